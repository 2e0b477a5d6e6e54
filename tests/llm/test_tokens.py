"""Packing and token files: exact round trips."""

import random

import numpy as np
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st

from callscore.llm import packing, token_files, tokens
from callscore.llm.queries import tokenizer_path

from .helpers import ROWS, clashing, docs, empty


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


def whole(tokenizer, text, end):
    return np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [end], "<u4").tobytes()


ENCODER = []


def encoder():
    if not ENCODER:
        ENCODER.append(tokens.Encoder(open(tokenizer_path(), encoding="utf-8").read()))
    return ENCODER[0]


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=60), st.text("aBcTé\u0308\u0307İẞΣς'., \t\n\x1c\u00a0\u2003<|>endoftxEN09-", max_size=60)))
def test_words_one_by_one_equal_whole_text(text):
    from tokenizers import Tokenizer

    full = Tokenizer.from_file(tokenizer_path()) if not hasattr(test_words_one_by_one_equal_whole_text, "t") else test_words_one_by_one_equal_whole_text.t
    test_words_one_by_one_equal_whole_text.t = full
    assert encoder()(text) == np.array(full.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_cache_stays_bounded(monkeypatch, tokenizer):
    monkeypatch.setattr(tokens, "CACHE_WORDS", 50)
    e = tokens.Encoder(open(tokenizer_path(), encoding="utf-8").read())
    text = " ".join(f"word{i % 180}, {'y' * (i % 90)}" for i in range(2000))
    assert e(text) + np.array([1], "<u4").tobytes() == whole(tokenizer, text, 1)
    assert len(e._words) <= 51 and len(e._words.old) <= 51


def sequences_of(pieces, capacity=2048):
    by: dict = {}
    for p in pieces:
        by.setdefault(p[4], []).append((p[5], p[2]))
    fills = []
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
        fills.append(at)
    return fills


@pytest.mark.parametrize("capacity,max_open", [(2048, 4096), (64, 4096), (100, 3), (7, 1)])
def test_pack_pieces_keeps_every_id_and_pads_little(capacity, max_open):
    rng = random.Random(capacity)
    for kind in (lambda: int(rng.lognormvariate(4, 1.2)) + 1, lambda: capacity // 2 + 1, lambda: capacity, lambda: 1):
        data = [(k, np.arange(kind(), dtype="<u4").tobytes()) for k in range(700)]
        pieces = list(packing.pack_pieces(iter(data), capacity, max_open))
        back: dict = {}
        for doc, start, length, total, _, _, ids in pieces:
            assert len(ids) == 4 * length and total == len(data[doc][1]) // 4
            back.setdefault(doc, []).append((start, ids))
        assert all(b"".join(i for _, i in sorted(back[k])) == ids for k, ids in data)
        fills = sequences_of(pieces, capacity)
        assert sum(packing.is_padded(f, capacity) for f in fills) <= 1


def test_choose_minimises_the_sum_of_squares():
    rng = random.Random(2)
    bins = packing.SumOfSquares(50)
    for _ in range(300):
        size = rng.randrange(1, 50)

        def after(level):
            n = {h: int(c) for h, c in enumerate(bins.counts)}
            n[level] -= bool(level)
            n[level + size] = n.get(level + size, 0) + 1
            return sum(c * c for h, c in n.items() if packing.is_padded(h, 50))

        levels = [0] + [h for h in range(1, 51 - size) if bins.counts[h]]
        level = bins.choose(size)
        assert level in levels and after(level) == min(map(after, levels))
        bins.put(level, size)
        assert bins.lacking == sum(50 - h for h, c in enumerate(bins.counts) for _ in range(c) if packing.is_padded(h, 50))


def test_pack_round_trip(spark, tokenizer):
    got = packing.pack(clashing(docs(spark)).repartition(3), tokenizer_path()).collect()
    sequences_of([(r["doc_id"], r["start"], r["length"], r["doc_tokens"], r["sequence_id"], r["offset"]) for r in got])
    total = sum(len(whole(tokenizer, t, 1)) // 4 for _, t, *_ in ROWS)
    assert sum(r["length"] for r in got) == total
    for i in (3, 9, 10, 11):
        text = next(t for k, t, *_ in ROWS if k == i)
        assert b"".join(bytes(r["ids"]) for r in sorted((r for r in got if r["doc_id"] == i), key=lambda r: r["start"])) == whole(tokenizer, text, 1)
    assert packing.pack(empty(docs(spark)), tokenizer_path()).count() == 0


def test_token_files_round_trip(spark, tokenizer, tmp_path):
    path = str(tmp_path / "files")
    token_files.write_token_files(clashing(docs(spark)), path, tokenizer_path(), file_bytes=4096)
    got = token_files.read_token_files(spark, path).join(token_files.file_starts(spark, path), "file").collect()
    got.sort(key=lambda r: r["start"] + r["file_start"])
    assert [r["doc_id"] for r in got] == sorted((r[0] for r in ROWS), key=lambda i: (i is not None, i or 0))
    at = 0
    for r in got:
        assert r["start"] + r["file_start"] == at and len(r["ids"]) == 4 * r["n_tokens"]
        at += r["n_tokens"]
    assert sorted(bytes(r["ids"]) for r in got) == sorted(whole(tokenizer, t, 2) for _, t, *_ in ROWS)
    some = token_files.read_token_files(spark, path, [3, 11]).collect()
    assert {r["doc_id"]: bytes(r["ids"]) for r in some} == {i: whole(tokenizer, t, 2) for i, t, *_ in ROWS if i in (3, 11)}


def test_files_are_seekable_zstandard(spark, tokenizer, tmp_path):
    path = tmp_path / "files"
    token_files.write_token_files(docs(spark).where("doc_id = 10"), str(path), tokenizer_path())
    content = next(p.read_bytes() for p in path.iterdir() if p.name.startswith("part-") and p.stat().st_size)
    assert content[-4:] == (0x8F92EAB1).to_bytes(4, "little")
    text = next(t for k, t, *_ in ROWS if k == 10)
    reader = zstandard.ZstdDecompressor().stream_reader(content, read_across_frames=True)
    assert reader.read() == whole(tokenizer, text, 2)
    file = token_files.TokenFile(content)
    assert file.docs == [(10, len(whole(tokenizer, text, 2)) // 4)]
    broken = bytearray(content)
    broken[-14] ^= 1       # the last checksum byte of the index frame's entry is not a document's
    broken[-9 - 24 + 8] ^= 1        # this one is
    with pytest.raises(ValueError):
        token_files.TokenFile(bytes(broken)).read(0, zstandard.ZstdDecompressor())


def test_token_files_of_no_rows(spark, tmp_path):
    path = str(tmp_path / "none")
    token_files.write_token_files(empty(docs(spark)), path, tokenizer_path())
    assert token_files.read_token_files(spark, path).count() == 0 and token_files.file_starts(spark, path).count() == 0
