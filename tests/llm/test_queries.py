"""The registered queries and the pipeline on the smallest tables."""

import hashlib
import math
import re
import struct
import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from callscore.llm import langid, mixing, quality
from callscore.llm import queries as Q
from callscore.plans.compare import compare, duck_connect

from .helpers import low
from .test_models import brute_statistics
from .test_native import brute_targets
from .test_simhash import brute_fingerprint, classes


@pytest.fixture(scope="module")
def con(small_dir):
    return duck_connect(small_dir)


@pytest.mark.parametrize("name", sorted(Q.QUERIES))
def test_query(spark, con, small_dir, name):
    df = entry.queries()[name](spark, small_dir)
    sql = entry.oracle_sql().get(name)
    if sql:
        r = compare(df, con, sql)
        assert r["schema_match"] and r["values_match"], r
    else:
        table, key = ("pages", "page_id") if "page_id" in df.columns else ("documents", "doc_id")
        assert df.select(key).distinct().count() == con.execute(f"select count(*) from {table}").fetchone()[0]


def plain_mix(rows, block=mixing.BLOCK_WORDS, seed=7):
    """What the mix takes of ``rows`` (one shard), word by word."""
    md5 = lambda *x: hashlib.md5(":".join(map(str, x)).encode()).hexdigest()
    spans = {r: [m.span() for m in re.finditer(r"[^\x20\x09-\x0d]+", r[1] or "")] for r in rows}
    sources = sorted({r[3] for r in rows}, key=lambda x: (x is None, x or ""))
    size = {s: sum(len(spans[r]) for r in rows if r[3] == s) for s in sources}
    target = brute_targets(size)
    exact = {"null" if s is None else f"s{s}": target[s] / block for s in sources}
    total, over = math.floor(sum(exact.values()) + 0.5), sum(math.floor(x + 0.5) for x in exact.values())
    seats = dict.fromkeys(exact, 0)
    for _ in range(total):      # of equal quotients the first loses its seat if rounding gives too many
        best = max(sorted(exact, reverse=over > total), key=lambda k: exact[k] / (2 * seats[k] + 1))
        seats[best] += 1
    out = []
    for s in sources:
        stream = [(r, k) for r in sorted((r for r in rows if r[3] == s), key=lambda r: (md5(seed, r[0], len(spans[r])), r[0])) for k in range(len(spans[r]))]
        words, key = len(stream), "null" if s is None else f"s{s}"
        quota = 2 * words if target[s] >= 2 * words else min(seats[key] * block or round(target[s]), 2 * words)
        passes, rest = divmod(quota, words)
        begin = int(md5(seed, key, 0)[:8], 16) % -(-words // block) * block
        run = [stream[begin:begin + rest], stream[:max(0, begin + rest - words)]]
        for r in {r for r, _ in stream}:
            out += [r] * passes
            parts = [[k for x, k in part if x == r] for part in run]
            for ks in parts:
                if len(ks) == len(spans[r]):
                    out.append(r)
                elif ks:
                    text = r[1][spans[r][ks[0]][0]:spans[r][ks[-1]][1]]
                    out.append((r[0], text, r[2], r[3], len(text)))
    return out


def plain_stages(rows, model):
    """The rows after each of the first four stages, in plain Python around the classifier's probability."""
    good = []
    for r in rows:
        n, _, _, _, repeated = brute_statistics(r[1])
        if n >= 20 and 100 * repeated <= 30 * n and model.probability(r[1]) >= quality.THRESHOLD:
            good.append(r)
    yield good
    last = {}
    for r in sorted(good, key=lambda r: r[0]):
        last[low(r[1])] = r
    single = list(last.values())
    yield single
    fps = {r: brute_fingerprint(r[1]) for r in single}
    values = sorted(set(fps.values()))
    root = classes(values, [(a, b) for i, a in enumerate(values) for b in values[:i] if (a ^ b).bit_count() <= 3])
    first = {}
    for r in sorted(single, key=lambda r: r[0]):
        first.setdefault(root[fps[r]], r)
    yield list(first.values())
    yield plain_mix(list(first.values()))


def check_packed(pieces, mixed):
    """Every id of every mixed row in one piece, and sequences without gaps or excess."""
    tokenizer = Tokenizer.from_file(Q.tokenizer_path())
    wanted, covered = {}, Counter()
    for r in mixed:
        ids = [*tokenizer.encode(r[1], add_special_tokens=False).ids, 1]
        wanted.setdefault((r[0], len(ids)), []).append(ids)
    sequences = {}
    for p in pieces:
        ids = list(struct.unpack(f"<{p['length']}I", p["ids"]))
        assert any(ids == w[p["start"]:p["start"] + p["length"]] for w in wanted[p["doc_id"], p["doc_tokens"]])
        assert p["ids_crc32"] == zlib.crc32(bytes(p["ids"]))
        covered.update((p["doc_id"], p["doc_tokens"], k) for k in range(p["start"], p["start"] + p["length"]))
        sequences.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    assert covered == Counter({(d, n, k): len(copies) for (d, n), copies in wanted.items() for k in range(n)})
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= 2048


def test_pipeline_equals_brute_force(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "exact dedup", "simhash near-dedup", "mixing", "packing"]
    assert docs.count() <= mixing.SHARD_ROWS
    model = quality.fit(docs.select(*corpus_pipeline.COLUMNS), spark.read.parquet(f"{small_dir}/labels.parquet"))
    plain = plain_stages([tuple(r) for r in docs.select(*corpus_pipeline.COLUMNS).collect()], model)
    sizes = [docs.count()]
    for (name, stage), want in zip(corpus_pipeline.STAGES, plain):
        docs = stage(spark, docs, small_dir).checkpoint()
        assert docs.columns == corpus_pipeline.COLUMNS
        got = [tuple(r) for r in docs.collect()]
        assert Counter(got) == Counter(want), name
        sizes.append(len(got))
    assert sizes[0] > sizes[1] >= sizes[2] >= sizes[3] > 0
    check_packed(corpus_pipeline.run(spark, small_dir).collect(), got)


def test_languages_equal_brute_force(spark, small_dir):
    """Every prediction of the query from the definition: trigrams of letters, bound, bundled, compared."""
    space = langid.Space()

    def vector(text):
        s = re.sub("\0+", "\0", "\0" + "".join(c if c.isalpha() else "\0" for c in (text or "").lower()) + "\0")
        total = np.zeros(space.dimensions)
        for gram, n in Counter(s[k:k + 3] for k in range(len(s) - 2)).items():
            if gram not in vectors:
                vectors[gram] = math.prod(np.roll(space.letter(ord(c)), 2 - i).astype(np.float64) for i, c in enumerate(gram))
            total += n * vectors[gram]
        return total if len(s) > 2 else None

    vectors, prototypes, texts = {}, {}, {}
    for r in spark.read.parquet(f"{small_dir}/documents.parquet").collect():
        texts[r["doc_id"]] = v = vector(r["text"])
        if v is not None and r["lang"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 != 2:
            prototypes[r["lang"]] = prototypes.get(r["lang"], 0) + v
    cosine = lambda a, b: float(a @ b / np.linalg.norm(a) / np.linalg.norm(b))
    got = Q.QUERIES["op8_language_id"](spark, small_dir).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(texts)
    for r in got:
        v = texts[r["doc_id"]]
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        if v is None:
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
            continue
        scores = {lang: cosine(p, v) for lang, p in prototypes.items()}
        assert scores[r["lang_pred"]] == pytest.approx(max(scores.values()), abs=1e-6) and r["score"] == pytest.approx(max(0.0, min(1.0, max(scores.values()))), abs=1e-6)
