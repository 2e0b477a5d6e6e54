"""Quality rules and language identification: brute-force statistics, held-out accuracy."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from callscore.llm import langid, quality

from .helpers import LONG, ROWS, clashing, docs, empty


def brute_statistics(text):
    text = text or ""
    words, spaces = text.encode().split(), set(quality.SPACES)
    seen: dict = {}
    for i in range(len(words) - 7):
        seen.setdefault(tuple(words[i:i + 8]), []).append(i)
    covered = {i + d for at in seen.values() if len(at) > 1 for i in at for d in range(8)}
    lines, doubled = set(), 0
    for line in text.split("\n"):
        if any(c not in spaces for c in line):
            doubled += line in lines
            lines.add(line)
    return len(words), sum(c not in spaces for c in text), sum(c in "#*$%&|<>" for c in text), doubled, len(covered)


def test_statistics():
    rng = random.Random(4)
    texts = [t for _, t, *_ in ROWS] + ["a b c d e f g h " * 3, "a " * 40, "a\na\n \n \na \n a", "one two three four five six seven eight"]
    texts += [" ".join(rng.choice("abc") for _ in range(rng.randrange(60))) + "\n|#" for _ in range(80)]
    for t in texts:
        assert quality.statistics(t) == brute_statistics(t)


def test_ngrams_do_not_depend_on_parts(monkeypatch):
    text = LONG[:5000] + " é\u2003ü " + LONG[:300]
    whole = quality.features(text)
    assert all(len(x) == len(whole[0]) for x in whole)
    assert quality.features("")[0].size == 0 and quality.features(None)[0].size == 0
    model = quality.Model(np.random.default_rng(0).normal(size=2 * quality.BUCKETS).astype(np.float32), 0.1)
    at, x = whole
    assert model.raw(text) == pytest.approx(0.1 + float(model.weights[at] @ x), rel=1e-3)
    monkeypatch.setattr(quality, "CHUNK", 1000)     # parts lose only the n-grams across their borders
    assert model.raw(text) == pytest.approx(0.1 + float(model.weights[at] @ x), rel=0.1)


def test_classifier_on_held_out_rows(spark, small_dir):
    data = spark.read.parquet(f"{small_dir.replace('0.001', '0.01')}/documents.parquet")
    labels = spark.read.parquet(f"{small_dir.replace('0.001', '0.01')}/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    model = quality.fit(data, labels.where(~held))
    got = quality.score(data, model).join(labels.where(held).select("doc_id", "quality"), "doc_id").collect()
    bad = [r for r in got if not r["quality"]]
    good = [r for r in got if r["quality"] and not r["base_failed"]]
    assert sum(not r["kept"] for r in bad) >= 0.8 * len(bad)
    assert sum(r["kept"] for r in good) >= 0.97 * len(good)
    # calibrated: mean probability near the share of good rows
    p = np.array([r["quality_score"] for r in got])
    assert abs(p.mean() - np.mean([r["quality"] for r in got])) < 0.08
    again = quality.fit(data.repartition(7), labels.where(~held))
    assert np.allclose(again.weights, model.weights) and again.slope == pytest.approx(model.slope)


def test_score_edges(spark):
    none = quality.fit(empty(docs(spark)), spark.createDataFrame([], "doc_id long, quality int"))
    out = quality.score(clashing(docs(spark)), none)
    rows = out.collect()
    assert len(rows) == len(ROWS) and sum(c.lower() == "kept" for c in out.columns) == 1
    for r in rows:
        n, chars, symbols, lines, repeated = brute_statistics(r["text"])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (n, chars, symbols, lines, repeated)
        assert r["base_failed"] == (n < 20 or 100 * repeated > 30 * n) and r["kept"] == (not r["base_failed"])
    one = quality.fit(docs(spark), spark.createDataFrame([(1, 0), (2, 0), (None, 1), (3, None)], "doc_id long, quality int"))
    assert quality.score(docs(spark), one).where("kept").count() == 0
    assert quality.score(empty(docs(spark)), none).count() == 0


def test_gram_vectors_bind_and_permute():
    space = langid.Space(64)
    codes, counts = langid.grams("Ab-ab")
    assert [(c >> 42, c >> 21 & 0x1FFFFF, c & 0x1FFFFF) for c in codes.tolist()] == [(0, 97, 98), (97, 98, 0), (98, 0, 97)]
    assert counts.tolist() == [2, 2, 1]
    a, b, s = (space.letter(c) for c in (97, 98, 0))
    assert (space.vectors(codes)[1] == np.roll(a, 2) * np.roll(b, 1) * s).all()
    cached = langid._Cached(64, langid.SEED)
    cached.learn(codes[:2])
    assert (cached.bundle(codes, counts) == space.bundle(codes, counts)).all()
    assert langid.grams("123 ?!")[0].size == 0 and langid.grams(None)[0].size == 0


def test_language_accuracy_on_held_out_rows(spark, small_dir):
    data = spark.read.parquet(f"{small_dir.replace('0.001', '0.01')}/documents.parquet")
    train = data.where(F.crc32(F.col("doc_id").cast("string")) % 4 != 2)
    profiles = langid.learn(train)
    got = langid.identify(data.select("doc_id", "text", "lang"), profiles).collect()
    held = [r for r in got if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    assert np.mean([r["lang"] == r["lang_pred"] for r in held]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got)
    assert np.array_equal(langid.learn(train.repartition(9)).prototypes, profiles.prototypes)


def test_identify_edges(spark):
    rows = [(1, None, "en", "a"), (2, "", "en", "a"), (3, "12 + 4", "en", "a"), (4, "word " * 50, None, "a"), (5, "mot " * 50, "fr", "a"), (6, "word " * 9, "en", "a"),
            (6, "word " * 9, "en", "a"), (None, "mot", "fr", "a")]
    profiles = langid.learn(docs(spark, rows))
    got = langid.identify(clashing(docs(spark, rows)), profiles).collect()
    assert [r["lang_pred"] for r in got] == ["und", "und", "und", "en", "fr", "en", "en", "fr"]
    assert [r["score"] for r in got][:3] == [0, 0, 0]
    nothing = langid.learn(empty(docs(spark)))
    assert {r["lang_pred"] for r in langid.identify(docs(spark, rows), nothing).collect()} == {"und"}
    assert langid.identify(empty(docs(spark)), profiles).count() == 0


def test_any_number_of_languages(spark, monkeypatch):
    """Blocks of languages give what all prototypes at once give."""
    rng = random.Random(8)
    rows = [(i, " ".join("".join(rng.choice("abcdefgh"[k % 4:k % 4 + 5]) for _ in range(4)) for _ in range(30)), f"l{k:02d}", "a")
            for i, k in enumerate(k for k in range(11) for _ in range(4))]
    df = docs(spark, [*rows, (100, None, "l01", "a"), (101, "123", None, "a"), (102, "abcd bcde", None, "a")])
    want = sorted((r["doc_id"], r["lang_pred"], r["score"]) for r in langid.identify(df, langid.learn(df)).collect())
    monkeypatch.setattr(langid, "MAX_LANGUAGES", 3)
    with pytest.raises(ValueError):
        langid.learn(df)
    out = langid.classify(clashing(df), df)
    got = sorted((r["doc_id"], r["lang_pred"], r["score"]) for r in out.collect())
    assert [g[:2] for g in got] == [w[:2] for w in want] and np.allclose([g[2] for g in got], [w[2] for w in want]) and "text" not in out.columns
    assert langid.classify(empty(df), df).count() == 0 and {r["lang_pred"] for r in langid.classify(df, empty(df)).collect()} == {"und"}


def test_fit_takes_up_to_six_thousand_labels(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(quality, "fit_rows", lambda rows: seen.append(len(rows)))
    for n, want in ((3980, 3980), (6050, 6000)):
        rows = spark.range(n).select(F.col("id").alias("doc_id"), F.lit("a few words").alias("text"), (F.col("id") % 2).cast("int").alias("quality"))
        quality.fit(rows.select("doc_id", "text"), rows.select("doc_id", "quality"))
        assert seen.pop() == want
