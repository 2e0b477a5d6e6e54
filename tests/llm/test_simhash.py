import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from callscore.llm import components, simhash

from .helpers import ROWS, clashing, docs, empty, low


def brute_fingerprint(text, k=3):
    words = low(text).split()
    shingles = [b" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(values, edges):
    parent = {v: v for v in values}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {v: find(v) for v in values}


def test_fingerprint(monkeypatch):
    monkeypatch.setattr(simhash, "CHUNK", 7)
    for text in [t for _, t, *_ in ROWS if t is None or len(t) < 3000] + ["a b", "a", "A\x0bB C d e f g h i j k l m n a b c"]:
        assert simhash.fingerprint(text) == brute_fingerprint(text)
    assert simhash.fingerprint("p q r s t", 5) == brute_fingerprint("p q r s t", 5)


@pytest.mark.parametrize("max_bits,block", [(3, 4096), (3, 40), (0, 4096), (1, 8), (5, 4096)])
def test_links_connect_as_all_pairs_do(spark, max_bits, block):
    rng = random.Random(max_bits * 100 + block)
    values = set()
    for n in (1, 3, 60, 200):       # clusters of near fingerprints, and loose ones
        centre = rng.getrandbits(64)
        for _ in range(n):
            v = centre
            for _ in range(rng.randrange(4)):
                v ^= 1 << rng.randrange(64)
            values.add(v)
    values |= {rng.getrandbits(64) for _ in range(100)} | {0, (1 << 64) - 1, 7}
    signed = sorted(v - (1 << 64) if v >> 63 else v for v in values)
    df = spark.createDataFrame([(v,) for v in signed], "fp long")
    links = {(r["a"], r["b"]) for r in simhash.near_links(df, max_bits, block).collect()}
    arr = np.array(signed, np.int64).view(np.uint64)
    pairs = [(signed[i], signed[j]) for i in range(len(arr)) for j in range(i) if int(np.bitwise_count(arr[i] ^ arr[j])) <= max_bits]
    for a, b in links:
        assert 0 < ((a ^ b) & ((1 << 64) - 1)).bit_count() <= max_bits
    want = classes(signed, pairs)
    assert classes(signed, links) == want
    roots = {r["node"]: r["root"] for r in components.connected_components(simhash.near_links(df, max_bits, block)).collect()}
    assert all(roots.get(v, v) == want[v] for v in signed)


def test_components_of_long_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 70)] + [(1000, k) for k in range(1001, 1300)] + [(-5, -5), (5, 4), (2000, 2001), (2001, 2000)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r["node"]: r["root"] for r in components.connected_components(df).collect()}
    want = classes({x for e in edges for x in e}, edges)
    assert all(got.get(n, n) == r for n, r in want.items())
    assert components.connected_components(df.where("false")).count() == 0


def near_rows():
    rng = random.Random(9)
    rows = list(ROWS)
    for k in range(12):
        words = [f"w{rng.randrange(5000)}" for _ in range(400)]
        for c in range(3):
            copy = list(words)
            if c:
                copy[rng.randrange(400)] = f"changed{c}"
            rows.append((100 + 10 * k + c, " ".join(copy), "en", "a"))
    return rows


def test_mark_and_drop_match_brute_force(spark):
    rows = near_rows()
    got = simhash.mark_near_duplicates(docs(spark, rows)).collect()
    assert len(got) == len(rows)
    fps = [brute_fingerprint(t) for _, t, *_ in rows]
    arr = np.array(fps, np.uint64)
    root = classes(range(len(rows)), [(i, j) for i in range(len(rows)) for j in range(i) if int(np.bitwise_count(arr[i] ^ arr[j])) <= 3])
    least: dict = {}
    for k, r in root.items():
        if rows[k][0] is not None:
            least[r] = min(least.get(r, rows[k][0]), rows[k][0])
    want = sorted(((str(rows[k][0]), f"{fps[k]:016x}", str(least.get(root[k]))) for k in range(len(rows))))
    assert sorted((str(r["doc_id"]), r["fingerprint"], str(r["component_id"])) for r in got) == want
    kept = simhash.drop_near_duplicates(clashing(docs(spark, rows)))
    assert sorted(str(r["doc_id"]) for r in kept.select("doc_id").collect()) == sorted(str(least.get(r)) for r in set(root.values()))


def test_empty_and_one_row(spark):
    assert simhash.mark_near_duplicates(empty(docs(spark))).count() == 0
    assert simhash.drop_near_duplicates(empty(docs(spark))).count() == 0
    one = simhash.mark_near_duplicates(docs(spark, [(1, None, None, None)])).select("doc_id", "fingerprint", "component_id").collect()
    assert [tuple(r) for r in one] == [(1, "0" * 16, 1)]
    assert simhash.fingerprints(docs(spark), fp="root").where(F.col("root").isNull()).count() == 0
