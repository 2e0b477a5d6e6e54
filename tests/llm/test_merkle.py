"""The manifest against a plain Merkle tree over whole lists."""

import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from callscore.llm import merkle

from .helpers import clashing, docs, empty


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(*values):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def levels_of(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i:i + 3]) for i in range(0, len(out[-1]), 3)])
    return out


def siblings(levels, i):
    out = []
    for nodes in levels[:-1]:
        run = i - i % 3
        out += [n for j, n in enumerate(nodes[run:run + 3], run) if j != i]
        i //= 3
    return out


def with_leaf(levels, i, x):
    """The last node after leaf ``i`` was replaced and all was hashed anew."""
    nodes = list(levels[0])
    nodes[i] = x
    return levels_of(nodes)[-1][0]


def brute(rows):
    """rows: (doc_id, text, lang, source, n_chars)."""
    by = {}
    for d, t, la, s, n in rows:
        own = leaf(d, s, la, n, t)
        other = leaf(d, s, la, n, None if t is None else t.replace("\n", "")) if d is not None and zlib.crc32(str(d).encode()) % 2 == 0 else own
        by.setdefault(s, []).append((d is not None, d or 0, own, other, d))
    keys = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in keys:
        by[s].sort(key=lambda r: r[:3])
        trees[s] = levels_of([r[2] for r in by[s]])
    top = levels_of([trees[s][-1][0] for s in keys])
    root, out = top[-1][0], []
    for k, s in enumerate(keys):
        for i, (_, _, own, other, d) in enumerate(by[s]):
            folded = with_leaf(top, k, with_leaf(trees[s], i, other))
            out.append((d, own, trees[s][-1][0], root, h(*siblings(trees[s], i), *siblings(top, k)), folded, folded == root))
    return sorted(out, key=str)


def digest(text):
    return merkle.leaf_digest(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text)


def run(df, **more):
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, digest(F.replace("text", F.lit("\n"), F.lit(""))))
    rows = merkle.manifest(df, digest(F.col("text")), tampered, **more)
    proof = F.sha2(F.array_join(F.transform("path", lambda p: F.concat(p["before"], p["after"])), ""), 256)
    got = rows.select("doc_id", "leaf", "subroot", "root", proof.alias("p"), "folded_root", "verified").collect()
    return sorted([tuple(r) for r in got], key=str)


def plain(df):
    return [tuple(r) for r in df.select("doc_id", "text", "lang", "source", "n_chars").collect()]


@pytest.mark.parametrize("levels", [1, 2, 6])
def test_blocks_of_any_size_give_the_same_tree(spark, levels):
    """One hot key over several levels of blocks, keys of 1, 2, 3, 9 and 10 rows, and many keys."""
    rows = [(i, f"a\nb{i}", "en", "hot") for i in range(100)]
    rows += [(1000 + i, f"x{i}\n" if i % 3 else f"x{i}", None, f"k{n}") for n in (1, 2, 3, 9, 10) for i in range(n)]
    rows += [(2000 + i, None if i % 2 else "one\nline", "de", f"s{i:02}") for i in range(14)]
    df = docs(spark, rows)
    assert run(df, levels=levels) == brute(plain(df))


def test_awkward_rows(spark):
    """Null ids, texts and sources, repeated rows, long texts, and columns named like outputs."""
    df = docs(spark).unionByName(docs(spark, [(7, "same row twice", "en", "c"), (21, "\n\n", "en", "é"), (22, "é\n", "en", "z")]))
    expected = brute(plain(df))
    assert run(df, levels=1) == expected
    assert run(clashing(df).withColumn("leaf", F.lit("x")).withColumn("root", F.lit(1)).withColumn("grp", F.lit(2))) == expected


def test_small_tables(spark):
    one = docs(spark, [(5, "a\nb", "en", None)])
    (d, own, subroot, root, proof, folded, ok), = run(one)
    assert own == subroot == root and proof == h() and d == 5 and ok == (folded == root)
    assert run(one) == brute(plain(one))
    assert run(empty(one)) == []


def test_every_path_verifies_and_versions_share_nodes(spark):
    df = docs(spark, [(i, f"t{i}", "en", f"s{i % 4}") for i in range(60)])
    rows = merkle.manifest(df, digest(F.col("text")), F.lit(None).cast("string"), levels=1)
    assert rows.where((merkle.fold(F.col("leaf"), F.col("path")) != F.col("root")) | ~F.col("verified")).count() == 0
    tree = merkle.Tree([h(str(i)) for i in range(20)], None)
    before = [list(x) for x in tree.levels]
    copied = tree.version(13, h("other"))
    assert [list(x) for x in tree.levels] == before and len(copied) == len(before)
    assert copied[-1] == with_leaf(before, 13, h("other"))
