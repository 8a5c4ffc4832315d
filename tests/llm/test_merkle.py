import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from assay.llm import merkle

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(*values):
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def tree(nodes):
    """(root, per leaf the (left, right) texts of each level)."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha(*levels[-1][i : i + 16]) for i in range(0, len(levels[-1]), 16)])
    paths = []
    for at in range(len(nodes)):
        path = []
        for level in levels[:-1]:
            a = at - at % 16
            path.append(("".join(level[a:at]), "".join(level[at + 1 : a + 16])))
            at //= 16
        paths.append(path)
    return levels[-1][0], paths


def expected(rows):
    by_source = defaultdict(list)
    for r in rows:
        by_source[r["source"]].append((r["doc_id"] is not None, r["doc_id"], leaf(*(r[f] for f in merkle.FIELDS)), r))
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        by_source[s].sort(key=lambda x: (x[0], x[1] or 0, x[2]))
        trees[s] = tree([x[2] for x in by_source[s]])
    root, outer = tree([trees[s][0] for s in order])
    out = []
    for s, up in zip(order, outer):
        for (_, key, node, r), inner in zip(by_source[s], trees[s][1]):
            path, folded = inner + up, node
            if key is not None and zlib.crc32(str(key).encode()) % 5 == 0 and r["text"] is not None:
                folded = leaf(*(r[f].translate(LOWER) if f == "text" else r[f] for f in merkle.FIELDS))
            for left, right in path:
                folded = sha(left, folded, right)
            out.append((key, node, trees[s][0], root, sha(*[x for pair in path for x in pair]), folded, folded == root))
    return out


@pytest.fixture(scope="module")
def sourced(messy):
    kind = F.pmod(F.xxhash64("text", "doc_id"), F.lit(7))
    source = F.when(kind < 3, "hot").when(kind == 3, "é").when(kind == 4, None).otherwise(F.concat(F.lit("s"), kind.cast("string")))
    more = messy.sparkSession.createDataFrame([(n, f"UPPER Case {n}") for n in range(200, 230)], "doc_id long, text string")
    messy = messy.unionByName(more, allowMissingColumns=True)
    return messy.withColumns({"source": source, "lang": F.when(kind > 1, "xx"), "n_chars": F.length("text"), "node": F.lit("n"), "at": F.lit(1), "tree": F.lit("t")})


def test_brute_force(sourced):
    out = merkle.check_tampered(sourced)
    assert out.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    want = expected(sourced.collect())
    assert sorted(map(str, map(tuple, out.collect()))) == sorted(map(str, want))
    assert {row[-1] for row in want} == {True, False}


@pytest.mark.parametrize("levels, n", [(1, 300), (2, 5000), (3, 5000)])
def test_several_rounds(spark, monkeypatch, levels, n):
    """Small superblocks, so that trees of leaves and of sources take up to three rounds."""
    monkeypatch.setattr(merkle, "CELL_ROWS", 100)
    df = spark.range(n).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("Text "), F.col("id")).alias("text"), F.lit("en").alias("lang"),
        F.when(F.col("id") % 10 < 8, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 300)).alias("source"), F.lit(6).alias("n_chars"),
    )
    want = sorted(expected(df.collect()))
    assert sorted(map(tuple, merkle.check_tampered(df, levels=levels).collect())) == want


def test_proofs_fold_to_the_root(sourced):
    manifest = merkle.build(sourced)
    root = manifest.root.first()["node"]
    rows = manifest.proofs().collect()
    assert len(rows) == sourced.count()
    assert all(merkle.fold(r["leaf"], r["lefts"], r["rights"]) == root == r["roots"][1] for r in rows)
    assert {r["roots"][0] for r in rows} == {r["node"] for r in manifest.subroots.collect()}


@pytest.mark.parametrize("n", [1, 2, 16, 17])
def test_small(spark, n):
    df = spark.createDataFrame([(i, "s", None, i, "AB") for i in range(n)], "doc_id long, source string, lang string, n_chars long, text string")
    assert sorted(map(tuple, merkle.check_tampered(df).collect())) == sorted(expected(df.collect()))


def test_levels():
    assert [merkle.levels_within(n) for n in (1, 2, 16, 17, 256, 257, 4096, 4097, 10**9)] == [0, 1, 1, 2, 2, 3, 3, 3, 3]


def test_empty(empty):
    df = empty.selectExpr("doc_id", "text", "text as source", "text as lang", "0L as n_chars")
    assert merkle.check_tampered(df).isEmpty()
