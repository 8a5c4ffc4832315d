import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from assay.llm import exact
from assay.llm.exact import DigestIndex, dedupe, drop_copies
from assay.session import scratch_path, settle

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def least(key):
    return float("-inf") if key is None else key


def test_brute_force(messy):
    groups = defaultdict(list)
    for r in messy.collect():
        groups[hashlib.sha256((r["text"] or "").translate(LOWER).encode()).hexdigest()].append(r["doc_id"])
    want = sorted(
        (str(d), str(max(ids, key=least)), len(ids), digest) for digest, ids in groups.items() for d in ids
    )
    got = dedupe(messy).collect()
    assert sorted((str(r["doc_id"]), str(r["keep_id"]), r["group_size"], r["text_sha256"]) for r in got) == want
    kept = [r["text_sha256"] for r in got if r["kept"]]
    assert sorted(kept) == sorted(groups)
    assert all(r["doc_id"] == r["keep_id"] for r in got if r["kept"])


def test_drop_copies(messy):
    left = drop_copies(messy)
    assert left.columns == messy.columns
    assert sorted((r["text"] or "").translate(LOWER) for r in left.collect()) == sorted(
        {(r["text"] or "").translate(LOWER) for r in messy.collect()}
    )


def test_index_goes_on(spark):
    path = scratch_path(spark, "index")
    frame = lambda rows: spark.createDataFrame(rows, "doc_id long, text string")
    first = frame([(1, "A"), (2, "b")])
    dedupe(first, DigestIndex(spark, path, 4))
    later = {r["doc_id"]: r for r in dedupe(frame([(9, "a"), (10, "c")]), DigestIndex(spark, path, 4)).collect()}
    assert later[9]["keep_id"] == 1 and not later[9]["kept"] and later[10]["kept"]
    assert DigestIndex(spark, path, 4).table().count() == 3
    dedupe(first, DigestIndex(spark, path, 4))  # again, as after a failure
    assert DigestIndex(spark, path, 4).table().count() == 3


def test_anti_join_leaves_the_index_in_place(spark):
    index = DigestIndex(spark, scratch_path(spark, "index"), 4)
    rows = spark.range(50).selectExpr("unhex(sha2(string(id), 256)) digest", "id doc_id", "id row")
    index.add(rows)
    new = rows.groupBy("digest").count().hint("merge").join(index.table(), "digest", "left_anti")
    plan = new._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan


def test_other_bucket_numbers_and_keys_are_refused(spark):
    path = scratch_path(spark, "index")
    DigestIndex(spark, path, 4)
    assert DigestIndex(spark, path).table().isEmpty()
    for args in ((8,), (None, "string")):
        with pytest.raises(ValueError):
            DigestIndex(spark, path, *args)


def test_buckets_grow_with_the_rows(spark):
    index = DigestIndex(spark, scratch_path(spark, "index"), rows=10**9)
    assert f"{-(-10**9 * 64 // (256 << 20))}" in str([r for r in spark.sql(f"DESCRIBE EXTENDED {index.name}").collect() if r[0] == "Num Buckets"])


def test_hot_text_is_reduced_before_it_moves(spark, monkeypatch):
    """Half of all rows have one text; a task passes on one row of them."""
    seen = []

    def recorded(df, label="table"):
        if label == "reduced":
            seen.append(df)
        return settle(df, label)

    monkeypatch.setattr(exact, "settle", recorded)
    df = spark.range(2000, numPartitions=4).selectExpr("id as doc_id", "if(id % 2 = 0, 'hot', concat('t', id)) as text")
    assert dedupe(df).where("kept").count() == 1001
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    before, after = plan.index("partial_max"), plan.index("Exchange hashpartitioning(digest")
    assert "Join" not in plan and before > after  # the lower line runs first


@pytest.mark.parametrize("kind", ["string", "date", "int"])
def test_other_keys(spark, kind):
    df = spark.range(1, 30).selectExpr("cast(id as int) as n", "if(id % 3 = 0, 'A', if(id % 3 = 1, 'a', concat(id))) as text")
    keys = {"string": F.concat(F.lit("k"), F.lpad("n", 3, "0")), "date": F.date_add(F.lit("2020-01-01").cast("date"), F.col("n")), "int": F.col("n")}
    rows = df.select(keys[kind].alias("doc_id"), "text")
    out = dedupe(rows)
    assert dict(out.dtypes)["keep_id"] == kind
    best = defaultdict(list)
    for r in rows.collect():
        best[r["text"].lower()].append(r["doc_id"])
    assert {(r["doc_id"], r["keep_id"]) for r in out.collect()} == {(d, max(ids)) for ids in best.values() for d in ids}


def test_empty(empty):
    assert dedupe(empty).isEmpty() and drop_copies(empty).isEmpty()
