import hashlib
import math
import zlib
from collections import Counter

import pytest

from assay.llm.sharding import place


def score(key, shard, weight=1.0):
    name = ("n" if key is None else f"k{key}") + f":{shard}"
    u = (int(hashlib.md5(name.encode()).hexdigest()[:13], 16) + 0.5) / 2**52
    return -math.log(u) / weight


def check(df, out, weights, grown):
    want = Counter()
    for r in df.collect():
        text = (r["text"] or "").encode()
        scores = [(score(r["doc_id"], s, w), s) for s, w in enumerate([*weights, grown])]
        want[r["doc_id"], len(text) + 16, zlib.crc32(text), min(scores[:-1])[1], min(scores)[1]] += 1
    got = out.collect()
    assert want == Counter((r["doc_id"], r["size"], r["text_crc32"], r["shard"], r["grown_shard"]) for r in got)
    slots = {}
    for r in got:
        slots.setdefault(r["shard"], []).append(r["slot"])
        assert r["grown_shard"] in (r["shard"], len(weights))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_equal_shards(messy):
    check(messy, place(messy, 5), [1.0] * 5, 1.0)


def test_weights(messy):
    check(messy, place(messy, [1, 3, 0.5], grown=2.0), [1, 3, 0.5], 2.0)


def test_weights_set_the_shares(spark):
    out = place(spark.range(6000).selectExpr("id as doc_id", "'' as text"), [1, 3], grown=None)
    counts = {r["shard"]: r["count"] for r in out.groupBy("shard").count().collect()}
    assert abs(counts[1] / 6000 - 0.75) < 0.03 and out.where("grown_shard is not null").isEmpty()


def test_empty(empty):
    assert place(empty, 3).isEmpty()


def test_weights_must_be_positive(messy):
    with pytest.raises(ValueError):
        place(messy, [1, 0])
