"""Secrets in text: strong patterns, and weak parts that count only beside their counterparts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assay.session import settle

REACH = 200

# Name, pattern, the group whose length is tested, its least length. Order is the order of kinds.
BASE = [
    ("assign", r"(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
     r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
]
# Weak parts: identifiers, secrets without a name, and endpoints.
WEAK = [
    ("identifier", r"(?:client_id|access_key_id|user_?name|login|account)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9_.@-]+)", 1, 3),
    ("blob", r"(?<![A-Za-z0-9+/=_-])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=_-])", 0, 40),
    ("endpoint", r"(?:https?|postgres|postgresql|mysql|mongodb|redis|amqp)://[A-Za-z0-9._~:/?#@!$&()*+,;=%-]+", 0, 10),
]
# What part of a credential each kind can be, and the parts that a weak kind needs within reach.
PARTS = {"assign": "secret", "hex": "secret", "access": "id", "identifier": "id", "blob": "secret", "endpoint": "place"}
NEEDS = {"identifier": ["secret"], "blob": ["id"], "endpoint": ["id", "secret"]}


def matches(text: Column, kind: str, pattern: str, group: int, least: int) -> Column:
    """For each match of a kind, the characters since the last one, its length, and whether it counts.

    The pieces between matches come from splitting the text with the same pattern, so positions need
    no search of their own.
    """
    gaps = F.transform(F.split(text, pattern, -1), lambda x: F.char_length(x))
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def one(match, gap):
        value = match if group == 0 else F.regexp_extract(match, pattern, group)
        return F.struct(
            F.lit(kind).alias("kind"),
            gap.alias("gap"),
            F.char_length(match).alias("length"),
            (F.char_length(value) >= least).alias("counts"),
        )

    listed = F.zip_with(found, F.slice(gaps, F.lit(1), F.size(found)), one)
    return F.when(text.rlike(hint(kind, pattern, least)), listed)


def hint(kind: str, pattern: str, least: int) -> str:
    """A cheaper test that every text with a counting match passes."""
    return {"hex": r"[0-9a-f]{24}", "access": "AKIA", "blob": r"[A-Za-z0-9+/]{40}", "endpoint": "://"}.get(kind, pattern)


def spans(rows: DataFrame) -> DataFrame:
    """(row, kind, start, end) of all matches of rows (row, found arrays by kind)."""
    before = Window.partitionBy("row", "kind").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.col("length")).over(before)
    kinds = [name for name, *_ in BASE + WEAK]
    each = F.explode(F.array(*[F.coalesce(F.col(k), F.array()) for k in kinds])).alias("found")
    return (
        rows.select("row", each)
        .select("row", F.posexplode("found").alias("at", "match"))
        .select("row", "at", "match.*")
        .select("row", "kind", "counts", (end - F.col("length")).alias("start"), end.alias("end"))
        .where("counts")
        .drop("counts")
    )


def linked(found: DataFrame, reach: int = REACH) -> DataFrame:
    """Strong spans, and weak spans that have the parts they need within `reach` characters.

    The interval join is a sweep: sorted by position, each span sees the nearest end of each part before
    it and the nearest start after it, so no pairs are formed however many parts lie within reach.
    A weak part may be needed by another weak part.
    """
    part = F.create_map(*[F.lit(x) for kv in PARTS.items() for x in kv])[F.col("kind")]
    left = Window.partitionBy("row").orderBy("start", "end", "kind").rowsBetween(Window.unboundedPreceding, -1)
    right = Window.partitionBy("row").orderBy("start", "end", "kind").rowsBetween(1, Window.unboundedFollowing)
    parts = sorted(set(PARTS.values()))
    seen = found.withColumn("part", part)
    near = {}
    for p in parts:
        mine = F.col("part") == p
        last = F.max(F.when(mine, F.col("end"))).over(left)
        next_ = F.min(F.when(mine, F.col("start"))).over(right)
        near[f"near_{p}"] = F.coalesce(F.col("start") - last <= reach, F.lit(False)) | F.coalesce(
            next_ - F.col("end") <= reach, F.lit(False)
        )
    keep = F.col("kind").isin([name for name, *_ in BASE])
    for kind, needs in NEEDS.items():
        met = F.lit(True)
        for p in needs:
            met = met & F.col(f"near_{p}")
        keep = keep | ((F.col("kind") == kind) & met)
    return seen.withColumns(near).where(keep).select("row", "kind", "start", "end")


def scan(df: DataFrame, key: str = "doc_id", text: str = "text", reach: int = REACH) -> DataFrame:
    """One row per input row: counts and spans of the secrets in its whole text.

    Strong kinds (`BASE`) are leftmost non-overlapping matches, each kind on its own, and always count.
    Weak kinds (`WEAK`) count only with their counterparts within `reach` characters of the same text.
    Returns key, n_assign, n_access, n_hex, base_sha256, spans. Positions are code points, ends exclusive;
    spans are ordered by start, then kind. A null text counts as empty, which has no spans. Repeated rows
    and null keys keep a row each. Extra columns are not read. An empty table gives an empty result.

    The text is read once; only positions are shuffled, by row.
    """
    content = F.coalesce(F.col("text"), F.lit(""))
    rows = settle(
        df.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text")).select(
            "doc_id",
            F.monotonically_increasing_id().alias("row"),
            *[matches(content, *kind).alias(kind[0]) for kind in BASE + WEAK],
        ),
        "secrets",
    )
    kinds = [name for name, *_ in BASE + WEAK]
    some = F.lit(False)
    for k in kinds:
        some = some | F.coalesce(F.size(k) > 0, F.lit(False))
    found = linked(spans(rows.where(some)), reach)
    rank = F.array_position(F.array(*[F.lit(k) for k in kinds]), F.col("kind")).cast("int")
    base = len(BASE)
    listed = found.groupBy("row").agg(
        F.array_sort(F.collect_list(F.struct("start", rank.alias("rank"), "end", "kind"))).alias("all")
    )
    joined = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    every = F.coalesce(F.col("all"), F.array().cast("array<struct<start:bigint,rank:int,end:bigint,kind:string>>"))
    count = lambda n: F.size(F.filter(every, lambda s: s["rank"] == n)).cast("long")
    return (
        rows.select("doc_id", "row")
        .join(listed, "row", "left")
        .select(
            F.col("doc_id").alias(key),
            *[count(n + 1).alias(f"n_{name}") for n, (name, *_) in enumerate(BASE)],
            F.sha2(joined(F.filter(every, lambda s: s["rank"] <= base)), 256).alias("base_sha256"),
            joined(every).alias("spans"),
        )
    )
