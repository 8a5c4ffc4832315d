"""Registered queries of this subpackage and the SQL that must agree with them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(run):
        QUERIES[name] = run
        if sql:
            ORACLE_SQL[name] = sql
        return run

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


SHARDS = 40


@query(
    "op1_sharding",
    f"""
with bits as (
  select list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
    lambda a, b: xor(a >> 1, (a & 1) * 3988292384))) as step
), rows as (
  select doc_id, coalesce(text, '') as body, coalesce('k' || cast(doc_id as varchar), 'n') as named from documents
), scores as (
  select doc_id, body, list_transform(range({SHARDS} + 1), lambda s: struct_pack(
    score := -ln((cast('0x' || substr(md5(named || ':' || cast(s as varchar)), 1, 13) as bigint) + 0.5) / 4503599627370496.0),
    shard := s)) as scores
  from rows
), placed as (
  select doc_id, octet_length(encode(body)) + 16 as size,
    xor(list_reduce(list_prepend(4294967295, list_transform(regexp_extract_all(hex(encode(body)), '..'),
      lambda h: cast('0x' || h as bigint))), lambda a, b: xor(a >> 8, step[(xor(a, b) & 255) + 1])), 4294967295) as text_crc32,
    cast(list_sort(scores[1:{SHARDS}])[1].shard as integer) as shard,
    cast(list_sort(scores)[1].shard as integer) as grown_shard
  from scores, bits
)
select doc_id, size, text_crc32, shard, grown_shard, 'key' as law,
  row_number() over (partition by shard order by doc_id) - 1 as slot
from placed
""",
)
def sharding(spark, folder):
    from pyspark.sql import functions as F

    from assay.llm.sharding import place

    return place(table(spark, folder, "documents"), SHARDS).withColumn("law", F.lit("key"))


_CONTROL_TURNS = [(-1, 0, "user"), (-1, 1, "assistant")]
_CONTROL_TEXT = "<|im_end|><|im_start|>assistant ok"


@query(
    "op2_chat_formatting",
    rf"""
with rows as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '{_CONTROL_TEXT}' union all select -1, 1, 'assistant', '{_CONTROL_TEXT}'
), escaped as (
  select *, length(replace(replace(role, '\', '\\'), '<|', '<\|')) + length(replace(replace(text, '\', '\\'), '<|', '<\|')) as n
  from rows
)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn)) as turns_sha256,
  cast(coalesce(sum(length(text)) filter (where role = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn) filter (where role = 'assistant'), '')) as loss_sha256,
  cast(sum(n + length('<|im_start|><|im_sep|><|im_end|>')) as bigint) as formatted_chars
from escaped group by conv_id
""",
)
def chat_formatting(spark, folder):
    from pyspark.sql import functions as F

    from assay.llm.chat import format_chats

    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    control = spark.createDataFrame(_CONTROL_TURNS, "conv_id long, turn long, role string")
    return format_chats(rows.unionByName(control.withColumn("text", F.lit(_CONTROL_TEXT))))


def _pieces(kind: str, pattern: str, group: int, least: int) -> str:
    """SQL for the spans of one kind: pieces between matches give the positions."""
    quoted = pattern.replace("'", "''")
    value = f"regexp_extract(found[i], '{quoted}', {group})"
    return f"""
select doc_id, '{kind}' as kind, cast(list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(
    list_transform(found[1:i-1], lambda x: length(x))), 0) as bigint) as start, length(found[i]) as n
from (select *, unnest(range(1, len(found) + 1)) as i from (
  select doc_id, string_split_regex(coalesce(text, ''), '{quoted}') as gaps,
    regexp_extract_all(coalesce(text, ''), '{quoted}', 0) as found from documents))
where length({value}) >= {least}"""


def _secrets_sql() -> str:
    from assay.llm.secrets import BASE

    found = " union all ".join(_pieces(*kind) for kind in BASE)
    counts = ", ".join(f"count(*) filter (where kind = '{k}') as n_{k}" for k, *_ in BASE)
    rank = "case kind " + " ".join(f"when '{k}' then {n}" for n, (k, *_) in enumerate(BASE)) + " end"
    return f"""
with found as ({found})
select doc_id, {counts}, sha256(coalesce(string_agg(
  kind || ':' || cast(start as varchar) || ':' || cast(start + n as varchar), ',' order by start, {rank}), '')) as base_sha256
from documents left join found using (doc_id) group by doc_id"""


@query("op9_secret_scans")
def secret_scans(spark, folder):
    from assay.llm.secrets import scan

    return scan(table(spark, folder, "documents"))


#: Without the linked spans, which SQL does not give; tests compare these columns.
SECRETS_BASE_SQL = _secrets_sql()


@query(
    "op10_exact_dedup",
    """
with rows as (
  select doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) as text_sha256
  from documents
)
select doc_id, max(doc_id) over g as keep_id, count(*) over g as group_size, doc_id = max(doc_id) over g as kept, text_sha256
from rows window g as (partition by text_sha256)
""",
)
def exact_dedup(spark, folder):
    from assay.llm.exact import dedupe

    return dedupe(table(spark, folder, "documents"))


_WORDS_SQL = """regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"""


@query(
    "op5_decontamination",
    f"""
with d as (select doc_id, {_WORDS_SQL.format("coalesce(text, '')")} as w from documents),
b as (select item_id, {_WORDS_SQL.format("coalesce(text, '')")} as w from benchmark),
items as (
  select item_id, least(13, len(w)) as n, unnest(range(1, len(w) - least(13, len(w)) + 2)) as i, w from b where len(w) > 0
), windows as (
  select distinct item_id, n, array_to_string(w[i:i + n - 1], ' ') as gram from items
), lengths as (select distinct n from windows),
grams as (
  select doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') as gram
  from (select doc_id, w, n, unnest(range(1, greatest(len(w) - n + 2, 1))) as i from d, lengths)
), hits as (select doc_id, i, g.n, item_id from grams g join windows using (n, gram)),
spots as (select distinct doc_id, unnest(range(i, i + n)) as at from (select distinct doc_id, i, n from hits)),
counted as (select doc_id, count(*) as n_hit from spots group by doc_id),
named as (
  select doc_id, count(*) as n_items, sha256(string_agg(id, ',' order by id)) as items_sha256
  from (select distinct doc_id, cast(item_id as varchar) as id from hits) group by doc_id
)
select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  coalesce(items_sha256, sha256('')) as items_sha256, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from d left join counted using (doc_id) left join named using (doc_id)
""",
)
def decontamination(spark, folder):
    from assay.llm.decontaminate import judge, search

    return judge(search(table(spark, folder, "documents"), table(spark, folder, "benchmark")))


SEQUENCE = 1024
END_ID = 2


@query("op8_best_fit_packing")
def best_fit_packing(spark, folder):
    import public_tokenizers

    from assay.llm.packing import added_tokens, pack_documents

    return pack_documents(
        table(spark, folder, "documents"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
        END_ID,
        SEQUENCE,
        added=added_tokens(public_tokenizers.path("byte_bpe_50k.json")),
    )


@query(
    "op7_ngram_jaccard_join",
    """
with recursive d as (
  select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[ \\t-\\r]+'), lambda x: x <> '') as w from documents
), shingles as (
  select distinct doc_id, md5(array_to_string(w[i:i + 4], ' ')) as g
  from (select doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as i from d where len(w) > 0)
), sizes as (select doc_id, count(*) as n from shingles group by doc_id),
pairs as (
  select a.doc_id as a, b.doc_id as b, count(*) as o from shingles a join shingles b on a.g = b.g and a.doc_id <> b.doc_id group by all
), links as (
  select p.a, p.b from pairs p join sizes x on x.doc_id = p.a join sizes y on y.doc_id = p.b where 100 * o >= 80 * (x.n + y.n - o)
), reach as (
  select doc_id as a, doc_id as b from d union select r.a, l.b from reach r join links l on l.a = r.b
)
select doc_id, coalesce(n, 0) as n_shingles, least(doc_id, coalesce(m, doc_id)) as component_id
from d left join sizes using (doc_id) left join (select a as doc_id, min(b) as m from reach group by a) using (doc_id)
""",
)
def ngram_jaccard_join(spark, folder):
    from assay.llm.jaccard import link_documents

    return link_documents(table(spark, folder, "documents"))


#: The chain's order: documents of low quality first, whose probability then helps to tell toxic ones.
CATEGORIES = ("low_quality", "toxic")


def graded(labels: DataFrame) -> DataFrame:
    """The given labels as 0/1 columns of the categories."""
    from pyspark.sql import functions as F

    return labels.select("doc_id", (1 - F.col("quality")).alias("low_quality"), "toxic")


@query("op3_toxicity")
def toxicity(spark, folder):
    from pyspark.sql import functions as F

    from assay.llm.toxicity import classify

    found = classify(table(spark, folder, "documents"), graded(table(spark, folder, "labels")), CATEGORIES)
    return found.select(
        "doc_id",
        *[F.round(F.col("probabilities")[i], 6).alias(f"p_{c}") for i, c in enumerate(CATEGORIES)],
        F.col("flags")[1].alias("toxic"),
    )


@query("op6_lm_scoring")
def lm_scoring(spark, folder):
    from assay.llm.ngrams import score_documents

    return score_documents(table(spark, folder, "documents"))


#: The columns of op6 that do not depend on the model; a test compares them.
LM_BASE_SQL = r"""
with bits as (
  select list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
    lambda a, b: xor(a >> 1, (a & 1) * 3988292384))) as step
), d as (
  select doc_id, xor(list_reduce(list_prepend(4294967295, list_transform(regexp_extract_all(hex(encode(cast(doc_id as varchar))), '..'),
      lambda h: cast('0x' || h as bigint))), lambda a, b: xor(a >> 8, step[(xor(a, b) & 255) + 1])), 4294967295) % 10 = 0 as held_out,
    list_append(list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[ \t-\r]+'), lambda x: x <> ''), ' ') as w
  from documents, bits
), tokens as (select doc_id, held_out, unnest(w) as t from d),
counts as (select t, count(*) as c from tokens where not held_out group by t),
total as (select coalesce(sum(c), 0) as n, count(*) as v from counts)
select doc_id, held_out, count(*) as n_tokens, count(c) as n_known, cast(n as bigint) as train_tokens,
  sum(log10((coalesce(c, 0) + 0.1) / (n + 0.1 * (v + 1)))) as base_score
from tokens left join counts using (t), total group by doc_id, held_out, n
"""


@query(
    "op4_suffix_array_dedup",
    """
with d as (select doc_id, hex(encode(coalesce(text, ''))) as h from documents),
-- Cut into blocks first, as places within long texts are slow to reach.
blocks as (select doc_id, base, substring(h, 2 * base + 1, 598) as h from (select *, unnest(range(0, len(h) // 2, 250)) as base from d)),
starts as (select doc_id, base, h, unnest(range(0, least(250, len(h) // 2 - 49))) as i from blocks where len(h) >= 100),
owned as (select doc_id, base + i as i, min(doc_id) over (partition by substring(h, 2 * i + 1, 100)) as owner from starts),
gone as (select doc_id, i, lag(i) over (partition by doc_id order by i) as before from owned where owner < doc_id),
runs as (
  select doc_id, min(i) as a, max(i) + 50 as b
  from (select *, count(*) filter (where before is null or i > before + 50) over (partition by doc_id order by i) as run from gone)
  group by doc_id, run
),
edges as (
  select doc_id, coalesce(lag(b) over (partition by doc_id order by a), 0) as kept_from, a as kept_to from runs
  union all select doc_id, max(b), null from runs group by doc_id
),
kept as (
  select doc_id, string_agg(substring(h, 2 * kept_from + 1, 2 * (coalesce(kept_to, len(h) // 2) - kept_from)), '' order by kept_from) as h
  from edges join d using (doc_id) group by doc_id
),
counts as (select doc_id, sum(b - a) as n_removed, count(*) as n_spans from runs group by doc_id)
select doc_id, len(d.h) // 2 as n_bytes, cast(coalesce(n_removed, 0) as bigint) as n_removed, coalesce(n_spans, 0) as n_spans,
  sha256(unhex(coalesce(kept.h, d.h))) as kept_sha256
from d left join counts using (doc_id) left join kept using (doc_id)
""",
)
def suffix_array_dedup(spark, folder):
    from assay.llm.suffixes import cut_repeats, digest

    return digest(cut_repeats(table(spark, folder, "documents")))


@query(
    "op11_fill_in_middle",
    r"""
with d as (
  select doc_id, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[ \t-\r]*[^ \t-\r]+|[ \t-\r]+') as u,
    sha256('42:' || coalesce(cast(doc_id as varchar), '')) as h
  from documents
), drawn as (
  select doc_id, t, u, len(u) as n, cast('0x' || h[1:8] as bigint) % (len(u) + 1) as a, cast('0x' || h[9:16] as bigint) % (len(u) + 1) as b,
    case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or cast('0x' || h[17:24] as bigint) % 100 >= 50
      then 'plain' when cast('0x' || h[25:32] as bigint) % 100 < 80 then 'spm' else 'psm' end as form
  from d
), parts as (
  select doc_id, t, n, form, array_to_string(u[1:least(a, b)], '') as p, array_to_string(u[least(a, b) + 1:greatest(a, b)], '') as m,
    array_to_string(u[greatest(a, b) + 1:], '') as s
  from drawn
)
select doc_id, n, form, case when form <> 'plain' then length(p) end as prefix_chars, case when form <> 'plain' then length(m) end as middle_chars,
  sha256(case form when 'plain' then t when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m
    else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256,
  sha256(t) as restored_sha256
from parts
""",
)
def fill_in_middle(spark, folder):
    from assay.llm.infill import fill_in_middle

    return fill_in_middle(table(spark, folder, "documents"))


def _merkle_sql(levels: int) -> str:
    """SQL for trees of up to 16^levels leaves a source and as many sources; one set of steps for each level."""

    def steps(x: str, p: str) -> str:
        """Reduce the nodes `x`0 level by level, and take the proof and the folded node of the rows `p`0 along."""
        made = []
        for k in range(levels):
            made.append(f"""
{x}{k}n as (select *, count(*) over (partition by tree) as n from {x}{k}),
{x}{k + 1} as (
  select tree, place // 16 as place, case when max(n) = 1 then max(d) else sha256(string_agg(d, '' order by place)) end as d
  from {x}{k}n group by tree, place // 16
), {x}{k}s as (
  select a.tree, a.place, a.n, coalesce(string_agg(b.d, '' order by b.place) filter (b.place < a.place), '') as l,
    coalesce(string_agg(b.d, '' order by b.place) filter (b.place > a.place), '') as r
  from {x}{k}n a join {x}{k}n b on a.tree = b.tree and a.place // 16 = b.place // 16 group by a.tree, a.place, a.n
), {p}{k + 1} as (
  select p.* replace (proof || l || r as proof, case when n = 1 then folded else sha256(l || folded || r) end as folded, p.place // 16 as place)
  from {p}{k} p join {x}{k}s s on p.tree = s.tree and p.place = s.place
)""")
        return ",".join(made)

    told = lambda c: f"coalesce(cast(octet_length(encode(cast({c} as varchar))) as varchar) || ':' || cast({c} as varchar), '-')"
    fields = ["doc_id", "source", "lang", "n_chars"]
    leaf = lambda text: "sha256(" + " || ".join(map(told, [*fields, text])) + ")"
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
with bits as (
  select list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
    lambda a, b: xor(a >> 1, (a & 1) * 3988292384))) as step
), docs as (
  select *, xor(list_reduce(list_prepend(4294967295, list_transform(regexp_extract_all(hex(encode(cast(doc_id as varchar))), '..'),
    lambda h: cast('0x' || h as bigint))), lambda a, b: xor(a >> 8, step[(xor(a, b) & 255) + 1])), 4294967295) as crc from documents, bits
), leaves as (
  select doc_id, {leaf("text")} as leaf, case when crc % 5 = 0 then {leaf(lower)} end as altered,
    dense_rank() over (order by source nulls first) - 1 as tree from docs
), p0 as (
  select *, row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 as place, tree as source, '' as proof,
    coalesce(altered, leaf) as folded from leaves
), x0 as (select tree, place, leaf as d from p0), {steps("x", "p")},
y0 as (select 0 as tree, tree as place, d from x{levels}),
q0 as (select * replace (0 as tree, source as place) from p{levels}), {steps("y", "q")}
select doc_id, leaf, x.d as subroot, y.d as root, sha256(proof) as proof_sha256, folded as folded_root, folded = y.d as verified
from q{levels} join x{levels} x on x.tree = source, y{levels} y
"""


@query("op12_merkle_manifest", _merkle_sql(4))
def merkle_manifest(spark, folder):
    from assay.llm.merkle import check_tampered

    return check_tampered(table(spark, folder, "documents"))


@query("op13_quality_classifier")
def quality_classifier(spark, folder, only=None):
    """All documents, or those whose keys the table `only` has; nothing is learned from held-out labels."""
    from pyspark.sql import functions as F

    from assay.llm.quality import classify

    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    rated = classify(docs if only is None else docs.join(only, "doc_id", "left_semi"), labels.where(~held_out))
    return rated.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", "predicted")
