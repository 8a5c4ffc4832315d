"""Chat logs as events: folding them into final messages, and a template that can be read back.

An event is (conv_id, seq, message, turn, role, kind, text). Kinds:

* `start` opens a message, `delta` adds streamed text to it,
* `edit` replaces its text, `regenerate` empties it for new deltas and discards every later message
  that had begun before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, BETWEEN, CLOSE = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
CONTROL, ESCAPE = "<|", "\\"
CHUNK = 256
MAX_CHUNKS = 1 << 24


def escape(text: Column) -> Column:
    """No `<|` is left in the result, and `unescape` gives the text back."""
    doubled = F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE * 2))
    return F.replace(doubled, F.lit(CONTROL), F.lit("<" + ESCAPE + "|"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def as_events(rows: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Rows (conv_id, turn, role, text) as the events of a stream: a start and a delta per `chunk` characters."""
    pieces = F.regexp_extract_all(F.coalesce(F.col("text").cast("string"), F.lit("")), F.lit(f"(?s).{{1,{chunk}}}"), F.lit(0))
    start = F.array(F.struct(F.lit("start").alias("kind"), F.lit("").alias("text")))
    deltas = F.transform(pieces, lambda p: F.struct(F.lit("delta").alias("kind"), p.alias("text")))
    return (
        rows.select(
            "conv_id",
            F.monotonically_increasing_id().alias("message"),
            F.col("turn").cast("long").alias("turn"),
            F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
            F.concat(start, deltas).alias("events"),
        )
        .select("conv_id", "message", "turn", "role", F.posexplode("events").alias("at", "event"))
        .select(
            "conv_id",
            (F.coalesce("turn", F.lit(-1)) * MAX_CHUNKS + F.col("at")).alias("seq"),
            "message",
            "turn",
            "role",
            "event.kind",
            "event.text",
        )
    )


def fold(events: DataFrame) -> DataFrame:
    """Final messages (conv_id, turn, first, message, role, text) of event logs.

    Events are first folded per message, so deltas meet in small groups, and only finished messages
    are then ordered by conversation. Order within a conversation is turn (null first), first
    sequence number, message. Null texts add nothing; null kinds count as deltas.
    """
    kind = F.coalesce("kind", F.lit("delta"))
    resets = kind.isin("edit", "regenerate")
    messages = events.groupBy("conv_id", "message").agg(
        F.min("turn").alias("turn"),
        F.min("seq").alias("first"),
        F.min_by("role", "seq").alias("role"),
        F.coalesce(F.max(F.when(resets, F.col("seq"))), F.min("seq")).alias("reset"),
        F.max(F.when(kind == "regenerate", F.col("seq"))).alias("regenerated"),
        F.collect_list(F.struct("seq", F.coalesce("text", F.lit("")).alias("text"))).alias("parts"),
    )
    live = F.filter(F.array_sort("parts"), lambda p: p["seq"] >= F.col("reset"))
    before = Window.partitionBy("conv_id").orderBy("turn", "first", "message").rowsBetween(Window.unboundedPreceding, -1)
    return (
        messages.withColumn("text", F.array_join(F.transform(live, lambda p: p["text"]), ""))
        .withColumn("cut", F.max("regenerated").over(before))
        .where("cut is null or first >= cut")
        .select("conv_id", "turn", "first", "message", F.coalesce("role", F.lit("")).alias("role"), "text")
    )


def render(messages: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """(conv_id, formatted, loss): each conversation in the template, with the spans the loss covers.

    Spans are (start, length) in code points of `formatted` and cover the escaped texts of `loss_role`.
    A conversation becomes one string, so it must fit in a row; conversations are never grouped further.
    """
    before = Window.partitionBy("conv_id").orderBy("turn", "first", "message").rowsBetween(Window.unboundedPreceding, -1)
    head = F.concat(F.lit(OPEN), escape(F.col("role")), F.lit(BETWEEN))
    piece = F.concat("head", "body", F.lit(CLOSE))
    placed = (
        messages.select("*", head.alias("head"), escape(F.col("text")).alias("body"))
        .withColumn("offset", F.coalesce(F.sum(F.char_length(piece)).over(before), F.lit(0)))
        .select(
            "conv_id",
            F.struct(
                "offset",
                piece.alias("piece"),
                F.when(
                    F.col("role") == loss_role,
                    F.struct(
                        (F.col("offset") + F.char_length("head")).cast("int").alias("start"),
                        F.char_length("body").alias("length"),
                    ),
                ).alias("loss"),
            ).alias("turn"),
        )
    )
    return (
        placed.groupBy("conv_id")
        .agg(F.array_sort(F.collect_list("turn")).alias("turns"))
        .select(
            "conv_id",
            F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("formatted"),
            F.filter(F.transform("turns", lambda t: t["loss"]), lambda s: s.isNotNull()).alias("loss"),
        )
    )


def read_back(rendered: DataFrame) -> DataFrame:
    """(conv_id, formatted, turns, loss_texts): roles and texts as the template's reader finds them."""

    def turn(piece):
        return F.struct(
            unescape(F.substring_index(F.substr(piece, F.lit(len(OPEN) + 1)), BETWEEN, 1)).alias("role"),
            unescape(F.substring_index(piece, BETWEEN, -1)).alias("text"),
        )

    pieces = F.split("formatted", CLOSE.replace("|", r"\|"), -1)
    return rendered.select(
        "conv_id",
        "formatted",
        F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), turn).alias("turns"),
        F.transform(
            "loss", lambda s: unescape(F.substr(F.col("formatted"), s["start"] + 1, s["length"]))
        ).alias("loss_texts"),
    )


def digest(read: DataFrame) -> DataFrame:
    """Counts and digests of what was read back."""
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("loss_texts", "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(whole, 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


def format_chats(rows: DataFrame) -> DataFrame:
    """Conversation rows (conv_id, turn, role, text) through events, folding, template and reader.

    Null roles and texts count as empty, null turns come first, and rows with a null conv_id form one
    conversation. Rows that repeat are turns of their own. Rows that tie in turn keep the order in which
    they were read. Extra columns are not read. No rows give no rows.
    """
    return digest(read_back(render(fold(as_events(rows)))))
