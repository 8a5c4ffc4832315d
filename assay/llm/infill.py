"""Fill-in-the-middle documents, put together by a secondary sort of text pieces.

Texts are cut into prefix, middle and suffix at unit borders, a unit being a word with the white space
before it. The cutting task emits pieces of whole units with their place in the output; one shuffle by
document and one sort by (document, place) put the pieces of an output side by side, where they stream
into a digest piece by piece. A second sort of the same partitions puts them back into the order of the
text. `repartition` with `sortWithinPartitions` is the DataFrame form of
``repartitionAndSortWithinPartitions``; the second sort needs no shuffle, as tasks keep their documents.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from assay.llm.common import parts_for, single_rows

PIECE_BYTES = 8 << 10
PARTITION_BYTES = 16 << 20
BATCH_ROWS = 1_000
SEED = 42
FIM_PERCENT, SPM_PERCENT = 50, 80

# The control strings, and the sections of each form's output in order.
SENTINELS = {"prefix": b"<P>", "suffix": b"<S>", "middle": b"<M>"}
FORMS = {"psm": ("prefix", "suffix", "middle"), "spm": ("suffix", "prefix", "middle")}
#: The order of the sections in the text.
SECTIONS = ("prefix", "middle", "suffix")

_MARK = re.compile(b"|".join(SENTINELS.values()))
_SECTION = {mark: SECTIONS.index(name) for name, mark in SENTINELS.items()}
_LONGEST = max(map(len, SENTINELS.values()))
_GAP = np.isin(np.arange(256), list(b" \t\n\v\f\r"))


def unit_ends(text: bytes) -> np.ndarray:
    """The end of each unit in bytes; white space at the end of the text is a unit of its own."""
    word = np.zeros(len(text) + 1, bool)
    word[:-1] = ~_GAP[np.frombuffer(text, np.uint8)]
    ends = np.flatnonzero(word[:-1] & ~word[1:]) + 1
    return ends if not text or word[len(text) - 1] else np.append(ends, len(text))


def n_chars(text: bytes) -> int:
    return int(np.count_nonzero(np.frombuffer(text, np.uint8) & 0xC0 != 0x80))


def draw(key, seed: int) -> list[int]:
    """Four 32-bit integers that only the key and the seed decide; a null key counts as empty."""
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).digest()
    return [int.from_bytes(digest[i : i + 4], "big") for i in range(0, 16, 4)]


def choose(key, text: bytes, units: int, seed: int, fim: int, spm: int) -> tuple[str, int, int]:
    """Form, and the numbers of units before the middle and before the suffix."""
    first, second, formed, ordered = draw(key, seed)
    low, high = sorted((first % (units + 1), second % (units + 1)))
    if not text or formed % 100 >= fim or _MARK.search(text):
        return "plain", low, high
    return "spm" if ordered % 100 < spm else "psm", low, high


def unit_chunks(ends: np.ndarray, start: int, stop: int, size: int) -> Iterator[tuple[int, int]]:
    """Ranges of whole units of at most `size` bytes; a longer unit is cut."""
    while start < stop:
        at = int(np.searchsorted(ends, start + size, "right"))
        cut = min(stop, int(ends[at - 1]) if at and ends[at - 1] > start else start + size)
        yield start, cut
        start = cut


def _pieces(key, text: bytes, seed: int, fim: int, spm: int, size: int):
    """What is told once for a document, and its output in pieces."""
    ends = unit_ends(text)
    form, low, high = choose(key, text, len(ends), seed, fim, spm)
    if form == "plain":
        return (len(ends), form, None, None), [text[a:b] for a, b in unit_chunks(ends, 0, len(text), size)] or [b""]
    borders = [0, *(int(ends[n - 1]) if n else 0 for n in (low, high)), len(text)]
    spans = {name: (borders[i], borders[i + 1]) for i, name in enumerate(SECTIONS)}
    out = []
    for name in FORMS[form]:
        chunks = [text[a:b] for a, b in unit_chunks(ends, *spans[name], size)] or [b""]
        out += [SENTINELS[name] + chunks[0], *chunks[1:]]
    return (len(ends), form, *(n_chars(text[slice(*spans[name])]) for name in SECTIONS[:2])), out


def _few_rows(source: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows of bounded size, some at a time as Python objects."""
    for batch in source:
        for start in range(0, batch.num_rows, BATCH_ROWS):
            yield from batch.slice(start, BATCH_ROWS).to_pylist()


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == BATCH_ROWS:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


_HEAD = "n bigint, form string, prefix_chars bigint, middle_chars bigint"
_HEAD_ARROW = [("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64())]


def output_pieces(
    df: DataFrame, key: str = "doc_id", text: str = "text", seed: int = SEED, fim: int = FIM_PERCENT, spm: int = SPM_PERCENT, size: int = PIECE_BYTES
) -> DataFrame:
    """(row, place, data, key, n, form, prefix_chars, middle_chars), sorted by row and place within partitions.

    The data of a row's places, one after another, is the output of that input row. The other columns
    are set at place 0 only. A null text counts as empty, a null key as one more key; repeated rows are
    rows of their own; other columns are not read. All pieces of a row lie in one partition.
    """
    docs = df.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(key).alias("key"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("text"),
    )
    kind = docs.schema["key"].dataType
    schema = pa.schema([("row", pa.int64()), ("place", pa.int32()), ("data", pa.binary()), ("key", to_arrow_type(kind)), *_HEAD_ARROW])

    def run(source):
        def rows():
            for doc in single_rows(source):
                head, data = _pieces(doc["key"], doc["text"], seed, fim, spm, size)
                yield doc["row"], 0, data[0], doc["key"], *head
                for place in range(1, len(data)):
                    yield doc["row"], place, data[place], None, None, None, None, None

        return _batches(rows(), schema)

    parts = parts_for(docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0, each=PARTITION_BYTES)
    made = docs.mapInArrow(run, f"row bigint, place int, data binary, key {kind.simpleString()}, {_HEAD}")
    return made.repartition(parts, "row").sortWithinPartitions("row", "place")


class Restorer:
    """Takes an output piece by piece and tells which section of the text each part belongs to.

    A text with a control string is left plain, so the control strings found are those put in. One that
    is split over two pieces is found too, because the last bytes are held back.
    """

    def __init__(self, form: str):
        self.plain, self.section, self.held = form == "plain", 0, b""

    def feed(self, data: bytes, last: bool = False) -> Iterator[tuple[int, bytes]]:
        if self.plain:
            yield 0, data
            return
        data, start = self.held + data, 0
        for mark in _MARK.finditer(data):
            if mark.start() > start:
                yield self.section, data[start : mark.start()]
            self.section, start = _SECTION[mark.group()], mark.end()
        stop = len(data) if last else max(start, len(data) - _LONGEST + 1)
        self.held = data[stop:]
        if stop > start:
            yield self.section, data[start:stop]


def restore(pieces: DataFrame) -> DataFrame:
    """(row, section, place, data, key, n, form, prefix_chars, middle_chars, output_sha256), sorted by row, section, place.

    `pieces` are those of `output_pieces` in their order. Section -1 has the columns told once and no
    data; the data of the others, one after another, is the text, read back from output and form alone.
    """
    kind = pieces.schema["key"].dataType
    schema = pa.schema(
        [("row", pa.int64()), ("section", pa.int32()), ("place", pa.int32()), ("data", pa.binary()), ("key", to_arrow_type(kind))]
        + [*_HEAD_ARROW, ("output_sha256", pa.string())]
    )
    bare = (None,) * 6

    def run(source):
        def rows():
            head = digest = reader = None
            number = 0

            def ended():
                for number_, (section, data) in enumerate(reader.feed(b"", last=True), number):
                    yield head["row"], section, number_, data, *bare
                yield head["row"], -1, 0, None, head["key"], *(head[name] for name, _ in _HEAD_ARROW), digest.hexdigest()

            for piece in _few_rows(source):
                if piece["place"] == 0:
                    if head:
                        yield from ended()
                    head, digest, reader, number = piece, hashlib.sha256(), Restorer(piece["form"]), 0
                digest.update(piece["data"])
                for section, data in reader.feed(piece["data"]):
                    yield piece["row"], section, number, data, *bare
                    number += 1
            if head:
                yield from ended()

        return _batches(rows(), schema)

    made = pieces.mapInArrow(
        run, f"row bigint, section int, place int, data binary, key {kind.simpleString()}, {_HEAD}, output_sha256 string"
    )
    return made.sortWithinPartitions("row", "section", "place")


def output_texts(pieces: DataFrame) -> DataFrame:
    """(key, form, output): the documents to train on, one row each, from `output_pieces` in their order."""
    kind = pieces.schema["key"].dataType
    schema = pa.schema([("key", to_arrow_type(kind)), ("form", pa.string()), ("output", pa.string())])

    def run(source):
        def rows():
            head, data = None, []
            for piece in _few_rows(source):
                if piece["place"] == 0:
                    if head:
                        yield head["key"], head["form"], b"".join(data).decode()
                    head, data = piece, []
                data.append(piece["data"])
            if head:
                yield head["key"], head["form"], b"".join(data).decode()

        return _batches(rows(), schema)

    return pieces.mapInArrow(run, f"key {kind.simpleString()}, form string, output string")


def fill_in_middle(
    df: DataFrame, key: str = "doc_id", text: str = "text", seed: int = SEED, fim: int = FIM_PERCENT, spm: int = SPM_PERCENT, size: int = PIECE_BYTES
) -> DataFrame:
    """One row per input row: key, n (units), form, prefix_chars, middle_chars, output_sha256, restored_sha256.

    Form is plain for an empty text, one that has a control string, and the share of documents that are
    left as they are; lengths are then null. Null texts count as empty; null keys draw as an empty one;
    repeated rows give a row each; an empty table gives an empty result. A text of any length streams
    through in pieces after the task that cuts it, and no task holds more than one partition's pieces,
    which Spark sorts and spills.
    """
    restored = restore(output_pieces(df, key, text, seed, fim, spm, size))
    kind = restored.schema["key"].dataType
    schema = pa.schema([("key", to_arrow_type(kind)), *_HEAD_ARROW, ("output_sha256", pa.string()), ("restored_sha256", pa.string())])

    def run(source):
        def rows():
            head = digest = None
            for piece in _few_rows(source):
                if piece["section"] < 0:
                    if head:
                        yield *head, digest.hexdigest()
                    head, digest = tuple(piece[name] for name in schema.names[:-1]), hashlib.sha256()
                else:
                    digest.update(piece["data"])
            if head:
                yield *head, digest.hexdigest()

        return _batches(rows(), schema)

    made = restored.mapInArrow(run, f"key {kind.simpleString()}, {_HEAD}, output_sha256 string, restored_sha256 string")
    return made.withColumnRenamed("key", key)
