"""Several values packed in one text field: a quote-aware finite-state tokenizer.

The tokenizer walks the text once. Its state is the open quote, the nesting depth, whether the
last character was an escape, and whether blanks are pending. A delimiter outside quotes ends
the current place; what brackets and quotes mean is set by ``Dialect``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Dialect:
    """How values are packed.

    ``quoted_delimiters`` are delimiters that also separate inside quotes (quotes around a whole
    list); the other delimiters inside quotes are content, and those in ``grouping`` are left
    out of it (``"1,234"`` is 1234). With ``nested_opaque`` delimiters inside brackets are
    content too and the brackets stay; otherwise brackets are no content. ``blank`` separates
    only between two values, once for a run. ``marks`` are texts that stay whole although they
    hold a delimiter.
    """

    delimiters: str = "|;,/:\t"
    blank: str = " "
    quotes: str = "\"'"
    brackets: str = "[]"
    escape: str = "\\"
    grouping: str = ","
    quoted_delimiters: str = "|;/:\t "
    nested_opaque: bool = False
    marks: tuple[str, ...] = ("n/a",)


def tokenize(text: str, d: Dialect = Dialect()) -> list[str]:
    """The places of ``text`` in order, empty ones included; one empty place for a blank text."""
    opening, closing = d.brackets[::2], d.brackets[1::2]
    places: list[str] = []
    value: list[str] = []
    quote, depth, pending, escaped, delimited = "", 0, False, False, True
    # delimited: the text's start or a delimiter is all that precedes the next content.
    i, n = 0, len(text)
    while i < n:
        c = text[i]
        i += 1
        if escaped:
            escaped = False
        elif c == d.escape and c:
            escaped = True
            continue
        elif quote:
            if c == quote:
                quote = ""
                continue
            if c in d.quoted_delimiters and not (d.nested_opaque and depth):
                if c == d.blank:
                    pending = True
                    continue
                places.append("".join(value))
                value, pending, delimited = [], False, True
                continue
            if c in d.grouping:
                continue
        else:
            if c in d.quotes:
                if pending and not delimited:
                    places.append("".join(value))
                    value = []
                quote, pending, delimited = c, False, False
                continue
            if c in opening or c in closing:
                depth = depth + 1 if c in opening else max(0, depth - 1)
                if not d.nested_opaque:
                    continue
            elif not (d.nested_opaque and depth):
                if c == d.blank:
                    pending = True
                    continue
                if c in d.delimiters:
                    places.append("".join(value))
                    value, pending, delimited = [], False, True
                    continue
        if pending and not delimited:
            places.append("".join(value))
            value = []
        pending = False
        if delimited or not value:
            for mark in d.marks:
                if text[i - 1 : i - 1 + len(mark)].lower() == mark and not text[i - 1 + len(mark) : i + len(mark)].isalnum():
                    c = text[i - 1 : i - 1 + len(mark)]
                    i += len(mark) - 1
                    break
        value.append(c)
        delimited = False
    places.append("".join(value))
    return places


#: Texts whose places a task remembers.
REPEATED = 50_000


def free_name(name: str, taken: list[str]) -> str:
    """``name``, or ``name_input`` and so on where an input column has it."""
    while name.lower() in {t.lower() for t in taken}:
        name += "_input"
    return name


def split_packed(
    df: DataFrame,
    column: str,
    dialect: Dialect = Dialect(),
    position: str = "position",
    value: str = "value",
    count: str = "n_places",
) -> DataFrame:
    """One row per place of ``column`` with its position (from 1), its text and the number of
    places, in place of the column; the input's other columns are kept.

    A null field gives no row; an empty or blank one gives one empty place. Repeated rows come
    out repeated. An input column that has the name of a new one is kept as ``<name>_input``.
    The walk is linear in the text's length and holds one field at a time; rows stay in their
    partition, so nothing is shuffled, and leave in batches of bounded size.
    """
    made = {position.lower(), value.lower(), count.lower()}
    renamed = [free_name(f"{f.name}_input", df.columns) if f.name.lower() in made else f.name for f in df.schema]
    source = renamed[df.columns.index(column)]
    df = df.toDF(*renamed)
    fields = [f for f in df.schema.fields if f.name != source]
    schema = T.StructType(
        [*fields, T.StructField(position, T.IntegerType()), T.StructField(value, T.StringType()), T.StructField(count, T.IntegerType())]
    )

    special = dialect.delimiters + dialect.blank + dialect.quotes + dialect.brackets + dialect.escape
    # A text of letters and digits is one place where those mean nothing to the dialect.
    plain = not any(c.isalnum() for c in special) and not any(m.isalnum() for m in dialect.marks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, list[str]] = {}
        for batch in batches:
            rest = pa.Table.from_batches([batch]).drop_columns([source])
            size = _batch_rows(rest)
            rows, at, texts, counts = [], [], [], []

            def leave(k: int) -> pa.RecordBatch:
                kept = rest.take(pa.array(rows[:k], pa.int64())).combine_chunks()
                new = [pa.array(at[:k], pa.int32()), pa.array(texts[:k], pa.string()), pa.array(counts[:k], pa.int32())]
                for made in (rows, at, texts, counts):
                    del made[:k]
                return pa.RecordBatch.from_arrays([*[c.chunk(0) if c.num_chunks else c.combine_chunks() for c in kept.columns], *new], names=schema.names)

            for i, text in enumerate(batch.column(source).to_pylist()):
                if text is not None:
                    places = [text] if plain and text.isalnum() else known.get(text)
                    if places is None:
                        places = tokenize(text, dialect)
                        # Short texts repeat; some are kept.
                        if len(text) <= 32 and len(known) < REPEATED:
                            known[text] = places
                    rows += [i] * len(places)
                    at += range(1, len(places) + 1)
                    texts += places
                    counts += [len(places)] * len(places)
                    while len(rows) >= size:
                        yield leave(size)
            if rows:
                yield leave(len(rows))

    return df.where(F.col(source).isNotNull()).mapInArrow(run, schema)


def _batch_rows(table: pa.Table) -> int:
    """Rows of a batch of some 64 MB if all were as long as the longest."""
    longest = 64
    for c in table.columns:
        text = pa.types.is_string(c.type) or pa.types.is_binary(c.type)
        longest += (pc.max(pc.binary_length(c)).as_py() or 0) if text else 16 if c.type.num_fields == 0 else c.nbytes
    return max(1, min(10_000, (64 << 20) // longest))


def whole_number(column: Column | str) -> Column:
    """The whole number that a place means (``485`` and ``485.0``), or null."""
    column = F.col(column) if isinstance(column, str) else column
    digits = F.regexp_extract(column, r"^\s*(\d+)(?:\.0*)?\s*$", 1)
    return F.when(digits != "", digits.try_cast("bigint"))
