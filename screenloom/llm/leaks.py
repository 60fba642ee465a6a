"""Evaluation passages in a corpus, found by template canonicalisation.

Every word of a text becomes a template code: numbers, units (words that follow numbers in the
evaluation set) and names (all words outside the evaluation set's own frame words) become typed
placeholders, frame words stay. A window of
``width`` consecutive codes has a template hash. Windows of the corpus whose template occurs in
the evaluation set are hash-joined with its windows on the template; the slots are then checked:
equal slots are a verbatim leak. The code of a word depends on the word only, so a verbatim window
always shares its template and none is lost.

Re-parameterised items (``reworded_passages``) are found on tokens: a run of names, of units or of
numbers is one slot, so that a name of two words meets one of one word and 3.5 meets 3. Slots may
be renamed one to one, and the renaming has to hold over all of the item, not only in a window.

Words are unbroken runs of ASCII letters, digits and underscores in lower case. They are cut and
hashed by array arithmetic on the raw bytes, without an object per word. Null texts and texts
with fewer than ``width`` words have no window. Repeated rows give the same pairs once. A text of
any length is worked off in segments that overlap by one window; positions go on over them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from screenloom.llm.filters import Filter, filter_of, member
from screenloom.session import cut

WIDTH = 13
#: Bytes worked on at once; bounds the memory of a task.
SEGMENT = 1 << 20
#: Words of a text that segments share where slots of several words are looked for.
OVERLAP = 64
#: Tokens of a window in which re-parameterised items are looked for.
TOKENS = 8
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_NUMBER, _UNIT, _NAME = np.uint64(11), np.uint64(12), np.uint64(13)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(97, 123), 95]] = True


def _mix(x: np.ndarray) -> np.ndarray:
    x = x.copy()
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    x ^= x >> np.uint64(33)
    return x


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, _BASE), np.full(n, _INVERSE)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


_CACHE: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers_of(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``_powers`` of at least ``n`` steps; the last sizes asked for are kept."""
    size = 1 << max(10, int(n).bit_length())
    if size not in _CACHE:
        if len(_CACHE) > 2:
            _CACHE.clear()
        _CACHE[size] = _powers(size)
    return _CACHE[size]


class Words:
    """The words of a byte string: where they are, their hashes and whether they are numbers.
    ``text`` is the string in lower case and ``sums`` its bytes' running hash, by which any part
    of it has the hash that it has as a word."""

    def __init__(self, data: bytes):
        raw = _LOWER[np.frombuffer(data, np.uint8)]
        self.text = raw
        inside = np.zeros(len(raw) + 2, np.int8)
        inside[1:-1] = _WORD[raw]
        edge = np.diff(inside)
        self.start, self.end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        up, self.down = powers_of(len(raw))
        self.sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(raw * up[: len(raw)], out=self.sums[1:])
        self.hash = _mix(self.part(self.start, self.end) + (self.end - self.start).astype(np.uint64))

    def part(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.down[start]

    @cached_property
    def number(self) -> np.ndarray:
        digits = np.zeros(len(self.text) + 1, np.int32)
        np.cumsum((self.text >= 48) & (self.text <= 57), out=digits[1:])
        return digits[self.end] - digits[self.start] == self.end - self.start


def word_hashes(words: list[str]) -> np.ndarray:
    return np.sort(Words(" ".join(words).encode()).hash) if words else np.empty(0, np.uint64)


def _rolling(codes: np.ndarray, width: int) -> np.ndarray:
    n = len(codes) - width + 1
    total = np.zeros(n, np.uint64)
    for k in range(width):
        total *= _BASE
        total += codes[k : k + n]
    return _mix(total)


def _renaming(hashes: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """Hash of where each word of a window occurred first in it: equal for windows that differ
    by a one-to-one renaming of words."""
    total = np.zeros(len(at), np.uint64)
    for k in range(width):
        first = np.full(len(at), k, np.uint64)
        for j in range(k - 1, -1, -1):
            first[hashes[at + j] == hashes[at + k]] = j
        total = total * _BASE + first + np.uint64(1)
    return _mix(total)


@dataclass(frozen=True)
class Templates:
    """The frame words and units of an evaluation set and the width of windows."""

    frame: tuple[str, ...]
    units: tuple[str, ...] = ()
    width: int = WIDTH


def segments(ids: list, texts: list, width: int) -> Iterator[tuple[list, list[int], bytes, list[int]]]:
    """Texts joined by blanks into byte strings of about SEGMENT: (ids, their offsets, bytes, the
    number of the text's words before each). A longer text is cut between words into segments that
    share ``width`` - 1 words."""
    some, offsets, parts, bases, total = [], [], [], [], 0
    for key, text in zip(ids, texts):
        if text is None:
            continue
        data, base = text.encode("utf-8", "surrogatepass"), 0
        while True:
            piece, data, words = (data, b"", 0) if len(data) <= SEGMENT else _cut(data, width)
            if total and total + len(piece) > SEGMENT:
                yield some, offsets, b" ".join(parts), bases
                some, offsets, parts, bases, total = [], [], [], [], 0
            some.append(key)
            offsets.append(total)
            parts.append(piece)
            bases.append(base)
            base += words
            total += len(piece) + 1
            if not data:
                break
    if some:
        yield some, offsets, b" ".join(parts), bases


def _cut(data: bytes, width: int) -> tuple[bytes, bytes, int]:
    """A first piece of at most about SEGMENT bytes that ends after a word, what follows from
    ``width`` - 1 words before its end, and the words before that."""
    size = SEGMENT
    while True:
        head = Words(data[: min(size, len(data))])
        if size >= len(data):
            return data, b"", 0
        if len(head.start) > width + 1:
            # The last word may go on behind the cut.
            return data[: head.end[-2]], data[head.start[-width] :], len(head.start) - width
        size *= 2


def _codes(w: Words, frame: np.ndarray, units: np.ndarray) -> np.ndarray:
    codes = np.where(member(w.hash, frame), w.hash, _NAME)
    codes[member(w.hash, units)] = _UNIT
    codes[w.number] = _NUMBER
    return codes


def _sequence(values: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """Hash of ``width`` values from each of ``at`` on."""
    whole = np.zeros(len(at), np.uint64)
    for k in range(width):
        whole = whole * _BASE + values[at + k]
    return _mix(whole)


def windows(df: DataFrame, key: str, text: str, templates: Templates, only: Filter | None = None) -> DataFrame:
    """The windows of ``text``: (key, position, template, slots).

    ``only``: the templates that are wanted; other windows are left out in the task that reads
    them. Positions count the words of the text.
    """
    shared = df.sparkSession.sparkContext.broadcast((word_hashes(list(templates.frame)), word_hashes(list(templates.units)), only))
    width, kind = templates.width, dict(df.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frame, units, keep = shared.value
        for batch in batches:
            ids = batch.column(0)
            for rows, offsets, data, bases in segments(list(range(len(ids))), batch.column(1).to_pylist(), width):
                w = Words(data)
                if len(w.start) < width:
                    continue
                owner = np.searchsorted(np.array(offsets), w.start, "right") - 1
                template = _rolling(_codes(w, frame, units), width)
                at = owner[: len(template)] == owner[width - 1 :]
                if keep is not None:
                    at &= keep.has(template)
                at = np.flatnonzero(at)
                if not len(at):
                    continue
                first = np.searchsorted(w.start, np.array(offsets))
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(np.array(rows)[owner[at]])),
                        pa.array(at - first[owner[at]] + np.array(bases)[owner[at]]),
                        pa.array(template[at].view(np.int64)),
                        pa.array(_sequence(w.hash, at, width).view(np.int64)),
                    ],
                    names=[key, "position", "template", "slots"],
                )

    return df.select(key, text).mapInArrow(run, f"`{key}` {kind}, position long, template long, slots long")


def token_windows(df: DataFrame, key: str, text: str, templates: Templates, only: Filter | None = None, tokens: int = TOKENS) -> DataFrame:
    """Windows of ``tokens`` tokens, runs of names, of units and of numbers being one token: (key,
    position, template, renaming, slots, token, slot). ``renaming`` says which tokens of the window
    are equal, ``token`` is the first one and ``slot`` whether it is a placeholder. Positions count
    the words of the text."""
    shared = df.sparkSession.sparkContext.broadcast((word_hashes(list(templates.frame)), word_hashes(list(templates.units)), only))
    kind = dict(df.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frame, units, keep = shared.value
        for batch in batches:
            ids = batch.column(0)
            for rows, offsets, data, bases in segments(list(range(len(ids))), batch.column(1).to_pylist(), OVERLAP):
                w = Words(data)
                if len(w.start) < tokens:
                    continue
                owner, codes = np.searchsorted(np.array(offsets), w.start, "right") - 1, _codes(w, frame, units)
                held = (codes == _NAME) | (codes == _UNIT) | (codes == _NUMBER)
                start = np.flatnonzero(np.r_[True, ~held[1:] | (codes[1:] != codes[:-1]) | (owner[1:] != owner[:-1])])
                # The words of a run, mixed in their order.
                place = np.arange(len(codes)) - np.repeat(start, np.diff(np.r_[start, len(codes)]))
                token = _mix(np.add.reduceat(w.hash * (np.uint64(2) * place.astype(np.uint64) + np.uint64(1)), start))
                if len(start) < tokens:
                    continue
                template, mine = _rolling(codes[start], tokens), owner[start]
                at = mine[: len(template)] == mine[tokens - 1 :]
                if keep is not None:
                    at &= keep.has(template)
                at = np.flatnonzero(at)
                if not len(at):
                    continue
                first, of = np.searchsorted(w.start, np.array(offsets)), mine[at]
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(np.array(rows)[of])),
                        pa.array(start[at] - first[of] + np.array(bases)[of]),
                        pa.array(template[at].view(np.int64)),
                        pa.array(_renaming(token, at, tokens).view(np.int64)),
                        pa.array(_sequence(token, at, tokens).view(np.int64)),
                        pa.array(token[at].view(np.int64)),
                        pa.array(held[start[at]]),
                    ],
                    names=[key, "position", "template", "renaming", "slots", "token", "slot"],
                )

    return df.select(key, text).mapInArrow(run, f"`{key}` {kind}, position long, template long, renaming long, slots long, token long, slot boolean")


def frame_words(items: DataFrame, text: str, share: float = 0.05, least: int = 3) -> Templates:
    """The frame words of an evaluation set, words of at least ``share`` of its texts (and
    ``least`` of them), and its units, other words that follow a number in as many. All others name
    things and are slots. There are at most (words per text) / share words of either kind, however
    large the set."""
    words = F.transform(F.regexp_extract_all(F.col(text), F.lit("[A-Za-z0-9_]+"), 0), F.lower)
    rows = items.where(F.col(text).isNotNull()).select(words.alias("w"))
    total = rows.agg(F.count(F.lit(1))).scalar()
    after = F.filter(F.arrays_zip(F.slice("w", 2, F.greatest(F.size("w"), F.lit(1))).alias("b"), F.col("w").alias("a")), lambda p: p.a.rlike("^[0-9]+$"))

    def common(found):
        each = rows.select(F.explode(F.array_distinct(found)).alias("word")).where(~F.col("word").rlike("^[0-9]+$"))
        each = each.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where((F.col("n") >= least) & (F.col("n") >= share * total))
        return {r.word for r in each.select("word").collect()}

    frame = common(F.col("w"))
    units = common(F.filter(F.transform(after, lambda p: p.b), lambda b: b.isNotNull())) - frame
    return Templates(tuple(sorted(frame)), tuple(sorted(units)))


def leaked_passages(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(doc_id, item_id): the document has at least ``WIDTH`` consecutive words of the item.

    Template and slots are both join keys, so a template that thousands of documents share costs
    no more than its verbatim matches.
    """
    templates = frame_words(items, text)
    # One row a word of the evaluation set, written since the filter comes from it too.
    of_items = cut(windows(items, item_id, text, templates), "items")
    only = filter_of(of_items.select("template").distinct())
    found = windows(docs, doc_id, text, templates, only).select(doc_id, "template", "slots").distinct()
    of_items = of_items.select(item_id, "template", "slots").distinct()
    return found.join(of_items, ["template", "slots"]).select(doc_id, item_id).distinct()


def reworded_passages(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text",
    share: float = 0.5, least: int = 4, band: int = 16,
) -> DataFrame:
    """(doc_id, item_id, n_windows, n_renamed, share): the document follows the item's template
    over ``share`` of its windows and ``least`` of them, its slots kept or renamed one to one.
    Windows count where document position less item position is within ``band`` words of the
    pair's most common one, so that a word more or less in a slot or a short insertion does no
    harm. ``n_renamed`` counts windows whose slots differ from the item's; zero is a verbatim copy.

    A pair that reaches ``share`` must have one of the item's rarest windows (those found in
    fewest items; as many as may be missed and one more). Only these pair documents with items:
    a line that all items share pairs nothing, and is counted for the pairs there are.
    """
    templates = frame_words(items, text)
    of_items = token_windows(items, item_id, text, templates).withColumnsRenamed({"position": "q", "slots": "item_slots", "token": "item_token"})
    of_items = cut(of_items.dropDuplicates([item_id, "q"]), "items")
    only = filter_of(of_items.select("template").distinct())
    found = token_windows(docs, doc_id, text, templates, only).withColumnRenamed("position", "p")
    found = cut(found.dropDuplicates([doc_id, "p"]), "found")
    key = ["template", "renaming"]
    in_items = of_items.groupBy(*key).agg(F.count_distinct(item_id).alias("n_items"))
    total = of_items.groupBy(item_id).agg(F.count(F.lit(1)).alias("n_item"))
    rarest = Window.partitionBy(item_id).orderBy("n_items", "q")
    prefix = of_items.join(in_items, key).join(total, item_id).withColumn("r", F.row_number().over(rarest))
    prefix = prefix.where(F.col("r") <= F.col("n_item") - F.ceil(share * F.col("n_item")) + 1).select(item_id, *key).distinct()
    candidates = found.select(doc_id, *key).distinct().join(prefix, key).select(doc_id, item_id).distinct()
    pairs = candidates.join(found, doc_id).join(of_items.drop("slot"), [item_id, *key])
    pair = [doc_id, item_id]
    shift = F.col("p") - F.col("q")
    near = Window.partitionBy(*pair).orderBy("shift").rangeBetween(-band, band)
    shifts = pairs.groupBy(*pair, shift.alias("shift")).agg(F.count(F.lit(1)).alias("n"))
    best = shifts.withColumn("n", F.sum("n").over(near)).groupBy(*pair).agg(F.max_by("shift", F.struct("n", -F.col("shift"))).alias("best"))
    pairs = pairs.join(best, pair).where(F.abs(shift - F.col("best")) <= band)
    # The renaming of the whole item: for each of its slots the token that most windows give it,
    # and the other way round.
    votes = pairs.where("slot").groupBy(*pair, "item_token", "token").agg(F.count(F.lit(1)).alias("n"))
    first = lambda one, other: F.row_number().over(Window.partitionBy(*pair, one).orderBy(F.col("n").desc(), other))
    agreed = votes.withColumn("a", first("item_token", "token")).withColumn("b", first("token", "item_token")).where("a = 1 AND b = 1")
    pairs = pairs.join(agreed.select(*pair, "item_token", "token", F.lit(True).alias("agreed")), [*pair, "item_token", "token"], "left")
    kept = pairs.where("agreed OR NOT slot").groupBy(*pair, "q").agg(F.max(F.col("slots") == F.col("item_slots")).alias("same"))
    counted = kept.groupBy(*pair).agg(F.count(F.lit(1)).alias("n_windows"), F.sum((~F.col("same")).cast("int")).alias("n_renamed"))
    out = counted.join(total, item_id).withColumn("share", F.col("n_windows") / F.col("n_item"))
    return out.where((F.col("n_windows") >= F.least(F.lit(least), F.col("n_item"))) & (F.col("share") >= share)).select(*pair, "n_windows", "n_renamed", "share")
