"""Subject areas of documents by seeded non-negative factorisation.

The document-term matrix is factored into document mixtures and component-term rates by
alternating multiplicative updates of the Kullback-Leibler objective. Each subject is one
component, anchored by its example words; one more component takes the words of no subject.
After each update a term stays with the subjects only if its rate is concentrated on one or two
of them: words that occur alike in all subjects, such as those of programming, go to the common
component. A document's mixture is then the expected number of its words per subject.

Terms are the parts of identifiers and words (split at case changes, digits and underscores), in
lower case and singular. Before they are cut, passages that point to no subject are blanked:
sentences found in ``boilerplate_share`` of all different texts (licence headers and texts; of
ten texts at the least) and passages of
given other texts (evaluation items), the latter by windows of ``PHRASE`` words.

Null and empty texts have no subject. Repeated rows count as documents of their own. Terms in
fewer than ``min_docs`` documents cannot be placed and are no evidence.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from screenloom.llm.files import batches_of
from screenloom.llm.filters import member
from screenloom.llm.leaks import Words, _mix, _rolling, powers_of, segments
from screenloom.session import cut, release, scratch_path

PHRASE = 6
#: Windows of the passages to blank, at most (8 bytes each in every task).
MOST_PHRASES = 20_000_000
#: Up to so many terms the component rates are handed to the tasks; of more, each block of
#: documents gets the rates of its own terms.
BROADCAST_TERMS = 200_000
#: Entries of the matrix in such a block, about.
BLOCK_ENTRIES = 5_000_000
ROUNDS, INNER, FINAL = 30, 3, 8
#: Rounds end when no component's total changes by more than this share.
STILL = 0.01
#: Entries of the matrix worked on at once in a task.
ENTRIES = 250_000
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True


def _fold(w: Words, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the terms at ``start:end`` of a text, in lower case and singular."""
    n, low = end - start, w.text
    at = lambda k: np.where(n > k, low[np.maximum(end - 1 - k, 0)], 0)
    s, e, i, u, h, x = (ord(ch) for ch in "seiuhx")
    # Few terms end in an s; the others need no more letters.
    some = np.flatnonzero((n > 3) & (at(0) == s))
    whole, n, end = n, n[some], end[some]
    a, b, c = s, at(1), at(2)
    ies = (n > 4) & (b == e) & (c == i)
    xes = (n > 4) & (b == e) & ((c == x) | (c == a) & (at(3) == a) | (c == h) & (at(3) == a))
    one = ~ies & ~xes & (b != s) & (b != u) & (b != i)
    n, y = whole.copy(), np.zeros(len(whole), bool)
    n[some] -= np.where(ies, 3, np.where(xes, 2, np.where(one, 1, 0)))
    y[some] = ies
    out = w.part(start, start + n)
    up, _ = powers_of(len(low))
    out[y] += np.uint64(ord("y")) * up[n[y]]
    return _mix(out + (n + y).astype(np.uint64))


def _terms(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the terms of a text are."""
    letter, upper = _LETTER[raw], (raw >= 65) & (raw < 91)
    before = np.r_[False, letter[:-1]]
    after_low = np.r_[False, letter[:-1] & ~upper[:-1]]
    next_low = np.r_[letter[1:] & ~upper[1:], False]
    first = letter & (~before | upper & (after_low | next_low))
    start = np.flatnonzero(first)
    stop = np.r_[start[1:], len(raw)]
    last = np.flatnonzero(letter & ~np.r_[letter[1:], False]) + 1
    return start, np.minimum(stop, last[np.searchsorted(last, start, "right")]) if len(start) else stop[:0]


def term_hash(words: list[str]) -> np.ndarray:
    """The hashes of single words."""
    return np.array([_fold(Words(w.encode()), np.array([0]), np.array([len(w.encode())]))[0] for w in words], np.uint64)


def phrases(texts: DataFrame, text: str) -> np.ndarray:
    """Hashes of all windows of ``PHRASE`` words of small reference texts, made and freed of
    repeats in Spark; they are handed to the tasks as a list, whose length is checked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, offsets, data, _ in segments(list(range(len(batch))), batch.column(0).to_pylist(), PHRASE):
                w = Words(data)
                if len(w.start) >= PHRASE:
                    owner = np.searchsorted(np.array(offsets), w.start, "right")
                    h = _rolling(w.hash, PHRASE)[owner[: len(owner) - PHRASE + 1] == owner[PHRASE - 1 :]]
                    yield pa.RecordBatch.from_arrays([pa.array(np.unique(h).view(np.int64))], names=["h"])

    found = cut(texts.select(text).mapInArrow(run, "h long").distinct(), "phrases")
    if found.count() > MOST_PHRASES:
        raise ValueError(f"more than {MOST_PHRASES} phrases to blank")
    return np.sort(found.toArrow().column(0).to_numpy().view(np.uint64))


_STOPS = np.zeros(256, bool)
_STOPS[[10, 13, 46]] = True


def _sentences(w: Words, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, word after the last, hash) of each sentence of ``PHRASE`` words or more."""
    if not len(w.start):
        return w.start, w.start, w.hash
    part = np.cumsum(_STOPS[w.text])[w.start]
    first = np.flatnonzero(np.r_[True, (part[1:] != part[:-1]) | (owner[1:] != owner[:-1])])
    last = np.r_[first[1:], len(part)]
    keep = last - first >= PHRASE
    first, last = first[keep], last[keep]
    up, down = powers_of(len(part))
    sums = np.zeros(len(part) + 1, np.uint64)
    np.cumsum(w.hash * up[: len(part)], out=sums[1:])
    return first, last, _mix((sums[last] - sums[first]) * down[first] + (last - first).astype(np.uint64))


def boilerplate(docs: DataFrame, text: str, share: float = 0.01, least: int = 10) -> np.ndarray:
    """Hashes of the sentences (runs between line ends and full stops) of ``PHRASE`` words or
    more found in at least ``share`` of the different texts, and in ``least`` of them, without
    which every sentence of a few texts would be common. Copies of a text, by its hash, count
    once: a file that is often vendored is no licence. There are at most (sentences per text) /
    share of them, whatever the size of the corpus; all texts are counted, with partial sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, hashes = batch.column(0).to_pylist(), batch.column(1).to_numpy()
            for rows, offsets, data, _ in segments(list(range(len(texts))), texts, 1):
                w = Words(data)
                owner = np.searchsorted(np.array(offsets), w.start, "right") - 1
                first, _, h = _sentences(w, owner)
                if len(first):
                    of = hashes[np.array(rows)[owner[first]]].view(np.uint64)
                    said = np.unique(np.stack([of, h], 1), axis=0).view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(said[:, 1]), pa.array(said[:, 0])], names=["s", "t"])

    texts = docs.where(F.col(text).isNotNull()).select(text, F.xxhash64(text).alias("t"))
    said = texts.mapInArrow(run, "s long, t long").distinct().groupBy("s").agg(F.count(F.lit(1)).alias("n"))
    total = texts.select("t").distinct().agg(F.count(F.lit(1))).scalar()
    found = said.where((F.col("n") >= least) & (F.col("n") >= F.lit(share) * total)).select("s").collect()
    return np.sort(np.array([r.s for r in found], np.int64).view(np.uint64))


def document_terms(docs: DataFrame, doc_id: str, text: str, blank: np.ndarray, common: np.ndarray) -> DataFrame:
    """(doc_id, terms, counts) of each text with a term; a text cut into segments gives a row
    for each. Passages with a window in ``blank`` and sentences with a hash in ``common`` give no
    term."""
    shared, kind = docs.sparkSession.sparkContext.broadcast((blank, common)), dict(docs.dtypes)[doc_id]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for rows, offsets, data, _ in segments(list(range(len(ids))), batch.column(1).to_pylist(), 1):
                raw = np.frombuffer(data, np.uint8)
                w = Words(data)
                passages, sentences = shared.value
                gone = np.zeros(len(raw) + 1, np.int32)
                if len(w.start) >= PHRASE and len(passages):
                    hit = np.flatnonzero(member(_rolling(w.hash, PHRASE), passages))
                    np.add.at(gone, w.start[hit], 1)
                    np.add.at(gone, w.end[hit + PHRASE - 1], -1)
                if len(sentences):
                    first, last, h = _sentences(w, np.searchsorted(np.array(offsets), w.start, "right"))
                    hit = np.flatnonzero(member(h, sentences))
                    np.add.at(gone, w.start[first[hit]], 1)
                    np.add.at(gone, w.end[last[hit] - 1], -1)
                if gone.any():
                    raw = np.where(np.cumsum(gone[:-1]) > 0, np.uint8(32), raw)
                start, end = _terms(raw)
                keep = end - start >= 3
                start, end = start[keep], end[keep]
                if not len(start):
                    continue
                owner = np.searchsorted(np.array(offsets), start, "right") - 1
                # The blanked parts hold no term, so that the whole text's hashes hold for the rest.
                term = _fold(w, start, end)
                order = np.lexsort((term, owner))
                owner, term = owner[order], term[order]
                new = np.r_[True, (owner[1:] != owner[:-1]) | (term[1:] != term[:-1])]
                at = np.flatnonzero(new)
                count = np.diff(np.r_[at, len(term)])
                owner, term = owner[at], term[at]
                edge = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
                off = pa.array(np.r_[edge, len(owner)].astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(np.array(rows)[owner[edge]])),
                        pa.ListArray.from_arrays(off, pa.array(term.view(np.int64))),
                        pa.ListArray.from_arrays(off, pa.array(count.astype(np.int32))),
                    ],
                    names=[doc_id, "terms", "counts"],
                )

    return docs.select(doc_id, text).mapInArrow(run, f"`{doc_id}` {kind}, terms array<long>, counts array<int>")


def _mixtures(rates: np.ndarray, n: np.ndarray, edge: np.ndarray, inner: int) -> tuple[np.ndarray, np.ndarray]:
    """(document mixtures, their share in each entry), a row for each component, for fixed rates
    of each entry."""
    size = np.diff(np.r_[edge, len(n)])
    mix = np.ones((len(rates), len(edge)), np.float32)
    for _ in range(inner):
        part = np.repeat(mix, size, axis=1)
        part *= rates
        part *= n / np.maximum(part.sum(0), np.float32(1e-30))
        mix = np.add.reduceat(part, edge, axis=1)
    return mix, part


def _entries(batch: pa.RecordBatch, known: np.ndarray) -> Iterator[tuple]:
    """Parts of a batch of documents: (rows, places of the entries' terms in ``known``, counts,
    first entries); entries of other terms are left out."""
    terms, counts = batch.column("terms"), batch.column("counts")
    flat, n = terms.flatten().to_numpy().view(np.uint64), counts.flatten().to_numpy().astype(np.float32)
    size = np.asarray(terms.value_lengths())
    owner = np.repeat(np.arange(len(size)), size)
    at = np.minimum(np.searchsorted(known, flat), len(known) - 1)
    ok = known[at] == flat
    owner, n, index = owner[ok], n[ok], at[ok]
    a = 0
    while a < len(owner):
        b = min(len(owner), a + ENTRIES)
        if b < len(owner):
            back = np.searchsorted(owner, owner[b])
            b = back if back > a else np.searchsorted(owner, owner[b], "right")
        o = owner[a:b]
        edge = np.flatnonzero(np.r_[True, o[1:] != o[:-1]])
        yield o[edge], index[a:b], n[a:b], edge
        a = b


def gate(sums: np.ndarray, totals: np.ndarray, purity: float = 0.6, two: float = 0.85) -> np.ndarray:
    """Component rates of terms from their expected counts; the last component is common. The
    update is followed by a projection that keeps the factors sparse: a term whose subject rates
    are not concentrated (``purity`` on one subject or ``two`` on two) is left to the common
    component but for a twentieth, so that it may come back. Without it the subjects take up the
    usual words of programming as the rounds go on (figures in the README)."""
    sums = sums.copy()
    rate = sums[:, :-1] / np.maximum(totals[:-1], 1e-9)
    share = np.sort(rate / np.maximum(rate.sum(1, keepdims=True), 1e-30), axis=1)[:, ::-1]
    mixed = (share[:, 0] < purity) & (share[:, 0] + share[:, 1] < two)
    sums[mixed, -1] += 0.95 * sums[mixed, :-1].sum(1)
    sums[mixed, :-1] *= 0.05
    return sums + 1e-9


def _term_sums(batches, known: np.ndarray, array: np.ndarray) -> np.ndarray:
    """Expected counts of the terms ``known`` (a row for each component) in some documents, whose
    mixtures are fitted to the rates ``array`` on the way."""
    sums = np.zeros(array.shape)
    for batch in batches:
        for _, index, n, edge in _entries(batch, known):
            _, part = _mixtures(array[:, index], n, edge, INNER)
            for j in range(len(sums)):
                sums[j] += np.bincount(index, part[j], len(known))
    return sums


def _document_words(batches, known: np.ndarray, array: np.ndarray, key: str) -> Iterator[pa.RecordBatch]:
    """(key, words): expected words per subject of some documents."""
    for batch in batches:
        for rows, index, n, edge in _entries(batch, known):
            mix, _ = _mixtures(array[:, index], n, edge, FINAL)
            words = pa.FixedSizeListArray.from_arrays(pa.array(mix[:-1].T.astype(np.float64).ravel()), len(mix) - 1)
            yield pa.RecordBatch.from_arrays([batch.column(key).take(pa.array(rows)), words.cast(pa.list_(pa.float64()))], names=[key, "words"])


def _as_rows(known: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
    """(term, sums) of the terms that occur."""
    some = np.flatnonzero(sums.any(0))
    rows = pa.FixedSizeListArray.from_arrays(pa.array(sums[:, some].T.ravel()), len(sums)).cast(pa.list_(pa.float64()))
    return pa.RecordBatch.from_arrays([pa.array(known[some].view(np.int64)), rows], names=["term", "sums"])


class Factors:
    """Component rates of all terms.

    While the terms are few (counted) the rates are an array in every task. Of more terms the
    rates stay a table: the documents are written in blocks of bounded size once, with the list of
    each block's terms (``routes``), and in a round every block gets the rates of its own terms,
    each once, and reads its documents' file. What is shuffled is the distinct terms of each block,
    however often they occur, and the matrix never is.
    """

    def __init__(self, matrix: DataFrame, doc_id: str, seeds: np.ndarray, owners: np.ndarray, k: int, min_docs: int):
        self.matrix, self.doc_id, self.k = matrix, doc_id, k
        counts = matrix.select(F.explode(F.arrays_zip("terms", "counts")).alias("e")).groupBy(F.col("e.terms").alias("term"))
        terms = counts.agg(F.count(F.lit(1)).alias("docs"), F.sum("e.counts").alias("n")).where(F.col("docs") >= min_docs)
        self.terms = cut(terms.select("term", "n"), "terms")
        self.few = self.terms.limit(BROADCAST_TERMS + 1).count() <= BROADCAST_TERMS
        if not self.few:
            self._route()
        total = float(self.terms.agg(F.sum("n")).first()[0] or 1)
        order = np.argsort(seeds)
        seeds, owners = seeds[order], owners[order]
        each = np.bincount(owners, minlength=k)

        def start(term: np.ndarray, n: np.ndarray) -> np.ndarray:
            """A common part everywhere, and the example words' subjects."""
            rates = np.repeat((n / total)[:, None], k + 1, axis=1)
            rates[:, :k] *= 0.1
            if len(seeds):
                lo, hi = np.searchsorted(seeds, term), np.searchsorted(seeds, term, "right")
                for r in np.flatnonzero(hi > lo):
                    own = owners[lo[r] : hi[r]]
                    rates[r, own] += 1.0 / each[own]
                    rates[r, k] *= 0.01
            return rates

        self._rates(lambda term, sums: start(term, sums[:, 0]), self.terms.select("term", F.array(F.col("n").cast("double")).alias("sums")))

    def _route(self) -> None:
        """Write the documents in blocks, and the terms of each block."""
        spark, size = self.matrix.sparkSession, self.matrix.agg(F.sum(F.size("terms"))).first()[0] or 0
        self.blocks, self.path = max(1, -(-int(size) // BLOCK_ENTRIES)), scratch_path(self.matrix.sparkSession, "blocks")
        block = F.pmod(F.xxhash64(self.doc_id, F.element_at("terms", 1)), F.lit(self.blocks)).cast("int")
        rows = self.matrix.withColumn("block", block).repartition(self.blocks, "block")
        rows.write.option("compression", "zstd").partitionBy("block").parquet(self.path)
        rows = spark.read.parquet(self.path)
        self.routes = cut(rows.select("block", F.explode("terms").alias("term")).distinct().join(self.terms.select("term"), "term"), "routes")

    def _rates(self, make, table: DataFrame) -> None:
        """Set the rates to ``make(terms, sums)``, each component scaled to one."""
        k = self.k

        def block(batch) -> tuple[np.ndarray, np.ndarray]:
            term = batch.column("term").to_numpy().view(np.uint64)
            sums = batch.column("sums").combine_chunks() if isinstance(batch, pa.Table) else batch.column("sums")
            return term, make(term, sums.flatten().to_numpy().reshape(len(term), -1)) if len(term) else np.zeros((0, k + 1))

        if self.few:
            term, rates = block(table.toArrow())
            order = np.argsort(term)
            rates = (rates / np.maximum(rates.sum(0), 1e-30))[order].astype(np.float32)
            self.known, self.array = term[order], np.ascontiguousarray(rates.T)
            return

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                _, rates = block(batch)
                rows = pa.FixedSizeListArray.from_arrays(pa.array(rates.ravel()), k + 1).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([batch.column("term"), rows], names=["term", "rates"])

        self.rates = rates = cut(table.mapInArrow(run, "term long, rates array<double>"), "rates")
        sums = rates.agg(*[F.sum(F.col("rates")[j]) for j in range(k + 1)]).first()
        scale = F.array(*[F.lit(1.0 / max(s or 0.0, 1e-30)) for s in sums])
        self.table = rates.select("term", F.zip_with("rates", scale, lambda a, b: a * b).cast("array<float>").alias("rates"))

    def _each(self, work, kind: str) -> DataFrame:
        """``work(batches of documents, terms, rates)`` for all documents."""
        if self.few:
            shared = self.matrix.sparkSession.sparkContext.broadcast((self.known, self.array))

            def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                if len(shared.value[0]):
                    yield from work(batches, *shared.value)

            return self.matrix.mapInArrow(run, kind)
        path, k = self.path, self.k

        def part(key: tuple, table: pa.Table) -> pa.Table:
            term = table.column("term").to_numpy().view(np.uint64)
            order = np.argsort(term)
            rates = table.column("rates").combine_chunks().flatten().to_numpy().reshape(-1, k + 1)[order]
            found = work(batches_of(f"{path}/block={key[0].as_py()}"), term[order], np.ascontiguousarray(rates.T))
            return pa.Table.from_batches(list(found), schema)

        names, types = zip(*[(c.split()[0].strip("`"), c.split()[1]) for c in kind.split(", ")])
        arrow = {"array<double>": pa.list_(pa.float64()), "long": pa.int64(), "bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}
        schema = pa.schema(list(zip(names, (arrow[t] for t in types))))
        return self.routes.join(self.table, "term").groupBy("block").applyInArrow(part, kind)

    def round(self) -> np.ndarray:
        """One update of the mixtures and then of the rates; the components' totals."""
        k = self.k

        def work(batches, known: np.ndarray, array: np.ndarray) -> Iterator[pa.RecordBatch]:
            yield _as_rows(known, _term_sums(batches, known, array))

        sums = self._each(work, "term long, sums array<double>")
        each = sums.groupBy("term").agg(F.array(*[F.sum(F.col("sums")[j]) for j in range(k + 1)]).alias("sums"))
        each = cut(each, "sums")
        totals = np.array([v or 0.0 for v in each.agg(*[F.sum(F.col("sums")[j]) for j in range(k + 1)]).first()])
        last = None if self.few else self.rates
        self._rates(lambda _, s: gate(s, totals), each)
        release(each)
        if last is not None:
            release(last)
        return totals

    def mixtures(self) -> DataFrame:
        """(doc_id, words): each document's expected words per subject."""
        key = self.doc_id
        kind = dict(self.matrix.dtypes)[key]
        return self._each(lambda batches, known, array: _document_words(batches, known, array, key), f"`{key}` {kind}, words array<double>")


def subject_words(
    docs: DataFrame, areas: DataFrame, other: DataFrame, doc_id: str = "doc_id", text: str = "text",
    min_docs: int = 5, rounds: int = ROUNDS, boilerplate_share: float = 0.01,
) -> DataFrame:
    """(doc_id, subject, n_words, share): the expected number of a document's words that point to
    each subject and its share of all its words that point to any. ``areas`` (subject,
    example_words) and ``other`` (text: passages that count for no subject) are small tables of
    the task; the corpus may have any size."""
    seeds = [(r.subject, [w.strip() for w in (r.example_words or "").split(",") if w.strip()]) for r in areas.orderBy("subject").collect()]
    names = [s for s, _ in seeds]
    owners = np.array([k for k, (_, words) in enumerate(seeds) for _ in words], np.int64)
    anchors = term_hash([w for _, words in seeds for w in words])
    matrix = cut(document_terms(docs, doc_id, text, phrases(other, text), boilerplate(docs, text, boilerplate_share)), "matrix")
    factors = Factors(matrix, doc_id, anchors, owners, len(names), min_docs)
    last = np.zeros(len(names) + 1)
    for _ in range(rounds):
        totals = factors.round()
        if np.all(np.abs(totals - last) <= STILL * np.maximum(totals, 1.0)):
            break
        last = totals
    words = factors.mixtures().select(doc_id, F.posexplode("words").alias("k", "n")).groupBy(doc_id, "k").agg(F.sum("n").alias("n_words"))
    return _shares(words, doc_id, names)


def _shares(words: DataFrame, doc_id: str, names: list[str]) -> DataFrame:
    both = words.groupBy(doc_id).agg(F.sum("n_words").alias("total"), F.collect_list(F.struct("k", "n_words")).alias("e"))
    each = both.select(doc_id, "total", F.inline("e"))
    subject = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("k") + 1)
    return each.select(doc_id, subject.alias("subject"), "n_words", F.try_divide("n_words", "total").alias("share"))


def _large(share: float, least: float) -> Column:
    return F.coalesce((F.col("share") >= share) & (F.col("n_words") >= least), F.lit(False))


def _place(words: DataFrame) -> Column:
    """The place of a subject in its document, which the first column names; equal counts go by
    the subject's name."""
    return F.row_number().over(Window.partitionBy(words.columns[0]).orderBy(F.col("n_words").desc(), "subject"))


def main_subjects(words: DataFrame, share: float = 0.25, least: float = 3.0, most: int = 2) -> DataFrame:
    """The ``most`` largest of the subjects of at least ``share`` of a document's subject words
    and ``least`` words."""
    rows = words.where(_large(share, least))
    return rows.withColumn("place", _place(rows)).where(F.col("place") <= most).drop("place")


def composition(words: DataFrame, share: float = 0.25, least: float = 3.0, most: int = 2) -> DataFrame:
    """(subject, n_documents, share): the documents whose ``main_subjects`` hold the subject, and
    its share in the corpus's subject words."""
    rows = words.withColumn("main", _large(share, least) & (_place(words) <= most))
    each = rows.groupBy("subject").agg(F.sum(F.col("main").cast("long")).alias("n_documents"), F.sum("n_words").alias("n_words"))
    total = each.agg(F.sum("n_words")).scalar()
    return each.select("subject", "n_documents", F.try_divide("n_words", total).alias("share"))
