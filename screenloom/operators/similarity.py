"""Neighbours, communities, clusters and principal components of profiles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.clustering import BisectingKMeans
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from screenloom.operators.relational import chunk_labels
from screenloom.session import cut, release

#: Stored values worked on at once in a task.
ENTRIES = 200_000
#: Centres of the cells in which neighbours are looked for, at most.
MOST_CENTRES = 2048


def sparse_rows(values: DataFrame, genes: DataFrame, key: str, *more: str) -> DataFrame:
    """(key, idx, val): the stored values of each row over ``genes`` (gene, gene_idx from 0), by
    place; with the columns ``more``, in which a row's values are alike."""
    entry = F.struct(F.col("gene_idx").cast("int").alias("i"), F.col("value").cast("double").alias("v"))
    rows = values.join(genes, "gene").groupBy(key, *more).agg(F.array_sort(F.collect_list(entry)).alias("e"))
    return rows.select(key, F.col("e.i").alias("idx"), F.col("e.v").alias("val"), *more)


def sparse_vectors(rows: DataFrame, size: int, key: str) -> DataFrame:
    """(key, v): sparse rows (key, idx, val) as vectors of ``size`` places; a row without entries
    is all zeros. They are written as the columns that Spark keeps vectors in and read as such."""
    places, entries = F.coalesce("idx", F.array().cast("array<int>")), F.coalesce("val", F.array().cast("array<double>"))
    stored = F.struct(F.lit(0).cast("byte").alias("type"), F.lit(size).alias("size"), places.alias("indices"), entries.alias("values"))
    schema = StructType([StructField(key, rows.schema[key].dataType), StructField("v", VectorUDT())])
    return cut(rows.select(key, stored.alias("v")), "vectors", schema=schema)


def _parts(batch: pa.RecordBatch) -> Iterator[tuple[slice, np.ndarray, np.ndarray, np.ndarray]]:
    """Some rows of a batch of sparse rows at a time: (rows, places, values, first entries)."""
    size = np.asarray(batch.column("idx").value_lengths())
    idx, val = batch.column("idx").flatten().to_numpy(), batch.column("val").flatten().to_numpy()
    ends = np.cumsum(size)
    a = 0
    while a < len(size):
        done = ends[a - 1] if a else 0
        b = max(a + 1, int(np.searchsorted(ends, done + ENTRIES, "right")))
        yield slice(a, b), idx[done : ends[b - 1]], val[done : ends[b - 1]], ends[a:b] - size[a:b] - done
        a = b


def cell_vectors(counts: DataFrame, genes: DataFrame, key: str = "cell_barcode") -> DataFrame:
    """(key, features): dense rows over ``genes`` (gene, gene_idx from 0), what is not stored 0."""
    n = genes.count()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, idx, val, first in _parts(batch):
                size = np.diff(np.r_[first, len(idx)])
                dense = np.zeros((len(first), n))
                dense[np.repeat(np.arange(len(first)), size), idx] = val
                at = pa.array(np.arange(len(first) + 1, dtype=np.int32) * np.int32(n))
                keys = batch.column(0).slice(rows.start, rows.stop - rows.start)
                yield pa.RecordBatch.from_arrays([keys, pa.ListArray.from_arrays(at, pa.array(dense.ravel()))], names=[key, "features"])

    rows = sparse_rows(counts, genes, key)
    return rows.mapInArrow(run, f"`{key}` {dict(rows.dtypes)[key]}, features array<double>")


def principal_components(values: DataFrame, genes: DataFrame, k: int, key: str = "cell_barcode", passes: int = 12, seed: int = 0) -> DataFrame:
    """(key, x): the first ``k`` principal components of the rows of ``values`` (key, gene, value;
    what is not stored is 0) over ``genes`` (gene, gene_idx from 0), or as many as there are genes;
    each axis is turned so that its greatest loading is positive.

    Block Lanczos iteration on the centred matrix: a pass over the stored values multiplies it with
    a block of directions and back, in sums per gene that each task forms and Spark adds up.
    No matrix square in the genes is ever made: what meets on the driver is some hundred numbers
    a gene. It ends when the first ``k`` variances no longer change, or after ``passes``. Where
    ``values`` has a column ``n``, each row stands for so many.
    """
    size = genes.count()
    weighted = "n" in values.columns
    rows = cut(sparse_rows(values, genes, key, *["n"] * weighted), "matrix")
    n = rows.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] if weighted else rows.count()
    k, width = min(k, size), min(k + 10, size)
    if not n or not k:
        return rows.select(key, F.array().cast("array<double>").alias("x"))
    sums = values.join(genes, "gene").groupBy("gene_idx").agg(F.sum(F.col("value") * F.col("n") if weighted else "value").alias("s")).toArrow()
    mean = np.zeros(size)
    mean[sums.column(0).to_numpy()] = sums.column(1).to_numpy() / n
    spark = values.sparkSession

    def project(idx: np.ndarray, val: np.ndarray, first: np.ndarray, axes: np.ndarray, shift: np.ndarray) -> np.ndarray:
        return np.add.reduceat(val[:, None] * axes[idx], first, axis=0) - shift

    def multiply(block: np.ndarray) -> np.ndarray:
        shared = spark.sparkContext.broadcast((block, mean @ block))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            axes, shift = shared.value
            out, total = np.zeros(axes.shape), np.zeros(axes.shape[1])
            for batch in batches:
                for at, idx, val, first in _parts(batch):
                    u = project(idx, val, first, axes, shift)
                    if weighted:
                        u *= batch.column("n").slice(at.start, at.stop - at.start).to_numpy()[:, None]
                    part = val[:, None] * np.repeat(u, np.diff(np.r_[first, len(idx)]), axis=0)
                    for j in range(out.shape[1]):
                        out[:, j] += np.bincount(idx, part[:, j], len(out))
                    total += u.sum(0)
            some = np.flatnonzero(out.any(1))
            flat = pa.FixedSizeListArray.from_arrays(pa.array(np.r_[total[None], out[some]].ravel()), out.shape[1])
            yield pa.RecordBatch.from_arrays([pa.array(np.r_[-1, some].astype(np.int32)), flat.cast(pa.list_(pa.float64()))], names=["i", "w"])

        parts = rows.mapInArrow(run, "i int, w array<double>")
        got = parts.groupBy("i").agg(F.array(*[F.sum(F.col("w")[j]) for j in range(block.shape[1])]).alias("w")).toArrow()
        at, w = got.column(0).to_numpy(), got.column(1).combine_chunks().flatten().to_numpy().reshape(-1, block.shape[1])
        out = np.zeros(block.shape)
        out[at[at >= 0]] = w[at >= 0]
        shared.unpersist()
        return out - np.outer(mean, w[at < 0].sum(0))

    block = np.linalg.qr(np.random.default_rng(seed).normal(size=(size, width)))[0]
    basis, image, before = np.zeros((size, 0)), np.zeros((size, 0)), None
    for _ in range(passes):
        made = multiply(block)
        basis, image = np.hstack([basis, block]), np.hstack([image, made])
        square = basis.T @ image
        found, turn = np.linalg.eigh((square + square.T) / 2)
        found, turn = found[::-1][:k], turn[:, ::-1][:, :k]
        if before is not None and np.all(np.abs(found - before) <= 1e-10 * max(found[0], 1e-300)) or basis.shape[1] >= size:
            break
        before, rest = found, made - basis @ (basis.T @ made)
        rest -= basis @ (basis.T @ rest)
        block = np.linalg.qr(rest)[0][:, : size - basis.shape[1]]
        # Directions that the basis holds already come out as noise; they are made orthogonal too.
        block = np.linalg.qr(block - basis @ (basis.T @ block))[0]
    axes = basis @ turn
    axes *= np.where(np.sign(axes[np.abs(axes).argmax(0), np.arange(axes.shape[1])]) < 0, -1.0, 1.0)
    shared = spark.sparkContext.broadcast((axes, mean @ axes))

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, idx, val, first in _parts(batch):
                x = project(idx, val, first, *shared.value)
                flat = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(part.start, part.stop - part.start), flat], names=[key, "x"])

    return rows.mapInArrow(scores, f"`{key}` {dict(rows.dtypes)[key]}, x array<double>")


def _closest(x: np.ndarray, y: np.ndarray, own: np.ndarray, others: np.ndarray, names: np.ndarray, k: int, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows of x, rows of y, distances): the ``k`` closest of each row of ``x``, by the distance
    to nine decimals and then by name; equal numbers in ``own`` and ``others`` are one row.
    What is beyond a row's ``bound`` may be left out. Products name those that can be among them,
    whatever their rounding; differences then decide."""
    out, yy, place = [], (y**2).sum(1), np.unique(names, return_inverse=True)[1]
    for a in range(0, len(x), 256):
        part = x[a : a + 256]
        rough = (part**2).sum(1)[:, None] + yy - 2 * part @ y.T
        same = own[a : a + 256, None] == others
        rough[same] = np.inf
        most = bound[a : a + 256] ** 2
        if not np.all(np.isfinite(most)):
            most = np.minimum(most, np.partition(rough, min(k, len(y)) - 1, axis=1)[:, min(k, len(y)) - 1])
        slack = 1e-10 * ((part**2).sum(1) + yy.max()) + 5e-9 * np.sqrt(np.maximum(most, 0)) + 1e-15
        i, j = np.nonzero((rough <= (most + slack)[:, None]) & ~same)
        d = np.empty(len(i))
        for b in range(0, len(i), ENTRIES):
            d[b : b + ENTRIES] = np.sqrt(((part[i[b : b + ENTRIES]] - y[j[b : b + ENTRIES]]) ** 2).sum(1))
        order = np.lexsort((place[j], np.round(d, 9), i))
        i, j, d = i[order], j[order], d[order]
        start = np.flatnonzero(np.r_[True, i[1:] != i[:-1]]) if len(i) else i
        keep = np.arange(len(i)) - np.repeat(start, np.diff(np.r_[start, len(i)])) < k
        out.append((i[keep] + a, j[keep], d[keep]))
    return tuple(np.concatenate(c) for c in zip(*out))


def nearest_neighbours(vectors: DataFrame, k: int, key: str, block: int = 2048, among: DataFrame | None = None) -> DataFrame:
    """(key, neighbour, rank, distance): the exact ``k`` nearest other rows of each row, of
    ``among`` where it is given, by Euclidean distance to nine decimals, ties by name. Rows
    without a name or vector are left out.

    Rows are parted into cells around centres (some of the rows, in hash order). A row first meets
    its own cell, which bounds its ``k``-th distance, and then only the cells whose centre and
    radius say that they can hold something closer. Cells are dealt to chunks of about ``block``
    rows on both sides; each pair of chunks is one array product, so that a task holds two chunks
    whatever the number of rows or copies.
    """
    def known(df: DataFrame, name: str) -> DataFrame:
        return cut(df.select(F.col(key).cast("string").alias("k"), "x").where("k IS NOT NULL AND x IS NOT NULL"), name)

    rows = known(vectors, "vectors")
    others = rows if among is None else known(among, "others")
    spark, order = rows.sparkSession, F.xxhash64("k")
    m = min(MOST_CENTRES, max(1, -(-others.count() // block)))
    picked = [r.x for r in others.orderBy(order, "k").limit(m).collect()]
    centres = np.array(picked, float) if picked else np.zeros((1, 1))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                x = batch.column("x").flatten().to_numpy().reshape(len(batch), -1)
                cell = ((centres**2).sum(1) - 2 * x @ centres.T).argmin(1)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell.astype(np.int32)), pa.array(np.sqrt(((x - centres[cell]) ** 2).sum(1)))], names=["k", "x", "cell", "far"])

    kind = "k string, x array<double>, cell int, far double"
    given = cut(others.mapInArrow(place, kind), "placed")
    asks = given if among is None else cut(rows.mapInArrow(place, kind), "asks")
    # A row a cell, of at most MOST_CENTRES cells.
    radius, sizes = np.full(len(centres), -np.inf), {}
    for r in given.groupBy("cell").agg(F.max("far").alias("r"), F.count(F.lit(1)).alias("n")).collect():
        radius[r.cell], sizes[r.cell] = r.r, -(-r.n // block)

    def meet(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(b):
            return pd.DataFrame({"k": pd.Series(dtype=str), "neighbour": pd.Series(dtype=str), "distance": pd.Series(dtype=float)})
        one, other = a["k"].to_numpy(), b["n"].to_numpy()
        # Numbers for names: texts are compared one by one.
        code = pd.factorize(np.concatenate([one, other]))[0].astype(np.int32)
        i, j, d = _closest(np.stack(a["x"].to_numpy()), np.stack(b["y"].to_numpy()), code[: len(one)], code[len(one) :], other.astype(str), k, a["bound"].fillna(np.inf).to_numpy(float))
        return pd.DataFrame({"k": one[i], "neighbour": other[j], "distance": d})

    def met(asking: DataFrame) -> DataFrame:
        """The closest of each chunk of the cells that ``asking`` (k, x, cell, bound) names, as far
        as they are not beyond its bound."""
        # A row a cell again.
        parts = {r.cell: -(-r["count"] // block) for r in asking.groupBy("cell").count().collect()}
        chunks = F.broadcast(spark.createDataFrame([(c, parts[c], n) for c, n in sizes.items() if c in parts], "cell int, na int, nb int"))
        own, each = lambda n: F.pmod(order, F.col(n)).cast("int"), lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        a = asking.join(chunks, "cell").select("k", "x", "cell", "bound", own("na").alias("i"), each("nb").alias("j"))
        b = given.join(chunks, "cell").select(F.col("k").alias("n"), F.col("x").alias("y"), F.col("cell").alias("c"), own("nb").alias("j"), each("na").alias("i"))
        return a.groupBy("cell", "i", "j").cogroup(b.groupBy("c", "i", "j")).applyInPandas(meet, "k string, neighbour string, distance double")

    best = Window.partitionBy("k").orderBy(F.round("distance", 9), "neighbour")
    first = lambda df: df.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    home = cut(first(met(asks.withColumn("bound", F.lit(None).cast("double")))), "home")
    bound = home.groupBy("k").agg(F.max(F.when(F.col("rank") == k, F.col("distance"))).alias("bound"))

    def abroad(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                x = batch.column("x").flatten().to_numpy().reshape(len(batch), -1)
                bound = batch.column("bound").to_numpy(zero_copy_only=False).astype(float)
                far = np.sqrt(np.maximum((x**2).sum(1)[:, None] + (centres**2).sum(1) - 2 * x @ centres.T, 0))
                slack = 2e-9 + 1e-7 * (far + radius.max(initial=0.0))
                near = far - radius <= np.where(np.isnan(bound), np.inf, bound)[:, None] + slack
                near[np.arange(len(x)), batch.column("cell").to_numpy()] = False
                i, c = np.nonzero(near & np.isfinite(radius))
                taken = batch.select(["k", "x", "bound"]).take(pa.array(i))
                yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(c.astype(np.int32))], names=["k", "x", "bound", "cell"])

    out = home
    if m > 1:
        further = cut(asks.join(bound, "k", "left").select("k", "x", "cell", "bound").mapInArrow(abroad, "k string, x array<double>, bound double, cell int"), "further")
        out = first(home.drop("rank").unionByName(met(further)))
    return out.select(F.col("k").alias(key), "neighbour", "rank", "distance")


def named_neighbours(asks: DataFrame, k: int, key: str, named: DataFrame, block: int = 2048) -> DataFrame:
    """(key, r, neighbour, of): the ``k`` names nearest to each of ``asks`` (key, x), by distance to
    nine decimals and then name; ``named`` (of, x, names) has the first ``k`` names of what shares a
    vector, or a part of it."""
    # Signs keep the names of askers and vectors apart, so that none leaves out another.
    sets = named.select(F.concat(F.lit("="), F.array_min("names")).alias("k"), "x", "of", F.size("names").alias("n"), "names")
    found = nearest_neighbours(asks.select(F.concat(F.lit("?"), key).alias("k"), "x"), k, "k", block, among=sets.select("k", "x"))
    found = found.select(F.substring("k", 2, 1 << 30).alias(key), F.col("neighbour").alias("k"), F.round("distance", 9).alias("d")).join(sets.drop("x"), "k")
    upto, tied = Window.partitionBy(key).orderBy("d"), Window.partitionBy(key, "d")
    before = F.sum("n").over(upto.rangeBetween(Window.unboundedPreceding, 0)) - F.sum("n").over(tied)
    # What lies behind enough closer rows is left out before names are listed.
    found = found.withColumn("before", before).where(F.col("before") < k).select(key, "d", "of", F.explode("names").alias("neighbour"))
    found = found.withColumn("r", F.row_number().over(Window.partitionBy(key).orderBy("d", "neighbour"))).where(F.col("r") <= k)
    return found.select(key, "r", "neighbour", "of")


def neighbours_of_alike(vectors: DataFrame, k: int, key: str, among: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(near, alike): the ``k`` nearest other rows of ``among``, a part of ``vectors``, as
    ``nearest_neighbours`` finds them. Rows with equal vectors that have the same neighbours ask
    once: near is (asker, neighbour), alike (key, asker) names each row's asker.

    Of ``among``'s rows with one vector only the first by name can be neighbours, one more than
    ``k`` as a row leaves itself out; these ask for themselves, and so many different vectors
    hold all that can be near. Different vectors are then what is compared, with any number of copies.
    """
    first = k + 1
    rows = vectors.select(F.col(key).cast("string").alias("k"), "x").where("k IS NOT NULL AND x IS NOT NULL").dropDuplicates(["k"])
    others = among.select(F.col(key).cast("string").alias("k")).distinct().withColumn("other", F.lit(True))
    rows = cut(rows.join(others, "k", "left").withColumn("other", F.coalesce("other", F.lit(False))), "rows")
    ranked = rows.where("other").withColumn("r", F.row_number().over(Window.partitionBy("x").orderBy("k"))).where(F.col("r") <= first)
    named = cut(ranked.groupBy("x").agg(F.array_sort(F.collect_list("k")).alias("names")), "named")
    own = F.transform("names", lambda n: F.struct(n.alias("k"), F.lit(True).alias("itself")))
    listed = cut(rows.where("other").select("k").join(named.select(F.explode(own).alias("e")).select("e.*"), "k", "left"), "listed")
    asking = rows.join(listed.withColumnRenamed("itself", "listed"), "k", "left").withColumn("listed", F.coalesce("listed", F.lit(False)))
    least = F.min(F.when(~F.col("listed"), F.col("k"))).over(Window.partitionBy("x", "other"))
    asking = cut(asking.withColumn("asker", F.when(F.col("listed"), F.col("k")).otherwise(least)).select("k", "x", "asker"), "alike")
    asks = asking.where("k = asker").select("x", "asker")
    # Askers of one vector (listed or not) share its search too.
    one = cut(asks.groupBy("x").agg(F.min("asker").alias("one")), "one")
    found = named_neighbours(one, first, "one", named.withColumn("of", F.col("names")[0]))
    found = cut(found.groupBy("one").agg(F.transform(F.array_sort(F.collect_list(F.struct("r", "neighbour"))), lambda e: e.neighbour).alias("best")), "found")
    others_of = F.slice(F.filter("best", lambda n: n != F.col("asker")), 1, k)
    near = asks.join(one, "x").join(found, "one").select("asker", F.explode(others_of).alias("neighbour"))
    return near, asking.select(F.col("k").alias(key), "asker")


def communities(neighbours: DataFrame, key: str, rounds: int = 20) -> DataFrame:
    """(key, community): label propagation over the neighbour links in both directions. In each
    round a node takes the label its neighbours have most of, the smallest on a tie, keeping its
    own where that is among them; nodes of alternate hash parity move in turn, which ends the
    oscillation of a synchronous update. Each round is two joins and two aggregates."""
    one = neighbours.select(F.col(key).alias("a"), F.col("neighbour").alias("b"))
    links = cut(one.unionByName(one.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = kept = cut(links.select("a").distinct().withColumn("label", F.col("a")), "labels")
    for r in range(rounds):
        votes = links.join(labels.withColumnsRenamed({"a": "b"}), "b").groupBy("a", "label").agg(F.count(F.lit(1)).alias("n"))
        votes = votes.join(labels.withColumnRenamed("label", "own"), "a")
        first = F.struct((-F.col("n")).alias("n"), (F.col("label") != F.col("own")).alias("o"), "label")
        best = votes.groupBy("a").agg(F.min_by("label", first).alias("top"))
        turn = F.pmod(F.xxhash64("a"), F.lit(2)) == r % 2
        moved = F.when(turn, F.coalesce("top", "label")).otherwise(F.col("label"))
        new = cut(labels.join(best, "a", "left").select("a", moved.alias("label"), (moved != F.col("label")).alias("changed")), "labels")
        same = new.where("changed").limit(1).count() == 0
        release(kept)
        kept, labels = new, new.select("a", "label")
        if same and r % 2:
            break
    return labels.select(F.col("a").alias(key), F.col("label").alias("community"))


def cluster_profiles(vectors: DataFrame, k: int, key: str, seed: int = 0) -> DataFrame:
    """(key, cluster, order_index) of rows (key, x), or (key, v) of Spark's own vectors, which may
    be sparse: a hierarchical clustering by repeated bisection, clusters numbered from 1 by size
    and then least name, and members ordered within. Agglomeration needs all pairs of rows in one
    place; bisection is its distributed counterpart."""
    data = vectors.where(F.col(key).isNotNull())
    if "v" not in data.columns:
        data = cut(data.select(key, "x"), "profiles").select(key, array_to_vector("x").alias("v"))
    if k < 2 or data.limit(3).count() < 3:
        return chunk_labels(data, key, 1).select(key, F.lit(1).alias("cluster"), (F.col("chunk_index") + 1).alias("order_index"))
    model = BisectingKMeans(k=k, featuresCol="v", predictionCol="c", seed=seed).fit(data)
    rows = model.transform(data).select(key, "c")
    sizes = rows.groupBy("c").agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("least"))
    sizes = sizes.withColumn("cluster", F.row_number().over(Window.orderBy(F.col("n").desc(), "least")).cast("int"))
    # Places within a cluster run on over all members in (cluster, name) order.
    ranked = chunk_labels(rows.join(F.broadcast(sizes), "c").select(F.struct("cluster", key).alias("at")), "at", 1)
    return ranked.select(f"at.{key}", "at.cluster", (F.col("chunk_index") + 1).alias("order_index"))


def profile_distances(matrix: DataFrame, group: str, groups_a: DataFrame, block: int = 256) -> DataFrame:
    """(group_a, group_b, distance, similarity): Euclidean distances of ``groups_a``'s profiles
    to all profiles in ``matrix`` (group, gene, value; absent is 0), and 1 / (1 + distance).

    Profiles are dealt to blocks; each pair of blocks is one task's array product, and its rows
    are the result itself.
    """
    rows = cut(cell_vectors(matrix, chunk_labels(matrix, "gene", 1).select("gene", F.col("chunk_index").alias("gene_idx")), group).select(F.col(group).alias("g"), "features"), "profiles")
    asked = rows.join(groups_a.select(F.col(group).alias("g")).distinct(), "g", "left_semi")
    blocks = max(1, -(-rows.count() // block))
    mine = F.pmod(F.xxhash64("g"), F.lit(blocks)).cast("int")
    each = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    a = asked.select("g", "features", mine.alias("i"), each.alias("j"))
    b = rows.select(F.col("g").alias("h"), F.col("features").alias("other"), mine.alias("j"), each.alias("i"))

    def meet(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(b):
            return pd.DataFrame({"group_a": pd.Series(dtype=str), "group_b": pd.Series(dtype=str), "distance": pd.Series(dtype=float)})
        x, y = np.stack(a["features"].to_numpy()), np.stack(b["other"].to_numpy())
        d = np.concatenate([np.sqrt(((y - v) ** 2).sum(1)) for v in x])
        return pd.DataFrame({"group_a": np.repeat(a["g"].to_numpy(), len(b)), "group_b": np.tile(b["h"].to_numpy(), len(a)), "distance": d})

    out = a.groupBy("i", "j").cogroup(b.groupBy("i", "j")).applyInPandas(meet, "group_a string, group_b string, distance double")
    return out.withColumn("similarity", 1 / (1 + F.col("distance")))
