"""Clusters of mutually similar vectors by parallel pivot correlation clustering.

Points are taken in the order of a hash. In each round every active point whose hash is least
among its active neighbours (vectors within ``radius``) becomes a pivot and absorbs its active
neighbours; rounds go on until no point is active. Members are then reassigned to their closest
pivot. Links between clusters are the pairs of neighbours in different clusters, contracted to
one link per pair of clusters; running the same pivot rounds over the contracted links until
none is left gives the chains (``linked_clusters``).

Neighbours are found through a grid on the most spread coordinates: a point is at home in one
cell and is copied into every cell its ball reaches, so that all neighbours of a point are in its
home cell. A second, finer grid on all coordinates has cells whose points are all neighbours of
one another: of such a sub-cell only the point of least hash can become a pivot, so that it alone
asks for its neighbours, however many points lie there. Absorbed points are found by asking the
few new pivots only. Distances are computed in blocks of array arithmetic and reduced at once to
one row per point; pairs are never emitted. A crowded cell is split into chunks of points, each of
which meets all that ask, so that no task holds a cell of unbounded size.

Vectors with a null, NaN or infinite coordinate are left out: the last two are near nothing, not
even themselves. Repeated rows count once. A name with two
different vectors is two points under one name. An empty input gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from screenloom.llm.filters import filter_of
from screenloom.session import cut, release

#: Coordinates of the grid, its cell width in radii, and the points of a block.
GRID_DIMS, CELL_RADII, BLOCK = 6, 4.0, 4096
#: Rows that leave a task together.
ROWS = 8192


def points(df: DataFrame, name: str, coordinates: list[str]) -> DataFrame:
    """Distinct points (point, name, hash, x): ``point`` names a vector of ``name``."""
    x = F.array(*[F.col(c).cast("double") for c in coordinates])
    rows = df.select(F.col(name).alias("name"), x.alias("x")).where(F.col("name").isNotNull())
    rows = rows.where(F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))).distinct()
    key = F.concat_ws("\x01", "name", F.hex(F.xxhash64("x")))
    # 48 bits of a hash of the name that any engine has, then bits that part the vectors of a name.
    order = F.conv(F.substring(F.md5("name"), 1, 12), 16, 10).cast("bigint") * 32768 + F.xxhash64("x").bitwiseAND(F.lit(32767))
    return rows.select(key.alias("point"), "name", order.alias("hash"), "x")


def _mixed(codes: np.ndarray) -> np.ndarray:
    """One number a row of whole numbers."""
    out = np.zeros(len(codes), np.uint64)
    for k in range(codes.shape[1]):
        out = (out ^ codes[:, k].astype(np.int64).view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out.view(np.int64)


def _sub_cells(x: np.ndarray, radius: float) -> np.ndarray:
    """The sub-cell of each vector; the diagonal of one is less than the radius."""
    return _mixed(np.floor(x / (radius * (1 - 1e-9) / np.sqrt(x.shape[1]))))


def _packed(x: np.ndarray) -> pa.Array:
    """Vectors as bytes, which cross between the JVM and Python without a step per coordinate."""
    ends = np.arange(len(x) + 1, dtype=np.int32) * np.int32(8 * x.shape[1])
    return pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(x, np.float64))])


def _unpacked(column: pa.Array) -> np.ndarray:
    if not len(column):
        return np.zeros((0, 1))
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[ends[0] : ends[-1]].view(np.float64).reshape(len(column), -1)


def grid_copies(pts: DataFrame, radius: float, block: int = BLOCK) -> DataFrame:
    """Each point in its home cell and in every other home cell within ``radius`` of it: (cell, home,
    id, hash, sub, x), ``sub`` being the point's sub-cell. Where a cell has more than ``block``
    points, also ``chunks``, the number of chunks that each cell is split into."""
    size = pts.agg(F.max(F.size("x"))).first()[0] or 0
    spread = pts.agg(F.array(*[F.var_samp(F.get("x", F.lit(k))) for k in range(size)]).alias("s")).first().s
    dims = sorted(range(size), key=lambda k: (-(spread[k] or 0.0), k))[:GRID_DIMS]
    width, reach = CELL_RADII * radius, radius * (1 + 1e-9)

    def homes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                x = batch.column("x").flatten().to_numpy().reshape(len(batch), -1)[:, dims]
                yield pa.RecordBatch.from_arrays([pa.array(np.unique(_mixed(np.floor(x / width))))], names=["cell"])

    # Most cells that a ball reaches are no point's home: copies there are not made.
    lived = pts.sparkSession.sparkContext.broadcast(filter_of(cut(pts.select("x").mapInArrow(homes, "cell long").distinct(), "cells")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = len(batch)
            if not n:
                continue
            full = batch.column("x").flatten().to_numpy().reshape(n, -1)
            sub = _sub_cells(full, radius)
            x = full[:, dims]
            base = np.floor(x / width)
            low = x - base * width
            row, cell, gap = np.arange(n), base.astype(np.int64), np.zeros(n)
            home = np.ones(n, bool)
            for k in range(len(dims)):
                parts = [(row, cell, gap, home)]
                for step, off in ((-1, low[row, k]), (1, width - low[row, k])):
                    near = np.flatnonzero(gap + off**2 <= reach**2)
                    moved = cell[near].copy()
                    moved[:, k] += step
                    parts.append((row[near], moved, (gap + off**2)[near], np.zeros(len(near), bool)))
                row, cell, gap, home = (np.concatenate(p) for p in zip(*parts))
            code = _mixed(cell)
            at = np.flatnonzero(lived.value.has(code.view(np.uint64)))
            row, home, code = row[at], home[at], code[at]
            taken = batch.select(["id", "hash"]).take(pa.array(row))
            yield pa.RecordBatch.from_arrays(
                [pa.array(code), pa.array(home), *taken.columns, pa.array(sub[row]), _packed(full[row])],
                names=["cell", "home", "id", "hash", "sub", "x"],
            )

    kind = "cell long, home boolean, id long, hash long, sub long, x binary"
    copies = cut(pts.select("id", "hash", "x").mapInArrow(run, kind), "copies")
    sizes = copies.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > block)
    if not sizes.limit(1).count():
        return copies
    sizes = sizes.select("cell", F.ceil(F.col("n") / block).cast("int").alias("chunks"))
    return cut(copies.join(sizes, "cell", "left").withColumn("chunks", F.coalesce("chunks", F.lit(1))), "copies")


def _whole(rows: DataFrame, asks: Column, given: Column, columns: list[str]) -> DataFrame:
    """Rows (block, asks, given, columns, x), a block for each cell: who asks, and whom."""
    # A new number, not the cell itself: the shuffle by block may not be left out for one by cell
    # further up, which adaptive execution may still replace.
    return rows.select(F.xxhash64("cell").alias("block"), asks.alias("asks"), given.alias("given"), *columns, "x")


def _dealt(asks: DataFrame, given: DataFrame, columns: list[str], block: int) -> DataFrame:
    """As ``_whole`` where cells are crowded: each side of a cell is dealt to chunks of about
    ``block`` rows, and each chunk of the one side meets each of the other."""
    parts = asks.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("parts"))
    each, own = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1)), lambda n: F.pmod("hash", F.col(n)).cast("int")
    sides = []
    for df, flag in ((asks, True), (given, False)):
        df = df.join(parts, "cell").withColumn("i", own("parts") if flag else each("parts")).withColumn("j", each("chunks") if flag else own("chunks"))
        sides.append(df.select(F.xxhash64("cell", "i", "j").alias("block"), F.lit(flag).alias("asks"), F.lit(not flag).alias("given"), *columns, "x"))
    return sides[0].unionByName(sides[1])


def _blocks(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple[dict, dict]]:
    """(those that ask, their company) of each block in a sorted partition; one at a time."""
    rest: pa.Table | None = None
    for batch in batches:
        if not len(batch):
            continue
        table = pa.Table.from_batches([batch])
        rest = table if rest is None else pa.concat_tables([rest, table])
        cells = rest.column("block").to_numpy()
        if cells[0] == cells[-1]:
            continue
        last = int(np.flatnonzero(cells != cells[-1])[-1]) + 1
        yield from _runs(rest.slice(0, last), names)
        rest = rest.slice(last)
    if rest is not None:
        yield from _runs(rest, names)


def _runs(table: pa.Table, names: list[str]) -> Iterator[tuple[dict, dict]]:
    table = table.combine_chunks()
    cells = table.column("block").to_numpy()
    starts = np.flatnonzero(np.r_[True, cells[1:] != cells[:-1]])
    ends = np.r_[starts[1:], len(cells)]
    columns = {n: table.column(n).to_numpy(zero_copy_only=False) for n in names}
    x = _unpacked(table.column("x").combine_chunks())
    for a, b in zip(starts, ends):
        ask, given = columns["asks"][a:b], columns["given"][a:b]
        if ask.any() and given.any():
            rows = {n: c[a:b] for n, c in columns.items()} | {"x": x[a:b]}
            yield tuple(rows if side.all() else {n: c[side] for n, c in rows.items()} for side in (ask, given))


def _near(x: np.ndarray, y: np.ndarray) -> Iterator[tuple[slice, np.ndarray]]:
    """Squared distances of rows of ``x`` to all of ``y``, some rows at a time."""
    if len(x) * len(y) <= 1024:
        yield slice(0, len(x)), ((x[:, None, :] - y[None, :, :]) ** 2).sum(2)
        return
    step = max(1, 2_000_000 // max(1, len(y)))
    for a in range(0, len(x), step):
        part = x[a : a + step]
        d = np.zeros((len(part), len(y)))
        for k in range(x.shape[1]):
            d += (part[:, k, None] - y[None, :, k]) ** 2
        yield slice(a, a + step), d


def _scan(blocks: DataFrame, kind: str, work) -> DataFrame:
    """``work`` on (those that ask, their company) of every block; it returns output columns or
    None."""
    out, names = [p.split()[0] for p in kind.split(",")], [c for c in blocks.columns if c not in ("block", "x")]

    def batch(parts: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*parts)], names=out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, rows = [], 0
        for a, b in _blocks(batches, names):
            found = work(a, b)
            if found is not None and len(found[0]):
                parts.append(found)
                rows += len(found[0])
            # Most blocks are small: some thousand rows leave together.
            if rows >= ROWS:
                yield batch(parts)
                parts, rows = [], 0
        if parts:
            yield batch(parts)

    return blocks.repartition("block").sortWithinPartitions("block").mapInArrow(run, kind)


def _least_hash(active: DataFrame, radius: float, block: int) -> DataFrame:
    """(id) of the active points that have the least hash among their active neighbours."""

    def work(a: dict, b: dict):
        if len(a["id"]) == len(b["id"]) == 1:
            return a["id"], np.zeros(1, bool)
        # Points of one sub-cell are neighbours: the least of them alone can be a pivot.
        sub = _sub_cells(a["x"], radius)
        order = np.lexsort((a["hash"], sub))
        first = order[np.r_[True, sub[order][1:] != sub[order][:-1]]]
        lower = np.zeros(len(first), bool)
        for rows, d in _near(a["x"][first], b["x"]):
            lower[rows] = ((d <= radius**2) & (b["hash"][None, :] < a["hash"][first[rows]][:, None])).any(1)
        return a["id"][first], lower

    columns, kind, home = ["id", "hash"], "id long, lower boolean", F.col("home")
    if not block:
        # A point asks in its home cell only.
        return _scan(_whole(active, home, F.lit(True), columns), kind, work).where("NOT lower").select("id")
    few = active.where(home).groupBy("cell", "sub").agg(F.min("hash").alias("hash"))
    few = active.where(home).join(few, ["cell", "sub", "hash"], "left_semi").select(*active.columns)
    # In a crowded cell it meets every chunk.
    found = _scan(_dealt(few, active, columns, block), kind, work)
    return found.groupBy("id").agg(F.max("lower").alias("lower")).where("NOT lower").select("id")


def _closest_pivot(copies: DataFrame, pivots: DataFrame, radius: float, block: int) -> DataFrame:
    """(id, pivot) of the points within ``radius`` of a pivot, the closest one."""

    def work(a: dict, b: dict):
        at, best = np.empty(len(b["id"]), np.int64), np.empty(len(b["id"]))
        for rows, d in _near(b["x"], a["x"]):
            at[rows], best[rows] = d.argmin(1), d.min(1)
        ok = best <= radius**2
        return b["id"][ok], a["id"][at[ok]], best[ok]

    kind, home = "id long, pivot long, d double", F.col("home")
    # The points are the given side, which is dealt to chunks; the pivots, far apart, ask them.
    if not block:
        rows = copies.join(pivots.withColumn("pivot", F.lit(True)), "id", "left").where("home OR pivot")
        return _scan(_whole(rows, F.coalesce("pivot", F.lit(False)), home, ["id"]), kind, work).select("id", "pivot")
    asks = copies.join(pivots, "id", "left_semi").select(*copies.columns)
    found = _scan(_dealt(asks, copies.where(home), ["id"], block), kind, work)
    return found.groupBy("id").agg(F.min(F.struct("d", "pivot")).getField("pivot").alias("pivot"))


def _cross_links(copies: DataFrame, radius: float, block: int) -> DataFrame:
    """(a, b): pairs of clusters with a pair of neighbours, from copies with ``cluster``."""

    def work(a: dict, b: dict):
        if len(a["cluster"]) == len(b["cluster"]) == 1:
            return None
        names, code = np.unique(np.r_[a["cluster"], b["cluster"]], return_inverse=True)
        if len(names) < 2:
            return None
        mine, other, links = code[: len(a["cluster"])], code[len(a["cluster"]) :], set()
        for rows, d in _near(a["x"], b["x"]):
            i, j = np.nonzero((d <= radius**2) & (mine[rows][:, None] != other[None, :]))
            links.update(np.unique(mine[rows][i] * len(names) + other[j]).tolist())
        if not links:
            return None
        found = np.array(sorted(links))
        return names[found // len(names)], names[found % len(names)]

    kind = "a long, b long"
    if not block:
        return _scan(_whole(copies, F.col("home"), F.lit(True), ["cluster"]), kind, work)
    mixed = copies.groupBy("cell").agg(F.min("cluster").alias("a"), F.max("cluster").alias("b")).where("a <> b").select("cell")
    rows = copies.join(mixed, "cell", "left_semi").select(*copies.columns)
    return _scan(_dealt(rows.where("home"), rows, ["cluster"], block), kind, work)


def _crowded(copies: DataFrame, block: int) -> int:
    """``block`` where a cell has several chunks, else 0."""
    return block if "chunks" in copies.columns else 0


def pivot_clusters(pts: DataFrame, radius: float, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """(members, copies): each point with its ``cluster``, the closest pivot within ``radius``,
    and the grid copies that found it."""
    # A number stands for a point from here on; written, it stays the same.
    pts = cut(pts.withColumn("id", F.monotonically_increasing_id()), "points")
    copies = grid_copies(pts, radius, block)
    pivots, active, dealt, rounds = None, copies, _crowded(copies, block), 0
    while active.where("home").limit(1).count():
        new = cut(_least_hash(active, radius, dealt), "pivots")
        pivots = new if pivots is None else pivots.unionByName(new)
        taken = cut(_closest_pivot(active, new, radius, dealt), "taken")
        last = active
        rounds, active = rounds + 1, cut(active.join(taken.select("id"), "id", "left_anti").select(*active.columns), "active")
        if last is not copies:
            release(last)
    if pivots is None:
        return cut(pts.withColumn("cluster", F.col("id")), "members"), copies
    # After a single round the points are with their closest pivots already.
    near = taken if rounds == 1 else _closest_pivot(copies, pivots, radius, dealt)
    members = pts.join(near.withColumnRenamed("pivot", "cluster"), "id")
    return cut(members, "members"), copies


def contract_links(links: DataFrame) -> DataFrame:
    """(cluster, component) for every cluster in ``links`` (a, b; both directions), by the same
    pivot rounds on the graph: local hash minima absorb their neighbours, links are contracted
    to the pivots, until no link is left."""
    mapping = None
    links = cut(links.distinct(), "links")
    while links.limit(1).count():
        order = F.struct(F.xxhash64(F.lit("contract"), "b").alias("h"), F.col("b").alias("n"))
        mine = F.struct(F.xxhash64(F.lit("contract"), "a").alias("h"), F.col("a").alias("n"))
        nodes = links.groupBy("a").agg(F.min(order).alias("least")).withColumn("mine", mine)
        pivots = nodes.where("mine < least").select("a")
        by = links.join(pivots.withColumnRenamed("a", "b"), "b").groupBy("a").agg(F.min(order).getField("n").alias("to"))
        step = nodes.select("a").join(by, "a", "left").select("a", F.coalesce("to", "a").alias("to"))
        step = cut(step, "step")
        renamed = links.join(step, "a").select(F.col("to").alias("a"), "b")
        renamed = renamed.join(step.select(F.col("a").alias("b"), F.col("to").alias("tb")), "b").select("a", F.col("tb").alias("b"))
        links = cut(renamed.where("a <> b").distinct(), "links")
        if mapping is None:
            mapping = step.select(F.col("a").alias("cluster"), F.col("to").alias("component"))
        else:
            moved = mapping.join(step.withColumnRenamed("a", "component"), "component", "left")
            mapping = cut(moved.select("cluster", F.coalesce("to", "component").alias("component")), "mapping")
    if mapping is None:
        return links.select(F.col("a").alias("cluster"), F.col("b").alias("component"))
    return mapping


def linked_clusters(pts: DataFrame, radius: float, block: int = BLOCK) -> DataFrame:
    """Each point with ``component``: points within ``radius`` of one another, and points that a
    chain of such pairs joins, share it.

    Clusters that share a sub-cell are linked without a distance. What cells then still hold of
    several components is compared point by point.
    """
    members, copies = pivot_clusters(pts, radius, block)
    both = lambda links: links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels, dealt = members.select("id", "cluster"), _crowded(copies, block)
    if dealt:
        home = copies.where("home").select("id", "sub").join(labels, "id")
        shared = home.groupBy("sub").agg(F.min("cluster").alias("least"), F.max("cluster").alias("most")).where("least <> most").select("sub", "least")
        shared = home.join(shared, "sub").where("cluster <> least").select(F.col("cluster").alias("a"), F.col("least").alias("b"))
        labels = _renamed(labels, contract_links(both(shared)))
    links = _cross_links(copies.join(labels, "id"), radius, dealt)
    whole = _renamed(labels, contract_links(both(cut(links, "links"))))
    return members.join(whole.withColumnRenamed("cluster", "component"), "id")


def _renamed(labels: DataFrame, mapping: DataFrame) -> DataFrame:
    return labels.join(mapping, "cluster", "left").select("id", F.coalesce("component", "cluster").alias("cluster"))


def describe_clusters(members: DataFrame, label: str = "cluster", typical: int = 3) -> DataFrame:
    """One row per cluster: ``cluster_name`` (its smallest name), ``size`` (points), ``medoid``
    (the member with the least sum of squared distances to all others, which is the one closest
    to the mean), ``typical`` (the names closest to the mean, in order) and ``spread`` (the root
    mean square distance to the mean). Means are partial sums, so a cluster of any size is never
    in one task."""
    dims = members.select(label, F.posexplode("x").alias("k", "v")).groupBy(label, "k").agg(F.avg("v").alias("m"))
    mean = dims.groupBy(label).agg(F.sort_array(F.collect_list(F.struct("k", "m"))).getField("m").alias("mean"))
    far = F.aggregate(F.zip_with("x", "mean", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, v: s + v)
    rows = members.join(mean, label).select(label, "name", far.alias("far"))
    sizes = rows.groupBy(label).agg(
        F.min("name").alias("cluster_name"), F.count(F.lit(1)).alias("size"), F.sqrt(F.avg("far")).alias("spread")
    )
    first = Window.partitionBy(label).orderBy(F.round("far", 9), "name")
    best = rows.withColumn("r", F.row_number().over(first)).where(F.col("r") <= typical)
    best = best.groupBy(label).agg(F.sort_array(F.collect_list(F.struct("r", "name"))).getField("name").alias("typical"))
    out = sizes.join(best, label)
    return out.select("cluster_name", "size", F.col("typical")[0].alias("medoid"), F.array_join("typical", ",").alias("typical"), "spread")
