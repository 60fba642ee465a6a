"""Top N items of every group by statistics-guided skipping.

The rows are clustered by group: range-partitioned and sorted by (group, score descending,
item), so that a heavy group spreads over as many files as its size needs and a rare one shares
its row group with others. Parquet then states the least and greatest group and score of each
row group. A row group that holds one group only and at least N rows proves that the group's
N-th score is no less than the row group's least score; every row group of the same group whose
greatest score is strictly below that bound is never read. The rest is read file by file in
descending greatest score, again skipping what lies strictly below the current N-th score, and
hands on N candidates a group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from screenloom.llm.files import open_file
from screenloom.session import cut, scratch_path

ROW_GROUP_BYTES = 32 << 20


def cluster_by_group(
    df: DataFrame, group: str, item: str, score: str, row_group_bytes: int = ROW_GROUP_BYTES
) -> str:
    """Write the distinct valid (group, item, score) rows clustered by group; returns the path.

    Equal rows meet in one range, so that removing the repeats costs no further shuffle.
    """
    path = scratch_path(df.sparkSession, "clustered")
    rows = df.select(F.col(group).alias("g"), F.col(item).alias("i"), F.col(score).alias("s"))
    rows = rows.where(F.col("g").isNotNull() & F.col("s").isNotNull())
    if dict(rows.dtypes)["s"] in ("double", "float"):
        # Zero has one sign, as in comparisons.
        rows = rows.where(~F.isnan("s")).withColumn("s", F.col("s") + F.lit(0.0).cast(dict(rows.dtypes)["s"]))
    order = [F.col("g"), F.col("s").desc(), F.col("i").asc_nulls_last()]
    ranged = rows.repartitionByRange(*order).dropDuplicates(["g", "s", "i"])
    ranged.sortWithinPartitions(*order).write.option("parquet.block.size", row_group_bytes).parquet(path)
    return path


def _row_groups(files: DataFrame) -> DataFrame:
    """One row per row group with its statistics, null where a file has none."""
    kind = "path string, rg int, n long, one_group boolean, g string, low double, high double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                meta, out = open_file(path).metadata, []
                for k in range(meta.num_row_groups):
                    rg = meta.row_group(k)
                    stats = {rg.column(c).path_in_schema: rg.column(c).statistics for c in range(rg.num_columns)}
                    g, s = stats["g"], stats["s"]
                    known = g is not None and s is not None and g.has_min_max and s.has_min_max
                    one = known and g.min == g.max
                    out.append((path, k, rg.num_rows, one, str(g.min) if one else None, *((float(s.min), float(s.max)) if known else (None, None))))
                if out:
                    types = [pa.string(), pa.int32(), pa.int64(), pa.bool_(), pa.string(), pa.float64(), pa.float64()]
                    names = ["path", "rg", "n", "one_group", "g", "low", "high"]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    return files.mapInArrow(run, kind)


def _first_n(table: pa.Table, n: int) -> pa.Table:
    """The first ``n`` rows of each run of equal groups."""
    codes = pc.run_end_encode(table.column("g").combine_chunks())
    ends = np.asarray(codes.run_ends)
    starts = np.concatenate([[0], ends[:-1]])
    within = np.arange(len(table)) - np.repeat(starts, ends - starts)
    return table.filter(pa.array(within < n))


def _candidates(chosen: DataFrame, n: int, schema: str) -> DataFrame:
    """Up to ``n`` candidates per group and row group read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                file, nth = open_file(row["path"]), {}
                for rg in row["groups"]:
                    if rg["one_group"] and rg["high"] < nth.get(rg["g"], -np.inf):
                        continue
                    table = _first_n(file.read_row_group(rg["rg"], columns=["g", "i", "s"]), n)
                    if rg["one_group"] and len(table) >= n:
                        nth[rg["g"]] = max(nth.get(rg["g"], -np.inf), float(table.column("s")[n - 1].as_py()))
                    yield from table.combine_chunks().to_batches()

    return chosen.mapInArrow(run, schema)


def top_n(df: DataFrame, group: str, item: str, score: str, n: int, row_group_bytes: int = ROW_GROUP_BYTES) -> DataFrame:
    """The ``n`` distinct items with the highest score of each group: (group, item, score,
    rank), ties by item ascending in byte order, a null item last.

    Rows with a null group, a null or a NaN score are no candidates; repeated rows count once;
    an item with two scores is two items. Groups with fewer than ``n`` items come out whole. An
    empty input gives an empty result. ``n`` below one gives an empty result too. Other columns
    of the input are never read, whatever their names.

    The table is clustered first, which is most of the work. A table that is asked often is
    clustered once (``cluster_by_group``) and asked by ``top_n_clustered``.
    """
    path = cluster_by_group(df, group, item, score, row_group_bytes)
    found = top_n_clustered(df.sparkSession, path, n)
    return found.select(F.col("g").alias(group), F.col("i").alias(item), F.col("s").alias(score), "rank")


def top_n_clustered(spark: SparkSession, path: str, n: int) -> DataFrame:
    """(g, i, s, rank) from a table that ``cluster_by_group`` wrote. In it a row group of several
    groups holds the first rows of all of them but one, so that only row groups of one group can
    lie below a bound."""
    clustered = spark.read.parquet(path)
    types = dict(clustered.dtypes)
    files = clustered.inputFiles()
    listed = spark.createDataFrame([(f,) for f in files], "path string")
    listed = listed.repartition(max(1, min(len(files), 4 * spark.sparkContext.defaultParallelism)))
    # One row a row group, written since both the bounds and the choice come from it.
    stats = cut(_row_groups(listed), "statistics")
    floor = stats.where(F.col("one_group") & (F.col("n") >= n)).groupBy("g").agg(F.max("low").alias("floor"))
    # Strictly below only: items that tie with the bound still compete by name.
    chosen = stats.join(floor, "g", "left").where(
        F.col("floor").isNull() | ~F.col("one_group") | (F.col("high") >= F.col("floor"))
    )
    chosen = chosen.groupBy("path").agg(
        F.sort_array(F.collect_list(F.struct("high", "rg", "one_group", "g")), asc=False).alias("groups")
    )
    found = _candidates(chosen, n, f"g {types['g']}, i {types['i']}, s {types['s']}")
    best = Window.partitionBy("g").orderBy(F.col("s").desc(), F.col("i").asc_nulls_last())
    ranked = found.withColumn("r", F.row_number().over(best)).where(F.col("r") <= n)
    return ranked.select("g", "i", "s", F.col("r").alias("rank"))
