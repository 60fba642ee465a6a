"""Per-key results when a few keys hold most of the rows.

Every result here is built from mergeable partial states. A task folds its own rows into one
small state per key (Spark's map-side hash aggregate, which spills to a sort when it outgrows
its memory), and only those states are shuffled. A key with a third of all rows therefore costs
its final task one state per input task, never a third of the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from screenloom.session import cut


def label_key(column: Column | str) -> Column:
    """A label without surrounding blanks and tabs, in lower case; null stays null."""
    column = F.col(column) if isinstance(column, str) else column
    return F.lower(F.trim(column, F.lit(" \t")))


def skewed_aggregate(
    df: DataFrame,
    keys: list[str],
    aggregates: dict[str, Column],
    distinct: dict[str, Column] | None = None,
) -> DataFrame:
    """One row per key with algebraic aggregates and exact distinct counts.

    ``aggregates`` maps output names to mergeable aggregates (count, sum, min, max, avg,
    variance). ``distinct`` maps output names to expressions whose distinct non-null values are
    counted. Each of those is first reduced to one row per (key, value), shuffled by both, so
    that the values of one heavy key spread over all tasks; the counts are then combined
    map-side again. An expanded plan with all distinct sets in one shuffle is avoided.

    Null keys form one group. Repeated rows count as often as they occur. An empty input gives
    an empty result. Columns not named are never read.
    """
    out = df.groupBy(*keys).agg(*[c.alias(n) for n, c in aggregates.items()])
    for name, column in (distinct or {}).items():
        values = df.select(*keys, column.alias("__value")).where(F.col("__value").isNotNull())
        counts = values.distinct().groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
        side = counts.select(*[F.col(k).alias(f"__{k}") for k in keys], name)
        same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
        out = out.join(side, same, "left").drop(*[f"__{k}" for k in keys])
        out = out.withColumn(name, F.coalesce(name, F.lit(0)))
    return out


def heavy_keys(df: DataFrame, keys: list[str], percent: float) -> DataFrame:
    """The keys that hold at least ``percent`` per cent of all rows, with ``n_rows``.

    Rows with a null in a key count towards the total but are no result. There are at most
    ``100 / percent`` result rows whatever the size of the input, which makes the result safe
    to broadcast. The counts, one row a key, are written once, since the total comes from them
    too. An empty input has no heavy key.
    """
    counts = cut(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")), "counts")
    total = counts.agg(F.sum("n_rows")).scalar()
    for k in keys:
        counts = counts.where(F.col(k).isNotNull())
    return counts.where(F.col("n_rows") * 100 >= F.lit(percent) * total)
