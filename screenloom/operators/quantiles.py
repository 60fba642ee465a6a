"""Exact quantiles of columns with any number of different values.

A first pass counts the values by narrow bands that keep their order (a sixty-fourth of a doubling
wide, some thousand at the most), combined map-side. The running counts say in which band a wanted
rank lies, and only the values of those bands are counted one by one in a second pass. A group's
values never meet in one task but for those of one band.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


BANDS = 64


def band_of(v: Column) -> Column:
    """A whole number that rises with the value; infinities have the outermost ones."""
    size = F.abs(v)
    place = F.when(size == 0, 0).when(size == float("inf"), 1 << 20).otherwise(F.floor(F.log2(size) * BANDS) + 80_000)
    return F.when(v < 0, -place).otherwise(place).cast("int")


def quantiles(df: DataFrame, groups: list[str], value: str, qs: list[float]) -> DataFrame:
    """(groups, n, q0, q1, ...): the quantiles ``qs`` of each group, linear between neighbours
    (a quantile that falls on a value, or between equal ones, is that value exactly), and the
    number of values. Nulls and NaN are left out; a null group is a group. Without groups there is
    one row, none where there is no value. ``df`` is read more than once."""
    v = F.col(value).cast("double")
    # Zero has one sign.
    rows = df.where(v.isNotNull() & ~F.isnan(v)).select(*groups, (v + F.lit(0.0)).alias("__v")).withColumn("__b", band_of(F.col("__v")))
    if not groups:
        return _of_all(rows, qs)
    # Some thousand rows a group.
    bands = rows.groupBy(*groups, "__b").agg(F.count(F.lit(1)).alias("__n"))
    whole = Window.partitionBy(*groups)
    upto = whole.orderBy("__b").rowsBetween(Window.unboundedPreceding, 0)
    run = bands.withColumn("n", F.sum("__n").over(whole)).withColumn("__u", F.sum("__n").over(upto))
    place = lambda q: F.lit(float(q)) * (F.col("n") - 1)
    ranks = [F.struct(F.lit(2 * i + s).alias("__k"), f(place(q)).cast("bigint").alias("__r")) for i, q in enumerate(qs) for s, f in enumerate((F.floor, F.ceil))]
    goals = run.select("*", F.inline(F.array(*ranks))).where((F.col("__r") < F.col("__u")) & (F.col("__r") >= F.col("__u") - F.col("__n")))
    names = [f"__g{i}" for i in range(len(groups))]
    goals = goals.select(*[F.col(g).alias(a) for g, a in zip(groups, names)], F.col("__b").alias("__c"), "__k", (F.col("__r") - F.col("__u") + F.col("__n")).alias("__r"), "n")
    same = F.col("__b") == F.col("__c")
    for g, a in zip(groups, names):
        same = same & F.col(g).eqNullSafe(F.col(a))
    near = rows.join(goals.select(*names, "__c").distinct(), same, "left_semi").groupBy(*groups, "__b", "__v").agg(F.count(F.lit(1)).alias("__n"))
    along = Window.partitionBy(*groups, "__b").orderBy("__v").rowsBetween(Window.unboundedPreceding, 0)
    near = near.withColumn("__u", F.sum("__n").over(along))
    hit = near.join(goals, same & (F.col("__r") < F.col("__u")) & (F.col("__r") >= F.col("__u") - F.col("__n")))
    each = hit.groupBy(*groups, "n").agg(*[F.max(F.when(F.col("__k") == k, F.col("__v"))).alias(f"__x{k}") for k in range(2 * len(qs))])
    part = lambda q: place(q) - F.floor(place(q))
    low, high = lambda i: F.col(f"__x{2 * i}"), lambda i: F.col(f"__x{2 * i + 1}")
    between = lambda i, q: F.when(low(i) == high(i), low(i)).otherwise(low(i) + part(q) * (high(i) - low(i)))
    return each.select(*groups, "n", *[between(i, q).alias(f"q{i}") for i, q in enumerate(qs)])


def _of_all(rows: DataFrame, qs: list[float]) -> DataFrame:
    """``quantiles`` without groups: the counts of the bands, some thousand numbers whatever the
    rows, say which bands to look into."""
    counts = sorted((r["__b"], r["count"]) for r in rows.groupBy("__b").count().collect())
    names = ["n", *[f"q{i}" for i in range(len(qs))]]
    schema = "n bigint, " + ", ".join(f"{c} double" for c in names[1:])
    n = sum(c for _, c in counts)
    if not n:
        return rows.sparkSession.createDataFrame([], schema)
    place, goals = [q * (n - 1) for q in qs], {}
    for rank in {r for p in place for r in (math.floor(p), math.ceil(p))}:
        before = 0
        for band, count in counts:
            if rank < before + count:
                goals[rank] = (band, rank - before)
                break
            before += count
    near = rows.where(F.col("__b").isin(sorted({b for b, _ in goals.values()}))).groupBy("__b", "__v").agg(F.count(F.lit(1)).alias("__n"))
    along = Window.partitionBy("__b").orderBy("__v").rowsBetween(Window.unboundedPreceding, 0)
    near = near.withColumn("__u", F.sum("__n").over(along))
    wanted = [(F.col("__b") == b) & (F.col("__u") > r) & (F.col("__u") - F.col("__n") <= r) for b, r in goals.values()]
    found = near.where(reduce(lambda a, b: a | b, wanted)).collect()
    at = {k: next(x["__v"] for x in found if x["__b"] == b and x["__u"] > r >= x["__u"] - x["__n"]) for k, (b, r) in goals.items()}
    low, high = [at[math.floor(p)] for p in place], [at[math.ceil(p)] for p in place]
    between = [a if a == b else a + (p - math.floor(p)) * (b - a) for a, b, p in zip(low, high, place)]
    return rows.sparkSession.createDataFrame([(n, *between)], schema)
