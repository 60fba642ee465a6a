"""Percentiles of very large numeric columns by radix selection.

A number becomes an integer of 64 bits that sorts like it (sign, exponent, mantissa). The
integer is read in digits from the top. Counting the values per digit (a histogram that merges
by addition, combined map-side) shows which digit holds the wanted rank; only the values that
share it go on to the next digit. After the last digit the value is exact. After ``bits`` bits
it is known up to the bits not read: for a normal number within a relative error of
2^-(bits - 12).

The integers are made once; all counting is built-in expressions and partial aggregates.

Null and NaN values are left out; a null group is a group. Repeated rows count as often as they
occur. The percentile q is the value of rank ceil(n * q / 100), the first for q = 0. An empty
input gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import LongType

from screenloom.session import cut

#: Bits of each digit from the top; the first holds sign, exponent and 4 bits of the mantissa.
DIGITS = (16, 16, 16, 16)
#: Bits of a mergeable histogram: sign, exponent, and 9 bits of the mantissa.
SKETCH_BITS = 21
#: Targets up to this number are sent to all tasks; more are joined through a shuffle.
MOST_TARGETS = 200_000
_MANTISSA = 2.0**52


@pandas_udf(LongType())
def _ordered(x: pd.Series) -> pd.Series:
    bits = (x.to_numpy(np.float64) + 0.0).view(np.int64)
    return pd.Series(np.where(bits < 0, -(bits & np.int64((1 << 63) - 1)), bits))


def ordered(column: Column | str) -> Column:
    """The order-preserving integer of a double: equal numbers, equal integers; -0.0 is 0. A
    view of the same 64 bits, Arrow-batched: built from powers and logarithms in the JVM it is an
    expression too long to be compiled, and took several microseconds a row."""
    return _ordered(F.col(column) if isinstance(column, str) else column)


def number(code: Column | str) -> Column:
    """The double of an order-preserving integer."""
    code = F.col(code) if isinstance(code, str) else code
    size = F.abs(code)
    e = F.shiftright(size, 52).cast("int")
    part = size.bitwiseAND(F.lit((1 << 52) - 1)).cast("double") / F.lit(_MANTISSA)
    half = F.floor((e - 1023) / 2).cast("int")
    value = (part + 1.0) * F.pow(F.lit(2.0), half) * F.pow(F.lit(2.0), e - 1023 - half)
    tiny = size.cast("double") * F.lit(2.0**-537) * F.lit(2.0**-537)
    value = F.when(e >= 2047, F.lit(float("inf"))).when(e == 0, tiny).otherwise(value)
    return F.when(code < 0, -value).otherwise(value)


def _ranks(n: Column, percents: list[int]) -> Column:
    """Structs (percentile, rank) with the rank by whole-number arithmetic."""
    rank = lambda q: F.greatest(F.lit(1), F.floor((n * q + 99) / 100)).cast("bigint")
    return F.array(*[F.struct(F.lit(q).alias("percentile"), rank(q).alias("rank")) for q in percents])


def _match(a: str, b: str, groups: list[str]) -> Column:
    out = F.lit(True)
    for g in groups:
        out = out & F.col(f"{a}.{g}").eqNullSafe(F.col(f"{b}.{g}"))
    return out


def digit_histogram(df: DataFrame, groups: list[str], value: str, bits: int = SKETCH_BITS) -> DataFrame:
    """The mergeable state: rows (groups, digit, n). States of separate partitions, files or days
    are combined by ``merge_histograms``. At most 2^bits rows a group, in practice the few
    hundred digits its values have."""
    x = F.col(value).cast("double")
    rows = df.where(x.isNotNull() & ~F.isnan(x)).select(*groups, F.shiftright(ordered(x), 64 - bits).alias("digit"))
    return rows.groupBy(*groups, "digit").agg(F.count(F.lit(1)).alias("n"))


def merge_histograms(states: DataFrame, groups: list[str]) -> DataFrame:
    """States of the finer groups added up to ``groups``."""
    return states.groupBy(*groups, "digit").agg(F.sum("n").alias("n"))


def _locate(hist: DataFrame, targets: DataFrame | None, groups: list[str], percents: list[int]) -> DataFrame:
    """For every target the digit that holds its rank, and its rank within the digit: (groups,
    percentile, total, digit, rank, n). ``hist`` has a ``prefix`` of the digits before."""
    key = [*groups, "prefix"]
    w = Window.partitionBy(*key).orderBy("digit").rowsBetween(Window.unboundedPreceding, 0)
    run = hist.withColumn("upto", F.sum("n").over(w)).withColumn("total", F.sum("n").over(Window.partitionBy(*key)))
    if targets is None:
        goals = run.select("*", F.inline(_ranks(F.col("total"), percents)))
        hit = goals.where((F.col("rank") <= F.col("upto")) & (F.col("rank") > F.col("upto") - F.col("n")))
        return hit.select(*groups, "percentile", "total", "digit", (F.col("rank") - F.col("upto") + F.col("n")).alias("rank"), "n")
    a, b = run.alias("a"), targets.alias("b")
    on = _match("a", "b", groups) & (F.col("a.prefix") == F.col("b.digit"))
    on = on & (F.col("b.rank") <= F.col("a.upto")) & (F.col("b.rank") > F.col("a.upto") - F.col("a.n"))
    rank = F.col("b.rank") - F.col("a.upto") + F.col("a.n")
    return a.join(b, on).select(*[F.col(f"b.{g}") for g in groups], "b.percentile", "b.total", "a.digit", rank.alias("rank"), "a.n")


def percentiles_of_histogram(hist: DataFrame, groups: list[str], percents: list[int], bits: int = SKETCH_BITS) -> DataFrame:
    """(groups, percentile, n_values, value, low, high): the percentile lies in [low, high], the
    values that share its digit; ``value`` is their middle."""
    found = _locate(hist.withColumn("prefix", F.lit(0).cast("bigint")), None, groups, percents)
    low = F.shiftleft(F.col("digit"), 64 - bits)
    out = found.select(
        *groups, "percentile", F.col("total").alias("n_values"),
        number(low).alias("low"), number(low + F.lit((1 << (64 - bits)) - 1)).alias("high"),
    )
    return out.withColumn("value", (F.col("low") + F.col("high")) / 2).select(*groups, "percentile", "n_values", "value", "low", "high")


def radix_percentiles(
    df: DataFrame, groups: list[str], value: str, percents: list[int], digits: tuple[int, ...] = DIGITS
) -> DataFrame:
    """Exact percentiles: (groups, percentile, n_values, value).

    The groups and integers are written once; then one pass over them per digit. Later passes keep only the values under a target's
    prefix; the targets are at most len(percents) a group and are sent to the tasks while few
    (counted first). All digits are counted with partial aggregates, so that neither a heavy
    group nor a crowded digit meets in one task.
    """
    x = F.col(value).cast("double")
    rows = cut(df.where(x.isNotNull() & ~F.isnan(x)).select(*groups, ordered(x).alias("code")), "codes")
    targets, left = None, 64
    for width in digits:
        left -= width
        part = rows.withColumn("digit", F.shiftright("code", left))
        if targets is None:
            part = part.withColumn("prefix", F.lit(0).cast("bigint"))
        else:
            wanted = targets.select(*groups, F.col("digit").alias("prefix")).distinct()
            few = wanted.limit(MOST_TARGETS + 1).count() <= MOST_TARGETS
            part = part.withColumn("prefix", F.shiftright("code", left + width))
            on = _match("v", "t", groups) & (F.col("v.prefix") == F.col("t.prefix"))
            part = part.alias("v").join((F.broadcast(wanted) if few else wanted).alias("t"), on, "left_semi")
        hist = part.groupBy(*groups, "prefix", "digit").agg(F.count(F.lit(1)).alias("n"))
        targets = _locate(hist, targets, groups, percents)
        if left:
            targets = cut(targets, "targets")
    return targets.select(*groups, "percentile", F.col("total").alias("n_values"), number("digit").alias("value"))

