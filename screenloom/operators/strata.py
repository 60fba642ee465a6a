"""Knock-out rates by guide abundance: strata per perturbation and deciles over all cells."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from screenloom.functions.pvalues import fisher_greater, student_two_sided
from screenloom.operators.quantiles import quantiles
from screenloom.operators.relational import quantile_bins
from screenloom.session import cut


def abundance_strata(cells: DataFrame, min_cells: int = 100, min_per_group: int = 20) -> DataFrame:
    """Per perturbation of at least ``min_cells`` cells (cell_barcode, perturbation, umi, is_ko;
    control cells removed before): knock-out rates of the cells up to the first and from the
    third quartile of ``umi`` (ties in both), their difference and ratio, and Fisher's one-sided
    test that the upper stratum's odds are greater."""
    # The quartiles and the strata both read the cells.
    cells = cut(cells.select("perturbation", "umi", "is_ko"), "cells")
    sizes = cells.groupBy("perturbation").agg(F.count(F.lit(1)).alias("n_cells")).where(F.col("n_cells") >= min_cells)
    limits = quantiles(cells, ["perturbation"], "umi", [0.25, 0.5, 0.75]).select("perturbation", F.col("q0").alias("q1"), F.col("q1").alias("median_umi"), F.col("q2").alias("q3"))
    limits = limits.join(sizes, "perturbation")
    low, high = F.col("umi") <= F.col("q1"), F.col("umi") >= F.col("q3")
    n = lambda c: F.sum(F.when(c, 1).otherwise(0))
    ko = F.col("is_ko") == 1
    d = cells.join(limits, "perturbation").groupBy("perturbation", "n_cells", "median_umi", "q1", "q3").agg(
        n(low).alias("n_low"), n(high).alias("n_high"), n(low & ko).alias("ko_low"), n(high & ko).alias("ko_high")
    ).where((F.col("n_low") >= min_per_group) & (F.col("n_high") >= min_per_group))
    d = d.withColumn("rate_low", F.col("ko_low") / F.col("n_low")).withColumn("rate_high", F.col("ko_high") / F.col("n_high"))
    d = d.withColumn("delta", F.col("rate_high") - F.col("rate_low")).withColumn("ratio", F.try_divide("rate_high", "rate_low"))
    c = [F.col(x) for x in ("ko_high", "n_high", "ko_low", "n_low")]
    return d.withColumn("p_value", fisher_greater(c[0], c[1] - c[0], c[2], c[3] - c[2]))


def abundance_deciles(cells: DataFrame) -> DataFrame:
    """(umi_decile, n_cells, n_ko, median_guide_umi, mean_guide_umi, ko_rate)."""
    d = quantile_bins(cut(cells.select("umi", "is_ko"), "cells"), "umi", 10, "umi_decile").where("umi_decile IS NOT NULL")
    # Written, so that the edges are looked for once.
    d = cut(d, "deciles")
    per = d.groupBy("umi_decile").agg(
        F.count(F.lit(1)).alias("n_cells"), F.sum("is_ko").cast("bigint").alias("n_ko"),
        F.avg("umi").alias("mean_guide_umi"), F.avg("is_ko").alias("ko_rate"),
    )
    middle = quantiles(d, ["umi_decile"], "umi", [0.5]).select("umi_decile", F.col("q0").alias("median_guide_umi"))
    return per.join(middle, "umi_decile").select("umi_decile", "n_cells", "n_ko", "median_guide_umi", "mean_guide_umi", "ko_rate")


def rank_correlation(df: DataFrame, group: str, a: str, b: str) -> DataFrame:
    """(group, spearman_r, n, p_value) with mid-ranks within each group over rows where both are
    known; p by Student's t with n - 2 degrees of freedom, null below three rows."""
    rows = df.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(group, a, b)
    # Ranks come from one row per distinct value, so that a heavy group is a short list of counts.
    def ranked(c: str) -> DataFrame:
        v = rows.groupBy(group, c).agg(F.count(F.lit(1)).alias("n"))
        w = Window.partitionBy(group).orderBy(c).rowsBetween(Window.unboundedPreceding, 0)
        return v.select(group, c, (F.sum("n").over(w) - F.col("n") + (F.col("n") + 1) / 2).alias(f"rank_{c}"))

    pairs = rows.groupBy(group, a, b).agg(F.count(F.lit(1)).alias("n"))
    d = pairs.join(ranked(a), [group, a]).join(ranked(b), [group, b])
    x, y, n = F.col(f"rank_{a}"), F.col(f"rank_{b}"), F.col("n").cast("double")
    s = d.groupBy(group).agg(F.sum(n).alias("n"), F.sum(n * x).alias("sx"), F.sum(n * y).alias("sy"), F.sum(n * x * x).alias("xx"), F.sum(n * y * y).alias("yy"), F.sum(n * x * y).alias("xy"))
    up = F.col("n") * F.col("xy") - F.col("sx") * F.col("sy")
    under = F.sqrt(F.greatest(F.col("n") * F.col("xx") - F.col("sx") ** 2, F.lit(0.0))) * F.sqrt(F.greatest(F.col("n") * F.col("yy") - F.col("sy") ** 2, F.lit(0.0)))
    out = s.select(group, F.try_divide(up, under).alias("spearman_r"), F.col("n").cast("bigint").alias("n"))
    free = F.greatest(F.col("n") - 2, F.lit(0)).cast("double")
    t = F.col("spearman_r") * F.sqrt(F.try_divide(free, F.lit(1.0) - F.col("spearman_r") * F.col("spearman_r")))
    return out.withColumn("p_value", F.when(F.abs("spearman_r") < 1, student_two_sided(t, free)).when(F.abs("spearman_r") >= 1, F.when(free > 0, 0.0)))

