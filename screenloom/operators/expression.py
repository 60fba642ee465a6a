"""Cells-by-genes counts as long triplets (cell_barcode, gene, value); zeros are not stored."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from screenloom.operators.quantiles import quantiles
from screenloom.session import cut


def normalize_total(counts: DataFrame, target: float | None = None, cell: str = "cell_barcode") -> DataFrame:
    """Each cell's values scaled to sum to ``target``, or to the median of the positive cell sums
    where no target is given. A cell whose sum is zero stays as it is."""
    total = F.sum("value").over(Window.partitionBy(cell))
    rows = counts.withColumn("__t", total)
    if target is None:
        sums = cut(counts.groupBy(cell).agg(F.sum("value").alias("t")).where("t > 0"), "sums")
        goal = quantiles(sums, [], "t", [0.5]).agg(F.max("q0")).scalar()
    else:
        goal = F.lit(float(target))
    scaled = F.when(F.col("__t") > 0, F.col("value") * goal / F.col("__t")).otherwise(F.col("value"))
    return rows.withColumn("value", scaled).drop("__t")


def log1p(counts: DataFrame) -> DataFrame:
    return counts.withColumn("value", F.log1p("value"))


def pseudobulk(counts: DataFrame, cells: DataFrame, group: str = "perturbation") -> DataFrame:
    """(group, gene, value): the values of each group's cells added up."""
    rows = counts.join(cells.select("cell_barcode", group).where(F.col(group).isNotNull()), "cell_barcode")
    return rows.groupBy(group, "gene").agg(F.sum("value").alias("value"))


def pseudobulk_expression(bulk: DataFrame, group: str = "perturbation", target: float = 10_000.0, log: bool = True) -> DataFrame:
    """Group profiles scaled to ``target`` (a sum of zero or less counts as one), then log1p."""
    total = F.sum("value").over(Window.partitionBy(group))
    scaled = F.col("value") * target / F.when(total <= 0, 1.0).otherwise(total)
    return bulk.withColumn("value", F.log1p(scaled) if log else scaled)


def gene_stats(counts: DataFrame, n_cells: int) -> DataFrame:
    """Per gene the cells with a value, the mean and the sample variance over all ``n_cells``,
    zeros included, all from sums. Where ``counts`` has a column ``n``, a row stands for so many."""
    v, n = F.col("value"), F.col("n") if "n" in counts.columns else F.lit(1)
    sums = counts.where("value <> 0").groupBy("gene").agg(
        F.sum(n).alias("n_nonzero"), F.sum(v * n).alias("s"), F.sum(v * v * n).alias("ss")
    )
    mean = F.col("s") / n_cells
    variance = F.try_divide(F.col("ss") - F.col("s") * mean, F.lit(n_cells - 1))
    return sums.select("gene", "n_nonzero", mean.alias("mean"), F.greatest(variance, F.lit(0.0)).alias("variance"))


def highly_variable(stats: DataFrame, n_top: int, bins: int = 20) -> DataFrame:
    """``stats`` with the dispersion (variance by mean), its z-score among genes of like mean
    and ``is_hvg`` for the ``n_top`` greatest. Genes are binned by equal steps of log mean."""
    d = stats.withColumn("dispersion", F.try_divide("variance", "mean")).withColumn("__m", F.log1p("mean"))
    span = d.agg(F.struct(F.min("__m").alias("a"), F.max("__m").alias("b"))).scalar()
    d = d.withColumn("__s", span)
    step = F.coalesce(F.try_divide((F.col("__m") - F.col("__s.a")) * bins, F.col("__s.b") - F.col("__s.a")), F.lit(0.0))
    d = d.withColumn("__bin", F.least(F.floor(step), F.lit(bins - 1)))
    per = d.groupBy("__bin").agg(F.avg("dispersion").alias("__avg"), F.stddev_samp("dispersion").alias("__sd"))
    # A bin of one gene has no deviation; its gene counts as one deviation above.
    norm = F.when(F.coalesce("__sd", F.lit(0.0)) > 0, (F.col("dispersion") - F.col("__avg")) / F.col("__sd")).otherwise(1.0)
    out = d.join(per, "__bin").withColumn("dispersion_norm", norm).drop("__bin", "__m", "__s", "__avg", "__sd")
    best = out.orderBy(F.col("dispersion_norm").desc_nulls_last(), "gene").limit(n_top).select("gene", F.lit(True).alias("is_hvg"))
    return out.join(best, "gene", "left").withColumn("is_hvg", F.coalesce("is_hvg", F.lit(False)))


def standardize_genes(matrix: DataFrame, group: str, n_groups: int) -> DataFrame:
    """Each gene's values less its mean over all groups by its population deviation (1 where it
    is 0), absent entries counting as zeros: (group, gene, value, zero) where ``zero`` is the
    value that an absent entry of the gene would have. Distances between groups are those of
    ``value - zero``, whose absent entries are 0."""
    per = matrix.groupBy("gene").agg(F.sum("value").alias("s"), F.sum(F.col("value") * F.col("value")).alias("ss"))
    mean = F.col("s") / n_groups
    sd = F.sqrt(F.greatest(F.col("ss") / n_groups - mean * mean, F.lit(0.0)))
    per = per.select("gene", mean.alias("m"), F.when(sd > 1e-12, sd).otherwise(1.0).alias("sd"))
    rows = matrix.join(per, "gene")
    return rows.select(group, "gene", ((F.col("value") - F.col("m")) / F.col("sd")).alias("value"), (-F.col("m") / F.col("sd")).alias("zero"))


def integer_like(df: DataFrame, column: str) -> DataFrame:
    """One row: n, the share of values that are whole numbers, their least and greatest."""
    v = F.col(column)
    near = F.when(F.abs(v - F.round(v)) <= 1e-8, 1.0).otherwise(0.0)
    return df.where(v.isNotNull()).agg(F.count(F.lit(1)).alias("n"), F.avg(near).alias("integer_share"), F.min(v).alias("low"), F.max(v).alias("high"))


def budgeted_genes(ranked: DataFrame, budget: int, max_genes: int = 0) -> DataFrame:
    """Genes in order of ``position`` while the non-zeros so far fit in ``budget``: a running sum,
    so that a gene that would exceed it ends the list. (gene, position, n_nonzero)"""
    # Positions are cut into ranges; each starts at the total of the ranges before it.
    width = 1024
    rows = ranked.withColumn("__b", F.floor((F.col("position") - 1) / width))
    sums = rows.groupBy("__b").agg(F.sum("n_nonzero").alias("__s"))
    before = sums.withColumn("__o", F.coalesce(F.sum("__s").over(Window.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    run = F.sum("n_nonzero").over(Window.partitionBy("__b").orderBy("position"))
    out = rows.join(before.drop("__s"), "__b").withColumn("__run", run + F.col("__o")).where(F.col("__run") <= budget)
    out = out.where(F.col("position") <= max_genes) if max_genes > 0 else out
    return out.select("gene", "position", "n_nonzero")


#: Factors by which the cap on one gene's non-zeros is raised until enough genes are candidates.
CAP_FACTORS = (1, 2, 4, 8, 16, 32, 64, 128)


def greedy_genes(ranked: DataFrame, budget: int, max_genes: int) -> DataFrame:
    """(gene, position, n_nonzero) of at most ``max_genes`` genes in order of ``position`` whose
    non-zeros fit in ``budget``: a gene that would exceed it is skipped and the next is tried.
    Genes under a cap come first (the even share, raised until a third of ``max_genes`` and 100
    are under it), then the others with what is left. The choice is sequential over one row per
    gene, which one task holds."""
    cap = max(1, budget // max(1, max_genes))
    enough = max(100, max_genes // 3)

    def choose(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf[pdf["n_nonzero"] > 0].sort_values("position", ignore_index=True)
        n = pdf["n_nonzero"].to_numpy()
        top = next((cap * f for f in CAP_FACTORS if (n <= cap * f).sum() >= enough), cap * CAP_FACTORS[-1])
        picked, total = [], 0
        for i in [*np.flatnonzero(n <= top), *np.flatnonzero(n > top)]:
            if len(picked) < max_genes and total + n[i] <= budget:
                picked.append(i)
                total += n[i]
        return pdf.iloc[sorted(picked)]

    rows = ranked.select("gene", F.col("position").cast("bigint").alias("position"), F.col("n_nonzero").cast("bigint").alias("n_nonzero"))
    return rows.groupBy().applyInPandas(choose, rows.schema)


def gene_scores(matrix: DataFrame, n_groups: int, how: str = "variance") -> DataFrame:
    """(gene, score): the mean size or the sample variance of each gene over ``n_groups`` groups;
    entries that are not stored are zeros."""
    v = F.col("value")
    sums = matrix.groupBy("gene").agg(F.sum(F.abs(v)).alias("a"), F.sum(v).alias("s"), F.sum(v * v).alias("ss"))
    if how == "mean_abs":
        return sums.select("gene", (F.col("a") / n_groups).alias("score"))
    if how != "variance":
        raise ValueError("variance or mean_abs")
    return sums.select("gene", F.greatest(F.try_divide(F.col("ss") - F.col("s") * F.col("s") / n_groups, F.lit(n_groups - 1)), F.lit(0.0)).alias("score"))


def gene_bytes(counts: DataFrame, per_value: int = 12) -> DataFrame:
    """(gene, n_nonzero, n_bytes): what a gene's values take as triplets."""
    per = counts.where("value <> 0").groupBy("gene").agg(F.count(F.lit(1)).alias("n_nonzero"))
    return per.withColumn("n_bytes", F.col("n_nonzero") * per_value)


def cell_quality(counts: DataFrame, marked: str = "MT-") -> DataFrame:
    """(cell_barcode, total_counts, n_genes, share_marked): a cell's sum, its genes with a value,
    and the share of its counts on genes whose names start with ``marked``."""
    v = F.col("value")
    own = F.sum(F.when(F.upper("gene").startswith(marked.upper()), v).otherwise(0.0))
    per = counts.where("value <> 0").groupBy("cell_barcode").agg(F.sum(v).alias("total_counts"), F.count(F.lit(1)).alias("n_genes"), own.alias("m"))
    return per.select("cell_barcode", "total_counts", "n_genes", F.try_divide("m", "total_counts").alias("share_marked"))


def quality_report(quality: DataFrame) -> DataFrame:
    """One row: cells, and the least, mean and greatest of their sums and genes."""
    parts = [f(c).alias(f"{n}_{c}") for c in ("total_counts", "n_genes") for n, f in (("min", F.min), ("mean", F.avg), ("max", F.max))]
    return quality.agg(F.count(F.lit(1)).alias("n_cells"), *parts, F.avg("share_marked").alias("mean_share_marked"))
