"""Differential expression of every perturbation against the control cells.

Only non-zero values are ever rows. The control cells of a gene are one histogram shared by all
perturbations: a running sum over a gene's distinct values ranks every perturbation's values
against it, so neither the control cells nor the zeros are repeated per perturbation. The values
of a gene are cut into narrow bands, each ranked on its own from the number of control cells in
the bands below, so that no task holds a gene.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from screenloom.functions.columns import finite
from screenloom.functions.pvalues import normal_two_sided, student_two_sided
from screenloom.session import cut

TINY = 1e-9
#: Bands of values to a doubling, and steps to one in which values are compared.
BANDS, STEPS = 64, 2.0**30


def rank_sums(counts: DataFrame, cells: DataFrame, control: str, tie_correct: bool = False) -> DataFrame:
    """(perturbation, gene, n_group, n_control, rank_sum, z, mean and share figures) of every
    perturbation and gene with a value in either; cells (cell_barcode, perturbation) name each
    cell once. Values must not be negative; zeros may be stored or not. Values are compared in
    steps of 2^-30, so that equal ratios are ties however they were rounded. A row of ``cells``
    with a column ``n`` stands for so many cells."""
    each = F.col("n") if "n" in cells.columns else F.lit(1).cast("bigint").alias("n")
    cells = cells.where("perturbation IS NOT NULL").select("cell_barcode", "perturbation", each)
    sizes = cells.groupBy("perturbation").agg(F.sum("n").alias("n1"))
    n0 = sizes.where(F.col("perturbation") == control).agg(F.max("n1")).scalar()
    near = F.rint(F.col("value") * STEPS) / STEPS
    rows = counts.where("value > 0").withColumn("value", F.when(near > 0, near).otherwise(F.col("value"))).join(cells, "cell_barcode")
    band = F.floor(F.log2("value") * BANDS).cast("int").alias("band")
    hist = rows.groupBy("gene", "perturbation", "value").agg(F.sum("n").alias("n")).select("*", band)
    # Both uses share one shuffle by (gene, band).
    hist = hist.repartition("gene", "band")
    is_control = F.col("perturbation") == control
    ctl = F.when(is_control, F.col("n")).otherwise(0)
    below = Window.partitionBy("gene").orderBy("band").rowsBetween(Window.unboundedPreceding, -1)
    opening = hist.groupBy("gene", "band").agg(F.sum(ctl).alias("c"))
    opening = opening.select("gene", "band", F.coalesce(F.sum("c").over(below), F.lit(0)).alias("opening"))
    upto = Window.partitionBy("gene", "band").orderBy("value").rangeBetween(Window.unboundedPreceding, 0)
    same = Window.partitionBy("gene", "band", "value")
    ranked = hist.withColumn("ceq", F.sum(ctl).over(same)).withColumn("cbelow", F.sum(ctl).over(upto) - F.col("ceq"))
    ranked = ranked.join(opening, ["gene", "band"])
    cube = lambda t: t * t * t - t
    g = F.col("n").cast("double")
    v = F.col("value")
    per = ranked.groupBy("gene", "perturbation").agg(
        F.sum("n").alias("nz"),
        F.sum(g * (F.col("opening") + F.col("cbelow") + F.col("ceq") / 2)).alias("wins"),
        F.sum(cube(g + F.col("ceq")) - cube(F.col("ceq").cast("double"))).alias("ties"),
        F.sum(g * v).alias("s"), F.sum(g * v * v).alias("ss"), F.sum(cube(g)).alias("own_ties"),
    )
    # One row per gene and perturbation, written since four branches read it.
    per = cut(per, "sums")
    base = per.where(is_control).select("gene", F.col("nz").alias("nz0"), F.col("s").alias("s0"), F.col("ss").alias("ss0"), F.col("own_ties").alias("ties0"))
    # Every gene meets every perturbation: the result's own size. The labels are one short list.
    names = sizes.where(~is_control).agg(F.sort_array(F.collect_list("perturbation"))).scalar()
    genes = per.select("gene").distinct().join(base, "gene", "left")
    grid = genes.withColumn("__names", names).withColumn("perturbation", F.explode("__names")).drop("__names")
    full = grid.join(per.where(~is_control), ["gene", "perturbation"], "left").join(sizes, "perturbation").withColumn("n0", n0)
    full = full.fillna(0, ["nz", "wins", "ties", "s", "ss", "nz0", "s0", "ss0", "ties0"]).where("n0 > 0")
    n1, n0c = F.col("n1").cast("double"), F.col("n0").cast("double")
    z1, z0 = n1 - F.col("nz"), n0c - F.col("nz0")
    total = n1 + n0c
    u = F.col("wins") + F.col("nz") * z0 + z1 * z0 / 2
    variance = n1 * n0c * (total + 1) / 12
    if tie_correct:
        tied = F.col("ties") + F.col("ties0") + cube(z1 + z0)
        variance = variance - F.coalesce(F.try_divide(n1 * n0c * tied, 12 * total * (total - 1)), F.lit(0.0))
    return full.select(
        "perturbation", "gene", F.col("n1").alias("n_group"), F.col("n0").alias("n_control"),
        (u + n1 * (n1 + 1) / 2).alias("rank_sum"),
        F.coalesce(F.try_divide(u - n1 * n0c / 2, F.sqrt(F.greatest(variance, F.lit(0.0)))), F.lit(0.0)).alias("z"),
        (F.col("s") / n1).alias("mean_group"), (F.col("s0") / n0c).alias("mean_control"),
        F.greatest(F.try_divide(F.col("ss") - F.col("s") * F.col("s") / n1, n1 - 1), F.lit(0.0)).alias("var_group"),
        F.greatest(F.try_divide(F.col("ss0") - F.col("s0") * F.col("s0") / n0c, n0c - 1), F.lit(0.0)).alias("var_control"),
        (F.col("nz") / n1).alias("pct_nz_group"), (F.col("nz0") / n0c).alias("pct_nz_reference"),
    )


def benjamini_hochberg(df: DataFrame, groups: list[str], p: str, out: str = "pval_adj") -> DataFrame:
    """Step-up adjusted p-values within ``groups``, clipped at 1; a null p stays null and does
    not count."""
    known = F.when(F.col(p).isNotNull(), 1)
    w = Window.partitionBy(*groups)
    order = w.orderBy(F.col(p).asc_nulls_last())
    d = df.withColumn("__m", F.count(p).over(w)).withColumn("__k", F.sum(known).over(order.rangeBetween(Window.unboundedPreceding, 0)))
    raw = F.col(p) * F.col("__m") / F.col("__k")
    back = w.orderBy(F.col(p).desc_nulls_last()).rangeBetween(Window.unboundedPreceding, 0)
    return d.withColumn(out, F.when(F.col(p).isNotNull(), F.least(F.min(raw).over(back), F.lit(1.0)))).drop("__m", "__k")


def welch(mean1: str, var1: str, n1: str, mean0: str, var0: str, n0: str):
    """(t, degrees of freedom) of Welch's test from moments; null where they are undefined."""
    a, b = F.col(var1) / F.col(n1), F.col(var0) / F.col(n0)
    t = F.try_divide(F.col(mean1) - F.col(mean0), F.sqrt(a + b))
    df = F.try_divide((a + b) * (a + b), F.try_divide(a * a, F.col(n1) - 1) + F.try_divide(b * b, F.col(n0) - 1))
    return finite(t), finite(df)


def differential_expression(counts: DataFrame, cells: DataFrame, control: str, method: str = "wilcoxon", tie_correct: bool = False) -> DataFrame:
    """The full ranking in the DE schema: genes of each perturbation by score descending, ties by
    name. ``counts`` are normalised log1p values. Methods: ``wilcoxon`` and ``t-test``."""
    stats = rank_sums(counts, cells, control, tie_correct)
    if method == "wilcoxon":
        stats = stats.withColumn("score", F.col("z")).withColumn("pval", normal_two_sided("score"))
    elif method == "t-test":
        t, df = welch("mean_group", "var_group", "n_group", "mean_control", "var_control", "n_control")
        stats = stats.withColumn("score", t).withColumn("pval", student_two_sided(t, df))
    else:
        raise ValueError(f"unknown method {method}")
    lfc = F.log2((F.expm1("mean_group") + TINY) / (F.expm1("mean_control") + TINY))
    stats = benjamini_hochberg(stats.withColumn("logfoldchange", lfc), ["perturbation"], "pval")
    rank = F.row_number().over(Window.partitionBy("perturbation").orderBy(F.col("score").desc_nulls_last(), "gene"))
    return stats.select(
        "perturbation", rank.alias("rank"), "gene", "score", "logfoldchange", "pval", "pval_adj", "pct_nz_group", "pct_nz_reference"
    )
