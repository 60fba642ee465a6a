"""Combining differential-expression streams, comparing methods, and the target-versus-random
tables built from them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from screenloom import schema
from screenloom.functions.columns import as_double, finite, neg_log10
from screenloom.operators.relational import full_outer_chain, pairwise_correlation, top_per_group, z_scores
from screenloom.session import cut
from screenloom.sources.tables import path_exists


def standardize_stream(de: DataFrame, stream: str) -> DataFrame:
    """A stream in the common schema. The effect is the first of logfoldchange, score and
    p_weight with any value in the whole table, else 1 / rank; rows without effect are left out."""
    cols = set(de.columns)
    measures = [c for c in ("logfoldchange", "score", "p_weight") if c in cols]
    if not de.columns or "perturbation" not in cols or "gene" not in cols:
        return schema.empty(de.sparkSession, schema.STREAM)
    mode = None
    if measures:
        seen = de.agg(*[F.count(as_double(c)).alias(c) for c in measures]).first()
        mode = next((c for c in measures if seen[c]), None)
    rank = F.col("rank").try_cast("int") if "rank" in cols else F.lit(None).cast("int")
    effect = as_double(mode) if mode else 1.0 / F.greatest(rank, F.lit(1))
    p = as_double("pval_adj") if "pval_adj" in cols else as_double("pval") if "pval" in cols else F.lit(None).cast("double")
    out = de.select(
        "perturbation", "gene", effect.cast("double").alias("effect_value"), p.alias("pval_adj"), rank.alias("rank"),
        F.lit(stream).alias("stream"), F.lit(mode or "rank").alias("effect_mode"),
    )
    return out.where("effect_value IS NOT NULL AND perturbation IS NOT NULL AND gene IS NOT NULL")


def significant(max_p: float = 0.05, min_effect: float = 0.25, max_rank: int = 100):
    """Whether a stream's row counts: p, where known, up to ``max_p`` (a negative one switches the
    test off); by rank up to ``max_rank`` (0 or less: any) where the effect is the rank, else by
    its size."""
    p = F.lit(True) if max_p < 0 else F.col("pval_adj").isNull() | (F.col("pval_adj") <= max_p)
    rank = F.lit(True) if max_rank <= 0 else F.coalesce(F.col("rank") <= max_rank, F.lit(False))
    return p & F.when(F.col("effect_mode") == "rank", rank).otherwise(F.abs("effect_value") >= min_effect)


def combine_streams(streams: list[DataFrame], n_streams: int | None = None, names: list[str] | None = None, **limits) -> DataFrame:
    """(perturbation, gene, effect_for_cluster, abs_effect, n_streams_detected): effects that are
    not significant count as 0 in the sum, which is divided by the number of streams; the other
    two figures count all rows. With ``names``, all names that streams have, the rows are shuffled
    once: a distinct count would shuffle them by name first. Another name is an error."""
    rows = reduce(DataFrame.unionByName, streams)
    rows = rows.withColumn("counted", F.when(significant(**limits), F.col("effect_value")).otherwise(0.0))
    return rows.groupBy("perturbation", "gene").agg(
        (F.sum("counted") / (n_streams or len(streams))).alias("effect_for_cluster"),
        F.max(F.abs("effect_value")).alias("abs_effect"), _distinct_names("stream", names).alias("n_streams_detected"),
    )


def _distinct_names(column: str, names: list[str] | None) -> Column:
    """The distinct count of a column; of up to 63 known names, by a bit for each."""
    if not names or len(names) > 63:
        return F.count_distinct(column)
    bit = F.when(F.col(column).isNull(), F.lit(0).cast("bigint"))
    for k, name in enumerate(names):
        bit = bit.when(F.col(column) == name, F.lit(1 << k).cast("bigint"))
    other = F.raise_error(F.concat(F.lit("not among the names: "), F.col(column))).cast("bigint")
    return F.bit_count(F.bit_or(bit.otherwise(other))).cast("bigint")


def feature_genes(combined: DataFrame, per_perturbation: int, least: int) -> DataFrame:
    """The genes to cluster on: the strongest ``per_perturbation`` of each perturbation (0: all),
    topped up with the globally strongest until there are ``least``."""
    size = F.abs("effect_for_cluster")
    if per_perturbation <= 0:
        return combined.select("gene").distinct()
    own = cut(top_per_group(combined, ["perturbation"], [size.desc(), F.col("gene")], per_perturbation).select("gene").distinct(), "own")
    have = own.count()
    if have >= least:
        return own
    best = combined.groupBy("gene").agg(F.max(size).alias("m")).join(own, "gene", "left_anti")
    return own.unionByName(best.orderBy(F.col("m").desc(), "gene").limit(least - have).select("gene"))


def effect_matrix(combined: DataFrame, perturbations: DataFrame, genes: DataFrame) -> DataFrame:
    """(perturbation, gene, value) of the chosen rows and genes, zeros left out."""
    rows = combined.join(perturbations.select("perturbation").distinct(), "perturbation", "left_semi").join(genes, "gene", "left_semi")
    return rows.where("effect_for_cluster <> 0").groupBy("perturbation", "gene").agg(F.avg("effect_for_cluster").alias("value"))


def recurrent_genes(combined: DataFrame, targets: DataFrame, share: float = 0.25) -> DataFrame:
    """Genes with a counted effect in at least ``share`` of the targets (one at least)."""
    n = targets.select("perturbation").distinct()
    rows = combined.where("effect_for_cluster <> 0").join(n, "perturbation", "left_semi")
    least = n.agg(F.greatest(F.lit(1), F.ceil(F.lit(share) * F.greatest(F.lit(1), F.count(F.lit(1)))))).scalar()
    return rows.groupBy("gene").agg(F.count_distinct("perturbation").alias("n_perturbations")).where(F.col("n_perturbations") >= least)


def volcano_points(de: DataFrame, recurrent: DataFrame, min_effect: float = 0.25, max_p: float = 0.05) -> DataFrame:
    """The points of a volcano plot: effect, -log10 p, and whether significant and recurrent."""
    p, x = as_double("pval_adj"), as_double("logfoldchange")
    rows = de.select("perturbation", "gene", x.alias("x"), p.alias("p")).dropna()
    sig = (F.col("p") <= max_p) & (F.abs("x") >= min_effect)
    flags = recurrent.select("gene", F.lit(True).alias("is_recurrent"))
    out = rows.select("perturbation", "gene", "x", neg_log10("p").alias("y"), sig.alias("is_significant")).join(flags, "gene", "left")
    return out.withColumn("is_recurrent", F.coalesce("is_recurrent", F.lit(False)))


def volcano_counts(points: DataFrame) -> DataFrame:
    """(perturbation, n_points, n_sig, n_recurrent)."""
    n = lambda c: F.sum(F.col(c).cast("bigint"))
    return points.groupBy("perturbation").agg(F.count(F.lit(1)).alias("n_points"), n("is_significant").alias("n_sig"), n("is_recurrent").alias("n_recurrent"))


def agreeing_cells(a: DataFrame, b: DataFrame, how: str = "intersection") -> DataFrame:
    """Distinct (perturbation, cell_barcode) that both methods, or either, assign."""
    a, b = (x.select("perturbation", "cell_barcode").dropna().distinct() for x in (a, b))
    if how == "intersection":
        return a.join(b, ["perturbation", "cell_barcode"], "left_semi")
    if how == "union":
        return a.unionByName(b).distinct()
    raise ValueError("intersection or union")


def assigned_by_score(scores: DataFrame, score: str, threshold: float = 0.0) -> DataFrame:
    """Distinct (perturbation, cell_barcode) with a score above the threshold."""
    return scores.where(as_double(score) > threshold).select("perturbation", "cell_barcode").dropna().distinct()


def compare_methods(effects: DataFrame, scores: DataFrame, weights: DataFrame, ps: DataFrame, summary: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(long table, correlations): the per-perturbation means of each method side by side with
    their z-scores, and Pearson's r of each pair of metrics."""
    parts = [
        effects.groupBy("perturbation").agg(F.avg("effect_l2_vs_control").alias("mixscape_effect")),
        scores.groupBy("perturbation").agg(F.avg("mixscale_score").alias("mixscale_score_mean")),
        ps.groupBy("perturbation").agg(F.avg("ps_score").alias("ps_score_mean")),
    ]
    best = weights.groupBy("perturbation").agg(F.min(finite(F.col("p_weight"))).alias("mixscale_best_p"))
    table = full_outer_chain(parts, "perturbation").join(best, "perturbation", "left").join(summary, "perturbation", "left")
    metrics = ["mixscape_effect", "mixscale_score_mean", "ps_score_mean", "mean_ps_score"]
    return z_scores(table, metrics), pairwise_correlation(table, metrics)


def volcano_labels(points: DataFrame, n: int = 25) -> DataFrame:
    """The ``n`` points of each perturbation to label, highest ``y`` first, then ``x``, then name."""
    return top_per_group(points, ["perturbation"], [F.col("y").desc(), F.col("x").desc(), F.col("gene")], n)


def read_stream(spark: SparkSession, path: str, stream: str) -> DataFrame:
    """A stream from its file of the best genes, or from the full ranking where that lies beside
    it (``name_full.tsv`` by ``name.tsv``); a missing or empty file gives no rows."""
    stem, dot, end = path.rpartition("/")[2].partition(".")
    full = f"{path[: len(path) - len(stem + dot + end)]}{stem}_full{dot}{end}"
    for p in (full, path):
        if path_exists(spark, p, non_empty=True):
            raw = spark.read.options(header=True, sep="\t").csv(p)
            return standardize_stream(raw, stream)
    return schema.empty(spark, schema.STREAM)
