"""Over-representation of up- and down-regulated genes in gene sets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from screenloom.functions.columns import as_double, p_column
from screenloom.functions.pvalues import hypergeometric_upper
from screenloom.operators.de import benjamini_hochberg


def regulated_genes(de: DataFrame, min_lfc: float = 0.25, alpha: float = 0.05) -> DataFrame:
    """(perturbation, direction, gene) of rows with finite figures beyond both thresholds."""
    rows = de.select("perturbation", "gene", as_double("logfoldchange").alias("lfc"), as_double(p_column(de.columns)).alias("p")).dropna()
    way = F.when(F.col("lfc") >= min_lfc, "up").when(F.col("lfc") <= -min_lfc, "down")
    return rows.where(F.col("p") <= alpha).select("perturbation", way.alias("direction"), "gene").where("direction IS NOT NULL").distinct()


def over_representation(
    query: DataFrame, sets: DataFrame, universe: DataFrame, min_genes: int = 10, min_size: int = 5, max_size: int = 5000
) -> DataFrame:
    """Terms hit by each (perturbation, direction): counts, enrichment, odds ratio, the
    hypergeometric tail, its adjustment over the terms hit, and the genes.

    Genes outside the universe do not count. The overlap is an equi-join on the gene followed by
    one aggregate; term and query sizes come from their own aggregates, so that no pair of query
    and term without a common gene is ever formed.
    """
    universe = universe.select("gene").where("gene IS NOT NULL").distinct()
    size = universe.agg(F.count(F.lit(1))).scalar()
    query = query.join(universe, "gene", "left_semi").distinct()
    sets = sets.select("term", "gene").distinct().join(universe, "gene", "left_semi")
    queries = query.groupBy("perturbation", "direction").agg(F.count(F.lit(1)).alias("query_size")).where(F.col("query_size") >= min_genes)
    terms = sets.groupBy("term").agg(F.count(F.lit(1)).alias("term_size")).where(F.col("term_size").between(min_size, max_size))
    hits = query.join(sets, "gene").groupBy("perturbation", "direction", "term").agg(
        F.count(F.lit(1)).alias("k_overlap"), F.array_join(F.sort_array(F.collect_set("gene")), ";").alias("hit_genes")
    )
    d = hits.join(queries, ["perturbation", "direction"]).join(terms, "term").withColumn("universe_size", size)
    k, n, m, u = (F.col(c) for c in ("k_overlap", "query_size", "term_size", "universe_size"))
    expected = n * m / u
    odds = ((k + 0.5) * (u - m - n + k + 0.5)) / ((n - k + 0.5) * (m - k + 0.5))
    d = d.select(
        "perturbation", "direction", "term", "k_overlap", "query_size", "term_size", "universe_size",
        expected.alias("expected_overlap"), (k / expected).alias("enrichment_ratio"), odds.alias("odds_ratio"),
        hypergeometric_upper(k, u, m, n).alias("p_value"), "hit_genes",
    )
    return benjamini_hochberg(d, ["perturbation", "direction"], "p_value", "p_adj_bh")


def best_terms(terms: DataFrame, n: int = 50) -> DataFrame:
    """The ``n`` first terms of each (perturbation, direction) by adjusted p, p and name."""
    w = Window.partitionBy("perturbation", "direction").orderBy("p_adj_bh", "p_value", "term")
    return terms.withColumn("__r", F.row_number().over(w)).where(F.col("__r") <= n).drop("__r")


def term_summary(terms: DataFrame, query: DataFrame, alpha: float = 0.05) -> DataFrame:
    """One row per (perturbation, direction) of the query, also where no term was tested."""
    asked = query.groupBy("perturbation", "direction").agg(F.count(F.lit(1)).alias("n_query_genes"))
    found = terms.groupBy("perturbation", "direction").agg(
        F.count(F.lit(1)).alias("n_terms_tested"),
        F.sum(F.when(F.col("p_adj_bh") <= alpha, 1).otherwise(0)).alias("n_terms_fdr_sig"),
        F.min_by("term", F.struct("p_adj_bh", "p_value", "term")).alias("best_term"),
        F.min("p_adj_bh").alias("best_p_adj_bh"),
    )
    out = asked.join(found, ["perturbation", "direction"], "left")
    return out.withColumns({c: F.coalesce(c, F.lit(0)).cast("bigint") for c in ("n_terms_tested", "n_terms_fdr_sig")})


def terms_of_targets(streams: dict[str, DataFrame], targets: DataFrame) -> DataFrame:
    """The terms of the target perturbations in every stream, tagged with ``stream``."""
    wanted = targets.select("perturbation").distinct()
    parts = [t.join(wanted, "perturbation", "left_semi").withColumn("stream", F.lit(name)) for name, t in streams.items()]
    return reduce(DataFrame.unionByName, parts)
