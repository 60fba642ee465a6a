"""Declared schemas of the engine's tables; every operator returns one of these also when empty."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

CELLS = "cell_barcode string, perturbation string"
COUNTS = "cell_barcode string, gene string, value double"
MANIFEST = "cell_barcode string, gene_target string, is_control int"
SELECTED = "cell_barcode string, perturbation string, chunk_id string"
DE = (
    "perturbation string, rank int, gene string, score double, logfoldchange double, pval double,"
    " pval_adj double, pct_nz_group double, pct_nz_reference double"
)
EFFECTS = "perturbation string, n_cells bigint, effect_l2_vs_control double"
ORA_TERMS = (
    "perturbation string, direction string, term string, k_overlap bigint, query_size bigint, term_size bigint,"
    " universe_size bigint, expected_overlap double, enrichment_ratio double, odds_ratio double, p_value double,"
    " p_adj_bh double, hit_genes string"
)
STREAM = "perturbation string, gene string, effect_value double, pval_adj double, rank int, stream string, effect_mode string"


def empty(spark: SparkSession, schema: str) -> DataFrame:
    """A table of no rows with its columns and types."""
    return spark.createDataFrame([], schema)
