"""The domain objects as views of the given tables, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from screenloom.functions.columns import token_sum
from screenloom.operators.relational import keep_first
from screenloom.session import load

CONTROL, CONTROL_MANY, CONTROL_SIZE = "HOUSEHOLD", "NATION_0", "T0"


def cells(spark: SparkSession, d: str) -> DataFrame:
    """Cells are orders; the perturbation is the customer's segment."""
    o, c = load(spark, d, "orders"), load(spark, d, "customer")
    rows = o.join(c, o.o_custkey == c.c_custkey)
    return rows.select(F.col("o_orderkey").cast("string").alias("cell_barcode"), F.col("c_mktsegment").alias("perturbation"))


def cells_many(spark: SparkSession, d: str) -> DataFrame:
    """Cells with many labels: the customer's nation."""
    o, c, n = load(spark, d, "orders"), load(spark, d, "customer"), load(spark, d, "nation")
    rows = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
    return rows.select(F.col("o_orderkey").cast("string").alias("cell_barcode"), F.col("n_name").alias("perturbation"))


def counts(spark: SparkSession, d: str, fine: bool = False, by_cell: bool = False) -> DataFrame:
    """Counts are line items' quantities per order and brand (with type where ``fine``). Where
    ``by_cell``, a cell's are in one task, so that its sums are formed there."""
    li, p = load(spark, d, "lineitem"), load(spark, d, "part")
    gene = F.concat("p_brand", F.lit("|"), "p_type") if fine else F.col("p_brand")
    rows = li.join(p, li.l_partkey == p.p_partkey).select(F.col("l_orderkey").cast("string").alias("cell_barcode"), gene.alias("gene"), "l_quantity")
    rows = rows.repartition("cell_barcode") if by_cell else rows
    return rows.groupBy("cell_barcode", "gene").agg(F.sum("l_quantity").alias("value"))


def cells_by_size(spark: SparkSession, d: str, made: DataFrame | None = None) -> DataFrame:
    """Cells with labels that show in their counts (``made`` where they are at hand): the band of a
    cell's sum, T0 to T4."""
    sums = (counts(spark, d) if made is None else made).groupBy("cell_barcode").agg(F.sum("value").alias("t"))
    return sums.select("cell_barcode", F.concat(F.lit("T"), F.least(F.lit(4), F.floor(F.col("t") / 50)).cast("string")).alias("perturbation"))


def gene_sets(spark: SparkSession, d: str) -> DataFrame:
    """Overlapping gene sets: the genes of each part size band."""
    p = load(spark, d, "part")
    return p.select(F.concat(F.lit("size_"), F.floor(F.col("p_size") / 5).cast("string")).alias("term"), F.concat("p_brand", F.lit("|"), "p_type").alias("gene")).distinct()


def guide_cells(spark: SparkSession, d: str) -> DataFrame:
    """One row per labelled cell with its guide counts: (cell_barcode, perturbation, umi, is_ko);
    cells are keyed by data set and barcode."""
    key = lambda: F.concat(F.coalesce("dataset", F.lit("")), F.lit("|"), F.upper(F.trim("cell_barcode")))
    labels = load(spark, d, "cell_mixscape_labels").where("cell_barcode IS NOT NULL AND gene_target IS NOT NULL").select(
        key().alias("cell_barcode"), F.lower(F.trim("gene_target", F.lit(" \t"))).alias("perturbation"),
        F.coalesce("is_predicted_perturbed", F.lit(0)).alias("flag"), F.coalesce(F.lower("mixscape_class_global").rlike("ko|perturbed"), F.lit(False)).alias("said"),
        "source_chunk", "loaded_at",
    )
    one = keep_first(labels, ["cell_barcode"], [F.col("source_chunk").asc_nulls_last(), F.col("loaded_at"), F.col("perturbation"), F.col("flag"), F.col("said")])
    calls = load(spark, d, "guide_calls_csv").where("cell_barcode IS NOT NULL AND num_umis IS NOT NULL AND lower(trim(pass_guide_filter)) = 'true'")
    sums = calls.select(key().alias("cell_barcode"), token_sum("num_umis").alias("umi")).groupBy("cell_barcode").agg(F.max("umi").alias("umi"))
    ko = ((F.col("flag") == 1) | F.col("said")).cast("int")
    return one.join(sums, "cell_barcode").select("cell_barcode", "perturbation", F.col("umi").cast("double").alias("umi"), ko.alias("is_ko"))


CELLS_SQL = "cells AS (SELECT CAST(o_orderkey AS VARCHAR) AS cell_barcode, c_mktsegment AS perturbation FROM orders JOIN customer ON o_custkey = c_custkey)"
MANY_SQL = (
    "cells AS (SELECT CAST(o_orderkey AS VARCHAR) AS cell_barcode, n_name AS perturbation FROM orders"
    " JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"
)
COUNTS_SQL = (
    "counts AS (SELECT CAST(l_orderkey AS VARCHAR) AS cell_barcode, p_brand AS gene, sum(l_quantity) AS value"
    " FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL)"
)
SIZE_SQL = (
    "cells AS (SELECT CAST(l_orderkey AS VARCHAR) AS cell_barcode, 'T' || CAST(least(4, floor(sum(l_quantity) / 50))::INTEGER AS VARCHAR) AS perturbation"
    " FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey)"
)
FINE_SQL = (
    "counts AS (SELECT CAST(l_orderkey AS VARCHAR) AS cell_barcode, p_brand || '|' || p_type AS gene, sum(l_quantity) AS value"
    " FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL)"
)
SETS_SQL = "sets AS (SELECT DISTINCT 'size_' || CAST(p_size // 5 AS VARCHAR) AS term, p_brand || '|' || p_type AS gene FROM part)"
GUIDE_SQL = """labels AS (SELECT coalesce(dataset, '') || '|' || upper(trim(cell_barcode)) AS cell_barcode, lower(trim(gene_target, ' ' || chr(9))) AS perturbation,
    coalesce(is_predicted_perturbed, 0) AS flag, coalesce(regexp_matches(lower(mixscape_class_global), 'ko|perturbed'), false) AS said, source_chunk, loaded_at
  FROM cell_mixscape_labels WHERE cell_barcode IS NOT NULL AND gene_target IS NOT NULL),
one AS (SELECT * FROM labels QUALIFY row_number() OVER (PARTITION BY cell_barcode ORDER BY source_chunk NULLS LAST, loaded_at, perturbation, flag, said) = 1),
sums AS (SELECT coalesce(dataset, '') || '|' || upper(trim(cell_barcode)) AS cell_barcode,
    max(coalesce(list_sum(list_transform(regexp_extract_all(num_umis, '\\d+'), lambda x: x::BIGINT)), 0)) AS umi
  FROM guide_calls_csv WHERE cell_barcode IS NOT NULL AND num_umis IS NOT NULL AND lower(trim(pass_guide_filter)) = 'true' GROUP BY 1),
guides AS (SELECT cell_barcode, perturbation, umi::DOUBLE AS umi, (CASE WHEN flag = 1 OR said THEN 1 ELSE 0 END) AS is_ko FROM one JOIN sums USING (cell_barcode))"""
