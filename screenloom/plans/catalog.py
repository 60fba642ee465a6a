"""Queries of the engine's own operators over the given tables, with their SQL oracles.

Names carry the operator's group and number: s sources, k sinks, f filters, j joins, a aggregates, w
windows, o ordering, u sets, h reshaping, r samples, n numerics, v audit, c composites.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from screenloom.functions.columns import as_double, is_true, token_sum
from screenloom.functions.pvalues import fisher_greater
from screenloom.operators import audit, models, ora, sampling, similarity, strata, streams
from screenloom.operators import de as de_ops
from screenloom.operators import effects as fx
from screenloom.operators import expression as ex
from screenloom.operators import relational as rel
from screenloom.operators.quantiles import quantiles
from screenloom.plans import composites as co
from screenloom.plans import sqlparts as sq
from screenloom.plans.views import CELLS_SQL, CONTROL, CONTROL_MANY, CONTROL_SIZE, COUNTS_SQL, FINE_SQL, GUIDE_SQL, MANY_SQL, SETS_SQL, SIZE_SQL
from screenloom.plans.views import cells, cells_by_size, cells_many, counts, gene_sets, guide_cells
from screenloom.session import cut, load, scratch_path
from screenloom.sources import sinks, tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


# Sources and sinks: tables written and read in the formats of screens.


@query("SELECT cell_barcode, gene_target, num_umis, count(*) AS n FROM guide_calls_csv WHERE cell_barcode IS NOT NULL AND gene_target IS NOT NULL AND num_umis <> '' GROUP BY ALL")
def s05_guide_scan(spark, d):
    path = scratch_path(spark, "guides")
    quoted = {"header": True, "escape": '"', "compression": "gzip", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    load(spark, d, "guide_calls_csv").select("cell_barcode", "gene_target", "num_umis", "call_id").dropna().where("num_umis <> ''").write.options(**quoted).csv(path)
    rows = tables.read_table(spark, path, "cell_barcode string, gene_target string, num_umis string", sep=",")
    return rows.groupBy("cell_barcode", "gene_target", "num_umis").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT perturbation, gene, score, count(*) AS n FROM perturbation_differential_genes WHERE perturbation IS NOT NULL AND score IS NOT NULL AND NOT isnan(score) GROUP BY ALL")
def s06_tsv_round_trip(spark, d):
    path = scratch_path(spark, "de")
    rows = load(spark, d, "perturbation_differential_genes").select("perturbation", "gene", "score")
    sinks.write_tsv(rows.where("perturbation IS NOT NULL AND score IS NOT NULL AND NOT isnan(score)"), path, gzip=True)
    back = tables.read_table(spark, path, "perturbation string, gene string, score double")
    return back.groupBy("perturbation", "gene", "score").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {MANY_SQL} SELECT cell_barcode, perturbation FROM cells")
def s07_union_of_chunks(spark, d):
    """A folder a label, written in one job, and one that is missing."""
    base = scratch_path(spark, "chunks")
    rows = cells_many(spark, d).withColumn("chunk", F.xxhash64("perturbation"))
    rows.write.partitionBy("chunk").options(header=True, sep="\t").csv(base)
    return tables.read_many(spark, [f"{base}/{n}" for n in [*tables.chunk_ids(spark, base, "*.csv"), "none"]], "cell_barcode string, perturbation string")


@query(f"WITH {MANY_SQL} SELECT cell_barcode, perturbation FROM cells")
def s07_all_chunks(spark, d):
    """The chunks of all labels, and one that is missing."""
    base = scratch_path(spark, "chunks")
    rows = cut(cells_many(spark, d), "cells")
    labels = [r[0] for r in load(spark, d, "nation").select("n_name").distinct().orderBy("n_name").collect()]
    for n, label in enumerate(labels):
        sinks.write_tsv(rows.where(F.col("perturbation") == label), f"{base}/{n}")
    return tables.read_many(spark, [f"{base}/{n}" for n in range(len(labels) + 1)], "cell_barcode string, perturbation string")


@query("SELECT 'sets:' || p_brand AS term, p_type AS gene FROM part GROUP BY ALL")
def s09_gene_set_file(spark, d):
    path = scratch_path(spark, "gmt")
    lines = load(spark, d, "part").groupBy("p_brand").agg(F.array_sort(F.collect_set("p_type")).alias("g"))
    lines.select(F.concat_ws("\t", "p_brand", F.lit("from part"), F.array_join("g", "\t"))).write.text(path)
    found = tables.read_gene_sets(spark, [path])
    return found.select(F.concat(F.lit("sets"), F.regexp_extract("term", ":.*$", 0)).alias("term"), "gene")


@query(f"WITH {CELLS_SQL}, {COUNTS_SQL} SELECT cell_barcode, gene, value FROM counts WHERE cell_barcode IN (SELECT cell_barcode FROM cells WHERE perturbation = 'BUILDING')")
def s17_load_by_barcodes(spark, d):
    return tables.select_barcodes(counts(spark, d), cells(spark, d).where("perturbation = 'BUILDING'"))


@query("""SELECT cell_barcode, gene_target, num_umis FROM (SELECT upper(trim(cell_barcode)) AS cell_barcode, gene_target, num_umis, call_id, loaded_at FROM guide_calls_csv
WHERE lower(trim(pass_guide_filter)) = 'true' AND upper(trim(cell_barcode)) IN (SELECT upper(trim(cell_barcode)) FROM obs_cells))
QUALIFY row_number() OVER (PARTITION BY cell_barcode ORDER BY call_id, loaded_at) = 1""")
def s21_guide_filter(spark, d):
    calls = load(spark, d, "guide_calls_csv").withColumn("cell_barcode", F.upper(F.trim("cell_barcode")))
    keep = load(spark, d, "obs_cells").select(F.upper(F.trim("cell_barcode")).alias("cell_barcode"))
    return tables.filtered_guide_calls(calls, keep, is_true("pass_guide_filter"), [F.col("call_id"), F.col("loaded_at")]).select("cell_barcode", "gene_target", "num_umis")


@query("SELECT cell_barcode, gene_target FROM obs_cells")
def s04_label_scan(spark, d):
    return tables.label_scan(load(spark, d, "obs_cells"), "cell_barcode", "gene_target")


@query("SELECT c_custkey, c_acctbal, 'c_mktsegment=' || c_mktsegment AS source_chunk FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')")
def s08_finished_chunks(spark, d):
    """Of the folders of all segments two are marked as finished."""
    root = scratch_path(spark, "chunks")
    load(spark, d, "customer").select("c_custkey", "c_acctbal", "c_mktsegment").write.partitionBy("c_mktsegment").options(header=True, sep="\t").csv(root)
    for done in ("BUILDING", "MACHINERY"):
        sinks.mark_done(spark, f"{root}/c_mktsegment={done}")
    return tables.read_finished_chunks(spark, root, "*.csv", "c_custkey bigint, c_acctbal double")


@query("""SELECT (row_number() OVER (ORDER BY perturbation DESC) - 1)::INTEGER AS ord, perturbation
FROM (SELECT DISTINCT trim(perturbation) AS perturbation FROM perturbation_clusters WHERE trim(perturbation) <> '' AND trim(perturbation) NOT LIKE '#%')""")
def s10_target_list(spark, d):
    """The list is written in falling order, with a comment and a blank line after each symbol."""
    path = scratch_path(spark, "targets")
    names = load(spark, d, "perturbation_clusters").select(F.trim("perturbation").alias("perturbation")).where("perturbation <> '' AND NOT startswith(perturbation, '#')")
    lines = names.orderBy(F.col("perturbation").desc()).select(F.explode(F.array("perturbation", F.concat(F.lit("# "), "perturbation"), F.lit(" "))).alias("perturbation"))
    sinks.write_list(lines, "perturbation", path)
    return tables.read_target_list(spark, path)


@query("SELECT c_custkey, c_nationkey, n_name AS label FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_nationkey < 20) ON c_nationkey = n_nationkey")
def s14_decode_categories(spark, d):
    known = load(spark, d, "nation").where("n_nationkey < 20").select(F.col("n_nationkey").alias("code"), F.col("n_name").alias("label"))
    return tables.decode_categories(load(spark, d, "customer").select("c_custkey", "c_nationkey"), "c_nationkey", known)


@query(f"WITH {COUNTS_SQL} SELECT cell_barcode, gene, value FROM counts ORDER BY cell_barcode, gene LIMIT 1000")
def s15_matrix_sample(spark, d):
    return tables.matrix_sample(counts(spark, d), 1000)


_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query(f"""WITH {CELLS_SQL}, {COUNTS_SQL} SELECT gene, {", ".join(f"coalesce(sum(value) FILTER (perturbation = '{s}'), 0) AS {s}" for s in _SEGMENTS)}
FROM counts JOIN cells USING (cell_barcode) GROUP BY 1""")
def k09_wide_matrix(spark, d):
    path = scratch_path(spark, "wide")
    sinks.write_wide(ex.pseudobulk(counts(spark, d), cells(spark, d)), "gene", "perturbation", "value", _SEGMENTS, path)
    return tables.read_table(spark, path, "gene string, " + ", ".join(f"{s} double" for s in _SEGMENTS))


# Filters.


@query("SELECT call_id, CASE WHEN isfinite(try_cast(num_umis AS DOUBLE)) THEN try_cast(num_umis AS DOUBLE) END AS n FROM guide_calls_csv")
def f02_lenient_cast(spark, d):
    return load(spark, d, "guide_calls_csv").select("call_id", as_double("num_umis").alias("n"))


@query("SELECT call_id, CASE WHEN isfinite(try_cast(num_umis AS DOUBLE)) THEN try_cast(num_umis AS DOUBLE) END AS n FROM guide_calls_csv")
def f02_lenient_cast_all(spark, d):
    return load(spark, d, "guide_calls_csv").select("call_id", as_double("num_umis").alias("n"))


@query("SELECT dataset, cell_barcode, gene_target FROM chunk_cells WHERE cell_barcode IS NOT NULL AND gene_target IS NOT NULL AND dataset IS NOT NULL")
def f03_drop_null_keys(spark, d):
    return load(spark, d, "chunk_cells").select("dataset", "cell_barcode", "gene_target").dropna()


@query(f"WITH {MANY_SQL} SELECT perturbation, count(*) AS n_cells FROM cells GROUP BY 1 HAVING count(*) >= 30")
def f07_min_cells(spark, d):
    return rel.min_count(cells_many(spark, d), "perturbation", 30)


@query("""SELECT dataset, count(*) AS n, sum(CASE WHEN regexp_matches(lower(mixscape_class_global), 'ko|perturbed') AND lower(trim(gene_target, ' ' || chr(9))) <> 'scramble' THEN 1 ELSE 0 END)::BIGINT AS n_perturbed
FROM cell_mixscape_labels GROUP BY 1""")
def f09_label_mask(spark, d):
    rows = load(spark, d, "cell_mixscape_labels")
    control = F.lower(F.trim("gene_target", F.lit(" \t"))) == "scramble"
    mask = rel.perturbed_mask(rows, ["mixscape_class_global", "mixscape_class"], F.coalesce(control, F.lit(True)))
    return rows.groupBy("dataset").agg(F.count(F.lit(1)).alias("n"), F.sum(mask.cast("int")).alias("n_perturbed"))


@query("""SELECT DISTINCT perturbation, CASE WHEN logfoldchange >= 0.25 THEN 'up' ELSE 'down' END AS direction, gene FROM perturbation_differential_genes
WHERE pval_adj <= 0.05 AND abs(logfoldchange) >= 0.25 AND perturbation IS NOT NULL AND gene IS NOT NULL AND NOT isnan(logfoldchange)""")
def f11_up_down_genes(spark, d):
    return ora.regulated_genes(load(spark, d, "perturbation_differential_genes"))


@query("""SELECT dataset, sum(CASE WHEN lower(trim(pass_guide_filter)) = 'true' THEN 1 ELSE 0 END)::BIGINT AS n_pass, count(*) AS n FROM guide_calls_csv GROUP BY 1""")
def f15_boolean_text(spark, d):
    rows = load(spark, d, "guide_calls_csv")
    return rows.groupBy("dataset").agg(F.sum(is_true("pass_guide_filter").cast("int")).alias("n_pass"), F.count(F.lit(1)).alias("n"))


@query("""SELECT perturbation, gene, logfoldchange AS effect_value, (pval_adj IS NULL OR pval_adj <= 0.05) AND abs(logfoldchange) >= 0.25 AS is_significant
FROM (SELECT DISTINCT perturbation, gene, logfoldchange, pval_adj FROM perturbation_differential_genes) WHERE perturbation IS NOT NULL AND gene IS NOT NULL AND logfoldchange IS NOT NULL AND NOT isnan(logfoldchange)""")
def f18_significance(spark, d):
    rows = load(spark, d, "perturbation_differential_genes").select("perturbation", "gene", "logfoldchange", "pval_adj").distinct()
    return streams.standardize_stream(rows, "global_de").select("perturbation", "gene", "effect_value", streams.significant().alias("is_significant"))


# Joins.


@query(f"WITH {CELLS_SQL}, {COUNTS_SQL} SELECT cell_barcode, perturbation FROM cells WHERE cell_barcode IN (SELECT cell_barcode FROM counts WHERE value > 100)")
def j01_semi(spark, d):
    return tables.select_barcodes(cells(spark, d), counts(spark, d).where("value > 100"))


@query(f"WITH {CELLS_SQL}, {COUNTS_SQL}, t AS (SELECT cell_barcode, sum(value) AS total FROM counts GROUP BY 1) SELECT cell_barcode, perturbation, total FROM cells LEFT JOIN t USING (cell_barcode)")
def j04_left(spark, d):
    totals = counts(spark, d).groupBy("cell_barcode").agg(F.sum("value").alias("total"))
    return cells(spark, d).join(totals, "cell_barcode", "left")


_SIDES = """a AS (SELECT gene_target AS k, count(*) AS n_a FROM obs_cells WHERE gene_target IS NOT NULL GROUP BY 1),
b AS (SELECT gene_target AS k, count(*) AS n_b FROM chunk_cells WHERE gene_target IS NOT NULL GROUP BY 1)"""


@query(f"WITH {_SIDES} SELECT k, n_a, n_b FROM a FULL JOIN b USING (k)")
def j05_full_outer(spark, d):
    side = lambda t, n: rel.min_count(load(spark, d, t), "gene_target", 1, out=n).withColumnRenamed("gene_target", "k")
    return rel.full_outer_chain([side("obs_cells", "n_a"), side("chunk_cells", "n_b")], "k")


@query(f"WITH {GUIDE_SQL} SELECT perturbation, count(*) AS n, sum(umi) AS umi FROM guides GROUP BY 1")
def j06_inner_qa(spark, d):
    return guide_cells(spark, d).groupBy("perturbation").agg(F.count(F.lit(1)).alias("n"), F.sum("umi").alias("umi"))


@query("SELECT DISTINCT gene_target FROM chunk_cells WHERE gene_target IS NOT NULL AND gene_target NOT IN (SELECT gene_target FROM obs_cells WHERE gene_target IS NOT NULL)")
def j07_anti(spark, d):
    rows = load(spark, d, "chunk_cells").select("gene_target").where("gene_target IS NOT NULL").distinct()
    return rows.join(load(spark, d, "obs_cells").select("gene_target"), "gene_target", "left_anti")


_METHODS = """a AS (SELECT DISTINCT c_mktsegment AS perturbation, CAST(o_orderkey AS VARCHAR) AS cell_barcode FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus = 'F'),
b AS (SELECT DISTINCT c_mktsegment AS perturbation, CAST(o_orderkey AS VARCHAR) AS cell_barcode FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_totalprice > 100000)"""


def _methods(spark, d):
    o, c = load(spark, d, "orders"), load(spark, d, "customer")
    rows = o.join(c, o.o_custkey == c.c_custkey).select(F.col("c_mktsegment").alias("perturbation"), F.col("o_orderkey").cast("string").alias("cell_barcode"), "o_orderstatus", "o_totalprice")
    return rows.where("o_orderstatus = 'F'"), streams.assigned_by_score(rows, "o_totalprice", 100000.0)


@query(f"WITH {_METHODS} SELECT * FROM a INTERSECT SELECT * FROM b")
def j10_agree_intersect(spark, d):
    return streams.agreeing_cells(*_methods(spark, d), "intersection")


@query(f"WITH {_METHODS} SELECT * FROM a UNION SELECT * FROM b")
def j10_agree_union(spark, d):
    return streams.agreeing_cells(*_methods(spark, d), "union")


_MANIFEST = f"""{MANY_SQL},
kept AS (SELECT perturbation, (row_number() OVER (ORDER BY perturbation) - 1) // 8 AS i FROM (SELECT perturbation FROM cells WHERE perturbation <> '{CONTROL_MANY}' GROUP BY 1 HAVING count(*) >= 30)),
sample AS (SELECT cell_barcode, perturbation FROM cells WHERE perturbation = '{CONTROL_MANY}' ORDER BY md5('7|' || cell_barcode), cell_barcode LIMIT 50),
m AS (SELECT 'chunk_' || lpad(CAST(i AS VARCHAR), 4, '0') AS chunk_id, cell_barcode, perturbation AS gene_target, 0 AS is_control FROM cells JOIN kept USING (perturbation)
  UNION ALL SELECT 'chunk_' || lpad(CAST(i AS VARCHAR), 4, '0'), cell_barcode, perturbation, 1 FROM sample, (SELECT DISTINCT i FROM kept))"""


def _manifest(spark, d):
    return co.build_manifest(cells_many(spark, d).withColumnRenamed("perturbation", "gene_target"), CONTROL_MANY, 8, 30, 50, 7)


@query(f"WITH {_MANIFEST} SELECT chunk_id, cell_barcode, is_control FROM m WHERE is_control = 1")
def j11_control_replicate(spark, d):
    return _manifest(spark, d).where("is_control = 1").select("chunk_id", "cell_barcode", "is_control")


_BULK = f"{CELLS_SQL}, {COUNTS_SQL}, bulk AS (SELECT perturbation, gene, sum(value) AS value FROM counts JOIN cells USING (cell_barcode) GROUP BY ALL)"


@query(f"WITH {_BULK} SELECT a.perturbation AS group_a, b.perturbation AS group_b, round(sqrt(sum((a.value - b.value) ** 2)), 3) AS distance FROM bulk a JOIN bulk b USING (gene) GROUP BY ALL")
def j14_pair_distance(spark, d):
    bulk = ex.pseudobulk(counts(spark, d), cells(spark, d))
    return similarity.profile_distances(bulk, "perturbation", bulk).select("group_a", "group_b", F.round("distance", 3).alias("distance"))


@query("""SELECT (SELECT count(DISTINCT gene_target) FROM obs_cells) AS n_a, (SELECT count(DISTINCT gene_target) FROM chunk_cells) AS n_b,
(SELECT count(DISTINCT gene_target) FROM obs_cells WHERE gene_target IN (SELECT gene_target FROM chunk_cells)) AS n_both,
round((SELECT count(DISTINCT gene_target) FROM obs_cells WHERE gene_target IN (SELECT gene_target FROM chunk_cells)) * 100.0::DOUBLE / (SELECT count(DISTINCT gene_target) FROM obs_cells), 6) AS percent_of_a""")
def j15_list_overlap(spark, d):
    out = rel.overlap_report(load(spark, d, "obs_cells"), load(spark, d, "chunk_cells"), "gene_target")
    return out.withColumn("percent_of_a", F.round("percent_of_a", 6))


# Aggregates.


@query("SELECT coalesce(gene_target, '<NA>') AS gene_target, count(*) AS n FROM chunk_cells GROUP BY 1")
def a01_counts(spark, d):
    return load(spark, d, "chunk_cells").groupBy(F.coalesce("gene_target", F.lit("<NA>")).alias("gene_target")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT chunk_id, count(DISTINCT cell_barcode) AS n_cells, count(DISTINCT gene_target) AS n_targets FROM chunk_cells GROUP BY 1")
def a03_distinct(spark, d):
    return load(spark, d, "chunk_cells").groupBy("chunk_id").agg(F.count_distinct("cell_barcode").alias("n_cells"), F.count_distinct("gene_target").alias("n_targets"))


@query("SELECT perturbation, min(pval) AS best_p, max(abs(logfoldchange)) AS most FROM perturbation_differential_genes WHERE logfoldchange IS NOT NULL AND NOT isnan(logfoldchange) GROUP BY 1")
def a06_minmax(spark, d):
    rows = load(spark, d, "perturbation_differential_genes").where("logfoldchange IS NOT NULL AND NOT isnan(logfoldchange)")
    return rows.groupBy("perturbation").agg(F.min("pval").alias("best_p"), F.max(F.abs("logfoldchange")).alias("most"))


_STREAMS = """base AS (SELECT DISTINCT perturbation, gene, logfoldchange, score, pval_adj FROM perturbation_differential_genes WHERE perturbation IS NOT NULL AND gene IS NOT NULL),
s AS (SELECT perturbation, gene, logfoldchange AS e, pval_adj AS p, 'global_de' AS stream FROM base WHERE logfoldchange IS NOT NULL AND NOT isnan(logfoldchange)
  UNION ALL SELECT perturbation, gene, score, NULL, 'mixscape' FROM base WHERE score IS NOT NULL AND NOT isnan(score)),
c AS (SELECT perturbation, gene, sum(CASE WHEN (p IS NULL OR p <= 0.05) AND abs(e) >= 0.25 THEN e ELSE 0 END) / 2 AS effect_for_cluster,
  max(abs(e)) AS abs_effect, count(DISTINCT stream) AS n_streams_detected FROM s GROUP BY ALL)"""


def _combined(spark, d):
    # Read by both streams, and once before for the measure each has.
    rows = cut(load(spark, d, "perturbation_differential_genes").select("perturbation", "gene", "logfoldchange", "score", "pval_adj").distinct(), "rows")
    two = [streams.standardize_stream(rows.drop("score"), "global_de"), streams.standardize_stream(rows.select("perturbation", "gene", "score"), "mixscape")]
    return streams.combine_streams(two, names=["global_de", "mixscape"])


@query(f"WITH {_STREAMS} SELECT perturbation, gene, round(effect_for_cluster, 6) AS effect_for_cluster, abs_effect, n_streams_detected FROM c")
def a07_stream_agg(spark, d):
    return _combined(spark, d).withColumn("effect_for_cluster", F.round("effect_for_cluster", 6))


@query("SELECT dataset, count(DISTINCT source_chunk) AS n_chunks, round(avg(ko_rate), 6) AS mean_rate, median(n_cells) AS median_cells FROM hct_mixscape_ko_by_umi_decile GROUP BY 1")
def a08_multi(spark, d):
    rows = load(spark, d, "hct_mixscape_ko_by_umi_decile")
    return rows.groupBy("dataset").agg(F.count_distinct("source_chunk").alias("n_chunks"), F.round(F.avg("ko_rate"), 6).alias("mean_rate"), F.median("n_cells").alias("median_cells"))


@query("SELECT c_mktsegment, round(quantile_cont(o_totalprice, 0.9), 4) AS q FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1")
def a09_quantile(spark, d):
    o, c = load(spark, d, "orders"), load(spark, d, "customer")
    prices = cut(o.join(c, o.o_custkey == c.c_custkey).select("c_mktsegment", "o_totalprice"), "prices")
    return quantiles(prices, ["c_mktsegment"], "o_totalprice", [0.9]).select("c_mktsegment", F.round("q0", 4).alias("q"))


@query("SELECT event_type, round(stddev_pop(value), 6) AS sd0, round(stddev_samp(value), 6) AS sd1, round(var_samp(value), 4) AS v1 FROM events GROUP BY 1")
def a10_deviation(spark, d):
    return load(spark, d, "events").groupBy("event_type").agg(
        F.round(F.stddev_pop("value"), 6).alias("sd0"), F.round(F.stddev_samp("value"), 6).alias("sd1"), F.round(F.var_samp("value"), 4).alias("v1")
    )


@query("""SELECT * FROM (SELECT 'effect_l2_vs_control' AS metric_a, 'n_cells' AS metric_b, round(corr(effect_l2_vs_control, n_cells), 6) AS pearson_r, count(*) FILTER (effect_l2_vs_control IS NOT NULL AND n_cells IS NOT NULL) AS n FROM perturbation_clusters
UNION ALL SELECT 'effect_l2_vs_control', 'delta_pc1', round(corr(effect_l2_vs_control, delta_pc1), 6), count(*) FILTER (effect_l2_vs_control IS NOT NULL AND delta_pc1 IS NOT NULL) FROM perturbation_clusters
UNION ALL SELECT 'n_cells', 'delta_pc1', round(corr(n_cells, delta_pc1), 6), count(*) FILTER (n_cells IS NOT NULL AND delta_pc1 IS NOT NULL) FROM perturbation_clusters)""")
def a11_pearson(spark, d):
    rows = load(spark, d, "perturbation_clusters").withColumn("n_cells", F.col("n_cells").cast("double"))
    return rel.pairwise_correlation(rows, ["effect_l2_vs_control", "n_cells", "delta_pc1"]).withColumn("pearson_r", F.round("pearson_r", 6))


@query("""WITH r AS (SELECT dataset, rank() OVER (PARTITION BY dataset ORDER BY n_cells) + (count(*) OVER (PARTITION BY dataset, n_cells) - 1) / 2 AS a,
  rank() OVER (PARTITION BY dataset ORDER BY ko_rate) + (count(*) OVER (PARTITION BY dataset, ko_rate) - 1) / 2 AS b
  FROM hct_mixscape_ko_by_umi_decile WHERE n_cells IS NOT NULL AND ko_rate IS NOT NULL)
SELECT dataset, round(c, 6) AS spearman_r, n, round(""" + sq.student_two_sided("(c * sqrt((n - 2) / (1 - c * c)))", "(n - 2.0::DOUBLE)") + """, 6) AS p_value FROM (SELECT dataset, corr(a, b) AS c, count(*) AS n FROM r GROUP BY 1)""")
def a12_spearman(spark, d):
    out = strata.rank_correlation(load(spark, d, "hct_mixscape_ko_by_umi_decile"), "dataset", "n_cells", "ko_rate")
    return out.withColumns({c: F.round(c, 6) for c in ("spearman_r", "p_value")})


@query("SELECT coalesce(gene_target, '<NA>') AS label, count(*) AS n FROM cell_mixscape_labels GROUP BY 1 ORDER BY n DESC, label LIMIT 20")
def a13_top20(spark, d):
    return audit.top_labels(load(spark, d, "cell_mixscape_labels"), "gene_target")


_VECTORS = """v AS (SELECT CAST(label AS VARCHAR) AS perturbation, unnest(embedding) AS x, unnest(range(1, len(embedding) + 1)) AS k FROM embeddings),
m AS (SELECT perturbation, k, avg(x::DOUBLE) AS m, count(*) AS n FROM v GROUP BY ALL)"""


def _vectors(spark, d):
    return load(spark, d, "embeddings").select(F.col("vec_id").cast("string").alias("cell_barcode"), F.col("label").cast("string").alias("perturbation"), F.col("embedding").cast("array<double>").alias("x"))


@query(f"""WITH {_VECTORS} SELECT a.perturbation, max(a.n) AS n_cells, round(sqrt(sum((a.m - b.m) ** 2)), 6) AS effect_l2_vs_control
FROM m a JOIN m b ON a.k = b.k AND b.perturbation = '0' GROUP BY 1""")
def a14_effect_vectors(spark, d):
    return fx.centroid_deltas(_vectors(spark, d), "0").select("perturbation", "n_cells", F.round("effect_l2_vs_control", 6).alias("effect_l2_vs_control"))


_WELCH_DF = "((a.v / a.n + b.v / b.n) ** 2 / ((a.v / a.n) ** 2 / (a.n - 1) + (b.v / b.n) ** 2 / (b.n - 1)))"


@query(f"""WITH s AS (SELECT CAST(label AS VARCHAR) AS perturbation, avg(embedding[1]::DOUBLE) AS m, var_samp(embedding[1]::DOUBLE) AS v, count(*)::DOUBLE AS n FROM embeddings GROUP BY 1),
w AS (SELECT a.perturbation, (a.m - b.m) / sqrt(a.v / a.n + b.v / b.n) AS t, {_WELCH_DF} AS df FROM s a JOIN s b ON b.perturbation = '0' WHERE a.perturbation <> '0')
SELECT perturbation, round(t, 6) AS t, round({sq.student_two_sided("t", "df")}, 6) AS p_value FROM w""")
def a15_welch_t(spark, d):
    out = fx.first_component_test(_vectors(spark, d), "0").where("perturbation <> '0'")
    return out.select("perturbation", F.round("pc1_t_stat_vs_control", 6).alias("t"), F.round("pc1_p_value_vs_control", 6).alias("p_value"))


@query("""SELECT gene_target AS perturbation, count(*) AS n_cells, sum(is_predicted_perturbed)::BIGINT AS n_predicted_perturbed,
round(sum(is_predicted_perturbed) / count(*), 6) AS frac_predicted_perturbed FROM (SELECT gene_target, CASE WHEN is_predicted_perturbed = 1 THEN 1 ELSE 0 END AS is_predicted_perturbed FROM cell_mixscape_labels WHERE gene_target IS NOT NULL) GROUP BY 1""")
def a16_ko_fraction(spark, d):
    rows = load(spark, d, "cell_mixscape_labels").withColumnRenamed("gene_target", "perturbation")
    return fx.perturbed_fraction(rows, F.col("is_predicted_perturbed") == 1).withColumn("frac_predicted_perturbed", F.round("frac_predicted_perturbed", 6))


@query("""WITH t AS (SELECT dataset, sum(n_ko) FILTER (umi_decile >= 5) AS a, sum(n_cells - n_ko) FILTER (umi_decile >= 5) AS b, sum(n_ko) FILTER (umi_decile < 5) AS c, sum(n_cells - n_ko) FILTER (umi_decile < 5) AS e
  FROM hct_mixscape_ko_by_umi_decile WHERE umi_decile IS NOT NULL AND n_ko IS NOT NULL AND n_cells IS NOT NULL GROUP BY 1),
u AS (SELECT dataset, a::BIGINT AS a, (a + b)::BIGINT AS n, (a + c)::BIGINT AS m, (a + b + c + e)::BIGINT AS u FROM t),
x AS (SELECT dataset, a, n, m, u, unnest(range(a, least(n, m) + 1)) AS k FROM u)
SELECT dataset, round(least(1, sum(exp(lgamma(m + 1) - lgamma(k + 1) - lgamma(m - k + 1) + lgamma(u - m + 1) - lgamma(n - k + 1) - lgamma(u - m - n + k + 1) - lgamma(u + 1) + lgamma(n + 1) + lgamma(u - n + 1)))), 5) AS p_value
FROM x WHERE u - m - n + k >= 0 GROUP BY dataset""")
def a17_fisher(spark, d):
    return fisher_of_deciles(load(spark, d, "hct_mixscape_ko_by_umi_decile")).withColumn("p_value", F.round("p_value", 5))


def fisher_of_deciles(rows: DataFrame) -> DataFrame:
    """(dataset, p_value): whether the upper five deciles have more KO cells, of all days and
    datasets whatever their counts; a side without cells counts as zeros."""
    rows = rows.where("umi_decile IS NOT NULL AND n_ko IS NOT NULL AND n_cells IS NOT NULL")
    high, rest = F.col("umi_decile") >= 5, F.col("n_cells") - F.col("n_ko")
    s = lambda c, v: F.coalesce(F.sum(F.when(c, v)), F.lit(0))
    t = rows.groupBy("dataset").agg(s(high, F.col("n_ko")).alias("a"), s(high, rest).alias("b"), s(~high, F.col("n_ko")).alias("c"), s(~high, rest).alias("e"))
    return t.select("dataset", fisher_greater("a", "b", "c", "e").alias("p_value"))


@query(ORACLES["a17_fisher"])
def a17_fisher_all(spark, d):
    return a17_fisher(spark, d)


_DE_SQL = f"""{CELLS_SQL}, {COUNTS_SQL},
size AS (SELECT perturbation, count(*) AS n1 FROM cells GROUP BY 1),
r AS (SELECT gene, perturbation, value FROM counts JOIN cells USING (cell_barcode) WHERE value > 0),
h AS (SELECT gene, perturbation, value, count(*) AS n FROM r GROUP BY ALL),
hc AS (SELECT gene, value, n FROM h WHERE perturbation = '{CONTROL}'),
u AS (SELECT h.gene, h.perturbation, sum(h.n) AS nz, sum(h.n * (coalesce((SELECT sum(n) FROM hc WHERE hc.gene = h.gene AND hc.value < h.value), 0)
  + coalesce((SELECT sum(n) FROM hc WHERE hc.gene = h.gene AND hc.value = h.value), 0) / 2)) AS wins FROM h WHERE perturbation <> '{CONTROL}' GROUP BY ALL),
z AS (SELECT gene, sum(n) AS nz0 FROM hc GROUP BY 1),
w AS (SELECT u.perturbation, u.gene, u.nz, z.nz0, s1.n1, s0.n1 AS n0, u.wins + u.nz * (s0.n1 - z.nz0) + (s1.n1 - u.nz) * (s0.n1 - z.nz0) / 2 AS uu
  FROM u JOIN z USING (gene) JOIN size s1 ON s1.perturbation = u.perturbation JOIN size s0 ON s0.perturbation = '{CONTROL}')"""


@query(f"""WITH {_DE_SQL} SELECT perturbation, gene, round(uu + n1 * (n1 + 1) / 2, 3) AS rank_sum, round((uu - n1 * n0 / 2) / sqrt(n1 * n0 * (n1 + n0 + 1) / 12), 6) AS z,
round(nz / n1, 6) AS pct_nz_group, round(nz0 / n0, 6) AS pct_nz_reference FROM w""")
def a21_ranksum_z(spark, d):
    out = de_ops.rank_sums(counts(spark, d), cells(spark, d), CONTROL)
    return out.select("perturbation", "gene", F.round("rank_sum", 3).alias("rank_sum"), *[F.round(c, 6).alias(c) for c in ("z", "pct_nz_group", "pct_nz_reference")])


@query("""WITH t AS (SELECT perturbation, gene, p, rank() OVER (PARTITION BY perturbation ORDER BY p) + count(*) OVER (PARTITION BY perturbation, p) - 1 AS k, count(*) OVER (PARTITION BY perturbation) AS m
  FROM (SELECT perturbation, gene, min(pval) AS p FROM perturbation_differential_genes WHERE pval IS NOT NULL AND NOT isnan(pval) GROUP BY ALL))
SELECT perturbation, gene, p, round(least(1, min(p * m / k) OVER (PARTITION BY perturbation ORDER BY p DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)), 9) AS q FROM t""")
def a20_bh(spark, d):
    rows = load(spark, d, "perturbation_differential_genes").where("pval IS NOT NULL AND NOT isnan(pval)").groupBy("perturbation", "gene").agg(F.min("pval").alias("p"))
    return de_ops.benjamini_hochberg(rows, ["perturbation"], "p", "q").withColumn("q", F.round("q", 9))


@query(f"WITH {_BULK} SELECT perturbation, gene, value FROM bulk")
def a24_pseudobulk(spark, d):
    return ex.pseudobulk(counts(spark, d), cells(spark, d))


@query(f"WITH {COUNTS_SQL}, t AS (SELECT count(DISTINCT cell_barcode) AS n FROM counts) SELECT gene, count(*) AS n_nonzero, round(sum(value) / max(t.n), 6) AS mean, round((sum(value * value) - sum(value) * sum(value) / max(t.n)) / (max(t.n) - 1), 4) AS variance FROM counts, t WHERE value <> 0 GROUP BY 1")
def a25_gene_nonzeros(spark, d):
    rows = counts(spark, d)
    out = ex.gene_stats(rows, rows.select("cell_barcode").distinct().count())
    return out.select("gene", "n_nonzero", F.round("mean", 6).alias("mean"), F.round("variance", 4).alias("variance"))


@query("SELECT count(*) AS n, round(avg(CASE WHEN abs(x - round(x)) <= 1e-8 THEN 1.0 ELSE 0.0 END)::DOUBLE, 6) AS integer_share, min(x) AS low, max(x) AS high FROM (SELECT median_guide_umi AS x FROM hct_mixscape_ko_by_umi_decile WHERE NOT isnan(median_guide_umi))")
def a26_integer_like(spark, d):
    rows = load(spark, d, "hct_mixscape_ko_by_umi_decile").where("NOT isnan(median_guide_umi)")
    return ex.integer_like(rows, "median_guide_umi").withColumn("integer_share", F.round("integer_share", 6))


@query("SELECT dataset, round(sum(n_ko) / sum(n_cells), 6) AS ko_rate, round(avg(CASE WHEN n_ko > 10 THEN 1.0 ELSE 0.0 END)::DOUBLE, 6) AS share_over_10 FROM hct_mixscape_ko_by_umi_decile GROUP BY 1")
def a27_ratios(spark, d):
    rows = load(spark, d, "hct_mixscape_ko_by_umi_decile")
    over = F.avg(F.when(F.col("n_ko") > 10, 1.0).otherwise(0.0))
    return rows.groupBy("dataset").agg(F.round(F.try_divide(F.sum("n_ko"), F.sum("n_cells")), 6).alias("ko_rate"), F.round(over, 6).alias("share_over_10"))


@query("SELECT p_brand AS term, string_agg(DISTINCT p_type, ';' ORDER BY p_type) AS hit_genes FROM part GROUP BY 1")
def a28_hit_genes(spark, d):
    return load(spark, d, "part").groupBy(F.col("p_brand").alias("term")).agg(F.array_join(F.sort_array(F.collect_set("p_type")), ";").alias("hit_genes"))


@query(f"""WITH {_STREAMS}, t AS (SELECT DISTINCT perturbation FROM perturbation_clusters WHERE n_cells >= 100 AND perturbation IS NOT NULL)
SELECT gene, count(DISTINCT perturbation) AS n_perturbations FROM c WHERE effect_for_cluster <> 0 AND perturbation IN (SELECT perturbation FROM t)
GROUP BY 1 HAVING count(DISTINCT perturbation) >= (SELECT greatest(1, ceil(0.002::DOUBLE * greatest(1, count(*)))) FROM t)""")
def a29_recurrent(spark, d):
    targets = load(spark, d, "perturbation_clusters").where("n_cells >= 100 AND perturbation IS NOT NULL")
    return streams.recurrent_genes(_combined(spark, d), targets, 0.002)


@query("SELECT call_id, max(coalesce(list_sum(list_transform(regexp_extract_all(num_umis, '\\d+'), lambda x: x::BIGINT)), 0))::BIGINT AS umi FROM guide_calls_csv WHERE num_umis IS NOT NULL GROUP BY 1")
def a34_token_sum(spark, d):
    return load(spark, d, "guide_calls_csv").where("num_umis IS NOT NULL").groupBy("call_id").agg(F.max(token_sum("num_umis")).alias("umi"))


# Windows, order, sets, reshaping, samples.


@query("""SELECT perturbation, gene, score, rank FROM (SELECT *, row_number() OVER (PARTITION BY perturbation ORDER BY score DESC, gene)::INTEGER AS rank
FROM (SELECT DISTINCT perturbation, gene, score FROM perturbation_differential_genes WHERE score IS NOT NULL AND NOT isnan(score) AND perturbation IS NOT NULL)) WHERE rank <= 5""")
def w02_topn(spark, d):
    rows = load(spark, d, "perturbation_differential_genes").where("score IS NOT NULL AND NOT isnan(score) AND perturbation IS NOT NULL").select("perturbation", "gene", "score").distinct()
    return rel.top_per_group(rows, ["perturbation"], [F.col("score").desc(), F.col("gene")], 5)


@query("SELECT call_id, gene_target, loaded_at FROM (SELECT *, row_number() OVER (PARTITION BY call_id ORDER BY loaded_at, gene_target NULLS LAST) AS r FROM guide_calls_csv) WHERE r = 1")
def w03_keep_first(spark, d):
    rows = load(spark, d, "guide_calls_csv").select("call_id", "gene_target", "loaded_at")
    return rel.keep_first(rows, ["call_id"], [F.col("loaded_at").asc_nulls_last(), F.col("gene_target").asc_nulls_last()])


@query("""WITH e AS (SELECT event_id, event_type, value FROM events WHERE event_type IS NOT NULL AND value IS NOT NULL), q AS (SELECT event_type, quantile_cont(value, 0.9) AS t FROM e GROUP BY 1)
SELECT event_id, event_type, round(t, 6) AS selection_threshold FROM e JOIN q USING (event_type) WHERE value >= t""")
def w04_quantile_select(spark, d):
    out = rel.select_by_quantile(load(spark, d, "events").select("event_id", "event_type", "value"), "event_type", "value", 0.9)
    return out.select("event_id", "event_type", F.round("selection_threshold", 6).alias("selection_threshold"))


@query("SELECT s_suppkey, round((s_acctbal - m) / s, 6) AS s_acctbal_z FROM supplier, (SELECT avg(s_acctbal) AS m, stddev_pop(s_acctbal) AS s FROM supplier)")
def w05_zscore(spark, d):
    return rel.z_scores(load(spark, d, "supplier"), ["s_acctbal"]).select("s_suppkey", F.round("s_acctbal_z", 6).alias("s_acctbal_z"))


@query(f"""WITH {GUIDE_SQL}, e AS (SELECT list_sort(list_distinct(quantile_cont(umi, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]))) AS e, min(umi) AS low, max(umi) AS high FROM guides)
SELECT len(list_filter(e, lambda x: umi > x AND x > low AND x < high))::INTEGER AS umi_decile, count(*) AS n_cells, sum(is_ko)::BIGINT AS n_ko, round(median(umi), 6) AS median_guide_umi,
round(avg(umi), 6) AS mean_guide_umi, round(avg(is_ko), 6) AS ko_rate FROM guides, e GROUP BY 1""")
def w06_deciles(spark, d):
    out = strata.abundance_deciles(guide_cells(spark, d))
    return out.select("umi_decile", "n_cells", "n_ko", *[F.round(c, 6).alias(c) for c in ("median_guide_umi", "mean_guide_umi", "ko_rate")])


@query("SELECT gene_target, ((row_number() OVER (ORDER BY gene_target) - 1) // 16)::INTEGER AS chunk_index FROM (SELECT DISTINCT gene_target FROM obs_cells WHERE gene_target IS NOT NULL)")
def w08_chunks(spark, d):
    return rel.chunk_labels(load(spark, d, "obs_cells").where("gene_target IS NOT NULL"), "gene_target", 16)


@query("""WITH c AS (SELECT 'gene_target' AS col, 1 AS ci, gene_target AS label FROM obs_cells UNION ALL SELECT 'dataset', 2, dataset FROM obs_cells),
n AS (SELECT col, ci, label, count(*) AS n, list_position(['Scramble', 'Safe-Cutter', 'CRX116'], label) AS li FROM c WHERE label IN ('Scramble', 'Safe-Cutter', 'CRX116') GROUP BY ALL)
SELECT col AS pert_col, label AS control_label, n AS control_count, n > 0 AS ready FROM n ORDER BY n DESC, ci, li LIMIT 1""")
def w10_recommend(spark, d):
    return audit.recommend_labels(load(spark, d, "obs_cells"), ["gene_target", "dataset"], ["Scramble", "Safe-Cutter", "CRX116"])


@query("""WITH s AS (SELECT dataset, 'chunk_cells' AS stream, 1 AS p, count(*) AS n FROM chunk_cells WHERE is_control = 1 GROUP BY ALL UNION ALL SELECT dataset, 'guide_calls_csv', 2, count(*) FROM guide_calls_csv GROUP BY ALL)
SELECT dataset, stream, n FROM (SELECT *, min(p) OVER (PARTITION BY dataset) AS b FROM s WHERE n > 500 AND dataset IS NOT NULL) WHERE p = b""")
def w11_priority(spark, d):
    a = load(spark, d, "chunk_cells").where("is_control = 1").groupBy("dataset").agg(F.count(F.lit(1)).alias("n")).withColumn("stream", F.lit("chunk_cells"))
    b = load(spark, d, "guide_calls_csv").groupBy("dataset").agg(F.count(F.lit(1)).alias("n")).withColumn("stream", F.lit("guide_calls_csv"))
    rows = a.unionByName(b).where("dataset IS NOT NULL")
    return rel.first_with_data(rows, ["dataset"], "stream", ["chunk_cells", "guide_calls_csv"], F.col("n") > 500).select("dataset", "stream", "n")


@query(f"""WITH {COUNTS_SQL}, g AS (SELECT gene, count(*) AS n_nonzero, row_number() OVER (ORDER BY count(*) DESC, gene) AS position FROM counts GROUP BY 1),
r AS (SELECT *, sum(n_nonzero) OVER (ORDER BY position) AS run, sum(n_nonzero) OVER () AS total FROM g) SELECT gene, position, n_nonzero FROM r WHERE run <= total // 2""")
def w13_gene_budget(spark, d):
    ranked, total = _ranked_genes(spark, d)
    return ex.budgeted_genes(ranked, total // 2)


@query(f"""WITH RECURSIVE {COUNTS_SQL}, g AS (SELECT gene, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, gene) AS position FROM counts GROUP BY 1),
b AS (SELECT sum(n) // 2 AS budget, greatest(1, sum(n) // 2 // 2000) AS cap FROM g), caps AS (SELECT cap * unnest([1, 2, 4, 8, 16, 32, 64, 128]) AS c FROM b),
top AS (SELECT coalesce((SELECT min(c) FROM caps WHERE (SELECT count(*) FROM g WHERE n <= c) >= 666), (SELECT max(c) FROM caps)) AS top),
o AS (SELECT gene, n, position, row_number() OVER (ORDER BY n > top, position) AS i FROM g, top),
w(i, total, picked) AS (SELECT 0::BIGINT, 0::HUGEINT, []::VARCHAR[] UNION ALL
  SELECT w.i + 1, CASE WHEN fits THEN total + n ELSE total END, CASE WHEN fits THEN list_append(picked, gene) ELSE picked END
  FROM (SELECT w.*, o.gene, o.n, total + o.n <= budget AND len(picked) < 2000 AS fits FROM w JOIN o ON o.i = w.i + 1, b) w)
SELECT gene, position, n AS n_nonzero FROM g WHERE gene IN (SELECT unnest(picked) FROM w WHERE i = (SELECT max(i) FROM w))""")
def w13_greedy_genes(spark, d):
    ranked, total = _ranked_genes(spark, d)
    return ex.greedy_genes(ranked, total // 2, 2000)


def _ranked_genes(spark, d):
    per = counts(spark, d).groupBy("gene").agg(F.count(F.lit(1)).alias("n_nonzero"))
    total = per.agg(F.sum("n_nonzero")).first()[0] or 0
    keyed = per.withColumn("key", F.struct((-F.col("n_nonzero")).alias("n"), "gene"))
    ranked = rel.chunk_labels(keyed, "key", 1).select(F.col("key.gene").alias("gene"), (-F.col("key.n")).alias("n_nonzero"), (F.col("chunk_index") + 1).cast("bigint").alias("position"))
    return ranked, total


@query("SELECT perturbation, cluster, n_cells FROM (SELECT DISTINCT perturbation, cluster, n_cells FROM perturbation_clusters) ORDER BY n_cells DESC NULLS LAST, cluster NULLS LAST, perturbation LIMIT 25")
def o02_mixed_sort_limit(spark, d):
    rows = load(spark, d, "perturbation_clusters").select("perturbation", "cluster", "n_cells").distinct()
    return rows.orderBy(F.col("n_cells").desc_nulls_last(), F.col("cluster").asc_nulls_last(), "perturbation").limit(25)


@query("SELECT dataset, upper(trim(cell_barcode)) AS cell_barcode FROM guide_calls_csv INTERSECT SELECT dataset, upper(trim(cell_barcode)) FROM chunk_cells")
def u04_intersect(spark, d):
    return _barcodes(spark, d, "guide_calls_csv").intersect(_barcodes(spark, d, "chunk_cells"))


@query("SELECT dataset, upper(trim(cell_barcode)) AS cell_barcode FROM guide_calls_csv UNION SELECT dataset, upper(trim(cell_barcode)) FROM chunk_cells")
def u05_union(spark, d):
    return _barcodes(spark, d, "guide_calls_csv").union(_barcodes(spark, d, "chunk_cells")).distinct()


@query("SELECT dataset, upper(trim(cell_barcode)) AS cell_barcode FROM guide_calls_csv EXCEPT SELECT dataset, upper(trim(cell_barcode)) FROM chunk_cells")
def u06_except(spark, d):
    return _barcodes(spark, d, "guide_calls_csv").subtract(_barcodes(spark, d, "chunk_cells"))


def _barcodes(spark, d, table):
    return load(spark, d, table).select("dataset", F.upper(F.trim("cell_barcode")).alias("cell_barcode"))


@query(f"WITH {_STREAMS}, p AS (SELECT DISTINCT perturbation FROM perturbation_clusters WHERE n_cells >= 100) SELECT perturbation, gene, round(effect_for_cluster, 6) AS value FROM c WHERE effect_for_cluster <> 0 AND perturbation IN (SELECT perturbation FROM p)")
def h01_pivot_long(spark, d):
    combined = _combined(spark, d)
    chosen = load(spark, d, "perturbation_clusters").where("n_cells >= 100")
    return streams.effect_matrix(combined, chosen, streams.feature_genes(combined, 0, 20)).withColumn("value", F.round("value", 6))


@query(f"""WITH {_VECTORS}, e AS (SELECT a.perturbation, a.n, a.k, a.m - b.m AS v FROM m a JOIN m b ON a.k = b.k AND b.perturbation = '0')
SELECT perturbation, max(n) AS n_cells, round(max(v) FILTER (k = 1), 6) AS delta_pc1, round(max(v) FILTER (k = 2), 6) AS delta_pc2, round(max(v) FILTER (k = 3), 6) AS delta_pc3 FROM e GROUP BY 1""")
def h02_effects_wide(spark, d):
    wide = fx.widen(fx.centroid_deltas(_vectors(spark, d), "0"), 3)
    return wide.select("perturbation", "n_cells", *[F.round(f"delta_pc{k}", 6).alias(f"delta_pc{k}") for k in (1, 2, 3)])


@query("SELECT perturbation, unnest(genes[:3]) AS gene, unnest(range(1, len(genes[:3]) + 1))::INTEGER AS rank FROM (SELECT p_brand AS perturbation, list_sort(list_distinct(list(p_type))) AS genes FROM part GROUP BY 1)")
def h03_lists_to_rows(spark, d):
    lists = load(spark, d, "part").groupBy(F.col("p_brand").alias("perturbation")).agg(F.array_sort(F.collect_set("p_type")).alias("genes"))
    rows = lists.select("perturbation", F.posexplode(F.slice("genes", 1, 3)).alias("k", "gene"))
    return rows.select("perturbation", "gene", (F.col("k") + 1).alias("rank"))


@query(f"WITH {CELLS_SQL} SELECT cell_barcode, perturbation FROM cells WHERE perturbation <> '{CONTROL}' UNION ALL (SELECT cell_barcode, perturbation FROM cells WHERE perturbation = '{CONTROL}' ORDER BY md5('3|' || cell_barcode), cell_barcode LIMIT 100)")
def r01_control_sample(spark, d):
    return sampling.cap_controls(cells(spark, d), "perturbation", CONTROL, "cell_barcode", 100, 3)


@query(f"WITH {MANY_SQL} SELECT cell_barcode, perturbation FROM cells QUALIFY row_number() OVER (PARTITION BY perturbation ORDER BY md5('5|' || cell_barcode), cell_barcode) <= 20")
def r03_group_cap(spark, d):
    return sampling.cap_groups(cells_many(spark, d), "perturbation", "cell_barcode", 20, 5)


_ROLES = """p AS (SELECT DISTINCT perturbation FROM perturbation_clusters WHERE perturbation IS NOT NULL),
t AS (SELECT DISTINCT perturbation FROM perturbation_differential_genes WHERE rank = 1 AND perturbation IS NOT NULL)"""


@query(f"""WITH {_ROLES} SELECT perturbation, 'target' AS role FROM t WHERE perturbation IN (SELECT perturbation FROM p) UNION ALL SELECT perturbation, 'missing' FROM t WHERE perturbation NOT IN (SELECT perturbation FROM p)
UNION ALL (SELECT perturbation, 'random' FROM p WHERE perturbation NOT IN (SELECT perturbation FROM t) ORDER BY md5('11|' || perturbation), perturbation LIMIT 50)""")
def r04_random_controls(spark, d):
    known = load(spark, d, "perturbation_clusters").where("perturbation IS NOT NULL")
    targets = load(spark, d, "perturbation_differential_genes").where("rank = 1 AND perturbation IS NOT NULL")
    return sampling.targets_and_random(known, targets, "perturbation", 50, False, 11)


# Numerics.


@query(f"WITH {COUNTS_SQL} SELECT cell_barcode, gene, round(value * 10000 / sum(value) OVER (PARTITION BY cell_barcode), 6) AS value FROM counts")
def n01_normalize(spark, d):
    return ex.normalize_total(counts(spark, d), 10_000).withColumn("value", F.round("value", 6))


@query(f"WITH {COUNTS_SQL}, t AS (SELECT cell_barcode, sum(value) AS t FROM counts GROUP BY 1) SELECT cell_barcode, gene, round(ln(1 + value * (SELECT median(t) FROM t) / t), 6) AS value FROM counts JOIN t USING (cell_barcode)")
def n02_median_normalize(spark, d):
    # Read for the cells' sums and for the values.
    rows = cut(counts(spark, d), "counts")
    return ex.log1p(ex.normalize_total(rows)).withColumn("value", F.round("value", 6))


@query(f"WITH {_BULK} SELECT perturbation, gene, round(ln(1 + value * 10000 / sum(value) OVER (PARTITION BY perturbation)), 6) AS value FROM bulk")
def n03_pseudobulk_log1p(spark, d):
    return ex.pseudobulk_expression(ex.pseudobulk(counts(spark, d), cells(spark, d))).withColumn("value", F.round("value", 6))


@query(f"""WITH {FINE_SQL}, v AS (SELECT cell_barcode, gene, ln(1 + value * 10000.0 / sum(value) OVER (PARTITION BY cell_barcode)) AS value FROM counts),
n AS (SELECT count(DISTINCT cell_barcode) AS n FROM v),
s AS (SELECT gene, sum(value) / n AS mean, greatest((sum(value * value) - sum(value) * sum(value) / n) / (n - 1), 0) AS variance FROM v, n WHERE value <> 0 GROUP BY gene, n),
e AS (SELECT gene, variance / nullif(mean, 0) AS x, ln(1 + mean) AS m FROM s), r AS (SELECT min(m) AS low, max(m) AS high FROM e),
b AS (SELECT gene, x, least(floor((m - low) * 20 / (high - low)), 19) AS bin FROM e, r), p AS (SELECT bin, avg(x) AS u, stddev_samp(x) AS sd FROM b GROUP BY 1),
z AS (SELECT gene, CASE WHEN coalesce(sd, 0) > 0 THEN (x - u) / sd ELSE 1.0 END AS z FROM b JOIN p USING (bin))
SELECT gene, row_number() OVER (ORDER BY z DESC NULLS LAST, gene) <= 40 AS is_hvg, round(z, 6) AS dispersion_norm FROM z""")
def n05_variable_genes(spark, d):
    rows = co.prepared(counts(spark, d, True), 10_000)
    return ex.highly_variable(ex.gene_stats(rows, rows.select("cell_barcode").distinct().count()), 40).select("gene", "is_hvg", F.round("dispersion_norm", 6).alias("dispersion_norm"))


@query(f"""WITH {_BULK}, s AS (SELECT gene, sum(value) / 5 AS m, sqrt(sum(value * value) / 5 - (sum(value) / 5) ** 2) AS s FROM bulk GROUP BY 1),
z AS (SELECT perturbation, gene, (value - m) / s AS v FROM bulk JOIN s USING (gene) WHERE s > 1e-12)
SELECT a.perturbation AS group_a, b.perturbation AS group_b, round(1 / (1 + sqrt(sum((a.v - b.v) ** 2))), 6) AS similarity FROM z a JOIN z b USING (gene) WHERE a.perturbation <> b.perturbation GROUP BY ALL""")
def n12_similarity(spark, d):
    bulk = ex.pseudobulk(counts(spark, d), cells(spark, d))
    z = ex.standardize_genes(bulk, "perturbation", 5).select("perturbation", "gene", (F.col("value") - F.col("zero")).alias("value"))
    out = similarity.profile_distances(z, "perturbation", z).where("group_a <> group_b")
    return out.select("group_a", "group_b", F.round("similarity", 6).alias("similarity"))


def _profiles(spark, d):
    values = co.prepared(counts(spark, d), 10_000)
    return values, co.gene_index(values)


@query()
def n06_pca(spark, d):
    values, genes = _profiles(spark, d)
    pcs = similarity.principal_components(values, genes, 10)
    return pcs.select("cell_barcode", F.transform("x", lambda v: F.round(v, 6)).alias("x"))


@query(f"""WITH {COUNTS_SQL}, v AS (SELECT cell_barcode, gene, ln(1 + value * 10000.0 / sum(value) OVER (PARTITION BY cell_barcode)) AS value FROM counts),
n AS (SELECT count(DISTINCT cell_barcode) AS n FROM v), m AS (SELECT gene, sum(value) / max(n) AS m FROM v, n GROUP BY 1), c AS (SELECT DISTINCT cell_barcode FROM v)
SELECT c.cell_barcode, round(sqrt(sum((coalesce(v.value, 0) - m) ** 2)), 5) AS length FROM c CROSS JOIN m LEFT JOIN v ON v.cell_barcode = c.cell_barcode AND v.gene = m.gene GROUP BY 1""")
def n06_component_lengths(spark, d):
    """Over all components a cell is as far from the mean as over all genes."""
    values, genes = _profiles(spark, d)
    pcs = similarity.principal_components(values, genes, 25)
    return pcs.select("cell_barcode", F.round(F.sqrt(F.aggregate("x", F.lit(0.0), lambda s, v: s + v * v)), 5).alias("length"))


@query(f"""WITH v AS (SELECT CAST(label AS VARCHAR) || '-' || CAST(vec_id AS VARCHAR) AS id, embedding AS e FROM embeddings),
q AS (SELECT a.id, b.id AS neighbour, sqrt(list_sum(list_transform(list_zip(a.e, b.e), lambda z: (z[1]::DOUBLE - z[2]::DOUBLE) ** 2))) AS x FROM v a, v b WHERE a.id <> b.id)
SELECT id, neighbour, rank FROM (SELECT id, neighbour, row_number() OVER (PARTITION BY id ORDER BY round(x, 9), neighbour)::INTEGER AS rank FROM q) WHERE rank <= 5""")
def n07_knn(spark, d):
    rows = _vectors(spark, d).select(F.concat("perturbation", F.lit("-"), "cell_barcode").alias("id"), "x")
    return similarity.nearest_neighbours(rows, 5, "id").select("id", "neighbour", "rank")


@query()
def n09_communities(spark, d):
    rows = _vectors(spark, d).select("cell_barcode", "x")
    return similarity.communities(similarity.nearest_neighbours(rows, 15, "cell_barcode"), "cell_barcode")


@query()
def n10_clusters(spark, d):
    x = F.array(*[F.col(f"delta_pc{k}") for k in range(1, 13)])
    rows = load(spark, d, "perturbation_clusters").select("perturbation", x.alias("x")).where(F.forall("x", lambda v: v.isNotNull())).distinct()
    return similarity.cluster_profiles(rows, 20, "perturbation")


@query("""WITH v AS (SELECT CAST(vec_id AS VARCHAR) AS cell_barcode, CAST(label AS VARCHAR) AS perturbation, embedding AS e FROM embeddings),
q AS (SELECT a.cell_barcode, b.cell_barcode AS neighbour, sqrt(list_sum(list_transform(list_zip(a.e, b.e), lambda z: (z[1]::DOUBLE - z[2]::DOUBLE) ** 2))) AS x
  FROM v a JOIN v b ON b.perturbation = '0' AND a.cell_barcode <> b.cell_barcode),
near AS (SELECT cell_barcode, neighbour FROM (SELECT *, row_number() OVER (PARTITION BY cell_barcode ORDER BY round(x, 9), neighbour) AS r FROM q) WHERE r <= 20),
m AS (SELECT near.cell_barcode, k, avg(v.e[k + 1]::DOUBLE) AS m FROM near JOIN v ON v.cell_barcode = near.neighbour, range(0, 64) t(k) GROUP BY ALL)
SELECT cell_barcode, perturbation, k::INTEGER AS k, round(e[k + 1]::DOUBLE - m, 6) AS value FROM v JOIN m USING (cell_barcode) WHERE k < len(e)""")
def n13_signature(spark, d):
    out = models.signature(_vectors(spark, d), "0", 20)
    return out.select("cell_barcode", "perturbation", F.posexplode("signature").alias("k", "value")).withColumn("value", F.round("value", 6))


def _scored(spark, d, **bounds):
    # Each is read several times below.
    rows, values = cut(cells_by_size(spark, d), "cells"), cut(co.prepared(counts(spark, d), 10_000), "values")
    de = de_ops.differential_expression(values, rows, CONTROL_SIZE)
    chosen = cut(models.effect_genes(de, co.Defaults.lfc, co.Defaults.p, **bounds), "chosen")
    return rows, models.projections(values, rows, chosen, CONTROL_SIZE), models.control_moments(values, rows, chosen, CONTROL_SIZE)


@query()
def n14_mixscape(spark, d):
    rows, scores, moments = _scored(spark, d)
    return models.classify(scores, moments, CONTROL_SIZE, rows).withColumn("p_ko", F.round("p_ko", 6))


_SCORED = f"""{SIZE_SQL}, {COUNTS_SQL}, kept AS (SELECT * FROM cells), vals AS (SELECT cell_barcode, gene, ln(1 + value * 10000.0 / sum(value) OVER (PARTITION BY cell_barcode)) AS value FROM counts),
{sq.differential_expression("vals", "kept", CONTROL_SIZE)},
sig AS (SELECT perturbation, gene, logfoldchange AS w, row_number() OVER (PARTITION BY perturbation ORDER BY q, abs(score) DESC, gene) AS r, count(*) OVER (PARTITION BY perturbation) AS n FROM de WHERE abs(logfoldchange) >= 0.1 AND q <= 0.05),
base AS (SELECT gene, sum(value) / (SELECT n0 FROM size0) AS c, sum(value * value) / (SELECT n0 FROM size0) - (sum(value) / (SELECT n0 FROM size0)) ** 2 AS var FROM vals JOIN cells USING (cell_barcode) WHERE perturbation = '{CONTROL_SIZE}' GROUP BY 1)"""


def _projected(which: str) -> str:
    return f"""{_SCORED}, g AS (SELECT perturbation, gene, w, coalesce(c, 0) AS c, greatest(coalesce(var, 0), 0) AS var FROM sig LEFT JOIN base USING (gene) WHERE {which}),
f AS (SELECT perturbation, sum(c * w) AS cw, sum(w * w) AS ww, sqrt(sum(w * w * var)) / sum(w * w) AS sd0 FROM g GROUP BY 1),
x AS (SELECT cell_barcode, sum(value * w) AS xw FROM vals JOIN cells USING (cell_barcode) JOIN g USING (perturbation, gene) GROUP BY 1),
s AS (SELECT cell_barcode, perturbation, (coalesce(xw, 0) - cw) / ww AS projection, sd0 FROM cells JOIN f USING (perturbation) LEFT JOIN x USING (cell_barcode) WHERE perturbation <> '{CONTROL_SIZE}' AND ww > 0)"""


@query(f"WITH {_projected('n >= 5 AND r <= 100')} SELECT cell_barcode, perturbation, round(projection / sd0, 6) AS mixscale_score FROM s WHERE sd0 > 0")
def n15_mixscale(spark, d):
    _, scores, moments = _scored(spark, d, most=co.Defaults.mixscale_max_genes, least=co.Defaults.mixscale_min_genes)
    return models.mixscale_scores(scores, moments).withColumn("mixscale_score", F.round("mixscale_score", 6))


@query(f"""WITH {_projected('true')}, t AS (SELECT perturbation, greatest(projection, 0) AS v, max(greatest(projection, 0)) OVER (PARTITION BY perturbation) AS top FROM s)
SELECT perturbation, count(*) AS n_cells, round(avg(coalesce(v / nullif(top, 0), 0)), 6) AS mean_ps_score, round(stddev_samp(coalesce(v / nullif(top, 0), 0)), 6) AS sd_ps_score FROM t GROUP BY 1""")
def n16_efficiency(spark, d):
    _, scores, _ = _scored(spark, d)
    out = models.efficiency_summary(models.efficiency_scores(scores))
    return out.withColumns({c: F.round(c, 6) for c in ("mean_ps_score", "sd_ps_score")})


# Audit and composites.


@query("""SELECT count(*) AS n_rows, count(DISTINCT g.cell_barcode) AS n_barcodes, count(DISTINCT g.gene_target) AS n_targets, sum(CASE WHEN g.gene_target = 'Scramble' THEN 1 ELSE 0 END)::BIGINT AS n_control_rows,
(SELECT count(DISTINCT cell_barcode) FROM guide_calls_csv WHERE cell_barcode IN (SELECT cell_barcode FROM obs_cells)) AS n_overlap FROM guide_calls_csv g""")
def v02_guide_summary(spark, d):
    return audit.guide_summary(load(spark, d, "guide_calls_csv"), load(spark, d, "obs_cells"), "Scramble")


_LABEL_COLUMNS = {"dataset": "string", "cell_barcode": "string", "gene_target": "string", "mixscape_class": "string", "mixscape_class_global": "string", "mixscape_class_p_ko": "double", "is_predicted_perturbed": "int", "source_chunk": "string", "loaded_at": "timestamp_ntz"}


@query(" UNION ALL ".join(f"SELECT '{c}' AS column, '{t}' AS type, count(*) AS n_rows, count(*) - count({c}) AS n_null FROM cell_mixscape_labels" for c, t in _LABEL_COLUMNS.items()))
def v01_structure(spark, d):
    """Without the distinct counts, which are approximate."""
    return audit.structure(load(spark, d, "cell_mixscape_labels")).drop("n_distinct")


@query("""WITH s AS (SELECT count(*) AS n, count(DISTINCT cell_barcode) AS b, sum(CASE WHEN gene_target = 'Scramble' THEN 1 ELSE 0 END) AS c FROM guide_calls_csv)
SELECT 'has_rows' AS name, n > 0 AS ok, n > 0 AND b > 0 AND c > 0 AS ready FROM s UNION ALL SELECT 'has_barcodes', b > 0, n > 0 AND b > 0 AND c > 0 FROM s UNION ALL SELECT 'has_control', c > 0, n > 0 AND b > 0 AND c > 0 FROM s""")
def v03_readiness(spark, d):
    calls = load(spark, d, "guide_calls_csv")
    s = audit.guide_summary(calls, load(spark, d, "obs_cells"), "Scramble").first()
    checks = [("has_rows", s.n_rows > 0, str(s.n_rows)), ("has_barcodes", s.n_barcodes > 0, str(s.n_barcodes)), ("has_control", s.n_control_rows > 0, str(s.n_control_rows))]
    return audit.readiness(checks, calls).select("name", "ok", "ready")


@query("""SELECT 'guide_umis' AS source, round(avg(CASE WHEN abs(x - round(x)) <= 1e-8 THEN 1.0 ELSE 0.0 END)::DOUBLE, 6) AS integer_share FROM (SELECT n_cells::DOUBLE AS x FROM hct_mixscape_ko_by_umi_decile WHERE n_cells IS NOT NULL)""")
def v05_raw_source(spark, d):
    rows = load(spark, d, "hct_mixscape_ko_by_umi_decile")
    layers = {"rates": rows.select(F.col("ko_rate").alias("value")), "guide_umis": rows.select(F.col("n_cells").cast("double").alias("value"))}
    return audit.raw_count_source(layers).withColumn("integer_share", F.round("integer_share", 6))


@query(f"WITH {_MANIFEST} SELECT chunk_id, cell_barcode, gene_target, is_control FROM m")
def c01_manifest(spark, d):
    return _manifest(spark, d)


@query(f"WITH {_MANIFEST} SELECT chunk_id, cell_barcode, gene_target, is_control FROM m")
def k03_chunk_files(spark, d):
    path = scratch_path(spark, "manifest")
    sinks.write_chunks(_manifest(spark, d), path)
    return spark.read.parquet(path)


@query()
def c03_run_mixscape(spark, d):
    made = cut(counts(spark, d, by_cell=True), "counts")
    classes, _, _ = co.run_mixscape(made, cells_by_size(spark, d, made), CONTROL_SIZE)
    return classes.withColumn("p_ko", F.round("p_ko", 6))


@query(f"""WITH {SIZE_SQL}, {COUNTS_SQL}, v AS (SELECT cell_barcode, gene, ln(1 + value * 10000.0 / sum(value) OVER (PARTITION BY cell_barcode)) AS value FROM counts),
n AS (SELECT perturbation, count(*) AS n FROM cells GROUP BY 1), g AS (SELECT DISTINCT gene FROM v),
m AS (SELECT n.perturbation, g.gene, coalesce(sum(value), 0) / n.n AS m FROM n CROSS JOIN g LEFT JOIN (SELECT * FROM v JOIN cells USING (cell_barcode)) x ON x.perturbation = n.perturbation AND x.gene = g.gene GROUP BY n.perturbation, g.gene, n.n)
SELECT a.perturbation, max(n.n) AS n_cells, round(sqrt(sum((a.m - b.m) ** 2)), 6) AS effect_l2_vs_control FROM m a JOIN m b ON a.gene = b.gene AND b.perturbation = '{CONTROL_SIZE}' JOIN n ON n.perturbation = a.perturbation GROUP BY 1""")
def c03_effects(spark, d):
    """With as many components as genes, whose turn leaves lengths as they are."""
    model = co.Defaults(n_pcs=25, neighbours=0)
    deltas = co.run_mixscape(counts(spark, d), cells_by_size(spark, d), CONTROL_SIZE, model)[1]
    return deltas.select("perturbation", "n_cells", F.round("effect_l2_vs_control", 6).alias("effect_l2_vs_control"))


@query("""WITH v AS (SELECT CAST(label AS VARCHAR) AS perturbation, vec_id, unnest(embedding)::DOUBLE AS x, unnest(range(1, len(embedding) + 1)) AS k FROM embeddings),
m AS (SELECT perturbation, k, avg(x) AS m, var_samp(x) AS v, count(*)::DOUBLE AS n FROM v GROUP BY ALL),
e AS (SELECT a.perturbation, sqrt(sum((a.m - b.m) ** 2)) AS effect FROM m a JOIN m b ON a.k = b.k AND b.perturbation = '0' GROUP BY 1),
t AS (SELECT a.perturbation, CASE WHEN a.perturbation <> '0' THEN (a.m - b.m) / sqrt(a.v / a.n + b.v / b.n) END AS t FROM m a JOIN m b ON b.perturbation = '0' AND a.k = 1 AND b.k = 1),
f AS (SELECT CAST(label AS VARCHAR) AS perturbation, count(*) AS n_cells, sum(CASE WHEN embedding[2] > 0 THEN 1 ELSE 0 END)::BIGINT AS n_predicted_perturbed FROM embeddings GROUP BY 1)
SELECT perturbation, n_cells, n_predicted_perturbed, round(n_predicted_perturbed / n_cells, 6) AS frac_predicted_perturbed, round(t, 6) AS pc1_t_stat_vs_control, round(effect, 6) AS effect_l2_vs_control
FROM f JOIN t USING (perturbation) JOIN e USING (perturbation)""")
def c04_summarize_effects(spark, d):
    rows = _vectors(spark, d)
    out = co.summarize_effects(rows, rows, F.col("x")[1] > 0, "0").drop("pc1_p_value_vs_control")
    return out.withColumns({c: F.round(c, 6) for c in ("frac_predicted_perturbed", "pc1_t_stat_vs_control", "effect_l2_vs_control")})


@query(f"""WITH {_MANIFEST} SELECT chunk_id, count(DISTINCT gene_target) FILTER (is_control = 0) AS n_perturbations, count(*) FILTER (is_control = 0) AS n_perturbed_cells, count(*) FILTER (is_control = 1) AS n_control_cells, count(*) AS n_total_cells,
array_to_string(list_sort(list_distinct(list(gene_target) FILTER (is_control = 0)))[:5], ',') || CASE WHEN count(DISTINCT gene_target) FILTER (is_control = 0) > 5 THEN '...' ELSE '' END AS first_perturbations FROM m GROUP BY 1""")
def c01_manifest_summary(spark, d):
    return co.manifest_summary(_manifest(spark, d))


_SELECTED = "sel AS (SELECT source_chunk AS chunk_id, gene_target AS perturbation, cell_barcode FROM cell_mixscape_labels WHERE is_predicted_perturbed = 1 AND gene_target IS NOT NULL AND source_chunk IS NOT NULL)"


@query(f"""WITH {_SELECTED}, t AS (SELECT perturbation, count(DISTINCT cell_barcode) AS n FROM sel GROUP BY 1)
SELECT chunk_id, perturbation, count(DISTINCT cell_barcode) AS n_selected_perturbed_cells, max(t.n) AS n_selected_total_for_perturbation, round((SELECT avg(n) FROM t), 6) AS mean_selected_cells_per_perturbation FROM sel JOIN t USING (perturbation) GROUP BY ALL""")
def c05_merge(spark, d):
    rows = load(spark, d, "cell_mixscape_labels").where("is_predicted_perturbed = 1 AND gene_target IS NOT NULL AND source_chunk IS NOT NULL")
    out = co.merge_selected(rows.select(F.col("source_chunk").alias("chunk_id"), F.col("gene_target").alias("perturbation"), "cell_barcode"))
    return out.withColumn("mean_selected_cells_per_perturbation", F.round("mean_selected_cells_per_perturbation", 6))


@query("SELECT gene_target, source_chunk, dataset FROM cell_mixscape_labels WHERE gene_target IS NOT NULL QUALIFY row_number() OVER (PARTITION BY gene_target ORDER BY source_chunk NULLS FIRST, dataset NULLS FIRST) = 1")
def c08_merge_tables(spark, d):
    rows = load(spark, d, "cell_mixscape_labels").where("gene_target IS NOT NULL").select("gene_target", "source_chunk", "dataset")
    return co.merge_tables(rows, ["gene_target"])


@query()
def c06_postprocess(spark, d):
    rows = cells_many(spark, d)
    out = co.postprocess(counts(spark, d, True), rows.where(F.col("perturbation") != CONTROL_MANY), 20)
    return out.withColumns({c: F.round(c, 6) for c in ("axis_1", "axis_2")})


@query("""WITH e AS (SELECT CAST(event_id AS VARCHAR) AS cell_barcode, event_type AS perturbation, value AS ps_score FROM events WHERE event_type <> 'click'),
q AS (SELECT perturbation, quantile_cont(ps_score, 0.9) AS t FROM e GROUP BY 1), s AS (SELECT e.*, t FROM e JOIN q USING (perturbation) WHERE ps_score >= t)
SELECT cell_barcode, perturbation, ps_score, round(t, 6) AS selection_threshold FROM s WHERE perturbation IN (SELECT perturbation FROM s GROUP BY 1 HAVING count(DISTINCT cell_barcode) >= 20)""")
def c10_ps_select(spark, d):
    rows = load(spark, d, "events").select(F.col("event_id").cast("string").alias("cell_barcode"), F.col("event_type").alias("perturbation"), F.col("value").alias("ps_score"))
    return co.ps_select(rows, "click").select("cell_barcode", "perturbation", "ps_score", F.round("selection_threshold", 6).alias("selection_threshold"))


_DE_COLUMNS = ", ".join(f"round({c}, 6) AS {n}" for c, n in (("score", "score"), ("logfoldchange", "logfoldchange"), ("pval", "pval"), ("q", "pval_adj"), ("pct_nz_group", "pct_nz_group"), ("pct_nz_reference", "pct_nz_reference")))


def _rounded(de):
    return de.withColumns({c: F.round(c, 6) for c in ("score", "logfoldchange", "pval", "pval_adj", "pct_nz_group", "pct_nz_reference")})


@query(f"WITH {MANY_SQL}, {FINE_SQL}, {sq.global_de(CONTROL_MANY, 2000)} SELECT perturbation, rank, gene, {_DE_COLUMNS} FROM de WHERE rank <= 2000")
def c11_global_de(spark, d):
    return _rounded(co.global_de(counts(spark, d, True), cells_many(spark, d), CONTROL_MANY))


@query(f"WITH {MANY_SQL}, {FINE_SQL}, {sq.global_de(CONTROL_MANY, 100, 't-test')} SELECT perturbation, rank, gene, {_DE_COLUMNS} FROM de WHERE rank <= 100")
def c11_global_de_t(spark, d):
    return _rounded(co.global_de(counts(spark, d, True), cells_many(spark, d), CONTROL_MANY, method="t-test", top=100))


@query(f"""WITH {MANY_SQL}, {FINE_SQL}, tot AS (SELECT cell_barcode, sum(value) AS t FROM counts GROUP BY 1),
ps AS (SELECT cell_barcode, perturbation, t AS score FROM cells JOIN tot USING (cell_barcode) WHERE perturbation <> '{CONTROL_MANY}'), q AS (SELECT perturbation, quantile_cont(score, 0.9) AS t FROM ps GROUP BY 1),
sel AS (SELECT cell_barcode, perturbation FROM ps JOIN q USING (perturbation) WHERE score >= q.t), enough AS (SELECT perturbation FROM sel GROUP BY 1 HAVING count(*) >= 20),
kept AS (SELECT * FROM sel WHERE perturbation IN (SELECT perturbation FROM enough) UNION ALL SELECT cell_barcode, perturbation FROM cells WHERE perturbation = '{CONTROL_MANY}'),
own AS (SELECT counts.*, sum(value) OVER (PARTITION BY cell_barcode) AS t FROM counts WHERE cell_barcode IN (SELECT cell_barcode FROM kept)), goal AS (SELECT median(t) AS g FROM (SELECT DISTINCT cell_barcode, t FROM own)),
vals AS (SELECT cell_barcode, gene, ln(1 + value * g / t) AS value FROM own, goal), {sq.differential_expression("vals", "kept", CONTROL_MANY)}
SELECT perturbation, rank, gene, {_DE_COLUMNS} FROM de WHERE rank <= 200""")
def c10_ps_de(spark, d):
    """The score of a cell is its count; the selected tenth meets all control cells."""
    rows, values = cells_many(spark, d), counts(spark, d, True)
    totals = values.groupBy("cell_barcode").agg(F.sum("value").alias("ps_score"))
    return _rounded(co.ps_select_and_de(rows.join(totals, "cell_barcode"), values, rows, CONTROL_MANY))


_ORA = f"""{SETS_SQL}, uni AS (SELECT DISTINCT p_brand || '|' || p_type AS gene FROM part), uu AS (SELECT count(*) AS u FROM uni),
query AS (SELECT DISTINCT 'SIZE_' || CAST(p_size % 3 AS VARCHAR) AS perturbation, 'up' AS direction, p_brand || '|' || p_type AS gene FROM part WHERE p_retailprice > 985),
nq AS (SELECT perturbation, direction, count(*) AS n FROM query GROUP BY ALL HAVING count(*) >= 10), nt AS (SELECT term, count(*) AS m FROM sets GROUP BY 1 HAVING count(*) BETWEEN 5 AND 5000),
h AS (SELECT perturbation, direction, term, count(*) AS k, string_agg(gene, ';' ORDER BY gene) AS hit_genes FROM query JOIN sets USING (gene) GROUP BY ALL),
o AS (SELECT h.*, n, m, u FROM h JOIN nq USING (perturbation, direction) JOIN nt USING (term), uu)"""


def _ora_query(spark, d):
    p = load(spark, d, "part").where("p_retailprice > 985")
    gene = F.concat("p_brand", F.lit("|"), "p_type")
    return p.select(F.concat(F.lit("SIZE_"), (F.col("p_size") % 3).cast("string")).alias("perturbation"), F.lit("up").alias("direction"), gene.alias("gene")).distinct()


@query(f"""WITH {_ORA}, x AS (SELECT perturbation, direction, term, k, n, m, u, unnest(range(k, least(n, m) + 1)) AS j FROM o)
SELECT o.perturbation, o.direction, o.term, o.k AS k_overlap, o.n AS query_size, o.m AS term_size, o.u AS universe_size, round(o.n * o.m / o.u, 6) AS expected_overlap, round(o.k / (o.n * o.m / o.u), 6) AS enrichment_ratio,
round(((o.k + 0.5::DOUBLE) * (o.u - o.m - o.n + o.k + 0.5)) / ((o.n - o.k + 0.5) * (o.m - o.k + 0.5)), 6) AS odds_ratio, round(least(1, p.p), 6) AS p_value, o.hit_genes FROM o
JOIN (SELECT perturbation, direction, term, sum(CASE WHEN u - m - n + j >= 0 THEN exp(lgamma(m + 1) - lgamma(j + 1) - lgamma(m - j + 1) + lgamma(u - m + 1) - lgamma(n - j + 1) - lgamma(greatest(u - m - n + j, 0) + 1) - lgamma(u + 1) + lgamma(n + 1) + lgamma(u - n + 1)) ELSE 0 END) AS p FROM x GROUP BY ALL) p USING (perturbation, direction, term)""")
def c12_ora(spark, d):
    universe = load(spark, d, "part").select(F.concat("p_brand", F.lit("|"), "p_type").alias("gene"))
    terms = ora.over_representation(_ora_query(spark, d), gene_sets(spark, d), universe)
    rounded = {c: F.round(c, 6) for c in ("expected_overlap", "enrichment_ratio", "odds_ratio", "p_value")}
    return terms.withColumns(rounded).drop("p_adj_bh")


_HYPER = sq.hypergeometric_upper("k", "u", "m", "n")


@query(f"""WITH {_ORA}, p AS (SELECT perturbation, direction, term, {_HYPER} AS p FROM o), t AS (SELECT *, round(q, 9) AS b FROM {sq.adjusted("p", "perturbation, direction", "p")}),
f AS (SELECT perturbation, direction, count(*) AS n_terms_tested, count(*) FILTER (q <= 0.05) AS n_terms_fdr_sig, min(q) AS best_p_adj_bh FROM t GROUP BY ALL)
SELECT a.perturbation, a.direction, a.n AS n_query_genes, coalesce(n_terms_tested, 0) AS n_terms_tested, coalesce(n_terms_fdr_sig, 0) AS n_terms_fdr_sig, round(best_p_adj_bh, 6) AS best_p_adj_bh
FROM (SELECT perturbation, direction, count(*) AS n FROM query GROUP BY ALL) a LEFT JOIN f USING (perturbation, direction)""")
def c12_ora_summary(spark, d):
    universe = load(spark, d, "part").select(F.concat("p_brand", F.lit("|"), "p_type").alias("gene"))
    out = ora.term_summary(ora.over_representation(_ora_query(spark, d), gene_sets(spark, d), universe), _ora_query(spark, d))
    return out.drop("best_term").withColumn("best_p_adj_bh", F.round("best_p_adj_bh", 6))


@query(f"""WITH de AS (SELECT perturbation, gene, logfoldchange AS x, pval_adj AS p FROM perturbation_differential_genes WHERE gene IS NOT NULL),
uni AS (SELECT DISTINCT gene FROM de), uu AS (SELECT count(*) AS u FROM uni), sets AS (SELECT DISTINCT substr(gene, 1, 2) AS term, gene FROM de),
query AS (SELECT DISTINCT perturbation, CASE WHEN x > 0 THEN 'up' ELSE 'down' END AS direction, gene FROM de WHERE perturbation IS NOT NULL AND isfinite(x) AND isfinite(p) AND p <= 0.05 AND abs(x) >= 0.25),
nq AS (SELECT perturbation, direction, count(*) AS n FROM query GROUP BY ALL HAVING count(*) >= 10), nt AS (SELECT term, count(*) AS m FROM sets GROUP BY 1 HAVING count(*) BETWEEN 5 AND 5000),
o AS (SELECT h.*, n, m, u FROM (SELECT perturbation, direction, term, count(*) AS k FROM query JOIN sets USING (gene) GROUP BY ALL) h JOIN nq USING (perturbation, direction) JOIN nt USING (term), uu),
p AS (SELECT *, {_HYPER} AS p FROM o), t AS {sq.adjusted("p", "perturbation, direction", "p")}
SELECT perturbation, direction, term, k AS k_overlap, n AS query_size, m AS term_size, u AS universe_size, round(p, 6) AS p_value, round(q, 6) AS p_adj_bh FROM t""")
def c12_run_ora(spark, d):
    """Genes' name stems are the sets, the tested genes the universe; all terms."""
    de = load(spark, d, "perturbation_differential_genes").where("gene IS NOT NULL")
    sets = de.select(F.substring("gene", 1, 2).alias("term"), "gene").distinct()
    terms = co.run_ora(de, sets, de.select("gene"), co.Defaults(ora_terms=1_000_000))[0]
    return terms.select("perturbation", "direction", "term", "k_overlap", "query_size", "term_size", "universe_size", F.round("p_value", 6).alias("p_value"), F.round("p_adj_bh", 6).alias("p_adj_bh"))


@query("""WITH a AS (SELECT perturbation, avg(effect_l2_vs_control) AS x FROM perturbation_clusters WHERE perturbation IS NOT NULL GROUP BY 1),
b AS (SELECT perturbation, avg(score) AS y FROM perturbation_differential_genes WHERE perturbation IS NOT NULL AND score IS NOT NULL AND NOT isnan(score) GROUP BY 1),
t AS (SELECT perturbation, x, y FROM a FULL JOIN b USING (perturbation)), m AS (SELECT avg(x) AS mx, stddev_pop(x) AS sx, avg(y) AS my, stddev_pop(y) AS sy FROM t)
SELECT perturbation, round((x - mx) / sx, 4) AS mixscape_effect_z, round((y - my) / sy, 4) AS mixscale_score_mean_z FROM t, m""")
def c13_compare(spark, d):
    table, _ = _compared(spark, d)
    return table.select("perturbation", F.round("mixscape_effect_z", 4).alias("mixscape_effect_z"), F.round("mixscale_score_mean_z", 4).alias("mixscale_score_mean_z"))


def _compared(spark, d):
    effects = load(spark, d, "perturbation_clusters").where("perturbation IS NOT NULL")
    de = load(spark, d, "perturbation_differential_genes").where("perturbation IS NOT NULL")
    scores = de.where("score IS NOT NULL AND NOT isnan(score)").select("perturbation", F.col("score").alias("mixscale_score"))
    ps = effects.select("perturbation", F.col("n_cells").cast("double").alias("ps_score"))
    summary = ps.groupBy("perturbation").agg(F.avg("ps_score").alias("mean_ps_score"))
    return streams.compare_methods(effects, scores, de.select("perturbation", F.col("pval").alias("p_weight")), ps, summary)


_METRICS = {"mixscape_effect": "a", "mixscale_score_mean": "b", "ps_score_mean": "c", "mean_ps_score": "c"}


@query("""WITH a AS (SELECT perturbation, avg(effect_l2_vs_control) AS a, avg(n_cells) AS c FROM perturbation_clusters WHERE perturbation IS NOT NULL GROUP BY 1),
b AS (SELECT perturbation, avg(score) AS b FROM perturbation_differential_genes WHERE perturbation IS NOT NULL AND score IS NOT NULL AND NOT isnan(score) GROUP BY 1), t AS (SELECT a, b, c FROM a FULL JOIN b USING (perturbation)) """
+ " UNION ALL ".join(f"SELECT '{x}' AS metric_a, '{y}' AS metric_b, round(corr({_METRICS[x]}, {_METRICS[y]}), 6) AS pearson_r, count(*) FILTER ({_METRICS[x]} IS NOT NULL AND {_METRICS[y]} IS NOT NULL) AS n FROM t"
    for i, x in enumerate(_METRICS) for y in list(_METRICS)[i + 1 :]))
def c13_correlations(spark, d):
    return _compared(spark, d)[1].withColumn("pearson_r", F.round("pearson_r", 6))


@query(f"WITH {_STREAMS} SELECT perturbation, count(*) AS n_genes, round(sum(abs(effect_for_cluster)), 4) AS strength, sum(CASE WHEN n_streams_detected = 2 THEN 1 ELSE 0 END)::BIGINT AS n_both FROM c GROUP BY 1")
def c15_combine(spark, d):
    both = F.sum(F.when(F.col("n_streams_detected") == 2, 1).otherwise(0))
    return _combined(spark, d).groupBy("perturbation").agg(F.count(F.lit(1)).alias("n_genes"), F.round(F.sum(F.abs("effect_for_cluster")), 4).alias("strength"), both.alias("n_both"))


@query()
def c16_target_random(spark, d):
    targets = load(spark, d, "perturbation_clusters").where("n_cells >= 300").select("perturbation").where("perturbation IS NOT NULL")
    return co.target_random(cut(_combined(spark, d), "combined"), targets, "control", per_perturbation=2)


@query(f"""WITH {_STREAMS}, t AS (SELECT DISTINCT perturbation FROM perturbation_clusters WHERE n_cells >= 100 AND perturbation IS NOT NULL),
r AS (SELECT gene FROM c WHERE effect_for_cluster <> 0 AND perturbation IN (SELECT perturbation FROM t) GROUP BY 1 HAVING count(DISTINCT perturbation) >= (SELECT greatest(1, ceil(0.002::DOUBLE * greatest(1, count(*)))) FROM t)),
p AS (SELECT perturbation, gene, logfoldchange AS x, pval_adj AS p FROM perturbation_differential_genes WHERE perturbation IS NOT NULL AND gene IS NOT NULL AND logfoldchange IS NOT NULL AND NOT isnan(logfoldchange) AND pval_adj IS NOT NULL AND NOT isnan(pval_adj))
SELECT perturbation, count(*) AS n_points, sum(CASE WHEN p <= 0.05 AND abs(x) >= 0.25 THEN 1 ELSE 0 END)::BIGINT AS n_sig, sum(CASE WHEN gene IN (SELECT gene FROM r) THEN 1 ELSE 0 END)::BIGINT AS n_recurrent FROM p GROUP BY 1""")
def c18_volcano(spark, d):
    de = load(spark, d, "perturbation_differential_genes")
    targets = load(spark, d, "perturbation_clusters").where("n_cells >= 100 AND perturbation IS NOT NULL")
    return streams.volcano_counts(streams.volcano_points(de, streams.recurrent_genes(_combined(spark, d), targets, 0.002)))


@query(f"""WITH {GUIDE_SQL}, q AS (SELECT perturbation, count(*) AS n_cells, quantile_cont(umi, 0.25) AS q1, quantile_cont(umi, 0.75) AS q3 FROM guides WHERE perturbation <> 'scramble' GROUP BY 1 HAVING count(*) >= 40)
SELECT perturbation, max(n_cells) AS n_cells, count(*) FILTER (umi <= q1) AS n_low, count(*) FILTER (umi >= q3) AS n_high, round(avg(is_ko) FILTER (umi >= q3) - avg(is_ko) FILTER (umi <= q1), 6) AS delta
FROM guides JOIN q USING (perturbation) GROUP BY 1 HAVING count(*) FILTER (umi <= q1) >= 10 AND count(*) FILTER (umi >= q3) >= 10""")
def c19_strata(spark, d):
    out = strata.abundance_strata(guide_cells(spark, d).where("perturbation <> 'scramble'"), 40, 10)
    return out.select("perturbation", "n_cells", "n_low", "n_high", F.round("delta", 6).alias("delta"))
