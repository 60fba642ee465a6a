"""Further queries of the engine's own operators and composites, with their SQL twins; names as in
``catalog``."""

from __future__ import annotations

from pyspark.sql import functions as F

from screenloom.functions.columns import is_true, label_seed
from screenloom.operators import audit, ora, sampling, streams
from screenloom.operators import expression as ex
from screenloom.operators import relational as rel
from screenloom.plans import catalog
from screenloom.plans import composites as co
from screenloom.plans import sqlparts as sq
from screenloom.plans.catalog import _BULK, _MANIFEST, _ORA, _STREAMS, query
from screenloom.plans.views import CONTROL_MANY, CONTROL_SIZE, COUNTS_SQL, FINE_SQL, GUIDE_SQL, MANY_SQL
from screenloom.plans.views import cells, cells_by_size, cells_many, counts, gene_sets, guide_cells
from screenloom.session import load, scratch_path
from screenloom.sources import sinks, tables

# Sources.


@query(f"WITH {FINE_SQL} SELECT DISTINCT gene FROM counts")
def s11_gene_universe(spark, d):
    return tables.gene_universe(counts(spark, d, True))


_FIELDS = ["h5ad", "guide_calls_csv", "pert_col", "control_label"]


@query(f"""SELECT dataset, {", ".join(_FIELDS)} FROM (SELECT DISTINCT nullif(trim(dataset), '') AS dataset, {", ".join(f"nullif(trim({c}), '') AS {c}" for c in _FIELDS)} FROM samples WHERE lower(trim(enabled)) = 'true')
WHERE dataset IS NOT NULL QUALIFY row_number() OVER (PARTITION BY dataset ORDER BY {", ".join(f"{c} NULLS LAST" for c in _FIELDS)}) = 1""")
def s12_registry(spark, d):
    return tables.dataset_registry(load(spark, d, "samples"))


@query("SELECT DISTINCT 'c_mktsegment=' || c_mktsegment AS chunk_id FROM customer")
def s16_chunk_ids(spark, d):
    root = scratch_path(spark, "chunks")
    load(spark, d, "customer").select("c_custkey", "c_mktsegment").write.partitionBy("c_mktsegment").csv(root)
    return spark.createDataFrame([(c,) for c in tables.chunk_ids(spark, root, "*.csv")], "chunk_id string")


@query(f"WITH {MANY_SQL} SELECT cell_barcode, perturbation FROM cells ORDER BY md5('4|' || cell_barcode), cell_barcode LIMIT 500")
def s18_load_sample(spark, d):
    return tables.load_cells(cells_many(spark, d), None, 500, 4)


@query("SELECT count(*) AS n_rows, count(DISTINCT dataset) AS n_datasets, max(dataset) AS last_dataset FROM obs_cells")
def s22_audit_record(spark, d):
    """The record is written as JSON and read back."""
    path = f"{scratch_path(spark, 'audit')}/audit.json"
    row = load(spark, d, "obs_cells").agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("dataset").alias("n_datasets"), F.max("dataset").alias("last_dataset")).first()
    sinks.write_metadata(spark, row.asDict(), path)
    back = tables.read_audit(spark, path)
    return spark.createDataFrame([(back["n_rows"], back["n_datasets"], back["last_dataset"])], "n_rows bigint, n_datasets bigint, last_dataset string")


@query(f"WITH {_MANIFEST} SELECT cell_barcode, perturbation FROM cells WHERE cell_barcode IN (SELECT cell_barcode FROM m WHERE chunk_id = 'chunk_0001')")
def s23_load_chunk(spark, d):
    return tables.load_cells(cells_many(spark, d), catalog._manifest(spark, d).where("chunk_id = 'chunk_0001'"))


# Filters and joins.

_PREFIX = [f"delta_pc{k}" for k in range(1, 13)]


@query(" UNION ALL ".join(f"SELECT '{c}' AS name, {k}::INTEGER AS place, round(avg({c}), 6) AS mean FROM perturbation_clusters WHERE NOT isnan({c})" for k, c in enumerate(_PREFIX)))
def f12_matching_columns(spark, d):
    rows = load(spark, d, "perturbation_clusters")
    found = rel.matching_columns(rows.columns, "delta_pc")
    v = lambda c: F.avg(F.nanvl(c, F.lit(None).cast("double")))
    parts = [F.struct(F.lit(c).alias("name"), F.lit(k).alias("place"), F.round(v(c), 6).alias("mean")) for k, c in enumerate(found)]
    return rows.agg(F.array(*parts).alias("p")).select(F.inline("p"))


@query(f"""WITH {MANY_SQL}, s AS (SELECT CAST(o_orderkey AS VARCHAR) AS cell_barcode, o_orderstatus AS l FROM orders WHERE o_totalprice > 100000)
SELECT cell_barcode, coalesce(l, 'control') AS perturbation FROM cells LEFT JOIN s USING (cell_barcode)""")
def f13_label_or_control(spark, d):
    chosen = load(spark, d, "orders").where("o_totalprice > 100000").select(F.col("o_orderkey").cast("string").alias("cell_barcode"), F.col("o_orderstatus").alias("perturbation"))
    return rel.label_or_control(cells_many(spark, d), chosen, "control")


@query("SELECT c_custkey, coalesce(u.v, c_acctbal) AS c_acctbal FROM customer LEFT JOIN (SELECT o_custkey, max(o_totalprice) AS v FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) u ON o_custkey = c_custkey")
def j03_aligned_update(spark, d):
    new = load(spark, d, "orders").where("o_orderstatus = 'F'").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_totalprice").alias("c_acctbal"))
    return rel.aligned_update(load(spark, d, "customer").select("c_custkey", "c_acctbal"), new, "c_custkey", ["c_acctbal"])


@query(f"""WITH {_MANIFEST}, t AS (SELECT perturbation, count(*) AS n_selected_cells FROM cells GROUP BY 1), s AS (SELECT gene_target AS perturbation, count(*) AS n FROM m WHERE is_control = 0 GROUP BY 1)
SELECT perturbation, n_selected_cells, n AS n_selected_cells_from_chunks FROM t LEFT JOIN s USING (perturbation)""")
def j04_from_chunks(spark, d):
    table = rel.min_count(cells_many(spark, d), "perturbation", 1, out="n_selected_cells")
    per = catalog._manifest(spark, d).where("is_control = 0").groupBy("chunk_id", F.col("gene_target").alias("perturbation")).agg(F.count(F.lit(1)).alias("n_selected_perturbed_cells"))
    return co.with_chunk_counts(table, per)


_A, _B = "(SELECT DISTINCT upper(trim(cell_barcode)) AS k FROM obs_cells WHERE cell_barcode IS NOT NULL)", "(SELECT DISTINCT upper(trim(cell_barcode)) AS k FROM guide_calls_csv WHERE cell_barcode IS NOT NULL)"


@query(f"SELECT count(a.k) AS n_a, count(b.k) AS n_b, count(*) FILTER (a.k IS NOT NULL AND b.k IS NOT NULL) AS n_both, round(count(*) FILTER (a.k IS NOT NULL AND b.k IS NOT NULL) / count(a.k), 6) AS rate_a, round(count(*) FILTER (a.k IS NOT NULL AND b.k IS NOT NULL) / count(b.k), 6) AS rate_b FROM {_A} a FULL JOIN {_B} b ON a.k = b.k")
def j06_match_rates(spark, d):
    side = lambda t: load(spark, d, t).select(F.upper(F.trim("cell_barcode")).alias("k"))
    return rel.match_rates(side("obs_cells"), side("guide_calls_csv"), "k").withColumns({c: F.round(c, 6) for c in ("rate_a", "rate_b")})


@query(f"WITH {_ORA}, s AS (SELECT unnest(['global_de', 'mixscape']) AS stream) SELECT stream, perturbation, direction, term, k AS k_overlap FROM o, s WHERE perturbation IN ('SIZE_1', 'SIZE_2')")
def j16_terms_of_targets(spark, d):
    universe = load(spark, d, "part").select(F.concat("p_brand", F.lit("|"), "p_type").alias("gene"))
    terms = ora.over_representation(catalog._ora_query(spark, d), gene_sets(spark, d), universe)
    targets = terms.select("perturbation").where("perturbation <> 'SIZE_0'")
    return ora.terms_of_targets({"global_de": terms, "mixscape": terms}, targets).select("stream", "perturbation", "direction", "term", "k_overlap")


# Aggregates, order, sets, samples.


@query(f"WITH {COUNTS_SQL} SELECT gene, count(*) AS n_nonzero, count(*) * 12 AS n_bytes FROM counts WHERE value <> 0 GROUP BY 1")
def a25_gene_bytes(spark, d):
    return ex.gene_bytes(counts(spark, d))


@query(f"""WITH {_BULK} SELECT gene, round(sum(abs(value)) / 5, 6) AS mean_abs, round(greatest((sum(value * value) - sum(value) * sum(value) / 5) / 4, 0), 4) AS variance FROM bulk GROUP BY 1""")
def a33_gene_scores(spark, d):
    bulk = ex.pseudobulk(counts(spark, d), cells(spark, d))
    size = ex.gene_scores(bulk, 5, "mean_abs").select("gene", F.round("score", 6).alias("mean_abs"))
    return size.join(ex.gene_scores(bulk, 5).select("gene", F.round("score", 4).alias("variance")), "gene")


_FEATURES = f"""WITH {_STREAMS}, own AS (SELECT DISTINCT gene FROM (SELECT gene, row_number() OVER (PARTITION BY perturbation ORDER BY abs(effect_for_cluster) DESC, gene) AS r FROM c) WHERE r <= {{k}})"""


@query(_FEATURES.format(k=2) + " SELECT gene FROM own")
def o04_feature_genes(spark, d):
    return streams.feature_genes(catalog._combined(spark, d), 2, 20)


@query(_FEATURES.format(k=1) + """ SELECT gene FROM own UNION ALL (SELECT gene FROM c WHERE gene NOT IN (SELECT gene FROM own) GROUP BY 1
ORDER BY max(abs(effect_for_cluster)) DESC, gene LIMIT (SELECT greatest(0, (SELECT count(DISTINCT gene) - 25 FROM c) - count(*)) FROM own))""")
def o05_feature_genes_topped_up(spark, d):
    """Topped up to all genes but 25."""
    combined = catalog._combined(spark, d)
    return streams.feature_genes(combined, 1, combined.select("gene").distinct().count() - 25)


@query("""SELECT perturbation, gene, rank FROM (SELECT perturbation, gene, row_number() OVER (PARTITION BY perturbation ORDER BY y DESC, x DESC, gene)::INTEGER AS rank FROM
(SELECT perturbation, gene, logfoldchange AS x, -log10(greatest(pval_adj, 1e-300)) AS y FROM perturbation_differential_genes WHERE perturbation IS NOT NULL AND gene IS NOT NULL AND isfinite(logfoldchange) AND isfinite(pval_adj))) WHERE rank <= 25""")
def o06_volcano_labels(spark, d):
    points = streams.volcano_points(load(spark, d, "perturbation_differential_genes"), load(spark, d, "part").select(F.col("p_brand").alias("gene")).distinct())
    return streams.volcano_labels(points).select("perturbation", "gene", "rank")


@query("SELECT perturbation, gene, row_number() OVER (PARTITION BY perturbation ORDER BY rank NULLS LAST, gene)::INTEGER AS position FROM perturbation_differential_genes WHERE perturbation IS NOT NULL")
def o07_first_usable(spark, d):
    rows = load(spark, d, "perturbation_differential_genes").withColumn("weight", F.lit(None).cast("double"))
    return rel.ordered_by_first_usable(rows, "perturbation", "gene", ["weight", "rank", "score"])


@query(f"WITH {MANY_SQL} SELECT perturbation, count(*) AS n_cells FROM cells GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 7")
def o08_largest_labels(spark, d):
    return rel.largest_labels(cells_many(spark, d), "perturbation", 7)


@query("SELECT dataset, count(*) AS n, count(num_umis) AS n_umis, count(chunk_id) AS n_chunks FROM (SELECT * FROM guide_calls_csv UNION ALL BY NAME SELECT * FROM chunk_cells) GROUP BY 1")
def u02_stacked(spark, d):
    both = rel.stacked([load(spark, d, "guide_calls_csv"), load(spark, d, "chunk_cells")])
    return both.groupBy("dataset").agg(F.count(F.lit(1)).alias("n"), F.count("num_umis").alias("n_umis"), F.count("chunk_id").alias("n_chunks"))


@query("SELECT perturbation FROM (SELECT DISTINCT perturbation FROM perturbation_clusters WHERE perturbation IS NOT NULL) ORDER BY md5('13|' || perturbation), perturbation LIMIT 20")
def r06_volcano_sample(spark, d):
    names = load(spark, d, "perturbation_clusters").select("perturbation").where("perturbation IS NOT NULL").distinct()
    return sampling.sample_rows(names, "perturbation", 20, 13)


@query(f"WITH {_MANIFEST} SELECT chunk_id, cell_barcode, gene_target, is_control FROM m WHERE is_control = 0 UNION ALL SELECT chunk_id, cell_barcode, gene_target, is_control FROM m WHERE is_control = 1 QUALIFY row_number() OVER (PARTITION BY chunk_id ORDER BY md5('3|' || cell_barcode), cell_barcode) <= 10")
def r07_recap_controls(spark, d):
    return sampling.recap_controls(catalog._manifest(spark, d), 10, 3)


@query(f"""WITH {MANY_SQL} SELECT cell_barcode, perturbation AS gene_target, 0 AS is_control FROM cells WHERE perturbation = 'NATION_3'
UNION ALL (SELECT cell_barcode, perturbation, 1 FROM cells WHERE perturbation = '{CONTROL_MANY}' ORDER BY md5('9|' || cell_barcode), cell_barcode LIMIT 40)""")
def r08_one_perturbation(spark, d):
    return sampling.one_perturbation(cells_many(spark, d), "perturbation", "NATION_3", CONTROL_MANY, 40, 9)


# Audit.

_TYPES = {"dataset": "string", "source_chunk": "string", "run_date": "date", "umi_decile": "int", "n_cells": "int", "n_ko": "int", "median_guide_umi": "double", "mean_guide_umi": "double", "ko_rate": "double", "loaded_at": "timestamp_ntz"}
_NUMBERS = ("int", "double")


@query(" UNION ALL ".join(
    f"SELECT '{c}' AS column, '{t}' AS type, count(*) AS n_rows, " + (f"min({c}::DOUBLE) FILTER (NOT isnan({c}::DOUBLE)) AS low, max({c}::DOUBLE) FILTER (NOT isnan({c}::DOUBLE)) AS high" if t in _NUMBERS else "NULL::DOUBLE AS low, NULL::DOUBLE AS high") + " FROM hct_mixscape_ko_by_umi_decile"
    for c, t in _TYPES.items()))
def v04_architecture(spark, d):
    return audit.architecture(load(spark, d, "hct_mixscape_ko_by_umi_decile"))


_SHARE = "round(avg(CASE WHEN abs(x - round(x)) <= 1e-8 THEN 1.0 ELSE 0.0 END)::DOUBLE, 6)"


@query(f"SELECT 'UMIs' AS source, {_SHARE} AS integer_share FROM (SELECT mean_guide_umi AS x FROM hct_mixscape_ko_by_umi_decile WHERE mean_guide_umi IS NOT NULL)")
def v05_named_source(spark, d):
    """A layer that its name says holds counts is taken before one that looks like it."""
    rows = load(spark, d, "hct_mixscape_ko_by_umi_decile")
    layers = {"X": rows.select(F.col("n_cells").cast("double").alias("value")), "UMIs": rows.select(F.col("mean_guide_umi").alias("value"))}
    return audit.count_source(layers).withColumn("integer_share", F.round("integer_share", 6))


@query("""SELECT 'all' AS dataset, count(*) AS n_cells, 'gene_target' AS pert_col, 'Non-Targeting' AS control_label, 0::BIGINT AS control_count, 'counts' AS raw_source,
(SELECT count(DISTINCT cell_barcode) FROM guide_calls_csv WHERE cell_barcode IN (SELECT cell_barcode FROM obs_cells)) AS n_overlap, false AS ready FROM obs_cells""")
def c25_dataset_audit(spark, d):
    """None of the usual control labels occurs in these cells, so that they are not ready."""
    rows = load(spark, d, "obs_cells")
    return audit.dataset_audit("all", rows, {"counts": rows.select(F.col("n_counts").cast("double").alias("value"))}, load(spark, d, "guide_calls_csv"))


# Composites.

_CALLS = """calls AS (SELECT cell_barcode, gene_target FROM guide_calls_csv WHERE lower(trim(pass_guide_filter)) = 'true'),
kept AS (SELECT gene_target, ((row_number() OVER (ORDER BY gene_target) - 1) // 16)::INTEGER AS i FROM (SELECT gene_target FROM calls WHERE cell_barcode IS NOT NULL AND gene_target IS NOT NULL AND gene_target <> 'Scramble' GROUP BY 1 HAVING count(*) >= 5))"""


def _calls_manifest(spark, d):
    return co.manifest_from_calls(load(spark, d, "guide_calls_csv"), "Scramble", is_true("pass_guide_filter"), 16, 5, 0, 2)


@query(f"""WITH {_CALLS} SELECT 'chunk_' || lpad(CAST(i AS VARCHAR), 4, '0') AS chunk_id, cell_barcode, gene_target, 0 AS is_control FROM calls JOIN kept USING (gene_target) WHERE cell_barcode IS NOT NULL
UNION ALL SELECT 'chunk_' || lpad(CAST(i AS VARCHAR), 4, '0'), cell_barcode, gene_target, 1 FROM calls, (SELECT DISTINCT i FROM kept) WHERE gene_target = 'Scramble' AND cell_barcode IS NOT NULL""")
def c02_manifest_of_calls(spark, d):
    return _calls_manifest(spark, d)[0]


@query(f"""WITH {_CALLS} SELECT count(*) AS total_rows, count(*) FILTER (gene_target = 'Scramble') AS n_control_cells_global, count(DISTINCT coalesce(gene_target, '<NA>')) AS n_perturbations_all,
(SELECT count(*) FROM kept) AS n_perturbations_kept, (SELECT count(DISTINCT i) FROM kept) AS n_chunks FROM calls""")
def c02_manifest_meta(spark, d):
    return _calls_manifest(spark, d)[1]


_DE_COLUMNS = catalog._DE_COLUMNS


@query(f"""WITH {MANY_SQL}, {FINE_SQL}, sel AS (SELECT cell_barcode, perturbation FROM cells JOIN orders ON cell_barcode = CAST(o_orderkey AS VARCHAR) WHERE o_totalprice > 100000 AND perturbation <> '{CONTROL_MANY}'),
kept AS (SELECT * FROM sel WHERE perturbation IN (SELECT perturbation FROM sel GROUP BY 1 HAVING count(*) >= 20) UNION ALL SELECT cell_barcode, perturbation FROM cells WHERE perturbation = '{CONTROL_MANY}'),
own AS (SELECT counts.*, sum(value) OVER (PARTITION BY cell_barcode) AS t FROM counts WHERE cell_barcode IN (SELECT cell_barcode FROM kept)), goal AS (SELECT median(t) AS g FROM (SELECT DISTINCT cell_barcode, t FROM own)),
vals AS (SELECT cell_barcode, gene, ln(1 + value * g / t) AS value FROM own, goal), {sq.differential_expression("vals", "kept", CONTROL_MANY)}
SELECT perturbation, rank, gene, {_DE_COLUMNS} FROM de WHERE rank <= 200""")
def c06_postprocess_de(spark, d):
    rows = cells_many(spark, d)
    large = load(spark, d, "orders").where("o_totalprice > 100000").select(F.col("o_orderkey").cast("string").alias("cell_barcode"))
    return catalog._rounded(co.postprocess_de(counts(spark, d, True), tables.select_barcodes(rows, large), rows, CONTROL_MANY)[1])


@query(catalog.ORACLES["n15_mixscale"])
def c07_run_mixscale(spark, d):
    """On plain values; the composite's default takes the differences from the nearest controls."""
    found, _ = co.run_mixscale(counts(spark, d), cells_by_size(spark, d), CONTROL_SIZE, co.Defaults(neighbours=0, n_pcs=2))
    return found.withColumn("mixscale_score", F.round("mixscale_score", 6))


@query(catalog.ORACLES["n16_efficiency"])
def c09_run_ps(spark, d):
    """On plain values, as ``c07_run_mixscale``."""
    _, summary = co.run_ps(counts(spark, d), cells_by_size(spark, d), CONTROL_SIZE, co.Defaults(neighbours=0, n_pcs=2))
    return summary.withColumns({c: F.round(c, 6) for c in ("mean_ps_score", "sd_ps_score")})


@query("""SELECT perturbation, gene, effect_value, rank FROM (SELECT perturbation, gene, logfoldchange AS effect_value, rank FROM perturbation_differential_genes)
WHERE perturbation IS NOT NULL AND gene IS NOT NULL AND isfinite(effect_value)""")
def c14_full_sibling(spark, d):
    """The full ranking that lies beside the file of the best genes is read."""
    root = scratch_path(spark, "stream")
    rows = load(spark, d, "perturbation_differential_genes").select("perturbation", "gene", "logfoldchange", "rank", "pval_adj").where("NOT isnan(logfoldchange)")
    sinks.write_tsv(rows.where("rank <= 5"), f"{root}/de.tsv")
    sinks.write_tsv(rows, f"{root}/de_full.tsv")
    return streams.read_stream(spark, f"{root}/de.tsv", "global_de").select("perturbation", "gene", "effect_value", "rank")


_KNOWN = "p AS (SELECT DISTINCT perturbation FROM perturbation_clusters WHERE perturbation IS NOT NULL), t AS (SELECT DISTINCT perturbation FROM perturbation_differential_genes WHERE rank = 1 AND perturbation IS NOT NULL)"


@query(f"""WITH {_KNOWN}, r AS (SELECT perturbation, 'target' AS role FROM t WHERE perturbation IN (SELECT perturbation FROM p) UNION ALL SELECT perturbation, 'missing' FROM t WHERE perturbation NOT IN (SELECT perturbation FROM p)
UNION ALL (SELECT perturbation, 'random' FROM p WHERE perturbation NOT IN (SELECT perturbation FROM t) ORDER BY md5('11|' || perturbation), perturbation LIMIT 50)),
n AS (SELECT gene_target AS perturbation, count(DISTINCT cell_barcode) AS n FROM obs_cells WHERE gene_target IS NOT NULL GROUP BY 1)
SELECT perturbation, role, coalesce(n, 0) AS n_cells FROM r LEFT JOIN n USING (perturbation)""")
def c17_selected_table(spark, d):
    known = load(spark, d, "perturbation_clusters").where("perturbation IS NOT NULL")
    targets = load(spark, d, "perturbation_differential_genes").where("rank = 1 AND perturbation IS NOT NULL")
    return sampling.selected_with_counts(known, targets, load(spark, d, "obs_cells").withColumnRenamed("gene_target", "perturbation"), 50, False, 11)


_BY_METHOD = " UNION ALL ".join(
    f"""SELECT '{m}' AS method, perturbation, 'target' AS "group" FROM tg WHERE perturbation IN (SELECT perturbation FROM cp) UNION ALL SELECT '{m}', 'control', 'control'
UNION ALL (SELECT '{m}', perturbation, 'random' FROM cp WHERE perturbation NOT IN (SELECT perturbation FROM tg) ORDER BY md5('{label_seed(5, m)}|' || perturbation), perturbation LIMIT (SELECT count(*) FROM tg))"""
    for m in ("deg_global_de", "deg_mixscape")
)


@query(f"""WITH {_STREAMS}, cp AS (SELECT DISTINCT perturbation FROM c), tg AS (SELECT DISTINCT perturbation FROM perturbation_clusters WHERE n_cells >= 300 AND perturbation IS NOT NULL) {_BY_METHOD}""")
def c20_by_method(spark, d):
    targets = load(spark, d, "perturbation_clusters").where("n_cells >= 300").select("perturbation").where("perturbation IS NOT NULL")
    combined = catalog.cut(catalog._combined(spark, d), "combined")
    found = co.target_random_by_method({"global_de": combined, "mixscape": combined}, targets, "control", seed=5, per_perturbation=2)
    return found.select("method", "perturbation", "group")


_CLASSES = {"ring": "ring", "widget": "Widget", "small": "SMALL", "red": "red"}


@query(f"""SELECT DISTINCT class, p_brand FROM part, (VALUES {", ".join(f"('{c}', '{w.lower()}')" for c, w in _CLASSES.items())}) t(class, word) WHERE contains(lower(p_name), word) AND p_brand IS NOT NULL""")
def c23_gene_lists(spark, d):
    return co.gene_lists(load(spark, d, "part"), "p_brand", "p_name", _CLASSES)


@query(f"""WITH {COUNTS_SQL}, q AS (SELECT cell_barcode, sum(value) AS t, count(*) AS g, sum(CASE WHEN gene LIKE 'Brand#1%' THEN value ELSE 0 END) / sum(value) AS s FROM counts WHERE value <> 0 GROUP BY 1)
SELECT count(*) AS n_cells, min(t) AS min_total_counts, round(avg(t), 6) AS mean_total_counts, max(t) AS max_total_counts, min(g) AS min_n_genes, round(avg(g), 6) AS mean_n_genes, max(g) AS max_n_genes, round(avg(s), 6) AS mean_share_marked FROM q""")
def c27_quality(spark, d):
    out = ex.quality_report(ex.cell_quality(counts(spark, d), "brand#1"))
    return out.withColumns({c: F.round(c, 6) for c in ("mean_total_counts", "mean_n_genes", "mean_share_marked")})


def _diagnostic(spark, d):
    both = guide_cells(spark, d)
    return co.guide_diagnostic(both.select("cell_barcode", "perturbation", "is_ko"), both.select("cell_barcode", "umi"), "scramble", 40, 10)


_TAIL = sq.hypergeometric_upper("kh", "(nh + nl)", "(kh + kl)", "nh")


@query(f"""WITH {GUIDE_SQL}, q AS (SELECT perturbation, quantile_cont(umi, 0.25) AS q1, quantile_cont(umi, 0.75) AS q3 FROM guides WHERE perturbation <> 'scramble' GROUP BY 1 HAVING count(*) >= 40),
s AS (SELECT perturbation, count(*) FILTER (umi <= q1) AS nl, count(*) FILTER (umi >= q3) AS nh, (sum(is_ko) FILTER (umi <= q1))::BIGINT AS kl, (sum(is_ko) FILTER (umi >= q3))::BIGINT AS kh FROM guides JOIN q USING (perturbation) GROUP BY 1)
SELECT perturbation, nl AS n_low, nh AS n_high, kl AS ko_low, kh AS ko_high, round({_TAIL}, 6) AS p_value FROM s WHERE nl >= 10 AND nh >= 10""")
def c28_strata(spark, d):
    per = _diagnostic(spark, d)[1]
    return per.select("perturbation", "n_low", "n_high", "ko_low", "ko_high", F.round("p_value", 6).alias("p_value"))


@query(f"WITH {GUIDE_SQL} SELECT count(DISTINCT cell_barcode) AS n_a, count(DISTINCT cell_barcode) AS n_b, count(DISTINCT cell_barcode) AS n_both, 1.0::DOUBLE AS rate_a, 1.0::DOUBLE AS rate_b FROM guides")
def c28_rates(spark, d):
    return _diagnostic(spark, d)[0]
