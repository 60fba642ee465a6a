"""Queries of the general data problems, each with its SQL oracle where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from screenloom.operators.orphans import absorb, open_references, orphan_snapshots, parent_events, reference_events
from screenloom.operators.packed import split_packed, whole_number
from screenloom.operators.skew import heavy_keys, label_key, skewed_aggregate
from screenloom.session import load

NULL_WORDS = ["", "na", "n/a", "nan", "null", "none", "-"]


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    labels = load(spark, d, "cell_mixscape_labels").select(label_key("gene_target").alias("gene_target_key"))
    return heavy_keys(labels, ["gene_target_key"], 1.0).select("gene_target_key")


def p1_label_profile(spark: SparkSession, d: str) -> DataFrame:
    """Complete results per label, heavy and rare alike; null-like labels form the null group."""
    key = label_key("gene_target")
    cells = load(spark, d, "cell_mixscape_labels").select(
        F.when(~key.isin(NULL_WORDS), key).alias("gene_target_key"),
        "dataset",
        F.upper(F.trim("cell_barcode")).alias("cell"),
        "is_predicted_perturbed",
        F.nanvl("mixscape_class_p_ko", F.lit(None).cast("double")).alias("p_ko"),
        "loaded_at",
    )
    out = skewed_aggregate(
        cells,
        ["gene_target_key"],
        {
            "n_rows": F.count(F.lit(1)),
            "n_ko": F.sum("is_predicted_perturbed").cast("bigint"),
            "sum_p_ko": F.sum("p_ko"),
            "n_p_ko": F.count("p_ko"),
            "last_loaded_at": F.max("loaded_at"),
        },
        {"n_cells": F.when(F.col("cell").isNotNull(), F.struct(F.coalesce("dataset", F.lit("")).alias("d"), "cell"))},
    )
    return out.select(
        "gene_target_key", "n_rows", "n_cells", "n_ko",
        F.round(F.try_divide("sum_p_ko", "n_p_ko"), 6).alias("mean_p_ko"), "last_loaded_at",
    )


def p1_control_cells(spark: SparkSession, d: str) -> DataFrame:
    """Rows of each chunk and day under its data set's own control label, as ``samples`` names it, however
    either is spelled; a data set without such rows has one row with a null chunk and zeros. Labels
    that hold most of a data set are combined map-side first."""
    named = load(spark, d, "samples").select("dataset", label_key("control_label").alias("control_key"))
    named = named.where("dataset IS NOT NULL AND control_key <> ''").distinct()
    rows = load(spark, d, "cell_mixscape_labels").select("dataset", "source_chunk", label_key("gene_target").alias("control_key"), "is_predicted_perturbed", "loaded_at")
    counts = skewed_aggregate(
        rows.withColumn("day", F.to_date("loaded_at")), ["dataset", "source_chunk", "day", "control_key"],
        {"n_rows": F.count(F.lit(1)), "n_ko": F.sum("is_predicted_perturbed").cast("bigint")},
    )
    found = named.join(counts, ["dataset", "control_key"], "left")
    found = found.withColumns({c: F.coalesce(c, F.lit(0).cast("bigint")) for c in ("n_rows", "n_ko")})
    return found.select("dataset", "control_key", "source_chunk", F.date_format("day", "yyyy-MM-dd").alias("day"), "n_rows", "n_ko")


def _references(spark: SparkSession, d: str) -> DataFrame:
    columns = ["dataset", "cell_barcode", "loaded_at"]
    guides = load(spark, d, "guide_calls_csv").select(*columns, F.lit("guide_calls_csv").alias("source_table"))
    chunks = load(spark, d, "chunk_cells").select(*columns, F.lit("chunk_cells").alias("source_table"))
    return guides.unionByName(chunks)


def _orphan_state(spark: SparkSession, d: str) -> DataFrame:
    return absorb(reference_events(_references(spark, d)).unionByName(parent_events(load(spark, d, "obs_cells"))))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return open_references(_orphan_state(spark, d))


def p4_snapshots(spark: SparkSession, d: str) -> DataFrame:
    return orphan_snapshots(_orphan_state(spark, d))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    calls = load(spark, d, "guide_calls_csv").select("call_id", "num_umis")
    places = split_packed(calls, "num_umis").where("n_places >= 2")
    numbers = places.select("call_id", "position", whole_number("value").alias("umi_value"))
    return numbers.where(F.col("umi_value").isNotNull()).distinct()


def p5_places(spark: SparkSession, d: str) -> DataFrame:
    """Every place of every distinct call, also single values, empty places and marks."""
    calls = load(spark, d, "guide_calls_csv").select("call_id", "num_umis")
    places = split_packed(calls, "num_umis").distinct()
    mark = F.lower(F.trim("value")).isin(NULL_WORDS)
    return places.select("call_id", "position", "n_places", F.when(~mark, F.trim("value")).alias("value"))


QUERIES = {f.__name__: f for f in (p1_found, p1_label_profile, p1_control_cells, p4_found, p4_snapshots, p5_found, p5_places)}

_KEY = r"lower(trim(gene_target, ' ' || chr(9)))"
_REFS = """
refs AS (
  SELECT 'guide_calls_csv' AS source_table, dataset, upper(trim(cell_barcode)) AS cell_barcode, loaded_at
  FROM guide_calls_csv WHERE cell_barcode IS NOT NULL
  UNION ALL
  SELECT 'chunk_cells', dataset, upper(trim(cell_barcode)), loaded_at FROM chunk_cells WHERE cell_barcode IS NOT NULL),
obs AS (SELECT dataset, upper(trim(cell_barcode)) AS cell_barcode, loaded_at, removed_at FROM obs_cells)"""
_PLACES = r"""
raw AS (SELECT DISTINCT call_id, num_umis FROM guide_calls_csv WHERE num_umis IS NOT NULL),
a AS (SELECT call_id, num_umis, string_split(regexp_replace(num_umis, '[nN]/[aA]', 'NA', 'g'), '"') AS s FROM raw),
b AS (SELECT call_id, num_umis, string_split(array_to_string(list_transform(s, lambda x, i: CASE WHEN i % 2 = 0 THEN replace(x, ',', '') ELSE x END), ''), '''') AS s FROM a),
c AS (SELECT call_id, num_umis, array_to_string(list_transform(s, lambda x, i: CASE WHEN i % 2 = 0 THEN replace(x, ',', '') ELSE x END), '') AS s FROM b),
e AS (SELECT call_id, num_umis, regexp_replace(regexp_replace(trim(translate(s, '[]', '')), ' *([|;,/:\t]) *', '\1', 'g'), ' +', '|', 'g') AS s FROM c),
f AS (SELECT call_id, num_umis, string_split_regex(s, '[|;,/:\t]') AS v FROM e),
places AS (SELECT call_id, num_umis, len(v)::INTEGER AS n_places, unnest(v) AS value, unnest(range(1, len(v) + 1))::INTEGER AS position FROM f)"""

ORACLES = {
    "p1_found": f"""
WITH k AS (SELECT {_KEY} AS gene_target_key, count(*) AS n FROM cell_mixscape_labels GROUP BY 1)
SELECT gene_target_key FROM k WHERE gene_target_key IS NOT NULL AND n * 100 >= (SELECT sum(n) FROM k)""",
    "p1_label_profile": f"""
SELECT CASE WHEN {_KEY} IN ('', 'na', 'n/a', 'nan', 'null', 'none', '-') THEN NULL ELSE {_KEY} END AS gene_target_key,
  count(*) AS n_rows,
  count(DISTINCT CASE WHEN cell_barcode IS NOT NULL THEN coalesce(dataset, '') || '|' || upper(trim(cell_barcode)) END) AS n_cells,
  sum(is_predicted_perturbed)::BIGINT AS n_ko,
  round(avg(CASE WHEN NOT isnan(mixscape_class_p_ko) THEN mixscape_class_p_ko END), 6) AS mean_p_ko,
  max(loaded_at) AS last_loaded_at
FROM cell_mixscape_labels GROUP BY 1""",
    "p1_control_cells": f"""
WITH n AS (SELECT DISTINCT dataset, lower(trim(control_label, ' ' || chr(9))) AS control_key FROM samples WHERE dataset IS NOT NULL AND trim(control_label, ' ' || chr(9)) <> ''),
k AS (SELECT dataset, source_chunk, strftime(loaded_at, '%Y-%m-%d') AS day, {_KEY} AS control_key, count(*) AS n_rows, coalesce(sum(is_predicted_perturbed), 0)::BIGINT AS n_ko FROM cell_mixscape_labels GROUP BY ALL)
SELECT dataset, control_key, source_chunk, day, coalesce(n_rows, 0) AS n_rows, coalesce(n_ko, 0) AS n_ko FROM n LEFT JOIN k USING (dataset, control_key)""",
    "p4_found": f"""
WITH {_REFS}
SELECT DISTINCT source_table, dataset, cell_barcode, strftime(loaded_at, '%Y-%m') AS period FROM refs r
WHERE NOT EXISTS (SELECT 1 FROM obs o WHERE o.dataset = r.dataset AND o.cell_barcode = r.cell_barcode
  AND o.loaded_at <= r.loaded_at AND (o.removed_at IS NULL OR o.removed_at > r.loaded_at))""",
    "p4_snapshots": f"""
WITH {_REFS},
live AS (SELECT * FROM obs WHERE dataset IS NOT NULL AND cell_barcode IS NOT NULL AND loaded_at IS NOT NULL AND (removed_at IS NULL OR removed_at > loaded_at)),
months AS (SELECT DISTINCT date_trunc('month', t) AS m FROM (
  SELECT loaded_at AS t FROM refs UNION ALL SELECT loaded_at FROM live UNION ALL SELECT removed_at FROM live) WHERE t IS NOT NULL),
keyed AS (SELECT source_table, dataset, cell_barcode, date_trunc('month', loaded_at) AS m, count(*) AS n FROM refs
  WHERE loaded_at IS NOT NULL GROUP BY ALL),
gone AS (SELECT k.source_table, months.m, sum(k.n) AS n_references,
  sum(CASE WHEN NOT EXISTS (SELECT 1 FROM obs o WHERE o.dataset = k.dataset AND o.cell_barcode = k.cell_barcode
      AND o.loaded_at < months.m + INTERVAL 1 MONTH AND (o.removed_at IS NULL OR (o.removed_at >= months.m + INTERVAL 1 MONTH AND o.removed_at > o.loaded_at)))
    THEN k.n ELSE 0 END) AS n_open
  FROM keyed k JOIN months ON k.m <= months.m GROUP BY ALL)
SELECT source_table, strftime(m, '%Y-%m') AS period, n_references::BIGINT AS n_references, n_open::BIGINT AS n_open FROM gone""",
    "p5_found": f"""
WITH {_PLACES}
SELECT DISTINCT call_id, position, CAST(regexp_extract(value, '^(\\d+)(\\.0*)?$', 1) AS BIGINT) AS umi_value
FROM places WHERE n_places >= 2 AND regexp_full_match(value, '\\d+(\\.0*)?')""",
    "p5_places": f"""
WITH {_PLACES}
SELECT call_id, position, n_places,
  CASE WHEN lower(trim(value)) IN ('', 'na', 'n/a', 'nan', 'null', 'none', '-') THEN NULL ELSE trim(value) END AS value FROM places""",
}
