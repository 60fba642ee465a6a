"""Queries of the training-data problems, each with its SQL oracle where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from screenloom.llm.clusters import describe_clusters, linked_clusters, pivot_clusters, points
from screenloom.llm.leaks import leaked_passages, reworded_passages
from screenloom.llm.packing import fill_containers, fill_report, token_counts
from screenloom.llm.percentiles import digit_histogram, merge_histograms, percentiles_of_histogram, radix_percentiles
from screenloom.llm.subjects import composition, main_subjects, subject_words
from screenloom.llm.topn import top_n
from screenloom.session import cut, load


COORDINATES = [f"delta_pc{k}" for k in range(1, 13)]


PERCENTS = [1, 5, 25, 50, 75, 95, 99]


def _umi_results(spark: SparkSession, d: str) -> DataFrame:
    """Partial results of 0 or more, exact redeliveries removed."""
    rows = load(spark, d, "hct_mixscape_ko_by_umi_decile").where("median_guide_umi >= 0 AND NOT isnan(median_guide_umi)")
    return rows.distinct()


def p2_percentiles(spark: SparkSession, d: str) -> DataFrame:
    found = radix_percentiles(_umi_results(spark, d), ["dataset", "umi_decile"], "median_guide_umi", PERCENTS)
    return found.withColumn("max_error", F.lit(0.0))


def _bounded(found: DataFrame) -> DataFrame:
    return found.withColumns({c: F.round(c, 6) for c in ("value", "low", "high")})


def p2_combined_days(spark: SparkSession, d: str) -> DataFrame:
    """Percentiles of all days from the states of single days, with the bounds of their error."""
    daily = digit_histogram(_umi_results(spark, d), ["dataset", "umi_decile", "run_date"], "median_guide_umi")
    whole = merge_histograms(daily, ["dataset", "umi_decile"])
    return _bounded(percentiles_of_histogram(whole, ["dataset", "umi_decile"], PERCENTS))


def p2_daily_percentiles(spark: SparkSession, d: str) -> DataFrame:
    daily = digit_histogram(_umi_results(spark, d), ["dataset", "run_date"], "median_guide_umi")
    return _bounded(percentiles_of_histogram(daily, ["dataset", "run_date"], PERCENTS))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    pts = points(load(spark, d, "perturbation_clusters"), "perturbation", COORDINATES)
    rows = linked_clusters(pts, 1.0).select("component", "name").distinct()
    found = rows.groupBy("component").agg(F.min("name").alias("perturbation_a"), F.count(F.lit(1)).alias("n")).where("n >= 3")
    out = rows.join(found, "component").where("name <> perturbation_a")
    return out.select("perturbation_a", F.col("name").alias("perturbation_b"))


def p3_clusters(spark: SparkSession, d: str) -> DataFrame:
    pts = points(load(spark, d, "perturbation_clusters"), "perturbation", COORDINATES)
    members, _ = pivot_clusters(pts, 1.0)
    return describe_clusters(members).withColumn("spread", F.round("spread", 6))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return p6_top_genes(spark, d).select("perturbation", "gene")


def p6_top_genes(spark: SparkSession, d: str) -> DataFrame:
    return top_n(load(spark, d, "perturbation_differential_genes"), "perturbation", "gene", "score", 10)


def _placed(spark: SparkSession, d: str, capacity: int) -> DataFrame:
    sizes = token_counts(load(spark, d, "documents").select("doc_id", "text"), "text")
    return fill_containers(sizes, "doc_id", "n_tokens", capacity)


def p7_pack_2048(spark: SparkSession, d: str) -> DataFrame:
    return _placed(spark, d, 2048)


def p7_pack_8192(spark: SparkSession, d: str) -> DataFrame:
    return _placed(spark, d, 8192)


def p7_fill(spark: SparkSession, d: str) -> DataFrame:
    reports = [fill_report(_placed(spark, d, c), c).withColumn("capacity", F.lit(c)) for c in (2048, 8192)]
    return reports[0].unionByName(reports[1])


def p7_checks(spark: SparkSession, d: str) -> DataFrame:
    """What must hold of both packings, per capacity: every document is placed, no container is
    over its capacity, no document is cut that fits, its pieces hold each of its tokens once, no
    place is given twice, and at most 2 % of the room is left (or what one container leaves)."""
    sizes = cut(token_counts(load(spark, d, "documents").select("doc_id", "text"), "text"), "sizes")
    out = []
    for capacity in (2048, 8192):
        placed = cut(fill_containers(sizes, "doc_id", "n_tokens", capacity), "placed")
        docs = placed.groupBy("doc_id").agg(F.sum("n_tokens").alias("n"), F.max(F.col("start") + F.col("n_tokens")).alias("end"), F.count(F.lit(1)).alias("pieces"))
        docs = docs.join(sizes.withColumnRenamed("n_tokens", "size"), "doc_id")
        whole = (F.col("n") == F.col("size")) & (F.col("end") == F.col("size")) & (F.col("pieces") == F.greatest(F.lit(1), F.ceil(F.col("size") / capacity)))
        boxes = placed.where("container IS NOT NULL").groupBy("container").agg(F.sum("n_tokens").alias("n"), F.count(F.lit(1)).alias("k"), F.count_distinct("slot").alias("slots"))
        a = docs.agg(F.count(F.lit(1)).alias("n_documents"), F.sum((~whole).cast("bigint")).alias("n_broken"))
        over, twice = F.sum((F.col("n") > capacity).cast("bigint")), F.sum((F.col("k") != F.col("slots")).cast("bigint"))
        b = boxes.agg(F.struct(F.coalesce(over, F.lit(0)).alias("o"), F.coalesce(twice, F.lit(0)).alias("t"), (F.coalesce(F.sum("n"), F.lit(0)) >= 0.98 * capacity * (F.count(F.lit(1)) - 1)).alias("f"))).scalar()
        out.append(a.withColumn("b", b).select(F.lit(capacity).alias("capacity"), "n_documents", "n_broken", F.col("b.o").alias("n_over"), F.col("b.t").alias("n_twice"), F.col("b.f").alias("well_filled")))
    return out[0].unionByName(out[1])


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return leaked_passages(load(spark, d, "documents"), load(spark, d, "eval_items"))


def p8_reworded(spark: SparkSession, d: str) -> DataFrame:
    return reworded_passages(load(spark, d, "documents"), load(spark, d, "eval_items"))


def _subjects(spark: SparkSession, d: str) -> DataFrame:
    return subject_words(load(spark, d, "documents"), load(spark, d, "subject_areas"), load(spark, d, "eval_items"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return main_subjects(_subjects(spark, d)).select("doc_id", "subject")


def p9_composition(spark: SparkSession, d: str) -> DataFrame:
    return composition(_subjects(spark, d))


QUERIES = {f.__name__: f for f in (p2_percentiles, p2_combined_days, p2_daily_percentiles, p3_found, p3_clusters, p6_found, p6_top_genes, p7_pack_2048, p7_pack_8192, p7_fill, p7_checks, p8_found, p8_reworded, p9_found, p9_composition)}

_BITS = """
WITH v AS (SELECT {groups}, median_guide_umi AS x FROM (SELECT DISTINCT * FROM hct_mixscape_ko_by_umi_decile)
  WHERE median_guide_umi >= 0 AND NOT isnan(median_guide_umi)),
r AS (SELECT *, row_number() OVER (PARTITION BY {groups} ORDER BY x) AS k, count(*) OVER (PARTITION BY {groups}) AS n FROM v),
q AS (SELECT unnest([1, 5, 25, 50, 75, 95, 99])::INTEGER AS percentile),
h AS (SELECT {groups}, percentile, n, x, CASE WHEN x > 0 THEN pow(2.0::DOUBLE, floor(log2(x)) - 9) END AS step FROM r JOIN q ON k = greatest(1, (n * percentile + 99) // 100)),
b AS (SELECT *, CASE WHEN x > 0 THEN floor(x / step) * step ELSE 0.0 END AS low, CASE WHEN x > 0 THEN floor(x / step) * step + step - step * pow(2.0::DOUBLE, -43) ELSE 0.0 END AS high FROM h)
SELECT {groups}, percentile, n AS n_values, round((low + high) / 2, 6) AS value, round(low, 6) AS low, round(high, 6) AS high FROM b
"""
_TOP = """
WITH v AS (SELECT DISTINCT perturbation, gene, score + 0.0 AS score FROM perturbation_differential_genes
  WHERE perturbation IS NOT NULL AND score IS NOT NULL AND NOT isnan(score)),
r AS (SELECT *, (row_number() OVER (PARTITION BY perturbation ORDER BY score DESC, gene NULLS LAST))::INTEGER AS rank FROM v)
"""
_WINDOWS = """
WITH w AS (SELECT {key}, list_transform(regexp_extract_all(text, '[A-Za-z0-9_]+'), lambda x: lower(x)) AS words FROM {table} WHERE text IS NOT NULL)
SELECT DISTINCT {key}, array_to_string(words[s:s + 12], ' ') AS passage
FROM (SELECT {key}, words, unnest(range(1, len(words) - 11)) AS s FROM w WHERE len(words) >= 13)
"""
_DIMS = [f"delta_pc{k}" for k in range(1, 13)]
ORACLES = {
    "p2_percentiles": """
WITH v AS (SELECT dataset, umi_decile, median_guide_umi AS x FROM (SELECT DISTINCT * FROM hct_mixscape_ko_by_umi_decile)
  WHERE median_guide_umi >= 0 AND NOT isnan(median_guide_umi)),
r AS (SELECT *, row_number() OVER (PARTITION BY dataset, umi_decile ORDER BY x) AS k, count(*) OVER (PARTITION BY dataset, umi_decile) AS n FROM v),
q AS (SELECT unnest([1, 5, 25, 50, 75, 95, 99])::INTEGER AS percentile)
SELECT dataset, umi_decile, percentile, n AS n_values, x + 0.0 AS value, 0.0::DOUBLE AS max_error
FROM r JOIN q ON k = greatest(1, (n * percentile + 99) // 100)""",
    "p2_combined_days": _BITS.format(groups="dataset, umi_decile"),
    "p2_daily_percentiles": _BITS.format(groups="dataset, run_date"),
    "p7_checks": """SELECT c AS capacity, n AS n_documents, 0::BIGINT AS n_broken, 0::BIGINT AS n_over, 0::BIGINT AS n_twice, true AS well_filled
FROM (SELECT unnest([2048, 8192])::INTEGER AS c), (SELECT count(*) AS n FROM documents)""",
    "p3_found": f"""
WITH RECURSIVE p AS (SELECT DISTINCT perturbation AS n, {", ".join(_DIMS)} FROM perturbation_clusters
  WHERE perturbation IS NOT NULL AND {" AND ".join(f"{c} IS NOT NULL AND NOT isnan({c})" for c in _DIMS)}),
e AS (SELECT a.n AS a, b.n AS b FROM p a JOIN p b ON abs(a.delta_pc1 - b.delta_pc1) <= 1
  AND {" + ".join(f"(a.{c} - b.{c}) ** 2" for c in _DIMS)} <= 1.0),
c(a, b) AS (SELECT a, b FROM e UNION SELECT c.a, e.b FROM c JOIN e ON c.b = e.a),
m AS (SELECT a AS n, min(b) AS root FROM c GROUP BY a),
s AS (SELECT root FROM m GROUP BY root HAVING count(*) >= 3)
SELECT root AS perturbation_a, n AS perturbation_b FROM m WHERE root IN (SELECT root FROM s) AND n <> root""",
    "p3_clusters": f"""
WITH RECURSIVE p AS (SELECT DISTINCT perturbation AS name, [{", ".join(_DIMS)}] AS x FROM perturbation_clusters
  WHERE perturbation IS NOT NULL AND {" AND ".join(f"isfinite({c})" for c in _DIMS)}),
o AS (SELECT row_number() OVER (ORDER BY substr(md5(name), 1, 12), name) AS i, name, x FROM p),
near AS (SELECT a.i, list(b.i) AS before FROM o a JOIN o b ON b.i < a.i AND abs(a.x[1] - b.x[1]) <= 1
  AND {" + ".join(f"(a.x[{k}] - b.x[{k}]) ** 2" for k in range(1, 13))} <= 1.0 GROUP BY a.i),
b AS (SELECT o.i, coalesce(near.before, []) AS before FROM o LEFT JOIN near USING (i)),
g(r, pivots, taken) AS (SELECT 0, []::BIGINT[], []::BIGINT[] UNION ALL
  SELECT r + 1, coalesce(list(i) FILTER (list_has_all(taken, before)), []), coalesce(list(i) FILTER (list_has_any(pivots, before)), [])
  FROM g, b WHERE len(pivots) + len(taken) < (SELECT count(*) FROM o) GROUP BY r),
q AS (SELECT o.* FROM o JOIN (SELECT unnest(pivots) AS i FROM g WHERE r = (SELECT max(r) FROM g)) USING (i)),
m AS (SELECT a.i, a.name, a.x, arg_min(q.i, (d, q.name)) AS c FROM (SELECT o.i, o.name, o.x, q.i AS qi,
    {" + ".join(f"(o.x[{k}] - q.x[{k}]) ** 2" for k in range(1, 13))} AS d FROM o JOIN q ON abs(o.x[1] - q.x[1]) <= 1) a JOIN q ON q.i = a.qi WHERE d <= 1.0 GROUP BY ALL),
v AS (SELECT c, k, avg(x[k]) AS u FROM m, range(1, 13) t(k) GROUP BY ALL),
f AS (SELECT m.c, m.name, sum((m.x[v.k] - v.u) ** 2) AS far FROM m JOIN v USING (c) GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY round(far, 9), name) AS r FROM f)
SELECT min(name) AS cluster_name, count(*) AS size, max(name) FILTER (r = 1) AS medoid, string_agg(name, ',' ORDER BY r) FILTER (r <= 3) AS typical, round(sqrt(avg(far)), 6) AS spread FROM r GROUP BY c""",
    "p6_found": _TOP + "SELECT perturbation, gene FROM r WHERE rank <= 10",
    "p6_top_genes": _TOP + "SELECT perturbation, gene, score, rank FROM r WHERE rank <= 10",
    "p8_found": f"""
SELECT DISTINCT doc_id, item_id FROM ({_WINDOWS.format(key="doc_id", table="documents")}) a
JOIN ({_WINDOWS.format(key="item_id", table="eval_items")}) b USING (passage)""",
}
