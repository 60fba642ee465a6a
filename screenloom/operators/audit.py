"""Inspection of inputs before a run: structure, label columns, counts, readiness."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from screenloom.operators.expression import integer_like
from screenloom.operators.relational import recommend

# The columns and control labels that are tried, in order.
LABEL_COLUMNS = ["gene_target", "guide_target", "target_gene", "perturbation", "perturbation_label", "gene", "target", "sgRNA", "sgrna", "guide"]
CONTROL_LABELS = ["Non-Targeting", "non-targeting", "NTC", "NT", "negative", "neg", "control", "CTRL"]


def structure(df: DataFrame) -> DataFrame:
    """(column, type, n_rows, n_null, n_distinct): one aggregate over all columns, the distinct
    counts approximate."""
    parts = [
        F.struct(F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("type"), F.count(F.lit(1)).alias("n_rows"),
                 F.sum(F.col(f"`{f.name}`").isNull().cast("bigint")).alias("n_null"), F.approx_count_distinct(F.col(f"`{f.name}`").cast("string")).alias("n_distinct"))
        for f in df.schema
    ]
    return df.agg(F.array(*parts).alias("p")).select(F.inline("p"))


def top_labels(df: DataFrame, column: str, n: int = 20) -> DataFrame:
    """The ``n`` most frequent values with nulls shown as ``<NA>``, ties by value."""
    label = F.coalesce(F.col(column).cast("string"), F.lit("<NA>"))
    return df.groupBy(label.alias("label")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "label").limit(n)


def label_counts(df: DataFrame, columns: list[str], labels: list[str]) -> DataFrame:
    """(column, label, n) of the candidate labels in the candidate columns, from one pass."""
    present = [c for c in columns if c in df.columns]
    wide = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("label")) for c in present])).alias("e"))
    return wide.select("e.*").where(F.col("label").isin(labels)).groupBy("column", "label").agg(F.count(F.lit(1)).alias("n"))


def recommend_labels(df: DataFrame, columns: list[str] = LABEL_COLUMNS, labels: list[str] = CONTROL_LABELS) -> DataFrame:
    """The label column and control label with the most cells, as ``recommend``."""
    present = [c for c in columns if c in df.columns]
    if not present:
        return df.sparkSession.createDataFrame([(None, None, 0, False)], "pert_col string, control_label string, control_count bigint, ready boolean")
    return recommend(label_counts(df, present, labels), present, labels)


def raw_count_source(layers: dict[str, DataFrame], column: str = "value", least: float = 0.95) -> DataFrame:
    """(source, integer_share): the first of the layers, in order, whose values are whole numbers
    to at least ``least``; ``none`` where there is none."""
    parts = [integer_like(df, column).select(F.lit(i).alias("i"), F.lit(name).alias("source"), "integer_share") for i, (name, df) in enumerate(layers.items())]
    found = reduce(DataFrame.unionByName, parts).where(F.col("integer_share") >= least)
    best = found.agg(F.min(F.struct("i", "source", "integer_share")).alias("b"))
    return best.select(F.coalesce("b.source", F.lit("none")).alias("source"), "b.integer_share")


# Layer names that hold raw counts.
COUNT_LAYERS = ["counts", "raw_counts", "raw", "umi", "umis"]


def count_source(layers: dict[str, DataFrame], column: str = "value", least: float = 0.95) -> DataFrame:
    """(source, integer_share): a layer whose name says counts, the first of ``COUNT_LAYERS``;
    else the first other layer without values or with whole numbers to at least ``least``."""
    names = {n.lower(): n for n in layers}
    named = next((names[c] for c in COUNT_LAYERS if c in names), None)
    if named is not None:
        return integer_like(layers[named], column).select(F.lit(named).alias("source"), "integer_share")
    return raw_count_source(layers, column, least)


def require_counts(report: DataFrame, source: DataFrame) -> None:
    """The gate before a run: raise unless all checks hold and there is a source of raw counts."""
    require_ready(report)
    if source.first().source == "none":
        raise ValueError("not ready: no source of raw counts")


def architecture(df: DataFrame) -> DataFrame:
    """(column, type, n_rows, low, high): the shape of a table, and the least and greatest of its
    columns of numbers, null for others; one aggregate over all columns."""
    number = lambda f: f.dataType.typeName() in ("byte", "short", "integer", "long", "float", "double")
    v = lambda f: F.nanvl(F.col(f"`{f.name}`").cast("double"), F.lit(None).cast("double")) if number(f) else F.lit(None).cast("double")
    parts = [
        F.struct(F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("type"), F.count(F.lit(1)).alias("n_rows"), F.min(v(f)).alias("low"), F.max(v(f)).alias("high"))
        for f in df.schema
    ]
    return df.agg(F.array(*parts).alias("p")).select(F.inline("p"))


def dataset_audit(name: str, cells: DataFrame, layers: dict[str, DataFrame], calls: DataFrame | None = None) -> DataFrame:
    """One row of an audit: (dataset, n_cells, pert_col, control_label, control_count, raw_source,
    n_overlap, ready). ``n_overlap`` counts the barcodes that the guide calls share with the
    cells, null without calls; ready needs a control label that occurs and raw counts."""
    labels = recommend_labels(cells)
    source = count_source(layers).select(F.col("source").alias("raw_source"))
    both = None if calls is None else calls.select("cell_barcode").distinct().join(cells.select("cell_barcode").distinct(), "cell_barcode", "left_semi")
    one = {"n_cells": cells.agg(F.count(F.lit(1))).scalar(), "raw_source": source.agg(F.max("raw_source")).scalar()}
    out = labels.withColumns(one).withColumn("n_overlap", F.lit(None).cast("bigint") if both is None else both.agg(F.count(F.lit(1))).scalar())
    ready = F.col("ready") & (F.col("raw_source") != "none")
    return out.select(F.lit(name).alias("dataset"), "n_cells", "pert_col", "control_label", "control_count", "raw_source", "n_overlap", ready.alias("ready"))


def guide_summary(calls: DataFrame, cells: DataFrame, control: str) -> DataFrame:
    """One row: rows, distinct barcodes and targets, control rows, and barcodes among the cells."""
    base = calls.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("cell_barcode").alias("n_barcodes"), F.count_distinct("gene_target").alias("n_targets"),
        F.sum(F.coalesce((F.col("gene_target") == control).cast("bigint"), F.lit(0))).alias("n_control_rows"),
    )
    both = calls.select("cell_barcode").distinct().join(cells.select("cell_barcode").distinct(), "cell_barcode", "left_semi")
    return base.withColumn("n_overlap", both.agg(F.count(F.lit(1))).scalar())


def readiness(checks: list[tuple[str, bool, str]], df: DataFrame) -> DataFrame:
    """(name, ok, detail, ready): the checks and whether all hold."""
    rows = df.sparkSession.createDataFrame(checks, "name string, ok boolean, detail string")
    return rows.withColumn("ready", F.lit(all(ok for _, ok, _ in checks)))


def require_ready(report: DataFrame) -> None:
    """Raise with the failed checks unless all hold."""
    failed = [r.name for r in report.where("NOT ok").collect()]
    if failed:
        raise ValueError("not ready: " + ", ".join(failed))
