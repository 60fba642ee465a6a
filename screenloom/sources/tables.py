"""Readers of the file formats that screens come in. Schemas are given, never inferred."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from screenloom.functions.columns import is_true
from screenloom.operators.relational import chunk_labels, keep_first
from screenloom.operators.sampling import sample_rows
from screenloom.schema import empty


def path_exists(spark: SparkSession, path: str, non_empty: bool = False) -> bool:
    """Whether a path (or a glob) names a file or folder, with any bytes where ``non_empty``."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    found = system.globStatus(hadoop)
    if not found:
        return False
    return not non_empty or any(system.getContentSummary(f.getPath()).getLength() > 0 for f in found)


def read_table(spark: SparkSession, path: str | list[str], schema: str, sep: str = "\t", columns: list[str] | None = None) -> DataFrame:
    """Delimited text with a header; gzip and the like are recognised by name. Every column is
    read as text by name and cast leniently, so that a bad value is null and column order does
    not matter. Missing columns are null."""
    wanted = empty(spark, schema).schema
    raw = spark.read.options(header=True, sep=sep, inferSchema=False, quote='"', escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    have = {c.lower(): c for c in raw.columns}
    pick = [
        (F.col(f"`{have[f.name.lower()]}`").try_cast(f.dataType) if f.name.lower() in have else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in wanted
        if columns is None or f.name in columns
    ]
    return raw.select(*pick)


def _header(spark: SparkSession, path: str) -> str:
    """The first line of the first file under ``path`` that has any bytes."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    hadoop = jvm.org.apache.hadoop.fs.Path(path)
    system = hadoop.getFileSystem(conf)
    found = [f for top in system.globStatus(hadoop) for f in (system.listStatus(top.getPath()) if top.isDirectory() else [top])]
    found = sorted((f.getPath().toString() for f in found if f.getLen() and f.getPath().getName()[0] not in "_."))
    if not found:
        return ""
    file = jvm.org.apache.hadoop.fs.Path(found[0])
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(file)
    raw = system.open(file)
    lines = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(codec.createInputStream(raw) if codec else raw))
    try:
        return lines.readLine() or ""
    finally:
        lines.close()


def read_many(spark: SparkSession, paths: list[str], schema: str, sep: str = "\t") -> DataFrame:
    """The union of tables, missing and zero-byte ones skipped; no table gives no rows. Tables with
    equal headers are one scan, so that the plan does not grow with their number."""
    alike: dict[str, list[str]] = {}
    for p in paths:
        if path_exists(spark, p, non_empty=True):
            alike.setdefault(_header(spark, p), []).append(p)
    out = empty(spark, schema)
    for some in alike.values():
        out = out.unionByName(read_table(spark, some, schema, sep))
    return out


def read_finished_chunks(spark: SparkSession, root: str, name: str, schema: str, marker: str = "done.txt") -> DataFrame:
    """``name`` in every folder under ``root`` that has a marker, tagged with ``source_chunk``.

    Markers are listed as files and matched with a semi-join on the folder, so the number of
    chunks does not matter to the driver.
    """
    if not path_exists(spark, f"{root}/*/{marker}"):
        return empty(spark, schema + ", source_chunk string")
    folder = lambda c: F.regexp_extract(c, "([^/]+)/[^/]+$", 1)
    done = spark.read.format("binaryFile").load(f"{root}/*/{marker}").select(folder("path").alias("source_chunk"))
    raw = spark.read.options(header=True, sep="\t").csv(f"{root}/*/{name}")
    rows = raw.withColumn("source_chunk", folder(F.col("_metadata.file_path")))
    fields = [F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in empty(spark, schema).schema]
    return rows.select(*fields, "source_chunk").join(done, "source_chunk", "left_semi")


def read_gene_sets(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Gene-set files (term, description, genes by tab) as distinct (term, gene); the term is
    ``file_stem:term``. Lines of fewer than three fields and blank genes are left out; equal
    terms merge."""
    if not paths:
        return empty(spark, "term string, gene string")
    lines = spark.read.text(paths).select(F.split("value", "\t").alias("f"), F.col("_metadata.file_name").alias("file"))
    stem = F.regexp_replace("file", r"(\.gmt|\.txt)(\.gz)?$", "")
    rows = lines.where(F.size("f") >= 3).select(
        F.concat(stem, F.lit(":"), F.trim(F.col("f")[0])).alias("term"), F.explode(F.slice("f", 3, 1 << 30)).alias("gene")
    )
    return rows.select("term", F.trim("gene").alias("gene")).where("gene <> ''").distinct()


def read_target_list(spark: SparkSession, path: str, out: str = "perturbation") -> DataFrame:
    """One symbol a line, blanks and ``#`` comments skipped, the first of equal symbols kept in
    its order: (ord, symbol), ``ord`` from 0 in the order of files and lines."""
    at = F.struct(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("b"), F.monotonically_increasing_id().alias("i"))
    lines = spark.read.text(path).select(F.trim("value").alias(out), at.alias("at"))
    rows = lines.where((F.col(out) != "") & ~F.col(out).startswith("#"))
    first = rows.groupBy(out).agg(F.min("at").alias("at")).select(F.struct("at", out).alias("k"))
    return chunk_labels(first, "k", 1).select(F.col("chunk_index").alias("ord"), F.col(f"k.{out}").alias(out))


def label_scan(df: DataFrame, barcode: str, label: str) -> DataFrame:
    """Two columns of a cell table as (cell_barcode, gene_target), as text."""
    for c in (barcode, label):
        if c not in df.columns:
            raise ValueError(f"no column {c}")
    return df.select(F.col(barcode).cast("string").alias("cell_barcode"), F.col(label).cast("string").alias("gene_target"))


def decode_categories(df: DataFrame, code: str, categories: DataFrame) -> DataFrame:
    """The label of each category code (categories: code, label); code -1 and unknown codes are
    null."""
    return df.join(categories.select(F.col("code").alias(code), "label"), code, "left")


def matrix_sample(counts: DataFrame, n: int) -> DataFrame:
    """The first ``n`` stored values in (cell, gene) order."""
    return counts.orderBy("cell_barcode", "gene").limit(n)


def select_barcodes(df: DataFrame, barcodes: DataFrame, key: str = "cell_barcode", required: bool = False) -> DataFrame:
    """The rows of the given distinct non-null barcodes: a semi-join, whose strategy the sizes
    decide. Where ``required``, no match is an error."""
    found = df.join(barcodes.select(key).where(F.col(key).isNotNull()).distinct(), key, "left_semi")
    if required and not found.limit(1).count():
        raise ValueError(f"no {key} of the selection is in the table")
    return found


def load_cells(df: DataFrame, chunk: DataFrame | None = None, max_cells: int = 0, seed: int = 0, key: str = "cell_barcode") -> DataFrame:
    """The cells of a run: those of a chunk's manifest where one is given (at least one must be
    there), else all or a sample of ``max_cells`` where that is above 0."""
    if chunk is not None:
        return select_barcodes(df, chunk, key, required=True)
    return sample_rows(df, key, max_cells, seed)


def gene_universe(counts: DataFrame) -> DataFrame:
    """The distinct genes of a matrix."""
    return counts.select("gene").where("gene IS NOT NULL").distinct()


def require_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """``df``, or an error that names the columns it lacks."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError("missing columns: " + ", ".join(missing))
    return df


def dataset_registry(samples: DataFrame) -> DataFrame:
    """The data sets switched on, once each (equal rows merge; of others the first by path), with
    blank fields as nulls."""
    text = [F.when(F.trim(c) != "", F.trim(c)).alias(c) for c in samples.columns]
    rows = samples.where(is_true("enabled")).select(*text).where("dataset IS NOT NULL").distinct()
    others = [F.col(c).asc_nulls_last() for c in rows.columns if c != "dataset"]
    return keep_first(rows, ["dataset"], others).drop("enabled")


def chunk_ids(spark: SparkSession, root: str, name: str) -> list[str]:
    """The folders under ``root`` that hold ``name``, in order; none is an error."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/*/{name}")
    found = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(hadoop) or []
    if not len(found):
        raise ValueError(f"no {name} in any folder of {root}")
    return sorted(f.getPath().getParent().getName() for f in found)


def read_audit(spark: SparkSession, path: str) -> dict:
    """A record of a run as it was written by ``sinks.write_metadata``."""
    return json.loads("\n".join(r.value for r in spark.read.text(path, wholetext=True).collect()))


def filtered_guide_calls(calls: DataFrame, keep: DataFrame, passed: Column, order: list[Column]) -> DataFrame:
    """Guide calls of the barcodes in ``keep`` that pass the filter, one call per barcode, the
    first in ``order``."""
    return keep_first(select_barcodes(calls.where(passed), keep), ["cell_barcode"], order)
