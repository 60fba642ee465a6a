"""Writers. A table goes out through its own partitions; nothing is gathered."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_tsv(df: DataFrame, path: str, gzip: bool = False) -> None:
    """Tab-separated text with a header; nulls are empty."""
    df.write.mode("overwrite").options(header=True, sep="\t", compression="gzip" if gzip else "none", quote='"', escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)


def write_chunks(df: DataFrame, path: str, chunk: str = "chunk_id") -> None:
    """One folder per chunk. Each task writes its own rows of a chunk, so that a large chunk is no
    single task."""
    df.write.mode("overwrite").partitionBy(chunk).parquet(path)


def write_list(df: DataFrame, column: str, path: str) -> None:
    """One value a line, without a header."""
    df.select(F.col(column).cast("string")).where(F.col(column).isNotNull()).write.mode("overwrite").text(path)


def write_wide(matrix: DataFrame, row: str, column: str, value: str, columns: list[str], path: str) -> None:
    """(row, column, value) as a wide table with the given columns, absent entries 0."""
    wide = matrix.groupBy(row).pivot(column, columns).agg(F.sum(value))
    write_tsv(wide.fillna(0, columns), path)


def write_metadata(spark: SparkSession, meta: dict, path: str) -> None:
    """A small JSON record of a run."""
    _write_text(spark, json.dumps(meta, indent=2, sort_keys=True, default=str), path)


def mark_done(spark: SparkSession, folder: str) -> None:
    _write_text(spark, "ok\n", f"{folder}/done.txt")


def _write_text(spark: SparkSession, text: str, path: str) -> None:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).create(hadoop, True)
    out.write(bytearray(text.encode()))
    out.close()
