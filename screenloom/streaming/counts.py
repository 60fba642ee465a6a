"""Guide calls per label, counted as files arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from screenloom.operators.skew import label_key
from screenloom.session import drop_path


def label_counts(calls: DataFrame, root: str) -> StreamingQuery:
    """Running counts per label under ``root/counts/batch=n``; those of the batch before the last
    are deleted. The state is one number a label, kept by the query's state store; partial counts
    are combined in each task before the shuffle, and every task writes its own labels."""
    counted = calls.groupBy(label_key("gene_target").alias("gene_target_key")).agg(F.count(F.lit(1)).alias("n"))

    def step(batch: DataFrame, n: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/counts/batch={n}")
        if n > 1:
            drop_path(batch.sparkSession, f"{root}/counts/batch={n - 2}")

    writer = counted.writeStream.outputMode("complete").foreachBatch(step).option("checkpointLocation", f"{root}/checkpoint")
    return writer.trigger(availableNow=True).start()
