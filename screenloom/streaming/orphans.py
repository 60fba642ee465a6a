"""Orphan references over files that keep arriving.

Each micro-batch is absorbed into the keyed state left by the batch before: references probe the
parents known so far, parents that arrive late resolve those that wait, removals open them again.
A batch leaves three folders under the root: ``state/batch=n``, ``changes/batch=n`` (what was
opened, resolved and reopened) and ``open/batch=n`` (a snapshot of the open references per table
and month). A batch that is run again writes the same folders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from screenloom.operators.orphans import KEY, absorb
from screenloom.session import drop_path


def _changes(before: DataFrame | None, after: DataFrame) -> DataFrame:
    """(source_table, dataset, cell_barcode, ts, change) of references whose verdict is new."""
    mark = [F.col(c) for c in ("source_table", *KEY, "ts")]
    one = lambda df, name: df.where("source_table IS NOT NULL").groupBy(*mark).agg(F.max("open").alias(name))
    now = one(after, "now")
    if before is None:
        rows = now.withColumn("was", F.lit(None).cast("boolean"))
    else:
        was = one(before, "was").select(*[c.alias(f"__{k}") for c, k in zip(mark, ("t", "d", "c", "s"))], "was")
        same = [c.eqNullSafe(F.col(f"__{k}")) for c, k in zip(mark, ("t", "d", "c", "s"))]
        rows = now.join(was, same, "left")
    change = F.when(F.col("was").isNull() & F.col("now"), "opened").when(F.col("was") & ~F.col("now"), "resolved").when(~F.col("was") & F.col("now"), "reopened")
    return rows.withColumn("change", change).where("change IS NOT NULL").select(*mark, "change")


def follow(events: DataFrame, root: str) -> StreamingQuery:
    """Start the job on a stream of events (source_table, dataset, cell_barcode, ts, delta, n) in
    any order. The state before the last one is deleted; the last is kept for a batch that has to
    be run again. The query stops when the files there are worked off."""
    kind = events.schema.add("open", "boolean")

    def step(batch: DataFrame, n: int) -> None:
        spark: SparkSession = batch.sparkSession
        at = lambda name, k: f"{root}/{name}/batch={k}"
        before = spark.read.schema(kind).parquet(at("state", n - 1)) if n else None
        absorb(batch, before).write.mode("overwrite").parquet(at("state", n))
        after = spark.read.schema(kind).parquet(at("state", n))
        _changes(before, after).write.mode("overwrite").parquet(at("changes", n))
        waiting = after.where("open").groupBy("source_table", F.date_format("ts", "yyyy-MM").alias("period")).agg(F.sum("n").alias("n_open"))
        waiting.write.mode("overwrite").parquet(at("open", n))
        if n > 1:
            drop_path(spark, at("state", n - 2))

    writer = events.writeStream.foreachBatch(step).option("checkpointLocation", f"{root}/checkpoint")
    return writer.trigger(availableNow=True).start()
