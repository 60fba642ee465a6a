"""References to records that do not exist at the time of the reference.

The state is keyed by (dataset, cell_barcode). A key holds its parent index, which is the steps
of its *balance* (an arrival adds one parent, a removal takes one away), and its references, each
marked ``open`` while no parent is present at its time. ``absorb`` takes the next batch of
events: new references probe the parent index, parents that arrive, also late ones, resolve the
references that wait, and removals open them again. Batches may come in any order; only the keys
a batch touches are decided again. A history worked off in one batch or in many gives one state.
``open_references`` and ``orphan_snapshots`` read the state.

Nulls: a parent without key or arrival time, or removed no later than it arrived, is never
present. A reference with a null barcode is no case. One with a null parent scope (``dataset``)
or a null time can match no parent and is an orphan, its period null when its time is. Repeated
parents raise and lower the balance together, repeated references give the same verdict and
count as often as they occur. Empty tables give an empty state.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from screenloom.session import cut

KEY = ["dataset", "cell_barcode"]
COLUMNS = ["source_table", *KEY, "ts", "delta", "n"]
#: A key is cut into ranges of time when it holds 0.1 % of a batch's events and this many.
HOT_PERCENT, HOT_ROWS = 0.1, 50_000
#: Keys that the sketch of frequent keys follows; its counts are right to 1 / 6000 of the events.
FOLLOWED = 8192


def barcode_key(column: str = "cell_barcode") -> Column:
    """Barcodes compare in upper case without surrounding blanks."""
    return F.upper(F.trim(F.col(column)))


def reference_events(refs: DataFrame) -> DataFrame:
    """References (source_table, dataset, cell_barcode, loaded_at) as events without a step."""
    rows = refs.select(
        "source_table", "dataset", barcode_key().alias("cell_barcode"), F.col("loaded_at").alias("ts"),
        F.lit(0).cast("bigint").alias("delta"), F.lit(1).cast("bigint").alias("n"),
    )
    return rows.where(F.col("cell_barcode").isNotNull())


def parent_events(parents: DataFrame) -> DataFrame:
    """Parents (dataset, cell_barcode, loaded_at, removed_at) as steps up and down; they have no
    ``source_table`` and count as no reference."""
    live = (
        parents.select("dataset", barcode_key().alias("cell_barcode"), "loaded_at", "removed_at")
        .where(F.col("dataset").isNotNull() & F.col("cell_barcode").isNotNull())
        .where(F.col("loaded_at").isNotNull())
        .where(F.col("removed_at").isNull() | (F.col("removed_at") > F.col("loaded_at")))
    )
    arrived = F.struct(F.col("loaded_at").alias("ts"), F.lit(1).cast("bigint").alias("delta"))
    removed = F.struct(F.col("removed_at").alias("ts"), F.lit(-1).cast("bigint").alias("delta"))
    steps = live.select(*KEY, F.inline(F.array(arrived, removed))).where(F.col("ts").isNotNull())
    return steps.select(F.lit(None).cast("string").alias("source_table"), *KEY, "ts", "delta", F.lit(0).cast("bigint").alias("n"))


def absorb(
    events: DataFrame, state: DataFrame | None = None, hot_percent: float = HOT_PERCENT, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """The state after a batch: (source_table, dataset, cell_barcode, ts, delta, n, open), one
    row per reference (``open`` says whether it waits for a parent) and per step of a parent
    (``source_table`` null).

    ``events`` are read once. They are written together with what the state knows of their keys,
    and a sketch of frequent keys comes out of the same pass. One shuffle by key and a running
    sum then decide all references. Keys that hold a large share would be one task's work; they
    are cut by ``_ranged`` instead. Keys the batch does not touch keep their rows.
    """
    spark, rest = events.sparkSession, None
    rows = events.select(*COLUMNS)
    if state is not None:
        # Keys with a null match nothing: their references stay open and need no new verdict.
        touched = events.select(*KEY).distinct()
        rows = rows.unionByName(state.join(touched, KEY, "left_semi").select(*COLUMNS))
        rest = state.join(touched, KEY, "left_anti").select(*COLUMNS, "open")
    seen, key = Observation("frequent keys"), F.xxhash64(*KEY)
    most = int(100 / hot_percent)
    figures = [F.expr(f"approx_top_k(__h, {most}, {max(FOLLOWED, 8 * most)})").alias("top"), F.count(F.lit(1)).alias("n")]
    rows = cut(rows.withColumn("__h", key).observe(seen, *figures).drop("__h"), "events")
    found = seen.get
    least = max(hot_rows, (found["n"] or 0) * hot_percent / 100)
    hot = [r["item"] for r in found["top"] or [] if r["count"] >= least and r["item"] is not None]
    if hot:
        # At most 100 / hot_percent numbers, whatever the input.
        is_hot = key.isin(hot)
        decided = _decided(rows.where(~is_hot), KEY).unionByName(_ranged(rows.where(is_hot)))
    else:
        decided = _decided(rows, KEY)
    return decided if rest is None else decided.unionByName(rest)


def _decided(rows: DataFrame, key: list[str], opening: Column | None = None) -> DataFrame:
    """Rows with ``open``: at the time of a reference, steps of that time included, the balance
    is not positive. References without a time come before all steps."""
    upto = Window.partitionBy(*key).orderBy(F.col("ts").asc_nulls_first()).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    balance = F.sum("delta").over(upto)
    balance = balance if opening is None else balance + opening
    waits = F.when(F.col("source_table").isNotNull(), F.col("ts").isNull() | (balance <= 0))
    return rows.withColumn("open", waits).select(*COLUMNS, "open")


def _ranged(rows: DataFrame) -> DataFrame:
    """``_decided`` for keys of any number of events: events of one time are added up in their
    tasks, the rest is cut into ranges of (key, time), within a day where a day is crowded, and
    every range is decided on its own from the balance that the ranges before it leave."""
    packed = rows.groupBy("source_table", *KEY, "ts").agg(F.sum("delta").alias("delta"), F.sum("n").alias("n"))
    ranges = packed.repartitionByRange(*KEY, "ts").withColumn("__p", F.spark_partition_id())
    # Kept, so that both uses see the same ranges.
    ranges = cut(ranges, "ranges")
    sums = ranges.groupBy(*KEY, "__p").agg(F.sum("delta").alias("d"))
    before = Window.partitionBy(*KEY).orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*[F.col(k).alias(f"__{k}") for k in KEY], F.col("__p").alias("__q"), F.coalesce(F.sum("d").over(before), F.lit(0)).alias("__o"))
    same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in KEY]
    opened = ranges.join(sums, [*same, F.col("__p") == F.col("__q")])
    return _decided(opened, [*KEY, "__p"], F.col("__o"))


def open_references(state: DataFrame) -> DataFrame:
    """Distinct (source_table, dataset, cell_barcode, period) of the references that wait; the
    period is the month ``yyyy-MM`` of the reference."""
    return state.where("open").select("source_table", *KEY, F.date_format("ts", "yyyy-MM").alias("period")).distinct()


def orphan_references(refs: DataFrame, parents: DataFrame, **options) -> DataFrame:
    """``open_references`` of a history that is absorbed in one batch."""
    return open_references(absorb(reference_events(refs).unionByName(parent_events(parents)), **options))


def orphan_snapshots(state: DataFrame) -> DataFrame:
    """Per table and month: references so far, and how many of their keys have no parent at the
    month's end. Columns source_table, period, n_references, n_open; one row for every month with
    an event from the table's first reference on.

    Works on one row per (key, month) with the month's change of balance and of references.
    A key's contribution changes only in those months, so the change is summed per table and
    month and added up over the months: arrivals resolve, removals reopen, nothing is replayed.
    References without a time belong to no month and are left out.
    """
    events = state.where(F.col("ts").isNotNull()).withColumn("period", F.date_format("ts", "yyyy-MM"))
    steps = events.groupBy(*KEY, "period", "source_table").agg(F.sum("delta").alias("delta"), F.sum("n").alias("n"))
    months = steps.groupBy(*KEY, "period").agg(
        F.sum("delta").alias("delta"),
        F.map_from_entries(F.collect_list(F.when(F.col("source_table").isNotNull(), F.struct("source_table", "n")))).alias("asked"),
    )
    upto = Window.partitionBy(*KEY).orderBy("period").rowsBetween(Window.unboundedPreceding, 0)
    tables = Window.partitionBy(*KEY, "source_table").orderBy("period")
    balance = months.select(*KEY, "period", F.sum("delta").over(upto).alias("balance"), "asked")
    # One row per (key, month, table that the key is referenced from); few tables per key. The
    # table without a name stands for the month itself.
    names = F.array_distinct(F.flatten(F.collect_list(F.map_keys("asked")).over(Window.partitionBy(*KEY))))
    known = balance.withColumn("names", F.array_append(names, F.lit(None).cast("string")))
    rows = known.select(*KEY, "period", "balance", "asked", F.explode("names").alias("source_table"))
    rows = rows.withColumn("n", F.when(F.col("source_table").isNull(), 0).otherwise(F.coalesce(F.col("asked")[F.col("source_table")], F.lit(0))))
    total = F.sum("n").over(tables.rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("open", F.when(F.col("balance") <= 0, total).otherwise(0))
    rows = rows.withColumn("change", F.col("open") - F.lag("open", 1, 0).over(tables))
    monthly = rows.groupBy("source_table", "period").agg(F.sum("n").alias("n"), F.sum("change").alias("change"))
    # A few rows from here on, written since they are read three times: every table has a row for
    # every month of the history.
    monthly = cut(monthly, "monthly")
    periods = monthly.agg(F.collect_set("period")).scalar()
    grid = monthly.select("source_table").where("source_table IS NOT NULL").distinct().withColumn("months", periods)
    grid = grid.select("source_table", F.explode("months").alias("period")).join(monthly, ["source_table", "period"], "left")
    along = Window.partitionBy("source_table").orderBy("period").rowsBetween(Window.unboundedPreceding, 0)
    total = lambda c: F.coalesce(F.sum(c).over(along), F.lit(0)).cast("bigint")
    out = grid.select("source_table", "period", total("n").alias("n_references"), total("change").alias("n_open"))
    return out.where("n_references > 0")
