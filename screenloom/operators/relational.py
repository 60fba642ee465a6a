"""Filters, keyed picks, quantile rules and ordering rules shared by the composites.

Every pick has a total order, so results do not depend on how rows are partitioned.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from screenloom.functions.columns import as_double, finite, says_perturbed
from screenloom.operators.quantiles import quantiles
from screenloom.session import cut


def min_count(df: DataFrame, key: str, least: int, counted: str | None = None, out: str = "n_cells") -> DataFrame:
    """The keys with at least ``least`` rows (non-null ``counted`` values where given), null keys
    left out."""
    n = F.count(F.col(counted) if counted else F.lit(1))
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(n.alias(out)).where(F.col(out) >= least)


def keep_first(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first in ``order``. The window keeps one row a key in each task
    before it shuffles."""
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r")


def top_per_group(df: DataFrame, key: list[str], order: list[Column], n: int, rank: str = "rank") -> DataFrame:
    """The first ``n`` rows of each key with their rank; all rows where ``n`` is 0 or less."""
    w = Window.partitionBy(*key).orderBy(*order)
    out = df.withColumn(rank, F.row_number().over(w))
    return out.where(F.col(rank) <= n) if n > 0 else out


def select_by_quantile(df: DataFrame, key: str, score: str, q: float, mode: str = "top_positive") -> DataFrame:
    """Rows whose metric reaches their group's ``q`` quantile (ties kept), with
    ``selection_metric`` and ``selection_threshold``. The metric is the score, its negative
    (``top_negative``) or its size (``top_absolute``); null scores and keys are left out."""
    if not 0 <= q <= 1:
        raise ValueError("the quantile must lie in [0, 1]")
    value = {"top_positive": F.col(score), "top_negative": -F.col(score), "top_absolute": F.abs(F.col(score))}[mode]
    rows = df.where(F.col(key).isNotNull()).withColumn("selection_metric", finite(value)).where("selection_metric IS NOT NULL")
    # Read for the thresholds and for the choice.
    rows = cut(rows, "metric")
    limits = quantiles(rows, [key], "selection_metric", [q]).select(key, F.col("q0").alias("selection_threshold"))
    return rows.join(limits, key).where("selection_metric >= selection_threshold")


def z_scores(df: DataFrame, columns: list[str]) -> DataFrame:
    """``<column>_z`` for each column over the whole table (population deviation): 0 where the
    column does not vary, null where the value is null. The moments are one row of partial sums."""
    parts = [f(finite(F.col(c))).alias(f"__{n}_{c}") for c in columns for n, f in (("m", F.avg), ("s", F.stddev_pop))]
    moments = df.agg(F.struct(*parts).alias("m")).scalar()
    out = df.withColumn("__m", moments)
    for c in columns:
        m, s, v = F.col(f"__m.__m_{c}"), F.col(f"__m.__s_{c}"), finite(F.col(c))
        out = out.withColumn(f"{c}_z", F.when(v.isNotNull(), F.when(F.coalesce(s, F.lit(0.0)) > 0, F.try_divide(v - m, s)).otherwise(0.0)))
    return out.drop("__m")


def quantile_bins(df: DataFrame, column: str, bins: int = 10, out: str = "bin") -> DataFrame:
    """The right-closed quantile bin of each value (from 0), equal edges merged; null for null."""
    found = quantiles(df, [], column, [0.0, *[k / bins for k in range(1, bins)], 1.0])
    edges = F.array(*[F.col(f"q{k}") for k in range(1, bins)])
    cuts = found.agg(F.first(F.struct(F.array_sort(F.array_distinct(edges)).alias("e"), F.col("q0").alias("low"), F.col(f"q{bins}").alias("high"))).alias("c")).select("c.*")
    # The edges above the minimum and below the maximum part the bins.
    inner = cuts.select(F.filter("e", lambda e: (e > F.col("low")) & (e < F.col("high"))).alias("e")).scalar()
    above = F.size(F.filter("__e", lambda e: F.col(column) > e))
    return df.withColumn("__e", inner).withColumn(out, F.when(F.col(column).isNotNull(), above)).drop("__e")


def chunk_labels(labels: DataFrame, label: str, size: int) -> DataFrame:
    """``chunk_index`` of distinct labels in order, ``size`` labels to a chunk. The table of
    labels is one row per label; the running number over all of them comes from range partitions
    numbered apart, so that it is not one task's sort."""
    ranged = labels.select(label).distinct().repartitionByRange(label).withColumn("__p", F.spark_partition_id())
    # Kept, so that both uses see the same ranges.
    ranged = cut(ranged, "ranges")
    within = ranged.withColumn("__k", F.row_number().over(Window.partitionBy("__p").orderBy(label)))
    sizes = within.groupBy("__p").agg(F.count(F.lit(1)).alias("__n"))
    before = F.sum("__n").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("__p", F.coalesce(before, F.lit(0)).alias("__o"))
    numbered = within.join(offsets, "__p")
    return numbered.select(label, F.floor((F.col("__k") - 1 + F.col("__o")) / size).cast("int").alias("chunk_index"))


def label_preview(column: str, n: int = 5) -> Column:
    """The first ``n`` labels joined by commas, with dots where there are more."""
    labels = F.array_sort(F.collect_set(column))
    return F.concat(F.array_join(F.slice(labels, 1, n), ","), F.when(F.size(labels) > n, "...").otherwise(""))


def perturbed_mask(df: DataFrame, priority: list[str], control: Column) -> Column:
    """Whether a cell is perturbed, by the first column of ``priority`` in which any cell's class
    says so. The columns are tried in one aggregate over the table."""
    present = [c for c in priority if c in df.columns]
    if not present:
        return F.lit(False)
    seen = df.agg(F.struct(*[F.max(says_perturbed(c)).alias(c) for c in present]).alias("s")).first().s
    chosen = next((c for c in present if seen[c]), None)
    return (says_perturbed(chosen) & ~control) if chosen else F.lit(False)


def recommend(counts: DataFrame, columns: list[str], labels: list[str]) -> DataFrame:
    """Among (column, label, n) the pair with the greatest count, the first listed on a tie; the
    first column and label with count 0 where none has a count. One row: pert_col,
    control_label, control_count, ready."""
    at = lambda c, items: F.coalesce(F.array_position(F.array(*[F.lit(i) for i in items]), c), F.lit(1 << 30))
    best = counts.where((F.col("n") > 0) & F.col("column").isin(columns) & F.col("label").isin(labels))
    order = F.struct((-F.col("n")).alias("n"), at(F.col("column"), columns).alias("c"), at(F.col("label"), labels).alias("l"))
    row = best.agg(F.min_by(F.struct("column", "label", "n"), order).alias("b"))
    return row.select(
        F.coalesce("b.column", F.lit(columns[0])).alias("pert_col"), F.coalesce("b.label", F.lit(labels[0])).alias("control_label"),
        F.coalesce("b.n", F.lit(0)).cast("bigint").alias("control_count"), (F.coalesce("b.n", F.lit(0)) > 0).alias("ready"),
    )


def first_with_data(df: DataFrame, key: list[str], stream: str, priority: list[str], usable: Column) -> DataFrame:
    """For each key the rows of the first stream in ``priority`` that has a usable row."""
    order = F.array_position(F.array(*[F.lit(p) for p in priority]), F.col(stream))
    rows = df.where(F.coalesce(usable, F.lit(False))).withColumn("__o", order).where("__o > 0")
    best = rows.groupBy(*key).agg(F.min("__o").alias("__b"))
    return rows.join(best, key).where("__o = __b").drop("__o", "__b")


def full_outer_chain(frames: list[DataFrame], key: str) -> DataFrame:
    """All keys of all tables; each has one row a key."""
    return reduce(lambda a, b: a.join(b, key, "full"), frames)


def overlap_report(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """One row: n_a, n_b, n_both, percent_of_a over distinct non-null keys."""
    left = a.select(key).where(F.col(key).isNotNull()).distinct().withColumn("a", F.lit(1))
    right = b.select(key).where(F.col(key).isNotNull()).distinct().withColumn("b", F.lit(1))
    both = left.join(right, key, "full")
    out = both.agg(F.count("a").alias("n_a"), F.count("b").alias("n_b"), F.sum(F.when(F.col("a").isNotNull() & F.col("b").isNotNull(), 1).otherwise(0)).cast("bigint").alias("n_both"))
    return out.withColumn("percent_of_a", F.try_divide(F.col("n_both") * 100.0, F.col("n_a")))


def pairwise_correlation(df: DataFrame, columns: list[str], least: int = 3) -> DataFrame:
    """(metric_a, metric_b, pearson_r, n) of all pairs a before b over rows where both are known;
    null below ``least`` rows. One aggregate computes all pairs."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    known = lambda a, b: finite(F.col(a)).isNotNull() & finite(F.col(b)).isNotNull()
    parts = [
        F.struct(
            F.lit(a).alias("metric_a"), F.lit(b).alias("metric_b"),
            F.corr(F.when(known(a, b), F.col(a)), F.when(known(a, b), F.col(b))).alias("r"),
            F.sum(F.when(known(a, b), 1).otherwise(0)).cast("bigint").alias("n"),
        )
        for a, b in pairs
    ]
    out = df.agg(F.array(*parts).alias("p")).select(F.inline("p"))
    return out.select("metric_a", "metric_b", F.when(F.coalesce("n", F.lit(0)) >= least, finite(F.col("r"))).alias("pearson_r"), F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


def aligned_update(df: DataFrame, updates: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """``df`` with the values of ``columns`` that ``updates`` (one row a key) has for its keys; keys
    that it lacks, and nulls in it, keep their values."""
    new = updates.select(key, *[F.col(c).alias(f"__{c}") for c in columns])
    out = df.join(new, key, "left").withColumns({c: F.coalesce(f"__{c}", c) for c in columns})
    return out.select(*df.columns)


def left_with_suffix(a: DataFrame, b: DataFrame, key: str, suffix: str = "_from_chunks") -> DataFrame:
    """All rows of ``a`` with the columns of ``b``; those that ``a`` has too get the suffix."""
    named = b.select(key, *[F.col(c).alias(f"{c}{suffix}" if c in a.columns else c) for c in b.columns if c != key])
    return a.join(named, key, "left")


def match_rates(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """One row: distinct keys of both sides, those in both, and their share in each."""
    out = overlap_report(a, b, key)
    return out.select("n_a", "n_b", "n_both", F.try_divide("n_both", "n_a").alias("rate_a"), F.try_divide("n_both", "n_b").alias("rate_b"))


def matching_columns(columns: list[str], prefix: str = "", parts: tuple[str, ...] = ()) -> list[str]:
    """The columns whose names start with ``prefix`` and hold all ``parts``, in any case; numbered
    ones in the order of their numbers."""
    found = [c for c in columns if c.lower().startswith(prefix.lower()) and all(p.lower() in c.lower() for p in parts)]
    number = lambda c: int("".join(filter(str.isdigit, c[len(prefix) :])) or 0)
    return sorted(found, key=number) if prefix else found


def label_or_control(cells: DataFrame, selected: DataFrame, control: str, key: str = "cell_barcode", label: str = "perturbation") -> DataFrame:
    """(key, label): the label a cell was selected for, the first by name, else the control's."""
    one = selected.where(F.col(label).isNotNull()).groupBy(key).agg(F.min(label).alias("__l"))
    return cells.select(key).join(one, key, "left").select(key, F.coalesce("__l", F.lit(control)).alias(label))


def class_members(df: DataFrame, name: str, text: str, classes: dict[str, str]) -> DataFrame:
    """Distinct (class, name): the names whose text holds a class's word, in any case. A row may
    be of several classes; null names and texts are of none."""
    hits = F.filter(F.array(*[F.when(F.lower(F.col(text)).contains(w.lower()), F.lit(c)) for c, w in classes.items()]), lambda c: c.isNotNull())
    return df.where(F.col(name).isNotNull()).select(F.explode(hits).alias("class"), name).distinct()


def largest_labels(cells: DataFrame, label: str, n: int) -> DataFrame:
    """The ``n`` labels with the most rows (all where ``n`` is 0 or less), ties by name."""
    per = min_count(cells, label, 1, out="n_cells")
    return per.orderBy(F.col("n_cells").desc(), label).limit(n) if n > 0 else per


def ordered_by_first_usable(df: DataFrame, group: str, item: str, columns: list[str], rank: str = "rank") -> DataFrame:
    """(group, item, position): items in the order of the first of ``columns`` with any finite
    value in the whole table: ``rank`` upwards, another column downwards; values that are no
    numbers come last, ties by item. Without a usable column the order is that of the items."""
    seen = df.agg(*[F.count(as_double(c)).alias(c) for c in columns]).first()
    chosen = next((c for c in columns if seen[c]), None)
    v = as_double(chosen) if chosen else F.lit(None).cast("double")
    order = v.asc_nulls_last() if chosen == rank else v.desc_nulls_last()
    w = Window.partitionBy(group).orderBy(order, item)
    return df.where(F.col(group).isNotNull()).select(group, item, F.row_number().over(w).alias("position"))


def stacked(frames: list[DataFrame]) -> DataFrame:
    """The rows of all tables with the columns of any; what a table lacks is null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
