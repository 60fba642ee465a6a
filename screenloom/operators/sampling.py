"""Deterministic samples: rows are ordered by a hash of the seed and their key, so a sample is the
same on any cluster, nests in a larger one, and has a SQL twin."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from screenloom.functions.columns import control_equals


def sample_order(seed: int, key: str) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}|"), F.col(key).cast("string")))


def sample_rows(df: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """``n`` rows in hash order; all where ``n`` is 0 or less. Each task keeps its own first
    ``n`` before they meet."""
    return df.orderBy(sample_order(seed, key), key).limit(n) if n > 0 else df


def cap_groups(df: DataFrame, group: str, key: str, n: int, seed: int = 0) -> DataFrame:
    """At most ``n`` rows of each group in hash order; all where ``n`` is 0 or less. The window
    limits each group in every task before the shuffle, so a heavy group costs ``n`` rows a task."""
    if n <= 0:
        return df
    w = Window.partitionBy(group).orderBy(sample_order(seed, key), key)
    return df.withColumn("__r", F.row_number().over(w)).where(F.col("__r") <= n).drop("__r")


def cap_controls(df: DataFrame, label: str, control: str, key: str, max_controls: int, seed: int = 0) -> DataFrame:
    """All perturbed rows, and the control rows reduced to ``max_controls``."""
    is_control = control_equals(label, control)
    return df.where(~is_control).unionByName(sample_rows(df.where(is_control), key, max_controls, seed))


def targets_and_random(candidates: DataFrame, targets: DataFrame, label: str, n: int | None, match: bool, seed: int = 0) -> DataFrame:
    """(label, role): the targets that are candidates (``target``), those that are not
    (``missing``), and as many other candidates in hash order (``random``): as many as targets
    were asked for where ``match``, else ``n``, else as many as were found."""
    pool, asked = candidates.select(label).distinct(), targets.select(label).distinct()
    present, missing = asked.join(pool, label, "left_semi"), asked.join(pool, label, "left_anti")
    wanted = asked.count() if match else n if n is not None else present.count()
    others = pool.join(asked, label, "left_anti")
    random = others.orderBy(sample_order(seed, label), label).limit(max(0, wanted))
    tag = lambda df, role: df.select(label, F.lit(role).alias("role"))
    return tag(present, "target").unionByName(tag(missing, "missing")).unionByName(tag(random, "random"))


def recap_controls(manifest: DataFrame, n: int, seed: int = 0) -> DataFrame:
    """A manifest whose chunks keep ``n`` of their control rows each, the same in all chunks."""
    is_control = F.col("is_control") == 1
    return manifest.where(~is_control).unionByName(cap_groups(manifest.where(is_control), "chunk_id", "cell_barcode", n, seed))


def one_perturbation(cells: DataFrame, label: str, target: str, control: str, max_controls: int, seed: int = 0) -> DataFrame:
    """(cell_barcode, gene_target, is_control): all cells of one label and a sample of controls."""
    rows = cells.where("cell_barcode IS NOT NULL").select("cell_barcode", F.col(label).alias("gene_target"))
    controls = sample_rows(rows.where(control_equals("gene_target", control)), "cell_barcode", max_controls, seed)
    mark = lambda df, k: df.withColumn("is_control", F.lit(k))
    return mark(rows.where(control_equals("gene_target", target)), 0).unionByName(mark(controls, 1))


def selected_with_counts(candidates: DataFrame, targets: DataFrame, cells: DataFrame, n: int | None = None, match: bool = True, seed: int = 0) -> DataFrame:
    """(perturbation, role, n_cells): ``targets_and_random`` with each one's distinct cells."""
    roles = targets_and_random(candidates, targets, "perturbation", n, match, seed)
    per = cells.where("perturbation IS NOT NULL").groupBy("perturbation").agg(F.count_distinct("cell_barcode").alias("n_cells"))
    return roles.join(per, "perturbation", "left").withColumn("n_cells", F.coalesce("n_cells", F.lit(0)).cast("bigint"))
