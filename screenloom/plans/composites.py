"""The steps of a perturbation-screen analysis, one function each, built from the operators."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from screenloom.functions.columns import control_equals, label_seed
from screenloom.operators import de as de_ops
from screenloom.operators import effects as fx
from screenloom.operators import expression as ex
from screenloom.operators import models, ora, sampling, similarity, strata, streams
from screenloom.operators import relational as rel
from screenloom.session import cut
from screenloom.sources.tables import require_columns


@dataclass(frozen=True)
class Defaults:
    """Parameters and their defaults."""

    # The defaults users of such screens expect.
    per_chunk: int = 128
    min_cells: int = 30
    max_controls: int = 10_000
    seed: int = 0
    n_pcs: int = 20
    target_sum: float = 10_000.0
    lfc: float = 0.10
    p: float = 0.05
    top_genes: int = 2000
    ora_lfc: float = 0.25
    ora_alpha: float = 0.05
    ora_min_genes: int = 10
    ora_terms: int = 50
    clusters: int = 20
    ps_quantile: float = 0.90
    ps_min_cells: int = 20
    ps_max_controls: int = 0
    n_variable: int = 0
    neighbours: int = 20
    signature_controls: int = 0
    mixscale_min_genes: int = 5
    mixscale_max_genes: int = 100


def build_manifest(cells: DataFrame, control: str, per_chunk: int = 128, min_cells: int = 30, max_controls: int = 10_000, seed: int = 0) -> DataFrame:
    """(chunk_id, cell_barcode, gene_target, is_control): labels with enough cells, in order,
    ``per_chunk`` to a chunk, and one sample of control cells repeated for every chunk. Cells
    without a barcode are left out; where no label has enough cells there is no chunk."""
    rows = cells.select("cell_barcode", "gene_target").where("gene_target IS NOT NULL AND cell_barcode IS NOT NULL")
    is_control = control_equals("gene_target", control)
    kept = rel.min_count(rows.where(~is_control), "gene_target", min_cells)
    chunks = rel.chunk_labels(kept, "gene_target", per_chunk)
    name = lambda c: F.concat(F.lit("chunk_"), F.lpad(c.cast("string"), 4, "0"))
    perturbed = rows.join(chunks, "gene_target").select(name(F.col("chunk_index")).alias("chunk_id"), "cell_barcode", "gene_target", F.lit(0).alias("is_control"))
    last = chunks.agg(F.max("chunk_index")).scalar()
    sample = sampling.sample_rows(rows.where(is_control), "cell_barcode", max_controls, seed).where(last.isNotNull())
    each = sample.select(F.explode(F.sequence(F.lit(0), F.coalesce(last, F.lit(0)))).alias("i"), "cell_barcode", "gene_target")
    return each.select(name(F.col("i")).alias("chunk_id"), "cell_barcode", "gene_target", F.lit(1).alias("is_control")).unionByName(perturbed)


def manifest_summary(manifest: DataFrame) -> DataFrame:
    """One row per chunk: perturbations, perturbed and control cells, and the first labels."""
    own = F.col("is_control") == 0
    label = F.when(own, F.col("gene_target"))
    return manifest.withColumn("l", label).groupBy("chunk_id").agg(
        F.count_distinct("l").alias("n_perturbations"), F.sum(own.cast("bigint")).alias("n_perturbed_cells"),
        F.sum((~own).cast("bigint")).alias("n_control_cells"), F.count(F.lit(1)).alias("n_total_cells"), rel.label_preview("l").alias("first_perturbations"),
    )


def prepared(counts: DataFrame, target: float | None) -> DataFrame:
    """Normalised log1p values of the stored counts."""
    return ex.log1p(ex.normalize_total(counts, target))


def global_de(
    counts: DataFrame, cells: DataFrame, control: str, min_cells: int = 30, max_controls: int = 0, max_cells: int = 0,
    target: float = 10_000.0, top: int = 2000, method: str = "wilcoxon", seed: int = 0,
) -> DataFrame:
    """Differential expression of every perturbation with enough cells over all assigned cells:
    the first ``top`` genes by score (0: all)."""
    rows = cells.select("cell_barcode", "perturbation").dropna()
    groups = rel.min_count(rows, "perturbation", min_cells).select("perturbation")
    is_control = F.col("perturbation") == control
    kept = rows.join(groups.where(~is_control), "perturbation", "left_semi").unionByName(rows.where(is_control))
    kept = sampling.cap_controls(kept, "perturbation", control, "cell_barcode", max_controls, seed)
    if max_cells > 0:
        kept = kept.where(is_control).unionByName(sampling.cap_groups(kept.where(~is_control), "perturbation", "cell_barcode", max_cells, seed))
    # The cells and their values enter the test several times; both are kept for it.
    kept = cut(kept, "cells")
    values = cut(prepared(counts.join(kept, "cell_barcode", "left_semi"), target), "values")
    found = de_ops.differential_expression(values, kept, control, method)
    return found.where(F.col("rank") <= top) if top > 0 else found


def chosen_genes(values: DataFrame, n: int) -> DataFrame:
    """(gene, gene_idx) of the ``n`` most variable genes, of all where ``n`` is 0."""
    if n <= 0:
        return gene_index(values)
    kinds = values.select("cell_barcode", "n" if "n" in values.columns else F.lit(1).alias("n")).distinct()
    size = kinds.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    return gene_index(ex.highly_variable(ex.gene_stats(values, size), n).where("is_hvg"))


def effect_model(counts: DataFrame, cells: DataFrame, control: str, d: Defaults, most: int = 0, least: int = 0) -> tuple:
    """(cells, components, chosen genes, scores, moments, each) that the three scores share:
    normalised values, principal components of the variable genes, each cell's difference from its
    nearest control cells on the significant genes, and its projection on the effect. With
    neighbours these are of the kinds of cells with equal values; ``each`` says for the cells what
    was found for the rows of ``cells``."""
    if d.neighbours > 0:
        return kinds_model(counts, cells, control, d, most, least)
    rows = cut(cells.select("cell_barcode", "perturbation").dropna(), "cells")
    values = cut(prepared(counts.join(rows, "cell_barcode", "left_semi"), d.target_sum), "values")
    pcs = cut(similarity.principal_components(values, chosen_genes(values, d.n_variable), d.n_pcs), "components")
    found = de_ops.differential_expression(values, rows, control)
    chosen = cut(models.effect_genes(found, d.lfc, d.p, most, least), "chosen")
    scores = cut(models.projections(values, rows, chosen, control), "scores")
    return rows, pcs, chosen, scores, models.control_moments(values, rows, chosen, control), lambda df: df


def kinds_model(counts: DataFrame, cells: DataFrame, control: str, d: Defaults, most: int = 0, least: int = 0) -> tuple:
    """``effect_model`` with neighbours, on one row a kind of cells: only the first step and ``each``
    shuffle all cells, and neither a cell's components nor its difference is ever written."""
    own, kinds, values = models.kinds_of_cells(prepared(counts, d.target_sum), cells.select("cell_barcode", "perturbation").dropna())
    pcs = cut(similarity.principal_components(values, chosen_genes(values, d.n_variable), d.n_pcs), "components")
    found = de_ops.differential_expression(values.drop("n"), kinds, control)
    chosen = cut(models.effect_genes(found, d.lfc, d.p, most, least), "chosen")
    near, rows = models.control_kinds(pcs, own, kinds, control, d.neighbours, d.signature_controls, d.seed)
    rows = cut(rows, "kinds")
    layer = cut(models.perturbed_layer(values, near, rows, chosen.select("gene").distinct()), "layer")
    scores = cut(models.projections(layer, rows, chosen, control), "scores")
    return rows, pcs, chosen, scores, models.control_moments(layer, rows, chosen, control), lambda df: models.of_each_cell(df, own, kinds)


def run_mixscape(counts: DataFrame, cells: DataFrame, control: str, d: Defaults = Defaults()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(classes, effects, scores): each cell's class, each perturbation's effect vector in
    principal components fitted once over all cells, and the projections."""
    rows, pcs, _, scores, moments, each = effect_model(counts, cells, control, d)
    deltas = fx.centroid_deltas(each(pcs.join(rows, "cell_barcode")), control)
    return each(models.classify(scores, moments, control, rows)), deltas, each(scores)


def run_mixscape_by(counts: DataFrame, cells: DataFrame, control: str, replicate: str, d: Defaults = Defaults()) -> DataFrame:
    """The classes of ``run_mixscape`` within each replicate (a column of ``cells`` with few
    values), whose cells are compared with its own controls; with the replicate's column."""
    names = [r[0] for r in cells.select(replicate).where(F.col(replicate).isNotNull()).distinct().orderBy(replicate).collect()]
    own = lambda r: cells.where(F.col(replicate) == F.lit(r))
    parts = [run_mixscape(counts, own(r), control, d)[0].withColumn(replicate, F.lit(r)) for r in names]
    return reduce(DataFrame.unionByName, parts)


def run_mixscale(counts: DataFrame, cells: DataFrame, control: str, d: Defaults = Defaults()) -> tuple[DataFrame, DataFrame]:
    """(scores, genes): each cell's strength (cell_barcode, perturbation, mixscale_score) and the
    genes it rests on (perturbation, gene, rank, p_weight), for perturbations with at least
    ``mixscale_min_genes`` significant genes, the ``mixscale_max_genes`` first of them."""
    _, _, chosen, scores, moments, each = effect_model(counts, cells, control, d, d.mixscale_max_genes, d.mixscale_min_genes)
    genes = rel.top_per_group(chosen, ["perturbation"], [F.abs("weight").desc(), F.col("gene")], 0)
    return each(models.mixscale_scores(scores, moments)), genes.select("perturbation", "gene", "rank", F.col("weight").alias("p_weight"))


def run_ps(counts: DataFrame, cells: DataFrame, control: str, d: Defaults = Defaults()) -> tuple[DataFrame, DataFrame]:
    """(scores, summary): each cell's efficiency (cell_barcode, perturbation, ps_score) and each
    perturbation's mean and deviation of it."""
    *_, scores, _, each = effect_model(counts, cells, control, d)
    ps = cut(each(models.efficiency_scores(scores)), "ps")
    return ps, models.efficiency_summary(ps)


def gene_index(counts: DataFrame) -> DataFrame:
    """(gene, gene_idx) from 0 in name order; genes are few enough to be a matrix's columns."""
    return rel.chunk_labels(counts, "gene", 1).select("gene", F.col("chunk_index").alias("gene_idx"))


def summarize_effects(vectors: DataFrame, cells: DataFrame, flag: Column, control: str) -> DataFrame:
    """Perturbation statistics: cells, perturbed share, the effect's length and Welch's test on the
    first component."""
    per = fx.perturbed_fraction(cells, flag)
    effect = fx.centroid_deltas(vectors, control).select("perturbation", "effect_l2_vs_control")
    return per.join(fx.first_component_test(vectors, control), "perturbation", "left").join(effect, "perturbation", "left")


def merge_selected(selected: DataFrame) -> DataFrame:
    """Per chunk and perturbation the distinct selected cells, the perturbation's total and the
    mean of the totals."""
    per = selected.groupBy("chunk_id", "perturbation").agg(F.count_distinct("cell_barcode").alias("n_selected_perturbed_cells"))
    total = selected.groupBy("perturbation").agg(F.count_distinct("cell_barcode").alias("n_selected_total_for_perturbation"))
    mean = total.agg(F.avg("n_selected_total_for_perturbation")).scalar()
    return per.join(total, "perturbation", "left").withColumn("mean_selected_cells_per_perturbation", mean)


def merge_tables(tables: DataFrame, key: list[str], chunk: str = "source_chunk") -> DataFrame:
    """One row per key of tables united over chunks, that of the first chunk by name; the other
    columns break ties."""
    others = [F.col(c) for c in tables.columns if c not in (*key, chunk)]
    return rel.keep_first(tables, key, [F.col(chunk), *others])


def ps_select(ps: DataFrame, control: str, q: float = 0.90, mode: str = "top_positive", min_cells: int = 20) -> DataFrame:
    """Selected cells: those at or above their perturbation's quantile, of perturbations with
    enough of them, each barcode once (perturbation ascending, score descending)."""
    rows = ps.select("cell_barcode", "perturbation", F.col("ps_score").try_cast("double").alias("ps_score"))
    rows = rows.where(F.col("cell_barcode").isNotNull() & ~control_equals("perturbation", control))
    chosen = rel.select_by_quantile(rows, "perturbation", "ps_score", q, mode)
    enough = chosen.groupBy("perturbation").agg(F.count_distinct("cell_barcode").alias("n")).where(F.col("n") >= min_cells)
    chosen = chosen.join(enough.select("perturbation"), "perturbation", "left_semi")
    return rel.keep_first(chosen, ["cell_barcode"], [F.col("perturbation"), F.col("ps_score").desc()])


def ps_select_and_de(ps: DataFrame, counts: DataFrame, cells: DataFrame, control: str, d: Defaults = Defaults(), top: int = 200) -> DataFrame:
    """Differential expression of the selected cells against all controls, or a sample of
    ``ps_max_controls`` where that is above 0, on values normalised to the median."""
    chosen = ps_select(ps, control, d.ps_quantile, min_cells=d.ps_min_cells).select("cell_barcode", "perturbation")
    controls = sampling.sample_rows(cells.where(control_equals("perturbation", control)), "cell_barcode", d.ps_max_controls, d.seed).select("cell_barcode", "perturbation")
    rows = cut(chosen.unionByName(controls), "cells")
    values = cut(prepared(counts.join(rows, "cell_barcode", "left_semi"), None), "values")
    found = de_ops.differential_expression(values, rows, control)
    return found.where(F.col("rank") <= top) if top > 0 else found


def run_ora(de: DataFrame, sets: DataFrame, universe: DataFrame, d: Defaults = Defaults()) -> tuple[DataFrame, DataFrame]:
    """(terms, summary) of the over-representation of each perturbation's up and down genes."""
    query = ora.regulated_genes(de, d.ora_lfc, d.ora_alpha)
    terms = ora.over_representation(query, sets, universe, d.ora_min_genes)
    return ora.best_terms(terms, d.ora_terms), ora.term_summary(terms, query, d.ora_alpha)


def postprocess(counts: DataFrame, selected: DataFrame, min_selected: int = 20, n_pcs: int = 10, k: int = 15, n_variable: int = 0) -> DataFrame:
    """(perturbation, n_selected_cells, community, axis_1, axis_2) of perturbations with enough
    selected cells: pseudobulk profiles, principal components of the variable genes, neighbours,
    communities. The plane is that of the first two components."""
    rows = selected.select("cell_barcode", "perturbation").dropna()
    rows = rel.keep_first(rows, ["cell_barcode"], [F.col("perturbation")])
    kept = cut(rel.min_count(rows, "perturbation", min_selected, out="n_selected_cells"), "kept")
    if kept.limit(3).count() < 3:
        return kept.select("perturbation", "n_selected_cells", F.lit("0").alias("community"), F.lit(0.0).alias("axis_1"), F.lit(0.0).alias("axis_2"))
    rows = rows.join(kept, "perturbation", "left_semi")
    bulk = ex.pseudobulk(counts, rows).withColumnRenamed("perturbation", "cell_barcode")
    values = cut(prepared(bulk, None), "values")
    pcs = cut(similarity.principal_components(values, chosen_genes(values, n_variable), n_pcs), "components")
    near = similarity.nearest_neighbours(pcs, k, "cell_barcode")
    groups = similarity.communities(near, "cell_barcode")
    out = kept.join(pcs.withColumnRenamed("cell_barcode", "perturbation"), "perturbation")
    out = out.join(groups.withColumnRenamed("cell_barcode", "perturbation"), "perturbation", "left")
    return out.select("perturbation", "n_selected_cells", "community", F.col("x")[0].alias("axis_1"), F.get("x", F.lit(1)).alias("axis_2"))


def postprocess_de(
    counts: DataFrame, selected: DataFrame, cells: DataFrame, control: str, min_selected: int = 20, max_controls: int = 0, top: int = 200, seed: int = 0
) -> tuple[DataFrame, DataFrame]:
    """(full, best): the differential expression of the selected cells of perturbations with enough
    of them against the control cells, on values normalised to the median; all genes, and the
    first ``top`` of each perturbation."""
    rows = selected.select("cell_barcode", "perturbation").dropna()
    rows = rel.keep_first(rows.where(~control_equals("perturbation", control)), ["cell_barcode"], [F.col("perturbation")])
    controls = sampling.sample_rows(cells.where(control_equals("perturbation", control)), "cell_barcode", max_controls, seed).select("cell_barcode")
    kept = rel.label_or_control(controls.unionByName(rows.select("cell_barcode")).distinct(), rows, control)
    enough = rel.min_count(kept.where(~control_equals("perturbation", control)), "perturbation", min_selected).select("perturbation")
    kept = cut(kept.join(enough, "perturbation", "left_semi").unionByName(kept.where(control_equals("perturbation", control)), allowMissingColumns=True), "cells")
    values = cut(prepared(counts.join(kept, "cell_barcode", "left_semi"), None), "values")
    full = cut(de_ops.differential_expression(values, kept, control), "de")
    return full, full.where(F.col("rank") <= top)


def with_chunk_counts(table: DataFrame, summary: DataFrame) -> DataFrame:
    """A table of perturbations with the cells that the chunks selected, added up over chunks, in
    columns ``_from_chunks`` where the names clash."""
    per = summary.groupBy("perturbation").agg(F.sum("n_selected_perturbed_cells").alias("n_selected_cells"))
    return rel.left_with_suffix(table, per, "perturbation")


def target_random(
    combined: DataFrame, targets: DataFrame, control: str, k: int = 20, per_perturbation: int = 0, least: int = 20, match: bool = True, seed: int = 0,
    genes: DataFrame | None = None,
) -> DataFrame:
    """(perturbation, cluster, order_index, group): targets and random perturbations clustered on
    their combined effects, standardised per gene; the control is a row of zeros. ``genes`` are
    ``combined``'s feature genes, where they are known already."""
    chosen = sampling.targets_and_random(combined.select("perturbation").where(F.col("perturbation") != control), targets, "perturbation", None, match, seed)
    chosen = cut(chosen.where("role <> 'missing'"), "chosen")
    if genes is None:
        genes = cut(streams.feature_genes(combined, per_perturbation, least), "genes")
    matrix = cut(streams.effect_matrix(combined, chosen, genes), "matrix")
    rows = chosen.select("perturbation", F.col("role").alias("group")).unionByName(combined.sparkSession.createDataFrame([(control, "control")], "perturbation string, group string"))
    index = gene_index(genes)
    # Standardised values less what an absent entry has: distances are the same, and what is not
    # stored stays away.
    z = ex.standardize_genes(matrix, "perturbation", rows.count()).select("perturbation", "gene", (F.col("value") - F.col("zero")).alias("value"))
    vectors = rows.join(similarity.sparse_rows(z, index, "perturbation"), "perturbation", "left")
    # The genes grow with the rows: a dense matrix would grow as their product.
    vectors = similarity.sparse_vectors(vectors, max(1, index.count()), "perturbation")
    clusters = similarity.cluster_profiles(vectors, k, "perturbation", seed)
    return clusters.join(rows, "perturbation").select("perturbation", "cluster", "order_index", "group")


def target_random_by_method(
    combined: dict[str, DataFrame], targets: DataFrame, control: str, prefix: str = "deg", seed: int = 0, per_perturbation: int = 0, least: int = 20, **options
) -> DataFrame:
    """``target_random`` for each method's own effects, with ``method`` and a seed from its label.
    Methods with the same effects share the feature genes."""
    genes = {id(e): e for e in combined.values()}
    genes = {i: cut(streams.feature_genes(e, per_perturbation, least), "genes") for i, e in genes.items()}
    parts = [
        target_random(effects, targets, control, seed=label_seed(seed, f"{prefix}_{name}"), genes=genes[id(effects)], **options).withColumn("method", F.lit(f"{prefix}_{name}"))
        for name, effects in combined.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def manifest_from_calls(calls: DataFrame, control: str, passed: Column, per_chunk: int = 128, min_cells: int = 30, max_controls: int = 10_000, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """(manifest, meta) from guide calls in two passes: the labels of the calls that pass are
    counted, then the rows of the labels that are kept are chunked. ``meta`` has one row:
    total_rows, n_control_cells_global, n_perturbations_all (the control and the missing label
    count), n_perturbations_kept, n_chunks."""
    rows = calls.where(passed).select("cell_barcode", "gene_target")
    manifest = build_manifest(rows, control, per_chunk, min_cells, max_controls, seed)
    own = control_equals("gene_target", control)
    labels = F.coalesce("gene_target", F.lit("<NA>"))
    meta = rows.agg(F.count(F.lit(1)).alias("total_rows"), F.sum(own.cast("bigint")).alias("n_control_cells_global"), F.count_distinct(labels).alias("n_perturbations_all"))
    kept = rel.min_count(rows.where("cell_barcode IS NOT NULL").where(~own), "gene_target", min_cells).agg(F.count(F.lit(1)).alias("k")).scalar()
    return manifest, meta.withColumn("n_perturbations_kept", kept).withColumn("n_chunks", F.ceil(F.col("n_perturbations_kept") / per_chunk))


def gene_lists(annotation: DataFrame, name: str, text: str, classes: dict[str, str] | None = None) -> DataFrame:
    """(class, name): the genes of each class whose word the annotation's text holds."""
    # The classes and the words that name them.
    words = classes or {"tf": "transcription factor", "transporter": "transporter", "enzyme": "enzyme"}
    require_columns(annotation, [name, text])
    return rel.class_members(annotation, name, text, words)


def guide_diagnostic(labels: DataFrame, guides: DataFrame, control: str, min_cells: int = 100, min_per_group: int = 20) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rates, per perturbation, deciles) of cells with a label (cell_barcode, perturbation, is_ko)
    and with guide counts (cell_barcode, umi): how many of each side match, and knock-out rates by
    guide abundance."""
    both = cut(labels.join(guides, "cell_barcode"), "both")
    per = strata.abundance_strata(both.where(~control_equals("perturbation", control)), min_cells, min_per_group)
    return rel.match_rates(labels, guides, "cell_barcode"), per, strata.abundance_deciles(both)
