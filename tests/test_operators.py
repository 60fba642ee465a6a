"""Hand goldens and properties of the statistics, files, samples and streams."""

import math
import random
import tempfile
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from screenloom.functions import columns, pvalues
from screenloom.functions.columns import label_seed
from screenloom.operators import audit, de, expression, ora, sampling, similarity, streams
from screenloom.operators import relational as rel
from screenloom.operators.orphans import open_references
from screenloom.operators.quantiles import quantiles
from screenloom.plans import composites as co
from screenloom.plans import config
from screenloom.sources import sinks, tables
from screenloom.streaming import counts as stream_counts
from screenloom.streaming import orphans as stream_orphans

CELLS, COUNTS = "cell_barcode string, perturbation string", "cell_barcode string, gene string, value double"


def test_benjamini_hochberg(spark):
    p = [0.01, 0.04, 0.03, 0.04, 0.5, None]
    df = spark.createDataFrame([("g", float(i), v) for i, v in enumerate(p)], "g string, i double, p double")
    got = [r.q for r in de.benjamini_hochberg(df, ["g"], "p", "q").orderBy("i").collect()]
    assert got[:5] == pytest.approx([0.05, 0.05, 0.05, 0.05, 0.5]) and got[5] is None
    same = df.limit(3).withColumn("p", F.lit(0.2))
    assert [r.q for r in de.benjamini_hochberg(same, ["g"], "p", "q").collect()] == pytest.approx([0.2] * 3)
    assert de.benjamini_hochberg(df.limit(0), ["g"], "p").count() == 0


def dense_ranks(x, y):
    z = np.concatenate([x, y])
    ranks = np.array([(z < v).sum() + ((z == v).sum() + 1) / 2 for v in z])
    n1, n0 = len(x), len(y)
    r1, n = ranks[:n1].sum(), n1 + n0
    ties = sum(((z == v).sum() ** 3 - (z == v).sum()) for v in set(z))
    var, tied = n1 * n0 * (n + 1) / 12, n1 * n0 * ties / (12 * n * (n - 1))
    return r1, (r1 - n1 * (n + 1) / 2) / math.sqrt(var), (r1 - n1 * (n + 1) / 2) / math.sqrt(max(var - tied, 1e-300))


def test_rank_sums_against_dense_ranks(spark):
    r = random.Random(2)
    cells = [(f"c{i}", r.choice(["ctl", "p", "q", None])) for i in range(80)]
    dense = {(c, g): float(r.choice([0, 0, 0, 1, 2, 3])) for c, _ in cells for g in ("g1", "g2", "only")}
    for c, p in cells:
        dense[(c, "only")] = 2.0 if p == "ctl" else 0.0
    counts = spark.createDataFrame([(c, g, v) for (c, g), v in dense.items() if v or r.random() < 0.2], COUNTS)
    frame = spark.createDataFrame(cells, CELLS)
    for tie in (False, True):
        got = {(x.perturbation, x.gene): x for x in de.rank_sums(counts, frame, "ctl", tie).collect()}
        assert len(got) == 6
        for p in ("p", "q"):
            for g in ("g1", "g2", "only"):
                x, y = (np.array([dense[(c, g)] for c, k in cells if k == lab]) for lab in (p, "ctl"))
                rank_sum, z, corrected = dense_ranks(x, y)
                assert got[(p, g)].rank_sum == pytest.approx(rank_sum)
                assert got[(p, g)].z == pytest.approx(corrected if tie else z)
                assert got[(p, g)].mean_group == pytest.approx(x.mean()) and got[(p, g)].var_control == pytest.approx(y.var(ddof=1))


def test_no_cells_no_result(spark):
    assert de.differential_expression(spark.createDataFrame([], COUNTS), spark.createDataFrame([], CELLS), "ctl").count() == 0


def test_tails():
    assert pvalues.normal_tail(np.array([1.959964, 0.0])) == pytest.approx([0.05, 1.0], abs=1e-6)
    assert pvalues.student_tail(np.array([2.228139, 12.7062, 0.0]), np.array([10.0, 1.0, 5.0])) == pytest.approx([0.05, 0.05, 1.0], abs=1e-6)
    k = np.array([3, 0, 11])
    assert pvalues.hypergeometric_tail(k, np.full(3, 100), np.full(3, 10), np.full(3, 20)) == pytest.approx([0.3187799362, 1.0, 0.0], abs=1e-9)


def test_ora_thresholds(spark):
    query = spark.createDataFrame([("p", "up", f"g{i}") for i in range(12)] + [("p", "up", "alien")], "perturbation string, direction string, gene string")
    sets = spark.createDataFrame([("t", f"g{i}") for i in range(6)] + [("small", "g1"), ("far", "z1")], "term string, gene string")
    universe = spark.createDataFrame([(f"g{i}",) for i in range(40)], "gene string")
    (row,) = ora.over_representation(query, sets, universe).collect()
    assert (row.term, row.k_overlap, row.query_size, row.term_size, row.universe_size) == ("t", 6, 12, 6, 40)
    assert row.p_value == pytest.approx(math.comb(12, 6) / math.comb(40, 6)) and row.hit_genes == "g0;g1;g2;g3;g4;g5"
    assert ora.over_representation(query.limit(0), sets, universe).count() == 0


def test_effect_modes(spark):
    base = spark.createDataFrame([("p", "g", 1, 2.0), ("p", "h", 4, None)], "perturbation string, gene string, rank int, score double")
    mode = lambda df: {(r.gene, r.effect_value, r.effect_mode) for r in streams.standardize_stream(df, "s").collect()}
    assert mode(base) == {("g", 2.0, "score")}
    assert mode(base.withColumn("logfoldchange", F.lit(None).cast("double"))) == {("g", 2.0, "score")}
    assert mode(base.drop("score").withColumn("p_weight", F.lit(None).cast("double"))) == {("g", 1.0, "rank"), ("h", 0.25, "rank")}
    assert streams.standardize_stream(base.limit(0), "s").count() == 0


def test_z_scores_of_a_constant(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 3.0), (None, None)], "a double, b double")
    got = [tuple(r)[2:] for r in rel.z_scores(df, ["a", "b"]).collect()]
    assert got == [(0.0, -1.0), (0.0, 1.0), (None, None)]


def test_bins_merge_equal_edges(spark):
    df = spark.createDataFrame([(float(v),) for v in [1] * 50 + list(range(2, 52))], "x double")
    got = {r.x: r.bin for r in rel.quantile_bins(df, "x").collect()}
    assert got[1.0] == 0 and max(got.values()) < 9 and sorted(got.values()) == [got[k] for k in sorted(got)]


def test_samples_nest(spark):
    df = spark.range(500).select(F.col("id").cast("string").alias("k"), (F.col("id") % 3).alias("g"))
    few, more = ({r.k for r in sampling.sample_rows(df, "k", n, 7).collect()} for n in (20, 60))
    assert few < more and len(more) == 60
    assert sampling.sample_rows(df, "k", 0).count() == 500
    assert {r["count"] for r in sampling.cap_groups(df, "g", "k", 9, 1).groupBy("g").count().collect()} == {9}


def test_manifest_without_groups(spark):
    cells = spark.createDataFrame([("a", "ctl"), ("b", "x"), (None, "x"), ("c", None)], "cell_barcode string, gene_target string")
    assert co.build_manifest(cells, "ctl", min_cells=2).count() == 0
    assert co.build_manifest(cells, "ctl", min_cells=1).count() == 2
    assert co.build_manifest(cells.limit(0), "ctl").count() == 0


def test_neighbours_over_blocks(spark):
    r = np.random.default_rng(1)
    x = r.normal(0, 1, (60, 4))
    df = spark.createDataFrame([(f"k{i:02d}", v.tolist()) for i, v in enumerate(x)], "k string, x array<double>")
    got = {}
    for row in similarity.nearest_neighbours(df, 3, "k", block=16).collect():
        got.setdefault(row.k, {})[row["rank"]] = row.neighbour
    d = ((x[:, None] - x[None]) ** 2).sum(2)
    np.fill_diagonal(d, np.inf)
    for i in range(60):
        assert [got[f"k{i:02d}"][k] for k in (1, 2, 3)] == [f"k{j:02d}" for j in np.argsort(d[i])[:3]]


def test_files(spark):
    root = "file://" + tempfile.mkdtemp(prefix="spark-")
    cells = spark.createDataFrame([("a", "x"), ("b", " q\"t\t"), ("c", None)], CELLS)
    sinks.write_tsv(cells, f"{root}/c1/cells.tsv.gz", gzip=True)
    sinks.write_tsv(cells, f"{root}/c2/cells.tsv.gz")
    sinks.mark_done(spark, f"{root}/c1")
    sinks.write_metadata(spark, {"n": 3}, f"{root}/meta.json")
    back = tables.read_table(spark, f"{root}/c1/cells.tsv.gz", CELLS)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, cells.collect()))
    assert tables.read_many(spark, [f"{root}/c1/cells.tsv.gz", f"{root}/none"], CELLS).count() == 3
    assert tables.read_many(spark, [], CELLS).count() == 0
    spark.createDataFrame([("# note",), ("B",), ("",), ("A",), ("B",)], "v string").coalesce(1).write.text(f"{root}/targets")
    assert [r.perturbation for r in tables.read_target_list(spark, f"{root}/targets").orderBy("ord").collect()] == ["B", "A"]


def test_config():
    assert config.deep_merge({"a": {"b": 1, "c": 2}}, {"a": {"b": 3}}) == {"a": {"b": 3, "c": 2}}
    assert config.dataset_args(["x=1", "x=2"]) == {"x": "2"}
    assert config.check_config({"methods": {"comparison": True}}) and not config.check_config({})
    assert label_seed(0, "ab") == 97 + 2 * 98


def test_streams_follow_files(spark, sf):
    root = "file://" + tempfile.mkdtemp(prefix="spark-")
    calls = spark.read.parquet(f"{sf}/guide_calls_csv.parquet")
    calls.repartition(3).write.parquet(f"{root}/in")
    stream = spark.readStream.schema(calls.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    stream_counts.label_counts(stream, f"{root}/out").awaitTermination()
    batches = sorted(int(p.name.split("=")[1]) for p in Path(f"{root}/out/counts".removeprefix("file://")).glob("batch=*"))
    assert len(batches) == 2 and batches[-1] >= 2
    assert spark.read.parquet(f"{root}/out/counts/batch={batches[-1]}").agg(F.sum("n")).first()[0] == calls.count()


def test_orphans_follow_batches(spark):
    from tests.test_dealt import history, orphan_case, orphans_by_hand

    refs, obs = orphan_case(20, 5)
    root = "file://" + tempfile.mkdtemp(prefix="spark-")
    # Files in any order: references come before their parents, removals before arrivals.
    history(spark, refs, obs).repartition(4, F.rand(3)).write.parquet(f"{root}/in")
    stream = spark.readStream.schema(spark.read.parquet(f"{root}/in").schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    stream_orphans.follow(stream, f"{root}/out").awaitTermination()
    last = max(int(p.name.split("=")[1]) for p in Path(f"{root}/out/state".removeprefix("file://")).glob("batch=*"))
    state = spark.read.parquet(f"{root}/out/state/batch={last}")
    assert {tuple(r) for r in open_references(state).collect()} == orphans_by_hand(refs, obs)
    assert last and len(list(Path(f"{root}/out/state".removeprefix("file://")).glob("batch=*"))) == 2
    # What was opened, resolved and reopened adds up to what is open.
    sign = F.when(F.col("change") == "resolved", -1).otherwise(1)
    changes = spark.read.parquet(f"{root}/out/changes").groupBy("source_table", "dataset", "cell_barcode", "ts").agg(F.sum(sign).alias("s"))
    assert changes.where("s = 1").count() == state.where("open").select("source_table", "dataset", "cell_barcode", "ts").distinct().count()
    assert changes.where("s NOT IN (0, 1)").count() == 0
    counted = spark.read.parquet(f"{root}/out/open/batch={last}").agg(F.sum("n_open")).first()[0]
    assert counted == state.where("open").agg(F.sum("n")).first()[0]


def test_bytes_that_are_no_text(spark):
    df = spark.createDataFrame([(1, b"NTC"), (2, b"\xff\xfeA"), (3, None), (4, b"")], "i int, b binary")
    got = {r.i: r.t for r in df.select("i", columns.lenient_decode("b").alias("t")).collect()}
    assert got[1] == "NTC" and got[2].endswith("A") and "�" in got[2] and got[3] is None and got[4] == ""


def test_readiness_gate(spark):
    df = spark.range(1)
    audit.require_ready(audit.readiness([("rows", True, "3")], df))
    with pytest.raises(ValueError, match="control"):
        audit.require_ready(audit.readiness([("rows", True, "3"), ("control", False, "0")], df))


def test_enabled_datasets():
    assert config.enabled_datasets({"datasets": {"a": {}, "b": {"enabled": False}, "c": {"enabled": True}}}) == ["a", "c"]
    assert config.enabled_datasets({}) == []


def test_neighbours_of_copies_and_near_copies(spark):
    """Many rows that repeat, exactly and nearly, over several cells and chunks."""
    r = np.random.default_rng(7)
    base = r.normal(0, 3, (40, 6))
    x = np.concatenate([base[r.integers(0, 40, 150)], base[r.integers(0, 40, 60)] + r.normal(0, 1e-7, (60, 6)), np.tile(base[0], (40, 1))])
    names = [f"k{i:03d}" for i in r.permutation(len(x))]
    df = spark.createDataFrame(list(zip(names, x.tolist())), "k string, x array<double>")
    got = {}
    for row in similarity.nearest_neighbours(df, 4, "k", block=24).collect():
        got.setdefault(row.k, {})[row["rank"]] = row.neighbour
    for i, n in enumerate(names):
        d = np.round(np.sqrt(((x - x[i]) ** 2).sum(1)), 9)
        want = sorted((d[j], names[j]) for j in range(len(x)) if j != i)[:4]
        assert [got[n][k] for k in (1, 2, 3, 4)] == [m for _, m in want]
    few = df.limit(1)
    assert similarity.nearest_neighbours(few, 3, "k").count() == 0
    assert similarity.nearest_neighbours(df.limit(0), 3, "k").count() == 0
    assert similarity.nearest_neighbours(df, 300, "k", block=50).count() == len(x) * (len(x) - 1)


def test_components_against_a_decomposition(spark):
    r = np.random.default_rng(3)
    x = np.where(r.random((80, 30)) < 0.4, r.gamma(2, 1, (80, 30)), 0) + np.outer(r.normal(0, 3, 80) ** 2, np.arange(30) % 5 == 0)
    rows = [(f"c{i}", f"g{j:02d}", float(x[i, j])) for i in range(80) for j in range(30) if x[i, j]]
    values = spark.createDataFrame(rows, COUNTS)
    genes = spark.createDataFrame([(f"g{j:02d}", j) for j in range(30)], "gene string, gene_idx int")
    got = {r.cell_barcode: r.x for r in similarity.principal_components(values, genes, 4).collect()}
    c = x - x.mean(0)
    axes = np.linalg.svd(c, full_matrices=False)[2][:4].T
    axes *= np.sign(axes[np.abs(axes).argmax(0), np.arange(4)])
    assert np.array([got[f"c{i}"] for i in range(80)]) == pytest.approx(c @ axes, abs=1e-6)
    assert similarity.principal_components(values.limit(0), genes, 4).count() == 0
    dense = {r.cell_barcode: r.features for r in similarity.cell_vectors(values, genes).collect()}
    assert np.array([dense[f"c{i}"] for i in range(80)]) == pytest.approx(x)


def test_similarity_of_sparse_profiles(spark):
    """An absent entry of a standardised gene is its zero, not 0."""
    x = np.array([[3.0, 0, 1], [0, 2.0, 1], [1.0, 0, 0], [0, 0, 4.0]])
    rows = [(f"p{i}", f"g{j}", float(x[i, j])) for i in range(4) for j in range(3) if x[i, j]]
    z = expression.standardize_genes(spark.createDataFrame(rows, "perturbation string, gene string, value double"), "perturbation", 4)
    z = z.select("perturbation", "gene", (F.col("value") - F.col("zero")).alias("value"))
    want = (x - x.mean(0)) / x.std(0)
    for r in similarity.profile_distances(z, "perturbation", z, block=2).collect():
        a, b = int(r.group_a[1]), int(r.group_b[1])
        assert r.distance == pytest.approx(np.linalg.norm(want[a] - want[b]))


def test_inputs_that_are_missing(spark):
    root = "file://" + tempfile.mkdtemp(prefix="spark-")
    cells = spark.createDataFrame([("a", "x"), ("b", "y")], CELLS)
    with pytest.raises(ValueError, match="cell_barcode"):
        tables.load_cells(cells, spark.createDataFrame([("z",)], "cell_barcode string"))
    assert tables.load_cells(cells, max_cells=1).count() == 1 and tables.load_cells(cells).count() == 2
    with pytest.raises(ValueError, match="lfc"):
        tables.require_columns(cells, ["perturbation", "lfc"])
    with pytest.raises(ValueError, match="cells.tsv"):
        tables.chunk_ids(spark, root, "cells.tsv")
    with pytest.raises(ValueError, match="pval"):
        columns.p_column(["gene"])
    assert columns.p_column(["pval", "pval_adj"]) == "pval_adj" and columns.p_column(["pval"]) == "pval"
    assert streams.read_stream(spark, f"{root}/none.tsv", "s").count() == 0


def test_tables_of_unequal_headers(spark):
    root = "file://" + tempfile.mkdtemp(prefix="spark-")
    for k, c in enumerate((["cell_barcode", "perturbation"], ["perturbation", "cell_barcode"], ["cell_barcode", "perturbation"])):
        sinks.write_tsv(spark.createDataFrame([(f"c{k}", f"p{k}")], CELLS).select(*c), f"{root}/{k}", gzip=k == 1)
    back = tables.read_many(spark, [f"{root}/{k}" for k in range(4)], CELLS)
    assert {tuple(r) for r in back.collect()} == {(f"c{k}", f"p{k}") for k in range(3)}


def test_sources_and_gate(spark):
    assert config.one_source({"h5ad": "x"}) == "h5ad"
    for both in ({"h5ad": "x", "guide_calls_csv": "y"}, {"h5ad": ""}):
        with pytest.raises(ValueError):
            config.one_source(both)
    assert config.check_config({"methods": {"target_random": True}, "targets": "t"}) and config.check_config({"streams": ["global_de"]})
    v = lambda *x: spark.createDataFrame([(float(a),) for a in x], "value double")
    report = audit.readiness([("rows", True, "3")], spark.range(1))
    audit.require_counts(report, audit.count_source({"X": v(0.5), "Counts": v(1, 2)}))
    assert audit.count_source({"X": v(3, 4), "Counts": v(0.5)}).first().source == "Counts"
    with pytest.raises(ValueError, match="raw counts"):
        audit.require_counts(report, audit.count_source({"X": v(0.5, 1.5)}))


def test_session_needs_a_shared_folder(monkeypatch):
    from screenloom import session

    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(Session())


def test_replicates_meet_their_own_controls(spark):
    r = np.random.default_rng(5)
    cells = [(f"c{i}", ("ctl", "p")[i % 2], f"r{i % 4 // 2}") for i in range(160)]
    values = [(c, f"g{j}", float(r.poisson(3 + 6 * (p == "p") * (j < 3)) + 1)) for c, p, _ in cells for j in range(8)]
    frame = spark.createDataFrame(cells, CELLS + ", replicate string")
    got = co.run_mixscape_by(spark.createDataFrame(values, COUNTS), frame, "ctl", "replicate", co.Defaults(n_pcs=3, neighbours=5, n_variable=6))
    rows = got.groupBy("replicate", "perturbation").agg(F.count(F.lit(1)).alias("n"), F.avg("is_predicted_perturbed").alias("ko")).collect()
    assert {(x.replicate, x.perturbation, x.n) for x in rows} == {(a, b, 40) for a in ("r0", "r1") for b in ("ctl", "p")}
    assert all((x.ko > 0.8) == (x.perturbation == "p") for x in rows)


def test_quantiles(spark):
    r = random.Random(6)
    rows = [(g, r.choice([r.gauss(0, 100), float(r.randint(-2, 2)), None, float("nan"), 0.0, -0.0])) for g in "ab" for _ in range(300)]
    rows += [(None, 5.0), (None, 7.0), ("one", 3.5), ("none", None), ("wide", 1e-300), ("wide", -1e300), ("wide", 1e300)]
    df = spark.createDataFrame(rows, "g string, x double")
    qs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = {x.g: x for x in quantiles(df, ["g"], "x", qs).collect()}
    assert set(got) == {"a", "b", None, "one", "wide"}
    for g, row in got.items():
        v = np.array([x for k, x in rows if k == g and x is not None and not math.isnan(x)])
        assert row.n == len(v)
        assert [row[f"q{i}"] for i in range(len(qs))] == pytest.approx(np.quantile(v, qs).tolist(), rel=1e-12)
    (whole,) = quantiles(df.where("g = 'a'"), [], "x", [0.5]).collect()
    assert whole.q0 == got["a"].q3
    assert quantiles(df.limit(0), [], "x", [0.5]).count() == 0


def test_released_tables_are_gone(spark):
    from screenloom.session import cut, release

    kept, gone = cut(spark.range(5), "kept"), cut(spark.range(7), "gone")
    path = Path(gone.inputFiles()[0].removeprefix("file://")).parent
    assert path.exists()
    release(gone)
    release(spark.range(3))
    assert not path.exists() and kept.count() == 5
