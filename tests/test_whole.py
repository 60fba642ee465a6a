"""Whole jobs: no day, size, pattern, control or gene is left out."""

import math
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from screenloom import session
from screenloom.functions import pvalues
from screenloom.operators import expression, models, similarity, streams
from screenloom.plans import catalog
from screenloom.plans import composites as co


def exact_tail(k, u, m, n):
    return sum(math.comb(m, j) * math.comb(u - m, n - j) for j in range(k, min(m, n) + 1)) / math.comb(u, n)


def test_fisher_of_all_days_and_sizes(spark):
    day = "dataset string, run_date string, umi_decile int, n_cells int, n_ko int"
    rows = [("small", "2025-03-01", 7, 30, 12), ("small", "2025-06-01", 2, 40, 9), ("large", "2025-04-01", 9, 150_000, 50_300), ("large", "2025-04-02", 1, 150_000, 50_000), ("low", "2025-04-02", 1, 5, 2)]
    got = {r.dataset: r.p_value for r in catalog.fisher_of_deciles(spark.createDataFrame(rows, day)).collect()}
    assert got["small"] == pytest.approx(exact_tail(12, 70, 21, 30)) and got["low"] == 1.0
    # By the normal curve, with a correction for continuity.
    z = (50_300 - 50_150 - 0.5) / math.sqrt(300_000 / 4 * (100_300 / 300_000) * (1 - 100_300 / 300_000))
    assert got["large"] == pytest.approx(math.erfc(z / math.sqrt(2)) / 2, rel=1e-3)


def test_hypergeometric_tails_of_any_size():
    r = np.random.default_rng(3)
    u = r.integers(2, 120, 300)
    m, n = r.integers(0, u + 1), r.integers(0, u + 1)
    k = r.integers(0, np.minimum(m, n) + 2)
    want = [exact_tail(int(a), int(b), int(c), int(d)) for a, b, c, d in zip(k, u, m, n)]
    assert pvalues.hypergeometric_tail(k, u, m, n) == pytest.approx(want, rel=1e-9, abs=1e-12)
    one = np.array([10**9])
    assert pvalues.hypergeometric_tail(one // 4, one, one // 2, one // 2) == pytest.approx([0.5], abs=1e-3)


def test_registered_whole_tables(spark, sf):
    calls = spark.read.parquet(f"{sf}/guide_calls_csv.parquet").count()
    assert catalog.f02_lenient_cast_all(spark, sf).count() == calls == catalog.f02_lenient_cast(spark, sf).count()
    assert catalog.s07_union_of_chunks(spark, sf).select("perturbation").distinct().count() > 2
    assert catalog.s07_all_chunks(spark, sf).select("perturbation").distinct().count() > 2


def test_signature_of_all_controls(spark):
    r = np.random.default_rng(4)
    x = r.normal(0, 1, (90, 3))
    rows = [(f"c{i:02d}", "ctl" if i < 60 else "p", v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "cell_barcode string, perturbation string, x array<double>")
    got = {s.cell_barcode: s.signature for s in models.signature(df, "ctl", 5).collect()}
    assert len(got) == 90
    for i in range(90):
        d = ((x[i] - x[:60]) ** 2).sum(1)
        if i < 60:
            d[i] = np.inf
        assert got[f"c{i:02d}"] == pytest.approx((x[i] - x[np.argsort(d)[:5]].mean(0)).tolist())
    # Fewer controls than asked for: a control is not its own neighbour.
    few = {s.cell_barcode: s.signature for s in models.signature(df.where("cell_barcode < 'c02' OR perturbation = 'p'"), "ctl", 5).collect()}
    assert few["c00"] == pytest.approx((x[0] - x[1]).tolist())


def test_selected_cells_meet_all_controls(spark):
    """More controls than the former fixed sample."""
    cells = spark.range(50_300).selectExpr("concat('c', id) AS cell_barcode", "if(id < 50200, 'ctl', 'p') AS perturbation")
    ps = cells.where("perturbation = 'p'").selectExpr("cell_barcode", "perturbation", "double(substring(cell_barcode, 2)) AS ps_score")
    counts = cells.selectExpr("cell_barcode", "concat('g', length(cell_barcode) % 2) AS gene", "double(1 + hash(cell_barcode) % 2) AS value").unionByName(cells.selectExpr("cell_barcode", "'h' AS gene", "1d AS value"))
    found = co.ps_select_and_de(ps, counts.where("value > 0"), cells, "ctl", co.Defaults(ps_quantile=0.5))
    share = counts.where("value > 0 AND gene = 'g1'").join(cells.where("perturbation = 'ctl'"), "cell_barcode").count() / 50_200
    assert found.where("gene = 'g1'").first().pct_nz_reference == pytest.approx(share, rel=1e-12)


def test_all_significant_genes(spark):
    rows = [("p", f"g{i:03d}", 1.0, 0.5, 0.01) for i in range(150)] + [("p", "weak", 1.0, 0.05, 0.01), ("p", "noise", 1.0, 0.5, 0.2), ("q", "g000", 1.0, 0.5, 0.01)]
    de = spark.createDataFrame(rows, "perturbation string, gene string, score double, logfoldchange double, pval_adj double")
    each = lambda df: {r.perturbation: r["count"] for r in df.groupBy("perturbation").count().collect()}
    assert each(models.effect_genes(de)) == {"p": 150, "q": 1}
    assert each(models.effect_genes(de, most=100, least=5)) == {"p": 100}


def test_mixture_does_not_follow_the_number_of_cells(monkeypatch):
    at = (np.arange(-40, 60) + 0.5) / 10
    h = np.round(900 * np.exp(-0.5 * at**2) + 200 * np.exp(-0.5 * ((at - 3) / 0.7) ** 2))
    # The start alone, without a step of the fit.
    monkeypatch.setattr(models, "range", lambda n: [], raising=False)
    few, many = models._mixture(h, at, 0.0, 1.0), models._mixture(100 * h, at, 0.0, 1.0)
    assert few == pytest.approx(many) and few[0] == pytest.approx(np.quantile(np.repeat(at, h.astype(int)), 0.75), abs=0.1)


def test_greedy_genes_skip_and_go_on(spark):
    n = [900, 5, 0, 400, 300, 200, 5]
    ranked = spark.createDataFrame([(f"g{i}", i + 1, v) for i, v in enumerate(n)], "gene string, position long, n_nonzero long")
    pick = lambda budget, most: {r.gene for r in expression.greedy_genes(ranked, budget, most).collect()}
    assert expression.budgeted_genes(ranked, 600).count() == 0
    # All are under the last cap: the first is over the budget and the rest go on.
    assert pick(600, 7) == {"g1", "g3", "g6"} and pick(600, 2) == {"g1", "g3"}
    many = [(f"big{i}", i + 1, 1500) for i in range(3)] + [(f"s{i:03d}", i + 4, 10) for i in range(100)]
    ranked = spark.createDataFrame(many, "gene string, position long, n_nonzero long")
    # The cap 3000 // 103 holds the large ones back for the second pass.
    assert pick(3000, 103) == {f"s{i:03d}" for i in range(100)} | {"big0"}


def test_axes_and_effects_are_registered(spark, sf):
    assert {"axis_1", "axis_2"} <= set(catalog.c06_postprocess(spark, sf).columns)
    assert "effect_l2_vs_control" in catalog.c03_effects(spark, sf).columns


def test_targets_and_random_are_clustered_as_stored(spark, monkeypatch):
    """What is not stored never becomes a number; distances are those of the dense rows."""
    r = np.random.default_rng(5)
    effects = [(f"p{i:02d}", f"g{i % 4}{g}", float(r.normal(1, 0.1))) for i in range(40) for g in range(5)]
    combined = spark.createDataFrame(effects, "perturbation string, gene string, effect_for_cluster double")
    targets = spark.createDataFrame([(f"p{i:02d}",) for i in range(20)], "perturbation string")
    fitted, fit = [], similarity.BisectingKMeans.fit
    monkeypatch.setattr(similarity.BisectingKMeans, "fit", lambda self, df: (fitted.append(df), fit(self, df))[1])
    found = {x.perturbation: x.cluster for x in co.target_random(combined, targets, "ctl", k=4).collect()}
    vectors = {x.perturbation: x.v for x in fitted[0].collect()}
    assert len(found) == len(vectors) == 41
    assert sum(len(v.values) for v in vectors.values()) == len(effects) and len(vectors["ctl"].values) == 0
    dense = np.zeros((41, 20))
    for p, g, e in effects:
        dense[int(p[1:]), int(g[1]) * 5 + int(g[2])] = e
    want = (dense - dense.mean(0)) / dense.std(0)
    got = np.array([vectors[p].toArray() for p in [*(f"p{i:02d}" for i in range(40)), "ctl"]])
    assert got - got[-1] == pytest.approx(want - want[-1])


def test_each_method_is_clustered_as_stored(spark, monkeypatch):
    effects = [(f"p{i}", f"g{(i + j) % 30}", 1.0 + j) for i in range(30) for j in range(2)]
    combined = spark.createDataFrame(effects, "perturbation string, gene string, effect_for_cluster double")
    fitted, fit = [], similarity.BisectingKMeans.fit
    monkeypatch.setattr(similarity.BisectingKMeans, "fit", lambda self, df: (fitted.append(df), fit(self, df))[1])
    found = co.target_random_by_method({"a": combined, "b": combined}, combined.where("gene < 'g2'").select("perturbation"), "ctl", k=3)
    assert len(fitted) == 2
    for df, rows in zip(fitted, (found.where(f"method = 'deg_{m}'").count() for m in "ab")):
        vectors = [x.v for x in df.collect()]
        assert len(vectors) == rows and sum(len(v.values) for v in vectors) == 2 * (rows - 1)


def test_cells_with_equal_vectors_ask_once(spark, monkeypatch):
    """More copies than neighbours, of cells and of controls; each cell's neighbours as of all pairs."""
    r = np.random.default_rng(6)
    base = r.normal(0, 1, (12, 3))
    at = np.r_[r.integers(0, 12, 100), r.integers(3, 12, 100), [0] * 12]
    names = [f"c{i:03d}" for i in r.permutation(212)]
    rows = [(n, "ctl" if i < 100 else "p", base[v].tolist()) for i, (n, v) in enumerate(zip(names, at))]
    df = spark.createDataFrame(rows, "cell_barcode string, perturbation string, x array<double>")
    asked, search = [], similarity.nearest_neighbours
    for module in (models, similarity):
        monkeypatch.setattr(module, "nearest_neighbours", lambda v, *a, among, **o: (asked.append((v.count(), among.count())), search(v, *a, among=among, **o))[1])
    found = models.control_neighbours(df, "ctl", 4)
    assert asked == [(12, 12)]
    near, alike = found
    got = {}
    for x in alike.join(near, "asker").collect():
        got.setdefault(x.cell_barcode, set()).add(x.neighbour)
    for i, n in enumerate(names):
        d = np.round(np.sqrt(((base[at[:100]] - base[at[i]]) ** 2).sum(1)), 9)
        assert got[n] == {m for _, m in sorted((d[j], names[j]) for j in range(100) if j != i)[:4]}
    assert alike.count() == len(got) == 212 and alike.select("asker").distinct().count() < 100
    # Fewer controls than asked for.
    few = df.where("perturbation = 'p'").unionByName(df.where("perturbation = 'ctl'").limit(2))
    near, alike = models.control_neighbours(few, "ctl", 4)
    each = {x.cell_barcode: x.n for x in alike.join(near, "asker").groupBy("cell_barcode").agg(F.count("*").alias("n")).collect()}
    assert sorted(each.values()) == [1, 1] + [2] * 112


def test_known_streams_are_shuffled_once(spark):
    """A distinct count beside sums is two shuffles of all rows; of known names it is one."""
    rows = [("p", "g", 1.0, 0.01, None, "a", "logfoldchange"), ("p", "g", -3.0, 0.5, None, "b", "logfoldchange"), ("p", "g", 2.0, None, None, "a", "logfoldchange"),
            ("p", "h", 0.1, 0.01, None, "b", "logfoldchange"), ("q", "g", 4.0, 0.01, None, None, "logfoldchange")]
    both = spark.createDataFrame(rows, "perturbation string, gene string, effect_value double, pval_adj double, rank int, stream string, effect_mode string")
    known, counted = streams.combine_streams([both], 2, names=["a", "b"]), streams.combine_streams([both], 2)
    assert known._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert sorted(known.collect()) == sorted(counted.collect()) == [("p", "g", 1.5, 3.0, 2), ("p", "h", 0.0, 0.1, 1), ("q", "g", 2.0, 4.0, 0)]
    assert known.dtypes == counted.dtypes
    with pytest.raises(Exception, match="not among the names: b"):
        streams.combine_streams([both], 2, names=["a"]).collect()


def test_the_twins_streams_are_shuffled_once(spark, sf):
    plan = catalog._combined(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_methods_with_the_same_effects_share_their_genes(spark, monkeypatch):
    effects = [(f"p{i}", f"g{(i + j) % 30}", 1.0 + j) for i in range(30) for j in range(2)]
    combined = spark.createDataFrame(effects, "perturbation string, gene string, effect_for_cluster double")
    other = combined.where("gene <> 'g0'")
    asked, genes = [], streams.feature_genes
    monkeypatch.setattr(streams, "feature_genes", lambda df, *limits: (asked.append((df, *limits)), genes(df, *limits))[1])
    found = co.target_random_by_method({"a": combined, "b": combined, "c": other}, combined.where("gene < 'g2'").select("perturbation"), "ctl", k=3, per_perturbation=1)
    assert [(df is combined, *limits) for df, *limits in asked] == [(True, 1, 20), (False, 1, 20)]
    assert {x.method for x in found.select("method").distinct().collect()} == {"deg_a", "deg_b", "deg_c"}


def test_cells_with_equal_values_are_one_row_of_the_model(spark, monkeypatch):
    """More copies than neighbours; each cell's score and class as from all pairs of cells."""
    r = np.random.default_rng(8)
    base = r.poisson(3, (14, 6)).astype(float)
    base[5:, :2] += 6
    at = np.r_[r.integers(0, 8, 120), r.integers(4, 14, 80)]
    names, label = [f"c{i:03d}" for i in r.permutation(200)], np.array(["ctl"] * 120 + ["p"] * 80)
    counts = spark.createDataFrame([(n, f"g{j}", float(base[v, j])) for n, v in zip(names, at) for j in range(6) if base[v, j] > 0], "cell_barcode string, gene string, value double")
    cells = spark.createDataFrame([*zip(names, label.tolist()), ("bare", "p")], "cell_barcode string, perturbation string")
    model, written = co.Defaults(n_pcs=3, neighbours=4), {}
    make = co.cut
    monkeypatch.setattr(co, "cut", lambda df, name, *a, **o: written.setdefault(name, make(df, name, *a, **o)))
    classes, deltas, scores = co.run_mixscape(counts, cells, "ctl", model)
    kinds = len(set(zip(at.tolist(), label.tolist())))
    assert written["components"].count() == kinds and written["chosen"].count() > 0
    assert kinds < written["scores"].count() + written["kinds"].where("perturbation = 'ctl'").count() < 40

    values = co.prepared(counts, model.target_sum)
    pcs = {x.cell_barcode: np.array(x.x) for x in similarity.principal_components(values, co.gene_index(values), 3).collect()}
    x, layer = np.log1p(base * 1e4 / base.sum(1, keepdims=True))[at], []
    for i, n in enumerate(names):
        near = sorted((round(float(np.sqrt(((pcs[names[j]] - pcs[n]) ** 2).sum())), 9), names[j], j) for j in range(120) if j != i)[:4]
        layer.append(x[i] - x[[j for *_, j in near]].mean(0))
    layer = np.array(layer)
    weight = np.zeros(6)
    for g in written["chosen"].collect():
        weight[int(g.gene[1])] = g.weight
    c = layer[:120].mean(0)
    want = {n: (v - c) @ weight / (weight @ weight) for n, v in zip(names[120:], layer[120:])} | {"bare": -c @ weight / (weight @ weight)}
    got = {s.cell_barcode: s.projection for s in scores.collect()}
    assert got.keys() == want.keys() and all(abs(got[n] - want[n]) < 1e-9 for n in want)
    found = {k.cell_barcode: k for k in classes.collect()}
    assert len(found) == classes.count() == 201 and all(found[n].mixscape_class_global == "NT" for n in names[:120])
    sure = models.classify(scores, models.control_moments(*_long(spark, layer[:120], names, weight)), "ctl", cells)
    assert {k.cell_barcode: round(k.p_ko, 6) for k in sure.collect()} == {n: round(k.p_ko, 6) for n, k in found.items()}
    assert {d.perturbation: d.n_cells for d in deltas.collect()} == {"ctl": 120, "p": 80}


def _long(spark, layer, names, weight):
    values = spark.createDataFrame([(n, f"g{j}", float(v)) for n, row in zip(names, layer) for j, v in enumerate(row)], "cell_barcode string, gene string, value double")
    cells = spark.createDataFrame([(n, "ctl") for n in names[: len(layer)]], "cell_barcode string, perturbation string")
    genes = spark.createDataFrame([("p", f"g{j}", float(w)) for j, w in enumerate(weight) if w], "perturbation string, gene string, weight double")
    return values, cells, genes, "ctl"


def test_a_write_leaves_no_shuffle(spark):
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffles = lambda: {f for f in blocks.getAllFiles().mkString(",").split(",") if "shuffle_" in f and f.endswith(".data")}
    before, setting = shuffles(), spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    kept = session.cut(spark.range(1000).repartition(3, "id").groupBy((F.col("id") % 7).alias("k")).count(), "kept")
    for _ in range(50):
        if not shuffles() - before:
            break
        time.sleep(0.2)
    assert not shuffles() - before and kept.count() == 7
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == setting
