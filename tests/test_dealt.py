"""The general data problems on hand-made tables: nulls, ties, repeats, empty tables, clashes."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from screenloom.operators import orphans as op
from screenloom.operators.packed import Dialect, split_packed, tokenize, whole_number
from screenloom.operators.skew import heavy_keys, label_key, skewed_aggregate
from screenloom.session import cut

T = lambda day, hour=0, month=1: dt.datetime(2025, month, day, hour)
REF = "source_table string, dataset string, cell_barcode string, loaded_at timestamp"
OBS = "dataset string, cell_barcode string, loaded_at timestamp, removed_at timestamp"


def test_label_key(spark):
    rows = spark.createDataFrame([(" Ab\t",), (None,), ("",)], "a string").select(label_key("a").alias("k"))
    assert [r.k for r in rows.collect()] == ["ab", None, ""]


def test_heavy_keys(spark):
    rows = spark.createDataFrame([("a",)] * 97 + [("b",)] + [(None,)] * 2, "k string")
    assert {(r.k, r.n_rows) for r in heavy_keys(rows, ["k"], 1.0).collect()} == {("a", 97), ("b", 1)}
    assert heavy_keys(rows.where("k = 'x'"), ["k"], 1.0).count() == 0
    assert heavy_keys(rows, ["k"], 1.01).count() == 1


def test_skewed_aggregate(spark):
    rows = [("a", i % 7, float(i)) for i in range(500)] + [(None, 1, 2.0), ("b", None, None), ("b", None, None)]
    df = spark.createDataFrame(rows, "k string, v int, x double")
    out = skewed_aggregate(df, ["k"], {"n": F.count(F.lit(1)), "s": F.sum("x")}, {"d": F.col("v"), "e": F.col("x")})
    assert {(r.k, r.n, r.s, r.d, r.e) for r in out.collect()} == {("a", 500, 124750.0, 7, 500), (None, 1, 2.0, 1, 1), ("b", 2, None, 0, 0)}
    assert skewed_aggregate(df.limit(0), ["k"], {"n": F.count(F.lit(1))}, {"d": F.col("v")}).count() == 0


def orphans_by_hand(refs, obs):
    out = set()
    for table, ds, bc, t in refs:
        if bc is None:
            continue
        key = bc.strip(" ").upper()
        ok = ds is not None and t is not None and any(
            d == ds and b is not None and b.strip(" ").upper() == key and a is not None and a <= t and (r is None or r > t) for d, b, a, r in obs
        )
        if not ok:
            out.add((table, ds, key, t and t.strftime("%Y-%m")))
    return out


def orphan_case(n, seed):
    r = random.Random(seed)
    names, sets = ["aa", " AA", "bb ", "cc", None], ["x", "y", None]
    when = lambda: T(r.randint(1, 28), r.randint(0, 3), r.randint(1, 4))
    obs = [(r.choice(sets), r.choice(names), r.choice([when(), when(), None]), r.choice([None, when(), when()])) for _ in range(n)]
    refs = [(r.choice("gc"), r.choice(sets), r.choice(names), r.choice([when(), when(), when(), None])) for _ in range(3 * n)]
    return refs + refs[:3], obs + obs[:2]


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("hot", [{}, {"hot_rows": 1, "hot_percent": 0.1}])
def test_orphans_against_hand(spark, seed, hot):
    refs, obs = orphan_case(12, seed)
    got = op.orphan_references(spark.createDataFrame(refs, REF), spark.createDataFrame(obs, OBS), **hot)
    assert {tuple(r) for r in got.collect()} == orphans_by_hand(refs, obs)


def history(spark, refs, obs):
    return op.reference_events(spark.createDataFrame(refs, REF)).unionByName(op.parent_events(spark.createDataFrame(obs, OBS)))


@pytest.mark.parametrize("seed", [9, 10])
@pytest.mark.parametrize("hot", [{}, {"hot_rows": 1, "hot_percent": 1.0}])
def test_orphans_in_batches_of_any_order(spark, seed, hot):
    """Late parents resolve, late removals reopen: any split gives the state of one batch."""
    refs, obs = orphan_case(20, seed)
    events = cut(history(spark, refs, obs).withColumn("b", F.floor(F.rand(seed) * 4)), "batches")
    state = None
    for b in range(4):
        state = cut(op.absorb(events.where(F.col("b") == b).drop("b"), state, **hot), "state")
    assert {tuple(r) for r in op.open_references(state).collect()} == orphans_by_hand(refs, obs)
    once = op.absorb(events.drop("b"))
    assert sorted(map(tuple, op.orphan_snapshots(state).collect())) == sorted(map(tuple, op.orphan_snapshots(once).collect()))


def test_orphans_of_one_hot_key_within_a_day(spark):
    r = random.Random(3)
    refs = [("g", "x", "aa", T(1, r.randint(0, 23)).replace(minute=r.randint(0, 59), second=r.randint(0, 59))) for _ in range(3000)]
    obs = [("x", "AA", T(1, h), T(1, h).replace(minute=40)) for h in range(0, 24, 2)]
    state = op.absorb(history(spark, refs, obs), hot_rows=100)
    want = sum(t.hour % 2 == 1 or t.minute >= 40 for *_, t in refs)
    assert state.where("open").agg(F.sum("n")).first()[0] == want


def test_orphans_empty(spark):
    refs, obs = spark.createDataFrame([], REF), spark.createDataFrame([], OBS)
    assert op.orphan_references(refs, obs).count() == 0
    assert op.orphan_snapshots(op.absorb(history(spark, [], []))).count() == 0
    one = spark.createDataFrame([("g", "x", "aa", T(1))], REF)
    assert [tuple(r) for r in op.orphan_references(one, obs).collect()] == [("g", "x", "AA", "2025-01")]


def test_snapshots_resolve_and_reopen(spark):
    refs = [("g", "x", "aa", T(1)), ("g", "x", "bb", T(2)), ("c", "x", "aa", T(3, month=3))]
    obs = [("x", "AA", T(5, month=2), T(6, month=3)), ("x", "AA", T(1, month=4), None)]
    got = op.orphan_snapshots(op.absorb(history(spark, refs, obs)))
    rows = {(r.source_table, r.period): (r.n_references, r.n_open) for r in got.collect()}
    assert rows[("g", "2025-01")] == (2, 2)
    assert rows[("g", "2025-02")] == (2, 1)
    assert rows[("g", "2025-03")] == (2, 2)
    assert rows[("c", "2025-03")] == (1, 1)
    assert rows[("g", "2025-04")] == (2, 1)


@pytest.mark.parametrize(
    "text, places",
    [
        ("1|2", ["1", "2"]), ('"1,234"/"5"', ["1234", "5"]), (", 5", ["", "5"]), ("5|", ["5", ""]), ("", [""]), ("   ", [""]),
        (" 1  2 ", ["1", "2"]), ("[1 ; 2]", ["1", "2"]), ("N/A|3", ["N/A", "3"]), ("3/N/A/4", ["3", "N/A", "4"]), ("'9|8'", ["9", "8"]),
        ("1||2", ["1", "", "2"]), ('"1" "2"', ["1", "2"]), ("1\\|2", ["1|2"]), ('"a', ["a"]), ("]1[", ["1"]), ("|", ["", ""]), ("1 |2", ["1", "2"]),
    ],
)
def test_tokenize(text, places):
    assert tokenize(text) == places


def test_tokenize_nested():
    d = Dialect(nested_opaque=True, brackets="[](){}", marks=())
    assert tokenize("[1|2]|(3 , 4)|5", d) == ["[1|2]", "(3 , 4)", "5"]


def test_tokenize_plain_texts_match_split():
    r = random.Random(1)
    for _ in range(300):
        parts = ["".join(r.choice("019") for _ in range(r.randint(0, 3))) for _ in range(r.randint(1, 6))]
        assert tokenize("|".join(parts)) == parts


def test_split_packed_clashes_and_edges(spark):
    long = "|".join(["7"] * 50_000)
    rows = [(1, "1|2", "p", 5), (1, "1|2", "p", 5), (2, None, None, None), (3, "", "q", 1), (4, long, "r", 2)]
    df = spark.createDataFrame(rows, "id int, v string, Position string, n_places int")
    out = split_packed(df, "v").cache()
    assert out.columns == ["id", "Position_input", "n_places_input", "position", "value", "n_places"]
    assert out.where("id = 1").count() == 4 and out.where("id = 2").count() == 0
    assert [tuple(r)[3:] for r in out.where("id = 3").collect()] == [(1, "", 1)]
    assert out.where("id = 4").agg(F.max("position")).first()[0] == 50_000
    assert split_packed(df.limit(0), "v").count() == 0
    assert split_packed(df.select(F.col("v").alias("position")), "position").columns == ["position", "value", "n_places"]


def test_whole_number(spark):
    rows = spark.createDataFrame([("485",), ("485.0",), ("4.5",), ("x",), ("",), (None,), ("9" * 30,)], "v string")
    assert [r.n for r in rows.select(whole_number("v").alias("n")).collect()] == [485, 485, None, None, None, None, None]
