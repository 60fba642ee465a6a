"""The training-data operators against brute force on small tables, with edge cases."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from screenloom.llm import clusters, filters, leaks, packing, percentiles, subjects, topn

NAN, INF = float("nan"), float("inf")


# Percentiles


def by_hand(values, percents):
    v = sorted(x for x in values if x is not None and not math.isnan(x))
    return {q: v[max(1, -(-len(v) * q // 100)) - 1] for q in percents} if v else {}


@pytest.fixture(scope="module")
def numbers(spark):
    r = random.Random(3)
    rows = [("a", r.choice([r.gauss(0, 1e3), float(r.randint(-5, 5)), None, NAN])) for _ in range(900)]
    rows += [("b", x) for x in (0.0, -0.0, 5e-324, -5e-324, 1e308, -1e308, INF, -INF, 2.0**-1022, 1.0, 1.0, 1.0 - 2**-53)]
    rows += [(None, 4.0), (None, 4.0), ("c", None)]
    return rows, spark.createDataFrame(rows, "g string, x double")


PERCENTS = [0, 1, 5, 25, 50, 75, 95, 99, 100]


@pytest.mark.parametrize("most", [200_000, 0])
@pytest.mark.parametrize("digits", [(16, 16, 16, 16), (8, 24, 32)])
def test_radix_percentiles(numbers, monkeypatch, most, digits):
    monkeypatch.setattr(percentiles, "MOST_TARGETS", most)
    rows, df = numbers
    got = percentiles.radix_percentiles(df, ["g"], "x", PERCENTS, digits).collect()
    for g in ("a", "b", None):
        mine = [x for k, x in rows if k == g]
        assert {r.percentile: r.value for r in got if r.g == g} == by_hand(mine, PERCENTS)
    assert not [r for r in got if r.g == "c"]
    assert percentiles.radix_percentiles(df.limit(0), ["g"], "x", PERCENTS).count() == 0


def test_histograms_combine_within_their_bounds(numbers):
    rows, df = numbers
    parts = df.withColumn("day", F.pmod(F.xxhash64("x"), F.lit(4)))
    whole = percentiles.merge_histograms(percentiles.digit_histogram(parts, ["g", "day"], "x"), ["g"])
    for r in percentiles.percentiles_of_histogram(whole, ["g"], PERCENTS).collect():
        true = by_hand([x for k, x in rows if k == r.g], PERCENTS)[r.percentile]
        assert r.low <= true <= r.high
        if r.g == "a" and true:
            assert abs(r.value - true) <= abs(true) * 2.0 ** -(percentiles.SKETCH_BITS - 12)


# Clusters


def cloud(seed, n=160, dims=5):
    r = np.random.default_rng(seed)
    centres = r.uniform(-6, 6, (12, dims))
    x = centres[r.integers(0, 12, n)] + r.normal(0, 0.35, (n, dims))
    x[:5] = x[0]
    return {f"p{i:03d}": x[i].tolist() for i in range(n)}


def chains(rows, radius):
    names = sorted(rows)
    x = np.array([rows[n] for n in names])
    near = ((x[:, None] - x[None]) ** 2).sum(2) <= radius**2
    root = list(range(len(names)))
    for _ in names:
        root = [min(root[j] for j in np.flatnonzero(near[i])) for i in range(len(names))]
    return {n: names[root[i]] for i, n in enumerate(names)}


def as_points(spark, rows, dims):
    data = [(k, *v) for k, v in rows.items()]
    data += data[:7] + [("none", *[None] * dims), ("nan", *[NAN] * dims), ("inf", *[INF] * dims), ("inf2", *[INF] * dims), (None, *[0.0] * dims)]
    columns = [f"c{k}" for k in range(dims)]
    df = spark.createDataFrame(data, "name string, " + ", ".join(f"{c} double" for c in columns))
    return clusters.points(df, "name", columns)


@pytest.mark.parametrize("seed, block, most", [(1, 4096, 0), (2, 4096, filters.MOST), (3, 5, filters.MOST)])
def test_linked_clusters_are_chains(spark, monkeypatch, seed, block, most):
    monkeypatch.setattr(filters, "MOST", most)
    rows = cloud(seed)
    got = clusters.linked_clusters(as_points(spark, rows, 5), 1.0, block).collect()
    want = chains(rows, 1.0)
    assert {r.name for r in got} == set(rows)
    groups = {}
    for r in got:
        groups.setdefault(r.component, set()).add(r.name)
    hand = {}
    for n, c in want.items():
        hand.setdefault(c, set()).add(n)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, hand.values()))


def test_pivot_clusters(spark):
    rows = cloud(5)
    members, _ = clusters.pivot_clusters(as_points(spark, rows, 5), 1.0, 9)
    by = {r.id: r for r in members.collect()}
    pivots = {r.cluster for r in by.values()}
    x = {p: np.array(r.x) for p, r in by.items()}
    for p in pivots:
        assert by[p].cluster == p
        assert all(np.sum((x[p] - x[q]) ** 2) > 1 for q in pivots if q != p)
    for p, r in by.items():
        near = min(pivots, key=lambda q: np.sum((x[p] - x[q]) ** 2))
        assert np.sum((x[p] - x[r.cluster]) ** 2) == pytest.approx(np.sum((x[p] - x[near]) ** 2))
        assert np.sum((x[p] - x[r.cluster]) ** 2) <= 1


def test_medoid_is_the_member_of_least_distance(spark):
    rows = cloud(7)
    members, _ = clusters.pivot_clusters(as_points(spark, rows, 5), 1.0)
    groups = {}
    for r in members.collect():
        groups.setdefault(r.cluster, []).append((r.name, np.array(r.x)))
    got = {r.cluster_name: r for r in clusters.describe_clusters(members).collect()}
    for g in groups.values():
        r = got[min(n for n, _ in g)]
        cost = {n: sum(np.sum((a - b) ** 2) for _, b in g) for n, a in g}
        assert r["size"] == len(g)
        assert cost[r.medoid] == pytest.approx(min(cost.values()))


def test_no_points(spark):
    empty = as_points(spark, {}, 5).limit(0)
    assert clusters.linked_clusters(empty, 1.0).count() == 0


# Top N


def test_top_n(spark):
    r = random.Random(4)
    rows = [("hot", f"i{k}", float(r.randint(0, 50))) for k in range(6000)]
    rows += [(r.choice(["a", "b", "c", None]), f"i{r.randint(0, 40)}", r.choice([1.0, 2.0, 3.0, None, NAN, INF, -0.0, 0.0])) for _ in range(200)]
    rows += rows[:50] + [("a", None, 3.0)]
    df = spark.createDataFrame(rows, "g string, i string, s double").withColumn("rank", F.lit(1)).withColumn("r", F.lit(2))
    got = topn.top_n(df, "g", "i", "s", 10, row_group_bytes=2000)
    want = set()
    for g in ("hot", "a", "b", "c"):
        mine = {(i, s + 0.0) for k, i, s in rows if k == g and s is not None and not math.isnan(s)}
        best = sorted(mine, key=lambda e: (-e[1], e[0] is None, e[0] or ""))[:10]
        want |= {(g, i, s, k) for k, (i, s) in enumerate(best, 1)}
    assert {tuple(r) for r in got.collect()} == want
    assert got.count() == len(want)
    assert topn.top_n(df.limit(0), "g", "i", "s", 10).count() == 0
    assert topn.top_n(df, "g", "i", "s", 0).count() == 0


def test_top_n_skips_row_groups(spark):
    """Most row groups of a heavy group lie below its tenth score and are not chosen."""
    df = spark.range(60_000).select(F.lit("hot").alias("g"), F.col("id").cast("string").alias("i"), F.rand(1).alias("s"))
    path = topn.cluster_by_group(df, "g", "i", "s", 20_000)
    files = spark.read.parquet(path).inputFiles()
    stats = topn._row_groups(spark.createDataFrame([(f,) for f in files], "path string")).collect()
    floor = max(r.low for r in stats if r.one_group and r.n >= 10)
    assert len(stats) > 8 and sum(r.high >= floor for r in stats) <= 2


def test_top_n_of_a_clustered_table(spark):
    """A table clustered once answers for any n, and gives what the whole job gives."""
    r = random.Random(11)
    rows = [(r.choice("abc"), f"i{k % 70}", float(r.randint(0, 9))) for k in range(900)]
    df = spark.createDataFrame(rows, "g string, i string, s double")
    path = topn.cluster_by_group(df, "g", "i", "s", 2000)
    for n in (1, 7):
        a = {tuple(x) for x in topn.top_n_clustered(spark, path, n).collect()}
        assert a == {tuple(x) for x in topn.top_n(df, "g", "i", "s", n).collect()} and len(a) == 3 * n


# Filters


def test_filters(spark, monkeypatch):
    r = np.random.default_rng(2)
    inside, outside = (r.integers(-(2**63), 2**63 - 1, 500, dtype=np.int64) for _ in range(2))
    df = spark.createDataFrame([(int(h),) for h in inside], "h long").repartition(4)
    exact = filters.filter_of(df)
    assert exact.ordered is not None and exact.has(inside.view(np.uint64)).all() and not exact.has(outside.view(np.uint64)).any()
    monkeypatch.setattr(filters, "MOST", 10)
    monkeypatch.setattr(filters, "BITS", 20)
    bits = filters.filter_of(df)
    assert len(bits.bits) == 1 << 17 and bits.has(inside.view(np.uint64)).all() and bits.has(outside.view(np.uint64)).mean() < 0.01
    assert not filters.filter_of(df.limit(0)).has(inside.view(np.uint64)).any()


# Packing


@pytest.mark.parametrize("seed", range(4))
def test_pack(seed):
    r = np.random.default_rng(seed)
    lengths = np.minimum(r.geometric(1 / 60, 800), 256)
    place, slot = packing.pack(lengths, 256)
    used = np.bincount(place, lengths)
    assert (used <= 256).all() and (used > 0).all()
    assert len({*zip(place.tolist(), slot.tolist())}) == len(lengths)
    assert len(used) <= math.ceil(lengths.sum() / 256) * 1.02 + 1


def test_best_two_replaces_the_smallest():
    """Greedy takes 6 then 2 of 10; 2 gives way to 1 and 3, which fill the gap."""
    place, _ = packing.pack(np.array([6, 3, 3, 3, 2]), 9)
    assert sorted(np.bincount(place, [6, 3, 3, 3, 2]).tolist()) == [8, 9]
    place, _ = packing.pack(np.array([70, 25, 18, 12]), 100)
    assert len(set(place.tolist())) == 2 and max(np.bincount(place, [70, 25, 18, 12])) == 100


def test_fill_containers(spark):
    rows = [(1, 100), (2, 250), (3, None), (4, 0), (5, 30), (5, 30), (6, 64)]
    got = packing.fill_containers(spark.createDataFrame(rows, "id long, n long"), "id", "n", 100).collect()
    by = {}
    for r in got:
        by.setdefault(r.id, []).append((r.piece, r.start, r.n_tokens))
    assert sorted(by[2]) == [(0, 0, 100), (1, 100, 100), (2, 200, 50)]
    assert by[3] == by[4] == [(0, 0, 0)] and len(by[5]) == 2
    assert all(r.container is None for r in got if r.n_tokens == 0)
    full = {}
    for r in got:
        if r.container is not None:
            full[r.container] = full.get(r.container, 0) + r.n_tokens
    assert max(full.values()) <= 100 and sum(full.values()) == 100 + 250 + 60 + 64
    assert packing.fill_containers(spark.createDataFrame([], "id long, n long"), "id", "n", 100).count() == 0


def test_groups_follow_the_pieces(spark):
    """A document of very many pieces is spread over groups of bounded size."""
    df = spark.createDataFrame([(1, 1000 * 10 - 3), (2, 4), (3, 3)], "id long, n long")
    got = packing.fill_containers(df, "id", "n", 10, group=100).collect()
    groups = {}
    for r in got:
        groups[r.container >> 32] = groups.get(r.container >> 32, 0) + 1
    assert len(groups) == 11 and max(groups.values()) < 150
    assert sum(r.n_tokens for r in got) == 9997 + 7 and len(got) == 1002


def test_token_counts(spark):
    rows = [(1, "def f(x):\n  return x"), (2, None), (3, ""), (4, "a" * 200_000), (5, "é 中 🙂 <|endoftext|>")]
    got = {r.id: r.n for r in packing.token_counts(spark.createDataFrame(rows, "id int, t string"), "t", "n").collect()}
    encode = packing._encoding(packing.TOKENIZER).encode_ordinary
    assert got == {k: len(encode(t)) if t else 0 for k, t in rows}


# Leaks

ITEM = "For level number 6554 the answer is 1814; for a pulsar with supernova twice it is 239 instead."
OTHER = "Treat an empty stack as 5290, but keep match and value apart until ralba has seen both innings and child."


def leak_tables(spark):
    docs = [
        (1, "x = 1\n# " + ITEM + "\n"), (2, ITEM.upper().replace(" ", "\n// ")), (3, None), (4, ""), (5, "nothing of the sort"),
        (6, ITEM.replace("6554", "77").replace("pulsar", "comet").replace("1814", "9").replace("239", "55")),
        (7, " ".join(ITEM.split()[:12])), (8, " ".join(ITEM.split()[4:17])), (9, "w " * 700_000 + OTHER + " w" * 700_000), (1, ITEM),
        (10, "é" + ITEM.replace(" ", "é")),
    ]
    items = [(1, ITEM), (2, OTHER), (3, None), (4, "too short"), (5, ITEM)]
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), docs, items


@pytest.mark.parametrize("limit, bits", [(filters.MOST, 0), (0, 20), (0, 5)])
def test_leaks(spark, monkeypatch, limit, bits):
    import re

    monkeypatch.setattr(filters, "MOST", limit)
    monkeypatch.setattr(filters, "BITS", bits)
    docs, items, d, i = leak_tables(spark)
    words = lambda t: [w.lower() for w in re.findall("[A-Za-z0-9_]+", t or "")]
    grams = lambda t: {tuple(w[k : k + 13]) for w in [words(t)] for k in range(len(w) - 12)}
    want = {(a, b) for a, s in d for b, t in i if grams(s) & grams(t)}
    got = leaks.leaked_passages(docs, items).collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want)
    assert (9, 2) in want and (2, 1) in want and (7, 1) not in want
    assert leaks.leaked_passages(docs.limit(0), items).count() == 0
    assert leaks.leaked_passages(docs, items.limit(0)).count() == 0


def planted(seed, n=60):
    """Items of three sentences, and documents that carry them with names, numbers and units
    renamed, a name of two words in place of one, decimals, and a line put in between."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("bdfgklmnprstvz") + r.choice("aeiou") for _ in range(r.randint(2, 4)))
    forms = [
        "For {a} number {m} the answer is {n}; for a {b} with {c} twice it is {k} instead.",
        "Treat an empty {c} as {m}, but keep {a} and {d} apart until {b} has seen both {a} and {c}.",
        "Whenever the {d} holds {n} or more {a} values, drop every {b} whose {c} differs from {d} by {k}.",
        "Given a {b} of {d} and its {a}, return the least {c} that no {b} can reach in {m} steps.",
    ]
    items, docs = [], []
    for i in range(n):
        text = r.sample(forms, 3)
        fill = lambda: {x: word() for x in "abcd"} | {x: str(r.randint(10, 9999)) for x in "mnk"}
        items.append((i, "Write a function that passes the checks below. " + " ".join(f.format(**(own := fill())) for f in text[:1]) + " " + " ".join(f.format(**own) for f in text[1:])))
        if i % 2:
            new = fill() | {"a": f"{word()} {word()}", "m": f"{r.randint(1, 9)}.{r.randint(1, 9)}"}
            lines = [f.format(**new) for f in text]
            lines.insert(r.randint(1, 2), "this line " + word() + " is of the file")
            docs.append((1000 + i, "x = 1\n" + "\n".join("# " + line for line in lines) + "\nreturn x"))
    docs += [(5000 + i, " ".join(word() for _ in range(300))) for i in range(20)]
    return items, docs


def test_reworded_items_are_found(spark):
    """Recall on planted rewordings, which share their sentences' forms with other items."""
    items, docs = planted(2)
    it, do = spark.createDataFrame(items, "item_id long, text string"), spark.createDataFrame(docs, "doc_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in leaks.reworded_passages(do, it).collect()}
    want = {(d, d - 1000) for d, _ in docs if d < 5000}
    assert len(want & set(got)) >= 0.9 * len(want)
    assert all(got[k].n_renamed > 0 and got[k].share >= 0.5 for k in want & set(got))
    assert not [k for k in got if k[0] >= 5000]


def test_reworded(spark):
    docs, items, *_ = leak_tables(spark)
    more = [(100 + k, ITEM.replace("pulsar", f"thing{k}").replace("6554", str(k)).replace("supernova", f"part{k}").replace("level", f"slot{k}")) for k in range(4)]
    items = items.unionByName(spark.createDataFrame(more, "item_id long, text string"))
    got = {(r.doc_id, r.item_id): r.n_renamed for r in leaks.reworded_passages(docs, items).collect()}
    assert got[(1, 1)] == 0 and got[(6, 1)] > 0 and (5, 1) not in got
    assert leaks.reworded_passages(docs.limit(0), items).count() == 0
    assert leaks.reworded_passages(docs, items.limit(0)).count() == 0


def test_one_renaming_holds_over_the_item(spark):
    """A name that becomes another in each sentence is no renaming."""
    parts = [f"keep {{}} and the {w} apart until {{}} has seen both of them in order" for w in ("first", "last", "old", "new")]
    item = ". ".join(p.format("alpha", "alpha") for p in parts)
    same, other = ". ".join(p.format("omega", "omega") for p in parts), ". ".join(p.format(f"x{k}", f"x{k}") for k, p in enumerate(parts))
    frame = [(10 + k, ". ".join(p.format(f"w{k}", f"v{k}") for p in parts)) for k in range(3)]
    items = spark.createDataFrame([(1, item), *frame], "item_id long, text string")
    docs = spark.createDataFrame([(1, same), (2, other)], "doc_id long, text string")
    got = {(r.doc_id, r.item_id): r.share for r in leaks.reworded_passages(docs, items, share=0.1, least=1).collect()}
    assert got[(1, 1)] == 1.0 and got.get((2, 1), 0) < 1.0


def test_positions_go_on_over_segments():
    text = " ".join(f"w{k}" for k in range(400_000))
    seen = []
    for _, _, data, bases in leaks.segments([0], [text], 5):
        w = leaks.Words(data)
        seen.append((bases[0], data[w.start[0] : w.end[0]].decode(), data[w.start[-1] : w.end[-1]].decode()))
    assert len(seen) > 2 and all(first == f"w{base}" for base, first, _ in seen) and seen[-1][2] == "w399999"
    assert all(int(b[1][1:]) == int(a[2][1:]) - 3 for a, b in zip(seen, seen[1:]))


def test_words_are_cut_as_by_a_pattern():
    import re

    r = random.Random(5)
    text = "".join(r.choice("aZ09_ -é\n中\tK") for _ in range(3000))
    w = leaks.Words(text.encode())
    raw = text.encode()
    found = [raw[a:b].lower() for a, b in zip(w.start, w.end)]
    assert found == [m.encode().lower() for m in re.findall("[A-Za-z0-9_]+", text)]
    assert len({*zip(found, w.hash.tolist())}) == len(set(found)) == len(set(w.hash.tolist()))


# Subjects


def test_terms():
    text = "getHTTPServer_names boxes flies classes status x9Value FOO_barBaz genes"
    raw = np.frombuffer(text.encode(), np.uint8)
    start, end = subjects._terms(raw)
    assert [text[a:b] for a, b in zip(start, end)] == ["get", "HTTP", "Server", "names", "boxes", "flies", "classes", "status", "x", "Value", "FOO", "bar", "Baz", "genes"]
    got = subjects._fold(leaks.Words(text.encode()), start, end)
    want = subjects.term_hash(["get", "http", "server", "name", "box", "fly", "class", "status", "x", "value", "foo", "bar", "baz", "gene"])
    assert got.tolist() == want.tolist()


@pytest.fixture(scope="module")
def corpus(spark):
    r = random.Random(8)
    vocab = {"law": [f"law{chr(97 + k)}" + "q" for k in range(20)], "sport": [f"sport{chr(97 + k)}" + "z" for k in range(20)], "music": [f"tune{chr(97 + k)}" + "k" for k in range(20)]}
    common = [f"code{chr(97 + k)}" + "w" for k in range(26)]
    licence = "You may copy and change lawaq as long as this notice stays. "
    docs, truth = [], {}
    for k in range(400):
        about = r.sample(sorted(vocab), r.choice([0, 1, 1, 1, 2]))
        words = [r.choice(common) for _ in range(60)]
        for s in about:
            words += [r.choice(vocab[s]) for _ in range(30)]
        r.shuffle(words)
        docs.append((k, (licence * 3 if k % 5 == 0 else "") + "\n".join(" ".join(words[i : i + 8]) for i in range(0, len(words), 8))))
        truth[k] = set(about)
    docs += [(1000, None), (1001, "")]
    areas = spark.createDataFrame([(s, ", ".join(v[:4])) for s, v in vocab.items()], "subject string, example_words string")
    other = spark.createDataFrame([("no passage at all in here today",), (None,)], "text string")
    return spark.createDataFrame(docs, "doc_id long, text string").repartition(3), areas, other, truth


@pytest.mark.parametrize("few", [subjects.BROADCAST_TERMS, 0])
def test_subjects(corpus, monkeypatch, few):
    monkeypatch.setattr(subjects, "BROADCAST_TERMS", few)
    docs, areas, other, truth = corpus
    words = subjects.subject_words(docs, areas, other)
    got = {}
    for r in subjects.main_subjects(words).collect():
        got.setdefault(r.doc_id, set()).add(r.subject)
    assert all(got.get(k, set()) == s for k, s in truth.items())
    assert 1000 not in got and 1001 not in got


def test_composition(corpus):
    docs, areas, other, truth = corpus
    rows = subjects.composition(subjects.subject_words(docs, areas, other)).collect()
    assert sum(r.share for r in rows) == pytest.approx(1.0)
    assert {r.subject: r.n_documents for r in rows} == {s: sum(s in t for t in truth.values()) for s in ("law", "music", "sport")}


def test_few_documents_are_not_all_boilerplate(corpus):
    docs, areas, other, truth = corpus
    few = docs.where("doc_id < 60")
    assert len(subjects.boilerplate(few, "text")) <= 1
    got = subjects.main_subjects(subjects.subject_words(few, areas, other)).collect()
    right = sum(r.subject in truth[r.doc_id] for r in got)
    want = sum(len(s) for k, s in truth.items() if k < 60)
    assert right >= 0.9 * len(got) and right >= 0.9 * want


def test_at_most_two_subjects(spark):
    rows = [(1, "a", 30.0, 0.3), (1, "b", 30.0, 0.3), (1, "c", 40.0, 0.4), (2, "a", 2.0, 1.0), (3, "b", 9.0, 1.0), (4, "a", None, None)]
    words = spark.createDataFrame(rows, "doc_id long, subject string, n_words double, share double")
    assert {(r.doc_id, r.subject) for r in subjects.main_subjects(words).collect()} == {(1, "c"), (1, "a"), (3, "b")}
    assert {r.subject: r.n_documents for r in subjects.composition(words).collect()} == {"a": 1, "b": 1, "c": 1}


def test_passages_to_blank_are_bounded(spark, monkeypatch):
    texts = spark.createDataFrame([("one two three four five six seven",), (None,), ("too short",)], "text string")
    assert len(subjects.phrases(texts, "text")) == 2
    assert len(subjects.phrases(texts.limit(0), "text")) == 0
    monkeypatch.setattr(subjects, "MOST_PHRASES", 1)
    with pytest.raises(ValueError, match="phrases"):
        subjects.phrases(texts, "text")


@pytest.mark.parametrize("entries", [2000, 10**9])
def test_rates_routed_to_blocks(corpus, monkeypatch, entries):
    """Any number of blocks gives what the array in every task gives."""
    docs, areas, other, _ = corpus
    few = docs.where("doc_id < 120")
    key = lambda df: {(r.doc_id, r.subject): r.n_words for r in df.collect()}
    want = key(subjects.subject_words(few, areas, other, rounds=3))
    monkeypatch.setattr(subjects, "BROADCAST_TERMS", 0)
    monkeypatch.setattr(subjects, "BLOCK_ENTRIES", entries)
    got = key(subjects.subject_words(few, areas, other, rounds=3))
    assert set(got) == set(want)
    assert all(got[k] == pytest.approx(want[k], rel=1e-3, abs=1e-3) for k in want)


def test_subjects_of_no_documents(corpus):
    docs, areas, other, _ = corpus
    assert subjects.main_subjects(subjects.subject_words(docs.limit(0), areas, other)).count() == 0


def test_copies_are_no_boilerplate(spark):
    """A file that is vendored often is one text; a licence line of many texts stays common."""
    licence = "You may copy and change this file as long as the notice stays."
    own = lambda k: " ".join(f"word{chr(97 + k % 26)}{chr(97 + k // 26)}{j}" for j in range(8))
    rows = [(k, own(k) + ".\n" + (licence if k < 20 else "")) for k in range(200)]
    rows += [(1000 + k, "The vendored parser reads rules of the law from tables.") for k in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = subjects.boilerplate(docs, "text").tolist()
    _, _, want = subjects._sentences(w := leaks.Words(licence.encode()), np.zeros(len(w.start), int))
    assert got == want.tolist()
