"""Operators, sources and streams on inline frames: nulls, ties, empty tables, hot keys."""

import datetime as dt
import json
import os
import re

import pytest
from pyspark.sql import functions as F

from tessera.operators import features, fusion, graph, incremental, joins, ml, profile, retrieval, windows
from tessera.sources import files, landed
from tessera.streaming import events

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def test_fusion_ignores_nulls_and_breaks_ties_by_order(spark):
    df = spark.createDataFrame([(1, 2, 1.0, None), (1, 1, None, "b"), (1, 3, 3.0, "a"), (2, 1, None, None)], "k int, o int, x double, c string")
    assert rows(fusion.fuse_treatments(df, ["k"], ["x"], ["c"], ["o"]), "k") == [(1, 2.0, "b", 3), (2, None, None, 1)]
    assert fusion.fuse_treatments(df.limit(0), ["k"], ["x"], ["c"], ["o"]).count() == 0
    assert rows(fusion.best_rows(df, ["k"], ["o"]), "k")[0] == (1, 3, 3.0, "a")
    assert rows(fusion.duplicate_rows(df, ["k"])) == [(2, 3, 1)]


def test_evidence_fusion_takes_most_confident_then_earliest(spark):
    df = spark.createDataFrame([(1, 5.0, 0.9, "r1", 2), (1, 6.0, 0.9, "r2", 1), (1, None, 1.0, "r3", 0), (2, 1.0, 0.1, "r1", 1)], "k int, v double, c double, r string, o int")
    got = {r.k: r for r in fusion.fuse_evidence(df, ["k"], "v", "c", "r", "o").collect()}
    assert (got[1].fused, got[1].fused_by, got[1].candidates, got[1].conflict, got[1].readers) == (6.0, "r2", 2, True, "r1,r2")
    assert got[2].conflict is False


def test_majority_and_records(spark):
    df = spark.createDataFrame([("s", "a"), ("s", "b"), ("s", "b"), ("s", None), ("t", None)], "k string, c string")
    assert sorted((r.k, r.majority or "", r.rewritten) for r in fusion.rewrite_minority(df, "k", "c").collect() if r.c == "a") == [("s", "b", True)]
    rec = spark.createDataFrame([(1, "d", ["x"], 3, None), (2, "d", ["y", "x"], 5, "J")], "id int, doi string, tags array<string>, n int, journal string")
    got = fusion.deduplicate_records(rec, F.col("doi"), F.col("n"), "id", ["tags"], ["n"], ["journal"]).first()
    assert (got.id, got.members, got.tags, got.n, got.journal) == (2, 2, ["x", "y"], 5, "J")


def test_similar_titles_meet_in_blocks(spark):
    df = spark.createDataFrame([(1, "Effect of zinc on wheat yield"), (2, "Effect of zinc on wheat yields"), (3, "Other"), (4, None)], "id int, t string")
    assert [r[:2] for r in rows(fusion.similar_titles(df, "id", "t", F.substring("t", 1, 6)))] == [(1, 2)]


def test_all_similar_titles_equal_brute_force(spark):
    import random
    from difflib import SequenceMatcher

    rng = random.Random(2)
    base = ["".join(rng.choice("abcd efgh") for _ in range(n)) for n in (10, 11, 12, 15, 19, 20, 21, 40, 60, 80, 80)] + ["a a " * 15, "ab" * 11, "x" * 30]
    titles = list(base)
    for t in base * 6:
        for _ in range(rng.randint(1, max(1, len(t) // 14))):  # edits anywhere, the start as well
            at = rng.randrange(len(t) + 1)
            t = t[:at] + rng.choice(["", "z", "q"]) + t[at + rng.randint(0, 1) :]
        titles.append(t)
    titles += ["Zinc, on wheat!", "zinc on wheat", "", "!!", None]
    df = spark.createDataFrame(list(enumerate(titles)), "id int, t string")
    norm = [re.sub("[^a-z0-9]+", " ", (t or "").lower()).strip() for t in titles]
    brute = {(i, j): r for j in range(len(norm)) for i in range(j) if norm[i] and norm[j] and (r := SequenceMatcher(None, norm[i], norm[j]).ratio()) >= 0.95}
    got = fusion.all_similar_titles(df, "id", "t").collect()
    assert len(got) == len(brute) > 50 and {(r.a, r.b): r.similarity for r in got} == pytest.approx(brute)


def test_title_pairs_of_blocks_equal_brute_force_without_a_join_of_pieces(spark):
    import random
    from difflib import SequenceMatcher

    rng = random.Random(3)
    made = {"a", "ab", "abc", "b a", "aaaa", "aaaab"}
    for n in (8, 19, 20, 21, 41, 80, 130):
        word = "".join(rng.choice("aab c1") for _ in range(n)).strip()
        for _ in range(12):
            at = rng.randrange(len(word))
            made.add(word[:at] + rng.choice(["", "z", "a"]) + word[at + rng.randint(0, 1) :])
    titles = spark.createDataFrame([(t,) for t in sorted(made)], "n string")
    for threshold in (0.95, 0.8, 0.3):
        brute = {(p, q): r for p in made for q in made if p != q and (r := SequenceMatcher(None, p, q).ratio()) >= threshold}
        for size in ({}, {"block": 9}):
            pairs = fusion.title_pairs(titles, threshold, **size)
            got = pairs.collect()
            assert len(got) == len(brute) > 100 and {(r.p, r.q): r.similarity for r in got} == brute
            assert "Join" not in pairs._jdf.queryExecution().executedPlan().toString()
    assert fusion.title_pairs(titles.limit(0)).count() == 0


def test_title_ratios_are_difflibs_without_a_call_a_pair(monkeypatch):
    import difflib
    import random

    import numpy as np
    import pyarrow as pa

    rng, made = random.Random(4), []
    for n in (1, 2, 7, 20, 41, 80, 80, 80, 130, 199, 200, 230):
        for letters in ("ab", "abc ", "abcdefghijklmnop "):
            word = "".join(rng.choice(letters) for _ in range(n))
            made += [word, word[n // 4 :] + word[: n // 4]]
            for _ in range(6):
                at = rng.randrange(n)
                made.append(word[:at] + rng.choice(["", "z", "a"]) + word[at + rng.randint(0, 1) :] or "z")
    p, q = (np.array([rng.randrange(len(made)) for _ in range(6000)]) for _ in range(2))
    q[::2] = np.minimum(p[::2] // 8 * 8 + q[::2] % 8, len(made) - 1)
    brute = np.array([difflib.SequenceMatcher(None, made[a], made[b]).ratio() for a, b in zip(p, q)])
    size = np.array([len(x) for x in made])
    flat = np.frombuffer("".join(made).encode(), np.uint8)
    for threshold in (0.95, 0.8, 0.3):
        got = fusion.block_ratios(flat, np.cumsum(size) - size, size, p, q, threshold)
        over = brute >= threshold
        assert over.sum() > 500 and (got[over] == brute[over]).all() and (got[~over] < threshold).all()

    # 400 copies with a letter changed are 79,800 pairs in each order: one call a pair took most of the time
    words = " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(13))
    titles = sorted({words[:at] + x + words[at + 1 :] for at in range(20) for x in "ijklmnopqrstuvwxyz0123"})[:400]
    monkeypatch.setattr(difflib, "SequenceMatcher", None)
    batch = {"i": [0] * 400, "j": [0] * 400, "own": [0] * 400, "n": titles}
    for columns, most in (({}, 2), ({"low": list(range(400)), "high": list(range(400))}, 1)):
        out = pa.Table.from_batches(fusion._title_matcher(0.95)([pa.RecordBatch.from_pydict(batch | columns)]))
        assert len(out) == most * 400 * 399 // 2 and min(out["similarity"].to_pylist()) >= 0.95
        assert most == 2 or all(a < b for a, b in zip(out["p"].to_pylist(), out["q"].to_pylist()))


def test_similar_titles_of_keys_that_repeat_and_lack(spark):
    title = "soil and water of the plain under wheat and rice in the dry season of years "
    made = [(3, title + "a"), (1, title + "b"), (2, title + "b"), (None, title + "c"), (5, title.upper() + "A"), (4, ""), (6, None)]
    alike = {(1, 2), (3, 5), (1, 3), (2, 3), (1, 5), (2, 5)}
    for kind in ("bigint", "string", "double"):
        df = spark.createDataFrame(made, "id bigint, t string").withColumn("id", F.col("id").cast(kind))
        got = [(int(float(r.a)), int(float(r.b))) for r in fusion.all_similar_titles(df, "id", "t").collect()]
        assert len(got) == len(alike) and set(got) == alike


def test_profiles_of_empty_and_null_columns(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 1.0)], "a double, b double")
    assert rows(profile.missing(df, ["a", "b"]), "column_name") == [("a", 2, 0, 100.0), ("b", 0, 2, 0.0)]
    assert rows(profile.missing(df.limit(0), ["a"])) == [("a", 0, 0, None)]
    assert [r[1:] for r in rows(profile.outliers(df, ["a", "b"]), "column_name")] == [(0, 0, 0), (0, 0, 0)]
    assert rows(profile.correlations(df, ["a", "b"])) == [("a", "b", None)]
    assert profile.statistics(df.limit(0), ["a"]).first().n == 0
    assert [r.vif for r in profile.inflation(df, ["a", "b"]).collect()] == [float("inf")] * 2


def test_contract_reports_each_kind(spark):
    df = spark.createDataFrame([(None, 1)], "a string, x int")
    got = {tuple(r) for r in profile.contract(df, {"a": "string", "x": "double", "m": "int"}, ["a"]).collect()}
    assert got == {("missing", "m", "int"), ("type", "x", "int for double"), ("null", "a", "1")}


def test_spatial_bins_fill_but_never_overwrite(spark):
    m = spark.createDataFrame([(1, 0.4, 0.4, None), (2, 0.4, 0.4, 9.0), (3, None, 0.0, None), (4, 5.0, 5.0, None)], "id int, lat double, lon double, t double")
    e = spark.createDataFrame([(0.1, 0.2, 4.0, 1.0), (0.0, -0.3, 6.0, 3.0)], "y double, x double, t double, rain double")
    assert rows(joins.spatial_bins(m, e, "lat", "lon", "y", "x", ["t", "rain"]).select("id", "t", "rain"), "id") == [(1, 5.0, 2.0), (2, 9.0, 2.0), (3, None, None), (4, None, None)]


def test_pairs_and_frequent_tokens(spark):
    df = spark.createDataFrame([(1, ["a", "b"]), (2, ["a"]), (3, ["b", "c"]), (4, None)], "k int, t array<string>")
    assert rows(joins.weighted_pairs(df, "k", {"t": 0.5}), "a", "b") == [(1, 2, 0.5), (1, 3, 0.5)]
    assert rows(joins.frequent_tokens(df, "k", ["t"], 1), "token") == [("t", "a", 2), ("t", "b", 2)]
    with pytest.raises(ValueError):
        joins.options(df, spark.range(20), F.lit(1.0), ["k"], most=10)


def test_pairs_are_summed_up_in_blocks_and_never_shuffled(spark):
    import random

    rng = random.Random(4)
    data = [(f"k{i:03}" if i else None, rng.sample("abcdefgh", rng.randint(0, 4)), rng.sample("abxyz", rng.randint(0, 3)) + ["all"]) for i in range(60)]
    df = spark.createDataFrame(data, "k string, t array<string>, u array<string>")
    brute = {}
    for k, t, u in data[1:]:
        for m, v, w in data[1:]:
            if k < m and (n := 0.5 * len({*t} & {*v}) + 2 * len({*u} & {*w})):
                brute[k, m] = n
    for size in ({}, {"entries": 20, "most": 7}):
        pairs = joins.weighted_pairs(df, "k", {"t": 0.5, "u": 2.0}, **size)
        got = pairs.collect()
        assert len(got) == len(brute) and {(r.a, r.b): r.score for r in got} == brute
        assert not re.search(r"hashpartitioning\((k|a|b)#", pairs._jdf.queryExecution().executedPlan().toString())
    assert joins.weighted_pairs(df.limit(0), "k", {"t": 0.5}).count() == 0


def test_windows(spark):
    df = spark.createDataFrame([("a", i, float(i)) for i in range(10)], "k string, o int, x double")
    assert [r[-1] for r in rows(windows.moving_average(df, "x", ["k"], ["o"], 3), "o")][:4] == [0.0, 0.5, 1.0, 2.0]
    ties = spark.createDataFrame([(3.0,), (2.0,), (2.0,), (1.0,)], "x double")
    assert sorted(r[-1] for r in rows(windows.average_rank(ties, "x"))) == [1.0, 2.5, 2.5, 4.0]
    parts = spark.createDataFrame([("k", 1, 4), ("k", 2, 3), ("k", 6, 8), ("k", 8, 9)], "k string, a int, b int")
    assert rows(windows.islands(parts, ["k"], "a", "b"), "a") == [("k", 1, 4, 2), ("k", 6, 9, 2)]
    v = windows.versions(spark.createDataFrame([("p", 1, "x"), ("p", 2, "x"), ("p", 3, "y")], "p string, t int, c string"), ["p"], ["t"], "c")
    assert [(r.version, r.status, r.changed) for r in v.orderBy("t").collect()] == [(1, "superseded", True), (2, "superseded", False), (3, "active", True)]


def test_graph(spark):
    n = spark.createDataFrame([(i,) for i in range(7)], "id int")
    e = spark.createDataFrame([(0, 1, "t"), (1, 2, "t"), (4, 3, "t"), (5, 5, "t")], "src int, dst int, type string")
    assert rows(graph.components(n, e), "id") == [(0, 0), (1, 0), (2, 0), (3, 3), (4, 3), (5, 5), (6, 6)]
    assert rows(graph.distances(e, 0), "id") == [(0, 0), (1, 1), (2, 2)]
    assert rows(graph.distances(e, 2, reverse=True), "id") == [(0, 2), (1, 1), (2, 0)]
    assert sum(r.rank for r in graph.pagerank(n, e).collect()) == pytest.approx(1.0)
    assert graph.summary(n, e).first().components == 4
    assert {r.id for r in graph.neighbours(e, 1).collect()} == {0, 2}
    log = spark.createDataFrame([("x", 1, "a"), ("x", 2, "b"), ("x", 3, "a")], "k string, o int, s string")
    assert [r.o for r in graph.transition_errors(log, "k", "o", "s", ["a", "b"]).collect()] == [3]


def test_distances_reach_every_node(spark):
    e = spark.createDataFrame([(i, i + 1) for i in range(23)], "src int, dst int").coalesce(1)
    assert rows(graph.distances(e, 0), "id") == [(i, i) for i in range(24)]
    with pytest.raises(RuntimeError):
        graph.distances(e, 0, bound=3)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name,start,reverse", [("shortest_paths_whole", 0, False), ("upstream_lineage_whole", 5, True)])
def test_whole_searches_equal_a_plain_search(spark, name, start, reverse):
    from tessera.plans import ordered, registry

    links = [(r.dst, r.src) if reverse else (r.src, r.dst) for r in ordered._chain(spark, SF).collect()]
    want, front, k = {start: 0}, {start}, 0
    while front:
        k += 1
        front = {b for a, b in links if a in front} - want.keys()
        want |= dict.fromkeys(front, k)
    assert dict(rows(registry.queries()[name](spark, SF))) == want


def test_incremental(spark):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", None)], "k int, s string, n int")
    new = spark.createDataFrame([(2, None, 5), (3, "c", 6)], "k int, s string, n int")
    assert rows(incremental.upsert(old, new, ["k"]), "k") == [(1, "a", 1), (2, "b", 5), (3, "c", 6)]
    assert rows(incremental.changes(old, new, "k", ["s"]), "k") == [(1, "removed"), (2, "changed"), (3, "added")]
    assert incremental.affected({"a": [], "b": ["a"], "c": ["b"], "d": []}, {"a"}) == ["a", "b", "c"]
    df = spark.createDataFrame([(25, None), (25, 24), (30, 20), (5, None)], "n int, p int")
    assert [r[0] for r in df.select(incremental.retrain_due(F.col("n"), F.col("p"))).collect()] == [True, False, True, False]


def test_retrieval(spark):
    df = spark.createDataFrame([(1, "x" * 1000), (2, "short"), (3, None), (4, "long enough")], "id int, t string")
    got = rows(retrieval.chunks(df, "id", "t"), "id", "chunk_no")
    assert [(a, b, len(c)) for a, b, c in got] == [(1, 0, 512), (1, 1, 512), (1, 2, 104), (4, 0, 11)]
    line = spark.createDataFrame([("a", 1.0, 2.0), ("a", 2.0, 4.0), ("a", 3.0, 6.0), ("b", 1.0, 1.0), ("b", 1.0, 2.0), ("b", 1.0, 3.0), ("c", 1.0, None)], "g string, x double, y double")
    got = {r.g: r for r in retrieval.response_line(line, ["g"], "x", "y").collect()}
    assert got["a"].slope == pytest.approx(2) and got["a"].r2 == pytest.approx(1) and got["b"].slope is None and "c" not in got
    v = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 1.0]), (3, [0.0, 0.0])], "id int, v array<double>")
    assert [r[1] for r in rows(retrieval.nearest(v.filter("id = 1"), v, "id", "v", 2), "rank")] == [1, 2]
    pooled = retrieval.pooled(spark.createDataFrame([("g", 1.0, 1.0), ("g", 3.0, 1.0), ("g", 9.0, 0.0)], "g string, x double, s double"), ["g"], "x", "s").first()
    assert (pooled.k, pooled.fixed, pooled.q, pooled.tau2, pooled.random) == (2, 2.0, pytest.approx(2.0), pytest.approx(1.0), 2.0)


def test_nearest_equals_sql_with_copies_and_multiples(spark):
    import duckdb
    import numpy as np
    import pandas as pd

    rng = np.random.default_rng(5)
    base = rng.normal(size=(40, 16)).astype(np.float32)
    m = np.concatenate([base, base[:20], base * np.float32(3), base[:1].repeat(60, 0), rng.normal(size=(900, 16)).astype(np.float32) * np.float32(1e-3)])
    ids = rng.permutation(len(m)) * 7
    data = pd.DataFrame({"id": ids, "v": list(m.astype(float))})
    con = duckdb.connect()
    con.register("data", data)
    want = con.sql("SELECT query, id, score, rank FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, id) AS rank FROM (SELECT q.id AS query, d.id AS id, list_cosine_similarity(q.v, d.v) AS score FROM data d, data q WHERE q.id % 5 = 0) WHERE score >= 0.1) WHERE rank <= 6").fetchall()
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, m)] + [(-1, [0.0] * 16), (-2, None), (-3, [1.0, None]), (-4, [1.0, 2.0])], "id int, v array<double>")
    for block in (10_000, 50):
        got = retrieval.nearest(df.filter("id % 5 = 0"), df, "id", "v", 6, 0.1, block).select("query", "id", "score", "rank").collect()
        assert len(got) == len(want) > 1000 and {tuple(r) for r in got} == set(want)


def test_derivation_and_encoding(spark):
    df = spark.createDataFrame([(1.0, None, 3.0), (None, None, 4.0)], "a double, t double, kept double")
    got = features.derive(df, [("t", ["a"], F.col("a") * 2), ("kept", ["a"], F.lit(0.0)), ("u", ["nope"], F.lit(0.0))])
    assert got.columns == ["a", "t", "kept"] and [r.t for r in got.collect()] == [2.0, None] and [r.kept for r in got.collect()] == [3.0, 4.0]


def test_models(spark):
    assert ml.is_leaky("Predicted_Yield", "Yield_per_Hectare") and ml.is_leaky("Yield_per_Plot", "Yield_per_Hectare") and not ml.is_leaky("Soil_pH", "Yield_per_Hectare")
    assert [ml.scheme(n) for n in (7, 8, 30)] == ["refuse", "leave-one-out", "repeated-5x3"] and ml.scheme(50, 9) == "leave-one-group-out"
    assert ml.ensemble_weights({"a": 0.5, "b": -1.0}) == {"a": 1.0, "b": 0.0} and ml.ensemble_weights({"a": -1, "b": -1}) == {"a": 0.5, "b": 0.5}
    df = spark.createDataFrame([(i, float(i % 17) if i % 5 else None, float(i % 17) * 2 + 1) for i in range(200)], "g int, x double, y double")
    got = ml.cross_validated(df, ["x"], "y", F.col("g"), "linear", 3)
    assert got.count() == 200 and profile.regression_metrics(got, "label", "prediction").first().r2 > 0.5
    prof = spark.createDataFrame([("a", 0.0, 1.0), ("b", 0.9, 1.0), ("c", 0.0, 0.0), ("d", 0.0, 1.0)], "column_name string, missing_share double, variance double")
    corr = spark.createDataFrame([("a", "d", 0.95)], "a string, b string, r double")
    assert ml.select_features(prof, corr, {"a": 0.2, "d": 0.5}) == ["d"]


@pytest.mark.parametrize("suffix", ["parquet", "csv", "tsv", "jsonl", "sqlite", "duckdb"])
def test_round_trip_of_formats(spark, tmp_path, suffix):
    df = spark.createDataFrame([(1, "a", 1.5), (2, "é", None)], "k int, s string, x double")
    path = f"{tmp_path}/t.{suffix}"
    files.write(df, path)
    got = files.read(spark, path, sep="\t" if suffix == "tsv" else ",", encoding="utf-8") if suffix in ("csv", "tsv") else files.read(spark, path)
    assert [(r.k, r.s, None if r.x is None or r.x != r.x else r.x) for r in got.orderBy("k").collect()] == [(1, "a", 1.5), (2, "é", None)]


@pytest.mark.parametrize("suffix", ["sqlite", "duckdb"])
def test_single_files_are_written_in_portions(spark, tmp_path, monkeypatch, suffix):
    monkeypatch.setattr(files, "ROWS", 3)
    df = spark.range(10).select(F.col("id"), F.when(F.col("id") != 4, F.concat(F.lit("v"), "id")).alias("v")).repartition(3)
    for part, n in ((df, 10), (df.limit(0), 0), (df.limit(2), 2)):  # a later write replaces an earlier one
        files.write(part, f"{tmp_path}/t.{suffix}")
        if n:
            got = files.read(spark, f"{tmp_path}/t.{suffix}")
            assert got.count() == n and got.columns == ["id", "v"]


def test_nested_rows_and_marked_text(spark, tmp_path):
    nested = spark.sql("select 1 a, named_struct('x', array(named_struct('y', 2))) s, map('k', 3) m")
    files.write(nested, f"{tmp_path}/n.duckdb")
    import duckdb

    assert duckdb.connect(f"{tmp_path}/n.duckdb").sql("select s.x[1].y, m['k'] from data").fetchall()[0][0] == 2
    files.write(spark.createDataFrame([(1, "é")], "k int, s string").coalesce(1), f"{tmp_path}/m.csv", mark=True)
    part = next(p for p in (tmp_path / "m.csv").iterdir() if p.name.startswith("part"))
    assert part.read_text(encoding="utf-8-sig").splitlines() == ["k,s", "1,é"] and part.read_bytes().startswith(b"\xef\xbb\xbf")


def test_sniffing_union_and_schema(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x;y\n1;2\n", encoding="latin1")
    (tmp_path / "b.csv").write_text("x,z\n3,é\n", encoding="utf-8")
    got = files.union_files(spark, [f"{tmp_path}/a.csv", f"{tmp_path}/b.csv"])
    assert got.columns == ["x", "y", "_source_file", "z"] and rows(got.select("x", "z"), "x") == [(1, None), (3, "é")]
    assert files.complete_schema(got, {"q": "int", "x": "int"}).columns[:2] == ["q", "x"]
    assert files.rename(spark.createDataFrame([(None, 2)], "a int, b int"), {"a": "c", "b": "c"}).first().c == 2
    assert files.map_column("Soil pH", {}, {"Soil_pH": ["ph"]}) == "Soil_pH" and files.map_column("zzz", {}, {"Soil_pH": ["ph"]}) is None
    m = files.feature_store(spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "k string, x int"), f"{tmp_path}/store", ["k"])
    assert rows(m, "k") == [("a", 2), ("b", 1)]


def test_content_addressing(spark, tmp_path):
    for name, body in (("a.txt", "one"), ("b.txt", "one"), ("c.txt", "two")):
        (tmp_path / name).write_text(body)
    got = files.content_addressed(spark.read.format("binaryFile").load(f"{tmp_path}/*.txt"), "src")
    assert got.count() == 3 and got.select("hash").distinct().count() == 2


def test_landed_connector(spark, tmp_path):
    (tmp_path / "crossref-1.jsonl").write_text(json.dumps({"source": "crossref", "source_id": "1", "year": 2020}) + "\n\n")
    assert len(landed.CONNECTORS) == 36
    got = landed.load(spark, "crossref", str(tmp_path)).first()
    assert (got.source, got.year, got.doi) == ("crossref", 2020, None)
    assert landed.load(spark, "arxiv", str(tmp_path)).count() == 0
    (tmp_path / "doaj-1.jsonl").write_text("no record\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        landed.load(spark, "doaj", str(tmp_path)).collect()


def test_html_tables_expand_spans(spark):
    html = "<table><tr><th colspan=2>A</th><th rowspan=2>B</th></tr><tr><td>1</td><td>2</td></tr></table>"
    df = spark.createDataFrame([(1, html), (2, None), (3, "<p>x")], "id long, h string")
    assert [r[2:] for r in rows(files.html_tables(df, "id", "h"), "row_no", "col_no")] == [(0, 0, "A"), (0, 1, "A"), (0, 2, "B"), (1, 0, "1"), (1, 1, "2"), (1, 2, "B")]


def test_streams(spark, tmp_path):
    t0 = dt.datetime(2024, 1, 1)
    data = [(i, t0 + dt.timedelta(minutes=20 * i), i % 2, float(i)) for i in range(12)] + [(0, t0, 0, 0.0)]
    spark.createDataFrame(data, "id int, ts timestamp, k int, v double").coalesce(1).write.parquet(f"{tmp_path}/in")
    schema = spark.read.parquet(f"{tmp_path}/in").schema
    source = events.stream(spark, f"{tmp_path}/in", schema)
    got = events.drain(events.windowed(source, "ts", ["k"], "v", "1 hour"), "w1", "complete")
    assert sum(r.n for r in got.collect()) == 13 and got.select("start").distinct().count() == 4
    assert events.drain(events.once(source, ["id"], "ts"), "w2").count() == 12
    events.upsert_into(source.select("id", "k", "v"), f"{tmp_path}/table", ["id"], f"{tmp_path}/ck").awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/table/v0").count() == 12
