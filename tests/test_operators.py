"""Operators against brute force, with hot keys."""

import inspect
import random

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from slotwise.operators import attach, categories, constancy, intervals, ranks, trailing, upsert


def test_attach_splits_hot_keys_and_keeps_every_row(spark):
    random.seed(3)
    keys = ["hot"] * 600 + [None] * 300 + [f"k{random.randint(0, 40)}" for _ in range(300)]
    fact = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "id long, key string")
    lookup = fact.groupBy("key").agg(F.count(F.lit(1)).alias("w"), F.max("id").alias("last")).where("key is null or key <> 'k1'")
    joined = attach.attach(fact, lookup, ["key"], "w", ["id"], null_safe=True)
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "_slice" in plan
    want = pd.DataFrame({"id": range(len(keys)), "key": keys})
    last = want.groupby("key", dropna=False)["id"].max().to_dict()
    got = {r["id"]: r["last"] for r in joined.collect()}
    nan_last = want[want["key"].isna()]["id"].max()
    assert len(got) == len(keys) == joined.count()
    for i, k in enumerate(keys):
        assert got[i] == (nan_last if k is None else None if k == "k1" else last[k])


def test_attach_spreads_a_hot_key_over_slices(spark):
    fact = spark.range(4000).select(F.col("id"), F.lit("one").alias("key"))
    lookup = fact.groupBy("key").agg(F.count(F.lit(1)).alias("w"))
    joined = attach.attach(fact, lookup.withColumn("v", F.lit(1)), ["key"], "w", ["id"])
    slices = fact.select(F.pmod(F.xxhash64("id"), F.lit(4)).alias("s")).distinct().count()
    assert slices == 4 and joined.where("v = 1").count() == 4000


def test_attach_without_null_safety_leaves_null_keys_unmatched(spark):
    keys = ["hot"] * 500 + [None] * 400 + ["cold"] * 100
    fact = spark.createDataFrame(list(enumerate(keys)), "id long, key string")
    lookup = fact.dropna().groupBy("key").agg(F.count(F.lit(1)).alias("w"), F.lit(1).alias("v"))
    got = attach.attach(fact, lookup, ["key"], "w", ["id"]).groupBy("key").agg(F.count("id").alias("n"), F.sum("v").alias("v"))
    assert {r["key"]: (r["n"], r["v"]) for r in got.collect()} == {"hot": (500, 500), None: (400, None), "cold": (100, 100)}


def test_plain_join_without_hot_keys(spark):
    fact = spark.range(1000).select("id", F.pmod("id", F.lit(200)).alias("key"))
    lookup = fact.groupBy("key").agg(F.count(F.lit(1)).alias("w"), F.sum("id").alias("total"))
    joined = attach.attach(fact, lookup, ["key"], "w", ["id"])
    assert "_slice" not in joined._jdf.queryExecution().optimizedPlan().toString()
    assert joined.where("total is null").count() == 0


@pytest.mark.parametrize("probability", [0.0, 0.25, 0.5, 0.95, 1.0])
def test_quantiles_match_numpy(spark, probability):
    random.seed(5)
    data = [("a", random.choice([1.0, 1.0, 1.0, random.random() * 100])) for _ in range(501)]
    data += [("b", float(i)) for i in range(10)]
    df = spark.createDataFrame(data, "g string, v double")
    got = {r["g"]: r["quantile"] for r in ranks.quantile(df, ["g"], "v", probability).collect()}
    for g in "ab":
        want = np.quantile([v for k, v in data if k == g], probability)
        assert got[g] == pytest.approx(want)


def test_running_sums(spark):
    random.seed(6)
    values = [random.randint(0, 500) for _ in range(3000)] + [7] * 1500
    df = spark.createDataFrame([(v,) for v in values], "v int")
    got = ranks.running_sums(ranks.value_counts(df, [], "v"), [], "v", ["n"]).collect()
    counts = pd.Series(values).value_counts().sort_index()
    assert {r["v"]: r["cum_n"] for r in got} == counts.cumsum().to_dict()
    assert {r["total_n"] for r in got} == {len(values)}


def test_medians_of_thousands_of_groups(spark):
    df = spark.range(40000).select(F.pmod("id", F.lit(5000)).alias("g"), F.hash("id").alias("v"))
    got = {r["g"]: r["median"] for r in ranks.median(df, ["g"], "v").collect()}
    want = df.toPandas().groupby("g")["v"].median()
    assert got == want.to_dict()


def test_running_sums_put_null_first(spark):
    df = spark.createDataFrame([("a", None, 2), ("a", 3, 1), (None, 5, 4)], "g string, v int, n int")
    got = {(r["g"], r["v"]): (r["cum_n"], r["total_n"]) for r in ranks.running_sums(df, ["g"], "v", ["n"]).collect()}
    assert got == {("a", None): (2, 3), ("a", 3): (3, 3), (None, 5): (4, 4)}


def test_nth_keys_with_ties(spark):
    data = [(10, i) for i in range(400)] + [(5, 1000 + i) for i in range(100)] + [(20, 2000)]
    random.seed(1)
    random.shuffle(data)
    df = spark.createDataFrame(data, "at long, tie long")
    positions = [0, 99, 100, 250, 499, 500]
    assert ranks.nth_keys(df, "at", "tie", positions) == [sorted(data)[p] for p in positions]
    with pytest.raises(ValueError):
        ranks.nth_keys(df, "at", "tie", [501])


def test_dense_index_is_gapless(spark):
    df = spark.range(777).withColumn("h", F.xxhash64("id"))
    got = sorted(r["i"] for r in ranks.dense_index(df, "h", "i").collect())
    assert got == list(range(777))


def brute_stab(points, spans):
    out = {}
    for place, at in points:
        hits = [s for s in spans if s[0] == place and s[1] <= at <= s[2]]
        if hits:
            out[(place, at)] = (len(hits), max(s[2] - s[1] for s in hits))
    return out


def run_stab(spark, points, spans):
    p = spark.createDataFrame(sorted(set(points)), "place string, at long")
    s = spark.createDataFrame([(*x, 1, x[2] - x[1]) for x in spans], "place string, a long, b long, n long, m long")
    got = intervals.stab(p, s, "place", "at", "a", "b", ["n"], ["m"])
    return {(r["place"], r["at"]): (r["n"], r["m"]) for r in got.collect()}


def test_stab_matches_brute_force_with_a_hot_place(spark):
    random.seed(9)
    second = 1_000_000
    spans, points = [], []
    for _ in range(400):
        start = random.randint(0, 40 * 86_400) * second + random.choice([0, 0, 1, 999_999, 123])
        length = random.choice([0, 1, second - 1, second, 61 * second, 5 * 3600 * second, 9 * 86_400 * second + 17])
        place = "hot" if random.random() < 0.6 else random.choice("abc")
        spans.append((place, start, start + length))
        points += [(place, start), (place, start - 1), (place, start + length), (place, start + length + 1)]
    points += [("hot", random.randint(0, 50 * 86_400 * second)) for _ in range(300)]
    spans.append(("a", 50, 10))
    assert run_stab(spark, points, spans) == brute_stab(set(points), spans)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    spans=st.lists(st.tuples(st.integers(0, 10**10), st.integers(0, 10**9)), min_size=1, max_size=12),
    points=st.lists(st.integers(0, 11 * 10**9), min_size=1, max_size=12),
)
def test_stab_property(spark, spans, points):
    spans = [("x", a, a + length) for a, length in spans]
    points = [("x", p) for p in points] + [("x", s[1]) for s in spans] + [("x", s[2]) for s in spans]
    assert run_stab(spark, points, spans) == brute_stab(set(points), spans)


def trips(spark, data):
    return spark.createDataFrame(data, "key string, day int, delay int").select(
        "key", F.timestamp_seconds(F.col("day") * 86_400 + 3600).alias("ts"), "delay"
    )


def test_trailing_ignores_the_own_day_and_old_days(spark):
    base = [("a", 1, 10), ("a", 8, 30), ("a", 9, 100), ("a", 39, 1), (None, 8, 20), (None, 9, 0), ("b", 9, None)]
    stats = trailing.trailing_stats(trips(spark, base), ["key"], "ts", "delay", "x", keep_null_keys=True)
    got = {(r["key"], r["day_no"]): r for r in stats.collect()}
    assert got[("a", 8)]["x_avg_delay_7d"] == 10 and got[("a", 8)]["x_delay_rate_7d"] == 0
    assert got[("a", 9)]["x_avg_delay_7d"] == 30
    assert got[("a", 9)]["x_avg_delay_30d"] == 20
    assert got[("a", 39)]["x_avg_delay_7d"] is None and got[("a", 39)]["x_avg_delay_30d"] == 100
    assert got[(None, 9)]["x_avg_delay_7d"] == 20
    assert got[("b", 9)]["x_avg_delay_7d"] is None
    changed = [(k, d, 999 if d == 9 else m) for k, d, m in base]
    again = trailing.trailing_stats(trips(spark, changed), ["key"], "ts", "delay", "x", keep_null_keys=True)
    assert {(r["key"], r["day_no"]): r for r in again.collect() if r["day_no"] <= 9} == {
        k: v for k, v in got.items() if k[1] <= 9
    }
    no_null = trailing.trailing_stats(trips(spark, base), ["key"], "ts", "delay", "x")
    assert no_null.where("key is null").count() == 0


def test_keep_last_keeps_null_fields_of_the_winner(spark):
    df = spark.createDataFrame([("k", 1, 5), ("k", 2, None)], "k string, o int, v int")
    assert [tuple(r) for r in upsert.keep_last(df, ["k"], ["o"]).collect()] == [("k", 2, None)]


def test_merge_keeps_first_and_overwrites_with_null(spark):
    df = spark.createDataFrame(
        [("k", 1, 5, "A"), ("k", 2, None, "B"), ("j", 1, 1, "C")], "k string, b int, delay int, terminal string"
    )
    got = upsert.merge_batches(df, ["k"], ["delay"], "b")
    assert sorted(tuple(r) for r in got.collect()) == [("j", 1, "C"), ("k", None, "A")]


def test_rewrite_partitions_is_idempotent_and_local(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([("a", 1, "x", 1), ("b", 1, "y", 2)], "k string, v int, f string, part int")
    upsert.rewrite_partitions(first, path, ["k"], ["v"], "part")
    untouched = {p.name for p in (tmp_path / "t" / "part=2").iterdir()}
    second = spark.createDataFrame([("a", None, "z", 1), ("c", 3, "w", 1)], "k string, v int, f string, part int")
    for _ in range(2):
        upsert.rewrite_partitions(second, path, ["k"], ["v"], "part")
        got = sorted((r["k"], r["v"], r["f"], r["part"]) for r in spark.read.parquet(path).collect())
        assert got == [("a", None, "x", 1), ("b", 1, "y", 2), ("c", 3, "w", 1)]
    assert {p.name for p in (tmp_path / "t" / "part=2").iterdir()} == untouched


def test_rare_groups_with_null(spark):
    values = ["A"] * 20 + ["B"] * 19 + [None] * 3
    df = spark.createDataFrame(list(enumerate(values)), "id long, c string")
    counts = categories.category_counts(df, ["c"])
    out = categories.group_rare(df, {"c": 20}, counts, ["id"])
    assert {(r["c"], r["c_grp"]) for r in out.collect()} == {("A", "A"), ("B", "OTHER"), (None, "OTHER")}
    frequent_null = categories.group_rare(df, {"c": 3}, counts, ["id"])
    assert (None, None) in {(r["c"], r["c_grp"]) for r in frequent_null.collect()}
    profile = categories.grouped_profile(counts, {"c": 20})[0]
    assert (profile["rows"], profile["missing"], profile["constant"]) == (42, 0, False)
    assert profile["top_share"] == 22 / 42


def test_near_constant_bounds(spark):
    df = spark.range(200).select(
        F.when(F.col("id") > 0, 1).otherwise(2).alias("drop_me"),
        F.when(F.col("id") > 1, "x").otherwise("y").alias("keep_me"),
        F.when(F.col("id") > 0, F.lit(None)).otherwise(1).alias("nearly_null"),
        F.lit(5).alias("same"), F.lit(None).cast("int").alias("empty"), "id",
    )
    constant, near = constancy.droppable(constancy.column_profile(df, df.columns))
    assert constant == ["same", "empty"]
    assert near == ["drop_me", "nearly_null"]


def test_most_frequent_takes_the_smallest_on_a_tie(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,), (None,), (None,)], "c string")
    got = categories.most_frequent(categories.category_counts(df, ["c"])).first()
    assert (got["value"], got["n"]) == ("a", 2)


def test_stab_points_and_ends_of_one_block_are_not_paired(spark):
    """200 points and 200 longer intervals that begin in one 64-second block: 40,000 pairs before."""
    unit = intervals.UNIT
    points = [("p", 5 * unit + i * 1000) for i in range(200)]
    spans = [("p", 5 * unit + i * 1000 + 7, 9 * unit) for i in range(200)]
    points.append(("p", 9 * unit))
    assert run_stab(spark, points, spans) == brute_stab(set(points), spans)
    p = spark.createDataFrame(points, "place string, at long")
    s = spark.createDataFrame([(*x, 1, 0.0) for x in spans], "place string, a long, b long, n long, m double")
    plan = intervals.stab(p, s, "place", "at", "a", "b", ["n"], ["m"])._jdf.queryExecution().optimizedPlan().toString()
    # Exact times are compared only where an interval lies in one block.
    assert "Window" in plan and sum("Join" in line and "<= at" in line for line in plan.splitlines()) <= 1


def test_profile_makes_no_row_per_cell(spark):
    df = spark.createDataFrame([(1, "a", None), (1, "b", None), (1, None, 2.0)], "x int, s string, n double")
    profile = {p["feature"]: p for p in constancy.column_profile(df, df.columns)}
    assert [profile[c]["missing"] for c in "xsn"] == [0, 1, 2] and profile["x"]["constant"] and not profile["n"]["constant"]
    assert constancy.column_profile(df.limit(0), df.columns) == []
    assert "explode" not in inspect.getsource(constancy.column_profile)
