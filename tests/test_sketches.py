"""Sketches of single days, merged, against exact ranks and counts."""

import random
from datetime import datetime, timedelta

from slotwise.catalog import explorations
from slotwise.operators.sketches import answers, daily_sketches, distinct_error, merged, rank_error
from slotwise.session import persist_table

FIRST = 20000
WANTED = {"p05": 0.05, "p50": 0.5, "p95": 0.95}


def test_merged_days_stay_within_their_bounds(spark):
    rng = random.Random(1)
    start = datetime(1970, 1, 1) + timedelta(days=FIRST)
    data = [
        ("hot" if i % 3 else f"g{i % 7}", start + timedelta(days=rng.randrange(20), minutes=i % 1440),
         rng.choice([float(rng.randrange(40)), rng.gauss(0, 1e6), None, float("nan")]), f"k{rng.randrange(3000)}")
        for i in range(30000)
    ]
    df = spark.createDataFrame(data, "g string, ts timestamp, v double, k string").repartition(7)
    stored = persist_table(daily_sketches(df, ["g"], "ts", ["v"], ["k"]), "sketches")
    assert stored.count() == len({(r[0], r[1].date()) for r in data})
    for first, last in ((None, None), (FIRST + 3, FIRST + 9), (FIRST + 4, FIRST + 4)):
        got = {r["g"]: r for r in answers(merged(stored, ["g"], first, last), WANTED).collect()}
        for g, row in got.items():
            days = lambda r: (r[1] - datetime(1970, 1, 1)).days
            rows = [r for r in data if r[0] == g and (first is None or first <= days(r) <= last)]
            known = [r[2] for r in rows if r[2] is not None and r[2] == r[2]]
            assert row["rows"] == len(rows) and row["v_n"] == len(known)
            for name, p in WANTED.items():
                found = row[f"v_{name}"]
                under, upto = (sum(f(v) for v in known) / len(known) for f in (found.__gt__, found.__ge__))
                slack = 2 * rank_error() + 1 / len(known)
                assert under - slack <= p <= upto + slack, (g, name)
            exact = len({r[3] for r in rows})
            assert abs(row["k_distinct"] - exact) <= max(2, 4 * distinct_error() * exact)


def test_groups_without_values_and_empty_tables(spark):
    at = datetime(2024, 1, 1)
    df = spark.createDataFrame([("a", at, None, None), ("b", None, 1.5, "x")], "g string, ts timestamp, v double, k string")
    out = answers(merged(daily_sketches(df, ["g"], "ts", ["v"], ["k"]), ["g"]), {"p50": 0.5}).orderBy("g").collect()
    assert [tuple(r) for r in out] == [("a", 1, 0, None, 0), ("b", 1, 1, 1.5, 1)]
    assert answers(merged(daily_sketches(df.limit(0), ["g"], "ts", ["v"], ["k"]), ["g"]), {"p50": 0.5}).collect() == []


def test_lines_are_not_dealt_out_by_their_few_flags(spark):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = explorations.sketched_quantiles(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
