"""Queries for exploratory statistics and drift."""

from __future__ import annotations

from pyspark.sql import functions as F

from slotwise.catalog.registry import Registry
from slotwise.catalog.views import silver_airports, silver_flights, table, view
from slotwise.operators.categories import cardinality
from slotwise.operators import sketches
from slotwise.operators.ranks import quantile
from slotwise.plans import drift, explore, gold
from slotwise.plans.splits import with_split
from slotwise.session import persist_table

REGISTRY = Registry()
query = REGISTRY.query

LABELLED = "trips WHERE delay_min IS NOT NULL"


def labelled(spark, sf):
    trips = view(spark, sf, "trips").where("delay_min is not null")
    return trips.withColumn("late", F.col("delay_min") > 15)


def _rates(df, **keys):
    return explore.delay_rates(df, keys, F.col("late"), F.col("delay_min"))


RATE = """round(avg(CASE WHEN delay_min > 15 THEN 1.0 ELSE 0.0 END), 6) AS delay_rate,
  round(avg(delay_min), 6) AS avg_delay_min, count(*) AS rows"""


@query("delay_by_hour", ["trips"], f"SELECT cast(hour(dep_ts) AS bigint) AS hour, {RATE} FROM {LABELLED} GROUP BY 1")
def delay_by_hour(spark, sf):
    return _rates(labelled(spark, sf), hour=F.hour("dep_ts"))


@query("delay_by_dow", ["trips"], f"SELECT cast(isodow(dep_ts) - 1 AS bigint) AS dow, {RATE} FROM {LABELLED} GROUP BY 1")
def delay_by_dow(spark, sf):
    return _rates(labelled(spark, sf), dow=F.weekday("dep_ts"))


@query("daily_trend", ["trips"], f"SELECT epoch_us(date_trunc('day', dep_ts)) AS day, {RATE} FROM {LABELLED} GROUP BY 1")
def daily_trend(spark, sf):
    return _rates(labelled(spark, sf), day=F.date_trunc("day", "dep_ts"))


@query("top_groups_min_support", ["trips"], f"""
SELECT cast(arr AS bigint) AS arr, {RATE} FROM {LABELLED} AND arr IS NOT NULL GROUP BY arr
HAVING count(*) >= 20 ORDER BY avg(CASE WHEN delay_min > 15 THEN 1.0 ELSE 0.0 END) DESC, arr LIMIT 15
""")
def top_groups_min_support(spark, sf):
    return explore.worst_groups(labelled(spark, sf), "arr", F.col("late"), F.col("delay_min"), 20)


@query("supplier_late_lines", None, """
SELECT s_name, round(avg(CASE WHEN l_shipdate > o_orderdate + INTERVAL 60 DAY THEN 1.0 ELSE 0.0 END), 6) AS delay_rate,
  round(avg(date_diff('day', o_orderdate::date, l_shipdate::date)), 6) AS avg_delay_min, count(*) AS rows
FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN supplier ON s_suppkey = l_suppkey
GROUP BY 1 HAVING count(*) >= 20
""")
def supplier_late_lines(spark, sf):
    """Late rate per supplier over all order lines: two large tables and one dimension."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_suppkey", "l_shipdate")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    late = F.col("l_shipdate") > F.col("o_orderdate") + F.expr("INTERVAL 60 DAYS")
    days = F.datediff("l_shipdate", "o_orderdate")
    named = joined.join(table(spark, sf, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    return explore.worst_groups(named, "s_name", late, days, 20, k=None)


@query("distance_bins", ["flights", "airports"], """
WITH x AS (SELECT dep_delay_min > 15 AS late, 100.0::double * (d.latitude_deg - a.latitude_deg) AS v FROM flights f
  JOIN airports d ON d.iata_code = f.dep_iata JOIN airports a ON a.iata_code = f.arr_iata WHERE dep_delay_min IS NOT NULL),
r AS (SELECT min(v) AS lo, max(v) AS hi, (max(v) - min(v)) / 8 AS w FROM x),
b AS (SELECT least(greatest(ceil((v - lo) / w), 1), 8)::bigint AS bin, avg(late::int) AS rate, count(*) AS n FROM x, r GROUP BY 1)
SELECT i AS bin, round(lo + (i - 1) * w, 6) + 0.0 AS low, round(lo + i * w, 6) + 0.0 AS high, round(rate, 6) AS delay_rate,
  coalesce(n, 0) AS rows FROM (SELECT unnest(range(1, 9)) AS i) g CROSS JOIN r LEFT JOIN b ON b.bin = i
""")
def distance_bins(spark, sf):
    rich = gold.enrich_airports(silver_flights(spark, sf), silver_airports(spark, sf))
    rows = rich.where("dep_delay_min is not null").withColumn(
        "north_south", 100.0 * (F.col("dep_latitude") - F.col("arr_latitude"))
    )
    return explore.equal_width_rates(rows, "north_south", F.col("dep_delay_min") > 15)


@query("crosstab_status_target", ["trips"], """
SELECT coalesce(status, 'missing') AS category, count(CASE WHEN delay_min <= 15 THEN 1 END) AS "false",
  count(CASE WHEN delay_min > 15 THEN 1 END) AS "true", count(CASE WHEN delay_min IS NULL THEN 1 END) AS missing
FROM trips GROUP BY 1
""")
def crosstab_status_target(spark, sf):
    trips = view(spark, sf, "trips")
    target = F.coalesce((F.col("delay_min") > 15).cast("string"), F.lit("missing"))
    return explore.crosstab(
        trips, F.coalesce("status", F.lit("missing")), target, ["false", "true", "missing"]
    )


@query("crosstab_margins", ["trips"], """
SELECT CASE WHEN grouping(a) = 1 THEN 'All' ELSE a END AS row_label,
  CASE WHEN grouping(b) = 1 THEN 'All' ELSE b END AS column_label, count(*) AS rows
FROM (SELECT cast(dep < 5 AS varchar) AS a, cast(arr IS NULL AS varchar) AS b FROM trips) q GROUP BY CUBE (a, b)
""")
def crosstab_margins(spark, sf):
    return explore.crosstab_with_margins(view(spark, sf, "trips"), F.col("dep") < 5, F.col("arr").isNull())


@query("missing_target_by_status", ["trips"], """
SELECT status, count(*) - count(delay_min) AS missing_is_delayed FROM trips GROUP BY status
""")
def missing_target_by_status(spark, sf):
    return view(spark, sf, "trips").groupBy("status").agg(
        F.count_if(F.col("delay_min").isNull()).alias("missing_is_delayed")
    )


@query("value_counts", ["trips"], """
SELECT carrier AS value, count(*) AS rows, round(100.0::double * count(*) / (SELECT count(*) FROM trips), 6) AS pct
FROM trips GROUP BY carrier
""")
def value_counts(spark, sf):
    return explore.value_shares(view(spark, sf, "trips"), "carrier")


@query("cardinality", ["trips"], """
WITH x AS (SELECT unnest(['carrier', 'status', 'terminal', 'arr']) AS feature,
  unnest([carrier, status, terminal, arr::varchar]) AS v FROM trips),
c AS (SELECT feature, v, count(*) AS n FROM x GROUP BY 1, 2),
t AS (SELECT feature, v, n, row_number() OVER (PARTITION BY feature ORDER BY n DESC, v) AS rn FROM c WHERE v IS NOT NULL),
s AS (SELECT feature, count(*) AS n_unique, sum(n) AS rows, sum(CASE WHEN v IS NULL THEN n ELSE 0 END) AS missing FROM c GROUP BY 1)
SELECT s.feature, n_unique, round(100.0::double * missing / rows, 2) AS missing_pct, t.v AS top_value,
  round(100.0::double * t.n / (rows - missing), 2) AS top_value_pct FROM s JOIN t ON t.feature = s.feature AND rn = 1
""")
def cardinality_report(spark, sf):
    return cardinality(view(spark, sf, "trips"), ["carrier", "status", "terminal", "arr"])


@query("bool_effect", ["trips"], """
WITH x AS (SELECT unnest(['weekend', 'has_arr', 'terminal_a']) AS feature,
  unnest([isodow(dep_ts) >= 6, arr IS NOT NULL, terminal = 'A']) AS f, delay_min > 15 AS late FROM trips WHERE delay_min IS NOT NULL)
SELECT feature, round(100 * avg(CASE WHEN NOT f THEN late::int END), 6) AS false_rate,
  round(100 * avg(CASE WHEN f THEN late::int END), 6) AS true_rate FROM x GROUP BY feature
""")
def bool_effect(spark, sf):
    rows = labelled(spark, sf).withColumns(
        {
            "weekend": F.weekday("dep_ts") >= 5,
            "has_arr": F.col("arr").isNotNull(),
            "terminal_a": F.col("terminal") == "A",
        }
    )
    return explore.flag_effect(rows, ["weekend", "has_arr", "terminal_a"], F.col("late"))


@query("p95_cut_rates", ["trips"], """
WITH g AS (SELECT k, avg(CASE WHEN delay_min > 15 THEN 1.0 ELSE 0.0 END) AS r, count(*) AS n
  FROM trips WHERE delay_min IS NOT NULL GROUP BY k)
SELECT cast(k AS bigint) AS k, round(r, 6) AS delay_rate, n AS rows FROM g
WHERE k <= (SELECT quantile_cont(k, 0.95) FROM g)
""")
def p95_cut_rates(spark, sf):
    return explore.rates_up_to_quantile(labelled(spark, sf), "k", F.col("late"))


@query("rates_up_to_limit", ["trips"], """
SELECT cast(coalesce(arr, 0) AS bigint) AS arr_fill, round(avg(CASE WHEN delay_min > 15 THEN 1.0 ELSE 0.0 END), 6) AS delay_rate,
  count(*) AS rows FROM trips WHERE delay_min IS NOT NULL GROUP BY 1 HAVING coalesce(arr, 0) <= 20
""".replace("HAVING coalesce(arr, 0) <= 20", "HAVING arr_fill <= 20"))
def rates_up_to_limit(spark, sf):
    filled = F.coalesce("arr", F.lit(0))
    return explore.rates_up_to(labelled(spark, sf), filled, "arr_fill", F.col("late"), 20)


@query("corr_target", ["trips"], """
WITH x AS (SELECT unnest(['value', 'k', 'arr', 'dep']) AS feature,
  unnest([value, k::double, arr::double, dep::double]) AS v, (delay_min > 15)::int AS y, delay_min AS m
  FROM trips WHERE delay_min IS NOT NULL)
SELECT feature, valid_rows, round(with_late, 6) AS with_late, round(with_minutes, 6) AS with_minutes,
  round(coalesce(top / 40000 * list_sum(list_transform(range(40000), lambda i: pow(cos(asin(abs(with_late)) + (i + 0.5) * top / 40000), valid_rows - 3)))
    / (sqrt(pi()) / 2 * exp(lgamma((valid_rows - 2) / 2.0) - lgamma((valid_rows - 1) / 2.0))), 0.0), 6) AS with_late_p
FROM (SELECT *, greatest(least(pi() / 2, 12 / sqrt(valid_rows - 3.0::double)) - asin(abs(with_late)), 0) AS top FROM (
  SELECT feature, count(v) AS valid_rows, corr(v, y) AS with_late, corr(v, m) AS with_minutes
  FROM x WHERE v IS NOT NULL GROUP BY feature HAVING count(v) >= 20) q) q
""")
def corr_target(spark, sf):
    rows = labelled(spark, sf)
    targets = {"with_late": F.col("late").cast("int"), "with_minutes": F.col("delay_min")}
    return explore.correlations(rows, ["value", "k", "arr", "dep"], targets, p_values=["with_late"])


@query("corr_matrix", None, """
SELECT unnest(['l_quantity','l_quantity','l_quantity','l_extendedprice','l_extendedprice','l_discount']) AS a,
  unnest(['l_extendedprice','l_discount','l_tax','l_discount','l_tax','l_tax']) AS b,
  unnest([round(corr(l_quantity, l_extendedprice), 6), round(corr(l_quantity, l_discount), 6),
    round(corr(l_quantity, l_tax), 6), round(corr(l_extendedprice, l_discount), 6),
    round(corr(l_extendedprice, l_tax), 6), round(corr(l_discount, l_tax), 6)]) AS r FROM lineitem
""")
def corr_matrix(spark, sf):
    return explore.correlation_matrix(
        table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    )


@query("top_correlations", None, """
SELECT b AS feature, r FROM (SELECT unnest(['l_quantity','l_discount','l_tax','l_linenumber']) AS b,
  unnest([round(corr(l_extendedprice, l_quantity), 6), round(corr(l_extendedprice, l_discount), 6),
   round(corr(l_extendedprice, l_tax), 6), round(corr(l_extendedprice, l_linenumber), 6)]) AS r FROM lineitem) q
ORDER BY abs(r) DESC, b LIMIT 25
""")
def top_correlations(spark, sf):
    items = table(spark, sf, "lineitem")
    names = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]
    found = explore.correlations(items, names, {"r": F.col("l_extendedprice")})
    return found.select("feature", "r").orderBy(F.desc(F.abs("r")), "feature").limit(25)


@query("describe_numeric", ["trips"], """
WITH x AS (SELECT unnest(['value', 'delay_min', 'arr']) AS feature, unnest([value, delay_min::double, arr::double]) AS v FROM trips)
SELECT feature, count(v) AS count, round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS std, min(v) AS min, max(v) AS max,
  round(100.0::double * (count(*) - count(v)) / count(*), 6) AS missing_pct, round(quantile_cont(v, 0.25), 6) AS q25,
  round(quantile_cont(v, 0.5), 6) AS q50, round(quantile_cont(v, 0.75), 6) AS q75 FROM x GROUP BY feature
""")
def describe_numeric(spark, sf):
    return explore.describe(view(spark, sf, "trips"), ["value", "delay_min", "arr"])


@query("price_histogram", None, """
WITH x AS (SELECT CASE WHEN o_totalprice = 600000 THEN 30 ELSE floor(o_totalprice / 20000) + 1 END AS bin FROM orders)
SELECT cast(bin AS bigint) AS bin, count(*) AS rows FROM x WHERE bin BETWEEN 1 AND 30 GROUP BY 1
""")
def price_histogram(spark, sf):
    return explore.fixed_histogram(table(spark, sf, "orders"), F.col("o_totalprice"), 0.0, 600000.0, 30)


@query("table_profile", ["trips"], """
SELECT count(*) AS rows, cast(11 AS bigint) AS columns, epoch_us(min(dep_ts)) AS time_min, epoch_us(max(dep_ts)) AS time_max FROM trips
""")
def table_profile(spark, sf):
    return explore.table_profile(view(spark, sf, "trips"), "dep_ts")


@query("feature_report", ["trips"], """
SELECT unnest(['carrier', 'delay_min']) AS feature, unnest(['string', 'int']) AS dtype,
  unnest([(SELECT count(*) FROM (SELECT DISTINCT carrier FROM trips) q), (SELECT count(*) FROM (SELECT DISTINCT delay_min FROM trips) q)]) AS n_unique,
  unnest([(SELECT count(*) - count(carrier) FROM trips), (SELECT count(*) - count(delay_min) FROM trips)]) AS missing
""")
def feature_report(spark, sf):
    trips = view(spark, sf, "trips")
    names = ["carrier", "delay_min"]
    kinds = F.create_map(*[F.lit(x) for c, k in trips.dtypes if c in names for x in (c, k)])
    missing = explore.missing_profile(trips, names, only_missing=False)
    distinct = cardinality(trips, names).select("feature", "n_unique")
    return missing.join(distinct, "feature").select(
        "feature", F.element_at(kinds, F.col("feature")).alias("dtype"), "n_unique", "missing"
    )


# --------------------------------------------------------------------- drift
def split_rows(spark, sf):
    return with_split(labelled(spark, sf), "dep_ts")


SPLIT = """l AS (SELECT * FROM trips WHERE delay_min IS NOT NULL),
cut AS (SELECT dep_ts AS c FROM l ORDER BY dep_ts LIMIT 1 OFFSET (SELECT cast(floor(count(*) * 0.8) AS bigint) FROM l)),
s AS (SELECT l.*, CASE WHEN dep_ts < (SELECT c FROM cut) THEN 'train' ELSE 'test' END AS split FROM l)"""


@query("split_summary", ["trips"], f"""
WITH {SPLIT} SELECT split, count(*) AS rows, round(avg(CASE WHEN delay_min > 15 THEN 1.0 ELSE 0.0 END), 6) AS delay_rate,
  round(avg(delay_min), 6) AS avg_delay_min, round(median(delay_min), 6) AS median_delay_min FROM s GROUP BY split
""")
def split_summary(spark, sf):
    return drift.split_summary(split_rows(spark, sf), "split", "late", "delay_min")


@query("ks_drift", ["trips"], f"""
WITH {SPLIT}, x AS (SELECT split, unnest(['value', 'k', 'arr']) AS feature, unnest([value, k::double, arr::double]) AS v FROM s),
c AS (SELECT feature, v, count(*) FILTER (split = 'train') AS a, count(*) FILTER (split = 'test') AS b FROM x WHERE v IS NOT NULL GROUP BY 1, 2),
e AS (SELECT feature, sum(a) OVER w / sum(a) OVER p AS fa, sum(b) OVER w / sum(b) OVER p AS fb FROM c
  WINDOW w AS (PARTITION BY feature ORDER BY v), p AS (PARTITION BY feature)),
m AS (SELECT feature, avg(v) FILTER (split = 'train') AS ma, avg(v) FILTER (split = 'test') AS mb,
  median(v) FILTER (split = 'train') AS da, median(v) FILTER (split = 'test') AS db,
  count(v) FILTER (split = 'train') AS na, count(v) FILTER (split = 'test') AS nb FROM x GROUP BY feature)
SELECT feature, round(ma, 6) AS train_mean, round(mb, 6) AS test_mean, round(mb - ma, 6) AS mean_diff,
  round(da, 6) AS train_median, round(db, 6) AS test_median, round(ks, 6) AS ks_stat,
  round(CASE WHEN z < 0.05 THEN 1.0 ELSE least(1.0, greatest(0.0, list_sum(list_transform(range(1, 101),
    lambda i: (CASE WHEN i % 2 = 1 THEN 2.0 ELSE -2.0 END) * exp(-2.0::double * i * i * z * z))))) END, 6) AS ks_p_value,
  na AS train_rows, nb AS test_rows FROM (SELECT m.*, ks, sqrt(na * nb / (na + nb)::double) * ks AS z
  FROM m JOIN (SELECT feature, max(abs(fa - fb)) AS ks FROM e GROUP BY 1) e ON e.feature = m.feature) q
""")
def ks_drift(spark, sf):
    return drift.numeric_drift(split_rows(spark, sf), ["value", "k", "arr"], "split", "train", "test")


@query("ks_by_route", ["trips"], f"""
WITH {SPLIT},
c AS (SELECT dep, arr, delay_min AS v, count(*) FILTER (split = 'train') AS a, count(*) FILTER (split = 'test') AS b FROM s GROUP BY ALL),
e AS (SELECT dep, arr, sum(a) OVER w AS ca, sum(b) OVER w AS cb, sum(a) OVER p AS n, sum(b) OVER p AS m FROM c
  WINDOW w AS (PARTITION BY dep, arr ORDER BY v), p AS (PARTITION BY dep, arr)),
g AS (SELECT dep, arr, n::bigint AS n, m::bigint AS m, max(abs(ca / n - cb / m)) AS ks FROM e WHERE n > 0 AND m > 0 GROUP BY ALL),
k AS (SELECT *, round(ks * n * m)::bigint AS h FROM g WHERE greatest(n, m) <= 100),
r AS (WITH RECURSIVE q AS (SELECT dep, arr, n, m, h, 0::bigint AS i, list_transform(range(m + 1), lambda j: CASE WHEN j * n < h THEN 1.0::double ELSE 0.0::double END) AS row FROM k
  UNION ALL SELECT dep, arr, n, m, h, i + 1, list_transform(range(m + 1), lambda j: CASE WHEN abs((i + 1) * m - j * n) < h
    THEN coalesce(list_sum(row[greatest(0, floor(((i + 1) * m - h) / n)::bigint + 1) + 1 : j + 1]), 0.0)::double ELSE 0.0::double END) FROM q WHERE i < n)
  SELECT * FROM q WHERE i = n),
z AS (SELECT *, sqrt(n * m / (n + m)::double) * ks AS z FROM g)
SELECT z.dep::bigint AS dep, z.arr::bigint AS arr, round(z.ks, 6) AS ks_stat, round(CASE WHEN r.n IS NOT NULL THEN greatest(0.0,
    1 - r.row[-1] / list_product(list_transform(range(1, z.n + 1), lambda i: (z.m + i)::double / i)))
  WHEN z < 0.05 THEN 1.0 ELSE least(1.0, greatest(0.0, list_sum(list_transform(range(1, 101),
    lambda i: (CASE WHEN i % 2 = 1 THEN 2.0 ELSE -2.0 END) * exp(-2.0::double * i * i * z * z))))) END, 6) AS ks_p_value,
  z.n AS train_rows, z.m AS test_rows, (r.n IS NOT NULL)::int::bigint AS exact
FROM z LEFT JOIN r ON r.dep = z.dep AND r.arr IS NOT DISTINCT FROM z.arr
""")
def ks_by_route(spark, sf):
    """Whether delays of a route differ between the periods, exact for small routes."""
    return drift.ks_by_group(split_rows(spark, sf), ["dep", "arr"], "delay_min", "split", "train", "test")


@query("tvd_shift", ["trips"], f"""
WITH {SPLIT}, x AS (SELECT split, unnest(['carrier', 'arr', 'event_day']) AS feature,
  unnest([carrier, arr::varchar, dep_ts::date::varchar]) AS v FROM s),
c AS (SELECT feature, v, count(*) FILTER (split = 'train') AS a, count(*) FILTER (split = 'test') AS b FROM x GROUP BY 1, 2),
t AS (SELECT feature, sum(a) AS ta, sum(b) AS tb FROM c GROUP BY 1)
SELECT c.feature, count(*) FILTER (a > 0) AS n_train_categories, count(*) FILTER (b > 0) AS n_test_categories,
  count(*) FILTER (a = 0 AND b > 0) AS unseen_categories_in_test, round(sum(abs(a / ta - b / tb)) / 2, 6) AS total_variation_distance
FROM c JOIN t ON t.feature = c.feature GROUP BY c.feature
""")
def tvd_shift(spark, sf):
    rows = split_rows(spark, sf).withColumn("event_day", F.to_date("dep_ts").cast("string"))
    return drift.categorical_shift(rows, ["carrier", "arr", "event_day"], "split", "train", "test")


@query("unseen_categories", ["trips"], f"""
WITH {SPLIT} SELECT DISTINCT cast(dep_ts::date AS varchar) AS day FROM s WHERE split = 'test'
  AND dep_ts::date NOT IN (SELECT dep_ts::date FROM s WHERE split = 'train')
""")
def unseen_categories(spark, sf):
    rows = split_rows(spark, sf).withColumn("day", F.to_date("dep_ts").cast("string"))
    return drift.unseen_categories(rows.where("split = 'train'"), rows.where("split = 'test'"), "day")


@query("exact_quantiles", None, """
SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.9), 6) AS quantile FROM lineitem GROUP BY 1
""")
def exact_quantiles(spark, sf):
    return quantile(table(spark, sf, "lineitem"), ["l_returnflag"], "l_extendedprice", 0.9)


@query("sketched_quantiles", None, """
SELECT l_returnflag, count(*) AS rows, 1::bigint AS median_close, 1::bigint AS p95_close, 1::bigint AS orders_close FROM lineitem
WHERE l_shipdate::date >= DATE '1995-01-01' GROUP BY 1
""")
def sketched_quantiles(spark, sf):
    """Day sketches of the prices and orders, merged from 1995 on, and whether they keep twice their
    error bounds of the exact shares and counts."""
    lines = table(spark, sf, "lineitem")
    stored = persist_table(
        sketches.daily_sketches(lines, ["l_returnflag"], "l_shipdate", ["l_extendedprice"], ["l_orderkey"]), "sketches"
    )
    # One row per flag goes to all tasks: lines dealt out by flag would be three tasks' work.
    found = persist_table(
        sketches.answers(sketches.merged(stored, ["l_returnflag"], first=9131), {"p50": 0.5, "p95": 0.95}), "quantiles"
    )
    late = lines.where(F.to_date("l_shipdate") >= F.lit("1995-01-01").cast("date"))
    price = F.col("l_extendedprice")

    def shares(name):
        at = F.col(f"l_extendedprice_{name}")
        return [F.count_if(price < at).alias(f"{name}_under"), F.count_if(price <= at).alias(f"{name}_upto")]

    exact = late.join(F.broadcast(found), "l_returnflag").groupBy("l_returnflag", "rows", "l_extendedprice_n", "l_orderkey_distinct").agg(
        *shares("p50"), *shares("p95"), F.count_distinct("l_orderkey").alias("orders")
    )
    slack = F.lit(2 * sketches.rank_error()) * F.col("l_extendedprice_n")

    def close(name, p):
        wanted = F.lit(p) * F.col("l_extendedprice_n")
        return ((F.col(f"{name}_under") - slack <= wanted) & (wanted <= F.col(f"{name}_upto") + slack)).alias(f"{'median' if name == 'p50' else name}_close")

    off = F.abs(F.col("l_orderkey_distinct") - F.col("orders"))
    return exact.select(
        "l_returnflag", "rows", close("p50", 0.5), close("p95", 0.95),
        (off <= 4 * sketches.distinct_error() * F.col("orders")).alias("orders_close"),
    )
