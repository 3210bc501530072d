"""Queries for splits, evaluation of scored rows, search and scoring rules."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from slotwise.catalog.registry import Registry
from slotwise.catalog.views import silver_flights, table, view
from slotwise.functions import rules
from slotwise.operators.ranks import dense_index, median
from slotwise.plans import evaluate, explore, models, scoring, splits
from slotwise.plans.fills import ExactFills
from slotwise.plans.search_index import SearchIndex
from slotwise.session import new_work_dir
from slotwise.sources.numbered import NumberedTable

REGISTRY = Registry()
query = REGISTRY.query


def scored(spark, sf):
    return view(spark, sf, "scored")


def ordered(spark, sf):
    return scored(spark, sf).withColumn("at", F.unix_micros("dep_ts"))


# -------------------------------------------------------------------- splits
@query("chrono_split", None, """
WITH o AS (SELECT o_orderkey, o_orderdate FROM orders),
c AS (SELECT o_orderdate AS c FROM o ORDER BY o_orderdate LIMIT 1 OFFSET (SELECT cast(floor(count(*) * 0.8) AS bigint) FROM o))
SELECT o_orderkey, CASE WHEN o_orderdate < (SELECT c FROM c) THEN 'train' ELSE 'test' END AS split FROM o
""")
def chrono_split(spark, sf):
    """Orders by date: many rows share a time, and those stay together."""
    return splits.with_split(table(spark, sf, "orders"), "o_orderdate").select("o_orderkey", "split")


@query("positional_split", None, """
SELECT o_orderkey, CASE WHEN rn <= floor(n * 0.8) THEN 'train' ELSE 'valid' END AS split FROM (
  SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS rn, count(*) OVER () AS n FROM orders) q
""")
def positional_split(spark, sf):
    rows = table(spark, sf, "orders").select(
        "o_orderkey", F.unix_micros(F.col("o_orderdate").cast("timestamp")).alias("at")
    )
    early, late = splits.positional_split(rows, "at", "o_orderkey")
    tag = lambda df, name: df.select("o_orderkey", F.lit(name).alias("split"))
    return tag(early, "train").unionByName(tag(late, "valid"))


@query("ts_cv_folds", ["scored"], """
SELECT event_id, cast(greatest(0, ceil((rn - (n - 4 * (n // 5))) / (n // 5)::double)) AS bigint) AS fold
FROM (SELECT event_id, row_number() OVER (ORDER BY dep_ts, event_id) AS rn, count(*) OVER () AS n FROM scored) q
""")
def ts_cv_folds(spark, sf):
    return splits.expanding_folds(ordered(spark, sf), "at", "event_id", 4).select("event_id", "fold")


@query("dense_row_index", ["scored"], """
SELECT event_id, count(*) OVER () AS n FROM scored
""")
def dense_row_index(spark, sf):
    """Rows numbered without a gap: every number from 0 to n-1 once."""
    numbered = dense_index(scored(spark, sf).withColumn("h", F.xxhash64("event_id")), "h", "i")
    ends = numbered.agg(F.max("i").alias("hi"), F.count_distinct("i").alias("d"))
    n = ends.select(F.when(F.col("hi") + 1 == F.col("d"), F.col("d")).otherwise(-1)).scalar()
    return numbered.select("event_id", n.alias("n"))


# --------------------------------------------------------------------- fills
@query("fitted_fills", None, """
WITH r AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE l_extendedprice END AS price,
  CASE WHEN l_suppkey % 5 = 0 THEN NULL ELSE l_quantity END AS quantity, CASE WHEN l_partkey % 3 = 0 THEN NULL ELSE l_returnflag END AS flag,
  l_shipdate FROM lineitem), f AS (SELECT * FROM r WHERE l_shipdate < TIMESTAMP '1996-01-01'),
m AS (SELECT median(price) AS price, median(quantity) AS quantity FROM f),
w AS (SELECT flag FROM f WHERE flag IS NOT NULL GROUP BY flag ORDER BY count(*) DESC, flag LIMIT 1)
SELECT l_orderkey, cast(l_linenumber AS bigint) AS l_linenumber, round(coalesce(r.price, m.price), 6) AS price, round(coalesce(r.quantity, m.quantity), 6) AS quantity,
  coalesce(r.flag, w.flag) AS flag FROM r, m, w
""")
def fitted_fills(spark, sf):
    """Medians and most frequent values of the early lines, saved, loaded and applied to all lines."""
    rows = table(spark, sf, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_shipdate", "CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE l_extendedprice END AS price",
        "CASE WHEN l_suppkey % 5 = 0 THEN NULL ELSE l_quantity END AS quantity",
        "CASE WHEN l_partkey % 3 = 0 THEN NULL ELSE l_returnflag END AS flag",
    )
    stage = ExactFills(numeric=["price", "quantity"], categorical=["flag"])
    path = new_work_dir(spark, "fills")
    Pipeline(stages=[stage]).fit(rows.where("l_shipdate < TIMESTAMP '1996-01-01'")).save(path)
    filled = PipelineModel.load(path).transform(rows)
    return filled.selectExpr(
        "l_orderkey", "l_linenumber", "price__num AS price", "quantity__num AS quantity", "flag__cat AS flag"
    )


# ------------------------------------------------------------------- metrics
@query("confusion", ["scored"], """
WITH c AS (SELECT event_type AS model, count(*) FILTER (y = 0 AND p < 0.5) AS tn, count(*) FILTER (y = 0 AND p >= 0.5) AS fp,
  count(*) FILTER (y = 1 AND p < 0.5) AS fn, count(*) FILTER (y = 1 AND p >= 0.5) AS tp
  FROM scored JOIN (SELECT event_id AS e, event_type FROM trips) t ON t.e = event_id GROUP BY 1)
SELECT *, round(fp / (fp + tn)::double, 6) AS false_positive_rate, round(fn / (fn + tp)::double, 6) AS false_negative_rate FROM c
""")
def confusion(spark, sf):
    types = view(spark, sf, "trips").select("event_id", F.col("event_type").alias("model"))
    rows = scored(spark, sf).join(types, "event_id")
    return evaluate.confusion(rows, (F.col("p") >= 0.5).cast("int"), ["model"])


SWEEP = """g AS (SELECT i, 0.05e0 + i * ((0.95e0 - 0.05e0) / 180) AS t FROM (SELECT unnest(range(0, 181)) AS i) q),
c AS (SELECT i, t, count(*) FILTER (p >= t) AS pp, count(*) FILTER (p >= t AND y = 1) AS tp,
  count(*) FILTER (y = 1) AS pos, count(*) AS n FROM scored, g GROUP BY i, t),
sweep AS (SELECT i, t, CASE WHEN pp = 0 THEN 0 ELSE tp / pp::double END AS pr,
  CASE WHEN pos = 0 THEN 0 ELSE tp / pos::double END AS re,
  CASE WHEN pp + pos = 0 THEN 0 ELSE 2 * tp / (pp + pos)::double END AS f1, pp, pp / n::double AS rate, tp, pp - tp AS fp, pos - tp AS fn FROM c)"""
SWEEP_COLUMNS = """cast(i AS bigint) AS threshold_index, round(t, 6) AS threshold, round(pr, 6) AS precision, round(re, 6) AS recall,
  round(f1, 6) AS f1, pp AS predicted_positive_count, round(rate, 6) AS predicted_positive_rate,
  tp AS true_positive_count, fp AS false_positive_count, fn AS false_negative_count"""


@query("threshold_sweep", ["scored"], f"WITH {SWEEP} SELECT {SWEEP_COLUMNS} FROM sweep")
def threshold_sweep(spark, sf):
    return evaluate.threshold_sweep(scored(spark, sf))


@query("best_threshold", ["scored"], f"""WITH {SWEEP} SELECT {SWEEP_COLUMNS} FROM sweep
WHERE re >= 0.25 AND rate >= 0.03 ORDER BY pr DESC, re DESC, f1 DESC, rate DESC, i LIMIT 1""")
def best_threshold(spark, sf):
    return evaluate.top_thresholds(evaluate.threshold_sweep(scored(spark, sf)), 1)


@query("top_thresholds", ["scored"], f"""WITH {SWEEP} SELECT {SWEEP_COLUMNS} FROM sweep
WHERE re >= 0.25 AND rate >= 0.03 ORDER BY pr DESC, re DESC, f1 DESC, rate DESC, i LIMIT 10""")
def top_thresholds(spark, sf):
    return evaluate.top_thresholds(evaluate.threshold_sweep(scored(spark, sf)), 10)


RANKING = """u AS (SELECT p, count(*) AS n, sum(y) AS pos FROM scored GROUP BY p),
r AS (SELECT p, n, pos, sum(n) OVER d AS cn, sum(pos) OVER d AS cp, sum(pos) OVER () AS tp, sum(n) OVER () AS tn FROM u
  WINDOW d AS (ORDER BY p DESC)),
m AS (SELECT sum((n - pos)::double * (cp - pos / 2.0::double)) / (max(tp)::double * (max(tn) - max(tp))) AS roc_auc,
  sum(pos / tp::double * (cp / cn::double)) AS pr_auc FROM r)"""


@query("roc_auc", ["scored"], f"WITH {RANKING} SELECT round(roc_auc, 6) AS roc_auc FROM m")
def roc_auc(spark, sf):
    return evaluate.ranking_metrics(scored(spark, sf)).select("roc_auc")


@query("avg_precision", ["scored"], f"WITH {RANKING} SELECT round(pr_auc, 6) AS pr_auc FROM m")
def avg_precision(spark, sf):
    return evaluate.ranking_metrics(scored(spark, sf)).select("pr_auc")


@query("classifier_metrics", ["scored"], f"""
WITH {RANKING}, c AS (SELECT count(*) FILTER (y = 0 AND p < 0.6) AS tn, count(*) FILTER (y = 0 AND p >= 0.6) AS fp,
  count(*) FILTER (y = 1 AND p < 0.6) AS fn, count(*) FILTER (y = 1 AND p >= 0.6) AS tp, avg((p - y) * (p - y)) AS brier FROM scored)
SELECT 0.6e0 AS threshold, round(roc_auc, 6) AS roc_auc, round(pr_auc, 6) AS pr_auc,
  round((tp + tn) / (tp + tn + fp + fn)::double, 6) AS accuracy, round(tp / (tp + fp)::double, 6) AS precision,
  round(tp / (tp + fn)::double, 6) AS recall, round(2 * tp / (2 * tp + fp + fn)::double, 6) AS f1, round(brier, 6) AS brier,
  tn, fp, fn, tp FROM c, m
""")
def classifier_metrics(spark, sf):
    return evaluate.classifier_metrics(scored(spark, sf), 0.6)


# The score, what it leaves to one, the minutes as a score and the same answer for all rows.
STACKED = """s AS (SELECT 'score' AS model, y, p FROM scored UNION ALL SELECT 'complement', y, 1 - p FROM scored
  UNION ALL SELECT 'minutes', y, pred_min / 120 FROM scored UNION ALL SELECT 'constant', y, 0.0e0 FROM scored),
u AS (SELECT model, p, count(*) AS n, sum(y) AS pos FROM s GROUP BY model, p),
r AS (SELECT model, p, n, pos, sum(n) OVER d AS cn, sum(pos) OVER d AS cp, sum(pos) OVER g AS tp, sum(n) OVER g AS tn FROM u
  WINDOW d AS (PARTITION BY model ORDER BY p DESC), g AS (PARTITION BY model)),
m AS (SELECT model, sum((n - pos)::double * (cp - pos / 2.0::double)) / (max(tp)::double * (max(tn) - max(tp))) AS roc_auc,
  sum(pos / tp::double * (cp / cn::double)) AS pr_auc FROM r GROUP BY model),
c AS (SELECT model, count(*) FILTER (y = 0 AND p < 0.5) AS tn, count(*) FILTER (y = 0 AND p >= 0.5) AS fp,
  count(*) FILTER (y = 1 AND p < 0.5) AS fn, count(*) FILTER (y = 1 AND p >= 0.5) AS tp, avg((p - y) * (p - y)) AS brier
  FROM s GROUP BY model)"""


@query("leaderboard", ["scored"], f"""WITH {STACKED}
SELECT model, 'baseline' AS stage, 0.5e0 AS threshold, round(roc_auc, 6) AS roc_auc, round(pr_auc, 6) AS pr_auc,
  round((tp + tn) / (tp + tn + fp + fn)::double, 6) AS accuracy,
  CASE WHEN tp + fp = 0 THEN 0 ELSE round(tp / (tp + fp)::double, 6) END AS precision, round(tp / (tp + fn)::double, 6) AS recall,
  round(2 * tp / (2 * tp + fp + fn)::double, 6) AS f1, round(brier, 6) AS brier, tn, fp, fn, tp FROM c JOIN m USING (model)""")
def leaderboard(spark, sf):
    """Four ways to score the same rows, compared from one aggregation."""
    rows = scored(spark, sf)
    ways = {"score": F.col("p"), "complement": 1 - F.col("p"), "minutes": F.col("pred_min") / 120, "constant": F.lit(0.0)}
    return models.leaderboard({name: rows.select("y", p.alias("p")) for name, p in ways.items()}, "baseline")


@query("regressor_leaderboard", ["scored"], """
WITH l AS (SELECT minutes, pred_min FROM scored WHERE y = 1), k AS (SELECT median(minutes) AS middle FROM l),
s AS (SELECT 'minutes' AS model, minutes, pred_min FROM l UNION ALL SELECT 'halved', minutes, pred_min / 2 FROM l
  UNION ALL SELECT 'Dummy median', minutes, middle FROM l, k)
SELECT model, 'baseline' AS stage, count(*) AS rows, round(avg(abs(pred_min - minutes)), 6) AS mae,
  round(sqrt(avg(pow(pred_min - minutes, 2))), 6) AS rmse,
  round(1 - sum(pow(pred_min - minutes, 2)) / sum(pow(minutes - m, 2)), 6) AS r2,
  round(median(abs(pred_min - minutes)), 6) AS median_absolute_error
FROM (SELECT *, avg(minutes) OVER (PARTITION BY model) AS m FROM s) q GROUP BY model
""")
def regressor_leaderboard(spark, sf):
    late = scored(spark, sf).where("y = 1").select("minutes", "pred_min")
    ways = {"minutes": late, "halved": late.withColumn("pred_min", F.col("pred_min") / 2)}
    middle = median(late, [], "minutes").select("median").scalar()
    return models.regressor_leaderboard({**ways, "Dummy median": late.withColumn("pred_min", middle)}, "baseline")


@query("regression_metrics", ["scored"], """
SELECT carrier, count(*) AS rows, round(avg(abs(pred_min - minutes)), 6) AS mae, round(sqrt(avg(pow(pred_min - minutes, 2))), 6) AS rmse,
  round(1 - sum(pow(pred_min - minutes, 2)) / sum(pow(minutes - m, 2)), 6) AS r2,
  round(median(abs(pred_min - minutes)), 6) AS median_absolute_error
FROM (SELECT *, avg(minutes) OVER (PARTITION BY carrier) AS m FROM scored WHERE y = 1 AND carrier IS NOT NULL) q GROUP BY carrier
""")
def regression_metrics(spark, sf):
    late = scored(spark, sf).where("y = 1 and carrier is not null")
    return evaluate.regression_metrics(late, ["carrier"])


@query("two_stage_metrics", ["scored"], """
SELECT count(*) AS test_rows, count(*) FILTER (y = 1) AS actual_delayed_rows, count(*) FILTER (y = 1 AND p >= 0.5) AS passed_rows,
  round(count(*) FILTER (y = 1 AND p >= 0.5) / count(*) FILTER (y = 1)::double, 6) AS coverage,
  round(avg(abs(pred_min - minutes)) FILTER (y = 1 AND p >= 0.5), 6) AS covered_mae,
  round(avg(abs(CASE WHEN p >= 0.5 THEN pred_min ELSE 0 END - minutes)) FILTER (y = 1), 6) AS two_stage_mae FROM scored
""")
def two_stage_metrics(spark, sf):
    return evaluate.two_stage_metrics(scored(spark, sf), 0.5)


@query("two_stage_output", ["scored"], """
SELECT event_id, cast(p >= 0.5 AS bigint) AS predicted, CASE WHEN p >= 0.5 THEN pred_min ELSE 0 END AS minutes FROM scored
""")
def two_stage_output(spark, sf):
    predicted = (F.col("p") >= 0.5).cast("int")
    return scored(spark, sf).select(
        "event_id", predicted.alias("predicted"),
        rules.two_stage_minutes(predicted, F.col("pred_min")).alias("minutes"),
    )


@query("class_report", ["scored"], """
WITH x AS (SELECT y, (p >= 0.5)::int AS q FROM scored)
SELECT cast(l AS bigint) AS label, round(count(*) FILTER (y = l AND q = l) / count(*) FILTER (q = l)::double, 6) AS precision,
  round(count(*) FILTER (y = l AND q = l) / count(*) FILTER (y = l)::double, 6) AS recall,
  round(2 * count(*) FILTER (y = l AND q = l) / (count(*) FILTER (q = l) + count(*) FILTER (y = l))::double, 6) AS f1,
  count(*) FILTER (y = l) AS support FROM x, (VALUES (0), (1)) v(l) GROUP BY l
""")
def class_report(spark, sf):
    return evaluate.class_report(scored(spark, sf), F.col("p") >= 0.5)


@query("error_types", ["scored"], """
SELECT CASE WHEN y = 1 AND p < 0.5 THEN 'false_negative' WHEN y = 0 AND p >= 0.5 THEN 'false_positive' ELSE 'correct' END AS error_type,
  count(*) AS rows FROM scored GROUP BY 1
""")
def error_types(spark, sf):
    errors = scoring.error_table(scored(spark, sf), 0.5)
    return errors.groupBy("error_type").agg(F.count(F.lit(1)).alias("rows"))


@query("worst_errors", ["scored"], """
SELECT event_id, p FROM scored WHERE y = 1 AND p < 0.5 ORDER BY p DESC, event_id LIMIT 20
""")
def worst_errors(spark, sf):
    errors = scoring.error_table(scored(spark, sf), 0.5)
    return scoring.worst_errors(errors, "false_negative", "event_id").select("event_id", "p")


@query("worst_residuals", ["scored"], """
SELECT event_id, pred_min - minutes AS residual_min, abs(pred_min - minutes) AS absolute_error_min FROM scored WHERE y = 1
ORDER BY 3 DESC, event_id LIMIT 20
""")
def worst_residuals(spark, sf):
    late = scoring.regression_errors(scored(spark, sf).where("y = 1"))
    return late.select("event_id", "residual_min", "absolute_error_min").orderBy(
        F.desc("absolute_error_min"), "event_id"
    ).limit(20)


@query("score_histogram", ["scored"], """
SELECT cast(y AS bigint) AS y, cast(least(floor(p * 29) + 1, 29) AS bigint) AS bin, count(*) AS rows FROM scored GROUP BY 1, 2
""")
def score_histogram(spark, sf):
    sides = [
        explore.fixed_histogram(scored(spark, sf).where(F.col("y") == y), F.col("p"), 0.0, 1.0, 29).select(
            F.lit(y).alias("y"), "bin", "rows"
        )
        for y in (0, 1)
    ]
    return sides[0].unionByName(sides[1])


@query("min_max_scores", ["scored"], """
SELECT event_id, round((pred_min - (SELECT min(pred_min) FROM scored)) / (SELECT max(pred_min) - min(pred_min) FROM scored), 6) AS p FROM scored
""")
def min_max_scores(spark, sf):
    return evaluate.min_max_scores(scored(spark, sf).drop("p"), "pred_min").select("event_id", "p")


@query("margin_scores", ["scored"], """
SELECT event_id, round(1 / (1 + exp((60 - pred_min) / 20)), 6) AS p FROM scored
""")
def margin_scores(spark, sf):
    """Minutes around an hour as margins, through the logistic function."""
    return scored(spark, sf).select("event_id", rules.logistic((F.col("pred_min") - 60) / 20).alias("p"))


METRICS = """metrics AS (SELECT CASE WHEN k % 2 = 0 THEN 'Tuned ' ELSE '' END || carrier AS model,
  CASE WHEN k % 2 = 0 THEN 'tuned' ELSE 'baseline' END AS stage,
  round(avg(CASE WHEN (p >= 0.5) = (y = 1) THEN 1.0 ELSE 0.0 END), 6) AS accuracy,
  round(avg((p - y) * (p - y)), 6) AS brier FROM scored WHERE carrier IS NOT NULL GROUP BY 1, 2)"""


def model_metrics(spark, sf):
    """A table of measures per model: carriers play families, the parity of k the stage."""
    tuned = F.col("k") % 2 == 0
    rows = scored(spark, sf).where("carrier is not null")
    right = (F.col("p") >= 0.5).cast("int") == F.col("y")
    return rows.groupBy(
        F.concat(F.when(tuned, "Tuned ").otherwise(""), "carrier").alias("model"),
        F.when(tuned, "tuned").otherwise("baseline").alias("stage"),
    ).agg(
        F.round(F.avg(right.cast("int")), 6).alias("accuracy"),
        F.round(F.avg(F.pow(F.col("p") - F.col("y"), 2.0)), 6).alias("brier"),
    )


@query("model_rank", ["scored"], f"""WITH {METRICS} SELECT model, rank() OVER (ORDER BY accuracy DESC) AS accuracy_rank,
  rank() OVER (ORDER BY brier DESC) AS brier_rank FROM metrics""")
def model_rank(spark, sf):
    return evaluate.rank_models(model_metrics(spark, sf), ["accuracy", "brier"])


@query("stage_pivot", ["scored"], f"""WITH {METRICS} SELECT replace(model, 'Tuned ', '') AS model_family,
  max(accuracy) FILTER (stage = 'baseline') AS baseline, max(accuracy) FILTER (stage = 'tuned') AS tuned FROM metrics GROUP BY 1""")
def stage_pivot(spark, sf):
    return evaluate.stage_pivot(model_metrics(spark, sf), "accuracy")


@query("confusion_with_metrics", ["scored"], f"""WITH {METRICS},
c AS (SELECT CASE WHEN k % 2 = 0 THEN 'Tuned ' ELSE '' END || carrier AS model, count(*) FILTER (y = 1 AND p >= 0.5) AS tp,
  count(*) FILTER (y = 0 AND p >= 0.5) AS fp FROM scored WHERE carrier IS NOT NULL GROUP BY 1)
SELECT c.model, tp, fp, brier FROM c LEFT JOIN metrics ON metrics.model = c.model""")
def confusion_with_metrics(spark, sf):
    name = F.concat(F.when(F.col("k") % 2 == 0, "Tuned ").otherwise(""), "carrier").alias("model")
    rows = scored(spark, sf).where("carrier is not null").select("*", name)
    counts = evaluate.confusion(rows, (F.col("p") >= 0.5).cast("int"), ["model"])
    return counts.join(model_metrics(spark, sf).drop("stage"), "model", "left").select("model", "tp", "fp", "brier")


# ------------------------------------------------------------ rules, lookups
@query("risk_bands", ["scored"], """
SELECT event_id, CASE WHEN p < 0.35 THEN 'low' WHEN p < 0.65 THEN 'medium' ELSE 'high' END AS risk_level FROM scored
""")
def risk_bands(spark, sf):
    return scored(spark, sf).select("event_id", rules.risk_band(F.col("p")).alias("risk_level"))


@query("top_factors", ["scored"], """
WITH x AS (SELECT event_id, dep <> coalesce(arr, -1) AS i, pred_min * 20 AS d, k % 8 AS n, k % 7 AS q, k % 6 AS r,
  k % 3 = 0 AS s, CASE WHEN k % 5 = 0 THEN 'yes' WHEN k % 5 = 1 THEN 'no' END AS c, k % 4 AS m FROM scored),
f AS (SELECT event_id, list_filter([CASE WHEN i THEN 'international flight' END, CASE WHEN d >= 1500 THEN 'long route distance' END,
  CASE WHEN n >= 5 THEN 'many route NOTAMs' END, CASE WHEN q >= 5 THEN 'departure airport congestion' END,
  CASE WHEN r >= 5 THEN 'arrival/departure airport congestion' END, CASE WHEN s THEN 'airspace restriction' END,
  CASE WHEN c = 'yes' THEN 'runway closure' END, CASE WHEN m >= 3 THEN 'departure airport NOTAM activity' END], lambda x: x IS NOT NULL) AS l FROM x)
SELECT event_id, array_to_string(l[1:5], ';') AS factors FROM f
""")
def top_factors(spark, sf):
    rows = scored(spark, sf).selectExpr(
        "event_id", "dep <> coalesce(arr, -1) AS is_international", "pred_min * 20 AS route_distance_km",
        "k % 8 AS notam_count_route", "k % 7 AS flights_dep_same_hour", "k % 6 AS flights_arr_same_hour",
        "k % 3 = 0 AS has_airspace_restriction",
        "CASE WHEN k % 5 = 0 THEN 'yes' WHEN k % 5 = 1 THEN 'no' END AS has_runway_closure_dep",
        "k % 4 AS notam_count_dep",
    )
    return rows.select("event_id", F.array_join(rules.top_factors(dict(rows.dtypes)), ";").alias("factors"))


@query("search_contains", ["flights"], """
SELECT flight_iata, dep_iata, arr_iata, airline_iata, epoch_us(dep_scheduled_utc) AS dep_scheduled_utc,
  cast(dep_delay_min AS bigint) AS dep_delay_min FROM flights
WHERE lower(dep_iata) LIKE '%a1%' AND lower(airline_iata) LIKE '%pur%' ORDER BY dep_scheduled_utc, event_id LIMIT 10
""")
def search_contains(spark, sf):
    found = scoring.search(
        silver_flights(spark, sf), ["dep_scheduled_utc", "event_id"], 10, dep_iata="a1", airline_iata="Pur"
    )
    return found.select("flight_iata", "dep_iata", "arr_iata", "airline_iata", "dep_scheduled_utc", "dep_delay_min")


@query("row_lookup", None, """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 1 OFFSET 1234
""")
def row_lookup(spark, sf):
    rows = table(spark, sf, "orders").withColumn("at", F.unix_micros(F.col("o_orderdate").cast("timestamp")))
    return scoring.row_at(rows, "at", "o_orderkey", 1234).select("o_orderkey", "o_totalprice")


@query("numbered_rows", None, """
SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS row_id FROM orders
""")
def numbered_rows(spark, sf):
    """Every order with its number in order of time, as written once."""
    rows = table(spark, sf, "orders").select("o_orderdate", "o_orderkey")
    written = NumberedTable.write(rows, new_work_dir(spark, "numbered"), ["o_orderdate", "o_orderkey"])
    return written.numbered().select("o_orderkey", "row_id")


@query("search_indexed", ["flights"], """
SELECT * FROM (SELECT row_number() OVER (ORDER BY dep_scheduled_utc, event_id) - 1 AS row_id, epoch_us(dep_scheduled_utc) AS
  dep_scheduled_utc, flight_iata, dep_iata, arr_iata, airline_iata, cast(dep_delay_min AS bigint) AS dep_delay_min FROM flights) q
WHERE lower(airline_iata) LIKE '%rch%' AND lower(flight_iata) LIKE '%l1%' AND lower(arr_iata) LIKE '%2%' ORDER BY row_id LIMIT 50
""")
def search_indexed(spark, sf):
    index = SearchIndex.build(silver_flights(spark, sf), new_work_dir(spark, "search"), ["dep_scheduled_utc", "event_id"])
    return index.search(50, airline_iata="RCH", flight_iata="l1", arr_iata="2")


@query("align_columns", ["flights"], """
SELECT flight_iata, cast(dep_delay_min AS double) AS dep_delay_min, cast(NULL AS double) AS route_distance_km FROM flights
""")
def align_columns(spark, sf):
    wanted = {"flight_iata": "string", "dep_delay_min": "double", "route_distance_km": "double"}
    return scoring.align(silver_flights(spark, sf), wanted)
