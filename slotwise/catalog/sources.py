"""Queries for snapshots, sinks, training sources and the rules around the models."""

from __future__ import annotations

from pyspark.sql import functions as F

from slotwise.catalog.registry import Registry
from slotwise.catalog.views import silver_flights, table, view
from slotwise.functions import casts
from slotwise.plans import cleaning, explore, models, scoring, silver
from slotwise.schemas import AIRPORT_CSV_COLUMNS
from slotwise.session import new_work_dir
from slotwise.sources import incremental, sinks, snapshot, training
from slotwise.streaming import landing, promotion

REGISTRY = Registry()
query = REGISTRY.query


def _snapshot(spark, sf, delivery):
    """Suppliers dressed as an airport snapshot; the second one has new names and heights."""
    later = delivery == 2
    given = {
        "id": "cast(s_suppkey AS string)", "ident": "cast(s_suppkey AS string)",
        "type": "CASE s_nationkey % 4 WHEN 0 THEN 'large_airport' WHEN 1 THEN 'medium_airport' "
                "WHEN 2 THEN 'small_airport' ELSE 'heliport' END",
        "name": "concat('New, ', s_name)" if later else "s_name",
        "latitude_deg": "cast(s_acctbal / 200 AS string)",
        "elevation_ft": f"cast(s_acctbal + {int(later)} AS string)",
        "iso_country": f"concat(cast(s_nationkey AS string), '{'b' if later else 'a'}')",
        "scheduled_service": "CASE WHEN s_nationkey % 2 = 0 THEN 'yes' ELSE 'no' END",
        "icao_code": "concat('x', cast(s_suppkey AS string))",
        "iata_code": "CASE WHEN s_suppkey % 5 = 0 THEN ' ' ELSE concat(' a', cast(s_suppkey AS string)) END",
    }
    order = AIRPORT_CSV_COLUMNS[::-1] if later else AIRPORT_CSV_COLUMNS
    rows = table(spark, sf, "supplier").where("s_suppkey % 3 = 0" if later else "true")
    return rows.selectExpr(*[f"{given.get(c, 'cast(NULL AS string)')} AS {c}" for c in order])


@query("airport_snapshots", None, """
SELECT 'A' || s_suppkey AS iata_code, 'X' || s_suppkey AS icao_code,
  CASE WHEN s_suppkey % 3 = 0 THEN 'New, ' || s_name ELSE s_name END AS name,
  CASE s_nationkey % 4 WHEN 0 THEN 'large_airport' WHEN 1 THEN 'medium_airport' ELSE 'small_airport' END AS type,
  round(s_acctbal / 200, 6) AS latitude_deg,
  cast(floor(s_acctbal + CASE WHEN s_suppkey % 3 = 0 THEN 1 ELSE 0 END) AS bigint) AS elevation_ft,
  s_nationkey || 'a' AS iso_country, cast(s_nationkey % 2 = 0 AS bigint) AS scheduled_service
FROM supplier WHERE s_nationkey % 4 <> 3 AND s_suppkey % 5 <> 0
""")
def airport_snapshots(spark, sf):
    """Two CSV snapshots, the second with its columns in another order, each loaded once
    and promoted: mutable columns come from the later one, the others from the first."""
    base = new_work_dir(spark, "snapshots")
    for delivery in (1, 2):
        rows = _snapshot(spark, sf, delivery)
        rows.write.mode("append").option("header", True).option("escape", '"').csv(f"{base}/csv-{delivery}")
        for _ in range(2):
            snapshot.load_airport_snapshots(spark, f"{base}/csv-{delivery}", f"{base}/raw")
        landing.drain(
            promotion.promote(
                spark, f"{base}/raw", promotion.AIRPORTS, f"{base}/airports", f"{base}/cp", ["loaded_at", "ourairports_id"]
            )
        )
    return spark.read.parquet(f"{base}/airports").select(
        "iata_code", "icao_code", "name", "type", "latitude_deg", "elevation_ft", "iso_country", "scheduled_service"
    )


@query("snapshot_columns", None, """
SELECT s_suppkey::varchar AS ourairports_id, s_name AS name, cast(NULL AS varchar) AS home_link, cast(1 AS bigint) AS deliveries FROM supplier WHERE s_suppkey % 3 <> 0
UNION ALL SELECT s_suppkey::varchar, s_name, NULL, 2 FROM supplier WHERE s_suppkey % 3 = 0
""")
def snapshot_columns(spark, sf):
    """Files of two column orders read at once."""
    path = new_work_dir(spark, "snapshots")
    for delivery in (1, 2):
        _snapshot(spark, sf, delivery).write.mode("append").option("header", True).csv(path)
    return snapshot.read_airport_csv(spark, path).groupBy("ourairports_id").agg(
        F.min(F.regexp_replace("name", "^New, ", "")).alias("name"), F.max("home_link").alias("home_link"),
        F.count(F.lit(1)).alias("deliveries"),
    )


@query("keys_required", ["flights"], """
SELECT flight_iata, epoch_us(dep_scheduled_utc) AS dep_scheduled_utc FROM flights WHERE event_id % 3 = 0
""")
def keys_required(spark, sf):
    """A third of the payloads lacks the number, another third the time."""
    raw = silver_flights(spark, sf).selectExpr(
        """to_json(named_struct('flight', named_struct('iataNumber', CASE WHEN event_id % 3 <> 1 THEN flight_iata ELSE '' END),
          'departure', named_struct('scheduledTime', CASE WHEN event_id % 3 <> 2
            THEN date_format(dep_scheduled_utc, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS") END))) AS payload""",
        "'' AS queried_airport", "current_date() AS chunk_from", "current_date() AS chunk_to", "'' AS source",
        "dep_scheduled_utc AS ingestion_ts_utc",
    )
    return silver.flatten_flights(raw).select("flight_iata", "dep_scheduled_utc")


@query("keyset_page", None, """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE o_orderkey > (SELECT cast(floor(avg(o_orderkey)) AS bigint) FROM orders) ORDER BY o_orderkey LIMIT 500
""")
def keyset_page(spark, sf):
    """One page of 500 orders after a stored position."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    state = new_work_dir(spark, "cursor")
    incremental.advance_cursor(spark, state, "orders", int(orders.agg(F.floor(F.avg("o_orderkey"))).first()[0]))
    return incremental.rows_after(orders, "o_orderkey", incremental.read_cursor(spark, state, "orders"), limit=500)


def _labelled(spark, sf):
    flights = silver_flights(spark, sf)
    return flights.select(
        "event_id", "dep_scheduled_utc", F.col("dep_delay_min").cast("double").alias("dep_delay_min"),
        (F.col("dep_delay_min") > 15).cast("int").alias("is_delayed"),
        F.when(F.col("event_id") % 4 == 0, F.lit(float("nan"))).otherwise(F.col("event_id") / 4).alias("reading"),
    )


@query("table_replaced", ["flights"], """
SELECT event_id, CASE WHEN event_id % 4 <> 0 THEN event_id / 4 END AS reading,
  cast(dep_delay_min AS double) AS dep_delay_min, (SELECT count(*) FROM flights) AS clean_rows, cast(5 AS bigint) AS clean_columns
FROM flights WHERE dep_delay_min IS NOT NULL
""")
def table_replaced(spark, sf):
    """The whole table is written twice, NaN as NULL; its labelled rows are read back."""
    path = new_work_dir(spark, "replaced")
    for _ in range(2):
        seen = sinks.replace_table(_labelled(spark, sf), path, ["dep_scheduled_utc", "event_id"])
    rows = training.not_empty(training.labelled_table(spark, path))
    return rows.select("event_id", "reading", "dep_delay_min", *[F.lit(n).alias(c) for c, n in seen.items()])


@query("training_sources", ["flights"], """
SELECT s AS source, count(*) AS rows, cast(0 AS bigint) AS invalid, count(*) FILTER (dep_delay_min <= 15) AS zeros,
  count(*) FILTER (dep_delay_min > 15) AS ones, cast(0 AS bigint) AS other, count(*) FILTER (dep_delay_min < 0) AS negative
FROM flights, (SELECT unnest(['csv', 'query', 'table']) AS s) q WHERE dep_delay_min IS NOT NULL GROUP BY 1
""")
def training_sources(spark, sf):
    """The same labelled rows from a table, a query and a CSV export, checked by their targets."""
    base = new_work_dir(spark, "training")
    _labelled(spark, sf).drop("reading").write.parquet(f"{base}/table")
    rows = training.labelled_table(spark, f"{base}/table")
    rows.write.option("header", True).csv(f"{base}/csv")
    frames = {
        "table": rows,
        "query": training.query_rows(spark, f"SELECT * FROM parquet.`{base}/table` WHERE is_delayed IS NOT NULL"),
        "csv": training.csv_rows(spark, f"{base}/csv"),
    }
    facts = [(name, *cleaning.validate_training_rows(frame).values()) for name, frame in frames.items()]
    return spark.createDataFrame(
        facts, "source string, rows long, invalid long, zeros long, ones long, other long, negative long"
    )


@query("report_file", None, """
SELECT count(*) AS rows, cast(6 AS bigint) AS columns, strftime(min(o_orderdate), '%Y-%m-%d') AS time_min,
  strftime(max(o_orderdate), '%Y-%m-%d') AS time_max FROM orders
""")
def report_file(spark, sf):
    """The profile of a table as one CSV report, read back."""
    path = new_work_dir(spark, "report")
    orders = table(spark, sf, "orders")
    sinks.write_report(explore.table_profile(orders, "o_orderdate"), path)
    found = spark.read.option("header", True).csv(path)
    return found.select(
        F.col("rows").cast("long"), F.col("columns").cast("long"),
        *[F.left(c, F.lit(10)).alias(c) for c in ("time_min", "time_max")],
    )


@query("target_words", ["trips"], """
SELECT event_id, cast(CASE k % 7 WHEN 0 THEN 1 WHEN 1 THEN 0 WHEN 2 THEN 1 WHEN 3 THEN 0 WHEN 4 THEN 1 END AS bigint) AS target,
  'flag' AS bool_like FROM trips
""")
def target_words(spark, sf):
    """Target words to 0 and 1, and the columns whose words are all boolean."""
    words = F.element_at(F.array(*map(F.lit, ["t", "false", "True", "0", "1", "yes", ""])), (F.col("k") % 7 + 1).cast("int"))
    flags = F.when(F.col("k") % 3 == 0, " TRUE").when(F.col("k") % 3 == 1, "f")
    rows = view(spark, sf, "trips").withColumns({"word": words, "flag": flags})
    found = cleaning.bool_like_text_columns(rows, ["word", "flag", "event_type"])
    return rows.select(
        "event_id", casts.binary_target(F.col("word"), "string").alias("target"), F.lit(",".join(found)).alias("bool_like")
    )


@query("derived_defaults", ["trips"], """
SELECT event_id, cast(k % 3 = 0 AS bigint) AS route_avg_delay_7d_missing, cast(carrier IS NULL AS bigint) AS airline_avg_delay_30d_missing,
  cast(CASE WHEN k % 4 = 0 THEN 0 ELSE k END AS double) AS notam_count_dep, cast(coalesce(dep > 9 AND k % 5 > 0, false) AS bigint) AS has_restriction_dep,
  cast(terminal IS NULL AS bigint) AS dep_terminal_missing FROM trips
""")
def derived_defaults(spark, sf):
    """Flags of missing history; missing notice counts and notice flags become 0."""
    rows = view(spark, sf, "trips").selectExpr(
        "event_id", "dep_ts AS dep_scheduled_utc", "terminal AS dep_terminal",
        "CASE WHEN k % 3 <> 0 THEN value END AS route_avg_delay_7d",
        "CASE WHEN carrier IS NOT NULL THEN value END AS airline_avg_delay_30d",
        "CASE WHEN k % 4 <> 0 THEN k END AS notam_count_dep", "CASE WHEN k % 5 > 0 THEN dep > 9 END AS has_restriction_dep",
    )
    return cleaning.derive(rows, rolling_flags=True).select(
        "event_id", "route_avg_delay_7d_missing", "airline_avg_delay_30d_missing", "notam_count_dep",
        "has_restriction_dep", "dep_terminal_missing",
    )


@query("leakage_guard", ["flights"], """
SELECT dep_iata || '_grp' AS dep_iata_grp, cast(event_id % 24 AS bigint) AS dep_hour, count(*) AS rows FROM flights GROUP BY ALL
""")
def leakage_guard(spark, sf):
    """Targets, raw columns with a grouped version and helpers go; all other columns stay."""
    rows = silver_flights(spark, sf).select(
        "dep_iata", F.concat("dep_iata", F.lit("_grp")).alias("dep_iata_grp"), "status", "flight_iata", "flight_number",
        "airline_icao", "dep_terminal", "dep_scheduled_utc", "dep_delay_min", F.lit(1).alias("is_delayed"),
        F.lit(1).alias("is_weekend_int"), (F.col("event_id") % 24).alias("dep_hour"),
    )
    left = cleaning.without_leakage(rows)
    cleaning.check_no_leakage(left.columns)
    return left.groupBy(*left.columns).agg(F.count(F.lit(1)).alias("rows"))


@query("late_rows", ["scored"], """
SELECT event_id, round(ln(1 + minutes), 6) AS log_minutes, round(minutes, 6) AS back FROM scored WHERE minutes > 15
""")
def late_rows(spark, sf):
    """Rows of the second stage with their target on the log scale, and back."""
    frame = models.ModelFrame(view(spark, sf, "scored"), [], [])
    rows = models.delayed_rows(frame, minimum=1).rows
    return rows.select("event_id", "log_minutes", F.expm1("log_minutes").alias("back"))


@query("scored_answers", ["scored"], """
SELECT event_id, round(p, 6) AS delay_probability, 0.685::double AS threshold, cast(p >= 0.685 AS bigint) AS is_delayed,
  CASE WHEN p >= 0.685 THEN 'delayed' ELSE 'on_time' END AS prediction_label,
  CASE WHEN p < 0.35 THEN 'low' WHEN p < 0.65 THEN 'medium' ELSE 'high' END AS risk_level,
  greatest(pred_min - 20, 0) AS predicted_delay_minutes_if_delayed,
  CASE WHEN p >= 0.685 THEN greatest(pred_min - 20, 0) ELSE 0 END AS two_stage_predicted_delay_minutes,
  CASE WHEN k % 8 >= 5 THEN 'many route NOTAMs' ELSE '' END AS top_factors FROM scored
""")
def scored_answers(spark, sf):
    """What a user gets for given scores of both stages."""
    rows = view(spark, sf, "scored").select(
        "event_id", "p", (F.col("pred_min") - 20).alias("pred_min"), (F.col("k") % 8).alias("notam_count_route")
    )
    out = scoring.answers(rows, 0.685, {"notam_count_route": "int"}).drop("notam_count_route")
    return out.withColumn("top_factors", F.array_join("top_factors", ";"))
