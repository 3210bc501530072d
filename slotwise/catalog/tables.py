"""Queries for landing, flattening, deduplication, upserts, streams and cleaning."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from slotwise.catalog.features import gold_table
from slotwise.catalog.registry import Registry
from slotwise.catalog.views import silver_airports, silver_flights, table, view
from slotwise.functions import casts
from slotwise.operators.categories import category_counts, group_rare, most_frequent
from slotwise.operators.constancy import column_profile
from slotwise.operators.upsert import keep_last, replay
from slotwise.plans import cleaning, silver
from slotwise.plans.explore import missing_profile
from slotwise.plans.gold import airport_role, enrich_airports
from slotwise.schemas import DELAY_THRESHOLD_MINUTES
from slotwise.session import new_work_dir, persist_table
from slotwise.sources import committed, envelope, incremental, snapshot, worklist
from slotwise.streaming import congestion, landing, promotion

REGISTRY = Registry()
query = REGISTRY.query


# ------------------------------------------------------------------ payloads
def flight_payloads(spark, sf, departure=None):
    """Flights as the feed delivers them: nested JSON plus provenance. ``departure``
    replaces the scheduled departure."""
    def text(ts):
        return f"date_format({ts}, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\")"

    flights = view(spark, sf, "flights")
    if departure is not None:
        flights = flights.withColumn("dep_scheduled_utc", departure)
    return flights.selectExpr(
        "event_id",
        f"""named_struct('status', status,
          'flight', named_struct('iataNumber', lower(flight_iata), 'icaoNumber', '', 'number', flight_number),
          'airline', named_struct('name', airline_iata, 'iataCode', lower(airline_iata), 'icaoCode', airline_icao),
          'departure', named_struct('iataCode', lower(dep_iata), 'icaoCode', dep_icao, 'terminal', dep_terminal,
            'scheduledTime', lower({text('dep_scheduled_utc')}), 'delay', cast(dep_delay_min AS string)),
          'arrival', named_struct('iataCode', arr_iata, 'icaoCode', arr_icao,
            'scheduledTime', {text('arr_scheduled_utc')})) AS record""",
        f"{text('dep_scheduled_utc')} AS ingestion_ts_utc",
        "dep_iata AS queried_airport", "'departure' AS query_direction",
        "cast(to_date(dep_scheduled_utc) AS string) AS chunk_from",
        "cast(date_add(to_date(dep_scheduled_utc), 6) AS string) AS chunk_to", "'feed' AS source",
    )


FLAT_SQL = """SELECT {event} flight_iata, flight_number, airline_iata, airline_icao, status, dep_iata, dep_icao,
  dep_terminal, epoch_us(dep_scheduled_utc) AS dep_scheduled_utc, cast(dep_delay_min AS bigint) AS dep_delay_min,
  arr_iata, arr_icao, epoch_us(arr_scheduled_utc) AS arr_scheduled_utc, dep_iata AS queried_airport,
  cast(dep_scheduled_utc::date AS varchar) AS chunk_from, cast(NULL AS varchar) AS flight_icao
FROM flights"""
FLAT_COLUMNS = [
    "flight_iata", "flight_number", "airline_iata", "airline_icao", "status", "dep_iata", "dep_icao",
    "dep_terminal", "dep_scheduled_utc", "dep_delay_min", "arr_iata", "arr_icao", "arr_scheduled_utc",
    "queried_airport", "chunk_from", "flight_icao",
]


@query("flatten_json", ["flights"], FLAT_SQL.format(event="event_id,"))
def flatten_json(spark, sf):
    raw = flight_payloads(spark, sf).withColumns(
        {
            "payload": F.to_json("record"),
            "ingestion_ts_utc": casts.utc_timestamp(F.col("ingestion_ts_utc")),
            "chunk_from": casts.iso_date(F.col("chunk_from")),
            "chunk_to": casts.iso_date(F.col("chunk_to")),
        }
    )
    return silver.flatten_flights(raw, ["event_id"]).select("event_id", *FLAT_COLUMNS)


@query("envelope_roundtrip", ["flights"], """
SELECT flight_iata, cast(epoch_us(dep_scheduled_utc) AS bigint) AS ingestion_ts_utc, dep_iata AS queried_airport,
  'departure' AS query_direction, cast(dep_scheduled_utc::date AS varchar) AS chunk_from,
  cast(dep_scheduled_utc::date + 6 AS varchar) AS chunk_to, 'feed' AS source
FROM flights WHERE NOT (k % 50 = 7) UNION ALL
SELECT 'undecodable', NULL, NULL, NULL, NULL, NULL, NULL FROM flights WHERE k % 50 = 7
""".replace("FROM flights WHERE", "FROM (SELECT f.*, cast(substr(flight_number, 2) AS int) AS k FROM flights f) f WHERE"))
def envelope_roundtrip(spark, sf):
    """Wrap, damage every record of one kind, decode; damaged ones are kept apart."""
    records = flight_payloads(spark, sf)
    sent = envelope.wrap(records, "record", envelope.FLIGHT_PROVENANCE, envelope.flight_key(F.col("record")))
    broken = F.regexp_extract("value", '"number":"N([0-9]+)"', 1).cast("int") % 50 == 7
    sent = sent.withColumn("value", F.when(broken, F.expr("left(value, length(value) - 9)")).otherwise(F.col("value")))
    good, bad = envelope.split_decoded(envelope.decode(sent.select("value"), envelope.FLIGHT_PROVENANCE))
    number = F.upper(F.get_json_object("payload", "$.flight.iataNumber")).alias("flight_iata")
    none = [F.lit(None).cast(t).alias(c) for c, t in good.dtypes if c not in ("payload",)]
    return good.select(number, *[c for c in good.columns if c != "payload"]).unionByName(
        bad.select(F.lit("undecodable").alias("flight_iata"), *none)
    )


@query("routing_key_md5", ["flights"], """
SELECT event_id, md5(coalesce(lower(flight_iata), 'unknown') || '|' ||
  lower(strftime(dep_scheduled_utc, '%Y-%m-%dT%H:%M:%S.%f'))) AS flight_key,
  md5(dep_iata || '|' || coalesce(flight_number, 'unknown')) AS notice_key FROM flights
""")
def routing_key_md5(spark, sf):
    records = flight_payloads(spark, sf)
    notice = F.struct(F.col("record.flight.number").alias("number"))
    return records.select(
        "event_id", envelope.flight_key(F.col("record")).alias("flight_key"),
        envelope.notam_key(notice, F.col("queried_airport")).alias("notice_key"),
    )


# ---------------------------------------------------------- dedup and upserts
@query("dedup_keep_last", ["trips"], """
SELECT dep, carrier, hour, event_id, delay_min, terminal FROM (
  SELECT cast(dep AS bigint) AS dep, carrier, epoch_us(date_trunc('hour', dep_ts)) AS hour, event_id,
    cast(delay_min AS bigint) AS delay_min, terminal,
    row_number() OVER (PARTITION BY dep, carrier, date_trunc('hour', dep_ts) ORDER BY event_id DESC) AS rn
  FROM trips) q WHERE rn = 1
""")
def dedup_keep_last(spark, sf):
    trips = view(spark, sf, "trips").select(
        "dep", "carrier", F.date_trunc("hour", "dep_ts").alias("hour"), "event_id", "delay_min", "terminal"
    )
    return keep_last(trips, ["dep", "carrier", "hour"], ["event_id"])


@query("upsert_partial", ["trips"], """
WITH b AS (SELECT dep, carrier, date_trunc('day', dep_ts) AS batch, event_id, delay_min, status, terminal, value
  FROM trips WHERE carrier IS NOT NULL),
w AS (SELECT *, row_number() OVER (PARTITION BY dep, carrier, batch ORDER BY event_id DESC) AS rn FROM b),
x AS (SELECT *, row_number() OVER (PARTITION BY dep, carrier ORDER BY batch) AS up,
  row_number() OVER (PARTITION BY dep, carrier ORDER BY batch DESC) AS down FROM w WHERE rn = 1)
SELECT cast(l.dep AS bigint) AS dep, l.carrier, cast(l.delay_min AS bigint) AS delay_min, l.status,
  f.terminal, round(f.value, 6) AS value
FROM x l JOIN x f ON f.dep = l.dep AND f.carrier = l.carrier AND f.up = 1 WHERE l.down = 1
""")
def upsert_partial(spark, sf):
    """Daily batches replayed: delay and status from the last one, the rest from the first."""
    batches = view(spark, sf, "trips").where("carrier is not null").select(
        "dep", "carrier", F.to_date("dep_ts").alias("batch"), "event_id", "delay_min", "status",
        "terminal", "value",
    )
    return replay(batches, ["dep", "carrier"], ["delay_min", "status"], "batch", ["event_id"])


@query("load_once_anti", None, """
WITH o AS (SELECT 'day-' || cast(o_orderdate::date AS varchar) AS source_file, o_orderstatus AS st FROM orders)
SELECT source_file, count(*) AS n FROM o
WHERE source_file NOT IN (SELECT source_file FROM o WHERE st = 'P') GROUP BY 1
""")
def load_once_anti(spark, sf):
    """One source file per order day; days with an order in state P are loaded already."""
    incoming = table(spark, sf, "orders").select(
        F.concat(F.lit("day-"), F.to_date("o_orderdate").cast("string")).alias("source_file"), "o_orderstatus"
    )
    loaded = incoming.where("o_orderstatus = 'P'")
    return snapshot.not_loaded_yet(incoming, loaded).groupBy("source_file").agg(F.count(F.lit(1)).alias("n"))


@query("airport_clean", None, """
SELECT upper(trim('a' || s_suppkey)) AS iata_code, 'X' || s_suppkey AS icao_code, s_name AS name,
  CASE s_nationkey % 4 WHEN 0 THEN 'large_airport' WHEN 1 THEN 'medium_airport' ELSE 'small_airport' END AS type,
  round(s_acctbal / 200, 6) AS latitude_deg, cast(floor(s_acctbal) AS bigint) AS elevation_ft,
  cast(s_nationkey % 2 = 0 AS bigint) AS scheduled_service
FROM supplier WHERE s_nationkey % 4 <> 3
""")
def airport_clean(spark, sf):
    """Suppliers dressed as raw snapshot rows: padded codes, numbers as text, two copies each."""
    raw = table(spark, sf, "supplier").selectExpr(
        "' a' || cast(s_suppkey AS string) || ' ' AS iata_code", "'x' || cast(s_suppkey AS string) AS icao_code",
        "cast(s_suppkey AS string) AS ident", "s_name AS name",
        "CASE s_nationkey % 4 WHEN 0 THEN 'large_airport' WHEN 1 THEN 'medium_airport' "
        "WHEN 2 THEN 'small_airport' ELSE 'heliport' END AS type",
        "cast(s_acctbal / 200 AS string) AS latitude_deg", "'n/a' AS longitude_deg",
        "cast(s_acctbal AS string) AS elevation_ft", "'EU' AS continent",
        "cast(s_nationkey AS string) AS iso_country", "'r' AS iso_region", "'m' AS municipality",
        "CASE WHEN s_nationkey % 2 = 0 THEN ' Yes' ELSE 'no' END AS scheduled_service",
    )
    copies = raw.withColumn("id", F.explode(F.array(F.lit(1), F.lit(2))))
    copies = copies.withColumn("latitude_deg", F.when(F.col("id") == 2, F.col("latitude_deg")))
    return silver.latest_airports(copies, ["id"]).select(
        "iata_code", "icao_code", "name", "type", "latitude_deg", "elevation_ft", "scheduled_service"
    )


@query("extract_plan", None, """
SELECT s_name AS airport, d AS direction, cast(c.a::date AS varchar) AS chunk_from,
  cast(least(c.a::date + 6, date '2024-01-31') AS varchar) AS chunk_to
FROM supplier, (VALUES ('departure'), ('arrival')) v(d),
  (SELECT unnest(generate_series(timestamp '2024-01-01', timestamp '2024-01-31', INTERVAL 7 DAY)) AS a) c
""")
def extract_plan(spark, sf):
    return worklist.extract_plan(
        table(spark, sf, "supplier"), "s_name", ["departure", "arrival"], date(2024, 1, 1), date(2024, 1, 31), 7
    )


@query("customer_work_chunks", None, """
WITH s AS (SELECT o_custkey, min(o_orderdate)::date AS a, max(o_orderdate)::date AS b FROM orders GROUP BY 1)
SELECT o_custkey, cast(c::date AS varchar) AS chunk_from, cast(least(c::date + 89, b) AS varchar) AS chunk_to
FROM (SELECT o_custkey, b, unnest(generate_series(a::timestamp, b::timestamp, INTERVAL 90 DAY)) AS c FROM s) q
""")
def customer_work_chunks(spark, sf):
    """Date spans cut into chunks of at most 90 days."""
    spans = table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.to_date(F.min("o_orderdate")).alias("a"), F.to_date(F.max("o_orderdate")).alias("b")
    )
    return worklist.add_chunks(spans, "a", "b", 90).select("o_custkey", "chunk_from", "chunk_to")


@query("incremental_scan", ["trips"], """
SELECT cast(dep AS bigint) AS dep, count(*) AS fresh, max(event_id) AS last_id FROM trips
WHERE event_id > (SELECT max(event_id) FROM trips WHERE dep_ts < timestamp '2024-01-15') GROUP BY dep
""")
def incremental_scan(spark, sf):
    """Read after the stored position of the first half of the month."""
    trips = view(spark, sf, "trips")
    state = new_work_dir(spark, "cursor")
    done = trips.where("dep_ts < timestamp '2024-01-15'").agg(F.max("event_id")).first()[0]
    incremental.advance_cursor(spark, state, "trips", done)
    fresh = incremental.rows_after(trips, "event_id", incremental.read_cursor(spark, state, "trips"))
    return fresh.groupBy("dep").agg(F.count(F.lit(1)).alias("fresh"), F.max("event_id").alias("last_id"))


@query("committed_runs", ["trips"], """
SELECT cast(v AS bigint) AS version, max(event_id) AS position, count(*) AS rows, count(DISTINCT event_id) AS ids,
  cast(sum(delay_min) AS bigint) AS delays FROM trips
JOIN (SELECT 1 AS v, timestamp '2024-01-10' AS till UNION ALL SELECT 2, timestamp '2024-01-20' UNION ALL SELECT 3, timestamp '9999-01-01') w
  ON event_id <= (SELECT max(event_id) FROM trips WHERE dep_ts < till) GROUP BY v
""")
def committed_runs(spark, sf):
    """Three incremental runs, the second of them twice since its first attempt is not published."""
    trips = view(spark, sf, "trips")
    target = committed.CommittedTable(spark, new_work_dir(spark, "committed"))
    for till in ("2024-01-10", "2024-01-20", "9999-01-01"):
        last = trips.where(F.col("dep_ts") < F.lit(till).cast("timestamp")).agg(F.max("event_id")).first()[0]
        known = trips.where(F.col("event_id") <= last)
        if till == "2024-01-20":
            target._write_rows(known)  # a run that ends before it publishes
        target.advance(known, "event_id")
    found = [
        target.read(v).select(F.lit(v.number).cast("long").alias("version"), F.lit(v.position).cast("long").alias("position"), "event_id", "delay_min")
        for v in map(target.version, (1, 2, 3))
    ]
    both = found[0].unionByName(found[1]).unionByName(found[2])
    return both.groupBy("version", "position").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("event_id").alias("ids"), F.sum("delay_min").alias("delays")
    )


@query("window_scans", ["flights", "notices"], """
SELECT 'flights' AS source, count(*) AS n FROM flights
  WHERE dep_scheduled_utc >= timestamp '2024-01-10' AND dep_scheduled_utc < timestamp '2024-01-17'
UNION ALL SELECT 'notices', count(*) FROM notices WHERE st <= timestamp '2024-01-17' AND en >= timestamp '2024-01-10'
""")
def window_scans(spark, sf):
    a, b = F.lit("2024-01-10").cast("timestamp"), F.lit("2024-01-17").cast("timestamp")
    flights = incremental.rows_between(silver_flights(spark, sf), "dep_scheduled_utc", a, b, ["flight_iata"])
    notices = incremental.overlapping(view(spark, sf, "notices"), "st", "en", a, b)
    count = F.count(F.lit(1)).alias("n")
    return flights.agg(count).select(F.lit("flights").alias("source"), "n").unionByName(
        notices.agg(count).select(F.lit("notices").alias("source"), "n")
    )


# ------------------------------------------------------------------- streams
@query("stream_bronze_silver", ["flights"], FLAT_SQL.format(event=""))
def stream_bronze_silver(spark, sf):
    """JSON files -> raw table -> keyed flights, each as a stream run to its end."""
    base = new_work_dir(spark, "stream")
    sent = envelope.wrap(
        flight_payloads(spark, sf), "record", envelope.FLIGHT_PROVENANCE, envelope.flight_key(F.col("record"))
    )
    files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sent.repartition(files, "key").select("value").write.text(f"{base}/in")
    stream = landing.landing_files(spark, f"{base}/in", max_files=2)
    landing.drain(
        landing.land(stream, envelope.FLIGHT_PROVENANCE, f"{base}/raw", f"{base}/bad", f"{base}/cp1")
    )
    landing.drain(
        promotion.promote(
            spark, f"{base}/raw", promotion.FLIGHTS, f"{base}/flights", f"{base}/cp2", ["batch_id", "arrival"]
        )
    )
    return spark.read.parquet(f"{base}/flights").select(*FLAT_COLUMNS)


def notice_payloads(spark, sf, source, days, chosen="true"):
    """Notices as the feed delivers them, valid ``days`` longer."""
    def text(ts):
        return f"date_format({ts}, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\")"

    return view(spark, sf, "notices").where(chosen).selectExpr(
        f"""named_struct('number', CASE WHEN notice_no % 11 = 0 THEN ' ' ELSE ' n' || cast(notice_no AS string) END,
          'location', lower(loc), 'class', '{source}', 'startdateutc', {text('st')},
          'enddateutc', {text(f'en + make_interval(0, 0, 0, {days}, 0, 0, 0)')}, 'condition', txt) AS record""",
        f"{text('st')} AS ingestion_ts_utc", "loc AS queried_airport", "cast(to_date(st) AS string) AS chunk_from",
        "cast(to_date(st) AS string) AS chunk_to", f"'{source}' AS source", "'notices' AS source_endpoint",
    )


@query("stream_notices", ["notices"], """
SELECT 'N' || cast(notice_no AS varchar) AS notam_number, loc AS location_icao,
  CASE WHEN notice_no % 3 = 0 THEN 'second' ELSE 'first' END AS class, epoch_us(st) AS start_utc,
  epoch_us(CASE WHEN notice_no % 3 = 0 THEN en + INTERVAL 1 DAY ELSE en END) AS end_utc, txt AS condition_text,
  loc AS queried_airport, 'first' AS source
FROM notices WHERE notice_no % 11 <> 0
""")
def stream_notices(spark, sf):
    """Two landed deliveries, promoted together: a third of the notices come again, longer
    valid. Notices without a number drop out; what is not mutable stays as it came first."""
    base = new_work_dir(spark, "stream")
    for source, days, chosen in (("first", 0, "true"), ("second", 1, "notice_no % 3 = 0")):
        records = notice_payloads(spark, sf, source, days, chosen)
        key = envelope.notam_key(F.col("record"), F.col("queried_airport"))
        sent = envelope.wrap(records, "record", envelope.NOTAM_PROVENANCE, key)
        sent.select("value").write.mode("append").text(f"{base}/in")
        stream = landing.landing_files(spark, f"{base}/in")
        landing.drain(
            landing.land(stream, envelope.NOTAM_PROVENANCE, f"{base}/raw", f"{base}/bad", f"{base}/cp1")
        )
    landing.drain(
        promotion.promote(
            spark, f"{base}/raw", promotion.NOTAMS, f"{base}/notices", f"{base}/cp2", ["batch_id", "arrival"]
        )
    )
    return spark.read.parquet(f"{base}/notices").select(
        "notam_number", "location_icao", "class", "start_utc", "end_utc", "condition_text", "queried_airport", "source"
    )


@query("stream_congestion", None, """
SELECT event_type, epoch_us(date_trunc('hour', ts)) AS hour, count(*) AS flights FROM events GROUP BY 1, 2
""")
def stream_congestion(spark, sf):
    base = new_work_dir(spark, "stream")
    schema = table(spark, sf, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    counts = congestion.hourly_counts(stream, "ts", "event_type")
    landing.drain(
        congestion.maintain_hourly_counts(counts, f"{base}/hours", "event_type", f"{base}/cp")
    )
    return spark.read.parquet(f"{base}/hours").select("event_type", "hour", "flights")


@query("stream_dedup", None, "SELECT event_id, event_type FROM events")
def stream_dedup(spark, sf):
    """Every event is delivered twice; one delivery survives."""
    base = new_work_dir(spark, "stream")
    events = table(spark, sf, "events")
    events.unionByName(events).write.parquet(f"{base}/in")
    stream = spark.readStream.schema(events.schema).parquet(f"{base}/in")
    kept = congestion.without_redelivery(stream, "ts", ["event_id"])

    def write(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{base}/out/batch={batch_id}")

    landing.drain(landing.start(kept, write, f"{base}/cp"))
    return spark.read.parquet(f"{base}/out").select("event_id", "event_type")


# ------------------------------------------------------------------ cleaning
@query("rare_groups", ["trips", "airports"], """
WITH c AS (SELECT o_clerk, count(*) AS n FROM (SELECT CASE WHEN o_custkey % 11 = 0 THEN NULL
  ELSE 'C' || cast(o_custkey % 977 AS varchar) END AS o_clerk FROM orders) q GROUP BY 1),
x AS (SELECT o_orderkey, CASE WHEN o_custkey % 11 = 0 THEN NULL
  ELSE 'C' || cast(o_custkey % 977 AS varchar) END AS o_clerk FROM orders)
SELECT x.o_orderkey, CASE WHEN c.n >= 15 THEN x.o_clerk ELSE 'OTHER' END AS clerk_grp
FROM x JOIN c ON c.o_clerk IS NOT DISTINCT FROM x.o_clerk
""")
def rare_groups(spark, sf):
    orders = table(spark, sf, "orders").selectExpr(
        "o_orderkey",
        "CASE WHEN o_custkey % 11 = 0 THEN NULL ELSE 'C' || cast(o_custkey % 977 AS string) END AS clerk",
    )
    counts = category_counts(orders, ["clerk"])
    return group_rare(orders, {"clerk": 15}, counts, ["o_orderkey"]).select("o_orderkey", "clerk_grp")


@query("near_constant_profile", None, """
WITH x AS (SELECT unnest(['l_returnflag', 'l_linestatus', 'l_linenumber', 'l_discount', 'one', 'mostly']) AS feature,
  unnest([l_returnflag, l_linestatus, l_linenumber::varchar, l_discount::varchar, 'a',
    CASE WHEN l_orderkey % 401 = 0 THEN NULL ELSE 'b' END]) AS v FROM lineitem),
c AS (SELECT feature, v, count(*) AS n FROM x GROUP BY 1, 2),
s AS (SELECT feature, cast(sum(n) AS bigint) AS rows, cast(sum(CASE WHEN v IS NULL THEN n ELSE 0 END) AS bigint) AS missing,
  cast(count(*) <= 1 AS bigint) AS constant, max(n) / sum(n) AS top FROM c GROUP BY 1)
SELECT feature, rows, missing, constant, round(CASE WHEN top >= 0.995 THEN top END, 6) AS dominant_share,
  cast(top >= 0.995 AND constant = 0 AS bigint) AS near_constant FROM s
""")
def near_constant_profile(spark, sf):
    items = table(spark, sf, "lineitem").withColumns(
        {"one": F.lit("a"), "mostly": F.when(F.col("l_orderkey") % 401 != 0, F.lit("b"))}
    )
    names = ["l_returnflag", "l_linestatus", "l_linenumber", "l_discount", "one", "mostly"]
    rows = column_profile(items, names)
    report = spark.createDataFrame(
        [(r["feature"], r["rows"], r["missing"], r["constant"], float(r["top_share"])) for r in rows],
        "feature string, rows long, missing long, constant boolean, top double",
    )
    high = F.col("top") >= 0.995
    return report.select(
        "feature", "rows", "missing", "constant", F.when(high, F.col("top")).alias("dominant_share"),
        (high & ~F.col("constant")).alias("near_constant"),
    )


@query("median_impute", ["flights", "airports"], """
WITH x AS (SELECT f.event_id, a.elevation_ft AS e, f.dep_delay_min AS m FROM flights f
  LEFT JOIN airports a ON a.iata_code = f.arr_iata)
SELECT event_id, cast(coalesce(e, (SELECT median(e) FROM x)) AS double) AS elevation,
  cast(coalesce(m, (SELECT median(m) FROM x)) AS double) AS minutes FROM x
""")
def median_impute(spark, sf):
    rows = silver_flights(spark, sf).join(airport_role(silver_airports(spark, sf), "arr"), "arr_iata", "left")
    rows = rows.select("event_id", F.col("arr_elevation_ft").alias("elevation"), F.col("dep_delay_min").alias("minutes"))
    medians = cleaning.column_medians(rows, ["elevation", "minutes"])
    return rows.select(
        "event_id", *[F.coalesce(F.col(c).cast("double"), F.lit(m)).alias(c) for c, m in medians.items()]
    )


@query("mode_impute", ["trips"], """
SELECT event_id, coalesce(carrier, (SELECT carrier FROM (SELECT carrier, count(*) AS n FROM trips
  WHERE carrier IS NOT NULL GROUP BY 1) q ORDER BY n DESC, carrier LIMIT 1)) AS carrier FROM trips
""")
def mode_impute(spark, sf):
    trips = view(spark, sf, "trips")
    mode = most_frequent(category_counts(trips, ["carrier"])).select("value").scalar()
    return trips.select("event_id", F.coalesce("carrier", mode).alias("carrier"))


@query("missing_profile", ["trips"], """
WITH m AS (SELECT count(*) AS rows, count(*) - count(arr) AS arr, count(*) - count(carrier) AS carrier,
  count(*) - count(delay_min) AS delay_min, count(*) - count(status) AS status, count(*) - count(terminal) AS terminal FROM trips)
SELECT feature, missing, round(100.0::double * missing / rows, 2) AS missing_pct
FROM (SELECT rows, unnest(['arr','carrier','delay_min','status','terminal']) AS feature,
  unnest([arr, carrier, delay_min, status, terminal]) AS missing FROM m) q WHERE missing > 0
""")
def missing_columns(spark, sf):
    return missing_profile(view(spark, sf, "trips"))


def cleaned(spark, sf):
    """The modelling table and its fitted plan over the full feature table."""
    gold = persist_table(gold_table(spark, sf), "gold-rows")
    plan = cleaning.fit_cleaning(gold)
    return gold, plan


@query("cleaned_dataset")
def cleaned_dataset(spark, sf):
    gold, plan = cleaned(spark, sf)
    return plan.transform(gold)


@query("cleaned_core", ["flights", "airports"], """
WITH l AS (SELECT * FROM flights WHERE dep_delay_min IS NOT NULL
  AND coalesce(lower(trim(status)), '') NOT IN ('cancelled', 'diverted')),
x AS (SELECT l.*, d.elevation_ft AS de, d.iso_country AS dc, a.elevation_ft AS ae, a.iso_country AS ac,
  a.scheduled_service AS serv, coalesce(l.dep_iata, 'UNKNOWN') || '_' || coalesce(l.arr_iata, 'UNKNOWN') AS route
  FROM l LEFT JOIN airports d ON d.iata_code = l.dep_iata LEFT JOIN airports a ON a.iata_code = l.arr_iata)
SELECT strftime(dep_scheduled_utc, '%Y-%m-%d %H:%M:%S') || '+00:00' AS dep_scheduled_utc,
  cast(dep_delay_min AS double) AS dep_delay_min, cast(dep_delay_min > 15 AS bigint) AS is_delayed,
  cast(hour(dep_scheduled_utc) AS bigint) AS dep_hour, cast(isodow(dep_scheduled_utc) - 1 AS bigint) AS dep_dayofweek,
  cast(isodow(dep_scheduled_utc) >= 6 AS bigint) AS dep_is_weekend,
  cast(terminal_missing AS bigint) AS dep_terminal_missing,
  cast(coalesce(de, (SELECT median(de) FROM x)) AS double) AS dep_elevation_ft,
  cast(coalesce(ae, (SELECT median(ae) FROM x)) AS double) AS arr_elevation_ft,
  cast(coalesce(cast(serv AS int), (SELECT median(cast(serv AS int)) FROM x)) AS double) AS arr_scheduled_service,
  coalesce(dep_iata, 'UNKNOWN') AS dep_iata, coalesce(arr_iata, 'UNKNOWN') AS arr_iata,
  coalesce(airline_iata, 'UNKNOWN') AS airline_iata, route, coalesce(ac, 'UNKNOWN') AS arr_iso_country,
  CASE WHEN count(*) OVER (PARTITION BY dep_iata) < 20 THEN 'OTHER' ELSE coalesce(dep_iata, 'UNKNOWN') END AS dep_iata_grp,
  CASE WHEN count(*) OVER (PARTITION BY arr_iata) < 20 THEN 'OTHER' ELSE coalesce(arr_iata, 'UNKNOWN') END AS arr_iata_grp,
  CASE WHEN count(*) OVER (PARTITION BY airline_iata) < 15 THEN 'OTHER' ELSE coalesce(airline_iata, 'UNKNOWN') END AS airline_iata_grp,
  CASE WHEN count(*) OVER (PARTITION BY route) < 10 THEN 'OTHER' ELSE route END AS route_grp,
  CASE WHEN count(*) OVER (PARTITION BY ac) < 20 THEN 'OTHER' ELSE coalesce(ac, 'UNKNOWN') END AS arr_iso_country_grp
FROM (SELECT *, dep_terminal IS NULL AS terminal_missing FROM x) x
""")
def cleaned_core(spark, sf):
    """The cleaned table without the joined history and notice columns."""
    rows = enrich_airports(silver_flights(spark, sf).drop("event_id", "dep_icao", "arr_icao", "arr_scheduled_utc"),
                           silver_airports(spark, sf))
    rows = persist_table(
        rows.withColumn("is_delayed", F.col("dep_delay_min") > DELAY_THRESHOLD_MINUTES), "gold-rows"
    )
    out = cleaning.fit_cleaning(rows).transform(rows)
    return out.select(
        "dep_scheduled_utc", "dep_delay_min", "is_delayed", "dep_hour", "dep_dayofweek", "dep_is_weekend",
        "dep_terminal_missing", "dep_elevation_ft", "arr_elevation_ft", "arr_scheduled_service", "dep_iata",
        "arr_iata", "airline_iata", "route", "arr_iso_country", "dep_iata_grp", "arr_iata_grp",
        "airline_iata_grp", "route_grp", "arr_iso_country_grp",
    )
