"""Training sources and sinks."""

import pytest
from pyspark.sql import functions as F

from slotwise.operators.upsert import table_exists
from slotwise.plans import cleaning
from slotwise.sources import sinks, training


def test_table_query_and_csv_give_the_same_rows(spark, tmp_path):
    rows = spark.createDataFrame(
        [(1, 20.0, "2026-04-10 00:00:00+00:00"), (0, 3.0, "2026-04-11 00:00:00+00:00"), (None, None, "2026-04-12 00:00:00+00:00")],
        "is_delayed int, dep_delay_min double, dep_scheduled_utc string",
    )
    path = str(tmp_path / "clean")
    assert sinks.replace_table(rows, path, ["dep_scheduled_utc"]) == {"clean_rows": 3, "clean_columns": 3}
    assert sinks.replace_table(rows, path, ["dep_scheduled_utc"])["clean_rows"] == 3
    table = training.not_empty(training.labelled_table(spark, path))
    sinks.write_report(table, str(tmp_path / "csv"))
    assert len(list((tmp_path / "csv").glob("part-*.csv"))) == 1
    csv = training.csv_rows(spark, str(tmp_path / "csv"))
    query = training.query_rows(spark, f"SELECT * FROM parquet.`{path}` WHERE is_delayed IS NOT NULL")
    for frame in (table, csv, query):
        assert cleaning.validate_training_rows(frame)["rows"] == 2
        assert sorted(map(tuple, frame.select("is_delayed", "dep_delay_min").collect())) == [(0, 3.0), (1, 20.0)]
    with pytest.raises(ValueError):
        training.not_empty(table.where(F.lit(False)))


def test_table_exists(spark, tmp_path):
    assert not table_exists(spark, str(tmp_path / "nothing"))
    (tmp_path / "started" / "_temporary").mkdir(parents=True)
    assert not table_exists(spark, str(tmp_path / "started"))
