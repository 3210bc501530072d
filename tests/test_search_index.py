"""Numbered tables and the trigram index against plain sorting and the plain scan."""

import random

import pytest

from slotwise.plans import scoring
from slotwise.plans.search_index import SearchIndex
from slotwise.sources.numbered import NumberedTable

SCHEMA = "flight_iata string, dep_iata string, arr_iata_grp string, dep_scheduled_utc long, tie long, note string"


def rows(n, seed=5):
    rng = random.Random(seed)
    codes = ["ALA", "IST", "ist", "GUW", "A.A", "%L_", "ÄLA", "X", "", None]
    return [
        (rng.choice([f"KC{rng.randrange(40)}", "TK.1", None]), rng.choice(codes), rng.choice(codes),
         # A third of all rows shares one time; some have none.
         rng.choice([7, None if i % 11 == 0 else 3, rng.randrange(60)]), i, "x")
        for i in range(n)
    ]


def in_order(data):
    return sorted(data, key=lambda r: (r[3] is not None, r[3] or 0, r[4]))


def scans(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_numbers_follow_the_order_and_lookups_read_one_part(spark, tmp_path):
    data = rows(500)
    df = spark.createDataFrame(data, SCHEMA)
    table = NumberedTable.write(df, str(tmp_path / "t"), ["dep_scheduled_utc", "tie"], parts=6)
    want = in_order(data)
    got = table.numbered().orderBy("row_id").collect()
    assert [r.row_id for r in got] == list(range(500))
    assert [tuple(r)[:-1] for r in got] == want
    assert table.parts().count() > 2
    for n in (0, 1, 250, 499):
        found = table.row_at(n)
        assert [tuple(r)[:-1] for r in found.collect()] == [want[n]]
        assert "(part#" in scans(found).split("PartitionFilters")[1].split("]")[0]
    for n in (-1, 500):
        with pytest.raises(IndexError):
            table.row_at(n)
    for low, high in ((7, 7), (0, 2), (58, 900), (900, 901)):
        between = table.between("dep_scheduled_utc", low, high).collect()
        assert sorted(r.tie for r in between) == sorted(r[4] for r in data if r[3] is not None and low <= r[3] <= high)


def test_numbered_edge_cases(spark, tmp_path):
    empty = NumberedTable.write(spark.createDataFrame([], SCHEMA), str(tmp_path / "e"), ["dep_scheduled_utc"])
    assert empty.numbered().count() == 0 and empty.between("dep_scheduled_utc", 0, 9).count() == 0
    with pytest.raises(IndexError):
        empty.row_at(0)
    with pytest.raises(ValueError):
        NumberedTable.write(spark.createDataFrame([(1, 2)], "part int, a int"), str(tmp_path / "c"), ["a"])
    same = spark.createDataFrame([("k", None)] * 30, "a string, b string")
    table = NumberedTable.write(same, str(tmp_path / "s"), ["a", "b"], parts=4)
    assert sorted(r.row_id for r in table.numbered().collect()) == list(range(30))


@pytest.mark.parametrize("listed", [1000, 2])
def test_index_finds_what_the_scan_finds(spark, tmp_path, monkeypatch, listed):
    monkeypatch.setattr("slotwise.plans.search_index.LISTED_VALUES", listed)
    df = spark.createDataFrame(rows(400), SCHEMA)
    index = SearchIndex.build(df, str(tmp_path / "i"), ["dep_scheduled_utc", "tie"], parts=5)
    numbered = index.table.numbered()
    for limit, wanted in (
        (10, {"dep_iata": "la"}), (1000, {"dep_iata": "ALA"}), (1000, {"arr_iata": "Ist"}), (5, {"flight_iata": "kc1"}),
        (1000, {"flight_iata": "k.1", "dep_iata": "."}), (1000, {"dep_iata": "%"}), (1000, {"dep_iata": "l_"}),
        (7, {"dep_iata": "äla"}), (1000, {"dep_iata": "älaä"}), (3, {}), (1000, {"dep_iata": ""}), (9, {"route": "x"}),
        (1000, {"flight_iata": "KC", "arr_iata": "a", "dep_iata": "ist"}),
    ):
        want = scoring.search(numbered, ["dep_scheduled_utc", "tie"], limit, **wanted).collect()
        got = index.search(limit, **wanted).collect()
        assert sorted(r.row_id for r in want) == [r.row_id for r in got], wanted
        assert {tuple(r) for r in want} == {tuple(r) for r in got}


def test_index_reads_the_parts_of_its_hits_only(spark, tmp_path):
    data = [(f"F{i}", "ALA" if i != 77 else "UNIQUE", "IST", i, i, "x") for i in range(200)]
    index = SearchIndex.build(spark.createDataFrame(data, SCHEMA), str(tmp_path / "i"), ["dep_scheduled_utc"], parts=8)
    found = index.search(10, dep_iata="niq")
    assert [r.flight_iata for r in found.collect()] == ["F77"]
    assert "(part#" in scans(found).split("PartitionFilters")[1].split("]")[0]
    assert [r.value for r in index.matching_values("dep_iata", "QUE").collect()] == ["unique"]
    with pytest.raises(ValueError):
        SearchIndex.build(spark.createDataFrame([(1,)], "a int"), str(tmp_path / "n"), ["a"])
