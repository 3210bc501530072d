"""Rows and position of a committed table, with runs that are killed at every step."""

import pytest

from slotwise.sources.committed import CommittedTable, Conflict, Version

STEPS = ["_write_rows", "_write_draft", "_rename"]


class Killed(Exception):
    pass


def rows(spark, ids):
    return spark.createDataFrame([(i, f"row {i}") for i in ids], "id long, text string")


def ids(table, version=None):
    df = table.read(version)
    return None if df is None else sorted(r.id for r in df.collect())


@pytest.mark.parametrize("after", [False, True])
@pytest.mark.parametrize("step", STEPS)
@pytest.mark.parametrize("job", ["advance", "compact"])
def test_a_run_killed_at_any_step_leaves_one_version(spark, tmp_path, monkeypatch, job, step, after):
    path = str(tmp_path / "t")
    table = CommittedTable(spark, path)
    table.advance(rows(spark, range(5)), "id")
    table.advance(rows(spark, range(8)), "id")
    old = table.version()
    assert (old.number, old.position, ids(table)) == (2, 7, list(range(8)))
    source = rows(spark, range(12))
    run = (lambda t: t.advance(source, "id")) if job == "advance" else (lambda t: t.compact())
    new = (3, 11, list(range(12))) if job == "advance" else (3, 7, list(range(8)))

    real = getattr(CommittedTable, step)

    def dies(self, *args):
        if after:
            real(self, *args)
        raise Killed

    with monkeypatch.context() as patch:
        patch.setattr(CommittedTable, step, dies)
        with pytest.raises(Killed):
            run(CommittedTable(spark, path))
    # Another process sees one version or the other, never a mixture.
    reader = CommittedTable(spark, path)
    seen = (reader.version().number, reader.version().position, ids(reader))
    published = step == "_rename" and after
    assert seen == (new if published else (2, 7, list(range(8))))
    # Running again ends in the same rows, each once.
    run(reader)
    assert (reader.version().position, ids(reader)) == (new[1], new[2])
    assert ids(reader, old) == list(range(8))
    reader.clear()
    newest = reader.version().number
    assert ids(reader) == new[2] and ids(reader, reader.version(newest - 1)) is not None
    listed = {f for n in (newest - 1, newest) for f in reader.version(n).folders}
    assert {p.name for p in (tmp_path / "t" / "rows").iterdir() if not p.name.startswith(".")} == listed


def test_two_runs_from_one_version(spark, tmp_path):
    table = CommittedTable(spark, str(tmp_path / "t"))
    assert table.version() == Version() and table.read() is None
    first = table.append(rows(spark, [1, 2]), 2, table.version())
    table.append(rows(spark, [3]), 3, first)
    with pytest.raises(Conflict):
        table.append(rows(spark, [4]), 4, first)
    assert (ids(table), table.version().position) == ([1, 2, 3], 3)
    table.append(rows(spark, [4]), None, table.version())
    assert (ids(table), table.version().position) == ([1, 2, 3, 4], 3)


def test_limits_and_nothing_new(spark, tmp_path):
    table, source = CommittedTable(spark, str(tmp_path / "t")), rows(spark, [5, 1, 9, 3, 7])
    seen = []
    while True:
        before, after = table.version(), table.advance(source, "id", limit=2)
        if before == after:
            break
        seen.append(after.position)
    assert seen == [3, 7, 9] and ids(table) == [1, 3, 5, 7, 9]
    assert ids(table, table.version(1)) == [1, 3]
    with pytest.raises(ValueError):
        table.version(9)
