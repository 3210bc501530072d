import pytest

from slotwise.llm.bpe import encode_documents
from slotwise.llm.decontamination import clean_documents
from slotwise.llm.exact_dedup import keep_first_copies
from slotwise.llm.queries import tokenizer_path
from slotwise.llm.simhash_dedup import keep_one_of_each

from tests.llm.conftest import words

STAGES = {
    "exact": keep_first_copies,
    "simhash": keep_one_of_each,
    "items": lambda docs: clean_documents(docs, docs.sparkSession.createDataFrame([(1, words(40, 1))], "item_id long, text string")),
}


@pytest.mark.parametrize("stage", sorted(STAGES))
def test_rows_dropped_do_not_depend_on_the_split(spark, make, tmp_path, stage):
    """The files are split otherwise once the stage has planned its result."""
    rows = [(i, words(40, 1 if i == 21 and stage == "items" else 1 + i % 22)) for i in range(24)]
    make(rows).coalesce(1).write.option("parquet.block.size", "2048").parquet(str(tmp_path / "in"))
    docs = spark.read.parquet(str(tmp_path / "in"))
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    try:
        kept = STAGES[stage](docs)
        spark.conf.set(key, "512")
        got = sorted(r.doc_id for r in kept.collect())
    finally:
        spark.conf.set(key, before)
    items = [i for i in range(24) if rows[i][1] != words(40, 1)]
    assert got == (items if stage == "items" else list(range(22)))


@pytest.mark.parametrize("stage", sorted(STAGES))
def test_columns_named_like_the_row_number_come_back(spark, stage):
    rows = [(5 + i, words(40, i), 100 + i, 200 + i) for i in range(3)]
    docs = spark.createDataFrame([*rows, rows[0]], "doc_id long, text string, _row long, meet long")
    kept = STAGES[stage](docs)
    assert kept.columns == docs.columns
    want = {(r[0], r[2], r[3]) for r in rows if stage != "items" or r[1] != words(40, 1)}
    assert {(r["doc_id"], r["_row"], r["meet"]) for r in kept.collect()} == want


def test_encoding_keeps_a_column_named_meet(spark):
    docs = spark.createDataFrame([(1, "some text", 9)], "doc_id long, text string, meet long")
    assert encode_documents(docs, tokenizer_path(), digests=True).first()["meet"] == 9
