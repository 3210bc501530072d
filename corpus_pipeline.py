"""The corpus pipeline: documents in, clean and encoded documents out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet
and read again as the next stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from slotwise.llm.bpe import encode_documents
from slotwise.llm.common import collecting, discard, fold, ship, table, written
from slotwise.llm.decontamination import clean_documents
from slotwise.llm.exact_dedup import keep_first_copies
from slotwise.llm.queries import tokenizer_path
from slotwise.llm.simhash_dedup import keep_one_of_each
from slotwise.llm.toxicity import without_toxic
from slotwise.session import configure


# Working tables of the stage before, which its written result no longer needs.
_left: list[str] = []


def _stage(first: bool = False):
    """A stage that deletes its predecessor's working tables; the first one begins anew."""

    def wrap(fn):
        @wraps(fn)
        def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
            if not first:
                discard(spark, _left)
            _left.clear()
            with collecting() as made:
                out = fn(spark, docs, sf_dir)
            _left.extend(made)
            return out

        return run_stage

    return wrap


@_stage(first=True)
def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier scores 0.5 or more go."""
    ship(configure(spark))
    return without_toxic(docs, table(spark, sf_dir, "labels"), fold(5) == 0)


@_stage()
def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal but for white space the longest stays, then the smallest id."""
    return keep_first_copies(docs)


@_stage()
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of fingerprints that differ in at most 3 bits the smallest id stays."""
    ship(configure(spark))
    return keep_one_of_each(docs)


@_stage()
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return clean_documents(docs, table(spark, sf_dir, "benchmark"))


@_stage()
def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, encoded: doc_id, n_tokens and digests of the ids and the decoded text."""
    ship(configure(spark))
    return encode_documents(docs.select("doc_id", "text"), tokenizer_path(), digests=True)


STAGES = [
    ("toxicity", toxicity),
    ("exact dedup", exact_dedup),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("BPE encoding and decoding", encoding),
]

# A trained classifier, fingerprints and BPE are beyond SQL: tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    before: list[str] = []
    for name, stage in STAGES[:-1]:
        planned = stage(spark, docs, sf_dir)
        with collecting() as made:
            docs = written(planned, name.replace(" ", "-"))
        discard(spark, before)
        before = made
    return STAGES[-1][1](spark, docs, sf_dir)
