import hashlib
import re
from pathlib import Path

import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from slotwise.llm.queries import ORACLES, QUERIES, tokenizer_path
from tools.check_oracle import compare

from tests.llm.test_simhash_dedup import plain_fingerprint, plain_roots

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="driver tables are not here")


def test_registered():
    names = set(entry.queries())
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= names and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for table in ("documents", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
    df = QUERIES[name](spark, SF)
    cursor = con.execute(ORACLES[name])
    assert compare(df.columns, [tuple(r) for r in df.collect()], [c[0] for c in cursor.description], cursor.fetchall()) is None


def test_stages_agree_with_brute_force(spark, tmp_path):
    """Each stage is held against a plain version of it, on what its predecessor left."""
    left = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = left.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        out = str(tmp_path / name.replace(" ", "-"))
        stage(spark, left, SF).write.parquet(out)
        before, left = left.collect(), spark.read.parquet(out)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert left.columns == columns
        seen[name] = (before, left.collect())

    before, after = seen["toxicity"]
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    clean = [r.doc_id for r in before if toxic.get(r.doc_id) == 0]
    assert len({r.doc_id for r in after} & set(clean)) >= 0.97 * len(clean)

    before, after = seen["exact dedup"]
    best = {}
    for r in before:
        key = re.sub(r"[\x20\x09-\x0D]", "", r.text)
        best[key] = min(best.get(key, (1, 0)), (-len(r.text), r.doc_id))
    assert sorted(r.doc_id for r in after) == sorted(d for _, d in best.values())

    before, after = seen["SimHash near-dedup"]
    before = sorted(before, key=lambda r: r.doc_id)
    fps = [plain_fingerprint(r.text) for r in before]
    roots = plain_roots(len(before), lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 3)
    assert sorted(r.doc_id for r in after) == [before[x].doc_id for x in sorted(set(roots))]

    before, after = seen["benchmark decontamination"]
    items = [re.findall(r"\w+", r.text.lower()) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    parts = [{tuple(i[k : k + 8]) for k in range(len(i) - 7)} for i in items]
    want = []
    for r in before:
        have = re.findall(r"\w+", r.text.lower())
        grams = {tuple(have[k : k + 8]) for k in range(len(have) - 7)}
        if not any(p and len(p & grams) >= 0.3 * len(p) for p in parts):
            want.append(r.doc_id)
    assert sorted(r.doc_id for r in after) == sorted(want)

    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    before, after = seen["BPE encoding and decoding"]
    want = []
    for r in before:
        ids = np.array(tokenizer.encode(r.text, add_special_tokens=False).ids, "<u4")
        want.append((r.doc_id, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(r.text.encode()).hexdigest()))
    assert sorted(map(tuple, after)) == sorted(want)


def test_run_applies_all_stages(spark):
    rows = corpus_pipeline.run(spark, SF)
    assert rows.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert 0 < rows.count() < 200
