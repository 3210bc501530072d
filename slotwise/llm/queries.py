"""The registered queries of this package: thin uses of its operators on the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from slotwise.llm.bpe import encode_documents
from slotwise.llm.common import fold, ship, table
from slotwise.llm.conversation_repair import damaged_and_repaired
from slotwise.llm.decontamination import contaminated
from slotwise.llm.embedding_dedup import near_vectors
from slotwise.llm.embedding_whitening import whiten
from slotwise.llm.exact_dedup import exact_dedup
from slotwise.llm.personal_data import find_personal_data
from slotwise.llm.quality import score_quality
from slotwise.llm.simhash_dedup import simhash_groups
from slotwise.llm.sparse_suffixes import repeated_spans
from slotwise.llm.suffix_tree import score_documents, training_fold
from slotwise.llm.toxicity import score_toxicity
from slotwise.llm.warc import round_trip
from slotwise.session import configure

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        def run(spark: SparkSession, sf: str) -> DataFrame:
            ship(spark)
            return fn(configure(spark), sf)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return register


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query("op1_suffix_tree")
def op1_suffix_tree(spark: SparkSession, sf: str) -> DataFrame:
    return score_documents(table(spark, sf, "documents"), training_fold())


@query(
    "op2_exact_dedup",
    r"""
    WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n,
        sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS text_sha256 FROM documents),
    r AS (SELECT *, row_number() OVER w AS place, first_value(doc_id) OVER w AS keep_id,
        count(*) OVER (PARTITION BY text_sha256) AS group_size
        FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id NULLS LAST))
    SELECT doc_id, keep_id, group_size, place = 1 AS kept, text_sha256 FROM r
    """,
)
def op2_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return exact_dedup(table(spark, sf, "documents")).drop("_row")


@query("op3_quality")
def op3_quality(spark: SparkSession, sf: str) -> DataFrame:
    return score_quality(table(spark, sf, "documents"), table(spark, sf, "labels"), fold(3) == 1)


@query("op4_toxicity")
def op4_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    return score_toxicity(table(spark, sf, "documents"), table(spark, sf, "labels"), fold(5) == 0)


@query(
    "op5_warc",
    r"""
    WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
    d AS (SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS payload_digest,
        sha256(payload) AS k FROM p),
    l AS (SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY k) END AS last_id FROM d)
    SELECT page_id, payload_bytes, payload_digest,
      CASE WHEN last_id IS NOT NULL AND page_id IS DISTINCT FROM last_id THEN 'revisit' ELSE 'response' END AS record_type,
      CASE WHEN last_id IS NOT NULL AND page_id IS DISTINCT FROM last_id THEN last_id END AS refers_to
    FROM l
    """,
)
def op5_warc(spark: SparkSession, sf: str) -> DataFrame:
    read = round_trip(spark, table(spark, sf, "pages"), payloads=False)
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op6_decontamination")
def op6_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return contaminated(table(spark, sf, "documents"), table(spark, sf, "benchmark")).drop("_row")


@query("op7_bpe")
def op7_bpe(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return encode_documents(docs, tokenizer_path(), digests=True)


@query("op8_personal_data")
def op8_personal_data(spark: SparkSession, sf: str) -> DataFrame:
    return find_personal_data(table(spark, sf, "documents"))


@query("op9_sparse_suffixes")
def op9_sparse_suffixes(spark: SparkSession, sf: str) -> DataFrame:
    return repeated_spans(table(spark, sf, "documents"))


@query("op10_simhash_dedup")
def op10_simhash_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return simhash_groups(table(spark, sf, "documents")).select("doc_id", "fingerprint", "component_id")


@query(
    "op13_embedding_dedup",
    """
    WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
    ok AS (SELECT * FROM v WHERE label IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND list_dot_product(e, e) > 0),
    l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.label = b.label AND len(a.e) = len(b.e)
        AND a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
    reach AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT reach.a, l.b FROM reach JOIN l ON reach.b = l.a),
    c AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
    n AS (SELECT a, count(*) AS n_links FROM l GROUP BY a)
    SELECT v.vec_id, coalesce(n_links, 0) AS n_links, component_id, v.vec_id = component_id AS kept
    FROM v JOIN c ON c.a = v.vec_id LEFT JOIN n ON n.a = v.vec_id
    """,
)
def op13_embedding_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return near_vectors(table(spark, sf, "embeddings"))


@query("op12_conversation_repair")
def op12_conversation_repair(spark: SparkSession, sf: str) -> DataFrame:
    return damaged_and_repaired(table(spark, sf, "conversations"))


@query("op11_embedding_whitening")
def op11_embedding_whitening(spark: SparkSession, sf: str) -> DataFrame:
    rows = whiten(table(spark, sf, "embeddings"))
    return rows.withColumn("deviation", F.col("deviation").try_cast("long"))
