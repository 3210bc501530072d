"""Exact duplicates by content-defined chunk recipes, DataFrame operations only.

A text without white space is cut where its own content says so, hence equal texts get
equal cuts. A chunk is named by its 64-bit hash once a pass over the distinct chunks
has proved that no other chunk has that hash; chunks that do share one get an ordinal
besides. A document is then the ordered list of its chunk identifiers, and only those
lists, a few bytes per thousand characters, are grouped and joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from slotwise.llm.common import ROW, SPACE, numbered, whole_text, without_rows, written

# A chunk has at least `LEAST` characters, ends after a vowel, one of d l m and one of
# a e h, and is cut at `MOST` characters if no such place comes.
LEAST, MOST = 512, 8192
ENDING = "[aeiou][dlm][aeh]"


def chunks_of(text: Column, least: int = LEAST, most: int = MOST) -> Column:
    pattern = rf"(?s).{{{least - 3},{most - 3}}}?{ENDING}|.{{1,{most}}}"
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def recipes(docs: DataFrame, bits: int = 64, least: int = LEAST, most: int = MOST) -> DataFrame:
    """Rows (_row, doc_id, n_points, text_sha256, recipe) of ``docs`` (_row, doc_id, text).

    Two documents have equal recipes exactly if their texts are equal without white space.
    ``bits`` narrows the chunk hash, for tests of the verification.
    """
    plain = docs.select(
        ROW, "doc_id", F.length("text").alias("n_points"), F.regexp_replace("text", SPACE + "+", "").alias("plain")
    )

    def name(chunk: Column) -> Column:
        h = F.xxhash64(chunk)
        return h if bits == 64 else F.shiftrightunsigned(h, 64 - bits)

    cut = plain.select(ROW, chunks_of(F.col("plain"), least, most).alias("chunks"))
    distinct = (
        cut.select(F.explode("chunks").alias("chunk"))
        .select(name(F.col("chunk")).alias("h"), "chunk")
        .groupBy("h", "chunk")
        .agg(F.count(F.lit(1)).alias("uses"))
    )
    # Hashes that name more than one chunk, with all their chunks: usually none.
    shared = distinct.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("h")
    shared = written(shared, "chunk-clashes")
    clash = not shared.isEmpty()
    if clash:
        # Two scans are joined by number below: both read the written rows.
        plain = written(plain, "numbered-texts")
        cut = plain.select(ROW, chunks_of(F.col("plain"), least, most).alias("chunks"))
    base = plain.select(
        ROW, "doc_id", "n_points", F.sha2("plain", 256).alias("text_sha256"),
        F.transform(chunks_of(F.col("plain"), least, most), name).alias("names"),
    )
    if not clash:
        return base.withColumnRenamed("names", "recipe")
    # The ordinal of a chunk is its place among those of its hash.
    place = F.row_number().over(Window.partitionBy("h").orderBy("chunk")).cast("long")
    ordinal = distinct.join(shared, "h", "left_semi").select("h", "chunk", place.alias("ord"))
    marked = (
        cut.select(ROW, F.posexplode("chunks").alias("at", "chunk"))
        .withColumn("h", name(F.col("chunk")))
        .join(ordinal, ["h", "chunk"])
        .groupBy(ROW)
        .agg(F.array_sort(F.collect_list(F.struct(F.col("at").cast("long").alias("at"), "ord"))).alias("marks"))
        .select(ROW, F.flatten(F.transform("marks", lambda m: F.array(m["at"], m["ord"]))).alias("marks"))
    )
    return base.join(marked, ROW, "left").select(
        ROW, "doc_id", "n_points", "text_sha256",
        F.concat(
            F.array(F.size("names").cast("long")), "names", F.coalesce("marks", F.array().cast("array<bigint>"))
        ).alias("recipe"),
    )


def exact_dedup(docs: DataFrame, bits: int = 64, least: int = LEAST, most: int = MOST) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256 and _row.

    Texts are equal if they are after deleting white space; null is the empty text, and
    all empty texts are one group. Of equal texts the one with the most code points stays,
    then the smallest doc_id (null last), then the first row; so one row of each group is
    kept even where rows repeat whole. keep_id is null only if that row has no doc_id.
    No rows give no rows. Other columns are ignored, whatever their names.
    """
    return _groups(docs.withColumn(ROW, F.monotonically_increasing_id()), bits, least, most)


def _groups(rows: DataFrame, bits: int = 64, least: int = LEAST, most: int = MOST) -> DataFrame:
    made = recipes(rows.select(ROW, "doc_id", whole_text().alias("text")), bits, least, most).withColumn("h", F.xxhash64("recipe"))
    made = written(made, "recipes")
    order = F.struct(-F.col("n_points"), F.col("doc_id").isNull(), F.col("doc_id"), F.col(ROW))
    best = made.groupBy("h", "recipe").agg(
        F.count(F.lit(1)).alias("group_size"), F.min_by(F.struct("doc_id", ROW), order).alias("keep")
    )
    best = best.select("h", "recipe", "group_size", F.col("keep.doc_id").alias("keep_id"), F.col(f"keep.{ROW}").alias("keep_row"))
    # Written, so that the join deals both sides itself and can split a group of very many copies.
    best = written(best, "recipe-groups")
    return made.join(best, ["h", "recipe"]).select(
        "doc_id", "keep_id", "group_size", (F.col(ROW) == F.col("keep_row")).alias("kept"), "text_sha256", ROW
    )


def keep_first_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with all its columns, less the rows that `exact_dedup` does not keep."""
    rows = numbered(docs)
    return without_rows(rows, _groups(rows).filter(~F.col("kept")), docs.columns)
