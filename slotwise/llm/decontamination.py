"""Benchmark passages in documents, also with other numbers, names and units.

Tokens become a template: numbers, names and units turn into typed placeholders. Windows
of templates are hashed and joined with those of the benchmark. Where windows meet along
one diagonal (document position less item position), the slots behind the placeholders are
compared: one value of the item must stand for one value of the document, kind by kind, else
the windows that cover it are dropped, unless they match word for word. Several values of
the item may stand for one of the document. DataFrame operations only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from slotwise.llm.common import ROW, numbered, whole_text, without_rows, written

WINDOW = 8
# Items of fewer tokens are too short to be told from chance; those between are one window.
LEAST_TOKENS = 5
# Words in a window that are no placeholders, at least.
LEAST_WORDS = 4
# Share of an item's windows that must be met.
SHARE = 0.3
# Benchmark windows, and the numbers of documents that meet one, are broadcast up to this
# many (24 and 8 bytes each), beyond it shuffled.
BROADCAST_ROWS = 1_000_000

# Words that the templates treat as units and as numbers.
UNITS = (
    "mm cm m km inch inches foot feet yard yards mile miles mg g kg ton tons gram grams ounce ounces pound pounds "
    "ml l liter liters litre litres gallon gallons second seconds minute minutes hour hours day days week weeks "
    "month months year years dollar dollars cent cents euro euros percent degree degrees meter meters metre metres "
    "kilometer kilometers kilogram kilograms"
).split()
NUMBERS = (
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen "
    "seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion"
).split()
# A capitalised word after a lower-case letter, digit or comma is a name; the mark tells so.
NAME = r"(?<=[\p{Ll}\p{N},;] )(\p{Lu}\p{Ll}+)"
MARK = "\u0002"


def tokens(text: Column) -> Column:
    """Lower-case words and numbers in order; names carry a mark."""
    plain = F.regexp_replace(F.regexp_replace(text, MARK, " "), r"(?<=\d)[.,](?=\d)", "")
    marked = F.lower(F.regexp_replace(plain, NAME, MARK + "$1"))
    return F.filter(F.split(marked, rf"[^\p{{L}}\p{{N}}{MARK}]+"), lambda t: t != "")


def kind(token: Column) -> Column:
    """n, p or u for numbers, names and units, else null."""
    first = F.substring(token, 1, 1)
    return (
        F.when(first == MARK, "p")
        .when(first.between("0", "9") | token.isin(NUMBERS), "n")
        .when(token.isin(UNITS), "u")
    )


def template(token: Column) -> Column:
    return F.coalesce(F.concat(F.lit("<"), kind(token), F.lit(">")), token)


def windows(hashes: Column, sizes: list[int]) -> Column:
    """Array of (window hash, position) of all windows of the given sizes."""

    def of(size: int) -> Column:
        starts = F.when(F.size(hashes) >= size, F.sequence(F.lit(1), F.size(hashes) - size + 1)).otherwise(
            F.array().cast("array<int>")
        )
        return F.transform(starts, lambda i: F.xxhash64(F.lit(size), F.slice(hashes, i, size)))

    return F.flatten(
        F.array(*[F.transform(of(n), lambda h, i: F.struct(h.alias("hash"), i.alias("at"))) for n in sizes])
    )


def item_windows(benchmark: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Item tokens (item_id, tokens) and windows (item_id, size, hash, at)."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), tokens(whole_text()).alias("tokens"))
    # Equal item ids with other texts are told apart by their text.
    items = items.filter(F.size("tokens") >= LEAST_TOKENS).withColumn("item", F.xxhash64("item_id", "tokens")).distinct()
    size = F.least(F.size("tokens"), F.lit(WINDOW))
    made = items.select(
        "item", "item_id", "tokens", size.alias("size"), F.transform("tokens", lambda t: F.xxhash64(template(t))).alias("hashes")
    )
    starts = F.explode(F.sequence(F.lit(1), F.size("tokens") - F.col("size") + 1)).alias("start")
    cut = made.select("item", "item_id", "tokens", "size", "hashes", starts)
    part = cut.select(
        "item", "item_id", "size", F.xxhash64("size", F.slice("hashes", F.col("start"), F.col("size"))).alias("hash"),
        (F.col("start") - 1).alias("item_at"),
        F.size(F.filter(F.slice("tokens", F.col("start"), F.col("size")), lambda t: kind(t).isNull())).alias("words"),
    )
    return items, part.filter(F.col("words") >= LEAST_WORDS).drop("words")


def contaminated(docs: DataFrame, benchmark: DataFrame, share: float = SHARE) -> DataFrame:
    """One row per document and benchmark item that it holds: doc_id, item_id, n_windows,
    n_matched and _row. Documents that hold none have no row.

    Null texts are empty and hold nothing; items of fewer than five tokens or without a
    window of four plain words are never found; repeated documents each have their rows,
    repeated items one. Rows of ``docs`` without doc_id are reported with a null. An empty
    table on either side gives no rows. Other columns are ignored.
    """
    return _contaminated(numbered(docs.select("doc_id", whole_text().alias("text"))), benchmark, share)


def _contaminated(rows: DataFrame, benchmark: DataFrame, share: float = SHARE) -> DataFrame:
    items, parts = item_windows(benchmark)
    items, parts = written(items, "benchmark-items"), written(parts, "benchmark-windows")
    sizes = sorted(r.size for r in parts.select("size").distinct().collect()) or [WINDOW]
    split = rows.select(ROW, tokens(whole_text()).alias("tokens"))
    hashed = split.select(ROW, F.transform("tokens", lambda t: F.xxhash64(template(t))).alias("hashes"))
    # The position of a window in its document is its place among those of its size.
    met = hashed.select(ROW, F.explode(windows(F.col("hashes"), sizes)).alias("w"))
    met = met.select(ROW, F.col("w.hash").alias("hash"), F.col("w.at").alias("doc_at"))
    small = parts.count() <= BROADCAST_ROWS
    met = met.join(F.broadcast(parts) if small else parts, "hash")
    met = written(met.select(ROW, "item", "item_id", "size", "item_at", "doc_at"), "met-windows")

    place = [ROW, "item", "diagonal"]
    met = met.withColumn("diagonal", F.col("doc_at") - F.col("item_at"))
    # Only the few documents that meet a window are split again, and their texts not shuffled for it.
    touched = written(met.select(ROW).distinct(), "met-rows")
    touched = F.broadcast(touched) if touched.count() <= BROADCAST_ROWS else touched
    again = rows.join(touched, ROW, "left_semi").select(ROW, tokens(whole_text()).alias("tokens"))
    dropped = inconsistent(met, written(slots(met, items, again), "slots"))
    good = met.join(dropped, [*place, "item_at"], "left_anti")
    total = parts.groupBy("item").agg(F.count(F.lit(1)).alias("n_windows"))
    found = good.groupBy(ROW, "item", "item_id").agg(F.countDistinct("item_at").alias("n_matched"))
    found = found.join(total, "item").filter(F.col("n_matched") >= share * F.col("n_windows"))
    return found.join(rows.select(ROW, "doc_id"), ROW).select("doc_id", "item_id", "n_windows", "n_matched", ROW)


def slots(met: DataFrame, items: DataFrame, split: DataFrame) -> DataFrame:
    """Values behind equal placeholders: (_row, item, diagonal, item_token, kind, theirs, ours)."""
    theirs = items.select("item", F.posexplode("tokens").alias("item_token", "theirs"))
    theirs = theirs.withColumn("kind", kind(F.col("theirs"))).filter("kind IS NOT NULL")
    pairs = met.select(
        ROW, "item", "diagonal",
        F.explode(F.sequence(F.col("item_at"), F.col("item_at") + F.col("size") - 1)).alias("item_token"),
    )
    pairs = pairs.join(theirs, ["item", "item_token"]).distinct()
    ours = split.select(ROW, F.posexplode("tokens").alias("doc_token", "ours")).filter(kind(F.col("ours")).isNotNull())
    pairs = pairs.withColumn("doc_token", F.col("item_token") + F.col("diagonal"))
    return pairs.join(ours, [ROW, "doc_token"]).select(
        ROW, "item", "diagonal", "item_token", "kind", "theirs", "ours"
    )


def inconsistent(met: DataFrame, values: DataFrame) -> DataFrame:
    """Windows (_row, item, diagonal, item_at) to drop: they cover a value of the item that
    stands for several of the document on the diagonal, and do not match word for word."""
    place = [ROW, "item", "diagonal"]
    several = values.groupBy(*place, "kind", "theirs").agg(F.count_distinct("ours").alias("n")).filter("n > 1")
    several = written(several.select(*place, "kind", "theirs"), "inconsistent-values")
    diagonals = several.select(*place).distinct()
    # Unlike slots of a consistent value matter too: a window that covers one is not verbatim.
    marked = values.join(diagonals, place, "left_semi").join(several.withColumn("bad", F.lit(True)), [*place, "kind", "theirs"], "left")
    marked = marked.select(*place, "item_token", F.coalesce("bad", F.lit(False)).alias("bad"), (F.col("theirs") != F.col("ours")).alias("other"))
    covered = met.join(diagonals, place, "left_semi").select(
        *place, "item_at", F.explode(F.sequence(F.col("item_at"), F.col("item_at") + F.col("size") - 1)).alias("item_token")
    )
    covered = covered.join(marked, [*place, "item_token"]).groupBy(*place, "item_at")
    return covered.agg(F.max("bad").alias("bad"), F.max("other").alias("other")).filter("bad AND other").select(*place, "item_at")


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` with all its columns, less the documents that hold a benchmark item."""
    rows = numbered(docs)
    return without_rows(rows, _contaminated(rows, benchmark).select(ROW).distinct(), docs.columns)
