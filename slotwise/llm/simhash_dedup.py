"""SimHash near-duplicates through an inverted index on the bytes of the fingerprints.

Two fingerprints of eight bytes that differ in at most three bits differ in at most
three bytes, so at least five positional bytes are equal. The index therefore has one
list for every five positions and their byte values. Pairs are looked for within a list:
their equal positional bytes are tallied, pairs with fewer than five go, and the bits of
the others are compared. Lists of single bytes would hold nearly all documents each.

Each list yields no more links than it has fingerprints: a spanning forest of its pairs,
which connects whatever its pairs connect.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from slotwise.llm.common import ROW, numbered, pieces, with_text, without_rows, written
from slotwise.llm.components import components

WORDS = 3
SEED = 42
BITS = 3  # fingerprints link at this many differing bits or fewer
BYTES = 8
LEAST_EQUAL = BYTES - BITS
_ALL = (1 << 64) - 1

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(text: bytes, words: int = WORDS, seed: int = SEED) -> int:
    """Majority of the bits of the shingles' hashes; a text without words gives zero."""
    tokens = text.translate(LOWER).split()
    if not tokens:
        return 0
    size = min(words, len(tokens))
    joined = b" ".join(tokens)
    ends = np.cumsum([len(t) + 1 for t in tokens]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()][: len(tokens) - size + 1]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], seed) for a, b in zip(starts, ends[size - 1 :].tolist())], dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 14):
        part = hashes[at : at + (1 << 14)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """Rows (_row, doc_id, fp) of ``docs`` (_row, doc_id, text); fp is the signed 64-bit value."""

    def run(batches):
        for tab in pieces(batches, 1 << 14, 8 << 20):
            texts = tab.column("text").to_pylist()
            fps = np.array([fingerprint(t.encode()) for t in texts], dtype=np.uint64).view(np.int64)
            yield from tab.drop_columns(["text"]).append_column("fp", pa.array(fps)).to_batches()

    return docs.select(ROW, "doc_id", "text").mapInArrow(run, f"{ROW} long, doc_id long, fp long")


def _lists(fps: DataFrame) -> DataFrame:
    """Rows (positions, bytes, fp): the lists of the index that a fingerprint is in."""
    masks = []
    for number, chosen in enumerate(combinations(range(BYTES), LEAST_EQUAL)):
        mask = sum(0xFF << (8 * p) for p in chosen)
        masks.append(F.struct(F.lit(number).alias("positions"), F.lit(mask - (mask >> 63 << 64)).alias("mask")))
    return fps.select("fp", F.explode(F.array(*masks)).alias("m")).select(
        F.col("m.positions").alias("positions"), F.col("fp").bitwiseAND(F.col("m.mask")).alias("bytes"), "fp"
    )


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices (node, root) that connect what the pairs (a, b) of 0..n-1 connect."""
    root = np.arange(n)
    while True:
        ra, rb = root[a], root[b]
        apart = ra != rb
        if not apart.any():
            break
        np.minimum.at(root, np.maximum(ra[apart], rb[apart]), np.minimum(ra[apart], rb[apart]))
        while (root[root] != root).any():
            root = root[root]
    moved = np.flatnonzero(root != np.arange(n))
    return moved, root[moved]


def _near(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of ``values`` (unique, uint64) that pass the count filter and the bit check."""
    left, right = [], []
    block = max(1, (1 << 20) // len(values))
    for at in range(0, len(values), block):
        x = values[at : at + block, None] ^ values[None, :]
        equal = (x.view(np.uint8).reshape(*x.shape, BYTES) == 0).sum(axis=2)
        i, j = np.nonzero(equal >= LEAST_EQUAL)
        keep = i + at < j
        i, j = i[keep], j[keep]
        near = np.bitwise_count(x[i, j]) <= BITS
        left.append(i[near] + at)
        right.append(j[near])
    return np.concatenate(left), np.concatenate(right)


def _flips(free: list[int]) -> np.ndarray:
    """All values with one to BITS ones among the bits of the bytes ``free``."""
    bits = [1 << (8 * p + k) for p in free for k in range(8)]
    return np.array([sum(c) for n in range(1, BITS + 1) for c in combinations(bits, n)], dtype=np.uint64)


def _list_links(positions: int, values: list[int]) -> list[tuple[int, int]]:
    """Links of one list. It holds distinct fingerprints that agree in five bytes, hence
    2^24 at most. A long list is not compared pair by pair: every value at up to three bits
    from a member is looked up, 2,324 of them, one after the other."""
    if len(values) < 8:
        return [(x, y) for x, y in combinations(values, 2) if _tally(x ^ y) and ((x ^ y) & _ALL).bit_count() <= BITS]
    sorted_values = np.sort(np.array(values, dtype=np.int64).view(np.uint64))
    chosen = list(combinations(range(BYTES), LEAST_EQUAL))[positions]
    flips = _flips([p for p in range(BYTES) if p not in chosen])
    if len(values) <= 2 * len(flips):
        node, root = _forest(len(values), *_near(sorted_values))
    else:
        node, root = _flipped(sorted_values, flips)
    signed = sorted_values.view(np.int64)
    return list(zip(signed[node].tolist(), signed[root].tolist()))


def _tally(x: int) -> bool:
    """Whether enough positional bytes of a pair are equal, given its exclusive or."""
    return sum(not x >> 8 * p & 0xFF for p in range(BYTES)) >= LEAST_EQUAL


def _flipped(values: np.ndarray, flips: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    nodes, roots = np.empty(0, np.int64), np.empty(0, np.int64)
    every = np.arange(len(values))
    for flip in flips:
        # Members pairwise equal in the list's bytes differ from the flipped value in bits.
        other = values ^ flip
        at = np.minimum(np.searchsorted(values, other), len(values) - 1)
        hit = (values[at] == other) & (every < at)
        if hit.any():
            nodes, roots = _forest(len(values), np.concatenate([nodes, every[hit]]), np.concatenate([roots, at[hit]]))
    return nodes, roots


def links(fps: DataFrame) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fps`` (fp) that connect all near ones."""

    def run(batches):
        for batch in batches:
            found = []
            for number, values in zip(batch.column("positions").to_pylist(), batch.column("fps")):
                found += _list_links(number, values.as_py())
            yield pa.RecordBatch.from_pydict({"a": [x for x, _ in found], "b": [y for _, y in found]}, schema)

    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    # A fingerprint is in 56 lists: the few partitions of a small table would each make very many rows.
    fps = fps.repartition(int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions")), "fp")
    lists = _lists(fps).groupBy("positions", "bytes").agg(F.collect_list("fp").alias("fps"))
    return lists.filter(F.size("fps") > 1).select("positions", "fps").mapInArrow(run, "a long, b long").distinct()


def simhash_groups(docs: DataFrame) -> DataFrame:
    """One row per document: _row, doc_id, fingerprint, component_id, component_key.

    Null is the empty text; texts without words have fingerprint zero and link like any
    other. Equal fingerprints are one node of the graph, so copies, ties and repeated rows
    cost nothing there. component_id is the smallest doc_id of the component, null if no
    row of it has a doc_id; component_key, a fingerprint, tells components apart in any
    case. No rows give no rows. Other columns are ignored.
    """
    # The fingerprints are written, and nothing goes back to the documents by number.
    return _groups(docs.withColumn(ROW, F.monotonically_increasing_id()))


def _groups(rows: DataFrame) -> DataFrame:
    fps = written(fingerprints(with_text(rows)), "fingerprints")
    distinct = written(fps.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "distinct-fingerprints")
    roots = components(links(distinct.select("fp"))).withColumnRenamed("node", "fp")
    nodes = distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = nodes.groupBy("root").agg(F.min("least_id").alias("component_id"))
    found = nodes.select("fp", "root").join(least, "root")
    return fps.join(found, "fp").select(
        ROW, "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id",
        F.col("root").alias("component_key"),
    )


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` with all its columns, less all but one document of each component.

    The row with the smallest doc_id stays (null last), of equal ones the first row.
    """
    rows = numbered(docs)
    found = written(_groups(rows), "simhash-groups")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", ROW)
    best = found.groupBy("component_key").agg(F.min_by(ROW, order).alias("keep"))
    dropped = found.join(best, "component_key").filter(F.col(ROW) != F.col("keep"))
    return without_rows(rows, dropped, docs.columns)
