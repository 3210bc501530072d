"""Repeated passages by a sparse suffix array over words.

Of the suffixes of a text only those at minimisers are retained: positions whose hash of
the next `SEED` words is the least among `SPAN` positions in a row. Every passage of
`PASSAGE` = SEED + SPAN - 1 words holds one, chosen by its content alone, so two copies of
the passage retain the same one. Suffixes are sorted by that hash in buckets, and
neighbours that agree are matches. Matches are extended left and right: all passages of
`PASSAGE` words around a matching suffix are looked up by hash in the same way, and those
that occur twice or more are joined to spans. A span is thus exactly a run of words each
of which lies in a passage of `PASSAGE` words that occurs again somewhere.

Hashes travel packed: one row per block of documents and bucket, distinct within the block,
and one bit per hash goes back. A passage in very many documents costs eight bytes a block.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from slotwise.llm.common import mix, partition_number, pieces, whole_text, written

SEED = 20
SPAN = 31
PASSAGE = SEED + SPAN - 1
# Documents and bytes of text in a block, and hashes that a bucket is meant to hold.
BLOCK_ROWS, BLOCK_BYTES = 8192, 8 << 20
BUCKET = 1 << 18
# Matching suffixes are told to the second pass by a Bloom filter of this many bits, a fixed
# size. Its errors only make the second pass look at more passages.
FILTER_BITS = 1 << 26

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


class Words:
    """The words of a block's documents in a row, with rolling hashes."""

    def __init__(self, texts: list[str]):
        digest = xxhash.xxh3_64_intdigest
        split = [t.encode().translate(LOWER).split() for t in texts]
        self.lengths = np.array([len(w) for w in split], dtype=np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.lengths)]).astype(np.int64)
        known: dict[bytes, int] = {}
        for words in split:
            for word in words:
                if word not in known:
                    known[word] = digest(word)
        total = int(self.first[-1])
        words = np.fromiter((known[w] for part in split for w in part), np.uint64, total)
        powers = np.cumprod(np.full(total + 1, _BASE, dtype=np.uint64))
        self.sums = np.zeros(total + 1, dtype=np.uint64)
        np.cumsum(words * powers[:total], out=self.sums[1:])
        self.inverse = np.cumprod(np.full(total + 1, _INVERSE, dtype=np.uint64))
        # Words from each position to the end of its document.
        ends = np.repeat(self.first[1:], self.lengths)
        self.left = ends - np.arange(total)

    def hashes(self, size: int) -> np.ndarray:
        """Hash of the next ``size`` words at each position, scrambled and never zero; zero
        where the document ends before."""
        total = len(self.left)
        out = np.zeros(total, dtype=np.uint64)
        n = total - size + 1
        if n > 0:
            out[:n] = mix((self.sums[size:] - self.sums[:n]) * self.inverse[:n]) | np.uint64(1)
        out[self.left < size] = 0
        return out

    def minimisers(self) -> tuple[np.ndarray, np.ndarray]:
        """(seeds, least): the seed hashes, and for each position where a passage begins
        the least of its seeds, else zero."""
        seeds = self.hashes(SEED)
        least = _sliding(seeds, SPAN, np.minimum)
        least[self.left < PASSAGE] = 0
        return seeds, least


def _sliding(x: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` over the ``width`` values from each position on; short ends take what is there."""
    out, have = x.copy(), 1
    while have < width:
        step = min(have, width - have)
        if step >= len(out):
            break
        out[:-step] = pick(out[:-step], out[step:])
        have += step
    return out


def retained(words: Words) -> np.ndarray:
    """Seed hashes of the retained suffixes, one entry per suffix."""
    seeds, least = words.minimisers()
    # A position is retained if its seed is the least of some passage that it lies in.
    greatest = _sliding(least[::-1], SPAN, np.maximum)[::-1]
    return seeds[(seeds > 0) & (greatest == seeds)]


def _buckets(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _packed(hashes: np.ndarray, buckets: int):
    """Yield (bucket, distinct hashes in order, a byte for each that is one if it occurs
    more than once)."""
    values, n = np.unique(hashes, return_counts=True)
    cut = np.searchsorted(_buckets(values, buckets), np.arange(buckets + 1))
    for bucket in np.flatnonzero(cut[1:] > cut[:-1]).tolist():
        part = slice(cut[bucket], cut[bucket + 1])
        yield bucket, values[part], (n[part] > 1).astype(np.uint8)


def _repeated(tab: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of a bucket, block after block, and whether each occurs elsewhere too."""
    values = np.concatenate([np.frombuffer(b, np.uint64) for b in tab.column("hashes").to_pylist()])
    many = np.concatenate([np.frombuffer(b, np.uint8) for b in tab.column("many").to_pylist()]).astype(bool)
    order = np.argsort(values, kind="stable")
    same = values[order][1:] == values[order][:-1]
    again = np.zeros(len(values), dtype=bool)
    again[1:] |= same
    again[:-1] |= same
    out = np.empty(len(values), dtype=bool)
    out[order] = again
    return values, out | many


def seed_filter(docs: DataFrame, buckets: int, bits: int) -> bytes:
    """Bloom filter of the seeds that two or more suffixes of ``docs`` (text) begin with.

    A bucket sets a slice of the filter of its own, so the slices just follow each other."""

    def run(batches):
        for tab in pieces(batches, BLOCK_ROWS, BLOCK_BYTES):
            rows = list(_packed(retained(Words(tab.column("text").to_pylist())), buckets))
            yield pa.RecordBatch.from_pydict(
                {"bucket": [b for b, _, _ in rows], "hashes": [h.tobytes() for _, h, _ in rows], "many": [m.tobytes() for _, _, m in rows]},
                schema,
            )

    def slice_of(tab: pa.Table) -> pa.Table:
        values, again = _repeated(tab)
        part = np.zeros(bits // buckets, dtype=np.uint8)
        part[_filter_bits(values[again], bits // buckets)] = 1
        return pa.table({"bucket": tab.column("bucket").slice(0, 1), "bits": pa.array([np.packbits(part).tobytes()], pa.binary())})

    schema = pa.schema([("bucket", pa.int64()), ("hashes", pa.binary()), ("many", pa.binary())])
    found = docs.select("text").mapInArrow(run, "bucket long, hashes binary, many binary")
    filled = found.groupBy("bucket").applyInArrow(slice_of, "bucket long, bits binary").toArrow()
    out = np.zeros((buckets, bits // buckets // 8), dtype=np.uint8)
    for bucket, part in zip(filled.column("bucket").to_pylist(), filled.column("bits").to_pylist()):
        out[bucket] = np.frombuffer(part, np.uint8)
    return out.tobytes()


def _filter_bits(values: np.ndarray, width: int) -> np.ndarray:
    return (mix(values) % np.uint64(width)).astype(np.int64)


def _passes(bloom: np.ndarray, values: np.ndarray, buckets: int, bits: int) -> np.ndarray:
    at = _buckets(values, buckets) * (bits // buckets) + _filter_bits(values, bits // buckets)
    return (bloom[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)


def passages(docs: DataFrame, bloom: bytes, seed_buckets: int, bits: int, buckets: int) -> DataFrame:
    """Passages around matching suffixes. Rows with hashes: (block, bucket, hashes, many).
    Rows with the layout of a block: its documents, and of each passage its document, its
    position and the place of its hash among those of the block."""
    shared = docs.sparkSession.sparkContext.broadcast(bloom)

    def run(batches):
        filled = np.frombuffer(shared.value, np.uint8)
        for serial, tab in enumerate(pieces(batches, BLOCK_ROWS, BLOCK_BYTES)):
            block = partition_number() << 24 | serial
            words = Words(tab.column("text").to_pylist())
            _, least = words.minimisers()
            starts = np.flatnonzero(least)
            starts = starts[_passes(filled, least[starts], seed_buckets, bits)]
            hashes = words.hashes(PASSAGE)[starts]
            values, place = np.unique(hashes, return_inverse=True)
            rows = list(_packed(hashes, buckets))
            yield pa.RecordBatch.from_pydict(
                {
                    "block": [block] * len(rows), "bucket": [b for b, _, _ in rows],
                    "hashes": [h.tobytes() for _, h, _ in rows], "many": [m.tobytes() for _, _, m in rows],
                    **dict.fromkeys(("doc_id", "n_words", "starts", "places"), [None] * len(rows)),
                },
                schema,
            )
            cut = np.searchsorted(starts, words.first)
            some = [i for i in range(tab.num_rows) if cut[i + 1] > cut[i]]
            yield pa.RecordBatch.from_pydict(
                {
                    "block": [block] * len(some), "bucket": [None] * len(some), "hashes": [None] * len(some), "many": [None] * len(some),
                    "doc_id": tab.column("doc_id").take(pa.array(some, pa.int64())).to_pylist(),
                    "n_words": [int(words.lengths[i]) for i in some],
                    "starts": [_steps(starts[cut[i] : cut[i + 1]] - words.first[i]) for i in some],
                    "places": [_planes(place[cut[i] : cut[i + 1]]) for i in some],
                },
                schema,
            )

    names = ("block", "bucket", "hashes", "many", "doc_id", "n_words", "starts", "places")
    kinds = ("long", "long", "binary", "binary", "long", "long", "binary", "binary")
    schema = pa.schema([(n, pa.int64() if k == "long" else pa.binary()) for n, k in zip(names, kinds)])
    return docs.select("doc_id", "text").mapInArrow(run, ", ".join(f"{n} {k}" for n, k in zip(names, kinds)))


def _steps(x: np.ndarray) -> bytes:
    """Ascending numbers as steps, nearly all of them one, which packs well."""
    return np.diff(x, prepend=0).astype("<i4").tobytes()


def _planes(x: np.ndarray) -> bytes:
    """Numbers as four planes of bytes; the planes of the high bytes hold zeros mostly."""
    return x.astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _from_planes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<i4").ravel()


def _told(tab: pa.Table) -> pa.Table:
    """For each block of a bucket: one bit per hash, whether it occurs again."""
    _, again = _repeated(tab)
    sizes = [len(b) // 8 for b in tab.column("hashes").to_pylist()]
    parts = np.split(again, np.cumsum(sizes)[:-1])
    return pa.table(
        {
            "in_block": tab.column("block"), "bucket": tab.column("bucket"), "size": pa.array(sizes, pa.int64()),
            "again": pa.array([np.packbits(p).tobytes() for p in parts], pa.binary()),
        }
    )


def _spans(documents: pa.Table, told: pa.Table) -> pa.Table:
    """Rows (doc_id, start, end, n_words) of a block."""
    told = told.sort_by("bucket")
    bits = [
        np.unpackbits(np.frombuffer(b, np.uint8), count=n).astype(bool)
        for b, n in zip(told.column("again").to_pylist(), told.column("size").to_pylist())
    ]
    again = np.concatenate(bits) if bits else np.empty(0, bool)
    out = {"doc_id": [], "start": [], "end": [], "n_words": []}
    rows = zip(*(documents.column(c).to_pylist() for c in ("doc_id", "n_words", "starts", "places")))
    for doc_id, n_words, starts, places in rows:
        found = np.cumsum(np.frombuffer(starts, "<i4"))[again[_from_planes(places)]]
        if len(found):
            breaks = np.flatnonzero(found[1:] > found[:-1] + PASSAGE) + 1
            for part in np.split(found, breaks):
                for name, value in (("doc_id", doc_id), ("start", int(part[0])), ("end", int(part[-1]) + PASSAGE), ("n_words", n_words)):
                    out[name].append(value)
    return pa.table({n: pa.array(v, pa.int64()) for n, v in out.items()})


def repeated_spans(docs: DataFrame, bits: int = FILTER_BITS, bucket: int = BUCKET) -> DataFrame:
    """One row per span of repeated words: doc_id, start, end, n_words.

    Words are split at white space and compare with A-Z in lower case. start and end (not
    included) count words of the document, n_words are all its words. A span is at least
    `PASSAGE` words long, and each of its words lies in a passage of that length which occurs
    twice or more, in other documents or in the same one. All occurrences are reported, so
    repeated rows are reported whole; documents without a repeat have no row. Null texts and
    texts of fewer words have none either. A null id is kept. No rows give no rows. Other
    columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    letters = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # About one seed in 16 words and at most one passage a word, of six bytes and more each.
    seed_buckets = _power(letters / 96 / bucket)
    passage_buckets = _power(letters / 6 / bucket)
    bloom = seed_filter(rows, seed_buckets, bits)
    made = written(passages(rows, bloom, seed_buckets, bits, passage_buckets), "passages")
    told = (
        made.filter("hashes IS NOT NULL").select("block", "bucket", "hashes", "many").groupBy("bucket")
        .applyInArrow(_told, "in_block long, bucket long, size long, again binary")
    )
    documents = made.filter("starts IS NOT NULL").select("block", "doc_id", "n_words", "starts", "places")
    return documents.groupBy("block").cogroup(told.groupBy("in_block")).applyInArrow(
        _spans, "doc_id long, start long, end long, n_words long"
    )


def _power(x: float) -> int:
    """The power of two next above ``x``, from 8 to 2^20."""
    return 1 << min(20, max(3, int(np.ceil(np.log2(max(x, 1))))))
