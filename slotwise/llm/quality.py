"""Quality scores: ridge regression on random Fourier features of document statistics.

Each text is turned into a few dozen statistics once. Random cosines of the standardised
statistics approximate a Gaussian kernel; partitions of the labelled rows sum their part of
the normal equations, which are solved once; the scores are made probabilities by isotonic
regression over binned training scores.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from slotwise.llm.common import partition_number, summed, whole_text, written

FEATURES = 256
# Width of the Gaussian kernel, in standard deviations times the root of their number.
WIDTH = 0.8
RIDGE = 1.0
SEED = 3
# Training scores are calibrated in bins of this width between these bounds.
BIN, LOWEST, HIGHEST = 0.002, -1.0, 2.0

_CLASSES = {
    "upper": range(65, 91), "lower": range(97, 123), "digit": range(48, 58), "space": (32, 9),
    "stop": (46, 63), "comma": (44, 59, 58), "bang": (33,), "bar": (124,), "mark": b"#$%&*+/<=>@[]^_{}~\\`",
    "quote": b"\"'()-", "line": (10,), "high": range(128, 256),
}
_TABLE = np.zeros((256, len(_CLASSES)))
for _i, _members in enumerate(_CLASSES.values()):
    _TABLE[list(_members), _i] = 1

STATISTICS = [
    "log_bytes", "log_words", *_CLASSES, "word_mean", "word_spread", "short_words", "long_words", "distinct", "top_word",
    "top_five", "same_again", "pair_again", "entropy", "titled", "shouted", "odd_ends", "line_words", "line_again", "longest_line",
]


def statistics(text: str) -> np.ndarray:
    """The statistics of a text; of an empty one they are all zero."""
    data = text.encode()
    out = np.zeros(len(STATISTICS))
    words = text.split()
    if not words:
        return out
    shares = np.bincount(np.frombuffer(data, np.uint8), minlength=256) @ _TABLE / len(data)
    n = len(words)
    lengths = np.fromiter(map(len, words), np.int64, n)
    counts = Counter(w.lower() for w in words)
    top = np.array(sorted(counts.values(), reverse=True), dtype=np.float64)
    p = top / n
    again = sum(a == b for a, b in zip(words, words[1:]))
    pairs = len(set(zip(words, words[1:])))
    lines = [x for x in text.split("\n") if x.strip()]
    widths = [len(x) for x in lines]
    out[:] = [
        np.log(len(data)), np.log(n), *shares, lengths.mean(), lengths.std(), (lengths <= 3).mean(), (lengths >= 14).mean(),
        len(counts) / n, p[0], p[:5].sum(), again / n, 1 - pairs / max(1, n - 1) if n > 1 else 0.0,
        -(p * np.log(p)).sum() / np.log(n + 1), sum(w.istitle() for w in words) / n, sum(w.isupper() for w in words) / n,
        sum(not (w[-1].isalpha() or w[-1] in ".,") for w in words) / n, np.log(n / len(lines)),
        1 - len(set(lines)) / len(lines), np.log(max(widths)),
    ]
    return out


def statistics_table(docs: DataFrame, held_out: Column) -> DataFrame:
    """Rows (doc_id, held_out, stats) of ``docs`` (doc_id, text)."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                stats = [statistics(t).tolist() for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_pydict(
                    {"doc_id": part.column("doc_id"), "held_out": part.column("held_out"), "stats": stats}, schema
                )

    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("stats", pa.list_(pa.float64()))])
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), whole_text().alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, stats array<double>")


class Features:
    """Random cosines of standardised statistics, and a constant."""

    def __init__(self, mean: np.ndarray, spread: np.ndarray, size: int = FEATURES, seed: int = SEED):
        draw = np.random.Generator(np.random.PCG64(seed))
        self.mean, self.scale = mean, np.where(spread > 1e-9, spread, 1.0)
        self.weights = draw.normal(size=(len(mean), size)) / (WIDTH * np.sqrt(len(mean)))
        self.phases = draw.uniform(0, 2 * np.pi, size)

    def __call__(self, stats: np.ndarray) -> np.ndarray:
        x = np.clip((stats - self.mean) / self.scale, -8, 8)
        z = np.cos(x @ self.weights + self.phases) * np.sqrt(2 / len(self.phases))
        return np.concatenate([z, np.ones((len(z), 1))], axis=1)


def _stats(batch) -> np.ndarray:
    column = batch.column("stats")
    return column.flatten().to_numpy().reshape(batch.num_rows, -1)


def normal_equations(labelled: DataFrame, features: Features) -> tuple[np.ndarray, np.ndarray] | None:
    """Sums over ``labelled`` (stats, label) of z z' and z y."""
    size = len(features.phases) + 1

    def run(batches):
        total = np.zeros((size, size + 1))
        for batch in batches:
            if batch.num_rows:
                z = features(_stats(batch))
                y = batch.column("label").to_numpy().astype(np.float64)
                total += z.T @ np.concatenate([z, y[:, None]], axis=1)
        yield pa.RecordBatch.from_pydict({"part": [partition_number()], "value": [total.tobytes()]})

    sums = summed(labelled.select("stats", "label").mapInArrow(run, "part long, value binary"))
    if sums is None:
        return None
    sums = sums.reshape(size, size + 1)
    return sums[:, :size], sums[:, size]


def isotonic(x: np.ndarray, n: np.ndarray, positive: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over bins in order of x; points to interpolate between."""
    blocks: list[list[float]] = []  # first x, last x, rows, positives
    for a, rows, ones in zip(x.tolist(), n.tolist(), positive.tolist()):
        blocks.append([a, a, rows, ones])
        while len(blocks) > 1 and blocks[-2][3] * blocks[-1][2] >= blocks[-1][3] * blocks[-2][2]:
            _, last, rows, ones = blocks.pop()
            blocks[-1][1:] = [last, blocks[-1][2] + rows, blocks[-1][3] + ones]
    # The share of a block counts one row of either kind besides, so it is never 0 or 1.
    points = [(edge, (b[3] + 0.5) / (b[2] + 1)) for b in blocks for edge in dict.fromkeys(b[:2])]
    heights = np.maximum.accumulate(np.array([y for _, y in points]))
    return np.array([a for a, _ in points]), heights


def score_quality(docs: DataFrame, labels: DataFrame, held_out: Column, label: str = "quality") -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    Learns from ``labels`` (doc_id, label 0 or 1) of documents for which the column
    ``held_out`` is false. Null labels and labels without a document count for nothing; of
    repeated ids each match is an example. Null texts are empty, whose statistics are all
    zero and which get a score like any other; a null id is kept and has no label. Without
    any example every score is 0.5. No rows give no rows. Other columns are ignored.
    """
    made = written(statistics_table(docs, held_out), "quality-statistics")
    width = len(STATISTICS)
    sums = made.agg(
        *[F.avg(F.col("stats")[i]).alias(f"m{i}") for i in range(width)],
        *[F.stddev_pop(F.col("stats")[i]).alias(f"s{i}") for i in range(width)],
    ).first()
    values = np.array([0.0 if v is None else v for v in sums])
    features = Features(values[:width], values[width:])
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    marked = marked.filter("doc_id IS NOT NULL AND label IS NOT NULL")
    examples = made.filter("NOT held_out").join(marked, "doc_id").select("stats", "label")
    equations = normal_equations(examples, features)
    if equations is None or equations[0][-1, -1] == 0:
        return made.select("doc_id", "held_out", F.lit(0.5).alias("score"), F.lit(1).alias("predicted"))
    gram, moments = equations
    penalty = RIDGE * np.eye(len(gram))
    penalty[-1, -1] = 0
    weights = np.linalg.solve(gram + penalty, moments)

    def raw(batches):
        for batch in batches:
            if batch.num_rows:
                x = np.clip(features(_stats(batch)) @ weights, LOWEST, HIGHEST)
                bins = np.round(x / BIN).astype(np.int64)
                yield pa.RecordBatch.from_pydict({"bin": bins, "label": batch.column("label").cast(pa.int64())})

    binned = examples.mapInArrow(raw, "bin long, label long").groupBy("bin")
    table = binned.agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("ones")).orderBy("bin").collect()
    edges, heights = isotonic(*(np.array([r[i] for r in table], dtype=np.float64) for i in range(3)))

    def score(batches):
        for batch in batches:
            if batch.num_rows:
                x = np.clip(features(_stats(batch)) @ weights, LOWEST, HIGHEST) / BIN
                p = np.interp(x, edges, heights)
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"), "score": p,
                        "predicted": (p >= 0.5).astype(np.int32),
                    }
                )

    return made.mapInArrow(score, "doc_id long, held_out boolean, score double, predicted int")
