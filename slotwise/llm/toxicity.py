"""Toxicity by weak supervision: many voters, a generative label model, a linear classifier.

Voters are lexicons, induced from a bounded sample of labelled rows and dealt to several
voters of words and of word stems, and fixed patterns. The label model sees the votes of
all documents: expectation maximisation estimates how each voter votes given the class, and
from the votes' correlations within a class how much of its evidence others repeat. A
logistic regression on single lexicon terms and patterns is trained on the posteriors of
the sample, and scores every document.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from slotwise.llm.common import partition_number, summed, whole_text, written

# Labelled rows to learn from, at most: those with the least hashes of their ids.
EXAMPLES = 20_000
# Lexicon terms: their log odds, the likelihood-ratio statistic of their counts (so high since
# very many terms are tried) and how many words, and stems, at most.
ODDS, EVIDENCE, TERMS = 2.0, 40.0, 4000
WORD_VOTERS = STEM_VOTERS = 8
STEMS = (4, 5, 6)
ROUNDS = 8
RIDGE = 0.3

WORD = re.compile(r"[^\W\d_]+")
# Patterns that may go with abuse; the label model learns what they are worth.
PATTERNS = {
    "bangs": re.compile(r"!{2,}"),
    "masked": re.compile(r"[^\W\d_][*#@$%]{2,}"),
    "drawn_out": re.compile(r"([^\W\d_])\1{3,}"),
    "shouted": re.compile(r"(?:[A-Z]{4,}[^\w]+){3}"),
}
VOTERS = WORD_VOTERS + STEM_VOTERS + 3 + len(PATTERNS)


def terms_of(words: set[str]) -> set[str]:
    """Words, and stems of several lengths with a star."""
    return words | {w[:n] + "*" for w in words for n in STEMS if len(w) >= n}


@dataclass
class Model:
    """Lexicon, voters and weights; small whatever the corpus."""

    terms: dict[str, int] = field(default_factory=dict)  # term -> its number
    weights: np.ndarray | None = None  # of terms, patterns and the constant
    prior: np.ndarray | None = None
    votes: np.ndarray | None = None  # voter, vote + 1, class: probability of the vote
    shares: np.ndarray | None = None  # what part of a voter's evidence is its own

    def __post_init__(self):
        self._memo: dict[str, tuple[int, ...]] = {}

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_memo"}

    def __setstate__(self, state):
        self.__dict__.update(state, _memo={})

    def look(self, text: str) -> tuple[list[int], list[int], list[int]]:
        """Votes (-1, 0, 1), numbers of the terms found, and patterns found (0, 1)."""
        words = set(WORD.findall(text.lower()))
        if len(self._memo) > 200_000:
            self._memo.clear()
        hits: set[int] = set()
        for word in words:
            found = self._memo.get(word)
            if found is None:
                found = self._memo[word] = tuple(self.terms[t] for t in terms_of({word}) if t in self.terms)
            hits.update(found)
        patterns = [int(p.search(text) is not None) for p in PATTERNS.values()]
        votes = [0] * VOTERS
        of_words = of_stems = 0
        for number in hits:
            stem = number >= TERMS
            of_stems += stem
            of_words += not stem
            votes[(WORD_VOTERS + number % STEM_VOTERS) if stem else number % WORD_VOTERS] = 1
        at = WORD_VOTERS + STEM_VOTERS
        votes[at] = 1 if of_words >= 2 else 0
        votes[at + 1] = 0 if of_words else -1
        votes[at + 2] = 0 if of_stems else -1
        votes[at + 3 :] = patterns
        return votes, sorted(hits), patterns

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """Probability of the toxic class of rows of votes."""
        with np.errstate(divide="ignore"):
            logs = np.log(self.votes)
        picked = logs[np.arange(VOTERS)[None, :], votes + 1]  # row, voter, class
        total = np.log(self.prior) + (picked * self.shares[None, :, None]).sum(axis=1)
        return 1 / (1 + np.exp(np.clip(total[:, 0] - total[:, 1], -50, 50)))

    def score(self, hits, patterns) -> np.ndarray:
        """Probability by the linear classifier."""
        if self.weights is None:
            return np.full(len(hits), 0.5)
        z = np.full(len(hits), self.weights[-1])
        for i, (found, pattern) in enumerate(zip(hits, patterns)):
            z[i] += self.weights[list(found)].sum() + self.weights[2 * TERMS : 2 * TERMS + len(PATTERNS)] @ np.array(pattern)
        return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def examples_of(labels: DataFrame, held_out: Column, label: str, limit: int) -> DataFrame:
    """At most ``limit`` labelled ids that are not held out: (doc_id, label), least hash first."""
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    marked = marked.filter("doc_id IS NOT NULL AND label IS NOT NULL").filter(~held_out)
    marked = marked.groupBy("doc_id").agg(F.max("label").alias("label"))
    return marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)


def unlike(examples: DataFrame) -> DataFrame:
    """One of the ``examples`` (doc_id, text, label) of each least hash of three words in a row, the
    one of the smallest doc_id, then text, then label: copies of a text, also changed ones, are not
    evidence for its words many times over."""

    @F.pandas_udf("long")
    def least(texts):
        out = []
        for text in texts:
            words = text.lower().split() or [""]
            threes = (" ".join(words[i : i + 3]).encode() for i in range(max(1, len(words) - 2)))
            out.append(min(map(xxhash.xxh3_64_intdigest, threes)) >> 1)
        return _series(out).astype("int64")

    first = F.min(F.struct("doc_id", "text", "label")).alias("first")
    return examples.withColumn("key", least("text")).groupBy("key").agg(first).select("first.*")


def induce(examples: DataFrame) -> dict[str, int]:
    """Lexicon from ``examples`` (text, label): words get numbers below `TERMS`, stems from there."""

    def run(batches):
        for batch in batches:
            counts = {0: Counter(), 1: Counter()}
            rows = Counter()
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
                counts[label].update(terms_of(set(WORD.findall(text.lower()))))
                rows[label] += 1
            terms = list(counts[0].keys() | counts[1].keys())
            yield pa.RecordBatch.from_pydict(
                {
                    "term": ["", *terms], "clean": [rows[0], *(counts[0][t] for t in terms)],
                    "toxic": [rows[1], *(counts[1][t] for t in terms)],
                }
            )

    counted = examples.select("text", F.when(F.col("label") > 0, 1).otherwise(0).alias("label")).mapInArrow(
        run, "term string, clean long, toxic long"
    )
    counted = written(counted.groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")), "terms")
    rows = counted.filter("term = ''").first()
    if rows is None or not rows.toxic or not rows.clean:
        return {}
    toxic, clean, share = F.col("toxic"), F.col("clean"), rows.toxic / (rows.toxic + rows.clean)
    odds = F.log((toxic + 0.5) / (rows.toxic + 1)) - F.log((clean + 0.5) / (rows.clean + 1))
    both = toxic + clean
    evidence = 2 * (
        toxic * F.log(F.greatest(toxic, F.lit(1)) / both / share)
        + clean * F.log(F.greatest(clean, F.lit(1)) / both / (1 - share))
    )
    strong = counted.filter(F.col("term") != "").withColumn("evidence", evidence)
    strong = strong.filter((odds >= ODDS) & (F.col("evidence") >= EVIDENCE))
    found = {}
    for base, kind in ((0, ~F.col("term").endswith("*")), (TERMS, F.col("term").endswith("*"))):
        best = strong.filter(kind).orderBy(F.desc("evidence"), "term").limit(TERMS).select("term").collect()
        found |= {r.term: base + i for i, r in enumerate(best)}
    return found


def _sums(model: Model, votes: np.ndarray, rows: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Sufficient statistics of the label model: per class the rows, the votes, and how often
    two voters speak together."""
    p = np.where(label >= 0, label, model.posterior(votes))
    spoke = (votes != 0).astype(np.float64)
    out = []
    for weight in ((1 - p) * rows, p * rows):
        kinds = np.stack([((votes == v) * weight[:, None]).sum(axis=0) for v in (-1, 0, 1)], axis=1)
        out += [[weight.sum()], kinds.ravel(), ((spoke * weight[:, None]).T @ spoke).ravel()]
    return np.concatenate(out)


def _update(model: Model, sums: np.ndarray, correlate: bool) -> None:
    n, size = VOTERS, 1 + 3 * VOTERS + VOTERS * VOTERS
    totals, votes, together = [], [], []
    for part in (sums[:size], sums[size:]):
        totals.append(part[0])
        votes.append(part[1 : 1 + 3 * n].reshape(n, 3))
        together.append(part[1 + 3 * n :].reshape(n, n))
    totals = np.array(totals)
    model.prior = (totals + 1) / (totals.sum() + 2)
    # A vote that was never seen keeps a small probability in either class.
    model.votes = np.stack([(v + 0.5) / (t + 1.5) for v, t in zip(votes, totals)], axis=2)
    if correlate:
        repeated = np.zeros(n)
        for part, total in zip(together, totals):
            mean = np.diag(part) / max(total, 1)
            spread = np.sqrt(np.maximum(mean * (1 - mean), 1e-12))
            correlation = (part / max(total, 1) - np.outer(mean, mean)) / np.outer(spread, spread)
            np.fill_diagonal(correlation, 0)
            repeated += total / max(totals.sum(), 1) * np.clip(correlation, 0, 1).sum(axis=1)
        model.shares = 1 / (1 + repeated)


def fit_labels(model: Model, looks: DataFrame) -> None:
    """Expectation maximisation over the distinct vote rows of ``looks`` (votes, label).

    ``label`` is null where it is unknown. Starts from the examples' own votes."""

    def unpacked(batch):
        votes = np.frombuffer(b"".join(batch.column("votes").to_pylist()), np.int8).reshape(-1, VOTERS).astype(np.int64)
        label = batch.column("label").fill_null(-1).to_numpy().astype(np.float64)
        return votes, batch.column("n").to_numpy().astype(np.float64), label

    def step(rows: DataFrame) -> np.ndarray | None:
        def run(batches):
            total = np.zeros(2 * (1 + 3 * VOTERS + VOTERS * VOTERS))
            for batch in batches:
                if batch.num_rows:
                    votes, n, label = unpacked(batch)
                    total += _sums(model, votes, n, label)
            yield pa.RecordBatch.from_pydict({"part": [partition_number()], "value": [total.tobytes()]})

        return summed(rows.mapInArrow(run, "part long, value binary"))

    rows = written(looks.groupBy("votes", "label").agg(F.count(F.lit(1)).alias("n")), "votes")
    model.prior, model.shares = np.array([0.9, 0.1]), np.ones(VOTERS)
    model.votes = np.full((VOTERS, 3, 2), 1 / 3)
    for number in range(ROUNDS):
        sums = step(rows.filter("label IS NOT NULL") if number == 0 else rows)
        if sums is None:
            return
        _update(model, sums, correlate=number >= 1)


def fit_classifier(model: Model, looks: DataFrame) -> None:
    """Logistic regression on the examples' terms and patterns, by their posteriors."""
    rows = looks.filter("label IS NOT NULL").select("votes", "hits", "patterns").toArrow()
    if rows.num_rows == 0:
        return
    votes = np.frombuffer(b"".join(rows.column("votes").to_pylist()), np.int8).reshape(-1, VOTERS).astype(np.int64)
    target = model.posterior(votes)
    width = 2 * TERMS + len(PATTERNS) + 1
    row, column = [], []
    for i, (hits, patterns) in enumerate(zip(rows.column("hits").to_pylist(), rows.column("patterns").to_pylist())):
        on = [*hits, *(2 * TERMS + k for k, p in enumerate(patterns) if p), width - 1]
        row += [i] * len(on)
        column += on
    row, column = np.array(row), np.array(column)
    weights, momentum, n = np.zeros(width), np.zeros(width), len(target)
    # Each weight steps by the curvature of its own column, with momentum.
    curvature = np.bincount(column, minlength=width) / 4 + RIDGE
    for _ in range(300):
        z = np.bincount(row, weights[column], minlength=n)
        error = 1 / (1 + np.exp(-np.clip(z, -50, 50))) - target
        penalty = RIDGE * weights
        penalty[-1] = 0
        gradient = np.bincount(column, error[row], minlength=width) + penalty
        momentum = 0.8 * momentum - 0.1 * gradient / curvature
        weights += momentum
    model.weights = weights


def fit(docs: DataFrame, labels: DataFrame, held_out: Column, label: str = "toxic", limit: int = EXAMPLES) -> tuple[Model, DataFrame]:
    """The model, and what it saw of each document: (doc_id, held_out, votes, hits, patterns).

    ``held_out`` is a column of doc_id alone.
    """
    chosen = written(examples_of(labels, held_out, label, limit), "toxicity-examples")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), whole_text().alias("text"))
    # At most `limit` ids of 12 bytes each are broadcast.
    sample = rows.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "label")
    model = Model(induce(unlike(sample)))

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                seen = [model.look(t) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": part.column("doc_id"), "held_out": part.column("held_out"),
                        "votes": [np.array(v, np.int8).tobytes() for v, _, _ in seen],
                        "hits": [h for _, h, _ in seen], "patterns": [p for _, _, p in seen],
                    },
                    schema,
                )

    schema = pa.schema(
        [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("votes", pa.binary()), ("hits", pa.list_(pa.int32())), ("patterns", pa.list_(pa.int32()))]
    )
    looks = written(
        rows.mapInArrow(run, "doc_id long, held_out boolean, votes binary, hits array<int>, patterns array<int>"), "looks"
    )
    marked = looks.join(F.broadcast(chosen), "doc_id", "left")
    fit_labels(model, marked)
    fit_classifier(model, marked)
    return model, looks


def score_toxicity(docs: DataFrame, labels: DataFrame, held_out: Column, label: str = "toxic", limit: int = EXAMPLES) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted and posterior (of the label model).

    Learns from at most ``limit`` of the ``labels`` (doc_id, label 0 or 1) that are not held
    out; an id with several labels is toxic if one says so. Null labels and labels without a
    document count for nothing. Null texts are empty: no term is found in them and they get
    the score of such texts. A null id is kept and has no label. Without any example every
    score is 0.5. No rows give no rows; repeated rows repeat their scores. Other columns are
    ignored.
    """
    model, looks = fit(docs, labels, held_out, label, limit)

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                votes = np.frombuffer(b"".join(batch.column("votes").to_pylist()), np.int8).reshape(-1, VOTERS)
                p = model.score(batch.column("hits").to_pylist(), batch.column("patterns").to_pylist())
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"), "score": p,
                        "predicted": (p >= 0.5).astype(np.int32), "posterior": model.posterior(votes.astype(np.int64)),
                    }
                )

    return looks.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int, posterior double")


def without_toxic(docs: DataFrame, labels: DataFrame, held_out: Column, label: str = "toxic", limit: int = EXAMPLES) -> DataFrame:
    """``docs`` with all its columns, less the documents that score 0.5 or more.

    Without any example nothing is known to be toxic, and all documents stay."""
    model, _ = fit(docs, labels, held_out, label, limit)
    if model.weights is None:
        return docs

    @F.pandas_udf("boolean")
    def clean(texts):
        seen = [model.look(t) for t in texts]
        return _series(model.score([h for _, h, _ in seen], [p for _, _, p in seen]) < 0.5)

    return docs.filter(clean(whole_text()))


def _series(values):
    import pandas as pd

    return pd.Series(values)
