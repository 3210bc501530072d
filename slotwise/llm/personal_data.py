"""Personal data: fixed patterns, and a skip-chain conditional random field that adds to them.

The field's nodes are the tokens of a document with a digit or an at sign. Neighbouring
nodes are linked in a chain, and each node is linked to the one before it, however distant,
with the same last seven digits or the same address, so that what is known of one mention
reaches the others. Potentials are estimated piece by piece from sums over all documents,
the patterns' findings being the labels; those findings are fixed while loopy message
passing finds the marginals of the other nodes. Nodes that an entity's label fits almost
surely become spans of their own.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from slotwise.llm.common import partition_number, pieces, summed, whole_text

KINDS = ["email", "ip", "card", "phone"]
LABELS = 1 + len(KINDS)  # 0 is none of them
# A node becomes a span if one kind has this marginal probability.
SURE = 0.9
SWEEPS = 12
DAMPING = 0.5
STRONGEST = 4.0  # bound of a link's potential, in nats
SIMILAR_DIGITS = 7

# What the patterns of the four kinds look like. Quantifiers do not give back
# where giving back cannot help, so long runs of digits take linear time.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

HINT = re.compile(r"[0-9@]")
REST_OF_TOKEN = re.compile(r"[0-9@]\S*")
NO_DIGIT = re.compile(r"[^0-9]+")


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) << (i & 1)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    """Matches lie between spaces and line feeds: only stretches with an at sign are searched."""
    out, done = [], 0
    at = text.find("@")
    while at >= 0:
        low = max(text.rfind(" ", done, at), text.rfind("\n", done, at), done - 1) + 1
        ends = [e for e in (text.find(" ", at), text.find("\n", at)) if e >= 0]
        done = min(ends, default=len(text))
        out += [m.span() for m in EMAIL.finditer(text, low, done)]
        at = text.find("@", done)
    return out


def base_spans(text: str) -> list[list[tuple[int, int]]]:
    """Spans of each kind by the patterns, in code points, end exclusive."""
    if not HINT.search(text):
        return [[], [], [], []]
    ips = [m.span() for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in _parts(m[0]))]
    cards = []
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = NO_DIGIT.sub("", m[0])
            if 16 <= len(digits) <= 19 and _luhn(digits):
                cards.append(m.span())
    phones = [m.span() for m in PHONE.finditer(text) if 8 <= len(NO_DIGIT.sub("", m[0])) <= 15] if "+" in text else []
    return [_emails(text) if "@" in text else [], ips, cards, phones]


def _parts(address: str) -> list[str]:
    """Numbers of an address; one of very many zeros is short for zero."""
    return [p.lstrip("0") or "0" for p in address.split(".")]


SIGNATURES = 1 << 11


def signature(token: str, digits: int) -> int:
    """Shape of a token as a number below `SIGNATURES`."""
    size = sum(digits > n for n in (0, 3, 6, 9, 12, 15, 19))
    groups = min(3, max(0, len(NO_DIGIT.split(token.strip("()+-.,;:"))) - 1))
    flags = ("@" in token) << 5 | ("." in token[:-1]) << 4 | ("+" in token) << 3 | ("-" in token) << 2 | ("(" in token) << 1
    flags |= any(c.isalpha() for c in token)
    return flags << 5 | size << 2 | groups


class Graph:
    """Nodes and links of several documents, as arrays."""

    def __init__(self, texts: list[str]):
        self.base = [base_spans(t) for t in texts]
        self.spans, self.signatures, self.labels, chain, skip = [], [], [], [], []
        self.first = [0]
        for text, base in zip(texts, self.base):
            if any(base) or HINT.search(text):
                self._add(text, base, chain, skip)
            self.first.append(len(self.spans))
        self.signatures = np.array(self.signatures, dtype=np.int64)
        self.labels = np.array(self.labels, dtype=np.int64)
        self.chain = np.array(chain, dtype=np.int64).reshape(-1, 2)
        self.skip = np.array(skip, dtype=np.int64).reshape(-1, 2)

    def _add(self, text: str, base, chain: list, skip: list) -> None:
        # Base spans by their start; of spans that overlap, the kind listed first counts.
        known = sorted((a, b, k + 1) for k, spans in enumerate(base) for a, b in spans)
        last_end, seen, at = None, {}, 0
        for m in REST_OF_TOKEN.finditer(text):
            start, end = m.span()
            while start and not text[start - 1].isspace() and (last_end is None or start > last_end):
                start -= 1
            token = text[start:end]
            digits = NO_DIGIT.sub("", token)
            number = len(self.spans)
            while at < len(known) and known[at][1] <= start:
                at += 1
            over = [k for a, b, k in known[at : at + 4] if a < end and b > start]
            self.spans.append((start, end))
            self.signatures.append(signature(token, len(digits)))
            self.labels.append(over[0] if over else 0)
            if last_end is not None and start - last_end <= 2:
                chain.append((number - 1, number))
            key = token.lower() if "@" in token else digits[-SIMILAR_DIGITS:] if len(digits) >= SIMILAR_DIGITS else None
            if key is not None:
                if key in seen:
                    skip.append((seen[key], number))
                seen[key] = number
            last_end = end


def potentials(docs: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """Logarithms of the potentials of nodes by signature, of chain links and of skip links."""

    def run(batches):
        nodes = np.zeros((SIGNATURES, LABELS))
        links = np.zeros((2, LABELS, LABELS))
        for tab in pieces(batches, 4096, 4 << 20):
            graph = Graph(tab.column("text").to_pylist())
            np.add.at(nodes, (graph.signatures, graph.labels), 1)
            for out, pairs in zip(links, (graph.chain, graph.skip)):
                np.add.at(out, (graph.labels[pairs[:, 0]], graph.labels[pairs[:, 1]]), 1)
        value = np.concatenate([nodes.ravel(), links.ravel()]).tobytes()
        yield pa.RecordBatch.from_pydict({"part": [partition_number()], "value": [value]})

    sums = summed(docs.select("text").mapInArrow(run, "part long, value binary"))
    if sums is None:
        return None
    nodes = sums[: SIGNATURES * LABELS].reshape(SIGNATURES, LABELS)
    unary = np.log((nodes + 1 / LABELS) / (nodes.sum(axis=1, keepdims=True) + 1))
    # A link says how much likelier two labels are together than by themselves.
    pairs = []
    for part in sums[SIGNATURES * LABELS :].reshape(2, LABELS, LABELS):
        both = part + part.T + 1 / LABELS
        p = both / both.sum()
        own = p.sum(axis=1)
        pairs.append(np.clip(np.log(p / np.outer(own, own)), -STRONGEST, STRONGEST))
    return unary, pairs[0], pairs[1]


def marginals(graph: Graph, model) -> np.ndarray:
    """Marginal label probabilities of all nodes, by loopy belief propagation."""
    unary, chain, skip = model
    own = unary[graph.signatures].copy()
    fixed = np.flatnonzero(graph.labels)
    own[fixed] = -50.0
    own[fixed, graph.labels[fixed]] = 0.0
    pairs = np.concatenate([graph.chain, graph.skip])
    source = np.concatenate([pairs[:, 0], pairs[:, 1]])
    target = np.concatenate([pairs[:, 1], pairs[:, 0]])
    n = len(pairs)
    back = np.concatenate([np.arange(n, 2 * n), np.arange(n)])
    table = np.concatenate([np.repeat(chain[None], len(graph.chain), 0), np.repeat(skip[None], len(graph.skip), 0)])
    table = np.concatenate([table, table])  # the tables are symmetric
    messages = np.zeros((2 * n, LABELS))
    belief = own.copy()
    for _ in range(SWEEPS if n else 0):
        out = (belief[source] - messages[back])[:, :, None] + table
        top = out.max(axis=1, keepdims=True)
        new = np.log(np.exp(out - top).sum(axis=1)) + top[:, 0]
        new -= new.max(axis=1, keepdims=True)
        messages = DAMPING * messages + (1 - DAMPING) * new
        belief = own.copy()
        np.add.at(belief, target, messages)
    p = np.exp(belief - belief.max(axis=1, keepdims=True)) if len(belief) else belief
    return p / p.sum(axis=1, keepdims=True) if len(belief) else p


def added_spans(graph: Graph, model, texts: list[str]) -> list[list[tuple[int, int, int]]]:
    """(kind, start, end) of the nodes beside base spans that are surely of a kind."""
    p = marginals(graph, model)
    out = []
    for i, text in enumerate(texts):
        found: list[tuple[int, int, int]] = []
        for node in range(graph.first[i], graph.first[i + 1]):
            label = int(p[node].argmax())
            if graph.labels[node] or not label or p[node, label] < SURE:
                continue
            start, end = graph.spans[node]
            while end > start and not text[end - 1].isalnum():
                end -= 1
            while start < end and not (text[start].isalnum() or text[start] in "+("):
                start += 1
            if start < end:
                if found and found[-1][0] == label - 1 and start - found[-1][2] <= 1:
                    start = found.pop()[1]  # a kind written in several tokens
                found.append((label - 1, start, end))
        out.append(found)
    return out


def _joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def find_personal_data(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone and base_sha256 of what the
    patterns find, spans of all that is found, and n_added.

    Spans are kind:start:end, by kind and start; start and end count code points. Null texts
    are empty: counts of zero, no spans. Texts of any length are searched whole. A null id is
    kept, repeated rows repeat their results, no rows give no rows. Other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    model = potentials(rows)

    def run(batches):
        for tab in pieces(batches, 4096, 4 << 20):
            texts = tab.column("text").to_pylist()
            graph = Graph(texts)
            base = [[(k, a, b) for k, spans in enumerate(kinds) for a, b in spans] for kinds in graph.base]
            more = added_spans(graph, model, texts)
            columns = {"doc_id": tab.column("doc_id").combine_chunks()}
            for k, kind in enumerate(KINDS):
                columns[f"n_{kind}"] = pa.array([len(kinds[k]) for kinds in graph.base], pa.int64())
            columns["base_sha256"] = [hashlib.sha256(_joined(b).encode()).hexdigest() for b in base]
            columns["spans"] = [_joined({*b, *m}) for b, m in zip(base, more)]
            columns["n_added"] = pa.array([len(m) for m in more], pa.int64())
            yield pa.RecordBatch.from_pydict(columns)

    return rows.mapInArrow(
        run,
        "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long",
    )
