"""Byte-level BPE with content-defined chunk reuse.

Texts are cut where a rolling hash of the last 32 bytes says so, so a passage that occurs
in many documents yields the same chunks in all of them. Documents are first brought
together by their smallest chunk hash, so that copies meet in one task; a task then
encodes each distinct chunk once. A join of two chunks is repaired by encoding a stretch
around it again: the stretch grows to both sides until its ends are places where any
encoding of the text must begin a new word piece, and where both chunks did begin one.

The tokenizer must be byte-level BPE without normalizer, whose pieces never cross a place
where an ASCII letter, one space and an ASCII letter follow each other.
"""

from __future__ import annotations

import hashlib
import os
import re
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from slotwise.llm.common import free_name, pieces, whole_text

# A chunk ends where this many high bits of the rolling hash are ones, and has at least `LEAST` bytes.
CHUNK_BITS = 10
LEAST = 256
WINDOW = 32

# One scrambled 32-bit number per byte value, from a fixed seed.
GEAR = np.random.Generator(np.random.PCG64(20)).integers(0, 2**32, 256, dtype=np.uint32)


# Texts whose characters this module and the tokenizer class alike as letters or white space,
# and those among them in which no two white-space characters meet.
PLAIN = re.compile(r"[\n\x20-\x7E\xA1-\u024F\u0391-\u03A1\u03A3-\u03C9\u0410-\u044F\u2010-\u2027]*+")
MEETING = re.compile(r"[ \n][ \n]")
# A single space between letters: every encoding of a text begins a piece there.
ANCHOR = re.compile(rb"(?<=[A-Za-z]) (?=[A-Za-z])")
MARK = "\x01"
# Pieces that a worker remembers; beyond this many it forgets them all.
REMEMBERED = 500_000


def cuts(data: bytes, bits: int = CHUNK_BITS, least: int = LEAST) -> list[int]:
    """Offsets at which chunks end, the last one included; at bounds of UTF-8 characters."""
    n = len(data)
    if n <= least:
        return [n] if n else []
    raw = np.frombuffer(data, dtype=np.uint8)
    rolling = GEAR[raw]
    step = 1
    while step < WINDOW:
        # After each round a hash covers twice as many bytes.
        rolling[step:] = rolling[step:] + (rolling[:-step] << np.uint32(step))
        step *= 2
    mask = np.uint32(((1 << bits) - 1) << (32 - bits))
    hits = np.flatnonzero((rolling[:-1] & mask == mask) & (raw[1:] & 0xC0 != 0x80)) + 1
    out, last = [], 0
    for at in hits.tolist():
        if at - last >= least and n - at >= 1:
            out.append(at)
            last = at
    return [*out, n]


def first_anchor(data: bytes) -> int | None:
    found = ANCHOR.search(data)
    return found.start() if found else None


def last_anchor(data: bytes) -> int | None:
    at = data.rfind(b" ")
    while at > 0:
        if ANCHOR.match(data, at):
            return at
        at = data.rfind(b" ", 0, at)
    return None


class Codec:
    """Encodes and decodes with one tokenizer file; keeps each chunk of one batch once."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        spelled = _byte_values()
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.pieces = [b""] * (max(vocabulary.values(), default=-1) + 1)
        for token, number in vocabulary.items():
            self.pieces[number] = b"".join(spelled.get(c) or c.encode() for c in token)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known: dict[str, bytes] = {}
        self.lengths = np.array([len(p) for p in self.pieces], dtype=np.int64)

    def plain(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of whole texts, by the tokenizer alone."""
        made = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4") for e in made]

    def chunk_ids(self, chunks: list[str]) -> list[np.ndarray]:
        """Ids of chunks: each distinct piece goes to the tokenizer once.

        A chunk falls apart before each space and around each line feed: the tokenizer
        begins a piece there too, if no white space meets. Chunks where it does, with unusual
        characters or with the text of a special token go to the tokenizer whole.
        """
        usual = [
            PLAIN.fullmatch(c) is not None and not MEETING.search(c) and not any(x in c for x in self.special) for c in chunks
        ]
        # A mark stands before text that no space precedes.
        split = [(MARK + c.replace("\n", " \n " + MARK)).split(" ") if ok else () for c, ok in zip(chunks, usual)]
        if len(self.known) > REMEMBERED:
            self.known.clear()
        new = list(set(chain.from_iterable(split)) - self.known.keys())
        for at in range(0, len(new), 1 << 14):
            some = new[at : at + (1 << 14)]
            texts = [p if p == "\n" else p[1:] if p[:1] == MARK else " " + p for p in some]
            self.known.update(zip(some, (x.tobytes() for x in self.plain(texts))))
        rest = iter(self.plain([c for c, ok in zip(chunks, usual) if not ok]))
        recall = self.known.__getitem__
        return [
            np.frombuffer(b"".join(map(recall, part)), dtype="<u4") if ok else next(rest) for part, ok in zip(split, usual)
        ]

    def encode(self, texts: list[bytes], bits: int = CHUNK_BITS, least: int = LEAST) -> list[np.ndarray]:
        """Ids of each text: chunks are encoded once, then their joins are repaired."""
        cut = [cuts(t, bits, least) for t in texts]
        chunks = [[t[a:b] for a, b in zip([0, *c], c)] for t, c in zip(texts, cut)]
        distinct = list(dict.fromkeys(x for c in chunks for x in c))
        known = dict(zip(distinct, self._with_ends(distinct)))
        plans, stretches = [], []
        for text, ends, parts in zip(texts, cut, chunks):
            plan = self._plan(text, ends, [known[p] for p in parts])
            plans.append(plan)
            stretches += [text[a:b] for kind, a, b in plan if kind is None]
        repaired = dict(zip(unique := list(dict.fromkeys(stretches)), self.chunk_ids([s.decode() for s in unique])))
        out = []
        for text, plan in zip(texts, plans):
            ids = [repaired[text[a:b]] if kind is None else kind[a:b] for kind, a, b in plan]
            out.append(np.concatenate(ids) if ids else np.empty(0, "<u4"))
        return out

    def _with_ends(self, chunks: list[bytes]):
        """(ids, ends of the ids in bytes, first and last sure place) of each chunk."""
        for ids, chunk in zip(self.chunk_ids([c.decode() for c in chunks]), chunks):
            ends = np.cumsum(self.lengths[ids])
            low, high = first_anchor(chunk), last_anchor(chunk)
            # A place counts only if the chunk's own encoding begins a piece there too.
            if low is not None and (ends[np.searchsorted(ends, low)] != low or ends[np.searchsorted(ends, high)] != high):
                low = high = None
            yield ids, ends, low, high

    def _plan(self, text: bytes, cut: list[int], parts) -> list:
        """How to put a text together: (ids, from, to) of a chunk, or (None, from, to) of
        the bytes of a stretch to encode again."""
        plan, stretch = [], None  # stretch: where one began that has not ended yet
        start = 0
        for number, (end, (ids, ends, inner_low, inner_high)) in enumerate(zip(cut, parts)):
            first, last = number == 0, number == len(parts) - 1
            low = start if first else None if inner_low is None else start + inner_low
            high = end if last else None if inner_high is None else start + inner_high
            if low is None or (high is None and not first):
                # No sure place in this chunk: the stretch goes on, to the end if this is last.
                if last:
                    plan.append((None, stretch, end))
                start = end
                continue
            if stretch is not None:
                plan.append((None, stretch, low))
            if high is None:
                stretch = start
            else:
                a, b = (int(np.searchsorted(ends, x - start, "right")) for x in (low, high))
                plan.append((ids, a, b))
                stretch = high
            start = end
        return plan

    def decode(self, ids: np.ndarray) -> bytes:
        """UTF-8 of the decoded text; bytes that are no text become replacement characters."""
        raw = b"".join(map(self.pieces.__getitem__, ids.tolist()))
        return raw.decode("utf-8", "replace").encode()


@cache
def codec(path: str) -> Codec:
    """The codec of a Python worker: later tasks of the worker find its pieces known."""
    return Codec(path)


def _byte_values() -> dict[str, bytes]:
    """The printable characters that stand for bytes in a byte-level vocabulary.

    Printable Latin-1 characters stand for themselves, the other bytes take the code
    points from 256 on in order."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): bytes([b]) for b in shown} | {chr(256 + i): bytes([b]) for i, b in enumerate(hidden)}


def _brought_together(docs: DataFrame, bits: int, least: int) -> DataFrame:
    """Rows of ``docs`` (…, text) dealt so that texts with the same smallest chunk hash
    share a task. Adaptive execution splits a hash with very many rows and joins small ones."""

    def run(batches):
        for batch in batches:
            keys = []
            for text in batch.column("text").to_pylist():
                data = text.encode()
                ends = cuts(data, bits, least)
                keys.append(min((_hash(data[a:b]) for a, b in zip([0, *ends], ends)), default=0))
            yield batch.append_column(meet, pa.array(keys, pa.int64()))

    meet = free_name(docs.columns, "meet")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields) + f", {meet} long"
    return docs.mapInArrow(run, schema).hint("rebalance", meet).drop(meet)


def _hash(data: bytes) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(data) >> 1


def encode_documents(
    docs: DataFrame, tokenizer: str, bits: int = CHUNK_BITS, least: int = LEAST, digests: bool = False
) -> DataFrame:
    """One row per document with the columns of ``docs`` but text, and ids and decoded text,
    or with ``digests`` their number and SHA-256 digests.

    ``tokenizer`` is the path of the tokenizer file on every executor. Null text is the
    empty text: no ids. Very long texts are encoded whole, as chunks. Repeated rows give
    repeated results, no rows none. Columns named ids, decoded, n_tokens, ids_sha256 or
    decoded_sha256 are replaced.
    """
    made = ["n_tokens", "ids_sha256", "decoded_sha256"] if digests else ["ids", "decoded"]
    kept = [c for c in docs.columns if c != "text" and c not in ("ids", "decoded", "n_tokens", "ids_sha256", "decoded_sha256")]
    rows = docs.select(*[f"`{c}`" for c in kept], whole_text().alias("text"))

    def run(batches):
        made_by = codec(tokenizer)
        for tab in pieces(batches, 4096, 4 << 20):
            texts = [t.encode() for t in tab.column("text").to_pylist()]
            ids = made_by.encode(texts, bits, least)
            tab = tab.drop_columns(["text"])
            if digests:
                columns = [
                    pa.array([len(x) for x in ids], pa.int64()),
                    pa.array([hashlib.sha256(x.tobytes()).hexdigest() for x in ids], pa.string()),
                    pa.array([hashlib.sha256(made_by.decode(x)).hexdigest() for x in ids], pa.string()),
                ]
            else:
                columns = [
                    pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32())),
                    pa.array([made_by.decode(x).decode() for x in ids], pa.string()),
                ]
            for name, column in zip(made, columns):
                tab = tab.append_column(name, column)
            yield from tab.to_batches()

    new = "n_tokens long, ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>, decoded string"
    old = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "text")
    return _brought_together(rows, bits, least).mapInArrow(run, f"{old}, {new}" if old else new)
