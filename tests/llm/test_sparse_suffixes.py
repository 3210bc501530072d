from collections import Counter

import numpy as np
import pytest

from slotwise.llm.sparse_suffixes import PASSAGE, SPAN, Words, _sliding, repeated_spans, retained

from tests.llm.conftest import words


def brute(rows):
    split = [(d, (t or "").lower().split()) for d, t in rows]
    count = Counter(tuple(w[i : i + PASSAGE]) for _, w in split for i in range(len(w) - PASSAGE + 1))
    out = []
    for doc_id, w in split:
        covered = np.zeros(len(w) + 1, bool)
        starts = [i for i in range(len(w) - PASSAGE + 1) if count[tuple(w[i : i + PASSAGE])] > 1]
        for i in starts:
            covered[i : i + PASSAGE] = True
        edges = np.flatnonzero(np.diff(np.concatenate([[False], covered]).astype(int)))
        out += [(doc_id, int(a), int(b), len(w)) for a, b in zip(edges[::2], edges[1::2])]
    return sorted(out, key=str)


def corpus():
    passage = [words(n, 900 + n) for n in (49, 50, 51, 64, 90, 200)]
    rows = [(i, words(120, i)) for i in range(12)]
    for i, p in enumerate(passage):
        rows += [(100 + 10 * i + k, f"{words(7 * k, i * 9 + k)} {p.title() if k == 1 else p} {words(11, 70 + i + k)}") for k in range(3)]
    rows += [(200, passage[4] + " " + words(5, 1) + " " + passage[4]), (201, " ".join(["again"] * 300)), (202, " ".join(["again"] * 49))]
    # Two documents share the first half of a passage with one and the second half with another.
    rows += [(203, " ".join(passage[5].split()[:70])), (204, " ".join(passage[5].split()[60:140])), (205, passage[5].replace(" ", "\n\t"))]
    rows += [(300, None), (301, ""), (None, passage[3]), (302, words(50_000, 4)), (302, words(50_000, 4))]
    return rows


@pytest.mark.parametrize("bits", [1 << 26, 1 << 9])
def test_spans_agree_with_brute_force(make, bits):
    # The small filter is full of errors, which must not change the result.
    rows = corpus()
    got = repeated_spans(make(rows), bits=bits).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


def test_nothing_repeats(make):
    assert repeated_spans(make([])).count() == 0
    assert repeated_spans(make([(1, words(60, 1)), (2, words(60, 2)), (3, None)])).count() == 0


def test_every_passage_holds_a_retained_suffix():
    block = Words([words(400, 1), "", words(49, 2), words(50, 3), " ".join(["same"] * 80)])
    seeds, least = block.minimisers()
    kept = set(retained(block).tolist())
    for at in np.flatnonzero(least):
        assert least[at] == seeds[at : at + SPAN].min() and int(least[at]) in kept
    assert np.count_nonzero(least) == 351 + 1 + 31


def test_sliding_windows():
    x = np.array([5, 3, 9, 1, 7, 7], np.uint64)
    for width in (1, 2, 3, 5, 9):
        assert _sliding(x, width, np.minimum).tolist() == [min(x[i : i + width].tolist()) for i in range(6)]
