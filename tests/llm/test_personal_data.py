import hashlib
import random
import re

import numpy as np

from slotwise.llm.personal_data import KINDS, LABELS, SIGNATURES, Graph, added_spans, base_spans, find_personal_data, marginals

PLAIN = [
    re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    re.compile(r"[0-9]([\x20-]?[0-9])+"),
    re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def plain_spans(text):
    digits = lambda s: re.sub("[^0-9]", "", s)

    def luhn(s):
        d = [int(c) for c in reversed(s)]
        return (sum(d[::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])) % 10 == 0

    good = [
        lambda s: True, lambda s: all(int(p) <= 255 for p in s.split(".")),
        lambda s: 16 <= len(digits(s)) <= 19 and luhn(digits(s)), lambda s: 8 <= len(digits(s)) <= 15,
    ]
    return [[m.span() for m in p.finditer(text) if ok(m[0])] for p, ok in zip(PLAIN, good)]


def odd_texts():
    draw = random.Random(3)
    parts = ["a@b.c", "x.y+z@mail", "@", ".", "1.2.3.4", "300.1.2.3", "4041894974608795", "4041 8949-7460 8795", "+1 (456) 555-2186", "555-2186",
             " ", "\n", "é", "7", "12", "+", "-", "(", "a", "0001.2.3.4", "word ", "😀"]
    return ["".join(draw.choice(parts) for _ in range(draw.randrange(0, 30))) for _ in range(400)]


def test_patterns_agree_with_plain_ones():
    for text in odd_texts() + ["", "1" * 20_000, "1.2.3." * 3000, "+1" * 3000, "a@" * 2000, "9 " * 9000]:
        assert base_spans(text) == plain_spans(text), text[:80]


def test_documents(make):
    rows = [(i, t) for i, t in enumerate(odd_texts()[:60])] + [(90, None), (91, ""), (None, "a@b.cd"), (92, "1.2.3.4 " * 9000), (92, "x 7")]
    got = find_personal_data(make(rows)).collect()
    want = []
    for doc_id, text in rows:
        spans = plain_spans(text or "")
        joined = ",".join(f"{k}:{a}:{b}" for k, s in zip(KINDS, spans) for a, b in s)
        want.append((str(doc_id), *map(len, spans), hashlib.sha256(joined.encode()).hexdigest()))
    have = [(str(r.doc_id), r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in got]
    assert sorted(have) == sorted(want)
    for r in got:
        assert r.n_email + r.n_ip + r.n_card + r.n_phone + r.n_added == len([s for s in r.spans.split(",") if s])
    assert find_personal_data(make([])).count() == 0


def test_distant_mention_is_found_through_its_twin():
    # Links that favour equal labels pull the second mention to the first one's kind.
    same = np.where(np.eye(LABELS, dtype=bool), 4.0, -4.0)
    unary = np.log(np.full((SIGNATURES, LABELS), 1 / LABELS))
    twin = "Call +14565552186 today. " + "word " * 200 + "or 4565552186 again, not 99."
    graph = Graph([twin])
    assert graph.skip.tolist() == [[0, 1]] and graph.labels.tolist() == [4, 0, 0]
    added = added_spans(graph, (unary, np.zeros((LABELS, LABELS)), same), [twin])[0]
    assert [(KINDS[k], twin[a:b]) for k, a, b in added] == [("phone", "4565552186")]


def test_messages_on_a_tree_are_exact():
    texts = ["7 8 9"]
    graph = Graph(texts)
    assert graph.chain.tolist() == [[0, 1], [1, 2]]
    draw = np.random.Generator(np.random.PCG64(2))
    unary = draw.normal(size=(SIGNATURES, LABELS))
    link = draw.normal(size=(LABELS, LABELS))
    link = link + link.T
    got = marginals(graph, (unary, link, link))
    own = unary[graph.signatures]
    joint = np.exp(own[0][:, None, None] + own[1][None, :, None] + own[2][None, None, :] + link[:, :, None] + link[None, :, :])
    joint /= joint.sum()
    for node, others in enumerate(((1, 2), (0, 2), (0, 1))):
        assert np.allclose(got[node], joint.sum(axis=others), atol=0.02)
