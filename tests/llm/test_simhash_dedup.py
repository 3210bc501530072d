import random
import re

import numpy as np
import xxhash

from slotwise.llm.components import components
from slotwise.llm.simhash_dedup import _flipped, _flips, _forest, _near, keep_one_of_each, links, simhash_groups

from tests.llm.conftest import words


def plain_fingerprint(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", text)
    size = min(3, len(found))
    shingles = [" ".join(found[i : i + size]) for i in range(len(found) - size + 1)] if found else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def plain_roots(n, near):
    root = list(range(n))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(n):
        for b in range(a):
            if near(a, b):
                x, y = top(a), top(b)
                root[max(x, y)] = min(x, y)
    return [top(x) for x in range(n)]


def test_groups_agree_with_brute_force(make):
    rows = [(i, words(80, i)) for i in range(40)]
    draw = random.Random(2)
    for i in range(60):
        changed = words(400, 500 + i % 4).split()
        changed[draw.randrange(400)] = "changed"
        rows.append((100 + i, " ".join(changed)))
    rows += [(300, None), (301, " \n"), (302, ""), (303, "One"), (304, "one"), (305, "two words"), (305, "two words"), (306, words(60_000, 9))]
    fps = [plain_fingerprint(t) for _, t in rows]
    roots = plain_roots(len(rows), lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 3)
    least = {}
    for (doc_id, _), root in zip(rows, roots):
        least[root] = min(doc_id, least.get(root, doc_id))
    want = sorted((d, f"{f:016x}", least[r]) for (d, _), f, r in zip(rows, fps, roots))
    docs = make(rows)
    got = simhash_groups(docs).select("doc_id", "fingerprint", "component_id").collect()
    assert sorted(map(tuple, got)) == want
    kept = keep_one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(least.values())


def test_null_ids_and_no_rows(make):
    docs = make([(None, "a b c d"), (None, "a b c d"), (5, "a b c d"), (None, "q r s t u v"), (None, "q r s t u v")])
    got = sorted((r.doc_id or 0, r.component_id or 0) for r in simhash_groups(docs).collect())
    assert got == [(0, 0), (0, 0), (0, 5), (0, 5), (5, 5)]
    assert sorted(r.doc_id or 0 for r in keep_one_of_each(docs).collect()) == [0, 5]
    assert simhash_groups(make([])).count() == 0 == keep_one_of_each(make([])).count()


def test_links_connect_what_near_pairs_connect(spark):
    draw = np.random.Generator(np.random.PCG64(1))
    base = draw.integers(0, 2**63, 12, dtype=np.uint64)
    values = np.unique(np.concatenate([base] + [b ^ (np.uint64(1) << draw.integers(0, 64, 25, dtype=np.uint64)) ^ (np.uint64(1) << draw.integers(0, 64, 25, dtype=np.uint64)) for b in base]))
    signed = values.view(np.int64).tolist()
    found = components(links(spark.createDataFrame([(v,) for v in signed], "fp long")))
    got = {r.node: r.root for r in found.collect()}
    order = sorted(signed)
    roots = plain_roots(len(order), lambda a, b: ((order[a] ^ order[b]) & (2**64 - 1)).bit_count() <= 3)
    assert [got.get(v, v) for v in order] == [order[r] for r in roots]


def test_long_lists_give_the_same_components():
    draw = np.random.Generator(np.random.PCG64(4))
    values = np.unique(draw.integers(0, 1 << 24, 3000, dtype=np.uint64) & np.uint64(0x3FFF))
    roots = []
    for node, root in (_forest(len(values), *_near(values)), _flipped(values, _flips([0, 1, 2]))):
        whole = np.arange(len(values))
        whole[node] = root
        roots.append(whole.tolist())
    assert roots[0] == roots[1]


def test_components_of_a_path_and_a_star(spark):
    pairs = [(i, i + 1) for i in range(100, 140)] + [(7, 200 + i) for i in range(50)] + [(9, 9), (5, 6), (6, 5)]
    got = {r.node: r.root for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert {got[i] for i in range(100, 141)} == {100} and {got[200 + i] for i in range(50)} == {7}
    assert got[6] == 5 == got[5] and 9 not in got
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
