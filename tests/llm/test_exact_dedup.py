import hashlib
import random
import re

import pytest

from slotwise.llm.exact_dedup import exact_dedup, keep_first_copies


def brute(rows):
    groups = {}
    for at, (doc_id, text) in enumerate(rows):
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text or ""), []).append((doc_id, text or "", at))
    out = []
    for plain, members in groups.items():
        best = min(members, key=lambda m: (-len(m[1]), m[0] is None, m[0] or 0, m[2]))
        digest = hashlib.sha256(plain.encode()).hexdigest()
        out += [(m[0], best[0], len(members), m is best, digest) for m in members]
    return sorted(out, key=str)


def texts(seed):
    draw = random.Random(seed)
    pieces = ["ala ", "bde", "\n", "dla", "xyz ", "émane", "ola\t", "日本"]
    rows = [(i, "".join(draw.choice(pieces) for _ in range(draw.randrange(0, 9)))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, " \r\n"), (None, "a b"), (None, "ab"), (103, "ab"), (103, "ab"), (104, "aebda" * 9000)]
    return rows + [(105, "aebda " * 9000), (106, "aebda" * 9000 + "x"), (107, "no\x00break space")]


@pytest.mark.parametrize("bits, least, most", [(64, 512, 8192), (2, 4, 12)])
def test_groups_are_those_of_equal_texts(make, bits, least, most):
    # Two bits make nearly all chunk names clash, so the verification decides.
    rows = texts(bits)
    found = exact_dedup(make(rows), bits, least, most).drop("_row").collect()
    assert sorted(map(tuple, found), key=str) == brute(rows)


def test_one_row_of_each_group_stays_with_all_its_columns(make):
    kept = keep_first_copies(make(texts(1)))
    assert kept.columns == ["doc_id", "text", "kept", "h"]
    assert kept.count() == sum(r[3] for r in brute(texts(1)))


def test_no_rows(make):
    assert exact_dedup(make([])).count() == 0 == keep_first_copies(make([])).count()
