import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict
from pathlib import Path

import pytest

from slotwise.llm import conversation_repair as repair
from slotwise.llm.common import ship
from slotwise.llm.conversation_repair import damaged_and_repaired, repair_audits, repaired_rows, search
from slotwise.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
WHITE = " \t\n\x0b\x0c\r"
FORM = re.compile(r"(s?(ua)+)?")


def options(initial, fault):
    """(letter, cost, role initial or None) of the edits of a row."""
    out = [("D", 2, None)]
    if fault not in "bd":
        more = 5 if fault == "t" else 0
        out += [("K", more, initial), ("R", 1 + more, "u"), ("R", 1 + more, "a")]
    return out


def every_way(rows, most_inserts):
    """All (cost, audit) that give a well-formed conversation, by trying everything."""
    best = None
    for chosen in itertools.product(*[options(*r) for r in rows]):
        for n in range(most_inserts + 1):
            for spots in itertools.combinations_with_replacement(range(len(rows) + 1), n):
                for roles in itertools.product("ua", repeat=n):
                    cost, audit, form = 5 * n, "", ""
                    for k in range(len(rows) + 1):
                        for spot, role in zip(spots, roles):
                            if spot == k:
                                audit, form = audit + "I", form + role
                        if k < len(rows):
                            letter, c, role = chosen[k]
                            cost, audit, form = cost + c, audit + letter, form + (role or "")
                    if FORM.fullmatch(form) and (best is None or (cost, audit) < best):
                        best = (cost, audit)
    return best


def straight(rows):
    """(cost, audit, roles) by going through the rows from the front, all states at a time."""
    after = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    def inserts(ways):
        for _ in range(4):
            for state in list(ways):
                for role in "ua":
                    if (state, role) in after:
                        cost, audit, roles = ways[state]
                        way = (cost + 5, audit + "I", roles + [role])
                        to = after[state, role]
                        if to not in ways or way[:2] < ways[to][:2]:
                            ways[to] = way
        return ways

    ways = inserts({"": (0, "", [])})
    for initial, fault in rows:
        new = {}
        for state, (cost, audit, roles) in ways.items():
            for letter, c, role in options(initial, fault):
                to = state if role is None else after.get((state, role))
                if to is not None:
                    way = (cost + c, audit + letter, roles + [role])
                    if to not in new or way[:2] < new[to][:2]:
                        new[to] = way
        ways = inserts(new)
    return min((ways[s] for s in ("", "a") if s in ways), key=lambda w: w[:2])


def plain(rows):
    """The whole report, one conversation after the other in Python."""
    left, names = defaultdict(list), []
    for conv, turn, role, text in rows:
        names.append(conv)
        turn_key = " " if turn is None else str(turn)
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{turn_key}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        left[conv] += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = []
    for conv in dict.fromkeys(names):
        def digest(role, text):
            return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()

        have = sorted(left[conv], key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), digest(r[1], r[2])))
        seen, coded = set(), []
        for _, role, text in have:
            ends = text.rstrip(WHITE)
            fault = "b" if not text.strip(WHITE) else "d" if (role, text) in seen else "t" if ends[-1] not in ".!?" else "-"
            seen.add((role, text))
            coded.append((role[:1] if role[:1] in ("s", "u", "a") else "x", fault))
        known = [t for t, _, _ in have if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(coded, coded[1:]))
        cost, audit, roles = straight(coded)
        turns, k, at = [], 0, 0
        for letter in audit:
            if letter == "I":
                turns.append(({"u": "user", "a": "assistant"}[roles[at]], ""))
            else:
                if letter != "D":
                    turns.append((have[k][1] if letter == "K" else {"u": "user", "a": "assistant"}[roles[at]], have[k][2]))
                k += 1
            at += 1
        text = "\n".join(f"{role}:{t}" for role, t in turns)
        faults = [sum(f == kind for _, f in coded) for kind in "bdt"]
        out.append((conv, gaps, *faults, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()))
    return out


def key(row):
    return (row[0] is not None, row[0] or 0)


def got(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=key)


def make(spark, rows):
    ship(spark)
    return spark.createDataFrame([(*r, "x", 7) for r in rows], "conv_id long, turn long, role string, text string, code string, copies int")


@pytest.mark.parametrize("seed", range(6))
def test_search_finds_the_least_of_all_ways(seed):
    draw = random.Random(seed)
    for _ in range(12):
        rows = [(draw.choice("suax"), draw.choice("bdt---")) for _ in range(draw.randrange(1, 5))]
        assert search(rows, repair.START, repair.ENDS) == every_way(rows, 2) == straight(rows)[:2]


def test_search_of_longer_conversations():
    draw = random.Random(11)
    for _ in range(200):
        rows = [(draw.choice("suaux"), draw.choice("bdtt----")) for _ in range(draw.randrange(1, 40))]
        assert search(rows, repair.START, repair.ENDS) == straight(rows)[:2]


def some_rows():
    draw = random.Random(5)
    texts = ["Fine.", "Good text!\n", "no end", "", " \t", "Why?", "ends oddly. ", "é.", "x" * 300_000 + "."]
    rows = []
    for conv in range(60):
        for turn in range(draw.randrange(1, 14)):
            rows.append((conv, turn + draw.choice([0, 0, 3]), draw.choice(["user", "assistant", "system", "tool", ""]), draw.choice(texts)))
    rows += [(None, None, None, None), (None, 1, "user", "Hi."), (None, 2, "assistant", None), (70, None, "user", "A."), (70, None, "assistant", "B.")]
    rows += [(71, 5, "user", "Same.")] * 40 + [rows[0], rows[1]]
    return rows


def test_report_agrees_with_plain_version(spark):
    rows = some_rows()
    assert got(damaged_and_repaired(make(spark, rows))) == sorted(plain(rows), key=key)


def test_a_long_conversation_in_segments(spark, monkeypatch):
    """One conversation over many segments and ranges; all others whole."""
    draw = random.Random(8)
    rows = [(1, k, draw.choice(["user", "assistant", "system"]), draw.choice(["One.", f"No {k}", f"T{k}.", ""])) for k in range(3000)]
    rows += [(2, k, ["user", "assistant"][k % 2], f"T{k}.") for k in range(8)] + [(3, 4, "user", "Same.")] * 1500
    assert got(damaged_and_repaired(make(spark, rows))) == sorted(plain(rows), key=key)


def test_repaired_turns(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "Ok."), (1, 2, "assistant", ""), (2, 0, "assistant", "Only.")]
    docs = make(spark, rows)
    audits = repair_audits(docs)
    assert {r.conv_id: (r.audit, r.cost) for r in audits.collect()} == {1: ("KRD", 3), 2: ("D", 2)}
    turns = [tuple(r) for r in repaired_rows(docs, audits).collect()]
    assert turns == [(1, 0, "K", 0, "user", "Hi."), (1, 1, "R", 1, "assistant", "Ok.")]


def test_empty_table_and_nothing_left(spark):
    assert damaged_and_repaired(make(spark, [])).count() == 0
    gone = next(k for k in range(1000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    assert got(damaged_and_repaired(make(spark, [(gone, 0, "user", "Hi.")]))) == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


@pytest.mark.skipif(not Path(SF).exists(), reason="driver tables are not here")
def test_query_on_the_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(QUERIES["op12_conversation_repair"](spark, SF)) == sorted(plain(rows), key=key)
