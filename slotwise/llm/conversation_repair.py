"""Repair of the turn structure of conversations by cheapest edits.

A conversation is well formed if its roles are an optional system turn followed by pairs of
user and assistant, or if it is empty. The edits of a row (Keep, Rerole, Delete) and turns
put in between (Insert) span a lattice of (rows done, state of the roles), and the cheapest
way through is looked for from both ends: a forward and a reverse heap settle nodes until
their least costs together exceed the best crossing, so that all crossings of that cost are
known. Of those the least audit, the initials of the edits in order, is taken.

Rows are sorted once over the whole cluster by (conversation, turn, role, digest), without
their texts. A range of that order is a task; conversations that lie in it are solved there.
One that is cut by the ends of a range, or longer than a segment, gives one small table per
segment, the cheapest ways between any two states, and those tables are put together.
"""

from __future__ import annotations

import hashlib
import heapq
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from slotwise.llm.common import SPACE, written

# Rows of a conversation that are searched at once.
SEGMENT = 512
# Costs of the edits, and of leaving a truncated turn in.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5

# States: nothing yet, after the system turn, after a user, after an assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = 4
ENDS = (START, ASSISTANT)
# The one role that may be put in each state, and the state after it.
NEXT = (("user", USER), ("user", USER), ("assistant", ASSISTANT), ("user", USER))
LEGAL = {"su", "ua", "au"}

# A row is two characters: the role's initial (x: any other) and its first fault.
BLANK, DUPLICATE, CUT, SOUND = "b", "d", "t", "-"


def _after(state: int, initial: str) -> int | None:
    """The state after a kept turn, None if it may not stand there."""
    if initial == "s":
        return SYSTEM if state == START else None
    role, to = NEXT[state]
    return to if initial == role[0] else None


def _edits(row: tuple[str, str], state: int) -> list[tuple[str, int, int]]:
    """(initial, cost, state after) of the edits of a row."""
    initial, fault = row
    found = [("D", DELETE, state)]
    if fault in (BLANK, DUPLICATE):
        return found
    extra = TRUNCATED if fault == CUT else 0
    found.append(("R", REROLE + extra, NEXT[state][1]))
    kept = _after(state, initial)
    return found if kept is None else [*found, ("K", KEEP + extra, kept)]


def _steps(rows: list[tuple[str, str]]) -> tuple[list[list], list[list]]:
    """Edges of the lattice out of and into each node 4 * rows done + state: (node, cost, initial)."""
    ahead = [[] for _ in range(STATES * (len(rows) + 1))]
    back = [[] for _ in ahead]
    for done in range(len(rows) + 1):
        for state in range(STATES):
            node = STATES * done + state
            edges = [("I", INSERT, STATES * done + NEXT[state][1])]
            if done < len(rows):
                edges += [(name, cost, STATES * (done + 1) + to) for name, cost, to in _edits(rows[done], state)]
            for name, cost, to in edges:
                ahead[node].append((to, cost, name))
                back[to].append((node, cost, name))
    return ahead, back


def search(rows: list[tuple[str, str]], source: int, ends: tuple[int, ...]) -> tuple[int, str] | None:
    """(cost, audit) of the cheapest way through ``rows`` from state ``source`` to one of
    ``ends``, of equal ones the least audit; None if there is none.

    Two ways to one node at one cost are never each other's beginning: the longer would hold
    more inserts. So the least audit up to a node is part of the least one through it. Edges
    without cost go on by a row, so among nodes of one cost the order of rows settles them.
    """
    steps = _steps(rows)
    labels: tuple[dict, dict] = ({source: (0, "")}, {STATES * len(rows) + e: (0, "") for e in ends})
    settled: tuple[set, set] = (set(), set())
    heaps = [[(0, 0, source)], [(0, 0, node) for node in labels[1]]]
    best = None
    while heaps[0] and heaps[1] and (best is None or heaps[0][0][0] + heaps[1][0][0] <= best):
        side = 0 if heaps[0][0][0] <= heaps[1][0][0] else 1
        _, _, node = heapq.heappop(heaps[side])
        if node in settled[side]:
            continue
        settled[side].add(node)
        cost, audit = labels[side][node]
        for to, more, name in steps[side][node]:
            if to in settled[side]:
                continue
            label = (cost + more, name + audit if side else audit + name)
            old = labels[side].get(to)
            if old is None or label < old:
                labels[side][to] = label
                if old is None or label[0] < old[0]:
                    done = to // STATES
                    heapq.heappush(heaps[side], (label[0], len(rows) - done if side else done, to))
            across = labels[1 - side].get(to)
            if across is not None and (best is None or label[0] + across[0] < best):
                best = label[0] + across[0]
        if node in labels[1 - side] and (best is None or cost + labels[1 - side][node][0] < best):
            best = cost + labels[1 - side][node][0]
    if best is None:
        return None
    # All crossings of the best cost: nodes settled ahead, and edges from them to labelled nodes.
    least = None
    for node in settled[0] | ({source} & labels[1].keys()):
        cost, audit = labels[0][node]
        ways = [(node, 0, ""), *steps[0][node]]
        for to, more, name in ways:
            across = labels[1].get(to)
            if across is not None and cost + more + across[0] == best:
                way = audit + name + across[1]
                least = way if least is None or way < least else least
    return best, least


@lru_cache(maxsize=1 << 14)
def solve(codes: str) -> tuple[int, str]:
    """(cost, audit) of a whole conversation, given as two characters a row."""
    return search(_rows(codes), START, ENDS)


@lru_cache(maxsize=1 << 8)
def transfer(codes: str) -> list[tuple[int, str] | None]:
    """The cheapest ways through a segment, from each state to each."""
    return [search(_rows(codes), a, (b,)) for a in range(STATES) for b in range(STATES)]


def _rows(codes: str) -> list[tuple[str, str]]:
    return list(zip(codes[::2], codes[1::2]))


def _joined(ways: list, segment: list) -> list:
    """Ways to each state after one more segment."""
    out = []
    for b in range(STATES):
        reached = [
            (ways[a][0] + segment[STATES * a + b][0], ways[a][1] + segment[STATES * a + b][1])
            for a in range(STATES) if ways[a] is not None and segment[STATES * a + b] is not None
        ]
        out.append(min(reached, default=None))
    return out


def _illegal(initials: str) -> int:
    return sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))


# ---- rows


def _given(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, digest); a null role or text is one space."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    rows = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    return rows.withColumn("digest", F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"), 256)))


def _same(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def turns(rows: DataFrame) -> DataFrame:
    """Written rows without texts, equal ones once: conv_id, turn, role, digest, copies, and
    code, the initial of the role and the first fault of the first of the copies."""
    given = _given(rows)
    initial = F.substring("role", 1, 1)
    initial = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    cut = ~F.col("text").rlike(rf"[.!?]{SPACE}*\z")
    fault = F.when(blank, BLANK).when(cut, CUT).otherwise(SOUND)
    narrow = given.select("conv_id", "turn", "role", "digest", F.concat(initial, fault).alias("code"))
    key = ["conv_id", "turn", "role", "digest", "code"]
    narrow = written(narrow.groupBy(*key).agg(F.count(F.lit(1)).alias("copies")), "turns")
    # A row is a duplicate if its role and text stand at an earlier turn of the conversation.
    when = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    first = narrow.groupBy(F.col("conv_id").alias("c"), F.col("digest").alias("d")).agg(
        F.min(when).alias("first"), F.count(F.lit(1)).alias("n")
    )
    first = first.filter("n > 1").select("c", "d", F.col("first.turn").alias("first_turn"), F.lit(True).alias("again"))
    found = narrow.join(first, _same("conv_id", "c") & (F.col("digest") == F.col("d")), "left")
    later = F.coalesce("again", F.lit(False)) & ~_same("turn", "first_turn")
    initial, fault = F.substring("code", 1, 1), F.substring("code", 2, 1)
    code = F.when(later & (fault != BLANK), F.concat(initial, F.lit(DUPLICATE))).otherwise(F.col("code"))
    return written(found.select("conv_id", "turn", "role", "digest", "copies", code.alias("code")), "faults")


def _counted(narrow: DataFrame) -> DataFrame:
    fault, copies = F.substring("code", 2, 1), F.col("copies")
    zero = F.lit(0).cast("long")
    blank = F.when(fault == BLANK, copies).otherwise(zero)
    duplicate = F.when(fault == DUPLICATE, copies).when(fault != BLANK, copies - 1).otherwise(zero)
    truncated = F.when(fault == CUT, 1).otherwise(0).cast("long")
    gaps = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    return narrow.groupBy("conv_id").agg(
        F.coalesce(gaps, zero).alias("gaps"), F.sum(blank).alias("blank"), F.sum(duplicate).alias("duplicate"),
        F.sum(truncated).alias("truncated"),
    )


# A conversation that is done has one way; a segment has sixteen, with -1 where there is none.
WAYS = "turn long, role string, digest binary, done boolean, first string, last string, illegal long, costs array<long>, audits array<string>"


class _Ranges:
    """Conversations out of sorted rows: done ones, and segments of the others."""

    def __init__(self):
        self.out, self.conv, self.codes, self.key, self.whole, self.segments = [], None, [], None, False, 0

    def add(self, conv, key, code: str, copies: int, first: bool) -> None:
        if first:
            self.close(True)
            self.conv, self.whole, self.segments = conv, self.conv is not None, 0
        again = code[0] + (BLANK if code[1] == BLANK else DUPLICATE)
        while copies:
            if len(self.codes) == SEGMENT:
                self.segment()
            if not self.codes:
                # Copies of one row may fill several segments: their number tells them apart.
                self.key = (*key, self.segments)
            n = min(copies, SEGMENT - len(self.codes))
            self.codes += [code, *[again] * (n - 1)]
            code, copies = again, copies - n

    def segment(self) -> None:
        codes = "".join(self.codes)
        self.put(False, codes, transfer(codes))

    def put(self, done: bool, codes: str, ways: list) -> None:
        turn, role, digest, _ = self.key
        costs, audits = [-1 if w is None else w[0] for w in ways], ["" if w is None else w[1] for w in ways]
        self.out.append((self.conv[0], turn, role, digest, done, codes[0], codes[-2], _illegal(codes[::2]), costs, audits, self.key[3]))
        self.codes, self.segments = [], self.segments + 1

    def close(self, ended: bool) -> None:
        """The conversation ends here, or the range does (``ended`` false)."""
        if self.conv is None or not self.codes:
            return
        if ended and self.whole and not self.segments:
            codes = "".join(self.codes)
            self.put(True, codes, [solve(codes)])
        else:
            self.segment()


def _ways(narrow: DataFrame) -> DataFrame:
    conv = dict(narrow.dtypes)["conv_id"]
    key = ["conv_id", "turn", "role", "digest"]
    parts = int(narrow.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = narrow.repartitionByRange(parts, *key).sortWithinPartitions(*key)

    def run(batches):
        ranges, last, started = _Ranges(), None, False
        for batch in batches:
            convs = batch.column("conv_id").to_pylist()
            rest = [batch.column(c).to_pylist() for c in ("turn", "role", "digest", "code", "copies")]
            for name, turn, role, digest, code, copies in zip(convs, *rest):
                first = not started or name != last
                started, last = True, name
                ranges.add((name,), (turn, role, digest), code, copies, first)
            yield from _batches(ranges.out, schema)
            ranges.out = []
        ranges.close(False)
        yield from _batches(ranges.out, schema)

    ddl = f"conv_id {conv}, {WAYS}, place int"
    schema = _arrow(narrow, ddl)
    return dealt.select(*key, "code", "copies").mapInArrow(run, ddl)


def _arrow(df: DataFrame, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(df.sparkSession.createDataFrame([], ddl).schema)


def _batches(rows: list[tuple], schema: pa.Schema):
    if rows:
        columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)]
        yield pa.RecordBatch.from_arrays(columns, schema=schema)


def _put_together(ways: DataFrame) -> DataFrame:
    """(conv_id, illegal, cost, audit) of the conversations that come as segments."""
    ddl = f"conv_id {dict(ways.dtypes)['conv_id']}, illegal long, cost long, audit string"
    schema = _arrow(ways, ddl)

    def run(tab: pa.Table) -> pa.Table:
        order = tab.select(["turn", "role", "digest", "place"]).to_pylist()
        order = sorted(range(len(order)), key=lambda k: _place(order[k]))
        now, last, illegal = [(0, ""), None, None, None], "", 0
        for k in order:
            row = tab.slice(k, 1).to_pylist()[0]
            illegal += row["illegal"] + _illegal(last + row["first"])
            last = row["last"]
            now = _joined(now, [None if c < 0 else (c, a) for c, a in zip(row["costs"], row["audits"])])
        cost, audit = min(now[s] for s in ENDS if now[s] is not None)
        made = [(tab.column("conv_id")[0].as_py(), illegal, cost, audit)]
        return pa.Table.from_batches(_batches(made, schema))

    return ways.groupBy("conv_id").applyInArrow(run, ddl)


def _place(row: dict) -> tuple:
    # Spark sorts strings by their bytes.
    return (row["turn"] is not None, row["turn"] or 0, row["role"].encode(), row["digest"], row["place"])


def repair_audits(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``rows`` (conv_id, turn, role, text): conv_id, gaps, blank,
    duplicate, truncated, illegal, cost, audit.

    Rows stand in order of turn, nulls first, within a turn by role and digest of the text;
    repeated rows are adjacent. A null role or text is one space, a role's initial its first
    character. Every row has one fault at most: blank (white space only), else duplicate (role
    and text seen earlier), else truncated (does not end in ``.``, ``!`` or ``?``). gaps counts
    the turns missing between the first and the last one, 0 if no turn is known. illegal
    counts neighbours whose initials are not su, ua or au. The audit has K, R, D or I for
    Keep, Rerole, Delete and Insert. Rows with a null conv_id are one conversation. An empty
    table gives no rows. Other columns are ignored.
    """
    narrow = turns(rows)
    ways = written(_ways(narrow), "conversation-ways")
    done = ways.filter("done").select("conv_id", "illegal", F.col("costs")[0].alias("cost"), F.col("audits")[0].alias("audit"))
    found = done.unionByName(_put_together(ways.filter("NOT done"))).withColumnRenamed("conv_id", "c")
    counted = _counted(narrow)
    both = counted.join(found, _same("conv_id", "c")).drop("c")
    return written(both.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"), "audits")


def repaired_rows(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """The turns of the repaired conversations: conv_id, position (from 0), edit (K, R or I),
    turn (null where inserted), role, text; a conversation's turns are adjacent and in order.

    ``audits`` is what ``repair_audits`` gives for ``rows``. A conversation's audit comes
    before its rows and is held while they pass by, one after the other.
    """
    conv = dict(rows.dtypes)["conv_id"]
    heads = audits.select("conv_id", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.col("audit").alias("text"), F.lit(b"").alias("digest"))
    body = _given(rows).select("conv_id", F.lit(1).alias("kind"), "turn", "role", "text", "digest")
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = heads.unionByName(body).repartition(parts, "conv_id")
    dealt = dealt.sortWithinPartitions("conv_id", "kind", "turn", "role", "digest").drop("digest")
    ddl = f"conv_id {conv}, position long, edit string, turn long, role string, text string"
    schema = _arrow(rows, ddl)

    def run(batches):
        out, held = [], 0
        conv, audit, at, state, position = None, "", 0, START, 0

        def inserts():
            nonlocal at, state, position
            while at < len(audit) and audit[at] == "I":
                role, state = NEXT[state]
                out.append((conv, position, "I", None, role, ""))
                at, position = at + 1, position + 1

        for batch in batches:
            for name, kind, turn, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "kind", "turn", "role", "text"))):
                if kind == 0:
                    inserts()
                    conv, audit, at, state, position = name, text, 0, START, 0
                    continue
                inserts()
                edit, at = audit[at], at + 1
                if edit == "D":
                    continue
                if edit == "R":
                    role, state = NEXT[state]
                else:
                    state = _after(state, role[:1])
                out.append((conv, position, edit, turn, role, text))
                position, held = position + 1, held + len(text)
                if len(out) >= 2048 or held >= 8 << 20:
                    yield from _batches(out, schema)
                    out, held = [], 0
        inserts()
        yield from _batches(out, schema)

    return dealt.mapInArrow(run, ddl)


def digests(repaired: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of the rows of ``repaired_rows``: SHA-256 of their
    ``role:text`` joined by newlines. Conversations without rows have none."""
    ddl = f"conv_id {dict(repaired.dtypes)['conv_id']}, repaired_sha256 string"
    schema = _arrow(repaired, ddl)

    def run(batches):
        out, conv, sha = [], None, None
        for batch in batches:
            for name, position, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "position", "role", "text"))):
                if position == 0:
                    if sha is not None:
                        out.append((conv, sha.hexdigest()))
                    conv, sha = name, hashlib.sha256()
                else:
                    sha.update(b"\n")
                sha.update(f"{role}:{text}".encode())
            yield from _batches(out, schema)
            out = []
        if sha is not None:
            yield from _batches([(conv, sha.hexdigest())], schema)

    return repaired.mapInArrow(run, ddl)


def damaged(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) with faults by crc32 of ``conv_id:turn`` modulo 20: 0 drops
    the row, 1 empties its text, 2 removes its ``.``, ``!`` and ``?``, 3 repeats it, 4 makes it the
    user's. Nulls, also in that key, are one space."""
    space = F.lit(" ")
    key = F.concat(*[F.coalesce(x.cast("string"), space) for x in (F.col("conv_id"),)], F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    kind = F.crc32(key.cast("binary")) % 20
    role, text = (F.coalesce(F.col(c).cast("string"), space) for c in ("role", "text"))
    rows = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), kind.alias("kind")).filter("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    times = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), times.alias("copy")).drop("copy")


def damaged_and_repaired(conversations: DataFrame) -> DataFrame:
    """The report of ``repair_audits`` on ``damaged`` rows with the digest of the repaired
    conversations, for every conv_id of ``conversations``; where no row is left, zeros, an
    empty audit and the digest of the empty text."""
    rows = damaged(conversations)
    audits = repair_audits(rows)
    made = digests(repaired_rows(rows, audits)).withColumnRenamed("conv_id", "d")
    every = conversations.select("conv_id").distinct()
    found = audits.withColumnRenamed("conv_id", "c")
    out = every.join(found, _same("conv_id", "c"), "left").join(made, _same("conv_id", "d"), "left")
    zero = F.lit(0).cast("long")
    return out.select(
        "conv_id", *[F.coalesce(c, zero).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(b""), 256)).alias("repaired_sha256"),
    )
