"""Repair of conversation structure: a generalised LR parser over the role grammar with weighted edits."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from objsync.llm.common import stored
from objsync.operators.joins import split_join

# The characters that do not count as content, and the ends of a finished text.
BLANK = r"[\x20\x09-\x0D]"
ENDS = r"[.!?]"
# What each edit costs; an undeleted truncated row adds UNFINISHED.
KEEP, REROLE, DELETE, INSERT, UNFINISHED = 0, 2, 3, 2, 1

# The role grammar over role initials: an optional s, then pairs of u and a, or nothing.
START, END = "conversation", "$"
GRAMMAR = [("conversation", ()), ("conversation", ("turns",)), ("conversation", ("s", "turns")),
           ("turns", ("u", "a")), ("turns", ("turns", "u", "a"))]
ROLES = {"u": "user", "a": "assistant"}

# What the parser sees of a row: its initial, and whether it must go or is truncated.
BAD, CUT, FINE = "bad", "cut", "fine"


class Table:
    """The SLR automaton of a grammar: states, shifts and gotos by (state, symbol), reductions by (state, lookahead)."""

    def __init__(self, grammar: list[tuple[str, tuple[str, ...]]], start: str):
        self.rules = [("'", (start,)), *grammar]
        self.names = {left for left, _ in self.rules}
        follow = self._follow()
        first = self._closure(frozenset({(0, 0)}))
        states, self.moves, self.reduces = {first: 0}, {}, {}
        queue = [first]
        for items in queue:
            at = states[items]
            # In order: every worker must number the states alike.
            for symbol in sorted({self.rules[r][1][dot] for r, dot in items if dot < len(self.rules[r][1])}):
                after = self._closure(frozenset((r, dot + 1) for r, dot in items if self.rules[r][1][dot:dot + 1] == (symbol,)))
                if after not in states:
                    states[after] = len(states)
                    queue.append(after)
                self.moves[at, symbol] = states[after]
            for r, dot in sorted(items):
                if dot == len(self.rules[r][1]):
                    for ahead in follow[self.rules[r][0]]:
                        self.reduces.setdefault((at, ahead), []).append(r)

    def _closure(self, items: frozenset) -> frozenset:
        found, queue = set(items), list(items)
        for r, dot in queue:
            for k, (left, _) in enumerate(self.rules):
                if self.rules[r][1][dot:dot + 1] == (left,) and (k, 0) not in found:
                    found.add((k, 0))
                    queue.append((k, 0))
        return frozenset(found)

    def _follow(self) -> dict[str, set[str]]:
        empty, first = set(), {n: set() for n in self.names}
        follow = {n: set() for n in self.names}
        follow["'"].add(END)
        size = -1
        while size != (size := len(empty) + sum(map(len, [*first.values(), *follow.values()]))):
            for left, right in self.rules:
                ahead = set(follow[left])
                start, gone = set(), True
                for symbol in reversed(right):
                    own = first[symbol] if symbol in self.names else {symbol}
                    if symbol in self.names:
                        follow[symbol] |= ahead
                    ahead = own | ahead if symbol in empty else set(own)
                for symbol in right:
                    start |= first[symbol] if symbol in self.names else {symbol}
                    if symbol not in empty:
                        gone = False
                        break
                first[left] |= start
                if gone:
                    empty.add(left)
        return follow

    def shift(self, stack: tuple[int, ...], symbol: str) -> list[tuple[int, ...]]:
        """All stacks after the reductions that ``symbol`` allows and its shift."""
        return [(*below, self.moves[below[-1], symbol]) for below in self._reduced(stack, symbol) if (below[-1], symbol) in self.moves]

    def accepts(self, stack: tuple[int, ...]) -> bool:
        return any(below == (0, self.moves[0, START]) for below in self._reduced(stack, END))

    def _reduced(self, stack: tuple[int, ...], ahead: str) -> Iterator[tuple[int, ...]]:
        yield stack
        for rule in self.reduces.get((stack[-1], ahead), []):
            left, right = self.rules[rule]
            if rule:
                below = stack[:len(stack) - len(right)]
                yield from self._reduced((*below, self.moves[below[-1], left]), ahead)


@lru_cache(maxsize=1)
def _table() -> Table:
    return Table(GRAMMAR, START)


@lru_cache(maxsize=None)
def _inserted(stack: tuple[int, ...]) -> tuple[tuple[tuple[int, ...], int], ...]:
    """The stacks that insertions alone lead to, each with their least number."""
    found, queue = {stack: 0}, [stack]
    for below in queue:
        for symbol in ROLES:
            for after in _table().shift(below, symbol):
                # Settled at once, so that tops which differ by pending reductions only are one.
                after = _settled(after)
                if after not in found:
                    found[after] = found[below] + 1
                    queue.append(after)
    return tuple(found.items())


def _settled(stack: tuple[int, ...]) -> tuple[int, ...]:
    """The stack after a reduction that every lookahead asks for, where the state offers nothing else."""
    table = _table()
    while not any((stack[-1], symbol) in table.moves for symbol in ("s", *ROLES)):
        rule = {r for (state, _), rules in table.reduces.items() if state == stack[-1] for r in rules}
        if len(rule) != 1 or table.rules[next(iter(rule))][0] == START or 0 in rule:
            break
        left, right = table.rules[rule.pop()]
        below = stack[:len(stack) - len(right)]
        stack = (*below, table.moves[below[-1], left])
    return stack


@lru_cache(maxsize=None)
def _edits(stack: tuple[int, ...], initial: str, fault: str) -> tuple[tuple[tuple[int, ...], int, str], ...]:
    """What the edits of one row, and insertions before it, make of a stack: (stack, cost, audit)."""
    found = []
    for below, inserts in _inserted(stack):
        cost, audit = INSERT * inserts, "I" * inserts
        found.append((below, cost + DELETE, audit + "D"))
        if fault == BAD:
            continue
        cost += UNFINISHED if fault == CUT else 0
        found.extend((_settled(after), cost + KEEP, audit + "K") for after in _table().shift(below, initial))
        found.extend((_settled(after), cost + REROLE, audit + "R") for symbol in ROLES for after in _table().shift(below, symbol))
    return tuple(found)


@lru_cache(maxsize=None)
def _endings(stack: tuple[int, ...]) -> tuple[int, ...]:
    return tuple(n for below, n in _inserted(stack) if _table().accepts(below))


@lru_cache(maxsize=1)
def _tops() -> tuple[tuple[int, ...], ...]:
    """One stack for each top that can stand between two rows."""
    found, queue = {0: (0,)}, [(0,)]
    for stack in queue:
        for symbol in ("s", *ROLES):
            for after in map(_settled, _table().shift(stack, symbol)):
                if after not in queue:
                    found.setdefault(after[-1], after)
                    queue.append(after)
    return tuple(found.values())


def parse(rows: list[tuple[str, str]], stack: tuple[int, ...] = (0,), end: bool = True) -> list[tuple[tuple[int, ...], int, str]]:
    """The cheapest repairs of (initial, fault) rows from a stack on: one if ``end``, else one for each top reached.

    A level of the graph-structured stack holds the tops after one row, each with the
    cheapest cost, the place of its audit among those of the level, the stack below
    and a link to the top it came from. Equal tops are merged by the least (cost,
    audit). Insertions stand before the row that follows them, so no audit of a level
    is the beginning of another and their order lasts.
    """
    level = {stack[-1]: (0, 0, stack)}
    links: list[dict] = []
    for initial, fault in rows:
        found: dict = {}
        for top, (cost, place, below) in level.items():
            for after, more, audit in _edits(below, initial, fault):
                entry = (cost + more, place, audit, top, after)
                known = found.get(after[-1])
                if known is None or entry[:3] < known[:3]:
                    found[after[-1]] = entry
        order = {top: k for k, top in enumerate(sorted(found, key=lambda t: found[t][1:3]))}
        level = {top: (cost, order[top], after) for top, (cost, _, _, _, after) in found.items()}
        links.append({top: (before, audit) for top, (_, _, audit, before, _) in found.items()})

    def audit(top: int) -> str:
        parts = []
        for known in reversed(links):
            top, text = known[top]
            parts.append(text)
        return "".join(reversed(parts))

    if not end:
        return [(below, cost, audit(top)) for top, (cost, _, below) in level.items()]
    done = [(cost + INSERT * n, place, "I" * n, top, below) for top, (cost, place, below) in level.items() for n in _endings(below)]
    cost, _, inserts, top, below = min(done)
    return [(below, cost, audit(top) + inserts)]


def damaged(rows: DataFrame) -> DataFrame:
    """``conv_id``, ``turn``, ``role`` and ``text`` (nulls: one space) with the planted faults of a test set.

    The CRC-32 of ``conv_id:turn`` modulo 20 decides: 0 drops the row, 1 empties its
    text, 2 takes out the marks that end a text, 3 repeats it, 4 makes its role user.
    """
    key = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    fault = F.pmod(F.crc32(key.cast("binary")), F.lit(20)).cast("int")
    split = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), fault.alias("fault")).filter("fault != 0")
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", ENDS, "")).otherwise(F.col("text"))
    return split.select("conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
                        F.explode(F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")).drop("copy")


def ordered(rows: DataFrame) -> DataFrame:
    """The rows with ``at``, a number that sorts them by conversation and turn, written to the shared folder.

    Rows of one turn (or without a turn, which come first) are ordered by role and the
    text's MD5 sum. A range sort deals a conversation of many rows, also of equal ones, over several tasks.
    """
    draw = F.pmod(F.xxhash64(F.spark_partition_id(), F.monotonically_increasing_id()), F.lit(1 << 20))
    order = ["conv_id", "turn", "role", "__digest", "__draw"]
    keyed = rows.select("conv_id", "turn", "role", "text", F.md5(F.col("text").cast("binary")).alias("__digest"), draw.alias("__draw"))
    sortd = keyed.repartitionByRange(*order).sortWithinPartitions(*order)
    return stored(sortd.drop("__digest", "__draw").withColumn("at", F.monotonically_increasing_id()), "turns")


def repair(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The cheapest repair of each conversation of ``ordered`` rows.

    Returns conversations (``conv_id``, ``gaps``, ``blank``, ``duplicate``,
    ``truncated``, ``illegal``, ``cost``, ``audit``) and segments (``conv_id``,
    ``at`` of its first row, ``expect``, the initial due there, ``audit``): the rows of a
    conversation that lie in one part of the order. Rows of a null ``conv_id`` are one conversation. A role's
    first character is what the grammar reads; an empty role has none and is in no
    grammar. No rows give no conversations.

    A conversation within one part is parsed from the empty stack. One that goes on
    in other parts (at most one at each border between parts) is parsed there from every
    top that can stand at the border; a chain over these few results picks the path.
    So a conversation of any share of the rows is parsed by many tasks.
    """
    core = F.regexp_replace("text", BLANK, "")
    blank = core == ""
    seen = turns.select("conv_id", "turn", "at", F.substring("role", 1, 1).alias("initial"), F.expr("shiftright(at, 33)").alias("part"),
                        blank.alias("blank"), (~blank & ~F.substring(core, -1, 1).rlike(ENDS)).alias("open"),
                        F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"), 256).alias("same"))
    slim = stored(seen.withColumn("conv", F.struct(F.col("conv_id").isNull().alias("no"), F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("id"))), "slim")
    again = slim.filter("not blank").groupBy("conv", "same").agg(F.min("at").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    # Parts follow the order, so a conversation that goes on crosses a border: there are fewer of them than parts.
    across = slim.groupBy("conv").agg(F.min("part").alias("low"), F.max("part").alias("high")).filter("low < high")
    marked = split_join(slim, again, ["conv", "same"], "left").join(across, ["conv"], "left")
    ready = marked.select("conv_id", "turn", "at", "part", "initial", "low", F.when(F.col("blank"), "blank").when(
        F.col("at") > F.col("first"), "duplicate").when(F.col("open"), "truncated").otherwise("").alias("fault"))
    kind = turns.schema["conv_id"].dataType.simpleString()
    schema = (f"conv_id {kind}, part long, at long, low long, entry int, leave int, cost long, audit string, rows long, blank long, duplicate long, "
              "truncated long, illegal long, head string, tail string, least long, most long, turns long, front long, back long")
    pieces = stored(ready.repartition("conv_id", "part").sortWithinPartitions("part", "at").mapInArrow(_pieces, schema), "pieces")

    whole = pieces.filter("low is null")
    crossing = pieces.filter("low is not null")
    # The audits stay in their rows: a chain needs their order at a border only.
    window = Window.partitionBy("conv_id", "part", "entry")
    small = crossing.withColumn("place", F.row_number().over(window.orderBy("audit"))).drop("audit")
    chained = small.groupBy("conv_id").applyInPandas(_chain, f"conv_id {kind}, part long, entry int, leave int, expect string, inserts int, total long, gaps long, illegal long")
    same = [crossing["conv_id"].eqNullSafe(chained["conv_id"]), *[crossing[c] == chained[c] for c in ("part", "entry", "leave")]]
    on = same[0] & same[1] & same[2] & same[3]
    path = crossing.drop("illegal").join(chained, on).select(
        crossing["conv_id"], crossing["part"], "at", "total", "gaps", "illegal", "blank", "duplicate", "truncated",
        "expect", F.concat("audit", F.repeat(F.lit("I"), F.col("inserts"))).alias("audit"))
    path = stored(path, "path")
    joined = path.groupBy("conv_id").agg(
        F.max("gaps").alias("gaps"), *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")], F.max("illegal").alias("illegal"),
        F.max("total").alias("cost"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "audit"))), lambda s: s["audit"]), "").alias("audit"))
    gaps = F.when(F.col("turns") > 0, F.col("most") - F.col("least") + 1 - F.col("turns")).otherwise(F.lit(0)).cast("long")
    single = whole.select("conv_id", gaps.alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    segments = whole.select("conv_id", "at", F.lit("u").alias("expect"), "audit").unionByName(path.select("conv_id", "at", "expect", "audit"))
    return single.unionByName(joined.select(single.columns)), segments


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The repairs of each run of rows of one conversation and part; rows come sorted by part and place."""
    held: list = []
    schema = None

    def results(found):
        columns = zip(*found, strict=True) if found else [[] for _ in schema]
        return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, schema, strict=True)], _COLUMNS)

    for batch in batches:
        schema = [batch.schema.field(0).type, *[pa.string() if c in ("audit", "head", "tail") else pa.int32() if c in ("entry", "leave")
                                                else pa.int64() for c in _COLUMNS[1:]]]
        done = []
        for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if held and (row[0], row[3]) != (held[0][0], held[0][3]):
                done.extend(_piece(held))
                held = []
            held.append(row)
        yield results(done)
    if held:
        yield results(_piece(held))


_COLUMNS = ["conv_id", "part", "at", "low", "entry", "leave", "cost", "audit", "rows", "blank", "duplicate", "truncated", "illegal",
            "head", "tail", "least", "most", "turns", "front", "back"]


def _piece(rows: list[tuple]) -> list[tuple]:
    conv, part, low = rows[0][0], rows[0][3], rows[0][5]
    initials = [r[4] for r in rows]
    faults = [r[6] for r in rows]
    seen = [(i, BAD if f in ("blank", "duplicate") else CUT if f else FINE) for i, f in zip(initials, faults, strict=True)]
    turns = [r[1] for r in rows if r[1] is not None]
    distinct = sum(a != b for a, b in zip(turns, turns[1:], strict=False)) + bool(turns)
    common = (len(rows), *[faults.count(f) for f in ("blank", "duplicate", "truncated")], illegal_pairs(initials), initials[0], initials[-1],
              *((min(turns), max(turns), distinct, turns[0], turns[-1]) if turns else (None, None, 0, None, None)))
    entries = [(0,)] if low is None or part == low else _tops()
    out = []
    for stack in entries:
        for below, cost, audit in parse(seen, stack, end=low is None):
            out.append((conv, part, rows[0][2], low, stack[-1], below[-1], cost, audit, *common))
    return out


def illegal_pairs(initials: list[str]) -> int:
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))


def _chain(frame: pd.DataFrame) -> pd.DataFrame:
    """The path through the parts of one conversation: least total cost, then least audit from the left."""
    stacks = {s[-1]: s for s in _tops()}
    parts = sorted(frame["part"].unique())
    rows = {part: [] for part in parts}
    for row in frame.itertuples():
        rows[row.part].append(row)
    # What each top at the end of a part still costs, from the last part back.
    left = {top: INSERT * min(_endings(stack), default=1 << 40) for top, stack in stacks.items()}
    togo = {parts[-1]: left}
    for before, part in zip(reversed(parts[:-1]), reversed(parts[1:]), strict=True):
        togo[before] = {top: min((r.cost + togo[part][r.leave] for r in rows[part] if r.entry == top), default=1 << 50) for top in stacks}
    out, top, total = [], 0, None
    for part in parts:
        best = min((r for r in rows[part] if r.entry == top), key=lambda r: (r.cost + togo[part][r.leave], r.place))
        total = int(best.cost + togo[part][best.leave]) if total is None else total
        inserts = min(_endings(stacks[best.leave])) if part == parts[-1] else 0
        expect = next(symbol for symbol in ROLES if _table().shift(stacks[top], symbol))
        out.append([frame["conv_id"].iloc[0], part, best.entry, best.leave, expect, inserts, total])
        top = best.leave
    each = [rows[part][0] for part in parts]
    filled = [r for r in each if r.turns > 0]
    turns = sum(r.turns for r in filled) - sum(a.back == b.front for a, b in zip(filled, filled[1:], strict=False))
    gaps = int(max(r.most for r in filled) - min(r.least for r in filled) + 1 - turns) if filled else 0
    illegal = int(sum(r.illegal for r in each)) + sum(illegal_pairs([a.tail, b.head]) for a, b in zip(each, each[1:], strict=False))
    return pd.DataFrame([[*row, gaps, illegal] for row in out], columns=["conv_id", "part", "entry", "leave", "expect", "inserts", "total", "gaps", "illegal"])


def repaired(turns: DataFrame, segments: DataFrame, together: bool = False) -> DataFrame:
    """The rows of the repaired conversations: ``conv_id``, ``at``, ``edit`` (K, R or I), ``role``, ``text``.

    ``at`` is that of the row, or of the row before which an insertion stands (of the last
    one, for insertions at the end). Rows of a conversation come in order within a
    partition; with ``together`` all of them in one partition, streamed and never held.
    """
    kind = turns.schema["conv_id"].dataType.simpleString()
    rows = turns.select("conv_id", "at", F.lit(1).alias("kind"), "role", "text")
    marks = segments.select("conv_id", "at", F.lit(0).alias("kind"), F.col("expect").alias("role"), F.col("audit").alias("text"))
    keys = ["conv_id"] if together else ["conv_id", F.expr("shiftright(at, 33)")]
    both = rows.unionByName(marks).repartition(*keys).sortWithinPartitions("conv_id", "at", "kind")
    return both.mapInArrow(_repaired, f"conv_id {kind}, at long, edit string, role string, text string")


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    audit, place, expected, last = "", 0, "u", 0

    def role_of(edit, role):
        """The role in the repaired sequence; an s stands first, then u and a take turns."""
        nonlocal expected
        if edit != "K":
            role = ROLES[expected]
        expected = "a" if role[:1] == "u" else "u"
        return role

    for batch in batches:
        out = [[] for _ in range(5)]

        def put(*row, out=out):
            for column, value in zip(out, row, strict=True):
                column.append(value)

        for owner, at, kind, role, text in zip(*[batch.column(k).to_pylist() for k in range(5)], strict=True):
            if kind == 0:
                audit, place, expected, last = text, 0, role, len(text.rstrip("I"))
                continue
            while audit[place] == "I":
                put(owner, at, "I", role_of("I", None), "")
                place += 1
            edit = audit[place]
            place += 1
            if edit != "D":
                put(owner, at, edit, role_of(edit, role), text)
            if place == last:
                for _ in range(len(audit) - last):
                    put(owner, at, "I", role_of("I", None), "")
        kinds = [batch.schema.field(0).type, pa.int64(), pa.string(), pa.string(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(out, kinds, strict=True)], ["conv_id", "at", "edit", "role", "text"])


def digests(rows: DataFrame) -> DataFrame:
    """``repaired_sha256`` of each conversation's ``role:text`` lines, from ``repaired(..., together=True)``; texts pass by one at a time.

    A digest of one text reads it from start to end, so one task streams a conversation's lines.
    """
    kind = rows.schema["conv_id"].dataType.simpleString()

    def run(batches):
        import hashlib

        conv, digest = None, None
        arrow = None
        for batch in batches:
            arrow = batch.schema.field(0).type
            owners, sums = [], []
            for owner, role, text in zip(*[batch.column(k).to_pylist() for k in (0, 3, 4)], strict=True):
                if (owner,) != conv:
                    if conv:
                        owners.append(conv[0])
                        sums.append(digest.hexdigest())
                    conv, digest = (owner,), hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update(f"{role}:{text}".encode())
            yield pa.RecordBatch.from_arrays([pa.array(owners, type=arrow), pa.array(sums, type=pa.string())], ["conv_id", "repaired_sha256"])
        if conv:
            yield pa.RecordBatch.from_arrays([pa.array([conv[0]], type=arrow), pa.array([digest.hexdigest()])], ["conv_id", "repaired_sha256"])

    return rows.mapInArrow(run, f"conv_id {kind}, repaired_sha256 string")
