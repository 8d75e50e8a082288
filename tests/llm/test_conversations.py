import hashlib
import itertools
import re
import zlib

import pytest

from objsync.llm import conversations as c
from objsync.llm.queries import QUERIES

COSTS = {"K": 0, "R": 2, "D": 3, "I": 2}


def brute_repair(rows):
    """All edit sequences of a few rows; the least (cost, audit) and what it gives."""
    choices = []
    for role, text, fault in rows:
        own = [("D", None, 3)]
        if fault not in ("blank", "duplicate"):
            extra = fault == "truncated"
            own += [("K", (role, text), extra), ("R", ("user", text), 2 + extra), ("R", ("assistant", text), 2 + extra)]
        choices.append(own)
    inserts = [(), ("user",), ("assistant",), ("user", "assistant"), ("assistant", "user")]
    best = None
    for edits in itertools.product(*choices):
        for new in itertools.product(inserts, repeat=len(rows) + 1):
            lines, audit, cost = [], "", 0
            for extra, edit in zip(new, [*edits, None], strict=True):
                lines += [(role, "") for role in extra]
                audit += "I" * len(extra)
                cost += 2 * len(extra)
                if edit:
                    audit, cost = audit + edit[0], cost + edit[2]
                    lines += [edit[1]] if edit[1] else []
            if best is not None and (cost, audit) >= best[:2]:
                continue
            initials = [role[:1] or "-" for role, _ in lines]
            if re.fullmatch("(s?(ua)+)?", "".join(initials)):
                best = (cost, audit, lines)
    return best


def dp_repair(rows):
    """The same by a table over the three places of the grammar, with whole audits."""
    accept = {(0, "s"): 3, (0, "u"): 1, (3, "u"): 1, (1, "a"): 2, (2, "u"): 1}
    state = {0: (0, "", [])}

    def inserted(now):
        now = dict(now)
        for _ in range(3):
            for at, (cost, audit, lines) in list(now.items()):
                for role in ("user", "assistant"):
                    to = accept.get((at, role[0]))
                    if to is not None:
                        new = (cost + 2, audit + "I", [*lines, (role, "")])
                        now[to] = min(now.get(to, new), new, key=lambda t: t[:2])
        return now

    for role, text, fault in rows:
        after = {}

        def put(to, new, after=after):
            if to is not None:
                after[to] = min(after.get(to, new), new, key=lambda t: t[:2])

        for at, (cost, audit, lines) in inserted(state).items():
            put(at, (cost + 3, audit + "D", lines))
            if fault not in ("blank", "duplicate"):
                cost += fault == "truncated"
                put(accept.get((at, role[:1])), (cost, audit + "K", [*lines, (role, text)]))
                for new in ("user", "assistant"):
                    put(accept.get((at, new[0])), (cost + 2, audit + "R", [*lines, (new, text)]))
        state = after
    return min((v for at, v in inserted(state).items() if at in (0, 2)), key=lambda t: t[:2])


def brute_conversations(rows, search):
    """The whole result of the query, conversation by conversation."""
    found = {}
    for conv, turn, role, text in rows:
        kept = found.setdefault(conv, [])
        role, text = (" " if v is None else v for v in (role, text))
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault = zlib.crc32(key.encode()) % 20
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        role = "user" if fault == 4 else role
        kept.extend([(turn, role, text)] * {0: 0, 3: 2}.get(fault, 1))
    out = {}
    for conv, kept in found.items():
        kept.sort(key=lambda r: (r[0] is not None, r[0], r[1], hashlib.md5(r[2].encode()).hexdigest()))
        seen, listed = set(), []
        for _, role, text in kept:
            core = re.sub("[\x20\x09-\x0d]", "", text)
            fault = "blank" if not core else "duplicate" if (role, text) in seen else "truncated" if core[-1] not in ".!?" else ""
            seen.add((role, text))
            listed.append((role, text, fault))
        turns = [t for t, _, _ in kept if t is not None]
        cost, audit, lines = search(listed) if listed else (0, "", [])
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
                     *[sum(f == n for _, _, f in listed) for n in ("blank", "duplicate", "truncated")],
                     sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(listed, listed[1:], strict=False)),
                     cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest())
    return out


def test_table_reads_the_grammar():
    table = c.Table(c.GRAMMAR, c.START)
    for word in map("".join, itertools.product("sua", repeat=5)):
        for size in range(6):
            stacks = {(0,)}
            for symbol in word[:size]:
                stacks = {after for stack in stacks for after in table.shift(stack, symbol)}
            assert any(map(table.accepts, stacks)) == bool(re.fullmatch("(s?(ua)+)?", word[:size])), word[:size]


def test_parse_finds_the_least_repair():
    kinds = [("system", ""), ("user", ""), ("assistant", ""), ("tool", "truncated"), ("user", "blank"), ("assistant", "truncated")]
    for number, rows in enumerate(itertools.product(kinds, repeat=3)):
        listed = [(role, str(k), fault) for k, (role, fault) in enumerate(rows)]
        seen = [(role[:1], c.BAD if fault == "blank" else c.CUT if fault else c.FINE) for role, fault in rows]
        _, cost, audit = c.parse(seen)[0]
        want = brute_repair(listed) if number % 9 == 0 else dp_repair(listed)
        assert (cost, audit) == want[:2], rows
        assert want[:2] == dp_repair(listed)[:2]


def run(make, rows, parts=None):
    df = make(rows, "conv_id long, turn long, role string, text string", clash=True)
    turns = c.ordered(c.damaged(df).repartition(4))
    repairs, segments = c.repair(turns)
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    sums = {r["conv_id"]: r["repaired_sha256"] for r in c.digests(c.repaired(turns, segments, together=True)).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    got = {r["conv_id"]: (*[r[n] for n in names], sums.get(r["conv_id"], empty)) for r in repairs.collect()}
    lines = {}
    for r in sorted(c.repaired(turns, segments).collect(), key=lambda r: r["at"]):
        lines.setdefault(r["conv_id"], []).append((r["edit"], r["role"], r["text"]))
    return turns, got, lines


def made(conv, size, start=0):
    roles = ["system", "user", "assistant", "user", "tool", None, ""]
    texts = ["Well. ", "so", "", None, "What?", "Well. ", "x" * 30_000 + "!"]
    return [(conv, None if k % 11 == 7 else k // 2 * 2 % 40 + start, roles[k * k % 7], texts[(k * 3 + k // 5) % 7]) for k in range(size)]


def test_repair_against_brute_force(make):
    rows = [r for conv in [None, *range(1, 30)] for r in made(conv, 1 + (conv or 3) % 13)] + [(90, 1, "user", "Hi.")] * 3
    want = brute_conversations(rows, dp_repair)
    _, got, _ = run(make, rows)
    assert got == {k: v for k, v in want.items() if k in got}
    assert all(v[:7] == (0, 0, 0, 0, 0, 0, "") for k, v in want.items() if k not in got)


def test_a_conversation_over_many_parts(make, llm):
    old = llm.conf.get("spark.sql.shuffle.partitions"), llm.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    llm.conf.set("spark.sql.shuffle.partitions", 7)
    llm.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = made(5, 400) + made(None, 300) + made(8, 20) + [(6, None, "assistant", "So.")] * 100
        turns, got, lines = run(make, rows)
        assert turns.filter("conv_id = 5").selectExpr("shiftright(at, 33) p").distinct().count() > 1
        assert turns.filter("conv_id = 6").selectExpr("shiftright(at, 33) p").distinct().count() > 1
    finally:
        llm.conf.set("spark.sql.shuffle.partitions", old[0])
        llm.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old[1])
    want = brute_conversations(rows, dp_repair)
    assert got == want
    for conv, out in lines.items():
        text = "\n".join(f"{role}:{text}" for _, role, text in out)
        assert hashlib.sha256(text.encode()).hexdigest() == want[conv][-1]


def test_empty_table(make):
    _, got, lines = run(make, [])
    assert got == {} and lines == {}


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001"])
def test_query(llm, sf):
    rows = [tuple(r) for r in llm.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r["conv_id"]: tuple(r)[1:] for r in QUERIES["op13_lr_conversation_repair"](llm, sf).collect()}
    assert got == brute_conversations(rows, dp_repair)
