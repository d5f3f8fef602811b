"""Conversation repair against all edit sequences on small conversations, and a plain DP on larger ones."""

import hashlib
import itertools
import random
import zlib

import pytest

from millrace.llm import conversations
from tests.llm.helpers import rows_of

SCHEMA = "conv_id long, turn long, role string, text string"
WHITE = " \t\n\x0b\x0c\r"


def good(roles):
    rest = roles[1:] if roles[:1] == "s" else roles
    return roles == "" or (len(rest) > 0 and rest == "ua" * (len(rest) // 2))


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        bare = text.rstrip(WHITE)
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def all_edits(rows, most_inserts):
    """(cost, audit, repaired) of the best edits among all, with at most so many inserts in each gap."""
    found = faults(rows)
    gaps = [[""], ["u"], ["a"], ["ua"], ["au"], ["uau"], ["aua"]][: 1 + 2 * most_inserts]
    per_row = []
    for (_, role, text), fault in zip(rows, found, strict=True):
        late = 1 if fault == "truncated" else 0
        options = [("D", 3, None)]
        if fault not in ("blank", "duplicate"):
            options += [("K", late, (role, text)), ("R", 2 + late, ("user", text)), ("R", 2 + late, ("assistant", text))]
        per_row.append(options)
    best = None
    for chosen in itertools.product(*per_row):
        for inserted in itertools.product([g[0] for g in gaps], repeat=len(rows) + 1):
            out, audit, cost = [], "", 0
            for k in range(len(rows) + 1):
                for r in inserted[k]:
                    out.append(({"u": "user", "a": "assistant"}[r], ""))
                    audit, cost = audit + "I", cost + 2
                if k < len(rows):
                    audit, cost = audit + chosen[k][0], cost + chosen[k][1]
                    if chosen[k][2]:
                        out.append(chosen[k][2])
            if (best is None or (cost, audit) < best[:2]) and good("".join(r[:1] or "-" for r, _ in out)):
                best = (cost, audit, "\n".join(f"{r}:{t}" for r, t in out))
    return best


def plain(rows, solve):
    """The result columns of one conversation, its rows in order."""
    turns = [t for t, _, _ in rows if t is not None]
    found = faults(rows)
    initials = [r[:1] for _, r, _ in rows]
    cost, audit, repaired = solve(rows)
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        *(found.count(f) for f in ("blank", "duplicate", "truncated")),
        sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials)),
        cost, audit, hashlib.sha256(repaired.encode()).hexdigest(),
    )


def forward(rows):
    """A plain forward search: per state the least (cost, audit) with what has been given."""
    found, now = faults(rows), {"": (0, "", ())}
    step = {"": "u", "s": "u", "u": "a", "a": "u"}
    named = {"u": "user", "a": "assistant"}

    def put(table, state, value):
        if state not in table or value[:2] < table[state][:2]:
            table[state] = value

    def inserted(table):
        for _ in range(3):
            for state, (cost, audit, out) in list(table.items()):
                put(table, step[state], (cost + 2, audit + "I", (*out, (named[step[state]], ""))))

    inserted(now)
    for (_, role, text), fault in zip(rows, found, strict=True):
        late, new = int(fault == "truncated"), {}
        for state, (cost, audit, out) in now.items():
            put(new, state, (cost + 3, audit + "D", out))
            if fault in ("blank", "duplicate"):
                continue
            if role[:1] == step[state] or (role[:1] == "s" and state == ""):
                put(new, role[:1], (cost + late, audit + "K", (*out, (role, text))))
            put(new, step[state], (cost + 2 + late, audit + "R", (*out, (named[step[state]], text))))
        now = new
        inserted(now)
    cost, audit, out = min((now[s] for s in ("", "a") if s in now), key=lambda v: v[:2])
    return cost, audit, "\n".join(f"{r}:{t}" for r, t in out)


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


def order(row):
    _, turn, role, text = row
    return (turn is not None, turn or 0, role.encode(), text[:64].encode(), hashlib.md5(text.encode()).hexdigest())


def expected(rows, solve=forward):
    left = damaged(rows)
    out = []
    for conv in {r[0] for r in rows}:
        mine = [r[1:] for r in sorted((r for r in left if r[0] == conv), key=order)]
        out.append((conv, *plain(mine, solve)))
    return sorted(out, key=repr)


def made(n, seed, longest=7, ids=None):
    rng = random.Random(seed)
    rows = []
    for conv in range(n) if ids is None else ids:
        for turn in range(rng.randrange(1, longest)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "u", "", None])
            text = rng.choice(["Yes.", "No!", "cut off", "", " \n", "Why? ", "a. b", "é", None, f"text {rng.randrange(99)}."])
            rows.append((conv, rng.choice([turn, turn, turn, turn + 2, None]), role, text))
    return rows


def test_plain_search_equals_all_edits():
    rng = random.Random(1)
    for _ in range(60):
        rows = [(t, rng.choice(["user", "assistant", "system", "x"]), rng.choice(["a.", "b", "", "a."])) for t in range(rng.randrange(4))]
        assert forward(rows) == all_edits(rows, 2)


def test_against_plain_search(spark):
    rows = made(300, 2) + [(None, t, r, x) for _, t, r, x in made(20, 3)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = conversations.report(frame.selectExpr("*", "'x' as conv", "'x' as pos", "'x' as codes", "1 as audit", "1 as piece"))
    assert rows_of(got) == expected(rows)


def test_query_against_plain_search(spark, sf_dir):
    from millrace.llm.queries import QUERIES

    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert rows_of(QUERIES["op11_conversation_repair"](spark, sf_dir)) == expected(rows)


def test_one_conversation_over_many_tasks(spark):
    """A third of the rows and more are one conversation (and one has no id): solved in pieces."""
    rng = random.Random(5)
    hot = [(7, t, rng.choice(["user", "assistant", "assistant", "system"]), rng.choice([f"t{t}.", "cut", "", f"u{t % 50}!"])) for t in range(3000)]
    rows = hot + made(200, 6, ids=range(100, 300)) + [(None, t, "user", "same.") for t in range(500)]
    got = conversations.report(spark.createDataFrame(rows, SCHEMA).repartition(7))
    assert rows_of(got) == expected(rows)


def test_blocks_give_what_the_whole_gives():
    rng = random.Random(8)
    for n in (0, 1, 2, 3, 10, 1000):
        codes = bytes(rng.randrange(4) * 4 + rng.choice([0, 0, 0, 1, 2, 3]) for _ in range(n))
        audit, state = conversations.edits(codes, conversations.END)
        assert state in (0, 3) and len(audit.replace("I", "")) == n
        for at in (0, n // 3, n):
            head, tail = codes[:at], codes[at:]
            middle = conversations.costs_before(tail, conversations.END)
            first, way = conversations.edits(head, middle, last=False)
            assert first + conversations.edits(tail, conversations.END, way)[0] == audit


@pytest.mark.parametrize("rows", [[], [(1, 0, "user", "x")] * 3])
def test_empty_and_repeated(spark, rows):
    assert rows_of(conversations.report(spark.createDataFrame(rows, SCHEMA))) == expected(rows)


def test_no_rows_left(spark):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    got = conversations.report(spark.createDataFrame([(gone, 0, "user", "x.")], SCHEMA)).collect()
    assert [tuple(r) for r in got] == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_query_against_sql(spark, duck, sf_dir):
    from millrace.llm.queries import ORACLES, QUERIES
    from tests.oracle import compare

    assert compare(spark, duck, QUERIES["op11_conversation_repair"], ORACLES["op11_conversation_repair"], sf_dir) == ""
