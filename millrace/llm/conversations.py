"""Conversation repair: the cheapest edits that give roles ``(system? (user assistant)+)?``, by a checkpointed DP.

Edits: Keep a row (0), Rerole it to user or assistant (2), Delete it (3; a must for blank rows and duplicates), Insert an
empty turn of user or assistant (2); a truncated row that stays costs 1.  Among the cheapest edits the initials that come
first in ASCII order win.  A state is what has been given so far (nothing, system, user, assistant), so one vector of four
costs says all about the rest of a conversation.  The vectors are made backward; only one in about the square root of the
rows is stored, the block between two of them is made again while the edits are read off forward.

The rows are sorted by a range partition, so a conversation of any length lies in consecutive pieces, one a task.  A piece
is a byte a row.  A conversation of several pieces is solved piece by piece: each gives the costs from any state to any
state, these are put together backward into the vector at its end, then its way from any state is chained forward to
the state it starts in.  Only the digest of the repaired text needs all rows of a conversation in one place; they pass
through in order and are not held.

Defined cases: null roles, texts and key parts count as one space; rows of one turn go by role, then by the first 64
characters of the text, then by its MD5; null turns come first; rows without conversation id are one conversation; a role
is known by its first letter, any other letter (and an empty role) can not be kept; a conversation without rows left gives
zeros, an empty audit and the digest of the empty text; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache
from itertools import pairwise
from math import isqrt

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.storage import stored

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
INF = 10**12
#: States: 0 nothing, 1 system, 2 user, 3 assistant given last.  Initials of rows: s, u, a, other.
START = 0
NEXT = (2, 2, 3, 2)  # the state after the one role that may be put in
KEPT = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}
INITIALS = "sua-"
FINE, BLANK, DUPLICATE, CUT = range(4)
SPACES = " \t\n\x0b\x0c\r"
Vector = tuple[int, int, int, int]


def _closed(base: list[int]) -> Vector:
    """Costs when turns may be put in first; more than two never help."""
    return tuple(min(base[q], INSERT + base[NEXT[q]], 2 * INSERT + base[NEXT[NEXT[q]]], INF) for q in range(4))


END: Vector = _closed([0, INF, INF, 0])


def _choices(code: int, after: Vector, q: int) -> list[tuple[str, int, int]]:
    """(letter, cost to the end, next state) of the edits of a row, without insertions, in ASCII order."""
    initial, fault = INITIALS[code >> 2], code & 3
    out = [("D", DELETE + after[q], q)]
    if fault not in (BLANK, DUPLICATE):
        late = TRUNCATED if fault == CUT else 0
        if (initial, q) in KEPT:
            out.append(("K", KEEP + late + after[KEPT[initial, q]], KEPT[initial, q]))
        out.append(("R", REROLE + late + after[NEXT[q]], NEXT[q]))
    return out


def _level(vector) -> tuple[int, Vector]:
    low = min(vector)
    return low, tuple(INF if x >= INF else x - low for x in vector)


@cache
def _before(code: int, after: Vector) -> Vector:
    return _closed([min(cost for _, cost, _ in _choices(code, after, q)) for q in range(4)])


@cache
def _edit(code: int, after: Vector, q: int) -> tuple[str, int]:
    """Initials of the edits up to and with this row, and the state after it: the ASCII-least tight ones."""
    now, done = _before(code, after), ""
    while True:
        tight = {letter: state for letter, cost, state in _choices(code, after, q) if cost == now[q]}
        if "D" in tight:
            return done + "D", tight["D"]
        if now[q] == INSERT + now[NEXT[q]]:
            done, q = done + "I", NEXT[q]
            continue
        letter = "K" if "K" in tight else "R"
        return done + letter, tight[letter]


def costs_before(codes: bytes, end: Vector) -> Vector:
    """The vector before the rows, from the one after them."""
    low, now = _level(end)
    for code in reversed(codes):
        more, now = _level(_before(code, now))
        low += more
    return tuple(min(x + low, INF) for x in now)


def edits(codes: bytes, end: Vector, state: int = START, last: bool = True) -> tuple[str, int]:
    """Initials of the edits of consecutive rows entered in ``state``, and the state after them.

    Vectors are kept at every block of about the square root of the rows only.
    """
    size = max(1, isqrt(len(codes)))
    blocks = range(0, len(codes), size)
    marks, now = {}, _level(end)[1]
    for at in reversed(blocks):
        marks[at] = now
        for code in reversed(codes[at : at + size]):
            now = _level(_before(code, now))[1]
    out = []
    for at in blocks:
        part, vectors = codes[at : at + size], [marks[at]]
        for code in reversed(part[1:]):
            vectors.append(_level(_before(code, vectors[-1]))[1])
        for code in part:
            letters, state = _edit(code, vectors.pop(), state)
            out.append(letters)
    while last and state not in (0, 3):
        out.append("I")
        state = NEXT[state]
    return "".join(out), state


def damage(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) with the fault that the hash of conversation and turn names; nulls are one space."""
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    kind = F.crc32(key) % 20
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    copies = F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1)
    damaged = rows.select("conv_id", "turn", F.when(kind == 4, "user").otherwise(role).alias("role"), text.alias("text"), copies.alias("_copies"))
    return damaged.withColumn("_nth", F.explode(F.sequence(F.lit(0), F.lit(1)))).where("_nth < _copies").drop("_nth", "_copies")


def _name(conv: Column) -> Column:
    """Conversation id as text; null has a name too."""
    return F.coalesce(F.concat(F.lit("c"), conv.cast("string")), F.lit(""))


def in_order(rows: DataFrame) -> DataFrame:
    """(conv, turn, role, text, pos): ``pos`` grows along each conversation; its upper bits number the pieces.  Stored."""
    named = rows.select(_name(F.col("conv_id")).alias("conv"), "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    named = named.withColumns({"_head": F.substring("text", 1, 64), "_md5": F.md5("text"), "_row": F.monotonically_increasing_id()})
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("_head"), F.col("_md5"), F.col("_row")]
    spread = named.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("pos", F.monotonically_increasing_id())
    return stored(spread.drop("_head", "_md5", "_row"))


def pieces(rows: DataFrame) -> DataFrame:
    """(conv, piece, pos, codes): one row per consecutive piece of a conversation, one byte per row: initial and first fault."""
    bare = F.rtrim(F.col("text"), F.lit(SPACES))
    same = F.sha2(F.concat_ws(":", F.length("conv"), "conv", F.length("role"), "role", "text"), 256)
    initial = F.lit(3)
    for at, letter in enumerate("sua"):
        initial = F.when(F.substring("role", 1, 1) == letter, at).otherwise(initial)
    cut = ~F.right(bare, F.lit(1)).isin(".", "!", "?")
    small = stored(rows.select("conv", "pos", initial.alias("initial"), (bare == "").alias("blank"), cut.alias("cut"), same.alias("same")))
    again = small.groupBy("same").agg(F.min("pos").alias("first"), F.count("*").alias("n")).where("n > 1")
    again = stored(again.select(F.col("same").alias("_same"), "first"))
    marked = small.join(again, F.col("same") == F.col("_same"), "left")
    fault = F.when(F.col("blank"), BLANK).when(F.col("pos") > F.col("first"), DUPLICATE).when(F.col("cut"), CUT).otherwise(FINE)
    coded = marked.select("conv", F.shiftright("pos", 33).alias("piece"), "pos", (F.col("initial") * 4 + fault).cast("int").alias("code"))
    coded = coded.repartition("conv", "piece").sortWithinPartitions("conv", "piece", "pos")
    return stored(coded.mapInArrow(_gather, "conv string, piece long, pos long, codes binary"))


def _gather(batches) -> Iterator[pa.RecordBatch]:
    key, codes, done = None, bytearray(), []

    def batch():
        made = pa.RecordBatch.from_pylist(done, pa.schema([("conv", pa.string()), ("piece", pa.int64()), ("pos", pa.int64()), ("codes", pa.binary())]))
        done.clear()
        return made

    for rows in batches:
        for conv, piece, pos, code in zip(*(c.to_pylist() for c in rows.columns), strict=True):
            if key is None or key[:2] != (conv, piece):
                if key is not None:
                    done.append({"conv": key[0], "piece": key[1], "pos": key[2], "codes": bytes(codes)})
                key, codes = (conv, piece, pos), bytearray()
            codes.append(code)
        if len(done) >= 10_000:
            yield batch()
    if key is not None:
        done.append({"conv": key[0], "piece": key[1], "pos": key[2], "codes": bytes(codes)})
    yield batch()


def _matrix(rows: DataFrame) -> DataFrame:
    """For each piece the costs from any state at its start to any state at its end."""

    def run(batches):
        for batch in batches:
            ends = [[0 if p == q else INF for p in range(4)] for q in range(4)]
            made = [[x for end in ends for x in costs_before(codes, tuple(end))] for codes in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(made, pa.list_(pa.int64()))], names=["conv", "piece", "costs"])

    return rows.select("conv", "piece", "codes").mapInArrow(run, "conv string, piece long, costs array<long>")


def _ends(group: pd.DataFrame) -> pd.DataFrame:
    """The vector after each piece, backward over the pieces of one conversation (at most one row per task)."""
    group, now, out = group.sort_values("piece", ascending=False), END, []
    for costs in group["costs"]:
        out.append(list(now))
        now = _closed([min(costs[4 * p + q] + now[p] for p in range(4)) for q in range(4)])
    return pd.DataFrame({"conv": group["conv"], "piece": group["piece"], "after": out})


def _ways(rows: DataFrame) -> DataFrame:
    """For each piece (conv, piece, codes, after) the state after it by the state before it."""

    def run(batches):
        for batch in batches:
            both = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)
            made = [[edits(codes, tuple(after), q, last=False)[1] for q in range(4)] for codes, after in both]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(made, pa.list_(pa.int64()))], names=["conv", "piece", "exits"])

    return rows.select("conv", "piece", "codes", "after").mapInArrow(run, "conv string, piece long, exits array<long>")


def _entries(group: pd.DataFrame) -> pd.DataFrame:
    group, state, out = group.sort_values("piece"), START, []
    for exits in group["exits"]:
        out.append(state)
        state = int(exits[state])
    last = [False] * (len(out) - 1) + [True]
    return pd.DataFrame({"conv": group["conv"], "piece": group["piece"], "state": out, "last": last})


def solved(found: DataFrame) -> DataFrame:
    """(conv, pos, codes, audit) for each piece."""
    several = stored(found.groupBy("conv").agg(F.count("*").alias("n")).where("n > 1").select("conv"))
    wide = found.join(several, "conv")
    ends = stored(_matrix(wide).groupBy("conv").applyInPandas(_ends, "conv string, piece long, after array<long>"))
    ways = _ways(wide.join(ends, ["conv", "piece"]))
    states = ways.groupBy("conv").applyInPandas(_entries, "conv string, piece long, state long, last boolean")
    told = stored(ends.join(states, ["conv", "piece"]))

    def run(batches):
        for batch in batches:
            conv, pos, codes = batch.columns[:3]
            made = []
            for known, after, state, last in zip(*(c.to_pylist() for c in batch.columns[2:]), strict=True):
                made.append(edits(known, tuple(after) if after else END, state or START, last is not False)[0])
            yield pa.RecordBatch.from_arrays([conv, pos, codes, pa.array(made, pa.string())], names=["conv", "pos", "codes", "audit"])

    every = found.join(told, ["conv", "piece"], "left").select("conv", "pos", "codes", "after", "state", "last")
    return every.mapInArrow(run, "conv string, pos long, codes binary, audit string")


class _Digest:
    """Counts and the running digest of one conversation; its pieces and rows come in order."""

    def __init__(self, conv: str):
        self.conv, self.hash, self.any, self.state = conv, hashlib.sha256(), False, START
        self.audit, self.faults, self.last, self.illegal, self.cost = [], [0, 0, 0, 0], "", 0, 0
        self.turns: list[int | None] = [None, None, 0]
        self.letters = iter(())

    def piece(self, codes: bytes, audit: str) -> None:
        self.rest()
        for code in codes:
            self.faults[code & 3] += 1
        roles = self.last + "".join(INITIALS[code >> 2] for code in codes)
        self.illegal += sum(a + b not in ("su", "ua", "au") for a, b in pairwise(roles))
        self.last = roles[-1]
        self.audit.append(audit)
        self.cost += sum({"D": DELETE, "I": INSERT, "R": REROLE}.get(x, KEEP) for x in audit)
        rows = iter(codes)
        self.cost += sum(TRUNCATED for x in audit if x != "I" and (next(rows) & 3) == CUT and x != "D")
        self.letters = iter(audit)

    def give(self, role: str, text: str) -> None:
        self.hash.update(f"{chr(10) if self.any else ''}{role}:{text}".encode("utf-8", "surrogatepass"))
        self.any = True

    def insert(self) -> None:
        self.state = NEXT[self.state]
        self.give("user" if self.state == 2 else "assistant", "")

    def row(self, turn: int | None, role: str, text: str) -> None:
        if turn is not None:
            low, high, n = self.turns
            self.turns = [turn if low is None else low, turn, n + (turn != high)]
        for letter in self.letters:
            if letter == "I":
                self.insert()
                continue
            if letter == "K":
                self.state = KEPT[role[:1], self.state]
                self.give(role, text)
            elif letter == "R":
                self.state = NEXT[self.state]
                self.give("user" if self.state == 2 else "assistant", text)
            return

    def rest(self) -> None:
        for _ in self.letters:
            self.insert()

    def result(self) -> dict:
        self.rest()
        low, high, n = self.turns
        gaps = 0 if low is None else high - low + 1 - n
        _, blank, duplicate, cut = self.faults
        found = {"conv": self.conv, "gaps": gaps, "blank": blank, "duplicate": duplicate, "truncated": cut}
        return found | {"illegal": self.illegal, "cost": self.cost, "audit": "".join(self.audit), "repaired_sha256": self.hash.hexdigest()}


_RESULT = "conv string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _digests(batches) -> Iterator[pa.RecordBatch]:
    now, done = None, []
    schema = pa.schema([(c, pa.string() if t == "string" else pa.int64()) for c, t in (x.split() for x in _RESULT.split(", "))])
    for batch in batches:
        for conv, _, codes, audit, turn, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if now is None or now.conv != conv:
                if now is not None:
                    done.append(now.result())
                now = _Digest(conv)
            if codes is not None:
                now.piece(codes, audit)
            else:
                now.row(turn, role, text)
        if len(done) >= 5_000:
            yield pa.RecordBatch.from_pylist(done, schema)
            done.clear()
    if now is not None:
        done.append(now.result())
    yield pa.RecordBatch.from_pylist(done, schema)


def repair(rows: DataFrame) -> DataFrame:
    """One row per conversation of (conv_id, turn, role, text): counts of faults, cost, audit and digest of the repaired rows.

    ``conv`` is the id as text after a ``c``, empty for null.
    """
    placed = in_order(rows)
    found = solved(pieces(placed))
    lines = placed.select("conv", "pos", F.col("turn").cast("long").alias("turn"), "role", "text")
    both = found.unionByName(lines, allowMissingColumns=True).select("conv", "pos", "codes", "audit", "turn", "role", "text")
    both = both.repartition("conv").sortWithinPartitions("conv", "pos", F.col("codes").isNull())
    return both.mapInArrow(_digests, _RESULT)


def report(rows: DataFrame) -> DataFrame:
    """:func:`repair` of the damaged rows, one row per original conversation."""
    mended = repair(damage(rows))
    every = rows.select("conv_id").distinct().withColumn("_conv", _name(F.col("conv_id")))
    joined = every.join(mended, F.col("_conv") == F.col("conv"), "left")
    counts = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in "gaps blank duplicate truncated illegal cost".split()]
    empty = F.sha2(F.lit(""), 256)
    return joined.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", empty).alias("repaired_sha256"))


def oracle() -> str:
    """DuckDB SQL for the query's rows: one recursion backward over the rows for the costs, one forward for the edits."""
    return r"""
    with recursive tab as (
        select list(list_reduce(list_prepend(b, range(8)), lambda c, i: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) order by b) as tab
        from (select unnest(range(256)) as b)
    ), keyed as (
        select *, coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as k from conversations
    ), kinds as (
        select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text, xor(list_reduce(list_prepend(4294967295,
            list_transform(range(length(k)), lambda i: ascii(substr(k, (i + 1)::int, 1))::bigint)), lambda c, b: xor(c >> 8, tab[((xor(c, b)) & 255) + 1])), 4294967295) % 20 as kind
        from keyed, tab
    ), damaged as (
        select coalesce('c' || conv_id, '') as conv, turn, case when kind = 4 then 'user' else role end as role,
            case when kind = 1 then '' when kind = 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
            unnest(range(case kind when 0 then 0 when 3 then 2 else 1 end)) as nth
        from kinds
    ), placed as (
        select conv, turn, role, text, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as bare, left(role, 1) as r,
            row_number() over (partition by conv order by turn nulls first, role, substr(text, 1, 64), md5(text), nth) as i
        from damaged
    ), told as (
        select *, case when bare = '' then 1 when row_number() over (partition by conv, role, text order by i) > 1 then 2
            when right(bare, 1) not in ('.', '!', '?') then 3 else 0 end as fault, lag(r) over (partition by conv order by i) as before
        from placed
    ), row as (select *, fault in (0, 3) as free, case fault when 3 then 1 else 0 end as late from told
    ), back as (
        select conv, max(i) + 1 as i, [0, 4, 2, 0]::bigint[] as b from row group by conv
        union all
        select conv, i, [least(c0, 2 + c2, 4 + c3), least(c1, 2 + c2, 4 + c3), least(c2, 2 + c3), least(c3, 2 + c2)] as b from (
            select row.conv, row.i,
                least(3 + b[1], case when free and r = 's' then late + b[2] when free and r = 'u' then late + b[3] end, case when free then 2 + late + b[3] end) as c0,
                least(3 + b[2], case when free and r = 'u' then late + b[3] end, case when free then 2 + late + b[3] end) as c1,
                least(3 + b[3], case when free and r = 'a' then late + b[4] end, case when free then 2 + late + b[4] end) as c2,
                least(3 + b[4], case when free and r = 'u' then late + b[3] end, case when free then 2 + late + b[3] end) as c3
            from back join row on row.conv = back.conv and row.i = back.i - 1)
    ), edit as (
        select conv, 1::bigint as i, 0 as q, '' as audit, []::varchar[] as given from back where i = 1
        union all
        select conv, case when x = 'I' then i else i + 1 end, case x when 'D' then q when 'K' then kept else nx end, audit || x,
            case x when 'D' then given when 'K' then list_append(given, role || ':' || text)
                else list_append(given, case nx when 2 then 'user:' else 'assistant:' end || case x when 'R' then text else '' end) end
        from (select *, case when role is null then 'I' when 3 + later[q + 1] = now[q + 1] then 'D' when 2 + now[nx + 1] = now[q + 1] then 'I'
                when kept is not null and free and late + later[kept + 1] = now[q + 1] then 'K' else 'R' end as x
            from (select e.*, role, text, free, late, b.b as now, a.b as later, case q when 2 then 3 else 2 end as nx,
                    case when r = 's' and q = 0 then 1 when r = 'u' and q in (0, 1, 3) then 2 when r = 'a' and q = 2 then 3 end as kept
                from edit e join back b on b.conv = e.conv and b.i = e.i left join back a on a.conv = e.conv and a.i = e.i + 1
                left join row on row.conv = e.conv and row.i = e.i where not (row.conv is null and q in (0, 3))))
    ), ended as (
        select edit.conv, audit, sha256(array_to_string(given, chr(10))) as digest from edit
        join (select conv, max(i) as n from row group by conv) l on l.conv = edit.conv and edit.i = n + 1 where q in (0, 3)
    ), counts as (
        select conv, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (fault = 1) as blank, count(*) filter (fault = 2) as duplicate,
            count(*) filter (fault = 3) as truncated, count(*) filter (before is not null and before || r not in ('su', 'ua', 'au')) as illegal
        from row group by conv
    )
    select o.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate, coalesce(truncated, 0) as truncated,
        coalesce(illegal, 0) as illegal, coalesce(b[1], 0) as cost, coalesce(audit, '') as audit, coalesce(digest, sha256('')) as repaired_sha256
    from (select distinct conv_id from conversations) o left join counts c on c.conv = coalesce('c' || o.conv_id, '')
        left join ended on ended.conv = c.conv left join back on back.conv = c.conv and back.i = 1
    """
