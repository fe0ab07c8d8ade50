"""Conversation structure repair by a run-length dynamic program.

Every row of a conversation is one symbol: the class of its role's first letter (s, u,
a or another) and its first fault (none, truncated, blank, duplicate). Edits turn the
rows into a sequence whose role letters read ``(s?(ua)+)?`` at the least cost.

1. Equal rows (conversation, turn, role, text) are counted before they are shuffled; a
   row is a duplicate where its role and text have an earlier turn, or from its second
   copy on. Rows are range-partitioned in order and each task collapses equal
   consecutive symbols of a conversation to runs, so a conversation of any length is
   spread over tasks and meets as runs only.
2. A symbol is a 4 x 4 min-plus matrix over the states "nothing yet", "after s", "after
   u" and "after a". A run of r rows is a product of cached powers of two of its
   matrix. From the costs at the run borders the choices are unrolled, each run by
   halving it, always taking the least letter that keeps the cost.
3. Audits and texts are sorted into one stream a conversation, in which the repaired
   rows are hashed as they pass; texts are never gathered.

Defined cases: a null role or text is one space (so blank, and a role of no class); in
the damage key a null id or turn is one space, too. Rows without a turn come first;
rows of one turn are in order of role, then digest of the text. Rows without a
conv_id are one conversation. A conversation without rows has zeros, an empty
audit and the hash of the empty string. Extra columns are ignored; an empty table gives
no rows. The result holds one audit letter per row in one value, as asked for.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Damage modulus and codes, edit costs, faults.
MODULUS = 20
DROP, EMPTY, UNPUNCTUATED, REPEAT, AS_USER = range(5)
REROLE, DELETE, INSERT, TRUNCATED_KEPT = 1, 2, 5, 5
OK, TRUNCATED, BLANK, DUPLICATE = range(4)
LETTERS = "sua"
OTHER = 3
#: States: nothing yet, after s, after u, after a; NEXT[state] maps a role class to the state after it.
NEXT = ({0: 1, 1: 2}, {1: 2}, {2: 3}, {1: 2})
#: What an insertion or a new role must be in each state.
WANTED = (1, 1, 2, 1)
ROLE = {1: "user", 2: "assistant"}
FAR = 1 << 60
#: Runs of one conversation that a task holds before it emits them.
FLUSH = 100_000

Vector = tuple[int, int, int, int]


def times(matrix, vector: Vector) -> Vector:
    """Min-plus product: the least cost from each state before to the end."""
    return tuple(min(c + v for c, v in zip(row, vector)) for row in matrix)


def product(a, b):
    return tuple(tuple(min(a[i][k] + b[k][j] for k in range(4)) for j in range(4)) for i in range(4))


def _inserts():
    """Least cost of insertions from state to state."""
    cost = [[0 if i == j else FAR for j in range(4)] for i in range(4)]
    for i in range(4):
        at, paid = i, 0
        for _ in range(4):
            at, paid = NEXT[at][WANTED[at]], paid + INSERT
            cost[i][at] = min(cost[i][at], paid)
    return tuple(map(tuple, cost))


_INSERTS = _inserts()
#: Cost to end well from each state: nothing yet and after a are ends.
END: Vector = tuple(min(row[0], row[3]) for row in _INSERTS)


def choices(symbol: int, state: int) -> list[tuple[str, int, int]]:
    """(letter, cost, next state) of the edits that use up a row, in letter order."""
    role, fault = divmod(symbol, 4)
    out = [("D", DELETE, state)]
    if fault in (OK, TRUNCATED):
        extra = TRUNCATED_KEPT if fault == TRUNCATED else 0
        if role in NEXT[state]:
            out.append(("K", extra, NEXT[state][role]))
        out.append(("R", REROLE + extra, NEXT[state][WANTED[state]]))
    return out


@lru_cache(maxsize=None)
def power(symbol: int, k: int):
    """Transition of 2**k rows of a symbol, insertions before each row included."""
    if k:
        half = power(symbol, k - 1)
        return product(half, half)
    row = [[FAR] * 4 for _ in range(4)]
    for state in range(4):
        for _, cost, to in choices(symbol, state):
            row[state][to] = min(row[state][to], cost)
    return product(_INSERTS, row)


def advance(symbol: int, n: int, after: Vector) -> Vector:
    """Costs before a run of n rows, given those after it."""
    k = 0
    while n:
        if n & 1:
            after = times(power(symbol, k), after)
        n >>= 1
        k += 1
    return after


def _unroll(symbol: int, n: int, state: int, after: Vector, out: list[str]) -> int:
    """Append the least letters of n rows from a state; the state after them."""
    while n > 1:
        half = n // 2
        state = _unroll(symbol, half, state, advance(symbol, n - half, after), out)
        n -= half
    left = times(power(symbol, 0), after)[state]
    while True:
        options = choices(symbol, state)
        options.insert(1, ("I", INSERT, -1))
        for letter, cost, to in options:
            if letter == "I":
                to = NEXT[state][WANTED[state]]
                if cost + times(power(symbol, 0), after)[to] == left:
                    break
            elif cost + after[to] == left:
                break
        out.append(letter)
        state, left = to, left - cost
        if letter != "I":
            return state


def repair(runs: list[tuple[int, int]]) -> tuple[int, str]:
    """(least cost, ASCII-least audit of that cost) of a conversation's (symbol, rows) runs."""
    costs = [END]
    for symbol, n in reversed(runs):
        costs.append(advance(symbol, n, costs[-1]))
    costs.reverse()
    out: list[str] = []
    state = 0
    for (symbol, n), after in zip(runs, costs[1:]):
        state = _unroll(symbol, n, state, after, out)
    while END[state]:
        out.append("I")
        state = NEXT[state][WANTED[state]]
    return costs[0][0], "".join(out)


def illegal_pairs(runs: list[tuple[int, int]]) -> int:
    """Adjacent rows whose role letters are not su, ua or au."""
    legal = {(0, 1), (1, 2), (2, 1)}
    roles = [symbol // 4 for symbol, _ in runs]
    return sum(n - 1 for _, n in runs) + sum(pair not in legal for pair in zip(roles, roles[1:]))


def damage(rows: DataFrame) -> DataFrame:
    """Rows conv_id, turn, role, text after the damage that each row's key picks."""
    space = F.lit(" ")
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")))
    hit = (F.crc32(key.cast("binary")) % MODULUS).cast("int")
    rows = rows.select("conv_id", "turn", F.coalesce("role", space).alias("role"),
                       F.coalesce("text", space).alias("text"), hit.alias("hit")).where(F.col("hit") != DROP)
    text = (F.when(F.col("hit") == EMPTY, F.lit(""))
            .when(F.col("hit") == UNPUNCTUATED, F.translate("text", ".!?", "")).otherwise(F.col("text")))
    role = F.when(F.col("hit") == AS_USER, F.lit("user")).otherwise(F.col("role"))
    copies = F.explode(F.when(F.col("hit") == REPEAT, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return (rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), "hit")
            .select("conv_id", "turn", "role", "text", copies.alias("copy")).drop("copy"))


def _digest():
    return F.unhex(F.md5(F.col("text").cast("binary"))).alias("digest")


def symbols(rows: DataFrame) -> DataFrame:
    """Distinct rows with their number, role class, own fault and whether they are the first
    of their role and text: conv_id, turn, role, digest, n, class, fault, first."""
    letter = F.substring("role", 1, 1)
    role = F.lit(OTHER)
    for i, c in enumerate(LETTERS):
        role = F.when(letter == c, i).otherwise(role)
    last = F.substring(F.rtrim("text", F.lit(" \t\n\x0b\f\r")), -1, 1)
    fault = (F.when(last == "", BLANK).when(last.isin(".", "!", "?"), OK).otherwise(TRUNCATED))
    each = (rows.select("conv_id", "turn", "role", _digest(), role.alias("class"), fault.alias("fault"))
            .groupBy("conv_id", "turn", "role", "digest", "class", "fault").agg(F.count(F.lit(1)).alias("n")))
    # Nulls are the first turn: a flag beside the turn keeps them apart and in order.
    turn = F.struct(F.col("turn").isNotNull().alias("has"), F.col("turn").alias("turn"))
    first = (each.groupBy(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"))
             .agg(F.min(turn).alias("at")))
    both = each.join(first, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r"))
                     & (F.col("digest") == F.col("d")))
    return both.select("conv_id", "turn", "role", "digest", "n", "class", "fault",
                       (turn == F.col("at")).alias("first"))


_RUNS = "conv_id bigint, part int, seq int, runs array<struct<symbol:int,n:bigint>>"


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of each conversation in a task's ordered rows."""
    kind = pa.list_(pa.struct([("symbol", pa.int32()), ("n", pa.int64())]))
    part = TaskContext.get().partitionId()

    def emitted(conv, seq, runs):
        return pa.RecordBatch.from_arrays(
            [pa.array([conv], pa.int64()), pa.array([part], pa.int32()), pa.array([seq], pa.int32()),
             pa.array([[{"symbol": s, "n": n} for s, n in runs]], kind)], ["conv_id", "part", "seq", "runs"])

    current, seq, runs, begun = None, 0, [], False
    for batch in batches:
        for conv, n, role, fault, first in zip(*(c.to_pylist() for c in batch.columns)):
            if begun and (conv != current or len(runs) >= FLUSH):
                yield emitted(current, seq, runs)
                seq, runs = (0 if conv != current else seq + 1), []
            current, begun = conv, True
            again = fault if fault == BLANK else DUPLICATE
            for f, times_ in ((fault, 1), (again, n - 1)) if first else ((again, n),):
                symbol = 4 * role + f
                if runs and runs[-1][0] == symbol:
                    runs[-1][1] += times_
                elif times_:
                    runs.append([symbol, times_])
    if begun:
        yield emitted(current, seq, runs)


_AUDIT = "conv_id bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"


def _audits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for conv, parts in zip(*(c.to_pylist() for c in batch.columns)):
            runs: list[tuple[int, int]] = []
            for piece in parts:
                for r in piece["runs"]:
                    if runs and runs[-1][0] == r["symbol"]:
                        runs[-1] = (r["symbol"], runs[-1][1] + r["n"])
                    else:
                        runs.append((r["symbol"], r["n"]))
            count = lambda f: sum(n for s, n in runs if s % 4 == f)
            rows.append((conv, count(BLANK), count(DUPLICATE), count(TRUNCATED), illegal_pairs(runs), *repair(runs)))
        columns = list(zip(*rows)) if rows else [()] * 7
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in columns[:6]] + [pa.array(columns[6], pa.string())],
            ["conv_id", "blank", "duplicate", "truncated", "illegal", "cost", "audit"])


def audits(rows: DataFrame) -> DataFrame:
    """Fault counts, cost and audit of every conversation that has rows."""
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")]
    runs = (symbols(rows).repartitionByRange(*order).sortWithinPartitions(*order)
            .select("conv_id", "n", "class", "fault", "first").mapInArrow(_segments, _RUNS))
    return (runs.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("part", "seq", "runs"))).alias("parts"))
            .mapInArrow(_audits, _AUDIT))


_RESULT = ("conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, "
           "cost bigint, audit string, repaired_sha256 string")
_NAMES = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


class _Repaired:
    """The repaired rows of one conversation, hashed as they pass."""

    def __init__(self, conv, gaps):
        self.head, self.counts, self.audit = (conv, gaps), (0, 0, 0, 0, 0), ""
        self.at, self.state, self.hash, self.lines = 0, 0, sha256(), 0

    def _line(self, role: str, text: bytes) -> None:
        self.hash.update(b"\n" * bool(self.lines) + role.encode() + b":" + text)
        self.lines += 1
        letter = role[:1]
        self.state = NEXT[self.state][LETTERS.index(letter)]

    def _insertions(self) -> None:
        while self.audit[self.at:self.at + 1] == "I":
            self._line(ROLE[WANTED[self.state]], b"")
            self.at += 1

    def row(self, role: str, text: bytes) -> None:
        self._insertions()
        letter = self.audit[self.at]
        self.at += 1
        if letter == "K":
            self._line(role, text)
        elif letter == "R":
            self._line(ROLE[WANTED[self.state]], text)

    def result(self):
        self._insertions()
        return (*self.head, *self.counts, self.audit, self.hash.hexdigest())


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One result row for each conversation of a stream ordered by (conv_id, kind, row order)."""
    def emitted(rows):
        columns = list(zip(*rows))
        return pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in columns[:7]] + [pa.array(c, pa.string()) for c in columns[7:]], _NAMES)

    now = None
    for batch in batches:
        done = []
        for conv, kind, role, text, numbers, audit in zip(*(c.to_pylist() for c in batch.columns)):
            if kind == 0:
                if now is not None:
                    done.append(now.result())
                now = _Repaired(conv, numbers[0])
            elif kind == 1:
                now.counts, now.audit = tuple(numbers), audit
            else:
                now.row(role, text)
        if done:
            yield emitted(done)
    if now is not None:
        yield emitted([now.result()])


def repair_conversations(conversations: DataFrame, damaged: DataFrame | None = None) -> DataFrame:
    """Gaps, faults, cheapest repair, audit and hash of every conversation.

    ``damaged`` are the rows to repair (default: ``conversations`` as they are); the
    conversations of the result are those of ``conversations``.
    """
    rows = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    names = rows.select("conv_id")
    if damaged is not None:
        rows = damaged.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
                              "role", "text")
    turns = names.select("conv_id", F.lit(None).cast("bigint").alias("turn")).unionByName(rows.select("conv_id", "turn"))
    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0))
    none = lambda kind: F.lit(None).cast(kind)
    heads = turns.groupBy("conv_id").agg(F.array(gaps).alias("numbers")).select(
        "conv_id", F.lit(0).alias("kind"), none("bigint").alias("turn"), none("string").alias("role"),
        none("binary").alias("digest"), none("binary").alias("text"), "numbers", none("string").alias("audit"))
    found = audits(rows).select(
        "conv_id", F.lit(1).alias("kind"), none("bigint").alias("turn"), none("string").alias("role"),
        none("binary").alias("digest"), none("binary").alias("text"),
        F.array("blank", "duplicate", "truncated", "illegal", "cost").alias("numbers"), "audit")
    texts = rows.select("conv_id", F.lit(2).alias("kind"), "turn", "role", _digest(), F.col("text").cast("binary").alias("text"),
                        none("array<bigint>").alias("numbers"), none("string").alias("audit"))
    stream = (heads.unionByName(found).unionByName(texts).repartition("conv_id")
              .sortWithinPartitions("conv_id", "kind", F.col("turn").asc_nulls_first(), "role", "digest"))
    return stream.select("conv_id", "kind", "role", "text", "numbers", "audit").mapInArrow(_hashed, _RESULT)
