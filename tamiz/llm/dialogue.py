"""Repair of conversation structure by a dynamic program with square-root checkpoints.

A repaired conversation has role initials ``(s?(ua)+)?``. Rows are kept (0), rerolled to user or
assistant (2) or deleted (3, and blank and repeated rows have to be), and rows without text can be
inserted anywhere (2); a truncated row that stays costs 1 more. Of the cheapest edits those whose
initials (D, I, K, R) come first in ASCII order are taken.

The backward recursion gives, at each place and for each of the four states of the pattern, the least
cost of the rest. These vectors are stored only at checkpoints. The walk forward recomputes the
vectors of one block from its checkpoint and takes the least letter among the tight edits. Blocks are
about as long as the square root of the longest conversation. A conversation of one block is done
where it is; of a longer one each block's cost matrix is found by itself, the vectors at its block
ends follow from the matrices, and the blocks are walked from their entry states, all as rows of Spark.

Rows are put in order by one sort over the cluster, so a conversation that holds a third of all rows
is dealt over tasks. Only the digest of the repaired text, which has to be taken in order, passes
through one task per conversation, in a stream of bounded batches.

Odd input: a null role or text is one space, a null turn comes first, rows of the same turn go by role
and then text (code points), repeated rows are duplicates, rows without a conversation id are one
conversation, an empty table gives none. Roles other than those that begin with s, u or a can only be
rerolled or deleted. Extra columns are not kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import pairwise
from math import isqrt

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamiz.session import materialize

BLANKS = " \t\n\x0b\x0c\r"
LEAST_BLOCK_BITS = 10  # no block is planned shorter than 1,024 rows
START, SYSTEM, USER, ASSISTANT = range(4)
# The state that a kept row of class s, u, a or another leads to; None where it is not allowed.
KEEP = (
    (SYSTEM, USER, None, None),
    (None, USER, None, None),
    (None, None, ASSISTANT, None),
    (None, USER, None, None),
)
NEXT = (USER, USER, ASSISTANT, USER)  # where an inserted or rerolled row leads to
ADDED = {USER: "user", ASSISTANT: "assistant"}
LEGAL = {(0, 1), (1, 2), (2, 1)}  # neighbouring classes su, ua, au
END = (0, 4, 2, 0)  # cost of the rest after the last row
FAR = 1 << 40
SOUND, TRUNCATED, FAULTY = range(3)
SYMBOLS = "abcdefghijkl"  # class * 3 + fault


def _class_of(symbol: str) -> int:
    return SYMBOLS.index(symbol) // 3


def _step(symbol: str, after: tuple[int, ...]) -> tuple[int, ...]:
    """Least cost of the rest before a row, from that after it."""
    kind, fault = divmod(SYMBOLS.index(symbol), 3)
    costs = []
    for state in range(4):
        best = 3 + after[state]
        if fault != FAULTY:
            stays = min(2 + after[NEXT[state]], after[KEEP[state][kind]] if KEEP[state][kind] is not None else FAR)
            best = min(best, stays + (fault == TRUNCATED))
        costs.append(best)
    user = min(costs[USER], 2 + costs[ASSISTANT])
    return (min(costs[START], 2 + user), min(costs[SYSTEM], 2 + user), user, min(costs[ASSISTANT], 2 + costs[USER]))


def _choose(symbol: str, state: int, after: tuple[int, ...]) -> tuple[str, int]:
    """The ASCII-least tight edits that use up a row, and the state they lead to."""
    kind, fault = divmod(SYMBOLS.index(symbol), 3)
    before, letters = _step(symbol, after), ""
    while True:
        rest, kept = before[state], KEEP[state][kind]
        extra = fault == TRUNCATED
        if 3 + after[state] == rest:
            return letters + "D", state
        if 2 + before[NEXT[state]] == rest:
            letters, state = letters + "I", NEXT[state]
        elif fault != FAULTY and kept is not None and extra + after[kept] == rest:
            return letters + "K", kept
        else:
            return letters + "R", NEXT[state]


class Solver:
    """The two recursions, with their steps remembered: only the differences within a vector matter."""

    def __init__(self):
        self.steps: dict = {}
        self.choices: dict = {}

    def back(self, symbols: str, vector: tuple[int, ...], total: int, keep: list | None = None):
        """Vector and its least value before ``symbols``; ``keep`` gets the ones after each symbol."""
        steps = self.steps
        for symbol in reversed(symbols):
            if keep is not None:
                keep.append(vector)
            known = steps.get((symbol, vector))
            if known is None:
                raw = _step(symbol, vector)
                low = min(raw)
                known = steps[symbol, vector] = (tuple(min(v - low, FAR) for v in raw), low)
            vector = known[0]
            total += known[1]
        return vector, total

    def walk(self, symbols: str, state: int, tail: tuple[int, ...]) -> tuple[str, int]:
        """Audit of ``symbols`` from ``state`` on, and the state it ends in; ``tail`` is the cost vector after them."""
        low = min(tail)
        vector = tuple(v - low for v in tail)
        block = isqrt(len(symbols)) + 1
        checkpoints = []
        for begin in range((len(symbols) - 1) // block * block, -1, -block):
            checkpoints.append(vector)
            vector, _ = self.back(symbols[begin:begin + block], vector, 0)
        letters, choices = [], self.choices
        for begin in range(0, len(symbols), block):
            part, after = symbols[begin:begin + block], []
            self.back(part, checkpoints.pop(), 0, after)
            for symbol in part:
                key = (symbol, state, after.pop())
                known = choices.get(key)
                if known is None:
                    known = choices[key] = _choose(*key)
                letters.append(known[0])
                state = known[1]
        return "".join(letters), state

    def cost(self, symbols: str, state: int, tail: tuple[int, ...]) -> int:
        low = min(tail)
        vector, total = self.back(symbols, tuple(v - low for v in tail), low)
        return vector[state] + total

    def matrix(self, symbols: str) -> list[int]:
        """Cost from each state before ``symbols`` to each state after them, row by row."""
        columns = []
        for end in range(4):
            vector, total = self.back(symbols, tuple(0 if s == end else FAR for s in range(4)), 0)
            columns.append([min(v + total, FAR) for v in vector])
        return [columns[end][begin] for begin in range(4) for end in range(4)]


def closing(state: int) -> str:
    """The rows inserted after the last one."""
    return "I" * (END[state] // 2)


def illegal_pairs(symbols: str) -> int:
    return sum((_class_of(a), _class_of(b)) not in LEGAL for a, b in pairwise(symbols))


def damage(conversations: DataFrame) -> DataFrame:
    """The rows after damage by ``crc32(conv_id:turn) % 20``, with ``present``.

    A dropped row stays as one that is not present, so that its conversation is still known.
    """
    blank = F.lit(" ")
    text = F.coalesce(F.col("text"), blank)
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), blank) for c in ("conv_id", "turn")))
    kind = F.crc32(key) % 20
    return conversations.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(F.coalesce("role", blank)).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        (kind != 0).alias("present"),
        F.explode(F.array_repeat(F.lit(1), F.when(kind == 3, 2).otherwise(1))).alias("copy"),
    ).drop("copy")


def _ordered(rows: DataFrame) -> DataFrame:
    """The rows stored in order, with their place ``at`` and what the text says about faults."""
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role"]
    # The prefix has the order of the text, so the sort within each range completes that of the ranges.
    dealt = rows.repartitionByRange(*order, F.substring("text", 1, 64)).sortWithinPartitions(*order, "text")
    trimmed = F.rtrim(F.col("text"), F.lit(BLANKS))
    known = dealt.withColumn("trimmed", trimmed).select(
        "*", F.monotonically_increasing_id().alias("at"), (F.col("trimmed") == "").alias("blank"),
        (~F.right("trimmed", F.lit(1)).isin(".", "!", "?")).alias("cut"),
        F.unhex(F.sha2("text", 256)).alias("digest"),
    )
    return materialize(known.drop("trimmed"), "dialogue-rows")


def _block_table(rows: DataFrame) -> DataFrame:
    """conv_id, block, at (its first row's), symbols, and counts of faults, of every block of rows."""
    present = rows.filter("present")
    longest = present.groupBy("conv_id").count().agg(F.max("count")).first()[0] or 0
    bits = max(LEAST_BLOCK_BITS, (isqrt(longest)).bit_length())
    # A row is no duplicate if it is the first of its role and text: places are unique, so this joins evenly.
    firsts = present.filter("NOT blank").groupBy("conv_id", "role", "digest").agg(F.min("at").alias("at"))
    marked = present.select("conv_id", "role", "at", "blank", "cut").join(
        firsts.select("at", F.lit(True).alias("first")), "at", "left"
    )
    again = ~F.col("blank") & F.col("first").isNull()
    short = ~F.col("blank") & ~again & F.col("cut")
    kind = F.left("role", F.lit(1))
    place = F.when(kind == "s", 0).when(kind == "u", 1).when(kind == "a", 2).otherwise(3)
    fault = F.when(F.col("blank") | again, FAULTY).when(short, TRUNCATED).otherwise(SOUND)
    symbol = F.substr(F.lit(SYMBOLS), place * 3 + fault + 1, F.lit(1))
    sorted_rows = F.array_sort(F.collect_list(F.struct("at", symbol.alias("symbol"))))
    blocks = marked.groupBy("conv_id", F.shiftright("at", bits).alias("block")).agg(
        F.min("at").alias("at"), F.array_join(sorted_rows["symbol"], "").alias("symbols"),
        *(F.count_if(c).alias(name) for name, c in (("n_blank", F.col("blank")), ("n_again", again), ("n_short", short))),
    )
    counted = blocks.withColumn("blocks", F.count(F.lit(1)).over(Window.partitionBy("conv_id")))
    return materialize(counted, "dialogue-blocks")


def _rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    for batch in batches:
        yield batch.to_pylist()


def _batch(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)


def _with(df: DataFrame, added: str, function) -> DataFrame:
    """Rows of ``df`` with the columns ``added``, which ``function(solver, row)`` gives as a dict."""
    from tamiz.llm.base import _arrow_schema

    schema = T.StructType(df.schema.fields + T.StructType.fromDDL(added).fields)
    wanted = _arrow_schema(df, schema)

    def run(batches):
        solver = Solver()
        for rows in _rows_of(batches):
            yield _batch([row | function(solver, row) for row in rows], wanted)

    return df.mapInArrow(run, schema)


def _whole(solver: Solver, row: dict) -> dict:
    """Audit and cost of a conversation of one block."""
    audit, state = solver.walk(row["symbols"], START, END)
    return {
        "audit": audit + closing(state), "cost": solver.cost(row["symbols"], START, END),
        "illegal": illegal_pairs(row["symbols"]),
    }


def _walked(solver: Solver, row: dict) -> dict:
    """Audit of one block of several, from its entry state and checkpoint."""
    audit, state = solver.walk(row["symbols"], row["entry"], tuple(row["tail"]))
    first = row["before"] is None
    boundary = not first and (_class_of(row["before"]), _class_of(row["symbols"][0])) not in LEGAL
    return {
        "audit": audit + (closing(state) if row["last"] else ""),
        "cost": solver.cost(row["symbols"], START, tuple(row["tail"])) if first else 0,
        "illegal": illegal_pairs(row["symbols"]) + boundary,
    }


def _by_conversation(df: DataFrame, added: str, function) -> DataFrame:
    """``function(rows)`` over the blocks of each conversation in order; they are as many as its square root."""
    from tamiz.llm.base import _arrow_schema

    schema = T.StructType(df.schema.fields + T.StructType.fromDDL(added).fields)
    wanted = _arrow_schema(df, schema)

    def run(group: pa.Table) -> pa.Table:
        rows = sorted(group.to_pylist(), key=lambda r: r["at"])
        return pa.Table.from_pylist([row | new for row, new in zip(rows, function(rows))], schema=wanted)

    return df.groupBy("conv_id").applyInArrow(run, schema)


def _tails(rows: list[dict]) -> list[dict]:
    """The checkpoint at the end of each block: the cost vector of all that follows it."""
    vector, out = END, []
    for row in reversed(rows):
        out.append({"tail": list(vector)})
        m = row["matrix"]
        vector = tuple(min(m[4 * s + e] + vector[e] for e in range(4)) for s in range(4))
    return out[::-1]


def _entries(rows: list[dict]) -> list[dict]:
    """The state in which the walk enters each block, and the symbol before it."""
    state, before, out = START, None, []
    for i, row in enumerate(rows):
        out.append({"entry": state, "before": before, "last": i == len(rows) - 1})
        state, before = row["exits"][state], row["symbols"][-1]
    return out


def _repaired_blocks(blocks: DataFrame) -> DataFrame:
    """Add ``audit``, ``illegal`` and ``cost`` (with the first block of a conversation) to every block."""
    result = "audit string, cost long, illegal long"
    single = _with(blocks.filter("blocks = 1"), result, _whole)
    several = blocks.filter("blocks > 1")
    if several.isEmpty():
        return single
    found = _with(several, "matrix array<long>", lambda solver, row: {"matrix": solver.matrix(row["symbols"])})
    placed = _by_conversation(found, "tail array<long>", _tails)
    walked = _with(placed.drop("matrix"), "exits array<int>", lambda solver, row: {
        "exits": [solver.walk(row["symbols"], state, tuple(row["tail"]))[1] for state in range(4)]
    })
    entered = _by_conversation(walked, "entry int, before string, last boolean", _entries)
    done = _with(entered.drop("exits"), result, _walked)
    return single.unionByName(done.select(single.columns))


class _Conversation:
    """Sums and the digest of one conversation, while its rows come by in order."""

    def __init__(self, conv_id):
        self.conv_id, self.sums = conv_id, [0, 0, 0, 0, 0]
        self.audits: list[str] = []
        self.waiting, self.state = iter(()), START
        self.digest, self.lines = hashlib.sha256(), 0
        self.low = self.high = None
        self.turns = 0

    def block(self, row) -> None:
        self.finish()
        for i, name in enumerate(("n_blank", "n_again", "n_short", "illegal", "cost")):
            self.sums[i] += row[name]
        self.audits.append(row["audit"])
        self.waiting = iter(row["audit"])

    def line(self, role: str, text: str = "") -> None:
        self.digest.update((("\n" if self.lines else "") + role + ":" + text).encode("utf-8"))
        self.lines += 1

    def add(self) -> str:
        self.state = NEXT[self.state]
        return ADDED[self.state]

    def row(self, turn, role: str, text: str) -> None:
        if turn is not None and turn != self.high:
            self.turns += 1
            self.low, self.high = turn if self.low is None else self.low, turn
        for letter in self.waiting:
            if letter == "I":
                self.line(self.add())
                continue
            if letter == "R":
                self.line(self.add(), text)
            elif letter == "K":
                self.state = KEEP[self.state]["sua".index(role[0])]
                self.line(role, text)
            return

    def finish(self) -> None:
        for _ in self.waiting:  # only inserted rows can be left
            self.line(self.add())

    def result(self) -> tuple:
        self.finish()
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        return (self.conv_id, gaps, *self.sums, "".join(self.audits), self.digest.hexdigest())


RESULT = (
    "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
    "repaired_sha256 string"
)


def repair(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``conv_id, turn, role, text, present``: faults, least cost, edits, digest.

    ``gaps`` is the number of turns missing between the least and the largest; ``illegal`` counts the
    neighbours whose initials are not su, ua or au; ``audit`` holds the edits' initials in order. A
    conversation without a present row has zeros, no edits and the digest of the empty text.
    """
    from tamiz.llm.base import _arrow_schema

    placed = _ordered(rows)
    blocks = _repaired_blocks(_block_table(placed))
    counts = ["n_blank", "n_again", "n_short", "illegal", "cost", "audit"]
    # A block comes before the first of its rows, and then every row finds its letter in the block's audit.
    head = blocks.select("conv_id", "at", F.lit(0).alias("rank"), *counts)
    body = placed.select("conv_id", "at", F.lit(1).alias("rank"), "turn", "role", "text", "present")
    stream = head.unionByName(body, allowMissingColumns=True).repartition("conv_id")
    schema = T.StructType([rows.schema["conv_id"]] + T.StructType.fromDDL(RESULT).fields)
    wanted = _arrow_schema(rows, schema)

    def run(batches):
        current = None
        for batch in batches:
            done = []
            for row in batch.to_pylist():
                if current is None or row["conv_id"] != current.conv_id:
                    if current is not None:
                        done.append(current.result())
                    current = _Conversation(row["conv_id"])
                if row["rank"] == 0:
                    current.block(row)
                elif row["present"]:
                    current.row(row["turn"], row["role"], row["text"])
            yield _columns(done)
        if current is not None:
            yield _columns([current.result()])

    def _columns(done):
        return pa.RecordBatch.from_arrays(
            [pa.array([d[i] for d in done], f.type) for i, f in enumerate(wanted)], schema=wanted
        )

    return stream.sortWithinPartitions("conv_id", "at", "rank").mapInArrow(run, schema)


def present_rows(conversations: DataFrame) -> DataFrame:
    """Rows of ``conv_id, turn, role, text`` as ``repair`` takes them, without any damage."""
    blank: Column = F.lit(" ")
    return conversations.select(
        "conv_id", "turn", F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"),
        F.lit(True).alias("present"),
    )
