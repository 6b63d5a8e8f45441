"""Conversation structure repair by Hirschberg's divide and conquer.

The turns of a conversation are edited into a legal sequence of role initials, ``(s?(ua)+)?``, at least cost. A turn may
be kept (0), given the role user or assistant (2), or deleted (3); an empty turn may be inserted anywhere (2); a truncated
turn that stays costs 1 more; blank and duplicate turns have to go. Edits are written as K, R, D and I; of all cheapest
edits, those whose letters are least in ASCII order are taken.

A legal sequence is read by four states: nothing yet, after s, after u, after a. Inserts come before the turn that they
precede, so a turn is one step between two states. A half of a conversation is a vector of four costs: forward, from its
begin to each state, and backward, from each state to its end. Both meet in the middle, in the state of least sum, and
each half is solved again with both its ends known, down to one turn. Forward vectors carry, beside the costs, the
order of the letters that lead to each state. That order is strict: letters that end in different states after the same
turn differ, and none is the begin of another, as each ends with the edit of that turn. So the crossing on the least letters
is known without keeping any letters, and memory is linear.

A conversation may have any number of turns. Records are sorted by range over all tasks and numbered; a conversation is
solved in blocks of at most ``BLOCK`` records. A first pass makes one table of costs and orders, entry state by exit
state, for every block; the tables of a conversation, 1/1024 of its records, fix the states at the edges of its blocks; a
second pass repairs all blocks apart from each other. Only ``digests``, whose SHA-256 has to see the turns in order, reads
a conversation in one task, as a stream with constant state besides the letters that it returns.

Edge cases. Null role or text: one space. Turns are ordered with nulls first; of equal turns by role and text, all in code
point order. Equal records (conversation, turn, role, text) are counted before anything is sorted. A null id is a conversation
of its own. A conversation that loses all turns has no edits. Other columns are ignored. Tables without rows give tables
without rows. Long texts travel as hashes but for the sort and the output.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.llm.arrow_runs import whole_groups
from flowlens.session import staged

BLOCK_BITS = 10
BLOCK = 1 << BLOCK_BITS
NONE, FAR = -1, 1 << 40
#: State after an inserted or re-roled turn; the state decides its role.
NEXT = (2, 2, 3, 2)
KEEP = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
#: Inserts that end a conversation in a legal state.
END = ("", "II", "I", "")
END_COST = np.array([0, 4, 2, 0])
#: Row kinds: role initial s, u, a, other; 4 more if truncated; the last kind has to be deleted.
INITIALS, DELETE = ("s", "u", "a", ""), 8


def _step(kind: int, state: int) -> dict[int, tuple[int, str]]:
    """Cheapest edits, then least letters, by the state after a turn. No insert comes before D: after it, it is less."""
    found: dict[int, tuple[int, str]] = {state: (3, "D")}
    cut = kind // 4 if kind < DELETE else 0
    at, cost = state, 0
    for inserts in range(3) if kind < DELETE else ():
        options = [(NEXT[at], cost + 2 + cut, "I" * inserts + "R")]
        kept = KEEP.get(INITIALS[kind % 4], {}).get(at)
        if kept is not None:
            options.append((kept, cost + cut, "I" * inserts + "K"))
        for to, price, letters in options:
            found[to] = min(found.get(to, (FAR, "")), (price, letters))
        at, cost = NEXT[at], cost + 2
    return found


LETTERS = [[["" for _ in range(4)] for _ in range(4)] for _ in range(DELETE + 1)]
COST = np.full((DELETE + 1, 4, 4), FAR, np.int64)
ORDER = np.full((DELETE + 1, 4, 4), 3, np.int64)
for _kind in range(DELETE + 1):
    for _state in range(4):
        _found = _step(_kind, _state)
        for _place, _to in enumerate(sorted(_found, key=lambda t: _found[t][1])):
            COST[_kind, _state, _to], LETTERS[_kind][_state][_to] = _found[_to]
            ORDER[_kind, _state, _to] = _place


def forward(cost: np.ndarray, order: np.ndarray, step_cost: np.ndarray, step_order: np.ndarray):
    """Costs and orders (n, 4) after one step each, and the state that each came from."""
    total = cost[:, :, None] + step_cost
    come = np.argmin(total * 4 + order[:, :, None], axis=1)
    rows, to = np.arange(len(cost))[:, None], np.arange(4)
    best = np.minimum(total[rows, come, to], FAR)
    letters = order[rows, come] * 4 + step_order[rows, come, to] + np.where(best < FAR, 0, 64)
    return best, np.argsort(np.argsort(letters, axis=1), axis=1), come


def _entry(states: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    cost = np.full((len(states), 4), FAR, np.int64)
    cost[np.arange(len(states)), states] = 0
    return cost, np.broadcast_to(np.arange(4), cost.shape).copy()


def _forward_over(kinds: np.ndarray, low: np.ndarray, high: np.ndarray, states: np.ndarray):
    """Forward vectors of many stretches [low, high), the longest first, from their entry states."""
    cost, order = _entry(states)
    for i in range(int((high - low).max(initial=0))):
        n = int(np.count_nonzero(high - low > i))
        kind = kinds[low[:n] + i]
        cost[:n], order[:n], _ = forward(cost[:n], order[:n], COST[kind], ORDER[kind])
    return cost, order


def tables(kinds: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Costs and orders (blocks, entry, exit) of the blocks between ``cuts``."""
    low, high = cuts[:-1], cuts[1:]
    by_length = np.argsort(low - high, kind="stable")
    low, high = np.repeat(low[by_length], 4), np.repeat(high[by_length], 4)
    cost, order = _forward_over(kinds, low, high, np.tile(np.arange(4), len(by_length)))
    back = np.argsort(by_length)
    return cost.reshape(-1, 4, 4)[back], order.reshape(-1, 4, 4)[back]


def edge_states(cost: np.ndarray, order: np.ndarray) -> tuple[list[int], int]:
    """States at the edges of the blocks of one conversation, and the cost of its cheapest edits."""
    now, place = _entry(np.zeros(1, np.int64))
    came = []
    for block_cost, block_order in zip(cost, order):
        now, place, come = forward(now, place, block_cost[None], block_order[None])
        came.append(come[0])
    total = now[0] + END_COST
    state = int(np.argmin(total * 4 + place[0]))
    least, states = int(total[state]), [state]
    for come in reversed(came):
        state = int(come[state])
        states.append(state)
    return states[::-1], least


def solve(kinds: np.ndarray, cuts: np.ndarray, entry: np.ndarray, exit_: np.ndarray) -> np.ndarray:
    """State before every record of all blocks between ``cuts``, whose states at both ends are given.

    All halves of one depth of the recursion are worked on together."""
    before = np.full(len(kinds), NONE, np.int64)
    low, high, begin, end = (np.asarray(a, np.int64) for a in (cuts[:-1], cuts[1:], entry, exit_))
    while len(low):
        before[low] = begin
        wide = high - low > 1
        low, high, begin, end = low[wide], high[wide], begin[wide], end[wide]
        if not len(low):
            break
        middle = (low + high + 1) // 2  # the left half is the longer one
        by_length = np.argsort(low - high, kind="stable")
        low, high, begin, end, middle = (a[by_length] for a in (low, high, begin, end, middle))
        cost, order = _forward_over(kinds, low, middle, begin)
        back, _ = _entry(end)
        for i in range(int((high - middle).max())):
            n = int(np.count_nonzero(high - middle > i))
            kind = kinds[high[:n] - 1 - i]
            back[:n] = np.minimum((COST[kind] + back[:n, None, :]).min(axis=2), FAR)
        crossing = np.argmin((cost + back) * 4 + order, axis=1)
        low, high = np.concatenate([low, middle]), np.concatenate([middle, high])
        begin, end = np.concatenate([begin, crossing]), np.concatenate([crossing, end])
    return before


def _one_space(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def is_blank(text: Column) -> Column:
    return ~text.rlike(r"[^\x20\x09-\x0D]")


def is_truncated(text: Column) -> Column:
    return ~text.rlike(r"[.!?][\x20\x09-\x0D]*\z")


def records(turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
            copies: Column | None = None) -> DataFrame:
    """(key, turn, role, text, copies, at, fault): distinct records in the order of ``at``, with their first fault.

    Written, as ``at`` must not change between passes."""
    rows = turns.select(F.col(key).alias("key"), F.col(turn).alias("turn"), _one_space(role).alias("role"),
                        _one_space(text).alias("text"), (F.lit(1) if copies is None else copies).cast("long").alias("copies"))
    keys = ["key", "turn", "role", "text"]
    placed = staged(
        rows.groupBy(*keys).agg(F.sum("copies").alias("copies")).repartitionByRange(*keys).sortWithinPartitions(*keys)
        .withColumn("at", F.monotonically_increasing_id()), "turns")
    # The first record of a role and text is found on the keys' hashes, and comes back by its number.
    firsts = (placed.where(~is_blank(F.col("text"))).groupBy("key", "role", F.sha2("text", 256).alias("digest"))
              .agg(F.min("at").alias("at")).select("at", F.lit(True).alias("first")))
    faults = (F.when(is_blank(F.col("text")), "blank").when(F.col("first").isNull(), "duplicate")
              .when(is_truncated(F.col("text")), "truncated"))
    return placed.join(firsts, "at", "left").withColumn("fault", faults).drop("first")


def _kinds(marked: DataFrame) -> DataFrame:
    initial = F.substring("role", 1, 1)
    kind = (F.when(F.col("fault").isin("blank", "duplicate"), DELETE).otherwise(
        F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
        + F.when(F.col("fault") == "truncated", 4).otherwise(0)))
    return marked.select("key", F.shiftright("at", BLOCK_BITS).alias("block"), "at", kind.cast("int").alias("kind"), "copies")


def _sorted(df: DataFrame, by: list[str], then: list[str]) -> DataFrame:
    return df.repartition(*by).sortWithinPartitions(*by, *then)


def _ints(table: pa.Table, column: str) -> np.ndarray:
    return table.column(column).to_numpy().astype(np.int64)


def _block_tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table, cuts in whole_groups(batches, ["key", "block"]):
        kinds = _ints(table, "kind")
        cost, order = tables(kinds, cuts)
        # Copies of a record go in any case.
        again = np.add.reduceat(3 * (_ints(table, "copies") - 1), cuts[:-1])
        firsts = pa.array(cuts[:-1])
        yield pa.RecordBatch.from_arrays([
            table.column("key").combine_chunks().take(firsts), table.column("block").combine_chunks().take(firsts), pa.array(again),
            pa.array([c.tobytes() for c in cost.astype("<i8")]), pa.array([o.tobytes() for o in order.astype("<i1")]),
        ], ["key", "block", "again", "cost", "letters"])


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table, cuts in whole_groups(batches, ["key"]):
        cost = [np.frombuffer(c, "<i8").reshape(4, 4) for c in table.column("cost").to_pylist()]
        order = [np.frombuffer(o, "<i1").reshape(4, 4).astype(np.int64) for o in table.column("letters").to_pylist()]
        again = _ints(table, "again")
        entry, exit_, total = [], [], []
        for a, b in zip(cuts[:-1], cuts[1:]):
            states, least = edge_states(np.array(cost[a:b]), np.array(order[a:b]))
            entry += states[:-1]
            exit_ += states[1:]
            # The cost of the conversation stands with its first block.
            total += [least + int(again[a:b].sum())] + [0] * int(b - a - 1)
        yield pa.RecordBatch.from_arrays([
            table.column("key").combine_chunks(), table.column("block").combine_chunks(),
            pa.array(entry, pa.int32()), pa.array(exit_, pa.int32()), pa.array(total, pa.int64()),
        ], ["key", "block", "entry", "exit", "cost"])


def _letters_of_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table, cuts in whole_groups(batches, ["key", "block"]):
        kinds = _ints(table, "kind")
        entry, exit_ = _ints(table, "entry")[cuts[:-1]], _ints(table, "exit")[cuts[:-1]]
        before = solve(kinds, cuts, entry, exit_)
        after = np.append(before[1:], 0)
        after[cuts[1:] - 1] = exit_
        edits = [LETTERS[k][a][b] for k, a, b in zip(kinds.tolist(), before.tolist(), after.tolist())]
        yield pa.RecordBatch.from_arrays([
            table.column("at").combine_chunks(), pa.array(edits, pa.string()), pa.array(before, pa.int32()),
            pa.array(after, pa.int32()), table.column("cost").combine_chunks(),
        ], ["at", "edits", "before", "after", "block_cost"])


def repair(marked: DataFrame) -> DataFrame:
    """``records`` with their edits: ``edits``, the letters of the first copy with the inserts before it (all other copies
    are deleted), the states ``before`` and ``after``, and ``block_cost``, which is the cost of the conversation on the
    records of its first block and 0 on the others."""
    kinds = _kinds(marked)
    kind = kinds.schema["key"].dataType.simpleString()
    blocks = _sorted(kinds, ["key", "block"], ["at"]).mapInArrow(
        _block_tables, f"key {kind}, block long, again long, cost binary, letters binary")
    edges = _sorted(blocks, ["key"], ["block"]).mapInArrow(_edges, f"key {kind}, block long, entry int, exit int, cost long")
    known = edges.withColumnsRenamed({"key": "of", "block": "number"})
    joined = kinds.join(known, (F.col("block") == F.col("number")) & F.col("key").eqNullSafe(F.col("of"))).drop("of", "number")
    letters = _sorted(joined, ["key", "block"], ["at"]).mapInArrow(
        _letters_of_blocks, "at long, edits string, before int, after int, block_cost long")
    return marked.join(letters, "at")


def _inserted(state: Column) -> Column:
    return F.when(state == 2, "assistant").otherwise("user")


def repaired_turns(edited: DataFrame) -> DataFrame:
    """(key, at, place, role, text): the repaired turns; inserts at the end of a conversation come last."""
    def turn(place, role, text):
        return F.struct(F.lit(place).alias("place"), role.alias("role"), text.alias("text"))

    empty, n = F.lit(""), F.length("edits")
    other = F.when(F.col("before") == 2, "user").otherwise("assistant")
    own = F.when(F.col("edits").endswith("R"), F.when(F.col("after") == 3, "assistant").otherwise("user")).otherwise(F.col("role"))
    parts = F.array(
        F.when(n > 1, turn(0, _inserted(F.col("before")), empty)), F.when(n > 2, turn(1, other, empty)),
        F.when(~F.col("edits").endswith("D"), turn(2, own, F.col("text"))))
    turns = edited.select("key", "at", F.explode(F.filter(parts, lambda p: p.isNotNull())).alias("t")).select("key", "at", "t.*")
    last = edited.groupBy("key").agg(F.max_by("after", "at").alias("state"), F.max("at").alias("at"))
    ends = F.array(F.when(F.col("state").isin(1, 2), turn(3, _inserted(F.col("state")), empty)),
                   F.when(F.col("state") == 1, turn(4, F.lit("assistant"), empty)))
    tail = last.select("key", "at", F.explode(F.filter(ends, lambda p: p.isNotNull())).alias("t")).select("key", "at", "t.*")
    return turns.unionByName(tail)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One conversation after the other, record by record."""
    key, held = None, None
    out: list[tuple] = []

    def emitted():
        keys, rest = pa.array([o[0] for o in out], key_type), list(zip(*out))[1:]
        return pa.RecordBatch.from_arrays(
            [keys, pa.array(rest[0], pa.int64()), pa.array(rest[1], pa.string()), pa.array(rest[2], pa.string())],
            ["key", "illegal", "audit", "digest"])

    def finish():
        letters = END[held["state"]]
        held["audit"].append(letters)
        state = held["state"]
        for _ in letters:
            add("assistant" if state == 2 else "user", "")
            state = NEXT[state]
        out.append((key, held["illegal"], "".join(held["audit"]), held["sha"].hexdigest()))

    def add(role, text):
        if held["any"]:
            held["sha"].update(b"\n")
        held["any"] = True
        held["sha"].update(f"{role}:{text}".encode())

    for batch in batches:
        key_type = batch.schema.field("key").type
        names = ("key", "role", "text", "copies", "edits", "before")
        for now, role, text, copies, edits, state in zip(*(batch.column(c).to_pylist() for c in names)):
            if held is None or now != key:
                if held is not None:
                    finish()
                key, held = now, {"sha": hashlib.sha256(), "any": False, "audit": [], "illegal": 0, "state": 0, "last": None}
            first = role[:1]
            held["illegal"] += copies - 1  # no initial may follow itself
            if held["last"] is not None and held["last"] + first not in ("su", "ua", "au"):
                held["illegal"] += 1
            held["last"] = first
            held["audit"].append(edits + "D" * (copies - 1))
            for letter in edits:
                if letter == "I":
                    add("assistant" if state == 2 else "user", "")
                    state = NEXT[state]
                elif letter == "R":
                    add("assistant" if state == 2 else "user", text)
                    state = NEXT[state]
                elif letter == "K":
                    add(role, text)
                    state = KEEP[first][state]
            held["state"] = state
        if len(out) > 5000:
            yield emitted()
            out = []
    if held is not None:
        finish()
        yield emitted()


def digests(edited: DataFrame) -> DataFrame:
    """(key, illegal, audit, digest): adjacent roles that may not follow each other before the repair, all letters in
    order, and the SHA-256 of the repaired turns, ``role:text`` by line."""
    kind = edited.schema["key"].dataType.simpleString()
    rows = edited.select("key", "at", "role", "text", "copies", "edits", "before")
    return _sorted(rows, ["key"], ["at"]).mapInArrow(_digests, f"key {kind}, illegal long, audit string, digest string")


def measures(edited: DataFrame) -> DataFrame:
    """(key, gaps, blank, duplicate, truncated, cost) of every conversation."""
    def faults(name, n):
        return F.coalesce(F.sum(F.when(F.col("fault") == name, n)), F.lit(0).cast("long"))

    # A stretch of equal turns may be long, so turns are made distinct before they are counted.
    again = F.col("copies") - 1
    not_deleted = F.col("fault").isNull() | (F.col("fault") == "truncated")
    by_turn = edited.groupBy("key", "turn").agg(
        faults("blank", F.col("copies")).alias("blank"),
        (faults("duplicate", F.col("copies")) + F.coalesce(F.sum(F.when(not_deleted, again)), F.lit(0))).alias("duplicate"),
        faults("truncated", F.lit(1)).alias("truncated"),
        F.max(F.struct(-F.col("at"), F.col("block_cost"))).alias("first"))
    wide = F.col("turn").cast("decimal(20,0)")
    gaps = F.coalesce((F.max(wide) - F.min(wide) + 1 - F.count("turn")).try_cast("long"), F.lit(0).cast("long"))
    return by_turn.groupBy("key").agg(
        gaps.alias("gaps"), *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")],
        F.max("first")["block_cost"].alias("cost"))
