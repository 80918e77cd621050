"""Chat formatting with minimum-cost role repair.

Legal conversations are an optional system turn, then user and assistant turns in alternation, the last an assistant's.  A dynamic
program over this automaton chooses for each turn, at least total cost, whether it keeps its role, is relabelled, is merged into the
turn before, or gets an empty turn inserted before it; then the repaired turns are rendered.

A step of the program is a (min, +) matrix over the automaton's states, and such matrices multiply in any grouping.  The turns are
sorted over the cluster.  A short conversation inside a partition, as almost all are, is rendered where it lies.  The turns of the others
get their places by counts and are cut by place and by text before them into parts of at most ``part`` turns, so that parts do not depend on
partitions; then only the parts' matrices meet, in blocks, and the blocks' products.  No task holds a whole long conversation.

Defined results: rows that repeat in all of (conv_id, turn, role, text), as they came, count once; roles are compared without letter
case and white space around them, and turns with equal numbers are ordered by role, then text; null turns come first; null and empty
texts are empty turns, one each; very long texts are kept whole; an unknown or null role has to be relabelled; rows with a null ``conv_id`` are one conversation; an empty table gives an empty table; other columns are not looked at.
Among equal costs keeping beats merging, merging beats relabelling, relabelling beats inserting, summed over the conversation; what then is
still equal goes to the lower role at a cut and to the first action elsewhere.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, small

START, SYSTEM, USER, ASSISTANT = range(4)
ROLES = ("system", "user", "assistant")
#: Costs stand above the sums of preferences in one number, so that both are minimised at once.
INF, COST = 1 << 61, 1 << 31
# Costs of the repairs.
MERGE, INSERT = 1, 2
RELABEL = {("system", "user"): 2, ("system", "assistant"): 3, ("user", "assistant"): 3, ("user", "system"): 4, ("assistant", "user"): 3, ("assistant", "system"): 4}
UNKNOWN = {"user": 1, "assistant": 1, "system": 4}
NEXT = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
#: Turns and characters of one part at most.
PART, PART_TEXT = 256, 16 << 20
#: Parts whose matrices one task multiplies.
BLOCK = 4096
SPACE = " \t\n\x0b\f\r"


def _inserts(a: int, b: int) -> tuple[int, ...] | None:
    """The empty turns that lead from state ``a`` to a turn of role ``b``, fewest first; None if none do."""
    if b in NEXT[a]:
        return ()
    for c in NEXT[a]:
        if c != SYSTEM and b in NEXT[c]:
            return (c,)
    return None


def steps(role: str | None, state: int) -> list[tuple[int, int, str, tuple[int, ...], int]]:
    """From ``state``, what a turn may become: (cost, preference, action, inserted turns, next state), best first."""
    role = role if role in ROLES else None
    out = []
    for k, name in enumerate(ROLES, 1):
        change = 0 if name == role else UNKNOWN[name] if role is None else RELABEL[role, name]
        if k == state:
            out.append((change + MERGE, 1 if not change else 2, "merge" if not change else "relabel+merge", (), k))
        filled = _inserts(state, k)
        if filled is not None:
            kind = ("relabel" if change else "keep") + ("+insert" if filled else "")
            out.append((change + INSERT * len(filled), 3 if filled else 2 if change else 0, kind, filled, k))
    return sorted(out)


STEPS = {(r, s): steps(r, s) for r in (*ROLES, None) for s in range(4)}
#: The empty turns that end a conversation legally.
CLOSING = {START: (USER, ASSISTANT), SYSTEM: (USER, ASSISTANT), USER: (ASSISTANT,), ASSISTANT: ()}


def step_matrix(role: str | None) -> np.ndarray:
    m = np.full((4, 4), INF, "i8")
    for s in range(4):
        for cost, preference, _, _, t in STEPS[role if role in ROLES else None, s]:
            m[s, t] = min(m[s, t], cost * COST + preference)
    return m


MATRIX = {r: step_matrix(r) for r in (*ROLES, None)}


def multiply(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.minimum((a[:, :, None] + b[None]).min(axis=1), INF)


def costs_to_go(roles: list[str | None], end: np.ndarray) -> np.ndarray:
    """Row i: the least cost from each state before turn i to the part's end, whose costs are ``end``."""
    out = np.empty((len(roles) + 1, 4), "i8")
    out[-1] = end
    for i in range(len(roles) - 1, -1, -1):
        out[i] = np.minimum((MATRIX[roles[i] if roles[i] in ROLES else None] + out[i + 1]).min(axis=1), INF)
    return out


def repair(turns: list[tuple[str | None, str]], enter: int, leave: int) -> list[tuple[int, str, str]]:
    """The repaired turns of a part between two states: (role, text, action); a merge is left as a row of its own, marked so."""
    end = np.full(4, INF, "i8")
    end[leave] = 0
    roles = [r for r, _ in turns]
    to_go = costs_to_go(roles, end)
    out, state = [], enter
    for i, (r, text) in enumerate(turns):
        cost, _, action, filled, nxt = min(((c * COST + p + int(to_go[i + 1][t]), p, a, f, t) for c, p, a, f, t in STEPS[r if r in ROLES else None, state]))
        out += [(k, "", "inserted") for k in filled]
        out.append((nxt, text, action))
        state = nxt
    return out


def render(rows: list[tuple[int, str, str]], closing: tuple[int, ...], first: bool) -> str:
    """The turns as text; a merged turn continues the one before it on a new line."""
    out = []
    for k, text, action in [*rows, *((k, "", "inserted") for k in closing)]:
        if action.endswith("merge"):
            out.append("\n" + text)
        else:
            out.append(("" if first and not out else "<|end|>\n") + f"<|{ROLES[k - 1]}|>\n{text}")
    return "".join(out)


CLOSE = np.array([INSERT * len(CLOSING[s]) * COST for s in range(4)], "i8")


def product_of(roles: list[str | None]) -> np.ndarray:
    m = None
    for r in roles:
        x = MATRIX[r if r in ROLES else None]
        m = x if m is None else multiply(m, x)
    return m


class _Cutter:
    """Tells the sorted turns of a partition: a row for each conversation inside it that is one part, and pieces of all others."""

    def __init__(self, most: int):
        self.most, self.before, self.rows, self.text = most, None, [], 0
        self.run, self.seq, self.cut, self.out = -1, 0, False, []

    def add(self, row: tuple) -> None:
        if row == self.before:
            return
        if self.before is None or row[0] != self.before[0]:
            # What lies at an edge of the partition may go on in the next one.
            self.flush(alone=self.run > 0 and not self.cut)
            self.run, self.cut = self.run + 1, False
        elif len(self.rows) >= self.most or self.text + len(row[3]) > PART_TEXT:
            self.cut = True
            self.flush(alone=False)
        self.before = row
        self.rows.append(row)
        self.text += len(row[3])

    def flush(self, alone: bool) -> None:
        if self.rows:
            self.out.append((self.rows[0][0], self.run, self.seq, alone, self.text, [r[2] for r in self.rows], [r[3] for r in self.rows]))
            self.seq += 1
        self.rows, self.text = [], 0


def _pieces(most: int, conv: pa.DataType):
    kinds = [conv, pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.string())]
    names = ["conv", "pid", "run", "seq", "alone", "chars", "roles", "texts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter, pid = _Cutter(most), TaskContext.get().partitionId()

        def told() -> pa.RecordBatch:
            rows, cutter.out = cutter.out, []
            cols = list(zip(*rows))
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip([cols[0], [pid] * len(rows), *cols[1:]], kinds)], names)

        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns)):
                cutter.add(row)
                if len(cutter.out) >= 512:
                    yield told()
            if cutter.out:
                yield told()
        cutter.flush(alone=False)
        if cutter.out:
            yield told()

    return run


def _places(pieces: DataFrame) -> DataFrame:
    """``pieces`` with the turns and characters of their conversation before them: counts within a partition, then of the partitions before."""
    sums = [F.sum(F.size("roles")).alias("n"), F.sum("chars").alias("c")]
    runs = pieces.groupBy("conv", "pid", "run").agg(*sums)
    before = lambda x, w: F.coalesce(F.sum(x).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    over_runs, inside = Window.partitionBy("conv").orderBy("pid"), Window.partitionBy("pid", "run").orderBy("seq")
    runs = runs.select("pid", "run", before("n", over_runs).alias("n0"), before("c", over_runs).alias("c0"))
    sized = pieces.select("pid", "run", "seq", F.size("roles").alias("n"), "chars").withColumns({"n1": before("n", inside), "c1": before("chars", inside)})
    at = sized.join(runs, ["pid", "run"]).select("pid", "seq", (F.col("n0") + F.col("n1")).alias("place"), (F.col("c0") + F.col("c1")).alias("before"))
    return pieces.join(small(materialise(at, "chat-places")), ["pid", "seq"])


def _cut_parts(pieces: DataFrame, part: int) -> DataFrame:
    """(conv, part, roles, texts): parts of at most ``part`` turns, cut by place, and where 16 MB of text are before; ``part``: the place of the first turn."""
    lengths = F.transform("texts", F.char_length)
    turns = F.transform("roles", lambda r, i: F.struct((F.col("place") + i).alias("place"), (F.col("before") + F.aggregate(F.slice(lengths, 1, i), F.lit(0).cast("long"), lambda a, x: a + x)).alias("before"), r.alias("role"), F.get("texts", i).alias("text")))
    each = _places(pieces).select("conv", F.inline_outer(turns))
    grouped = each.groupBy("conv", F.floor(F.col("place") / part).alias("k"), F.floor(F.col("before") / PART_TEXT).alias("t")).agg(F.array_sort(F.collect_list(F.struct("place", "role", "text"))).alias("turns"))
    return grouped.select("conv", F.get("turns", F.lit(0))["place"].alias("part"), F.transform("turns", lambda x: x["role"]).alias("roles"), F.transform("turns", lambda x: x["text"]).alias("texts"))


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        m = [product_of(roles).ravel().tolist() for roles in b.column("roles").to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("conv"), b.column("part"), pa.array(m, pa.list_(pa.int64()))], ["conv", "part", "m"])


def way(ms: list[np.ndarray], enter: int, end: np.ndarray) -> tuple[list[tuple[int, int]], int]:
    """The states at both ends of each matrix on the cheapest way from ``enter`` through all, if the states after the last cost ``end``; and its cost."""
    to_go = [end]
    for m in reversed(ms):
        to_go.append(np.minimum((m + to_go[-1]).min(axis=1), INF))
    to_go.reverse()
    state, out = enter, []
    for i, m in enumerate(ms):
        nxt = int((m[state] + to_go[i + 1]).argmin())
        out.append((state, nxt))
        state = nxt
    return out, int(to_go[0][enter])


def _matrix_list(t: pa.Table) -> list[np.ndarray]:
    return [np.array(x, "i8").reshape(4, 4) for x in t["m"].to_pylist()]


def _block_products(t: pa.Table) -> pa.Table:
    """One matrix for a block of a conversation's parts."""
    m = None
    for x in _matrix_list(t.sort_by("part")):
        m = x if m is None else multiply(m, x)
    return pa.table({"conv": t["conv"][:1].combine_chunks(), "block": t["block"][:1].combine_chunks(), "m": pa.array([m.ravel().tolist()], pa.list_(pa.int64()))})


def _block_states(t: pa.Table) -> pa.Table:
    """For a conversation's blocks: its states where it goes from one to the next, and its cost."""
    t = t.sort_by("block")
    states, cost = way(_matrix_list(t), START, CLOSE)
    n = len(states)
    columns = [t["conv"].combine_chunks(), t["block"].combine_chunks(), pa.array([s for s, _ in states], pa.int32()), pa.array([s for _, s in states], pa.int32())]
    return pa.table([*columns, pa.array([i == 0 for i in range(n)]), pa.array([i == n - 1 for i in range(n)]), pa.array([cost // COST] * n, pa.int64())], ["conv", "block", "enter", "leave", "first", "last", "cost"])


def _part_states(left: pa.Table, right: pa.Table) -> pa.Table:
    """The same for the parts within one block, between the states at its ends."""
    left, s = left.sort_by("part"), right.to_pylist()[0]
    end = np.full(4, INF, "i8")
    end[s["leave"]] = 0
    states, _ = way(_matrix_list(left), s["enter"], end)
    n = len(states)
    columns = [left["conv"].combine_chunks(), left["part"].combine_chunks(), pa.array([a for a, _ in states], pa.int32()), pa.array([b for _, b in states], pa.int32())]
    return pa.table([*columns, pa.array([s["first"] and i == 0 for i in range(n)]), pa.array([s["last"] and i == n - 1 for i in range(n)]), pa.array([s["cost"]] * n, pa.int64())], ["conv", "part", "enter", "leave", "first", "last", "cost"])


def _rendered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv_id", "part", "n_turns", "n_merged", "n_relabelled", "n_inserted", "cost", "rendered"]
    for b in batches:
        for lo in range(0, b.num_rows, 256):
            some, out = b.slice(lo, 256), []
            for r in some.to_pylist():
                if r["enter"] is None:
                    ((enter, leave),), cost = way([product_of(r["roles"])], START, CLOSE)
                    r |= {"enter": enter, "leave": leave, "first": True, "last": True, "cost": cost // COST}
                rows = repair(list(zip(r["roles"], r["texts"])), r["enter"], r["leave"])
                closing = CLOSING[r["leave"]] if r["last"] else ()
                text = render(rows, closing, r["first"]) + ("<|end|>\n" if r["last"] else "")
                actions = [x for _, _, x in rows]
                added = actions.count("inserted")
                out.append((r["part"], len(actions) - added, sum(x.endswith("merge") for x in actions), sum(x.startswith("relabel") for x in actions), added + len(closing), r["cost"], text))
            kinds = [pa.int64()] * 6 + [pa.string()]
            yield pa.RecordBatch.from_arrays([some.column(0), *(pa.array(c, k) for c, k in zip(zip(*out), kinds))], names)


STATES = "enter int, leave int, first boolean, last boolean, cost long"


def format_chats(chats: DataFrame, part: int = PART) -> DataFrame:
    """Repair and render every conversation of (conv_id, turn, role, text).

    A row for each part of a conversation (almost always one): conv_id, part (turns of the conversation before it), n_turns, n_merged,
    n_relabelled, n_inserted, cost (of the whole conversation) and rendered.  The texts of a conversation's parts, in the order of
    ``part``, are the conversation.
    """
    spark = chats.sparkSession
    rows = chats.select(
        F.col("conv_id").alias("conv"),
        F.coalesce(F.col("turn").cast("long"), F.lit(-(1 << 62))).alias("turn"),
        F.coalesce(F.lower(F.btrim(F.col("role").cast("string"), F.lit(SPACE))), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        # As they came: turns that differ in these only are different rows.
        F.col("role").cast("string").alias("raw_role"),
        F.struct(F.col("turn").isNull(), F.col("text").isNull()).cast("string").alias("nulls"),
    )
    kind = dict(rows.dtypes)["conv"]
    arrow = pa.int64() if kind == "bigint" else pa.int32() if kind == "int" else pa.string()
    if arrow == pa.string() and kind != "string":
        rows, kind = rows.withColumn("conv", F.col("conv").cast("string")), "string"
    order = ["conv", "turn", "role", "text", "raw_role", "nulls"]
    rows = rows.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order).sortWithinPartitions(*order)
    schema = f"conv {kind}, pid int, run long, seq long, alone boolean, chars long, roles array<string>, texts array<string>"
    pieces = materialise(rows.mapInArrow(_pieces(part, arrow), schema), "chat-pieces")
    parts = materialise(_cut_parts(pieces.where(~F.col("alone")), part), "chat-parts")
    matrices = materialise(parts.select("conv", "part", "roles").mapInArrow(_matrices, f"conv {kind}, part long, m array<long>"), "chat-matrices")
    block = F.floor(F.col("part") / (part * BLOCK))
    blocked = matrices.withColumn("block", block)
    ends = blocked.groupBy("conv", "block").applyInArrow(_block_products, f"conv {kind}, block long, m array<long>").groupBy("conv").applyInArrow(_block_states, f"conv {kind}, block long, {STATES}")
    states = blocked.groupBy("conv", "block").cogroup(ends.groupBy("conv", "block")).applyInArrow(_part_states, f"conv {kind}, part long, {STATES}")
    states = materialise(states, "chat-states")
    same = parts["conv"].eqNullSafe(states["conv"]) & (parts["part"] == states["part"])
    long = parts.join(small(states), same).select(parts["conv"], parts["part"], "roles", "texts", "enter", "leave", "first", "last", "cost")
    nothing = {"enter": "int", "leave": "int", "first": "boolean", "last": "boolean", "cost": "long"}
    alone = pieces.where("alone").select("conv", F.lit(0).cast("long").alias("part"), "roles", "texts", *[F.lit(None).cast(t).alias(c) for c, t in nothing.items()])
    return alone.unionByName(long).mapInArrow(_rendered, f"conv_id {kind}, part long, n_turns long, n_merged long, n_relabelled long, n_inserted long, cost long, rendered string")
