"""Repair of conversations: the cheapest edits that make roles alternate and every turn whole.

A Viterbi search runs over the turns of a conversation with four states: nothing yet, after a
system turn, after a user's, after an assistant's. Its paths are a tree of back pointers with
reference counts; what no survivor needs is let go, and edits are given out as soon as all
survivors share them, so the tree holds only what is still open. Paths of one cost are compared by
the whole of what is open of them.

Turns are dealt by ranges of (conversation, turn) and cut into segments of bounded size. One
that holds its whole conversation is decided at once. One that does not is searched from each
state it may begin in, and the same search, now over segments instead of turns, picks the
way through them.
"""

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanfield.llm.common import short_batches, stored

STATES = (0, 1, 2, 3)  # nothing, system, user, assistant
KEEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
NEXT = {0: 2, 1: 2, 2: 3, 3: 2}
ROLE = {2: "user", 3: "assistant"}
TAIL = {0: "", 1: "II", 2: "I", 3: ""}
# (a, b): whatever may follow in state b may follow in state a for so much more: for insertions first, or
# for deleting the system turn that only a beginning may keep. Survivors beaten by more are let go.
BRIDGE = {
    (0, 1): 0, (0, 2): 3, (0, 3): 0, (1, 2): 3, (1, 3): 6, (2, 0): 7, (2, 1): 3, (2, 3): 3, (3, 0): 4, (3, 1): 0, (3, 2): 3,
}
COST = {"K": 0, "R": 3, "D": 4, "I": 3}
TRUNCATED = 3
SEGMENT_ROWS, SEGMENT_BYTES = 2_000, 4 << 20

BLANK = r"^[\x20\x09-\x0D]*\z"
WHOLE = r"[.!?][\x20\x09-\x0D]*\z"
TURN = "struct<turn: long, role: string, text: string, fault: string>"
SEGMENT = f"conv_id long, segment long, whole boolean, costs array<long>, ranks array<int>, audits array<string>, turns array<{TURN}>"
EDITED = "conv_id long, segment long, place int, edit string, turn long, old_role string, text string, fault string, role string"


class Node:
    __slots__ = ("parent", "label", "refs")

    def __init__(self, parent: "Node | None", label: str):
        self.parent, self.label, self.refs = parent, label, 0
        if parent is not None:
            parent.refs += 1


class Survivors:
    """The cheapest path into each state, of equal ones the one with the least text."""

    def __init__(self, start: int):
        self.root = Node(None, "")
        self.root.refs = 1
        self.heads = {start: (0, self.root)}
        self.done: list[str] = []

    def open_text(self, node: Node) -> str:
        """The labels of a path that have not been given out."""
        labels = []
        while node is not self.root:
            labels.append(node.label)
            node = node.parent
        return "".join(reversed(labels))

    def least(self, ends) -> tuple[int, Node, str]:
        """The least of (cost, node, label) by cost, then by the whole open text."""
        low = min(e[0] for e in ends)
        tied = [e for e in ends if e[0] == low]
        return tied[0] if len(tied) == 1 else min(tied, key=lambda e: self.open_text(e[1]) + e[2])

    def step(self, edges, bridge=BRIDGE) -> None:
        """Go on by `edges` (state, next state, cost, label)."""
        into: dict[int, list] = {}
        for p, q, cost, label in edges:
            if p in self.heads:
                into.setdefault(q, []).append((self.heads[p][0] + cost, self.heads[p][1], label))
        best = {q: self.least(ends) for q, ends in into.items()}
        old, self.heads = self.heads, {}
        for q, (cost, node, label) in best.items():
            if not any(best[p][0] + more < cost for (p, to), more in bridge.items() if to == q and p in best):
                self.heads[q] = (cost, Node(node, label))
                self.heads[q][1].refs = 1
        for _, node in old.values():
            self.release(node)
        self.coalesce()

    def release(self, node: Node) -> None:
        node.refs -= 1
        while node.refs == 0 and node is not self.root:
            node = node.parent
            node.refs -= 1

    def coalesce(self) -> None:
        """Give out what all survivors share."""
        if self.root.refs != 1 or not self.heads:
            return
        way, node = [], next(iter(self.heads.values()))[1]
        while node is not self.root:
            way.append(node)
            node = node.parent
        while way and self.root.refs == 1:
            self.root = way.pop()
            self.done.append(self.root.label)
            self.root.parent = None

    def ends(self) -> dict[int, tuple[int, str]]:
        """Cost and text of the path into each state."""
        shared = "".join(self.done)
        return {q: (cost, shared + self.open_text(node)) for q, (cost, node) in self.heads.items()}

    def finish(self, tails: dict[int, str] = TAIL) -> tuple[int, str, int]:
        """Cost, text and last state of the best path, with the insertions that complete it."""
        ends = [(cost + 3 * len(tails[q]), node, tails[q], q) for q, (cost, node) in self.heads.items()]
        cost, node, tail, q = self.least(ends)
        return cost, "".join(self.done) + self.open_text(node) + tail, q


def moves(states, initial: str, fault: str | None) -> Iterator[tuple[int, int, int, str]]:
    """The edits of one turn, each after an insertion or not. (Deleting goes before inserting: D sorts first.)"""
    more = TRUNCATED if fault == "truncated" else 0
    for p in states:
        yield p, p, COST["D"], "D"
        if fault in ("blank", "duplicate"):
            continue
        for at, cost, label in ((p, more, ""), (NEXT[p], more + COST["I"], "I")):
            if (at, initial) in KEEP:
                yield p, KEEP[at, initial], cost, label + "K"
            yield p, NEXT[at], cost + COST["R"], label + "R"


def search(turns: list[dict], start: int) -> Survivors:
    found = Survivors(start)
    for turn in turns:
        found.step(moves(tuple(found.heads), turn["role"][:1], turn["fault"]))
    return found


def edits(turns: list[dict], audit: str, state: int) -> Iterator[tuple[str, dict | None, str | None]]:
    """Each edit with its turn and the role that comes out."""
    rest = iter(turns)
    for edit in audit:
        turn, role = (None if edit == "I" else next(rest)), None
        if edit == "K":
            role, state = turn["role"], KEEP[state, turn["role"][:1]]
        elif edit != "D":
            state = NEXT[state]
            role = ROLE[state]
        yield edit, turn, role


def ordered(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and fault of every turn, in ranges and order of conversation and turn.

    Turns of one number stand in the order of role, then of their text's md5. A duplicate is told by the earliest
    turn of its role and text, so a conversation of any size is judged in many tasks.
    """
    keyed = stored(
        turns.select(
            F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.coalesce(F.col("role"), F.lit(" ")).alias("role"),
            F.coalesce(F.col("text"), F.lit(" ")).alias("text"), F.monotonically_increasing_id().alias("row"),
        ).withColumn("digest", F.md5(F.col("text").cast("binary")))
    )
    blank = F.col("text").rlike(BLANK)
    place = F.struct(F.col("turn").isNotNull().alias("named"), "turn", "row")
    first = (
        keyed.where(~blank).groupBy("conv_id", "role", "digest")
        .agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
        .select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"), "first")
    )
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d"))
    fault = (
        F.when(blank, "blank").when(F.col("first").isNotNull() & (place > F.col("first")), "duplicate")
        .when(~F.col("text").rlike(WHOLE), "truncated")
    )
    order = ["conv_id", "turn", "role", "digest", "row"]
    return (
        keyed.join(first, same, "left").select(*order, "text", fault.alias("fault"))
        .repartitionByRange(*order).sortWithinPartitions(*order)
        .select("conv_id", "turn", "role", "text", "fault", F.spark_partition_id().alias("part"))
    )


def segments(most_rows: int, most_bytes: int):
    """Turns in order to segments; a whole one has its one audit, others have one for each start and end."""

    def cut(batches):
        part = number = size = 0
        run, opened, first = [], True, True

        def closed(ended: bool) -> pa.RecordBatch:
            """The run as a segment; `ended` tells whether the conversation ends with it."""
            whole = opened and ended and not first
            if whole:
                cost, audit, _ = search(run, 0).finish()
                costs, audits = [cost], [audit]
            else:
                found = [search(run, start).ends() for start in STATES]
                costs = [ends[q][0] if q in ends else None for ends in found for q in STATES]
                audits = [ends[q][1] if q in ends else None for ends in found for q in STATES]
            order = {a: i for i, a in enumerate(sorted({a for a in audits if a is not None}))}
            row = {
                "conv_id": run[0]["conv_id"], "segment": (part << 33) + number, "whole": whole, "costs": costs,
                "ranks": [order.get(a) for a in audits], "audits": audits,
                "turns": [{k: t[k] for k in ("turn", "role", "text", "fault")} for t in run],
            }
            return pa.RecordBatch.from_pylist([row], ROW)

        for batch in batches:
            for row in batch.to_pylist():
                ended = bool(run) and row["conv_id"] != run[0]["conv_id"]
                if ended or len(run) >= most_rows or size >= most_bytes:
                    yield closed(ended)
                    first, opened = first and not ended, ended
                    number, run, size = number + 1, [], 0
                part = row["part"]
                run.append(row)
                size += len(row["text"])
        if run:
            yield closed(False)  # the next range may go on with it

    return cut


ROW = pa.schema(
    [
        ("conv_id", pa.int64()), ("segment", pa.int64()), ("whole", pa.bool_()), ("costs", pa.list_(pa.int64())),
        ("ranks", pa.list_(pa.int32())), ("audits", pa.list_(pa.string())),
        ("turns", pa.list_(pa.struct([("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("fault", pa.string())]))),
    ]
)


def way(_, rows):
    """The audit to take of each segment of a conversation: its place among `audits`, and what is inserted at the end.

    A segment's audits are compared by their ranks. None of them begins another one of them: all end with
    the edit of the segment's last turn.
    """
    rows = rows.sort_values("segment")
    found = Survivors(0)
    for costs, ranks in zip(rows["costs"], rows["ranks"]):
        paths = [(k // 4, k % 4, int(c), chr(int(r)) + chr(16 + k)) for k, (c, r) in enumerate(zip(costs, ranks)) if not pd.isna(c)]
        found.step(paths, {})
    _, text, last = found.finish({q: "" for q in STATES} | {1: "..", 2: "."})
    picks = [ord(x) - 16 for x in text.rstrip(".")[1::2]]
    tails = [""] * (len(picks) - 1) + [TAIL[last]]
    return pd.DataFrame({"segment": rows["segment"], "pick": picks, "tail": tails})


def repair(turns: DataFrame, segment_rows: int = SEGMENT_ROWS, segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """One row per edit of `turns` (conv_id, turn, role, text), in the order of (conv_id, segment, place).

    `edit` is K (keep), R (rerole to user or assistant), D (delete) or I (insert an empty turn); `role` is what
    comes out (null of a deleted turn), `old_role`, `turn`, `text` and `fault` are those of the turn that went
    in (null, but an empty text, of an inserted one). K costs 0, R and I cost 3, D costs 4, a truncated turn
    that is not deleted costs 3 more; blank and duplicate turns must go. The cheapest edits are taken that leave roles
    whose initials read `(s?(ua)+)?`; of equally cheap ones the least text of initials.

    Null roles and texts count as one space. Turns without a number come first, a null conv_id is a
    conversation of its own. A role without any letter cannot be kept. Repeated rows are duplicates. An
    empty table gives no rows; further columns are not looked at. A conversation of any size is worked on in segments of
    at most `segment_rows` turns and about `segment_bytes` of text; one task sees a row of costs for each of them.
    """
    short_batches(turns.sparkSession)
    found = stored(ordered(turns).mapInArrow(segments(segment_rows, segment_bytes), SEGMENT))
    cut = found.where("not whole")
    ways = cut.select("conv_id", "segment", "costs", "ranks").groupBy("conv_id").applyInPandas(
        way, "segment long, pick int, tail string"
    )
    picked = cut.join(ways, "segment").select(
        "conv_id", "segment", "turns", F.floor(F.col("pick") / 4).cast("int").alias("state"),
        F.concat(F.col("audits")[F.col("pick")], "tail").alias("audit"),
    )
    whole = found.where("whole").select("conv_id", "segment", "turns", F.lit(0).alias("state"), F.col("audits")[0].alias("audit"))

    def apply(batches):
        for batch in batches:
            for s in batch.to_pylist():
                rows = [
                    {
                        "conv_id": s["conv_id"], "segment": s["segment"], "place": place, "edit": edit, "role": role,
                        "turn": t and t["turn"], "old_role": t and t["role"], "fault": t and t["fault"], "text": t["text"] if t else "",
                    }
                    for place, (edit, t, role) in enumerate(edits(s["turns"], s["audit"], s["state"]))
                ]
                yield pa.RecordBatch.from_pylist(rows, EDITED_ROW)

    return whole.unionByName(picked).mapInArrow(apply, EDITED)


EDITED_ROW = pa.schema(
    [(c.split()[0], {"long": pa.int64(), "int": pa.int32(), "string": pa.string()}[c.split()[1]]) for c in EDITED.split(", ")]
)


def damaged(turns: DataFrame) -> DataFrame:
    """`turns` after a damage that the crc32 of conversation and turn tells: of twenty rows one goes, one is emptied,
    one loses its full stops, one comes twice and one has the user's role."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate(space("text"), ".!?", "")).otherwise(space("text"))
    return turns.where(kind != 0).select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(space("role")).alias("role"), text.alias("text"),
        F.explode(F.array_repeat(F.lit(1), F.when(kind == 3, 2).otherwise(1))).alias("copy"),
    ).drop("copy")


REPORT = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
)
REPORT_ROW = pa.schema(
    [(c.split()[0], pa.int64() if c.endswith("long") else pa.string()) for c in REPORT.split(", ")]
)


def report(turns: DataFrame, **segment) -> DataFrame:
    """One row per conversation of `turns` after `damaged`: its faults, what `repair` costs, its audit and outcome.

    `gaps` counts numbers missing between the least and the largest turn, `illegal` neighbours whose roles cannot follow
    each other. A conversation left without rows has zeros and an empty outcome. A digest runs over the turns of a conversation
    one after the other, so they stream through one task, which holds a batch and the audit of them.
    """

    def told(batches):
        now, found = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if now is None or row["conv_id"] != now.conv_id:
                    if now is not None:
                        found.append(now.row())
                    now = Outcome(row["conv_id"])
                now.add(row)
            yield pa.RecordBatch.from_pylist(found, REPORT_ROW)
            found = []
        if now is not None:
            yield pa.RecordBatch.from_pylist([now.row()], REPORT_ROW)

    order = ["conv_id", "segment", "place"]
    ids = turns.select(F.col("conv_id").cast("long")).distinct()
    found = repair(damaged(turns), **segment).repartition("conv_id").sortWithinPartitions(*order).mapInArrow(told, REPORT)
    found = found.withColumnRenamed("conv_id", "its_id")
    joined = ids.join(found, F.col("conv_id").eqNullSafe(F.col("its_id")), "left")
    names = [f.name for f in found.schema if f.name != "its_id"]
    empty = {"audit": F.lit(""), "repaired_sha256": F.sha2(F.lit(b""), 256)}
    return joined.select("conv_id", *[F.coalesce(F.col(n), empty.get(n, F.lit(0))).alias(n) for n in names])


class Outcome:
    """What `report` tells of one conversation, turn by turn."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.audit, self.digest = conv_id, [], hashlib.sha256()
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal = self.cost = self.distinct = 0
        self.low = self.high = self.role = None
        self.line = b""

    def add(self, row: dict) -> None:
        self.audit.append(row["edit"])
        self.cost += COST[row["edit"]] + TRUNCATED * (row["fault"] == "truncated" and row["edit"] != "D")
        if row["edit"] != "I":
            if row["fault"]:
                self.faults[row["fault"]] += 1
            if self.role is not None and self.role + row["old_role"][:1] not in ("su", "ua", "au"):
                self.illegal += 1
            self.role = row["old_role"][:1]
            if row["turn"] is not None and row["turn"] != self.high:
                self.low = row["turn"] if self.low is None else self.low
                self.high = row["turn"]
                self.distinct += 1
        if row["edit"] != "D":
            self.digest.update(self.line + f"{row['role']}:{row['text']}".encode())
            self.line = b"\n"

    def row(self) -> dict:
        gaps = self.high - self.low + 1 - self.distinct if self.distinct else 0
        return self.faults | {
            "conv_id": self.conv_id, "gaps": gaps, "illegal": self.illegal, "cost": self.cost,
            "audit": "".join(self.audit), "repaired_sha256": self.digest.hexdigest(),
        }
