"""Conversation structure repair by survivor-coalescence Viterbi.

Cheapest edits (Keep, Rerole, Delete, Insert) make the roles of a conversation
``(s?(ua)+)?``. Four states follow the roles written so far: nothing, after the system
turn, after a user, after an assistant. Each state's survivor is the cheapest way
into it, of equals the one with the ASCII-least edits; edits of two ways into one state
over the same turns never are a prefix of each other at one cost, since they
differ by insertions only, so what follows cannot change which is less. Survivors are leaves
of one tree of backpointers whose nodes count their references. As soon as the root has
a single child, all survivors share that edit: it is emitted, its turn goes into
the hash and is forgotten. A state that another one beats for certain, whatever
follows, is given up, so that the tree stays short; ties are compared over
the whole unresolved suffixes.

Turns are damaged, judged and ordered on the cluster: one shuffle by conversation,
the first turn of each (role, text) by a window inside it, and a sort that spills.
The repair reads the sorted stream and holds one batch and the unresolved turns. The hash
of a conversation's whole text can only be made in order, so a conversation of any
length is one stream through one task, in bounded memory; texts are not collected.

Nulls: a null role, text, conversation or turn reads as one space where text is needed; null
turns come first; a null conversation is one of its own. Turns with one number are
ordered by role, then text, repeated rows side by side (all but the first are
duplicates). An empty role can neither be kept nor make a legal pair. Empty tables give no
rows; a conversation that lost all rows gives zeros, no edits and the hash of nothing. Extra
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import LongType, StringType, StructField, StructType

START, SYSTEM, USER, ASSISTANT = range(4)
COSTS = {"K": 0, "R": 1, "D": 2, "I": 5}
TRUNCATED = 5
AFTER = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
WRITES = {START: "user", SYSTEM: "user", USER: "assistant", ASSISTANT: "user"}  # what an inserted or changed turn becomes
LEGAL = {"su", "ua", "au"}
#: SURELY[s][t]: most that any continuation costs more from state t than from state s.
SURELY = {START: {USER: 7, ASSISTANT: 2}, SYSTEM: {START: 0, USER: 5, ASSISTANT: 0}, USER: {START: 5, ASSISTANT: 5}, ASSISTANT: {START: 0, USER: 5}}


class Node:
    __slots__ = ("edit", "parent", "refs")

    def __init__(self, edit: str, parent: Node | None):
        self.edit, self.parent, self.refs = edit, parent, 0
        if parent is not None:
            parent.refs += 1

    def release(self) -> None:
        """One reference less; what nothing refers to goes, and its parents with it."""
        node = self
        while node is not None:
            node.refs -= 1
            if node.refs:
                return
            node = node.parent


def suffix(node: Node, root: Node) -> str:
    out = []
    while node is not root:
        out.append(node.edit)
        node = node.parent
    return "".join(reversed(out))


class Repair:
    """Cheapest edits of one conversation, a turn at a time."""

    def __init__(self):
        self.root = Node("", None)
        self.survivors: dict[int, tuple[int, Node]] = {START: (0, self.root)}
        self.root.refs += 1
        self.turns: deque[tuple[str, str]] = deque()
        self.audit: list[str] = []
        self.hash = hashlib.sha256()
        self.state, self.written = START, False
        self.most = 0
        self._insert(self.survivors)

    def _offer(self, new: dict, state: int, cost: int, edit: str, parent: Node) -> bool:
        """Take this way into ``state`` if it is cheaper, or as cheap with ASCII-less edits."""
        old = new.get(state)
        if old is not None and (old[0] < cost or old[0] == cost and suffix(old[1], self.root) <= suffix(parent, self.root) + edit):
            return False
        node = Node(edit, parent)
        node.refs += 1
        if old is not None:
            old[1].release()
        new[state] = (cost, node)
        return True

    def _insert(self, new: dict) -> None:
        changed = True
        while changed:
            changed = False
            for state in sorted(new, key=lambda s: new[s][0]):
                cost, node = new[state]
                changed |= self._offer(new, AFTER[state, WRITES[state][0]], cost + COSTS["I"], "I", node)

    def turn(self, role: str, text: str, gone: bool, truncated: bool) -> None:
        """``gone``: the turn must be deleted."""
        self.turns.append((role, text))
        new: dict[int, tuple[int, Node]] = {}
        for state, (cost, node) in self.survivors.items():
            self._offer(new, state, cost + COSTS["D"], "D", node)
            if not gone:
                late = cost + (TRUNCATED if truncated else 0)
                if (state, role[:1]) in AFTER:
                    self._offer(new, AFTER[state, role[:1]], late + COSTS["K"], "K", node)
                self._offer(new, AFTER[state, WRITES[state][0]], late + COSTS["R"], "R", node)
        self._insert(new)
        for state in list(new):
            if any(t in new and new[t][0] + more < new[state][0] for t, more in SURELY[state].items()):
                new.pop(state)[1].release()
        for _, node in self.survivors.values():
            node.release()
        self.survivors = new
        self._emit()
        self.most = max(self.most, len(self.turns))

    def _emit(self) -> None:
        """Edits that all survivors share."""
        while self.root.refs == 1:
            node = next(iter(self.survivors.values()))[1]
            if node is self.root:
                return
            path = []
            while node is not self.root:
                path.append(node)
                node = node.parent
            for node in reversed(path):
                self._write(node.edit)
                node.parent, self.root = None, node
                if node.refs != 1 or any(x[1] is node for x in self.survivors.values()):
                    return

    def _write(self, edit: str) -> None:
        self.audit.append(edit)
        role, text = ("", "") if edit == "I" else self.turns.popleft()
        if edit == "D":
            return
        if edit != "K":
            role = WRITES[self.state]
        self.state = AFTER[self.state, role[:1]]
        self.hash.update((("\n" if self.written else "") + f"{role}:{text}").encode())
        self.written = True

    def finish(self) -> tuple[int, str, str]:
        """(cost, edits, hash)."""
        ends = [(self.survivors[s][0], suffix(self.survivors[s][1], self.root)) for s in (START, ASSISTANT) if s in self.survivors]
        cost, rest = min(ends)
        for edit in rest:
            self._write(edit)
        return cost, "".join(self.audit), self.hash.hexdigest()


class Conversation:
    """Counts of faults, and the repair."""

    def __init__(self):
        self.first = self.last = self.before = None
        self.numbers = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.repair = Repair()

    def add(self, turn: int | None, role: str, text: str, fault: str | None) -> None:
        if turn is not None and turn != self.last:
            self.first = turn if self.first is None else self.first
            self.last = turn
            self.numbers += 1
        self.blank += fault == "blank"
        self.duplicate += fault == "duplicate"
        self.truncated += fault == "truncated"
        if self.before is not None:
            self.illegal += self.before + role[:1] not in LEGAL
        self.before = role[:1]
        self.repair.turn(role, text, fault in ("blank", "duplicate"), fault == "truncated")

    def row(self) -> tuple:
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.numbers
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal, *self.repair.finish()


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text): rows after damage; a dropped row leaves its conv_id with a null role."""
    c = conversations
    space = lambda x: F.coalesce(x.cast("string"), F.lit(" "))
    h = F.crc32(F.concat(space(c["conv_id"]), F.lit(":"), space(c["turn"])).cast("binary")) % 20
    rows = c.select(c["conv_id"], c["turn"].cast("bigint").alias("turn"), space(c["role"]).alias("role"), space(c["text"]).alias("text"), h.alias("h"))
    return rows.select(
        "conv_id", "turn", F.when(F.col("h") == 4, "user").when(F.col("h") != 0, F.col("role")).alias("role"),
        F.when(F.col("h") == 1, "").when(F.col("h") == 2, F.translate("text", ".!?", "")).when(F.col("h") != 0, F.col("text")).alias("text"),
        F.explode(F.when(F.col("h") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy")).drop("copy")


def faults(rows: DataFrame) -> DataFrame:
    """Adds ``fault``: blank, duplicate, truncated or null."""
    solid = F.btrim(F.col("text"), F.lit(" \t\n\x0b\x0c\r"))
    same = F.sha2(F.concat(F.length("role"), F.lit(":"), "role", "text"), 256)
    seen = Window.partitionBy("conv_id", "same").orderBy(F.col("turn").asc_nulls_first())
    nth = F.row_number().over(seen)
    return rows.repartition("conv_id").withColumn("same", same).withColumn("nth", nth).select(
        "conv_id", "turn", "role", "text",
        F.when(F.col("role").isNull(), None).when(solid == "", "blank").when(F.col("nth") > 1, "duplicate").when(~F.substring(solid, -1, 1).isin(".", "!", "?"), "truncated").alias("fault"),
        F.col("nth"))


def order(c: Column) -> Column:
    return c.asc_nulls_first()


def repair(conversations: DataFrame) -> DataFrame:
    """Per conv_id: gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
    kind = conversations.schema["conv_id"].dataType
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    schema = StructType([StructField("conv_id", kind), *[StructField(x, LongType()) for x in names], StructField("audit", StringType()), StructField("repaired_sha256", StringType())])
    arrow = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in schema])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, open_, done = None, None, []
        for b in batches:
            for conv, turn, role, text, fault in zip(*[b.column(k).to_pylist() for k in range(5)]):
                if open_ is None or conv != now:
                    if open_ is not None:
                        done.append((now, *open_.row()))
                    now, open_ = conv, Conversation()
                if role is not None:
                    open_.add(turn, role, text, fault)
            if len(done) >= 1000:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*done), arrow.types)], schema=arrow)
                done = []
        if open_ is not None:
            done.append((now, *open_.row()))
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*done), arrow.types)], schema=arrow)
    rows = faults(damaged(conversations)).sortWithinPartitions(*[order(F.col(x)) for x in ("conv_id", "turn", "role", "text", "nth")])
    return rows.drop("nth").mapInArrow(run, schema)
