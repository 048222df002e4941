"""Cheapest repair of a conversation's structure by a survivor-coalescence Viterbi (op 12).

A repaired conversation is empty, or a system turn if there is one, then pairs of
a user and an assistant turn. Rows are kept, given another role, deleted, or
turns without text inserted; the cheapest edits win, of equal cost those whose
initials (D, I, K, R) come first. Rows stream past in order; the best edits that
lead to each of the four states are paths in one tree of back-pointers whose
nodes count their references. Once all survivors descend from one node, the
edits up to it are final, are sent on and forgotten: what is held is the part
that is still open, however long the conversation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoincident.llm.common import lean, prepare, shuffle_width

REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
START, SYSTEM, USER, ASSISTANT = range(4)
#: state and initial of a role to the next state
_NEXT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
#: the user or assistant turn that may follow each state
_TURN = {START: "user", SYSTEM: "user", USER: "assistant", ASSISTANT: "user"}
_BLANKS = " \t\n\x0b\x0c\r"
#: rows of edits sent on together
_SEND = 2000


class _Edit:
    """A node of the tree: an edit, the one before it, and how many edits and survivors refer to it.

    ``what``: text, turn, old role, fault and role of the edited row or inserted turn.
    """

    __slots__ = ("parent", "letter", "what", "depth", "refs", "next")

    def __init__(self, parent: _Edit | None, letter: str, what: tuple):
        self.parent, self.letter, self.what = parent, letter, what
        self.depth = parent.depth + 1 if parent else 0
        self.refs, self.next = 0, []


def _before(a: _Edit, b: _Edit) -> bool:
    """Whether the edits up to ``a`` come before those up to ``b``, read from the last edit that they share.

    Both cost the same and cover the same rows, so neither is the beginning of the other.
    """
    x = y = ""
    while a is not b:
        up, down = a.depth >= b.depth, b.depth >= a.depth
        if up:
            x, a = a.letter, a.parent
        if down:
            y, b = b.letter, b.parent
    return x < y


class Viterbi:
    """Edits of one conversation; ``row`` and ``end`` give those that have become final: (letter, what)."""

    def __init__(self) -> None:
        self.root = _Edit(None, "", ())
        self.best: dict[int, tuple[int, _Edit]] = {}
        self._survive({START: (0, self.root)})
        self.open = 0  # edits held beyond the root

    def _survive(self, new: dict[int, tuple[int, _Edit]]) -> None:
        for _, edit in new.values():
            self._hold(edit)
        for _, edit in self.best.values():
            self._drop(edit)
        self.best = new

    def _hold(self, edit: _Edit) -> None:
        """Counts a survivor; an edit that becomes part of the tree refers to the one before it."""
        while edit.refs == 0 and edit.parent is not None:
            edit.refs = 1
            edit.parent.next.append(edit)
            self.open += 1
            edit = edit.parent
        edit.refs += 1

    def _drop(self, edit: _Edit) -> None:
        edit.refs -= 1
        while edit.refs == 0 and edit.parent is not None:
            edit.parent.next.remove(edit)
            self.open -= 1
            edit = edit.parent
            edit.refs -= 1

    @staticmethod
    def _offer(new: dict[int, tuple[int, _Edit]], state: int, cost: int, edit: _Edit) -> bool:
        old = new.get(state)
        if old is None or cost < old[0] or (cost == old[0] and _before(edit, old[1])):
            new[state] = (cost, edit)
            return True
        return False

    def _inserted(self, best: dict[int, tuple[int, _Edit]]) -> dict[int, tuple[int, _Edit]]:
        """Survivors with turns inserted where that is cheaper."""
        best, left = dict(best), list(best)
        while left:
            state = left.pop()
            cost, edit = best[state]
            role = _TURN[state]
            after = _NEXT[state, role[0]]
            if self._offer(best, after, cost + INSERT, _Edit(edit, "I", ("", None, None, None, role))):
                left.append(after)
        return best

    def row(self, initial: str, what: tuple, must_go: bool, truncated: bool) -> Iterator[tuple[str, tuple]]:
        new: dict[int, tuple[int, _Edit]] = {}
        more = TRUNCATED if truncated else 0
        for state, (cost, edit) in self._inserted(self.best).items():
            self._offer(new, state, cost + DELETE, _Edit(edit, "D", what))
            if must_go:
                continue
            kept = _NEXT.get((state, initial))
            if kept is not None:
                self._offer(new, kept, cost + more, _Edit(edit, "K", what))
            role = _TURN[state]
            self._offer(new, _NEXT[state, role[0]], cost + REROLE + more, _Edit(edit, "R", (*what[:-1], role)))
        self._survive(self._worthwhile(new))
        return self._final()

    @staticmethod
    def _worthwhile(best: dict[int, tuple[int, _Edit]]) -> dict[int, tuple[int, _Edit]]:
        """Without survivors that another one beats whatever follows: a turn can be inserted, and the one row that only an
        early state may keep, the system's, be deleted. Else deleting everything would never share an ancestor."""
        cost = {s: c for s, (c, _) in best.items()}
        never = 1 << 62
        user, assistant = cost.get(USER, never), cost.get(ASSISTANT, never)
        most = {USER: assistant + INSERT, ASSISTANT: user + INSERT, SYSTEM: min(assistant, user + INSERT),
                START: min(assistant, user + INSERT) + DELETE}
        return {s: kept for s, kept in best.items() if kept[0] <= most[s]}

    def end(self) -> Iterator[tuple[str, tuple]]:
        done = self._inserted(self.best)
        last = {s: done[s] for s in (START, ASSISTANT) if s in done}
        least: dict[int, tuple[int, _Edit]] = {}
        for cost, edit in last.values():
            self._offer(least, 0, cost, edit)
        self._survive(least)
        yield from self._final()

    def _final(self) -> Iterator[tuple[str, tuple]]:
        while self.root.refs == 1 and self.root.next:
            self.root = self.root.next[0]
            self.root.parent = None
            self.open -= 1
            yield self.root.letter, self.root.what


_EDITS = ("edit", "turn", "role", "text", "old_role", "fault")


def _place(df: DataFrame) -> Column:
    """Null turns come first."""
    return F.struct(df["turn"].isNotNull().alias("known"), df["turn"].alias("turn"))


def _faulty(rows: DataFrame) -> DataFrame:
    """Rows with blank and truncated, and marks of those whose role and text stood in an earlier turn.

    A mark is a row of its own that sorts before the rows it is about; only hashes are compared, texts don't move for it.
    """
    shown = F.rtrim("text", F.lit(_BLANKS))
    rows = rows.withColumns({
        "hash": F.sha2(F.col("text").cast("binary"), 256), "blank": shown == "",
        "truncated": ~F.right(shown, F.lit(1)).isin(".", "!", "?"), "mark": F.lit(0)})
    keys = rows.where("copies > 0").select("conv_id", "turn", "role", "hash").distinct()
    first = keys.groupBy("conv_id", "role", "hash").agg(F.min(_place(keys)).alias("first"), F.count("*").alias("n"))
    first = first.where("n > 1").select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("hash").alias("h"), "first")
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("hash") == F.col("h"))
    marks = keys.join(first, same).where(_place(keys) > F.col("first")).select(
        "conv_id", "turn", "role", "hash", F.lit(-1).alias("mark"))
    return rows.unionByName(marks, allowMissingColumns=True)


def repair(rows: DataFrame, copies: Column | None = None) -> DataFrame:
    """The edits that repair each conversation, in order within their partition: conv_id and, per edit, ``edit`` (K, R, D
    or I), the repaired turn (turn, role, text; deleted rows have their own), old_role and fault (blank, duplicate or
    truncated, the first that holds).

    ``rows`` has conv_id, turn, role, text; other columns are ignored. Null roles and texts are one blank; a null conv_id
    is a conversation; a row of an empty role, or one of another initial than s, u and a, can't be kept as it is. Rows go by
    turn (null first), those of one turn by role and the text's hash; repeated rows are duplicates.
    ``copies``: how often a row stands there (0: not at all, but its conversation is known). A conversation without rows,
    or whose cheapest repair is no edit, has one row with edit null. An empty table gives no row.

    One conversation streams through one task, as its edits are a sequence; the task holds what is open only.
    """
    prepare(rows.sparkSession)
    own = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"),
                      F.coalesce("text", F.lit(" ")).alias("text"),
                      (F.lit(1) if copies is None else copies).cast("int").alias("copies"))
    order = ["conv_id", "turn", "role", "hash", "mark"]
    dealt = (_faulty(own).select(*order, "copies", "blank", "truncated", "text")
             .repartition(shuffle_width(rows.sparkSession), "conv_id").sortWithinPartitions(*order))
    schema = dealt.select("conv_id").schema
    for name in _EDITS:
        schema = schema.add(name, T.LongType() if name == "turn" else T.StringType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        ids, types = None, [pa.string(), pa.int64()] + [pa.string()] * 4
        held = viterbi = None
        some = False

        def send() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True))
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[0], ids), *(pa.array(c, t) for c, t in zip(columns[1:], types, strict=True))], names=schema.names)

        def take(final: Iterator[tuple[str, tuple]]) -> Iterator[pa.RecordBatch]:
            nonlocal out, some
            for letter, what in final:
                text, turn, old, fault, role = what
                out.append((held, letter, turn, role, text, old, fault))
                some = True
                if len(out) >= _SEND:
                    yield send()
                    out = []

        def close() -> Iterator[pa.RecordBatch]:
            yield from take(viterbi.end())
            if not some:
                out.append((held, None, None, None, None, None, None))

        seen = known = None
        for batch in batches:
            ids = batch.schema.types[0]
            for conv, turn, role, digest, mark, times, blank, cut, text in zip(
                    *(c.to_pylist() for c in batch.columns), strict=True):
                if viterbi is None or conv != held:
                    if viterbi is not None:
                        yield from close()
                    held, viterbi, some, seen, known = conv, Viterbi(), False, None, None
                key = (turn, role, digest)
                if mark < 0:
                    known = key
                    continue
                for _ in range(times):
                    again = key in (known, seen)
                    fault = "blank" if blank else "duplicate" if again else "truncated" if cut else None
                    seen = key
                    yield from take(viterbi.row(role[:1], (text, turn, role, fault, role), bool(blank or again),
                                                fault == "truncated"))
        if viterbi is not None:
            yield from close()
        if out:
            yield send()

    return dealt.mapInArrow(lean(run), schema)


def damage(rows: DataFrame) -> tuple[DataFrame, Column]:
    """Rows as op 12's contract damages them, and how often each then stands there."""
    key = F.concat(*[F.coalesce(F.col(c).cast("string"), F.lit(" ")) if c != ":" else F.lit(":") for c in ("conv_id", ":", "turn")])
    case = F.crc32(key) % 20
    text = F.coalesce("text", F.lit(" "))
    hurt = rows.select(
        "conv_id", "turn", F.when(case == 4, "user").otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(case == 1, "").when(case == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(case == 0, 0).when(case == 3, 2).otherwise(1).alias("copies"))
    return hurt, F.col("copies")


def report(edits: DataFrame) -> DataFrame:
    """One row per conversation of ``repair``'s result: gaps, numbers of faults and illegal neighbours, cost, the edits'
    initials and the hash of the repaired turns. Reads the edits in the order they are in, without a shuffle."""
    schema = edits.select("conv_id").schema
    for name in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost"):
        schema = schema.add(name, T.LongType())
    schema = schema.add("audit", T.StringType()).add("repaired_sha256", T.StringType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        held, begun, ids = None, False, None

        def line() -> tuple:
            gaps = turns[1] - turns[0] + 1 - turns[2] if turns[2] else 0
            return (held, gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, "".join(audit),
                    sha.hexdigest())

        def send() -> pa.RecordBatch:
            types = [ids] + [pa.int64()] * 6 + [pa.string()] * 2
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*done, strict=True), types, strict=True)], names=schema.names)

        for batch in batches:
            ids = batch.schema.types[0]
            for conv, edit, turn, role, text, old, fault in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if not begun or conv != held:
                    if begun:
                        done.append(line())
                    held, begun = conv, True
                    turns, faults = [0, 0, 0], {"blank": 0, "duplicate": 0, "truncated": 0}
                    illegal = cost = 0
                    audit, sha, before, any_turn = [], hashlib.sha256(), None, False
                if edit is None:
                    continue
                audit.append(edit)
                cost += {"K": 0, "R": REROLE, "D": DELETE, "I": INSERT}[edit]
                if edit != "I":
                    if before is not None and before + old[:1] not in ("su", "ua", "au"):
                        illegal += 1
                    before = old[:1]
                    if fault:
                        faults[fault] += 1
                        cost += TRUNCATED if fault == "truncated" and edit != "D" else 0
                    if turn is not None:
                        if not turns[2]:
                            turns = [turn, turn, 1]
                        elif turn != turns[1]:
                            turns = [turns[0], turn, turns[2] + 1]
                if edit != "D":
                    sha.update(f"{chr(10) if any_turn else ''}{role}:{text}".encode())
                    any_turn = True
            if len(done) >= _SEND:
                yield send()
                done = []
        if begun:
            done.append(line())
            yield send()

    return edits.select("conv_id", *_EDITS).mapInArrow(lean(run), schema)


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, damaged by the contract's rule and repaired."""
    rows, copies = damage(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return report(repair(rows, copies))
