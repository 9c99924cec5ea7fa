"""Conversation structure repair by survivor-coalescence Viterbi.

A conversation's rows are taken by turn (nulls first; equal turns by role, then text). A row's fault is the first of
blank (no character but white space), duplicate (role and text seen earlier) and truncated (the last character that
isn't white space is none of ``.!?``). The cheapest edits (keep, rerole, delete, insert) are sought that give the role
initials ``(s?(ua)+)?``; see ``survivors`` for the search.

The rows are shuffled once, by conversation. Inside the partitions Spark sorts them by role and text, which marks
duplicates (a native window), and then by turn; both sorts spill to disk. A task reads the sorted rows as a stream and
holds a running hash per survivor and the letters of the edits, no rows, so a conversation of any length is never
gathered. The hash over its repaired text has to be taken in order: one conversation is read by one task.

Defined results: a null role or text counts as one space, in the key of the damage a null conv_id or turn too; rows
without conv_id are one conversation; repeated rows are rows of their own; an empty role or one with another initial
can only be reroled or deleted; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import non_space, read
from .survivors import AFTER, KEPT, NONE, ROLE, Survivors

_LEGAL = {"su", "ua", "au"}     # fixed by the contract
FLUSH = 4096                    # edits handed on at once

_SUMMARY = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
            "audit string, repaired_sha256 string")
_EDITS = "conv_id long, nth long, edit string, role string, text string"


def damage(rows: DataFrame) -> DataFrame:
    """``rows`` (conv_id, turn, role, text) with the faults that the crc32 of ``conv_id:turn`` names; a dropped row
    stays as a mark of its conversation (``dropped``)."""
    def or_space(c: str) -> F.Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    fault = F.crc32(F.concat(or_space("conv_id"), F.lit(":"), or_space("turn")).cast("binary")) % 20
    text = F.when(fault == 1, "").when(fault == 2, F.translate(or_space("text"), ".!?", "")).otherwise(or_space("text"))
    d = rows.select("conv_id", "turn", F.when(fault == 4, "user").otherwise(or_space("role")).alias("role"),
                    F.when(fault != 0, text).alias("text"), (fault == 0).alias("dropped"), fault.alias("_f"))
    return d.withColumn("_n", F.explode(F.sequence(F.lit(1), F.when(F.col("_f") == 3, 2).otherwise(1)))).drop("_n", "_f")


def _ordered(rows: DataFrame) -> DataFrame:
    """Rows of a conversation together and in order, with ``fault`` (B, D, T or null)."""
    solid = non_space(F.col("text"))
    nth = F.row_number().over(Window.partitionBy("conv_id", "dropped", "role", "text").orderBy(F.asc_nulls_first("turn")))
    fault = (F.when(F.col("dropped"), None).when(solid == "", "B").when(nth > 1, "D")
             .when(~F.substring(solid, -1, 1).isin(".", "!", "?"), "T"))
    return (rows.repartition("conv_id").withColumn("fault", fault)
            .sortWithinPartitions(F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), "role", "text")
            .select("conv_id", "turn", "role", "text", "dropped", "fault"))


class RepairedHash:
    """Running hash of repaired rows, ``role:text`` joined by line feeds."""

    def __init__(self, state=None, begun: bool = False):
        self.state, self.begun = state or hashlib.sha256(), begun

    def copy(self) -> "RepairedHash":
        return RepairedHash(self.state.copy(), self.begun)

    def add(self, role: str, text: str) -> None:
        self.state.update((("\n" if self.begun else "") + f"{role}:{text}").encode())
        self.begun = True


class Nothing:
    def copy(self) -> "Nothing":
        return self

    def add(self, role: str, text: str) -> None:
        pass


class _Conversation:
    """What is known of the conversation that is being read."""

    def __init__(self, conv_id: int | None, hand_out: Callable, payload):
        self.conv_id = conv_id
        self.counts = {"B": 0, "D": 0, "T": 0}
        self.illegal = self.turns = 0
        self.low = self.high = self.initial = None
        self.survivors = Survivors(hand_out, payload)

    def row(self, turn: int | None, role: str, text: str, fault: str | None) -> None:
        if fault:
            self.counts[fault] += 1
        if self.initial is not None and self.initial + role[:1] not in _LEGAL:
            self.illegal += 1
        self.initial = role[:1]
        if turn is not None and turn != self.high:
            self.low = turn if self.low is None else self.low
            self.high = turn
            self.turns += 1
        self.survivors.row(role, text, fault in ("B", "D"), fault == "T")

    def gaps(self) -> int:
        return self.high - self.low + 1 - self.turns if self.turns else 0


def _read(batches: Iterator[pa.RecordBatch], start: Callable, row: Callable, finish: Callable) -> Iterator[None]:
    """Feeds the ordered rows to one conversation after another; yields after every row."""
    now: _Conversation | None = None
    for b in batches:
        for conv_id, turn, role, text, dropped, fault in zip(*(c.to_pylist() for c in b.columns)):
            if now is None or now.conv_id != conv_id:
                if now is not None:
                    finish(now)
                now = start(conv_id)
            if not dropped:
                row(role, text)
                now.row(turn, role, text, fault)
            yield
    if now is not None:
        finish(now)
        yield


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [x.split() for x in schema.split(", ")]
    kinds = {"long": pa.int64(), "string": pa.string()}
    made = pa.RecordBatch.from_arrays([pa.array(x, kinds[k]) for x, (_, k) in zip(zip(*rows), fields)], [n for n, _ in fields])
    rows.clear()
    return made


def summaries(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``rows`` (conv_id, turn, role, text, dropped), as the contract has it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        audit: list[str] = []

        def start(conv_id) -> _Conversation:
            audit.clear()
            return _Conversation(conv_id, audit.extend, RepairedHash())

        def finish(c: _Conversation) -> None:
            cost, digest = c.survivors.end()
            done.append((c.conv_id, c.gaps(), c.counts["B"], c.counts["D"], c.counts["T"], c.illegal, cost,
                         "".join(audit), digest.state.hexdigest()))

        for _ in _read(batches, start, lambda role, text: None, finish):
            if len(done) >= FLUSH:
                yield _batch(done, _SUMMARY)
        if done:
            yield _batch(done, _SUMMARY)

    return _ordered(rows).mapInArrow(run, _SUMMARY)


def edits(rows: DataFrame) -> DataFrame:
    """Every edit of ``rows`` (conv_id, turn, role, text, dropped): conv_id, nth (from 0), edit (K, R, D or I), and the
    role and text of the repaired row, null if it is deleted. An edit is handed on as soon as it is final; the rows
    whose edits are unresolved are held until then."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        waiting: deque[tuple[str, str]] = deque()
        conv, nth, state = None, 0, NONE

        def hand_out(letters: list[str]) -> None:
            nonlocal nth, state
            for letter in letters:
                role, text = ("", "") if letter == "I" else waiting.popleft()
                if letter == "D":
                    role = text = None
                elif letter == "K":
                    state = KEPT[role[:1]]
                else:
                    state = AFTER[state]
                    role = ROLE[state]
                out.append((conv, nth, letter, role, text))
                nth += 1

        def start(conv_id) -> _Conversation:
            nonlocal conv, nth, state
            conv, nth, state = conv_id, 0, NONE
            return _Conversation(conv_id, hand_out, Nothing())

        for _ in _read(batches, start, lambda role, text: waiting.append((role, text)), lambda c: c.survivors.end()):
            if len(out) >= FLUSH:
                yield _batch(out, _EDITS)
        if out:
            yield _batch(out, _EDITS)

    return _ordered(rows).mapInArrow(run, _EDITS)


def repaired(rows: DataFrame) -> DataFrame:
    """The repaired rows of ``rows`` (conv_id, turn, role, text): conv_id, turn (from 0), role, text."""
    given = rows.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"),
                        F.coalesce("text", F.lit(" ")).alias("text"), F.lit(False).alias("dropped"))
    kept = edits(given).where("edit <> 'D'")
    at = F.row_number().over(Window.partitionBy("conv_id").orderBy("nth")).cast("long") - 1
    return kept.select("conv_id", at.alias("turn"), "role", "text")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return summaries(damage(rows))
