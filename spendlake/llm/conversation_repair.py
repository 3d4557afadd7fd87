"""Repair of the turn structure of conversations, as cheaply as can be.

A repair reads a conversation's rows in order and keeps, re-roles or deletes each, with inserted
empty messages in between, until the roles read: an optional system message, then pairs of user and
assistant. An item (place, state) says that the rows before ``place`` are dealt with and what the
roles so far end in; every edit is a deduction of one item from another, and an item's value is the
cost and the audit, the edits' initials, of its lightest derivation. Knuth's agenda finds it: items
are popped by (cost, place, audit), and the first value popped for an item is final, since

* deductions are superior: each edit but Keep costs something, and Keep moves on by a row;
* they are monotone: values of one item and one cost deal with the same rows, so that neither audit is the
  other's beginning, and a further initial leaves their order as it is.

The agenda runs until the goal item is final. A long conversation is read in blocks; the final
values at the end of one are the axioms of the next, without the beginning that their audits share.
"""

from __future__ import annotations

import hashlib
import heapq
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendlake.llm.batches import short_batches
from spendlake.session import stored

COST = {"K": 0, "R": 3, "D": 4, "I": 3}
TRUNCATED_COST = 3

WHITE = " \t\n\x0b\x0c\r"

# What the roles so far end in.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
ACCEPTED = (NOTHING, ASSISTANT)
# The state behind each role's initial, by the state before it.
_STEPS = {"s": {NOTHING: SYSTEM}, "u": dict.fromkeys((NOTHING, SYSTEM, ASSISTANT), USER), "a": {USER: ASSISTANT}}
_NEXT = {NOTHING: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
_ROLE = {USER: "user", ASSISTANT: "assistant"}
_LEGAL = {"su", "ua", "au"}

# Rows of a conversation that one run of the agenda deals with.
BLOCK_ROWS = 256

COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")

Row = tuple[str, bool, bool]  # initial of the role, whether it must go, whether it is truncated


def lightest(rows: list[Row], axioms: dict[int, tuple[int, str]], last: bool) -> dict[int, tuple[int, str]]:
    """Lightest (cost, audit) of each state behind ``rows``; if these are the last, of the lightest accepted one only."""
    agenda = [(cost, 0, audit, state) for state, (cost, audit) in axioms.items()]
    heapq.heapify(agenda)
    final: set[tuple[int, int]] = set()
    ends: dict[int, tuple[int, str]] = {}
    while agenda:
        cost, place, audit, state = heapq.heappop(agenda)
        if (place, state) in final:
            continue
        final.add((place, state))

        def deduce(edit: str, to: int, behind: int, more: int = 0) -> None:
            if (to, behind) not in final:
                heapq.heappush(agenda, (cost + COST[edit] + more, to, audit + edit, behind))

        deduce("I", place, _NEXT[state])
        if place == len(rows):
            ends[state] = (cost, audit)
            if last and state in ACCEPTED:
                return {state: (cost, audit)}
            continue
        initial, must_go, truncated = rows[place]
        deduce("D", place + 1, state)
        if not must_go:
            more = TRUNCATED_COST if truncated else 0
            kept = _STEPS.get(initial, {}).get(state)
            if kept is None:
                deduce("R", place + 1, _NEXT[state], more)
            else:  # cheaper than to give it the role it has
                deduce("K", place + 1, kept, more)
    return ends


class _Conversation:
    """One conversation's counts and lightest repair, its rows taken in order."""

    def __init__(self, name) -> None:
        self.name = name
        self.counts = dict.fromkeys(COUNTS, 0)
        self.block: list[Row] = []
        self.ends: dict[int, tuple[int, str]] = {NOTHING: (0, "")}
        self.settled: list[str] = []
        self.initial: str | None = None
        self.first_turn = self.last_turn = None
        self.turns = 0

    def add(self, turn, role: str, times: int, blank: bool, truncated: bool, again: bool) -> None:
        """``times`` equal rows; ``again`` if an earlier turn has the same role and text."""
        if turn is not None and turn != self.last_turn:
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn, self.turns = turn, self.turns + 1
        initial = role[:1]
        for nth in range(times):
            repeats = not blank and (again or nth > 0)
            cut = truncated and not blank and not repeats
            self.counts["blank"] += blank
            self.counts["duplicate"] += repeats
            self.counts["truncated"] += cut
            self.counts["illegal"] += self.initial is not None and self.initial + initial not in _LEGAL
            self.initial = initial
            self.block.append((initial, blank or repeats, cut))
            if len(self.block) == BLOCK_ROWS:
                ends = lightest(self.block, self.ends, last=False)
                shared = os.path.commonprefix([audit for _, audit in ends.values()])
                self.settled.append(shared)
                self.ends = {state: (cost, audit[len(shared) :]) for state, (cost, audit) in ends.items()}
                self.block = []

    def result(self) -> tuple:
        ((cost, audit),) = lightest(self.block, self.ends, last=True).values()
        self.counts["cost"] = cost
        if self.turns:
            self.counts["gaps"] = self.last_turn - self.first_turn + 1 - self.turns
        return (self.name, *self.counts.values(), "".join(self.settled) + audit)


def _plan(batches: Iterator[pa.RecordBatch], kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    names = ["conv_id", *COUNTS, "audit"]
    types = [kind, *[pa.int64()] * len(COUNTS), pa.string()]

    def made(results: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array(c, t) for c, t in zip(zip(*results, strict=True), types, strict=True)]
        return pa.RecordBatch.from_arrays(columns, names=names)

    now: _Conversation | None = None
    for batch in batches:
        done = []
        for name, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if now is None or now.name != name:
                if now is not None:
                    done.append(now.result())
                now = _Conversation(name)
            now.add(*row)
        if done:
            yield made(done)
    if now is not None:
        yield made([now.result()])


def _filled(convs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(" "))
    return convs.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
        text.alias("text"),
    )


def _same(a: DataFrame, b: DataFrame, *keys: str) -> Column:
    condition = F.lit(True)
    for key in keys:
        condition = condition & a[key].eqNullSafe(b[key])
    return condition


def repairs(convs: DataFrame) -> DataFrame:
    """Per conversation of ``convs`` (conv_id, turn, role, text) its faults and its cheapest repair.

    Columns conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit. Rows go by turn, null first; those of
    one turn by role and then by the SHA-256 of the text, so that repeated rows are neighbours. A null role
    or text is one space, a null conv_id a conversation of its own. A row has at most one fault: blank (no
    character but white space), duplicate (role and text of an earlier row) or truncated (the last such
    character is none of ``.!?``). Roles go by their first letter, and a row whose role is empty or begins with
    another letter than s, u or a cannot be kept as it is. No rows give none; other columns are left out.

    Texts stay where they are read: only their digests are shuffled, equal rows combined before that.
    A conversation's rows pass through one task in order, and that keeps one letter of audit for each.
    """
    filled = _filled(convs)
    ending = F.rtrim(F.col("text"), F.lit(WHITE))
    rows = filled.select(
        "conv_id",
        "turn",
        "role",
        "digest",
        (F.length(ending) == 0).alias("blank"),
        (~F.right(ending, F.lit(1)).isin(".", "!", "?")).alias("cut"),
    )
    rows = stored(rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("times")), "turns")
    place = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    spoken = rows.filter("not blank").groupBy("conv_id", "role", "digest")
    first = spoken.agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("turns")).filter("turns > 1")
    first = stored(first.drop("turns"), "repeated")
    joined = rows.join(first, _same(rows, first, "conv_id", "role", "digest") & ~rows["blank"], "left")
    again = F.coalesce(place > F.col("first"), F.lit(False)).alias("again")
    listed = joined.select(rows["conv_id"], rows["turn"], rows["role"], rows["digest"], "times", "blank", "cut", again)
    listed = listed.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "digest")
    kind = convs.schema["conv_id"].dataType.simpleString()
    counts = ", ".join(f"{name} long" for name in COUNTS)

    def plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for first_ in batches:
            yield from _plan(_chained(first_, batches), first_.schema.field(0).type)

    made = listed.drop("digest").mapInArrow(plan, f"conv_id {kind}, {counts}, audit string")
    return stored(made, "repairs")


def _chained(first: pa.RecordBatch, rest: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield first
    yield from rest


class _Reading:
    """Carries out one conversation's audit on its rows, which come in order."""

    def __init__(self, name, audit: str) -> None:
        self.name, self.audit = name, audit
        self.at = self.place = 0
        self.state = NOTHING

    def _out(self, role: str, text: str, edit: str, state: int) -> tuple:
        self.state, self.place = state, self.place + 1
        return self.name, self.place, role, text, edit

    def inserted(self) -> Iterator[tuple]:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            state = _NEXT[self.state]
            yield self._out(_ROLE[state], "", "I", state)

    def row(self, role: str, text: str) -> Iterator[tuple]:
        yield from self.inserted()
        edit, self.at = self.audit[self.at], self.at + 1
        if edit == "K":
            yield self._out(role, text, edit, _STEPS[role[0]][self.state])
        elif edit == "R":
            state = _NEXT[self.state]
            yield self._out(_ROLE[state], text, edit, state)


def repaired(convs: DataFrame, plans: DataFrame) -> DataFrame:
    """The rows of the repaired conversations: conv_id, place (from 1), role, text, edit (K, R or I).

    ``plans`` are the ``repairs`` of ``convs``. A conversation's rows follow each other in one partition, in order.
    They stream through it: a batch of rows and one audit are held at a time.
    """
    kind = convs.schema["conv_id"].dataType.simpleString()
    heads = plans.select("conv_id", F.lit(0).alias("part"), "audit")
    rows = _filled(convs).withColumn("part", F.lit(1))
    order = ["conv_id", "part", "turn", "role", "digest"]
    both = heads.unionByName(rows, allowMissingColumns=True).repartition("conv_id").sortWithinPartitions(*order)

    def carry_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, types = None, None

        def made(results: list[tuple]) -> pa.RecordBatch:
            columns = [pa.array(c, t) for c, t in zip(zip(*results, strict=True), types, strict=True)]
            return pa.RecordBatch.from_arrays(columns, names=["conv_id", "place", "role", "text", "edit"])

        for batch in batches:
            types = [batch.schema.field(0).type, pa.int64(), pa.string(), pa.string(), pa.string()]
            results: list[tuple] = []
            for name, part, audit, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if part == 0:
                    results.extend(now.inserted() if now else ())
                    now = _Reading(name, audit)
                else:
                    results.extend(now.row(role, text))
            if results:
                yield made(results)
        if now and (results := list(now.inserted())):
            yield made(results)

    chosen = short_batches(both).select("conv_id", "part", "audit", "role", "text")
    return chosen.mapInArrow(carry_out, f"conv_id {kind}, place long, role string, text string, edit string")


def digests(rows: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of ``repaired`` rows: SHA-256 of each conversation's ``role:text`` lines.

    SHA-256 can only be taken from front to back, so a conversation's rows are read where they lie, one after the other.
    """
    kind = rows.schema["conv_id"].dataType.simpleString()

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sha, type_ = None, None, None

        def made(found: list[tuple]) -> pa.RecordBatch:
            columns = [pa.array([f[0] for f in found], type_), pa.array([f[1] for f in found], pa.string())]
            return pa.RecordBatch.from_arrays(columns, names=["conv_id", "repaired_sha256"])

        for batch in batches:
            type_, found = batch.schema.field(0).type, []
            for name, place, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if place == 1:
                    if sha:
                        found.append((now, sha.hexdigest()))
                    now, sha = name, hashlib.sha256()
                else:
                    sha.update(b"\n")
                sha.update(f"{role}:{text}".encode())
            if found:
                yield made(found)
        if sha:
            yield made([(now, sha.hexdigest())])

    return rows.select("conv_id", "place", "role", "text").mapInArrow(take, f"conv_id {kind}, repaired_sha256 string")


def damaged(convs: DataFrame) -> DataFrame:
    """``convs`` with faults planted by the CRC-32 of ``conv_id:turn``: rows dropped, emptied, unpointed, repeated, re-roled."""
    shown = [F.coalesce(F.col(name).cast("string"), F.lit(" ")) for name in ("conv_id", "turn")]
    kind = F.crc32(F.concat_ws(":", *shown).cast("binary")) % 20
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    copies = F.array_repeat(F.lit(0), F.when(kind == 3, 2).otherwise(1))
    rows = convs.filter(kind != 0).select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        text.alias("text"),
        F.explode(copies).alias("copy"),
    )
    return rows.drop("copy")


def repair_damaged(convs: DataFrame) -> DataFrame:
    """Per conversation of ``convs`` the ``repairs`` of its ``damaged`` rows and the digest of the repaired ones.

    Conversations of which no row is left have zeros, an empty audit and the hash of an empty text.
    """
    rows = damaged(convs)
    plans = repairs(rows)
    hashes = digests(repaired(rows, plans))
    every = convs.select("conv_id").distinct()
    known = every.join(plans, _same(every, plans, "conv_id"), "left").drop(plans["conv_id"])
    hashed = known.join(hashes, _same(known, hashes, "conv_id"), "left").drop(hashes["conv_id"])
    return hashed.select(
        "conv_id",
        *[F.coalesce(name, F.lit(0)).alias(name) for name in COUNTS],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )
