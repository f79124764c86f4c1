"""Conversations brought to the shape (system)? (user assistant)+ by the cheapest edits.

Rows are dealt by conversation and sorted by turn, last turn first, and streamed through mapInPandas:
what is carried from row to row, across Arrow batches, is the cost of the rest of the conversation
from each of four states. Each row leaves one small number with the edit chosen in each state. At the
first turn these numbers, read backwards, give the edits in order of turns. Numbers of giant
conversations go to the shared folder in blocks. A second stream, first turn first, applies the edits.

A conversation's edits form one string and its repaired rows one digest, so one task streams a
conversation whatever its length; it holds a batch, a block of numbers and the string of edits.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from opsgauge.llm.workspace import Workspace, filesystem

SPACES = " \t\n\x0b\x0c\r"
ENDS = (".", "!", "?")
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: Edits in ASCII order: of equally cheap ones the first is taken.
EDITS = "DIKR"
#: States: nothing yet, after system, after user, after assistant. A new row is what the state lacks.
NEXT = (2, 2, 3, 2)
ROLE = {2: "user", 3: "assistant"}
KEPT = {"s": (1, None, None, None), "u": (2, 2, None, 2), "a": (None, None, 3, None)}
LEGAL = {"su", "ua", "au"}
#: Rows of a conversation whose numbers are held in memory.
BLOCK_ROWS = 1 << 22

FAULTS = ("blank", "duplicate", "truncated")
AUDIT = "key string, known boolean, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
TURNS = "key string, known boolean, place long, edit string, role string, text string"


def damage(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, gone): the rows after faults chosen by crc32 of ``conv_id:turn``
    modulo 20: 0 drops the row (it stays here, marked gone, so that its conversation stays known), 1
    empties its text, 2 takes the sentence ends out, 3 repeats it, 4 makes it the user's. Nulls of
    the key, role and text count as one space; conv_id and turn themselves stay null."""
    part = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn")).cast("binary")) % 20
    text = F.when(fault == 1, "").when(fault == 2, F.translate(part("text"), "".join(ENDS), "")).otherwise(part("text"))
    role = F.when(fault == 4, "user").otherwise(part("role"))
    times = F.explode(F.when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), (fault == 0).alias("gone"), times)
    return rows.select("conv_id", "turn", "role", "text", "gone")


def keyed(rows: DataFrame) -> DataFrame:
    """Rows with what deals and orders them. A missing conv_id is a conversation of its own."""
    gone = F.col("gone") if "gone" in rows.columns else F.lit(False)
    return rows.select(
        F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("key"),
        F.col("conv_id").isNotNull().alias("known"),
        F.coalesce(F.col("turn").cast("long"), F.lit(0)).alias("turn"),
        F.col("turn").isNotNull().alias("timed"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
        gone.alias("gone"),
    ).withColumn("mark", F.md5("text"))


def order(direction) -> list[Column]:
    """By turn, missing ones first; equal turns by role and a digest of the text."""
    return [direction(c) for c in ("timed", "turn", "role", "mark")]


def faults(rows: DataFrame) -> DataFrame:
    """Each row's first fault: blank, duplicate (role and text were there before), truncated. Of a
    text, only its digest and its last character that is no space are shuffled."""
    ahead = W.partitionBy("key", "known", "gone", "role", "mark").orderBy("timed", "turn")
    rows = rows.withColumn("text", F.right(F.rtrim("text", F.lit(SPACES)), F.lit(1)))
    rows = rows.withColumn("nth", F.row_number().over(ahead))
    kind = (
        F.when(F.col("text") == "", FAULTS[0])
        .when(F.col("nth") > 1, FAULTS[1])
        .when(~F.col("text").isin(*ENDS), FAULTS[2])
        .otherwise("")
    )
    return rows.withColumn("fault", kind).drop("text")


@lru_cache(maxsize=None)
def step(rest: tuple[int, ...], initial: str, fault: str) -> tuple[tuple[int, ...], int, int]:
    """One row further back. ``rest`` is the cost of what follows it from each state, less the least
    of them. Gives the same from this row on, what was taken off, and the edits chosen by state."""
    fixed = fault in FAULTS[:2]
    late = TRUNCATED if fault == FAULTS[2] else 0
    options: list[dict[str, int]] = []
    for q in range(4):
        found = {"D": DELETE + rest[q]}
        to = KEPT.get(initial, (None,) * 4)[q]
        if not fixed and to is not None:
            found["K"] = KEEP + late + rest[to]
        if not fixed:
            found["R"] = REROLE + late + rest[NEXT[q]]
        options.append(found)
    least = [min(o.values()) for o in options]
    for _ in range(2):  # a third insertion would come back to a state that was there
        least = [min(least[q], INSERT + least[NEXT[q]]) for q in range(4)]
    chosen = 0
    for q, found in enumerate(options):
        found["I"] = INSERT + least[NEXT[q]]
        letter = next(k for k, e in enumerate(EDITS) if found.get(e) == least[q])
        chosen |= letter << 2 * q
    if initial == "s":
        chosen |= 1 << 8
    base = min(least)
    return tuple(c - base for c in least), base, chosen


#: Cost of ending in each state, by insertions alone.
AT_END = (0, 2 * INSERT, INSERT, 0)


class Numbers:
    """The numbers of one conversation, two bytes a row; full blocks go to files in the shared folder."""

    def __init__(self, folder: str, block_rows: int):
        self.folder, self.block, self.now, self.files = folder, 2 * block_rows, bytearray(), []

    def add(self, number: int) -> None:
        self.now += number.to_bytes(2, "little")
        if len(self.now) >= self.block:
            fs, root = filesystem(self.folder)
            fs.create_dir(root, recursive=True)
            self.files.append(f"{root}/{uuid.uuid4().hex}")
            with fs.open_output_stream(self.files[-1]) as out:
                out.write(bytes(self.now))
            self.now = bytearray()

    def backwards(self) -> Iterator[int]:
        """Last number first; files go as they are read."""
        data = bytes(self.now)
        while True:
            for at in range(len(data) - 2, -1, -2):
                yield int.from_bytes(data[at : at + 2], "little")
            if not self.files:
                return
            fs, _ = filesystem(self.folder)
            path = self.files.pop()
            with fs.open_input_stream(path) as source:
                data = source.read()
            fs.delete_file(path)


def edits(numbers: Iterator[int]) -> Iterator[str]:
    """The edits in order, from the numbers of the rows, first row first."""
    q = 0
    for number in numbers:
        while True:
            letter = EDITS[number >> 2 * q & 3]
            yield letter
            if letter in "IR":
                q = NEXT[q]
            elif letter == "K":
                q = 1 if q == 0 and number >> 8 else NEXT[q]
            if letter != "I":
                break
    yield from "I" * (AT_END[q] // INSERT)


class Tally:
    """What is known of one conversation while its rows go by, last row first."""

    def __init__(self, folder: str, block_rows: int):
        self.rest, self.base = AT_END, 0
        self.numbers = Numbers(folder, block_rows)
        self.count = dict.fromkeys(FAULTS, 0)
        self.illegal = self.turns = 0
        self.after = self.first = self.last = None

    def row(self, turn: int | None, role: str, fault: str) -> None:
        initial = role[:1]
        if fault:
            self.count[fault] += 1
        if self.after is not None and initial + self.after not in LEGAL:
            self.illegal += 1
        self.after = initial
        if turn is not None and turn != self.first:
            self.first, self.turns = turn, self.turns + 1
            self.last = turn if self.last is None else self.last
        self.rest, base, chosen = step(self.rest, initial if initial in KEPT else "", fault)
        self.base += base
        self.numbers.add(chosen)

    def result(self) -> tuple:
        gaps = 0 if self.last is None else self.last - self.first + 1 - self.turns
        return (gaps, *self.count.values(), self.illegal, self.base + self.rest[0], "".join(edits(self.numbers.backwards())))


def tallied(folder: str, block_rows: int):
    """The first stream."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [f.split()[0] for f in AUDIT.split(", ")]
        at = tally = None
        for batch in batches:
            done = []
            columns = (batch[c].tolist() for c in ("key", "known", "timed", "turn", "role", "fault", "gone"))
            for key, known, timed, turn, role, fault, gone in zip(*columns, strict=True):
                if at != (key, known):
                    if at is not None:
                        done.append((*at, *tally.result()))
                    at, tally = (key, known), Tally(folder, block_rows)
                if not gone:
                    tally.row(turn if timed else None, role, fault)
            if done:
                yield pd.DataFrame(done, columns=names)
        if at is not None:
            yield pd.DataFrame([(*at, *tally.result())], columns=names)

    return run


def audits(spark: SparkSession, conversations: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row a conversation: (key, known, gaps, blank, duplicate, truncated, illegal, cost, audit).

    ``audit`` has the cheapest edits in order of the rows: K keeps one (cost 0), R makes it the user's
    or the assistant's (1), D deletes it (2; required for blank and duplicate rows), I inserts an empty
    one (5); a truncated row that is not deleted costs 5 more. Of equally cheap strings the least in
    ASCII order is taken. A role counts by its initial (case matters); an empty role fits nowhere.
    Missing roles and texts are one space, which has no legal initial and is blank. Rows marked
    ``gone`` only make their conversation known; one with no other rows has zeros and an empty audit.
    """
    work = Workspace(spark, "repair")
    rows = faults(keyed(conversations)).repartition("key", "known")
    rows = rows.sortWithinPartitions("key", "known", *order(F.desc), F.desc("nth"))  # of equal rows the first is no duplicate
    rows = rows.select("key", "known", "timed", "turn", "role", "fault", "gone")
    return work.table(rows.mapInPandas(tallied(f"{work.path}/numbers", block_rows), AUDIT), "audits")


def repaired(batches: Iterator[pd.DataFrame]) -> Iterator[list[tuple]]:
    """The second stream: the rows of the repaired conversations, a list for each batch. Each
    conversation begins with its edits; a last entry of place -1 closes it."""
    at, left, q, place = None, iter(()), 0, 0

    def inserted(out: list) -> str | None:
        """Rows that the edits insert here; then the next edit."""
        nonlocal q, place
        for letter in left:
            if letter != "I":
                return letter
            q = NEXT[q]
            out.append((*at, place, "I", ROLE[q], ""))
            place += 1
        return None

    for batch in batches:
        out: list[tuple] = []
        for key, known, audit, role, text in zip(*(batch[c].tolist() for c in ("key", "known", "audit", "role", "text")), strict=True):
            if audit is not None:
                if at is not None:
                    inserted(out)
                    out.append((*at, -1, "", "", ""))
                at, left, q, place = (key, known), iter(audit), 0, 0
                continue
            letter = inserted(out)
            if letter == "D":
                continue
            q = 1 if letter == "K" and q == 0 and role[:1] == "s" else NEXT[q]
            out.append((*at, place, letter, role if letter == "K" else ROLE[q], text))
            place += 1
        yield out
    out = []
    if at is not None:
        inserted(out)
        out.append((*at, -1, "", "", ""))
    yield out


def turns_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = [f.split()[0] for f in TURNS.split(", ")]
    for rows in repaired(batches):
        yield pd.DataFrame([r for r in rows if r[2] >= 0], columns=names)


def digests_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    digest = hashlib.sha256()
    for rows in repaired(batches):
        done = []
        for key, known, place, _, role, text in rows:
            if place < 0:
                done.append((key, known, digest.hexdigest()))
                digest = hashlib.sha256()
            else:
                digest.update(f"{chr(10) if place else ''}{role}:{text}".encode())
        yield pd.DataFrame(done, columns=["key", "known", "repaired_sha256"])


def with_edits(conversations: DataFrame, found: DataFrame) -> DataFrame:
    """The rows behind their conversation's edits, dealt and sorted for the second stream."""
    rows = keyed(conversations).where("NOT gone").withColumn("audit", F.lit(None).cast("string"))
    heads = found.select("key", "known", "audit")
    both = rows.unionByName(heads, allowMissingColumns=True).withColumn("row", F.col("audit").isNull())
    both = both.repartition("key", "known").sortWithinPartitions("key", "known", "row", *order(F.asc))
    return both.select("key", "known", "audit", "role", "text")


def conv_id(of: DataFrame) -> Column:
    """The conversation's id from its key."""
    return F.when(F.col("known"), F.col("key")).cast(of.schema["conv_id"].dataType).alias("conv_id")


def repair_turns(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    """The repaired conversations: (conv_id, place, edit, role, text), places from 0 without gaps.
    ``edit`` is K, R or I. Conversations of which nothing stays have no rows. See ``audits`` for the
    rules and odd rows; further columns are not used."""
    out = with_edits(conversations, audits(spark, conversations)).mapInPandas(turns_of, TURNS)
    return out.select(conv_id(conversations), "place", "edit", "role", "text")


def repair_summary(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    """One row a conversation: conv_id, the columns of ``audits``, and ``repaired_sha256``, the digest
    of its repaired rows ``role:text`` joined by newlines."""
    found = audits(spark, conversations)
    digests = with_edits(conversations, found).mapInPandas(digests_of, "key string, known boolean, repaired_sha256 string")
    out = found.join(digests, ["key", "known"])
    return out.select(conv_id(conversations), "gaps", *FAULTS, "illegal", "cost", "audit", "repaired_sha256")
