"""Repair of conversations: the cheapest edits that make roles alternate.

A conversation is fine when the first letters of its roles read ``(s?(ua)+)?``. Rows are kept, get another role, are
deleted, or empty rows are inserted; of equally cheap edits the one whose letters come first in ASCII counts.

Rows are dealt by conversation and sorted by turn, and stream through ``mapInArrow``. A dynamic program over four states
(nothing yet, after system, after user, after assistant) goes from row to row and across Arrow batches. Of each row two
bytes are kept: which of the known steps it took, where a step tells for each state where its best path comes from. Costs
are kept relative to the cheapest state, so there are few different steps and each is worked out once. Two paths to one
row never are one the beginning of the other, as both end with that row's letter; so their order at a row is their order
for good, and is carried as a rank. Steps and texts of a conversation beyond ``HELD`` bytes go to a temporary file of the
task, without a name, until the conversation ends; a task that is repeated starts anew. A giant conversation is one
task's stream since its digest is one chain over its text; what that task holds doesn't grow with it.

Null roles and texts count as one space, null turns come first. Rows of one turn are ordered by role and text, so repeats
are neighbours. A null conversation id is a conversation. Other columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import tempfile
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from changeflow.llm.common import small_batches

BLANK, DUPLICATE, TRUNCATED = 1, 2, 3
#: States of the role pattern and what each letter leads to.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
#: The state that an inserted or renamed row leads to, and inserts that complete a conversation.
WANTED = (USER, USER, ASSISTANT, USER)
MISSING = (0, 2, 1, 0)
KEEP, RENAME, DELETE, INSERT, CUT_OFF = 0, 1, 2, 5, 5
FAR = 1 << 40
#: Bytes of texts that one conversation may hold in memory, and steps.
HELD = 8 << 20

WHITE = " \t\n\x0b\x0c\r"

OUT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


class Steps:
    """Steps of the program, each worked out once: (relative costs, ranks) and a kind of row to the next and its back pointers."""

    def __init__(self) -> None:
        self.known: dict = {}
        self.backs: list[list] = []
        self.ids: dict = {}

    def step(self, at: tuple, kind: tuple[str, int]) -> tuple[tuple, int, int]:
        """(next, what all paths cost more, number of the back pointers)."""
        found = self.known.get((at, kind))
        if found is None:
            if len(self.known) > 100_000:
                self.known.clear()
            found = self.known[at, kind] = self._step(*at, *kind)
        return found

    def _step(self, costs: tuple, ranks: tuple, letter: str, fault: int) -> tuple[tuple, int, int]:
        best: list = [None] * 4
        for q in range(4):
            if costs[q] >= FAR:
                continue
            state, cost, edits = q, costs[q], ""
            for _ in range(3):
                ways = [("D", state, DELETE)]
                if fault not in (BLANK, DUPLICATE):
                    more = CUT_OFF if fault == TRUNCATED else 0
                    ways.append(("R", WANTED[state], RENAME + more))
                    if (state, letter) in NEXT:
                        ways.append(("K", NEXT[state, letter], KEEP + more))
                for edit, to, price in ways:
                    candidate = (cost + price, ranks[q], edits + edit, q)
                    if best[to] is None or candidate < best[to]:
                        best[to] = candidate
                state, cost, edits = WANTED[state], cost + INSERT, edits + "I"
        low = min(b[0] for b in best if b)
        order = sorted((b[1:3], q) for q, b in enumerate(best) if b)
        place = {q: k for k, (_, q) in enumerate(order)}
        back = tuple((b[3], b[2]) if b else None for b in best)
        number = self.ids.setdefault(back, len(self.backs))
        if number == len(self.backs):
            self.backs.append(back)
        at = tuple(b[0] - low if b else FAR for b in best), tuple(place.get(q, 9) for q in range(4))
        return (at, low, number)


BEGIN = ((0, FAR, FAR, FAR), (0, 9, 9, 9))


class Conversation:
    """One conversation while its rows come in."""

    def __init__(self, key, steps: Steps, held: int = HELD) -> None:
        self.key, self.program, self.held = key, steps, held
        self.counts = [0, 0, 0, 0]
        self.low = self.high = self.turn = None
        self.distinct = self.illegal = self.cost = self.rows = 0
        self.letter = None
        self.at = BEGIN
        self.numbers, self.texts, self.size = array("H"), [], 0
        self.files = None

    def add(self, turn, role: str, text: str, fault: int) -> None:
        if turn is not None and turn != self.turn:
            self.low = turn if self.low is None else self.low
            self.high = self.turn = turn
            self.distinct += 1
        letter = role[:1]
        if self.letter is not None and self.letter + letter not in ("su", "ua", "au"):
            self.illegal += 1
        self.letter = letter
        self.counts[fault] += 1
        self.at, more, number = self.program.step(self.at, (letter if letter in ("s", "u", "a") else "", fault))
        self.cost += more
        self.numbers.append(number)
        self.texts.append((role, text))
        self.rows += 1
        self.size += len(role) + len(text) + 120
        if self.size > self.held:
            self._spill()

    def _spill(self) -> None:
        if self.files is None:
            self.files = tempfile.TemporaryFile(), tempfile.TemporaryFile()
        self.numbers.tofile(self.files[0])
        for row in self.texts:
            for part in row:
                data = part.encode("utf-8", "surrogatepass")
                self.files[1].write(len(data).to_bytes(8, "little"))
                self.files[1].write(data)
        self.numbers, self.texts, self.size = array("H"), [], 0

    def _numbers_backwards(self) -> Iterator[int]:
        yield from reversed(self.numbers)
        if self.files is not None:
            file, chunk = self.files[0], 1 << 16
            end = file.seek(0, 2)
            while end:
                start = max(0, end - 2 * chunk)
                file.seek(start)
                part = array("H")
                part.frombytes(file.read(end - start))
                yield from reversed(part)
                end = start

    def _texts(self) -> Iterator[tuple[bytes, bytes]]:
        if self.files is not None:
            file = self.files[1]
            file.seek(0)
            while head := file.read(8):
                role = file.read(int.from_bytes(head, "little"))
                yield role, file.read(int.from_bytes(file.read(8), "little"))
        for role, text in self.texts:
            yield role.encode("utf-8", "surrogatepass"), text.encode("utf-8", "surrogatepass")

    def result(self) -> tuple:
        costs, ranks = self.at
        total, _, q = min((costs[q] + INSERT * MISSING[q], ranks[q], q) for q in range(4) if costs[q] < FAR)
        edits = bytearray(b"I" * MISSING[q])  # from the last to the first
        for number in self._numbers_backwards():
            q, part = self.program.backs[number][q]
            edits += part[::-1].encode()
        edits.reverse()
        audit = edits.decode()
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.distinct
        digest = self._digest(audit)
        if self.files is not None:
            for file in self.files:
                file.close()
        return (self.key, gaps, self.counts[BLANK], self.counts[DUPLICATE], self.counts[TRUNCATED], self.illegal, self.cost + total if self.rows else 0, audit, digest)

    def _digest(self, audit: str) -> str:
        """SHA-256 of the repaired rows, as the edits say; the state tells the role of a renamed or inserted row."""
        digest, state, rows, first = hashlib.sha256(), START, self._texts(), True
        for edit in audit:
            role, text = (b"", b"") if edit == "I" else next(rows)
            if edit == "D":
                continue
            if edit == "K":
                state = NEXT[state, role[:1].decode()]
            else:
                state = WANTED[state]
                role = b"user" if state == USER else b"assistant"
            digest.update(b"" if first else b"\n")
            for part in (role, b":", text):
                digest.update(part)
            first = False
        return digest.hexdigest()


def repaired(rows: DataFrame) -> DataFrame:
    """One row for each conversation of ``(conv_id, turn, role, text, gone)``: its faults, the cheapest edits and a digest of the repaired rows.

    Rows that are ``gone`` only tell that there is such a conversation.
    """
    small_batches(rows.sparkSession)
    last = F.substring(F.rtrim(F.col("text"), F.lit(WHITE)), -1, 1)
    # Dealt by conversation once; both orders within it are local sorts.
    dealt = rows.select("conv_id", "turn", "role", "text", "gone").repartition("conv_id")
    again = F.row_number().over(Window.partitionBy("conv_id", "gone", "role", "text").orderBy("turn")) > 1
    fault = F.when(F.col("gone"), 0).when(last == "", BLANK).when(F.col("_again"), DUPLICATE).when(~last.isin(".", "!", "?"), TRUNCATED).otherwise(0)
    marked = dealt.withColumn("_again", again).withColumn("fault", fault)
    marked = marked.sortWithinPartitions("conv_id", "gone", "turn", "role", "text", "_again").drop("_again")

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps, now, done = Steps(), None, []
        for batch in batches:
            for key, turn, role, text, gone, fault in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "gone", "fault")), strict=True):
                if now is None or key != now.key:
                    if now is not None:
                        done.append(now.result())
                    now = Conversation(key, steps)
                if not gone:
                    now.add(turn, role, text, fault)
            if len(done) >= 1000:
                yield _batch(done)
                done = []
        if now is not None:
            done.append(now.result())
        if done:
            yield _batch(done)

    return marked.mapInArrow(stream, OUT)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names, kinds = zip(*(f.split() for f in OUT.split(", ")), strict=True)
    columns = [pa.array(c, pa.int64() if kind == "long" else pa.string()) for c, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(columns, list(names))


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, gone``: rows damaged by the CRC-32 of ``conv_id:turn``, to be repaired."""
    blank = F.lit(" ")
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", blank).alias("role"),
        F.coalesce("text", blank).alias("text"), (F.crc32(name.cast("binary")) % 20).alias("_how"),
    )
    how = F.col("_how")
    text = F.when(how.isin(0, 1), "").when(how == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.explode(F.when(how == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return rows.select("conv_id", "turn", F.when(how == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), (how == 0).alias("gone"), copies.alias("_copy")).drop("_copy")
