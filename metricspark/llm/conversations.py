"""Operator 11: conversation structure repair by secondary-sorted streaming.

Rows go to tasks by conversation and are sorted by turn there. A task streams them
once, in Arrow batches: it counts the faults, and a shortest-path state is carried
from row to row and from batch to batch.

The path. The initials of the repaired roles must read ``(s?(ua)+)?``, so after some
rows a repair stands at one of four places: nothing yet, after ``s``, after ``u``, after
``a``. Each place fixes what an edit can be: an inserted or changed turn is the user's
except after ``u``, where it is the assistant's. For each place the cheapest repair so
far is kept, of equally cheap ones the one with the least edits in ASCII order; all end
with the edit of a row, so none begins with another and their order stands for good.
What a row does to the four costs and their order depends on few things, so these steps
are looked up in a table that fills itself.

Giant conversations. A row leaves one byte or two behind, the number of its step. After
``SEGMENT_ROWS`` rows or ``SEGMENT_CHARS`` characters the steps are followed back once for each place:
its running digest takes up the repaired texts, its edits go to a compressed block, and
the rows are let go. So neither texts nor steps of a whole conversation are ever held;
a conversation of a third of all rows is one stream of bounded memory, and only its
edits, which are part of the result, grow with it.

Whether a row repeats an earlier one is known before the stream: rows are counted by
(conversation, role, digest of the text), which tasks combine first, and only those that occur
more than once are joined back. No task holds the texts seen so far.

Damage (``damage_conversations``), to have something to repair, is by the row's checksum
``crc32("conv_id:turn") % 20``: 0 drops the row, 1 empties its text, 2 removes ``.!?``, 3
repeats the row next to itself, 4 makes it the user's.

Defined cases: a null conversation is one conversation; a null turn comes first; nulls
in role and text, and in the checksum's input, stand for one space; rows of one turn are
taken by role, then text, so that repeated rows are neighbours; a role without
characters has no initial and has to be changed or deleted; texts of any length stay
whole; other columns are not read; a conversation that lost all its rows has zeros; an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metricspark.llm.common import bound_batches

SEGMENT_ROWS, SEGMENT_CHARS = 4_096, 4 << 20
SPACES = " \t\n\x0b\x0c\r"
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
# Places of a repair: nothing yet, after a system turn, after the user's, after the assistant's.
START, SYSTEM, USER, ASSISTANT = range(4)
# the place that each initial leads to, and the initial that edits give
NEXT = {START: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
GIVEN = {START: "u", SYSTEM: "u", USER: "a", ASSISTANT: "u"}
ROLE = {"u": "user", "a": "assistant"}
# the inserted turns after which a repair may end
CLOSING = {START: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}
INITIALS = ("s", "u", "a")
LEGAL = {"su", "ua", "au"}
ROW = ("conv_id", "turn", "role", "text", "copies", "seen")
NAMES = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


class Steps:
    """What a row of one class does to the costs of the four places, computed once each.

    A state is ``((place, cost above the least), ...)`` in the order of the repairs' edits.
    A class is ``(initial, must be deleted, truncated)``. A step has the number that the
    rows keep, the cost that the least grew by, the next state, and for each of its places
    the place before and the edits between.
    """

    def __init__(self):
        self.known: dict[tuple, tuple] = {}
        self.back: list[dict[int, tuple[int, str]]] = []

    def __call__(self, state: tuple, kind: tuple) -> tuple[int, int, tuple]:
        step = self.known.get((state, kind))
        if step is None:
            step = self.known[state, kind] = self._step(state, kind)
        return step

    def _step(self, state: tuple, kind: tuple) -> tuple[int, int, tuple]:
        initial, must_delete, truncated = kind
        best: dict[int, tuple[int, int, str, int]] = {}
        for order, (place, cost) in enumerate(state):
            at = place
            for inserted in range(3):
                options = [("D", at, DELETE)]
                if not must_delete:
                    options.append(("R", NEXT[at][GIVEN[at]], REROLE + TRUNCATED * truncated))
                    if initial in NEXT[at]:
                        options.append(("K", NEXT[at][initial], TRUNCATED * truncated))
                for letter, to, price in options:
                    found = (cost + inserted * INSERT + price, order, "I" * inserted + letter, place)
                    best[to] = min(best.get(to, found), found)
                at = NEXT[at][GIVEN[at]]
        # A repair at ASSISTANT can do all that one at SYSTEM can, and what one at START can for
        # a deletion more, so dearer ones are let go; that keeps the states few.
        for place, more in ((START, DELETE), (SYSTEM, 0)):
            if place in best and best[place][0] > best[ASSISTANT][0] + more:
                del best[place]
        least = min(cost for cost, *_ in best.values())
        ranked = sorted(best.items(), key=lambda item: item[1][1:3])
        self.back.append({to: (place, edits) for to, (_, _, edits, place) in best.items()})
        return len(self.back) - 1, least, tuple((to, cost - least) for to, (cost, *_) in ranked)


def apply_edits(place: int, edits: str, role: str, text: str) -> tuple[int, list[str]]:
    """The place after a row's edits, and the ``role:text`` lines that they leave."""
    lines = []
    for letter in edits:
        if letter == "D":
            continue
        given = GIVEN[place]
        if letter == "K":
            given = role[0]
            lines.append(f"{role}:{text}")
        else:
            lines.append(f"{ROLE[given]}:{text if letter == 'R' else ''}")
        place = NEXT[place][given]
    return place, lines


class Repair:
    """The running repair of one conversation, fed row by row."""

    def __init__(self, steps: Steps):
        self.steps = steps
        self.state: tuple = ((START, 0),)
        self.cost = 0
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.turns, self.first_turn, self.last_turn = 0, None, None
        self.before: str | None = None
        self._segment: list[tuple[int, str, str]] = []
        self._chars = 0
        # for each place: digest so far, whether it holds a line, and the edits as linked blocks
        self._past = {START: (hashlib.sha256(), False, None)}

    def add(self, turn: int | None, role: str, text: str, seen: bool) -> None:
        initial = role[:1]
        shown = text.strip(SPACES)
        fault = "blank" if not shown else "duplicate" if seen else "truncated" if shown[-1] not in ".!?" else ""
        self.blank += fault == "blank"
        self.duplicate += fault == "duplicate"
        self.truncated += fault == "truncated"
        if self.before is not None and self.before + initial not in LEGAL:
            self.illegal += 1
        self.before = initial
        if turn is not None and turn != self.last_turn:
            self.turns += 1
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn
        number, cost, self.state = self.steps(self.state, (initial if initial in INITIALS else "", fault in ("blank", "duplicate"), fault == "truncated"))
        self.cost += cost
        self._segment.append((number, role, text))
        self._chars += len(text)
        if len(self._segment) >= SEGMENT_ROWS or self._chars >= SEGMENT_CHARS:
            self._fold([place for place, _ in self.state])

    def _fold(self, places: list[int]) -> None:
        """Takes the segment into the past of each of the places, and lets its rows go."""
        past = {}
        for place in places:
            at, edits = place, []
            for number, _, _ in reversed(self._segment):
                at, some = self.steps.back[number][at]
                edits.append(some)
            digest, begun, blocks = self._past[at]
            digest = digest.copy()
            for some, (_, role, text) in zip(reversed(edits), self._segment):
                at, lines = apply_edits(at, some, role, text)
                for line in lines:
                    digest.update((b"\n" if begun else b"") + line.encode("utf-8", "surrogatepass"))
                    begun = True
            past[place] = (digest, begun, (blocks, zlib.compress("".join(reversed(edits)).encode(), 1)))
        self._past, self._segment, self._chars = past, [], 0

    def result(self) -> tuple:
        """Counts, cost, edits and digest of the finished conversation."""
        cost, _, place = min((cost + INSERT * len(CLOSING[place]), order, place) for order, (place, cost) in enumerate(self.state))
        self._fold([place])
        digest, begun, blocks = self._past[place]
        for line in apply_edits(place, CLOSING[place], "", "")[1]:
            digest.update((b"\n" if begun else b"") + line.encode())
            begun = True
        parts = [CLOSING[place]]
        while blocks:
            blocks, block = blocks
            parts.append(zlib.decompress(block).decode())
        gaps = self.last_turn - self.first_turn + 1 - self.turns if self.turns else 0
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost + cost, "".join(reversed(parts)), digest.hexdigest()


def damage_conversations(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, copies``: the damaged rows; dropped ones have no copies."""
    spaced = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")}
    what = F.crc32(F.concat(spaced["conv_id"], F.lit(":"), spaced["turn"])) % 20
    text = F.when(what.isin(0, 1), "").when(what == 2, F.translate(spaced["text"], ".!?", "")).otherwise(spaced["text"])
    return conversations.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.when(what == 4, "user").when(what == 0, "").otherwise(spaced["role"]).alias("role"),
        text.alias("text"),
        F.when(what == 0, 0).when(what == 3, 2).otherwise(1).alias("copies"),
    )


def mark_repeats(rows: DataFrame) -> DataFrame:
    """Adds ``first_turn``: that of the first equal role and text, where it is an earlier turn.

    Null turns count as the least. Only (conversation, role, text) that occur in several
    turns are joined back, by digest; a hot one is combined in the tasks first, and what
    the join gets of it is split by adaptive execution.
    """
    order = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    keyed = rows.withColumn("_digest", F.unhex(F.sha2(F.concat_ws(":", F.length("role").cast("string"), "role", "text").cast("binary"), 256)))
    several = (
        keyed.where(F.col("copies") > 0)
        .groupBy("conv_id", "_digest")
        .agg(F.min(order).alias("_first"), F.max(order).alias("_last"))
        .where(F.col("_first") != F.col("_last"))
        .select(F.col("conv_id").alias("_conv"), F.col("_digest").alias("_of"), "_first")
    )
    joined = keyed.join(several, keyed["conv_id"].eqNullSafe(F.col("_conv")) & (F.col("_digest") == F.col("_of")), "left")
    return joined.select("conv_id", "turn", "role", "text", "copies", F.coalesce(order > F.col("_first"), F.lit(False)).alias("seen"))


def repair_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a conversation, from rows that are sorted by conversation and turn."""
    steps, done, kind = Steps(), [], pa.null()
    current, repair, before = None, None, None

    def frame() -> pa.RecordBatch:
        columns = list(zip(*done)) or [()] * len(NAMES)
        types = [kind, *[pa.int64()] * 6, pa.string(), pa.string()]
        out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=NAMES)
        done.clear()
        return out

    for batch in batches:
        kind = batch.schema.field("conv_id").type
        for conv_id, turn, role, text, copies, seen in zip(*(batch.column(c).to_pylist() for c in ROW)):
            if repair is None or conv_id != current:
                if repair is not None:
                    done.append((current, *repair.result()))
                current, repair, before = conv_id, Repair(steps), None
            for _ in range(copies):
                # equal rows of one turn are neighbours: the first is new, the others repeat it
                repair.add(turn, role, text, seen or before == (turn, role, text))
                before = (turn, role, text)
        if len(done) >= 1_000:
            yield frame()
    if repair is not None:
        done.append((current, *repair.result()))
        yield frame()


def repair_conversations(rows: DataFrame) -> DataFrame:
    """Faults and cheapest repair of every conversation of ``conv_id, turn, role, text, copies``."""
    bound_batches(rows.sparkSession)
    kind = rows.schema["conv_id"].dataType.simpleString()
    streams = mark_repeats(rows).repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text")
    numbers = " long, ".join(NAMES[1:7])
    return streams.select(*ROW).mapInArrow(repair_batches, f"conv_id {kind}, {numbers} long, audit string, repaired_sha256 string")


def conversation_result(conversations: DataFrame) -> DataFrame:
    """The query's columns."""
    return repair_conversations(damage_conversations(conversations))
