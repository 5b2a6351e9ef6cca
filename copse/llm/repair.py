"""Conversation structure repair by scalar big-integer weights.

The rows of a conversation become a legal sequence of roles,
``(s?(ua)+)?`` by their initials, by the cheapest edits:

* Keep a row (``K``), free; a truncated row that stays costs 1 more;
* Rerole it (``R``) to user or assistant, 2;
* Delete it (``D``), 3; blank and duplicate rows must go;
* Insert an empty row of user or assistant anywhere (``I``), 2.

The letters of the edits, in order, are the audit; among the cheapest the
ASCII-least audit wins. A path's weight is one integer: its high digits
are the cost, its low digits, of a fixed width, are the letters by position
(D 1, I 2, K 3, R 4), zeros after the last. An edge adds its cost and its
letter at the path's next position, and the least integer decides each node of
the graph, whose nodes are (rows consumed, role state). Two paths of equal
cost into a node are never prefixes of each other (the longer one would
consist of further, paid, inserts), so the least one stays least however
the conversation goes on. Equal weights are equal repairs: the alternation
fixes the roles that R and I stand for.

Conversations are shuffled once, by id; equal (role, text) are numbered by a
window that this partitioning serves, and the rows stream through the task
in the order of their turns. A task holds an Arrow batch and, for each of
four states, an integer, a running SHA-256 and the audit so far; texts are
not collected, however long a conversation is. An integer that is full hands
its first letters over and keeps their rank among the four states, which
decides all later comparisons as the letters would. A single conversation
is not split over tasks: its SHA-256 is one chain.

Defined cases: a null conv_id is a conversation of its own; a null role or
text is one space (so the role is illegal and the text is blank); a null
turn comes first and takes no part in gaps; equal turns are ordered by role
and text; an empty role has no legal place; repeated rows are duplicates;
a conversation without rows has zeros, an empty audit and the hash of the empty
string; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from copse.llm.scratch import shuffle_parts

#: What the edits cost.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
#: Digits of the letters, in ASCII order; 0 ends the audit.
DIGIT = {"D": 1, "I": 2, "K": 3, "R": 4}
LETTER = {n: letter for letter, n in DIGIT.items()}
BITS = 3
#: Letters that an integer has room for at first.
WIDTH = 128

ROLES = {"u": "user", "a": "assistant"}
START, SYSTEM, USER, ASSISTANT = range(4)
#: Legal moves between states by the initial of the next role.
MOVE = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
LEGAL_PAIRS = {"su", "ua", "au"}
BLANKS = " \t\n\x0b\x0c\r"

COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


class Path:
    """The least way into a state: weight, letters in it, hash of the text,
    and the letters before those of the weight as (earlier ones, last ones)."""

    __slots__ = ("weight", "length", "sha", "before")

    def __init__(self, weight, length, sha, before=None):
        self.weight, self.length, self.sha, self.before = weight, length, sha, before


class Repair:
    """Takes a conversation's rows one after the other. A weight is, from the
    high digits down: cost, rank of the letters before, ``width`` letters."""

    def __init__(self, width: int = WIDTH):
        self.width = width
        self.paths = {START: Path(0, 0, hashlib.sha256())}

    def row(self, role: str, text: str, must_go: bool, truncated: bool) -> None:
        self._room()
        self._inserts()
        extra = TRUNCATED if truncated else 0
        best = {}
        for q, path in self.paths.items():
            self._offer(best, q, path, DELETE, "D", q, None)
            if must_go:
                continue
            to = MOVE.get((q, role[:1]))
            if to is not None:
                self._offer(best, to, path, KEEP + extra, "K", q, (role, text))
            for initial, name in ROLES.items():
                to = MOVE.get((q, initial))
                if to is not None:
                    self._offer(best, to, path, REROLE + extra, "R", q, (name, text))
        self.paths = {to: self._take(*found) for to, found in best.items()}

    def finish(self) -> tuple[int, str, str]:
        """Cost, audit and hash of the cheapest legal sequence."""
        self._room()
        self._inserts()
        path = min((self.paths[q] for q in (START, ASSISTANT) if q in self.paths), key=lambda p: p.weight)
        audit, before = [self._letters(path, path.length)], path.before
        while before is not None:
            before, letters = before
            audit.append(letters)
        return self._cost(path), "".join(reversed(audit)), path.sha.hexdigest()

    def _cost(self, path: Path) -> int:
        return path.weight >> BITS * (self.width + 1)

    def _weight(self, path: Path, cost: int, letter: str) -> int:
        return path.weight + (cost << BITS * (self.width + 1)) + (DIGIT[letter] << BITS * (self.width - 1 - path.length))

    def _offer(self, best, to, path, cost, letter, q, line) -> None:
        weight = self._weight(path, cost, letter)
        if to not in best or weight < best[to][0]:
            best[to] = (weight, path, q, line)

    def _take(self, weight, path, q, line) -> Path:
        sha = path.sha
        if line is not None:
            sha = sha.copy()
            sha.update(f"{'' if q == START else chr(10)}{line[0]}:{line[1]}".encode())
        return Path(weight, path.length + 1, sha, path.before)

    def _inserts(self) -> None:
        """Relaxes the edges that consume no row until none gives less."""
        changed = True
        while changed:
            changed = False
            for q in sorted(self.paths):
                for initial, name in ROLES.items():
                    to = MOVE.get((q, initial))
                    if to is None:
                        continue
                    weight = self._weight(self.paths[q], INSERT, "I")
                    if to not in self.paths or weight < self.paths[to].weight:
                        self.paths[to] = self._take(weight, self.paths[q], q, (name, ""))
                        changed = True

    def _letters(self, path: Path, n: int) -> str:
        """The first ``n`` letters of a path's weight."""
        digits = path.weight & ((1 << BITS * self.width) - 1)
        octal = f"{digits >> BITS * (self.width - n):0{n}o}" if n else ""
        return "".join(LETTER[int(d)] for d in octal)

    def _room(self) -> None:
        """Room for a row and the inserts around it. As many letters as every
        path has leave the weights, and their rank (with that of those before
        them) stays; letters of one length rank as they compare."""
        if max(p.length for p in self.paths.values()) + 8 < self.width:
            return
        # Whatever follows a start or system state also follows the
        # assistant's, a kept system row deleted at most.
        if ASSISTANT in self.paths:
            limit = self._cost(self.paths[ASSISTANT]) + DELETE
            self.paths = {q: p for q, p in self.paths.items() if q in (USER, ASSISTANT) or self._cost(p) <= limit}
        n = min(p.length for p in self.paths.values())
        rest = BITS * (self.width - n)
        head = {q: p.weight >> rest & ((1 << BITS * (n + 1)) - 1) for q, p in self.paths.items()}
        rank = {h: i for i, h in enumerate(sorted(set(head.values())))}
        longest = max(p.length for p in self.paths.values()) - n
        width = self.width if 2 * longest < self.width else 2 * self.width
        for q, p in self.paths.items():
            tail = (p.weight & ((1 << rest) - 1)) << BITS * (width - self.width + n)
            weight = (self._cost(p) << BITS * (width + 1)) + (rank[head[q]] << BITS * width) + tail
            self.paths[q] = Path(weight, p.length - n, p.sha, (p.before, self._letters(p, n)))
        self.width = width


class Conversation:
    """Counts of a conversation and its repair, fed in order."""

    def __init__(self, conv_id):
        self.conv_id, self.repair = conv_id, Repair()
        self.turns, self.low, self.high = 0, None, None
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.before = None

    def row(self, turn, role: str, text: str, again: bool) -> None:
        if turn is not None and turn != self.high:
            self.turns, self.high = self.turns + 1, turn
            self.low = turn if self.low is None else self.low
        words = text.strip(BLANKS)
        blank = not words
        again = again and not blank
        cut = not blank and not again and words[-1] not in ".!?"
        self.blank += blank
        self.duplicate += again
        self.truncated += cut
        if self.before is not None and self.before + role[:1] not in LEGAL_PAIRS:
            self.illegal += 1
        self.before = role[:1]
        self.repair.row(role, text, blank or again, cut)

    def result(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        cost, audit, sha = self.repair.finish()
        return self.conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit, sha


def damage(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
           text: str = "text") -> DataFrame:
    """Damaged rows by ``crc32(conv_id:turn) % 20`` (nulls: one space): 0 marks the
    row as gone, 1 empties its text, 2 removes ``[.!?]``, 3 repeats the row, 4
    makes it the user's. Columns: conv_id, turn, role, text, gone."""
    space = lambda c: F.coalesce(c.cast("string"), F.lit(" "))
    d = conversations
    kind = F.crc32(F.concat(space(d[conv_id]), F.lit(":"), space(d[turn]))) % 20
    rows = d.select(d[conv_id].alias("conv_id"), d[turn].alias("turn"), space(d[role]).alias("role"),
                    space(d[text]).alias("text"), kind.alias("kind"))
    return rows.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text")).alias("text"),
        (F.col("kind") == 0).alias("gone"), F.explode(F.sequence(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1)))
    ).drop("col")


def _ordered(conversations: DataFrame, conv_id: str, turn: str, role: str, text: str, gone: Column | None) -> DataFrame:
    """(conv_id, turn, role, text, again, gone), a conversation's rows
    together and in order."""
    d = conversations
    space = lambda c: F.coalesce(c.cast("string"), F.lit(" "))
    rows = d.select(d[conv_id].alias("conv_id"), d[turn].alias("turn"), space(d[role]).alias("role"),
                    space(d[text]).alias("text"), (F.lit(False) if gone is None else gone).alias("gone"))
    equal = W.partitionBy("conv_id", "gone", "role", "text").orderBy(F.col("turn").asc_nulls_first())
    return rows.repartition(shuffle_parts(d.sparkSession), "conv_id") \
        .withColumn("again", F.row_number().over(equal) > 1) \
        .sortWithinPartitions(F.col("conv_id"), F.col("turn").asc_nulls_first(), "role", "text", "again") \
        .select("conv_id", "turn", "role", "text", "again", "gone")


def repair(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
           text: str = "text", gone: Column | None = None) -> DataFrame:
    """Per conversation: conv_id, gaps (turn numbers missing between the
    first and the last), blank, duplicate, truncated (rows by first fault),
    illegal (adjacent roles that may not follow each other), cost, audit,
    repaired_sha256 (of the repaired ``role:text`` lines). Rows that ``gone``
    marks only name their conversation. ``turns`` gives the repaired rows."""
    rows = _ordered(conversations, conv_id, turn, role, text, gone)
    schema = T.StructType([rows.schema["conv_id"], *[T.StructField(c, T.LongType()) for c in COUNTS],
                           T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, kind = None, None
        for b in batches:
            kind = b.schema.field(0).type
            done = []
            for key, at, who, said, again, out in zip(*(b.column(i).to_pylist() for i in range(6))):
                if now is None or key != now.conv_id:
                    if now is not None:
                        done.append(now.result())
                    now = Conversation(key)
                if not out:
                    now.row(at, who, said, again)
            yield _batch(done, kind, schema)
        if now is not None:
            yield _batch([now.result()], kind, schema)

    return rows.mapInArrow(run, schema)


def _batch(results: list[tuple], kind: pa.DataType, schema: T.StructType) -> pa.RecordBatch:
    types = [kind, *[pa.int64()] * len(COUNTS), pa.string(), pa.string()]
    columns = zip(*results) if results else [[]] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], schema.names)


def turns(conversations: DataFrame, repaired: DataFrame, conv_id: str = "conv_id", turn: str = "turn",
          role: str = "role", text: str = "text", gone: Column | None = None) -> DataFrame:
    """The repaired rows: conv_id, position (from 0), role, text, edit (K, R or
    I). ``repaired`` is the result of ``repair`` on the same rows."""
    rows = _ordered(conversations, conv_id, turn, role, text, gone).where("not gone")
    own = W.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text", "again")
    rows = rows.withColumn("n", F.row_number().over(own)).select(F.col("conv_id").alias("c"), "role", "text", "n")
    letters = repaired.select("conv_id", F.posexplode(F.split("audit", "")).alias("at", "edit")).where("edit != ''")
    before = W.partitionBy("conv_id").orderBy("at")
    letters = letters.withColumn("n", F.count(F.when(F.col("edit") != "I", 1)).over(before)) \
        .where("edit != 'D'").withColumn("position", F.row_number().over(before) - 1)
    both = letters.join(rows.withColumnRenamed("n", "m"), F.col("conv_id").eqNullSafe(F.col("c"))
                        & (F.col("n") == F.col("m")) & (F.col("edit") != "I"), "left")
    first = F.first(F.when((F.col("edit") == "K") & F.col("role").startswith("s"), 1).otherwise(0)).over(before)
    made = F.when((F.col("position") - first) % 2 == 0, "user").otherwise("assistant")
    return both.withColumn("role", F.when(F.col("edit") == "K", F.col("role")).otherwise(made)) \
        .select("conv_id", "position", "role", F.coalesce("text", F.lit("")).alias("text"), "edit")
