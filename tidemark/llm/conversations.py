"""Repair of the structure of conversations by their cheapest edit into ``(s?(ua)+)?``: an optional system turn, then user and assistant in turns.

Rows are dealt by conversation and sorted by turn, and a task walks through them row by row, one conversation after the other. Edits
are letters: Keep, Rerole, Delete, Insert. What has been emitted so far leaves four states (nothing, system, user, assistant), so
edits are paths in an acyclic graph of rows and states, and each path's weight is one big integer: its cost in the high digits, and
below them its letters in places of fixed width, first letter highest, zeros behind the last. The smallest integer that reaches a node is
the cheapest path to it and, of equally cheap ones, the one whose letters come first in ASCII; the letters are read from the integer in the
end. (Of two paths of equal cost to a node neither's letters begin with the other's: they would differ by inserts, which cost.)

Letters that the paths to all states share are taken off the integers as soon as ``WIDTH`` places are full, so integers stay short
whatever the length of a conversation. Its texts are kept until the edits are known, beyond ``SPOOL`` bytes in a temporary file of the task.
What grows with a conversation in a task's memory is a 16-byte digest a row, which tells repeated rows, and its row of the result.
"""

from __future__ import annotations

import hashlib
import struct
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tidemark.llm.common import ship

BLANKS = " \t\n\x0b\x0c\r"
WIDTH, SPOOL = 512, 16 << 20
#: Letters by their digit, in ASCII order; zero is the padding.
LETTERS = "_DIKR"
DELETE, INSERT, KEEP, REROLE = 1, 2, 3, 4
COSTS = {DELETE: 3, INSERT: 2, KEEP: 0, REROLE: 2}
#: Two inserts and a delete.
FAR = 2 * COSTS[INSERT] + COSTS[DELETE]
#: States: what was emitted last. The state that an emitted user or assistant leads to, by the state before.
START, SYSTEM, USER, ASSISTANT = range(4)
TURNED = {START: USER, SYSTEM: USER, ASSISTANT: USER, USER: ASSISTANT}
KEPT = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
#: Other pairs of neighbouring initials are illegal.
LEGAL = {"su", "ua", "au"}


class Edits:
    """Cheapest edits of the rows seen so far, for each state."""

    def __init__(self, width: int = WIDTH):
        self.width = width
        self.best: dict[int, tuple[int, int]] = {START: (0, 0)}  # state: (weight, letters)
        self.settled, self.cost = "", 0  # letters and cost that all paths share

    def _edge(self, at: tuple[int, int], letter: int, cost: int) -> tuple[int, int]:
        weight, n = at
        return weight + (cost << 3 * self.width) + (letter << 3 * (self.width - 1 - n)), n + 1

    def _gap(self) -> dict[int, tuple[int, int]]:
        """The states before a row or the end: as they are, or after one or two inserts. A third would lead back and cost more."""
        out, layer = dict(self.best), self.best
        for _ in range(2):
            after: dict[int, tuple[int, int]] = {}
            for state, at in layer.items():
                reached = self._edge(at, INSERT, COSTS[INSERT])
                for table in (after, out):
                    table[TURNED[state]] = min(table.get(TURNED[state], reached), reached)
            layer = after
        return out

    def row(self, initial: str, only_delete: bool, extra: int) -> None:
        """One more row: its role's initial, whether it has to go, and what it costs besides if it stays."""
        if max(n for _, n in self.best.values()) + 3 > self.width:
            self._settle()
        after: dict[int, tuple[int, int]] = {}
        for state, at in self._gap().items():
            ways = [(state, DELETE, COSTS[DELETE])]
            if not only_delete:
                ways.append((TURNED[state], REROLE, COSTS[REROLE] + extra))
                if state in KEPT.get(initial, ()):
                    ways.append((KEPT[initial][state], KEEP, COSTS[KEEP] + extra))
            for to, letter, cost in ways:
                reached = self._edge(at, letter, cost)
                after[to] = min(after.get(to, reached), reached)
        self.best = after

    def _letters(self, low: int, n: int) -> str:
        return "".join(LETTERS[low >> 3 * (self.width - 1 - k) & 7] for k in range(n))

    def _settle(self) -> None:
        """Take off the leading letters and the cost that all paths share; without any, make room for more letters.

        Paths more than ``FAR`` dearer than another can't win and go first: the other reaches any state but the first two by two inserts,
        and what only the first two can do, to keep a system turn, it makes up for by a delete.
        """
        mask, least = (1 << 3 * self.width) - 1, min(w >> 3 * self.width for w, _ in self.best.values())
        self.best = {s: at for s, at in self.best.items() if at[0] >> 3 * self.width <= least + FAR}
        lows = [w & mask for w, _ in self.best.values()]
        apart = max(low ^ lows[0] for low in lows)
        shared = min(self.width - (apart.bit_length() + 2) // 3, *(n for _, n in self.best.values()))
        self.settled += self._letters(lows[0], shared)
        self.cost += least
        wide = self.width if shared else 2 * self.width
        lows = [(low << 3 * shared & mask) << 3 * (wide - self.width) for low in lows]
        self.best = {s: ((((w >> 3 * self.width) - least) << 3 * wide) | low, n - shared) for (s, (w, n)), low in zip(self.best.items(), lows, strict=True)}
        self.width = wide

    def result(self) -> tuple[int, str]:
        """Cost and letters of the cheapest way to an allowed end."""
        if max(n for _, n in self.best.values()) + 3 > self.width:
            self._settle()
        weight, n = min(at for state, at in self._gap().items() if state in (START, ASSISTANT))
        return self.cost + (weight >> 3 * self.width), self.settled + self._letters(weight & ((1 << 3 * self.width) - 1), n)


class Conversation:
    """Counts, edits and spooled texts of one conversation, row by row."""

    def __init__(self):
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.low = self.high = self.initial = None
        self.seen: set[bytes] = set()
        self.edits = Edits()
        self.texts = tempfile.SpooledTemporaryFile(max_size=SPOOL)  # noqa: SIM115

    def row(self, turn, role: str | None, text: str | None) -> None:
        role, text = " " if role is None else role, " " if text is None else text
        if turn is not None:
            self.turns += turn != self.high  # turns come sorted
            self.low, self.high = turn if self.low is None else self.low, turn
        initial, bare = role[:1], text.strip(BLANKS)
        self.illegal += self.initial is not None and self.initial + initial not in LEGAL
        self.initial = initial
        a, b = role.encode(), text.encode()
        head = struct.pack("<QQ", len(a), len(b))
        self.texts.write(head + a + b)
        key = hashlib.blake2b(head + a + b, digest_size=16).digest()
        blank, duplicate = not bare, key in self.seen
        self.seen.add(key)
        truncated = not blank and not duplicate and bare[-1] not in ".!?"
        self.blank, self.duplicate, self.truncated = self.blank + blank, self.duplicate + (duplicate and not blank), self.truncated + truncated
        self.edits.row(initial, blank or duplicate, int(truncated))

    def result(self) -> tuple:
        gaps = 0 if self.low is None else min(self.high - self.low + 1 - self.turns, (1 << 63) - 1)
        cost, audit = self.edits.result()
        digest, state, lines = hashlib.sha256(), START, 0
        self.texts.seek(0)
        for letter in audit:
            role, text = b"", b""
            if letter != "I":
                a, b = struct.unpack("<QQ", self.texts.read(16))
                role, text = self.texts.read(a), self.texts.read(b)
            if letter == "D":
                continue
            state = KEPT[role.decode()[:1]][state] if letter == "K" else TURNED[state]
            if letter != "K":
                role = b"user" if state == USER else b"assistant"
            digest.update((b"\n" if lines else b"") + role + b":" + text)
            lines += 1
        self.texts.close()
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit, digest.hexdigest()


def repair(rows: DataFrame, present: str | None = None) -> DataFrame:
    """Per conversation of ``rows`` (conv_id, turn, role, text): gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    A row without words is blank, one whose role and text came before in its conversation is a duplicate, one whose last character that is
    no blank is none of ``.!?`` is truncated; the first of these counts. Rows are taken by turn, missing ones first, ties by role and text. Null roles and texts
    are one space; missing conv_ids are one conversation; an empty table gives none. Rows for which the column ``present`` is
    false only name their conversation: without others it has zeros, no edits and the hash of an empty text. Gaps above the largest long are that. Further
    columns are ignored.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    ship(rows.sparkSession)
    numbers = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
    schema = StructType([StructField("conv_id", rows.schema["conv_id"].dataType), *StructType.fromDDL(numbers).fields])
    out = to_arrow_schema(schema)

    def batch_of(found: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*found, strict=True), out, strict=True)], schema=out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, name, found = None, None, []
        for batch in batches:
            for conv, turn, role, text, there in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                if current is None or conv != name:
                    if current is not None:
                        found.append((name, *current.result()))
                    current, name = Conversation(), conv
                if there:
                    current.row(turn, role, text)
            if found:
                yield batch_of(found)
                found = []
        if current is not None:
            yield batch_of([(name, *current.result())])

    there = F.coalesce(F.col(present).cast("boolean"), F.lit(False)) if present else F.lit(True)
    dealt = rows.select("conv_id", "turn", "role", "text", there.alias("_there")).repartition("conv_id")
    return dealt.sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")).mapInArrow(run, schema)


def damage(conversations: DataFrame) -> DataFrame:
    """The rows with planted faults by CRC-32 of ``conv_id:turn`` modulo 20, and a column ``present`` that is false for dropped ones.

    0 drops a row, 1 empties its text, 2 removes its ``.!?``, 3 repeats it, 4 makes its role user; null is one space in the key, role and text.
    """
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    text = F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.regexp_replace(space("text"), "[.!?]", "")).otherwise(space("text"))
    role = F.when(F.col("_kind") == 4, "user").otherwise(space("role"))
    rows = conversations.select("conv_id", "turn", "role", "text", kind.alias("_kind"))
    copies = F.explode(F.array_repeat(F.col("_kind") != 0, F.when(F.col("_kind") == 3, 2).otherwise(1))).alias("present")
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies)


def op13(spark, sf_dir: str) -> DataFrame:
    """All ``conversations``, damaged and repaired."""
    return repair(damage(spark.read.parquet(f"{sf_dir}/conversations.parquet")), present="present")


#: The same by recursion over rows, with (cost, letters) compared as a pair.
OP13_SQL = r"""
WITH RECURSIVE bits AS (
  SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) t(i)
),
crc_table AS (SELECT list(v ORDER BY i) AS tab FROM bits),
original AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS cid,
    hex(encode(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))) AS key
  FROM conversations
),
kinds AS (
  SELECT *, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length(key) // 2 + 1), lambda j: ('0x' || substr(key, 2 * j - 1, 2))::BIGINT)),
    lambda c, b: xor(c >> 8, tab[xor(c & 255, b) + 1])), 4294967295) % 20 AS kind
  FROM original, crc_table
),
damaged AS (
  SELECT cid, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM (SELECT *, unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM kinds)
),
placed AS (SELECT *, row_number() OVER (PARTITION BY cid ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged),
judged AS (
  SELECT *, regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS bare, row_number() OVER (PARTITION BY cid, role, text ORDER BY i) > 1 AS again,
    lag(role[1]) OVER (PARTITION BY cid ORDER BY i) || role[1] AS pair
  FROM placed
),
faults AS (
  SELECT cid, i, turn, role, text, pair, CASE WHEN bare = '' THEN 'blank' WHEN again THEN 'duplicate' WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'none' END AS fault FROM judged
),
inserts(s, t) AS (VALUES (0, 2), (1, 2), (3, 2), (2, 3)),
gaps AS (
  SELECT s, s AS t, '' AS letters, 0 AS cost FROM range(4) r(s) UNION ALL SELECT s, t, 'I', 2 FROM inserts
  UNION ALL SELECT a.s, b.t, 'II', 4 FROM inserts a JOIN inserts b ON a.t = b.s
),
ops AS (
  SELECT s, s AS t, 'D' AS letter, 3 AS cost, NULL::VARCHAR AS initial FROM range(4) r(s) UNION ALL SELECT s, t, 'R', 2, NULL::VARCHAR FROM inserts
  UNION ALL SELECT * FROM (VALUES (0, 1, 'K', 0, 's'), (0, 2, 'K', 0, 'u'), (1, 2, 'K', 0, 'u'), (3, 2, 'K', 0, 'u'), (2, 3, 'K', 0, 'a'))
),
paths AS (
  SELECT DISTINCT cid, 0::BIGINT AS i, 0 AS s, {'c': 0, 'a': ''} AS best FROM original
  UNION ALL
  SELECT p.cid, f.i, o.t, min({'c': (p.best.c + g.cost + o.cost + CASE WHEN o.letter <> 'D' AND f.fault = 'truncated' THEN 1 ELSE 0 END)::INTEGER, 'a': p.best.a || g.letters || o.letter})
  FROM paths p JOIN faults f ON f.cid = p.cid AND f.i = p.i + 1 JOIN gaps g ON g.s = p.s JOIN ops o ON o.s = g.t
  WHERE (o.letter = 'D' OR f.fault NOT IN ('blank', 'duplicate')) AND (o.initial IS NULL OR o.initial = f.role[1])
  GROUP BY p.cid, f.i, o.t
),
ends AS (
  SELECT p.cid, min({'c': p.best.c + g.cost, 'a': p.best.a || g.letters}) AS best
  FROM paths p JOIN gaps g ON g.s = p.s
  WHERE g.t IN (0, 3) AND p.i = (SELECT count(*) FROM faults f WHERE f.cid = p.cid) GROUP BY p.cid
),
letters AS (SELECT cid, unnest(range(1, length(best.a) + 1)) AS k, best.a AS a FROM ends),
edits AS (
  SELECT cid, k, a[k] AS letter, sum((a[k] <> 'I')::INT) OVER (PARTITION BY cid ORDER BY k) AS i, sum((a[k] <> 'D')::INT) OVER (PARTITION BY cid ORDER BY k) AS emitted FROM letters
),
lines AS (
  SELECT e.*, f.role, CASE WHEN letter = 'I' THEN '' ELSE f.text END AS text, max((letter = 'K' AND emitted = 1 AND f.role[1] = 's')::INT) OVER (PARTITION BY e.cid) AS system
  FROM edits e LEFT JOIN faults f ON f.cid = e.cid AND f.i = e.i
),
repaired AS (
  SELECT cid, string_agg(CASE WHEN letter = 'K' THEN role WHEN (emitted - system) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY k) AS whole
  FROM lines WHERE letter <> 'D' GROUP BY cid
),
counted AS (
  SELECT cid, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faults GROUP BY cid
)
SELECT DISTINCT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
  coalesce(illegal, 0)::BIGINT AS illegal, e.best.c::BIGINT AS cost, e.best.a AS audit, sha256(coalesce(whole, '')) AS repaired_sha256
FROM original o JOIN ends e USING (cid) LEFT JOIN repaired USING (cid) LEFT JOIN counted USING (cid)
"""
