"""Repair of conversations whose turns are missing, blank, repeated, cut off or out of role.

Rows go to the task of their conversation and are sorted by turn, last first. The task reads them as a stream: what it
holds of a conversation is the cheapest cost from here to the end for each of the four states of `(s?(ua)+)?`, carried
from one batch to the next, and two bytes of decisions a row, which go to a scratch file of the task once they are many.
At the conversation's first row the decisions are followed forward and give the audit. A second stream, first row first,
applies it; it keeps one row at a time.

Rows of one turn are taken by role and the SHA-256 of their text. A null role or text is one space, and a null turn comes
first. Null conversation ids are one conversation. Identical rows are repeats of one another.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SPACES = " \t\n\x0b\x0c\r"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1  # costs
LETTERS = "DIKR"  # in the order in which ties are broken
NEXT = (2, 2, 3, 2)  # state after the only role that may be put in: start, after s, after u, after a
PUT = ("user", "user", "assistant", "user")
FAR = 1 << 60
HELD = 8 << 20  # bytes of decisions in memory
FACTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def damaged(convs: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv, turn, role, text, copies: each row damaged as crc32 of `conv:turn` modulo 20 says; 0 copies of a row that is dropped."""
    conv, turn, role, text = (F.col(c) for c in (conv_col, turn_col, role_col, text_col))
    blank = F.lit(" ")
    kind = F.crc32(F.concat(F.coalesce(conv.cast("string"), blank), F.lit(":"), F.coalesce(turn.cast("string"), blank))) % 20
    text = F.coalesce(text, blank)
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    role = F.when(kind == 4, "user").otherwise(F.coalesce(role, blank))
    return convs.select(conv.alias("conv"), turn.cast("long").alias("turn"), role.alias("role"), text.alias("text"), F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).cast("long").alias("copies"))


class Decisions:
    """Two bytes a row, read back last first; beyond HELD bytes they are kept in a scratch file that ends with the conversation."""

    def __init__(self, held: int = HELD):
        self.now, self.held, self.file = bytearray(), held, None

    def add(self, x: int) -> None:
        self.now += x.to_bytes(2, "little")
        if len(self.now) >= self.held:
            self.file = self.file or tempfile.TemporaryFile()
            self.file.write(self.now)
            self.now.clear()

    def backwards(self) -> Iterator[int]:
        left = self.file.tell() if self.file else 0
        part = self.now
        while True:
            for i in range(len(part) - 2, -1, -2):
                yield part[i] | part[i + 1] << 8
            if not left:
                break
            size = min(self.held, left) & ~1
            left -= size
            self.file.seek(left)
            part = self.file.read(size)
        if self.file:
            self.file.close()


def _inserted(base: list[int]) -> list[int]:
    """Cheapest costs if up to two rows may be put in first; a third never pays."""
    one = [INSERT + base[NEXT[q]] for q in range(4)]
    two = [2 * INSERT + base[NEXT[NEXT[q]]] for q in range(4)]
    return [min(x) for x in zip(base, one, two, strict=True)]


class Repair:
    """The state of one conversation, fed with its rows last first."""

    def __init__(self, held: int = HELD):
        self.cost, self.decisions = _inserted([0, FAR, FAR, 0]), Decisions(held)
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.low = self.high = self.after = None

    def row(self, role: str, turn: int | None, fault: str) -> None:
        initial = role[:1]
        if turn is not None and turn != self.low:
            self.turns, self.low = self.turns + 1, turn
            self.high = turn if self.high is None else self.high
        if self.after is not None and initial + self.after not in ("su", "ua", "au"):
            self.illegal += 1
        self.after = initial
        if fault:
            setattr(self, fault, getattr(self, fault) + 1)
        more = TRUNCATED if fault == "truncated" else 0
        options = []
        for q in range(4):
            keep = rerole = FAR
            if fault not in ("blank", "duplicate"):
                rerole = REROLE + more + self.cost[NEXT[q]]
                if initial == PUT[q][0]:
                    keep = KEEP + more + self.cost[NEXT[q]]
                elif q == 0 and initial == "s":
                    keep = KEEP + more + self.cost[1]
            options.append((DELETE + self.cost[q], FAR, keep, rerole))
        cost = _inserted([min(o) for o in options])
        word = (initial == "s") << 8
        for q in range(4):
            d, _, k, r = options[q]
            word |= (d, INSERT + cost[NEXT[q]], k, r).index(cost[q]) << 2 * q
        self.decisions.add(word)
        self.cost = cost

    def result(self) -> tuple[dict[str, int], str]:
        audit, q = bytearray(), 0
        for word in self.decisions.backwards():
            while True:
                move = word >> 2 * q & 3
                audit += LETTERS[move].encode()
                if move == 0:
                    break
                q = 1 if move == 2 and q == 0 and word >> 8 else NEXT[q]
                if move != 1:
                    break
        while q in (1, 2):
            audit += b"I"
            q = NEXT[q]
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return dict(zip(FACTS, (gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost[0]), strict=True)), audit.decode()


def _order(asc: bool) -> list[Column]:
    return [F.col(c).asc() if asc else F.col(c).desc() for c in ("has_turn", "turn", "role", "digest")]


def audits(rows: DataFrame, held: int = HELD) -> DataFrame:
    """conv, gaps, blank, duplicate, truncated, illegal, cost, audit for each conversation of rows(conv, turn, role, text, copies); one whose rows all have 0 copies has zeros and an empty audit."""
    trimmed = F.rtrim(F.col("text"), F.lit(SPACES))
    kind = rows.schema["conv"].dataType
    slim = rows.select(F.col("conv").cast("string").alias("conv"), F.col("turn").isNotNull().alias("has_turn"), F.coalesce("turn", F.lit(0)).cast("long").alias("turn"), "role", F.sha2(F.col("text").cast("binary"), 256).alias("digest"), (trimmed == "").alias("is_blank"), (~F.right(trimmed, F.lit(1)).isin(".", "!", "?")).alias("is_cut"), "copies")
    slim = slim.groupBy("conv", "has_turn", "turn", "role", "digest", "is_blank", "is_cut").agg(F.sum("copies").alias("copies"))
    there = F.when(F.col("copies") > 0, F.struct("has_turn", "turn"))
    alike = Window.partitionBy("conv", "role", "digest")
    # Rows are dealt by conversation once; the window and the sort below need no other exchange.
    slim = slim.repartition("conv").withColumn("first", F.coalesce(F.min(there).over(alike) == F.struct("has_turn", "turn"), F.lit(False)))
    slim = slim.sortWithinPartitions("conv", *_order(False)).select("conv", "has_turn", "turn", "role", "is_blank", "is_cut", "copies", "first")
    numbers = ", ".join(f"{c} long" for c in FACTS)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name, now, began, out = None, Repair(held), False, []

        def close() -> None:
            facts, audit = now.result()
            out.append({"conv": name, **facts, "audit": audit})

        for batch in batches:
            for conv, has_turn, turn, role, is_blank, is_cut, copies, first in batch.itertuples(index=False, name=None):
                conv = None if conv is None or conv != conv else conv
                if began and conv != name:
                    close()
                    now = Repair(held)
                name, began = conv, True
                at = turn if has_turn else None
                for i in range(copies, 0, -1):  # the first copy comes last here
                    now.row(role, at, "blank" if is_blank else "duplicate" if i > 1 or not first else "truncated" if is_cut else "")
            if out:
                yield pd.DataFrame(out)
                out.clear()
        if began:
            close()
            yield pd.DataFrame(out)

    return slim.mapInPandas(run, f"conv string, {numbers}, audit string").withColumn("conv", F.col("conv").cast(kind))


def _edits(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Each conversation's audit, then its rows by turn, in the task of the conversation."""
    nothing = {"has_turn": F.lit(False), "turn": F.lit(0).cast("long"), "role": F.lit(None).cast("string"), "text": F.lit(None).cast("string"), "copies": F.lit(0).cast("long"), "digest": F.lit(None).cast("string")}
    said = found.select(F.col("conv").cast("string").alias("conv"), F.lit(0).alias("kind"), *(v.alias(k) for k, v in nothing.items()), *FACTS, "audit")
    texts = rows.where("copies > 0").select(F.col("conv").cast("string").alias("conv"), F.lit(1).alias("kind"), F.col("turn").isNotNull().alias("has_turn"), F.coalesce("turn", F.lit(0)).cast("long").alias("turn"), "role", "text", "copies", F.sha2(F.col("text").cast("binary"), 256).alias("digest"), *(F.lit(0).cast("long").alias(c) for c in FACTS), F.lit(None).cast("string").alias("audit"))
    return said.unionByName(texts).repartition("conv").sortWithinPartitions("conv", "kind", *_order(True)).select("conv", "kind", "turn", "has_turn", "role", "text", "copies", *FACTS, "audit")


class Editor:
    """Applies an audit to rows as they come; gives role and text of each row that stays or is put in."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, 0

    def _put(self) -> Iterator[tuple[str, str]]:
        while self.audit[self.at : self.at + 1] == "I":
            yield PUT[self.state], ""
            self.state, self.at = NEXT[self.state], self.at + 1

    def row(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        yield from self._put()
        move = self.audit[self.at]
        self.at += 1
        if move == "D":
            return
        yield (PUT[self.state] if move == "R" else role), text
        self.state = 1 if move == "K" and self.state == 0 and role[:1] == "s" else NEXT[self.state]

    def end(self) -> Iterator[tuple[str, str]]:
        yield from self._put()


def repaired(rows: DataFrame, found: DataFrame) -> DataFrame:
    """conv, place, turn (null for a row put in), role, text: the conversations of rows after the edits of found."""
    kind = rows.schema["conv"].dataType

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name, editor, place, out = None, None, 0, []

        def take(pieces, turn):
            nonlocal place
            for role, text in pieces:
                out.append((name, place, turn, role, text))
                place += 1

        for batch in batches:
            for conv, what, turn, has_turn, role, text, copies, *_, audit in batch.itertuples(index=False, name=None):
                if what == 0:
                    if editor:
                        take(editor.end(), None)
                    name, editor, place = conv, Editor(audit), 0
                for _ in range(copies):
                    take(editor.row(role, text), str(turn) if has_turn else None)
            yield pd.DataFrame(out, columns=["conv", "place", "turn", "role", "text"])
            out.clear()
        if editor:
            take(editor.end(), None)
            yield pd.DataFrame(out, columns=["conv", "place", "turn", "role", "text"])

    made = _edits(rows, found).mapInPandas(run, "conv string, place long, turn string, role string, text string")
    return made.withColumn("conv", F.col("conv").cast(kind)).withColumn("turn", F.col("turn").cast("long"))


def digests(rows: DataFrame, found: DataFrame) -> DataFrame:
    """found with repaired_sha256: of `role:text` of the repaired rows, joined by newlines, hashed as they stream by."""
    kind = rows.schema["conv"].dataType
    columns = ["conv", *FACTS, "audit", "repaired_sha256"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        head, editor, digest, begun, out = None, None, None, False, []

        def take(pieces):
            nonlocal begun
            for role, text in pieces:
                digest.update(f"{'\n' if begun else ''}{role}:{text}".encode())
                begun = True

        def close():
            take(editor.end())
            out.append((*head, digest.hexdigest()))

        for batch in batches:
            for conv, what, _, _, role, text, copies, *facts in batch.itertuples(index=False, name=None):
                if what == 0:
                    if editor:
                        close()
                    head, editor, digest, begun = (conv, *facts), Editor(facts[-1]), hashlib.sha256(), False
                for _ in range(copies):
                    take(editor.row(role, text))
            if out:
                yield pd.DataFrame(out, columns=columns)
                out.clear()
        if editor:
            close()
            yield pd.DataFrame(out, columns=columns)

    made = _edits(rows, found).mapInPandas(run, "conv string, " + ", ".join(f"{c} long" for c in FACTS) + ", audit string, repaired_sha256 string")
    return made.withColumn("conv", F.col("conv").cast(kind))


def _oracle() -> str:
    """The rows of op11, for DuckDB: costs to the end from the last row to the first, as strings of cost and edits so that the least is the answer, then the edits from the first row on."""
    def more(x: str, cost: str, letters: str) -> str:
        return f"(lpad(CAST(CAST(substr({x}, 1, 9) AS BIGINT) + {cost} AS VARCHAR), 9, '0') || '{letters}' || substr({x}, 10))"

    step = "v0"
    table = "SELECT i, i AS v0 FROM (SELECT unnest(range(0, 256)) AS i)"
    for k in range(1, 9):
        table = f"SELECT i, CASE WHEN v{k - 1} % 2 = 1 THEN xor(v{k - 1} // 2, 3988292384) ELSE v{k - 1} // 2 END AS v{k} FROM ({table})"
        step = f"v{k}"
    base = []
    for q in range(4):
        rerole = f"CASE WHEN fault NOT IN ('blank', 'duplicate') THEN {more(f'f{NEXT[q]}', f'{REROLE} + extra', 'R')} END"
        keep = f"CASE WHEN fault NOT IN ('blank', 'duplicate') AND initial = '{PUT[q][0]}' THEN {more(f'f{NEXT[q]}', 'extra', 'K')}" + (f" WHEN fault NOT IN ('blank', 'duplicate') AND initial = 's' THEN {more('f1', 'extra', 'K')}" if q == 0 else "") + " END"
        base.append(f"least({more(f'f{q}', str(DELETE), 'D')}, coalesce({keep}, '9'), coalesce({rerole}, '9')) AS b{q}")
    relaxed = ", ".join(f"least(b{q}, {more(f'b{NEXT[q]}', str(INSERT), 'I')}, {more(f'b{NEXT[NEXT[q]]}', str(2 * INSERT), 'II')})" for q in range(4))
    put = "CASE WHEN q = 2 THEN 'assistant' ELSE 'user' END"
    follow = "CASE WHEN q = 2 THEN 3 ELSE 2 END"
    return rf"""
WITH RECURSIVE
bytes AS (SELECT i, {step} AS v FROM ({table})),
named AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS s FROM conversations),
crc AS (SELECT DISTINCT s, CAST(0 AS BIGINT) AS i, CAST(4294967295 AS BIGINT) AS c FROM named
  UNION ALL SELECT s, crc.i + 1, xor(c // 256, b.v) FROM crc JOIN bytes b ON b.i = xor(c % 256, ascii(substr(s, CAST(crc.i AS INTEGER) + 1, 1))) WHERE crc.i < length(s)),
kinds AS (SELECT s, xor(c, 4294967295) % 20 AS kind FROM crc WHERE i = length(s)),
made AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, kind FROM named JOIN kinds USING (s)),
rows AS (SELECT conv_id, turn, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn ASC NULLS FIRST, role, sha256(text), copy) AS i FROM (SELECT *, unnest(range(0, CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy FROM made WHERE kind <> 0)),
seen AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS nth, lag(role) OVER (PARTITION BY conv_id ORDER BY i) AS before, count(*) OVER (PARTITION BY conv_id) AS n FROM rows),
faults AS (SELECT *, substr(role, 1, 1) AS initial, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN nth > 1 THEN 'duplicate' WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault FROM seen),
back AS (
  SELECT conv_id, CAST(max(n) AS BIGINT) AS i, '000000000' AS f0, '000000004II' AS f1, '000000002I' AS f2, '000000000' AS f3 FROM faults GROUP BY conv_id
  UNION ALL SELECT conv_id, i - 1, {relaxed} FROM (
    SELECT b.conv_id, b.i, {", ".join(base)} FROM (SELECT b.*, f.fault, f.initial, CASE WHEN f.fault = 'truncated' THEN {TRUNCATED} ELSE 0 END AS extra FROM back b JOIN faults f ON f.conv_id = b.conv_id AND f.i = b.i) b)),
best AS (SELECT conv_id, CAST(substr(f0, 1, 9) AS BIGINT) AS cost, substr(f0, 10) AS audit FROM back WHERE i = 0),
walk AS (
  SELECT conv_id, audit, CAST(0 AS BIGINT) AS j, CAST(0 AS BIGINT) AS i, 0 AS q, CAST(NULL AS VARCHAR) AS acc FROM best
  UNION ALL SELECT w.conv_id, w.audit, w.j + 1, CASE WHEN letter = 'I' THEN w.i ELSE w.i + 1 END,
    CASE WHEN letter = 'D' THEN q WHEN letter = 'K' AND q = 0 AND substr(f.role, 1, 1) = 's' THEN 1 ELSE {follow} END,
    CASE WHEN letter = 'D' THEN acc ELSE coalesce(acc || chr(10), '') || CASE letter WHEN 'I' THEN {put} || ':' WHEN 'R' THEN {put} || ':' || f.text ELSE f.role || ':' || f.text END END
  FROM (SELECT *, substr(audit, CAST(j AS INTEGER) + 1, 1) AS letter FROM walk WHERE j < length(audit)) w LEFT JOIN rows f ON f.conv_id = w.conv_id AND f.i = w.i + 1),
done AS (SELECT conv_id, sha256(coalesce(acc, '')) AS h FROM walk WHERE j = length(audit)),
facts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
  count(*) FILTER (before IS NOT NULL AND substr(before, 1, 1) || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM faults GROUP BY conv_id)
SELECT a.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, coalesce(h, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a LEFT JOIN facts f ON a.conv_id = f.conv_id LEFT JOIN best b ON a.conv_id = b.conv_id LEFT JOIN done d ON a.conv_id = d.conv_id
"""


#: The rows of op11, for DuckDB.
ORACLE = _oracle()
