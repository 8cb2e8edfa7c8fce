"""Conversation structure repair by Wagner-Fischer alignment with target grammars.

A conversation should read ``(s?(ua)+)?`` by the initials of its roles. Its turns
are aligned with that grammar's string of every feasible length by the edit table
of Wagner and Fischer: Keep, Rerole, Delete and Insert have their costs, rows that
must go can only be deleted. The table is filled from the end, so lengths share
it; the cost of a plain left-to-right repair is the incumbent, and cells whose
distance from the diagonal alone would cost more are left out (Ukkonen's band), as
are such lengths. Backtraces take the smallest letter that stays on a cheapest
path, and the backtraced audits of equally cheap lengths are compared.

A conversation is aligned in segments of ``SEGMENT`` rows, each for every state of
the grammar that it may start and end in; segments are aligned apart and the
cheapest chain of them is that of the whole, so the work grows with the rows,
however long a conversation is. Texts never meet in memory: turns become one
letter each for the alignment, and the repaired text is hashed as it streams by in
order.

Defined cases: nulls of roles and texts are one space, and so are those of ids and
turns where a row's damage is drawn; a null conv_id is a conversation of its own;
rows of one turn are in the order of role and text; an empty or unknown role can't
be kept; a conversation that loses all rows has zeros, an empty audit and the hash
of nothing; an empty table gives an empty result; other columns don't matter.
"""

from __future__ import annotations

import hashlib
import json
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessella.llm.common import materialize, small_batches
from tessella.llm.spelling import CRC_TABLE, crc_of

REROLE, DELETE, INSERT, CUT = 3, 4, 3, 3
SEGMENT = 512
FAR = 1 << 60

#: States of the grammar: nothing yet, after the system turn, a user's turn open, complete.
START, LED, OPEN, DONE = range(4)


# --- alignment ----------------------------------------------------------------------------
# A row is a letter: s, u, a or o (another role), in upper case if its text is cut short;
# x has to be deleted.


def _other(role: str) -> str:
    return "a" if role == "u" else "u"


def _plain(rows: str, first: str, last: str) -> int:
    """The cost of repairing rows from left to right into an alternating string with given ends."""
    cost, due, made = 0, first, 0
    for r in rows:
        if r == "x":
            cost += DELETE
            continue
        cost += CUT if r.isupper() else 0
        if r.lower() == _other(due):
            cost += INSERT
            made += 1
            due = _other(due)
        elif r.lower() != due:
            cost += REROLE
        made += 1
        due = _other(due)
    if not made:
        cost, made, due = cost + INSERT, 1, _other(due)
    return cost + (INSERT if due == last else 0)


class _Table:
    """Costs of making the last r roles of an alternating string, which ends in ``last``, of the rows from i on."""

    def __init__(self, rows: str, last: str, most: int):
        self.rows, self.last = rows, last
        n = len(rows)
        left = [0] * (n + 1)  # rows from i on that may stay
        base = [0] * (n + 1)  # what they cost at least
        for i in range(n - 1, -1, -1):
            left[i] = left[i + 1] + (rows[i] != "x")
            base[i] = base[i + 1] + (DELETE if rows[i] == "x" else CUT if rows[i].isupper() else 0)
        self.left, self.base, self.spare = left, base, most - base[0]
        over = self.spare // INSERT  # inserts that the incumbent allows; a deletion costs 1 more than a cut text at least
        self.low = [max(0, left[i] - self.spare) for i in range(n + 1)]
        self.cost = [[]] * (n + 1)
        self.cost[n] = [INSERT * r for r in range(self.low[n], over + 1)]
        for i in range(n - 1, -1, -1):
            row, at, below, b_low = rows[i], self.low[i], self.cost[i + 1], self.low[i + 1]
            out, role, cut = [], row.lower(), CUT if row.isupper() else 0
            for r in range(at, left[i] + over + 1):
                k = r - b_low
                best = below[k] + DELETE if 0 <= k < len(below) else FAR
                if r and out and r > at and out[-1] + INSERT < best:
                    best = out[-1] + INSERT
                if r and row != "x" and 0 <= k - 1 < len(below):
                    step = below[k - 1] + cut + (0 if role == self.role(r) else REROLE)
                    best = min(best, step)
                out.append(best)
            self.cost[i] = out

    def role(self, r: int) -> str:
        return self.last if r % 2 else _other(self.last)

    def at(self, i: int, r: int) -> int:
        k = r - self.low[i]
        return self.cost[i][k] if 0 <= k < len(self.cost[i]) else FAR

    def lengths(self, first: str) -> range:
        """Feasible lengths of strings that begin with ``first``, one role at least."""
        odd = first == self.last
        low = max(1, self.low[0])
        return range(low + ((low % 2 == 1) != odd), self.low[0] + len(self.cost[0]), 2)

    def audit(self, i: int, r: int) -> str:
        """The smallest of the cheapest edits."""
        out, rows, n = [], self.rows, len(self.rows)
        while i < n or r:
            here = self.at(i, r)
            if i < n and self.at(i + 1, r) + DELETE == here:
                out.append("D")
                i += 1
            elif r and self.at(i, r - 1) + INSERT == here:
                out.append("I")
                r -= 1
            else:
                out.append("K" if rows[i].lower() == self.role(r) else "R")
                i, r = i + 1, r - 1
        return "".join(out)


def _after_lead(rows: str, k: int) -> tuple[int, str]:
    """Cost and audit of deleting the rows before a system turn k and keeping it."""
    return DELETE * k + (CUT if rows[k].isupper() else 0), "D" * k + "K"


@lru_cache(maxsize=50_000)
def moves(rows: str) -> dict[tuple[int, int], tuple[int, str]]:
    """The cheapest (cost, audit) from each state of the grammar to each other over some rows; ties to the smallest audit."""
    n = len(rows)
    none = (DELETE * n, "D" * n)
    out = {(s, s): none for s in (START, LED, OPEN, DONE)}

    def offer(a: int, b: int, found: tuple[int, str]) -> None:
        if (a, b) not in out or found < out[a, b]:
            out[a, b] = found

    leads = [k for k in range(n) if rows[k] in "sS"]
    for k in leads:
        cost, audit = _after_lead(rows, k)
        offer(START, LED, (cost + DELETE * (n - k - 1), audit + "D" * (n - k - 1)))
    for last, end in (("u", OPEN), ("a", DONE)):
        most = max(_plain(rows, first, last) for first in "ua")
        table = _Table(rows, last, most)
        for first, starts in (("u", (START, LED, DONE)), ("a", (OPEN,))):
            costs = {r: table.at(0, r) for r in table.lengths(first)}
            best = min(costs.values(), default=FAR)
            if best <= most:
                found = min((best, table.audit(0, r)) for r, c in costs.items() if c == best)
                for s in starts:
                    offer(s, end, found)
        for k in leads:  # the system turn is kept and what follows begins with a user's turn
            cost, audit = _after_lead(rows, k)
            if cost > out[START, end][0]:
                break
            inner = _led(rows[k + 1 :], last)
            offer(START, end, (cost + inner[0], audit + inner[1]))
    return out


@lru_cache(maxsize=20_000)
def _led(rows: str, last: str) -> tuple[int, str]:
    """The cheapest (cost, audit) of making rows a string from a user's turn on, one role at least."""
    most = _plain(rows, "u", last)
    table = _Table(rows, last, most)
    costs = {r: table.at(0, r) for r in table.lengths("u")}
    best = min(costs.values())
    return min((best, table.audit(0, r)) for r, c in costs.items() if c == best)


def chain(segments: list[dict]) -> list[tuple[int, str]]:
    """Cost and audit of each segment in the cheapest repair of all."""
    states, back = {START: (0, "")}, []
    for step in segments:
        reached, via = {}, {}
        for (a, b), (cost, audit) in step.items():
            if a in states:
                found = (states[a][0] + cost, states[a][1] + audit)
                if b not in reached or found < reached[b]:
                    reached[b], via[b] = found, (a, (cost, audit))
        states = reached
        back.append(via)
    at = min((s for s in (START, DONE) if s in states), key=lambda s: states[s])
    out = []
    for via in reversed(back):
        at, piece = via[at]
        out.append(piece)
    return out[::-1]


# --- rows ---------------------------------------------------------------------------------


def damaged(rows: DataFrame) -> DataFrame:
    """Rows with the damage that is drawn from conv_id and turn: dropped, emptied, cut, repeated, role lost."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    rows = rows.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"), kind.cast("int").alias("kind")).where("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.explode(copies).alias("copy"))


def examined(rows: DataFrame) -> DataFrame:
    """Rows in order (``row``, ``segment``) with their fault, whether they follow lawfully, and their letter.

    Written to the shared folder. All windows are over one shuffle by conversation.
    """
    order = [F.col("turn").asc_nulls_first(), "role", "text", "again"]  # of equal rows the one that counts as first comes first
    again = F.row_number().over(Window.partitionBy("conv_id", "role", "text").orderBy(F.col("turn").asc_nulls_first()))
    in_order = Window.partitionBy("conv_id").orderBy(*order)
    last = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    fault = F.when(last == "", "blank").when(F.col("again") > 1, "duplicate").when(~last.isin(".", "!", "?"), "truncated")
    initial = F.substring("role", 1, 1)
    pair = F.concat(F.lag(initial).over(in_order), initial)
    letter = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    letter = F.when(F.col("fault").isin("blank", "duplicate"), "x").when(F.col("fault") == "truncated", F.upper(letter)).otherwise(letter)
    rows = rows.withColumn("again", again).withColumns({"row": F.row_number().over(in_order) - 1, "illegal": (~pair.isin("su", "ua", "au")).cast("int")})
    rows = rows.withColumn("fault", fault).withColumns({"letter": letter, "segment": F.call_function("div", F.col("row"), F.lit(SEGMENT))})
    return materialize(rows.select("conv_id", "turn", "role", "text", "row", "segment", "fault", "letter", "illegal"), "conversation-rows")


def _aligned(frames):
    for frame in frames:
        found = [json.dumps([[a, b, *m] for (a, b), m in moves(letters).items()]) for letters in frame["letters"]]
        yield pd.DataFrame({"key": frame["key"].tolist(), "segment": frame["segment"].to_numpy(), "moves": found})


def _groups(frames, column: str):
    """(key, list of rows) of sorted frames, the key's rows in order."""
    key, held = None, []
    for frame in frames:
        for k, *rest in frame.itertuples(index=False, name=None):
            if held and k != key:
                yield key, held
                held = []
            key = k
            held.append(rest)
    if held:
        yield key, held


def _chained(frames):
    def rows():
        for key, held in _groups(frames, "key"):
            steps = [{(a, b): (c, t) for a, b, c, t in json.loads(m)} for _, m in held]
            for (segment, _), (cost, audit) in zip(held, chain(steps)):
                yield key, segment, cost, audit

    yield from _framed(rows(), ["key", "segment", "cost", "piece"])


def _framed(rows, columns: list[str], most: int = 20_000):
    held = []
    for r in rows:
        held.append(r)
        if len(held) >= most:
            yield pd.DataFrame(held, columns=columns)
            held = []
    if held:
        yield pd.DataFrame(held, columns=columns)


def _key() -> Column:
    return F.to_json(F.struct("conv_id")).alias("key")


def audits(rows: DataFrame) -> DataFrame:
    """(key, segment, cost, piece): the cheapest repair's cost and edits by segment."""
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("row", "letter"))), lambda s: s["letter"]), "")
    segments = rows.groupBy(_key(), "segment").agg(joined.alias("letters"))
    steps = segments.mapInPandas(_aligned, "key string, segment long, moves string")
    return steps.repartition("key").sortWithinPartitions("key", "segment").mapInPandas(_chained, "key string, segment long, cost long, piece string")


def _repaired(frames):
    """Hashes of repaired texts: pieces of audits come before the rows of their segment."""

    def rows():
        key, digest, piece, at, due, lines = None, hashlib.sha256(), "", 0, "u", 0

        def put(role: str, text: str) -> None:
            nonlocal due, lines
            digest.update((("\n" if lines else "") + f"{role}:{text}").encode("utf-8", "surrogatepass"))
            due, lines = _other(due) if role[:1] in ("u", "a") else due, lines + 1

        def inserts() -> None:
            nonlocal at
            while at < len(piece) and piece[at] == "I":
                put("user" if due == "u" else "assistant", "")
                at += 1

        for frame in frames:
            for k, kind, role, text, edits in frame[["key", "kind", "role", "text", "piece"]].itertuples(index=False, name=None):
                if k != key:
                    if key is not None:
                        inserts()
                        yield key, digest.hexdigest()
                    key, digest, piece, at, due, lines = k, hashlib.sha256(), "", 0, "u", 0
                if kind == 0:
                    inserts()
                    piece, at = edits, 0
                    continue
                inserts()
                edit, at = piece[at], at + 1
                if edit == "K":
                    put(role, text)
                elif edit == "R":
                    put("user" if due == "u" else "assistant", text)
        if key is not None:
            inserts()
            yield key, digest.hexdigest()

    yield from _framed(rows(), ["key", "repaired_sha256"])


def repair(conversations: DataFrame) -> DataFrame:
    """A row a conversation: its faults after ``damaged``, the cheapest repair and the repaired text's hash."""
    small_batches(conversations.sparkSession)
    rows = examined(damaged(conversations))
    pieces = materialize(audits(rows), "conversation-audits")
    lines = pieces.select("key", "segment", F.lit(0).alias("kind"), F.lit(0).alias("row"), F.lit("").alias("role"), F.lit("").alias("text"), "piece")
    lines = lines.unionByName(rows.select(_key(), "segment", F.lit(1).alias("kind"), "row", "role", "text", F.lit("").alias("piece")))
    hashed = lines.repartition("key").sortWithinPartitions("key", "segment", "kind", "row").mapInPandas(_repaired, "key string, repaired_sha256 string")
    whole = pieces.groupBy("key").agg(F.sum("cost").alias("cost"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("segment", "piece"))), lambda s: s["piece"]), "").alias("audit"))
    many = lambda fault: F.count_if(F.col("fault") == fault).alias(fault)
    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long")
    counted = rows.groupBy("conv_id").agg(gaps.alias("gaps"), many("blank"), many("duplicate"), many("truncated"), F.coalesce(F.sum("illegal"), F.lit(0)).alias("illegal"))
    found = counted.withColumn("key", _key()).drop("conv_id").join(whole, "key").join(hashed, "key")
    every = conversations.select("conv_id").distinct().withColumn("key", _key())
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    nothing = hashlib.sha256().hexdigest()
    return every.join(found, "key", "left").select(
        "conv_id", *map(zero, ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"),
    )


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations after damage, with their cheapest repairs."""
    return repair(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


#: The cheapest repair as a walk over the grammar's states, a row a step: another way to the same answer.
OP13_SQL = rf"""
WITH RECURSIVE {CRC_TABLE},
raw AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
drawn AS (SELECT raw.*, {crc_of("k")} % 20 AS kind FROM raw, crc),
dam AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(CASE kind WHEN 0 THEN [] WHEN 3 THEN [0, 1] ELSE [0] END) AS copy FROM drawn),
ranked AS (SELECT *, dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, again) AS n, regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS tail FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) AS again FROM dam)),
rws AS MATERIALIZED (SELECT *, substr(role, 1, 1) AS r, CASE WHEN tail = '' THEN 'blank' WHEN again > 1 THEN 'duplicate' WHEN tail NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault, lag(substr(role, 1, 1)) OVER (PARTITION BY c ORDER BY n) || substr(role, 1, 1) AS pair FROM ranked),
ins(a, b, cost, letters) AS (VALUES (0, 0, 0, ''), (0, 2, 3, 'I'), (0, 3, 6, 'II'), (1, 1, 0, ''), (1, 2, 3, 'I'), (1, 3, 6, 'II'), (2, 2, 0, ''), (2, 3, 3, 'I'), (3, 3, 0, ''), (3, 2, 3, 'I')),
edits(a, b, cost, letter, role) AS (VALUES (0, 0, 4, 'D', ''), (1, 1, 4, 'D', ''), (2, 2, 4, 'D', ''), (3, 3, 4, 'D', ''), (0, 1, 0, 'K', 's'), (0, 2, 0, 'K', 'u'), (1, 2, 0, 'K', 'u'), (3, 2, 0, 'K', 'u'), (2, 3, 0, 'K', 'a'), (0, 2, 3, 'R', ''), (1, 2, 3, 'R', ''), (3, 2, 3, 'R', ''), (2, 3, 3, 'R', '')),
dp AS (
  SELECT c, 0::BIGINT AS n, 0 AS st, 0::BIGINT AS cost, '' AS audit FROM rws GROUP BY c
  UNION ALL
  SELECT c, n, st, best.cost, best.audit FROM (
    SELECT d.c, w.n, e.b AS st, min({{'cost': CAST(d.cost + i.cost + e.cost + CASE WHEN e.letter <> 'D' AND w.fault = 'truncated' THEN 3 ELSE 0 END AS BIGINT), 'audit': d.audit || i.letters || e.letter}}) AS best
    FROM dp d JOIN rws w ON w.c = d.c AND w.n = d.n + 1 JOIN ins i ON i.a = d.st JOIN edits e ON e.a = i.b
    WHERE e.letter = 'D' OR (w.fault NOT IN ('blank', 'duplicate') AND (e.letter = 'R' OR e.role = w.r))
    GROUP BY d.c, w.n, e.b)),
ends AS (SELECT d.c, min({{'cost': CAST(d.cost + i.cost AS BIGINT), 'audit': d.audit || i.letters}}) AS best FROM dp d JOIN (SELECT c, max(n) AS m FROM rws GROUP BY c) t ON t.c = d.c AND t.m = d.n JOIN ins i ON i.a = d.st WHERE i.b IN (0, 3) GROUP BY d.c),
letters AS (SELECT c, best.audit AS audit, unnest(range(1, length(best.audit) + 1)) AS p FROM ends),
spelt AS (SELECT c, p, substr(audit, p, 1) AS e, sum(CASE WHEN substr(audit, p, 1) <> 'I' THEN 1 ELSE 0 END) OVER (PARTITION BY c ORDER BY p) AS n, sum(CASE WHEN substr(audit, p, 1) <> 'D' THEN 1 ELSE 0 END) OVER (PARTITION BY c ORDER BY p) AS place FROM letters),
kept AS (SELECT s.c, s.p, s.e, s.place, w.role, w.text, max(CASE WHEN s.place = 1 AND s.e = 'K' AND w.r = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY s.c) AS lead_s FROM spelt s LEFT JOIN rws w ON w.c = s.c AND w.n = s.n AND s.e <> 'I' WHERE s.e <> 'D'),
line AS (SELECT c, p, (CASE WHEN e = 'K' THEN role WHEN (place - lead_s) % 2 = 1 THEN 'user' ELSE 'assistant' END) || ':' || (CASE WHEN e = 'I' THEN '' ELSE text END) AS t FROM kept),
hashed AS (SELECT c, sha256(string_agg(t, chr(10) ORDER BY p)) AS h FROM line GROUP BY c),
stats AS (SELECT c, any_value(conv_id) AS conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM rws GROUP BY c)
SELECT o.conv_id, CAST(coalesce(s.gaps, 0) AS BIGINT) AS gaps, coalesce(s.blank, 0) AS blank, coalesce(s.duplicate, 0) AS duplicate, coalesce(s.truncated, 0) AS truncated, coalesce(s.illegal, 0) AS illegal, coalesce(e.best.cost, 0) AS cost, coalesce(e.best.audit, '') AS audit, coalesce(h.h, '{hashlib.sha256().hexdigest()}') AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN stats s ON s.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN ends e ON e.c = s.c LEFT JOIN hashed h ON h.c = s.c
"""
