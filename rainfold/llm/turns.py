"""Conversation structure repair by alignment to the strings of a grammar.

A conversation's rows, by turn (none first), then role and text, shall give role initials ``(s?(ua)+)?``. Each row's first fault counts: ``blank`` (nothing but white
space), ``duplicate`` (role and text seen earlier), ``truncated`` (its last character other than white space isn't one of ``.!?``). Edits: Keep costs 0, Rerole to user or assistant 1, Delete 2
(blank and duplicate rows must go), Insert of an empty user or assistant turn 5; a truncated row that stays adds 5. The cheapest edits' initials in order are the ``audit``, of equally
cheap ones the least in ASCII order.

Alignment (Wagner-Fischer). Rows are aligned to each feasible length of the string ``uaua...``. These strings are suffixes of each other, so one table, filled from the end, holds the costs for
all of them: cell (i, q) is the least cost of turning the rows from i on into the last q symbols. A leading ``s`` is a kept row whose predecessors are deleted. A cheap way that one
walk over the rows finds is the incumbent: cells whose own lower bound (what must go, then 2 a row too many or 5 a symbol too many) exceeds its cost lie outside the Ukkonen band, and so do lengths. The
audits of all lengths that reach the least cost are traced back and compared.

The band of a conversation of over ``LONG`` rows would grow with the square of its rows; such a one is walked through the grammar's own states instead, in time and memory proportional to its rows, with the same cost
and audit, which tests compare. Rows are streamed in order, sorted by Spark within tasks: a task holds the initials and faults of one conversation, a byte a row, and no texts.

Defined results: a null conv_id is a conversation, null roles and texts are empty, null turns come first and don't count as gaps; equal rows are duplicates; a text of any length is
streamed; other columns are left alone, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rainfold.llm.common import Scratch, arrow_schema, batch_of, table

REROLE, DELETE, INSERT, CUT = 1, 2, 5, 5
LONG = 2048
FAR = 1 << 40
ROLE = {"u": "user", "a": "assistant"}
#: A row as a byte: its initial, and what stands in the way of keeping it.
INITIALS, MUST_GO, TRUNCATED = "?sua", 4, 8


def code(initial: str, fault: str | None) -> int:
    return max(0, INITIALS.find(initial or "?")) + {"blank": MUST_GO, "duplicate": MUST_GO, "truncated": TRUNCATED}.get(fault, 0)


def incumbent(rows: bytes) -> int:
    """The cost of deleting whatever is faulty or out of turn, the first row that fits being kept each time."""
    cost, want = 0, "u"
    for at, r in enumerate(rows):
        initial = INITIALS[r & 3]
        if r >= MUST_GO or initial != want:
            cost += DELETE
        else:
            want = "a" if want == "u" else "u"
    return cost if want == "u" else cost + INSERT


class Table:
    """Costs of aligning the rows from each one on with the last q symbols of ``uaua...``, within the band of ``limit``."""

    def __init__(self, rows: bytes, limit: int):
        n = len(rows)
        self.rows, self.low = rows, [0] * (n + 1)
        free = np.array([not r & MUST_GO for r in rows], np.int64)
        # Of the rows from i on, how many may stay; whatever happens, the others cost the limit that much.
        stay = np.concatenate((np.cumsum(free[::-1])[::-1], [0]))
        slack = limit - DELETE * int((1 - free).sum())
        self.costs: list[np.ndarray] = [np.empty(0, np.int64)] * (n + 1)
        for i in range(n, -1, -1):
            low, high = max(0, int(stay[i]) - slack // DELETE), int(stay[i]) + slack // INSERT
            q = np.arange(low, high + 1)
            best = np.where(q == 0, 0, FAR) if i == n else self.at(i + 1, q) + DELETE
            if i < n and not rows[i] & MUST_GO:
                wanted = np.where(q % 2 == 0, INITIALS.index("u"), INITIALS.index("a"))
                fits = np.where(rows[i] & 3 == wanted, 0, REROLE) + (CUT if rows[i] & TRUNCATED else 0)
                best = np.minimum(best, np.where(q > 0, self.at(i + 1, q - 1) + fits, FAR))
            # An insertion comes from the cell before: the running minimum of what each cell costs less its place.
            best = np.minimum.accumulate(best - INSERT * q) + INSERT * q
            self.low[i], self.costs[i] = low, best

    def at(self, i: int, q: np.ndarray) -> np.ndarray:
        own, place = self.costs[i], q - self.low[i]
        return np.where((place >= 0) & (place < len(own)), own[np.clip(place, 0, len(own) - 1)], FAR)

    def one(self, i: int, q: int) -> int:
        place = q - self.low[i]
        return int(self.costs[i][place]) if 0 <= place < len(self.costs[i]) else FAR

    def audit(self, i: int, q: int) -> str:
        """The least of the cheapest edits from row i on."""
        out = []
        while i < len(self.rows) or q:
            left = self.one(i, q)
            row = self.rows[i] if i < len(self.rows) else MUST_GO
            fits = INITIALS[row & 3] == ("u" if q % 2 == 0 else "a")
            extra = CUT if row & TRUNCATED else 0
            if i < len(self.rows) and self.one(i + 1, q) + DELETE == left:
                out.append("D")
                i += 1
            elif q and self.one(i, q - 1) + INSERT == left:
                out.append("I")
                q -= 1
            else:
                out.append("K" if fits and self.one(i + 1, q - 1) + extra == left else "R")
                i, q = i + 1, q - 1
        return "".join(out)


def aligned(rows: bytes) -> tuple[int, str]:
    """(cost, audit) of a conversation's rows, by alignment to every feasible length."""
    n = len(rows)
    limit = min(DELETE * n, incumbent(rows))
    costs = Table(rows, limit)
    starts = [(0, 0, 0)] + [(p, DELETE * p + (CUT if r & TRUNCATED else 0), 1) for p, r in enumerate(rows) if INITIALS[r & 3] == "s" and not r & MUST_GO]
    best, ways = limit, []
    for p, before, kept in starts:
        i = p + kept
        for q in range(costs.low[i] + costs.low[i] % 2, costs.low[i] + len(costs.costs[i]), 2):
            if q >= 2 * kept and (total := before + costs.one(i, q)) <= best:
                ways = [*(ways if total == best else []), (p, kept, q)]
                best = total
    return best, min("D" * p + "K" * kept + costs.audit(p + kept, q) for p, kept, q in ways)


#: The states of the grammar: nothing yet, after s, after u, after a; where each leads by a symbol, and those that may end.
STEPS = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
STATES, ENDS = list(STEPS), ("", "a")


def walked(rows: bytes) -> tuple[int, str]:
    """The same through the grammar's states, in time proportional to the rows."""
    costs = np.empty((len(rows) + 1, len(STATES)), np.int64)
    at = {s: k for k, s in enumerate(STATES)}

    def closed(row: dict[str, int]) -> list[int]:
        """Costs with insertions before the next row, of which two lead back."""
        for _ in range(3):
            row = {s: min([c, *(row[t] + INSERT for sym, t in STEPS[s].items() if sym != "s")]) for s, c in row.items()}
        return [row[s] for s in STATES]

    costs[-1] = closed({s: 0 if s in ENDS else FAR for s in STATES})
    for i in range(len(rows) - 1, -1, -1):
        r, after = rows[i], costs[i + 1].tolist()
        row = {s: after[at[s]] + DELETE for s in STATES}
        if not r & MUST_GO:
            for s in STATES:
                for sym, t in STEPS[s].items():
                    own = INITIALS[r & 3] == sym
                    if own or sym != "s":
                        row[s] = min(row[s], after[at[t]] + (0 if own else REROLE) + (CUT if r & TRUNCATED else 0))
        costs[i] = closed(row)
    out, state, i = bytearray(), "", 0
    while True:
        left, step = int(costs[i][at[state]]), None
        if i == len(rows) and left == 0 and state in ENDS:
            return int(costs[0][0]), out.decode()
        r = rows[i] if i < len(rows) else MUST_GO
        if i < len(rows) and costs[i + 1][at[state]] + DELETE == left:
            step = ("D", state, 1)
        if not step:
            step = next((("I", t, 0) for sym, t in STEPS[state].items() if sym != "s" and costs[i][at[t]] + INSERT == left), None)
        if not step:
            cut = CUT if r & TRUNCATED else 0
            ways = [(INITIALS[r & 3] == sym, t) for sym, t in STEPS[state].items() if sym != "s" or INITIALS[r & 3] == "s"]
            step = min(("K" if own else "R", t, 1) for own, t in ways if costs[i + 1][at[t]] + cut + (0 if own else REROLE) == left)
        out += step[0].encode()
        state, i = step[1], i + step[2]


class Audits(dict):
    """Costs and audits by the rows' bytes; short conversations recur."""

    def __missing__(self, rows: bytes) -> tuple[int, str]:
        out = aligned(rows) if len(rows) <= LONG else walked(rows)
        if len(rows) <= 64 and len(self) < 1 << 18:
            self[rows] = out
        return out


def placed(turns: DataFrame) -> DataFrame:
    """``(conv_id, pos, turn, role, text, initial, fault)`` of ``turns(conv_id, turn, role, text, copy, gone)``: rows in order from 1, and their first fault.

    ``copy`` orders equal rows. Rows that are ``gone`` have no fault and stand for their conversation only. One shuffle by conversation serves both windows.
    """
    conv = Window.partitionBy("conv_id", "gone").orderBy(F.col("turn").asc_nulls_first(), "role", "text", "copy")
    same = Window.partitionBy("conv_id", "gone", "role", "text").orderBy("pos")
    rows = turns.withColumn("pos", F.row_number().over(conv).cast("long")).withColumn("nth", F.row_number().over(same))
    trimmed = F.regexp_extract("text", rf"(?s)([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    fault = F.when(trimmed == "", "blank").when(F.col("nth") > 1, "duplicate").when(~trimmed.isin(".", "!", "?"), "truncated")
    return rows.select("conv_id", "gone", "pos", "turn", "role", "text", F.left("role", F.lit(1)).alias("initial"), F.when(~F.col("gone"), fault).alias("fault"))


AUDIT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def audited(rows: DataFrame) -> DataFrame:
    """``AUDIT`` of placed rows: a row a conversation, those without rows included."""
    schema = arrow_schema("conv_id long, blank long, duplicate long, truncated long, illegal long, cost long, audit string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, conv, rows, counts, last, out = Audits(), None, bytearray(), {}, None, []

        def told() -> tuple:
            return (conv[0], *(counts.get(k, 0) for k in ("blank", "duplicate", "truncated", "illegal")), *known[bytes(rows)])

        for batch in batches:
            for conv_id, gone, initial, fault in zip(*(c.to_pylist() for c in batch.columns)):
                if conv != (conv_id,):
                    if conv:
                        out.append(told())
                    conv, rows, counts, last = (conv_id,), bytearray(), {}, None
                if gone:
                    continue
                if last is not None and last + initial not in ("su", "ua", "au"):
                    counts["illegal"] = counts.get("illegal", 0) + 1
                if fault:
                    counts[fault] = counts.get(fault, 0) + 1
                rows.append(code(initial, fault))
                last = initial
            yield batch_of(out, schema)
            out.clear()
        if conv:
            yield batch_of([told()], schema)

    narrow = rows.select("conv_id", "gone", "initial", "fault", "pos")
    streamed = narrow.repartition("conv_id").sortWithinPartitions("conv_id", "gone", "pos").drop("pos")
    found = streamed.mapInArrow(run, "conv_id long, blank long, duplicate long, truncated long, illegal long, cost long, audit string")
    at = F.when(~F.col("gone"), F.col("turn").cast("decimal(38,0)"))
    gaps = rows.groupBy("conv_id", at.alias("at")).agg(F.count("*").alias("n")).groupBy("conv_id").agg(F.coalesce(F.max("at") - F.min("at") + 1 - F.count("at"), F.lit(0)).try_cast("long").alias("gaps"))
    return found.join(gaps.withColumnRenamed("conv_id", "id"), F.col("conv_id").eqNullSafe(F.col("id"))).select(*(c.split()[0] for c in AUDIT.split(", ")))


def repaired_turns(audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """What the edits make of the rows."""
    want, started = "user", False
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(rows)
        if edit == "D":
            continue
        if edit == "K" and not started and role.startswith("s"):
            yield role, text
        else:
            yield (role if edit == "K" else want), text
            want = "assistant" if want == "user" else "user"
        started = True


def streamed_repairs(rows: DataFrame, audits: DataFrame, make, schema: str) -> DataFrame:
    """``make(conv_id, repaired turns)`` gives rows of ``schema`` for every conversation, whose turns are read as they come, behind its audit."""
    arrow = arrow_schema(schema)
    texts = rows.where("not gone").select("conv_id", "pos", "role", "text", F.lit(None).cast("string").alias("audit"))
    both = texts.unionByName(audits.select("conv_id", F.lit(0).cast("long").alias("pos"), F.lit("").alias("role"), F.lit("").alias("text"), "audit"))
    both = both.repartition("conv_id").sortWithinPartitions("conv_id", "pos").drop("pos")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines = (line for batch in batches for line in zip(*(c.to_pylist() for c in batch.columns)))
        out = []
        for conv_id, _, _, audit in lines:
            for row in make(conv_id, repaired_turns(audit, ((role, text) for _, role, text, _ in lines))):
                out.append(row)
                if len(out) >= 1024:
                    yield batch_of(out, arrow)
                    out = []
        yield batch_of(out, arrow)

    return both.mapInArrow(run, schema)


def turns_of(conv_id: int | None, turns: Iterator[tuple[str, str]]) -> Iterator[tuple]:
    for i, (role, text) in enumerate(turns):
        yield conv_id, i, role, text


def digest_of(conv_id: int | None, turns: Iterator[tuple[str, str]]) -> Iterator[tuple]:
    digest, between = sha256(), b""
    for role, text in turns:
        digest.update(between + f"{role}:{text}".encode("utf-8", "surrogatepass"))
        between = b"\n"
    yield conv_id, digest.hexdigest()


def as_turns(conversations: DataFrame) -> DataFrame:
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    return conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), empty("role"), empty("text"), F.lit(0).alias("copy"), F.lit(False).alias("gone"))


def repair(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The audits (``AUDIT``) and the repaired conversations ``(conv_id, turn, role, text)``, turns from 0."""
    scratch = Scratch(conversations.sparkSession, "turns")
    rows = scratch.write(placed(as_turns(conversations)))
    audits = scratch.write(audited(rows))
    return audits, streamed_repairs(rows, audits, turns_of, "conv_id long, turn long, role string, text string")


def damaged(conversations: DataFrame) -> DataFrame:
    """Turns with planted faults, told by the checksum of their place; a dropped one is ``gone``."""
    filled = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    own = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), filled("role").alias("role"), filled("text").alias("text"), (F.crc32(F.concat(filled("conv_id"), F.lit(":"), filled("turn")).cast("binary")) % 20).alias("fault"))
    gone = F.col("fault") == 0
    text = F.when(gone | (F.col("fault") == 1), "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("fault") == 4, "user").otherwise(F.col("role"))
    copies = F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return own.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("copy"), gone.alias("gone"))


def op11_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "turns")
    rows = scratch.write(placed(damaged(table(spark, sf_dir, "conversations"))))
    audits = scratch.write(audited(rows))
    digests = streamed_repairs(rows, audits, digest_of, "id long, repaired_sha256 string")
    return audits.join(digests, F.col("conv_id").eqNullSafe(F.col("id"))).drop("id")
