"""Repeated runs of a fixed length, brought down to anchors.

Every window of ``length`` units (words or bytes) has an anchor: of its grams of ``gram`` units the one with the
smallest hash, the leftmost of equal ones. Equal windows have their anchors at the same place, so windows that
repeat are found among equal anchors. Consecutive windows with one anchor make a slice, and a slice is one row:
about two in ``length - gram + 2`` units.

Hashes come from prefix sums of polynomial hashes modulo 2**64, over random 64-bit values of the units.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rainfold.llm.common import Scratch, arrow_schema, batch_of

BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
#: Units hashed at a time; longer texts are taken in chunks that overlap by a window.
CHUNK = 1 << 18
SLICES = "doc_id long, tie long, s0 long, more int, rel int, g long, h long"
_POWERS: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    have = _POWERS.get(int(base))
    if have is None or len(have) < n:
        have = np.full(max(n, 1 << 16), base, np.uint64)
        have[0] = 1
        have = _POWERS[int(base)] = np.cumprod(have, dtype=np.uint64)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def prefix_hashes(units: np.ndarray) -> np.ndarray:
    return np.concatenate((np.zeros(1, np.uint64), np.cumsum(units * powers(BASE, len(units)), dtype=np.uint64)))


def range_hash(prefix: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hashes of units[a:b], whatever their place."""
    return (prefix[b] - prefix[a]) * powers(INVERSE, len(prefix))[a]


def slices(units: np.ndarray, bounds: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(piece, first window, windows after it, anchor less first window, anchor's hash, slice's hash) of the
    slices of the pieces units[bounds[i]:bounds[i + 1]]."""
    n, width = len(units), length - gram + 1
    if n < length:
        return (np.empty(0, np.int64),) * 4 + (np.empty(0, np.uint64),) * 2
    prefix = prefix_hashes(units)
    every = np.arange(n - gram + 1)
    g = mix((prefix[gram:] - prefix[: n - gram + 1]) * powers(INVERSE, n + 1)[: n - gram + 1])
    least = (g & np.uint64(0xFFFFFFFF00000000)) | every.astype(np.uint64)
    span = 1
    while span * 2 <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    count = n - length + 1
    anchor = (np.minimum(least[:count], least[width - span : width - span + count]) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    piece = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    starts = np.flatnonzero(piece[:count] == piece[length - 1 :])
    if not len(starts):
        return (np.empty(0, np.int64),) * 4 + (np.empty(0, np.uint64),) * 2
    anchor = anchor[starts]
    first = np.concatenate(([0], np.flatnonzero(anchor[1:] != anchor[:-1]) + 1))
    last = np.concatenate((first[1:] - 1, [len(starts) - 1]))
    s0, s1, at = starts[first], starts[last], anchor[first]
    more, rel = s1 - s0, at - s0
    h = mix(range_hash(prefix, s0, s1 + length) + more.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + rel.astype(np.uint64) * np.uint64(0xA0761D6478BD642F))
    return piece[s0], s0 - bounds[piece[s0]], more, rel, g[at], h


def folded(units: np.ndarray, bounds: np.ndarray, found: tuple[np.ndarray, ...], length: int) -> tuple[np.ndarray, np.ndarray]:
    """Which slices to keep, and how many like it follow each: in a stretch that repeats itself every p units, every slice is the one p units before.

    Equal slices that follow each other are compared unit by unit, so those left out hold nothing but windows of the one kept. A text of one character, all of whose windows are slices of
    their own, then has a few.
    """
    piece, s0, more, rel, g, h = found
    like = np.zeros(len(s0), bool)
    like[1:] = (piece[1:] == piece[:-1]) & (g[1:] == g[:-1]) & (h[1:] == h[:-1]) & (more[1:] == more[:-1]) & (rel[1:] == rel[:-1]) & (s0[1:] == s0[:-1] + more[:-1] + 1)
    after = np.zeros(len(s0), np.int64)
    edges = np.flatnonzero(np.diff(np.concatenate((like.astype(np.int8), [0]))))
    first = 0 if not len(s0) or not like[0] else -1
    for a, b in zip(edges[first::2].tolist(), edges[first + 1 :: 2].tolist()):
        start, period = bounds[piece[a]] + s0[a], more[a] + 1
        end = start + (b - a + 1) * period - 1 + length
        if np.array_equal(units[start : end - period], units[start + period : end]):
            after[a] = b - a
        else:
            like[a + 1 : b + 1] = False
    return ~like, after


def anchored(docs: DataFrame, units_of: Callable[[str | None], np.ndarray], length: int, gram: int, fold: bool = False) -> DataFrame:
    """SLICES of every row of ``docs(doc_id, tie, text)``, over whole texts, and ``after``, with ``fold`` how many slices like it follow one and are left out."""

    schema = f"{SLICES}, after long"
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, int, np.ndarray]] = []
        size = 0

        def hashed() -> pa.RecordBatch:
            bounds = np.concatenate(([0], np.cumsum([len(u) for *_, u in held])))
            units = np.concatenate([u for *_, u in held])
            found = slices(units, bounds, length, gram)
            keep, after = folded(units, bounds, found, length) if fold else (slice(None), np.zeros(len(found[0]), np.int64))
            piece, s0, more, rel, g, h = (c[keep] for c in found)
            ids, ties, bases = (np.array([x[i] for x in held], np.int64)[piece] for i in range(3))
            held.clear()
            columns = (ids, ties, s0 + bases, more.astype(np.int32), rel.astype(np.int32), g.view(np.int64), h.view(np.int64), after[keep])
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=arrow)

        for batch in batches:
            for doc_id, tie, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                units = units_of(text.as_py())
                for base in range(0, max(1, len(units) - length + 1), CHUNK):
                    part = units[base : base + CHUNK + length - 1]
                    held.append((doc_id, tie, base, part))
                    size += len(part)
                    if size >= CHUNK:
                        yield hashed()
                        size = 0
        if held:
            yield hashed()

    return docs.select("doc_id", "tie", "text").mapInArrow(run, schema)


#: Stands for a null doc_id, which comes last.
LAST = (1 << 63) - 1
KEY = ["doc_id", "tie"]


def keyed(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """``(doc_id, tie, text, n)`` of ``docs(doc_id, text)``: its texts under keys of their own.

    ``tie`` is 0, and for rows without doc_id or that share one a hash of the text; ``n`` rows are equal, and have one key.
    """
    docs = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    shared = scratch.write(docs.groupBy("doc_id").agg(F.count("*").alias("n")).where(f"n > 1 or doc_id = {LAST}").select("doc_id"))
    one = docs.withColumns({"tie": F.lit(0).cast("long"), "n": F.lit(1).cast("long")}).select(*KEY, "text", "n")
    if shared.isEmpty():
        return one
    tied = docs.join(shared, "doc_id", "left_semi").withColumn("tie", F.xxhash64("text"))
    return one.join(shared, "doc_id", "left_anti").unionByName(scratch.write(tied.groupBy(*KEY).agg(F.min("text").alias("text"), F.count("*").alias("n"))))


def candidates(docs: DataFrame, units_of: Callable[[str | None], np.ndarray], length: int, gram: int, scratch: Scratch, fold: bool = False) -> DataFrame:
    """The slices whose anchor occurs more than once, those left out included. Both sides of the join are as they come from the shuffle, so that a hot anchor can be split."""
    often = scratch.write(anchored(docs, units_of, length, gram, fold).groupBy("g").agg(F.sum(F.col("after") + 1).alias("n")).where("n > 1").select("g"))
    found = scratch.write(anchored(docs, units_of, length, gram, fold).join(often, "g"))
    scratch.drop(often)
    return found


def cut(docs: DataFrame, wanted: DataFrame, fields: str, piece: Callable[[str, list[tuple]], Iterable[tuple]], schema: str) -> DataFrame:
    """For each document of ``wanted(doc_id, tie, fields)`` its key and the rows of ``schema`` that ``piece(text, rows of fields)`` makes.

    Only the rows of one document are gathered, as many as it has slices at most.
    """
    names = [f.split()[0] for f in fields.split(", ")]
    by_doc = wanted.groupBy(*KEY).agg(F.collect_list(F.struct(*names)).alias("wanted"))
    full = f"doc_id long, tie long, {schema}"
    arrow = arrow_schema(full)
    joined = docs.join(by_doc, KEY).select(*KEY, "text", "wanted")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for at in range(batch.num_rows):
                doc_id, tie, text, want = (c[0] for c in batch.slice(at, 1).to_pydict().values())
                rows += [(doc_id, tie, *got) for got in piece(text, [tuple(w.values()) for w in want])]
                if len(rows) > 4096:
                    yield batch_of(rows, arrow)
                    rows = []
            yield batch_of(rows, arrow)

    return joined.mapInArrow(run, full)


def windows(docs: DataFrame, wanted: DataFrame, units_of: Callable[[str], np.ndarray], length: int) -> DataFrame:
    """``(w, doc_id, tie, a)``: the hashes of the windows of the slices ``wanted(doc_id, tie, s0, more)``, whose texts are hashed once."""
    by_doc = wanted.groupBy(*KEY).agg(F.collect_list(F.struct("s0", F.col("more").cast("long").alias("more"))).alias("wanted"))
    schema = "w long, doc_id long, tie long, a long"
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                parts = []
                for doc_id, tie, text, own in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(2), part.column(3)):
                    s0, more = (own.values.field(k).to_numpy() for k in range(2))
                    count = more + 1
                    ends = np.cumsum(count)
                    starts = np.arange(ends[-1]) + np.repeat(s0 - (ends - count), count)
                    prefix = prefix_hashes(units_of(text.as_py()))
                    parts.append((mix(range_hash(prefix, starts, starts + length)).view(np.int64), np.full(len(starts), doc_id), np.full(len(starts), tie), starts))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*parts)], schema=arrow)

    return docs.join(by_doc, KEY).select(*KEY, "text", "wanted").mapInArrow(run, schema)


def lines(pieces: DataFrame, *by: str) -> DataFrame:
    """Pieces ``(doc_id, tie, a, b, from_doc, from_tie, from_a)``, the units a to b of a text being those from from_a of another one,
    joined where they overlap or touch alike in both."""
    same = Window.partitionBy(*KEY, "from_doc", "from_tie", "shift", *by)
    pieces = pieces.withColumn("shift", F.col("a") - F.col("from_a"))
    before = F.max("b").over(same.orderBy("a", "b").rowsBetween(Window.unboundedPreceding, -1))
    pieces = pieces.withColumn("new", F.when(before >= F.col("a"), 0).otherwise(1))
    pieces = pieces.withColumn("line", F.sum("new").over(same.orderBy("a", "b").rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    joined = pieces.groupBy(*KEY, "from_doc", "from_tie", "shift", *by, "line").agg(F.min("a").alias("a"), F.max("b").alias("b"))
    return joined.select(*KEY, "a", "b", "from_doc", "from_tie", (F.col("a") - F.col("shift")).alias("from_a"), *by)


def with_source(joined: DataFrame, docs: DataFrame, piece: Callable[[str, list[tuple]], Iterable[tuple]], schema: str) -> DataFrame:
    """Lines with what ``piece`` cuts out of the text that they come from, as ``(s0, units, columns of schema)``."""
    wanted = joined.select(F.col("from_doc").alias("doc_id"), F.col("from_tie").alias("tie"), F.col("from_a").alias("s0"), (F.col("b") - F.col("a")).alias("units")).distinct()
    held = cut(docs, wanted, "s0 long, units long", piece, f"s0 long, units long, {schema}").withColumnsRenamed({"doc_id": "from_doc", "tie": "from_tie", "s0": "from_a"})
    return joined.withColumn("units", F.col("b") - F.col("a")).join(held, ["from_doc", "from_tie", "from_a", "units"])
