"""Substring dedup of byte strings by a hash-compared suffix sort.

A byte goes where it is covered by a ``LENGTH``-byte string that also starts anywhere else, in the same document or
another.

1. Candidates. Slices of windows (see ``winnow``) whose anchor recurs. A slice that recurs as a whole, told by the hashes of anchor and
   slice, repeats another occurrence of it. Such repeats are joined where they continue each other, and the bytes that they
   come from are sent to the documents and compared, so nothing goes because of a hash alone.
   A stretch of a document that repeats itself after fewer bytes than a window has (padding, rules, runs of one character) is told while the text is hashed, byte by byte: it is
   one span, and one of its slices stands for all.
2. Blocks. Where an anchor has slices of different bytes, one of each kind is laid over a grid of ``BLOCKS[0]`` starts around its
   anchor. All windows of a block share its core, the bytes common to them, so only blocks whose core recurs go on, dealt out by core.
   A core with over ``GROUP`` blocks is laid over finer grids; blocks of one window that are still as many are the
   same window, and are dealt out in groups that hold the first of them.
3. Suffix sort. The suffixes of a core's blocks are merge-sorted. Two suffixes are compared by a
   binary search for their common extension over prefix polynomial hashes, so a comparison is logarithmic in the length.
   Neighbours that agree in LENGTH bytes, checked byte by byte, are repeats.

Passages of PASSAGE words can have fewer than LENGTH bytes. They stay, but are told of if that is asked for: a document's words are counted that lie in a passage of as many words, whatever
stands between them, which also starts earlier (a smaller doc_id, or the same document and an earlier start). Candidates are slices of words; windows of mixed ones
are counted by hash. These counts rest on 64-bit hashes, as nothing goes by them.

Nulls: a null text is empty. Rows that share a doc_id, or have none, are documents of their own; equal rows repeat each
other. Other columns of the input are left alone. A text of any length that a row can hold is hashed in chunks of bounded size; what is gathered for it is at most
a few times its bytes. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rainfold.llm.common import Scratch, arrow_schema, batch_of, table
from rainfold.llm.winnow import CHUNK, KEY, LAST, candidates, cut, keyed, lines, mix, prefix_hashes, range_hash, windows, with_source

LENGTH, GRAM = 400, 32
#: Words of a passage that is told of though it may be too short to go, and of its grams.
PASSAGE, WORDS = 51, 8
#: Starts in a block, each a multiple of the next; blocks of a core that one task may gather, and blocks sorted at a time.
BLOCKS, GROUP, TOGETHER = (64, 8, 1), 4096, 256
VALUES = np.random.default_rng(9).integers(0, 1 << 64, 256, np.uint64)
GAPS = bytes(b in b" \t\n\v\f\r" for b in range(256))


def raw(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


def byte_units(text: str) -> np.ndarray:
    return VALUES[np.frombuffer(raw(text), np.uint8)]


def word_units(text: str) -> np.ndarray:
    whole = raw(text)
    gap = np.frombuffer(b"\1" + whole.translate(GAPS) + b"\1", np.bool_)
    edges = np.flatnonzero(gap[1:] != gap[:-1])
    data, starts, ends = np.frombuffer(whole, np.uint8), edges[::2], edges[1::2]
    if len(data) <= CHUNK:
        return mix(range_hash(prefix_hashes(VALUES[data]), starts, ends))
    out, i = [np.empty(0, np.uint64)], 0
    while i < len(starts):
        at, j = starts[i], max(i + 1, int(np.searchsorted(ends, starts[i] + CHUNK, "right")))
        out.append(mix(range_hash(prefix_hashes(VALUES[data[at : ends[j - 1]]]), starts[i:j] - at, ends[i:j] - at)))
        i = j
    return np.concatenate(out)


def slice_bytes(text: str, wanted: list[tuple[int, int]]) -> list[tuple]:
    whole = raw(text)
    return [(a, n, whole[a : a + n]) for a, n in wanted]


def common_extension(prefix: np.ndarray, a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """Length of the longest common prefix of the suffixes at ``a`` and ``b``, at most ``most``, by binary search."""
    low, high = np.zeros(len(a), np.int64), np.full(len(a), most, np.int64)
    for _ in range(most.bit_length()):
        mid = (low + high + 1) // 2
        same = range_hash(prefix, a, a + mid) == range_hash(prefix, b, b + mid)
        low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
    return low


def suffix_order(data: np.ndarray, starts: np.ndarray, groups: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes at ``starts`` by their first ``length`` bytes within each group (``groups`` ascends), and the prefix hashes.

    Bottom-up merge sort of all groups at once. To merge two runs, each element's rank in the other run is found by
    binary search; the first eight bytes decide most comparisons, common extensions the others.
    """
    prefix = prefix_hashes(VALUES[data])
    padded = np.concatenate((data, np.zeros(8, np.uint8))).astype(np.uint64)
    head = np.zeros(len(data), np.uint64)
    for i in range(8):
        head = head << np.uint64(8) | padded[i : i + len(data)]
    ends = np.append(np.flatnonzero(groups[1:] != groups[:-1]) + 1, len(groups))
    begins = np.concatenate(([0], ends[:-1]))
    which = np.repeat(np.arange(len(ends)), ends - begins)
    begin, end = begins[which], ends[which]
    order = np.arange(len(starts))
    here = np.arange(len(starts))

    def before(a: np.ndarray, b: np.ndarray, or_equal: np.ndarray) -> np.ndarray:
        """Whether suffix a comes before suffix b, or is equal where that is asked for."""
        p, q = starts[a], starts[b]
        x, y = head[p], head[q]
        out = x < y
        if len(tie := np.flatnonzero(x == y)):
            p, q = p[tie], q[tie]
            n = common_extension(prefix, p, q, length)
            at = np.minimum(n, length - 1)
            out[tie] = np.where(n == length, or_equal[tie], data[p + at] < data[q + at])
        return out

    width = 1
    while width < (ends - begins).max(initial=0):
        run = (here - begin) // width
        own = begin + run * width
        left = run % 2 == 0
        low = np.minimum(np.where(left, own + width, own - width), end)
        other, high = low, np.minimum(low + width, end)
        low, high = low.copy(), np.where(left, high, own)
        while len(open_ := np.flatnonzero(low < high)):
            mid = (low[open_] + high[open_]) // 2
            # An element of the left run comes before equal ones of the right run.
            less = before(order[mid], order[open_], ~left[open_])
            low[open_] = np.where(less, mid + 1, low[open_])
            high[open_] = np.where(less, high[open_], mid)
        to = np.where(left, here + (low - other), np.minimum(own, other) + (here - own) + (low - other))
        merged = np.empty_like(order)
        merged[to] = order
        order = merged
        width *= 2
    return order, prefix


def repeats(blocks: list[tuple], length: int) -> list[tuple[int, int, int, int]]:
    """(doc_id, tie, start, end) of the windows that repeat among (group, doc_id, tie, start, windows, bytes) sorted by group."""
    data = np.frombuffer(b"".join(b[-1] for b in blocks), np.uint8)
    sizes = np.array([len(b[-1]) for b in blocks])
    bounds = np.cumsum(sizes) - sizes
    counts = np.array([b[-2] for b in blocks])
    block = np.repeat(np.arange(len(blocks)), counts)
    shift = np.arange(len(block)) - np.repeat(np.cumsum(counts) - counts, counts)
    starts = bounds[block] + shift
    group = np.cumsum([0, *(x[0] != y[0] for x, y in zip(blocks, blocks[1:]))])
    order, prefix = suffix_order(data, starts, group[block], length)
    a, b = order[:-1], order[1:]
    at = np.flatnonzero((group[block[a]] == group[block[b]]) & (common_extension(prefix, starts[a], starts[b], length) == length))
    a, b = a[at], b[at]
    windows = np.lib.stride_tricks.sliding_window_view(data, length)
    hit = np.zeros(len(starts), bool)
    for i in range(0, len(a), 4096):
        p, q = a[i : i + 4096], b[i : i + 4096]
        real = (windows[starts[p]] == windows[starts[q]]).all(axis=1)
        hit[p[real]] = hit[q[real]] = True
    found = [(*blocks[i][1:3], blocks[i][3] + int(k)) for i, k in zip(block[hit].tolist(), shift[hit])]
    return runs([(*w, w[2] + length) for w in found])


def runs(spans: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """The spans (doc_id, tie, start, end), joined where they overlap or touch."""
    out: list[list[int]] = []
    for doc_id, tie, start, end in sorted(spans):
        if out and out[-1][:2] == [doc_id, tie] and start <= out[-1][3]:
            out[-1][3] = max(out[-1][3], end)
        else:
            out.append([doc_id, tie, start, end])
    return [tuple(x) for x in out]


def blocks_of(length: int, block: int):
    """(core, start, windows, distance of the first one before the anchor) of the blocks that slices (start, windows, distance) make."""

    def of(text: str, wanted: list[tuple[int, int, int]]) -> Iterator[tuple]:
        whole = raw(text)
        for start, n, d in wanted:
            for k in range((d - n + 1) // block, d // block + 1):
                # Windows start + early to start + late, of which the slice has those from a to b.
                late, early = d - k * block, d - k * block - block + 1
                a, b = max(0, early), min(n - 1, late)
                core = xxhash.xxh3_64_intdigest(whole[start + late : start + early + length] + b"%d" % k)
                yield core - (1 << 64) if core >> 63 else core, start + a, b - a + 1, d - a

    return of


def block_bytes(length: int):
    def of(text: str, wanted: list[tuple]) -> Iterator[tuple]:
        whole = raw(text)
        for *group, a, windows in wanted:
            yield *group, a, windows, whole[a : a + windows - 1 + length]

    return of


def sorted_repeats(length: int):
    schema = arrow_schema("doc_id long, tie long, a long, b long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for core, part, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if len(held) >= TOGETHER and (core, part) != held[-1][0]:
                    yield batch_of(repeats(held, length), schema)
                    held = []
                held.append(((core, part), *row))
        if held:
            yield batch_of(repeats(held, length), schema)

    return run


def sorted_spans(docs: DataFrame, slices: DataFrame, scratch: Scratch, length: int) -> DataFrame:
    """``(doc_id, tie, a, b)``: repeats among windows of the slices ``(doc_id, tie, a, windows, d)``."""
    parts, place = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))), F.struct(*KEY, "a")
    chosen = None
    grids = [b for b in BLOCKS if b == 1 or b <= length // 6]
    for block in grids:
        cores = scratch.write(cut(docs, slices, "a long, windows int, d int", blocks_of(length, block), "core long, a long, windows int, d int"))
        often = scratch.write(cores.groupBy("core").agg(F.count("*").alias("n"), F.min(place).alias("first")).where("n > 1"))
        shared = cores.join(often, "core")
        last = block == 1 or often.where(F.col("n") > GROUP).isEmpty()
        few = shared if last else shared.where(F.col("n") <= GROUP)
        of = F.when(F.col("n") > GROUP, F.ceil(F.col("n") / GROUP)).otherwise(1)
        own = F.when(place == F.col("first"), F.sequence(F.lit(0).cast("long"), of - 1)).otherwise(F.array(F.pmod(F.xxhash64(*KEY, "a"), of)))
        few = few.withColumn("part", F.explode(own)).select("core", "part", *KEY, "a", "windows")
        chosen = few if chosen is None else chosen.union(few)
        if last:
            break
        slices = shared.where(F.col("n") > GROUP)
    schema = "core long, part long, a long, windows int, bytes binary"
    blocks = cut(docs, chosen, "core long, part long, a long, windows int", block_bytes(length), schema).select("core", "part", *KEY, "a", "windows", "bytes")
    return blocks.repartition(parts, "core", "part").sortWithinPartitions("core", "part", *KEY, "a").mapInArrow(sorted_repeats(length), "doc_id long, tie long, a long, b long")


def repeated_spans(docs: DataFrame, scratch: Scratch, length: int, gram: int) -> DataFrame:
    """``(doc_id, tie, a, b, bytes)``: byte ranges to remove, if they hold ``bytes`` or that is null."""
    found = candidates(docs, byte_units, length, gram, scratch, fold=True)
    period = F.col("more") + 1
    periodic = scratch.write(found.where("after > 0").select(*KEY, F.col("s0").alias("a"), (F.col("s0") + (F.col("after") + 1) * period - 1 + length).alias("b")))
    place = F.struct(*KEY, "s0")
    kinds = scratch.write(found.groupBy("g", "h").agg(F.min(place).alias("first"), F.max(place).alias("last"), F.first("more").alias("more"), F.first("rel").alias("rel")))
    several = scratch.write(kinds.groupBy("g").agg(F.count("*").alias("kinds")).where("kinds > 1").select("g"))
    whole = found.join(kinds.where("first <> last").select("g", "h", "first", "last"), ["g", "h"]).withColumn("other", F.when(place == F.col("first"), F.col("last")).otherwise(F.col("first")))
    whole = whole.select(*KEY, F.col("s0").alias("a"), (F.col("s0") + F.col("more") + length).alias("b"), F.col("other.doc_id").alias("from_doc"), F.col("other.tie").alias("from_tie"), F.col("other.s0").alias("from_a"))
    joined = scratch.write(lines(whole))
    mixed = kinds.join(several, "g").select("first.doc_id", "first.tie", F.col("first.s0").alias("a"), (F.col("more") + 1).alias("windows"), F.col("rel").alias("d"))
    spans = scratch.write(sorted_spans(docs, mixed, scratch, length))
    scratch.drop(found, kinds, several)
    whole = with_source(joined, docs, slice_bytes, "bytes binary").select(*KEY, "a", "b", "bytes")
    return whole.unionByName(spans.union(periodic).withColumn("bytes", F.lit(None).cast("binary")))


def covered(a: np.ndarray, b: np.ndarray) -> int:
    """How many places the spans a to b cover."""
    order = np.argsort(a)
    a, top = a[order], np.maximum.accumulate(b[order])
    return int((top - np.maximum(a, np.concatenate((a[:1], top[:-1])))).sum())


def later_words(docs: DataFrame, scratch: Scratch, length: int, gram: int) -> DataFrame:
    """``(doc_id, tie, later)``: the words of a document in passages of ``length`` words that also start earlier, if there are any."""
    found = candidates(docs, word_units, length, gram, scratch, fold=True)
    place, at, period = F.struct(*KEY, "s0"), F.struct(*KEY, "a"), F.col("more") + 1
    span = lambda a, b: (*KEY, a.alias("a"), b.alias("b"))
    folded = found.where("after > 0").select(*span(F.col("s0") + period, F.col("s0") + (F.col("after") + 1) * period - 1 + length))
    kinds = scratch.write(found.groupBy("g", "h").agg(F.min(place).alias("first"), (F.min(place) != F.max(place)).alias("recurs"), F.first("more").alias("more")))
    several = scratch.write(kinds.groupBy("g").agg(F.count("*").alias("kinds")).where("kinds > 1").select("g"))
    whole = found.join(kinds.where("recurs").select("g", "h", "first"), ["g", "h"]).where(place != F.col("first")).select(*span(F.col("s0"), F.col("s0") + F.col("more") + length))
    # The first slice of a kind holds the first of its windows, so one slice of each kind will do.
    each = scratch.write(windows(docs, kinds.join(several, "g").select("first.*", "more"), word_units, length))
    often = scratch.write(each.groupBy("w").agg(F.min(at).alias("first"), F.max(at).alias("last")).where("first <> last").select("w", "first"))
    later = each.join(often, "w").where(at != F.col("first")).select(*span(F.col("a"), F.col("a") + length))
    schema = "doc_id long, tie long, later long"
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, ties, a, b = batch.columns
            yield batch_of([(i.as_py(), t.as_py(), covered(x.values.to_numpy(), y.values.to_numpy())) for i, t, x, y in zip(ids, ties, a, b)], arrow)

    told = scratch.write(whole.union(folded).union(later).groupBy(*KEY).agg(F.collect_list("a").alias("a"), F.collect_list("b").alias("b")).mapInArrow(run, schema))
    scratch.drop(found, kinds, several, each, often)
    return told


def confirmed(data: bytes, spans: list[dict], length: int) -> list[tuple[int, int]]:
    """The spans (a, b) of ``data``; of those that come with other bytes than it has there, the runs of LENGTH or more equal bytes."""
    out = []
    for a, b, own in ((s["a"], s["b"], s["bytes"]) for s in spans):
        if own is None or data[a:b] == own:
            out.append((a, b))
            continue
        same = np.frombuffer(data[a:b], np.uint8) == np.frombuffer(own, np.uint8)
        edges = np.flatnonzero(np.diff(np.concatenate(([0], same.astype(np.int8), [0]))))
        out += [(a + x, a + y) for x, y in zip(edges[::2].tolist(), edges[1::2].tolist()) if y - x >= length]
    return out


def without(docs: DataFrame, spans: DataFrame, length: int, told: DataFrame | None = None, passage: int = 0) -> DataFrame:
    """The result for every row that ``docs(doc_id, tie, text, n)`` stands for, with the passages ``told`` of if there are such."""
    own = spans.groupBy(*KEY).agg(F.collect_list(F.struct("a", "b", "bytes")).alias("spans"))
    ddl = "doc_id long, n long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary" + ", n_passage_words long" * (told is not None)
    schema = arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = []
                for doc_id, text, n, spans, *later in zip(*(c.to_pylist() for c in batch.slice(at, 256).columns)):
                    data, kept, end = raw(text), [], 0
                    gone = confirmed(data, spans or [], length)
                    if n > 1 and len(data) >= length:
                        gone.append((0, len(data)))
                    gone = runs([(0, 0, a, b) for a, b in gone])
                    for *_, a, b in gone:
                        kept.append(data[end:a])
                        end = b
                    rest = b"".join([*kept, data[end:]])
                    row = (len(data), len(data) - len(rest), len(gone), sha256(rest).hexdigest(), rest)
                    if later and n > 1:  # equal rows repeat the first one
                        words = len(data.split())
                        rows += [(doc_id, 1, *row, *later), (doc_id, n - 1, *row, words if words >= passage else 0)]
                    else:
                        rows.append((doc_id, n, *row, *later))
                yield batch_of(rows, schema)

    out = docs.join(own, KEY, "left")
    if told is not None:
        out = out.join(told, KEY, "left").withColumn("later", F.coalesce("later", F.lit(0)))
    out = out.select("doc_id", "text", "n", "spans", *["later"] * (told is not None)).mapInArrow(run, ddl)
    return out.withColumn("n", F.explode(F.sequence(F.lit(1).cast("long"), "n"))).drop("n")


def dedup(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, passage: int | None = None, words: int = WORDS) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept)``; ``kept`` is the bytes that stay. With ``passage`` also ``n_passage_words``, the words in passages of as many
    words that also start earlier; nothing is removed for them."""
    scratch = Scratch(docs.sparkSession, "suffixes")
    docs = keyed(docs, scratch)
    spans = repeated_spans(docs, scratch, length, gram)
    out = without(docs, spans, length, later_words(docs, scratch, passage, words) if passage else None, passage)
    return out.withColumn("doc_id", F.when(F.col("doc_id") < LAST, F.col("doc_id")))


def op9_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(table(spark, sf_dir, "documents"), passage=PASSAGE).drop("kept")
