"""SimHash near-duplicates, linked through deletion-variant signatures.

A 64-bit fingerprint is cut into ``max_bits // 2 + 1`` segments, so of two fingerprints that differ in at
most ``max_bits`` bits one segment differs by at most one. Each segment is indexed once for every bit of it,
with that bit wildcarded; an equality join on (bit, rest of the segment) then meets every such pair, and the
pairs are verified by counting the bits that differ.

Only distinct fingerprints are indexed. A bucket of two gives its pair from one aggregation; buckets of up to
``BUCKET`` fingerprints give their pairs; fingerprints of larger buckets get signatures with ``max_bits`` bits
wildcarded over the whole width, where equal signatures mean a distance within the bound, so each is linked to
the smallest of its signature instead of to all others. No link is lost and no group is expanded into all pairs.

Nulls: a null text has no words. Its fingerprint is zero, as is that of an empty one. A null doc_id is never the
smallest of a component. Repeated rows stay repeated. A text of any length is hashed as a whole. Other columns are left alone, whatever their names. An empty table gives
an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rainfold.llm.common import Scratch, arrow_schema, components, per_text, table, words_of

#: Above this many distinct fingerprints a bucket is linked by full-width signatures, of which a fingerprint has 2016 at two bits.
BUCKET = 128
#: Shingle hashes held at once; in how many of every STRIDE-th set a shingle is frequent, and how many of those the prefixes put last.
AT_ONCE, FREQUENT, STRIDE, OFTEN = 1 << 16, 2, 8, 1 << 20
#: Bits of the sketches by which pairs are told apart before their sets are compared.
SKETCH = 512


def shingle_hashes(words: list[bytes], n: int, seed: int) -> np.ndarray:
    """XXH64 of each run of ``n`` words joined by spaces, repeats included; of all words if there are fewer."""
    if not words:
        return np.empty(0, np.uint64)
    buffer = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = min(n, len(words))
    digest = xxhash.xxh64_digest
    raw = b"".join([digest(buffer[a:b], seed) for a, b in zip(starts[: len(words) - n + 1].tolist(), ends[n - 1 :].tolist())])
    return np.frombuffer(raw, dtype=">u8").astype(np.uint64)


def fold(hashes: np.ndarray) -> int:
    """The fingerprint: a bit is 1 if it is set in over half of the hashes."""
    if not len(hashes):
        return 0
    total = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65536):
        part = hashes[at : at + 65536].astype(">u8").view(np.uint8).reshape(-1, 8)
        total += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(total * 2 > len(hashes)).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, words: int = 3, seed: int = 42, distinct: bool = False) -> DataFrame:
    """``(doc_id, fp)`` with the fingerprint as a signed long. ``distinct``: each shingle counts once."""

    def run(ids: list, texts: list) -> dict:
        out = []
        for text in texts:
            h = shingle_hashes((text or "").encode("utf-8", "surrogatepass").lower().split(), words, seed)
            out.append(fold(np.unique(h) if distinct else h))
        return {"doc_id": ids, "fp": out}

    return per_text(docs, run, "doc_id long, fp long")


def segments(max_bits: int) -> list[tuple[int, int]]:
    """(first bit, width) of the segments."""
    n = max_bits // 2 + 1
    cuts = [64 * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def variants(fps: DataFrame, max_bits: int) -> DataFrame:
    """64 rows a fingerprint: its one-wildcard segment variants as ``(key, fp)``."""
    parts = []
    for first, width in segments(max_bits):
        value = F.shiftrightunsigned("fp", first).bitwiseAND(F.lit((1 << width) - 1).cast("long"))
        parts += [(F.lit(first + i).cast("long") * F.lit(1 << 40)).bitwiseOR(value.bitwiseAND(F.lit(~(1 << i)).cast("long"))) for i in range(width)]
    return fps.select("*", F.explode(F.array(*parts)).alias("key"))


def near(max_bits: int):
    return F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits


def links(fps: DataFrame, max_bits: int, scratch: Scratch) -> DataFrame:
    """Edges ``(a, b)`` that connect exactly what fingerprints at ``max_bits`` or fewer differing bits connect."""
    parts = max(1, int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    index = variants(fps.repartition(parts, "fp"), max_bits)  # 64 times the rows: not by the few tasks that read a small table
    buckets = scratch.write(index.groupBy("key").agg(F.count("*").alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b")).where("n > 1"))
    firsts = [first for first, _ in segments(max_bits)]
    is_first = F.shiftright("key", 40).isin(firsts)
    side = lambda fp: F.expr(f"shiftrightunsigned({fp}, cast(key >> 40 as int)) & 1")
    two = buckets.where("n = 2").where(is_first | (side("a") != side("b"))).select("a", "b").where(near(max_bits))
    large = scratch.write(buckets.where("n > 2").select("key", "n"))
    members = scratch.write(index.join(scratch.sized(large), "key"))
    few = members.where(F.col("n") <= BUCKET).groupBy("key").agg(F.collect_list("fp").alias("all"))
    # Equal segments meet in every bucket of the segment, and count in its first; those that differ in the bucket's bit only here.
    few = few.withColumn("first", is_first).select("key", "first", "all", F.explode("all").alias("a"))
    partner = f"(y > a) and (first or ((shiftrightunsigned(a ^ y, cast(key >> 40 as int)) & 1) = 1)) and bit_count(a ^ y) <= {max_bits}"
    few = few.select("a", F.explode(F.expr(f"filter(all, y -> {partner})")).alias("b"))
    hot = scratch.write(members.where(F.col("n") > BUCKET).select("fp").distinct())
    out = two.union(few)
    if not hot.isEmpty():
        out = out.union(starred(hot, max_bits))
    return out.distinct()


def starred(fps: DataFrame, max_bits: int) -> DataFrame:
    """Edges to the smallest fingerprint of each signature with ``max_bits`` of the 64 bits wildcarded; equal signatures are near."""
    signed = fps.repartition(max(1, int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))), "fp").select("fp", F.lit(-1).alias("i"), F.lit(0).cast("long").alias("mask"))
    for left in reversed(range(max_bits)):
        signed = signed.select("fp", "mask", F.explode(F.sequence(F.col("i") + 1, F.lit(63 - left))).alias("i"))
        signed = signed.select("fp", "i", F.expr("mask | shiftleft(1L, i)").alias("mask"))
    signed = signed.select("fp", "mask", F.expr("fp & ~mask").alias("rest"))
    least = signed.groupBy("mask", "rest").agg(F.min("fp").alias("a"), F.count("*").alias("n")).where("n > 1").select("mask", "rest", "a")
    return signed.join(least, ["mask", "rest"]).select("a", F.col("fp").alias("b")).where("a <> b")


def near_duplicates(docs: DataFrame, words: int = 3, max_bits: int = 2, seed: int = 42) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` for every row of ``docs(doc_id, text)``; see the module for ties and nulls.

    ``component_id`` is the smallest doc_id reachable over links of at most ``max_bits`` differing bits.
    """
    scratch = Scratch(docs.sparkSession, "simhash")
    marked = scratch.write(fingerprints(docs, words, seed))
    fps = scratch.write(marked.groupBy("fp").agg(F.min("doc_id").alias("low")))
    roots = scratch.write(components(links(fps.select("fp"), max_bits, scratch), scratch))
    grouped = fps.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    least = grouped.groupBy("root").agg(F.min("low").alias("component_id"))
    named = scratch.write(grouped.join(least, "root").select("fp", "component_id"))
    return marked.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def shingled(docs: DataFrame, words: int, keep: Callable[[np.ndarray, np.ndarray], tuple], schema: str) -> DataFrame:
    """``keep(sizes, sets)`` of the texts' sets of shingle hashes, one after the other and each ascending, some texts at a time.

    It returns the columns of ``schema`` after the first, which is the first of ``docs(.., text)``, and how many rows each text has.
    """
    arrow = arrow_schema(schema)

    def made(nodes: list, sets: list) -> pa.RecordBatch:
        columns, rows = keep(np.array([len(s) for s in sets], np.int64), np.concatenate(sets))
        return pa.RecordBatch.from_arrays([pa.array(np.repeat(nodes, rows), arrow[0].type), *(pa.array(c, f.type) for c, f in zip(columns, list(arrow)[1:]))], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, sets, size = [], [], 0
            for node, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                nodes.append(node)
                sets.append(shingle_set(text.as_py(), words))
                size += len(sets[-1])
                if size >= AT_ONCE:
                    yield made(nodes, sets)
                    nodes, sets, size = [], [], 0
            if nodes:
                yield made(nodes, sets)

    return docs.mapInArrow(run, schema)


def shingle_set(text: str | None, words: int) -> np.ndarray:
    return np.unique(shingle_hashes(words_of(text), words, 7))


def row_key(docs: DataFrame) -> list[Column]:
    """128 bits that tell rows apart by all their columns; rows with the same ones are equal."""
    columns = [F.to_json(F.struct(F.col(f"`{f.name}`"))) if "map<" in f.dataType.simpleString() else F.col(f"`{f.name}`") for f in docs.schema]
    return [F.xxhash64(F.lit(i), *columns).alias(c) for i, c in enumerate(("row_a", "row_b"))]


MARKS = "doc_id long, row_a long, row_b long, node long, size long, fp long, sketch array<long>"


def marks(rows: DataFrame, words: int) -> DataFrame:
    """MARKS of ``rows(row_a, row_b, doc_id, text)``: a hash of the text's set of shingles, its size, fingerprint and parity sketch."""

    def run(ids: list, texts: list, a: list, b: list) -> dict:
        sets = [shingle_set(t, words) for t in texts]
        nodes = [xxhash.xxh3_64_intdigest(x.tobytes()) for x in sets]
        own = {"node": np.array(nodes, np.uint64).view(np.int64), "size": [len(x) for x in sets], "fp": [fold(x) for x in sets], "sketch": [parities(x) for x in sets]}
        return {"doc_id": ids, "row_a": a, "row_b": b} | own

    return per_text(rows, run, MARKS, "row_a", "row_b")


def parities(hashes: np.ndarray) -> np.ndarray:
    """SKETCH bits, each telling if an odd number of the hashes falls on it. Two sets differ in at least as many hashes as their sketches in bits."""
    odd = np.bincount((hashes % np.uint64(SKETCH)).astype(np.int64), minlength=SKETCH) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def shingle_sets(texts: DataFrame, words: int) -> DataFrame:
    def keep(sizes: np.ndarray, sets: np.ndarray) -> tuple:
        return [pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32)), pa.array(sets.view(np.int64)))], 1

    return shingled(texts, words, keep, "node long, own array<long>")


def prefixes(texts: DataFrame, words: int, least: float, often: np.ndarray) -> DataFrame:
    """``(node, size, at, key)``: of each set the shingles of which one must be shared at a Jaccard similarity of ``least``, with their places.

    Sets in one order, ``often`` (ascending) last and by hash otherwise, that share ``least`` of the larger one, share a shingle of
    the first ``size - ceil(least * size) + 1`` of each. This holds for any order; ``often`` only keeps the buckets small.
    """

    def keep(sizes: np.ndarray, sets: np.ndarray) -> tuple:
        last = np.zeros(len(sets), bool)
        if len(often):
            last = often[np.minimum(np.searchsorted(often, sets), len(often) - 1)] == sets
        ordered = sets[np.argsort(np.repeat(np.arange(len(sizes)) * 2, sizes) + last, kind="stable")]
        rows = np.minimum(sizes, sizes - np.ceil(least * sizes - 1e-9).astype(np.int64) + 1)
        place = np.arange(len(sets)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        chosen = place < np.repeat(rows, sizes)
        return [np.repeat(sizes, rows), place[chosen], ordered[chosen].view(np.int64)], rows

    return shingled(texts, words, keep, "node long, size long, at long, key long")


def may_be_near(x: str, y: str, least: float) -> str:
    """SQL: whether sets with sizes and places of a shared shingle ``x`` and ``y`` can have a Jaccard similarity of ``least``, if it is the first that they share.

    Then they share at most that one and what lies behind it in both. A pair that shares an earlier one of their prefixes is found by that.
    """
    return f"""(least({x}.size, {y}.size) + 1e-9D >= greatest({x}.size, {y}.size) * {least}D
        and least({x}.size - {x}.at, {y}.size - {y}.at) * {1 + least}D + 1e-9D >= ({x}.size + {y}.size) * {least}D)"""


def sketches_near(x: str, y: str, least: float) -> str:
    """SQL: whether the sketches of ``x`` and ``y`` leave a Jaccard similarity of ``least`` possible."""
    differ = f"aggregate(zip_with({x}.sketch, {y}.sketch, (p, q) -> bit_count(p ^ q)), 0, (n, v) -> n + v)"
    return f"(({x}.size + {y}.size - {differ}) / 2 * {1 + least}D + 1e-9D >= ({x}.size + {y}.size) * {least}D)"


def sketched_pairs(pairs: DataFrame, nodes: DataFrame, least: float) -> DataFrame:
    """The ``pairs(a, b)`` whose sketches don't show that they are below ``least``: no pair above it goes."""
    side = lambda c: nodes.select(F.col("node").alias(c), F.struct("size", "sketch").alias(f"of_{c}"))
    both = pairs.join(side("b"), "b").join(side("a"), "a")
    return both.where(sketches_near("of_a", "of_b", least)).select("a", "b")


def similar(pairs: DataFrame, nodes: DataFrame, texts: DataFrame, words: int, least: float, scratch: Scratch) -> DataFrame:
    """The distinct ``pairs(a, b)`` whose shingle sets have a Jaccard similarity of ``least`` or more. Only sets of pairs that pass the sketches are made."""
    pairs = scratch.write(sketched_pairs(pairs, nodes, least))
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    sets = scratch.write(shingle_sets(texts.join(wanted, "node", "left_semi"), words))
    side = lambda c, to: sets.select(F.col("node").alias(c), F.col("own").alias(to))
    shared = F.size(F.array_intersect("x", "y"))
    found = scratch.write(pairs.join(side("b", "y"), "b").join(side("a", "x"), "a").where(shared >= least * (F.size("x") + F.size("y") - shared)).select("a", "b"))
    scratch.drop(pairs, sets)
    return found


def index_of(texts: DataFrame, words: int, least: float, scratch: Scratch) -> DataFrame:
    """The prefixes, in an order that puts frequent shingles last, so that few sets have one of them in their prefix.

    Frequencies are those among one in ``STRIDE`` of the nodes, with all their shingles. The order only keeps the buckets small: any one meets every pair.
    """
    some = prefixes(texts.where(F.pmod(F.xxhash64("node"), F.lit(STRIDE)) == 0), words, 0.0, np.empty(0, np.uint64))
    top = some.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > FREQUENT).orderBy(F.desc("n"), "key").limit(OFTEN).select("key").toPandas()["key"]
    return scratch.write(prefixes(texts, words, least, np.sort(top.to_numpy(np.int64).view(np.uint64))))


def with_roots(nodes: DataFrame, roots: DataFrame) -> DataFrame:
    return nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def across(hot: DataFrame, nodes: DataFrame, edges: DataFrame, verify: Callable[[DataFrame], DataFrame], least: float, scratch: Scratch) -> DataFrame:
    """Edges that with ``edges`` connect exactly what all verified pairs of the buckets ``hot(key, node, size, at)`` would connect.

    All nodes are compared with the smallest of their bucket. Of the components that result, a bucket's pairs within one tell nothing new;
    those between two of them are all compared: each node outside the bucket's largest component with every node of another one. Nodes meet in bands of
    sizes, of which near copies are in the same one or in neighbouring ones, and what their sketches tell apart isn't a pair.
    """
    band = F.floor(F.log("size") / -math.log(least) + 1e-9).cast("int")
    hot = scratch.write(hot.join(nodes.select("node", "sketch"), "node").select("key", "node", F.struct("size", "at", "sketch").alias("x"), F.when(F.col("size") > 0, band).otherwise(-1).alias("band")))
    passing = lambda x, y: f"{may_be_near(x, y, least)} and {sketches_near(x, y, least)}"
    hubs = hot.groupBy("key").agg(F.min(F.struct("node", "x")).alias("m")).select("key", F.col("m.node").alias("a"), F.col("m.x").alias("y"))
    linked = verify(hot.join(hubs, "key").where(f"node <> a and {passing('x', 'y')}").select("a", F.col("node").alias("b")).distinct())
    held = scratch.write(with_roots(hot, components(edges.union(linked), scratch)))
    counts = held.groupBy("key", "root").count().groupBy("key").agg(F.max(F.struct("count", "root")).alias("m"), F.count("*").alias("roots"))
    largest = scratch.write(counts.where("roots > 1").select("key", F.col("m.root").alias("main")))
    held = scratch.write(held.join(largest, "key"))
    minor = held.where("root <> main").select("key", F.col("node").alias("a"), F.col("x").alias("y"), F.col("root").alias("own"), F.explode(F.sequence(F.col("band") - 1, F.col("band") + 1)).alias("band"))
    pairs = held.join(minor, ["key", "band"]).where(f"own <> root and (root = main or a < node) and {passing('x', 'y')}")
    return linked.union(verify(pairs.select(F.least("a", "node").alias("a"), F.greatest("a", "node").alias("b")).distinct()))


def fingerprint_pairs(nodes: DataFrame, max_bits: int, scratch: Scratch) -> DataFrame:
    """A candidate ``(a, b)`` for each of ``nodes(node, fp)`` that has any: the smallest node of its fingerprint, and for that one the smallest of the hubs
    of its buckets within ``max_bits``. At most one row a node, whatever the size of the buckets."""
    parts = max(1, int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    first = scratch.write(nodes.groupBy("fp").agg(F.min("node").alias("first")))
    index = variants(first.repartition(parts, "fp"), max_bits)
    hubs = scratch.write(index.groupBy("key").agg(F.min(F.struct("fp", "first")).alias("hub"), F.count("*").alias("n")).where("n > 1").select("key", F.col("hub.fp").alias("a"), F.col("hub.first").alias("hub")))
    met = index.withColumnRenamed("fp", "b").join(hubs, "key").where(near(max_bits)).where("a <> b")
    met = scratch.write(met.groupBy(F.col("b").alias("fp")).agg(F.min("hub").alias("hub")))
    own = nodes.join(first.join(met, "fp", "left"), "fp").select(F.when(F.col("node") == F.col("first"), F.col("hub")).otherwise(F.col("first")).alias("a"), F.col("node").alias("b"))
    return own.where("a is not null")


def near_copies(nodes: DataFrame, texts: DataFrame, words: int, least: float, max_bits: int, scratch: Scratch) -> DataFrame:
    """``(node, root)`` of ``nodes(node, size, fp, sketch)`` that are near copies of another one, with ``texts(node, text)``.

    First the fingerprints meet by their deletion variants: each is compared with the smallest one of every bucket that it is in, and each node with
    one such candidate. Fingerprints of texts with a similarity of ``least`` may differ in more bits than variants can span, so what is not linked by
    then meets in the buckets of the prefix filter, where every pair meets. Pairs within a component tell nothing new and aren't compared.
    """
    verify = lambda pairs: similar(pairs, nodes, texts, words, least, scratch)
    edges = verify(fingerprint_pairs(nodes.select("node", "fp"), max_bits, scratch))
    roots = scratch.write(components(edges, scratch))
    index = index_of(texts, words, least, scratch)
    rooted = scratch.write(with_roots(index, roots))
    shared = rooted.groupBy("key").agg(F.count("*").alias("n"), F.min("root").alias("low"), F.max("root").alias("high")).where("n > 1 and low <> high")
    members = scratch.write(rooted.join(scratch.write(shared.select("key", "n")), "key").select("key", "n", "node", "size", "at", "root"))
    scratch.drop(index, rooted)
    few = members.where(F.col("n") <= BUCKET).groupBy("key").agg(F.collect_list(F.struct("node", "size", "at", "root")).alias("all"))
    few = few.select("all", F.explode("all").alias("m"))
    few = few.select(F.col("m.node").alias("a"), F.explode(F.expr(f"filter(all, y -> y.node > m.node and y.root <> m.root and {may_be_near('y', 'm', least)})")["node"]).alias("b"))
    edges = scratch.write(edges.union(verify(few.distinct())))
    hot = members.where(F.col("n") > BUCKET).drop("n", "root")
    if not hot.isEmpty():
        edges = scratch.write(edges.union(across(hot, nodes, edges, verify, least, scratch)))
    return components(edges, scratch)


def representatives(docs: DataFrame, words: int = 5, least: float = 0.8, max_bits: int = 3) -> DataFrame:
    """The rows of ``docs``, with all their columns, without near copies: of each group the row with the smallest doc_id stays.

    Near copies share ``least`` of their ``words``-word shingles. Texts with the same shingles are one node; ``near_copies`` links the
    nodes. A null text has no shingles, as an empty one, and is grouped with those. A null doc_id is the largest one; of rows that share a doc_id and are
    near copies one stays, by a hash of the row, and rows that aren't near copies stay each. Equal rows are copies.
    """
    scratch = Scratch(docs.sparkSession, "copies")
    keyed = docs.select(*row_key(docs), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_a", "row_b")).alias("m")
    nodes = scratch.write(marks(keyed, words).groupBy("node").agg(first, F.first("size").alias("size"), F.first("fp").alias("fp"), F.first("sketch").alias("sketch")))
    own = nodes.select("node", "m.row_a", "m.row_b")
    texts = scratch.write(keyed.join(own, ["row_a", "row_b"]).groupBy("node").agg(F.min("text").alias("text")))
    groups = with_roots(nodes.select("node", "m"), near_copies(nodes, texts, words, least, max_bits, scratch))
    stay = scratch.write(groups.groupBy("root").agg(F.min("m").alias("m")).select("m.row_a", "m.row_b"))
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), *row_key(docs)).join(stay, ["row_a", "row_b"])
    return whole.groupBy("row_a", "row_b").agg(F.any_value("row").alias("row")).select("row.*")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
