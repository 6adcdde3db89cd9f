"""Benchmark decontamination by latent semantic retrieval.

1. Passages of all documents (``PASSAGE`` words, every ``STRIDE``) are rows of a TF-IDF matrix over the benchmark's words. Tasks count
   in how many strides a word is and sketch the matrix to ``SKETCH`` rows: each passage is added to one of them with a random sign. The sketches add up
   by grouped sums. The right singular vectors of the sketch, scaled by IDF, span the latent space (a randomised SVD: the
   sketch preserves the Gram matrix in expectation). What comes to the driver is the sketch, SKETCH doubles for each
   different word of a block of the benchmark.
2. A passage is a candidate for an item if the cosine of their latent vectors is at least ``COSINE`` and the passage's
   vector reaches at least ``REACH`` of the length of the item's along it, so that one shared word isn't enough.
3. A candidate leaks if the longest common subsequence of words holds at least ``HIGH`` of the item, or at least ``LOW`` of it and
   ``HIGH`` of the answer, the item's last quarter (a paraphrase).

The benchmark is a stated query set, taken in blocks of at most ``BLOCK`` bytes of text; every document is searched over its whole text.

Nulls: a null text, in either table, holds no words and leaks nothing. Repeated documents give repeated rows, repeated items
one row each. Without benchmark or documents the result is empty. Other columns are left alone. Very long texts are taken whole, one at
a time at least.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rainfold.llm.common import arrow_schema, batch_of, table, whole_rows, words_of
from rainfold.llm.winnow import mix

PASSAGE, STRIDE = 32, 16
SKETCH, RANK = 128, 64
COSINE, REACH, HIGH, LOW = 0.3, 0.35, 0.8, 0.6
#: Words in over this share of the strides are common, and count only where they are among the RARE rarest of an item; see ``latent``.
COMMON, RARE = 0.005, 8
#: Bytes of the benchmark's text searched at a time, which bounds the sketch: SKETCH rows of at most BLOCK / 2 words.
BLOCK, AT_ONCE = 1 << 18, 1 << 18
SCHEMA = "doc_id long, item_id long, cosine double, lcs double, answer double"


def strides_of(docs: list[np.ndarray], useful: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Useful words of texts with the number of their stride, and the first stride of each text; strides of all texts count on.

    ``useful`` has a flag for each word's number and, last, for words without one (-1).
    """
    n = np.array([len(d) for d in docs], np.int64)
    strides = np.maximum(1, -(-n // STRIDE))
    first = np.concatenate(([0], np.cumsum(strides)))
    ids = np.concatenate(docs)
    at = np.flatnonzero(useful[ids])
    of = np.searchsorted(np.cumsum(n), at, side="right")
    return ids[at].astype(np.int64), first[of] + (at - (np.cumsum(n) - n)[of]) // STRIDE, first


def batches_of(batch: pa.RecordBatch, numbers: dict[bytes, int], first: Callable = lambda doc_id, words: doc_id) -> Iterator[tuple[list, list[np.ndarray]]]:
    """Texts of about AT_ONCE words at a time: doc_ids, or what ``first`` makes of them, and the numbers of their words."""
    ids, known, size, number = [], [], 0, numbers.get
    for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
        words = words_of(text.as_py())
        doc_id = first(doc_id, words)
        ids.append(doc_id)
        known.append(np.fromiter(map(number, words, repeat(-1)), np.int32, len(words)))
        size += len(words)
        if size >= AT_ONCE:
            yield ids, known
            ids, known, size = [], [], 0
    if ids:
        yield ids, known


def sketched(docs: DataFrame, numbers: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, int]:
    """In how many strides each word is, sketch (SKETCH x words) of the passages' term frequencies, and the number of strides."""
    width = len(numbers)
    useful = np.append(np.ones(width, bool), False)
    names = [f"z{i}" for i in range(SKETCH)]
    schema = arrow_schema("word int, df long, " + ", ".join(f"{c} double" for c in names))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch, df, total = np.zeros(SKETCH * width), np.zeros(width, np.int64), 0
        for batch in batches:
            # Rows and signs come from the text and the stride's place in it, so that the sketch doesn't depend on how the rows are dealt to tasks.
            for seeds, known in batches_of(batch, numbers, lambda _, words: xxhash.xxh3_64_intdigest(b" ".join(words))):
                word, stride, first = strides_of(known, useful)
                counts = np.diff(first)
                drawn = mix(np.repeat(np.array(seeds, np.uint64), counts) + (np.arange(first[-1]) - np.repeat(first[:-1], counts)).astype(np.uint64))
                rows, signs = (drawn >> np.uint64(32)).astype(np.int64) % SKETCH, (drawn & np.uint64(1)).astype(np.float64) * 2 - 1
                sketch += np.bincount(rows[stride] * width + word, signs[stride], SKETCH * width)
                begins = np.zeros(first[-1] + 1, bool)
                begins[first] = True
                later = np.flatnonzero(~begins[stride])  # a stride belongs to the passage that begins with it and to the one before
                before = stride[later] - 1
                sketch += np.bincount(rows[before] * width + word[later], signs[before], SKETCH * width)
                keys = np.sort(stride * width + word)
                df += np.bincount(keys[np.flatnonzero(np.diff(keys, prepend=-1))] % width, minlength=width)
                total += int(first[-1])
        used = np.flatnonzero(df)
        columns = [pa.array(np.append(used, -1).astype(np.int32)), pa.array(np.append(df[used], total))]
        columns += [pa.array(np.append(z[used], 0.0)) for z in sketch.reshape(SKETCH, width)]
        yield pa.RecordBatch.from_arrays(columns, schema=schema)

    parts = docs.mapInArrow(run, "word int, df long, " + ", ".join(f"{c} double" for c in names))
    df, sketch, total = np.zeros(width, np.int64), np.zeros((SKETCH, width)), 0
    for word, n, *z in parts.groupBy("word").agg(F.sum("df"), *(F.sum(c) for c in names)).collect():
        if word < 0:
            total = n
        else:
            df[word], sketch[:, word] = n, z
    return df, sketch, total


def latent(df: np.ndarray, sketch: np.ndarray, total: int, items: list[list[int]]) -> np.ndarray:
    """IDF times the right singular vectors: a row for each word.

    A common word has a row of zeros unless it is among the ``RARE`` rarest of some item, so an item made of common words only is found by them,
    and what one item holds changes nothing for the words of others.
    """
    used = df <= COMMON * total
    for item in items:
        own = np.unique(item)
        used[own[np.argsort(df[own], kind="stable")[:RARE]]] = True
    idf = np.log((1 + total) / (1 + df)) * used
    idf = np.where(used, np.maximum(idf, 0.05), 0.0)  # a word of all strides still tells an item made of such words from nothing
    _, s, vt = np.linalg.svd(sketch * idf, full_matrices=False)
    rank = min(RANK, int((s > 1e-9 * s[:1].max(initial=0)).sum()))
    return (vt[:rank] * idf).T.astype(np.float32)


def common_words(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence, a row of the table at a time in the bits of an integer."""
    masks: dict[int, int] = {}
    for i, w in enumerate(a):
        masks[w] = masks.get(w, 0) | 1 << i
    full = row = (1 << len(a)) - 1
    for w in b:
        if m := masks.get(w):
            x = row & m
            row = (row + x | row - x) & full
    return len(a) - row.bit_count()


def held_enough(met: list[tuple[np.ndarray, ...]], known: list[np.ndarray], first: np.ndarray, items: list[tuple[int, list[int]]], width: int) -> Iterator[tuple[int, int, float]]:
    """Each (passage, item) once, with its largest cosine, where the words around the passage hold at least LOW of the item's; else no subsequence can be as long."""
    passage, item, cosine = (np.concatenate(x) for x in zip(*met)) if met else (np.empty(0, np.int64),) * 3
    if not len(passage):
        return
    code = passage * len(items) + item
    order = np.argsort(code, kind="stable")
    starts = np.flatnonzero(np.diff(code[order], prepend=-1))
    passage, item, cosine = passage[order][starts], item[order][starts], np.maximum.reduceat(cosine[order], starts)
    size = np.array([len(words) for _, words in items])
    flat, words = np.concatenate([w for _, w in items]), np.concatenate(known)
    item_at, doc_at = np.cumsum(size) - size, np.concatenate(([0], np.cumsum([len(k) for k in known])))
    rows = max(1, (1 << 25) // width)  # passages whose words are marked at once, 32 MB
    ranges = lambda begin, n: np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(n.sum())
    heads = np.flatnonzero(np.diff(passage, prepend=-1))
    for at in range(0, len(heads), rows):
        own = heads[at : at + rows]
        end = heads[at + rows] if at + rows < len(heads) else len(passage)
        p, i = passage[own[0] : end], item[own[0] : end]
        row = np.cumsum(np.isin(np.arange(own[0], end), own)) - 1
        reach = np.maximum.reduceat(size[i], own - own[0])
        doc = np.searchsorted(first, passage[own], side="right") - 1
        begin = doc_at[doc] + (passage[own] - first[doc]) * STRIDE
        low, high = np.maximum(doc_at[doc], begin - reach), np.minimum(doc_at[doc + 1], begin + PASSAGE + reach)
        there = np.zeros((len(own), width + 1), bool)
        there[np.repeat(np.arange(len(own)), high - low), words[ranges(low, high - low)]] = True  # words without a number, -1, fall on the last column
        ends = np.cumsum(size[i])
        cuts = np.unique(np.concatenate(([0], np.searchsorted(ends, np.arange(1 << 21, ends[-1], 1 << 21)), [len(i)])))
        for b, c in zip(cuts, cuts[1:]):  # pairs of some two million words of items at a time
            n = size[i[b:c]]
            held = np.add.reduceat(there[np.repeat(row[b:c], n), flat[ranges(item_at[i[b:c]], n)]], np.cumsum(n) - n, dtype=np.int64)
            for k in (b + np.flatnonzero(held >= LOW * n)).tolist():
                yield int(p[k]), int(i[k]), float(cosine[own[0] + k])


def search(docs: DataFrame, items: list[tuple[int, list[bytes]]], drop: bool = False) -> DataFrame:
    """SCHEMA rows of the documents that hold an item; with ``drop`` instead the rows of ``docs``, with all columns, that hold none."""
    numbers: dict[bytes, int] = {}
    for _, words in items:
        for w in words:
            numbers.setdefault(w, len(numbers))
    own = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    coded = [(item_id, [numbers[w] for w in words]) for item_id, words in items]
    table_ = latent(*sketched(own, numbers), [words for _, words in coded])
    useful = np.append(np.abs(table_).max(axis=1, initial=0) > 0, False)
    parts = [(i, words[a : a + PASSAGE]) for i, (_, words) in enumerate(coded) for a in range(0, max(1, len(words) - STRIDE), STRIDE)]
    owner = np.array([i for i, _ in parts])
    queries = np.stack([table_[p].sum(axis=0) for _, p in parts])
    lengths = np.linalg.norm(queries, axis=1)
    shortest = lengths.min(initial=np.inf)
    schema, places = arrow_schema(SCHEMA), [docs.columns.index(c) for c in ("doc_id", "text")] if drop else [0, 1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, clean = [], []
            for ids, known in batches_of(batch.select(places), numbers):
                word, stride, first = strides_of(known, useful)
                sums = np.zeros((int(first[-1]) + 1, table_.shape[1]), np.float32)
                at = np.flatnonzero(np.diff(stride, prepend=-1))
                if len(at):
                    sums[stride[at]] = np.add.reduceat(table_[word], at)
                ends = np.zeros(len(sums), bool)
                ends[first[1:]] = True  # the first stride of the next text
                vectors = sums[:-1] + np.where(ends[1:, None], 0, sums[1:])
                norms = np.linalg.norm(vectors, axis=1)
                long_enough = np.flatnonzero((norms >= REACH * shortest) & (norms > 0))
                met: list[tuple[np.ndarray, ...]] = []
                for a in range(0, len(long_enough), 4096):
                    some = long_enough[a : a + 4096]
                    product = vectors[some] @ queries.T
                    p, q = np.nonzero((product >= REACH * lengths * lengths) & (product >= COSINE * norms[some, None] * lengths))
                    met.append((some[p], owner[q], product[p, q] / norms[some[p]] / lengths[q]))
                best: dict[tuple[int, int], tuple] = {}
                for p, i, cosine in held_enough(met, known, first, coded, len(numbers)):
                    doc = int(np.searchsorted(first, p, side="right")) - 1
                    item_id, item = coded[i]
                    begin = (p - int(first[doc])) * STRIDE
                    around = known[doc][max(0, begin - len(item)) : begin + PASSAGE + len(item)].tolist()
                    lcs = common_words(item, around) / len(item)
                    if lcs >= LOW:
                        answer = item[-max(1, len(item) // 4) :]
                        held = common_words(answer, around) / len(answer)
                        if lcs >= HIGH or held >= HIGH:
                            best[doc, i] = max(best.get((doc, i), (0.0,)), (lcs, held, cosine))
                if drop:
                    hit = {doc for doc, _ in best}
                    clean += [doc not in hit for doc in range(len(ids))]
                    continue
                rows += [(ids[doc], coded[i][0], cosine, lcs, held) for (doc, i), (lcs, held, cosine) in sorted(best.items())]
            yield batch.filter(pa.array(clean, pa.bool_())) if drop else batch_of(rows, schema)

    return whole_rows(docs, run) if drop else own.mapInArrow(run, SCHEMA)


def item_blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, list[bytes]]]]:
    benchmark = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).where("text is not null")
    blocks = 1 + (benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // BLOCK
    for k in range(blocks):
        rows = benchmark.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).orderBy("item_id", "text").collect()
        if items := [(i, words) for i, t in rows if (words := words_of(t))]:
            yield items


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``(doc_id, item_id, cosine, lcs, answer)`` of every document that holds an item."""
    out = docs.sparkSession.createDataFrame([], SCHEMA)
    for items in item_blocks(benchmark):
        out = out.union(search(docs, items))
    return out


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all their columns, that hold no item."""
    for items in item_blocks(benchmark):
        docs = search(docs, items, drop=True)
    return docs


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
