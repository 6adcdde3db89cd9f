"""Quality rules: counts of a text's words, symbols and repeats, judged by an isolation forest.

The forest is fitted on all rows labelled good, which are dealt to its trees by hash: each row to one tree at least, and to as many as
give a tree ``SAMPLE`` rows. Trees grow in tasks; they split the rule statistics at random values, and documents that few splits set apart are anomalous.
The threshold is the score that rejects at most ``MAX_LOSS`` of all good rows, each of which is scored.
Every document is counted over its whole text, once; the counts are written, and scored when the forest is known.

Nulls: a null text has no words, and so fails the base rule. Without labelled good rows nothing but the base rule
rejects. Repeated rows stay repeated. A doc_id counts once in the fit, with its smallest counts if it has several. A text of any length is counted as a whole, in memory
a few times its own. Other columns are left alone, whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rainfold.llm.common import Scratch, arrow_schema, per_text, table, whole_rows

#: The share of the good rows that the threshold may reject.
MAX_LOSS = 0.001
#: Trees (a power of two), rows of a tree at least, if there are as many.
TREES, SAMPLE, DEPTH, SEED = 128, 512, 12, 8
SYMBOLS = "#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
OTHERS = ("n_upper", "n_shout", "n_lines")


def repeated_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that the text has twice or more, the first one included."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    seen = Counter(windows)
    covered = 0
    until = 0
    for i, w in enumerate(windows):
        if seen[w] > 1:
            covered += i + 3 - max(until, i)
            until = i + 3
    return covered


def statistics(text: str | None) -> tuple[int, ...]:
    """COUNTS, then OTHERS. Words are runs without ASCII white space."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    seen: set[bytes] = set()
    duplicates = lines = 0
    for line in raw.split(b"\n"):
        if line and not line.isspace():
            lines += 1
            duplicates += line in seen
            seen.add(line)
    spaces = sum(map(raw.count, (b" ", b"\t", b"\n", b"\v", b"\f", b"\r")))
    upper = sum(1 for w in words if len(w) > 2 and w.isupper())
    return (
        len(words), len(text) - spaces, sum(map(text.count, SYMBOLS)), duplicates, repeated_words(words),
        upper, raw.count(b"!"), lines,
    )


def features(counts: np.ndarray) -> np.ndarray:
    """What the forest sees: shares, so that a long text isn't anomalous for its length alone."""
    c = counts.astype(np.float64)
    words, chars = np.maximum(c[:, 0], 1), np.maximum(c[:, 1], 1)
    symbols, shouts, lines = c[:, 2], c[:, 6], np.maximum(c[:, 7], 1)
    return np.stack([chars / words, symbols / words, symbols / chars, c[:, 5] / words, shouts / words, c[:, 3] / lines, c[:, 4] / words], axis=1)


def harmonic(n: np.ndarray) -> np.ndarray:
    """Mean path length of an unsuccessful search among ``n`` rows."""
    n = np.asarray(n, np.float64)
    return np.where(n > 2, 2 * (np.log(np.maximum(n - 1, 1)) + 0.5772156649) - 2 * (n - 1) / np.maximum(n, 1), np.where(n == 2, 1.0, 0.0))


def grown(rows: np.ndarray, low: np.ndarray, high: np.ndarray, rng: np.random.Generator) -> list[tuple]:
    """A tree's nodes, the root first: feature (-1: leaf), split, children and, at leaves, the path length."""
    # The range is widened by random values outside it, as of the rows in a sample that holds them.
    margin = (high - low + 1e-3) * rng.uniform(0, 1, (4, rows.shape[1]))
    outside = np.where(rng.integers(0, 2, margin.shape) == 1, high + margin, low)
    nodes: list[tuple] = []

    def grow(part: np.ndarray, depth: int) -> int:
        at = len(nodes)
        nodes.append((-1, 0.0, 0, 0, depth + float(harmonic(np.array([len(part)]))[0])))
        spans = np.flatnonzero(part.min(axis=0) < part.max(axis=0)) if depth < DEPTH and len(part) > 1 else []
        if len(spans):
            j = int(rng.choice(spans))
            split = float(rng.uniform(part[:, j].min(), part[:, j].max()))
            left = part[:, j] <= split
            nodes[at] = (j, split, grow(part[left], depth + 1), grow(part[~left], depth + 1), 0.0)
        return at

    grow(np.concatenate([rows, outside]), 0)
    return nodes


class Forest:
    """Isolation forest in arrays: the nodes of all trees, and the places of their roots."""

    def __init__(self, rows: np.ndarray, seed: int = SEED):
        rng = np.random.default_rng(seed)
        size = min(SAMPLE, len(rows))
        trees = [grown(rows[rng.choice(len(rows), size, replace=False)], rows.min(axis=0), rows.max(axis=0), rng) for _ in range(TREES)]
        self._join([np.array(c) for c in zip(*(n for t in trees for n in t))], np.array([len(t) for t in trees]), size)

    @classmethod
    def of(cls, nodes: list[np.ndarray], sizes: np.ndarray, rows: float) -> Forest:
        """Of the trees' nodes one after the other, their numbers of nodes and the mean of their rows."""
        forest = cls.__new__(cls)
        forest._join(nodes, sizes, rows)
        return forest

    def _join(self, nodes: list[np.ndarray], sizes: np.ndarray, rows: float) -> None:
        self.norm = float(harmonic(np.array([rows]))[0]) or 1.0
        self.roots = np.cumsum(sizes) - sizes
        first = np.repeat(self.roots, sizes)
        self.feature, self.split, left, right, self.length = nodes
        self.left, self.right = left + first, right + first

    def score(self, rows: np.ndarray) -> np.ndarray:
        """0 to 1; near 1: few splits set the row apart."""
        total = np.zeros(len(rows))
        every = np.arange(len(rows))
        for root in self.roots:
            at = np.full(len(rows), root)
            for _ in range(DEPTH + 1):
                j = self.feature[at]
                inner = j >= 0
                if not inner.any():
                    break
                at = np.where(inner, np.where(rows[every, np.maximum(j, 0)] <= self.split[at], self.left[at], self.right[at]), at)
            total += self.length[at]
        return np.power(2.0, -total / len(self.roots) / self.norm)


def base_failed(counts: np.ndarray) -> np.ndarray:
    return (counts[:, 0] < 50) | (100 * counts[:, 4] > 50 * counts[:, 0])


COUNTED = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS + OTHERS)
FEATURES = [f"f{i}" for i in range(7)]


def matrix(batch: pa.RecordBatch, columns: tuple | list) -> np.ndarray:
    return np.stack([batch.column(c).to_numpy() for c in columns], axis=1)


def fit(counts: DataFrame, labels: DataFrame, scratch: Scratch) -> tuple[Forest | None, float]:
    """The forest and its threshold, from all labelled good rows of ``counts(doc_id, COUNTS, OTHERS)``. The driver sees the rows' number and range, and the trees."""
    good = labels.where("quality = 1 and doc_id is not null").select("doc_id").distinct()
    known = counts.join(good, "doc_id").groupBy("doc_id").agg(F.min(F.struct(*COUNTS, *OTHERS)).alias("c")).select("doc_id", "c.*")
    ddl = "doc_id long, " + ", ".join(f"{f} double" for f in FEATURES)
    seen = arrow_schema(ddl)

    def shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = matrix(batch, COUNTS + OTHERS)
            stays = ~base_failed(rows)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").filter(pa.array(stays)), *map(pa.array, features(rows[stays]).T.copy())], schema=seen)

    rows = scratch.write(known.mapInArrow(shares, ddl))
    n, *ends = rows.agg(F.count("*"), *(f(c) for f in (F.min, F.max) for c in FEATURES)).first()
    if not n:
        return None, np.inf
    low, high = np.array(ends[:7]), np.array(ends[7:])
    times = min(TREES, -(-TREES * SAMPLE // n))
    first, step = F.pmod(F.xxhash64(F.lit(SEED), "doc_id"), F.lit(TREES)), 2 * F.pmod(F.xxhash64(F.lit(SEED + 1), "doc_id"), F.lit(TREES // 2)) + 1
    dealt = rows.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(times - 1)))).withColumn("tree", F.pmod(first + F.col("k") * step, F.lit(TREES)).cast("int"))
    node = "tree int, node int, feature int, split double, left int, right int, length double"
    shape = arrow_schema(node)

    def tree(part: pa.Table) -> pa.Table:
        part = part.sort_by("doc_id")
        at = part.column("tree")[0].as_py()
        nodes = grown(np.stack([part.column(c).to_numpy() for c in FEATURES], axis=1), low, high, np.random.default_rng((SEED, at)))
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*((at, i, *x) for i, x in enumerate(nodes))), shape)], schema=shape)

    nodes = dealt.groupBy("tree").applyInArrow(tree, node).toArrow().sort_by([("tree", "ascending"), ("node", "ascending")])
    sizes = np.unique(nodes.column("tree").to_numpy(), return_counts=True)[1]
    forest = Forest.of([nodes.column(c).to_numpy() for c in ("feature", "split", "left", "right", "length")], sizes, n * times / len(sizes))
    score = arrow_schema("score double")

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(forest.score(matrix(batch, FEATURES)))], schema=score)

    return forest, rows.mapInArrow(scored, "score double").orderBy(F.desc("score")).offset(int(MAX_LOSS * n)).first()[0]


def count(docs: DataFrame) -> DataFrame:
    def run(ids: list, texts: list) -> dict:
        rows = list(zip(*map(statistics, texts))) or [()] * len(COUNTS + OTHERS)
        return {"doc_id": ids} | dict(zip(COUNTS + OTHERS, rows))

    return per_text(docs, run, COUNTED)


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, COUNTS, ``base_failed``, ``anomaly`` and ``kept`` for every row of ``docs``."""
    scratch = Scratch(docs.sparkSession, "rules")
    counts = scratch.write(count(docs))
    forest, limit = fit(counts, labels, scratch)
    ddl = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", base_failed boolean, anomaly double, kept boolean"
    schema = arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = matrix(batch, COUNTS + OTHERS)
            score = forest.score(features(rows)) if forest else np.zeros(len(rows))
            failed = base_failed(rows)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(batch.column(c) for c in COUNTS), *map(pa.array, (failed, score, ~failed & (score <= limit)))], schema=schema)

    return counts.mapInArrow(run, ddl)


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all their columns, that ``judge`` keeps."""
    scratch = Scratch(docs.sparkSession, "rules")
    counts = scratch.write(count(docs))
    forest, limit = fit(counts, labels, scratch)
    scratch.drop(counts)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.array([statistics(t.as_py()) for t in batch.column(at)], np.int64).reshape(-1, len(COUNTS) + len(OTHERS))
            score = forest.score(features(rows)) if forest else np.zeros(len(rows))
            yield batch.filter(pa.array(~base_failed(rows) & (score <= limit)))

    return whole_rows(docs, run)


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
