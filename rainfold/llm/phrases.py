"""Substring dedup of word windows by repeated-phrase automata.

A window of ``LENGTH`` words is removed where its word sequence also starts earlier (a smaller doc_id, or the same
document and an earlier start).

1. Recurring passages. Slices of windows (see ``winnow``) whose anchor recurs are candidates. A slice that recurs as a
   whole repeats its first occurrence. Where an anchor has slices of different words, the windows of one slice of each kind are
   counted by hash, and those that recur repeat their first occurrence too. Repeats that continue each other, here and where
   they come from, are joined to one passage, so a passage's words are cut and sent once for each document that may hold it.
   Counts are pre-aggregated, and no group of copies is gathered.
2. Automata. A task takes its documents in small shards and compiles the passages that they may hold to one Aho-Corasick
   automaton over word numbers.
3. The documents that may hold a passage after it first occurs stream through their shard's automaton, which confirms the passages word
   by word and finds every occurrence; those after the first one are removed. No other document has anything to remove.

Nulls: a null text has no words, a null doc_id comes last. Rows that share a doc_id, or have none, are documents of their own, ordered by
a hash of the text; of equal rows one is the first, and the others repeat it. Other columns of the input are left alone. A text of any
length is hashed in chunks of bounded size. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from itertools import chain, compress, repeat

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rainfold.llm.common import Scratch, arrow_schema, batch_of, table
from rainfold.llm.winnow import KEY, LAST, candidates, keyed, lines, windows, with_source

LENGTH, GRAM = 20, 5
#: Documents whose passages share an automaton, and words whose hashes are remembered.
SHARD, WORDS = 64, 500_000


class WordHash(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > WORDS:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word) >> 1
        return found


def split(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split()


class WordUnits:
    def __init__(self):
        self.known = WordHash()

    def __call__(self, text: str) -> np.ndarray:
        words = split(text)
        return np.fromiter(map(self.known.__getitem__, words), np.int64, len(words)).view(np.uint64)


def slice_words(text: str, wanted: list[tuple[int, int]]) -> list[tuple]:
    words = split(text)
    return [(a, n, b" ".join(words[a : a + n]).decode("utf-8", "surrogatepass")) for a, n in wanted]


def passages(docs: DataFrame, scratch: Scratch, length: int, gram: int) -> DataFrame:
    """``(doc_id, tie, from_doc, from_tie, from_a, words)``: the passages that a document may hold after they first occur."""
    found = candidates(docs, WordUnits(), length, gram, scratch)
    place = F.struct(*KEY, "s0")
    kinds = scratch.write(found.groupBy("g", "h").agg(F.min(place).alias("first"), (F.min(place) != F.max(place)).alias("recurs"), F.first("more").alias("more")))
    several = scratch.write(kinds.groupBy("g").agg(F.count("*").alias("kinds")).where("kinds > 1").select("g"))
    source = lambda at: (F.col(f"{at}.doc_id").alias("from_doc"), F.col(f"{at}.tie").alias("from_tie"))
    whole = found.join(kinds.where("recurs").select("g", "h", "first"), ["g", "h"]).where(place != F.col("first"))
    whole = whole.select(*KEY, F.col("s0").alias("a"), (F.col("s0") + F.col("more") + length).alias("b"), *source("first"), F.col("first.s0").alias("from_a"))
    mixed = kinds.join(several, "g").select("first.*", "more")
    each = scratch.write(windows(docs, mixed, WordUnits(), length))
    at = F.struct(*KEY, "a")
    often = scratch.write(each.groupBy("w").agg(F.min(at).alias("first"), F.max(at).alias("last")).where("first <> last").select("w", "first"))
    later = each.join(often, "w").where(at != F.col("first")).select(*KEY, "a", (F.col("a") + length).alias("b"), *source("first"), F.col("first.a").alias("from_a"))
    joined = scratch.write(lines(whole.union(later)))
    scratch.drop(found, kinds, several, each, often)
    return with_source(joined, docs, slice_words, "words string").select(*KEY, "from_doc", "from_tie", "from_a", "words")


def swept(docs: DataFrame, found: DataFrame, length: int, kept: bool = True) -> DataFrame:
    """Steps 2 and 3: ``(doc_id, n_words, n_removed, kept_sha256, kept)`` for every row that ``docs(doc_id, tie, text, n)`` stands for; ``kept`` if it is asked for."""
    own = found.groupBy(*KEY).agg(F.collect_list(F.struct("from_doc", "from_tie", "from_a", "words")).alias("passages"))
    ddl = "doc_id long, n long, n_words long, n_removed long, kept_sha256 string" + ", kept string" * kept
    schema = arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SHARD):
                ids, ties, texts, ns, own = (c.to_pylist() for c in batch.slice(at, SHARD).columns)
                numbers: dict[bytes, int] = {}
                firsts: dict[tuple, tuple[int, int, int]] = {}
                for p in chain.from_iterable(ps for ps in own if ps):
                    key = tuple([numbers.setdefault(w, len(numbers) + 1) for w in p["words"].encode("utf-8", "surrogatepass").split(b" ")])
                    first = (p["from_doc"], p["from_tie"], p["from_a"])
                    firsts[key] = min(firsts.get(key, first), first)
                automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
                for key, first in firsts.items():
                    automaton.add_word(key, (len(key), first))
                if firsts:
                    automaton.make_automaton()
                rows = []
                for doc_id, tie, text, n, may in zip(ids, ties, texts, ns, own):
                    words = split(text)
                    stay, gone = words, 0
                    if may and len(words) >= length:
                        keep = bytearray(b"\1") * len(words)
                        for end, (size, first) in automaton.iter(tuple(map(numbers.get, words, repeat(0)))):
                            if (doc_id, tie, end + 1 - size) > first:
                                keep[end + 1 - size : end + 1] = bytes(size)
                        stay, gone = compress(words, keep), keep.count(0)
                    rest = b" ".join(stay)
                    text_of = lambda x: (x.decode("utf-8", "surrogatepass"),) * kept
                    rows.append((doc_id, 1, len(words), gone, sha256(rest).hexdigest(), *text_of(rest)))
                    if n > 1 and len(words) < length:  # equal rows too short to repeat anything
                        rows.append((doc_id, n - 1, *rows[-1][2:]))
                    elif n > 1:
                        rows.append((doc_id, n - 1, len(words), len(words), sha256(b"").hexdigest(), *text_of(b"")))
                yield batch_of(rows, schema)

    out = docs.join(own, KEY, "left").select(*KEY, "text", "n", "passages").mapInArrow(run, ddl)
    return out.withColumn("n", F.explode(F.sequence(F.lit(1).cast("long"), "n"))).drop("n")


def dedup(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, kept: bool = True) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept_sha256, kept)``; ``kept`` is the text that stays, its words joined by a space, and left out unless it is asked for."""
    scratch = Scratch(docs.sparkSession, "phrases")
    docs = keyed(docs, scratch)
    out = swept(docs, passages(docs, scratch, length, gram), length, kept)
    return out.withColumn("doc_id", F.when(F.col("doc_id") < LAST, F.col("doc_id")))


def op10_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(table(spark, sf_dir, "documents"), kept=False)


OP10_SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), i AS (
  SELECT doc_id, unnest(range(1, len(words) - 18)) AS s, words FROM w WHERE len(words) >= 20
), f AS (
  SELECT doc_id, s, row_number() OVER (PARTITION BY array_to_string(words[s:s + 19], ' ') ORDER BY doc_id, s) AS k FROM i
), gone AS (
  SELECT DISTINCT doc_id, s + j AS p FROM f, range(20) r(j) WHERE k > 1
), kept AS (
  SELECT e.doc_id, count(g.p) AS n_removed, coalesce(string_agg(e.word, ' ' ORDER BY e.p) FILTER (WHERE g.p IS NULL), '') AS kept
  FROM (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS p FROM w) e LEFT JOIN gone g ON e.doc_id = g.doc_id AND e.p = g.p GROUP BY e.doc_id
)
SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN kept ON w.doc_id = kept.doc_id
"""
