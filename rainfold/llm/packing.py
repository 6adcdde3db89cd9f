"""Packing of token sequences by minimum bin slack.

Documents become ids; whole windows of ``CAPACITY`` ids are sequences of their own, and what remains of each
document (1 to CAPACITY - 1 ids) is packed. A window takes the longest remainder and then the multiset of the
others that fills it closest to capacity: a subset-sum dynamic programme over a bitset (bit s is set if some
multiset sums to s) with one layer for each length and power of two of its count, walked back for the counts. It stops at the
first layer that reaches capacity exactly. A fill is used again while the counts allow it.

A window that no multiset fills exactly is filled with the head of another remainder, whose tail stays in the
pool. What is left when a partition ends is cut into sequences whose lengths are powers of two, which need no padding.

Every task packs what it reads and nothing is shuffled. The pool of a task holds (document, start, length)
triples and is packed when it has ``POOL`` of them, so memory is bounded. ``sequence_id`` has the partition in its upper bits. A task that runs again
over the same rows gives the same result.

Nulls: a null or empty text is the end id alone. Repeated rows are packed as often as they occur, a null doc_id too. A text of any length is cut into as many
sequences as it fills. Other columns are left alone, whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

import re
import struct
import unicodedata
import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rainfold.llm.common import arrow_schema, table

CAPACITY, END_ID, VOCABULARY = 2048, 1, "word_bpe_49k.json"
#: Remainders packed at a time, texts tokenised at a time, and words that a worker remembers.
POOL, BATCH, WORDS = 4096, 256, 1_200_000
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def fill(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """The multiset of lengths within ``counts`` whose sum is closest to ``capacity`` without exceeding it."""
    mask = (1 << (capacity + 1)) - 1
    reached, layers = 1, []
    for length in range(min(capacity, max(counts, default=0)), 0, -1):
        if not (left := min(counts.get(length, 0), capacity // length)):
            continue
        take = 1
        while left and not reached >> capacity & 1:
            take = min(take, left)
            layers.append((length, take, reached))
            reached |= reached << (length * take) & mask
            left -= take
            take *= 2
        if reached >> capacity & 1:
            break
    total, chosen = reached.bit_length() - 1, defaultdict(int)
    for length, take, before in reversed(layers):
        if not before >> total & 1:
            chosen[length] += take
            total -= length * take
    return dict(chosen)


class Packer:
    """Pool of remainders by length. ``close`` gives rows (piece, sequence, offset), a piece being (key, start, length)."""

    def __init__(self, capacity: int = CAPACITY):
        self.capacity, self.pool, self.counts, self.size, self.total, self.sequences = capacity, defaultdict(list), defaultdict(int), 0, 0, 0

    def add(self, piece: tuple) -> None:
        self.pool[piece[2]].append(piece)
        self.counts[piece[2]] += 1
        self.size += 1
        self.total += piece[2]

    def take(self, length: int) -> tuple:
        self.counts[length] -= 1
        self.size -= 1
        self.total -= length
        if not self.counts[length]:
            del self.counts[length]
        return self.pool[length].pop()

    def sequence(self, pieces: list[tuple]) -> Iterator[tuple]:
        at = 0
        for piece in pieces:
            yield piece, self.sequences, at
            at += piece[2]
        self.sequences += 1

    def pack(self, until: int) -> Iterator[tuple]:
        """Full windows, as long as the pool has over ``until`` remainders and enough ids for one."""
        while self.size > until and self.total >= self.capacity:
            longest = max(self.counts)
            self.counts[longest] -= 1
            chosen = fill(self.counts, self.capacity - longest)
            self.counts[longest] += 1
            chosen[longest] = chosen.get(longest, 0) + 1
            slack = self.capacity - sum(x * n for x, n in chosen.items())
            for _ in range(min(self.counts[x] // n for x, n in chosen.items()) if not slack else 1):
                pieces = [self.take(x) for x, n in chosen.items() for _ in range(n)]
                if slack:
                    key, start, length = self.take(min(x for x in self.counts if x > slack))
                    pieces.append((key, start, slack))
                    self.add((key, start + slack, length - slack))
                yield from self.sequence(pieces)

    def close(self) -> Iterator[tuple]:
        """All that is left: full windows, then sequences whose lengths are powers of two."""
        yield from self.pack(0)
        rest = [p for x in sorted(self.pool, reverse=True) for p in self.pool[x]]
        total = sum(p[2] for p in rest)
        for bit in reversed(range(total.bit_length())):
            if total >> bit & 1:
                room, pieces = 1 << bit, []
                while room:
                    key, start, length = rest.pop()
                    pieces.append((key, start, min(room, length)))
                    if length > room:
                        rest.append((key, start + room, length - room))
                    room -= pieces[-1][2]
                yield from self.sequence(pieces)


def parts_pattern() -> re.Pattern:
    """Cuts lower-case Latin words, one a line, as the tokenizer cuts: letters, single digits, other characters."""
    kinds = {kind: re.escape("".join(c for c in map(chr, range(0x250)) if unicodedata.category(c)[0] == kind)) for kind in "LN"}
    letters, digits = kinds["L"], kinds["N"]
    return re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{digits}]|[^\\t-\\r \x85\xa0{letters}{digits}]+|\n")


#: By vocabulary, the ids of words and of parts of words; outlives a task where a worker runs several.
_MEMORY: dict[str, tuple[dict[bytes, bytes], dict[str, bytes]]] = {}


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit bytes, the same as encoding each text at once.

    The vocabulary's tokens never span white space, so the ids of words are remembered. A Latin word's ids are those of its
    parts, cut as the tokenizer cuts; they are remembered too, as many words share them.
    Other words are encoded as they are, texts that may hold a special token whole. A memory is emptied when it is full.
    """

    PARTS = parts_pattern()
    #: Ends a word among the ids of parts; no id has these bytes, and none can end or begin inside them.
    END = b"\xff\xff\xff\xff"

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tokenizers

        self.tokenizer = tokenizers.Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.known, self.parts = _MEMORY.setdefault(path, ({}, {}))

    def ids(self, texts: list[str]) -> list[bytes]:
        return [struct.pack(f"<{len(e.ids)}I", *e.ids) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def ids_of_parts(self, parts: list[str]) -> list[bytes]:
        """Encoded together, and cut after each token that ends a part."""
        out: list[bytes] = []
        for at in range(0, len(parts), 256):
            some = parts[at : at + 256]
            raw = self.ids([" ".join(some)])[0]
            cuts = [0, *(4 * (np.flatnonzero(self.ends[np.frombuffer(raw, "<u4")]) + 1)).tolist()]
            out += [raw[a:b] for a, b in zip(cuts, cuts[1:])] if len(cuts) == len(some) + 1 else self.ids(some)
        return out

    def latin(self, word: bytes) -> bool:
        """Characters below U+0250 are composed already, and lower-cased by Python as by the normaliser but for the dotted capital I."""
        text = word.decode("utf-8", "surrogatepass")
        return max(text) < "\u0250" and "\u0130" not in text

    def learn(self, words: set[bytes]) -> None:
        known, parts = self.known, self.parts
        cut = [w for w in words if w.isascii() or self.latin(w)]
        if len(cut) < len(words):
            others = list(words.difference(cut))
            known.update(zip(others, self.ids([w.decode("utf-8", "surrogatepass") for w in others])))
        if not cut:
            return
        flat = self.PARTS.findall(b"\n".join(cut).decode().lower())
        if len(parts) > WORDS:
            parts.clear()
        parts["\n"] = self.END
        new = list(set(flat).difference(parts))
        parts.update(zip(new, self.ids_of_parts(new)))
        known.update(zip(cut, b"".join(map(parts.__getitem__, flat)).split(self.END)))

    def encode(self, texts: list[str | None]) -> Iterator[bytes]:
        split = [(t or "").encode("utf-8", "surrogatepass").split() for t in texts]
        whole = [bool(t) and "<|" in t for t in texts]
        words = set(chain.from_iterable(own for own, x in zip(split, whole) if not x))
        known = self.known
        if new := words.difference(known):
            if len(known) + len(new) > WORDS:
                known.clear()
                new = words
            self.learn(new)
        for text, own, at_once in zip(texts, split, whole):
            yield self.ids([text])[0] if at_once else b"".join(map(known.__getitem__, own))


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, *extra: str) -> DataFrame:
    """Pieces of SCHEMA for every row of ``docs(doc_id, text)``; with ``extra`` naming ``ids``, the ids too."""
    end = struct.pack("<I", END_ID)
    schema = SCHEMA + (", ids array<int>" if "ids" in extra else "")
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, packer = Encoder(path), Packer(capacity)
        base = TaskContext.get().partitionId() << 40
        rows: list[tuple] = []
        held: list[bytes] = []

        def keep(placed: Iterator[tuple]) -> None:
            for (key, start, length), sequence, offset in placed:
                doc_id, total, begin, buffer = key
                raw = buffer[4 * (start - begin) : 4 * (start - begin + length)]
                rows.append((doc_id, start, length, zlib.crc32(raw), total, base + sequence, offset))
                if "ids" in extra:
                    held.append(raw)

        def given() -> pa.RecordBatch:
            columns = [pa.array(c, type=pa.int64()) for c in zip(*rows)] or [pa.array([], type=pa.int64())] * 7
            if "ids" in extra:
                ends = np.cumsum([0, *(len(x) // 4 for x in held)], dtype=np.int32)
                columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(held), "<i4"))))
            rows.clear()
            held.clear()
            return pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)

        for batch in batches:
            for at in range(0, batch.num_rows, BATCH):
                ids, texts = (c.to_pylist() for c in batch.slice(at, BATCH).columns)
                for doc_id, buffer in zip(ids, encoder.encode(texts)):
                    buffer += end
                    total = len(buffer) // 4
                    whole = total // capacity * capacity
                    for start in range(0, whole, capacity):
                        keep(packer.sequence([((doc_id, total, 0, buffer), start, capacity)]))
                    if total > whole:  # only the remainder's ids stay in memory
                        packer.add(((doc_id, total, whole, buffer[4 * whole :]), whole, total - whole))
                if packer.size >= 2 * POOL:
                    keep(packer.pack(POOL))
                if len(rows) >= BATCH:
                    yield given()
        keep(packer.close())
        yield given()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))
