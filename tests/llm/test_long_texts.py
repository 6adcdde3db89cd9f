"""Texts that repeat themselves, and columns of any name."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from rainfold.llm import simhash, suffixes

DOCS = "doc_id long, text string, `a.b` string, g long, h long, after long, tie long, s0 long"


def table(spark, texts):
    return spark.createDataFrame([(i, t, "x", 1, 2, 3, 4, 5) for i, t in texts], DOCS)


def windows_removed(texts, length):
    """(doc_id, bytes, removed, digest) by counting every window."""
    raws = [(i, (t or "").encode()) for i, t in texts]
    seen: dict[bytes, int] = {}
    for _, raw in raws:
        for a in range(len(raw) - length + 1):
            seen[raw[a : a + length]] = seen.get(raw[a : a + length], 0) + 1
    out = []
    for i, raw in raws:
        gone = bytearray(len(raw))
        for a in range(len(raw) - length + 1):
            if seen[raw[a : a + length]] > 1:
                gone[a : a + length] = b"\1" * length
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out.append((i, len(raw), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def test_periods_against_every_window(spark):
    rng = random.Random(7)
    word = lambda n: "".join(rng.choices("abé ", k=n))
    texts = [(0, word(50) + "=" * 300 + word(60)), (1, "=" * 41), (2, word(20) + "=" * 40), (3, (word(7) * 90)[:500]), (4, word(37) * 9 + word(30)), (5, word(60) * 6), (6, "ab" * 21 + "ba" * 30)]
    texts += [(7, texts[3][1][11:52]), (8, texts[4][1][:45] + "!"), (9, "x" * 39), (10, "y" * 40), (11, "z" * 41 + "!" + "z" * 40)]
    got = suffixes.dedup(table(spark, texts), 40, 8).select("doc_id", "n_bytes", "n_removed", "kept_sha256").collect()
    assert sorted(map(tuple, got)) == windows_removed(texts, 40)


@pytest.mark.parametrize("text", ["a" * 2_000_000, "abcdefg" * 300_000, "".join(random.Random(1).choices("abcdefgh", k=2_000_000))], ids=["one", "seven", "random"])
def test_two_million_bytes(spark, text):
    rows = {r["doc_id"]: (r["n_bytes"], r["n_removed"]) for r in suffixes.dedup(table(spark, [(1, text), (2, text[:400]), (3, text[9:408])])).collect()}
    periodic = text[:70] == text[7:77]
    assert rows == {1: (len(text), len(text) if periodic else 400), 2: (400, 400), 3: (399, 0)}


@pytest.mark.parametrize("unit", ["a ", "ab " * 60 + "c\n", "a" * 300_000 + " "], ids=["one word", "a line", "long words"])
def test_passages_of_long_texts(spark, unit):
    text = unit * (2_000_000 // len(unit) if len(unit) < 1000 else 53)
    words = text.split()
    rows = [(1, text), (2, " ".join(words[:51])), (3, " ".join(words[:50])), (4, "x y " + " ".join(words[-51:]))]
    got = {r["doc_id"]: r["n_passage_words"] for r in suffixes.dedup(table(spark, rows), passage=51).collect()}
    told, seen = {}, set()
    for i, t in rows:
        w, gone, end = t.split(), 0, 0
        for s in range(len(w) - 50):
            key = hash(tuple(w[s : s + 51]))
            if key in seen:
                gone += s + 51 - max(s, end)
                end = s + 51
            seen.add(key)
        told[i] = gone
    assert got == told


def test_representatives_keep_columns_of_any_name(spark):
    rng = random.Random(3)
    base = [f"w{rng.randint(0, 500)}" for _ in range(200)]
    docs = table(spark, [(1, " ".join(base)), (2, " ".join(base + ["more"])), (3, "other words altogether in this text"), (4, None), (None, None)])
    kept = simhash.representatives(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"], r["a.b"]) for r in kept.select("doc_id", F.col("`a.b`")).collect()) == [(1, "x"), (3, "x"), (4, "x")]
