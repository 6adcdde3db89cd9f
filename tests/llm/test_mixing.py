"""Mixing against plain positions and against what a mix must have."""

import hashlib
import random
import re
from collections import defaultdict

import pytest

from rainfold.llm import mixing

SCHEMA = "doc_id long, text string, source string, size long, place string, src long, block long, slot long, row long, bucket string"


def levels(sizes: list[int]) -> list[float]:
    """Targets by sharing the excess again and again."""
    weights, out, total = [(5, 2, 1)[i % 3] for i in range(len(sizes))], [0.0] * len(sizes), float(sum(sizes))
    open_, left = set(range(len(sizes))), total
    while open_ and left > 0:
        share = left / sum(weights[i] for i in open_)
        full = {i for i in open_ if share * weights[i] >= 3 * sizes[i]}
        for i in full or open_:
            out[i] = 3.0 * sizes[i] if full else share * weights[i]
        left = left - sum(3.0 * sizes[i] for i in full) if full else 0
        open_ -= full
    return out


def corpus(seed: int) -> list[tuple]:
    rng = random.Random(seed)
    rows = [(i, " ".join(["wörd"] * rng.choice([0, 1, 7, 30, 90])), rng.choice(["b"] * 6 + ["a", "ä", "z", "", "\U0001f600", "￿"])) for i in range(400)]
    rows += [(None, "no id", None), (None, "no id", None), (7, "twice two\tthree", "b"), (7, "other", "b"), (500, None, "a"), (501, "x " * 40_000, "a"), (502, None, "nothing here")]
    return rows


def table(spark, rows):
    return spark.createDataFrame([(*r, 5, "p", 1, 2, 3, 4, "u") for r in rows], SCHEMA)


def test_against_plain(spark, tmp_path):
    rows = corpus(1)
    table(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = [r.asDict() for r in mixing.op12_mixing(spark, str(tmp_path)).collect()]
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    by_source = defaultdict(list)
    for i, t, s in rows:
        by_source[s].append((hashlib.md5(f"mix:{'' if i is None else i}:{t or ''}".encode()).hexdigest(), i or -1, size(t), i))
    names = sorted((s for s in by_source if s is not None), key=lambda s: s.encode()) + [None]
    totals = [sum(r[2] for r in by_source[s]) for s in names]
    want = []
    for s, n, target in zip(names, totals, levels(totals)):
        at, quota = 0, min(3 * n, round(target))
        for _, _, own, i in sorted(by_source[s], key=lambda r: r[:3]):
            taken = sum(max(0, min(at + k * n + own, quota) - (at + k * n)) for k in range(3))
            want.append((i if i is not None else -1, own, n, round(target, 3), taken))
            at += own
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["size"], r["source_size"], round(r["target"], 3), r["taken"]) for r in got) == sorted(want)
    assert all(r["taken"] <= 3 * r["size"] and (r["first_slot"] is None) == (r["taken"] == 0) for r in got)
    again = [r.asDict() for r in mixing.op12_mixing(spark, str(tmp_path)).collect()]
    key = lambda r: str(sorted(r.items()))
    assert sorted(got, key=key) == sorted(again, key=key)


@pytest.mark.parametrize("block", [1024, 16])
def test_slots_follow_the_weights(spark, monkeypatch, block):
    """Every slot holds a block of one source, each word at most three times, and every stretch of slots has the sources in their shares."""
    monkeypatch.setattr(mixing, "BLOCK", block)
    pieces = [r.asDict() for r in mixing.mix(table(spark, corpus(2))).where("slot is not null").collect()]
    slots = defaultdict(list)
    for p in pieces:
        slots[p["slot"]].append(p)
    assert sorted(slots) == list(range(len(slots)))
    for held in slots.values():
        held.sort(key=lambda p: p["offset"])
        assert len({p["doc"]["src"] for p in held}) == 1
        assert [p["offset"] for p in held] == [sum(q["length"] for q in held[:i]) for i in range(len(held))]
    assert sum(sum(p["length"] for p in held) == block for held in slots.values()) >= len(slots) - 8
    if block == 16:
        order = [slots[s][0]["doc"]["src"] for s in range(len(slots))]
        for src in set(order):
            share = order.count(src) / len(order)
            for end in range(1, len(order), 50):
                assert abs(order[:end].count(src) - share * end) < 6


def test_nothing_to_mix(spark):
    assert mixing.mix(table(spark, [])).collect() == []
    (row,) = mixing.mix(table(spark, [(1, None, None)])).collect()
    assert (row["doc_id"], row["size"], row["target"], row["slot"], row["length"]) == (1, 0, 0.0, None, 0)
