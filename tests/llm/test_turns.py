"""Structure repair against every way through the grammar."""

import functools
import hashlib
import random
import re
import zlib

import pytest

from rainfold.llm import turns

SCHEMA = "conv_id long, turn long, role string, text string, pos string, gone string, audit string"


def cheapest(rows: list[tuple[str, str]]) -> tuple[int, str]:
    """(cost, audit) of rows (initial, fault), by trying every edit at every place."""
    follow = {"": ["s", "u"], "s": ["u"], "u": ["a"], "a": ["u"]}

    @functools.lru_cache(None)
    def best(i: int, last: str, inserted: int) -> tuple[int, str]:
        ways = [(0, "")] if i == len(rows) and last in ("", "a") else []
        add = lambda cost, edit, rest: ways.append((cost + rest[0], edit + rest[1]))
        if i < len(rows):
            initial, fault = rows[i]
            add(2, "D", best(i + 1, last, 0))
            if fault not in ("blank", "duplicate"):
                for symbol in follow[last]:
                    if initial == symbol or symbol != "s":
                        add((0 if initial == symbol else 1) + (5 if fault == "truncated" else 0), "K" if initial == symbol else "R", best(i + 1, symbol, 0))
        if inserted < 3:
            for symbol in follow[last]:
                if symbol != "s":
                    add(5, "I", best(i, symbol, inserted + 1))
        return min(ways, default=(10**9, ""))

    return best(0, "", 0)


def plain(rows: list[tuple], damage: bool) -> dict:
    """The whole query in plain Python; rows (conv_id, turn, role, text)."""
    convs: dict = {}
    for conv_id, turn, role, text in rows:
        own = convs.setdefault(conv_id, [])
        fault = zlib.crc32(f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}".encode()) % 20 if damage else 99
        empty = " " if damage else ""
        role, text = empty if role is None else role, empty if text is None else text
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        own += [(turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    out = {}
    for conv_id, own in convs.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        found, seen = [], set()
        for _, role, text in own:
            last = re.findall(r"[^\x20\x09-\x0D]", text)[-1:]
            found.append("blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last[0] not in ".!?" else "")
            seen.add((role, text))
        at = [r[0] for r in own if r[0] is not None]
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(own, own[1:])]
        cost, audit = cheapest([(r[1][:1], f) for r, f in zip(own, found)])
        left, repaired, want = iter(own), [], "user"
        for edit in audit:
            _, role, text = (None, want, "") if edit == "I" else next(left)
            if edit != "D":
                role = want if edit == "R" else role
                repaired.append(f"{role}:{text}")
                want = "user" if role[:1] == "s" or role[:1] == "a" else "assistant"
        out[conv_id] = (
            max(at) - min(at) + 1 - len(set(at)) if at else 0, found.count("blank"), found.count("duplicate"), found.count("truncated"),
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(repaired).encode()).hexdigest(),
        )
    return out


def conversations(n: int, seed: int) -> list[tuple]:
    rng, rows = random.Random(seed), []
    for c in range(n):
        roles = ["system"] * rng.randint(0, 1) + ["user", "assistant"] * rng.randint(0, 5)
        for t, role in enumerate(roles):
            rows.append((c, t + rng.randint(0, 1), rng.choice([role] * 12 + ["tool", "", None, "user"]), rng.choice(["Fine.", "One more?", "cut", " ", "", None, f"Say {t} \n", "é!\t"])))
    return rows + [(None, 1, "user", "No id."), (None, None, "assistant", "Nor turn."), (n, None, None, None), (n + 1, 2**62, "user", "x" * 300_000 + "."), (n + 1, -(2**62), "assistant", "y.")]


def as_dict(df) -> dict:
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    return {r["conv_id"]: tuple(r[n] for n in names) for r in df.collect()}


def test_alignment_and_walk_against_every_way():
    rng = random.Random(5)
    faults = [None, "blank", "duplicate", "truncated"]
    for _ in range(800):
        weights = rng.choice([[1, 1, 1, 1], [0, 1, 5, 5], [0, 0, 3, 1], [1, 5, 1, 1]])
        n = rng.randint(0, 11)
        rows = [("tsua"[i], f) for i, f in zip(rng.choices(range(4), weights, k=n), rng.choices(faults, [6, 1, 1, 2], k=n))]
        own = bytes(turns.code(*r) for r in rows)
        assert turns.aligned(own) == turns.walked(own) == cheapest(rows), rows
    long = bytes(turns.code(rng.choice("uuaa") if rng.random() < 0.1 else "ua"[i % 2], rng.choices(faults, [12, 1, 1, 1])[0]) for i in range(700))
    assert turns.aligned(long) == turns.walked(long)


def test_query_against_plain(spark, tmp_path):
    rows = conversations(120, 2)
    path = str(tmp_path)
    spark.createDataFrame([(*r, "p", "g", "a") for r in rows], SCHEMA).write.parquet(f"{path}/conversations.parquet")
    assert as_dict(turns.op11_turns(spark, path)) == plain(rows, True)


@pytest.mark.parametrize("long", [2048, 3])
def test_repair_gives_the_grammar(spark, monkeypatch, long):
    monkeypatch.setattr(turns, "LONG", long)
    rows = conversations(60, 3)
    audits, repaired = turns.repair(spark.createDataFrame([(*r, "p", "g", "a") for r in rows], SCHEMA))
    want = plain(rows, False)
    assert {r["conv_id"]: (r["gaps"], r["cost"], r["audit"]) for r in audits.collect()} == {c: (w[0], w[5], w[6]) for c, w in want.items()}
    found: dict = {}
    for r in sorted(repaired.collect(), key=lambda r: r["turn"]):
        found.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    for conv_id, w in want.items():
        own = found.get(conv_id, [])
        assert re.fullmatch("(s?(ua)+)?", "".join(role[:1] for role, _ in own))
        assert hashlib.sha256("\n".join(f"{a}:{b}" for a, b in own).encode()).hexdigest() == w[7]


def test_no_rows(spark):
    audits, repaired = turns.repair(spark.createDataFrame([], SCHEMA))
    assert audits.collect() == repaired.collect() == []
