"""What the randomness tests find among keys and identifiers, and what they report of it."""

import random
import string

import pytest

from rainfold.llm import secrets

LETTERS = {"hex": "0123456789abcdef", "base32": string.ascii_uppercase + "234567", "alphanumeric": string.ascii_letters + string.digits, "base64": string.ascii_letters + string.digits + "+/"}


def key(rng, letters, n):
    while True:
        own = "".join(rng.choices(letters, k=n))
        if any(c.isdigit() for c in own) and any(c.isalpha() for c in own):
            return own


def identifier(rng, n):
    """Words and a few digits, as names of files and variables have them."""
    out = ""
    while len(out) < n:
        out += rng.choice(["user", "report", "annual", "session", "archive", "temperature", "index"]) + rng.choice(["_", "-", "_0", "_1", "2024"])
    return (out + "1")[-n:] if any(c.isdigit() for c in out) else (out + "1")[-n:]


def test_limits_bound_what_is_reported():
    uniform = {i: n for i in range(60) if (n := round(100_000 * (2.718281828 ** (-i / 10) - 2.718281828 ** (-(i + 1) / 10))))}
    assert secrets.limit_of(uniform)[1] < 0.02 and secrets.limit_of(uniform)[0] > 50
    # As many regular tokens, of which most look random at first sight.
    mixed = {i: uniform.get(i, 0) + (6000 if 8 <= i < 30 else 0) for i in range(60)}
    limit, share = secrets.limit_of(mixed)
    stay = sum(n for i, n in mixed.items() if i < limit)
    false = sum(6000 for i in range(8, 30) if i < limit)
    assert share <= secrets.REPORTED + 0.05 and false / stay <= secrets.REPORTED + 0.1 and limit >= secrets.NEXT_TO_ONE
    assert secrets.limit_of({40: 500}) == (secrets.NEXT_TO_ONE, 0.0) or sum(n for i, n in {40: 500}.items() if i < secrets.limit_of({40: 500})[0]) == 0


@pytest.mark.parametrize("n", [20, 28, 36, 60, 100])
def test_recall_of_keys(spark, n):
    """At least 0.85 of the keys of each encoding are found, and no more than REPORTED of what is reported are identifiers."""
    rng = random.Random(n)
    rows, kind = [], {}
    for encoding, letters in LETTERS.items():
        for _ in range(150):
            kind[len(rows)] = encoding
            rows.append((len(rows), f"see {key(rng, letters.upper() if encoding == 'hex' else letters, n)} there"))
    for _ in range(300):
        kind[len(rows)] = "identifier"
        rows.append((len(rows), f"open {identifier(rng, n)} now"))
    found = {r["doc_id"] for r in secrets.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect() if "random" in r["spans"]}
    share = {k: sum(i in found for i in kind if kind[i] == k) / sum(v == k for v in kind.values()) for k in set(kind.values())}
    assert min(v for k, v in share.items() if k != "identifier") >= 0.85, share
    assert sum(kind[i] == "identifier" for i in found) <= (secrets.REPORTED + 0.1) * len(found), share
