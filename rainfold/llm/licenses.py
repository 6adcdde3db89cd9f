"""License scans: fuzzy search for short notices.

A text becomes its words (ASCII letters lower-cased; runs of letters, digits and non-ASCII characters) joined by
single spaces. A notice may differ from its wording by ``len // ERROR_SHARE`` edits of characters, k at most. Cut into
k + 1 pieces, one of them must occur exactly, so the pieces of all notices are searched at once with one automaton,
and only around a hit does the regex library match the notice with at most k errors and report the span. Numbers are no errors: those
within the span, as whole words, must be the notice's own, so one version isn't taken for another.

The base phrases are searched exactly, as consecutive words, and always count.

Nulls: a null text is empty. Texts without a license have empty labels and a score of 0. Repeated rows stay
repeated. A text of any length is searched as a whole, in time proportional to its words and hits. Other columns are left alone, whatever their names. An empty table gives
an empty result.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from itertools import accumulate

import ahocorasick
import regex
from pyspark.sql import DataFrame, SparkSession

from rainfold.llm.common import per_text, table, words_of

BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
#: Wording of short notices, by label.
NOTICES = {
    "released under the mit license": "mit",
    "licensed under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy of this software": "mit",
    "licensed under the apache license version 2": "apache-2",
    "licensed under the apache license version 2 0": "apache-2",
    "you may not use this file except in compliance with the license": "apache-2",
    "licensed under the gnu general public license version 3": "gpl-3",
    "licensed under the gnu general public license version 2": "gpl-2",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "licensed under the bsd 2 clause license": "bsd",
    "licensed under the bsd 3 clause license": "bsd",
    "subject to the terms of the mozilla public license": "mpl",
    "licensed under the mozilla public license version 2 0": "mpl",
    "licensed under the eclipse public license version 2 0": "epl",
    "licensed under the boost software license version 1 0": "boost",
    "licensed under the artistic license version 2 0": "artistic",
    "dedicated to the public domain under the cc0 1 0 universal dedication": "cc0",
    "licensed under the creative commons attribution noncommercial license": "cc-by-nc",
    "licensed under the creative commons attribution sharealike license": "cc-by-sa",
    "licensed under the creative commons attribution license": "cc-by",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "permission to use copy modify and or distribute this software for any purpose": "isc",
    "all rights reserved": "all-rights-reserved",
}
ERROR_SHARE = 12


class Search:
    """Automaton of the pieces of all notices, and each notice's pattern with bounded errors."""

    def __init__(self, notices: dict[str, str]):
        self.notices = [(n, label, len(n) // ERROR_SHARE) for n, label in notices.items()]
        self.patterns = [regex.compile(f"(?b)(?:{regex.escape(n, literal_spaces=True)}){{e<={k}}}") for n, _, k in self.notices]
        self.numbers = [numbers(n, 0, len(n)) for n in notices]
        pieces: dict[str, list[tuple[int, int]]] = {}
        for i, (n, _, k) in enumerate(self.notices):
            cuts = [len(n) * j // (k + 1) for j in range(k + 2)]
            for a, b in zip(cuts, cuts[1:]):
                pieces.setdefault(n[a:b], []).append((i, a))
        self.automaton = ahocorasick.Automaton()
        for piece, where in pieces.items():
            self.automaton.add_word(piece, (len(piece), where))
        if pieces:
            self.automaton.make_automaton()

    def spans(self, text: str) -> list[tuple[int, int, str, int, int]]:
        """(start, end, label, edits, length of the notice) of the notices found, by start; of overlapping ones the closest."""
        areas: dict[tuple[int, int, int], None] = {}
        for end, (size, where) in self.automaton.iter(text) if len(self.automaton) else ():
            for i, shift in where:
                n, _, k = self.notices[i]
                areas[i, max(0, end + 1 - size - shift - k), end + 1 - size - shift + len(n) + k] = None
        found: dict[tuple, None] = {}  # each seed's area is searched by itself, so that the best match of one seed hides no other's
        for i, a, b in areas:
            n, label, _ = self.notices[i]
            for m in self.patterns[i].finditer(text[a:b]):
                if numbers(text, a + m.start(), a + m.end()) == self.numbers[i]:
                    found[a + m.start(), a + m.end(), label, sum(m.fuzzy_counts), len(n)] = None
        kept: list[tuple] = []
        for s in sorted(found, key=lambda s: (s[3] / s[4], -s[4], s[0])):  # of overlapping notices the closest one
            at = bisect_left(kept, s)
            if (not at or kept[at - 1][1] <= s[0]) and (at == len(kept) or s[1] <= kept[at][0]):
                kept.insert(at, s)
        return kept


def numbers(text: str, a: int, b: int) -> list[str]:
    """The words of digits in a span, whole even where they go on beyond it."""
    if a < b and text[a] != " ":
        a = text.rfind(" ", 0, a) + 1
    if a < b and text[b - 1] != " ":
        end = text.find(" ", b)
        b = len(text) if end < 0 else end
    return [w for w in text[a:b].split() if w.isdecimal()]


def scan(docs: DataFrame, notices: dict[str, str] = NOTICES) -> DataFrame:
    """One row a document: counts, labels, score, and ``notices``, the spans found as start word:last word:label:edits."""

    def run(ids: list, texts: list) -> dict:
        search, out = Search(notices), {k: [] for k in ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "notices")}
        for text in texts:
            words = words_of(text)
            joined = b" ".join(words)
            padded, starts, base = b" " + joined + b" ", [], set()
            begins = list(accumulate((len(w) + 1 for w in words), initial=0))
            for phrase, label in BASE.items():
                needle = b" " + phrase.encode() + b" "
                at = padded.find(needle)
                while at >= 0:
                    starts.append(bisect_left(begins, at))
                    base.add(label)
                    at = padded.find(needle, at + 1)
            line = joined.decode("utf-8", "surrogatepass")
            spans = search.spans(line)
            begins = list(accumulate((len(w) + 1 for w in line.split(" ")), initial=0)) if spans else []
            word = lambda at: bisect_right(begins, at) - 1  # noqa: B023, E731
            out["n_words"].append(len(words))
            out["n_base"].append(len(starts))
            out["first_word"].append(min(starts, default=None))
            out["last_word"].append(max(starts, default=None))
            out["base_labels"].append(",".join(sorted(base)))
            out["labels"].append(",".join(sorted(base | {s[2] for s in spans})))
            out["score"].append(1.0 if base else max((1 - edits / size for *_, edits, size in spans), default=0.0))
            out["notices"].append(",".join(f"{word(a + (line[a] == ' '))}:{word(b - 1 - (line[b - 1] == ' '))}:{label}:{edits}" for a, b, label, edits, _ in spans))
        return {"doc_id": ids, **out}

    return per_text(docs, run, "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, notices string")


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
