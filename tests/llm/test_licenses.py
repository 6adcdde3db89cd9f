"""Versions are exact, and many notices in a text are told apart in order."""

import pytest

from rainfold.llm import licenses


@pytest.mark.parametrize(
    ("text", "labels"),
    [
        ("licensed under the gnu general public license version 1", []),
        ("licensed under the gnu general public license version 20", []),
        ("licensed under the apache license version 1 1", []),
        ("licensed under the apache license version 2 0", ["apache-2"]),
        ("licensd under the apache license version 2 only", ["apache-2"]),
        ("licensed under the gnu general publik license version 3 0", ["gpl-3"]),
        ("licensd under the gnu generl public license version 2 licensed under the gnu general public license version 3", ["gpl-2", "gpl-3"]),
        ("released under the 3 mit license", []),
        ("", []),
    ],
)
def test_versions_are_exact(text, labels):
    assert [s[2] for s in licenses.Search(licenses.NOTICES).spans(text)] == labels


def test_many_notices_and_their_words(spark):
    n = 300
    text = "é 1 " + " ".join(["All rights reserved; released under the MIT licence."] * n)
    (row,) = licenses.scan(spark.createDataFrame([(1, text, "x")], "doc_id long, text string, `n.words` string")).collect()
    spans = [s.split(":") for s in row["notices"].split(",")]
    assert [s[2] for s in spans] == ["all-rights-reserved", "mit"] * n
    assert [(int(s[0]), int(s[1])) for s in spans] == [(2 + 8 * k + o, 2 + 8 * k + o + w) for k in range(n) for o, w in ((0, 2), (3, 4))]
    assert (row["n_words"], row["n_base"], row["labels"]) == (2 + 8 * n, 0, "all-rights-reserved,mit")
