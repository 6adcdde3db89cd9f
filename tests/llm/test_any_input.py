"""Every operator on rows takes texts of megabytes, and columns whose names it uses itself."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from rainfold.llm import chat, decontamination, licenses, packing, phrases, quality_model, quality_rules, secrets, simhash, suffixes

EXTRA = ["n", "start", "end", "kind", "row", "fp", "node", "key", "words", "a.b", "host", "p_quality", "length", "own", "spans", "all", "hit", "tie", "g", "h", "s0", "n_words", "kept", "band", "batch", "ids", "size", "value"]
LONG = " ".join(f"w{i % 9973} license" if i % 50 == 0 else f"v{i * 7919 % 100_003}" for i in range(400_000))


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(1, LONG, "en", "s"), (2, "short text", "en", "s"), (3, None, None, None), (None, "", "en", "t"), (2, "short text", "en", "s")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").select("*", *(F.lit(i).alias(c) for i, c in enumerate(EXTRA)))


@pytest.fixture(scope="module")
def labels(docs):
    return docs.select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic"), *(F.col(f"`{c}`") for c in EXTRA))


def ids(df):
    return sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in df.select("doc_id").collect())


def test_one_row_a_document(docs, labels):
    want = ids(docs)
    assert ids(simhash.near_duplicates(docs)) == want
    assert ids(quality_model.classify(docs, labels)) == want
    assert ids(licenses.scan(docs)) == want
    assert ids(secrets.scan(docs)) == want
    assert ids(quality_rules.judge(docs, labels)) == want
    assert ids(phrases.dedup(docs)) == want
    assert ids(suffixes.dedup(docs)) == want


def test_counts_of_the_long_text(docs, labels):
    n = len(LONG.split())
    assert {r["n_words"] for r in quality_rules.judge(docs, labels).where("doc_id = 1").collect()} == {n}
    assert {r["n_words"] for r in licenses.scan(docs).where("doc_id = 1").collect()} == {n}
    assert {r["n_bytes"] for r in suffixes.dedup(docs).where("doc_id = 1").collect()} == {len(LONG)}


def test_stages_keep_columns_of_any_name(spark, docs, labels):
    assert secrets.redacted(docs).columns == quality_rules.accepted(docs, labels).columns == simhash.representatives(docs).columns == docs.columns
    benchmark = spark.createDataFrame([(1, "one item of a benchmark that no document here holds at all")], "item_id long, text string").select("*", *(F.lit(i).alias(c) for i, c in enumerate(EXTRA)))
    kept = decontamination.without_leaks(docs, benchmark)
    assert kept.columns == docs.columns and ids(kept) == ids(docs)


def test_packing_holds_every_id_once(docs):
    pieces = packing.pack(docs, public_tokenizers.path(packing.VOCABULARY)).where("doc_id = 1").select("start", "length", "doc_tokens").orderBy("start").collect()
    at = 0
    for r in pieces:
        assert r["start"] == at and r["length"] <= packing.CAPACITY
        at += r["length"]
    assert at == pieces[0]["doc_tokens"] > 400_000


def test_long_turns_are_read_back(spark):
    rows = [(1, 0, "user", LONG), (1, 1, "assistant", "<s>[INST]" + LONG), (None, None, None, None)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").select("*", *(F.lit(i).alias(c) for i, c in enumerate([*EXTRA, "at", "part", "seq", "reset", "taken"])))
    got = {r["conv_id"]: r for r in chat.read_back(chat.format_conversations(turns)).collect()}
    assert [t["text"] for t in got[1]["turns"]] == [LONG, "<s>[INST]" + LONG] and got[1]["loss"] == "<s>[INST]" + LONG and got[None]["loss"] == ""
