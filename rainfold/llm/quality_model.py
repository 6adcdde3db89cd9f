"""Quality classifier by hierarchical empirical Bayes.

Two questions are asked of each document, whether its quality is good and whether it is toxic, each in the same way:

1. Evidence. A logistic regression over hashed words and word shapes, fitted on a bounded sample of labelled rows (the
   ``FIT`` with the smallest hash of doc_id), gives each document a probability. Only features that the sample ties
   to the label beyond chance count.
2. Posteriors of sites. Over all documents, evidence is summed by path (source and language) and by host (source). The global
   mean is the prior of hosts and a host's posterior mean the prior of its paths, with as much weight as the spread between hosts, or
   between paths, warrants (method of moments): sparse sites stay near their prior.
3. A document's probability is combined with the posterior of its path, left out its own part of it.

``kept``: good rather than not, and not toxic. Nulls: a null text has no words, null source and language are values of their own.
Without labels of both kinds the evidence is the prior. Repeated rows stay repeated; a doc_id labelled twice counts once, with the larger label,
and one with several texts with the smallest text. A text of any length counts as a whole, by its distinct words. Other columns are left alone, whatever their names. An
empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rainfold.llm.common import Scratch, per_text, table

FIT, FEATURES = 8192, 1 << 16
#: Chi-squared beyond which a feature counts, ridge and steps of the fit, and the weight of the site's logit.
SIGNIFICANT, RIDGE, STEPS, SITE_WEIGHT = 15.0, 1.0, 300, 0.5
TARGETS = ("quality", "toxic")
WORDS = 300_000


class Features(dict):
    """Numbers of a word's features: the word in lower case without its punctuation, and its shape."""

    def __missing__(self, word: bytes) -> tuple[int, int]:
        if len(self) > WORDS:
            self.clear()
        text = word.decode("utf-8", "surrogatepass")
        shape = re.sub(r"(.)\1+", r"\1", "".join("a" if c.islower() else "A" if c.isupper() else "0" if c.isdigit() else c for c in text))
        out = self[word] = (zlib.crc32(text.lower().strip(".,!?;:").encode("utf-8", "surrogatepass")) % FEATURES, zlib.crc32(b"shape " + shape.encode("utf-8", "surrogatepass")) % FEATURES)
        return out


def features(text: str | None, known: Features) -> np.ndarray:
    """Distinct features of a text, with its length and its share of repeated lines."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    lines = [x for x in raw.split(b"\n") if x and not x.isspace()]
    repeated = 10 * (len(lines) - len(set(lines))) // max(1, len(lines))
    own = (zlib.crc32(b"length %d" % len(words).bit_length()) % FEATURES, zlib.crc32(b"repeated %d" % repeated) % FEATURES)
    found = set(chain.from_iterable(map(known.__getitem__, set(words))))
    found.update(own)
    return np.fromiter(found, np.int64, len(found))


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Evidence:
    """Logistic regression over the features that the sample ties to the label, with a little weight on small coefficients."""

    def __init__(self, rows: list[np.ndarray], label: np.ndarray):
        self.weights, self.shift = np.zeros(FEATURES), 0.0
        n1 = int(label.sum())
        n0 = len(label) - n1
        if not n0 or not n1:
            self.shift = 4.0 if n1 else -4.0 if n0 else 0.0
            return
        have = np.zeros((2, FEATURES))
        for r, y in zip(rows, label):
            have[int(y), r] += 1
        total = have.sum(axis=0)
        expected = total * n1 / len(label)
        chi = (have[1] - expected) ** 2 / np.maximum(expected * n0 / len(label) * (1 - total / len(label)), 1e-9)
        used = np.flatnonzero(chi > SIGNIFICANT)
        at = np.full(FEATURES, -1)
        at[used] = np.arange(len(used))
        x = np.ones((len(rows), len(used) + 1), np.float32)
        for i, r in enumerate(rows):
            x[i, :-1] = 0
            x[i, at[r][at[r] >= 0]] = 1
        keep = np.full(len(used) + 1, RIDGE, np.float32)
        keep[-1] = 0
        v = np.ones(len(used) + 1, np.float32)
        for _ in range(10):
            v = x.T @ (x @ v)
            curve = float(np.linalg.norm(v))
            v /= curve
        step = 1 / (curve / 4 + RIDGE)
        w, z, t = np.zeros(len(v), np.float32), np.zeros(len(v), np.float32), 1.0
        for _ in range(STEPS):  # accelerated gradient descent
            after = z - step * (x.T @ (logistic(x @ z) - label).astype(np.float32) + keep * z)
            t, before = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
            z = after + np.float32((before - 1) / t) * (after - w)
            w = after
        self.weights[used], self.shift = w[:-1], float(w[-1])

    def logit(self, own: np.ndarray) -> float:
        return float(np.clip(self.weights[own].sum() + self.shift, -8, 8))


def fit(docs: DataFrame, labels: DataFrame) -> dict[str, Evidence]:
    """The models. At most FIT labelled doc_ids come to the driver, each once, as at most FEATURES numbers."""
    once = labels.where("doc_id is not null").groupBy("doc_id").agg(*(F.max(F.col(t).cast("int")).alias(t) for t in TARGETS))
    sample = once.orderBy(F.xxhash64("doc_id"), "doc_id").limit(FIT)

    def run(ids: list, texts: list, *targets: list) -> dict:
        known = Features()
        return {"doc_id": ids, "own": [features(t, known) for t in texts], **dict(zip(TARGETS, targets))}

    found = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").groupBy("doc_id", *TARGETS).agg(F.min("text").alias("text"))
    found = per_text(found, run, "doc_id long, own array<long>, quality int, toxic int", *TARGETS).collect()
    out = {}
    for t in TARGETS:
        rows = sorted((r for r in found if r[t] is not None), key=lambda r: r["doc_id"])
        out[t] = Evidence([np.array(r["own"], np.int64) for r in rows], np.array([r[t] for r in rows], np.float64))
    return out


def weight_of(sites: DataFrame, mean: str, n: str, prior: str) -> float:
    """Pseudo-documents of a prior: the variance within sites over that between them, by moments."""
    row = sites.agg(
        F.sum(n).alias("n"), F.sum(F.col(n) * F.col(n)).alias("nn"), F.count("*").alias("sites"),
        F.sum(F.col(n) * F.col(prior) * (1 - F.col(prior))).alias("within"), F.sum(F.col(n) * F.pow(F.col(mean) - F.col(prior), 2)).alias("between"),
    ).first()
    if not row["n"] or row["sites"] < 2:
        return 1e6
    within = row["within"] / row["n"]
    spread = (row["between"] - row["sites"] * within) / max(row["n"] - row["nn"] / row["n"], 1e-9)
    return float(min(max(within / spread - 1, 1.0), 1e6)) if spread > 0 else 1e6


def logit(p):
    p = F.least(F.greatest(p, F.lit(1e-4)), F.lit(1 - 1e-4))
    return F.log(p / (1 - p))


def with_sites(scored: DataFrame, scratch: Scratch) -> DataFrame:
    """Adds for each target ``<target>_host``, ``<target>_path`` and ``<target>``, the posteriors of the document's site and of itself.

    Evidence is summed once, within tasks first, so a site that holds most of the rows is a row a task. The table of paths is broadcast if it is small, else
    a large site's rows are split by adaptive execution, as both sides of the join come straight from a shuffle.
    """
    sums = lambda n, c: [F.sum(n).alias("n"), *(F.sum(f"{c}_{t}").alias(f"s_{t}") for t in TARGETS)]
    paths = scratch.write(scored.withColumn("one", F.lit(1).cast("long")).groupBy("host", "lang").agg(*sums("one", "p")))
    hosts = scratch.write(paths.groupBy("host").agg(*sums("n", "s")))
    total = hosts.agg(*sums("n", "s")).first()
    overall = {t: total[f"s_{t}"] / total["n"] if total["n"] else 0.5 for t in TARGETS}
    weights = {}
    for t in TARGETS:
        k = weight_of(hosts.withColumns({"prior": F.lit(overall[t]), "mean": F.col(f"s_{t}") / F.col("n")}), "mean", "n", "prior")
        hosts = hosts.withColumn(f"{t}_host", (F.col(f"s_{t}") + k * overall[t]) / (F.col("n") + k))
    paths = paths.join(hosts.select("host", *(f"{t}_host" for t in TARGETS)), "host")
    for t in TARGETS:
        weights[t] = weight_of(paths.withColumn("mean", F.col(f"s_{t}") / F.col("n")), "mean", "n", f"{t}_host")
    out = scored.join(scratch.sized(scratch.write(paths)), ["host", "lang"])
    for t in TARGETS:
        p, k, prior = F.col(f"p_{t}"), weights[t], F.col(f"{t}_host")
        others = (F.col(f"s_{t}") - p + k * prior) / (F.col("n") - 1 + k)
        final = 1 / (1 + F.exp(-(logit(p) + SITE_WEIGHT * (logit(others) - logit(F.lit(overall[t]))))))
        out = out.withColumns({f"{t}_path": (F.col(f"s_{t}") + k * prior) / (F.col("n") + k), t: final})
    return out.select("doc_id", "host", "lang", *(c for t in TARGETS for c in (f"p_{t}", f"{t}_host", f"{t}_path", t)))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, for each target the evidence ``p_<target>``, the posteriors of host, path and document, and ``kept``."""
    scratch, models = Scratch(docs.sparkSession, "quality"), fit(docs, labels)

    def run(ids: list, texts: list, hosts: list, langs: list) -> dict:
        known = Features()
        own = [features(t, known) for t in texts]
        return {"doc_id": ids, "host": hosts, "lang": langs} | {f"p_{t}": logistic(np.array([m.logit(o) for o in own])) for t, m in models.items()}

    schema = "doc_id long, host string, lang string, " + ", ".join(f"p_{t} double" for t in TARGETS)
    out = scratch.write(per_text(docs, run, schema, *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(to) for c, to in (("source", "host"), ("lang", "lang")))))
    return with_sites(out, scratch).withColumn("kept", (F.col("quality") >= 0.5) & (F.col("toxic") < 0.5)).drop("host", "lang")


def op5_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
