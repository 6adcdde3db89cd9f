"""Secret scans with a battery of randomness tests, in DataFrame functions only.

Base spans are those of three patterns. The method adds spans of kind ``random``: long tokens with digits and letters whose
characters look drawn at random.

Of each token the encoding is inferred (decimal, hex, base32, letters and digits, base64), and against it three tests
give p-values of the hypothesis that the token is random: chi-squared of the characters' counts against a uniform alphabet, a runs test on the upper and
lower half of the alphabet, and the serial correlation of neighbours. Fisher's method combines them. Over all tokens of the corpus,
in bands of length (short tokens tell less), the Benjamini-Hochberg procedure finds which are not
random, so that of the tokens put aside at most ``RATE`` are expected to be random ones. Of the others the share of regular tokens is estimated band by band, and where it
is above ``REPORTED`` the band's limit is drawn in until what is reported is below it. The p-values are counted in bins, so only a table of bands and bins comes to the driver.

Offsets are code points. Nulls: a null text is empty. Repeated rows stay repeated. A text of any length is searched as a whole; its matches are one array. Other columns are
left alone, whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rainfold.llm.common import Scratch, table

ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
PATTERNS = {"assign": ASSIGN, "access": r"AKIA[A-Z0-9]{14,}", "hex": r"[0-9a-f]{16,}", "random": r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9])(?=[0-9+/_-]*[A-Za-z])[A-Za-z0-9+/_-]{20,}={0,2}"}
KINDS = list(PATTERNS)
RATE = 0.05
#: The share of regular tokens that may be expected among the random spans of a band.
REPORTED = 0.2
#: Upper lengths of the bands; bins of -10 ln p.
BANDS, BINS = (24, 32, 40, 64, 128), 400
#: Bins of the largest p-values, from which the number of random tokens is estimated.
NEXT_TO_ONE = 6
ALPHABETS = {
    "decimal": ("^[0-9]+$", "0123456789"),
    "hex": ("^(?:[0-9a-f]+|[0-9A-F]+)$", "0123456789abcdef"),
    "base32": ("^[A-Z2-7]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    "alphanumeric": ("^[A-Za-z0-9]+$", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"),
    "base64": ("", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz+/"),
}


def hits(kind: str) -> Column:
    """``(kind, i, gap, hit)`` of every match: ``gap`` is the length of what lies before it and after the last one."""
    if kind == "assign":
        lowered = F.lower("text")
        may = F.lit(False)
        for word in ("password", "passwd", "secret", "token", "apikey", "api_key"):
            may = may | F.contains(lowered, F.lit(word))
    else:
        may = F.contains(F.col("text"), F.lit("AKIA")) if kind == "access" else F.lit(True)
    pattern = PATTERNS[kind]
    zipped = F.arrays_zip(F.split("text", pattern, -1).alias("gap"), F.regexp_extract_all("text", F.lit(pattern), F.lit(0)).alias("hit"))
    named = F.transform(zipped, lambda x, i: F.struct(F.lit(KINDS.index(kind)).alias("kind"), i.alias("i"), F.length(x["gap"]).alias("gap"), x["hit"].alias("hit")))
    return F.when(may, F.filter(named, lambda x: x["hit"].isNotNull()))


def tail(z: Column) -> Column:
    """Upper tail of the normal distribution."""
    z = F.least(F.greatest(z, F.lit(-8.0)), F.lit(8.0))
    return 1 / (1 + F.exp(1.5976 * z + 0.070566 * z * z * z))


def tested(rows: DataFrame) -> DataFrame:
    """Adds ``encoding`` and ``p``, the probability that a random string looks as regular as ``hit``."""
    bare = F.translate(F.regexp_replace("hit", "=+$", ""), "-_", "+/")
    encoding = F.lit(None).cast("string")
    for name, (pattern, _) in reversed(ALPHABETS.items()):
        encoding = F.when(bare.rlike(pattern), name).otherwise(encoding) if pattern else F.lit(name)
    alphabet = F.lit("")
    for name, (_, letters) in ALPHABETS.items():
        alphabet = F.when(F.col("encoding") == name, letters).otherwise(alphabet)
    token = F.when(F.col("encoding") == "hex", F.lower("bare")).otherwise(F.col("bare"))
    rows = rows.withColumn("bare", bare).withColumn("encoding", encoding).withColumn("alphabet", alphabet).withColumn("bare", token)
    rows = rows.withColumn("letters", F.split("bare", "")).withColumn("n", F.length("bare").cast("double")).withColumn("k", F.length("alphabet").cast("double"))
    rows = rows.withColumn("v", F.expr("transform(letters, x -> cast(locate(x, alphabet) - 1 as double))"))
    add = lambda array: F.aggregate(array, F.lit(0.0), lambda a, x: a + x)
    squares = add(F.expr("transform(array_distinct(letters), x -> cast(pow(n - length(replace(bare, x, '')), 2) as double))"))
    rows = rows.withColumns({"squares": squares, "high": add(F.expr("transform(v, x -> if(x >= k / 2, 1.0D, 0.0D))")), "mean": add(F.col("v")) / F.col("n")})
    turns = add(F.expr("zip_with(slice(v, 1, cast(n as int) - 1), slice(v, 2, cast(n as int)), (x, y) -> if((x >= k / 2) <> (y >= k / 2), 1.0D, 0.0D))"))
    lagged = add(F.expr("zip_with(slice(v, 1, cast(n as int) - 1), slice(v, 2, cast(n as int)), (x, y) -> (x - mean) * (y - mean))"))
    spread = add(F.expr("transform(v, x -> (x - mean) * (x - mean))"))
    rows = rows.withColumns({"turns": turns, "lagged": lagged, "spread": spread})
    n, k, n1 = F.col("n"), F.col("k"), F.col("high")
    n0 = n - n1
    chi = (k / n * F.col("squares") - n - (k - 1)) / F.sqrt(2 * (k - 1) * (n - 1) / n)
    expected = 2 * n1 * n0 / n + 1
    variance = (expected - 1) * (expected - 2) / (n - 1)
    runs = F.when(variance > 0, (F.col("turns") + 1 - expected) / F.sqrt(variance)).otherwise(8.0)
    serial = F.when(F.col("spread") > 0, (F.col("lagged") / F.col("spread") + 1 / (n - 1)) * F.sqrt(n)).otherwise(8.0)
    x = -F.log(tail(chi)) - F.log(F.least(F.lit(1.0), 2 * tail(F.abs(runs)))) - F.log(F.least(F.lit(1.0), 2 * tail(F.abs(serial))))
    p = F.exp(-x) * (1 + x + x * x / 2)  # chi-squared with six degrees of freedom, of 2 x
    return rows.withColumn("p", p)


def band() -> Column:
    out = F.lit(len(BANDS))
    for i, upper in reversed(list(enumerate(BANDS))):
        out = F.when(F.length("hit") <= upper, i).otherwise(out)
    return out


def limits(tokens: DataFrame) -> dict[int, tuple[int, float]]:
    """By band the smallest bin that is put aside, and the share of regular tokens estimated among those that stay.

    The p-values of random tokens are uniform, so the bins next to 1, where hardly any others are, tell how many random tokens there are, and with that how many lie below a limit. It
    is the one of the Benjamini-Hochberg procedure or, if that leaves more than REPORTED regular tokens, the largest one that doesn't, two standard deviations of that number allowed, but not within the bins next to 1.
    """
    counts: dict[int, dict[int, int]] = {}
    for b, i, n in tokens.groupBy("band", "bin").count().collect():
        counts.setdefault(b, {})[i] = n
    return {b: limit_of(own) for b, own in counts.items()}


def limit_of(own: dict[int, int]) -> tuple[int, float]:
    """The limit and the estimated share of one band's counts by bin."""
    total, below, limit = sum(own.values()), 0, BINS + 1
    for i in sorted(own, reverse=True):
        below += own[i]
        if math.exp(-i / 10) <= RATE * below / total:  # the largest p of the bin
            limit = i
    near, share = sum(n for i, n in own.items() if i < NEXT_TO_ONE), 1 - math.exp(-NEXT_TO_ONE / 10)
    likely, at_most = near / share, (near + 2 * math.sqrt(near + 1)) / share
    while True:
        stay, part = sum(n for i, n in own.items() if i < limit), 1 - math.exp(-limit / 10)
        if stay * (1 - REPORTED) <= at_most * part or limit <= NEXT_TO_ONE:
            return limit, max(0.0, 1 - min(total, likely) * part / stay) if stay else 0.0
        limit -= 1


def spans(docs: DataFrame, scratch: Scratch, row: Column) -> DataFrame:
    """``(row, doc_id, kind, start, end, aside, rate, hit)``: every span and token; a row with null kind for a text without any."""
    docs = docs.select(row.alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    empty = F.array().cast("array<struct<kind:int,i:int,gap:int,hit:string>>")
    found = docs.select("row", "doc_id", F.explode_outer(F.concat(*(F.coalesce(hits(k), empty) for k in KINDS))).alias("h")).select("row", "doc_id", "h.*")
    so_far = Window.partitionBy("row", "kind").orderBy("i")
    placed = found.withColumn("end", F.sum(F.col("gap") + F.length("hit")).over(so_far)).withColumn("start", F.col("end") - F.length("hit"))
    secret = F.regexp_extract("hit", ASSIGN, 2)
    placed = placed.withColumn("kind", F.when((F.col("kind") != 0) | (F.length(secret) >= 12), F.col("kind")))
    base_end = F.max(F.when(F.col("kind") < 3, F.col("end"))).over(Window.partitionBy("row").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = placed.withColumn("inside", (F.col("kind") == 3) & F.coalesce(base_end >= F.col("end"), F.lit(False)))
    placed = scratch.write(placed.select("row", "doc_id", F.when(~F.col("inside"), F.col("kind")).alias("kind"), "start", "end", "hit"))
    bins = F.least(F.floor(-10 * F.log(F.greatest("p", F.lit(1e-300)))), F.lit(BINS)).cast("int")
    judged = tested(placed.where("kind = 3")).withColumn("bin", bins)
    aside, rate = F.lit(False), F.lit(0.0)
    for b, (i, false) in limits(judged.select(band().alias("band"), "bin")).items():
        aside = aside | ((band() == b) & (F.col("bin") >= i))
        rate = F.when(band() == b, false).otherwise(rate)
    judged = judged.withColumns({"aside": aside, "rate": rate})
    rest = placed.where("kind is null or kind < 3").withColumns({"aside": F.lit(False), "rate": F.lit(None).cast("double")})
    columns = ["row", "doc_id", "kind", "start", "end", "aside", "rate", "hit"]
    return judged.select(*columns).unionByName(rest.select(*columns))


def scan(docs: DataFrame) -> DataFrame:
    """A row for each of ``docs(doc_id, text)``: counts, spans, and ``random_rate``, the share of regular tokens estimated among the random spans of the
    lengths that the text has; NULL if it has none."""
    found = spans(docs, Scratch(docs.sparkSession, "secrets"), F.monotonically_increasing_id())
    names = F.array(*map(F.lit, KINDS))
    text = F.concat_ws(":", F.element_at(names, F.col("kind") + 1), "start", "end")
    mine = F.struct("start", "kind", text.alias("text"))
    base, live = F.col("kind") < 3, F.col("kind").isNotNull() & ~F.col("aside")
    count = lambda kind: F.count(F.when(F.col("kind") == KINDS.index(kind), 1)).alias(f"n_{kind}")
    rate = F.max(F.when(live & (F.col("kind") == 3), F.col("rate"))).alias("random_rate")
    per_text = found.groupBy("row").agg(F.first("doc_id").alias("doc_id"), rate, *map(count, KINDS[:3]), F.array_sort(F.collect_list(F.when(base, mine))).alias("base"), F.array_sort(F.collect_list(F.when(live, mine))).alias("all"))
    return per_text.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(F.array_join(F.col("base.text"), ","), 256).alias("base_sha256"), F.array_join(F.col("all.text"), ",").alias("spans"), "random_rate")


def redacted(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """The rows of ``docs``, with all their columns, with ``mark`` in place of every span. A column ``n_chars`` is counted anew."""
    held = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("all"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    held = held.withColumn("own", F.concat_ws(":", "doc_id", F.xxhash64("text"), F.length("text")))
    once = held.select("doc_id", "text", "own").dropDuplicates(["own"])  # equal rows have the same spans
    found = spans(once, Scratch(docs.sparkSession, "redaction"), F.col("own"))
    live = found.where(F.col("kind").isNotNull() & ~F.col("aside"))
    by_row = live.groupBy(F.col("row").alias("own")).agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("spans"))
    state = "struct<out:string,pos:int>"
    step = f"""aggregate(spans, cast(struct('', 0) as {state}), (a, s) -> if(s.end <= a.pos, a, cast(struct(
        concat(a.out, substr(text, a.pos + 1, greatest(s.start - a.pos, 0)), if(s.start >= a.pos, '{mark}', '')), s.end) as {state})),
        a -> concat(a.out, substr(text, a.pos + 1)))"""
    out = held.join(by_row, "own", "left").withColumn("fresh", F.when(F.col("spans").isNull(), F.col("text")).otherwise(F.expr(step)))
    own = {c: F.col("all")[c] for c in docs.columns} | {"text": F.col("fresh")}
    if "n_chars" in docs.columns:
        own["n_chars"] = F.when(F.col("spans").isNull(), own["n_chars"]).otherwise(F.length("fresh").cast(docs.schema["n_chars"].dataType))
    return out.select(*(column.alias(c) for c, column in own.items()))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
