"""Secrets in texts: fixed patterns, and strings that look random to character Markov models."""

from __future__ import annotations

import string
from math import log

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybook.llm.staging import Staging

#: Kind, pattern, the group whose length counts, its least length; a match is dropped if it is shorter.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
BASE = (
    ("assign", ASSIGN, 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
)
#: What has no such text has no match that stays, so the patterns themselves are spared.
HINT = {"assign": ASSIGN, "access": "AKIA[A-Z0-9]{16}", "hex": "[0-9a-f]{24}"}
KINDS = [kind for kind, *_ in BASE] + ["random"]
ALPHABET = string.ascii_letters + string.digits + "+/_=-"
CANDIDATE = "[A-Za-z0-9+/_=-]"
#: Shorter runs are no candidates; from there on the ratio decides, which grows with the length.
LEAST_LENGTH = 12
#: Weight of a character's own frequency where few pairs are known.
BACKOFF = 10.0
#: A candidate with a letter is a secret if its log-likelihood ratio, random to ordinary, is this much or more.
LEAST_RATIO = 6.0
#: Bounds of the samples: strings that the base patterns found, and documents that give ordinary words.
RANDOM_ROWS = 20_000
ORDINARY_DOCUMENTS = 2_000


def _matches(text: Column, number: int, pattern: str, group: int, least: int, hint: str) -> Column:
    """The matches of a pattern in order: where each starts is the sum of the gaps and lengths before."""
    whole, inner = (F.regexp_extract_all(text, F.lit(pattern), F.lit(g)) for g in (0, group))
    found = F.transform(
        F.arrays_zip(F.split(text, pattern, -1).alias("before"), whole.alias("match"), inner.alias("inner")),
        lambda x, i: F.struct(
            F.lit(number).alias("kind"),
            i.alias("i"),
            F.length(x["before"]).alias("gap"),
            F.length(x["match"]).alias("length"),
            F.coalesce(F.length(x["inner"]) >= least, F.lit(False)).alias("good"),
            F.when(F.length(x["inner"]) >= least, x["inner"]).alias("value"),
        ),
    )
    none = F.array().cast("array<struct<kind:int,i:int,gap:int,length:int,good:boolean,value:string>>")
    return F.when(text.rlike(hint), found).otherwise(none)


def extracted(documents: DataFrame) -> DataFrame:
    """One row per match that stays, of each kind: row, doc_id, kind, start, end, value.

    A document keeps the first match of each kind even if it is dropped (its kind is then null), or a row
    without any, so it is in the result.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    kinds = [*((k, p, g, n, HINT[k]) for k, p, g, n in BASE), ("random", f"{CANDIDATE}{{{LEAST_LENGTH},}}", 0, LEAST_LENGTH, f"{CANDIDATE}{{{LEAST_LENGTH}}}")]
    matches = [_matches(text, number, *rest) for number, (_, *rest) in enumerate(kinds)]
    rows = documents.select("doc_id", F.concat(*matches).alias("matches")).withColumn("row", F.monotonically_increasing_id())
    rows = rows.select("row", "doc_id", F.explode_outer("matches").alias("m")).select("row", "doc_id", "m.*")
    so_far = Window.partitionBy("row", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("gap").cast("long") + F.col("length")).over(so_far)
    placed = rows.withColumn("end", end).withColumn("start", F.col("end") - F.col("length"))
    placed = placed.where(F.col("good") | F.coalesce(F.col("i") == 0, F.lit(True)))
    return placed.select("row", "doc_id", F.when(F.col("good"), F.col("kind")).alias("kind"), "start", "end", "value")


def _pairs(strings: DataFrame) -> DataFrame:
    """How often each pair of neighbouring characters occurs in the column ``value``, each counted ``times``."""
    pair = F.explode(
        F.transform(F.sequence(F.lit(1), F.length("value") - 1), lambda i: F.substring(F.col("value"), i, F.lit(2)))
    )
    return strings.where(F.length("value") > 1).select(pair.alias("pair"), "times").groupBy("pair").agg(F.sum("times").alias("count"))


def _chances(pairs: DataFrame) -> list[list[float]]:
    """Transition probabilities: counts of pairs, and BACKOFF more spread as the second characters are; of
    these each count is raised by one. At most len(ALPHABET) ** 2 rows are fetched."""
    counts = [[0] * len(ALPHABET) for _ in ALPHABET]
    for row in pairs.collect():
        one, two = (ALPHABET.find(c) for c in row["pair"])
        counts[one][two] += row["count"]
    single = [1 + sum(line[k] for line in counts) for k in range(len(ALPHABET))]
    share = [BACKOFF * n / sum(single) for n in single]
    return [[(n + x) / (sum(line) + BACKOFF) for n, x in zip(line, share, strict=True)] for line in counts]


def trained(found: DataFrame, documents: DataFrame) -> list[float]:
    """The log ratio of the two models' transition probabilities, by character pair.

    Random strings are a sample of those that base patterns found and that are long enough; ordinary ones
    are words of eight characters or more that a sample of documents has at least twice, as a random string
    hardly is, without what those patterns take.
    Without random strings their model is uniform.
    """
    clean = f"^{CANDIDATE}+$"
    random = (
        found.where(F.col("kind").isin(0, 1, 2) & (F.length("value") >= LEAST_LENGTH) & F.col("value").rlike(clean))
        .select("value")
        .distinct()
        .orderBy(F.xxhash64("value"), "value")
        .limit(RANDOM_ROWS)
    )
    some = documents.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(ORDINARY_DOCUMENTS)
    texts = documents.join(F.broadcast(some), "doc_id", "left_semi")  # at most ORDINARY_DOCUMENTS ids
    words = texts.select(F.explode(F.regexp_extract_all(F.col("text"), F.lit(f"{CANDIDATE}{{8,}}"), F.lit(0))).alias("value"))
    ordinary = words.where(~F.col("value").rlike(f"{HINT['hex']}|{HINT['access']}|^[0-9]+$"))
    ordinary = ordinary.groupBy("value").agg(F.count(F.lit(1)).alias("times")).where("times > 1")
    ordinary = ordinary.join(found.where("kind in (0, 1, 2)").select("value").distinct(), "value", "left_anti")
    one, two = _chances(_pairs(random.withColumn("times", F.lit(1)))), _chances(_pairs(ordinary))
    return [log(x / y) for a, b in zip(one, two, strict=True) for x, y in zip(a, b, strict=True)]


def ratio(value: Column, table: list[float]) -> Column:
    """The log-likelihood ratio of a string over ALPHABET."""
    place = [max(ALPHABET.find(chr(code)), 0) for code in range(128)]
    code = lambda i: F.get(F.lit(place), F.ascii(F.substring(value, i, F.lit(1))))
    return F.aggregate(
        F.sequence(F.lit(1), F.length(value) - 1),
        F.lit(0.0),
        lambda total, i: total + F.get(F.lit(table), code(i) * len(ALPHABET) + code(i + 1)),
    )


def scan(documents: DataFrame, staging: Staging) -> DataFrame:
    """One row per document: doc_id, counts of each kind, and spans: array of (start, kind, end).

    Spans of a kind don't overlap; start and end count code points. Candidates of the Markov models are
    runs of LEAST_LENGTH or more of ALPHABET with a letter, outside of all base spans. Null texts are empty; rows with repeated
    or null ids get a row each. Very long texts are scanned whole. An empty table gives no rows. Columns other
    than doc_id and text are not read.
    """
    documents = documents.select("doc_id", "text")
    found = staging.table(extracted(documents), "found")
    score = ratio(F.col("value"), trained(found, documents))
    good = found.withColumn("kind", F.when((F.col("kind") < 3) | (F.col("value").rlike("[A-Za-z]") & (score >= LEAST_RATIO)), F.col("kind")))
    base = F.col("kind") < 3
    order = Window.partitionBy("row").orderBy("start", "kind")
    before = F.max(F.when(base, F.col("end"))).over(order.rowsBetween(Window.unboundedPreceding, -1))
    back = Window.partitionBy("row").orderBy(F.desc("start"), F.desc("kind"))  # a running frame, as the other
    after = F.min(F.when(base, F.col("start"))).over(back.rowsBetween(Window.unboundedPreceding, -1))
    free = (F.coalesce(before, F.lit(0)) <= F.col("start")) & (F.coalesce(after, F.col("end")) >= F.col("end"))
    good = good.withColumn("kind", F.when(base | free, F.col("kind")))
    span = F.when(F.col("kind").isNotNull(), F.struct("start", "kind", "end"))
    counts = [F.count(F.when(F.col("kind") == i, 1)).alias(f"n_{kind}") for i, kind in enumerate(KINDS)]
    return good.groupBy("row").agg(F.first("doc_id").alias("doc_id"), *counts, F.array_sort(F.collect_list(span)).alias("spans"))


def written(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    one = lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
    return F.concat_ws(",", F.transform(spans, one))
