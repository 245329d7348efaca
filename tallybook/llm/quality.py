"""Quality rules: a table of thresholds compiled into one projection of Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
#: Common short words of the four languages of the corpus.
STOP_WORDS = (
    "the a an of to in and is that it for on was with as by at be this are from or have not they you "
    "der die das und ist nicht ein eine zu den von mit sich auf dem für im sie es auch "
    "le la les de des et est un une que qui dans pour sur pas en du au ce il "
    "el los las y es un una que en no se por con para su al lo del"
).split()
#: name of the ratio, least, most: a text is kept if each ratio lies inside its bounds.
THRESHOLDS = (
    ("word_length", 2.0, 15.0),  # code points of words to words
    ("symbol_share", 0.0, 0.1),  # symbols to words
    ("stop_share", 0.02, 1.0),  # stop words to words
    ("exclaim_share", 0.0, 0.3),  # words that end with ! to words
    ("upper_share", 0.0, 0.6),  # words of capitals only, of two or more, to words
    ("dup_line_share", 0.0, 0.4),  # repeated lines to lines with a word
)
LEAST_WORDS = 20
MOST_REPEATED = 0.3  # words in repeated windows to words


def without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def counted(documents: DataFrame) -> DataFrame:
    """doc_id and the counts that the rules compare, of each whole text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.filter(F.split(F.translate(text, BLANKS, " " * len(BLANKS)), " "), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda line: F.length(without(line, BLANKS)) > 0)
    frame = documents.select(
        F.col("doc_id"),
        F.length(without(text, BLANKS)).cast("long").alias("word_chars"),
        (F.length(text) - F.length(without(text, SYMBOLS))).cast("long").alias("n_symbols"),
        lines.alias("lines"),
        words.alias("words"),
    )
    frame = frame.select(
        "doc_id",
        "word_chars",
        "n_symbols",
        F.size("words").cast("long").alias("n_words"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.filter("words", lambda w: F.lower(w).isin(STOP_WORDS))).alias("n_stop"),
        F.size(F.filter("words", lambda w: w.endswith("!"))).alias("n_exclaim"),
        F.size(F.filter("words", lambda w: (w == F.upper(w)) & (w != F.lower(w)) & (F.length(w) > 1))).alias("n_upper"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("word_hashes"),
    )
    frame = frame.withColumn(
        "windows",
        F.when(F.col("n_words") < WINDOW, F.array().cast("array<long>")).otherwise(
            F.transform(
                F.sequence(F.lit(1), F.col("n_words").cast("int") - WINDOW + 1),
                lambda i: F.xxhash64(F.slice("word_hashes", i, WINDOW)),
            )
        ),
    ).drop("word_hashes")
    # Windows in the order of their hashes: equal ones stand side by side. Only for texts that have some.
    at = F.struct(F.lit(None).cast("long").alias("h"), F.lit(0).alias("i"))
    frame = frame.withColumn(
        "sorted",
        F.when(
            F.size(F.array_distinct("windows")) < F.size("windows"),
            F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ).otherwise(F.array(at).cast("array<struct<h:bigint,i:int>>")),
    ).drop("windows")
    frame = frame.withColumn(
        "places",
        F.array_sort(
            F.transform(
                F.filter(
                    "sorted",
                    lambda x, k: (x["h"] == F.get(F.col("sorted"), k - 1)["h"]) | (x["h"] == F.get(F.col("sorted"), k + 1)["h"]),
                ),
                lambda x: x["i"],
            )
        ),
    ).drop("sorted")
    covered = F.aggregate(
        F.transform("places", lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(F.col("places"), k + 1) - p, F.lit(WINDOW)))),
        F.lit(0).cast("long"),
        lambda total, x: total + x,
    )
    return frame.withColumn("n_repeat_words", covered).drop("places")


def compiled(thresholds: tuple[tuple[str, float, float], ...] = THRESHOLDS) -> Column:
    """True where every ratio of the table lies inside its bounds; no words make all ratios 0."""
    words, lines = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("n_lines"), F.lit(1))
    ratios = {
        "word_length": F.col("word_chars") / words,
        "symbol_share": F.col("n_symbols") / words,
        "stop_share": F.col("n_stop") / words,
        "exclaim_share": F.col("n_exclaim") / words,
        "upper_share": F.col("n_upper") / words,
        "dup_line_share": F.col("n_dup_lines") / lines,
    }
    verdict = F.lit(True)
    for name, least, most in thresholds:
        verdict = verdict & ratios[name].between(least, most)
    return verdict


def judged(documents: DataFrame, thresholds: tuple[tuple[str, float, float], ...] = THRESHOLDS) -> DataFrame:
    """doc_id, counts, base_failed and kept, one row per row of ``documents``.

    Base: at least 20 words, and at most 0.3 of them in windows of eight words that occur twice or more;
    then the table decides. Null and empty texts have no words and fail. Repeated rows get equal rows.
    Columns other than doc_id and text are not read.
    """
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > int(100 * MOST_REPEATED) * F.col("n_words"))
    return counted(documents).withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & compiled(thresholds))
