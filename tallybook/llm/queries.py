"""The queries of the operators of this subpackage, over whole tables, and their SQL for DuckDB."""

from __future__ import annotations

import functools
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.llm import dartminhash, divergence, fill_middle, mixing, neighbours, ngram_join, packing, personal_data, quality, repeats, secret_scan
from tallybook.llm import sharding, toxicity
from tallybook.llm.staging import Staging

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def importable(spark: SparkSession) -> None:
    """Let the tasks' Python find this package, where the session names no path of its own."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))


def query(function):
    """Register a query."""

    @functools.wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        importable(spark)
        return function(spark, sf_dir)

    QUERIES[function.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of near equal bytes; equal texts share a shard."""
    found = sharding.shard(table(spark, sf_dir, "documents"), 16, Staging(spark))
    return found.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as pieces of at most 4096 ids in as few sequences as best-two-fit gets."""
    return packing.pack(table(spark, sf_dir, "documents"), Staging(spark))


@query
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A toxicity score of every document, by a classifier that never saw the held-out fold."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(documents, table(spark, sf_dir, "labels"), Staging(spark))
    return toxicity.scored(documents, model, "score").select(
        "doc_id",
        (toxicity.fold(F.col("doc_id")) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@query
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of the quality rules for every document."""
    columns = "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept"
    return quality.judged(table(spark, sf_dir, "documents")).select(*columns.split())


@query
def op2_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the words of 20-word windows that start earlier in the corpus."""
    found = repeats.without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), Staging(spark))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.encode("kept_text", "UTF-8"), 256).alias("kept_sha256"))


ORACLE_SQL["op2_repeats"] = r"""
WITH words AS (
    SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
    FROM documents
), windows AS (
    SELECT doc_id, i AS start, md5(array_to_string(w[i:i + 19], ' ')) AS content
    FROM words, unnest(range(1, len(w) - 18)) AS t(i)
), repeated AS (
    SELECT doc_id, start FROM windows
    QUALIFY row_number() OVER (PARTITION BY content ORDER BY doc_id, start) > 1
), covered AS (
    SELECT DISTINCT doc_id, start + k AS i FROM repeated, range(20) AS t(k)
), single AS (
    SELECT doc_id, i, w[i] AS word FROM words, unnest(range(1, len(w) + 1)) AS t(i)
), kept AS (
    SELECT s.doc_id, count(*) AS n, string_agg(s.word, ' ' ORDER BY s.i) AS text
    FROM single s ANTI JOIN covered c ON s.doc_id = c.doc_id AND s.i = c.i GROUP BY s.doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)
"""


@query
def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate class of every document."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dartminhash.classes(documents, Staging(spark)).select("doc_id", "class_id")


# All links, of which the buckets miss one of 0.8 similarity with a probability of 0.0001, and none here.
ORACLE_SQL["op7_near_duplicates"] = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents
), bags AS (
    SELECT doc_id, s, count(*) AS n
    FROM (SELECT doc_id, array_to_string(w[i:i + 4], ' ') AS s FROM words, unnest(range(1, greatest(len(w) - 3, 2))) AS t(i) WHERE len(w) > 0)
    GROUP BY ALL
), weights AS (
    SELECT doc_id, sum(n) AS total FROM bags GROUP BY doc_id
), shared AS (
    SELECT x.doc_id AS a, y.doc_id AS b, sum(least(x.n, y.n)) AS c FROM bags x JOIN bags y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL
), links AS (
    SELECT a, b FROM shared JOIN weights x ON x.doc_id = a JOIN weights y ON y.doc_id = b WHERE 100 * c >= 80 * (x.total + y.total - c)
    UNION
    SELECT x.doc_id, y.doc_id FROM documents x JOIN documents y ON x.text IS NOT DISTINCT FROM y.text AND x.doc_id <> y.doc_id
), reach AS (
    SELECT doc_id AS a, doc_id AS b FROM documents
    UNION
    SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b
)
SELECT a AS doc_id, min(b) AS class_id FROM reach GROUP BY a
"""


_STOP_WORDS = ", ".join(f"'{w}'" for w in sorted(set(quality.STOP_WORDS)))
_RATIOS = {
    "word_length": "word_chars / greatest(n_words, 1)",
    "symbol_share": "n_symbols / greatest(n_words, 1)",
    "stop_share": "n_stop / greatest(n_words, 1)",
    "exclaim_share": "n_exclaim / greatest(n_words, 1)",
    "upper_share": "n_upper / greatest(n_words, 1)",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
}
ORACLE_SQL["op5_quality"] = rf"""
WITH words AS (
    SELECT doc_id, coalesce(text, '') AS t,
           list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w,
           list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
    FROM documents
), windows AS (
    SELECT doc_id, i, md5(array_to_string(w[i:i + 7], ' ')) AS content FROM words, unnest(range(1, len(w) - 6)) AS x(i)
), repeated AS (
    SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, content) > 1
), covered AS (
    SELECT doc_id, count(DISTINCT i + k) AS n FROM repeated, range(8) AS x(k) GROUP BY doc_id
), counts AS (
    SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
           length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
           (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, len(lines) AS n_lines,
           coalesce(covered.n, 0)::BIGINT AS n_repeat_words,
           len(list_filter(w, lambda x: lower(x) IN ({_STOP_WORDS}))) AS n_stop,
           len(list_filter(w, lambda x: ends_with(x, '!'))) AS n_exclaim,
           len(list_filter(w, lambda x: x = upper(x) AND x <> lower(x) AND length(x) > 1)) AS n_upper
    FROM words LEFT JOIN covered USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT base_failed AND {" AND ".join(f"{_RATIOS[n]} BETWEEN {low} AND {high}" for n, low, high in quality.THRESHOLDS)} AS kept
FROM counts
"""


@query
def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document: those of the base patterns, and strings that look random."""
    found = secret_scan.scan(table(spark, sf_dir, "documents"), Staging(spark))
    base = secret_scan.written(F.filter("spans", lambda s: s["kind"] < 3))
    return found.select(
        "doc_id",
        "n_assign",
        "n_access",
        "n_hex",
        F.sha2(F.encode(base, "UTF-8"), 256).alias("base_sha256"),
        secret_scan.written(F.col("spans")).alias("spans"),
    )


_KIND_PATTERNS = [(p, g) for _, p, g, _ in secret_scan.BASE] + [(f"{secret_scan.CANDIDATE}{{{secret_scan.LEAST_LENGTH},}}", 0)]
_LEAST = [n for *_, n in secret_scan.BASE] + [secret_scan.LEAST_LENGTH]


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


# The samples that the models are fitted on hold all rows here: their bounds are not reached at this size.
ORACLE_SQL["op10_secrets"] = rf"""
WITH docs AS (
    SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents
), runs AS (
    {" UNION ALL ".join(f"SELECT row, {k} AS kind, regexp_extract_all(text, {_quoted(p)}, 0) AS w, regexp_extract_all(text, {_quoted(p)}, {g}) AS v, regexp_split_to_array(text, {_quoted(p)}) AS gaps FROM docs" for k, (p, g) in enumerate(_KIND_PATTERNS))}
), matches AS (
    SELECT row, kind, v[i] AS value, (list_sum(list_transform(gaps[1:i], lambda x: length(x))) + list_sum(list_transform(w[1:i], lambda x: length(x))))::BIGINT AS stop,
           stop - length(w[i]) AS start
    FROM runs, unnest(range(1, len(w) + 1)) AS t(i) WHERE length(v[i]) >= [{", ".join(map(str, _LEAST))}][kind + 1]
), base AS (
    SELECT * FROM matches WHERE kind < 3
), random AS (
    SELECT DISTINCT value FROM base WHERE length(value) >= {secret_scan.LEAST_LENGTH} AND regexp_full_match(value, '{secret_scan.CANDIDATE}+')
), ordinary AS (
    SELECT value, count(*) AS times FROM (SELECT unnest(regexp_extract_all(text, '{secret_scan.CANDIDATE}{{8,}}')) AS value FROM docs)
    WHERE NOT regexp_matches(value, '{secret_scan.HINT["hex"]}|{secret_scan.HINT["access"]}|^[0-9]+$') AND value NOT IN (SELECT value FROM base) GROUP BY value HAVING count(*) > 1
), pairs AS (
    SELECT model, value[i:i + 1] AS pair, sum(times) AS n
    FROM (SELECT 1 AS model, value, 1 AS times FROM random UNION ALL SELECT 2, value, times FROM ordinary), unnest(range(1, length(value))) AS t(i) GROUP BY ALL
), letters AS (
    SELECT unnest(string_split('{secret_scan.ALPHABET}', '')) AS c
), cells AS (
    SELECT m.model, a.c AS one, b.c AS two, coalesce(n, 0)::DOUBLE AS n
    FROM letters a, letters b, (VALUES (1), (2)) m(model) LEFT JOIN pairs ON pairs.model = m.model AND pairs.pair = a.c || b.c
), single AS (
    SELECT model, two, {secret_scan.BACKOFF} * (1 + sum(n)) / sum(1 + sum(n)) OVER (PARTITION BY model) AS share FROM cells GROUP BY model, two
), chances AS (
    SELECT model, one || two AS pair, (n + share) / (sum(n) OVER (PARTITION BY model, one) + {secret_scan.BACKOFF}) AS p
    FROM cells JOIN single USING (model, two)
), weights AS (
    SELECT x.pair, ln(x.p / y.p) AS weight FROM chances x JOIN chances y ON x.pair = y.pair AND x.model = 1 AND y.model = 2
), scored AS (
    SELECT row, start, stop, sum(weight) AS score
    FROM (SELECT row, start, stop, unnest(list_transform(range(1, length(value)), lambda i: value[i:i + 1])) AS pair FROM matches WHERE kind = 3 AND regexp_matches(value, '[A-Za-z]'))
    JOIN weights USING (pair) GROUP BY row, start, stop
), spans AS (
    SELECT row, kind, start, stop FROM base
    UNION ALL
    SELECT s.row, 3, s.start, s.stop FROM scored s
    WHERE score >= {secret_scan.LEAST_RATIO} AND NOT EXISTS (SELECT 1 FROM base b WHERE b.row = s.row AND b.start < s.stop AND s.start < b.stop)
), texts AS (
    SELECT *, ['assign', 'access', 'hex', 'random'][kind + 1] || ':' || start || ':' || stop AS text FROM spans
)
SELECT d.doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
       sha256(coalesce(string_agg(x.text, ',' ORDER BY start, kind) FILTER (kind < 3), '')) AS base_sha256,
       coalesce(string_agg(x.text, ',' ORDER BY start, kind), '') AS spans
FROM docs d LEFT JOIN texts x USING (row) GROUP BY row, d.doc_id
"""


@query
def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: that of the base patterns, and what the random field adds."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = personal_data.scanned(documents, personal_data.fit(documents, Staging(spark)))
    kinds = F.transform("base_spans", lambda s: s["kind"])
    counts = [
        (F.size("base_spans") - F.size(F.array_remove(kinds, i))).cast("long").alias(f"n_{kind}")
        for i, kind in enumerate(personal_data.KINDS)
    ]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(F.encode(personal_data.written(F.col("base_spans")), "UTF-8"), 256).alias("base_sha256"),
        personal_data.written(F.concat("base_spans", "added_spans")).alias("spans"),
    )


@query
def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of every document in the mixture of its sources, weighted by the root of their sizes."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "source")
    return mixing.mixed(documents).select("doc_id", "source", "mixture.*")


@query
def op6_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors of every 50th vector, against all rows."""
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, Staging(spark))


@query
def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far every source is from the others of its language, and its ten most telling terms."""
    found = divergence.audit(table(spark, sf_dir, "documents"), Staging(spark))
    return found.select("lang", "source", "part", "item", "value", "rank")


ORACLE_SQL["op11_divergence"] = r"""
WITH docs AS (
    SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text
    FROM documents
), terms AS (
    SELECT row, lang, source, translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
    FROM (SELECT row, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM docs)
), kept AS (
    SELECT lang, term FROM terms GROUP BY lang, term HAVING count(DISTINCT row) >= 10
), groups AS (
    SELECT DISTINCT lang, source FROM docs
), counts AS (
    SELECT lang, source, term, count(*) AS n FROM terms SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term
), cells AS (
    SELECT g.lang, g.source, k.term, coalesce(c.n, 0)::HUGEINT AS n
    FROM groups g JOIN kept k ON k.lang = g.lang LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), p AS (
    SELECT lang, source, term, n, 1 + (1000000000 * (n + 2)) // (sum(n) OVER w + 2 * count(*) OVER w) AS p
    FROM cells WINDOW w AS (PARTITION BY lang, source)
), whole AS (
    SELECT lang, term, sum(n)::HUGEINT AS n FROM cells GROUP BY lang, term
), q AS (
    SELECT lang, term, 1 + (1000000000 * (n + 2)) // (sum(n) OVER w + 2 * count(*) OVER w) AS q
    FROM whole WINDOW w AS (PARTITION BY lang)
), pair AS (
    SELECT a.lang, a.source, b.source AS item, coalesce(v.value, 0)::BIGINT AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN (
        SELECT x.lang, x.source, y.source AS other, sum(((x.p - y.p) * (x.p - y.p)) // (x.p + y.p)) AS value
        FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL
    ) v ON v.lang = a.lang AND v.source = a.source AND v.other = b.source
), term AS (
    SELECT p.lang, p.source, p.term AS item, (((p - q) * (p - q)) // (p + q))::BIGINT AS value
    FROM p JOIN q ON q.lang = p.lang AND q.term = p.term WHERE n > 0 AND p > q
), ranked AS (
    SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM pair
    UNION ALL
    SELECT lang, source, 'term', item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) FROM term
)
SELECT lang, source, part, item, value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""


@query
def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document rearranged for filling in its middle, and back."""
    made = fill_middle.fill_middle(table(spark, sf_dir, "documents"))
    back = fill_middle.restored(F.col("output"), F.col("form"))
    digests = [F.sha2(F.encode(c, "UTF-8"), 256).alias(f"{name}_sha256") for name, c in (("output", F.col("output")), ("restored", back))]
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


ORACLE_SQL["op12_fill_middle"] = r"""
WITH units AS (
    SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || doc_id) AS h,
           regexp_extract_all(t, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u
    FROM documents
), drawn AS (
    SELECT doc_id, t, u, len(u) AS n, ('0x' || h[1:8])::BIGINT % (n + 1) AS one, ('0x' || h[9:16])::BIGINT % (n + 1) AS two,
           t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR ('0x' || h[17:24])::BIGINT % 100 >= 50 AS plain,
           ('0x' || h[25:32])::BIGINT % 100 < 80 AS spm
    FROM units
), cut AS (
    SELECT *, array_to_string(u[1:least(one, two)], '') AS prefix, array_to_string(u[least(one, two) + 1:greatest(one, two)], '') AS middle,
           array_to_string(u[greatest(one, two) + 1:n], '') AS suffix
    FROM drawn
)
SELECT doc_id, n::BIGINT AS n, CASE WHEN plain THEN 'plain' WHEN spm THEN 'spm' ELSE 'psm' END AS form,
       CASE WHEN NOT plain THEN length(prefix)::BIGINT END AS prefix_chars, CASE WHEN NOT plain THEN length(middle)::BIGINT END AS middle_chars,
       sha256(CASE WHEN plain THEN t WHEN spm THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle
                   ELSE '<P>' || prefix || '<S>' || suffix || '<M>' || middle END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM cut
"""


@query
def op13_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The component of every document under links of 0.9 similarity on three-word shingles."""
    return ngram_join.joined(table(spark, sf_dir, "documents"), Staging(spark))


ORACLE_SQL["op13_ngram_join"] = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
    FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS s FROM words, unnest(range(1, greatest(len(w) - 1, 2))) AS t(i) WHERE len(w) > 0
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL
), links AS (
    SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 90 * (x.n + y.n - c)
), reach AS (
    SELECT doc_id AS a, doc_id AS b FROM documents
    UNION
    SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b
)
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, min(r.b) AS component_id
FROM documents d LEFT JOIN sizes s USING (doc_id) JOIN reach r ON r.a = d.doc_id GROUP BY ALL
"""
