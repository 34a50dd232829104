"""Quality rules: counts of each text, and line frequency across the documents of a host."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import keep, pick, words
from tessera.session import sized

SYMBOLS = r"[^#*$%&|<>]+"
WINDOW = 8
MIN_WORDS = 20
REPEAT_PERCENT = 30
#: A line is boilerplate of its host when so many of the host's documents, and this share of them, hold it.
LINE_DOCS = 5
LINE_SHARE = 0.01
#: A document is depleted when fewer words than MIN_WORDS, or less than this share of them, are left.
LEFT_SHARE = 0.5


def base_counts(docs: DataFrame) -> DataFrame:
    """Adds the counts of each text and base_failed; the counts of a null text are 0."""
    blank = F.coalesce(F.col("text"), F.lit(""))
    n = F.size("found") - WINDOW + 1
    found = docs.withColumn("found", words(F.col("text")))
    found = found.withColumn("hashes", F.when(n > 1, F.transform(F.sequence(F.lit(1), n), lambda i: F.xxhash64(F.slice("found", i, F.lit(WINDOW))))))
    # Window hashes beside their places, for the few texts in which one repeats.
    placed = F.array_sort(F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    found = found.withColumn("placed", F.when(F.size(F.array_distinct("hashes")) < F.size("hashes"), placed))
    twice = F.filter("placed", lambda x, k: F.get("placed", k - 1)["h"].eqNullSafe(x["h"]) | F.get("placed", k + 1)["h"].eqNullSafe(x["h"]))
    found = found.withColumn("starts", F.array_sort(F.transform(twice, lambda x: x["i"])))
    steps = F.transform("starts", lambda s, k: F.least(F.coalesce(F.get("starts", k + 1) - s, F.lit(WINDOW)), F.lit(WINDOW)))
    lines = F.filter(F.split(blank, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    found = found.withColumn("held", lines)
    return found.select(
        *docs.columns,
        F.size("found").cast("bigint").alias("n_words"),
        F.char_length(F.array_join("found", "")).cast("bigint").alias("word_chars"),
        F.char_length(F.regexp_replace(blank, SYMBOLS, "")).cast("bigint").alias("n_symbols"),
        (F.size("held") - F.size(F.array_distinct("held"))).cast("bigint").alias("n_dup_lines"),
        F.coalesce(F.aggregate(steps, F.lit(0), lambda total, x: total + x), F.lit(0)).cast("bigint").alias("n_repeat_words"),
    ).withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words")))


def line_hashes(text: Column) -> Column:
    """A hash of each line of a text in lower case with single blanks; null for lines without a word."""
    plain = F.split(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[\x20\x09\x0B-\x0D]+", " "), "\n")
    return F.transform(F.transform(plain, lambda line: F.trim(line)), lambda line: F.when(line != "", F.xxhash64(line)))


def _document(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def frequent_lines(docs: DataFrame, least: int = LINE_DOCS, share: float = LINE_SHARE) -> DataFrame:
    """of, document, n_lines_removed, n_words_gone, frequent: of each different text with lines frequent in its host, these lines.

    A line is frequent that at least `least` documents and `share` of the host's hold; copies of a text count as
    one document. Pairs of text and line are counted by host and line, counts merged before each shuffle, and
    joined with the frequent ones, so neither a host nor a line with a third of all rows is a single task
    and nothing is gathered but the lines of one text.
    """
    line = F.transform(F.arrays_zip(F.split(F.coalesce("text", F.lit("")), "\n").alias("line"), line_hashes(F.col("text")).alias("h")), lambda x: F.struct(x["h"].alias("h"), F.size(words(x["line"])).alias("words")))
    rows = docs.select("host", _document(F.col("text")).alias("document"), F.filter(line, lambda x: x["h"].isNotNull()).alias("lines"))
    rows = keep(rows.dropDuplicates(["host", "document"]), "lines")
    held = sized(rows.groupBy("host").agg(F.count("*").alias("docs")).withColumnRenamed("host", "of"))
    once = F.array_distinct(F.transform("lines", lambda x: x["h"]))
    counts = rows.select("host", F.explode(once).alias("h")).groupBy("host", "h").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    chosen = counts.join(held, F.col("host").eqNullSafe(F.col("of"))).where(F.col("n") >= share * F.col("docs"))
    chosen = sized(keep(chosen.select(F.col("host").alias("of"), F.col("h").alias("known")), "frequent"))
    pairs = rows.select("host", "document", F.inline("lines")).join(chosen, F.col("host").eqNullSafe(F.col("of")) & (F.col("h") == F.col("known")))
    return pairs.groupBy(F.col("host").alias("of"), "document").agg(F.count("*").alias("n_lines_removed"), F.sum("words").alias("n_words_gone"), F.collect_set("h").alias("frequent"))


def quality(docs: DataFrame, host: str = "source", least: int = LINE_DOCS, share: float = LINE_SHARE, left: float = LEFT_SHARE) -> DataFrame:
    """One row per row of docs: doc_id, host, text, the base counts, base_failed, n_lines_removed, n_words_left, cleaned, kept.

    Lines frequent in their host are taken out (cleaned: the text without them); a document is
    kept unless base_failed or depleted, that is with under MIN_WORDS words or `left` of its words
    remaining. A host is a value of the column `host`; null is one too. A null text has no words,
    so base_failed, and cleaned is null. Repeated rows come back alike. An empty table gives no rows.
    Other columns are ignored.
    """
    docs = pick(docs, "doc_id", host, "text").toDF("doc_id", "host", "text")
    touched = sized(keep(frequent_lines(docs, least, share), "touched").withColumnRenamed("document", "touched"))
    rows = base_counts(docs.withColumn("document", _document(F.col("text"))))
    rows = rows.join(touched, F.col("host").eqNullSafe(F.col("of")) & (F.col("document") == F.col("touched")), "left")
    rows = rows.withColumn("n_lines_removed", F.coalesce("n_lines_removed", F.lit(0)).cast("bigint"))
    rows = rows.withColumn("n_words_left", (F.col("n_words") - F.coalesce("n_words_gone", F.lit(0))).cast("bigint"))
    lines = F.arrays_zip(F.split("text", "\n").alias("line"), line_hashes(F.col("text")).alias("h"))
    stay = F.filter(lines, lambda x: ~F.coalesce(F.array_contains("frequent", x["h"]), F.lit(False)))
    cleaned = F.when(F.col("n_lines_removed") > 0, F.array_join(F.transform(stay, lambda x: x["line"]), "\n")).otherwise(F.col("text"))
    depleted = (F.col("n_words_left") < MIN_WORDS) | (F.col("n_words_left") < left * F.col("n_words"))
    rows = rows.withColumn("cleaned", cleaned).withColumn("kept", ~F.col("base_failed") & ~depleted)
    return rows.drop("of", "document", "touched", "n_words_gone", "frequent")


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def op1_quality_rules(spark, sf_dir):
    found = quality(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", *COUNTS, "base_failed", "kept", "n_lines_removed", "n_words_left")


OP1_SQL = f"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, source AS host, text, coalesce(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), []) AS w FROM documents
), win AS (
    SELECT r, i, array_to_string(w[i:i + {WINDOW - 1}], ' ') AS x FROM (SELECT r, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM d)
), twice AS (
    SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, x) AS n FROM win) WHERE n > 1
), rep AS (
    SELECT r, sum(least({WINDOW}, coalesce(nxt - i, {WINDOW})))::BIGINT AS n FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS nxt FROM twice) GROUP BY r
), l AS (
    SELECT r, host, text, line, trim(regexp_replace(lower(line), '[\\x20\\x09\\x0B-\\x0D]+', ' ', 'g'), ' ') AS norm
    FROM (SELECT r, host, text, unnest(string_split(text, chr(10))) AS line FROM d)
), f AS (
    SELECT host, norm FROM (SELECT host, norm, count(DISTINCT text) AS n FROM l WHERE norm <> '' GROUP BY host, norm) JOIN
        (SELECT host, count(DISTINCT coalesce(text, '')) AS docs FROM d GROUP BY host) h USING (host) WHERE n >= {LINE_DOCS} AND n >= {LINE_SHARE} * docs
), gone AS (
    SELECT r, count(*) AS n, sum(len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')))::BIGINT AS w FROM l JOIN f USING (host, norm) GROUP BY r
), lc AS (
    SELECT r, count(*) - count(DISTINCT line) AS dup FROM l WHERE norm <> '' GROUP BY r
), c AS (
    SELECT d.r, doc_id, len(d.w)::BIGINT AS n_words, length(array_to_string(d.w, ''))::BIGINT AS word_chars,
        length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
        coalesce(lc.dup, 0)::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
        coalesce(gone.n, 0)::BIGINT AS n_lines_removed, (len(d.w) - coalesce(gone.w, 0))::BIGINT AS n_words_left
    FROM d LEFT JOIN rep USING (r) LEFT JOIN lc USING (r) LEFT JOIN gone USING (r)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_words < {MIN_WORDS} OR 100 * n_repeat_words > {REPEAT_PERCENT} * n_words AS base_failed,
    NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {REPEAT_PERCENT} * n_words) AND n_words_left >= {MIN_WORDS} AND n_words_left >= {LEFT_SHARE} * n_words AS kept,
    n_lines_removed, n_words_left
FROM c
"""
