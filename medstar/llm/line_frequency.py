"""Quality rules by cross-document line frequency, DataFrame functions only.

Base rules count, in every whole text: words, code points in words, symbol
characters, lines equal to an earlier line, and words in three-word windows
found twice or more.  The method's own rule hashes normalised lines (lower
case, runs of other characters than letters and digits as one blank), counts
for each host the documents that hold a line, and removes lines held by more
than ``max_docs`` documents of one host.  A document that loses more than
``max_lost`` of its words so is depleted and rejected.  Every row is a
document, copies too; a line counts once in a document.

Scale: the texts are read once.  Only hashes leave that pass (one number per
line).  Copies are aggregated first: one row per host and text with its number
of documents, whose lines add that number, so a copy in half of all rows costs
each task one row.  The table of lines above the limit is written before it is
joined; joins against a hot line are split by Spark's skew handling.  Sequences
within a text are handled in the row, whatever its length; three-word windows
are compared word by word when their 64-bit hashes agree.

Defined results: a null or empty text has no words and fails the base rules;
a null host is a host of its own; lines without letters and digits are never
counted; repeated rows get equal verdicts; ids may be null; an empty table
gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medstar.llm.common import cut

MAX_DOCS, MAX_LOST = 20, 50                     # documents of one host; per cent of the words
BLANKS = r"[\x20\x09-\x0D]+"


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), BLANKS), lambda w: w != "")


def _windows(words: Column) -> Column:
    """Hashes of the three-word windows."""
    every = F.transform(words, lambda w, i: F.xxhash64(
        w, F.get(words, i + 1), F.get(words, i + 2)))
    return F.slice(every, 1, F.greatest(F.size(words) - 2, F.lit(0)))


def _covered(places: Column) -> Column:
    """Words under windows that begin at the ascending places."""
    return F.aggregate(
        places, F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).cast("long").alias("to")),
        lambda s, p: F.struct(
            (s["n"] + F.least(F.lit(3).cast("long"), p - s["to"])).alias("n"),
            p.alias("to")), lambda s: s["n"])


def _repeated_places(words: Column, windows: Column) -> Column:
    """Places of the windows whose three words are found again: equal windows
    are neighbours once hashes and places are sorted."""
    coded = F.sort_array(F.transform(windows, lambda h, i: F.struct(
        h.alias("h"), i.alias("i"))))

    def same(a: Column, b: Column) -> Column:
        i, j = a["i"], b["i"]
        return F.coalesce((a["h"] == b["h"]) & (F.get(words, i) == F.get(words, j))
                          & (F.get(words, i + 1) == F.get(words, j + 1))
                          & (F.get(words, i + 2) == F.get(words, j + 2)), F.lit(False))

    def places(s: Column) -> Column:
        found = F.filter(s, lambda x, k: same(x, F.get(s, k - 1)) | same(x, F.get(s, k + 1)))
        return F.sort_array(F.transform(found, lambda x: x["i"].cast("long")))

    return _let(coded, places)


def repeated_words(words: Column) -> Column:
    def count(w: Column) -> Column:
        return _let(_windows(w), lambda h: F.when(
            F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(
            _covered(_repeated_places(w, h))))

    return _let(words, count)


def normal_line(line: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(line), r"[^\p{L}\p{N}]+", " "))


def _lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))


def base_rules(docs: DataFrame, host_col: str = "source") -> DataFrame:
    """doc_id, host, text hash, the five counts, and for each line with letters
    or digits its hash and number of words."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id"), F.col(host_col).cast("string").alias("host"),
                       text.alias("text"))
    counted = rows.select(
        "doc_id", "host", F.xxhash64("text").alias("text_hash"),
        F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        _let(words_of(F.col("text")), lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            repeated_words(w).alias("n_repeat_words"))).alias("w"),
        _let(_lines(F.col("text")), lambda x: F.struct(
            (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            F.transform(x, lambda y: _let(normal_line(y), lambda n: F.struct(
                F.when(n != "", F.xxhash64(n)).alias("line"),
                F.size(words_of(y)).alias("words")))).alias("lines"))).alias("l"))
    return counted.select("doc_id", "host", "text_hash", "n_symbols", "w.*", "l.*")


def host_texts(rows: DataFrame) -> DataFrame:
    """(host, text_hash, docs, lines): one row per text of a host, with the
    number of its documents."""
    return rows.groupBy("host", "text_hash").agg(F.count("*").alias("docs"),
                                                 F.first("lines").alias("lines"))


def frequent_lines(texts: DataFrame, max_docs: int) -> DataFrame:
    """(host, line) held by more than ``max_docs`` documents of the host."""
    held = texts.select("host", "docs", F.explode(F.array_distinct(F.transform(
        "lines", lambda x: x["line"]))).alias("line")).filter("line is not null")
    return (held.groupBy("host", "line").agg(F.sum("docs").alias("docs"))
            .filter(F.col("docs") > max_docs).select("host", "line"))


def _hits(texts: DataFrame, frequent: DataFrame) -> DataFrame:
    """Lines of texts that are frequent on the text's host, with their words."""
    lines = (texts.select("host", "text_hash", F.explode("lines").alias("x"))
             .select(F.col("host").alias("h"), "text_hash", F.col("x.line").alias("line"),
                     F.col("x.words").alias("words")))
    return lines.join(frequent.withColumnRenamed("line", "of"), F.col("h").eqNullSafe(F.col("host"))
                      & (F.col("line") == F.col("of"))).select("host", "text_hash", "line", "words")


def quality(docs: DataFrame, max_docs: int = MAX_DOCS, max_lost: int = MAX_LOST,
            host_col: str = "source") -> DataFrame:
    """doc_id, the five counts, lost_words, base_failed and kept."""
    rows = cut(base_rules(docs, host_col), "quality-rows")
    texts = cut(host_texts(rows), "quality-texts")
    frequent = cut(frequent_lines(texts, max_docs), "quality-lines")
    lost = (_hits(texts, frequent).groupBy(F.col("host").alias("h"), F.col("text_hash").alias("t"))
            .agg(F.sum("words").cast("long").alias("lost")))
    failed = (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    return (rows.drop("lines").join(
        lost, F.col("host").eqNullSafe(F.col("h")) & (F.col("text_hash") == F.col("t")), "left")
        .withColumn("lost_words", F.coalesce("lost", F.lit(0).cast("long")))
        .withColumn("base_failed", failed)
        .withColumn("kept", ~failed & (F.col("lost_words") * 100 <= F.col("n_words") * max_lost))
        .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                "lost_words", "base_failed", "kept"))


def cleaned(docs: DataFrame, max_docs: int = MAX_DOCS, max_lost: int = MAX_LOST,
            host_col: str = "source") -> DataFrame:
    """(doc_id, text) of the documents that stay, without the removed lines."""
    rows = cut(base_rules(docs, host_col), "quality-rows")
    texts = cut(host_texts(rows), "quality-texts")
    frequent = cut(frequent_lines(texts, max_docs), "quality-lines")
    gone = _hits(texts, frequent).groupBy(
        F.col("host").alias("h"), F.col("text_hash").alias("t")).agg(
        F.collect_set("line").alias("gone"), F.sum("words").alias("lost"))
    text = F.coalesce(F.col("text"), F.lit(""))
    whole = docs.select("doc_id", F.col(host_col).cast("string").alias("host"), text.alias("text"),
                        F.xxhash64(text).alias("text_hash"))
    left = F.filter(F.split("text", "\n"), lambda x: ~F.coalesce(F.array_contains(
        F.col("gone"), F.xxhash64(normal_line(x))), F.lit(False)) | (normal_line(x) == ""))
    n, failed = F.col("n_words"), F.col("n_words") < 50
    good = rows.select("host", "text_hash", "n_words", "n_repeat_words").distinct().filter(
        ~failed & (F.col("n_repeat_words") * 100 <= n * 50)).select(
        F.col("host").alias("gh"), F.col("text_hash").alias("gt"), "n_words")
    return (whole.join(good, F.col("host").eqNullSafe(F.col("gh")) & (F.col("text_hash") == F.col("gt")))
            .join(gone, F.col("host").eqNullSafe(F.col("h")) & (F.col("text_hash") == F.col("t")), "left")
            .filter(F.coalesce(F.col("lost"), F.lit(0)) * 100 <= n * max_lost)
            .select("doc_id", F.array_join(left, "\n").alias("text")))


QUALITY_SQL = rf"""
WITH d AS (SELECT doc_id, source AS host, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
             list_filter(string_split(text, chr(10)),
                         lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
t AS (SELECT DISTINCT text, ws FROM w),
g AS (SELECT text, unnest(range(1, len(ws) - 1)) AS i, ws FROM t WHERE len(ws) >= 3),
h AS (SELECT text, i, count(*) OVER (PARTITION BY text, ws[i], ws[i + 1], ws[i + 2]) AS n FROM g),
r AS (SELECT text, count(DISTINCT p) AS n_repeat_words
      FROM (SELECT text, unnest([i, i + 1, i + 2]) AS p FROM h WHERE n > 1) GROUP BY text),
l AS (SELECT host, text, trim(regexp_replace(lower(x), '[^\p{{L}}\p{{N}}]+', ' ', 'g')) AS line,
             len(list_filter(regexp_split_to_array(x, '[\x20\x09-\x0D]+'), lambda y: y <> '')) AS words
      FROM (SELECT host, text, unnest(ls) AS x FROM (SELECT DISTINCT host, text, ls FROM w))),
n AS (SELECT host, text, count(*) AS docs FROM d GROUP BY host, text),
f AS (SELECT x.host, line
      FROM (SELECT DISTINCT host, text, line FROM l WHERE line <> '') AS x
      JOIN n ON n.text = x.text AND n.host IS NOT DISTINCT FROM x.host
      GROUP BY x.host, line HAVING sum(docs) > {MAX_DOCS}),
lost AS (SELECT l.host, l.text, sum(words) AS lost FROM l JOIN f
         ON l.host IS NOT DISTINCT FROM f.host AND l.line = f.line GROUP BY l.host, l.text),
c AS (SELECT doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
             length(regexp_replace(w.text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
             len(ls) - len(list_distinct(ls)) AS n_dup_lines,
             coalesce(n_repeat_words, 0) AS n_repeat_words,
             CAST(coalesce(lost, 0) AS BIGINT) AS lost_words
      FROM w LEFT JOIN r ON w.text = r.text
      LEFT JOIN lost ON w.text = lost.text AND w.host IS NOT DISTINCT FROM lost.host)
SELECT *, n_words < 50 OR n_repeat_words * 100 > n_words * 50 AS base_failed,
       NOT (n_words < 50 OR n_repeat_words * 100 > n_words * 50)
       AND lost_words * 100 <= n_words * {MAX_LOST} AS kept
FROM c
"""
