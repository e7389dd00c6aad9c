"""Removal of repeated runs of lines by winnowing (operator 2).

Blank lines carry nothing and are left out of the sequence.  A window is the shortest run
of consecutive lines with at least ``min_words`` words that starts, or that ends, at a given
line; its *minimum* - the line with most words, ties by hash - is its fingerprint, and
fingerprint and hash of the complete window together are its key.  Every line of a run of
``min_words`` words or more lies in a window inside the run: windows by their start cover
all but the run's tail, windows by their end all but its head.

Each window is joined to the first occurrence of its key (smallest document key, then line):
one partner each, never all pairs.  A window that stands earlier is deleted, and windows
that overlap join to runs, so of two equal runs of ``min_words`` words or more the later one
goes whole, wherever else its lines occur.  Every deleted line has an equal line earlier in
(document, line) order, so the first copy of anything always stays.

Results for odd input: null text stays null and has no lines; repeated rows (same id, same
text) are one document and get the same result; equal ids with other texts are ordered by a
text hash; null ids come last; an empty table gives no rows; a text of which every line
goes becomes empty.  Lines are compared after trimming and joining white space.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.llm.common import KEY, boxed, key_columns, words_of, write_table

MIN_WORDS = 50


def _line_hash(line: Column) -> Column:
    """60 bits of the digest of the words of a line."""
    words = F.array_join(words_of(line), " ")
    return F.conv(F.substring(F.md5(words), 1, 15), 16, 10).cast("long")


def fingerprints(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Complete windows: (key, h, run, from_line, to_line); ``h`` is the fingerprint, ``run`` the window's hash."""
    lines = (docs.select(*key_columns(F.col("doc_id"), F.col("text")), "text").dropDuplicates(KEY)
             .select(*KEY, F.posexplode(F.split("text", "\n")).alias("line", "content"))
             .select(*KEY, "line", F.size(words_of(F.col("content"))).alias("n"), _line_hash(F.col("content")).alias("h"))
             .where("n > 0"))
    by_line = Window.partitionBy(*KEY).orderBy("line")
    lines = lines.withColumn("upto", F.sum("n").over(by_line)).withColumn("from", F.col("upto") - F.col("n"))
    lines = lines.withColumn("words", F.sum("n").over(Window.partitionBy(*KEY)))
    starting = Window.partitionBy(*KEY).orderBy("from").rangeBetween(0, min_words - 1)
    ending = Window.partitionBy(*KEY).orderBy("upto").rangeBetween(-(min_words - 1), 0)
    item = F.struct("n", "h", "line")
    lines = lines.select(*KEY, "from", "upto", "words", F.collect_list(item).over(starting).alias("starting"),
                         F.collect_list(item).over(ending).alias("ending"))
    windows = F.array(F.when(F.col("words") - F.col("from") >= min_words, F.col("starting")),
                      F.when(F.col("upto") >= min_words, F.col("ending")))
    found = lines.select(*KEY, F.explode(F.filter(windows, lambda w: w.isNotNull())).alias("w"))
    least = F.array_min(F.transform("w", lambda x: F.struct((-x["n"]).alias("n"), x["h"].alias("h"))))
    return found.select(*KEY, least["h"].alias("h"), F.xxhash64(F.transform("w", lambda x: x["h"])).alias("run"),
                        F.get("w", F.lit(0))["line"].alias("from_line"), F.element_at("w", -1)["line"].alias("to_line"))


def repeated_runs(marks: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(key, from_line, to_line) of the lines that later copies of windows cover, each line once."""
    place = F.struct(*KEY, "from_line")
    first = (marks.groupBy("h", "run").agg(F.min(place).alias("first"), F.max(place).alias("last"))
             .where("first < last").select("h", "run", "first"))
    later = marks.join(first, ["h", "run"]).where(place != F.col("first")).select(*KEY, "from_line", "to_line")
    before = Window.partitionBy(*KEY).orderBy("from_line", "to_line").rowsBetween(Window.unboundedPreceding, -1)
    new = F.greatest(F.col("from_line"), F.max("to_line").over(before) + 1)
    return later.withColumn("from_line", new).where("from_line <= to_line")


def _cleaned(docs: DataFrame, min_words: int) -> DataFrame:
    """(row, clean_text, removed) for every row of ``docs``."""
    marks = write_table(fingerprints(docs, min_words), "fingerprints")
    runs = (repeated_runs(marks, min_words).groupBy(*KEY)  # a document's runs: bounded by its lines
            .agg(F.flatten(F.collect_list(F.sequence("from_line", "to_line"))).alias("gone")))
    keyed = boxed(docs).select("row", *(c.alias(f"row_{k}") for c, k in zip(key_columns(F.col("row.doc_id"), F.col("row.text")), KEY)))
    text = F.col("row.text")
    joined = (keyed.join(runs, [F.col(f"row_{k}") == F.col(k) for k in KEY], "left")
              .withColumn("lines", F.when(F.col("gone").isNotNull(), F.split(text, "\n"))))
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    clean = F.when(F.col("gone").isNull(), text).otherwise(
        F.array_join(F.transform(left, lambda i: F.get("lines", i)), "\n"))
    return joined.select("row", clean.alias("clean_text"), F.coalesce("gone", F.array().cast("array<int>")).alias("removed"))


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, text, clean_text, removed) for every row of ``docs``; ``removed`` lists the
    0-based line numbers taken out (blank lines inside a removed run go with it)."""
    return _cleaned(docs, min_words).select("row.doc_id", "row.text", "clean_text", "removed")


def drop_repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with the cleaned text in place of ``text`` (and ``n_chars``, if there, to match).

    A document of which no word is left - all of it stands earlier - goes; one that had no
    words to begin with stays as it is.
    """
    out = _cleaned(docs, min_words).where((F.size("removed") == 0) | F.col("clean_text").rlike(r"[^\x20\x09-\x0D]"))
    new = {"text": F.col("clean_text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.size("removed") == 0, F.col("row.n_chars")).otherwise(
            F.length("clean_text").cast(docs.schema["n_chars"].dataType))
    return out.select(*(new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns))


ORACLE_SQL = """
WITH doc AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents),
l0 AS (SELECT doc_id, i - 1 AS line, regexp_extract_all(ls[i], '[^\\x20\\x09-\\x0D]+') AS w
       FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM doc)),
l1 AS (SELECT doc_id, line, len(w) AS n, ('0x' || md5(array_to_string(w, ' '))[1:15])::BIGINT AS h FROM l0 WHERE len(w) > 0),
l2 AS (SELECT *, sum(n) OVER (PARTITION BY doc_id ORDER BY line) AS upto, sum(n) OVER (PARTITION BY doc_id) AS words FROM l1),
l3 AS (SELECT *, upto - n AS start FROM l2),
starting AS (SELECT a.doc_id, list(b.h ORDER BY b.line) AS run, min(b.line) AS first_line, max(b.line) AS last_line
             FROM l3 a JOIN l3 b ON a.doc_id = b.doc_id AND b.start BETWEEN a.start AND a.start + 49
             WHERE a.words - a.start >= 50 GROUP BY a.doc_id, a.line),
ending AS (SELECT a.doc_id, list(b.h ORDER BY b.line) AS run, min(b.line) AS first_line, max(b.line) AS last_line
           FROM l3 a JOIN l3 b ON a.doc_id = b.doc_id AND b.upto BETWEEN a.upto - 49 AND a.upto
           WHERE a.upto >= 50 GROUP BY a.doc_id, a.line),
win AS (SELECT * FROM starting UNION SELECT * FROM ending),
firsts AS (SELECT run, min({'doc_id': doc_id, 'line': first_line}) AS f FROM win GROUP BY run),
later AS (SELECT doc_id, first_line, last_line FROM win JOIN firsts USING (run) WHERE {'doc_id': doc_id, 'line': first_line} <> f),
gone AS (SELECT DISTINCT doc_id, unnest(range(first_line, last_line + 1)) AS line FROM later),
gone_list AS (SELECT doc_id, list(line ORDER BY line) AS removed FROM gone GROUP BY doc_id)
SELECT doc_id, coalesce(len(ls), 0)::BIGINT AS n_lines, coalesce(len(removed), 0)::BIGINT AS n_removed,
       CASE WHEN removed IS NULL THEN text ELSE array_to_string(list_filter(ls, lambda x, i: NOT list_contains(removed, i - 1)), chr(10)) END AS text
FROM doc LEFT JOIN gone_list USING (doc_id)
"""
