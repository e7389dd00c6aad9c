"""Quality rules with host-level shrinkage (operator 1).

Every document is measured by plain text rules.  Failures are summed by host (partial
aggregates, so a host with a third of all rows costs one row per task), host failure
rates are shrunk towards a beta prior fitted to all hosts by moments, and the host
verdict is joined back: documents of a distrusted host must meet the strict limits,
documents of any other host the plain ones.  A document that breaks no rule is kept
whatever its host.

Results for odd input: null text has no words and fails the base rules; the null host is
a host of its own; repeated rows count as often as they occur; without rows there are no
hosts and no result; with one host, or when all or no documents fail, the prior has the
strength ``PRIOR_STRENGTH``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import WHITE_SPACE, boxed, is_broadcastable, let, words_of, write_table

#: Prior weight, in documents, where the hosts do not determine it; and its bounds.
PRIOR_STRENGTH, MIN_STRENGTH, MAX_STRENGTH = 10.0, 1.0, 1e6
#: A host whose shrunk failure rate reaches this is distrusted.
DISTRUST_AT = 0.5
#: Largest share, in percent, of symbols per word and of duplicate lines: (plain, strict).
SYMBOL_PCT, DUP_LINE_PCT = (25, 10), (50, 25)
WINDOW = 3  # words of a repeated window


def repeat_words(words: Column, window: int = WINDOW) -> Column:
    """Words covered by windows of ``window`` words that occur at least twice in the text.

    Window hashes are sorted with their positions; equal neighbours are repeats, and the
    union of their spans is summed gap by gap: O(n log n) for any text.
    """
    def spans(at: Column) -> Column:
        return F.aggregate(
            F.transform(at, lambda p, j: F.least(F.lit(window), F.coalesce(F.get(at, j + 1) - p, F.lit(window)))),
            F.lit(0).cast("long"), lambda total, x: total + x)

    def repeated(ranked: Column) -> Column:
        twin = lambda s, j: (F.coalesce(F.get(ranked, j - 1)["h"] == s["h"], F.lit(False))
                             | F.coalesce(F.get(ranked, j + 1)["h"] == s["h"], F.lit(False)))
        return let(F.sort_array(F.transform(F.filter(ranked, twin), lambda s: s["i"])), spans)

    windows = F.when(F.size(words) >= window, F.transform(
        F.sequence(F.lit(0), F.size(words) - window),
        lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(window)))))

    def counted(hashes: Column) -> Column:
        # most texts repeat no window: a hash set finds that without sorting
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(
            let(F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), repeated))

    return F.coalesce(let(windows, counted), F.lit(0).cast("long"))


def measures(text: Column) -> Column:
    """Struct of the rule measures of one text."""
    whole = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda line: F.length(F.regexp_replace(line, WHITE_SPACE, "")) > 0)
    by_line = let(lines, lambda ls: F.struct(
        F.size(ls).cast("long").alias("n_lines"), (F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("n_dup_lines")))
    by_word = let(words_of(text), lambda ws: F.struct(
        F.size(ws).cast("long").alias("n_words"), repeat_words(ws).alias("n_repeat_words")))
    return let(F.struct(by_line.alias("l"), by_word.alias("w")), lambda m: F.struct(
        m["w"]["n_words"].alias("n_words"),
        F.length(F.regexp_replace(whole, WHITE_SPACE, "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace(whole, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        m["l"]["n_dup_lines"].alias("n_dup_lines"), m["w"]["n_repeat_words"].alias("n_repeat_words"),
        m["l"]["n_lines"].alias("n_lines")))


def base_failed(m: Column) -> Column:
    return (m["n_words"] < 50) | (m["n_repeat_words"] * 100 > m["n_words"] * 50)


def over_limits(m: Column, strict: bool) -> Column:
    return ((m["n_symbols"] * 100 > m["n_words"] * SYMBOL_PCT[strict])
            | (m["n_dup_lines"] * 100 > m["n_lines"] * DUP_LINE_PCT[strict]))


def host_verdicts(measured: DataFrame) -> DataFrame:
    """(host, host_docs, host_rate, distrusted) of a table with ``host`` and ``failed``."""
    hosts = measured.groupBy("host").agg(F.count("*").alias("n"), F.sum(F.col("failed").cast("long")).alias("f"))
    totals = hosts.agg(F.count("*").alias("hosts"), F.sum("n").alias("docs"), F.sum("f").alias("fails"),
                       F.sum(F.col("f") * F.col("f") / F.col("n")).alias("squares"))
    mean = F.col("fails") / F.col("docs")
    # spread of the true rates: spread of the observed ones less their sampling noise
    between = (F.col("squares") / F.col("docs") - mean * mean) - mean * (1 - mean) * F.col("hosts") / F.col("docs")
    strength = (F.when((F.col("hosts") < 2) | (F.col("fails") == 0) | (F.col("fails") == F.col("docs")), PRIOR_STRENGTH)
                .when(between <= 1e-12, MAX_STRENGTH)
                .otherwise(F.greatest(F.lit(MIN_STRENGTH), F.least(F.lit(MAX_STRENGTH), mean * (1 - mean) / between - 1))))
    prior = totals.select(mean.alias("mean"), strength.alias("strength"))
    rate = (F.col("f") + F.col("mean") * F.col("strength")) / (F.col("n") + F.col("strength"))
    return hosts.crossJoin(F.broadcast(prior)).select(  # the prior is one row
        "host", F.col("n").alias("host_docs"), F.round(rate, 6).alias("host_rate"), (rate >= DISTRUST_AT).alias("distrusted"))


def _measured(docs: DataFrame, host_column: str) -> DataFrame:
    m = docs.select("doc_id", F.col(host_column).alias("host"), measures(F.col("text")).alias("m"))
    return m.select("doc_id", "host", "m", base_failed(F.col("m")).alias("base_failed"),
                    over_limits(F.col("m"), False).alias("plain"), over_limits(F.col("m"), True).alias("strict"),
                    (base_failed(F.col("m")) | over_limits(F.col("m"), False)).alias("failed"))


def _kept(base: Column, plain: Column, strict: Column, distrusted: Column) -> Column:
    return ~(base | plain | (F.coalesce(distrusted, F.lit(False)) & strict))


def score_quality(docs: DataFrame, host_column: str = "source") -> DataFrame:
    """Measures and verdict of every row of ``docs(doc_id, text, <host_column>)``."""
    table = write_table(_measured(docs, host_column), "quality")  # narrow: no text
    verdicts = host_verdicts(table).withColumnRenamed("host", "v_host")
    return (table.join(verdicts, F.col("host").eqNullSafe(F.col("v_host")), "left")
            .select("doc_id", "m.n_words", "m.word_chars", "m.n_symbols", "m.n_dup_lines", "m.n_repeat_words",
                    "base_failed", "host_rate",
                    _kept(F.col("base_failed"), F.col("plain"), F.col("strict"), F.col("distrusted")).alias("kept")))


def keep_good(docs: DataFrame, host_column: str = "source") -> DataFrame:
    """The rows of ``docs`` that pass, all columns unchanged.

    Only distrusted hosts are joined to the texts; the measures are taken once for the
    host table (without texts) and once where the rows are filtered, so no text moves.
    The filter is one expression that binds the measures once: split into conditions,
    each would be pushed to the scan with a copy of the measures of its own.
    """
    failed = let(measures(F.col("text")), lambda m: base_failed(m) | over_limits(m, False))
    verdicts = host_verdicts(docs.select(F.col(host_column).alias("host"), failed.alias("failed")))
    bad = write_table(verdicts.where("distrusted").select("host", "distrusted"), "hosts")
    bad = F.broadcast(bad) if is_broadcastable(bad.count()) else bad
    kept = let(measures(F.col("row.text")), lambda m: _kept(
        base_failed(m), over_limits(m, False), over_limits(m, True), F.col("distrusted")))
    return (boxed(docs).join(bad, F.col(f"row.{host_column}").eqNullSafe(F.col("host")), "left").where(kept).select("row.*"))


ORACLE_SQL = """
WITH words AS (
  SELECT doc_id, source, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
lines AS (
  SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM words),
grams AS (
  SELECT doc_id, i, w[i] || chr(10) || w[i + 1] || chr(10) || w[i + 2] AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM words WHERE len(w) >= 3)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM grams) WHERE c > 1),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY doc_id),
m AS (
  SELECT doc_id, source, len(w)::BIGINT AS n_words,
         coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, len(ls)::BIGINT AS n_lines,
         coalesce(covered.n, 0)::BIGINT AS n_repeat_words
  FROM words JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)),
r AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         n_symbols * 100 > n_words * 25 OR n_dup_lines * 100 > n_lines * 50 AS plain,
         n_symbols * 100 > n_words * 10 OR n_dup_lines * 100 > n_lines * 25 AS strict FROM m),
h AS (SELECT source, count(*)::DOUBLE AS n, sum((base_failed OR plain)::INT)::DOUBLE AS f FROM r GROUP BY source),
t AS (SELECT count(*) AS hosts, sum(n) AS docs, sum(f) AS fails, sum(f * f / n) AS squares FROM h),
b AS (SELECT *, fails / docs AS mu,
             squares / docs - (fails / docs) ** 2 - fails / docs * (1 - fails / docs) * hosts / docs AS spread FROM t),
p AS (SELECT mu, CASE WHEN hosts < 2 OR fails = 0 OR fails = docs THEN 10.0 WHEN spread <= 1e-12 THEN 1e6
                      ELSE greatest(1.0, least(1e6, mu * (1 - mu) / spread - 1)) END AS s FROM b),
v AS (SELECT source, (f + mu * s) / (n + s) AS rate FROM h, p)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, round(rate, 6) AS host_rate,
       NOT (base_failed OR plain OR (rate >= 0.5 AND strict)) AS kept
FROM r JOIN v ON r.source IS NOT DISTINCT FROM v.source
"""
