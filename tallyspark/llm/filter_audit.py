"""Filter interaction audit (operator 12).

What a filter of a chain removes depends on what stands before it.  Every document is
measured once and becomes a mask, the letters of the filters it fails; documents of one
part and mask form a cell (at most 2^5 cells a part, counted by partial aggregates).  Each
cell then folds across the array of all orders: ``transform`` walks the 120 orders,
``aggregate`` walks the five steps of one and carries whether the cell is still alive, and
every step becomes a struct weighted with the cell's counts, 600 a cell.  The cells of a
part are merged by elementwise sums.

Filters (failure conditions): A under ``MIN_WORDS`` words; B fewer than half of the words
distinct; C more than 3 % capitals A-Z; D holds any of ``#$%&*|``; E the text of a smaller
doc_id.  E needs the smallest id of every text: rows are matched with it on (text digest,
id), so a text that a third of the rows share is spread by its ids.

Results for odd input: null text is the empty text, null lang the part ``''``; a null id is
neither smaller nor larger than another, so such a row never fails E; rows repeated under
one id all pass E where that id is the smallest; several labels of one id count as the best
quality and the worst toxicity; rows without label count in neither; without documents
there are no parts and no rows.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import let, words_of, write_table

FILTERS = "ABCDE"
MIN_WORDS = 200
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MARKS = r"[#$%&*|]"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]


def failed_by_text(text: Column) -> Column:
    """The letters of the filters A to D that one text fails."""
    whole = F.coalesce(text, F.lit(""))

    def letters(m: Column) -> Column:
        capitals = F.length(whole) - F.length(F.translate(whole, CAPITALS, ""))
        fails = {"A": m["n"] < MIN_WORDS, "B": m["distinct"] * 100 < m["n"] * 50,
                 "C": capitals.cast("long") * 100 > F.length(whole).cast("long") * 3, "D": whole.rlike(MARKS)}
        return F.concat(*(F.when(cond, letter).otherwise("") for letter, cond in fails.items()))

    return let(let(words_of(text), lambda ws: F.struct(F.size(ws).cast("long").alias("n"),
                                                       F.size(F.array_distinct(ws)).cast("long").alias("distinct"))), letters)


def masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, failed, good, toxic, n): documents counted by all that the audit asks of one."""
    text = F.coalesce("text", F.lit(""))
    narrow = write_table(docs.select(
        "doc_id", F.coalesce("lang", F.lit("")).alias("part"), failed_by_text(F.col("text")).alias("by_text"),
        F.unhex(F.sha2(text, 256)).alias("digest")), "masks")
    first = narrow.where("doc_id IS NOT NULL").groupBy(F.col("digest").alias("f_digest")).agg(F.min("doc_id").alias("f_id"))
    rows = narrow.groupBy("digest", "doc_id", "part", "by_text").agg(F.count("*").alias("n"))
    later = F.col("f_id").isNull() & F.col("doc_id").isNotNull()
    marked = rows.join(first, (F.col("digest") == F.col("f_digest")) & (F.col("doc_id") == F.col("f_id")), "left").select(
        "doc_id", "part", F.concat("by_text", F.when(later, "E").otherwise("")).alias("failed"), "n")
    by_id = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("l_id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    return marked.join(by_id, F.col("doc_id") == F.col("l_id"), "left").select(
        "part", "failed", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"), "n")


def cells(masked: DataFrame) -> DataFrame:
    """(part, failed, n, good, toxic) with the counts of each mask, at most 2^5 rows a part."""
    count = lambda cond: F.sum(F.when(cond, F.col("n")).otherwise(F.lit(0).cast("long")))
    return masked.groupBy("part", "failed").agg(F.sum("n").alias("n"), count(F.col("good")).alias("n_good"),
                                                count(F.col("toxic")).alias("n_toxic"))


def fold(failed: Column, n: Column, good: Column, toxic: Column, orders: Column) -> Column:
    """One struct of counts for every step of every order, as one array."""
    long = lambda cond, value: F.when(cond, value).otherwise(F.lit(0).cast("long"))
    steps = "array<struct<" + ",".join(f"{c}:bigint" for c in COUNTS) + ">>"

    def walk(order: Column) -> Column:
        def step(state: Column, letter: Column) -> Column:
            alive, fails = state["alive"], F.contains(failed, letter)
            counts = F.struct(long(alive & ~fails, n).alias("kept"), long(alive & fails, n).alias("removed"),
                              long(~alive & fails, n).alias("redundant"), long(failed == letter, n).alias("unique_fails"),
                              long(alive & fails, good).alias("good_lost"), long(alive & fails, toxic).alias("toxic_lost"))
            return F.struct((alive & ~fails).alias("alive"), F.concat(state["steps"], F.array(counts)).alias("steps"))

        start = F.struct(F.lit(True).alias("alive"), F.array().cast(steps).alias("steps"))
        return F.aggregate(F.split(order, ""), start, step, lambda state: state["steps"])

    return F.flatten(F.transform(orders, walk))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order and step, zeros included."""
    orders = F.array(*(F.lit(o) for o in ORDERS))
    folded = cells(masks(docs, labels)).select("part", fold(
        F.col("failed"), F.col("n"), F.col("n_good"), F.col("n_toxic"), orders).alias("steps"))
    zeros = F.array_repeat(F.struct(*(F.lit(0).cast("long").alias(c) for c in COUNTS)), len(ORDERS) * len(FILTERS))
    add = lambda a, b: F.zip_with(a, b, lambda x, y: F.struct(*((x[c] + y[c]).alias(c) for c in COUNTS)))
    merged = folded.groupBy("part").agg(F.collect_list("steps").alias("cells")).select(  # at most 2^5 arrays a part
        "part", F.aggregate("cells", zeros, add).alias("steps"))
    rows = merged.select("part", F.posexplode("steps").alias("at", "s")).select(
        "part", F.get(orders, F.floor(F.col("at") / len(FILTERS)).cast("int")).alias("filter_order"),
        (F.col("at") % len(FILTERS) + 1).cast("int").alias("step"), "s.*")
    letter = F.substring("filter_order", F.col("step"), F.lit(1))
    totals = rows.groupBy(F.col("part").alias("t_part"), letter.alias("letter")).agg(F.sum("removed").alias("shapley"))
    return rows.join(totals, (F.col("part") == F.col("t_part")) & (letter == F.col("letter"))).select(
        "part", "filter_order", "step", *COUNTS, "shapley")


ORACLE_SQL = """
WITH words AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
smallest AS (SELECT coalesce(text, '') AS text, min(doc_id) AS first_id FROM documents GROUP BY 1),
marks AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
fails AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         len(w) < 200 AS a, 100 * len(list_distinct(w)) < 50 * len(w) AS b,
         100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text) AS c,
         regexp_matches(text, '[#$%&*|]') AS d, coalesce(words.doc_id > first_id, false) AS e
  FROM words JOIN smallest USING (text) LEFT JOIN marks ON marks.doc_id = words.doc_id),
long AS (SELECT part, row_number() OVER () AS rid, good, toxic, a, b, c, d, e FROM fails),
failing AS (
  SELECT rid, part, good, toxic, [a, b, c, d, e] AS f, a::INT + b::INT + c::INT + d::INT + e::INT AS n_failed FROM long),
cell AS (
  SELECT part, f, n_failed, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM failing GROUP BY part, f, n_failed),
letter AS (SELECT unnest(range(1, 6)) AS x),
orders AS (
  SELECT [p1.x, p2.x, p3.x, p4.x, p5.x] AS o
  FROM letter p1, letter p2, letter p3, letter p4, letter p5
  WHERE len(list_distinct([p1.x, p2.x, p3.x, p4.x, p5.x])) = 5),
steps AS (SELECT o, unnest(range(1, 6)) AS step FROM orders),
walked AS (
  SELECT part, o, step, n, good, toxic, n_failed, f[o[step]] AS fails,
         NOT list_bool_or(list_transform(o[1:step - 1], lambda i: f[i])) IS TRUE AS alive
  FROM cell, steps),
summed AS (
  SELECT part, o, step,
         sum(CASE WHEN alive AND NOT fails THEN n ELSE 0 END)::BIGINT AS kept,
         sum(CASE WHEN alive AND fails THEN n ELSE 0 END)::BIGINT AS removed,
         sum(CASE WHEN NOT alive AND fails THEN n ELSE 0 END)::BIGINT AS redundant,
         sum(CASE WHEN fails AND n_failed = 1 THEN n ELSE 0 END)::BIGINT AS unique_fails,
         sum(CASE WHEN alive AND fails THEN good ELSE 0 END)::BIGINT AS good_lost,
         sum(CASE WHEN alive AND fails THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM walked GROUP BY part, o, step)
SELECT part, array_to_string(list_transform(o, lambda i: substr('ABCDE', i, 1)), '') AS filter_order, step::INT AS step,
       kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       sum(removed) OVER (PARTITION BY part, o[step])::BIGINT AS shapley
FROM summed
"""
