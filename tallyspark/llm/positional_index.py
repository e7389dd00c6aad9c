"""Benchmark decontamination by a positional inverted index (operator 13).

The index stores the postings of the training tokens that occur in the benchmark: document,
term, position, and one row per document with its length.  It is written where the texts
are read, a file per task: no posting is shuffled, so a term that every document holds
costs no hot partition.  A window is ``WINDOW`` consecutive words of an item (a shorter
item is one window).  The corpus counts of the terms come from the index; of each window
the two rarest terms are looked up, their positions are shifted by the term's place in the
item, and the two lists are intersected on (document, item, shifted position).  What is in
both lists is compared word for word with the text it came from.

Neighbouring windows of an item mostly have the same two rarest terms; they share one
lookup, whose range of item words covers them all (a window that lies between two windows
with the same rarest two has them as well).

``phrase_matches`` returns exact phrases; ``proximity_matches`` returns the places where
the two rarest terms of a window stand up to ``slop`` words off their distance in the item.

Results for odd input: null text has no words; null or empty items have no windows; an item
of fewer words than a window is one window; items repeated under one id count once in
``n_items``, a null item_id marks words but is no item; documents are told apart by id and
text, repeated rows share one verdict; without benchmark or documents nothing is hit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyspark.llm.common import KEY, is_broadcastable, key_columns, let, write_table

WINDOW = 10
#: What separates words (fixed by the query contract): ASCII other than digits and letters.
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PAIR = ["item", "qa", "qb"]


def index_words(text: Column) -> Column:
    """The words of a text, A-Z in lower case (null: none)."""
    return F.filter(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), NOT_WORD), lambda w: w != "")


def _small(table: DataFrame, max_rows: int = 200_000) -> DataFrame:
    """A written table of narrow rows, marked for broadcast if it is counted small; Spark chooses otherwise."""
    return F.broadcast(table) if is_broadcastable(table.count(), max_rows) else table


def read_items(benchmark: DataFrame) -> DataFrame:
    """(item, item_id, words): every different row of the benchmark with words, numbered."""
    rows = benchmark.select("item_id", "text").distinct().select("item_id", index_words(F.col("text")).alias("words"))
    return write_table(rows.where(F.size("words") > 0).select(
        F.monotonically_increasing_id().alias("item"), F.col("item_id").cast("string").alias("item_id"), "words"), "items")


def write_index(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Postings (document key, term, pos) of the items' terms, and a row with null term and the length per document."""
    terms = write_table(items.select(F.explode("words").alias("v_term")).distinct(), "terms")
    words = F.array_append(index_words(F.col("text")), F.lit(None).cast("string"))  # the last position is the length
    postings = docs.select(*key_columns(F.col("doc_id"), F.col("text")), F.posexplode(words).alias("pos", "term"))
    held = postings.join(_small(terms), F.col("term") == F.col("v_term"), "left").where("v_term IS NOT NULL OR term IS NULL")
    return write_table(held.select(*KEY, "term", "pos"), "postings")


def rarest_pairs(index: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item, qa, ta, qb, tb, lo, hi, width): the two rarest terms of the windows between item words lo and hi.

    Windows with a term that no document holds match nowhere and are left out.
    """
    counts = index.where("term IS NOT NULL").groupBy(F.col("term").alias("c_term")).agg(F.count("*").alias("freq"))
    words = items.select("item", F.least(F.size("words"), F.lit(window)).alias("width"), F.size("words").alias("n"),
                         F.posexplode("words").alias("q", "term"))
    placed = words.join(counts, F.col("term") == F.col("c_term"), "left").select(
        "item", "width", F.struct(F.coalesce("freq", F.lit(0)).alias("freq"), "q", "term").alias("t"),
        F.explode(F.sequence(F.greatest(F.lit(0), F.col("q") - F.col("width") + 1),
                             F.least(F.col("q"), F.col("n") - F.col("width")))).alias("at"))
    ranked = placed.groupBy("item", "at", "width").agg(F.sort_array(F.collect_list("t")).alias("ts"))  # a window's words
    a, b = F.get("ts", F.lit(0)), F.coalesce(F.get("ts", F.lit(1)), F.get("ts", F.lit(0)))
    chosen = ranked.where(F.get("ts", F.lit(0))["freq"] > 0).select(
        "item", "at", "width", a["q"].alias("qa"), a["term"].alias("ta"), b["q"].alias("qb"), b["term"].alias("tb"))
    return write_table(chosen.groupBy(*PAIR, "ta", "tb", "width").agg(
        F.min("at").alias("lo"), (F.max("at") + F.col("width") - 1).alias("hi")), "pairs")


def _lists(index: DataFrame, pairs: DataFrame) -> DataFrame:
    """Postings of the pairs' terms with the shifted position ``diag`` and the side, 1 or 2."""
    sides = write_table(pairs.select(*PAIR, F.inline(F.array(
        F.struct(F.col("ta").alias("a_term"), F.col("qa").alias("q"), F.lit(1).alias("side")),
        F.struct(F.col("tb").alias("a_term"), F.col("qb").alias("q"), F.lit(2).alias("side"))))), "sides")
    return index.join(_small(sides), F.col("term") == F.col("a_term")).select(
        *KEY, *PAIR, (F.col("pos") - F.col("q")).alias("diag"), "side")


def candidates(index: DataFrame, pairs: DataFrame) -> DataFrame:
    """(document key, item, qa, qb, diag) that both lists of a pair hold."""
    return _lists(index, pairs).groupBy(*KEY, *PAIR, "diag").agg(F.bit_or("side").alias("sides")).where("sides = 3").drop("sides")


def phrase_matches(docs: DataFrame, index: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """(document key, item, item_at, doc_at, width): every occurrence of a window, counted in words from 0."""
    pairs = rarest_pairs(index, items, window)
    found = candidates(index, pairs).join(pairs.select(*PAIR, "lo", "hi", "width"), PAIR)
    by_doc = write_table(found.groupBy(*KEY).agg(F.collect_list(F.struct("item", "diag", "lo", "hi", "width")).alias("found")), "found")

    def pieces(words: Column) -> Column:
        # a pair's range may stick out of the text: its windows inside it may still match
        def piece(c: Column) -> Column:
            lo = F.greatest(c["lo"], -c["diag"])
            hi = F.least(c["hi"], F.size(words) - 1 - c["diag"])
            return F.struct(c["item"].alias("item"), c["diag"].alias("diag"), lo.alias("lo"), c["width"].alias("width"),
                            F.slice(words, c["diag"] + lo + 1, F.greatest(F.lit(0), hi - lo + 1)).alias("text"))
        return F.transform(F.col("found"), piece)

    texts = docs.select(*key_columns(F.col("doc_id"), F.col("text")), "text").join(
        _small(by_doc.select(*KEY)), KEY, "left_semi")
    cut = texts.join(by_doc, KEY).select(*KEY, F.explode(let(index_words(F.col("text")), pieces)).alias("p")).select(*KEY, "p.*")

    def starts(words: Column) -> Column:
        same = F.zip_with("text", F.slice(words, F.col("lo") + 1, F.size("text")), lambda x, y: x == y)
        return let(same, lambda eq: F.filter(F.transform(eq, lambda e, i: F.when(F.forall(
            F.slice(eq, i + 1, F.col("width")), lambda x: x) & (i + F.col("width") <= F.size(eq)), i)), lambda i: i.isNotNull()))

    held = cut.where(F.size("text") >= F.col("width")).join(items.select("item", "words"), "item")
    return held.select(*KEY, "item", "diag", "lo", "width", F.explode(starts(F.col("words"))).alias("i")).select(
        *KEY, "item", (F.col("lo") + F.col("i")).alias("item_at"), (F.col("diag") + F.col("lo") + F.col("i")).alias("doc_at"),
        "width").distinct()


def proximity_matches(index: DataFrame, items: DataFrame, slop: int, window: int = WINDOW) -> DataFrame:
    """(document key, item, lo, hi, diag, apart): where a window's two rarest terms stand ``apart`` words off
    their distance in the item, at most ``slop`` either way.

    Shifted positions are cut into bins of slop + 1; only equal and neighbouring bins are joined.
    """
    pairs = rarest_pairs(index, items, window)
    lists = _lists(index, pairs).withColumn("bin", F.floor(F.col("diag") / (slop + 1)))
    first = lists.where("side = 1").drop("side")
    second = lists.where("side = 2").select(*KEY, *PAIR, F.col("diag").alias("diag_b"), F.explode(
        F.array(F.col("bin") - 1, F.col("bin"), F.col("bin") + 1)).alias("bin"))
    near = first.join(second, [*KEY, *PAIR, "bin"]).where(F.abs(F.col("diag_b") - F.col("diag")) <= slop)
    return near.join(pairs.select(*PAIR, "lo", "hi"), PAIR).select(
        *KEY, "item", "lo", "hi", "diag", (F.col("diag_b") - F.col("diag")).alias("apart")).distinct()


def _covered(spans: DataFrame) -> DataFrame:
    """(document key, n_hit): words inside any match, overlaps counted once, in one ordered pass per document."""
    merged = spans.groupBy(*KEY, "doc_at").agg(F.max("width").alias("width"))
    before = Window.partitionBy(*KEY).orderBy("doc_at").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.coalesce(F.max(F.col("doc_at") + F.col("width")).over(before), F.lit(0))
    return merged.select(*KEY, F.greatest(F.lit(0), F.col("doc_at") + F.col("width") - F.greatest(F.col("doc_at"), reached)).alias("new")) \
        .groupBy(*KEY).agg(F.sum("new").alias("n_hit"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: its words, those inside benchmark windows, and the items found."""
    items = read_items(benchmark)
    index = write_index(docs, items)
    spans = write_table(phrase_matches(docs, index, items, window), "spans")
    by_item = spans.select(*KEY, "item").distinct().join(items.select("item", "item_id"), "item")
    listed = by_item.groupBy(*KEY).agg(F.sort_array(F.collect_set("item_id")).alias("ids"))
    verdict = _covered(spans).join(listed, KEY)
    lengths = index.where("term IS NULL").select(*KEY, F.col("pos").alias("n"))
    ids = F.coalesce("ids", F.array().cast("array<string>"))
    return lengths.join(verdict, KEY, "left").select(
        F.when(~F.col("k_null"), F.col("k_id")).alias("doc_id"), F.col("n").cast("long").alias("n_words"),
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"), (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"))


ORACLE_SQL = f"""
WITH words AS (
  SELECT doc_id, text, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, list_slice(w, p0, p0 + width - 1) AS win, width
  FROM (SELECT item_id, w, least(len(w), {WINDOW}) AS width, unnest(range(1, len(w) - least(len(w), {WINDOW}) + 2)) AS p0 FROM items WHERE len(w) > 0)),
placed AS (
  SELECT doc_id, p0, width, list_slice(w, p0, p0 + width - 1) AS win
  FROM (SELECT doc_id, w, width, unnest(range(1, len(w) - width + 2)) AS p0
        FROM words, (SELECT DISTINCT width FROM windows) WHERE len(w) >= width)),
hits AS (SELECT DISTINCT doc_id, p0, width, item_id FROM placed JOIN windows USING (win, width)),
hit_words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(p0, p0 + width)) AS p FROM hits) GROUP BY doc_id),
hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS i FROM hits) GROUP BY doc_id)
SELECT words.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""
