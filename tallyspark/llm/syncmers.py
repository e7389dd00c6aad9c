"""Document fingerprints from closed syncmers (operator 6).

The units are words: a k-mer of ``K`` words is selected when, of the hashes of its inner
``S``-word substrings, the smallest is the first or the last one.  Selection looks at the
k-mer alone, so the same words are anchors wherever they stand (``anchors`` returns them
with positions, for positional matching).  A fingerprint is the ``SIZE`` smallest distinct
anchor hashes; the likeness of two fingerprints is the share of common hashes among the
``SIZE`` smallest of both.

Results for odd input: a text of fewer than ``K`` words has one anchor, all its words; a
null text counts as empty; a text without words has the empty fingerprint, like another
empty one (1.0) and unlike any other (0.0); equal ids are ordered by a text hash, null ids
come last; the only document of a table is its own successor; no rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.llm.common import KEY, key_columns, let, words_of, write_table

K, S, SIZE = 5, 2, 64


def _inner_hashes(words: Column, s: int) -> Column:
    return F.when(F.size(words) >= s, F.transform(
        F.sequence(F.lit(0), F.size(words) - s), lambda i: F.xxhash64(*(F.get(words, i + j) for j in range(s)))))


def anchors(text: Column, k: int = K, s: int = S) -> Column:
    """array<struct<pos, hash>> of the closed syncmers of a text; pos counts words."""
    span = k - s  # the last inner substring starts here

    def select(words: Column) -> Column:
        def closed(inner: Column) -> Column:
            at = lambda i, j: F.get(inner, i + j)
            smallest = lambda i: F.least(*(at(i, j) for j in range(span + 1)))
            is_closed = lambda i: let(smallest(i), lambda m: (at(i, 0) == m) | (at(i, span) == m))
            whole = lambda i: F.xxhash64(*(at(i, j) for j in range(0, span, s)), at(i, span))
            starts = F.filter(F.sequence(F.lit(0), F.size(words) - k), is_closed)
            return F.transform(starts, lambda i: F.struct(i.alias("pos"), whole(i).alias("hash")))

        short = F.array(F.struct(F.lit(0).alias("pos"), F.xxhash64(F.array_join(words, " ")).alias("hash")))
        none = F.slice(short, 1, 0)
        return (F.when(F.size(words) >= k, let(_inner_hashes(words, s), closed))
                .when(F.size(words) > 0, short).otherwise(none))

    return let(words_of(text), select)


def fingerprint(text: Column, k: int = K, s: int = S, size: int = SIZE) -> Column:
    """Sorted array of the ``size`` smallest distinct 32-bit anchor hashes."""
    hashes = F.transform(anchors(text, k, s), lambda a: F.shiftrightunsigned(a["hash"], 32))
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, size)


def likeness(a: Column, b: Column, size: int = SIZE) -> Column:
    """Bottom-k estimate of the Jaccard similarity of the two anchor sets."""
    lowest = F.slice(F.sort_array(F.array_union(a, b)), 1, size)
    shared = let(lowest, lambda u: F.size(F.array_intersect(F.array_intersect(u, a), b)) / F.size(u))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(shared)


def as_text(prints: Column) -> Column:
    return F.array_join(F.transform(prints, lambda v: F.lpad(F.lower(F.hex(v)), 8, "0")), "")


def _buckets(docs: DataFrame) -> tuple[DataFrame, int]:
    """``docs`` with ``bucket``: ranges of doc_id with about equally many rows, numbered in
    descending order.  Only their bounds (twice the shuffle partitions) reach the driver."""
    n = 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bounds = docs.select(F.percentile_approx("k_id", [i / n for i in range(1, n)], 100 * n)).first()[0] or []
    bounds = sorted(set(bounds))
    below = F.size(F.filter(F.array(*map(F.lit, bounds)), lambda b: b < F.col("k_id"))) if bounds else F.lit(0)
    return docs.withColumn("bucket", F.when(F.col("k_null"), n).otherwise(F.lit(len(bounds)) - below)), n


def with_next(docs: DataFrame, columns: list[str], derive) -> DataFrame:
    """Each row of a keyed table, as ``derive`` extends it, with ``next_<column>`` of its
    successor in descending key order (after the last: the first).  Rows meet by range of
    the key, never in one task; the first row of each range is handed to the range before
    it by a small join, and only that row is derived a second time."""
    docs, _ = _buckets(docs)
    order = [F.col("k_null").asc(), F.col("k_id").desc(), F.col("k_hash").desc()]
    window = Window.partitionBy("bucket").orderBy(*order)
    rows = derive(docs).select("*", F.struct(*columns).alias("__row"))
    rows = rows.withColumn("__lead", F.lead("__row").over(window))
    # first row of each range: one key per range
    key = F.struct((~F.col("k_null")).alias("a"), F.col("k_id").alias("b"), F.col("k_hash").alias("c"))
    heads = docs.groupBy("bucket").agg(F.max(key).alias("head"))
    ring = heads.select(F.col("bucket").alias("to"), "head",
                        F.coalesce(F.lag("bucket").over(Window.orderBy("bucket")),
                                   F.max("bucket").over(Window.partitionBy())).alias("of"))
    ring = write_table(ring, "ranges")  # at most one row per range
    head_docs = docs.withColumn("__key", key).join(F.broadcast(ring), F.col("__key") == F.col("head"))
    head_rows = (derive(head_docs).select(F.col("of").alias("__of"), F.struct(*columns).alias("__head"))
                 .groupBy("__of").agg(F.first("__head").alias("__head")))  # repeated rows: any, they are equal
    joined = rows.join(head_rows, (F.col("bucket") == F.col("__of")) & F.col("__lead").isNull(), "left")
    return joined.select("*", *(F.coalesce(F.col("__lead")[c], F.col("__head")[c]).alias(f"next_{c}") for c in columns))


def fingerprint_documents(docs: DataFrame, k: int = K, s: int = S, size: int = SIZE) -> DataFrame:
    """Fingerprints of every text, of its edited text, and their likenesses."""
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = docs.select("doc_id", text.alias("text"), *key_columns(F.col("doc_id"), F.col("text")))
    rows = with_next(keyed, ["text", "fp"], lambda d: d.withColumn("fp", fingerprint(F.col("text"), k, s, size)))
    rows = rows.withColumn("n_chars", F.length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - half), F.substring("next_text", F.lit(1), half))
    rows = rows.select("doc_id", "n_chars", "fp", "next_fp", edited.alias("edited"))
    rows = rows.select("doc_id", "n_chars", "fp", "next_fp", F.sha2("edited", 256).alias("edited_sha256"),
                       fingerprint(F.col("edited"), k, s, size).alias("edited_fp"))
    return rows.select("doc_id", "n_chars", "edited_sha256", as_text(F.col("fp")).alias("fingerprint"),
                       as_text(F.col("edited_fp")).alias("edited_fingerprint"),
                       likeness(F.col("fp"), F.col("edited_fp"), size).alias("near_edited"),
                       likeness(F.col("fp"), F.col("next_fp"), size).alias("near_next"))
