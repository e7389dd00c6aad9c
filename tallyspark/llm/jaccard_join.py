"""Exact n-gram Jaccard similarity join by parity sketches (operator 10).

1. Each text becomes its set of distinct ``k``-word shingles, as 64-bit hashes.  Texts
   with equal sets form a class (compared by size and a 128-bit digest).
2. Parity sketch: per size band the shingles are dealt to blocks of ``BLOCK_BITS`` bits,
   each flipping one bit (XOR) of its block.  Two sketches differ in at most as many bits as
   the sets differ in elements, so a pair similar enough to link, whose difference is at
   most d, differs in at most d blocks.  Of d + 1 + spare blocks a text leaves out its
   ``spare`` weakest: fewest rare shingles, then fewest bits, ties by content.  A linking
   pair has the same shingles in 1 + spare blocks at least; the strongest of these is left
   out by neither text, so equal (band, block, bits) keys find the pair: no pair is lost.
   Which shingles count as common is learned from a bounded sample of texts; it decides
   only which blocks are weak, so passages and phrases that many texts share do not bring
   unrelated texts together, and any other choice would find the same links.
3. Candidates of a key are not paired with each other: each class first meets, of the
   smallest classes of its keys, the one it shares most keys with.  A further parity sketch
   of the whole set drops pairs whose Hamming distance is over d before any text moves;
   what is left is verified, and verified links give components.  Only keys that still hold
   several components are looked at again: tasks hold blocks of at most about ``BLOCK_ROWS``
   members with their sketches, compare those outside the key's main component with all
   others, and name for each member the others of different components whose Hamming
   distance allows a link, each pair under its smallest common key.  The named members'
   shingle sets then move to their block once each, and the block verifies its pairs there,
   joining components as links are found: a pair already in one component needs no look, and
   a block puts out fewer links than it has members.
4. Verification recomputes the shingle sets from the whole texts and compares sizes exactly
   with integers.

Results for odd input: null text and texts without words have the empty set and link with
nothing; texts of fewer than ``k`` words are one shingle; repeated rows and copies fall
into one class; rows with null doc_id get the smallest id of their copies' component (null
if no copy has an id, and then they link with nothing else); an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.llm.common import boxed, is_broadcastable, key_columns, small_batches, write_table
from tallyspark.llm.components import connected_components
from tallyspark.llm.wordio import mix, split_words, text_slices, word_hashes

BLOCK_BITS = 256
BAND_RATIO = 1.15     # smaller sizes of a band: [1.15^j, 1.15^(j+1))
SPARE_PCT = 35        # further blocks, in percent, so that weak blocks need not be used
SAMPLE_TEXTS = 4_000  # classes sampled to learn common shingles
COMMON_AT = 4         # sampled classes that hold a common shingle
SMALL = 8             # members of a key up to which they are paired by a join
BLOCK_ROWS = 2_000    # members of a key that a task compares with as many others
BLOCK_SHINGLES = 2_000_000  # shingles of these members (16 MB)
COMPARE_WORDS = 1_000_000   # 64-bit words of sketches compared at a time (8 MB)
MAX_COMMON = 1 << 17  # common shingles at most (1 MB, broadcast)
CLASS = ["n", "d1", "d2"]
_LANES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], dtype=np.uint64)


def shingle_sets(texts: pa.Array, k: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text (A-Z lower-cased)."""
    counts, codes, vocabulary = split_words(texts, lower=True)
    hashes = word_hashes(vocabulary)[codes]
    base = np.uint64(0x9FB21C651E98DF25)
    with np.errstate(over="ignore"):
        poly = hashes.copy()
        if len(hashes) >= k:
            for j in range(1, k):
                poly[:len(hashes) - j] = poly[:len(hashes) - j] * base + mix(hashes[j:] + np.uint64(j))
        poly = mix(poly)
    stops = np.cumsum(counts)
    for a, b in zip((stops - counts).tolist(), stops.tolist()):
        if b - a >= k:
            yield np.unique(poly[a:b - k + 1])
        elif b > a:
            with np.errstate(over="ignore"):
                short = np.uint64(b - a)
                for h in hashes[a:b]:
                    short = short * base + mix(h)
                yield np.array([mix(short)], dtype=np.uint64)
        else:
            yield np.empty(0, np.uint64)


def bands(size: int, num: int, den: int) -> list[tuple[int, int]]:
    """(band, largest difference of a linking pair) for each band a set of ``size`` is in.

    Band j holds the pairs whose smaller set has a size in [1.15^j, 1.15^(j+1)).
    """
    out, j = [], max(0, int(np.log(max(size * num / den, 1)) / np.log(BAND_RATIO)) - 2)
    while True:
        low, high = int(np.ceil(BAND_RATIO ** j)), int(np.ceil(BAND_RATIO ** (j + 1))) - 1
        if low > size:
            return out
        top = high * den // num
        if high >= low and size <= top:
            out.append((j, largest_difference(high, top, num, den)))
        j += 1


def largest_difference(a, b, num: int, den: int):
    """Most elements in which linking sets of sizes a and b can differ."""
    return (den - num) * (a + b) // (den + num)


def sketch_keys(shingles: np.ndarray, num: int, den: int, common: np.ndarray) -> np.ndarray:
    """The block keys of one set; two sets that link share at least one, whatever ``common``
    (sorted, the same for all sets) holds."""
    keys = []
    place = np.searchsorted(common, shingles)
    rare = np.append(common, np.uint64(0))[place] != shingles if len(common) else np.ones(len(shingles), bool)
    for band, differ in bands(len(shingles), num, den):
        if differ == 0:
            continue  # only equal sets link, and those are one class
        spare = 1 + differ * SPARE_PCT // 100
        blocks = differ + 1 + spare
        with np.errstate(over="ignore"):
            token = mix(shingles + np.uint64(band))
            block = ((token >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)
            sketch = _flip(block * np.uint64(BLOCK_BITS) + (token & np.uint64(BLOCK_BITS - 1)), blocks * BLOCK_BITS)
            sketch = sketch.reshape(blocks, -1)
            number = np.arange(blocks, dtype=np.uint64) + np.uint64(band << 40)
            key = mix((mix(sketch + _LANES) * _LANES).sum(axis=1, dtype=np.uint64) + mix(number))
        n_rare = np.bincount(block[rare].astype(np.int64), minlength=blocks)
        weak_first = np.lexsort((key, np.bitwise_count(sketch).sum(axis=1), n_rare))
        keys.append(key[weak_first[spare:]])
    return np.concatenate(keys) if keys else np.empty(0, np.uint64)


def _flip(bits: np.ndarray, size: int) -> np.ndarray:
    """Parity of how often each of ``size`` bits is named, as 64-bit words."""
    sketch = np.zeros(size // 64, dtype=np.uint64)
    np.bitwise_xor.at(sketch, (bits >> np.uint64(6)).astype(np.int64), np.uint64(1) << (bits & np.uint64(63)))
    return sketch


def whole_sketch(shingles: np.ndarray, num: int, den: int) -> bytes:
    """Parity sketch of a set in a power of two of bits, sixteen times the difference it must tell."""
    most = largest_difference(len(shingles), len(shingles) * den // num, num, den)
    size = max(512, 1 << int(8 * most).bit_length())
    return _flip(mix(shingles ^ _LANES[3]) & np.uint64(size - 1), size).tobytes()


def hamming(a: bytes, b: bytes) -> int:
    """Bits in which two whole sketches differ; the longer one is folded to the shorter's size."""
    x, y = sorted((np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)), key=len)
    if len(y) > len(x):
        y = np.bitwise_xor.reduce(y.reshape(-1, len(x)), axis=0)
    return int(np.bitwise_count(x ^ y).sum())


def _digest(shingles: np.ndarray) -> tuple[int, int]:
    with np.errstate(over="ignore"):
        a = mix(shingles).sum(dtype=np.uint64)
        b = np.bitwise_xor.reduce(mix(shingles ^ _LANES[0])) if len(shingles) else np.uint64(0)
    return int(a.astype(np.int64)), int(np.uint64(b).astype(np.int64))


def _text_hash(text: Column) -> Column:
    return key_columns(F.lit(None), text)[2]


def _set_table(docs: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """(doc_id, text_hash, n, d1, d2, sketch): size, digest and whole sketch of each text's shingle set."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in text_slices(batch.column("text")):
                part = batch.slice(start, stop - start)
                rows = [(len(s), *_digest(s), whole_sketch(s, num, den)) for s in shingle_sets(part.column("text"), k)]
                kinds = [pa.int64()] * 3 + [pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("text_hash"), *(pa.array(c, kind) for c, kind in zip(zip(*rows), kinds))],
                    names=["doc_id", "text_hash", *CLASS, "sketch"])

    hashed = docs.select("doc_id", "text", _text_hash(F.col("text")).alias("text_hash"))
    return hashed.mapInArrow(sets, "doc_id long, text_hash long, n long, d1 long, d2 long, sketch binary")


def _common_shingles(docs: DataFrame, classes: DataFrame, k: int) -> np.ndarray:
    """Sorted shingles that at least ``COMMON_AT`` of ``SAMPLE_TEXTS`` classes hold, the most
    frequent ``MAX_COMMON``; the sample is the classes of smallest digest hash."""
    chosen = (classes.where("rep IS NOT NULL").orderBy(F.xxhash64("d1"), "cid").limit(SAMPLE_TEXTS)
              .select(F.col("rep").alias("s_rep")))

    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in text_slices(batch.column("text")):
                found = list(shingle_sets(batch.column("text").slice(start, stop - start), k))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).view(np.int64))], names=["shingle"])

    texts = docs.join(F.broadcast(chosen), F.col("doc_id") == F.col("s_rep")).select("text").distinct()
    found = (texts.mapInArrow(shingles, "shingle long").groupBy("shingle").agg(F.count("*").alias("n"))
             .where(F.col("n") >= COMMON_AT).orderBy(F.desc("n"), "shingle").limit(MAX_COMMON).select("shingle"))
    return np.sort(found.toPandas()["shingle"].to_numpy(np.int64).view(np.uint64))


def _key_table(docs: DataFrame, k: int, num: int, den: int, common: np.ndarray) -> DataFrame:
    """(key, d1): block keys of each class, once per task however often a text recurs."""
    shared = docs.sparkSession.sparkContext.broadcast(common)

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            for start, stop in text_slices(batch.column("text")):
                if len(seen) > 1_000_000:
                    seen.clear()
                out, owners = [np.empty(0, np.uint64)], []
                for shingles in shingle_sets(batch.column("text").slice(start, stop - start), k):
                    digest = _digest(shingles)
                    if len(shingles) and digest not in seen:
                        seen.add(digest)
                        out.append(sketch_keys(shingles, num, den, shared.value))
                        owners.append((digest[0], len(out[-1])))
                flat = np.concatenate(out).view(np.int64)
                owner = np.repeat(np.array([o for o, _ in owners], dtype=np.int64), [n for _, n in owners])
                for a in range(0, len(flat), 200_000):
                    yield pa.RecordBatch.from_arrays([pa.array(flat[a:a + 200_000]), pa.array(owner[a:a + 200_000])],
                                                     names=["key", "d1"])

    return docs.select("text").mapInArrow(keys, "key long, d1 long")


def _verify(pairs: DataFrame, texts: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """The class pairs ``(a, b)`` that link.

    A text speaks for a class only if it has the class's digest (rows with equal ids may
    have other texts).
    """

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in text_slices(batch.column("text_a"), 4_000_000):
                part = batch.slice(start, stop - start)
                links = []
                for x, y, of_x, of_y in zip(shingle_sets(part.column("text_a"), k), shingle_sets(part.column("text_b"), k),
                                            part.column("d_a").to_pylist(), part.column("d_b").to_pylist()):
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    links.append(den * both >= num * (len(x) + len(y) - both) and both > 0
                                 and _digest(x)[0] == of_x and _digest(y)[0] == of_y)
                yield part.select(["a", "b"]).filter(pa.array(links, pa.bool_()))

    left = texts.select(F.col("rep").alias("r_a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("rep").alias("r_b"), F.col("text").alias("text_b"))
    return (pairs.join(left, "r_a").join(right, "r_b").select("a", "b", "d_a", "d_b", "text_a", "text_b")
            .mapInArrow(check, "a long, b long").distinct())


def _near_sketches(pairs: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b, r_a, r_b, d_a, d_b) of the pairs whose sketches differ in no more bits than linking sets can."""

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [hamming(x, y) <= largest_difference(n, m, num, den) for x, y, n, m in zip(
                *(batch.column(c).to_pylist() for c in ("sketch_a", "sketch_b", "n_a", "n_b")))]
            yield batch.select(["cid_a", "cid_b", "rep_a", "rep_b", "x", "y"]).rename_columns(
                ["a", "b", "r_a", "r_b", "d_a", "d_b"]).filter(pa.array(kept, pa.bool_()))

    return pairs.mapInArrow(near, "a long, b long, r_a long, r_b long, d_a long, d_b long")


def _texts_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(rep, text) of the documents that ``ids(rep)`` name; repetitions meet in one row."""
    ids = write_table(ids.distinct(), "involved")
    # few ids are broadcast, more are joined by shuffle
    wanted = F.broadcast(ids) if is_broadcastable(ids.count()) else ids
    return (docs.join(wanted, F.col("doc_id") == F.col("rep")).groupBy("rep").agg(F.collect_set("text").alias("text"))
            .select("rep", F.explode("text").alias("text")))


def _mixed(labelled: DataFrame) -> DataFrame:
    """The members of keys that hold several components, with the key's main one and its size."""
    sizes = labelled.groupBy("key", "component").agg(F.count("*").alias("rows"), F.sum("n").alias("shingles"))
    mixed = (sizes.groupBy("key").agg(F.max(F.struct("rows", "component")).alias("main"), F.sum("rows").alias("members"),
                                     F.sum("shingles").alias("shingles"), F.count("*").alias("parts"))
             .where("parts > 1").select("key", F.col("main.component").alias("main"), "members", "shingles"))
    return labelled.join(mixed, "key")


def _few_pairs(open_keys: DataFrame) -> DataFrame:
    """Pairs (x, y) of different components among the members of keys of up to ``SMALL`` members."""
    small = open_keys.where(F.col("members") <= SMALL)
    return (small.where("component <> main").select("key", F.col("d1").alias("x"), F.col("component").alias("c_x"))
            .join(small.select("key", F.col("d1").alias("y"), F.col("component").alias("c_y")), "key")
            .where("c_x <> c_y").select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct())


def _near_members(open_keys: DataFrame, names: DataFrame, num: int, den: int) -> DataFrame:
    """(block, d1, cid, component, near): members of larger keys, block by block, with the
    members of other components whose sketches allow a link; a pair is named by one of its two,
    and members in no pair are left out."""
    open_keys = open_keys.where(F.col("members") > SMALL)
    keys = open_keys.groupBy("d1").agg(F.collect_list("key").alias("keys"))  # at most the block keys of one text
    rows = open_keys.join(keys, "d1").join(names.select("d1", "sketch"), "d1")
    blocks = F.ceil(F.greatest(F.col("members") / BLOCK_ROWS, F.col("shingles") / BLOCK_SHINGLES))
    mine = F.pmod(F.xxhash64("d1"), blocks)
    rows = (rows.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
            .withColumn("block_a", F.least("mine", "other")).withColumn("block_b", F.greatest("mine", "other")))

    def compare(g: pd.DataFrame) -> pd.DataFrame:
        key, a, b = (g[c].iloc[0] for c in ("key", "block_a", "block_b"))
        words = [np.frombuffer(x, np.uint64) for x in g["sketch"]]
        width = min(map(len, words))
        sketches = np.stack([np.bitwise_xor.reduce(w.reshape(-1, width), axis=0) for w in words])
        n, d1, part = g["n"].to_numpy(), g["d1"].to_numpy(), g["mine"].to_numpy()
        component, is_main = g["component"].to_numpy(), (g["component"] == g["main"]).to_numpy()
        # the smaller keys of each member, as numbers: a pair belongs to its smallest common key
        flat = np.concatenate(g["keys"].to_list())
        smaller = flat < key
        stops = np.concatenate([[0], np.cumsum(smaller)])[np.cumsum([len(k) for k in g["keys"]])].tolist()
        names, codes = np.unique(flat[smaller], return_inverse=True)
        below = [codes[start:stop] for start, stop in zip([0, *stops], stops)]
        marked = np.zeros(len(names), dtype=bool)
        found: dict[int, list[int]] = {}
        minor = np.flatnonzero(~is_main)
        step = max(1, COMPARE_WORDS // sketches.size)
        for at in range(0, len(minor), step):
            x = minor[at:at + step]
            differ = np.bitwise_count(sketches[x][:, None, :] ^ sketches[None]).sum(axis=2)
            near = differ <= largest_difference(n[x][:, None], n[None], num, den)
            near &= component[x][:, None] != component[None]
            near &= (d1[x][:, None] < d1[None]) | is_main[None]
            if a != b:
                near &= part[x][:, None] != part[None]
            for i, others in zip(x.tolist(), near):
                marked[below[i]] = True
                for y in np.flatnonzero(others).tolist():
                    if not marked[below[y]].any():
                        found.setdefault(i, []).append(int(d1[y]))
                        found.setdefault(y, [])
                marked[below[i]] = False
        rows = list(found)
        return pd.DataFrame({"block": f"{key} {a} {b}", "d1": d1[rows], "cid": g["cid"].to_numpy()[rows],
                             "component": component[rows], "near": pd.Series(list(found.values()), dtype=object)})

    return (rows.select("key", "block_a", "block_b", "mine", "d1", "cid", "n", "component", "main", "keys", "sketch")
            .groupBy("key", "block_a", "block_b")
            .applyInPandas(compare, "block string, d1 long, cid long, component long, near array<long>"))


def _shingles_of(docs: DataFrame, ids: DataFrame, k: int) -> DataFrame:
    """(s_d1, shingles): the shingle sets, as 64-bit integers, of the documents named by ``ids(rep)``."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in text_slices(batch.column("text"), 4_000_000):
                found = list(shingle_sets(batch.column("text").slice(start, stop - start), k))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([_digest(s)[0] for s in found], pa.int64()), pa.array([s.tobytes() for s in found], pa.binary())],
                    names=["s_d1", "shingles"])

    return _texts_of(docs, ids).select("text").distinct().mapInArrow(sets, "s_d1 long, shingles binary").dropDuplicates(["s_d1"])


def _block_links(members: DataFrame, shingles: DataFrame, num: int, den: int) -> DataFrame:
    """Links (a, b) between components, verified inside the blocks of ``_near_members``: with the
    components known before, they connect all that its pairs that link connect."""

    def link(g: pd.DataFrame) -> pd.DataFrame:
        sets = [np.frombuffer(x, np.uint64) for x in g["shingles"]]
        at = {d1: i for i, d1 in enumerate(g["d1"].tolist())}
        component, cid = g["component"].tolist(), g["cid"].tolist()
        above = {c: c for c in component}

        def top(c: int) -> int:
            while above[c] != c:
                above[c] = c = above[above[c]]
            return c

        links = []
        for i, near in enumerate(g["near"]):
            for y in near.tolist():
                j = at[y]
                c, d = top(component[i]), top(component[j])
                if c == d:
                    continue
                both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if den * both >= num * (len(sets[i]) + len(sets[j]) - both):
                    above[c] = d
                    links.append((min(cid[i], cid[j]), max(cid[i], cid[j])))
        return pd.DataFrame(links, columns=["a", "b"], dtype="int64")

    return (members.join(shingles, F.col("d1") == F.col("s_d1")).select("block", "d1", "cid", "component", "near", "shingles")
            .groupBy("block").applyInPandas(link, "a long, b long"))


def near_duplicates(docs: DataFrame, k: int = 5, num: int = 4, den: int = 5) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs(doc_id, text)``.

    Texts link when the Jaccard similarity of their shingle sets is at least ``num / den``;
    ``component_id`` is the smallest doc_id reachable by links.
    """
    return _components(docs, k, num, den).drop("text_hash")


def _components(docs: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """``near_duplicates`` with the hash of each row's text."""
    # all steps that send rows to workers are written inside; what is returned has joins only
    with small_batches(docs.sparkSession):
        return _joined(docs, k, num, den)


def _joined(docs: DataFrame, k: int, num: int, den: int) -> DataFrame:
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sets = write_table(_set_table(docs, k, num, den), "sets")
    classes = write_table(sets.where("n > 0").groupBy(*CLASS).agg(F.min("doc_id").alias("rep"), F.first("sketch").alias("sketch"))
                          .withColumn("cid", F.monotonically_increasing_id()), "classes")

    # classes that share a key, each with the first class of that key
    by_key = Window.partitionBy("key").orderBy("d1")
    shared = (_key_table(docs, k, num, den, _common_shingles(docs, classes, k))
              .select("key", "d1", F.first("d1").over(by_key).alias("center"), F.lag("d1").over(by_key).alias("before"))
              .where("d1 <> center AND d1 <> before").select("key", "d1", "center"))
    shared = write_table(shared, "shared")
    names = classes.where("rep IS NOT NULL").select("d1", "n", "rep", "cid", "sketch")

    def both_ids(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.col("r_a").alias("rep")).union(pairs.select("r_b"))

    def pairs_of(pairs: DataFrame) -> DataFrame:
        """Pairs (x, y) of class digests as ordered class pairs that sizes and sketches let link."""
        a = names.select(F.col("d1").alias("x"), *(F.col(c).alias(f"{c}_a") for c in ("n", "rep", "cid", "sketch")))
        b = names.select(F.col("d1").alias("y"), *(F.col(c).alias(f"{c}_b") for c in ("n", "rep", "cid", "sketch")))
        return _near_sketches(
            pairs.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).where("x < y").distinct()
            .join(a, "x").join(b, "y").where(F.least("n_a", "n_b") * den >= F.greatest("n_a", "n_b") * num), num, den)

    best = (shared.groupBy("d1", "center").agg(F.count("*").alias("keys")).groupBy("d1")
            .agg(F.max(F.struct("keys", "center")).alias("best")).select(F.col("d1").alias("x"), F.col("best.center").alias("y")))
    first = write_table(pairs_of(best), "pairs")
    links = write_table(_verify(first, _texts_of(docs, both_ids(first)), k, num, den), "verified")
    labels = connected_components(links)

    # keys that still hold several components: the members outside the main one against all
    members = shared.select("key", "d1").union(shared.select("key", F.col("center").alias("d1")).distinct())
    labelled = (members.join(names.select("d1", "cid", "n"), "d1").join(labels, F.col("cid") == F.col("id"), "left")
                .select("key", "d1", "cid", "n", F.coalesce("component", "cid").alias("component")))
    open_keys = write_table(_mixed(labelled), "open")
    second = write_table(pairs_of(_few_pairs(open_keys)).join(first.select("a", "b"), ["a", "b"], "left_anti"), "pairs")
    few = _verify(second, _texts_of(docs, both_ids(second)), k, num, den)
    near = write_table(_near_members(open_keys, names, num, den), "near")
    named = near.select("d1").distinct().join(names.select("d1", "rep"), "d1").select("rep")
    late = write_table(few.union(_block_links(near, _shingles_of(docs, named, k), num, den)).distinct(), "verified")
    if not late.isEmpty():
        labels = connected_components(links.union(late))

    found = classes.join(labels, F.col("cid") == F.col("id"), "left").select(*CLASS, "rep", F.coalesce("component", "cid").alias("component"))
    least = found.groupBy("component").agg(F.min("rep").alias("group_id"))
    groups = found.join(least, "component").select(*(F.col(c).alias(f"g_{c}") for c in CLASS), "group_id")
    on = [sets[c] == groups[f"g_{c}"] for c in CLASS]
    return sets.join(groups, on, "left").select(
        "doc_id", "text_hash", F.col("n").alias("n_shingles"), F.coalesce("group_id", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame, k: int = 5, num: int = 4, den: int = 5) -> DataFrame:
    """The rows of ``docs`` that are the smallest id of their group, all columns unchanged.

    Repeated rows of that id stay together; rows without an id are in no group and stay.  Of
    rows with one id and several texts, each goes or stays by the group of its own text.
    """
    gone = (_components(docs, k, num, den).where("component_id < doc_id")
            .select(F.col("doc_id").alias("gone"), F.col("text_hash").alias("gone_hash")).distinct())
    same = (F.col("row.doc_id") == F.col("gone")) & (_text_hash(F.col("row.text")) == F.col("gone_hash"))
    return boxed(docs).join(gone, same, "left_anti").select("row.*")


def oracle_sql(k: int, num: int, den: int) -> str:
    spans = " || chr(10) || ".join(f"w[i + {j}]" for j in range(k))
    return f"""
WITH RECURSIVE t AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
g AS (SELECT DISTINCT doc_id, {spans} AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - {k - 2})) AS i FROM t WHERE len(w) >= {k})
      UNION ALL SELECT doc_id, array_to_string(w, chr(10)) FROM t WHERE len(w) BETWEEN 1 AND {k - 1}),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM g x JOIN g y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE {den} * c >= {num} * (na.n + nb.n - c)),
r AS (SELECT doc_id AS a, doc_id AS b FROM n UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT t.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(m.c, t.doc_id) AS component_id
FROM t LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT a AS doc_id, min(b) AS c FROM r GROUP BY a) m USING (doc_id)
"""
