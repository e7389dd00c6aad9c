"""Centroid clustering by subvector dictionaries (operator 11).

Vectors are turned into whole numbers and cut into blocks of ``BLOCK`` dimensions.  Chunks
of up to ``CHUNK`` vectors are dictionary-encoded without loss: per block the distinct
subvectors once, and per vector one code a block.  The encoded chunks are written once.
Each round computes the squared distance of every dictionary entry to every centroid once,
in exact integers, and a vector's distances are the sums of the entries its codes name;
the smallest wins, ties go to the smaller centroid.  Only sums and counts per centroid and
dimension (k x dims rows a task, whatever the input) leave a task; the new centroids, k x
dims whole numbers, go back out with the next round.  Dictionaries belong to a chunk, as
in columnar files: no row is shuffled, so a vector that a third of the rows repeat is one
entry a block here and no hot key, and a lost executor's chunks are read again.

Results for odd input: vectors with another number of components, or any null, NaN or
infinite one, are left out, as are null vectors; rows with a null id are clustered but
never start a centroid before rows with one; repeated rows count as often as they occur
and may start several centroids; with fewer vectors than centroids there are as many
centroids as vectors; without vectors no rows.  Components of 2^27 / scale or more raise:
their squared distances would not fit a long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import write_table

CHUNK, BLOCK = 16_384, 2  # vectors of a chunk (codes are 16 bit), dimensions of a block
LIMIT = 1 << 27
_CHUNKS = "ids array<bigint>, sizes array<int>, entries binary, codes binary"


def whole_vectors(vectors: DataFrame, dims: int, scale: int) -> DataFrame:
    """(vec_id, v) with the kept vectors in whole numbers, v = floor(scale * x)."""
    x = F.col("embedding")
    finite = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    scaled = lambda e: e.cast("double") * scale
    whole = lambda e: F.when(F.abs(scaled(e)) < LIMIT, F.floor(scaled(e)).cast("int")).otherwise(
        F.raise_error(F.concat(F.lit("component too large for exact distances: "), e.cast("string"))).cast("int"))
    return vectors.where((F.size(x) == dims) & finite).select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(x, whole).alias("v"))


def _encoded(ids: list, v: np.ndarray, block: int) -> dict:
    sizes, entries, codes = [], [], np.empty(((v.shape[1] + block - 1) // block, len(v)), "<u2")
    for b in range(len(codes)):
        sub = v[:, b * block:(b + 1) * block]
        distinct, code = np.unique(sub, axis=0, return_inverse=True)
        sizes.append(len(distinct))
        entries.append(distinct.astype("<i4").tobytes())
        codes[b] = code.reshape(-1)
    return {"ids": ids, "sizes": sizes, "entries": b"".join(entries), "codes": codes.tobytes()}


def encode_chunks(whole: DataFrame, dims: int, block: int = BLOCK, chunk: int = CHUNK) -> DataFrame:
    """Chunks of dictionary-encoded vectors: per block its distinct subvectors, per vector and block a code."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed(ids: list, parts: list) -> pa.RecordBatch:
            row = _encoded(ids, np.concatenate(parts), block)
            return pa.RecordBatch.from_pydict({k: [x] for k, x in row.items()}, schema=pa.schema([
                ("ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32())), ("entries", pa.binary()), ("codes", pa.binary())]))

        ids, parts = [], []
        for batch in batches:
            new_ids = batch.column("vec_id").to_pylist()
            v = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
            while len(ids) + len(new_ids) >= chunk:
                take = chunk - len(ids)
                yield packed(ids + new_ids[:take], parts + [v[:take]])
                ids, parts, new_ids, v = [], [], new_ids[take:], v[take:]
            ids, parts = ids + new_ids, parts + [v]
        if ids:
            yield packed(ids, parts)

    return whole.mapInArrow(run, _CHUNKS)


def _decoded(batch: pa.RecordBatch, dims: int, block: int) -> Iterator[tuple[pa.Array, list[np.ndarray], np.ndarray]]:
    """Per chunk its ids, the dictionary of each block and the codes, one row a block."""
    for i in range(batch.num_rows):
        ids = batch.column("ids")[i].values
        sizes = batch.column("sizes")[i].as_py()
        entries = np.frombuffer(batch.column("entries")[i].as_buffer(), "<i4")
        codes = np.frombuffer(batch.column("codes")[i].as_buffer(), "<u2").reshape(len(sizes), len(ids))
        books, at = [], 0
        for b, n in enumerate(sizes):
            width = min(block, dims - b * block)
            books.append(entries[at:at + n * width].reshape(n, width).astype(np.int64))
            at += n * width
        yield ids, books, codes


def _nearest(books: list[np.ndarray], codes: np.ndarray, centroids: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centroid (ties: the smaller) and squared distance of each vector of a chunk."""
    total = np.zeros((codes.shape[1], len(centroids)), np.int64)
    for b, book in enumerate(books):
        gap = book[:, None, :] - centroids[None, :, b * block:(b + 1) * block]
        total += (gap * gap).sum(axis=2)[codes[b]]  # the distances of an entry, taken once, summed by code
    best = total.argmin(axis=1)
    return best, total[np.arange(len(best)), best]


def _sums(chunks: DataFrame, centroids: np.ndarray, dims: int, block: int) -> list:
    """Rows (cluster, dim, n, s): k x dims of them at most, summed over all tasks."""
    k = len(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for batch in batches:
            for _, books, codes in _decoded(batch, dims, block):
                best, _ = _nearest(books, codes, centroids, block)
                n += np.bincount(best, minlength=k)
                for b, book in enumerate(books):
                    # how often a cluster holds an entry, times the entry
                    held = np.bincount(best * len(book) + codes[b], minlength=k * len(book)).reshape(k, len(book))
                    s[:, b * block:b * block + book.shape[1]] += held @ book
        c, d = np.nonzero(np.repeat(n[:, None] > 0, dims, axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32()), pa.array(d, pa.int32()), pa.array(n[c]), pa.array(s[c, d])],
                                         names=["cluster", "dim", "n", "s"])

    out = chunks.mapInArrow(run, "cluster int, dim int, n bigint, s bigint")
    return out.groupBy("cluster", "dim").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect()


def first_centroids(whole: DataFrame, k: int, seed: int) -> np.ndarray:
    """The k vectors of smallest sha256 of "seed:vec_id", in that order; ties by their components."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = whole.select("v", digest.alias("h")).orderBy(F.col("h").asc_nulls_last(), "v").limit(k).collect()
    return np.array([r.v for r in rows], np.int64)


def cluster_vectors(vectors: DataFrame, k: int = 40, rounds: int = 5, dims: int = 64, scale: int = 256, seed: int = 2,
                    block: int = BLOCK) -> DataFrame:
    """One row per kept vector of ``vectors(vec_id, embedding)`` with its cluster after ``rounds`` rounds."""
    whole = whole_vectors(vectors, dims, scale)
    centroids = first_centroids(whole, k, seed)
    schema = "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    if not len(centroids):
        return vectors.sparkSession.createDataFrame([], schema)
    chunks = write_table(encode_chunks(whole, dims, block), "chunks")
    for _ in range(rounds):
        moved = centroids.copy()
        for r in _sums(chunks, centroids, dims, block):
            moved[r.cluster, r.dim] = r.s // r.n  # whole numbers: Python's // is the exact floor
        centroids = moved
    final = centroids

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, books, codes in _decoded(batch, dims, block):
                best, distance = _nearest(books, codes, final, block)
                yield pa.RecordBatch.from_arrays([ids, pa.array(best, pa.int32()), pa.array(distance)],
                                                 names=["vec_id", "cluster", "distance"])

    assigned = write_table(chunks.mapInArrow(assign, "vec_id bigint, cluster int, distance bigint"), "assigned")
    inertia = {r.cluster: int(r.d) for r in assigned.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()}  # k rows
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    facts = vectors.sparkSession.createDataFrame(
        [(c, inertia[c], sum(inertia.values()), digests[c]) for c in sorted(inertia)],
        "c int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return assigned.join(F.broadcast(facts), F.col("cluster") == F.col("c")).drop("c")  # k rows


def oracle_sql(k: int, rounds: int, dims: int, scale: int, seed: int) -> str:
    """The same in DuckDB, with every distance taken from the whole vectors."""
    def nearest(table: str) -> str:
        return f"""(
  SELECT rid, vec_id, v, cid, dist FROM (
    SELECT rid, vec_id, v, cid, list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS dist,
           row_number() OVER (PARTITION BY rid ORDER BY dist, cid) AS place FROM kept, {table}) WHERE place = 1)"""

    steps = []
    for r in range(rounds):
        steps.append(f"a{r} AS MATERIALIZED {nearest(f'c{r}')}")
        steps.append(f"""m{r} AS MATERIALIZED (
  SELECT cid, list((s - ((s % n) + n) % n) // n ORDER BY d) AS c
  FROM (SELECT cid, d, sum(x)::BIGINT AS s, count(*) AS n
        FROM (SELECT cid, unnest(range(1, {dims + 1})) AS d, unnest(v) AS x FROM a{r}) GROUP BY cid, d) GROUP BY cid)""")
        steps.append(f"c{r + 1} AS MATERIALIZED (SELECT cid, coalesce(m{r}.c, c{r}.c) AS c FROM c{r} LEFT JOIN m{r} USING (cid))")
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dims}),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, v) - 1 AS cid, v AS c
  FROM (SELECT v, sha256('{seed}:' || vec_id) AS h FROM kept ORDER BY h, v LIMIT {k})),
{(',' + chr(10)).join(steps)},
final AS MATERIALIZED {nearest(f'c{rounds}')}
SELECT vec_id, cid::INT AS cluster, dist::BIGINT AS distance, sum(dist) OVER (PARTITION BY cid)::BIGINT AS cluster_inertia,
       sum(dist) OVER ()::BIGINT AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM final JOIN c{rounds} USING (cid)
"""
