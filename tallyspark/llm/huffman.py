"""Token-id files in canonical length-limited Huffman code (operator 8).

Writing: every text is encoded once and its ids kept, compressed, in a scratch table;
global id counts (at most one row per vocabulary entry reaches the driver) give a
canonical code no longer than ``limit`` bits; documents are range-partitioned by doc_id
and each task writes its shard as a sequence of independent blocks.

File format, one Parquet row per block, in document order within the shard:
``shard, block, first_id`` (ids of the shard before the block), ``doc_ids``,
``doc_lengths``, ``n_ids``, ``gaps`` (unsigned 16-bit bit lengths of every
``STEP`` ids: the bit-offset checkpoints), ``payload`` (codes, most significant bit
first).  The code itself is a side table ``(id, bits)``, from which the canonical codes
follow.  Blocks hold whole documents and about ``BLOCK_IDS`` ids.

Reading decodes each block on its own; within a block all checkpoints are decoded side by
side with one table look-up per id.

Results for odd input: null and empty texts are the end id alone; rows with equal doc_id
follow each other in the order of their ids' bytes; null doc_ids come last; an empty table
gives no rows.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.llm.common import write_table
from tallyspark.llm.tokens import worker_encoder
from tallyspark.llm.wordio import text_slices
from tallyspark.session import scratch_path

LIMIT = 18        # longest code in bits: a 256k-entry decoding table
STEP = 64         # ids between checkpoints
BLOCK_IDS = 1 << 16
BLOCK_SCHEMA = ("shard int, block int, first_id long, doc_ids array<long>, doc_lengths array<long>, "
                "n_ids long, gaps binary, payload binary")


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits for positive counts (package-merge)."""
    n = len(counts)
    if n <= 1:
        return np.ones(n, dtype=np.int64)
    limit = max(limit, int(np.ceil(np.log2(n))))
    order = np.argsort(counts, kind="stable")
    weights = counts[order].astype(np.float64) if counts.sum() > 2**62 else counts[order].astype(np.int64)
    level, is_leaf = weights, [np.ones(n, dtype=bool)]
    for _ in range(limit - 1):
        pairs = len(level) // 2
        packages = level[0:2 * pairs:2] + level[1:2 * pairs:2]
        joined = np.concatenate([weights, packages])
        rank = np.argsort(joined, kind="stable")
        level = joined[rank]
        is_leaf.append(rank < n)
    lengths, take = np.zeros(n, dtype=np.int64), 2 * n - 2
    for leaf in reversed(is_leaf):
        leaves = int(leaf[:take].sum())
        lengths[:leaves] += 1
        take = 2 * (take - leaves)
    out = np.empty(n, dtype=np.int64)
    out[order] = lengths
    return out


class Code:
    """Canonical code: symbols by (length, id) get consecutive code words."""

    def __init__(self, ids: np.ndarray, bits: np.ndarray) -> None:
        self.width = int(bits.max()) if len(bits) else 1
        order = np.lexsort((ids, bits))
        ids, bits = ids[order].astype(np.int64), bits[order].astype(np.int64)
        spans = np.left_shift(1, self.width - bits)  # entries of the decoding table per symbol
        ends = np.cumsum(spans)
        size = int(ids.max()) + 1 if len(ids) else 1
        self.words = np.zeros(size, dtype=np.uint64)
        self.bits = np.zeros(size, dtype=np.int64)
        self.words[ids] = ((ends - spans) >> (self.width - bits)).astype(np.uint64)
        self.bits[ids] = bits
        self.table = np.zeros(1 << self.width, dtype=np.uint64)
        filled = np.repeat((ids << 8 | bits).astype(np.uint64), spans)
        self.table[:len(filled)] = filled

    def encode(self, ids: np.ndarray) -> tuple[bytes, bytes]:
        """(payload, checkpoint gaps) of one block."""
        bits = self.bits[ids]
        ends = np.cumsum(bits)
        begins = ends - bits
        total = int(ends[-1]) if len(ends) else 0
        out = np.zeros(total // 64 + 2, dtype=np.uint64)
        word, room = begins >> 6, 64 - (begins & 63) - bits
        values = self.words[ids]
        inside = np.where(room >= 0, values << np.maximum(room, 0).astype(np.uint64),
                          values >> np.maximum(-room, 0).astype(np.uint64))
        first = np.flatnonzero(np.diff(word, prepend=-1))
        if len(first):
            out[word[first]] = np.add.reduceat(inside, first)  # distinct bits: a sum is an or
        over = np.flatnonzero(room < 0)  # at most one code crosses each word boundary
        out[word[over] + 1] += values[over] << (64 + room[over]).astype(np.uint64)
        gaps = np.add.reduceat(bits, np.arange(0, len(bits), STEP)) if len(bits) else bits
        return out.astype(">u8").tobytes()[:(total + 7) // 8], gaps.astype("<u2").tobytes()

    def decode(self, payload: bytes, gaps: bytes, n_ids: int) -> np.ndarray:
        lanes = np.frombuffer(gaps, dtype="<u2").astype(np.int64)
        at = np.cumsum(lanes) - lanes
        padded = np.frombuffer(payload + bytes(STEP * 4 + 8), dtype=np.uint8).astype(np.uint32)
        peek = padded[:-3] << 24 | padded[1:-2] << 16 | padded[2:-1] << 8 | padded[3:]
        out = np.empty((STEP, len(at)), dtype=np.uint32)
        mask, shift = np.uint32((1 << self.width) - 1), 32 - self.width
        for k in range(STEP):
            window = peek[at >> 3] >> (shift - (at & 7)).astype(np.uint32) & mask
            entry = self.table[window]
            out[k] = entry >> np.uint64(8)
            at += (entry & np.uint64(255)).astype(np.int64)
        return out.T.reshape(-1)[:n_ids]


def _id_table(docs: DataFrame, tokenizer_path: str, end_id: int) -> DataFrame:
    """(doc_id, n_ids, ids): every text's ids as compressed little-endian 32-bit integers."""
    shared = docs.sparkSession.sparkContext.broadcast(Path(tokenizer_path).read_text(encoding="utf-8"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        encoder, packer = worker_encoder(shared.value), zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for start, stop in text_slices(batch.column("text")):
                part = batch.slice(start, stop - start)
                offsets, ids = encoder.encode(part.column("text"), end_id)
                # low and high halves apart: the high one is nearly constant
                blobs = [packer.compress(ids[a:b].astype("<u2").tobytes() + (ids[a:b] >> 16).astype(np.uint8).tobytes()
                                         if (ids[a:b] >> 16).any() else ids[a:b].astype("<u2").tobytes())
                         for a, b in zip(offsets.tolist(), offsets[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(np.diff(offsets)), pa.array(blobs, pa.binary())],
                    names=["doc_id", "n_ids", "ids"])

    table = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(encode, "doc_id long, n_ids long, ids binary")
    return write_table(table, "ids")


def _unpack(unpacker, blob: bytes, n: int) -> np.ndarray:
    raw = unpacker.decompress(blob)
    ids = np.frombuffer(raw, dtype="<u2", count=n).astype(np.uint32)
    return ids if len(raw) == 2 * n else ids | np.frombuffer(raw, np.uint8, offset=2 * n).astype(np.uint32) << 16


def _global_counts(table: DataFrame) -> DataFrame:
    """(id, n) over all documents: each task counts its own ids first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpacker, total = zstandard.ZstdDecompressor(), np.zeros(1, dtype=np.int64)
        for batch in batches:
            for n, blob in zip(batch.column("n_ids").to_pylist(), batch.column("ids").to_pylist()):
                part = np.bincount(_unpack(unpacker, blob, n))
                if len(part) > len(total):
                    total = np.concatenate([total, np.zeros(len(part) - len(total), dtype=np.int64)])
                total[:len(part)] += part
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total[ids])], names=["id", "n"])

    return table.select("n_ids", "ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def write_ids(docs: DataFrame, tokenizer_path: str, path: str, end_id: int = 2, limit: int = LIMIT) -> None:
    """Write the ids of ``docs(doc_id, text)`` below ``path`` (``blocks`` and ``code``)."""
    spark = docs.sparkSession
    table = _id_table(docs, tokenizer_path, end_id)
    counts = _global_counts(table).toPandas().sort_values("id")  # at most the vocabulary
    ids, bits = counts["id"].to_numpy(np.int64), code_lengths(counts["n"].to_numpy(np.int64), limit)
    spark.createDataFrame(list(zip(ids.tolist(), bits.tolist())), "id long, bits long").coalesce(1).write.parquet(f"{path}/code")
    shared = spark.sparkContext.broadcast((ids, bits))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        code, unpacker = Code(*shared.value), zstandard.ZstdDecompressor()
        shard, block, before = TaskContext.get().partitionId(), 0, 0
        names = [c.split()[0] for c in BLOCK_SCHEMA.replace("array<long>", "array").split(", ")]
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), pa.binary(), pa.binary()]

        def write(docs_in: list, parts: list[np.ndarray]) -> pa.RecordBatch:
            ids_in = np.concatenate(parts)
            payload, gaps = code.encode(ids_in)
            row = (shard, block, before, docs_in, [len(p) for p in parts], len(ids_in), gaps, payload)
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names=names)

        doc_ids, parts, held = [], [], 0
        for batch in batches:
            for doc_id, n, blob in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "n_ids", "ids"))):
                doc_ids.append(doc_id)
                parts.append(_unpack(unpacker, blob, n))
                held += n
                if held >= BLOCK_IDS:
                    yield write(doc_ids, parts)
                    doc_ids, parts, block, before, held = [], [], block + 1, before + held, 0
        if parts:
            yield write(doc_ids, parts)

    order = F.col("doc_id").asc_nulls_last()
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (table.repartitionByRange(shards, order).sortWithinPartitions(order, "ids")
     .mapInArrow(blocks, BLOCK_SCHEMA).write.option("compression", "uncompressed").parquet(f"{path}/blocks"))


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, decoded from the files."""
    table = spark.read.schema("id long, bits long").parquet(f"{path}/code").toPandas()  # at most the vocabulary
    shared = spark.sparkContext.broadcast((table["id"].to_numpy(np.int64), table["bits"].to_numpy(np.int64)))
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(f"{path}/blocks")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Code(*shared.value)
        names = ["shard", "doc_id", "local_start", "n_tokens", "ids_crc32"]
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i] for c in batch.schema.names}
                lengths = np.asarray(row["doc_lengths"].as_py(), dtype=np.int64)
                ids = code.decode(row["payload"].as_py(), row["gaps"].as_py(), row["n_ids"].as_py())
                stops = np.cumsum(lengths)
                raw = ids.astype("<u4").tobytes()
                crcs = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip((stops - lengths).tolist(), stops.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["shard"].as_py()] * len(lengths), pa.int32()), pa.array(row["doc_ids"].as_py(), pa.int64()),
                     pa.array(stops - lengths + row["first_id"].as_py()), pa.array(lengths), pa.array(crcs, pa.int64())],
                    names=names)

    docs = blocks.mapInArrow(decode, "shard int, doc_id long, local_start long, n_tokens long, ids_crc32 long")
    # one row per shard, read from the block headers
    sizes = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    offsets = sizes.selectExpr("shard", "sum(n) OVER (ORDER BY shard) - n AS offset")
    return docs.join(offsets, "shard").select(
        "doc_id", (F.col("offset") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32")


def scratch_files(spark: SparkSession) -> str:
    """A new folder for token-id files below the shared checkpoint folder."""
    return scratch_path(spark, f"llm-token-files-{uuid.uuid4().hex}")
