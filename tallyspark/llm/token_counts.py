"""Token counts through a digest cache (operator 7).

Counts live in a Parquet table keyed by (content digest, tokenizer digest).  A run
digests every text on the JVM, joins the digests to the stored counts, sends each
*distinct missing* text through the tokenizer once, and appends the new counts; all
documents then read their count from the cache.

Results for odd input: null text counts as the empty text (0 bytes, 0 tokens);
repeated texts share one cache row; null ids are kept; an empty table gives no rows;
special-token strings inside texts are treated as the library's default does.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.wordio import text_slices

CACHE_SCHEMA = "digest string, tokenizer string, n_tokens long"
#: Pieces after which a worker forgets its counts (about 100 MB).
WORKER_ENTRIES = 600_000

#: White space the splitter below does not treat as such; texts with it are encoded whole.
_ODD_SPACE = re.compile(r"[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
#: A piece is a run of white space and the word after it: byte-level BPE never joins a
#: character to white space that follows it, so pieces can be counted on their own.
_PIECE = re.compile(r"[ \t-\r]*[^ \t-\r]+|[ \t-\r]+")
_MARKS = ".,;:!?%*#$&|"

_COUNTERS: dict[str, "PieceCounter"] = {}


class PieceCounter:
    """Token counts of texts under a byte-level BPE file, each distinct piece encoded once."""

    def __init__(self, tokenizer_json: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.known: dict[str, int] = {}

    def _count(self, texts: list[str]) -> list[int]:
        return [len(e.ids) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, pieces: set[str]) -> None:
        if len(self.known) + len(pieces) > WORKER_ENTRIES:
            self.known.clear()
        cuts = {}
        for p in pieces:
            core = p.rstrip(_MARKS)  # a letter never joins the marks after it
            cuts[p] = (core, p[len(core):]) if core and core[-1].isalpha() and core != p else (p, "")
        missing = list({x for cut in cuts.values() for x in cut if x and x not in self.known})
        self.known.update(zip(missing, self._count(missing)))
        for p, (core, tail) in cuts.items():
            if tail:
                self.known[p] = self.known[core] + self.known[tail]

    def counts(self, texts: list[str]) -> list[int]:
        parts = [None if _ODD_SPACE.search(t) else _PIECE.findall(t) for t in texts]
        wanted = set().union(*(p for p in parts if p is not None))
        if missing := {p for p in wanted if p not in self.known}:
            self._learn(missing if len(self.known) + len(missing) <= WORKER_ENTRIES else wanted)
        known = self.known
        whole = iter(self._count([t for t, p in zip(texts, parts) if p is None]))
        return [next(whole) if p is None else sum([known[x] for x in p]) for p in parts]


def _worker_counter(tokenizer_json: str) -> PieceCounter:
    key = hashlib.sha256(tokenizer_json.encode()).hexdigest()
    if key not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[key] = PieceCounter(tokenizer_json)
    return _COUNTERS[key]


def _encode_misses(texts: DataFrame, tokenizer_json: str, version: str) -> DataFrame:
    shared = texts.sparkSession.sparkContext.broadcast(tokenizer_json)  # one vocabulary file

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _worker_counter(shared.value)
        for batch in batches:
            for start, stop in text_slices(batch.column("text")):
                part = batch.slice(start, stop - start)
                n = counter.counts(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column("digest"), pa.array([version] * len(n)), pa.array(n, pa.int64())],
                    names=["digest", "tokenizer", "n_tokens"])

    return texts.mapInArrow(count, CACHE_SCHEMA)


def read_cache(spark, cache_path: str, version: str) -> DataFrame:
    """Stored counts of one tokenizer version, one row per digest (an append that two
    runs made at the same time may have stored a digest twice)."""
    stored = spark.read.schema(CACHE_SCHEMA).parquet(cache_path)
    return stored.where(F.col("tokenizer") == version).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def count_tokens(docs: DataFrame, tokenizer_path: str, cache_path: str, limit: int = 512) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for every row of ``docs(doc_id, text)``.

    ``cache_path`` is a folder all executors reach; it is created if absent and only ever
    appended to.  ``over_limit`` is ``n_tokens > limit``.
    """
    spark = docs.sparkSession
    tokenizer_json = Path(tokenizer_path).read_text(encoding="utf-8")
    version = hashlib.sha256(tokenizer_json.encode()).hexdigest()
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    digest = F.sha2(F.col("text"), 256).alias("digest")

    spark.createDataFrame([], CACHE_SCHEMA).write.mode("append").parquet(cache_path)  # creates the folder
    stored = read_cache(spark, cache_path, version)
    # one partial aggregate per task before the exchange: a text that a third of the rows
    # share leaves each task once
    misses = (texts.select(digest, "text").join(stored.select("digest"), "digest", "left_anti")
              .groupBy("digest").agg(F.first("text").alias("text")))
    _encode_misses(misses, tokenizer_json, version).write.mode("append").parquet(cache_path)

    counts = read_cache(spark, cache_path, version)
    return (texts.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), digest)
            .join(counts, "digest")
            .select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")))
