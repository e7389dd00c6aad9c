"""Token ids through the public tokenizers, with a bounded word cache per Python worker.

The word-level BPE never joins characters across white space, so a text's ids are the
ids of its white-space separated words in order.  Every distinct word is encoded by the
library once per worker (a bounded cache), and the ids of all texts of a slice are
gathered with numpy.
"""

from __future__ import annotations

import hashlib
import os
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tallyspark.llm.wordio import split_words

#: Pieces after which a worker's cache is emptied (about 100 MB).
CACHE_ENTRIES = 600_000
#: A word of these letters followed by these marks is cut between them by the pre-tokenizer.
LETTERS = "".join(map(chr, [*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC0, 0xD7), *range(0xD8, 0xF7), *range(0xF8, 0x100)]))
MARKS = ".,;:!?%*#$&|"

_ENCODERS: dict[str, "WordEncoder"] = {}


def worker_encoder(tokenizer_json: str, max_entries: int = CACHE_ENTRIES) -> "WordEncoder":
    """The encoder of this Python worker for the given tokenizer file content."""
    key = hashlib.sha256(tokenizer_json.encode()).hexdigest()
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = WordEncoder(tokenizer_json)
    _ENCODERS[key].max_entries = max_entries
    return _ENCODERS[key]


class WordEncoder:
    """Encodes many texts with a tokenizer that separates words at white space."""

    def __init__(self, tokenizer_json: str, max_entries: int = CACHE_ENTRIES) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.max_entries = max_entries
        self.cache: dict[str, bytes] = {}
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.word_end = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.word_end[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_words(self, words: list[str]) -> list[bytes]:
        """Encode letter-only words, many to a call, and cut the ids at the word ends."""
        out: list[bytes] = []
        for start in range(0, len(words), 2000):
            part = words[start:start + 2000]
            flat = self._encode([" ".join(part)])[0]
            stops = (np.flatnonzero(self.word_end[np.frombuffer(flat, dtype=np.uint32)]) + 1) * 4
            if len(stops) == len(part) and stops[-1] == len(flat):
                begin = 0
                for stop in stops.tolist():
                    out.append(flat[begin:stop])
                    begin = stop
            else:  # the library grouped them otherwise: one by one
                out.extend(self._encode(part))
        return out

    def _pieces(self, words: np.ndarray, plain: np.ndarray) -> list[bytes]:
        """Ids of distinct pieces; ``plain`` marks those of letters only."""
        got = [self.cache.get(w) for w in words]
        missing = [i for i, x in enumerate(got) if x is None]
        if missing:
            letters = [i for i in missing if plain[i]]
            others = [i for i in missing if not plain[i]]
            for where, ids in ((letters, self._encode_words([words[i] for i in letters])),
                               (others, self._encode([words[i] for i in others]))):
                for i, x in zip(where, ids):
                    got[i] = x
            if len(self.cache) + len(missing) > self.max_entries:
                self.cache.clear()
            if len(missing) <= self.max_entries:
                self.cache.update((words[i], got[i]) for i in missing)
        return got

    def encode(self, texts: pa.Array, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """``(offsets, ids)``: the ids of text i are ``ids[offsets[i]:offsets[i + 1]]``,
        ``end_id`` appended to each if given."""
        counts, codes, vocabulary = split_words(texts)
        words = pa.array(vocabulary, type=pa.string())
        # word = letters + marks: two pieces, shared by many words; any other word: one piece
        core, tail = pc.utf8_rtrim(words, MARKS), pc.utf8_ltrim(words, LETTERS)
        cut = pc.and_(pc.equal(pc.utf8_ltrim(tail, MARKS), ""), pc.not_equal(core, ""))
        pieces = pa.concat_arrays([pc.if_else(cut, pc.ascii_lower(core), words), pc.if_else(cut, tail, "")]).dictionary_encode()
        piece_of = pieces.indices.to_numpy(zero_copy_only=False)
        strings = pieces.dictionary.to_numpy(zero_copy_only=False)
        plain = np.zeros(len(strings), dtype=bool)
        plain[piece_of[:len(words)][cut.to_numpy(zero_copy_only=False)]] = True
        blobs = self._pieces(strings, plain)
        flat = np.frombuffer(b"".join(blobs), dtype=np.uint32)
        sizes = np.fromiter(map(len, blobs), dtype=np.int64, count=len(blobs)) // 4
        # each word as two pieces (the second may be empty), the end id as one more "word"
        sequence = np.empty((len(codes), 2), dtype=np.int64)
        sequence[:, 0], sequence[:, 1] = piece_of[codes], piece_of[len(words):][codes]
        sequence, counts = sequence.reshape(-1), counts * 2
        starts = np.cumsum(sizes) - sizes
        if end_id is not None:
            flat = np.append(flat, np.uint32(end_id))
            sizes, starts = np.append(sizes, 1), np.append(starts, len(flat) - 1)
            sequence = np.insert(sequence, np.cumsum(counts), len(sizes) - 1)
            counts = counts + 1
        lengths = sizes[sequence]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        # source position of every output id: start of its piece + position within the piece
        source = np.repeat(starts[sequence] - (ends - lengths), lengths) + np.arange(total)
        ids = flat[source] if total else np.empty(0, np.uint32)
        return np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])], ids
