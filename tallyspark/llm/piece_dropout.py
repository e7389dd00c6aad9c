"""SentencePiece BPE with seeded merge-dropout, and lossless decoding (operator 4).

Encoding follows the library's agenda: the best-scored adjacent pair is merged first, the
leftmost of equals.  Every candidate taken from the agenda is skipped with probability
``dropout``, decided by a keyed hash of (seed, occurrence, word, span): the same call always
gives the same ids, on any number of tasks and after any retry.  An occurrence's key is a
hash of its document's key and its position, so every occurrence draws for itself.  A
worker's cache, bounded in bytes, holds every word's ids and agenda without skips: an
occurrence that skips none of that agenda takes those ids, and the others are merged once
each, many at a time, drawing as they go.  What the characters of a word join to is looked up
once for all its occurrences in a slice.  ``variants`` (default: none) draws
only that many segmentations of a word.  With ``dropout`` 0 the ids are the library's.

Characters without a piece fall back to byte pieces, also the library's space mark
U+2581 where a text contains it, so decoding gives back every text exactly.

Results for odd input: null and empty texts have no ids and decode to the empty text;
repeated rows (same id, same text) get equal ids; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import heapq
from array import array
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame

from tallyspark.llm.wordio import mix, text_slices

SPACE = "▁"     # the library's mark for a space
_RAW_MARK = ""         # no word is empty: stands for a literal U+2581, never leaves the encoder
CACHE_BYTES = 40_000_000   # of a worker's nodes, checked before every slice
NODE_BYTES = 250           # of a node besides its ids and spans, about
SLICE_BYTES = 2_000_000    # of text encoded at a time
SHORT = 64             # characters up to which words are merged many at a time
MERGE_CELLS = 50_000   # characters of words merged together, about: their arrays stay in a core's cache
STEPS = 16             # candidates of all occurrences looked at one after the other, further ones together
_NEVER = 1 << 62       # on the agenda: no candidate
_ORDER_AT, _LEFT_AT = 40, 32   # bits of an offer: its order, the cell where it starts (at most SHORT + 1), the joined piece
_LEFT_MASK, _PIECE_MASK = (1 << _ORDER_AT - _LEFT_AT) - 1, (1 << _LEFT_AT) - 1
_M64 = (1 << 64) - 1

_CODECS: dict[tuple, "PieceTable"] = {}


def worker_table(model: bytes) -> "PieceTable":
    key = (hashlib.sha256(model).digest(),)
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = PieceTable(model)
    return _CODECS[key]


def worker_codec(model: bytes, seed: int, dropout: float, variants: int | None) -> "PieceCodec":
    key = (hashlib.sha256(model).digest(), seed, dropout, variants)
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = PieceCodec(model, seed, dropout, variants)
    return _CODECS[key]


class PieceTable:
    """The pieces of a model: all that decoding needs."""

    def __init__(self, model: bytes) -> None:
        import sentencepiece

        processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.rank: dict[str, float] = {}
        self.ids: dict[str, int] = {}
        self.byte_ids = [0] * 256
        self.decoded: list[bytes] = []
        for i in range(processor.get_piece_size()):
            piece = processor.id_to_piece(i)
            text = b""
            if processor.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_ids[value], text = i, bytes([value])
            elif not (processor.is_control(i) or processor.is_unknown(i) or processor.is_unused(i)):
                self.rank[piece], self.ids[piece] = -processor.get_score(i), i
                text = piece.replace(SPACE, " ").encode()
            self.decoded.append(text)
        self.decoded_array = pa.array(self.decoded, pa.large_binary())

    def decode(self, ids: np.ndarray) -> str:
        if not len(ids):
            return ""
        found = self.decoded_array.take(pa.array(ids))
        ends = np.frombuffer(found.buffers()[1], dtype=np.int64)[found.offset:found.offset + len(found) + 1]
        text = str(memoryview(found.buffers()[2])[ends[0]:ends[-1]], "utf-8", errors="replace") if ends[-1] else ""
        return text[1:] if text.startswith(" ") else text  # the mark put before every text


class PieceCodec(PieceTable):
    def __init__(self, model: bytes, seed: int = 0, dropout: float = 0.1, variants: int | None = None) -> None:
        super().__init__(model)
        self.seed, self.limit, self.variants = seed, int(dropout * (1 << 32)), variants
        joined = "".join(p for p in self.rank if len(p) > 1)
        # no piece joins a character to a space mark after it, nor any of these to a neighbour
        self.alone = np.zeros(256, dtype=bool)
        self.alone[[ord(c) for c in "\n\t\r\x0b\x0c" if c not in joined]] = True
        self._index_pairs()
        self._forget()

    def _forget(self) -> None:
        """Empty the cache: a node for every word met so far, with the ids it comes to without
        skips and what the skip hash sees of its agenda."""
        self.nodes: dict[str, int] = {}
        self.node_ids: list[bytes] = []
        self.node_spans: list[bytes] = []
        self.node_salts = np.empty(0, np.uint64)
        self.cached_bytes = 0

    def _index_pairs(self) -> None:
        """Arrays for many words at once: an id for every character (those without a piece lie
        above the vocabulary) and a hash table (open addressing, at most a quarter full) of
        the pairs of pieces that join to a piece, with its order on the agenda and that piece."""
        size = len(self.decoded)
        self.char_id = np.arange(size, size + 0x110000, dtype=np.int64)
        self.edge = size + 0x110000  # beside a word: joins with nothing
        for piece, i in self.ids.items():
            if len(piece) == 1:
                self.char_id[ord(piece)] = i
        part = lambda x: self.ids[x] if x in self.ids else int(self.char_id[ord(x)]) if len(x) == 1 else -1
        pairs = [(part(p[:k]) * (self.edge + 1) + part(p[k:]), self.rank[p], i) for p, i in self.ids.items()
                 for k in range(1, len(p)) if part(p[:k]) >= 0 and part(p[k:]) >= 0]
        keys = np.array([x[0] for x in pairs], dtype=np.int64)
        order = np.unique(np.array([x[1] for x in pairs]), return_inverse=True)[1] if pairs else np.empty(0, np.int64)
        bits = max(4, (4 * len(pairs)).bit_length())
        self.pair_shift, mask = np.uint64(64 - bits), (1 << bits) - 1
        self.pair_key = np.full(1 << bits, -1, dtype=np.int64)
        self.pair_offer = np.full(1 << bits, _NEVER, dtype=np.int64)
        slot, left = self._slot(keys), np.arange(len(keys))
        while len(left):
            free = left[self.pair_key[slot[left]] < 0]
            self.pair_key[slot[free]] = keys[free]
            put = self.pair_key[slot[left]] == keys[left]
            at = left[put]
            self.pair_offer[slot[at]] = order[at] << _ORDER_AT | np.array([pairs[i][2] for i in at.tolist()], dtype=np.int64)
            left = left[~put]
            slot[left] = (slot[left] + 1) & mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.pair_shift).view(np.int64)

    def _offer(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Offers (order on the agenda, joined piece) of pairs of ids; no candidate: ``_NEVER``."""
        key = left.astype(np.int64) * (self.edge + 1) + right
        slot = self._slot(key)
        found = self.pair_key.take(slot)
        far = np.flatnonzero((found != key) & (found >= 0))
        while len(far):  # taken by another pair: the next slot
            slot[far] = (slot[far] + 1) & (len(self.pair_key) - 1)
            found[far] = self.pair_key[slot[far]]
            far = far[(found[far] != key[far]) & (found[far] >= 0)]
        return self.pair_offer.take(slot)  # an empty slot holds no candidate

    def _merge_many(self, flat: tuple[np.ndarray, np.ndarray], first: np.ndarray, lengths: np.ndarray, salts: np.ndarray | None):
        """Ids of many words of similar length, each ``first`` to ``first + length`` of ``flat``:
        the ids of characters, and each one's offer with the next.

        Every word is a column of arrays with an edge above and below, a cell for each
        character: the piece that starts there, the cells of its neighbours, and its
        candidate with the piece after it.  All words take their best candidate together,
        step by step, and skip it as their salt says; without salts none is skipped.
        Returns (ids, starts, sizes, spans, their starts, their sizes), the spans of all
        candidates taken without salts only.
        """
        longest, words = int(lengths.max()), len(lengths)
        cell = np.arange(longest + 2)[:, None]
        source = np.clip(first + cell - 1, 0, len(flat[0]) - 1)
        pieces = np.where((cell > 0) & (cell <= lengths), flat[0].take(source), np.int32(self.edge))
        agenda = np.where((cell > 0) & (cell < lengths), flat[1].take(source), _NEVER)
        agenda |= cell << _LEFT_AT        # of equal pieces the leftmost
        cell = cell.astype(np.int32)
        after, before = np.repeat(cell + 1, words, axis=1), np.repeat(cell - 1, words, axis=1)
        rows = np.arange(words)
        ids, sizes, starts, total = [], np.zeros(words, dtype=np.int64), np.zeros(words, dtype=np.int64), 0
        taken, spans = [np.empty(0, np.int64)], [np.empty(0, np.uint64)]
        while True:
            best = agenda.min(axis=0)
            live = best < _NEVER
            n = int(np.count_nonzero(live))
            if 4 * n <= 3 * len(rows):  # put out the words that are done
                done = pieces[1:-1, ~live].T
                real = (done >= 0) & (done < self.edge)
                out, count = self._with_bytes(done[real], real.sum(axis=1))
                sizes[rows[~live]], starts[rows[~live]] = count, total + np.cumsum(count) - count
                ids.append(out)
                total += len(out)
                if not n:
                    break
                keep = np.flatnonzero(live)
                pieces, after, before, agenda = (x.take(keep, axis=1) for x in (pieces, after, before, agenda))
                rows, best = rows[keep], best[keep]
                salts = salts if salts is None else salts[keep]
                at = np.arange(n)
            else:
                at = np.flatnonzero(live)
                best = best[at]
            wide = len(rows)
            piece, following, previous, offers = (x.reshape(-1) for x in (pieces, after, before, agenda))
            left = best >> _LEFT_AT & _LEFT_MASK
            here = left * wide + at
            right = following.take(here)
            gone = right * wide + at
            end = following.take(gone)
            span = self._span(*((x - 1).astype(np.uint64) for x in (left, right, end)))
            if salts is None:
                taken.append(rows[at])
                spans.append(span)
            else:
                skip = self._skipped(salts[at], span)
                offers[here[skip]] = _NEVER
                kept = np.flatnonzero(~skip)
                at, left, here, gone, end, best = (x.take(kept) for x in (at, left, here, gone, end, best))
            beyond = end * wide + at
            new = best & _PIECE_MASK
            piece[here], piece[gone], offers[gone] = new, -1, _NEVER
            following[here], previous[beyond] = end, left
            back = previous.take(here).astype(np.int64)
            behind = back * wide + at
            found = self._offer(np.concatenate([new, piece.take(behind)]), np.concatenate([piece.take(beyond), new]))
            offers[here] = found[:len(at)] | left << _LEFT_AT
            offers[behind] = found[len(at):] | back << _LEFT_AT
        owner = np.concatenate(taken)
        steps = np.bincount(owner, minlength=words)
        return (np.concatenate(ids), starts, sizes, np.concatenate(spans)[np.argsort(owner, kind="stable")],
                np.cumsum(steps) - steps, steps)

    @staticmethod
    def _span(left, right, end):
        """What the skip hash sees of the candidate that joins [left, right) and [right, end)."""
        with np.errstate(over="ignore"):
            return (left * np.uint64(0x165667B19E3779F9) + right * np.uint64(0xD6E8FEB86659FD93)
                    + end * np.uint64(0xA0761D6478BD642F))

    def _skipped(self, salts: np.ndarray, spans: np.ndarray) -> np.ndarray:
        """Whether the occurrences of these salts skip the candidates of these spans."""
        with np.errstate(over="ignore"):
            h = salts ^ spans
            h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
            return ((h ^ (h >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32) < np.uint64(self.limit)

    def _merge_long(self, word: str, salt: int | None) -> tuple[np.ndarray, np.ndarray]:
        """``_merge_many`` for one word, its agenda a heap: n log n for words of any length."""
        n = len(word)
        pieces: list[str | None] = list(word)
        after, before, ends = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
        agenda: list[tuple[float, int, int, int]] = []
        taken = []

        def offer(left: int) -> None:
            right = after[left]
            if right < n and (r := self.rank.get(pieces[left] + pieces[right])) is not None:
                heapq.heappush(agenda, (r, left, right, ends[right]))

        for left in range(n - 1):
            offer(left)
        while agenda:
            _, left, right, end = heapq.heappop(agenda)
            if pieces[left] is None or pieces[right] is None or after[left] != right or ends[right] != end:
                continue  # a side has been merged meanwhile
            if salt is None:
                taken.append((left, right, end))
            else:  # ``_skipped`` in whole numbers
                h = salt ^ (left * 0x165667B19E3779F9 + right * 0xD6E8FEB86659FD93 + end * 0xA0761D6478BD642F) & _M64
                h = (h ^ (h >> 32)) * 0xD6E8FEB86659FD93 & _M64
                if ((h ^ (h >> 29)) * 0x9E3779B97F4A7C15 & _M64) >> 32 < self.limit:
                    continue
            pieces[left], pieces[right], ends[left] = pieces[left] + pieces[right], None, end
            after[left] = after[right]
            if after[left] < n:
                before[after[left]] = left
                offer(left)
            if before[left] >= 0:
                offer(before[left])
        ids = np.array([self.ids[p] if p in self.ids else self.char_id[ord(p)] for p in pieces if p is not None], dtype=np.int64)
        return (self._with_bytes(ids, np.array([len(ids)]))[0],
                self._span(*np.array(taken, dtype=np.uint64).T) if taken else np.empty(0, np.uint64))

    def _merge(self, words: list[str], codes: np.ndarray, salts: np.ndarray | None):
        """(ids, starts, sizes, spans, their starts, their sizes) of the occurrences ``words[code]``."""
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        chars = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32)
        first = np.cumsum(lengths) - lengths
        pieces = np.append(self.char_id[chars], self.edge)
        joins = np.append(self._offer(pieces[:-1], pieces[1:]), _NEVER)
        both = pieces.astype(np.int32), joins
        quarter = ((lengths + 3) // 4)[codes]
        order = np.argsort(quarter, kind="stable")
        bounds = np.flatnonzero(np.diff(quarter[order], prepend=-1))
        flat, spans = [np.empty(0, np.uint32)], [np.empty(0, np.uint64)]
        starts, sizes, span_starts, span_sizes = (np.zeros(len(codes), dtype=np.int64) for _ in range(4))
        total, span_total = 0, 0

        def put(at, found) -> None:
            nonlocal total, span_total
            ids, a, n, span, b, m = found
            starts[at], sizes[at], span_starts[at], span_sizes[at] = a + total, n, b + span_total, m
            flat.append(ids)
            spans.append(span)
            total, span_total = total + len(ids), span_total + len(span)

        for low, high in zip(bounds.tolist(), [*bounds[1:].tolist(), len(order)]):
            longest = 4 * int(quarter[order[low]])
            if not longest:
                continue  # the literal mark
            if longest <= SHORT:
                step = max(500, MERGE_CELLS // longest)
                for a in range(low, high, step):
                    at = order[a:min(a + step, high)]
                    put(at, self._merge_many(both, first[codes[at]], lengths[codes[at]], salts if salts is None else salts[at]))
            else:
                for i in order[low:high].tolist():
                    ids, span = self._merge_long(words[codes[i]], salts if salts is None else int(salts[i]))
                    put(i, (ids, 0, len(ids), span, 0, len(span)))
        return np.concatenate(flat), starts, sizes, np.concatenate(spans), span_starts, span_sizes

    def _add(self, words: list[str]) -> None:
        """New nodes for words."""
        start = len(self.node_ids)
        self.nodes.update(zip(words, range(start, start + len(words))))
        if not words:
            return
        flat, starts, sizes, spans, span_starts, span_sizes = self._merge(words, np.arange(len(words)), None)
        raw, seen = flat.tobytes(), spans.tobytes() if self.limit else b""
        ids = [raw[4 * a:4 * (a + n)] for a, n in zip(starts.tolist(), sizes.tolist())]
        if _RAW_MARK in words:
            ids[words.index(_RAW_MARK)] = self._literal_mark()
        found = [seen[8 * a:8 * (a + n)] for a, n in zip(span_starts.tolist(), span_sizes.tolist())]
        if _RAW_MARK in words:
            found[words.index(_RAW_MARK)] = b""
        self.node_ids += ids
        self.node_spans += found
        salts = np.fromiter((xxhash.xxh64_intdigest(w, self.seed & _M64) for w in words), dtype=np.uint64, count=len(words))
        self.node_salts = np.concatenate([self.node_salts, salts])
        self.cached_bytes += sum(map(len, ids)) + sum(map(len, found)) + NODE_BYTES * len(words)

    def _settle(self, words: list[str], codes: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """The node of every occurrence, ``words[code]`` under its key.  ``self.roots`` has the
        nodes of ``words``; numbers above all nodes stand for the occurrences that skip
        candidates, whose ids are (ids, starts, sizes) in ``self.drawn``."""
        if self.cached_bytes > CACHE_BYTES:
            self._forget()
        known = map(self.nodes.get, words)
        self._add([w for w, node in zip(words, known) if node is None])
        self.roots = np.fromiter(map(self.nodes.__getitem__, words), dtype=np.int64, count=len(words))
        self.drawn = np.empty(0, np.uint32), np.empty(0, np.int64), np.empty(0, np.int64)
        node = self.roots[codes]
        if not self.limit or not len(node):
            return node
        with np.errstate(over="ignore"):
            salts = self.node_salts[node] + keys.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
        flat, starts, sizes = _joined([self.node_spans[i] for i in self.roots.tolist()], np.uint64)
        skips = np.zeros(len(node), dtype=bool)
        for a in range(0, len(node), 50_000):
            rows = np.arange(a, min(a + 50_000, len(node)))
            begin, steps, salt = starts[codes[rows]], sizes[codes[rows]], salts[rows]
            for step in range(STEPS):
                on = np.flatnonzero(steps > step)
                if not len(on):
                    break
                rows, begin, steps, salt = (x.take(on) for x in (rows, begin, steps, salt))
                hit = self._skipped(salt, flat.take(begin + step))
                skips[rows[hit]] = True
                steps[hit] = 0
            on = np.flatnonzero(steps > STEPS)
            if not len(on):
                continue
            rows, begin, steps, salt = rows[on], begin[on] + STEPS, steps[on] - STEPS, salt[on]
            ends = np.cumsum(steps)
            source = np.repeat(begin - (ends - steps), steps) + np.arange(int(ends[-1]))
            hit = self._skipped(np.repeat(salt, steps), flat[source])
            skips[rows[np.searchsorted(ends, np.flatnonzero(hit), side="right")]] = True
        rows = np.flatnonzero(skips)
        if len(rows):
            node[rows] = len(self.node_ids) + np.arange(len(rows))
            self.drawn = self._merge(words, codes[rows], salts[rows])[:3]
        return node

    def _ids(self, words: list[str], codes: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, starts, sizes): where the ids of every occurrence start, and how many they are."""
        node = self._settle(words, codes, keys)
        flat, starts, sizes = _joined([self.node_ids[i] for i in self.roots.tolist()], np.uint32)
        starts, sizes = starts[codes], sizes[codes]
        rows = np.flatnonzero(node >= len(self.node_ids))
        drawn, at, n = self.drawn
        starts[rows], sizes[rows] = at + len(flat), n
        return np.concatenate([flat, drawn]), starts, sizes

    def segments(self, words: list[str], keys: list[int]) -> list[bytes]:
        """Ids (native 32-bit integers) of words, each under its key."""
        vocabulary = list(dict.fromkeys(words))
        code = {w: i for i, w in enumerate(vocabulary)}
        flat, starts, sizes = self._ids(vocabulary, np.array([code[w] for w in words], dtype=np.int64), np.array(keys, dtype=np.uint64))
        return [flat[a:a + n].tobytes() for a, n in zip(starts.tolist(), sizes.tolist())]

    def _with_bytes(self, ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``ids`` of rows of these sizes with characters without a piece as their bytes, and the sizes then."""
        size = len(self.decoded)
        bare = np.flatnonzero(ids >= size)
        if not len(bare):
            return ids.astype(np.uint32), sizes
        char = ids[bare] - size
        n = np.ones(len(ids), dtype=np.int64)
        n[bare] += (char >= 0x80).astype(np.int64) + (char >= 0x800) + (char >= 0x10000)
        out = np.repeat(ids, n)
        raw = np.frombuffer(char.astype("<u4").tobytes().decode("utf-32-le").encode(), dtype=np.uint8)
        out[np.repeat(ids >= size, n)] = np.array(self.byte_ids, dtype=np.int64)[raw]
        upto = np.concatenate([[0], np.cumsum(n)])
        ends = np.cumsum(sizes)
        return out.astype(np.uint32), upto[ends] - upto[ends - sizes]

    def _literal_mark(self) -> bytes:
        return array("I", [self.byte_ids[b] for b in SPACE.encode()]).tobytes()

    def _words(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """(words per text, the words of all texts in order as positions in the vocabulary, the
        vocabulary).  A word is one of ``alone``, or spaces with the other characters up to
        the next space; a literal U+2581 is a word of its own."""
        marked = [b" " + t.encode() if t else b"" for t in texts]  # the mark put before every text
        raw = b"".join(marked)
        data = np.frombuffer(raw, dtype=np.uint8)
        bounds = np.concatenate([[0], np.cumsum(np.fromiter(map(len, marked), dtype=np.int64, count=len(marked)))])
        space, start = data == ord(" "), self.alone[data]
        start[1:] |= start[:-1] | space[1:] & ~space[:-1]
        start[bounds[:-1][np.diff(bounds) > 0]] = True
        sign = np.frombuffer(SPACE.encode(), dtype=np.uint8)
        literal = np.flatnonzero(data[:-2] == sign[0]) if len(data) > 2 else np.empty(0, np.int64)
        literal = literal[(data[literal + 1] == sign[1]) & (data[literal + 2] == sign[2])]
        start[literal] = True
        start[(literal + 3)[literal + 3 < len(data)]] = True
        starts = np.flatnonzero(start)
        coded = pa.StringArray.from_buffers(len(starts), pa.py_buffer(np.append(starts, len(data)).astype(np.int32)), pa.py_buffer(raw)).dictionary_encode()
        vocabulary = pc.replace_substring(coded.dictionary, " ", SPACE).to_numpy(zero_copy_only=False).tolist()
        if len(literal):
            vocabulary[coded.dictionary.index(SPACE).as_py()] = _RAW_MARK
        return np.diff(np.searchsorted(starts, bounds)), coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), vocabulary

    def encode(self, texts: list[str], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(offsets, ids)`` of texts; ``keys`` (64 bits each) with the position key every word."""
        counts, codes, vocabulary = self._words(texts)
        at = np.arange(len(codes)) - np.repeat(np.cumsum(counts) - counts, counts)
        with np.errstate(over="ignore"):
            drawn = mix(np.repeat(keys, counts) + at.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        if self.variants:
            drawn %= np.uint64(self.variants)
        flat, starts, lengths = self._ids(vocabulary, codes, drawn)
        ends = np.cumsum(lengths)
        source = np.repeat(starts - (ends - lengths), lengths) + np.arange(int(ends[-1]) if len(ends) else 0)
        return np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])], flat[source]


def _joined(blobs: list[bytes], kind) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Values of all blobs in one array, and where each blob's start and how many they are."""
    flat = np.frombuffer(b"".join(blobs), dtype=kind)
    sizes = np.fromiter(map(len, blobs), dtype=np.int64, count=len(blobs)) // np.dtype(kind).itemsize
    return flat, np.cumsum(sizes) - sizes, sizes


def _documents_key(doc_ids: pa.Array, texts: list[str], seed: int) -> np.ndarray:
    """64 bits per row from its id and text."""
    ids = np.array([0 if i is None else i for i in doc_ids.to_pylist()], dtype=np.int64).astype(np.uint64)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, texts), dtype=np.uint64, count=len(texts))
    with np.errstate(over="ignore"):
        return mix(mix(ids + np.uint64(seed & _M64)) + hashes)


def encode(docs: DataFrame, model_path: str, seed: int = 0, dropout: float = 0.1, variants: int | None = None,
           keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, *keep, ids): ``ids`` is the little-endian 32-bit ids of the text as binary."""
    shared = docs.sparkSession.sparkContext.broadcast(Path(model_path).read_bytes())
    kept = docs.select("doc_id", *keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = worker_codec(shared.value, seed, dropout, variants)
        for batch in batches:
            for start, stop in text_slices(batch.column("__text"), SLICE_BYTES):
                part = batch.slice(start, stop - start)
                texts = [t or "" for t in part.column("__text").to_pylist()]
                offsets, ids = codec.encode(texts, _documents_key(part.column("doc_id"), texts, seed))
                raw = ids.astype("<u4").tobytes()
                blobs = [raw[4 * a:4 * b] for a, b in zip(offsets.tolist(), offsets[1:].tolist())]
                yield pa.RecordBatch.from_arrays([part.column(c) for c in ("doc_id", *keep)] + [pa.array(blobs, pa.binary())],
                                                 names=["doc_id", *keep, "ids"])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields] + ["ids binary"])
    return docs.select("doc_id", *keep, docs["text"].alias("__text")).mapInArrow(run, schema)


def decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """``encoded`` with a column ``decoded``: the text its ``ids`` stand for."""
    shared = encoded.sparkSession.sparkContext.broadcast(Path(model_path).read_bytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = worker_table(shared.value)
        for batch in batches:
            texts = [table.decode(np.frombuffer(x, dtype="<u4")) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, "decoded"])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields] + ["decoded string"])
    return encoded.mapInArrow(run, schema)
