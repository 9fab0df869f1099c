"""Byte-pair encoding and decoding with a contiguous rank array per word.

The vocabulary file holds what the `tokenizers` library reads: a lower-casing BPE over words whose last symbol carries
an end mark. Text is normalised, split at white space, and every distinct chunk is encoded once per Python worker.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator
from hashlib import sha256

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from otelier.llm.memo import once
from otelier.llm.ragged import span_hashes, spans

SPACE, LETTER, NUMBER, OTHER = range(4)
#: Ranges of Unicode's White_Space.
WHITE_SPACE = ((0x09, 0x0D), (0x20, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A),
               (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000))
_ODD, _MASK = 0x9E3779B97F4A7C15, (1 << 64) - 1
#: Above all ranks.
_NONE = (1 << 31) - 1


def character_kinds() -> np.ndarray:
    """SPACE, LETTER, NUMBER or OTHER for each code point: Unicode White_Space, general categories L and N."""
    kinds = np.array([{"L": LETTER, "N": NUMBER}.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)],
                     dtype=np.uint8)
    for first, last in WHITE_SPACE:
        kinds[first:last + 1] = SPACE
    return kinds


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = [""] * 256
    for b in shown:
        out[b] = chr(b)
    for n, b in enumerate(b for b in range(256) if b not in set(shown)):
        out[b] = chr(256 + n)
    return out


def merge_scan(ids: list[int], rank_of: dict[int, int], made: list[int]) -> list[int]:
    """Merge the pair of lowest rank (leftmost first) until none is left.

    `ids` are the parts between boundaries and `ranks[i]` the rank of parts i and i + 1. Each round scans the ranks for
    the minimum, deletes the boundary and refreshes the two neighbouring ranks. Quadratic, but on the few symbols
    of a word faster than any ordered structure.
    """
    ranks = [rank_of.get(a << 20 | b, _NONE) for a, b in zip(ids, ids[1:])]
    while ranks:
        low = min(ranks)
        if low == _NONE:
            break
        i = ranks.index(low)
        ids[i] = made[low]
        del ids[i + 1], ranks[i]
        if i:
            ranks[i - 1] = rank_of.get(ids[i - 1] << 20 | ids[i], _NONE)
        if i < len(ranks):
            ranks[i] = rank_of.get(ids[i] << 20 | ids[i + 1], _NONE)
    return ids


def merge_heap(ids: list[int], rank_of: dict[int, int], made: list[int]) -> list[int]:
    """The same result for very long words, in n log n."""
    n = len(ids)
    after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
    heap = [(r, i, a, b) for i, (a, b) in enumerate(zip(ids, ids[1:])) if (r := rank_of.get(a << 20 | b)) is not None]
    heapq.heapify(heap)
    while heap:
        r, i, a, b = heapq.heappop(heap)
        j = after[i] if alive[i] else n
        if j >= n or ids[i] != a or ids[j] != b:
            continue
        ids[i], alive[j], after[i] = made[r], False, after[j]
        if after[j] < n:
            before[after[j]] = i
        for left in (before[i], i):
            if left >= 0 and (right := after[left]) < n:
                s = rank_of.get(ids[left] << 20 | ids[right])
                if s is not None:
                    heapq.heappush(heap, (s, left, ids[left], ids[right]))
    return [x for x, keep in zip(ids, alive) if keep]


class PairRanks:
    """Ranks of pairs of ids, for whole arrays at once: a hash table with open addressing."""

    def __init__(self, rank_of: dict[int, int]):
        self.bits = max(8, (3 * len(rank_of)).bit_length())
        self.keys = np.full(1 << self.bits, -1, dtype=np.int64)
        self.ranks = np.full(1 << self.bits, _NONE, dtype=np.int32)
        for key, rank in rank_of.items():
            slot = (key * _ODD & _MASK) >> (64 - self.bits)
            while self.keys[slot] >= 0:
                slot = (slot + 1) & (len(self.keys) - 1)
            self.keys[slot], self.ranks[slot] = key, rank

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of (a, b); _NONE where they don't merge or either is negative (no symbol)."""
        key = np.where((a < 0) | (b < 0), -2, a.astype(np.int64) << 20 | b)
        slot = ((key.astype(np.uint64) * np.uint64(_ODD)) >> np.uint64(64 - self.bits)).astype(np.int64)
        found = self.keys[slot]
        out = np.where(found == key, self.ranks[slot], _NONE)
        pending = np.flatnonzero((found != key) & (found >= 0) & (key >= 0))
        while len(pending):
            slot[pending] = (slot[pending] + 1) & (len(self.keys) - 1)
            found = self.keys[slot[pending]]
            hit = found == key[pending]
            out[pending[hit]] = self.ranks[slot[pending[hit]]]
            pending = pending[~hit & (found >= 0)]
        return out


def word_bytes(chars: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of words end to end, and the number of bytes of each."""
    n_chars = ends - starts
    letters = chars[spans(starts, n_chars)]
    n_bytes = 1 + (letters >= 0x80) + (letters >= 0x800) + (letters >= 0x10000)
    n_bytes = np.add.reduceat(n_bytes.astype(np.int64), np.cumsum(n_chars) - n_chars)
    data = letters.tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass")
    return np.frombuffer(data, dtype=np.uint8), n_bytes


class KnownWords:
    """Ids of words by hash, kept between blocks in sorted arrays of bounded length."""

    LIMIT = 400_000

    def __init__(self):
        self.hashes = np.zeros(0, dtype=np.uint64)
        self.begins = self.counts = np.zeros(0, dtype=np.int64)
        self.ids = np.zeros(0, dtype=np.uint32)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Where each (sorted) hash is, -1 if it isn't."""
        if not len(self.hashes):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, at, -1)

    def add(self, hashes: np.ndarray, at: np.ndarray, fresh: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Take in the words of hashes[fresh]; return where all `hashes` are now. A full store keeps only these."""
        if len(self.hashes) + len(fresh) > self.LIMIT:
            old = np.flatnonzero(at >= 0)
            kept = at[old]
            self.ids = self.ids[spans(self.begins[kept], self.counts[kept])]
            self.hashes, self.counts = self.hashes[kept], self.counts[kept]
            self.begins = np.cumsum(self.counts) - self.counts
        begins = len(self.ids) + np.cumsum(counts) - counts
        self.ids = np.concatenate([self.ids, ids.astype(np.uint32)])
        merged = np.concatenate([self.hashes, hashes[fresh]])
        order = np.argsort(merged, kind="stable")
        self.hashes = merged[order]
        self.begins = np.concatenate([self.begins, begins])[order]
        self.counts = np.concatenate([self.counts, counts])[order]
        return np.searchsorted(self.hashes, hashes)


class WordBpe:
    """Encoder and decoder for one vocabulary file (its JSON text)."""

    #: Words of up to so many symbols are merged side by side, longer ones one by one, very long ones by a heap.
    SIDE_BY_SIDE, LONG = (4, 8, 16, 32), 200

    def __init__(self, text: str):
        spec = json.loads(text)
        vocab, self.end = spec["model"]["vocab"], spec["model"]["end_of_word_suffix"]
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special, self.tokens = special, [""] * (1 + max([*vocab.values(), *special.values()]))
        for token, i in [*vocab.items(), *special.items()]:
            self.tokens[i] = token
        symbols = byte_symbols()
        self.inner = np.array([vocab[s] for s in symbols], dtype=np.int64)
        self.last = np.array([vocab[s + self.end] for s in symbols], dtype=np.int64)
        self.rank_of, made = {}, []
        for rank, (a, b) in enumerate(spec["model"]["merges"]):
            self.rank_of[vocab[a] << 20 | vocab[b]] = rank
            made.append(vocab[a + b])
        self.made, self.made_array = made, np.array(made, dtype=np.int64)
        self.pair_ranks = PairRanks(self.rank_of)
        self.kinds = character_kinds()
        self.known = KnownWords()
        self.split_special = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len)[::-1])) + ")")

    @staticmethod
    def normalise(text: str) -> str:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
            if "Σ" in text:  # lower() looks at the context of this letter, the tokenizer doesn't
                text = text.replace("Σ", "σ")
        return text.lower()

    def word_spans(self, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of words: runs of letters, single digits, runs of other characters but white space.

        Fixed values: the endings 's 't 're 've 'm 'll 'd are words of their own where a word would start with the
        apostrophe.
        """
        n, kind = len(chars), self.kinds[chars]
        start = kind != SPACE
        start[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == NUMBER)
        at = np.flatnonzero(start & (chars == ord("'")))
        if len(at):
            padded = np.concatenate([chars[:0], np.zeros(4, dtype=chars.dtype)])
            near = np.stack([np.where(at + d < n, chars[np.minimum(at + d, n - 1)], padded[0]) for d in (1, 2)])
            one = np.isin(near[0], [ord(c) for c in "stmd"])
            two = np.zeros(len(at), dtype=bool)
            for a, b in ("re", "ve", "ll"):
                two |= (near[0] == ord(a)) & (near[1] == ord(b))
            start[at[one | two] + 1] = False
            rest = np.concatenate([at[one] + 2, at[two] + 3])
            rest = rest[rest < n]
            start[rest[kind[rest] == LETTER]] = True
        inside = kind != SPACE
        stop = inside.copy()
        stop[:-1] &= ~inside[1:] | start[1:]
        return np.flatnonzero(start), np.flatnonzero(stop) + 1

    def merge_words(self, data: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(flat ids, number of ids) of words given as their bytes end to end."""
        ids = self.inner[data]
        starts = np.cumsum(lengths) - lengths
        ids[starts + lengths - 1] = self.last[data[starts + lengths - 1]]
        counts = lengths.copy()
        low = 0
        for width in self.SIDE_BY_SIDE:
            rows = np.flatnonzero((lengths > low) & (lengths <= width))
            low = width
            if not len(rows):
                continue
            parts = np.full((len(rows), width), -1, dtype=np.int32)
            cells = np.arange(width) < lengths[rows][:, None]
            source = spans(starts[rows], lengths[rows])
            parts[cells] = ids[source]
            left = self._merge_side_by_side(parts)
            counts[rows] = left
            target = spans(starts[rows], left)
            ids[target] = parts[np.arange(width) < left[:, None]]
        for row in np.flatnonzero(lengths > low):
            s, n = starts[row], lengths[row]
            merged = (merge_scan if n <= self.LONG else merge_heap)(ids[s:s + n].tolist(), self.rank_of, self.made)
            counts[row] = len(merged)
            ids[s:s + len(merged)] = merged
        return ids[spans(starts, counts)], counts

    def _merge_side_by_side(self, parts: np.ndarray) -> np.ndarray:
        """`merge_scan` on each row of `parts` (padded with -1) in step; returns the parts left in each row."""
        width = parts.shape[1]
        left = (parts >= 0).sum(1)
        if width == 1:
            return left
        ranks = self.pair_ranks(parts[:, :-1].ravel(), parts[:, 1:].ravel()).reshape(-1, width - 1)
        rows, columns = np.arange(len(parts)), np.arange(width)
        p, r = parts, ranks
        while len(rows):
            at = r.argmin(1)
            low = r[np.arange(len(rows)), at]
            go = low < _NONE
            if not go.all():
                parts[rows[~go]] = p[~go]
                rows, p, r, at, low = rows[go], p[go], r[go], at[go], low[go]
                if not len(rows):
                    break
            each = np.arange(len(rows))
            left[rows] -= 1
            # delete the boundary behind part `at`, close up, and refresh the ranks on both sides
            p[:, :-1] = np.where(columns[:-1] > at[:, None], p[:, 1:], p[:, :-1])
            p[:, -1] = -1
            p[each, at] = self.made_array[low]
            r[:, :-1] = np.where(columns[:-2] >= at[:, None], r[:, 1:], r[:, :-1])
            r[:, -1] = _NONE
            r[each, at] = self.pair_ranks(p[each, at], p[each, np.minimum(at + 1, width - 1)])
            before = np.flatnonzero(at > 0)
            r[before, at[before] - 1] = self.pair_ranks(p[before, at[before] - 1], p[before, at[before]])
        return left

    def encode_block(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(flat ids, ids per text). Words are told apart by 64-bit hashes and each distinct one is merged once."""
        lengths = np.array([len(t) for t in texts], dtype=np.int64)
        chars = np.frombuffer("\n".join(texts).encode("utf-32-le", "surrogatepass"), dtype="<u4")
        starts, ends = self.word_spans(chars)
        if not len(starts):
            return np.zeros(0, dtype=np.uint32), np.zeros(len(texts), dtype=np.int64)
        hashes, first, word = np.unique(span_hashes(chars, starts, ends), return_index=True, return_inverse=True)
        at = self.known.find(hashes)
        fresh = np.flatnonzero(at < 0)
        if len(fresh):
            ids, counts = self.merge_words(*word_bytes(chars, starts[first[fresh]], ends[first[fresh]]))
            at = self.known.add(hashes, at, fresh, ids, counts)
        counts, ids = self.known.counts[at], self.known.ids
        begins = self.known.begins[at]
        per_word = counts[word]
        flat = ids[spans(begins[word], per_word)]
        text_ends = np.cumsum(lengths + 1)
        of_text = np.searchsorted(text_ends, starts, side="right")
        return flat.astype(np.uint32), np.bincount(of_text, weights=per_word, minlength=len(texts)).astype(np.int64)

    def encode_many(self, texts: Iterable[str | None], block: int = 500_000) -> Iterator[np.ndarray]:
        """Ids (unsigned 32-bit) of each text in turn. Texts are handled in blocks of about `block` characters."""
        waiting, size = [], 0
        for text in texts:
            text = text or ""
            if any(s in text for s in self.special):
                yield from self._flush(waiting)
                waiting, size = [], 0
                yield self.encode_special(text)
                continue
            waiting.append(self.normalise(text))
            size += len(text) + 1
            if size >= block:
                yield from self._flush(waiting)
                waiting, size = [], 0
        yield from self._flush(waiting)

    def _flush(self, texts: list[str]) -> Iterator[np.ndarray]:
        if texts:
            flat, counts = self.encode_block(texts)
            yield from np.split(flat, np.cumsum(counts)[:-1])

    def encode_special(self, text: str) -> np.ndarray:
        """A text that holds strings of special tokens, which the library cuts out before it normalises."""
        parts = [
            np.array([self.special[p]], dtype=np.uint32) if p in self.special else self.encode_block([self.normalise(p)])[0]
            for p in self.split_special.split(text)]
        return np.concatenate(parts)

    def encode(self, text: str) -> list[int]:
        return next(self.encode_many([text])).tolist()

    def decode(self, ids: Iterable[int]) -> str:
        """Tokens joined by a space, which is what the library gives for a vocabulary without a decoder."""
        return " ".join(map(self.tokens.__getitem__, ids))


def read_vocabulary(path: str) -> str:
    """The vocabulary file, read once on the driver: a few MB that do not depend on the data."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def encoder(vocabulary: str) -> WordBpe:
    return once(("word-bpe", len(vocabulary), hash(vocabulary)), lambda: WordBpe(vocabulary))


def encode_documents(docs: DataFrame, path: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Rows (key, ids, decoded): token ids as bytes (unsigned 32-bit, little-endian) and the decoded text.

    Narrow, one row out per row in. Null text counts as empty: no ids, empty text. Repeated rows give repeated rows, a
    null key stays null, other columns are left out, an empty table gives no rows.
    """
    return _narrow(docs, path, text, key, "ids binary, decoded string",
                   lambda ids, decoded: (ids.astype("<u4").tobytes(), decoded))


def encoding_digests(docs: DataFrame, path: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """`encode_documents`, as n_tokens, ids_sha256 and decoded_sha256, taken where the ids are, so that ids stay there."""
    return _narrow(docs, path, text, key, "n_tokens bigint, ids_sha256 string, decoded_sha256 string",
                   lambda ids, decoded: (len(ids), sha256(ids.astype("<u4").tobytes()).hexdigest(),
                                         sha256(decoded.encode("utf-8", "surrogatepass")).hexdigest()))


def _narrow(docs: DataFrame, path: str, text: str, key: str, columns: str, result) -> DataFrame:
    vocabulary, names = read_vocabulary(path), [c.split()[0] for c in columns.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = encoder(vocabulary)
        for batch in batches:
            rows = [result(ids, bpe.decode(ids.tolist())) for ids in bpe.encode_many(batch["t"])]
            yield pd.DataFrame({"k": batch["k"]} | dict(zip(names, map(list, zip(*rows)) if rows else [[]] * len(names))))

    kind = docs.schema[key].dataType.simpleString()
    out = docs.select(F.col(key).alias("k"), F.col(text).alias("t")).mapInPandas(run, f"k {kind}, {columns}")
    return out.withColumnRenamed("k", key)
