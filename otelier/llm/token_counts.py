"""Token counts by a finite-state transducer compiled from a byte-pair vocabulary.

A state is what reading more text can depend on: the longest end of the text that a longer piece may begin with, the
last token of the encoding up to each position in it, and how the token counts of these positions differ. A transition
reads one character and is annotated with the change of the token count, so the counts of a path add up to the number
of tokens. States and transitions are compiled when first met and kept per Python worker.

Which token ends at a position follows from the encodings of shorter prefixes: exactly one piece ends there that is its
own encoding and stays as it is next to the token before it. That holds for any merge order by rank of the merged piece.

No piece has a word mark behind another character, and unknown characters (bytes) never merge, so texts are cut there:
a chunk that begins so maps every state to the same one. Long stretches without a cut are chunked by length. Every chunk
gets its map from the states that chunks before it can leave to, all side by side; the maps are composed pairwise.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import sentencepiece
from pyspark.sql import DataFrame, functions as F

from otelier.llm.memo import once
from otelier.llm.ragged import span_hashes, spans

MARK = "▁"
LIMIT = 4096
#: Characters of a chunk within a stretch without cuts.
CHUNK = 64
#: Rounds in which maps are extended to further states, for all chunks side by side.
ROUNDS = 8
_ODD = np.uint64(0x9E3779B97F4A7C15)


class Transducer:
    """Compiled lazily from the pieces and scores of a vocabulary."""

    #: Start afresh beyond so many states, so that memory stays bounded.
    MAX_STATES = 300_000

    def __init__(self, scores: dict[str, float]):
        self.scores = scores
        letters = sorted({c for p in scores for c in p})
        if any(c not in scores for c in letters):
            raise ValueError("every character of a piece must be a piece")
        if any(MARK in p.lstrip(MARK) for p in scores):
            raise ValueError("a piece has a word mark behind another character")
        self.letters = dict(zip(letters, range(1, len(letters) + 1)))
        self.class_of = np.zeros(0x110000, dtype=np.int64)
        for c, n in self.letters.items():
            self.class_of[ord(c)] = n
        self.class_of[ord(" ")] = self.letters[MARK]
        self.letter = ["", *letters]
        self.width = len(self.letter)
        self.begins = {p[:n] for p in scores for n in range(1, len(p))}
        self.own = {p for p in scores if self.encode(p) == [p]}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.reset()

    def encode(self, text: str) -> list[str]:
        """Pieces of a short text: merge the neighbours with the best score, leftmost first, until none is left."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = self.scores.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def fits(self, left: str, right: str) -> bool:
        """Whether two tokens stay as they are next to each other."""
        known = self.pairs.get((left, right))
        if known is None:
            known = self.pairs[left, right] = self.encode(left + right) == [left, right]
        return known

    def reset(self) -> None:
        self.ids: dict[tuple, int] = {}
        self.states: list[tuple] = []
        self.bits = 16
        self.keys = np.full(1 << self.bits, -1, dtype=np.int64)
        self.values = np.zeros((1 << self.bits, 2), dtype=np.int32)
        self.used = 0
        if len(self.pairs) > 4 * self.MAX_STATES:
            self.pairs.clear()
        self.start = self._id(("", (None,), (0,)))

    def _id(self, state: tuple) -> int:
        n = self.ids.setdefault(state, len(self.states))
        if n == len(self.states):
            self.states.append(state)
        return n

    def _step(self, state: tuple, c: str) -> tuple[tuple, int]:
        """(next state, change of the count). In a state the newest position comes first."""
        end, tokens, counts = state
        text = end + c
        for n in range(1, len(text) + 1):
            token, before = text[-n:], tokens[n - 1]
            if token in self.own and (before is None or self.fits(before, token)):
                break
        change = counts[n - 1] + 1
        keep = next((m for m in range(len(text), 0, -1) if text[-m:] in self.begins), 0)
        now = (token, *tokens)[:keep + 1]
        relative = tuple(x - change for x in (change, *counts))[:keep + 1]
        return (text[len(text) - keep:], now, relative), change

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * _ODD) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _insert(self, keys: np.ndarray, values: np.ndarray) -> None:
        if 2 * (self.used + len(keys)) > len(self.keys):
            old = self.keys >= 0
            keys, values = np.concatenate([self.keys[old], keys]), np.concatenate([self.values[old], values])
            while 2 * len(keys) > 1 << self.bits:
                self.bits += 1
            self.bits += 1
            self.keys = np.full(1 << self.bits, -1, dtype=np.int64)
            self.values = np.zeros((1 << self.bits, 2), dtype=np.int32)
            self.used = 0
        self.used += len(keys)
        slot, left = self._slots(keys), np.arange(len(keys))
        while len(left):
            free = self.keys[slot[left]] < 0
            take = left[free]
            _, first = np.unique(slot[take], return_index=True)  # one key per free slot
            take = take[first]
            self.keys[slot[take]], self.values[slot[take]] = keys[take], values[take]
            placed = np.zeros(len(keys), dtype=bool)
            placed[take] = True
            left = left[~placed[left]]
            slot[left] = (slot[left] + 1) & (len(self.keys) - 1)

    def _find(self, keys: np.ndarray) -> np.ndarray:
        slot = self._slots(keys)
        out = np.where(self.keys[slot] == keys, slot, -1)
        left = np.flatnonzero((out < 0) & (self.keys[slot] >= 0))
        while len(left):
            slot[left] = (slot[left] + 1) & (len(self.keys) - 1)
            found = self.keys[slot[left]]
            hit = found == keys[left]
            out[left[hit]] = slot[left[hit]]
            left = left[~hit & (found >= 0)]
        return out

    def step(self, states: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All lanes read one character: (next states, changes of the counts)."""
        keys = states * self.width + classes
        at = self._find(keys)
        missing = np.unique(keys[at < 0])
        if len(missing):
            made = np.empty((len(missing), 2), dtype=np.int32)
            for i, key in enumerate(missing.tolist()):
                following, change = self._step(self.states[key // self.width], self.letter[key % self.width])
                made[i] = self._id(following), change
            self._insert(missing, made)
            at = self._find(keys)
        return self.values[at, 0].astype(np.int64), self.values[at, 1]

    def run(self, classes: np.ndarray, starts: np.ndarray, lengths: np.ndarray, entry: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The maps of chunks at one state each: (state behind the chunk, tokens it adds)."""
        order = np.argsort(-lengths, kind="stable")
        at, state = starts[order], entry[order].copy()
        total = np.zeros(len(at), dtype=np.int64)
        live = np.searchsorted(-lengths[order], -np.arange(1, int(lengths.max(initial=0)) + 1), side="right")
        for i, n in enumerate(live.tolist()):
            state[:n], change = self.step(state[:n], classes[at[:n] + i])
            total[:n] += change
        exits, counts = np.empty_like(state), np.empty_like(total)
        exits[order], counts[order] = state, total
        return exits, counts

    def count_stretches(self, classes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Tokens of each stretch between cuts."""
        if len(self.states) > self.MAX_STATES:
            self.reset()
        lengths = ends - starts
        out = np.zeros(len(starts), dtype=np.int64)
        short = np.flatnonzero(lengths <= CHUNK)
        _, out[short] = self.run(classes, starts[short], lengths[short], np.full(len(short), self.start))
        long = np.flatnonzero(lengths > CHUNK)
        if len(long):
            out[long] = self._count_long(classes, starts[long], ends[long])
        return out

    def _count_long(self, classes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Tokens of stretches of several chunks. Each chunk gets its map from every state that a run before it may leave to
        (state behind it, tokens); maps are composed pairwise, in as many steps as the number of chunks has digits. Most
        states forget what was before a chunk, so maps close after two or three rounds. Stretches that keep meeting new
        states, such as one letter repeated, are chained chunk by chunk, where each distinct (chunk, state) is run once."""
        chunks = -(-(ends - starts) // CHUNK)
        owner = np.repeat(np.arange(len(starts)), chunks)
        first = np.cumsum(chunks) - chunks
        number = np.arange(len(owner)) - first[owner]
        begin = starts[owner] + number * CHUNK
        size = np.minimum(ends[owner] - begin, CHUNK)
        more = number < chunks[owner] - 1
        # equal chunks, told by 64-bit hashes, share their maps
        _, example, content = np.unique(span_hashes(classes, begin, begin + size), return_index=True, return_inverse=True)

        maps = np.zeros(0, dtype=np.int64)  # sorted keys content << 32 | state
        exits, counts = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        nodes = np.arange(len(owner), dtype=np.int64) << 32 | self.start  # chunk << 32 | state
        fresh = nodes

        def looked_up(keys: np.ndarray) -> np.ndarray:
            return np.searchsorted(maps, content[keys >> 32] << 32 | keys & 0xFFFFFFFF)

        for _ in range(ROUNDS):
            if not len(fresh):
                break
            wanted = np.setdiff1d(content[fresh >> 32] << 32 | fresh & 0xFFFFFFFF, maps)
            at = example[wanted >> 32]
            left, added = self.run(classes, begin[at], size[at], wanted & 0xFFFFFFFF)
            order = np.argsort(np.concatenate([maps, wanted]), kind="stable")
            maps = np.concatenate([maps, wanted])[order]
            exits, counts = np.concatenate([exits, left])[order], np.concatenate([counts, added])[order]
            # what leaves a chunk enters the next
            onward = fresh[more[fresh >> 32]]
            fresh = np.setdiff1d(((onward >> 32) + 1) << 32 | exits[looked_up(onward)], nodes)
            nodes = np.union1d(nodes, fresh)

        out = np.zeros(len(starts), dtype=np.int64)
        open_ones = np.unique(owner[fresh >> 32])
        known = {int(k): (int(e), int(n)) for k, e, n in zip(maps, exits, counts)} if len(open_ones) else {}
        for i in open_ones.tolist():
            state = self.start
            for chunk in range(int(first[i]), int(first[i] + chunks[i])):
                name = int(content[chunk]) << 32 | state
                if name not in known:
                    left, added = self.run(classes, begin[chunk:chunk + 1], size[chunk:chunk + 1], np.array([state]))
                    known[name] = (int(left[0]), int(added[0]))
                state, n = known[name]
                out[i] += n

        nodes = nodes[~np.isin(owner[nodes >> 32], open_ones)]
        found = looked_up(nodes)
        total = np.append(counts[found], 0)
        onward = more[nodes >> 32]
        following = np.full(len(nodes) + 1, len(nodes))  # the last one is behind the end
        following[:-1][onward] = np.searchsorted(nodes, ((nodes[onward] >> 32) + 1) << 32 | exits[found][onward])
        for _ in range(int(chunks.max()).bit_length()):
            total = total + total[following]
            following = following[following]
        closed = np.setdiff1d(np.arange(len(starts)), open_ones)
        out[closed] = total[np.searchsorted(nodes, first[closed] << 32 | self.start)]
        return out

    def count_block(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text. Equal stretches, told by 64-bit hashes, are run once."""
        marked = [f" {t}" if t else "" for t in texts]
        chars = np.frombuffer("\n".join(marked).encode("utf-32-le", "surrogatepass"), dtype="<u4")
        lengths = np.array([len(t) + 1 for t in marked])
        of_text = np.repeat(np.arange(len(texts)), lengths)[:len(chars)]
        classes = self.class_of[chars]
        known = classes > 0
        mark = classes == self.letters[MARK]
        begin = known.copy()
        begin[1:] &= ~known[:-1] | (mark[1:] & ~mark[:-1])
        stop = known.copy()
        stop[:-1] &= ~known[1:] | begin[1:]
        starts, ends = np.flatnonzero(begin), np.flatnonzero(stop) + 1
        _, first, same = np.unique(span_hashes(classes, starts, ends), return_index=True, return_inverse=True)
        counts = self.count_stretches(classes, starts[first], ends[first])[same]
        out = np.bincount(of_text[starts], weights=counts, minlength=len(texts))
        # unknown characters fall back to their bytes; the line breaks between texts don't count
        strange = np.flatnonzero(~known)
        n_bytes = 1 + (chars[strange] >= 0x80) + (chars[strange] >= 0x800) + (chars[strange] >= 0x10000)
        out += np.bincount(of_text[strange], weights=n_bytes, minlength=len(texts))
        out[:-1] -= 1
        return out.astype(np.int64)

    def count_many(self, texts: Iterable[str | None], block: int = 500_000) -> Iterator[int]:
        waiting, size = [], 0
        for t in texts:
            waiting.append(t or "")
            size += len(waiting[-1]) + 1
            if size >= block:
                yield from self.count_block(waiting).tolist()
                waiting, size = [], 0
        if waiting:
            yield from self.count_block(waiting).tolist()


def read_pieces(path: str) -> dict[str, float]:
    """Pieces that can come out of merges, with their scores: tens of thousands, whatever the data."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return {model.id_to_piece(i): model.get_score(i) for i in range(model.get_piece_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))}


def transducer(pieces: dict[str, float]) -> Transducer:
    return once(("transducer", len(pieces), hash(tuple(pieces.items()))), lambda: Transducer(pieces))


def count_tokens(docs: DataFrame, path: str, limit: int = LIMIT, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, n_bytes, n_tokens, over_limit) per row of `docs`, in one narrow pass.

    Tokens are those of the vocabulary file without begin, end or added special tokens. Null text counts as empty: no
    tokens. Repeated rows give repeated rows, a null key stays null, other columns are left out, an empty table gives
    no rows.
    """
    pieces = read_pieces(path)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        machine = transducer(pieces)
        for batch in batches:
            yield pd.DataFrame({"k": batch["k"], "n_bytes": batch["n_bytes"], "n_tokens": list(machine.count_many(batch["t"]))})

    kind = docs.schema[key].dataType.simpleString()
    source = docs.select(F.col(key).alias("k"), F.col(text).alias("t"), F.octet_length(F.coalesce(F.col(text), F.lit(""))).cast("bigint").alias("n_bytes"))
    out = source.mapInPandas(run, f"k {kind}, n_bytes bigint, n_tokens bigint")
    return out.withColumn("over_limit", F.col("n_tokens") > limit).withColumnRenamed("k", key)
