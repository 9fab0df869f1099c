"""Sum-of-squares online packing of token sequences.

Every task packs the documents it reads, in order, with bounded state; nothing is shuffled. Long documents fill whole
windows first. What is left of a document goes, uncut, to the fill level that minimises the sum over all levels of the
squared number of partly filled windows at that level, which keeps the levels balanced so that later pieces find a
partner that fills a window. The counts are an array over levels. At the end of a task the open windows, a few hundred
however many were filled, are settled: their pieces are laid end to end and cut at window borders, and the very last
rest is cut into sequences whose lengths are powers of two, which need no padding. Should the memory for open windows
ever run out before, the fullest few are settled.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from otelier.llm.bpe import encoder, read_vocabulary

WINDOW = 4096


def place(counts: np.ndarray, size: int) -> int:
    """The level (0: a new window) whose use by a piece of `size` gives the least sum of squared counts.

    `counts[h]` is the number of open windows filled up to h, 0 < h < len(counts) - 1; the last entry stays 0, since
    full windows do not count. Ties go to the fullest level.
    """
    full = len(counts) - 1
    best, gain = 0, 2 * int(counts[size]) + 1 if size < full else 0
    levels = np.flatnonzero(counts[: full - size + 1])
    if len(levels):
        after = levels + size
        change = 2 * (counts[after] - counts[levels]) + np.where(after == full, 1, 2)
        i = len(levels) - 1 - int(np.argmin(change[::-1]))
        if change[i] <= gain:
            best = int(levels[i])
    return best


class Packer:
    """State of one task. Pieces are (row, start, ids, doc_tokens); `out` gets them once their window is closed."""

    def __init__(self, window: int, max_open: int, first_id: int):
        self.window, self.max_open, self.next_id = window, max_open, first_id
        self.counts = np.zeros(window + 1, dtype=np.int64)
        self.open: dict[int, list[list]] = {}
        self.n_open = 0
        #: Windows closed by cutting open ones.
        self.settled = 0
        self.out: list[tuple] = []

    def add(self, key, ids: bytes) -> None:
        n, step = len(ids) // 4, self.window
        whole = n - n % step
        for start in range(0, whole, step):
            self._close([(key, start, ids[4 * start:4 * (start + step)], n)])
        if whole < n:
            self._fit((key, whole, ids[4 * whole:], n), n - whole)

    def _fit(self, piece: tuple, size: int) -> None:
        level = place(self.counts, size)
        if level:
            pieces = self.open[level].pop()
            self.counts[level] -= 1
            self.n_open -= 1
        else:
            pieces = []
        pieces.append(piece)
        if level + size == self.window:
            self._close(pieces)
            return
        self.open.setdefault(level + size, []).append(pieces)
        self.counts[level + size] += 1
        self.n_open += 1
        if self.n_open > self.max_open:
            self._settle(False)

    def _close(self, pieces: list[tuple]) -> None:
        offset = 0
        for key, start, ids, n in pieces:
            self.out.append((key, start, len(ids) // 4, crc32(ids), n, self.next_id, offset))
            offset += len(ids) // 4
        self.next_id += 1

    def _settle(self, last: bool) -> None:
        """Lay open windows end to end and cut: all of them at the end; before that the fullest sixteenth, whose rest stays
        open as one window."""
        pieces, room, level = [], self.window, 0
        queue, windows = [], self.n_open if last else max(2, self.n_open // 16)
        for h in sorted(self.open, reverse=True):
            while windows and self.open[h]:
                queue += self.open[h].pop()
                self.counts[h] -= 1
                self.n_open -= 1
                windows -= 1
        rest = sum(len(p[2]) for p in queue) // 4
        self.settled += -(-rest // self.window)
        if last:
            room = min(self.window, 1 << (rest.bit_length() - 1)) if rest else 0
        for key, start, ids, n in queue:
            while ids:
                take = min(room - level, len(ids) // 4)
                pieces.append((key, start, ids[:4 * take], n))
                start, ids, level, rest = start + take, ids[4 * take:], level + take, rest - take
                if level == room:
                    self._close(pieces)
                    pieces, level = [], 0
                    if last and rest:
                        room = min(self.window, 1 << (rest.bit_length() - 1))
        if pieces:
            self.open.setdefault(level, []).append(pieces)
            self.counts[level] += 1
            self.n_open += 1

    def drain(self, last: bool = False) -> list[tuple]:
        if last:
            self._settle(True)
        rows, self.out = self.out, []
        return rows


def pack_documents(docs: DataFrame, path: str, end_id: int = 2, window: int = WINDOW, max_open: int = 4096,
                   text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per piece: key, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document is its token ids, then `end_id`; null text counts as empty, so it is one id. Repeated rows are packed as
    often as they come; a null key stays null; other columns are left out; an empty table gives no rows. A task keeps
    at most `max_open` open windows of ids (64 MB by default) and one document whole. Task number and a running number make up `sequence_id`, so a repeated task
    gives the same ids.
    """
    vocabulary, end = read_vocabulary(path), int(end_id).to_bytes(4, "little")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["k", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        bpe = encoder(vocabulary)
        packer = Packer(window, max_open, TaskContext.get().partitionId() << 32)
        for batch in batches:
            for k, ids in zip(batch["k"].astype(object), bpe.encode_many(batch["t"])):
                packer.add(None if pd.isna(k) else k, ids.astype("<u4").tobytes() + end)
            yield pd.DataFrame(packer.drain(), columns=names)
        yield pd.DataFrame(packer.drain(last=True), columns=names)

    kind = docs.schema[key].dataType.simpleString()
    out = docs.select(F.col(key).alias("k"), F.col(text).alias("t")).mapInPandas(
        run, f"k {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint")
    return out.withColumnRenamed("k", key)
