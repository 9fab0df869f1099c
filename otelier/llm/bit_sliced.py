"""Exact search for the largest integer inner products with a bit-sliced index.

Vectors are quantised to integers. A block of rows is indexed by bitmaps: one per component and binary digit, with one
bit per row. A query adds the slices of all components, shifted by the digits of its own components, with bitmap full
adders, so that the scores of all rows of a block arise side by side as bitmaps. The best rows are selected from the
most significant score slice downward; rows that tie at the border are told apart exactly, by id.

Each block is indexed once and all queries stream past it; the best of each block are merged per query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from otelier.llm.staging import staged
from otelier.llm.vectors import best_per_query, usable_vectors

#: Rows of a block.
ROWS = 16_384


class SlicedBlock:
    """Bitmaps over the rows (in order of id) of one block. Components are stored from their least value up."""

    def __init__(self, ids: np.ndarray, values: np.ndarray, names: np.ndarray | None = None):
        """`names` tell rows apart, where ids do not."""
        names = ids if names is None else names
        order = np.lexsort((names, ids))
        self.ids, values, self.names = ids[order], values[order], names[order]
        self.place = {int(n): i for i, n in enumerate(self.names)}
        self.rows = len(ids)
        self.most = int(abs(values).max(initial=0))
        self.values = values
        if values.dtype == object:
            return
        self.words = -(-self.rows // 64)
        self.low = values.min(0)
        above = (values - self.low).T
        self.digits = [int(x).bit_length() for x in above.max(1)]
        self.all = self._bitmap(np.ones(self.rows, dtype=np.int64))
        plain = [self._bitmap(x >> j & 1) for x, n in zip(above, self.digits) for j in range(n)]
        #: The slices of all components, then the same inverted.
        self.slices = np.stack(plain + [~s & self.all for s in plain]) if plain else np.zeros((0, self.words), np.uint64)
        self.first = (np.cumsum(self.digits) - self.digits).astype(int).tolist()

    def _bitmap(self, bits: np.ndarray) -> np.ndarray:
        packed = np.zeros(self.words * 8, dtype=np.uint8)
        b = np.packbits(bits.astype(np.uint8), bitorder="little")
        packed[:len(b)] = b
        return packed.view(np.uint64)

    def add_up(self, query: np.ndarray) -> tuple[np.ndarray, int]:
        """(score slices from the least significant one, offset): score = offset + number in the slices.

        A component's factor is written with digits 1, 0 and -1. A digit -1 adds the inverted slices, which is the
        largest value less the component, and lowers the offset.
        """
        columns: list[list[int]] = []
        offset, inverted = int(query @ self.low), len(self.slices) // 2
        for factor, n, first in zip(query.tolist(), self.digits, self.first):
            shift = 0
            while factor and n:
                if factor & 1:
                    digit = 2 - (factor & 3)
                    if digit < 0:
                        offset -= ((1 << n) - 1) << shift
                    while len(columns) < shift + n:
                        columns.append([])
                    at = first if digit > 0 else first + inverted
                    for j in range(n):
                        columns[shift + j].append(at + j)
                    factor -= digit
                factor >>= 1
                shift += 1
        return self._carry([self.slices[np.array(c, dtype=int)] for c in columns]), offset

    def _carry(self, stacks: list[np.ndarray]) -> np.ndarray:
        """Reduce the bitmaps of each weight to one; sums of three leave one bitmap and carry one."""
        out, w = [], 0
        while w < len(stacks):
            s = stacks[w]
            carried = [stacks[w + 1]] if w + 1 < len(stacks) else []
            while len(s) > 1:
                n = len(s) // 3
                if n:
                    a, b, c = s[:n], s[n:2 * n], s[2 * n:3 * n]
                    half = a ^ b
                    carried.append(a & b | half & c)
                    s = np.concatenate([half ^ c, s[3 * n:]])
                else:
                    carried.append(s[:1] & s[1:2])
                    s = s[:1] ^ s[1:2]
            out.append(s[0] if len(s) else np.zeros(self.words, np.uint64))
            rest = np.concatenate(carried) if carried else np.zeros((0, self.words), np.uint64)
            if w + 1 < len(stacks):
                stacks[w + 1] = rest
            elif len(rest):
                stacks.append(rest)
            w += 1
        return np.stack(out) if out else np.zeros((0, self.words), np.uint64)

    def _rows_of(self, bitmap: np.ndarray) -> np.ndarray:
        return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little", count=self.rows))

    def top(self, query_name: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the k best rows but the query's own, in no order."""
        if self.values.dtype == object or self.most * int(abs(query).max(initial=0)) * len(query) >= 1 << 62:
            return self._top_large(query_name, query, k)
        slices, offset = self.add_up(query)
        equal = self.all.copy()
        own = self.place.get(query_name)
        if own is not None:
            equal[own // 64] &= ~np.uint64(1 << int(own % 64))
        sure = np.zeros_like(equal)
        for s in slices[::-1]:
            high = equal & s
            n = int(np.bitwise_count(sure).sum()) + int(np.bitwise_count(high).sum())
            if n >= k:
                equal = high
                if n == k:
                    break
            else:
                sure |= high
                equal &= ~s
        first = self._rows_of(sure)
        border = self._rows_of(equal)[:k - len(first)]  # equal scores: the smaller ids
        rows = np.concatenate([first, border])
        bits = (slices[:, rows // 64] >> (rows % 64).astype(np.uint64)) & np.uint64(1)
        weights = np.int64(1) << np.arange(len(slices), dtype=np.int64)
        return self.ids[rows], offset + weights @ bits.astype(np.int64)

    def _top_large(self, query_name: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The same in whole numbers of any size, where the slices of a score would not fit 63 bits."""
        scores = self.values.astype(object) @ query.astype(object)
        rows = sorted((i for i in range(self.rows) if i != self.place.get(query_name)), key=lambda i: -scores[i])[:k]
        best = [scores[i] for i in rows]
        if any(abs(x) >= 1 << 63 for x in best):
            raise OverflowError(f"a score does not fit 64 bits: {max(best, key=abs)}")
        return self.ids[rows], np.array(best, dtype=np.int64)


def quantised(vectors: np.ndarray, scale: float) -> np.ndarray:
    """floor(scale * component), as numbers of any size where 64 bits could not hold them."""
    q = np.floor(vectors * scale)
    if abs(q).max(initial=0) < 1 << 53:
        return q.astype(np.int64)
    return np.array([[int(x) for x in row] for row in q], dtype=object)


def top_inner_products(vectors: DataFrame, k: int = 5, every: int = 50, scale: float = 256.0,
                       key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose key is divisible by `every` the k rows with the largest inner
    product of floor(scale * component), exactly; all rows if there are fewer. The query's own row is no candidate.

    Ties go to the smaller key. Vectors that are null or hold a null or non-finite component take no part; rows with a
    null key neither. Exact repeats count once; rows that share a key but not the vector are queries and candidates of
    their own. Vectors are compared with those of as many components. Components may be of any finite size; a result whose
    score does not fit 64 bits fails. Other columns are left out; an empty table gives no rows.

    Each block of rows goes to one task, is indexed there once, and all queries stream past it.
    """
    rows = staged(usable_vectors(vectors, key, vector), "usable")
    asked = F.col("id") % every == 0
    blocks = max(1, -(-rows.count() // ROWS))
    all_blocks = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    candidates = rows.select("dim", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int").alias("block"), F.lit(0).alias("asks"), "id", "row", "v")
    queries = rows.where(asked).select("dim", all_blocks.alias("block"), F.lit(1).alias("asks"), "id", "row", "v")
    cells = ["dim", "block"]
    stream = candidates.unionByName(queries).repartition(*cells).sortWithinPartitions(*cells, "asks")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cell, held, block = None, [], None
        for batch in batches:
            found = [pd.DataFrame({"query_id": [], "query_row": [], "vec_id": [], "score": []}, dtype="int64")]
            for (dim, number, asks), part in batch.groupby(["dim", "block", "asks"], sort=True):
                if cell != (dim, number):
                    cell, held, block = (dim, number), [], None
                if not asks:
                    held.append(part)
                    continue
                if not held:
                    continue
                if block is None:
                    whole = pd.concat(held)
                    block = SlicedBlock(whole["id"].to_numpy(), quantised(np.stack(whole["v"].to_numpy()), scale), whole["row"].to_numpy())
                for q, name, v in zip(part["id"].tolist(), part["row"].tolist(), quantised(np.stack(part["v"].to_numpy()), scale)):
                    ids, scores = block.top(name, v, k)
                    found.append(pd.DataFrame({"query_id": q, "query_row": name, "vec_id": ids, "score": scores}))
            yield pd.concat(found)

    found = stream.mapInPandas(run, "query_id bigint, query_row bigint, vec_id bigint, score bigint")
    return best_per_query(found, k)


ORACLE = """
WITH v AS (
  SELECT vec_id, [floor(256 * x::DOUBLE) FOR x IN embedding] AS q FROM embeddings),
scored AS (
  SELECT a.vec_id AS query_id, b.vec_id, list_dot_product(a.q, b.q)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, rank::INT AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""
