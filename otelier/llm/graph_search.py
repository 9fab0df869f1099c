"""Approximate nearest neighbours by a robust-pruned directed graph per shard (Jayaram Subramanya et al., 2019).

Largest inner product becomes least distance by one more component per vector. A shard's points enter its graph in
growing batches: a greedy search through the graph so far proposes neighbours, robust pruning keeps a neighbour only if
no kept one is closer to it by the factor `ALPHA`, edges are made both ways and pruned again. Every query runs a beam
search through every shard's graph; the scores of what it finds are computed on the original vectors.

Equal vectors are one point of a graph, however many rows hold them. Index and query packs are rows of bounded size.
"""

from __future__ import annotations

import pickle

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from otelier.llm.staging import staged
from otelier.llm.vectors import best_per_query, usable_vectors

#: Rows of a shard and queries of a pack.
SHARD, PACK = 8192, 8192
#: Edges per point, width of the beam while building and searching, pruning factor.
DEGREE, BUILD_BEAM, SEARCH_BEAM, ALPHA = 32, 48, 96, 1.2
_LANES = 512


class Graph:
    """Points (rows of `x`), their edges (rows of point numbers, -1 for none) and where searches start."""

    def __init__(self, x: np.ndarray):
        self.x = x.astype(np.float32)
        self.square = np.einsum("nd,nd->n", self.x, self.x)
        self.edges = np.full((len(x), DEGREE), -1, dtype=np.int32)
        self.entry = int(np.argmin(((self.x - self.x.mean(0)) ** 2).sum(1)))

    def beam_search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """(points, squared distances), nearest first, of the best `beam` points each search has met; -1 fills up."""
        n, lane = len(queries), np.arange(len(queries))
        q2 = np.einsum("nd,nd->n", queries, queries)
        points = np.full((n, beam), -1, dtype=np.int32)
        dist = np.full((n, beam), np.inf, dtype=np.float32)
        done = np.ones((n, beam), dtype=bool)
        points[:, 0], done[:, 0] = self.entry, False
        dist[:, 0] = q2 + self.square[self.entry] - 2 * queries @ self.x[self.entry]
        met = np.zeros((n, len(self.x)), dtype=bool)
        met[:, self.entry] = True
        while True:
            waiting = np.where(done, np.inf, dist)
            best = waiting.argmin(1)
            live = np.flatnonzero(np.isfinite(waiting[lane, best]))
            if not len(live):
                return points, dist
            done[live, best[live]] = True
            near = self.edges[points[live, best[live]]]
            fresh = (near >= 0) & ~met[live[:, None], near]
            row, column = np.nonzero(fresh)
            if not len(row):
                continue
            target = near[row, column]
            met[live[row], target] = True
            d = np.full(near.shape, np.inf, dtype=np.float32)
            d[row, column] = q2[live[row]] + self.square[target] - 2 * np.einsum("nd,nd->n", queries[live[row]], self.x[target])
            all_d = np.concatenate([dist[live], d], 1)
            order = np.argpartition(all_d, beam - 1, 1)[:, :beam]
            take = lambda a, b: np.take_along_axis(np.concatenate([a[live], b], 1), order, 1)
            points[live], done[live] = take(points, np.where(fresh, near, -1)), take(done, ~fresh)
            dist[live] = np.take_along_axis(all_d, order, 1)

    def prune(self, of: np.ndarray, candidates: np.ndarray) -> np.ndarray:
        """Edges for points `of` from candidates (-1 for none): nearest first, skipping those a kept one shadows."""
        valid = (candidates >= 0) & (candidates != of[:, None])
        order = np.argsort(np.where(valid, candidates, np.iinfo(np.int32).max), 1, kind="stable")
        candidates, valid = np.take_along_axis(candidates, order, 1), np.take_along_axis(valid, order, 1)
        valid[:, 1:] &= candidates[:, 1:] != candidates[:, :-1]
        c = np.where(valid, candidates, of[:, None])
        vectors, squares = self.x[c], self.square[c]
        own = squares + self.square[of][:, None] - 2 * np.einsum("nd,ncd->nc", self.x[of], vectors)
        between = squares[:, :, None] + squares[:, None, :] - 2 * vectors @ vectors.transpose(0, 2, 1)
        left = np.where(valid, own, np.inf)
        out, lane = np.full((len(of), DEGREE), -1, dtype=np.int32), np.arange(len(of))
        for i in range(DEGREE):
            best = left.argmin(1)
            found = np.isfinite(left[lane, best])
            if not found.any():
                break
            out[found, i] = c[found, best[found]]
            shadowed = ALPHA ** 2 * between[lane, best] <= own
            left[shadowed & found[:, None]] = np.inf
            left[lane, best] = np.inf
        return out

    def insert(self, new: np.ndarray) -> None:
        for low in range(0, len(new), _LANES):
            part = new[low:low + _LANES]
            met, _ = self.beam_search(self.x[part], BUILD_BEAM)
            self.edges[part] = self.prune(part, np.concatenate([met, self.edges[part]], 1))
            source = np.repeat(part, DEGREE)
            target = self.edges[part].ravel()
            source, target = source[target >= 0], target[target >= 0]
            self._link_back(target, source)

    def _link_back(self, of: np.ndarray, to: np.ndarray) -> None:
        order = np.argsort(of, kind="stable")
        of, to = of[order], to[order]
        number = np.arange(len(of)) - np.searchsorted(of, of)
        for low in range(0, int(number.max(initial=-1)) + 1, DEGREE):
            now = (number >= low) & (number < low + DEGREE)
            points, row = np.unique(of[now], return_inverse=True)
            for at in range(0, len(points), _LANES):
                mine = (row >= at) & (row < at + _LANES)
                extra = np.full((min(_LANES, len(points) - at), DEGREE), -1, dtype=np.int32)
                extra[row[mine] - at, number[now][mine] - low] = to[now][mine]
                part = points[at:at + _LANES]
                both = np.concatenate([self.edges[part], extra], 1)
                ordered = np.take_along_axis(both, np.argsort(both < 0, 1, kind="stable"), 1)
                full = ordered[:, DEGREE] >= 0
                self.edges[part[~full]] = ordered[~full, :DEGREE]
                if full.any():
                    self.edges[part[full]] = self.prune(part[full], both[full])

    @classmethod
    def build(cls, x: np.ndarray, seed: int = 1) -> Graph:
        graph = cls(x)
        order = np.random.default_rng(seed).permutation(len(x)).astype(np.int32)
        order = np.concatenate([[graph.entry], order[order != graph.entry]]).astype(np.int32)
        at, size = 1, 1
        while at < len(order):
            graph.insert(order[at:at + size])
            at += size
            size = min(2 * size, max(64, len(order) // 20))
        return graph


class Shard:
    """The index of one shard: distinct vectors, the ids that hold each, and their graph."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, names: np.ndarray):
        order = np.lexsort((names, ids))
        ids, vectors, names = ids[order], vectors[order], names[order]
        self.vectors, group = np.unique(vectors, axis=0, return_inverse=True)
        by_group = np.argsort(group, kind="stable")
        self.ids, self.names, self.begins = ids[by_group], names[by_group], np.searchsorted(group[by_group], np.arange(len(self.vectors) + 1))
        scale = np.abs(self.vectors).max()
        norms = ((self.vectors / scale) ** 2).sum(1)
        self.scale = scale
        self.graph = Graph.build(np.column_stack([self.vectors / scale, np.sqrt(np.maximum(norms.max() - norms, 0))]))

    def search(self, ids: np.ndarray, names: np.ndarray, queries: np.ndarray, k: int, beam: int) -> pd.DataFrame:
        lifted = np.column_stack([queries / np.abs(queries).max(1, keepdims=True), np.zeros(len(queries))]).astype(np.float32)
        found = []
        for low in range(0, len(ids), _LANES):
            points, _ = self.graph.beam_search(lifted[low:low + _LANES], beam)
            row, column = np.nonzero(points >= 0)
            point = points[row, column]
            row = row + low
            score = np.einsum("nd,nd->n", queries[row], self.vectors[point])
            # of equal vectors the k + 1 smallest ids can matter, as one may be the query's own
            n = np.minimum(np.diff(self.begins)[point], k + 1)
            each = np.repeat(np.arange(len(point)), n)
            at = self.begins[point][each] + np.arange(len(each)) - np.repeat(np.cumsum(n) - n, n)
            rows = pd.DataFrame({"query_id": ids[row[each]], "query_row": names[row[each]], "vec_id": self.ids[at], "score": score[each]})
            rows = rows[rows["query_row"] != self.names[at]].sort_values(
                ["query_row", "score", "vec_id"], ascending=[True, False, True])
            found.append(rows.groupby("query_row").head(k))
        return pd.concat(found)


def build_shards(rows: DataFrame, shards: int) -> DataFrame:
    """One row per shard (and vector length): (dim, shard, index)."""

    def build(group: pd.DataFrame) -> pd.DataFrame:
        made = Shard(group["id"].to_numpy(), np.stack(group["v"].to_numpy()), group["row"].to_numpy())
        return pd.DataFrame({"dim": group["dim"].iloc[:1], "shard": group["shard"].iloc[:1], "index": [pickle.dumps(made, protocol=5)]})

    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int"))
    return dealt.groupBy("dim", "shard").applyInPandas(build, "dim int, shard int, index binary")


def nearest(vectors: DataFrame, k: int = 20, every: int = 20, beam: int = SEARCH_BEAM, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose key is divisible by `every` up to k rows of large inner product,
    found in every shard, best first. The query's own row is no candidate.

    Scores are inner products of the original vectors in double precision; ties go to the smaller key. Vectors that are
    null or zero or hold a null or non-finite component take no part, nor do rows with a null key. Exact repeats count
    once; rows that share a key but not the vector are queries and candidates of their own. Vectors are compared with
    those of as many components. Other columns are left out; an empty table gives no rows. A query gets k rows where
    there are as many; which ones is approximate.

    A graph goes to its searches once for every `PACK` queries.
    """
    rows = staged(usable_vectors(vectors, key, vector, nonzero=True), "vectors")
    asked = F.col("id") % every == 0
    counts = rows.agg(F.count("*").alias("n"), F.count_if(asked).alias("q")).first()
    shards, packs = max(1, -(-counts.n // SHARD)), max(1, -(-counts.q // PACK))
    index = staged(build_shards(rows, shards), "graphs")
    queries = rows.where(asked).withColumn("pack", F.pmod(F.xxhash64("id"), F.lit(packs)).cast("int"))
    queries = queries.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    index = index.withColumn("pack", F.explode(F.sequence(F.lit(0), F.lit(packs - 1))))
    beam = max(beam, k + 1)

    def search(shard: pd.DataFrame, asks: pd.DataFrame) -> pd.DataFrame:
        if not len(shard) or not len(asks):
            return pd.DataFrame({"query_id": [], "query_row": [], "vec_id": [], "score": []}, dtype="int64")
        asks = asks.sort_values(["id", "row"])
        return pickle.loads(shard["index"].iloc[0]).search(asks["id"].to_numpy(), asks["row"].to_numpy(), np.stack(asks["v"].to_numpy()), k, beam)

    cells = ["dim", "shard", "pack"]
    found = index.groupBy(*cells).cogroup(queries.groupBy(*cells)).applyInPandas(search, "query_id bigint, query_row bigint, vec_id bigint, score double")
    return best_per_query(found, k)
