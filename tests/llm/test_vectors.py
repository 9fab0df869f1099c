"""Vector searches against brute force."""

import numpy as np
import pytest

from otelier.llm.bit_sliced import SlicedBlock, top_inner_products
from otelier.llm.graph_search import nearest

SCHEMA = "vec_id bigint, embedding array<float>, label int, score string, rank int"


def awkward(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=8).astype(float).tolist(), 1, "s", 2) for i in range(300)]
    hot = rows[7][1]
    rows += [(i, hot, 1, None, None) for i in range(300, 450)]  # a third of all rows
    rows += [(500, None, 1, None, None), (501, [None] * 8, 1, None, None), (502, [float("nan")] + [0.1] * 7, 1, None, None),
             (503, [float("inf")] + [0.1] * 7, 1, None, None), (None, hot, 1, None, None), (520, [0.0] * 8, 1, None, None),
             (540, [0.5, 0.25], 1, None, None), (541, [0.5, 0.5], 1, None, None), rows[0], rows[20]]
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


def usable(df, zero):
    out = {}
    for r in df.collect():
        v = r["embedding"]
        if r["vec_id"] is not None and v and all(x is not None and np.isfinite(x) for x in v) and (zero or any(v)):
            out[r["vec_id"]] = np.array(v, dtype=float)
    return out


def best(vectors, every, k):
    out = {}
    for q in (q for q in vectors if q % every == 0):
        found = [(-(vectors[q] @ v), i) for i, v in vectors.items() if i != q and len(v) == len(vectors[q])]
        out[q] = [(i, -s) for s, i in sorted(found)[:k]]
    return out


def grouped(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def test_bit_sliced_search_is_exact(spark, sf):
    for df in (awkward(spark), spark.read.parquet(f"{sf}/embeddings.parquet")):
        vectors = {i: np.floor(256 * v) for i, v in usable(df, True).items()}
        want = {q: [(i, int(s)) for i, s in found] for q, found in best(vectors, 50, 5).items() if found}
        assert grouped(top_inner_products(df, k=5, every=50)) == want
    assert top_inner_products(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("span", [1, 300, 1 << 26])
def test_bit_sliced_sums(span):
    rng = np.random.default_rng(span)
    values, ids = rng.integers(-span, span, size=(150, 5)), rng.permutation(150)
    block = SlicedBlock(ids, values)
    for row in range(0, 150, 10):
        got_ids, scores = block.top(int(ids[row]), values[row], 7)
        want = sorted((-int(v), int(i)) for v, i in zip(values @ values[row], ids) if i != ids[row])[:7]
        assert sorted(zip(-scores, got_ids)) == want


def test_two_vectors_under_one_id(spark):
    """Rows that share an id are queries and candidates of their own; exact repeats count once."""
    rows = [(50, [1.0, 0.0]), (50, [0.5, 0.5]), (50, [1.0, 0.0]), (7, [2.0, 1.0]), (9, [0.25, 0.0])]
    df = spark.createDataFrame([(i, v, 1, "s", 2) for i, v in rows], SCHEMA).repartition(3)
    for search, score in ((lambda: top_inner_products(df, k=5, every=50), 256 * 256), (lambda: nearest(df, k=5, every=50), 1)):
        found = sorted((r["rank"], r["vec_id"], r["score"] / score) for r in search().collect())
        assert found == sorted([(1, 7, 2.0), (2, 50, 0.5), (3, 9, 0.25), (1, 7, 1.5), (2, 50, 0.5), (3, 9, 0.125)])


def test_components_of_any_size(spark):
    rows = [(0, [2.0 ** 22, 1.0]), (1, [2.0 ** 22, -1.0]), (2, [1.0, 3.0]), (3, [-2.0 ** 22, 0.0]), (50, [2.0 ** -8, 2.0 ** -8])]
    vectors = {i: [int(np.floor(256 * x)) for x in v] for i, v in rows}
    df = spark.createDataFrame([(i, v, 1, "s", 2) for i, v in rows], "vec_id bigint, embedding array<double>, label int, score string, rank int")
    want = {q: sorted(((i, sum(a * b for a, b in zip(vectors[q], v))) for i, v in vectors.items() if i != q), key=lambda x: (-x[1], x[0])) for q in (0, 50)}
    assert grouped(top_inner_products(df, k=5, every=50)) == want
    huge = spark.createDataFrame([(0, [1e18]), (1, [1e18])], "vec_id bigint, embedding array<double>")
    with pytest.raises(Exception, match="does not fit 64 bits"):
        top_inner_products(huge).collect()
    small = spark.createDataFrame([(0, [1e-3]), (1, [1e17]), (2, [-1e17])], "vec_id bigint, embedding array<double>")
    assert grouped(top_inner_products(small)) == {0: [(1, 0), (2, 0)]}


def test_graph_search(spark, sf):
    df = awkward(spark)
    got, want = grouped(nearest(df)), best(usable(df, False), 20, 20)
    assert set(got) == {q for q, found in want.items() if found}
    for q, found in want.items():
        assert len(got.get(q, [])) == len(found)
        assert [s for _, s in got.get(q, [])] == sorted((s for _, s in got.get(q, [])), reverse=True)
    # ties go to the smaller id: of 151 equal vectors the smallest ids
    assert [i for i, _ in got[300]] == [i for i, _ in want[300]]
    assert len({i for i, _ in got[300]} & {7, *range(301, 320)}) >= 15
    assert nearest(spark.createDataFrame([], SCHEMA)).count() == 0


def test_graph_search_recall(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    got, want = grouped(nearest(df)), best(usable(df, False), 20, 20)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in found}) for q, found in want.items())
    assert hits >= 0.9 * sum(map(len, want.values()))
    for q, found in got.items():
        exact = dict(best({**{q: usable(df, False)[q]}, **{i: usable(df, False)[i] for i, _ in found[:2]}}, 1, 9)[q])
        assert all(s == pytest.approx(exact[i], abs=1e-12) for i, s in found[:2])
        break
