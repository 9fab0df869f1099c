"""Exact n-gram Jaccard join by vertical partitioning.

The hashes of all shingles are one global order. It is cut into fragments of equal width; each fragment holds its part
of every document's set, and what fragments find out is added up per document or per pair:

1. Blocks of documents send the distinct hashes of each fragment to it, whatever number of documents of the block hold
   them. A fragment counts documents per hash and answers with the hashes found more than once. A document keeps those,
   rarest first; if they are fewer than the overlap that a link needs, it can have none.
2. Linked documents share one of the rarest hashes (the prefix that the needed overlap leaves). Documents under such a
   hash are compared with one of them, not with each other: a hot group gives a star.
3. Partial overlaps of the pairs are counted in each fragment and summed per pair.
4. Sets around one centre which the stars left in different components are compared with each other, in cells of
   bounded size, again fragment by fragment; a cell tells only the links that connect. So no link that joins
   components is missed, and links within a component need not be listed.

Equal sets are one node throughout.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from otelier.llm.components import components
from otelier.llm.shingles import set_signature, shingle_sets
from otelier.llm.staging import staged

#: Fragments at least, and characters of text per fragment where there are more.
FRAGMENTS, FRAGMENT_CHARS = 64, 1 << 23
#: Bits of a hash that are kept: 6 for the least number of fragments, and 48.
KEPT = np.uint64(~((1 << 10) - 1) & (1 << 64) - 1)
#: Characters and documents of a block.
BLOCK_CHARS, BLOCK_DOCS = 4_000_000, 60_000
#: Fragments in which pairs are counted; columns of a fragment where all pairs of a cell are.
SEGMENTS, COLUMNS = 8, 4096

_FRAGMENT = "fragment int, block bigint, one binary, one_doc binary, many binary, many_count binary"
_INFO = "ids binary, sizes binary, signatures binary, owners binary, many_docs binary"


def _blocks(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[list, list]]:
    ids, texts, size = [], [], 0
    for batch in batches:
        for i, t in zip(batch["k"].tolist(), batch["t"]):
            ids.append(i)
            texts.append(t)
            size += len(t)
            if size >= BLOCK_CHARS or len(ids) >= BLOCK_DOCS:
                yield ids, texts
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def _bounds(fragments: int) -> np.ndarray:
    """First hash of each fragment but the first; `fragments` is a power of two."""
    return np.arange(1, fragments, dtype=np.uint64) << np.uint64(65 - fragments.bit_length())


def _narrow(hashes: np.ndarray, fragments: int) -> bytes:
    """Hashes of one fragment in 6 bytes each: its own bits are those that `KEPT` leaves behind the fragment's."""
    inside = (hashes << np.uint64(fragments.bit_length() - 1)) >> np.uint64(16)
    return np.ascontiguousarray(inside.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def _wide(data: bytes, fragment: int, fragments: int) -> np.ndarray:
    """The hashes that `_narrow` packed."""
    padded = np.zeros((len(data) // 6, 8), dtype=np.uint8)
    padded[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    bits = np.uint64(fragments.bit_length() - 1)
    return (padded.view("<u8").ravel() << np.uint64(16)) >> bits | np.uint64(fragment) << np.uint64(64) - bits


def _block_rows(block: int, ids: list, texts: list, size: int, fragments: int) -> pd.DataFrame:
    sets = shingle_sets(texts, size)
    signatures = [set_signature(s) for s in sets]
    first: dict[bytes, int] = {}
    owner = np.array([first.setdefault(s, i) == i for i, s in enumerate(signatures)])
    own = np.flatnonzero(owner)
    kept = [np.unique(sets[i] & KEPT) for i in own]
    hashes = np.concatenate(kept)
    docs = np.repeat(own, [len(x) for x in kept]).astype("<u2")
    order = np.argsort(hashes, kind="stable")
    hashes, docs = hashes[order], docs[order]
    starts = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]])) if len(hashes) else np.zeros(0, np.int64)
    counts = np.diff(np.append(starts, len(hashes)))
    single = counts == 1
    one, one_doc = hashes[starts[single]], docs[starts[single]]
    many, many_count = hashes[starts[~single]], counts[~single].astype("<u4")
    cuts = _bounds(fragments)
    a, b = np.searchsorted(one, cuts), np.searchsorted(many, cuts)
    parts = zip(np.split(one, a), np.split(one_doc, a), np.split(many, b), np.split(many_count, b))
    rows = [(f, block, _narrow(x, fragments), d.tobytes(), _narrow(m, fragments), c.tobytes(), None, None, None, None, None)
            for f, (x, d, m, c) in enumerate(parts) if len(x) or len(m)]
    # what only the block itself needs again: under a fragment number of its own, which passes through
    rows.append((
        -1 - block % fragments, block, None, None, many.tobytes(), many_count.tobytes(), np.array(ids, dtype="<i8").tobytes(),
        np.array([len(s) for s in sets], dtype="<u4").tobytes(), b"".join(signatures), owner.tobytes(),
        docs[np.repeat(~single, counts)].tobytes()))
    return pd.DataFrame(rows, columns=[c.split()[0] for c in f"{_FRAGMENT}, {_INFO}".split(", ")])


def _count_fragment(group: pd.DataFrame, fragments: int) -> pd.DataFrame:
    """Documents per hash of one fragment; each block gets back its hashes that more than one document holds."""
    if group["ids"].notna().any():
        return group
    fragment = int(group["fragment"].iloc[0])
    ones = [_wide(x, fragment, fragments) for x in group["one"]]
    many = [_wide(x, fragment, fragments) for x in group["many"]]
    counts = [np.frombuffer(x, "<u4") for x in group["many_count"]]
    lengths = [len(x) for x in ones]
    hashes = np.concatenate(ones + many)
    weights = np.concatenate([np.ones(sum(lengths), np.int64), *counts])
    order = np.argsort(hashes)
    ranked = hashes[order]
    starts = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
    found = np.add.reduceat(weights[order], starts)
    # only the order of frequencies matters, and that they are the same in all documents
    frequency = np.empty(len(hashes), dtype="<u2")
    frequency[order] = np.repeat(np.minimum(found, 0xFFFF), np.diff(np.append(starts, len(hashes))))
    ones_f = np.split(frequency[:sum(lengths)], np.cumsum(lengths)[:-1])
    many_f = np.split(frequency[sum(lengths):], np.cumsum([len(x) for x in many])[:-1])
    rows = []
    for block, x, d, f, m, g in zip(group["block"], ones, group["one_doc"], ones_f, many, many_f):
        keep = f > 1
        if keep.any() or len(m):
            # `many_count` carries the frequencies from here on: of the single hashes, then of the others
            rows.append((fragment, block, _narrow(x[keep], fragments), np.frombuffer(d, "<u2")[keep].tobytes(),
                         _narrow(m, fragments), np.concatenate([f[keep], g]).astype("<u2").tobytes(), None, None, None, None, None))
    return pd.DataFrame(rows, columns=group.columns)


def _assemble(group: pd.DataFrame, percent: int, fragments: int) -> pd.DataFrame:
    """The answers of all fragments to one block, as one row per document."""
    info = group[group["ids"].notna()].iloc[0]
    ids, sizes = np.frombuffer(info["ids"], "<i8"), np.frombuffer(info["sizes"], "<u4").astype(np.int64)
    many, counts = np.frombuffer(info["many"], "<u8"), np.frombuffer(info["many_count"], "<u4").astype(np.int64)
    many_docs = np.frombuffer(info["many_docs"], "<u2")
    answers = group[group["ids"].isna()]
    hashes, docs, frequency = [many.repeat(counts)], [many_docs], [np.zeros(len(many_docs), np.int64)]
    of_many = np.zeros(len(many), np.int64)
    for i, x, d, m, f in zip(*[answers[c] for c in ("fragment", "one", "one_doc", "many", "many_count")]):
        x, m, f = _wide(x, i, fragments), _wide(m, i, fragments), np.frombuffer(f, "<u2")
        hashes.append(x)
        docs.append(np.frombuffer(d, "<u2"))
        frequency.append(f[:len(x)].astype(np.int64))
        of_many[np.searchsorted(many, m)] = f[len(x):]
    frequency[0] = of_many.repeat(counts)
    hashes, docs, frequency = np.concatenate(hashes), np.concatenate(docs), np.concatenate(frequency)
    shared = np.bincount(docs, minlength=len(ids))
    needed = -(-percent * sizes // 100)
    able = (shared >= needed) & (sizes > 0) & np.frombuffer(info["owners"], bool)
    keep = able[docs]
    hashes, docs, frequency = hashes[keep], docs[keep], frequency[keep]
    order = np.lexsort((hashes, frequency, docs))
    lists = np.split(hashes[order].view(np.int64), np.cumsum(np.where(able, shared, 0))[:-1])
    signatures = info["signatures"]
    # how much of a set is common: high for the text that near copies were made from
    weight = np.bincount(docs, weights=np.log2(frequency), minlength=len(ids)) / np.maximum(sizes, 1)
    return pd.DataFrame({
        "k": ids, "node": [signatures[16 * i:16 * i + 16] for i in range(len(ids))], "n": sizes, "common": weight,
        "hashes": [x if ok else None for x, ok in zip(lists, able)]})


def shingle_profiles(docs: DataFrame, size: int, percent: int, text: str, key: str) -> DataFrame:
    """(k, node, n, common, hashes): set size per document; hashes that others hold too, rarest first, where a link is possible.
    `node` tells sets apart; of equal sets in a block one row has the hashes."""
    source = docs.select(F.col(key).cast("bigint").alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t")).where("k IS NOT NULL")
    chars = source.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    fragments = max(FRAGMENTS, 1 << max(0, (chars // FRAGMENT_CHARS)).bit_length())

    def dealt(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task = TaskContext.get().partitionId() << 32
        for i, (ids, texts) in enumerate(_blocks(batches)):
            yield _block_rows(task + i, ids, texts, size, fragments)

    columns = f"{_FRAGMENT}, {_INFO}"
    answered = source.mapInPandas(dealt, columns).groupBy("fragment").applyInPandas(
        lambda group: _count_fragment(group, fragments), columns)
    return answered.groupBy("block").applyInPandas(
        lambda group: _assemble(group, percent, fragments), "k bigint, node binary, n bigint, common double, hashes array<bigint>")


def _long_enough(a: Column, b: Column, percent: int) -> Column:
    """Set sizes that allow a link."""
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def count_overlaps(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, na, b, nb) with `overlap`: each fragment counts its part, parts are summed per pair."""
    width = 64 - (SEGMENTS.bit_length() - 1)
    parts = sets.select("node", F.explode(F.transform(
        F.sequence(F.lit(0), F.lit(SEGMENTS - 1)), lambda f: F.struct(f.alias("segment"), F.filter(
            "hashes", lambda h: F.shiftrightunsigned(h, width) == f).alias("part")))).alias("s")).select("node", "s.segment", "s.part")
    left = parts.select(F.col("node").alias("a"), "segment", F.col("part").alias("part_a"))
    right = parts.select(F.col("node").alias("b"), "segment", F.col("part").alias("part_b"))
    partial = pairs.join(left, "a").join(right, ["b", "segment"]).select(
        "a", "na", "b", "nb", F.size(F.array_intersect("part_a", "part_b")).alias("common"))
    return partial.groupBy("a", "na", "b", "nb").agg(F.sum("common").alias("overlap"))


def _overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections: the order of hashes is cut into fragments, each adds its partial overlaps."""
    lengths = [len(x) for x in sets]
    _, column, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), lengths)
    twice = counts > 1
    rank = np.cumsum(twice) - 1
    row, column = row[twice[column]], rank[column[twice[column]]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    out = np.zeros((len(sets), len(sets)), dtype=np.float32)
    for low in range(0, int(twice.sum()), COLUMNS):
        at = slice(*np.searchsorted(column, [low, low + COLUMNS]))
        part = np.zeros((len(sets), COLUMNS), dtype=np.float32)
        part[row[at], column[at] - low] = 1
        out += part @ part.T
    return out


def _spanning_links(nodes: list[bytes], sizes: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[bytes, bytes]]:
    """Links that connect what the links among these sets connect: one less than the sets, at most."""
    overlap = _overlaps(sets).astype(np.int64)
    linked = 100 * overlap >= percent * (sizes[:, None] + sizes[None, :] - overlap)
    new, out = np.ones(len(nodes), dtype=bool), []
    for start in range(len(nodes)):
        if not new[start]:
            continue
        new[start] = False
        stack = [start]
        while stack:
            u = stack.pop()
            found = np.flatnonzero(linked[u] & new)
            new[found] = False
            out += [(nodes[u], nodes[v]) for v in found]
            stack += found.tolist()
    return out


def compare_groups(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that connect, within each group `a` of `m` members, all that are similar enough. A large group is cut
    into blocks, each pair of blocks is one cell, and cells stream through tasks one after the other."""
    width = F.greatest(F.lit(100.0), F.least(F.lit(2000.0), 2 * F.sqrt("m")))
    blocks = F.ceil(F.col("m") / width).cast("int")
    own = members.withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    cells = own.withColumn("other", F.explode(F.when(F.col("blocks") == 1, F.array(F.lit(0))).otherwise(
        F.array_remove(F.sequence(F.lit(0), F.col("blocks") - 1), F.col("own")))))
    cells = cells.select("a", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "node", "n")
    cells = cells.join(sets.select("node", "hashes"), "node").repartition("a", "i", "j").sortWithinPartitions("a", "i", "j")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cell, rows = None, []
        for batch in batches:
            links = []
            for a, i, j, node, n, hashes in batch[["a", "i", "j", "node", "n", "hashes"]].itertuples(index=False, name=None):
                if cell != (a, i, j):
                    links += closed(rows)
                    cell, rows = (a, i, j), []
                rows.append((node, n, hashes))
            yield pd.DataFrame(links, columns=["a", "b"])
        yield pd.DataFrame(closed(rows), columns=["a", "b"])

    def closed(rows: list[tuple]) -> list[tuple[bytes, bytes]]:
        if len(rows) < 2:
            return []
        return _spanning_links([r[0] for r in rows], np.array([r[1] for r in rows]), [r[2] for r in rows], percent)

    return cells.mapInPandas(run, "a binary, b binary")


def similar_components(docs: DataFrame, size: int = 5, percent: int = 80, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, n_shingles, component_id) per row of `docs`.

    Words are runs without blanks, A-Z in lower case; a set holds the distinct shingles of `size` words, all words if
    there are fewer, none if there are none. Two sets link when 100 * intersection >= percent * union; component_id is
    the least key that links reach. Null and empty texts have no shingles and link with nothing. Rows with a null key
    link with nothing and get nulls. Repeated rows give repeated rows; rows that share a key but not their text are
    nodes of their own. Other columns are left out. An empty table gives an empty one.
    """
    profiles = staged(shingle_profiles(docs, size, percent, text, key), "profiles")
    sets = staged(profiles.where("hashes IS NOT NULL").groupBy("node").agg(
        F.first("n").alias("n"), F.max("common").alias("common"), F.max("hashes").alias("hashes")), "sets")

    # the rarest hashes: linked sets share one of these
    needed = F.ceil(F.lit(percent) * F.col("n") / 100).cast("int")
    prefix = staged(sets.select("node", "n", "common", F.explode(F.slice(
        "hashes", F.lit(1), F.greatest(F.size("hashes") - needed + 1, F.lit(0)))).alias("h")), "prefixes")
    centres = prefix.groupBy("h").agg(F.max(F.struct("common", "node", "n")).alias("c"), F.count("*").alias("m")).where("m > 1")
    under = staged(prefix.join(centres.select("h", F.col("c.node").alias("a"), F.col("c.n").alias("na")), "h"), "stars")
    star = under.where("node <> a").where(_long_enough(F.col("na"), F.col("n"), percent))
    star = star.select("a", "na", F.col("node").alias("b"), F.col("n").alias("nb")).distinct()
    union = F.col("na") + F.col("nb") - F.col("overlap")
    linked = 100 * F.col("overlap") >= percent * union
    stars = staged(count_overlaps(star, sets).where(linked).select("a", "b"), "star-links")
    labels = components(stars)

    # what the stars have not decided: sets around one centre, in different components
    around = under.select("a", "node", "n").distinct().join(
        labels.select("node", F.col("root").alias("label")), "node", "left").withColumn("label", F.coalesce("label", "node"))
    open_groups = around.groupBy("a").agg(F.count("*").alias("m"), F.min("label").alias("x"), F.max("label").alias("y"))
    open_groups = open_groups.where("m > 2 AND x <> y").select("a", "m")
    more = compare_groups(around.join(open_groups, "a").select("a", "m", "node", "n"), sets, percent)
    links = stars.unionAll(more)
    roots = components(links)

    named = profiles.groupBy("node").agg(F.min("k").alias("least"))
    named = named.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = named.groupBy("root").agg(F.min("least").alias("component"))
    named = staged(named.join(least, "root").select("node", "component"), "classes")
    # empty sets share a node but link with nothing
    out = profiles.join(named, "node").select(
        F.col("k").alias(key), F.col("n").alias("n_shingles"), F.when(F.col("n") == 0, F.col("k")).otherwise(F.col("component")).alias("component_id"))
    nameless = docs.where(F.col(key).isNull()).select(
        F.lit(None).cast("bigint").alias(key), F.lit(None).cast("bigint").alias("n_shingles"), F.lit(None).cast("bigint").alias("component_id"))
    return out.unionAll(nameless)
