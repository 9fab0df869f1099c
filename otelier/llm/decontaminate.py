"""Benchmark passages in training text, found with a generalised suffix automaton of the benchmark.

The automaton accepts every run of words of every item. A document streams through it word by word; the state tells the
longest run that ends here and occurs in an item. Where that run is at least a window long, its words are hit, and the
state's last window names the items. Items shorter than a window count as one window and are marked at their state.

Automata hold a bounded number of words. A benchmark of any size is cut into several, built in tasks; as many as fit
the broadcast bound go over the documents together, and further passes add to what earlier ones found.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from hashlib import md5

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from otelier.llm.memo import once
from otelier.llm.staging import staged
from otelier.llm.words import WORD, pieces

WINDOW = 10
#: Words of one chunk of an item and of one automaton, and bytes of automata sent to all tasks at once.
CHUNK_WORDS, AUTOMATON_WORDS, BROADCAST_BYTES = 10_000, 100_000, 64 << 20


class Automaton:
    """Suffix automaton over (words, item) chunks; `window` is the number of words that make a hit."""

    def __init__(self, chunks: list[tuple[str | None, list[bytes]]], window: int):
        self.window = window
        self.words: dict[bytes, int] = {}
        coded = [(item, [self.words.setdefault(w, len(self.words)) for w in ws]) for item, ws in chunks if ws]
        self.shortest = min((min(len(ids), window) for _, ids in coded), default=window)

        steps, self.link, self.length = [{}], [-1], [0]
        for _, ids in coded:
            last = 0
            for c in ids:
                last = self._extend(steps, last, c)

        # pairs of neighbours: a run breaks where a text has another pair
        width = len(self.words)
        self.pairs = np.unique(np.concatenate([np.array(ids[:-1], dtype=np.int64) * width + ids[1:] for _, ids in coded] or [np.zeros(0, np.int64)]))
        self.next = {s * width + c: t for s, step in enumerate(steps) for c, t in step.items()}
        self._name_windows(coded)

    def _extend(self, steps: list[dict[int, int]], last: int, c: int) -> int:
        """The state of the run that ends in `last`, one word longer."""
        link, length = self.link, self.length
        there = steps[last].get(c)
        if there is not None and length[there] == length[last] + 1:
            return there

        def split(state: int, of: int) -> int:
            """A copy of state `of` that holds only the runs that reach it from `state` and its suffixes."""
            steps.append(dict(steps[of]))
            link.append(link[of])
            length.append(length[state] + 1)
            copy = len(steps) - 1
            while state >= 0 and steps[state].get(c) == of:
                steps[state][c] = copy
                state = link[state]
            link[of] = copy
            return copy

        if there is not None:
            return split(last, there)
        steps.append({})
        link.append(0)
        length.append(length[last] + 1)
        new, state = len(steps) - 1, last
        while state >= 0 and c not in steps[state]:
            steps[state][c] = new
            state = link[state]
        if state >= 0:
            there = steps[state][c]
            link[new] = there if length[there] == length[state] + 1 else split(state, there)
        return new

    def _name_windows(self, coded: list[tuple[str | None, list[int]]]) -> None:
        """For each state that holds a whole window its items; `marked` leads from a state to the next one, itself
        included, that holds a short item."""
        self.items: dict[int, set] = {}
        self.short: dict[int, dict[int, set]] = {}
        for item, ids in coded:
            state = 0
            for i, c in enumerate(ids):
                state = self.cut(self.next[state * len(self.words) + c])
                if i + 1 >= self.window:
                    self.items.setdefault(state, set()).add(item)
            if len(ids) < self.window:
                self.short.setdefault(state, {}).setdefault(len(ids), set()).add(item)
        self.marked = [-1] * len(self.link)
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__):  # links lead to shorter runs
            self.marked[state] = state if state in self.short else self.marked[self.link[state]]

    def cut(self, state: int) -> int:
        """The state of the last `window` words of a state's runs."""
        while self.link[state] > 0 and self.length[self.link[state]] >= self.window:
            state = self.link[state]
        return state

    def runs(self, ids: np.ndarray) -> Iterator[tuple[int, int]]:
        """(start, end) of the runs of known words in known pairs that are long enough to hold the shortest window."""
        known = ids >= 0
        linked = np.zeros(len(ids), dtype=bool)
        if len(self.pairs):
            pair = ids[:-1] * len(self.words) + ids[1:]
            at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
            linked[1:] = known[:-1] & known[1:] & (self.pairs[at] == pair)
        starts = np.flatnonzero(known & ~linked)
        ends = np.flatnonzero(known & ~np.concatenate([linked[1:], [False]])) + 1
        long = ends - starts >= self.shortest
        return zip(starts[long].tolist(), ends[long].tolist())

    def scan(self, words: list[int], start: int, spans: list[list[int]], found: set) -> int:
        """Stream the known `words`, which begin at word `start` of a text: adds hit spans (ordered by their end) and
        items, and returns the length of the longest run matched."""
        following, link, length, width, window = self.next, self.link, self.length, len(self.words), self.window
        state = matched = longest = 0
        for i, c in enumerate(words, start + 1):
            while (there := following.get(state * width + c)) is None:
                state = link[state]
                matched = length[state]
            state = there
            matched += 1
            longest = max(longest, matched)
            if matched >= window:
                found |= self.items[self.cut(state)]
                _add(spans, i - matched, i)
            mark, held = self.marked[state], matched
            while mark > 0:
                held = min(held, length[mark])
                for size, items in self.short[mark].items():
                    if size <= held:
                        found |= items
                        _add(spans, i - size, i)
                mark = self.marked[link[mark]]
        return longest


def _add(spans: list[list[int]], start: int, end: int) -> None:
    """Add a span that ends no earlier than those before; touching spans become one."""
    while spans and spans[-1][1] >= start:
        start, end = min(start, spans[-1][0]), max(end, spans[-1][1])
        spans.pop()
    spans.append([start, end])


def merged(spans: list) -> list[list[int]]:
    """Spans in order, touching ones joined."""
    out: list[list[int]] = []
    for start, end in sorted(map(tuple, spans)):
        if out and out[-1][1] >= start:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return out


def word_ids(texts: list[bytes | None], words: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the words of all texts, -1 for unknown ones and between texts, and where each text begins."""
    out, offsets, at = [], [], 0
    for text in texts:
        offsets.append(at)
        for piece in pieces(text or b""):
            found = WORD.findall(piece)
            out.append(np.fromiter((words.get(w, -1) for w in found), dtype=np.int64, count=len(found)))
            at += len(found)
        out.append(np.array([-1]))
        at += 1
    return np.concatenate(out) if out else np.zeros(0, dtype=np.int64), np.array([*offsets, at])


def automata(items: DataFrame, window: int = WINDOW, text: str = "text", key: str = "item_id",
             chunk_words: int = CHUNK_WORDS, automaton_words: int = AUTOMATON_WORDS) -> DataFrame:
    """(shard, blob): pickled automata of the items, each of about `automaton_words` words.

    Long items are cut into chunks that share `window` - 1 words, so each window lies whole in one of them.
    """

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for item, content in zip(batch["item"].astype(object), batch["t"]):
                item, held, first = None if pd.isna(item) else item, [], True
                for piece in pieces(content or b""):
                    held += WORD.findall(piece)
                    while len(held) > chunk_words + window:
                        rows.append((item, b" ".join(held[:chunk_words + window - 1]), chunk_words))
                        held, first = held[chunk_words:], False
                if held and (first or len(held) >= window):
                    rows.append((item, b" ".join(held), len(held)))
            yield pd.DataFrame(rows, columns=["item", "words", "n"])

    chunks = staged(items.select(F.col(key).cast("string").alias("item"), F.col(text).cast("binary").alias("t")).mapInPandas(
        cut, "item string, words binary, n bigint"), "benchmark-words")
    total = chunks.agg(F.sum("n")).first()[0] or 0
    shards = max(1, -(-total // automaton_words))

    def build(group: pd.DataFrame) -> pd.DataFrame:
        made = Automaton([(i if isinstance(i, str) else None, w.split(b" ")) for i, w in zip(group["item"], group["words"])], window)
        return pd.DataFrame({"shard": [int(group["shard"].iloc[0])], "blob": [pickle.dumps(made, protocol=5)]})

    numbered = chunks.withColumn("shard", F.pmod(F.xxhash64("words"), F.lit(shards)).cast("int"))
    return staged(numbered.groupBy("shard").applyInPandas(build, "shard int, blob binary"), "automata")


def _passes(built: DataFrame, bytes_at_once: int) -> Iterator[list[bytes]]:
    """Automata in groups that together stay within the bound (or hold a single one)."""
    sizes = built.select("shard", F.octet_length("blob").alias("size")).orderBy("shard").collect()
    group, room = [], bytes_at_once
    for shard, size in map(tuple, sizes):
        if group and size > room:
            yield [r["blob"] for r in built.where(F.col("shard").isin(group)).collect()]
            group, room = [], bytes_at_once
        group.append(shard)
        room -= size
    if group:
        yield [r["blob"] for r in built.where(F.col("shard").isin(group)).collect()]


_FOUND = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("longest", T.LongType()),
    T.StructField("spans", T.ArrayType(T.ArrayType(T.LongType()))), T.StructField("items", T.ArrayType(T.StringType()))])
_ARROW = [pa.int64(), pa.int64(), pa.list_(pa.list_(pa.int64())), pa.list_(pa.string())]


def _one_pass(rows: DataFrame, blobs: list[bytes], names: list[str]) -> DataFrame:
    """Add what the automata of a pass find to the columns n_words, longest, spans and items."""
    marks = [md5(b).hexdigest() for b in blobs]

    def load() -> tuple[dict[bytes, int], list[tuple[Automaton, np.ndarray]]]:
        """All known words with their numbers, and each automaton with its own numbers for them (-1: none; the last
        entry stands for unknown words)."""
        loaded, words = [pickle.loads(b) for b in blobs], {}
        for automaton in loaded:
            for w in automaton.words:
                words.setdefault(w, len(words))
        own = []
        for automaton in loaded:
            numbers = np.full(len(words) + 1, -1, dtype=np.int64)
            numbers[[words[w] for w in automaton.words]] = list(automaton.words.values())
            own.append((automaton, numbers))
        return words, own

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, own = once(("automata", *marks), load)
        for batch in batches:
            spans = [s or [] for s in batch.column("spans").to_pylist()]
            items = [set(s or ()) for s in batch.column("items").to_pylist()]
            longest = [n or 0 for n in batch.column("longest").to_pylist()]
            codes, offsets = word_ids(batch.column("__text").to_pylist(), words)
            for automaton, numbers in own:
                ids = numbers[codes]
                for start, end in automaton.runs(ids):
                    doc = int(np.searchsorted(offsets, start, side="right")) - 1
                    here: list[list[int]] = []
                    n = automaton.scan(ids[start:end].tolist(), start - int(offsets[doc]), here, items[doc])
                    longest[doc] = max(longest[doc], n)
                    spans[doc] += here
            found = [np.diff(offsets) - 1, longest, [merged(s) for s in spans], [sorted(x for x in s if x is not None) for s in items]]
            yield pa.RecordBatch.from_arrays(
                [*map(batch.column, kept), *[pa.array(v, t) for v, t in zip(found, _ARROW)]], names=[*kept, *_FOUND.names])

    kept = [*names, "__text"]
    return rows.mapInArrow(run, T.StructType([*rows.select(*kept).schema.fields, *_FOUND.fields]))


def find_passages(docs: DataFrame, items: DataFrame, window: int = WINDOW, text: str = "text", key: str = "doc_id",
                  item_key: str = "item_id", item_text: str = "text", keep: tuple[str, ...] = (), bytes_at_once: int = BROADCAST_BYTES, **limits) -> DataFrame:
    """Every row of `docs`: key, the columns in `keep`, n_words, n_hit, longest, spans and items.

    Words are runs of digits, letters and characters beyond ASCII, A-Z in lower case. A window is `window` consecutive
    words of an item, or a shorter item as a whole. A document word within any occurrence of a window is hit. spans are
    [first, end) numbers of the hit words, joined where they touch; items the ids, as sorted texts, of the items with an
    occurring window (an item without id counts for hits only; a repeated id counts once); longest is the longest run of
    words found in an item, looked for where a window could lie, 0 elsewhere. Null and empty texts have no words and hit
    nothing, and so do such items. Very long texts are read piece by piece and matched across pieces. Repeated rows
    and keys are rows of their own; `keep` must not name a result column. Empty tables give no rows or no hits.
    """
    names = list(dict.fromkeys([key, *keep]))
    rows = docs.select(*names, F.col(text).cast("binary").alias("__text"), *[
        F.lit(None).cast(f.dataType).alias(f.name) for f in _FOUND.fields])
    groups = list(_passes(automata(items, window, item_text, item_key, **limits), bytes_at_once)) or [[]]
    for n, blobs in enumerate(groups):
        rows = _one_pass(staged(rows, "passages") if n else rows, blobs, names)
    hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s[1] - s[0])
    return rows.select(*names, "n_words", hit.alias("n_hit"), "longest", "spans", "items")


def remove_passages(docs: DataFrame, items: DataFrame, window: int = WINDOW, longest_kept: int = 0, coverage: float = 0.5,
                    text: str = "text", key: str = "doc_id", item_key: str = "item_id", **limits) -> DataFrame:
    """`docs` without the spans of more than `longest_kept` hit words, from the first byte of their first word to the last
    of their last, and without the documents of which more than `coverage` of the words are hit. Null text stays null;
    other columns pass, except those that `find_passages` adds, which are replaced."""
    names = [c for c in docs.columns if c not in ("n_words", "n_hit", "longest", "spans", "items")]
    found = find_passages(docs, items, window, text, key, item_key, keep=tuple(names), **limits)
    kept = found.where(F.col("n_hit") <= coverage * F.col("n_words"))

    @F.pandas_udf("binary")
    def cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else without(t, [s for s in ss if s[1] - s[0] > longest_kept]) for t, ss in zip(texts, spans)])

    clean = F.when(F.size("spans") > 0, cut(F.col(text).cast("binary"), "spans").cast("string")).otherwise(F.col(text))
    return kept.select(*[clean.alias(c) if c == text else F.col(c) for c in names])


def without(text: bytes, spans: list) -> bytes:
    """UTF-8 text without the given spans of words."""
    begin, end = {int(a) for a, _ in spans}, {int(b) - 1 for _, b in spans}
    out, at, read, count = [], 0, 0, 0
    for piece in pieces(text):
        for m in WORD.finditer(piece):
            if count in begin:
                out.append(text[at:read + m.start()])
            if count in end:
                at = read + m.end()
            count += 1
        read += len(piece)
    return b"".join([*out, text[at:]])


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + 9], ' ') AS run
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
places AS (
  SELECT rid, i, n, array_to_string(w[i:i + n - 1], ' ') AS run
  FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM windows))),
hits AS (SELECT rid, i, n, item_id FROM places JOIN windows USING (n, run)),
words AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM hits) GROUP BY rid),
named AS (
  SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT rid, item_id::VARCHAR AS item FROM hits WHERE item_id IS NOT NULL) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (rid) LEFT JOIN named USING (rid)
"""
