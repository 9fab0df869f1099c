"""Importance resampling of documents towards a target set, by hashed word n-grams.

A task joins the texts of a batch with sentinels and finds all words in one regex pass. A search of their places among
the ends of the texts says whose they are and masks the n-grams that would reach from one text into the next; what
remains is counted per bucket. A document's weight is the mean gain of its features: the logarithm of how much more
frequent a bucket is in the target. Weights plus keyed Gumbel noise are ranked, which draws without replacement.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from otelier.llm.staging import staged
from otelier.llm.words import PIECE, WORD, joined, pieces

_ROW = (1 << 33) - 1  # a row's place within its task, in monotonically_increasing_id


def batch_features(data: bytes, ends: np.ndarray, longest: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket of each feature, its document, words per document) of joined texts that end at `ends`."""
    spans = [m.span() for m in WORD.finditer(data)]
    starts = np.fromiter((a for a, _ in spans), dtype=np.int64, count=len(spans))
    owner = np.searchsorted(ends, starts)
    hashed, owners = [np.fromiter((crc32(data[a:b]) for a, b in spans), dtype=np.int64, count=len(spans))], [owner]
    if longest > 1:
        words = [data[a:b] for a, b in spans]
        for n in range(2, longest + 1):
            inside = np.flatnonzero(owner[: len(owner) - n + 1] == owner[n - 1:]) if len(owner) >= n else np.zeros(0, dtype=np.int64)
            hashed.append(np.fromiter((crc32(b" ".join(words[i:i + n])) for i in inside), dtype=np.int64, count=len(inside)))
            owners.append(owner[inside])
    return np.concatenate(hashed) % buckets, np.concatenate(owners), np.bincount(owner, minlength=len(ends))


def _long_features(text: bytes, longest: int, buckets: int) -> Iterator[tuple[np.ndarray, int]]:
    """(buckets, words) of one text piece by piece; n-grams that cross a cut are made of the last words before it."""
    before: list[bytes] = []
    for piece in pieces(text):
        words = WORD.findall(piece)
        hashed = [crc32(w) for w in words]
        for n in range(2, longest + 1):
            tail = before[len(before) - n + 1:] if len(before) >= n else before
            run = tail + words
            hashed += [crc32(b" ".join(run[i:i + n])) for i in range(len(run) - n + 1)]
        before = (before + words)[-(longest - 1):] if longest > 1 else []
        yield np.array(hashed, dtype=np.int64) % buckets, len(words)


def text_features(texts: list[bytes], longest: int, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(buckets, index of the text of each, words per text) in portions of bounded size; all texts occur in order, a long
    one in several portions."""
    for first, data, ends in joined(texts):
        if len(ends) == 1 and len(data) > PIECE:
            for found, n in _long_features(data, longest, buckets):
                count = np.zeros(len(texts), dtype=np.int64)
                count[first] = n
                yield found, np.full(len(found), first), count
            continue
        found, owner, n = batch_features(data, ends, longest, buckets)
        count = np.zeros(len(texts), dtype=np.int64)
        count[first:first + len(ends)] = n
        yield found, owner + first, count


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return [t or b"" for t in batch.column("__text").to_pylist()]


def bucket_counts(docs: DataFrame, longest: int, buckets: int, text: str = "text") -> DataFrame:
    """(bucket, n) of all documents. A task adds up its batches and sends at most one row per bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for found, _, _ in text_features(_texts(batch), longest, buckets):
                total += np.bincount(found, minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["bucket", "n"])

    counted = docs.select(F.col(text).cast("binary").alias("__text")).mapInArrow(run, "bucket bigint, n bigint")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(raw: DataFrame, target: DataFrame, longest: int, buckets: int, text: str = "text") -> np.ndarray:
    """floor(1000 * ln(target share / raw share)) per bucket, with one added to each. Only `buckets` pairs of numbers
    come to the driver."""
    s, t = np.zeros(buckets), np.zeros(buckets)
    for row in bucket_counts(raw, longest, buckets, text).collect():
        s[row["bucket"]] = row["n"]
    for row in bucket_counts(target, longest, buckets, text).collect():
        t[row["bucket"]] = row["n"]
    all_s, all_t = s.sum() + buckets, t.sum() + buckets
    return np.array([math.floor(1000 * math.log((b + 1) * all_s / ((a + 1) * all_t))) for a, b in zip(s, t)], dtype=np.int64)


def importance_weights(docs: DataFrame, gains: np.ndarray, longest: int, text: str, keep: list[str]) -> DataFrame:
    """The columns in `keep` with n_words, n_features and weight: the floored mean gain of its features, 0 without any."""
    buckets = len(gains)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, features, total = (np.zeros(batch.num_rows, dtype=np.int64) for _ in range(3))
            for found, owner, n in text_features(_texts(batch), longest, buckets):
                words += n
                features += np.bincount(owner, minlength=batch.num_rows)
                # sums of whole numbers: exact
                total += np.bincount(owner, weights=gains[found], minlength=batch.num_rows).astype(np.int64)
            added = [words, features, total // np.maximum(features, 1)]
            yield pa.RecordBatch.from_arrays([*map(batch.column, keep), *map(pa.array, added)], names=[*keep, *names])

    names, kept = ["n_words", "n_features", "weight"], docs.select(*keep).schema
    for name in names:
        kept = kept.add(name, T.LongType())
    return docs.select(*keep, F.col(text).cast("binary").alias("__text")).mapInArrow(run, kept)


def gumbel(seed: int, key: Column) -> Column:
    """floor(1000 * noise), noise a Gumbel number that depends on the seed and the key alone (null: as the empty text)."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("bigint")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296))).cast("bigint")


def _ranked(candidates: DataFrame, order: list[Column]) -> DataFrame:
    """`rank` from 1 over the whole table: a sort by range, then the number of rows in the ranges before."""
    placed = candidates.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id())
    placed = staged(placed, "ranked").withColumn("__part", F.expr("shiftrightunsigned(__at, 33)"))
    sizes = placed.groupBy("__part").agg(F.count("*").alias("n"))  # a row per task
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__before"))
    return placed.join(offsets, "__part").withColumn(
        "rank", F.col("__before") + F.col("__at").bitwiseAND(F.lit(_ROW)) + 1).drop("__at", "__part", "__before")


def importance_ranks(
    docs: DataFrame, target: DataFrame, longest: int = 1, buckets: int = 10_000, percent: int = 10, min_words: int = 20,
    seed: int = 2024, text: str = "text", key: str = "doc_id", keep: tuple[str, ...] = (),
) -> DataFrame:
    """Every row of `docs`: key, the columns in `keep`, n_words, n_features, weight, score and rank.

    Words are runs of digits, letters and characters beyond ASCII, A-Z in lower case; features are all runs of 1 to
    `longest` words. score is weight plus Gumbel noise of seed and key. Of the documents with at least `min_words` words
    the `percent` of highest score are drawn (rounded down) and ranked from 1, ties to the smaller key (null first),
    then fewer words; rank is null for all others. Null text has no words; without features the weight is 0. Very long
    texts are read piece by piece. Repeated rows are documents of their own with equal scores and ranks next to each
    other. `keep` must not name a result column. An empty table gives no rows; an empty target pulls towards no word.
    """
    gains = bucket_gains(docs, target, longest, buckets, text)
    weighed = importance_weights(docs, gains, longest, text, list(dict.fromkeys([key, *keep])))
    scored = staged(weighed.withColumn("score", F.col("weight") + gumbel(seed, F.col(key))).withColumn(
        "__row", F.monotonically_increasing_id()), "scored")

    eligible = scored.where(F.col("n_words") >= min_words)
    # scores are whole numbers within the range of gains and noise, so there are some ten thousands of them at any size
    histogram = sorted(map(tuple, eligible.groupBy("score").agg(F.count("*").alias("n")).collect()), reverse=True)
    draw, seen, least = sum(n for _, n in histogram) * percent // 100, 0, None
    for score, n in histogram:
        if seen >= draw:
            break
        seen, least = seen + n, score
    if least is None:
        return scored.withColumn("rank", F.lit(None).cast("bigint")).drop("__row")
    candidate = (F.col("n_words") >= min_words) & (F.col("score") >= least)
    order = [F.desc("score"), F.asc(key), F.asc("n_words"), F.asc("__row")]
    ranked = _ranked(scored.where(candidate), order).withColumn("rank", F.when(F.col("rank") <= draw, F.col("rank")))
    rest = scored.where(~candidate).withColumn("rank", F.lit(None).cast("bigint"))
    return ranked.unionByName(rest).drop("__row")


def resample(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The drawn documents, with all their columns."""
    keep = tuple(c for c in docs.columns if c not in ("n_words", "n_features", "weight", "score", "rank"))
    return importance_ranks(docs, target, keep=keep, **options).where("rank IS NOT NULL").select(*keep)


ORACLE = r"""
WITH crc_table AS (
  SELECT list_transform(range(256), lambda b: list_reduce(
    list_prepend(b, range(8)), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS steps),
words AS (
  SELECT rid, doc_id, 0 AS is_target, unnest(ws) AS w FROM (
    SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
    FROM documents)
  UNION ALL
  SELECT NULL, NULL, 1, unnest(regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'))
  FROM benchmark),
hashed AS (
  SELECT w, xor(list_reduce(list_prepend(4294967295, list_transform(range(length(h) // 2),
              lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT)),
           lambda c, b: xor(c // 256, steps[xor(c % 256, b) + 1])), 4294967295) % 10000 AS bucket
  FROM (SELECT DISTINCT w, hex(encode(w)) AS h FROM words), crc_table),
features AS (SELECT rid, doc_id, is_target, bucket FROM words JOIN hashed USING (w)),
counts AS (
  SELECT bucket, count(*) FILTER (is_target = 0) AS s, count(*) FILTER (is_target = 1) AS t FROM features GROUP BY bucket),
totals AS (SELECT sum(s) AS all_s, sum(t) AS all_t FROM counts),
gains AS (
  SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (all_s + 10000)::DOUBLE / ((s + 1)::DOUBLE * (all_t + 10000)::DOUBLE)))::BIGINT AS gain
  FROM counts, totals),
weights AS (
  SELECT rid, count(*) AS n, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight
  FROM features JOIN gains USING (bucket) WHERE is_target = 0 GROUP BY rid),
scored AS (
  SELECT d.doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(d.doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE)
                                                    / 4294967296)))::BIGINT AS score
  FROM (SELECT row_number() OVER () AS rid, doc_id FROM documents) d LEFT JOIN weights USING (rid)),
drawn AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS r, count(*) FILTER (n_features >= 20) OVER () AS n
  FROM scored)
SELECT doc_id, n_features::BIGINT AS n_features, weight, score, CASE WHEN n_features >= 20 AND r <= n * 10 // 100 THEN r END AS rank FROM drawn
"""
