"""Quality by hierarchical empirical Bayes: a document's own evidence, shrunk rates of its path and its host.

A logistic regression on surface features gives each document a probability of being good. Grouped sums of these give
rates per path and per host. The spread between groups, beyond what their sizes explain, says how much a group's own
rate counts: a host with few documents stays near the global rate, a path with few documents near its host's rate.
The rate of the path (without the document itself) is the prior to which the document's evidence is added.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from otelier.llm.ragged import mix, span_hashes
from otelier.llm.staging import staged

FEATURES = ("upper", "digit", "sentence", "exclamation", "bar", "symbol", "foreign", "repeated", "distinct", "symbol_ends",
            "word_length", "log_words")
#: Labelled documents to fit on, at most (those with the smallest hash of their key): they come to the driver.
MAX_LABELS = 20_000
#: Documents with a smaller probability of being good are rejected.
THRESHOLD = 0.5
_PIECE = 500_000
_OTHER, _LOWER, _UPPER, _DIGIT, _BLANK, _SENTENCE, _EXCLAMATION, _BAR, _SYMBOL = range(9)


def _classes() -> np.ndarray:
    kinds = np.full(256, _OTHER, dtype=np.int64)
    kinds[0x21:0x7F] = _SYMBOL
    for chars, kind in ((range(97, 123), _LOWER), (range(65, 91), _UPPER), (range(48, 58), _DIGIT),
                        (b" \t\n\x0b\x0c\r", _BLANK), (b".,;:?'\"()-", _SENTENCE), (b"!", _EXCLAMATION), (b"|", _BAR)):
        kinds[list(chars)] = kind
    return kinds


_CLASS = _classes()


def text_features(texts: list[str]) -> np.ndarray:
    """One row of FEATURES per text. Long texts are counted piece by piece; `distinct` is over words of a piece."""
    out = np.zeros((len(texts), len(FEATURES)))
    batch, size = [], 0
    for i, t in enumerate(texts):
        data = t.encode("utf-8", "surrogatepass")
        batch.append((i, data))
        size += len(data) + 1
        if size >= _PIECE or i == len(texts) - 1:
            _fill(out, batch)
            batch, size = [], 0
    return out


def _fill(out: np.ndarray, batch: list[tuple[int, bytes]]) -> None:
    sums = np.zeros((len(batch), 14))
    pieces, owners, size = [], [], 0
    for row, (_, data) in enumerate(batch):
        for at in range(0, max(1, len(data)), _PIECE):
            pieces.append(data[at:at + _PIECE])
            owners.append(row)
            size += len(pieces[-1])
            if size >= _PIECE:
                _count(sums, pieces, owners)
                pieces, owners, size = [], [], 0
    if pieces:
        _count(sums, pieces, owners)
    kinds, words, same, distinct, ends, length = sums[:, :9], *sums[:, 9:14].T
    letters = np.maximum(kinds[:, _LOWER] + kinds[:, _UPPER], 1)
    shown = np.maximum(kinds.sum(1) - kinds[:, _BLANK], 1)
    n = np.maximum(words, 1)
    rows = [i for i, _ in batch]
    out[rows] = np.stack([
        kinds[:, _UPPER] / letters, kinds[:, _DIGIT] / shown, kinds[:, _SENTENCE] / shown, kinds[:, _EXCLAMATION] / shown,
        kinds[:, _BAR] / shown, kinds[:, _SYMBOL] / shown, kinds[:, _OTHER] / shown, same / n, distinct / n, ends / n,
        length / n, np.log1p(words)], 1)


def _count(sums: np.ndarray, pieces: list[bytes], owners: list[int]) -> None:
    lengths = np.array([len(p) + 1 for p in pieces])
    data = np.frombuffer(b"\n".join(pieces) + b"\n", dtype=np.uint8)
    kind = _CLASS[data]
    of_byte = np.repeat(np.arange(len(pieces)), lengths)
    counts = np.bincount(of_byte * 9 + kind, minlength=9 * len(pieces)).reshape(-1, 9).astype(float)
    counts[:, _BLANK] -= 1
    word = kind != _BLANK
    start, stop = word.copy(), word.copy()
    start[1:] &= ~word[:-1]
    stop[:-1] &= ~word[1:]
    s, e = np.flatnonzero(start), np.flatnonzero(stop) + 1
    of_word = of_byte[s]
    tally = lambda mask: np.bincount(of_word[mask], minlength=len(pieces)).astype(float)
    every = np.ones(len(s), dtype=bool)
    h = span_hashes(data, s, e)
    same = np.zeros(len(s), dtype=bool)
    same[1:] = (h[1:] == h[:-1]) & (of_word[1:] == of_word[:-1])
    first = np.zeros(len(s), dtype=bool)
    first[np.unique(mix(h + of_word.astype(np.uint64)), return_index=True)[1]] = True
    ends = np.isin(kind[e - 1], (_SYMBOL, _EXCLAMATION, _BAR))
    length = np.bincount(of_word, weights=e - s, minlength=len(pieces))
    found = np.column_stack([counts, tally(every), tally(same), tally(first), tally(ends), length])
    np.add.at(sums, owners, found)


@dataclass(frozen=True)
class DocumentModel:
    """log-odds = bias + weights * features; `base` is the share of good documents among the labelled ones."""

    bias: float
    weights: tuple[float, ...]
    base: float


def fit(features: np.ndarray, good: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> DocumentModel:
    """Logistic regression by Newton's method on standardised features. Without both classes all weights are 0."""
    if len(good) == 0 or good.min() == good.max():
        return DocumentModel(0.0, (0.0,) * len(FEATURES), 0.5)
    mean, spread = features.mean(0), features.std(0) + 1e-9
    x = np.column_stack([np.ones(len(good)), (features - mean) / spread])
    w, penalty = np.zeros(x.shape[1]), np.full(x.shape[1], ridge)
    penalty[0] = 1e-9
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty), x.T @ (p - good) + penalty * w)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    weights = w[1:] / spread
    return DocumentModel(float(w[0] - weights @ mean), tuple(map(float, weights)), float(good.mean()))


def _probability(log_odds: Column) -> Column:
    return 1 / (1 + F.exp(-F.greatest(F.least(log_odds, F.lit(30.0)), F.lit(-30.0))))


def _log_odds(p: Column) -> Column:
    p = F.greatest(F.least(p, F.lit(1 - 1e-9)), F.lit(1e-9))
    return F.log(p / (1 - p))


def strength(groups: DataFrame, mean: Column) -> float:
    """How many documents the parent's rate counts for (method of moments for a beta prior): from the spread of group
    rates around `mean`, less what groups of such sizes show by chance. `groups` has n and s (sum of probabilities)."""
    noise = mean * (1 - mean)
    row = groups.agg(F.sum(F.col("n") * F.pow(F.col("s") / F.col("n") - mean, 2)).alias("seen"), F.sum(noise).alias("chance"),
                     F.sum(noise * F.col("n")).alias("scale")).first()
    if not row.scale:
        return 1.0
    between = max((row.seen - row.chance) / row.scale, 1e-6)
    return float(min(max(1 / between - 1, 1.0), 1e6))


def quality_scores(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id",
                   host: Column | None = None, path: Column | None = None, label: str = "quality") -> DataFrame:
    """(key, body, host, path, p_document, host_rate, path_rate, score, keep) per row of `docs`.

    `host` and `path` default to `source` and, within it, `lang`. `body` is the hash of the text: with the key it finds
    the row again. Null text counts as empty; a text without words gets score 0 and is rejected. Null host or path is
    a group of its own. Labels that are null, or whose key is null or unknown, are not used; a key labelled twice counts
    twice. Without labels of both kinds each document has probability 0.5 and is kept. Repeated rows
    give repeated rows; an empty table gives an empty one.
    """
    host = F.col("source") if host is None else host
    path = F.col("lang") if path is None else path

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = text_features([t or "" for t in batch["t"]])
            yield pd.DataFrame({c: batch[c] for c in ("k", "body", "host", "path")} | {"f": list(found)})

    kind = docs.schema[key].dataType.simpleString()
    source = docs.select(F.col(key).alias("k"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("body"),
                         host.cast("string").alias("host"), path.cast("string").alias("path"), F.col(text).alias("t"))
    rows = staged(source.mapInPandas(run, f"k {kind}, body bigint, host string, path string, f array<double>"), "features")

    known = labels.select(F.col(key).alias("k"), F.col(label).cast("double").alias("y")).where("y IS NOT NULL")
    # a share of the labels first, so that tasks don't each send as many rows as the bound allows
    share = min(1.0, 1.1 * MAX_LABELS / max(known.count(), 1))
    drawn = known.where(F.pmod(F.xxhash64("k"), F.lit(1 << 30)) < int(share * (1 << 30)))
    sample = rows.join(drawn, "k").orderBy(F.xxhash64("k"), "body").limit(MAX_LABELS).select("f", "y").toPandas()
    model = fit(np.array(sample["f"].tolist()).reshape(-1, len(FEATURES)), (sample["y"].to_numpy(dtype=float) > 0).astype(float))

    evidence = F.lit(model.bias)
    for i, w in enumerate(model.weights):
        evidence = evidence + F.lit(w) * F.col("f")[i]
    words = F.col("f")[FEATURES.index("log_words")]
    scored = rows.select("k", "body", "host", "path", (words > 0).alias("words"), _probability(evidence).alias("p"))

    paths = staged(scored.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("p").alias("s")), "paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    total = hosts.agg(F.sum("n").alias("n"), F.sum("s").alias("s")).first()
    overall = min(max(total.s / total.n, 1e-6), 1 - 1e-6) if total.n else 0.5
    k_host = strength(hosts, F.lit(overall))
    hosts = hosts.select(F.col("host").alias("h"), ((k_host * overall + F.col("s")) / (k_host + F.col("n"))).alias("host_rate"))
    paths = paths.join(hosts, F.col("host").eqNullSafe(F.col("h"))).drop("h")
    k_path = strength(paths, F.col("host_rate"))

    site = paths.select(F.col("host").alias("h"), F.col("path").alias("q"), "n", "s", "host_rate")
    joined = scored.join(site, F.col("host").eqNullSafe(F.col("h")) & F.col("path").eqNullSafe(F.col("q")))
    # the document's own evidence is not part of its prior
    path_rate = (k_path * F.col("host_rate") + F.col("s") - F.col("p")) / (k_path + F.col("n") - 1)
    score = _probability(_log_odds(F.col("p")) + _log_odds(path_rate) - F.lit(float(np.log(model.base / (1 - model.base)))))
    out = joined.withColumn("path_rate", path_rate).withColumn("score", F.when(F.col("words"), score).otherwise(0.0))
    return out.select(F.col("k").alias(key), "body", "host", "path", F.col("p").alias("p_document"), "host_rate", "path_rate",
                      "score", (F.col("score") >= THRESHOLD).alias("keep"))


def keep_good(docs: DataFrame, scores: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows of `docs` that `scores` keeps, unchanged."""
    rejected = scores.where(~F.col("keep")).select(F.col(key).alias("__k"), F.col("body").alias("__b")).distinct()
    match = F.col(key).eqNullSafe(F.col("__k")) & (F.xxhash64(F.coalesce(F.col(text), F.lit(""))) == F.col("__b"))
    return docs.join(rejected, match, "left_anti")
