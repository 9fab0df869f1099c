"""Decontamination and importance resampling against plain versions."""

import math
import random
import re
from collections import Counter
from hashlib import sha256
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from otelier.llm import decontaminate as D, resampling as R
from otelier.llm.words import WORD, joined, pieces
from tests.llm.brute import UPPER, awkward, awkward_rows, empty

ITEMS = "item_id bigint, text string, spans string, rank int"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UPPER))


def plain_hits(docs, items, window):
    wanted = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - window + 1) if w else 0):
            wanted.setdefault(tuple(w[i:i + window]), set()).add(item)
    sizes = {len(w) for w in wanted}
    out = []
    for key, text in docs:
        w, hit, names = words(text), set(), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                found = wanted.get(tuple(w[i:i + size]))
                if found:
                    hit |= set(range(i, i + size))
                    names |= found
        out.append((key, len(w), sorted(hit), sorted(str(n) for n in names if n is not None)))
    return sorted(out, key=repr)


def found_hits(df):
    return sorted(((r["doc_id"], r["n_words"], [p for a, b in r["spans"] for p in range(a, b)], r["items"]) for r in df.collect()), key=repr)


def case(seed):
    rng = random.Random(seed)
    text = lambda n, v: " ".join(rng.choice(v) for _ in range(n))
    few = ["a", "b", "Été", "1x"]
    items = [(i, text(rng.randrange(1, 30), few + ["zz"])) for i in range(12)] + [(3, text(12, few)), (None, text(9, few)), (40, None), (41, " .;"), (5, "A b")]
    docs = [(i, text(rng.randrange(0, 60), few + ["other"])) for i in range(60)] + awkward_pairs() + [(100, items[0][1] + "," + items[1][1])]
    return docs, items


def awkward_pairs():
    return [(r[0], r[1]) for r in awkward_rows()]


@pytest.mark.parametrize("window", [2, 3, 5])
def test_passages(spark, window):
    docs, items = case(window)
    df = spark.createDataFrame([(k, t, "x", 1) for k, t in docs], "doc_id bigint, text string, spans string, n_words int").repartition(3)
    bench = spark.createDataFrame([(*i, "s", 1) for i in items], ITEMS)
    want = plain_hits(docs, items, window)
    assert found_hits(D.find_passages(df, bench, window)) == want
    # items cut into chunks, several automata, a pass over the documents for each
    small = D.find_passages(df, bench, window, chunk_words=4, automaton_words=20, bytes_at_once=1)
    assert found_hits(small) == want
    for r in small.collect():
        assert r["n_hit"] == sum(b - a for a, b in r["spans"]) and all(a < b for a, b in r["spans"])


def test_passages_without_rows(spark):
    bench = spark.createDataFrame([], ITEMS)
    got = D.find_passages(awkward(spark), bench)
    assert got.count() == len(awkward_rows()) and not got.where("n_hit > 0 OR size(items) > 0").count()
    assert D.find_passages(empty(spark), bench).count() == 0
    assert D.remove_passages(empty(spark), bench).count() == 0


def test_automaton_lengths():
    """The longest run that ends at each word is a substring of an item, and the next longer one is not."""
    rng = random.Random(3)
    items = [[rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randrange(1, 25))] for _ in range(8)]
    automaton = D.Automaton([(str(i), w) for i, w in enumerate(items)], 4)
    spelled = [b" " + b" ".join(w) + b" " for w in items]
    holds = lambda w: any(b" " + b" ".join(w) + b" " in s for s in spelled)
    text = [rng.choice([b"a", b"b", b"c"]) for _ in range(300)]
    for end in range(1, 300):
        n = automaton.scan([automaton.words[w] for w in text[:end]], 0, [], set())
        assert n == max(j - i for i in range(end) for j in range(i + 1, min(end, i + 26) + 1) if holds(text[i:j]))
        if end > 40:
            break
    assert len(automaton.link) <= 2 * sum(map(len, items))


def test_passages_are_removed(spark):
    item = "The quick brown fox jumps over the lazy dog again today"
    docs = [(1, f"Before: {item.upper()}! After it, eight more words that stay here, {'and more ' * 5}."), (2, item + " end"), (3, None), (4, "Nothing here."),
            (5, f"{item} x y z " + "w " * 30 + item + ".")]
    df = spark.createDataFrame([(k, t, i) for i, (k, t) in enumerate(docs)], "doc_id int, text string, extra int")
    bench = spark.createDataFrame([(7, item)], "item_id int, text string")
    got = {r["doc_id"]: r["text"] for r in D.remove_passages(df, bench, coverage=0.6).collect()}
    assert got == {1: docs[0][1].replace(item.upper(), ""), 3: None, 4: "Nothing here.", 5: " x y z " + "w " * 30 + "."}
    assert D.remove_passages(df, bench, coverage=0.6, longest_kept=11).count() == 4
    assert D.remove_passages(df, bench, coverage=1.0, longest_kept=11).where("doc_id = 2").first()["text"] == docs[1][1]


def test_long_texts_in_pieces():
    rng = random.Random(8)
    text = " ".join(rng.choice(["alpha", "Béta", "c3", "x" * 50]) for _ in range(5000)).encode()
    cut = list(pieces(text, 300))
    assert b"".join(cut) == text.lower() and len(cut) > 100
    assert [w for p in cut for w in WORD.findall(p)] == WORD.findall(text.lower())
    assert list(pieces(b"y" * 5000, 300)) == [b"y" * 5000]
    texts = [text[:n] for n in (0, 10, 5000, 7, 0, 900)]
    assert b"".join(t for _, data, ends in joined(texts, 1000) for t in [data]).count(b"\0") == len(texts) - len(list(joined(texts, 1000)))


# ---------------------------------------------------------------- resampling


def plain_ranks(docs, items, longest, buckets, percent, least):
    def features(text):
        w = words(text)
        return len(w), [crc32(" ".join(w[i:i + n]).encode()) % buckets for n in range(1, longest + 1) for i in range(len(w) - n + 1)]

    raw, target = Counter(), Counter()
    for _, t in docs:
        raw.update(features(t)[1])
    for _, t in items:
        target.update(features(t)[1])
    s, t = sum(raw.values()), sum(target.values())
    gain = lambda b: math.floor(1000 * math.log((target[b] + 1) * (s + buckets) / ((raw[b] + 1) * (t + buckets))))
    rows = []
    for key, text in docs:
        n, found = features(text)
        weight = sum(map(gain, found)) // len(found) if found else 0
        h = int(sha256(f"2024:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        rows.append([key, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    drawn = sorted((r for r in rows if r[5] >= least), key=lambda r: (-r[3], r[0] is not None, r[0] or 0, r[5]))
    for rank, r in enumerate(drawn[:len(drawn) * percent // 100], 1):
        r[4] = rank
    return sorted((tuple(r[:5]) for r in rows), key=repr)


@pytest.mark.parametrize("longest,percent", [(1, 10), (3, 60), (2, 100), (1, 0)])
def test_importance_ranks(spark, sf, longest, percent):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()] + awkward_pairs() + awkward_pairs()
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()] + [(None, None)]
    df = spark.createDataFrame([(k, t, 1, "z") for k, t in docs], "doc_id bigint, text string, rank int, score string").repartition(4)
    bench = spark.createDataFrame([(*i, "s", 1) for i in items], ITEMS)
    got = R.importance_ranks(df, bench, longest=longest, buckets=500, percent=percent)
    got = sorted((tuple(r) for r in got.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=repr)
    assert got == plain_ranks(docs, items, longest, 500, percent, 20)


def test_resampled_documents(spark, sf):
    docs, items = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "benchmark"))
    ranks = R.importance_ranks(docs, items)
    drawn = R.resample(docs, items)
    assert drawn.columns == docs.columns
    want = ranks.where("rank IS NOT NULL").join(docs, "doc_id").select(docs.columns)
    assert sorted(map(tuple, drawn.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    assert R.importance_ranks(empty(spark), items).count() == 0
    assert R.importance_ranks(docs, items.limit(0)).where("rank IS NOT NULL").count() == drawn.count()
    # the draw leans towards the target
    weights = ranks.agg(F.avg(F.when(F.col("rank").isNotNull(), F.col("weight"))), F.avg("weight")).first()
    assert weights[0] > weights[1]


@pytest.mark.parametrize("longest", [1, 2, 4])
def test_features_of_long_texts(monkeypatch, longest):
    rng = random.Random(9)
    texts = [" ".join(rng.choice(["one", "two", "Drei", "4"]) for _ in range(n)).encode() for n in (0, 3, 4000, 1, 2, 900, 0)]
    want = [np.bincount(f, minlength=97).tolist() for t in texts for f, _, _ in [R.batch_features(t.lower(), np.array([len(t)]), longest, 97)]]
    monkeypatch.setattr(R, "PIECE", 500)
    monkeypatch.setattr(R, "joined", lambda texts: joined(texts, 500))
    monkeypatch.setattr(R, "pieces", lambda text: pieces(text, 500))
    got, n_words = np.zeros((len(texts), 97), dtype=int), 0
    for found, owner, count in R.text_features(texts, longest, 97):
        np.add.at(got, (owner, found), 1)
        n_words = n_words + count
    assert got.tolist() == want and n_words.tolist() == [len(t.split()) for t in texts]
