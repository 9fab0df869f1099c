"""The corpus pipeline against plain versions of its stages."""

import public_tokenizers
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from otelier.llm.pii import find_entities
from tests.llm.brute import SCHEMA, awkward, kept_lines, similar


def test_stages_against_plain_versions(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    stage = dict(corpus_pipeline.STAGES)
    good = stage["quality classifier"](spark, docs, sf).cache()
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = sorted((r["doc_id"], r["text"]) for r in good.collect())
    assert good.columns == docs.columns and 0 < len(rows) < docs.count()
    assert not [i for i, _ in rows if labels.get(i) == 0]
    assert {i for i, q in labels.items() if q == 1} <= {i for i, _ in rows}

    lines = stage["line dedup"](spark, good, sf)
    rows = sorted((i, t) for i, _, _, t in kept_lines(rows))
    assert lines.columns == docs.columns
    assert sorted((r["doc_id"], r["text"]) for r in lines.collect()) == rows

    groups = similar(rows, 5, 80)
    distinct = stage["n-gram Jaccard join"](spark, lines, sf)
    rows = [(i, t) for (i, t), (_, _, c) in zip(rows, groups) if i == c]
    assert distinct.columns == docs.columns
    assert sorted((r["doc_id"], r["text"]) for r in distinct.collect()) == rows

    private = stage["PII"](spark, distinct, sf)
    assert private.columns == docs.columns
    after = {r["doc_id"]: r["text"] for r in private.collect()}
    for i, t in rows:
        found = find_entities(t)
        assert (after[i] == t) == (not found)
        new = {(k, v) for _, _, k, v in find_entities(after[i])}
        assert not {(k, v) for _, _, k, v in found} & new

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {i: len(library.encode(t, add_special_tokens=False).ids) + 1 for i, t in after.items()}
    packed = corpus_pipeline.run(spark, sf).collect()
    got = {}
    for r in packed:
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + r["length"]
    assert got == want
    good.unpersist()


def test_stages_on_awkward_and_empty_tables(spark, sf):
    docs = awkward(spark).select("doc_id", "text", "lang", "source", "n_chars")
    for table in (docs, docs.limit(0), spark.createDataFrame([], SCHEMA).select(docs.columns)):
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, table, sf)
            out.collect()
    kept = dict(corpus_pipeline.STAGES)["n-gram Jaccard join"](spark, docs, sf)
    # equal rows stay once; rows without an id stay
    assert kept.where("doc_id = 6").count() == 1 and kept.where("doc_id IS NULL").count() == 1


def test_texts_that_share_an_id(spark, sf):
    """A unique text stays though another one under its id is a copy; of two similar texts under one id one stays."""
    text = lambda seed: " ".join(f"word{seed}x{i}" for i in range(40))
    rows = [(1, text(1)), (2, text(1)), (2, text(2)), (3, text(3)), (3, text(3) + " more"), (4, text(2) + " end"), (4, ""), (5, ""), (5, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    kept = dict(corpus_pipeline.STAGES)["n-gram Jaccard join"](spark, docs, sf)
    got = sorted((r["doc_id"], r["text"]) for r in kept.where("text IS NOT NULL").collect())
    threes = [t for i, t in got if i == 3]
    assert [r for r in got if r[0] != 3] == [(1, text(1)), (2, text(2)), (4, ""), (5, "")] and len(threes) == 1


def test_every_operator_has_a_query():
    names = entry.queries()
    assert {f"op{n}" for n in range(1, 14)} == {k.split("_")[0] for k in names if k.startswith("op")}
    assert "pipeline" in names
