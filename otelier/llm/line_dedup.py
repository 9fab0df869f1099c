"""Exact line deduplication: a line that several documents hold stays in the one with the smallest id.

Lines are hashed to 128 bits and dealt by hash range; within a range they are sorted by hash, document and position, so
the first occurrence of a line streams by before its copies. A line in very many documents would fill one range, so
each hash has `SLICES` sub-ranges by document: every slice finds its first document, then the few firsts of a hash
are compared. What comes back per document is a bitmap with one bit per line, not text.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window, functions as F

from otelier.llm.staging import staged

#: Fixed values: [\x20\x09-\x0D].
BLANKS = " \t\n\x0b\x0c\r"
MIN_LENGTH = 10
SLICES = 16


def lower_ascii(text: Column) -> Column:
    """A-Z to lower case, nothing else. The built-in lower() does the same, faster, where all characters are ASCII."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def line_key(line: Column) -> Column:
    return lower_ascii(F.btrim(line, F.lit(BLANKS)))


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_drops(docs: DataFrame, text: str = "text", key: str = "doc_id", min_length: int = MIN_LENGTH) -> DataFrame:
    """(key, body, drop_bits, n_dropped) for each document that loses lines; bit i % 64 of word i / 64 says that line i
    goes. The array ends at the last such word. `body` is the hash of the text, so that rows which share a key but not
    their text keep apart."""
    source = docs.select(F.col(key).alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("t")).where("doc IS NOT NULL")
    lines = source.select("doc", F.xxhash64("t").alias("body"), F.posexplode(lines_of(F.col("t"))).alias("pos", "line"))
    lines = lines.select("doc", "body", "pos", line_key(F.col("line")).alias("k")).where(F.length("k") >= min_length)
    lines = staged(lines.select(
        F.xxhash64("k").alias("h1"), F.xxhash64(F.lit(1), "k").alias("h2"),
        F.pmod(F.xxhash64("doc"), F.lit(SLICES)).cast("int").alias("slice"), "doc", "pos", "body"), "lines")

    order = ["h1", "h2", "slice", "doc", "pos"]
    stream = Window.partitionBy("h1", "h2", "slice").orderBy("doc", "pos")
    ranged = lines.repartitionByRange("h1", "h2", "slice").sortWithinPartitions(*order)
    seen = staged(ranged.withColumns({
        "first_doc": F.first("doc").over(stream), "n": F.row_number().over(stream)}), "lines-seen")

    # one row per slice and hash from here on: slices whose first document isn't the first of the hash
    firsts = seen.where("n = 1").select("h1", "h2", "slice", "first_doc")
    late = firsts.withColumn("least", F.min("first_doc").over(Window.partitionBy("h1", "h2"))).where("first_doc > least")
    copies = seen.where("doc > first_doc").select("doc", "body", "pos")
    late_lines = seen.where("doc = first_doc").join(late.select("h1", "h2", "slice"), ["h1", "h2", "slice"], "left_semi")
    dropped = copies.unionAll(late_lines.select("doc", "body", "pos")).select(
        "doc", "body", F.expr("pos div 64").cast("int").alias("word"),
        F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("pos") % 64).alias("bit"))

    words = dropped.groupBy("doc", "body", "word").agg(F.bit_or("bit").alias("bits"))
    listed = words.groupBy("doc", "body").agg(
        F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("words"), F.sum(F.bit_count("bits")).alias("n_dropped"))
    # zeros for the words between two that hold dropped lines
    dense = F.flatten(F.transform("words", lambda w, i: F.concat(
        F.array_repeat(F.lit(0).cast("bigint"),
                       w["word"] - F.when(i > 0, F.col("words")[i - 1]["word"]).otherwise(-1) - 1),
        F.array(w["bits"]))))
    return listed.select(F.col("doc").alias(key), "body", dense.alias("drop_bits"), F.col("n_dropped").cast("bigint").alias("n_dropped"))


def dedup_lines(docs: DataFrame, text: str = "text", key: str = "doc_id", min_length: int = MIN_LENGTH) -> DataFrame:
    """`docs` with `text` cut to the lines that stay, plus n_lines (before), n_dropped and drop_bits.

    A line's key is the line without blanks at its ends and with A-Z in lower case; keys shorter than `min_length` code
    points always stay, as do all lines of rows with a null key. Null text is one empty line and becomes empty text.
    A row repeated as a whole keeps the same lines each time; within one document a kept line may repeat. Other columns
    pass through unless they are named n_lines, n_dropped, drop_bits or body, which are replaced. An empty
    table gives an empty one.
    """
    drops = line_drops(docs, text, key, min_length).select(
        F.col(key).alias("__doc"), F.col("body").alias("__body"), F.col("drop_bits").alias("__bits"), F.col("n_dropped").alias("__n"))
    rows = docs.drop("n_lines", "n_dropped", "drop_bits", "body").withColumn(text, F.coalesce(F.col(text), F.lit("")))
    joined = rows.join(drops, (F.col(key) == F.col("__doc")) & (F.xxhash64(text) == F.col("__body")), "left")
    bit = lambda i: F.getbit(F.get("__bits", F.floor(i / 64).cast("int")), i % 64)
    kept = F.array_join(F.filter(lines_of(F.col(text)), lambda line, i: F.coalesce(bit(i), F.lit(0)) == 0), "\n")
    return joined.select(
        *[F.when(F.col("__bits").isNull(), F.col(text)).otherwise(kept).alias(c) if c == text else F.col(c) for c in rows.columns],
        F.size(lines_of(F.col(text))).cast("bigint").alias("n_lines"), F.coalesce("__n", F.lit(0)).cast("bigint").alias("n_dropped"),
        F.coalesce("__bits", F.array().cast("array<bigint>")).alias("drop_bits"))


ORACLE = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keys AS (
  SELECT *, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines),
firsts AS (SELECT k, min(doc_id) AS least FROM keys WHERE length(k) >= 10 GROUP BY k),
decided AS (
  SELECT keys.*, coalesce(doc_id > least, false) AS gone FROM keys LEFT JOIN firsts ON keys.k = firsts.k)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM decided GROUP BY doc_id
"""
