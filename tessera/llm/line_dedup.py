"""Operator 4: line deduplication with per-document keep bitmaps, in DataFrame functions only.

A line's key is the line stripped of ASCII white space, A-Z lower-cased; only
its 128-bit hash travels.  Hashes are range-partitioned on (hash, document)
and sorted with the documents descending and positions ascending, so a key
held by very many documents is cut over many tasks; each task streams the
first occurrence of every key in every document, and partial counts per key
meet in a second, small aggregate.  Keys of at least ``least_chars`` code
points in at least ``least_docs`` documents lose their lines except in the
largest doc_id.

The result is a bitmap per document that loses lines, compressed to the line
numbers at which it flips between keep and drop, starting with keep.

Defined results: null and empty texts are one empty line; rows with a null
doc_id keep every line and count for nothing; rows that repeat a doc_id count
as one document (bitmaps are told apart by the text's hash); other columns are
ignored by :func:`keep_bitmaps` and kept by :func:`kept`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tessera.llm.common import text_or_empty, written

_STRIPPED = " \t\n\x0b\x0c\r"


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _folded(key: Column) -> Column:
    """A form that two keys share exactly if they are equal but for the case of A-Z.

    The key's UTF-8 bytes are read as Latin-1 and lower-cased.  That also maps
    some lead bytes (C0-DE to E0-FE), but no two texts onto one: the number of
    continuation bytes, which stay, tells a two-byte from a longer character.
    """
    return F.lower(F.decode(F.encode(key, "UTF-8"), "ISO-8859-1"))


def _text_mark(text: str) -> Column:
    return F.xxhash64(text_or_empty(text))


def keep_bitmaps(docs: DataFrame, least_chars: int = 40, least_docs: int = 5, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """doc_id, mark (hash of the text), n_dropped, flips: for the documents that lose lines."""
    def hashed(line: Column, pos: Column) -> Column:
        key = F.btrim(line, F.lit(_STRIPPED))
        low = _folded(key)
        return F.when(F.length(key) >= least_chars, F.struct(
            pos.alias("pos"), F.xxhash64(F.lit(1), low).alias("h1"), F.xxhash64(F.lit(2), low).alias("h2")))

    long_lines = F.filter(F.transform(lines_of(F.col(text_col)), hashed), lambda x: x.isNotNull())
    lines = written(
        docs.filter(F.col(id_col).isNotNull())
        .select(F.col(id_col).alias("doc_id"), _text_mark(text_col).alias("mark"), F.explode(long_lines).alias("l"))
        .select("doc_id", "mark", "l.*"), "line-hashes")
    # the range partitioning holds each (hash, document) together, so this aggregate needs no further shuffle
    first = (lines.repartitionByRange("h1", "h2", "doc_id")
             .sortWithinPartitions("h1", "h2", F.desc("doc_id"), "pos")
             .groupBy("h1", "h2", "doc_id").agg(F.min("pos").alias("first")))
    repeated = written(first.groupBy("h1", "h2").agg(F.count("*").alias("docs"), F.max("doc_id").alias("owner"))
                       .filter(F.col("docs") >= least_docs).drop("docs"), "repeated-lines")
    dropped = (lines.join(repeated, ["h1", "h2"]).filter("doc_id < owner")
               .groupBy("doc_id", "mark").agg(F.sort_array(F.collect_set("pos")).alias("p")))
    after = F.transform("p", lambda x: x + 1)
    return dropped.select("doc_id", "mark", F.size("p").cast("long").alias("n_dropped"), F.array_sort(
        F.concat(F.array_except("p", after), F.array_except(after, F.col("p")))).alias("flips"))


def kept(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """row (all columns of ``docs`` in a struct), n_lines, n_dropped, kept: bitmaps applied to texts."""
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("doc_id"), _text_mark(text_col).alias("mark"))
    lines = lines_of(F.col("row")[text_col])
    n = F.size("lines")
    ends = F.concat(F.array(F.lit(0)), F.col("flips"), F.array(n))
    pieces = F.transform(F.sequence(F.lit(0), (F.size("flips") / 2).cast("int")), lambda k: F.slice(
        F.col("lines"), F.get(F.col("ends"), 2 * k) + 1, F.get(F.col("ends"), 2 * k + 1) - F.get(F.col("ends"), 2 * k)))
    cut = (rows.join(bitmaps, ["doc_id", "mark"], "left").withColumn("lines", lines).withColumn("ends", ends))
    return cut.select(
        "row", n.cast("long").alias("n_lines"), F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("flips").isNull(), F.coalesce(F.col("row")[text_col], F.lit("")))
        .otherwise(F.array_join(F.flatten(pieces), "\n")).alias("kept"))
