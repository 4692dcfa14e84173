"""Operator 1: token counts by overlap resynchronisation.

Texts of at most ``chunk_chars`` code points are counted where they lie.  A
longer text is cut into overlapping chunks, one row each, which are dealt over
the cluster and encoded with offsets.  Two neighbouring chunks are spliced at
the first token start that both encodings have inside their overlap and that
follows a space or a line feed.  Such a boundary is proven stable: the
tokenizer drops white space before it splits, no merge or special token spans
it and no normalisation reaches across it, so what stands left and right of it
is encoded independently.  Texts with a seam that has no such boundary go
round again with chunks and overlaps four times as wide, at last as a whole.

Defined results: null text counts as empty (0 bytes, 0 tokens); a null doc_id
is kept; repeated rows give repeated rows; columns other than the id and the
text are ignored, whatever their names.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tessera.llm.common import file_bytes, python_ready, steps, text_or_empty, written

#: Distinct space-free segments whose counts a worker remembers; emptied when full.
SEGMENTS_KEPT = 400_000
_WIDEN = 4


@lru_cache(maxsize=2)
def _json_tokenizer(data: bytes):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tok = Tokenizer.from_buffer(data)
    tok.no_truncation()
    tok.no_padding()
    return tok


@lru_cache(maxsize=2)
def _piece_tokenizer(data: bytes):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=data)


def splits_at_spaces(data: bytes) -> bool:
    """Does this tokenizer drop spaces before it splits, so that they are stable boundaries?"""
    tok = _json_tokenizer(data)
    if tok.pre_tokenizer is None:
        return False
    e = tok.encode("ab cd\nef", add_special_tokens=False)
    apart = sum((tok.encode(x, add_special_tokens=False).ids for x in ("ab", "cd", "ef")), [])
    return e.ids == apart and not any(a <= at < b for a, b in e.offsets for at in (2, 5))


class _SegmentCounter:
    """Counts of texts as sums over their space-free segments, each encoded by the library once."""

    def __init__(self, data: bytes):
        self.tok = _json_tokenizer(data)
        self.known: dict[str, int] = {"": 0}

    def __call__(self, texts: list[str]) -> list[int]:
        parts = [t.replace("\n", " ").split(" ") for t in texts]
        new = list({p for ps in parts for p in ps if p not in self.known})
        if len(self.known) + len(new) > SEGMENTS_KEPT:
            self.known = {"": 0}
            new = list({p for ps in parts for p in ps if p})
        if new:
            encoded = self.tok.encode_batch_fast(new, add_special_tokens=False)
            self.known.update(zip(new, map(len, encoded)))
        get = self.known.__getitem__
        return [sum(map(get, ps)) for ps in parts]


@lru_cache(maxsize=2)
def _counter(data: bytes, kind: str, segments: bool):
    if kind == "model":
        sp = _piece_tokenizer(data)
        return lambda texts: [len(x) for x in sp.encode(texts, num_threads=1)]
    if segments:
        return _SegmentCounter(data)
    tok = _json_tokenizer(data)
    return lambda texts: [len(x) for x in tok.encode_batch_fast(texts, add_special_tokens=False)]


def _cut(chunk: int, overlap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in steps(batches):
            for key, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                starts = list(range(0, len(text), chunk))
                for at in range(0, len(starts), 64):
                    own = starts[at:at + 64]
                    yield pa.RecordBatch.from_pydict({
                        "key": pa.array([key] * len(own), pa.string()),
                        "chunk": pa.array([s // chunk for s in own], pa.int64()),
                        "last": pa.array([s == starts[-1] for s in own], pa.bool_()),
                        "piece": pa.array([text[s:s + chunk + overlap] for s in own], pa.string()),
                    })

    return run


def _encode_chunks(data, chunk: int, overlap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = _json_tokenizer(data.value)
        for b in steps(batches):
            out: dict[str, list] = {n: [] for n in _ENCODED.names}
            for key, k, last, piece in zip(*(b.column(i).to_pylist() for i in range(4))):
                starts = [s for s, _ in tok.encode(piece, add_special_tokens=False).offsets]
                stable = [(s, i) for i, s in enumerate(starts)
                          if s and piece[s - 1] in " \n" and starts[i - 1] != s]
                head = [(s, i) for s, i in stable if s < overlap] if k else []
                tail = [] if last else [(s, i) for s, i in stable if s >= chunk]
                row = (key, k, last, len(starts), [k * chunk + s for s, _ in head], [i for _, i in head],
                       [k * chunk + s for s, _ in tail], [i for _, i in tail])
                for n, v in zip(_ENCODED.names, row):
                    out[n].append(v)
            yield pa.RecordBatch.from_pydict(out, schema=_ENCODED_ARROW)

    return run


_ENCODED = T.StructType(
    [T.StructField("key", T.StringType()), T.StructField("chunk", T.LongType()),
     T.StructField("last", T.BooleanType()), T.StructField("n", T.LongType())]
    + [T.StructField(n, T.ArrayType(T.LongType())) for n in ("head_at", "head_i", "tail_at", "tail_i")])
_ENCODED_ARROW = pa.schema([
    ("key", pa.string()), ("chunk", pa.int64()), ("last", pa.bool_()), ("n", pa.int64()),
    *((n, pa.list_(pa.int64())) for n in ("head_at", "head_i", "tail_at", "tail_i"))])


def splice(encoded: DataFrame) -> DataFrame:
    """key, n_tokens, aligned: the chunks of each text joined at their seams."""
    right = encoded.select("key", (F.col("chunk") - 1).alias("chunk"), F.col("head_at").alias("r_at"),
                           F.col("head_i").alias("r_i"))
    seam = F.try_element_at(F.array_intersect("tail_at", "r_at"), F.lit(1))
    index = lambda at, i: F.element_at(i, F.array_position(F.col(at), F.col("seam")).cast("int"))
    own = (encoded.join(right, ["key", "chunk"], "left")
           .withColumn("seam", F.when(~F.col("last"), seam))
           .withColumn("part", F.when(F.col("last"), F.col("n"))
                       .when(F.col("seam").isNotNull(), index("tail_at", "tail_i") - index("r_at", "r_i"))))
    return own.groupBy("key").agg(F.sum("part").alias("n_tokens"),
                                  (F.count("part") == F.count("*")).alias("aligned"))


def count_tokens(docs: DataFrame, tokenizer: str, chunk_chars: int = 32_768,
                 overlap_chars: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens of every whole text.

    ``tokenizer``: path of a ``.json`` (tokenizers) or ``.model``
    (sentencepiece) file.  Texts are cut only for tokenizers that drop spaces
    (see :func:`splits_at_spaces`); for others every text is encoded whole.
    """
    spark = docs.sparkSession
    python_ready(spark)
    data = file_bytes(tokenizer)
    kind = tokenizer.rsplit(".", 1)[-1]
    stable = kind == "json" and splits_at_spaces(data)
    sent = spark.sparkContext.broadcast(data)
    rows = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    n_chars = F.length("text")
    bytes_of = F.octet_length("text").cast("long").alias("n_bytes")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(sent.value, kind, stable)
        for b in steps(batches):
            n = pa.array(counter(b.column(2).to_pylist()), pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), n], ["doc_id", "n_bytes", "n_tokens"])

    schema = T.StructType([T.StructField("doc_id", rows.schema["doc_id"].dataType),
                           T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])
    short = rows.filter(n_chars <= chunk_chars) if stable else rows
    short = short.select("doc_id", bytes_of, "text").mapInArrow(count, schema)
    if not stable:
        return short

    long = rows.filter(n_chars > chunk_chars).select("doc_id", bytes_of, "text",
                                                      F.sha2("text", 256).alias("key"), n_chars.alias("chars"))
    todo, counts, chunk, overlap = long.select("key", "text"), None, chunk_chars, overlap_chars
    while True:
        pieces = todo.mapInArrow(_cut(chunk, overlap), "key string, chunk long, last boolean, piece string")
        encoded = (pieces.repartition("key", "chunk").mapInArrow(_encode_chunks(sent, chunk, overlap), _ENCODED)
                   .dropDuplicates(["key", "chunk"]))
        done = written(splice(written(encoded, "token-chunks")), "token-splices")
        good = done.filter("aligned").select("key", "n_tokens")
        counts = good if counts is None else counts.unionByName(good)
        failed = done.filter(~F.col("aligned")).select("key")
        if failed.isEmpty():
            break
        chunk, overlap = chunk * _WIDEN, overlap * _WIDEN
        todo = long.select("key", "text").join(failed, "key", "left_semi")
    return short.unionByName(long.join(counts, "key").select("doc_id", "n_bytes", "n_tokens"))
