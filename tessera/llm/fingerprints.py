"""Operator 6: document fingerprints by content-defined chunking.

A gear hash rolls over a text's UTF-8 bytes (a window of 32 bytes).  A chunk
ends where the hash's top bits are zero: a strict mask before the normal size,
a loose one after it (normalised chunking), never before the least and always
at the largest size.  A fingerprint is the set of its chunks' digests, each
with the chunk's length; an insertion changes only the chunks around it.
Likeness of A to B is containment: the share of A's length whose chunks B has.

Defined results: null text counts as empty; the empty text has the empty
fingerprint, which is wholly contained in any other (likeness 1), and no other
fingerprint is contained in it (0).  ``with_next`` orders rows by doc_id, ties
by text, null ids first; the last row's next is the first, a lone row's itself.
Repeated rows stay; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, functions as F, types as T

from tessera.llm.common import python_ready, steps, text_or_empty

LEAST, NORMAL, LARGEST = 16, 64, 256
#: One multiplier per byte value, by rule: the first four bytes of the value's BLAKE2b digest.
_GEAR = np.array([int.from_bytes(hashlib.blake2b(bytes([b]), digest_size=4).digest(), "big")
                  for b in range(256)], dtype=np.uint32)
_STRICT, _LOOSE = np.uint32(0xFF << 24), np.uint32(0xF << 28)


def gear_hash(data: bytes) -> np.ndarray:
    """The 32-byte rolling hash at each byte: sum of gear values, shifted left once per byte of age."""
    h = _GEAR[np.frombuffer(data, dtype=np.uint8)]
    for k in (1, 2, 4, 8, 16):  # the hash of 2k bytes from two of k bytes
        if len(h) > k:
            h[k:] = h[k:] + (h[:-k] << np.uint32(k))
    return h


def cut_points(data: bytes) -> list[int]:
    """Ends of the chunks of ``data``."""
    n, at, ends = len(data), 0, []
    if n > LEAST:
        h = gear_hash(data)
        strict = (np.flatnonzero((h & _STRICT) == 0) + 1).tolist()
        loose = (np.flatnonzero((h & _LOOSE) == 0) + 1).tolist()
        while n - at > LEAST:
            i = bisect_left(strict, at + LEAST)
            if i < len(strict) and strict[i] < at + NORMAL:
                at = strict[i]
            else:
                i = bisect_left(loose, at + NORMAL)
                at = min(n, at + LARGEST, loose[i] if i < len(loose) else n)
            ends.append(at)
    if at < n:
        ends.append(n)
    return ends


def chunk_set(text: str) -> frozenset[int]:
    """Chunks as 48 digest bits and 16 bits of length."""
    data, at, out = text.encode("utf-8", "surrogatepass"), 0, set()
    for end in cut_points(data):
        digest = hashlib.blake2b(data[at:end], digest_size=6).digest()
        out.add(int.from_bytes(digest, "big") << 16 | (end - at))
        at = end
    return frozenset(out)


def as_string(chunks: frozenset[int]) -> str:
    return base64.b64encode(np.array(sorted(chunks), dtype=">u8").tobytes()).decode()


def from_string(fingerprint: str) -> frozenset[int]:
    return frozenset(np.frombuffer(base64.b64decode(fingerprint), dtype=">u8").tolist())


def likeness(a: frozenset[int], b: frozenset[int]) -> float:
    """The share of ``a``'s length that is in ``b``."""
    if not a:
        return 1.0
    return sum(c & 0xFFFF for c in a & b) / sum(c & 0xFFFF for c in a)


def fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint of every whole text; no shuffle."""
    python_ready(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in steps(batches):
            prints = pa.array([as_string(chunk_set(t)) for t in b.column(1).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([b.column(0), prints], ["doc_id", "fingerprint"])

    schema = T.StructType([rows.schema["doc_id"], T.StructField("fingerprint", T.StringType())])
    return rows.mapInArrow(run, schema)


def next_to(rows: DataFrame) -> DataFrame:
    """``rows`` (doc_id integer, text) laid out so that each row's next one follows it in its partition.

    Rows go to ranges of doc_id (split points from approximate quantiles, a few
    per shuffle partition); every range also gets the first row of the range
    after it, marked ``ahead``.  One shuffle of the texts, no global window.
    """
    spark = rows.sparkSession
    n = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = F.coalesce(F.col("doc_id").cast("double"), F.lit(float("-inf")))
    cuts = rows.select(F.percentile_approx("doc_id", [i / n for i in range(1, n)], 20 * n).alias("q")).head()["q"]
    splits = [float("-inf"), *sorted({float(c) for c in cuts or []}), float("inf")]
    if len(splits) == 2:
        splits.insert(1, 0.0)
    ranged = (Bucketizer(splits=splits, inputCol="key", outputCol="range")
              .transform(rows.withColumn("key", key)).drop("key"))
    # at most n rows, one per range; null ids come first, as in the later sort
    first = F.min(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id")).alias("r")
    least = ranged.groupBy("range").agg(first).select("range", "r.doc_id").collect()
    order = sorted(r["range"] for r in least)
    before = dict(zip(order, order[-1:] + order[:-1]))
    kind = rows.schema["doc_id"].dataType
    firsts = spark.createDataFrame(
        [(r["range"], r["doc_id"], before[r["range"]]) for r in least],
        T.StructType([T.StructField("range", T.DoubleType()), T.StructField("doc_id", kind),
                      T.StructField("before", T.DoubleType())]))
    same = ranged["doc_id"].eqNullSafe(firsts["doc_id"]) & (ranged["range"] == firsts["range"])
    ahead = (ranged.join(F.broadcast(firsts), same).groupBy("before")
             .agg(F.min(F.struct(ranged["doc_id"], ranged["text"])).alias("r"))
             .select("r.doc_id", "r.text", F.col("before").alias("range"), F.lit(1).alias("ahead")))
    both = ranged.withColumn("ahead", F.lit(0)).unionByName(ahead)
    return (both.repartition(F.col("range"))
            .sortWithinPartitions("range", "ahead", F.col("doc_id").asc_nulls_first(), "text"))


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each text, of the text edited with its next one, and their likeness.

    The edited text is the text with its last floor(n/2) code points replaced
    by the first as many (or all) of the next row's text.
    """
    python_ready(docs.sparkSession)
    rows = next_to(docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text")))
    fields = [rows.schema["doc_id"], T.StructField("n_chars", T.LongType())]
    fields += [T.StructField(n, T.StringType()) for n in ("edited_sha256", "fingerprint", "edited_fingerprint")]
    fields += [T.StructField(n, T.DoubleType()) for n in ("near_edited", "near_next")]
    schema = T.StructType(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # the row whose next is awaited
        for b in steps(batches):
            ids, out = b.column(0), {n: [] for n in schema.names}
            kept_ids = []
            for i, (text, group, ahead) in enumerate(
                    zip(b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist())):
                own = chunk_set(text)
                if last is not None and last[0] == group:
                    _, last_id, last_text, last_own = last
                    half = len(last_text) // 2
                    edited = last_text[:len(last_text) - half] + text[:half]
                    changed = chunk_set(edited)
                    kept_ids.append(last_id)
                    out["n_chars"].append(len(last_text))
                    out["edited_sha256"].append(hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest())
                    out["fingerprint"].append(as_string(last_own))
                    out["edited_fingerprint"].append(as_string(changed))
                    out["near_edited"].append(likeness(last_own, changed))
                    out["near_next"].append(likeness(last_own, own))
                last = None if ahead else (group, ids[i].as_py(), text, own)
            out["doc_id"] = kept_ids
            yield pa.RecordBatch.from_pydict({n: pa.array(out[n], arrow_types[n]) for n in schema.names})

    from pyspark.sql.pandas.types import to_arrow_schema

    arrow_types = {f.name: f.type for f in to_arrow_schema(schema)}
    return rows.select("doc_id", "text", "range", "ahead").mapInArrow(run, schema)
