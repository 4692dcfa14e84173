"""Operator 9: n-gram Jaccard self-join with a MinHash LSH forest.

Texts are sets of five-word shingles (64-bit hashes).  Equal sets form one
class with a representative, so copies are never paired.  Representatives get
a MinHash signature cut into ``trees`` labels of ``longest`` values, and each
tree is a trie of the labels.  Documents are candidates if they stand in one
node.  The deepest node that counts is the one for which the chance to meet a
pair at the threshold in some tree reaches ``recall`` (5 of 8 values, 0.9915 at
0.8).  From there matched prefixes are shortened as far as the trie is thin:
each document stands in the highest node of its path, of at least ``SHORTEST``
values, that holds no more than ``THIN`` documents.  With 3 values a pair at 0.8
is met with a chance of 0.9999, so only pairs in crowded nodes keep the lower
one; in no node is it below ``recall``.  The other values serve the signatures'
comparison only.
Candidates whose signatures agree well enough are joined to candidate groups,
and all pairs of a group are verified exactly on their shingle sets.

Large trie nodes and large groups are cut into chunks, and every pair of
chunks is a cell of bounded size; a cell emits a spanning forest of its links
and each document's number of links, never the pairs.

Result: one row per doc_id: ``class_id`` (least doc_id of the documents
connected by links), ``n_links`` (other documents at the threshold or above,
copies included).

Defined results: words are runs of word characters, lower-cased; a text of one
to four words is one shingle; empty and wordless texts have no shingles and are
linked to equal texts only; a null text has no links and is its own class; rows
with a null doc_id give no row; rows that repeat a doc_id count once (the least
signature); other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from tessera.llm.common import grouped, python_ready, steps, tidy, written
from tessera.llm.graph import components

THRESHOLD, WORDS, TREES, LONGEST, RECALL = 0.8, 5, 12, 8, 0.99
#: Matched prefixes are shortened down to so many values, in nodes of at most so many documents.
SHORTEST, THIN = 3, 64
#: Members of one side of a cell: signatures are small, shingle sets larger.
SKETCHES, SETS = 512, 256
#: Share of equal signature values below which a candidate is given up: at the
#: threshold of 0.8 with 96 values this is over four standard deviations off.
SKETCH_SLACK = 0.18
_WORDS = re.compile(r"\w+")
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def depth(recall: float, trees: int, longest: int, threshold: float) -> int:
    """The longest prefix at which a pair at the threshold meets in some tree with the wanted chance."""
    for d in range(longest, 1, -1):
        if 1 - (1 - threshold ** d) ** trees >= recall:
            return d
    return 1


@lru_cache(maxsize=200_000)
def _word_hash(word: str) -> int:
    return int.from_bytes(hashlib.blake2b(word.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _SPREAD
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def shingles(text: str, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the text's word n-grams."""
    found = _WORDS.findall(text.lower())
    h = np.fromiter(map(_word_hash, found), dtype=np.uint64, count=len(found))
    if not len(h):
        return h
    k = min(words, len(h))
    out = np.zeros(len(h) - k + 1, dtype=np.uint64)
    for j in range(k):
        out = out * _SPREAD + h[j:len(h) - k + 1 + j]
    return np.unique(_mixed(out))


@lru_cache(maxsize=4)
def _permutations(n: int) -> tuple[np.ndarray, np.ndarray]:
    r = np.random.Generator(np.random.PCG64(20240607))
    return (r.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1),
            r.integers(0, 1 << 63, n, dtype=np.uint64))


def signature(sets: np.ndarray, n: int) -> np.ndarray:
    """The least of each of ``n`` permuted hashes of the set, a step of the set at a time."""
    a, b = _permutations(n)
    least = np.full(n, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(sets), 4096):
        x = sets[at:at + 4096]
        least = np.minimum(least, (a[:, None] * x[None, :] + b[:, None]).min(axis=1))
    return (least >> np.uint64(32)).astype(np.uint32)


def levels_of(d: int) -> list[int]:
    """Lengths of the prefixes that count, the shortest first."""
    return list(range(min(SHORTEST, d), d + 1))


def _prefixes(sig: np.ndarray, trees: int, longest: int, d: int) -> list[int]:
    """Of each tree in turn the hashes of its label's prefixes, the shortest first."""
    labels = sig.reshape(trees, longest)[:, :d].astype(np.uint64)
    out = np.zeros(trees, dtype=np.uint64)
    path = []
    for j in range(d):
        out = _mixed(out * _SPREAD + labels[:, j] + np.uint64(1))
        path.append(out)
    return np.stack(path[levels_of(d)[0] - 1:], axis=1).ravel().view(np.int64).tolist()


def _nodes(leaves: DataFrame, d: int) -> DataFrame:
    """doc_id, tree, prefix, size: each document's node in each tree, where it is not alone.

    ``leaves`` has a column ``path`` with the hashes of a label's prefixes, the
    shortest first.  A node's documents choose it together, as the choice
    depends on the sizes along their common path.
    """
    levels = levels_of(d)
    cols = [f"p{k}" for k in levels]
    at = leaves.select("doc_id", "tree", *[F.get("path", F.lit(n)).alias(c) for n, c in enumerate(cols)])
    sizes = at.groupBy("tree", *cols).agg(F.count("*").alias(f"n{d}"))
    for n in range(len(levels) - 1):  # upwards sums of the deepest nodes' counts
        sizes = sizes.withColumn(f"n{levels[n]}", F.sum(f"n{d}").over(Window.partitionBy("tree", *cols[:n + 1])))
    prefix, size = F.col(cols[-1]), F.col(f"n{d}")
    for k, c in reversed(list(zip(levels[:-1], cols[:-1]))):
        prefix, size = (F.when(F.col(f"n{k}") <= THIN, x).otherwise(y) for x, y in
                        ((F.col(c), prefix), (F.col(f"n{k}"), size)))
    chosen = sizes.select("tree", *cols, prefix.alias("prefix"), size.alias("size")).filter("size > 1")
    return at.join(chosen, ["tree", *cols]).select("doc_id", "tree", "prefix", "size")


def signatures(rows: DataFrame, words: int, trees: int, longest: int, d: int) -> DataFrame:
    """doc_id, h (digest of the shingle set, or of a wordless text), n (-1: null), sig, prefixes; one row per doc_id."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in steps(batches):
            out: dict[str, list] = {n: [] for n in ("h", "n", "sig", "prefixes")}
            for text in b.column(1).to_pylist():
                s = shingles(text or "", words)
                sig = signature(s, trees * longest)
                of, kind = (s.tobytes(), b"") if len(s) else ((text or "").encode("utf-8", "surrogatepass"), b"wordless")
                out["h"].append(hashlib.blake2b(of, digest_size=16, person=kind).digest())
                out["n"].append(-1 if text is None else len(s))
                out["sig"].append(sig.tobytes())
                out["prefixes"].append(_prefixes(sig, trees, longest, d) if len(s) else [])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(out["h"], pa.binary()), pa.array(out["n"], pa.int64()),
                 pa.array(out["sig"], pa.binary()), pa.array(out["prefixes"], pa.list_(pa.int64()))], schema.names)
        _word_hash.cache_clear()  # a worker serves other stages too

    schema = T.StructType([rows.schema["doc_id"], T.StructField("h", T.BinaryType()), T.StructField("n", T.LongType()),
                           T.StructField("sig", T.BinaryType()), T.StructField("prefixes", T.ArrayType(T.LongType()))])
    return (rows.mapInArrow(tidy(run), schema).groupBy("doc_id")
            .agg(F.min(F.struct("h", "n", "sig", "prefixes")).alias("s")).select("doc_id", "s.*"))


def _cells(members: DataFrame, key: list[str], size: str, most: int) -> DataFrame:
    """Members of groups cut into chunks of about ``most``, with a row for each pair of chunks they are in."""
    n = F.ceil(F.col(size) / most).cast("int")
    chunk = F.pmod(F.xxhash64("doc_id", *key), n).cast("int")
    return (members.withColumn("chunks", n).withColumn("chunk", chunk)
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
            .withColumn("i", F.least("chunk", "other")).withColumn("j", F.greatest("chunk", "other")))


class _Groups:
    """Labels of members joined by links, kept as the least position."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def link(self, row: int, others: np.ndarray) -> None:
        if len(others):
            found = np.unique(np.append(self.label[others], self.label[row]))
            if len(found) > 1:
                self.label[np.isin(self.label, found)] = found[0]


def _linked(chunk: np.ndarray, i: int, j: int, partners) -> _Groups:
    """Join each member with its partners: the later members, or in a mixed cell those of the other chunk."""
    groups = _Groups(len(chunk))
    other = np.flatnonzero(chunk == j)
    for r in np.flatnonzero(chunk == i).tolist():
        rest = other[other > r] if i == j else other
        if len(rest):
            groups.link(r, partners(r, rest))
    return groups


def _forest(ids: np.ndarray, groups: _Groups) -> list[tuple[int, int]]:
    on = np.flatnonzero(groups.label != np.arange(len(ids)))
    return list(zip(ids[on].tolist(), ids[groups.label[on]].tolist()))


def _sketch_cells(need: int):
    """Links by signature in each cell of (tree, prefix, i, j, doc_id, chunk, sig)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[int, int]] = []
        for (_, _, i, j), (*_, ids, chunk, sig) in grouped(batches, 4):
            if len(ids) < 2:
                continue
            sigs = np.frombuffer(b"".join(sig), dtype=np.uint32).reshape(len(ids), -1)
            agree = lambda r, rest: rest[np.count_nonzero(sigs[rest] == sigs[r], axis=1) >= need]  # noqa: E731, B023
            out += _forest(np.array(ids), _linked(np.array(chunk), i, j, agree))
        yield pa.RecordBatch.from_pydict({"a": pa.array([x for x, _ in out], pa.int64()),
                                          "b": pa.array([x for _, x in out], pa.int64())})

    return run


def _verified(ids, chunk, h, copies, texts, i: int, j: int, words: int, threshold: float):
    """(a, b, links) rows of one cell: its forest of exact links, and the links of each member."""
    rows: dict[int, tuple] = {}  # of rows that repeat an id the one that counts
    for d, c, digest, n, text in zip(ids, chunk, h, copies, texts):
        own = shingles(text, words)
        if d not in rows and hashlib.blake2b(own.tobytes(), digest_size=16).digest() == digest:
            rows[d] = c, n, own
    if len(rows) < 2:
        return []
    found = np.array(list(rows))
    chunk, copies, sets = (list(x) for x in zip(*rows.values()))
    copies, links = np.array(copies), np.zeros(len(rows), dtype=np.int64)
    sizes = np.array([len(s) for s in sets])
    _, word_of = np.unique(np.concatenate(sets), return_inverse=True)
    ends = np.cumsum(sizes)
    own = [word_of[e - n:e] for e, n in zip(ends, sizes)]
    here = np.zeros(word_of.max() + 1, dtype=np.int64)

    def partners(r: int, rest: np.ndarray) -> np.ndarray:
        low, high = np.minimum(sizes[rest], sizes[r]), np.maximum(sizes[rest], sizes[r])
        rest = rest[low >= threshold * high - 1e-9]
        if not len(rest):
            return rest
        here[own[r]] = 1
        at = np.concatenate([[0], np.cumsum(sizes[rest])[:-1]])
        both = np.add.reduceat(here[np.concatenate([own[x] for x in rest])], at)
        here[own[r]] = 0
        rest = rest[both >= threshold * (sizes[rest] + sizes[r] - both) - 1e-9]
        links[r] += copies[rest].sum()
        links[rest] += copies[r]
        return rest

    forest = _forest(found, _linked(np.array(chunk), i, j, partners))
    return [(a, b, 0) for a, b in forest] + [(d, d, n) for d, n in zip(found.tolist(), links.tolist()) if n]


def _set_cells(words: int, threshold: float):
    """Exact links in each cell of (group, i, j, doc_id, chunk, h, copies, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, i, j), (*_, ids, chunk, h, copies, texts) in grouped(batches, 3):
            if out := _verified(ids, chunk, h, copies, texts, i, j, words, threshold):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, pa.int64()) for x in zip(*out)], ["a", "b", "links"])
        _word_hash.cache_clear()

    return run


def near_groups(docs: DataFrame, threshold: float = THRESHOLD, words: int = WORDS, trees: int = TREES,
                longest: int = LONGEST, recall: float = RECALL, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """doc_id, class_id, n_links; doc_id must be an integer."""
    python_ready(docs.sparkSession)
    rows = docs.filter(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    d = depth(recall, trees, longest, threshold)
    signed = written(signatures(rows, words, trees, longest, d), "signatures")
    # classes of equal sets, and of equal wordless texts, which are never paired
    alike = signed.filter("n > 0")
    classes = written(signed.filter("n >= 0").groupBy("h")
                      .agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies")), "classes")
    reps = classes.select(F.col("rep").alias("doc_id"), "h", "copies")
    # the trees' nodes that at least two representatives share
    n = len(levels_of(d))
    paths = F.transform(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: F.slice("prefixes", t * n + 1, n))
    leaves = (alike.select("doc_id", "prefixes").join(reps.select("doc_id"), "doc_id")
              .select("doc_id", F.posexplode(paths).alias("tree", "path")))
    node = ["tree", "prefix"]
    met = _nodes(leaves, d).join(alike.select("doc_id", "sig"), "doc_id")
    need = int(np.ceil((threshold - SKETCH_SLACK) * trees * longest))
    cell = [*node, "i", "j"]
    candidates = (_cells(met, node, "size", SKETCHES).select(*cell, "doc_id", "chunk", "sig")
                  .repartition(*cell).sortWithinPartitions(*cell, "doc_id")
                  .mapInArrow(tidy(_sketch_cells(need)), "a long, b long"))
    groups = components(candidates).select(F.col("node").alias("doc_id"), F.col("component").alias("group"))
    sizes = groups.groupBy("group").agg(F.count("*").alias("size"))
    members = written(groups.join(sizes, "group").join(reps, "doc_id"), "candidates")
    # exact verification; the texts are shuffled at every size, as they are at scale, whatever the planner
    # would broadcast, so that small runs tell how large ones go
    texts = members.hint("merge").join(rows, "doc_id")
    cell = ["group", "i", "j"]
    verified = written(
        _cells(texts, ["group"], "size", SETS).select(*cell, "doc_id", "chunk", "h", "copies", "text")
        .repartition(*cell).sortWithinPartitions(*cell, "doc_id")
        .mapInArrow(tidy(_set_cells(words, threshold)), "a long, b long, links long"), "links")
    found = components(verified.select("a", "b")).select(F.col("node").alias("rep"), "component")
    links = verified.filter("links > 0").groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    of_class = (classes.join(found, "rep", "left").join(links, "rep", "left")
                .select("h", F.coalesce("component", "rep").alias("class_id"),
                        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    return (signed.filter("n >= 0").select("doc_id", "h").join(of_class, "h").select("doc_id", "class_id", "n_links")
            .unionByName(signed.filter("n < 0").select("doc_id", F.col("doc_id").alias("class_id"),
                                                       F.lit(0).cast("long").alias("n_links"))))
