"""Operator 5: toxicity by nearest labelled examples under exact TF-IDF cosine.

Terms are a text's words (and, if the weighting says so, their leading
letters).  The classifier is fitted on a bounded sample of labelled rows
(``max_examples``, the smallest hashes of the id).  Every term of the examples
has its own weight, see :class:`Weighting`: ``PLAIN`` is how often it stands in
the text times the logarithm of how rare it is; ``MARKED`` dampens both and
multiplies what marks toxic examples surely, so that a long text's few insults
are not lost among its plain words.  Document frequencies come from all
documents, and no term is left out.  Terms that no example holds would only
scale all cosines of a text alike, which changes neither neighbours nor votes,
so a text's norm is taken over the terms that examples hold.

Examples lie in an inverted index: postings for the rarer terms, and for the
most common ones a matrix of weights with the largest weight in each block of
examples.  A text's postings give each example a part of its cosine; the best
parts are completed by the common terms, and the kth of those cosines is a bar
that every other example's part plus its block's largest common weights must
reach to be completed, too.  So the neighbours are exact; all ties with the kth
take part.  The votes, weighted by cosine, are made
probabilities by an isotonic fit to the examples' own leave-one-out votes.

Labels come only from rows whose crc32(id as text) mod 5 is not 0.

Defined results: texts without a term of the examples (null and empty ones too)
meet no example and score the share of toxic examples (at most 0.49); with no
labelled rows, or of one class only, all score 0; null ids are held out of
training (held_out null -> false); repeated label rows of an id count once, as
toxic if any is; repeated documents give a row each; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tessera.llm.common import python_ready, steps, text_or_empty, tidy, written

MAX_EXAMPLES, NEIGHBOURS, BLOCK = 8_192, 15, 16
#: So many of the most common terms have block maxima instead of postings.
COMMON = 512
#: Examples completed to find the bar.
SEEDS = 24
_LEADS = (4, 5)
_WORDS = re.compile(r"\w+")
#: Words looked up together, and code points of a text searched at once.
WORDS_AT_ONCE, CHARS_AT_ONCE = 200_000, 1 << 20
_GAP = re.compile(r"\W")


def held_out(id_col: str = "doc_id") -> Column:
    """crc32 of the id as text is divisible by 5."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def _pieces(text: str) -> Iterator[str]:
    """The text in pieces that cut no word."""
    at = 0
    while len(text) - at > CHARS_AT_ONCE:
        gap = _GAP.search(text, at + CHARS_AT_ONCE)
        to = gap.end() if gap else len(text)
        yield text[at:to]
        at = to
    yield text[at:]


@dataclass(frozen=True)
class Weighting:
    """What a term weighs in a text that holds it n times.

    n, or 1 + ln n with ``log_counts``; times the logarithm of its rarity to
    the power ``rarity``; times the odds by which it marks toxic examples, if
    ``sure`` is given: their ratio less ``sure`` standard errors, at least 1,
    to the power ``sharp``.
    """

    leads: tuple[int, ...] = _LEADS
    log_counts: bool = False
    rarity: float = 1.0
    sure: float | None = None
    sharp: float = 1.0

    def factor(self, n_docs: int, frequency: np.ndarray, toxic: np.ndarray, clean: np.ndarray,
               n_toxic: int, n_clean: int) -> np.ndarray:
        """Per term; frequency in all documents, toxic and clean examples that hold it, and their numbers."""
        out = np.log((1 + n_docs) / (1 + frequency)) ** self.rarity
        if self.sure is not None:
            share = n_toxic / (n_toxic + n_clean)  # one example's worth of doubt, split as the classes are
            a, b = toxic + share, clean + 1 - share
            odds = np.log(a / (n_toxic + 2 * share - a)) - np.log(b / (n_clean + 2 * (1 - share) - b))
            out = out * np.maximum(1.0, np.exp(self.sharp * (odds - self.sure * np.sqrt(1 / a + 1 / b))))
        return out


PLAIN = Weighting()
MARKED = Weighting(leads=(), log_counts=True, rarity=2.0, sure=3.0, sharp=2.0)


def terms_of(word: str, leads: tuple[int, ...] = _LEADS) -> list[str]:
    return [word, *("^" + word[:k] for k in leads if len(word) > k)]


class Vocabulary:
    """The terms of the examples, by number, with their weights."""

    def __init__(self, terms: list[str], weighting: Weighting = PLAIN, factor: np.ndarray | None = None):
        self.words, self.leads = {}, [(k, {}) for k in weighting.leads]
        leads = dict(self.leads)
        for i, t in enumerate(terms):
            if t[0] == "^":
                leads[len(t) - 1][t[1:]] = i
            else:
                self.words[t] = i
        self.weighting, self.factor = weighting, factor

    def counts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(how many different terms each text holds, the terms of one text after the other, how often they stand there)."""
        most = 1 + len(self.words) + sum(len(leads) for _, leads in self.leads)
        codes, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        found: list[str] = []
        sizes: list[tuple[int, int]] = []

        def add() -> None:
            words = pa.array(found, pa.string()).dictionary_encode()
            text_of = np.repeat(*(np.array(x, dtype=np.int64) for x in zip(*sizes))) * most
            at, distinct = words.indices.to_numpy(), words.dictionary.to_pylist()
            known = [[self.words.get(w, -1) for w in distinct]]
            known += [[leads.get(w[:k], -1) if len(w) > k else -1 for w in distinct] for k, leads in self.leads]
            for terms in known:
                term = np.array(terms, dtype=np.int64)[at]
                code, n = np.unique((text_of + term)[term >= 0], return_counts=True)
                codes.append(code)
                counts.append(n)
            found.clear()
            sizes.clear()

        for k, text in enumerate(texts):
            for piece in _pieces(text.lower()):
                own = _WORDS.findall(piece)
                found += own
                sizes.append((k, len(own)))
                if len(found) > WORDS_AT_ONCE:
                    add()
        if found:
            add()
        code, place = np.unique(np.concatenate(codes), return_inverse=True)
        n = np.bincount(place, np.concatenate(counts), len(code))
        return np.bincount(code // most, minlength=len(texts)), (code % most).astype(np.int32), n.astype(np.int32)

    def weighted(self, t: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        w = (1 + np.log(n) if self.weighting.log_counts else n) * self.factor[t]
        t, w = t[w > 0], w[w > 0]
        return t, w / np.sqrt((w * w).sum()) if len(w) else w


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All places of the ranges, one range after the other."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))


class BlockMaxIndex:
    """Examples by term, in blocks with the largest weight each common term has in them."""

    def __init__(self, ids: list, labels: list[int], vectors: list[tuple[np.ndarray, np.ndarray]]):
        # like examples lie together: ordered by their heaviest term, so that block maxima are tight
        heaviest = [(int(t[w.argmax()]), float(w.max())) if len(t) else (-1, 0.0) for t, w in vectors]
        order = sorted(range(len(ids)), key=lambda i: (heaviest[i], ids[i]))
        self.ids = [ids[i] for i in order]
        self.labels = np.array([labels[i] for i in order], dtype=float)
        sizes = np.array([len(vectors[i][0]) for i in order])
        self.begin = np.concatenate([[0], np.cumsum(sizes)])
        # of each example its terms and weights, in the order of the terms
        self.terms, self.weights = np.empty(self.begin[-1], np.int32), np.empty(self.begin[-1])
        for at, i in enumerate(order):
            t, w = vectors[i]
            by = np.argsort(t)
            self.terms[self.begin[at]:self.begin[at + 1]], self.weights[self.begin[at]:self.begin[at + 1]] = t[by], w[by]
        held = np.bincount(self.terms, minlength=1)
        common = np.argsort(-held, kind="stable")[:COMMON]
        self.column = np.full(len(held), -1, np.int32)  # of a common term
        self.column[common] = np.arange(len(common))

    @cached_property
    def matrix(self) -> np.ndarray:
        """Weights of the common terms, a row for each example, in whole blocks."""
        out = np.zeros((-(-len(self.ids) // BLOCK) * BLOCK, int(self.column.max(initial=-1)) + 1))
        column = self.column[self.terms]
        row = np.repeat(np.arange(len(self.ids)), np.diff(self.begin))
        out[row[column >= 0], column[column >= 0]] = self.weights[column >= 0]
        return out

    @cached_property
    def maxima(self) -> np.ndarray:
        """Largest weight of each common term in each block, read by term."""
        return np.asfortranarray(self.matrix.reshape(-1, BLOCK, self.matrix.shape[1]).max(axis=1))

    @cached_property
    def postings(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where each term's postings start; their examples and weights (none for common terms)."""
        rare = np.flatnonzero(self.column[self.terms] < 0).astype(np.int32)
        rare = rare[np.argsort(self.terms[rare], kind="stable")]
        starts = np.concatenate([[0], np.cumsum(np.bincount(self.terms[rare], minlength=len(self.column)))])
        return starts, (np.searchsorted(self.begin, rare, side="right") - 1).astype(np.int32), self.weights[rare]

    def nearest(self, t: np.ndarray, w: np.ndarray, k: int, leave=None) -> tuple[np.ndarray, np.ndarray]:
        """Examples with the k best cosines above 0 (all ties), and the cosines."""
        return self.nearest_of([(t, w)], k, [leave])[0]

    def nearest_of(self, queries: list[tuple[np.ndarray, np.ndarray]], k: int,
                   leave: list | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
        """``nearest`` of each query."""
        return [self._nearest(t[t < len(self.column)], w[t < len(self.column)], k, leave[q] if leave else None)
                for q, (t, w) in enumerate(queries)]

    def _nearest(self, t: np.ndarray, w: np.ndarray, k: int, leave) -> tuple[np.ndarray, np.ndarray]:
        column = self.column[t]
        columns, common = column[column >= 0], w[column >= 0]
        part = self._parts(t[column < 0], w[column < 0])
        # the most that the common terms can add, per block (einsum: one thread, whatever BLAS is set to)
        most = np.einsum("i,ij->j", common, self.maxima.T[columns])

        def completed(rows: np.ndarray) -> np.ndarray:
            cosines = part[rows] + np.einsum("ij,j->i", self.matrix[rows[:, None], columns], common)
            if leave is not None:
                cosines[rows == leave] = 0
            return cosines

        tried = np.sort(completed(self._seeds(part, k)))
        bar = tried[-k] if len(tried) >= k else 0.0  # the kth cosine is at least this
        reach = (part.reshape(-1, BLOCK) + most[:, None]).ravel()[:len(self.ids)]
        rows = np.flatnonzero(reach >= bar - 1e-9)
        cosines = completed(rows)
        kth = np.partition(cosines, len(cosines) - k)[len(cosines) - k] if len(cosines) >= k else 0.0
        best = (cosines >= kth - 1e-12) & (cosines > 0)
        return rows[best], cosines[best]

    def _parts(self, t: np.ndarray, w: np.ndarray) -> np.ndarray:
        """What terms with postings add to the cosine of each example, in whole blocks."""
        starts, examples, weights = self.postings
        sizes = starts[t + 1] - starts[t]
        at = _ranges(starts[t], sizes)
        return np.bincount(examples[at], np.repeat(w, sizes) * weights[at], len(self.matrix))

    def _seeds(self, part: np.ndarray, k: int) -> np.ndarray:
        """Some examples with large parts: the best of the best blocks (one more than k, as one may be left out)."""
        best = part.reshape(-1, BLOCK).max(axis=1)
        most = max(SEEDS, k + 1)
        blocks = np.argpartition(best, len(best) - most)[len(best) - most:] if len(best) > most else np.arange(len(best))
        rows = (blocks[:, None] * BLOCK + np.arange(BLOCK)).ravel()
        rows = rows[rows < len(self.ids)]
        return rows[np.argpartition(-part[rows], most)[:most]] if len(rows) > most else rows


class Scorer:
    """Weighted votes of the nearest examples, calibrated."""

    def __init__(self, vocabulary: Vocabulary, index: BlockMaxIndex):
        self.vocabulary, self.index = vocabulary, index

    def votes(self, texts: list[tuple[np.ndarray, np.ndarray]], leave: list | None = None) -> list[tuple[float | None, list]]:
        """Vote (None without neighbours) and evidence of each text, given as its terms and their counts."""
        index, out = self.index, []
        queries = [self.vocabulary.weighted(t, n) for t, n in texts]
        for rows, cosines in index.nearest_of(queries, NEIGHBOURS, leave):
            best = np.lexsort((rows, -cosines))[:3]
            vote = float((cosines * index.labels[rows]).sum() / cosines.sum()) if len(rows) else None
            out.append((vote, [index.ids[rows[i]] for i in best]))
        return out

    def scores(self, texts: list[tuple[np.ndarray, np.ndarray]], curve: tuple[list, list]) -> list[tuple[float, list]]:
        keys = [(t.tobytes(), n.tobytes()) for t, n in texts]
        each = dict(zip(keys, texts))  # copies are scored once
        found = dict(zip(each, self.votes(list(each.values()))))
        return [self.calibrated(*found[key], curve) for key in keys]

    def calibrated(self, vote: float | None, evidence: list, curve: tuple[list, list]) -> tuple[float, list]:
        if vote is None:
            return min(0.49, float(self.index.labels.mean())), []
        p = float(np.interp(vote, *curve))
        return min(1.0, max(0.0, 0.999 * p + 0.001 * vote)), evidence


def _packed(numbers: np.ndarray) -> bytes:
    return zlib.compress(np.ascontiguousarray(numbers.astype("<i4").view(np.uint8).reshape(-1, 4).T), 1)


def _unpacked(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zlib.decompress(data), np.uint8).reshape(4, -1).T).view("<i4").ravel()


class Fitted:
    """Examples, terms and their weights, small enough to be sent; the scorer is built where it is used."""

    def __init__(self, terms: list[str], weighting: Weighting = PLAIN, factor: np.ndarray | None = None, ids=(),
                 labels=(), sizes=(), t: np.ndarray | None = None, n: np.ndarray | None = None):
        """t, n: terms and counts of the examples, one example after the other; sizes: how many are of each."""
        self.terms, self.weighting = zlib.compress("\n".join(terms).encode("utf-8", "surrogatepass"), 1), weighting
        self.ids, self.labels, self.factor = list(ids), list(labels), factor
        if factor is not None:
            self.sizes, self.n = _packed(np.asarray(sizes)), _packed(n)
            # runs of near numbers pack well
            self.t = _packed(np.diff(t, prepend=0))

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("vocabulary", "scorer")}

    @cached_property
    def vocabulary(self) -> Vocabulary:
        terms = zlib.decompress(self.terms).decode("utf-8", "surrogatepass")
        return Vocabulary(terms.split("\n") if terms else [], self.weighting, self.factor)

    @cached_property
    def scorer(self) -> Scorer:
        t, n = np.cumsum(_unpacked(self.t), dtype=np.int64), _unpacked(self.n)
        at = np.concatenate([[0], np.cumsum(_unpacked(self.sizes))])
        weights = Vocabulary([], self.weighting, self.factor)  # terms are numbers from here on
        vectors = [weights.weighted(t[a:b], n[a:b]) for a, b in zip(at, at[1:])]
        return Scorer(weights, BlockMaxIndex(self.ids, self.labels, vectors))


def isotonic(votes: np.ndarray, labels: np.ndarray) -> tuple[list, list]:
    """Pool adjacent violators: (vote, probability) corners of the non-decreasing fit."""
    pools: list[list[float]] = []  # sum of labels, of weights, of votes
    for v in np.unique(votes):
        own = labels[votes == v]
        pools.append([own.sum(), len(own), v * len(own)])
        while len(pools) > 1 and pools[-2][0] / pools[-2][1] >= pools[-1][0] / pools[-1][1]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    return [p[2] / p[1] for p in pools], [p[0] / p[1] for p in pools]


def examples(docs: DataFrame, labels: DataFrame, max_examples: int) -> DataFrame:
    """doc_id, text, toxic of the bounded sample; never of held-out rows."""
    given = (labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out())
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    known = docs.filter(F.col("doc_id").isNotNull()).select("doc_id").join(given, "doc_id").distinct()
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_examples)  # its bound lets it be broadcast
    texts = docs.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    return written(texts, "toxic-examples")


def example_terms(sample: DataFrame, leads: tuple[int, ...]) -> list[str]:
    """All terms of the examples."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: set[str] = set()
        for b in steps(batches):
            for text in b.column(0).to_pylist():
                for word in set(_WORDS.findall(text.lower())):
                    found.update(terms_of(word, leads))
        yield pa.RecordBatch.from_pydict({"term": pa.array(list(found), pa.string())})

    return sorted(sample.select("text").mapInArrow(tidy(run), "term string").distinct().toArrow()["term"].to_pylist())


def _lists(batch: pa.RecordBatch, name: str) -> list[np.ndarray]:
    """The arrays of a column of lists, without copies."""
    column = batch.column(name)
    ends = np.concatenate([[0], np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))])
    flat = column.flatten().to_numpy()
    return [flat[a:b] for a, b in zip(ends, ends[1:])]


def counted_terms(rows: DataFrame, plain: Broadcast, name: str) -> DataFrame:
    """``rows`` with their ``text`` replaced by t, n: the vocabulary's terms in it and their counts, written.

    Texts are taken apart once; frequencies and scores read these numbers.
    """
    keep = [c for c in rows.columns if c != "text"]
    schema = T.StructType([rows.schema[c] for c in keep] + [T.StructField(c, T.ArrayType(T.IntegerType(), False), False)
                                                            for c in "tn"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in steps(batches):
            sizes, t, n = plain.value.vocabulary.counts(b.column("text").to_pylist())
            ends = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.ListArray.from_arrays(ends, pa.array(t)),
                                              pa.ListArray.from_arrays(ends, pa.array(n))], names=[*keep, "t", "n"])

    return written(rows.select(*keep, "text").mapInArrow(tidy(run), schema), name)


def document_frequencies(counted: DataFrame, n_terms: int) -> tuple[int, np.ndarray]:
    """Number of documents, and of those that hold each term of the vocabulary."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(n_terms + 1, dtype=np.int64)  # the last counts all documents
        for b in batches:
            counts[:-1] += np.bincount(b.column(0).flatten().to_numpy(), minlength=n_terms)
            counts[-1] += b.num_rows
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_pydict({"term": pa.array(seen, pa.int64()), "n": pa.array(counts[seen], pa.int64())})

    found = (counted.select("t").mapInArrow(tidy(run), "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
             .toArrow())
    out = np.zeros(n_terms + 1, dtype=np.int64)
    out[found["term"].to_numpy()] = found["n"].to_numpy()
    return int(out[-1]), out[:-1]


def fit(rows: DataFrame, labels: DataFrame, max_examples: int = MAX_EXAMPLES,
        weighting: Weighting = PLAIN) -> tuple[DataFrame, Broadcast, tuple] | None:
    """(``rows`` by terms and counts, the examples, the calibration curve); None without labelled rows of both classes."""
    spark = rows.sparkSession
    labels = labels.select("doc_id", (F.col("toxic") > 0).cast("int").alias("toxic"))
    sample = examples(rows.select("doc_id", "text"), labels, max_examples)
    if sample.select("toxic").distinct().count() < 2:
        return None
    terms = example_terms(sample, weighting.leads)
    plain = spark.sparkContext.broadcast(Fitted(terms, weighting))
    counted = counted_terms(rows, plain, "toxic-terms")
    tried = counted_terms(sample, plain, "toxic-example-terms")
    plain.destroy()
    n_docs, frequency = document_frequencies(counted, len(terms))
    known = tried.toArrow()  # at most max_examples rows, as arrays of numbers
    t, n = known["t"].combine_chunks(), known["n"].combine_chunks()
    sizes, marks = t.value_lengths().to_numpy(), known["toxic"].to_numpy()
    held = [np.bincount(t.flatten().to_numpy()[np.repeat(marks == c, sizes)], minlength=len(terms)) for c in (1, 0)]
    factor = weighting.factor(n_docs, frequency, *held, int((marks == 1).sum()), int((marks == 0).sum()))
    fitted = Fitted([], weighting, factor, known["doc_id"].to_pylist(), marks.tolist(), sizes,
                    t.flatten().to_numpy(), n.flatten().to_numpy())
    del known, t, n, held
    sent = spark.sparkContext.broadcast(fitted)

    def leave_one_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = sent.value.scorer
        place = {i: at for at, i in enumerate(scorer.index.ids)}
        for b in steps(batches):
            own = [place[i] for i in b.column("doc_id").to_pylist()]
            votes = [v for v, _ in scorer.votes(list(zip(_lists(b, "t"), _lists(b, "n"))), own)]
            yield pa.RecordBatch.from_arrays([pa.array(votes, pa.float64()), b.column("toxic")], ["vote", "toxic"])

    votes = (tried.repartition("doc_id").mapInArrow(tidy(leave_one_out), "vote double, toxic int").dropna().collect())
    curve = isotonic(np.array([r["vote"] for r in votes]), np.array([r["toxic"] for r in votes], dtype=float))
    return counted, sent, curve


def score(docs: DataFrame, labels: DataFrame, **fitting) -> DataFrame:
    """doc_id, held_out, score, predicted, evidence (ids of the nearest examples) of every whole text.

    ``fitting``: ``max_examples`` and ``weighting`` of :func:`fit`.
    """
    spark = docs.sparkSession
    python_ready(spark)
    rows = docs.select("doc_id", held_out().alias("held_out"), text_or_empty().alias("text"))
    fitted = fit(rows, labels, **fitting)
    kind = rows.schema["doc_id"].dataType
    if fitted is None:
        return rows.select("doc_id", "held_out", F.lit(0.0).alias("score"), F.lit(0).alias("predicted"),
                           F.array().cast(T.ArrayType(kind)).alias("evidence"))
    counted, sent, curve = fitted
    schema = T.StructType([T.StructField("doc_id", kind), T.StructField("held_out", T.BooleanType()),
                           T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType()),
                           T.StructField("evidence", T.ArrayType(kind))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in steps(batches):
            scored = sent.value.scorer.scores(list(zip(_lists(b, "t"), _lists(b, "n"))), curve)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("held_out"), pa.array([s for s, _ in scored], pa.float64()),
                 pa.array([int(s >= 0.5) for s, _ in scored], pa.int32()),
                 pa.array([e for _, e in scored], pa.list_(b.column("doc_id").type))], schema.names)

    return counted.mapInArrow(tidy(run), schema)
