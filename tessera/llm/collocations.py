"""Operator 12: phrase collocations by prefix-free parsing.

Texts become words and piece breaks.  A window of ``longest - 1`` symbols whose
hash is divisible by ``CHUNK_WORDS`` starts a chunk, which runs to the end of
the next such window; so neighbouring chunks overlap by one window, equal
passages give equal chunks wherever they stand, and the distinct chunks with
their frequencies (the dictionary of the parse) hold the whole corpus.  An
n-gram belongs to the chunk in which it starts before the closing window, so
one that lies in an overlap is counted once; every text ends in a window of
breaks, which closes its last chunk.  n-grams are then counted inside the
distinct chunks, weighted by the chunks' frequencies: added up per step of a
task in numpy, then per part.  Parts are ranges of hashes; a step sends each
part one row, which holds the part's keys and counts as bytes, so the shuffles
of chunks, hashes and phrases have few rows, and a task adds up whole columns.

Phrases are counted level by level.  A phrase of ``least`` occurrences has
only parts of as many.  A first pass per level adds up hashes of n-grams (the
part and 32 bits), which are short and quick to group; the hashes that reach
``least`` go into a Bloom filter.  One last pass counts the phrases themselves,
exactly, where the filters let them through.  A filter has a fixed number of
bits: on a corpus too large for it fewer n-grams are left out, the counts stay
the same.

Scores are worked out in decimal arithmetic of 38 digits.

Defined results: null and empty texts hold no word; rows that repeat a text or
an id count each time; a null group is ``und``; a group without candidates has
no row; ties of score and count go by phrase in UTF-8 byte order; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from tessera.llm.common import python_ready, steps, tidy, written

#: One window in this many starts a chunk: the mean length of a chunk in symbols.
CHUNK_WORDS = 16
#: A chunk that found no window of its own within this many symbols is cut there.
LONGEST_CHUNK = 4096
#: Symbols counted together in one numpy step.
SYMBOLS_PER_STEP = 1 << 20
#: log2 of the bits of a filter of frequent phrases: 16 MB, whatever the corpus.
FILTER_BITS = 27
#: log2 of the bits of a filter that one task sets.
SEGMENT_BITS = 21
#: Stored bytes for which another part is made, and the most parts.
PART_BYTES, MOST_PARTS = 1 << 22, 1 << 14
#: Bits for a count behind a filter's key of a part and 32 bits.
COUNT_BITS = 18
#: A word that makes up one word in this many of the corpus is common, so there are no more common words than this.
COMMON = 4096
#: Parts into which the ranking of a group is split.
SALTS = 16

#: Keys and what they count, one row for each part that a step has keys of.
_DEALT = "part int, length binary, key binary, f binary"

#: The symbol of a piece break: the characters that break pieces stand in no word.
BREAK = b"."
# one table for bytes of UTF-8: A-Z to a-z, what breaks a piece to the break; other bytes as they are
_TABLE = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ,;:!?\n\x0b\x0c\r",
                         b"abcdefghijklmnopqrstuvwxyz" + BREAK * 9)


def symbols(text: bytes) -> list[bytes]:
    """Words and piece breaks of a UTF-8 text, lower-cased in A-Z."""
    return text.translate(_TABLE).replace(BREAK, b" . ").split()  # only spaces and tabs are left to split at


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


_PER_BYTE = _mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _hashes(words: pa.Array) -> np.ndarray:
    """Hash of each word, the same in every task; a break's is 0, no other is."""
    words = pa.concat_arrays([words.cast(pa.binary())])  # offsets from 0
    if not len(words):
        return np.zeros(0, dtype=np.uint64)
    _, ends, data = words.buffers()
    ends = np.frombuffer(ends, dtype=np.int32, count=len(words) + 1).astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8, count=ends[-1]) if data else np.zeros(0, dtype=np.uint8)
    size = np.diff(ends)
    place = np.arange(len(raw)) - np.repeat(ends[:-1], size)
    powers = np.cumprod(np.full(int(size.max()) + 1, 0xD6E8FEB86659FD93, dtype=np.uint64))
    summed = np.r_[np.uint64(0), np.cumsum(_PER_BYTE[raw] * powers[place])]
    h = np.maximum(_mixed(summed[ends[1:]] - summed[ends[:-1]] + size.astype(np.uint64)), np.uint64(1))
    broken = size == 1
    broken[broken] = raw[ends[:-1][broken]] == BREAK[0]
    h[broken] = 0
    return h


def _encoded(words: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(number of each word, the distinct words, the hash of each word)."""
    coded = words.dictionary_encode()
    at = coded.indices.to_numpy()
    return at, coded.dictionary, _hashes(coded.dictionary)[at]


def _window_hash(h: np.ndarray, width: int) -> np.ndarray:
    """Hash of the ``width`` symbols from each place on; the places at which so many are left."""
    n = len(h) - width + 1
    out = np.zeros(max(n, 0), dtype=np.uint64)
    for k in range(width):
        out = _mixed(out + h[k:k + max(n, 0)])
    return out


def chunks_of(texts: list[list[bytes]], overlap: int, mean: int = CHUNK_WORDS) -> tuple[list[bytes], np.ndarray]:
    """(the chunks of all texts, their symbols joined by spaces, the number of each chunk's text).

    A text's last chunk, like every other, ends with its closing window.
    """
    return _hashed_chunks(texts, overlap, mean)[:2]


def _hashed_chunks(texts: list[list[bytes]], overlap: int, mean: int) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """:func:`chunks_of` and a hash of each chunk's symbols in any order."""
    flat: list[bytes] = []
    sizes, owners = [], []
    for k, words in enumerate(texts):
        if words.count(BREAK) < len(words):
            flat += words
            flat += [BREAK] * overlap
            sizes.append(len(words) + overlap)
            owners.append(k)
    if not flat:
        return [], np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    symbols_ = pa.array(flat, pa.binary())
    _, _, h = _encoded(symbols_)
    size = np.array(sizes)
    stop = np.cumsum(size)
    limit = np.repeat(stop - overlap, size)  # where the text's last window starts
    place = np.arange(len(flat))
    chosen = np.zeros(len(flat), dtype=bool)
    chosen[:len(flat) - overlap + 1] = _window_hash(h, overlap) % np.uint64(mean) == 0
    chosen[stop - size] = True
    starts = np.flatnonzero(chosen & (place < limit))
    ends = np.minimum(np.r_[starts[1:], len(flat)], limit[starts])
    if (ends - starts).max() > LONGEST_CHUNK:
        starts = np.concatenate([np.arange(a, b, LONGEST_CHUNK) for a, b in zip(starts, ends)])
        ends = np.minimum(np.r_[starts[1:], len(flat)], limit[starts])
    joined = b" ".join(flat)
    byte = np.r_[0, np.cumsum(pc.binary_length(symbols_).to_numpy() + 1)]
    chunks = [joined[a:b] for a, b in zip(byte[starts].tolist(), (byte[ends + overlap] - 1).tolist())]
    summed = np.r_[np.uint64(0), np.cumsum(_mixed(h))]
    return chunks, np.repeat(np.array(owners), size)[starts], _mixed(summed[ends + overlap] - summed[starts])


def _stored_bytes(df: DataFrame) -> int:
    """What Spark takes the size of the rows to be; for files their size."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def _parts_for(df: DataFrame) -> int:
    """Parts for what is counted in ``df``: by its size, so that one fits into a task's memory."""
    by_size = -(-_stored_bytes(df) // PART_BYTES)
    return min(MOST_PARTS, max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), by_size))


def _part_of(h: np.ndarray, parts: int) -> np.ndarray:
    """The part of each hash, by its upper half."""
    return (h >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)


def _runs(part: np.ndarray) -> np.ndarray:
    """Where each part starts in ascending parts, and their end."""
    return np.r_[np.flatnonzero(np.r_[True, part[1:] != part[:-1]]), len(part)] if len(part) else np.zeros(1, np.int64)


def _cut(values: np.ndarray, at: np.ndarray) -> pa.Array:
    """The bytes of the values from each place to the next."""
    offsets = (at * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(values)])


def _joined(column: pa.ChunkedArray, kind: type) -> np.ndarray:
    """The values that :func:`_cut` has cut, one after the other."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype=kind)


def _dealt(keys: pa.Array, groups: pa.Array, f: np.ndarray, h: np.ndarray, parts: int) -> pa.RecordBatch:
    """Rows of ``_DEALT``: keys of a text without line feeds and a group, and what they count, by parts of the hashes."""
    part = _part_of(h, parts)
    order = np.argsort(part.astype(np.uint16), kind="stable")  # a radix sort
    part, at = part[order], _runs(part[order])
    whole = pc.binary_join_element_wise(keys, groups, "\n").take(pa.array(order))
    whole = pa.concat_arrays([whole.cast(pa.binary())])  # offsets from 0
    _, ends, data = whole.buffers()
    ends = np.frombuffer(ends, dtype=np.int32, count=len(whole) + 1) if len(whole) else np.zeros(1, np.int32)
    raw = np.frombuffer(data, dtype=np.uint8, count=ends[-1]) if data else np.zeros(0, dtype=np.uint8)
    return pa.RecordBatch.from_arrays(
        [pa.array(part[at[:-1]].astype(np.int32)), _cut(np.diff(ends), at), _cut(raw, ends[at]), _cut(f[order], at)],
        names=["part", "length", "key", "f"])


def _summed(rows: pa.Table, least: int) -> tuple[pa.Array, pa.Array, pa.Array]:
    """(text, group, count) of a part's keys with ``least`` occurrences or more; empty texts always."""
    ends = np.r_[0, np.cumsum(_joined(rows.column("length"), np.int32), dtype=np.int64)]
    raw = pa.py_buffer(b"".join(rows.column("key").to_pylist()))
    if raw.size < 1 << 31:  # grouped faster
        key = pa.Array.from_buffers(pa.string(), len(ends) - 1, [None, pa.py_buffer(ends.astype(np.int32)), raw])
    else:
        key = pa.Array.from_buffers(pa.large_string(), len(ends) - 1, [None, pa.py_buffer(ends), raw])
    got = pa.table({"key": key, "f": _joined(rows.column("f"), np.int64)}).group_by("key", use_threads=False).aggregate(
        [("f", "sum")])
    got = got.filter(pc.or_(pc.greater_equal(got.column("f_sum"), least), pc.starts_with(got.column("key"), "\n")))
    halves = pc.split_pattern(got.column("key").combine_chunks().cast(pa.string()), "\n", max_splits=1)
    return pc.list_element(halves, 0), pc.list_element(halves, 1), got.column("f_sum").combine_chunks()


def dictionary(docs: DataFrame, text: str, group: str, overlap: int) -> DataFrame:
    """grp, chunk, freq: the distinct chunks of every group's texts and how often the parse holds them."""
    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in steps(batches):
            texts = [symbols(t) for t in b.column(1).cast(pa.binary()).to_pylist()]
            chunks, owner, h = _hashed_chunks(texts, overlap, CHUNK_WORDS)
            held.append((pa.array(chunks, pa.binary()).cast(pa.string()), b.column(0).take(pa.array(owner)), h))
            size += sum(map(len, texts))
            if size >= SYMBOLS_PER_STEP:
                yield dealt(held)
                held, size = [], 0
        if held:
            yield dealt(held)

    def dealt(held: list[tuple]) -> pa.RecordBatch:
        chunks, groups, h = zip(*held)
        h = np.concatenate(h)
        return _dealt(pa.concat_arrays(chunks), pa.concat_arrays(groups), np.ones(len(h), dtype=np.int64), h, parts)

    def add(rows: pa.Table) -> pa.Table:
        chunks, groups, f = _summed(rows, 1)
        return pa.table({"grp": groups, "chunk": chunks, "freq": f})

    given = docs.select(F.coalesce(F.col(group), F.lit("und")).alias("grp"), F.col(text).alias("text")).filter(
        "text is not null")
    parts = _parts_for(given)
    return (given.mapInArrow(tidy(parse), _DEALT).groupBy("part")
            .applyInArrow(add, "grp string, chunk string, freq long"))


class _Step:
    """The symbols of some of the dictionary's chunks as arrays: numbers, hashes, weights, the starts a chunk owns."""

    def __init__(self, chunks: pa.Table, overlap: int):
        split = pc.split_pattern(chunks.column("chunk").combine_chunks(), " ")
        self.length = split.value_lengths().to_numpy().astype(np.int64)
        self.ids, self.words, self.hash = _encoded(split.flatten())
        coded = chunks.column("grp").combine_chunks().dictionary_encode()
        self.group_names = coded.dictionary
        self.group_of_chunk = coded.indices.to_numpy().astype(np.int64)
        self.group = np.repeat(self.group_of_chunk, self.length)
        self.group_hash = _hashes(coded.dictionary)
        self.weight = np.repeat(chunks.column("freq").to_numpy(), self.length)
        left = np.repeat(np.cumsum(self.length), self.length) - np.arange(len(self.ids))  # up to the chunk's end
        self.starts = left > overlap  # an n-gram that starts later belongs to the next chunk

    def grams(self, n: int) -> np.ndarray:
        """Places where an n-gram of words starts that this chunk owns."""
        m = max(len(self.ids) - n + 1, 0)
        ok = self.starts[:m].copy()
        for k in range(n):
            ok &= self.hash[k:k + m] != 0
        return np.flatnonzero(ok)

    def phrase_hash(self, at: np.ndarray, n: int) -> np.ndarray:
        """Hash of the group and the n words at each place."""
        out = self.group_hash[self.group[at]]
        for k in range(n):
            out = _mixed(out + self.hash[at + k])
        return out

    def likely(self, n: int, filters: dict[int, np.ndarray], parts: int) -> np.ndarray:
        """The places of :meth:`grams` whose phrase, or whose parts one word shorter, the filters let through."""
        at = self.grams(n)
        for size, ahead in (((n, 0),) if n in filters else ((n - 1, 0), (n - 1, 1)) if n - 1 in filters else ()):
            at = at[_in_filter(filters[size], _filter_key(self.phrase_hash(at + ahead, size), parts))]
        return at

    def batch(self, at: np.ndarray, n: int) -> pa.RecordBatch:
        """grp, size, phrase, f, h of the distinct n-grams at the places, told apart by group and words."""
        code, codes = self.group[at], len(self.group_names)
        for k in range(n):
            if codes * len(self.words) >= 1 << 63:
                known, code = np.unique(code, return_inverse=True)
                codes = len(known)
            code = code.astype(np.int64) * len(self.words) + self.ids[at + k]
            codes *= len(self.words)
        place, weight = _added(code, self.weight[at])
        place = at[place]
        parts = [self.words.take(pa.array(self.ids[place + k])) for k in range(n)]
        phrase = parts[0] if n == 1 else pc.binary_join_element_wise(*parts, " ")
        return pa.RecordBatch.from_arrays(
            [self.group_names.take(pa.array(self.group[place])), pa.array(np.full(len(place), n, dtype=np.int32)),
             phrase, pa.array(weight), pa.array(self.phrase_hash(place, n))], names=["grp", "size", "phrase", "f", "h"])

    def totals(self) -> pa.RecordBatch:
        """grp, size 0, '', number of words, h."""
        per_group = np.zeros(len(self.group_names), dtype=np.int64)
        np.add.at(per_group, self.group, self.weight * (self.starts & (self.hash != 0)))
        m = len(per_group)
        return pa.RecordBatch.from_arrays(
            [self.group_names, pa.array(np.zeros(m, dtype=np.int32)), pa.array([""] * m, pa.string()),
             pa.array(per_group), pa.array(self.group_hash)], names=["grp", "size", "phrase", "f", "h"])


def _added(code: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(a place of each distinct code, the sum of its weights)."""
    if not len(code):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    order = np.argsort(code)
    code = code[order]
    first = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
    return order[first], np.add.reduceat(weight[order], first)


def _bits_of(key: np.ndarray, log_bits: int) -> list[np.ndarray]:
    """The two bits of a key in a filter of ``2 ** log_bits`` bits."""
    h, mask = _mixed(key), np.uint64((1 << log_bits) - 1)
    return [h & mask, (h >> np.uint64(32)) & mask]


def _bounded_sums(key: np.ndarray, f: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(the distinct keys in order, the sum of each one's counts, at most ``most``); keys leave COUNT_BITS bits free."""
    both = np.sort(key << np.uint64(COUNT_BITS) | np.minimum(f, most).astype(np.uint64))  # faster than by places
    key, f = both >> np.uint64(COUNT_BITS), both & np.uint64((1 << COUNT_BITS) - 1)
    first = _runs(key)[:-1]
    return key[first], np.minimum(np.add.reduceat(f, first), np.uint64(most)) if len(first) else f


def _in_filter(bits: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Whether a key may be in the filter: both of its bits are set."""
    ok = np.ones(len(key), dtype=bool)
    for at in _bits_of(key, (len(bits) * 64).bit_length() - 1):
        ok &= (bits[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)
    return ok


def _steps_of(batches: Iterator[pa.RecordBatch], overlap: int) -> Iterator[_Step]:
    """The dictionary's rows in steps of about ``SYMBOLS_PER_STEP`` symbols."""
    held, size = [], 0
    for b in batches:
        for part in (b.slice(at, 4096) for at in range(0, b.num_rows, 4096)):
            held.append(part)
            size += part.num_rows + (pc.sum(pc.count_substring(part.column("chunk"), " ")).as_py() or 0)
            if size >= SYMBOLS_PER_STEP:
                yield _Step(pa.Table.from_batches(held), overlap)
                held, size = [], 0
    if held:
        yield _Step(pa.Table.from_batches(held), overlap)


def _filter_key(h: np.ndarray, parts: int) -> np.ndarray:
    """What the filters tell hashes apart by: the part, then 32 bits."""
    return _part_of(h, parts) << np.uint64(32) | h & np.uint64(0xFFFFFFFF)


def _frequent_filter(chunks: DataFrame, size: int, overlap: int, least: int, log_bits: int, filters: dict, parts: int):
    """Bloom filter of the ``size``-grams whose hash occurs ``least`` times, as a broadcast of ``2 ** log_bits`` bits."""
    enough = min(least, (1 << COUNT_BITS) - 1)  # a count beyond that is as good as that
    count = np.min_scalar_type(enough)
    segment = min(SEGMENT_BITS, log_bits)

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shorter = {n: f.value for n, f in filters.items()}
        for step in _steps_of(batches, overlap):
            at = step.likely(size, shorter, parts)
            key, weight = _bounded_sums(_filter_key(step.phrase_hash(at, size), parts), step.weight[at], enough)
            part = (key >> np.uint64(32)).astype(np.int32)
            runs = _runs(part)
            yield pa.RecordBatch.from_arrays(
                [pa.array(part[runs[:-1]]), _cut(key.astype(np.uint32), runs),
                 _cut(weight.astype(count), runs)], names=["part", "low", "f"])
            step = None  # before the next one is made

    def frequent(key: tuple, rows: pa.Table) -> pa.Table:
        low, f = _bounded_sums(_joined(rows.column("low"), np.uint32).astype(np.uint64), _joined(rows.column("f"), count), enough)
        found = low[f >= enough] | np.uint64(key[0].as_py() << 32)
        bits = np.unique(np.concatenate(_bits_of(found, log_bits)))
        of = (bits >> np.uint64(segment)).astype(np.int32)
        runs = _runs(of)
        low_bits = (bits & np.uint64((1 << segment) - 1)).astype(np.uint32)
        return pa.table({"segment": of[runs[:-1]], "at": _cut(low_bits, runs)})

    def packed(key: tuple, rows: pa.Table) -> pa.Table:
        is_set = np.zeros(1 << segment, dtype=bool)
        is_set[_joined(rows.column("at"), np.uint32)] = True
        return pa.table({"segment": [key[0].cast(pa.int32())], "bits": [np.packbits(is_set, bitorder="little").tobytes()]})

    found = (chunks.mapInArrow(tidy(tally), "part int, low binary, f binary")
             .groupBy("part").applyInArrow(frequent, "segment int, at binary")
             .groupBy("segment").applyInArrow(packed, "segment int, bits binary"))
    bits = np.zeros(1 << (log_bits - 6), dtype=np.uint64)
    words = 1 << (segment - 6)
    for row in found.toArrow().to_pylist():  # at most 2 ** log_bits bits in all
        bits[row["segment"] * words:][:words] = np.frombuffer(row["bits"], dtype=np.uint64)
    return chunks.sparkSession.sparkContext.broadcast(bits)


def _count(chunks: DataFrame, longest: int, overlap: int, least: int, filters: dict, parts: int) -> DataFrame:
    """grp, size, phrase, f of the phrases with at least ``least`` occurrences; size 0: a group's number of words."""
    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = {n: f.value for n, f in filters.items()}
        for step in _steps_of(batches, overlap):
            for n in range(longest + 1):
                found = step.batch(step.likely(n, bits, parts), n) if n else step.totals()
                yield _dealt(found.column("phrase"), found.column("grp"), found.column("f").to_numpy(),
                             found.column("h").to_numpy(), parts)
                found = None
            step = None  # before the next one is made

    def add(rows: pa.Table) -> pa.Table:
        phrases, groups, f = _summed(rows, least)
        words = pc.add(pc.count_substring(phrases, " "), 1)
        size = pc.if_else(pc.equal(pc.binary_length(phrases), 0), pa.scalar(0, words.type), words)
        return pa.table({"grp": groups, "size": size.cast(pa.int32()), "phrase": phrases, "f": f})

    return (chunks.mapInArrow(tidy(tally), _DEALT).groupBy("part")
            .applyInArrow(add, "grp string, size int, phrase string, f long"))


def _part(size: int, start: int, stop: int) -> Column:
    """Words ``start`` to ``stop`` of a phrase of ``size`` words."""
    ahead = F.substring_index("phrase", " ", stop) if stop < size else F.col("phrase")
    return F.substring_index(ahead, " ", start - stop) if start else ahead


def _with_count(found: DataFrame, frequent: DataFrame, size: int, part: Column, name: str, common: int) -> DataFrame:
    """``found`` with ``name``, the count of the part; that of a word of ``common`` occurrences, which may be in most
    phrases, by broadcast.  A hash in front makes the sort quick, the strings tell parts apart."""
    table = frequent.filter(F.col("size") == size).select(
        F.col("grp").alias("_g"), F.col("phrase").alias("_p"), F.col("f").alias(name))
    found = found.withColumn("_part", part)
    same = [F.col("grp") == F.col("_g"), F.col("_part") == F.col("_p")]
    key, known = F.xxhash64("grp", "_part"), F.lit(None).cast("long")
    if size == 1 and common:
        often = table.filter(F.col(name) >= common).withColumnRenamed(name, "_often")
        found = found.join(F.broadcast(often), same, "left").drop("_g", "_p")
        table = table.filter(F.col(name) < common)
        known = F.col("_often")
        key = F.when(known.isNull(), key).otherwise(F.xxhash64("phrase"))  # those met by broadcast are spread
    keyed = found.withColumn("_key", key)
    joined = keyed.join(table.withColumn("_h", F.xxhash64("_g", "_p")), [F.col("_key") == F.col("_h"), *same], "left")
    return joined.withColumn(name, F.coalesce(known, name)).drop("_g", "_p", "_h", "_key", "_part", "_often")


def _scored(found: DataFrame, frequent: DataFrame, size: int, common: int = 0) -> DataFrame:
    """Candidates of ``size`` words with the l, r and score of their lowest-scoring cut; common: see _with_count."""
    big = lambda c: F.col(c).cast("decimal(18,0)")
    cuts = []
    for k in range(1, size):
        found = _with_count(found, frequent, k, _part(size, 0, k), f"_l{k}", common)
        found = _with_count(found, frequent, size - k, _part(size, k, size), f"_r{k}", common)
        square = (big("a") * big("a")).cast("decimal(32,0)") * F.lit(1_000_000).cast("decimal(7,0)")
        product = (big(f"_l{k}") * big(f"_r{k}")).cast("decimal(38,0)")
        found = found.withColumns({"_square": square.cast("decimal(38,0)"), "_product": product}).withColumn(
            f"_s{k}", F.expr("_square div _product").cast("long")).drop("_square", "_product")
        cuts.append(F.struct(F.col(f"_s{k}").alias("score"), F.lit(k).alias("k"), F.col(f"_l{k}").alias("l"),
                             F.col(f"_r{k}").alias("r")))
    return found.withColumn("cut", F.array_min(F.array(*cuts))).select(
        "grp", F.lit(size).alias("size"), "phrase", "a", "cut.l", "cut.r", "cut.score")


def mine(docs: DataFrame, text: str = "text", group: str = "lang", longest: int = 3, least: int = 10,
         inside_percent: int = 50, filter_bits: int = FILTER_BITS) -> DataFrame:
    """group, phrase, a, l, r, n, score: every candidate that no longer candidate explains.

    Candidates are the phrases of 2 to ``longest`` words with ``least``
    occurrences or more in their group; one is dropped if a longer candidate
    holds its words side by side and has ``inside_percent`` of its count.
    ``filter_bits`` is the log2 of the filter's bits, at least 6; it changes no result.
    """
    if longest < 2:
        raise ValueError("phrases have at least two words")
    spark = docs.sparkSession
    python_ready(spark)
    overlap = longest - 1
    chunks = written(dictionary(docs, text, group, overlap), "chunk-dictionary")
    parts = _parts_for(chunks)
    filters: dict = {}
    for size in range(2, max(3, longest)):
        filters[size] = _frequent_filter(chunks, size, overlap, least, filter_bits, filters, parts)
    frequent = written(_count(chunks, longest, overlap, least, filters, parts), "frequent-phrases")
    for f in filters.values():
        f.unpersist()
    words = frequent.filter("size = 0").select("grp", F.col("f").alias("n"))  # one row per group
    common = -(-(words.agg(F.sum("n")).head()[0] or 0) // COMMON)
    # the largest count of a longer candidate around each shorter phrase
    inner = frequent.filter("false").select("grp", "f", "phrase")
    for size in range(3, longest + 1):
        parts = [_part(size, at, at + m) for m in range(2, size) for at in range(size - m + 1)]
        inner = inner.unionByName(frequent.filter(F.col("size") == size).select(
            "grp", "f", F.explode(F.array(*parts)).alias("phrase")))
    around = inner.groupBy("grp", "phrase").agg(F.max("f").alias("longer"))
    around = around.withColumn("_h", F.xxhash64("grp", "phrase"))
    kept = None
    for size in range(2, longest + 1):
        level = _scored(frequent.filter(F.col("size") == size).select("grp", "phrase", F.col("f").alias("a")),
                        frequent, size, common)
        if size < longest:
            level = level.withColumn("_h", F.xxhash64("grp", "phrase")).join(
                around, ["_h", "grp", "phrase"], "left").filter(
                F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * inside_percent)).drop("_h", "longer")
        kept = level if kept is None else kept.unionByName(level)
    return kept.join(F.broadcast(words), "grp").select(
        F.col("grp").alias(group), "phrase", "a", "l", "r", "n", "score")


def best(found: DataFrame, limit: int = 2000, group: str = "lang") -> DataFrame:
    """Each group's first ``limit`` phrases with their rank.

    A group is ranked in ``SALTS`` parts first, so the last task sees at most
    ``SALTS * limit`` rows of a group, however many phrases and tasks there are.
    """
    order = [F.desc("score"), F.desc("a"), "phrase"]
    salted = found.withColumn("_salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    ahead = (salted.withColumn("rank", F.row_number().over(Window.partitionBy(group, "_salt").orderBy(*order)))
             .filter(F.col("rank") <= limit))
    ranked = ahead.withColumn("rank", F.row_number().over(Window.partitionBy(group).orderBy(*order)))
    return ranked.filter(F.col("rank") <= limit).select(
        group, F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
