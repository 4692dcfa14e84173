"""Operator 8: BPE encoding and decoding with a tokenization automaton.

The automaton's arcs carry tokens; the token sequences it accepts are exactly
the BPE encodings.  It starts as one state with a loop for every base symbol.
The gadget of a merge (u, v) -> w, applied in merge order, is: the state that
u-arcs lead to is split off a copy without its v-arc, u-arcs are redirected to
the copy, and wherever a u-arc leaves, a w-arc is added that leads to where v
led.  All arcs with the same label lead to the same state, so a state is kept
per last token; copies share everything but the arcs taken from them, which
are kept with the merge at which they went.  A w-arc leaves a state exactly if
its left part's arc left it at that merge and w was not taken since; this is
the transition table's rule.  The table's entries are worked out by the rule when
an arc is first asked for, and kept up to a bound.

Every prefix of a word has one accepted path, so encoding walks a word's
symbols left to right, looks the pieces ahead up by their spelling and enters no
position twice.
Decoding emits the labels of the arcs.

Defined results: null text is encoded as empty (no ids); repeated rows and null
ids give a row each; other columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
import sys
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tessera.llm.common import file_bytes, kept, python_ready, steps, text_or_empty, tidy

#: Distinct space-free segments, and words, whose encodings a worker remembers: half of them met lately, half before;
#: when the first half is full, it becomes the second, so what is met often stays.
SEGMENTS_KEPT, WORDS_KEPT = 500_000, 300_000
#: Entries of the transition table that a worker keeps; emptied when full.
ARCS_KEPT = 400_000


# The split pattern of the lower-casing word vocabulary, and the same for ASCII.
_KNOWN_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_ASCII_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")


class MergeAutomaton:
    """Deterministic automaton over tokens, compiled from a merge list."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]]):
        self.rank: dict[int, int] = {}
        self.left: dict[int, int] = {}
        #: state of a token -> {arc: merge at which the gadget took it}
        start: dict[int, int] = {}
        base = {i for i in vocab.values()}
        base -= {vocab[a + b] for a, b in merges}
        self.state = dict.fromkeys(base, start)
        owners = {id(start): len(base) + 1}  # the start state itself is never changed
        for r, (a, b) in enumerate(merges):
            u, v, w = vocab[a], vocab[b], vocab[a + b]
            self.rank[w], self.left[w] = r, u
            led = self.state[v]  # where w leads: v's state before the split
            old = self.state[u]
            if owners[id(old)] > 1:
                owners[id(old)] -= 1
                old = dict(old)
                owners[id(old)] = 1
                self.state[u] = old
            if u == v and led is old:  # the copy loses the arc, the old one stays for w
                old = dict(old)
                self.state[u] = old
                owners[id(old)] = 1
                owners[id(led)] -= 1
            old.setdefault(v, r)
            self.state[w] = led
            owners[id(led)] += 1
        self.start = start
        self.label = {i: t for t, i in vocab.items()}
        #: (last token, or -1 at the start; next token) packed -> does the arc leave the state?
        self.arcs: dict[int, bool] = {}

    def has_arc(self, state: dict[int, int], token: int) -> bool:
        """Does an arc for ``token`` leave ``state`` in the finished automaton?"""
        before = len(self.rank) + 1
        while True:
            if state.get(token, before) < before:
                return False
            if token not in self.rank:
                return True
            before, token = self.rank[token] + 1, self.left[token]

    def arc_after(self, last: int, token: int) -> bool:
        """A new entry of the transition table: does an arc for ``token`` leave the state after ``last``?"""
        if len(self.arcs) >= ARCS_KEPT:
            self.arcs.clear()
        found = self.has_arc(self.start if last < 0 else self.state[last], token)
        self.arcs[last << 32 | token] = found
        return found

    def add_word_tokens(self, spelt: dict[int, str], end: str = "") -> None:
        """The spelling of each token; those with the suffix ``end`` stand at a word's end only."""
        ends = {i: t[:-len(end)] for i, t in spelt.items() if end and t.endswith(end) and t != end}
        self.inner = {t: i for i, t in spelt.items() if i not in ends}
        self.final = {t: i for i, t in ends.items()} if end else self.inner
        self.longest = max(map(len, self.final), default=0)
        lengths: dict[str, set[int]] = {}
        for t in self.inner:
            if len(t) > 2:
                lengths.setdefault(t[:3], {1, 2}).add(len(t))
        #: first three symbols -> lengths of the tokens inside words that start with them, longest first
        self.lengths = {t: tuple(sorted(found, reverse=True)) for t, found in lengths.items()}

    def encode(self, word: str) -> list[int]:
        """The one accepted path over the symbols of ``word``.

        Longest arcs are tried first.  A prefix has one accepted path, so a
        position from which the end cannot be reached is never entered twice.
        """
        n, at, last, nth = len(word), 0, -1, -1  # nth: the length tried next; -1 is all that is left of the word
        inner, arcs, lengths, longest = self.inner, self.arcs, self.lengths, self.longest
        dead: set[int] = set()
        path: list[tuple] = []
        while at < n:
            if nth < 0:
                nth = 0
                token = self.final.get(word[at:]) if n - at <= longest else None
                if token is not None:
                    found = arcs.get(last << 32 | token)
                    if found or found is None and self.arc_after(last, token):
                        path.append((token, at, last, nth))
                        break
            tried = lengths.get(word[at:at + 3], (2, 1))
            while nth < len(tried):
                to = at + tried[nth]
                nth += 1
                if to < n and to not in dead:
                    token = inner.get(word[at:to])
                    if token is not None:
                        found = arcs.get(last << 32 | token)
                        if found or found is None and self.arc_after(last, token):
                            path.append((token, at, last, nth))
                            at, last, nth = to, token, -1
                            break
            else:
                dead.add(at)
                _, at, last, nth = path.pop()
        return [p[0] for p in path]


class BpeCodec:
    """Encoder and decoder for a byte-level vocabulary with word ends, from a tokenizers ``.json`` file."""

    def __init__(self, data: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        spec = json.loads(data)
        model = spec["model"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.machine = MergeAutomaton(model["vocab"], merges)
        self.machine.add_word_tokens(self.machine.label, model.get("end_of_word_suffix") or "")
        tok = Tokenizer.from_buffer(data)
        self.normalize = tok.normalizer.normalize_str if tok.normalizer else str
        self.split = tok.pre_tokenizer.pre_tokenize_str
        text = json.dumps([spec["normalizer"], spec["pre_tokenizer"]])
        self.plain = json.dumps(_KNOWN_SPLIT) in text and '"Lowercase"' in text and '"ByteLevel"' in text
        self.special = {a["content"]: a["id"] for a in spec["added_tokens"]}
        self.label = self.machine.label | {i: t for t, i in self.special.items()}
        self.special_at = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.words: dict[str, bytes] = {}
        self.words_before: dict[str, bytes] = {}
        self.segments: dict[str, bytes] = {}
        self.segments_before: dict[str, bytes] = {}

    def _word(self, word: str) -> bytes:
        ids = self.words.get(word)
        if ids is None:
            ids = self.words_before.get(word)
            if ids is None:
                ids = _packed(self.machine.encode(word))
            if len(word) <= 64:
                self.words[word] = ids
                if len(self.words) > WORDS_KEPT // 2:
                    self.words_before, self.words = self.words, {}
        return ids

    def _words(self, text: str) -> list[str]:
        """The normalised, pre-split words of a text without special tokens.

        Printable ASCII needs no library call where the file splits in the
        known way: its normal form is lower case and its bytes stand for
        themselves.
        """
        if self.plain and text.isascii() and text.isprintable():
            low = text.lower()
            return [low] if low.isalpha() else _ASCII_WORDS.findall(low)
        return [w for w, _ in self.split(self.normalize(text))]

    def _segment(self, text: str, marked: bool) -> bytes:
        """Ids of a text; ``marked``: it may hold special tokens."""
        if not marked:
            return b"".join(map(self._word, self._words(text)))
        ids = b""
        for part in self.special_at.split(text):
            if part in self.special:
                ids += _packed([self.special[part]])
            elif part:
                ids += b"".join(map(self._word, self._words(part)))
        return ids

    def _new(self, segments: set[str], marked: bool) -> dict[str, bytes]:
        """Ids of segments not met before; those beyond ASCII go through the library together, split by spaces."""
        new, others = {}, []
        for part in segments:
            if part.isascii() or not part.isprintable() or marked and any(t in part for t in self.special):
                new[part] = self._segment(part, marked)
            else:
                others.append(part)
        normal = self.normalize(" ".join(others))
        pieces = normal.split(" ")
        if len(pieces) != len(others):  # the normal form has spaces of its own, or there are none to do
            return new | {part: self._segment(part, marked) for part in others}
        words = iter(self.split(normal))
        word, span = next(words, (None, None))
        end = -1
        for part, piece in zip(others, pieces):
            end += 1 + len(piece)
            ids = b""
            while span and span[0] < end:
                ids += self._word(word)
                word, span = next(words, (None, None))
            new[part] = ids
        return new

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers.

        Spaces and line feeds are dropped before words are split, so the
        segments between them are encoded independently and remembered.
        """
        known, parts = self.segments, text.replace("\n", " ").split(" ")
        asked = set(parts).difference(known)
        if asked:
            before = self.segments_before
            new = {p: before[p] for p in asked if p in before}
            new |= self._new(asked.difference(new), any(t in text for t in self.special))
            known |= new
        ids = b"".join(map(known.__getitem__, parts))
        for part in asked:
            if len(part) > 64:
                del known[part]
        if len(known) > SEGMENTS_KEPT // 2:
            self.segments_before, self.segments = known, {}
        return ids

    def decode(self, ids: bytes) -> str:
        """The arcs' labels, joined as the library joins tokens when a file names no decoder."""
        label = self.label
        return " ".join([label[i] for i in memoryview(ids).cast("I")])


def _packed(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    found = array("I", ids)
    if sys.byteorder == "big":
        found.byteswap()
    return found.tobytes()


def _codec(data: bytes) -> BpeCodec:
    """Kept with its caches until the worker turns to another stage."""
    return kept((BpeCodec, data), lambda: BpeCodec(data))


def encode(docs: DataFrame, tokenizer: str, text_col: str = "text", decoded: bool = True,
           carry: list[str] | None = None) -> DataFrame:
    """The columns ``carry`` (default: all) in a struct ``row``, with ids (packed little-endian uint32), n_tokens and decoded.

    Only the text and the carried columns travel to Python; nothing is shuffled.
    """
    spark = docs.sparkSession
    python_ready(spark)
    sent = spark.sparkContext.broadcast(file_bytes(tokenizer))
    row = F.struct("*") if carry is None else F.struct(*carry)
    rows = docs.select(row.alias("row"), text_or_empty(text_col).alias("text"))
    schema = T.StructType([rows.schema["row"], T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids", T.BinaryType())]
                          + [T.StructField("decoded", T.StringType())] * decoded)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(sent.value)
        for b in steps(batches):
            ids = [codec.encode(t.as_py()) for t in b.column(1)]
            cols = [b.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())]
            if decoded:
                cols.append(pa.array(map(codec.decode, ids), pa.string()))
            yield pa.RecordBatch.from_arrays(cols, schema.names)

    return rows.mapInArrow(tidy(run, keep=True), schema)
