"""Operator 10: license scans by an exact set-similarity join.

Text blocks are joined with license templates by containment: the share of a
template's distinct words that a block holds must reach the threshold.  Blocks
are all windows of the text's words, line feeds or not, that are as long as the
template with as many words put in as the threshold lets be left out.  Of
templates of at most ``SHORT`` words a block must also hold every word that no
template of another label has, else "Released under the BSD License" is MIT's.

Words are ordered by how often they stand in all documents, rarest first.  A
text with a block that contains a template to the threshold must hold one of
its first ``|T| - need + 1`` words (prefix filter), at least ``need`` template
words (length filter), and at the first word that meets, enough words must
remain on both sides (positional filter).  In texts that are left, a window
moves over the places of the template's words; overlapping finds are one span.

The templates are a fixed small list, so their index travels to the blocks;
nothing else leaves its row.  Phrases are counted in the same pass.

Defined results: null text counts as empty (no words, no labels, score 0);
each row gives a row, also repeated ones; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tessera.llm.common import python_ready, steps, text_or_empty

# Phrases that are counted, and templates, with their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
TEMPLATES = (
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files, to deal in the Software without restriction"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the "
            "GNU General Public License as published by the Free Software Foundation"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted "
            "provided that the following conditions are met"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("reserved", "All rights reserved"),
)

#: Templates of at most so many distinct words are told by the words that only their label has.
SHORT = 8

_WORD = bytes(b if 0x61 <= b <= 0x7A or 0x30 <= b <= 0x39 or b >= 0x80 else
              b + 32 if 0x41 <= b <= 0x5A else 32 for b in range(256))


def folded(text: str) -> bytes:
    """The text's bytes with A-Z lower-cased and all that is no word made a space."""
    return text.encode("utf-8", "surrogatepass").translate(_WORD)


class TemplateIndex:
    """Templates as sets of word ranks with an index of their prefixes."""

    def __init__(self, templates, threshold: float, frequency: Mapping[bytes, int]):
        lists = [(label, folded(text).split()) for label, text in templates]
        words = sorted({w for _, t in lists for w in t}, key=lambda w: (frequency.get(w, 0), w))
        self.rank = {w: i for i, w in enumerate(words)}
        self.words = frozenset(words)
        self.templates = []
        self.prefix: dict[int, list[tuple[int, int]]] = {}
        for k, (label, listed) in enumerate(lists):
            ranks = sorted(self.rank[w] for w in set(listed))
            need = max(1, math.ceil(threshold * len(ranks) - 1e-9))
            width = math.ceil(len(listed) / threshold - 1e-9) if threshold > 0 else len(listed)
            others = {w for la, t in lists if la != label for w in t}
            telling = {self.rank[w] for w in set(listed) - others} if len(ranks) <= SHORT else set()
            self.templates.append((label, frozenset(ranks), need, width, telling))
            for at, r in enumerate(ranks[:len(ranks) - need + 1]):
                self.prefix.setdefault(r, []).append((k, at))

    def candidates(self, words: list[bytes]) -> list[int]:
        """Templates of which the text as a whole holds enough words."""
        ranks = sorted({self.rank[w] for w in self.words.intersection(words)})
        seen: set[int] = set()
        out = []
        own = set(ranks)
        for j, r in enumerate(ranks):
            for k, i in self.prefix.get(r, ()):
                if k not in seen:
                    seen.add(k)
                    _, template, need, _, telling = self.templates[k]
                    if need <= min(len(template) - i, len(ranks) - j):
                        if len(template & own) >= need and telling <= own:
                            out.append(k)
        return sorted(out)

    def spans(self, words: list[bytes]) -> list[tuple[str, int, int, float]]:
        """(label, first word, last word, largest containment) of all blocks that contain a template, overlaps merged."""
        found: list[tuple[str, int, int, float]] = []
        candidates = self.candidates(words)
        if not candidates:
            return found
        places = [(p, self.rank[w]) for p, w in enumerate(words) if w in self.words]
        for k in candidates:
            label, template, need, width, telling = self.templates[k]
            own = [x for x in places if x[1] in template]
            held: Counter[int] = Counter()
            first, start = 0, len(found)
            for p, r in own:  # the window's last word
                held[r] += 1
                while own[first][0] <= p - width:
                    held[own[first][1]] -= 1
                    if not held[own[first][1]]:
                        del held[own[first][1]]
                    first += 1
                if len(held) >= need and telling <= held.keys():
                    begin, share = own[first][0], len(held) / len(template)
                    if len(found) > start and begin <= found[-1][2]:
                        found[-1] = (label, found[-1][1], p, max(share, found[-1][3]))
                    else:
                        found.append((label, begin, p, share))
        return found


def word_frequencies(docs: DataFrame, words: frozenset[bytes], text_col: str = "text") -> dict[bytes, int]:
    """How often each template word stands in all documents (one row per template word)."""
    rows = docs.select(text_or_empty(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count: Counter[bytes] = Counter()
        for b in steps(batches):
            for text in b.column(0).to_pylist():
                count.update(w for w in folded(text).split() if w in words)
        yield pa.RecordBatch.from_pydict({"word": pa.array(list(count), pa.binary()),
                                          "n": pa.array(list(count.values()), pa.int64())})

    found = rows.mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return {bytes(r["word"]): r["n"] for r in found.collect()}


def phrase_places(words: list[bytes], phrases: Mapping[str, str]) -> list[tuple[int, str]]:
    """(start word, label) of all places where a phrase's words stand consecutively."""
    line, out = b" " + b" ".join(words) + b" ", []
    for phrase, label in phrases.items():
        at = line.find(sought := b" " + phrase.encode() + b" ")
        while at >= 0:
            out.append((line.count(b" ", 0, at), label))
            at = line.find(sought, at + 1)
    return sorted(out)


def scan(docs: DataFrame, templates=TEMPLATES, phrases: Mapping[str, str] = PHRASES, threshold: float = 0.8,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, blocks.

    ``blocks``: (label, first_word, last_word, containment) of every span found.
    ``score``: 1 where a phrase stands, else the largest containment found, else 0.
    """
    python_ready(docs.sparkSession)
    plain = TemplateIndex(templates, threshold, {})
    index = TemplateIndex(templates, threshold, word_frequencies(docs, plain.words, text_col))
    rows = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    block = T.StructType([T.StructField("label", T.StringType()), T.StructField("first_word", T.LongType()),
                          T.StructField("last_word", T.LongType()), T.StructField("containment", T.DoubleType())])
    schema = T.StructType(
        [rows.schema["doc_id"]] + [T.StructField(n, T.LongType()) for n in ("n_words", "n_base", "first_word", "last_word")]
        + [T.StructField("base_labels", T.StringType()), T.StructField("labels", T.StringType()),
           T.StructField("score", T.DoubleType()), T.StructField("blocks", T.ArrayType(block))])
    rare = re.compile(b"|".join(re.escape(max(p.split(), key=len).encode()) for p in phrases))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for b in steps(batches):
            out: list[dict] = []
            for text in b.column(1).to_pylist():
                data = folded(text)
                words = data.split()
                blocks = [{"label": la, "first_word": a, "last_word": z, "containment": c}
                          for la, a, z, c in index.spans(words)]
                base = phrase_places(words, phrases) if rare.search(data) else []
                of_base = {la for _, la in base}
                out.append({
                    "n_words": len(words), "n_base": len(base),
                    "first_word": base[0][0] if base else None, "last_word": base[-1][0] if base else None,
                    "base_labels": ",".join(sorted(of_base)),
                    "labels": ",".join(sorted(of_base | {x["label"] for x in blocks})),
                    "score": 1.0 if base else max((x["containment"] for x in blocks), default=0.0),
                    "blocks": blocks})
            cols = [b.column(0)] + [pa.array([r[f.name] for r in out], f.type) for f in list(arrow)[1:]]
            yield pa.RecordBatch.from_arrays(cols, schema=arrow)

    return rows.mapInArrow(run, schema)
