"""Operator 5 as registered: held-out recall, and scores against a plain version of weights, votes and calibration."""

import re
import zlib

import numpy as np
import pytest

from tessera.llm import queries, toxicity
from tests.conftest import SF_SMALL

SF_LARGE = SF_SMALL.replace("sf0.001", "sf0.1")


def kept_out(i):
    return i is not None and zlib.crc32(str(i).encode()) % 5 == 0


@pytest.mark.parametrize("sf, least_recall, most_marked", [(SF_LARGE, 0.9, 0.01)])
def test_held_out_toxic_documents_are_found(spark, sf, least_recall, most_marked):
    marks = {}
    for r in spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic").collect():
        if r.toxic is not None and kept_out(r.doc_id):
            marks[r.doc_id] = max(marks.get(r.doc_id, 0), r.toxic)
    got = queries.op5_toxicity(spark, sf).select("doc_id", "predicted").collect()
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    said = {r.doc_id: r.predicted for r in got}
    toxic = [said[i] for i, t in marks.items() if t == 1 and i in said]
    clean = [said[i] for i, t in marks.items() if t == 0 and i in said]
    assert sum(toxic) >= least_recall * len(toxic) and len(toxic) > 50
    assert sum(clean) <= most_marked * len(clean)


def plain_scores(rows, marks, weighting):
    """Dense vectors, all cosines, votes of the 15 nearest and all ties, isotonic fit by its min-max formula."""
    words = {i: [x for w in re.findall(r"\w+", t.lower()) for x in toxicity.terms_of(w, weighting.leads)] for i, t in rows}
    known = sorted(i for i in marks if not kept_out(i))
    terms = {x: k for k, x in enumerate(sorted({x for i in known for x in words[i]}))}
    counts = {i: np.zeros(len(terms)) for i, _ in rows}
    for i, ws in words.items():
        for x in ws:
            if x in terms:
                counts[i][terms[x]] += 1
    df = sum((c > 0).astype(int) for c in counts.values())
    held = [sum((counts[i] > 0).astype(int) for i in known if marks[i] == c) for c in (1, 0)]
    many = [sum(marks[i] == c for i in known) for c in (1, 0)]
    factor = np.log((1 + len(rows)) / (1 + df)) ** weighting.rarity
    if weighting.sure is not None:
        share = many[0] / sum(many)
        a, b = held[0] + share, held[1] + 1 - share
        odds = np.log(a * (many[1] + 2 * (1 - share) - b) / (b * (many[0] + 2 * share - a)))
        factor = factor * np.maximum(1, np.exp(weighting.sharp * (odds - weighting.sure * np.sqrt(1 / a + 1 / b))))
    vec = {}
    for i, c in counts.items():
        w = (np.where(c > 0, 1 + np.log(np.maximum(c, 1)), 0) if weighting.log_counts else c) * factor
        vec[i] = w / np.linalg.norm(w) if w.any() else w

    def vote(i, left_out):
        cos = np.array([0.0 if k == left_out else vec[i] @ vec[k] for k in known])
        kth = np.sort(cos)[-15] if len(cos) >= 15 else 0.0
        near = (cos >= kth - 1e-12) & (cos > 1e-15)
        return (cos[near] * np.array([marks[k] for k in known])[near]).sum() / cos[near].sum() if near.any() else None

    own = [(vote(i, i), marks[i]) for i in known]
    own = sorted((v, y) for v, y in own if v is not None)
    levels = sorted({v for v, _ in own})
    sums = [sum(y for v, y in own if v == x) for x in levels]
    sizes = [sum(v == x for v, _ in own) for x in levels]
    mean = lambda p, q: sum(sums[p:q + 1]) / sum(sizes[p:q + 1])
    fit = [max(min(mean(p, q) for q in range(k, len(levels))) for p in range(k + 1)) for k in range(len(levels))]
    corners, values, at = [], [], 0
    while at < len(levels):  # a stretch of one value is one corner at its mean vote
        to = at
        while to + 1 < len(levels) and abs(fit[to + 1] - fit[at]) < 1e-12:
            to += 1
        corners.append(sum(levels[j] * sizes[j] for j in range(at, to + 1)) / sum(sizes[at:to + 1]))
        values.append(fit[at])
        at = to + 1
    out = {}
    for i, _ in rows:
        v = vote(i, None)
        out[i] = min(0.49, many[0] / sum(many)) if v is None else min(1, max(0, 0.999 * np.interp(v, corners, values) + 0.001 * v))
    return out


@pytest.mark.parametrize("weighting", [toxicity.PLAIN, toxicity.MARKED])
def test_scores_equal_a_plain_version(spark, weighting):
    rng = np.random.default_rng(11)
    pool = [f"word{k}" for k in range(120)]
    rows = []
    for i in range(240):
        text = " ".join(rng.choice(pool, rng.integers(3, 30)))
        if i % 6 == 0:
            text += " " + " ".join(rng.choice(["nasty", "rotten", "vile"], rng.integers(1, 3)))
        rows.append((i, text))
    marks = {i: int(i % 6 == 0 or i % 31 == 0) for i in range(0, 240) if i % 4}
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame(list(marks.items()), "doc_id long, toxic int")
    got = {r.doc_id: r.score for r in toxicity.score(docs, labels, weighting=weighting).collect()}
    want = plain_scores(rows, marks, weighting)
    assert got.keys() == want.keys()
    assert max(abs(got[i] - want[i]) for i in want) < 1e-6


def test_odd_rows_with_the_registered_weighting(spark):
    rows = [(i, f"plain words number {i} stand here" + (" dreadful" if i % 3 == 0 else "")) for i in range(90)]
    rows += [(7, rows[7][1]), (7, rows[7][1]), (500, "calm " * 200_000 + "dreadful"), (501, "dreadful " * 150_000),
             (502, None), (503, ""), (504, "...\n\t"), (None, "dreadful"), (None, None)]
    docs = spark.createDataFrame([(i, t, 1.0, "x") for i, t in rows], "doc_id long, text string, score double, t string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(90)] + [(None, 1), (4, None)] * 2,
                                   "doc_id long, toxic int")
    got = toxicity.score(docs, labels, weighting=toxicity.MARKED).collect()
    assert len(got) == len(rows)
    said = {}
    for r in got:
        said.setdefault(r.doc_id, []).append((r.score, r.predicted))
    assert said[7] == said[7][:1] * 3  # repeated rows score alike
    assert said[500][0][1] == said[501][0][1] == 1
    assert said[502] == said[503] == said[504] and said[502][0][1] == 0
    assert sorted(p for _, p in said[None]) == [0, 1]


def test_one_class_among_the_learnt_rows(spark):
    """Toxic rows only among the held out ones: nothing to learn from."""
    rows = [(i, f"word{i} and others") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(kept_out(i))) for i in range(60)], "doc_id long, toxic int")
    got = toxicity.score(docs, labels, weighting=toxicity.MARKED).collect()
    assert len(got) == 60 and {(r.score, r.predicted) for r in got} == {(0.0, 0)}


@pytest.mark.parametrize("weighting", [toxicity.PLAIN, toxicity.MARKED])
def test_counts_do_not_depend_on_the_steps(monkeypatch, weighting):
    rng = np.random.default_rng(4)
    texts = [" ".join(rng.choice(["Alpha", "betas", "gamma,delta", "eeeeeee!", "x", "Σας", "ΟΔΟΣ"], rng.integers(0, 60))) for _ in range(30)]
    terms = sorted({x for t in texts[:20] for w in re.findall(r"\w+", t.lower()) for x in toxicity.terms_of(w, weighting.leads)})
    vocabulary = toxicity.Vocabulary(terms, weighting)

    def counted():
        sizes, t, n = vocabulary.counts(texts + [""])
        ends = np.cumsum(sizes)
        return [dict(zip(a.tolist(), b.tolist())) for a, b in zip(np.split(t, ends[:-1]), np.split(n, ends[:-1]))]

    place = {x: i for i, x in enumerate(terms)}
    want = []
    for t in texts + [""]:
        own = [x for w in re.findall(r"\w+", t.lower()) for x in toxicity.terms_of(w, weighting.leads) if x in place]
        want.append({place[x]: own.count(x) for x in set(own)})
    assert counted() == want
    monkeypatch.setattr(toxicity, "WORDS_AT_ONCE", 7)
    monkeypatch.setattr(toxicity, "CHARS_AT_ONCE", 11)
    assert counted() == want
