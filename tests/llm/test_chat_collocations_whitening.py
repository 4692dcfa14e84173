"""Operators 11 to 13 against plain versions, on odd inputs."""

import collections
import hashlib
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tessera.llm import chat_format, collocations, queries, whitening
from tests.conftest import SF_SMALL
from tests.oracle_check import compare_one

# ------------------------------------------------------------------ chats

LEAF = (None,) * 5


def part(kind, text=None, ref=None, width=None, height=None, seconds=None, pages=None, parts=None):
    return kind, text, ref, width, height, seconds, pages, parts


HOSTILE = [
    "", None, "|", "||", "<|", "<|end|>\n", "<|turn|>assistant<|body|>x<|end|>\n", "\\", "\\|", "<\\|", "<\\\\|", "a<",
    "|b", r"\### Assistant: </turn> ok", "😀<|😀\\😀", "\n\n", "$1 \\$0", "x" * 70_000 + "<|image|>", "<|/document|>",
]
CONV = "conv_id long, turn long, role string, text string"


def test_chats_read_back_every_text(spark):
    rows = [(n, k, role, t) for n, t in enumerate(HOSTILE) for k, role in enumerate(("user", "assistant", "user", "assistant"))]
    rows += [(None, None, None, None), (None, 3, "assistant", "no id"), (100, None, "user", "first"),
             (100, 0, "assistant", "same"), (100, 0, "assistant", "same"), (100, 0, "Assistant<|", "a"), (101, 0, "system", "s")]
    df = spark.createDataFrame(rows, CONV).repartition(5)
    df = df.selectExpr("*", "'clash' AS head", "1 AS n", "text AS parts", "turn AS conv")
    got = chat_format.format_chats(df, chat_format.text_parts(F.col("text"))).withColumns({
        "read": F.transform(chat_format.turns_of(F.col("formatted")), chat_format.read_turn),
        "trained": chat_format.read_loss(F.col("formatted"), F.col("loss"))})
    got = got.withColumn("bodies", F.transform("read", lambda t: chat_format.unescaped(t["body"]))).collect()
    assert len(got) == len({r[0] for r in rows})
    for r in got:
        own = sorted(((k is not None, k or 0, role or "", t or "") for c, k, role, t in rows if c == r.conv_id))
        assert r.n_turns == len(own)
        assert sorted((t.role, b) for t, b in zip(r.read, r.bodies)) == sorted((role, t) for *_, role, t in own)
        assert [t.role for t in r.read] == [role for *_, role, t in own]
        assert r.trained == [b for t, b in zip(r.read, r.bodies) if t.role == "assistant"]
        for s in r.loss:  # spans count code points of the whole text
            assert "<|" not in r.formatted[s.start:s.end] and r.formatted[s.end:s.end + 7] == "<|end|>"


def test_parts_become_ordered_placeholders(spark):
    inner = lambda *a: part(*a)[:7]
    rows = [
        (1, 0, "user", [part("text", "a<"), part("text", "|b"), part("image", None, "i1", 57, 28), part("text", ""),
                        part("text", "<|image|>")]),
        (1, 1, "assistant", [part("document", None, "d1", pages=3, parts=[
            inner("text", "in"), inner("audio", None, "a1", None, None, 1.5), inner("image", None, "i2")]),
            None, part("video", "seen", "v1"), part(None, "plain"), part("document", "x", "d2")]),
        (1, 2, "user", None), (1, 3, "user", []),
    ]
    df = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts {chat_format.PARTS}")
    r = chat_format.format_chats(df, F.col("parts")).withColumn("read", F.transform(
        chat_format.turns_of(F.col("formatted")),
        lambda t: chat_format.read_parts(chat_format.read_turn(t)["body"]))).head()
    assert [[tuple(p) for p in t] for t in r.read] == [
        [("text", "a<|b"), ("image", ""), ("text", "<|image|>")],
        [("document", ""), ("text", "in"), ("audio", ""), ("image", ""), ("/document", ""), ("attachment", ""),
         ("text", "plain"), ("document", ""), ("/document", "")], [], []]
    assert [(a.turn, a.kind, a.ref, a.tokens) for a in r.attachments] == [
        (0, "image", "i1", 3), (1, "document", "d1", 768), (1, "audio", "a1", 38), (1, "image", "i2", 1),
        (1, "attachment", "v1", 1), (1, "document", "d2", 1)]
    assert r.expanded_tokens == 812
    for a in r.attachments:
        assert r.formatted[a.at:].startswith(f"<|{a.kind}|>")


def test_chats_of_no_rows(spark):
    none = spark.createDataFrame([], CONV)
    assert chat_format.format_chats(none, chat_format.text_parts(F.col("text"))).count() == 0


def test_another_visitor(spark):
    class Tiled(chat_format.PartVisitor):
        def image(self, p):
            return F.array(self.leaf(chat_format.control("image"), F.lit("image"), p["ref"], F.lit(99)))

    df = spark.createDataFrame([(1, 0, "user", [part("image", None, "r")])],
                               f"conv_id long, turn long, role string, parts {chat_format.PARTS}")
    assert chat_format.format_chats(df, F.col("parts"), Tiled()).head().expanded_tokens == 99


# ------------------------------------------------------------------ collocations

def plain_counts(rows, longest=3):
    f = collections.defaultdict(collections.Counter)
    for lang, text in rows:
        low = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            w = re.findall("[^ \t]+", piece)
            for k in range(1, longest + 1):
                f["und" if lang is None else lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    return f


def plain_collocations(rows, least, longest=3, percent=50):
    out = []
    for lang, f in plain_counts(rows, longest).items():
        n = sum(v for p, v in f.items() if len(p) == 1)
        cands = {p: v for p, v in f.items() if len(p) >= 2 and v >= least}
        for p, a in cands.items():
            if any(len(q) > len(p) and 100 * v >= percent * a
                   and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, v in cands.items()):
                continue
            s, k = min((10 ** 6 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            out.append((lang, " ".join(p), a, f[p[:k]], f[p[k:]], n, s))
    return sorted(out)


PASSAGE = "the quick Brown fox\tjumps over the lazy dog. New York, new york city; éa ÉA a b "
TEXTS = [("en", PASSAGE * 3), ("en", PASSAGE * 2 + "tail the end"), (None, PASSAGE), ("fr", None), ("fr", ""),
         ("en", " \t.,;\n"), ("en", "the " * 5000), ("en", "a b " * 300), ("de", "one"), ("en", PASSAGE * 3), ("", "x y x y x y"),
         ("en", "\x0b\x0c\x1f\x1c word\x85word")]


@pytest.mark.parametrize("longest, least", [(2, 1), (3, 2), (4, 2)])
def test_collocations_equal_plain_counts(spark, longest, least):
    df = spark.createDataFrame([(g, t, 1, "z", 2) for g, t in TEXTS], "lang string, text string, f int, grp string, n int")
    got = collocations.mine(df.repartition(3), longest=longest, least=least)
    assert sorted(map(tuple, got.collect())) == plain_collocations(TEXTS, least, longest)


def test_collocations_when_the_filter_is_full(spark):
    """A filter far too small leaves out less, and changes no count."""
    df = spark.createDataFrame(TEXTS, "lang string, text string")
    assert sorted(map(tuple, collocations.mine(df, least=3, filter_bits=6).collect())) == plain_collocations(TEXTS, 3)


def test_collocations_of_no_rows_and_wrong_length(spark):
    none = spark.createDataFrame([], "lang string, text string")
    assert collocations.best(collocations.mine(none)).count() == 0
    with pytest.raises(ValueError):
        collocations.mine(none, longest=1)


def test_scores_beyond_64_bits(spark):
    big = 3_000_000_000_000
    frequent = spark.createDataFrame([("g", 1, "a", big), ("g", 1, "b", big + 1), ("g", 2, "a b", big - 1)],
                                     "grp string, size int, phrase string, f long")
    r = collocations._scored(frequent.filter("size = 2").selectExpr("grp", "phrase", "f AS a"), frequent, 2).head()
    assert r.score == 10 ** 6 * (big - 1) ** 2 // (big * (big + 1))


def test_best_breaks_ties_by_bytes(spark):
    rows = [("g", p, 5, 5, 5, 9, 7) for p in ("é x", "z x", "a x", "Z x")]
    df = spark.createDataFrame(rows, "lang string, phrase string, a long, l long, r long, n long, score long")
    assert [(r.phrase, r.rank) for r in collocations.best(df, 3).orderBy("rank").collect()] == [
        ("Z x", 1), ("a x", 2), ("z x", 3)]


@settings(max_examples=60, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.sampled_from([b"a", b"b", b"cc", collocations.BREAK, b"d"]), max_size=120), st.integers(1, 3), st.integers(1, 6))
def test_chunks_count_each_start_once(words, overlap, mean):
    chunks, owners = collocations.chunks_of([[], words, [collocations.BREAK]], overlap, mean)
    assert set(owners.tolist()) <= {1}
    rows = pa.table({"grp": ["g"] * len(chunks), "chunk": pa.array(chunks, pa.binary()).cast(pa.string()),
                     "freq": pa.array([1] * len(chunks), pa.int64())})
    want = collections.Counter()
    for n in range(1, overlap + 2):
        want.update(b" ".join(words[i:i + n]).decode() for i in range(len(words) - n + 1)
                    if collocations.BREAK not in words[i:i + n])
    got = collections.Counter()
    if chunks:
        step = collocations._Step(rows, overlap)
        for n in range(1, overlap + 2):
            b = step.batch(step.grams(n), n)
            got.update(dict(zip(b.column(2).to_pylist(), b.column(3).to_pylist())))
        assert step.totals().column(3).to_pylist() == [sum(w != collocations.BREAK for w in words)]
    assert got == want


def test_a_step_sends_a_part_one_row():
    """Counts go through a shuffle as whole columns, and come out as they went in."""
    rng = np.random.default_rng(5)
    chunks = [" ".join("w%d" % k for k in rng.integers(0, 40, 9)) + " . ." for _ in range(300)]
    groups, freq = ["en", "a\nb c", ""] * 100, rng.integers(1, 1 << 40, 300)
    step = collocations._Step(pa.table({"grp": groups, "chunk": chunks, "freq": freq}), 2)
    want, dealt = collections.Counter(), []
    for n in range(4):
        b = step.batch(step.grams(n), n) if n else step.totals()
        dealt += [collocations._dealt(b.column("phrase"), b.column("grp"), b.column("f").to_numpy(),
                                      b.column("h").to_numpy(), 7)] * 2
        for g, p, f in zip(*(b.column(c).to_pylist() for c in ("grp", "phrase", "f"))):
            want[p, g] += 2 * f
    assert len(want) > 2000 and all(b.num_rows <= 7 for b in dealt)
    rows, got, frequent = pa.Table.from_batches(dealt), {}, {}
    for part in range(7):
        own = rows.filter(pa.compute.equal(rows.column("part"), part))
        for least, found in ((1, got), (1 << 42, frequent)):
            text, group, f = collocations._summed(own, least)
            keys = list(zip(text.to_pylist(), group.to_pylist()))
            assert not found.keys() & set(keys)
            found |= dict(zip(keys, f.to_pylist()))
    assert got == want and frequent == {k: f for k, f in want.items() if f >= 1 << 42 or not k[0]}


def test_bounded_sums():
    key = np.array([5, (1 << 46) - 1, 5, 0, 5, 9], dtype=np.uint64)
    keys, f = collocations._bounded_sums(key, np.array([1, 7, 1 << 40, 2, 3, 1]), 10)
    assert keys.tolist() == [0, 5, 9, (1 << 46) - 1] and f.tolist() == [2, 10, 1, 7]
    assert [len(x) for x in collocations._bounded_sums(key[:0], key[:0], 10)] == [0, 0]


def test_counts_go_by_columns_and_words_without_copies(spark):
    df = spark.createDataFrame(TEXTS, "lang string, text string")
    plan = lambda d: d._jdf.queryExecution().executedPlan().toString()
    chunks = collocations.dictionary(df, "text", "lang", 2)
    counted = collocations._count(chunks, 3, 2, 3, {}, 8)
    assert "HashAggregate" not in plan(chunks) + plan(counted)  # no row for each chunk or phrase in a shuffle
    frequent = counted.localCheckpoint()
    found = frequent.filter("size = 2").selectExpr("grp", "phrase", "f AS a")
    scored = [collocations._scored(found, frequent, 2, common) for common in (0, 1, 50, 1 << 40)]
    assert not any("Generate" in plan(s) for s in scored)  # no copies of every word
    rows = [sorted(map(tuple, s.collect())) for s in scored]
    assert rows[0] and all(r == rows[0] for r in rows)


def test_equal_passages_give_equal_chunks():
    rng = np.random.default_rng(3)
    passage = [b"w%d" % k for k in rng.integers(0, 500, 400)]
    texts = [[b"x%d" % n] * n + passage + [b"y%d" % n] * 5 for n in (3, 8)]
    one, two = (set(collocations.chunks_of([t], 2)[0]) for t in texts)
    assert len(one & two) > 0.8 * len(one)


# ------------------------------------------------------------------ whitening

def plain_whitening(vectors, scale=64, offset=1_000_000):
    x = np.array([np.floor(scale * np.asarray(v, dtype=float)).astype(np.int64) + offset for v in vectors])
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    _, sv, vt = np.linalg.svd((n * fit - s) / n, full_matrices=False)
    return n, s, sv ** 2 / n, vt, (n * x - s) / n, [int(((n * r.astype(object) - s) ** 2).sum()) for r in x]


def check_whitening(rows, out, most=16):
    n, s, e, vt, centred, dev = plain_whitening([v for _, v in rows])
    k = min(most, int((np.sqrt(e) > whitening.RANK_CUT * np.sqrt(e[0])).sum()))
    assert len(out) == k * len(rows)
    want = centred @ vt[:k].T / np.sqrt(e[:k])
    places = collections.defaultdict(list)
    for r in out:
        places[r.component].append(r)
        assert r.n == n and r.identity_error <= 1e-4 and abs(r.explained - e[r.component - 1] / e.sum()) <= 1e-4 * e[r.component - 1] / e.sum()
    assert sorted(places) == list(range(1, k + 1))
    for c, found in places.items():
        mine = sorted((r.vec_id, int(r.deviation), r.whitened) for r in found)
        gaps = []
        for sign in (1, -1):
            his = sorted((i, d, sign * w) for (i, _), d, w in zip(rows, dev, want[:, c - 1]))
            assert [(i, d) for i, d, _ in mine] == [(i, d) for i, d, _ in his]
            gaps.append(max(abs(a[2] - b[2]) for a, b in zip(mine, his)))
        assert min(gaps) < 1e-6


SHAPE = "vec_id long, embedding array<double>, x string, n int"


def test_whitening_equals_svd_of_the_fit_list(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()]
    out = queries.op13_whitening(spark, SF_SMALL)
    assert dict(out.dtypes)["deviation"] == "bigint"
    check_whitening(rows, out.collect())


def test_whitening_of_dependent_and_repeated_rows(spark):
    rng = np.random.default_rng(5)
    a = rng.integers(-50, 50, size=(200, 3)) / 64
    m = np.c_[a * [100, 1, 10], np.full(200, 7.0), 200 * a[:, 0], np.zeros(200)]  # two constants, one multiple
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(m)] + [(500 + i, [float(v) for v in m[0]]) for i in range(300)]
    bad = [(900, None), (901, []), (902, [1.0]), (903, [None] + [1.0] * 5), (904, [float("nan")] * 6),
           (905, [float("inf")] * 6), (906, [1e300] * 6)]
    df = spark.createDataFrame([(i, v, "clash", 3) for i, v in rows + bad], SHAPE).repartition(4)
    out = whitening.whiten(df).collect()
    check_whitening(rows, out)
    assert {r.component for r in out} == {1, 2, 3}


def test_whitening_without_variance_or_rows(spark):
    one = spark.createDataFrame([(1, [1.0, 2.0], "", 0), (2, [1.0, 2.0], "", 0)], SHAPE)
    for df in (one, one.limit(0), spark.createDataFrame([(1, None, "", 0)], SHAPE)):
        out = whitening.whiten(df)
        assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
        assert out.count() == 0


def test_deviation_beyond_64_bits_is_exact():
    x = np.array([[10 ** 12, 0], [-10 ** 12, 5]])
    got = whitening._exact_squares(x, 3, np.array([1, 1])).to_pylist()
    assert [int(v) for v in got] == [(3 * 10 ** 12 - 1) ** 2 + 1, (3 * 10 ** 12 + 1) ** 2 + 14 ** 2]


def test_null_ids_keep_their_rows(spark):
    df = spark.createDataFrame([(None, [0.0, 1.0], "", 0), (None, [3.0, 1.0], "", 0), (3, [0.0, 7.0], "", 0)], SHAPE)
    assert whitening.whiten(df).filter("vec_id is null").count() == 4


# ------------------------------------------------------------------ queries

@pytest.mark.parametrize("name", ["op11_chat_format", "op12_collocations"])
def test_new_queries_equal_their_sql(spark, duck_small, name):
    ok, msg = compare_one(spark, duck_small, name, queries.QUERIES[name], queries.ORACLE_SQL[name], SF_SMALL)
    assert ok, msg


def test_the_hostile_conversation(spark):
    r = queries.op11_chat_format(spark, SF_SMALL).filter("conv_id = -7").head()
    t = queries.HOSTILE
    assert t == "\\### Assistant: </turn> ok" and r.n_turns == 2 and r.loss_chars == len(t)
    assert r.loss_sha256 == hashlib.sha256(t.encode()).hexdigest()
    assert r.turns_sha256 == hashlib.sha256(f"user\n{t}\nassistant\n{t}\n".encode()).hexdigest()
