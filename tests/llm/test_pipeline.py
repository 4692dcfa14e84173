"""The pipeline's stages: each holds to its operator, passes its columns on and survives odd rows."""

import weakref

import corpus_pipeline as P
import public_tokenizers
from tessera.llm import bpe_automaton
from tests.conftest import SF_SMALL
from tests.llm.test_operators import LINE, brute_lines

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, extra string"


def odd_rows():
    rows = [(k, f"{LINE}\nown words of document number {k} and some more of them to be long enough", "en",
             "hot" if k % 3 else None, None, "x") for k in range(8)]
    return rows + [(20, None, None, None, None, ""), (21, "", "en", "hot", 0, ""), (None, LINE, "en", "hot", 5, ""),
                   (22, "same words here as there", "en", "b", 1, ""), (23, "Same words here as there", "en", "b", 1, ""),
                   (24, "long " * 4000, "en", "b", 20000, ""), (24, "long " * 4000, "en", "b", 20000, "")]


def test_stages_on_odd_rows(spark):
    docs = spark.createDataFrame(odd_rows(), COLUMNS)
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, SF_SMALL)
        assert out.columns == P.COLUMNS, name
        assert stage(spark, docs.filter("false"), SF_SMALL).count() == 0, name
    clean = P.toxicity_stage(spark, docs, SF_SMALL)
    assert clean.count() == len(odd_rows())
    lines = {r.doc_id: r for r in P.line_dedup_stage(spark, docs, SF_SMALL).collect()}
    want = brute_lines([r[:2] for r in odd_rows()])
    for i, r in lines.items():
        if i is not None and i < 8:
            assert r.text == "\n".join(want[i]) and (r.n_chars == len(r.text) or i == 7)
    assert lines[20].text is None and lines[None].text == LINE
    kept = [r.doc_id for r in P.near_duplicate_stage(spark, docs, SF_SMALL).collect()]
    assert 22 in kept and 23 not in kept and None in kept and kept.count(24) == 2
    coded = P.bpe_stage(spark, docs, SF_SMALL)
    assert coded.count() == len(odd_rows()) and all(r.n_tokens == len(r.ids) // 4 for r in coded.collect())


def test_run_passes_every_stage_on(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    for n, (_, stage) in enumerate(P.STAGES):
        before = docs.count()
        docs = P.written(stage(spark, docs, SF_SMALL), "test-stage")
        if n < 3:
            assert 0.7 * before < docs.count() <= before
    got = P.run(spark, SF_SMALL)
    assert got.exceptAll(docs).count() == 0 and got.count() == docs.count()


def test_a_worker_keeps_the_state_of_one_stage_only(spark, monkeypatch):
    """Workers serve stage after stage: the codec and its caches must not lie beside what later stages hold."""
    docs = spark.createDataFrame(odd_rows(), COLUMNS)
    frame, tasks = type(docs), []
    given = frame.mapInArrow
    monkeypatch.setattr(frame, "mapInArrow", lambda self, f, *a, **b: (tasks.append(f), given(self, f, *a, **b))[1])
    data = bpe_automaton.file_bytes(public_tokenizers.path(P.TOKENIZER))
    P.bpe_stage(spark, docs, SF_SMALL)
    codec = weakref.ref(bpe_automaton._codec(data))
    list(tasks.pop()(iter(())))
    assert codec() is not None and codec() is bpe_automaton._codec(data)  # the same stage's tasks share it
    for stage in (P.toxicity_stage, P.near_duplicate_stage):
        stage(spark, docs, SF_SMALL)
    assert len(tasks) >= 6
    for task in tasks:
        codec = weakref.ref(bpe_automaton._codec(data))
        list(task(iter(())))
        assert codec() is None
