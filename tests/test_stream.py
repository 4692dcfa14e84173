"""Streaming: micro-batch ingestion, stateful histogram (= batch form), replay, loop, registry."""

import pytest

from tessera.functions.grid import Grid
from tessera.operators import histogram as H
from tessera.operators import state as S
from tessera.plans import registry as REG
from tessera.plans.points import load_points
from tessera.plans.q_curve import curve_segments
from tessera.session import scratch_path
from tessera.streaming import adaptive as AD
from tessera.streaming import state as ST
from tests.conftest import SF_SMALL

G = Grid(8)


def _cells(batch):
    return H.split_domain(H.assign_cells(batch, G), G)[0]


def test_stream_equals_batch_and_replay_is_idempotent(spark):
    pts = load_points(spark, SF_SMALL)
    src = scratch_path(spark, "src")
    days = ST.stage_batches(pts, src)
    assert len(days) == pts.select("batch").distinct().count()
    base = scratch_path(spark, "st")
    got = ST.stateful_hist_stream(spark, src, base + "/out", base + "/ckpt", pts.schema, G, _cells)
    want = S.batch_history(_cells(pts), G).select("batch", "idx", "n_points", "dh", "sat", "h_after")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    # running the same stream again (same checkpoint) changes nothing
    again = ST.stateful_hist_stream(spark, src, base + "/out", base + "/ckpt", pts.schema, G, _cells)
    assert again.exceptAll(want).count() == 0 and again.count() == want.count()


def test_ingest_micro_batches(spark):
    pts = load_points(spark, SF_SMALL)
    src = scratch_path(spark, "src")
    ST.stage_batches(pts, src)
    base = scratch_path(spark, "ing")
    t = ST.ingest_micro_batches(spark, src, base + "/t", base + "/c", pts.schema)
    assert t.select("epoch").distinct().count() == pts.select("batch").distinct().count()
    assert t.select(*pts.columns).exceptAll(pts).count() == 0


def test_adaptive_loop_runs_and_lowers_weights(spark):
    pts = load_points(spark, SF_SMALL)
    rounds = pts.select("seq", "batch")
    days = [r[0] for r in rounds.select("batch").distinct().orderBy("batch").collect()][:4]
    out = AD.adaptive_hist(spark, rounds, curve_segments(spark, SF_SMALL), G,
                           scratch_path(spark, "ad"), days)
    rows = out.collect()
    assert len(rows) == 64 and rows[0].rounds_run >= 1
    assert set(r.weight for r in rows) <= {1.0, 100.0}


def test_registry_unknown_and_outputs(spark):
    with pytest.raises(REG.UnknownAnalysis):
        REG.run_analysis(spark, "NoSuchAnalysis")
    REG.register_analysis("Bad", lambda s, i, st: {"a": s.range(1)}, outputs=["a", "b"])
    with pytest.raises(KeyError):
        REG.run_analysis(spark, "Bad")
    st = REG.run_analysis(spark, "Init")
    assert st["h"].count() == 64 * 64


def test_stream_with_several_files_per_trigger(spark):
    """Micro-batches holding several days (or parts of days) give the same history."""
    pts = load_points(spark, SF_SMALL)
    src = scratch_path(spark, "src")
    ST.stage_batches(pts, src, order="seq")
    base = scratch_path(spark, "st")
    got = ST.stateful_hist_stream(spark, src, base + "/out", base + "/ckpt", pts.schema, G, _cells,
                                  files_per_trigger=4)
    want = S.batch_history(_cells(pts), G).select("batch", "idx", "n_points", "dh", "sat", "h_after")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_expand_children_chunks(spark):
    from tessera.operators import records as R
    parents = spark.createDataFrame([(1, 0, 10), (2, 1, 0), (3, 1, 3)], "id long, rank int, natoms int")
    kids = R.expand_children(parents, chunk=4)
    assert kids.count() == 13
    assert sorted(r.num for r in kids.where("timestep = 1").collect()) == list(range(10))


def test_adaptive_loop_resumes(spark):
    pts = load_points(spark, SF_SMALL)
    rounds = pts.select("seq", "batch")
    days = [r[0] for r in rounds.select("batch").distinct().orderBy("batch").collect()][:3]
    seg = curve_segments(spark, SF_SMALL)
    work = scratch_path(spark, "ad")
    first = AD.adaptive_hist(spark, rounds, seg, G, work, days, max_rounds=2).collect()
    full = AD.adaptive_hist(spark, rounds, seg, G, work, days).collect()     # resumes at round 3
    fresh = AD.adaptive_hist(spark, rounds, seg, G, scratch_path(spark, "ad"), days).collect()
    key = lambda rows: sorted((r.xmin, r.ymin, r.weight) for r in rows)
    assert key(full) == key(fresh)
    assert first[0].rounds_run == 2 and full[0].rounds_run == fresh[0].rounds_run
