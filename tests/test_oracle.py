"""Every registered query against its DuckDB oracle (sf0.001), like the driver's gate."""

import pytest

from tessera.plans import catalog
from tests.conftest import SF_SMALL
from tests.oracle_check import compare_one

SQL = catalog.oracle_sql()
NAMES = sorted(n for n in catalog.queries() if n in SQL)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck_small, name):
    ok, msg = compare_one(spark, duck_small, name, catalog.queries()[name], SQL[name], SF_SMALL)
    assert ok, msg


def test_every_query_has_a_doc():
    qs = catalog.queries()
    assert len(qs) >= 75
    for name, fn in qs.items():
        assert fn.__doc__, name


def test_training_scores_every_row(spark):
    rows = catalog.queries()["mlp_train"](spark, SF_SMALL).collect()
    labels = {r.vec_id: int(r.label >= 5) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()}
    assert len(rows) == len(labels)
    assert all(r.label == labels[r.vec_id] and r.prediction in (0.0, 1.0) for r in rows)
    right = sum(r.label == r.prediction for r in rows)
    assert right > max(sum(labels.values()), len(labels) - sum(labels.values()))  # beats the larger class


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.columns == ["idx", "sat"]
    rows = df.collect()
    assert all(r.sat > 3 for r in rows)
    sats = [(-r.sat, r.idx) for r in rows]
    assert sats == sorted(sats)
