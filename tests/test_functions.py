"""Scalar column expressions: edges of each rule."""

from pyspark.sql import functions as F

from tessera.functions import grid as GR
from tessera.functions import scalar as SC
from tessera.operators import histogram as H


def _col(spark, values, typ="double"):
    return spark.createDataFrame([(v,) for v in values], f"v {typ}")


def test_clamp_and_replace_small(spark):
    df = _col(spark, [-10.0, 24.9, 25.0, 50.0, 75.0, 80.0])
    assert [r.c for r in df.select(SC.clamp("v").alias("c")).collect()] == [25.0, 25.0, 25.0, 50.0, 75.0, 75.0]
    df = _col(spark, [-1.0, -0.999, 0.0, 0.5, 1.0, 3.0])
    assert [r.c for r in df.select(SC.replace_small("v").alias("c")).collect()] == [-1.0, -5.0, -5.0, -5.0, 1.0, 3.0]


def test_label_sign_ties_are_negative(spark):
    df = spark.createDataFrame([(1.0, 0.5), (1.0, 1.0), (1.0, 2.0)], "curve double, y double")
    assert [r.l for r in df.select(SC.label_sign("curve", "y").alias("l")).collect()] == [1, -1, -1]


def test_value_lookup_null_and_wrap(spark):
    df = _col(spark, [0, 1, 2, 3, 6], "int")
    got = df.select(SC.value_lookup_in_array("v", SC.ATOM_SYMBOLS).alias("a"),
                    SC.value_lookup_in_array("v", SC.ATOM_SYMBOLS, wrap=True).alias("b")).collect()
    assert [r.a for r in got] == ["C", "O", "O", None, None]
    assert [r.b for r in got] == ["C", "O", "O", "C", "C"]


def test_char_code_round_trip(spark):
    df = spark.createDataFrame([("C",), ("O",)], "s string")
    got = df.select(SC.char_code("s").alias("n")).select("n", SC.code_char("n").alias("s")).collect()
    assert [(r.n, r.s) for r in got] == [(67, "C"), (79, "O")]


def test_cast_text_number(spark):
    df = spark.createDataFrame([("0.150000",), (" 12 ",), ("1e3",), ("abc",), ("",)], "t string")
    got = [r.v for r in df.select(SC.cast_text_number("t").alias("v")).collect()]
    assert got == [0.15, 12.0, 1000.0, None, None]


def test_axis_scale_ordinal_signed_abs(spark):
    df = spark.createDataFrame([("C1", 0, -3), ("C7", 6, 4), ("C64", 63, 0)], "name string, k int, h int")
    got = df.select(GR.column_ordinal("name").alias("o"), GR.axis_scale("k", 64).alias("a"),
                    GR.signed_abs("h").alias("s")).collect()
    assert [r.o for r in got] == [0, 6, 63]
    assert [r.a for r in got] == [0.0, 6 * 100 / 64, 63 * 100 / 64]
    assert [r.s for r in got] == [3, 4, 0]


def test_cell_index_round_trip_and_domain(spark):
    g = GR.Grid(8)
    df = spark.createDataFrame([(i, j) for i in range(1, 9) for j in range(1, 9)], "i int, j int")
    back = df.select("i", "j", GR.cell_index("i", "j", g).alias("idx")).select(
        "i", "j", "idx", GR.cell_row("idx", g).alias("i2"), GR.cell_col("idx", g).alias("j2"))
    rows = back.collect()
    assert sorted(r.idx for r in rows) == list(range(1, 65))
    assert all(r.i == r.i2 and r.j == r.j2 for r in rows)
    pts = spark.createDataFrame([(0.0, 5.0), (100.0, 100.0), (100.5, 3.0), (12.5, 12.5)], "x double, y double")
    ok, bad = H.split_domain(H.assign_cells(pts, g), g)
    assert sorted((r.gx, r.gy) for r in ok.collect()) == [(1, 1), (8, 8)]
    assert sorted((r.gx, r.gy) for r in bad.collect()) == [(0, 1), (9, 1)]


def test_linspace_endpoints(spark):
    one = spark.range(1).select(F.lit(5).alias("n"))
    xs = [r.x for r in SC.linspace_points(one, "n", 1.0, 3.0).orderBy("k").collect()]
    assert xs == [1.0, 1.5, 2.0, 2.5, 3.0]


def test_unit_from_hash_is_uniform_and_stable(spark):
    df = spark.range(20000)
    u = df.select(SC.unit_from_hash("id", seed=3).alias("u"))
    stats = u.agg(F.min("u"), F.max("u"), F.avg("u")).first()
    assert 0.0 <= stats[0] and stats[1] < 1.0 and abs(stats[2] - 0.5) < 0.01
    assert u.exceptAll(df.repartition(5).select(SC.unit_from_hash("id", seed=3).alias("u"))).count() == 0
