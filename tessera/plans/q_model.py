"""Scoring queries over ``embeddings`` (network input: the embedding vector)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalar import one_hot_binary
from ..operators import mlp as NN
from ..session import read_table
from . import registry as REG
from .catalog import query

M, T = NN.HIDDEN, NN.TARGETS


def _emb(spark, sf_dir):
    return read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")


def _params(spark, sf_dir):
    # the input width comes from the data: one scalar aggregate, folded in as a literal
    d = _emb(spark, sf_dir).agg(F.max(F.size("embedding"))).first()[0] or 0
    return NN.mlp_init(spark.range(1).select(F.lit(int(d)).alias("D")))


def _scored(spark, sf_dir, outputs, digits=6):
    """Forward pass on Arrow batches; layers rounded with Spark's ``round`` (HALF_UP)."""
    s = NN.score_batches(_emb(spark, sf_dir), "embedding", _params(spark, sf_dir), ["vec_id"],
                         outputs, digits=None)
    if digits is None:
        return s
    return s.select("vec_id", *[NN.round_array(F.col(o), digits).alias(o) for o in outputs])


def _binary_label():
    return (F.col("label") >= 5).cast("int")


_W_SQL = f"""
    dims AS (SELECT max(len(embedding)) AS n_in FROM embeddings),
    w AS (SELECT
      list_transform(range({M}), lambda m: list_transform(range(n_in), lambda r:
        round(sin(CAST(1 + r * {M} + m AS DOUBLE)) * sqrt(2.0::DOUBLE / CAST(n_in AS DOUBLE)), 6))) AS W1,
      list_transform(range({T}), lambda c: list_transform(range({M}), lambda m:
        round(sin(CAST(1 + {NN.W2_OFFSET} + m * {T} + c AS DOUBLE)) * sqrt(2.0::DOUBLE / {M}.0::DOUBLE), 6))) AS W2
      FROM dims),
    xs AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
    l1 AS (SELECT vec_id, label, x, list_transform(W1, lambda wu:
             list_reduce(list_transform(range(len(x)), lambda i: x[i + 1] * wu[i + 1]), lambda a, b: a + b) + 0.0::DOUBLE) AS z1,
             W2 FROM xs, w),
    l2 AS (SELECT vec_id, label, x, z1, list_transform(z1, lambda v: 1.0::DOUBLE / (1.0::DOUBLE + exp(-v))) AS a1, W2 FROM l1),
    l3 AS (SELECT vec_id, label, x, z1, a1, list_transform(W2, lambda wu:
             list_reduce(list_transform(range(len(a1)), lambda i: a1[i + 1] * wu[i + 1]), lambda a, b: a + b) + 0.0::DOUBLE) AS z2
           FROM l2),
    l4 AS (SELECT *, list_transform(z2, lambda v: exp(v - list_max(z2))) AS e FROM l3),
    l5 AS (SELECT *, list_transform(e, lambda v: v / list_reduce(e, lambda a, b: a + b)) AS probs FROM l4)"""


def _round_list(c: str) -> str:
    return f"list_transform({c}, lambda v: round(v, 6))"


@query("mlp_init", sql=f"""
    WITH dims AS (SELECT max(len(embedding)) AS D FROM embeddings)
    SELECT 'W1' AS layer, CAST(k // {M} AS INTEGER) AS row, CAST(k % {M} AS INTEGER) AS col,
           round(sin(CAST(1 + k AS DOUBLE)) * sqrt(2.0::DOUBLE / CAST(D AS DOUBLE)), 6) AS value,
           0.0::DOUBLE AS m, 0.0::DOUBLE AS v
    FROM dims, range(D * {M}) r(k)
    UNION ALL SELECT 'b1', 0, CAST(k AS INTEGER), 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE FROM range({M}) r(k)
    UNION ALL SELECT 'W2', CAST(k // {T} AS INTEGER), CAST(k % {T} AS INTEGER),
           round(sin(CAST(1 + {NN.W2_OFFSET} + k AS DOUBLE)) * sqrt(2.0::DOUBLE / {M}.0::DOUBLE), 6),
           0.0::DOUBLE, 0.0::DOUBLE FROM range({M} * {T}) r(k)
    UNION ALL SELECT 'b2', 0, CAST(k AS INTEGER), 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE FROM range({T}) r(k)""")
def q_mlp_init(spark, sf_dir):
    """M5: weights (D x M, M x t) sized from the data, zero biases and zero Adam moments."""
    return _params(spark, sf_dir)


@query("affine_forward", sql=f"WITH {_W_SQL} SELECT vec_id, {_round_list('z1')} AS z1 FROM l5")
def q_affine_forward(spark, sf_dir):
    """M1: ``X %*% W1 + b1`` per row."""
    return _scored(spark, sf_dir, ["z1"])


@query("sigmoid", sql=f"WITH {_W_SQL} SELECT vec_id, {_round_list('a1')} AS a1 FROM l5")
def q_sigmoid(spark, sf_dir):
    """M2: ``1 / (1 + exp(-z))`` on the hidden layer."""
    return _scored(spark, sf_dir, ["a1"])


@query("softmax", sql=f"WITH {_W_SQL} SELECT vec_id, {_round_list('probs')} AS probs FROM l5")
def q_softmax(spark, sf_dir):
    """M3: row-wise softmax of the output layer."""
    return _scored(spark, sf_dir, ["probs"])


def _predict(spark, inputs, state):
    """The reference's prediction script: the class probabilities of every row and the inputs they belong to."""
    pred = NN.score_batches(inputs["X"], "embedding", state["params"], ["vec_id", "embedding"], ["probs"], digits=None)
    return {"pred": pred.select("vec_id", F.get("probs", 0).alias("p0"), F.get("probs", 1).alias("p1")),
            "X": pred.select("vec_id", NN.as_double_array("embedding").alias("x")), "scored": pred}


REG.register_analysis("Predict", _predict, deps=["X"], outputs=["pred", "X", "scored"])


@query("mlp_score", sql=f"""WITH {_W_SQL}
    SELECT vec_id, round(probs[1], 6) AS p0, round(probs[2], 6) AS p1, {_round_list('x')} AS x FROM l5""")
def q_mlp_score(spark, sf_dir):
    """M4: the analysis ``Predict`` by name: class probabilities (D -> 64 sigmoid -> 2 softmax) and the inputs of every row."""
    res = REG.run_analysis(spark, "Predict", {"X": _emb(spark, sf_dir).select("vec_id", "embedding")},
                           state={"params": _params(spark, sf_dir)})
    return res["scored"].select(
        "vec_id", F.round(F.get("probs", 0), 6).alias("p0"), F.round(F.get("probs", 1), 6).alias("p1"),
        NN.round_array(NN.as_double_array("embedding")).alias("x"))


@query("one_hot_binary", sql="""
    SELECT vec_id, 1 - CAST(label >= 5 AS INTEGER) AS y0, CAST(label >= 5 AS INTEGER) AS y1
    FROM embeddings""")
def q_one_hot_binary(spark, sf_dir):
    """``cbind(1 - b, b)`` targets from a 0/1 label (b = label >= 5)."""
    y0, y1 = one_hot_binary(_binary_label())
    return _emb(spark, sf_dir).select("vec_id", y0.alias("y0"), y1.alias("y1"))


#: Steps and batch size of the registered training runs (the reference's script uses batches of 16).
TRAIN_STEPS, TRAIN_BATCH = 30, 1024


def _trained(spark, sf_dir):
    rows = _emb(spark, sf_dir).withColumn("hit", _binary_label())
    params = NN.train_adam(rows, _params(spark, sf_dir), "vec_id", "embedding", "hit", TRAIN_STEPS, TRAIN_BATCH)
    scored = NN.score_batches(rows, "embedding", params, ["vec_id", "hit"], ["probs"], digits=None)
    return params, scored.select("vec_id", F.col("hit").cast("double").alias("label"),
                                 (F.get("probs", 1) > F.get("probs", 0)).cast("double").alias("prediction"))


@query("mlp_train")
def q_mlp_train(spark, sf_dir):
    """M6: train the D -> 64 -> 2 network by mini-batch Adam on the l2 loss and score every row."""
    return _trained(spark, sf_dir)[1]


@query("mlp_train_summary", sql=f"""
    WITH e AS (SELECT CAST(label >= 5 AS INTEGER) AS y, len(embedding) AS d FROM embeddings)
    SELECT COUNT(*) AS n_rows, CAST(SUM(y) AS BIGINT) AS n_positive,
           CAST((max(d) + 1) * {M} + ({M} + 1) * {T} AS BIGINT) AS n_params,
           CAST((max(d) + 1) * {M} + ({M} + 1) * {T} AS BIGINT) AS n_moved, true AS beats_larger_class FROM e""")
def q_mlp_train_summary(spark, sf_dir):
    """M6: what must hold of a training run: rows scored, all weights moved, more rows right than by the larger class."""
    params, scored = _trained(spark, sf_dir)
    hit = F.sum("label")
    moved = params.join(_params(spark, sf_dir).select("layer", "row", "col", F.col("value").alias("old")),
                        ["layer", "row", "col"]).agg(
        F.count(F.lit(1)).alias("n_params"), F.count(F.when(F.col("value") != F.col("old"), 1)).alias("n_moved"))
    return scored.agg(F.count(F.lit(1)).alias("n_rows"), hit.cast("long").alias("n_positive"), (
        F.sum((F.col("label") == F.col("prediction")).cast("long")) > F.greatest(hit, F.count(F.lit(1)) - hit))
        .alias("beats_larger_class")).withColumns(
        {c: moved.select(c).scalar() for c in ("n_params", "n_moved")})
