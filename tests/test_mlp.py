"""The two MLP forms agree: column expressions (higher-order functions) and Arrow batches."""

import numpy as np
from pyspark.sql import functions as F

from tessera.operators import mlp as NN
from tests.conftest import SF_SMALL


def test_column_expression_and_batch_forms_agree(spark):
    emb = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").select("vec_id", "embedding")
    dims = emb.agg(F.max(F.size("embedding")).alias("D"))
    params = NN.mlp_init(dims)
    assert params.where("layer = 'W1'").count() == 64 * 64
    hof = NN.with_weights(emb, params).select(
        "vec_id", NN.round_array(NN.mlp_forward(NN.as_double_array("embedding"))["probs"], 9).alias("p"))
    batch = NN.score_batches(emb, "embedding", params, ["vec_id"], ["probs"], digits=None).select(
        "vec_id", NN.round_array(F.col("probs"), 9).alias("p"))
    a = {r.vec_id: r.p for r in hof.collect()}
    b = {r.vec_id: r.p for r in batch.collect()}
    assert a.keys() == b.keys()
    for k in a:
        assert all(abs(x - y) < 1e-8 for x, y in zip(a[k], b[k]))
        assert abs(sum(a[k]) - 1.0) < 1e-8


def plain_step(x, y, w, m, v, step):
    """One Adam step of the l2 loss in plain numpy, derivatives by finite differences left to the other test."""
    z1 = x @ w["W1"] + w["b1"]
    a1 = 1 / (1 + np.exp(-z1))
    z2 = a1 @ w["W2"] + w["b2"]
    p = np.exp(z2) / np.exp(z2).sum(axis=1, keepdims=True)
    dp = (p - y) / len(x)
    dz2 = np.array([(np.diag(q) - np.outer(q, q)) @ d for q, d in zip(p, dp)])
    dz1 = dz2 @ w["W2"].T * a1 * (1 - a1)
    g = {"W1": x.T @ dz1, "b1": dz1.sum(0), "W2": a1.T @ dz2, "b2": dz2.sum(0)}
    for k in g:
        m[k] = 0.9 * m[k] + 0.1 * g[k]
        v[k] = 0.999 * v[k] + 0.001 * g[k] ** 2
        w[k] = w[k] - 0.03 * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)


def test_adam_steps_equal_numpy(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(50, 6))
    hit = (x[:, 0] > 0).astype(int)
    rows = [(k, [float(c) for c in r], int(b)) for k, (r, b) in enumerate(zip(x, hit))]
    odd = [(1000, None, 1), (1001, [0.0] * 5 + [None], 1), (1002, [0.0] * 6, None)]
    df = spark.createDataFrame(rows + odd, "id long, x array<double>, hit int").repartition(5)
    params = NN.mlp_init(spark.range(1).select(F.lit(6).alias("D")), hidden=8)
    w = NN.collect_weights(params)
    m, v = ({k: np.zeros_like(a) for k, a in w.items()} for _ in range(2))
    for step in range(1, 6):  # 53 rows in batches of 16: the fourth has the odd rows, the fifth is the first again
        at = slice(16 * ((step - 1) % 4), 16 * ((step - 1) % 4) + 16)
        plain_step(x[at], np.c_[1 - hit[at], hit[at]], w, m, v, step)
    trained = NN.train_adam(df, params, "id", "x", "hit", steps=5)
    got = NN.collect_weights(trained)
    for k in w:
        assert np.allclose(got[k], w[k], atol=1e-9), k
    moments = trained.where("layer = 'W2'").orderBy("row", "col").collect()
    assert np.allclose([r.m for r in moments], m["W2"].ravel()) and np.allclose([r.v for r in moments], v["W2"].ravel())


def test_gradients_are_the_derivatives_of_the_loss():
    rng = np.random.default_rng(2)
    x, y = rng.normal(size=(4, 3)), np.eye(2)[[0, 1, 1, 0]]
    w = {"W1": rng.normal(size=(3, 5)), "b1": rng.normal(size=5), "W2": rng.normal(size=(5, 2)), "b2": rng.normal(size=2)}
    g = NN.gradients(x, y, w)
    for k, i in (("W1", (1, 2)), ("b1", (3,)), ("W2", (4, 0)), ("b2", (1,))):
        around = []
        for eps in (1e-5, -1e-5):
            moved = {n: a.copy() for n, a in w.items()}
            moved[k][i] += eps
            around.append(NN.gradients(x, y, moved)["loss"][0, 0])
        assert abs((around[0] - around[1]) / 2e-5 - np.atleast_2d(g[k])[i if len(i) == 2 else (0, *i)]) < 1e-7


def test_training_without_rows_changes_nothing(spark):
    params = NN.mlp_init(spark.range(1).select(F.lit(2).alias("D")), hidden=3)
    none = spark.createDataFrame([], "id long, x array<double>, hit int")
    assert NN.train_adam(none, params, "id", "x", "hit", steps=3).exceptAll(params).count() == 0
