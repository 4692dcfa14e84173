"""A small multilayer perceptron (affine -> sigmoid -> affine -> softmax) as column expressions.

Weights live in a long parameter table ``(layer, row, col, value, m, v)`` (with
zero Adam moments) built by Spark from ``range``; scoring turns each layer
into one array value through a scalar subquery -- evaluated once, shipped to
every task like a broadcast -- and evaluates the network per row with
higher-order functions (``transform`` / ``zip_with`` / ``aggregate``), so the
rows never leave the JVM.

Initialisation is deterministic: ``W[r, c] = round(sin(seed + offset + r * cols
+ c) * sqrt(2 / rows), 6)`` (a He-style scale), biases 0.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The network shape of the reference scripts (64 hidden units, 2 targets).
HIDDEN = 64
TARGETS = 2
# Our own deterministic initialisation parameters.
SEED = 1.0
W2_OFFSET = 100000


def _init_layer(dims: DataFrame, name: str, rows: Column, cols: Column, offset: int) -> DataFrame:
    k = F.explode(F.sequence(F.lit(0), rows * cols - 1)).alias("k")
    e = dims.select(rows.alias("_r"), cols.alias("_c"), k)
    r = F.floor(F.col("k") / F.col("_c")).cast("int")
    c = F.pmod(F.col("k"), F.col("_c")).cast("int")
    val = F.round(F.sin(F.lit(SEED + offset) + F.col("k").cast("double"))
                  * F.sqrt(F.lit(2.0) / F.col("_r").cast("double")), 6)
    return e.select(F.lit(name).alias("layer"), r.alias("row"), c.alias("col"), val.alias("value"))


def _zero_layer(dims: DataFrame, name: str, cols: Column) -> DataFrame:
    e = dims.select(F.explode(F.sequence(F.lit(0), cols - 1)).alias("col"))
    return e.select(F.lit(name).alias("layer"), F.lit(0).alias("row"), F.col("col").cast("int"),
                    F.lit(0.0).alias("value"))


def mlp_init(dims: DataFrame, d_col: str = "D", hidden: int = HIDDEN, targets: int = TARGETS) -> DataFrame:
    """Parameter table for a D -> hidden -> targets network, D taken from ``dims``."""
    D, M, T = F.col(d_col), F.lit(hidden), F.lit(targets)
    parts = [_init_layer(dims, "W1", D, M, 0), _zero_layer(dims, "b1", M),
             _init_layer(dims, "W2", M, T, W2_OFFSET), _zero_layer(dims, "b2", T)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumns({"m": F.lit(0.0), "v": F.lit(0.0)})


def layer_matrix(params: DataFrame, layer: str) -> Column:
    """The layer as ``array<array<double>>`` indexed [output unit][input], via a scalar subquery."""
    p = params.where(F.col("layer") == layer)
    per_col = p.groupBy("col").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("row", "value"))), lambda s: s["value"])
        .alias("w"))
    return per_col.agg(F.transform(F.array_sort(F.collect_list(F.struct("col", "w"))),
                                   lambda s: s["w"]).alias("W")).scalar()


def layer_vector(params: DataFrame, layer: str) -> Column:
    p = params.where(F.col("layer") == layer)
    return p.agg(F.transform(F.array_sort(F.collect_list(F.struct("col", "value"))),
                             lambda s: s["value"]).alias("b")).scalar()


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, v: acc + v)


def affine(x: Column, W: Column, b: Column) -> Column:
    """``x %*% W + b`` for one row: one output per unit of W."""
    return F.transform(W, lambda w, u: dot(x, w) + F.get(b, u))


def sigmoid(z: Column) -> Column:
    return F.transform(z, lambda v: F.lit(1.0) / (F.lit(1.0) + F.exp(-v)))


def softmax(z: Column) -> Column:
    """Row-wise softmax, max subtracted first."""
    mx = F.array_max(z)
    e = F.transform(z, lambda v: F.exp(v - mx))
    s = F.aggregate(e, F.lit(0.0), lambda acc, v: acc + v)
    return F.transform(e, lambda v: v / s)


def as_double_array(c) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.transform(col, lambda v: v.cast("double"))


def with_weights(df: DataFrame, params: DataFrame) -> DataFrame:
    """Attach the layers as columns (scalar subqueries, computed once per query).

    Higher-order functions cannot contain subqueries, so the arrays are
    projected first and the network reads them as ordinary columns.
    """
    return df.withColumns({"_W1": layer_matrix(params, "W1"), "_b1": layer_vector(params, "b1"),
                           "_W2": layer_matrix(params, "W2"), "_b2": layer_vector(params, "b2")})


def mlp_forward(x: Column) -> dict[str, Column]:
    """All layers of the forward pass for input array ``x`` (after :func:`with_weights`)."""
    W1, b1, W2, b2 = (F.col(c) for c in ("_W1", "_b1", "_W2", "_b2"))
    z1 = affine(x, W1, b1)
    a1 = sigmoid(z1)
    z2 = affine(a1, W2, b2)
    return {"z1": z1, "a1": a1, "z2": z2, "probs": softmax(z2)}


def round_array(c: Column, digits: int = 6) -> Column:
    return F.transform(c, lambda v: F.round(v, digits))


# ---------------------------------------------------------------- batch scoring (Arrow)
#
# The higher-order-function form above evaluates every multiply-add through an
# interpreted lambda; for a 64 x 64 layer that is ~4k lambda calls per row.
# Scoring therefore runs on Arrow batches with numpy: the parameter table is
# small (bounded by the network shape, not by the data), so it is collected
# once and broadcast like any Spark ML model; every batch is then a handful of
# vectorised numpy operations.  Sums run input by input, in the same order as
# a sequential fold.

def collect_weights(params: DataFrame) -> dict[str, "np.ndarray"]:
    """Parameter table -> numpy arrays (W1: D x M, b1: M, W2: M x t, b2: t)."""
    import numpy as np
    rows = params.select("layer", "row", "col", "value").collect()  # bounded: D*M + M*t + M + t
    shapes: dict[str, tuple[int, int]] = {}
    for r in rows:
        h, w = shapes.get(r.layer, (0, 0))
        shapes[r.layer] = (max(h, r.row + 1), max(w, r.col + 1))
    out = {k: np.zeros(s) for k, s in shapes.items()}
    for r in rows:
        out[r.layer][r.row, r.col] = r.value
    out["b1"], out["b2"] = out["b1"][0], out["b2"][0]
    return out


def _layer(x, W, b):
    z = np.zeros((x.shape[0], W.shape[1]))
    for i in range(W.shape[0]):  # sequential sum over inputs, vectorised over rows and units
        z = z + x[:, i:i + 1] * W[i][None, :]
    return z + b[None, :]


LAYERS = ("z1", "a1", "z2", "probs")


def forward_numpy(x, w: dict, outputs=LAYERS) -> dict:
    """The layers of the forward pass, up to the last one that is asked for."""
    last = max(LAYERS.index(o) for o in outputs)
    out = {"z1": _layer(x, w["W1"], w["b1"])}
    if last >= 1:
        out["a1"] = 1.0 / (1.0 + np.exp(-out["z1"]))
    if last >= 2:
        out["z2"] = _layer(out["a1"], w["W2"], w["b2"])
    if last >= 3:
        e = np.exp(out["z2"] - out["z2"].max(axis=1, keepdims=True))
        s = np.zeros(e.shape[0])
        for j in range(e.shape[1]):
            s = s + e[:, j]
        out["probs"] = e / s[:, None]
    return out


def _vectors(column, width: int):
    """(rows with a vector, their values): null vectors and those with a null are left out.

    A vector of another length than ``width`` is an error.
    """
    values = column.flatten().to_numpy(zero_copy_only=False).astype("float64")
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    there = ~np.isnan(lengths.astype("float64"))
    wrong = lengths[there] != width
    if wrong.any():
        raise ValueError(f"input vector of {int(lengths[there][wrong][0])} values; the network takes {width}")
    x = values.reshape(int(there.sum()), width)
    nulls = column.flatten().is_null().to_numpy(zero_copy_only=False).reshape(x.shape).any(axis=1)
    return np.flatnonzero(there)[~nulls], x[~nulls]


def score_batches(df: DataFrame, x_col: str, params: DataFrame, keep: list[str],
                  outputs: list[str], digits: int | None = 6) -> DataFrame:
    """Run the network over ``df`` on Arrow batches; returns ``keep`` + the requested layers.

    Each output is an ``array<double>`` column (rounded to ``digits`` when
    given); null for a vector that is null or holds a null.  A vector of the
    wrong length raises.
    """
    import pyarrow as pa
    from ..session import ship_package
    spark = df.sparkSession
    ship_package(spark)
    bc = spark.sparkContext.broadcast(collect_weights(params))
    in_schema = df.select(*keep).schema
    out_schema = in_schema
    from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType
    out_schema = StructType(list(in_schema.fields)
                            + [StructField(o, ArrayType(DoubleType(), False)) for o in outputs])

    def run(batches):
        w = bc.value
        for b in batches:
            if b.num_rows == 0:
                continue
            rows, x = _vectors(b.column(x_col), w["W1"].shape[0])
            res = forward_numpy(x, w, outputs)
            at = np.full(b.num_rows, -1)
            at[rows] = np.arange(len(rows))
            take = pa.array(at, mask=at < 0)
            cols = [b.column(k) for k in keep]
            for o in outputs:
                v = res[o]
                if digits is not None:
                    v = np.round(v, digits)
                found = pa.FixedSizeListArray.from_arrays(pa.array(v.ravel()), v.shape[1])
                cols.append(found.cast(pa.list_(pa.float64())).take(take))
            yield pa.RecordBatch.from_arrays(cols, names=keep + outputs)

    return df.select(*dict.fromkeys([*keep, x_col])).mapInArrow(run, out_schema)


# ---------------------------------------------------------------- training: mini-batch Adam on the l2 loss (M6)
#
# The parameter table carries each weight with its two moments.  A step is one
# Spark job: every task adds up the gradient of its rows of the batch (Arrow,
# numpy), Spark adds the tasks' sums per weight and joins them to the table,
# and the new table is written to the scratch folder.  Only the table, bounded
# by the network's shape, reaches the driver, to be broadcast for the next step.

# Fixed values of the reference's training script.
LEARNING_RATE, BETA1, BETA2, EPSILON, BATCH_SIZE = 0.03, 0.9, 0.999, 1e-8, 16


def gradients(x, y, w: dict) -> dict:
    """Sums over the rows of the l2 loss's derivatives (not yet divided by the batch's size) and of the loss."""
    f = forward_numpy(x, w, ("a1", "probs"))
    p, a1 = f["probs"], f["a1"]
    off = p - y
    dz2 = p * (off - (off * p).sum(axis=1, keepdims=True))
    dz1 = (dz2 @ w["W2"].T) * a1 * (1.0 - a1)
    return {"W1": x.T @ dz1, "b1": dz1.sum(axis=0)[None, :], "W2": a1.T @ dz2, "b2": dz2.sum(axis=0)[None, :],
            "loss": 0.5 * np.square(off).sum()[None, None]}


def number_batches(rows: DataFrame, key: str, batch_size: int = BATCH_SIZE) -> DataFrame:
    """``rows`` with ``batch`` (from 0) in ``key`` order, written so that a batch is a stretch of files."""
    from ..session import scratch_path
    from .reshape import row_index
    numbered = row_index(rows, key=key, name="_row").withColumn(
        "batch", F.floor((F.col("_row") - 1) / batch_size).cast("long")).drop("_row")
    path = scratch_path(rows.sparkSession, "batches")
    numbered.repartitionByRange("batch").sortWithinPartitions("batch").write.parquet(path)
    return rows.sparkSession.read.schema(numbered.schema).parquet(path)


def _gradient_table(batch: DataFrame, x_col: str, label_col: str, w: dict) -> DataFrame:
    """(layer, row, col, g) summed over the rows; layer ``loss`` has the loss, layer ``n`` the rows with a vector."""
    import pyarrow as pa
    spark = batch.sparkSession
    bc = spark.sparkContext.broadcast(w)

    def run(batches):
        weights, total, n = bc.value, None, 0
        for b in batches:
            if b.num_rows == 0:
                continue
            at, x = _vectors(b.column(0), weights["W1"].shape[0])
            hit = b.column(1).to_numpy(zero_copy_only=False)[at].astype("float64")
            known = ~np.isnan(hit)
            x, hit = x[known], hit[known]
            g = gradients(x, np.column_stack([1.0 - hit, hit]), weights)
            total = g if total is None else {k: total[k] + g[k] for k in g}
            n += len(x)
        if total is not None:
            total["n"] = np.array([[float(n)]])
            for layer, g in total.items():
                r, c = np.indices(g.shape)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([layer] * g.size, pa.string()), pa.array(r.ravel().astype("int32")),
                     pa.array(c.ravel().astype("int32")), pa.array(g.ravel())], names=["layer", "row", "col", "g"])

    return (batch.select(x_col, F.col(label_col).cast("double")).mapInArrow(run, "layer string, row int, col int, g double")
            .groupBy("layer", "row", "col").agg(F.sum("g").alias("g")))


def adam_step(params: DataFrame, grads: DataFrame, step: int, lr: float = LEARNING_RATE, beta1: float = BETA1,
              beta2: float = BETA2, epsilon: float = EPSILON) -> DataFrame:
    """The parameter table after step ``step`` (from 1); ``grads`` as summed, divided here by the batch's rows."""
    n = grads.where("layer = 'n'").agg(F.max("g").alias("n")).scalar()
    g = F.coalesce(F.col("g"), F.lit(0.0)) / F.coalesce(F.col("_n"), F.lit(1.0))
    out = params.join(grads, ["layer", "row", "col"], "left").withColumn("_n", n).withColumn("g", g).withColumns({
        "m": F.lit(beta1) * F.col("m") + F.lit(1.0 - beta1) * F.col("g"),
        "v": F.lit(beta2) * F.col("v") + F.lit(1.0 - beta2) * F.col("g") * F.col("g")})
    move = (F.col("m") / F.lit(1.0 - beta1 ** step)) / (F.sqrt(F.col("v") / F.lit(1.0 - beta2 ** step)) + F.lit(epsilon))
    return out.select("layer", "row", "col", (F.col("value") - F.lit(lr) * move).alias("value"), "m", "v")


def train_adam(rows: DataFrame, params: DataFrame, key: str, x_col: str, label_col: str, steps: int,
               batch_size: int = BATCH_SIZE, lr: float = LEARNING_RATE) -> DataFrame:
    """The parameter table after ``steps`` mini-batches in ``key`` order, over and over.

    Rows without a vector or a label (0 or 1) add nothing.  A batch without
    any leaves the gradient at zero; no rows at all leave ``params`` as given.
    """
    from ..session import scratch_path, ship_package
    spark = rows.sparkSession
    ship_package(spark)
    batches = number_batches(rows.select(key, x_col, label_col), key, batch_size)
    last = batches.agg(F.max("batch")).first()[0]
    if last is None:
        return params
    for step in range(1, steps + 1):
        grads = _gradient_table(batches.where(F.col("batch") == (step - 1) % (last + 1)), x_col, label_col,
                                collect_weights(params))
        path = scratch_path(spark, "params")
        stepped = adam_step(params, grads, step, lr)
        stepped.coalesce(1).write.parquet(path)
        params = spark.read.schema(stepped.schema).parquet(path)
    return params
