"""Fitting both scorers on labelled pairs with Spark ML."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankweave.functions.vectors import cosine, elementwise_product, weighted_dot
from rankweave.operators.encode import encode_dense_terms
from rankweave.operators.pairs import ranked_choices, require_choices
from rankweave.operators.ranking import top_k
from rankweave.operators.rerank import FEATURES, fitted_scorer
from rankweave.session import scratch_path, staged

EPOCHS = 10  # fixed value: passes of both fits
MRR_CUTOFF = 10
BI_CANDIDATES = (1e-6, 1e-2)
TEXT_DIM = 128
#: Pair scorers to choose from: a logistic one (regularisation, iterations) or boosted trees (depth, trees).
CANDIDATES = (("logistic", 0.0, EPOCHS), ("logistic", 0.01, EPOCHS), ("logistic", 0.1, EPOCHS), ("trees", 3, EPOCHS))
BINS, SHRINKAGE = 32, 0.1
#: Training rows that a worker of the descent holds, at most, and the share of the longest safe step it takes.
WORKER_ROWS, BATCHES, RATE = 50_000, 4, 0.5


def cosine_loss(pairs: DataFrame) -> DataFrame:
    """One row: mean squared error of cosine(query_vec, doc_vec) against ``label``, and the pair count."""
    error = cosine(F.col("query_vec"), F.col("doc_vec")) - F.col("label")
    return pairs.agg(F.avg(error * error).alias("mse"), F.count("*").alias("n_pairs"))


def fit_bi_weights(
    train: DataFrame, validation: DataFrame | None = None, candidates: Sequence[float] = BI_CANDIDATES
) -> list[float]:
    """One weight per dimension, minimising the squared error of sum(w * q * d) against ``label``.

    Both inputs hold unit vectors ``query_vec`` and ``doc_vec`` and a ``label``. Of the candidate
    regularisations the one with the smallest validation error is kept (the first without validation).
    The fit is one distributed pass per candidate; the result has ``dim`` numbers.
    """
    product = elementwise_product(F.col("query_vec"), F.col("doc_vec"))
    training = train.select(array_to_vector(product).alias("features"), "label")
    best: tuple[list[float], float] | None = None
    for reg_param in candidates if validation is not None else candidates[:1]:
        fitted = LinearRegression(
            fitIntercept=False, maxIter=EPOCHS, regParam=reg_param, standardization=False
        ).fit(training)
        weights = [float(w) for w in fitted.coefficients]
        if validation is None:
            return weights
        error = weighted_dot(F.col("query_vec"), F.col("doc_vec"), weights) - F.col("label")
        reached = validation.agg(F.avg(error * error)).first()[0]
        if best is None or reached < best[1]:
            best = (weights, reached)
    if best is None:
        raise ValueError("no candidate to fit")
    return best[0]


def fit_text_weights(
    train: DataFrame, validation: DataFrame | None = None, dim: int = TEXT_DIM, candidates: Sequence[float] = BI_CANDIDATES
) -> list[float]:
    """``fit_bi_weights`` from labelled texts: pairs (query, doc, label), encoded to ``dim`` entries."""

    def encoded(pairs: DataFrame | None) -> DataFrame | None:
        if pairs is None:
            return None
        with_query = encode_dense_terms(pairs.select("query", "doc", "label"), "query", dim).withColumnRenamed("embedding", "query_vec")
        return staged(encode_dense_terms(with_query, "doc", dim).withColumnRenamed("embedding", "doc_vec"), "fit-vectors")

    return fit_bi_weights(encoded(train), encoded(validation), candidates)


def descend_bi_weights(
    train: DataFrame, validation: DataFrame, epochs: int = EPOCHS, rate: float = RATE, workers: int = 1, batches: int = BATCHES
) -> tuple[list[float], DataFrame]:
    """Weights as in ``fit_bi_weights`` by distributed descent, and its (epoch, mse, val_mse, weights).

    Both inputs hold ``query_id``, ``doc_id``, unit vectors ``query_vec`` and ``doc_vec``, and ``label``. Training
    rows are dealt to workers, and inside one to mini-batches, by a hash of their ids. In an epoch each worker
    starts from the shared weights and takes a step for each of its batches in turn; then the weights are
    averaged, by rows. There are as many workers as keep their rows below ``WORKER_ROWS``, and ``workers`` at
    least. The weights of the epoch with the smallest validation error are returned.
    """
    product = elementwise_product(F.col("query_vec"), F.col("doc_vec"))
    digest = F.md5(F.concat_ws("|", "query_id", "doc_id"))

    def dealt(first: int, number: int):
        return F.pmod(F.conv(F.substring(digest, first, 4), 16, 10).cast("int"), F.lit(number)).alias

    counted = train.count()
    workers = max(workers, -(-counted // WORKER_ROWS))
    rows = staged(train.select(dealt(1, workers)("worker"), dealt(5, batches)("batch"), "label", product.alias("x")), "descent")
    held = staged(validation.select("label", product.alias("x")), "descent-held")
    length = rows.agg(F.avg(F.aggregate("x", F.lit(0.0), lambda acc, v: acc + v * v))).first()[0]
    if not length:
        raise ValueError("no training rows to descend on")
    step = rate / length
    weights = [1.0] * rows.select(F.size("x")).first()[0]
    history = []
    for epoch in range(epochs + 1):
        history.append((epoch, _mse(rows, weights), _mse(held, weights), weights))
        if epoch < epochs:
            weights = _descended(rows, weights, step, batches)
    best = min(history, key=lambda h: (h[2] is None, h[2] or h[1]))
    return best[3], rows.sparkSession.createDataFrame(history, "epoch int, mse double, val_mse double, weights array<double>")


def _mse(rows: DataFrame, weights: Sequence[float]) -> float | None:
    factors = np.array(weights)

    def errors(x: pa.Array, label: pa.Array) -> pa.Array:
        found = x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), len(factors)) @ factors
        return pa.array((found - label.to_numpy(zero_copy_only=False)) ** 2)

    return rows.select(F.arrow_udf(errors, "double")("x", "label").alias("e")).agg(F.avg("e")).first()[0]


def _descended(rows: DataFrame, weights: Sequence[float], step: float, batches: int) -> list[float]:
    """The average of the weights that the workers reach from ``weights`` in one epoch."""
    start = np.array(weights)

    def descend(group: pa.Table) -> pa.Table:
        x = group["x"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(group), len(start))
        label, batch, own = group["label"].to_numpy(), group["batch"].to_numpy(), start.copy()
        for b in range(batches):
            mine = batch == b
            if mine.any():
                own -= step * 2 / mine.sum() * (x[mine].T @ (x[mine] @ own - label[mine]))
        return pa.table({"dim": np.arange(len(own)), "part": own * len(group), "n": np.full(len(own), len(group))})

    moved = rows.groupBy("worker").applyInArrow(descend, "dim long, part double, n long")
    means = moved.groupBy("dim").agg((F.sum("part") / F.sum("n")).alias("w")).orderBy("dim").collect()
    return [r["w"] for r in means]


def bi_gradient(pairs: DataFrame, weights: Sequence[float]) -> DataFrame:
    """(dim, gradient) of the mean squared error of sum(w * q * d) at ``weights``; zero at the least squares."""
    error = weighted_dot(F.col("query_vec"), F.col("doc_vec"), weights) - F.col("label")
    product = elementwise_product(F.col("query_vec"), F.col("doc_vec"))
    slopes = pairs.select((2 * error).alias("_e"), F.posexplode(product).alias("dim", "_x"))
    return slopes.groupBy("dim").agg(F.avg(F.col("_e") * F.col("_x")).alias("gradient"))


def weigh_queries(queries: DataFrame, weights: Sequence[float]) -> DataFrame:
    """Fold fitted weights into the query vectors, so the stored document vectors stay as they are.

    Search the result with ``cosine_topk(..., normalize=False)`` over unit document vectors.
    """
    factors = F.array(*[F.lit(float(w)) for w in weights])
    return queries.withColumn("embedding", elementwise_product(F.col("embedding"), factors))


def ranking_score(choices: DataFrame, score: str = "ce_score") -> DataFrame:
    """One row: mean reciprocal rank of the first positive, cut at ten, and the query count.

    ``choices`` are positives and negatives per query; equal scores are ordered by doc_id.
    """
    best = top_k(choices, ["query_id"], [F.col(score).desc(), F.col("doc_id").asc()], MRR_CUTOFF)
    per_query = best.groupBy("query_id").agg(F.min(F.when(F.col("positive"), F.col("rank"))).alias("first"))
    return per_query.agg(
        F.avg(F.coalesce(F.lit(1.0) / F.col("first"), F.lit(0.0))).alias("mrr10"),
        F.count("*").alias("n_queries"),
    )


def pair_estimator(kind: str, first: float, second: int) -> Pipeline:
    """A logistic scorer (regularisation, iterations) or boosted trees on binned features (depth, trees)."""
    if kind == "logistic":
        model = LogisticRegression(regParam=first, maxIter=second)
    elif kind == "trees":
        model = GBTClassifier(maxDepth=int(first), maxIter=second, maxBins=BINS, stepSize=SHRINKAGE, seed=1)
    else:
        raise ValueError(f"a pair scorer is logistic or trees, not {kind!r}")
    assembled = VectorAssembler(inputCols=list(FEATURES), outputCol="_raw")
    return Pipeline(stages=[assembled, StandardScaler(inputCol="_raw", outputCol="features", withMean=True), model])


def positive_labels(pairs: DataFrame) -> DataFrame:
    return pairs.withColumn("label", (F.col("score") > 0).cast("double"))


def fit_pair_scorer(
    train: DataFrame,
    validation: DataFrame,
    candidates: Sequence[tuple[str, float, int]] = CANDIDATES,
    reached: list[tuple[str, float]] | None = None,
) -> tuple[PipelineModel, float]:
    """The candidate with the best validation ranking (the first of equal ones), and that score.

    Both inputs carry the pair features, ``query_id``, ``doc_id`` and the grade ``score``. ``reached`` gets
    the kind and the score of each candidate.
    """
    labelled = positive_labels(train).persist()
    choices = require_choices(ranked_choices(validation)).persist()
    best: tuple[PipelineModel, float] | None = None
    try:
        for candidate in candidates:
            model = reloaded(pair_estimator(*candidate).fit(labelled), train.sparkSession)
            score = ranking_score(fitted_scorer(model)(choices)).first()["mrr10"]
            if reached is not None:
                reached.append((candidate[0], score))
            if best is None or score > best[1]:
                best = (model, score)
    finally:
        labelled.unpersist()
        choices.unpersist()
    if best is None:
        raise ValueError("no candidate to fit")
    return best


def logistic_gradient(pairs: DataFrame, model: PipelineModel) -> DataFrame:
    """(term, gradient): the slope of the mean log loss in each feature's coefficient, as scaled, and in the
    intercept; all zero where an unregularised fit has ended."""
    from pyspark.ml.functions import vector_to_array

    found = model.transform(positive_labels(pairs))
    error = F.get(vector_to_array("probability"), 1) - F.col("label")
    scaled = vector_to_array("features")
    slopes = found.select(
        F.explode(
            F.array(
                F.struct(F.lit("intercept").alias("term"), error.alias("_g")),
                *[F.struct(F.lit(name).alias("term"), (error * F.get(scaled, i)).alias("_g")) for i, name in enumerate(FEATURES)],
            )
        ).alias("_s")
    )
    return slopes.groupBy("_s.term").agg(F.avg("_s._g").alias("gradient"))


def tree_leaves(pairs: DataFrame, model: PipelineModel) -> DataFrame:
    """(tree, value, rows, expected) of every leaf of boosted trees over the rows they were fitted on.

    ``expected`` is the mean of what the tree was fitted to: the label as -1 or 1 for the first, then the
    downward slope of the log loss under the trees before it.
    """
    boosted = model.stages[-1]
    found = PipelineModel(model.stages[:-1]).transform(positive_labels(pairs)).select("features", (2 * F.col("label") - 1).alias("_y"))
    total, leaves = F.lit(0.0), []
    for number, (tree, weight) in enumerate(zip(boosted.trees, boosted.treeWeights)):
        found = tree.setPredictionCol(f"_t{number}").transform(found)
        target = F.col("_y") if number == 0 else 4 * F.col("_y") / (1 + F.exp(2 * F.col("_y") * total))
        total = total + F.lit(float(weight)) * F.col(f"_t{number}")
        leaves.append(F.struct(F.lit(number).alias("tree"), F.col(f"_t{number}").alias("value"), target.alias("_target")))
    rows = found.select(F.explode(F.array(*leaves)).alias("_l")).select("_l.*")
    return rows.groupBy("tree", "value").agg(F.count(F.lit(1)).alias("rows"), F.avg("_target").alias("expected"))


def reloaded(model: PipelineModel, spark: SparkSession) -> PipelineModel:
    """The model as read back from the shared folder.

    A freshly fitted one drags its training summary, and through it the session, into every task, which
    fails to serialize once the session has observed a DataFrame.
    """
    path = scratch_path(spark, "model")
    save_model(model, path)
    return load_model(path)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
