"""Message vectors, K-Means intents and the choice of their number."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window, functions as F, types as T

from ..functions.text import draw_order
from ..functions.vectors import normalized
from ..session import stage
from .rules import TOPIC_KEYWORDS, best_keywords
from .sampling import SEED, cluster_sample
from .tfidf import tokens

# Restarts, cluster counts and sample sizes.
RESTARTS = 10
CLUSTER_COUNTS = range(7, 14)
SILHOUETTE_ROWS = 5000
SAMPLES_PER_CLUSTER = 20
EXAMPLES_PER_CLUSTER = 3
# When a fit ends, and costs that count as equal.
MAX_ROUNDS, TOLERANCE, SAME_COST = 300, 1e-4, 1e-9
# Rows of a packed block, rows that fill a task, and partial sums that the driver adds up.
BLOCK_ROWS, ROWS_PER_TASK, COLLECTED_PARTS = 2048, 10_000, 64


def embed(
    df: DataFrame, text_col: str, out: str = "embedding",
    encoder: Callable[[list[str]], np.ndarray] | None = None, size: int = 256,
) -> DataFrame:
    """Add a unit-length message vector.

    ``encoder`` maps a batch of texts to a matrix and runs inside the tasks.
    Without one, texts are hashed to ``size`` term buckets on the JVM.
    """
    if encoder is None:
        words = df.withColumn("_words", tokens(F.col(text_col)))
        hashed = HashingTF(numFeatures=size, inputCol="_words", outputCol="_hashed").transform(words)
        return hashed.withColumn(out, normalized(vector_to_array(F.col("_hashed")))).drop("_words", "_hashed")

    schema = T.StructType(list(df.schema.fields) + [T.StructField(out, T.ArrayType(T.FloatType()))])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(**{out: list(np.asarray(encoder(batch[text_col].tolist()), dtype="float32"))})

    return df.mapInPandas(run, schema)


def _vectors(df: DataFrame, vec_col: str) -> DataFrame:
    return df.withColumn("features", array_to_vector(F.col(vec_col).cast("array<double>")))


@dataclass
class Clusters:
    """Centres of a K-Means fit, and what its rows cost in the last round."""

    centres: np.ndarray
    cost: float

    def clusterCenters(self) -> list[np.ndarray]:  # noqa: N802, as Spark ML names it
        return list(self.centres)

    def nearest(self, rows: np.ndarray) -> np.ndarray:
        return np.argmin((self.centres * self.centres).sum(axis=1) / 2 - rows @ self.centres.T, axis=1)


def _seeds(data: DataFrame, k: int, seed: int) -> np.ndarray:
    """Centres after Spark ML's seeding and one round."""
    model = KMeans(k=k, seed=seed, maxIter=1, featuresCol="features", predictionCol="cluster_id").fit(data)
    return np.array(model.clusterCenters())


def _blocks(data: DataFrame) -> DataFrame:
    """Vectors packed into blocks of up to ``BLOCK_ROWS`` rows."""
    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start in range(0, len(batch), BLOCK_ROWS):
                rows = np.stack(batch["x"].iloc[start:start + BLOCK_ROWS].to_numpy()).astype(np.float64)
                yield pd.DataFrame({"n": [len(rows)], "block": [rows.tobytes()]})

    return data.select(vector_to_array("features").alias("x")).mapInPandas(pack, "n bigint, block binary")


def _round(blocks: DataFrame, models: list[np.ndarray], parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums and counts of the rows of all clusters of all models, and the cost of each model, from one scan."""
    stacked = np.concatenate(models)
    bounds = np.cumsum([0, *map(len, models)])
    half, size = (stacked * stacked).sum(axis=1) / 2, stacked.shape[1]

    def packed(total: list[np.ndarray]) -> pd.DataFrame:
        return pd.DataFrame({"total": [np.concatenate([x.ravel() for x in total]).tobytes()]})

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = [np.zeros_like(stacked), np.zeros(len(stacked)), np.zeros(len(models))]
        for batch in batches:
            for n, block in zip(batch["n"], batch["block"]):
                rows = np.frombuffer(block).reshape(n, size)
                far, own, squares = half - rows @ stacked.T, np.zeros((n, len(stacked))), (rows * rows).sum()
                for m, (begin, end) in enumerate(zip(bounds[:-1], bounds[1:])):
                    nearest = far[:, begin:end].argmin(axis=1) + begin
                    own[np.arange(n), nearest] = 1
                    total[2][m] += max(0.0, squares + 2 * far[np.arange(n), nearest].sum())
                total[0] += own.T @ rows
                total[1] += own.sum(axis=0)
        yield packed(total)

    def split(total: bytes) -> list[np.ndarray]:
        flat = np.frombuffer(total)
        return [flat[:stacked.size].reshape(stacked.shape), flat[stacked.size:stacked.size + len(stacked)], flat[-len(models):]]

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = [np.zeros_like(stacked), np.zeros(len(stacked)), np.zeros(len(models))]
        for batch in batches:
            for one in batch["total"]:
                for mine, other in zip(total, split(one)):
                    mine += other
        yield packed(total)

    partial = blocks.mapInPandas(scan, "total binary")
    while parts > COLLECTED_PARTS:
        parts = math.ceil(parts / COLLECTED_PARTS)
        partial = partial.repartition(parts).mapInPandas(add, "total binary")
    sums = [split(row["total"]) for row in partial.collect()]  # bounded: at most COLLECTED_PARTS rows
    return tuple(sum(x) for x in zip(*sums))


def fit_kmeans(
    df: DataFrame, vec_col: str, ks: Sequence[int], restarts: int = RESTARTS, seed: int = SEED, parallel: int = 8
) -> dict[int, Clusters]:
    """Best of several seeded fits for every k; lowest training cost wins, the earlier restart among equal ones.

    Fits are seeded by Spark ML side by side.  Then all of them advance together: a scan of the table, packed into
    blocks, moves the centres of every model, and models whose centres stand leave.
    """
    vectors = _vectors(df, vec_col).select("features")
    rows, cores = vectors.count(), df.sparkSession.sparkContext.defaultParallelism
    tasks = min(cores, math.ceil(rows / ROWS_PER_TASK))
    if vectors.rdd.getNumPartitions() < tasks:
        vectors = vectors.repartition(tasks)
    data = vectors.persist(StorageLevel.MEMORY_AND_DISK)
    blocks = _blocks(data).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        runs = [(k, seed + i) for k in ks for i in range(restarts)]
        with ThreadPool(parallel) as pool:
            centres = pool.map(lambda run: _seeds(data, *run), runs, chunksize=1)
        blocks.count()
        data.unpersist()
        parts, costs = blocks.rdd.getNumPartitions(), [math.inf] * len(runs)
        moving = list(range(len(runs)))
        for _ in range(MAX_ROUNDS - 1):
            if not moving:
                break
            sums, counts, cost = _round(blocks, [centres[m] for m in moving], parts)
            begin, stay = 0, []
            for i, m in enumerate(moving):
                some = slice(begin, begin := begin + len(centres[m]))
                held = counts[some, None]
                moved = np.where(held > 0, sums[some] / np.maximum(held, 1), centres[m])
                if (((moved - centres[m]) ** 2).sum(axis=1) > TOLERANCE ** 2).any():
                    stay.append(m)
                centres[m], costs[m] = moved, float(cost[i])
            moving = stay
    finally:
        data.unpersist()
        blocks.unpersist()
    best: dict[int, Clusters] = {}
    for (k, _), points, cost in zip(runs, centres, costs):
        if k not in best or cost < best[k].cost * (1 - SAME_COST):
            best[k] = Clusters(points, cost)
    return best


def assign_clusters(df: DataFrame, vec_col: str, model: Clusters) -> DataFrame:
    @F.pandas_udf("int")
    def nearest(vectors: pd.Series) -> pd.Series:
        return pd.Series(model.nearest(np.stack(vectors.to_numpy())) if len(vectors) else [], dtype="int32")

    return _vectors(df, vec_col).withColumn("cluster_id", nearest(vector_to_array("features"))).drop("features")


def silhouette(df: DataFrame, id_col: str, vec_col: str, cluster_col: str, rows: int = SILHOUETTE_ROWS, seed: int = SEED) -> DataFrame:
    """Euclidean silhouette per row of a sample: (id, cluster, silhouette).

    The sample (``rows`` lowest in draw order) is what every row is compared
    with, so the block sent to the tasks never has more than ``rows`` vectors,
    and no task holds more than one slice of the distance matrix.
    """
    sample = (
        df.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("vector"), F.col(cluster_col).cast("int").alias("cluster"))
        .orderBy(draw_order(seed, F.col(id_col)), id_col).limit(rows)
    )
    block = sample.toPandas()
    schema = T.StructType([
        T.StructField("id", df.schema[id_col].dataType), T.StructField("cluster", T.IntegerType()), T.StructField("silhouette", T.DoubleType())])
    if block.empty:
        return df.sparkSession.createDataFrame([], schema)
    matrix = np.stack(block["vector"].to_numpy())
    names, member = np.unique(block["cluster"].to_numpy(), return_inverse=True)
    one_hot = np.eye(len(names))[member]
    sizes = one_hot.sum(axis=0)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start in range(0, len(batch), 256):
                part = batch.iloc[start:start + 256]
                here = np.stack(part["vector"].to_numpy())
                squares = (here * here).sum(axis=1)[:, None] + (matrix * matrix).sum(axis=1)[None, :] - 2 * here @ matrix.T
                near = squares < 1e-6
                distance = np.sqrt(np.maximum(squares, 0))
                # The expanded square loses digits for close pairs: take those directly.
                for i, j in zip(*np.nonzero(near)):
                    distance[i, j] = np.sqrt(((here[i] - matrix[j]) ** 2).sum())
                sums = distance @ one_hot
                own = np.searchsorted(names, part["cluster"].to_numpy())
                pick = np.arange(len(part))
                alone = sizes[own] <= 1
                inner = sums[pick, own] / np.maximum(sizes[own] - 1, 1)
                means = sums / sizes
                means[pick, own] = np.inf
                outer = means.min(axis=1)
                top = np.maximum(inner, outer)
                score = np.where(alone | (top == 0) | ~np.isfinite(outer), 0.0, (outer - inner) / np.where(top == 0, 1, top))
                yield pd.DataFrame({"id": part["id"].to_numpy(), "cluster": part["cluster"].to_numpy(), "silhouette": score})

    return sample.repartition(F.col("id")).mapInPandas(run, schema)


def choose_k(
    df: DataFrame, id_col: str, vec_col: str, ks: Sequence[int] = CLUSTER_COUNTS, restarts: int = RESTARTS, seed: int = SEED
) -> tuple[DataFrame, dict[int, Clusters]]:
    """(k, silhouette, is_best) for every candidate k, and the fitted models."""
    models = fit_kmeans(df, vec_col, ks, restarts, seed)
    # One sample, drawn once, serves every k; only its rows are assigned.
    sample = stage(df.select(id_col, vec_col).orderBy(draw_order(seed, F.col(id_col)), id_col).limit(SILHOUETTE_ROWS), "silhouette-sample")
    scores = None
    for k, model in models.items():
        one = silhouette(assign_clusters(sample, vec_col, model), id_col, vec_col, "cluster_id", seed=seed).agg(
            F.avg("silhouette").alias("silhouette")).withColumn("k", F.lit(k))
        scores = one if scores is None else scores.unionByName(one)
    best = Window.orderBy(F.desc("silhouette"), "k")
    return scores.select("k", "silhouette", (F.row_number().over(best) == 1).alias("is_best")), models


def cluster_sizes(df: DataFrame, cluster: str) -> DataFrame:
    return df.groupBy(cluster).agg(F.count("*").alias("cluster_size"))


def topic_taxonomy(
    df: DataFrame, cluster: str, id_col: str, text_col: str,
    topics: Mapping[str, Sequence[str]] = TOPIC_KEYWORDS, seed: int = SEED, limit: int = SAMPLES_PER_CLUSTER,
) -> DataFrame:
    """Name every cluster after the topic with most keywords in its sample.

    Gives one taxonomy row per cluster; ties go to the earlier topic and no
    keyword at all gives ``other``.
    """
    drawn = cluster_sample(df.select(cluster, id_col, text_col), cluster, id_col, limit, seed)
    gathered = (
        drawn.groupBy(cluster)
        .agg(F.array_sort(F.collect_list(F.struct("place", F.col(text_col).alias("text")))).alias("sample"))
        .withColumn("all_text", F.concat_ws(" ", F.transform("sample", lambda s: F.lower(s["text"]))))
    )
    sizes = cluster_sizes(df, cluster).withColumnRenamed(cluster, "_cluster")
    named = gathered.join(sizes, F.col(cluster) == F.col("_cluster")).drop("_cluster")
    return named.select(
        F.col(cluster).alias("cluster_id"),
        best_keywords(F.col("all_text"), list(topics.items()), F.lit("other")).alias("intent_label"),
        F.concat(F.lit("Cluster "), F.col(cluster).cast("string"), F.lit(" ("), F.col("cluster_size").cast("string"), F.lit(" messages)")).alias("description"),
        F.array().cast("array<string>").alias("keywords"),
        F.lit(False).alias("typically_needs_escalation"),
        "cluster_size",
        F.transform(F.slice("sample", 1, EXAMPLES_PER_CLUSTER), lambda s: s["text"]).alias("example_messages"),
    )
