"""Nearest neighbours of a stated query set among all rows, in two stages."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Query vectors held by a task at a time; the query set goes over all rows in blocks of this size.
BLOCK = 4096


def nearest(rows: DataFrame, queries: DataFrame, k: int = 5, key: str = "vec_id", vector: str = "embedding", block: int = BLOCK) -> DataFrame:
    """(query_id, neighbour_id, score, rank): the k most similar other rows of each query by cosine; ties go to the smaller id.

    Every task keeps its best k of each query, so k rows per query and task are shuffled.  Null vectors and keys match
    nothing; a vector without length has similarity 0.
    """
    spark = rows.sparkSession
    kind = rows.schema[key].dataType.simpleString()
    data = rows.where(F.col(key).isNotNull() & F.col(vector).isNotNull()).select(F.col(key).alias("key"), F.col(vector).alias("vector"))
    asked = queries.where(F.col(key).isNotNull() & F.col(vector).isNotNull()).select(F.col(key).alias("key"), F.col(vector).alias("vector"))

    def search(ids: np.ndarray, unit: np.ndarray) -> DataFrame:
        shared = spark.sparkContext.broadcast((ids, unit))

        def run(batches):
            qid, q = shared.value
            best: tuple[np.ndarray, np.ndarray] | None = None
            for pdf in batches:
                if pdf.empty:
                    continue
                m = np.stack(pdf["vector"].to_numpy()).astype(np.float64)
                m /= np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-300)
                own = pdf["key"].to_numpy()
                score = q @ m.T
                score[qid[:, None] == own[None, :]] = -np.inf
                names = np.broadcast_to(own, score.shape)
                if best is not None:
                    score, names = np.hstack([best[0], score]), np.hstack([best[1], names])
                order = np.lexsort((names, -np.round(score, 12)), axis=1)[:, :k]
                best = np.take_along_axis(score, order, 1), np.take_along_axis(names, order, 1)
            if best is not None:
                width = best[0].shape[1]
                out = pd.DataFrame({"query_id": np.repeat(qid, width), "neighbour_id": best[1].ravel(), "score": best[0].ravel()})
                yield out[np.isfinite(out["score"])]

        return data.mapInPandas(run, f"query_id {kind}, neighbour_id {kind}, score double")

    found, ids, vectors = None, [], []

    def flush() -> None:
        nonlocal found, ids, vectors
        m = np.array(vectors, np.float64)
        m /= np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-300)
        part = search(np.array(ids), m)
        found = part if found is None else found.union(part)
        ids, vectors = [], []

    for row in asked.toLocalIterator():
        ids.append(row.key)
        vectors.append(row.vector)
        if len(ids) == block:
            flush()
    if ids:
        flush()
    if found is None:
        return spark.createDataFrame([], f"query_id {kind}, neighbour_id {kind}, score double, rank int")
    order = Window.partitionBy("query_id").orderBy(F.desc(F.round("score", 12)), "neighbour_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
