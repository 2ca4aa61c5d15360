"""Exact top-k by inner product with a pivot table.

Vectors of integers are lifted to one more coordinate, ``sqrt(M - |x|^2)`` with M the
largest squared length (0 for queries), so that the squared distance of a query and a
vector is ``|q|^2 + M - 2 q.x``: the best scores are the nearest vectors. The distances
of every vector to fixed pivots are computed once. The largest difference of two
vectors' distances to a pivot is a lower bound of their own; candidates are evaluated in
the order of that bound until none left can reach the k-th best score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stocklake.llm.common import Staging, map_arrow

SCALE = 256
PIVOTS = 32
#: Pivots are chosen among about so many vectors, by a hash of the id.
PIVOT_SAMPLE = 2048
#: Rows of a block of candidates and of queries.
CANDIDATES, QUERIES = 8192, 1024
#: Candidates evaluated at once.
STEP = 128


def integers(embedding: Column) -> Column:
    """``floor(256 * x)`` of each component; null if a component is null or not finite."""
    value = F.transform(embedding, lambda x: x.cast("double"))
    sound = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(F.coalesce(sound, F.lit(False)), F.transform(value, lambda x: F.floor(x * SCALE)))


def choose_pivots(sample: np.ndarray, count: int) -> np.ndarray:
    """Rows far from each other: each next one is the farthest from those before."""
    if not len(sample):
        return sample
    chosen = [int(np.argmax((sample**2).sum(axis=1)))]
    far = ((sample - sample[chosen[0]]) ** 2).sum(axis=1)
    while len(chosen) < min(count, len(sample)) and far.max() > 0:
        chosen.append(int(np.argmax(far)))
        far = np.minimum(far, ((sample - sample[chosen[-1]]) ** 2).sum(axis=1))
    return sample[chosen]


def pivot_distances(rows: np.ndarray, lift: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances (rows x pivots) of lifted rows to the pivots, which have a lift of 0."""
    squares = (rows**2).sum(axis=1)[:, None] + lift[:, None] ** 2 + (pivots**2).sum(axis=1)
    return np.sqrt(np.maximum(squares - 2 * rows @ pivots.T, 0))


def search_block(
    queries: np.ndarray,
    query_ids: np.ndarray,
    query_table: np.ndarray,
    rows: np.ndarray,
    row_ids: np.ndarray,
    row_table: np.ndarray,
    top: float,
    k: int,
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per query its id, and ids and scores of the k best rows, ties to smaller ids.

    ``top`` is the M of the lift. A row is left out only if its bound says that its score
    is below the k-th best found; bounds are lowered by more than the rounding error.
    """
    slack = 1e-7 * (np.sqrt(top) + 1)
    for i, query in enumerate(queries):
        bound = np.zeros(len(rows))
        for pivot in range(row_table.shape[1]):
            np.maximum(bound, np.abs(row_table[:, pivot] - query_table[i, pivot]), out=bound)
        bound -= slack
        order = np.argsort(bound, kind="stable")
        size = float(query @ query) + top
        ids, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for start in range(0, len(order), STEP):
            part = order[start : start + STEP]
            if len(ids) == k:
                # The score a row at this distance would have; below the k-th it ends.
                reach = (size - max(bound[part[0]], 0.0) ** 2) / 2
                if reach < scores[-1]:
                    break
            part = part[row_ids[part] != query_ids[i]]
            ids = np.concatenate((ids, row_ids[part]))
            scores = np.concatenate((scores, np.rint(rows[part] @ query).astype(np.int64)))
            best = np.lexsort((ids, -scores))[:k]
            ids, scores = ids[best], scores[best]
        yield int(query_ids[i]), ids, scores


def top_k(
    embeddings: DataFrame, k: int = 5, every: int = 50, pivots: int = PIVOTS,
    candidates: int = CANDIDATES, queries: int = QUERIES,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each vector whose id is divisible by
    ``every`` the ``k`` others with the highest integer inner product.

    Vectors that are null or hold a null or non-finite component, and those without an
    id, take no part. Vectors of different lengths are not compared. A row's own id is no
    candidate, whatever rows repeat it; other repeated ids count once per row. Rows that
    repeat a query are one query, rows of one id with different vectors are answered
    together. Scores are exact while they are below 2**53. An empty table gives no rows.

    Candidates and queries are dealt by a hash to blocks of bounded size; a task has one
    pair of blocks, so nothing is broadcast but the pivots, and a vector that a third of
    the rows repeat is spread over all blocks. Blocks send on k rows per query.
    """
    spark = embeddings.sparkSession
    staging = Staging(spark, "top-k")
    sound = (
        embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), integers(F.col("embedding")).alias("v"))
        .where("vec_id is not null and v is not null")
        .withColumn("dim", F.size("v"))
    )
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    sound = staging.write(sound.withColumn("square", square), "vectors")
    sizes = {
        r.dim: (r.n, r.top)
        for r in sound.groupBy("dim").agg(F.count("*").alias("n"), F.max("square").alias("top")).collect()
    }
    asked = {r.dim: r.n for r in sound.where(F.col("vec_id") % every == 0).groupBy("dim").agg(F.count("*").alias("n")).collect()}
    spot = F.pmod(F.xxhash64(F.lit("pivot"), "vec_id"), F.lit(1 << 30))
    table = {}
    for dim in sorted(asked):
        n, top = sizes[dim]
        few = sound.where((F.col("dim") == dim) & (spot < min(1 << 30, PIVOT_SAMPLE * (1 << 30) // n)))
        sample = few.select("v").limit(2 * PIVOT_SAMPLE).collect()
        rows = np.array([r.v for r in sample], float).reshape(len(sample), dim)
        table[dim] = (choose_pivots(rows, pivots), top, -(-n // candidates), -(-asked[dim] // queries))
    held = spark.sparkContext.broadcast(table)
    kinds = "dim int, block int, vec_id long, vector binary, distances binary"

    def measured(lifted: bool):
        def run(batches):
            for batch in batches:
                dims = batch["dim"].to_numpy()
                vectors = batch["v"].to_pylist()
                raw: list = [None] * len(vectors)
                distances: list = [None] * len(vectors)
                for dim in np.unique(dims).tolist():
                    here = np.nonzero(dims == dim)[0]
                    rows = np.array([vectors[i] for i in here], float).reshape(len(here), dim)
                    chosen, top, _, _ = held.value[dim]
                    squares = (rows**2).sum(axis=1)
                    lift = np.sqrt(np.maximum(top - squares, 0)) if lifted else np.zeros(len(here))
                    table = pivot_distances(rows, lift, chosen)
                    for i, row, far in zip(here, rows, table, strict=True):
                        raw[i], distances[i] = row.tobytes(), far.tobytes()
                yield pa.record_batch(
                    [
                        *(batch[c] for c in ("dim", "block", "vec_id")),
                        pa.array(raw, pa.binary()),
                        pa.array(distances, pa.binary()),
                    ],
                    names=["dim", "block", "vec_id", "vector", "distances"],
                )

        return run

    def blocked(rows: DataFrame, which: int) -> DataFrame:
        counts = F.coalesce(*[F.when(F.col("dim") == d, F.lit(t[which])) for d, t in table.items()], F.lit(1))
        block = F.pmod(F.xxhash64(F.lit("block"), "vec_id", F.monotonically_increasing_id()), counts)
        return rows.withColumn("block", block.cast("int")).select("dim", "block", "vec_id", "v")

    def numbers(which: int) -> Column:
        """The numbers of the other side's blocks."""
        counts = F.coalesce(*[F.when(F.col("dim") == d, F.lit(t[which])) for d, t in table.items()], F.lit(1))
        return F.explode(F.sequence(F.lit(0), counts - 1))

    if not table:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    rows = sound.where(F.col("dim").isin(list(table)))
    wanted = rows.where(F.col("vec_id") % every == 0).dropDuplicates(["vec_id", "v"])
    pivoted = staging.write(map_arrow(blocked(rows, 2), measured(True), kinds, 4096), "pivoted")
    asking = staging.write(map_arrow(blocked(wanted, 3), measured(False), kinds, 4096), "asking")
    left = asking.withColumnRenamed("block", "query_block").withColumn("block", numbers(2))
    right = pivoted.withColumn("query_block", numbers(3))

    def search(asks: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[int, int, int]] = []
        if len(asks) and len(block):
            dim = int(block["dim"].iloc[0])
            chosen, top, _, _ = held.value[dim]
            array = lambda column, width: np.frombuffer(b"".join(column)).reshape(len(column), width)
            found = search_block(
                array(asks["vector"], dim), asks["vec_id"].to_numpy(), array(asks["distances"], len(chosen)),
                array(block["vector"], dim), block["vec_id"].to_numpy(), array(block["distances"], len(chosen)),
                top, k,
            )
            for query, ids, scores in found:
                out.extend((query, int(i), int(s)) for i, s in zip(ids, scores, strict=True))
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype("int64")

    keys = ("dim", "query_block", "block")
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(
        search, "query_id long, vec_id long, score long"
    )
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    # The cut to k rows per query is made before the shuffle as well.
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
