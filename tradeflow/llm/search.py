"""Exact top-k search by inner product with a pivot table.

Each vector's distances to many pivots are computed once and stored. For a query q
and a candidate c, the largest ``|d(q, p) - d(c, p)|`` over the pivots bounds their
distance from below, and so ``(|q|^2 + |c|^2 - bound^2) / 2`` bounds their inner
product from above. Candidates are evaluated in the order of that bound until it
falls below the k-th best score, so nothing better can be left.

The given queries meet all vectors in pairs of blocks, each a task's work of fixed
size. Every query starts from its k-th best score among the pivots, so most blocks
end after their bounds.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tradeflow.session import pin

PIVOTS, BLOCK, CHUNK, SCALE = 64, 1024, 128, 1024
# Above the rounding of the distances, which are kept in single precision.
SLACK = 1e-5


def whole(vector: Column) -> Column:
    """Neither null nor with a null, NaN or infinite component."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    return F.coalesce(vector.isNotNull() & fine, F.lit(False))


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of integers; shorter ones are filled up with zeros."""
    sizes = np.diff(column.offsets.to_numpy()) if len(column) else np.empty(0, int)
    values = column.flatten().to_numpy().astype(np.int64)
    out = np.zeros((len(sizes), int(sizes.max(initial=0))), np.int64)
    out[np.arange(out.shape[1])[None, :] < sizes[:, None]] = values
    return out


def _packed(column: pa.ChunkedArray, kind) -> np.ndarray:
    """Rows of packed numbers; shorter ones are filled up with zeros."""
    rows = column.to_pylist()
    width = max(map(len, rows), default=0)
    joined = b"".join(r.ljust(width, b"\0") for r in rows)
    return np.frombuffer(joined, kind).reshape(len(rows), width // np.dtype(kind).itemsize)


def _align(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    width = max(a.shape[1], b.shape[1])
    return tuple(
        x if x.shape[1] == width else np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (a, b)
    )


def exact(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows in a type in which their inner products are exact: doubles, which
    are fast, where these hold every sum, else 64-bit integers."""
    a, b = _align(a, b)
    top = [float(np.abs(x).max(initial=0)) for x in (a, b)]
    kind = float if top[0] * top[1] * max(1, a.shape[1]) < 2.0**52 else np.int64
    return a.astype(kind), b.astype(kind)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    a, b = exact(a, b)
    return (a @ b.T).astype(np.int64)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    a, b = _align(a.astype(float), b.astype(float))
    square = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2.0 * (a @ b.T)
    return np.sqrt(np.maximum(square, 0.0)).astype(np.float32)


def pivot_table(vectors: DataFrame, pivots: np.ndarray, pivot_ids: np.ndarray, k: int) -> DataFrame:
    """``v`` and ``dist`` (to each pivot) packed, ``norm``, and ``seed``: a query's k-th
    best score among the pivots other than itself, null if there are fewer. Of pivots
    equal to the query in id and vector one counts as itself."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            rows, ids = _matrix(batch.column(1)), batch.column(0).to_numpy()
            asks = batch.column(2).to_numpy(zero_copy_only=False)
            seeds: list = [None] * len(rows)
            wide, known = _align(rows, pivots)
            for i, scores in zip(np.flatnonzero(asks), products(rows[asks], pivots)):
                own = np.flatnonzero((pivot_ids == ids[i]) & (known == wide[i]).all(1))
                others = np.sort(np.delete(scores, own[:1]))[::-1]
                seeds[i] = int(others[k - 1]) if len(others) >= k else None
            arrays = [
                *[batch.column(0), pa.array([r.tobytes() for r in rows], pa.binary()), batch.column(2)],
                pa.array((rows.astype(float) ** 2).sum(1)),
                pa.array([d.tobytes() for d in distances(rows, pivots)], pa.binary()),
                pa.array(seeds, pa.int64()),
            ]
            names = ["vec_id", "v", "is_query", "norm", "dist", "seed", "row"]
            yield pa.RecordBatch.from_arrays([*arrays, batch.column(3)], names)

    kinds = "vec_id bigint, v binary, is_query boolean, norm double, dist binary, seed bigint, row bigint"
    return vectors.mapInArrow(run, kinds)


def best_of_block(query: tuple, block: tuple, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of the up to k best candidates that reach the query's seed."""
    own_row, q, q_norm, q_dist, seed = query
    places, ids, rows, norms, dists = block
    lower = np.zeros(len(ids), np.float32)
    for to_pivot, own in zip(dists, q_dist):
        np.maximum(lower, np.abs(to_pivot - own), out=lower)
    upper = (q_norm + norms - lower.astype(float) ** 2) / 2.0 + SLACK * (q_norm + norms) + 0.5
    able = np.flatnonzero((upper >= seed) & (places != own_row))
    if not len(able):
        return ids[:0], ids[:0]
    able = able[np.argsort(-upper[able], kind="stable")]
    best_ids, best = np.empty(0, np.int64), np.empty(0, np.int64)
    for at in range(0, len(able), CHUNK):
        part = able[at : at + CHUNK]
        if upper[part[0]] < (best[k - 1] if len(best) >= k else seed):
            break
        scores = (rows[part] @ q).astype(np.int64)
        best_ids, best = np.append(best_ids, ids[part]), np.append(best, scores)
        order = np.lexsort((best_ids, -best))[:k]
        best_ids, best = best_ids[order], best[order]
    reach = best >= seed
    return best_ids[reach], best[reach]


def _search(k: int):
    def run(queries: pa.Table, block: pa.Table) -> pa.Table:
        out = [np.empty(0, np.int64) for _ in range(3)]
        if queries.num_rows and block.num_rows:
            q_rows, rows = exact(_packed(queries.column("v"), np.int64), _packed(block.column("v"), np.int64))
            by_pivot = np.ascontiguousarray(_packed(block.column("dist"), np.float32).T)
            found = (block.column("row").to_numpy(), block.column("vec_id").to_numpy(), rows, block.column("norm").to_numpy(), by_pivot)
            asked = zip(
                queries.column("row").to_numpy(),
                q_rows,
                queries.column("norm").to_numpy(),
                _packed(queries.column("dist"), np.float32),
                [-math.inf if x is None else x for x in queries.column("seed").to_pylist()],
            )
            parts = [(q[0], *best_of_block(q, found, k)) for q in asked]
            parts = [(np.full(len(ids), q), ids, scores) for q, ids, scores in parts]
            out = [np.concatenate(p) for p in zip(*parts)]
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("query", "vec_id", "score"), out)})

    return run


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 10,
    pivots: int = PIVOTS,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    block: int = BLOCK,
) -> DataFrame:
    """``query_id``, ``rank`` from 1, ``vec_id`` and ``score`` of each query's k best.

    Components count as ``floor(1024 * x)``; the score is the inner product, ties
    go to the smaller id. Rows with a null id take no part, nor do vectors that are
    null or hold a null or non-finite component; a shorter vector counts as filled
    up with zeros. Each row is a vector of its own, also where ids repeat: every query
    row asks, and only its own row is no candidate, so a repeated id may have several
    rows of a rank. Equal vectors all stay candidates. No query, or an empty table,
    gives an empty result.
    """
    scaled = F.transform(
        F.col(f"`{embedding}`"), lambda x: F.floor(F.lit(float(SCALE)) * x.cast("double")).cast("bigint")
    )
    rows = vectors.filter(whole(F.col(f"`{embedding}`")) & F.col(f"`{vec_id}`").isNotNull())
    rows = rows.select(
        F.col(f"`{vec_id}`").cast("bigint").alias("vec_id"),
        scaled.alias("v"),
        F.coalesce(is_query, F.lit(False)).alias("is_query"),
        F.monotonically_increasing_id().alias("row"),
    )
    chosen = rows.orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(pivots).select("vec_id", "v").collect()
    width = max((len(r["v"]) for r in chosen), default=0)
    matrix = np.array([list(r["v"]) + [0] * (width - len(r["v"])) for r in chosen], np.int64)
    ids = np.array([r["vec_id"] for r in chosen], np.int64)
    known = pin(pivot_table(rows, matrix.reshape(len(chosen), width), ids, k), "pivot-table")

    n, n_queries = known.agg(F.count(F.lit(1)), F.count_if("is_query")).first()
    blocks, query_blocks = max(1, -(-n // block)), max(1, -(-n_queries // block))
    place = F.xxhash64("row", F.lit("block"))
    asked = known.filter("is_query").drop("is_query").withColumns(
        {
            "_qb": F.pmod(place, F.lit(query_blocks)).cast("int"),
            "_cb": F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))),
        }
    )
    stored = known.drop("is_query", "seed").withColumns(
        {
            "_qb": F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))),
            "_cb": F.pmod(place, F.lit(blocks)).cast("int"),
        }
    )
    found = (
        asked.groupBy("_qb", "_cb")
        .cogroup(stored.groupBy("_qb", "_cb"))
        .applyInArrow(_search(k), "query bigint, vec_id bigint, score bigint")
    )
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    names = known.filter("is_query").select(F.col("row").alias("query"), F.col("vec_id").alias("query_id"))
    return ranked.join(names, "query").select("query_id", "rank", "vec_id", "score")
