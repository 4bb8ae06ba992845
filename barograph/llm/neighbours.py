"""Block matrix join: nearest vectors by tiles of int8 products, with error bounds and a float recheck.

Queries and candidates are cut into blocks, and each pair of blocks is one tile in one group. In a tile the
int8 codes are multiplied (exactly, in float32: 1,024 components at a time, so that sums stay below 2^24) and scaled. With
q = q^ + e and c = c^ + f, the product is off by at most |q| |f| + |e| |c^|, which bounds every score from
both sides. Candidates whose upper bound is below the k-th largest lower bound of the tile
cannot be among the k nearest; the others are recomputed in double precision on the
original vectors, summed in the order of the components. The k best of each tile are merged by heaps,
for a block of queries and a bounded number of tiles at a time.

An id may have several vectors. They lie in one block, and a pair of ids counts with its largest product.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize


@dataclass(frozen=True)
class Blocks:
    """Neighbours per query, rows of a tile's two sides, and tiles whose results are merged at a time."""

    k: int = 20
    query_rows: int = 1024
    candidate_rows: int = 8192
    merged: int = 32


#: Components whose code products add up exactly in float32: 127^2 x 1,024 < 2^24.
EXACT = 1024


def codes(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes as float32, scale per row, and the norm of what the codes leave out.

    A row too small to be scaled has zero codes and is left out whole.
    """
    scale = np.abs(rows).max(axis=1) / 127
    code = np.rint(rows / np.where(scale > 0, scale, np.inf)[:, None])
    return code.astype(np.float32), scale, norms(rows - code * scale[:, None])


def norms(rows: np.ndarray) -> np.ndarray:
    """Euclidean norms of rows whose squares may overflow or vanish."""
    top = np.abs(rows).max(axis=1)
    return np.linalg.norm(rows / np.where(top > 0, top, 1.0)[:, None], axis=1) * top


def code_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact products of all rows of codes."""
    parts = (a[:, j : j + EXACT] @ b[:, j : j + EXACT].T for j in range(0, a.shape[1], EXACT))
    return sum(part.astype(np.float64) for part in parts)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row inner products, components added in their order."""
    total = np.zeros(len(a))
    for j in range(a.shape[1]):
        total += a[:, j] * b[:, j]
    return total


def tile(query_ids, queries, ids, rows, k: int) -> list[tuple[int, int, float]]:
    """The k nearest ids of ``rows`` for each query row, as (query, id, score)."""
    qc, qs, qe = codes(queries)
    cc, cs, ce = codes(rows)
    out = []
    step = max(1, 4_000_000 // max(1, len(rows)))
    near = norms(cc) * cs
    # With at most so many rows to an id, the k times as many nearest rows hold k ids.
    many = int(np.unique(ids, return_counts=True)[1].max(initial=1))
    for at in range(0, len(queries), step):
        part = slice(at, at + step)
        score = code_products(qc[part], cc) * qs[part][:, None] * cs
        slack = norms(queries[part])[:, None] * ce + qe[part][:, None] * near
        slack = slack * (1 + 1e-9) + 1e-12 * np.abs(score) + 1e-300
        own = query_ids[part][:, None] == ids
        low = np.where(own, -np.inf, score - slack)
        kth = min(k * many, low.shape[1])
        bound = -np.partition(-low, kth - 1, axis=1)[:, kth - 1]
        q, c = np.nonzero((score + slack >= bound[:, None]) & ~own)
        exact = np.empty(len(q))
        for i in range(0, len(q), 200_000):
            some = slice(i, i + 200_000)
            exact[some] = products(queries[at + q[some]], rows[c[some]])
        if many > 1:  # of the rows of an id the nearest
            order = np.lexsort((-exact, ids[c], q))
            q, c, exact = q[order], c[order], exact[order]
            first = np.ones(len(q), bool)
            first[1:] = (q[1:] != q[:-1]) | (ids[c[1:]] != ids[c[:-1]])
            q, c, exact = q[first], c[first], exact[first]
        order = np.lexsort((ids[c], -exact, q))
        q, c, exact = q[order], c[order], exact[order]
        rank = np.arange(len(q)) - np.searchsorted(q, q)
        best = rank < k
        out += zip(query_ids[at + q[best]].tolist(), ids[c[best]].tolist(), exact[best].tolist(), strict=True)
    return out


FOUND = "query_id long, down long, tile long, vec_id long, score double"


def _tile(k: int):
    def run(key: tuple, queries: pa.Table, rows: pa.Table) -> pa.Table:
        found = []
        if len(queries) and len(rows):
            width = key[0].as_py()
            sides = queries.column("vector"), rows.column("other")
            a, b = (side.combine_chunks().flatten().to_numpy().reshape(-1, width) for side in sides)
            found = tile(queries.column("id").to_numpy(), a, rows.column("near").to_numpy(), b, k)
        ids, near, score = zip(*found, strict=True) if found else ((), (), ())
        n = len(found)
        columns = [ids, [key[1].as_py()] * n, [key[2].as_py()] * n, near, score]
        kinds = [pa.int64()] * 4 + [pa.float64()]
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=NAMES)

    return run


NAMES = [f.split(" ")[0] for f in FOUND.split(", ")]


def _merge(k: int):
    """The k best ids of each query of a block, from the sorted runs of its tiles and vectors."""

    def best(runs: list) -> list[tuple[float, int]]:
        out, seen = [], set()
        for far, one in heapq.merge(*runs):
            if one not in seen:  # several vectors of the query may have found it
                seen.add(one)
                out.append((far, one))
                if len(out) == k:
                    break
        return out

    def merge(key: tuple, rows: pa.Table) -> pa.Table:
        query, place = rows.column("query_id").to_numpy(), rows.column("tile").to_numpy()
        one, far = rows.column("vec_id").to_numpy(), -rows.column("score").to_numpy()
        order = np.lexsort((one, far, place, query))
        query, place, one, far = query[order], place[order], one[order], far[order]
        cuts = np.flatnonzero((np.diff(query, prepend=query[0] - 1) != 0) | (np.diff(place, prepend=place[0] - 1) != 0))
        runs: dict[int, list] = {}
        for low, high in zip(cuts.tolist(), [*cuts[1:].tolist(), len(query)], strict=True):
            runs.setdefault(int(query[low]), []).append(zip(far[low:high].tolist(), one[low:high].tolist(), strict=True))
        found = [(q, -f, i) for q, parts in runs.items() for f, i in best(parts)]
        q, score, ids = zip(*found, strict=True)
        n, values = len(found), [k.as_py() for k in key]
        columns = [q, [values[0]] * n, [values[1]] * n, ids, score]
        kinds = [pa.int64()] * 4 + [pa.float64()]
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=NAMES)

    return merge


def nearest(vectors: DataFrame, is_query: Column, blocks: Blocks = Blocks()) -> DataFrame:
    """(query_id, rank, vec_id, score): the k largest inner products of each query, ties to the smaller id.

    ``vectors`` has vec_id and embedding; all take part as candidates, never as their own query's. Rows whose id
    or vector is null, and vectors that are empty, zero or hold null or non-finite components take no part.
    Rows that repeat an id all take part: a pair of ids counts once, with the largest product of their vectors.
    Vectors of different lengths have no product: a query finds vectors of its own length. Other columns are ignored.
    """
    number = F.col("embedding").cast("array<double>")
    fit = F.size(number) > 0
    fit &= ~F.exists(number, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    fit &= F.exists(number, lambda x: x != 0)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), number.alias("vector")).where(
        F.col("vec_id").isNotNull() & F.col("vector").isNotNull()
    )
    rows = rows.where(fit).distinct().withColumn("query", is_query).withColumn("width", F.size("vector"))
    rows = materialize(rows.withColumnRenamed("vec_id", "id"), "vectors")
    sizes = rows.groupBy("width").agg(F.count("*").alias("rows"), F.count_if("query").alias("queries"))
    sizes = [  # one row per vector length
        (r["width"], max(1, -(-r["rows"] // blocks.candidate_rows)), max(1, -(-r["queries"] // blocks.query_rows)))
        for r in sizes.collect()
    ]
    spark = vectors.sparkSession
    counts = spark.createDataFrame(sizes, "width int, across long, down long")
    rows = rows.join(F.broadcast(counts), "width")
    spread = F.xxhash64("id")

    def every(count: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(count) - 1))

    queries = rows.where("query").select(
        "width", F.pmod(spread, F.col("down")).alias("row"), every("across").alias("tile"), "id", "vector"
    )
    others = rows.select(
        F.col("width").alias("size"), every("down").alias("to"), F.pmod(spread, F.col("across")).alias("block"),
        F.col("id").alias("near"), F.col("vector").alias("other"),
    )
    found = queries.groupBy("width", "row", "tile").cogroup(others.groupBy("size", "to", "block")).applyInArrow(
        _tile(blocks.k), FOUND
    )
    # The vectors of a query have neighbours of their own; those of one id, of any length, meet here.
    parts = max(1, sum(down for _, _, down in sizes))
    found = found.withColumn("down", F.pmod(F.xxhash64("query_id"), F.lit(parts)))
    tiles = max([across for _, across, _ in sizes], default=1)
    while True:
        found = found.withColumn("next", F.floor(F.col("tile") / blocks.merged))
        found = found.groupBy("down", "next").applyInArrow(_merge(blocks.k), FOUND)
        if tiles <= blocks.merged:
            break
        tiles = -(-tiles // blocks.merged)
    order = F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("far"), "vec_id")))
    listed = found.groupBy("query_id").agg(order.alias("found"))  # k rows per query
    listed = listed.select("query_id", F.posexplode("found").alias("place", "one"))
    return listed.select(
        "query_id", (F.col("place") + 1).cast("int").alias("rank"), F.col("one.vec_id").alias("vec_id"),
        (-F.col("one.far")).alias("score"),
    )
