"""Exact nearest neighbours by inner product, as a block matrix join.

Queries and candidates are dealt into blocks by hash of their id, and every query block
meets every candidate block in one tile. A tile multiplies int8 matrices; rounding a
vector to scale * int8 leaves a rest e, and by Cauchy-Schwarz the product of the rounded
vectors differs from the true one by at most |e_x| |y| + |x'| |e_y|. A pair survives if its
upper bound reaches the k-th largest lower bound of its query in the tile. Survivors are
recomputed from the original vectors in double precision, component after component, and
each query's best k of every tile are merged in a heap.

A task holds one tile: its size is set by the block sizes, not by the table. Queries are a
stated share of the rows, so the work grows with queries times candidates; tiles move
through shuffles, and no side is broadcast or collected.

Defined cases: vectors that are null, empty, all zero, or hold null or non-finite
components take no part, nor do rows without an id; of rows that share an id the one with
the smallest bytes counts; vectors of different lengths are not compared; equal scores
rank by smaller id; a score beyond the range of a double is infinite, and lowest if its sum has
no value; below k candidates all are returned; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

QUERY_ROWS, CANDIDATE_ROWS = 1024, 8192
# Sums of products of int8 values are whole numbers below 2^24, exact in float32, up to so
# many components; longer vectors are multiplied in parts.
EXACT = 2 ** 24 // 127 ** 2
BLOCK = ("tile_query int, tile_candidate int, dim int, ids binary, vectors binary, "
         "rounded binary, scale binary, rest binary, norm binary")


def usable(ids: pa.ChunkedArray, vectors: pa.ChunkedArray) -> dict[int, dict[int, np.ndarray]]:
    """Usable vectors by length and id, as float32 if the column is, or else in double precision."""
    found: dict[int, dict[int, np.ndarray]] = {}
    for i, v in zip(ids.to_pylist(), vectors):
        if i is None or not v.is_valid or v.values.null_count or not len(v.values):
            continue
        x = v.values.to_numpy(zero_copy_only=False)
        x = x if x.dtype == np.float32 else x.astype(np.float64)
        if not np.isfinite(x).all() or not x.any():
            continue
        same = found.setdefault(len(x), {})
        if i not in same or x.tobytes() < same[i].tobytes():
            same[i] = x
    return found


def lengths(x: np.ndarray) -> np.ndarray:
    """Norms of rows whose squares may leave the range of a double."""
    most = np.abs(x).max(axis=1)
    unit = np.where(most > 0, most, 1.0)
    with np.errstate(over="ignore"):
        return np.linalg.norm(x / unit[:, None], axis=1) * unit


def as_block(key: tuple, table: pa.Table) -> pa.Table:
    """The rows of a block, by vector length: ids, vectors, rounded vectors and bounds."""
    rows = []
    for dim, by_id in usable(table["vec_id"], table["embedding"]).items():
        ids = np.array(sorted(by_id), np.int64)
        x = np.stack([by_id[i] for i in ids])
        wide = x.astype(np.float64)
        # the smallest doubles divide by 127 to 0
        scale = np.maximum(np.abs(wide).max(axis=1) / 127, np.finfo(np.float64).tiny)
        rounded = np.clip(np.rint(wide / scale[:, None]), -127, 127).astype(np.int8)
        back = rounded * scale[:, None]
        rows.append((key[0].as_py(), 0, dim, ids.tobytes(), x.tobytes(), rounded.tobytes(),
                     scale.tobytes(), lengths(wide - back).tobytes(), lengths(back).tobytes()))
    names = [part.split()[0] for part in BLOCK.split(", ")]
    kinds = [pa.int32(), pa.int32(), pa.int32(), *[pa.binary()] * 6]
    return pa.table([pa.array([r[k] for r in rows], kinds[k]) for k in range(len(names))],
                    names=names)


def blocks(rows: DataFrame, n: int) -> DataFrame:
    """One row per block and vector length; ``tile_query`` holds the block's number."""
    dealt = rows.select(F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int").alias("block"),
                        "vec_id", "embedding")
    return dealt.groupBy("block").applyInArrow(as_block, BLOCK)


class Block:
    def __init__(self, table: pa.Table, row: int) -> None:
        dim = table["dim"][row].as_py()
        read = lambda name, kind: np.frombuffer(table[name][row].as_py(), kind)
        self.ids = read("ids", np.int64)
        wide = len(table["vectors"][row].as_py()) == 8 * dim * len(self.ids)
        self.vectors = read("vectors", np.float64 if wide else np.float32).reshape(-1, dim)
        self.rounded = read("rounded", np.int8).reshape(-1, dim).astype(np.float32)
        self.scale, self.rest, self.norm = (read(n, np.float64) for n in ("scale", "rest", "norm"))
        self.dim = dim


def rounded_products(q: Block, c: Block, rows: slice) -> np.ndarray:
    total = np.zeros((len(q.ids[rows]), len(c.ids)))
    for d in range(0, q.dim, EXACT):
        total += q.rounded[rows, d:d + EXACT] @ c.rounded[:, d:d + EXACT].T
    with np.errstate(over="ignore"):
        return total * q.scale[rows, None] * c.scale[None, :]


def exact_products(q: Block, c: Block, qi: np.ndarray, ci: np.ndarray) -> np.ndarray:
    """In double precision, summed in the order of the components."""
    left, right = q.vectors[qi].astype(np.float64), c.vectors[ci].astype(np.float64)
    total = np.zeros(len(qi))
    with np.errstate(over="ignore", invalid="ignore"):
        for d in range(q.dim):
            total += left[:, d] * right[:, d]
    return np.where(np.isnan(total), -np.inf, total)


def best_of_tile(q: Block, c: Block, k: int, step: int = 64
                 ) -> Iterator[tuple[int, list[tuple[float, int]]]]:
    """Each query's k best of the tile, as (-score, id)."""
    for start in range(0, len(q.ids), step):
        rows = slice(start, start + step)
        about = rounded_products(q, c, rows)
        with np.errstate(over="ignore", invalid="ignore"):
            bound = (q.rest[rows, None] * (c.norm + c.rest)[None, :]
                     + q.norm[rows, None] * c.rest[None, :])
            bound = bound * (1 + 1e-9) + 1e-12 * np.abs(about) + 1e-300
            low, high = about - bound, about + bound
        unsure = ~(np.isfinite(low) & np.isfinite(high))
        low[unsure], high[unsure] = -np.inf, np.inf
        own = q.ids[rows, None] == c.ids[None, :]
        low[own] = -np.inf
        if len(c.ids) > k:
            least = np.partition(low, len(c.ids) - k, axis=1)[:, len(c.ids) - k]
            survives = (high >= least[:, None]) & ~own
        else:
            survives = ~own
        for at in range(survives.shape[0]):
            ci = np.flatnonzero(survives[at])
            if not len(ci):
                continue
            score = exact_products(q, c, np.full(len(ci), start + at), ci)
            if len(ci) > 4 * k:  # equal scores: all of the k-th best stay for the ids to decide
                cut = np.partition(score, len(ci) - k)[len(ci) - k]
                ci, score = ci[score >= cut], score[score >= cut]
            yield int(q.ids[start + at]), heapq.nsmallest(k, zip((-score).tolist(),
                                                                 c.ids[ci].tolist()))


def tile(k: int):
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple[int, int, float]] = []
        for i in range(left.num_rows):
            for j in range(right.num_rows):
                q, c = Block(left, i), Block(right, j)
                if q.dim == c.dim:
                    for query_id, best in best_of_tile(q, c, k):
                        out += [(query_id, vec_id, -minus) for minus, vec_id in best]
        return pa.table([pa.array([r[n] for r in out], f.type) for n, f in enumerate(schema)],
                        schema=schema)

    return run


def merged(k: int):
    """Keeps a heap of the k best for each query of a partition."""
    schema = pa.schema([("query_id", pa.int64()), ("rank", pa.int32()), ("vec_id", pa.int64()),
                        ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps: dict[int, list[tuple[float, int]]] = {}
        for batch in batches:
            for query_id, vec_id, score in zip(*(batch.column(n).to_pylist() for n in range(3))):
                heap = heaps.setdefault(query_id, [])
                entry = (score, -vec_id)
                if len(heap) < k:
                    heapq.heappush(heap, entry)
                else:
                    heapq.heappushpop(heap, entry)
        rows = [(query_id, rank, -minus, score) for query_id, heap in heaps.items()
                for rank, (score, minus) in enumerate(sorted(heap, reverse=True), 1)]
        yield pa.record_batch([pa.array([r[n] for r in rows], f.type)
                               for n, f in enumerate(schema)], schema=schema)

    return run


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, query_rows: int = QUERY_ROWS,
            candidate_rows: int = CANDIDATE_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest of each query among ``vectors``."""
    rows = vectors.select("vec_id", "embedding").where("vec_id IS NOT NULL")
    asked = rows.where(is_query)
    n_query = max(1, math.ceil(asked.count() / query_rows))
    n_candidate = max(1, math.ceil(rows.count() / candidate_rows))
    queries = blocks(asked, n_query).withColumn("tile_candidate", F.explode(F.sequence(
        F.lit(0), F.lit(n_candidate - 1))))
    candidates = blocks(rows, n_candidate).withColumn(
        "tile_candidate", F.col("tile_query")).withColumn("tile_query", F.explode(F.sequence(
            F.lit(0), F.lit(n_query - 1))))
    key = ["tile_query", "tile_candidate"]
    found = queries.groupBy(*key).cogroup(candidates.groupBy(*key)).applyInArrow(
        tile(k), "query_id bigint, vec_id bigint, score double")
    return found.repartition("query_id").mapInArrow(
        merged(k), "query_id bigint, rank int, vec_id bigint, score double")
