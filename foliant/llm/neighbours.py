"""The k most similar vectors: randomly rotated one-bit codes, error bounds, exact reranking of what the bounds leave.

A unit vector x is rotated and kept as the signs of its coordinates, packed, with one correction scalar f = <sign(x), x>.
For a query q, <sign(x), q> / f estimates <x, q>; with a random rotation its error lies within eps * sqrt((1 - f^2) / f^2
/ (D - 1)) but for a probability that falls off as exp(-eps^2 / 2). A vector whose upper bound falls below the k-th best
similarity known of the query can't be among the k and is never compared exactly.

Codes are made once a row and stored beside it (encoded()); one scan of the stored rows answers GROUP_QUERIES queries.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliant.session import cut

#: Standard widths of the error bound; 3 leaves out about one true neighbour in a thousand.
EPS = 3.0
#: Queries worked off at once, and rows compared with them at once: matrices of 4 bytes each, some 4 MB.
BLOCK_QUERIES, BLOCK_ROWS = 1024, 1024
#: Queries sent to the workers for one scan of the rows: 16 MB at 64 dimensions of 4 bytes. More are worked off in groups.
GROUP_QUERIES = 65_536
#: Seed of the rotation, a fixed parameter: codes of old rows stay valid while the table grows.
SEED = 20240607


def rotation(d: int, seed: int = SEED) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((d, d)))
    return (q * np.sign(np.diag(r))).astype(np.float32)


def encode(x: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(packed signs, correction scalars) of unit rows: uint8 (n, d / 8) and float32 (n)."""
    y = x.astype(np.float32) @ turn
    return np.packbits(y > 0, axis=1, bitorder="little"), (np.abs(y).sum(axis=1) / np.sqrt(y.shape[1])).astype(np.float32)


def signs(codes: np.ndarray, d: int) -> np.ndarray:
    """Codes as rows of +1 and -1, for one matrix product with many queries."""
    return np.unpackbits(codes, axis=1, count=d, bitorder="little").astype(np.float32) * 2 - 1


class Queries:
    """Unit queries, as they are and rotated, with the best rows found so far."""

    def __init__(self, q: np.ndarray, turn: np.ndarray, ids: np.ndarray | None = None):
        self.exact, self.single, self.d = q, q.astype(np.float32), q.shape[1]
        self.turned, self.ids = self.single @ turn, ids
        self.floor = np.full(len(q), -2.0, dtype=np.float32)
        self.best_q, self.best_s, self.best_id = np.zeros(0, dtype=np.int64), np.zeros(0), np.zeros(0, dtype=object)

    def estimate(self, codes: np.ndarray, f: np.ndarray) -> np.ndarray:
        """Estimated inner products (queries, rows), from the packed bits and the correction scalars alone."""
        return self._estimate(signs(codes, self.d), f)

    def _estimate(self, bits: np.ndarray, f: np.ndarray) -> np.ndarray:
        return (self.turned @ bits.T) / (np.sqrt(np.float32(self.d)) * f)

    def bound(self, f: np.ndarray, eps: float) -> np.ndarray:
        """Width of the estimate's error, by row."""
        return (eps * np.sqrt(np.maximum(0, 1 - f**2) / f**2 / max(1, self.d - 1))).astype(np.float32)

    def take(self, ids: np.ndarray, x: np.ndarray, bits: np.ndarray, f: np.ndarray, k: int, eps: float) -> None:
        """Compare a block of rows: what the bounds leave exactly, and keep the k best of each query, ties by id."""
        estimate = self._estimate(bits, f)
        if len(ids) > k and (self.floor < -1).any():
            # The best by estimate, compared exactly, bound the k-th best of all from below.
            near = np.argpartition(estimate, len(ids) - k - 1, axis=1)[:, -k - 1 :]  # k + 1: the query may be among the rows
            rows, at = np.repeat(np.arange(len(self.exact)), k + 1), near.ravel()
            self.floor = np.maximum(self.floor, _exact(self.exact, unit(x), rows, at).reshape(near.shape).min(axis=1) - 1e-6).astype(np.float32)
        left = estimate >= self.floor[:, None] - self.bound(f, eps)
        qs, rows = np.flatnonzero(left.any(axis=1)), np.flatnonzero(left.any(axis=0))
        if not len(qs):
            return
        whole = unit(x[rows])
        # One product in single precision for all that is left; only what may be among the best goes on in double.
        close = self.single[qs] @ whole.astype(np.float32).T >= self.floor[qs, None] - 1e-5
        at_q, at_x = np.nonzero(close & left[np.ix_(qs, rows)])
        q, own = qs[at_q], ids[rows[at_x]]
        other = own != self.ids[q]
        q, own, at_x = q[other], own[other], at_x[other]
        self._merge(q, _exact(self.exact, whole, q, at_x), own, k)

    def _merge(self, q: np.ndarray, s: np.ndarray, ids: np.ndarray, k: int) -> None:
        q, s, ids = np.concatenate((self.best_q, q)), np.concatenate((self.best_s, s)), np.concatenate((self.best_id, ids))
        if not len(q):
            return
        order = np.lexsort((ids.astype(type(ids[0])), -s, q))
        q, s, ids = q[order], s[order], ids[order]
        first = np.searchsorted(q, q)
        keep = np.arange(len(q)) - first < k
        self.best_q, self.best_s, self.best_id = q[keep], s[keep], ids[keep]
        full = np.flatnonzero(np.bincount(self.best_q, minlength=len(self.floor)) == k)
        last = np.searchsorted(self.best_q, full, "right") - 1
        self.floor[full] = np.maximum(self.floor[full], self.best_s[last] - 1e-6)


def usable(vector: Column, d: int) -> Column:
    """Whether an array is d finite numbers, not all zero."""
    return (F.size(vector) == d) & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(vector, lambda x: x != 0)


def current_vectors(df: DataFrame, key: str, vector: str, d: int, model: tuple[str, str] | None = None, newest: str | None = None) -> DataFrame:
    """(key, vector, norm) of the usable rows, the newest of each key; equal times are decided by the vector itself.

    Null keys are left out. model is (column, value).
    """
    rows = df.where(F.col(f"`{key}`").isNotNull())
    if model:
        rows = rows.where(F.col(f"`{model[0]}`") == model[1])
    rows = rows.where(usable(F.col(f"`{vector}`"), d)).select(F.col(f"`{key}`").alias("id"), F.col(f"`{vector}`").cast("array<float>").alias("v"), (F.col(f"`{newest}`") if newest else F.lit(0)).alias("at"))
    # The rows go through the sort-free maximum of a struct; partial maxima are made before the shuffle.
    return rows.groupBy("id").agg(F.max(F.struct("at", "v")).alias("m")).select("id", F.col("m.v").alias("v"))


def unit(x: np.ndarray) -> np.ndarray:
    """Rows brought to length 1, in double precision."""
    y = x.astype(np.float64)
    y /= np.abs(y).max(axis=1, keepdims=True)  # first, so that squares neither overflow nor vanish
    return y / np.linalg.norm(y, axis=1, keepdims=True)


def _exact(a: np.ndarray, b: np.ndarray, rows: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Inner products of pairs of rows, in pieces that bound the memory."""
    out = np.empty(len(rows))
    for i in range(0, len(rows), 1 << 15):
        j = slice(i, i + (1 << 15))
        out[j] = np.einsum("ij,ij->i", a[rows[j]], b[at[j]])
    return out


def encoded(vectors: DataFrame, d: int) -> DataFrame:
    """(id, code, f, v) of rows (id, v): packed signs, correction scalar, and the vector as bytes. To be stored once; new rows are appended."""
    kind = vectors.schema["id"].dataType.simpleString()

    def codes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        turn = rotation(d)
        for batch in batches:
            if len(batch):
                x = np.stack(batch["v"].to_numpy()).astype("<f4")
                code, f = encode(unit(x), turn)
                yield pd.DataFrame({"id": batch["id"].to_numpy(), "code": [c.tobytes() for c in code], "f": f, "v": [r.tobytes() for r in x]})

    return vectors.select("id", "v").where(F.col("v").isNotNull()).mapInPandas(codes, f"id {kind}, code binary, f float, v binary")


def top_k(vectors: DataFrame, queries: DataFrame, k: int, d: int, eps: float = EPS) -> DataFrame:
    """top_k_stored() of rows (id, v) as current_vectors gives them, encoded and stored here."""
    return top_k_stored(cut(encoded(vectors, d)), encoded(queries, d), k, d, eps)


def top_k_stored(rows: DataFrame, queries: DataFrame, k: int, d: int, eps: float = EPS) -> DataFrame:
    """(query_id, id, rank, similarity): the k rows of highest cosine similarity for each query but itself, ties by id.

    Both frames are as encoded() gives them. Queries are sent in groups of GROUP_QUERIES, and one scan of the rows, of
    which none is shuffled, answers a group. Each task keeps k rows a query, so the shuffle after it carries tasks x
    queries x k small rows. The k-th best found so far in a task bounds what later rows must beat. Without queries or
    rows the result is empty; with fewer than k other rows it holds them all.
    """
    sc = rows.sparkSession.sparkContext
    kind = rows.schema["id"].dataType.simpleString()
    asked = queries.select("id", "v")
    n_groups = max(1, -(-asked.count() // GROUP_QUERIES))
    out = None
    for group in range(n_groups):
        own = asked if n_groups == 1 else asked.where(F.pmod(F.xxhash64("id"), F.lit(n_groups)) == group)
        sent = sc.broadcast([(r.id, bytes(r.v)) for r in own.toLocalIterator()])

        def scan(batches: Iterator[pd.DataFrame], sent=sent) -> Iterator[pd.DataFrame]:
            turn, blocks = rotation(d), []
            for at in range(0, len(sent.value), BLOCK_QUERIES):
                ids, v = zip(*sent.value[at : at + BLOCK_QUERIES], strict=True)
                blocks.append(Queries(unit(np.frombuffer(b"".join(v), "<f4").reshape(-1, d)), turn, np.array(ids, dtype=object)))
            for batch in batches:
                ids = batch["id"].to_numpy(dtype=object)
                for at in range(0, len(batch), BLOCK_ROWS):
                    part = batch.iloc[at : at + BLOCK_ROWS]
                    bits = signs(np.frombuffer(b"".join(part["code"]), np.uint8).reshape(len(part), -1), d)
                    x, f = np.frombuffer(b"".join(part["v"]), "<f4").reshape(-1, d), part["f"].to_numpy(np.float32)
                    for block in blocks:
                        block.take(ids[at : at + BLOCK_ROWS], x, bits, f, k, eps)
            for block in blocks:
                yield pd.DataFrame({"query_id": block.ids[block.best_q], "id": block.best_id, "similarity": block.best_s})

        found = rows.select("id", "code", "f", "v").mapInPandas(scan, f"query_id {kind}, id {kind}, similarity double")
        out = found if out is None else out.unionByName(found)
    order = Window.partitionBy("query_id").orderBy(F.desc("similarity"), "id")
    return out.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "id", "rank", "similarity")
