"""Vector codes by product quantization; codebooks by ball k-means in exact integers.

Vectors become integers and are cut into equal parts, each part position with a codebook of its own.
A round assigns every part to its nearest entry and moves each entry to its parts' mean, rounded down.
Assigning starts from the entry that a part had before. The parts of an entry are a ball:

* only entries whose distance from the ball's centre is at most twice its radius are neighbours, for
  a farther entry is farther from every part of the ball than the centre;
* a part nearer to its centre than half the way to the nearest neighbour is in the stable core and
  keeps its entry without another distance;
* neighbours sorted by distance cut the rest of the ball into annular rings; a part is compared
  with exactly those neighbours at most twice as far from its centre as the part is.

All of it holds with ties, for entries at exactly the bound are compared. A ball is taken per Arrow
batch, so its radius is at most that of the whole ball, and no step must wait for the radius of all.
The first round has no entry from before and starts from a guess by a floating-point product, which
the same steps make exact.

Codebooks are ``PARTS`` * ``ENTRIES`` entries whatever the vectors: they travel with the tasks. Their
new sums are added up per task, then per number, so that one entry may hold any share of all parts.
Between rounds vectors and codes are a table in the shared folder.

Defined results. Rows whose vector is null or has null or non-finite components go. A vector whose
length differs from that of the first (of the least id) has a null code and error. Null ids come last
among those that start the codebooks, equal ids by their vectors. With fewer vectors than ``ENTRIES``
the codebooks have as many entries. Rows that repeat are counted each. No vectors: no rows. A length
that cannot be cut into equal parts is an error, as are components too large for 64-bit distances
(2**28 after scaling, with 16 a part). Further columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from wearlens.llm.store import forget, keep, map_arrow, own, ship

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
PAIRS = 1 << 19  # part and entry pairs compared together


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    gap = a - b
    return np.einsum("ij,ij->i", gap, gap)


def guess(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """About the nearest entry of each row."""
    c = entries.astype(np.float64)
    half = (c * c).sum(axis=1) / 2
    some = range(0, len(x), 4096)
    return np.concatenate([np.argmin(half - x[a : a + 4096].astype(np.float64) @ c.T, axis=1) for a in some]) if len(x) else np.zeros(0, dtype=np.int64)


class Balls:
    """A codebook's entries, with their neighbours by distance."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        between = np.stack([squared(entries, np.broadcast_to(e, entries.shape)) for e in entries])
        np.fill_diagonal(between, np.iinfo(np.int64).max)  # an entry is no neighbour of itself
        self.order = np.argsort(between, axis=1, kind="stable")
        self.between = np.take_along_axis(between, self.order, axis=1)

    def assign(self, x: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest entry of each row and its squared distance, given the entry from before."""
        at, near = at.copy(), squared(x, self.entries[at])
        radius = np.zeros(len(self.entries), dtype=np.int64)
        np.maximum.at(radius, at, near)
        neighbours = (self.between <= 4 * radius[:, None]).sum(axis=1)
        loose = np.flatnonzero(4 * near >= self.between[at, 0])  # outside the stable cores
        by_ball = loose[np.argsort(at[loose], kind="stable")]
        ball, first = np.unique(at[by_ball], return_index=True)
        ring = np.empty(len(by_ball), dtype=np.int64)  # neighbours to compare with
        for b, a, z in zip(ball.tolist(), first.tolist(), [*first[1:].tolist(), len(by_ball)]):
            ring[a:z] = np.searchsorted(self.between[b, : neighbours[b]], 4 * near[by_ball[a:z]], side="right")
        upto = np.cumsum(ring)
        a = 0
        while a < len(by_ball):
            z = max(a + 1, int(np.searchsorted(upto, (upto[a - 1] if a else 0) + PAIRS, side="right")))
            rows, size = by_ball[a:z], ring[a:z]
            begin = np.cumsum(size) - size
            row = np.repeat(rows, size)
            other = self.order[at[row], np.arange(len(row)) - np.repeat(begin, size)]
            far = squared(x[row], self.entries[other])
            best = np.minimum.reduceat(far, begin)
            lowest = np.minimum.reduceat(np.where(far == np.repeat(best, size), other, len(self.entries)), begin)
            moved = (best < near[rows]) | ((best == near[rows]) & (lowest < at[rows]))
            at[rows[moved]], near[rows[moved]] = lowest[moved], best[moved]
            a = z
        return at, near


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), width)


def finite(vector: str) -> Column:
    return F.forall(vector, lambda x: F.coalesce(x.cast("double").isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")), F.lit(False)))


def integers(vectors: DataFrame, vector: str) -> DataFrame:
    """Rows with a whole finite vector, as integers ``v``."""
    kept = vectors.filter(F.col(f"`{vector}`").isNotNull() & finite(f"`{vector}`"))
    return kept.withColumn("v", F.transform(f"`{vector}`", lambda x: F.floor(x.cast("double") * SCALE))).drop(vector)


def assigned(rows: DataFrame, books: np.ndarray) -> DataFrame:
    """``rows`` with the nearest entry of every part in ``code``, and their squared distances' sum ``error``."""
    width = books.shape[0] * books.shape[2]

    def batch(b: pa.RecordBatch):
        names = b.schema.names
        x = _matrix(b.column(names.index("v")), width).reshape(-1, books.shape[0], books.shape[2])
        if x.size and 4.0 * max(float(np.abs(x).max()), float(np.abs(books).max())) ** 2 * books.shape[2] * 4 >= 2.0**63:
            raise OverflowError("vector components are too large for exact distances in 64 bits")
        before = b.column(names.index("code"))
        code, error = np.empty(x.shape[:2], dtype=np.int64), np.zeros(len(x), dtype=np.int64)
        old = None if before.null_count else _matrix(before, books.shape[0])
        for p in range(books.shape[0]):
            part = np.ascontiguousarray(x[:, p])
            code[:, p], near = balls[p].assign(part, guess(part, books[p]) if old is None else old[:, p])
            error += near
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * books.shape[0]), pa.array(code.ravel(), pa.int32()))
        given = {"code": lists, "error": pa.array(error)}
        yield pa.RecordBatch.from_arrays([given.get(n, c) for n, c in zip(names, b.columns)], names)

    balls = [Balls(b) for b in books]
    return map_arrow(rows, rows.columns, rows.schema, batch)


def moved(rows: DataFrame, books: np.ndarray) -> np.ndarray:
    """Codebooks with every entry at its parts' mean, rounded down; entries without parts stay."""
    parts, entries, size = books.shape

    def run(batches):
        sums = np.zeros((parts, entries, size + 1), dtype=np.int64)
        for b in batches:
            x, code = _matrix(b.column(0), parts * size).reshape(-1, parts, size), _matrix(b.column(1), parts)
            for p in range(parts):
                order = np.argsort(code[:, p], kind="stable")
                used, first = np.unique(code[order, p], return_index=True)
                if len(used):
                    sums[p, used, :size] += np.add.reduceat(x[order, p], first, axis=0)
                    sums[p, used, size] += np.diff(np.append(first, len(order)))
        flat = sums.ravel()
        slot = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(slot, pa.int32()), pa.array(flat[slot])], ["slot", "s"])

    ship()
    total = rows.select("v", "code").mapInArrow(run, "slot int, s long").groupBy("slot").agg(F.sum("s").alias("s")).toArrow()
    sums = np.zeros(parts * entries * (size + 1), dtype=np.int64)  # one number per component: bounded by the codebooks
    sums[total["slot"].to_numpy()] = total["s"].to_numpy()
    sums = sums.reshape(parts, entries, size + 1)
    count = sums[:, :, size:]
    return np.where(count > 0, sums[:, :, :size] // np.maximum(count, 1), books)


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def encode(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """Rows (id, label, code, error) of every whole vector, and the codebooks they refer to."""
    schema = vectors.schema
    named = own(vectors, *dict.fromkeys((vec_id, vector, label)))
    rows = integers(named.toDF(*["id", "vector", "label"][: len(named.columns)]), "vector")
    rows = keep(rows.select("id", "label", "v", F.lit(None).cast("array<int>").alias("code"), F.lit(None).cast("long").alias("error")), "vectors")
    by_id = rows.orderBy(F.col("id").asc_nulls_last(), "v").select("v")
    first = by_id.first()
    width = len(first.v) if first else 0
    if width % parts:
        raise ValueError(f"vectors of {width} components cannot be cut into {parts} equal parts")
    fits = F.size("v") == width
    start = by_id.filter(fits).limit(entries).toArrow()["v"].to_pylist() if width else []
    books = np.array(start, dtype=np.int64).reshape(len(start), parts, width // parts).transpose(1, 0, 2)
    done = rows.filter(fits)
    if books.size:
        for k in range(rounds + 1):
            after = keep(assigned(done, books), "codes")
            if k:
                forget(done)
            done = after
            if k < rounds:
                books = moved(done, books)
    else:
        done = rows  # no vectors, or all of no components
    odd = rows.filter(~fits) if books.size else rows.limit(0)
    out = done.unionByName(odd).select(F.col("id").alias(vec_id), F.col("label").alias(label), "code", "error")
    return out.select(F.col(f"`{vec_id}`").cast(schema[vec_id].dataType), F.col(f"`{label}`"), "code", "error"), books
