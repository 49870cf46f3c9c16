import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import types as T

from wearlens.llm import ball_kmeans, queries

SCHEMA = T.StructType(
    [T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType()),
     T.StructField("v", T.StringType()), T.StructField("code", T.StringType()), T.StructField("a.b", T.LongType())]
)


def brute(rows):
    """The contract in plain Python integers."""
    kept = [(i, [math.floor(1024 * x) for x in v], c) for i, v, c in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    start = [v for i, v, _ in sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:256]]
    d = len(start[0]) // 4 if start else 0
    books = [[v[p * d : p * d + d] for v in start] for p in range(4)]
    cut = lambda v, p: v[p * d : p * d + d]
    near = lambda v, p: min((sum((a - b) ** 2 for a, b in zip(cut(v, p), e)), k) for k, e in enumerate(books[p]))
    for _ in range(4):
        held = [[[] for _ in start] for _ in range(4)]
        for _, v, _ in kept:
            for p in range(4):
                held[p][near(v, p)[1]].append(cut(v, p))
        books = [[[sum(x) // len(m) for x in zip(*m)] if m else e for e, m in zip(books[p], held[p])] for p in range(4)]
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out = []
    for i, v, c in kept:
        found = [near(v, p) for p in range(4)]
        out.append((i, "".join(f"{k:02x}" for _, k in found), sum(e for e, _ in found), c))
    total = {}
    for _, _, e, c in out:
        total[c] = total.get(c, 0) + e
    return sorted(map(str, [(i, code, e, total[c], sha) for i, code, e, c in out]))


def query(spark, tmp_path, rows):
    spark.createDataFrame([(*r, "x", "y", 1) for r in rows], SCHEMA).write.parquet(str(tmp_path / "embeddings.parquet"))
    return sorted(map(str, map(tuple, queries.op13_vector_codes(spark, str(tmp_path)).collect())))


def vectors(n, r, grid=None):
    draw = (lambda: r.gauss(0, 0.3)) if grid is None else (lambda: r.randrange(grid) / 8)
    return [[float(np.float32(draw())) for _ in range(12)] for _ in range(n)]


@pytest.mark.parametrize("grid", [None, 3])
def test_equals_brute_force(spark, tmp_path, grid):
    r = random.Random(grid or 1)
    rows = [(k * 3, v, r.choice([0, 1, 1, 1, None])) for k, v in enumerate(vectors(300, r, grid))]
    rows += [(5, None, 1), (7, [*rows[0][1][:-1], None], 1), (8, [*rows[0][1][:-1], math.nan], 2), (10, [*rows[0][1][:-1], math.inf], 2)]
    rows += [rows[3], rows[3], (9, rows[4][1], 0), (None, rows[5][1], 1), (None, rows[6][1], 7)] + [(2000 + k, rows[7][1], 3) for k in range(150)]
    r.shuffle(rows)
    assert query(spark, tmp_path, rows) == brute(rows)


def test_few_odd_and_no_vectors(spark, tmp_path):
    rows = [(k, v, 1) for k, v in enumerate(vectors(5, random.Random(2)))]
    assert query(spark, tmp_path / "few", rows) == brute(rows)
    assert query(spark, tmp_path / "none", [(1, None, 1)]) == query(spark, tmp_path / "empty", []) == []
    got = query(spark, tmp_path / "odd", [*rows, (9, [1.0] * 8, 1), (10, [], None)])
    assert [x for x in got if "None" not in x] == brute(rows) and len(got) == 7


def test_balls_compare_no_more_than_their_rings():
    r = np.random.default_rng(4)
    entries = r.integers(-50, 50, (64, 6)) * 40
    x = entries[r.integers(0, 64, 3000)] + r.integers(-60, 60, (3000, 6))
    balls = ball_kmeans.Balls(entries)
    all_pairs = ((x[:, None] - entries[None]) ** 2).sum(axis=2)
    for before in (ball_kmeans.guess(x, entries), np.zeros(3000, dtype=np.int64)):
        at, near = balls.assign(x, before)
        assert (at == all_pairs.argmin(axis=1)).all() and (near == all_pairs.min(axis=1)).all()


def test_components_too_large_are_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="too large"):
        query(spark, tmp_path, [(1, [1e12] * 12, 1)])
