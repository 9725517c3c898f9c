"""Exact top-k search against all products."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventtally.llm import topk
from eventtally.llm.topk import Summaries, integers, products, top_products, upper_bounds

rng = np.random.default_rng(6)


def brute(rows, k, is_query):
    out = []
    for q, x in {(i, tuple(v)) for i, v in rows if is_query(i)}:
        scored = sorted(((-sum(a * b for a, b in zip(x, y)), i) for i, y in rows if i != q and len(y) == len(x)))
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("blocks", [(4096, 1024, 4), (37, 5, 2)])
def test_equals_brute_force(spark, monkeypatch, blocks):
    for name, value in zip(("BLOCK_ROWS", "QUERY_ROWS", "BLOCKS_PER_TASK"), blocks):
        monkeypatch.setattr(topk, name, value)
    rows = [(k, rng.integers(-9, 9, 6).tolist()) for k in range(300)]
    rows += [(k, rows[3][1]) for k in range(300, 340)] + [(3, rows[3][1]), (500, [10**9] * 6), (520, [10**9, 1, 0, 0, 0, 7])]
    rows += [(540, [1, 2]), (541, [3, 4]), (560, [])]
    frame = spark.createDataFrame(rows + [(None, [1] * 6), (7, None)], "vec_id long, vector array<long>").selectExpr("*", "1 as copy", "2 as block")
    found = top_products(frame.repartition(4), F.col("vec_id") % 20 == 0, 7)
    got = sorted(tuple(r[c] for c in ("query_id", "rank", "vec_id", "score")) for r in found.collect())
    assert got == brute(rows, 7, lambda i: i % 20 == 0)


def test_bounds_hold():
    a, b = (Summaries(rng.integers(-40, 40, (50, 13))) for _ in range(2))
    exact = products(a, b)
    bounds = [upper_bounds(a, b, level) for level in range(len(topk.RESOLUTIONS))]
    for bound in bounds:
        assert (bound >= exact).all()
    assert bounds[2].mean() <= bounds[1].mean() <= bounds[0].mean()


def test_components(spark):
    nan, inf = float("nan"), float("inf")
    frame = spark.createDataFrame([([0.5, -0.01],), ([nan],), ([inf, 1.0],), ([None, 1.0],), (None,), ([],)], "e array<float>")
    assert [r[0] for r in frame.select(integers(F.col("e"))).collect()] == [[32, -1], None, None, None, None, []]


def test_empty_table(spark):
    frame = spark.createDataFrame([], "vec_id long, vector array<long>")
    assert top_products(frame, F.col("vec_id") % 20 == 0).count() == 0
