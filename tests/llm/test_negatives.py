"""Hard negatives against plain Python, with blocks of any size; the curve and the bounds by themselves."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from filingloom.llm import negatives as module
from filingloom.llm.negatives import Anchors, hilbert, mine_negatives, write_blocks

SCHEMA = "vec_id long, embedding array<float>, label int"


def expected(rows, positives=5, negatives=5, low=80, high=100):
    whole = {(i, label, tuple(int(np.floor(256 * float(x))) for x in v)) for i, v, label in rows
             if i is not None and label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    out = []
    for a, label, v in whole:
        if a % 100:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w, strict=True)), i, other == label) for i, other, w in whole if i != a and len(w) == len(v))
        for score, p, _ in [s for s in scored if s[2]][:positives]:
            fit = [(-s, i) for s, i, same in scored if not same and low * -score <= 100 * -s <= high * -score]
            out += [(a, p, rank, i, -score, s) for rank, (s, i) in enumerate(fit[:negatives], 1)]
    return sorted(out)


def mined(spark, rows, **more):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    return sorted(tuple(r) for r in mine_negatives(frame, F.col("vec_id") % 100 == 0, **more).collect())


def table(rng, n, dims=6, centers=12):
    base = rng.normal(size=(centers, dims))
    return [(int(i), (base[c] + 0.3 * rng.normal(size=dims)).astype("float32").tolist(), int(c % 4)) for i, c in enumerate(rng.integers(0, centers, n))]


@pytest.mark.parametrize(("block", "task_blocks", "held", "anchor_bytes"), [(256, 64, 512, 4 << 20), (5, 3, 8, 300), (1, 40, 1, 4 << 20)])
def test_against_plain_python(spark, monkeypatch, block, task_blocks, held, anchor_bytes):
    monkeypatch.setattr(module, "BLOCK", block)
    monkeypatch.setattr(module, "TASK_BLOCKS", task_blocks)
    monkeypatch.setattr(module, "HELD", held)
    monkeypatch.setattr(module, "ANCHOR_BYTES", anchor_bytes)
    rows = table(np.random.default_rng(2), 420)
    rows += [(1000 + i, rows[0][1], i % 3) for i in range(60)]  # one vector many times: ties
    assert mined(spark, rows) == expected(rows)
    assert len(expected(rows)) > 60


def test_edges(spark):
    rows = table(np.random.default_rng(3), 120) + [(200, None, 1), (300, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1), (400, [float("nan")] * 6, 1), (500, [float("inf")] * 6, 2), (600, [1.0] * 6, None),
                                                    (None, [1.0] * 6, 1), (700, [2.0, 1.0], 1), (701, [2.0, 1.0], 1), (702, [2.0, 0.9], 2), (703, [-1.0, 0.0], 2), (800, [], 1), (801, [], 1), (802, [], 2),
                                                    (900, [0.5] * 2000, 1), (901, [0.5] * 2000, 1), (902, [0.4] * 2000, 0)]
    rows += rows[:3]  # repeated rows
    rows += [(100, [0.5] * 6, 3)]  # an id with two vectors
    assert mined(spark, rows) == expected(rows)
    frame = spark.createDataFrame(rows, SCHEMA)
    clash = frame.selectExpr("*", "1 AS v", "'x' AS anchor", "2 AS score", "3 AS length", "4 AS FILE", "true AS is_anchor")
    assert sorted(tuple(r) for r in mine_negatives(clash, F.col("vec_id") % 100 == 0).collect()) == expected(rows)
    assert mine_negatives(frame.limit(0), F.lit(True)).count() == 0
    assert mine_negatives(frame, F.lit(False)).count() == 0
    assert mined(spark, rows, positives=2, negatives=3, low=50, high=90) == expected(rows, 2, 3, 50, 90)


def test_very_large_components(spark):
    rows = [(0, [3e30, 1.0], 1), (1, [3e30, 1.0], 1), (2, [2.9e30, 1.0], 2), (100, [1e14, 1.0], 1), (101, [1e14, 3.0], 1), (102, [1e14, 2.0], 2)]
    got = mined(spark, rows)
    assert {(r[0], r[1]) for r in got} >= {(0, 1), (100, 1)}


def test_the_curve_steps_to_neighbours():
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        points = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
        place = hilbert(points, bits)
        assert sorted(place.tolist()) == list(range(len(points)))
        path = points[np.argsort(place)]
        assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_bounds_hold_and_leave_blocks_unread(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(module, "BLOCK", 32)
    rng = np.random.default_rng(4)
    rows = table(rng, 2_000, dims=3, centers=40)
    frame = spark.createDataFrame([(i, label, [int(np.floor(256 * x)) for x in v]) for i, v, label in rows], "vec_id long, label long, v array<long>").repartition(3)
    zones = write_blocks(frame, f"file://{tmp_path}/blocks").collect()
    assert sum(z.n for z in zones) == 2_000 and max(z.n for z in zones) == 32
    read, anchors = module._reader(), Anchors([0, 1], [0, 1], [0, 0], [[300, -200, 10], [-5, 400, 90]], 3)
    best, need = -np.inf, 0
    for z in zones:
        z = z.asDict() | {"low": np.array(z.low), "high": np.array(z.high)}
        ids, labels, vectors = read(z)
        scores = anchors.scores(np.array([0, 1]), vectors)
        low, high = anchors.bounds(z["low"], z["high"])
        assert (low[:, None] <= scores).all() and (scores <= high[:, None]).all()
        assert sorted(set(labels.tolist())) == z["labels"] and len(ids) == z["n"]
        best = max(best, scores[0].max())
    need = sum(anchors.bounds(np.array(z.low), np.array(z.high))[1][0] >= 0.9 * best for z in zones)
    assert 0 < need < len(zones) / 3
