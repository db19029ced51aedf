import math

import duckdb
import numpy as np
import pandas as pd
import pytest
from stratus.llm import hard_negatives as H
from stratus.llm.queries import queries

SCHEMA = "vec_id long, embedding array<float>, label int"


def expected(rows):
    """Plain Python over (vec_id, embedding, label)."""
    kept = []
    for i, v, label in rows:
        if i is None or label is None or not v or any(x is None or not math.isfinite(x) for x in v):
            continue
        kept.append((i, (label + 1) % 10 if i % 7 == 0 else label, [math.floor(256 * float(np.float32(x))) for x in v]))
    out = []
    for i, label, v in kept:
        if i % 100:
            continue
        scored = [(-sum(p * q for p, q in zip(v, w, strict=True)), j, other) for j, other, w in kept if len(w) == len(v)]
        for ps, j, _ in sorted(x for x in scored if x[2] == label and x[1] != i)[:5]:
            ps = -ps
            fit = sorted(x for x in scored if x[2] != label and 30 * ps <= -100 * x[0] <= 90 * ps)[:10]
            out += [(i, j, k, n, ps, -ns) for k, (ns, n, _) in enumerate(fit, 1)]
    return sorted(out)


def vectors(seed, n, dim, spread=.3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(4, dim))
    points = centres[rng.integers(0, 4, n)] + spread * rng.normal(size=(n, dim))
    return [(int(i), [float(np.float32(x)) for x in p], int(k)) for i, p, k in
            zip(rng.permutation(n * 3)[:n] * 5, points, rng.integers(0, 4, n), strict=True)]


def run(spark, rows, settings=H.Settings(), schema=SCHEMA):
    return sorted(map(tuple, H.mine_embeddings(spark.createDataFrame(rows, schema), settings).collect()))


@pytest.mark.parametrize("settings", [
    H.Settings(), H.Settings(block_bytes=8 * 12 * 25, blocks=2, tile=6, part=3), H.Settings(segments=(2, 6), block_bytes=8 * 12 * 7)])
def test_equals_a_plain_scan(spark, settings):
    rows = vectors(1, 700, 12)
    assert run(spark, rows, settings) == expected(rows)


def test_odd_rows(spark):
    rows = vectors(2, 300, 5, .05)
    rows += rows[:40]  # repeated rows
    rows += [(None, rows[0][1], 1), (100, None, 1), (200, [], 2), (300, [1.0, None, 2.0, 1.0, 1.0], 1), (400, [float("nan")] * 5, 1),
             (500, [float("inf")] * 5, 1), (600, [0.0] * 5, 2), (700, [1.0, 2.0], 1), (701, [1.0, 2.0], 1), (702, [.5, 1.0], 2), (800, rows[0][1], None)]
    assert run(spark, rows, H.Settings(block_bytes=400, blocks=1)) == expected(rows)


def test_huge_components_are_scored_in_whole_numbers(spark):
    rows = [(100 * (k % 3) + k, [float(2 ** 22 + k), float(2 ** 21 - k), 1.0], k % 2) for k in range(12)] + [(0, [2.0 ** 22, 3.0, 1.0], 0)]
    assert run(spark, rows) == expected(rows)
    assert run(spark, [(0, [1e30, 1.0], 0), (1, [1e30, 1.0], 0), (2, [1.0, 1.0], 1)], schema="vec_id long, embedding array<double>, label int") == []


def test_empty_and_clashing_columns(spark):
    assert run(spark, []) == []
    rows = vectors(4, 200, 4)
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS dim", "2 AS tile", "3 AS vector", "4 AS block", "5 AS rank", "6 AS score")
    assert sorted(map(tuple, H.mine_embeddings(df).collect())) == expected(rows)


def test_bounds_hold_at_every_level():
    rng, s = np.random.default_rng(7), H.Settings(segments=(1, 2, 4, 8))
    a, b = (np.floor(256 * rng.normal(size=(n, 21))) for n in (30, 40))
    sketches = [H.Sketch(*H.summaries(x, 8), 21, s) for x in (a, b)]
    spread = []
    for level in range(4):
        low, high = sketches[0].bounds(sketches[1], level, slice(0, 30), np.arange(40))
        assert (low <= a @ b.T).all() and (a @ b.T <= high).all()
        spread.append((high - low).mean())
    assert spread == sorted(spread, reverse=True)


def test_summaries_spare_exact_scores(spark, monkeypatch):
    """Clustered vectors: the filter leaves few rows to score."""
    seen = []
    true = H.exact_scores
    monkeypatch.setattr(H, "exact_scores", lambda a, b: seen.append(len(a) * len(b)) or true(a, b))
    rng = np.random.default_rng(3)
    values = np.repeat(np.eye(16) * 256, 50, axis=0) + np.floor(4 * rng.normal(size=(800, 16)))
    s = H.Settings(segments=(4, 16))
    rows = H.Rows(np.arange(800), np.zeros(800, np.int64), values, H.Sketch(*H.summaries(values, 16), 16, s))
    tile = H.Rows(rows.ids[:5], rows.labels[:5], values[:5], H.Sketch(*H.summaries(values[:5], 16), 16, s))
    best = H.Best(np.full(5, 60000), np.full(5, 1 << 40), 5)
    H.scan(tile, rows, best, 1, True, s)
    assert sum(seen) <= 5 * 60


def test_query_equals_duckdb(spark, tmp_path):
    rows = [(i, v, k) for i, v, k in vectors(9, 900, 8)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = queries()["op13_hard_negatives"](spark, str(tmp_path))
    con = duckdb.connect()
    con.register("embeddings", pd.DataFrame(rows, columns=["vec_id", "embedding", "label"]).astype({"label": "int32"}))
    want = con.execute(H.ORACLE)
    assert [d[0] for d in want.description] == got.columns
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())
