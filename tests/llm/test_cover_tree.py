import math
import time

import numpy as np
import pytest
from stratus.llm import cover_tree as C

SMALL = C.Settings(block_bytes=4 * 6 * 20, fan=2, partners=2, leaf=2, seeds=16, held=5)


def unit(v):
    n = math.sqrt(sum(x * x for x in v))
    return [x / n for x in v]


def expected(rows, bound=0.95):
    """Every pair by itself: vec_id -> rows (n_links, component, kept), as a sorted list."""
    n, sound = len(rows), []
    for _, v in rows:
        good = bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)
        sound.append(unit([float(x) for x in v]) if good else None)
    links = [[j for j in range(n) if j != i and sound[i] and sound[j] and len(sound[i]) == len(sound[j])
              and sum(p * q for p, q in zip(sound[i], sound[j], strict=True)) >= bound] for i in range(n)]
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        least = min(ids) if ids else None
        out.append((rows[i][0], len(links[i]), least, least is not None and least == rows[i][0]))
    return sorted(out, key=str)


def run(spark, rows, s=C.Settings(), kind="float"):
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")
    return sorted(map(tuple, C.near_duplicates(df, s).collect()), key=str)


def clustered(seed, n, dim, spread):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(max(1, n // 12), dim))
    points = centres[rng.integers(0, len(centres), n)] + spread * rng.normal(size=(n, dim))
    points[: n // 5] = centres[0] + .5 * spread * rng.normal(size=(n // 5, dim))  # one big group
    ids = rng.permutation(n)
    return [(int(i), [float(np.float32(x)) for x in p]) for i, p in zip(ids, points, strict=True)]


@pytest.mark.parametrize("spread", [.1, .25, .4])
@pytest.mark.parametrize("s", [C.Settings(), SMALL])
def test_links_and_components_equal_all_pairs(spark, spread, s):
    rows = clustered(int(spread * 100), 300, 6, spread)
    assert run(spark, rows, s) == expected(rows)


def test_odd_rows(spark):
    rows = clustered(4, 60, 4, .2) + [
        (100, None), (101, []), (102, [1.0, None, 0.0, 0.0]), (103, [float("nan")] * 4), (104, [float("inf"), 1.0, 0.0, 0.0]),
        (105, [0.0] * 4), (106, [-0.0, 0.0, -0.0, 0.0]), (107, [1.0, 0.0]), (108, [2.0, -0.0]), (109, [3.0]), (110, [-3.0]),
        (111, [1e-30, 0.0, 1e-30, 0.0]), (112, [1e30, 0.0, 1e30, 0.0]), (None, [1e20, 0.0, 1e20, 0.0]), (None, [9.0, 9.0, 9.0, 9.0, 9.0])]
    rows += rows[:10] + [(3, [5.0, 1.0, 1.0, 1.0]), (3, [5.0, 1.0, 1.0, 1.0])]
    assert run(spark, rows, SMALL) == expected(rows)


def test_empty_table_and_clashing_columns(spark):
    assert run(spark, []) == []
    assert run(spark, [(5, None), (None, [0.0])]) == expected([(5, None), (None, [0.0])])
    rows = clustered(6, 50, 3, .3)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr(
        "*", "1 AS h1", "2 AS class", "3 AS n", "4 AS component", "5 AS block", "6 AS label")
    assert sorted(map(tuple, C.near_duplicates(df).collect()), key=str) == expected(rows)


def test_doubles_beyond_single_precision(spark):
    rows = [(1, [1e200, 1e200]), (2, [1e-200, 1e-200]), (3, [1e300, -1e300]), (4, [1.0, 1.0 + 1e-12])]
    assert run(spark, rows, kind="double") == expected([(1, [1.0, 1.0]), (2, [1.0, 1.0]), (3, [1.0, -1.0]), (4, [1.0, 1.0])])


def test_chain_of_links_is_one_component(spark):
    rows = [(200 - k, [math.cos(k * .3), math.sin(k * .3) * .999, 0.01 * k]) for k in range(40)]
    assert run(spark, rows, C.Settings(block_bytes=4 * 3 * 4, fan=2)) == expected(rows)


def test_nodes_cover_their_vectors_and_levels_halve():
    rng = np.random.default_rng(2)
    points = C.unit_rows(rng.normal(size=(400, 5)))
    t = C.build(points, 4)
    assert (np.sort(t.order) == np.arange(400)).all() and (t.points == points[t.order]).all()
    for k in range(len(t.start)):
        inside = t.points[t.start[k]:t.stop[k]]
        assert C.distances(inside[:1], inside).max() <= t.radius[k] + 1e-7
        parts = C._children(t, k)
        if t.n_child[k]:
            assert t.start[parts[0]] == t.start[k] and t.stop[parts[-1]] == t.stop[k]
            assert (t.stop[parts[:-1]] == t.start[parts[1:]]).all()


def test_pairs_of_far_blocks_are_pruned(spark):
    """Two tight bundles of vectors: no pair of blocks across them is met."""
    rng = np.random.default_rng(5)
    points = np.concatenate([np.eye(4)[k] + .02 * rng.normal(size=(200, 4)) for k in (0, 1)])
    s = C.Settings(block_bytes=4 * 4 * 25, fan=3)
    df = spark.createDataFrame([(k, p.tolist()) for k, p in enumerate(points)], "vec_id long, embedding array<float>")
    seen = {}
    true = C.block_pairs

    def noted(nodes, s):
        found = true(nodes, s)
        seen["blocks"], seen["pairs"] = nodes.count(), found.count()
        return found
    try:
        C.block_pairs = noted
        got = C.near_duplicates(df, s).collect()
    finally:
        C.block_pairs = true
    n = seen["blocks"]
    assert n >= 16 and seen["pairs"] <= n * (n - 1) // 2 - (n // 2 - 1) ** 2
    assert {r.component_id for r in got} == {0, 200}


def test_a_large_dense_group_takes_little_time():
    """Links of vectors that are all near each other are counted by nodes, not pair by pair."""
    rng = np.random.default_rng(1)
    points = C.unit_rows(np.ones((6000, 8)) + .01 * rng.normal(size=(6000, 8)))
    begun = time.time()
    counts, labels = C.self_links(C.build(points, 8), np.ones(6000, np.int64), C.Settings())
    assert (counts == 5999).all() and (labels == 0).all() and time.time() - begun < 20
