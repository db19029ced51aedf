import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratus.llm.graph import components
from stratus.llm.minhash_dedup import (Settings, drop_near_duplicates, least_matches, near_duplicates, shingle_set,
                                       signature, survivors, _permutations)

from .conftest import words

SETTINGS = Settings(shingle=3, percent=85)


def brute(pairs, k, percent):
    sets = {}
    for i, t in pairs:
        w = words(t)
        grams = {tuple(w[j:j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
        if i is not None:
            sets.setdefault(i, []).append(grams)
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1:]:
            if any(p and q and 100 * len(p & q) >= percent * len(p | q) for p in sets[a] for q in sets[b]):
                ra, rb = find(a), find(b)
                parent[max(ra, rb)] = min(ra, rb)
    return {i: find(i) for i in ids}


def edited(rng, base, edits):
    out = list(base)
    for _ in range(edits):
        out[rng.randrange(len(out))] = f"w{rng.randrange(10**6)}"
    return out


def corpus(seed=3):
    """Copies, chains of near copies, a hub with many near copies and unrelated texts."""
    rng = random.Random(seed)
    rows, i = [], 0
    for _ in range(12):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.randrange(60, 160))]
        chain = base
        for _ in range(rng.randrange(1, 6)):
            rows.append((i, " ".join(chain)))
            i += 1
            chain = edited(rng, chain, rng.randrange(0, 4))
    hub = [f"h{rng.randrange(400)}" for _ in range(120)]
    for _ in range(60):
        rows.append((i, "  ".join(edited(rng, hub, rng.randrange(1, 5)))))
        i += 1
    for _ in range(30):
        rows.append((i, " ".join(f"u{rng.randrange(5000)}" for _ in range(rng.randrange(1, 40)))))
        i += 1
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("settings", [SETTINGS, Settings(), Settings(shingle=3, percent=85, block=4, partners=3)])
def test_components_equal_brute_force(documents, settings):
    pairs = corpus()
    got = {r.doc_id: r for r in near_duplicates(documents(pairs), settings).collect()}
    assert {i: r.component_id for i, r in got.items()} == brute(pairs, settings.shingle, settings.percent)
    for i, r in got.items():
        assert r.kept == (i == r.component_id)
        assert r.n_shingles == len(shingle_set(dict(pairs)[i], settings.shingle))


def test_edge_rows_have_defined_results(documents):
    pairs = [(1, None), (2, ""), (3, " \n\t"), (4, "One two"), (5, "ONE\x0btwo"), (6, "one two three four"),
             (None, "one two"), (None, None), (7, "same text here ok"), (7, "same text here ok"), (8, "x" * 50_000),
             (9, "a b"), (10, "long " * 40_000)]
    got = near_duplicates(documents(pairs), SETTINGS).orderBy("doc_id").collect()
    assert len(got) == len(pairs)
    by = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got if r.doc_id is not None}
    assert by[1] == (0, 1, True) and by[2] == (0, 2, True) and by[3] == (0, 3, True)
    assert by[4] == (1, 4, True) and by[5] == (1, 4, False)
    assert by[6] == (2, 6, True) and by[7] == (2, 7, True) and by[8] == (1, 8, True) and by[9] == (1, 9, True)
    assert by[10] == (1, 10, True)
    assert [(r.component_id, r.kept) for r in got if r.doc_id is None] == [(None, True)] * 2


def test_empty_table(documents):
    assert near_duplicates(documents([]), SETTINGS).count() == 0
    assert drop_near_duplicates(documents([]), SETTINGS).count() == 0


def test_drop_keeps_one_row_of_a_group_and_every_column(documents):
    docs = documents([(1, "a b c d"), (2, "a b c d"), (2, "a b c d"), (3, "other words here now"), (None, "a b c d")])
    out = drop_near_duplicates(docs, SETTINGS)
    assert out.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text) for r in out.collect()) == [
        (0, "a b c d"), (1, "a b c d"), (3, "other words here now")]


def test_shared_passage_does_not_link(documents):
    rng = random.Random(5)
    shared = " ".join(f"p{rng.randrange(900)}" for _ in range(60))
    pairs = [(i, shared + " " + " ".join(f"q{rng.randrange(9000)}" for _ in range(60))) for i in range(80)]
    got = near_duplicates(documents(pairs), Settings(shingle=3, percent=85, bands=90, rows=2, batch=30)).collect()
    assert all(r.kept for r in got)


def test_signature_estimates_similarity():
    rng = np.random.default_rng(1)
    a = np.unique(rng.integers(0, 1 << 63, 4000, dtype=np.uint64))
    b = np.concatenate([a[:3400], np.unique(rng.integers(0, 1 << 63, 600, dtype=np.uint64))])
    seeds, odds = _permutations(180)
    same = (signature(a, seeds, odds) == signature(b, seeds, odds)).mean()
    assert abs(same - 3400 / 4600) < 0.12


def test_bayesian_bounds_grow_and_keep_true_pairs():
    least = least_matches(180, 30, 0.85, 1e-6)
    assert least == sorted(least) and 0 < least[0] < 30
    rng = np.random.default_rng(2)
    left = rng.integers(0, 1 << 16, (500, 180), dtype=np.uint16)
    right = np.where(rng.random((500, 180)) < 0.9, left, left + 1)
    assert len(survivors(left, right, 30, least)[0]) == 500
    assert len(survivors(left, left + 1, 30, least)[0]) == 0


def test_components_of_stars_chains_and_loops(spark):
    edges = [(0, i) for i in range(1, 50)] + [(i, i + 1) for i in range(100, 160)] + [(200, 200), (7, 300)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert all(got[i] == 0 for i in [*range(50), 300]) and all(got[i] == 100 for i in range(100, 161))
    assert 200 not in got
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_whole_table_query_equals_brute_force_on_a_small_table(spark, tmp_path):
    from stratus.llm.queries import queries
    pairs = corpus(9)
    spark.createDataFrame(pairs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    out = queries()["op4_minhash_near_dedup"](spark, str(tmp_path))
    assert out.columns[:4] == ["doc_id", "n_shingles", "component_id", "kept"]
    assert dict(out.select("doc_id", F.col("component_id")).collect()) == brute(pairs, 3, 85)
