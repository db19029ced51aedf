import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from stratus.llm import lm_scoring as lm

from .conftest import words


def corpus(n=400, seed=3):
    """Two kinds of text with words of their own, so that context tells more than frequency."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        kind = rng.choice(["xa", "yb"])
        out.append((i, " ".join(f"{kind}{int(rng.paretovariate(0.8)) % 400}{kind}" for _ in range(rng.randrange(5, 120)))))
    return out


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 5 == 1


def base_scores(pairs):
    tokens = {k: [*words(t), "\n"] for k, (_, t) in enumerate(pairs)}
    counts = Counter(x for k, (i, _) in enumerate(pairs) if not held(i) for x in tokens[k])
    total, distinct = sum(counts.values()), len(counts)
    spread = total + 0.5 * (distinct + 1)
    return total, {k: (len(t), sum(x in counts for x in t), sum(math.log10((counts[x] + 0.5) / spread) for x in t))
                   for k, t in tokens.items()}


def test_counts_and_base_score_equal_brute_force_and_model_is_better(documents):
    pairs = corpus()
    for settings in (lm.Settings(rounds=2, batch=128), lm.Settings(known=4, words=0.2)):
        got = {r.doc_id: r for r in lm.score_texts(documents(pairs), settings).collect()}
        total, want = base_scores(pairs)
        for k, (i, _) in enumerate(pairs):
            n, known, base = want[k]
            r = got[i]
            assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(i), n, known, total)
            assert abs(r.base_score - base) < 1e-6 * abs(base)
            assert r.score < 0
        if settings.rounds == 2:
            out = [r for r in got.values() if r.held_out]
            assert sum(r.score for r in out) > sum(r.base_score for r in out)


def plain_score(text, model, v, counts):
    """The model's score of one text, token by token and class by class."""
    codes = lm.token_codes(text)
    total = 0.0
    for k, code in enumerate(codes):
        q = np.zeros(model.places.shape[1])
        for i, place in enumerate(model.places):
            before = v.units if k - 1 - i < 0 else int(v.unit_ids(codes[k - 1 - i:k - i])[0])
            q += model.context[before].astype(float) * place
        unit = int(v.unit_ids(codes[k:k + 1])[0])
        own = int(np.searchsorted(v.starts, unit, side="right")) - 1
        for table, chosen in ((model.outer, own), (model.inner[v.starts[own]:v.starts[own + 1]], unit - v.starts[own])):
            powers = [math.exp(row[:-1].astype(float) @ q + float(row[-1])) for row in table]
            total += math.log10(powers[chosen] / sum(powers))
        if v.share_log[unit]:  # a cell of rarer tokens
            c = counts.get(int(code.view(np.int64)))
            total += v.unseen_log[unit] if c is None else math.log10(c) + v.share_log[unit]
    return total


def test_scores_equal_a_plain_scorer(documents, monkeypatch):
    pairs = [*corpus(60), (500, None), (501, ""), (502, "never seen, never!"), (503, "A a A a. B"), (None, "xa1xa xa2xa")]
    for settings in (lm.Settings(batch=64), lm.Settings(batch=64, known=0, block=7), lm.Settings(rounds=2, known=30, words=0.3)):
        seen = {}
        true = lm.partial_scores
        monkeypatch.setattr(lm, "partial_scores", lambda rows, m, v, s: seen.update(m=m, v=v) or true(rows, m, v, s))
        docs = documents(pairs)
        got = {r.doc_id: r.score for r in lm.score_texts(docs, settings).collect()}
        monkeypatch.undo()
        counts = Counter(int(c) for i, t in pairs if not held(i) for c in lm.token_codes(t).view(np.int64))
        for i, t in pairs:
            assert abs(got[i] - plain_score(t, seen["m"], seen["v"], counts)) < 1e-3 * max(1, abs(got[i]))


def test_probabilities_add_up_to_one(documents):
    rows = lm.coded(documents(corpus(120)))
    s = lm.Settings(batch=64)
    counts = lm.cut(lm.token_counts(rows))
    v = lm.vocabulary(counts, s)
    model = lm.train_round(rows, lm.fresh(v, s), v, s, 0)
    rng = np.random.default_rng(0)
    for before in rng.integers(0, v.units, (5, s.context)):
        texts = np.concatenate([np.append(before, u) for u in range(v.units)])  # the same context, each unit after it
        logs = lm.unit_logs(model, v, texts, np.full(v.units, s.context + 1), 64)
        assert abs((10 ** logs[s.context::s.context + 1]).sum() - 1) < 1e-5
    # in a cell: known tokens by their counts, and one share for unseen ones; a frequent token is a unit by itself
    table = counts.toPandas()
    units = v.unit_ids(table.h.to_numpy().view(np.uint64))
    for u in range(v.units):
        inside = table[units == u]
        if v.share_log[u] and len(inside):
            assert abs((10 ** v.share_log[u] * inside.c).sum() + 10 ** v.unseen_log[u] - 1) < 1e-9
        elif not v.share_log[u]:
            assert len(inside) == 1


def test_every_place_is_a_target_and_the_model_grows(documents, monkeypatch):
    sizes = []
    for n in (60, 480):
        rows = lm.coded(documents(corpus(n)).coalesce(1))
        counts = lm.cut(lm.token_counts(rows))
        v, s = lm.vocabulary(counts, lm.Settings()), lm.Settings(batch=100)
        assert len(v.own) == min(math.ceil(v.total ** s.words), v.distinct)
        sizes.append((len(v.own), v.units))
        codes = np.concatenate([np.frombuffer(r.codes, np.uint64) for r in rows.collect()])
        met = Counter()
        trainer = lm.Trainer(lm.fresh(v, s), v, s, (0, 0))
        monkeypatch.setattr(trainer, "step", lambda strips: met.update(strips[:, s.context:].ravel().tolist()))
        monkeypatch.setattr(lm, "Trainer", lambda *a: trainer)
        lm._train(iter([pa.RecordBatch.from_pylist([{"codes": r.codes} for r in rows.collect()])]), None, v, s, (0, 0))
        monkeypatch.undo()
        met.pop(v.units)  # places before and after texts
        assert met == Counter(v.unit_ids(codes).tolist())
    assert sizes[0][0] < sizes[1][0] and sizes[0][1] < sizes[1][1]


def test_noise_differs_by_partition_and_a_rerun_does_not(documents):
    rows = lm.coded(documents(corpus(80)).repartition(3, "doc_id"))
    s = lm.Settings(batch=64)
    v = lm.vocabulary(lm.cut(lm.token_counts(rows)), s)
    one, two = (lm.train_round(rows, lm.fresh(v, s), v, s, 0) for _ in range(2))
    assert all((a == b).all() for a, b in zip(one.tables(), two.tables(), strict=True))
    a, b = (lm.Trainer(lm.fresh(v, s), v, s, (0, k)).rng.random(4).tolist() for k in (0, 1))
    assert a != b


def test_contexts_of_texts():
    ids = np.array([5, 6, 7, 8, 9])
    sequence, places = lm.padded(ids, np.array([3, 2]), 2, 99)
    assert sequence.tolist() == [99, 99, 5, 6, 7, 99, 99, 8, 9] and sequence[places].tolist() == ids.tolist()


def test_codes_tell_endings_and_beginnings():
    def low(word):
        code = int(lm.token_codes(word)[0])
        return (code >> lm._BEGIN_BITS) & ((1 << lm._END_BITS) - 1), code & ((1 << lm._BEGIN_BITS) - 1)

    assert low("walking") == low("walking,") == low('walking!")') and low("walking")[0] == low("ring")[0] != low("walked")[0]
    assert low("walk")[1] == low("walking")[1] and low("a") != low("b") and low("...")
    text = "Aa bb, \t.. c\n" * 50 + "é。" + "x" * 3000
    codes = lm.token_codes(text)
    each = [lm.token_codes(w)[0] for w in words(text)]
    assert codes[:-1].tolist() == each and codes[-1] == lm.token_codes("")[0] and len(set(codes.tolist())) == 6


def test_a_step_follows_the_gradient(documents):
    """Small steps raise the contrastive objective, so targets gain on noise."""
    rows = lm.coded(documents(corpus(40)))
    s = lm.Settings(batch=256, rate=0.05)
    v = lm.vocabulary(lm.cut(lm.token_counts(rows)), s)
    codes = [np.frombuffer(r.codes, np.uint64) for r in rows.collect()]
    units, sizes = v.unit_ids(np.concatenate(codes)), np.array([len(c) for c in codes])
    start = lm.fresh(v, s)
    batch = pa.RecordBatch.from_pylist([{"codes": c.tobytes()} for c in codes])
    before = lm.unit_logs(start, v, units, sizes, 512).sum()
    after = [lm.unit_logs(lm._train(iter([batch] * n), start, v, s, (0, 0)).m, v, units, sizes, 512).sum() for n in (1, 4)]
    assert before < after[0] < after[1]


def test_edge_rows(documents):
    pairs = [(0, None), (1, ""), (2, " \n"), (2, " \n"), (None, "alone here"), (None, None), (3, "w " * 30_000), (4, "z" * 9000)]
    got = lm.score_texts(documents(pairs)).collect()
    assert len(got) == len(pairs)
    total, want = base_scores(pairs)
    assert sorted((r.n_tokens, r.n_known) for r in got) == sorted(x[:2] for x in want.values())
    assert all(r.train_tokens == total and math.isfinite(r.score) and r.score <= 0 for r in got)
    assert not any(r.held_out for r in got if r.doc_id is None)
    assert lm.score_texts(documents([])).count() == 0
    only_held = [(i, "some text") for i in range(200) if held(i)][:3]
    for r in lm.score_texts(documents(only_held)).collect():
        assert r.train_tokens == 0 and r.n_known == 0 and math.isfinite(r.score)
