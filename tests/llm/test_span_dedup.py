import random

from stratus.llm.span_dedup import Settings, drop_repeated_spans, runs, sentences

S = Settings()


def sentence(rng, low=6, high=12):
    return " ".join(f"w{rng.randrange(10**5)}" for _ in range(rng.randint(low, high))).capitalize() + "."


def brute(pairs):
    """The same rule in a plain loop: global first owner of every span, later ones cut."""
    owner = {}
    split = {}
    for i, t in sorted(pairs):
        parts = sentences(t)
        words = [t[a:b].split() for a, b in parts]
        found = [(r, tuple(map(tuple, words[r[0]:r[1]]))) for r in runs([len(w) for w in words], S)]
        split[i] = (t, parts, found)
        for _, span in found:
            owner.setdefault(span, i)
    out = {}
    for i, (t, parts, found) in split.items():
        gone, seen = set(), set()
        for (a, b), span in found:
            if owner[span] != i or span in seen:
                gone.update(range(a, b))
            seen.add(span)
        out[i] = "".join(t[a:b] for k, (a, b) in enumerate(parts) if k not in gone)
    return out


def test_equals_brute_force(documents):
    rng = random.Random(2)
    passages = [" ".join(sentence(rng) for _ in range(n)) for n in (3, 5, 9)]
    passages.append(" ".join(sentence(rng, 30, 40) for _ in range(2)))        # two long sentences
    passages.append(sentence(rng, 60, 70))                                   # one long sentence
    passages.append("Is so. " * 9 + sentence(rng))
    pairs = []
    for i in range(60):
        parts = [sentence(rng) for _ in range(rng.randrange(0, 8))]
        for p in rng.sample(passages, rng.randrange(0, 3)):
            parts.insert(rng.randrange(len(parts) + 1), p)
        pairs.append((i, rng.choice([" ", "\n", "  \n"]).join(parts)))
    rng.shuffle(pairs)
    out = drop_repeated_spans(documents(pairs))
    got = {r.doc_id: r.text for r in out.collect()}
    assert got == brute(pairs)
    for p in passages[:5]:
        assert sum(p in t for t in got.values()) == min(1, sum(p in t for _, t in pairs))


def test_a_passage_in_very_many_documents(documents):
    rng = random.Random(7)
    passage = " ".join(sentence(rng, 10, 14) for _ in range(5))
    pairs = [(i, f"{sentence(rng)}\n{passage}\n{sentence(rng)}") for i in range(300)]
    got = {r.doc_id: r for r in drop_repeated_spans(documents(pairs)).collect()}
    assert got[0].text == pairs[0][1] and got[0].n_removed == 0
    assert all(got[i].n_removed == 5 and passage not in got[i].text for i in range(1, 300))


def prose(rng, words):
    """Sentences of 4 to 25 words with a comma now and then."""
    out, left = [], 0
    for _ in range(words):
        if not left:
            left = rng.randint(4, 25)
        left -= 1
        out.append(f"w{rng.randrange(10**6)}" + ("." if not left else "," if rng.random() < .12 else ""))
    return out


def test_passages_that_begin_and_end_inside_a_sentence(documents):
    rng = random.Random(11)
    passages = [prose(rng, rng.randint(52, 70)) for _ in range(40)]
    pairs, held = [], {}
    for i in range(240):
        body = prose(rng, rng.randint(30, 200))
        at = rng.randrange(1, len(body))
        if i >= 40:
            held[i] = passages[i % 40]
            body[at:at] = held[i]
        pairs.append((i, " ".join(body)))
    got = {r.doc_id: r for r in drop_repeated_spans(documents(pairs)).collect()}
    assert {i: r.text for i, r in got.items()} == brute(pairs)
    first = set(range(40, 80))
    assert all(not r.n_removed and r.text == pairs[i][1] for i, r in got.items() if i < 40 or i in first)
    later = [i for i in held if i not in first]
    assert sum(got[i].n_removed > 0 and " ".join(held[i]) not in got[i].text for i in later) >= .95 * len(later)


def test_runs_cover_every_sentence_of_a_passage():
    rng = random.Random(6)
    for _ in range(300):
        counts = [rng.choice([1, 2, 4, 9, 16, 30]) for _ in range(rng.randint(1, 12))]
        i, j = sorted(rng.sample(range(len(counts) + 1), 2))
        inside = [(a, b) for a, b in runs(counts, S) if i <= a and b <= j]
        if sum(counts[i:j]) >= S.min_words:
            assert set().union(*(range(a, b) for a, b in inside)) == set(range(i, j))


def test_a_column_named_like_the_count(documents):
    docs = documents([(1, "Some words."), (2, None)], extra=("n_removed", "key", "owner", "new_"))
    out = drop_repeated_spans(docs)
    assert out.columns == [*docs.columns, "n_removed_"] and {r.n_removed for r in out.collect()} == {"x"}


def test_clean_and_odd_rows_stay(documents):
    rng = random.Random(1)
    clean = [(10 + i, "\n".join(sentence(rng) for _ in range(20)) + "  ") for i in range(20)]
    short = [(50 + i, "The. Of. And.") for i in range(5)]                     # too few words for a span
    odd = [(1, None), (2, ""), (3, " \n"), (4, "no end"), (5, "a" * 60_000), (6, "a。b。c。d")]
    docs = documents(clean + short + odd)
    out = drop_repeated_spans(docs)
    assert out.columns == [*docs.columns, "n_removed"]
    got = {r.doc_id: (r.text, r.n_removed) for r in out.collect()}
    assert got == {i: (t, 0) for i, t in clean + short + odd}
    assert drop_repeated_spans(documents([])).count() == 0


def test_copies_repeated_rows_and_rows_without_id(documents):
    rng = random.Random(9)
    text = " ".join(sentence(rng) for _ in range(6))
    got = drop_repeated_spans(documents([(5, text), (2, text), (2, text), (None, text), (None, text + " End of it all.")]))
    by = {}
    for r in got.collect():
        by.setdefault(r.doc_id, []).append(r.text)
    assert by[2] == [text, text] and by[5] == [""]
    assert sorted(by[None]) in (["", "End of it all."], ["", " End of it all."])


def test_repeats_inside_a_document(documents):
    rng = random.Random(4)
    part = " ".join(sentence(rng) for _ in range(4))
    got = drop_repeated_spans(documents([(1, f"{part} Between the two of them. {part}")])).first()
    assert got.text.count(part) == 1 and got.n_removed == 4
