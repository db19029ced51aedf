"""Quality rules, winnowing, source mixing and chat formatting (column expressions only)."""
import hashlib
import random

import duckdb
import pandas as pd
import pytest

from stratus.llm import chat_format, mixing, quality_rules, winnowing

from .conftest import WORD

TEXTS = [
    None, "", " \n\t ", "one", "a b\x0bc\x0cd\re", "the cat and the dog " * 12, "a b c d e f g h i j " * 5,
    "\n".join(["the same line of words here"] * 6 + ["another of the lines"] * 2), "### $$$ the of and | & < >" * 4,
    " ".join(f"w{i}" for i in range(60)), "the " + " of ".join(f"word{i}," for i in range(60)), "x" * 30_000,
    "- the of a\n- and the in\n" * 10, "the of and so on ...\nit is that …\n" * 9, "ééé ñ 中文 the of and to a in is " * 9,
    " ".join(["the of and it is to be or not"] * 3) + " " + " ".join(f"q{i} the" for i in range(40)),
]


def base_counts(text):
    t = text or ""
    w = WORD.findall(t)
    where = {}
    for i in range(len(w) - 7):
        where.setdefault(tuple(w[i:i + 8]), []).append(i)
    covered = {p for at in where.values() if len(at) > 1 for i in at for p in range(i, i + 8)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered))


def test_quality_counts_and_verdict(documents):
    got = {r.doc_id: r for r in quality_rules.judge(documents(list(enumerate(TEXTS)))).collect()}
    assert len(got) == len(TEXTS)
    for i, t in enumerate(TEXTS):
        r = got[i]
        n, chars, symbols, dups, repeats = base_counts(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, dups, repeats)
        assert r.base_failed == (n < 20 or 100 * repeats > 30 * n)
        assert r.kept == (not r.base_failed and r.failed_rules == "")
    assert got[10].kept and got[14].n_words == 90 and "stop_words" in got[9].failed_rules
    assert "symbols" in got[8].failed_rules and "bullet_lines" in got[12].failed_rules


def test_quality_filter_keeps_whole_rows(documents):
    docs = documents([*enumerate(TEXTS), (None, TEXTS[10]), (10, TEXTS[10])])
    out = quality_rules.keep_good(docs)
    assert out.columns == docs.columns
    good = {r.doc_id for r in quality_rules.judge(docs).where("kept").collect()}
    assert sorted(r.doc_id or -1 for r in out.collect()) == sorted([*(i for i in good if i is not None), 10, -1])
    assert quality_rules.keep_good(documents([])).count() == 0 and quality_rules.judge(documents([])).count() == 0


def test_filter_on_a_verdict_does_not_multiply_the_plan(documents):
    plan = quality_rules.judge(documents([(1, "a")])).where("kept and n_repeat_words = 0")
    assert len(plan._jdf.queryExecution().optimizedPlan().toString()) < 40_000


def test_quality_oracle(documents):
    docs = documents([(i, t) for i, t in enumerate(TEXTS)]).select("doc_id", "text")
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    want = con.execute(quality_rules.ORACLE).fetchdf().sort_values("doc_id").reset_index(drop=True)
    got = quality_rules.judge(docs).toPandas().sort_values("doc_id").reset_index(drop=True)
    pd.testing.assert_frame_equal(got, want[got.columns], check_dtype=False)


def test_fingerprints_of_edited_texts(documents):
    rng = random.Random(8)
    words = [" ".join(f"w{rng.randrange(60)}" for _ in range(n)) for n in (0, 1, 3, 30, 200, 200, 400)]
    pairs = [(i * 1000 - 2000, w) for i, w in enumerate(words)] + [(70_000_000_000, words[4]), (99, None)]
    got = {r.doc_id: r for r in winnowing.compare_with_edits(documents(pairs)).collect()}
    ids = sorted(got)
    texts = {i: t or "" for i, t in pairs}
    for at, i in enumerate(ids):
        follows = texts[ids[(at + 1) % len(ids)]]
        half = len(texts[i]) // 2
        edited = texts[i][:len(texts[i]) - half] + follows[:half]
        assert got[i].n_chars == len(texts[i])
        assert got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= got[i].near_edited <= 1 and 0 <= got[i].near_next <= 1
    assert got[2000].fingerprint == got[70_000_000_000].fingerprint != ""
    assert got[-2000].fingerprint == "" and got[-2000].near_edited == 1.0
    assert got[3000].near_edited > got[3000].near_next


def test_fingerprint_equals_brute_force_winnowing(spark):
    rng = random.Random(3)
    text = " ".join(rng.choice("ab") for _ in range(300))
    s = winnowing.Settings(k=3, window=6)
    df = spark.createDataFrame([(text,)], "text string")
    units = text.split()
    from pyspark.sql import functions as F
    grams = df.select(F.expr("transform(split(text, ' '), x -> xxhash64(x))").alias("h")).select(
        F.expr(f"transform(sequence(1, {len(units) - 2}), i -> xxhash64(slice(h, i, 3)) & {(1 << 33) - 1})").alias("g")).first().g
    chosen = []
    for i in range(len(grams) - s.window + 1):
        least = min(grams[i:i + s.window])
        at = max(j for j in range(i, i + s.window) if grams[j] == least)  # rightmost
        if (least, at) not in chosen:
            chosen.append((least, at))
    got = winnowing.with_fingerprint(df, "text", "fp", s).select(winnowing.written("fp")).first()[0]
    assert got == ",".join(f"{h:X}@{p}" for h, p in chosen)
    places = [p for _, p in chosen]
    assert all(b - a <= s.window for a, b in zip(places, places[1:]))  # no match of window + k - 1 units is missed


def test_shared_parts_of_short_and_of_unspaced_texts_are_found(spark):
    rng = random.Random(4)
    cjk = "".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(3000))
    words = [f"w{i}" for i in range(16)]
    pairs = [(cjk, "\u4e2d" + cjk), (cjk, cjk[:1500] + "\U0001F642" + cjk[1500:]),
             (" ".join(words), " ".join(words[:8] + [f"x{i}" for i in range(8)])),  # eight units in a row
             ("an " + "abcdefghijklm" * 40, "an " + "x" + "abcdefghijklm" * 40)]
    df = spark.createDataFrame(pairs, "a string, b string")
    for side in "ab":
        df = winnowing.with_fingerprint(df, side, f"{side}_").withColumn(f"{side}_", winnowing.hashes(f"{side}_"))
    got = [r.x for r in df.select(winnowing.likeness("a_", "b_").alias("x")).collect()]
    assert got[0] > 0.95 and got[1] > 0.95 and got[2] > 0 and got[3] > 0.5


def test_units_are_short_runs_and_characters_of_long_runs(spark):
    s = winnowing.Settings(k=1, window=1)
    df = spark.createDataFrame([("Ab " + "q" * 12 + "\t" + "abcdefghijklm" + "\x0bx",)], "text string")
    got = winnowing.with_fingerprint(df, "text", "fp", s).select(winnowing.written("fp")).first()[0]
    assert len(got.split(",")) == 2 + 13 + 1


def test_fingerprint_edge_rows(documents):
    docs = documents([(1, "a b"), (1, "c d"), (None, "e f g"), (None, None)])
    got = winnowing.compare_with_edits(docs).collect()
    assert len(got) == 4
    null = next(r for r in got if r.doc_id is None and r.n_chars == 5)
    assert null.edited_sha256 == hashlib.sha256(b"e f").hexdigest()
    first = next(r for r in got if r.n_chars == 3 and r.doc_id == 1)
    assert first.edited_sha256 in {hashlib.sha256(x).hexdigest() for x in (b"a a", b"c a")}
    assert winnowing.compare_with_edits(documents([])).count() == 0


def _sources(documents, n=4000):
    rng = random.Random(6)
    rows = [(i, "t" * rng.randrange(20, 60)) for i in range(n)]
    docs = documents(rows, extra=("rate", "steps", "copies"))
    from pyspark.sql import functions as F
    return docs.withColumn("source", F.expr("case when doc_id % 3 = 0 then 'hot' when doc_id % 50 = 1 then null else 's' end"))


def test_mixing_reaches_target_weights_and_is_repeatable(documents):
    from pyspark.sql import functions as F
    docs = _sources(documents)
    out = mixing.mix_sources(docs)
    assert out.columns == [*docs.columns, "copy_no_"]
    size = {r["source"]: r["sum(n)"] for r in docs.select("source", F.length("text").alias("n")).groupBy("source").sum("n").collect()}
    got = {r["source"]: r["sum(n)"] for r in out.select("source", F.length("text").alias("n")).groupBy("source").sum("n").collect()}
    roots = {k: v ** 0.5 for k, v in size.items()}
    for k in size:
        want = sum(size.values()) * roots[k] / sum(roots.values())
        assert abs(got[k] - want) < 0.15 * want
    again = mixing.mix_sources(docs.repartition(5))
    assert sorted(map(tuple, out.select("doc_id", "copy_no_").collect())) == sorted(
        map(tuple, again.select("doc_id", "copy_no_").collect()))
    order = [r.doc_id for r in out.select("doc_id").collect()]
    assert order != sorted(order)


def test_mixing_with_given_weights_without_broadcast(documents, monkeypatch):
    docs = _sources(documents, 900)
    want = sorted(map(tuple, mixing.mix_sources(docs, {"hot": 3.0, "s": 1.0}).select("doc_id", "copy_no_").collect()))
    monkeypatch.setattr(mixing, "BROADCAST_ENTRIES", 0)
    out = mixing.mix_sources(docs, {"hot": 3.0, "s": 1.0})
    assert sorted(map(tuple, out.select("doc_id", "copy_no_").collect())) == want
    assert out.where("source is null").count() == 0


def test_mixing_edge_tables(documents):
    assert mixing.mix_sources(documents([])).count() == 0
    docs = documents([(None, None), (None, "a"), (3, ""), (3, "")])
    out = mixing.mix_sources(docs, scale=4.0)
    assert set(out.columns) >= set(docs.columns) and out.where("doc_id = 3").count() % 2 == 0
    assert mixing.mix_sources(documents([(1, ""), (2, None)]), scale=3.0).count() >= 0


def test_poisson_steps_are_the_distribution_function(spark):
    import math
    rates = spark.createDataFrame([("a", 0.4), ("b", 30.0), ("c", 900.0)], "source_ string, rate double")
    for name, steps in mixing.poisson_steps(rates).collect():
        rate = {"a": 0.4, "b": 30.0, "c": 900.0}[name]
        k = int(rate)
        assert steps == sorted(steps) and abs(steps[-1] - 1) < 1e-9
        want = sum(math.exp(j * math.log(rate) - rate - math.lgamma(j + 1)) for j in range(k + 1))
        assert abs(steps[k] - want) < 1e-9


def _chats():
    turns = [("user", "hi"), ("assistant", "hello"), ("user", "more"), (None, None)]
    rows = [(c, i, r, t) for c, n in ((1, 2), (2, 4), (3, 4), (4, 1), (5, 3)) for i, (r, t) in enumerate(turns[:n])]
    rows += [(6, 10, "user", "hi"), (6, 20, "assistant", "other")]           # shares a first turn only
    rows += [(7, 0, "user", "solo"), (7, 0, "user", "solo")]                  # a repeated row
    rows += [(None, 0, "user", "x"), (8, None, "user", "first"), (8, 1, "user", "second"), (9, 0, "userhi", "")]
    return rows


def test_rows_without_conv_id_are_never_gathered(spark):
    from pyspark.sql import functions as F
    rows = [(None, k % 3, "user", f"t{k % 40}") for k in range(400)] + [(None, 1, None, None), (5, 0, "user", "t3"), (5, 1, "user", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert chat_format.prefix_hashes(df).where("conv_id is null").agg(F.max("n")).first()[0] == 1
    got = sorted(((r.conv_id, r.n_turns, r.n_copies, r.rendered) for r in chat_format.format_chats(df).collect()), key=str)
    con = duckdb.connect()
    con.register("conversations", df.toPandas())
    assert got == sorted(con.execute(chat_format.ORACLE).fetchall(), key=str)
    assert sum(r[2] for r in got if r[0] is None) == 391 and len(got) == 41  # ten logs of t3 begin conversation 5


def test_chats_collapse_to_maximal_conversations(spark):
    df = spark.createDataFrame(_chats(), "conv_id long, turn long, role string, text string")
    from pyspark.sql import functions as F
    df = df.withColumn("n", F.lit("x")).withColumn("line", F.lit("y"))
    got = {r.conv_id: r for r in chat_format.format_chats(df).collect()}
    assert set(got) == {2, 6, 7, 8, 9, None}
    assert got[2].n_turns == 4 and got[2].n_copies == 2 and got[7].n_turns == 1
    assert got[2].rendered.startswith("<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\nhello<|im_end|>")
    assert got[2].rendered.endswith("<|im_start|>unknown\n<|im_end|>")
    assert got[8].rendered.index("first") < got[8].rendered.index("second")
    con = duckdb.connect()
    con.register("conversations", df.toPandas())
    want = con.execute(chat_format.ORACLE).fetchall()
    assert sorted(want, key=str) == sorted(([r.conv_id, r.n_turns, r.n_copies, r.rendered] for r in got.values()), key=str) \
        or sorted(map(tuple, want), key=str) == sorted(((r.conv_id, r.n_turns, r.n_copies, r.rendered) for r in got.values()), key=str)
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat_format.format_chats(empty).count() == 0
