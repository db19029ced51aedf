import hashlib
import heapq
import random
import re
import zlib
from collections import defaultdict

import pytest
from stratus.llm import chat_repair as C

GOOD = re.compile(r"(s?(ua)+)?")


def cheapest(initials, forced, short):
    """Least cost, then ASCII-least initials of the edits: a plain search over (turn, roles so far up to the grammar)."""
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    heap, seen = [(0, "", 0, "", ())], {}
    while heap:
        cost, audit, at, state, made = heapq.heappop(heap)
        if (at, state) in seen:
            continue
        seen[at, state] = True
        if at == len(initials) and state in ("", "a"):
            return cost, audit, made
        for c in "ua":
            if (state, c) in step:
                heapq.heappush(heap, (cost + 3, audit + "I", at, c, (*made, ("I", c, at))))
        if at < len(initials):
            more = 3 if short[at] else 0
            heapq.heappush(heap, (cost + 4, audit + "D", at + 1, state, made))
            if not forced[at]:
                if (state, initials[at]) in step:
                    heapq.heappush(heap, (cost + more, audit + "K", at + 1, step[state, initials[at]], (*made, ("K", initials[at], at))))
                for c in "ua":
                    if (state, c) in step:
                        heapq.heappush(heap, (cost + 3 + more, audit + "R", at + 1, c, (*made, ("R", c, at))))
    raise AssertionError


def expected(rows):
    """{conv_id: row} by plain Python, for rows (conv_id, turn, role, text)."""
    out, damaged = {}, defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        damaged[conv] += []
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        damaged[conv] += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    for conv, turns in damaged.items():
        turns.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2][:64], hashlib.md5(r[2].encode()).hexdigest()))
        seen, faults = set(), []
        for _, role, text in turns:
            bare = text.rstrip(C.BLANKS)
            faults.append("blank" if not bare else "duplicate" if (role, text) in seen else
                          "truncated" if bare[-1] not in ".!?" else "")
            seen.add((role, text))
        first = [r[:1] for _, r, _ in turns]
        cost, audit, made = cheapest(first, [f in ("blank", "duplicate") for f in faults], [f == "truncated" for f in faults])
        lines = []
        for edit, c, at in made:
            name = {"u": "user", "a": "assistant"}.get(c)
            lines.append(f"{turns[at][1]}:{turns[at][2]}" if edit == "K" else f"{name}:{turns[at][2] if edit == 'R' else ''}")
        assert GOOD.fullmatch("".join(x[0] for x in lines))
        numbers = [t for t, _, _ in turns if t is not None]
        out[conv] = (max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0,
                     *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
                     sum(a + b not in ("su", "ua", "au") for a, b in zip(first, first[1:], strict=False)), cost, audit,
                     hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def check(spark, rows, chunk=1024, extra=""):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    if extra:
        df = df.selectExpr("*", *(f"1 AS {c}" for c in extra.split()))
    got = {r.conv_id: tuple(r)[1:] for r in C.repair_damaged(df, C.Settings(chunk=chunk)).collect()}
    assert got == expected(rows)


def talk(rng, conv, n, roles=("user", "assistant", "system", "tool", "")):
    texts = ["Yes.", "No!", "cut off", "", " \t", "Why?  ", "long " * 30 + ".", "Yes.\n", "é。", None]
    return [(conv, t if rng.random() < .95 else None, rng.choice(roles) if rng.random() < .95 else None,
             rng.choice(texts) if rng.random() < .5 else f"w{rng.random()}.") for t in range(n)]


def test_random_conversations_equal_a_plain_search(spark):
    rng = random.Random(3)
    rows = [r for c in range(150) for r in talk(rng, c, rng.randrange(1, 9))]
    rows += [r for c in range(150, 220) for r in talk(rng, c, rng.randrange(1, 12), ("user", "assistant"))]
    rows += talk(rng, None, 6) + [(500, 1, "user", "a."), (500, 1, "user", "a."), (500, 1, "system", "b."), (500, 9, "x", "z")]
    check(spark, rows, extra="key at chunk edits first last place code letters")


def test_long_conversations_in_small_chunks(spark):
    rng = random.Random(5)
    rows = talk(rng, 1, 900) + talk(rng, 2, 300, ("user", "assistant")) + [(3, t, "tool", f"t{t}.") for t in range(301)]
    rows += [(4, t, "user", "") for t in range(200)] + [(5, t, ("user", "assistant")[t % 2], f"x{t}.") for t in range(400)]
    rows += [(6, t, "tool", f"t{t}") for t in range(200)] + [(7, 0, "user", "same.")] * 60
    rng.shuffle(rows)
    check(spark, rows, chunk=8)


def test_no_rows_and_conversations_without_rows(spark):
    dropped = next(t for t in range(1000) if zlib.crc32(f"7:{t}".encode()) % 20 == 0)
    check(spark, [(7, dropped, "user", "hello.")])
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert C.repair_damaged(df).count() == 0


def test_repaired_rows_are_well_formed(spark):
    rng = random.Random(8)
    df = spark.createDataFrame([r for c in range(60) for r in talk(rng, c, 7)], "conv_id long, turn long, role string, text string")
    rows = C.repair(df).rows().orderBy("key", "at", "place").collect()
    said = defaultdict(str)
    for r in rows:
        said[r.key] += r.role[:1]
        assert r.edit == "I" or r.text.strip(C.BLANKS)
    assert all(GOOD.fullmatch(x) for x in said.values()) and any(r.edit == "I" and r.turn is None for r in rows)


@pytest.mark.parametrize("letters", ["B" * 60, "D" * 61, "H" * 30, "BC" * 30, "PD" * 33, "MBNO" * 9])
def test_runs_that_stop_early_give_the_same_vectors(letters):
    m = C.Machine([C.END, (0, 0, 0, 0), (3, 3, 0, 3), (0, 1, 1, 0)])
    ends = list(range(4))
    assert m.starts(letters, ends) == [m.run(letters, k)[0] for k in ends]
