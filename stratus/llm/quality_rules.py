"""Quality rules: a threshold table compiled into one projection, no user functions.

Counting words, repeated windows and lines takes higher-order array functions;
every ratio of the table is then one column expression, and the verdict is the
conjunction of the table's bounds. There is no shuffle.

Defined results: a null text counts as an empty one; a text without words has
zero counts and fails the base rule; ratios over zero words or lines are 0.
Rows are judged one by one, so repeated rows get equal verdicts; other columns
are neither read nor changed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, settled

#: Frequent words of the languages kept (English, French, German, Spanish).
STOP_WORDS = (
    "the of and to a in is that it for was on with as be by this are at from or an not have "
    "de la le et les des en un du une que est pour qui dans au sur par pas avec "
    "der die und den von zu das mit sich auf für ist im nicht dem ein als eine "
    "el y los se del las por con no una su para es al lo"
).split()

MIN_WORDS = 20          # base rule
MAX_REPEAT_PERCENT = 30  # base rule: words in repeated 8-word windows
WINDOW = 8


@dataclass(frozen=True)
class Rule:
    name: str
    metric: str   # key of metrics()
    low: float
    high: float


RULES = (
    Rule("word_length", "mean_word_chars", 2.0, 14.0),
    Rule("symbols", "symbols_per_word", 0.0, 0.1),
    Rule("stop_words", "stop_word_ratio", 0.06, 1.0),
    Rule("adjacent_repeats", "adjacent_repeat_ratio", 0.0, 0.2),
    Rule("duplicate_lines", "duplicate_line_ratio", 0.0, 0.4),
    Rule("bullet_lines", "bullet_line_ratio", 0.0, 0.9),
    Rule("ellipsis_lines", "ellipsis_line_ratio", 0.0, 0.3),
)


def word_array(text: Column) -> Column:
    return F.array_remove(F.split(text, f"{SPACE}+"), "")


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def metrics() -> dict[str, Column]:
    """The ratios that rules bound, over the columns that ``counted`` provides."""
    stop = F.size(F.filter("words_", lambda w: F.rtrim(F.lower(w), F.lit(".,;:!?")).isin(STOP_WORDS)))
    again = F.size(F.filter("words_", lambda w, i: (i > 0) & (w == F.get("words_", i - 1))))
    bullets = F.size(F.filter("lines_", lambda x: x.rlike(f"^{SPACE}*[-*•‣·]")))
    dots = F.size(F.filter("lines_", lambda x: x.rlike(rf"(\.\.\.|…){SPACE}*$")))
    n, lines = F.col("n_words"), F.size("lines_")
    return {
        "mean_word_chars": _ratio(F.col("word_chars"), n),
        "symbols_per_word": _ratio(F.col("n_symbols"), n),
        "stop_word_ratio": _ratio(stop, n),
        "adjacent_repeat_ratio": _ratio(again, n),
        "duplicate_line_ratio": _ratio(F.col("n_dup_lines"), lines),
        "bullet_line_ratio": _ratio(bullets, lines),
        "ellipsis_line_ratio": _ratio(dots, lines),
    }


def _repeat_words(df: DataFrame) -> DataFrame:
    """Adds n_repeat_words: words in 8-word windows that occur twice or more in the text.

    Window hashes with their positions are sorted, so equal windows become
    neighbours; only texts with a repeated window pay for the sort.
    """
    hashes = F.transform("words_", lambda w: F.xxhash64(w))
    df = df.withColumn("hashes_", hashes)
    windows = F.when(F.size("hashes_") >= WINDOW, F.transform(
        F.sequence(F.lit(1), F.size("hashes_") - (WINDOW - 1)),
        lambda i: F.xxhash64(F.slice("hashes_", i, WINDOW)))).otherwise(F.array().cast("array<bigint>"))
    df = df.withColumn("windows_", windows)
    ordered = F.array_sort(F.transform("windows_", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    df = df.withColumn("ordered_", F.when(F.size(F.array_distinct("windows_")) < F.size("windows_"), ordered))
    repeated = F.filter("ordered_", lambda x, i: (x["h"] == F.get("ordered_", i + 1)["h"])
                        | ((i > 0) & (x["h"] == F.get("ordered_", F.greatest(i - 1, F.lit(0)))["h"])))
    df = df.withColumn("places_", F.array_sort(F.transform(repeated, lambda x: x["i"])))
    start = F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last"))
    covered = F.aggregate("places_", start, lambda acc, i: F.struct(
        (acc["n"] + F.least(F.lit(WINDOW), i - acc["last"])).alias("n"), i.alias("last")))
    return df.withColumn("n_repeat_words", settled(F.coalesce(covered["n"], F.lit(0)).cast("long")))


def counted(df: DataFrame, text: Column) -> DataFrame:
    """``df`` with the base counts and the arrays ``words_`` and ``lines_`` (the caller names no such column)."""
    df = df.withColumn("text_", F.coalesce(text.cast("string"), F.lit("")))
    df = df.withColumn("words_", word_array(F.col("text_"))).withColumn(
        "lines_", F.filter(F.split("text_", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    df = df.withColumns({
        "n_words": F.size("words_").cast("long"),
        "word_chars": F.length(F.array_join("words_", "")).cast("long"),
        "n_symbols": (F.length("text_") - F.length(F.regexp_replace("text_", r"[#*$%&|<>]", ""))).cast("long"),
        "n_dup_lines": (F.size("lines_") - F.size(F.array_distinct("lines_"))).cast("long"),
    })
    return _repeat_words(df)


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per row of ``docs``: the base counts, the base verdict, ``kept`` and the failed rules' names."""
    df = counted(docs.select(docs["doc_id"], docs["text"].alias("raw_")), F.col("raw_"))
    known = metrics()
    df = df.withColumns({f"m_{r.metric}": known[r.metric] for r in rules})
    broken = [F.when(~F.col(f"m_{r.metric}").between(r.low, r.high), F.lit(r.name)) for r in rules]
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return df.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base.alias("base_failed"), F.concat_ws(",", *broken).alias("failed_rules"),
    ).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
             settled(~F.col("base_failed") & (F.col("failed_rules") == "")).alias("kept"), "failed_rules")


def keep_good(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns, unchanged."""
    packed = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row_"))
    df = counted(packed, F.col("row_.text"))
    known = metrics()
    df = df.withColumns({f"m_{r.metric}": known[r.metric] for r in rules})
    good = (F.col("n_words") >= MIN_WORDS) & (100 * F.col("n_repeat_words") <= MAX_REPEAT_PERCENT * F.col("n_words"))
    for r in rules:
        good = good & F.col(f"m_{r.metric}").between(r.low, r.high)
    return df.select("row_", settled(good).alias("good_")).where("good_").select("row_.*")


def _sql_list(words) -> str:
    return "[" + ", ".join("'" + w + "'" for w in words) + "]"


ORACLE = f"""
WITH base AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT r, doc_id, t, list_filter(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM base),
win AS (
  SELECT r, i, array_to_string(words[i:i + 7], ' ') AS g
  FROM (SELECT r, words, unnest(range(1, len(words) - 6)) AS i FROM w WHERE len(words) >= 8)),
places AS (
  SELECT DISTINCT r, i + unnest(range(0, 8)) AS p
  FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM win) WHERE n > 1),
rep AS (SELECT r, count(*) AS n FROM places GROUP BY r),
c AS (
  SELECT w.r, doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(rep.n, 0)::BIGINT AS n_repeat_words, len(lines) AS n_lines,
         len(list_filter(words, lambda x: list_contains({_sql_list(STOP_WORDS)}, rtrim(lower(x), '.,;:!?')))) AS n_stop,
         len(list_filter(range(2, len(words) + 1), lambda i: words[i] = words[i - 1])) AS n_again,
         len(list_filter(lines, lambda x: regexp_matches(x, '^[\\x20\\x09-\\x0D]*[-*•‣·]'))) AS n_bullets,
         len(list_filter(lines, lambda x: regexp_matches(x, '(\\.\\.\\.|…)[\\x20\\x09-\\x0D]*$'))) AS n_dots
  FROM w LEFT JOIN rep ON rep.r = w.r),
f AS (
  SELECT *, (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed,
    array_to_string(list_filter([
      CASE WHEN n_words = 0 OR word_chars / n_words < 2 OR word_chars / n_words > 14 THEN 'word_length' END,
      CASE WHEN n_words > 0 AND n_symbols / n_words > 0.1 THEN 'symbols' END,
      CASE WHEN n_words = 0 OR n_stop / n_words < 0.06 THEN 'stop_words' END,
      CASE WHEN n_words > 0 AND n_again / n_words > 0.2 THEN 'adjacent_repeats' END,
      CASE WHEN n_lines > 0 AND n_dup_lines / n_lines > 0.4 THEN 'duplicate_lines' END,
      CASE WHEN n_lines > 0 AND n_bullets / n_lines > 0.9 THEN 'bullet_lines' END,
      CASE WHEN n_lines > 0 AND n_dots / n_lines > 0.3 THEN 'ellipsis_lines' END], lambda x: x IS NOT NULL), ',') AS failed_rules
  FROM c)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       (NOT base_failed AND failed_rules = '') AS kept, failed_rules
FROM f
"""
