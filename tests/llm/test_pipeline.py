import random

import corpus_pipeline
from stratus.llm import bpe
from stratus.llm.queries import oracle_sql, queries

from .test_bpe import expected


def test_stages_take_effect_in_order(spark, tmp_path):
    rng = random.Random(12)

    def prose(n):
        return " ".join(rng.choice(["the", "of", "and", f"w{rng.randrange(9999)}", f"v{rng.randrange(9999)}"]) for _ in range(n)) + "."

    passage = " ".join(prose(12) for _ in range(6))
    good = [(i, "\n".join(prose(15) for _ in range(6))) for i in range(40)]
    rows = good + [(100, good[0][1]), (101, good[1][1] + " the end"), (102, "### $$$ " * 40), (103, "tiny")]
    rows += [(110 + i, f"{prose(60)}\n{passage}\n{prose(60)}") for i in range(4)] + [(None, prose(50)), (104, None)]
    spark.createDataFrame([(i, t, "en", f"s{(i or 0) % 2}", len(t or "")) for i, t in rows],
                          "doc_id long, text string, lang string, source string, n_chars long"
                          ).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        path = f"{tmp_path}/{name}"
        docs.write.parquet(path)
        docs = spark.read.parquet(path)
        seen[name] = docs
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    ids = {name: {r.doc_id for r in df.select("doc_id").collect()} for name, df in seen.items()}
    clean = {i for i, _ in good} | {110, 111, 112, 113, None}
    assert ids["quality_rules"] == clean | {100, 101}
    assert ids["minhash_near_dedup"] == clean and ids["substring_dedup"] == clean
    assert seen["substring_dedup"].where(f"contains(text, '{passage}')").count() == 1
    assert seen["substring_dedup"].where("n_chars != length(text)").count() == 0
    mixed = {r.doc_id: r.text for r in seen["source_mixing"].collect()}
    for r in seen["bpe"].collect():
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == expected(mixed[r.doc_id])
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == seen["bpe"].count()


def test_stages_keep_columns_with_names_of_their_own(spark, documents):
    rng = random.Random(3)
    pairs = [(i, " ".join(f"the and of w{rng.randrange(9999)} v{rng.randrange(9999)}" for _ in range(40)) + ".") for i in range(30)]
    extra = ("n_removed", "copy_no_", "kept", "key_", "row_", "component_id", "n_words")
    docs = documents(pairs + [(3, pairs[3][1]), (None, pairs[4][1] + " more of it"), (77, None)], extra)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", *extra]
        assert {r.n_removed + r.copy_no_ for r in docs.collect()} == {"xx"}


def test_stages_of_an_empty_table(spark, documents):
    docs = documents([])
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
        assert docs.count() == 0, name


def test_registered_queries():
    names = list(queries())
    assert [int(n[2:].split("_")[0]) for n in names] == list(range(1, 14))
    assert set(oracle_sql()) <= set(names) and corpus_pipeline.ORACLE_SQL is None
    assert bpe.Settings().tokenizer == "word_bpe_49k.json"
