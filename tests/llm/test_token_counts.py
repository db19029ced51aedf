import random

from stratus.llm.token_counts import automaton, build, token_counts

from .conftest import WORD, words


def greedy(word, initial, following):
    count, at = 0, 0
    while at < len(word):
        pieces = initial if at == 0 else following
        end = next((e for e in range(len(word), at, -1) if word[at:e] in pieces), None)
        if end is None:
            return -1
        count, at = count + 1, end
    return count


def test_automaton_equals_greedy_matching_on_random_vocabularies():
    rng = random.Random(1)
    for _ in range(150):
        def pieces(n):
            return {"".join(rng.choice("abc") for _ in range(rng.randint(1, 5))) for _ in range(n)}
        initial, following = pieces(rng.randint(1, 12)), pieces(rng.randint(1, 12))
        auto = build(initial, following)
        for _ in range(60):
            word = "".join(rng.choice("abcd" if rng.random() < 0.1 else "abc") for _ in range(rng.randint(1, 14)))
            assert auto.count(word) == greedy(word, initial, following), (word, initial, following)


def test_query_equals_greedy_matching_with_the_real_vocabulary(documents):
    import public_tokenizers
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=str(public_tokenizers.path("piece_bpe_32k.model")))
    pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size()) if not (sp.is_unknown(i) or sp.is_control(i) or sp.is_byte(i))]
    initial = {p[1:] for p in pieces if p[0] == "▁" and len(p) > 1}
    following = {p for p in pieces if p[0] != "▁"}
    pairs = [(1, None), (2, ""), (3, "The unbelievable, Theatre-goer's 1234 éclair 中文字 \U0001F642"), (None, "null id"),
             (4, "x" * 5000), (5, "same row"), (5, "same row"), (6, "wörd\x0bwörd " * 500)]
    got = sorted(token_counts(documents(pairs)).collect(), key=str)
    assert len(got) == len(pairs)
    want = []
    for i, t in pairs:
        counts = [greedy(w, initial, following) for w in words(t)]
        want.append((i, len(counts), sum(max(c, 1) for c in counts), sum(c < 0 for c in counts)))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert token_counts(documents([])).count() == 0
    assert automaton("piece_bpe_32k.model").count("the") == 1


def test_words_are_counted_in_their_own_case(documents):
    import public_tokenizers
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=str(public_tokenizers.path("piece_bpe_32k.model")))
    pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size()) if not (sp.is_unknown(i) or sp.is_control(i) or sp.is_byte(i))]
    initial = {p[1:] for p in pieces if p[0] == "▁" and len(p) > 1}
    following = {p for p in pieces if p[0] != "▁"}
    texts = ["UNBELIEVABLE", "unbelievable", "The NASA Theatre, McDonald's\x0bABLE able", "ÉCLAIR iPhone"]
    for r in token_counts(documents(list(enumerate(texts)))).collect():
        counts = [greedy(w, initial, following) for w in WORD.findall(texts[r.doc_id])]
        assert (r.n_words, r.n_tokens, r.n_unknown) == (
            len(counts), sum(max(c, 1) for c in counts), sum(c < 0 for c in counts)), texts[r.doc_id]
    assert automaton("piece_bpe_32k.model").count("UNBELIEVABLE") != automaton("piece_bpe_32k.model").count("unbelievable")
