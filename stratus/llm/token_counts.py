"""Greedy word-piece counts by a linear longest-match automaton.

The vocabulary's word-initial and continuation pieces form a trie with two
roots. Every node has a failure link and the number of tokens that following
it pops, both worked out once per worker process, breadth first. A word is then read
once, left to right, and its number of greedy longest-match pieces is the sum
of the popped counts; no piece is built and no position is read twice.

Words are runs of characters other than space, tab, \\n, \\v, \\f, \\r, in the
case in which they stand, as the vocabulary is cased. A word that cannot be
split into pieces counts as one unknown token. The vocabulary is that of a
sentencepiece file: a piece with a leading mark starts a word, one without
continues it.

Defined results: null or empty text has zero counts; repeated rows are counted
each for itself; a word of any length is read whole. Other columns are not read.
"""

from __future__ import annotations

import os
from collections import deque
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import record_batches, word_slices

MARK = "▁"
MEMO_WORDS = 100_000  # counted words remembered by a task; forgotten together when full


@dataclass
class Automaton:
    """Nodes 0 (start of a word) and 1 (within a word) are roots."""
    children: list[dict[str, int]] = field(default_factory=lambda: [{}, {}])
    fail: list[int] = field(default_factory=lambda: [-1, -1])
    pops: list[int] = field(default_factory=lambda: [0, 0])

    def count(self, word: str) -> int:
        """Number of pieces, or -1 for an unknown word."""
        children, fail, pops = self.children, self.fail, self.pops
        node = total = 0
        for ch in word:
            after = children[node].get(ch)
            while after is None:
                total += pops[node]
                node = fail[node]
                if node < 0:
                    return -1
                after = children[node].get(ch)
            node = after
        while node > 1:
            total += pops[node]
            node = fail[node]
        return total if node == 1 else -1


def build(initial: Iterable[str], following: Iterable[str]) -> Automaton:
    auto = Automaton()
    children, fail, pops = auto.children, auto.fail, auto.pops
    ends = set()
    for root, pieces in ((0, initial), (1, following)):
        for piece in pieces:
            node = root
            for ch in piece:
                if ch not in children[node]:
                    children[node][ch] = len(children)
                    children.append({})
                    fail.append(-1)
                    pops.append(0)
                node = children[node][ch]
            if node > 1:
                ends.add(node)
    queue = deque([0, 1])
    while queue:
        node = queue.popleft()
        for ch, child in children[node].items():
            queue.append(child)
            if child in ends:
                fail[child], pops[child] = 1, 1
                continue
            back, popped = fail[node], pops[node]
            while back >= 0 and ch not in children[back]:
                popped += pops[back]
                back = fail[back]
            if back >= 0:
                fail[child], pops[child] = children[back][ch], popped
    return auto


_built: dict[str, Automaton] = {}


def automaton(model: str) -> Automaton:
    """The automaton of a sentencepiece file (name or absolute path), built once per worker process."""
    if model not in _built:
        import sentencepiece
        path = model
        if not os.path.isabs(model):
            import public_tokenizers
            path = public_tokenizers.path(model)
        sp = sentencepiece.SentencePieceProcessor(model_file=str(path))
        pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())
                  if not (sp.is_unknown(i) or sp.is_control(i) or sp.is_byte(i) or sp.is_unused(i))]
        _built[model] = build((p[1:] for p in pieces if p[0] == MARK and len(p) > 1),
                              (p for p in pieces if p[0] != MARK))
    return _built[model]


_COUNTS = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_tokens", pa.int64()), ("n_unknown", pa.int64())])


def token_counts(docs: DataFrame, model: str = "piece_bpe_32k.model") -> DataFrame:
    """``doc_id, n_words, n_tokens, n_unknown`` per row; unknown words are tokens too."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        auto, memo = automaton(model), {}

        def rows():
            for batch in batches:
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    words = tokens = unknown = 0
                    for part in word_slices(text.as_py() or "", lower=False):
                        words += len(part)
                        for word in part:
                            n = memo.get(word)
                            if n is None:
                                n = auto.count(word.decode("utf-8", "surrogatepass"))
                                if len(memo) >= MEMO_WORDS:
                                    memo.clear()
                                if len(word) <= 64:
                                    memo[word] = n
                            if n < 0:
                                unknown += 1
                            else:
                                tokens += n
                    yield doc_id, words, tokens + unknown, unknown
        return record_batches(rows(), _COUNTS)

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text")).mapInArrow(
        run, "doc_id long, n_words long, n_tokens long, n_unknown long")
