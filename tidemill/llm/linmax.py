"""Greedy word-piece counts with a linear longest-match automaton (operator 6).

A word is cut greedily: the longest piece that starts the word, then again and again the longest continuation piece. The automaton
finds how many pieces that gives in one pass over the word's characters and without building a piece. It is the trie of
the vocabulary (initial pieces below one root, continuations below the other); each node has a failure link, the node that is
reached after cutting off as many whole pieces as the node's string begins with, and the number of pieces cut off on the way.

A word that cannot be cut to its end counts as one unknown token.

Defined cases: a null text, an empty one and one without words have 0 words and 0 tokens; an empty table gives no rows; repeated rows are
counted each; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemill.llm.encoder import tokenizer_path
from tidemill.llm.words import slices, text_column, word_codes

VOCABULARY = "piece_bpe_32k.model"
WORD_START = "▁"
#: Distinct words remembered by one task.
MEMORY = 600_000
_NONE = -1


def vocabulary(path: str) -> tuple[list[str], list[str]]:
    """Initial and continuation pieces of a sentence-piece file; its control, unknown and byte pieces are left out."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    ids = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    pieces = [model.id_to_piece(i) for i in ids]
    initial = [p[1:] for p in pieces if p.startswith(WORD_START) and len(p) > 1]
    return initial, [p for p in pieces if p and WORD_START not in p]


class Automaton:
    """Nodes 0 (start of a word) and 1 (after a piece) are the roots."""

    def __init__(self, initial: Iterable[str], continuation: Iterable[str]):
        self.children: list[dict[str, int]] = [{}, {}]
        ends: set[int] = set()
        for root, pieces in ((0, initial), (1, continuation)):
            for piece in pieces:
                node = root
                for letter in piece:
                    below = self.children[node]
                    if letter not in below:
                        below[letter] = len(self.children)
                        self.children.append({})
                    node = below[letter]
                ends.add(node)
        self.link = [_NONE] * len(self.children)
        self.popped = [0] * len(self.children)
        layer = [0, 1]
        while layer:  # by depth, as a link leads to a shorter string
            below = []
            for parent in layer:
                for letter, node in self.children[parent].items():
                    below.append(node)
                    if node in ends:
                        self.link[node], self.popped[node] = 1, 1
                        continue
                    at, cut_off = self.link[parent], self.popped[parent]
                    while at != _NONE and letter not in self.children[at]:
                        cut_off += self.popped[at]
                        at = self.link[at]
                    if at != _NONE:
                        self.link[node], self.popped[node] = self.children[at][letter], cut_off
            layer = below

    def count(self, word: str) -> int:
        """The number of pieces of a word, 0 when it cannot be cut to its end."""
        children, link, popped = self.children, self.link, self.popped
        node, n = 0, 0
        for letter in word:
            below = children[node].get(letter)
            while below is None:
                n += popped[node]
                node = link[node]
                if node == _NONE:
                    return 0
                below = children[node].get(letter)
            node = below
        while node > 1:
            n += popped[node]
            node = link[node]
            if node == _NONE:
                return 0
        return n


class Counter:
    """Counts of words, remembered up to ``MEMORY`` words."""

    def __init__(self, path: str):
        self.automaton = Automaton(*vocabulary(path))
        self.known: dict[str, int] = {}

    def counts(self, words: list[str]) -> np.ndarray:
        if len(self.known) + len(words) > MEMORY:
            self.known = {}
        known, count = self.known, self.automaton.count
        for word in words:
            if word not in known:
                known[word] = count(word)
        return np.fromiter((known[w] for w in words), np.int64, len(words))


@lru_cache(maxsize=1)
def shared_counter(path: str) -> Counter:
    """The counter of this worker process."""
    return Counter(path)


def count_tokens(docs: DataFrame, *, vocabulary_path: str | None = None) -> DataFrame:
    """``docs(doc_id, text)``: ``doc_id, n_words, n_tokens, n_unknown``; an unknown word counts as one token."""
    path = vocabulary_path or tokenizer_path(VOCABULARY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = shared_counter(path)
        for batch in batches:
            for part in slices(batch):
                codes, bounds, words = word_codes(text_column(part))
                pieces = counter.counts(words.to_numpy(zero_copy_only=False).tolist())
                tokens = np.concatenate([[0], np.cumsum(np.maximum(pieces, 1)[codes])])[bounds]
                unknown = np.concatenate([[0], np.cumsum((pieces == 0)[codes])])[bounds]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(np.diff(bounds)), pa.array(np.diff(tokens)), pa.array(np.diff(unknown))],
                    names=["doc_id", "n_words", "n_tokens", "n_unknown"],
                )

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, "doc_id long, n_words long, n_tokens long, n_unknown long")
