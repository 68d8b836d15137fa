"""Token counts: greedy longest-match word pieces, counted by an automaton without building pieces.

The vocabulary's trie gets failure links. Where no child takes the next character, the pieces that greedy matching would cut off
(popped) are already known: their number is stored with the node, and its link leads to the node of what is left. So each character
is looked at once, and no text is looked at again.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame

from .base import map_texts, table

#: Begins the pieces that begin a word.
MARK = "▁"


class Automaton:
    """Of pieces: those that begin with ``MARK`` begin words, the others go on."""

    def __init__(self, pieces: list[str]):
        self.next: list[dict[str, int]] = [{}]
        is_piece = [False]
        for piece in sorted(set(pieces)):
            node = 0
            for c in piece:
                if c not in self.next[node]:
                    self.next[node][c] = len(self.next)
                    self.next.append({})
                    is_piece.append(False)
                node = self.next[node][c]
            is_piece[node] = bool(piece)
        self.link = [-1] * len(self.next)  # -1: what is here cannot be cut into pieces
        self.popped = [0] * len(self.next)
        level = [0]
        while level:
            below = []
            for parent in level:
                for c, node in self.next[parent].items():
                    below.append(node)
                    if is_piece[node]:
                        self.link[node], self.popped[node] = 0, 1
                        continue
                    count, at = self.popped[parent], self.link[parent]
                    while at >= 0 and c not in self.next[at]:
                        count += self.popped[at]
                        at = self.link[at]
                    if at >= 0:
                        self.link[node], self.popped[node] = self.next[at][c], count
            level = below

    def count(self, word: str) -> int:
        """Pieces of the word, by greedy longest match of ``MARK`` + word; 0 if it cannot be cut into pieces."""
        node, count = 0, 0
        nexts, link, popped = self.next, self.link, self.popped
        for c in MARK + word:
            while (to := nexts[node].get(c)) is None:
                if link[node] < 0:
                    return 0
                count += popped[node]
                node = link[node]
            node = to
        while node:
            if link[node] < 0:
                return 0
            count += popped[node]
            node = link[node]
        return count


@lru_cache(2)
def automaton(model_file: str) -> Automaton:
    """Of a sentencepiece model's ordinary pieces."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=model_file)
    every = range(model.get_piece_size())
    return Automaton([model.id_to_piece(i) for i in every if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))])


class _Counts(dict):
    """Words to their pieces; forgets all when it grows large. Very long words are not kept."""

    def __init__(self, of: Automaton, most: int = 300_000):
        self.of, self.most = of, most

    def __missing__(self, word: str) -> int:
        n = self.of.count(word)
        if len(word) <= 64:
            if len(self) >= self.most:
                self.clear()
            self[word] = n
        return n


def count_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model_file: str | None = None) -> DataFrame:
    """doc_id, n_words, n_pieces, n_unknown for each row's whole text.

    Words are split at Unicode white space. A word that greedy matching cannot cut into pieces is one unknown piece, and counts in
    n_pieces too. Null and empty texts have none. No shuffle; the vocabulary is read from ``model_file`` in each task.
    """
    import public_tokenizers

    model_file = model_file or public_tokenizers.path("piece_bpe_32k.model")
    kept: list[_Counts] = []

    def run(_, texts):
        kept or kept.append(_Counts(automaton(model_file)))
        words, pieces, unknown = [], [], []
        for text in texts:
            own = text.split() if text else []
            counts = np.fromiter(map(kept[0].__getitem__, own), np.int64, len(own))
            lost = int((counts == 0).sum())
            words.append(len(own))
            pieces.append(int(counts.sum()) + lost)
            unknown.append(lost)
        return {"n_words": words, "n_pieces": pieces, "n_unknown": unknown}

    return map_texts(docs, run, "n_words long, n_pieces long, n_unknown long", id_col, text_col, binary=False)


def op8_token_counts(spark, sf_dir) -> DataFrame:
    """Word pieces of all ``documents``."""
    return count_pieces(table(spark, sf_dir, "documents"))
