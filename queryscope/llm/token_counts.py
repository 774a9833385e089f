"""Token counts under a unigram vocabulary, by dynamic programming shared in a trie.

The count of a text is the number of pieces in its best segmentation (the
largest sum of piece scores; on equal sums the longest last piece).  Pieces
and scores are those of a sentencepiece model file; a character without a
piece costs the smallest score less 10 and counts as its UTF-8 bytes, as
the library does for a unigram model with byte pieces.

Method.  A text falls into pre-tokens at cuts that no piece spans, and its
count is the sum of theirs.  The distinct pre-tokens of a batch that are
not yet known form a trie; it is walked in sorted order with the current
branch on a stack, so the forward score of a shared prefix is computed
once.  The count at each terminal node is kept and looked up for every
occurrence.  Sums over a document need no shuffle.

Cases: null text counts as empty; an empty text has 0 tokens; texts are
counted whole; repeated rows give repeated results; input columns called
``n_tokens`` or ``n_pretokens`` are replaced.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame

from queryscope.llm.common import append_columns, documents, text_or_empty, tokenizer_file
from queryscope.llm.piece_bpe import SPACE, Pieces

UNKNOWN_PENALTY = 10.0
KEPT = 400_000  # terminal counts kept per worker; refilled when full


class TrieCounts(dict):
    """pre-token -> tokens in its best segmentation."""

    def __init__(self, pieces: Pieces):
        self.split = pieces.chunks
        self.score = pieces.score
        self.unknown = min(pieces.score.values()) - UNKNOWN_PENALTY
        self.ends: dict = {}  # pieces read from their last character back; "" holds the score
        for p, v in pieces.score.items():
            node = self.ends
            for c in reversed(p):
                node = node.setdefault(c, {})
            node[""] = v

    def learn(self, words: set[str]) -> None:
        """Walk the trie of ``words`` and keep their terminal counts."""
        best, count = [0.0], [0]  # forward scores and token counts along the current branch
        before = ""
        for w in sorted(words):
            k, most = 0, min(len(before), len(w))
            while k < most and before[k] == w[k]:
                k += 1
            del best[k + 1:], count[k + 1:]
            for d in range(k, len(w)):
                top, tokens = float("-inf"), 0
                node, j = self.ends, d
                if w[d] not in self.score:
                    top, tokens = best[d] + self.unknown, count[d] + len(w[d].encode())
                while j >= 0:
                    node = node.get(w[j])
                    if node is None:
                        break
                    v = node.get("")
                    if v is not None and best[j] + v >= top:
                        top, tokens = best[j] + v, count[j] + 1
                    j -= 1
                best.append(top)
                count.append(tokens)
            self[w] = count[-1]
            before = w

    def counts(self, texts: list[str]) -> tuple[list[int], list[int]]:
        split = [self.split(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
        words = set().union(*split)
        new = words.difference(self)
        if len(self) + len(new) > KEPT:
            self.clear()
            new = words
        self.learn(new)
        return [sum(map(self.__getitem__, ws)) for ws in split], [len(ws) for ws in split]


def token_counts(df: DataFrame, model: str, text: str = "text") -> DataFrame:
    """``df`` with ``n_tokens`` and ``n_pretokens`` of its text column."""
    def make():
        trie = TrieCounts(Pieces(model))

        def run(texts):
            n, words = trie.counts(texts)
            return [pa.array(n, pa.int64()), pa.array(words, pa.int64())]
        return run

    return append_columns(df, text, "n_tokens long, n_pretokens long", make, max_bytes=2 << 20)


def op9(spark, sf_dir: str, model: str | None = None) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", text_or_empty().alias("text"))
    return token_counts(docs, model or tokenizer_file("piece_bpe_32k.model")).select("doc_id", "n_tokens", "n_pretokens")
