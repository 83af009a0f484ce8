"""Token counts of whole texts under a unigram model, with scores shared along a trie.

A pre-token is a run without ASCII white space, with the word mark of the vocabulary
in front.  Its count is the number of pieces of its best segmentation.  Distinct
pre-tokens are inserted in a trie; a node's forward score is computed when the node is
made, from the scores of the nodes above it, so pre-tokens that begin alike share the
work; the counts are stored where pre-tokens end.  Counting needs no shuffle, and each
process keeps a trie of bounded size.

The vocabulary files state an order of pieces and no probabilities, and tokenizers are
not trained here, so piece number r gets the log probability of Zipf's law, -log(r + 1)
up to a constant, in whole millionths, which makes sums exact.  A character
outside the vocabulary is spelled in bytes, one token each.  Of equally good
segmentations the one with fewer pieces counts.

Defined cases: a null or empty text has 0 pre-tokens and 0 tokens; pre-tokens of any
length are segmented whole; repeated rows are counted one by one; an empty table gives
an empty result; further columns are ignored.
"""

from __future__ import annotations

from math import log

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship

MARK = "▁"
#: nodes of a process's trie and longest pre-token that is kept in it
NODES = 250_000
KEPT_CHARS = 64
REMEMBERED = 400_000


def zipf_scores(pieces: list[str]) -> dict[str, int]:
    """Score of each piece in millionths, by its place in the list."""
    constant = log(len(pieces) + 1)
    return {piece: -round(1e6 * (log(rank + 1) + constant)) for rank, piece in enumerate(pieces)}


def sentencepiece_pieces(path: str) -> list[str]:
    """The ordinary pieces of a sentencepiece file, in its order."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    skip = (model.IsControl, model.IsUnknown, model.IsByte, model.IsUnused)
    return [model.IdToPiece(i) for i in range(model.GetPieceSize()) if not any(f(i) for f in skip)]


def utf8_bytes(c: str) -> int:
    """Bytes of a character."""
    return 1 if c < "\x80" else 2 if c < "\u0800" else 3 if c < "\U00010000" else 4


#: a segmentation is told by one number, its score times this less its tokens: the larger is the better
TOKENS = 1 << 32
CHARS = 0x110000


class TrieCounter(dict):
    """Pre-token (UTF-8, without mark) -> number of tokens."""

    def __init__(self, scores: dict[str, int], nodes: int = NODES):
        super().__init__()
        self.nodes = nodes
        self.byte = (min(scores.values(), default=0) - 1_000_000) * TOKENS - 1
        #: number of every end of a piece (None: no piece itself); a string that ends no piece is not in it
        self.ends: dict[str, int | None] = dict.fromkeys(piece[at:] for piece in scores for at in range(1, len(piece)))
        self.ends.update({piece: score * TOKENS - 1 for piece, score in scores.items()})
        self.reset()

    def reset(self) -> None:
        #: node times CHARS plus a character -> the node below; numbers only, which the collector need not visit
        self.below: dict[int, int] = {}
        #: the best segmentation up to the node
        self.best: list[int] = [0]

    def forward(self, word: str, above: list[int]) -> None:
        """Best segmentations of the word's beginnings, appended to those of the shorter ones; ``above[i]``: of the first i characters."""
        end_of, byte = self.ends.get, self.byte
        for end in range(len(above), len(word) + 1):
            c = word[end - 1]
            best = above[end - 1] + (byte if c < "\x80" else utf8_bytes(c) * byte)
            for start in range(end - 1, -1, -1):
                own = end_of(word[start:end], 0)
                if own:
                    own += above[start]
                    if own > best:
                        best = own
                elif own == 0:
                    # what ends no piece is the end of no longer string that does
                    break
            above.append(best)

    def insert(self, word: str) -> int:
        """Tokens of a word; makes the nodes that its prefixes lack."""
        below, best, node, above = self.below, self.best, 0, [self.best[0]]
        for c in map(ord, word):
            under = below.get(node * CHARS + c)
            if under is None:
                break
            node = under
            above.append(best[node])
        known, new = len(above), len(best)
        self.forward(word, above)
        for c in map(ord, word[known - 1 :]):
            below[node * CHARS + c] = node = new
            new += 1
        best += above[known:]
        return -above[-1] % TOKENS

    def tokens(self, word: str) -> int:
        """Tokens of a word that is too long to keep."""
        above = [0]
        self.forward(word, above)
        return -above[-1] % TOKENS

    def __missing__(self, chunk: bytes) -> int:
        word = MARK + chunk.decode("utf-8", "replace")
        if len(word) > KEPT_CHARS:
            return self.tokens(word)
        count = self.insert(word)
        self[chunk] = count
        return count

    def count(self, text: bytes | None) -> tuple[int, int]:
        """(pre-tokens, tokens) of a text."""
        if len(self.best) > self.nodes:
            self.reset()
        if len(self) > REMEMBERED:
            self.clear()
        chunks = (text or b"").split()
        return len(chunks), sum(map(self.__getitem__, chunks))


_counters: dict[str, TrieCounter] = {}


def counter(path: str) -> TrieCounter:
    """The counter of this process for a vocabulary file."""
    if path not in _counters:
        _counters[path] = TrieCounter(zipf_scores(sentencepiece_pieces(path)))
    return _counters[path]


def count_tokens(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_pretokens, n_tokens) per document."""
    ship(docs.sparkSession)

    @F.pandas_udf("n_pretokens long, n_tokens long")
    def counts(texts: pd.Series) -> pd.DataFrame:
        own = counter(vocabulary)
        return pd.DataFrame([own.count(t) for t in texts], columns=["n_pretokens", "n_tokens"], dtype="int64")

    rows = docs.select(F.col(id_col).alias("doc_id"), counts(F.col(text_col).cast("binary")).alias("n"))
    return rows.select("doc_id", "n.n_pretokens", "n.n_tokens")
