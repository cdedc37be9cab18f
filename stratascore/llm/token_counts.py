"""Token counts under a unigram piece vocabulary, by dynamic programming over a trie of pre-tokens.

Every distinct pre-token (a word, with the vocabulary's word mark in front) goes into a trie. The best
score of segmenting a prefix depends on the prefix alone, so it is computed once at its trie node and
shared by all pre-tokens that begin with it; where one ends, its number of pieces is stored. A document
then costs one look-up per word. Each task has its own trie, which starts anew above ``NODES`` nodes, so
memory is bounded and nothing is shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
NODES = 400_000
LONGEST_STORED = 256
MOST_PIECES = 1 << 20


def load_pieces(path: str = MODEL) -> dict[str, float]:
    """Pieces with log-probabilities. The file orders its pieces without probabilities, so Zipf's law gives them by rank."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    if model.get_piece_size() > MOST_PIECES:
        raise ValueError(f"more than {MOST_PIECES} pieces")
    plain = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    plain.sort(key=lambda i: (-model.get_score(i), i))
    total = math.log(sum(1 / r for r in range(1, len(plain) + 1)))
    return {model.id_to_piece(i): -math.log(rank) - total for rank, i in enumerate(plain, 1)}


class PieceTrie:
    """Forward scores per prefix. A character outside all pieces becomes its UTF-8 bytes, one token each."""

    def __init__(self, pieces: dict[str, float], nodes: int = NODES):
        self.nodes = nodes
        self.tails: dict[str, float] = {}  # every ending of a piece, with the score of those that are pieces themselves
        for piece in pieces:
            for start in range(len(piece) - 1, 0, -1):
                self.tails.setdefault(piece[start:], -math.inf)
        self.tails |= pieces
        self.byte = min(pieces.values(), default=0.0) - 10.0
        self.clear()

    def clear(self) -> None:
        self.children: dict[tuple[int, str], int] = {}
        self.score, self.tokens = [0.0], [0]
        self.counts: dict[bytes, int] = {}

    def _forward(self, text: str, end: int, score: list[float], tokens: list[int], path: list[int]) -> tuple[float, int]:
        """Best score of ``text[:end]`` and its tokens (fewer tokens win a tie), from the prefixes before it, nearest first."""
        best, least = -math.inf, 0
        tail = self.tails.get
        for start in range(end - 1, -1, -1):
            own = tail(text[start:end])
            if own is None:
                break  # no piece ends like this, so none begins further left
            at = path[start]
            found, n = score[at] + own, tokens[at] + 1
            if found > best or (found == best and n < least and found > -math.inf):
                best, least = found, n
        if best == -math.inf:
            spread, at = len(text[end - 1].encode("utf-8", "replace")), path[end - 1]
            best, least = score[at] + spread * self.byte, tokens[at] + spread
        return best, least

    def count(self, word: bytes) -> int:
        """Tokens of one pre-token."""
        text = MARK + word.decode("utf-8", "replace")
        if len(text) > LONGEST_STORED:  # a row of scores instead of nodes: junk that no other word shares
            score, tokens, path = [0.0], [0], list(range(len(text) + 1))
            for end in range(1, len(text) + 1):
                best, n = self._forward(text, end, score, tokens, path)
                score.append(best)
                tokens.append(n)
            return tokens[-1]
        if len(self.score) > self.nodes:
            self.clear()
        path, node = [0], 0
        for end, ch in enumerate(text, 1):
            child = self.children.get((node, ch))
            if child is None:
                best, n = self._forward(text, end, self.score, self.tokens, path)
                child = self.children[node, ch] = len(self.score)
                self.score.append(best)
                self.tokens.append(n)
            path.append(child)
            node = child
        self.counts[word] = self.tokens[node]
        return self.tokens[node]

    def document(self, text: str | None) -> tuple[int, int]:
        """Pre-tokens and tokens of a whole text."""
        words = [] if text is None else text.encode("utf-8", "replace").split()
        known = self.counts
        try:
            return len(words), sum(map(known.__getitem__, words))
        except KeyError:
            own = {w: known[w] if w in known else -1 for w in set(words)}
            for w in sorted(w for w, n in own.items() if n < 0):
                own[w] = self.count(w)
            return len(words), sum(map(own.__getitem__, words))


def count_tokens(docs: DataFrame, pieces: dict[str, float], text: str = "text", key: str = "doc_id") -> DataFrame:
    """``doc_id, n_pretokens, n_tokens`` of every row, over the whole text.

    Pre-tokens are the stretches between the six ASCII blanks; case is kept. Null and blank texts have 0
    of both; repeated rows are rows; other columns are not read; an empty table gives an empty result.
    The vocabulary is broadcast and at most ``MOST_PIECES`` pieces.
    """
    shared = docs.sparkSession.sparkContext.broadcast(pieces)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trie = PieceTrie(shared.value)
        for frame in frames:
            found = [trie.document(t) for t in frame["text"]]
            yield pd.DataFrame({"doc_id": frame["doc_id"], "n_pretokens": [n for n, _ in found], "n_tokens": [n for _, n in found]})

    rows = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInPandas(run, "doc_id bigint, n_pretokens bigint, n_tokens bigint")
