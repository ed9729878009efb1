"""Token counts by a unigram model over a trie of pre-tokens (free style: Arrow batches).

A text is cut into pre-tokens by the vocabulary's pattern. Every distinct pre-token is put into
a trie; the forward recursion of the unigram model (best score of any segmentation of a prefix)
is a property of a trie node, so it is computed once for the pre-tokens of a slice of 500 texts that
share the prefix; later slices compute it anew for new pre-tokens.
The node a pre-token ends in stores its number of tokens.

Sorting the new pre-tokens makes the walk over the trie a stack: the nodes of the common prefix
with the preceding pre-token stay, the rest is computed anew. Nothing but the stack and the
terminal counts is kept. The table of terminal counts lives in one Python worker and is emptied
when it exceeds ``max_terminals``; that costs time, never results.

The score of a piece is its Zipf log-probability by rank in the public vocabulary, as the
vocabulary is given and tokenizers are not trained. Among segmentations of equal score the one
with fewer tokens counts.

Results: null or empty text: 0 tokens. Repeated rows are counted each. Other columns of the
input are ignored. No shuffle; memory is bounded by a batch, the terminals and one pre-token.
"""

from __future__ import annotations

import base64
import functools
import math
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

MAX_TERMINALS = 400_000
SCHEMA = "doc_id bigint, n_pretokens bigint, n_tokens bigint"


def load_scores(vocabulary: str) -> dict[bytes, float]:
    """Piece → log-probability; every line of the file is a base64 piece and its rank."""
    with open(vocabulary, "rb") as lines:
        ranks = {base64.b64decode(p): int(r) for p, r in (line.split() for line in lines if line.strip())}
    total = sum(1.0 / (r + 1) for r in ranks.values())
    return {piece: -math.log((rank + 1) * total) for piece, rank in ranks.items()}


class TrieCounter:
    """Number of tokens of pre-tokens, sharing the recursion over common prefixes."""

    def __init__(self, scores: dict[bytes, float], max_terminals: int = MAX_TERMINALS):
        self.scores = scores
        self.longest = max(map(len, scores))
        self.max_terminals = max_terminals
        self.terminals: dict[str, int] = {}
        self.nodes = 0

    def add(self, pretokens: set[str]) -> None:
        """Insert the pre-tokens that have no terminal yet."""
        new = sorted((p.encode(), p) for p in pretokens if p not in self.terminals)
        if len(self.terminals) + len(new) > self.max_terminals:
            self.terminals = {}
            new = sorted((p.encode(), p) for p in pretokens)
        scores, longest = self.scores, self.longest
        # best[i], count[i]: of the first i bytes on the path from the root.
        best, count = [0.0], [0]
        before = b""
        for word, pretoken in new:
            shared = 0
            for a, b in zip(before, word):
                if a != b:
                    break
                shared += 1
            del best[shared + 1 :], count[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                top, fewest = -math.inf, 0
                for start in range(max(0, end - longest), end):
                    score = scores.get(word[start:end])
                    if score is not None:
                        score += best[start]
                        if score > top or (score == top and count[start] < fewest):
                            top, fewest = score, count[start]
                best.append(top)
                count.append(fewest + 1)
            self.nodes += len(word) - shared
            self.terminals[pretoken] = count[-1]
            before = word


@functools.cache
def _counter(vocabulary: str, max_terminals: int) -> TrieCounter:
    return TrieCounter(load_scores(vocabulary), max_terminals)


def token_counts(
    docs: DataFrame, vocabulary: str, pattern: str, max_terminals: int = MAX_TERMINALS
) -> DataFrame:
    """``doc_id``, ``n_pretokens`` and ``n_tokens`` of every row.

    ``vocabulary`` is a rank file that every executor can open and must hold all 256 single
    bytes; ``pattern`` is its pre-token pattern.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(vocabulary, max_terminals)
        find = regex.compile(pattern).findall
        for batch in batches:
            ids = batch.column("doc_id")
            texts = batch.column("text").to_pylist()
            for first in range(0, len(texts), 500):
                counts = [Counter(find(t)) if t else {} for t in texts[first : first + 500]]
                counter.add(set().union(*counts))
                terminals = counter.terminals
                yield pa.record_batch(
                    [
                        ids.slice(first, len(counts)),
                        pa.array([sum(c.values()) for c in counts], pa.int64()),
                        pa.array([sum(n * terminals[p] for p, n in c.items()) for c in counts], pa.int64()),
                    ],
                    names=["doc_id", "n_pretokens", "n_tokens"],
                )

    return docs.selectExpr("cast(doc_id as bigint) doc_id", "cast(text as string) text").mapInArrow(work, SCHEMA)
