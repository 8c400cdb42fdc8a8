"""Greedy word-piece token counts by a linear longest-match automaton."""

from __future__ import annotations

import hashlib
from collections import Counter, deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .bpe import default_vocabulary, read_ranks
from .common import small_batches

MEMO, MEMO_CHARS = 300_000, 48  # words whose counts a worker remembers, then it starts anew; longer words are not remembered


class Matcher:
    """Longest-match-first lengths in one pass over a word's bytes.

    A node of the vocabulary's trie stands for the bytes read since the last piece was cut. Where the next byte has no
    child, the failure link leads to the node for what is left once the longest pieces are cut off, and `pops` says how
    many pieces that cuts. Pieces are never built. A byte that no piece can begin makes the word unknown: one token.
    """

    def __init__(self, pieces: list[bytes]):
        self.next: list[dict[int, int]] = [{}]
        final = [False]
        for piece in pieces:
            at = 0
            for byte in piece:
                to = self.next[at].get(byte)
                if to is None:
                    to = self.next[at][byte] = len(self.next)
                    self.next.append({})
                    final.append(False)
                at = to
            final[at] = True
        final[0] = False
        self.fail, self.pops = [-1] * len(self.next), [0] * len(self.next)
        queue = deque([0])
        while queue:  # breadth first: a link leads to a shallower node
            node = queue.popleft()
            for byte, child in self.next[node].items():
                queue.append(child)
                if final[child]:
                    self.fail[child], self.pops[child] = 0, 1
                    continue
                back, popped = self.fail[node], self.pops[node]
                while back >= 0 and byte not in self.next[back]:
                    popped += self.pops[back]
                    back = self.fail[back]
                if back >= 0:
                    self.fail[child], self.pops[child] = self.next[back][byte], popped

    def count(self, word: bytes) -> int:
        """Greedy pieces of the word; 1 (the unknown token) if it cannot be cut into pieces; 0 for no bytes."""
        nexts, fail, pops = self.next, self.fail, self.pops
        node = total = 0
        for byte in word:
            while (to := nexts[node].get(byte)) is None:
                total += pops[node]
                node = fail[node]
                if node < 0:
                    return 1
            node = to
        while node > 0:
            total += pops[node]
            node = fail[node]
        return total if node == 0 else 1


_MATCHERS: dict[bytes, tuple[Matcher, dict[str, int]]] = {}  # one for each Python worker


def matcher(ranks_file: bytes) -> tuple[Matcher, dict[str, int]]:
    key = hashlib.sha256(ranks_file).digest()
    if key not in _MATCHERS:
        _MATCHERS[key] = Matcher(list(read_ranks(ranks_file).values())), {}
    return _MATCHERS[key]


def count_text(own: Matcher, memo: dict[str, int], text: str) -> tuple[int, int]:
    """(words, tokens): words lie between white space; each is matched with a space before it, as the vocabulary marks word starts."""
    words = text.split()
    tokens = 0
    for word, times in Counter(words).items():
        n = memo.get(word)
        if n is None:
            n = own.count(b" " + word.encode())
            if len(word) <= MEMO_CHARS:
                if len(memo) >= MEMO:
                    memo.clear()
                memo[word] = n
        tokens += n * times
    return len(words), tokens


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """(doc_id, n_bytes, n_words, n_tokens) for every row, over its whole text.

    Null and empty texts count as no words; very long texts and words are gone through in one pass. Repeated rows and null
    doc_ids are kept; an empty table gives an empty result; other columns are not read. Ties cannot arise. One
    narrow pass without a shuffle; the automaton is built once a worker from the broadcast vocabulary (below 1 MB).
    """
    small_batches(docs.sparkSession)
    with open(path or default_vocabulary()[0], "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())

    @F.pandas_udf("n_words long, n_tokens long")
    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own, memo = matcher(shared.value)
        for texts in batches:
            rows = np.array([count_text(own, memo, t or "") for t in texts], np.int64).reshape(-1, 2)
            yield pd.DataFrame({"n_words": rows[:, 0], "n_tokens": rows[:, 1]})

    size = F.octet_length(F.coalesce(F.col(text_col), F.lit(""))).cast("long")
    return docs.select(F.col(id_col).alias("doc_id"), size.alias("n_bytes"), counted(F.col(text_col)).alias("c")).select("doc_id", "n_bytes", "c.*")
