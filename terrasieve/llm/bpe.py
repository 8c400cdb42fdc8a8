"""Byte-level BPE: a minimal perfect hash for whole pre-tokens, a heap over linked bytes for the rest."""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import small_batches, unused

MEMO = 400_000  # entries in a generation of a worker's memo of runs; a quarter of that for words
MEMO_CHARS = 48  # longer runs are not remembered


class PerfectHash:
    """A minimal perfect hash of `keys` by hash and displace: n keys fill n slots, so a lookup is one probe and one compare.

    Groups of several keys seek a seed that sends them to free slots; a group of one key takes a free slot by number.
    """

    def __init__(self, keys: list[bytes]):
        n = self.n = len(keys)
        groups: list[list[bytes]] = [[] for _ in range(max(1, n // 3))]
        for key in keys:
            groups[xxhash.xxh3_64_intdigest(key) % len(groups)].append(key)
        self.seeds = [0] * len(groups)  # from 0: a seed; below 0: the one key's slot, as -1 - slot
        self.slots: list[bytes | None] = [None] * n
        order = sorted(range(len(groups)), key=lambda g: -len(groups[g]))
        for g in (g for g in order if len(groups[g]) > 1):
            seed = 0
            while True:
                seed += 1
                at = {xxhash.xxh3_64_intdigest(key, seed) % n: key for key in groups[g]}
                if len(at) == len(groups[g]) and all(self.slots[i] is None for i in at):
                    break
            for i, key in at.items():
                self.slots[i] = key
            self.seeds[g] = seed
        free = (i for i in range(n) if self.slots[i] is None)
        for g, i in zip((g for g in order if len(groups[g]) == 1), list(free)):
            self.slots[i], self.seeds[g] = groups[g][0], -1 - i

    def slot(self, key: bytes) -> int:
        """The key's slot, or -1 if it is none of the keys."""
        if not self.n:
            return -1
        seed = self.seeds[xxhash.xxh3_64_intdigest(key) % len(self.seeds)]
        i = xxhash.xxh3_64_intdigest(key, seed) % self.n if seed >= 0 else -1 - seed
        return i if self.slots[i] == key else -1


class Memo(dict):
    """What `make` gives for a key; two generations of `most` entries at most, so memory is bounded."""

    def __init__(self, make, most: int, longest: int = MEMO_CHARS):
        self.make, self.most, self.longest, self.old = make, most, longest, {}

    def __missing__(self, key: str) -> bytes:
        got = self.old.get(key)
        if got is None:
            got = self.make(key)
        if len(key) <= self.longest:
            if len(self) >= self.most:
                self.old = dict(self)
                self.clear()
            self[key] = got
        return got


#: What the pattern's \s means to tiktoken: Unicode's White_Space.
SPACES = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_BESIDE_SPACE = re.compile(f" [{SPACES}]|[{SPACES}] ")


def read_ranks(ranks_file: bytes) -> dict[int, bytes]:
    """Rank -> piece of a vocabulary file with a base64 piece and its rank on each line."""
    lines = (line.split() for line in ranks_file.splitlines() if line.strip())
    return {int(rank): base64.b64decode(piece) for piece, rank in lines}


class Codec:
    def __init__(self, ranks_file: bytes, pattern: str, memo: int = MEMO):
        self.pieces = read_ranks(ranks_file)
        self.names = {rank: str(rank) for rank in self.pieces}
        self.whole = PerfectHash(list(self.pieces.values()))
        rank_of = {piece: rank for rank, piece in self.pieces.items()}
        self.ranks = [rank_of[piece] for piece in self.whole.slots]
        self.bytes = [rank_of.get(bytes([b]), -1) for b in range(256)]
        self.pairs = {}  # two neighbours' ranks in one number -> the rank of both together
        for piece, rank in rank_of.items():
            for cut in range(1, len(piece)):
                left, right = rank_of.get(piece[:cut]), rank_of.get(piece[cut:])
                if left is not None and right is not None:
                    self.pairs[left << 32 | right] = rank
        spaced = pattern.replace(r"[^\s", f"[^{SPACES}").replace(r"\S", f"[^{SPACES}]").replace(r"\s", f"[{SPACES}]")
        self.split = regex.compile(spaced).findall
        self.by_word = pattern.startswith("'s|'t|'re|'ve|'m|'ll|'d| ?")  # then a match holds a space as its first character only
        self.words, self.runs = Memo(self._word, memo // 4), Memo(self._run, memo // 40)
        self.later = Memo(lambda run: self._run(" " + run), memo)

    def merge(self, piece: bytes) -> list[int]:
        """Ids of a pre-token that is no token itself: lowest rank first, leftmost on ties, from a heap over linked parts."""
        n, pairs = len(piece), self.pairs
        part = [self.bytes[b] for b in piece]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [r << 32 | i for i, (x, y) in enumerate(zip(part, part[1:])) if (r := pairs.get(x << 32 | y)) is not None]
        heapq.heapify(heap)
        while heap:
            low = heapq.heappop(heap)
            rank, i = low >> 32, low & 0xFFFFFFFF
            j = after[i]
            if j >= n or part[i] < 0 or pairs.get(part[i] << 32 | part[j]) != rank:
                continue  # one of the two has been merged with another since
            part[i], part[j] = rank, -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (r := pairs.get(rank << 32 | part[k])) is not None:
                    heapq.heappush(heap, r << 32 | i)
            if (h := before[i]) >= 0 and (r := pairs.get(part[h] << 32 | rank)) is not None:
                heapq.heappush(heap, r << 32 | h)
        return [r for r in part if r >= 0]

    def _word(self, word: str) -> bytes:
        piece = word.encode()
        i = self.whole.slot(piece)
        return array("I", (self.ranks[i],) if i >= 0 else self.merge(piece)).tobytes()

    def _run(self, run: str) -> bytes:
        return b"".join(map(self.words.__getitem__, self.split(run)))

    def encode(self, text: str) -> np.ndarray:
        """Token ids. Where no space has white space beside it, what lies between spaces is looked up at once."""
        if not self.by_word or _BESIDE_SPACE.search(text):
            packed = self._run(text)
        else:
            first, *rest = text.split(" ")
            packed = self.runs[first] + b"".join(map(self.later.__getitem__, rest))
        return np.frombuffer(packed, np.uint32)

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.pieces.__getitem__, ids))


_CODECS: dict[tuple[bytes, str, int], Codec] = {}  # one for each Python worker


def codec(ranks_file: bytes, pattern: str, memo: int = MEMO) -> Codec:
    key = (hashlib.sha256(ranks_file).digest(), pattern, memo)
    if key not in _CODECS:
        _CODECS[key] = Codec(ranks_file, pattern, memo)
    return _CODECS[key]


def default_vocabulary() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def _shared(spark: SparkSession, path: str | None, pattern: str | None):
    small_batches(spark)
    own_path, own_pattern = default_vocabulary() if path is None or pattern is None else ("", "")
    with open(path or own_path, "rb") as f:  # a vocabulary file lies beside the driver and is below 1 MB
        return spark.sparkContext.broadcast(f.read()), pattern or own_pattern


def encode(docs: DataFrame, text_col: str = "text", out: str = "ids", path: str | None = None, pattern: str | None = None) -> DataFrame:
    """`docs` with the array `out` of token ids of each whole text. Null and empty texts have no ids."""
    shared, pattern = _shared(docs.sparkSession, path, pattern)

    @F.pandas_udf("array<int>")
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = codec(shared.value, pattern)
        for texts in batches:
            yield pd.Series([own.encode(t or "").astype(np.int32) for t in texts], dtype=object)

    return docs.withColumn(out, ids(F.col(text_col)))


def decode(rows: DataFrame, ids_col: str = "ids", out: str = "decoded", path: str | None = None, pattern: str | None = None) -> DataFrame:
    """`rows` with the bytes `out` that the token ids stand for. Null ids give no bytes; an unknown id is an error."""
    shared, pattern = _shared(rows.sparkSession, path, pattern)

    @F.pandas_udf("binary")
    def back(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = codec(shared.value, pattern)
        for lists in batches:
            yield pd.Series([own.decode([] if x is None else x.tolist()) for x in lists], dtype=object)

    return rows.withColumn(out, back(F.col(ids_col)))


def encode_checked(docs: DataFrame, text_col: str = "text", path: str | None = None, pattern: str | None = None, memo: int = MEMO) -> DataFrame:
    """`docs` with n_tokens, ids and exact: whether decoding the ids gives the text's bytes again. Null texts have no ids.

    Columns of these names in `docs` are replaced; any other name is kept.

    `memo` bounds what a worker remembers: fewer entries cost time and change no result.
    """
    shared, pattern = _shared(docs.sparkSession, path, pattern)

    @F.pandas_udf("ids array<int>, exact boolean")
    def both(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = codec(shared.value, pattern, memo)
        for texts in batches:
            ids = [own.encode(t or "").astype(np.int32) for t in texts]
            exact = [own.decode(x.tolist()) == (t or "").encode() for x, t in zip(ids, texts)]
            yield pd.DataFrame({"ids": pd.Series(ids, dtype=object), "exact": pd.Series(exact, dtype=bool)})

    name = unused("__bpe", docs)
    done = docs.drop("n_tokens", "ids", "exact").withColumn(name, both(F.col(text_col)))
    return done.withColumns({"n_tokens": F.size(f"{name}.ids").cast("long"), "ids": F.col(f"{name}.ids"), "exact": F.col(f"{name}.exact")}).drop(name)


def round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, pattern: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) for every row: encodes the whole text, decodes the ids, and digests both.

    Ids and bytes stay inside the task, one document at a time, so a very long text needs memory for itself only. Null
    texts count as empty. Equal ranks cannot arise, and of equal pairs the leftmost merges first. Repeated rows and null
    doc_ids are kept as they are; an empty table gives an empty result; other columns are not read.
    """
    shared, pattern = _shared(docs.sparkSession, path, pattern)

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def digests(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = codec(shared.value, pattern)
        for texts in batches:
            rows = []
            for text in texts:
                ids = own.encode(text or "").tolist()
                named = " ".join(map(own.names.__getitem__, ids))
                rows.append((len(ids), hashlib.sha256(named.encode()).hexdigest(), hashlib.sha256(own.decode(ids)).hexdigest()))
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col(id_col).alias("doc_id"), digests(F.col(text_col)).alias("d")).select("doc_id", "d.*")
