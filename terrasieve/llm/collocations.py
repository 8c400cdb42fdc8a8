"""Phrases whose words stand together more often than their parts would: Rabin-Karp fingerprints of every word n-gram.

Texts become packs of one language. A pack's n-grams are hashed by prefix polynomials and counted; fingerprints with their
counts and a pointer to an occurrence are shuffled and summed; only pointers of frequent fingerprints go back to their
packs, where the phrases are read from the text. Counts are then summed by phrase, so a collision never joins two phrases.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F, Window

from .common import small_batches, stored

PACK_BYTES = 8 << 20  # of text that is counted at a time; a longer text is cut between words
CHUNK = 1 << 19  # bytes of a prefix polynomial
SPANS = 1 << 15  # whose bytes are compared at a time
BITS = 48  # of a fingerprint: what collides is told apart by its text
BUCKET_ENTRIES, LEAST_BUCKETS = 1 << 20, 64  # fingerprints a task gets at a time, about, and the fewest such tasks
SALTS = 64  # parts of a language that are ranked before the language is
LONGEST = 3  # words of a phrase
BASE = 0x9E3779B97F4A7C15  # of the polynomials; odd, so it has an inverse modulo 2**64

OTHER, BLANK, BREAK = 0, 1, 2  # kinds of bytes
KIND = np.zeros(256, np.uint8)
KIND[[0x20, 0x09]] = BLANK
KIND[list(b".,;:!?\n\x0b\x0c\r")] = BREAK
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


@cache
def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i < n."""
    out = []
    for base in (BASE, pow(BASE, -1, 1 << 64)):
        steps = np.full(n, base, np.uint64)
        steps[0] = 1
        out.append(np.cumprod(steps))
    return out[0], out[1]


def mix(h: np.ndarray) -> None:
    """Spreads bits over each word, in place: the high ones choose buckets."""
    for shift, factor in ((32, 0xD6E8FEB86659FD93), (29, 0xBF58476D1CE4E5B9)):
        h ^= h >> np.uint64(shift)
        h *= np.uint64(factor)


def tidy(raw: bytes) -> np.ndarray:
    """The words in lower case, each with one blank or, at the end of a piece, one line end after it."""
    a = LOWER[np.frombuffer(raw, np.uint8)]
    kind = KIND[a]
    inside = np.concatenate([[False], kind == OTHER, [False]])
    starts, ends = np.flatnonzero(~inside[:-1] & inside[1:]), np.flatnonzero(inside[:-1] & ~inside[1:])
    piece = np.cumsum(kind == BREAK, dtype=np.int32)[starts] if len(starts) else starts
    keep = inside[1:-1].copy()
    after = ends[ends < len(a)]
    keep[after] = True  # one separator after each word; the last may lack one
    text = a.copy()
    last = np.append(piece[1:] != piece[:-1], True) if len(piece) else np.zeros(0, bool)
    text[after] = np.where(last[: len(after)], 10, 32)
    text = text[keep]
    return np.append(text, np.uint8(10)) if len(ends) > len(after) else text


def gather(text: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The bytes of all these spans, one after the other."""
    at = np.repeat(starts - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) + np.arange(int(lengths.sum()))
    return text[at]


def differ(text: np.ndarray, s1: np.ndarray, s2: np.ndarray, n1: np.ndarray, n2: np.ndarray) -> np.ndarray:
    """Whether the bytes of two spans differ, span by span."""
    out = n1 != n2
    every = np.flatnonzero(~out & (s1 != s2))
    for k in range(0, len(every), SPANS):
        same = every[k : k + SPANS]
        n = n1[same]
        wrong = gather(text, s1[same], n) != gather(text, s2[same], n)
        out[same[np.repeat(np.arange(len(same)), n)[wrong]]] = True
    return out


def hashes(text: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> Iterator[np.ndarray]:
    """For n of 1 to LONGEST: the hash of the n words from each word on, with the blanks between them.

    The prefix polynomial is kept for CHUNK bytes at a time; hashes do not depend on where a chunk begins.
    """
    out = [np.zeros(len(starts), np.uint64) for _ in range(LONGEST)]
    at = 0
    while at < len(starts):
        stop = max(at + 1, int(np.searchsorted(ends, starts[at] + CHUNK, "right")))
        far = min(stop + LONGEST - 1, len(starts))
        origin = starts[at]
        part = text[origin : ends[far - 1]]
        power, inverse = powers(1 << max(20, len(part).bit_length()))
        prefix = np.zeros(len(part) + 1, np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * power[: len(part)], out=prefix[1:])
        for n, h in enumerate(out, 1):
            own = np.arange(at, min(stop, far - n + 1))
            begin = starts[own] - origin
            h[own] = (prefix[ends[own + n - 1] - origin] - prefix[begin]) * inverse[begin]
        at = stop
    while out:
        yield out.pop(0)


def count_grams(text: np.ndarray, starts: np.ndarray, ends: np.ndarray, piece: np.ndarray, own: int, seed: int, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(fingerprints, counts, pointers), sorted, of the n-grams that start at the first `own` words.

    A pointer is the number of an occurrence's first word times four, plus its number of words. Occurrences that share a
    fingerprint of so many bits are compared with the first: words by their bytes, longer ones word by word. Where that
    fails, each text has an entry of its own.
    """
    word = np.zeros(len(starts), np.int32)
    found = []
    for n, every in enumerate(hashes(text, starts, ends), 1):  # one array is dropped before the next is used
        first = np.arange(max(0, len(starts) - n + 1), dtype=np.int32)
        first = first[piece[first] == piece[first + n - 1]]
        if n > 1:  # words past the own ones are compared too, but n-grams there belong to the next part
            first = first[first < own]
        h = every[first]
        h += np.uint64(seed * (2 * n + 1) % (1 << 64))
        mix(h)
        h >>= np.uint64(64 - bits)
        order = np.argsort(h, kind="stable")
        h, first = h[order], first[order]
        del order
        new = np.append(True, h[1:] != h[:-1])[: len(h)]
        group = np.cumsum(new, dtype=np.int32) - np.int32(1)
        head = first[new][group]
        if n == 1:
            size = ends - starts
            wrong = differ(text, starts[first], starts[head], size[first], size[head])
        else:
            wrong = np.zeros(len(first), bool)
            for k in range(n):
                wrong |= word[first + k] != word[head + k]
        if wrong.any():  # a collision: the texts of its fingerprint part
            torn = np.flatnonzero(np.isin(group, group[wrong]))
            spans = [text[starts[i] : ends[i + n - 1]].tobytes() for i in first[torn].tolist()]
            torn = torn[np.array(sorted(range(len(torn)), key=lambda j: (h[torn[j]], spans[j])), np.int64)]
            spans = [text[starts[i] : ends[i + n - 1]].tobytes() for i in first[torn].tolist()]
            where = np.sort(torn)
            h[where], first[where] = h[torn], first[torn]
            for j in range(1, len(spans)):
                new[where[j]] |= spans[j] != spans[j - 1]
            group = np.cumsum(new, dtype=np.int32) - np.int32(1)
            head = first[new][group]
        if n == 1:
            word[first] = head
            mine = first < own
        else:
            mine = slice(None)
        counts = np.bincount(group[mine], minlength=int(new.sum())) if len(group) else np.zeros(0, np.int64)
        there = counts > 0
        found.append((h[new][there], counts[there], (first[new] * 4 + n)[there]))
    prints, counts, pointers = (np.concatenate(x) for x in zip(*found))
    order = np.argsort(prints, kind="stable")
    return prints[order], counts[order].astype(np.uint32), pointers[order].astype(np.uint32)


def squeezed(values: np.ndarray) -> bytes:
    """Byte planes of the numbers, compressed: high bytes of small numbers cost nothing."""
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes())


def loosened(data: bytes, kind) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def parts(raw: bytes, most: int) -> Iterator[tuple[np.ndarray, int]]:
    """(tidy text, own words) in parts of about `most` bytes, each with two words more than its own, so no n-gram is cut."""
    inside = np.concatenate([[False], KIND[np.frombuffer(raw, np.uint8)] == OTHER, [False]])
    starts, ends = np.flatnonzero(~inside[:-1] & inside[1:]), np.flatnonzero(inside[:-1] & ~inside[1:])
    at = 0
    while at < len(starts):
        stop = max(at + 1, int(np.searchsorted(ends, starts[at] + most, "right")))
        if len(raw) <= 2 * most:
            stop = len(starts)
        far = min(stop + LONGEST - 1, len(starts)) - 1
        yield tidy(raw[starts[at] : ends[far]]), min(stop, len(starts)) - at
        at = stop


def _packs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(pack, lang, n_words, own, text): tidy texts of one language, compressed; languages of a task fill packs side by side."""
    held: dict[str, list[bytes]] = {}
    size: dict[str, int] = {}

    def out(lang: str) -> Iterator[pa.RecordBatch]:
        raw = b"\n".join(held.pop(lang))
        size.pop(lang)
        for text, own in parts(raw, PACK_BYTES):
            row = {"pack": uuid.uuid4().int >> 65, "lang": lang, "own": own, "text": zstandard.ZstdCompressor(level=3).compress(text.tobytes())}
            yield pa.RecordBatch.from_pylist([row], pa.schema([("pack", pa.int64()), ("lang", pa.string()), ("own", pa.int64()), ("text", pa.binary())]))

    for batch in batches:
        for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist()):
            held.setdefault(lang, []).append(text)
            size[lang] = size.get(lang, 0) + len(text) + 1
            if size[lang] >= PACK_BYTES or sum(size.values()) >= 2 * PACK_BYTES:
                yield from out(max(size, key=size.get))
    for lang in list(held):
        yield from out(lang)


def words_of(text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, piece) of the words of a tidy text."""
    ends = np.flatnonzero(KIND[text] != OTHER).astype(np.int32)
    starts = np.concatenate([np.zeros(1, np.int32), ends[:-1] + np.int32(1)])
    return starts, ends, np.concatenate([np.zeros(1, np.int32), np.cumsum(text[ends[:-1]] == 10, dtype=np.int32)])


def seed_of(lang: str) -> int:
    return int.from_bytes(lang.encode()[:64].ljust(8, b"\0"), "big") % ((1 << 61) - 1)


ENTRIES = pa.schema([("bucket", pa.int32()), ("pack", pa.int64()), ("prints", pa.binary()), ("counts", pa.binary()), ("pointers", pa.binary())])


def _fingerprints(buckets: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                text = np.frombuffer(zstandard.decompress(row.pop("text")), np.uint8)
                prints, counts, pointers = count_grams(text, *words_of(text), row["own"], seed_of(row["lang"]), bits)
                cuts = np.searchsorted(prints, np.array([(b << bits) // buckets for b in range(1, buckets)], np.uint64))
                edges = np.concatenate([[0], cuts, [len(prints)]])
                rows = []
                for b in np.flatnonzero(np.diff(edges)).tolist():
                    of = slice(edges[b], edges[b + 1])
                    rows.append({"bucket": b, "pack": row["pack"], "prints": squeezed(np.diff(prints[of], prepend=np.uint64(0))), "counts": squeezed(counts[of]), "pointers": squeezed(pointers[of])})
                yield pa.RecordBatch.from_pylist(rows, ENTRIES)

    return run


REPLIES = pa.schema([("pack", pa.int64()), ("counts", pa.binary()), ("pointers", pa.binary())])


def _frequent(least: int):
    def run(rows: pa.Table) -> pa.Table:
        """Of a bucket: the entries whose fingerprints have the least count in all packs together, each to its pack."""
        rows = rows.to_pylist()
        prints = [np.cumsum(loosened(r["prints"], np.uint64), dtype=np.uint64) for r in rows]
        counts = [loosened(r["counts"], np.uint32) for r in rows]
        every = np.concatenate(prints)
        order = np.argsort(every, kind="stable")
        every = every[order]
        first = np.flatnonzero(np.append(True, every[1:] != every[:-1]))
        many = np.add.reduceat(np.concatenate(counts)[order].astype(np.int64), first) >= least
        keep = np.zeros(len(every), bool)
        keep[order] = np.repeat(many, np.diff(np.append(first, len(every))))
        out, at = [], 0
        for r, p, c in zip(rows, prints, counts):
            own = keep[at : at + len(p)]
            at += len(p)
            if own.any():
                out.append({"pack": r["pack"], "counts": squeezed(c[own]), "pointers": squeezed(loosened(r["pointers"], np.uint32)[own])})
        return pa.Table.from_pylist(out, REPLIES)

    return run


PHRASES = pa.schema([("lang", pa.string()), ("k", pa.int32()), ("phrase", pa.string()), ("f", pa.int64())])


def _phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Phrases behind the pointers, read from the text, with their counts in the pack."""
    for batch in batches:
        for row in batch.to_pylist():
            text = np.frombuffer(zstandard.decompress(row["text"]), np.uint8)
            begins, ends, _ = words_of(text)
            for reply in row["replies"]:
                pointers, counts = loosened(reply["pointers"], np.uint32).astype(np.int64), loosened(reply["counts"], np.uint32).astype(np.int64)
                first, k = pointers >> 2, pointers & 3
                starts = begins[first]
                lengths = ends[first + k - 1] - starts
                offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
                phrases = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(gather(text, starts, lengths).tobytes()))
                lang = pa.DictionaryArray.from_arrays(np.zeros(len(k), np.int32), [row["lang"]]).cast(pa.string())
                yield pa.RecordBatch.from_arrays([lang, pa.array(k, pa.int32()), phrases, pa.array(counts)], schema=PHRASES)


def phrase_counts(docs: DataFrame, least: int = 10, text_col: str = "text", lang_col: str = "lang", bits: int = BITS) -> tuple[DataFrame, DataFrame]:
    """((lang, k, phrase, f), (lang, n)): phrases of one to three words that occur `least` times, and all words of a language.

    Null texts are empty, a null language is `und`. Both results are exact, whatever fingerprints collide. No phrase of
    lesser count leaves its pack; a phrase that every row has is one entry a pack.
    """
    small_batches(docs.sparkSession)
    data = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    texts = docs.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), data.alias("text"))
    packs = stored(texts.mapInArrow(_packs, "pack long, lang string, own long, text binary"), "collocation-packs")
    words = packs.groupBy("lang").agg(F.sum("own").alias("n"))
    total = packs.agg(F.coalesce(F.sum("own"), F.lit(0))).first()[0]
    buckets = max(LEAST_BUCKETS, LONGEST * total // BUCKET_ENTRIES)
    schema = "bucket int, pack long, prints binary, counts binary, pointers binary"
    entries = packs.select("pack", "lang", "own", "text").mapInArrow(_fingerprints(buckets, bits), schema)
    replies = entries.groupBy("bucket").applyInArrow(_frequent(least), "pack long, counts binary, pointers binary")
    back = replies.groupBy("pack").agg(F.collect_list(F.struct("pointers", "counts")).alias("replies"))  # a pack's own entries
    read = packs.select("pack", "lang", "text").join(back, "pack").mapInArrow(_phrases, "lang string, k int, phrase string, f long")
    return read.groupBy("lang", "k", "phrase").agg(F.sum("f").alias("f")).filter(F.col("f") >= least), words


def scores(counts: DataFrame) -> DataFrame:
    """(lang, k, phrase, a, l, r, score) of phrases of two and three words: the lowest-scoring cut, ties to the first.

    floor(1000000 a a / (l r)) by decimals: a, l and r stay below 10**15, so the products fit 38 digits.
    """
    words = lambda start, length: F.array_join(F.slice("w", start, length), " ")
    cut = F.explode(F.transform(F.sequence(F.lit(1), F.col("k") - 1), lambda c: F.struct(c.alias("cut"), words(F.lit(1), c).alias("left"), words(c + 1, F.col("k")).alias("right"))))
    longer = counts.filter("k > 1").withColumn("w", F.split("phrase", " ")).select("lang", "k", "phrase", F.col("f").alias("a"), cut.alias("c")).select("lang", "k", "phrase", "a", "c.*")
    half = lambda name, f: counts.filter(F.col("k") < LONGEST).select("lang", F.col("phrase").alias(name), F.col("f").alias(f))
    both = longer.join(half("left", "l"), ["lang", "left"]).join(half("right", "r"), ["lang", "right"])
    wide = lambda c: F.col(c).cast("decimal(15,0)")
    numerator = (wide("a") * wide("a")).cast("decimal(30,0)") * F.lit(1000000).cast("decimal(7,0)")
    both = both.withColumns({"top": numerator.cast("decimal(38,0)"), "under": (wide("l") * wide("r")).cast("decimal(30,0)")}).withColumn("score", F.expr("cast(top div under as bigint)"))
    best = both.groupBy("lang", "k", "phrase", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("b"))
    return best.select("lang", "k", "phrase", "a", "b.l", "b.r", "b.score")


def mine(docs: DataFrame, least: int = 10, top: int = 2000, text_col: str = "text", lang_col: str = "lang", bits: int = BITS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's best phrases of two or three words.

    Order: score, then count a, both descending, then the phrase's bytes. A phrase that a longer one holds, with half of
    its count or more, is left out. Null texts count as empty, a null language as `und`; repeated rows count each; a table
    without frequent phrases gives an empty result; no other column is read.
    """
    counts, words = phrase_counts(docs, least, text_col, lang_col, bits)
    counts = stored(counts, "collocation-counts")
    inner = F.explode(F.array(F.array_join(F.slice("w", 1, 2), " "), F.array_join(F.slice("w", 2, 2), " ")))
    held = counts.filter("k = 3").withColumn("w", F.split("phrase", " ")).select("lang", inner.alias("phrase"), "f").groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    found = scores(counts).join(held.withColumn("k", F.lit(2)), ["lang", "k", "phrase"], "left").filter("longer IS NULL OR 100 * longer < 50 * a")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = found.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    some = part.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).filter(F.col("rank") <= top)
    best = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    return best.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
