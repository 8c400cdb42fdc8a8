"""Removal of byte strings that repeat across documents: distributed difference-cover suffix sorting.

Suffixes that can share a prefix of WIDTH bytes with another document's are few, and meet by content. Every WIDTH-byte
window has a marker, the smallest hash of the GRAM-byte strings in it; equal windows have equal markers.

1. Documents are packed, some megabytes a row, so that shuffles carry compressed blocks and not suffixes.
2. Markers meet in parts by their value; a pack learns which of its markers another document has too.
3. Windows of those markers are cut out as short segments, deduplicated in the pack with their smallest document, and
   meet by marker. There their suffixes are sorted by the difference-cover method: sort the sampled triples, recurse on
   their names, merge the remaining suffixes; adjacent prefixes of WIDTH bytes are compared, and each window learns the
   smallest document that has it.
4. Packs take the answers back and cut what an earlier document covers.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, functions as F

from .common import Stored, small_batches

WIDTH = 50
GRAM = 16
SPAN = WIDTH - GRAM + 1  # grams in a window
PACK_BYTES = 2 << 20
SLICE = 1 << 16  # windows worked on at a time: arrays stay in a processor's cache, and a huge text needs little memory
SEGMENT = 32  # windows in a segment, at most
HOT = 4096  # occurrences of a marker from which its windows are dealt one by one, by their own hash
PART_MARKERS, PART_BYTES = 1 << 20, 8 << 20  # what a part should hold
BLOCK = 1_500_000  # bytes whose suffixes are sorted together; a marker's segments are never split
NONE = np.iinfo(np.int64).max  # stands for a null id: no document comes after it; ids make room for it (free_id)
_BASE = 0x9E3779B97F4A7C15


def _packed(*arrays: np.ndarray | bytes) -> bytes:
    parts = [a if isinstance(a, bytes) else np.ascontiguousarray(a).tobytes() for a in arrays]
    return zstandard.ZstdCompressor(level=1).compress(b"".join([struct.pack(f"<{len(parts)}q", *map(len, parts)), *parts]))


def _unpacked(data: bytes, *kinds) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    sizes, at, out = struct.unpack_from(f"<{len(kinds)}q", raw), 8 * len(kinds), []
    for kind, size in zip(kinds, sizes):
        out.append(np.frombuffer(raw, kind, size // np.dtype(kind).itemsize, at))
        at += size
    return out


def free_id(docs: DataFrame, id_col: str) -> int:
    """A number that no row has as its id: the largest long, if it is free. Ids above it are held one lower inside, so that the largest long stands for null."""
    own, free = F.col(id_col).cast("long"), NONE
    while not docs.filter(own == free).isEmpty():
        free = (free * 6364136223846793005 + 1442695040888963407) % (1 << 63)
    return free


def make_packs(docs: DataFrame, id_col: str, text_col: str, free: int = NONE) -> DataFrame:
    """(tag, n_bytes, pack): documents in rows of about PACK_BYTES; a tag names its row once it is stored."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, texts, size = [], [], 0

        def row() -> pd.DataFrame:
            data = _packed(np.array(ids, np.int64), np.array([len(t) for t in texts], np.int64), b"".join(texts))
            return pd.DataFrame({"tag": [uuid.uuid4().int >> 65], "n_bytes": [size], "pack": [data]})

        for batch in batches:
            for doc, text in zip(batch["doc_id"], batch["text"]):
                ids.append(NONE if pd.isna(doc) else int(doc) - (int(doc) > free))
                texts.append((text or "").encode())
                size += len(texts[-1])
                if size >= PACK_BYTES or len(ids) >= 20_000:
                    yield row()
                    ids, texts, size = [], [], 0
        if ids:
            yield row()

    rows = docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).alias("text"))  # as text: ids keep all digits in pandas
    return rows.mapInPandas(pack, "tag long, n_bytes long, pack binary")


def gram_hashes(a: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of each k-byte string in `a`: a polynomial by doubling, then mixed."""
    with np.errstate(over="ignore"):
        power, n = np.uint64(_BASE), 1
        run = (a.astype(np.uint64) + np.uint64(1)) * np.uint64(0xFF51AFD7ED558CCD)
        out, done = None, 0
        while k:
            if k & 1:
                out = run if out is None else out[: len(run) - done] * power + run[done:]
                done += n
            k >>= 1
            if k:
                run = run[: len(run) - n] * power + run[n:]
                power, n = power * power, 2 * n
        out = out ^ (out >> np.uint64(29))
        out *= np.uint64(0xBF58476D1CE4E5B9)
        return out ^ (out >> np.uint64(32))


def window_markers(a: np.ndarray) -> np.ndarray:
    """The marker of each window in `a`: the least of its SPAN gram hashes."""
    low, n = gram_hashes(a, GRAM), 1
    while 2 * n <= SPAN:
        low, n = np.minimum(low[: len(low) - n], low[n:]), 2 * n
    return np.minimum(low[: len(low) - (SPAN - n)], low[SPAN - n :]) if SPAN > n else low


class Pack:
    def __init__(self, data: bytes):
        self.ids, sizes, self.data = _unpacked(data, np.int64, np.int64, np.uint8)
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes

    def runs(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(marker, first window, windows, document's place) of the longest runs of windows with one marker, by slices."""
        for at in range(0, len(self.data) - WIDTH + 1, SLICE):
            marks = window_markers(self.data[at : at + SLICE + WIDTH - 1])
            upto = at + len(marks)
            low, high = np.searchsorted(self.ends, [at, upto - 1], "right")
            span = slice(low, high + 1)
            doc = np.repeat(np.arange(low, high + 1), np.minimum(self.ends[span], upto) - np.maximum(self.starts[span], at))
            inside = np.arange(at + WIDTH, upto + WIDTH) <= self.ends[doc]
            head = np.flatnonzero(np.r_[True, (marks[1:] != marks[:-1]) | (doc[1:] != doc[:-1]) | (inside[1:] != inside[:-1])])
            n = np.diff(np.r_[head, len(marks)])
            kept = inside[head]
            head, n = head[kept], n[kept]
            if len(head):
                yield marks[head], head + at, n, doc[head]


def _ids(marks: np.ndarray, parts: int) -> np.ndarray:
    """A marker's part and 32 more of its bits, as one number; two markers seldom share it, and then only cost work."""
    n = np.uint64(parts)
    return (marks // n & np.uint64(0xFFFFFFFF)) * n + marks % n


def deal_markers(parts: int):
    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for tag, data in zip(batch["tag"], batch["pack"]):
                found = [(_ids(m, parts), d) for m, _, _, d in Pack(data).runs()]
                if not found:
                    continue
                ids, docs = (np.concatenate(c) for c in zip(*found))
                order = np.lexsort((docs, ids))
                ids, docs = ids[order], docs[order]
                fresh = np.r_[True, (ids[1:] != ids[:-1]) | (docs[1:] != docs[:-1])]
                times = np.unique(ids, return_counts=True)[1]  # occurrences of each marker in the pack
                ids, n = np.unique(ids[fresh], return_counts=True)  # and its documents
                part = (ids % np.uint64(parts)).astype(np.int64)
                order = np.argsort(part, kind="stable")
                cuts = np.flatnonzero(np.diff(part[order])) + 1
                rows = [(int(part[k[0]]), tag, _packed((ids[k] // np.uint64(parts)).astype(np.uint32), np.minimum(n[k], 2).astype(np.uint8), times[k].astype(np.uint32))) for k in np.split(order, cuts)]
                yield pd.DataFrame(rows, columns=["part", "tag", "marks"])

    return deal


def answer_markers(parts: int):
    """In a part: which markers two documents have. Each pack hears about its own; a marker in a third of all documents has an entry a pack."""

    def answer(rows: pd.DataFrame) -> pd.DataFrame:
        part = np.uint64(rows["part"].iloc[0])
        lists = [_unpacked(x, np.uint32, np.uint8, np.uint32) for x in rows["marks"]]
        of, inverse = np.unique(np.concatenate([a for a, _, _ in lists]), return_inverse=True)
        n, times = (np.bincount(inverse, weights=np.concatenate(c)) for c in list(zip(*lists))[1:])
        out, at = [], 0
        for tag, (marks, _, _) in zip(rows["tag"], lists):
            own = inverse[at : at + len(marks)]
            at += len(marks)
            full, shared, hot = marks.astype(np.uint64) * np.uint64(parts) + part, n[own] > 1, times[own] >= HOT
            out.append((tag, full[shared & ~hot].tobytes(), full[shared & hot].tobytes()))
        out = [x for x in out if x[1] or x[2]]
        return pd.DataFrame(out, columns=["tag", "plain", "hot"])

    return answer


class Segments:
    """The candidate windows of a pack, as distinct segments in a fixed order, and where they occur."""

    def __init__(self, pack: Pack, answers: pd.DataFrame, marker_parts: int, parts: int):
        plain, hot = (np.sort(np.frombuffer(b"".join(answers[c]), np.uint64)) for c in ("plain", "hot"))
        seen: tuple[dict[bytes, int], dict[bytes, int]] = {}, {}  # segments, and windows dealt one by one, with their numbers
        found = []
        data = pack.data.tobytes()
        for marks, pos, n, docs in pack.runs():
            ids = _ids(marks, marker_parts)
            for alone, known in enumerate((plain, hot)):
                k = np.flatnonzero(_member(ids, known))
                if not len(k):
                    continue
                size = 1 if alone else SEGMENT
                pieces = -(-n[k] // size)
                src = np.repeat(k, pieces)
                nth = np.arange(len(src)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                first = pos[src] + nth * size
                ends = first + np.minimum(n[src] - nth * size, size) + WIDTH - 1
                route = (_window_hash(pack.data, first) if alone else marks[src]) % np.uint64(parts)
                found.append((_numbered(data, first, ends, seen, alone), first, docs[src], route.astype(np.int64)))
        where, start, doc, route = ([np.concatenate(x) for x in zip(*found)] if found else [np.zeros(0, np.int64)] * 4)
        self.where, self.start, self.doc = where, start, doc
        self.alone, self.texts = _in_order(seen)
        self.part, self.least = np.zeros(len(self.texts), np.int64), np.full(len(self.texts), NONE)
        self.part[where] = route  # the same for all of a segment
        np.minimum.at(self.least, where, pack.ids[doc])
        self.order = np.argsort(self.part, kind="stable")

    def dealt(self) -> Iterator[tuple[int, bytes]]:
        """(part, its segments in order): whether windows are dealt one by one, length, smallest document, bytes."""
        for k in np.split(self.order, np.flatnonzero(np.diff(self.part[self.order])) + 1):
            if len(k):
                own = [self.texts[i] for i in k.tolist()]
                sizes = np.where(self.alone[k], 0, [len(text) for text in own]).astype(np.uint8)
                yield int(self.part[k[0]]), _packed(sizes, self.least[k], b"".join(own))


def _numbered(data: bytes, starts: np.ndarray, ends: np.ndarray, seen: tuple[dict, dict], alone: int) -> np.ndarray:
    """The numbers of the byte strings data[start:end]; new ones get the next."""
    number, own, other = seen[alone].setdefault, seen[alone], len(seen[1 - alone])
    return np.array([number(data[i:j], len(own) + other) for i, j in zip(starts.tolist(), ends.tolist())], np.int64)


def _in_order(seen: tuple[dict, dict]) -> tuple[np.ndarray, list[bytes]]:
    """By number: whether a byte string is a window dealt alone, and the string."""
    alone, texts = np.zeros(len(seen[0]) + len(seen[1]), bool), [b""] * (len(seen[0]) + len(seen[1]))
    for kind, own in enumerate(seen):
        for text, i in own.items():
            texts[i] = text
        alone[list(own.values())] = kind == 1
    return alone, texts


def _member(ids: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(ids), bool)
    return known[np.minimum(np.searchsorted(known, ids), len(known) - 1)] == ids


def _window_hash(data: np.ndarray, first: np.ndarray) -> np.ndarray:
    out = np.zeros(len(first), np.uint64)
    with np.errstate(over="ignore"):
        for i in range(WIDTH):
            out = out * np.uint64(_BASE) + data[first + i] + np.uint64(1)
        out ^= out >> np.uint64(31)
        return out * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(8)


def _names(keys: np.ndarray) -> np.ndarray:
    """1, 2, ... by value, equal for equal keys; a few million possible values are counted rather than sorted."""
    if len(keys) > 1 << 16 and (most := int(keys.max())) < 1 << 25:
        there = np.zeros(most + 1, bool)
        there[keys] = True
        return np.cumsum(there, dtype=np.int64)[keys]
    return np.unique(keys, return_inverse=True)[1] + 1


def suffix_order(text: np.ndarray, reach: int, covered: int = 1) -> np.ndarray:
    """Positions of `text` (numbers from 1) in the order of their suffixes' first `reach` letters, by a difference cover modulo 3.

    A letter here stands for `covered` letters of the text at the top. Suffixes that agree that far may come in any order.
    """
    n = len(text)
    t = np.zeros(n + 3, np.int64)
    t[:n] = text
    one, two = np.arange(1, n + (n % 3 == 1), 3), np.arange(2, n, 3)
    sample = np.concatenate((one, two))
    rank = np.zeros(n + 3, np.int64)
    if len(sample):
        top = int(t.max()) + 1
        names = _names((t[sample] * top + t[sample + 1]) * top + t[sample + 2])
        if names.max() < len(sample) and 3 * covered < reach:
            joined = np.concatenate((names[: len(one)], [0], names[len(one) :]))  # 0 ends the first half
            deeper = suffix_order(joined + 1, reach, 3 * covered)
            place = np.empty(len(joined), np.int64)
            place[deeper] = np.arange(1, len(joined) + 1)
            names = np.concatenate((place[: len(one)], place[len(one) + 1 :]))
            rank[sample] = names
            at = np.full(len(joined) + 1, -1)
            at[names] = sample  # ranks are places already
            sample = at[at >= 0]
        else:
            rank[sample] = names
            sample = sample[np.argsort(names, kind="stable")]
        sample = sample[sample < n]
    rest = np.arange(0, n, 3)
    wide = int(rank.max()) + 1
    rest = rest[np.argsort(t[rest] * wide + rank[rest + 1], kind="stable")]
    ones, twos = sample[sample % 3 == 1], sample[sample % 3 == 2]
    letters = int(t.max()) + 1
    pair = lambda i: t[i] * wide + rank[i + 1]
    triple = lambda i: (t[i] * letters + t[i + 1]) * wide + rank[i + 2]
    before = np.searchsorted(pair(ones), pair(rest)) + np.searchsorted(triple(twos), triple(rest))
    before = np.maximum.accumulate(before)  # suffixes that agree for the whole reach are in any order, so searches among them vary
    out = np.empty(n, np.int64)
    at = before + np.arange(len(rest))
    out[at] = rest
    free = np.ones(n, bool)
    free[at] = False
    out[free] = sample
    return out


def least_documents(texts: list[bytes], least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The number of windows of each segment, and for each window in turn the smallest document among all segments that hold its WIDTH bytes."""
    sizes = np.array([len(x) for x in texts])
    starts = np.cumsum(sizes + 1) - sizes - 1
    whole = np.frombuffer(b"\0".join(texts) + bytes(WIDTH), np.uint8)
    letters = whole.astype(np.int64) + 1
    letters[starts[1:] - 1] = 0
    n = int(starts[-1] + sizes[-1])
    order = suffix_order(letters[:n] + 1, WIDTH)
    windows = sizes - WIDTH + 1
    owner = np.repeat(np.arange(len(texts)), windows)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows) + starts[owner]
    number = np.full(n, -1)
    number[place] = np.arange(len(place))
    sorted_windows = number[order]
    sorted_windows = sorted_windows[sorted_windows >= 0]
    view, at = np.lib.stride_tricks.sliding_window_view(whole, WIDTH), place[sorted_windows]
    same = np.zeros(len(at), bool)
    for i in range(1, len(at), 1 << 18):
        j = min(len(at), i + (1 << 18))
        same[i:j] = (view[at[i:j]] == view[at[i - 1 : j - 1]]).all(axis=1)
    head = np.flatnonzero(~same)
    low = np.minimum.reduceat(least[owner[sorted_windows]], head)
    found = np.empty(len(at), np.int64)
    found[sorted_windows] = np.repeat(low, np.diff(np.r_[head, len(at)]))
    return windows, found


def answer_segments(rows: pd.DataFrame) -> pd.DataFrame:
    """In a part: sorts the suffixes of all packs' segments, and tells each pack the smallest documents of its windows.

    A marker with one distinct segment needs no sorting: all its windows are in that segment, in all documents alike.
    Windows dealt one by one are distinct already.
    """
    seen: tuple[dict[bytes, int], dict[bytes, int]] = {}, {}
    lists, lows = [], []
    for data in rows["segments"]:
        sizes, low, text = _unpacked(data, np.uint8, np.int64, np.uint8)
        single = sizes == 0
        ends = np.cumsum(np.where(single, WIDTH, sizes.astype(np.int64)))
        starts, text, own = np.r_[0, ends[:-1]], text.tobytes(), np.empty(len(sizes), np.int64)
        for alone, k in enumerate((np.flatnonzero(~single), np.flatnonzero(single))):
            own[k] = _numbered(text, starts[k], ends[k], seen, alone)
        lists.append(own)
        lows.append(low)
    alone, texts = _in_order(seen)
    low = np.full(len(texts), NONE)
    np.minimum.at(low, np.concatenate(lists), np.concatenate(lows))
    n_runs, lengths, docs = np.ones(len(texts), np.int64), [np.array([len(x) - WIDTH + 1 for x in texts])], [low]
    where = [np.arange(len(texts))]
    dealt = np.flatnonzero(~alone)
    if len(dealt):
        marks = window_markers(np.frombuffer(b"".join([texts[i][:WIDTH] for i in dealt]), np.uint8))[::WIDTH]
        order = np.argsort(marks, kind="stable")
        _, n = np.unique(marks, return_counts=True)
        dealt = dealt[order][np.repeat(n > 1, n)]
        n = n[n > 1]
    if len(dealt):
        total = np.cumsum([len(texts[i]) + 1 for i in dealt])
        group_end = np.repeat(total[np.cumsum(n) - 1], n)  # bytes up to where the marker's segments end
        sorted_here = np.zeros(len(texts), bool)
        sorted_here[dealt] = True
        lengths, docs, where = [lengths[0][~sorted_here]], [low[~sorted_here]], [where[0][~sorted_here]]
        for k in np.split(dealt, np.flatnonzero(np.diff((group_end - 1) // BLOCK)) + 1):
            windows, found = least_documents([texts[i] for i in k], low[k])
            owner = np.repeat(k, windows)
            head = np.flatnonzero(np.r_[True, (found[1:] != found[:-1]) | (owner[1:] != owner[:-1])])
            lengths.append(np.diff(np.r_[head, len(found)]))
            docs.append(found[head])
            where.append(owner[head])
            n_runs[k] = np.unique(owner[head], return_counts=True)[1][np.argsort(np.argsort(k))]
    lengths, docs, where = (np.concatenate(x) for x in (lengths, docs, where))
    order = np.argsort(where, kind="stable")  # runs of the first segment, of the second, and so on
    lengths, docs = lengths[order].astype(np.uint8), docs[order]
    first = np.cumsum(n_runs) - n_runs
    out = []
    for tag, own in zip(rows["tag"], lists):
        many = n_runs[own]
        at = np.repeat(first[own], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        out.append((tag, int(rows["part"].iloc[0]), _packed(many.astype(np.uint8), lengths[at], docs[at])))
    return pd.DataFrame(out, columns=["tag", "part", "runs"])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", spans: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) for every row, and with `spans` the removed byte ranges and kept bytes.

    A byte goes if a WIDTH-byte string that covers it also starts in a document with a smaller id; strings are judged on
    the input. Null texts count as empty, texts below WIDTH bytes lose nothing. Rows that share an id do not remove each
    other's text; a null id counts as larger than all others, so such rows lose what any other row has. Very long texts
    are gone through a slice at a time. An empty table gives an empty result; other columns are not read.

    Not all windows are decided by sorting suffixes. A marker with one distinct segment needs no order, and windows of a
    marker that occurs HOT times or more are grouped by their bytes, as no task could take all its segments.
    """
    small_batches(docs.sparkSession)
    free = free_id(docs, id_col)
    packs = Stored(make_packs(docs, id_col, text_col, free), "suffix-packs").df
    total = packs.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]
    marker_parts, parts = max(48, total // (16 * PART_MARKERS)), max(48, total // PART_BYTES)
    marks = packs.select("tag", "pack").mapInPandas(deal_markers(marker_parts), "part int, tag long, marks binary")
    known = Stored(marks.groupBy("part").applyInPandas(answer_markers(marker_parts), "tag long, plain binary, hot binary"), "suffix-known").df
    del marks  # what is stored needs no shuffle files any more; Spark deletes those of plans that nobody holds

    def deal(pack: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for tag, data in zip(pack["tag"], pack["pack"]):
            rows += [(part, tag, text) for part, text in Segments(Pack(data), answers, marker_parts, parts).dealt()]
        return pd.DataFrame(rows, columns=["part", "tag", "segments"])

    segments = packs.groupBy("tag").cogroup(known.groupBy("tag")).applyInPandas(deal, "part int, tag long, segments binary")
    answered = Stored(segments.groupBy("part").applyInPandas(answer_segments, "tag long, part int, runs binary"), "suffix-answers").df
    del segments

    def cut(pack: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for data in pack["pack"]:
            rows += _cut(Pack(data), answers, marker_parts, parts, spans, free)
        return pd.DataFrame(rows, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept"])

    both = known.unionByName(answered, allowMissingColumns=True)
    shape = "doc_id string, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<array<long>>, kept binary"
    done = packs.groupBy("tag").cogroup(both.groupBy("tag")).applyInPandas(cut, shape).withColumn("doc_id", F.col("doc_id").cast(docs.schema[id_col].dataType))
    return done if spans else done.drop("spans", "kept")


def _cut(pack: Pack, answers: pd.DataFrame, marker_parts: int, parts: int, spans: bool, free: int) -> list[tuple]:
    gone = np.zeros(len(pack.data) + 1, np.int32)
    known, runs = answers[answers["plain"].notna()], answers[answers["runs"].notna()].sort_values("part")
    if len(runs):
        found = Segments(pack, known, marker_parts, parts)
        n, lengths, docs = (np.concatenate(c) for c in zip(*(_unpacked(x, np.uint8, np.uint8, np.int64) for x in runs["runs"])))
        n, lengths = n.astype(np.int64), lengths.astype(np.int64)
        ends = np.cumsum(n)
        place = np.empty(len(found.order), np.int64)
        place[found.order] = np.arange(len(found.order))  # answers come in the order in which segments were dealt
        at = place[found.where]
        many = n[at]
        src = np.repeat(np.arange(len(at)), many)
        nth = np.arange(len(src)) - np.repeat(np.cumsum(many) - many, many)
        run = ends[at][src] - many[src] + nth
        upto = np.cumsum(lengths)
        offset = upto[run] - lengths[run] - (upto[ends[at] - many] - lengths[ends[at] - many])[src]
        earlier = docs[run] < pack.ids[found.doc[src]]
        first = (found.start[src] + offset)[earlier]
        np.add.at(gone, first, 1)
        np.add.at(gone, first + lengths[run][earlier] + WIDTH - 1, -1)
    removed = np.cumsum(gone[:-1]) > 0
    out = []
    for doc, start, end in zip(pack.ids.tolist(), pack.starts.tolist(), pack.ends.tolist()):
        mask, data = removed[start:end], pack.data[start:end]
        n = int(mask.sum())
        edge = np.flatnonzero(np.diff(np.r_[False, mask, False])) if n else np.zeros(0, np.int64)
        kept = data[~mask].tobytes() if n else data.tobytes()
        name = None if doc == NONE else str(doc + (doc >= free))
        out.append((name, end - start, n, len(edge) // 2, hashlib.sha256(kept).hexdigest(), edge.reshape(-1, 2).tolist() if spans else None, kept if spans else None))
    return out
