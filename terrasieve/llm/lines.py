"""Removal of repeated passages of lines: chunks whose bounds the lines themselves choose, extended line by line."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from .common import pack_rows, stored, unpack_rows, unused

WINDOW = 2  # lines whose hashes roll together
DIVISOR = 2  # a chunk ends where some bits of the rolling hash are divisible by it, after LEAST lines at least
LEAST = 2
FAMILIES = 6  # ways to cut a text, each by bits of its own: a short passage that one way cuts apart is whole in another
_BASE, _WORD = 0x9E3779B97F4A7C15, (1 << 64) - 1
NAME = 16  # bytes that stand for a line beside a chunk


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def chunk_bounds(lines: list[bytes], family: int = 0) -> list[tuple[int, int]]:
    """Line ranges [from, to) of the chunks.

    A bound depends on WINDOW lines and on the bounds just before, so that chunks move along with shifted text. Only
    the last chunk may have fewer than LEAST lines.
    """
    hashes = [xxhash.xxh64_intdigest(line) for line in lines]
    lead = pow(_BASE, WINDOW, 1 << 64)
    out, start, roll = [], 0, 0
    for i, h in enumerate(hashes):
        roll = (roll * _BASE + h) & _WORD
        if i >= WINDOW:
            roll = (roll - hashes[i - WINDOW] * lead) & _WORD
        if i + 1 == len(lines) or i + 1 >= WINDOW and i + 1 - start >= LEAST and (roll >> 17 + 7 * family) % DIVISOR == 0:
            out.append((start, i + 1))
            start = i + 1
    return out


Spans = list[tuple[int, int]]


def multi_line(text: str | None) -> tuple[list[bytes], list[Spans]]:
    """(lines, chunks of each family): line ranges [from, to) that begin and end with a line that is not blank.

    Bounds depend on lines that are not blank alone; only a family's last chunk may have fewer than LEAST of them.
    """
    lines = (text or "").encode().split(b"\n")
    full = [i for i, line in enumerate(lines) if line.strip()]
    shown = [lines[i] for i in full]
    return lines, [[(full[i], full[j - 1] + 1) for i, j in chunk_bounds(shown, family)] for family in range(FAMILIES)]


def chunks_of(text: str | None) -> Iterator[tuple[Spans, int, bytes]]:
    """(family's chunks, number among them, bytes) of the chunks that have two lines or more, each once."""
    lines, families = multi_line(text)
    seen = set()
    for spans in families:
        for i, (start, end) in enumerate(spans):
            if end - start > 1 and (start, end) not in seen:
                seen.add((start, end))
                yield spans, i, b"\n".join(lines[start:end])


def beside(lines: list[bytes], spans: Spans, i: int) -> tuple[bytes, bytes]:
    """Names of the lines before chunk i (nearest first) and after it, as far as a repeat of it can reach without holding
    another repeated chunk.

    After a common bound two texts go on with the same bounds while their lines agree, so the next chunk is enough. Before
    it, their bounds may differ along chunks of LEAST lines only: the first longer one, beyond the one just before, ends
    that.
    """
    first = i - 1
    while first > 0:
        first -= 1
        if sum(1 for line in lines[spans[first][0] : spans[first][1]] if line.strip()) > LEAST:
            break
    low = spans[max(first, 0)][0] if i else spans[i][0]
    high = spans[i + 1][1] if i + 1 < len(spans) else spans[i][1]
    name = lambda rows: b"".join(_name(line)[:NAME] for line in rows)
    return name(lines[low : spans[i][0]][::-1]), name(lines[spans[i][1] : high])


def _digest(chunk: bytes) -> int:
    return _signed(xxhash.xxh3_64_intdigest(chunk))


def _name(chunk: bytes) -> bytes:
    return hashlib.sha256(chunk).digest()


def _reach(lines: list[bytes], at: int, step: int, names: bytes) -> int:
    """How many lines from `at` on agree with the names; blank ones at the far end do not count."""
    n = good = 0
    while n * NAME < len(names) and 0 <= at + step * n < len(lines) and _name(lines[at + step * n])[:NAME] == names[n * NAME : (n + 1) * NAME]:
        n += 1
        good = n if lines[at + step * (n - 1)].strip() else good
    return good


def _repeat(lines: list[bytes], one: tuple[int, int], two: tuple[int, int]) -> range:
    """Lines of the second of two equal ranges with those around that repeat too; the first with its own stays whole."""
    left = right = 0
    while one[0] - left > 0 and two[0] - left > one[1] and lines[one[0] - left - 1] == lines[two[0] - left - 1]:
        left += 1
    while two[1] + right < len(lines) and one[1] + right < two[0] - left and lines[one[1] + right] == lines[two[1] + right]:
        right += 1
    while left and not lines[two[0] - left].strip():
        left -= 1
    while right and not lines[two[1] + right - 1].strip():
        right -= 1
    return range(two[0] - left, two[1] + right)


def remove(text: str | None, first: dict[bytes, tuple[int, bytes, bytes]], doc: int | None) -> tuple[str | None, int, int, int]:
    """(kept text, lines, removed passages, removed lines): what an earlier document holds first, and repeats within the text, are cut.

    `first` has, by a chunk's name, the first document that holds it and the lines beside it there.
    """
    if text is None:
        return None, 0, 0, 0
    lines = text.encode().split(b"\n")
    cut: set[int] = set()
    seen: dict[bytes, tuple[int, int]] = {}
    for (start, end), chunk in sorted((spans[i], chunk) for spans, i, chunk in chunks_of(text)):
        if start >= (one := seen.setdefault(chunk, (start, end)))[1]:
            cut.update(_repeat(lines, one, (start, end)))
        told = first.get(_name(chunk)) if first and doc is not None else None
        if told is not None and told[0] < doc:
            cut.update(range(start - _reach(lines, start - 1, -1, told[1]), end + _reach(lines, end, 1, told[2])))
    if not cut:
        return text, text.count("\n") + 1 if text else 0, 0, 0
    kept = [line for i, line in enumerate(lines) if i not in cut]
    return b"\n".join(kept).decode(), len(lines), sum(i - 1 not in cut for i in cut), len(cut)


MADE = ("n_lines", "n_removed_chunks", "n_removed_lines")


def drop_repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", made: tuple[str, str, str] = MADE) -> DataFrame:
    """`docs` with repeated passages of lines cut from the text, and numbers of lines, removed passages and removed lines.

    Content-defined chunks of two or more lines are compared, and those that an earlier document holds byte for byte go,
    with the lines around that agree with that document's; so a repeated passage goes from its first line to its last if
    one whole chunk lies in it. Of equal chunks the one in the document with the smallest id stays (its first, if it has
    several). Rows are packed, a few megabytes a pack, and packs are what the shuffles carry. Digests only propose:
    chunks whose digest two documents share are sent whole, once a pack, and grouped by their bytes, which Spark combines
    before the shuffle. What a pack needs to know comes back to it once, however many of its rows hold the chunk.
    Rows with a null id lose only repeats of their own; rows that repeat an id count as one document. Null texts stay
    null. Lines that repeat without a chunk stay, and so do blank lines at the ends of what is cut. A text whose lines all
    go is empty. Three new columns, named by `made`, replace columns of those names; other columns are kept.
    """
    docs = docs.drop(*made)
    packs = pack_rows(docs)

    def digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for tag, data in zip(batch["tag"], batch["pack"]):
                low, high = {}, {}
                for doc, text in _columns(data, id_col, text_col):
                    for digest in {_digest(c) for _, _, c in chunks_of(text)} if doc is not None else ():
                        low[digest] = min(doc, low.get(digest, doc))
                        high[digest] = max(doc, high.get(digest, doc))
                yield pd.DataFrame({"digest": list(low), "tag": tag, "low": list(low.values()), "high": [high[d] for d in low]}).astype("int64")

    def whole(pack: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        wanted, low, high = set(asked["digest"].tolist()), {}, {}
        for data in pack["pack"] if wanted else ():
            for doc, text in _columns(data, id_col, text_col):
                rows, own = None, set()
                for spans, i, c in chunks_of(text) if doc is not None else ():
                    if (key := (_digest(c), c))[0] in wanted and key not in own:
                        own.add(key)
                        rows = rows or text.encode().split(b"\n")
                        high[key] = max(doc, high.get(key, doc))
                        if key not in low or doc <= low[key][0]:
                            low[key] = min((doc, *beside(rows, spans, i)), low.get(key, (doc + 1,)))
        rows = [(d, c, *first, high[d, c]) for (d, c), first in low.items()]
        return pd.DataFrame(rows, columns=["digest", "chunk", "low", "before", "after", "high"])

    schema = T.StructType([f for f in docs.schema.fields] + [T.StructField(c, T.LongType()) for c in made])

    def cut(pack: pa.Table, told: pa.Table) -> pa.Table:
        first = {r["name"]: (r["first"], r["before"], r["after"]) for r in told.to_pylist()}
        out = []
        for data in pack["pack"]:
            rows = unpack_rows(data.as_py())
            ids = rows[id_col].to_pylist()
            done = [remove(t, first, doc) for doc, t in zip(ids, rows[text_col].to_pylist())]
            at = rows.column_names.index(text_col)
            rows = rows.set_column(at, rows.field(at), pa.chunked_array([pa.array([x[0] for x in done], rows.field(at).type)]))
            for i, c in enumerate(made, 1):
                rows = rows.append_column(c, pa.array([x[i] for x in done], pa.int64()))
            out.append(rows)
        return pa.concat_tables(out)

    held = stored(packs.mapInPandas(digests, "digest long, tag long, low long, high long"), "line-chunks")
    shared = held.groupBy("digest").agg(F.min("low").alias("low"), F.max("high").alias("high")).filter("low < high").select("digest")
    proposed = stored(held.join(shared, "digest").select("tag", "digest"), "line-proposed")
    bytes_of = packs.groupBy("tag").cogroup(proposed.groupBy("tag")).applyInPandas(whole, "digest long, chunk binary, low long, before binary, after binary, high long")
    equal = bytes_of.groupBy("digest", "chunk").agg(F.min(F.struct("low", "before", "after")).alias("first"), F.max("high").alias("last")).filter("first.low < last")
    verified = stored(equal.select("digest", F.unhex(F.sha2("chunk", 256)).alias("name"), F.col("first.low").alias("first"), "first.before", "first.after"), "line-verified")  # a SHA-256 stands for bytes
    told = proposed.join(verified, "digest").select("tag", "name", "first", "before", "after")
    return packs.groupBy("tag").cogroup(told.groupBy("tag")).applyInArrow(cut, schema)


def _columns(data: bytes, *names: str):
    rows = unpack_rows(data)
    return zip(*(rows[c].to_pylist() for c in names))


def keep_lines(docs: DataFrame) -> DataFrame:
    """The rows of `docs` with repeated passages cut, columns unchanged; n_chars follows the kept text.

    Null texts stay null (and n_chars too), empty ones empty; rows of equal id are one document and keep each other's
    lines; rows with a null id lose repeats of their own only. Names used inside give way to columns of `docs`.
    """
    made = tuple(unused(name, docs) for name in MADE)
    done = drop_repeated(docs, made=made)
    if "n_chars" in docs.columns:
        done = done.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return done.select(*docs.columns)
