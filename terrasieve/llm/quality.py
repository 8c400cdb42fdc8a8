"""Quality by compression: zstandard dictionaries of good and bad text, and a calibrated size difference."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, functions as F

from .common import small_batches, unused

BLOCK = 1024  # bytes compressed at a time: a dictionary counts most near a block's start
LEVEL = 3
DICT_BYTES = 112_640
PER_CLASS = 3000  # labelled documents of a class that the fit uses at most: the bound on what the driver gathers
THRESHOLD = 0.7


def _blocks(text: str | None) -> list[bytes]:
    data = (text or "").encode()
    return [data[i : i + BLOCK] for i in range(0, len(data), BLOCK)] or [b""]


def _compressor(dictionary: bytes | None) -> zstandard.ZstdCompressor:
    if dictionary is None:
        return zstandard.ZstdCompressor(level=LEVEL, write_content_size=False, write_checksum=False)
    known = zstandard.ZstdCompressionDict(dictionary)
    known.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=known, write_content_size=False, write_dict_id=False, write_checksum=False)


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    centre: tuple[float, ...] = (0.0, 0.0)
    scale: tuple[float, ...] = (1.0, 1.0)
    weights: tuple[float, ...] = (0.0, 0.0, 0.0)

    def measures(self, texts) -> np.ndarray:
        """Of each whole text: how much smaller the good dictionary makes it than the bad one, and its size without either, both a byte.

        The last tells texts that repeat themselves. It takes no dictionary, so a text that lies in one is none of them.
        """
        good, bad, alone = _compressor(self.good), _compressor(self.bad), _compressor(None)
        out = np.zeros((len(texts), 2))
        for i, text in enumerate(texts):
            g = b = a = n = 0
            for block in _blocks(text):
                g += len(good.compress(block))
                b += len(bad.compress(block))
                a += len(alone.compress(block))
                n += len(block)
            out[i] = (b - g) / max(n, 1), a / max(n, 1)
        return out

    def calibrated(self, measured: np.ndarray) -> np.ndarray:
        z = np.c_[(measured - self.centre) / self.scale, np.ones(len(measured))] @ np.array(self.weights)
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def _logistic(x: np.ndarray, y: np.ndarray, rounds: int = 40, ridge: float = 1e-3) -> tuple:
    """Newton's method with a ridge, on standardised columns."""
    centre, scale = x.mean(0), x.std(0) + 1e-9
    z = np.c_[(x - centre) / scale, np.ones(len(x))]
    w = np.zeros(z.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -500, 500)))
        hessian = (z * (p * (1 - p))[:, None]).T @ z + ridge * len(y) * np.eye(len(w))
        w = w + np.linalg.solve(hessian, z.T @ (y - p) - ridge * len(y) * w)
    return tuple(centre), tuple(scale), tuple(w)


def held_out(doc_id) -> F.Column:
    """Rows whose labels are never learnt from: crc32 of the id's text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model:
    """Learns dictionaries and calibration from at most `per_class` labelled rows of each class, none of them held out.

    Rows are chosen by a hash of doc_id, alternately for dictionaries and calibration, and learnt from with their whole
    texts. A doc_id that `docs` repeats counts once, with its smallest text, so that what the driver gathers is bounded by
    2 * per_class texts. Rows with a null id or label are not used. Without rows of both classes every score is 0.5.
    """
    usable = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id"))).select("doc_id", "quality")
    picked = None
    for quality in (0, 1):
        part = usable.filter(F.col("quality") == quality).distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        picked = part if picked is None else picked.unionByName(part)
    chosen = [(r.doc_id, r.quality, i % 2) for i, r in enumerate(sorted(picked.collect(), key=lambda r: (r.quality, r.doc_id)))]
    if len({q for _, q, _ in chosen}) < 2:
        return Model(b"", b"")
    spark = docs.sparkSession
    chosen = spark.createDataFrame(chosen, "doc_id long, quality int, part int")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id")  # 2 * per_class rows
    texts = texts.groupBy("doc_id", "quality", "part").agg(F.min("text").alias("text"))

    samples: dict[int, list[bytes]] = {0: [], 1: []}
    for row in texts.filter("part = 0").select("quality", "text").toLocalIterator():
        samples[row.quality] += _blocks(row.text)
    model = Model(*(_dictionary(sorted(samples[q])) for q in (1, 0)))

    @F.pandas_udf("array<double>")
    def measured(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(list(model.measures(batch)), dtype=object)

    rows = texts.filter("part = 1").select("quality", measured("text").alias("m")).collect()
    if len({r.quality for r in rows}) < 2:
        return Model(b"", b"")
    rows = sorted((list(r.m), r.quality) for r in rows)
    return Model(model.good, model.bad, *_logistic(np.array([m for m, _ in rows]), np.array([float(q) for _, q in rows])))


def _dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary; of too few samples to train from, their text itself."""
    try:
        return zstandard.train_dictionary(DICT_BYTES, samples, k=200, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICT_BYTES:]


def score(docs: DataFrame, model: Model, text_col: str = "text", out: str = "score") -> DataFrame:
    """`docs` with a score from 0 to 1 of each whole text, higher for better text; null and empty texts get one too.

    A column of the name `out` is replaced; other columns are kept. Very long texts are compressed block by block. A row's
    score depends on its text alone, so repeated rows score alike; an empty table gives an empty result.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = shared.value
        for batch in batches:
            yield pd.Series(own.calibrated(own.measures(batch)), dtype="float64")

    return docs.withColumn(out, scored(F.col(text_col)))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `docs`, columns unchanged, whose score reaches the threshold; a score equal to it does.

    Null and empty texts are scored like others. Repeated rows and rows with a null id stay or go by their texts.
    """
    name = unused("__score", docs)
    scored = score(docs, fit(docs, labels), out=name)
    return scored.filter(F.col(name) >= threshold).drop(name)
