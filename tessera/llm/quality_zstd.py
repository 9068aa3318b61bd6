"""Quality by compression: a text that resembles good documents is shorter
under a dictionary of good text than under one of bad text.

Two zstandard dictionaries are trained, on pieces of labelled good and of
labelled bad documents. A text is cut into short pieces, so that it cannot be
its own dictionary, and every piece is compressed under both. The evidence is
the difference of both total sizes divided by the bytes of the text, and a
logistic curve of it, fitted on labelled rows that the dictionaries have not
seen, is the score.

What reaches the driver is bounded: ``SAMPLE_PIECES`` pieces of each class and
two numbers for each of ``CURVE_ROWS`` rows. The dictionaries and the curve,
at most ``2 * DICT_BYTES`` and some numbers, go out with the task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from tessera.llm.util import bounded_sample, cut

#: Labelled rows at most, of each class, that pieces are taken from, pieces at
#: most that a dictionary is trained on, and rows that the curve is fitted on.
MAX_FIT_ROWS, SAMPLE_PIECES, CURVE_ROWS = 20_000, 8_000, 40_000
#: Bytes of a piece, of the least piece that trains, and of a dictionary.
PIECE, LEAST_PIECE, DICT_BYTES = 512, 64, 128 << 10
LEVEL = 3
THRESHOLD = 0.3
#: Folds of the ids, and the one that takes no part in learning.
FOLDS, HELD_OUT, CURVE_FOLD = 5, 0, 4


def fold(doc_id: Column) -> Column:
    """crc32 of the id's decimal text, modulo 5 (null id: 0, so held out)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS, F.lit(HELD_OUT))


def pieces(text: str | None) -> list[bytes]:
    """The whole text in UTF-8, in runs of ``PIECE`` bytes."""
    data = (text or "").encode("utf-8", "replace")
    return [data[at:at + PIECE] for at in range(0, len(data), PIECE)]


def train(samples: list[bytes]) -> zstandard.ZstdCompressionDict | None:
    """A trained dictionary; of too few samples their bytes as they are, and
    none of nothing."""
    if sum(map(len, samples)) < LEAST_PIECE:
        return None
    try:
        return zstandard.train_dictionary(DICT_BYTES, samples)
    except zstandard.ZstdError:
        return zstandard.ZstdCompressionDict(b"".join(samples)[:DICT_BYTES], dict_type=zstandard.DICT_TYPE_RAWCONTENT)


class Sizes:
    """Compressed sizes of texts under the dictionary of each class."""

    def __init__(self, dictionaries: list[tuple[bytes, int] | None]):
        options = {"level": LEVEL, "write_checksum": False, "write_content_size": False, "write_dict_id": False}
        self.compressors = []
        for held in dictionaries:
            d = zstandard.ZstdCompressionDict(held[0], dict_type=held[1]) if held else None
            self.compressors.append(zstandard.ZstdCompressor(dict_data=d, **options) if d else
                                    zstandard.ZstdCompressor(**options))

    def evidence(self, text: str | None) -> float:
        """Bytes that the dictionary of good text saves against that of bad
        text, for each byte of the text (0 for an empty one)."""
        bad = good = n = 0
        for piece in pieces(text):
            bad += len(self.compressors[0].compress(piece))
            good += len(self.compressors[1].compress(piece))
            n += len(piece)
        return (bad - good) / n if n else 0.0


def _kept(dictionary: zstandard.ZstdCompressionDict | None) -> tuple[bytes, int] | None:
    if dictionary is None:
        return None
    data = dictionary.as_bytes()
    full = data[:4] == b"\x37\xa4\x30\xec"  # the format's mark of a trained dictionary
    return data, zstandard.DICT_TYPE_FULLDICT if full else zstandard.DICT_TYPE_RAWCONTENT


def fit_curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Bias and slope of a logistic curve by Newton steps, with a small ridge
    on the slope of the scaled evidence."""
    scale = float(np.abs(x).max()) or 1.0
    a = np.column_stack([np.ones(len(x)), x / scale])
    w, ridge = np.zeros(2), np.diag([1e-6, 1e-2])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve(a.T @ (a * (p * (1 - p) + 1e-9)[:, None]) + ridge, a.T @ (y - p) - ridge @ w)
        w = w + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1]) / scale


def _labelled(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The learning labels ``(doc_id, label, fold)``, one for each id, and the
    rows ``(doc_id, text)`` with an id."""
    known = labels.where("doc_id is not null and quality in (0, 1)").groupBy("doc_id") \
        .agg(F.max("quality").cast("int").alias("label")).withColumn("fold", fold(F.col("doc_id")))
    return cut(known.where(F.col("fold") != HELD_OUT)), docs.where("doc_id is not null").select("doc_id", "text")


def fit(docs: DataFrame, labels: DataFrame) -> dict:
    """Dictionaries and curve from ``labels(doc_id, quality)`` outside the
    held-out fold; three of the other folds give the dictionaries, one the
    curve. Without rows of both classes every score is the share of good
    labels, or 0.5 if there are none."""
    known, texts = _labelled(docs, labels)

    def cut_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for t in batch["text"]:
                yield pd.DataFrame({"piece": [p for p in pieces(t) if len(p) >= LEAST_PIECE]})

    held = []
    for label in (0, 1):
        some = cut(bounded_sample(known.where((F.col("fold") != CURVE_FOLD) & (F.col("label") == label)), "doc_id", MAX_FIT_ROWS))
        got = texts.join(F.broadcast(some), "doc_id").select("text").mapInPandas(cut_up, "piece binary") \
            .orderBy(F.xxhash64("piece"), "piece").limit(SAMPLE_PIECES).toArrow()
        held.append(_kept(train([p.as_py() for p in got["piece"]])))

    some = cut(bounded_sample(known.where(F.col("fold") == CURVE_FOLD), "doc_id", CURVE_ROWS))

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sizes = Sizes(held)
        for batch in batches:
            yield pd.DataFrame({"x": [sizes.evidence(t) for t in batch["text"]], "y": batch["label"].to_numpy(float)})

    got = texts.join(F.broadcast(some), "doc_id").select("text", "label").distinct() \
        .mapInPandas(measure, "x double, y double").orderBy("x", "y").limit(CURVE_ROWS).toArrow()
    x, y = (got[c].to_numpy() for c in "xy")
    share = float(y.mean()) if len(y) else 0.5
    both = 0 < share < 1 and all(held)
    return {"dictionaries": held, "curve": fit_curve(x, y) if both else None, "share": share}


def score(docs: DataFrame, fitted: dict) -> DataFrame:
    """Rows ``(doc_id, score)``, one for each row of ``docs``, by its text only."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sizes, curve = Sizes(fitted["dictionaries"]), fitted["curve"]
        for batch in batches:
            if curve is None:
                p = np.full(len(batch), fitted["share"])
            else:
                x = np.array([sizes.evidence(t) for t in batch["text"]], float)
                p = 1 / (1 + np.exp(-np.clip(curve[0] + curve[1] * x, -30, 30)))
            yield pd.DataFrame({"doc_id": batch["doc_id"], "score": p})

    return docs.select("doc_id", "text").mapInPandas(run, "doc_id long, score double")


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows ``(doc_id, held_out, score, predicted)``, one for each row.

    Null and empty texts get the score of no evidence; null ids and repeated
    rows each come back (a null id counts as held out); of several labels of
    an id the largest counts, null labels and labels of null ids are none;
    empty tables give empty results; other columns are not read.
    """
    return score(docs, fit(docs, labels)).select(
        "doc_id", (fold(F.col("doc_id")) == HELD_OUT).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
