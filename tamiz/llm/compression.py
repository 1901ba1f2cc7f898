"""Quality classifier by compression with dictionaries of good and of bad text.

Method: two zstandard dictionaries are trained, on good and on bad labelled texts. Every whole
text is compressed with each; the sizes per byte of text, whose difference says which kind of text
it resembles, become a score through a logistic calibration fitted on labelled texts that no
dictionary has seen. Fitting is bounded: at most `sample` texts a class for the dictionaries and as
many for the calibration, chosen by a hash of the id, so a fit can be repeated. Scoring reads only
the text and runs within each task, without a shuffle.

Nulls: a null text counts as empty; empty texts get the calibration's value for size zero.
Unlabelled rows, rows with a null label and held-out ids are never fitted on. If a class has too
few texts to train a dictionary, its raw texts serve as dictionary; without any labelled text of
a class the score of all texts is the share of label 1, or 0.5 without labels.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tamiz.llm.common import bucket_of, staged, texts
from tamiz.queries.base import table

SAMPLE = 1500
SLICES = 256
DICTIONARY_BYTES = 32 << 10
LEVEL = 1
FOLDS, HELD_OUT = 3, 1


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    weights: tuple[float, ...]

    def compressors(self) -> list[zstandard.ZstdCompressor]:
        made = []
        for content in (self.good, self.bad):
            known = zstandard.ZstdCompressionDict(content)
            known.precompute_compress(level=LEVEL)
            made.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=known))
        return made

    def score(self, sizes: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(features(sizes) @ np.array(self.weights), -500, 500)))


def features(sizes: np.ndarray) -> np.ndarray:
    """From (good size, bad size, length) per text: the normalised difference, also against the
    larger of the two, and how well the text compresses at all."""
    good, bad, n = (sizes[:, k].astype(float) for k in range(3))
    difference = (bad - good) / (n + 1)
    return np.stack(
        [np.ones(len(sizes)), 10 * difference, 10 * (bad - good) / np.maximum(good, bad), good / (n + 1)], axis=1
    )


def sizes_of(found: list[bytes], compressors: list[zstandard.ZstdCompressor]) -> np.ndarray:
    return np.array([[*(len(c.compress(t)) for c in compressors), len(t)] for t in found]).reshape(-1, 3)


def train_dictionary(samples: list[bytes]) -> bytes:
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:DICTIONARY_BYTES]


def fit(docs: DataFrame, labels: DataFrame, label: str, sample: int = SAMPLE) -> Model:
    """Fit on the texts of `docs` and the labels (doc_id, 0 or 1). At most 2 * sample whole
    texts reach the driver for the dictionaries, and as many sizes for the calibration."""
    dice = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    part = F.conv(F.substring(dice, 1, 1), 16, 10).cast("int") % 2
    ids = labels.filter(F.col(label).isin(0, 1)).select("doc_id", F.col(label).cast("int").alias("y"), dice.alias("_dice"), part.alias("_part"))
    # Ids are ranked alone, first in slices of their hashes, then among the first of each slice, so that no task gets
    # a whole class; texts are read for the chosen ones.
    cut = ids.withColumn("_slice", F.conv(F.substring("_dice", -2, 2), 16, 10).cast("int") % SLICES)
    for columns in (["y", "_part", "_slice"], ["y", "_part"]):
        order = Window.partitionBy(*columns).orderBy("_dice")
        cut = cut.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= sample).drop("_rank")
    known = cut.drop("_dice", "_slice")
    chosen = texts(docs).join(F.broadcast(known), "doc_id")
    chosen = staged(chosen.select("y", "_part", "text"), "compression-sample")
    seen = {y: [] for y in (0, 1)}
    for row in chosen.filter("_part = 0").select("y", "text").toLocalIterator():
        seen[row.y].append(row.text.encode())
    if not all(seen.values()):
        share = ids.agg(F.avg("y")).first()[0]
        odds = 0.0 if share is None else float(np.log((share + 1e-6) / (1 - share + 1e-6)))
        return Model(b"", b"", (odds, 0.0, 0.0, 0.0))
    model = Model(train_dictionary(seen[1]), train_dictionary(seen[0]), ())
    measured = chosen.filter("_part = 1").select("text", "y").mapInArrow(sizer(model, ["y"]), "y int, good long, bad long, n long")
    rows = measured.collect()
    y = np.array([r.y for r in rows], float)
    if len(set(y)) < 2:
        return Model(model.good, model.bad, (0.0, 10.0, 0.0, 0.0))
    return Model(model.good, model.bad, calibrate(features(np.array([[r.good, r.bad, r.n] for r in rows])), y))


def calibrate(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, steps: int = 100) -> tuple[float, ...]:
    """Logistic regression by damped Newton steps; the classes count alike, so that 0.5 is the border."""
    weight = np.where(y == 1, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9))
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weight * (y - p)) - ridge * w
        curve = x.T @ (x * (weight * p * (1 - p))[:, None]) + ridge * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w += step * min(1.0, 5 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-9:
            break
    return tuple(float(v) for v in w)


def sizer(model: Model, kept: list[str]):
    """For mapInArrow: the kept columns and both compressed sizes and the length of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressors = model.compressors()
        for batch in batches:
            sizes = sizes_of([v.as_buffer() or b"" for v in batch.column("text").cast(pa.binary())], compressors)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), *(pa.array(sizes[:, k], pa.int64()) for k in range(3))],
                names=[*kept, "good", "bad", "n"],
            )

    return run


def score(docs: DataFrame, model: Model, held_out: Column) -> DataFrame:
    """doc_id, held_out, score, predicted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressors = model.compressors() if model.good else None
        for batch in batches:
            column = batch.column("text").cast(pa.binary())
            if compressors:
                sizes = sizes_of([v.as_buffer() for v in column], compressors)
            else:
                sizes = np.ones((batch.num_rows, 3))
            p = model.score(sizes)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(p), pa.array((p >= 0.5).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    rows = texts(docs).select(F.col("doc_id").cast("long"), "text", held_out.alias("held_out"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def op1_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents scored, fitted on the labels outside the held-out third."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = bucket_of("doc_id", FOLDS) == HELD_OUT
    return score(docs, fit(docs, labels.filter(~held_out), "quality"), held_out)
