"""Quality classifier by compression: text is scored by how well it compresses with a dictionary
built from good text and with one built from bad text.

A text is compressed in short blocks, so that the dictionaries, and not the text's own past, say
how well it compresses. The two sizes, each divided by the text's size, are the features; the
difference of the sizes is calibrated on labelled rows that neither dictionary has seen.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from questlake.llm.common import free_name, texts_of

#: The bounded sample that the model is fitted on: so many labelled rows of either class for the
#: dictionaries, so many others for the calibration, none of more than so many bytes.
DICTIONARY_ROWS, CALIBRATION_ROWS, SAMPLE_BYTES = 1500, 6000, 64 << 10
DICTIONARY_BYTES, BLOCK_BYTES, LEVEL = 112 << 10, 250, 3
_LEAST_BLOCK = 64  # shorter pieces teach a dictionary nothing


@dataclass(frozen=True)
class QualityModel:
    """Two dictionaries, and the weights of ``(size with good, size with bad, 1)``. ``base`` is the
    score of a text without bytes."""

    good: bytes
    bad: bytes
    weights: tuple[float, float, float]
    base: float


def _blocks(text: bytes) -> Iterator[bytes]:
    for start in range(0, len(text), BLOCK_BYTES):
        yield text[start : start + BLOCK_BYTES]


def build_dictionary(texts: list[bytes]) -> bytes:
    """Trained on the blocks of ``texts``; their last bytes as they are if these are too few to train on."""
    samples = [b for text in texts for b in _blocks(text) if len(b) >= _LEAST_BLOCK]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"\n".join(texts)[-DICTIONARY_BYTES:]


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    flags = {"level": LEVEL, "write_content_size": False, "write_checksum": False, "write_dict_id": False}
    if len(dictionary) < 8:  # less than zstd takes for a dictionary
        return zstandard.ZstdCompressor(**flags)
    built = zstandard.ZstdCompressionDict(dictionary)
    built.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(dict_data=built, **flags)


class _Sizer:
    def __init__(self, good: bytes, bad: bytes):
        self.compressors = (_compressor(good), _compressor(bad))

    def sizes(self, text: bytes) -> list[float]:
        return [sum(len(c.compress(b)) for b in _blocks(text)) / len(text) for c in self.compressors]


def _features(good: bytes, bad: bytes) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizer = _Sizer(good, bad)
        for batch in batches:
            sizes = [sizer.sizes(t) for t in texts_of(batch.column("text"))]
            yield pa.RecordBatch.from_pydict(
                {
                    "with_good": pa.array([s[0] for s in sizes], pa.float64()),
                    "with_bad": pa.array([s[1] for s in sizes], pa.float64()),
                    "quality": batch.column("quality"),
                }
            )

    return run


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-4, steps: int = 100) -> np.ndarray:
    """Weights of a logistic regression whose last column of ``x`` is constant, by Newton steps that
    are halved until the loss falls. The ridge holds for columns of unit variance."""
    mean, scale = x.mean(0), x.std(0) + 1e-12
    mean[-1], scale[-1] = 0, 1
    x = (x - mean) / scale

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float(np.mean(np.logaddexp(0, z) - y * z) + ridge / 2 * w[:-1] @ w[:-1])

    w = np.zeros(x.shape[1])
    penalty = ridge * np.r_[np.ones(x.shape[1] - 1), 1e-9]
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        gradient = x.T @ (p - y) / len(y) + penalty * w
        hessian = (x * (p * (1 - p))[:, None]).T @ x / len(y) + np.diag(penalty + 1e-10)
        step = np.linalg.solve(hessian, gradient)
        size = 1.0
        while size > 1e-6 and loss(w - size * step) > loss(w):
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-9:
            break
    w = w / scale
    w[-1] -= w[:-1] @ mean[:-1]
    return w


def held_out(doc_id: str, folds: int = 3, fold: int = 1) -> Column:
    """Whether a row is never learned from: crc32 of its id as text leaves ``fold``. A NULL id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % folds == fold, F.lit(False))


def fit_quality(
    docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", label: str = "quality", rows: tuple[int, int] | None = None
) -> QualityModel:
    """Fit on a bounded sample of the labelled rows that are not held out, chosen by a hash of the id.

    Labels other than 0 and 1, rows without id and documents without text are not learned from.
    Without labels of both classes there is nothing to tell apart: every score is then the share of
    label 1 among what there is, or a half.
    """
    for_dictionary, for_calibration = rows or (DICTIONARY_ROWS, CALIBRATION_ROWS)
    usable = labels.where(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull() & ~held_out(doc_id))
    usable = usable.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("quality")).distinct()
    order = [F.xxhash64("id"), F.col("id"), F.col("quality")]
    # A second hash of the id gives three in four rows to the dictionaries, the others to the calibration.
    learned = F.pmod(F.xxhash64(F.lit("fit"), "id"), F.lit(4)) != 1
    parts = [usable.where(learned & (F.col("quality") == q)).orderBy(*order).limit(for_dictionary) for q in (1, 0)]
    sample = parts[0].union(parts[1]).withColumn("part", F.lit("dictionary"))
    sample = sample.union(usable.where(~learned).orderBy(*order).limit(for_calibration).withColumn("part", F.lit("calibration")))
    texts = docs.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text"))
    short = texts.where(F.octet_length("text").between(1, SAMPLE_BYTES))
    found = short.join(F.broadcast(sample), "id")
    samples: dict[int, list[bytes]] = {0: [], 1: []}
    for row in found.where("part = 'dictionary'").select("id", "quality", "text").dropDuplicates(["id", "quality"]).orderBy("id", "quality").collect():
        samples[row["quality"]].append(row["text"].encode())
    good, bad = build_dictionary(samples[1]), build_dictionary(samples[0])
    calibration = found.where("part = 'calibration'").select("text", "quality")
    fitted = calibration.mapInArrow(_features(good, bad), "with_good double, with_bad double, quality int").toPandas()
    y = fitted["quality"].to_numpy(float)
    base = float((y.sum() + 1) / (len(y) + 2))
    if len(set(y)) < 2:
        return QualityModel(good, bad, (0.0, 0.0, float(np.log(base / (1 - base)))), base)
    x = np.c_[fitted[["with_good", "with_bad"]].to_numpy(), np.ones(len(y))]
    return QualityModel(good, bad, tuple(map(float, logistic(x, y))), base)


def _scores(model: QualityModel, text_name: str, score_name: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizer = _Sizer(model.good, model.bad)
        w_good, w_bad, bias = model.weights
        for batch in batches:
            scores = []
            for text in texts_of(batch.column(text_name)):
                if text:
                    with_good, with_bad = sizer.sizes(text)
                    z = w_good * with_good + w_bad * with_bad + bias
                    scores.append(1 / (1 + np.exp(-min(500.0, max(-500.0, z)))))
                else:
                    scores.append(model.base)
            columns = {n: batch.column(n) for n in batch.schema.names if n != text_name}
            columns[score_name] = pa.array(scores, pa.float64())
            yield pa.RecordBatch.from_pydict(columns)

    return run


def score_quality(docs: DataFrame, model: QualityModel, *, text: str = "text", into: str = "quality_score") -> DataFrame:
    """``docs`` with the column ``into``: the quality of the whole text, from 0 to 1.

    ``into`` must not be a column of ``docs`` (see ``free_name``). NULL and empty texts score
    ``model.base``. The score depends on nothing but the text, so repeated rows score alike. Rows
    are scored where they are read: nothing is shuffled.
    """
    text_name = free_name(docs, "scored_text")
    schema = ", ".join([*(f"`{n}` {t}" for n, t in docs.dtypes), f"`{into}` double"])
    return docs.withColumn(text_name, F.col(text).cast("string")).mapInArrow(_scores(model, text_name, into), schema)
