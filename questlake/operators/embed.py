"""Embedding a text column with a pluggable model."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from questlake.functions.bound import bound

# Fixed value: texts per call of the model.
BATCH_SIZE = 20

Embedder = Callable[[Sequence[str], str], Sequence[Sequence[float]]]


class HashedWords:
    """Word counts hashed to ``dims`` slots, scaled to length 1.

    ``column`` is the model in Spark's own functions, which is what tables are embedded with; a
    call embeds texts outside Spark, with the same vectors. ``input_type`` "query" counts each word
    of the text once, "document" as often as it occurs.
    """

    def __init__(self, dims: int):
        self.dims = dims
        self._word = re.compile(r"[^\W_]+")

    def _slot(self, token: str) -> int:
        return int(hashlib.md5(token.encode()).hexdigest()[:8], 16) % self.dims

    def __call__(self, texts: Sequence[str], input_type: str) -> np.ndarray:
        out = np.zeros((len(texts), self.dims))
        for i, text in enumerate(texts):
            tokens = self._word.findall(text.lower())
            if input_type == "query":
                tokens = list(set(tokens))
            if tokens:
                out[i] = np.bincount([self._slot(t) for t in tokens], minlength=self.dims)
        norms = np.sqrt((out * out).sum(axis=1))
        return out / np.where(norms > 0, norms, 1.0)[:, None]

    def column(self, text: Column, input_type: str = "document") -> Column:
        """The vector of each text. Each slot's number is sorted in among the words' slots, so that
        the places where the numbers come first tell how many words lie between them."""
        words = F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))
        words = F.array_distinct(words) if input_type == "query" else words
        slots = F.transform(words, lambda w: (F.conv(F.substring(F.md5(w), 1, 8), 16, 10).cast("long") % self.dims).cast("int"))
        ordered = F.array_sort(F.concat(slots, F.sequence(F.lit(0), F.lit(self.dims))))
        starts = lambda all_: F.transform(all_, lambda d, at: F.when(~F.get(all_, at - 1).eqNullSafe(d), at))
        places = F.filter(bound(ordered, starts), lambda at: at.isNotNull())
        counts = bound(places, lambda at: F.transform(F.slice(at, F.lit(1), F.lit(self.dims)), lambda p, d: (F.get(at, d + 1) - p - 1).cast("double")))

        def scaled(n: Column) -> Column:
            norm = F.sqrt(F.aggregate(n, F.lit(0.0), lambda total, x: total + x * x))
            return bound(norm, lambda length: F.transform(n, lambda x: (x / F.greatest(length, F.lit(1.0))).cast("float")))

        return F.when(text.isNotNull(), bound(counts, scaled))


def hashed_words(dims: int = 64) -> HashedWords:
    """The default model: it needs no service and gives the same vector on every worker."""
    return HashedWords(dims)


def embedding(text: Column, embed: Embedder, input_type: str = "document", batch_size: int = BATCH_SIZE) -> Column:
    """The vector of each text, NULL for NULL. A model with a ``column`` is evaluated by Spark alone;
    others are called with at most ``batch_size`` texts, and only the text column goes to Python."""
    if hasattr(embed, "column"):
        return embed.column(text, input_type)

    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            given = part.dropna()
            vectors = []
            for at in range(0, len(given), batch_size):
                result = embed(given.iloc[at : at + batch_size].tolist(), input_type)
                vectors.extend(np.asarray(v, dtype=np.float32) for v in result)
            yield pd.Series(vectors, index=given.index, dtype=object).reindex(part.index).where(lambda s: s.notna(), None)

    # pandas_udf reads the evaluation type from these hints; postponed ones name no local type.
    run.__annotations__ = {"parts": Iterator[pd.Series], "return": Iterator[pd.Series]}
    # Not to be run again for a filter that the optimiser infers from how the result is used.
    return F.pandas_udf(run, T.ArrayType(T.FloatType())).asNondeterministic()(text)


def with_embedding(
    df: DataFrame,
    text: Column,
    embed: Embedder,
    output: str = "embedding",
    input_type: str = "document",
    batch_size: int = BATCH_SIZE,
    partitions: int | None = None,
) -> DataFrame:
    """``df`` with the vector of ``text``. ``partitions`` spreads few, costly rows over that
    many tasks first."""
    spread = df.repartition(partitions) if partitions else df
    return spread.withColumn(output, embedding(text, embed, input_type, batch_size))
