"""What the corpus operators share: words, written tables and joins that survive hot keys.

Every operator reads only the columns it names and returns only the columns it documents, so
other columns of its input can never clash with its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from questlake.session import new_dir

#: Fixed by the contracts: what separates words, and what makes a normalised word.
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
PLAIN_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Bytes of UTF-8 text: A-Z become a-z, all other bytes that are in no plain word become spaces.
PLAIN_TABLE = bytes(
    b | 0x20 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


def plain_words(text: bytes) -> list[bytes]:
    """Words of letters, digits and non-ASCII characters, A-Z lower-cased."""
    return text.translate(PLAIN_TABLE).split()


def sha256_hex(text: bytes) -> str:
    return hashlib.sha256(text).hexdigest()


def texts_of(column: pa.Array) -> Iterator[bytes | None]:
    """The UTF-8 bytes of a string column's values."""
    binary = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    for value in column.cast(binary):
        yield value.as_py()


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: it cuts lineage, and what follows
    reads the same rows however often a task is run again."""
    path = new_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or the first longer one that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def record_hash(df: DataFrame) -> Column:
    """A hash of all columns of a row: with an id it tells rows apart that repeat the id."""
    return F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])


def word_count(text: Column) -> Column:
    """Number of maximal runs without spaces; NULL has none. Each run of spaces between words
    becomes one space first, so counting spaces counts words."""
    one = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " "))
    spaces = F.length(one) - F.length(F.replace(one, F.lit(" "), F.lit("")))
    return F.when(one == "", F.lit(0)).otherwise(spaces + 1).cast("long")


def hot_keys(df: DataFrame, key: Sequence[str], share: int = 1000) -> DataFrame:
    """Keys that hold more than one in ``share`` of all rows, with their row count as ``n_hot``.
    There are fewer than ``share`` of them, which bounds what a broadcast of them can hold."""
    counts = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n_hot"))
    total = df.agg(F.count(F.lit(1)).alias("n_all"))
    return counts.join(F.broadcast(total), F.col("n_hot") * share > F.col("n_all")).drop("n_all")


def lookup(left: DataFrame, right: DataFrame, key: str, hot: DataFrame, fields: Sequence[str]) -> DataFrame:
    """``left`` with ``fields`` of the one row of ``right`` that has its ``key``, NULL if there is none.

    ``hot`` holds the rows of ``right`` whose keys are hot in ``left``; it is bounded by
    construction (see ``hot_keys``) and is broadcast, so a hot key is never shuffled. All other
    keys meet in a shuffled join, in which no key holds more than a small share of the rows.
    """
    small = F.broadcast(hot.select(key, *fields))
    found = left.join(small, key).select(*left.columns, *fields)
    rest = left.join(small.select(key), key, "left_anti")
    return found.unionByName(rest.join(right.select(key, *fields), key, "left").select(*left.columns, *fields))
