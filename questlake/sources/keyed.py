"""A keyed table that is never overwritten: commits, and a manifest that says which of them count.

Rows lie in folders ``commit=<name>/bucket=<n>`` that no later commit touches. A first commit, and a
compaction, spreads rows over hash buckets; an upsert adds its rows, however few, as one delta (bucket -1).
A version is one small file that lists the live commits. It is put in place by a rename that fails if the
version is already there, so a job that dies before leaves the table as it was, and of two writers one is
told to begin again. Readers merge deltas over the buckets: a newer row hides older ones of its key.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from questlake.operators.merge import upsert_by_key
from questlake.session import materialise, shredded_variants
from questlake.sources import hdfs

#: Deltas that a table keeps before it is compacted, and the part of all rows (one in so many) that is merged sooner.
MOST_DELTAS, LARGE_SHARE = 8, 2
_VERSIONS, _DELTA = "_versions", -1


class ConcurrentWrite(Exception):
    """Another job has committed the version that this one was about to."""


class Changed(NamedTuple):
    """What an upsert wrote: new keys, and rows that replace stored ones."""

    inserted: int
    updated: int


def _version_file(path: str, version: int) -> str:
    return f"{path}/{_VERSIONS}/{version:020d}.json"


def manifest(spark: SparkSession, path: str) -> dict | None:
    """The latest version, or None if nothing was ever committed."""
    names = hdfs.child_files(spark, f"{path}/{_VERSIONS}")
    names = [n for n in names if n.endswith(".json")]
    return json.loads(hdfs.read_small(spark, f"{path}/{_VERSIONS}/{names[-1]}")) if names else None


def notes(spark: SparkSession, path: str) -> dict:
    """What the last writer left with its commit."""
    return (manifest(spark, path) or {}).get("notes", {})


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _rows(spark: SparkSession, path: str, state: dict, touched: Sequence[int] | None = None) -> DataFrame:
    schema = T.StructType.fromJson(state["schema"])
    parts, newer = [], None
    for entry in reversed(state["live"]):
        folder = f"{path}/commit={entry['commit']}"
        rows = spark.read.schema(T.StructType([*schema.fields, T.StructField("bucket", T.IntegerType())])).parquet(folder)
        if entry["kind"] == "base" and touched is not None:
            rows = rows.where(F.col("bucket").isin(list(touched)))
        if entry.get("without"):
            rows = rows.where(~F.col("bucket").isin(entry["without"]))
        rows = rows.drop("bucket")
        parts.append(rows if newer is None else rows.join(newer, state["key"], "left_anti").select(*schema.names))
        if entry["kind"] == "update":
            keys = rows.select(state["key"])
            newer = keys if newer is None else newer.union(keys)
    result = parts[-1]
    for part in reversed(parts[:-1]):
        result = result.unionByName(part)
    return result


def read_keyed(spark: SparkSession, path: str) -> DataFrame:
    """The table as of its latest version. Stored rows are not shuffled: only deltas that replace rows are
    joined, by their keys, and those are few before a compaction merges them."""
    state = manifest(spark, path)
    if state is None:
        raise FileNotFoundError(f"no version of a keyed table at {path}")
    return _rows(spark, path, state)


def _write(rows: DataFrame, path: str, version: int) -> tuple[str, int]:
    """Write a commit's folder under a name of its own; returns the name and the row count."""
    name, counted = f"{version:010d}-{uuid.uuid4().hex[:12]}", Observation()
    with shredded_variants(rows.sparkSession):
        rows.observe(counted, F.count(F.lit(1)).alias("n")).write.partitionBy("bucket").parquet(f"{path}/commit={name}")
    return name, counted.get["n"]


def _commit(spark: SparkSession, path: str, state: dict) -> None:
    if not hdfs.create_small(spark, _version_file(path, state["version"]), json.dumps(state)):
        raise ConcurrentWrite(f"version {state['version']} of {path} was committed by another job")


def _as_base(rows: DataFrame, key: str, buckets: int) -> DataFrame:
    return rows.withColumn("bucket", _bucket(key, buckets)).hint("rebalance", "bucket").sortWithinPartitions("bucket", key)


def upsert(
    changes: DataFrame,
    path: str,
    key: str,
    update: Sequence[str],
    stamps: dict[str, Column] | None = None,
    buckets: int = 64,
    notes: dict | None = None,
    most_deltas: int = MOST_DELTAS,
) -> Changed:
    """Merge ``changes``, with unique keys, into the table at ``path``, as ``upsert_by_key`` does.

    What is written are the changed rows alone, in as many files as their size asks for. ``notes`` are kept with
    the version, so that a job's progress and its rows are committed together. Beyond ``most_deltas`` deltas, or
    when they hold a large share of the rows, the buckets they fall into are rewritten as a new commit. The
    first commit fixes key, columns and ``buckets``. A NULL key is an error, as for a primary key.
    """
    spark = changes.sparkSession
    checked = F.when(F.col(key).isNull(), F.raise_error(F.lit(f"{key} must not be null"))).otherwise(F.col(key))
    incoming = changes.withColumn(key, checked)
    state = manifest(spark, path)
    if state is None:
        rows = incoming.withColumns(stamps or {})
        name, n = _write(_as_base(rows, key, buckets), path, 1)
        live = [{"commit": name, "kind": "base", "rows": n}]
        _commit(spark, path, {"version": 1, "key": key, "buckets": buckets, "schema": rows.schema.jsonValue(), "live": live, "notes": notes or {}})
        return Changed(n, 0)
    incoming = materialise(incoming, "changes")
    met = materialise(_rows(spark, path, state).join(incoming.select(key), key, "left_semi"), "met")
    rows = upsert_by_key(met, incoming, key, update, stamps)
    updated = met.count()
    version = state["version"] + 1
    name, n = _write(rows.withColumn("bucket", F.lit(_DELTA)).hint("rebalance"), path, version)
    entry = [{"commit": name, "kind": "update" if updated else "insert", "rows": n}] if n else []
    state = {**state, "version": version, "live": state["live"] + entry, "notes": {**state["notes"], **(notes or {})}}
    _commit(spark, path, state)
    deltas = [e["rows"] for e in state["live"] if e["kind"] != "base"]
    if len(deltas) > most_deltas or sum(deltas) * LARGE_SHARE > sum(e["rows"] for e in state["live"]):
        compact(spark, path)
    return Changed(n - updated, updated)


def compact(spark: SparkSession, path: str) -> bool:
    """Merge all deltas into the buckets that they fall into; other buckets stay where they are. Returns whether
    there was something to do. At most as many bucket numbers as there are buckets are collected."""
    state = manifest(spark, path)
    deltas = [e for e in state["live"] if e["kind"] != "base"] if state else []
    if not deltas:
        return False
    key, buckets, version = state["key"], state["buckets"], state["version"] + 1
    stored = spark.read.option("basePath", path).parquet(*[f"{path}/commit={e['commit']}" for e in deltas])
    keys = stored.select(_bucket(key, buckets).alias("bucket"))
    touched = sorted(r.bucket for r in keys.distinct().collect())
    name, n = _write(_as_base(_rows(spark, path, state, touched), key, buckets), path, version)
    live = [{**e, "without": sorted({*e.get("without", []), *touched})} for e in state["live"] if e["kind"] == "base"]
    live = [e for e in live if len(e["without"]) < buckets]
    _commit(spark, path, {**state, "version": version, "live": [*live, {"commit": name, "kind": "base", "rows": n}]})
    return True


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Delete the commits that the last ``keep`` versions do not list, and older versions; returns the commits'
    names. Commits of a version that is still being written are newer than those and stay."""
    names = [n for n in hdfs.child_files(spark, f"{path}/{_VERSIONS}") if n.endswith(".json")][-keep:]
    kept = [json.loads(hdfs.read_small(spark, f"{path}/{_VERSIONS}/{n}")) for n in names]
    if not kept:
        return []
    wanted, newest = {e["commit"] for state in kept for e in state["live"]}, kept[-1]["version"]
    folders = [f.partition("=")[2] for f in hdfs.child_folders(spark, path) if f.startswith("commit=")]
    gone = [c for c in folders if c not in wanted and int(c.partition("-")[0]) <= newest]
    for commit in gone:
        hdfs.delete_folder(spark, f"{path}/commit={commit}")
    for version in range(1, kept[0]["version"]):
        if hdfs.exists(spark, _version_file(path, version)):
            hdfs.delete_folder(spark, _version_file(path, version))
    return gone
