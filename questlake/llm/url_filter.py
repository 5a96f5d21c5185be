"""URL filters by a temporal list join: a capture is judged by the lists as they stood when it was fetched.

A list is a history of dated entries: a key (a domain, or a host with a leading part of its path)
is added or removed on a day. A key's entries become intervals in which it is listed. A capture
has as keys its host, the domains above it, and each leading part of its path. It meets the
intervals of its keys by an equality join, and those that hold its fetch time decide.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from questlake.llm.common import hot_keys, lookup, written


def url_keys(url: Column) -> Column:
    """Keys of a URL, none if it has no host: ``a.b.c``, ``b.c``, ``c``, ``a.b.c/d``, ``a.b.c/d/e``."""
    rest = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^?#]*)", 1)
    host = F.lower(F.regexp_replace(F.substring_index(rest, "/", 1), r":[0-9]*$", ""))
    labels = F.split(host, r"\.")
    parts = F.filter(F.split(F.substring(rest, F.length(F.substring_index(rest, "/", 1)) + 2, 1 << 30), "/"), lambda p: p != "")
    domains = F.transform(labels, lambda _, at: F.array_join(F.slice(labels, at + 1, F.size(labels)), "."))
    paths = F.transform(parts, lambda _, at: F.concat(host, F.lit("/"), F.array_join(F.slice(parts, F.lit(1), at + 1), "/")))
    return F.when(host == "", F.expr("cast(array() AS array<string>)")).otherwise(F.array_distinct(F.concat(domains, paths)))


def intervals(entries: DataFrame) -> DataFrame:
    """``key`` with ``listed``: its intervals as an array of ``(list, since, until)``, until NULL if open.

    ``entries`` has ``list, key, since, listed``. Of entries for one day, list and key, a removal
    counts. An entry that changes nothing makes no interval. Entries without key or day are ignored.
    """
    days = entries.where("key IS NOT NULL AND since IS NOT NULL").groupBy("list", "key", "since").agg(F.min("listed").alias("listed"))
    by_day = Window.partitionBy("list", "key").orderBy("since")
    changes = days.withColumn("was", F.lag("listed").over(by_day)).where(F.coalesce(F.col("was") != F.col("listed"), F.col("listed")))
    spans = changes.withColumn("until", F.lead("since").over(by_day)).where("listed")
    return spans.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("list", "since", "until"))).alias("listed"))


def judge_captures(captures: DataFrame, entries: DataFrame, *, capture_id: str = "page_id", url: str = "url", fetched: str = "fetched") -> DataFrame:
    """Per row of ``captures``: ``capture_id``, ``row`` (its number in the input), ``n_entries`` (list
    entries active at its fetch time), ``lists`` (their names, sorted) and ``blocked``.

    A NULL URL or one without host, and a NULL fetch time, meet nothing. Repeated rows are judged
    one by one; NULL ids are ids like others. No lists or no captures give no matches or no rows.
    A key that many captures share is not shuffled: its intervals go to the captures.
    """
    rows = captures.select(
        F.col(capture_id).alias("capture_id"), F.monotonically_increasing_id().alias("row"), F.col(fetched).alias("at"), url_keys(F.col(url)).alias("keys")
    )
    rows = written(rows, "captures")
    spans = written(intervals(entries), "intervals")
    keyed = rows.where("at IS NOT NULL").select("row", "at", F.explode("keys").alias("key"))
    busy = hot_keys(keyed, ["key"])
    met = lookup(keyed, spans, "key", spans.join(F.broadcast(busy), "key", "left_semi"), ["listed"]).where("listed IS NOT NULL")
    active = F.filter("listed", lambda s: (s["since"] <= F.col("at")) & (s["until"].isNull() | (s["until"] > F.col("at"))))
    found = met.select("row", F.transform(active, lambda s: s["list"]).alias("lists")).where("size(lists) > 0")
    found = found.groupBy("row").agg(F.flatten(F.collect_list("lists")).alias("lists"))
    lists = F.array_sort(F.array_distinct(F.coalesce("lists", F.expr("cast(array() AS array<string>)"))))
    n = F.coalesce(F.size("lists"), F.lit(0))
    judged = rows.select("capture_id", "row").join(found, "row", "left")
    return judged.select("capture_id", "row", F.when(F.col("lists").isNull(), 0).otherwise(n).cast("long").alias("n_entries"), lists.alias("lists")).withColumn("blocked", F.col("n_entries") > 0)
