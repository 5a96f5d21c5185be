"""License scan: headers and license files are matched to templates, other files inherit.

Every line of a file that speaks of a license is a header, and so is every block of lines: comments,
paragraphs that speak of a license, and such lines with their neighbours. A license file also is one
vector as a whole. Lines are compared with short forms, blocks and whole files with full notices and
license texts (``notices.py``). Headers and templates are sparse vectors of terms weighted by
frequency and rarity, among lines for lines and among blocks and files for these; a header belongs to
the template of the largest cosine. Equal headers are compared once. A file without a license of its
own takes that of the nearest directory above it that has a license file.

Blocks are read twice. The first pass counts in how many blocks each term occurs, the second leaves
out, where it reads them, all blocks that cannot reach the threshold: with the counts of the
templates' terms all is known of a cosine but the rarity of the block's other terms, which weigh
their frequency at least.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from questlake.llm.common import LOWER, UPPER, hot_keys, lookup, written
from questlake.llm.notices import notices

#: Short forms of common license notices by SPDX identifier.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms are permitted under the BSD 3-Clause License."),
    ("CC-BY-4.0", "This work is licensed under the Creative Commons Attribution license, CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under the CC0 1.0 Universal license."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MPL-2.0", "This file is subject to the terms of the Mozilla Public License, version 2.0."),
)
TRIGGER = r"(?i)licen[cs]|copyright|public domain|spdx|redistribution"
TERM = r"[a-z0-9]+(?:[.][0-9]+)*"
THRESHOLD = 0.6
#: More than what rounding can add to a score.
_SLACK = 1e-6
#: Lines beside a line that speaks of a license which belong to its block.
_NEAR = 2
_TRIGGER = re.compile(TRIGGER, re.ASCII)
_MARK = re.compile(r"\s*(?:#+|//+[!/]*|/\*+!?|\*+/?|--+|;+|%+|<!--+|[\"']{3}|dnl\b|(?:rem|REM)\b)")
_MARK_END = re.compile(r"\s*(?:\*+/|--+>|[\"']{3})\s*$")
#: What a line can start or end with that has a comment mark there, and what a text has that speaks of a license.
_MARKS, _MARK_ENDS = frozenset("#/*-;%<\"'drR"), ("/", ">", '"', "'")
_SPOKEN = ("licenc", "licens", "copyright", "public domain", "spdx", "redistribution")
_LINE_END = re.compile(r"\r\n|\n|\r")
_TERM = re.compile(TERM.encode())
#: Terms that a task counts before it sends the counts on.
_HELD_TERMS = 1 << 18


def _terms(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(TERM), F.lit(0))


def blocks(text: str) -> list[str]:
    """The distinct header blocks of a text of more than one line, comment marks taken off: runs of comment
    lines; runs of paragraphs that speak of a license; runs of lines that do with their neighbours."""
    lines = _LINE_END.split(text)
    if len(lines) < 2:
        return []
    comment, plain = [], []
    for line in lines:
        bare = line.strip()
        mark = _MARK.match(bare) if bare and bare[0] in _MARKS else None
        comment.append(mark is not None)
        if mark:
            bare = bare[mark.end() :].strip()
        plain.append(_MARK_END.sub("", bare).strip() if bare.endswith(_MARK_ENDS) else bare)
    runs: list[list[int]] = []

    def close(run: list[int]) -> None:
        if len(run) > 1:
            runs.append(run)

    filled = [i for i, line in enumerate(plain) if line]
    low = text.lower()
    spoken = {i for i in filled if _TRIGGER.search(plain[i])} if any(word in low for word in _SPOKEN) else set()
    run: list[int] = []
    for i, is_comment in enumerate(comment):
        if is_comment or run and not lines[i].strip():
            run += [i] if plain[i] else []
        else:
            close(run)
            run = []
    close(run)
    if spoken:
        paragraphs: list[list[int]] = []
        for i, line in enumerate(plain):
            if not line:
                paragraphs.append([])
            elif i and paragraphs and plain[i - 1] and comment[i - 1] == comment[i]:
                paragraphs[-1].append(i)
            else:
                paragraphs.append([i])
        run = []
        for paragraph in filter(None, paragraphs):
            if spoken.isdisjoint(paragraph):
                close(run)
                run = []
            else:
                run += paragraph
        close(run)
        run, reach = [], -1
        places = {i: at for at, i in enumerate(filled)}
        for at in sorted(places[i] for i in spoken):
            first = max(0, at - _NEAR)
            if first > reach + 1:
                close(run)
                run, reach = [], first - 1
            last = min(len(filled) - 1, at + _NEAR)
            run += filled[max(first, reach + 1) : last + 1]
            reach = last
        close(run)
    return list(dict.fromkeys("\n".join(plain[i] for i in run) for run in runs))


def _found(batch: pa.RecordBatch, license_file: re.Pattern) -> Iterator[list[str]]:
    """The blocks of each row; the text of a license file is one of them."""
    for path, text in zip(batch.column("path").to_pylist(), batch.column("text").to_pylist(), strict=True):
        of = blocks(text) if text else []
        if text and path is not None and license_file.search(path):
            of.append(text)
        yield list(dict.fromkeys(of))


def _block_terms(block: str) -> list[bytes]:
    return _TERM.findall(block.encode().lower())


def _count_terms(license_file: re.Pattern) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Terms with the number of blocks they occur in; the empty term counts all blocks."""

    def sent(counts: Counter) -> pa.RecordBatch:
        terms = pa.array([term.decode() for term in counts], pa.string())
        return pa.RecordBatch.from_pydict({"term": terms, "times": pa.array(list(counts.values()), pa.int64())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for of in _found(batch, license_file):
                counts[b""] += len(of)
                for block in of:
                    counts.update(set(_block_terms(block)))
                if len(counts) > _HELD_TERMS:
                    yield sent(counts)
                    counts.clear()
        yield sent(counts)

    return run


def _reach(templates: list[tuple[str, str]], df: dict[str, int], n: int, damped: bool) -> Callable[[str], float]:
    """A function of a block: a bound that none of its cosines to ``templates`` exceeds.

    ``df`` has the number of blocks, of ``n``, for each term of the templates that occurs. Terms of
    the block that no template has are given the least rarity, 1, which makes the block's norm the least.
    """

    def often(count: int) -> float:
        return 1.0 + math.log(count) if damped else float(count)

    wanted = [Counter(term.decode() for term in _block_terms(text)) for _, text in templates]
    places = {term.encode(): at for at, term in enumerate(sorted(set().union(*wanted)))}
    idf = np.zeros(len(places))
    for term, at in places.items():
        idf[at] = math.log((1.0 + n) / (1.0 + df.get(term.decode(), 0))) + 1.0
    weights = np.zeros((len(places), len(wanted)))
    for column, counts in enumerate(wanted):
        for term, count in counts.items():
            weights[places[term.encode()], column] = often(count) * idf[places[term.encode()]]
    weights /= np.maximum(np.sqrt((weights * weights).sum(axis=0)), 1e-300)

    def reach(block: str) -> float:
        at, own, other = [], [], 0.0
        for term, count in Counter(_block_terms(block)).items():
            place = places.get(term)
            if place is None:
                other += often(count) ** 2
            else:
                at.append(place)
                own.append(often(count))
        if not at:
            return 0.0
        weight = np.array(own) * idf[at]
        return float((weight @ weights[at]).max() / math.sqrt(weight @ weight + other))

    return reach


def _blocks(license_file: re.Pattern, reach: Callable[[str], float], least: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The rows with those of their ``blocks`` that may reach ``least`` instead of their text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[block for block in of if reach(block) >= least] for of in _found(batch, license_file)]
            columns = {n: batch.column(n) for n in ("file_id", "row", "path", "lines")}
            yield pa.RecordBatch.from_pydict(columns | {"blocks": pa.array(found, pa.list_(pa.string()))})

    return run


def match_headers(lines: DataFrame, templates: DataFrame, *, damped: bool = False, among: tuple[DataFrame, int] | None = None) -> DataFrame:
    """``line, license, score`` of the best template of each line that shares a term with one.

    ``lines`` has ``line`` and ``times``, how often it occurs, and a ``key`` if another name is to stand for it. A term's weight is its frequency, or one
    more than the logarithm of it if ``damped``, times ``ln((1 + n) / (1 + df)) + 1`` over all
    occurrences of lines. ``among`` has these (``term``, ``df``) and their number, if ``lines`` are not
    all. Scores have nine digits, so that equal ones tie; ties go to the first identifier.
    """
    often = F.log(F.col("count")) + 1.0 if damped else F.col("count")
    n = among[1] if among else lines.agg(F.coalesce(F.sum("times"), F.lit(0))).first()[0]
    name = F.col("key") if "key" in lines.columns else F.col("line")
    terms = lines.select(name.alias("line"), "times", F.explode(_terms(F.col("line"))).alias("term")).groupBy("line", "times", "term").count()
    terms = written(terms, "terms")
    df = among[0] if among else terms.groupBy("term").agg(F.sum("times").alias("df"))
    wanted = templates.select("license", F.explode(_terms(F.col("template"))).alias("term")).groupBy("license", "term").count()
    idf = F.log((1.0 + n) / (1.0 + F.coalesce("df", F.lit(0)))) + 1.0
    weights = wanted.join(df, "term", "left").withColumn("weight", often * idf)
    norms = weights.groupBy("license").agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("norm"))
    names = [row["license"] for row in templates.select("license").distinct().orderBy("license").collect()]
    share = lambda name: F.coalesce(F.max(F.when(F.col("license") == name, F.col("weight") / F.col("norm"))), F.lit(0.0))
    sides = weights.join(norms, "license").groupBy("term").agg(F.array(*map(share, names)).alias("shares"))

    busy = hot_keys(terms, ["term"])
    rated = lookup(terms, df, "term", df.join(F.broadcast(busy), "term", "left_semi"), ["df"]).withColumn("weight", often * idf)
    rated = rated.join(F.broadcast(sides), "term", "left")  # a row per term of the templates
    norm = F.sqrt(F.sum(F.col("weight") * F.col("weight")))
    dots = [F.sum(F.col("weight") * F.coalesce(F.get("shares", F.lit(at)), F.lit(0.0))).alias(f"dot_{at}") for at in range(len(names))]
    scored = rated.groupBy("line").agg(norm.alias("norm"), *dots)
    best = F.array_max(F.array(*[F.struct(F.round(F.col(f"dot_{at}") / F.col("norm"), 9).alias("score"), F.lit(-at).alias("at")) for at in range(len(names))]))
    found = scored.select("line", best.alias("best")).where("best.score > 0")
    return found.select("line", F.element_at(F.array(*map(F.lit, names)), 1 - F.col("best.at")).alias("license"), F.col("best.score").alias("score"))


def ancestors(path: Column) -> Column:
    """Directories above a path, each with its depth."""
    parts = F.split(path, "/")
    return F.transform(F.slice(parts, F.lit(1), F.size(parts) - 1), lambda _, at: F.struct(at.alias("depth"), F.array_join(F.slice(parts, F.lit(1), at + 1), "/").alias("dir")))


def scan_licenses(
    files: DataFrame,
    templates: DataFrame,
    *,
    file_id: str = "doc_id",
    path: str = "path",
    text: str = "text",
    license_file: str = r"(?i)(^|/)(licen[cs]e|copying|notice)[^/]*$",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Per row of ``files``: ``file_id``, ``row`` (its number in the input), ``own`` (license its headers
    state), ``score`` (their best cosine), ``license`` (own or inherited) and ``inherited_from``.

    ``templates`` is a small table of ``license`` and ``template`` for single lines, broadcast by its terms;
    blocks and whole license files meet the notices and texts of its licenses. NULL and
    empty texts have no headers and inherit; texts are read whole, however long. Other columns are not
    read, so none can clash. A NULL path has no directories and inherits nothing. Of
    several license files in a directory, the one with the best score counts, then the first license.
    Repeated rows are files of their own.
    """
    spark, name = files.sparkSession, re.compile(license_file)
    known = {row["license"] for row in templates.select("license").distinct().collect()}
    texts = [(form, words) for form, words in notices() if form.split(" ", 1)[0] in known]
    given = files.select(F.col(path).alias("path"), F.col(text).cast("string").alias("text"))
    counted = given.mapInArrow(_count_terms(name), "term string, times long")
    counted = written(counted.groupBy("term").agg(F.sum("times").alias("df")), "terms")
    n_blocks = counted.where("term = ''").agg(F.coalesce(F.sum("df"), F.lit(0))).first()[0]
    df = counted.where("term <> ''")
    of_texts = spark.createDataFrame(texts, "license string, template string").select(F.explode(_terms(F.col("template"))).alias("term")).distinct()
    rarity = {row["term"]: row["df"] for row in df.join(F.broadcast(of_texts), "term", "left_semi").collect()}
    reach = _reach(texts, rarity, n_blocks, damped=True) if texts else lambda block: 0.0

    rows = files.select(
        F.col(file_id).alias("file_id"),
        F.monotonically_increasing_id().alias("row"),
        F.col(path).alias("path"),
        F.col(text).cast("string").alias("text"),
        F.array_distinct(F.filter(F.split(F.coalesce(F.col(text).cast("string"), F.lit("")), "\n"), lambda line: line.rlike(TRIGGER))).alias("lines"),
    )
    kind = dict(rows.dtypes)["file_id"]
    schema = f"file_id {kind}, row long, path string, lines array<string>, blocks array<string>"
    rows = written(rows.mapInArrow(_blocks(name, reach, threshold - _SLACK), schema), "headers")
    wide = rows.select("row", F.explode("blocks").alias("line"))
    wide = wide.withColumn("key", F.concat_ws(" ", F.xxhash64("line"), F.xxhash64("line", F.lit(1))))
    each = rows.select("row", F.explode("lines").alias("line"))
    lines = written(each.groupBy("line").agg(F.count(F.lit(1)).alias("times")), "lines")
    matched = written(match_headers(lines, templates).where(F.col("score") >= threshold), "matched")
    busy = lines.where(F.col("times") * 1000 > lines.agg(F.coalesce(F.sum("times"), F.lit(0))).first()[0])
    hot = matched.join(F.broadcast(busy.select("line")), "line", "left_semi")
    stated = lookup(each, matched, "line", hot, ["license", "score"]).where("license IS NOT NULL")

    once = written(wide.groupBy("key").agg(F.first("line").alias("line"), F.count(F.lit(1)).alias("times")), "blocks")
    full = spark.createDataFrame(texts, "license string, template string")
    best = match_headers(once, full, damped=True, among=(df, n_blocks)).where(F.col("score") >= threshold)
    best = written(best.withColumn("license", F.substring_index("license", " ", 1)), "matched")
    hot = best.join(F.broadcast(hot_keys(wide, ["key"]).select(F.col("key").alias("line"))), "line", "left_semi")
    keyed = wide.select("row", F.col("key").alias("line"))
    stated = stated.union(lookup(keyed, best, "line", hot, ["license", "score"]).where("license IS NOT NULL").select(*stated.columns))
    order = F.struct((-F.col("score")).alias("worse"), "license")
    own = written(stated.groupBy("row").agg(F.min(order).alias("best")), "own")

    files_ = rows.join(own, "row", "left").select("file_id", "row", "path", F.col("best.license").alias("own"), (-F.col("best.worse")).alias("score"))
    files_ = written(files_, "files")
    in_dir = files_.where(F.col("own").isNotNull() & F.col("path").rlike(license_file))
    in_dir = in_dir.withColumn("dir", F.try_element_at(ancestors(F.col("path")), F.lit(-1))["dir"]).where("dir IS NOT NULL")
    dirs = written(in_dir.groupBy("dir").agg(F.min(F.struct((-F.col("score")).alias("worse"), F.col("own").alias("license"))).alias("best")), "dirs")
    dirs = dirs.select("dir", F.col("best.license").alias("license"))
    above = files_.where("own IS NULL").select("row", F.inline(ancestors(F.col("path"))))
    busy = hot_keys(above, ["dir"])
    met = lookup(above, dirs, "dir", dirs.join(F.broadcast(busy), "dir", "left_semi"), ["license"]).where("license IS NOT NULL")
    nearest = met.groupBy("row").agg(F.max(F.struct("depth", "dir", "license")).alias("near"))
    told = files_.join(nearest, "row", "left")
    return told.select("file_id", "row", "own", "score", F.coalesce("own", "near.license").alias("license"), F.col("near.dir").alias("inherited_from"))
