"""Jobs that were once done in part: each test failed before its operator did the whole of it."""

import textwrap

import duckdb

import corpus_pipeline
from questlake.llm import components as linked
from questlake.llm.license_scan import TEMPLATES, scan_licenses
from questlake.llm.notices import notices
from questlake.llm.queries import QUERIES
from tests.llm.test_brute_force import _components


def _runs(text, size):
    w = text.lower().split()
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()


def test_near_dedup_stage_links_at_five_words_and_four_fifths(spark, tmp_path):
    """The stage on raw documents, and the stages after it on what it keeps."""
    sf = "/root/testdata/sf0.01"
    texts = dict(duckdb.sql(f"SELECT doc_id, text FROM '{sf}/documents.parquet'").fetchall())
    ids = sorted(texts)
    component = _components([_runs(texts[i], 5) for i in ids], 80)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[1:]:
        stage(spark, docs, sf).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        kept[name] = docs.collect()
    assert sorted(r.doc_id for r in kept["near_dedup"]) == sorted({ids[c] for c in component})
    dirty = {r.doc_id for r in QUERIES["op1_decontaminate"](spark, sf).collect() if r.contaminated}
    assert {r.doc_id for r in kept["decontaminate"]} == {r.doc_id for r in kept["near_dedup"]} - dirty
    sizes = {r.doc_id: len(r.text.encode().split()) for r in kept["decontaminate"]}
    mixed = sum(sizes[r.doc_id] for r in kept["mixing"])
    assert abs(mixed - 1.5 * sum(sizes.values())) < 0.02 * mixed
    assert sorted(r.doc_id for r in kept["sharding"]) == sorted(r.doc_id for r in kept["mixing"])


def test_wrapped_headers_and_whole_license_files(spark):
    """Notices wrapped at any width, as comments or plain, and license files down to what inherits from them."""
    forms, rows, want = dict(notices()), [], {}
    gnu = "Copyright (C) 2024 Some Body\n\n"
    for name, form, mark, width in (
        ("GPL-3.0", "notice", "# ", 40), ("GPL-3.0", "notice", "", 72), ("LGPL-3.0", "notice", " * ", 60), ("Apache-2.0", "notice", "// ", 50),
        ("Apache-2.0", "notice", "", 45), ("MPL-2.0", "notice", "; ", 50), ("MIT", "text", "-- ", 60), ("BSD-3-Clause", "text", "# ", 78),
    ):
        body = "\n".join(mark + line for line in textwrap.wrap(gnu + forms[f"{name} {form}"], width))
        text = "some words before\n\n" + body + "\n\nint main() { return 0; }\n" * 20
        want[len(rows)] = name
        rows.append((len(rows), f"src/{len(rows)}.c", text))
    for name, form in (("MIT", "text"), ("BSD-3-Clause", "text"), ("GPL-3.0", "full"), ("Apache-2.0", "full"), ("LGPL-3.0", "full"), ("MPL-2.0", "full")):
        at = len(rows)
        text = gnu + "\n".join(textwrap.wrap(forms[f"{name} {form}"], 70))
        want[at] = want[at + 1] = name
        rows += [(at, f"{name}/LICENSE", text), (at + 1, f"{name}/a/b.c", "int x;")]
    prose = " ".join(["the terms of this work and all that you may do with it under any license are in the hands of the reader"] * 50)
    for path, text in (("x/LICENSE", prose), ("x/a.txt", prose.replace(" you ", "\nyou ")), ("x/b.sh", "#!/bin/sh\n# prints the license\n# and ends\n")):
        want[len(rows)] = None
        rows.append((len(rows), path, text))
    files = spark.createDataFrame(rows, "doc_id long, path string, text string").repartition(3)
    templates = spark.createDataFrame(TEMPLATES, "license string, template string")
    got = {r.file_id: r for r in scan_licenses(files, templates).collect()}
    assert {k: r.license for k, r in got.items()} == want
    assert got[9].own is None and got[9].inherited_from == "MIT"


def test_wordless_rows_that_repeat_fully_all_stay(spark):
    text = "one two three four five six seven"
    rows = [(None, None), (None, None), (None, None), (5, ""), (5, ""), (6, " \n\t"), (7, text), (7, text), (8, text)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = corpus_pipeline.near_dedup(spark, docs, "").collect()
    assert sorted(map(tuple, got), key=str) == sorted([*rows[:6], (7, text)], key=str)


def test_components_go_on_until_nothing_moves(spark, monkeypatch):
    monkeypatch.setattr(linked, "_ROUNDS", 1, raising=False)
    links = spark.createDataFrame([(i, i + 1) for i in range(30)], "u long, v long")
    got = linked.components(links).collect()
    assert sorted((r.node, r.component) for r in got) == [(i, 0) for i in range(31)]
