"""Loads that are logged per batch, and staging that reads only what came since its last run."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from questlake.functions.variant import Field
from questlake.plans import staged, staging
from questlake.plans.staged import read_staged, stage_new_batches
from questlake.sources import hdfs, keyed
from questlake.streaming.incremental import batches, load_log, load_new_files, read_raw_table

FIELDS = [Field("id", "$.id", "bigint"), Field("name", "$.name", "string"), Field("n", "$.n", "int")]


@pytest.fixture
def lake(spark, tmp_path):
    (tmp_path / "in").mkdir()

    class Lake:
        source, target, checkpoint, store = (str(tmp_path / n) for n in ("in", "raw", "checkpoint", "staged"))

        def land(self, name, *docs):
            lines = [d if isinstance(d, str) else json.dumps(d) for d in docs]
            (tmp_path / "in" / name).write_text("".join(f"{line}\n" for line in lines))

        def load(self, day=1, **how):
            return load_new_files(spark, self.source, self.target, self.checkpoint, dt.datetime(2026, 1, day), **how)

        def stage(self, **how):
            return stage_new_batches(spark, self.target, self.store, FIELDS, buckets=4, **how)

        def rows(self):
            return sorted((tuple(r) for r in read_staged(spark, self.store).collect()), key=str)

        def full(self):
            ties = [F.desc("source_file"), F.asc("line_hash")]
            return sorted((tuple(r) for r in staging.latest(read_raw_table(spark, self.target), FIELDS, ties=ties).collect()), key=str)

    return Lake()


def test_a_batch_that_is_run_again_counts_once(spark, lake, monkeypatch):
    lake.land("a", {"id": 1}, "{bad", {"id": 2})
    real = hdfs.replace_small

    def dies(*args):
        raise RuntimeError("killed")

    monkeypatch.setattr(hdfs, "replace_small", dies)
    with pytest.raises(Exception, match="killed"):
        lake.load()
    assert read_raw_table(spark, lake.target).count() == 0 and load_log(spark, lake.target).count() == 0
    monkeypatch.setattr(hdfs, "replace_small", real)
    assert lake.load() == (2, 1) and lake.load() == (0, 0)
    assert read_raw_table(spark, lake.target).count() == 2
    for i in range(3):
        lake.land(f"b{i}", {"id": i})
    assert lake.load(2, files_per_batch=1) == (3, 0)
    log = [(r.batch, r.loaded, r.rejected) for r in load_log(spark, lake.target).orderBy("batch").collect()]
    assert log == [(0, 2, 1), (1, 1, 0), (2, 1, 0), (3, 1, 0)] and batches(spark, lake.target, 1) == [2, 3]


def test_counting_does_not_read_the_table(spark, lake, monkeypatch):
    lake.land("a", {"id": 1})
    assert lake.load() == (1, 0)
    lake.land("b", {"id": 2})

    def read(*args):
        raise AssertionError("the raw table was read")

    from questlake.streaming import incremental

    monkeypatch.setattr(incremental, "_rows", read)
    assert lake.load(2) == (1, 0)


def test_staging_reads_new_files_only(spark, lake, monkeypatch):
    lake.land("a", *[{"id": i, "name": "old"} for i in range(20)])
    lake.load(1)
    assert lake.stage() == {"batches": 1, "inserted": 20, "updated": 0}
    lake.land("b", {"id": 3, "name": "new"}, {"id": 77, "name": "new"}, {"name": "no key"})
    lake.load(2)
    seen = []
    real = staged.latest
    monkeypatch.setattr(staged, "latest", lambda raw, *a, **k: seen.append(raw.inputFiles()) or real(raw, *a, **k))
    assert lake.stage() == {"batches": 1, "inserted": 1, "updated": 1}
    assert seen[0] and all("/batch=1/" in f for f in seen[0])
    assert lake.stage() == {"batches": 0, "inserted": 0, "updated": 0}
    assert lake.rows() == lake.full() and len(lake.rows()) == 21


def test_increments_equal_a_full_run(spark, lake):
    draw = random.Random(2)
    for day in (3, 1, 4, 2):  # a load with an older time than the last does not win
        docs = [{"id": draw.choice([None, *range(12)]), "name": f"{day}-{i}", "n": draw.choice([1.5, "2", None])} for i in range(15)]
        lake.land(f"f{day}", *docs, {"name": "no key"}, {"id": 1, "name": f"{day}-twice"}, {"id": 1, "name": f"{day}-twice"})
        lake.load(day)
        lake.stage()
        assert lake.rows() == lake.full()
    assert any(r[0] is None for r in lake.rows())


def test_staging_that_dies_is_run_again(spark, lake, monkeypatch):
    lake.land("a", {"id": 1, "name": "x"}, {"id": 2, "name": "x"})
    lake.load(1)
    lake.stage()
    lake.land("b", {"id": 2, "name": "y"}, {"id": 5, "name": "y"})
    lake.load(2)
    before = lake.rows()

    def dies(*args):
        raise RuntimeError("killed")

    with monkeypatch.context() as patch:
        patch.setattr(keyed, "_commit", dies)
        with pytest.raises(RuntimeError):
            lake.stage()
    assert lake.rows() == before and keyed.notes(spark, lake.store) == {"through": 0}
    assert lake.stage() == {"batches": 1, "inserted": 1, "updated": 1} and lake.rows() == lake.full()
    lake.land("c", {"id": 9, "n": "many"})
    lake.load(3)
    with pytest.raises(Exception, match="do not cast: n"):
        lake.stage()
    assert lake.stage(strict=False)["inserted"] == 1 and lake.rows()[-1] == (9, None, None)
