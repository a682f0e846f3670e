"""Staged tables: what is written, what goes afterwards."""

import os

from pyspark.sql import functions as F

from asofmill.llm import common, line_dedup, simhash
from asofmill.llm.common import FREE_SHUFFLES, discard, settled, stage


def test_stage_keeps_rows_and_the_session_setting(spark):
    before = spark.conf.get(FREE_SHUFFLES, None)
    counts = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    first = stage(counts, "counts")
    second = stage(first.join(counts.withColumnRenamed("count", "again"), "k"), "joined")
    assert spark.conf.get(FREE_SHUFFLES, None) == before
    assert sorted(first.collect()) == sorted(counts.collect())
    assert second.filter("count = again").count() == 7


def test_discard_removes_the_folder_of_that_table_alone(spark):
    kept, gone = stage(spark.range(3), "kept"), stage(spark.range(0), "gone")
    folder = {f.rsplit("/", 1)[0].removeprefix("file://") for f in gone.inputFiles()}
    discard(gone)
    assert not any(os.path.exists(f) for f in folder)
    assert kept.count() == 3


def test_settled_leaves_nothing_but_its_result(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(common, "shared_dir", lambda spark: f"file://{tmp_path}")
    left = lambda: {f.name.rsplit("-", 1)[0] for d in tmp_path.iterdir() for f in d.iterdir()}
    kept = settled(lambda: settled(lambda: stage(spark.range(5), "inner"), "middle").filter("id > 1"), "outer")
    assert kept.count() == 3 and left() == {"outer"}
    docs = spark.createDataFrame([(1, "one line of text\nthat is long enough"), (2, "that is long enougH\nand one of its own"), (3, None)], "doc_id long, text string")
    lines = line_dedup.dedup_lines(docs, max_edits=3, per_edit=16)
    one = simhash.keep_one(docs, shingle=5, max_bits=8, size=4, repeats=False, forest=simhash.Forest(trees=1, bits=4), similarity=0.8)
    assert left() == {"outer", "gone", "fate"}
    assert lines.filter("n_removed > 0").count() == 1 and one.count() == 3
