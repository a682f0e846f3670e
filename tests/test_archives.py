"""Zipped CSV files through the data source and back."""

import zipfile

import pytest

from asofmill.sources import archives


def pack(path, **members):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for name, text in members.items():
            z.writestr(f"{name}.csv", text)
    return str(path)


def test_members_are_partitions(spark, tmp_path):
    one = pack(tmp_path / "1.zip", a="﻿x,y\n1,\"a, \"\"b\"\"\"\n2,\n", b="y,x\n\nq,3\nlonely\n")
    pack(tmp_path / "2.zip", a="x,y\n4,\"two\nlines\"\n", empty="")
    rows = lambda frame: sorted(((r.x, r.y) for r in frame.collect()), key=repr)
    got = archives.read(spark, one)
    assert got.columns == ["x", "y"] and got.rdd.getNumPartitions() == 2
    assert rows(got) == sorted([("1", 'a, "b"'), ("2", None), ("3", "q"), (None, "lonely")], key=repr)
    assert rows(archives.read(spark, one, members="first")) == [("1", 'a, "b"'), ("2", None)]
    assert rows(archives.read(spark, str(tmp_path))) == sorted([("1", 'a, "b"'), ("2", None), ("3", "q"), (None, "lonely"), ("4", "two\nlines")], key=repr)
    assert [r.value for r in archives.read(spark, one, "first", lines=True).collect()][1:] == ['1,"a, ""b"""', "2,"]
    with pytest.raises(Exception, match="no-such"):
        archives.read(spark, str(tmp_path / "no-such.zip")).collect()


def test_long_members_come_in_batches(spark, tmp_path, monkeypatch):
    path = pack(tmp_path / "l.zip", a="n,t\n" + "".join(f"{i},{'x' * 50}\n" for i in range(30_000)))
    got = archives.read(spark, path)
    assert got.count() == 30_000 and got.selectExpr("sum(n)").first()[0] == sum(range(30_000))


def test_round_trip(spark, tmp_path):
    rows = [(str(i), None if i % 5 == 0 else f'{i}, "quoted"\nline') for i in range(200)]
    frame = spark.createDataFrame(rows, "a string, b string").repartition(3)
    folder = str(tmp_path / "out")
    assert sum(r.n for r in archives.write(frame, folder).collect()) == 200
    archives.write(frame, folder).collect()  # again: the same archives
    back = archives.read(spark, folder)
    assert back.rdd.getNumPartitions() == 3 and sorted(map(tuple, back.collect()), key=repr) == sorted(rows, key=repr)


def test_archives_grow_in_number(spark):
    """Before, four tasks wrote and read all bars, however many there were."""
    from asofmill import catalog

    held = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "7")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        assert catalog.QUERIES["archived_bars"](spark, "/root/testdata/sf0.001").rdd.getNumPartitions() == 7
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
