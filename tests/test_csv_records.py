"""Quoted CSV by quote parity: same rows as Spark's own reader, many tasks."""

import csv
import os
import random

import pytest

from nbsieve.sources import csv_records as R
from nbsieve.sources import loaders as L


@pytest.fixture
def small_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "1500", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def cell(rng):
    if rng.random() < .03:
        return "long\n" * rng.randint(300, 900)          # over several blocks
    return "".join(rng.choice(["a", "b", " ", '"', "\n", ",", "é", "\r\n" if rng.random() < .2 else "z"])
                   for _ in range(rng.randint(0, 60)))


def write(path, header, rows, end="\n"):
    with open(path, "w", newline="") as f:
        w = csv.writer(f, lineterminator=end)
        w.writerow(header)
        w.writerows(rows)


def test_same_rows_in_file_order(spark, tmp_path, small_splits):
    rng = random.Random(1)
    write(tmp_path / "a.csv", ["id", "Message", "Category"], [[i, cell(rng), "spam"] for i in range(250)])
    write(tmp_path / "b c.csv", ["label", "x,y", "Text"], [["0", "q", cell(rng)] for _ in range(250)], "\r\n")
    write(tmp_path / "c+d%.csv", ["Message", "Category"], [[cell(rng), rng.choice(["ham", "1"])] for _ in range(250)])
    (tmp_path / "empty.csv").write_text("Message,Category\n")
    (tmp_path / "none.csv").write_text("")
    (tmp_path / "other.csv").write_text("foo,bar\n1,2\n")
    files = L.list_csv_files(spark, str(tmp_path))
    rows, unpaired, missing = R.labelled_records(spark, files, L.resolve_columns)
    assert unpaired == [] and missing == ["foo,bar"]
    got = {}
    for r in sorted(rows.collect(), key=lambda r: (r["path"], r["position"])):
        got.setdefault(r["path"].split("/")[-1], []).append((r["raw_text"], r["raw_label"]))
    for name, uri in (("a.csv", "a.csv"), ("b c.csv", "b%20c.csv"), ("c+d%.csv", "c+d%25.csv")):
        df = L._read_whole_csv(spark, str(tmp_path / name))
        assert got.pop(uri) == [tuple(r) for r in df.select(*L.resolve_columns(df.columns)).collect()]
    assert got == {}
    kept = L.load_csv_directory(spark, str(tmp_path), limit_per_file=3, numbered=True)
    assert {r["source"]: r["count"] for r in kept.groupBy("source").count().collect()} == {
        "a.csv": 3, "b c.csv": 3, "c+d%.csv": 3}


def test_one_file_is_many_tasks(spark, tmp_path, small_splits):
    rng = random.Random(2)
    write(tmp_path / "one.csv", ["Message", "Category"], [[cell(rng), "ham"] for _ in range(300)])
    states = R.block_states(spark, [str(tmp_path / "one.csv")])
    as_text = spark.read.text(str(tmp_path / "one.csv"))
    assert states.count() >= as_text.rdd.getNumPartitions() > 10
    plan = L.load_csv_directory(spark, str(tmp_path))._jdf.queryExecution().toString()
    assert "multiLine=true" not in plan


def test_files_with_unpaired_quotes_are_read_as_before(spark, tmp_path):
    (tmp_path / "odd.csv").write_text('Message,Category\nfive 5" inch,spam\nplain,ham\n')
    (tmp_path / "fine.csv").write_text('Message,Category\n"two\nlines",spam\n')
    rows = sorted(tuple(r) for r in L.load_csv_directory(spark, str(tmp_path)).collect())
    assert rows == [("fine.csv", "spam", "two\nlines"), ("odd.csv", "ham", "plain"),
                    ("odd.csv", "spam", 'five 5" inch')]


def test_groups_of_files_keep_to_the_limit():
    sizes = [("a", 3), ("b", 4), ("c", 9), ("d", 1)]
    assert R._groups(sizes, 100) == [None]
    assert R._groups(sizes, 7) == [["a", "b"], ["c"], ["d"]]
