"""Versioned bundle and histogram selection."""

import os
import random

import pytest

from nbsieve.operators import nb
from nbsieve.operators.vocab import strongest
from nbsieve.sources import manifest
from nbsieve.sources import model_io as MIO


def model(spark, word):
    rows = [("spam", f"win cash {word}"), ("spam", f"cash {word} claim"), ("ham", "lunch meeting"), ("ham", "meeting lunch")]
    return nb.fit(nb.tokenize(spark.createDataFrame(rows, "label string, text string")))


def tokens(m):
    return {r["token"] for r in m.counts.select("token").collect()}


def test_a_stopped_writer_leaves_the_old_bundle(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "bundle")
    assert not MIO.model_exists(spark, path)
    with pytest.raises(RuntimeError):
        MIO.load_model(spark, path)
    MIO.save_model(model(spark, "prize"), path)
    old, _ = MIO.load_model(spark, path, verify=True)
    calls = []

    def stop(df, real=MIO._checksum):
        calls.append(1)
        if len(calls) == 2:
            raise KeyboardInterrupt
        return real(df)
    monkeypatch.setattr(MIO, "_checksum", stop)
    with pytest.raises(KeyboardInterrupt):
        MIO.save_model(model(spark, "lottery"), path)
    monkeypatch.undo()
    assert len(manifest.names(spark, f"{path}/versions")) == 2
    m, _ = MIO.load_model(spark, path, verify=True)
    assert "prize" in tokens(m) and "lottery" not in tokens(m)
    for word in ("alpha", "beta", "gamma"):
        MIO.save_model(model(spark, word), path)
        assert word in tokens(MIO.load_model(spark, path, verify=True)[0])
    assert len(manifest.names(spark, f"{path}/versions")) == MIO.KEEP_VERSIONS
    assert len(manifest.names(spark, f"{path}/manifests")) == MIO.KEEP_VERSIONS


def test_a_changed_table_is_noticed(spark, tmp_path):
    path = str(tmp_path / "bundle")
    version = MIO.save_model(model(spark, "prize"), path)
    spark.createDataFrame([("other", 1, 1, 1, 1)], MIO.load_model(spark, path)[0].counts.schema).write.mode(
        "append").parquet(f"{path}/versions/{version}/counts")
    MIO.load_model(spark, path)
    with pytest.raises(RuntimeError, match="counts"):
        MIO.load_model(spark, path, verify=True)


def test_train_from_sources_once(spark, tmp_path):
    path, calls = str(tmp_path / "bundle"), []

    def sources():
        calls.append(1)
        return spark.createDataFrame([("spam", "win cash"), ("spam", "win cash"), ("ham", "lunch today"),
                                      ("ham", "lunch today")], "label string, text string")
    first = tokens(MIO.load_or_train(spark, path, sources))
    assert first == tokens(MIO.load_or_train(spark, path, sources)) == {
        "win", "cash", "win_cash", "lunch", "today", "lunch_today"} and len(calls) == 1
    assert os.path.isdir(f"{path}/manifests")


def test_strongest_equals_the_sort(spark):
    rng = random.Random(1)
    for values in ([rng.random() for _ in range(3000)], [rng.choice([0.1, 0.5, 0.5 + 1e-12]) for _ in range(3000)],
                   [0.0] * 500, [10.0 ** rng.randint(-9, 9) for _ in range(2000)]):
        rows = [(f"t{i:05d}", v) for i, v in enumerate(values)]
        df = spark.createDataFrame(rng.sample(rows, len(rows)), "token string, score double").repartition(5)
        for k in (1, 37, 400, 499, 5000):
            want = sorted(rows, key=lambda r: (-r[1], r[0]))[:k]
            assert sorted(tuple(r) for r in strongest(df, "score", "token", k, bins=16).collect()) == sorted(want)
