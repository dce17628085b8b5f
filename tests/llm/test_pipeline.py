"""The pipeline's stages in order, and the guard for a missing subpackage."""

import random
import subprocess
import sys
from collections import Counter
from pathlib import Path

import corpus_pipeline
from tests.llm.helpers import frame, prose


def test_stages_in_order(spark, tmp_path):
    rng = random.Random(4)
    items = [prose(rng, 40) for _ in range(3)]
    good = [prose(rng, 150, "abcdefghijklmnop", 8) for _ in range(30)]
    passage = prose(rng, 80, "qrstuvw", 8)
    texts = good + ["too short"] + [good[0]] + [good[1] + " tail"]
    texts += [prose(rng, 80, "abcdefg", 8) + " " + items[0] + " " + prose(rng, 60, "abcdefg", 8)]
    texts += [prose(rng, 90, "lmnopqrs", 8) + "\n" + passage + "\n" + prose(rng, 90, "lmnopqrs", 8)
              for _ in range(2)]
    frame(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns, seen = docs.columns, {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, str(tmp_path))
        docs.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        seen[name] = docs
        if k < 4:
            assert docs.columns == columns
    ids = lambda n: {r["doc_id"] for r in seen[n].select("doc_id").collect()}
    assert ids("quality_rules") == set(range(len(texts))) - {30}
    assert ids("near_duplicates") == ids("quality_rules") - {31, 32}
    assert ids("repeated_passages") == ids("near_duplicates")
    text = {r["doc_id"]: r["text"] for r in seen["repeated_passages"].collect()}
    assert all(passage not in text[i] for i in (34, 35)) and text[2] == good[2]
    assert ids("benchmark_passages") == ids("repeated_passages") - {33}
    packed = seen["packing"].collect()
    assert {r["doc_id"] for r in packed} == ids("benchmark_passages")
    fill = Counter()
    for r in packed:
        fill[r["sequence_id"]] += r["length"]
    assert max(fill.values()) <= 2048
    whole = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert Counter((r["doc_id"], r["piece"], r["ids_crc32"]) for r in whole) == Counter(
        (r["doc_id"], r["piece"], r["ids_crc32"]) for r in packed)


def test_entry_without_the_subpackage():
    root = str(Path(corpus_pipeline.__file__).parent)
    code = ("import sys; sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e; "
            "assert e.queries() and not any(k.startswith('op') for k in e.queries())")
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, timeout=120)
