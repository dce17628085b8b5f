from pyspark.sql import functions as F

from nbsieve.operators.vocab import top_k_global, top_k_per_group


def test_global_top_k_large_path_equals_limit(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 1009).alias("v"),
                                     F.col("id").cast("string").alias("t")).repartition(7)
    order = [F.desc("v"), F.asc("t")]
    for k in (3, 777):
        got = [tuple(r) for r in top_k_global(df, order, k, small_k=2).collect()]
        ref = [tuple(r) for r in df.orderBy(*order).limit(k).collect()]
        assert sorted(got) == sorted(ref)


def test_top_k_per_group(spark):
    df = spark.createDataFrame([(g, i, (i * 37) % 11) for g in ("a", "b") for i in range(200)],
                               "g string, i long, v long")
    got = top_k_per_group(df, "g", [F.desc("v"), F.asc("i")], 5).collect()
    for g in ("a", "b"):
        rows = sorted([(r["rank"], r["i"]) for r in got if r["g"] == g])
        ref = sorted([(i, v) for gg, i, v in [(g, i, (i * 37) % 11) for i in range(200)]],
                     key=lambda x: (-x[1], x[0]))[:5]
        assert [i for _, i in rows] == [i for i, _ in ref]
