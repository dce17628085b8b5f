from pyspark.sql import Window
from pyspark.sql import functions as F

from nbsieve.operators.ordered import rank_by_hash, running_totals, seeded_hash


def test_rank_by_hash_equals_single_window(spark):
    # one class holds ~90 % of the rows
    df = spark.range(0, 3000).select(F.col("id").alias("doc_id"),
                                     F.when(F.col("id") % 10 == 0, "spam").otherwise("ham").alias("label"))
    df = df.withColumn("h", seeded_hash(42, "doc_id"))
    got = rank_by_hash(df, "label", "h", "doc_id", bucket_chars=2)
    ref = df.withColumn("ref", F.row_number().over(Window.partitionBy("label").orderBy("h", "doc_id")))
    j = got.join(ref.select("doc_id", "ref"), "doc_id")
    assert j.where(F.col("rank") != F.col("ref")).count() == 0
    sizes = {r["label"]: r["group_size"] for r in got.select("label", "group_size").distinct().collect()}
    assert sizes == {"spam": 300, "ham": 2700}


def test_running_totals_equal_single_window(spark):
    df = spark.range(0, 2000).select(
        (F.col("id") % 3).alias("m"),
        F.round(F.pow(F.rand(3), 8), 12).alias("s"),  # crowded near 0
        (F.col("id") % 2).alias("pos")).groupBy("m", "s").agg(F.sum("pos").alias("pos"),
                                                              F.count(F.lit(1)).alias("n"))
    got = running_totals(df, ["m"], "s", ["pos", "n"])
    w = Window.partitionBy("m").orderBy("s").rowsBetween(Window.unboundedPreceding, 0)
    ref = df.select("m", "s", F.sum("pos").over(w).alias("rp"), F.sum("n").over(w).alias("rn"))
    j = got.join(ref, ["m", "s"])
    assert j.count() == df.count()
    assert j.where((F.col("cum_pos") != F.col("rp")) | (F.col("cum_n") != F.col("rn"))).count() == 0


def test_exact_percentiles_match_numpy(spark):
    import numpy as np

    from nbsieve.operators.profile import exact_percentiles
    vals = {"a": [5, 1, 1, 9, 3, 3, 3, 120, 7], "b": [2], "c": [4, 8]}
    df = spark.createDataFrame([(k, v) for k, vs in vals.items() for v in vs], "g string, v long")
    qs = (0.25, 0.5, 0.75, 0.9, 0.95)
    got = {r["g"]: r for r in exact_percentiles(df, "g", "v", qs).collect()}
    for g, vs in vals.items():
        for q in qs:
            assert abs(got[g][f"p{int(round(q * 100))}"] - float(np.percentile(vs, q * 100))) < 1e-9
