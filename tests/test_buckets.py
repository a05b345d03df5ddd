"""Bucketed directories: written and read without a shuffle by their key."""

from pyspark.sql import functions as F

from salesmart.sources.buckets import BucketedPartitions, read_bucketed, write_bucketed


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def rows(spark, n=1000):
    return spark.range(n).select(F.col("id").alias("k"), (F.col("id") % 3).cast("int").alias("p"), F.lit("it's").alias("t"))


def test_join_reads_buckets_without_a_shuffle(spark, tmp_path):
    path = str(tmp_path / "a'b")
    frame = rows(spark)
    write_bucketed(frame.repartition(4, "k"), path, "k", 4)
    stored = read_bucketed(spark, path, frame.schema, "k", 4)
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, frame.collect()))
    other = spark.range(500, 2000).withColumnRenamed("id", "k")
    joined = stored.join(other.hint("merge"), "k", "left_anti")
    assert plan(joined).count("Exchange hashpartitioning") == 1  # the other side's
    assert joined.count() == 500
    assert "Exchange" not in plan(stored.groupBy("k").count())
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("salesmart_")]


def test_partitions_of_several_writes(spark, tmp_path):
    frame = rows(spark)
    write_bucketed(frame.repartition(4, "k"), str(tmp_path / "v1"), "k", 4, "p")
    again = frame.filter("p = 1").withColumn("t", F.lit("new"))
    write_bucketed(again.repartition(4, "k"), str(tmp_path / "v2"), "k", 4, "p")
    places = [(0, str(tmp_path / "v1/p=0")), (1, str(tmp_path / "v2/p=1"))]
    schema = frame.select("k", "t", "p").schema
    table = BucketedPartitions(spark, str(tmp_path), schema, "k", 4, "p", places)
    found = {(r.p, r.t): r["count"] for r in table.read().groupBy("p", "t").count().collect()}
    assert found == {(0, "it's"): 334, (1, "new"): 333}
    every = table.read().unionByName(table.read()).drop("p")
    write_bucketed(every, str(tmp_path / "v3"), "k", 4)
    written = read_bucketed(spark, str(tmp_path / "v3"), every.schema, "k", 4).groupBy("k").count()
    assert "Exchange" not in plan(written) and {r["count"] for r in written.collect()} == {2}
    by_key = table.read().groupBy("k").count()
    assert "Exchange" not in plan(by_key) and by_key.count() == 667
    other = spark.range(10).withColumnRenamed("id", "k")
    assert plan(table.read().join(other.hint("merge"), "k", "left_semi")).count("Exchange hashpartitioning") == 1
    table.forget()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("salesmart_")]
