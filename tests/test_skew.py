"""Hot keys: joins split them at run time, windows and lists never hold them whole."""

import contextlib

import pytest
from pyspark.sql import functions as F

from millrace.operators import changes, graph, ordered, params, routing, validate

TINY = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@contextlib.contextmanager
def tiny_partitions(spark):
    before = {k: spark.conf.get(k, None) for k in TINY}
    for k, v in TINY.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hot(spark, n=60_000):
    """A third of all rows have one key."""
    key = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 500))
    return spark.range(0, n, 1, 8).select(
        F.lit("p").alias("pipeline_id"), key.alias("key"), "id", F.xxhash64("id").alias("noise")
    )


def keys(spark):
    """Known keys, each many times; every other key is unknown."""
    return hot(spark).where("key = 'hot' OR cast(substring(key, 2, 9) as int) % 2 = 0")


def final_plan(df):
    count = df.select(F.count("*"), F.sum(F.hash(*df.columns)))
    result = count.collect()[0][0]
    return result, count._jdf.queryExecution().executedPlan().toString()


def cases(spark):
    rows, known = hot(spark), keys(spark)
    yield validate.dangling_refs(rows, known, [("pipeline_id", "pipeline_id"), ("key", "key")])
    nodes = known.select("pipeline_id", F.col("key").alias("name"), F.col("id").alias("pos"),
                         F.col("key").alias("id"))
    edges = rows.select("pipeline_id", F.col("key").alias("source"), F.lit("k2").alias("destination"), "noise")
    yield changes.look_up_edges(edges, nodes)
    waits = routing.wait_notify(rows, known, "key", 100)
    yield waits["waiting"]
    queue = rows.select(F.col("key").alias("connection_id"), "id", F.lit(1).alias("size_bytes"))
    yield changes.empty_queue(queue, known.select(F.col("key").alias("connection_id")))[0]
    texts = rows.select("pipeline_id", F.concat(F.lit("#{"), "key", F.lit("}")).alias("text"), "noise")
    values = known.groupBy(F.lit("p").alias("context"), F.col("key").alias("name")).agg(F.lit("v").alias("value"))
    yield params.substitute(texts, "text", values, "pipeline_id")


@pytest.mark.parametrize("case", range(5))
def test_hot_keys_are_split(spark, case):
    with tiny_partitions(spark):
        df = list(cases(spark))[case]
        rows, plan = final_plan(df)
    assert rows > 0
    assert "skew=true" in plan


def test_closure_of_a_hub_splits_its_edges(spark, monkeypatch):
    monkeypatch.setattr(graph, "fits_broadcast", lambda rows, size: False)
    edges = hot(spark).select(F.col("key").alias("src"), F.col("id").cast("string").alias("dst"))
    seeds = spark.createDataFrame([("hot",), ("k1",)], "seed string")
    with tiny_partitions(spark):
        found = graph.lineage_closure(edges, seeds)
        counts = {r.seed: r["count"] for r in found.groupBy("seed").count().collect()}
    expected = {r.src: r.n + 1 for r in edges.groupBy("src").agg(F.countDistinct("dst").alias("n")).collect()}
    assert counts == {k: expected[k] for k in ("hot", "k1")}


def test_no_window_holds_a_whole_hot_key(spark):
    """The largest window group is one slice, however large the key is."""
    rows = hot(spark)
    numbered = ordered.row_numbers(rows, ["key"], ["id"], slice_by=F.floor(F.col("id") / 1000))
    plan = numbered._jdf.queryExecution().executedPlan().toString()
    assert "Window [row_number()" in plan and "windowspecdefinition(_group" in plan
    last = {r.key: r.last for r in numbered.groupBy("key").agg(F.max("row_number").alias("last")).collect()}
    counts = {r.key: r["count"] for r in rows.groupBy("key").count().collect()}
    assert last == counts
