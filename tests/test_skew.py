"""Hot keys: one customer / one date holding a third of all rows."""

import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from airshed.operators import exposure_per_city
from airshed.sinks import write_by_date


@pytest.fixture()
def skew_conf(spark):
    keys = {
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def skewed_events(spark, n=6000):
    # customer 0 holds a third of all events
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 500).alias("user_id"),
        (F.col("id") % 17).cast("double").alias("value"),
        F.concat(F.lit("2022-04-"), F.lpad(((F.col("id") % 5) + 1).cast("string"), 2, "0"),
                 F.lit(" 10:00:00")).alias("time_date"))


def test_hot_customer_join_is_split_and_exact(spark, skew_conf):
    ev = skewed_events(spark)
    cust = spark.range(500).select(F.col("id").alias("c_custkey"),
                                   F.concat(F.lit("seg"), (F.col("id") % 4).cast("string"),
                                            F.lit(", X, R")).alias("location_name"))
    j = ev.join(cust, ev.user_id == cust.c_custkey, "left").select(
        "time_date", "location_name", F.col("value").alias("measurement_pm10Atmo"),
        F.col("value").alias("measurement_pm25Atmo"), F.lit(None).cast("double").alias("measurement_pm100Atmo"),
        F.lit(2).alias("tourist_estimate"))
    rows = exposure_per_city(j).collect()
    # the executed adaptive plan of the join carries the skew split
    j.collect()
    executed = j._jdf.queryExecution().executedPlan().toString()
    assert "skew=true" in executed, executed
    # brute force
    ev_rows = ev.collect()
    loc = {i: f"seg{i % 4}, X, R" for i in range(500)}
    seen = {(r.time_date[:10], loc[r.user_id], r.value) for r in ev_rows}
    exp = {}
    for d, c, v in seen:
        exp[(d, c)] = exp.get((d, c), 0.0) + v * 2
    got = {(str(r.day), r.city): r.pollution_total_visitor_pm10 for r in rows}
    assert got == pytest.approx(exp)


def test_hot_date_is_written_by_several_tasks(spark, skew_conf, tmpdir_path):
    df = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit("2022-04-01"))
         .otherwise(F.concat(F.lit("2022-04-"), F.lpad(((F.col("id") % 20) + 2).cast("string"), 2, "0")))
         .cast("date").alias("date"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"))
    out = os.path.join(tmpdir_path, "by_date")
    write_by_date(df.repartition(8), out, mode="overwrite")
    hot = glob.glob(os.path.join(out, "date=2022-04-01", "part-*"))
    assert len(hot) > 1, "the hot date should be split over several tasks"
    back = spark.read.option("header", True).csv(out)
    assert back.count() == 30000


def test_stream_fail_mode_leaves_ledger_untouched(spark, tmpdir_path):
    from airshed.sinks import read_ledger
    from airshed.streaming import ledger_stream
    src = os.path.join(tmpdir_path, "queue")
    os.makedirs(src)
    body = json.dumps({"Records": [{"s3": {"bucket": {"name": "b"}, "object": {"key": "pollution/ok.csv"}},
                                    "eventTime": "t"},
                                   {"s3": {"bucket": {"name": "b"}, "object": {"key": "pollution/dlq-test.txt"}},
                                    "eventTime": "t"}]})
    with open(os.path.join(src, "m.json"), "w") as f:
        f.write(json.dumps({"Records": [{"body": body}]}) + "\n")
    ledger = os.path.join(tmpdir_path, "ledger")
    q = ledger_stream(spark, src, ledger, os.path.join(tmpdir_path, "ck"), on_poison="fail")
    with pytest.raises(Exception, match="DLQ"):
        q.awaitTermination(120)
    assert read_ledger(spark, ledger).count() == 0


def test_bucketed_tables_join_without_shuffle(spark):
    from airshed.plans.layout import write_bucketed
    ev = spark.range(2000).select((F.col("id") % 50).alias("user_id"), F.col("id").alias("v"))
    cust = spark.range(50).select(F.col("id").alias("c_custkey"),
                                  F.concat(F.lit("loc"), F.col("id").cast("string")).alias("loc"))
    e = write_bucketed(ev, "ev_bucketed", "user_id", 4)
    c = write_bucketed(cust, "cust_bucketed", "c_custkey", 4)
    j = e.join(c, e.user_id == c.c_custkey, "left")
    rows = j.collect()
    plan = j._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan, plan
    assert len(rows) == 2000 and all(r.loc == f"loc{r.user_id}" for r in rows)
