import os

from airshed.operators import drop_markers, graft_plan, remap_plan
from airshed.plans.workflows import inventory_remap
from airshed.sources import list_objects


def test_remap_plan_copies_two_objects(spark):
    objs = spark.createDataFrame([("pollution/file1.csv",), ("pollution/file2.csv",), ("pollution/",),
                                  ("weather/x.csv",)], "key string")
    plan = remap_plan(objs, "pollution/", "archive/")
    got = sorted((r.key, r.dest_key) for r in plan.collect())
    assert got == [("pollution/file1.csv", "archive/file1.csv"),
                   ("pollution/file2.csv", "archive/file2.csv")]
    assert f"Copied {plan.count()} objects" == "Copied 2 objects"


def test_drop_markers_modes(spark):
    objs = spark.createDataFrame([("p/",), ("p/sub/",), ("p/a.csv",), ("p",)], "key string")
    assert sorted(r.key for r in drop_markers(objs, mode="all_markers", prefix="p/").collect()) == ["p/a.csv"]
    assert sorted(r.key for r in drop_markers(objs, mode="root_only", prefix="p/").collect()) == \
        ["p", "p/a.csv", "p/sub/"]


def test_graft_plan(spark):
    objs = spark.createDataFrame([("weather_partitioned/date=2022-04-01/part-0.csv",)], "key string")
    assert graft_plan(objs, "weather_enriched/").first().dest_key == \
        "weather_enriched/date=2022-04-01/part-0.csv"


def test_listing_and_remap_on_files(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "pollution")
    for rel in ["date=2022-04-01/a.csv", "date=2022-04-02/b.csv", "c.csv"]:
        p = os.path.join(root, rel)
        os.makedirs(os.path.dirname(p), exist_ok=True)
        with open(p, "w") as f:
            f.write("x\n1\n")
    objs = list_objects(spark, root)
    got = sorted((r.key, r.date_str, r.length) for r in objs.collect())
    assert got == [("pollution/c.csv", None, 4), ("pollution/date=2022-04-01/a.csv", "2022-04-01", 4),
                   ("pollution/date=2022-04-02/b.csv", "2022-04-02", 4)]
    plan = inventory_remap(spark, root, "pollution/", "archive/")
    assert sorted(r.dest_key for r in plan.collect()) == \
        ["archive/c.csv", "archive/date=2022-04-01/a.csv", "archive/date=2022-04-02/b.csv"]


def test_dates_from_keys_strict_and_tolerant(spark):
    import pytest
    from airshed.operators import dates_from_keys
    objs = spark.createDataFrame([("w/date=2022-04-01/a.csv",), ("w/date=2022-04-01/b.csv",),
                                  ("w/date=2022-04-02/c.csv",), ("w/",)], "key string")
    assert sorted(r.date_str for r in dates_from_keys(objs, prefix="w/").collect()) == \
        ["2022-04-01", "2022-04-02"]
    bad = objs.union(spark.createDataFrame([("w/loose.csv",)], "key string"))
    with pytest.raises(ValueError, match="w/loose.csv"):
        dates_from_keys(bad)
    assert dates_from_keys(bad, strict=False).count() == 2


def test_listing_glob_filter(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "weather")
    for rel in ["a.csv", "b.json", "sub/c.csv"]:
        p = os.path.join(root, rel)
        os.makedirs(os.path.dirname(p), exist_ok=True)
        with open(p, "w") as f:
            f.write("x\n")
    keys = sorted(r.key for r in list_objects(spark, root, glob="*.csv").collect())
    assert keys == ["weather/a.csv", "weather/sub/c.csv"]
