import json
import os

import pytest

from airshed.operators import last_wins, ledger_rows, select_notices, split_poison
from airshed.sinks import read_ledger, upsert_ledger
from airshed.sources import parse_notifications
from airshed.streaming import ledger_stream, process_notice_batch


def message(*records, raw_body=None):
    body = raw_body if raw_body is not None else json.dumps({"Records": list(records)})
    return json.dumps({"Records": [{"body": body}]})


def rec(key, event_time="2025-11-19T10:00:00Z", bucket="my-bucket"):
    r = {"s3": {"bucket": {"name": bucket}, "object": {"key": key}}}
    if event_time is not None:
        r["eventTime"] = event_time
    return r


def messages_df(spark, msgs):
    return spark.createDataFrame([(m,) for m in msgs], "value string")


def notices(spark, msgs):
    return select_notices(parse_notifications(messages_df(spark, msgs)))


def test_happy_path_one_ledger_row(spark):
    good, dead = split_poison(notices(spark, [message(rec("pollution/data.csv"))]))
    rows = ledger_rows(good).collect()
    assert [(r.file_name, r.timestamp, r.status) for r in rows] == \
        [("data.csv", "2025-11-19T10:00:00Z", 0)]
    assert dead.count() == 0


def test_ignores_invalid_prefix_and_folder_markers(spark):
    msgs = [message(rec("other-folder/file.txt")), message(rec("weather/")),
            message(rec("dlq-test.txt"))]   # poison outside the watched folders is ignored
    good, dead = split_poison(notices(spark, msgs))
    assert good.count() == 0 and dead.count() == 0


def test_poison_and_malformed_go_to_dead_letters(spark):
    msgs = [message(rec("pollution/dlq-test.txt")), message(raw_body="{oops"),
            message(rec("sensor/a+b%C4%83.csv", event_time=None)), message(raw_body="{}")]
    good, dead = split_poison(notices(spark, msgs))
    assert sorted((r.file_name or "", r.malformed) for r in dead.collect()) == \
        [("", True), ("dlq-test.txt", False)]
    g = good.collect()
    assert [r.file_name for r in g] == ["a bă.csv"] and g[0].event_time is None


def test_fail_mode_raises_with_dlq_message(spark, tmpdir_path):
    batch = messages_df(spark, [message(rec("pollution/dlq-test.txt"))])
    with pytest.raises(RuntimeError, match="DLQ"):
        process_notice_batch(batch, 0, os.path.join(tmpdir_path, "ledger"), on_poison="fail")
    assert read_ledger(spark, os.path.join(tmpdir_path, "ledger")).count() == 0


def test_last_wins_groups_without_window(spark):
    df = spark.createDataFrame([("a", "t1", 0, 1), ("a", "t3", 1, 2), ("a", "t2", 2, 3), ("b", "t1", 0, 1)],
                               "file_name string, timestamp string, status int, pos int")
    got = {r.file_name: (r.timestamp, r.status)
           for r in last_wins(df, ["file_name"], ["timestamp", "pos"], ["timestamp", "status"]).collect()}
    assert got == {"a": ("t3", 1), "b": ("t1", 0)}


def test_upsert_is_idempotent(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "ledger")
    b = spark.createDataFrame([("x.csv", "t1", 0), ("y.csv", "t1", 0)], "file_name string, timestamp string, status int")
    upsert_ledger(b, path, keys=("file_name",))
    v2 = upsert_ledger(b, path, keys=("file_name",))
    assert v2 == 2
    assert sorted(tuple(r) for r in read_ledger(spark, path).collect()) == \
        [("x.csv", "t1", 0), ("y.csv", "t1", 0)]
    c = spark.createDataFrame([("x.csv", "t2", 0)], "file_name string, timestamp string, status int")
    upsert_ledger(c, path, keys=("file_name",))
    assert sorted(tuple(r) for r in read_ledger(spark, path).collect()) == \
        [("x.csv", "t2", 0), ("y.csv", "t1", 0)]


def write_queue(folder, name, msgs):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write("\n".join(msgs) + "\n")


def test_stream_replay_same_and_fresh_checkpoint(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "queue")
    ledger = os.path.join(tmpdir_path, "ledger")
    dead = os.path.join(tmpdir_path, "dead")
    write_queue(src, "m1.json", [message(rec("pollution/a.csv"), rec("weather/b.csv")),
                                 message(rec("other/c.csv"))])
    write_queue(src, "m2.json", [message(rec("sensor/d.csv", event_time="2025-11-19T11:00:00Z")),
                                 message(rec("pollution/dlq-test.txt")),
                                 message(rec("weather/no-time.csv", event_time=None))])
    q = ledger_stream(spark, src, ledger, os.path.join(tmpdir_path, "ck1"), dead_letter_path=dead)
    q.awaitTermination(120)
    first = sorted(tuple(r) for r in read_ledger(spark, ledger).collect())
    assert [r[0] for r in first] == ["a.csv", "b.csv", "d.csv", "no-time.csv"]
    assert first[3][1].startswith("20")   # stamped with the landing time, not empty
    assert spark.read.json(dead).count() == 1
    # same checkpoint: nothing new to do
    q = ledger_stream(spark, src, ledger, os.path.join(tmpdir_path, "ck1"), dead_letter_path=dead)
    q.awaitTermination(120)
    assert sorted(tuple(r) for r in read_ledger(spark, ledger).collect()) == first
    # fresh checkpoint: every batch is replayed, neither the ledger nor the
    # dead letters change
    q = ledger_stream(spark, src, ledger, os.path.join(tmpdir_path, "ck2"), dead_letter_path=dead)
    q.awaitTermination(120)
    assert sorted(tuple(r) for r in read_ledger(spark, ledger).collect()) == first
    assert spark.read.json(dead).count() == 1
    # new arrivals are added
    write_queue(src, "m3.json", [message(rec("weather/e.csv"))])
    q = ledger_stream(spark, src, ledger, os.path.join(tmpdir_path, "ck1"))
    q.awaitTermination(120)
    assert [r[0] for r in sorted(read_ledger(spark, ledger).collect())] == \
        ["a.csv", "b.csv", "d.csv", "e.csv", "no-time.csv"]


def test_landing_time_stamp_is_utc_whatever_the_session_zone(spark, tmpdir_path):
    import datetime as dt
    src = os.path.join(tmpdir_path, "queue")
    write_queue(src, "m.json", [message(rec("weather/x.csv", event_time=None))])
    mtime = os.path.getmtime(os.path.join(src, "m.json"))
    expect = dt.datetime.fromtimestamp(mtime, dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%S")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        ledger = os.path.join(tmpdir_path, "ledger")
        ledger_stream(spark, src, ledger, os.path.join(tmpdir_path, "ck")).awaitTermination(120)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    ts = read_ledger(spark, ledger).first().timestamp
    assert ts.startswith(expect), (ts, expect)


def test_parse_notifications_keeps_arrival_positions(spark):
    msgs = [json.dumps({"Records": [
        {"body": json.dumps({"Records": [rec("pollution/a.csv"), rec("pollution/b.csv")]})},
        {"body": json.dumps({"Records": [rec("weather/c.csv")]})}]}),
        json.dumps({"Records": []}), json.dumps({"NoRecords": 1})]
    rows = parse_notifications(messages_df(spark, msgs)).orderBy("msg_pos", "rec_pos").collect()
    assert [(r.msg_pos, r.rec_pos, r.raw_key, r.bucket) for r in rows] == \
        [(0, 0, "pollution/a.csv", "my-bucket"), (0, 1, "pollution/b.csv", "my-bucket"),
         (1, 0, "weather/c.csv", "my-bucket")]


def test_wrongly_shaped_bodies_and_lines_are_dead_lettered(spark):
    msgs = [message(raw_body=json.dumps({"Records": 5})), message(raw_body="[1, 2]"),
            "not json at all", message(raw_body="{}"), message(rec("weather/ok.csv"))]
    good, dead = split_poison(notices(spark, msgs))
    assert [r.file_name for r in good.collect()] == ["ok.csv"]
    assert sorted(r.body for r in dead.collect()) == sorted(
        [json.dumps({"Records": 5}), "[1, 2]", "not json at all"])


def test_records_that_lack_a_field_are_dead_letters_with_their_text(spark, tmpdir_path):
    no_key = {"s3": {"bucket": {"name": "b"}, "object": {}}, "eventTime": "t"}
    no_bucket = {"s3": {"bucket": {}, "object": {"key": "weather/x.csv"}}}
    msgs = [message(no_key), message(no_bucket), message({"eventTime": "t"}), json.dumps({"Records": [{}]}), json.dumps({"Records": [None]}),
            message(rec("pollution/dlq-test.txt")), message(rec("weather/ok.csv")), message(rec("other/y.csv"))]
    good, dead = split_poison(notices(spark, msgs))
    assert [r.file_name for r in good.collect()] == ["ok.csv"]
    bodies = [json.loads(m)["Records"][0] for m in msgs[:6]]
    raw = [b["body"] if b and "body" in b else m for b, m in zip(bodies, msgs)]
    assert sorted(r.body for r in dead.collect()) == sorted(raw)
    from airshed.operators import account
    assert {r.outcome: r.n for r in account(parse_notifications(messages_df(spark, msgs))).collect()} == \
        {"dead": 6, "ledger": 1, "ignored": 1}
    # without a named folder dead letters go beside the ledger
    path = os.path.join(tmpdir_path, "ledger")
    process_notice_batch(messages_df(spark, msgs), 0, path)
    assert spark.read.json(path + "-dead-letters").count() == 6 and read_ledger(spark, path).count() == 1
    with pytest.raises(RuntimeError):
        process_notice_batch(messages_df(spark, msgs[:1]), 0, path, on_poison="fail")


def test_bytes_per_batch_do_not_grow_with_the_ledger(spark, tmpdir_path):
    from airshed.sinks import compact_ledger
    path, sizes = os.path.join(tmpdir_path, "ledger"), []
    for n in range(6):
        b = spark.range(n * 200, n * 200 + 200).selectExpr("concat('f', id % 700) as file_name", f"'t{n}' as timestamp", "0 as status")
        version = upsert_ledger(b, path, keys=("file_name",))
        folder = os.path.join(path, f"part=v-{version:06d}")
        sizes.append(sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(folder) for f in fs if f.endswith(".parquet")))
    assert max(sizes) < 1.5 * min(sizes)
    before = sorted(tuple(r) for r in read_ledger(spark, path).collect())
    assert len(before) == 700 and dict((r[0], r[1]) for r in before)["f0"] == "t3"
    assert compact_ledger(spark, path) == 6 and compact_ledger(spark, path) == 0
    assert sorted(tuple(r) for r in read_ledger(spark, path).collect()) == before
    assert upsert_ledger(spark.createDataFrame([("f0", "t9", 0)], "file_name string, timestamp string, status int"), path, ("file_name",)) == 7
    assert dict((r.file_name, r.timestamp) for r in read_ledger(spark, path).collect())["f0"] == "t9"


SCHEMA = "file_name string, timestamp string, status int"


def folders(path):
    return sorted(d for d in os.listdir(path) if d.startswith("part="))


def test_versions_stay_bounded_over_fifty_batches_and_a_reader_keeps_its_files(spark, tmpdir_path):
    path, want = os.path.join(tmpdir_path, "ledger"), {}
    under_way, expected = None, None
    for n in range(50):
        rows = [(f"f{(n * 7 + i) % 40}", f"t{n:03d}", n) for i in range(5)]
        upsert_ledger(spark.createDataFrame(rows, SCHEMA), path, ("file_name",))
        want.update({r[0]: r for r in rows})
        if n % 10 == 5:
            if under_way is not None and n == 15:
                pass
            under_way, expected = read_ledger(spark, path), dict(want)
            under_way._jdf.queryExecution().sparkPlan()  # its files are chosen now
        if n % 10 == 8:  # three batches and perhaps a fold later
            assert {r[0]: tuple(r) for r in under_way.collect()} == expected
    assert {r[0]: tuple(r) for r in read_ledger(spark, path).collect()} == want
    assert len(folders(path)) <= 2 * (2 * 8 + 1)
    from airshed.sinks import ledger as sink
    assert len(sink._current(sink._folders(spark, path))) <= 2 * sink.FOLD_AFTER + 1


def test_a_batch_and_a_keyed_read_touch_only_their_buckets(spark, tmpdir_path):
    from airshed.sinks.ledger import BUCKETS, bucket_of
    path = os.path.join(tmpdir_path, "ledger")
    many = spark.range(500).selectExpr("concat('f', id) as file_name", "'t1' as timestamp", "0 as status")
    upsert_ledger(many, path, ("file_name",))
    upsert_ledger(spark.createDataFrame([("f7", "t2", 0)], SCHEMA), path, ("file_name",))
    from pyspark.sql import functions as F
    own = spark.range(1).select(bucket_of(F.lit("f7")).alias("b")).first().b
    buckets = lambda v: sorted(os.listdir(os.path.join(path, f"part=v-{v:06d}", "_table=ledger")))
    assert len(buckets(1)) == BUCKETS and buckets(2) == [f"_bucket={own}"]
    one = read_ledger(spark, path, "f7")
    assert [tuple(r) for r in one.collect()] == [("f7", "t2", 0)]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_table" in plan and f"(_bucket" in plan
    files = {r.f for r in spark.read.option("basePath", path).parquet(*[os.path.join(path, d) for d in folders(path)])
             .filter((F.col("_table") == "ledger") & (F.col("_bucket") == own)).selectExpr("_metadata.file_path as f").collect()}
    assert files and all(f"_bucket={own}/" in f for f in files)


def test_rows_and_dead_letters_of_a_batch_show_together(spark, tmpdir_path, monkeypatch):
    """Killed after the commit, before the export; killed within the write; replayed either time."""
    from airshed.sinks import ledger as sink
    from airshed.sinks import read_dead_letters
    from airshed.streaming import ledger as stream
    path = os.path.join(tmpdir_path, "ledger")
    batch = messages_df(spark, [message(rec("weather/ok.csv")), message(rec("pollution/dlq-test.txt")), "no JSON", "no JSON"]) \
        .selectExpr("value", "'file:/q/m1' as source", "timestamp '2025-01-02 03:04:05' as landed_at")
    state = lambda: (sorted(tuple(r) for r in read_ledger(spark, path).collect()),
                     sorted((r.body, r.copies) for r in read_dead_letters(spark, path).collect() if "JSON" in r.body),
                     sum(r.copies for r in read_dead_letters(spark, path).collect()))
    whole = ([("ok.csv", "2025-11-19T10:00:00Z", 0)], [("no JSON", 2)], 3)

    def broken(*_a, **_k):
        raise RuntimeError("killed")

    kept = sink._write
    monkeypatch.setattr(sink, "_write", broken)
    with pytest.raises(RuntimeError, match="killed"):
        process_notice_batch(batch, 0, path)
    assert state() == ([], [], 0)
    # the files of a write that broke off are there, without the marker
    monkeypatch.setattr(sink, "_write", kept)
    os.makedirs(os.path.join(path, "part=v-000001", "_table=ledger", "_bucket=1"))
    assert state() == ([], [], 0)
    monkeypatch.setattr(stream, "write_dead_letters", broken)
    with pytest.raises(RuntimeError, match="killed"):
        process_notice_batch(batch, 0, path)
    assert state() == whole
    monkeypatch.undo()
    for n in (0, 0, 5):  # replayed under its own and under another number
        process_notice_batch(batch, n, path)
        assert state() == whole
    assert spark.read.json(path + "-dead-letters").count() == 3
