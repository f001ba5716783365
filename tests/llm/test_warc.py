import hashlib
import random

import pyarrow as pa
import pytest

from airshed.llm import warc as W
from airshed.session import scratch_path

DATE = "2024-01-01T00:00:00Z"


def member(i, payload=None, refers_to=None):
    payload = payload or f"<p>{i}</p>".encode() * 40
    return W.record(i, f"http://x.org/{i}", payload, hashlib.sha1(payload).hexdigest(), refers_to, DATE, i)


def read(data):
    return list(W.salvage(pa.BufferReader(data)))


def ids(found):
    return [int(f[3][0]["x-page-id"]) for f in found if f[0] == "record"]


@pytest.mark.parametrize("packed", [True, False])
def test_whole_archives_have_no_gap(packed):
    parts = [W.gzip_member(member(i)) if packed else member(i) for i in range(30)]
    found = read(b"".join(parts))
    assert ids(found) == list(range(30)) and all(f[0] == "record" for f in found)
    assert read(b"") == []


@pytest.mark.parametrize("packed", [True, False])
@pytest.mark.parametrize("damage", ["flip", "cut", "zero", "insert", "tail"])
def test_later_records_survive_damage(packed, damage):
    rng = random.Random(damage)
    for _ in range(12):
        parts = [W.gzip_member(member(i)) if packed else member(i) for i in range(20)]
        hurt = rng.randrange(20)
        p = bytearray(parts[hurt])
        at = rng.randrange(1, len(p) - 1)
        if damage == "flip":
            at = rng.randrange(len(p) // 2, len(p) - 9)  # in the payload
            p[at] ^= 0x55
        elif damage == "cut":
            del p[at:]
        elif damage == "zero":
            p[:] = bytes(len(p))
        elif damage == "insert":
            p += b"junk \x1f\x8b\x08 WARC/1.1 junk"
        data = b"".join(bytes(x) for x in parts[:hurt]) + bytes(p) + b"".join(parts[hurt + 1:])
        if damage == "tail":
            data = data[:-7]
            hurt = 19
        else:
            data = bytes(data)
        found = read(data)
        want = [i for i in range(20) if i != hurt or damage == "insert"]
        assert ids(found) == want
        gaps = [f for f in found if f[0] == "gap"]
        assert gaps and all(f[2] > 0 and f[3] for f in gaps)
        # records and gaps cover the archive without overlap
        end = 0
        for kind, offset, length, _ in found:
            assert offset == end
            end = offset + length
        assert end == len(data)


def test_records_over_several_steps(monkeypatch):
    monkeypatch.setattr(W, "STEP", 64)
    big = member(1, payload=random.Random(0).randbytes(5000))
    data = W.gzip_member(member(0)) + b"\x1f\x8b" + W.gzip_member(big) + member(2) + big[:300] + member(3)
    found = read(data)
    assert ids(found) == [0, 1, 2, 3]
    assert [f[0] for f in found] == ["record", "gap", "record", "record", "gap", "record"]


def test_pages_round_trip(spark):
    page = "<p>ünï</p>" * 200
    rows = [(1, "http://a/1", page), (5, "http://a/5", page), (3, None, page), (2, "http://a/\r\n2", "short"), (4, "u", "short"),
            (6, "u", None), (None, "u", page), (7, "u", ""), (8, "u", "x" * 300_000), (9, "u", "y" * 1000), (9, "u", "y" * 1000)]
    pages = spark.createDataFrame([(*r, 0.5) for r in rows], "page_id long, url string, html string, doc_id double")
    folder = scratch_path(spark, "warc-test")
    archives = W.write_archives(pages, folder, archive_bytes=2000)
    assert archives.count() > 1
    got = W.read_archives(archives, folder)
    assert got.filter("kind = 'gap'").count() == 0
    want = []
    for i, _, h in rows:
        b = (h or "").encode()
        most = max(r[0] for r in rows if (r[2] or "") == (h or "") and r[0] is not None)
        revisit = len(b) >= 1000 and (i is None or i < most)
        want.append((i, len(b), hashlib.sha1(b).hexdigest(), "revisit" if revisit else "response", most if revisit else None))
    found = got.select("id", "payload_bytes", "digest_hex", "type", "refers_to").collect()
    assert sorted(map(tuple, found), key=repr) == sorted(want, key=repr)
    kept = {bytes(r.payload) for r in got.filter("type = 'response'").select("payload").collect()}
    assert kept == {(h or "").encode() for _, _, h in rows}
    empty = W.write_archives(pages.filter("false"), scratch_path(spark, "warc-test"))
    assert W.read_archives(empty, folder).count() == 0


def test_spark_log_of_gaps(spark, tmp_path):
    parts = [W.gzip_member(member(i)) for i in range(9)]
    data = b"".join(parts[:4]) + bytes(50) + b"".join(parts[5:])
    (tmp_path / "a.warc.gz").write_bytes(data)
    archives = spark.createDataFrame([(str(tmp_path / "a.warc.gz"),)], "path string")
    got = W.read_archives(archives, str(tmp_path)).collect()
    assert [r.id for r in got if r.kind == "record"] == [0, 1, 2, 3, 5, 6, 7, 8]
    assert [(r.offset, r.length) for r in got if r.kind == "gap"] == [(sum(map(len, parts[:4])), 50)]


def test_records_of_a_member_are_salvaged_one_by_one(monkeypatch):
    rng = random.Random(1)
    parts = [member(i, payload=rng.randbytes(3000)) for i in range(8)]
    hurt = bytearray(parts[3])
    hurt[-40] ^= 1
    data = W.gzip_member(b"".join([*parts[:3], bytes(hurt), *parts[4:]])) + W.gzip_member(member(9))
    first = W.gzip_member(b"".join(parts))
    late = bytearray(first)
    late[len(first) // 2 + 100] ^= 0x55  # in record 3, stored as it is: only the checksum and the digest tell
    for step in (1 << 20, 64):
        monkeypatch.setattr(W, "STEP", step)
        found = read(data)
        assert ids(found) == [0, 1, 2, 4, 5, 6, 7, 9]
        assert ["payload" in f[3] or "block" in f[3] for f in found if f[0] == "gap"] == [True]
        # the first record of a member, its last one
        for at in (0, 7):
            some = [bytes(20) + p if i == at else p for i, p in enumerate(parts)]
            assert ids(read(W.gzip_member(b"".join(some)))) == list(range(8))
        found = read(first[:len(first) * 3 // 5])  # cut off
        assert ids(found) == [0, 1, 2, 3]
        assert found[-1][0] == "gap" and found[-1][1] + found[-1][2] == len(first) * 3 // 5
        found = read(first[:len(first) * 3 // 5] + W.gzip_member(member(9)))
        assert ids(found) == [0, 1, 2, 3, 9]
        found = read(bytes(late) + W.gzip_member(member(9)))
        assert set(ids(found)) - {7} == {0, 1, 2, 4, 5, 6, 9} and len(ids(found)) == len(set(ids(found)))


def test_a_cut_member_always_leaves_a_gap():
    data = W.gzip_member(b"".join(member(i, payload=bytes([65 + i]) * 90) for i in range(4)))
    for end in range(1, len(data)):
        found = read(data[:end])
        assert ids(found) == list(range(len(ids(found)))) and len(ids(found)) < 4
        assert [f[0] for f in found].count("gap") == 1


def test_a_record_is_bounded_not_its_member(monkeypatch):
    monkeypatch.setattr(W, "MOST_RECORD", 4000)
    monkeypatch.setattr(W, "STEP", 256)
    parts = [member(i, payload=bytes([65 + i]) * 900) for i in range(20)]
    assert ids(read(W.gzip_member(b"".join(parts)))) == list(range(20))
    parts[5] = member(5, payload=b"x" * 9000)
    assert ids(read(W.gzip_member(b"".join(parts)))) == [i for i in range(20) if i != 5]


def test_headers_may_repeat():
    twice = member(1).replace(b"Content-Type", b"WARC-Concurrent-To: <urn:a>\r\nWARC-Concurrent-To: <urn:b>\r\nContent-Type", 1)
    for data in (twice + member(2), W.gzip_member(twice) + W.gzip_member(member(2))):
        found = read(data)
        assert ids(found) == [1, 2] and len(found) == 2
        assert found[0][3][0]["warc-concurrent-to"] == "<urn:a>, <urn:b>"


def test_a_gap_is_an_error_for_op10(spark, tmp_path):
    parts = [W.gzip_member(member(i)) for i in range(3)]
    for name, data in (("a", b"".join(parts)), ("b", parts[0] + bytes(50) + parts[2])):
        (tmp_path / f"{name}.warc.gz").write_bytes(data)
        archives = spark.createDataFrame([(str(tmp_path / f"{name}.warc.gz"),)], "path string")
        got = W.without_gaps(W.read_archives(archives, str(tmp_path))).select("id")
        if name == "a":
            assert sorted(r.id for r in got.collect()) == [0, 1, 2]
        else:
            with pytest.raises(Exception, match="gap in"):
                got.collect()


def test_folders_of_object_stores_are_known_by_hadoops_names():
    if not hasattr(W.pafs, "S3FileSystem"):
        pytest.skip("built without it")
    fs, path = W.file_system("s3a://bucket/some/folder?region=eu-west-1")
    assert isinstance(fs, W.pafs.S3FileSystem) and path == "bucket/some/folder"
