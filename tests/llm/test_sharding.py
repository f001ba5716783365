import zlib

from airshed.llm import sharding as S


def check(rows, out, shards, near=None):
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in out), key=repr) == \
        sorted(((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows), key=repr)
    slots, sizes = {}, dict.fromkeys(range(shards), 0)
    for r in out:
        assert 0 <= r.shard < shards
        slots.setdefault(r.shard, []).append(r.slot)
        sizes[r.shard] += r.size
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    if near:
        mean = sum(sizes.values()) / shards
        assert max(abs(s - mean) for s in sizes.values()) <= near * mean, sizes
    return sizes


def test_sizes_are_nearly_equal_and_groups_stay_together(docs_of):
    rows = [(i, f"text {i} " + "é" * (i * 37 % 400)) for i in range(3000)] + [(5000 + i, f"group {i % 40} " * 10) for i in range(400)]
    out = S.shard_by_bytes(docs_of(rows), 8).collect()
    check(rows, out, 8, near=0.03)
    split = {}
    for r in out:
        if r.doc_id >= 5000:
            split.setdefault(r.text_crc32, set()).add(r.shard)
    assert sum(len(s) > 1 for s in split.values()) <= 1  # ten copies are about a range here


def test_hot_groups_and_repeated_rows_are_subdivided(docs_of, monkeypatch):
    rows = [(i, f"text {i} " * 6) for i in range(1500)]
    rows += [(9000 + i, "the same copy " * 5) for i in range(1500)]   # a third of rows: equal texts
    rows += [(7, "the same row ")] * 1500                             # a third: equal rows
    check(rows, S.shard_by_bytes(docs_of(rows), 8).collect(), 8, near=0.03)
    many = [(i, None if i % 2 else "") for i in range(4000)] + [(i, "long " * 2000) for i in range(40)]
    check(many, S.shard_by_bytes(docs_of(many), 4).collect(), 4, near=0.11)


def test_subdividing_an_overfull_range_keeps_small_groups_together(docs_of, monkeypatch):
    monkeypatch.setattr(S, "quantiles", lambda drawn, ranges: [])  # all rows in one range at first
    rows = [(i, f"group {i // 3} " * 5) for i in range(3000)] + [(9000 + i, "hot copy " * 5) for i in range(1500)]
    out = S.shard_by_bytes(docs_of(rows), 16, ranges_per_shard=1).collect()
    check(rows, out, 16, near=0.5)
    split = {}
    for r in out:
        split.setdefault(r.text_crc32, set()).add(r.shard)
    hot = zlib.crc32(("hot copy " * 5).encode())
    assert len(split[hot]) > 1  # several ranges by itself
    assert all(len(s) == 1 for crc, s in split.items() if crc != hot)


def test_ranges_are_subdivided_until_none_is_overfull(docs_of, monkeypatch):
    """Starting from one range, with rows of very different sizes: the stated bound holds."""
    monkeypatch.setattr(S, "quantiles", lambda drawn, ranges: [])
    rows = [(i, f"t{i} " + "x" * (i % 90)) for i in range(4000)] + [(9000 + i, f"huge {i} " * 3000) for i in range(5)]
    rows += [(9100 + i, "copy " * 400) for i in range(300)]
    shards, per_shard = 4, 16
    sizes = check(rows, S.shard_by_bytes(docs_of(rows), shards, ranges_per_shard=per_shard).collect(), shards)
    mean, largest = sum(sizes.values()) / shards, max(len(t) + 1 for _, t in rows)
    assert max(abs(s - mean) for s in sizes.values()) <= S.OVERFULL / per_shard * mean + largest


def test_draws_and_splitters_do_not_grow_with_the_rows(docs_of, monkeypatch):
    drawn = []
    plain = S.draw
    monkeypatch.setattr(S, "draw", lambda *a: drawn.append(plain(*a)) or drawn[-1])
    for n in (2000, 20_000):
        S.shard_by_bytes(docs_of([(i, f"text {i}") for i in range(n)]), 2, ranges_per_shard=8).count()
    first = [len(d) for d in drawn]
    assert len(first) == 2 and max(first) < 2 * 2 * 8 * S.DRAWS_PER_RANGE


def test_heavy_draws_are_always_splitters():
    low = -(1 << 63)
    drawn = [((1, 0, 0), 1.0), ((2, 0, 0), 500.0), ((3, 0, 0), 1.0), ((4, 0, 0), 40.0)]
    assert S.subdividing(drawn) == [(2, 0, 0), (4, 0, 0)]
    assert S.subdividing([((k, 5, 0), 1.0) for k in range(16)]) == [(7, low, low), (15, low, low)]


def test_small_and_empty_tables(docs_of):
    rows = [(None, None), (1, ""), (1, ""), (2, "a" * 100_000)]
    check(rows, S.shard_by_bytes(docs_of(rows), 16).collect(), 16)
    assert S.shard_by_bytes(docs_of([])).count() == 0


def test_cut_shards_takes_the_nearest_end():
    assert S.cut_shards([1] * 8, 4) == [0, 0, 1, 1, 2, 2, 3, 3]
    assert S.cut_shards([], 3) == []
