import random

import numpy as np
import xxhash

from airshed.llm import simhash as S


def slow_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(pairs, bits=3):
    """Smallest id reachable of each (id, fp), over all pairs."""
    left, out = list(range(len(pairs))), [None] * len(pairs)
    while left:
        group, front = set(), [left[0]]
        while front:
            at = front.pop()
            if at in group:
                continue
            group.add(at)
            front += [x for x in left if x not in group and (pairs[x][1] ^ pairs[at][1]).bit_count() <= bits]
        ids = [pairs[x][0] for x in group if pairs[x][0] is not None]
        for x in group:
            out[x] = min(ids, default=None)
        left = [x for x in left if x not in group]
    return out


def test_fingerprint_matches_definition():
    for text in ["", " \t\n", "One", "one two", "A b C d e f a b c", "é É ß", "x " * 500]:
        assert S.fingerprint(text.encode()) == slow_fingerprint(text)


def test_golay_keys_reach_every_pair_within_three_bits():
    rng, tables = random.Random(5), S.golay_tables()
    for _ in range(400):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), rng.randint(1, 3)):
            b ^= 1 << bit
        key, row, side = S.keys_of(np.array([a, b], np.uint64), tables)
        keys = {(r, s): set(key[(row == r) & (side == s)]) for r in (0, 1) for s in (0, 1)}
        assert keys[0, 0] & keys[1, 1] and keys[1, 0] & keys[0, 1]


def planted(n_groups=6):
    """Ids and fingerprints: chains and stars within 3 bits, and strangers."""
    rng, out, i = random.Random(9), [], 0
    for g in range(n_groups):
        at = rng.getrandbits(63)
        for _ in range(rng.randint(2, 40)):
            out.append((i, at))
            i += 1
            for bit in rng.sample(range(64), rng.randint(0, 3)):
                at ^= 1 << bit
    out += [(i + k, rng.getrandbits(63)) for k in range(60)]
    return out


def test_links_and_components_match_all_pairs(spark, monkeypatch):
    pairs = planted()
    fps = spark.createDataFrame([(int(np.uint64(f).view(np.int64)),) for f in sorted({f for _, f in pairs})], "fp long")
    for block in (S.BLOCK, 8):  # 8: keys too large for one task are dealt out in blocks
        monkeypatch.setattr(S, "BLOCK", block)
        roots = {r.node & (2 ** 64 - 1): r.root for r in S.components(S.links(fps)).collect()}
        want = dict(zip((f for _, f in pairs), slow_components(pairs)))
        groups = {}
        for f, c in want.items():
            groups.setdefault(c, set()).add(roots.get(f, f))
        assert all(len(g) == 1 for g in groups.values())
        assert len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_documents_edge_cases(spark, docs_of):
    long_text = " ".join(f"w{i % 997}" for i in range(30_000))
    rows = [(7, None), (3, ""), (9, " \n"), (5, "same text here now"), (2, "same text here now"), (2, "same text here now"),
            (None, "Same TEXT here now"), (11, long_text), (12, long_text + " end"), (None, "quite another thing")]
    got = sorted((tuple(r) for r in S.near_duplicates(docs_of(rows)).collect()), key=repr)
    fps = [slow_fingerprint(t) for _, t in rows]
    want = slow_components([(i, f) for (i, _), f in zip(rows, fps)])
    assert got == sorted(((i, int(np.uint64(f).view(np.int64)), c) for (i, _), f, c in zip(rows, fps, want)), key=repr)
    kept = S.keep_one(docs_of(rows))
    assert kept.columns == docs_of(rows).columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted([2, 3, 11, None], key=repr)
    assert S.near_duplicates(docs_of([])).count() == 0 and S.keep_one(docs_of([])).count() == 0
