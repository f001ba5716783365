import random
import re

from airshed.llm import urlfilter as U


def slow(url, rules, default="allow"):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in m[1]) if m else ""
    path = m[2] if m else ""
    fits = [(len(h + p), len(h), v == "block", h + p) for h, p, v in rules if h is not None and p is not None
            and (host == h or host.endswith("." + h)) and path.startswith(p)]
    if not fits:
        return host, path, None, default
    best = max(fits)
    return host, path, best[3], "block" if best[2] else "allow"


URLS = [None, "", "no scheme", "http://", "https://EXAMPLE.org/es/a?x#y", "http://a.example.org/en/123", "http://example.org", "http://org/",
        "http://notexample.org/es/", "http://x.com/fr/", "http://x.com/de/1", "http://a.b.c.com/de/", "ftp://é.com/fr/ü", "http://h?x=/de/",
        "http://h.com#/de/", "x://y://z.com/de/", "http://example.org/es", "http://com/de/" + "d/" * 50_000, "http://" + "a." * 5000 + "com/de/",
        "http://u:p@x.com:80/de/", "http://x.com/\n/de/", "http://example.org/en/1", "http://example.org/en/1"]


def test_matches_brute_force(spark):
    rules = U.RULES + [("b.c.com", "/d", "allow"), ("c.com", "/de/x", "block"), ("org", "/es/", "block"), (None, "/", "block"), ("z.com", None, "block"),
                       ("com", "/de/", "allow"), ("é.com", "/fr/ü", "block"), ("com", "", "block")]
    pages = spark.createDataFrame([(i, u, "h", "r") for i, u in enumerate(URLS)] + [(None, URLS[4], "h", "r")],
                                  "page_id long, url string, host string, rule string")
    table = spark.createDataFrame(rules, "host string, path string, verdict string")
    got = sorted((tuple(r) for r in U.judge(pages, table).collect()), key=repr)
    want = [(i, *slow(u, [r for r in rules if r != ("com", "/de/", "allow")])) for i, u in [*enumerate(URLS), (None, URLS[4])]]
    assert got == sorted(want, key=repr)


def test_no_rules_and_no_pages(spark):
    rules = spark.createDataFrame([], "host string, path string, verdict string")
    pages = spark.createDataFrame([(1, "http://x.com/a")], "page_id long, url string")
    assert [tuple(r) for r in U.judge(pages, rules, default="block").collect()] == [(1, "x.com", "/a", None, "block")]
    some = spark.createDataFrame(U.RULES, "host string, path string, verdict string")
    assert U.judge(pages.filter("false"), some).count() == 0


def test_many_shapes_make_no_larger_plan(spark):
    rng = random.Random(2)
    word = lambda n: "".join(rng.choice("ab") for _ in range(n))
    rules = [(".".join(word(1) for _ in range(rng.randint(1, 4))), "/" + word(n % 250), "block" if n % 3 else "allow") for n in range(1000)]
    urls = ["http://" + ".".join(word(1) for _ in range(rng.randint(1, 6))) + "/" + word(rng.randint(0, 12)) for _ in range(300)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    out = U.judge(pages, spark.createDataFrame(rules, "host string, path string, verdict string"))
    verdicts = {}
    for h, p, v in rules:
        verdicts.setdefault((h, p), set()).add(v)
    merged = [(h, p, "block" if "block" in v else "allow") for (h, p), v in verdicts.items()]
    want = sorted(((i, *slow(u, merged)) for i, u in enumerate(urls)), key=repr)
    assert sorted((tuple(r) for r in out.collect()), key=repr) == want
    assert sum(r[3] is not None for r in want) > 50
    few = U.judge(pages, spark.createDataFrame(U.RULES, "host string, path string, verdict string"))
    size = lambda df: len(df._jdf.queryExecution().analyzed().toString())
    assert size(out) < 1.2 * size(few)
