import random

from feedlake.llm import urlrules

ROWS = "page_id long, url string, key string, verdict string, rule string"


def pages(spark, *urls):
    return spark.createDataFrame([(i, u, "k", "v", "r") for i, u in urls], ROWS)


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, rest = rest[:cut], rest[cut:]
    end = min([rest.find(c) for c in "?#" if c in rest], default=len(rest))
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), rest[:end]


def brute(url, rules, default="allow"):
    host, path = parts(url)
    best = None
    for rule_host, rule_path, verdict in rules:
        if not rule_host or verdict is None:
            continue
        rule_path = rule_path or ""
        if (host == rule_host or host.endswith("." + rule_host)) and path.startswith(rule_path):
            entry = (len(rule_host) + len(rule_path), len(rule_host), rule_host + rule_path, verdict)
            best = max(best, entry) if best else entry
    return host, path, best[2] if best else None, best[3] if best else default


def judged(spark, urls, rules):
    frame = urlrules.judged(pages(spark, *urls), urlrules.rule_table(spark, rules))
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def test_random_rules(spark):
    rng = random.Random(4)
    label = lambda: rng.choice(["a", "b", "ab", "example", "org", "com", "x-y"])
    host = lambda n: ".".join(label() for _ in range(n))
    path = lambda: "".join("/" + rng.choice(["", "a", "ab", "en", "é"]) for _ in range(rng.randrange(4)))
    rules = [(host(rng.randrange(1, 4)), path(), rng.choice(["allow", "block"])) for _ in range(150)]
    urls = [(i, f"http://{host(rng.randrange(1, 5))}{path()}{rng.choice(['', '?q=/a', '#t'])}") for i in range(1500)]
    assert judged(spark, urls, rules) == sorted(((i, *brute(u, rules)) for i, u in urls), key=repr)


def test_ranges(spark, monkeypatch):
    monkeypatch.setattr(urlrules, "RANGE_KEYS", 40)
    rng = random.Random(8)
    rules = [("org", "/", "allow"), ("org", "/a", "block"), ("b.org", "/", "block"), ("b.org", "/aa/", "allow")]
    urls = [(i, f"https://{rng.choice(['', 'b.', 'c.b.', 'd.'])}org/{rng.choice('ab')}{rng.choice(['a/', '', 'z'])}{i}") for i in range(900)]
    assert judged(spark, urls, rules) == sorted(((i, *brute(u, rules)) for i, u in urls), key=repr)


def test_odd_rows(spark):
    urls = [
        (1, None), (2, ""), (3, "no scheme"), (4, "http://"), (5, "x://HOST.Org?x=/"), (6, "://org/a"), (None, "http://org/a"),
        (7, "http://a.org"), (8, "http://a.org/"), (9, "http://org./a"), (10, "http://.org/"), (11, "http://org/" + "a" * 50_000),
        (12, "http://org/a\nb"), (12, "http://org/a\nb"), (13, "a://b://org/"), (14, "http://xorg/"), (15, "http://ÄOrg/ä"),
    ]
    rules = [("org", "/", "allow"), ("ORG", "/a", "block"), ("org", "/a", "allow"), ("", "/", "block"), (None, "/", "block"), ("äorg", None, "block")]
    lowered = [(r[0].lower() if r[0] and r[0].isascii() else r[0], *r[1:]) for r in rules]
    assert judged(spark, urls, rules) == sorted(((i, *brute(u, lowered)) for i, u in urls), key=repr)


def test_hot_url_and_empty_tables(spark):
    urls = [(i, "http://hot.org/same") for i in range(600)] + [(1000 + i, f"http://h{i}.com/") for i in range(300)]
    rules = [("org", "/", "block")]
    assert judged(spark, urls, rules) == sorted(((i, *brute(u, rules)) for i, u in urls), key=repr)
    assert judged(spark, urls[:3], [("", "", "block")]) == sorted(((i, *brute(u, [])) for i, u in urls[:3]), key=repr)
    empty = urlrules.judged(pages(spark, (1, "a")).filter("page_id > 1"), urlrules.rule_table(spark, rules))
    assert empty.count() == 0


def test_hosts_of_many_labels_and_hot_keys(spark):
    """Keys go no deeper than the longest rule host, and a key that many URLs share is swept once."""
    rows = [(1, "http://" + "a." * 20_000 + "example.org/x"), (2, "http://" + "b." * 20_000 + "org")]
    rows += [(n, f"http://host{n}.com/") for n in range(10, 3000)]
    frame = spark.createDataFrame(rows, "page_id long, url string")
    rules = urlrules.rule_table(spark, [("com", "/", "block"), ("example.org", "/", "block"), ("org", "", "allow")])
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in urlrules.judged(frame, rules).collect()}
    assert got[1] == ("example.org/", "block") and got[2] == ("org", "allow")
    assert {got[n] for n in range(10, 3000)} == {("com/", "block")}
    urls = frame.select(*[c.alias(n) for c, n in zip(urlrules.split_url(frame["url"]), ("host", "path"), strict=True)])
    assert urlrules._domain_keys(urls, 2).count() == 2 * len(rows)


def test_without_rules(spark):
    frame = spark.createDataFrame([(1, "http://a.com/"), (2, None)], "page_id long, url string")
    none = urlrules.rule_table(spark, [("x", "/", "block")]).limit(0)
    assert [(r["rule"], r["verdict"]) for r in urlrules.judged(frame, none).collect()] == [(None, "allow")] * 2
