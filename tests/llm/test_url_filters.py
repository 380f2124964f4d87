import datetime

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import url_filters as u

DAY = datetime.date.fromisoformat
ENTRIES = [
    ("bad.example", "spam", DAY("2024-01-10"), "list"),
    ("bad.example", "spam", DAY("2024-02-10"), "unlist"),
    ("bad.example", "spam", DAY("2024-03-10"), "list"),
    ("bad.example", "adult", DAY("2024-03-15"), "list"),
    ("host.fine.example", "spam", DAY("2024-01-01"), "list"),
    ("host.fine.example", "spam", DAY("2024-01-01"), "unlist"),
    ("site.example/path", "malware", DAY("2024-01-05"), "list"),
    (None, "spam", DAY("2024-01-01"), "list"),
    ("other.example", "spam", None, "list"),
    ("bad.example", "spam", DAY("2024-01-20"), "list"),
    ("deep.example/ads", "spam", DAY("2024-01-15"), "list"),
    ("c.d.e.f.deep.example", "adult", DAY("2024-01-25"), "list"),
    ("1.7", "spam", DAY("2024-01-01"), "list"),
    ("10.9.1.7", "malware", DAY("2024-02-01"), "list"),
    ("[2001:db8::1]", "malware", DAY("2024-02-01"), "list"),
    ("[2001", "spam", DAY("2024-01-01"), "list"),
]


def captures(spark, rows):
    return spark.createDataFrame([(k, url, day and DAY(day)) for k, (url, day) in enumerate(rows)], "capture_id long, url string, fetched date")


def active(url, day):
    """Replays the entries up to the day, for the host and all parent domains, with and without the path."""
    host, _, rest = url.split("://")[1].partition("/")
    host = host.split("@")[-1].lower()
    host = host.partition("]")[0] + "]" if host.startswith("[") else host.split(":")[0]
    address = host.startswith("[") or host.replace(".", "").isdigit()
    names = {host} | (set() if address else {host.split(".", k)[-1] for k in range(host.count("."))})
    first = rest.split("/")[0].split("?")[0].split("#")[0]
    keys = names | {f"{name}/{first}" for name in names if first}
    on = {}
    for key, category, since, action in sorted((e for e in ENTRIES if None not in e), key=lambda e: (e[2], e[3])):
        if since <= day:
            on[key, category] = action == "list"
    return {k for k, v in on.items() if v and k[0] in keys}


def test_every_day_against_a_replay(spark):
    days = [DAY("2024-01-01") + datetime.timedelta(k) for k in range(0, 100)]
    urls = ["http://bad.example/x", "https://User@A.B.bad.EXAMPLE:80/y?z", "http://host.fine.example", "http://site.example/path/a", "http://site.example/pathology", "http://notbad.example/"]
    urls += ["http://a.b.c.d.e.f.deep.example/ads/1", "http://deep.example/ads?x", "http://x.deep.example/ad", "http://192.168.1.7/", "http://10.9.1.7:80/x"]
    urls += ["http://[2001:db8::1]/x", "http://[2001:DB8::1]:8080/", "http://u@[2001:aaaa::2]/y"]
    rows = [(url, day.isoformat()) for url in urls for day in days]
    out = u.evaluate(captures(spark, rows), u.intervals(entries(spark))).collect()
    assert len(out) == len(rows)
    for r in out:
        expected = active(r.url, r.fetched)
        assert r.blocked == bool(expected) and r.n_entries == len(expected), r
        if expected:
            assert (r.category, r.matched_key) == min((c, k) for k, c in expected)


def entries(spark):
    return spark.createDataFrame(ENTRIES, "key string, category string, effective date, action string")


def test_intervals(spark):
    out = {tuple(r) for r in u.intervals(entries(spark)).collect()}
    forever = DAY("9999-12-31")
    assert out == {
        ("bad.example", "spam", DAY("2024-01-10"), DAY("2024-02-10")),
        ("bad.example", "spam", DAY("2024-03-10"), forever),
        ("bad.example", "adult", DAY("2024-03-15"), forever),
        ("site.example/path", "malware", DAY("2024-01-05"), forever),
        *((key, category, since, forever) for key, category, since, _ in ENTRIES[-6:]),
    }


@pytest.mark.parametrize(
    ("url", "host"),
    [("http://A.b.C/x", "a.b.c"), ("https://u:p@h.org:8080?q", "h.org"), ("ftp://x.y.#f", "x.y"), ("no url", ""), ("", ""), (None, ""), ("http:///p", ""),
     ("http://[2001:DB8::1]/x", "[2001:db8::1]"), ("https://u:p@[::1]:8080/", "[::1]"), ("http://[2001", "")],
)
def test_host(spark, url, host):
    df = spark.createDataFrame([(url,)], "url string")
    assert df.select(u.host_of(F.col("url"))).first()[0] == host


def test_every_parent_domain_with_and_without_path(spark):
    hosts = ["example.com", "e.example.com", "b.c.d.e.example.com", "a.b.c.d.e.example.com", "z.a.b.c.d.e.example.com", ".".join("l" * 126) + ".zz"]
    urls = [f"http://{host}{path}" for host in hosts for path in ("", "/ads/x", "/Ads", "/other")]
    own = lambda host: [host.split(".", k)[-1] for k in range(host.count("."))]
    names = sorted({name for host in hosts for name in own(host)})
    listed = [name for k, name in enumerate(names) if k % 3] + [f"{name}/ads" for name in names]
    rows = [(key, "spam", DAY("2024-01-01"), "list") for key in listed]
    found = u.evaluate(
        captures(spark, [(url, "2024-02-01") for url in urls]),
        u.intervals(spark.createDataFrame(rows, "key string, category string, effective date, action string")),
    ).collect()
    assert len(found) == len(urls)
    for r in found:
        host, _, path = r.url.split("://")[1].partition("/")
        first = path.split("/")[0]
        expected = {key for name in own(host) for key in (name, f"{name}/{first}") if key in listed}
        assert r.n_entries == len(expected) and r.matched_key == min(expected, default=None), r


def test_broken_long_hosts_have_few_keys(spark):
    df = spark.createDataFrame([("http://" + "a." * 50_000 + "bad.example/p",)], "url string")
    keys = df.select(u.lookup_keys(u.host_of(F.col("url")), u.first_path(F.col("url")))).first()[0]
    assert len(keys) < 300 and {"bad.example", "a.bad.example/p"} <= set(keys)


def test_edges(spark):
    rows = [(None, "2024-03-20"), ("", "2024-03-20"), ("http://bad.example/", None), ("http://bad.example/", "2024-03-20"), ("http://bad.example/", "2024-03-20")]
    seen = captures(spark, rows).selectExpr("*", "1 as host", "2 as path", "3 as key", "4 as month", "5 as n_entries", "6 as hit")
    out = u.evaluate(seen, u.intervals(entries(spark))).orderBy("capture_id").collect()
    assert [r.blocked for r in out] == [False, False, False, True, True]
    assert not any(r.blocked for r in u.evaluate(seen, u.intervals(entries(spark).limit(0))).collect())
    assert u.evaluate(seen.limit(0), u.intervals(entries(spark))).count() == 0
