import datetime
import random

from pyspark.sql import functions as F

from urbanstats.llm.urls import active_intervals, host_of, judge_captures, path_of

DAY = datetime.date(2024, 1, 1)
ENTRIES = "list string, action string, kind string, value string, changed date, added boolean, host string"
CAPTURES = "page_id long, url string, fetched date, id int, row int, kind string, value string, time int, path string"


def day(n):
    return None if n is None else DAY + datetime.timedelta(n)


def entries_of(spark, rows):
    return spark.createDataFrame([(*r[:4], day(r[4]), r[5], "h") for r in rows], ENTRIES)


def captures_of(spark, rows):
    return spark.createDataFrame([(i, u, day(d), 1, 2, "k", "v", 3, "p") for i, u, d in rows], CAPTURES)


def plain(captures, entries):
    """For each capture and entry the last change up to the fetch."""
    out = []
    for page_id, host, path, fetched in captures:
        state = {}
        for name, action, kind, value, changed, added in entries:
            if None in (name, action, kind, value, changed, added) or fetched is None or host is None:
                continue
            value = value if kind == "prefix" else value.lower()
            match = {
                "host": host == value,
                "domain": ("." + host).endswith("." + value),
                "prefix": f"{host}/{path}/".startswith(value + "/"),
            }[kind]
            if match and changed <= fetched:
                key = (name, action, kind, value)
                state[key] = max(state.get(key, (-1, False)), (changed, not added))
        active = [k for k, (_, removed) in state.items() if not removed]
        verdict = "allow" if any(k[1] == "allow" for k in active) else "block" if active else "none"
        out.append((str(page_id), len(active), ",".join(sorted({k[0] for k in active})), verdict))
    return sorted(out)


def found(df):
    return sorted((str(r["page_id"]), r["n_active"], r["lists"], r["verdict"]) for r in df.collect())


def test_random_lists(spark):
    rnd = random.Random(3)
    hosts = ["a.example.com", "b.example.com", "example.com", "x.a.example.com", "other.org"]
    entries = []
    for _ in range(150):
        kind = rnd.choice(["host", "domain", "prefix"])
        value = rnd.choice(hosts) + (rnd.choice(["/p", "/p/q", "/r"]) if kind == "prefix" else "")
        action = rnd.choice(["block", "block", "allow"])
        entries.append((f"l{rnd.randrange(3)}", action, kind, value, rnd.randrange(60), rnd.random() < 0.6))
    rows, captures = [], []
    for i in range(300):
        # A third of the captures are of one host.
        host = hosts[0] if i % 3 == 0 else rnd.choice(hosts)
        path, fetched = rnd.choice(["", "p", "p/q", "p/q/s", "pq", "r"]), rnd.randrange(-5, 70)
        rows.append((i, f"https://{host.upper() if i % 7 == 0 else host}:80/{path}?p=/r#p", fetched))
        captures.append((i, host, path, fetched))
    got = judge_captures(captures_of(spark, rows), entries_of(spark, entries))
    assert got.columns == ["page_id", "host", "fetched", "n_active", "lists", "verdict"]
    assert found(got) == plain(captures, entries)


def test_intervals(spark):
    rows = [("l", "block", "host", "H.com", d, a) for d, a in ((1, True), (2, True), (5, False), (6, False))]
    rows += [("l", "block", "host", "h.com", 9, True), ("l", "block", "host", "tie.com", 3, True)]
    rows += [("l", "block", "host", "tie.com", 3, False), ("l", "block", "host", None, 3, True)]
    got = {tuple(r)[3:] for r in active_intervals(entries_of(spark, rows)).collect()}
    assert got == {("h.com", day(1), day(5)), ("h.com", day(9), None)}


def test_hosts_and_paths(spark):
    urls = {
        "https://User:p@Www.Example.COM.:8080/a/b?c/d#e": ("www.example.com", "a/b"),
        "http://h": ("h", ""),
        "ftp://h/x#y/z": ("h", "x"),
        "no scheme": (None, ""),
        "http:///path": (None, "path"),
        "": (None, ""),
        None: (None, ""),
    }
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    got = df.select("u", host_of(F.col("u")).alias("h"), path_of(F.col("u")).alias("p")).collect()
    assert {r["u"]: (r["h"], r["p"]) for r in got} == urls


def test_odd_rows(spark):
    entries = [("l", "block", "domain", "com", 0, True), ("l", "block", "prefix", "a.com/p", 0, True)]
    rows = [(1, "http://a.com/p", 3), (1, "http://a.com/p", 3), (None, "http://a.com", 3), (2, None, 3)]
    rows += [(3, "", 3), (4, "http://a.com", None), (5, "http://a.com/" + "s/" * 20_000, 3)]
    captures = [(1, "a.com", "p", 3)] * 2 + [(None, "a.com", "", 3), (2, None, "", 3), (3, None, "", 3)]
    captures += [(4, "a.com", "", None), (5, "a.com", "s", 3)]
    assert found(judge_captures(captures_of(spark, rows), entries_of(spark, entries))) == plain(captures, entries)


def test_empty_tables(spark):
    one = captures_of(spark, [(1, "http://a.com", 3)])
    assert found(judge_captures(one, entries_of(spark, []))) == [("1", 0, "", "none")]
    assert found(judge_captures(one.limit(0), entries_of(spark, []))) == []
