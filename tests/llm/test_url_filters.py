import datetime as dt

from tapecraft.llm.url_filters import judge_captures, validity_intervals

LOG = "list string, rule string, action string, day date"
CAPTURES = "page_id long, url string, fetched date, rule string, n_rules int, extra string"


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


ENTRIES = [
    ("bad", "spam.com", "add", day(10)), ("bad", "spam.com", "remove", day(20)), ("bad", "spam.com", "add", day(30)),
    ("bad", "spam.com", "add", day(10)),                                               # repeated row
    ("bad", "same.org", "add", day(5)), ("bad", "same.org", "remove", day(5)),         # both on one day
    ("paths", "ok.net/x/y", "add", day(0)), ("paths", "ok.net", "add", day(40)), ("other", "ok.net", "add", day(40)),
    ("bad", "never.com", "remove", day(3)), (None, "a.com", "add", day(0)), ("bad", None, "add", day(0)),
    ("bad", "a.com", None, day(0)), ("bad", "b.com", "add", None),
]


def active(rule, when):
    """(list, since) pairs by replaying the log day by day."""
    out = []
    for name in {e[0] for e in ENTRIES if e[0]}:
        on, since = False, None
        for d in sorted({e[3] for e in ENTRIES if e[0] == name and e[1] == rule and e[3] and e[2]}):
            if d > when:
                break
            actions = {e[2] for e in ENTRIES if e[0] == name and e[1] == rule and e[3] == d}
            now = "remove" not in actions
            since = d if now and not on else since if now else None
            on = now
        if on:
            out.append((name, since))
    return out


def brute(url, when):
    if url is None or when is None or "://" not in url:
        return 0, None
    rest = url.split("://", 1)[1].split("?")[0].split("#")[0]
    host, _, path = rest.partition("/")
    host = host.split("@")[-1].split(":")[0].lower()
    labels, segments = host.split("."), [s for s in path.split("/") if s]
    keys = {".".join(labels[-n:]) for n in range(1, len(labels) + 1)} if host else set()
    keys |= {host + "/" + "/".join(segments[:n]) for n in range(1, len(segments) + 1)} if host else set()
    found = [(-len(k), name, k, since) for k in keys for name, since in active(k, when)]
    return len(found), min(found)[1:] if found else None


def captures():
    urls = ["http://spam.com/a", "https://www.spam.com:8080/b?c#d", "http://notspam.com/", "http://same.org/", "http://ok.net/x/y/z",
            "http://ok.net/x", "http://OK.net//x///y", "http://user@ok.net/q", "ftp://spam.com", "spam.com/a", "", None,
            "http:///x", "http://" + "a." * 500 + "spam.com/" + "s/" * 3000, "http://never.com"]
    rows = [(i * 100 + n, u, day(n)) for i, u in enumerate(urls) for n in (0, 5, 9, 10, 19, 20, 29, 30, 39, 40, 100)]
    rows += [(7, "http://spam.com/hot", day(12))] * 500 + [(8, "http://spam.com/a", None), (None, "http://spam.com/a", day(15))]
    return rows


def test_captures_match_a_replay_of_the_log(spark):
    rows = captures()
    table = spark.createDataFrame([(*r, "clash", 9, "kept") for r in rows], CAPTURES).repartition(3)
    got = judge_captures(table, validity_intervals(spark.createDataFrame(ENTRIES, LOG)))
    assert got.columns == ["page_id", "url", "fetched", "extra", "n_rules", "blocked", "list", "rule", "since"]
    want = []
    for page_id, url, when in rows:
        n, best = brute(url, when)
        name, rule, since = best or (None, None, None)
        want.append((page_id, url, when, "kept", n, n > 0, name, rule, since))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_empty_tables(spark):
    none = spark.createDataFrame([], LOG)
    rows = spark.createDataFrame([(1, "http://a.com/", day(1), "c", 1, "e")], CAPTURES)
    (row,) = judge_captures(rows, validity_intervals(none)).collect()
    assert (row.n_rules, row.blocked, row.rule) == (0, False, None)
    assert judge_captures(rows.limit(0), validity_intervals(spark.createDataFrame(ENTRIES, LOG))).collect() == []


def test_intervals_are_half_open_and_merged(spark):
    got = {(r.list, r.rule, r.valid_from, r.valid_to)
           for r in validity_intervals(spark.createDataFrame(ENTRIES + [("bad", "spam.com", "add", day(12))], LOG)).collect()}
    assert {g for g in got if g[1] == "spam.com"} == {("bad", "spam.com", day(10), day(20)), ("bad", "spam.com", day(30), None)}
    assert not {g for g in got if g[1] in ("same.org", "never.com")}
