"""URL rules and perspective rotation on odd rows."""

import collections
import math
import re

from millrace.llm import chat, urls
from millrace.llm.queries import URL_RULES

RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]
URLS = [
    None, "", "no scheme/x", "http://a.com", "http://A.COM/x?y=1#z", "https://example.com/en/1", "https://www.Example.com/en/1", "ftp://notexample.com/en/",
    "http://net/es/", "http://x.net/fr/a?b://c", "http://x.org/en/", "http://q.org?x://y.com/", "://com/", "http://sub.www.example.com/en/?k=v&l=w", "http://é.net/es/ñ",
    "http://x.com/line\nbreak", "http://x.com/" + "a" * 9000,
]


def parts(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match("[^/?#]*", rest)[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), re.match("[^?#]*", rest[len(host) :])[0]


def test_rules_are_those_of_the_query():
    assert [tuple(r) for r in URL_RULES] == RULES


def test_url_filter(spark):
    rows = [(i, u) for i, u in enumerate(URLS * 3)] + [(None, "http://x.net/es/")]
    rows += [(1000 + i, f"http://h{i % 9}.example.{('com', 'net', 'org')[i % 3]}/{('en', 'es')[i % 2]}/{i}") for i in range(300)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    for name in ("rule", "host", "label", "key", "features", "prediction"):
        pages = pages.withColumn(name, pages.page_id)
    got = urls.judge(pages, URL_RULES)
    assert got.columns == ["page_id", "host", "path", "rule", "verdict"]
    want = collections.Counter()
    for key, url in rows:
        host, path = parts(url)
        fits = [(len(h + p), h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        want[key, host, path, max(fits)[1] if fits else None, max(fits)[2] if fits else None] += 1
    seen = got.collect()
    assert collections.Counter((r.page_id, r.host, r.path, r.rule, r.verdict if r.rule else None) for r in seen) == want
    assert {r.verdict for r in seen} == {"allow", "block"}


def test_url_filter_with_one_verdict_or_none(spark):
    only = spark.createDataFrame([(1, "http://x.net/es/"), (2, "http://x.org/")], "page_id long, url string")
    assert {r.verdict for r in urls.judge(only, URL_RULES).collect()} == {"block"}
    none = spark.createDataFrame([(2, "http://x.org/")], "page_id long, url string")
    assert {r.verdict for r in urls.judge(none, URL_RULES).collect()} == {"allow"}
    assert urls.judge(none.filter("page_id > 5"), URL_RULES).count() == 0


def rendered(turns):
    """conversation -> perspective -> (text, masked text)."""
    out = {}
    groups = collections.defaultdict(list)
    for conv, turn, role, text in turns:
        groups[conv].append((turn, role, text))
    for conv, rows in groups.items():
        for who in {r for _, r, _ in rows if r not in (None, "system")}:
            text, learned = "", []
            for _, role, content in sorted(rows, key=lambda r: r[0]):
                speaker = "assistant" if role == who else "system" if role == "system" else "user"
                name = f" name={role}" if speaker == "user" and role else ""
                text += f"<|{speaker}{name}|>\n{content or ''}<|end|>\n"
                if speaker == "assistant":
                    learned.append(content or "")
            out[conv, who] = (text, learned)
    return out


def test_rotation(spark):
    turns = [(c, t, ("ann", "bob", "system", None)[((c or 0) + t) % 4], None if t == 3 else f"é{c} {t}") for c in (1, 2, None) for t in range(9)]
    turns += [(7, 0, "system", "alone")]
    turns += [(9, t, ("x", "y", "z")[t % 3], "long " * 2000) for t in range(60)]
    table = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").repartition(4)
    for name in ("speaker", "salt", "conv", "start", "head"):
        table = table.withColumn(name, table.turn)
    got = collections.defaultdict(list)
    for r in chat.rotate(table).collect():
        got[r.conv_id, r.perspective].append(r)
    want = rendered(turns)
    assert set(got) == set(want)
    for key, rows in got.items():
        rows.sort(key=lambda r: r.segment_start)
        text = "".join(r.segment for r in rows)
        assert text == want[key][0]
        assert [text[r.loss_start : r.loss_end] for r in rows if r.loss_start is not None] == want[key][1]


def test_equal_turns_follow_by_content_and_repeat(spark):
    table = spark.createDataFrame([(1, 0, "a", "x"), (1, 0, "a", "x"), (1, None, "b", "first"), (1, 0, "b", "y")], "conv_id long, turn long, role string, text string")
    rows = [r for r in chat.rotate(table).collect() if r.perspective == "a"]
    rows.sort(key=lambda r: r.segment_start)
    assert len(rows) == 4 and rows[0].segment == "<|user name=b|>\nfirst<|end|>\n"
    assert all(a.segment_start + len(a.segment) == b.segment_start for a, b in zip(rows, rows[1:], strict=False))
    assert chat.rotate(table.filter("turn > 5")).count() == 0


def test_rotation_runs_no_python(spark):
    table = spark.createDataFrame([(1, 0, "a", "x")], "conv_id long, turn long, role string, text string")
    plan = chat.rotate(table)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|NestedLoop|Cartesian", plan)


def test_suffix_statistics_are_by_suffix(spark):
    """More hosts than any table of slots had, hot and rare ones, each with its own rate."""
    hosts = [(f"h{n}.x", float(n % 2)) for n in range(6000)] + [("often.y", 1.0)] * 300 + [("new.z", None)]
    rows = [(k, f"http://{host}/", host, "/", label) for k, (host, label) in enumerate(hosts)]
    judged = spark.createDataFrame(rows, "key long, url string, host string, path string, label double")
    tables, base = urls._suffix_tables(judged)
    got, names = urls._with_features(judged, tables, base)
    got = {r.host: (r.rate_2, r.count_2, r.rate_1) for r in got.select("host", "label", *names).collect()}
    assert len(got) == 6002
    for host, (rate, count, _) in got.items():
        blocked, n = {"often.y": (300, 300), "new.z": (0, 0)}.get(host) or (int(host[1:-2]) % 2, 1)
        assert abs(rate - (blocked + urls.PRIOR * base) / (n + urls.PRIOR)) < 1e-9 and abs(count - math.log1p(n)) < 1e-9
    assert abs(got["h0.x"][2] - (3000 + urls.PRIOR * base) / (6000 + urls.PRIOR)) < 1e-9
