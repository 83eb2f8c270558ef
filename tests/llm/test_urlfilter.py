import random
import re

from shopmarts.llm import urlfilter as U


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def rule_of(host, path, rules=U.RULES):
    fit = [(len(h + p), v == "allow", h + p, v) for v, h, p in rules
           if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fit)[2:] if fit else None


URLS = [None, "", "no scheme net/", "http://", "http://net", "http://net/", "HTTP://A.NET/x", "x://net?q",
        "https://sub.example.net/en/1#top", "https://example.net/en", "http://notnet/", "http://a.example.com/de/x",
        "http://example.com/DE/x", "http://x.org/fr/", "http://x.org/fr", "http://É.net/é?x", "a://b://net/",
        "http://user@x.net:80/", "http://x.net#f/", "http://example.com.net/de/", "://net/y"]


def page(url=None, refresh=None):
    head = f'<link data-x="1" rel=\'shortcut CANONICAL\' href="{url}">' if url else ""
    if refresh:
        head += f"<META http-equiv=Refresh content=\"0; URL='{refresh}'\">"
    return f"<html><head>{head}</head><body><a href='http://z.net/'>x</a></body></html>"


def test_hosts_paths_and_rules_equal_brute_force(spark):
    rng = random.Random(1)
    urls = URLS + ["".join(rng.choice(["http", "://", "/", "net", ".", "example", "org", "fr", "#", "?", "A"])
                           for _ in range(9)) for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: r for r in U.judge(df).collect()}
    for k, url in enumerate(urls):
        host, path = split(url)
        rule = rule_of(host, path)
        r = got[k]
        assert (r.host, r.path, r.rule) == (host, path, rule[0] if rule else None), url
        assert r.verdict == (rule[1] if rule else "allow")


def test_blocks_travel_over_aliases_but_not_to_allowed_pages(spark):
    rows = [(1, "http://a.io/1", page("https://bad.net/x")),       # alias of a blocked page
            (2, "http://a.io/2", page(refresh="/1")),              # two steps away, relative
            (3, "https://example.net/en/ok", page("http://a.io/1")),   # allowed by rule
            (4, "http://a.io/4", page("http://b.io/")), (5, "http://b.io#frag", None),
            (6, "http://c.io/x?q=1&r=2", page("//a.io/2")), (7, "http://c.io/x?q=1", page()),
            (8, "http://d.io/", "<!-- " + page("http://bad.net/") + " --><script>" + page("http://bad.net/")
             + "</script>"),
            (9, None, page("http://bad.net/")), (2, "http://a.io/2", page(refresh="/1")),
            (10, "https://a.io/1", "")]
    df = spark.createDataFrame([(*r, "v") for r in rows], "page_id long, url string, html string, verdict string")
    got = {}
    for r in U.judge(df).collect():
        got.setdefault(r.page_id, []).append(r.verdict)
    assert got == {1: ["block"], 2: ["block"] * 2, 3: ["allow"], 4: ["allow"], 5: ["allow"], 6: ["block"],
                   7: ["allow"], 8: ["allow"], 9: ["allow"], 10: ["block"]}


def test_a_redirect_table_joins_components_of_any_length(spark):
    chain = [(f"http://h{i}.io/", f"http://h{i + 1}.io/") for i in range(40)] + [("http://h40.io/", "http://x.net/")]
    redirects = spark.createDataFrame(chain, "source string, target string")
    df = spark.createDataFrame([(i, f"http://h{i}.io") for i in range(41)] + [(99, "http://other.io/")],
                               "page_id long, url string")
    got = {r.page_id: r.verdict for r in U.judge(df, redirects=redirects).collect()}
    assert got == {**{i: "block" for i in range(41)}, 99: "allow"}


def test_many_aliases_of_one_page(spark):
    rows = [(i, f"http://m{i}.io/", page("http://hub.io/")) for i in range(400)]
    rows.append((1000, "http://hub.io/", page("http://x.example.com/de/")))
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.verdict for r in U.judge(df).collect()} == {"block"}


def test_empty_table(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert U.judge(df).collect() == []
