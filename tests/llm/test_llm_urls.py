"""URL filter: normal forms, relative targets and aliases against a brute-force walk."""

from urllib.parse import urljoin, urlsplit

from pyspark.sql import functions as F

from ticklab.llm.queries import URL_RULES
from ticklab.llm.url_filter import host_path, link_edges, normal_url, url_verdicts

NORMAL = {
    "HTTP://A.com/x#f": "http://a.com/x", "http://a.com": "http://a.com/", "http://a.com?q": "http://a.com/?q", "http://A.com:80/X": "http://a.com/X",
    "https://a.com:443": "https://a.com/", "https://a.com:80/": "https://a.com:80/", "http://a.com:/": "http://a.com/", "http://U:P@A.com/": "http://U:P@a.com/",
    "http://a.com/b/../c/./d": "http://a.com/c/d", "http://a.com/../..": "http://a.com/", "http://a.com/b/.": "http://a.com/b/", "http://a.com/b/..?x=/../y": "http://a.com/?x=/../y",
    "http://a.com/.b/c..": "http://a.com/.b/c..", "no url/../x": "no url/../x", "": "", "http://a.com/a//../b": "http://a.com/a/b", "ftp://A/x?#": "ftp://a/x?",
}


def test_normal_form(spark):
    df = spark.createDataFrame([(k,) for k in NORMAL] + [(None,)], "url string")
    got = {r.url: r.n for r in df.select("url", normal_url(F.col("url")).alias("n")).collect()}
    assert got == {**NORMAL, None: None}


def test_targets_resolve_as_in_the_standard(spark):
    base = "http://org.de/a/b/c?x=1#t"
    hrefs = ["d", "./d", "../d", "../../../d", "/d/./e", "//h.fr/x", "?q=2", "#here", "https://z.com/../y", "d/../e?f/../g", "..", "."]
    pages = spark.createDataFrame([(i, base, f'<link rel="canonical" href="{h}">') for i, h in enumerate(hrefs)]
                                  + [(90, base, '<link rel=canonical href="mailto:a@b">'), (91, base, '<link rel=canonical href="javascript:x()">'),
                                     (92, "http://org.de", "<link href='x' rel='canonical'>"), (93, base, None), (94, None, "<link rel=canonical href=x>")],
                                  "page_id long, url string, html string")
    got = {r[0] for r in link_edges(pages).select(normal_url(F.col("b"))).collect()}
    norm = lambda u: u.split("#")[0]
    want = {norm(urljoin(base, h)) for h in hrefs if h != "https://z.com/../y"} | {"https://z.com/y", "http://org.de/x"}
    assert got == want


def brute(pages, rules):
    """Every url's own longest rule, else that of the urls it reaches by links, allow first."""
    def own(url):
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        parts = urlsplit("x://" + rest)
        host, path = parts.netloc.lower(), parts.path
        fits = [(len(h + p), h + p, v) for h, p, v in rules if host and (host == h or host.endswith("." + h)) and path.startswith(p)]
        return max(fits)[1:] if fits else (None, None)

    def norm(url):
        parts = urlsplit(url)
        path = parts.path or "/"
        return f"{parts.scheme.lower()}://{parts.netloc.lower()}{path}" + (f"?{parts.query}" if parts.query else "")
    near = {}
    for _, url, target in pages:
        if url and target:
            a, b = norm(url), norm(urljoin(url, target))
            if a != b:
                near.setdefault(a, set()).add(b)
                near.setdefault(b, set()).add(a)
    raw = {}
    for _, url, _ in pages:
        if url and "://" in url:
            raw.setdefault(norm(url), set()).add(url)
    out = []
    for i, url, _ in pages:
        rule, verdict = own(url)
        component = None
        if url and "://" in url and norm(url) in near:
            seen, todo = set(), [norm(url)]
            while todo:
                n = todo.pop()
                if n not in seen:
                    seen.add(n)
                    todo.extend(near[n])
            component = min(seen)
            votes = {own(u)[1] for n in seen for u in {n, *raw.get(n, ())}} - {None}
            verdict = verdict or (min(votes) if votes else None)
        out.append((i, rule, verdict or "allow", component))
    return sorted(out)


def test_aliases_pass_decisions_on(spark):
    pages = [
        (1, "HTTP://News.Example.net/x#top", "http://a.com/de/1"),  # blocked through its target
        (2, "http://news.example.net/x", None),  # the same resource
        (3, "http://news.example.net/x?y", None),  # another one
        (4, "http://a.com/de/1", None), (5, "http://shop.net/a/b", "../c"), (6, "http://shop.net/c", "http://b.com/de/2"),
        (7, "http://mix.net/", "http://a.com/fr/1"), (8, "http://mix.net/fr", "http://mix.net"), (9, "http://MIX.net:80/q", None),
        (10, "http://mix.net/z", "http://c.com/de/1"), (11, "http://mix.net/z#2", "/"),  # allow and block: allow first
        (12, None, "http://a.com/de/1"), (13, "no url", None), (14, "http://self.net/a", "#b"), (15, "http://self.net/a?p", "?p"),
        (16, "http://deep.org/x", "http://q.com/de/9"),  # its own rule decides
    ]
    html = lambda t: f'<html><meta http-equiv="refresh" content="0; url={t}">' if t else None
    df = spark.createDataFrame([(i, u, html(t), "x", 1) for i, u, t in pages], "page_id long, url string, html string, rule string, component int")
    got = sorted((r.page_id, r.rule, r.verdict, r.component) for r in url_verdicts(df, spark.createDataFrame(URL_RULES, "host string, path string, verdict string")).collect())
    want = [r if r[0] != 9 else (9, None, "allow", None) for r in brute(pages, URL_RULES)]
    assert got == want
    verdicts = {r[0]: r[2] for r in got}
    assert [verdicts[i] for i in (1, 2, 3, 5, 6, 7, 8, 10, 11, 16)] == ["block", "block", "allow", "block", "block", "allow", "allow", "allow", "allow", "allow"]
    assert verdicts[14] == verdicts[15] == "allow" and dict((r[0], r[3]) for r in got)[14] is None


def test_empty_and_host_path(spark):
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert url_verdicts(empty, rules).isEmpty()
    host, path = host_path(F.lit("HTTP://A.b/C?d"))
    assert tuple(spark.range(1).select(host, path).first()) == ("a.b", "/C")
