import random
import re

from martwright.llm.queries import URL_RULES
from martwright.llm.url_filter import GlobAutomaton, judge


def matches(glob, text):
    host, slash, path = glob.partition("/")
    pattern = "".join(
        ("[^/]*" if c == "*" else "[^/]" if c == "?" else re.escape(c)) for c in host
    )
    pattern += re.escape(slash) + "".join(
        (".*" if c == "*" else "." if c == "?" else re.escape(c)) for c in path
    )
    return re.fullmatch(pattern, text, re.DOTALL) is not None


def test_automaton_against_regular_expressions():
    rng = random.Random(1)
    globs = ["".join(rng.choice("ab*?./") for _ in range(rng.randint(1, 12))) for _ in range(60)]
    texts = ["".join(rng.choice("ab./") for _ in range(rng.randint(0, 15))) for _ in range(300)]
    automaton = GlobAutomaton(globs)
    assert automaton.words > 4
    fits = automaton.run([t.encode() for t in texts])
    for i, text in enumerate(texts):
        for j, glob in enumerate(globs):
            assert fits[i, j] == matches(glob, text), (glob, text)
    assert fits.any()


def plain(url):
    if url is None or "://" not in url:
        return "", "", None, "block"
    rest = url[url.index("://") + 3 :]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    best = None
    for verdict, rule in URL_RULES:
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            best = max(best or ("", ""), (rule, verdict), key=lambda r: len(r[0]))
    return host, path, *(best or (None, "allow" if host else "block"))


def test_rules(spark):
    urls = [
        None, "", "no scheme", "://", "http://", "http:///en/", "http://example.com/en/1",
        "HTTP://WWW.Example.COM/en/", "http://a.www.example.com/en/x?y=/es/", "http://com/",
        "http://example.com", "http://example.com?/en/", "http://myexample.com/en/",
        "http://x.net/es", "http://x.net/es/", "http://net/fr/#a", "http://x.org/net/es/",
        "http://x.org/a.net/fr/", "http://É.com/ü", "a://b://c.com/", "http://x.net/fr/" + "z" * 5000,
        "http://x.net/fr/\nq", "http://example.com/en/1",
    ]
    pages = spark.createDataFrame(
        [(i, u, "own") for i, u in enumerate(urls)], "page_id long, url string, rule string"
    )
    rows = {r["page_id"]: r for r in judge(pages, URL_RULES).collect()}
    for i, url in enumerate(urls):
        got = tuple(rows[i][c] for c in ("host", "path", "rule", "verdict"))
        assert got == plain(url), url
    assert judge(pages.limit(0), URL_RULES).count() == 0
    assert {r["verdict"] for r in judge(pages.filter("page_id = 6"), []).collect()} == {"allow"}
