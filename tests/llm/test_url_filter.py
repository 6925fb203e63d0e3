import random
import re

from corvane.llm.queries import URL_RULES
from corvane.llm.url_filter import GlobAutomaton, filter_urls


def test_automaton_equals_regular_expressions():
    rng = random.Random(3)
    globs = ["".join(rng.choice("ab/.?*") for _ in range(rng.randint(0, 9))) for _ in range(40)] + ["**", "*", "a**b", "", "x" * 70 + "*"]
    texts = ["".join(rng.choice("ab/.") for _ in range(rng.randint(0, 12))) for _ in range(300)] + ["", "x" * 90, "é/b"]

    def pattern(g):
        return re.compile(b"".join({b"*": b"[^/]*", b"?": b"[^/]"}.get(p, b".*" if p.startswith(b"**") else re.escape(p)) for p in re.findall(rb"\*+|.", g.encode(), re.S)), re.S)

    found = GlobAutomaton(globs).matches([t.encode() for t in texts])
    for j, g in enumerate(globs):
        for i, t in enumerate(texts):
            assert found[i, j] == bool(pattern(g).fullmatch(t.encode())), (g, t)


def test_rules_edges(spark):
    urls = {
        "http://a.EXAMPLE.com/en/7x?q": ("a.example.com", "/en/7x", "example.com/en/7", "allow"),
        "https://x.com/en/": ("x.com", "/en/", "com/en/", "block"),
        "https://com/en/": ("com", "/en/", "com/en/", "block"),
        "https://xcom/en/": ("xcom", "/en/", None, "allow"),
        "https://a.net/x.com/en/": ("a.net", "/x.com/en/", None, "allow"),
        "https://example.net/de/81": ("example.net", "/de/81", "example.net/de/8", "block"),
        "https://b.example.net/de/7": ("b.example.net", "/de/7", "net/de/", "allow"),
        "ftp://o.org/es/#x": ("o.org", "/es/", "org/es/", "block"),
        "o.org/es/": ("", "", None, "allow"),
        "": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
        "http://a.com?x=/en/": ("a.com", "", None, "allow"),
        "x://y://com/en/": ("y:", "//com/en/", None, "allow"),
        "https://a.com/" + "en/" * 4000: ("a.com", "/" + "en/" * 4000, "com/en/", "block"),
    }
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)], "page_id long, url string, host string")
    out = filter_urls(pages, URL_RULES).orderBy("page_id").collect()
    assert [(r.host, r.path, r.rule, r.verdict) for r in out] == list(urls.values())


def test_ties_repeats_and_no_rules(spark):
    pages = spark.createDataFrame([(1, "http://a.b/c"), (1, "http://a.b/c")], "page_id long, url string")
    assert [r.verdict for r in filter_urls(pages, [("block", "a.b", "/c"), ("allow", "a.b", "/c")]).collect()] == ["block"] * 2
    assert [(r.rule, r.verdict) for r in filter_urls(pages, [], otherwise="block").collect()] == [(None, "block")] * 2
    assert filter_urls(pages.where("false"), URL_RULES).collect() == []


def test_signs_of_globs_in_rules_stand_for_themselves(spark):
    from corvane.llm.url_filter import automaton, literal

    rules = [("block", "a.b", "/x*y"), ("block", "a.b", "/q\\z"), ("block", "c.*", "/")]
    urls = {"http://a.b/x*y1": "block", "http://a.b/xAy": "allow", "http://a.b/x": "allow", "http://a.b/q\\z": "block", "http://a.b/qz": "allow", "http://c.*/": "block", "http://c.d/": "allow"}
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    assert [r.verdict for r in filter_urls(pages, rules).orderBy("page_id").collect()] == list(urls.values())
    assert GlobAutomaton([literal("a?*\\b")]).matches([b"a?*\\b", b"axy\\b"]).ravel().tolist() == [True, False]
    assert automaton(("a*",)) is automaton(("a*",))
