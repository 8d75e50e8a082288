import math
import random
from functools import lru_cache

from objsync.llm import urls
from objsync.llm.queries import RULES

SCHEMA = "page_id long, url string, html string"


def test_host_path_and_rule(make):
    cases = {
        "http://Www.Example.COM/en/1?x#y": ("www.example.com", "/en/1", "www.example.com/en/", "allow"),
        "http://a.example.com/en/1": ("a.example.com", "/en/1", "example.com/en/", "block"),
        "https://example.com": ("example.com", "", None, None), "http://x.com/": ("x.com", "/", "com/", "allow"),
        "http://b.net/es/": ("b.net", "/es/", "net/es/", "block"), "http://bnet/es/": ("bnet", "/es/", None, None),
        "net/es/": ("", "", None, None), "a?b://c.com/d://e": ("c.com", "/d://e", "com/", "allow"), "http://É.com/x\ny": ("É.com", "/x\ny", "com/", "allow"),
        "http://h.org?q=/a": ("h.org", "", None, None), "": ("", "", None, None), None: ("", "", None, None), "://": ("", "", None, None),
    }
    rows = [(i, u, None) for i, u in enumerate(cases)]
    df = urls.parsed(make(rows, SCHEMA, clash=True).drop("rule", "verdict"))
    rule, verdict = urls.rule_columns(RULES)
    got = {r[0]: tuple(r)[1:] for r in df.select("page_id", "host", "path", rule, verdict).collect()}
    assert got == {i: want for i, want in enumerate(cases.values())}


def test_segmentation_is_the_cheapest_split(make):
    draw = random.Random(1)
    counts = {"free": 50, "bets": 20, "fre": 3, "ebets": 2, "cheap": 9, "pills": 9, "a": 30, "b": 5, "ab": 1}
    total = sum(counts.values())
    labels = ["freebets", "cheappills", "abab", "xfreey", "aaa", "", "zz"] + ["".join(draw.choice("abfre") for _ in range(8)) for _ in range(20)]
    unknown = math.log(total + 1) + 1

    @lru_cache(None)
    def cost(text):
        if not text:
            return 0.0
        known = [math.log(total / n) + cost(text[len(w):]) for w, n in counts.items() if text.startswith(w)]
        return min([unknown + cost(text[1:]), *known])

    df = make([(label,) for label in labels], "label string")
    got = {r["label"]: r["words"] for r in urls.segment(df, make(list(counts.items()), "word string, n long")).collect()}
    assert set(got) == set(labels)
    for label, words in got.items():
        assert "".join(words) == label
        price = sum(math.log(total / counts[w]) if w in counts else unknown * len(w) for w in words)
        assert math.isclose(price, cost(label), rel_tol=1e-9, abs_tol=1e-9)
    assert got["freebets"] == ["free", "bets"] and got["xfreey"] == ["x", "free", "y"]


def test_method_judges_the_rest(make):
    rows = [(i, f"http://shopbest.example.com/en/{i}", "<p>shop best news day</p>") for i in range(20)]
    rows += [(30 + i, f"http://newsday.example.com/fr/{i}", "news day") for i in range(20)]
    rows += [(60, "http://bestshop.example.org/en/1", None), (61, "http://daynews.example.org/fr/1", ""), (62, None, "day"), (63, "no url", "")]
    rows += [(64, "http://" + "news" * 5000 + ".org/", ""), (60, "http://bestshop.example.org/en/1", None)]
    df = make(rows, SCHEMA, clash=True)
    got = {r["page_id"]: r for r in urls.judge(df, RULES, urls.word_counts(df, "html")).collect()}
    assert got[60]["verdict"] == "block" and got[61]["verdict"] == "allow"
    assert got[60]["words"] == ["best", "shop", "example", "org"] and got[62]["host"] == "" and got[63]["verdict"] in ("allow", "block")
    assert len(got[64]["words"]) == 5001


def test_empty_tables(make):
    df = make([], SCHEMA)
    assert urls.judge(df, RULES, urls.word_counts(df, "html")).count() == 0
    one = make([(1, "http://a.org/x", None)], SCHEMA)
    assert [r["verdict"] for r in urls.judge(one, RULES, urls.word_counts(df, "html")).collect()] == ["allow"]
