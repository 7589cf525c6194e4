import math
import random
from collections import Counter, defaultdict

import pytest

from addrflow.llm import url_filter as L


def host_path(url):
    url = url or ""
    if "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    host, rest = rest[:cut], rest[cut:]
    end = min([rest.index(c) for c in "?#" if c in rest], default=len(rest))
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), rest[:end]


def rule_of(host, path):
    found = [(r, v) for v, r in L.RULES if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith(r[r.index("/") :])]
    return max(found, key=lambda x: len(x[0]), default=(None, None))


def chance(counts, gram):
    """Witten-Bell: from no context to the longest."""
    p = 1 / L.ALPHABET
    for k in range(len(gram)):
        own = counts[gram[len(gram) - 1 - k : -1]]
        n = sum(own.values())
        if n:
            p = (own[gram[-1]] + len(own) * p) / (n + len(own))
    return p


def _score(a, b, url, order):
    text = L.START * order + url + L.END
    grams = [text[i : i + order + 1] for i in range(len(url) + 1)]
    return sum(math.log(chance(a, g)) - math.log(chance(b, g)) for g in grams) / len(grams)


def _counts(urls, order):
    out = defaultdict(Counter)
    for u in urls:
        text = L.START * order + u + L.END
        for i in range(len(u) + 1):
            for k in range(order + 1):
                out[text[i + order - k : i + order]][text[i + order]] += 1
    return out


def _urls():
    rng = random.Random(6)
    out = [None, "", "nothing", "https://", "https://EXAMPLE.org", "https://example.org/", "http://a.example.org/es/x", "http://example.org/en/12?q", "http://notexample.org/en/1", "ftp://X.COM/de/1#f", "http://com/fr/", "http://x.com?a=/fr/", "a://b://c/d", "http://x.org\n/y"]
    for _ in range(150):
        tld, lang = rng.choice(["org", "com", "net"]), rng.choice(["en", "fr", "de", "es"])
        word = "".join(rng.choice("abc" if tld == "org" or lang == "fr" else "bcxyz") for _ in range(7))
        out.append(f"https://{word}.example.{tld}/{lang}/{rng.randrange(99)}")
    return out + out[20:40]


def test_rules_hosts_and_scores_equal_brute_force(spark):
    urls = _urls()
    rows = [(i if i % 9 else None, u, "<p>", "x") for i, u in enumerate(urls)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, verdict string").repartition(3)
    order = 3
    got = L.judge(pages, order=order).collect()
    assert len(got) == len(rows)
    distinct = {u or "" for u in urls}
    ruled = {u: rule_of(*host_path(u)) for u in distinct}
    half = {r.url: r.half for r in spark.createDataFrame([(u,) for u in distinct], "url string").selectExpr("url", "cast(pmod(xxhash64(url), 2) as int) as half").collect()}
    models = {
        v: [_counts([u for u in distinct if ruled[u][1] == kind and (v == 2 or half[u] == 1 - v)], order) for kind in ("allow", "block")] for v in (0, 1, 2)
    }
    own = {u: _score(*models[2 if ruled[u][1] is None else half[u]], u, order) for u in distinct}
    by = {(r.page_id, r.host, r.path, r.rule): r for r in got}
    for (i, u, *_rest) in rows:
        r = by[(i, *host_path(u), ruled[u or ""][0])]
        if i is not None:
            assert r.score == pytest.approx(own[u or ""], abs=2e-6)
        if ruled[u or ""][1]:
            assert r.verdict == ruled[u or ""][1]
    free = [r for r in got if r.rule is None]
    low = max((r.score for r in free if r.verdict == "block"), default=-9.0)
    high = min((r.score for r in free if r.verdict == "allow"), default=9.0)
    assert low <= high + 1e-6
    right = [r.verdict == ("allow" if "a" in r.host.split(".")[0] else "block") for r in free if "example" in r.host]
    assert sum(right) > 0.75 * len(right)


def test_empty_table_and_one_kind(spark):
    schema = "page_id long, url string, html string"
    assert L.judge(spark.createDataFrame([], schema)).collect() == []
    only = L.judge(spark.createDataFrame([(1, "http://a.org/x", None), (2, None, None)], schema)).collect()
    assert sorted((r.page_id, r.verdict) for r in only) == [(1, "allow"), (2, "allow")]


def test_threshold_equals_brute_force(spark):
    """The calibrated threshold, from an own count of both kinds' errors at every bin edge."""
    urls, order = _urls(), 3
    distinct = {u or "" for u in urls}
    ruled = {u: rule_of(*host_path(u))[1] for u in distinct}
    half = {r.url: r.half for r in spark.createDataFrame([(u,) for u in distinct], "url string").selectExpr("url", "cast(pmod(xxhash64(url), 2) as int) as half").collect()}
    models = {v: [_counts([u for u in distinct if ruled[u] == kind and (v == 2 or half[u] == 1 - v)], order) for kind in ("allow", "block")] for v in (0, 1, 2)}
    own = {u: _score(*models[2 if ruled[u] is None else half[u]], u, order) for u in distinct}
    good = [own[u] for u in distinct if ruled[u] == "allow"]
    bad = [own[u] for u in distinct if ruled[u] == "block"]
    step = L.SPAN / L.BINS
    edges = [b * step - L.SPAN / 2 for b in range(L.BINS)]
    errors = [(sum(x < e for x in good) / len(good) + sum(x >= e for x in bad) / len(bad), e) for e in edges]
    least = min(errors)[0]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(sorted(distinct))], "page_id long, url string")
    free = [(own[u], r.verdict) for u, r in zip(sorted(distinct), L.judge(pages, order=order).orderBy("page_id").collect(), strict=True) if ruled[u] is None]
    low = max((x for x, v in free if v == "block"), default=-L.SPAN)
    high = min((x for x, v in free if v == "allow"), default=L.SPAN)
    # Some edge of least error lies where the verdicts change.
    assert any(e <= least + 1e-9 and low - 1e-6 <= edge <= high + 1e-6 for e, edge in errors)
