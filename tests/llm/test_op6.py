import math
from collections import Counter, defaultdict

from tidemark.llm import op6_urls as U


def split(url):
    if not url or "://" not in url:
        return "", "", (url or "")
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    tail = rest[cut:]
    end = min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])
    low = lambda s: "".join(c.lower() if "A" <= c <= "Z" else c for c in s)
    return low(rest[:cut]), tail[:end], rest


def brute(urls):
    low = lambda s: "".join(c.lower() if "A" <= c <= "Z" else c for c in s)
    rows, examples = [], []
    for u in urls:
        host, path, rest = split(u)
        fit = [(h + p, v) for v, h, p in U.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        rule = max(fit, key=lambda x: len(x[0]), default=(None, None))
        rows.append((host, path, *rule, low(rest)))
    model = {}
    for kind in ("allow", "block"):
        count, follow = Counter(), defaultdict(set)
        for *_, verdict, letters in rows:
            if verdict == kind:
                s = "\x02" * U.ORDER + letters
                for i in range(U.ORDER, len(s)):
                    for k in range(U.ORDER + 1):
                        count[s[i - k:i], s[i]] += 1
                        count[s[i - k:i], None] += 1
                        follow[s[i - k:i]].add(s[i])
        model[kind] = count, follow
    def score(letters):
        s, total = "\x02" * U.ORDER + letters, 0
        for i in range(U.ORDER, len(s)):
            for kind, sign in (("allow", 1), ("block", -1)):
                count, follow = model[kind]
                p = 1 / U.ALPHABET
                for k in range(U.ORDER + 1):
                    c = s[i - k:i]
                    n, t = count[c, None], len(follow[c])
                    p = (count[c, s[i]] + t * p) / (n + t) if n else p
                total += sign * math.log(p)
        return total / len(letters) if letters else 0.0
    scored = [(*r, score(r[4])) for r in rows]
    kinds = {k: [r[5] for r in scored if r[3] == k and r[4]] for k in ("allow", "block")}
    if all(kinds.values()):
        mean = {k: sum(v) / len(v) for k, v in kinds.items()}
        sd = {k: math.sqrt(max(0, sum(x * x for x in v) / len(v) - mean[k] ** 2)) + 1e-9 for k, v in kinds.items()}
        cut = (mean["allow"] * sd["block"] + mean["block"] * sd["allow"]) / (sd["allow"] + sd["block"])
    else:
        cut = -math.inf
    return [(h, p, rule, v or ("allow" if s >= cut else "block"), s) for h, p, rule, v, _, s in scored]


URLS = ["http://x.net/a", "http://net/", "http://EXAMPLE.net/en/1", "https://m.example.net/en/", "http://a.example.net/EN/1", "http://a.net", "http://b.example.com/de/1?x=/de/",
        "http://example.org/fr/2#t", "http://notorg/fr/", "http://a.org/de/3", "http://example.com/en/3", "ftp://h?x#y", "http://h#a/b", None, "", "no scheme", "a://b://c/d",
        "HTTP://ÄÖ.example.com/ß\n/x", "http://😀.com/😀😀/a", "http://x.org/" + "long/" * 3000, "://", "http://", "http://a.org/de/3", "http://good.example.org/fr/9", "http://bad.example.net/xx/9"]


def test_verdicts_equal_brute_force(spark):
    df = spark.createDataFrame([(i, u, "h", 1) for i, u in enumerate(URLS)] + [(None, URLS[0], "h", 1)], "page_id long, url string, host string, score int").repartition(4)
    want = brute(URLS + URLS[:1])[:-1]
    got = {r.page_id: r for r in U.filter_urls(df).collect()}
    assert U.filter_urls(df).count() == len(URLS) + 1
    for i, (host, path, rule, verdict, score) in enumerate(want):
        r = got[i]
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, rule, verdict)
        assert abs(r.score - score) < 1e-9


def test_empty_and_unruled_tables(spark):
    schema = "page_id long, url string"
    assert U.filter_urls(spark.createDataFrame([], schema)).count() == 0
    rows = U.filter_urls(spark.createDataFrame([(1, "http://q.com/"), (2, None)], schema)).collect()
    assert {r.verdict for r in rows} == {"allow"} and {r.rule for r in rows} == {None}
