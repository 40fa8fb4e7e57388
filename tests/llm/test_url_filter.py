import math
import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from cadenza.llm import url_filter as U


def brute_rule(url):
    if url is None or "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        end = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
        path = rest[end : min((rest.find(c, end) for c in "?#" if rest.find(c, end) >= 0), default=len(rest))]
    fit = [(h + p, v) for v, h, p in U.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, *max(fit, key=lambda f: len(f[0]), default=(None, None))


URLS = ["http://x.example.net/en/1", "https://EXAMPLE.net/en/", "http://example.net/fr/", "http://net/", "http://a.net", "ftp://planet/", "http://b.org/fr/x?y#z", "http://b.org?fr/", "http://example.com/de/", "http://notexample.com/de/", "no scheme", "", None, "://", "http://é.ORG/fr/\nx", "x://y://z.org/fr/", "http://b.org/fr/x?y#z"]


def test_rules(spark):
    df = spark.createDataFrame([(i, u, "h", "r") for i, u in enumerate(URLS)], "page_id long, url string, host string, rule string")
    got = {r.page_id: (r.host, r.path, r.rule, r.ruling) for r in U.ruled(df.select("page_id", "url")).collect()}
    assert got == {i: brute_rule(u) for i, u in enumerate(URLS)}
    judged = {r.page_id: r for r in U.judge(df).collect()}
    assert len(judged) == len(URLS) and all(r.verdict in ("allow", "block") and r.verdict == (brute_rule(URLS[i])[3] or r.verdict) for i, r in judged.items())
    assert U.judge(df.limit(0)).isEmpty()


def test_likelihoods_equal_brute_force(spark):
    rng = random.Random(1)
    texts = [("".join(rng.choices("abc/", weights=(4, 2, 1, 1) if y else (1, 2, 4, 1), k=rng.randint(1, 9))), y) for y in (0, 1) for _ in range(40)]
    windows = Counter()
    for t, y in texts:
        padded = "\2" * U.ORDER + t
        for i in range(len(t)):
            windows[padded[i : i + U.ORDER + 1], y] += 1
    table = [(w, windows[w, 1], windows[w, 0]) for w in {w for w, _ in windows}]
    got = {r.window: r.ratio for r in U.log_ratios(spark.createDataFrame(table, "window string, accepted long, rejected long")).collect()}
    counts = defaultdict(Counter)
    for (w, y), n in windows.items():
        for k in range(U.ORDER + 1):
            counts[y, w[U.ORDER - k : U.ORDER]][w[-1]] += n

    def likelihood(w, y):
        p = 1 / U.ALPHABET
        for k in range(U.ORDER + 1):
            c = counts[y, w[U.ORDER - k : U.ORDER]]
            if c:
                p = (c[w[-1]] + len(c) * p) / (sum(c.values()) + len(c))
        return p

    assert got.keys() == {w for w, *_ in table}
    assert all(abs(got[w] - math.log(likelihood(w, 1)) + math.log(likelihood(w, 0))) < 1e-9 for w in got)


def test_the_model_tells_unseen_urls_apart(spark):
    rng = random.Random(2)
    name = lambda letters: "".join(rng.choices(letters, k=8))
    rows = [(i, f"http://{name('abcdef')}.example.net/en/{name('abcdef')}") for i in range(150)] + [(200 + i, f"http://{name('uvwxyz')}.net/{name('uvwxyz')}") for i in range(150)]
    rows += [(1000 + i, f"http://{name('abcdef')}.biz/{name('abcdef')}") for i in range(40)] + [(2000 + i, f"http://{name('uvwxyz')}.biz/{name('uvwxyz')}") for i in range(40)]
    got = {r.page_id: r.verdict for r in U.judge(spark.createDataFrame(rows, "page_id long, url string")).where(F.col("rule").isNull()).collect()}
    assert sum(v == ("allow" if i < 2000 else "block") for i, v in got.items()) >= 76
