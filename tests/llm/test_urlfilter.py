import random
import re

import llm_cases as cases
from engage.llm import urlfilter as U

HOSTS = ["a.com", "www.a.com", "xa.com", "spam-farm.example.org", "b.spam-farm.net", "shop.example.org", "Example.ORG",
         "example.org.evil.com", "casino.net", "my-casino.net", "mycasino.net", "org", "com", "ads.x.fr", "Übung.com"]
PATHS = ["", "/", "/es/1", "/en/1", "/en/148.html", "/en/9.html", "/EN/1", "/fr/", "/fr", "/de/x.exe", "/track/q/pixel/",
         "/track/pixel", "/a_casino_b", "/buy-pills.html", "/payday--loan/", "/es", "/en/19?x=://y/de/", "/.torrent"]
TAILS = ["", "?utm=casino", "#top", "?a=1#b.exe", ".exe"]


def urls(n=600, seed=3):
    rng = random.Random(seed)
    out = [f"{rng.choice(['http', 'HTTPS', 'x'])}://{rng.choice(HOSTS)}{rng.choice(PATHS)}{rng.choice(TAILS)}"
           for _ in range(n)]
    return out + [None, "", "no scheme.com/de/1", "://", "http://", "//casino/", "http://u@example.org:80/es/",
                  "http://example.org?x=/es/", "a://b://com/de/", "http://com/de/" + "y" * 200000, "http://a.com\n/de/1"]


def split(url):
    url = url or ""
    if "://" not in url:
        return "", "", url
    after = url.split("://", 1)[1]
    cut = min([after.index(c) for c in "/?#" if c in after], default=len(after))
    host, rest = after[:cut], after[cut:]
    end = min([rest.index(c) for c in "?#" if c in rest], default=len(rest))
    return low(host), rest[:end], after


def low(s):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in s)


def host_fits(rule, host, path):
    h, slash, p = rule.partition("/")
    return bool(h) and (host == low(h) or host.endswith("." + low(h))) and path.startswith(slash + p)


def glob(pat, s, i, must_end):
    """Plain recursive matcher of the wildcards, from position i of s."""
    if not pat:
        return not must_end or i == len(s)
    c, rest = pat[0], pat[1:]
    if c == "*":
        return any(glob(rest, s, j, must_end) for j in range(i, len(s) + 1))
    if c == "^":
        if i == len(s):
            return glob(rest, s, i, must_end)
        return not re.fullmatch(r"[a-z0-9_.%-]", s[i]) and glob(rest, s, i + 1, must_end)
    return i < len(s) and s[i] == c and glob(rest, s, i + 1, must_end)


def pattern_fits(rule, subject):
    s, body = low(subject), low(rule).removeprefix("@@")
    if body.startswith("||"):
        body = body[2:]
        hostlen = min([s.index(c) for c in "/?#" if c in s], default=len(s))
        starts = [0] + [i + 1 for i in range(hostlen) if s[i] == "."]
    elif body.startswith("|"):
        body, starts = body[1:], [0]
    else:
        starts = range(len(s) + 1)
    end = body.endswith("|")
    return any(glob(body.removesuffix("|"), s, i, end) for i in starts)


def brute(url, host_rules, patterns, default="allow"):
    host, path, subject = split(url)
    fit = [(-len(r), r, a) for r, a in host_rules if r and host_fits(r, host, path)]
    if fit:
        _, rule, action = min(fit)
        return host, path, rule, action, None
    subject = subject if len(subject) < 9999 else subject[:300]
    fit = [(not p.startswith("@@"), -len(p), p) for p in patterns if p and pattern_fits(p, subject)]
    if fit:
        blocks, _, p = min(fit)
        return host, path, None, "block" if blocks else "allow", p
    return host, path, None, default, None


def judged(spark, urls, host_rules, patterns):
    pages = spark.createDataFrame([(i, u, "h", "x") for i, u in enumerate(urls)],
                                  "page_id long, url string, host string, verdict string").repartition(5)
    out = {r.page_id: r for r in U.judge_urls(pages, U.rules_table(spark, host_rules, patterns)).collect()}
    assert len(out) == len(urls)
    return out


def test_equals_brute_force_on_stated_rules(spark):
    us = urls()
    out = judged(spark, us, U.HOST_RULES, U.PATTERN_RULES)
    seen = set()
    for i, u in enumerate(us):
        r = out[i]
        want = brute(u, U.HOST_RULES, U.PATTERN_RULES)
        assert (r.host, r.path, r.rule, r.verdict, r.pattern) == want, u
        seen.add(r.rule or r.pattern)
    assert {r for r, _ in U.HOST_RULES} <= seen and len(seen) > 12


def test_many_random_rules_with_and_without_tokens(spark):
    rng = random.Random(9)
    us = urls(300, 4)
    pieces = ["a", "en", "casino", "/", "-", ".", "*", "^", "example", "org", "1", "track", ".html", "x", "ü"]
    pats = {p + "".join(rng.choice(pieces) for _ in range(rng.randint(1, 4))) + e
            for _ in range(150) for p in ["", "||", "|", "@@", "@@||"] for e in ["", "|"] if rng.random() < 0.2}
    hosts = {f"{rng.choice(HOSTS)}{rng.choice(['', '/', '/e', '/en/', '/en/1', '/fr'])}": rng.choice(["allow", "block"])
             for _ in range(12)}
    pats = {p for p in pats if p.removeprefix("@@").lstrip("|").rstrip("|").strip("*")}
    assert sum(not U.compile_pattern(p)[2] for p in pats) > U.BLOCK      # several blocks without a token
    out = judged(spark, us, list(hosts.items()), [*pats, None, "", "*", "@@", "||", *list(pats)[:5]])
    for i, u in enumerate(us):
        r = out[i]
        assert (r.host, r.path, r.rule, r.verdict, r.pattern) == brute(u, hosts.items(), pats), u


def test_first_place_of_a_piece_may_be_a_later_label(spark):
    us = ["http://x.a1b.a", "http://a.b.a/b", "http://b.a", "http://x.a.b", "http://ab.c/a^b"]
    pats = ["||a*b", "||a1*b|", "||b.a|", "|a.b*/b|", "||ab^*^a"]
    out = judged(spark, us, [], pats)
    assert [out[i].pattern for i in range(len(us))] == [brute(u, [], pats)[4] for u in us]


def test_rules_are_filed_under_their_rarest_token(spark):
    us = ["http://com/rare"] + ["http://example.com/en/"] * 40
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(us)], "page_id long, url string")
    urls_ = U.split_urls(pages).withColumn("uid", pages.page_id)
    rules = U.compile_rules(U.rules_table(spark, [("example.com/rare/", "block")], ["^en^never^", "^zz*y"]))
    filed = {r.rule: r.token for r in U.index_rules(rules, U.url_tokens(urls_)).collect()}
    assert filed == {"example.com/rare/": "rare", "^en^never^": "never", "^zz*y": None}
    # a rule whose rarest token the URL lacks is never tried
    out = U.judge_urls(pages, U.rules_table(spark, [("example.com/rare/", "block")], ["^en^never^"])).collect()
    assert sorted(r.n_candidates for r in out) == [0] * 40 + [1]


def test_empty_tables(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert U.judge_urls(pages, U.rules_table(spark)).collect() == []
    none = spark.createDataFrame([], "kind string, rule string, action string")
    got = U.judge_urls(cases.small(spark, "pages"), none).collect()
    assert len(got) == cases.small(spark, "pages").count() and {r.verdict for r in got} == {"allow"}
