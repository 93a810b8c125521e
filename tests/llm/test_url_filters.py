import random
import re
from collections import defaultdict

from quillspark.llm import url_filters as uf
from quillspark.llm.queries import URL_RULES
from quillspark.llm.url_filters import judge_urls


def parse(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def ruled(host, path):
    best = None
    for verdict, rule in URL_RULES:
        name, rest = rule.split("/", 1)
        if (host == name or host.endswith("." + name)) and path.startswith("/" + rest) and (best is None or len(rule) > len(best[0])):
            best = (rule, verdict)
    return best or (None, None)


def test_rules_and_parsing(spark):
    urls = [
        None, "", "no scheme.com/en/", "http://", "http://com/x", "http://com", "HTTP://WWW.Example.COM/en/1", "http://example.com/en/", "http://a.www.example.com/en/x?y", "http://example.com/EN/",
        "http://x.net/es/1#t", "http://x.net/es", "http://net/fr/", "http://xnet/fr/", "ftp://a.org://b.net/es/", "http://x.com?u=/en/", "http://exa mple.com/en/\nx", "http://ÀB.com/", "://h.net/fr/9", "http://example.com/en/en/",
    ]
    df = spark.createDataFrame([(k, u, "z") for k, u in enumerate(urls)] + [(None, urls[6], "z"), (3, urls[3], "z")], "page_id long, url string, host string")
    got = judge_urls(df, URL_RULES).collect()
    assert len(got) == len(urls) + 2
    for r in got:
        url = urls[r.page_id] if r.page_id is not None else urls[6]
        host, path = parse(url)
        rule, verdict = ruled(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict in ("allow", "block") and (verdict is None or r.verdict == verdict)
    assert judge_urls(df.limit(0), URL_RULES).collect() == []
    assert {r.verdict for r in judge_urls(df, []).collect()} == {"allow"}


def test_templates_like_brute_force(spark):
    rng = random.Random(1)
    rules = [("block", "bad.net/spam/"), ("allow", "bad.net/news/"), ("block", "mix.org/a/x"), ("allow", "mix.org/a/y"), ("block", "many.io/u/q")]
    urls = []
    for k in range(1500):
        host = rng.choice(["bad.net", "w.bad.net", "mix.org", "many.io", "free.org"])
        top = rng.choice(["spam", "news", "a", "b", "c"])
        tail = rng.choice([str(k), f"{k}.html", f"x{rng.randrange(40)}", f"y{rng.randrange(40)}", "deadbeef01", f"q{rng.randrange(3)}", ""])
        urls.append(f"https://{host}/{top}/{tail}")
        if host == "many.io":
            urls.append(f"http://many.io/u/{rng.choice('pqr')}{k}zz/page")
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: r for r in judge_urls(df, rules).collect()}
    # brute force: the same definitions, page by page
    def kind(s):
        if re.fullmatch(r"[0-9]+", s):
            return "{num}"
        if m := re.fullmatch(r"[0-9]+(\.[A-Za-z]{1,5})", s):
            return "{num}" + m[1]
        return "{hex}" if re.fullmatch(r"[0-9A-Fa-f]{8,}", s) else s

    pages = []
    for u in urls:
        host, path = parse(u)
        hit = max(((len(r), v) for v, r in rules if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith("/" + r.split("/", 1)[1])), default=(0, None))
        pages.append([host, [kind(s) for s in path.split("/")[1:]], hit[1], ""])
    for level in range(4):
        kids = defaultdict(list)
        for host, segs, _, t in pages:
            if level < len(segs):
                kids[host, t].append(segs[level])
        for p in pages:
            if level < len(p[1]):
                mine = kids[p[0], p[3]]
                variable = len(set(mine)) >= uf.MANY and len(set(mine)) >= uf.VARIED * len(mine)
                p[3] += "/" + ("*" if variable and not p[1][level].startswith("{") else p[1][level])
    stats = defaultdict(lambda: [0, 0])
    for host, _, v, t in pages:
        stats[host, t][0] += v is not None
        stats[host, t][1] += v == "block"
    pooled = defaultdict(list)
    for (host, t), (l, b) in stats.items():
        parts = t.split("/")
        for at in range(1, len(parts)):
            if parts[at] not in ("*", "") and not parts[at].startswith("{"):
                pooled[host, "/".join(parts[:at] + ["*"] + parts[at + 1 :])].append((at, t, l, b))
    into = {}
    for (host, wider), members in sorted(pooled.items()):
        total, blocked = sum(m[2] for m in members), sum(m[3] for m in members)
        if len(members) > 1 and total:
            rate = blocked / total
            same = [m for m in members if m[2] >= uf.COMPARED and abs(m[3] / m[2] - rate) < uf.SIMILAR * (max(rate * (1 - rate), 1e-9) / m[2]) ** 0.5]
            if len(same) > 1:
                for at, t, _, _ in same:
                    into[host, t] = min(into.get((host, t), (99,)), (at, wider, sum(m[2] for m in same), sum(m[3] for m in same)))
    n, b = sum(s[0] for s in stats.values()), sum(s[1] for s in stats.values())
    for k, (host, _, v, t) in enumerate(pages):
        _, wider, l, bl = into.get((host, t), (0, t, *stats[host, t]))
        purity = (bl + uf.PRIOR * b / n) / (l + uf.PRIOR)
        want = v or ("block" if l and purity >= uf.REJECT else "allow")
        assert (got[k].template, got[k].labelled, got[k].verdict) == (wider, l, want), urls[k]
        assert abs(got[k].purity - purity) < 1e-9
    assert any(r.rule is None and r.verdict == "block" for r in got.values())
    assert any("*" in r.template for r in got.values())
