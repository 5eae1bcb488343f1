import math
import random
import re
from collections import Counter

from orderlens.llm import url_filter as uf

URLS = [
    None, "", "no scheme", "https://A.Example.COM/en/1?q#f", "http://www.example.com/en/2", "http://example.com/en", "x://com/", "x://com",
    "ftp://xexample.com/en/", "http://a.net/es/9", "http://a.net/fr/", "http://net/fr/x", "http://a.net/de/1", "http://h?x://y/z",
    "http://a.org#b/c", "http://É.net/es/1", "http://u@a.net:80/es/", "a://b://c/d", "http://a.org/x//y/", "://com/x", "http://İ.com/x",
    "http://a.org/" + "s/" * 3000,
]


def brute(url):
    url = url or ""
    if "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    best = (None, None)
    for rule, verdict in uf.RULES:
        domain, _, start = rule.partition("/")
        if (host == domain or host.endswith("." + domain)) and path.startswith("/" + start):
            if best[0] is None or len(rule) > len(best[0]):
                best = (rule, verdict)
    return host, path, *best


def test_rules_and_templates(spark):
    many = [f"http://many.org/{w}/{i}.html" for i in range(60) for w in ("de", "es")]
    many += [f"http://s{i % 5}.net/{w}/{i}" for i in range(100) for w in ("es", "fr")] + [f"http://n.org/u{'x' * i}/p" for i in range(30)]
    rows = list(enumerate(URLS + many)) + [(0, None)]
    df = spark.createDataFrame([(i, u, "z", "y") for i, u in rows], "page_id long, url string, host string, rule string")
    got = uf.judge_urls(df).collect()
    assert len(got) == len(rows)
    for r in got:
        host, path, rule, verdict = brute(rows[r.page_id][1])
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict in ("allow", "block") and (verdict is None or r.verdict == verdict)
    by = {(r.host, r.template): r for r in got}
    assert by["many.org", "/es/*"].verdict == "allow" and by["n.org", "/*/p"].verdict == "allow"
    assert uf.judge_urls(df.limit(0)).collect() == []


def test_a_blocked_template_takes_its_other_urls_along(spark):
    urls = [f"http://m.org/a{k}/{i}" for k in (1, 2, 3) for i in range(10)] + [f"http://m.org/x/{i}" for i in range(5)]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    rules = (("m.org/a1/", "block"), ("m.org/a2/", "block"))
    got = {(r.template, r.rule is None, r.verdict) for r in uf.judge_urls(df, rules=rules).collect()}
    assert got == {("/*/*", False, "block"), ("/*/*", True, "block"), ("/x/*", True, "allow")}


def split(path):
    return [x for x in path.split("/") if x]


def brute_templates(paths, variety=0.5, least=20):
    """Templates of one host's different paths, level by level."""
    segs = {p: ["*" if re.search(r"\d", x) else x for x in split(p)] for p in paths}
    level = 0
    while True:
        nodes = {}
        for p, x in segs.items():
            if len(x) > level:
                nodes.setdefault(tuple(x[:level]), []).append(p)
        nodes = {k: v for k, v in nodes.items() if len(v) >= least}
        if not nodes:
            return segs
        for below in nodes.values():
            kinds = {segs[p][level] for p in below} - {"*"}
            if len(kinds) >= max(least, variety * len(below)):
                for p in below:
                    segs[p][level] = "*"
        level += 1


def g(n, b, m, c):
    total = 0
    for seen, rows, both in ((b, n, b + c), (c, m, b + c), (n - b, n, n - b + m - c), (m - c, m, n - b + m - c)):
        total += seen * math.log(seen * (n + m) / (rows * both)) if seen else 0
    return 2 * total


def brute_scores(counts, prior=0.1, weight=4.0):
    """Labelled templates (tuples of segments) of one host to the scores of their branches."""

    def merge(node):  # -> (n, b, members) if the node is one branch, else None; finished branches go to ``done``
        children = {}
        for t in node:
            children.setdefault(t[0], {})[t[1:]] = node[t]
        found = []
        for seg, below in children.items():
            if set(below) == {()}:
                n, b, name = below[()]
                found.append((n, b, seg, [name]))
            else:
                one = merge(below)
                if one:
                    found.append((one[0], one[1], seg, one[2]))
                else:
                    mixed.add(id(node))
        share = lambda x: ((x[1] + prior * weight) / (x[0] + weight), x[0])
        runs = []
        for x in sorted(found, key=share):
            if runs and g(x[0], x[1], runs[-1][-1][0], runs[-1][-1][1]) <= uf.CRITICAL:
                runs[-1].append(x)
            else:
                runs.append([x])
        out = [(sum(x[0] for x in r), sum(x[1] for x in r), [m for x in r for m in x[3]]) for r in runs]
        if len(out) == 1 and id(node) not in mixed:
            return out[0]
        done.extend(out)
        return None

    done, mixed = [], set()
    whole = merge({(*t, ""): (*v, t) for t, v in counts.items()})
    if whole:
        done.append(whole)
    return {t: (b + prior * weight) / (n + weight) for n, b, members in done for t in members}


def test_trees_meet_brute_force(spark):
    rng = random.Random(6)
    rules = (("h.org/bad/", "block"), ("h.org/a/x/", "block"), ("h.org/a/y/", "block"), ("h.org/a/good/", "allow"), ("h.org/b/", "allow"), ("h.org/b/x/q/", "block"), ("i.org/n", "block"))
    words = ["a", "b", "x", "y", "bad", "good", "q", "deep", "n"]
    urls = [f"http://{rng.choice('hi')}.org/" + "/".join(rng.choices(words, k=rng.randrange(6))) + rng.choice(["", "/", f"/{k}"]) for k in range(700)]
    urls += [f"http://i.org/n/{''.join(rng.choices('abcdefgh', k=6))}/{rng.choice('uv')}" for _ in range(60)] + ["http://h.org", "http://h.org/bad/" + "s/" * 400]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = uf.judge_urls(df, rules=rules).collect()
    for host in ("h.org", "i.org"):
        mine = [r for r in got if r.host == host]
        segs = brute_templates({r.path for r in mine})
        counts = Counter()
        for r in mine:
            assert r.template == "".join("/" + x for x in segs[r.path])
            if r.rule:
                counts[tuple(segs[r.path]), r.verdict] += 1
        labelled = {t: (counts[t, "block"] + counts[t, "allow"], counts[t, "block"]) for t, _ in counts}
        scores = brute_scores(labelled)
        for r in mine:
            score = scores.get(tuple(segs[r.path]))
            assert (r.score is None) == (score is None) and (score is None or math.isclose(r.score, score, abs_tol=1e-8))
            if not r.rule:
                assert r.verdict == ("block" if score is not None and score >= 0.5 else "allow")


def test_merging_inner_branches_changes_a_verdict(spark):
    """Two small branches say too little alone; together they are blocked, and the unlike third one is not."""
    rules = (("m.org/es/news/a", "block"), ("m.org/fr/news/a", "block"), ("m.org/de/", "allow"))
    urls = [f"http://m.org/{w}/news/{k}{i}" for w, n in (("es", 3), ("fr", 2)) for k in "ab" for i in range(n)] + [f"http://m.org/de/news/{i}" for i in range(30)]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    merged = {(r.template, r.verdict) for r in uf.judge_urls(df, rules=rules).collect() if r.rule is None}
    assert merged == {("/es/news/*", "block"), ("/fr/news/*", "block")}
    alone = {(r.template, r.verdict) for r in uf.judge_urls(df, rules=rules, critical=-1.0).collect() if r.rule is None}
    assert alone == {("/es/news/*", "allow"), ("/fr/news/*", "allow")}


def test_levels_run_as_deep_as_the_paths_go(spark):
    """Clean pages below a long common prefix are not blocked by the bad ones beside them."""
    urls = [f"http://d.org/a/b/c/d/e/{w}/{i}" for w in ("good", "bad") for i in range(40)]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    rules = tuple((f"d.org/a/b/c/d/e/bad/{i}", "block") for i in range(10, 32))
    got = {(r.template, r.verdict) for r in uf.judge_urls(df, rules=rules).collect()}
    assert got == {("/a/b/c/d/e/good/*", "allow"), ("/a/b/c/d/e/bad/*", "block")}


def test_nulls_ties_and_repeats(spark):
    df = spark.createDataFrame([(None, "http://t.org/a/1"), (None, None), (1, "http://t.org/b/1"), (1, "http://t.org/b/1"), (2, "http://t.org/c/1")], "page_id long, url string")
    got = uf.judge_urls(df, rules=(("t.org/a/", "block"), ("t.org/b/", "block"))).collect()
    assert len(got) == 5 and {r.branch for r in got if r.rule} == {next(r.branch for r in got if r.rule)}
    assert {r.verdict for r in got if r.path == "/c/1" or not r.host} == {"allow"}
