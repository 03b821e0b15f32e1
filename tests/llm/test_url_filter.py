import random
import re

import pytest

from ledgerline.llm import url_filter as uf

CASES = {
    "http://a.com/x": ("a.com", "/x", "com/", "allow"),
    "http://com": ("com", "", None, None),
    "HTTP://WWW.Example.COM/en/1?q": ("www.example.com", "/en/1", "www.example.com/en/", "allow"),
    "https://m.www.example.com/en/": ("m.www.example.com", "/en/", "www.example.com/en/", "allow"),
    "https://m.example.com/en/x#y": ("m.example.com", "/en/x", "example.com/en/", "block"),
    "https://myexample.com/en/x": ("myexample.com", "/en/x", "com/", "allow"),
    "https://example.com/EN/x": ("example.com", "/EN/x", "com/", "allow"),
    "https://a.net/es/1": ("a.net", "/es/1", "net/es/", "block"),
    "https://a.net/es": ("a.net", "/es", None, None),
    "https://a.net?x=/es/": ("a.net", "", None, None),
    "https://a.org/p://b.net/es/": ("a.org", "/p://b.net/es/", None, None),
    "x://é.NET/fr/\nq": ("é.net", "/fr/\nq", "net/fr/", "block"),
    "no scheme": ("", "", None, None),
    "": ("", "", None, None),
    None: ("", "", None, None),
}


def test_hosts_paths_and_rules(spark):
    rows = [(i, u, None) for i, u in enumerate(CASES)]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, host string, n int")
    got = {r.url: (r.host, r.path, r.rule, r.by_rule) for r in uf.judged_by_rules(frame.select("page_id", "url")).collect()}
    assert got == CASES


def brute(pages):
    """Verdicts by dense iteration."""
    host = lambda u: (m[1].lower() if (m := re.match(r"(?s).*?://([^/?#]*)", u or "")) else "")
    hosts, edges, judged = set(), {}, []
    for p, u, html in pages:
        hosts.add(host(u))
        for to in re.findall(r"""(?i)href\s*=\s*["']?((?:[a-z][a-z0-9+.-]*:)?//[^"'\s>]+)""", html or ""):
            to = "x:" + to if to.startswith("//") else to
            if host(u) and host(to) and host(u) != host(to):
                edges[host(u), host(to)] = edges.get((host(u), host(to)), 0) + 1
                hosts.add(host(to))
        path = m[1] if (m := re.match(r"(?s).*?://[^/?#]*([^?#]*)", u or "")) else ""
        fit = [r for r in uf.RULES if (host(u) == r[0].split("/")[0] or host(u).endswith("." + r[0].split("/")[0])) and path.startswith("/" + r[0].partition("/")[2])]
        judged.append((p, u, max(fit, key=lambda r: len(r[0])) if fit else None))
    score = {}
    for name, verdict, flip in (("t", "allow", False), ("d", "block", True)):
        own = [host(u) for _, u, r in judged if r and r[1] == verdict]
        seed = {h: own.count(h) / len(own) * (1 - uf.DAMPING) for h in set(own)}
        step = {((b, a) if flip else (a, b)): n for (a, b), n in edges.items()}
        out = {}
        for (a, _), n in step.items():
            out[a] = out.get(a, 0) + n
        now = dict(seed)
        for _ in range(300):
            new = dict(seed)
            for (a, b), n in step.items():
                new[b] = new.get(b, 0) + uf.DAMPING * now.get(a, 0) * n / out[a]
            now = new
        score[name] = now
    verdicts = []
    for p, u, r in judged:
        t, d = score["t"].get(host(u), 0), score["d"].get(host(u), 0)
        verdicts.append((p, r[0] if r else None, r[1] if r else "block" if d > uf.THRESHOLD * (t + d) else "allow"))
    return sorted(verdicts, key=str), score


def pages(seed):
    rng = random.Random(seed)
    hosts = [f"h{i}.{t}" for i in range(12) for t in ("com", "net", "org")] + ["www.example.com", "x.example.com"]
    rows = []
    for p in range(150):
        links = "".join(f'<a HREF="{rng.choice(["http:", "HTTPS:", ""])}//{rng.choice(hosts)}/{rng.choice("ab")}">x</a><a href="/own">' for _ in range(rng.randrange(4)))
        rows.append((p, f"http://{rng.choice(hosts)}/{rng.choice(['en', 'fr', 'es'])}/{p}", links if p % 9 else None))
    return [*rows, (150, None, links), (151, "nothing", links), (3, *rows[3][1:])]


def test_scores_and_verdicts_equal_dense_iteration(spark):
    for seed in (1, 2):
        rows = pages(seed)
        frame = spark.createDataFrame([(*r, 5, "x") for r in rows], "page_id long, url string, html string, trust int, src string")
        want, score = brute(rows)
        got = {r.host: (r.trust, r.distrust) for r in uf.host_scores(frame).collect()}
        for h in set(score["t"]) | set(score["d"]):
            assert abs(got[h][0] - score["t"].get(h, 0)) < 1e-5 and abs(got[h][1] - score["d"].get(h, 0)) < 1e-5
        assert sorted(((r.page_id, r.rule, r.verdict) for r in uf.judge(frame.repartition(3)).collect()), key=str) == want
        assert {"block", "allow"} == {v for _, r, v in want if r is None}


def test_distrust_reaches_the_end_of_a_chain(spark, monkeypatch):
    chain = [(i, f"http://h{i}.org/", f'<a href="http://h{i + 1}.org/">') for i in range(25)]
    rows = [*chain, (25, "http://h25.org/", '<a href="//bad.net/fr/">'), (26, "http://bad.net/fr/", ""), (27, "http://other.org/", "")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.verdict for r in uf.judge(frame).collect()}
    assert got == {i: "allow" if i == 27 else "block" for i in range(28)}
    edges = uf.host_links(frame)
    seeds = spark.createDataFrame([("h0.org", 1.0)], "host string, weight double")
    with pytest.raises(RuntimeError, match="after 5 iterations"):
        uf.personalised(edges, seeds, "few", most=5)


def test_no_links_and_empty_table(spark):
    frame = spark.createDataFrame([(1, "http://a.net/fr/", "<p>"), (2, "http://a.net/en/", None), (3, "http://b.org/", "")], "page_id long, url string, html string")
    assert {(r.page_id, r.verdict) for r in uf.judge(frame).collect()} == {(1, "block"), (2, "block"), (3, "allow")}
    assert uf.judge(frame.limit(0)).collect() == []
