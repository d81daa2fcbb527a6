"""URL rules and host reputation against a plain rendering."""

import math
import random
from collections import defaultdict

import pytest

from firmweave.llm import url_filter as uf

ODD = [
    (None, None),
    (1, ""),
    (2, "no scheme at all"),
    (3, "http://"),
    (4, "://COM/x"),
    (5, "http://com"),
    (6, "http://notcom.org/en/"),
    (7, "https://user@WWW.Example.COM:8080/en/?q=1#x"),
    (8, "http://a.b.example.com/en/ä?x://y.net/es/"),
    (9, "http://x.net/es/\nline"),
    (10, "http://10.0.0.1/es/"),
    (11, "http://deep.shop.co.uk/fr/"),
    (11, "http://deep.shop.co.uk/fr/"),
    (12, "http://x.net/" + "long" * 20000),
    (13, "http://.com/a"),
    (14, "http://x.net./es/"),
]


def split_url(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, tail = rest[:cut], rest[cut:]
    path = tail[: min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
    return "".join(c.lower() if c in uf.UPPER else c for c in host), path


def ruled(host, path):
    fits = [r for r in uf.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.host + r.path), default=None)
    return (best.name, best.verdict) if best else (None, None)


def parents(host):
    name = host.rsplit("@", 1)[-1]
    name = name.rsplit(":", 1)[0] if name.rsplit(":", 1)[-1].isdigit() and ":" in name else name
    name = name[:-1] if name.endswith(".") else name
    labels = name.split(".")
    if len(labels) == 4 and all(x.isdigit() for x in labels):
        return name, ""
    width = 2 if ".".join(labels[-2:]) in uf.SUFFIXES else 1
    return ".".join(labels[-width - 1 :]), ".".join(labels[-width:])


def plain(rows):
    """page_id, host, path, rule, verdict of every row, by loops."""
    pages = [(p, *split_url(u)) for p, u in rows]
    outcomes = defaultdict(lambda: [0, 0])
    for _, host, path in pages:
        verdict = ruled(host, path)[1]
        outcomes[host][0] += verdict is not None
        outcomes[host][1] += verdict == "block"
    levels = [dict(outcomes), defaultdict(lambda: [0, 0]), defaultdict(lambda: [0, 0]), {"": [0, 0]}]
    up = [{h: parents(h)[0] for h in outcomes}, {}, {}]
    for host, (n, k) in outcomes.items():
        domain, suffix = parents(host)
        up[1][domain], up[2][suffix] = suffix, ""
        for level, key in zip(levels[1:], (domain, suffix, ""), strict=True):
            level[key][0] += n
            level[key][1] += k
    rates = [k / n for n, k in levels[2].values() if n]
    means, weight = {"": round((sum(rates) + uf.PRIOR_SUFFIXES / 2) / (len(rates) + uf.PRIOR_SUFFIXES), 9)}, None
    for level in (2, 1, 0):
        top, bottom = uf.PRIOR_WEIGHT * uf.PRIOR_CORRELATION, uf.PRIOR_WEIGHT
        for key, (n, k) in levels[level].items():
            all_n, all_k = levels[level + 1][up[level][key]]
            if n and all_n:
                m = all_k / all_n
                top += (k - n * m) ** 2 - n * m * (1 - m)
                bottom += n * (n - 1) * m * (1 - m)
        rho = round(min(max(top / bottom, uf.CORRELATION_BOUNDS[0]), uf.CORRELATION_BOUNDS[1]), 9)
        weight = (1 - rho) / rho
        means = {key: (k + weight * means[up[level][key]]) / (n + weight) for key, (n, k) in levels[level].items()}
    out = []
    for page, host, path in pages:
        rule, verdict = ruled(host, path)
        mean = means[host]
        low = mean - uf.Z * math.sqrt(mean * (1 - mean) / (outcomes[host][0] + weight + 1))
        out.append((page, host, path, rule, verdict or ("block" if low > uf.THRESHOLD else "allow")))
    return out


def frame(spark, rows):
    """With columns whose names clash with the operator's own."""
    full = [(p, u, "x", 1, "y", 2, "z") for p, u in rows]
    return spark.createDataFrame(full, "page_id long, url string, host string, n int, verdict string, mean int, domain string")


@pytest.mark.parametrize("seed", [1, 2])
def test_against_loops(spark, seed):
    rng = random.Random(seed)
    hosts = [f"{s}{i % 7}.d{i % 5}.{t}" for i, (s, t) in enumerate((s, t) for s in ("www.a", "b", "m.c") for t in ("net", "org", "co.uk", "com", "de"))]
    rows = [(i, f"http://{rng.choice(hosts) if rng.random() < 0.6 else hosts[0]}/{rng.choice(['en', 'es', 'fr', 'de'])}/{i}") for i in range(600)]
    rows += [(1000 + i, u) for i, (_, u) in enumerate(ODD)] + ODD
    found = [tuple(r)[:5] for r in uf.judge_urls(frame(spark, rows)).collect()]
    assert sorted(found, key=repr) == sorted(plain(rows), key=repr)
    assert {r[4] for r in found if r[3] is None} == {"allow", "block"}


def test_little_evidence_does_not_block(spark):
    rows = [(i, f"http://x.good.org/{i}") for i in range(50)] + [(100, "http://one.net/es/a"), (101, "http://one.net/de/a")]
    found = {r.page_id: r.verdict for r in uf.judge_urls(frame(spark, rows)).collect()}
    assert found[100] == "block" and all(found[i] == "allow" for i in range(50))


def test_no_rows_and_no_rules(spark):
    empty = uf.judge_urls(frame(spark, []))
    assert empty.count() == 0 and empty.columns[:5] == ["page_id", "host", "path", "rule", "verdict"]
    found = uf.judge_urls(frame(spark, ODD), rules=()).collect()
    assert len(found) == len(ODD) and {(r.rule, r.verdict) for r in found} == {(None, "allow")}


def test_only_jvm_operators(spark):
    plan = uf.judge_urls(frame(spark, ODD))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
