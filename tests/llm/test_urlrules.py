"""URL rules: mined sets, pruning and matching against brute force over all token subsets."""
import collections
import itertools
import random
import re

from pyspark.sql import functions as F

from sheaf.llm import urlrules as U


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    m = re.match(r"(?s)([^/?#]*)([^?#]*)", rest)
    return re.sub("[A-Z]", lambda x: x.group().lower(), m.group(1)), m.group(2)


def tokens(url):
    if url is None or "://" not in url:
        return frozenset()
    host, path = split(url)
    labels = host.split(".")
    kind = re.search(r"\.([A-Za-z0-9]+)\Z", path)
    segments = [s for s in re.sub(r"\.[A-Za-z0-9]+\Z", "", path).split("/") if s]
    query = re.search(r"\?([^#]*)", url)
    subs = labels[:max(len(labels) - 2, 0)]
    out = {"scheme=" + re.match(r"(?s)(.*?)://", url).group(1), "site=" + ".".join(labels[-2:])}
    out |= {"sub=" + x for x in subs} | {"word=" + w for x in subs if "-" in x for w in x.split("-")}
    out |= {"path=" + s for s in segments if not re.search("^[0-9]+$", s)} | {"type=" + kind.group(1) for _ in [0] if kind}
    out |= {"key=" + k for k in re.findall(r"(?:^|&)([^=&]+)", query.group(1) if query else "")}
    return frozenset(out)


def brute(urls, bad, support, confidence, lift):
    known = [(tokens(u), bad[d]) for u in urls for d in [doc(u)] if d in bad]
    n, freq, hit = len(known), collections.Counter(), collections.Counter()
    for t, b in known:
        for k in range(1, len(t) + 1):
            for s in itertools.combinations(sorted(t), k):
                freq[s] += 1
                hit[s, b] += 1
    least, share = max(support * n, U.MIN_COUNT), {b: sum(x == b for _, x in known) / n for b in (True, False)}
    rules = {(s, "block" if b else "allow"): (h, h / freq[s]) for (s, b), h in hit.items()
             if h >= least - 1e-9 and h / freq[s] >= confidence and h / freq[s] >= lift * share[b]}
    kept = {r: v for r, v in rules.items() if not any(
        q[1] == r[1] and len(q[0]) < len(r[0]) and set(q[0]) < set(r[0]) and rules[q][1] >= v[1] for q in rules)}
    verdict = {}
    for u in urls:
        t = tokens(u)
        best = max(((c, h, len(s), " ".join(s), v) for (s, v), (h, c) in kept.items() if set(s) <= t), default=None)
        if best:
            verdict[u] = best[4]
    return kept, verdict


def doc(u):
    m = re.search(r"(?s)^.*/([0-9]{1,18})(?:\.[a-z]+)?(?:/|$)", split(u)[1])
    return int(m.group(1)) if m else None


def data():
    rng, urls, bad = random.Random(6), [], {}
    for d in range(160):
        spam = rng.random() < .3
        host = rng.choice(["cheap-pills", "casino-win"]) if spam else rng.choice(["news", "blog", "shop"])
        urls.append(f"http://{host}.example.{rng.choice(['com', 'org', 'net'])}/{rng.choice(['en', 'de'])}/{d}"
                    + rng.choice(["", "/", ".html", "?ref=x", "#top"]))
        if rng.random() < .8:
            bad[d] = spam if rng.random() < .93 else not spam
    urls += [None, "", "no scheme/en/3", "HTTP://WWW.Example.NET", "x://", "a://net", "a://b.net/x?y#z", "a://example.com.evil/de/", "a://ÉX.org/fr/1"]
    return urls + urls[:20] + urls[-9:], bad


def test_rules_and_verdicts(spark):
    urls, bad = data()
    labels = [(d, b) for d, b in bad.items()] + [(5000, True), (None, True), (next(iter(bad)), None)]
    pages = spark.createDataFrame([(i if i % 13 else None, u) for i, u in enumerate(urls)], "page_id bigint, url string")
    marked = spark.createDataFrame(labels, "id bigint, bad boolean")
    kept, verdicts = brute(urls, bad, U.MIN_SUPPORT, U.MIN_CONFIDENCE, U.MIN_LIFT)
    with U.Scratch(spark) as scratch:
        rules = U.mine(pages.select("url"), marked, scratch).collect()
    got = {(tuple(r.tokens), r.verdict): (r.support, r.confidence) for r in rules}
    assert len(kept) > 3 and {v for _, v in kept} == {"block", "allow"}
    assert got == kept
    out = U.judge(pages.withColumn("rule", F.lit("mine")).withColumn("tokens", F.lit(0)), marked)
    assert out.columns == ["page_id", "url", "rule", "tokens", "host", "path", "_rule", "verdict", "mined_rule"]
    rows = out.collect()
    assert len(rows) == len(urls)
    for r in rows:
        host, path = split(r.url)
        fits = [(len(h + p), h + p, v) for h, p, v in U.LISTED if (host == h or host.endswith("." + h)) and path.startswith(p)]
        want = max(fits)[1:] if fits else (None, verdicts.get(r.url, "allow"))
        assert (r.host, r.path, r["_rule"], r.verdict) == (host, path, *want), r.url


def test_no_labels_and_empty_tables(spark):
    urls, bad = data()
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id bigint, url string")
    none = spark.createDataFrame([], "id bigint, bad boolean")
    assert U.judge(pages, none).count() == len(urls)
    assert U.judge(pages.limit(0), none).count() == 0
