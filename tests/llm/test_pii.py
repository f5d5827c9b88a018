"""PII spans against plain regular expressions, and disclosing terms against brute force."""
import collections
import hashlib
import math
import random

import regex
from pyspark.sql import functions as F

from sheaf.llm import pii

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
         "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
         "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def valid(kind, s):
    d = regex.sub("[^0-9]", "", s)
    return {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in s.split(".")),
            "card": 12 <= len(d) <= 19 and luhn(d or "0"), "phone": 9 <= len(d) <= 15}[kind]


def base(text):
    out = []
    for k, kind in enumerate(PLAIN):
        for m in regex.finditer(PLAIN[kind], text or ""):
            if valid(kind, m.group()):
                out.append((m.start(), k, m.end(), m.group()))
    return sorted(out)


def entity(kind, s):
    k = list(PLAIN)[kind]
    return f"{k}:" + (s.lower() if k == "email" else s if k == "ip" else regex.sub("[^0-9]", "", s))


TERM = r"[\p{L}\p{M}\p{N}]++(?:['’‐‑-][\p{L}\p{M}\p{N}]++)*+"


def terms(text):
    """(term, start, end) outside the base entities."""
    blank = list(text)
    for a, _, b, _ in base(text):
        blank[a:b] = " " * (b - a)
    return [(m.group().lower(), m.start(), m.end()) for m in regex.finditer(TERM, "".join(blank))]


def brute(texts):
    n, seen, total = collections.Counter(), collections.defaultdict(set), collections.Counter()
    for t in texts:
        placed = terms(t or "")
        total.update(w for w, _, _ in placed)
        near = {(entity(k, s), w, x, y) for a, k, b, s in base(t) for w, x, y in placed
                if (y <= a and x >= a - 100) or (x >= b and y <= b + 100)}
        for e, w, _, _ in near:
            n[e, w] += 1
            seen[e, w].add(t)
    cls_n, cls_total, told = collections.Counter(), collections.Counter(), {}
    for (e, w), c in n.items():
        cls_n[e, w[:3]] += c
    for w, c in total.items():
        cls_total[w[:3]] += c
    for (e, w), c in n.items():
        if len(seen[e, w]) >= 3 and math.log2(total[w] / c) <= 2:
            broad = len(w) > 3 and math.log2(cls_total[w[:3]] / cls_n[e, w[:3]]) > 2
            told[w] = min(told.get(w, 5), 5 if broad else 4)
    return [sorted([x[:3] for x in base(t)] + [(a, told[w], b) for w, a, b in terms(t or "") if w in told]) for t in texts]


def texts():
    rng = random.Random(2)
    common = [f"{a}{b}{c}" for a in "bdfg" for b in "aeiou" for c in ("rn", "st", "lé")]
    people = [("ann.lee@x-mail.co.uk", "zyxwine"), ("10.0.0.255", "quarkling"), ("4111 1111 1111 1111", "vexillum"),
              ("+1 (743) 555-3824", "barnstormer")]
    out = [None, "", "a@b@c.d a@b.c_d@e.f .@x.y a@b.c.@x.y", "1.2.3.4.5.6.7.8 256.1.1.1 000255.1.01.0 12.3.4 1..2.3.4.5",
           "4111-1111 1111-1111 4111  1111 41111111111111112 5 55 0000000000000000 4111111111111111@x.com",
           "+1 23 +12 345 678 +1(((((...)))))234567890 +1                  2", "é" * 50 + " x@y.z " + "ß" * 50,
           "1" * 3000, "a" * 5000 + "@", "x.y." * 2000, "1.2.3.4@mail.example.com", "+4111111111111111", "1 " * 2000 + "9",
           "a@b.c " * 700, "foo, (bar) \"bazzy\" a@b.c (quux)! don't 12ab\x0bnext\x1cword"]
    for k in range(140):
        w = [rng.choice(common) for _ in range(rng.randint(3, 60))]
        for _ in range(rng.randint(0, 2)):
            who, clue = rng.choice(people)
            i = rng.randrange(len(w))
            w[i:i] = [who + rng.choice(["", ",", "."])] + ([clue + rng.choice(["", ";"])] if rng.random() < .7 else [])
        out.append(rng.choice([" ", "\n"]).join(w))
    out.append("barnacle barnyard barnful " * 200)
    return out + out[-6:] + out[-3:]


def test_spans_against_brute_force(spark):
    ts = texts()
    df = spark.createDataFrame(list(enumerate(ts)), "doc_id bigint, text string").repartition(4)
    done = pii.with_spans(df)
    got = {r.doc_id: r for r in done.select("doc_id", "entities", "all_spans", F.sha2(pii._listed(F.col("entities")), 256).alias("sha")).collect()}
    want = brute(ts)
    assert sum(k >= 4 for x in want for _, k, _ in x) > 20
    for i, t in enumerate(ts):
        b = base(t)
        assert [(e.start, e.kind, e.end) for e in got[i].entities] == [x[:3] for x in b], (i, t)
        assert [e.entity for e in got[i].entities] == [entity(k, s) for _, k, _, s in b]
        assert [tuple(s) for s in got[i].all_spans] == want[i], (i, t)
        listed = ",".join(f"{list(PLAIN)[k]}:{a}:{z}" for a, k, z, _ in b)
        assert got[i].sha == hashlib.sha256(listed.encode()).hexdigest()


def redact(text, spans):
    out, end = "", 0
    for a, k, z in spans:
        if a >= end:
            out += text[end:a] + (text[a:a + 3] + "*" if k == 5 else f"<{pii.KINDS[k].upper()}>")
        end = max(end, z)
    return out + text[end:]


def test_sanitise(spark):
    ts = texts()
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(ts)], "doc_id bigint, text string, entities string")
    out = pii.sanitise(df)
    assert out.columns == df.columns
    want = brute(ts)
    for r in out.collect():
        t = ts[r.doc_id]
        assert r.text == (t if not want[r.doc_id] else redact(t, want[r.doc_id])), t
        assert r.entities == "x"


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert pii.sanitise(df).count() == 0
