"""Every occurrence of a disclosing term goes; terms of any letters, marks, digits and length; against brute force."""
import random

from sheaf.llm import pii
from tests.llm.test_pii import base, brute, redact

NAMES = ["O'Neil", "Smith-Jones", "Li", "jdoe42", "Zoéx", "हिन्दी", "barnstormer", "Q", "1987"]
WHO = ["ann.lee@x-mail.co.uk", "10.0.0.255", "4111 1111 1111 1111", "+1 (743) 555-3824", "b@c.de", "c@d.fr", "d@e.gh",
       "192.168.0.7", "e@f.gh"]


def texts():
    rng = random.Random(5)
    common = [f"{a}{b}{c}" for a in "bdfg" for b in "aeiou" for c in ("rn", "st", "lé")]
    out = [None, "", "a@b.cé x-y'z", "é-" * 200 + "x@y.z" + "-ß" * 200, "x@y.z_" * 300, "1 " * 2000 + "9", "\U0001F600" * 1500 + " b@c.de Li",
           "w " * 3000 + "Q b@c.de"]
    for k in range(160):
        w = [rng.choice(common) for _ in range(rng.randint(2, 50))]
        for _ in range(rng.randint(0, 3)):
            j = rng.randrange(len(NAMES))
            i = rng.randrange(len(w))
            w[i:i] = rng.choice([[NAMES[j]], [WHO[j], NAMES[j] + rng.choice(["", ",", "/x"])], [WHO[j], "filler", NAMES[j].upper()]])
        out.append(rng.choice([" ", "\n"]).join(w))
    out.append("barnacle barnyard barnful " * 200)
    return out + out[-4:]


def test_against_brute_force(spark):
    ts = texts()
    df = spark.createDataFrame(list(enumerate(ts)), "doc_id bigint, text string").repartition(4)
    want = brute(ts)
    alone = sum(k >= 4 for t, x in zip(ts, want) if not base(t) for _, k, _ in x)
    assert alone > 5 and {k for x in want for _, k, _ in x} == set(range(6))
    gone = {(ts[i] or "")[a:b].lower() for i, x in enumerate(want) for a, k, b in x if k >= 4}
    assert {"o'neil", "smith-jones", "li", "jdoe42", "हिन्दी"} <= gone
    for r in pii.with_spans(df).collect():
        assert [tuple(s) for s in r.all_spans] == want[r.doc_id], ts[r.doc_id]
    for r in pii.sanitise(df).collect():
        t = ts[r.doc_id]
        assert r.text == (redact(t, want[r.doc_id]) if want[r.doc_id] else t), t
