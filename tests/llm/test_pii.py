import hashlib
import random
import re
import time

import duckdb
from pyspark.sql import functions as F

from quire.llm import catalog, pii, rows
from tests.conftest import SF_SMALL


def luhn(d):
    return sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(map(int, reversed(d)))) % 10 == 0


def base_spans(text):
    text, out = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m.group())
        if 13 <= len(d) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append(("phone", *m.span()))
    return out


def row(doc_id, text):
    spans = base_spans(text)
    said = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
    return (doc_id, *(sum(s[0] == k for s in spans) for k in pii.BASE_KINDS), hashlib.sha256(said.encode()).hexdigest()), said


def test_query_equals_brute_force(spark):
    texts = duckdb.sql(f"select doc_id, text from '{SF_SMALL}/documents.parquet'").fetchall()
    want = dict((row(d, t)[0], row(d, t)[1]) for d, t in texts)
    got = [tuple(r) for r in catalog.op5_pii(spark, SF_SMALL).collect()]
    assert sorted(r[:-1] for r in got) == sorted(want)
    assert all(r[-1].startswith(want[r[:-1]]) for r in got)
    assert sum(len(w) > 0 for w in want.values()) > 5


def test_odd_texts(spark):
    rng = random.Random(8)
    bits = ["a@b.c", "@", ".", "x", "1", "22", "255", "256", " ", "-", "+4", "(", ")", "%d@e.f", "ä", "😀", "\n", "4111111111111111", "4111 1111 1111 1111", "1.2.3.4", "+49 (030) 555-123", "user.name+x@mail.example.org", "000.01.2.003"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(25))) for _ in range(500)]
    texts += [None, "", "a" * 60000 + "@", "1-" * 40000, "mail me: " + ", ".join(f"u{i}@ex{i}.com" for i in range(2000)), "1.2." * 30000, "+" * 5000 + "1" * 50]
    df = spark.createDataFrame(list(enumerate(texts)), "row bigint, text string").withColumn("found", F.lit("clash"))
    got = {r.row: [tuple(s) for s in r.spans if s.kind in pii.BASE_KINDS] for r in pii.find(df, F.col("text"), {"row": F.col("row"), "found": F.col("found")}).collect()}
    for i, t in enumerate(texts):
        assert got[i] == base_spans(t), repr(t)[:200]
    assert pii.find(df.limit(0), F.col("text"), {"row": F.col("row")}).count() == 0


def test_sums_before(spark):
    for n in (0, 1, 255, 256, 257, 1000):
        v = list(range(n))
        df = spark.createDataFrame([(v,)], "v array<int>").select(rows.sums_before(F.col("v")).alias("s"))
        assert df.first().s == [sum(v[:i]) for i in range(n)]
        rng = random.Random(n)
        v = [rng.randrange(100000) for _ in v]
        df = spark.createDataFrame([(v,)], "v array<int>").select(rows.most_before(F.col("v")).alias("s"))
        assert df.first().s == [max(v[:i], default=-1) for i in range(n)]


def test_label_model_finds_the_reliable_labelers():
    rng = random.Random(9)
    patterns, truth = {}, {}
    for _ in range(20000):
        y = rng.random() < 0.4
        right = [0.95, 0.8, 0.55, 0.9, 0.7]
        votes = tuple(0 if rng.random() < 0.2 else (1 if (rng.random() < r) == y else -1) for r in right)
        p = (rng.randrange(len(pii.KINDS)), *votes)
        patterns[p] = patterns.get(p, 0) + 1
        truth[p] = truth.get(p, 0) + y
    posterior = pii.reliabilities(patterns)
    weights = pii.train(patterns, posterior)
    decided = {p: sum(a * b for a, b in zip(pii._inputs(p), weights)) >= 0 for p in patterns}
    right = sum(truth[p] if decided[p] else n - truth[p] for p, n in patterns.items())
    majority = sum(truth[p] if sum(p[1:]) > 0 else n - truth[p] for p, n in patterns.items())
    assert right / 20000 > 0.93 and right >= majority


def test_looser_spans_and_redaction(spark):
    rng = random.Random(11)
    good = [f"please call our phone 030 {rng.randrange(1000, 9999)} {rng.randrange(100, 999)} 77 today" for _ in range(60)]
    mails = [f"contact mail u{i}@example.com or call +49 30 {rng.randrange(1000000, 9999999)}" for i in range(120)]
    clean = [f"see section {i}, version 2.{i}.0 of the text" for i in range(60)]
    texts = good + mails + clean + [None, "", "Dear Mrs Maria Lopez, name signed"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {r.doc_id: [s.kind for s in r.spans] for r in pii.find(df, F.col("text"), {"doc_id": F.col("doc_id")}).collect()}
    assert all("local_phone" in found[i] for i in range(60))
    assert all(found[i] == ["email", "phone"] for i in range(60, 180))
    assert all(found[i] == [] for i in range(180, 242))
    out = {r.doc_id: r.text for r in pii.redact(df).collect()}
    assert out[60] == "contact mail [EMAIL] or call [PHONE]" and out[0].startswith("please call our phone [LOCAL_PHONE] today")
    assert all(out[i] == texts[i] for i in range(180, 242))


def test_redaction_of_overlapping_spans(spark):
    span = "array<struct<kind:string,start:int,end:int>>"
    df = spark.createDataFrame([("ä😀cdefghij", [("ip", 2, 5), ("card", 4, 7), ("email", 7, 8), ("phone", 0, 1)]), ("x", []), (None, [])], f"text string, spans {span}")
    got = [r[0] for r in df.select(pii.redacted(F.col("text"), F.col("spans"))).collect()]
    assert got == ["[PHONE]😀[IP][EMAIL]ij", "x", None]


def test_redaction_equals_brute_force(spark):
    rng = random.Random(13)
    data = []
    for n in (0, 1, 4095, 4096, 4097, 20000):
        text = "".join(rng.choice("aä😀\n ") for _ in range(n))
        for share in (0, 0.002, 0.05):
            starts = sorted(rng.randrange(n) for _ in range(int(n * share)))
            data.append((text, [(rng.choice(pii.KINDS), a, min(n, a + rng.choice([1, 3, 20, 5000 if n > 10000 and rng.random() < 0.02 else 2]))) for a in starts]))

    def brute(text, spans):
        out, at, end = [], 0, -1
        for a, b, kind in sorted((a, b, k) for k, a, b in spans):
            if a >= end:
                out += [text[at if end < 0 else end : a], f"[{kind.upper()}]"]
            end = max(end, b)
        return "".join(out) + text[max(end, 0) :]

    df = spark.createDataFrame([(i, *d) for i, d in enumerate(data)], "i int, text string, spans array<struct<kind:string,start:int,end:int>>")
    got = dict(df.select("i", pii.redacted(F.col("text"), F.col("spans"))).collect())
    for i, (text, spans) in enumerate(data):
        assert got[i] == brute(text, spans), i


def test_looser_spans_clear_of_others(spark):
    rng = random.Random(14)
    data = []
    for n in (0, 1, 3, 30, 600):
        for m in (0, 1, 5, 600):
            own = sorted({rng.randrange(20 * (n + m)) for _ in range(n)}) if n else []
            data.append(([(a, a + rng.randrange(1, 12)) for a in own], [(a, a + rng.randrange(1, 40)) for a in (rng.randrange(20 * (n + m)) for _ in range(m))]))
    spans = "array<struct<start:int,end:int>>"
    df = spark.createDataFrame([(i, *d) for i, d in enumerate(data)], f"i int, a {spans}, b {spans}")
    got = {r.i: [tuple(s) for s in r.kept] for r in df.select("i", pii._clear_of(F.col("a"), F.col("b")).alias("kept")).collect()}
    for i, (own, others) in enumerate(data):
        assert got[i] == [s for s in own if not any(x[0] < s[1] and s[0] < x[1] for x in others)], i


def test_many_spans_in_one_text(spark):
    n = 32000
    text = "".join(f"u{i}@ex.com 030 {i % 9000 + 1000} 555 77, " for i in range(n))
    df = spark.createDataFrame([(text,)], "text string")
    begun = time.monotonic()
    out = pii.redact(df).first().text
    assert out.count("[EMAIL]") == n and "@" not in out
    assert time.monotonic() - begun < 60
