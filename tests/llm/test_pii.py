import hashlib
import random
import re

import pytest
from conftest import DATA

from llm import pii
from llm.session import table

PATTERNS = [
    ("email", re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")),
    ("ip", re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")),
    ("card", re.compile(r"[0-9]([\x20-]?[0-9])+")),
    ("phone", re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")),
]


def luhn(d):
    return sum(sum(divmod(int(c) * 2, 10)) if i % 2 else int(c) for i, c in enumerate(reversed(d))) % 10 == 0


def valid(kind, m):
    d = re.sub("[^0-9]", "", m)
    return {
        "email": lambda: True,
        "ip": lambda: all(int(x) <= 255 for x in m.split(".")),
        "card": lambda: 16 <= len(d) <= 19 and luhn(d),
        "phone": lambda: 8 <= len(d) <= 15,
    }[kind]()


def base(text):
    return [f"{k}:{m.start()}:{m.end()}" for k, p in PATTERNS for m in p.finditer(text or "") if valid(k, m[0])]


def check(df, texts):
    for r in df.collect():
        want = base(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), (texts[r.doc_id], want, r.spans)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(x.startswith(k + ":") for x in want) for k, _ in PATTERNS]
        spans = r.spans.split(",") if r.spans else []
        assert [s for s in spans if s.split(":")[0] in ("email", "ip", "card", "phone")] == want


def test_query_equals_brute_force(spark):
    texts = {r.doc_id: r.text for r in table(spark, DATA, "documents").collect()}
    check(pii.op8_pii(spark, DATA), texts)


def test_random_texts(spark):
    rnd = random.Random(4)
    bits = ["a@b.co", "x.y+z@m-1.example.org", "@", ".", "-", " ", "+1 (319) 555-5132", "+49", "12.34.56.78", "300.1.1.1", "1.2.3.4.5.6.7.8.9", "007.1.1.1", "4425414259157784", "4425 4142-5915 7784", "12345678", "é", "漢", "word", "(", ")", "9", "0", "password=7602ad27cf", "\n", "_", "%"]
    texts = {i: "".join(rnd.choice(bits) for _ in range(rnd.randint(0, 25))) for i in range(1500)}
    check(pii.find_pii(spark.createDataFrame(list(texts.items()), "doc_id long, text string")), texts)


def test_long_runs_need_no_stack(spark):
    texts = {1: "1 " * 60_000, 2: "a" * 60_000, 3: "1" * 60_000, 4: "a." * 30_000 + "@", 5: "+" + "1" * 60_000, 6: "x@" + "a." * 20_000 + "b", 7: None, 8: ""}
    check(pii.find_pii(spark.createDataFrame(list(texts.items()), "doc_id long, text string")), texts)


def test_method_adds_secrets_and_keeps_to_them(spark):
    rows = [(i, f"the password=7602ad27cf{i} ends") for i in range(30)] + [(100, "my password is long"), (101, "id 123-45-6789 here"), (102, 'token = "0641917ea4e9feb9"')]
    got = {r.doc_id: r for r in pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[i].n_secret == 1 and got[i].spans.startswith("secret:4:") for i in range(30))
    assert got[100].spans == "" and got[102].n_secret == 1


def test_label_model_ranks_voters():
    rnd = random.Random(7)
    counts = {}
    for _ in range(4000):
        y = rnd.random() < 0.4
        good = [1 if (y if rnd.random() < 0.9 else not y) else -1 for _ in range(2)]
        v = (*good, rnd.choice([-1, 0, 1]), 1 if (y if rnd.random() < 0.7 else not y) else -1)
        counts[0, v, y] = counts.get((0, v, y), 0) + 1
    rows, truth = {}, {}
    for (k, v, y), n in counts.items():
        rows[k, v] = rows.get((k, v), 0) + n
        truth[k, v] = truth.get((k, v), 0) + n * y
    table = [(k, v, n) for (k, v), n in rows.items()]
    post, share, rates = pii.fit_labelers(table)
    hit = sum(max(truth[x] if post[x] >= 0.5 else n - truth[x], 0) for x, n in rows.items())
    assert hit / 4000 > 0.88 and abs(share[0] - 0.4) < 0.08
    assert rates[0][0][2] > rates[3][0][2] > rates[2][0][2]
    w = pii.fit_classifier(table, post)
    assert w[-4] > w[-1] > abs(w[-2])


def test_empty_clashing_and_native(spark):
    df = spark.createDataFrame([(None, "a@b.co", 1), (None, "a@b.co", 1)], "doc_id long, text string, spans int")
    out = pii.find_pii(df)
    assert [r.spans for r in out.collect()] == ["email:0:6"] * 2
    assert pii.find_pii(df.limit(0)).count() == 0
    plan = pii.candidate_spans(df)._jdf.queryExecution().toString() + out._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("threshold", [0.5])
def test_no_candidates_at_all(spark, threshold):
    out = pii.find_pii(spark.createDataFrame([(1, "plain words")], "doc_id long, text string"), threshold).first()
    assert out.spans == "" and out.base_sha256 == hashlib.sha256(b"").hexdigest()


def test_long_secrets_and_secrets_about_base_spans_are_whole(spark):
    long = "".join("aB3xZ9kQ"[i % 8] for i in range(900))
    values = [long, "me@corp.com!Xy9aB", "Zq7+4915512345678kLm", "Ab9-10.20.30.40-xY7", "aB1" * 20_000]
    texts = {i: f"my password={v} ends" for i, v in enumerate(values * 6)}
    df = pii.find_pii(spark.createDataFrame(list(texts.items()), "doc_id long, text string"))
    check(df, texts)
    for r in df.collect():
        assert f"secret:3:{len(texts[r.doc_id]) - 5}" in r.spans.split(",") and r.n_secret == 1


def test_many_spans_of_a_text_have_the_right_places(spark):
    texts = {n: "é see 10.2.3.4, +49 319 555 5132 or x@y.org;" * n for n in (1, 127, 128, 129, 256, 257, 20_000)}
    check(pii.find_pii(spark.createDataFrame(list(texts.items()), "doc_id long, text string")), texts)
