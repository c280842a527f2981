import hashlib
import re

import pytest

from docspark.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

TEXTS = [
    "",
    "plain words only",
    "a@b.c a@b a@@b.c x.y%z+1-2@d-e.f.g, @x.y a@b.c@d.e .@-.- a@b.-c",
    "1.2.3.4 1.2.3.4.5.6.7.8 256.1.1.1 01.002.0003.255 1.2.3 11.22.33.444 a1.2.3.4b 0000000000000000000001.1.1.1",
    "4111 1111 1111 1111 4111-1111-1111-1112 4111111111111111 123456789012 41111111111111111111 5 5500 0000 0000 0004",
    "+1 (212) 555-0101 +49.30.123456 +1 +12345678 +123456789 +1-(2)-345678901234567 +1 (5 +1555-",
    "é\U0001f600 a@b.co \U0001f600 10.0.0.1 \U0001f600 +12 345 678 90",
    "9" * 5000 + "." + "a" * 20000 + "@" + "b" * 5,
    "@" * 3000 + "1." * 3000,
]


def brute(text):
    spans = [("email", *m.span()) for m in EMAIL.finditer(text)]
    spans += [("ip", *m.span()) for m in IP.finditer(text) if all(len(p.lstrip("0")) < 4 and int(p) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        d = re.sub("[^0-9]", "", m[0])
        total = sum(sum(divmod(int(c) * 2, 10)) if k % 2 else int(c) for k, c in enumerate(d[::-1])) if len(d) < 20 else 1
        if 13 <= len(d) <= 19 and total % 10 == 0:
            spans.append(("card", *m.span()))
    return spans + [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]


@pytest.mark.parametrize("k", range(len(TEXTS) - 2))
def test_base_rules(k):
    assert pii.base_spans(TEXTS[k]) == brute(TEXTS[k])


@pytest.mark.parametrize("text", TEXTS[-2:])
def test_long_runs_stay_linear(text):
    pii.base_spans(text * 20)
    pii.proposals(text * 20)


@pytest.fixture(scope="module")
def finder(spark):
    return pii.fit(spark.createDataFrame([], "doc_id long, text string"))


def test_added_spans(finder):
    found = lambda t: [(k, t[a:b]) for k, a, b in finder.extra(t, pii.base_spans(t))]
    key = "04dbebab91ab85687d33eeaaf9ac699e1188f962"
    assert ("secret", key) in found(f'here token = "{key}" and more')
    assert ("ssn", "123-45-6789") in found("his ssn: 123-45-6789 was there")
    assert ("email", "joe [at] mail [dot] com") in found("contact: joe [at] mail [dot] com today")
    assert found("in 2019-20 some 1234 of 5678, part 3.14 and 2024-01-02 were there; order 555 123 4567 left") == []
    assert found("clean words without any numbers (at) all") == []


def test_query_rows(table, hostile, finder):
    df = table(list(enumerate(TEXTS))).unionByName(hostile)
    got = pii.find(df, finder).collect()
    assert len(got) == df.count()
    want = {r["doc_id"]: brute(r["text"] or "") for r in table(list(enumerate(TEXTS[:-2]))).collect()}
    for r in pii.find(table(list(enumerate(TEXTS[:-2]))), finder).collect():
        spans = want[r["doc_id"]]
        assert r["base_sha256"] == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pii.BASE] == [sum(s[0] == k for s in spans) for k in pii.BASE]
        assert {f"{k}:{a}:{b}" for k, a, b in spans} <= set(r["spans"].split(",")) | {""}
    assert pii.find(df.limit(0), finder).count() == 0


def test_redact(table):
    df = table([(1, "to a@b.co or 10.0.0.1!"), (2, None), (3, "nothing here")])
    got = {r["doc_id"]: r["text"] for r in pii.redact(df).collect()}
    assert got == {1: "to [EMAIL] or [IP]!", 2: None, 3: "nothing here"}
    assert pii.redact(df).columns == df.columns
    assert pii.redacted("abcdef", [("ip", 1, 4), ("card", 2, 5)]) == "a[IP]f"


def test_spans_never_overlap_base_spans(finder):
    text = "1.2.3.4%" * 6 + "ssn 123-45-6789@x.yy and ssn: 123-45-6789"
    base = pii.base_spans(text)
    for kind, a, b in finder.extra(text, base):
        assert all(b <= c or d <= a for _, c, d in base), (kind, text[a:b])
    taken = pii.Taken([("email", 0, 60), ("ip", 0, 7), ("ip", 8, 15), ("card", 70, 75)])
    assert taken.hits(("ssn", 50, 61)) and not taken.hits(("ssn", 60, 70)) and taken.hits(("ssn", 74, 80))
    taken.add(("ssn", 60, 70))
    assert taken.hits(("phone", 69, 70))


def test_recall_and_precision_of_added_kinds(finder, words):
    """Items of every added kind put into invented prose: found whole; prose and look-alikes stay."""
    import base64

    rng = __import__("random").Random(11)
    hexes = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    coded = lambda n: base64.b64encode(rng.randbytes(n)).decode()
    part = lambda n: base64.urlsafe_b64encode(rng.randbytes(n)).decode().rstrip("=")
    makers = {
        "hex": lambda: ('token = "', hexes(40), '"'),
        "long": lambda: ('secret = "', hexes(700), '"'),
        "base64": lambda: ("api_key: ", coded(60), " "),
        "jwt": lambda: ('token = "', f"eyJ{part(30)}.eyJ{part(60)}.{part(40)}", '"'),
        "ssn": lambda: ("ssn: ", f"{rng.randint(100, 600)}-{rng.randint(10, 99)}-{rng.randint(1000, 9999)}", " "),
        "email": lambda: ("contact: ", f"{words(rng.random(), 1)} [at] mail [dot] com", " "),
    }
    for name, make in makers.items():
        hit = 0
        for k in range(40):
            lead, item, close = make()
            text = f"{words(k, 30)} {lead}{item}{close} {words(k + 500, 30)}"
            spans = finder.extra(text, pii.base_spans(text))
            hit += any(text[a:b] == item for _, a, b in spans)
            assert all(a < len(text) - len(words(k + 500, 30)) and b > len(words(k, 30)) for _, a, b in spans)
        assert hit >= 36, (name, hit)
    clean = [words(k, 200) for k in range(50)] + ["see docs/guide/chapter-12/section-3 or build.2024-01-02.release and v1.22.333-rc4 of 2020/2021"] * 5
    assert all(finder.extra(t, pii.base_spans(t)) == [] for t in clean)
