"""Personal data: fixed rules, and further spans that boosted trees choose among many proposals."""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docspark.llm.boosting import Forest, platt, sigmoid, train
from docspark.llm.common import narrowed, releasing

Span = tuple[str, int, int]

# Kinds in the order in which spans are listed, the base ones first.
BASE = ["email", "ip", "card", "phone"]
KINDS = [*BASE, "iban", "secret", "ssn"]

#: Texts whose proposals the trees learn from, and proposals of them.
SAMPLE, PROPOSALS = 2_000, 20_000
#: Texts redacted at a time.
ROWS = 512
#: Least calibrated probability of an added span, and the precision each kind's threshold must show on held-out rows.
LEAST, PRECISION = 0.9, 0.98

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_NOT_LOCAL = re.compile(r"[^A-Za-z0-9._%+-]")
# possessive, and only from the start of a run of digits: a later start of the same run fails where the first does
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping addresses. Each @ is looked at once, so that a text without spaces costs no more."""
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        lo = at
        while lo > last and not _NOT_LOCAL.match(text, lo - 1):
            lo -= 1
        m = _DOMAIN.match(text, at + 1) if lo < at else None
        if m:
            out.append((lo, m.end()))
        last = m.end() if m else at + 1
        at = text.find("@", last)
    return out


def _octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and int(part) <= 255


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _digits(part: str) -> str:
    return "".join(_DIGIT.findall(part))


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed rules, kind by kind. A match that fails its test is dropped; nothing is tried inside it."""
    out = [("email", a, b) for a, b in emails(text)]
    if not _DIGIT.search(text):
        return out
    out += [("ip", *m.span()) for m in _IP.finditer(text) if all(map(_octet, m[0].split(".")))]
    out += [("card", *m.span()) for m in _CARD.finditer(text) if 13 <= len(d := _digits(m[0])) <= 19 and luhn(d)]
    out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return out


# Generators: many proposals, most of them wrong. Each is linear in the text.
_GENERATORS = [
    ("email", re.compile(r"(?<![A-Za-z0-9])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63} ?[\[({](?:at|AT|@)[\])}] ?[A-Za-z0-9-]{1,63}(?: ?[\[({](?:dot|DOT|\.)[\])}] ?[A-Za-z0-9-]{1,63}|\.[A-Za-z0-9-]{1,63}){1,4}")),
    ("phone", re.compile(r"(?<![0-9A-Za-z.])[(]?[0-9]{2,5}[)]?(?:[\x20./-][(]?[0-9]{2,6}[)]?){1,4}(?![0-9A-Za-z])")),
    ("phone", re.compile(r"(?<![0-9A-Za-z.+])0[0-9]{8,13}(?![0-9A-Za-z])")),
    ("card", re.compile(r"(?<![0-9A-Za-z.])[0-9]{4}(?:[._/]{1,2}[0-9]{3,6}){2,4}(?![0-9A-Za-z])")),
    ("ssn", re.compile(r"(?<![0-9A-Za-z-])[0-9]{3}[- ][0-9]{2}[- ][0-9]{4}(?![0-9A-Za-z-])")),
    ("iban", re.compile(r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[0-9A-Z]{4}){2,7}(?: ?[0-9A-Z]{1,3})?(?![0-9A-Za-z])")),
    # whole runs of any length: keys, base64, and the three parts of a signed token
    ("secret", re.compile(r"(?<![0-9A-Za-z+/_=-])(?=[A-Za-z_+/-]*+[0-9])[0-9A-Za-z_+/-]{16,}+={0,2}")),
    ("secret", re.compile(r"(?<![0-9A-Za-z_.-])[0-9A-Za-z_-]{8,}+\.[0-9A-Za-z_-]{8,}+\.[0-9A-Za-z_-]{8,}+(?![0-9A-Za-z.])")),
]
# Words that speak for a kind when they stand shortly before.
CUES = {
    "email": ["mail", "contact", "write", "correo"],
    "phone": ["phone", "call", "tel", "mobile", "fax", "telefon"],
    "card": ["card", "visa", "mastercard", "credit", "karte"],
    "ssn": ["ssn", "social security"],
    "iban": ["iban", "account", "konto", "compte"],
    "secret": ["token", "secret", "password", "passwd", "api_key", "apikey", "key ="],
}
_BEFORE = 32
FEATURES = [
    *[f"is_{k}" for k in ("email", "phone", "card", "ssn", "iban", "secret")],
    *["length", "digits", "upper", "lower", "separators", "entropy", "luhn", "mod97", "ssn_range", "groups", "longest_group"],
    *["hex", "own_cue", "other_cue", "quoted", "assigned", "letter_near", "digit_near"],
]
MONOTONE = {"own_cue": 1, "luhn": 1, "mod97": 1, "assigned": 1}


def proposals(text: str) -> list[Span]:
    """Overlapping spans of the generators."""
    if not _DIGIT.search(text) and not ("at]" in text or "at)" in text or "at}" in text):
        return []
    return [(kind, *m.span()) for kind, pattern in _GENERATORS for m in pattern.finditer(text)]


def _mod97(part: str) -> bool:
    part = part.replace(" ", "")
    turned = part[4:] + part[:4]
    return turned.isascii() and turned.isalnum() and int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def _ssn(digits: str) -> bool:
    return len(digits) == 9 and digits[:3] not in ("000", "666") and digits[0] != "9" and digits[3:5] != "00" and digits[5:] != "0000"


def describe(text: str, span: Span) -> list[float]:
    """Features of a proposal: its format, and what stands around it."""
    kind, a, b = span
    part, before = text[a:b], text[max(0, a - _BEFORE) : a].lower()
    digits = _digits(part)
    n = len(part)
    _, counts = np.unique(list(part), return_counts=True)
    p = counts / n
    runs = re.findall(r"[0-9]+", part)
    near = text[max(0, a - 2) : a] + text[b : b + 2]
    return [
        *[float(kind == k) for k in ("email", "phone", "card", "ssn", "iban", "secret")],
        float(n),
        float(len(digits)),
        sum(c.isupper() for c in part) / n,
        sum(c.islower() for c in part) / n,
        float(sum(not c.isalnum() for c in part)),
        float(-(p * np.log2(p)).sum()),
        float(13 <= len(digits) <= 19 and luhn(digits)),
        float(kind == "iban" and _mod97(part)),
        float(kind == "ssn" and _ssn(digits)),
        float(len(runs)),
        float(max(map(len, runs), default=0)),
        float(re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", part) is not None),
        float(any(c in before for c in CUES[kind])),
        float(any(c in before for k, cs in CUES.items() if k != kind for c in cs)),
        float(before[-1:] in ("'", '"')),
        float(re.search(r"[=:]\s*['\"]?$", before) is not None),
        float(any(c.isalpha() for c in near)),
        float(any(c.isdigit() for c in near)),
    ]


def examples(seed: int = 6, n: int = 250) -> list[tuple[str, Span, int]]:
    """Labelled proposals written from the formats: kinds that a sample of a corpus may lack, and look-alikes of each."""
    rng = np.random.default_rng(seed)
    num = lambda k: "".join(map(str, rng.integers(0, 10, k)))
    word = lambda: "".join(rng.choice(list("abcdefghilmnoprstu"), rng.integers(3, 9)))
    out = []

    def add(kind: str, value: str, label: int, cue: str = "", close: str = "") -> None:
        lead = f"{word()} {word()} {cue}"
        text = f"{lead}{value}{close} {word()} {word()}"
        out.append((text, (kind, len(lead), len(lead) + len(value)), label))

    def cue(kind: str) -> str:
        return CUES[kind][rng.integers(len(CUES[kind]))] + str(rng.choice([": ", " "]))

    def iban() -> str:
        body = num(18)
        return f"DE{98 - int(body + '131400') % 97:02d}{body}"

    def card(ok: bool) -> str:
        body = num(15)
        last = next(d for d in "0123456789" if luhn(body + d))
        d = body + (last if ok else str((int(last) + int(rng.integers(1, 10))) % 10))
        return "{}.{}.{}.{}".format(d[:4], d[4:8], d[8:12], d[12:])

    def ssn(ok: bool) -> str:
        return f"{rng.integers(100, 600) if ok else rng.integers(900, 999)}-{rng.integers(10, 99)}-{rng.integers(1000, 9999)}"

    for _ in range(n):
        add("email", f"{word()} [at] {word()} [dot] com", 1, cue("email") if rng.random() < 0.5 else "")
        add("email", f"{word()} (at) {word()} (dot) {word()[:3]}", 1)
        add("phone", f"({num(3)}) {num(3)}-{num(4)}", 1, cue("phone"))
        add("phone", f"{num(3)}-{num(3)}-{num(4)}", 1, cue("phone"))
        add("phone", f"0{num(10)}", 1, cue("phone"))
        add("phone", f"{num(4)}-{num(2)}-{num(2)}", 0)
        add("phone", f"{num(3)} {num(3)} {num(4)}", 0)
        add("phone", f"0{num(10)}", 0)
        add("phone", f"{num(2)}.{num(2)}.{num(4)}", 0, cue("phone") if rng.random() < 0.1 else "")
        add("card", card(True), 1, cue("card"))
        add("card", card(False), 0, cue("card") if rng.random() < 0.3 else "")
        add("ssn", ssn(True), 1, cue("ssn"))
        add("ssn", ssn(False), 0, cue("ssn") if rng.random() < 0.3 else "")
        add("ssn", ssn(True), 0)
        good = iban()
        add("iban", good, 1, cue("iban") if rng.random() < 0.5 else "")
        add("iban", good[:-1] + str((int(good[-1]) + 1) % 10), 0, cue("iban") if rng.random() < 0.3 else "")
        key = "".join(rng.choice(list("0123456789abcdef"), int(rng.choice([32, 40, 64]))))
        add("secret", key, 1, str(rng.choice(["token", "secret", "password", "api_key"])) + ' = "', '"')
        add("secret", key, 0)
        long = "".join(rng.choice(list("0123456789abcdefABCDEFGHIJKLMNOPQRSTUVWXYZ+/"), int(rng.choice([24, 88, 400]))))
        lead = str(rng.choice(["token", "secret", "password", "api_key"])) + str(rng.choice([' = "', ": ", "="]))
        add("secret", long + str(rng.choice(["", "=", "=="])), 1, lead, '"' if lead.endswith('"') else "")
        part = lambda: "".join(rng.choice(list("0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ_-"), int(rng.integers(20, 90))))
        add("secret", f"eyJ{part()}.eyJ{part()}.{part()}", 1, lead, '"' if lead.endswith('"') else "")
        add("secret", f"{word()}/{word()}/{num(4)}/{word()}-{word()}", 0)
        add("secret", f"{word()}{word()}.{word()}{word()}{num(2)}.{word()}{word()}", 0)
        add("secret", f"{word()}-{word()}-{num(2)}-{word()}", 0)
        add("secret", num(16 + int(rng.integers(0, 8))), 0, cue("card") if rng.random() < 0.5 else "")
    return out


def teacher(text: str, span: Span) -> int | None:
    """Label of a corpus proposal where a strict rule is sure, else None."""
    kind, a, b = span
    before = text[max(0, a - _BEFORE) : a].lower()
    cued = any(c in before for c in CUES[kind])
    digits = _digits(text[a:b])
    if kind == "secret":
        return int(cued and bool(re.search(r"[=:]\s*['\"]?$", before))) if cued or not re.search(r"[=:]\s*['\"]?$", before) else None
    if kind == "iban":
        return int(_mod97(text[a:b]))
    if kind == "card":
        return int(cued and luhn(digits)) if cued or not luhn(digits) else None
    if kind == "ssn":
        return int(cued and _ssn(digits)) if cued or not _ssn(digits) else None
    return int(cued and 9 <= len(digits) <= 15) if kind == "phone" else 1


@dataclass
class Finder:
    """Trees, the curve that calibrates their margin, and the least probability by kind."""

    forest: Forest
    slope: float
    offset: float
    least: dict[str, float]

    def extra(self, text: str, base: list[Span]) -> list[Span]:
        """Added spans: above their kind's threshold, the most probable of those that overlap, none on a base span."""
        taken = Taken(base)
        found = [s for s in proposals(text) if not taken.hits(s)]
        if not found:
            return []
        p = sigmoid(self.slope * self.forest.margin(np.array([describe(text, s) for s in found])) + self.offset)
        out: list[Span] = []
        for k in np.lexsort(([s[1] for s in found], -p)):
            if p[k] >= self.least[found[k][0]] and not taken.hits(found[k]):
                out.append(found[k])
                taken.add(found[k])
        return out


class Taken:
    """Ranges of a text that are taken, as disjoint ones in order."""

    def __init__(self, spans: list[Span]):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for _, a, b in sorted(spans, key=lambda s: s[1]):
            if self.ends and a < self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], b)
            else:
                self.starts.append(a)
                self.ends.append(b)

    def hits(self, span: Span) -> bool:
        k = bisect_left(self.starts, span[2])
        return k > 0 and self.ends[k - 1] > span[1]

    def add(self, span: Span) -> None:
        """Take a span that hits none."""
        k = bisect_left(self.starts, span[1])
        self.starts.insert(k, span[1])
        self.ends.insert(k, span[2])


def listed(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2])))


def learn(rows: np.ndarray, label: np.ndarray, kind: list[str]) -> Finder:
    """Trees on three quarters of the rows; calibration and thresholds on the rest."""
    rest = np.arange(len(label)) % 4 == 3
    forest = train(rows[~rest], label[~rest], {FEATURES.index(k): v for k, v in MONOTONE.items()}, trees=60, depth=4)
    margin = forest.margin(rows[rest])
    slope, offset = platt(margin, label[rest])
    p, kinds, least = sigmoid(slope * margin + offset), np.array(kind)[rest], {}
    for k in KINDS:
        mine = kinds == k
        cuts = np.unique(p[mine & (p >= LEAST)])
        right = [c for c in cuts if label[rest][mine & (p >= c)].mean() >= PRECISION]
        least[k] = float(right[0]) if right else 1.1
    return Finder(forest, slope, offset, least)


def fit(df: DataFrame, sample: int = SAMPLE) -> Finder:
    """Learn from written examples and from the proposals of a bounded sample of ``df`` that strict rules are sure of."""
    docs = narrowed(df, text="string").filter("text is not null")
    picked = docs.filter(F.col("text").rlike("[0-9]|at[\\])}]")).withColumn("_h", F.xxhash64("text")).select("_h").distinct()
    hashes = picked.orderBy("_h").limit(sample)

    def weak(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for text in batch.column("text").to_pylist():
                for span in proposals(text):
                    label = teacher(text, span)
                    if label is not None:
                        out.append((span[0], label, np.array(describe(text, span)).tobytes()))
            names = ["kind", "label", "x"]
            yield pa.RecordBatch.from_pydict({n: pa.array([r[i] for r in out], t) for i, (n, t) in enumerate(zip(names, (pa.string(), pa.int32(), pa.binary()), strict=True))})

    texts = docs.withColumn("_h", F.xxhash64("text")).join(F.broadcast(hashes), "_h", "left_semi").dropDuplicates(["_h"]).select("text")
    found = texts.mapInArrow(weak, "kind string, label int, x binary").orderBy(F.xxhash64("x"), "x", "kind", "label").limit(PROPOSALS).collect()
    made = examples()
    made = [made[i] for i in np.random.default_rng(7).permutation(len(made))]
    rows = np.array([describe(t, s) for t, s, _ in made] + [np.frombuffer(r["x"]) for r in found])
    label = np.array([y for _, _, y in made] + [r["label"] for r in found], float)
    return learn(rows, label, [s[0] for _, s, _ in made] + [r["kind"] for r in found])


def find(df: DataFrame, finder: Finder) -> DataFrame:
    """Counts and spans of each (doc_id, text): ``base_sha256`` of the fixed rules' list, ``spans`` with what is added.

    Offsets are code points of the whole text. Null counts as empty and has no spans; every row gets a row; equal
    texts get equal results; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[str, list[int]] = {k: [] for k in BASE}
            shas, spans = [], []
            for text in batch.column("text").to_pylist():
                base = base_spans(text or "")
                for k in BASE:
                    counts[k].append(sum(s[0] == k for s in base))
                shas.append(hashlib.sha256(listed(base).encode()).hexdigest())
                spans.append(listed(base + finder.extra(text or "", base)))
            cols = {f"n_{k}": pa.array(v, pa.int64()) for k, v in counts.items()}
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), **cols, "base_sha256": pa.array(shas, pa.string()), "spans": pa.array(spans, pa.string())})

    kinds = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
    return narrowed(df, doc_id="bigint", text="string").mapInArrow(run, kinds)


def redacted(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind; spans that overlap are replaced as one, under the first's kind."""
    out, last = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], s[2])):
        if a >= last:
            out += [text[last:a], f"[{kind.upper()}]"]
        last = max(last, b)
    return "".join([*out, text[last:]])


def redact(df: DataFrame) -> DataFrame:
    """``df`` with personal data in ``text`` replaced; ``n_chars``, where there is one, follows.

    Null stays null; rows that repeat stay; an empty table gives an empty one; other columns, of any name, stay as they are.
    """
    finder = fit(df)
    fields = df.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, ROWS):
                batch, out = whole.slice(lo, ROWS), []
                for text in batch.column("text").to_pylist():
                    base = base_spans(text or "")
                    out.append(text if text is None else redacted(text, base + finder.extra(text, base)))
                yield batch.set_column(batch.schema.get_field_index("text"), "text", pa.array(out, pa.string()))

    clean = df.mapInArrow(releasing(run), fields)
    if "n_chars" in df.columns:
        clean = clean.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.char_length("text").cast(fields["n_chars"].dataType)))
    return clean
