from __future__ import annotations

import hashlib
import re
from collections import Counter

import pytest
from odd import no_docs, odd_docs
from pyspark.sql import functions as F

from wagerlens.llm import pii
from wagerlens.llm.queries import QUERIES

DOCS = "doc_id long, text string, kind string, base string, spans string"
# The contract's patterns, as they stand there.
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base(text):
    found = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            good = {
                "email": lambda: True,
                "ip": lambda: all(int(p) <= 255 for p in m.group().split(".")),
                "card": lambda: 12 <= len(digits) <= 19 and luhn(digits),
                "phone": lambda: 9 <= len(digits) <= 15,
            }
            if good[kind]():
                found.append((m.start(), pii.KINDS.index(kind), m.end()))
    return sorted(found)


def listed(spans):
    return ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in spans)


def parsed(text):
    return [(int(a), pii.KINDS.index(k), int(b)) for k, a, b in (s.split(":") for s in text.split(",") if s)]


def check(given, found):
    """Base columns as brute force has them; further spans lie beside the base ones and in order."""
    right = []
    for doc, text in given:
        spans = base(text)
        n = Counter(pii.KINDS[k] for _, k, _ in spans)
        digest = hashlib.sha256(listed(spans).encode()).hexdigest()
        right.append((doc, *(n[k] for k in pii.KINDS), digest))
    columns = ["doc_id", *(f"n_{k}" for k in pii.KINDS), "base_sha256"]
    assert Counter(tuple(r[c] for c in columns) for r in found) == Counter(right)
    texts = {}
    for doc, text in given:
        texts.setdefault(doc, []).append(text or "")
    added = 0
    for r in found:
        spans = parsed(r["spans"])
        assert spans == sorted(spans)
        fits = [t for t in texts[r["doc_id"]] if set(base(t)) <= set(spans)]
        assert fits
        own = set(base(fits[0]))
        extra = [s for s in spans if s not in own]
        added += len(extra)
        for a, _, b in extra:
            assert 0 <= a < b <= len(fits[0])
            assert not any(a < y and x < b for x, _, y in spans if (x, _, y) != (a, _, b) and (x, y) != (a, b))
    return added


def frame(spark, texts):
    rows = [(i, t, "x", "y", "z") for i, t in texts]
    return spark.createDataFrame(rows, DOCS).repartition(3)


def test_given_documents_equal_brute_force(spark, sf_dir):
    found = QUERIES["op11_candidate_boosting"](spark, sf_dir)
    assert found.columns == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
    given = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    check([tuple(r) for r in given], found.collect())


ODD = [
    "a@b.c_d@e.f and x@y, z@w.q; @@ a@@b.c a@b@c.d é@ab.cd tail@dom.", "..%+@-.- a.b-@c-.d..e@f.g",
    "1.2.3.4.5.6.7.8 256.1.1.1 0255.000.1.01 1.2.3 1..2.3.4 999999.1.2.3 1.2.3.4",
    "4111 1111 1111 1111, 4111-1111-1111-1112 4111111111111111 378282246310005 4 1 1 1",
    "4111111111111111 4012888888881881", "+1 (017) 555-7713 4952935900253052 +12 ++1234567890 +1234567 8",
    "🙂 mail me@mail.example.com 🙂🙂 10.0.0.1 漢字 +44 20 7946 0958", "1" * 25, "1-2-3-4-5-6-7-8-9-0-1-2-3",
    "0000000000000000", "٤١١١١١١١١١١١١١١١ ０１２", "a" * 3000, None, "", " ",
]


def test_odd_texts(spark):
    texts = [*enumerate(ODD), (3, ODD[3]), (None, ODD[2]), (None, ODD[2])]
    found = pii.private_digests(frame(spark, texts)).collect()
    check(texts, found)
    docs = odd_docs(spark)
    check([tuple(r) for r in docs.select("doc_id", "text").collect()], pii.private_digests(docs).collect())
    assert pii.private_digests(no_docs(spark)).count() == 0
    assert pii.find_private(no_docs(spark)).count() == 0


@pytest.mark.parametrize("text", [
    "a" * 1_000_000 + " me@mail.com", "a.b-" * 250_000 + "@x.y", "x@" + "a." * 500_000, "7" * 1_000_000,
    "1.2." * 250_000, "+1" * 500_000, "+1" + " 2" * 500_000, "1 1-" * 250_000, "a@b.co " * 100_000,
])
def test_very_long_texts(spark, text):
    (r,) = pii.private_digests(frame(spark, [(1, text)])).collect()
    spans = base_fast(text)
    assert r["base_sha256"] == hashlib.sha256(listed(spans).encode()).hexdigest()


def base_fast(text):
    """base(), which is quadratic in runs, by hand for the texts above."""
    if text.endswith("me@mail.com"):
        return [(len(text) - 11, 0, len(text))]
    if text.startswith("a.b-"):
        return [(0, 0, len(text))]
    if text.startswith("x@"):
        return [(0, 0, len(text) - 1)]
    if text.startswith("1.2."):
        return [(i, 1, i + 7) for i in range(0, len(text) - 7, 8)]
    if text.startswith("a@b"):
        return [(i, 0, i + 6) for i in range(0, len(text), 7)]
    return []


def card(number):
    digits = f"{4_000_000_000_000_00 + number * 7919:015d}"
    return next(digits + c for c in "0123456789" if luhn(digits + c))


def test_trees_add_what_base_patterns_miss(spark):
    rows = []
    for i in range(400):
        good, other = card(i), card(i + 1000)
        bad = f"{(7_777_000_000_000_000 + i * 104729) % 10**16:016d}"
        rows += [(4 * i, f"my card {good} is new"), (4 * i + 1, f"order {bad} came today")]
        if i % 10 == 0:
            # Two numbers in a row: 32 digits, which no base pattern takes.
            rows.append((4 * i + 2, f"my card {good} {other} here"))
    rows.append((10_003, "nothing here but 12 words and 7 numbers"))
    found = {r["doc_id"]: r["spans"] for r in pii.private_digests(frame(spark, rows)).collect()}
    texts = dict(rows)
    for i in range(0, 400, 10):
        t = texts[4 * i + 2]
        assert parsed(found[4 * i + 2]) == [(8, 2, 24), (25, 2, 41)], t
    assert found[10_003] == ""
    # Chance hits of the check among the orders are base spans; nothing else is added there.
    for i in range(400):
        assert parsed(found[4 * i + 1]) == base(texts[4 * i + 1])


def test_redacted_texts(spark, sf_dir):
    texts = [*enumerate(ODD), (77, ("x" * 4090 + " me@mail.example.com 10.0.0.1 ") * 3), (78, "1.2.3.4," * 5000)]
    df = frame(spark, texts).withColumn("row", F.lit("mine"))
    out = pii.redact(df)
    assert out.columns == df.columns
    got = {r["doc_id"]: r for r in out.collect()}
    spans = {r["doc_id"]: parsed(r["spans"]) for r in pii.private_digests(df).collect()}
    for doc, text in texts:
        want, at = "", 0
        merged = []
        for a, k, b in spans[doc]:
            if merged and a < merged[-1][2]:
                merged[-1][2] = max(merged[-1][2], b)
            else:
                merged.append([a, k, b])
        for a, k, b in merged:
            want += text[at:a] + f"[{pii.KINDS[k].upper()}]"
            at = b
        assert got[doc]["text"] == (None if text is None else want + text[at:])
        assert got[doc]["row"] == "mine" and got[doc]["spans"] == "z"


def test_native_plan(spark, sf_dir):
    plan = QUERIES["op11_candidate_boosting"](spark, sf_dir)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
