"""Personal data against plain patterns in Python."""

import hashlib
import re

from conftest import SF

from lexweave.llm import pii
from lexweave.llm.catalogue import QUERIES

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
HARD = [
    None,
    "",
    "a@b.c_x@d.e f@g.h.i, @j.k l@m .n@o.p q@r..s",
    "1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.0004 1.2.3 .9.9.9.9. 99999999999.1.1.1",
    "4111 1111 1111 1111 4111-1111-1111-1112 41111111111111111111 4-1-1-1 4111  1111",
    "+1 (702) 555-0742 ++44 20 7946 0958 +1((( +12 +123456789012345678 +1.2.3.4.5.6.7.8",
    "mail é🙂 x@y.zz 4111111111111111 🙂 +49 30 123456",
    "x@" + "a." * 300 + "b " + "7" * 3000 + " " + "y" * 5000,
    " ".join(f"u{i}@h{i}.org" for i in range(700)),
]


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text):
    found = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 16 <= len(digits) <= 19 and luhn(digits),
                "phone": 8 <= len(digits) <= 15,
            }[kind]
            if good:
                found.append(f"{kind}:{m.start()}:{m.end()}")
    return found


def expected(text):
    spans = base_spans(text)
    counts = [sum(s.startswith(k + ":") for s in spans) for k in PLAIN]
    return (*counts, hashlib.sha256(",".join(spans).encode()).hexdigest())


def test_query_against_plain_patterns(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op8_pii"](spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        found = (r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["base_sha256"])
        assert found == expected(texts[r["doc_id"]]), r["doc_id"]
        base = base_spans(texts[r["doc_id"]])
        assert r["spans"].split(",")[: len(base)] == (base or [""])[: len(base)]


def test_hard_texts(spark):
    docs = spark.createDataFrame(
        [(i, t, "x") for i, t in enumerate(HARD)] + [(None, HARD[2], "y"), (2, HARD[2], None)],
        "doc_id long, text string, base string",
    )
    rows = pii.with_spans(docs).select("doc_id", pii.listed("base").alias("s")).collect()
    assert len(rows) == len(HARD) + 2
    for r in rows:
        text = HARD[2] if r["doc_id"] is None else HARD[r["doc_id"]]
        assert r["s"] == ",".join(base_spans(text))


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert pii.with_spans(docs).collect() == []


def test_redaction(spark):
    docs = spark.createDataFrame(
        [(1, "write a.b@c.de or +49 30 1234567."), (2, None), (3, "none here")], "doc_id long, text string"
    )
    found = {r["doc_id"]: r["text"] for r in pii.redact(docs).collect()}
    assert found == {1: "write <email> or <phone>.", 2: "", 3: "none here"}


def test_boosting_finds_the_telling_feature():
    blank = dict.fromkeys(pii.FEATURES, 0) | {"kind": 4}
    rows = [blank | {"case": 2, "label": 1, "n": 50}, blank | {"case": 1, "label": 0, "n": 500}]
    model = pii.PiiModel(*pii.boost(rows), {})
    assert model.odds(rows[0]) > 1 > -1 > model.odds(rows[1])


def test_thresholds_count_only_what_can_be_added(spark):
    """Emails confirm no handle that is none: those are covered and never added."""
    data = [(i, " ".join(f"bob{k}@site{i}.com" for k in range(60)) + f" and x{i}@y there") for i in range(200)]
    found = pii.with_spans(spark.createDataFrame(data, "doc_id long, text string")).collect()
    assert all(len(r["base"]) == 60 and r["added"] == [] for r in found)


def test_telling_words_are_no_feature():
    assert "telling" not in pii.FEATURES
