import hashlib
import random
import re
import time

from tallyforge.llm import pii
from tallyforge.llm.queries import QUERIES

from .conftest import rows_of_edge

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def brute(text):
    found = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if kind == "card" and not (13 <= len(digits) <= 19 and pii.luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            found.append(f"{kind}:{m.start()}:{m.end()}")
    return found


def test_base_spans_equal_the_plain_patterns():
    rng = random.Random(3)
    parts = ["a", "b.", "@", "@x.y", ".", "-", " ", "4111111111111111", "4111 1111 1111 1111", "1.2.3.4", "999.1.1.1", "+49 (0)30 123456", "+1",
             "5", "\n", "é", "a@b@c.de", "0", "00001.2.3.4"]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(12)))
        ours = [f"{k}:{s}:{e}" for k, s, e, _ in pii.find_spans(text) if k in pii.BASE_KINDS]
        assert ours == brute(text), text


def test_validators():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")
    assert pii.mod97("GB82 WEST 1234 5698 7654 32") and not pii.mod97("GB82 WEST 1234 5698 7654 33")


def test_context_decides_added_kinds():
    assert [s[0] for s in pii.find_spans("my ssn is 123-45-6789")] == ["ssn"]
    assert not pii.find_spans("part 123-45-6789 is here")
    assert [s[0] for s in pii.find_spans("transfer to GB82WEST12345698765432 now")] == ["iban"]
    near, far = pii.find_spans("call +4930123456789")[0], pii.find_spans("abc +4930123456789")[0]
    assert near[3] > far[3]


def test_ibans_end_at_the_token_that_fits():
    def ibans(text):
        return [text[s:e] for k, s, e, _ in pii.find_spans(text) if k == "iban"]

    gb, de = "GB82 WEST 1234 5698 7654 32", "DE89 3704 0044 0532 0130 00"
    assert ibans(f"{gb} BIC DEUTDEFF") == [gb] and ibans("DE89370400440532013000 USD 500") == ["DE89370400440532013000"]
    assert ibans(f"{de} 2024-01-01") == [de] and ibans(f"{gb} {de} NO93 8601 1117 947 A") == [gb, de, "NO93 8601 1117 947"]
    assert ibans(f"AB12 {gb} X") == [gb] and ibans(f"{gb}, {de}.") == [gb, de]  # a failed start hides no other
    assert ibans("GB82 WEST 1234 5698 7654 33 BIC") == [] and ibans("GB82 WEST 1234 5698 7654 32x") == []
    start = time.time()
    for text in ("AB12 " * 80_000, "A" * 400_000, "GB82" * 100_000):
        ibans(text)
    assert time.time() - start < 20


def test_very_long_texts_take_linear_time():
    start = time.time()
    for text in ("a" * 400_000 + " x@", "1" * 400_000, "1." * 200_000, "+1" + " " * 400_000, "a@" * 200_000):
        pii.find_spans(text)
    assert time.time() - start < 20


def test_edges_and_empty(edge, none):
    got = {}
    for r in pii.pii_spans(edge).collect():
        got.setdefault(r.doc_id, []).append(len(r.spans))
    assert sum(map(len, got.values())) == len(rows_of_edge()) and got[2] == [0] and len(got[None]) == 2
    assert pii.pii_spans(none).count() == 0


def test_query_digest(spark, folder, documents):
    texts = {r.doc_id: r.text for r in documents.collect()}
    for r in QUERIES["op1_pii"](spark, folder).collect():
        spans = brute(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest()
        assert r.n_email == sum(s.startswith("email") for s in spans)


def test_redaction(frame):
    out = pii.redact(frame(["write to me@x.org or +4930123456789!", None])).collect()
    assert sorted(r.text for r in out) == ["", "write to [email] or [phone]!"]


def test_overlaps_with_base_spans_are_left_out_wherever_they_stand():
    text = "a@b.co ssn 123-45-6789 1.2.3.4 " * 3000 + "card 4111 1111 1111 1111 ssn 123-45-6789"
    spans = pii.find_spans(text)
    base = sorted((s, e) for k, s, e, _ in spans if k in pii.BASE_KINDS)
    others = [(s, e) for k, s, e, _ in spans if k not in pii.BASE_KINDS]
    assert len(others) == 3001 and all(a[1] <= b[0] for a, b in zip(sorted(base + others), sorted(base + others)[1:]))
