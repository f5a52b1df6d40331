import hashlib
import random
import re
from collections import Counter

import pytest

from tidemark.llm.pii import _expectation_maximisation, find_pii, pii_digests, redact_pii
from tidemark.llm.queries import queries


def luhn(digits):
    return sum(v // 10 + v % 10 for k, c in enumerate(reversed(digits)) for v in [int(c) * (1 + k % 2)]) % 10 == 0


def base(text):
    """The base spans as their definition has them."""
    out, text = [], text or ""
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, "email", m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, "ip", m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        if 14 <= len(digits(m)) <= 19 and luhn(digits(m)):
            out.append((m.start(), 2, "card", m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(digits(m)) <= 15:
            out.append((m.start(), 3, "phone", m.end()))
    return sorted(out)


def joined(spans):
    return ",".join(f"{k}:{a}:{b}" for a, _, k, b in spans)


def check(found, texts):
    wanted = Counter((i, hashlib.sha256(joined(base(t)).encode()).hexdigest(), *(sum(s[2] == k for s in base(t)) for k in ("email", "ip", "card", "phone"))) for i, t in texts)
    rows = pii_digests(found).collect()
    assert Counter((r.doc_id, r.base_sha256, r.n_email, r.n_ip, r.n_card, r.n_phone) for r in rows) == wanted
    return {r.doc_id: r.spans for r in rows}


def test_sample_equals_brute_force(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    spans = check(find_pii(docs), [(r.doc_id, r.text) for r in docs.collect()])
    for r in docs.collect():
        assert set(joined(base(r.text)).split(",")) <= set(spans[r.doc_id].split(","))


def test_random_texts_equal_brute_force(docs):
    r = random.Random(5)
    atoms = "1 2 0 4 255 . - + @ a b.c é 😀 ( ) 4111111111111111 a@b.c 1.2.3.4 300.1.1.1".split() + [" ", "4111 1111 1111 1111", "+1 (803) 555-5351", "803-555-5351", "joe [at] x [dot] com", "\n", "call me ", 'token = "']
    texts = ["".join(r.choice(atoms) for _ in range(r.randint(0, 30))) for _ in range(1500)]
    texts += [None, "", "a@b.c " * 1000, "9" * 30_000, "a" * 30_000 + "@", "x@" + "b." * 20_000, "1.1.1." * 3000, "+1" + "(" * 20_000]
    check(find_pii(docs(*texts)), list(enumerate(texts)))


def test_wider_forms_are_added_where_the_labelers_trust_them(docs):
    texts = [f"please call me: +1 (803) 555-53{k:02d} today" for k in range(40)] + [f"mail to someone{k}@mail.example.com now" for k in range(40)]
    texts += [f'key = "{k}{k}1234567890123456ab"' for k in range(10, 40)]
    texts += ["please call me: (803) 555-5351 today", "contact joe [at] mail [dot] com please", "no numbers 12-34 here"]
    spans = check(find_pii(docs(*texts)), list(enumerate(texts)))
    n = len(texts)
    assert spans[n - 3] == "phone:16:30" and spans[n - 2] == "email:8:31" and spans[n - 1] == ""
    assert all(not spans[k] for k in range(80, 110))


def test_edges_and_redaction(crowded, no_rows, docs):
    assert find_pii(crowded).count() == crowded.count() and find_pii(no_rows).count() == 0
    clean = redact_pii(crowded)
    assert clean.columns == crowded.columns and clean.count() == crowded.count()
    by = {r.doc_id: r.text for r in clean.collect()}
    assert by[3] is None and by[4] == "" and by[7] == "<EMAIL> and <CARD>"
    assert redact_pii(no_rows).count() == 0
    # an address in which a number is also an ip: overlapping spans are one
    row = redact_pii(docs("é a1.2.3.4@b.co, +1 (803) 555-5351!")).first()
    assert row.text == "é <EMAIL>, <PHONE>!"


def test_reliabilities_follow_the_votes():
    counts = {("email", 1, 1, 0, 1): 80, ("email", 1, -1, 0, 1): 5, ("email", -1, -1, -1, -1): 60, ("email", -1, 1, 0, -1): 5}
    chance, trust = _expectation_maximisation(counts)
    assert chance["email", 1, 1, 0, 1] > 0.95 and chance["email", -1, -1, -1, -1] < 0.05
    assert trust["email", "check"][0] > trust["email", "gazetteer"][0] and trust["email", "check"][1] < 0.1


@pytest.mark.parametrize("name", ["op1_pii"])
def test_no_python_on_the_executors(spark, small, name):
    plan = queries()[name](spark, small)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def redacted(text):
    """Base spans in angle brackets; overlapping ones go together."""
    cuts = []
    for a, _, kind, b in base(text):
        if cuts and a < cuts[-1][1]:
            cuts[-1][1] = max(cuts[-1][1], b)
        else:
            cuts.append([a, b, kind])
    parts, at = [], 0
    for a, b, kind in cuts:
        parts.append(text[at:a] + f"<{kind.upper()}>")
        at = b
    return "".join(parts) + text[at:]


def test_many_matches_in_one_text(docs):
    import time

    texts = [" ".join(f"é user{k}@mail{k % 7}.example.com and 10.0.{k % 300}.7 or +1 (803) 555-{k:04d}" for k in range(n)) for n in (1, 31, 7000)]
    check(find_pii(docs("warm")), [(0, "warm")])
    began = time.perf_counter()
    check(find_pii(docs(*texts)), list(enumerate(texts)))
    clean = {r.doc_id: r.text for r in redact_pii(docs(*texts)).collect()}
    assert clean == {k: redacted(t) for k, t in enumerate(texts)}
    assert sum(len(base(t)) for t in texts) > 19_000 and time.perf_counter() - began < 60


def test_redaction_cuts_at_any_place(docs):
    """Spans at the borders of the blocks in which a text is cut, and overlapping ones."""
    r = random.Random(8)
    texts = ["x" * n + " a@b.co " + "😀" * m + " 1.2.3.4@h.org 4111 1111 1111 1111" for n in (0, 1015, 1016, 1017, 1023, 1024, 1025, 2040) for m in (0, 1, 1000, 1024)]
    texts += ["".join(r.choice(["a@b.co", " ", "é", "1.2.3.4", "+1 (803) 555-5351", "x" * 500]) for _ in range(60)) for _ in range(60)]
    clean = {r.doc_id: r.text for r in redact_pii(docs(*texts)).collect()}
    assert clean == {k: redacted(t) for k, t in enumerate(texts)}


def test_search_runs_once_in_redaction(spark, docs):
    plan = redact_pii(docs("a@b.co"))._jdf.queryExecution().optimizedPlan().toString()
    assert "split(" not in plan


def test_guarded_ips_and_parted_cards(docs):
    texts = [f"please call me: +1 (803) 555-53{k:02d} today" for k in range(40)] + [f"the server 10.1.{k}.3 is up" for k in range(40)] + ["pay by card 4111 1111 1111 1111 now"] * 40
    texts += ["the server 10[.]1[.]2[.]3 is up"] * 20 + ["pay by card 4111.1111.1111.1111 now"] * 20 + ["pay by card 4111.1111.1111.1112 now"] * 20
    spans = check(find_pii(docs(*texts)), list(enumerate(texts)))
    assert spans[120] == "ip:11:25" and spans[140] == "card:12:31" and spans[160] == ""
