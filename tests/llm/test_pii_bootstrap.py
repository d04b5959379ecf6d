import hashlib
import re

from txrisk.llm import pii_bootstrap, queries

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def valid(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    if kind == "phone":
        return 9 <= len(digits) <= 15
    return True


def base_spans(text):
    found = [(m.start(), i, k, m.end()) for i, (k, r) in enumerate(BASE.items()) for m in re.finditer(r, text or "") if valid(k, m[0])]
    return [(k, a, b) for a, _, k, b in sorted(found)]


def parsed(spans):
    return [(k, int(a), int(b)) for k, a, b in (s.split(":") for s in spans.split(",") if s)]


def check(rows, got):
    want = sorted(
        (str(i), *(sum(k == kind for k, *_ in base_spans(t)) for kind in BASE), hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in base_spans(t)).encode()).hexdigest())
        for i, t in rows
    )
    assert sorted((str(r.doc_id), r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in got) == want
    texts = {}
    for i, t in rows:
        texts.setdefault(i, set()).add(t or "")
    for r in got:
        every = parsed(r.spans)
        assert any([s for s in every if s[0] != "id"] == base_spans(t) for t in texts[r.doc_id])
        assert every == sorted(every, key=lambda s: (s[1], [*BASE, "id"].index(s[0])))


HARD = [
    "a@b.c_d@e.f,x@y.zz..q@r.st. @a.b a@.b a@b a.b@c-d.e--f.g",
    "1.2.3.4.5.6.7.8 256.1.1.1 1.1.1.256 0001.002.3.0255 1.2.3 é1.2.3.4",
    "4111 1111 1111 1111 4111-1111-1111-1111 4111  1111 1111 1111 4111 1111 1111 1111 5 4111 - 1111",
    "x4111111111111111y 1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 -4111111111111111- 79927398713 0000000000000",
    "+1 (974) 555-3436, +12 34 +1(2)3.4-5 6 7 8 9 0. +++49 30 123456 7 é +123456789012345678",
    "é€😀 a@b.c 😀 +1 (487) 555-7209 😀1.2.3.4",
    "9" * 5000, "1 " * 3000, "a." * 3000 + "@", "@" * 50, "x" * 20000 + "5", "a@" + "b." * 400 + "c", "+1" + "(" * 5000,
    None, "", " \n", "no digits here", "1.2.3.4", "1.2.3.4",
]


def test_fixed_patterns(spark):
    rows = [(i, t) for i, t in enumerate(HARD)] + [(3, HARD[3]), (None, "a@b.c")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    check(rows, pii_bootstrap.pii_report(df).collect())


def test_whole_table(spark, small):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    check(rows, queries.QUERIES["op7_pii_bootstrap"](spark, small).collect())


def test_contexts_bring_up_unseen_identifiers(spark):
    rows = [(i, f"Words. Please ring me on +1 (974) 555-34{i:02} before noon.") for i in range(40)]
    rows += [(100, "so ring me on 0555-019922, or not"), (101, "the year 1999-2000 was fine"), (102, "call 0555-019922 now"), (103, "see chapter 12345")]
    # A second round: what the first one finds makes another context known.
    rows += [(200 + i, f"you ring me on k{i}k{i}k9x ok") for i in range(4)] + [(300 + i, f"my handle is k{i}k{i}k9x ok") for i in range(4)]
    rows += [(400, "my handle is zz77zz ok")]
    got = {r.doc_id: r for r in pii_bootstrap.pii_report(spark.createDataFrame(rows, "doc_id long, text string"), min_score=0.7).collect()}
    texts = dict(rows)
    found = {i: [texts[i][a:b] for k, a, b in parsed(r.spans) if k == "id"] for i, r in got.items()}
    assert found[100] == found[102] == ["0555-019922"] and found[101] == found[103] == []
    assert found[201] == found[301] == ["k1k1k9x"] and found[400] == ["zz77zz"]
    assert all(not found[i] and got[i].n_phone == 1 for i in range(40))


def card(i):
    digits = f"4111{i:011}"
    return next(digits + d for d in "0123456789" if luhn(digits + d))


def brought_up(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.doc_id: [texts[r.doc_id][a:b] for k, a, b in parsed(r.spans) if k == "id"] for r in pii_bootstrap.pii_report(df).collect()}


SEEDS = [card, lambda i: f"10.0.{i}.7", lambda i: f"u{i}@x.org", lambda i: f"+1 (974) 555-34{i:02}"]


def test_seeds_of_every_kind_bring_up_identifiers(spark):
    texts, want = [], {}
    for k, seed in enumerate(SEEDS):
        kind = "abcd"[k]
        # Only the two words before are the same, or only the word before and the one after.
        for form in (f"we {kind}one {kind}two {{}}, w{{}}", f"w{{1}} {kind}three ({{0}}) {kind}four"):
            texts += [form.format(seed(i), "efghijklm"[i]) for i in range(9)]
            want[len(texts)] = [f"new{len(texts)}id"]
            texts.append(form.format(f"new{len(texts)}id", "z"))
    found = brought_up(spark, texts)
    assert {i: found[i] for i in want} == want


def test_identifiers_beside_other_matches(spark):
    """Dates, numbers and other identifiers around a match are words of its context."""
    forms = ["see 17 {} 2020 ok", "see at@ 2021 {} and", "key 11 x5x5x5 {}"]
    texts, want = [], {}
    for k, form in enumerate(forms):
        texts += [form.format(f"u{i}k{k}@x.org") for i in range(9)]
        want[len(texts)] = f"new{k}id"
        texts.append(form.format(f"new{k}id"))
    found = brought_up(spark, texts)
    assert all(name in found[i] for i, name in want.items())


def test_redaction(spark):
    schema = "doc_id long, text string, rid long, kind string, n_chars long"
    rows = [(1, "é a@b.cc and 1.2.3.4!", 7, "k", 21), (2, None, 7, "k", 0), (3, "plain", 7, "k", 5), (4, "+1 (974) 555-3436", 1, "k", 17), (4, "x", 1, "k", 1)]
    df = pii_bootstrap.redact(spark.createDataFrame(rows, schema))
    assert df.columns == ["doc_id", "text", "rid", "kind", "n_chars"]
    assert sorted(((r.doc_id, r.text, r.n_chars) for r in df.collect()), key=str) == [
        (1, "é [EMAIL] and [IP]!", 19), (2, None, 0), (3, "plain", 5), (4, "[PHONE]", 7), (4, "x", 1),
    ]
    empty = spark.createDataFrame([], schema)
    assert pii_bootstrap.redact(empty).collect() == pii_bootstrap.pii_report(empty).collect() == []
