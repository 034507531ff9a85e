import hashlib
import random
import re


from clearbook.llm import pii, queries


def luhn(digits):
    total = 0
    for i, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + i % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def strict(text):
    text = text or ""
    found = [("email", m) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(part) <= 255 for part in m.group().split(".")):
            found.append(("ip", m))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m.group())
        if 13 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", m))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            found.append(("phone", m))
    return [(kind, m.start(), m.end()) for kind, m in found]


def test_strict_spans_of_random_texts():
    rng = random.Random(3)
    pieces = ["a", "b.c", "@", "x.y", "%", "_", ".", "-", "1", "22", "333", "+", "(", ")", " ", "4111111111111111", "10.0.0.1", "+1 555", "\n", "é"]
    for _ in range(20_000):
        text = "".join(rng.choices(pieces, k=12))
        assert pii.base_spans(text) == strict(text)


def test_long_runs_take_linear_time():
    for text in ("a" * 200_000, "a" * 200_000 + "@", "1" * 200_000, "1." * 100_000, "+1" + " " * 200_000):
        assert pii.spans_of(text, None) == [(*s, True, 1.0) for s in pii.base_spans(text)]


def test_query_finds_the_strict_spans_and_adds_to_them(spark):
    rows = {r.doc_id: r for r in queries.op8_pii(spark, "/root/testdata/sf0.01").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()
    assert len(rows) == len(docs)
    for doc in docs:
        spans, row = strict(doc.text), rows[doc.doc_id]
        listed = [f"{k}:{a}:{b}" for k, a, b in spans]
        assert row.base_sha256 == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert (row.n_email, row.n_ip, row.n_card, row.n_phone) == tuple(sum(s[0] == k for s in spans) for k in pii.KINDS)
        assert set(listed) <= set(row.spans.split(","))


def test_the_trees_add_looser_spans_and_spare_other_numbers(spark):
    trees = pii.train(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"))
    context = "Onesthre orshin the edhawh {} anth erthing anre ouinsh ed."
    for kind, loose in [
        ("email", "jane.doe(at)mail7.example.com"), ("email", "jane.doe @ mail7.example.com"),
        ("card", "4539.1488.0343.6467"), ("phone", "(555) 234-5678"),
    ]:
        text = context.format(loose)
        found = pii.spans_of(text, trees)
        assert [(k, text[a:b]) for k, a, b, base, _ in found if not base] == [(kind, loose)]
    for harmless in ["2024-03-15 10:30", "1,234,567.89", "3.14159", "1990-1995", "no. 12345678", "at the dot"]:
        assert pii.spans_of(context.format(harmless), trees) == []


def test_messy_rows(messy, empty):
    trees = pii.train(messy)
    found = pii.find(messy, trees)
    for row in found.collect():
        assert [(s.kind, s.start, s.end) for s in row.spans if s.base] == strict(row.text)
    redacted = pii.redacted(messy)
    assert redacted.columns == messy.columns and redacted.count() == messy.count()
    assert not [r for r in redacted.collect() if strict(r.text)]
    assert [r.text for r in redacted.where("doc_id = 300").collect()] == [None]
    assert pii.train(empty) is None and pii.redacted(empty).count() == 0


def test_redaction_leaves_the_rest(spark):
    text = "é mail a@b.co, ip 10.0.0.1 and again a@b.co."
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert pii.redact(pii.find(docs, None)).first().text == "é mail [EMAIL], ip [IP] and again [EMAIL]."
    assert pii.digests(pii.find(docs, None)).first().n_email == 2


def test_the_prefilter_passes_every_text_with_a_candidate(spark):
    rng = random.Random(5)
    pieces = ["jane.doe", "mail", ".", " ", " at ", "(at)", "[ AT ]", "{at}", "@", " dot ", "[dot]", "com", "\u00a0at\u2003", "7", "+", "\n"]
    texts = ["".join(rng.choices(pieces, k=8)) for _ in range(20_000)]
    proposed = [t for t in texts if pii.candidates(t)]
    assert len(proposed) > 1_000 and all(pii._MAY_HOLD.search(t) for t in proposed)
    # no digit, no @, no "dot"
    trees = pii.train(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"))
    text = "Onesthre orshin the edhawh write to jane.doe(at)mail.example.com anth erthing anre ouinsh ed."
    row = pii.find(spark.createDataFrame([(1, text)], "doc_id long, text string"), trees).first()
    assert [(x.kind, text[x.start : x.end]) for x in row.spans] == [("email", "jane.doe(at)mail.example.com")]


def test_rare_strict_spans_are_enough_and_rules_stand_in_for_the_rest(spark):
    plain = [(i, f"Onesthre orshin {i % 9} edhawh anre ouinsh, the {i % 7}.{i % 5} of 19{i % 90 + 10}-05-0{i % 9 + 1} anth.") for i in range(4000)]
    rare = [(10_000 + i, f"Onesthre write to user{i}.name@mail{i % 9}.example.com anre ouinsh ed {i % 8}.") for i in range(160)]
    docs = spark.createDataFrame(plain + rare, "doc_id long, text string")
    # a sample of 400 documents by chance alone would hold about 15 of these
    trees = pii.train(docs, sample_rows=400)
    assert trees is not None and "email" in trees.thresholds and "card" not in trees.thresholds
    text = "Onesthre write to some.body(at)mail7.example.com or 4539.1488.0343.6467, not 4539.1488.0343.6468, in 2024-03-15 10:30."
    wanted = [("email", "some.body(at)mail7.example.com"), ("card", "4539.1488.0343.6467")]
    assert [(k, text[a:b]) for k, a, b, _, _ in pii.spans_of(text, trees)] == wanted
    assert [(k, text[a:b]) for k, a, b, _, _ in pii.spans_of(text, None)] == wanted
    assert pii.spans_of("We met at the dot. Then 1,234,567.89 of 1990-1995, no. 12345678 at home. Then", None) == []
    text = "jane at mail dot example dot com. Then call 555 234 5678"
    wanted = ["jane at mail dot example dot com", "555 234 5678"]
    assert [text[a:b] for _, a, b, _, _ in pii.spans_of(text, None)] == wanted
