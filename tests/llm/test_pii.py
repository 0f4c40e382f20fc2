import hashlib
import re

from citylake.llm import pii
from tests.llm.fixtures import clashing, docs_of, documents, empty_documents, odd_documents

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def valid(kind, text):
    digits = [int(d) for d in re.findall("[0-9]", text)]
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in text.split("."))
    if kind == "card":
        doubled = [sum(divmod(2 * d, 10)) if k % 2 else d for k, d in enumerate(reversed(digits))]
        return 13 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind != "phone" or 9 <= len(digits) <= 15


def brute(doc_id, text):
    found = [[m.span() for m in re.finditer(p, text or "") if valid(k, m[0])] for k, p in PATTERNS.items()]
    joined = ",".join(f"{k}:{s}:{e}" for k, spans in zip(PATTERNS, found) for s, e in spans)
    return doc_id, *map(len, found), hashlib.sha256(joined.encode()).hexdigest()


TRICKY = [
    (1, "a@b.c@d.ef x@y @z.q a.b+c%d-e@f-g.h.i. ..@a.b"), (2, "999.1.1.1.1 1.2.3.4.5.6.7.8 001.02.3.255 1.2.3.256"),
    (3, "4111 1111 1111 1111, 4111-1111-1111-1111 4111111111111112 0000000000000"), (4, "+1 (555) 010-9999 +12 3 +1234567890123456 ++49 30 1234567."),
    (5, "é日本 a@b.co 日 10.0.0.1 \U0001f600 +49 (30) 1234-567"), (6, "a@@b.c d@e.f@g.h"), (7, "5" * 5000 + "." + "1.1.1"), (8, "x" * 3000 + "@"),
]


def test_base_against_brute_force(spark):
    names = ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256"]
    for docs in (documents(spark), odd_documents(spark), docs_of(spark, TRICKY)):
        got = pii.digest_columns(pii.spans(docs)).select(names)
        assert sorted(map(tuple, got.collect()), key=str) == sorted((brute(r["doc_id"], r["text"]) for r in docs.collect()), key=str)


def test_long_runs_take_linear_time():
    assert pii.base_spans("a" * 10**6) == [] and pii.base_spans("a." * 500000 + "@") == []
    assert pii.base_spans("1" * 10**6 + ".1") == []


def corpus(spark):
    """Zorblax stands beside one address only; 'writes' stands everywhere."""
    rows = [(i, f"now Zorblax writes from ann@example.com about number {i}") for i in range(5)]
    rows += [(10 + i, f"someone now writes from bob{i}@example.com about number {i}") for i in range(40)]
    return docs_of(spark, rows + [(100, "a plain text that writes about Zorblaxes and nothing else"), (101, None)])


def test_disclosing_terms(spark):
    docs = corpus(spark)
    found = {r["doc_id"]: r["spans"] for r in pii.digest_columns(pii.spans(docs)).collect()}
    assert found[0] == "email:24:39,remove:4:11" and found[10] == "email:24:40" and found[100] == "" and found[101] == ""
    revealed = {r["term"]: r["revealed"] for r in pii.disclosing(docs, pii.find(docs), least=-99).collect()}
    assert abs(revealed["zorblax"] - 1) < 1e-9 and abs(revealed["writes"]) < 0.1


def distant(spark):
    """Quuxley is in every document of one address, six words off or more, and in one without it."""
    far = "with one two three four five six seven words between"
    rows = [(i, f"Quuxley {far} then ann@example.com number {i}") for i in range(4)]
    rows += [(10 + i, f"nobody {far} then bob{i}@example.com number {i}") for i in range(300)]
    return docs_of(spark, rows + [(1000, "Here QUUXLEY is alone"), (1001, "write to quuxley@example.com today")])


def test_terms_far_from_the_entity_and_without_it(spark):
    for more in ({}, {"held_terms": 0}):
        found = {r["doc_id"]: r["spans"] for r in pii.digest_columns(pii.spans(distant(spark), generalise=0.5, remove=0.9, **more)).collect()}
        assert len(found) == 306
        assert found[0] == "email:66:81,remove:0:7"
        assert found[1000] == "remove:5:12" and found[10].startswith("email:") and "," not in found[10]
        assert found[1001] == "email:9:28"  # the base span keeps its own words


def test_near_terms_are_masked_in_other_documents(spark):
    rows = [(i, f"now Zorblax writes from ann@example.com about number {i}") for i in range(5)]
    rows += [(10 + i, f"someone now writes from bob{i}@example.com about number {i}") for i in range(40)]
    rows += [(60, "ann@example.com one two three four five six seven Zorblax"), (61, "we met zorblax there")]
    found = {r["doc_id"]: r["spans"] for r in pii.digest_columns(pii.spans(docs_of(spark, rows), generalise=0.5)).collect()}
    assert found[60].endswith(":50:57") and found[61].endswith("e:7:14")


def test_sanitise(spark):
    docs = clashing(corpus(spark), "key", "spans", "clean", "doc")
    out = pii.sanitise(docs)
    assert out.columns == docs.columns
    texts = {r["doc_id"]: r["text"] for r in out.collect()}
    assert texts[0] == "now  writes from [EMAIL] about number 0" and texts[101] is None
    assert texts[100].endswith("Zorblaxes and nothing else")
    general = {r["doc_id"]: r["text"] for r in pii.sanitise(corpus(spark), remove=2.0).collect()}
    assert general[1] == "now [NAME] writes from [EMAIL] about number 1"


def test_sanitise_takes_every_row_by_its_own_text(spark):
    rows = [(1, "to ann@example.com"), (1, "to bob at 10.0.0.1"), (1, "to ann@example.com"), (None, "no id, 10.0.0.1"), (None, None), (2, "")]
    out = pii.sanitise(docs_of(spark, rows))
    assert sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=str) == sorted(
        [(1, "to [EMAIL]"), (1, "to bob at [IP]"), (1, "to [EMAIL]"), (None, "no id, [IP]"), (None, None), (2, "")], key=str
    )
    assert pii.sanitise(empty_documents(spark)).count() == 0


def test_a_text_of_very_many_matches(spark):
    text = " ".join(f"a{i}@example.com 10.0.{i // 256}.{i % 256}" for i in range(20_000))
    found = pii.digest_columns(pii.spans(docs_of(spark, [(1, text), (2, "none")]))).filter("doc_id = 1").first()
    assert (found["n_email"], found["n_ip"], found["n_phone"]) == (20_000, 20_000, 0)


def test_empty(spark):
    assert pii.spans(empty_documents(spark)).count() == 0
