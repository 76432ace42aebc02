import hashlib
import re

import pytest

from shopseg.llm import catalog, pii
from .helpers import ODD, SCHEMA, corpus, table

RULES = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
         ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
         ("card", r"[0-9]([\x20-]?[0-9])+"),
         ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def base(text):
    """Brute force of the base spans."""
    out = []
    for kind, pattern in RULES:
        for m in re.finditer(pattern, text or ""):
            d = [int(c) for c in m[0] if c in "0123456789"]
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (16 <= len(d) <= 19 and sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(d[::-1])) % 10 == 0):
                continue
            if kind == "phone" and not 8 <= len(d) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return out


TEXTS = [*ODD, "a@b.c_d@e.f x@y.z.", "..a@b..c %+-@q.r é@é.com", "@@a@b.c@d.e", "mail me: é a.b@c.d, and 1.2.3.4.5.6.7.8 too",
         "256.1.1.1 0000.00255.1.1 1.2.3 01.02.03.004", "4111 1111 1111 1111 and 4111-1111-1111-1111 or 4111 1111 1111 1112",
         "4111111111111111 " * 3, "+1 (826) 555-7388 +1 2 +123456789012345678 ++49 30 1234567-", "1 " * 4000, "1.2." * 3000,
         "a." * 3000 + "@b.c", "x@y" + ".z" * 5000, "日本 mail@host.jp 語 192.168.0.1", "-" * 3000 + "5", "+1" + " " * 5000]


def check(spark, docs):
    got = pii.find_spans(docs).select("doc_id", pii.listed("spans", "s.kind < 4").alias("base"), "spans").collect()
    want = sorted((str(r.doc_id), ",".join(f"{k}:{a}:{z}" for k, a, z in base(r.text))) for r in docs.collect())
    assert sorted((str(r.doc_id), r.base) for r in got) == want
    return got


def test_base_spans(spark):
    check(spark, table(spark, TEXTS))
    check(spark, corpus(spark))


def test_null_repeated_empty(spark):
    rows = [(None, "a@b.c"), (1, "a@b.c"), (1, "a@b.c"), (1, None), (2, "none")]
    check(spark, spark.createDataFrame([(*r, None, None, None) for r in rows], SCHEMA))
    assert pii.find_spans(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.fixture(scope="module")
def disclosed(spark):
    texts = [f"text {'abcdefghij'[i % 10]} says Zorblax wrote to jane@corp.example today {'klmnopqrst'[i % 10]}" for i in range(10)]
    texts += [f"other wrote today says number {'abcdefghijklmnopqrstuvwxyz'[i % 26] * (i // 26 + 1)}" for i in range(200)]
    texts += ["Zorblax without the address", "jane@corp.example alone", "once near Quux bob@corp.example"]
    return table(spark, texts)


def test_disclosing_terms(spark, disclosed):
    got = {r.doc_id: [(s.start, s.end, s.removed) for s in r.spans if s.kind == 4] for r in check(spark, disclosed)}
    text = disclosed.where("doc_id = 0").first().text
    a = text.index("Zorblax")
    assert (a, a + 7, False) in got[0] or (a, a + 7, True) in got[0]
    for word in ("says", "wrote", "today"):  # as common elsewhere
        assert text.index(word) not in [s for s, *_ in got[0]]
    assert got[210] == [] and got[211] == [] and got[212] == []  # far from the entity, and too little support
    assert all(not got[i] for i in range(10, 210))


def test_terms_are_measured_by_pmi(spark, disclosed):
    """Counts and ratio against brute force over the texts."""
    import math
    matches = pii._matches(disclosed)
    spans = [r for r in pii.find_spans(disclosed).collect() if r.doc_id == 0][0].spans
    texts = {r.text.lower() for r in disclosed.collect()}
    n_e = sum("jane@corp.example" in t and t.split()[0] == "text" for t in texts)
    n_t, n_te = sum("zorblax" in t for t in texts), sum("zorblax" in t and "jane@" in t for t in texts)
    pmi, info = math.log2(n_te * len(texts) / (n_t * n_e)), math.log2(len(texts) / n_e)
    assert matches.select("h").distinct().count() == len(texts)
    assert pmi / info >= pii.GENERALISE and [s.removed for s in spans if s.kind == 4 and s.end - s.start == 7] == [pmi / info >= pii.REMOVE]


def test_sanitise(spark, disclosed):
    got = {r.doc_id: r.text for r in pii.sanitise(disclosed).collect()}
    assert "jane" not in "".join(got.values()) and "[EMAIL]" in got[0] and "Zorblax" not in got[0] and "Zorblax" in got[210]
    docs = table(spark, ["é a@b.c and 1.2.3.4, end", None, "plain"])
    assert {r.doc_id: r.text for r in pii.sanitise(docs).collect()} == {0: "é [EMAIL] and [IP], end", 1: None, 2: "plain"}
    assert pii.sanitise(docs).columns == docs.columns


def test_query(spark):
    texts = {r.doc_id: r.text for r in corpus(spark).collect()}
    for r in catalog.op9_pii(spark, "/root/testdata/sf0.001").collect():
        own = base(texts[r.doc_id])
        joined = ",".join(f"{k}:{a}:{z}" for k, a, z in own)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x for k, *_ in own) for x, _ in RULES]
        assert set(joined.split(",")) - {""} <= set(r.spans.split(","))


def test_entities_of_one_or_two_texts(spark):
    """The estimate against brute force; terms far from the entity, with digits, short, at every place of the text."""
    import math
    filler = " ".join(f"fill{i}" for i in range(30))
    texts = [f"Zorblax7 {filler} pay ann@corp.example today {filler} zorblax7 Q9", f"Vextrum {filler} bob@corp.example today", f"vextrum again {filler} bob@corp.example"]
    texts += [f"today {filler} no {i % 500}" for i in range(1500)]
    docs = table(spark, texts)
    got = {r.doc_id: {(s.start, s.end, s.removed) for s in r.spans if s.kind == 4} for r in check(spark, docs)}
    held = {r.text: set(re.findall(r"\w+", re.sub(r"\S+@\S+", " ", r.text.lower()))) for r in docs.collect()}
    n, b = len(held), pii.PRIOR
    for i, who in ((0, "ann@"), (1, "bob@"), (2, "bob@")):
        want, n_e, n_k = set(), sum(who in t for t in held), sum("@" in t for t in held)
        for m in re.finditer(r"\w+", re.sub(r"\S+@\S+", lambda x: " " * len(x[0]), texts[i].lower())):
            mine = [t for t in held if m[0] in re.findall(r"\w+", t.lower())]
            of_kind = (sum("@" in t for t in mine) + b * n_k / n) / (len(mine) + b)
            p = (sum(who in t for t in mine) + b * of_kind * n_e / n_k) / (len(mine) + b)
            share = math.log2(p * n / n_e) / math.log2(n / n_e)
            want |= {(m.start(), m.end(), share >= pii.REMOVE)} if share >= pii.GENERALISE else set()
        assert got[i] == want
    words = {i: {texts[i][a:z] for a, z, _ in got[i]} for i in range(3)}
    assert {"Zorblax7", "zorblax7", "Q9"} <= words[0] and "Vextrum" in words[1] and "vextrum" in words[2]
    assert not any("fill" in w or w == "today" for i in words for w in words[i])
    assert not any(got[i] for i in range(3, len(texts)))


def test_other_matches_cut_no_context(spark):
    """Numbers that are no card, and other entities, hide no term from an entity; words within entities are no terms."""
    own = ["Zorblax paid 2024 by card 4111 1111 1111 1111 on 12 May 1999", "Quuxby x@y.example, z@y.example, +49 30 1234567 or 1.2.3.400"]
    got = {r.doc_id: r for r in check(spark, table(spark, [*own, *(f"paid by card on 12 May 1999, or in 2024 {i}" for i in range(1500))]))}
    terms = {i: {own[i][s.start:s.end] for s in got[i].spans if s.kind == 4} for i in range(2)}
    assert "Zorblax" in terms[0] and "Quuxby" in terms[1]
    assert not terms[0] & {"paid", "2024", "card", "4111", "1999"} and not terms[1] & {"x", "y", "z", "example", "49", "30"}
