import hashlib
import re

from likeness.llm import private_terms as pt
from likeness.llm.common import table
from tests.conftest import SF_ORACLE
from tests.llm.helpers import DOCS, TEXTS, docs

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(d[::-1])) % 10 == 0


def base(text):
    """Plain scan with the contract's expressions."""
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m[0])
            if {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                    "card": 16 <= len(d) <= 19 and luhn(d), "phone": 8 <= len(d) <= 15}[kind]:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


CASES = TEXTS + [
    "é mail a.b@c.de, x@y z@q..r a@b.c.@d.e ..k@l.m. n@o.p..q@r.s t@u-v.w_x@y.z", "🙂 1.2.3.4 256.1.1.1 1.2.3.4.5 001.02.3.004 1..2.3.4",
    "4111 1111 1111 1111 x 4111-1111-1111-1111- 4111  1111111111111111 41111111111111112 5", "+49 (30) 123-45 67. +1 +12345678) ++44 20 7946 0958 ",
    "1 2 3 4 " * 4000, "a@" + "b." * 6000 + "c", "a." * 6000 + "@x.y", "9" * 30000, "+1" + " " * 20000, "a@b.c@d.e f@g.h.i@j.k",
]


def split_spans(row):
    return [s for s in row.spans.split(",") if s and not s.startswith("term:")]


def test_base_spans_equal_a_plain_scan(spark):
    found = {r.doc_id: r for r in pt.q_private(docs(spark, CASES)).collect()}
    for i, text in enumerate(CASES):
        want = base(text or "")
        assert split_spans(found[i]) == want, (text or "")[:80]
        assert found[i].base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert found[i].n_card == sum(s.startswith("card") for s in want)


def test_whole_table(spark):
    d = table(spark, SF_ORACLE, "documents")
    texts = {r.doc_id: r.text for r in d.select("doc_id", "text").collect()}
    for r in pt.q_private(d).collect():
        assert split_spans(r) == base(texts[r.doc_id] or "")


def test_a_term_that_only_comes_with_one_entity_is_found(spark):
    rows = [f"write to Zebulon at zeb@mail.org about the report {i}" for i in range(5)]
    rows += [f"the report of week {i} was sent to all, write about it" for i in range(40)]
    out = {r.doc_id: r for r in pt.q_private(docs(spark, rows)).collect()}
    at = rows[0].index("Zebulon")
    assert f"term:{at}:{at + 7}" in out[0].spans.split(",")
    assert not any(s.startswith(f"term:{rows[0].index('report')}:") for s in out[0].spans.split(","))
    assert all(out[i].spans == "" for i in range(5, 45))
    clean = {r.doc_id: r for r in pt.sanitise(docs(spark, rows)).collect()}
    assert "Zebulon" not in clean[0].text and "[EMAIL]" in clean[0].text and clean[0].Score == "clash"
    assert clean[7].text == rows[7]


def test_nulls_and_empty_table(spark):
    assert pt.q_private(spark.createDataFrame([], DOCS)).count() == 0
    assert pt.sanitise(docs(spark, [None, ""])).where("doc_id is not null").orderBy("doc_id").collect()[0].text is None


def test_no_python_in_the_plan(spark):
    plan = pt.q_private(docs(spark))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_a_term_is_counted_and_marked_in_whole_documents(spark):
    far = "about this and that " * 20
    rows = [f"zeb@mail.org {far} Zebulon {far} Zebulon" for _ in range(4)] + ["a note on Zebulon alone"] + [far] * 60
    out = {r.doc_id: r.spans.split(",") for r in pt.q_private(docs(spark, rows)).collect()}
    for i in range(5):
        want = {f"term:{m.start()}:{m.end()}" for m in re.finditer("Zebulon", rows[i])}
        assert want <= set(out[i])
    clean = {r.doc_id: r.text for r in pt.sanitise(docs(spark, rows)).collect()}
    assert not any("Zebulon" in clean[i] for i in range(5)) and clean[9] == far


def test_leaving_out_hopeless_pairs_loses_no_term(spark, monkeypatch):
    d = table(spark, SF_ORACLE, "documents")
    found = pt._found(d, "doc_id", "text", [])
    want = {(r.entity, r.term): r.disclosure for r in pt.disclosing_terms(found).collect()}
    monkeypatch.setattr(pt, "LISTED", 0)        # nothing is listed: every pair is counted
    assert want and want == {(r.entity, r.term): r.disclosure for r in pt.disclosing_terms(found).collect()}


def test_entities_of_one_or_two_documents_disclose(spark):
    names = ["Zebulon", "Wu", "7Q41", "नमिता"]
    rows = [f"report of {name} to p{k}x@mail.org about the week" for k, name in enumerate(names)]
    rows += [rows[0] + " again", "notes on Wu"] + ["report of all to all about the week again notes on 12"] * 40
    out = {r.doc_id: r.spans.split(",") for r in pt.q_private(docs(spark, rows)).collect()}
    for i, name in [(0, "Zebulon"), (1, "Wu"), (2, "7Q41"), (3, "नमिता"), (4, "Zebulon"), (5, "Wu")]:
        at = rows[i].index(name)
        assert [s for s in out[i] if s.startswith("term")] == [f"term:{at}:{at + len(name)}"]
    assert all(out[i] == [""] for i in range(6, 46))


def test_many_words_in_one_text_take_linear_time(spark):
    import time

    took = []
    for n in (2000, 32000):
        text = "zeb@mail.org " + " ".join(f"w{i}" for i in range(n))
        d = docs(spark, [text] + ["other words for all of them"] * 20)
        start = time.time()
        spans = [r.spans for r in pt.q_private(d).where("doc_id = 0").collect()][0].split(",")
        took.append(time.time() - start)
        at = 13
        assert len(spans) == n + 1 and spans[1] == f"term:{at}:{at + 2}" and spans[-1].endswith(f":{len(text)}")
    assert took[1] < took[0] + 60
