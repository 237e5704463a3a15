import re

from textloom.llm import private, queries

FORMS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def ok(kind, match):
    digits = [int(c) for c in match if c.isascii() and c.isdigit()]
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        return 12 <= len(digits) <= 19 and sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(reversed(digits))) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def brute(text):
    out = [(m.start(), n, k, m.end()) for n, (k, form) in enumerate(FORMS.items()) for m in re.finditer(form, text or "") if ok(k, m.group())]
    return sorted(out)


def joined(spans):
    return ",".join(f"{k}:{s}:{e}" for s, _, k, e in spans)


def check(result, rows, sha):
    want = {key: brute(text) for key, text in rows}
    assert len(result) == len(rows)
    for r in result:
        spans = want[r.doc_id]
        assert r.base_sha256 == sha(joined(spans)), r.doc_id
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[2] == k for s in spans) for k in FORMS]
        assert set(joined(spans).split(",")) <= set(r.spans.split(","))
        assert len(r.spans.split(",")) - (r.spans == "") == len(spans) + r.n_found


ODD = [
    None, "", "a@b.c", "a@b.c_d@e.f", "x a@b.c@d.e.f g", "é\U0001f600 me+you@x-y.co.uk.", "a@b", "@b.c", "..@a.b", "a.@-.-.", "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1 0255.001.0.000", "1.2.3", "0" * 400 + ".1.1.1",
    "4111 1111-1111 1111", "4111  1111 1111 1111", "4111111111111111 5", "0" * 12, "0" * 19, "0" * 20, "5 5", "+1 (873) 555-4781", "+1", "+1 2", "+12345678", "+123456789012345", "+1234567890123456", "+1 ((((((((( 23456789.", "++12 345 678 901)",
    "a" * 50_000, "a@" * 3000, "7" * 50_000, "1." * 20_000, "+" * 5000 + "1 " * 5000, "\U0001f600" * 10 + " q@w.e",
]


def test_odd_texts(spark, table, folder, sha):
    check(queries.op2_private(spark, folder(documents=table(ODD + ODD[:4]))).collect(), list(enumerate(ODD + ODD[:4])), sha)
    assert queries.op2_private(spark, folder(documents=table([]))).count() == 0


def test_given_table(spark, data, sha):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{data}/documents.parquet").collect()]
    check(queries.op2_private(spark, data).collect(), rows, sha)


def texts():
    out = [f"note {i} please write to: user{i}@mail.example today" for i in range(8)]
    out += ["some words please write to: jane_corp9 or so", "we sent the 3 parts by mail", "the of the the q1@w.com the of the and the of the x"]
    return out + [f"the of the mail{i}@w.com but the of the house, the of the 2nd, the of the garden, the of the end" for i in range(9)]


def test_contexts_find_more(spark, table):
    rows = {r.doc: r for r in private.find(table(texts())).collect()}
    start = texts()[8].index("jane_corp9")
    assert [tuple(s) for s in rows[8].found] == [(start, 0, "email", start + 10)]
    assert all(not r.found for k, r in rows.items() if k != 8)  # "of the" stands before much else


def test_redacted(spark):
    df = spark.createDataFrame([(1, "mail a@b.c or +1 (873) 555-4781, 4111 1111 1111 1111; 1.2.3.4 v1.2", "z"), (2, None, "y")], "doc_id long, text string, found string")
    rows = {r.doc_id: r for r in private.redact(df).collect()}
    assert rows[1].text == "mail <EMAIL> or <PHONE>, <CARD>; <IP> v1.2" and rows[1].found == "z" and rows[2].text is None


def test_overlapping_kinds_leave_no_rest(spark, table):
    texts = ["call +49.30.12.34 567 now", "+49.30.12.34 567", "mail 1.2.3.4@b.c, 1.2.3.4", "\U0001f600 +49.30.12.34 567 a@b.c", "+49 30 123456 1.2.3.4 99999999", None, ""]
    rows = {r.doc_id: r.text for r in private.redact(table(texts)).collect()}
    assert rows == {0: "call <PHONE> now", 1: "<PHONE>", 2: "mail <EMAIL>, <IP>", 3: "\U0001f600 <PHONE> <EMAIL>",
                    4: "<PHONE> <IP> 99999999", 5: None, 6: ""}
