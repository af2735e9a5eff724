import math
import random
import re
from collections import defaultdict

import regex
from pyspark.sql import functions as F

from footfall.llm import pii as P
from tests.conftest import SF_SMALL

PLAIN = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
         ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def _luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def _plain_spans(text):
    out = []
    for k, (name, pattern) in enumerate(PLAIN):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if name == "ip" and any(int(p) > 255 for p in m.group().split(".")) \
                    or name == "card" and not (14 <= len(digits) <= 19 and _luhn(digits)) \
                    or name == "phone" and not 10 <= len(digits) <= 15:
                continue
            out.append((m.start(), k, m.end(), name))
    return ",".join(f"{n}:{s}:{e}" for s, _, e, n in sorted(out))


def test_base_spans_equal_plain_patterns(spark):
    rng = random.Random(9)
    texts = [r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    texts += ["a@b.c_x@d.e", "x a@b.c.@d.e x@y.z,,x@y.z", "1.2.3.4.5.6.7.8 999.1.1.1 0255.0.0.01", "5 -6 7", "", None,
              "4111 1111 1111 1111 x 4111-1111-1111-1112 é 4111111111111111", "+1 (202) 555-0100. +1234567",
              "\U0001f600 a@b.co \U0001f600 a@b.co", "a" * 30_000 + "@", "1" * 30_000, "a@" + "b." * 20_000 + "c", "+1" + " " * 9000]
    texts += ["".join(rng.choice("a1.@+- (5é\n") for _ in range(rng.randrange(60))) for _ in range(1500)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.s for r in P.base_spans(docs).select("doc_id", P.listed("spans").alias("s")).collect()}
    assert got == {i: _plain_spans(t) for i, t in enumerate(texts)}


def test_disclosing_terms_by_hand(spark):
    texts = ["mail john smithers at js@x.org now", "ask Smithers by js@x.org please", "smithers, js@x.org",
             "write smithers or js@x.org today", "please now mail other@y.org today"]
    texts += ["please go now by mail and ask today"] * 60
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r for r in P.find_personal_data(docs).collect()}
    terms = {i: [texts[i][t.start:t.end] for t in r.terms] for i, r in rows.items()}
    # n = 65; "smithers" and js@x.org share 4 documents: PMI = IC, all of it is disclosed.
    assert [terms[i] for i in range(5)] == [["smithers"], ["Smithers"], ["smithers"], ["smithers"], []]
    assert all(t.removed for i in range(4) for t in rows[i].terms)
    clean = {r.doc_id: r.text for r in P.sanitise(docs).collect()}
    assert clean[1] == "ask  by [email] please" and clean[4] == "please now mail [email] today" and clean[9] == texts[9]


def test_copies_alone_prove_nothing(spark):
    docs = spark.createDataFrame([(i, "unique words near a@b.org stay") for i in range(9)] + [(9, "other")], "doc_id long, text string")
    assert all(not r.terms for r in P.find_personal_data(docs).collect())


def test_two_contexts_are_enough_for_a_term(spark):
    texts = ["mail vandermeer at a@b.org now", "vandermeer, a@b.org today"] + ["mail now at " + "x" * i for i in range(3, 33)] * 2
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts + texts[:1] * 5)], "doc_id long, text string")
    rows = {r.doc_id: r for r in P.find_personal_data(docs).collect()}
    for i in (0, 1, len(texts)):
        assert [(texts[i % len(texts)][t.start:t.end], t.removed) for t in rows[i].terms] == [("vandermeer", False)]


def test_terms_anywhere_in_the_text_of_an_entity(spark):
    far = " now mail at xx" * 20
    texts = [f"Vandermeer signed.{far} a@b.org", f"ask by a@b.org today.{far} Yours, vandermeer or Vandermeer"]
    texts += ["ask now mail by today at signed yours or " + "x" * i for i in range(2, 62)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = P.find_personal_data(docs).orderBy("doc_id").collect()
    found = [[texts[r.doc_id][t.start:t.end] for t in r.terms] for r in rows]
    assert found == [["Vandermeer"], ["vandermeer", "Vandermeer"]] + [[]] * 60


def _plain_terms(texts, generalise_at=0.7, remove_at=0.95):
    """{text: [(start, end, removed)]} by counting every pair of term and mail address."""
    mail = re.compile(PLAIN[0][1])
    distinct = sorted({t or "" for t in texts})
    words = {t: {w.lower() for w in regex.findall(r"\p{L}{3,40}+", t)} for t in distinct}
    holders, n_term = defaultdict(dict), defaultdict(int)
    for t in distinct:
        for w in words[t]:
            n_term[w] += 1
        found, at = list(mail.finditer(t)), 0
        for m, after in zip(found, [f.start() for f in found[1:]] + [len(t)]):
            before, behind = t[at:m.start()], t[m.end():after]
            before = regex.sub(r"^\p{L}+", "", before[-48:]) if len(before) > 48 else before
            behind = regex.sub(r"\p{L}+$", "", behind[:48]) if len(behind) > 48 else behind
            holders[m.group().lower()][t], at = (before, behind), m.end()
    n, told = len(distinct), defaultdict(dict)
    for entity, having in holders.items():
        if 1 - 3.0 ** -len(set(having.values())) < generalise_at or len(having) == n:
            continue
        for w in set().union(*(words[t] for t in having)):
            both = [t for t in having if w in words[t]]
            share = ((1 - 3.0 ** -len({having[t] for t in both}))
                     * math.log(n * len(both) / (n_term[w] * len(having))) / math.log(n / len(having)))
            if share >= generalise_at:
                for t in both:
                    told[t][w] = max(told[t].get(w, 0), share)
    out = {}
    for t in distinct:
        spans = [m.span() for m in mail.finditer(t)]
        out[t] = [(m.start(), m.end(), told[t][m.group().lower()] >= remove_at) for m in regex.finditer(r"\p{L}{3,40}+", t)
                  if m.group().lower() in told[t] and not any(s < m.end() and m.start() < e for s, e in spans)]
    return out


def test_terms_equal_to_counting_every_pair(spark):
    rng = random.Random(12)
    common, texts = [f"w{chr(97 + k)}{chr(97 + k // 5)}rd" for k in range(25)], []
    for k in range(400):
        words = rng.choices(common, k=rng.randrange(3, 25))
        if k % 2:
            who = rng.randrange(14)
            words.insert(rng.randrange(len(words)), f"u.x{who}@Mail{who}.org" if k % 4 == 1 else f"U.x{who}@mail{who}.org")
            for j in range(who % 4):
                if rng.random() < 0.8:
                    words.insert(rng.randrange(len(words)), rng.choice(["Telling", "telling"]) + "abcdefghijklmn"[who] * (j + 1))
        texts.append(" ".join(words))
    for k in range(6):  # entities of two texts
        texts += [" ".join([*rng.choices(common, k=9), f"rare{'pqrstu'[k]}", f"r{k}@two.org", *rng.choices(common, k=j)]) for j in (3, 5)]
    texts += texts[1:40:3] + [None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = _plain_terms(texts)
    got = {r.doc_id: [(t.start, t.end, t.removed) for t in r.terms] for r in P.find_personal_data(docs).collect()}
    assert got == {i: want[t or ""] for i, t in enumerate(texts)}
    assert {x for found in want.values() for _, _, x in found} == {True, False}


def test_very_many_spans_in_one_text(spark):
    text = " ".join(f"a{k}@b.org x" for k in range(20_000))
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert P.base_spans(docs).select(P.listed("spans").alias("s")).first().s == _plain_spans(text)
    assert P.sanitise(docs).first().text == " ".join(["[email] x"] * 20_000)


def test_overlapping_spans_leave_nothing(spark):
    # a phone number, an address inside it that goes on, and a mail address
    text = "\u00e9 +1 202 555 01 10.1.2.3 end me@x.org"
    docs = spark.createDataFrame([(1, text), (2, "10.1.2.3 or 1.2.3.4@x.org."), (3, "none")], "doc_id long, text string")
    out = {r.doc_id: r.text for r in P.sanitise(docs).collect()}
    assert out == {1: "\u00e9 [phone] end [email]", 2: "[ip] or [email].", 3: "none"}


def test_actions_are_listed(spark):
    texts = ["mail vandermeer at a@b.org now", "vandermeer, a@b.org today"] + ["mail now at " + "x" * i for i in range(3, 33)] * 2
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r.a for r in P.find_personal_data(docs).select("doc_id", P.actions("terms").alias("a")).collect()}
    assert (rows[0], rows[1], rows[5]) == ("generalise:5:15", "generalise:0:10", "")


def test_edge_rows(spark, edge_docs, no_docs):
    found = P.find_personal_data(edge_docs)
    assert found.count() == edge_docs.count() and found.where(F.size("spans") + F.size("terms") > 0).count() == 0
    extra = edge_docs.withColumn("text", F.when(F.col("doc_id") == 1, "to a@b.org").otherwise(F.col("text")))
    out = P.sanitise(extra)
    assert out.columns == edge_docs.columns and out.count() == edge_docs.count()
    assert [r.text for r in out.where("doc_id = 1").collect()] == ["to [email]"] * 2
    assert out.where("doc_id = 6").first().text is None
    assert P.find_personal_data(no_docs).count() == 0 and P.sanitise(no_docs).count() == 0


def test_no_python_on_the_path(spark, edge_docs):
    plan = P.find_personal_data(edge_docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
