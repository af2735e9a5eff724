import hashlib

import pytest

from footfall.llm import line_dedup as L
from tests.conftest import SF_SMALL
from tests.llm import brute


@pytest.mark.parametrize("bits", [None, 16])
def test_equal_to_brute_force_whatever_the_filter(spark, bits):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    want = brute.line_dedup(texts)
    got = {r.doc_id: r.text for r in L.dedup_lines(docs, filter_bits=bits).collect()}
    assert got == want and any(got[i] != t for i, t in texts)
    report = {r.doc_id: r for r in L.line_report(docs, filter_bits=bits).collect()}
    for i, t in texts:
        assert report[i].n_lines == t.count("\n") + 1
        assert report[i].kept_sha256 == hashlib.sha256(want[i].encode()).hexdigest()


def test_filters_follow_the_lines(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    most = sum(len(L.long_keys(r.text.encode(), 20)) for r in docs.collect())
    assert most <= L.possible_lines(docs, 20) <= 50 * most
    assert L.filter_size(0) == (20, 1) and L.filter_size(10 ** 7) == (26, 1)
    bits, ranges = L.filter_size(3 * 10 ** 9)
    assert bits == L.MOST_BITS and ranges << bits >= 12 * 10 ** 9
    hashes = L._hashes([b"%d" % k for k in range(5000)])
    shares = [L._in_range(hashes, 5, k) for k in range(5)]
    assert (sum(s.astype(int) for s in shares) == 1).all() and min(s.sum() for s in shares) > 800


def test_ranges_of_hashes_change_no_result(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [{(r.doc_id, r.text_key, frozenset(map(bytes, r.drops))) for r in found.collect()}
            for found in (L.repeated_lines(docs), L.repeated_lines(docs, filter_bits=18, ranges=3))]
    assert rows[0] == rows[1] and rows[0]


def test_edge_rows(spark, edge_docs, no_docs):
    out = L.dedup_lines(edge_docs)
    assert out.columns == edge_docs.columns and out.count() == edge_docs.count()
    texts = {}
    for r in out.collect():
        texts.setdefault(r.doc_id, set()).add(r.text)
    first = "Alpha beta gamma delta epsilon zeta"
    assert texts[1] == {first}  # both rows of the id lose the line, documents 1, 2 and 4 hold it
    assert texts[4] == {"x\nshared line of more than twenty CHARACTERS"}  # the largest id keeps it
    assert texts[3] == {"other words\nshared line of more than twenty characters\ttail"}  # another key
    assert texts[5] == {""} and texts[6] == {None} and texts[8] == {"\n\n\n"}
    report = {r.doc_id: r for r in L.line_report(edge_docs).collect()}
    assert (report[6].n_lines, report[6].n_dropped, report[8].n_lines) == (1, 0, 4)
    assert report[1].n_dropped == 1 and report[6].kept_sha256 == hashlib.sha256(b"").hexdigest()
    assert L.dedup_lines(no_docs).count() == 0 and L.line_report(no_docs).count() == 0


def test_all_lines_of_the_largest_id_stay(spark):
    line = "a line that is long enough to count"
    docs = spark.createDataFrame([(i, f"{line}\n{line.upper()}\nend") for i in range(1, 6)], "doc_id long, text string")
    got = {r.doc_id: r.text for r in L.dedup_lines(docs).collect()}
    assert got[5] == f"{line}\n{line.upper()}\nend" and all(got[i] == "end" for i in range(1, 5))


def test_rows_of_one_id_have_lists_of_their_own(spark):
    lines = [f"a line of the corpus with number {k}" for k in range(60)]
    rows = [(None, lines[k]) for k in range(60)] + [(i, "\n".join(lines)) for i in (1, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(len(r.drops) for r in L.repeated_lines(docs).collect()) == [1] * 60 + [60]
    assert sorted(r.text for r in L.dedup_lines(docs).collect()) == [""] * 61 + ["\n".join(lines)]
