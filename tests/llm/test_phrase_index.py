"""Phrases of items in documents, exact and near, against brute force."""

import hashlib
import re

import pytest
from tests_prose import prose

from queuelake.llm import phrase_index
from queuelake.llm.phrase_index import END

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(phrase_index.WORD, (text or "").translate(_LOWER))


def brute(docs, items, size=10):
    phrases = {}
    for item, text in items:
        ws = words(text)
        for i in range(max(1, len(ws) - size + 1) if ws else 0):
            phrases.setdefault(tuple(ws[i : i + size]), set()).add("" if item is None else str(item))
    out = []
    for doc, text in docs:
        ws, hit, found = words(text), set(), set()
        for n in {len(p) for p in phrases}:
            for i in range(len(ws) - n + 1):
                ids = phrases.get(tuple(ws[i : i + n]))
                if ids:
                    hit.update(range(i, i + n))
                    found |= ids
        out.append((doc, len(ws), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def items_of(spark, rows):
    return spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "item_id bigint, text string, term int, phrase int")


@pytest.fixture(scope="session")
def planted(odd_rows):
    long = prose(1, 30_000)
    passage = prose(5, 45)
    items = [
        (1, " ".join(long[200:240])),
        (2, "--".join(passage)),
        (2, "a word"),
        (3, None),
        (4, " ?! "),
        (5, "alone"),
        (6, " ".join(long[210:228])),
        (None, "WORD"),
        (7, "one one one two one one one two one one one two"),
        (8, "  ".join(passage)),
    ]
    docs = [(r[0], r[1]) for r in odd_rows]
    docs += [(50 + i, " ".join(prose(90 + i, 30) + passage[i : i + 9 + i % 4] + prose(95 + i, 8))) for i in range(12)]
    docs += [(70, "one one one two " * 7), (71, "one one two one one two " * 9), (72, " ".join(passage * 3))]
    return docs, items


@pytest.mark.parametrize("size", [10, 3])
def test_contamination(as_docs, spark, planted, size):
    """Nulls, repeated rows and ids, phrases shared by items, terms that repeat in a phrase, items of one word."""
    docs, items = planted
    found = phrase_index.contamination(as_docs([(i, t, None, None) for i, t in docs]), items_of(spark, items), size)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == brute(docs, items, size)


def test_contamination_without_broadcasts(as_docs, spark, planted, monkeypatch):
    docs, items = planted
    monkeypatch.setattr(phrase_index, "BROADCAST_ROWS", 0)
    found = phrase_index.contamination(as_docs([(i, t, None, None) for i, t in docs]), items_of(spark, items))
    assert sorted((tuple(r) for r in found.collect()), key=repr) == brute(docs, items)


def test_contamination_of_nothing(as_docs, spark, planted):
    docs, items = planted
    assert phrase_index.contamination(as_docs([]), items_of(spark, items)).collect() == []
    clean = phrase_index.contamination(as_docs([(i, t, None, None) for i, t in docs]), items_of(spark, []))
    assert sorted((tuple(r) for r in clean.collect()), key=repr) == brute(docs, [])


def test_postings_are_whole_and_sorted(as_docs, spark, planted):
    """Every listed word of every document is filed; a segment's terms are in order, so scans skip pages."""
    docs, items = planted
    terms, _, _ = phrase_index.windows(items_of(spark, items))
    index = phrase_index.postings(as_docs([(i, t, None, None) for i, t in docs]), terms)
    known = {r.word for r in terms.collect()}
    assert index.where(f"term <> {END}").count() == sum(w in known for _, t in docs for w in words(t))
    for part in index.select("term").rdd.glom().collect():
        assert [r.term for r in part] == sorted(r.term for r in part)
    plan = index.where("term IN (1, 2)")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(term, [1,2])]" in plan


def test_native(as_docs, spark, planted):
    """No Python worker takes part."""
    docs, items = planted
    found = phrase_index.contamination(as_docs([(i, t, None, None) for i, t in docs]), items_of(spark, items))
    plan = found._jdf.queryExecution().toString()
    assert "Python" not in plan and "InArrow" not in plan and "InPandas" not in plan


def test_proximity(as_docs, spark):
    docs = [(1, "x a y b z c q q q q a b"), (2, "c b a"), (3, "a b"), (4, None), (5, "a a b q c b a"), (6, "b q q q q q q a c")]
    items = [(1, "a b c"), (2, "a a b")]
    terms, placed, _ = phrase_index.windows(items_of(spark, items))
    index = phrase_index.postings(as_docs([(i, t, None, None) for i, t in docs]), terms)
    ids = {r.rid: r.doc_id for r in index.where(f"term = {END}").collect()}
    names = {r.phrase: r.words for r in placed.join(terms, "term").groupBy("phrase").agg({"word": "collect_list"}).toDF("phrase", "words").collect()}
    found = sorted((ids[r.rid], tuple(sorted(names[r.phrase])), r["first"], r["last"]) for r in phrase_index.proximity(index, placed, 5).collect())
    expected = []
    for doc, text in docs:
        ws = (text or "").split()
        for phrase in (("a", "b", "c"), ("a", "a", "b")):
            full = [s for s in range(-4, len(ws)) if all(ws[max(s, 0) : s + 5].count(w) >= phrase.count(w) for w in phrase)]
            starts = [s for s in full if s - 1 not in full]
            expected += [(doc, tuple(sorted(phrase)), s, next(e for e in range(s, len(ws) + 1) if e + 1 not in full)) for s in starts]
    assert found == sorted(expected)
