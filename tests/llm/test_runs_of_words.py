"""Periodic runs against a plain search, awkward rows, and the query's rows."""

import hashlib
import zlib
from pathlib import Path

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from moodline.llm import queries, runs

SF = Path("/root/testdata/sf0.001")


def plain(word, least, times):
    """All runs, by comparing the words q apart for every q."""
    n, out = len(word), []
    for q in range(1, n // 2 + 1):
        k = 0
        while k < n - q:
            e = k
            while e < n - q and word[e] == word[e + q]:
                e += 1
            if e > k:
                size, part = e - k + q, word[k : e + q]
                shorter = any(part[p:] == part[:-p] for p in range(1, q))
                if size >= max(least, times * q) and not shorter:
                    out.append((k, size, q))
            k = e + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


@st.composite
def texts(draw):
    word = draw(st.lists(st.integers(0, draw(st.integers(1, 4))), max_size=70))
    for _ in range(draw(st.integers(0, 2))):
        if len(word) > 2:
            a, p = draw(st.integers(0, len(word) - 1)), draw(st.integers(1, 12))
            for k in range(a + p, min(len(word), a + draw(st.integers(2, 70)))):
                word[k] = word[k - p]
    return word


@settings(max_examples=400, deadline=None)
@given(texts(), st.sampled_from([(24, 3), (4, 2), (6, 3), (1, 2)]))
def test_same_as_plain_search(word, shape):
    want = plain(word, *shape)
    assert runs.runs_of(word, *shape) == want
    assert runs.find_runs([b"%d" % w for w in word], *shape) == want


def test_long_texts_stay_cheap():
    for word in ([0] * 100_000, [k % 777 for k in range(100_000)]):
        assert len(runs.runs_of(word)) == 1


def test_strongest_is_exact():
    assert runs.strongest([]) is None
    assert runs.strongest([(0, 30, 10), (5, 24, 8), (5, 60, 20)]) == (0, 30, 10)
    assert runs.strongest([(0, 10**17, 3), (9, 10**17 + 1, 3)]) == (9, 10**17 + 1, 3)


def reference(doc_id, text):
    """The contract's row, by plain search."""
    words = (text or "").encode().split()
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = plain(words, 24, 3)
    gone = {i for s, size, q in found for i in range(s + q, s + size)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None, None, None))
    listed = "".join(f"{s},{size},{q}\n" for s, size, q in found)
    return (
        doc_id, len(found), *best, best[1] * 1000 // best[2] if found else None,
        hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest(),
    )


def by_row(rows):
    return sorted(map(tuple, rows), key=repr)


def test_awkward_rows(spark):
    loop = "la li lu " * 9 + "end"
    rows = [(None, loop, 1), (1, None, 2), (2, "", 3), (3, " \t\x0b", 4), (4, loop, 5), (4, loop, 6),
            (13, "x " * 5000, 7), (5, "a b " * 30 + " " * 30, 8), (6, "Aa aA " * 20, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_runs int")  # a name of the result
    got = runs.digest(docs).collect()
    assert by_row(got) == by_row(reference(i, t) for i, t, _ in rows)
    assert runs.digest(docs.limit(0)).collect() == []
    kept = {r.doc_id: r for r in runs.collapse_runs(docs).collect()}
    assert kept[4].collapsed == "la li lu end" and [tuple(r) for r in kept[4].runs] == [(0, 27, 3)]
    assert kept[1].collapsed == "" and kept[1].runs == []


@pytest.mark.skipif(not SF.exists(), reason="test tables are not here")
def test_query(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    short = {r.doc_id: r.text for r in rows if len((r.text or "").split()) < 400}
    got = queries.op11_runs(spark, str(SF)).collect()
    assert sorted(r.doc_id for r in got) == sorted(r.doc_id for r in rows)
    assert by_row(r for r in got if r.doc_id in short) == by_row(reference(*r) for r in short.items())
    assert any(r.n_runs for r in got)
