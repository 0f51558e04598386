"""Alignment against a plain byte-by-byte version, the monoid's laws, awkward rows."""

import hashlib
from collections import Counter
from functools import reduce
from pathlib import Path

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from moodline.llm import alignment, queries
from moodline.llm.alignment import Fragment, fragment, links, ranges_of

P = pytest.importorskip("public_tokenizers")
SF = Path("/root/testdata/sf0.001")
FILES = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def both():
    with open(FILES[0], encoding="utf-8") as first, open(FILES[1], "rb") as second:
        return alignment.Tokenizers(first.read(), second.read())


@pytest.fixture(scope="module")
def by_file():
    with open(FILES[0], encoding="utf-8") as first:
        return alignment._by_file(first.read())


def parts(n):
    """Token sizes that add up to n."""
    return st.lists(st.integers(0, 1), min_size=n, max_size=n).map(
        lambda cuts: [k for k, c in enumerate([*cuts[:-1], 1], 1) if c]
    )


@st.composite
def streams(draw):
    n = draw(st.integers(1, 40))
    ends = [np.array(draw(parts(n))) for _ in "ab"]
    ids = [np.array([draw(st.integers(0, 3)) for _ in e], np.int32) for e in ends]
    cuts = sorted(draw(st.sets(st.integers(1, n), max_size=5)))
    return ids, ends, [0, *cuts, n + 1]


def same(x, y):
    return all(np.array_equal(a, b) for a, b in zip(x.packed(), y.packed(), strict=True))


@settings(max_examples=300, deadline=None)
@given(streams(), st.randoms(use_true_random=False))
def test_any_grouping_gives_the_same(stream, random):
    (a, b), (ea, eb), cuts = stream
    whole = fragment(a, b, ea, eb)
    pieces = []
    for lo, hi in zip(cuts, cuts[1:], strict=False):
        ia, ib = (ea > lo) & (ea <= hi), (eb > lo) & (eb <= hi)
        pieces.append(fragment(a[ia], b[ib], ea[ia], eb[ib]))
    assert same(reduce(Fragment.__add__, pieces), whole)
    while len(pieces) > 1:
        k = random.randrange(len(pieces) - 1)
        pieces[k : k + 2] = [pieces[k] + pieces[k + 1]]
    assert same(pieces[0], whole)
    assert same(Fragment() + whole, whole) and same(whole + Fragment(), whole)
    assert same(Fragment.unpacked(*whole.packed()), whole)
    # the groups, plainly
    common = sorted(set(ea.tolist()) & set(eb.tolist()))
    groups = [
        (a[(ea > lo) & (ea <= hi)], b[(eb > lo) & (eb <= hi)]) for lo, hi in zip([0, *common], common, strict=False)
    ]
    done = whole.whole()
    text = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
    assert done.groups.decode().rstrip(";") == text and done.n_groups == len(groups)
    want = Counter((int(i), int(j)) for x, y in groups for i in x for j in y)
    got = {(int(p) >> 32, int(p) & 0xFFFFFFFF): int(t) for p, t in zip(done.pairs, done.times, strict=True)}
    assert got == want and len(links([])[0]) == 0


@settings(max_examples=300, deadline=None)
@given(texts=st.lists(st.text(alphabet=st.sampled_from("ab é漢😀\n\t  ‍'sdt1²½_-%<|endoftext|>") | st.characters(codec="utf-8"), max_size=60)))
def test_both_encoders_agree(both, by_file, texts):
    assert [list(x) for x in both.first(texts)] == [list(x) for x in by_file(texts)]


def test_ranges_cover_the_text():
    text = b" " + b"some words " * 500 + b"x" * 9000 + b" and so on " * 50
    found = ranges_of(text, 512)
    assert len(found) > 8 and sum(hi - lo for _, lo, hi in found) == len(text)
    assert b"".join(t[lo:hi] for t, lo, hi in found) == text
    assert all(t.startswith(b" ") for t, _, _ in found)
    assert [t for t, _, _ in ranges_of(b" " + b"y" * 5000, 512)] == [b" " + b"y" * 5000]


def test_safe_places(both):
    assert both.safe
    text = "It's 3 cats, the dog　and a  bird\n\nso on. " * 30 + "été ñandú 漢字 😀 a b"
    for part in (text, "a" * 700 + " " + "b" * 700):
        whole = next(both.fragments([(b" " + part.encode(), 0, len(part.encode()) + 1)])).whole()
        for size in (7, 64, 300):
            pieces = both.fragments(ranges_of(b" " + part.encode(), size))
            assert same(reduce(Fragment.__add__, pieces).whole(), whole), size


def plain(texts, both):
    """The contract's rows (without id), one byte after the other."""
    every, out = [], []
    for text in texts:
        coded = next(both.encode([b" " + text.encode()])) if text else ((), ())
        goal = (" " + (text or "")).encode()
        owner = []
        for ids, own in zip(coded, (both.bytes_a, both.bytes_b), strict=True):
            owner.append([own[i] for i in ids])
        groups = []
        if text and all(b"".join(o) == goal for o in owner):
            ends = []
            for o in owner:
                at, mine = 0, []
                for t in o:
                    at += len(t)
                    mine.append(at)
                ends.append(mine)
            where = [dict(zip(m, map(int, c), strict=True)) for c, m in zip(coded, ends, strict=True)]
            groups = [[[], []]]
            common = set(ends[0]) & set(ends[1])
            for end in range(1, len(goal) + 1):
                for side in (0, 1):
                    if end in where[side]:
                        groups[-1][side].append(where[side][end])
                if end in common:
                    groups.append([[], []])
            groups.pop()
        every.append(groups)
    count = Counter()
    for groups in every:
        count.update({(i, j) for a, b in groups for i in a for j in b})
    best = {}
    for (i, _), n in count.items():
        best[i] = max(best.get(i, 0), n)
    for groups in every:
        pairs = [(i, j) for a, b in groups for i in a for j in b]
        text = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)
        out.append(
            (
                sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), len(pairs),
                sum(count[p] == best[p[0]] for p in pairs), sum(count[p] for p in pairs), text,
            )
        )
    return out


NAMES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]

ROWS = [
    (1, "hello world"), (2, None), (3, ""), (None, "null id"), (5, "hello world"), (5, "twice the id"),
    (7, "holds ▁ itself"), (8, "<|endoftext|> </s> <unk> <0x41> are text"), (9, "漢字 仮名 😀👩‍👧 ﷽ \u0000 \x07"),
    (10, "  two  spaces\n\n\ttabs   "), (11, "a" * 3000), (12, "=" * 500 + " " * 500 + "-" * 333),
    (13, "word and word " * 400), (14, "no safe place" .replace(" ", "_") * 300), (15, " "), (16, "\n"),
    (17, "words ▁ " * 300 + "and the rest of it " * 200),
]


@pytest.mark.parametrize("size, most", [(1 << 16, 10**6), (256, 10**6), (64, 0)])
def test_same_as_plain(spark, both, size, most):
    docs = spark.createDataFrame([(i, t, 0) for i, t in ROWS], "doc_id long, text string, n_a int").repartition(3)
    got = alignment.align(docs, *FILES, range_bytes=size, most_pairs=most)
    assert sorted(got.columns) == sorted(["doc_id", *NAMES])
    want = [(i, *r) for (i, _), r in zip(ROWS, plain([t for _, t in ROWS], both), strict=True)]
    rows = [(r.doc_id, *[r[c] for c in NAMES]) for r in got.collect()]
    assert sorted(rows, key=repr) == sorted(want, key=repr)
    assert alignment.align(docs.limit(0), *FILES, most_pairs=most).collect() == []


@pytest.mark.skipif(not SF.exists(), reason="test tables are not here")
def test_query(spark, both):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = [
        (r.doc_id, *p[:-1], hashlib.sha256(p[-1].encode()).hexdigest() if p[0] else "")
        for r, p in zip(rows, plain([r.text for r in rows], both), strict=True)
    ]
    got = queries.op13_alignment(spark, str(SF)).collect()
    found = [(r.doc_id, *[r[c] for c in NAMES[:-1]], r.groups_sha256) for r in got]
    assert sorted(found) == sorted(want)
