"""The training-data operators against brute force, on small tables with every awkward row."""

import hashlib
import math
import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from moodline.llm import bpe, exact_dedup, html, langid, lm, mixing, ngram_join, pii, topk, toxicity
from moodline.llm.common import fold, fold_of, words

SCHEMA = "doc_id long, text string, lang string, source string, rid long, row string, sha string, n long, id long"
LONG = "ab cd ef " * 20_000


def awkward(spark, rows):
    """doc_id, text, lang, source with columns whose names operators use inside."""
    return spark.createDataFrame([(*r, 1, "x", "y", 2, 3) for r in rows], SCHEMA)


ROWS = [
    (1, None, "en", "a"),
    (2, "", None, "b"),
    (3, " \t ", "en", None),
    (4, "one two three four five six", "en", "a"),
    (4, "one two three four five six", "en", "a"),
    (5, "ONE two  three\nfour five six", "en", "b"),
    (6, "one two three\x0bfour five six", "en", "b"),
    (7, LONG, "en", "a"),
    (8, LONG, "fr", "a"),
    (9, "tiny", None, "a"),
    (None, "no id", "en", "a"),
    (11, "é\x1f\x85 　x 🎉", "fr", "a"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return awkward(spark, ROWS)


@pytest.fixture(scope="module")
def empty(spark):
    return awkward(spark, [])


def test_exact_dedup(docs):
    got = exact_dedup.mark_copies(docs).collect()
    want = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t, *_ in ROWS]
    sha = [hashlib.sha256(t.encode()).hexdigest() for t in want]
    assert Counter(r.text_sha256 for r in got) == Counter(sha)
    of = {}
    for (i, *_), s in zip(ROWS, sha, strict=True):
        of.setdefault(s, []).append(i)
    for r in got:
        ids = [i for i in of[r.text_sha256] if i is not None]
        assert r.group_size == len(of[r.text_sha256])
        assert r.keep_id == (min(ids) if ids else None)
    # one row of each text, also where ids repeat
    assert Counter(r.text_sha256 for r in got if r.kept) == Counter(set(sha))
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns and kept.count() == len(of)


def test_filter_is_bounded_and_false_hits_are_harmless(docs, monkeypatch):
    assert exact_dedup._filter_words(10**12) == exact_dedup.MAX_WORDS
    monkeypatch.setattr(exact_dedup, "_filter_words", lambda rows: 1)
    assert sum(r.kept for r in exact_dedup.mark_copies(docs).collect()) == 8


def shingle_sets(texts):
    out = []
    for t in texts:
        w = words(t)
        out.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    return out


def linked(a, b):
    both = len(a & b)
    return both > 0 and 100 * both >= 80 * len(a | b)


def brute_components(ids, sets):
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if linked(sets[i], sets[j]):
                root[find(i)] = find(j)
    groups = {}
    for i in range(len(ids)):
        groups.setdefault(find(i), []).append(ids[i])
    least = {g: min((v for v in vs if v is not None), default=None) for g, vs in groups.items()}
    return [least[find(i)] for i in range(len(ids))]


def test_ngram_join(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "FREQUENT", 2)  # combinations on small groups
    monkeypatch.setattr(ngram_join, "PAIRS_PER_ENTRY", 1)
    rnd = random.Random(5)
    rows = list(ROWS)
    passage = [f"p{k}" for k in range(60)]
    for family in range(6):
        text = [f"w{rnd.randrange(400)}" for _ in range(rnd.choice([12, 30, 90, 200]))]
        for _ in range(9):
            copy = list(text)
            for _ in range(rnd.randrange(4)):
                copy[rnd.randrange(len(copy))] = f"x{rnd.randrange(9)}"
            if family % 2:
                copy = copy[: rnd.randrange(len(copy))] + passage + copy[: len(copy) // 3]
            rows.append((1000 - len(rows), " ".join(copy), "en", "a"))
    docs = awkward(spark, rows)
    got = {}
    for r in ngram_join.near_copies(docs).collect():
        got.setdefault((r.doc_id, r.n_shingles, r.component_id), 0)
        got[r.doc_id, r.n_shingles, r.component_id] += 1
    sets = shingle_sets([t for _, t, *_ in rows])
    ids = [i for i, *_ in rows]
    want = Counter((i, len(s), c) for i, s, c in zip(ids, sets, brute_components(ids, sets), strict=True))
    assert got == want
    kept = ngram_join.drop_near_copies(docs)
    assert kept.columns == docs.columns
    comps = Counter(c for i, s, c in zip(ids, sets, brute_components(ids, sets), strict=True) if s)
    assert kept.count() == len(comps) + sum(not s for s in sets)


def test_ngram_join_lists_what_a_hub_does_not_link_anew(spark, monkeypatch):
    """Copies around the least similarity: few link with the hub, yet pairs don't grow with the square of their number."""
    rnd = random.Random(7)
    text = [f"w{k}" for k in range(60)]
    rows = []
    for k in range(200):
        copy = list(text)
        for _ in range(rnd.randrange(1, 4)):
            copy[rnd.randrange(len(copy))] = f"x{rnd.randrange(12)}" if k % 4 == 0 else f"y{k}"
        rows.append((1000 - k, " ".join(copy[: 60 - k % 3]), "en", "a"))
    sizes = []
    stage = ngram_join.stage

    def counted(df, name):
        out = stage(df, name)
        if name == "join-candidates":
            sizes.append(out.count())
        return out

    monkeypatch.setattr(ngram_join, "stage", counted)
    got = {r.doc_id: r.component_id for r in ngram_join.near_copies(awkward(spark, rows)).collect()}
    ids, sets = [i for i, *_ in rows], shingle_sets([t for _, t, *_ in rows])
    want = dict(zip(ids, brute_components(ids, sets), strict=True))
    assert got == want
    assert len(set(want.values())) > 20
    assert sum(sizes) < 10 * len(rows), sizes


def test_linking_sets_share_an_index_key(monkeypatch):
    monkeypatch.setattr(ngram_join, "FREQUENT", 3)
    rng = np.random.default_rng(2)
    for size in (1, 4, 6, 14, 15, 16, 17, 19, 21, 40, 63, 66, 150, 400):
        for _ in range(6):
            base = np.unique(rng.integers(-(2**62), 2**62, size))
            sets = []
            for _ in range(12):
                keep = base[rng.random(len(base)) > rng.choice([0.0, 0.05, 0.1])]
                sets.append(np.unique(np.r_[keep, rng.integers(-(2**62), 2**62, rng.integers(0, 1 + len(base) // 9))]))
            token, df = np.unique(np.concatenate(sets), return_counts=True)
            common = {t: d for t, d in zip(token.tolist(), df.tolist(), strict=True) if d > 1}
            keys = []
            for s in sets:
                own = [t for t in s.tolist() if t in common]
                found = np.array([common[t] for t in own], np.int64), np.array(own, np.int64)
                keys.append(set(ngram_join.keys_of(len(s), *found).tolist()) if len(s) else set())
            for i in range(len(sets)):
                for j in range(i):
                    if len(sets[i]) and len(sets[j]) and ngram_join.links(sets[i], sets[j]):
                        assert keys[i] & keys[j], (size, i, j)


def test_components(spark):
    rnd = random.Random(1)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(220)] + [(k, k + 1) for k in range(400, 440)]
    got = {r.rid: r.comp for r in ngram_join.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {x: x for e in edges for x in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(root[a], root[b])
            changed |= root[a] != low or root[b] != low
            root[a] = root[b] = low
    assert got == root


def test_bpe_equals_the_library(docs):
    tokenizers = pytest.importorskip("tokenizers")
    files = pytest.importorskip("public_tokenizers")
    path = files.path("byte_bpe_50k.json")
    library = tokenizers.Tokenizer.from_file(path)
    vocab = bpe.Vocabulary.read(path)
    rnd = random.Random(7)
    texts = [t or "" for _, t, *_ in ROWS] + ["<|endoftext|>a <|endoftext|><|endoftext|>", "aaaa" * 50, "it's we'LL  \n\n x", "   "]
    texts += ["".join(chr(c) for c in (rnd.randrange(0x3000) for _ in range(120)) if not 0xD800 <= c < 0xE000) for _ in range(60)]
    splitter = bpe.Splitter(vocab)
    ids = bpe.encode_texts([splitter.split(t) for t in texts], splitter.numbers, vocab)
    for text, own in zip(texts, ids, strict=True):
        want = library.encode(text, add_special_tokens=False).ids
        assert own.tolist() == want
        assert bpe.decode(own, np.array(vocab.tokens, object)) == library.decode(want, skip_special_tokens=False)
    rows = bpe.tokenize(docs, path, keep=["doc_id", "n"], indexed_chars=10).collect()
    for r in rows:
        text = next((t or "") for i, t, *_ in ROWS if i == r.doc_id)
        assert np.frombuffer(r.ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
        assert r.decoded == text and r.n_tokens * 4 == len(r.ids) and r.n == 2


def test_bpe_memory_is_bounded_by_slices_of_words():
    files = pytest.importorskip("public_tokenizers")
    vocab = bpe.Vocabulary.read(files.path("byte_bpe_50k.json"))
    rnd = random.Random(3)
    numbers: dict[str, int] = {}
    while len(numbers) < 100_000:
        numbers.setdefault(" " + "".join(rnd.choices("etaoinshrdlu", k=rnd.randint(3, 14))), len(numbers))
    text = np.arange(len(numbers), dtype=np.int32)
    tracemalloc.start()
    got = next(iter(bpe.encode_texts([text], numbers, vocab)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    whole, _ = bpe.encode_words([w.encode() for w in numbers], vocab)
    assert np.array_equal(got, whole)
    assert peak < 30e6
    assert bpe.decode(got, np.array(vocab.tokens, object)) == "".join(numbers)


def test_mixing_meets_targets(spark):
    rnd = random.Random(4)
    rows = [(k, "w " * rnd.randrange(60), "en", rnd.choice(["hot"] * 6 + ["b", "c", None])) for k in range(3000)]
    docs = awkward(spark, rows + [(3001, None, "en", "only"), (None, "a b", "en", "b")])
    got = mixing.mix(docs).toPandas()
    again = mixing.mix(docs).toPandas()
    order = ["doc_id", "size"]
    assert got.sort_values(order)["taken"].tolist() == again.sort_values(order)["taken"].tolist()
    assert (got["taken"] <= 2 * got["size"]).all() and len(got) == 3002
    assert math.isclose(got.groupby("target")["target"].first().sum(), 1.5 * got["size"].sum(), rel_tol=1e-9)
    for target, own in got.groupby("target"):
        assert own["taken"].sum() == pytest.approx(target, abs=max(2, 0.003 * target))
        assert target <= 2 * own["source_size"].iloc[0] + 1e-6
    taken = mixing.take(docs)
    assert taken.columns == docs.columns and taken.count() == got["times"].sum()


@pytest.mark.parametrize("step", ["near", "exact", "mix"])
def test_row_numbers_hold_when_cores_change_between_passes(spark, tmp_path, monkeypatch, step):
    """Each pass over a table is planned for the cores of its moment."""
    module, between, run = {
        "near": (ngram_join, "_sharing", ngram_join.drop_near_copies),
        "exact": (exact_dedup, "_groups", exact_dedup.drop_copies),
        "mix": (mixing, "targets", mixing.take),
    }[step]
    rnd = random.Random(8)
    texts = [" ".join(f"w{rnd.randrange(5000)}" for _ in range(rnd.randrange(20, 60))) for _ in range(150)]
    awkward(spark, [(k, texts[k % 150], "en", "ab"[k % 2]) for k in range(300)]).repartition(8).write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    cores, cost = "spark.sql.leafNodeDefaultParallelism", "spark.sql.files.openCostInBytes"
    monkeypatch.setattr(module, between, (lambda f: lambda *a: (spark.conf.set(cores, "1"), f(*a))[1])(getattr(module, between)))
    try:
        spark.conf.set(cost, "1")
        if step == "mix":
            want = Counter({(r.doc_id): r.times for r in mixing.mix(docs).collect() if r.times})
        spark.conf.set(cores, "8")
        got = Counter(r.doc_id for r in run(docs).collect())
    finally:
        spark.conf.unset(cores)
        spark.conf.unset(cost)
    if step == "mix":
        taken = {k: sum(len(texts[i % 150].split()) * n for i, n in x.items() if i % 2 == k) for x in (got,) for k in (0, 1)}
        due = {k: sum(len(texts[i % 150].split()) * n for i, n in want.items() if i % 2 == k) for k in (0, 1)}
        assert all(abs(taken[k] - due[k]) < 5 for k in (0, 1))
    elif step == "exact":
        assert got == Counter(range(150))
    else:
        assert sorted(k % 150 for k in got.elements()) == list(range(150))


def test_flight_keeps_both_totals():
    rng = np.random.default_rng(0)
    p, size = rng.random(500), rng.integers(1, 400, 500)
    flown, left = mixing.fly(p, size)
    assert len(left) <= 2
    assert flown.sum() == pytest.approx(p.sum()) and (flown * size).sum() == pytest.approx((p * size).sum())


def test_toxicity(spark, empty):
    rnd = random.Random(9)
    plain = [f"word{k}" for k in range(80)]
    rows, labels = [], []
    for k in range(300):
        bad = k % 5 == 0
        text = [rnd.choice(plain) for _ in range(30)] + ([rnd.choice(["Nasty,", "vile"])] if bad else [])
        rnd.shuffle(text)
        rows.append((k, " ".join(text), "en", "a"))
        if k < 200:
            labels.append((k, 1, int(bad)))
    labels += [(5000, 1, 1), (None, 1, 1), (3, None, None)]
    docs = awkward(spark, rows + [(900, None, "en", "a"), (901, "", "en", "a"), (902, LONG + " vile", "en", "a")])
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    chain = toxicity.fit(docs, marks, toxicity.label_categories(marks), "toxic")
    assert {"nasty", "vile"} <= set(chain.markers)
    got = {r.doc_id: r.toxic for r in toxicity.score(docs, chain).collect()}
    assert all(got[k] == (k % 5 == 0) for k in range(300)) and not got[900] and not got[901] and got[902]
    clean = toxicity.keep_clean(docs, chain)
    assert clean.columns == docs.columns and clean.count() == 242
    none = toxicity.fit(docs, marks.limit(0), toxicity.label_categories(marks), "toxic")
    assert toxicity.keep_clean(docs, none).count() == docs.count()
    assert toxicity.score(empty, chain).count() == 0


def test_language_model_counts(docs, empty):
    got = lm.score(docs, fold_of("doc_id", 7) != 2).collect()
    c = Counter()
    for i, t, *_ in ROWS:
        if fold(i, 7) != 2:
            c.update([*words(t), b""])
    total, base = sum(c.values()), math.log10(sum(c.values()) + len(c) + 1)
    want = Counter()
    for i, t, *_ in ROWS:
        own = [*words(t), b""]
        score = sum(math.log10(c[w] + 1) for w in own) - len(own) * base
        want[i, len(own), sum(c[w] > 0 for w in own), round(score, 4)] += 1
    assert Counter((r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 4)) for r in got) == want
    assert all(r.train_tokens == total and math.isfinite(r.score) for r in got)
    assert lm.score(empty, fold_of("doc_id", 7) != 2).count() == 0
    assert all(r.train_tokens == 0 for r in lm.score(docs, F.lit(False)).collect())


def test_language_model_rare_tokens_are_joined(docs, monkeypatch):
    whole = {(r.doc_id, r.n_tokens): (r.n_known, r.base_score) for r in lm.score(docs, F.lit(True)).collect()}
    monkeypatch.setattr(lm, "TABLE", 3)
    for r in lm.score(docs, F.lit(True)).collect():
        known, base = whole[r.doc_id, r.n_tokens]
        assert r.n_known == known and r.base_score == pytest.approx(base)


def test_language_model_is_a_distribution():
    model = lm.Model(np.random.default_rng(0).normal(size=lm.ROWS[0] * lm.CLASSES + lm.ROWS[1] * lm.WIDTH).astype(np.float32))
    total = 0.0
    for last in range(lm.OUTSIDE * lm.WIDTH + 1):
        total += 10 ** (model.log10(np.array([5, 7, last])) - model.log10(np.array([5, 7])))
    assert total == pytest.approx(1, abs=1e-3)


def test_language_model_learns_every_position(docs):
    text = F.col("text").cast("string")
    table = lm.counts_of(docs, text).toPandas()
    lexicon = lm.Lexicon.of([bytes(t) for t in table["token"]], table["c"].to_numpy())
    context = docs.sparkSession.sparkContext
    texts = lm.numbered_texts(docs, F.lit(True), "doc_id", text, context.broadcast(lexicon), None).drop("id")
    tree = lm.Tree(len(table) + 1)
    moved = lm.updates(texts, context.broadcast(np.zeros((tree.nodes, lm.WIDTH), np.float32)), tree, 1000)
    root = [np.frombuffer(r.seen)[0] for r in moved.filter("block = 0").collect()]
    assert sum(root) == table["c"].sum()


def test_language_model_tree_covers_the_vocabulary():
    for leaves in (1, 31, 993, 40_000):
        tree = lm.Tree(leaves)
        start = tree.initial(np.array([0, leaves]), np.array([0.0, leaves]))
        model = lm.Model.of(tree, start, np.zeros((1, lm.WIDTH), np.float16))
        numbers = np.arange(leaves)
        assert np.allclose(model.logs(numbers, np.zeros((3, leaves), np.uint64)), -math.log(leaves), atol=1e-4)
        assert len(set(zip(*(x.tolist() for x in tree.paths(numbers)), strict=True))) >= leaves
    assert lm.Model.rows_for(lm.Tree(10**7)) > 20 * lm.Model.rows_for(lm.Tree(1000))


def test_language_model_averages_by_touch():
    def part(k, rows, seen, value):
        data = np.full((len(rows), lm.WIDTH), value, np.float16)
        return {"block": 0, "part": k, "rows": np.array(rows, np.uint16).tobytes(), "seen": np.array(seen, float).tobytes(), "data": data.tobytes()}

    got = lm.averaged(pd.DataFrame([part(0, [1, 5], [30, 4], 1.0), part(1, [1], [10], 2.0)])).iloc[0]
    data = np.frombuffer(got["data"], np.float16).reshape(-1, lm.WIDTH)
    assert np.frombuffer(got["rows"], np.uint16).tolist() == [1, 5] and data[:, 0].tolist() == [1.25, 1.0]


def test_lm_update_is_that_of_a_plain_loop():
    rng = np.random.default_rng(5)
    tree = lm.Tree(3000)
    start = rng.normal(size=(tree.nodes, lm.WIDTH)).astype(np.float32)
    numbers = np.minimum(rng.zipf(1.2, 700), 2999)
    features = lm.contexts(numbers, [0, 300])
    trainer = lm.Trainer(tree, start, 997)  # keys occur once, twice and often
    trainer.update(numbers, features)
    model = lm.Model.of(tree, start, np.zeros((997, lm.WIDTH), np.float32))
    at, node, branch = tree.paths(numbers)
    z, rows = model.sums(features[:, at], node)
    z = z.astype(np.float64)
    z = np.exp(z - z.max(axis=1, keepdims=True))
    z /= z.sum(axis=1, keepdims=True)
    z[np.arange(len(z)), branch] -= 1
    keys = ((trainer.model.constants, start, node[None]), (trainer.model.hashed, model.hashed, rows))
    met = set()
    for which, (table, old, flat) in enumerate(keys):
        total, times = np.zeros(table.shape), np.zeros(len(table), np.int64)
        for r in flat:
            np.add.at(total, r, z)
            np.add.at(times, r, 1)
        squares = 1 + (total**2).mean(axis=1)
        assert np.array_equal(trainer.touched[which], times)
        met |= set(times.tolist())
        np.testing.assert_allclose(trainer.squares[which], squares, rtol=1e-4)
        np.testing.assert_allclose(table, old - lm.STEP * total / np.sqrt(squares)[:, None], atol=2e-5)
    assert max(met) >= lm.OFTEN and {1, 2, 3} <= met


def test_lm_softmax_of_any_size():
    z = np.array([[0, -np.inf], [200, 100], [-300, -301], [1, 2]], np.float32)
    e, total, top = lm.exponents(z)
    want = np.exp(z - z.max(axis=1, keepdims=True))
    np.testing.assert_allclose(e / total[:, None], want / want.sum(axis=1, keepdims=True), rtol=1e-6)
    assert lm.exponents(z[[0, 3]])[2] == 0.0 and np.array_equal(top, z.max(axis=1))


def test_language_model_beats_the_base_score_on_rare_tokens(spark):
    """Beyond the most frequent tokens, too, what follows what is learned."""
    rnd = random.Random(6)
    rows = []
    for k in range(1500):
        pairs = [rnd.randrange(1500) for _ in range(20)]
        rows.append((k, " ".join(f"a{p} b{p}" for p in pairs), "en", "a"))
    scores = lm.score(awkward(spark, rows).repartition(8), fold_of("doc_id", 7) != 2).toPandas()
    held_out = scores[[fold(int(i), 7) == 2 for i in scores["doc_id"]]]
    assert (held_out["score"] - held_out["base_score"]).sum() > 0.2 * held_out["n_tokens"].sum()


def test_lm_numbers_are_packed_and_texts_split_as_words():
    numbers = np.array([0, -1, 1, 16383, 16384, -16384, -16385, 2**29 - 1, -(2**29), 5, -70000])
    assert np.array_equal(lm.unpacked(lm.packed(numbers)), numbers) and lm.packed(np.arange(16384)).nbytes == 2 * 16384
    rnd = random.Random(2)
    alphabet = [chr(k) for k in range(256)] + list("\u2028\u3000\u0130\ud7ff \t\n") * 5
    texts = ["".join(rnd.choice(alphabet) for _ in range(40)) for _ in range(500)] + [None, "", " ", " A  b ", LONG]
    found, of = lm.split_texts(pa.array(texts, pa.string()))
    got = [[] for _ in texts]
    for token, k in zip(found.to_pylist(), of.tolist(), strict=True):
        got[k].append(token)
    assert got == [words(t) for t in texts]


def test_lm_frequent_tokens_pass_few_softmaxes():
    tree = lm.Tree(1_000_000)
    at, _, _ = tree.paths(np.array([500, 5_000, 100_000, 900_000]))
    assert np.bincount(at).tolist() == [2, 3, 4, 5]
    assert len(lm.Tree(40_000_000).paths(np.array([39_999_999]))[0]) == 8  # beyond the first root


def test_lm_ranked_tokens_are_numbered_by_count(spark):
    rows = [(f"t{k}".encode(), 1 + k % 4) for k in range(400)]
    counts = lm.ranked(spark.createDataFrame(rows, "token binary, c long").repartition(5))
    got = lm._others(lm.stage(counts, "test-counts"), 4, 100).toPandas().sort_values("number")
    assert got["number"].tolist() == list(range(100, 400))
    of = {t: c for t, c in rows}
    assert [of[bytes(t)] for t in got["rare"]] == sorted((c for c in of.values() if c < 4), reverse=True)


def test_language_model_parcels(docs, monkeypatch):
    """Rare tokens find their numbers, and texts their ids, however many texts share a row."""
    whole = {(r.doc_id, r.n_tokens): (r.n_known, r.base_score) for r in lm.score(docs, F.lit(True)).collect()}
    monkeypatch.setattr(lm, "TABLE", 3)
    monkeypatch.setattr(lm, "PARCEL", 40)
    monkeypatch.setattr(lm, "PARCELS", 2)
    got = lm.score(docs, F.lit(True)).collect()
    assert len(got) == docs.count()
    for r in got:
        known, base = whole[r.doc_id, r.n_tokens]
        assert r.n_known == known and r.base_score == pytest.approx(base) and math.isfinite(r.score)


def luhn(digits):
    return sum((int(d) * 2 - 9 * (d > "4")) if k % 2 else int(d) for k, d in enumerate(reversed(digits))) % 10 == 0


RULES = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda v: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda v: all(int(x) <= 255 for x in v.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda v: 16 <= len(d := re.sub("[^0-9]", "", v)) <= 19 and luhn(d)),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda v: 8 <= len(re.sub("[^0-9]", "", v)) <= 15),
}


def test_pii_base_spans(spark, empty):
    rnd = random.Random(3)
    parts = ["a@b.c", "@", "x.y", "1.2.3.4", ".5", "+1 ", "(017) 555-7713", "4952935900253052", "4111111111111111"]
    parts += [" ", "-", "é", "🎉", "a_", "foo (at) bar (dot) com", "12", "\n", "0256.1.1.1"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randrange(1, 25))) for _ in range(250)]
    texts += [None, "", "a" * 30_000, "1" * 30_000, "9 " * 3000, "+1" + " 2" * 3000, "a@b." * 600]
    docs = awkward(spark, [(k, t, "en", "a") for k, t in enumerate(texts)])
    for r in pii.digest(pii.find(docs)).collect():
        found = {k: [f"{k}:{m.start()}:{m.end()}" for m in re.finditer(p, texts[r.doc_id] or "") if ok(m.group())] for k, (p, ok) in RULES.items()}
        flat = [s for k in RULES for s in found[k]]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [len(found[k]) for k in RULES]
        assert r.base_sha256 == hashlib.sha256(",".join(flat).encode()).hexdigest()
        spans = r.spans.split(",") if r.spans else []
        assert set(flat) <= set(spans) and len(set(spans)) == len(spans)
        ends = sorted((int(a), int(b)) for s in set(spans) - set(flat) for _, a, b in [s.split(":")])
        assert all(x[1] <= y[0] for x, y in zip(ends, ends[1:], strict=False))
    assert pii.digest(pii.find(empty)).count() == 0


def test_pii_selects_what_looks_like_base_spans(spark):
    rows = [(k, f"my card {4111111111111111 if k % 2 else 4111111111111112} thanks", "en", "a") for k in range(40)]
    got = pii.digest(pii.find(awkward(spark, rows + [(99, "nothing here but 12 words", "en", "a")]))).collect()
    assert all(r.spans == ("" if r.doc_id == 99 else "card:8:24") for r in got)


def test_pii_running_starts(spark):
    sizes = [(k * 7) % 13 for k in range(1500)]
    got = spark.createDataFrame([(sizes,)], "v array<int>").select(pii.running_starts(F.col("v")).alias("s")).first().s
    assert got == [sum(sizes[:k]) for k in range(1500)]


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var a = "</p><p>no";</script></head><body>
<div class="cookie-notice"><p>We use cookies here and there and everywhere</p></div>
<nav><ul><li><a href="/">Home</a></li></ul></nav><!-- no --><div class="sidebar">Side words beside the text</div>
<{0}><h1>Title &amp; more</h1><p><b>First&nbsp;paragraph.<br><p>Second   one
with <a href="x">a link</a> inside.</p><div class="ad">Buy now, buy here</div><p>Last &lt;one&gt;.</p></{0}>
<section class="comments"><article><p>I say so too, and so do many other people here</p></article></section>
<form><label>Your mail</label></form><footer>&copy; all rights</footer></body></html>"""


@pytest.mark.parametrize("element", ["article", "div"])
def test_html_main_text(element):
    want = "Title & more\nFirst paragraph.\nSecond one with a link inside.\nLast <one>."
    assert html.main_text(PAGE.replace("{0}", element), html.DEFAULTS) == want


@pytest.mark.parametrize("name", ["ad-container", "ad-wrapper", "sidebar-content", "newsletter-body", "text ad"])
def test_html_boilerplate_names_win(name):
    page = PAGE.replace("{0}", "article")
    assert html.main_text(page.replace('class="ad"', f'class="{name}"'), html.DEFAULTS) == html.main_text(page, html.DEFAULTS)
    state = page.replace("<article><h1>", '<article class="content has-sidebar"><h1>')
    assert html.main_text(state, html.DEFAULTS) == html.main_text(page, html.DEFAULTS)


def test_html_edges(spark):
    pages = spark.createDataFrame(
        [(1, "u", None, "x"), (2, None, "", "x"), (2, None, "", "x"), (3, "u", "<p>only", "x"), (4, "u", "<" * 5000, "x"),
         (5, "u", "<div>" * 3000 + "deep words" + "</div>" * 3000, "x"), (None, "u", PAGE.replace("{0}", "article"), "x")],
        "page_id long, url string, html string, text string",
    )
    rows = html.extract(pages, html.fit(pages)).collect()
    assert Counter((r.page_id, r.n_chars) for r in rows)[2, 0] == 2
    assert {r.page_id: r.text for r in rows}[3] == "only"
    assert all(r.n_chars == len(r.text) for r in rows)
    assert html.fit(pages.limit(0)) == html.DEFAULTS


def test_best_region():
    rnd = random.Random(0)
    for _ in range(200):
        s = [rnd.choice([-3, -1, 0, 1, 2]) for _ in range(rnd.randrange(12))]
        a, b = html.best_region(s)
        sums = [sum(s[i:j]) for i in range(len(s)) for j in range(i + 1, len(s) + 1)]
        assert sum(s[a:b]) == max([0, *sums])


def test_topk(spark):
    rng = np.random.default_rng(1)
    rows = [(k, [float(x) for x in rng.normal(size=8) / 3]) for k in range(400)]
    rows += [(1000 + k, rows[50][1]) for k in range(9)]  # ties
    rows += [(450, rows[3][1]), (450, rows[3][1]), (None, rows[2][1]), (500, None), (550, [1.0, None]), (600, [float("nan")] * 8),
             (650, []), (700, [1.0, 2.0]), (701, [0.5, -2.0]), (750, [float("inf")] * 8)]
    vectors = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<float>, v int, score string")
    whole = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows
             if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    want = Counter()
    for q, v in {i: v for i, v in whole if i % 50 == 0}.items():
        best = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in whole if i != q and len(w) == len(v))[:5]
        want.update((q, rank, i, -s) for rank, (s, i) in enumerate(best, 1))
    for sizes in ({}, {"candidates": 64, "queries": 3}):
        got = topk.search(vectors, F.col("vec_id") % 50 == 0, 5, **sizes).collect()
        assert Counter((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == want
    assert topk.search(vectors.limit(0), F.lit(True), 5).count() == 0


def test_topk_of_huge_components(spark):
    rows = [(0, [1e17, 1.0]), (1, [1e17, 2.0]), (2, [-1e17, 1.0])]
    got = topk.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") == 0, 5).collect()
    assert [(r.vec_id, r.score) for r in got] == [(1, 2**63 - 1), (2, -(2**63))]


def test_language_id(spark, docs, empty):
    rnd = random.Random(2)
    letters = {"aa": "abcdefgh", "bb": "hijklmno", "cc": "стуфхцч"}
    rows = []
    for k in range(300):
        lang = rnd.choice(sorted(letters))
        rows.append((k, " ".join("".join(rnd.choice(letters[lang]) for _ in range(5)) for _ in range(12)), lang, "a"))
    table = awkward(spark, rows + [(900, None, "aa", "a"), (901, "123 !?", "bb", "a"), (902, LONG, None, "a")])
    model = langid.fit(table, fold_of("doc_id", 5) != 0)
    got = {r.doc_id: r for r in langid.predict(table, model).collect()}
    held_out = [(got[k].lang_pred, lang) for k, _, lang, _ in rows if fold(k, 5) == 0]
    assert len(held_out) > 30 and all(a == b for a, b in held_out)
    assert got[900].lang_pred == got[901].lang_pred == "und" and got[902].lang_pred in letters
    assert all(0 <= r.score <= 1 for r in got.values())
    assert langid.predict(empty, model).count() == 0
    nothing = langid.fit(empty, F.lit(True))
    assert {r.lang_pred for r in langid.predict(docs, nothing).collect()} == {"und"}


def test_html_of_broken_markup_takes_linear_time():
    import time

    for part in ("<a ", "<script ", '<a "', "</b>", "<div></p>", "<!", "< "):
        start = time.perf_counter()
        html.main_text("<div>" * 2000 + part * (10**6 // len(part)), html.DEFAULTS)
        assert time.perf_counter() - start < 20, part


def test_html_article_element_decides_nothing():
    body = "<p>" + "real words of the story, many of them. " * 9 + "</p>"
    menu = "<ul class='menu'><li><a href=x>home</a><li><a href=y>news</a></ul>"
    with_element, without = (
        html.main_text(f"<body>{menu}<{e}><h1>Title</h1>{body}</{e}><footer>end</footer></body>", html.DEFAULTS)
        for e in ("article", "div")
    )
    assert with_element == without and "real words" in without and "home" not in without
