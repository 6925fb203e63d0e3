import re

import pytest

from corvane.llm import decontamination as D

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall((t or "").encode().lower())


def brute(docs, items, size=10):
    out = []
    for i, t in docs:
        w, hit, names = words(t), set(), set()
        for name, text in items:
            x = words(text)
            for win in [x[k : k + size] for k in range(max(1, len(x) - size + 1))] if x else []:
                for p in range(len(w) - len(win) + 1):
                    if w[p : p + len(win)] == win:
                        hit.update(range(p, p + len(win)))
                        names.add(str(name))
        out.append((i, len(w), len(hit), sorted(names)))
    return sorted(out)


@pytest.fixture
def items(corpus):
    texts = dict(corpus)
    inside = texts[100].split()
    return [(11, " ".join(inside[3:20])), (2, texts[12]), (30, " ".join(inside[5:15]).upper() + "!"), (4, "one"), (5, ""), (6, None), (7, "not to be found at all anywhere here in these texts"), (8, "one")]


@pytest.mark.parametrize("options", [{}, {"block_bytes": 60}])
def test_equals_brute_force(spark, make, corpus, items, options):
    tests = spark.createDataFrame(items, "item_id long, text string")
    out = D.find_test_text(make(corpus), tests, **options).collect()
    assert sorted((r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in out) == brute(corpus, items)
    assert all(sum(e - s for s, e in zip(r.starts, r.ends)) == r.n_hit for r in out)


def test_the_index_holds_every_term_and_serves_any_test(spark, corpus, items, make):
    from corvane.llm.common import Workspace, prepare

    index = D.build_index(make(corpus), Workspace(prepare(spark), "t"), block_words=50)
    assert index.count() > 20
    every = [w for _, t in corpus for w in words(t)]
    assert D.term_counts(index, {b"one", b"never", *every[:40]}) == {w: every.count(w) for w in {b"one", *every[:40]}}
    for r in index.collect():
        s = D.Segment(r.sizes, bytes(r.terms), r.counts, bytes(r.positions))
        assert len(s.positions) == sum(r.sizes) and sorted(s.positions) == list(range(sum(r.sizes)))
        assert all((x[1:] > x[:-1]).all() for x in (s.positions[e - n : e] for n, e in zip(s.counts, s.ends)))


def segment(texts):
    """A segment of documents given as lists of words."""
    import numpy as np

    flat = [w for t in texts for w in t]
    terms = [*dict.fromkeys(flat)]
    at = [i for t in terms for i, w in enumerate(flat) if w == t]
    return D.Segment([len(t) for t in texts], b" ".join(terms), [flat.count(t) for t in terms], np.array(at, np.uint32).tobytes())


@pytest.mark.parametrize("candidates", [1, 7, 1 << 21])
def test_phrases_against_scanning(monkeypatch, candidates):
    import random

    monkeypatch.setattr(D, "_CANDIDATES", candidates)
    rng = random.Random(candidates)
    for _ in range(40):
        texts = [[rng.choice([b"a", b"b", b"c", b"d"]) for _ in range(rng.randrange(0, 30))] for _ in range(5)]
        items = [(str(i), " ".join(rng.choice("abcde") for _ in range(rng.randrange(0, 7)))) for i in range(12)]
        s = segment(texts)
        flat = [w for t in texts for w in t]
        q = D.sought(items, 3, lambda terms: {t: flat.count(t) for t in terms if t in flat})
        got = set()
        for w, p in zip(*(x.tolist() for x in s.phrases(q))):
            got |= {(q.names[i], p) for i in q.item[q.first_item[w] : q.first_item[w + 1]]}
        want = set()
        for name, text in items:
            x = text.encode().split()
            for win in [x[k : k + 3] for k in range(max(1, len(x) - 2))] if x else []:
                for d, t in enumerate(texts):
                    want |= {(name, sum(map(len, texts[:d])) + p) for p in range(len(t) - len(win) + 1) if t[p : p + len(win)] == win}
        assert got == want


def test_proximity_against_scanning():
    import random
    from collections import Counter

    rng = random.Random(3)
    for _ in range(300):
        texts = [[rng.choice([b"a", b"b", b"c", b"x"]) for _ in range(rng.randrange(0, 14))] for _ in range(3)]
        terms, within, at, want = [rng.choice([b"a", b"b", b"c", b"q"]) for _ in range(rng.randrange(1, 4))], rng.randrange(1, 9), 0, set()
        for t in texts:
            spans = [(i, j) for i in range(len(t)) for j in range(i + 1, min(len(t), i + within) + 1) if not Counter(terms) - Counter(t[i:j])]
            want |= {(at + i, at + j) for i, j in spans if not any((x, y) != (i, j) and i <= x and y <= j for x, y in spans)}
            at += len(t)
        assert set(segment(texts).near(terms, within)) == want


def test_proximity_takes_any_order(spark, make):
    docs = make([(1, "alpha x beta y gamma"), (2, "gamma a a a beta a a a alpha"), (3, "alpha beta"), (4, "z alpha gamma beta z")])
    tests = spark.createDataFrame([(1, "alpha beta gamma")], "item_id long, text string")
    out = {r.doc_id: r.n_hit for r in D.find_test_text(docs, tests, window=3, within=5).collect()}
    assert out == {1: 5, 2: 0, 3: 0, 4: 3}


def test_empty_tables_null_ids_and_dropping(spark, make):
    none = spark.createDataFrame([], "item_id long, text string")
    assert D.find_test_text(make([]), none).collect() == []
    assert [r.n_hit for r in D.find_test_text(make([(None, "a b")]), none).collect()] == [0]
    tests = spark.createDataFrame([(None, "bad words")], "item_id long, text string")
    docs = make([(1, "some bad words"), (2, "fine"), (None, "bad words"), (1, "some bad words")])
    kept = D.drop_contaminated(docs, tests)
    assert kept.columns == docs.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["2"]
