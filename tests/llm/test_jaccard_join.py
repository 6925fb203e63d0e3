import random
from collections import Counter, defaultdict
from itertools import combinations

import pytest

from corvane.llm import jaccard_join as J
from corvane.llm.common import Workspace, prepare
from corvane.llm.components import components


def brute(rows):
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()})
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(range(len(rows)), 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= 80 * len(x | y):
            parent[max(find(a), find(b))] = min(find(a), find(b))
    least = defaultdict(list)
    for k, (i, _) in enumerate(rows):
        least[find(k)] += [] if i is None else [i]
    return Counter((i, len(s), min(least[find(k)], default=None)) for k, ((i, _), s) in enumerate(zip(rows, sets)))


def told(df):
    return Counter((r.doc_id, r.n_shingles, r.component_id) for r in df.collect())


def test_equals_brute_force(make, corpus):
    rows = [*corpus, (None, dict(corpus)[3]), (3, dict(corpus)[3]), (None, "alone in the world of words")]
    assert told(J.near_duplicates(make(rows))) == brute(rows)


@pytest.mark.parametrize("boundary", [0, 8, 24])
def test_chains_and_edges_at_every_boundary(make, monkeypatch, boundary):
    rng = random.Random(boundary)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for size in (5, 6, 8, 9, 10, 12, 14, 20, 22, 40, 70):
        base = rng.sample(words, size + 4)
        for step in range(9):
            w = base[: size + 4 - step % 3]
            for _ in range(rng.randint(0, 2)):
                w[rng.choice([0, 1, -1, len(w) // 2])] = rng.choice(words)
            rows.append((len(rows) * 7 % 101 + 1000 * (len(rows) // 101), " ".join(w)))
    monkeypatch.setattr(J, "light_boundary", lambda sizes, length: boundary)
    assert told(J.near_duplicates(make(rows))) == brute(rows)


@pytest.mark.parametrize("entries, hot", [(3, 1000), (2048, 10**9), (2, 10**9)])
def test_blocks_and_hot_keys_do_not_change_results(make, monkeypatch, corpus, entries, hot):
    """Long lists cut into blocks of a few entries, and every key treated as hot."""
    from corvane.llm import components as C

    rng = random.Random(entries)
    line, rows = [f"l{i}" for i in range(40)], [*corpus]
    for i in range(60):  # one line with different ends: one list, many components
        rows.append((500 + i, " ".join(line + [f"e{rng.randrange(12)}" for _ in range(rng.randrange(2, 12))])))
    monkeypatch.setattr(J, "_LIST_ENTRIES", entries)
    monkeypatch.setattr(J, "HOT_KEYS", hot)
    monkeypatch.setattr(C, "HOT_KEYS", hot)
    assert told(J.near_duplicates(make(rows))) == brute(rows)


def test_the_last_light_size_follows_the_lists():
    for length in (1.0, 30.0, 1e4, 1e9):
        m = J.last_size(length)
        assert all(J.light_cost(k) > J.heavy_cost(k, length) for k in range(m, m + 60))


def test_the_boundary_follows_the_cost():
    assert J.light_boundary({5: 1000, 6: 1000}, 30.0) >= 6
    assert J.light_boundary({20: 1000}, 1.0) < 20
    assert J.needed(9, 9) == 8 and J.needed(5, 6) == 5 and list(J.partners(5)) == [4, 5, 6] and J.prefix_length(10) == 3


def test_components_of_long_chains(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 102), (101, 102), (7, 7)]
    out = components(spark.createDataFrame(edges, "a long, b long"), Workspace(prepare(spark), "t"))
    assert {r.node: r.component for r in out.collect()} == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 102: 100}


def test_empty_and_keeping(make):
    assert J.near_duplicates(make([])).collect() == []
    docs = make([(5, "a b c d e f"), (2, "A b c d e f"), (9, "z"), (None, "a b c d e f"), (None, None)])
    kept = J.keep_one_of_each(docs)
    assert kept.columns == docs.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["2", "9", "None"]


def brute_links(rows):
    """(doc_id, the number of other rows that link, rows of the same class) of every row."""
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()})
    links = [0] * len(rows)
    for a, b in combinations(range(len(rows)), 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= 80 * len(x | y):
            links[a] += 1
            links[b] += 1
    alike = [1 if not x else sum(x == y for y in sets) for x in sets]
    return Counter((i, n, same) for (i, _), n, same in zip(rows, links, alike))


@pytest.mark.parametrize("block", [(1024, 1 << 19), (5, 1 << 19), (1024, 300)])
def test_links_are_counted_whole(make, monkeypatch, corpus, block):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(300)]
    base, texts = [rng.choice(words) for _ in range(60)], []
    for i in range(70):  # near copies of one text, of many sizes, of which neighbours link and far ones do not
        w = base[: 40 + i % 21]
        w[rng.choice([0, -1, 20])] = rng.choice(words)
        texts.append(" ".join(w))
    rows = [*corpus, *((1000 + i, t) for i, t in enumerate(texts + texts[:9] + texts[:2]))]
    for name, value in zip(("_BLOCK_SETS", "_BLOCK_KEYS"), block):
        monkeypatch.setattr(J, name, value)
    out = J.near_duplicates(make(rows)).collect()
    same = Counter(r.class_id for r in out)
    assert Counter((r.doc_id, r.n_links, same[r.class_id]) for r in out) == brute_links(rows)
    assert max(r.n_links for r in out) > 30
