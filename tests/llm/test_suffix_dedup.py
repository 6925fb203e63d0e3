import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from corvane.llm import suffix_dedup as S


def brute(rows, size=200):
    texts = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(b[k : k + size] for _, b in texts for k in range(len(b) - size + 1))
    out = []
    for i, b in texts:
        gone = bytearray(len(b))
        for k in range(len(b) - size + 1):
            if seen[b[k : k + size]] > 1:
                gone[k : k + size] = b"\1" * size
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((str(i), len(b), hashlib.sha256(kept).hexdigest(), sum(g and (j == 0 or not gone[j - 1]) for j, g in enumerate(gone))))
    return sorted(out)


def told(out):
    return sorted((str(r.doc_id), r.n_bytes, hashlib.sha256(bytes(r.kept)).hexdigest(), len(r.starts)) for r in out)


@pytest.fixture(scope="module")
def hard():
    rng = random.Random(8)
    rand = lambda n, letters="abcdefgh é": "".join(rng.choice(letters) for _ in range(n))
    p = [rand(n) for n in (199, 200, 201, 230, 900)]
    rows = [rand(300) + x + rand(50) for x in p for _ in range(2)]
    rows += ["ab" * 400, "a" * 199, "a" * 200, "a" * 201, "a" * 1500, p[4][:250], p[4][100:420] + rand(9), p[4][-210:] + p[4][:210], rand(250) * 3]
    rows += [None, "", "x", p[1], p[4], p[4]]
    rows += [p[4][: k] + rand(40) + p[4][k:] for k in (150, 199, 200, 201, 450, 700)]
    return [(i, t) for i, t in enumerate(rows)] + [(None, p[4]), (3, rows[3])]


def test_equals_brute_force(make, hard):
    assert told(S.remove_repeats(make(hard)).collect()) == brute(hard)


def test_on_the_common_corpus(make, corpus):
    assert told(S.remove_repeats(make(corpus, parts=5)).collect()) == brute(corpus)
    assert S.remove_repeats(make([])).collect() == []


@pytest.mark.parametrize("length", [255, 256, 257, 511, 512, 513, 1023, 1025, 4095, 4097, 65535, 65537])
def test_anchors_depend_on_the_window_alone(length):
    """The same passage in texts whose lengths lie on both sides of a power of two."""
    rng = random.Random(length)
    passage = rng.randbytes(230)
    alone = S.stretches(passage)
    text = rng.randbytes(length // 2)[: max(0, length - 230)] + passage
    text += rng.randbytes(max(0, length - len(text)))
    at, (first, n, gram) = text.index(passage), S.stretches(text)
    anchor = {int(f) + k: int(g) for f, c, g in zip(first, n, gram) for k in range(c)}
    assert [anchor[at + int(f) + k] for f, c in zip(*alone[:2]) for k in range(c)] == [int(g) for _, c, g in zip(*alone) for _ in range(c)]


@pytest.mark.parametrize("piece", [1, 64, 300, 1000])
def test_pieces_do_not_change_stretches(piece):
    rng = random.Random(piece)
    for text in (rng.randbytes(2500), b"ab" * 700, b"a" * 900, rng.randbytes(70) * 20, rng.randbytes(200)):
        for x, y in zip(S.stretches(text, piece), S.stretches(text)):
            assert x.tolist() == y.tolist()


def test_passages_in_texts_of_many_lengths(make):
    rng = random.Random(6)
    rand = lambda n: "".join(rng.choice("abcdefgh é") for _ in range(n))
    passage = rand(260)
    rows = [(i, rand(n // 3) + passage[rng.randrange(40) :] + rand(n)) for i, n in enumerate([0, 1, 30, 120, 250, 260, 500, 510, 1000, 1040, 2000, 4100, 9000])]
    assert told(S.remove_repeats(make(rows, parts=4), run_bytes=1500).collect()) == brute(rows)


def test_family_counts_and_levels():
    rng, family, every, first, numbers = np.random.default_rng(0), S.Family(), Counter(), {}, []
    for batch in range(40):
        high = rng.integers(0, 60, 30).astype(np.uint64)
        low = rng.integers(0, 3, 30).astype(np.uint64)
        h, w, n, _, _ = S._distinct(high, low)
        numbers.append(([*zip(h.tolist(), w.tolist())], family.insert(h, w, n, batch)))
        every.update(zip(high.tolist(), low.tolist()))
        for key in zip(high.tolist(), low.tolist()):
            first.setdefault(key, batch)
        sizes = [len(level[0]) for level in family.levels]
        assert sizes == sorted(set(sizes), reverse=True) and sum(sizes) == len(every)
    for keys, number in numbers:
        assert family.totals[number].tolist() == [every[k] for k in keys] and family.first[number].tolist() == [first[k] for k in keys]


def test_digests_that_agree_in_their_first_half():
    family = S.Family()
    low = np.arange(0, 50, 2).astype(np.uint64)
    same = np.full(25, 7, np.uint64)
    a, b = family.insert(same, low, np.ones(25, int), 0), family.insert(same, low + np.uint64(1), np.ones(25, int), 1)
    assert len({*a.tolist(), *b.tolist()}) == 50 and family.insert(same, low, np.ones(25, int), 2).tolist() == a.tolist()
