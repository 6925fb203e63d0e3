import random
import re
from collections import Counter

import numpy as np
import pytest

from corvane.llm import collocations
from corvane.llm.collocations import Trie


def brute(rows, least=30, most=2000, covered=80):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang, text = "und" if lang is None else lang, re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, *w[i : i + m]) for m in range(1, 5) for i in range(len(w) - m + 1))
    f = Counter({k: v for k, v in f.items() if v >= least})
    longer = Counter()
    for (lang, *w), v in f.items():
        for m in range(2, len(w)):
            for i in range(len(w) - m + 1):
                longer[(lang, *w[i : i + m])] = max(longer[(lang, *w[i : i + m])], v)
    out = {}
    for (lang, *w), a in f.items():
        if len(w) > 1 and 100 * longer[(lang, *w)] < covered * a:
            score, _, k = min((2_000_000 * a // (f[(lang, *w[:k])] + f[(lang, *w[k:])]), k, k) for k in range(1, len(w)))
            out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), f[(lang, *w[:k])], f[(lang, *w[k:])]))
    return sorted((lang, r, p.decode(), -a, left, right, n[lang], -s) for lang, found in out.items() for r, (s, a, p, left, right) in enumerate(sorted(found)[:most], 1))


def found(spark, rows, parts=5, **options):
    df = spark.createDataFrame([(lang, text, 1, "x", 2) for lang, text in rows], "lang string, text string, phrase int, f string, n long").repartition(parts)
    return sorted(map(tuple, collocations.mine_collocations(df, **options).collect()))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    words = "The a OF old Red fox é\xa0x 漢字 \x00z ab abc b 'tis -".split(" ") + ["fox", "a", "a"]
    text = lambda n: "".join(rng.choice(words) + rng.choice((" ", " ", " ", "\t ", ", ", ".", "\n", " \r\n", ";", "\x0b")) for _ in range(n))
    out = [(rng.choice(("en", "en", "en", "de", None, "", "zz")), text(rng.randint(0, 60))) for _ in range(500)]
    out += [("en", "new york city hall. " * 40), ("en", "same line " * 300), ("en", None), (None, ""), ("de", text(8000))] + [("en", "the old red fox")] * 50
    return out


def test_as_brute_force(spark, rows):
    assert len(brute(rows)) > 40 and found(spark, rows) == brute(rows)


@pytest.mark.parametrize(("sampled", "samples", "shard"), [(1, 1, 200), (40, 2, 1000), (7, 3, 1 << 20)])
def test_any_bounds_and_shards_give_the_same(spark, rows, monkeypatch, sampled, samples, shard):
    """Nodes that reach over bounds, down to a path a range, are put together again."""
    some = rows[:150] + rows[-55:]
    for name, value in (("SAMPLED", sampled), ("SAMPLES", samples), ("SHARD_BYTES", shard)):
        monkeypatch.setattr(collocations, name, value)
    assert found(spark, some if sampled > 1 else some[-60:] + some[:12], least=5) == brute(some if sampled > 1 else some[-60:] + some[:12], least=5)


def test_options_and_empty_tables(spark, rows):
    assert found(spark, rows, least=10, most=7, covered=50) == brute(rows, 10, 7, 50)
    assert found(spark, []) == [] == found(spark, [("en", "once only"), (None, None)])


def test_tries_keep_their_order_and_come_back():
    rng = random.Random(3)
    texts = [" ".join(rng.choice(("b", "a", "ab", "é", "z" * 70000, "\x00")) for _ in range(20)).encode() for _ in range(30)]
    trie, n = Trie.of_texts(texts)
    assert n == 600 and trie.counts.sum() == 600
    paths = [trie.path(i) for i in range(len(trie.counts))]
    assert paths == sorted(paths) and len({*map(tuple, paths)}) == len(paths)
    again = Trie.unpacked(trie.packed())
    assert [again.path(i) for i in range(len(paths))] == paths and np.array_equal(again.counts, trie.counts)
    for bound in [*paths[::7], [b"a"], [b"aa", b"b"], [b"zz"], [b"\x00", b"\xff"], []]:
        assert trie.place(bound) == sum(p < bound for p in paths)
    cut = len(paths) // 2
    whole = Trie.merged([trie.part(cut, len(paths)), trie.part(0, cut), trie])
    assert [whole.path(i) for i in range(len(paths))] == paths and np.array_equal(whole.counts, 2 * trie.counts)
