import random
import zlib

from corvane.llm import toxicity as X

WORDS = [a + b for a in "bcdfghklmnprst" for b in ("ander", "olik", "ime", "ustan", "egor", "apil")]
RUDE = ("grobblox", "snarfel", "vexwit", "durgle")


def texts(n, rude, seed):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        w = [rng.choice(WORDS) for _ in range(rng.randint(20, 120))]
        for _ in range(rng.randint(2, 5) if rude else 0):
            w[rng.randrange(len(w))] = rng.choice(RUDE)
        out.append(" ".join(w))
    return out


def test_held_out_accuracy(spark, make):
    rows = [(i, t) for i, t in enumerate(texts(300, False, 1) + texts(120, True, 2))]
    docs = make([*rows, (None, None), (9999, ""), (9998, "x" * 100_000), (3, rows[3][1])])
    labels = spark.createDataFrame([(i, int(i >= 300), 1) for i, _ in rows] + [(None, 1, 1), (5000, 1, 0), (7, None, 1)], "doc_id long, toxic int, quality int")
    out = X.score_toxicity(docs, X.train(docs, labels)).collect()
    assert len(out) == len(rows) + 4
    for r in out:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        assert r.held_out == (zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 5 == 0)
    held = [(r.predicted, int(r.doc_id >= 300)) for r in out if r.held_out and r.doc_id is not None and r.doc_id < 420]
    assert sum(p == y for p, y in held) / len(held) > 0.97
    assert all(r.predicted == 0 for r in out if r.doc_id in (None, 9999, 9998))


def test_gains_follow_the_dictionaries_when_words_are_swapped():
    """The same texts with other words in the rude ones' places: what is toxic follows from the labels alone."""
    swap = dict(zip(RUDE, ("blenting", "orsumak", "kwafelt", "dimporu")))
    plain, rude = texts(200, False, 5), texts(150, True, 6)
    swapped = [" ".join(swap.get(w, w) for w in t.split()) for t in rude]
    a, b = X.fit(rude[:120], plain[:160]), X.fit(swapped[:120], plain[:160])
    a.open()
    b.open()
    right = lambda m, mine, others: (sum(m.score(t) >= 0.5 for t in mine[120:]), sum(m.score(t) >= 0.5 for t in (*plain[160:], *others[120:])))
    for m, mine, others in ((a, rude, swapped), (b, swapped, rude)):
        caught, wrong = right(m, mine, others)
        assert caught >= 28 and wrong <= 4


def test_score_is_the_formula_over_compressed_lengths():
    import math

    import zstandard as zs

    model = X.fit(texts(90, True, 3), texts(120, False, 4))
    model.open()
    assert model.toxic and model.ordinary and model.weights[1:] != [0.0] * 4
    params = dict(compression_level=9, window_log=20, hash_log=17, chain_log=17, search_log=6, min_match=4, target_length=16, strategy=zs.STRATEGY_BTLAZY2, write_content_size=False, write_checksum=False, write_dict_id=False, format=zs.FORMAT_ZSTD1_MAGICLESS)

    def length(content, data):
        p = zs.ZstdCompressionParameters(**params)
        d = zs.ZstdCompressionDict(content, dict_type=zs.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(compression_params=p)
        return len(zs.ZstdCompressor(dict_data=d, compression_params=p).compress(data))

    gap = b" " * 9
    for text in (*texts(6, True, 9), *texts(4, False, 8), "", "a", "Vexwit, (DURGLE)! " * 5, "y" * 3000):
        ws = [w.strip(b".,;:!?\"'()[]|*%&$#@~_-") for w in text.encode().lower().split()]
        cut = lambda w: [w] if len(w) <= 512 else [w[k : k + 512] for k in range(0, len(w) - 256, 256)]
        wins = dict.fromkeys(c for i in range(0, len(ws), 4) for c in cut(b"   " + b"   ".join(ws[i : i + 4]) + b"   "))
        g = [length(model.ordinary + gap, w) - length(model.toxic + model.ordinary + gap, w) for w in wins]
        strong = sum(x >= 3 for x in g)
        x = (sum(g) / len(g), max(0, min(12, max(g))), math.log1p(strong), 10 * strong / len(g)) if g else (0, 0, 0, 0)
        z = model.weights[0] + sum(w * v for w, v in zip(model.weights[1:], x))
        assert abs(model.score(text) - 1 / (1 + math.exp(-max(-30, min(30, z))))) < 1e-9


def test_no_byte_of_a_text_is_left_out():
    rng = random.Random(1)
    for text in (*texts(5, True, 1), "z" * 5000, " ".join("q" * rng.randrange(1, 700) for _ in range(30))):
        assert {w for w in X.rendered(text) if len(w) < 200} <= {p for w in X.windows(text) for p in w.split()}
        for word in X.rendered(text):
            assert all(any(word[i : i + 6] in w for w in X.windows(text)) for i in range(max(1, len(word) - 5)))


def test_the_sample_is_bounded_in_rows_and_bytes(spark, make):
    rows = [(i, t) for i, t in enumerate(texts(40, False, 1) + texts(40, True, 2))]
    labels = spark.createDataFrame([(i, int(i >= 40)) for i, _ in rows], "doc_id long, toxic int")
    whole, few = X.train(make(rows), labels), X.train(make(rows), labels, sample=8)
    assert X.train(make(rows), labels, sample_bytes=400).toxic == b"" and len(few.ordinary) < len(whole.ordinary)


def test_labels_of_the_held_out_fold_are_not_read(spark, make):
    rows = [(i, t) for i, t in enumerate(texts(60, False, 1) + texts(60, True, 2))]
    fold = lambda i: zlib.crc32(str(i).encode()) % 5 == 0
    right = [(i, int(i >= 60)) for i, _ in rows]
    wrong = [(i, 1 - y if fold(i) else y) for i, y in right]
    a, b = (X.train(make(rows), spark.createDataFrame(x, "doc_id long, toxic int")) for x in (right, wrong))
    assert (a.toxic, a.ordinary, a.weights) == (b.toxic, b.ordinary, b.weights)


def test_nothing_to_learn_and_empty(spark, make):
    model = X.train(make([(1, "a b")]), spark.createDataFrame([], "doc_id long, toxic int"))
    assert [r.predicted for r in X.score_toxicity(make([(1, "a b"), (2, None)]), model).collect()] == [0, 0]
    assert X.score_toxicity(make([]), model).collect() == []
    assert X.drop_toxic(make([(1, "a b")]), model).columns == make([]).columns
