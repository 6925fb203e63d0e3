import random

from pyspark.sql import functions as F

from corvane.functions import cleaning
from corvane.functions import text as T


def both(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").repartition(4)
    rows = df.select("i", "t", T.full_text_cleaning(F.col("t")).alias("a"), T.chain_of_columns(F.col("t")).alias("b")).collect()
    return [r for r in rows if r.a != r.b], rows


def test_one_pass_agrees_with_the_chain_on_every_code_point(spark):
    """Each code point between letters, after a line end, beside spaces and at both ends of a text of some hundred."""
    points = [chr(i) for i in range(0x110000) if not 0xD800 <= i < 0xE000]
    texts = []
    for low in range(0, len(points), 200):
        some = points[low : low + 200]
        texts.append("the beginning " + "".join(f"a{p}b \n{p} c{p} {p}\n" for p in some))
        texts.append(f"{some[0]} {some[-1]}the middle of it{some[1 % len(some)]}{some[0]}")
    texts += [f"{p}the rest of the text{p}" for p in points if p.isspace() or not p.isprintable() and ord(p) < 0x3000]
    wrong, rows = both(spark, texts)
    assert not wrong, [(ascii(r.t), ascii(r.a), ascii(r.b)) for r in wrong[:3]]
    assert sum(r.a is not None for r in rows) > 10000


def test_random_texts_with_urls_html_and_few_stop_words(spark):
    rng = random.Random(4)
    parts = [" ", "\n", "\t", "\r", "\f", "\x0b", " ", " ", "　", "\x00", "\x85", "​", "http://", "https://x.y/z", "www.", "www.a", "whttp://", "HTTP://a", "<p>", "</div>", "<table", "&amp;", "cafÃ©", "the", "zq", "漢", "é", "ﬁ", "<", "a>b"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    texts += [" ".join(rng.choice(("zq", "xv", "qq")) for _ in range(n)) + tail for n in (49, 50, 51, 99, 100, 101, 150) for tail in ("", " the", "\nthe")]
    texts += [None, "", " ", "\n　", "short the text", "www.http://abc the end of it all", "x" * 300_000 + " the"]
    wrong, _ = both(spark, texts)
    assert not wrong, [(ascii(r.t), ascii(r.a), ascii(r.b)) for r in wrong[:3]]


def test_texts_of_a_batch_do_not_touch(spark):
    runs = cleaning.class_runs((T.CONTROL, T.INVALID))
    texts = ["a ", " b", "", "\n", " \n c\n \n", "d\n", "e  \t f", " g\n h   i"]
    assert cleaning.transduced(texts, runs) == ["a", "b", "", "", "c", "d", "e f", "g\nh   i"] == [cleaning.transduced([t], runs)[0] for t in texts]
