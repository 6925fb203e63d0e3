import unicodedata

import pytest
from pyspark.sql import functions as F

from corvane.functions import text as T
from corvane.operators.chunking import PARENT_BREAKS, split_sentences


def column(spark, f, values):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [r[0] for r in rows.orderBy("i").select(f(F.col("t"))).collect()]


def test_urls_controls_and_spaces(spark):
    assert column(spark, T.remove_urls, ["see https://a.b/c?d e www.x.org/y z", None]) == ["see  e  z", None]
    assert column(spark, T.remove_control_chars, ["a\x00b\tc\nd\x7f"]) == ["ab\tc\nd"]
    assert column(spark, T.clean_whitespace, ["a \t b\n\n\n  c\r\nd", "x\n y"]) == ["a b\nc \nd", "x\ny"]


def test_valid_unicode_in_both_readings(spark):
    assert column(spark, T.keep_valid_unicode, ["a​b\tc\nd x&]y"]) == ["ab\tc\nd x&]y"]
    assert column(spark, lambda c: T.keep_valid_unicode(c, compat=True), ["a​b", "x&]y", "a[]b"]) == ["a​b", "xy", "ab"]


def test_language_and_cleaning(spark):
    assert column(spark, T.detect_language, ["plain", "ééééé", "", None, "abcdé", "abcd中"]) == ["en", "other", "other", "other", "other", "other"]
    junk = " ".join(f"q{i}x" for i in range(60))
    long = "The  ﬁrst sentence is here.\n\n\nAnd <p>more</p> https://x.y"
    got = column(spark, T.full_text_cleaning, [None, "  ", "short", junk, junk + " the", long])
    assert got[:4] == [None] * 4 and got[4] == junk + " the" and got[5].startswith("The first sentence is here.\nAnd") and "http" not in got[5]


def test_html(spark):
    page = "<html><head><style>p{}</style><script>var a='</p>';</script></head><body><DIV>one<br>two &amp; three</DIV><p>four</p></body></html>"
    (got,) = column(spark, T.html_to_text, [page])
    assert "var" not in got and "p{}" not in got and [w for w in got.split("\n") if w.strip()] == ["one", "two & three", "four"]
    assert column(spark, T.html_to_text, ["a <b>c</b>", None]) == ["a <b>c</b>", None]
    assert column(spark, T.strip_tags, ["<p>a</p><i>b</i>", "<i>b</i>"]) == ["\na\n b ", "<i>b</i>"]


@pytest.mark.parametrize("title,good", [("X5", True), ("x", False), ("file_12 report", False), ("doc-3", False), ("id_9", False), ("id_9b", True), ("untitled 2", False), ("2024-01-02", False), ("12345", False), ("____", False), ("", False), (None, False), ("a" * 201, False), ("名前", True), ("  AB  ", True)])
def test_titles(spark, title, good):
    assert column(spark, T.is_good_title, [title]) == [good]


def test_title_forms(spark):
    assert column(spark, T.clean_title, [" - A  b http://x.y report.PDF", "www.site.org", "x.txt"]) == ["A b report", "www.site.org", "x"]
    words = " ".join(f"w{i}" for i in range(20))
    assert column(spark, T.title_words, [words, "12345"]) == [[f"w{i}" for i in range(16)], None]


def test_sentences_agree_with_the_scan(spark):
    texts = ["A b. C d! ", "...lead. x", ". . .", "no end", "", "  ", "a.\n\nb?  \n c;d。e", "x\r\ny.", "  . a"]
    got = column(spark, T.sentences, texts)
    for t, s in zip(texts, got):
        assert [(x["text"], x["start"], x["end"]) for x in s] == split_sentences(t, PARENT_BREAKS), t
        assert all(t[x["start"] : x["end"]].strip() == x["text"] for x in s)


def test_breaks(spark):
    t = "ab. cd! ef"
    df = spark.createDataFrame([(t,)], "t string")
    at = lambda f, a, b: df.select(f(F.col("t"), F.lit(a), F.lit(b))).first()[0]
    assert (at(T.first_break, 0, 10), at(T.first_break, 3, 6), at(T.last_break, 0, 10), at(T.last_break, 3, 6)) == (3, 6, 7, 3)


def test_small_ones(spark):
    assert column(spark, T.preview, ["a" * 501, "b"]) == ["a" * 500 + "...", "b"]
    assert spark.range(1).select(T.hms(F.lit(3725.9))).first()[0] == "01:02:05"
    assert column(spark, T.normalize_unicode, ["ﬁ①", None]) == [unicodedata.normalize("NFKC", "ﬁ①"), None]
    assert column(spark, T.count_tokens, ["a" * 9, ""]) == [2, 0]


def test_repair_of_misread_words():
    from corvane.functions import text as T

    for word in ("café", "naïve", "“quoted”", "Zürich", "señor—sí"):
        for misread in ("cp1252", "latin-1"):
            try:
                bad = word.encode().decode(misread)
            except UnicodeDecodeError:
                continue
            assert T.repaired(f"a {bad} b") == f"a {word} b"
            assert T.repaired(bad.encode().decode("latin-1")) == word or misread == "cp1252"
    for fine in ("plain", "café Ångström", "Ã", "日本語", "Â", "10 €", "Málaga, São Paulo"):
        assert T.repaired(fine) == fine


def test_cleaning_is_planned_once(spark):
    """One Arrow evaluation, with the filter on the result's length; as a chain of columns one chain of replacements beside it."""
    from pyspark.sql import functions as F

    from corvane.functions import text as T

    df = spark.createDataFrame([("x" * 200 + " the http://a.b c",), ("short",), (None,), ("  ",), ("<p>" + "the cell " * 40 + "</p><script>x</script>",)], "t string")
    out = df.select(F.explode(T.cleaned_at_least(F.col("t"), 100)).alias("t")).withColumn("n", F.length("t"))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("https?://") == 0 and plan.count("ArrowEvalPython") == 1
    plan = df.select(F.explode(T.cleaned_at_least(F.col("t"), 100, compat=True)).alias("t"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("https?://") == 1 and plan.count("ArrowEvalPython") == 1
    assert sorted(r.n for r in out.collect()) == sorted(len(t) for t in ("x" * 200 + " the c", "the cell " * 39 + "the cell"))
