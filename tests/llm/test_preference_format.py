from pyspark.sql import functions as F

from corvane.llm.preference_format import preference_pairs


def run(spark, rows):
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, prompt string, status long") if rows else spark.createDataFrame([], "conv_id long, turn long, role string, text string, prompt string, status long")
    return {r.pair_id: r for r in preference_pairs(turns, F.expr("conv_id div 2"), F.col("conv_id") % 2 == 0).collect()}


def turn(c, i, role, text):
    return (c, i, role, text, "clash", 1)


def shown(role, text):
    return f"<|{role}|>\n{text}<|end|>\n"


def test_prefix_spans_and_states(spark):
    rows = [turn(0, 0, "user", "hi"), turn(0, 1, "assistant", "good"), turn(1, 5, "user", "hi"), turn(1, 6, "assistant", "bäd"), turn(1, 7, "user", "why"), turn(1, 8, "assistant", "x")]
    rows += [turn(2, 0, "user", "a"), turn(3, 0, "user", "a")]
    rows += [turn(4, 0, "user", "only"), turn(7, 0, "user", "other")]
    out = run(spark, rows)
    r = out[0]
    assert (r.status, r.n_prefix, r.prompt) == ("pair", 1, shown("user", "hi"))
    assert r.chosen == shown("assistant", "good") and r.rejected == shown("assistant", "bäd") + shown("user", "why") + shown("assistant", "x")
    cut = lambda whole, spans: [whole[slice(*map(int, s.split(":")))] for s in spans.split(",")]
    assert cut(r.prompt + r.chosen, r.chosen_spans) == ["good"] and cut(r.prompt + r.rejected, r.rejected_spans) == ["bäd", "x"]
    assert (out[1].status, out[1].prompt, out[1].chosen, out[1].chosen_spans) == ("identical", shown("user", "a"), "", "")
    assert (out[2].status, out[2].n_prefix, out[2].chosen) == ("chosen_only", 0, shown("user", "only"))
    assert (out[3].status, out[3].prompt, out[3].rejected) == ("rejected_only", "", shown("user", "other"))


def test_nulls_ties_repeats_and_empty(spark):
    rows = [turn(0, 1, None, None), turn(0, 1, None, None), turn(0, None, "assistant", "first"), turn(1, None, "assistant", "first"), turn(None, 0, "user", "nowhere")]
    rows += [turn(2, 1, "user", "b"), turn(2, 1, "user", "a"), turn(2, 1, "assistant", "z"), turn(3, 1, "user", "a")]
    out = run(spark, rows)
    assert set(out) == {0, 1}
    assert (out[0].n_prefix, out[0].n_chosen, out[0].chosen) == (1, 3, shown("", "") * 2)
    assert out[1].chosen == shown("assistant", "z") + shown("user", "a") + shown("user", "b")
    assert run(spark, []) == {}


def test_long_text_and_plan_without_python(spark):
    rows = [turn(0, i, "user", "x" * 20_000) for i in range(50)] + [turn(1, 0, "user", "y")]
    assert len(run(spark, rows)[0].chosen) == 50 * (20_000 + 17)
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, prompt string, status long")
    plan = preference_pairs(turns, F.expr("conv_id div 2"), F.col("conv_id") % 2 == 0)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_columns_with_names_used_inside(spark):
    rows = [(0, 1, "user", "hi", "x", 1, "y", 2), (0, 2, "assistant", "yes " * 5000, "x", 1, "y", 2), (1, 1, "user", "hi", "x", 1, "y", 2), (1, 2, "assistant", None, "x", 1, "y", 2)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, c string, r int, t string, pair_id int")
    out = preference_pairs(df, F.expr("conv_id div 2"), F.col("conv_id") % 2 == 0).collect()
    assert [(r.pair_id, r.n_prefix, r.status, len(r.chosen)) for r in out] == [(0, 1, "pair", len("<|assistant|>\n<|end|>\n") + 20_000)]
