import hashlib
from collections import Counter

import pytest

from corvane.operators import sampling


def table(spark, rows):
    return spark.createDataFrame(rows, "id long, label string, other int").repartition(5)


def order(i):
    return hashlib.md5(f"42:{i}".encode()).hexdigest(), i


@pytest.fixture(params=[(4,), (4, 4), (1, 1, 1)])
def digits(request, monkeypatch):
    monkeypatch.setattr(sampling, "DIGITS", request.param)


def test_the_first_in_hash_order(spark, digits):
    rows = [(i, "abc"[i % 7 % 3] if i % 11 else None, i) for i in range(700)]
    for n in (1, 13, 350, 699):
        out = sampling.stratified_split(table(spark, rows), "label", "id", n).collect()
        assert len(out) == 700 and sum(r.part == "sample" for r in out) == n
        for label in ("a", "b", "c", None):
            mine = sorted((r.id for r in out if r.label == label), key=order)
            chosen = {r.id for r in out if r.label == label and r.part == "sample"}
            assert chosen == set(mine[: len(chosen)]) and abs(len(chosen) - n * len(mine) / 700) < 1
    assert sorted(r.id for r in sampling.sample_rows(table(spark, rows), "id", 20).collect()) == sorted(sorted(range(700), key=order)[:20])


def test_repeated_keys_and_few_rows(spark):
    rows = [(i // 40, "x", i) for i in range(200)]  # forty rows a key
    out = sampling.stratified_split(table(spark, rows), "label", "id", 99).collect()
    assert Counter(r.part for r in out) == {"sample": 99, "rest": 101} and len({r.other for r in out}) == 200
    assert sorted(Counter(r.id for r in out if r.part == "sample").values()) == [19, 40, 40]
    assert sampling.sample_rows(table(spark, rows), "id", 500).count() == 200 and sampling.sample_rows(table(spark, rows), "id", 0).count() == 0
    assert sampling.sample_rows(table(spark, []), "id", 5).count() == 0
    with pytest.raises(ValueError):
        sampling.stratified_split(table(spark, rows), "label", "id", 200)


def test_no_sort_of_the_table(spark):
    rows = [(i, "ab"[i % 2], i) for i in range(100)]
    plan = sampling.stratified_split(table(spark, rows), "label", "id", 10)._jdf.queryExecution().optimizedPlan().toString()
    assert "Sort" not in plan and plan.count("Window") == 1 and plan.count("Repartition") == 2  # the table's own, in both branches
