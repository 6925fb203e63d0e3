import hashlib
from collections import defaultdict

import pytest

from corvane.llm.exact_dedup import admits, bloom, drop_copies, exact_dedup


def brute(rows, pick):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    return sorted((i, pick(groups[t or ""]), len(groups[t or ""]), hashlib.sha256((t or "").encode()).hexdigest()) for i, t in rows)


@pytest.mark.parametrize("options", [{}, {"memtable_rows": 5}, {"memtable_bytes": 300, "shards": 3}, {"digest_bytes": 1, "memtable_rows": 7}, {"hit_bits": 1, "memtable_rows": 5}, {"memtable_rows": 2, "shards": 1}])
@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_equals_grouping_by_text(make, corpus, keep, options):
    out = exact_dedup(make(corpus), keep=keep, **options).collect()
    assert sorted((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in out) == brute(corpus, min if keep == "smallest" else max)
    assert all(r.kept == (r.doc_id == r.keep_id) for r in out)


@pytest.mark.parametrize("width", [32, 1])
def test_null_and_repeated_rows(make, width):
    out = exact_dedup(make([(None, "a"), (4, "a"), (4, "a"), (None, "b"), (None, None), (7, "")]), digest_bytes=width).collect()
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.kept) for r in out) == sorted(
        [("None", "4", 3, False), ("4", "4", 3, True), ("4", "4", 3, False), ("None", "None", 1, True), ("None", "7", 2, False), ("7", "7", 2, True)]
    )


def test_empty_table_and_unknown_order(make):
    assert exact_dedup(make([])).collect() == []
    with pytest.raises(ValueError):
        exact_dedup(make([]), keep="first")


def test_drop_copies_keeps_columns(make):
    docs = make([(1, "a"), (2, "a"), (3, "b"), (None, "c")])
    out = drop_copies(docs, keep="largest")
    assert out.columns == docs.columns
    assert sorted(str(r.doc_id) for r in out.collect()) == ["2", "3", "None"]


@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_identifiers_at_both_ends_of_their_range(make, keep):
    ends = [-(2**63), -(2**63) + 1, -1, 0, 2**63 - 2, 2**63 - 1]
    out = exact_dedup(make([(i, t) for i in ends for t in ("same", str(i))] + [(None, "same")]), keep=keep, memtable_rows=3).collect()
    best = min(ends) if keep == "smallest" else max(ends)
    assert all(r.keep_id == (best if r.group_size > 1 else r.doc_id) and r.kept == (r.doc_id == r.keep_id) for r in out)
    assert sum(r.kept for r in out) == len(ends) + 1


def test_a_memtable_holds_one_text_for_all_its_copies():
    import pyarrow as pa

    from corvane.llm import exact_dedup as module

    held = []

    def spy(entries, rows, run, shards):
        held.append((len(entries), len({id(r[3]) for r in rows}), len(rows)))
        yield from ()

    ctx = type("Context", (), {"get": staticmethod(lambda: type("C", (), {"partitionId": staticmethod(lambda: 0)}))})
    import pyspark

    old, pyspark.TaskContext, flush, module._flush = pyspark.TaskContext, ctx, module._flush, spy
    try:
        batch = pa.RecordBatch.from_arrays([pa.array([None] * 900, pa.int64()), pa.array(range(900)), pa.array(["x" * 1000] * 900)], names=["row", "doc_id", "text"])
        list(module._runs("smallest", 1, 32, 10_000, 1 << 16)([batch]))
    finally:
        pyspark.TaskContext, module._flush = old, flush
    assert held == [(1, 1, 900)]


def test_levels_merge_like_one_sort():
    import numpy as np

    from corvane.llm.exact_dedup import FAN_IN, Run, compact

    rng, want, runs = np.random.default_rng(4), {}, []
    for n in range(FAN_IN * FAN_IN + 3):
        keys = np.unique(rng.integers(0, 400, 30)).astype(np.uint64) << np.uint64(50)
        ranks = rng.integers(-5, 5, len(keys))
        nameless = rng.random(len(keys)) < 0.3
        runs.append(Run(keys[:, None], {"nameless": nameless, "rank": ranks, "n": np.full(len(keys), 2), "best_run": np.full(len(keys), n), "runs": np.ones(len(keys), int), "mixed": np.zeros(len(keys), bool)}))
        for k, r, e in zip(keys.tolist(), ranks.tolist(), nameless.tolist()):
            best, times = want.get(k, ((True, 9, 0), 0))
            want[k] = (min(best, (e, r, n)) if times else (e, r, n), times + 1)
    got = compact(runs)
    assert got.digests[:, 0].tolist() == sorted(want)
    for k, *v in zip(got.digests[:, 0].tolist(), *(got.values[x].tolist() for x in ("nameless", "rank", "best_run", "runs", "n"))):
        assert (tuple(v[:3]), v[3], v[4]) == (*want[k], 2 * want[k][1])


def test_rows_repeated_whole_or_without_identifier_are_copies(make):
    docs = make([(1, "a"), (1, "a"), (None, "c"), (None, "c"), (1, "b"), (2, None), (None, "")])
    for d in (docs, docs.withColumnRenamed("lang", "__row").withColumnRenamed("source", "row").withColumnRenamed("digest", "run")):
        out = drop_copies(d, keep="largest")
        assert out.columns == d.columns
        assert sorted((str(r.doc_id), str(r.text)) for r in out.collect()) == [("1", "a"), ("1", "b"), ("2", "None"), ("None", "c")]
    assert drop_copies(make([])).collect() == []


def test_filters_have_no_false_negatives():
    import numpy as np

    words, others = np.random.default_rng(1).integers(0, 2**63, (2, 500)).astype(np.uint64)
    bits = bloom(words, 1 << 13)
    assert admits(bits, words).all() and admits(bits, others).mean() < 0.05
