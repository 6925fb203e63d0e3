import corpus_pipeline as P
from corvane.llm import queries, toxicity


def test_each_stage_against_brute_force(spark, sf_dir):
    docs = queries.table(spark, sf_dir, "documents")
    model = toxicity.train(docs, queries.table(spark, sf_dir, "labels"))
    model.open()
    rows = {r.doc_id: r.text for r in docs.collect()}
    want = {i: t for i, t in rows.items() if model.score(t) < 0.5}
    newest = {}
    for i, t in sorted(want.items()):
        newest[t] = i
    want = {i: t for i, t in want.items() if newest[t] == i}
    from test_decontamination import brute as passages
    from test_jaccard_join import brute as near

    want = {i: want[i] for i, _, c in near([*want.items()]) if i == c}
    items = [(r.item_id, r.text) for r in queries.table(spark, sf_dir, "benchmark").collect()]
    clean = {i for i, _, hit, _ in passages([*want.items()], items) if not hit}
    out = P.run(spark, sf_dir)
    got = out.collect()
    assert {r.doc_id for r in got} == clean and all(r.text == rows[r.doc_id] and r.round_trip for r in got)
    assert out.columns[: len(docs.columns)] == docs.columns
    assert [n for n, _ in P.STAGES] == ["toxicity", "exact", "near", "benchmark", "tokens"]


def test_each_stage_on_awkward_rows(spark, make, tmp_path):
    """Nulls, repeated rows, shared and absent ids, empty tables and columns with names used inside, in all tables."""
    long = " ".join(f"w{i}" for i in range(3000))
    test = "the quick brown fox jumps over the lazy dog and runs away"
    rows = [(1, "a b"), (1, "a b"), (None, "c d"), (None, "c d"), (None, None), (2, ""), (3, long), (4, long + " end"), (None, long + " ending"), (None, f"so {test} today"), (5, f"so {test} now"), (5, "fine"), (6, "fine again")]
    for tables in ([(7, test), (None, None), (7, "")], []):
        spark.createDataFrame([(i, t, 1, "x", 2) for i, t in tables], "item_id long, text string, doc_id long, item string, n_hit long").write.parquet(f"{tmp_path}/{len(tables)}/benchmark.parquet")
        spark.createDataFrame([(1, 1, 0, "x"), (None, 1, 1, "x"), (3, None, None, "x")] if tables else [], "doc_id long, quality int, toxic int, text string").write.parquet(f"{tmp_path}/{len(tables)}/labels.parquet")
    of = dict(P.STAGES)
    for docs in (make(rows), make(rows).withColumnRenamed("lang", "__row").withColumnRenamed("source", "rid").withColumnRenamed("n", "n_hit")):
        at = lambda name, tables=3: of[name](spark, docs, f"{tmp_path}/{tables}")
        text = lambda out: sorted((str(r.doc_id), (r.text or "-")[-6:]) for r in out.collect())
        every = text(docs)
        assert text(at("toxicity")) == every == text(at("toxicity", 0)) == text(at("benchmark", 0))
        assert text(at("exact")) == sorted({("1", "a b"), ("None", "c d"), *(e for e in every if e[1] not in ("a b", "c d", "-"))} | {("2", "-")})
        near = text(at("near"))
        assert near == sorted([("1", "a b"), ("None", "c d"), ("None", "-"), ("2", "-"), ("3", " w2999"), ("5", "ay now"), ("5", "fine"), ("6", " again")])
        assert text(at("benchmark")) == [e for e in every if not e[1].endswith(("today", "y now"))] and len(at("benchmark").collect()) == len(rows) - 2
        assert [at(n).columns for n, _ in P.STAGES[:-1]] == [docs.columns] * 4
        coded = at("tokens").collect()
        assert len(coded) == len(rows) and all(r.round_trip for r in coded)
        for name, _ in P.STAGES:
            assert of[name](spark, docs.limit(0), f"{tmp_path}/3").collect() == []


def test_queries_have_the_contracts_columns(spark, sf_dir):
    import __spark_entry__ as entry

    wanted = {
        "op1": "doc_id keep_id group_size kept text_sha256", "op2": "doc_id held_out n_tokens n_known train_tokens base_score score", "op3": "doc_id n_words n_hit n_items items_sha256 contaminated",
        "op4": "page_id host path rule verdict", "op6": "doc_id n_tokens ids_sha256 decoded_sha256", "op7": "doc_id n_assign n_access n_hex base_sha256 spans", "op8": "doc_id held_out score predicted",
        "op9": "doc_id n_bytes n_removed n_spans kept_sha256", "op10": "doc_id n_shingles component_id",
        "op11": "anchor_id positive_id rank negative_id positive_score negative_score", "op12": "lang rank phrase a l r n score", "op13": "doc_id piece start length ids_crc32 sequence_id offset",
    }
    names = {n.split("_")[0]: n for n in entry.queries() if n.startswith("op")}
    assert sorted(names, key=lambda n: int(n[2:])) == [f"op{i}" for i in range(1, 14)] and "pipeline" in entry.queries()
    for op, columns in wanted.items():
        if op in ("op4", "op6", "op7"):  # the lazy ones; the others' columns are in their own tests
            assert entry.queries()[names[op]](spark, sf_dir).columns == columns.split()


def test_new_queries_have_the_contracts_types(spark, sf_dir):
    import __spark_entry__ as entry

    kinds = {"op11_hard_negatives": {"rank": "int"}, "op12_collocations": {"lang": "string", "phrase": "string"}, "op13_best_fit_packing": {"piece": "int"}}
    for name, other in kinds.items():
        out = entry.queries()[name](spark, sf_dir)
        assert all(kind == other.get(c, "bigint") for c, kind in out.dtypes), out.dtypes
