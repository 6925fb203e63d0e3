import json
import random

import pytest

from corvane.sources import byte_ranges, readers, split_json


@pytest.fixture
def small_ranges(spark):
    names = "spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"
    before = [spark.conf.get(n) for n in names]

    def set_to(n):
        for name in names:
            spark.conf.set(name, str(n))

    yield set_to
    for name, value in zip(names, before):
        spark.conf.set(name, value)


def value_of(rng, depth=0):
    """Values full of the signs that part members, in strings and outside."""
    kind = rng.randint(0, 6 if depth < 3 else 3)
    if kind <= 2:
        return "".join(rng.choice(('"', "\\", "\\\\", ",", "[", "]", "{", "}", "\n", "é", "漢", "a", ": ", '\\"')) for _ in range(rng.randint(0, 12)))
    if kind == 3:
        return rng.choice((1, 2.5, True, False, -3))
    if kind <= 5:
        return {f'k{i},"]': value_of(rng, depth + 1) for i in range(rng.randint(0, 3))}
    return [value_of(rng, depth + 1) for _ in range(rng.randint(0, 3))]


@pytest.mark.parametrize("size", [23, 150, 1 << 20])
def test_members_of_ranges_of_any_size(spark, tmp_path, small_ranges, size):
    rng = random.Random(size)
    items = [value_of(rng) for _ in range(40 if size < 64 else 200)]
    keyed = {f'id,{i}"[': v for i, v in enumerate(items)}
    (tmp_path / "l.json").write_text(json.dumps(items, indent=rng.choice((None, 1)), ensure_ascii=False))
    (tmp_path / "o.json").write_text("﻿ \n" + json.dumps(keyed, ensure_ascii=size > 64))
    small_ranges(size)
    if size < 1 << 20:
        assert byte_ranges.parts_of(spark, str(tmp_path / "l.json"), ",").rdd.getNumPartitions() >= 8
    rows = sorted(split_json.members(spark, str(tmp_path / "l.json")).collect(), key=lambda r: (r.block, r.number))
    assert [json.loads(r.value) for r in rows] == items and all(r.key is None for r in rows)
    assert [r.plain for r in rows] == [v if isinstance(v, str) else None for v in items]
    assert {r.key: json.loads(r.value) for r in split_json.members(spark, str(tmp_path / "o.json")).collect()} == keyed


def test_small_files(spark, tmp_path, small_ranges):
    for i, (text, want) in enumerate([("[]", []), ("{}", []), ("", []), (" [ ] \n", []), ("[1]", ["1"]), ('["a"]\n', ['"a"']), ('{"a": [1, 2]}', ["[1, 2]"]), ("[[1, 2], [3]]", ["[1, 2]", "[3]"]), ("[null, 1, null]", ["1"])]):
        (tmp_path / f"{i}.json").write_text(text)
        for size in (3, 1 << 20):
            small_ranges(size)
            assert sorted(r.value for r in split_json.members(spark, str(tmp_path / f"{i}.json")).collect()) == want, text


def test_documents_and_id_maps_in_parts(spark, tmp_path, small_ranges):
    rows = [{"id": i, "text": f"text, {i} " + "x" * (i % 40), "title": "t" if i % 2 else None} for i in range(300)]
    (tmp_path / "l.json").write_text(json.dumps(rows))
    (tmp_path / "one.json").write_text(json.dumps({"doc_id": "z", "content": "a, b"}))
    (tmp_path / "ids.json").write_text(json.dumps([f"c{i}" for i in range(500)]))
    (tmp_path / "map.json").write_text(json.dumps({str(i): f"c{i}" for i in range(500)}))
    small_ranges(600)
    want = sorted((str(r["id"]), r["title"] or "", r["text"]) for r in rows)
    assert sorted(map(tuple, readers.read_documents(spark, str(tmp_path / "l.json")).collect())) == want
    assert readers.read_documents(spark, str(tmp_path / "one.json")).collect() == [("z", "", "a, b")]
    for name in ("ids", "map"):
        assert sorted(map(tuple, readers.read_id_map(spark, str(tmp_path / f"{name}.json")).collect())) == [(i, f"c{i}") for i in range(500)]
