import csv
import io
import random

import pytest

from corvane.sources import byte_ranges, readers, split_csv


@pytest.fixture
def small_ranges(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")

    def set_to(n):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(n))
        spark.conf.set("spark.sql.files.openCostInBytes", str(n))

    yield set_to
    spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
    spark.conf.set("spark.sql.files.openCostInBytes", before[1])


def fields_of(rng):
    sign = lambda: rng.choice(["a", "b", "é", "漢", ",", '"', "\n", "\n\n", "\r\n", " ", "x,y", '""', "\n\"", ""])
    return "".join(sign() for _ in range(rng.randint(0, 30)))


@pytest.mark.parametrize("size", [37, 200, 1000, 1 << 20])
def test_ranges_of_any_size_give_the_same_records(spark, tmp_path, small_ranges, size):
    rng = random.Random(size)
    rows = [(str(i), fields_of(rng), fields_of(rng)) for i in range(40 if size < 64 else 200)]
    out = io.StringIO(newline="")
    writer = csv.writer(out, quoting=csv.QUOTE_ALL if size == 37 else csv.QUOTE_NOTNULL, lineterminator="\r\n" if size == 200 else "\n")
    writer.writerow(["id", "text\nof two lines" if size == 1000 else "text", "more"])
    writer.writerows(rows)
    (tmp_path / "x.csv").write_bytes(out.getvalue().encode())
    small_ranges(size)
    df = split_csv.read(spark, str(tmp_path / "x.csv"))
    if size < 1 << 20:
        assert byte_ranges.parts_of(spark, str(tmp_path / "x.csv"), "\n").rdd.getNumPartitions() >= 8
    assert sorted(map(tuple, df.collect())) == sorted(rows)


def test_bad_bytes_short_and_long_records_and_nulls(spark, tmp_path, small_ranges):
    data = b'\xef\xbb\xbfid,"te""xt",more\n1,a\xffb,\n\n2,"c\xe9\n\xf0\x9f",""\n3\n4,x,y,z\n5,"open\nto the end'
    (tmp_path / "x.csv").write_bytes(data)
    want = [("1", "ab", None), ("2", "c\n", ""), ("3", None, None), ("4", "x", "y"), ("5", "open\nto the end", None)]
    for size in (11, 1 << 20):
        small_ranges(size)
        df = split_csv.read(spark, str(tmp_path / "x.csv"))
        assert df.columns == ["id", 'te"xt', "more"] and sorted(map(tuple, df.collect())) == want


def test_folders_types_and_empty_files(spark, tmp_path):
    folder = tmp_path / "f"
    folder.mkdir()
    (folder / "a.csv").write_text('n,x,when,ok,s\n1,1.5,2024-01-02 03:04:05,true,a\n')
    (folder / "b.csv").write_text('n,x,when,ok,s\n30000000000,,2024-01-02 03:04:05,false,"1\n2"\n')
    (folder / "c.csv").write_text("")
    df = readers.read_csv(spark, str(folder))
    assert [t for _, t in df.dtypes] == ["bigint", "double", "timestamp", "boolean", "string"] and df.count() == 2
    typed = readers.read_csv(spark, str(folder), schema="s string, n long, missing int")
    assert sorted(map(tuple, typed.collect())) == [("1\n2", 30000000000, None), ("a", 1, None)]
    (tmp_path / "e.csv").write_text("id,text\n")
    assert readers.read_csv(spark, str(tmp_path / "e.csv"), tolerant=True).collect() == []
