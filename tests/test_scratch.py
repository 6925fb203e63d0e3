import time

from corvane.sources.scratch import kept


def test_what_is_kept_follows_its_input(spark, tmp_path):
    made = []

    def make(path):
        made.append(path)
        spark.range(3).write.parquet(f"{path}/t")

    source = str(tmp_path / "in")
    spark.range(5).write.parquet(source)
    first = kept(spark, "x", [source], make)
    assert kept(spark, "x", [source], make) == first and kept(spark, "y", [source], make) != first and len(made) == 2
    time.sleep(1.1)
    spark.range(6).write.mode("overwrite").parquet(source)
    again = kept(spark, "x", [source], make)
    assert again != first and len(made) == 3
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(again)
    root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(root, True)
    assert kept(spark, "x", [source], make) != again and len(made) == 4
