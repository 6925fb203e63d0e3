"""What finished steps leave on the driver."""

from corvane.llm import common


def test_written_table_collects_a_grown_heap(spark, monkeypatch):
    heap = spark.sparkContext._jvm.Runtime.getRuntime()
    monkeypatch.setattr(common, "_heap_after", [heap.totalMemory() - common.HEAP_GROWTH - 1])
    ws = common.Workspace(spark, "test")
    assert ws.write(spark.range(3), "t").count() == 3
    assert common._heap_after == [heap.totalMemory()]  # collected, and noted

    common._heap_after[0] = known = heap.totalMemory() + 1
    ws.write(spark.range(3), "u")
    assert common._heap_after == [known] or heap.totalMemory() > known  # not for less
    ws.drop("t", "u")
    assert common._heap_after[0] != known
    ws.remove()
