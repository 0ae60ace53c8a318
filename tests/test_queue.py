import pytest
from pyspark.sql import functions as F

from kpi_shift.sources import queue


def read(spark, path):
    return sorted(bytes(r.value) for r in spark.read.format(queue.FORMAT).load(path).collect())


def test_batch_failed_write_and_stream(spark, tmp_path):
    queue.register(spark)
    path = str(tmp_path / "queue")
    assert read(spark, path) == []

    def numbers(first, end):
        return spark.range(first, end, 1, 3).select(F.col("id").cast("string").alias("value"))

    numbers(0, 20).write.format(queue.FORMAT).mode("append").save(path)
    failing = numbers(20, 40).withColumn("value", F.when(F.col("value") == "39", F.raise_error(F.lit("lost"))).otherwise(F.col("value")))
    with pytest.raises(Exception, match="lost"):
        failing.write.format(queue.FORMAT).mode("append").save(path)
    # what a failed write left is not read, and its repetition counts once
    assert read(spark, path) == sorted(str(n).encode() for n in range(20))
    numbers(20, 40).write.format(queue.FORMAT).mode("append").save(path)
    wanted = sorted(str(n).encode() for n in range(40))
    assert read(spark, path) == wanted

    def copy():
        rows = spark.readStream.format(queue.FORMAT).load(path)
        copied = rows.writeStream.format(queue.FORMAT).option("path", str(tmp_path / "copy")).option("writer", "copy")
        copied.option("checkpointLocation", str(tmp_path / "progress")).trigger(once=True).start().awaitTermination()
        return read(spark, str(tmp_path / "copy"))

    assert copy() == wanted
    numbers(40, 41).write.format(queue.FORMAT).mode("append").save(path)
    assert copy() == sorted([*wanted, b"40"])
    assert copy() == sorted([*wanted, b"40"])


def test_a_repeated_batch_adds_nothing(tmp_path):
    import pyarrow as pa

    folder = queue._Folder(str(tmp_path / "queue"))
    for _ in range(2):
        rows = pa.RecordBatch.from_arrays([pa.array([b"a", None, b""])], ["value"])
        folder.publish([folder.write(iter([rows])), None, folder.write(iter(()))], "s", "0")
    (only,) = folder.files_between(0, None)
    assert [v for b in folder.read(only) for v in b.column(0).to_pylist()] == [b"a", None, b""]
    assert folder.files_between(1, None) == [] and len(list((tmp_path / "queue" / "data").iterdir())) == 1
