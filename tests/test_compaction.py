import json

from pyspark.sql import functions as F

from kpi_shift.sources.published import read_published
from kpi_shift.streaming import compaction
from kpi_shift.streaming.messages import append_to_files, parse_messages
from tests.helpers import as_set

DAY_MS = 86_400_000
START_MS = 1704240000000  # 2024-01-03


def arrive(spark, tmp_path, ids, day):
    rows = [(json.dumps({"eventType": i, "location": None, "timestamp": START_MS + day * DAY_MS + i % 3 * 3_600_000, "data": str(i)}).encode(),) for i in ids]
    rows += [(b"not json",)]
    source = str(tmp_path / "in")
    spark.createDataFrame(rows, "value binary").repartition(6).write.mode("append").parquet(source)
    parsed = parse_messages(spark.readStream.schema("value binary").option("maxFilesPerTrigger", 2).parquet(source))
    append_to_files(parsed, str(tmp_path / "out"), str(tmp_path / "progress"), once=True).awaitTermination()
    return parsed.schema


def test_rows_are_the_same_before_and_after_and_files_few(spark, tmp_path):
    out, path = str(tmp_path / "out"), str(tmp_path / "compacted")

    def same(schema):
        stream = as_set(spark.read.schema(schema).json(out).select(*schema.names))
        assert as_set(compaction.read_messages(spark, out, schema, path)) == stream
        return len(stream)

    schema = arrive(spark, tmp_path, range(60), 0)
    assert same(schema) == 61
    assert compaction.compact(spark, out, schema, path, "2024-01-03", "2024-01-04") == 1
    assert same(schema) == 61
    small = len(list((tmp_path / "out").rglob("*.json.gz")))
    compacted = read_published(spark, path)
    assert small > 6 and len(compacted.inputFiles()) == 3 and compacted.count() == 60
    # late rows of a compacted day, and a day that is still open
    arrive(spark, tmp_path, range(60, 70), 0)
    arrive(spark, tmp_path, range(5), 1)
    assert same(schema) == 78
    # no file of the compacted rows is read again
    left = compaction.uncovered_files(spark, out, read_published(spark, path))
    covered = {r[0] for r in compacted.select(compaction.SOURCE_FILE).distinct().collect()}
    assert left and not covered & {f.rsplit("/", 1)[-1] for f in left}
    compaction.compact(spark, out, schema, path, "2024-01-03", "2024-01-04")
    assert same(schema) == 78
    again = read_published(spark, path)
    assert len(again.inputFiles()) == 3 and again.agg(F.count("*")).first()[0] == 70
    # a range without rows empties nothing else
    compaction.compact(spark, out, schema, path, "2024-02-01", "2024-02-02")
    assert same(schema) == 78


def test_before_the_first_compaction(spark, tmp_path):
    schema = arrive(spark, tmp_path, [1], 0)
    assert compaction.read_messages(spark, str(tmp_path / "out"), schema, str(tmp_path / "none")).count() == 2
