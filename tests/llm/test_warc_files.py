"""WARC archives: few files list them, however many tasks write, and they are dealt evenly to the readers."""

from pathlib import Path

from weftline.llm import warc
from weftline.session import frozen


def test_list_of_archives_takes_few_files(spark, tmp_path):
    before = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "24")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        pages = spark.createDataFrame([(i, f"u{i}", f"page {i % 150}") for i in range(400)], "page_id long, url string, html string")
        archives = warc.write_warc(pages, f"file://{tmp_path}/warc")
        cores = spark.sparkContext.defaultParallelism
        count = len(list((tmp_path / "warc").glob("*.warc.gz")))
        assert count > 2 * cores and archives.count() == count
        assert len(list(Path(frozen()[-1].removeprefix("file://")).glob("part-*"))) <= cores
        found = warc.read_warc(archives, payloads=False)
        tasks = [len({r.archive for r in rows}) for rows in found.select("archive").rdd.glom().collect()]
        assert sum(tasks) == count and max(tasks) <= 4
        rows = {r.page_id: (r.record_type, r.refers_to) for r in found.collect()}
        assert rows == {i: ("response", None) if i < 150 else ("revisit", i % 150) for i in range(400)}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before[0])
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before[1])
