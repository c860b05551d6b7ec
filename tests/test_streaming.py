"""Available-now intake processes each extract file once; a retried batch repeats its run id."""

import datetime as dt
import tempfile
import uuid

from trialmart.sinks import archive_snapshot, publish, run_id_of
from trialmart.streaming import process_new_extracts, worklist_batch_handler


def test_new_extract_files_are_processed_once(spark):
    folder = tempfile.mkdtemp(prefix="trialmart-extracts-")
    spark.range(0, 5).write.mode("append").parquet(folder)
    schema = spark.read.parquet(folder).schema
    seen = []
    name = f"extracts_{uuid.uuid4().hex}"
    on_batch = lambda df, _id: seen.append(df.count())
    process_new_extracts(spark, folder, schema, on_batch, name=name)
    spark.range(5, 8).write.mode("append").parquet(folder)
    process_new_extracts(spark, folder, schema, on_batch, name=name)
    assert sum(seen) == 8 and seen[-1] == 3


def test_retried_batch_is_one_run(spark):
    base = tempfile.mkdtemp(prefix="trialmart-retry-")

    def build(rows, run_ts):
        rid = run_id_of(run_ts)
        archive_snapshot(spark, publish(rows, base, "worklist", rid), f"{base}/history", rid)

    handle = worklist_batch_handler(build, dt.datetime(2024, 2, 1, 6))
    for batch_id in (0, 0, 1):
        handle(spark.range(batch_id, batch_id + 3), batch_id)
    handle(spark.range(0), 2)
    history = spark.read.parquet(f"{base}/history")
    assert history.count() == 6 and history.select("run_id").distinct().count() == 2
