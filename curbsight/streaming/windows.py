"""Quarter-hour windows that late readings still correct.

The stream over landed records closes a window when its watermark has passed. This one follows silver, which holds every
reading once however late it came, and adds what is new to a stored rollup. A batch becomes parts of its own windows, the
parts are merged with those of the touched days that the rollup holds, and these days are replaced. There is no watermark and no state beside the
table, so nothing is dropped and nothing grows with the number of open windows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from curbsight import schemas
from curbsight.operators.traffic_gold import merged_quarters, sensor_quarters, stored_sensor_quarters
from curbsight.sources.tables import only_days, read_parquet, write_arranged
from curbsight.streaming.ledger import KEPT
from curbsight.streaming.staging import discard, exists, made, stage, staged_days, started


def quarter_schema(spark: SparkSession) -> T.StructType:
    return sensor_quarters(spark.createDataFrame([], schemas.SILVER_TRAFFIC)).schema


def add_quarters(readings: DataFrame, rollup_path: str, redo_path: str) -> None:
    """Add new readings to the rollup.

    Sums must not be added twice. The parts of the batch and the new content of the days that the rollup holds already are
    staged before any day is replaced, and a batch that is run again goes on from what it finds there. All other days
    get the parts of the batch as they are.
    """
    spark = readings.sparkSession
    schema = quarter_schema(spark)
    incoming = stage(stored_sensor_quarters(readings), f"{redo_path}/incoming", schema, arranged=True)
    days = staged_days(incoming)
    if not days:
        return
    merged = spark.createDataFrame([], schema)
    if exists(spark, rollup_path):
        stored = only_days(read_parquet(spark, rollup_path, schema), days)
        merged = merged_quarters(only_days(incoming, staged_days(stored)).unionByName(stored))
    # Staged also if empty: what a crashed attempt has written must not pass for days that were held before.
    redo = stage(merged, f"{redo_path}/merged", schema)
    new = set(days) - set(staged_days(redo))
    write_arranged(redo.unionByName(only_days(incoming, new)), rollup_path, overwrite="dynamic")


def run_quarters(
    spark: SparkSession,
    silver_path: str,
    rollup_path: str,
    progress_path: str,
    *,
    every: str | None = None,
    max_files: int | None = None,
) -> StreamingQuery:
    """Silver traffic to the sensor-quarter rollup, from which all traffic tables but the incidents follow."""
    made(spark, silver_path)
    reader = spark.readStream.schema(schemas.SILVER_TRAFFIC).option("maxFileAge", KEPT)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)

    def add(batch: DataFrame, number: int) -> None:
        add_quarters(batch, rollup_path, f"{progress_path}/redo/batch-{number}")
        # The batch before this one is committed, so its redo tables are of no more use.
        discard(batch.sparkSession, f"{progress_path}/redo/batch-{number - 1}")

    return started(reader.parquet(silver_path).writeStream.foreachBatch(add), f"{progress_path}/checkpoint", every)
