"""A queue of requests as a stream: units go in one by one, each is done with before the next, and a later run goes on.

The requests of a queue are written once, a file a unit, and read as a file stream with an available-now trigger that takes
one file a micro-batch. The stream's checkpoint tells which units are done; what a unit brought is saved by the
caller within its micro-batch. So a run that is stopped, by the caller or by a failure, leaves the rest of the queue to
the next one and repeats no unit that was done.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.sources import files


class Stop(Exception):
    """Ends a run between two units."""


def fill(requests: DataFrame, folder: str, unit: int) -> bool:
    """Writes requests (batch, ...) as units of `unit` batches, the first batches first. False if there are none."""
    spark = requests.sparkSession
    numbered = requests.withColumn("unit", F.floor(F.col("batch") / unit).cast("int"))
    numbered.repartition("unit").write.mode("overwrite").partitionBy("unit").parquet(f"{folder}/units")
    units = [n for n in files.names(spark, f"{folder}/units") if n.startswith("unit=")]
    # a file stream takes the oldest file first
    start = int(time.time() * 1000) - 10 * len(units)
    for n in units:
        for f in files.names(spark, f"{folder}/units/{n}"):
            files.set_time(spark, f"{folder}/units/{n}/{f}", start + 10 * int(n.split("=")[1]))
    return bool(units)


def run(spark: SparkSession, folder: str, work: Callable[[DataFrame, int], bool]) -> bool:
    """Does the units that are left of a filled queue; work(requests, number) returns False to end the run before a unit.
    True if the queue is empty now."""
    schema = spark.read.parquet(f"{folder}/units").schema
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/units")
    stopped: list[int] = []

    def each(batch: DataFrame, number: int) -> None:
        if not work(batch, number):
            stopped.append(number)
            raise Stop

    query = source.writeStream.foreachBatch(each).option("checkpointLocation", f"{folder}/mark").trigger(availableNow=True).start()
    try:
        query.awaitTermination()
    except StreamingQueryException:
        if not stopped:
            raise
    return not stopped


def drain(spark: SparkSession, folder: str, requests: Callable[[], DataFrame], unit: int, work: Callable[[str, DataFrame, int], bool]) -> bool:
    """First what an earlier run left of its queue, then a queue of the requests as they are now. work(queue, requests,
    number) as for run(). True if nothing is left."""
    held = files.names(spark, folder)
    for name in held:
        own = f"{folder}/{name}"
        state = files.names(spark, own)
        if "filled" in state and "done" not in state:
            if not run(spark, own, lambda df, n, q=name: work(q, df, n)):
                return False
            files.write_text(spark, f"{own}/done", "")
        files.remove(spark, f"{own}/units")
    name = f"q-{1 + max((int(n[2:]) for n in held if n.startswith('q-')), default=0):08d}"
    own = f"{folder}/{name}"
    if not fill(requests(), own, unit):
        return True
    files.write_text(spark, f"{own}/filled", "")
    if not run(spark, own, lambda df, n: work(name, df, n)):
        return False
    files.write_text(spark, f"{own}/done", "")
    return True
