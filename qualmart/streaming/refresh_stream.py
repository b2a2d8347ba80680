"""Run the keyed refresh for every load that is announced (Structured Streaming).

A load is a named whole: a line of JSON, ``{"load": ..., "outcomes": folder, "infections": folder}``,
put into the announcement folder after both feeds lie complete in theirs. The stream reads
announcements, one file a trigger, and hands each load to the same batch ``refresh``; a folder that is
still being copied isn't announced, so it is never read, and two loads are never mixed. The stream's
checkpoint in the shared folder records the announcements done. A load whose publish succeeded but whose
stream commit was lost runs again; the keyed merge then writes equal tables as another version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from qualmart.plans.refresh import RefreshConfig, refresh
from qualmart.sources.landing import read_feed
from qualmart.sources.store import TableStore

ANNOUNCEMENT = "load string, outcomes string, infections string"


def start_refresh_stream(spark: SparkSession, announcements: str, store: TableStore, config: RefreshConfig,
                         checkpoint_location: str, available_now: bool = False) -> StreamingQuery:
    loads = (spark.readStream.schema(ANNOUNCEMENT).option("maxFilesPerTrigger", 1)
                  .option("mode", "FAILFAST").json(announcements))

    def run(batch: DataFrame, batch_id: int) -> None:
        for load in sorted(batch.collect()):        # the announcements of one file
            refresh(spark, store, read_feed(spark, load.outcomes, "outcomes"),
                    read_feed(spark, load.infections, "infections"), config)

    writer = (loads.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint_location)
                   .queryName("qualmart_refresh"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="1 minute")
    return writer.start()
