"""Weekly ingest as a file stream: new workbooks are picked up as they arrive.

The record table is the state. The stream itself keeps none, because a key is compared with all
records ever stored and such a state would grow without end.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from portledger.plans.ingest import ingest, weekly_rows
from portledger.plans.records import translated
from portledger.schema import FILE_SCHEMA
from portledger.sources.inbox import WORKBOOK_SUFFIX, list_folder, listing_of, literal, qualified, unprocessed


def repaired(listing, ledger):
    """Listed files whose last ledger entry is not ``done`` and that have changed since.

    A stream never sees a path twice, so a file that failed once comes back through the ledger.
    """
    latest = Window.partitionBy("path").orderBy(F.desc("modification_time"), F.desc(F.col("status") == "done"))
    last = ledger.select("path", "modification_time", "status").withColumn("_n", F.row_number().over(latest))
    failed = last.where("_n = 1 AND status <> 'done'").select("path", F.col("modification_time").alias("_tried"))
    return listing.join(failed, "path").where("modification_time <> _tried").select(*listing.columns)


def weekly_stream(spark, folder, store, translations, checkpoint, prefix="stream", max_files=1000, opener=None):
    """Start the stream over what is in ``folder`` now; returns the query.

    Every micro-batch is one ingest batch, and a replayed micro-batch finds its keys stored. Files that failed and were
    repaired since join the next micro-batch; they are also taken at the start, as no new file may come.
    """
    root = qualified(spark, folder)
    files = (
        spark.readStream.format("binaryFile")
        .schema(FILE_SCHEMA)
        .option("pathGlobFilter", f"*{WORKBOOK_SUFFIX}")
        .option("maxFilesPerTrigger", max_files)
        .load(literal(spark, folder))
    )
    files = unprocessed(listing_of(files), root)
    finish = lambda fresh: translated(fresh, translations)

    def take(new, batch_id):
        again = repaired(unprocessed(list_folder(spark, folder), root), store.ledger())
        listing = again if new is None else new.unionByName(again.join(new, "path", "left_anti"))
        ingest(lambda listed: weekly_rows(listed, opener), listing, store, batch_id, finish=finish)

    take(None, f"{prefix}-retry")
    return (
        files.writeStream.foreachBatch(lambda batch, epoch: take(batch, f"{prefix}-{epoch:09d}"))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
