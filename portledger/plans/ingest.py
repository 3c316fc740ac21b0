"""The ingest jobs: decode, normalise, dedup-append, keep the ledger.

All files of a run go through one plan. Workbooks are decoded once into a staged table in the shared
checkpoint folder; later steps read only the columns they need from it and a lost executor costs a
re-read, not a second decode. Names are translated last, for the new rows only.
"""

from pyspark.sql import functions as F

from portledger.operators.dedup import counter_totals, ingest_counters
from portledger.operators.lookup import Translations
from portledger.operators.sheet import HISTORICAL, STATUS_ROW, WEEKLY, rows_of_blocks
from portledger.plans.records import historical_records, translated, weekly_fields
from portledger.operators.joins import fits_broadcast
from portledger.schema import HISTORICAL_SHEET, LEDGER_SCHEMA, LOOKUP_SHEET
from portledger.session import pinned, scratch_path
from portledger.sources.inbox import escaped, list_folder, list_path, literal, pending_files, qualified
from portledger.sources.workbook import grid_of, scan_workbooks, whole_files

BACKFILL_BATCH = "0000-backfill"


def load_translations(spark, workbook_path):
    """Lookup table of a workbook; one that cannot be read or lacks the lookup sheet is an error."""
    listing = list_path(spark, escaped(workbook_path))
    blocks, bad = whole_files(scan_workbooks(listing, LOOKUP_SHEET))
    error = bad.first()
    if error:
        raise ValueError(error["error"])
    return Translations.from_grid(grid_of(blocks))


def weekly_rows(listing, opener=None):
    """Untranslated record rows and status rows of listed weekly workbooks."""
    return weekly_fields(rows_of_blocks(scan_workbooks(listing, opener=opener), WEEKLY))


def historical_rows(listing, opener=None):
    """Record and status rows of listed historical workbooks."""
    blocks = scan_workbooks(listing, HISTORICAL_SHEET, opener)
    return historical_records(rows_of_blocks(blocks, HISTORICAL))


class Stage:
    """Tables of one run in the shared checkpoint folder."""

    def __init__(self, spark):
        self.spark = spark
        self.path = scratch_path(spark, "stage")

    def table(self, name, df):
        path = f"{self.path}/{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self):
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)


def ingest(rows_of, listing, store, batch_id, dry_run=False, finish=None):
    """Dedup-append the rows of the listed files and write one ledger row per file; returns the ledger rows.

    ``rows_of(listing)`` gives record rows plus one status row per file; ``finish`` completes new rows. The listing is
    written down once, and the tasks that open the files are dealt from what was written: a file replaced meanwhile shows
    up with a new time and is taken again. Rows of a file that broke midway are dropped by its status. The
    ledger is written after the records, and nothing of a run counts before its ledger is there.
    """
    stage = Stage(listing.sparkSession)
    try:
        listed = stage.table("listing", listing)
        if listed.isEmpty():
            return stage.spark.createDataFrame([], LEDGER_SCHEMA)
        staged = stage.table("rows", rows_of(listed))
        files = staged.where(F.col("row_idx") == STATUS_ROW).select("src_file", "message")
        batch = staged.where(F.col("row_idx") > STATUS_ROW).drop("message")
        # Files without a header or column left no rows; only those broken midway have some to drop.
        bad = files.where(F.col("message").isNotNull()).select("src_file")
        if bad.limit(1).count():
            batch = batch.join(F.broadcast(bad) if fits_broadcast(bad) else bad, "src_file", "left_anti")
        if dry_run:
            return pinned(ledger_rows(listed, ingest_counters(files, batch, store.fresh(batch)), batch_id))
        pub = store.begin()
        written = store.append(batch, batch_id, finish, pub)
        entries = ledger_rows(listed, ingest_counters(files, batch, written), batch_id)
        return store.write_ledger(entries, pub)
    finally:
        stage.drop()


def ledger_rows(listing, counters, batch_id):
    """One row per listed file: done, empty or failed, with its counts."""
    joined = listing.join(counters.withColumnRenamed("src_file", "path"), "path", "left")
    gone = F.lit("file was replaced or removed while it was read")
    message = F.coalesce("message", F.when(F.col("parsed").isNull(), gone))
    status = F.when(message.isNotNull(), "failed").when(F.col("parsed") == 0, "empty").otherwise("done")
    count = lambda c: F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
    return joined.select(
        "path",
        "modification_time",
        "length",
        status.alias("status"),
        count("parsed"),
        count("written"),
        count("skipped"),
        F.when(message.isNotNull(), 1).otherwise(0).cast("bigint").alias("errors"),
        message.alias("message"),
        F.lit(batch_id).alias("batch_id"),
    )


def ledger_totals(entries):
    """Written, skipped and errors per file and, with a null file, for the run."""
    return counter_totals(entries.withColumnRenamed("path", "src_file"))


def weekly_ingest(spark, folder, store, translations, batch_id, dry_run=False, single_file=None, opener=None):
    """Ingest every pending workbook of ``folder``, or just ``single_file`` whatever its state.

    Returns the ledger rows of the run; nothing pending gives none.
    """
    if single_file is not None:
        # A missing file is an error here, as there is nothing else to do.
        listing = list_path(spark, escaped(single_file))
    else:
        listing = pending_files(list_folder(spark, folder), store.ledger(), qualified(spark, folder))
    finish = lambda fresh: translated(fresh, translations)
    return ingest(lambda listed: weekly_rows(listed, opener), listing, store, batch_id, dry_run, finish)


def historical_ingest(spark, path, store, dry_run=False, batch_id=BACKFILL_BATCH, opener=None):
    """Ingest the historical workbook (or workbooks) at ``path``; repeating it writes nothing new."""
    listing = list_path(spark, literal(spark, path))
    return ingest(lambda listed: historical_rows(listed, opener), listing, store, batch_id, dry_run)
