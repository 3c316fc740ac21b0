"""Which workbooks are waiting: a listing without contents, joined with the ledger."""

import re

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

# File names.
WORKBOOK_SUFFIX = ".xlsx"
DONE_SUFFIX = "_done.xlsx"

LISTING_SCHEMA = "path string, modification_time timestamp, length bigint"


def escaped(path):
    """``path`` with glob characters taken literally."""
    return re.sub(r"([\\{}\[\]*?,])", r"\\\1", path)


def _hadoop_path(spark, path):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def literal(spark, path):
    """``path`` itself where something is there, else as the glob it may be."""
    folder, fs = _hadoop_path(spark, path)
    return escaped(path) if fs.exists(folder) else path


def qualified(spark, path):
    """``path`` as the file system spells it in listings, whatever way it was typed."""
    folder, fs = _hadoop_path(spark, path)
    return fs.makeQualified(folder).toString()


def listing_of(files):
    """Files of the binary source as ``(path, modification_time, length)``; contents are not read."""
    return files.select("path", F.col("modificationTime").alias("modification_time"), "length")


def list_path(spark, path):
    """All files at ``path``, a file, folder or glob; one that is not there is an error."""
    return listing_of(spark.read.format("binaryFile").load(path))


def list_folder(spark, folder):
    """Workbooks directly in ``folder``; a folder that is not there has none."""
    folder = literal(spark, folder)
    try:
        files = spark.read.format("binaryFile").option("pathGlobFilter", f"*{WORKBOOK_SUFFIX}").load(folder)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LISTING_SCHEMA)
    return listing_of(files)


def unprocessed(listing, folder):
    """Workbooks directly in ``folder``, a qualified path, whose name does not carry the done mark."""
    name = F.substring_index("path", "/", -1)
    parent = F.col("path").substr(F.lit(1), F.length("path") - F.length(name))
    # A local root is listed with one slash or three.
    plain = F.regexp_replace(parent, "^file:/+", "file:/")
    return listing.where(
        (plain == re.sub("^file:/+", "file:/", folder.rstrip("/") + "/"))
        & name.endswith(WORKBOOK_SUFFIX)
        & ~name.endswith(DONE_SUFFIX)
    )


def pending_files(listing, ledger, folder):
    """Unprocessed workbooks without a ``done`` entry for the same path and modification time.

    Failed and empty files, and new files under an old name, are pending again.
    """
    done = ledger.where(F.col("status") == "done").select("path", "modification_time")
    return unprocessed(listing, folder).join(done, ["path", "modification_time"], "left_anti")
