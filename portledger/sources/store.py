"""The record table, its key table, the file ledger and the reports, as Parquet below one root folder.

Every append is a publication of its own, ``pub=<n>``, and no publication is ever written again: a batch id that
is used twice, a file that comes again or a second stream only adds records whose keys are not stored yet. A publication counts
once its name is in ``commits``, which is the last thing a run writes: a run that stops midway shows nothing of its
records, keys or ledger rows, and its repeat finds all of them unseen.

The keys of the records lie in a table of their own, bucketed by key, so a batch meets them without a shuffle of
the stored side. ``compact`` rewrites many small publications into one, whose name says which it replaces.
"""

import hashlib
import re

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from portledger.functions.text import safe_str
from portledger.operators.dedup import dedup_keys, first_lineage, rows_at, unseen
from portledger.operators.joins import size_columns
from portledger.plans.records import aligned
from portledger.schema import DEDUP_KEY, LEDGER_SCHEMA, STORED_SCHEMA
from portledger.session import pinned

NO_YEAR = "none"

# Least number of buckets of the key table; a store keeps the number it was made with. Fewer buckets than
# shuffle partitions would make Spark shuffle both sides of a join.
KEY_BUCKETS = 64

_PUB = [StructField("pub", LongType())]
_SEQ = [StructField("seq", LongType())]
# ``seq`` is the publication a record came in first; compaction keeps it.
PUBLISHED_SCHEMA = StructType(STORED_SCHEMA.fields + _SEQ + _PUB)
PUBLISHED_LEDGER_SCHEMA = StructType(LEDGER_SCHEMA.fields + _PUB)


def record_year(date="date"):
    """Partition value of a record: the year of an ISO-shaped date, or ``none``."""
    text = safe_str(date)
    return F.when(text.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), F.substring(text, 1, 4)).otherwise(NO_YEAR)


class RecordStore:
    """Append-only records. One writer at a time."""

    def __init__(self, spark, root, buckets=None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.buckets = buckets or max(KEY_BUCKETS, int(spark.conf.get("spark.sql.shuffle.partitions")))

    # Folders and commits.

    def _path(self, *parts):
        return "/".join([self.root, *parts])

    def _fs(self, path):
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return folder, folder.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, *parts):
        folder, fs = self._fs(self._path(*parts))
        return [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []

    def _next(self):
        """A number above every one ever used, from folder names alone."""
        used = [re.match(r"(?:pub=)?(\d+)", n) for part in ("records", "ledger", "commits") for n in self._names(part)]
        return 1 + max([int(m[1]) for m in used if m], default=0)

    def commits(self):
        """Visible publications: committed, and not replaced by a compaction."""
        found = [re.fullmatch(r"(\d+)(?:-(\d+)-(\d+))?", n) for n in self._names("commits")]
        replaced = [(int(m[2]), int(m[3])) for m in found if m and m[2]]
        return sorted(n for m in found if m for n in [int(m[1])] if not any(a <= n <= b for a, b in replaced))

    def _commit(self, pub, replaces=None):
        name = f"{pub}-{replaces[0]}-{replaces[1]}" if replaces else str(pub)
        path, fs = self._fs(self._path("commits", name))
        fs.create(path).close()

    def _read(self, schema, part, pubs=None):
        path = self._path(part)
        pubs = self.commits() if pubs is None else pubs
        try:
            found = self.spark.read.schema(schema).option("basePath", path).parquet(path)
        except AnalysisException as exc:
            if exc.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)
        return found.where(F.col("pub").isin(pubs))

    def ensure(self):
        """Create an empty record table with its columns; leave an existing one alone."""
        path = self._path("records")
        try:
            self.spark.read.schema(PUBLISHED_SCHEMA).parquet(path)
        except AnalysisException as exc:
            if exc.getCondition() != "PATH_NOT_FOUND":
                raise
            empty = self.spark.createDataFrame([], PUBLISHED_SCHEMA)
            empty.write.partitionBy("pub", "yr").parquet(path)

    # Records and keys.

    def published(self, pubs=None):
        """All stored records with their batch and ``seq``, the number of the append they came in."""
        return self._read(PUBLISHED_SCHEMA, "records", pubs).drop("pub")

    def records(self):
        """All stored records, with the batch each came in."""
        return self.published().drop("seq")

    def batch(self, batch_id):
        return self.records().where(F.col("batch_id") == batch_id)

    def _bucket_count(self):
        made = [int(n.removeprefix("keys-")) for n in self._names() if re.fullmatch(r"keys-\d+", n)]
        return made[0] if made else self.buckets

    def _key_table(self):
        """The key table under a name of this session; its files and their buckets are the store's."""
        buckets = self._bucket_count()
        path = self._path(f"keys-{buckets}")
        name = f"portledger_keys_{hashlib.md5(path.encode()).hexdigest()}"
        if not self.spark.catalog.tableExists(name):
            place = path.replace("\\", "\\\\").replace("'", "\\'")
            columns = ", ".join(f"{c} STRING" for c in DEDUP_KEY)
            keys = ", ".join(DEDUP_KEY)
            self.spark.sql(
                f"CREATE TABLE {name} ({columns}, yr STRING, pub BIGINT) USING parquet PARTITIONED BY (pub) "
                f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {buckets} BUCKETS LOCATION '{place}'"
            )
        return name

    def keys(self):
        """Stripped keys of all visible records, with their year."""
        if not any(n.startswith("keys-") for n in self._names()):
            columns = ", ".join(f"{c} string" for c in [*DEDUP_KEY, "yr"])
            return self.spark.createDataFrame([], columns)
        name = self._key_table()
        self.spark.catalog.refreshTable(name)
        return self.spark.table(name).where(F.col("pub").isin(self.commits())).drop("pub")

    def _write_keys(self, records, pub):
        keys = dedup_keys(records.select(*DEDUP_KEY)).withColumn("yr", record_year())
        # A task gets whole buckets, as the number of tasks divides that of the buckets: one file each.
        buckets = self._bucket_count()
        most = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        tasks = max(n for n in range(1, min(buckets, most) + 1) if buckets % n == 0)
        dealt = keys.repartition(tasks, *DEDUP_KEY).withColumn("pub", F.lit(pub).cast("bigint"))
        dealt.write.insertInto(self._key_table())

    def fresh(self, batch):
        """Rows of ``batch`` that are not stored yet, first of their key.

        The date is part of the key, so only stored keys of the batch's years are read.
        """
        firsts, names = first_lineage(batch)
        firsts = pinned(firsts)
        keys = firsts.select(*names)
        # At most 10,000 year texts and "none".
        years = F.collect_set(record_year(names[DEDUP_KEY.index("date")])).alias("years")
        measured = keys.agg(years, *size_columns(keys)).first()
        stored = self.keys().where(F.col("yr").isin(measured["years"]))
        stored_keys = stored.select(*[F.col(c).alias(n) for c, n in zip(DEDUP_KEY, names)])
        return rows_at(batch, unseen(firsts, names, stored_keys, measured))

    def append(self, batch, batch_id, finish=None, pub=None):
        """Dedup-append ``batch`` and return the rows that this call wrote.

        ``batch`` needs the key and lineage columns; ``finish`` turns the new rows into records, so
        work that the key does not depend on is done for new rows only. With ``pub`` the caller commits it.
        """
        rows = self.fresh(batch)
        rows = aligned(finish(rows) if finish else rows)
        number = self._next() if pub is None else pub
        rows = rows.withColumns(
            {"batch_id": F.lit(batch_id), "seq": F.lit(number).cast("bigint"), "yr": record_year()}
        )
        # Rebalancing splits a year that holds most of the rows and joins small ones.
        rows.hint("rebalance", "yr").write.partitionBy("yr").parquet(self._path("records", f"pub={number}"))
        self.ensure()
        written = self.published([number])
        self._write_keys(written, number)
        if pub is None:
            self._commit(number)
        return written.drop("seq")

    def begin(self):
        """The number of a publication that its caller commits."""
        return self._next()

    # Ledger, tallies and reports.

    def ledger(self, pubs=None):
        return self._read(PUBLISHED_LEDGER_SCHEMA, "ledger", pubs).drop("pub")

    def write_ledger(self, rows, pub):
        """Write the run's ledger rows, then commit its publication; returns the rows."""
        rows.write.parquet(self._path("ledger", f"pub={pub}"))
        self._commit(pub)
        return self.ledger([pub])

    def _done(self, *parts):
        path, fs = self._fs(self._path(*parts, "_SUCCESS"))
        return fs.exists(path)

    def tallied(self):
        """Publications' first numbers up to which tallies are there; a tally covers those after the one before it."""
        found = [int(n) for n in self._names("tallies") if n.isdigit()]
        return sorted(n for n in found if self._done("tallies", str(n), "importers"))

    def untallied(self):
        """Records that no tally covers yet, read from their publications alone, and the number that covers them."""
        covered = max(self.tallied(), default=0)
        pubs = [n for n in self.commits() if n > covered]
        return (self.published(pubs).where(F.col("seq") > covered), pubs[-1]) if pubs else (None, covered)

    def write_tallies(self, upto, counts, importers):
        counts.write.mode("overwrite").parquet(self._path("tallies", str(upto), "counts"))
        # Written last: with it the tally counts.
        importers.write.mode("overwrite").parquet(self._path("tallies", str(upto), "importers"))

    def tallies(self, part):
        """The rows of ``part`` of all tallies, or None without any."""
        paths = [self._path("tallies", str(n), part) for n in self.tallied()]
        return self.spark.read.parquet(*paths) if paths else None

    def _report_versions(self):
        found = [int(n) for n in self._names("reports") if n.isdigit()]
        return sorted(n for n in found if self._done("reports", str(n)))

    def write_reports(self, reports):
        """Write all ``reports``, a mapping of names, as a new version; readers see the last one until it is complete."""
        used = [int(n) for n in self._names("reports") if n.isdigit()]
        version = 1 + max(used, default=0)
        for name, df in reports.items():
            df.write.parquet(self._path("reports", str(version), name))
        path, fs = self._fs(self._path("reports", str(version), "_SUCCESS"))
        fs.create(path).close()
        # A reader that has just opened the last version can still finish.
        for old in used:
            if old < version - 1:
                path, fs = self._fs(self._path("reports", str(old)))
                fs.delete(path, True)

    def report(self, name):
        """The newest complete version of a report."""
        versions = self._report_versions()
        if not versions:
            raise LookupError("no report was made yet")
        return self.spark.read.parquet(self._path("reports", str(versions[-1]), name))

    # Upkeep.

    def compact(self):
        """Rewrite all visible publications into one; records, lineage, ``seq`` and ledger stay the same.

        Readers see the old ones until the commit and the new one from then on. Returns the new number, or None.
        """
        pubs = self.commits()
        if len(pubs) < 2:
            return None
        number = self._next()
        records = self.published(pubs)
        records.hint("rebalance", "yr").write.partitionBy("yr").parquet(self._path("records", f"pub={number}"))
        self._write_keys(self.published([number]), number)
        self.ledger(pubs).coalesce(1 + self.ledger(pubs).count() // 1_000_000).write.parquet(self._path("ledger", f"pub={number}"))
        self._commit(number, (pubs[0], pubs[-1]))
        return number

    def vacuum(self):
        """Delete publications that are replaced or were never committed; no run may be under way."""
        kept = set(self.commits())
        for part in ("records", "ledger", *[n for n in self._names() if n.startswith("keys-")]):
            for name in self._names(part):
                number = re.fullmatch(r"pub=(\d+)", name)
                if number and int(number[1]) not in kept:
                    path, fs = self._fs(self._path(part, name))
                    fs.delete(path, True)
