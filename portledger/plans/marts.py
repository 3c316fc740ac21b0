"""The four report aggregations.

Each one first counts by raw text values, next to the scan and before any shuffle, and reads numbers
out of the few remaining year and month texts. A hot importer, year or country is therefore one
partial count per task when it reaches the shuffle.

Rows to leave out are counted as nothing and their empty groups dropped afterwards. A filter on the
parsed number would be pushed below the first count and parse the text of every record again.
"""

from pyspark.sql import functions as F

from portledger.functions.classify import COUNTRIES, TYPES, country_bucket, type_label
from portledger.functions.text import lenient_int, safe_str
from portledger.operators.joins import fits_broadcast
from portledger.operators.ranking import with_global_rank
from portledger.schema import LINEAGE
from portledger.session import pinned

# Fixed value: group of the records without an importer name; shown as the empty string.
UNKNOWN_IMPORTER = "__unknown__"

COUNTRY_COLUMNS = {"NZ": "nz", "Russia": "russia", "China": "china", "Other": "other"}


def tally(records):
    """Record counts ``n`` by year, month, type label and country bucket.

    ``year`` and ``month`` are whole numbers, null where the text was no number. Small enough to be
    the common base of the three count reports.
    """
    return (
        records.select(
            "year", "month", type_label().alias("ptype"), country_bucket().alias("country")
        )
        .groupBy("year", "month", "ptype", "country")
        .agg(F.count("*").alias("n"))
        .select(
            lenient_int("year").alias("year"), lenient_int("month").alias("month"), "ptype", "country", "n"
        )
    )


def _n_where(condition, name):
    return F.sum(F.when(condition, F.col("n")).otherwise(0)).alias(name)


def _by_country(kept):
    return [_n_where(kept & (F.col("country") == c), COUNTRY_COLUMNS[c]) for c in COUNTRIES]


def monthly_by_type(tallied):
    """Counts per calendar month and product type; only months that occur."""
    kept = (F.col("year") != 0) & (F.col("month") != 0)
    return (
        tallied.groupBy("year", "month")
        .agg(
            *[_n_where(kept & (F.col("ptype") == t), t) for t in TYPES], _n_where(kept, "total")
        )
        .where("total > 0")
    )


def yearly_by_country(tallied):
    """Counts per year and country bucket, zero-filled within a year, ascending years."""
    kept = F.col("year") != 0
    return (
        tallied.groupBy("year")
        .agg(*_by_country(kept), _n_where(kept, "total"))
        .where("total > 0")
        .orderBy("year")
    )


def type_country_pivot(tallied, year=None):
    """Type by country with a total row: always four rows, zeros where there is nothing.

    Without ``year`` every record counts, also those whose year is no number.
    """
    kept = F.lit(True) if year is None else F.col("year") == year
    counted = tallied.groupBy("ptype").agg(*_by_country(kept))
    columns = list(COUNTRY_COLUMNS.values())
    # Three rows go into the rollup, so the total costs nothing.
    totalled = counted.rollup("ptype").agg(*[F.sum(c).alias(c) for c in columns])
    named = totalled.withColumn("ptype", F.coalesce("ptype", F.lit("total")))
    rows = F.explode(F.array(*[F.lit(t) for t in [*TYPES, "total"]])).alias("ptype")
    scaffold = tallied.sparkSession.range(1).select(rows)
    # At most four rows.
    return scaffold.join(F.broadcast(named), "ptype", "left").na.fill(0, columns)


# A record's place as one fixed-width number: publication, file and row. Its least value is a plain minimum.
PLACE = "decimal(38,0)"


def _places(seen, order):
    """Add ``place``, which orders records as ``order`` does; the last column is a whole number.

    Columns before it are ranked, apart from a leading ``seq``, which stays a number, so places of different publications
    compare whatever they were ranked with. One row per file is ranked.
    """
    *prefix, last = order
    if not prefix:
        return seen.withColumn("place", F.col(last).cast(PLACE))
    ranked = with_global_rank(seen.select(*prefix).distinct(), [F.asc(c) for c in prefix], "_rank")
    joined = seen.join(F.broadcast(ranked) if fits_broadcast(ranked) else ranked, prefix)
    wide = lambda c, bits: F.col(c).cast("decimal(18,0)") * F.lit(str(1 << bits)).cast("decimal(20,0)")
    place = wide("_rank", 32) + F.col(last).cast("decimal(18,0)")
    if prefix[0] == "seq":
        place = place + wide("seq", 64)
    return joined.withColumn("place", place.cast(PLACE)).drop("_rank")


def importer_tally(records, order=LINEAGE):
    """Record counts and first place per importer, English name and year; records without a usable year are left out.

    Tallies of different records add up: ``merged_importers`` makes one of them.
    """
    *prefix, last = order
    raw = records.select(
        safe_str("importer_ko").alias("ko"), safe_str("importer_en").alias("en"), "year", *order
    )
    seen = raw.groupBy("ko", "en", "year", *prefix).agg(
        F.count("*").alias("n"), F.min(last).alias(last)
    )
    group = F.when(F.col("ko") == "", UNKNOWN_IMPORTER).otherwise(F.col("ko"))
    return (
        _places(seen, order)
        .select(group.alias("ko"), "en", lenient_int("year").alias("year"), "n", "place")
        .groupBy("ko", "en", "year")
        .agg(_n_where(F.col("year") != 0, "n"), F.min("place").alias("place"))
        .where("n > 0")
    )


def merged_importers(tallied):
    return tallied.groupBy("ko", "en", "year").agg(F.sum("n").alias("n"), F.min("place").alias("place"))


def merged_tally(tallied):
    return tallied.groupBy("year", "month", "ptype", "country").agg(F.sum("n").alias("n"))


def _shown(ko):
    return F.when(ko == UNKNOWN_IMPORTER, "").otherwise(ko)


def importer_years(records, order=LINEAGE):
    """Counts per importer and year, long form."""
    counts = importer_tally(records, order).groupBy("ko", "year").agg(F.sum("n").alias("n"))
    return counts.select(_shown(F.col("ko")).alias("importer_ko"), "year", "n")


def importer_totals(records, translations=None, order=LINEAGE):
    """Per importer: display name, counts per year, total and the place it was first seen."""
    return importer_totals_of(importer_tally(records, order), translations)


def importer_totals_of(tallied, translations=None):
    """As ``importer_totals``, from a tally.

    The display name is the lookup value, else the English name of the importer's first record with a
    usable year, else the Korean name.
    """
    by_year = tallied.groupBy("ko", "year").agg(F.sum("n").alias("n"), F.min("place").alias("place"))
    grouped = by_year.groupBy("ko").agg(
        # One entry per distinct year of the importer.
        F.sort_array(F.collect_list(F.struct("year", "n"))).alias("years"),
        F.sum("n").alias("total"),
        F.min("place").alias("place"),
    )
    # Places are unique per record, so the first one belongs to one name.
    grouped = grouped.join(tallied.select("ko", "place", "en"), ["ko", "place"])
    from_table = F.lit(None).cast("string")
    if translations is not None:
        # One row per importer on the left and per name on the right.
        named = translations.category("importer").select(F.col("key").alias("ko"), "value")
        grouped = grouped.join(named, "ko", "left")
        from_table = F.col("value")
    not_blank = lambda c: F.nullif(c, F.lit(""))
    return grouped.select(
        F.coalesce(not_blank(from_table), not_blank(F.col("en")), "ko").alias("importer_en"),
        _shown(F.col("ko")).alias("importer_ko"),
        F.map_from_entries("years").alias("year_counts"),
        "total",
        F.col("place").alias("first_seen"),
    )


def importer_ranking(totals):
    """Importers by total descending, then name, then first appearance; ``rank`` holds that order."""
    return with_global_rank(totals, [F.desc("total"), F.asc("importer_en"), F.asc("first_seen")]).drop(
        "first_seen"
    )


def year_counts_text(year_counts="year_counts"):
    """Year counts as ``2018:1,2019:2``, ascending."""
    entries = F.array_sort(F.map_entries(year_counts))
    return F.array_join(
        F.transform(entries, lambda e: F.concat_ws(":", e["key"].cast("string"), e["value"].cast("string"))),
        ",",
    )


def refresh_reports(store, translations=None):
    """Bring the four reports up to the stored records.

    Only publications that no tally covers are read; their tally is kept beside the earlier ones, and the
    reports are made from all tallies. They are published together: a reader sees the old ones or the new ones.
    """
    order = ["seq", *LINEAGE]
    records, upto = store.untallied()
    if records is not None:
        store.write_tallies(upto, tally(records), importer_tally(records, order))
    counts, importers = store.tallies("counts"), store.tallies("importers")
    if counts is None:
        # Nothing is stored yet: the reports of no records.
        records = store.published()
        counts, importers = tally(records), importer_tally(records, order)
    counts, importers = pinned(merged_tally(counts)), pinned(merged_importers(importers))
    store.write_reports(
        {
            "monthly_by_type": monthly_by_type(counts),
            "yearly_by_country": yearly_by_country(counts),
            "type_country_pivot": type_country_pivot(counts),
            "importers": importer_ranking(importer_totals_of(importers, translations)),
        }
    )
