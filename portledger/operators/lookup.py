"""The stacked lookup sheet: sections, key/value tables and translation with fallback."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from portledger.functions.text import safe_str, strip
from portledger.operators.joins import is_small, keyed_left_join, size_columns
from portledger.session import pinned

# The row that opens each section, and whether it is an entry itself.
SECTION_STARTS = {
    "country": ("뉴질랜드", "New Zealand", True),
    "product_type": ("Product name (Korean)", "Translation", False),
    "importer": ("Company Korean name", "Company English name", False),
    "exporter": ("Company", "Country", False),
}

# Rows per span of the section walk; a file has at most 2^31 / 2^16 spans.
SPAN_BITS = 16


def lookup_rows(grid):
    """Rows that have at least three cells and a non-blank second one, as ``(file, row_idx, key, value)``."""
    return (
        grid.where((F.size("cells") >= 3) & (safe_str(F.get("cells", F.lit(1))) != ""))
        .select(
            "file",
            "row_idx",
            safe_str(F.get("cells", F.lit(1))).alias("key"),
            safe_str(F.get("cells", F.lit(2))).alias("value"),
        )
    )


def _opened_section(key, value):
    opened = F.lit(None).cast("string")
    for name, (k, v, _) in SECTION_STARTS.items():
        opened = F.when((key == k) & (value == v), name).otherwise(opened)
    return opened


def _opens_without_entry(key, value):
    starts = [(k, v) for k, v, is_entry in SECTION_STARTS.values() if not is_entry]
    return F.struct(key.alias("k"), value.alias("v")).isin(
        [F.struct(F.lit(k).alias("k"), F.lit(v).alias("v")) for k, v in starts]
    )


def lookup_sections(rows):
    """Label every lookup row with the section open at that row; rows before any section drop out.

    A forward fill in two levels, so that no task holds a whole file: rows are filled inside spans of
    65,536 sheet positions, and the section a span starts with comes from a fill over the spans.
    """
    opened = rows.withColumn("_opened", _opened_section(F.col("key"), F.col("value"))).withColumn(
        "_span", F.shiftright("row_idx", SPAN_BITS)
    )
    opened_at = F.when(F.col("_opened").isNotNull(), F.col("row_idx"))
    earlier = Window.partitionBy("file").orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    spans = (
        opened.groupBy("file", "_span")
        .agg(F.max_by("_opened", opened_at).alias("_closing"))
        .select("file", "_span", F.last("_closing", ignorenulls=True).over(earlier).alias("_carried"))
    )
    inside = (
        Window.partitionBy("file", "_span").orderBy("row_idx").rowsBetween(Window.unboundedPreceding, 0)
    )
    filled = opened.withColumn("_open", F.last("_opened", ignorenulls=True).over(inside))
    return (
        filled.join(spans, ["file", "_span"])
        .withColumn("category", F.coalesce("_open", "_carried"))
        .where(F.col("category").isNotNull())
        .where(~_opens_without_entry(F.col("key"), F.col("value")))
        .select("file", "row_idx", "category", "key", "value")
    )


def lookup_table(sections):
    """``(category, key, value)``; blanks are left out and the last duplicate of a key wins."""
    return (
        sections.where((F.col("key") != "") & (F.col("value") != ""))
        .groupBy("category", "key")
        .agg(F.max_by("value", F.struct("file", "row_idx")).alias("value"))
    )


class Translations:
    """A lookup table built once per job, with the measured size of each category."""

    def __init__(self, table, max_bytes=None, max_rows=None):
        self.table = pinned(table)
        self.limits = (max_bytes, max_rows)
        # One row per category, and there are four categories.
        sizes = self.table.groupBy("category").agg(*size_columns(self.table)).collect()
        self.fits = {r["category"]: is_small(r, max_bytes, max_rows) for r in sizes}

    @classmethod
    def from_grid(cls, grid, **limits):
        return cls(lookup_table(lookup_sections(lookup_rows(grid))), **limits)

    def all_fit(self, categories):
        return all(self.fits.get(c, True) for c in categories)

    def used_by(self, df, sources):
        """The entries that ``df`` needs: one pass over all fields, ``sources`` being ``(category, field)`` pairs.

        Every field's key is one row; equal ones collapse before the shuffle, so a hot key is one row per task, and they
        meet the table once, on category and key.
        """
        pairs = F.array(*[F.struct(F.lit(c).alias("category"), strip(f).alias("key")) for c, f in sources])
        needed = df.select(F.explode(pairs).alias("p")).select("p.category", "p.key").distinct()
        return Translations(self.table.join(needed, ["category", "key"], "left_semi"), *self.limits)

    def category(self, name):
        return self.table.where(F.col("category") == name).select("key", "value")

    def translate(self, df, category, source, target, spread_by):
        """Add ``target``: the translation of ``source``, or its stripped text where there is none."""
        entries = self.category(category).select(
            F.col("key").alias("_key"), F.col("value").alias("_value")
        )
        joined = keyed_left_join(
            df.withColumn("_key", strip(source)),
            entries,
            "_key",
            spread_by,
            small_fits=self.fits.get(category, True),
        )
        return joined.withColumn(target, F.coalesce("_value", "_key")).drop("_key", "_value")
