"""From sheet rows to the 25-column record."""

from pyspark.sql import functions as F

from portledger.functions import classify, text
from portledger.operators.sheet import HISTORICAL, WEEKLY, cells_to_columns
from portledger.schema import FLAG_COLUMNS, HISTORICAL_COLUMNS, LINEAGE, RECORD_COLUMNS, WEEKLY_COLUMNS
from portledger.session import pinned

# Source marks.
WEEKLY_SOURCE = "mfds"
HISTORICAL_SOURCE = "historical"

# Translated field -> (lookup category, field it is looked up by).
TRANSLATED = {
    "importer_en": ("importer", "importer_ko"),
    "product_type_en": ("product_type", "product_type_ko"),
    "country_export_en": ("country", "country_export_ko"),
    "country_origin_en": ("country", "country_origin_ko"),
}

DATES = ("date", "expiry_date")


def _clean(rows, layout, date_rule):
    named = cells_to_columns(rows, layout, dates=DATES)
    fields = [f for _, f in layout.headers]
    passed = [c for c in named.columns if c not in fields and not c.endswith("_cell")]
    return named.select(
        *passed,
        *[
            (date_rule(f, F.col(f"{f}_cell")) if f in DATES else text.safe_str(f)).alias(f)
            for f in fields
        ],
    )


def _passed_on(df):
    return [c for c in ("message",) if c in df.columns]


def weekly_fields(rows):
    """Weekly rows before translation: parts from the date, three type flags, source mark."""
    return _clean(rows, WEEKLY, text.weekly_date).withColumns(
        {
            **text.date_parts("date"),
            **classify.weekly_type_flags("product_type_ko"),
            "source": F.lit(WEEKLY_SOURCE),
        }
    )


def translated(fields, translations):
    """Weekly records: the English names are looked up, unknown names keep their text.

    Where a category is too large to copy, the rows are written down first, so whatever made them runs once, and the
    lookup is reduced to the names they hold, for all fields together.
    """
    if not translations.all_fit(c for c, _ in TRANSLATED.values()):
        fields = pinned(fields)
        translations = translations.used_by(fields, sorted(set(TRANSLATED.values())))
    for target, (category, source) in TRANSLATED.items():
        fields = translations.translate(fields, category, source, target, spread_by=LINEAGE)
    return fields.select(*WEEKLY_COLUMNS, *LINEAGE)


def weekly_records(rows, translations):
    return translated(weekly_fields(rows), translations)


def historical_records(rows):
    """Records of historical rows: parts and both languages come from the sheet's own columns."""
    clean = _clean(rows, HISTORICAL, text.historical_date)
    flagged = clean.withColumns(
        {
            **classify.historical_type_flags("product_type_ko", "product_type_en"),
            "source": F.lit(HISTORICAL_SOURCE),
        }
    )
    return flagged.select(*HISTORICAL_COLUMNS, *LINEAGE, *_passed_on(flagged))


def aligned(records):
    """The 25 stored columns by name: what is missing becomes empty, what is unknown is dropped."""
    missing = [c for c in RECORD_COLUMNS if c not in records.columns]
    blank = {c: F.lit(None).cast("boolean") if c in FLAG_COLUMNS else F.lit("") for c in missing}
    filled = records.withColumns(blank) if blank else records
    kept = [c for c in RECORD_COLUMNS if c not in FLAG_COLUMNS and c not in missing]
    return filled.na.fill("", kept).select(*RECORD_COLUMNS, *LINEAGE, *_passed_on(records))


def unified(*sources):
    """Records of several sources in the stored layout."""
    first, *rest = [aligned(s) for s in sources]
    for other in rest:
        first = first.unionByName(other, allowMissingColumns=True)
    return first


def typed(records):
    """Records with typed siblings of the text columns; the text stays the record's value."""
    return records.withColumns(
        {
            "year_i": text.lenient_int("year"),
            "month_i": text.lenient_int("month"),
            "date_d": text.date_value("date"),
            "weight_kg_d": text.decimal_value("weight_kg"),
            "quantity_d": text.decimal_value("quantity"),
        }
    )
