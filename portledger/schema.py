"""Column layouts shared by every step.

The lists below are fixed values: header texts and field names are part of the data contract.
"""

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# Weekly workbook header -> field name.
WEEKLY_HEADERS = {
    "처리일자": "date",
    "수입업체": "importer_ko",
    "신고번호": "report_no",
    "품목제조번호": "item_no",
    "제품명(한글)": "product_ko",
    "제품명(영문)": "product_en",
    "품목류": "product_type_ko",
    "수출국": "country_export_ko",
    "제조국": "country_origin_ko",
    "제조사(영문)": "exporter_en",
    "순중량(KG)": "weight_kg",
    "수량(갯수)": "quantity",
    "유통기한": "expiry_date",
    "원산지": "country_origin_raw",
}

# Historical sheet header -> field name.
HISTORICAL_HEADERS = {
    "Year": "year",
    "Month": "month",
    "Day": "day",
    "Importer": "importer_en",
    "Translation of type": "product_type_en",
    "Country of origin": "country_origin_en",
    "Country of export": "country_export_en",
    "Importer (Korean)": "importer_ko",
    "Product name (Korean)": "product_ko",
    "Product name (English)": "product_en",
    "Product type (Korean)": "product_type_ko",
    "Exporter (English)": "exporter_en",
    "Date": "date",
    "Expire date start from": "expiry_date",
    "Country of origin (KR)": "country_origin_ko",
    "Country of export (KR)": "country_export_ko",
}

# Sheet names.
HISTORICAL_SHEET = "import list"
LOOKUP_SHEET = "Names for Vlookup"

# Output field order of each source.
HISTORICAL_COLUMNS = [
    "year", "month", "day", "date",
    "importer_en", "importer_ko",
    "product_ko", "product_en",
    "product_type_ko", "product_type_en",
    "country_origin_en", "country_origin_ko",
    "country_export_en", "country_export_ko",
    "exporter_en", "expiry_date",
    "type_frozen", "type_dried", "type_ambiguous",
    "source",
]
WEEKLY_ONLY_COLUMNS = ["report_no", "item_no", "weight_kg", "quantity", "country_origin_raw"]
WEEKLY_COLUMNS = [
    "year", "month", "day", "date",
    "importer_en", "importer_ko",
    "product_ko", "product_en",
    "product_type_ko", "product_type_en",
    "country_origin_en", "country_origin_ko",
    "country_export_en", "country_export_ko",
    "exporter_en", "expiry_date",
    "report_no", "item_no", "weight_kg", "quantity", "country_origin_raw",
    "type_frozen", "type_dried", "type_ambiguous",
    "source",
]

# Stored order: the historical columns, then what only the weekly source has.
RECORD_COLUMNS = HISTORICAL_COLUMNS + WEEKLY_ONLY_COLUMNS
FLAG_COLUMNS = ["type_frozen", "type_dried", "type_ambiguous"]

# A record is a repeat when these three agree.
DEDUP_KEY = ["date", "importer_ko", "product_ko"]

# Where a row came from. A DataFrame has no order, so every first-wins / last-wins rule uses this.
LINEAGE = ["src_file", "row_idx"]

HEADER_SEARCH_ROWS = 5
HEADER_MATCH_COLUMNS = 7


def _record_fields():
    return [
        StructField(c, BooleanType() if c in FLAG_COLUMNS else StringType()) for c in RECORD_COLUMNS
    ]


_LINEAGE_FIELDS = [StructField("src_file", StringType()), StructField("row_idx", IntegerType())]

RECORD_SCHEMA = StructType(_record_fields() + _LINEAGE_FIELDS)

# The record table is laid out as batch_id=<id>/yr=<year of the record date, or "none">.
STORED_SCHEMA = StructType(
    RECORD_SCHEMA.fields + [StructField("batch_id", StringType()), StructField("yr", StringType())]
)

# What the binaryFile source gives.
FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"

SHEET_ROW = StructType(
    [
        StructField("row_idx", IntegerType()),
        StructField("cells", ArrayType(StringType())),
        StructField("dated", ArrayType(IntegerType())),
    ]
)

# One decoded run of sheet rows; every block of a file carries the first rows of the sheet.
BLOCK_SCHEMA = StructType(
    [
        StructField("file", StringType()),
        StructField("sheet", StringType()),
        StructField("block", IntegerType()),
        StructField("head", ArrayType(SHEET_ROW)),
        StructField("rows", ArrayType(SHEET_ROW)),
        StructField("error", StringType()),
    ]
)

LEDGER_SCHEMA = StructType(
    [
        StructField("path", StringType()),
        StructField("modification_time", TimestampType()),
        StructField("length", LongType()),
        StructField("status", StringType()),
        StructField("parsed", LongType()),
        StructField("written", LongType()),
        StructField("skipped", LongType()),
        StructField("errors", LongType()),
        StructField("message", StringType()),
        StructField("batch_id", StringType()),
    ]
)
