"""The registered queries: every operator over the relations in ``fixtures``."""

from pyspark.sql import functions as F

from checks import fixtures as fx
from checks.workbooks import write_workbooks
from portledger.functions import classify, text
from portledger.operators import dedup, lookup, sheet
from portledger.plans import marts, records
from portledger.plans.ingest import historical_ingest, ledger_totals, weekly_ingest
from portledger.session import scratch_path
from portledger.sources.inbox import list_folder, pending_files
from portledger.sources.store import RecordStore
from portledger.sources.workbook import grid_of, scan_workbooks, whole_files

SEQ = ["seq"]
FILE_ORDER = ["src_file", "row_idx"]


# ---- inputs ---------------------------------------------------------------------------------------


def declarations(spark, sf):
    return fx.relation(spark, sf, fx.DECLARATIONS)


def declared(spark, sf):
    """Declarations with the weekly rules applied: date, parts, flags and stripped names."""
    raw = declarations(spark, sf)
    dated = raw.withColumn("date", text.weekly_date("date_raw")).withColumns(
        {
            **text.date_parts("date"),
            **classify.weekly_type_flags("product_type_ko"),
            "importer_ko": text.safe_str("importer_ko"),
        }
    )
    return dated.withColumn("src_file", F.col("file")).withColumn("row_idx", F.col("seq"))


def stored_and_incoming(spark, sf):
    """File f0 was stored by an earlier run; now all files come in, f0 among them."""
    everything = declared(spark, sf)
    return everything.where(F.col("src_file") == "f0"), everything


def _cells(relation, n):
    return relation.select("file", "row_idx", F.array(*[f"c{i}" for i in range(n)]).alias("cells"))


def weekly_grid(spark, sf):
    return _cells(fx.relation(spark, sf, fx.WEEKLY_GRID), 14)


def historical_grid(spark, sf):
    return _cells(fx.relation(spark, sf, fx.HISTORICAL_GRID), 17)


def lookup_grid(spark, sf):
    rows = fx.relation(spark, sf, fx.LOOKUP_SHEET_ROWS)
    return rows.select("file", "row_idx", F.array(F.lit(None).cast("string"), "b", "c").alias("cells"))


def translations(spark, sf):
    return lookup.Translations.from_grid(lookup_grid(spark, sf))


# ---- scans and sheets -----------------------------------------------------------------------------


def _weekly_folder(spark, sf):
    """The weekly workbooks as files in a fresh folder."""
    grid = _cells(fx.relation(spark, sf, fx.WEEKLY_WORKBOOKS), 14)
    return write_workbooks(grid, scratch_path(spark, "inbox"), lambda name, rows: {"data": rows, "notes": [["not this one"]]})


def _historical_folder(spark, sf):
    grid = _cells(fx.relation(spark, sf, fx.HISTORICAL_WORKBOOKS), 17)
    return write_workbooks(
        grid, scratch_path(spark, "history"), lambda name, rows: {"cover": [["cover"]], "import list": rows}
    )


def _name(path):
    return F.substring_index(path, "/", -1)


def workbook_scan(spark, sf):
    grid = weekly_grid(spark, sf)
    span = F.floor(F.col("row_idx") / fx.WORKBOOK_SPAN)
    placed = grid.select(
        F.concat("file", F.lit("-"), span.cast("string"), F.lit(".xlsx")).alias("file"),
        (F.col("row_idx") % fx.WORKBOOK_SPAN).alias("row_idx"),
        "cells",
    )
    sheets = lambda name, rows: {"data": rows, "notes": [["not this one"]]}
    folder = write_workbooks(placed, scratch_path(spark, "scan"), sheets)
    blocks, _ = whole_files(scan_workbooks(list_folder(spark, folder)))
    cells = [F.get("cells", F.lit(i)).alias(f"c{i}") for i in range(14)]
    return grid_of(blocks).select(_name("file").alias("file"), "row_idx", *cells)


def sheet_by_name(spark, sf):
    """Rows of the sheet "data", wherever it is; a workbook without it gives one row with its error."""
    grid = _cells(fx.relation(spark, sf, fx.WEEKLY_WORKBOOKS), 14)
    sheets = lambda name, rows: {"cover": [["cover"]], "other" if name[:2] == "g5" else "data": rows}
    folder = write_workbooks(grid, scratch_path(spark, "sheets"), sheets)
    blocks, bad = whole_files(scan_workbooks(list_folder(spark, folder), "data"))
    cells = [F.get("cells", F.lit(i)).alias(f"c{i}") for i in range(14)]
    rows = grid_of(blocks).select("file", "row_idx", *cells)
    errors = bad.select("file", F.lit(-1).alias("row_idx"), F.col("error").alias("c0"))
    both = rows.unionByName(errors, allowMissingColumns=True)
    return both.withColumn("file", _name("file"))


def header_rows(spark, sf):
    return sheet.header_rows(weekly_grid(spark, sf), sheet.WEEKLY)


def fixed_header(spark, sf):
    return _named(sheet.rows_of_grid(historical_grid(spark, sf), sheet.HISTORICAL), sheet.HISTORICAL)


def schema_check(spark, sf):
    weekly = sheet.schema_check(weekly_grid(spark, sf), sheet.WEEKLY)
    return weekly.unionByName(sheet.schema_check(historical_grid(spark, sf), sheet.HISTORICAL))


def _named(rows, layout):
    return sheet.cells_to_columns(rows, layout)


def cells_to_columns(spark, sf):
    return _named(sheet.rows_of_grid(weekly_grid(spark, sf), sheet.WEEKLY), sheet.WEEKLY)


def drop_blank_rows(spark, sf):
    return sheet.drop_blank_rows(weekly_grid(spark, sf)).select("file", "row_idx")


def read_records(spark, sf):
    """Store file f0, then all files twice, and read everything back."""
    stored, incoming = stored_and_incoming(spark, sf)
    store = RecordStore(spark, scratch_path(spark, "store"))
    for batch_id, part in [("a", stored), ("b", incoming), ("c", incoming)]:
        store.append(part.withColumn("row_idx", F.col("row_idx").cast("int")), batch_id)
    return store.records().select(
        "batch_id", "yr", "src_file", "row_idx", "date", "importer_ko", "product_ko", "type_frozen", "report_no"
    )


def pending(spark, sf):
    listing, ledger = (fx.relation(spark, sf, s) for s in (fx.LISTING, fx.LEDGER))
    return pending_files(listing, ledger, "in").orderBy("path")


# ---- jobs -----------------------------------------------------------------------------------------


def _entries(ledger, *more):
    counts = ["status", "parsed", "written", "skipped", "errors", "message"]
    return ledger.select(*more, _name("path").alias("file"), *counts)


def _weekly_run(spark, sf):
    store = RecordStore(spark, scratch_path(spark, "store"))
    folder, names = _weekly_folder(spark, sf), translations(spark, sf)
    return store, folder, names, weekly_ingest(spark, folder, store, names, "w1")


def weekly_job(spark, sf):
    return _entries(_weekly_run(spark, sf)[3])


def weekly_job_records(spark, sf):
    store = _weekly_run(spark, sf)[0]
    return store.records().withColumn("src_file", _name("src_file"))


def repeat_batch(spark, sf):
    """The weekly job, the job again, and one of its files again by name: the ledger of all three."""
    store, folder, names, _ = _weekly_run(spark, sf)
    weekly_ingest(spark, folder, store, names, "w1")
    weekly_ingest(spark, folder, store, names, "w2", single_file=f"{folder}/g0-0.xlsx")
    return _entries(store.ledger(), "batch_id")


def backfill_two_sources(spark, sf):
    """Historical workbooks, then weekly ones into the same store: the ledger of both."""
    store = RecordStore(spark, scratch_path(spark, "store"))
    historical_ingest(spark, _historical_folder(spark, sf), store)
    weekly_ingest(spark, _weekly_folder(spark, sf), store, translations(spark, sf), "w1")
    return _entries(store.ledger(), "batch_id")


def reports_of_store(spark, sf):
    """Reports kept up over two appends, the importer report and the monthly counts as one relation."""
    stored, incoming = stored_and_incoming(spark, sf)
    store = RecordStore(spark, scratch_path(spark, "store"))
    for batch_id, part in [("a", stored), ("b", incoming)]:
        store.append(part.withColumn("row_idx", F.col("row_idx").cast("int")), batch_id)
        marts.refresh_reports(store)
    importers = store.report("importers").select(
        F.lit("importers").alias("report"),
        F.concat_ws("|", "importer_ko", "importer_en", marts.year_counts_text()).alias("entry"),
        "total",
        F.col("rank").cast("bigint").alias("place"),
    )
    monthly = store.report("monthly_by_type").select(
        F.lit("monthly").alias("report"),
        F.concat_ws("|", *[F.col(c).cast("string") for c in ("year", "month", "frozen", "dried", "ambiguous")]).alias("entry"),
        "total",
        F.lit(None).cast("bigint").alias("place"),
    )
    return importers.unionByName(monthly)


# ---- scalar rules ---------------------------------------------------------------------------------


def strip_fields(spark, sf):
    fields = ["date_raw", "importer_ko", "importer_en", "product_ko"]
    return declarations(spark, sf).select("seq", *[text.safe_str(c).alias(c) for c in fields])


def weekly_dates(spark, sf):
    return declarations(spark, sf).select("seq", text.weekly_date("date_raw").alias("date"))


def historical_dates(spark, sf):
    fields = [*FILE_ORDER, "date", "expiry_date", "year", "month", "day"]
    return historical(spark, sf).select(*fields)


def date_parts(spark, sf):
    return declared(spark, sf).select("seq", "date", "year", "month", "day")


def weekly_type(spark, sf):
    return declared(spark, sf).select("seq", "type_frozen", "type_dried", "type_ambiguous")


def historical_type(spark, sf):
    flags = classify.historical_type_flags("product_type_ko", "product_type_en")
    return declarations(spark, sf).withColumns(flags).select("seq", *flags)


def product_predicates(spark, sf):
    name = F.col("product_type_ko")
    return declarations(spark, sf).select(
        "seq",
        classify.is_frozen_product(name).alias("is_frozen"),
        classify.is_dried_product(name).alias("is_dried"),
    )


def type_label(spark, sf):
    return declared(spark, sf).select("seq", classify.type_label().alias("ptype"))


def country_bucket(spark, sf):
    return declarations(spark, sf).select("seq", classify.country_bucket().alias("country"))


def lenient_int(spark, sf):
    number = [text.lenient_int(c).alias(f"{c}_i") for c in ("year", "month", "day")]
    return declared(spark, sf).select("seq", "year", *number)


def numeric_text(spark, sf):
    return records.typed(weekly(spark, sf)).select(
        *FILE_ORDER,
        "weight_kg",
        "quantity",
        F.col("weight_kg_d").cast("double").alias("weight_kg_d"),
        F.col("quantity_d").cast("double").alias("quantity_d"),
    )


def dedup_keys(spark, sf):
    return dedup.dedup_keys(declared(spark, sf)).distinct()


# ---- lookups --------------------------------------------------------------------------------------


def lookup_rows(spark, sf):
    return lookup.lookup_rows(lookup_grid(spark, sf))


def lookup_sections(spark, sf):
    return lookup.lookup_sections(lookup.lookup_rows(lookup_grid(spark, sf)))


def lookup_table(spark, sf):
    return lookup.lookup_table(lookup_sections(spark, sf))


def _translated(df, spark, sf, category, source):
    out = translations(spark, sf).translate(df.select("seq", source), category, source, "translated", SEQ)
    return out.select("seq", "translated")


def translate_country(spark, sf):
    return _translated(declarations(spark, sf), spark, sf, "country", "country_export_ko")


def translate_product_type(spark, sf):
    return _translated(declarations(spark, sf), spark, sf, "product_type", "product_type_ko")


def translate_importer(spark, sf):
    return _translated(declarations(spark, sf), spark, sf, "importer", "importer_ko")


def exporter_country(spark, sf):
    return _translated(fx.relation(spark, sf, fx.EXPORTERS), spark, sf, "exporter", "exporter_en")


# ---- records and dedup ----------------------------------------------------------------------------


def weekly(spark, sf):
    return records.weekly_records(
        sheet.rows_of_grid(weekly_grid(spark, sf), sheet.WEEKLY), translations(spark, sf)
    )


def historical(spark, sf):
    return records.historical_records(sheet.rows_of_grid(historical_grid(spark, sf), sheet.HISTORICAL))


def weekly_records(spark, sf):
    return weekly(spark, sf)


def historical_records(spark, sf):
    return records.aligned(historical(spark, sf))


def unified_records(spark, sf):
    return records.unified(historical(spark, sf), weekly(spark, sf))


def _key_view(df):
    return df.select("file", "seq", "date", "importer_ko", "product_ko")


def dedup_first_wins(spark, sf):
    return _key_view(dedup.dedup_first_wins(declared(spark, sf)))


def new_records(spark, sf):
    stored, incoming = stored_and_incoming(spark, sf)
    return _key_view(dedup.new_records(incoming, stored))


def ingest_counters(spark, sf):
    stored, incoming = stored_and_incoming(spark, sf)
    written = dedup.new_records(incoming, stored)
    files = incoming.select("src_file", F.lit(None).cast("string").alias("message")).distinct()
    counted = dedup.ingest_counters(files, incoming, written)
    return ledger_totals(counted.withColumnRenamed("src_file", "path"))


# ---- reports --------------------------------------------------------------------------------------


def monthly_by_type(spark, sf):
    return marts.monthly_by_type(marts.tally(declared(spark, sf)))


def yearly_by_country(spark, sf):
    return marts.yearly_by_country(marts.tally(declared(spark, sf)))


def type_country_pivot(spark, sf):
    return marts.type_country_pivot(marts.tally(declared(spark, sf)))


def type_country_pivot_year(spark, sf):
    return marts.type_country_pivot(marts.tally(declared(spark, sf)), year=1997)


def type_country_pivot_year0(spark, sf):
    return marts.type_country_pivot(marts.tally(declared(spark, sf)), year=0)


def importer_years(spark, sf):
    return marts.importer_years(declared(spark, sf), SEQ)


def importer_names(spark, sf):
    totals = marts.importer_totals(declared(spark, sf), translations(spark, sf), SEQ)
    return totals.select("importer_ko", "importer_en")


def importer_totals(spark, sf):
    totals = marts.importer_totals(declared(spark, sf), order=SEQ)
    counts = marts.year_counts_text().alias("year_counts")
    return totals.select("importer_en", "importer_ko", counts, "total")


def importer_ranking(spark, sf):
    ranked = marts.importer_ranking(marts.importer_totals(declared(spark, sf), order=SEQ))
    return ranked.select("rank", "importer_en", "importer_ko", "total")


QUERIES = {
    "workbook_scan": workbook_scan,
    "sheet_by_name": sheet_by_name,
    "weekly_job": weekly_job,
    "weekly_job_records": weekly_job_records,
    "repeat_batch": repeat_batch,
    "backfill_two_sources": backfill_two_sources,
    "reports_of_store": reports_of_store,
    "header_rows": header_rows,
    "fixed_header": fixed_header,
    "schema_check": schema_check,
    "cells_to_columns": cells_to_columns,
    "drop_blank_rows": drop_blank_rows,
    "pending_files": pending,
    "read_records": read_records,
    "strip_fields": strip_fields,
    "weekly_dates": weekly_dates,
    "historical_dates": historical_dates,
    "date_parts": date_parts,
    "weekly_type": weekly_type,
    "historical_type": historical_type,
    "product_predicates": product_predicates,
    "type_label": type_label,
    "country_bucket": country_bucket,
    "lenient_int": lenient_int,
    "numeric_text": numeric_text,
    "dedup_keys": dedup_keys,
    "lookup_rows": lookup_rows,
    "lookup_sections": lookup_sections,
    "lookup_table": lookup_table,
    "translate_country": translate_country,
    "translate_product_type": translate_product_type,
    "translate_importer": translate_importer,
    "exporter_country": exporter_country,
    "weekly_records": weekly_records,
    "historical_records": historical_records,
    "unified_records": unified_records,
    "dedup_first_wins": dedup_first_wins,
    "new_records": new_records,
    "ingest_counters": ingest_counters,
    "monthly_by_type": monthly_by_type,
    "yearly_by_country": yearly_by_country,
    "type_country_pivot": type_country_pivot,
    "type_country_pivot_year": type_country_pivot_year,
    "type_country_pivot_year0": type_country_pivot_year0,
    "importer_years": importer_years,
    "importer_names": importer_names,
    "importer_totals": importer_totals,
    "importer_ranking": importer_ranking,
}
