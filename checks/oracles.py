"""What each registered query must return, as DuckDB SQL over the same relations."""

from checks import fixtures as fx
from checks.fixtures import in_duckdb

# Header texts, their fields, and field order, as the data contract has them.
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
RECORD_COLUMNS = (
    "year month day date importer_en importer_ko product_ko product_en product_type_ko product_type_en "
    "country_origin_en country_origin_ko country_export_en country_export_ko exporter_en expiry_date "
    "type_frozen type_dried type_ambiguous source report_no item_no weight_kg quantity country_origin_raw "
).split()
WEEKLY_COLUMNS = (
    "year month day date importer_en importer_ko product_ko product_en product_type_ko product_type_en "
    "country_origin_en country_origin_ko country_export_en country_export_ko exporter_en expiry_date "
    "report_no item_no weight_kg quantity country_origin_raw type_frozen type_dried type_ambiguous source "
).split()

F, G, H, L = (
    in_duckdb(s)
    for s in (fx.DECLARATIONS, fx.WEEKLY_GRID, fx.HISTORICAL_GRID, fx.LOOKUP_SHEET_ROWS)
)


def _date(c):
    return (
        f"CASE WHEN TRIM(COALESCE({c},'')) IN ('','-') THEN '' "
        f"ELSE REGEXP_REPLACE(TRIM({c}), '^([0-9]{{4}})([0-9]{{2}})([0-9]{{2}})$', '\\1-\\2-\\3') END"
    )


def _plain_date(c):
    return f"CASE WHEN TRIM(COALESCE({c},'')) IN ('','-') THEN '' ELSE TRIM({c}) END"


def _part(c, start, size):
    return f"CASE WHEN LENGTH({c}) = 10 THEN SUBSTRING({c},{start},{size}) ELSE '' END"


PARTS = ", ".join(
    f"{_part('date', s, n)} AS {name}" for name, s, n in [("year", 1, 4), ("month", 6, 2), ("day", 9, 2)]
)


def _int(c):
    return (
        f"CASE WHEN COALESCE({c},'') = '' THEN 0 "
        f"WHEN REGEXP_MATCHES(TRIM({c}), '^[+-]?[0-9]+$') THEN TRY_CAST(TRIM({c}) AS BIGINT) END"
    )


def _weekly_flags(c):
    frozen = f"(CONTAINS({c},'냉동') OR CONTAINS({c},'생녹용'))"
    dried = f"(CONTAINS({c},'건조') OR (CONTAINS({c},'건') AND NOT CONTAINS({c},'건강') AND NOT {frozen}))"
    return _flags(frozen, dried)


def _historical_flags(ko, en):
    ko = f"TRIM(COALESCE({ko},''))"
    en = f"LOWER(TRIM(COALESCE({en},'')))"
    frozen = (
        f"(CASE WHEN {ko} <> '' THEN CONTAINS({ko},'냉동') OR CONTAINS({ko},'생녹용') ELSE CONTAINS({en},'frozen') END)"
    )
    dried = (
        f"(CASE WHEN {ko} <> '' THEN CONTAINS({ko},'건조') OR (STARTS_WITH({ko},'건') AND NOT CONTAINS({ko},'건강')) "
        f"ELSE CONTAINS({en},'dried') END)"
    )
    return _flags(frozen, dried)


def _flags(frozen, dried):
    return (
        f"{frozen} AND NOT {dried} AS type_frozen, {dried} AND NOT {frozen} AS type_dried, "
        f"({frozen} AND {dried}) OR NOT ({frozen} OR {dried}) AS type_ambiguous"
    )


LABEL = "CASE WHEN type_frozen THEN 'frozen' WHEN type_dried THEN 'dried' ELSE 'ambiguous' END"
BUCKET = """CASE WHEN CONTAINS(country_export_en,'New Zealand') OR CONTAINS(country_export_ko,'뉴질랜드') THEN 'NZ'
  WHEN CONTAINS(country_export_en,'Russia') OR CONTAINS(country_export_ko,'러시아') THEN 'Russia'
  WHEN CONTAINS(country_export_en,'China') OR CONTAINS(country_export_ko,'중국') THEN 'China' ELSE 'Other' END"""

# R: declarations with the weekly rules applied.
R = f"""f AS ({F}), f1 AS (SELECT *, {_date('date_raw')} AS date FROM f),
r AS (SELECT seq, file, date, TRIM(importer_ko) AS importer_ko, TRIM(importer_en) AS importer_en, product_ko,
  product_type_ko, country_export_en, country_export_ko, {PARTS}, {_weekly_flags('product_type_ko')} FROM f1)"""

# C: counted declarations, with numbers and labels.
C = f"""{R}, c AS (SELECT *, {_int('year')} AS y, {_int('month')} AS m, {LABEL} AS ptype, {BUCKET} AS country FROM r)"""


def _n(column, value, name):
    return f"CAST(COALESCE(SUM(CASE WHEN {column} = '{value}' THEN 1 ELSE 0 END), 0) AS BIGINT) AS {name}"


BY_TYPE = ", ".join(_n("ptype", t, t) for t in ("frozen", "dried", "ambiguous"))
BY_COUNTRY = ", ".join(
    _n("country", c, c.lower()) for c in ("NZ", "Russia", "China", "Other")
)


def _pivot(where):
    return f"""WITH {C}, kept AS (SELECT * FROM c {where}),
counted AS (SELECT ptype, country FROM kept UNION ALL SELECT 'total', country FROM kept),
rows4 AS (SELECT * FROM (VALUES ('frozen'),('dried'),('ambiguous'),('total')) AS t(ptype))
SELECT rows4.ptype, {BY_COUNTRY} FROM rows4 LEFT JOIN counted ON rows4.ptype = counted.ptype GROUP BY rows4.ptype"""


# ---- grids ----------------------------------------------------------------------------------------


def _list(texts):
    return "[" + ", ".join(f"'{t}'" for t in texts) + "]"


def _grid(sql, n, header, expected, prefix):
    """CTEs: cells, header names per file, missing headers, usable data rows (prefixed)."""
    p = prefix
    cells = ", ".join(f"c{i}" for i in range(n))
    texts = _list(expected)
    return f"""{p}g AS ({sql}), {p}c AS (SELECT file, row_idx, [{cells}] AS cells FROM {p}g),
{p}n AS (SELECT file, row_idx, LIST_TRANSFORM(cells, lambda x: TRIM(COALESCE(x,''))) AS names FROM {p}c WHERE row_idx < 5),
{p}f AS (SELECT DISTINCT file FROM {p}c),
{p}h0 AS (SELECT file, MIN(row_idx) AS header_row FROM {p}n WHERE {header} GROUP BY file),
{p}h AS (SELECT {p}h0.file, header_row, names FROM {p}h0 JOIN {p}n ON {p}h0.file = {p}n.file AND {p}h0.header_row = {p}n.row_idx),
{p}m AS (SELECT file, header_row, names, LIST_FILTER({texts}, lambda t: NOT LIST_CONTAINS(names, t)) AS missing FROM {p}h),
{p}d AS (SELECT {p}c.file, {p}c.row_idx, cells, names FROM {p}c JOIN {p}m ON {p}c.file = {p}m.file
  WHERE LEN(missing) = 0 AND {p}c.row_idx > header_row
    AND LEN(LIST_FILTER(cells, lambda x: TRIM(COALESCE(x,'')) <> '')) > 0)"""


_W7 = _list(list(WEEKLY_HEADERS)[:7])
GW = _grid(G, 14, f"LIST_HAS_ALL(names, {_W7})", WEEKLY_HEADERS, "w")
GH = _grid(H, 17, "row_idx = 1", HISTORICAL_HEADERS, "h")


def _at(header):
    # Position of the last header with that text.
    return f"COALESCE(cells[LEN(names) + 1 - LIST_POSITION(LIST_REVERSE(names), '{header}')], '')"


def _picked(headers):
    return ", ".join(f"{_at(h)} AS {f}" for h, f in headers.items())


def _status(p):
    return f"""SELECT {p}f.file, header_row, COALESCE(LEN(missing) = 0, FALSE) AS ok, ARRAY_TO_STRING(missing, ',') AS missing
FROM {p}f LEFT JOIN {p}m ON {p}f.file = {p}m.file"""


# ---- lookups --------------------------------------------------------------------------------------

LS = f"""l AS ({L}),
lr AS (SELECT file, row_idx, TRIM(b) AS key, TRIM(COALESCE(c,'')) AS value FROM l WHERE TRIM(COALESCE(b,'')) <> ''),
lo AS (SELECT *, CASE WHEN key = '뉴질랜드' AND value = 'New Zealand' THEN 'country'
    WHEN key = 'Product name (Korean)' AND value = 'Translation' THEN 'product_type'
    WHEN key = 'Company Korean name' AND value = 'Company English name' THEN 'importer'
    WHEN key = 'Company' AND value = 'Country' THEN 'exporter' END AS opened FROM lr),
lf AS (SELECT *, LAST_VALUE(opened IGNORE NULLS) OVER (PARTITION BY file ORDER BY row_idx
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS category FROM lo),
ls AS (SELECT file, row_idx, category, key, value FROM lf
  WHERE category IS NOT NULL AND (opened IS NULL OR opened = 'country')),
lt AS (SELECT category, key, ARG_MAX(value, row_idx) AS value FROM ls WHERE key <> '' AND value <> '' GROUP BY category, key)"""


def _translate(base, category, source):
    return f"""WITH {LS}, b AS ({base})
SELECT seq, COALESCE(lt.value, TRIM(b.{source})) AS translated
FROM b LEFT JOIN lt ON lt.category = '{category}' AND lt.key = TRIM(b.{source})"""


def _looked_up(category, source):
    return f"COALESCE((SELECT value FROM lt WHERE category = '{category}' AND key = w.{source}), w.{source})"


# ---- records --------------------------------------------------------------------------------------


def _clean(headers, date_rule):
    return ", ".join(
        f"{date_rule(f) if f in ('date', 'expiry_date') else f'TRIM({f})'} AS {f}" for f in headers.values()
    )


WEEKLY = f"""{GW}, {LS}, w0 AS (SELECT file, row_idx, {_picked(WEEKLY_HEADERS)} FROM wd),
w AS (SELECT file, row_idx, {_clean(WEEKLY_HEADERS, _date)} FROM w0),
weekly AS (SELECT {PARTS}, {_weekly_flags('product_type_ko')}, 'mfds' AS source, w.*,
  file AS src_file, COALESCE(i.value, importer_ko) AS importer_en, COALESCE(p.value, product_type_ko) AS product_type_en,
  COALESCE(e.value, country_export_ko) AS country_export_en, COALESCE(o.value, country_origin_ko) AS country_origin_en
  FROM w LEFT JOIN lt i ON i.category = 'importer' AND i.key = importer_ko
  LEFT JOIN lt p ON p.category = 'product_type' AND p.key = product_type_ko
  LEFT JOIN lt e ON e.category = 'country' AND e.key = country_export_ko
  LEFT JOIN lt o ON o.category = 'country' AND o.key = country_origin_ko)"""

HISTORICAL = f"""{GH}, x0 AS (SELECT file, row_idx, {_picked(HISTORICAL_HEADERS)} FROM hd),
x AS (SELECT file, row_idx, {_clean(HISTORICAL_HEADERS, _plain_date)} FROM x0),
historical AS (SELECT x.*, file AS src_file, {_historical_flags('product_type_ko', 'product_type_en')}, 'historical' AS source,
  '' AS report_no, '' AS item_no, '' AS weight_kg, '' AS quantity, '' AS country_origin_raw FROM x)"""

LINEAGE = "src_file, row_idx"

# JOB: what the weekly job makes of the workbooks; ``jn`` counts per file, ``jwin`` are the records.
JW, JH = in_duckdb(fx.WEEKLY_WORKBOOKS), in_duckdb(fx.HISTORICAL_WORKBOOKS)
GJ = _grid(JW, 14, f"LIST_HAS_ALL(names, {_W7})", WEEKLY_HEADERS, "j")
GK = _grid(JH, 17, "row_idx = 1", HISTORICAL_HEADERS, "k")
YEAR = "CASE WHEN REGEXP_MATCHES(date, '^[0-9]{4}-[0-9]{2}-[0-9]{2}$') THEN SUBSTRING(date,1,4) ELSE 'none' END AS yr"
JOB_ROWS = f"""{GJ}, j0 AS (SELECT file, row_idx, {_picked(WEEKLY_HEADERS)} FROM jd),
jr AS (SELECT file, row_idx, {_clean(WEEKLY_HEADERS, _date)} FROM j0)"""
JOB = f"""{JOB_ROWS}, jwin AS (
  SELECT * FROM jr QUALIFY ROW_NUMBER() OVER (PARTITION BY date, importer_ko, product_ko ORDER BY file, row_idx) = 1)"""
BACKFILL_ROWS = f"""{GK}, k0 AS (SELECT file, row_idx, {_picked(HISTORICAL_HEADERS)} FROM kd),
kr AS (SELECT file, row_idx, {_clean(HISTORICAL_HEADERS, _plain_date)} FROM k0),
kwin AS (SELECT * FROM kr QUALIFY ROW_NUMBER() OVER (PARTITION BY date, importer_ko, product_ko ORDER BY file, row_idx) = 1)"""


def _job_entries(p, win, texts, seven):
    """Ledger rows of the grid CTEs with prefix ``p`` and written records ``win``."""
    return f"""SELECT {p}f.file, CASE WHEN header_row IS NULL OR LEN(missing) > 0 THEN 'failed' WHEN COALESCE(n, 0) = 0 THEN 'empty' ELSE 'done' END AS status,
  COALESCE(n, 0)::BIGINT AS parsed, COALESCE(w, 0)::BIGINT AS written, (COALESCE(n, 0) - COALESCE(w, 0))::BIGINT AS skipped,
  CASE WHEN header_row IS NULL OR LEN(missing) > 0 THEN 1 ELSE 0 END::BIGINT AS errors,
  CASE WHEN header_row IS NULL THEN 'header row not found, expected at least: {seven}'
    WHEN LEN(missing) > 0 THEN 'missing columns: ' || ARRAY_TO_STRING(missing, ', ') END AS message
FROM {p}f LEFT JOIN {p}m ON {p}f.file = {p}m.file
  LEFT JOIN (SELECT file, COUNT(*) AS n FROM {p}r GROUP BY file) a ON a.file = {p}f.file
  LEFT JOIN (SELECT file, COUNT(*) AS w FROM {win} GROUP BY file) b ON b.file = {p}f.file"""


JOB_ENTRIES = _job_entries("j", "jwin", WEEKLY_HEADERS, ", ".join(list(WEEKLY_HEADERS)[:7]))
BACKFILL_ENTRIES = _job_entries("k", "kwin", HISTORICAL_HEADERS, ", ".join(list(HISTORICAL_HEADERS)[:7]))
AFTER_ENTRIES = _job_entries("j", "jafter", WEEKLY_HEADERS, ", ".join(list(WEEKLY_HEADERS)[:7]))

KEY = "date, importer_ko, product_ko"
FIRSTS = f"""firsts AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY {KEY} ORDER BY file, seq) AS rn FROM r) t WHERE rn = 1),
stored AS (SELECT DISTINCT {KEY} FROM r WHERE file = 'f0'),
fresh AS (SELECT firsts.* FROM firsts ANTI JOIN stored USING ({KEY}))"""

# A: declarations by importer, valid years only.
A = f"""{C}, a AS (SELECT *, CASE WHEN importer_ko = '' THEN '__unknown__' ELSE importer_ko END AS ko FROM c WHERE y <> 0),
per_year AS (SELECT ko, y, COUNT(*) AS n FROM a GROUP BY ko, y),
who AS (SELECT ko, COUNT(*) AS total, ARG_MIN(importer_en, seq) AS first_en, MIN(seq) AS first_seq FROM a GROUP BY ko),
named AS (SELECT CASE WHEN ko = '__unknown__' THEN '' ELSE ko END AS importer_ko,
  COALESCE(NULLIF(first_en,''), ko) AS importer_en, ko, total, first_seq FROM who)"""

TRANSLATED_FIELDS = ["importer_en", "product_type_en", "country_export_en", "country_origin_en"]

ORACLES = {
    "workbook_scan": f"""WITH g AS ({G}) SELECT file || '-' || CAST(row_idx // {fx.WORKBOOK_SPAN} AS VARCHAR) || '.xlsx' AS file,
      row_idx % {fx.WORKBOOK_SPAN} AS row_idx, {", ".join(f"NULLIF(c{i},'') AS c{i}" for i in range(14))} FROM g""",
    "sheet_by_name": f"""WITH g AS ({JW}) SELECT file, row_idx, {", ".join(f"NULLIF(c{i},'') AS c{i}" for i in range(14))} FROM g
      WHERE file NOT LIKE 'g5%' UNION ALL SELECT DISTINCT file, -1, 'ValueError: sheet ''data'' not found, available: [''cover'', ''other'']',
      {", ".join(["NULL"] * 13)} FROM g WHERE file LIKE 'g5%'""",
    "weekly_job": f"WITH {JOB} {JOB_ENTRIES}",
    "weekly_job_records": f"""WITH {JOB}, {LS}, w AS (SELECT {PARTS}, {_weekly_flags('product_type_ko')}, 'mfds' AS source, jwin.*,
      file AS src_file, 'w1' AS batch_id, {YEAR} FROM jwin)
      SELECT {", ".join(c for c in RECORD_COLUMNS if c not in TRANSLATED_FIELDS)}, {LINEAGE}, batch_id, yr,
      {_looked_up('importer', 'importer_ko')} AS importer_en, {_looked_up('product_type', 'product_type_ko')} AS product_type_en,
      {_looked_up('country', 'country_export_ko')} AS country_export_en, {_looked_up('country', 'country_origin_ko')} AS country_origin_en FROM w""",
    "repeat_batch": f"""WITH {JOB}, first_run AS ({JOB_ENTRIES}) SELECT 'w1' AS batch_id, * FROM first_run
      UNION ALL SELECT 'w1', * FROM first_run WHERE status <> 'done'
      UNION ALL SELECT 'w2', file, status, parsed, 0, parsed, errors, message FROM first_run WHERE file = 'g0-0.xlsx'""",
    "backfill_two_sources": f"""WITH {BACKFILL_ROWS}, {JOB},
      jafter AS (SELECT * FROM jwin WHERE NOT EXISTS (SELECT 1 FROM kwin WHERE kwin.date = jwin.date
        AND kwin.importer_ko = jwin.importer_ko AND kwin.product_ko = jwin.product_ko))
      SELECT '0000-backfill' AS batch_id, * FROM ({BACKFILL_ENTRIES}) UNION ALL SELECT 'w1', * FROM ({AFTER_ENTRIES})""",
    "reports_of_store": f"""WITH {C}, kept AS (
        SELECT *, 1 AS pub FROM c WHERE file = 'f0' QUALIFY ROW_NUMBER() OVER (PARTITION BY {KEY} ORDER BY seq) = 1
        UNION ALL SELECT *, 2 FROM (SELECT * FROM c QUALIFY ROW_NUMBER() OVER (PARTITION BY {KEY} ORDER BY file, seq) = 1) x
        WHERE NOT EXISTS (SELECT 1 FROM c f WHERE f.file = 'f0' AND f.date = x.date AND f.importer_ko = x.importer_ko AND f.product_ko = x.product_ko)),
      a AS (SELECT *, CASE WHEN importer_ko = '' THEN '__unknown__' ELSE importer_ko END AS ko FROM kept WHERE y <> 0),
      per AS (SELECT ko, STRING_AGG(y::VARCHAR || ':' || n::VARCHAR, ',' ORDER BY y) AS years FROM (SELECT ko, y, COUNT(*) AS n FROM a GROUP BY ko, y) GROUP BY ko),
      who AS (SELECT ko, COUNT(*) AS total, FIRST(importer_en ORDER BY pub, file, seq) AS en, MIN((pub, file, seq)) AS place FROM a GROUP BY ko),
      named AS (SELECT ko, total, place, COALESCE(NULLIF(en,''), ko) AS name FROM who)
      SELECT 'importers' AS report, CASE WHEN ko = '__unknown__' THEN '' ELSE ko END || '|' || name || '|' || years AS entry, total,
        ROW_NUMBER() OVER (ORDER BY total DESC, name, place) AS place FROM named JOIN per USING (ko)
      UNION ALL SELECT 'monthly', y || '|' || m || '|' || SUM((ptype = 'frozen')::INT) || '|' || SUM((ptype = 'dried')::INT) || '|' || SUM((ptype = 'ambiguous')::INT),
        COUNT(*), NULL FROM kept WHERE y <> 0 AND m <> 0 GROUP BY y, m""",
    "header_rows": f"WITH {GW} SELECT file, header_row FROM wh",
    "fixed_header": f"WITH {GH} SELECT file AS src_file, row_idx, {_picked(HISTORICAL_HEADERS)} FROM hd",
    "schema_check": f"WITH {GW}, {GH} {_status('w')} UNION ALL {_status('h')}",
    "cells_to_columns": f"WITH {GW} SELECT file AS src_file, row_idx, {_picked(WEEKLY_HEADERS)} FROM wd",
    "drop_blank_rows": f"""WITH {GW} SELECT file, row_idx FROM wc
      WHERE LEN(LIST_FILTER(cells, lambda x: TRIM(COALESCE(x,'')) <> '')) > 0""",
    "pending_files": f"""WITH listing AS ({in_duckdb(fx.LISTING)}), ledger AS ({in_duckdb(fx.LEDGER)})
      SELECT * FROM listing x WHERE path LIKE 'in/%.xlsx' AND path NOT LIKE 'in/%/%' AND NOT SUFFIX(path, '_done.xlsx')
      AND NOT EXISTS (SELECT 1 FROM ledger y WHERE y.path = x.path AND y.modification_time = x.modification_time AND status = 'done')""",
    "read_records": f"""WITH {R}, {FIRSTS},
      first_f0 AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY {KEY} ORDER BY seq) AS rn FROM r WHERE file = 'f0') t WHERE rn = 1),
      both_batches AS (SELECT 'a' AS batch_id, * FROM first_f0 UNION ALL SELECT 'b', * FROM fresh)
      SELECT batch_id, CASE WHEN REGEXP_MATCHES(date, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$') THEN SUBSTRING(date,1,4) ELSE 'none' END AS yr,
      file AS src_file, CAST(seq AS INTEGER) AS row_idx, {KEY}, type_frozen, '' AS report_no FROM both_batches""",
    "strip_fields": f"""WITH f AS ({F}) SELECT seq, TRIM(date_raw) AS date_raw, TRIM(importer_ko) AS importer_ko,
      TRIM(importer_en) AS importer_en, TRIM(product_ko) AS product_ko FROM f""",
    "weekly_dates": f"WITH {R} SELECT seq, date FROM r",
    "historical_dates": f"WITH {HISTORICAL} SELECT {LINEAGE}, date, expiry_date, year, month, day FROM historical",
    "date_parts": f"WITH {R} SELECT seq, date, year, month, day FROM r",
    "weekly_type": f"WITH {R} SELECT seq, type_frozen, type_dried, type_ambiguous FROM r",
    "historical_type": f"WITH f AS ({F}) SELECT seq, {_historical_flags('product_type_ko', 'product_type_en')} FROM f",
    "product_predicates": f"""WITH f AS ({F}) SELECT seq,
      CONTAINS(product_type_ko,'냉동') OR CONTAINS(product_type_ko,'생녹용') AS is_frozen,
      CONTAINS(product_type_ko,'건조') OR (CONTAINS(product_type_ko,'녹용') AND NOT CONTAINS(product_type_ko,'냉동')
        AND NOT CONTAINS(product_type_ko,'생')) AS is_dried FROM f""",
    "type_label": f"WITH {R} SELECT seq, {LABEL} AS ptype FROM r",
    "country_bucket": f"WITH {R} SELECT seq, {BUCKET} AS country FROM r",
    "lenient_int": f"WITH {R} SELECT seq, year, {_int('year')} AS year_i, {_int('month')} AS month_i, {_int('day')} AS day_i FROM r",
    "numeric_text": f"""WITH {WEEKLY} SELECT {LINEAGE}, weight_kg, quantity, TRY_CAST(weight_kg AS DOUBLE) AS weight_kg_d,
      TRY_CAST(quantity AS DOUBLE) AS quantity_d FROM weekly""",
    "dedup_keys": f"WITH {R} SELECT DISTINCT {KEY} FROM r",
    "lookup_rows": f"WITH {LS} SELECT file, row_idx, key, value FROM lr",
    "lookup_sections": f"WITH {LS} SELECT file, row_idx, category, key, value FROM ls",
    "lookup_table": f"WITH {LS} SELECT category, key, value FROM lt",
    "translate_country": _translate(F, "country", "country_export_ko"),
    "translate_product_type": _translate(F, "product_type", "product_type_ko"),
    "translate_importer": _translate(F, "importer", "importer_ko"),
    "exporter_country": _translate(in_duckdb(fx.EXPORTERS), "exporter", "exporter_en"),
    "weekly_records": f"WITH {WEEKLY} SELECT {', '.join(WEEKLY_COLUMNS)}, {LINEAGE} FROM weekly",
    "historical_records": f"WITH {HISTORICAL} SELECT {', '.join(RECORD_COLUMNS)}, {LINEAGE} FROM historical",
    "unified_records": f"""WITH {WEEKLY}, {HISTORICAL} SELECT {', '.join(RECORD_COLUMNS)}, {LINEAGE} FROM historical
      UNION ALL SELECT {', '.join(RECORD_COLUMNS)}, {LINEAGE} FROM weekly""",
    "dedup_first_wins": f"WITH {R}, {FIRSTS} SELECT file, seq, {KEY} FROM firsts",
    "new_records": f"WITH {R}, {FIRSTS} SELECT file, seq, {KEY} FROM fresh",
    "ingest_counters": f"""WITH {R}, {FIRSTS}, per_file AS (SELECT r.file AS src_file,
      COUNT(fresh.seq) AS written, COUNT(*) - COUNT(fresh.seq) AS skipped, CAST(0 AS BIGINT) AS errors
      FROM r LEFT JOIN fresh ON fresh.seq = r.seq GROUP BY r.file)
      SELECT src_file, CAST(SUM(written) AS BIGINT) AS written, CAST(SUM(skipped) AS BIGINT) AS skipped,
      CAST(SUM(errors) AS BIGINT) AS errors FROM per_file GROUP BY ROLLUP(src_file)""",
    "monthly_by_type": f"""WITH {C} SELECT y AS year, m AS month, {BY_TYPE}, COUNT(*) AS total FROM c
      WHERE y <> 0 AND m <> 0 GROUP BY y, m""",
    "yearly_by_country": f"WITH {C} SELECT y AS year, {BY_COUNTRY}, COUNT(*) AS total FROM c WHERE y <> 0 GROUP BY y ORDER BY y",
    "type_country_pivot": _pivot(""),
    "type_country_pivot_year": _pivot("WHERE y = 1997"),
    "type_country_pivot_year0": _pivot("WHERE y = 0"),
    "importer_years": f"""WITH {A} SELECT CASE WHEN ko = '__unknown__' THEN '' ELSE ko END AS importer_ko, y AS year, n FROM per_year""",
    "importer_names": f"""WITH {A}, {LS} SELECT named.importer_ko, COALESCE(NULLIF(lt.value,''), named.importer_en) AS importer_en
      FROM named LEFT JOIN lt ON lt.category = 'importer' AND lt.key = named.ko""",
    "importer_totals": f"""WITH {A}, texts AS (SELECT ko, STRING_AGG(CAST(y AS VARCHAR) || ':' || CAST(n AS VARCHAR), ',' ORDER BY y) AS year_counts
      FROM per_year GROUP BY ko)
      SELECT importer_en, importer_ko, year_counts, total FROM named JOIN texts ON texts.ko = named.ko""",
    "importer_ranking": f"""WITH {A} SELECT ROW_NUMBER() OVER (ORDER BY total DESC, importer_en, first_seq) AS rank,
      importer_en, importer_ko, total FROM named""",
}
