"""Relations the registered queries run on, as SQL that Spark and DuckDB both read.

Every relation is derived from whole tables and grows with them; ``{orders}`` and the like stand for
the given tables. The messy values hit each rule's branches.
"""

# Raw weekly-shaped declarations, one per order.
DECLARATIONS = """
WITH d AS (
  SELECT o.o_orderkey AS seq, o.o_custkey, c.c_name, c.c_nationkey, n.n_name,
         CAST(CAST(o.o_orderdate AS DATE) AS STRING) AS iso
  FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey
                JOIN {nation}   n ON c.c_nationkey = n.n_nationkey)
SELECT seq, 'f' || CAST(seq % 4 AS STRING) AS file,
  CASE seq % 10 WHEN 0 THEN REPLACE(iso,'-','') WHEN 1 THEN '-' WHEN 2 THEN ''
                WHEN 3 THEN ' ' || iso || ' ' WHEN 4 THEN REPLACE(iso,'-','.')
                WHEN 5 THEN SUBSTRING(iso,9,2) || '/' || SUBSTRING(iso,6,2) || '/' || SUBSTRING(iso,1,4)
                ELSE iso END AS date_raw,
  CASE WHEN o_custkey % 40 = 0 THEN '' WHEN o_custkey % 7 = 0 THEN ' ' || c_name || ' ' ELSE c_name END AS importer_ko,
  CASE WHEN seq % 3 = 0 THEN '' ELSE 'EN ' || c_name END AS importer_en,
  '제품' || CAST(o_custkey % 3 AS STRING) AS product_ko,
  CASE seq % 9 WHEN 0 THEN '생녹용(냉동)' WHEN 1 THEN '녹용(건조)' WHEN 2 THEN '녹용' WHEN 3 THEN '건녹용'
               WHEN 4 THEN '건강식품' WHEN 5 THEN '냉동건조' WHEN 6 THEN '건녹용(냉동)' WHEN 7 THEN '' ELSE '수건' END AS product_type_ko,
  CASE seq % 4 WHEN 0 THEN 'Frozen velvet' WHEN 1 THEN 'Dried velvet' WHEN 2 THEN 'Velvet' ELSE '' END AS product_type_en,
  CASE c_nationkey % 5 WHEN 0 THEN 'New Zealand' WHEN 1 THEN 'Russian Federation' WHEN 2 THEN 'China' WHEN 3 THEN '' ELSE n_name END AS country_export_en,
  CASE c_nationkey % 5 WHEN 3 THEN '뉴질랜드' WHEN 4 THEN '호주' ELSE '' END AS country_export_ko
FROM d
"""

# Weekly cell grid: six files with the header at different rows, one too deep, one with a column missing.
WEEKLY_GRID = """
WITH base AS (
  SELECT o.o_orderkey AS seq, c.c_name AS nm, CAST(CAST(o.o_orderdate AS DATE) AS STRING) AS iso, o.o_custkey AS ck
  FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey),
f AS (SELECT * FROM (VALUES ('g0',0),('g1',1),('g2',4),('g3',5),('g4',0),('g5',0)) AS t(file, hrow)),
hdr AS (
  SELECT file, hrow AS row_idx,
    CASE WHEN file='g5' THEN '수입업체' ELSE '처리일자' END AS c0, CASE WHEN file='g5' THEN '처리일자' ELSE ' 수입업체 ' END AS c1,
    '신고번호' AS c2, '품목제조번호' AS c3, '제품명(한글)' AS c4, '제품명(영문)' AS c5, '품목류' AS c6, '수출국' AS c7, '제조국' AS c8,
    '제조사(영문)' AS c9, '순중량(KG)' AS c10, '수량(갯수)' AS c11, '유통기한' AS c12,
    CASE WHEN file='g4' THEN '기타' ELSE '원산지' END AS c13 FROM f),
title AS (SELECT file, 0 AS row_idx, '수입식품 조회 결과' AS c0 FROM f WHERE hrow > 0),
data AS (
  SELECT 'g' || CAST(seq % 6 AS STRING) AS file, CAST(10 + seq AS INT) AS row_idx, seq % 97 = 0 AS blank,
    CASE WHEN seq % 6 = 5 THEN nm ELSE REPLACE(iso,'-','') END AS c0, CASE WHEN seq % 6 = 5 THEN REPLACE(iso,'-','') ELSE nm END AS c1,
    'R' || CAST(seq AS STRING) AS c2, 'I' || CAST(ck AS STRING) AS c3, '제품' || CAST(ck % 3 AS STRING) AS c4, 'Product ' || CAST(ck % 3 AS STRING) AS c5,
    CASE seq % 3 WHEN 0 THEN '생녹용(냉동)' WHEN 1 THEN '녹용(건조)' ELSE '녹용' END AS c6, '뉴질랜드' AS c7, '러시아' AS c8, 'Exporter' AS c9,
    CASE WHEN seq % 11 = 0 THEN 'N/A' ELSE CAST(ck AS STRING) END AS c10, CAST(seq % 50 AS STRING) AS c11,
    CASE WHEN seq % 4 = 0 THEN NULL ELSE '20280515' END AS c12, '뉴질랜드' AS c13 FROM base)
SELECT * FROM hdr
UNION ALL SELECT file,row_idx,c0,NULL,NULL,NULL,NULL,NULL,NULL,NULL,NULL,NULL,NULL,NULL,NULL,NULL FROM title
UNION ALL SELECT file,row_idx, CASE WHEN blank THEN ' ' ELSE c0 END, CASE WHEN blank THEN NULL ELSE c1 END, CASE WHEN blank THEN '' ELSE c2 END,
  CASE WHEN blank THEN NULL ELSE c3 END, CASE WHEN blank THEN NULL ELSE c4 END, CASE WHEN blank THEN NULL ELSE c5 END, CASE WHEN blank THEN NULL ELSE c6 END,
  CASE WHEN blank THEN NULL ELSE c7 END, CASE WHEN blank THEN NULL ELSE c8 END, CASE WHEN blank THEN NULL ELSE c9 END, CASE WHEN blank THEN NULL ELSE c10 END,
  CASE WHEN blank THEN NULL ELSE c11 END, CASE WHEN blank THEN NULL ELSE c12 END, CASE WHEN blank THEN NULL ELSE c13 END FROM data
"""

# Lookup sheet rows (columns b and c of the sheet).
LOOKUP_SHEET_ROWS = """
SELECT 'l0' AS file, * FROM (VALUES (0,'고아','orphan'),(1,'뉴질랜드','New Zealand'),(2,' 러시아 ','Russia'),(3,'중국','China'),(4,'일본',''),(5,'중국','China PRC'),
  (10,'Product name (Korean)','Translation'),(11,'생녹용(냉동)','Frozen velvet antler'),(12,'녹용(건조)','Dried velvet antler'),(13,'녹용','Velvet antler'),
  (20,'Company Korean name','Company English name')) AS t(row_idx, b, c)
UNION ALL SELECT 'l0', CAST(1000 + c_custkey AS INT), c_name, 'Co ' || c_mktsegment || ' ' || CAST(c_custkey AS STRING) FROM {customer} WHERE c_custkey % 2 = 0
UNION ALL SELECT 'l0', 900000000, 'Company', 'Country'
UNION ALL SELECT 'l0', CAST(900000001 + s_suppkey AS INT), s_name, n_name FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey
"""

# Files in an inbox.
LISTING = """
SELECT 'in/' || CASE WHEN o_orderkey % 16 = 0 THEN 'sub/' ELSE '' END || 'w' || CAST(o_orderkey AS STRING)
       || CASE o_orderkey % 8 WHEN 1 THEN '_done.xlsx' WHEN 2 THEN '.txt' ELSE '.xlsx' END AS path,
       o_orderkey % 3 AS modification_time
FROM {orders}
"""

# What the ledger says about them.
LEDGER = """
SELECT 'in/w' || CAST(o_orderkey AS STRING) || '.xlsx' AS path,
       CASE WHEN o_orderkey % 7 = 0 THEN o_orderkey % 3 - 1 ELSE o_orderkey % 3 END AS modification_time,
       CASE o_orderkey % 5 WHEN 0 THEN 'failed' WHEN 1 THEN 'empty' ELSE 'done' END AS status
FROM {orders} WHERE o_orderkey % 2 = 1
"""

# Historical cell grid: h0 as expected, h1 without the Year column, h2 with two columns swapped and the
# Day header repeated (the last one counts), h3 with a title row only.
HISTORICAL_GRID = """
WITH base AS (
  SELECT o.o_orderkey AS seq, c.c_name AS nm, n.n_name, CAST(CAST(o.o_orderdate AS DATE) AS STRING) AS iso, o.o_custkey AS ck
  FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey JOIN {nation} n ON c.c_nationkey = n.n_nationkey),
f AS (SELECT * FROM (VALUES ('h0'),('h1'),('h2')) AS t(file)),
title AS (SELECT * FROM (VALUES ('h0'),('h1'),('h2'),('h3')) AS t(file)),
data AS (
  SELECT 'h' || CAST(seq % 3 AS STRING) AS file, CAST(2 + seq AS INT) AS row_idx, seq % 89 = 0 AS blank, seq, nm, n_name, ck, iso,
    SUBSTRING(iso,1,4) AS y, CAST(CAST(SUBSTRING(iso,6,2) AS INT) AS STRING) AS m FROM base)
SELECT file, 0 AS row_idx, 'Import list' AS c0, CAST(NULL AS STRING) AS c1, CAST(NULL AS STRING) AS c2, CAST(NULL AS STRING) AS c3,
  CAST(NULL AS STRING) AS c4, CAST(NULL AS STRING) AS c5, CAST(NULL AS STRING) AS c6, CAST(NULL AS STRING) AS c7, CAST(NULL AS STRING) AS c8,
  CAST(NULL AS STRING) AS c9, CAST(NULL AS STRING) AS c10, CAST(NULL AS STRING) AS c11, CAST(NULL AS STRING) AS c12, CAST(NULL AS STRING) AS c13,
  CAST(NULL AS STRING) AS c14, CAST(NULL AS STRING) AS c15, CAST(NULL AS STRING) AS c16 FROM title
UNION ALL SELECT file, 1, CASE file WHEN 'h1' THEN 'Yr' WHEN 'h2' THEN 'Month' ELSE 'Year' END, CASE file WHEN 'h2' THEN 'Year' ELSE ' Month ' END,
  'Day', 'Importer', 'Translation of type', 'Country of origin', 'Country of export', 'Importer (Korean)', 'Product name (Korean)',
  'Product name (English)', 'Product type (Korean)', 'Exporter (English)', 'Date', 'Expire date start from', 'Country of origin (KR)',
  'Country of export (KR)', CASE file WHEN 'h2' THEN 'Day' ELSE 'Note' END FROM f
UNION ALL SELECT file, row_idx, CASE file WHEN 'h2' THEN m ELSE y END, CASE file WHEN 'h2' THEN y ELSE m END, SUBSTRING(iso,9,2),
  CASE WHEN seq % 5 = 0 THEN '' ELSE ' EN ' || nm END,
  CASE seq % 4 WHEN 0 THEN 'Frozen velvet' WHEN 1 THEN 'DRIED velvet' WHEN 2 THEN 'Velvet' ELSE 'Frozen dried velvet' END,
  'Russia', n_name, nm, '제품' || CAST(ck % 3 AS STRING), 'Product ' || CAST(ck % 3 AS STRING),
  CASE seq % 7 WHEN 0 THEN '생녹용(냉동)' WHEN 1 THEN '녹용(건조)' WHEN 2 THEN '건녹용' WHEN 3 THEN '건녹용(냉동)' WHEN 4 THEN '수건' WHEN 5 THEN '' ELSE ' ' END,
  'Exporter ' || CAST(ck % 10 AS STRING),
  CASE seq % 6 WHEN 0 THEN REPLACE(iso,'-','') WHEN 1 THEN '-' WHEN 2 THEN ' ' || iso || ' ' WHEN 3 THEN NULL ELSE iso END,
  CASE WHEN seq % 4 = 0 THEN NULL ELSE '2028-05-15' END, '러시아', CASE WHEN seq % 8 = 0 THEN NULL ELSE '뉴질랜드' END, '31'
  FROM data WHERE NOT blank
UNION ALL SELECT file, row_idx, ' ', NULL, '', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM data WHERE blank
"""

# The weekly grid as many workbooks: rows go to workbooks by their position, each with its grid's first rows.
_W14 = ", ".join(f"c{i}" for i in range(14))
_H14 = ", ".join(f"h.c{i}" for i in range(14))
WEEKLY_WORKBOOKS = f"""
WITH g AS ({WEEKLY_GRID}), head AS (SELECT * FROM g WHERE row_idx < 10),
body AS (SELECT file AS grid, file || '-' || CAST(CAST(FLOOR(row_idx / 6000) AS BIGINT) AS STRING) || '.xlsx' AS file,
  CAST(10 + row_idx % 6000 AS INT) AS row_idx, {_W14} FROM g WHERE row_idx >= 10)
SELECT p.file, h.row_idx, {_H14} FROM (SELECT DISTINCT grid, file FROM body) p JOIN head h ON p.grid = h.file
UNION ALL SELECT file, row_idx, {_W14} FROM body
"""

# The historical grid in the same way; the one with a title row only is a workbook of its own.
_W17 = ", ".join(f"c{i}" for i in range(17))
_H17 = ", ".join(f"h.c{i}" for i in range(17))
HISTORICAL_WORKBOOKS = f"""
WITH g AS ({HISTORICAL_GRID}), head AS (SELECT * FROM g WHERE row_idx < 2),
body AS (SELECT file AS grid, file || '-' || CAST(CAST(FLOOR(row_idx / 6000) AS BIGINT) AS STRING) || '.xlsx' AS file,
  CAST(2 + row_idx % 6000 AS INT) AS row_idx, {_W17} FROM g WHERE row_idx >= 2),
p AS (SELECT DISTINCT grid, file FROM body UNION ALL SELECT 'h3', 'h3-0.xlsx')
SELECT p.file, h.row_idx, {_H17} FROM p JOIN head h ON p.grid = h.file
UNION ALL SELECT file, row_idx, {_W17} FROM body
"""

# Exporter names as they come in: padded, some unknown to the lookup sheet.
EXPORTERS = """
SELECT s_suppkey AS seq, CASE WHEN s_suppkey % 10 = 0 THEN 'New ' || s_name ELSE ' ' || s_name || ' ' END AS exporter_en FROM {supplier}
"""

TABLES = ["orders", "customer", "nation", "supplier"]

# Sheet rows per generated workbook; positions are unique per file, so this bounds a workbook.
WORKBOOK_SPAN = 6000


def in_duckdb(sql):
    return sql.format(**{t: t for t in TABLES})


def relation(spark, sf_dir, sql):
    used = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES if f"{{{t}}}" in sql}
    return spark.sql(sql, **used)
