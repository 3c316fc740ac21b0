"""Finding headers, checking columns and turning cells into named columns.

Each source is described by a ``Layout``. The layout of a file is worked out from its first rows only,
as expressions: decoded blocks carry those rows with them, so no join is needed; a flat grid gets
them by a keyed join on the file.
"""

from dataclasses import dataclass

from pyspark.sql import functions as F

from portledger.functions.text import WHITESPACE, safe_str
from portledger.operators.joins import keyed_left_join
from portledger.schema import (
    HEADER_MATCH_COLUMNS,
    HEADER_SEARCH_ROWS,
    HISTORICAL_HEADERS,
    SHEET_ROW,
    WEEKLY_HEADERS,
)
from portledger.session import pinned

STATUS_ROW = -1
# ``block`` of the row that closes a file.
LAST_BLOCK = -1


@dataclass(frozen=True)
class Layout:
    """Header texts and their fields; ``header_row`` is fixed or, if None, searched for."""

    headers: tuple
    header_row: int = None

    @property
    def texts(self):
        return [text for text, _ in self.headers]


WEEKLY = Layout(tuple(WEEKLY_HEADERS.items()))
HISTORICAL = Layout(tuple(HISTORICAL_HEADERS.items()), header_row=1)


def texts(values):
    return F.array(*[F.lit(v) for v in values])


def stripped_cells(cells):
    return F.transform(cells, lambda c: safe_str(c))


def is_blank_row(cells="cells"):
    """True where every cell is null or white space."""
    return F.btrim(F.array_join(cells, ""), F.lit(WHITESPACE)) == ""


def drop_blank_rows(grid):
    return grid.where(~is_blank_row())


def sheet_heads(grid):
    """First rows of every file as ``(file, head)``; at most five short rows per file."""
    row = F.struct("row_idx", "cells", F.lit(None).cast("array<int>").alias("dated"))
    return (
        grid.where(F.col("row_idx") < HEADER_SEARCH_ROWS)
        .groupBy("file")
        .agg(F.sort_array(F.collect_list(row)).alias("head"))
    )


def with_layout(df, layout):
    """Add ``header_row``, ``missing``, ``positions`` and ``message`` from the ``head`` column.

    ``positions`` holds the cell index of every expected header, the last one if a header repeats.
    ``message`` says why the file cannot be used, or is null.
    """
    if layout.header_row is None:
        wanted = texts(layout.texts[:HEADER_MATCH_COLUMNS])
        found = F.filter(
            "head",
            lambda r: (r["row_idx"] < HEADER_SEARCH_ROWS)
            & (F.size(F.array_except(wanted, stripped_cells(r["cells"]))) == 0),
        )
    else:
        found = F.filter("head", lambda r: r["row_idx"] == layout.header_row)
    header = F.get(found, F.lit(0))
    df = df.withColumn("_header", header).select(
        "*",
        F.col("_header.row_idx").alias("header_row"),
        stripped_cells(F.col("_header.cells")).alias("_names"),
    )
    size, backwards = F.size("_names"), F.reverse("_names")
    at = [F.array_position(backwards, F.lit(t)) for t in layout.texts]
    positions = F.array(*[F.when(p > 0, size - p).cast("int") for p in at])
    df = df.withColumn("missing", F.array_except(texts(layout.texts), F.col("_names"))).withColumn(
        "positions", positions
    )
    problem = F.when(
        F.col("header_row").isNull(),
        F.lit(f"header row not found, expected at least: {', '.join(layout.texts[:HEADER_MATCH_COLUMNS])}"),
    ).when(
        F.size("missing") > 0, F.concat(F.lit("missing columns: "), F.array_join("missing", ", "))
    )
    error = F.col("error") if "error" in df.columns else F.lit(None).cast("string")
    return df.withColumn("message", F.coalesce(error, problem)).drop("_header", "_names")


def header_rows(grid, layout):
    """Header position of every file that has one."""
    return (
        with_layout(sheet_heads(grid), layout)
        .where(F.col("header_row").isNotNull())
        .select("file", "header_row")
    )


def schema_check(grid, layout):
    """One status row per file: usable or not, and which expected columns are missing."""
    return with_layout(sheet_heads(grid), layout).select(
        "file",
        "header_row",
        F.col("message").isNull().alias("ok"),
        F.when(F.col("header_row").isNotNull(), F.array_join("missing", ",")).alias("missing"),
    )


def rows_of_grid(grid, layout):
    """Data rows of a flat grid together with their file's column positions.

    The per-file side is worked out once, kept, and measured before it is broadcast; a file may hold
    any share of the rows.
    """
    usable = pinned(
        with_layout(sheet_heads(grid), layout)
        .where(F.col("message").isNull())
        .select("file", "header_row", "positions")
    )
    joined = keyed_left_join(grid, usable, "file", spread_by=["row_idx"])
    return drop_blank_rows(joined.where(F.col("row_idx") > F.col("header_row"))).select(
        F.col("file").alias("src_file"),
        "row_idx",
        "cells",
        F.lit(None).cast("array<int>").alias("dated"),
        "positions",
    )


def rows_of_blocks(blocks, layout):
    """Data rows of decoded blocks, plus one status row per file (``row_idx = -1``) with its message.

    Narrow all the way: the layout is computed once per block, then the block is exploded. The status row comes from the
    row that closes a file; rows of a file that broke before its end are there too, and its status has the error.
    """
    status = F.array(F.lit(None).cast(SHEET_ROW))
    none = F.array().cast(f"array<{SHEET_ROW.simpleString()}>")
    emitted = F.concat(
        F.when(F.col("block") == LAST_BLOCK, status).otherwise(none),
        F.when(F.col("message").isNull(), F.col("rows")).otherwise(none),
    )
    rows = with_layout(blocks, layout).select(
        "file", "header_row", "positions", "message", F.explode(emitted).alias("_r")
    )
    is_status = F.col("_r").isNull()
    return rows.where(
        is_status | ((F.col("_r.row_idx") > F.col("header_row")) & ~is_blank_row(F.col("_r.cells")))
    ).select(
        F.col("file").alias("src_file"),
        F.when(is_status, F.lit(STATUS_ROW)).otherwise(F.col("_r.row_idx")).alias("row_idx"),
        F.col("_r.cells").alias("cells"),
        F.col("_r.dated").alias("dated"),
        "positions",
        F.when(is_status, F.col("message")).alias("message"),
    )


def cells_to_columns(rows, layout, dates=()):
    """Named text columns by header position; a short row or empty cell gives the empty string.

    For each field in ``dates`` a ``<field>_cell`` flag says whether the cell was a true date cell.
    """
    named = [
        f"coalesce(get(cells, get(positions, {i})), '') AS {field}"
        for i, (_, field) in enumerate(layout.headers)
    ]
    flags = [
        f"coalesce(array_contains(dated, get(positions, {i})), false) AS {field}_cell"
        for i, (_, field) in enumerate(layout.headers)
        if field in dates
    ]
    kept = [c for c in rows.columns if c not in ("cells", "dated", "positions")]
    return rows.selectExpr(*kept, *named, *flags)
