"""Writing small workbooks, to have something to scan."""

import io
import re
import sys
import zipfile
from functools import cache
from xml.sax.saxutils import escape

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import functions as F

_TYPES = (
    '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types">'
    '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
    '<Default Extension="xml" ContentType="application/xml"/></Types>'
)
_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


# Files of a run are read once or twice: speed before size.
LEVEL = 1

# Column names so far.
_NAMES = {}


def column_name(i):
    name = ""
    i += 1
    while i:
        i, rest = divmod(i - 1, 26)
        name = chr(65 + rest) + name
    return name


def workbook_bytes(sheets, shared=False, styles=None, date1904=False):
    """An xlsx file. ``sheets`` maps a name to ``{row position: [values]}`` or a list of rows.

    A value is text, a number, a bool, None, or ``(number, style index)``; ``styles`` lists the number
    format of each style, an id or a format code.
    """
    strings = {}
    members = {"[Content_Types].xml": _TYPES}
    for n, rows in enumerate(sheets.values(), 1):
        if isinstance(rows, TextRows):
            body = rows.body(strings)
        else:
            rows = rows if isinstance(rows, dict) else dict(enumerate(rows))
            body = "".join(
                f'<row r="{at + 1}">{"".join(_cell(at, i, v, strings if shared else None) for i, v in enumerate(row))}</row>'
                for at, row in sorted(rows.items())
            )
        members[f"xl/worksheets/sheet{n}.xml"] = (
            f'<worksheet xmlns="{_MAIN}"><sheetData>{body}</sheetData></worksheet>'
        )
    tabs = "".join(f'<sheet name="{escape(s)}" sheetId="{n}" r:id="rId{n}"/>' for n, s in enumerate(sheets, 1))
    props = '<workbookPr date1904="1"/>' if date1904 else ""
    members["xl/workbook.xml"] = (
        f'<workbook xmlns="{_MAIN}" xmlns:r="{_REL}">{props}<sheets>{tabs}</sheets></workbook>'
    )
    rels = "".join(
        f'<Relationship Id="rId{n}" Type="{_REL}/worksheet" Target="worksheets/sheet{n}.xml"/>'
        for n in range(1, len(sheets) + 1)
    )
    members["xl/_rels/workbook.xml.rels"] = (
        f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{rels}</Relationships>'
    )
    if strings:
        texts = strings if not re.search("[&<>]", "".join(strings)) else map(escape, strings)
        items = '<si><t xml:space="preserve">' + '</t></si><si><t xml:space="preserve">'.join(texts) + "</t></si>"
        members["xl/sharedStrings.xml"] = f'<sst xmlns="{_MAIN}">{items}</sst>'
    if styles:
        codes = {c: 164 + i for i, c in enumerate(s for s in styles if isinstance(s, str))}
        fmts = "".join(
            f'<numFmt numFmtId="{i}" formatCode="{escape(c, {chr(34): "&quot;"})}"/>' for c, i in codes.items()
        )
        xfs = "".join(f'<xf numFmtId="{codes.get(s, s)}"/>' for s in styles)
        members["xl/styles.xml"] = (
            f'<styleSheet xmlns="{_MAIN}"><numFmts>{fmts}</numFmts><cellXfs>{xfs}</cellXfs></styleSheet>'
        )
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED, compresslevel=LEVEL) as archive:
        for name, text in members.items():
            archive.writestr(name, '<?xml version="1.0" encoding="UTF-8"?>' + text)
    return out.getvalue()


def _cell(row, col, value, strings):
    if value is None or value == "":
        return ""
    name = _NAMES.get(col) or _NAMES.setdefault(col, column_name(col))
    ref = f"{name}{row + 1}"
    if strings is not None and isinstance(value, str):
        return f'<c r="{ref}" t="s"><v>{strings.setdefault(value, len(strings))}</v></c>'
    if isinstance(value, tuple):
        return f'<c r="{ref}" s="{value[1]}"><v>{value[0]}</v></c>'
    if isinstance(value, bool):
        return f'<c r="{ref}" t="b"><v>{int(value)}</v></c>'
    if isinstance(value, (int, float)):
        return f'<c r="{ref}"><v>{value}</v></c>'
    return f'<c r="{ref}" t="inlineStr"><is><t xml:space="preserve">{escape(value)}</t></is></c>'


class TextRows:
    """Rows of shared texts: ``texts`` are the distinct ones, ``numbers`` those of all cells end to end, -1 for none."""

    def __init__(self, at, texts, numbers, ends):
        self.at, self.texts, self.numbers, self.ends = at, texts, numbers, ends

    def body(self, strings):
        known = np.array([*(strings.setdefault(t, len(strings)) for t in self.texts), -1])
        flat = known[self.numbers].tolist()
        # The last of several rows at one position stays, as in a dict.
        spans = dict(zip(self.at, zip(self.ends, self.ends[1:])))
        return "".join([_text_row(at, flat[a:b]) for at, (a, b) in sorted(spans.items())])


def _text_row(at, numbers):
    if -1 in numbers:
        template = _row_template(tuple(i for i, n in enumerate(numbers) if n >= 0))
        numbers = [n for n in numbers if n >= 0]
    else:
        template = _row_template(tuple(range(len(numbers))))
    return template.replace("#", str(at + 1)) % tuple(numbers)


@cache
def _row_template(columns):
    """A row with texts in ``columns``: ``#`` is its position, ``%d`` the number of a text."""
    cells = "".join(f'<c r="{column_name(c)}#" t="s"><v>%d</v></c>' for c in columns)
    return f'<row r="#">{cells}</row>'


def write_workbooks(grid, folder, sheets):
    """Write one workbook per ``file`` of ``(file, row_idx, cells)`` into ``folder``; keep each file's rows few.

    ``sheets(file, rows)`` gives a workbook's sheets.
    """

    def write(table):
        import os

        import pyarrow as pa
        import pyarrow.compute as pc

        name = table.column("file")[0].as_py()
        # Each distinct text becomes a Python text once; empty ones make no cell.
        lists = table.column("cells").combine_chunks()
        flat = lists.flatten()
        coded = pc.if_else(pc.equal(flat, ""), None, flat).dictionary_encode()
        numbers = coded.indices.fill_null(-1).to_numpy()
        ends = (lists.offsets.to_numpy() - lists.offsets[0].as_py()).tolist()
        texts = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        rows = TextRows(table.column("row_idx").to_numpy().tolist(), texts, numbers, ends)
        root = re.sub("^file:/*", "/", folder)
        os.makedirs(root, exist_ok=True)
        with open(f"{root}/{name}", "wb") as out:
            out.write(workbook_bytes(sheets(name, rows), shared=True))
        return pa.table({"file": pa.array([name], pa.string())})

    rows = grid.select("file", F.col("row_idx").cast("int").alias("row_idx"), "cells")
    # As many tasks as asked for: by its bytes alone this step would get about one task a core, of uneven length.
    spark = grid.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    rows.repartition(tasks, "file").groupBy("file").applyInArrow(write, "file string").write.format("noop").mode("overwrite").save()
    return folder


cloudpickle.register_pickle_by_value(sys.modules[__name__])
