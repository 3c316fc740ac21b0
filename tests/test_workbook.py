import cProfile
import datetime
import io
import subprocess
import sys
import zipfile
from xml.etree import ElementTree

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from checks.workbooks import column_name, workbook_bytes, write_workbooks
from portledger.sources import workbook as wb
from portledger.sources.inbox import escaped, list_folder, list_path
from portledger.sources.workbook import LAST, decode_workbooks, grid_of, scan_workbooks, whole_files


def decoded(spark, content, sheet=None):
    files = spark.createDataFrame([("f", bytearray(content))], "path string, content binary")
    blocks, bad = whole_files(decode_workbooks(files, sheet))
    error = bad.first()
    rows = {r["row_idx"]: r["cells"] for r in grid_of(blocks).collect()}
    return rows, error and error["error"]


@pytest.mark.parametrize("shared", [True, False])
def test_values_become_python_text(spark, shared):
    rows = [["한글 <&>", 2020, 2020.5, True, False, None, "  pad "], [None, None, "c"], [1e20, 0.1, -3]]
    got, error = decoded(spark, workbook_bytes({"s": rows}, shared=shared))
    assert error is None
    assert got == {
        0: ["한글 <&>", "2020", "2020.5", "True", "False", None, "  pad "],
        1: [None, None, "c"],
        2: [str(1e20), "0.1", "-3"],
    }


def test_gaps_keep_their_sheet_position(spark):
    got, _ = decoded(spark, workbook_bytes({"s": {0: ["a"], 7: ["b"], 1200: ["c"]}}))
    assert got == {0: ["a"], 7: ["b"], 1200: ["c"]}


def test_many_blocks_share_the_head(spark):
    rows = {i: [str(i)] for i in range(3, 2000)}
    files = spark.createDataFrame([("f", bytearray(workbook_bytes({"s": rows})))], "path string, content binary")
    blocks = decode_workbooks(files).collect()
    assert [b["block"] for b in blocks] == [*range(len(blocks) - 1), LAST] and len(blocks) > 4
    assert all([r["row_idx"] for r in b["head"]] == [3, 4] for b in blocks)
    assert [r["row_idx"] for b in blocks for r in b["rows"]] == list(range(3, 2000))


def test_dates_by_style(spark):
    styles = [0, 14, 46, "yyyy\\-mm\\-dd", '0.00" day"', "[h]:mm", "[Red]0.0", "h:mm"]
    day = (datetime.date(2020, 1, 15) - datetime.date(1899, 12, 30)).days
    row = [(day, 0), (day, 1), (1.5, 2), (day + 0.5, 3), (3, 4), (0.25, 5), (3.5, 6), (0.5, 7), (1, 1), (60, 1)]
    files = spark.createDataFrame(
        [("f", bytearray(workbook_bytes({"s": [row]}, styles=styles)))], "path string, content binary"
    )
    got = decode_workbooks(files).first()["rows"][0]
    assert got["cells"] == [
        str(day), "2020-01-15 00:00:00", "1 day, 12:00:00", "2020-01-15 12:00:00", "3", "6:00:00", "3.5", "12:00:00",
        "1900-01-01 00:00:00", "1900-02-28 00:00:00",
    ]
    assert got["dated"] == [1, 3, 8, 9]


def test_1904_dates(spark):
    got, _ = decoded(spark, workbook_bytes({"s": [[(1, 0)]]}, styles=[14], date1904=True))
    assert got == {0: ["1904-01-02 00:00:00"]}


def test_first_sheet_or_by_name(spark):
    book = workbook_bytes({"one": [["1"]], "two & more": [["2"]]})
    assert decoded(spark, book)[0] == {0: ["1"]}
    assert decoded(spark, book, "two & more")[0] == {0: ["2"]}
    rows, error = decoded(spark, book, "three")
    assert rows == {} and "three" in error and "two & more" in error


def test_broken_file_is_one_error_row(spark, tmp_path):
    good = workbook_bytes({"s": {i: [str(i)] for i in range(1500)}})
    (tmp_path / "good.xlsx").write_bytes(good)
    (tmp_path / "junk.xlsx").write_bytes(b"not a workbook")
    (tmp_path / "한글 [1].xlsx").write_bytes(workbook_bytes({"s": [["x"]]}))
    blocks = scan_workbooks(list_folder(spark, str(tmp_path)))
    errors = {r["file"].rsplit("/", 1)[1]: r["error"] for r in blocks.where(f"block = {LAST}").collect()}
    assert errors["good.xlsx"] is None and errors["한글 [1].xlsx"] is None
    assert errors["junk.xlsx"].startswith("BadZipFile")
    assert grid_of(blocks).count() == 1501


def test_file_broken_midway_gives_no_rows(spark):
    import io
    import zipfile

    source = zipfile.ZipFile(io.BytesIO(workbook_bytes({"s": {i: ["v"] for i in range(3000)}})))
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as target:
        for name in source.namelist():
            data = source.read(name)
            target.writestr(name, data[: len(data) // 2] if "sheet1" in name else data)
    rows, error = decoded(spark, out.getvalue())
    assert rows == {} and error.startswith("ParseError")


def test_cells_and_rows_without_a_reference_follow_each_other(spark):
    import io
    import re
    import zipfile

    base = zipfile.ZipFile(io.BytesIO(workbook_bytes({"s": [[1, 2, 3], [4, None, 6]]})))
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as target:
        for name in base.namelist():
            text = base.read(name).decode()
            if "sheet1" in name:
                text = re.sub(r' r="[A-Z]*[0-9]+"', "", text).replace("<v>2</v>", "")
            target.writestr(name, text)
    assert decoded(spark, out.getvalue())[0] == {0: ["1", None, "3"], 1: ["4", "6"]}


def test_rich_text_and_phonetic_hints(spark):
    import io
    import zipfile

    out = io.BytesIO()
    base = zipfile.ZipFile(io.BytesIO(workbook_bytes({"s": [["q"]]}, shared=True)))
    shared = (
        f'<sst xmlns="{_main()}"><si><r><t>녹</t></r><r><t>용</t></r><rPh sb="0" eb="1"><t>X</t></rPh></si></sst>'
    )
    with zipfile.ZipFile(out, "w") as target:
        for name in base.namelist():
            target.writestr(name, shared if "sharedStrings" in name else base.read(name))
    assert decoded(spark, out.getvalue())[0] == {0: ["녹용"]}


def _main():
    return "http://schemas.openxmlformats.org/spreadsheetml/2006/main"


def test_tasks_need_no_installed_package(tmp_path):
    # What a task gets must load where this package cannot be imported.
    code = (
        "import sys, pyarrow as pa; from pyspark import cloudpickle; "
        "blocks, book = cloudpickle.loads(sys.stdin.buffer.read()); "
        "first = next(blocks('p', lambda: pa.BufferReader(book), None)); "
        "print(first.column('rows')[0].as_py()[0]['cells'])"
    )
    sent = cloudpickle.dumps((wb._blocks, workbook_bytes({"s": [["a", 1, (43845, 1)]]}, styles=[0, 14])))
    run = subprocess.run(
        [sys.executable, "-c", code], input=sent, capture_output=True, cwd=tmp_path, env={"PATH": "/usr/bin"}
    )
    assert run.stdout.decode().strip() == "['a', '1', '2020-01-15 00:00:00']", run.stderr.decode()


def broken_midway(rows):
    import io
    import zipfile

    source = zipfile.ZipFile(io.BytesIO(workbook_bytes({"s": rows})))
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as target:
        for name in source.namelist():
            data = source.read(name)
            target.writestr(name, data[: len(data) // 2] if "sheet1" in name else data)
    return out.getvalue()


def test_blocks_leave_before_the_end_and_bad_files_are_dropped_afterwards(spark, tmp_path):
    (tmp_path / "bad.xlsx").write_bytes(broken_midway({i: ["v"] for i in range(3000)}))
    (tmp_path / "good.xlsx").write_bytes(workbook_bytes({"s": {i: ["v"] for i in range(3000)}}))
    blocks = scan_workbooks(list_folder(spark, str(tmp_path)))
    assert blocks.where("file like '%bad.xlsx' and block >= 0").count() > 0
    whole, bad = whole_files(blocks)
    assert {r["file"].rsplit("/", 1)[1] for r in grid_of(whole).select("file").distinct().collect()} == {"good.xlsx"}
    assert grid_of(whole).count() == 3000 and bad.count() == 1


def test_plan_moves_no_contents(spark, tmp_path):
    for i in range(40):
        (tmp_path / f"{i}.xlsx").write_bytes(workbook_bytes({"s": [[str(i)] * (i + 1)]}))
    blocks = scan_workbooks(list_folder(spark, str(tmp_path)))
    assert sorted(int(r["cells"][0]) for r in grid_of(blocks).collect()) == list(range(40))
    plan = blocks._jdf.queryExecution().executedPlan().toString()
    # Two exchanges of the narrow listing, none above the files.
    assert "content:binary" not in plan and plan.count("Exchange") == 2 and plan.index("MapInArrow") < plan.index("Exchange")


def test_tasks_are_filled_by_size(spark, monkeypatch):
    sizes = [(f"file:/x/{i}", (i % 3) * 300 << 20) for i in range(64)]
    listing = spark.createDataFrame(sizes, "path string, length long")
    total = sum(n for _, n in sizes) + 64 * wb.OPEN_COST
    dealt = wb.dealt_by_size(listing, total, 64)
    monkeypatch.setattr(wb, "SHORT_LISTING", 0)
    by_ranges = wb.dealt_by_size(listing, total, 64)
    tasks = lambda df: sorted(sorted(r["path"] for r in part) for part in df.rdd.glom().collect())
    assert tasks(dealt) == tasks(by_ranges)
    loads = [sum(r["length"] for r in part) for part in dealt.rdd.glom().collect()]
    assert len(loads) > 100 or max(loads) <= sum(loads) / len(loads) + (600 << 20)
    assert sum(loads) == sum(n for _, n in sizes) and sum(1 for x in loads if x) >= 42


def test_memory_does_not_grow_with_the_file(tmp_path):
    # The peak of a decoding process, 5,000 against 500,000 rows of unlike texts.
    code = (
        "import sys; sys.path.insert(0, sys.argv[2]); from portledger.sources import workbook as wb; "
        "n = sum(len(b.column('rows')[0]) for b in wb._blocks('p', lambda: wb.open_direct(sys.argv[1]), None)); "
        "print(n, next(line.split()[1] for line in open('/proc/self/status') if line.startswith('VmHWM')))"
    )
    import os

    root = os.path.dirname(os.path.dirname(os.path.abspath(wb.__file__)))
    peaks = []
    for n in (5_000, 500_000):
        path = tmp_path / f"{n}.xlsx"
        path.write_bytes(workbook_bytes({"s": {i: [f"number {i}", i, "again"] for i in range(n)}}, shared=True))
        run = subprocess.run([sys.executable, "-c", code, str(path), os.path.dirname(root)], capture_output=True, text=True)
        rows, peak = map(int, run.stdout.split())
        assert rows == n
        peaks.append(peak)
    assert peaks[1] < 2 * peaks[0], peaks


def test_other_stores_are_read_by_spark(spark, tmp_path, monkeypatch):
    (tmp_path / "a [1].xlsx").write_bytes(workbook_bytes({"s": [["a"]]}))
    (tmp_path / "b.xlsx").write_bytes(workbook_bytes({"s": [["b"]]}))
    (tmp_path / "large.xlsx").write_bytes(bytes(100_000))
    (tmp_path / "unlisted.xlsx").write_bytes(workbook_bytes({"s": [["no"]]}))
    listing = list_folder(spark, str(tmp_path)).where("path not like '%unlisted%'")
    monkeypatch.setattr(wb, "DIRECT", {"s3": "S3FileSystem"})
    monkeypatch.setattr(wb, "MAX_CONTENT_BYTES", 50_000)
    whole, bad = whole_files(scan_workbooks(listing))
    assert sorted(r["cells"][0] for r in grid_of(whole).collect()) == ["a", "b"]
    assert [r["file"].rsplit("/", 1)[1] for r in bad.collect()] == ["large.xlsx"]


def test_a_caller_may_open_files_itself(spark, tmp_path):
    (tmp_path / "a.xlsx").write_bytes(workbook_bytes({"s": [["a"]]}))
    listing = list_path(spark, escaped(str(tmp_path / "a.xlsx"))).withColumn("path", F.lit("own://a"))
    place = str(tmp_path / "a.xlsx")
    blocks = scan_workbooks(listing, opener=lambda path: open(place, "rb"))
    assert [r["file"] for r in grid_of(blocks).collect()] == ["own://a"]


def test_a_missing_file_is_an_error_row(spark, tmp_path):
    listing = spark.createDataFrame([(f"file:{tmp_path}/gone.xlsx", 10)], "path string, length long")
    row = scan_workbooks(listing).first()
    assert row["block"] == LAST and row["error"].startswith("FileNotFoundError")
    assert scan_workbooks(listing.where("false")).isEmpty()


def test_column_letters():
    assert [wb._column_index(column_name(i)) for i in (0, 25, 26, 701, 702)] == [0, 25, 26, 701, 702]


SHEET = '<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main">{}</worksheet>'


def rows_of(sheet, strings=None):
    """Rows of a sheet's XML, and whether they were read without a tree."""
    plain = zipfile.ZipFile(io.BytesIO(workbook_bytes({"s": [["x", (1, 1)]]}, shared=True, styles=[0, 14])))
    parts = {n: plain.read(n) for n in plain.namelist()}
    parts["xl/worksheets/sheet1.xml"] = sheet.encode() if isinstance(sheet, str) else sheet
    parts |= {} if strings is None else {"xl/sharedStrings.xml": strings.encode()}
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as archive:
        for name, data in parts.items():
            archive.writestr(name, data)
    with zipfile.ZipFile(out) as archive:
        book = wb._Workbook(archive)
        with archive.open("xl/worksheets/sheet1.xml") as part:
            tree = list(book._tree_rows(part))
        try:
            with archive.open("xl/worksheets/sheet1.xml") as part:
                usual = list(book._usual_rows(part))
        except wb._Unusual:
            usual = None
        got = list(book.rows("xl/worksheets/sheet1.xml"))
    assert got == tree and usual in (None, tree)
    return got, usual is not None


def test_usual_sheets_are_read_without_a_tree_and_give_its_rows():
    body = (
        '<dimension ref="A1:D9"/><sheetData><row r="1" spans="1:4"><c r="A1" t="s"><v>0</v></c><c r="C1"><v>007</v></c>'
        '<c r="D1" s="1"><v>43845</v></c></row><row r="3"/><row r="4"><c r="B4" s="1"/><c r="C4" t="b"><v>1</v></c>'
        '<c r="D4" t="str"><v> é한 </v></c><c r="E4"><v>1.50</v></c></row><row r="6"><c r="A6"></c></row></sheetData><pageMargins left="1"/>'
    )
    rows, usual = rows_of('<?xml version="1.0" encoding="UTF-8"?>' + SHEET.format(body))
    assert usual and [at for at, *_ in rows] == [0, 3]
    assert rows[0] == (0, ["x", None, "7", "2020-01-15 00:00:00"], [3]) and rows[1][1] == [None, None, "True", " é한 ", "1.5"]
    # The same over many parts.
    many = "".join(f'<row r="{i}"><c r="A{i}"><v>{i}</v></c><c r="B{i}" t="str"><v>{"é" * (i % 50)}</v></c></row>' for i in range(1, 9000))
    rows, usual = rows_of(SHEET.format(f"<sheetData>{many}</sheetData>"))
    assert usual and len(rows) == 8999 and rows[8998][:2] == (8998, ["8999", "é" * 49])


@pytest.mark.parametrize(
    "body",
    [
        "<row r='1'><c r='A1'><v>1</v></c></row>",
        '<row r="1"><c r="A1"><!-- <v>2</v> --><v>1</v></c></row>',
        '<row r="1"><c r="A1" t="str"><v><![CDATA[<row r="9">]]></v></c></row>',
        '<row r="1"><c r="A1" t="str"><v>a &amp; b</v></c></row>',
        '<row r="1">\n <c r="A1"><f>1+1</f><v>2</v></c>\n</row>',
        '<row r="1"><c r="A1"><v>1</v></c></row><row><c><v>2</v></c></row>',
        '<row r="1"><c r="A1" t="inlineStr"><is><t>one</t></is></c></row>',
        '<row r="1" foo="2"><c r="A1"><v>5</v></c></row>',
    ],
)
def test_other_sheets_are_walked_as_a_tree(body):
    rows, usual = rows_of(SHEET.format(f"<sheetData>{body}</sheetData>"))
    assert not usual and rows


@pytest.mark.parametrize(
    "sheet",
    [
        SHEET.format('<sheetData><row r="1"><c r="A1"><v>1</v></c></row></sheetData><broken>'),
        SHEET.format('<sheetData><row r="1"><c r="A1"><v>1</v></c></row>'),
        SHEET.format('<sheetData><row r="1"><c r="A1"><v>1</v></row></c></sheetData>'),
        SHEET.format('<sheetData><row r="1"><c r="A1"><v>1</v></c></row></sheetData>').encode() + b"\xff",
    ],
)
def test_malformed_sheets_are_errors(sheet):
    with pytest.raises(ElementTree.ParseError):
        rows_of(sheet)


def test_plain_cells_cost_little():
    # Counted in calls of Python functions, which do not depend on the machine.
    content = workbook_bytes({"s": [[f"a{i}", "b", i, str(i % 7), "e"] for i in range(4000)]}, shared=True)
    list(wb._blocks("p", lambda: io.BytesIO(content), None))
    profile = cProfile.Profile()
    profile.enable()
    blocks = list(wb._blocks("p", lambda: io.BytesIO(content), None))
    profile.disable()
    assert sum(len(b.column("rows")[0]) for b in blocks) == 4000
    calls = sum(entry.callcount for entry in profile.getstats())
    assert calls < 100 * 4000


def test_whole_numbers_and_shared_texts_are_read_as_columns():
    # Calls of Python functions by the row, not by the cell: 14 cells in each of 4,000 rows.
    rows = {10 + i: [f"a{i}", "b", None, i, *["c"] * 10] for i in range(4000)}
    content = workbook_bytes({"s": {0: ["title"], **rows}}, shared=True)
    read = lambda: list(wb._blocks("p", lambda: io.BytesIO(content), None))
    read()
    profile = cProfile.Profile()
    profile.enable()
    blocks = read()
    profile.disable()
    assert sum(entry.callcount for entry in profile.getstats()) < 4 * 4000
    got = [r for b in blocks for r in b.to_pylist()[0]["rows"]]
    assert [r["row_idx"] for r in got] == [0, *rows]
    assert [r["cells"] for r in got[1:]] == [[v if v is None else str(v) for v in row] for row in rows.values()]
    assert all([h["cells"] for h in b.to_pylist()[0]["head"]] == [["title"]] for b in blocks)
    assert all(len(b.column("rows")[0]) <= wb.BLOCK_ROWS for b in blocks)


@pytest.mark.parametrize(
    "row, plain",
    [
        ('<row r="7"><c r="A7" t="s"><v>0</v></c><c r="AB7"><v>12</v></c><c r="XFD7" t="n"><v>0</v></c></row>', True),
        ('<row r="7" spans="1:3"><c r="A7" s="1" t="s"><v>0</v></c><c r="B7" s="1"/><c r="C7"></c><c r="D7"><v></v></c></row>', True),
        ('<row r="7"></row>', True),
        ('<row r="7"/>', False),
        ('<row r="7"><c r="B7"><v>1</v></c><c r="A7"><v>2</v></c></row>', False),
        ('<row r="7"><c r="A7"><v>007</v></c></row>', False),
        ('<row r="7"><c r="A7"><v>-7</v></c></row>', False),
        ('<row r="7"><c r="A7"><v>1.5</v></c></row>', False),
        ('<row r="7"><c r="A7"><v>12345678901234567890</v></c></row>', False),
        ('<row r="7"><c r="A7" s="1"><v>43845</v></c></row>', False),
        ('<row r="7"><c r="A7" t="b"><v>1</v></c></row>', False),
        ('<row r="7"><c r="A7" t="str"><v>é</v></c></row>', False),
        ('<row r="7"><c r="ABCD7"><v>1</v></c></row>', False),
        ('<row r="7"><c r="A"><v>1</v></c></row>', None),
        ('<row r="7"> <c r="A7"><v>1</v></c></row>', None),
        ('<row r="7"><c r="A7"><v>1</v> </c></row>', None),
        ('<row r="7"><c r="A7"><f>1</f><v>1</v></c></row>', None),
    ],
)
def test_columns_give_the_rows_of_the_tree(row, plain):
    # ``plain``: whether the part is read as columns; None where only a tree reads it.
    first = '<row r="1"><c r="A1" t="s"><v>0</v></c></row>'
    strings = wb._Strings()
    strings.extend([b"x"])
    assert (wb._plain_rows(first + row, strings, True) is not None) == bool(plain)
    last = '<row r="9"><c r="A9"><v>5</v></c></row>'
    try:
        rows, usual = rows_of(SHEET.format(f"<sheetData>{first}{row}{last}</sheetData>"))
    except ValueError:
        return
    assert (rows[0], rows[-1]) == ((0, ["x"], []), (8, ["5"], [])) and usual == (plain is not None)


def test_a_number_without_a_shared_text_is_an_error():
    with pytest.raises(IndexError):
        rows_of(SHEET.format('<sheetData><row r="1"><c r="A1" t="s"><v>1</v></c></row></sheetData>'))


def test_long_texts_still_end_a_block():
    texts = [f"{i} " + "é" * 30_000 for i in range(300)]
    content = workbook_bytes({"s": [[t] for t in texts]}, shared=True)
    blocks = list(wb._blocks("p", lambda: io.BytesIO(content), None))
    assert len(blocks) > 3 and [r["cells"] for b in blocks for r in b.to_pylist()[0]["rows"]] == [[t] for t in texts]


@pytest.mark.parametrize("text", ["plain", "", "한글", "a &amp; b", "&lt;", "tab\there", "\x7f", "]]"])
def test_shared_texts_of_all_kinds(text):
    items = [f'<si><t xml:space="preserve">{t}</t></si>' for t in ("one", text, "two")]
    for some in (items, [i.replace(' xml:space="preserve"', "") for i in items], [items[0], "<si><t>two</t></si>", items[1]]):
        cells = "".join(f'<c r="{c}1" t="s"><v>{i}</v></c>' for i, c in enumerate("ABC"))
        strings = f'<sst xmlns="{_main()}">{"".join(some)}</sst>'
        (row,), _ = rows_of(SHEET.format(f'<sheetData><row r="1">{cells}</row></sheetData>'), strings)
        assert row[1] == [ElementTree.fromstring(i.replace("xml:", "")).findtext("t") for i in some]


def test_texts_written_in_bulk_come_back(spark, tmp_path):
    rows = [("a.xlsx", i, ["x", None, "", "<&>", f"한글 {i}"] if i % 3 else [None, ""]) for i in range(9)]
    grid = spark.createDataFrame([*rows, ("b.xlsx", 4, ["only"])], "file string, row_idx int, cells array<string>")
    folder = write_workbooks(grid, str(tmp_path / "out"), lambda name, rows: {"cover": [["x", "cover"]], "data": rows})
    blocks, bad = whole_files(scan_workbooks(list_folder(spark, folder), "data"))
    got = {(r["file"].rsplit("/", 1)[1], r["row_idx"]): r["cells"] for r in grid_of(blocks).collect()}
    assert bad.count() == 0
    assert got == {("b.xlsx", 4): ["only"], **{(f, i): ["x", None, None, "<&>", c[4]] for f, i, c in rows if len(c) > 2}}
