"""Workbook scan: one xlsx file per input row in, blocks of sheet rows out.

Only this step runs Python per file. Tasks get paths and lengths, are filled by size, and open the files themselves,
in ranges: a file's bytes are no column and never move between tasks, and no file is too large. A task walks
one workbook's XML at a time and hands blocks on as they fill. Everything after it is DataFrame work.

A file is published in two steps. Its blocks leave before its end is seen; a last row, ``block = LAST``, says whether
the file was good. ``whole_files`` (or a join on the status rows) drops what came from a file that broke midway.

Rows and shared texts that are written the usual way are read as text, which costs a third of a tree of elements. Every
character must belong to a tag of the known form or to a plain value. At the first that does not, or where what
surrounds them is not well-formed, the part is walked as a tree from there on, with the same rows and errors.
Parts of a sheet that hold nothing but whole numbers and shared texts are read as columns, without a Python object for each cell.
"""

import codecs
import datetime
import io
import re
import sys
import zipfile
from array import array
from collections import deque
from itertools import accumulate, islice
from xml.etree import ElementTree

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Window
from pyspark.sql import functions as F

from portledger.operators.joins import fits_broadcast
from portledger.operators.ranking import with_global_rank
from portledger.schema import BLOCK_SCHEMA, HEADER_SEARCH_ROWS
from portledger.session import pinned

# A block leaves when it holds so many rows or so much text.
BLOCK_ROWS = 512
BLOCK_CHARS = 4 << 20

# ``block`` of the row that closes a file.
LAST = -1

# Bytes a task reads at once, and what opening a file counts for when tasks are filled.
READ_BYTES = 1 << 20
OPEN_COST = 4 << 20

# Bytes of XML given to the parser at once; whole children of them are then walked.
PART_BYTES = 1 << 16

# Bytes of XML that are read as text at once.
TEXT_BYTES = 1 << 18

# Texts of a workbook that stay decoded, and the longest of them.
CACHED_TEXTS = 1 << 14
CACHED_CHARS = 256

# Listings of so few files are numbered in one task; longer ones by ranges, with the same numbers.
SHORT_LISTING = 10_000

# File systems that tasks open themselves, by scheme; other stores are read by Spark, file by file.
DIRECT = {"file": "LocalFileSystem", "s3": "S3FileSystem", "s3a": "S3FileSystem", "gs": "GcsFileSystem"}

# Spark cannot hold a larger file in one row; only stores that tasks cannot open know this limit.
MAX_CONTENT_BYTES = (1 << 31) - (1 << 20)

# Built-in number formats that show a date or a time (ECMA-376 part 1, 18.8.30).
_DATE_FORMAT_IDS = {*range(14, 23), 45, 46, 47}
_ELAPSED_FORMAT_IDS = {46}

_DIGITS = "0123456789"

_ROW = pa.struct(
    [("row_idx", pa.int32()), ("cells", pa.list_(pa.string())), ("dated", pa.list_(pa.int32()))]
)
_BLOCK = pa.schema(
    [
        ("file", pa.string()),
        ("sheet", pa.string()),
        ("block", pa.int32()),
        ("head", pa.list_(_ROW)),
        ("rows", pa.list_(_ROW)),
        ("error", pa.string()),
    ]
)


def scheme_of(path):
    return path.partition(":")[0] if re.match(r"[A-Za-z][A-Za-z0-9+.-]+:", path) else "file"


def open_direct(path):
    """A seekable file of a store in ``DIRECT``, read in ranges."""
    import pyarrow.fs

    scheme = scheme_of(path)
    name = path[len(scheme) + 1 :] if path.startswith(scheme + ":") else path
    # A local path has one slash or three after its scheme; others name a bucket.
    name = "/" + name.lstrip("/") if scheme == "file" else name.lstrip("/")
    file = getattr(pyarrow.fs, DIRECT[scheme])().open_input_file(name)
    return io.BufferedReader(_Ranges(file), READ_BYTES)


class _Ranges(io.RawIOBase):
    """A file of an Arrow file system as Python's own kind; a place before its start is an OSError, as zip readers expect."""

    def __init__(self, file):
        self.file, self.size, self.at = file, file.size(), 0

    def readable(self):
        return True

    def seekable(self):
        return True

    def seek(self, offset, whence=io.SEEK_SET):
        at = offset + (0, self.at, self.size)[whence]
        if at < 0:
            raise OSError("place before the start of the file")
        self.at = at
        return at

    def tell(self):
        return self.at

    def readinto(self, buffer):
        data = self.file.read_at(min(len(buffer), max(0, self.size - self.at)), self.at)
        buffer[: len(data)] = data
        self.at += len(data)
        return len(data)

    def close(self):
        if not self.closed:
            self.file.close()
        super().close()


def scan_workbooks(listing, sheet=None, opener=None):
    """Blocks of all listed workbooks, ``(path, length)`` and more; ``sheet=None`` takes each file's first sheet.

    ``opener`` turns a path into a seekable file inside a task, for stores beyond ``DIRECT``. Without one, files of such stores
    are read by Spark. The listing must give the same rows each time it is read.
    """
    total = F.coalesce(F.sum(F.col("length") + OPEN_COST), F.lit(0))
    if opener is not None:
        return _decoded_paths(listing, listing.agg(total, F.count("*")).first(), sheet, opener)
    scheme = F.when(F.col("path").rlike("^[A-Za-z][A-Za-z0-9+.-]+:"), F.substring_index("path", ":", 1)).otherwise("file")
    by_task = scheme.isin(list(DIRECT))
    # Two rows at most; of both kinds only those that are there are planned.
    kinds = {r[0]: r[1:] for r in listing.groupBy(by_task).agg(total, F.count("*")).collect()}
    parts = []
    if True in kinds or not kinds:
        parts.append(_decoded_paths(listing.where(by_task), kinds.get(True, (0, 0)), sheet, open_direct))
    if False in kinds:
        parts.append(_decoded_contents(listing.where(~by_task), sheet))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _decoded_paths(listing, measured, sheet, opener):
    def decode(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                yield from _blocks(path, lambda: opener(path), sheet)

    return dealt_by_size(listing, *measured).select("path").mapInArrow(decode, BLOCK_SCHEMA)


def dealt_by_size(listing, total, files):
    """The listing, of ``files`` files and ``total`` bytes, dealt to as many tasks as its bytes fill, largest files first, like cards.

    A task gets about ``spark.sql.files.maxPartitionBytes``, less where that would leave cores idle, one file at least.
    """
    spark = listing.sparkSession
    full = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(
        spark.conf.get("spark.sql.files.maxPartitionBytes")
    )
    tasks = max(1, min(files, max(-(-total // full), spark.sparkContext.defaultParallelism)))
    order = [F.desc("length"), F.asc("path")]
    listing = listing.select("path", "length")
    if files <= SHORT_LISTING:
        ranked = listing.withColumn("rank", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*order)))
    else:
        ranked = pinned(with_global_rank(listing, order))
    return ranked.repartitionById(tasks, ((F.col("rank") - 1) % tasks).cast("int"))


def _decoded_contents(listing, sheet):
    """Files that only Spark can read, one row each; larger ones than a row holds are reported."""
    spark = listing.sparkSession
    names = listing.where(F.col("length") <= MAX_CONTENT_BYTES).select("path").distinct()
    folder = F.expr("substring(path, 1, length(path) - length(substring_index(path, '/', -1)))")
    # A run lists one folder, or files that a caller named.
    folders = [re.sub(r"([\\{}\[\]*?,])", r"\\\1", r[0]) for r in listing.select(folder).distinct().collect()]
    files = spark.read.format("binaryFile").load(folders)
    # Only listed files are opened; while their names fit a broadcast (measured), contents stay where they are read.
    listed = files.join(F.broadcast(names) if fits_broadcast(names) else names, "path", "left_semi")
    blocks = decode_workbooks(listed, sheet)
    large = listing.where(F.col("length") > MAX_CONTENT_BYTES).select(F.col("path").alias("file"))
    message = "file is too large for a store that tasks cannot open"
    closing = {f.name: F.lit(None).cast(f.dataType) for f in BLOCK_SCHEMA.fields if f.name != "file"}
    closing |= {"block": F.lit(LAST), "error": F.lit(message), "head": F.array().cast(BLOCK_SCHEMA["head"].dataType)}
    closing["rows"] = closing["head"]
    return blocks.unionByName(large.withColumns(closing))


def decode_workbooks(files, sheet=None):
    """Decode rows of ``(path, content)`` into blocks."""

    def decode(batches):
        for batch in batches:
            paths, contents = batch.column(0), batch.column(1)
            for i in range(batch.num_rows):
                yield from _blocks(paths[i].as_py(), lambda: pa.BufferReader(contents[i].as_buffer()), sheet)

    return files.select("path", "content").mapInArrow(decode, BLOCK_SCHEMA)


def whole_files(blocks):
    """The blocks of files that were good to their end, with their closing rows, and the errors of the others.

    The blocks are checkpointed, so no file is read twice; bad files are dropped by a join afterwards.
    """
    blocks = pinned(blocks)
    bad = blocks.where((F.col("block") == LAST) & F.col("error").isNotNull()).select("file", "error")
    if bad.limit(1).count() == 0:
        return blocks, bad
    names = bad.select("file")
    return blocks.join(F.broadcast(names) if fits_broadcast(names) else names, "file", "left_anti"), bad


def grid_of(blocks):
    """Blocks as the flat relation ``(file, sheet, row_idx, cells)``, one row per sheet row."""
    return blocks.select("file", "sheet", F.explode("rows").alias("r")).select(
        "file", "sheet", "r.row_idx", "r.cells"
    )


def _blocks(path, opened, sheet):
    # Blocks leave as they fill; the last row says whether the file was good.
    head, name = _Rows(), sheet
    try:
        with opened() as source, zipfile.ZipFile(source) as archive:
            book = _Workbook(archive)
            name, member = book.find(sheet)
            chunk, made = _Rows(), 0
            for run in book.runs(member):
                while run:
                    part, run = run.cut(BLOCK_ROWS - len(chunk))
                    head.extend(part.first())
                    chunk.extend(part)
                    if len(chunk) == BLOCK_ROWS or chunk.chars >= BLOCK_CHARS:
                        yield _batch(path, name, made, head, chunk, None)
                        chunk, made = _Rows(), made + 1
            if len(chunk):
                yield _batch(path, name, made, head, chunk, None)
        yield _batch(path, name, LAST, head, _Rows(), None)
    except Exception as exc:  # any broken file is one error row; the other files go on
        yield _batch(path, name, LAST, head, _Rows(), f"{type(exc).__name__}: {exc}")


class _Row:
    """One sheet row."""

    def __init__(self, at, cells, dated):
        self.at, self.cells, self.dated = at, cells, dated

    def cut(self, n):
        return self, None

    def first(self):
        return self if self.at < HEADER_SEARCH_ROWS else None

    def rows(self):
        return [(self.at, self.cells, self.dated)]


class _Plain:
    """Sheet rows without dates as columns: their positions, their cells as lists; ``chars`` counts the bytes of their texts."""

    def __init__(self, at, cells, chars):
        self.at, self.cells, self.chars = at, cells, chars

    def __len__(self):
        return len(self.at)

    def cut(self, n):
        """The first ``n`` rows and the others; the texts count for the first."""
        return _Plain(self.at[:n], self.cells[:n], self.chars), _Plain(self.at[n:], self.cells[n:], 0)

    def first(self):
        found = [i for i, at in enumerate(self.at) if at < HEADER_SEARCH_ROWS]
        return _Plain([self.at[i] for i in found], self.cells.take(pa.array(found, pa.int32())), 0) if found else None

    def rows(self):
        return [(at, cells, []) for at, cells in zip(self.at, self.cells.to_pylist())]


class _Rows:
    """Sheet rows as they fill the columns of ``_ROW``."""

    def __init__(self):
        self.full, self.chars, self.count = [], 0, 0
        self._clear()

    def __len__(self):
        return self.count

    def _clear(self):
        self.at, self.cells, self.dated, self.ends, self.dated_ends = [], [], [], [0], [0]

    def extend(self, run):
        if run is None:
            return
        if isinstance(run, _Plain):
            self._close()
            none = pa.ListArray.from_arrays(pa.array([0] * (len(run) + 1), pa.int32()), pa.array([], pa.int32()))
            self.full.append([pa.array(run.at, pa.int32()), run.cells, none])
            self.chars += run.chars
            self.count += len(run)
            return
        self.at.append(run.at)
        self.cells += run.cells
        self.ends.append(len(self.cells))
        self.dated += run.dated
        self.dated_ends.append(len(self.dated))
        self.chars += len("".join(filter(None, run.cells)))
        self.count += 1

    def _close(self):
        """Rows that came one by one become columns."""
        if self.at or not self.full:
            lists = lambda ends, values, of: pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, of))
            cells, dated = lists(self.ends, self.cells, pa.string()), lists(self.dated_ends, self.dated, pa.int32())
            self.full.append([pa.array(self.at, pa.int32()), cells, dated])
            self._clear()

    def array(self):
        """All rows as one list."""
        self._close()
        columns = [c[0] if len(c) == 1 else pa.concat_arrays(c) for c in zip(*self.full)]
        return pa.ListArray.from_arrays(pa.array([0, self.count], pa.int32()), pa.StructArray.from_arrays(columns, fields=list(_ROW)))


def _batch(path, sheet, block, head, rows, error):
    values = [path, sheet, block, head.array(), rows.array(), error]
    return pa.RecordBatch.from_arrays(
        [v if isinstance(v, pa.Array) else pa.array([v], type=f.type) for v, f in zip(values, _BLOCK)], schema=_BLOCK
    )


def _local(tag):
    return tag.rpartition("}")[2]


def _children(element, name):
    return [e for e in element.iter() if _local(e.tag) == name]


def _elements(part, name, parent):
    """Children ``name`` of the element ``parent`` of an XML part, in order, each detached before the next part is read, so none is kept.

    The parser builds the tree by itself, a part at a time; all children but the last are whole then. Events
    only show where ``parent`` is.
    """
    parser, holder = ElementTree.XMLPullParser(["start"]), None
    more = True
    while more:
        more = part.read(PART_BYTES)
        if more:
            parser.feed(more)
        else:
            parser.close()
        if holder is None:
            holder = next((e for _, e in parser.read_events() if _local(e.tag) == parent), None)
        deque(parser.read_events(), maxlen=0)
        if holder is not None:
            whole = slice(-1 if more else None)
            for e in holder[whole]:
                if _local(e.tag) == name:
                    yield e
            del holder[whole]


class _Unusual(Exception):
    """A part is not written the usual way; its tree has to be walked."""


# Characters of a value that stand for themselves.
_PLAIN = r"[^<>&\x00-\x1f\ufffe\uffff]*"
_START = re.compile(r'(?:<\?xml version="1\.0"(?: encoding="[Uu][Tt][Ff]-8")?(?: standalone="(?:yes|no)")?\?>)?\s*(?:<[^?!]*)?\Z')
_SHEET_DATA = re.compile("<sheetData>")
_SST = re.compile("<sst [^<>]*[^<>/]>")
_ROW_TAG = (
    r'<row r="([0-9]+)"(?: spans="[0-9: ]*")?(?: s="[0-9]+")?(?: customFormat="[01]")?(?: ht="[0-9.]+")?'
    r'(?: hidden="[01]")?(?: customHeight="[01]")?(/?)>'
)
# Column, style, kind and value of a cell; number of a row and whether it ends at once; end of a row; anything else.
_CELL_OR_ROW = re.compile(
    rf'<c r="([A-Z]+)[0-9]+"(?: s="([0-9]+)")?(?: t="(s|n|b|e|str|d)")?(?:><v>({_PLAIN})</v></c>|></c>|/>)'
    rf'|{_ROW_TAG}|(</row>)|(.)',
    re.DOTALL,
)
_ROW_START = re.compile(_ROW_TAG)
_SHARED = re.compile(rf'<si><t(?: xml:space="preserve")?>({_PLAIN})</t></si>|(.)', re.DOTALL)


def _texts(part, opening, closing, item):
    """The text between ``opening`` and ``closing``, in pieces that end after an ``item``; the rest must be well-formed XML."""
    decoder, around = codecs.getincrementaldecoder("utf-8")(), ElementTree.XMLPullParser(["start"])

    def read():
        data = part.read(TEXT_BYTES)
        if not data:
            raise _Unusual
        return decoder.decode(data)

    try:
        text = read()
        start = opening.search(text)
        if start is None or not _START.match(text[: start.start()]):
            raise _Unusual
        around.feed(text[: start.end()])
        # Bare names are of a namespace, as elsewhere.
        if not [e.tag for _, e in around.read_events()][-1].startswith("{"):
            raise _Unusual
        text = text[start.end() :]
        while (stop := text.find(closing)) < 0:
            end = text.rfind(item) + len(item)
            if end >= len(item):
                yield text[:end]
                text = text[end:]
            elif len(text) > BLOCK_CHARS:
                raise _Unusual
            text += read()
        yield text[:stop]
        around.feed(text[stop:])
        while data := part.read(PART_BYTES):
            around.feed(decoder.decode(data))
        around.feed(decoder.decode(b"", True))
        around.close()
    except (ElementTree.ParseError, UnicodeDecodeError) as exc:
        raise _Unusual from exc


# Tags of a sheet, by what they begin with: cell, its value and their ends, row and its end. Last a cell that ends at once.
_TAGS = [b'<c r="', b"<v>", b"</v>", b"</c>", b'<row r="', b"</row>"]
_CELL, _VALUE, _VALUE_END, _CELL_END, _ROW_OPEN, _ROW_END, _EMPTY = range(1, 8)
_FOLLOWS = np.zeros((8, 8), bool)
for _tag, _next in [
    (_CELL, [_VALUE, _CELL_END]),
    (_VALUE, [_VALUE_END]),
    (_VALUE_END, [_CELL_END]),
    (_CELL_END, [_CELL, _EMPTY, _ROW_END]),
    (_EMPTY, [_CELL, _EMPTY, _ROW_END]),
    (_ROW_OPEN, [_CELL, _EMPTY, _ROW_END]),
    (_ROW_END, [_ROW_OPEN]),
]:
    _FOLLOWS[_tag, _next] = True
_FOLLOWS = _FOLLOWS.ravel()

# Digits of a number that is read as columns, and cells with the gaps between them.
PLAIN_DIGITS = 9
PLAIN_CELLS = 1 << 20


def _numbers(data, first, last):
    """The numbers between places, or None where one is not of one to ``PLAIN_DIGITS`` digits."""
    width = last - first
    if not len(width):
        return width
    most = width.max()
    if width.min() < 1 or most > PLAIN_DIGITS:
        return None
    numbers = np.zeros(len(width), np.int64)
    for i in range(most):
        inside, digit = width > i, data[first + i] - np.uint8(48)
        if (inside & (digit > 9)).any():
            return None
        numbers = np.where(inside, numbers * 10 + digit, numbers)
    return numbers


def _plain_rows(text, strings, styled):
    """The whole rows of ``text`` as columns, or None where a cell is not a whole number, a shared text or empty.

    Every character is accounted for: tags follow each other as ``_FOLLOWS`` says, with nothing between them but digits of a value.
    Where ``styled``, numbers with a style may be dates.
    """
    if not text.isascii():
        return None
    raw = text.encode() + bytes(16)
    data = np.frombuffer(raw, np.uint8)
    words = np.ndarray(len(raw) - 7, "<u8", raw, 0, (1,))
    begins = lambda found, tag: (found & np.uint64((1 << 8 * len(tag)) - 1)) == int.from_bytes(tag, "little")
    opens, closes = np.flatnonzero(data == ord("<")), np.flatnonzero(data == ord(">"))
    if not len(opens) or len(opens) != len(closes) or opens[0] or closes[-1] != len(text) - 1:
        return None
    between = opens[1:] - closes[:-1] - 1
    if (opens > closes).any() or (between < 0).any():
        return None
    at_tag = words[opens]
    tags = np.zeros(len(opens), np.int8)
    for i, tag in enumerate(_TAGS, 1):
        tags[begins(at_tag, tag)] = i
    tags[(tags == _CELL) & (data[closes - 1] == ord("/"))] = _EMPTY
    if tags[0] != _ROW_OPEN or tags[-1] != _ROW_END or not _FOLLOWS[tags[:-1] * 8 + tags[1:]].all() or between[tags[:-1] != _VALUE].any():
        return None

    # Columns and kinds of all cells.
    cells = np.flatnonzero((tags == _CELL) | (tags == _EMPTY))
    if not len(cells):
        return None
    ends = closes[cells] - (tags[cells] == _EMPTY)
    start = opens[cells] + len(_TAGS[0])
    quotes = np.append(np.flatnonzero(data == ord('"')), [len(text)] * 4)
    quote = np.searchsorted(quotes, start)
    close = quotes[quote]
    # Letters by their place in the alphabet; other characters are 0 or above 26.
    letters = [data[start + i] - np.uint8(64) for i in range(3)]
    capital = [(a > 0) & (a <= 26) for a in letters]
    if not capital[0].all():
        return None
    column, begin = letters[0].astype(np.int64), start + 1
    if capital[1].any():
        capital[2] &= capital[1]
        for a, there in zip(letters[1:], capital[1:]):
            column, begin = np.where(there, column * 26 + a, column), begin + there
    column -= 1
    if _numbers(data, begin, close) is None:
        return None
    rest = close + 1
    style = begins(words[rest], b' s="')
    if style.any():
        close = quotes[quote + 2]
        if _numbers(data, rest[style] + 4, close[style]) is None:
            return None
        rest = np.where(style, close + 1, rest)
    kind, left = words[rest], ends - rest
    shared = (left == 6) & begins(kind, b' t="s"')
    if not (shared | (left == 0) | (left == 6) & begins(kind, b' t="n"')).all():
        return None

    # Values; cells without one are left out.
    valued = (tags[cells] == _CELL) & (tags[cells + 1] == _VALUE)
    valued[valued] &= between[cells[valued] + 1] > 0
    cells, column, shared, style = cells[valued], column[valued], shared[valued], style[valued]
    if not len(cells):
        return None
    first, last = closes[cells + 1] + 1, opens[cells + 2]
    width = last - first
    index = _numbers(data, first, last)
    if index is None or (~shared & ((styled & style) | ((data[first] == 48) & (width > 1)))).any():
        return None
    index = index[shared]
    if len(index) and index.max() >= len(strings):
        return None

    # Rows, and where their cells stand in them.
    started = tags == _ROW_OPEN
    first_row, closed = opens[started] + len(_TAGS[4]), closes[started]
    positions = _numbers(data, first_row, closed - 1) if (data[closed - 1] == ord('"')).all() else None
    if positions is None:
        # Rows with more than their number.
        found = [_ROW_START.match(text, a) for a in opens[started].tolist()]
        if not all(found) or any(m[2] for m in found):
            return None
        positions = np.array([int(m[1]) for m in found])
    row = (np.cumsum(started) - 1)[cells]
    turn = row[1:] != row[:-1]
    if (~turn & (column[1:] <= column[:-1])).any():
        return None
    closing = np.append(turn, True)
    lengths = column[closing] + 1
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    chars = strings.size(index) + int(width[~shared].sum())
    if offsets[-1] > PLAIN_CELLS or chars > BLOCK_CHARS:
        return None
    values, order = strings.take(index), np.arange(len(cells))
    if not shared.all():
        numbers = [text[a:b] for a, b in zip(first[~shared].tolist(), last[~shared].tolist())]
        values = pa.concat_arrays([values, pa.array(numbers, pa.string())])
        order[shared], order[~shared] = np.arange(len(index)), len(index) + np.arange(len(numbers))
    if offsets[-1] > len(cells) or not shared.all():
        taken = np.full(offsets[-1], -1)
        taken[offsets[np.concatenate([[0], np.cumsum(turn)])] + column] = order
        values = values.take(pa.array(taken, mask=taken < 0))
    at = (positions[row[closing]] - 1).tolist()
    return _Plain(at, pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values), chars)


class _Strings:
    """Texts by number, end to end in one buffer: little more than their bytes. All are there before one is read."""

    def __init__(self):
        self.data, self.ends, self.decoded, self.column = bytearray(), array("q", [0]), {}, None

    def __len__(self):
        return len(self.ends) - 1

    def extend(self, texts):
        """Adds encoded texts."""
        self.ends.extend(islice(accumulate(map(len, texts), initial=self.ends[-1]), 1, None))
        self.data += b"".join(texts)

    def size(self, numbers):
        """Bytes of the texts ``numbers``."""
        ends = np.frombuffer(self.ends, np.int64)
        return int((ends[numbers + 1] - ends[numbers]).sum())

    def take(self, numbers):
        if self.column is None:
            buffers = [None, pa.py_buffer(self.ends), pa.py_buffer(self.data)]
            self.column = pa.Array.from_buffers(pa.large_string(), len(self), buffers)
        return self.column.take(pa.array(numbers)).cast(pa.string())

    def append(self, text):
        self.data += text.encode("utf-8", "surrogatepass")
        self.ends.append(len(self.data))

    def __getitem__(self, i):
        if i < 0:
            raise IndexError(i)
        return self.data[self.ends[i] : self.ends[i + 1]].decode("utf-8", "surrogatepass")

    def read(self, number):
        """The text of a cell's ``number``, as written; a bounded number of short ones stay decoded."""
        value = self.decoded.get(number)
        if value is None:
            value = self[int(number)]
            if len(value) <= CACHED_CHARS:
                if len(self.decoded) >= CACHED_TEXTS:
                    self.decoded.clear()
                self.decoded[number] = value
        return value


_SI, _SI_END = [b'<si><t xml:space="preserve">', b"<si><t>"], b"</t></si>"


def _plain_texts(piece):
    """The shared texts of ``piece``, encoded, or None where not all are plain and begin alike."""
    if "&" in piece or "\ufffe" in piece or "\uffff" in piece:
        return None
    data = piece.encode()
    begin = next(filter(data.startswith, _SI), None)
    if begin is None or not data.endswith(_SI_END) or (np.frombuffer(data, np.uint8) < 32).any():
        return None
    texts = data[len(begin) : -len(_SI_END)].split(_SI_END + begin)
    return texts if data.count(b"<") == data.count(b">") == 4 * len(texts) else None


class _Workbook:
    """The few parts of an xlsx package needed to read cell values."""

    def __init__(self, archive):
        self.archive = archive
        self.columns = {}
        names = set(archive.namelist())
        book = ElementTree.fromstring(archive.read("xl/workbook.xml"))
        rels = ElementTree.fromstring(archive.read("xl/_rels/workbook.xml.rels"))
        targets = {
            r.get("Id"): r.get("Target")
            for r in _children(rels, "Relationship")
            if r.get("Type", "").endswith("/worksheet")
        }
        self.sheets = {}
        for s in _children(book, "sheet"):
            rel = next(v for k, v in s.attrib.items() if _local(k) == "id" and k != "id")
            if rel in targets:
                target = targets[rel]
                self.sheets[s.get("name")] = target.lstrip("/") if target[0] == "/" else "xl/" + target
        props = _children(book, "workbookPr")
        self.from_1904 = bool(props) and props[0].get("date1904") in ("1", "true")
        self.shared = self._shared_strings() if "xl/sharedStrings.xml" in names else _Strings()
        self.date_styles, self.elapsed_styles = (
            self._date_styles() if "xl/styles.xml" in names else (set(), set())
        )

    def find(self, sheet):
        if sheet is None:
            if not self.sheets:
                raise ValueError("workbook has no sheet")
            return next(iter(self.sheets.items()))
        if sheet not in self.sheets:
            raise ValueError(f"sheet '{sheet}' not found, available: {list(self.sheets)}")
        return sheet, self.sheets[sheet]

    def _shared_strings(self):
        strings = _Strings()
        try:
            with self.archive.open("xl/sharedStrings.xml") as part:
                for piece in _texts(part, _SST, "</sst>", "</si>"):
                    found = _plain_texts(piece)
                    if found is None:
                        found = []
                        for text, other in _SHARED.findall(piece):
                            if other:
                                raise _Unusual
                            found.append(text.encode())
                    strings.extend(found)
                return strings
        except _Unusual:
            known = len(strings)
        with self.archive.open("xl/sharedStrings.xml") as part:
            for e in islice(_elements(part, "si", "sst"), known, None):
                strings.append(_rich_text(e))
        return strings

    def _date_styles(self):
        root = ElementTree.fromstring(self.archive.read("xl/styles.xml"))
        custom = {int(f.get("numFmtId")): f.get("formatCode", "") for f in _children(root, "numFmt")}
        dates, elapsed = set(), set()
        for group in _children(root, "cellXfs"):
            for i, xf in enumerate(group):
                fmt = int(xf.get("numFmtId", 0))
                if _shows_date(custom[fmt]) if fmt in custom else fmt in _DATE_FORMAT_IDS:
                    dates.add(i)
                if _shows_elapsed(custom[fmt]) if fmt in custom else fmt in _ELAPSED_FORMAT_IDS:
                    elapsed.add(i)
        return dates, elapsed

    def rows(self, member):
        """Rows in sheet order as ``(zero-based sheet position, cells, columns of dates)``; rows without cells are left out."""
        for run in self.runs(member):
            yield from run.rows()

    def runs(self, member):
        """The rows of ``rows``, in order, each a ``_Row`` or many as a ``_Plain``."""
        known = 0
        try:
            with self.archive.open(member) as part:
                for run in self._usual_runs(part):
                    yield run
                    known += len(run) if isinstance(run, _Plain) else 1
                return
        except _Unusual:
            pass
        with self.archive.open(member) as part:
            for row in islice(self._tree_rows(part), known, None):
                yield _Row(*row)

    def _usual_rows(self, part):
        for run in self._usual_runs(part):
            yield from run.rows()

    def _usual_runs(self, part):
        text, known, date_styles, columns = self.shared.read, self.shared.decoded, self.date_styles, self.columns
        at = None
        for piece in _texts(part, _SHEET_DATA, "</sheetData>", "</row>"):
            plain = _plain_rows(piece, self.shared, bool(date_styles)) if at is None else None
            if plain is not None:
                yield plain
                continue
            for letters, style, kind, raw, number, closed, end, other in _CELL_OR_ROW.findall(piece):
                if letters:
                    if at is None:
                        raise _Unusual
                    if not raw:
                        continue
                    col = columns.get(letters)
                    if col is None:
                        col = columns[letters] = _column_index(letters)
                    if kind == "s":
                        value = known.get(raw)
                        if value is None:
                            value = text(raw)
                    elif (not kind or kind == "n") and raw.isdecimal() and int(style or 0) not in date_styles:
                        value = str(int(raw))
                    else:
                        value = self._value(raw, kind or "n", int(style or 0), col, dated)
                    if col > len(cells):
                        cells.extend([None] * (col - len(cells)))
                    cells.append(value)
                elif end and at is not None:
                    if cells:
                        yield _Row(at, cells, dated)
                    at = None
                elif number and at is None:
                    if not closed:
                        at, cells, dated = int(number) - 1, [], []
                else:
                    raise _Unusual
        if at is not None:
            raise _Unusual

    def _tree_rows(self, part):
        at = -1
        for e in _elements(part, "row", "sheetData"):
            position = e.get("r")
            at = int(position) - 1 if position else at + 1
            row = self._row(at, e)
            if row[1]:
                yield row

    def _row(self, at, element):
        cells, dated, col = [], [], -1
        columns = self.columns
        for c in element:
            if c.tag[-2:] != "}c":
                continue
            ref = c.get("r")
            if ref:
                letters = ref.rstrip(_DIGITS)
                col = columns.get(letters)
                if col is None:
                    col = columns[letters] = _column_index(letters)
            else:
                col += 1
            if not len(c):
                continue
            kind = c.get("t", "n")
            if kind == "inlineStr":
                value = _rich_text(c)
            else:
                raw = next((e.text for e in c if e.tag[-2:] == "}v"), None)
                value = None if raw is None else self._value(raw, kind, int(c.get("s", 0)), col, dated)
            if value is None:
                continue
            if col > len(cells):
                cells.extend([None] * (col - len(cells)))
            cells.append(value)
        return at, cells, dated

    def _value(self, raw, kind, style, col, dated):
        """Cell text as Python prints the value; the column of a calendar date goes to ``dated``."""
        if kind == "s":
            return self.shared.read(raw)
        if kind == "n":
            number = float(raw) if "." in raw or "e" in raw or "E" in raw else int(raw)
            if style not in self.date_styles:
                return str(number)
            text, is_date = _serial_date(number, self.from_1904, style in self.elapsed_styles)
        elif kind == "d":
            text, is_date = str(datetime.datetime.fromisoformat(raw.rstrip("Z"))), True
        else:
            return str(bool(int(raw))) if kind == "b" else raw
        if is_date:
            dated.append(col)
        return text


def _rich_text(element):
    # Phonetic hints (rPh) are annotations, not part of the text.
    parts = []
    for e in element:
        tag = _local(e.tag)
        if tag == "t":
            parts.append(e.text or "")
        elif tag in ("r", "is"):
            parts.append(_rich_text(e))
    return "".join(parts)


def _column_index(letters):
    index = 0
    for ch in letters:
        index = index * 26 + ord(ch.upper()) - 64
    return index - 1


def _shows_date(code):
    # Literal text, escapes, colours and conditions do not make a format a date.
    first = code.split(";")[0]
    bare = re.sub(r'"[^"]*"|\\.|_.|\*.|\[(?!h+\]|m+\]|s+\])[^\]]*\]', "", first, flags=re.I)
    return bool(re.search(r"[dmyhs]", bare, re.I))


def _shows_elapsed(code):
    return bool(re.search(r"\[(h+|m+|s+)\]", code.split(";")[0], re.I))


# Fixed value: what a cell shows that cannot be a date.
DATE_ERROR = "#VALUE!"


def _serial_date(number, from_1904, elapsed):
    """Day count as date-time text; day counts below one are times of day, elapsed formats durations.

    A count beyond the calendar is an error text, for its cell alone.
    """
    try:
        return _dated(number, from_1904, elapsed)
    except (OverflowError, ValueError):
        return DATE_ERROR, False


def _dated(number, from_1904, elapsed):
    if elapsed:
        return str(datetime.timedelta(days=number)), False
    span = datetime.timedelta(milliseconds=round(number * 86_400_000))
    if 0 <= number < 1 and span.days == 0:
        return str((datetime.datetime.min + span).time()), False
    if from_1904:
        return str(datetime.datetime(1904, 1, 1) + span), True
    # The 1900 calendar counts a 29 February 1900 that never was, so early days are off by one.
    base = datetime.datetime(1899, 12, 31) if 0 < number < 60 else datetime.datetime(1899, 12, 30)
    return str(base + span), True


# Tasks get this module's code with the plan, so executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
