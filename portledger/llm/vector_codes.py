"""Product codes of integer vectors, assigned by orchard search.

A vector becomes integers, is cut into ``PARTS`` equal parts, and each part is replaced by the number of the nearest entry of
its position's codebook. Codebooks start as the parts of the vectors with the smallest ids and are moved to the floor of
their parts' mean in each of ``ROUNDS`` rounds.

Orchard search: for every codebook entry all entries are listed by distance from it. A part starts at some entry and goes
through that entry's list. A nearer entry (or an equally near one of lower number) becomes the current one, and the search jumps
to its list; entries measured before are marked and skipped. An entry further than twice the current distance from the current
entry cannot be nearer by the triangle inequality, nor can any after it, so the search stops there. Entries at exactly
twice are still measured, as they may tie. All distances are integers, so the result is exact. A task searches its parts
together, one step of every part at a time.

The codebooks are ``PARTS`` x ``ENTRIES`` parts of a vector, whatever the table size; they travel with the tasks. Tasks add
up the parts of each entry before anything is shuffled, so a vector that fills a third of the table is one row per task.

Rows whose vector is null, empty, or holds null or non-finite components take no part, nor do vectors whose length is not a
multiple of ``PARTS`` or not that of the smallest usable id. With fewer than ``ENTRIES`` vectors the codebooks are as much
shorter. Null ids come after all others; equal ids are ordered by their vectors. Equal distances go to the
lower entry. Repeated rows are coded each. Integers that do not fit 64 bits are computed with unbounded ones; an error
beyond 64 bits, or a sum of errors beyond them, is null. No usable vector gives no rows. Other columns are not read.
"""

import hashlib
import math
from decimal import Decimal

import numpy as np
import pyarrow as pa

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from portledger.llm.common import Scratch, read_table, small_side
from portledger.session import pinned

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
# Larger integers than this are added and squared as unbounded ones.
SAFE = 1 << 26
# Parts searched together.
CHUNK = 1 << 16

# Sums travel in digits of so many bits: any number of any size adds up without overflow.
LIMB = 48

SUMS = "part int, entry int, component int, limb int, total decimal(38,0), n long"


def _integers(column, dim):
    """Floors of the scaled components of an Arrow list column, one row per vector."""
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, dim)
    if not len(flat) or np.abs(flat).max() < SAFE / SCALE:
        return np.floor(flat * SCALE).astype(np.int64)
    # From 2^53 on a double is a whole number; scaling it first might leave the doubles.
    whole = lambda v: int(v) * SCALE if abs(v) >= 1 << 53 else math.floor(v * SCALE)
    return np.array([[whole(v) for v in row] for row in flat.tolist()], dtype=object)


def _squared(a, b):
    """Squared distances of rows that lie side by side."""
    d = a - b
    return (d * d).sum(axis=-1)


class Orchard:
    """Neighbour lists of one codebook and the search through them."""

    def __init__(self, entries):
        self.entries = entries
        gaps = _squared(entries[:, None, :], entries[None, :, :])
        # By distance, ties by number: an entry's list begins with entries equal to it.
        self.lists = np.argsort(gaps, axis=1, kind="stable")
        self.gaps = np.take_along_axis(gaps, self.lists, axis=1)
        # A good start is an entry whose components add up to nearly the same.
        sums = entries.sum(axis=1)
        self.by_sum = np.argsort(sums, kind="stable")
        self.sums = sums[self.by_sum]

    def nearest(self, x):
        """``(entry, squared distance)`` of every row of ``x``; ties go to the lower entry."""
        k = len(self.entries)
        if x.dtype == object or self.entries.dtype == object:
            x, entries = x.astype(object), self.entries.astype(object)
        else:
            entries = self.entries
        at = np.searchsorted(self.sums, x.sum(axis=1)).astype(np.int64).clip(0, k - 1)
        best = self.by_sum[at]
        dist = _squared(x, entries[best])
        step = np.zeros(len(x), np.int64)
        seen = np.zeros((len(x), k), bool)
        seen[np.arange(len(x)), best] = True
        active = np.arange(len(x))
        while len(active):
            own, place = best[active], step[active]
            # The end of the list, or beyond twice the current distance: nothing further on is as near.
            going = place < k
            going[going] = self.gaps[own[going], place[going]] <= 4 * dist[active[going]]
            active, own, place = active[going], own[going], place[going]
            entry = self.lists[own, place]
            step[active] += 1
            fresh = ~seen[active, entry]
            rows, entry = active[fresh], entry[fresh]
            seen[rows, entry] = True
            d = _squared(x[rows], entries[entry])
            better = (d < dist[rows]) | ((d == dist[rows]) & (entry < best[rows]))
            rows = rows[better]
            best[rows], dist[rows], step[rows] = entry[better], d[better], 0
        return best, dist


def _assigned(x, orchards):
    """Entries and squared distances of all parts, vectors by parts."""
    width = x.shape[1] // PARTS
    codes, errors = np.empty((len(x), PARTS), np.int64), np.empty((len(x), PARTS), object if x.dtype == object else np.int64)
    for p, orchard in enumerate(orchards):
        for at in range(0, len(x), CHUNK):
            rows = slice(at, at + CHUNK)
            codes[rows, p], errors[rows, p] = orchard.nearest(x[rows, p * width : (p + 1) * width])
    return codes, errors


def _summing(books, dim):
    def summing(batches):
        orchards = [Orchard(b) for b in books]
        width = dim // PARTS
        k = len(books[0])
        totals, counts = np.zeros((PARTS, k, width), object), np.zeros((PARTS, k), np.int64)
        for batch in batches:
            x = _integers(batch.column(0), dim)
            codes, _ = _assigned(x, orchards)
            for p in range(PARTS):
                part = x[:, p * width : (p + 1) * width]
                own = np.zeros((k, width), x.dtype)
                np.add.at(own, codes[:, p], part)
                totals[p] += own
                counts[p] += np.bincount(codes[:, p], minlength=k)
        rows = [
            (int(p), int(e), c, limb, Decimal(digit), int(counts[p, e]))
            for p, e in zip(*np.nonzero(counts))
            for c in range(width)
            for limb, digit in _digits(int(totals[p, e, c]))
        ]
        if rows:
            kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.decimal128(38, 0), pa.int64())
            names = ["part", "entry", "component", "limb", "total", "n"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    return summing


def _digits(number):
    """``(limb, digit)`` of a whole number, digits with its sign; limb 0 always."""
    sign, rest, limb = (-1 if number < 0 else 1), abs(number), 0
    while rest or not limb:
        yield limb, sign * (rest & ((1 << LIMB) - 1))
        rest, limb = rest >> LIMB, limb + 1


def _coding(books, dim):
    def coding(batches):
        orchards = [Orchard(b) for b in books]
        for batch in batches:
            codes, errors = _assigned(_integers(batch.column(0), dim), orchards)
            text = codes.astype(np.uint8).tobytes().hex()
            code = [text[i : i + 2 * PARTS] for i in range(0, len(text), 2 * PARTS)]
            error = [e if e < 1 << 63 else None for e in map(int, errors.sum(axis=1))]
            columns = [batch.column("vec_id"), batch.column("label"), pa.array(code, pa.string()), pa.array(error, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "label", "code", "error"])

    return coding


def usable(vectors):
    """``(vector, vec_id, label)`` of the rows whose components are all numbers and whose length can be cut."""
    x = vectors["embedding"].cast("array<double>")
    finite = F.forall(x, lambda v: F.coalesce(F.abs(v) < F.lit(float("inf")), F.lit(False)) & ~F.isnan(v))
    whole = (F.size(x) > 0) & (F.size(x) % PARTS == 0)
    return vectors.where(x.isNotNull() & whole & finite).select(
        x.alias("vector"), vectors["vec_id"].cast("long").alias("vec_id"), vectors["label"]
    )


def _first_books(rows):
    """Codebooks of the smallest ids, and the vectors' length; None without a vector."""
    order = [F.col("vec_id").asc_nulls_last(), "vector"]
    least = rows.orderBy(*order).limit(1).collect()
    if not least:
        return None, 0
    dim = len(least[0]["vector"])
    firsts = rows.where(F.size("vector") == dim).orderBy(*order).limit(ENTRIES).collect()
    x = _integers(pa.array([r["vector"] for r in firsts], pa.list_(pa.float64())), dim)
    return [np.ascontiguousarray(p) for p in np.split(x, PARTS, axis=1)], dim


def _moved(books, sums):
    """Codebooks after one round; ``sums`` has a row per used entry, component and digit."""
    out = [b.copy() for b in books]
    totals, counts = {}, {}
    for r in sums:
        at = (r["part"], r["entry"], r["component"])
        totals[at] = totals.get(at, 0) + (int(r["total"]) << (LIMB * r["limb"]))
        if r["limb"] == 0:
            counts[at] = r["n"]
    for (part, entry, component), total in totals.items():
        mean = total // counts[part, entry, component]
        if abs(mean) >= SAFE and out[part].dtype != object:
            out[part] = out[part].astype(object)
        out[part][entry, component] = mean
    return out


def trained(rows, books, dim, rounds=ROUNDS):
    """Codebooks after ``rounds`` rounds over all rows. Only the sums of each entry's components come to the driver."""
    for _ in range(rounds):
        sums = rows.select("vector").mapInArrow(_summing(books, dim), SUMS).groupBy("part", "entry", "component", "limb")
        books = _moved(books, sums.agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect())
    return books


def books_digest(books):
    numbers = ",".join(str(int(v)) for b in books for entry in b for v in entry)
    return hashlib.sha256(numbers.encode()).hexdigest()


def coded(vectors, scratch, rounds=ROUNDS):
    """``(vec_id, code, error, label_error, codebooks_sha256)`` of every usable vector."""
    spark = vectors.sparkSession
    rows = usable(vectors)
    books, dim = _first_books(rows)
    if books is None:
        return spark.createDataFrame(
            [], "vec_id long, code string, error long, label_error long, codebooks_sha256 string"
        )
    rows = rows.where(F.size("vector") == dim)
    books = trained(rows, books, dim, rounds)
    label = next(f for f in rows.schema.fields if f.name == "label")
    numbers = [StructField("vec_id", LongType()), label, StructField("code", StringType()), StructField("error", LongType())]
    codes = scratch.stored(rows.mapInArrow(_coding(books, dim), StructType(numbers)), "codes")
    by_label = codes.groupBy(F.col("label").alias("_label")).agg(F.try_sum("error").alias("label_error"))
    by_label = scratch.stored(by_label, "labels")
    joined = codes.join(small_side(by_label), codes["label"].eqNullSafe(by_label["_label"]))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256"))


def op13_vector_codes(spark, sf_dir):
    with Scratch(spark, "vector-codes") as scratch:
        vectors = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
        return pinned(coded(vectors, scratch))


def oracle():
    """The contract as SQL, by measuring every entry."""
    ctes = [
        """kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"""parts AS MATERIALIZED (
  SELECT r, p, v[p * (len(v) // {PARTS}) + 1:(p + 1) * (len(v) // {PARTS})] AS x FROM kept, range({PARTS}) t(p))""",
        f"""book0 AS MATERIALIZED (
  SELECT p, i AS entry, x AS e FROM (
    SELECT r, row_number() OVER (ORDER BY vec_id) - 1 AS i FROM kept QUALIFY i < {ENTRIES}) JOIN parts USING (r))""",
    ]
    gap = "list_sum(list_transform(list_zip(x, e), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    for i in range(ROUNDS + 1):
        ctes.append(
            f"""near{i} AS MATERIALIZED (
  SELECT r, p, any_value(x) AS x, arg_min(entry, {gap} * {ENTRIES} + entry) AS entry, min({gap}) AS d
  FROM parts JOIN book{i} USING (p) GROUP BY r, p)"""
        )
        if i < ROUNDS:
            ctes.append(
                f"""mean{i} AS (
  SELECT p, entry, list(m ORDER BY j) AS m FROM (
    SELECT p, entry, j, floor(sum(x[j]) / count(*))::BIGINT AS m FROM near{i}, range(1, 1 + len(x)) t(j) GROUP BY p, entry, j)
  GROUP BY p, entry)"""
            )
            ctes.append(
                f"book{i + 1} AS MATERIALIZED (SELECT p, entry, coalesce(m, e) AS e FROM book{i} LEFT JOIN mean{i} USING (p, entry))"
            )
    ctes.append(
        f"coded AS (SELECT r, string_agg(printf('%02x', entry), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM near{ROUNDS} GROUP BY r)"
    )
    ctes.append(
        f"digest AS (SELECT sha256(string_agg(array_to_string(e, ','), ',' ORDER BY p, entry)) AS codebooks_sha256 FROM book{ROUNDS})"
    )
    return (
        "WITH "
        + ",\n".join(ctes)
        + "\nSELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256 FROM kept JOIN coded USING (r), digest"
    )
