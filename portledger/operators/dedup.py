"""First-wins dedup, the test against stored records, and ingest counters.

Only keys and lineage take part in deciding which rows are kept; the rows themselves are picked afterwards, where they are
read, by marks of one bit per lineage position.
"""

from functools import reduce
from operator import and_

from pyspark.sql import Window
from pyspark.sql import functions as F

from portledger.functions.text import safe_str
from portledger.operators.joins import fits_broadcast, is_small, size_columns
from portledger.schema import DEDUP_KEY, LINEAGE
from portledger.session import pinned

# A filter's block is four words of 64 bits; a key sets two bits of each. At twelve bits a key about one stored key in
# 150 passes by chance.
WORDS = 4
BITS_PER_KEY = 12
# A filter has at most so many blocks, about 64 MB as a broadcast: room for 20 million keys at the full width.
# More keys share them, and more stored keys pass.
MAX_BLOCKS = 1 << 20


def dedup_keys(df, key=DEDUP_KEY):
    """The key columns alone, stripped, under their own names."""
    return df.select(*[safe_str(c).alias(c) for c in key])


def key_lineage(df, key=DEDUP_KEY, order=LINEAGE):
    """The stripped key under working names, and the lineage columns: all that dedup moves."""
    names = [f"_k{i}" for i in range(len(key))]
    return df.select(*[safe_str(c).alias(n) for c, n in zip(key, names)], *order), names


def first_lineage(df, key=DEDUP_KEY, order=LINEAGE):
    """Key and lineage of the first row of every key in ``order``.

    The rank filter also runs before the shuffle, so a key that fills a third of the rows sends one
    narrow row per input task.
    """
    narrow, names = key_lineage(df, key, order)
    by_key = Window.partitionBy(*names).orderBy(*order)
    return narrow.withColumn("_rn", F.row_number().over(by_key)).where("_rn = 1").drop("_rn"), names


def lineage_marks(kept, order=LINEAGE):
    """The lineage positions in ``kept`` as bits: one row for 64 positions of a file."""
    *file, row = order
    at = F.col(row)
    return kept.groupBy(*file, F.shiftright(at, 6).alias("_word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), at.bitwiseAND(F.lit(63)).cast("int"))).alias("_bits")
    )


def rows_at(df, kept, order=LINEAGE):
    """Rows of ``df`` whose lineage, unique in ``df``, is in the stored narrow table ``kept``.

    While the marks fit a broadcast (measured) no row of ``df`` moves; beyond that both sides meet on the lineage.
    """
    marks = lineage_marks(kept, order)
    if not fits_broadcast(marks):
        return df.join(kept.select(*order), order, "left_semi").select(*df.columns)
    *file, row = order
    marks = marks.select(*[F.col(c).alias(f"_m{i}") for i, c in enumerate(file)], "_word", "_bits")
    at = F.col(row)
    marked = F.call_function("shiftright", F.col("_bits"), at.bitwiseAND(F.lit(63)).cast("int")).bitwiseAND(F.lit(1)) == 1
    same = [F.col(c) == F.col(f"_m{i}") for i, c in enumerate(file)]
    condition = reduce(and_, same, (F.shiftright(at, 6) == F.col("_word")) & marked)
    return df.join(F.broadcast(marks), condition, "left_semi")


def dedup_first_wins(df, key=DEDUP_KEY, order=LINEAGE):
    """The first row of every key in ``order``; ``order`` must be unique per row."""
    firsts, _ = first_lineage(df, key, order)
    return rows_at(df, pinned(firsts.select(*order)), order)


def _filter_place(names, blocks):
    """A key's block and its two bits in each word, from two hashes."""
    mixed = F.xxhash64(F.lit(1), *names)
    one = F.lit(1).cast("bigint")
    bit = lambda i: F.call_function("shiftleft", one, F.shiftright(mixed, 6 * i).bitwiseAND(F.lit(63)).cast("int"))
    words = {f"_w{w}": bit(2 * w).bitwiseOR(bit(2 * w + 1)) for w in range(WORDS)}
    return {"_block": F.pmod(F.xxhash64(*names), F.lit(blocks)), **words}


def filter_blocks(n_keys):
    return max(1, min(MAX_BLOCKS, -(-n_keys * BITS_PER_KEY // (64 * WORDS))))


def key_filter(keys, names, blocks):
    """A Bloom filter of the columns ``names`` as rows ``(_block, _w0.._w3)``.

    Filters with the same number of blocks merge by the same aggregate, so tasks build theirs before the shuffle.
    """
    placed = keys.select(*[c.alias(n) for n, c in _filter_place(names, blocks).items()])
    return merged_filters(placed)


def merged_filters(*filters):
    rows = reduce(lambda a, b: a.unionByName(b), filters)
    return rows.groupBy("_block").agg(*[F.bit_or(f"_w{w}").alias(f"_w{w}") for w in range(WORDS)])


def probable(df, names, blocks, filter_rows):
    """Rows of ``df`` whose key the filter may hold: all that it holds, and a few by chance. No row moves."""
    held, meets = _meets(names, blocks, filter_rows)
    return df.join(F.broadcast(held), meets, "left_semi")


def _meets(names, blocks, filter_rows):
    held = filter_rows.select(F.col("_block").alias("_b"), *[F.col(f"_w{w}").alias(f"_f{w}") for w in range(WORDS)])
    place = _filter_place(names, blocks)
    hit = [place[f"_w{w}"].bitwiseAND(F.col(f"_f{w}")) == place[f"_w{w}"] for w in range(WORDS)]
    return held, reduce(and_, hit, place["_block"] == F.col("_b"))


def split_by_filter(df, names, keys, n_keys):
    """``(maybe, rest)``: rows of ``df`` whose columns ``names`` may equal a row of ``keys``, and rows that surely do not.

    ``df`` is read twice and none of its rows moves.
    """
    blocks = filter_blocks(n_keys)
    held, meets = _meets(names, blocks, key_filter(keys, names, blocks))
    return df.join(F.broadcast(held), meets, "left_semi"), df.join(F.broadcast(held), meets, "left_anti")


def fresh_lineage(batch, stored, key=DEDUP_KEY, order=LINEAGE, keys_fit=None):
    """Key and lineage, checkpointed, of the rows of ``batch`` to append: first of their key, key not in ``stored``."""
    firsts, names = first_lineage(batch, key, order)
    firsts = pinned(firsts)
    measured = firsts.select(*names).agg(*size_columns(firsts.select(*names))).first()
    stored_keys = stored.select(*[safe_str(c).alias(n) for c, n in zip(key, names)])
    return unseen(firsts, names, stored_keys, measured, keys_fit)


def unseen(firsts, names, stored_keys, measured, keys_fit=None):
    """Rows of ``firsts``, one per key and narrow, whose key is not in ``stored_keys``; a checkpoint.

    When the keys fit in a broadcast (``measured``), the stored side is only scanned and reduced to the hits.
    Otherwise the stored scan is reduced by a Bloom filter of the keys, and only what passes meets them; the
    exact join drops what passed by chance. Stored columns keep the layout they have: a table bucketed by key is not shuffled.
    """
    keys = firsts.select(*names)
    if is_small(measured) if keys_fit is None else keys_fit:
        hits = F.broadcast(stored_keys.join(F.broadcast(keys), names, "left_semi").distinct())
    else:
        blocks = filter_blocks(measured["rows"])
        hits = probable(stored_keys, names, blocks, key_filter(keys, names, blocks))
    return pinned(firsts.join(hits, names, "left_anti"))


def new_records(batch, stored, key=DEDUP_KEY, order=LINEAGE, keys_fit=None):
    """Rows of ``batch`` to append, see ``fresh_lineage``; ``order`` must be unique per row."""
    return rows_at(batch, fresh_lineage(batch, stored, key, order, keys_fit), order)


def counts_by_file(rows, name):
    return rows.groupBy("src_file").agg(F.count("*").alias(name))


def ingest_counters(files, batch, written):
    """Per file: rows parsed, written and skipped; ``files`` has one row per file with its message."""
    joined = (
        files.select("src_file", "message")
        .join(counts_by_file(batch, "parsed"), "src_file", "left")
        .join(counts_by_file(written, "written"), "src_file", "left")
    )
    filled = joined.na.fill(0, ["parsed", "written"])
    return filled.select(
        "src_file",
        "parsed",
        "written",
        (F.col("parsed") - F.col("written")).alias("skipped"),
        F.when(F.col("message").isNull(), 0).otherwise(1).cast("bigint").alias("errors"),
        "message",
    )


def counter_totals(counters):
    """Per-file counters with one more row for all files, whose ``src_file`` is null."""
    sums = [F.sum(c).alias(c) for c in ("written", "skipped", "errors")]
    return counters.rollup("src_file").agg(*sums)
