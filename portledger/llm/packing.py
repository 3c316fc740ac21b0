"""Best-fit packing into sequences of several permitted lengths.

A document is as long as its words and one end mark. Beyond the largest capacity it is cut; its full
pieces are bins of their own and need no packing, so every document has one piece to pack at most.
These are dealt into groups of about ``GROUP`` by a hash, and each group is packed on its own: longest
first, into the open bin that it leaves the least room in. If none has room, a bin is opened. Its size is chosen
together with what is to go into it: for every permitted size the bin is filled, as a trial, with the longest lengths still to come
that fit, shrunk to its contents, and the size that costs least for each token held is opened.
In the end every bin shrinks to the smallest permitted size that holds its contents.

The number of groups grows with the documents, so a task's memory does not, and a group wastes one
partly filled bin or so. Only lengths are shuffled, no texts.

Null or empty text is its end mark alone. Rows with a null or repeated ``doc_id`` are packed each.
Other columns are not read. ``bin_id`` is text: group and number, or document and piece for full pieces.
"""

import bisect

import numpy as np
import pyarrow as pa

from pyspark.sql import functions as F

CAPACITIES = (512, 1024, 2048, 4096, 8192)
# Cost of a sequence: its length, a fixed part, and attention that grows with the square of the length.
OVERHEAD = 32
ATTENTION = 131_072
GROUP = 8_192

PACKED = "doc_id long, piece long, start long, n_tokens long, bin_id string, capacity int, bin_offset long"


def cost(capacity):
    return capacity + OVERHEAD + capacity * capacity / ATTENTION


def filled(length, capacity, sizes, counts):
    """Tokens in a bin of ``capacity`` that starts with ``length`` and goes on with the longest pieces that fit.

    ``sizes`` are the lengths still to come, ascending, ``counts`` how often each does.
    """
    used = length
    at = bisect.bisect_right(sizes, capacity - used) - 1
    while at >= 0:
        used += min(counts[at], (capacity - used) // sizes[at]) * sizes[at]
        at = min(at - 1, bisect.bisect_right(sizes, capacity - used) - 1)
    return used


def open_size(length, sizes, counts, capacities=CAPACITIES):
    """The size to open for ``length``: the one whose trial filling costs least per token."""

    def price(capacity):
        used = filled(length, capacity, sizes, counts)
        return cost(next(c for c in capacities if c >= used)) / used, capacity

    return min((c for c in capacities if c >= length), key=price)


def pack(lengths, capacities=CAPACITIES):
    """Bin number, offset in the bin and final capacity of every length, in the order given.

    Lengths are between 1 and the largest capacity.
    """
    lengths = np.asarray(lengths, np.int64)
    order = np.argsort(-lengths, kind="stable")
    sizes, counts = (x.tolist() for x in np.unique(lengths, return_counts=True))
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    used, rooms = [], []  # rooms: (room, bin) in order, of bins that have room
    for i in order.tolist():
        n = int(lengths[i])
        # Longest first: what is still to come is all below, and the rest of this length.
        counts[-1] -= 1
        if not counts[-1]:
            sizes.pop()
            counts.pop()
        at = bisect.bisect_left(rooms, (n, -1))
        if at < len(rooms):
            room, b = rooms.pop(at)
        else:
            b, room = len(used), open_size(n, sizes, counts, capacities)
            used.append(0)
        bins[i], offsets[i] = b, used[b]
        used[b] += n
        if room > n:
            bisect.insort(rooms, (room - n, b))
    permitted = np.asarray(capacities)
    final = permitted[np.searchsorted(permitted, np.asarray(used, np.int64))]
    return bins, offsets, final[bins] if len(bins) else bins


def _packer(capacities):
    def pack_group(table):
        # The order of rows that arrive is not fixed; the packing is.
        table = table.sort_by([(c, "ascending") for c in ("n_tokens", "doc_id", "tie", "piece")])
        bins, offsets, final = pack(table.column("n_tokens").to_numpy(), capacities)
        group = table.column("grp")[0].as_py()
        return pa.Table.from_arrays(
            [
                table.column("doc_id"),
                table.column("piece"),
                table.column("start"),
                table.column("n_tokens"),
                pa.array([f"g{group}-{b}" for b in bins.tolist()]),
                pa.array(final, pa.int32()),
                pa.array(offsets),
            ],
            names=["doc_id", "piece", "start", "n_tokens", "bin_id", "capacity", "bin_offset"],
        )

    return pack_group


def lengths(docs):
    """``(doc_id, tie, n_tokens)``: words and one end mark; ``tie`` tells rows of one id apart."""
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    words = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+"))
    return docs.select(
        docs["doc_id"].cast("long").alias("doc_id"), F.xxhash64(text).alias("tie"), (words + 1).cast("long").alias("n_tokens")
    )


def packed(sized, capacities=CAPACITIES, group=GROUP):
    """Packs ``sized(doc_id, tie, n_tokens)``: one row per piece of a document."""
    capacities = tuple(sorted(capacities))
    most = capacities[-1]
    groups = max(1, -(-sized.count() // group))
    full = (
        sized.where(F.col("n_tokens") >= most)
        .select("doc_id", "tie", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"n_tokens div {most}") - 1)).alias("piece"))
        .select(
            "doc_id",
            "piece",
            (F.col("piece") * most).alias("start"),
            F.lit(most).cast("long").alias("n_tokens"),
            F.concat_ws("-", F.lit("d"), F.col("doc_id"), F.hex("tie"), F.col("piece")).alias("bin_id"),
            F.lit(most).cast("int").alias("capacity"),
            F.lit(0).cast("long").alias("bin_offset"),
        )
    )
    rest = sized.where(F.col("n_tokens") % most > 0).select(
        "doc_id",
        "tie",
        F.expr(f"n_tokens div {most}").alias("piece"),
        F.expr(f"n_tokens div {most} * {most}").alias("start"),
        (F.col("n_tokens") % most).alias("n_tokens"),
        F.pmod(F.xxhash64("doc_id", "tie"), F.lit(groups)).alias("grp"),
    )
    return rest.groupBy("grp").applyInArrow(_packer(capacities), PACKED).unionByName(full)


def packed_documents(docs, **options):
    return packed(lengths(docs), **options)


def op8_best_fit_packing(spark, sf_dir):
    return packed_documents(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
