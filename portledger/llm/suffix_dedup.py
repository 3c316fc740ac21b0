"""Removal of long repeated byte strings, by distributed prefix doubling over sampled positions.

A byte goes if a string of ``LENGTH`` bytes that covers it starts anywhere else too, in another text or the same.

1. Positions. Every window of ``WINDOW`` places has an anchor: the place whose ``GRAM`` bytes have the least hash. Equal strings
   have equal anchors inside, so anchors stand for all positions. The bytes from an anchor up to the next one's are its first rank.
2. Doubling. An anchor's rank and that of the anchor 1, then 2 further on make its next rank. Spark sorts and counts the
   pairs, and anchors whose rank is unique drop out. A string of ``LENGTH`` bytes holds four whole steps, so what is left
   after two doublings are the anchors of possible repeats.
3. Ends. The strings that start between two anchors are judged together: all repeat if their union does, none does if
   the part common to all is unique. Only where neither holds, at the ends of repeats, are the strings compared one by one.

Equal texts are one text with a number of copies: from ``LENGTH`` bytes on they are removed whole. Ranks are hashes of 64 bits, as are
texts' names. Anchors of one text are sent once per task, so a text with copies is a few rows, and a frequent string is
as many rows as there are different texts with it, counted partially; joins on ranks may be split by Spark.

Null text counts as empty. Texts shorter than ``LENGTH`` bytes lose nothing. Rows with a null or repeated ``doc_id`` are judged each, and rows
of equal text count as copies. Other columns are not read.
"""

import hashlib

import numpy as np
import pyarrow as pa

from pyspark.sql import functions as F

from portledger.llm.common import as_text, small_side, stored

LENGTH = 400
WINDOW = 48
GRAM = 16
# Bytes hashed at a time, which bounds a long text's arrays.
SLICE = 1 << 20

_RANDOM = np.random.default_rng(11)
_BYTES = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def _mixed(h):
    h = (h ^ (h >> np.uint64(31))) * _MIX
    return h ^ (h >> np.uint64(29))


def _powers(base, size):
    out = np.full(size, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class Hasher:
    """Hashes of substrings, from sums of byte values times powers."""

    def __init__(self, longest=2 * LENGTH):
        self.longest = longest
        self.up = _powers(_BASE, SLICE + longest)
        self.down = _powers(_INVERSE, SLICE + 1)

    def __call__(self, raw, starts, ends):
        """Hashes of ``raw[start:end]``; starts are in order, and no substring is longer than ``longest``."""
        out = np.empty(len(starts), np.uint64)
        for at in range(0, len(raw), SLICE):
            a, b = np.searchsorted(starts, [at, at + SLICE])
            if a == b:
                continue
            part = raw[at : at + SLICE + self.longest]
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTES[part] * self.up[: len(part)], dtype=np.uint64)])
            s, e = starts[a:b] - at, ends[a:b] - at
            out[a:b] = _mixed((sums[e] - sums[s]) * self.down[s] + (e - s).astype(np.uint64))
        return out


def anchors(raw):
    """Places whose ``GRAM`` bytes have the least hash of some window of ``WINDOW`` places; each window has one."""
    found, over = [], 2 * WINDOW + GRAM
    for at in range(0, max(1, len(raw)), SLICE):
        begin = max(0, at - over)
        h = _BYTES[raw[begin : at + SLICE + over]]
        step = 1
        while step < GRAM:
            h = _mixed(h[:-step] * np.uint64(_BASE) + h[step:])
            step *= 2
        n = len(h)
        if n < WINDOW:
            continue

        def over_window(x, of):
            width = 1
            while width * 2 <= WINDOW:
                x = of(x[:-width], x[width:])
                width *= 2
            return of(x[: len(x) - (WINDOW - width)], x[WINDOW - width :]) if width < WINDOW else x

        least = over_window(h, np.minimum)
        edge = np.zeros(WINDOW - 1, np.uint64)
        chosen = begin + np.flatnonzero(over_window(np.concatenate([edge, least, edge]), np.maximum) == h)
        found.append(chosen[(chosen >= at) & (chosen < at + SLICE)])
    return np.concatenate(found) if found else np.empty(0, np.int64)


def phrases(raw, places, hasher):
    """Hash of the bytes from each anchor to the end of the next one's."""
    return hasher(raw, places[:-1], places[1:] + GRAM)


def _raw(text):
    return np.frombuffer(text.encode(), np.uint8)


def _first_ranks(batches):
    """``(tie, idx, rank)`` of all anchors; equal texts of a task once."""
    hasher, seen = Hasher(), set()
    for batch in batches:
        ties, idx, ranks, size = [], [], [], 0
        for tie, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if tie in seen:
                continue
            if len(seen) < 1 << 20:
                seen.add(tie)
            raw = _raw(text)
            if len(raw) < LENGTH:
                continue
            places = anchors(raw)
            rank = phrases(raw, places, hasher)
            ties.append(np.full(len(rank), tie))
            idx.append(np.arange(len(rank), dtype=np.int32))
            ranks.append(rank.view(np.int64))
            size += len(rank)
            if size >= 1 << 18:
                yield _batch(["tie", "idx", "rank"], ties, idx, ranks)
                ties, idx, ranks, size = [], [], [], 0
        if size:
            yield _batch(["tie", "idx", "rank"], ties, idx, ranks)


def _batch(names, *columns):
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in columns], names=names)


def _several(batches):
    """Rows of sorted ``(rank, tie, idx)`` whose rank is at several places."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        now = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
        held = now if held is None else [np.concatenate(p) for p in zip(held, now)]
        cut = int(np.searchsorted(held[0], held[0][-1]))
        if cut:
            yield _repeated(*(c[:cut] for c in held))
            held = [c[cut:] for c in held]
    if held is not None:
        yield _repeated(*held)


def _repeated(rank, tie, idx):
    starts = np.flatnonzero(np.concatenate([[True], rank[1:] != rank[:-1]]))
    sizes = np.diff(np.append(starts, len(rank)))
    many = np.minimum.reduceat(tie, starts) != np.maximum.reduceat(tie, starts)
    many |= np.minimum.reduceat(idx, starts) != np.maximum.reduceat(idx, starts)
    take = np.repeat(many, sizes)
    names = ["tie", "idx", "rank"]
    return pa.RecordBatch.from_arrays([pa.array(tie[take]), pa.array(idx[take]), pa.array(rank[take])], names=names)


RANKED = "tie long, idx int, rank long"


def first_ranks(texts):
    """Anchors whose first rank is at several places. Rows are sorted by rank and read as a stream."""
    rows = texts.mapInArrow(_first_ranks, RANKED).select("rank", "tie", "idx")
    rows = rows.repartition("rank").sortWithinPartitions("rank").mapInArrow(_several, RANKED)
    return stored(rows.distinct(), "ranks")


def doubled(ranked, offset):
    """The next ranks, of twice the steps, that are at several places."""
    further = ranked.select("tie", (F.col("idx") - offset).alias("idx"), F.col("rank").alias("next"))
    pairs = ranked.join(further, ["tie", "idx"]).select("tie", "idx", F.xxhash64("rank", "next").alias("rank"))
    pairs = stored(pairs, "pairs")
    several = pairs.groupBy("rank").agg(F.count("*").alias("n")).where("n > 1").select("rank")
    return stored(pairs.join(several, "rank").select("tie", "idx", "rank"), "ranks")


def starts_of(raw, places):
    """First and last start of the strings that each anchor stands for: it is their first one WINDOW - 1 bytes in or later."""
    before = np.concatenate([[-1], places[:-1]])
    low = np.maximum(0, before - (WINDOW - 2))
    low[:1] = 0
    high = np.minimum(places - (WINDOW - 1), len(raw) - LENGTH)
    return low, high


# The bytes common to all strings of an anchor, from its place.
COMMON = (1 - WINDOW, LENGTH - 2 * WINDOW + 1)


def _spans(batches):
    """``(common, whole, tie, idx, low, high)``: hashes of the common part and of the union of an anchor's strings."""
    hasher = Hasher()
    for batch in batches:
        rows = [[], [], [], [], [], []]
        for tie, text, idx in zip(*(batch.column(c).to_pylist() for c in ("tie", "text", "idx"))):
            raw = _raw(text)
            places = anchors(raw)
            low, high = starts_of(raw, places)
            at = np.array(sorted(set(idx)), np.int64)
            at = at[high[at] >= low[at]]
            low, high, place = low[at], high[at], places[at]
            rows[0].append(hasher(raw, place + COMMON[0], place + COMMON[1]).view(np.int64))
            rows[1].append(hasher(raw, low, high + LENGTH).view(np.int64))
            rows[2].append(np.full(len(at), tie))
            rows[3].append(at.astype(np.int32))
            rows[4].append(low)
            rows[5].append(high)
        if rows[0]:
            yield _batch(["common", "whole", "tie", "idx", "low", "high"], *rows)


def _strings(batches):
    """``(string, tie, low)``: every single string of the given ranges of starts."""
    hasher = Hasher()
    for batch in batches:
        rows = [[], [], []]
        for tie, text, ranges in zip(*(batch.column(c).to_pylist() for c in ("tie", "text", "ranges"))):
            raw = _raw(text)
            at = np.unique(np.concatenate([np.arange(r["low"], r["high"] + 1) for r in ranges]))
            rows[0].append(hasher(raw, at, at + LENGTH).view(np.int64))
            rows[1].append(np.full(len(at), tie))
            rows[2].append(at)
        if rows[0]:
            yield _batch(["string", "tie", "low"], *rows)


def merged(ranges):
    """Maximal runs of bytes covered by the strings that start in ``(low, high)`` ranges."""
    out = []
    for low, high in sorted(ranges):
        end = high + LENGTH
        if out and low <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([low, end])
    return out


def _removals(batches):
    for batch in batches:
        rows = []
        for tie, text, ranges in zip(*(batch.column(c).to_pylist() for c in ("tie", "text", "ranges"))):
            raw = text.encode()
            runs = merged((r["low"], r["high"]) for r in ranges)
            kept, at = [], 0
            for a, b in runs:
                kept.append(raw[at:a])
                at = b
            kept.append(raw[at:])
            rows.append((tie, runs, sum(b - a for a, b in runs), len(runs), b"".join(kept)))
        columns = list(zip(*rows)) or [()] * 5
        types = (pa.int64(), pa.list_(pa.list_(pa.int64())), pa.int64(), pa.int64(), pa.binary())
        names = ["tie", "runs", "n_removed", "n_spans", "kept"]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)


REMOVED = "tie long, runs array<array<long>>, n_removed long, n_spans long, kept binary"


def removals(texts):
    """``(tie, runs, n_removed, n_spans, kept)`` of the different texts that lose some bytes to other strings.

    ``texts`` has ``tie``, the text's hash, and ``text``.
    """
    ranked = first_ranks(texts)
    for offset in (1, 2):
        ranked = doubled(ranked, offset)
    # Positions of one text, which is in one piece anyway.
    alive = stored(ranked.groupBy("tie").agg(F.collect_list("idx").alias("idx")), "alive")
    held = texts.join(small_side(alive.select("tie"), 200_000), "tie", "left_semi")
    held = held.groupBy("tie").agg(F.first("text").alias("text"))
    held = stored(held.join(alive, "tie"), "held")
    spans = stored(held.mapInArrow(_spans, "common long, whole long, tie long, idx int, low long, high long"), "spans")
    wholes = spans.groupBy("common", "whole").agg(F.count("*").alias("n"), F.min(F.struct("tie", "low", "high")).alias("one"))
    wholes = stored(wholes, "wholes")
    parts = wholes.groupBy("common").agg(F.sum("n").alias("total"), F.min("n").alias("least"))
    parts = parts.where((F.col("total") > 1) & (F.col("least") == 1)).select("common")
    covered = spans.join(wholes.where("n > 1").select("common", "whole"), ["common", "whole"]).select("tie", "low", "high")
    # One text of each union is enough to compare with.
    open_ends = wholes.join(parts, "common").select("one.*").groupBy("tie").agg(F.collect_list(F.struct("low", "high")).alias("ranges"))
    strings = held.select("tie", "text").join(open_ends, "tie").mapInArrow(_strings, "string long, tie long, low long")
    strings = stored(strings, "strings")
    several = strings.groupBy("string").agg(F.count("*").alias("n")).where("n > 1").select("string")
    single = strings.join(several, "string").select("tie", "low", F.col("low").alias("high"))
    found = covered.unionByName(single).groupBy("tie").agg(F.collect_list(F.struct("low", "high")).alias("ranges"))
    return held.select("tie", "text").join(found, "tie").mapInArrow(_removals, REMOVED)


def _measured(batches):
    for batch in batches:
        raw = [t.encode() for t in batch.column(2).to_pylist()]
        digests = pa.array([hashlib.sha256(r).hexdigest() for r in raw], pa.string())
        arrays = [batch.column(0), batch.column(1), pa.array([len(r) for r in raw], pa.int64()), digests]
        yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "tie", "n_bytes", "whole_sha256"])


def document_removals(docs):
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256)`` of every document."""
    texts = docs.select(docs["doc_id"].cast("long").alias("doc_id"), as_text(docs).alias("text"))
    texts = texts.select("doc_id", F.xxhash64("text").alias("tie"), "text")
    all_docs = texts.mapInArrow(_measured, "doc_id long, tie long, n_bytes long, whole_sha256 string")
    all_docs = stored(all_docs, "documents")
    found = removals(texts.select("tie", "text"))
    found = found.select("tie", "n_removed", "n_spans", F.sha2("kept", 256).alias("sha"))
    copies = all_docs.where(F.col("n_bytes") >= LENGTH).groupBy("tie").agg(F.count("*").alias("copies")).where("copies > 1")
    # One row per text that loses anything, copies or not.
    lost = stored(found.join(copies, "tie", "full"), "lost")
    joined = all_docs.join(lost, "tie", "left")
    whole = F.col("copies").isNotNull()
    empty = hashlib.sha256(b"").hexdigest()
    none = F.lit(0).cast("long")
    return joined.select(
        "doc_id",
        "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", none)).alias("n_removed"),
        F.when(whole, F.lit(1).cast("long")).otherwise(F.coalesce("n_spans", none)).alias("n_spans"),
        F.when(whole, F.lit(empty)).otherwise(F.coalesce("sha", "whole_sha256")).alias("kept_sha256"),
    )


def op3_suffix_dedup(spark, sf_dir):
    return document_removals(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
