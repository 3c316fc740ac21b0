"""Line deduplication by a segment-partition edit join.

A line is a repeat if the same line, or one within ``EDITS`` edits (code points inserted, deleted or
replaced), first occurs earlier; lines are ordered by document id and line number. The same line counts at any
length, if it has a letter or digit. Pairs whose shorter line has under ``LEAST`` code points may differ by one edit, and
lines under ``SHORT`` not at all.

Of two lines within ``k`` edits, cut one into ``k + 1`` segments: one segment lies unchanged in the other, near
its old place. So each line indexes its segments under (length, number, hash) and probes with the few
substrings that may match a segment of a line of its own or a smaller length. Postings are sorted by
key; lines that share one become candidates unless their letters or pairs of letters differ too much, and those are verified on their texts with a banded
bit-parallel edit distance.

Copies of a line post once per task. A long list of postings first compares its members with its
earliest line only; what is found to repeat needs no more. The rest meet all other members of the list by
a join that Spark may split, so a hot segment is neither one task's work nor all pairs of its list.

``deduplicated`` removes repeats from a document unless half of its text or more repeats one other document: such a
document is a copy, which document deduplication must see whole. Repeats of several documents, or of the document
itself, do not add up to a copy. A document that loses all its words goes.

Null or empty text has no lines to remove. Rows equal in ``doc_id`` and text count as one document. Null ids
come last. Columns named like a result's are replaced.
"""

import numpy as np
import pyarrow as pa
import xxhash

from pyspark.sql import functions as F

from portledger.llm.common import Scratch, as_text
from portledger.operators.dedup import filter_blocks, key_filter, probable, split_by_filter
from portledger.session import pinned

EDITS = 2
LEAST = 40
SHORT = 20
# Postings lists of more lines go through their earliest line first.
LONG_LIST = 32
# Lines whose postings are one batch.
POSTED = 2_000
NO_ID = (1 << 63) - 1

POSTINGS = "key long, probe boolean, doc long, n int, line long, signs long"
CANDIDATES = "key long, a long, b long, rest boolean, signs long"


def segments(length, k):
    """``(start, width)`` of the ``k + 1`` nearly equal segments of a line."""
    width, longer = divmod(length, k + 1)
    out, at = [], 0
    for i in range(k + 1):
        w = width + (i >= k + 1 - longer)
        out.append((at, w))
        at += w
    return out


def threshold(length, k):
    """Edits allowed in a pair whose shorter line has this length."""
    return k if length >= LEAST else min(k, 1)


def probes(length, k, least=LEAST):
    """``(indexed length, segment, start, width)`` of the substrings of a line that may equal a segment.

    A segment's shift is bounded from either end by the edits that the other segments must hold.
    """
    out = []
    for other in range(max(least, length - k), length + 1):
        gap, most = length - other, threshold(other, k)
        if gap > most:
            continue
        for i, (at, width) in enumerate(segments(other, most)):
            low = max(0, at - i, at + gap - (most - i))
            high = min(length - width, at + i, at + gap + (most - i))
            out += [(other, i, p, width) for p in range(low, high + 1)]
    return out


def within(a, b, k):
    """Whether two texts are within ``k`` edits, by bit vectors of the prefixes reached per edit count.

    Bit ``i`` of vector ``d``: the first ``i`` characters of ``a`` turn into what was read of ``b`` with ``d`` edits. Only
    the band of ``2k + 1`` diagonals can hold bits.
    """
    if abs(len(a) - len(b)) > k:
        return False
    at = 0
    while at < min(len(a), len(b)) and a[at] == b[at]:
        at += 1
    end = 0
    while end < min(len(a), len(b)) - at and a[-1 - end] == b[-1 - end]:
        end += 1
    a, b = a[at : len(a) - end], b[at : len(b) - end]
    where = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    reached = [(2 << d) - 1 for d in range(k + 1)]
    window, full = (1 << (2 * k + 1)) - 1, (2 << len(a)) - 1
    for j, c in enumerate(b, 1):
        band = (window << (j - k) if j > k else window >> (k - j)) & full
        same, before, after = where.get(c, 0), 0, 0
        for d in range(k + 1):
            old = reached[d]
            now = (old & same) << 1
            if d:
                now |= before | before << 1 | after << 1
            before, after = old, now & band
            reached[d] = after
        if not after:
            return False
    return bool(reached[k] >> len(a) & 1)


def line_rows(docs):
    """``(doc, tie, n, line, chars)``: every line as its hash. ``tie`` tells texts of one id apart."""
    text = as_text(docs)
    # Hashed before its lines are apart: once for each text, not for each line.
    texts = docs.select(F.coalesce(docs["doc_id"].cast("long"), F.lit(NO_ID)).alias("doc"), F.xxhash64(text).alias("tie"), text.alias("_t"))
    rows = texts.select("doc", "tie", F.posexplode(F.split("_t", "\n")).alias("n", "body"))
    # Blank lines and rules of signs are layout.
    rows = rows.where(F.col("body").rlike(r"[\p{L}\p{N}]") | (F.length("body") >= LEAST))
    return rows.select("doc", "tie", "n", F.xxhash64("body").alias("line"), F.length("body").alias("chars"))


def letters_of(bodies):
    """Per line, which of 32 classes of code points it holds an odd number of, as bits: an edit changes two at most."""
    codes = np.frombuffer("".join(bodies).encode("utf-32-le"), "<u4") & 31
    starts = np.cumsum([0, *map(len, bodies)])[:-1]
    # Lines that are posted are not empty.
    return np.bitwise_xor.reduceat(np.left_shift(np.uint32(1), codes), starts).astype(np.uint32).view(np.int32)


def signs_of(bodies):
    """Per line, ``letters_of`` in 16 classes as the low bits, and which of 48 classes of neighbouring code points
    it holds an odd number of as the others: an edit changes four of these at most."""
    codes = np.frombuffer("".join(bodies).encode("utf-32-le"), "<u4")
    starts = np.cumsum([0, *map(len, bodies)])[:-1]
    before = np.concatenate([codes[:1], codes[:-1]])
    # The first code point of a line has no neighbour before it.
    before[starts] = 0
    mixed = (before * np.uint32(0x9E3779B1) ^ codes) * np.uint32(0x85EBCA6B)
    classes = (mixed >> np.uint32(16)) % np.uint32(48) + np.uint32(16)
    neighbours = np.bitwise_xor.reduceat(np.left_shift(np.uint64(1), classes.astype(np.uint64)), starts)
    letters = letters_of(bodies).view(np.uint32)
    return (neighbours | ((letters ^ letters >> np.uint32(16)) & np.uint32(0xFFFF)).astype(np.uint64)).view(np.int64)


def may_be_near(differ, k):
    """Whether lines whose ``signs_of`` differ in these bits (unsigned) may be within ``k`` edits."""
    return (differ & 0xFFFF).bit_count() <= 2 * k and (differ >> 16).bit_count() <= 4 * k


def _poster(k, least):
    plans = {}

    def plan(length):
        if length not in plans:
            own = [(length << 8 | i, at, at + w) for i, (at, w) in enumerate(segments(length, threshold(length, k)))]
            plans[length] = own, [(o << 8 | i, p, p + w) for o, i, p, w in probes(length, k, least)]
        return plans[length]

    def post(batches):
        for batch in batches:
            docs, numbers, lines, bodies = batch.columns
            # Copies of a line post once.
            _, firsts = np.unique(lines.to_numpy(), return_index=True)
            taken = np.sort(firsts)
            kept = bodies.take(pa.array(taken)).to_pylist()
            if not kept:
                continue
            per_line = [c.to_numpy()[taken] for c in (docs, numbers, lines)] + [signs_of(kept)]
            for at in range(0, len(kept), POSTED):
                yield posted(kept[at : at + POSTED], [c[at : at + POSTED] for c in per_line])

    def posted(kept, per_line):
        digest = xxhash.xxh3_64_intdigest
        keys, own_sizes, other_sizes = [], [], []
        for body in kept:
            own, other = plan(len(body))
            raw = body.encode()
            if len(raw) == len(body):
                keys += [digest(raw[a:b], seed) for seed, a, b in own]
                keys += [digest(raw[a:b], seed) for seed, a, b in other]
            else:
                keys += [digest(body[a:b].encode(), seed) for seed, a, b in own]
                keys += [digest(body[a:b].encode(), seed) for seed, a, b in other]
            own_sizes.append(len(own))
            other_sizes.append(len(other))
        pairs = np.column_stack([own_sizes, other_sizes])
        sizes = pairs.sum(axis=1)
        kinds = np.repeat(np.tile([False, True], len(kept)), pairs.ravel())
        columns = [np.array(keys, np.uint64).view(np.int64), kinds, *(np.repeat(c, sizes) for c in per_line)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["key", "probe", "doc", "n", "line", "signs"])

    return post


def _lister(limit, k):
    """Sorted postings to candidates: all of a short list, those with the earliest line of a long one.

    Lines whose letters, or neighbouring letters, differ in more classes than ``k`` edits can change are no candidates.
    """

    def pairs_of(key, probe, line, signs):
        # Rows are in order of (key, doc, n): the first row of a line is its earliest.
        of = dict(zip(line.tolist(), signs.tolist()))
        indexed = list(dict.fromkeys(line[~probe].tolist()))
        probing = list(dict.fromkeys(line[probe].tolist()))
        near = lambda a, b: a != b and may_be_near((of[a] ^ of[b]) & 0xFFFFFFFFFFFFFFFF, k)
        if len(indexed) * len(probing) <= limit * limit:
            return [(key, a, b, False, 0) for a in indexed for b in probing if near(a, b)]
        # The earliest line serves as partner; members of both kinds are kept for the second turn.
        first = indexed[0]
        out = [(key, first, b, False, 0) for b in probing if near(first, b)]
        out += [(key, a, None, True, of[a]) for a in indexed] + [(key, None, b, True, of[b]) for b in probing]
        return out

    def flush(key, probe, line, signs):
        """Candidates of whole lists."""
        starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        ends = np.append(starts[1:], len(key))
        any_probe = np.logical_or.reduceat(probe, starts)
        any_index = np.logical_or.reduceat(~probe, starts)
        low, high = np.minimum.reduceat(line, starts), np.maximum.reduceat(line, starts)
        out = []
        for i in np.flatnonzero(any_probe & any_index & (low != high)).tolist():
            part = slice(starts[i], ends[i])
            out += pairs_of(int(key[starts[i]]), probe[part], line[part], signs[part])
        columns = list(zip(*out)) or [(), (), (), (), ()]
        types = (pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64())
        names = ["key", "a", "b", "rest", "signs"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    def lists(batches):
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            now = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
            held = now if held is None else [np.concatenate(p) for p in zip(held, now)]
            # The last list may go on in the next batch.
            cut = int(np.searchsorted(held[0], held[0][-1]))
            if cut:
                yield flush(*(c[:cut] for c in held))
                held = [c[cut:] for c in held]
        if held is not None:
            yield flush(*held)

    return lists


def _verifier(k):
    def verify(batches):
        for batch in batches:
            a, b = batch.column("a_body").to_pylist(), batch.column("b_body").to_pylist()
            near = pa.array([within(x, y, threshold(min(len(x), len(y)), k)) for x, y in zip(a, b)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(near)

    return verify


def _long_lines(docs, least):
    text = as_text(docs)
    rows = docs.select(
        F.coalesce(docs["doc_id"].cast("long"), F.lit(NO_ID)).alias("doc"), F.posexplode(F.split(text, "\n")).alias("n", "body")
    ).where((F.length("body") >= least) & (F.col("body").rlike(r"[\p{L}\p{N}]") | (F.length("body") >= LEAST)))
    return rows.select("doc", "n", F.xxhash64("body").alias("line"), "body")


def _verified(docs, pairs, k, least, scratch):
    """The ``(a, b)`` of ``pairs`` whose texts are within ``k`` edits. Only lines that may be in a pair are shuffled."""
    wanted = scratch.stored(pairs.select(F.explode(F.array("a", "b")).alias("line")).distinct(), "wanted")
    blocks = filter_blocks(wanted.count())
    found = probable(_long_lines(docs, least).select("line", "body"), ["line"], blocks, key_filter(wanted, ["line"], blocks))
    # One text per line: equal hashes stand for equal texts.
    bodies = scratch.stored(found.groupBy("line").agg(F.min("body").alias("body")), "bodies")
    side = lambda name: bodies.select(F.col("line").alias(name), F.col("body").alias(f"{name}_body"))
    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(_verifier(k), "a long, b long")


def _later(near, firsts):
    """``(line, earlier)``: the line of each near pair that first occurs later, and its earliest partner's first place."""
    place = lambda name: firsts.select(F.col("line").alias(name), F.col("first").alias(f"{name}_first"))
    joined = near.join(place("a"), "a").join(place("b"), "b")
    later = F.when(F.col("a_first") < F.col("b_first"), F.col("b")).otherwise(F.col("a"))
    return joined.groupBy(later.alias("line")).agg(F.min(F.least("a_first", "b_first")).alias("earlier"))


def near_repeats(docs, firsts, scratch, k=EDITS, least=LEAST):
    """``(line, earlier)``: hashes of the lines that have an earlier near line, and the first place of one."""
    postings = _long_lines(docs, least).mapInArrow(_poster(k, least), POSTINGS)
    listed = postings.repartition("key").sortWithinPartitions("key", "doc", "n").select("key", "probe", "line", "signs")
    stored = scratch.stored
    candidates = stored(listed.mapInArrow(_lister(LONG_LIST, k), CANDIDATES), "candidates")
    ordered = lambda df: df.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    first_turn = stored(ordered(candidates.where("not rest")), "pairs")
    later = stored(_later(_verified(docs, first_turn, k, least, scratch), firsts), "repeats")
    # Second turn: members of long lists that are not known to repeat yet meet all the list's other lines.
    rest = candidates.where("rest")
    if rest.limit(1).count():
        indexed = rest.where("a is not null").select("key", "a", F.col("signs").alias("a_signs"))
        probing = rest.where("b is not null").select("key", "b", F.col("signs").alias("b_signs"))
        differ = lambda x, y: x["a_signs"].bitwiseXOR(y["b_signs"])
        few = lambda bits: (F.bit_count(bits.bitwiseAND(0xFFFF)) <= 2 * k) & (F.bit_count(F.shiftrightunsigned(bits, 16)) <= 4 * k)
        close = lambda x, y: (x["key"] == y["key"]) & (x["a"] != y["b"]) & few(differ(x, y))
        meet = lambda x, y: x.join(y, close(x, y)).select("a", "b")
        # Either line of a pair may be the open one.
        open_a = indexed.join(later, indexed["a"] == later["line"], "left_anti")
        open_b = probing.join(later, probing["b"] == later["line"], "left_anti")
        open_a, open_b = open_a.select(*indexed.columns), open_b.select(*probing.columns)
        more = ordered(meet(open_a, probing).unionByName(meet(indexed, open_b)))
        more = more.join(first_turn, ["a", "b"], "left_anti")
        more = stored(more, "pairs")
        if more.limit(1).count():
            both = later.unionByName(_later(_verified(docs, more, k, least, scratch), firsts))
            later = stored(both.groupBy("line").agg(F.min("earlier").alias("earlier")), "repeats")
    return later


def repeated_lines(docs, k=EDITS, least=LEAST):
    """``(doc, tie, n, chars, of)`` of every line that repeats an earlier one; ``of`` is the earlier one's place.

    Lines under ``least`` code points are left alone.
    """
    with Scratch(docs.sparkSession, "line-dedup") as scratch:
        return pinned(_repeated_lines(docs, scratch, k, least))


def _repeated_lines(docs, scratch, k, least):
    rows = line_rows(docs).where(F.col("chars") >= least)
    place = F.struct("doc", "tie", "n")
    firsts = rows.groupBy("line").agg(F.min(place).alias("first"), F.count("*").alias("copies"))
    firsts = scratch.stored(firsts, "lines")
    near = near_repeats(docs, firsts, scratch, k, max(least, SHORT))
    several = firsts.where("copies > 1").select("line", "first")
    marks = several.join(near, "line", "full")
    joined = rows.join(marks, "line").where(F.col("earlier").isNotNull() | (place > F.col("first")))
    return joined.select("doc", "tie", "n", "chars", F.coalesce("earlier", "first").alias("of")).distinct()


def marked(docs, k=EDITS):
    """Per document that has repeats: ``(doc, tie, repeats, repeated_chars, copied_chars)``.

    ``repeats`` are line numbers from 0; ``copied_chars`` is the most that repeats one other document.
    """
    with Scratch(docs.sparkSession, "line-dedup") as scratch:
        return pinned(_marked(docs, scratch, k))


def _marked(docs, scratch, k):
    repeats = _repeated_lines(docs, scratch, k, 1)
    other = (F.col("of.doc") != F.col("doc")) | (F.col("of.tie") != F.col("tie"))
    each = repeats.groupBy("doc", "tie", F.col("of.doc").alias("of_doc"), F.col("of.tie").alias("of_tie")).agg(
        F.collect_list("n").alias("lines"), F.sum("chars").alias("all"), F.sum(F.when(other, F.col("chars"))).alias("copied")
    )
    return each.groupBy("doc", "tie").agg(
        F.sort_array(F.flatten(F.collect_list("lines"))).alias("repeats"),
        F.sum("all").alias("repeated_chars"),
        F.coalesce(F.max("copied"), F.lit(0)).alias("copied_chars"),
    )


def deduplicated(docs, k=EDITS, whole_copies=True):
    """``docs`` without repeated lines, except in documents that repeat half of their text or more from one other.

    ``whole_copies=False`` strips these too, for documents whose near copies are gone.
    """
    marks = marked(docs, k)
    text = as_text(docs)
    rows = docs.select(
        F.struct(*docs.columns).alias("_row"),
        text.alias("_text"),
        F.coalesce(docs["doc_id"].cast("long"), F.lit(NO_ID)).alias("doc"),
        F.xxhash64(text).alias("tie"),
    )
    # Only documents that may have marks meet them; the others stay where they are read.
    maybe, rest = split_by_filter(rows, ["doc", "tie"], marks, marks.count())
    joined = maybe.join(marks, ["doc", "tie"], "left")
    strip = F.col("repeats").isNotNull()
    if whole_copies:
        strip = strip & (2 * F.col("copied_chars") < F.length("_text"))
    kept = F.array_join(F.filter(F.split("_text", "\n"), lambda line, i: ~F.array_contains("repeats", i)), "\n")
    joined = joined.withColumn("_strip", strip).withColumn("_kept", F.when(strip, kept).otherwise(F.col("_row.text")))
    joined = joined.where(~F.col("_strip") | F.col("_kept").rlike(r"[^\x20\x09-\x0D]"))
    changed = {"text": F.col("_kept")}
    if "n_chars" in docs.columns:
        size = F.length("_kept").cast(docs.schema["n_chars"].dataType)
        changed["n_chars"] = F.when(F.col("_strip"), size).otherwise(F.col("_row.n_chars"))
    joined = joined.select(*[changed.get(c, F.col("_row")[c]).alias(c) for c in docs.columns])
    return joined.unionByName(rest.select("_row.*"))


def op9_line_dedup(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    text = as_text(docs)
    whole = docs.select(
        "doc_id",
        F.coalesce(docs["doc_id"].cast("long"), F.lit(NO_ID)).alias("doc"),
        F.xxhash64(text).alias("tie"),
        F.size(F.split(text, "\n")).cast("long").alias("n_lines"),
        F.length(text).cast("long").alias("n_chars"),
    )
    found = whole.join(marked(docs), ["doc", "tie"], "left")
    chars = F.coalesce("repeated_chars", F.lit(0)).cast("long")
    return found.select(
        "doc_id",
        "n_lines",
        F.coalesce(F.size("repeats"), F.lit(0)).cast("long").alias("n_repeats"),
        chars.alias("repeated_chars"),
        (F.col("repeats").isNotNull() & (2 * F.col("copied_chars") >= F.col("n_chars"))).alias("is_copy"),
        F.coalesce("repeats", F.array().cast("array<int>")).alias("repeats"),
    )
