"""Exact Jaccard join on word n-grams, by vertical partitioning of the global n-gram order.

1. Sets. A text's n-grams become 64-bit hashes; equal sets are one node, so copies cost one row each and no pair.
2. First cut. A set with a partner at the threshold ``t`` shares all but a quarter of its n-grams. Among its least
   hashes, taken as many as may be lone plus an eighth of the set, enough must occur in another set. Tasks
   settle what they can among their own sets and send one row per n-gram and block, so a frequent n-gram
   is as many rows as there are blocks.
3. Global order. The n-grams that are left are counted and ordered by frequency class, rare first, then by
   hash. The order is cut into fragments; a set becomes one segment per fragment. Sets with too few
   shared n-grams go.
4. Candidates. Sets that share an n-gram of their prefixes meet in lists. Neighbours in a list, its first
   member and its member with the fewest lone n-grams are compared first; what these links connect needs no more. Then all pairs of a list
   whose sets are not connected yet are compared, whatever their number.
5. Overlaps. Two sets' segments of one fragment are intersected separately, and the counts are summed per pair.

Components are found on set nodes by alternating star steps, without collecting anything.

Text without words (null, empty, blanks) has an empty set, linked with nothing; its component is its own id. Fewer words
than the n-gram's length are one n-gram. Rows with a repeated ``doc_id`` are judged each; a null id is a member but never names
a component, unless there is no other. Other columns are not read.
"""

import numpy as np
import pyarrow as pa
import xxhash

from pyspark.sql import Window
from pyspark.sql import functions as F

from portledger.llm.common import Scratch, connected_components, partitions, small_side
from portledger.operators.dedup import filter_blocks, key_filter, probable, split_by_filter
from portledger.session import pinned

WORDS = 5
PERCENT = 75
# Text bytes of a task's block in the first cut.
BLOCK_BYTES = 8 << 20
# Words known to a task at once.
KNOWN_WORDS = 1 << 17
# Texts that a task takes out of a batch at once.
TAKEN = 1_000
# Each frequency class of the order is cut into so many fragments; classes beyond the last are one.
CUTS, CLASSES = 4, 4

MEMBERS = "node long, n long, grams array<long>"
ROWS = "gram long, node long, hits int"

_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def _taken(batches):
    """Slices of few texts: Python holds these, not those of a whole batch."""
    for batch in batches:
        for at in range(0, batch.num_rows, TAKEN):
            yield batch.slice(at, TAKEN)


class _Words(dict):
    def __missing__(self, word):
        if len(self) >= KNOWN_WORDS:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def _mixed(h):
    h = (h ^ (h >> np.uint64(31))) * _MIX
    return h ^ (h >> np.uint64(29))


def gram_set(text, known, words=WORDS):
    """Sorted distinct hashes of a text's word n-grams."""
    found = (text or "").encode().lower().split()
    if not found:
        return np.empty(0, np.uint64)
    place = known.__getitem__
    w = np.fromiter(map(place, found), np.uint64, len(found))
    width = min(words, len(w))
    h = np.full(len(w) - width + 1, width, np.uint64)
    for k in range(width):
        h = _mixed(h * _MULTIPLY + w[k : len(w) - width + 1 + k])
    return np.unique(h)


def node_of(grams):
    """One hash for a whole set."""
    m = _mixed(grams + np.uint64(1))
    both = np.array([m.sum(dtype=np.uint64), np.bitwise_xor.reduce(m) + np.uint64(len(grams))], np.uint64)
    return int(_mixed(_mixed(both[:1]) * _MULTIPLY + both[1:]).view(np.int64)[0])


def lone(n, percent=PERCENT):
    """How many n-grams a set of ``n`` may have that a partner lacks."""
    return n - -(-percent * n // 100)


def _first_cut(words, percent, bits):
    """Rows ``(gram, node, hits)`` of blocks of sets. ``hits`` 0: one n-gram to look for elsewhere, -1: the same, but
    the block has counted it for its own sets; above 0: so many n-grams of the set are shared within the block.

    Below -1 a row is a document, its id in ``gram``, its set's size ``n`` in ``hits`` as -2n - 2, or -2n - 3 for a null id. So texts
    are split and hashed once for the sets and the cut.
    """
    shift = np.uint64(64 - bits)

    def settle(grams, nodes):
        g = np.concatenate(grams)
        sizes = [len(x) for x in grams]
        owner = np.repeat(np.arange(len(nodes)), sizes)
        order = np.argsort(g, kind="stable")
        g, owner = g[order], owner[order]
        starts = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))
        counts = np.diff(np.append(starts, len(g)))
        shared = counts > 1
        hits = np.bincount(owner[np.repeat(shared, counts)], minlength=len(nodes))
        nodes = np.asarray(nodes, np.int64)
        some = np.flatnonzero(hits)
        gram = np.concatenate([g[starts].view(np.int64), nodes[some]])
        node = np.concatenate([nodes[owner[starts]], nodes[some]])
        kind = np.concatenate([np.where(shared, -1, 0), hits[some]])
        arrays = [pa.array(gram), pa.array(node), pa.array(kind, pa.int32())]
        table = pa.Table.from_arrays(arrays, names=["gram", "node", "hits"])
        return table.to_batches(max_chunksize=1 << 16)

    def cut(batches):
        known, grams, nodes, seen, size = _Words(), [], [], set(), 0
        for batch in _taken(batches):
            ids, kinds, owners = [], [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = gram_set(text, known, words)
                node = node_of(found) if len(found) else 0
                ids.append(doc_id or 0)
                kinds.append(-2 * len(found) - 2 - (doc_id is None))
                owners.append(node)
                if not len(found) or node in seen:
                    continue
                seen.add(node)
                first = found[: lone(len(found), percent) + max(1, len(found) // 8)]
                grams.append(first >> shift)
                nodes.append(node)
                size += len(text)
                if size >= BLOCK_BYTES:
                    yield from settle(grams, nodes)
                    grams, nodes, seen, size = [], [], set(), 0
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(owners, pa.int64()), pa.array(kinds, pa.int32())], names=["gram", "node", "hits"]
            )
        if nodes:
            yield from settle(grams, nodes)

    return cut


def _runs(batches, columns):
    """Whole runs of equal first columns from sorted batches, several runs at a time."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        now = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(columns)]
        held = now if held is None else [np.concatenate(p) for p in zip(held, now)]
        cut = int(np.searchsorted(held[0], held[0][-1]))
        if cut:
            yield [c[:cut] for c in held]
            held = [c[cut:] for c in held]
    if held is not None:
        yield held


def _starts(key):
    return np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))


def _credits(batches):
    """Hits of nodes in sorted rows: n-grams that rows of different nodes hold, and what blocks have counted.

    Rows ``(doc_id, node, hits)``; those of documents go through as they are.
    """

    def out(doc_id, node, hits):
        arrays = [pa.array(doc_id, pa.int64()), pa.array(node, pa.int64()), pa.array(hits.astype(np.int64))]
        return pa.RecordBatch.from_arrays(arrays, names=["doc_id", "node", "hits"])

    def of_runs(gram, node, hits):
        counted = hits > 0
        out_node, out_hits = [node[counted]], [hits[counted].astype(np.int64)]
        gram, node, hits = gram[~counted], node[~counted], hits[~counted]
        if len(gram):
            starts = _starts(gram)
            sizes = np.diff(np.append(starts, len(gram)))
            shared = np.minimum.reduceat(node, starts) != np.maximum.reduceat(node, starts)
            take = np.repeat(shared, sizes) & (hits == 0)
            own, times = np.unique(node[take], return_counts=True)
            out_node.append(own)
            out_hits.append(times)
        node, hits = np.concatenate(out_node), np.concatenate(out_hits)
        return out(np.zeros(len(node), np.int64), node, hits)

    held = None
    for batch in batches:
        now = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
        document = now[2] < -1
        if document.any():
            yield out(*(c[document] for c in now))
            now = [c[~document] for c in now]
        if not len(now[0]):
            continue
        held = now if held is None else [np.concatenate(p) for p in zip(held, now)]
        cut = int(np.searchsorted(held[0], held[0][-1]))
        if cut:
            yield of_runs(*(c[:cut] for c in held))
            held = [c[cut:] for c in held]
    if held is not None:
        yield of_runs(*held)


def _members(words):
    def members(batches):
        known = _Words()
        for batch in _taken(batches):
            nodes, sizes, grams = [], [], []
            for text in batch.column(0).to_pylist():
                found = gram_set(text, known, words)
                if len(found):
                    nodes.append(node_of(found))
                    sizes.append(len(found))
                    grams.append(found.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64()), pa.array(grams, pa.list_(pa.int64()))], names=["node", "n", "grams"]
            )

    return members


def _counted(batches):
    """Sorted ``(gram, node)`` rows with the number of sets of each n-gram, where there are several."""
    for gram, node in _runs(batches, 2):
        sizes = np.diff(np.append(_starts(gram), len(gram)))
        df = np.repeat(sizes, sizes)
        several = df > 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(gram[several]), pa.array(node[several]), pa.array(df[several], pa.int64())], names=["gram", "node", "df"]
        )


def segments(members, percent=PERCENT):
    """``(node, n, fragment, grams, before, shared)``: segments in the global order; ``before``: n-grams in earlier ones."""
    rows = members.select(F.explode("grams").alias("gram"), "node")
    rows = rows.repartition("gram").sortWithinPartitions("gram").mapInArrow(_counted, "gram long, node long, df long")
    rank = F.least(F.length(F.bin("df")) - 2, F.lit(CLASSES - 1))
    part = F.pmod(F.shiftright("gram", 62), F.lit(CUTS))
    rows = rows.select("node", "gram", (rank * CUTS + part).cast("int").alias("fragment"))
    parts = rows.repartition("node").groupBy("node", "fragment").agg(F.sort_array(F.collect_list("gram")).alias("grams"))
    of_set = Window.partitionBy("node")
    size = F.size("grams").cast("long")
    parts = parts.withColumns(
        {
            "before": F.sum(size).over(of_set.orderBy("fragment").rowsBetween(Window.unboundedPreceding, 0)) - size,
            "shared": F.sum(size).over(of_set),
        }
    )
    parts = parts.join(members.select("node", "n"), "node")
    return parts.where(100 * F.col("shared") >= percent * F.col("n"))


def prefixes(parts, percent=PERCENT):
    """``(gram, n, node, rest, lone)``: the n-grams of every set's prefix.

    Lone n-grams come first in the order and match nothing. ``rest``: n-grams of the set from this one on.
    """
    lone_grams = F.col("n") - F.col("shared")
    longest = F.col("n") - F.ceil(F.col("n") * percent / 100).cast("long") + 1 - lone_grams
    here = F.greatest(longest - F.col("before"), F.lit(0).cast("long")).cast("int")
    rows = parts.select("n", "node", "before", lone_grams.alias("lone"), F.posexplode(F.slice("grams", 1, here)).alias("at", "gram"))
    return rows.select("gram", "n", "node", (F.col("n") - F.col("lone") - F.col("before") - F.col("at")).alias("rest"), "lone")


def _pairs(percent, label):
    """Pairs of list members that may reach the threshold. Without labels: neighbours, and each with the first that
    fits in size and with the member of the smallest share of lone n-grams; with labels: all whose labels differ.

    At the first n-gram that two sets share, what is left of either must hold the whole overlap; a pair that
    reaches the threshold passes there.
    """

    def emit(found):
        if found:
            both = np.unique(np.concatenate(found), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["a", "b"])

    def pairs(batches):
        for columns in _runs(batches, 6 if label else 5):
            gram, n, node, rest, lone = columns[:5]
            group = columns[5] if label else None
            starts = _starts(gram)
            ends = np.append(starts[1:], len(gram))
            found, held = [], 0
            for s, e in zip(starts.tolist(), ends.tolist()):
                if e - s < 2:
                    continue
                size, who, left = n[s:e], node[s:e], rest[s:e]
                turns = []
                if label:
                    own = group[s:e]
                    if (own == own[0]).all():
                        continue
                    # Sizes are in order: partners of i end where the size is too large.
                    last = np.searchsorted(size, size * 100 // percent, side="right")
                    turns = ((np.array([i]), i + 1 + np.flatnonzero(own[i + 1 : last[i]] != own[i])) for i in range(e - s - 1))
                else:
                    every = np.arange(e - s)
                    first = np.searchsorted(size, -(-size * percent // 100))
                    cleanest = np.array([np.lexsort((who, lone[s:e] / size))[0]])
                    turns = ((every[:-1], every[1:]), (first, every), (cleanest, every))
                for a, b in turns:
                    small, large = np.minimum(size[a], size[b]), np.maximum(size[a], size[b])
                    fit = (a != b) & (small * 100 >= large * percent)
                    fit &= np.minimum(left[a], left[b]) * (100 + percent) >= percent * (small + large)
                    x, y = np.broadcast_to(who[a], fit.shape)[fit], who[b][fit]
                    if len(x):
                        found.append(np.stack([np.minimum(x, y), np.maximum(x, y)], axis=1))
                        held += len(x)
                    if held >= 1 << 18:
                        yield from emit(found)
                        found, held = [], 0
            yield from emit(found)

    return pairs


def linked(pairs, parts, percent=PERCENT):
    """The pairs at the threshold: partial overlaps of each fragment, summed per pair."""
    segment = F.struct("fragment", "grams")
    sets = parts.groupBy("node", "n").agg(F.map_from_entries(F.collect_list(segment)).alias("segments"))
    side = lambda name: sets.select(
        F.col("node").alias(name), F.col("n").alias(f"{name}_n"), F.col("segments").alias(f"{name}_segments")
    )
    met = pairs.join(side("a"), "a").join(side("b"), "b")
    none = F.array().cast("array<long>")
    of = lambda name, f: F.coalesce(F.try_element_at(f"{name}_segments", f), none)
    fragments = F.sequence(F.lit(0), F.lit(CUTS * CLASSES - 1))
    partial = F.transform(fragments, lambda f: F.size(F.array_intersect(of("a", f), of("b", f))))
    overlap = F.aggregate(partial, F.lit(0), lambda total, n: total + n)
    summed = met.select("a", "b", "a_n", "b_n", overlap.cast("long").alias("overlap"))
    union = F.col("a_n") + F.col("b_n") - F.col("overlap")
    return summed.where(100 * F.col("overlap") >= percent * union).select("a", "b", "overlap")


def sets_and_credits(docs, scratch, words=WORDS, percent=PERCENT):
    """``nodes(doc_id, node, n)`` of every document, and the ``hits(node, hits)`` of the first cut, from one pass over the texts."""
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    bits = min(63, max(40, (max(1, rows.count()) * 512).bit_length() + 12))
    first = rows.mapInArrow(_first_cut(words, percent, bits), ROWS)
    first = first.repartition("gram").sortWithinPartitions("gram").mapInArrow(_credits, "doc_id long, node long, hits long")
    first = scratch.stored(first, "credits")
    size = F.expr("(-hits - 2) div 2")
    nodes = first.where("hits < -1").select(
        F.when(F.col("hits") % 2 == 0, F.col("doc_id")).alias("doc_id"),
        F.when(size > 0, F.col("node")).alias("node"),
        size.cast("long").alias("n"),
    )
    return nodes, first.where("hits >= -1").groupBy("node").agg(F.sum("hits").alias("hits"))


def similar_sets(docs, nodes, hits, scratch, words=WORDS, percent=PERCENT):
    """Links ``(a, b)`` between set nodes that connect exactly what the threshold connects."""
    stored = scratch.stored
    sizes = nodes.where("n > 0").select("node", "n").distinct()
    # The smallest partner's share of first n-grams must occur elsewhere.
    needed = F.greatest(F.lit(1), F.floor(F.ceil(F.col("n") * percent / 100) / 8))
    alive = stored(hits.join(sizes, "node").where(F.col("hits") >= needed).select("node"), "alive")
    # Only texts of sets that are still alive are split again. A document is one of them by its id, or by a null id.
    ids = nodes.join(alive, "node", "left_semi").select(F.coalesce("doc_id", F.lit(0)).alias("_id")).distinct()
    ids = stored(ids, "ids")
    n_ids = ids.count()
    texts = docs.select(F.coalesce(docs["doc_id"].cast("long"), F.lit(0)).alias("_id"), docs["text"].cast("string").alias("text"))
    blocks = filter_blocks(n_ids)
    texts = probable(texts.where("text is not null"), ["_id"], blocks, key_filter(ids, ["_id"], blocks)).select("text")
    members = texts.mapInArrow(_members(words), MEMBERS).join(small_side(alive, 200_000), "node", "left_semi")
    members = stored(members.groupBy("node").agg(F.first("n").alias("n"), F.first("grams").alias("grams")), "members")
    parts = stored(segments(members, percent), "segments")
    # A number of its own keeps the lists apart: joined partitions would be few and long tasks.
    number = partitions(docs.sparkSession)
    lists = prefixes(parts, percent).repartition(number, "gram")
    near = lists.sortWithinPartitions("gram", "n", "node").mapInArrow(_pairs(percent, False), "a long, b long").distinct()
    near = stored(near, "pairs")
    links = stored(linked(near, parts, percent), "linked")
    groups = stored(connected_components(links.select("a", "b"), stored=stored), "groups")
    named = prefixes(parts, percent).join(groups.withColumnRenamed("component", "label"), "node", "left")
    named = named.select("gram", "n", "node", "rest", "lone", F.coalesce("label", "node").alias("label")).repartition(number, "gram")
    rest = named.sortWithinPartitions("gram", "n", "node").mapInArrow(_pairs(percent, True), "a long, b long").distinct()
    rest = stored(rest.join(near, ["a", "b"], "left_anti"), "pairs")
    return stored(links.unionByName(linked(rest, parts, percent)), "linked")


def _components(docs, scratch, words=WORDS, percent=PERCENT):
    nodes, hits = sets_and_credits(docs, scratch, words, percent)
    links = similar_sets(docs, nodes, hits, scratch, words, percent)
    groups = connected_components(links.select("a", "b"), stored=scratch.stored)
    # Nodes and links are hashes; a component takes its name from its documents.
    named = nodes.join(groups, "node", "left").withColumn("label", F.coalesce("component", "node")).drop("component")
    least = named.where("label is not null").groupBy("label").agg(F.min("doc_id").alias("component_id"))
    return named.join(least, "label", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("label").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        "node",
    )


def components(docs, words=WORDS, percent=PERCENT):
    """``(doc_id, n_shingles, component_id)`` of every document, and its set ``node``; a checkpoint, working tables are dropped."""
    with Scratch(docs.sparkSession, "ngram-join") as scratch:
        return pinned(_components(docs, scratch, words, percent))


def dropped_ids(docs, words=WORDS, percent=PERCENT):
    """``doc_id`` of the documents that are not the smallest id of their component."""
    found = components(docs, words, percent)
    own = F.col("doc_id").eqNullSafe(F.col("component_id"))
    keep = found.where(own).select("doc_id").distinct()
    drop = found.where(~own & F.col("doc_id").isNotNull()).select("doc_id").distinct()
    return pinned(drop.join(keep, "doc_id", "left_anti"))


def one_of_each(docs, words=WORDS, percent=PERCENT):
    """The document with the smallest id of every component. Rows with a null id stay; rows of one id go or stay together.

    Only documents whose id may be a dropped one meet the dropped ids; the others stay where they are read.
    """
    drop = dropped_ids(docs, words, percent).withColumnRenamed("doc_id", "_id")
    rows = docs.select(F.struct(*docs.columns).alias("_row"), docs["doc_id"].cast("long").alias("_id"))
    n_drop = drop.count()
    if n_drop <= 200_000:
        kept = rows.join(F.broadcast(drop), "_id", "left_anti")
    else:
        maybe, rest = split_by_filter(rows, ["_id"], drop, n_drop)
        kept = rest.unionByName(maybe.join(drop, "_id", "left_anti").select("_row", "_id"))
    return kept.select("_row.*")


def op1_ngram_jaccard_join(spark, sf_dir):
    found = components(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return found.select("doc_id", "n_shingles", "component_id")


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS x FROM documents),
g AS (
  SELECT DISTINCT doc_id, array_to_string(x[i:i + 4], ' ') AS gram
  FROM (SELECT doc_id, x, unnest(CASE WHEN len(x) = 0 THEN [] ELSE range(1, greatest(len(x) - 3, 2)) END) AS i FROM w)),
c AS (SELECT doc_id, count(*) AS n FROM g GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM p JOIN c ca ON ca.doc_id = a JOIN c cb ON cb.doc_id = b WHERE 100 * o >= 75 * (ca.n + cb.n - o)),
r AS (SELECT doc_id, doc_id AS reach FROM w UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.reach)
SELECT w.doc_id, coalesce(any_value(c.n), 0) AS n_shingles, min(r.reach) AS component_id
FROM w JOIN r ON r.doc_id = w.doc_id LEFT JOIN c ON c.doc_id = w.doc_id GROUP BY w.doc_id
"""
