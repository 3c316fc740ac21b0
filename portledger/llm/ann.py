"""Approximate nearest neighbours by an adaptive dimension scan of probed lists.

A random rotation spreads every vector's length evenly over its dimensions, so the distance over the
first dimensions estimates the whole one. Vectors are put into lists by their nearest centroid. In a
probed list the rotated vectors lie in column blocks; after each block a hypothesis test drops the
candidates whose partial distance, scaled up, is beyond the tenth best so far by more than the test's
margin. What is left is measured exactly, on the original vectors in double precision.

Rotation and centroids are fitted on at most ``SAMPLE`` vectors; every vector is indexed. A list is cut
into parts of about ``PART`` vectors by a hash of the id, so a list that holds a third of all rows is
many parts, and queries go to every part of a probed list. A query probes the lists
nearest to it: as many as hold ``TARGET`` of the true neighbours within the sample, which depends on
how clustered the vectors are, and at least as many as hold ``LEAST_CANDIDATES`` vectors.

Vectors that are null, zero, of another length than most, or hold null or non-finite components take
no part; rows with a null id neither. Equal distances go to the smaller id. A repeated id is a
candidate each time. No vector at all gives no rows. Other columns are not read.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from pyspark.sql import Window
from pyspark.sql import functions as F

from portledger.llm.common import stored

SAMPLE = 20_000
MAX_LISTS = 1_024
LEAST_PROBES = 8
# Share of the sample's true neighbours that the probed lists must hold.
TARGET = 0.96
PART = 4_096
QUERIES = 4_096
LEAST_CANDIDATES = 500
NEAREST = 10
COLUMNS = 16
# Width of the hypothesis test: larger keeps more candidates.
MARGIN = 2.1
# Rounding of a partial distance, as a share of the squared lengths: exact copies may be this far apart.
ROUNDING = 1e-12
FIRST = 256
CHUNK = 1_024

RESULT = "query_id long, rank int, vec_id long, score double"
ASSIGNED = "vec_id long, list int, vec binary"


def _rows(column, dim):
    """Indices of the usable vectors of an Arrow list column, and these as a matrix of doubles."""
    right = pc.fill_null(pc.equal(pc.list_value_length(column), dim), False)
    at = np.flatnonzero(right.to_numpy(zero_copy_only=False))
    if not len(at):
        return at, np.empty((0, dim))
    flat = column.take(pa.array(at)).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    x = flat.reshape(len(at), dim)
    good = np.isfinite(x).all(axis=1) & (x != 0).any(axis=1)
    return at[good], x[good]


class Index:
    """Rotation and centroids, fitted on a bounded sample."""

    def __init__(self, sample, lists, seed=7, rounds=8):
        rng = np.random.default_rng(seed)
        self.dim = sample.shape[1]
        self.rotation = np.linalg.qr(rng.standard_normal((self.dim, self.dim)))[0]
        x = sample @ self.rotation
        self.centroids = x[rng.choice(len(x), min(lists, len(x)), replace=False)]
        for _ in range(rounds):
            near = self.nearest(x)
            sums = np.zeros_like(self.centroids)
            np.add.at(sums, near, x)
            count = np.bincount(near, minlength=len(self.centroids))
            filled = count > 0
            self.centroids[filled] = sums[filled] / count[filled, None]

        self.probes = self._probes(x, rng)

    def _probes(self, x, rng, trials=256):
        """How many lists hold ``TARGET`` of the sample's own nearest neighbours."""
        near = self.nearest(x)
        needed = []
        for i in rng.choice(len(x), min(trials, len(x)), replace=False):
            closest = np.argpartition(((x - x[i]) ** 2).sum(axis=1), min(NEAREST, len(x) - 1))[: NEAREST + 1]
            place = self.distances(x[i : i + 1])[0].argsort(kind="stable").argsort()
            needed += place[near[closest[closest != i]]].tolist()
        return int(np.quantile(needed, TARGET)) + 1 if needed else 1

    def distances(self, rotated):
        return (self.centroids**2).sum(axis=1) - 2 * rotated @ self.centroids.T

    def nearest(self, rotated):
        return np.concatenate(
            [np.empty(0, np.int64), *(self.distances(part).argmin(axis=1) for part in np.array_split(rotated, max(1, len(rotated) // 4096)))]
        )


def fitted(vectors, sample=SAMPLE):
    """An index fitted on about ``sample`` vectors spread over the table by a hash; None without vectors."""
    known = vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull())
    total = known.count()
    share = min(1.0, 1.1 * sample / max(total, 1))
    drawn = known.where(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
    table = drawn.select("embedding").limit(sample).toArrow()
    column = table.column(0).combine_chunks()
    if not len(column):
        return None
    lengths = pc.value_counts(pc.list_value_length(column)).to_pylist()
    dim = max(lengths, key=lambda v: (v["counts"], v["values"]))["values"]
    x = _rows(column, dim)[1] if dim else np.empty((0, 0))
    if not len(x):
        return None
    return Index(x, int(min(MAX_LISTS, max(1, 2 * np.sqrt(total)), max(1, len(x) // 16))))


def _assigner(index):
    def assign(batches):
        for batch in batches:
            at, x = _rows(batch.column(1), index.dim)
            ids = batch.column(0).take(pa.array(at))
            near = index.nearest(x @ index.rotation)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(near, pa.int32()), pa.array([v.tobytes() for v in x], pa.binary())],
                names=["vec_id", "list", "vec"],
            )

    return assign


def _prober(index, sizes, probes, least):
    def probe(batches):
        for batch in batches:
            out = []
            for vec_id, vec in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                order = index.distances((np.frombuffer(vec) @ index.rotation)[None])[0].argsort(kind="stable")
                enough = np.searchsorted(np.cumsum(sizes[order]), least) + 1
                out += [(vec_id, l, vec) for l in order[: max(probes, enough)].tolist() if sizes[l]]
            columns = list(zip(*out)) or [(), (), ()]
            types = (pa.int64(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["vec_id", "list", "vec"])

    return probe


def scan_list(ids, x, rotated, query_id, query, rotation, nearest=NEAREST, longest=None):
    """The nearest found of one part of a list: ``(id, distance)``, by the adaptive dimension scan.

    ``longest`` is the largest squared length in ``x``, for callers that scan a part many times.
    """
    dim = x.shape[1]
    q = query @ rotation
    exact = lambda at: np.sqrt(((x[at] - query) ** 2).sum(axis=1))
    longest = (x**2).sum(axis=1).max(initial=0.0) if longest is None else longest
    slack = ROUNDING * (query @ query + longest)
    start = np.flatnonzero(ids[:FIRST] != query_id)
    best_at, best = start, exact(start)
    keep = np.lexsort((ids[best_at], best))[:nearest]
    best_at, best = best_at[keep], best[keep]
    for begin in range(FIRST, len(ids), CHUNK):
        alive = begin + np.flatnonzero(ids[begin : begin + CHUNK] != query_id)
        limit = best[-1] ** 2 if len(best) == nearest else np.inf
        partial = np.zeros(len(alive))
        done = 0
        for block in rotated:
            width = block.shape[1]
            partial += ((block[alive] - q[done : done + width]) ** 2).sum(axis=1)
            done += width
            if done < dim:
                inside = partial * (dim / done) <= limit * (1 + MARGIN / np.sqrt(done)) ** 2 + slack * (dim / done)
                alive, partial = alive[inside], partial[inside]
            if not len(alive):
                break
        alive = alive[partial <= limit * (1 + 1e-9) + slack]
        if len(alive):
            best_at, best = np.concatenate([best_at, alive]), np.concatenate([best, exact(alive)])
            keep = np.lexsort((ids[best_at], best))[:nearest]
            best_at, best = best_at[keep], best[keep]
    return ids[best_at], best


def _scanner(index, nearest):
    def scan(members, queries):
        schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
        if not members.num_rows or not queries.num_rows:
            return schema.empty_table()
        matrix = lambda t: np.frombuffer(b"".join(t.column("vec").to_pylist())).reshape(-1, index.dim)
        ids, x = members.column("vec_id").to_numpy(), matrix(members)
        whole = x @ index.rotation
        rotated = [np.ascontiguousarray(whole[:, c : c + COLUMNS]) for c in range(0, index.dim, COLUMNS)]
        longest = (x**2).sum(axis=1).max()
        found = []
        for query_id, query in zip(queries.column("vec_id").to_pylist(), matrix(queries)):
            near, score = scan_list(ids, x, rotated, query_id, query, index.rotation, nearest, longest)
            found.append((np.full(len(near), query_id), near, score))
        columns = [np.concatenate(c) for c in zip(*found)]
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return scan


def nearest_neighbours(vectors, is_query, nearest=NEAREST, probes=None, sample=SAMPLE, part=PART):
    """Each query's nearest vectors found: ``query_id, rank, vec_id, score``.

    ``vectors`` has ``vec_id`` and ``embedding``; ``is_query`` is a condition on ``vec_id``.
    """
    spark = vectors.sparkSession
    vectors = vectors.select(vectors["vec_id"].cast("long").alias("vec_id"), "embedding")
    index = fitted(vectors, sample)
    if index is None:
        return spark.createDataFrame([], RESULT)
    probes = max(LEAST_PROBES, index.probes) if probes is None else probes
    known = vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull())
    assigned = stored(known.mapInArrow(_assigner(index), ASSIGNED), "vectors")
    # One row per list, of which there are MAX_LISTS at most.
    sizes = np.zeros(len(index.centroids), np.int64)
    for r in assigned.groupBy("list").count().collect():
        sizes[r["list"]] = r["count"]
    parts = F.array(*[F.lit(int(n)).cast("long") for n in np.maximum(1, -(-sizes // part))])
    queries = assigned.where(is_query).select("vec_id", "vec")
    # Queries meet a part in groups of a bounded size too.
    turns = int(1 + queries.count() * probes // (len(sizes) * QUERIES))
    members = assigned.withColumn("part", F.pmod(F.xxhash64("vec_id"), F.get(parts, F.col("list"))))
    members = members.withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(turns - 1))))
    probed = queries.mapInArrow(_prober(index, sizes, probes, LEAST_CANDIDATES), ASSIGNED)
    probed = probed.withColumn("turn", F.pmod(F.xxhash64("vec_id"), F.lit(turns)).cast("int"))
    probed = probed.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.get(parts, F.col("list")) - 1)))
    found = (
        members.groupBy("list", "part", "turn")
        .cogroup(probed.groupBy("list", "part", "turn"))
        .applyInArrow(_scanner(index, nearest), "query_id long, vec_id long, score double")
    )
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    ranked = found.withColumn("rank", rank).where(F.col("rank") <= nearest)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op6_nearest_neighbours(spark, sf_dir):
    return nearest_neighbours(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 100 == 0)
