"""Merkle manifest of a document table, with incremental witnesses.

Leaves of one language are a sequence in id order. A streaming append adds leaf after leaf to a tree whose runs of
eight become their parent as they fill. Every open subtree carries the partial witnesses of its leaves: when a run is
complete, each member gets one link to its siblings and the parent, which all leaves below it share, and the parent
is appended to the level above. So a leaf's witness is a chain that later completions only extend.

Distributed, appends are aligned: a block is ``8**height`` consecutive leaves, so blocks are whole subtrees and
independent. Their roots are further appends of the same kind, block by block, until one root per language is left; the
languages' roots are once more a sequence. The witness of a leaf is its block's part, then its block root's, then its
language's. A language that holds most rows is many blocks; no task sees more than one block at a time.

``Manifest.append`` adds later documents: only the block that is still open is built again. Blocks lie in a
folder of publications; a closed block is never written twice.

A leaf is the hash of id, source, language, length and text; nulls count as ``-`` and differ from empty texts. A null
``doc_id`` sorts first and is never tampered with, a null language comes before all others. Equal ids are ordered by leaf,
so repeated rows and ties give the same rows in any input order; each repeated row is a leaf. An empty table gives no
rows. Other columns are not read, so their names may clash.
"""

import hashlib
import string

import pyarrow as pa

from pyspark.errors import AnalysisException
from pyspark.sql import Window
from pyspark.sql import functions as F

from portledger.llm.common import Scratch, partitions, read_table, small_side
from portledger.session import pinned

# Members of a run; levels of runs in a block.
ARITY = 8
HEIGHT = 4

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]

# ``key`` orders languages, null first; ``lone`` is the subtree's own root, ``root`` its root at the block's full height.
BLOCKS = (
    "key string, block long, size int, doc_ids array<long>, leaves array<binary>, tampered array<binary>, "
    "lone string, root string"
)
STEPS = "array<struct<place: int, siblings: array<string>>>"
WITNESSES = f"key string, idx long, n long, steps {STEPS}, up long, root string"
RESULT = (
    "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
)


def run_hash(digests):
    return hashlib.sha256("".join(digests).encode()).hexdigest()


def levels_above(n):
    """Levels of runs over ``n`` nodes until one remains."""
    levels = 0
    while n > 1:
        n, levels = -(-n // ARITY), levels + 1
    return levels


class _Node:
    __slots__ = ("digest", "place", "run", "parent")

    def __init__(self, digest):
        self.digest, self.place, self.run, self.parent = digest, None, None, None


class Appender:
    """A tree that grows by appends, and the witnesses of what was appended."""

    def __init__(self):
        self.leaves, self._open = [], [[]]

    def append(self, digest):
        leaf = _Node(digest)
        self.leaves.append(leaf)
        self._add(0, leaf)

    def _add(self, level, node):
        if level == len(self._open):
            self._open.append([])
        self._open[level].append(node)
        if len(self._open[level]) == ARITY:
            self._complete(level)

    def _complete(self, level):
        members, self._open[level] = self._open[level], []
        run = [m.digest for m in members]
        parent = _Node(run_hash(run))
        for place, member in enumerate(members):
            member.place, member.run, member.parent = place, run, parent
        self._add(level + 1, parent)

    def close(self, levels):
        """Complete the runs that are still short, up to ``levels``; the root."""
        for level in range(levels):
            if self._open[level]:
                self._complete(level)
        return self._open[levels][0].digest

    @staticmethod
    def witness(node):
        """``(place, siblings)`` of every level that the node's chain has reached."""
        steps = []
        while node.parent is not None:
            steps.append((node.place, node.run[: node.place] + node.run[node.place + 1 :]))
            node = node.parent
        return steps


def appended(digests, levels):
    tree = Appender()
    for digest in digests:
        tree.append(digest)
    return tree, tree.close(levels)


def folded(digest, steps):
    """The root that follows from a leaf and its witness."""
    for place, siblings in steps:
        digest = run_hash([*siblings[:place], digest, *siblings[place:]])
    return digest


# Leaves, as Column expressions.


def _field(value):
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_rows(docs):
    """``(key, doc_id, leaf, tampered)``: the leaf's digest, and that of the tampered row where it is tampered with."""
    rest = [_field(docs[c]) for c in FIELDS[:-1]]
    hashed = lambda text: F.unhex(F.sha2(F.concat(*rest, _field(text)).cast("binary"), 256))
    lowered = F.translate(docs["text"].cast("string"), string.ascii_uppercase, string.ascii_lowercase)
    chosen = F.crc32(docs["doc_id"].cast("string").cast("binary")) % 3 == 0
    return docs.select(
        F.coalesce(F.concat(F.lit("="), docs["lang"].cast("string")), F.lit("")).alias("key"),
        docs["doc_id"].cast("long").alias("doc_id"),
        hashed(docs["text"]).alias("leaf"),
        F.when(chosen, hashed(lowered)).alias("tampered"),
    )


def numbered(rows, order, scratch):
    """``pos``: the place of each row within its key, from 0, in ``order``.

    Rows are dealt by ranges of key and order and written sorted; a place is the row's place in its range plus what
    the key has in earlier ranges. Rows that are equal in everything are told apart by where they came from.
    """
    first = scratch.stored(rows.withColumn("_tie", F.monotonically_increasing_id()), "rows")
    by = ["key", *order, "_tie"]
    ranged = first.repartitionByRange(partitions(rows.sparkSession), *by).sortWithinPartitions(*by).drop("_tie")
    ranged = scratch.stored(ranged.withColumn("_at", F.monotonically_increasing_id()), "ranged")
    ranged = ranged.withColumn("_part", F.shiftright("_at", 33))
    before = Window.partitionBy("key").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # At most one row per range and key, and a range holds whole keys but for its first and last.
    starts = ranged.groupBy("key", "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    starts = starts.select("key", "_part", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    starts = scratch.stored(starts, "starts")
    placed = ranged.join(small_side(starts), ["key", "_part"])
    return placed.withColumn("pos", F.col("_at") - F.col("_first") + F.col("_before")).drop(
        "_at", "_part", "_first", "_before"
    )


# Blocks of leaves.


def _packed(height):
    def packed(table):
        table = table.sort_by("pos")
        digests = [d.hex() for d in table.column("leaf").to_pylist()]
        _, lone = appended(digests, levels_above(len(digests)))
        root = lone
        for _ in range(height - levels_above(len(digests))):
            root = run_hash([root])
        lists = [pa.array([table.column(c).to_pylist()]) for c in ("doc_id", "leaf", "tampered")]
        kinds = (pa.int64(), pa.binary(), pa.binary())
        return pa.table(
            [
                table.column("key").slice(0, 1),
                table.column("block").slice(0, 1),
                pa.array([len(digests)], pa.int32()),
                *(x.cast(pa.list_(k)) for x, k in zip(lists, kinds)),
                pa.array([lone]),
                pa.array([root]),
            ],
            names=["key", "block", "size", "doc_ids", "leaves", "tampered", "lone", "root"],
        )

    return packed


class Manifest:
    """A manifest below ``path`` in the shared file system; one writer at a time."""

    def __init__(self, spark, path, height=HEIGHT):
        self.spark = spark
        self.path = path.rstrip("/")
        self.height = height
        self.block = ARITY**height

    def blocks(self):
        """The newest state of every block: closed ones as they are, of open ones the longest."""
        try:
            found = self.spark.read.schema(BLOCKS).option("recursiveFileLookup", "true").parquet(f"{self.path}/blocks")
        except AnalysisException as exc:
            if exc.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], BLOCKS)
        # Only narrow rows meet here: one per block and publication.
        newest = found.groupBy("key", "block").agg(F.max("size").alias("size"))
        return found.join(newest, ["key", "block", "size"])

    def append(self, docs, publication):
        """Add documents that follow, in each language, the ones already there; done twice, it adds nothing.

        ``publication`` names this append. Open blocks are built again from their leaves and the new ones.
        """
        fs_path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/blocks/{publication}/_SUCCESS")
        if fs_path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(fs_path):
            return
        with Scratch(self.spark, "merkle-append") as scratch:
            new = numbered(leaf_rows(docs), ["doc_id", "leaf"], scratch)
            stored = self.blocks()
            known = stored.groupBy("key").agg(
                F.sum("size").cast("long").alias("_stored"), F.max(F.array_max("doc_ids")).alias("_last")
            )
            known = scratch.stored(known, "known")
            if known.limit(1).count():
                starts = new.groupBy("key").agg(F.expr("min(coalesce(doc_id, -9223372036854775808))").alias("_least"))
                both = scratch.stored(starts.join(known, "key"), "both")
                if both.where("_least < _last").limit(1).count():
                    raise ValueError("an append must follow the stored documents of its language")
                new = new.join(small_side(known), "key", "left")
                new = new.withColumn("pos", F.col("pos") + F.coalesce("_stored", F.lit(0))).drop("_stored", "_last")
                open_blocks = stored.where(F.col("size") < self.block).join(small_side(both), "key", "left_semi")
                zipped = F.arrays_zip("doc_ids", "leaves", "tampered")
                again = open_blocks.select("key", "block", F.posexplode(zipped).alias("_i", "_l")).select(
                    "key",
                    F.col("_l.doc_ids").alias("doc_id"),
                    F.col("_l.leaves").alias("leaf"),
                    F.col("_l.tampered").alias("tampered"),
                    (F.col("block") * self.block + F.col("_i")).alias("pos"),
                )
                new = new.unionByName(again)
            new = new.withColumn("block", F.expr(f"pos div {self.block}"))
            packed = new.groupBy("key", "block").applyInArrow(_packed(self.height), BLOCKS)
            packed.write.mode("overwrite").parquet(f"{self.path}/blocks/{publication}")

    def witnesses(self, scratch):
        """``RESULT`` of every leaf: the untampered manifest, and what folding the tampered leaf gives."""
        blocks = self.blocks()
        narrow = scratch.stored(blocks.select("key", "block", "lone", "root"), "blocks")
        n = narrow.groupBy("key").agg(F.count("*").alias("n"))
        nodes = narrow.join(n, "key").select("key", F.col("block").alias("idx"), "n", "lone", "root")
        nodes = scratch.stored(nodes, "nodes")
        # The only block of a language is a tree of its own height; others are subtrees of full height.
        inner, tops = _climbed(nodes.where("n > 1").select("key", "idx", "n", "root"), self.height, scratch)
        subroots = tops.unionByName(nodes.where("n = 1").select("key", F.col("lone").alias("root")))
        if subroots.limit(1).count() == 0:
            return self.spark.createDataFrame([], RESULT)
        # The languages' roots are one sequence, under a key of their own.
        named = subroots.select(F.lit("").alias("key"), F.col("key").alias("of"), "root")
        named = scratch.stored(numbered(named, ["of"], scratch), "subroots")
        count = named.count()
        outer, top = _climbed(
            named.select("key", F.col("pos").alias("idx"), F.lit(count).cast("long").alias("n"), "root"), self.height, scratch
        )
        root = top.first()["root"]
        places = named.join(outer.select(F.col("idx").alias("pos"), "steps"), "pos", "left").select(
            F.col("of").alias("key"), F.col("root").alias("subroot"), F.coalesce("steps", _no_steps()).alias("_outer")
        )
        upper = (
            narrow.select("key", "block")
            .join(inner.select("key", F.col("idx").alias("block"), "steps"), ["key", "block"], "left")
            .join(places, "key")
            .select("key", "block", "subroot", F.concat(F.coalesce("steps", _no_steps()), "_outer").alias("steps"))
        )
        joined = blocks.join(n, "key").join(upper, ["key", "block"])
        return joined.select("doc_ids", "leaves", "tampered", "n", "subroot", "steps").mapInArrow(
            _emitted(self.height, root), RESULT
        )


def _no_steps():
    return F.array().cast(STEPS)


def _climbed(nodes, height, scratch):
    """Witnesses ``(key, idx, steps)`` of sequences of nodes, and the root ``(key, root)`` of each key.

    ``nodes`` is ``(key, idx, n, root)``. Each round appends the nodes block by block; the blocks' roots are the nodes of
    the next one. Rounds grow with the logarithm of the longest sequence.
    """
    spark = nodes.sparkSession
    size = ARITY**height

    def extended(table):
        table = table.sort_by("idx")
        digests, n = table.column("root").to_pylist(), table.column("n")[0].as_py()
        tree, root = appended(digests, levels_above(n) if n <= size else height)
        steps = [[{"place": p, "siblings": s} for p, s in tree.witness(leaf)] for leaf in tree.leaves]
        rows = len(steps)
        return pa.table(
            [
                table.column("key"),
                table.column("idx"),
                table.column("n"),
                pa.array(steps, pa.list_(pa.struct([("place", pa.int32()), ("siblings", pa.list_(pa.string()))]))),
                pa.array([i // size for i in table.column("idx").to_pylist()], pa.int64()),
                pa.array([root] * rows),
            ],
            names=["key", "idx", "n", "steps", "up", "root"],
        )

    rounds, roots = [], spark.createDataFrame([], "key string, root string")
    while nodes.limit(1).count():
        grouped = nodes.withColumn("up", F.expr(f"idx div {size}")).groupBy("key", "up")
        done = scratch.stored(grouped.applyInArrow(extended, WITNESSES), "witnesses")
        rounds.append(done)
        firsts = done.where(F.col("idx") % size == 0)
        roots = roots.unionByName(firsts.where(F.col("n") <= size).select("key", "root"))
        nodes = firsts.where(F.col("n") > size).select(
            "key", F.col("up").alias("idx"), F.ceil(F.col("n") / size).cast("long").alias("n"), "root"
        )
    steps = None
    for done in reversed(rounds):
        own = done.select("key", "idx", "up", "steps")
        if steps is not None:
            above = steps.select("key", F.col("idx").alias("up"), F.col("steps").alias("_above"))
            own = own.join(above, ["key", "up"], "left")
            own = own.withColumn("steps", F.concat("steps", F.coalesce("_above", _no_steps())))
        steps = own.select("key", "idx", "steps")
    if steps is None:
        steps = spark.createDataFrame([], f"key string, idx long, steps {STEPS}")
    return steps, roots


def _emitted(height, root):
    def emitted(batches):
        for batch in batches:
            for row in batch.to_pylist():
                yield _block_result(row, height, root)

    return emitted


def _block_result(row, height, root):
    """Results of one block: its appends are replayed, and each leaf's chain goes on with the block's own witness."""
    digests = [d.hex() for d in row["leaves"]]
    tree, _ = appended(digests, levels_above(len(digests)) if row["n"] == 1 else height)
    upper = [(s["place"], s["siblings"]) for s in row["steps"]]
    upper_text = "".join("".join(s) for _, s in upper)
    proofs, roots = [], []
    for leaf, tampered in zip(tree.leaves, row["tampered"]):
        steps = tree.witness(leaf)
        siblings = "".join("".join(s) for _, s in steps) + upper_text
        proofs.append(hashlib.sha256(siblings.encode()).hexdigest())
        roots.append(folded(folded(tampered.hex() if tampered else leaf.digest, steps), upper))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(row["doc_ids"], pa.int64()),
            pa.array(digests),
            pa.array([row["subroot"]] * len(digests)),
            pa.array([root] * len(digests)),
            pa.array(proofs),
            pa.array(roots),
            pa.array([r == root for r in roots]),
        ],
        names=["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"],
    )


def append_stream(stream, manifest, checkpoint):
    """Append a stream of documents, in id order per language, one publication per micro-batch."""

    def take(batch, epoch):
        manifest.append(batch, f"epoch-{epoch:09d}")

    writer = stream.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def op12_merkle_manifest(spark, sf_dir):
    with Scratch(spark, "merkle") as scratch:
        manifest = Manifest(spark, scratch.path("manifest"))
        manifest.append(read_table(spark, sf_dir, "documents").select(*FIELDS), "all")
        return pinned(manifest.witnesses(scratch))


def oracle(levels=12):
    """The contract as SQL: ``levels`` levels of runs each for languages and for the root, one node passing through unchanged."""
    crc_step = "list_reduce([c, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)"
    field = lambda v: f"coalesce(strlen({v}) || ':' || {v}, '-')"
    fixed = " || ".join(field(f"{c}::VARCHAR") for c in FIELDS[:-1])
    lowered = f"translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
    ctes = [
        f"crc_table AS (SELECT list_transform(range(256), lambda c: {crc_step}) AS entries)",
        f"""leaves AS (
  SELECT doc_id, coalesce('=' || lang, '') AS key,
    sha256({fixed} || {field('text')}) AS leaf,
    CASE WHEN doc_id IS NOT NULL AND xor(list_reduce(
        list_concat([4294967295::BIGINT], list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
        lambda a, b: xor(a >> 8, entries[(xor(a, b) & 255) + 1])), 4294967295) % 3 = 0
      THEN sha256({fixed} || {field(lowered)}) ELSE sha256({fixed} || {field('text')}) END AS tampered
  FROM documents, crc_table)""",
        "t0 AS (SELECT doc_id, key, leaf, tampered, row_number() OVER (PARTITION BY key ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, "
        "leaf AS node, tampered AS fold, '' AS proof FROM leaves)",
        "n0 AS (SELECT DISTINCT key, idx, node FROM t0)",
    ]

    def climb(i, prefix, key):
        """Level ``i``: nodes of runs, and every leaf's node, fold and proof one level up."""
        n, t = f"n{prefix}{i}", f"t{prefix}{i}"
        ctes.append(f"{n}c AS (SELECT *, count(*) OVER (PARTITION BY {key}) AS total FROM {n})")
        ctes.append(
            f"{n}r AS MATERIALIZED (SELECT {key}, idx // {ARITY} AS run, any_value(total) AS total, list(node ORDER BY idx) AS members, "
            f"CASE WHEN any_value(total) = 1 THEN any_value(node) ELSE sha256(string_agg(node, '' ORDER BY idx)) END AS up "
            f"FROM {n}c GROUP BY ALL)"
        )
        ctes.append(f"n{prefix}{i + 1} AS MATERIALIZED (SELECT {key}, run AS idx, up AS node FROM {n}r)")
        place = f"({t}.idx % {ARITY})"
        before, after = f"members[1:{place}::BIGINT]", f"members[{place}::BIGINT + 2:]"
        joined = lambda part: f"array_to_string({part}, '')"
        ctes.append(
            f"t{prefix}{i + 1} AS MATERIALIZED (SELECT doc_id, {t}.key, leaf, tampered, {t}.idx // {ARITY} AS idx, up AS node, "
            + ("subroot, " if prefix else "")
            + f"CASE WHEN total = 1 THEN fold ELSE sha256({joined(before)} || fold || {joined(after)}) END AS fold, "
            f"CASE WHEN total = 1 THEN proof ELSE proof || {joined(before)} || {joined(after)} END AS proof "
            f"FROM {t} JOIN {n}r ON {t}.idx // {ARITY} = {n}r.run" + ("" if prefix else f" AND {t}.key = {n}r.key") + ")"
        )

    for i in range(levels):
        climb(i, "", "key")
    ctes.append(f"subroots AS (SELECT key, node, row_number() OVER (ORDER BY encode(key)) - 1 AS idx FROM n{levels})")
    ctes.append("nx0 AS (SELECT 0 AS one, idx, node FROM subroots)")
    ctes.append(
        f"tx0 AS (SELECT doc_id, t{levels}.key, leaf, tampered, subroots.idx, subroots.node, subroots.node AS subroot, fold, proof "
        f"FROM t{levels} JOIN subroots ON t{levels}.key = subroots.key)"
    )
    for i in range(levels // 2):
        climb(i, "x", "one")
    return (
        "WITH "
        + ",\n".join(ctes)
        + f"\nSELECT doc_id, leaf, subroot, node AS root, sha256(proof) AS proof_sha256, fold AS folded_root, fold = node AS verified FROM tx{levels // 2}"
    )
