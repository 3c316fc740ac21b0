"""Shared pieces of the training-data operators."""

import uuid

from pyspark.sql import functions as F

from portledger.session import checkpoint_root, scratch_path

# Rows up to which a table whose rows are a few numbers may be broadcast.
BROADCAST_ROWS = 20_000


def read_table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df, name):
    """``df`` written to the shared checkpoint folder and read again: lineage ends there."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_folder(spark, path):
    """Delete a folder of the shared file system."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


class Scratch:
    """Working tables of one run, below one folder of the shared checkpoint folder, dropped at the end.

    A result that outlives the run is checkpointed inside it.
    """

    def __init__(self, spark, name):
        self.spark = spark
        self.root = scratch_path(spark, name)
        self.name = self.root.rsplit("/", 1)[-1]

    def __enter__(self):
        return self

    def __exit__(self, *exc):
        drop_folder(self.spark, self.root)

    def path(self, name):
        return f"{self.root}/{name}"

    def stored(self, df, name):
        """``df`` written to the folder and read again: lineage ends there."""
        path = self.path(f"{name}-{uuid.uuid4().hex}")
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


def small_side(df, rows=BROADCAST_ROWS):
    """``df`` marked for broadcast when it has at most ``rows`` (narrow) rows, else as it is."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def partitions(spark, least=1):
    return max(least, int(spark.conf.get("spark.sql.shuffle.partitions")))


def as_text(df, column="text"):
    """The text column with null as empty text."""
    return F.coalesce(df[column].cast("string"), F.lit(""))


def connected_components(edges, rounds=60, stored=stored):
    """``(node, component)`` of the undirected graph ``edges(a, b)``: the smallest node reachable.

    Alternating large-star and small-star steps on DataFrames: every step shuffles the links by
    node, keeps one link per pair and is written to the shared folder. Chains shorten by a factor in
    each round, so the number of rounds grows with the logarithm of the longest path. A hot node
    costs one partially aggregated minimum and a join that Spark may split; no node's neighbours
    meet in memory.
    """
    spark = edges.sparkSession
    checkpoint_root(spark)
    links = edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    links = stored(links, "links")
    for _ in range(rounds):
        # Large star: neighbours above a node go to the least of the node and its neighbours.
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # Small star: neighbours below a node, and the node, go to the least of them.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = (
            joined.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v")))
            .distinct()
        )
        after = stored(small, "links")
        # Done when every node has one link and no centre has a link of its own.
        centres = after.select(F.col("v").alias("u")).distinct()
        several = after.groupBy("u").count().where("count > 1")
        if several.limit(1).count() == 0 and after.join(centres, "u", "left_semi").limit(1).count() == 0:
            links = after
            break
        links = after
    else:
        raise RuntimeError("components did not settle")
    nodes = links.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
