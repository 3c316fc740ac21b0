"""Token counts through a cache of digests.

1. Digest. Every text is normalised as the tokenizer itself would and hashed; a narrow table keeps id, bytes and digest.
2. Join. The distinct digests are joined with the counts stored for this tokenizer version; what is not there is a miss.
3. Encode. Each distinct missing content is encoded once, whole, and its count appended to the cache.
4. Count. The narrow table is joined with the cache.

Texts move at most once, one of each content: copies collapse inside the tasks before the shuffle, so content that a third of
all rows share is one row per task. If the misses fit a broadcast (counted) only their texts move at all.

The cache is a folder of facts ``(digest, n_tokens)`` below the digest of the tokenizer version. Appends go to folders of their
own, so runs side by side do no harm: a fact that two runs add is the same fact. An append cut short leaves no wrong fact.

Null text counts as empty; empty text has 0 bytes and what the library gives, 0 tokens. Repeated rows each get their row, a
null ``doc_id`` stays null, an empty table gives no rows. Other columns are not read, so their names may clash.
"""

import hashlib

import pyarrow as pa
import pyarrow.compute as pc

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from portledger.llm.common import Scratch, as_text, read_table, small_side
from portledger.session import pinned

LIMIT = 4096
# Misses up to this many digests of 32 bytes are broadcast.
BROADCAST_DIGESTS = 500_000

CONTENT = "doc_id long, n_bytes long, digest binary"
TEXTS = "digest binary, text string"
COUNTS = "digest binary, n_tokens long"


class Tokenizer:
    """A tokenizer file, its library and the digest that names this version of both.

    The file's bytes travel with the tasks, so executors need no copy of it.
    """

    def __init__(self, path):
        with open(path, "rb") as file:
            self.data = file.read()
        self.library = "sentencepiece" if path.endswith(".model") else "tokenizers"
        named = f"{self.library} {__import__(self.library).__version__}\n".encode()
        self.version = hashlib.sha256(named + self.data).hexdigest()

    def load(self):
        """``(normalise, count)`` functions of one text.

        Texts of equal normalised form have equal counts. That holds for a model's own normaliser, which runs before
        anything else; a tokenizers file looks for added tokens in the raw text first, so there texts stay as they are.
        """
        if self.library == "sentencepiece":
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_proto=self.data)
            return model.normalize, lambda text: len(model.encode(text))
        import tokenizers

        model = tokenizers.Tokenizer.from_str(self.data.decode())
        model.no_truncation()
        model.no_padding()
        return str, lambda text: len(model.encode(text, add_special_tokens=False).ids)


def default_tokenizer():
    """The public vocabulary of 32,000 pieces."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class TokenCountCache:
    """Stored counts at ``path``, a folder all executors share."""

    def __init__(self, spark, path):
        self.spark = spark
        self.path = path.rstrip("/")

    def _folder(self, version):
        return f"{self.path}/tokenizer={version}"

    def counts(self, version):
        """``(digest, n_tokens)`` stored for one tokenizer version, one row per digest."""
        try:
            rows = self.spark.read.schema(COUNTS).parquet(self._folder(version))
        except AnalysisException as exc:
            if exc.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], COUNTS)
        return rows.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))

    def append(self, counts, version, run):
        counts.write.parquet(f"{self._folder(version)}/run={run}")

    def compact(self, version, run):
        """All facts of a version in one new folder; the folders they were in go afterwards."""
        from portledger.llm.common import drop_folder

        jvm = self.spark._jvm
        folder = jvm.org.apache.hadoop.fs.Path(self._folder(version))
        fs = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        before = [s.getPath().toString() for s in fs.listStatus(folder)]
        self.append(self.counts(version), version, run)
        for path in before:
            drop_folder(self.spark, path)


def _digests(tokenizer):
    def digests(batches):
        normalise, _ = tokenizer.load()
        for batch in batches:
            found = [hashlib.sha256(normalise(t.as_py()).encode()).digest() for t in batch.column("text")]
            sizes = pc.cast(pc.binary_length(batch.column("text")), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), sizes, pa.array(found, pa.binary())], names=["doc_id", "n_bytes", "digest"]
            )

    return digests


def _contents(tokenizer):
    def contents(batches):
        normalise, _ = tokenizer.load()
        for batch in batches:
            text = batch.column("text")
            found = [hashlib.sha256(normalise(t.as_py()).encode()).digest() for t in text]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary()), text], names=["digest", "text"])

    return contents


def _encoded(tokenizer):
    def encoded(batches):
        _, count = tokenizer.load()
        for batch in batches:
            counts = pa.array([count(t.as_py()) for t in batch.column("text")], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("digest"), counts], names=["digest", "n_tokens"])

    return encoded


def token_counts(docs, tokenizer, cache, scratch):
    """``(doc_id, n_bytes, n_tokens, over_limit)`` of every document; new contents are added to ``cache``.

    ``scratch`` holds the narrow tables the result reads; drop it when the result is written.
    """
    text = as_text(docs).alias("text")
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text)
    content = scratch.stored(rows.mapInArrow(_digests(tokenizer), CONTENT), "contents")
    known = cache.counts(tokenizer.version)
    misses = content.select("digest").distinct().join(known, "digest", "left_anti")
    misses = scratch.stored(misses, "misses")
    first = F.first("text").alias("text")
    texts = rows.select("text").mapInArrow(_contents(tokenizer), TEXTS)
    n_misses = misses.count()
    if n_misses:
        if n_misses <= BROADCAST_DIGESTS:
            texts = texts.join(small_side(misses, BROADCAST_DIGESTS), "digest", "left_semi").groupBy("digest").agg(first)
        else:
            # Copies collapse before the only shuffle of texts; the misses meet them where they are then.
            texts = texts.groupBy("digest").agg(first).join(misses, "digest", "left_semi")
        cache.append(texts.mapInArrow(_encoded(tokenizer), COUNTS), tokenizer.version, scratch.name)
    return content.join(cache.counts(tokenizer.version), "digest").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > LIMIT).alias("over_limit")
    )


def op11_token_counts(spark, sf_dir):
    """Counts of the whole table through a cache that starts empty and is dropped with the run."""
    with Scratch(spark, "token-counts") as scratch:
        cache = TokenCountCache(spark, scratch.path("cache"))
        docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
        return pinned(token_counts(docs, Tokenizer(default_tokenizer()), cache, scratch))
