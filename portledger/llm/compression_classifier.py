"""Quality classifier by compression.

Two zstandard dictionaries are trained, on good and on bad labelled texts. A text is cut into pieces of
``PIECE`` bytes, so that its own history doesn't outweigh the dictionary; each piece is compressed with
either. The size difference over all pieces, per byte and damped for short texts, and the text's
shortness are turned into the probability of label 1 by a logistic curve, fitted on labelled texts that the dictionaries haven't seen and weighted by the
labels' shares.

Fitting uses at most ``SAMPLE`` labelled texts of each label, whole, of up to ``LONGEST`` characters, drawn by
a hash of the id. Scoring runs over whole texts in tasks; nothing is shuffled but the label counts.

Null or empty text has a difference of 0 and gets the score of that. Labels other than 0 and 1 are
left out; without labels of both kinds the score is the share of label 1, or 0.5 without any. A null
``doc_id`` counts as an empty id text. Repeated rows are scored each; other columns are not read.
"""

import math

import numpy as np
import pyarrow as pa
import zstandard

from pyspark.sql import functions as F

SAMPLE = 3_000
LONGEST = 100_000
PIECE = 1_024
# Length in bytes at which a difference counts half.
SHORT = 64
DICTIONARY_BYTES = 112 << 10
LEVEL = 3
FOLDS = 5
THRESHOLD = 0.3

SCORED = "doc_id long, held_out boolean, score double, predicted int, difference double"


def held_out(doc_id):
    """Whether a row belongs to the fold that labels are never learnt from."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % FOLDS == 0


def pieces(raw, size=PIECE):
    return [raw[i : i + size] for i in range(0, len(raw), size)]


class Compressors:
    """Compressed sizes with the good and the bad dictionary."""

    def __init__(self, dictionaries):
        self.two = []
        for data in dictionaries:
            known = zstandard.ZstdCompressionDict(data)
            known.precompute_compress(level=LEVEL)
            options = dict(dict_data=known, write_content_size=False, write_checksum=False)
            self.two.append(zstandard.ZstdCompressor(level=LEVEL, **options))

    def difference(self, text):
        """Bytes that the bad dictionary needs beyond the good one, and the text's length in bytes."""
        raw = (text or "").encode()
        good, bad = (sum(len(c.compress(p)) for p in pieces(raw)) for c in self.two)
        return bad - good, len(raw)


def features(difference, length):
    """Normalised difference, damped for short texts, and how short the text is."""
    return difference / (length + SHORT), SHORT / (length + SHORT)


def logistic_fit(x, y, weight, rounds=50):
    """Slopes and intercept of a weighted logistic curve, by Newton steps with a slight ridge."""
    rows = np.column_stack([x, np.ones(len(x))])
    a = np.zeros(rows.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(rows @ a, -30, 30)))
        grad = rows.T @ (weight * (y - p)) - 1e-6 * a
        curve = (rows * (weight * p * (1 - p))[:, None]).T @ rows + 1e-6 * np.eye(len(a))
        step = np.linalg.solve(curve, grad)
        a = a + step
        if np.abs(step).max() < 1e-9:
            break
    return a.tolist()


class Model:
    """Dictionaries and curve; ``constant`` where there was nothing to learn from."""

    def __init__(self, texts, shares):
        self.constant, self.dictionaries, self.curve = None, None, None
        if min(len(texts[0]), len(texts[1])) < 20:
            total = shares[0] + shares[1]
            self.constant = shares[1] / total if total else 0.5
            return
        built = {}
        for label in (1, 0):
            parts = [p for t in texts[label][::2] for p in pieces(t.encode())]
            size = min(DICTIONARY_BYTES, max(4_096, sum(map(len, parts)) // 10))
            try:
                built[label] = zstandard.train_dictionary(size, parts, level=LEVEL).as_bytes()
            except zstandard.ZstdError:  # too little to train on: the texts themselves
                built[label] = b"".join(parts)[:size]
        self.dictionaries = [built[1], built[0]]
        use = Compressors(self.dictionaries)
        x, y, w = [], [], []
        for label in (1, 0):
            rest = texts[label][1::2]
            x += [features(*use.difference(t)) for t in rest]
            y += [label] * len(rest)
            w += [shares[label] / len(rest)] * len(rest)
        x, y, w = (np.asarray(v, float) for v in (x, y, w))
        spread = np.maximum(x.std(axis=0), 1e-9)
        *slopes, offset = logistic_fit(x / spread, y, w * len(w) / w.sum())
        self.curve = [float(v) for v in slopes / spread] + [offset]

    def score(self, difference, length):
        if self.constant is not None:
            return self.constant
        a, b = features(difference, length)
        z = self.curve[0] * a + self.curve[1] * b + self.curve[2]
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def fitted(docs, labels, sample=SAMPLE):
    """Model learnt from the labels outside the held-out fold."""
    known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    shares = {0: 0, 1: 0} | {r["quality"]: r["count"] for r in known.groupBy("quality").count().collect()}
    texts = {0: [], 1: []}
    long_enough = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    long_enough = long_enough.where((F.length("text") > 0) & (F.length("text") <= LONGEST))
    for label in (0, 1):
        # At most SAMPLE ids.
        ids = known.where(F.col("quality") == label).select("doc_id").distinct()
        ids = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
        rows = long_enough.join(F.broadcast(ids), "doc_id", "left_semi").limit(sample).collect()
        texts[label] = [r["text"] for r in sorted(rows, key=lambda r: (r["doc_id"], r["text"]))]
    return Model(texts, shares)


def _scorer(model):
    def score(batches):
        use = Compressors(model.dictionaries) if model.dictionaries else None
        for batch in batches:
            found = [use.difference(t) if use else (0, 0) for t in batch.column(2).to_pylist()]
            scores = [model.score(*d) for d in found]
            predicted = pa.array([int(s >= THRESHOLD) for s in scores], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(scores, pa.float64()), predicted, pa.array([features(*d)[0] for d in found], pa.float64())],
                names=["doc_id", "held_out", "score", "predicted", "difference"],
            )

    return score


def scored(docs, labels, sample=SAMPLE):
    """``(doc_id, held_out, score, predicted, difference)`` of every document."""
    model = fitted(docs, labels, sample)
    doc_id = docs["doc_id"].cast("long")
    rows = docs.select(doc_id.alias("doc_id"), held_out(doc_id).alias("held_out"), docs["text"].cast("string").alias("text"))
    return rows.mapInArrow(_scorer(model), SCORED)


def op5_compression_classifier(spark, sf_dir):
    read = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return scored(read("documents").select("doc_id", "text"), read("labels"))
