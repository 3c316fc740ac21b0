"""Secret scan: candidates by pattern, false positives removed by a random forest.

Candidates are private key headers, runs of 16 and more token characters, whole whatever their length, quoted values, values behind
the name of a secret, passwords in addresses and short keys of a known form. The forest sees a candidate's length, its character
transitions (changes of character class, and how usual its letter pairs are in the corpus), how much of it dictionary words
cover, the path it is in and the words around it. It is trained from labelled findings, of which at most ``SAMPLE`` are
used; ``labelled_findings`` makes them from the corpus where no reviewed ones are at hand: a known
key format or a named, mixed value is a secret, plain letters or plain digits in running text are not.

Dictionary and letter pairs come from all documents: the words that most documents hold, ``DICTIONARY`` of
them. Everything is DataFrame operations; documents without a candidate are read and left, only
candidates move, each with the few characters around it. Distinct candidate texts are measured once, so copies of one secret
cost one, in chunks, so a text without a blank is many small rows.

Result: ``doc_id, start, length, score, is_secret``; ``start`` counts code points from 0. Null or empty text has
no candidates. Rows with a repeated or null ``doc_id`` are scanned each. A null ``source`` is an empty path.
Without labelled findings of both kinds every candidate scores 1: nothing is known to be false.
"""

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Window
from pyspark.sql import functions as F

from portledger.llm.common import as_text, stored
from portledger.operators.dedup import split_by_filter

# Patterns of candidates and known key formats.
KEY_HEADER = r"-----BEGIN [A-Z ]{0,32}PRIVATE KEY-----"
TOKEN_RUN = r"[A-Za-z0-9+/=_\-]{16,}+"
QUOTED_VALUE = r"(?<=[\"'])[^\"'\s]{8,}+(?=[\"'])"
# What must end before a named value is looked at first: the names are then tried at few places.
NAMED_VALUE = r"(?<=[=: \"'])(?<=[=:]|: |=[\"'])(?<=(?i:word|pwd|pass|ecret|oken|_key|-key|apikey)(?:=|: |:|=\"|='))[^\s\"',;]{6,}+"
ADDRESS_PASSWORD = r"(?<=[^\s/:@]:)[^\s/:@\"']{3,}+(?=@[A-Za-z0-9])"
SHORT_KEY = r"(?<![A-Za-z0-9])sk-[A-Za-z0-9]{8,}+"
# No candidate starts behind a letter or digit, unless with a dash or where the last one ended: a run of token characters is
# taken from its first one. The kinds are not tried elsewhere.
START = r"(?:(?<![A-Za-z0-9])|(?=-)|\G)"
CANDIDATE = f"{START}(?:{'|'.join([KEY_HEADER, NAMED_VALUE, TOKEN_RUN, QUOTED_VALUE, ADDRESS_PASSWORD, SHORT_KEY])})"
KNOWN_FORMAT = r"^(AKIA|ASIA)[0-9A-Z]{16}$|^gh[pousr]_[A-Za-z0-9]{36}$|^xox[abprs]-[A-Za-z0-9-]+$|^sk_live_[A-Za-z0-9]+$|^sk-[A-Za-z0-9]{8,}$|^AIza[A-Za-z0-9_-]{35}$|^-----BEGIN [A-Z ]*PRIVATE KEY-----$"
NAMES = r"(?i)(token|secret|passw|pwd|api.?key|access.?key|credential|auth)"
EXAMPLES = r"(?i)(example|dummy|sample|placeholder|your|test|fixture|mock)"
ASSIGNED = r"[:=]\s*[\"']?$"
ADDRESS = r"://[^\s/@]*:$"
QUOTED = r"[\"']$"

SAMPLE = 4_000
# Candidates are measured in chunks of so many code points, each with the start of the next.
CHUNK, LONGEST_WORD = 256, 12
DICTIONARY = 20_000
BEFORE, AFTER = 40, 24
MASK = "<SECRET>"

FEATURES = [
    "length",
    "class_changes",
    "digits",
    "capitals",
    "distinct_share",
    "pair_log",
    "covered",
    "named",
    "assigned",
    "quoted",
    "address",
    "example_near",
    "plain_before",
    "plain_after",
    "path_example",
    "path_depth",
]


def pattern_of(text):
    """The pattern that finds the candidates of a text; null if it has none.

    Each kind is sought by itself first: that takes a fraction of the time of all kinds at once, and most texts have none or runs
    alone. A kind that is nowhere in a text can be left out of its pattern.
    """
    others = (
        text.rlike(NAMED_VALUE)
        | text.rlike(QUOTED_VALUE)
        | (text.contains("@") & text.rlike(ADDRESS_PASSWORD))
        | (text.contains("sk-") & text.rlike(SHORT_KEY))
        | (text.contains("PRIVATE KEY-----") & text.rlike(KEY_HEADER))
    )
    return F.when(others, F.lit(CANDIDATE)).when(text.rlike(TOKEN_RUN), F.lit(TOKEN_RUN))


def candidates(docs):
    """One row per candidate: ``doc_id, tie, nth, start, candidate, before, after, path``.

    ``nth`` numbers a text's candidates from 0, ``tie`` is the text's hash: rows of one id are told apart by it.
    """
    path = F.coalesce(docs["source"].cast("string"), F.lit("")) if "source" in docs.columns else F.lit("")
    text = as_text(docs)
    df = docs.select("doc_id", text.alias("_t"), path.alias("path"), pattern_of(text).alias("_k")).where("_k is not null")
    row = F.monotonically_increasing_id().alias("_row")
    df = df.select(
        "doc_id",
        F.xxhash64("_t").alias("tie"),
        "path",
        row,
        F.regexp_extract_all("_t", F.col("_k"), F.lit(0)).alias("_c"),
        F.split("_t", F.col("_k")).alias("_p"),
    )
    # Each candidate leaves with what it needs of the pieces around it; the text's arrays stay behind.
    one = lambda c, i: F.struct(
        c.alias("candidate"),
        F.length(F.get("_p", i)).alias("gap"),
        F.right(F.get("_p", i), F.lit(BEFORE)).alias("before"),
        F.left(F.get("_p", i + 1), F.lit(AFTER)).alias("after"),
    )
    df = df.select("doc_id", "tie", "path", "_row", F.posexplode(F.transform("_c", one)).alias("nth", "_o"))
    df = df.select("doc_id", "tie", "path", "_row", "nth", "_o.*")
    # What lies before a candidate: the gaps up to it and the candidates before it. Rows of one text at a time.
    upto = Window.partitionBy("_row").orderBy("nth").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap").cast("long") + F.length("candidate")).over(upto)
    return df.select(
        "doc_id", "tie", "nth", (end - F.length("candidate")).alias("start"), "candidate", "before", "after", "path"
    )


def dictionary(docs, words=DICTIONARY):
    """``(word, documents)`` of the lower-case letter words that most documents hold."""
    text = F.lower(F.regexp_replace(as_text(docs), r"[^A-Za-z]+", " "))
    each = docs.select(F.explode(F.array_distinct(F.split(text, " "))).alias("word"))
    each = each.where(F.length("word").between(3, 12))
    return each.groupBy("word").agg(F.count("*").alias("documents")).orderBy(F.desc("documents"), "word").limit(words)


def letter_pairs(words):
    """``(pair, pair_log)``: log share of every letter pair in the dictionary words, by use; 26 x 26 rows at most."""
    pair = F.explode(F.transform(F.sequence(F.lit(1), F.length("word") - 1), lambda i: F.substring("word", i, F.lit(2))))
    counted = words.select(pair.alias("pair"), "documents").groupBy("pair").agg(F.sum("documents").alias("n"))
    total = counted.agg(F.sum("n").alias("total"))
    total = (total.first()["total"] or 1) * 1.0
    return counted.select("pair", F.log(F.col("n") / total).alias("pair_log"))


# Log share of a pair that no dictionary word has.
UNKNOWN_PAIR = -14.0


def text_measures(found, words):
    """Measures of every distinct candidate text, which its hash stands for."""
    texts = found.select("candidate").distinct().withColumn("id", F.xxhash64("candidate"))
    chunks = F.regexp_extract_all(F.lower("candidate"), F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))
    body = lambda c, j: F.concat(c, F.left(F.coalesce(F.get("_x", j + 1), F.lit("")), F.lit(LONGEST_WORD - 1)))
    # A chunk of its own length, with what a word that starts in it may reach.
    own = F.transform("_x", lambda c, j: F.struct((j * CHUNK).alias("at"), F.length(c).alias("size"), body(c, j).alias("body")))
    rows = texts.select("id", chunks.alias("_x")).select("id", F.inline(own))
    place = F.explode(F.sequence(F.lit(1), F.col("size")))
    at = rows.select("id", "at", "body", place.alias("i"))
    pairs = at.where(F.col("i") < F.length("body")).select("id", F.substring("body", F.col("i"), F.lit(2)).alias("pair"))
    usual = (
        pairs.join(F.broadcast(letter_pairs(words)), "pair", "left")
        .groupBy("id")
        .agg(F.avg(F.coalesce("pair_log", F.lit(UNKNOWN_PAIR))).alias("pair_log"))
    )
    size = F.explode(F.sequence(F.lit(3), F.lit(LONGEST_WORD))).alias("k")
    parts = at.select("id", "at", "body", "i", size).where(F.col("i") + F.col("k") - 1 <= F.length("body"))
    parts = parts.select("id", (F.col("at") + F.col("i")).alias("from"), "k", F.substring("body", F.col("i"), F.col("k")).alias("word"))
    hits = parts.join(F.broadcast(words.select("word")), "word", "left_semi")
    # The longest word from each place, then the places that words cover, each once.
    hits = hits.groupBy("id", "from").agg(F.max("k").alias("k"))
    covered = hits.select("id", F.explode(F.sequence(F.col("from"), F.col("from") + F.col("k") - 1)).alias("place")).distinct()
    covered = covered.groupBy("id").agg(F.count("*").alias("covered"))
    joined = texts.join(usual, "id", "left").join(covered, "id", "left")
    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace("candidate", "[a-z]+", "a"), "[A-Z]+", "A"), "[0-9]+", "0")
    share = lambda chars: F.length(F.regexp_replace("candidate", f"[^{chars}]+", "")) / F.length("candidate")
    return joined.select(
        "candidate",
        F.length("candidate").alias("length"),
        (F.length(kinds) / F.length("candidate")).alias("class_changes"),
        share("0-9").alias("digits"),
        share("A-Z").alias("capitals"),
        (F.size(F.array_distinct(F.split("candidate", ""))) / F.length("candidate")).alias("distinct_share"),
        F.coalesce("pair_log", F.lit(UNKNOWN_PAIR)).alias("pair_log"),
        (F.coalesce("covered", F.lit(0)) / F.length("candidate")).alias("covered"),
    )


def measured(found, words):
    """Candidates with all features, as numbers."""
    flag = lambda condition: F.coalesce(condition, F.lit(False)).cast("double")
    near = F.concat_ws(" ", "before", "after")
    df = found.withColumns(
        {
            "named": flag(F.col("before").rlike(NAMES)),
            "assigned": flag(F.col("before").rlike(ASSIGNED)),
            "quoted": flag(F.col("before").rlike(QUOTED)),
            "address": flag(F.col("before").rlike(ADDRESS) & F.col("after").startswith("@")),
            "example_near": flag(near.rlike(EXAMPLES)),
            "plain_before": flag(F.col("before").rlike(r"[\p{L}.,]\s$")),
            "plain_after": flag(F.col("after").rlike(r"^[.,]?\s+\p{L}")),
            "path_example": flag(F.col("path").rlike(EXAMPLES)),
            "path_depth": F.size(F.split("path", "/")).cast("double"),
        }
    )
    df = df.join(text_measures(found, words), "candidate")
    return df.withColumns({c: F.col(c).cast("double") for c in FEATURES})


def labelled_findings(features):
    """Findings with a ``label`` where the candidate's own form decides it."""
    text = F.col("candidate")
    named = (F.col("named") == 1) & (F.col("assigned") == 1) & (F.col("digits") > 0) & (F.col("class_changes") > 0.2)
    secret = text.rlike(KNOWN_FORMAT) | ((named | (F.col("address") == 1)) & (F.col("example_near") == 0))
    plain = text.rlike(r"^[A-Za-z]?[a-z]+$|^[A-Z]+$|^[0-9]+$") & (F.col("named") == 0)
    return features.withColumn("label", F.when(secret, 1.0).when(plain, 0.0)).where("label is not null")


def forest(findings, sample=SAMPLE):
    """A random forest from at most ``sample`` labelled findings, half of each label; None without both."""
    half = sample // 2
    order = [F.xxhash64("candidate", "doc_id", "start"), "candidate", "doc_id", "start"]
    pick = lambda label: findings.where(F.col("label") == label).orderBy(*order).limit(half)
    chosen = stored(pick(1.0).unionByName(pick(0.0)).select("label", "candidate", "start", *FEATURES), "findings")
    if chosen.select("label").distinct().count() < 2:
        return None
    # One partition of a bounded sample, in one order: the same findings give the same forest.
    rows = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(chosen)
    rows = rows.coalesce(1).sortWithinPartitions("label", "candidate", "start", *FEATURES)
    return RandomForestClassifier(numTrees=32, maxDepth=6, seed=7, featureSubsetStrategy="sqrt").fit(rows)


def findings(docs, labelled=None, sample=SAMPLE):
    """Scored candidates of ``docs``: the columns of ``candidates`` with ``score`` and ``is_secret``.

    ``labelled``: findings with ``label`` (0 or 1) and the columns of ``candidates``; by default made from ``docs``.
    """
    words = stored(dictionary(docs), "dictionary")
    found = stored(candidates(docs), "candidates")
    features = stored(measured(found, words), "features")
    known = labelled_findings(features) if labelled is None else measured(labelled, words)
    model = forest(known, sample)
    if model is None:
        scored = features.withColumn("score", F.lit(1.0))
    else:
        rows = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(features)
        scored = model.transform(rows).withColumn("score", F.round(F.get(vector_to_array("probability"), F.lit(1)), 9))
    return scored.select(*found.columns, "score", (F.col("score") >= 0.5).alias("is_secret"))


def redacted(docs):
    """``docs`` with every secret replaced by a mask; all rows stay, and documents without one stay where they are."""
    found = findings(docs).where("is_secret")
    found = stored(found.groupBy("doc_id", "tie").agg(F.collect_set("nth").alias("_nths")), "secrets")
    rows = docs.select(F.struct(*docs.columns).alias("_row"), docs["doc_id"].alias("doc_id"), F.xxhash64(as_text(docs)).alias("tie"))
    # Only documents that may have a secret meet them and are matched again.
    maybe, rest = split_by_filter(rows, ["doc_id", "tie"], found, found.count())
    found = found.select(F.col("doc_id").alias("_found_id"), F.col("tie").alias("_found_tie"), "_nths")
    match = F.col("doc_id").eqNullSafe(F.col("_found_id")) & (F.col("tie") == F.col("_found_tie"))
    joined = maybe.join(found, match, "left")
    masked = F.transform(
        F.regexp_extract_all("_row.text", F.lit(CANDIDATE), F.lit(0)),
        lambda c, i: F.when(F.array_contains("_nths", i), F.lit(MASK)).otherwise(c),
    )
    joined = joined.withColumn("_masked", F.when(F.col("_nths").isNotNull(), masked))
    whole = F.transform(
        F.split("_row.text", CANDIDATE), lambda p, i: F.concat(p, F.coalesce(F.get("_masked", i), F.lit("")))
    )
    changed = {"text": F.when(F.col("_nths").isNotNull(), F.array_join(whole, "")).otherwise(F.col("_row.text"))}
    if "n_chars" in docs.columns:
        size = F.length(changed["text"]).cast(docs.schema["n_chars"].dataType)
        changed["n_chars"] = F.when(F.col("_nths").isNotNull(), size).otherwise(F.col("_row.n_chars"))
    joined = joined.select(*[changed.get(c, F.col("_row")[c]).alias(c) for c in docs.columns])
    return joined.unionByName(rest.select("_row.*"))


def op2_secret_scan(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    return findings(docs).select("doc_id", "start", F.length("candidate").cast("long").alias("length"), "score", "is_secret")
