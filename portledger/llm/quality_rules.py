"""Quality rules with thresholds learnt from the data, in DataFrame operations only.

Fixed cutoffs are replaced by fences above the middle half of each (language, source): the upper quartile and some times the
distance of the quartiles. Every measure is one that ordinary documents have some of, so its quartiles differ. The
quantiles come from mergeable sketches: every measure is put into log-linear integer buckets (exact
below 128, then 64 buckets for each power of two, so a value is known to 1/64), and a sketch is the
table of bucket counts. Sketches merge by adding counts: partial counts of tasks into a source,
sources into a language, languages into the whole. A source with few documents borrows the sketch of
its language, a language with few that of all.

Two passes read the text: the first one for the cheap measures of the sketches, the second one for
all measures and the verdict. No text is shuffled.

Null or empty text: no words, so it fails the base rules. A null language or source is a group of
its own. Repeated rows count each. Columns of the input with a result's name are replaced.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from portledger.llm.common import as_text, small_side, stored

# Words, symbols and base rules.
GAPS = "\t\n\x0b\x0c\r"
HAS_WORD = r"[^\x20\x09-\x0D]"
NOT_SYMBOLS = r"[^#*$%&|<>]+"
WINDOW = 8
LEAST_WORDS = 20
REPEAT_PERCENT = 30

# A measure is rejected above its group's upper quartile + SPREADS x interquartile range. Where nearly all documents of a group
# agree, the range is taken as this least one, a rounding error of the measure: ten-thousandths of the word
# characters or words, hundredths of a character.
SPREADS = 4
ROUNDING = {"marks": 25, "capitals": 25, "stutters": 25, "word_length": 8}
# A sketch of fewer documents is replaced by the one above it.
LEAST_DOCUMENTS = 200

RESULT = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
RESULT += [f"m_{m}" for m in ROUNDING]


def bucketed(name):
    """Lower end of the log-linear bucket of the column's value (bigint)."""
    shift = f"(length(bin({name})) - 7)"
    return F.expr(f"case when {name} < 128 then {name} else shiftleft(shiftright({name}, {shift}), {shift}) end")


def with_measures(docs):
    """``docs`` with its words joined by single spaces (``_w``) and the cheap counts."""
    df = docs.withColumn("_t", as_text(docs))
    spaced = F.col("_t")
    for gap in GAPS:
        spaced = F.replace(spaced, F.lit(gap), F.lit(" "))
    df = df.withColumn("_w", F.trim(F.regexp_replace(spaced, "  +", " "))).withColumn(
        "_l", F.filter(F.split("_t", "\n"), lambda line: line.rlike(HAS_WORD))
    )
    together = F.replace(F.col("_w"), F.lit(" "), F.lit(""))
    df = df.withColumns(
        {
            "word_chars": F.length(together).cast("bigint"),
            "n_words": F.when(F.col("_w") == "", 0).otherwise(F.length("_w") - F.length(together) + 1).cast("bigint"),
            "n_symbols": F.length(F.regexp_replace("_t", NOT_SYMBOLS, "")).cast("bigint"),
            "n_dup_lines": (F.size("_l") - F.size(F.array_distinct("_l"))).cast("bigint"),
            "n_marks": F.length(F.regexp_replace("_w", r"[\p{L}\p{N} ]+", "")).cast("bigint"),
            "n_capitals": F.length(F.regexp_replace("_w", r"[^\p{Lu}]+", "")).cast("bigint"),
            "n_stutters": F.regexp_count("_w", F.lit(r"(?<![^ ])([^ ]++) (?=\1(?: |$))")).cast("bigint"),
        }
    )
    per = lambda count, of, unit: F.expr(f"case when {of} > 0 then {count} * {unit} div {of} else 0L end")
    return df.withColumns(
        {
            "m_marks": per("n_marks", "word_chars", 10000),
            "m_capitals": per("n_capitals", "word_chars", 10000),
            "m_stutters": per("n_stutters", "n_words", 10000),
            "m_word_length": per("word_chars", "n_words", 100),
            "_lang": F.coalesce(F.col("lang").cast("string"), F.lit("\x00")),
            "_source": F.coalesce(F.col("source").cast("string"), F.lit("\x00")),
        }
    ).drop("_t", "_l")


def sketches(docs):
    """Bucket counts ``(_lang, _source, measure, bucket, n)``: one mergeable sketch per group and measure."""
    pairs = [
        F.struct(F.lit(m).alias("measure"), bucketed(f"m_{m}").alias("bucket")) for m in ROUNDING
    ]
    rows = with_measures(docs).select("_lang", "_source", F.inline(F.array(*pairs)))
    return rows.groupBy("_lang", "_source", "measure", "bucket").agg(F.count("*").alias("n"))


def merged(sketch, keys):
    return sketch.groupBy(*keys, "measure", "bucket").agg(F.sum("n").alias("n"))


def quartiles(sketch, keys):
    """``low`` and ``high`` quartile of every measure per group of ``keys``, as bucket ends, and the group's size ``total``."""
    group = [*keys, "measure"]
    upto = Window.partitionBy(*group).orderBy("bucket")
    whole = Window.partitionBy(*group)
    ranked = sketch.withColumns({"c": F.sum("n").over(upto), "total": F.sum("n").over(whole)})
    quantile = lambda num, den: F.min(F.when(F.col("c") * den >= F.col("total") * num, F.col("bucket")))
    return ranked.groupBy(*group).agg(quantile(1, 4).alias("low"), quantile(3, 4).alias("high"), F.max("total").alias("total"))


def fences(sketch, keys):
    """Upper fence of every measure per group of ``keys``, as a map, and the group's size."""
    least = F.create_map(*[x for m, s in ROUNDING.items() for x in (F.lit(m), F.lit(s).cast("bigint"))])
    spread = F.greatest(F.col("high") - F.col("low"), least[F.col("measure")])
    # A bucket is known by its lower end; its values reach a 64th further.
    fence = F.col("high") + F.expr("high div 64") + SPREADS * spread
    return quartiles(sketch, keys).groupBy(*keys).agg(
        F.map_from_entries(F.collect_list(F.struct("measure", fence.alias("fence")))).alias("fence"),
        F.max("total").alias("total"),
    )


def thresholds(docs):
    """``(_lang, _source, _fence)``: each source's own fences, or its language's, or everyone's."""
    # Written once: the text is read for the sketches once, and merging works on bucket counts.
    own = stored(sketches(docs), "sketches")
    by_source = fences(own, ["_lang", "_source"])
    by_lang = fences(merged(own, ["_lang"]), ["_lang"]).select(
        "_lang", F.col("fence").alias("lang_fence"), F.col("total").alias("lang_total")
    )
    overall = fences(merged(own, []), []).first()["fence"] or {}
    everyone = F.create_map(*[x for m in ROUNDING for x in (F.lit(m), F.lit(overall.get(m)).cast("bigint"))])
    enough = lambda c: F.col(c) >= LEAST_DOCUMENTS
    cuts = by_source.join(by_lang, "_lang").select(
        "_lang",
        "_source",
        F.when(enough("total"), F.col("fence"))
        .when(enough("lang_total"), F.col("lang_fence"))
        .otherwise(everyone)
        .alias("_fence"),
    )
    return stored(cuts, "fences")


def with_repeats(df):
    """Adds ``n_repeat_words``: words in word windows that occur twice or more in their text.

    Window digests are made by doubling: pairs of words, fours, eights. Only texts in which two fours are equal go on to eights, and
    the few in which two of these are equal go on to compare the windows themselves.
    """
    after = lambda c, k: F.slice(c, k + 1, F.greatest(F.size(c) - k, F.lit(0)))
    doubled = lambda c, k: F.zip_with(c, after(c, k), lambda a, b: F.xxhash64(a, b))
    df = df.withColumn("_m", F.split("_w", " "))
    for k in (1, 2):
        df = df.withColumn("_m", doubled("_m", k))
    df = df.withColumn("_m", F.when(F.size(F.array_distinct("_m")) < F.size("_m"), F.col("_m"))).withColumn("_m", doubled("_m", 4))
    df = df.withColumn("_m", F.slice("_m", 1, F.greatest(F.size("_m") - (WINDOW - 1), F.lit(0))))
    df = df.withColumn("_r", F.when(F.size(F.array_distinct("_m")) < F.size("_m"), F.split("_w", " "))).drop("_m")
    window = lambda i: F.struct(F.array_join(F.slice("_r", i, WINDOW), " ").alias("w"), i.alias("i"))
    df = df.withColumn("_s", F.array_sort(F.transform(F.sequence(F.lit(1), F.size("_r") - (WINDOW - 1)), window)))
    same = lambda x, j: x["w"].eqNullSafe(F.get("_s", j)["w"])
    places = F.transform("_s", lambda x, j: F.when(same(x, j - 1) | same(x, j + 1), x["i"]))
    df = df.withColumn("_p", F.array_sort(F.array_compact(places)))
    width = lambda p, j: F.least(F.lit(WINDOW), F.coalesce(F.get("_p", j + 1) - p, F.lit(WINDOW)))
    covered = F.aggregate(F.transform("_p", width), F.lit(0), lambda total, x: total + x)
    return df.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("bigint"))


def _judged(docs, limits=None):
    """``_row`` (the document's own columns), the counts, ``base_failed``, ``kept`` and the measures."""
    docs = docs.select(F.struct(*docs.columns).alias("_row"), "text", "lang", "source")
    limits = small_side(thresholds(docs) if limits is None else limits)
    # The join carries no window arrays, and the counts are made after it: only it may move rows.
    df = with_repeats(with_measures(docs).join(limits, ["_lang", "_source"], "left"))
    failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words")
    )
    inside = F.lit(True)
    for m in ROUNDING:
        inside = inside & (F.col(f"m_{m}") <= F.coalesce(F.col("_fence")[m], F.lit(2**62)))
    df = df.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & inside)
    return df.select("_row", *RESULT)


def judged(docs, limits=None):
    """``docs`` with the counts and the verdict; ``limits`` defaults to thresholds of its own."""
    own = [F.col("_row")[c].alias(c) for c in docs.columns if c not in RESULT]
    return _judged(docs, limits).select(*own, *RESULT)


def kept_documents(docs):
    """The documents that pass, with their own columns."""
    # A filter on the verdict alone would be pushed down into the projections, which repeats the measures'
    # nested expressions many times over; it may not pass a column that depends on the partition.
    held = _judged(docs).withColumn("_part", F.spark_partition_id())
    return held.where(F.col("kept") & (F.col("_part") >= 0)).select("_row.*")


def op7_quality_rules(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source")
    return judged(docs).select("doc_id", *RESULT)
