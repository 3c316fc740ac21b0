"""Odd tables through every operator and the whole pipeline: empty, nulls, ties, very long texts, clashing columns."""

import collections
import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from portledger.llm import bpe, compression_classifier, license_scan, line_dedup, ngram_join, packing, quality_rules, secret_scan, suffix_dedup

SF_DIR = "/root/testdata/sf0.001"
CLASHES = ["_dropped_id", "_id", "_row", "_text", "_t", "tie", "doc", "node", "n", "kept", "score", "grp", "repeats", "key"]


def odd_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").where("doc_id < 40")
    rows = [
        (None, None, None, None, None),
        (None, "a null id and a text of some words that is not the same as any other text " * 3, "en", "s", 5),
        (900, None, "en", "s", 0),
        (901, "", "en", None, 0),
        (902, " \n\t ", None, "s", 4),
        (3, "an id that is there twice, once with this text of several words and no more than that", "en", "s", 9),
        (903, "x" * 2_000_000, "en", "s", 2_000_000),
        (904, "ab1 " * 500_000, "en", "s", 2_000_000),
        (905, "\n".join(f"line {i} of a long text, which differs in its number {i * 7919}" for i in range(30_000)), "de", "s", 1),
    ]
    odd = spark.createDataFrame(rows, docs.schema)
    both = docs.unionByName(odd).unionByName(odd.where("doc_id = 902")).unionByName(docs.where("doc_id < 5"))
    return both.withColumns({c: F.lit("own") for c in CLASHES}).repartition(4)


OPERATORS = {
    "ngram_join": lambda d: ngram_join.one_of_each(d),
    "secret_scan": lambda d: secret_scan.redacted(d),
    "suffix_dedup": lambda d: suffix_dedup.document_removals(d.where("length(text) < 100000 or text is null")),
    "bpe": lambda d: bpe.document_digests(d),
    "quality_rules": lambda d: quality_rules.judged(d),
    "packing": lambda d: packing.packed_documents(d),
    "line_dedup": lambda d: line_dedup.deduplicated(d),
    "license_scan": lambda d: license_scan.license_units(d),
}


@pytest.mark.parametrize("name", list(OPERATORS))
def test_operators_take_odd_tables(spark, name):
    docs = odd_documents(spark)
    out = OPERATORS[name](docs)
    n = out.count()
    if name in ("secret_scan", "suffix_dedup", "bpe", "quality_rules"):
        assert n == docs.count() - (3 if name == "suffix_dedup" else 0)
    assert OPERATORS[name](docs.where("false")).count() == 0


def test_pipeline_takes_odd_tables(spark, tmp_path):
    docs = odd_documents(spark)
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        path = str(tmp_path / name)
        stage(spark, docs, SF_DIR).write.parquet(path)
        after = spark.read.parquet(path)
        assert after.columns == columns and after.count() > 0
        docs = after
    assert {r["_dropped_id"] for r in docs.select("_dropped_id").distinct().collect()} == {"own"}
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR)
    assert {r["doc_id"] for r in packed.collect()} == {r["doc_id"] for r in docs.collect()}


def test_pipeline_takes_an_empty_table(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").where("false")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_classifier_takes_very_long_texts(spark):
    rng = random.Random(2)
    good, bad = ["the river ran past the mill", "rain fell over the fields"], ["CLICK!!! $$$ win", "buy*** cheap###"]
    rows = [(i, " ".join(rng.choice(good if i % 2 else bad) for _ in range(20))) for i in range(300)]
    docs = spark.createDataFrame([*rows, (1_000, "x" * 2_000_000), (1_001, " ".join(good) * 40_000)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(300)], "doc_id long, quality int, toxic int")
    out = {r["doc_id"]: r["score"] for r in compression_classifier.scored(docs, labels).collect()}
    assert len(out) == 302 and all(0 <= s <= 1 for s in out.values()) and out[1_001] > 0.5


def test_line_marks_against_brute_force(spark):
    """Which lines repeat, and how much of a document one other has first: lines too unlike to be near each other."""
    rng = random.Random(3)
    base = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(rng.randrange(45, 90))) + "z" for _ in range(40)]
    rows = [(i, "\n".join(rng.choice(base) for _ in range(rng.randrange(1, 9)))) for i in range(80)] + [(500, None), (501, "")]
    first, want = {}, {}
    for d, t in rows:
        lines = (t or "").split("\n")
        repeats, copied = [], collections.Counter()
        for n, x in enumerate(lines):
            if x not in first:
                if x:
                    first[x] = d
                continue
            repeats.append(n)
            if first[x] != d:
                copied[first[x]] += len(x)
        whole = len(t or "")
        most = max(copied.values(), default=0)
        want[d] = (len(lines), len(repeats), sum(len(lines[n]) for n in repeats), bool(repeats) and 2 * most >= whole, repeats)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    marks = {r["doc"]: r for r in line_dedup.marked(docs).collect()}
    for d, (_, n, chars, is_copy, repeats) in want.items():
        r = marks.get(d)
        assert (r is None) == (n == 0)
        if r:
            whole = len(dict(rows)[d])
            assert (r["repeats"], r["repeated_chars"], 2 * r["copied_chars"] >= whole) == (repeats, chars, is_copy)


def test_line_dedup_query_against_its_marks(spark):
    rows = entry.queries()["op9_line_dedup"](spark, SF_DIR).collect()
    text = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    assert sorted(r["doc_id"] for r in rows) == sorted(text)
    for r in rows:
        lines = text[r["doc_id"]].split("\n")
        assert r["n_lines"] == len(lines) and r["n_repeats"] == len(r["repeats"])
        assert r["repeated_chars"] == sum(len(lines[n]) for n in r["repeats"])
        # Every exact repeat of an earlier document's line is marked.
    first = {}
    for d in sorted(text):
        for n, x in enumerate(text[d].split("\n")):
            if any(c.isalnum() for c in x):
                first.setdefault(x, (d, n))
    marked = {(r["doc_id"], n) for r in rows for n in r["repeats"]}
    exact = {(d, n) for d in text for n, x in enumerate(text[d].split("\n")) if x in first and first[x] < (d, n)}
    assert exact <= marked


def test_working_tables_are_dropped(spark, tmp_path):
    """What a run leaves in the shared folder are checkpoints, which Spark removes with their last reference."""
    import os

    from portledger.session import checkpoint_root

    root = checkpoint_root(spark).removeprefix("file:")
    names = lambda: {n for n in os.listdir(root) if n.split("-")[0] in ("ngram", "line", "token", "merkle", "vector")}
    before = names()
    for name in ("op1_ngram_jaccard_join", "op9_line_dedup", "op11_token_counts", "op12_merkle_manifest", "op13_vector_codes"):
        assert entry.queries()[name](spark, SF_DIR).count() > 0
    assert names() == before
