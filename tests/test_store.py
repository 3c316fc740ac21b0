"""The record store: commits, keys, reports and upkeep."""

import os
import random

import pytest
from pyspark.sql import functions as F

from portledger.operators import dedup
from portledger.operators.lookup import Translations
from portledger.plans import marts, records
from portledger.plans.ingest import ingest
from portledger.sources.store import RecordStore

FIELDS = "src_file string, row_idx int, date string, importer_ko string, importer_en string, product_ko string, year string, month string, type_frozen boolean"


def rows_of(n, file, seed=1, keys=400):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        year = rng.choice(["2019", "2020", "", "x"])
        date = f"{year}-0{rng.randrange(1, 10)}-11" if year.isdigit() else year
        ko = rng.choice(["", f"회사{rng.randrange(30)}"])
        out.append((file, i, date, ko, rng.choice(["", f"EN{rng.randrange(40)}"]), f"p{rng.randrange(keys)}", year, str(rng.randrange(13)), rng.random() < 0.5))
    return out


@pytest.fixture
def store(spark, tmp_path):
    return RecordStore(spark, str(tmp_path / "store"))


def add(store, n, file, batch_id, seed):
    return store.append(store.spark.createDataFrame(rows_of(n, file, seed), FIELDS), batch_id)


def content(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_nothing_counts_before_the_commit(store):
    """A run killed midway shows nothing, and its repeat reports what it would have reported."""
    batch = store.spark.createDataFrame(rows_of(300, "a"), FIELDS)
    number = store.begin()
    written = store.append(batch, "b1", pub=number).count()
    assert written > 0 and store.records().isEmpty() and store.keys().isEmpty() and store.ledger().isEmpty()
    assert add(store, 300, "a", "b1", 1).count() == written
    assert store.records().count() == store.keys().count() == written
    assert add(store, 300, "a", "b2", 1).isEmpty()
    store.vacuum()
    assert store.records().count() == written and len(os.listdir(f"{store.root}/records")) >= 2
    assert f"pub={number}" not in os.listdir(f"{store.root}/records")


def test_a_run_that_stops_before_its_ledger_repeats_with_right_counters(store, tmp_path, monkeypatch):
    spark = store.spark
    listing = spark.createDataFrame([("f1", 5), ("f2", 5)], "path string, length long").withColumn("modification_time", F.lit("2020-01-01").cast("timestamp"))
    status = spark.createDataFrame([("f1", -1), ("f2", -1)], "src_file string, row_idx int").withColumn("message", F.lit(None).cast("string"))
    rows = spark.createDataFrame(rows_of(200, "f1", 1) + rows_of(200, "f2", 2), FIELDS)
    decoded = lambda listed: rows.unionByName(status, allowMissingColumns=True)
    whole = RecordStore(spark, str(tmp_path / "whole"))
    want = content(ingest(decoded, listing, whole, "b").select("path", "status", "parsed", "written", "skipped"))

    def killed(*args):
        raise RuntimeError("killed")

    with monkeypatch.context() as patched:
        patched.setattr(RecordStore, "write_ledger", killed)
        with pytest.raises(RuntimeError):
            ingest(decoded, listing, store, "b")
    assert store.records().isEmpty() and store.ledger().isEmpty()
    assert content(ingest(decoded, listing, store, "b").select("path", "status", "parsed", "written", "skipped")) == want
    assert content(store.records().drop("src_file")) == content(whole.records().drop("src_file"))


def test_keys_are_joined_without_an_exchange(store, monkeypatch):
    add(store, 400, "a", "b1", 1)
    add(store, 400, "b", "b2", 2)
    plans = []
    pinned = dedup.pinned
    planned = lambda df: df._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(dedup, "pinned", lambda df: plans.append(planned(df)) or pinned(df))
    monkeypatch.setattr(dedup, "is_small", lambda measured: False)
    store.spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        batch = store.spark.createDataFrame(rows_of(400, "c", 3), FIELDS)
        got = store.fresh(batch).count()
        plan = plans[-1]
    finally:
        store.spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    seen = {tuple(k) for k in store.records().select("date", "importer_ko", "product_ko").collect()}
    assert got == len({(r[2], r[3], r[5]) for r in rows_of(400, "c", 3)} - seen)
    stored = plan[plan.index("SortMergeJoin") :]
    assert "Bucketed: true" in stored and "SelectedBucketsCount" in stored
    # One exchange, that of the batch; the stored side and its filter need none.
    assert stored.count("Exchange hashpartitioning(_k0") == 1


def test_reports_follow_appends_and_read_new_publications_only(store, monkeypatch):
    def rebuilt():
        records, order = store.published(), ["seq", "src_file", "row_idx"]
        counts = marts.tally(records)
        ranked = marts.importer_ranking(marts.importer_totals(records, order=order))
        return {
            "monthly_by_type": content(marts.monthly_by_type(counts)),
            "yearly_by_country": content(marts.yearly_by_country(counts)),
            "type_country_pivot": content(marts.type_country_pivot(counts)),
            "importers": content(ranked),
        }

    marts.refresh_reports(store)
    assert store.report("monthly_by_type").isEmpty() and store.report("type_country_pivot").count() == 4
    read = []
    published = RecordStore.published
    for i in range(3):
        add(store, 200, f"f{i}", f"b{i}", i + 1)
        if i == 1:
            store.compact()
        with monkeypatch.context() as patched:
            patched.setattr(RecordStore, "published", lambda self, pubs=None: read.append(pubs) or published(self, pubs))
            marts.refresh_reports(store)
        assert {name: content(store.report(name)) for name in rebuilt()} == rebuilt()
    # The first and the last refresh read one publication each; the compacted one holds the second append.
    assert [len(p) for p in read] == [1, 1, 1]
    marts.refresh_reports(store)
    assert len(read) == 3 and {name: content(store.report(name)) for name in rebuilt()} == rebuilt()


def test_a_reader_never_misses_a_report(store, monkeypatch):
    add(store, 100, "a", "b1", 1)
    marts.refresh_reports(store)
    before = content(store.report("importers"))
    add(store, 100, "b", "b2", 2)
    held = store.report("importers")

    def killed(*args):
        raise RuntimeError("killed")

    with monkeypatch.context() as patched:
        patched.setattr(marts, "importer_ranking", killed)
        with pytest.raises(RuntimeError):
            marts.refresh_reports(store)
    assert content(store.report("importers")) == before
    marts.refresh_reports(store)
    # What was opened before can still be read.
    assert content(held) == before and content(store.report("importers")) != before


def test_compaction_changes_no_record_and_no_report(store):
    for i in range(4):
        add(store, 120, f"f{i}", f"b{i}", i + 1)
    marts.refresh_reports(store)
    reports = ("monthly_by_type", "yearly_by_country", "type_country_pivot", "importers")
    before = [content(store.published()), content(store.keys()), *[content(store.report(r)) for r in reports]]
    number = store.compact()
    assert store.commits() == [number]
    marts.refresh_reports(store)
    after = [content(store.published()), content(store.keys()), *[content(store.report(r)) for r in reports]]
    assert after == before
    store.vacuum()
    assert content(store.published()) == before[0] and os.listdir(f"{store.root}/records").count(f"pub={number}") == 1
    assert add(store, 120, "f0", "again", 1).isEmpty()
    assert store.compact() is not None and store.compact() is None


def test_a_store_keeps_its_buckets(store):
    add(store, 50, "a", "b1", 1)
    other = RecordStore(store.spark, store.root, buckets=7)
    assert other.keys().count() == store.keys().count() and other._bucket_count() == store._bucket_count()


def test_first_seen_is_a_plain_minimum(spark):
    df = spark.createDataFrame(rows_of(200, "a"), FIELDS).withColumn("seq", F.lit(1))
    for order in (["row_idx"], ["src_file", "row_idx"], ["seq", "src_file", "row_idx"]):
        tallied = marts.importer_tally(df, order)
        for plan in (tallied, marts.importer_totals_of(marts.merged_importers(tallied))):
            text = plan._jdf.queryExecution().executedPlan().toString()
            assert "SortAggregate" not in text


def test_first_names_by_publication_file_and_row(spark):
    rows = []
    for seq, file, row, en in [(2, "a", 1, "late"), (1, "b", 7, "third"), (1, "a", 9, "second"), (1, "a", 2, "first"), (1, "a", 1, "no year")]:
        rows.append((seq, file, row, "회사", en, "" if en == "no year" else "2020"))
    df = spark.createDataFrame(rows, "seq long, src_file string, row_idx int, importer_ko string, importer_en string, year string")
    totals = marts.importer_totals(df, order=["seq", "src_file", "row_idx"]).collect()
    assert [(r["importer_en"], r["total"]) for r in totals] == [("first", 4)]
    # Tallies of parts, each ranked on its own, give the same.
    parts = [marts.importer_tally(df.where(f"seq = {i}"), ["seq", "src_file", "row_idx"]) for i in (2, 1)]
    merged = marts.importer_totals_of(marts.merged_importers(parts[0].unionByName(parts[1]))).collect()
    assert [(r["importer_en"], r["total"]) for r in merged] == [("first", 4)]


def test_names_beyond_the_broadcast_take_one_pass(spark):
    """Rows are made once, and the lookup is reduced to the names they hold."""
    table = [(c, f"k{i}", f"{c} {i}") for c in ("importer", "product_type", "country") for i in range(200)]
    table = spark.createDataFrame(table, "category string, key string, value string")
    names = Translations(table, max_rows=50)
    assert not names.all_fit(["importer"])
    fields = {"importer_ko": "k1", "product_type_ko": " k2 ", "country_export_ko": "k3", "country_origin_ko": "unknown"}
    made = spark.sparkContext.accumulator(0)
    df = spark.range(300).select(F.lit("f").alias("src_file"), F.col("id").cast("int").alias("row_idx"))
    df = df.withColumns({c: F.lit(v) for c, v in fields.items()})
    rest = [c for c in records.WEEKLY_COLUMNS if c not in fields and c not in records.TRANSLATED]
    df = df.withColumns({c: F.lit("").alias(c) for c in rest})
    counted = df.rdd.map(lambda r: made.add(1) or r).toDF(df.schema)
    out = records.translated(counted, names)
    got = out.select(*records.TRANSLATED).distinct().collect()
    assert [r.asDict() for r in got] == [{"importer_en": "importer 1", "product_type_en": "product_type 2", "country_export_en": "country 3", "country_origin_en": "unknown"}]
    assert out.count() == 300 and made.value == 300
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 4 and "Window" not in plan
