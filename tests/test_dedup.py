import random

import pytest
from pyspark.sql import functions as F

from portledger.operators import dedup
from portledger.operators.ranking import with_global_rank

SCHEMA = "src_file string, row_idx int, date string, importer_ko string, product_ko string, note string"


def batch(spark, n=4000, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        # A third of the rows share one key, the one with blank fields.
        key = ("", "", "") if rng.random() < 0.34 else (f"2020-01-{rng.randrange(9)}", f" i{rng.randrange(30)}", f"p{rng.randrange(9)} ")
        rows.append((f"f{rng.randrange(5)}", i, *key, f"n{i}"))
    return rows


def key(r):
    return tuple(v.strip() for v in r[2:5])


def first_wins(rows, seen=()):
    seen, out = set(seen), []
    for r in sorted(rows):
        if key(r) not in seen:
            seen.add(key(r))
            out.append(r)
    return out


def test_first_row_in_file_then_row_order_wins(spark):
    rows = batch(spark)
    got = dedup.dedup_first_wins(spark.createDataFrame(rows, SCHEMA).repartition(7))
    assert sorted(tuple(r) for r in got.collect()) == first_wins(rows)


@pytest.mark.parametrize("keys_fit", [True, False, None])
def test_only_unseen_keys_are_new(spark, keys_fit):
    rows = batch(spark)
    # Stored rows repeat keys too; a third of them is the blank key.
    stored = batch(spark, 900, seed=2)
    df, old = (spark.createDataFrame(r, SCHEMA).repartition(5) for r in (rows, stored))
    got = dedup.new_records(df, old, keys_fit=keys_fit)
    assert sorted(tuple(r) for r in got.collect()) == first_wins(rows, map(key, stored))
    assert dedup.new_records(df, df, keys_fit=keys_fit).isEmpty()


def test_null_key_field_is_the_empty_text(spark):
    df = spark.createDataFrame([("a", 1, None, "i", "p", ""), ("a", 2, "", "i", " p", "")], SCHEMA)
    assert [r["row_idx"] for r in dedup.dedup_first_wins(df).collect()] == [1]


def test_key_is_a_parameter(spark):
    df = spark.createDataFrame(batch(spark, 200), SCHEMA)
    assert dedup.dedup_first_wins(df, key=["note"]).count() == 200
    assert dedup.dedup_first_wins(df, key=["src_file"]).count() == 5


def test_hot_keys_are_trimmed_before_the_shuffle(spark):
    df = spark.createDataFrame(batch(spark, 100), SCHEMA)
    firsts, _ = dedup.first_lineage(df)
    plan = firsts._jdf.queryExecution().sparkPlan().toString()
    physical = firsts._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert physical.index("Final") < physical.index("Exchange") < physical.index("Partial")


def test_only_key_and_lineage_are_shuffled(spark, tmp_path):
    spark.createDataFrame(batch(spark, 500), SCHEMA).write.parquet(str(tmp_path / "batch"))
    df = spark.read.parquet(str(tmp_path / "batch"))
    firsts, _ = dedup.first_lineage(df)
    plan = firsts._jdf.queryExecution().executedPlan().toString()
    assert "note" not in plan and "ReadSchema: struct<src_file:string,row_idx:int,date:string,importer_ko:string,product_ko:string>" in plan
    # The rows themselves are picked where they are read.
    out = dedup.dedup_first_wins(df)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "note" in plan and "LeftSemi" in plan and "SortMergeJoin" not in plan and "Window" not in plan
    scan = plan[: plan.index("BroadcastExchange")]
    assert "hashpartitioning" not in scan


@pytest.mark.parametrize("fits", [True, False])
def test_rows_at_picks_by_lineage(spark, monkeypatch, fits):
    if not fits:
        monkeypatch.setattr(dedup, "fits_broadcast", lambda df: False)
    rows = [(f"f{i % 3}", i, "d", "i", "p", "n") for i in [*range(300), 4095, 4096, 70_000, 2**31 - 1]]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    kept = [r for r in rows if r[1] % 7 == 0 or r[1] > 4000]
    got = dedup.rows_at(df, spark.createDataFrame(kept, SCHEMA).select("src_file", "row_idx"))
    assert sorted(map(tuple, got.collect())) == sorted(kept) and got.columns == df.columns
    assert dedup.rows_at(df, df.where("false")).isEmpty()


def test_marks_are_one_row_for_64_positions(spark):
    df = spark.createDataFrame([("f", i) for i in range(640)], "src_file string, row_idx int")
    marks = dedup.lineage_marks(df).collect()
    assert len(marks) == 10 and all(r["_bits"] == -1 for r in marks)


def test_filter_lets_its_keys_through_and_few_others(spark):
    inside = spark.range(40_000).selectExpr("cast(id as string) a", "'x' b")
    outside = spark.range(100_000, 500_000).selectExpr("cast(id as string) a", "'x' b")
    blocks = dedup.filter_blocks(40_000)
    whole = dedup.key_filter(inside, ["a", "b"], blocks)
    assert dedup.probable(inside, ["a", "b"], blocks, whole).count() == 40_000
    assert dedup.probable(outside, ["a", "b"], blocks, whole).count() < 0.02 * 400_000
    # Filters of parts merge into the filter of the whole.
    parts = [dedup.key_filter(inside.where(f"a % 3 = {i}"), ["a", "b"], blocks) for i in range(3)]
    assert sorted(map(tuple, dedup.merged_filters(*parts).collect())) == sorted(map(tuple, whole.collect()))
    maybe, rest = dedup.split_by_filter(outside.union(inside), ["a", "b"], inside, 40_000)
    assert maybe.count() + rest.count() == 440_000 and rest.join(inside, ["a", "b"]).isEmpty()


def test_stored_side_is_filtered_beyond_the_broadcast(spark, tmp_path):
    """Only stored keys that the filter may hold are shuffled; those that pass by chance do not count."""
    schema = "src_file string, row_idx int, date string, importer_ko string, product_ko string"
    row = lambda i, f: (f, i, f"d{i}", "i", "p")
    df = spark.createDataFrame([row(i, "b") for i in range(3_000)], schema)
    stored = spark.createDataFrame([row(i, "s") for i in range(2_000, 60_000)], schema)
    got = dedup.fresh_lineage(df, stored, keys_fit=False)
    assert {r["row_idx"] for r in got.collect()} == set(range(2_000))
    firsts, names = dedup.first_lineage(df)
    keys = firsts.select(*names)
    stored_keys = stored.selectExpr("date _k0", "importer_ko _k1", "product_ko _k2")
    blocks = dedup.filter_blocks(3_000)
    passed = dedup.probable(stored_keys, names, blocks, dedup.key_filter(keys, names, blocks)).count()
    assert 1_000 <= passed < 2_500


def test_stored_side_is_not_shuffled_when_the_batch_is_small(spark, tmp_path, monkeypatch):
    spark.createDataFrame(batch(spark, 500), SCHEMA).write.parquet(str(tmp_path / "old"))
    old = spark.read.parquet(str(tmp_path / "old"))
    plans = []
    monkeypatch.setattr(dedup, "pinned", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or df)
    dedup.new_records(spark.createDataFrame(batch(spark, 50), SCHEMA), old, keys_fit=True)
    plan = plans[-1]
    assert "LeftSemi" in plan and "LeftAnti" in plan and "SortMergeJoin" not in plan
    # Only the three key columns of the stored table are read.
    assert "ReadSchema: struct<date:string,importer_ko:string,product_ko:string>" in plan


def test_counters(spark):
    rows = spark.createDataFrame([("a", i, str(i % 3), "i", "p", "") for i in range(10)], SCHEMA)
    files = spark.createDataFrame([("a", None), ("b", "broken"), ("c", None)], "src_file string, message string")
    counted = dedup.ingest_counters(files, rows, dedup.dedup_first_wins(rows))
    got = {r["src_file"]: tuple(r)[1:] for r in counted.collect()}
    assert got == {"a": (10, 3, 7, 0, None), "b": (0, 0, 0, 1, "broken"), "c": (0, 0, 0, 0, None)}
    totals = {r["src_file"]: tuple(r)[1:] for r in dedup.counter_totals(counted).collect()}
    assert totals[None] == (3, 7, 1) and totals["a"] == (3, 7, 0)


def test_global_rank_equals_a_sort(spark):
    rng = random.Random(5)
    rows = [(rng.randrange(50), f"n{rng.randrange(20)}", i) for i in range(5000)]
    df = spark.createDataFrame(rows, "total int, name string, seq int").repartition(6)
    ranked = with_global_rank(df, [F.desc("total"), F.asc("name"), F.asc("seq")])
    got = [(r["rank"], r["total"], r["name"], r["seq"]) for r in ranked.orderBy("rank").collect()]
    want = sorted(rows, key=lambda r: (-r[0], r[1], r[2]))
    assert got == [(i, *r) for i, r in enumerate(want, 1)]


def test_global_rank_of_nothing(spark):
    df = spark.createDataFrame([], "total int, name string")
    assert with_global_rank(df, [F.asc("total")]).collect() == []
