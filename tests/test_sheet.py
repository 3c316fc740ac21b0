import pytest
from pyspark.sql import functions as F

from portledger.operators import joins, sheet
from portledger.operators.sheet import HISTORICAL, WEEKLY
from portledger.schema import HISTORICAL_HEADERS, WEEKLY_HEADERS

W, H = list(WEEKLY_HEADERS), list(HISTORICAL_HEADERS)


def grid(spark, files):
    rows = [(f, i, cells) for f, sheet_rows in files.items() for i, cells in sheet_rows.items()]
    return spark.createDataFrame(rows, "file string, row_idx int, cells array<string>")


def status(df):
    return {r["file"]: (r["header_row"], r["ok"], r["missing"]) for r in df.collect()}


def test_header_is_searched_in_the_first_five_rows(spark):
    files = {
        "top": {0: W},
        "title": {0: ["조회 결과"], 1: W},
        "fifth": {4: W},
        "too deep": {0: ["x"], 5: W},
        "reordered": {0: W[::-1]},
        "padded": {1: ["　" + h + " " for h in W]},
        "twice": {1: W, 3: W},
        "cut": {0: W[:7]},
        "six of seven": {0: W[:6] + ["x"] + W[7:]},
        "extra": {0: ["extra", None, *W]},
    }
    assert status(sheet.schema_check(grid(spark, files), WEEKLY)) == {
        "top": (0, True, ""),
        "title": (1, True, ""),
        "fifth": (4, True, ""),
        "too deep": (None, False, None),
        "reordered": (0, True, ""),
        "padded": (1, True, ""),
        "twice": (1, True, ""),
        "cut": (0, False, ",".join(W[7:])),
        "six of seven": (None, False, None),
        "extra": (0, True, ""),
    }


def test_fixed_header(spark):
    files = {"ok": {0: ["title"], 1: H}, "no year": {1: ["Yr", *H[1:]]}, "one row": {0: H}}
    assert status(sheet.schema_check(grid(spark, files), HISTORICAL)) == {
        "ok": (1, True, ""),
        "no year": (1, False, "Year"),
        "one row": (None, False, None),
    }


def named(spark, files, layout):
    rows = sheet.cells_to_columns(sheet.rows_of_grid(grid(spark, files), layout), layout)
    return {(r["src_file"], r["row_idx"]): r.asDict() for r in rows.collect()}


def test_cells_follow_their_header(spark):
    cells = [f"v{i}" for i in range(14)]
    got = named(
        spark,
        {
            "a": {0: W, 1: cells, 2: cells[:3], 3: [None] * 14, 4: [" ", "　", ""], 5: [None, "x"]},
            "b": {0: ["title"], 2: [*W[::-1], W[0], "unknown"], 3: [*cells, "last", "dropped"], 4: cells},
        },
        WEEKLY,
    )
    assert set(got) == {("a", 1), ("a", 2), ("a", 5), ("b", 3), ("b", 4)}
    assert [got["a", 1][f] for f in WEEKLY_HEADERS.values()] == cells
    assert [got["a", 2][f] for f in WEEKLY_HEADERS.values()] == cells[:3] + [""] * 11
    assert got["a", 5]["importer_ko"] == "x" and got["a", 5]["date"] == ""
    # The date header occurs twice in b; its last position counts, also when the row is too short.
    assert got["b", 3]["date"] == "last" and got["b", 4]["date"] == ""
    assert got["b", 3]["country_origin_raw"] == "v0"


def test_rows_above_the_header_and_bad_files_are_left_out(spark):
    got = named(spark, {"a": {0: ["x"], 1: W, 2: ["1"]}, "bad": {0: W[:10], 1: ["1"]}}, WEEKLY)
    assert set(got) == {("a", 2)}


def _join_inputs(spark):
    # Key "hot" holds more than a third of the rows, some keys have no match, some are null.
    big = spark.range(20_000).select(
        "id",
        F.when(F.col("id") % 5 < 2, "hot")
        .when(F.col("id") % 5 == 2, F.lit(None))
        .otherwise(F.concat(F.lit("k"), F.col("id") % 3000))
        .alias("key"),
    )
    small = spark.range(2000).select(
        F.concat(F.lit("k"), "id").alias("key"), F.col("id").alias("a"), F.lit("x").alias("b")
    )
    hot = spark.createDataFrame([("hot", -1, None)], "key string, a bigint, b string")
    return big, small.union(hot)


@pytest.mark.parametrize("share", [1 / 500, 1 / 50_000, 1])
def test_both_join_strategies_agree(spark, monkeypatch, share):
    monkeypatch.setattr(joins, "HOT_SHARE", share)
    big, small = _join_inputs(spark)
    fast = joins.keyed_left_join(big, small, "key", ["id"])
    wide = joins.keyed_left_join(big, small, "key", ["id"], small_fits=False).select(fast.columns)
    assert wide.count() == 20_000
    assert fast.exceptAll(wide).isEmpty() and wide.exceptAll(fast).isEmpty()


def test_hot_and_null_keys_are_spread_before_the_shuffle(spark, monkeypatch):
    monkeypatch.setattr(joins, "HOT_SHARE", 1 / 500)
    big, small = _join_inputs(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        wide = joins.keyed_left_join(big, small, "key", ["id"], small_fits=False)
        placed = wide.withColumn("p", F.spark_partition_id()).groupBy("p").count()
        sizes = [r["count"] for r in placed.collect()]
        # The join has eight partitions; without the split one of them would hold the hot 40 %.
        assert sum(sizes) == 20_000 and len(sizes) == 8 and max(sizes) < 4_000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_size_is_measured_before_broadcast(spark):
    _, small = _join_inputs(spark)
    assert joins.fits_broadcast(small)
    assert not joins.fits_broadcast(small, max_rows=2000)
    assert not joins.fits_broadcast(small, max_bytes=10_000)
    assert joins.fits_broadcast(small.limit(0))
