import pytest
from pyspark.sql import functions as F

from portledger.operators import lookup
from portledger.operators.lookup import Translations, lookup_rows, lookup_sections, lookup_table

ROWS = [
    [None, "고아", "orphan"],
    [None, "뉴질랜드", "New Zealand"],
    [None, " 러시아 ", "Russia"],
    [None, "중국", "China"],
    [None, "일본", ""],
    [None, "중국", "China PRC"],
    [None, None, None],
    [None, "  ", "blank key"],
    [None, "short"],
    [None, "Product name (Korean)", "Translation"],
    [None, "생녹용(냉동)", "Frozen velvet antler"],
    [None, "녹용", "Velvet antler"],
    [None, "Company Korean name", "Company English name"],
    [None, "한국수입사", "Korea Importer Co"],
    [None, "Company", "Country"],
    [None, "NZ Exports", "New Zealand"],
    [None, "Company", "not a header"],
]


def grid(spark, rows, at=None):
    data = [("f", (at or range(len(rows)))[i], cells) for i, cells in enumerate(rows)]
    return spark.createDataFrame(data, "file string, row_idx int, cells array<string>")


def table(spark, rows=ROWS, at=None):
    found = lookup_table(lookup_sections(lookup_rows(grid(spark, rows, at)))).collect()
    return {(r["category"], r["key"]): r["value"] for r in found}


EXPECTED = {
    ("country", "뉴질랜드"): "New Zealand",
    ("country", "러시아"): "Russia",
    ("country", "중국"): "China PRC",
    ("product_type", "생녹용(냉동)"): "Frozen velvet antler",
    ("product_type", "녹용"): "Velvet antler",
    ("importer", "한국수입사"): "Korea Importer Co",
    ("exporter", "NZ Exports"): "New Zealand",
    ("exporter", "Company"): "not a header",
}


def test_sections_and_last_duplicate(spark):
    assert table(spark) == EXPECTED


@pytest.mark.parametrize("step", [1 << 15, 1 << 16, 100_000])
def test_sections_reach_across_spans(spark, step):
    # The same sheet stretched over many spans of the section walk, most of them without a header.
    at = [i * step for i in range(len(ROWS))]
    assert table(spark, at=at) == EXPECTED


def test_section_walk_equals_a_plain_walk(spark, monkeypatch):
    import random

    monkeypatch.setattr(lookup, "SPAN_BITS", 2)
    rng = random.Random(3)
    starts = [(k, v) for k, v, _ in lookup.SECTION_STARTS.values()]
    pairs = [rng.choice(starts) if rng.random() < 0.1 else (f"k{rng.randrange(40)}", f"v{i}") for i in range(400)]
    section, want = None, {}
    for k, v in pairs:
        opened = next((n for n, (a, b, _) in lookup.SECTION_STARTS.items() if (a, b) == (k, v)), None)
        section = opened or section
        if section and (not opened or opened == "country"):
            want[section, k] = v
    assert table(spark, [[None, k, v] for k, v in pairs]) == want


def test_translation_falls_back_to_the_stripped_text(spark):
    found = Translations.from_grid(grid(spark, ROWS))
    df = spark.createDataFrame([(1, "중국"), (2, " 러시아　"), (3, " 호주 "), (4, ""), (5, "중국")], "id int, k string")
    for limits in ({}, {"max_rows": 0}):
        found = Translations.from_grid(grid(spark, ROWS), **limits)
        got = found.translate(df, "country", "k", "en", ["id"]).orderBy("id")
        assert [r["en"] for r in got.collect()] == ["China PRC", "Russia", "호주", "", "China PRC"]
        assert got.columns == ["id", "k", "en"]
        nothing = found.translate(df, "no such category", "k", "en", ["id"]).orderBy("id")
        assert [r["en"] for r in nothing.collect()] == ["중국", "러시아", "호주", "", "중국"]


def test_one_category_does_not_answer_for_another(spark):
    found = Translations.from_grid(grid(spark, ROWS))
    df = spark.createDataFrame([(1, "한국수입사"), (2, "녹용")], "id int, k string")
    got = found.translate(df, "product_type", "k", "en", ["id"]).orderBy("id").select("en")
    assert [r[0] for r in got.collect()] == ["한국수입사", "Velvet antler"]


def test_lookup_join_is_broadcast_only_when_it_fits(spark):
    df = spark.range(10).select("id", F.col("id").cast("string").alias("k"))
    plan = lambda t: t.translate(df, "importer", "k", "en", ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan(Translations.from_grid(grid(spark, ROWS)))
