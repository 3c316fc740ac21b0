import pytest

from portledger.plans import marts

FIELDS = ["year", "month", "importer_ko", "importer_en", "country_export_en", "country_export_ko",
          "type_frozen", "type_dried", "type_ambiguous"]
SCHEMA = (
    "year string, month string, importer_ko string, importer_en string, country_export_en string, "
    "country_export_ko string, type_frozen boolean, type_dried boolean, type_ambiguous boolean, src_file string, row_idx int"
)


def row(year="2020", month="1", ko="벨벳코", en="Velvet Co", cen="New Zealand", cko="", frozen=False, dried=False, amb=False):
    return (year, month, ko, en, cen, cko, frozen, dried, amb)


@pytest.fixture
def records(spark):
    def build(rows):
        return spark.createDataFrame([(*r, "f", i) for i, r in enumerate(rows)], SCHEMA).repartition(3)

    return build


def monthly(df):
    return {(r[0], r[1]): tuple(r)[2:] for r in marts.monthly_by_type(marts.tally(df)).collect()}


def test_monthly_counts_each_type(records):
    rows = [row(frozen=True), row(dried=True), row(amb=True), row(), row(frozen=None, dried=None, amb=None), row(month="02")]
    assert monthly(records(rows)) == {(2020, 1): (1, 1, 3, 5), (2020, 2): (0, 0, 1, 1)}


def test_monthly_joins_differently_written_numbers(records):
    assert monthly(records([row(month="5"), row(month="05"), row(month=" 5 ")])) == {(2020, 5): (0, 0, 3, 3)}


def test_monthly_skips_what_has_no_year_or_month(records):
    rows = [row(year="0"), row(month="0"), row(year=""), row(month=None), row(year="15/0"), row(month="x"), row(year="00")]
    assert monthly(records(rows)) == {}
    assert monthly(records([])) == {}


def test_monthly_keeps_odd_numbers(records):
    assert monthly(records([row(month="13"), row(year="-5")])) == {(2020, 13): (0, 0, 1, 1), (-5, 1): (0, 0, 1, 1)}


def yearly(df):
    return [tuple(r) for r in marts.yearly_by_country(marts.tally(df)).collect()]


def test_yearly_is_zero_filled_and_ascending(records):
    rows = [row(year="2021", cen="China"), row(year="2019", cen="", cko="러시아"), row(year="2020"), row(cen="Peru"), row(year="bad")]
    assert yearly(records(rows)) == [(2019, 0, 1, 0, 0, 1), (2020, 1, 0, 0, 1, 2), (2021, 0, 0, 1, 0, 1)]
    assert yearly(records([])) == []


def pivot(df, year=None):
    return {r["ptype"]: (r["nz"], r["russia"], r["china"], r["other"]) for r in marts.type_country_pivot(marts.tally(df), year).collect()}


def test_pivot_is_dense_when_empty(records):
    zero = (0, 0, 0, 0)
    assert pivot(records([])) == dict.fromkeys(["frozen", "dried", "ambiguous", "total"], zero)


def test_pivot_counts_and_year_filter(records):
    rows = [row(frozen=True), row(dried=True, cen="", cko="뉴질랜드"), row(year="bad", cen="China"), row(year="", cen="Chile"), row(year="2019", frozen=True, cen="Russia")]
    everything = {"frozen": (1, 1, 0, 0), "dried": (1, 0, 0, 0), "ambiguous": (0, 0, 1, 1), "total": (2, 1, 1, 1)}
    assert pivot(records(rows)) == everything
    assert pivot(records(rows), 2020)["total"] == (2, 0, 0, 0)
    # Year 0 is the year of records whose year is blank, not of unreadable ones.
    assert pivot(records(rows), 0)["total"] == (0, 0, 0, 1)
    assert pivot(records(rows), 1950)["total"] == (0, 0, 0, 0)


class Names:
    def __init__(self, df):
        self.df = df

    def category(self, name):
        assert name == "importer"
        return self.df


def importers(df, names=None):
    found = marts.importer_totals(df, names).collect()
    return {r["importer_ko"]: (r["importer_en"], r["year_counts"], r["total"]) for r in found}


def test_importer_counts_per_year(records):
    rows = [row(ko="가"), row(ko=" 가 "), row(ko="가", year="2018"), row(ko="나", year="x"), row(ko="다", year="0")]
    assert importers(records(rows)) == {"가": ("Velvet Co", {2018: 1, 2020: 2}, 3)}


def test_unknown_importers_are_one_group(records):
    rows = [row(ko="", en=""), row(ko=None, en="X"), row(ko="__unknown__", en="Y")]
    assert importers(records(rows)) == {"": ("__unknown__", {2020: 3}, 3)}


def test_first_usable_row_names_the_importer(spark, records):
    rows = [row(ko="가", en="bad year", year="x"), row(ko="가", en="first"), row(ko="가", en="later"),
            row(ko="나", en=" "), row(ko="나", en="too late"), row(ko="다", en="row"), row(ko="라", en="row")]
    table = Names(spark.createDataFrame([("다", "table"), ("라", "")], "key string, value string"))
    got = importers(records(rows), table)
    assert {k: v[0] for k, v in got.items()} == {"가": "first", "나": "나", "다": "table", "라": "row"}


def test_ranking_by_total_name_and_first_appearance(records):
    rows = [row(ko="가", en="B"), row(ko="나", en="A"), row(ko="다", en="B"), row(ko="라", en="Z"), row(ko="라", en="Z")]
    ranked = marts.importer_ranking(marts.importer_totals(records(rows)))
    assert [r["importer_ko"] for r in ranked.orderBy("rank").collect()] == ["라", "나", "가", "다"]


def test_year_numbers_are_read_after_the_first_count(records):
    plan = marts.monthly_by_type(marts.tally(records([row()])))._jdf.queryExecution().optimizedPlan().toString()
    below_the_count = plan[plan.rindex("+- Project") :]
    assert plan.count("Aggregate [") == 2 and "try_cast" in plan and "try_cast" not in below_the_count


def test_reports_use_partial_aggregation_and_no_python(records):
    df = records([row()])
    for report in (marts.monthly_by_type(marts.tally(df)), marts.yearly_by_country(marts.tally(df)),
                   marts.type_country_pivot(marts.tally(df)), marts.importer_totals(df)):
        plan = report._jdf.queryExecution().executedPlan().toString()
        assert "partial_count" in plan and "Python" not in plan and "Cartesian" not in plan
        assert "NestedLoop" not in plan
