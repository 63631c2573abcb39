import duckdb
import pytest
from pyspark.sql import functions as F

from star_rows import rows
from grantlens.functions import draws, labels, numbers, periods, text
from grantlens.functions.dates import safe_date

DATES = [
    "2020-01-05", " 2020-01-05 ", "2020-1-5", "2020/01/05", "2020/1/5", "2020", "2020-01",
    "2020-13-01", "2020-02-30", "", "abc", "2020-01-05 10:20:30", "20200105", "1999-12-31",
    "2020-01-05x", "05-01-2020", None,
]


@pytest.mark.parametrize("value", DATES)
def test_dates_parse_like_the_other_engine(spark, value):
    got = spark.createDataFrame([(value,)], "d string").select(safe_date(F.col("d"))).first()[0]
    want = duckdb.execute("SELECT TRY_CAST(? AS DATE)", [value]).fetchone()[0]
    assert got == want


def _one(spark, column, **values):
    names = list(values)
    df = spark.createDataFrame(
        [tuple(values.values())],
        ", ".join(f"{n} {'double' if isinstance(values[n], float) else 'string'}" for n in names),
    )
    return df.select(column).first()[0]


def test_text_cleaning(spark):
    dirty = "   Trimmed    title with inner   spacing   "
    assert _one(spark, text.collapsed(F.col("t")), t=dirty) == "Trimmed title with inner spacing"
    assert _one(spark, text.collapsed(F.col("t")), t="a\t\n b\u000bc d") == "a b\u000bc d"
    assert _one(spark, text.blank_to_null(F.col("t")), t="") is None
    name = text.full_name(F.col("a"), F.col("b"))
    assert _one(spark, name, a=" Ann ", b=None) == "Ann"
    assert _one(spark, name, a=None, b=" Lee") == "Lee"
    assert _one(spark, name, a=None, b=None) == ""
    owner = text.organisation_or_person(F.col("o"), F.col("a"), F.col("b"))
    assert _one(spark, owner, o=" ", a="Ann", b="Lee") == "Ann Lee"
    assert _one(spark, owner, o="Acme ", a="Ann", b="Lee") == "Acme"
    assert _one(spark, owner, o=None, a="", b=None) is None


def test_name_split_and_shortening(spark):
    assert _one(spark, text.first_word(F.col("n")), n="Ann Mary Lee") == "Ann"
    assert _one(spark, text.after_first_word(F.col("n")), n="Ann Mary Lee") == "Mary Lee"
    assert _one(spark, text.after_first_word(F.col("n")), n="Ann") is None
    assert _one(spark, text.shortened(F.col("n")), n="x" * 40) == "x" * 40
    assert _one(spark, text.shortened(F.col("n")), n="x" * 41) == "x" * 40 + "…"
    assert _one(spark, text.preview(F.col("n")), n="short") == "short…"
    assert _one(spark, text.preview(F.col("n")), n=None) == ""


@pytest.mark.parametrize(
    "needle, literal, found",
    [
        ("SOLAR", False, True), ("s_lar", False, True), ("s_lar", True, False),
        ("100%", False, True), ("100%", True, False), ("a\\b", False, True), ("a\\b", True, True),
        ("zzz", False, False),
    ],
)
def test_search_patterns(spark, needle, literal, found):
    assert _one(spark, text.matches(F.col("t"), needle, literal), t="Solar 100 a\\b") is found


def test_missing_text_never_matches(spark):
    assert _one(spark, text.matches(F.col("t"), "x"), t=None) is False


def test_numbers(spark):
    df = spark.createDataFrame([(10, 0), (15, 10), (5, 10)], "new int, old int")
    got = df.select(numbers.round4(numbers.growth(F.col("new"), F.col("old"))).alias("g")).collect()
    assert [r.g for r in got] == [None, 0.5, -0.5]
    df = spark.createDataFrame([(1, 8, 3), (2, 2, 0), (0, 5, 3)], "f int, l int, s int")
    rate = numbers.compound_growth(F.col("f"), F.col("l"), F.col("s"))
    assert [r[0] for r in df.select(numbers.round4(rate)).collect()] == [1.0, None, None]


@pytest.mark.parametrize("x, digits, shown", [
    (0.48634, 1, "48.6 %"), (0.05, 1, "5.0 %"), (0.12345, 2, "12.34 %"), (-0.5, 1, "-50.0 %"),
])
def test_percent_text(spark, x, digits, shown):
    assert _one(spark, numbers.percent_text(F.col("x"), digits), x=x) == shown


def test_signed_percent_text(spark):
    assert _one(spark, numbers.signed_percent_text(F.col("x")), x=0.1234) == "+12.3%"
    assert _one(spark, numbers.signed_percent_text(F.col("x")), x=-0.5) == "-50.0%"


def test_periods(spark):
    df = spark.createDataFrame([(1975,), (1976,), (1989,), (2025,), (2030,), (None,)], "y int")
    y = F.col("y")
    got = df.select(
        periods.closed_period(y, periods.DECADE_PERIODS), periods.open_period(y, periods.DECADE_PERIODS),
        periods.decade(y),
    ).collect()
    assert [tuple(r) for r in got] == [
        ("other", "1976-1989", 1970), ("1976-1989", "1976-1989", 1970),
        ("1976-1989", "1976-1989", 1980), ("2020-2025", "2020-2025", 2020),
        ("other", "2020-2025", 2030), ("other", None, None),
    ]


def test_labels_fall_back_to_the_code(spark):
    df = spark.createDataFrame([("A",), ("Q",), (None,)], "c string")
    got = [r[0] for r in df.select(labels.section_label(F.col("c"))).collect()]
    assert got == ["Human Necessities", "Q", None]
    df = spark.createDataFrame([("DE",), ("ZZ",)], "c string")
    got = df.select(labels.country_name(F.col("c")), labels.country_iso3(F.col("c"))).collect()
    assert [tuple(r) for r in got] == [("Germany", "DEU"), ("ZZ", "ZZ")]
    assert _one(spark, labels.coded_section_label(F.col("c"), 5), c="G") == "G — Physi"


def test_draws_do_not_depend_on_partitioning(spark):
    few = spark.range(0, 20000, 1, 2).select("id", draws.uniform(F.col("id"), "s").alias("u"))
    many = spark.range(0, 20000, 1, 13).select("id", draws.uniform(F.col("id"), "s").alias("u"))
    assert few.exceptAll(many).count() == 0
    low, high, mean = few.agg(F.min("u"), F.max("u"), F.avg("u")).first()
    assert 0 <= low and high < 1 and abs(mean - 0.5) < 0.01
    share = few.select(draws.pick(F.col("u"), [("a", 0.2), ("b", 0.8)]).alias("v")).filter("v = 'a'")
    assert abs(share.count() / 20000 - 0.2) < 0.02
    mean = few.select(F.avg(draws.triangular(F.col("u"), 0.0, 65.0, 100.0))).first()[0]
    assert abs(mean - 55.0) < 1.0
