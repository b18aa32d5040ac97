"""Golden rows for the text / number / date column functions (samples from the reference's comments)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from snapmetrics.functions import geo, numbers, text, urls


def one(spark, col, value):
    return spark.createDataFrame([(value,)], "x string").select(col.alias("y")).first()["y"]


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("30.12.2019 13:02:31", dt.datetime(2019, 12, 30, 13, 2, 31)),
        ("30 Дек. 2019, 16:13", dt.datetime(2019, 12, 30, 16, 13)),
        ("10:21     27 декември 2019", dt.datetime(2019, 12, 27, 10, 21)),
        ("30.12.2019 10:33", dt.datetime(2019, 12, 30, 10, 33)),
        ("21 ноември 2019  19:42", dt.datetime(2019, 11, 21, 19, 42)),
        ("30 Декември, 2019 15:26", dt.datetime(2019, 12, 30, 15, 26)),
        ("14:41, 30 дек 19", dt.datetime(2019, 12, 30, 14, 41)),
        ("01 януари 2020 | 16:26 - Обновена", dt.datetime(2020, 1, 1, 16, 26)),
        ("15:54 на 21 февруари, 2020 год.", dt.datetime(2020, 2, 21, 15, 54)),
        ("4 декември 2020 16:31", dt.datetime(2020, 12, 4, 16, 31)),
        ("без дата", None),
    ],
)
def test_parse_bg_datetime(spark, raw, expected):
    assert one(spark, text.parse_bg_datetime(F.col("x")), raw) == expected


def test_month_prefix_calendar_order(spark):
    assert one(spark, text.month_number(F.col("x")), "ма") == "03"  # март before май
    assert one(spark, text.month_number(F.col("x")), "Юл") == "07"
    assert one(spark, text.month_number(F.col("x")), "на") is None


def test_link_id(spark):
    link = "rental-apartment/espoo/suurpelto/block+of+flats/722129?entryPoint=fromSearch&rentalIndex=1"
    assert one(spark, urls.link_id(F.col("x")), link) == "722129"


def test_place_from_title(spark):
    assert one(spark, text.place_from_title(F.col("x")), "София - Герман  338000") == "Герман"


def test_clean_text(spark):
    assert one(spark, text.clean_text(F.col("x")), '  a\n"b"\t„c“\\xa0d  ') == "a 'b' 'c' d"


def test_listing_rules(spark):
    assert one(spark, text.listing_type(F.col("x")), " 3-СТАЕН апартамент ") == "тристаен"
    assert one(spark, text.listing_place(F.col("x")), "гр. София, Лозенец / близо до център") == " лозенец   център"
    assert one(spark, numbers.first_number(F.col("x"), 3), "127 034 лв.") == "127034"
    assert one(spark, numbers.first_number(F.col("x"), 2), "7 кв.м") is None
    assert one(spark, text.after_place(F.col("x"), F.lit("гр. (София)")), "a гр. (София), ул. 5") == ", ул. 5"


def test_round_ratio_exact(spark):
    df = spark.createDataFrame([(1, 8), (-1, 8), (123456789012345, 1000000000000000), (5, 0), (None, 3)], "p long, t long")
    got = [r[0] for r in df.select(numbers.round_ratio("p", "t", 1)).collect()]
    assert got == [12.5, -12.5, 12.3, None, None]


def test_round_half_up_goes_through_decimal(spark):
    assert one(spark, numbers.round_half_up(F.lit(1.005), 2).cast("string"), "") == "1.01"


def test_slugify(spark):
    assert one(spark, geo.slugify_bg(F.col("x")), "Жилище, гр. Щип") == "zhilishte-gr-shtip"
    assert one(spark, geo.slugify_bg(F.col("x")), "nan") == "nan"


def test_query_value_plus_is_space(spark):
    assert one(spark, urls.query_value(F.col("x"), "daddr"), "https://m.example/?daddr=12+main+st&x=1") == "12 main st"


def test_pairs_to_map_odd_is_null(spark):
    df = spark.createDataFrame([(["a", "1", "b", "2", "a", "3"],), (["a", "1", "b"],)], "items array<string>")
    from snapmetrics.functions.jsonx import pairs_to_map

    rows = [r[0] for r in df.select(pairs_to_map("items")).collect()]
    assert rows[0] == {"a": "3", "b": "2"}  # repeated key: last wins
    assert rows[1] is None


def test_tags_from_script_blob(spark):
    blob = (
        "GTM\nvar\nw2g = w2g | | {};\nw2g.targeting = {\ncid: 'news',\nbid: 'view',\naid: '273680',\n"
        "tag: 'тенис',\ntag: 'джейми',\ntag: 'мъри',\ntag: 'григор',\ntag: 'димитров',\ntag: 'александър',\n"
        "tag: 'лазаров',\ntag: 'великобритания',\ntag: 'българия'\n};"
    )
    col = text.all_words(text.between(F.col("x"), "w2g.targeting = ", ";"))
    assert one(spark, col, blob) == (
        "тенис - джейми - мъри - григор - димитров - александър - лазаров - великобритания - българия"
    )


def test_ideal_parts(spark):
    from snapmetrics.plans.tenders import ideal_parts

    assert one(spark, ideal_parts(F.col("x")), "1/6 ид. части от поземлен имот") == "1/6 "
    assert one(spark, ideal_parts(F.col("x")), " 2/9 от имот") == "2/9"
    assert one(spark, ideal_parts(F.col("x")), "Идеална част от апартамент") == ""
    assert one(spark, ideal_parts(F.col("x")), "Самостоятелен обект") is None
