"""One case per fault that lost rows or changed values: links, paragraphs, keys, matches, prices, ids, late rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from snapmetrics.functions.geo import buffer_points, golden_offset
from snapmetrics.functions.jsonx import repair_json
from snapmetrics.functions.numbers import counter, eu_number, first_number
from snapmetrics.functions.text import after_place, attribute_value, between, class_text, cut_after, paragraphs, text_after
from snapmetrics.operators.ordered import presented
from snapmetrics.operators.joins import insert_if_absent, only_new, update_by_key
from snapmetrics.plans.listings import price_eur, price_with_vat, scrape_price_eur, site_price
from snapmetrics.plans.pages import LinkRules, labelled_outlinks, page_articles, page_outlinks
from snapmetrics.plans.places import match_places
from snapmetrics.plans.tenders import disperse_clusters, ideal_parts, tender_fields
from snapmetrics.session import scratch_path

NB = " "


def one(spark, value, *cols):
    df = spark.createDataFrame([(value,)], "x string")
    return tuple(df.select(*[c.alias(f"c{i}") for i, c in enumerate(cols)]).first())


def test_all_links_are_kept_unless_a_rule_says_otherwise(spark):
    html = """<a href="/é,b">x</a><a class='k' href='/ö'>y</a><a href="https://other.example/z.html">z</a><a href="">none</a>"""
    pages = spark.createDataFrame([(1, "https://s.example/en/1", html)], "page_id long, url string, html string")
    assert {r["link"] for r in page_outlinks(pages).collect()} == {"https://s.example/é,b", "https://s.example/ö", "https://other.example/z.html"}
    rules = LinkRules(prefix="https://other", suffix=".html", pattern="z", without=("forum",))
    assert [r["link"] for r in page_outlinks(pages, rules).collect()] == ["https://other.example/z.html"]
    assert labelled_outlinks(pages.withColumn("page_id", F.lit(4))).filter("section = 'most_read'").count() == 3


def test_paragraphs_with_attributes_and_any_words(spark):
    html = '<h1>H</h1><p class="lead">Nicht dies.</p><p>two</p><pre>no</pre>'
    assert one(spark, html, paragraphs("x")) == (["Nicht dies.", "two"],)
    pages = spark.createDataFrame([(1, "https://s.example/en/1", html)], "page_id long, url string, html string")
    assert page_articles(pages).first()["n_paragraphs"] == 2 and page_articles(pages, ["Nicht"]).first()["n_paragraphs"] == 1


def test_field_rules(spark):
    html = "<div class='x label'>Адрес</div></div><div class=info>ул. 1</div><span>Цена:</span> 12 лв.<a data-a=1 href='/q'>t</a>"
    assert one(spark, html, class_text("x", "label"), text_after("x", "Адрес"), text_after("x", "Цена:"), attribute_value("x", "a", "href")) == ("Адрес", "ул. 1", "12 лв.", "/q")


def test_null_keys_are_kept_apart(spark):
    new = spark.createDataFrame([(None, 1), (None, 2), ("a", 3), ("a", 4), ("b", 5)], "k string, v int")
    old = spark.createDataFrame([("b",), (None,)], "k string")
    assert sorted(insert_if_absent(new, old, ["k"], ["v"]).collect(), key=str) == sorted([(None, 1), (None, 2), ("a", 3)], key=str)
    assert only_new(new, old, ["k"], drop_null_keys=True).collect() == []  # NOT IN a set that holds a null
    assert only_new(new, old.filter("k is not null"), ["k"], drop_null_keys=True).count() == 2


def test_two_updates_of_a_key_keep_one_row(spark):
    base = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    up = spark.createDataFrame([("a", 5), ("a", 7)], "k string, v int")
    assert sorted(update_by_key(base, up, ["k"], ["v"]).collect()) == [("a", 7), ("b", 2)]


def test_places_repeated_records_and_far_matches(spark):
    gaz = spark.createDataFrame(
        [("Банкя", "гр", "Общ", "Р", 1.0, 2.0, 1), ("Б", "с", "Общ", "Р", 3.0, 4.0, 2), ("", "с", "Общ", "Р", 0.0, 0.0, 3)],
        "name string, settlement_type string, mun string, region string, lon double, lat double, gorder int",
    )
    far = "x" * 1500 + " банкя"
    rec = spark.createDataFrame([(1, "Р", far), (1, "Р", far), (2, "Р", "нищо"), (3, None, "банкя"), (4, "Р", None)], "rid int, region string, place string")
    got = match_places(rec, gaz).collect()
    assert len(got) == 5 and [r["city_clean"] for r in got if r["rid"] == 1] == ["Б", "Б"]  # same place: the village first
    assert all(r["city_clean"] is None for r in got if r["rid"] != 1)
    assert all(r["city_clean"] is None for r in match_places(rec, gaz, max_position=1000).collect())


def test_presentation_order_and_its_nulls(spark):
    df = spark.createDataFrame([("b", 1), ("a", None), ("a", 2), (None, 3), ("a", 5)], "k string, v int")
    assert [tuple(r) for r in presented(df, "k", "-v").collect()] == [("a", 5), ("a", 2), ("a", None), ("b", 1), (None, 3)]
    assert [r["v"] for r in presented(df, "-v", nulls_first_on_desc=True).collect()] == [None, 5, 3, 2, 1]


def test_no_break_thousands(spark):
    price = f"12{NB}000 лв."
    assert one(spark, price, price_eur("x"), price_with_vat("x"), scrape_price_eur("x"), first_number("x", 3)) == (6126.2, 12000.0, 6136.0, "12000")
    assert one(spark, f"12{NB}345,50{NB}€", eu_number("x")) == ("12345.50",)


@pytest.mark.parametrize(
    ("text", "number", "kept"),
    [("Наем € 500/месец", 500.0, None), ("100 – 200 EUR", None, "100 – 200 EUR"), ("Цена по запитване", None, "Цена по запитване"), (f"1{NB}000 без ДДС", 1200.0, None)],
)
def test_site_prices(spark, text, number, kept):
    assert one(spark, text, *site_price("x")) == (number, kept)


def test_rent_only_by_its_pattern(spark):
    assert one(spark, "Наем € 500/месец", *site_price("x", rent=True)) == (500.0, None)
    assert one(spark, "500 EUR", *site_price("x", rent=True)) == (None, "500 EUR")


def test_texts_are_read_whole(spark):
    assert one(spark, "а" * 200 + " 1/3 ид. части", ideal_parts("x"))[0].endswith(" 1/3 ")
    assert one(spark, "1" * 150, first_number("x", 3)) == ("1" * 150,)
    assert one(spark, "a|b|" + "c" * 10, cut_after("x", "|")) == ("b|" + "c" * 10,)
    assert one(spark, "12 коментара | прочетена 36", counter("x", 5), counter("x", 1)) == (36, 12)


def test_address_after_place_over_lines_and_odd_places(spark):
    df = spark.createDataFrame([("София, ул. 1\nбл. 2", "София"), (r"a\Eb c", r"a\E"), ("x", "y"), (None, "y")], "a string, p string")
    assert [r[0] for r in df.select(after_place("a", "p")).collect()] == [", ул. 1\nбл. 2", "b c", None, None]


def test_invalid_json_becomes_null(spark):
    assert one(spark, '"{bad}"', repair_json("x")) == (None,) and one(spark, '"{""a"": 1}"', repair_json("x")) == ('{"a": 1}',)
    assert one(spark, "v = '[{\"a\": \"it's\"}]';", between("x", "v = '", "]'")) == ("[{\"a\": \"it's\"}",)


def test_clusters_of_text_ids(spark):
    rows = [(f"id{i:04d}", 1.0, 2.0) for i in range(25)] + [("z1", 3.0, 4.0), ("n", None, 1.0)]
    df = spark.createDataFrame(rows, "page_id string, lon double, lat double")
    got = disperse_clusters(df).collect()
    assert len(got) == 27 and sum(r["is_appr_coor"] for r in got) == 25 and {r["cluster_size"] for r in got if r["is_appr_coor"]} == {25}
    want = spark.createDataFrame([(k,) for k in range(25)], "k int").select(golden_offset(F.lit(1.0), F.lit(2.0), "k", F.lit(25))[0]).collect()
    assert sorted(r["display_lon"] for r in got if r["is_appr_coor"]) == sorted(r[0] for r in want)


def test_ring_has_sixteen_segments_a_quarter(spark):
    ring = spark.range(1).select(buffer_points(F.lit(0.0), F.lit(0.0), F.lit(1000)).alias("r")).first()["r"]
    assert len(ring) == 65 and abs(ring[16]["y"] - 0.01) < 1e-12


def test_a_cluster_without_a_shared_folder_is_refused():
    class Context:
        master, applicationId = "spark://host:7077", "app"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_path(Session(), "x")


def test_drawdown_pairs_every_high_with_every_as_of_row(spark):
    """Equal highs repeat the symbol; a symbol whose only high is at the date, without the date, or without highs drops out."""
    from snapmetrics.plans.prices import sector_drawdown

    day = lambda n: dt.date(2021, 1, n)
    bars = [("a", day(1), 20.0), ("a", day(3), 20.0), ("a", day(9), 15.0), ("b", day(2), 5.0), ("b", day(9), 10.0), ("c", day(1), 4.0), ("d", day(9), None), ("e", day(1), 8.0), ("e", day(9), 8.0),
            ("f", day(1), 9.0), ("f", day(9), None), ("g", day(1), 7.0), ("g", day(9), 1.0), (None, day(1), 3.0), (None, day(9), 2.0), ("a", None, 20.0)]
    prices = spark.createDataFrame(bars, "symbol string, at_date date, high double")
    companies = spark.createDataFrame([(s, '{"sector": "x"}' if s != "g" else "{}") for s in "abcdefg"], "symbol string, details string")
    (r,) = sector_drawdown(prices, companies, day(9)).collect()
    # a: 25 % twice (8 and 6 days), e: 0 % (8 days), f: unknown (8 days)
    assert (r["sector"], r["count_"], r["avg_percent_lower"], r["std_percent_lower"], r["avg_days_since_max_date"], r["std_days_since_max_date"]) == ("x", 4, 17.0, 14.43, 8.0, 1.0)


def test_lines_of_a_place_are_its_parts(spark):
    """The block of area and place is matched over its line breaks: a bare one separates parts, others are spaces."""
    blocks = {1: " - 85 кв.м., гр. Варна\nкв. Левски\nул. 1\n", 2: "\n- 60 кв.м., гр.\r\nВарна\tцентър-", 3: "40 кв.м., гр. Варна", 4: None, 5: "", 6: "\n\n"}
    rows = [(i, b, "", "", "") for i, b in blocks.items()]
    df = spark.createDataFrame(rows, "page_id long, area_and_place string, meta string, price_text string, description string")
    got = {r["page_id"]: (r["area"], r["place"]) for r in tender_fields(df).collect()}
    assert got == {1: ("85", "гр. Варна,кв. Левски,ул. 1"), 2: ("60", "гр. Варна център"), 3: ("40", "гр. Варна"), 4: (None, None), 5: (None, None), 6: (None, None)}
