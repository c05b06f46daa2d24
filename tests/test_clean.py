from clickrev.fixed_values import ALL_HITS_COLUMNS
from clickrev.operators import blank_to_null, clean_hits, trim_strings
from data import column, hits, rows_of


def test_every_string_column_is_trimmed(spark):
    raw = hits(spark, {"geo_city": "  Salem  ", "pagename": " a b ", "user_agent": "x "})
    row = trim_strings(raw).first()
    assert (row.geo_city, row.pagename, row.user_agent) == ("Salem", "a b", "x")
    assert row.hit_time_gmt == 1000


def test_only_blanks_are_trimmed(spark):
    # a tab cannot stand in an unquoted field of a tab-delimited file
    assert column(trim_strings(hits(spark, {"geo_region": "\tOR\t"})), "geo_region") == ["\tOR\t"]


def test_blank_becomes_null_in_the_three_packed_columns_only(spark):
    blank = dict.fromkeys(["event_list", "product_list", "referrer", "geo_city"], "   ")
    row = clean_hits(hits(spark, blank)).first()
    assert (row.event_list, row.product_list, row.referrer) == (None, None, None)
    assert row.geo_city == ""


def test_null_stays_null_and_text_stays_text(spark):
    row = blank_to_null(hits(spark, {"event_list": "1", "referrer": None})).first()
    assert (row.event_list, row.referrer) == ("1", None)


def test_columns_keep_their_fixed_order(spark):
    shuffled = hits(spark, {}).select(*reversed(ALL_HITS_COLUMNS))
    assert clean_hits(shuffled).columns == ALL_HITS_COLUMNS


def test_no_hit_is_dropped(spark):
    raw = hits(
        spark,
        {"product_list": None},
        {"product_list": ""},
        {"product_list": "A;B;1;2;"},
        {"ip": None, "hit_time_gmt": None},
        {"ip": None, "hit_time_gmt": None},
    )
    assert len(rows_of(clean_hits(raw))) == 5
