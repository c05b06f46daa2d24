from pyspark.sql import functions as F

from clickrev.functions import has_event
from clickrev.operators import purchase_hits
from data import column, frame, hits


PURCHASES = ["1", "1,2", "2,1", "2,1,12", "2, 1 ,12", " 1", "1 ", "\t1"]
OTHERS = ["2", "10", "11", "12", "13", "14", "10,12", "21", "1a", "1;2", "1.0", "", None]


def test_only_the_whole_token_1_is_a_purchase(spark):
    df = hits(spark, *[{"event_list": events} for events in [*PURCHASES, *OTHERS]])
    assert column(purchase_hits(df), "event_list") == PURCHASES


def test_other_codes(spark):
    df = frame(spark, "e string", ("2,12",)).select(
        *[has_event(F.col("e"), code).alias(f"c{code}") for code in ("2", "12", "1")]
    )
    assert tuple(df.first()) == (True, True, False)
    dotted = frame(spark, "e string", ("1x2",)).select(has_event(F.col("e"), "1.2").alias("hit"))
    assert column(dotted, "hit") == [False]
