"""Session settings shared by the jobs, the bench and the tests."""
from pyspark.sql import SparkSession

SETTINGS = {
    # Hit times carry no zone; one fixed zone keeps their text form stable.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # HotSpot leaves methods over 8,000 bytes interpreted. A stage that would
    # generate one runs faster uncompiled by Spark, operator by operator.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

# Reduce tasks are sized for shuffled rows, which are a small part of the input
# here (narrow columns, reduced per task before each shuffle).
_INPUT_BYTES_PER_SHUFFLE_PARTITION = 4 << 30
_PARTITIONS_OF_ANY_INPUT = 200


def build_session(app_name: str, **settings: str) -> SparkSession:
    """A session with the library's settings; master and resources come from spark-submit."""
    return SparkSession.builder.appName(app_name).config(map={**SETTINGS, **settings}).getOrCreate()


def sizing_for(input_bytes: int) -> dict[str, str]:
    """Settings that fit an input of ``input_bytes``: one rule for every size.

    Adaptive execution merges shuffle partitions that turn out small but cannot split an
    aggregate's, so their number grows with the input; 100 TB gives 25,800.
    """
    grown = -(-input_bytes // _INPUT_BYTES_PER_SHUFFLE_PARTITION)
    return {"spark.sql.shuffle.partitions": str(_PARTITIONS_OF_ANY_INPUT + grown)}


def apply_sizing(spark: SparkSession, input_bytes: int) -> None:
    """Set :func:`sizing_for` on the session, except what spark-submit set explicitly."""
    chosen = spark.sparkContext.getConf()
    for key, value in sizing_for(input_bytes).items():
        if not chosen.contains(key):
            spark.conf.set(key, value)
