import random

import pytest
from pyspark.sql import functions as F

from jornada.functions import legacy_int

# FIXTURES.md section 5: int text, fraction, not an int, range.
CASES = [
    ("1000", 1000), (" 12 ", 12), ("+5", 5), ("00012", 12),
    ("1000.7", 1000), ("-3.9", -3), ("1000.", 1000), (".5", 0),
    ("abc", None), ("", None), ("1e3", None), ("1_000", None), ("1,000", None),
    ("1.234,5", None), ("12a", None), ("-", None),
    ("2147483647", 2147483647), ("2147483648", None), ("-2147483648", -2147483648),
    (None, None),
]


def test_edge_values(spark):
    df = spark.createDataFrame([(v,) for v, _ in CASES], "v string")
    got = [r.i for r in df.select(legacy_int("v").alias("i")).collect()]
    assert got == [e for _, e in CASES]


def _lenient_cast(spark, values):
    """Spark's own non-ANSI cast, for comparison only (session setting restored)."""
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
        return [r.r for r in df.orderBy("i").select(F.col("v").cast("int").alias("r")).collect()]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)


def test_matches_lenient_cast_on_random_text(spark):
    rng = random.Random(7)
    alphabet = "0123456789+-. \t\ne,x"
    values = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 12)))
              for _ in range(3000)]
    values += [str(rng.randint(-3_000_000_000, 3_000_000_000)) for _ in range(500)]
    values += [f"{rng.uniform(-1e6, 1e6):.{rng.randint(0, 4)}f}" for _ in range(500)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    ours = [r.r for r in df.orderBy("i").select(legacy_int("v").alias("r")).collect()]
    assert ours == _lenient_cast(spark, values)


def test_independent_of_ansi_setting(spark):
    df = spark.createDataFrame([("1000.7",), ("x",)], "v string")
    old = spark.conf.get("spark.sql.ansi.enabled")
    try:
        for mode in ("true", "false"):
            spark.conf.set("spark.sql.ansi.enabled", mode)
            assert [r.i for r in df.select(legacy_int("v").alias("i")).collect()] == [1000, None]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)


@pytest.mark.parametrize("text,expected", [("٣", None), ("１２", None), ("\t7\n", 7), (".", 0)])
def test_unicode_and_whitespace(spark, text, expected):
    df = spark.createDataFrame([(text,)], "v string")
    assert df.select(legacy_int("v").alias("i")).first().i == expected
