"""Small document tables with the awkward rows every operator must bear."""

import random

from pyspark.sql.types import LongType, StringType, StructField, StructType

SCHEMA = StructType([StructField("doc_id", LongType()), StructField("text", StringType()), StructField("source", StringType())])

SYLLABLES = "an on the er re sh in ea tion st wh en ha ti or le".split()


def prose(seed, n):
    draw = random.Random(seed)
    return " ".join("".join(draw.choice(SYLLABLES) for _ in range(draw.randint(1, 4))) for _ in range(n))


def awkward():
    long = prose(5, 6000)
    return [
        (1, prose(1, 120), "b"), (2, None, "a"), (3, "", "a"), (4, " \n\t\x0b ", None), (5, long, "b"),
        (6, prose(1, 120), "a"), (6, prose(1, 120), "a"), (None, prose(2, 80), "c"), (None, prose(2, 80), "c"),
        (9, "one", "c"), (10, "ÀÉ ñandú ñandú\nx\nx\n#$ a|b " + prose(3, 60), None), (11, prose(1, 119) + " changed", "b"),
        (12, "spam " * 400, "a"), (13, "two words", "zz"),
    ]


def table(spark, rows, extra=()):
    """The rows, with constant extra columns whose names clash with those an operator works with."""
    df = spark.createDataFrame(rows, SCHEMA)
    for name in extra:
        df = df.selectExpr("*", f"'{name}' AS `{name}`")
    return df
