import re
import zlib

import pytest

LOWER = {i: i + 32 for i in range(65, 91)}
ODD = [
    (1, None, "en", "s1", 3), (2, "", None, None, None), (3, "   \t\n", "en", "s1", 5), (4, "Same Text here, with IDIOT words.", "en", "s1", 33), (4, "Same Text here, with IDIOT words.", "en", "s1", 33),
    (5, "same text HERE, with idiot words.", "fr", None, 33), (None, "no id at all", "de", "s2", 12), (None, None, None, None, None), (7, "é Ü 漢字 🙂 \x00 x", "de", "s3", 11), (8, "word " * 30000, "en", "s2", 150000), (9, "a" * 70000, "en", "s2", 70000), (10, "!!! 123 ???", "en", "s1", 11),
]


@pytest.fixture
def odd(spark):
    """Nulls, empty and very long texts, ties, repeated rows, and extra columns whose names clash with inner ones."""
    from pyspark.sql import functions as F

    d = spark.createDataFrame(ODD, "doc_id long, text string, lang string, source string, n_chars long")
    return d.select("*", F.lit("x").alias("sid"), F.lit(1).alias("size"), F.lit(None).cast("string").alias("score"), F.lit(2).alias("n"), F.lit("k").alias("gid"), F.lit(0.5).alias("y"))


@pytest.fixture
def empty(odd):
    return odd.filter("false")


def words(text, pattern=r"[^\x20\x09-\x0D]+"):
    return re.findall(pattern, (text or "").translate(LOWER))


def crc(doc_id):
    return zlib.crc32(str(doc_id).encode())
