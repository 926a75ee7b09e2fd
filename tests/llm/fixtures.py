"""Documents with nulls, empty and long texts, ties and repeated rows, and extra columns with clashing names."""

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_bytes string, score string, kept string, size string, taken string, value string"


def rows():
    base = "the quick brown fox jumps over the lazy dog while many other small animals sleep under old green trees near quiet rivers "
    return [
        (1, base * 3, "en", "a"),
        (2, base * 3, "en", "a"),
        (2, base * 3, "en", "a"),
        (3, base * 3 + "extra", "en", "b"),
        (4, None, None, None),
        (5, "", "en", "b"),
        (6, "one", "fr", "c"),
        (7, "one", "fr", None),
        (8, "x" * 70_000, "de", "a"),
        (9, "be " * 5_000, "de", "a"),
        (None, "no id here at all", "en", "b"),
        (10, "mail a.b@x.example.org or c at d dot example dot com, 10.0.0.1 and 4111 1111 1111 1111, +1 (505) 555-1234", "en", "c"),
        (11, "Released under the MIT License. SPDX-License-Identifier: (Apache-2.0 OR GPL-2.0-only WITH Classpath-exception-2.0) AND MIT", "en", "c"),
        (12, " \t\n", "es", "c"),
        (13, "ñandú ünïcode ☃ 日本 𝒳 " * 20, "es", "d"),
    ]


def documents(spark, data=None):
    data = rows() if data is None else data
    return spark.createDataFrame([(*r, len(r[1] or ""), *["clash"] * 6) for r in data], SCHEMA)


def labels(spark, data=None):
    return spark.createDataFrame(data or [], "doc_id long, quality int, toxic int")


def empty(spark):
    return documents(spark).where(F.lit(False))
