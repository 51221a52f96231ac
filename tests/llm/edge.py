"""Awkward rows that every operator must take."""

LONG = "lorem ipsum dolor sit amet " * 4000
SHARED = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen " * 6
# names that operators use inside, as columns of the input
CLASH = ("size", "target", "taken", "order", "last", "left", "whole", "n", "digest", "key", "piece", "bucket", "copy", "place", "block", "token",
         "tokens", "class_id", "component_id", "component", "host", "path", "rule", "score", "held_out", "lang_pred", "spans", "fp", "cell", "rank",
         "shard", "visited", "text_hash", "cuts", "first", "next_text", "edited", "source_key", "prefix", "token_ids", "n_tokens")

DOCS = [
    (1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, " \t\n\x0b\x0c\r ", "en", None, 7), (4, "Hello world", "en", "a", 11),
    (5, "Hello world", "en", "a", 11), (5, "Hello world", "en", "a", 11), (None, "no id here at all friends", "de", "b", 25), (7, LONG, "de", "b", len(LONG)),
    (8, LONG, None, "b", len(LONG)), (9, "1234 5678 !!", None, None, 12), (10, SHARED + "tail words here", "en", "a", 0), (11, SHARED + "other ending now", "en", "c", 0),
    (12, "x" * 5000, "en", "c", 5000), (13, "ñandú übergröße \U0001f600 中文字符 çédille", "es", "c", 0), (14, "a b c", "en", "zz", 5), (15, "A  B\nC", "en", "zz", 6),
    (16, SHARED.upper() + "TAIL words here", "en", "a", 0), (-3, "below zero id text", "en", "", 18),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def edge_docs(spark, rows=None, clash=True):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(DOCS if rows is None else rows, SCHEMA)
    return df.withColumns({c: F.lit(f"clash {c}") for c in CLASH}) if clash else df


def plain_docs(rows):
    return [(r[0], r[1] or "") for r in rows]
