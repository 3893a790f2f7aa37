"""Cases shared by the tests of this folder."""

from __future__ import annotations

import re

from pyspark.sql import types as T

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower_az(text: str) -> str:
    return re.sub("[A-Z]+", lambda m: m.group().lower(), text)


# Null id, null text, empty and white-space texts, repeated rows, a long text, a null source,
# multi-byte characters, control characters; and columns named like the operators' own.
LONG = " ".join(f"w{i % 977}" for i in range(30_000))
EDGE_ROWS = [
    (1, "the quick brown fox jumps over the lazy dog " * 8, "en", "a", 1, "x", 5),
    (2, "the quick brown fox jumps over the lazy dog " * 8, "en", "a", 1, "x", 5),
    (2, "the quick brown fox jumps over the lazy dog " * 8, "en", "a", 1, "x", 5),
    (3, None, "en", "b", 1, None, None),
    (4, "", None, "b", 1, "y", 1),
    (5, " \t\n\x0b\x0c\r ", "en", None, None, "y", 1),
    (6, "one two", "en", "b", 1, "z", 2),
    (7, "ONE  Two\n", "en", "b", 1, "z", 2),
    (None, "one two", "en", "b", 1, "z", 2),
    (8, LONG, "en", "c", 1, "z", 2),
    (9, LONG + " tail", "en", "c", 1, "z", 2),
    (10, "größe été 日本語 テスト ½ ² 🙂 a\x1cb it's we'll   x y z \n\n end", "de", "é", 1, "q", 3),
    (11, "mail bob@example.com or bob.x@a-b.co.uk, ip 10.0.0.1 or 999.1.1.1, "
         "card 4111 1111 1111 1111, call +1 (212) 555-0100 now", "en", "a", 1, "q", 3),
]
EDGE_SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.IntegerType()),
    # clashing names
    T.StructField("key", T.StringType()), T.StructField("size", T.IntegerType())])
