"""Tables with everything that is unusual: nulls, empty and long texts, ties, clashing columns."""

from __future__ import annotations

import public_tokenizers

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside or return; a table may have them already.
CLASHING = ("score", "bits", "shard", "slot", "key", "votes", "bucket", "place", "node", "part", "tab", "ids",
            "size", "component", "component_id", "sequence_id", "offset", "start", "print", "words", "learning",
            "lang_pred", "hits", "label", "toxic", "rejected", "_text", "_whole", "curve_key")
PLAIN = "The quick brown fox jumps over the lazy dog and runs away from it.\nThen it sleeps for a while in the sun."
ROWS = [
    (1, PLAIN, "en", "a", 1),
    (2, None, None, None, None),
    (3, "", "en", "a", 0),
    (None, "no id here, but words there are", "en", None, 5),
    (5, "Zwölf Boxkämpfer jagen Viktor quer über den großen Sylter Deich. " * 4000, "de", "b", 1),
    (6, PLAIN, "en", "c", 1),
    (6, PLAIN, "en", "c", 1),
    (7, "日本語のテキスト 😀😀 <|endoftext|> ՘ \x00\t  \n\n1234567", "ja", "d", 9),
    (9, "!!! ... 123", None, "d", 9),
    (-4, "a", "en", "d", 9),
]


def unusual(spark, clashing: bool = False):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    if clashing:
        from pyspark.sql import functions as F

        docs = docs.withColumns({name: F.lit("x") for name in CLASHING})
    return docs


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def texts() -> list[str]:
    return [row[1] or "" for row in ROWS]
