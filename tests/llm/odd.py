"""Small tables with nulls, empty and very long texts, ties, repeated rows and clashing names."""

from __future__ import annotations

from pyspark.sql import functions as F

# Names that operators use for columns of their own.
CLASHING = ["row", "group", "least", "site", "nameless", "boilerplate", "tie", "shard", "block",
            "size", "crc", "first", "key", "fp", "sequence_id", "offset", "lang_pred", "score"]
DOCS = "doc_id long, text string, lang string, source string, n_chars long"

LONG = "word salad " * 40_000
TEXTS = [
    (1, "The cat sat on the mat.\nAll rights reserved.", "en", "a"),
    (2, "Le chat est sur la table, avec l'été.", "fr", "a"),
    (3, None, "en", "a"),
    (4, "", "de", None),
    (5, " \t\n\r  ", None, None),
    (6, "12345 67.8 !!! ***", "en", "b"),
    (7, LONG, "en", "b"),
    (8, "<|endoftext|> ▁under▁ 漢字 🙂 naïve ﬁ́ Σας \x00\x1f", None, "b"),
    (None, "no id here at all", "en", "b"),
    (None, "no id here at all", "en", "b"),
    (9, "copy of one text that is the same", "en", "a"),
    (10, "copy of one text that is the same", "en", "a"),
    (10, "copy of one text that is the same", "en", "a"),
    (-11, "A  double  blank and a-b_c 'quoted' it's we'll", "en", ""),
    (12, "Der Hund läuft über die Straße und schläft.", "de", "a"),
]


def rows():
    return [(i, t, lang, source, len(t or "")) for i, t, lang, source in TEXTS]


def odd_docs(spark, clashing: bool = True):
    df = spark.createDataFrame(rows(), DOCS).repartition(3)
    return df.withColumns({c: F.lit("x") for c in CLASHING}) if clashing else df


def no_docs(spark):
    return spark.createDataFrame([], DOCS)


def library_ids(vocab: str):
    """The ids that a fresh tokenizer of the library gives by its plain call, as bytes."""
    import numpy as np
    from tokenizers import Tokenizer

    from wagerlens.llm.tokens import vocabulary

    plain = Tokenizer.from_file(vocabulary(vocab))
    return lambda text: np.array(plain.encode(text or "", add_special_tokens=False).ids, "<u4").tobytes()
