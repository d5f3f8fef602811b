"""Small tables for the tests of the training-data operators."""

from __future__ import annotations

import random

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts, ids=None, sources=None):
    """A documents table; the id defaults to the place in the list."""
    ids = range(len(texts)) if ids is None else ids
    sources = ["s"] * len(texts) if sources is None else sources
    rows = [(i, t, "en", s, len(t) if t is not None else None) for i, t, s in zip(ids, texts, sources, strict=True)]
    return spark.createDataFrame(rows, DOCUMENTS).repartition(3)


def prose(n_docs: int, seed: int, words: int = 60, vocabulary: int = 400) -> list[str]:
    rng = random.Random(seed)
    known = ["".join(rng.choice("abcdeéñß") for _ in range(rng.randint(1, 8))) for _ in range(vocabulary)]
    return [" ".join(rng.choice(known) for _ in range(rng.randint(1, words))) for _ in range(n_docs)]


#: Columns whose names the operators also use inside.
CLASHING = "_id _th _text _owner _doc _lost row nth block grp fp root size target copies p h c word keys token spans blob set rank score".split()


def with_clashes(df):
    from pyspark.sql import functions as F

    return df.withColumns({c: F.lit("x") for c in CLASHING if c not in df.columns})


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
