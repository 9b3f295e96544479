"""The only Python that runs inside tasks: four small Arrow-batched functions.

Callers send null for every row that a built-in expression can settle, so only the few rows with
an entity, a non-ASCII name or an undecided pair of names are worked on here.
"""

from __future__ import annotations

import html
import sys
import unicodedata
from difflib import SequenceMatcher

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ship these functions with the job, so that executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@F.pandas_udf(T.StringType())
def unescape_texts(values: pd.Series) -> pd.Series:
    return values.map(html.unescape, na_action="ignore")


@F.pandas_udf(T.ArrayType(T.StringType()))
def unescape_arrays(values: pd.Series) -> pd.Series:
    return values.map(lambda items: None if items is None else [html.unescape(x) for x in items])


def _fold(word: str) -> str:
    marks_apart = unicodedata.normalize("NFKD", word)
    bare = "".join(c for c in marks_apart if not unicodedata.combining(c)).lower()
    return "".join(c for c in bare if c.isascii() and c.isalnum())


@F.pandas_udf(T.StringType())
def fold_unicode(values: pd.Series) -> pd.Series:
    """Words without accents, case and punctuation."""
    return values.map(lambda text: " ".join(map(_fold, text.split())), na_action="ignore")


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def similarity_to_each(words: pd.Series, other: pd.Series) -> pd.Series:
    """Matching-blocks ratio of each word against one other word; null words stay null."""
    def ratios(items, target):
        if items is None or target is None:
            return None
        return [None if w is None else SequenceMatcher(None, w, target).ratio() for w in items]

    return pd.Series([ratios(w, t) for w, t in zip(words, other)])
