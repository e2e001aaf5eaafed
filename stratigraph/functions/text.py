"""Names as keys: Unicode normalisation is the one thing Spark has no built-in for, so only texts beyond ASCII go
through a vectorised Python function."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Letters that decomposition alone would lose or shorten.
TRANSLITERATION = {
    "ä": "ae", "ö": "oe", "ü": "ue", "Ä": "Ae", "Ö": "Oe", "Ü": "Ue",
    "ß": "ss", "æ": "ae", "Æ": "Ae", "ø": "oe", "Ø": "Oe",
    "å": "aa", "Å": "Aa", "đ": "d", "Đ": "D", "ł": "l", "Ł": "L",
    "þ": "th", "Þ": "Th", "ð": "d", "Ð": "D", "œ": "oe", "Œ": "Oe",
}

_ASCII = "^[\\x00-\\x7F]*$"


@F.pandas_udf(StringType())
def nfc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: unicodedata.normalize("NFC", x), na_action="ignore")


@F.pandas_udf(StringType())
def nfkd(s: pd.Series) -> pd.Series:
    return s.map(lambda x: unicodedata.normalize("NFKD", x), na_action="ignore")


def slug(c: Column) -> Column:
    """Lower-case ASCII words joined by _; `unknown` where nothing is left."""
    t = F.trim(c)
    for letter, plain in TRANSLITERATION.items():
        t = F.replace(t, F.lit(letter), F.lit(plain))
    plain = t.rlike(_ASCII)  # these texts aren't sent to Python
    ascii_only = F.when(plain, t).otherwise(F.regexp_replace(nfkd(F.when(~plain, t)), "[^\\x00-\\x7F]", ""))
    out = F.lower(F.btrim(F.regexp_replace(ascii_only, "[^A-Za-z0-9]+", "_"), F.lit("_")))
    return F.when(out == "", "unknown").otherwise(out)


def short_hash(c: Column, n: int = 6) -> Column:
    """First hex digits of SHA-256 over the trimmed, composed (NFC) name."""
    t = F.trim(c)
    plain = t.rlike(_ASCII)
    return F.substring(F.sha2(F.when(plain, t).otherwise(nfc(F.when(~plain, t))), 256), 1, n)
