"""Text normalisation and predicates for detected words."""

from __future__ import annotations

import re
import unicodedata
from difflib import SequenceMatcher
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

# Words that are never names, and those that are none in tables.
NO_NAMES = (
    "bre", "defence", "expedia", "football club", "forwards", "goalkeeper", "hollywood", "lfc", "midfield",
    "premier league", "standard", "standard chartered", "substitutes",
)
NO_TABLE_NAMES = (*NO_NAMES, "captain", "coach", "df", "elite", "fw", "gk", "head coach", "mf", "team lineup")
NUMBER, TEXT = "shirt_number_candidate", "text"
SUBSTITUTES = r"\bsubstitutes?\b"


def plain(value: object) -> str:
    """Lower-case words of ASCII letters and digits, accents removed, single blanks."""
    return _plain(str(value))


@lru_cache(1 << 14)
def _plain(value: str) -> str:
    letters = unicodedata.normalize("NFKD", value)
    letters = "".join(c for c in letters if not unicodedata.combining(c)).casefold()
    return " ".join(re.findall("[a-z0-9]+", letters))


@lru_cache(1 << 16)
def alike(left: str, right: str) -> float:
    """Matching-block ratio of two normalised texts, in this order; 0 if one is empty."""
    return SequenceMatcher(None, left, right).ratio() if left and right else 0.0


@F.pandas_udf(StringType())
def normalized(text: pd.Series) -> pd.Series:
    return text.map(plain, na_action="ignore")


@F.pandas_udf(StringType())
def nfc(text: pd.Series) -> pd.Series:
    return text.map(lambda t: unicodedata.normalize("NFC", t.strip()), na_action="ignore")


@F.pandas_udf(DoubleType())
def similarity(left: pd.Series, right: pd.Series) -> pd.Series:
    return pd.Series([alike(plain(a), plain(b)) if a is not None and b is not None else 0.0 for a, b in zip(left, right)])


@F.pandas_udf(StringType())
def ascii_folded(text: pd.Series) -> pd.Series:
    return text.map(lambda t: unicodedata.normalize("NFKD", t).encode("ascii", "ignore").decode(), na_action="ignore")


def normalized_ascii(text: Column) -> Column:
    """normalized() for texts of ASCII alone, without Python."""
    return F.trim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " "))


def safe_stem(stem: Column, fold: bool = True) -> Column:
    """A file-name stem of letters, digits, dots, lines; ``video`` if nothing is left."""
    kept = F.regexp_replace(ascii_folded(stem) if fold else stem, "[^A-Za-z0-9._-]+", "_")
    kept = F.regexp_replace(kept, "^[._-]+|[._-]+$", "")
    return F.coalesce(F.when(kept != "", kept), F.lit("video"))


def text_type(text: Column) -> Column:
    """Whether a text is a shirt number of 1 to 99."""
    number = F.when(text.rlike("^[0-9]+$"), text.try_cast("long"))
    return F.when(number.between(1, 99), NUMBER).otherwise(TEXT)


def is_shirt_number(kind: Column, text: Column) -> Column:
    return F.coalesce((kind == NUMBER) & text.try_cast("double").between(1, 99), F.lit(False))


def is_name(norm: Column, excluded: tuple = NO_NAMES) -> Column:
    """Of a normalised text: two letters or more, at most 40 characters, not excluded."""
    letters = F.length(F.regexp_replace(norm, "[^a-z]", ""))
    return (norm != "") & ~norm.isin(*excluded) & (letters >= 2) & (F.length(norm) <= 40)


def inline_player(text: Column, norm_of=normalized_ascii) -> Column:
    """struct(number, name) of texts like ``10 Name``; null for others."""
    number = F.regexp_extract(text, r"^\s*([0-9]{1,2})\s+(.+?)\s*$", 1)
    name = F.regexp_extract(text, r"^\s*([0-9]{1,2})\s+(.+?)\s*$", 2)
    value = number.try_cast("int")
    return F.when(value.between(1, 99) & is_name(norm_of(name), NO_TABLE_NAMES), F.struct(value.alias("number"), name.alias("name")))


def clip_name(stem: Column, number: Column, start_tag: Column, end_tag: Column) -> Column:
    return F.format_string("%s_lineup_%02d_%s_to_%s.mp4", stem, number, start_tag, end_tag)


def path_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)$", 1)


def path_stem(path: Column) -> Column:
    return F.regexp_replace(path_name(path), r"(?<=.)\.[^.]*$", "")


def parent_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)/[^/]*$", 1)
