"""Text expressions: tokenising, keyword tests, address clean-up, split with Java-like trimming."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tokens(text: str | Column) -> Column:
    """Lower-case words of ASCII letters, digits and underscore; empties dropped."""
    return F.filter(F.split(F.lower(_col(text)), r"\W+"), lambda w: w != "")


def token_rows(df: DataFrame, text: str, out: str = "word") -> DataFrame:
    """One row per word of ``text``; the empties go in a plain filter, inside generated code."""
    return df.select(F.explode(F.split(F.lower(F.col(text)), r"\W+")).alias(out)).where(F.col(out) != "")


def drop_trailing_empties(parts: Column) -> Column:
    """Remove empty strings at the end only, keeping inner ones."""
    last = F.array_max(F.transform(parts, lambda p, i: F.when(p != "", i + 1).otherwise(0)))
    return F.slice(parts, F.lit(1), F.coalesce(last, F.lit(0)))


def whitespace_words(text: str | Column) -> Column:
    return drop_trailing_empties(F.split(_col(text), r"\s"))


def contains_all(text: str | Column, words: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.contains(_col(text), F.lit(w)) for w in words])


def english_tweet_words(json: str | Column) -> Column:
    """Words of the ``text`` field where ``user.lang`` is ``en``; null for other messages."""
    parsed = F.from_json(_col(json), "user struct<lang:string>, text string")
    words = F.filter(F.split(F.lower(parsed["text"]), r"\s+"), lambda w: w != "")
    return F.when(parsed["user"]["lang"] == "en", words)


def normalise_address(*parts: str | Column) -> Column:
    """Upper case, non-word characters to single blanks, trimmed, joined by ``, ``."""
    def clean(c: str | Column) -> Column:
        spaced = F.regexp_replace(F.upper(_col(c).cast("string")), r"\W", " ")
        return F.trim(F.regexp_replace(spaced, r"\s+", " "))

    return F.concat_ws(", ", *[clean(p) for p in parts])


def split_as_array(text: str | Column, delimiter: str) -> Column:
    """Regex split; null or empty text gives null, trailing empty parts are dropped."""
    c = _col(text)
    return F.when(F.length(c) > 0, drop_trailing_empties(F.split(c, delimiter)))


def split_rows(df: DataFrame, text: str, delimiter: str = r"\s+", outer: bool = False) -> DataFrame:
    """One row per part: position, whether it lies in the second half, the part, its length."""
    parts = F.split(F.col(text), delimiter)
    explode = F.posexplode_outer if outer else F.posexplode
    rows = df.select("*", F.size(parts).alias("__n"), explode(parts).alias("pos", "word"))
    return rows.withColumns({
        "second_half": F.col("pos") * 2 > F.col("__n"),
        "word_length": F.length("word"),
    }).drop("__n")
