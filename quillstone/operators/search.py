"""Finding phrases in many texts by an equi-join on hashed words, before any text is compared."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import quoting
from ..scratch import written
from .joins import small

#: Words of a phrase that are looked up (its first ones; shorter phrases have fewer).
KEY_WORDS = 3


def bare_words(text: Column) -> Column:
    """The words of a text between single spaces, without opening marks before and closing marks after them."""
    return F.transform(F.split(text, " "), lambda w: F.rtrim(F.ltrim(w, F.lit(quoting.OPENERS)), F.lit(quoting.CLOSERS)))


def _hashes(text: Column) -> Column:
    return F.transform(bare_words(text), lambda w: F.xxhash64(w))


def _key(h: Column, at: Column, n: int) -> Column:
    """Hash of n words from a place on, made of their hashes."""
    return F.xxhash64(F.lit(n), *[F.get(h, at + k) for k in range(n)])


def phrase_key(text: Column) -> Column:
    """Hash of the first words of a phrase, and of how many they are."""
    h = _hashes(text)
    out = _key(h, F.lit(0), KEY_WORDS)
    for n in range(KEY_WORDS - 1, 0, -1):
        out = F.when(F.size(h) == n, _key(h, F.lit(0), n)).otherwise(out)
    return out


def phrase_keys(text: Column, lengths: list[int]) -> Column:
    """The hashes that phrases of so many key words have, wherever they begin in a text. Each word is hashed
    once (the array of one keeps its hashes at hand for all places)."""
    if not lengths:
        return F.array().cast("array<bigint>")
    held = F.array(_hashes(text))
    of = lambda n: F.flatten(F.transform(held, lambda h: F.transform(F.slice(h, F.lit(1), F.greatest(F.size(h) - n + 1, F.lit(0))), lambda x, i: _key(h, i, n))))
    return F.array_distinct(F.concat(*[of(n) for n in lengths]))


def phrase_pairs(texts: DataFrame, key: list[str], body: str, phrases: DataFrame, phrase_id: str, phrase: str) -> DataFrame:
    """(key, phrase_id): which texts can hold which phrases at word edges; all that do, and few others.

    Both sides are normalised (single spaces). Texts give one row a word position, narrow and without the
    text, to an equi-join with the phrases: broadcast if they are few, by shuffle otherwise.
    """
    keyed = phrases.select(phrase_id, phrase_key(F.col(phrase)).alias("h"), F.least(F.size(F.split(phrase, " ")), F.lit(KEY_WORDS)).alias("n_key"))
    lengths = sorted(r[0] for r in keyed.select("n_key").distinct().collect())  # at most KEY_WORDS numbers
    spread = texts.select(*key, F.explode(phrase_keys(F.col(body), lengths)).alias("h"))
    # Written, so that the texts are gone through once however the pairs are used.
    return written(spread.join(small(keyed.select(phrase_id, "h")), "h").select(*key, phrase_id).distinct(), "phrase-pairs")


def located(texts: DataFrame, key: list[str], body: str, phrases: DataFrame, phrase_id: str, phrase: str, prepare=None) -> DataFrame:
    """key, phrase_id, body, phrase, start, end: the first accepted place of each phrase in each text that
    has one. ``prepare`` normalises the body of candidate texts; phrases are normalised already."""
    ready = texts.withColumn(body, prepare(F.col(body))) if prepare else texts
    pairs = phrase_pairs(ready.select(*key, body), key, body, phrases, phrase_id, phrase)
    joined = texts.select(*key, body).join(small(pairs, 100_000), key)
    if prepare:
        joined = joined.withColumn(body, prepare(F.col(body)))
    both = joined.join(small(phrases.select(phrase_id, phrase)), phrase_id).filter(F.contains(F.col(body), F.col(phrase)))
    spans = both.withColumn("span", quoting.locate(F.col(body), F.col(phrase))).filter("span.start IS NOT NULL")
    return spans.select(*key, phrase_id, body, phrase, F.col("span.start").alias("start"), F.col("span.end").alias("end"))
