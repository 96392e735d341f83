"""Which texts resemble which patterns, by alignment of words, over the pairs that a bound admits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import quoting
from .joins import small

THRESHOLD, LEAST_MATCHED = 0.85, 6


def bounded_pairs(patterns: DataFrame, pattern_id: str, texts: DataFrame, key: list[str], share: float) -> DataFrame:
    """(pattern_id, key): the pairs in which the text holds at least ``share`` of the pattern's distinct words.

    patterns: pattern_id, words; texts: key, words (distinct word arrays). Of a pattern with n words at least
    one of its rarest n - ceil(share * n) + 1 must be in such a text: only these words are joined, so common
    words make no pairs. The bound itself is tested on the pairs that are left.
    """
    spread = texts.select(*key, F.explode("words").alias("w"))
    counts = spread.groupBy("w").agg(F.count(F.lit(1)).alias("n_texts"))
    rare = patterns.select(pattern_id, F.explode("words").alias("w")).join(counts, "w", "left")
    ranked = rare.groupBy(pattern_id).agg(F.array_sort(F.collect_list(F.struct(F.coalesce("n_texts", F.lit(0)).alias("n"), "w"))).alias("sorted"))
    n = F.size("sorted")
    prefix = ranked.select(pattern_id, F.explode(F.slice("sorted", F.lit(1), (n - F.ceil(F.lit(share) * n) + 1).cast("int"))).alias("r")).select(pattern_id, F.col("r.w").alias("w"))
    pairs = spread.join(small(prefix, 200_000), "w").select(pattern_id, *key).distinct()
    both = pairs.join(small(patterns.withColumnRenamed("words", "pattern_words")), pattern_id).join(texts, key)
    held = F.size(F.array_intersect("pattern_words", "words"))
    return both.filter(held >= F.lit(share) * F.size("pattern_words")).select(pattern_id, *key)


def resembling(patterns: DataFrame, pattern_id: str, texts: DataFrame, key: list[str], threshold: float = THRESHOLD) -> DataFrame:
    """pattern_id, key, score of pairs that reach the threshold. patterns and texts have text columns
    ``words`` (arrays, in order, with repeats). The score is matched / (matched + cost) of the best
    alignment of the whole pattern with any stretch of the text; at least LEAST_MATCHED words, or all, match.

    matched <= the pattern's words that the text holds, and the words it lacks each cost one: so the share of
    distinct words held is at least threshold less what repeats may add, which the bound allows for.
    """
    distinct = lambda df, *c: df.select(*c, F.array_distinct("words").alias("words"))
    # A pattern of n words with d distinct ones that misses m of these costs m at least: (n - m) / n >= threshold.
    sized = patterns.withColumn("share", 1 - (1 - F.lit(threshold)) * F.size("words") / F.size(F.array_distinct("words")))
    least = sized.agg(F.min("share")).first()[0]
    if least is None:
        return patterns.select(pattern_id).limit(0).crossJoin(texts.select(*key).limit(0)).withColumn("score", F.lit(0.0))
    pairs = bounded_pairs(distinct(patterns, pattern_id), pattern_id, distinct(texts, *key), key, max(0.01, least))
    both = pairs.join(small(patterns.select(pattern_id, F.col("words").alias("pattern_words"))), pattern_id).join(texts.select(*key, "words"), key)
    scored = both.withColumn("score", quoting.alignment(F.col("pattern_words"), F.col("words")))
    enough = F.size("pattern_words") * F.col("score") >= F.least(F.lit(LEAST_MATCHED), F.size("pattern_words")) * F.lit(threshold)
    return scored.filter((F.col("score") >= threshold) & enough).select(pattern_id, *key, "score")
