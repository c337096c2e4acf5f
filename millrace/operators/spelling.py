"""Correct misspelt values to the known spelling that is nearest, at most two edits away.

Two words at most two edits apart have a common rest when up to two characters are deleted from
each. So all such deletions of the known words are an index, those of the values look it up, and only
pairs that meet are compared in full. Deleting from the beginning of a word is enough: where the beginnings
differ by two edits, up to two deletions from each, the last characters included, make them equal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

EDITS = 2
BEGINNING = 12  # characters that deletions are taken from, so a word of any length has 79 of them


def deletions(word: Column, edits: int = EDITS) -> Column:
    """The beginning of a word and what is left of it after up to ``edits`` deletions, each once."""
    left = F.array(F.substring(word, 1, BEGINNING))
    for _ in range(edits):
        shorter = F.flatten(
            F.transform(
                left,
                lambda w: F.transform(
                    F.sequence(F.lit(1), F.greatest(F.length(w), F.lit(1))),
                    lambda i: F.concat(F.substr(w, F.lit(1), i - 1), F.substr(w, i + 1)),
                ),
            )
        )
        left = F.array_distinct(F.concat(left, shorter))
    return left


def nearest_spelling(values: DataFrame, column: str, known: DataFrame, spelling: str, *, edits: int = EDITS) -> DataFrame:
    """value, corrected, distance for every distinct value of the column that is not NULL.

    ``corrected`` is the known spelling with the fewest edits (insertions, deletions, substitutions). It is
    NULL if there is none within ``edits``, or if several are equally near: a tie is not for a rule to
    decide. A known spelling is its own correction. Every value counts once, however many rows have it.
    """
    found = values.select(F.col(f"`{column}`").alias("value")).filter("value IS NOT NULL").distinct()
    words = known.select(F.col(f"`{spelling}`").alias("word")).filter("word IS NOT NULL").distinct()
    asked = found.select("value", F.explode(deletions(F.col("value"), edits)).alias("rest"))
    index = words.select("word", F.explode(deletions(F.col("word"), edits)).alias("rest"))
    # a pair meets in several rests: the distance is that of the pair, whichever it is seen through
    near = asked.join(index, "rest").select("value", "word", F.levenshtein("value", "word", edits).alias("distance")).filter("distance >= 0")
    best = near.groupBy("value", "distance").agg(F.min("word").alias("first"), F.max("word").alias("last"))
    best = best.groupBy("value").agg(F.min_by(F.struct("distance", "first", "last"), "distance").alias("best"))
    chosen = F.when(F.col("best.first") == F.col("best.last"), F.col("best.first"))
    return found.join(best, "value", "left").select("value", chosen.alias("corrected"), F.col("best.distance").alias("distance"))


def correct_spelling(df: DataFrame, column: str, known: DataFrame, spelling: str, name: str, *, edits: int = EDITS) -> DataFrame:
    """All rows with the corrected value as column ``name``; NULL where there is no one nearest spelling."""
    pairs = nearest_spelling(df, column, known, spelling, edits=edits).select(F.col("value").alias("_value"), F.col("corrected").alias("_corrected"))
    joined = df.join(pairs, F.col(f"`{column}`") == F.col("_value"), "left")
    return joined.withColumn(name, F.col("_corrected")).drop("_value", "_corrected")
