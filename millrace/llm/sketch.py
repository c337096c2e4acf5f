"""Document fingerprints: bottom-k sketches of word-shingle hashes, in DataFrame operations only.

A sketch is the sorted array of the ``k`` least distinct 64-bit hashes of a set of
shingles. Sketches of parts merge into the sketch of the whole, and two sketches tell
resemblance, containment and the number of distinct shingles.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import IntegralType

from millrace.session import materialise

K = 128
SHINGLE = 5  # words
TASK_BYTES = 1 << 24  # text that is put in order in one task, about
HASHES = 2.0**64


def word_list(text: Column) -> Column:
    """The words of a text; none for NULL."""
    spaces = F.translate(F.coalesce(text, F.lit("")), "\t\n\x0b\x0c\r", "     ")
    return F.array_remove(F.split(spaces, " "), "")


def shingle_hashes(text: Column, shingle: int = SHINGLE) -> Column:
    """A hash for each run of words; one for all words of a shorter text, none without words.

    Words are hashed once, and a run is the hash of its words' hashes.
    """
    hashes = F.transform(word_list(text), lambda w: F.xxhash64(w))

    def runs(h: Column) -> Column:
        longer = F.transform(
            F.slice(h, F.lit(1), F.greatest(F.size(h) - (shingle - 1), F.lit(0))),
            lambda x, i: F.xxhash64(x, *[F.get(h, i + j) for j in range(1, shingle)]),
        )
        return F.when(F.size(h) >= shingle, longer).when(F.size(h) > 0, F.array(F.xxhash64(h))).otherwise(
            F.array().cast("array<long>")
        )

    # one more lambda names the hashes, so that they are computed once
    return F.flatten(F.transform(F.array(hashes), runs))


def least(hashes: Column, k: int = K) -> Column:
    return F.slice(F.array_sort(F.array_distinct(hashes)), 1, k)


def sketch(text: Column | str, k: int = K, shingle: int = SHINGLE) -> Column:
    """The sketch of a text; empty for NULL and for texts without words."""
    return least(shingle_hashes(F.col(text) if isinstance(text, str) else text, shingle), k)


def merge(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of both sets together."""
    return least(F.concat(a, b), k)


def merge_groups(df: DataFrame, keys: Sequence[str], name: str, k: int = K) -> DataFrame:
    """The sketch of all rows of a group.

    Hashes are made distinct map-side, and of a group only the ``k`` least of each task are
    shuffled for the rank, so a group of any size is ``k`` rows per task.
    """
    hashes = df.select(*keys, F.explode_outer(name).alias("_hash")).distinct()
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("_hash").asc_nulls_last()))
    few = hashes.withColumn("_rank", rank).filter(F.col("_rank") <= k)
    return few.groupBy(*keys).agg(F.array_sort(F.collect_list("_hash")).alias(name))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Share of common shingles among all: of the ``k`` least of both, those in both. 1 for two empty sets."""
    both = merge(a, b, k)
    common = F.size(F.array_intersect(F.array_intersect(both, a), b))
    return F.when(F.size(both) == 0, 1.0).otherwise(common / F.size(both))


def distinct_shingles(a: Column, k: int = K) -> Column:
    """How many distinct shingles there are: exact below ``k``, from the k-th least hash above."""
    share = (F.element_at(a, -1).cast("double") + HASHES / 2 + 1) / HASHES
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / share)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Share of the first set that is in the second, among the hashes up to where both sketches are complete.

    Rough where the first set is much smaller than the second: then few of its hashes lie so low.
    """
    top = F.lit(2**63 - 1)
    upto = F.least(*[F.when(F.size(x) < k, top).otherwise(F.element_at(x, -1)) for x in (a, b)])
    low = F.filter(a, lambda h: h <= upto)
    return F.when(F.size(a) == 0, 1.0).when(F.size(low) == 0, 0.0).otherwise(F.size(F.array_intersect(low, b)) / F.size(low))


def written(a: Column) -> Column:
    """A sketch as text: 16 hexadecimal digits for each hash."""
    return F.array_join(F.transform(a, lambda h: F.lower(F.lpad(F.hex(h), 16, "0"))), "")


def _cuts(docs: DataFrame) -> tuple[list[float], dict[int, int], int]:
    """doc_ids at which the documents are cut into stretches of about TASK_BYTES of text, and by how many
    stretches the rows of one doc_id, and those of none, are cut further."""
    size = F.octet_length("text")
    without = F.sum(F.when(F.col("doc_id").isNull(), size))
    seen = docs.agg(*[F.coalesce(x, F.lit(0)).alias(n) for x, n in ((F.sum(size), "bytes"), (without, "without"))]).first()
    parts = max(1, -(-int(seen.bytes) // TASK_BYTES))
    if parts == 1:
        return [], {}, 1
    ids = docs.select(F.col("doc_id").cast("double").alias("id")).filter("id is not null")
    cuts = ids.approxQuantile("id", [i / parts for i in range(1, parts)], 1 / (8 * parts))
    # a cut that comes again is a doc_id with the rows of a stretch; as a double it must be one doc_id
    whole = isinstance(docs.schema["doc_id"].dataType, IntegralType)
    often = {int(c): n + 1 for c, n in Counter(cuts).items() if n > 1 and whole and abs(c) < 2**53}
    return sorted(set(cuts)), often, min(1 << 20, max(1, -(-int(seen.without) // TASK_BYTES)))


def in_order(docs: DataFrame) -> DataFrame:
    """doc_id, text, fp (the sketch), next_text and next_fp: of the next document, of the first after the last.

    Stretches of doc_id are put in order side by side, in one shuffle of the texts. Behind
    each stretch stands a copy of the first document of the next one. Rows with one doc_id
    follow each other by a hash of the text, by which very many of them are several stretches;
    a null doc_id comes last.
    """
    key = [F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.xxhash64("text").alias("h")]
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    cuts, often, without = _cuts(rows)
    if cuts or without > 1:
        last = len(cuts) + 1
        if cuts:
            at = Bucketizer(splits=[-float("inf"), *cuts, float("inf")], inputCol="_id", outputCol="part", handleInvalid="keep")
            placed = at.transform(rows.withColumn("_id", F.col("doc_id").cast("double"))).drop("_id")
        else:
            placed = rows.withColumn("part", F.lit(0))
        part = F.when(F.col("doc_id").isNull(), last).otherwise(F.col("part")).cast("long")

        def turn(n: int | Column) -> Column:
            """The place of the hash among ``n`` equal ranges."""
            return F.least(F.floor((F.xxhash64("text") / HASHES + 0.5) * n), (n if isinstance(n, Column) else F.lit(n)) - 1)

        # a stretch begins with the doc_id it is cut at; rows of other doc_ids follow
        others = F.lit((1 << 20) - 1).cast("long")
        if often:
            n = F.try_element_at(F.create_map(*[F.lit(x).cast("long") for pair in often.items() for x in pair]), F.col("doc_id").cast("long"))
            others = F.when(n.isNotNull(), turn(n)).otherwise(others)
        within = F.when(F.col("doc_id").isNull(), turn(without) + (1 << 20)).otherwise(others)
        placed = placed.withColumn("part", part * (1 << 21) + within)
    else:
        placed = rows.withColumn("part", F.lit(0))
    placed = placed.select("part", "doc_id", "text", *key[::2])

    # the first of each stretch: a few bytes for each, then its text
    heads = placed.groupBy("part").agg(F.min(F.struct("none", "doc_id", "h")).alias("head"))
    order = Window.orderBy("part")  # one row per stretch
    before = F.coalesce(F.lag("part").over(order), F.max("part").over(Window.partitionBy(F.lit(0))))
    # written, so that its size is known before the join with the texts is planned
    heads = materialise(heads.withColumn("before", before).select(F.col("part").alias("p"), "before", "head"), "heads")
    same = (F.col("part") == F.col("p")) & F.col("h").eqNullSafe(F.col("head.h")) & F.col("doc_id").eqNullSafe(F.col("head.doc_id"))
    copies = placed.join(heads, same).groupBy("p", "before").agg(F.first("doc_id").alias("doc_id"), F.first("text").alias("text"))
    copies = copies.select(
        F.col("before").alias("part"), "doc_id", "text", F.lit(True).alias("none"), F.xxhash64("text").alias("h"), F.lit(True).alias("copy")
    )
    together = placed.withColumn("copy", F.lit(False)).unionByName(copies)
    # A range for each stretch: hashed, several would meet in one task. Sketches are made after the
    # shuffle, so that they are not shuffled themselves.
    stretches = len(cuts) + 1 + sum(often.values()) + without
    dealt = together.repartitionByRange(stretches, "part").withColumn("fp", sketch("text"))
    follow = Window.partitionBy("part").orderBy("copy", "none", "doc_id", "h")
    found = dealt.withColumns({"next_text": F.lead("text").over(follow), "next_fp": F.lead("fp").over(follow)})
    return found.filter(~F.col("copy")).select("doc_id", "text", "fp", "next_text", "next_fp")


def fingerprint_documents(docs: DataFrame, k: int = K) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next for every row.

    The edited text has the last quarter of its code points replaced by the first as many
    of the next document, or by all of them. A null text counts as empty; two empty texts
    have likeness 1. The only document is its own next one. Rows that share doc_id and text
    are documents of their own; other columns are left out.
    """
    n = F.length("text")
    quarter = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - quarter), F.substring("next_text", F.lit(1), quarter))
    rows = in_order(docs).withColumn("edited", edited)
    rows = rows.withColumn("edited_fp", sketch("edited", k))
    return rows.select(
        "doc_id",
        n.cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        written(F.col("fp")).alias("fingerprint"),
        written(F.col("edited_fp")).alias("edited_fingerprint"),
        resemblance(F.col("fp"), F.col("edited_fp"), k).alias("near_edited"),
        resemblance(F.col("fp"), F.col("next_fp"), k).alias("near_next"),
    )
