"""Language of a text by string kernels.

The kernel of two texts is the number of character n-grams, n from 1 to 3, that occur in
both (presence, not counts), divided by the root of the product of their own numbers. A
Nystroem map over landmark texts turns it into a short vector, on which kernel ridge
regression separates each language from the rest. Texts are scored in batches: their
presence rows times the presence of the landmarks is one matrix product.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from millrace.llm.common import portions, within
from millrace.session import materialise

SAMPLE, PER_LANG = 3000, 600  # texts the model is fitted on, at most: in all and of one language
LANDMARKS = 160
SAMPLE_BYTES = 1 << 15  # of a drawn text on average, at most; every text is scored whole
RIDGE = 1e-3
LETTERS = 64  # classes of characters: 0 for whatever is no letter
GRAMS = LETTERS + LETTERS**2 + LETTERS**3
ROWS_AT_ONCE, CHARACTERS_AT_ONCE = 64, 1 << 20
UNKNOWN = "und"


def letter_classes() -> np.ndarray:
    """The class of every code point: 0 for no letter, 1 to 26 for a-z, 27 to 63 for others by rule."""
    classes = np.zeros(0x110000, dtype=np.uint8)
    letters = np.array([c for c in range(0x110000) if chr(c).isalpha()])
    classes[letters] = 27 + letters % 37
    for c in range(26):
        classes[ord("a") + c] = classes[ord("A") + c] = 1 + c
    return classes


_classes: list[np.ndarray] = []


def _stretches(text: str) -> Iterator[np.ndarray]:
    """Classes of a lower-cased text between two boundaries, in stretches that share two characters."""
    if not _classes:
        _classes.append(letter_classes())
    text = f" {text.lower()} "
    for i in range(0, max(1, len(text) - 2), CHARACTERS_AT_ONCE):
        points = text[i : i + CHARACTERS_AT_ONCE + 2].encode("utf-32-le", "replace")
        yield _classes[0][np.frombuffer(points, dtype=np.uint32)].astype(np.int32)


def presence(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """A row of GRAMS zeros and ones for each text, and whether it has a letter.

    Each text stands between two boundaries of class 0, like a space.
    """
    rows = np.zeros((len(texts), GRAMS), dtype=np.uint8)
    lettered = np.zeros(len(texts), dtype=bool)
    for k, text in enumerate(texts):
        here = rows[k]
        for c in _stretches(text or ""):
            lettered[k] |= c.any()
            two = c[:-1] * LETTERS + c[1:]
            here[c] = 1
            here[LETTERS + two] = 1
            here[LETTERS + LETTERS**2 + two[:-1] * LETTERS + c[2:]] = 1
    return rows, lettered


@dataclass
class Model:
    languages: list[str]
    grams: np.ndarray  # those that occur in a landmark
    landmarks: np.ndarray  # grams x landmarks, zeros and ones
    size: np.ndarray  # grams of each landmark
    weights: np.ndarray  # landmarks x languages: the Nystroem map and the regressions in one

    def kernel(self, rows: np.ndarray) -> np.ndarray:
        """The kernel of presence rows with the landmarks."""
        common = rows[:, self.grams].astype(np.float32) @ self.landmarks
        own = rows.sum(axis=1, dtype=np.int64)
        return common / np.sqrt(np.maximum(own, 1)[:, None] * self.size[None, :])

    def predict(self, texts: Sequence[str | None]) -> tuple[list[str], np.ndarray]:
        """A language and a score between 0 and 1 for each text; UNKNOWN and 0 without a letter."""
        langs, scores = [], []
        for part in portions([len(t or "") for t in texts], CHARACTERS_AT_ONCE):
            for i in range(part.start, part.stop, ROWS_AT_ONCE):
                rows, lettered = presence(texts[i : min(part.stop, i + ROWS_AT_ONCE)])
                votes = self.kernel(rows) @ self.weights if len(self.languages) else np.zeros((len(rows), 0))
                for vote, known in zip(votes, lettered):
                    if not known or not len(vote):
                        langs.append(UNKNOWN)
                        scores.append(0.0)
                    else:  # targets were 1 and -1
                        best = int(vote.argmax())
                        langs.append(self.languages[best])
                        scores.append(float(np.clip((vote[best] + 1) / 2, 0, 1)))
        return langs, np.array(scores)


def fit(texts: Sequence[str], langs: Sequence[str], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """Landmarks are dealt to the languages in turn; one-versus-rest ridge regression on their map."""
    names = sorted(set(langs))
    if not names:
        return Model([], np.zeros(0, int), np.zeros((0, 0), np.float32), np.zeros(0), np.zeros((0, 0)))
    by_lang = {n: [i for i, l in enumerate(langs) if l == n] for n in names}
    turns = [by_lang[n][k] for k in range(max(map(len, by_lang.values()))) for n in names if k < len(by_lang[n])]
    marks = turns[:landmarks]
    rows, _ = presence([texts[i] for i in marks])
    grams = np.flatnonzero(rows.any(axis=0))
    matrix = rows[:, grams].T.astype(np.float32)
    model = Model(names, grams, matrix, rows.sum(axis=1, dtype=np.int64).astype(np.float64), np.zeros((len(marks), len(names))))
    between = model.kernel(rows).astype(np.float64)
    value, vector = np.linalg.eigh((between + between.T) / 2)
    keep = value > 1e-8 * value.max()
    to_map = vector[:, keep] / np.sqrt(value[keep])  # Nystroem: kernel with landmarks to features
    features = []
    for i in range(0, len(texts), ROWS_AT_ONCE):
        features.append(model.kernel(presence(texts[i : i + ROWS_AT_ONCE])[0]) @ to_map)
    x = np.concatenate(features)
    y = np.where(np.array(langs)[:, None] == np.array(names)[None, :], 1.0, -1.0)
    # languages weigh alike, however many texts each has
    weight = np.array([1 / len(by_lang[l]) for l in langs])[:, None]
    normal = x.T @ (weight * x) + ridge * np.eye(x.shape[1])
    model.weights = to_map @ np.linalg.solve(normal, x.T @ (weight * y))
    return model


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that nothing is learned from; a null doc_id is held out too."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(True))


def learned(docs: DataFrame) -> Model:
    """Fitted on up to PER_LANG texts of each language that are not held out, SAMPLE in all, by a hash of the id.

    Together they have up to SAMPLE * SAMPLE_BYTES bytes; a text that no longer fits is passed over.
    Languages are counted first, so that only about twice the wanted rows of each are ranked.
    """
    usable = docs.filter(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    digest = F.md5(F.col("doc_id").cast("string"))
    ids = usable.select("doc_id", "lang", F.xxhash64("text").alias("text_key"), digest.alias("place"), F.octet_length("text").alias("size"))
    counts = materialise(ids.groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "languages")
    share = F.conv(F.substring("place", 1, 8), 16, 10).cast("double") / 2**32
    few = ids.join(counts, "lang").filter(share < F.lit(2.0 * PER_LANG) / F.col("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("place", "doc_id", "text_key"))
    drawn = few.distinct().withColumn("rank", rank).filter(F.col("rank") <= PER_LANG).orderBy("rank", "lang").limit(SAMPLE)
    keys = ["doc_id", "lang", "text_key"]
    rows = usable.select("doc_id", "lang", "text", F.xxhash64("text").alias("text_key"))
    drawn = drawn.select(*keys, "rank", "size")
    found = drawn.collect()  # bounded by SAMPLE
    fits = within([r["size"] for r in found], SAMPLE * SAMPLE_BYTES)
    chosen = docs.sparkSession.createDataFrame([r for r, fit in zip(found, fits) if fit], drawn.schema).drop("size")
    sample = rows.join(F.broadcast(chosen), keys).groupBy(*keys, "rank").agg(F.first("text").alias("text"))
    sample = sample.toPandas().sort_values(["rank", "lang"])
    return fit(sample["text"].tolist(), sample["lang"].tolist())


PREDICTION = StructType([StructField("lang_pred", StringType()), StructField("score", DoubleType())])


def predict_documents(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row.

    The model learns from text and lang of documents with crc32(doc_id) mod 4 other than 2.
    A text that is null or has no letter is ``und`` with score 0, and so is every text when
    there is nothing to learn from. Repeated rows get equal answers; other columns are left out.
    """
    shared = docs.sparkSession.sparkContext.broadcast(learned(docs))  # bounded by landmarks and grams

    @F.pandas_udf(PREDICTION)
    def predict(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in texts:
            langs, scores = shared.value.predict(part.tolist())
            yield pd.DataFrame({"lang_pred": langs, "score": scores})

    return docs.select("doc_id", held_out().alias("held_out"), predict("text").alias("found")).select(
        "doc_id", "held_out", "found.*"
    )
