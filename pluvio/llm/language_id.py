"""Language identification by rank-order profiles.

Each language's profile is the ranking of its most frequent character n-grams (one to
three letters, word edges included). A document's most frequent n-grams are ranked the
same way, and the language whose profile is least out of place wins. Profiles are
counted over all training documents: tasks count words, turn them into n-gram counts,
and Spark adds these up; only the profiles (``depth`` n-grams a language) reach the
driver.
"""
from __future__ import annotations

import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pluvio.llm.common import fresh, widened, without

WORD = re.compile(r"[^\W\d_]+")
DEPTH = 400            # n-grams in a profile
GRAM = 3               # longest n-gram; three code points fit into 63 bits
EDGE = 0x20            # marks the edge of a word
TASK_CHARS = 1 << 20   # text that a task holds before it passes its counts on
UNKNOWN = "und"


def grams_of(words: list[str]) -> np.ndarray:
    """The n-grams of the words as packed code points, sorted, repeats included. A
    word's edge is the mark between it and its neighbour, so no n-gram of interest has
    the mark inside."""
    mark = chr(EDGE)
    text = mark + mark.join(words) + mark
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
    edge = points == EDGE
    out, packed, inside = [points[~edge]], points, np.zeros(len(points), bool)
    for n in range(2, GRAM + 1):
        packed = (packed[:-1] << 21) | points[n - 1:]
        if n > 2:
            inside = inside[:-1] | edge[n - 2:-1]
            out.append(packed[~inside])
        else:
            inside = inside[:-1]
            out.append(packed)
    keys = np.concatenate(out)
    keys.sort()
    return keys


def gram_counts(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-grams in order, and how often each occurs."""
    keys = grams_of(words)
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.diff(first, append=len(keys))


def _count(batches):
    """(lang, gram, n) of a partition, in parts of about TASK_CHARS characters."""
    held, size = defaultdict(list), 0

    def passed_on():
        for lang, words in held.items():
            if words:
                keys, n = gram_counts(words)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), pa.array(keys),
                                                  pa.array(n)], names=["lang", "gram", "n"])
        held.clear()

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            text = text.as_py()
            held[lang].extend(WORD.findall(text.lower()))
            size += len(text)
            if size > TASK_CHARS:
                yield from passed_on()
                size = 0
    yield from passed_on()


def fit_profiles(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
                 depth: int = DEPTH) -> dict[str, np.ndarray]:
    """The profile of each non-null language of ``docs``: packed n-grams, most frequent
    first (ties by n-gram). All rows with text count. Bound of what is collected:
    ``depth`` for each language."""
    counts = (docs.select(F.col(f"`{lang_col}`").cast("string").alias("lang"), F.col(f"`{text_col}`").alias("text"))
              .filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
              .mapInArrow(_count, "lang string, gram long, n long")
              .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    # a language may hold most of the n-grams: rank within slices first
    order = F.desc("n"), F.asc("gram")
    sliced = counts.withColumn("slice", F.pmod(F.xxhash64("gram"), F.lit(64)))
    top = (sliced.withColumn("r", F.row_number().over(Window.partitionBy("lang", "slice").orderBy(*order)))
           .filter(F.col("r") <= depth)
           .withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
           .filter(F.col("r") <= depth))
    out = defaultdict(list)
    for row in top.select("lang", "gram", "r").collect():
        out[row["lang"]].append((row["r"], row["gram"]))
    return {lang: np.array([g for _, g in sorted(v)], dtype=np.int64) for lang, v in sorted(out.items())}


class RankModel:
    """Out-of-place distances to all profiles at once."""

    def __init__(self, profiles: dict[str, np.ndarray], depth: int = DEPTH):
        self.langs, self.depth = list(profiles), depth
        self.keys = np.unique(np.concatenate(list(profiles.values()))) if profiles else np.empty(0, np.int64)
        self.ranks = np.full((len(self.langs), len(self.keys) + 1), -1, dtype=np.int64)
        for i, grams in enumerate(profiles.values()):
            self.ranks[i, np.searchsorted(self.keys, grams)] = np.arange(len(grams))

    def predict(self, text: str | None) -> tuple[str, float]:
        """(language, score): the score is 1 for a document whose ranks are those of the
        profile and 0 if none of its n-grams is in it."""
        if not text or not self.langs or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0
        words = WORD.findall(text.lower())
        keys, n = gram_counts(words)
        if len(n) > self.depth:  # all that reach the count of the last in the ranking
            enough = n >= np.partition(n, -self.depth)[-self.depth]
            keys, n = keys[enough], n[enough]
        top = keys[np.argsort(-n, kind="stable")[:self.depth]]
        at = np.searchsorted(self.keys, top)
        at[(at == len(self.keys)) | (self.keys[np.minimum(at, len(self.keys) - 1)] != top)] = len(self.keys)
        ranks = self.ranks[:, at]
        out_of_place = np.where(ranks < 0, self.depth, np.abs(ranks - np.arange(len(top))))
        distance = out_of_place.sum(axis=1)
        best = int(distance.argmin())
        return self.langs[best], float(1 - distance[best] / (self.depth * len(top)))


def predict_languages(docs: DataFrame, profiles: dict[str, np.ndarray], text_col: str = "text",
                      depth: int = DEPTH) -> DataFrame:
    """``docs`` plus lang_pred and score (0 to 1). ``und`` with score 0 for null text,
    text without a letter, or without profiles. Ties go to the first language by name.
    Extra columns with these names are replaced."""
    from pyspark.sql.pandas.types import to_arrow_schema
    docs = without(docs, *[c for c in ("lang_pred", "score") if c != text_col])
    schema = widened(docs, lang_pred=T.StringType(), score=T.DoubleType())
    arrow, at = to_arrow_schema(schema), docs.columns.index(text_col)
    model = RankModel(profiles, depth)

    def go(batches):
        for batch in batches:
            got = [model.predict(text.as_py()) for text in batch.column(at)]
            yield pa.RecordBatch.from_arrays(
                [*[c.cast(f.type) for c, f in zip(batch.columns, arrow, strict=False)],
                 pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())], schema=arrow)

    return docs.mapInArrow(go, schema)


def held_out(doc_id: Column) -> Column:
    """Documents that profiles are never learned from: crc32 of the id as text is 1
    modulo 3. A null id isn't held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             depth: int = DEPTH, training: DataFrame | None = None) -> DataFrame:
    """``docs`` plus held_out, lang_pred and score. Profiles come from the labelled rows
    of ``training`` (default: ``docs``) that aren't held out; a prediction sees the text
    only."""
    (flag,) = fresh(docs, "held")
    source = docs if training is None else training
    learn = source.filter(~held_out(F.col(f"`{id_col}`")))
    profiles = fit_profiles(learn, text_col, lang_col, depth)
    docs = without(docs, *[c for c in ("held_out",) if c not in (id_col, text_col)])
    return (predict_languages(docs.withColumn(flag, held_out(F.col(f"`{id_col}`"))), profiles, text_col, depth)
            .withColumnRenamed(flag, "held_out"))
