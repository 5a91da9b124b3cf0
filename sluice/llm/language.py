"""Language identification by rank-order profiles of character n-grams.

A profile lists a language's most frequent n-grams (1 to 3 characters of lower
case letters, with a blank at word ends) by rank. A text's own most frequent
n-grams are compared with each profile: each adds how far out of place it is,
or the profile's length if the profile lacks it. The nearest profile wins.

Profiles are learned from a bounded sample of the labelled rows: about
``sample_docs`` per language, chosen by a hash of the id, whatever the input's
size. Predictions use the text alone and read it whole.

Defined cases: a null text or one without a letter is ``und`` with score 0;
ties between languages go to the first in alphabetical order; without any
labelled row every text is ``und``; rows with a null id are predicted and not
learned from; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .scratch import fresh

UNKNOWN = "und"
PROFILE = 400
SAMPLE_DOCS = 2000
LONGEST_GRAM = 3


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-grams of a text as integers, and how often each occurs."""
    letters = _letters()
    code = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    code = np.where(letters[code], code, 32)
    code = np.concatenate(([32], code, [32]))
    code = code[np.append(True, (code[1:] != 32) | (code[:-1] != 32))]
    one = code[code != 32]
    two = (code[:-1] << 21 | code[1:])
    inner = code[1:-1] != 32  # a blank stands only at an end
    three = (code[:-2] << 42 | code[1:-1] << 21 | code[2:])[inner]
    return np.unique(np.concatenate((one, two, three)), return_counts=True)


def _top(gram: np.ndarray, count: np.ndarray, size: int) -> np.ndarray:
    """The most frequent n-grams, ties by their number."""
    if len(gram) > 4 * size:
        floor = np.partition(count, len(count) - size)[len(count) - size]
        gram, count = gram[count >= floor], count[count >= floor]
    return gram[np.argsort(-count, kind="stable")][:size]


class Profiles:
    """Ranks of n-grams by language, from ``(lang, gram, rank)`` rows."""

    def __init__(self, rows: list[tuple[str, int, int]], size: int = PROFILE):
        self.size = size
        self.langs = sorted({lang for lang, _, _ in rows})
        self.grams = np.unique(np.array([g for _, g, _ in rows], dtype=np.int64))
        self.ranks = np.full((len(self.langs), len(self.grams) + 1), -1, dtype=np.int64)
        for lang, gram, rank in rows:
            self.ranks[self.langs.index(lang), np.searchsorted(self.grams, gram)] = rank

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and score: 1 for a text whose n-grams stand as in the profile, 0 for none shared."""
        if not text or not self.langs:
            return UNKNOWN, 0.0
        gram, count = grams(text)
        if not len(gram):
            return UNKNOWN, 0.0
        own = _top(gram, count, self.size)
        at = np.searchsorted(self.grams, own)
        at[at == len(self.grams)] = 0
        ranks = np.where(self.grams[at] == own, self.ranks[:, at], -1)
        away = np.where(ranks >= 0, np.minimum(np.abs(ranks - np.arange(len(own))), self.size), self.size).sum(axis=1)
        best = int(np.argmin(away))
        return self.langs[best], float(1 - away[best] / (self.size * len(own)))


def is_held_out(doc_id):
    """True where the CRC-32 of the id as text is a multiple of 5."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def learn(docs: DataFrame, size: int = PROFILE, sample_docs: int = SAMPLE_DOCS) -> list[tuple[str, int, int]]:
    """Profile rows from labelled documents that are not held out; ``size`` rows per language."""
    labelled = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("lang").alias("label"))
    labelled = labelled.filter(F.col("label").isNotNull() & F.col("doc_id").isNotNull() & ~is_held_out(F.col("doc_id")))
    counts = labelled.groupBy("label").count().select("label", (sample_docs / F.col("count")).alias("share"))
    chance = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    sample = labelled.join(F.broadcast(counts), "label").filter(chance < F.col("share"))  # a row per language

    def count(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for b in it:
            parts: dict[str, list] = {}
            for label, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                parts.setdefault(label, []).append(grams(text or ""))
            for label, found in parts.items():
                if label in total:
                    found.append(total[label])
                gram, where = np.unique(np.concatenate([g for g, _ in found]), return_inverse=True)
                total[label] = gram, np.bincount(where, np.concatenate([c for _, c in found]), len(gram)).astype(np.int64)
        for label, (gram, n) in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([label] * len(gram), pa.string()), pa.array(gram), pa.array(n)], ["label", "gram", "n"])

    counted = sample.select("label", "text").mapInArrow(count, "label string, gram long, n long")
    total = counted.groupBy("label", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("label").orderBy(F.desc("n"), "gram")
    top = total.withColumn("rank", F.row_number().over(order) - 1).filter(F.col("rank") < size)
    return [(x.label, x.gram, x["rank"]) for x in top.collect()]  # size rows per language


def _with_prediction(texts: DataFrame, profiles: Profiles, lang: str, score: str) -> DataFrame:
    """``texts`` with two more columns; it has a column ``text``."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            found = [profiles.predict(t) for t in b.column("text").to_pylist()]
            more = [pa.array([x for x, _ in found], pa.string()), pa.array([x for _, x in found], pa.float64())]
            yield pa.RecordBatch.from_arrays([*b.columns, *more], [*b.schema.names, lang, score])

    schema = T.StructType([*texts.schema.fields, T.StructField(lang, T.StringType()), T.StructField(score, T.DoubleType())])
    return texts.mapInArrow(run, schema)


def predict(docs: DataFrame, rows: list[tuple[str, int, int]], size: int = PROFILE) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = _with_prediction(texts, Profiles(rows, size), "lang_pred", "score").drop("text")
    return found.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def identify(docs: DataFrame) -> DataFrame:
    """Learn profiles from the labelled rows of ``docs`` and predict all of its rows."""
    return predict(docs, learn(docs))


def keep_identified(docs: DataFrame, least_score: float = 0.05) -> DataFrame:
    """The rows of ``docs`` whose language is found with at least this score, all columns kept.

    Rejected are texts without a letter and texts that share next to nothing
    with any profile, whatever their label says.
    """
    lang, score = fresh(docs, "lang_pred"), fresh(docs, "score")
    found = _with_prediction(docs, Profiles(learn(docs)), lang, score)
    return found.filter((F.col(lang) != UNKNOWN) & (F.col(score) >= least_score)).select(docs.columns)
