"""Language identification by words first, backing off to ever shorter character n-grams.

A known word adds its log frequency in each language. For an unseen word, each of its places takes the longest known n-gram that
begins there, down to single characters, and the word adds the mean over its places, times the weight of an unseen word.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .base import crc_of_id, map_texts, table

#: Runs of letters; what Unicode calls numbers but not digits is sorted out by ``has_letter``.
WORD = re.compile(r"[^\W\d_]+")
UNDETERMINED = "und"


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def has_letter(words: list[str]) -> bool:
    return any(c.isalpha() for w in words for c in w)


@dataclass
class Model:
    """Rows of ``words`` and ``grams`` point into ``scores``: log probabilities by language, less their mean over the languages."""

    languages: list[str]
    words: dict[str, int]
    grams: dict[str, int]
    scores: np.ndarray
    longest: int
    unseen_weight: float

    def unseen(self, word: str) -> np.ndarray:
        marked, found = f"^{word}$", []
        for start in range(len(marked)):
            for end in range(min(len(marked), start + self.longest), start, -1):
                if (row := self.grams.get(marked[start:end])) is not None:
                    found.append(row)
                    break
        return self.unseen_weight * self.scores[found].mean(axis=0) if found else np.zeros(len(self.languages))

    def word(self, word: str) -> np.ndarray:
        row = self.words.get(word)
        return self.unseen(word) if row is None else self.scores[row]


class _Known(dict):
    """Words to rows of a growing table of their scores; forgets all when it grows large."""

    def __init__(self, model: Model, most: int = 200_000):
        self.model, self.most = model, most
        self.table = np.zeros((most, len(model.languages)), np.float32)

    def __missing__(self, word: str) -> int:
        row = self[word] = len(self)
        self.table[row] = self.model.word(word)
        return row

    def total(self, words: list[str]) -> np.ndarray:
        sums = np.zeros(len(self.model.languages))
        for start in range(0, len(words), self.most // 4):
            part = words[start : start + self.most // 4]
            if len(self) + len(part) > self.most:
                self.clear()
            sums += self.table[np.fromiter(map(self.__getitem__, part), np.int64, len(part))].sum(axis=0, dtype=np.float64)
        return sums


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", max_texts: int = 4_000, max_words: int = 50_000, max_grams: int = 50_000, longest: int = 5, unseen_weight: float = 1.0, max_languages: int = 256) -> Model:
    """A model from the texts with a language.

    The bounds: of each language at most ``max_texts`` texts are read, those with the smallest hash of id and text; each language keeps
    its ``max_words`` most frequent words and ``max_grams`` n-grams of up to ``longest`` characters (of words marked ^ and $), each
    counted twice or more. Rows that repeat id, text and language count as one. Null languages and null texts teach nothing; ties go
    by the word itself. More than ``max_languages`` languages are an error: the column then holds something else.
    """
    known = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")).where("lang is not null and text is not null")
    known = known.withColumn("draw", F.xxhash64("doc_id", "text"))
    # A cut of the hash that lets through about twice the bound; the exact bound is then a sort of few rows.
    each = known.select("lang", "doc_id", "draw").distinct().groupBy("lang").count().limit(max_languages + 1).collect()
    if len(each) > max_languages:
        raise ValueError(f"more than {max_languages} languages in column {lang_col}")
    sizes = {r["lang"]: r["count"] for r in each}
    if not sizes:
        return Model([], {}, {}, np.empty((0, 0), np.float32), longest, unseen_weight)
    share = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, 2 * max_texts / n))])[F.col("lang")]
    few = known.where((F.col("draw") / F.lit(2.0**64) + 0.5) <= share)
    place = F.row_number().over(Window.partitionBy("lang").orderBy("draw", "doc_id"))
    picked = few.select("doc_id", "draw", "lang").distinct().withColumn("place", place).where(F.col("place") <= max_texts)
    chosen = few.dropDuplicates(["doc_id", "draw", "lang"]).join(F.broadcast(picked.select("doc_id", "draw", "lang")), ["doc_id", "draw", "lang"], "left_semi").select("lang", "text")

    def count(batches):
        from collections import Counter

        for batch in batches:
            seen: dict[str, Counter] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                seen.setdefault(lang, Counter()).update(words_of(text))
            for lang, words in seen.items():
                grams: Counter = Counter()
                for word, n in words.items():
                    marked = f"^{word}$"
                    for size in range(1, longest + 1):
                        for start in range(len(marked) - size + 1):
                            grams[marked[start : start + size]] += n
                for kind, counts in ((0, words), (1, grams)):
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(counts)), pa.array([kind] * len(counts), pa.int32()), pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["lang", "kind", "term", "n"])

    counts = chosen.mapInArrow(count, "lang string, kind int, term string, n long").groupBy("lang", "kind", "term").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang", "kind").orderBy(F.desc("n"), "term"))
    most = F.when(F.col("kind") == 0, max_words).otherwise(max_grams)
    kept = counts.where("n > 1").withColumn("rank", rank).where(F.col("rank") <= most).select("lang", "kind", "term", "n")
    return _fit(sorted(map(tuple, kept.collect())), longest, unseen_weight)


def _fit(rows: list[tuple[str, int, str, int]], longest: int, unseen_weight: float) -> Model:
    languages = sorted({r[0] for r in rows})
    column = {lang: i for i, lang in enumerate(languages)}
    tables, scores, offset = [], [], 0
    for kind in (0, 1):
        own = [r for r in rows if r[1] == kind]
        terms = {t: i for i, t in enumerate(sorted({r[2] for r in own}))}
        counts = np.full((len(terms), len(languages)), 0.5)
        for lang, _, term, n in own:
            counts[terms[term], column[lang]] += n
        logs = np.log(counts / np.maximum(counts.sum(axis=0), 1)) if len(terms) else counts
        scores.append(logs - logs.mean(axis=1, keepdims=True) if len(terms) else logs)
        tables.append({t: i + offset for t, i in terms.items()})
        offset += len(terms)
    return Model(languages, tables[0], tables[1], np.concatenate(scores).astype(np.float32), longest, unseen_weight)


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score: the likeliest learnt language of each row's whole text and its share of the languages' likelihoods.

    Null texts and texts without a letter are ``und`` with score 0, as are all if no language was learnt. Ties go to the language
    that sorts first. No shuffle; the model's size is bounded by its options.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept: list[_Known] = []

    def run(_, texts):
        kept or kept.append(_Known(shared.value))
        own, out, scores = kept[0], [], []
        for text in texts:
            words = words_of(text)
            if not own.model.languages or not has_letter(words):
                out.append(UNDETERMINED)
                scores.append(0.0)
                continue
            total = own.total(words)
            best = int(np.argmax(total))
            out.append(own.model.languages[best])
            scores.append(float(1 / np.exp(total - total[best]).sum()))
        return {"lang_pred": out, "score": scores}

    return map_texts(docs, run, "lang_pred string, score double", id_col, text_col, binary=False)


def op9_language(spark, sf_dir) -> DataFrame:
    """Languages of all ``documents``, learnt from ids whose crc32 mod 4 is not 2."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(crc_of_id("doc_id") % 4 == 2, F.lit(False))
    return identify(docs, learn(docs.where(~held_out))).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
