"""Language ID by word-first backoff.

A word that the model knows is scored by its log frequency in each language;
an unseen word by its character n-grams, from the longest down: the first
length of which any n-gram is known decides.  Scores of all words of the
whole text add up.

The model is fitted on a bounded sample of labelled documents: about
``DOCS_PER_LANG`` of each language, those of least hash, so that rare
languages keep all they have.  Words and n-grams are counted in Spark from all
of the sample.  Every language is kept, and names its most frequent words and
n-grams of each length, as many as its even share of ``MAX_ITEMS`` (at least
``LEAST_SHARE``); an item that one language names keeps its counts in all.
Frequencies are of all counts of the sample, named or not, and are smoothed
towards the mean of the languages: a language of which little is known is
neutral to what it has not seen, instead of taking or refusing it.
Prediction runs over Arrow batches; each Python worker keeps a bounded cache
of scored words.  Shuffles are of the sample only.

Defined cases: a null text, one without a letter, or one of which the model
knows neither a word nor an n-gram, is ``und`` with score 0;
without labelled documents every text is; ties go to the first language by
name; rows that repeat each get a row; columns of any other name play no part.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import durable, fields_of, gram, let, whole_row

DOCS_PER_LANG = 2000
MAX_ITEMS = 200_000
LEAST_SHARE = 500
LONGEST = 4
PRIOR = 50.0
CACHE = 200_000
CACHE_FLOATS = 8_000_000
DENSE_FLOATS = 4_000_000
WORD = r"\p{L}+"
_LETTERS = re.compile(r"[^\W\d_]+")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def items_of(word: Column) -> Column:
    """(size, item) of a word: itself as size 0, then its n-grams as ``grams_of`` has them."""

    def grams(padded: Column, size: int) -> Column:
        starts = F.sequence(F.lit(0), F.size(padded) - size)
        made = F.transform(starts, lambda i: F.struct(F.lit(size).alias("size"), F.concat(*gram(padded, i, size)).alias("item")))
        return F.when(F.size(padded) >= size, made).otherwise(F.array().cast("array<struct<size:int,item:string>>"))

    def of_chars(chars: Column) -> Column:
        single = F.transform(chars, lambda c: F.struct(F.lit(1).alias("size"), c.alias("item")))
        return let(F.concat(F.array(F.lit("^")), chars, F.array(F.lit("$"))), lambda padded: F.concat(single, *[grams(padded, n) for n in range(2, LONGEST + 1)]))

    whole = F.array(F.struct(F.lit(0).alias("size"), word.alias("item")))
    return F.concat(whole, let(F.regexp_extract_all(word, F.lit("(?s)."), F.lit(0)), of_chars))


def item_counts(labelled: DataFrame, docs_per_lang: int = DOCS_PER_LANG) -> DataFrame | None:
    """(size, lang, item, n) of the whole bounded sample; None without labelled documents."""
    labelled = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "lang", "text")
    sizes = labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()
    if not sizes:
        return None
    rates = labelled.sparkSession.createDataFrame([(r["lang"], min(1.0, docs_per_lang / r["n"])) for r in sizes], "lang string, rate double")
    chance = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) / 1_000_003.0
    sample = labelled.join(F.broadcast(rates), "lang").where(chance < F.col("rate"))  # a row per language
    words = sample.select("lang", F.explode_outer(F.regexp_extract_all(F.lower("text"), F.lit(WORD), F.lit(0))).alias("word")).where(F.col("word").isNotNull())
    counts = words.groupBy("lang", "word").agg(F.count("*").alias("n"))
    items = counts.select("lang", "n", F.explode_outer(items_of(F.col("word"))).alias("i")).select(F.col("i.size").alias("size"), "lang", F.col("i.item").alias("item"), "n")
    return durable(items.groupBy("size", "lang", "item").agg(F.sum("n").alias("n")))


def build(items: DataFrame, max_items: int = MAX_ITEMS, least_share: int = LEAST_SHARE) -> Model:
    """The model of (size, lang, item, n), with an even share of items for each language."""
    langs = sorted(r["lang"] for r in items.select("lang").distinct().collect())
    share = max(least_share, max_items // max(1, len(langs)))
    # By language and size the last count that is named, and what part of its
    # items by hash; a sort of the items would send a language to one task.
    counts = Window.partitionBy("size", "lang").orderBy(F.desc("n"))
    above = F.coalesce(F.sum("many").over(counts.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    classes = items.groupBy("size", "lang", "n").agg(F.count("*").alias("many")).withColumn("above", above)
    last = F.min(F.when(F.col("above") < share, F.struct("n", "many", "above"))).alias("last")
    limits = classes.groupBy("size", "lang").agg(F.sum(F.col("n") * F.col("many")).alias("total"), last).collect()
    at = {lang: k for k, lang in enumerate(langs)}
    totals = np.zeros((LONGEST + 1, len(langs)))
    for r in limits:
        totals[r["size"], at[r["lang"]]] = r["total"]
    marks = [(r["size"], r["lang"], at[r["lang"]], r["last"]["n"], (share - r["last"]["above"]) / r["last"]["many"]) for r in limits]
    marks = items.sparkSession.createDataFrame(marks, "size int, lang string, k int, least long, rate double")
    chance = F.pmod(F.xxhash64("item"), F.lit(1_000_003)) / 1_000_003.0
    named = (F.col("n") > F.col("least")) | ((F.col("n") == F.col("least")) & (chance < F.col("rate")))
    # LONGEST + 1 rows per language are broadcast; an item has a row per language at most.
    rows = items.join(F.broadcast(marks), ["size", "lang"]).select("size", "item", F.struct("k", "n").alias("of"), named.alias("named"))
    rows = rows.groupBy("size", "item").agg(F.sort_array(F.collect_list("of")).alias("of"), F.max("named").alias("named")).where("named")
    found = rows.select("size", "item", F.col("of.k").alias("k"), F.col("of.n").alias("n")).toArrow()
    tables = []
    for size in range(LONGEST + 1):
        part = found.filter(pc.equal(found["size"], size)).combine_chunks()
        starts = np.concatenate([[0], np.cumsum(pc.list_value_length(part["k"]).to_numpy())]).astype(np.int64)
        k, n = (pc.list_flatten(part[c]).to_numpy() for c in ("k", "n"))
        tables.append(_Table(part["item"].to_pylist(), starts, k, n, totals[size]))
    return Model(langs, tables)


def grams_of(word: str, n: int) -> list[str]:
    padded = f"^{word}$"
    return [padded[i : i + n] for i in range(len(padded) - n + 1)] if n > 1 else list(word)


class _Table:
    """Smoothed log frequencies: a place per item, and entries only for the
    languages that have it; one matrix where that is small.

    p = (n + PRIOR * mean) / (total + PRIOR), the mean being that of the
    languages' n / total.  PRIOR * mean is left out of all languages' logs.
    """

    def __init__(self, items: list[str], starts: np.ndarray, langs: np.ndarray, counts: np.ndarray, totals: np.ndarray):
        self.place = {item: k for k, item in enumerate(items)}
        self.starts, self.langs = starts, langs.astype(np.int32)
        self.base = -np.log1p(totals / PRIOR).astype(np.float32)
        mean = np.add.reduceat(counts / totals[langs], starts[:-1]) / len(totals) if items else np.zeros(0)
        self.gains = np.log1p(counts / (PRIOR * np.repeat(mean, np.diff(starts)))).astype(np.float32)

        self.rows = None
        if len(items) * len(totals) <= DENSE_FLOATS:
            self.rows = np.tile(self.base, (len(items), 1))
            self.rows[np.repeat(np.arange(len(items)), np.diff(starts)), self.langs] += self.gains
            self.starts = self.langs = self.gains = None

    def mean(self, places: list[int]) -> np.ndarray:
        if self.rows is not None:
            return self.rows[places[0]] if len(places) == 1 else np.add.reduce(self.rows.take(places, axis=0), axis=0) / len(places)
        row = self.base.copy()
        for k in places:
            part = slice(self.starts[k], self.starts[k + 1])
            row[self.langs[part]] += self.gains[part] / len(places)
        return row


class Model:
    """Log frequencies of words and n-grams by language.

    From the tables of all sizes, or from few (lang, word, n) without Spark.
    """

    def __init__(self, langs: list, tables: list[_Table] | None = None):
        if tables is None:
            langs, tables = self._small(langs)
        self.langs, self.words, self.grams = langs, tables[0], tables[1:]
        self.scorer: Scorer | None = None  # of this process; its cache outlives a task

    @staticmethod
    def _small(counts: list) -> tuple[list[str], list[_Table]]:
        langs = sorted({r["lang"] for r in counts})
        tables = []
        for size in range(LONGEST + 1):
            table: dict[str, Counter] = {}
            for r in counts:
                for item in grams_of(r["word"], size) if size else [r["word"]]:
                    table.setdefault(item, Counter())[langs.index(r["lang"])] += r["n"]
            entries = [e for of in table.values() for e in sorted(of.items())]
            k, n = np.array([e[0] for e in entries], np.int64), np.array([e[1] for e in entries], np.int64)
            starts = np.cumsum([0, *map(len, table.values())])
            tables.append(_Table(list(table), starts, k, n, np.bincount(k, n, len(langs)) if len(langs) else np.zeros(0)))
        return langs, tables

    def word(self, word: str) -> np.ndarray | None:
        known = self.words.place.get(word)
        if known is not None:
            return self.words.mean([known])
        for k in range(LONGEST, 0, -1):
            get = self.grams[k - 1].place.get
            hits = [x for g in grams_of(word, k) if (x := get(g)) is not None]
            if hits:
                return self.grams[k - 1].mean(hits)
        return None


class Scorer:
    def __init__(self, model: Model):
        langs = max(1, len(model.langs))
        # The last column tells whether the model knows anything of the word.
        self.model, self.place, self.rows = model, {}, np.zeros((1024, langs + 1), np.float32)
        self.cache = max(1024, min(CACHE, CACHE_FLOATS // langs))

    def _row(self, word: str) -> np.ndarray:
        row = np.zeros(self.rows.shape[1], np.float32)
        found = self.model.word(word)
        if found is not None:
            row[:-1], row[-1] = found, 1
        return row

    def _at(self, word: str) -> int:
        if len(self.place) >= self.cache:
            self.place.clear()
        k = len(self.place)
        if k == len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
        self.rows[k] = self._row(word)
        self.place[word] = k
        return k

    def predict(self, text: str | None) -> tuple[str, float]:
        spoken = text and self.model.langs and any(map(str.isalpha, text))
        counts = Counter(_LETTERS.findall(text.lower())) if spoken else None
        if not counts:
            return "und", 0.0
        if len(self.place) + len(counts) > self.cache:
            self.place.clear()
        if len(counts) > self.cache:  # one text with more distinct words than the cache holds
            total = sum((n * self._row(w).astype(np.float64) for w, n in counts.items()), np.zeros(self.rows.shape[1]))
        else:
            get, at = self.place.get, self._at
            rows = [k if (k := get(w)) is not None else at(w) for w in counts]
            total = np.fromiter(counts.values(), np.float64, len(counts)) @ self.rows[rows].astype(np.float64)
        if not total[-1]:
            return "und", 0.0
        total = total[:-1]
        n = sum(counts.values())
        best = int(np.argmax(total))
        # Evidence of at most 30 words, so that long texts keep a scale.
        odds = np.exp(np.minimum(0.0, (total - total[best]) / n * min(n, 30)))
        return self.model.langs[best], float(1.0 / odds.sum())


def predict(docs: DataFrame, model: Model, *keep: str) -> DataFrame:
    """``keep`` columns, lang_pred and score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by MAX_ITEMS a size and the languages that share an item

    @F.pandas_udf("lang_pred string, score double")
    def scored(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = shared.value
        scorer = model.scorer = model.scorer or Scorer(model)
        for batch in texts:
            yield pd.DataFrame([scorer.predict(t) for t in batch], columns=["lang_pred", "score"])

    return docs.select(*keep, scored("text").alias("_p")).select(*keep, F.col("_p.lang_pred").alias("lang_pred"), F.col("_p.score").alias("score"))


def known_rows(docs: DataFrame, model: Model) -> DataFrame:
    """Rows of ``docs`` whose text has a language of the model, with their own columns only."""
    judged = predict(docs.select(whole_row(docs).alias("row"), "text"), model, "row")
    return judged.where(F.col("lang_pred") != "und").select(*fields_of("row", docs.columns))


def fit(docs: DataFrame) -> Model:
    items = item_counts(docs.where(~held_out(F.col("doc_id"))))
    return Model([]) if items is None else build(items)
