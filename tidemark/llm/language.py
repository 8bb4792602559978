"""Language identification by word-first backoff.

A known word is scored by its log frequency in each language.  An unseen word
backs off to the longest of its character n-grams that are known, then to
shorter ones: all its known n-grams of the first length that has any count,
averaged, so one word weighs as much as another; a word without any known
n-gram says nothing.  A text's language is the one with the highest sum over
all its words.

The tables are counted over labelled documents: a hash-chosen sample of about
``train_docs`` for each language (all, if there are fewer).  Of that sample every
language has its own ``max_words`` most frequent words and, for each length, its
own ``max_grams`` most frequent n-grams in the tables (ties by the token), so a
language with few documents keeps its words beside large ones.  The model, which
every task gets, is thus bounded for each language; it grows with their number
only.  Frequencies are smoothed by the number of distinct tokens that the sample
holds.  Words are lower-cased runs of letters.

Odd input: a null text, or one without a letter, is ``und`` with score 0; a text
whose words are all unknown gets the language with most training words and an
even score; of languages with equal sums the first by name is predicted; rows
without lang train nothing; repeated rows train and are scored each; with no
training rows, as with an empty table, every text is ``und``.  Other columns are
not read.  A very long text is a block of its own; it is counted by distinct words.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.components import _written
from tidemark.llm.textblocks import blocks, small_batches
from tidemark.sources.tables import read_table

LETTERS = re.compile(r"[^\W\d_]+")
ORDERS = (5, 4, 3, 2, 1)
CACHE_WORDS = 300_000
FEW_LANGUAGES = 10_000  # rows of a table of languages that may be broadcast


def words_of(text: str) -> list[str]:
    return LETTERS.findall(text.lower())


def grams_of(word: str, n: int) -> list[str]:
    padded = f"<{word}>"
    return [padded[i : i + n] for i in range(len(padded) - n + 1)]


def _map_counts(batches):
    """Partial counts of a run of training documents: (lang, order, token, n);
    order 0 is a word."""
    for part in blocks(batches):
        found: dict = {}
        for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
            found.setdefault(lang, Counter()).update(words_of(text or ""))
        rows = []
        for lang, words in found.items():
            grams: dict = {n: Counter() for n in ORDERS}
            for w, c in words.items():
                for n in ORDERS:
                    for g in grams_of(w, n):
                        grams[n][g] += c
            for order, table in [(0, words), *grams.items()]:
                rows.extend((lang, order, token, c) for token, c in table.items())
        columns = list(zip(*rows)) if rows else [()] * 4
        kinds = (pa.string(), pa.int32(), pa.string(), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, kinds)], ["lang", "order", "token", "n"]
        )


def train(rows: DataFrame, train_docs: int = 2000, max_words: int = 30_000, max_grams: int = 10_000) -> dict:
    """The model from ``rows`` (lang, text, h: a hash of the row's id)."""
    small_batches(rows.sparkSession)
    sizes = _written(rows.groupBy("lang").agg(F.count("*").alias("of_lang")), "language-sizes")
    if sizes.count() <= FEW_LANGUAGES:  # else the join is by language, texts and all
        sizes = F.broadcast(sizes)
    share = F.pmod("h", F.lit(1 << 20)) * F.col("of_lang") < train_docs * (1 << 20)
    sample = rows.join(sizes, "lang").where(share).select("lang", "text")
    counts = sample.mapInArrow(_map_counts, "lang string, order int, token string, n long")
    counts = _written(counts.groupBy("lang", "order", "token").agg(F.sum("n").alias("n")), "language-counts")
    # One row for each language and order, from the bounded sample.
    totals = {(r["lang"], r["order"]): r["n"] for r in counts.groupBy("lang", "order").agg(F.sum("n").alias("n")).collect()}
    distinct = {r["order"]: r["n"] for r in counts.groupBy("order").agg(F.countDistinct("token").alias("n")).collect()}
    langs = sorted({lang for lang, _ in totals})
    if not langs:
        return {"langs": [], "words": {}, "word_logs": [], "grams": {}, "gram_logs": [], "prior": 0}
    place = F.row_number().over(Window.partitionBy("lang", "order").orderBy(F.desc("n"), "token"))
    kept = counts.withColumn("place", place).where(F.col("place") <= F.when(F.col("order") == 0, max_words).otherwise(max_grams))
    kept = counts.join(kept.select("order", "token").distinct(), ["order", "token"]).toArrow()
    names, at = np.unique(np.array([f"{o} {t}" for o, t in zip(kept["order"].to_pylist(), kept["token"].to_pylist())], object), return_inverse=True)
    counted = np.zeros((len(names), len(langs)))
    counted[at, [langs.index(x) for x in kept["lang"].to_pylist()]] = kept["n"].to_numpy()
    orders = np.array([int(x[0]) for x in names], np.int64)
    total = np.array([[totals.get((lang, o), 0) for lang in langs] for o in range(len(ORDERS) + 1)], float)
    smooth = 0.5 * np.array([distinct.get(o, 0) for o in range(len(ORDERS) + 1)], float)
    logs = np.log((counted + 0.5) / (total + smooth[:, None])[orders])
    is_word = orders == 0
    named = lambda mask: {names[i][2:]: row for row, i in enumerate(np.flatnonzero(mask))}
    return {
        "langs": langs,
        "words": named(is_word),
        "word_logs": logs[is_word],
        "grams": named(~is_word),
        "gram_logs": logs[~is_word],
        "prior": int(np.argmax(total[0])),
    }


def known_grams(word: str, grams: dict) -> list[int]:
    """Rows of the word's known n-grams of the longest length that has any."""
    for n in ORDERS:
        hits = [grams[g] for g in grams_of(word, n) if g in grams]
        if hits:
            return hits
    return []


class Scorer:
    """Log frequencies of the words met so far, a bounded number of them."""

    def __init__(self, model: dict, size: int = CACHE_WORDS):
        self.model, self.size = model, size
        self.forget(size)

    def forget(self, size: int):
        self.rows: dict = {}
        self.logs = np.zeros((size + 1, len(self.model["langs"])))
        self.says = np.zeros(size + 1, bool)

    def learn(self, counted: list) -> None:
        new = list(set().union(*counted).difference(self.rows))
        if len(self.rows) + len(new) > self.size:
            new = list(set().union(*counted))
            self.forget(max(self.size, len(new)))
        first = len(self.rows)
        self.rows.update(zip(new, range(first, first + len(new))))
        words, grams = self.model["words"], self.model["grams"]
        known = [(i, words[w]) for i, w in enumerate(new, first) if w in words]
        if known:
            at, row = np.array(known).T
            self.logs[at] = self.model["word_logs"][row]
            self.says[at] = True
        backed = [(i, known_grams(w, grams)) for i, w in enumerate(new, first) if w not in words]
        backed = [(i, hits) for i, hits in backed if hits]
        if backed:
            sizes = np.array([len(h) for _, h in backed])
            flat = self.model["gram_logs"][[g for _, h in backed for g in h]]
            at = [i for i, _ in backed]
            self.logs[at] = np.add.reduceat(flat, np.cumsum(sizes) - sizes) / sizes[:, None]
            self.says[at] = True

    def predict(self, texts: list) -> tuple[list[str], list[float]]:
        """(language, score) of every text; the score is the language's share of
        the evidence, sharpened with the square root of the number of words."""
        langs = self.model["langs"]
        counted = [Counter(words_of(t)) if t else Counter() for t in texts]
        self.learn(counted)
        names, scores = [], []
        for words in counted:
            has_letter = any(w.isalpha() for w in words) or any(c.isalpha() for w in words for c in w)
            if not langs or not has_letter:
                names.append("und")
                scores.append(0.0)
                continue
            at = np.fromiter(map(self.rows.__getitem__, words), np.int64, len(words))
            weights = np.fromiter(words.values(), np.float64, len(words)) * self.says[at]
            total = weights @ self.logs[at]
            if not weights.any():
                best, score = self.model["prior"], 1.0 / len(langs)
            else:
                best = int(np.argmax(total))
                score = float(1 / np.exp((total - total[best]) / math.sqrt(weights.sum())).sum())
            names.append(langs[best])
            scores.append(score)
        return names, scores


def identify(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, lang_pred and score for each row of ``docs`` (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        scorer = Scorer(shared.value)
        for part in blocks(batches):
            names, scores = scorer.predict(part.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [part.column(0).cast(pa.int64()), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                ["doc_id", "lang_pred", "score"],
            )

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, "doc_id long, lang_pred string, score double")


def fold(modulus: int):
    """crc32 of the doc_id's text modulo ``modulus`` (a null id counts as empty)."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % modulus


def query(spark, sf_dir):
    """Language of every document, learned from those outside the held-out third."""
    docs = read_table(spark, sf_dir, "documents")
    rows = docs.where(F.col("lang").isNotNull() & (fold(3) != 1))
    model = train(rows.select("lang", "text", F.xxhash64("doc_id").alias("h")))
    found = identify(docs, model)
    return found.select("doc_id", (fold(3) == 1).alias("held_out"), "lang_pred", "score")
