"""Toxicity by a subsequence string-kernel support vector machine.

Kernel: two words are compared by their common subsequences of three characters
(with marks for begin and end), each weighted by ``DECAY`` to the power of the
stretch it is spread over in either word; stretches end at ``REACH`` characters.
Inserted characters and gaps thus lower a match but don't lose it.  It is
normalised by the self-similarity of a word of the same length whose characters
all differ.

The words of a sentence are its white-space tokens without outer punctuation,
lower-cased, and spaced-out words (three or more single characters in a row,
read as one).  A text is as toxic as its ``TOP`` most toxic different words are
together: their margins, the greatest first, are the features of a logistic
regression with weights of at least 0, so an insult among clean words counts, and
several that are each less sure count too.

Training: labelled texts are bags of such words.  The first positives are the words
that stand in more toxic texts than chance allows: their likelihood ratio against
equal shares is over twice the logarithm of the number of different words.  Texts without any of these give the
word that the machine of the round before took for their worst, if no clean text
holds it.  Negatives are words of clean texts, among them each one's two worst so
far.  The machine works on Nystroem features: similarities to ``landmarks`` words,
whitened.  As the features are linear in a word's subsequences, landmarks and
weights fold into one table over all triples, and scoring a word is a sum of table
entries.  What is fitted is bounded: at most ``per_class`` labelled texts of either
label, of whose clean words ``n_clean``, evenly spread over their sorted list, are
negatives from the start.  A fifth of the texts fits the regression over the
margins, whose intercept is moved to the shares of both labels among all labelled
rows.  Scores see every word of every text.

Odd input: a null or empty text gets the score of a text without any toxic word;
without training rows of both labels, or with empty tables, all scores are 0;
repeated rows are scored each; of equally toxic words any gives the text's score.
Only doc_id and text are read.  A very long text is a block of its own, its distinct
words are scored 20,000 at a time.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.language import fold
from tidemark.llm.textblocks import blocks
from tidemark.llm.training import labelled_sample, sigmoid
from tidemark.sources.tables import read_table

DECAY = 0.7
REACH = 7
STEPS = [(a, b) for b in range(2, REACH) for a in range(1, b)]
TABLE = 1 << 18
EDGES = ".,;:!?\"'()[]{}<>|#*$%&-_"
CACHE_WORDS = 300_000
PREDICT_AT = 0.3
TOP = 3



def _symbols(codes: np.ndarray) -> np.ndarray:
    """0 begin and end (code 0), 1-26 a-z, 27-62 all others by their code point."""
    letter = (codes >= 0x61) & (codes <= 0x7A)
    return np.where(codes == 0, 0, np.where(letter, codes - 0x60, 27 + codes % 36))


def tokens_of(text: str) -> set:
    """Distinct words of a lower-cased text, without outer punctuation; spaced-out
    words joined."""
    words = text.lower().split()
    found = {w.strip(EDGES) for w in set(words)}
    run: list = []
    for i in [i for i, w in enumerate(words) if len(w) == 1] + [-9]:
        if run and i != run[-1] + 1:
            if len(run) > 2:
                found.add("".join(words[j] for j in run))
            run = []
        run.append(i)
    return found


def _codes(words: list) -> tuple[np.ndarray, np.ndarray]:
    """(symbols of all words between begin and end marks, first place of each)."""
    bare = [w.strip(EDGES) for w in words]
    flat = np.frombuffer("".join(f"\x00{w}\x00" for w in bare).encode("utf-32-le", "replace"), np.uint32)
    codes = _symbols(flat.astype(np.int64))
    sizes = np.array([len(w) + 2 for w in bare], np.int64)
    return codes, np.concatenate([[0], np.cumsum(sizes)])


def _norms(sizes: np.ndarray) -> np.ndarray:
    """Square root of the self-similarity of distinct characters, by length."""
    total = np.zeros(len(sizes))
    for _, b in STEPS:
        total += np.maximum(sizes - b, 0) * DECAY ** (2 * b)
    return np.sqrt(np.maximum(total, 1e-12))


def triples(words: list):
    """(table index, word, weight) of every subsequence of every word, by step."""
    codes, ptr = _codes(words)
    sizes = np.diff(ptr)
    owner = np.repeat(np.arange(len(words)), sizes)
    stop = np.repeat(ptr[1:], sizes)
    scale = 1 / _norms(sizes)
    at = np.arange(len(codes))
    for a, b in STEPS:
        ok = at[: max(len(codes) - b, 0)][at[: max(len(codes) - b, 0)] + b < stop[: max(len(codes) - b, 0)]]
        index = (codes[ok] << 12) | (codes[ok + a] << 6) | codes[ok + b]
        yield index, owner[ok], DECAY**b * scale[owner[ok]]


def margins(words: list, model: dict) -> np.ndarray:
    total = np.full(len(words), model["bias"])
    for index, owner, weight in triples(words):
        total += np.bincount(owner, weight * model["table"][index], len(words))
    return total


class Words:
    """Subsequence features of a fixed list of words."""

    def __init__(self, words: list):
        self.words = words
        parts = list(triples(words))
        self.index = np.concatenate([p[0] for p in parts])
        self.owner = np.concatenate([p[1] for p in parts])
        self.weight = np.concatenate([p[2] for p in parts])

    def dot(self, table: np.ndarray) -> np.ndarray:
        return np.bincount(self.owner, self.weight * table[self.index], len(self.words))

    def table(self, i: int) -> np.ndarray:
        mine = self.owner == i
        return np.bincount(self.index[mine], self.weight[mine], TABLE)


def svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, c: float = 10.0, rounds: int = 15):
    """L2 support vector machine (squared hinge) by Newton steps: (w, b)."""
    x1 = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x1.shape[1])
    ridge = np.eye(len(w))
    ridge[-1, -1] = 1e-6
    for _ in range(rounds):
        active = y * (x1 @ w) < 1
        xa = x1[active] * (c * weight[active])[:, None]
        new = np.linalg.solve(ridge + xa.T @ x1[active], xa.T @ y[active])
        if np.abs(new - w).max() < 1e-6:
            break
        w = new
    return w[:-1], w[-1]


def _spread(order: list, n: int) -> list:
    """n entries spaced evenly through a list."""
    return [order[i] for i in np.unique(np.linspace(0, len(order) - 1, min(n, len(order))).astype(int))]


def unlikely(toxic: list, clean: list, n_words: int) -> np.ndarray:
    """Likelihood ratio of each word's counts of toxic and clean texts against equal
    shares; 0 where it is no more frequent in toxic ones."""
    seen = [np.bincount(np.concatenate(g), minlength=n_words).astype(float) for g in (toxic, clean)]
    share = len(toxic) / (len(toxic) + len(clean))
    ratio = np.zeros(n_words)
    for count, part in zip(seen, (share, 1 - share)):
        held = count > 0
        ratio[held] += 2 * count[held] * np.log(count[held] / (part * (seen[0] + seen[1])[held]))
    return np.where(seen[0] > share * (seen[0] + seen[1]), ratio, 0)


def fit(bags: list, y: np.ndarray, landmarks: int = 96, rounds: int = 2, n_clean: int = 4000) -> dict:
    """A table over all triples and a bias from bags of words with labels."""
    vocabulary = sorted(set().union(*bags))
    at = {w: i for i, w in enumerate(vocabulary)}
    space = Words(vocabulary)
    members = [np.array(sorted(at[w] for w in bag), np.int64) for bag in bags]
    toxic = [m for m, label in zip(members, y) if label == 1 and len(m)]
    clean = [m for m, label in zip(members, y) if label == 0 and len(m)]
    none = {"table": np.zeros(TABLE, np.float32), "bias": -1.0}
    if not toxic or not clean:
        return none
    in_clean = np.zeros(len(vocabulary), bool)
    in_clean[np.concatenate(clean)] = True
    ratio = unlikely(toxic, clean, len(vocabulary))
    sure = ratio >= 2 * np.log(len(vocabulary))
    if not sure.any():  # too few texts for any word to stand out: the best of each
        sure[[m[np.argmax(ratio[m])] for m in toxic if ratio[m].any()]] = True
    # An even pick over the vocabulary's order stands for all clean words.
    negatives = np.array(_spread(np.flatnonzero(in_clean & ~sure).tolist(), n_clean), np.int64)
    positives = strong = np.flatnonzero(sure)
    model = none
    for _ in range(rounds):
        negatives = np.setdiff1d(negatives, positives)
        if not len(positives) or not len(negatives):
            return model
        order = positives[np.argsort(-ratio[positives], kind="stable")]
        z = _spread(order.tolist(), landmarks // 2) + _spread(negatives.tolist(), landmarks - landmarks // 2)
        marks = [space.table(i) for i in z]
        rows = np.concatenate([positives, negatives])
        label = np.where(np.arange(len(rows)) < len(positives), 1.0, -1.0)
        sub = Words([vocabulary[i] for i in rows])
        similar = np.stack([sub.dot(t) for t in marks], axis=1)
        kzz = np.stack([Words([vocabulary[i] for i in z]).dot(t) for t in marks], axis=1)
        value, vector = np.linalg.eigh((kzz + kzz.T) / 2)
        good = value > 1e-6 * value.max()
        whiten = vector[:, good] / np.sqrt(value[good])
        balance = np.where(label == 1, 1.0, len(positives) / len(negatives) * 4)
        w, bias = svm(similar @ whiten, label, balance)
        table = np.zeros(TABLE)
        for beta, t in zip(whiten @ w, marks):
            table += beta * t
        model = {"table": table.astype(np.float32), "bias": float(bias)}
        guess = space.dot(table) + bias
        hard = np.unique(np.concatenate([m[np.argsort(-guess[m], kind="stable")[:2]] for m in clean]))
        negatives = np.union1d(negatives, hard[~sure[hard]])
        worst = np.array([m[np.argmax(guess[m])] for m in toxic if not sure[m].any()], np.int64)
        positives = np.union1d(strong, worst[(guess[worst] > 0) & ~in_clean[worst]]).astype(np.int64)
    return model


def _map_bags(batches):
    for part in blocks(batches):
        bags = [sorted(tokens_of(t or "")) for t in part.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([part.column(0).cast(pa.int32()), pa.array(bags, pa.list_(pa.string()))], ["label", "words"])


def top_margins(words, margin_of) -> np.ndarray:
    """The ``TOP`` greatest margins of a bag of words, the last one repeated."""
    found = np.sort(np.array([margin_of(w) for w in words] or [margin_of("")]))[::-1][:TOP]
    return np.concatenate([found, np.full(TOP - len(found), found[-1])])


def fit_top(x: np.ndarray, y: np.ndarray, steps: int = 2000) -> tuple[np.ndarray, float]:
    """Logistic regression with weights of at least 0, by projected gradient steps
    on class-balanced, smoothed labels: (weights, intercept)."""
    scale = x.std() or 1.0
    z = (x - x.mean(axis=0)) / scale
    share = np.where(y == 1, 0.5 / max((y == 1).sum(), 1), 0.5 / max((y == 0).sum(), 1))
    target = np.where(y == 1, 1 - 0.5 / ((y == 1).sum() + 1), 0.5 / ((y == 0).sum() + 1))
    w, b = np.full(x.shape[1], 1.0), 0.0
    for _ in range(steps):
        r = (sigmoid(z @ w + b) - target) * share
        w, b = np.maximum(w - 2.0 * (z.T @ r + 1e-4 * w), 0), b - 2.0 * r.sum()
    return w / scale, float(b - (w / scale) @ x.mean(axis=0))


def train(docs: DataFrame, labels: DataFrame, where=None, per_class: int = 600) -> dict | None:
    """The model from at most ``per_class`` texts of each label; None without both."""
    sample = labelled_sample(docs, labels, "toxic", per_class, where).select("label", "text")
    rows = sample.mapInArrow(_map_bags, "label int, words array<string>").toArrow()
    data = sorted(zip(rows["words"].to_pylist(), rows["label"].to_pylist()))
    bags, y = [set(b) for b, _ in data], np.array([label for _, label in data])
    if len(set(y.tolist())) < 2:
        return None
    rank = np.zeros(len(y), np.int64)
    for c in (0, 1):
        rank[y == c] = np.arange((y == c).sum())
    held = rank % 5 == 4
    if len(set(y[held].tolist())) < 2:
        held[:] = False
    model = fit([b for b, h in zip(bags, held) if not h], y[~held])
    test = held if held.any() else ~held
    some = [sorted(b) or [""] for b, h in zip(bags, test) if h]
    of = {w: m for b in some for w, m in zip(b, margins(b, model))}
    weights, intercept = fit_top(np.stack([top_margins(b, of.__getitem__) for b in some]), y[test])
    # From balanced classes to the labels' own shares.
    counted = labels.where("toxic IN (0, 1)" if where is None else where & F.col("toxic").isin(0, 1))
    n = {r["toxic"]: r["n"] for r in counted.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    prior = float(np.log(n.get(1, 1) / n.get(0, 1)))
    return {**model, "weights": weights, "intercept": intercept + prior}


def score_texts(texts: list, model: dict, cache: dict) -> np.ndarray:
    bags = [tokens_of(t) if t else {""} for t in texts]
    new = list(set().union(*bags, {""}).difference(cache))
    if len(cache) + len(new) > CACHE_WORDS:
        cache.clear()
        new = list(set().union(*bags, {""}))
    for i in range(0, len(new), 20_000):
        some = new[i : i + 20_000]
        cache.update(zip(some, margins(some, model).tolist()))
    top = np.stack([top_margins(bag, cache.__getitem__) for bag in bags]) if bags else np.zeros((0, TOP))
    return sigmoid(top @ model["weights"] + model["intercept"])


def rate(docs: DataFrame, model: dict | None) -> DataFrame:
    """doc_id and score for each row of ``docs`` (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        cache: dict = {}
        for part in blocks(batches):
            texts = part.column(1).to_pylist()
            scores = np.zeros(len(texts)) if shared.value is None else score_texts(texts, shared.value, cache)
            yield pa.RecordBatch.from_arrays([part.column(0).cast(pa.int64()), pa.array(scores)], ["doc_id", "score"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, "doc_id long, score double")


def query(spark, sf_dir):
    """Toxicity of every document, learned from the labels outside the held-out quarter."""
    docs = read_table(spark, sf_dir, "documents")
    model = train(docs, read_table(spark, sf_dir, "labels"), where=fold(4) != 2)
    return rate(docs, model).select(
        "doc_id",
        (fold(4) == 2).alias("held_out"),
        "score",
        F.when(F.col("score") >= PREDICT_AT, 1).otherwise(0).cast("int").alias("predicted"),
    )
