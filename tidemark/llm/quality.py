"""Quality rules: counts over each whole text, and a logistic regression over
hashed word and character n-grams, trained on labelled rows.

Training uses at most ``2 * per_class`` labelled documents (a documented bound);
features are hashed into fixed tables on the executors, the fit is a few seconds
of numpy.  A fifth of the sample is left out of the fit and calibrates the score
to a probability (Platt).  Scoring runs in Arrow batches: a table lookup per
n-gram, summed per text, against the fixed threshold ``keep_at``.

Results for odd input: a null or empty text has zero counts, fails the base rule
(fewer than 20 words) and is not kept.  Without labelled rows of both classes
the score is a constant at least ``keep_at``, so the base rules alone decide.
Each input row gives one result row, repeated rows too; other columns are left
alone.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.textblocks import NOT_SPACE, SLOT, U64, Block, blocks, byte_set, inside, owners, repeated, rolling
from tidemark.llm.training import Sparse, fit_logistic, labelled_sample, platt, sigmoid
from tidemark.sources.tables import read_table

SYMBOLS = byte_set(b"#*$%&|<>")
NOT_NEWLINE = ~byte_set([0x0A])
WINDOW = 8

BITS = 15  # entries of each family's hash table
CHAR_GRAMS = (1, 3, 4)
DIM = (1 + len(CHAR_GRAMS)) << BITS


def counts(block: Block) -> dict[str, np.ndarray]:
    """The base counts of every text of a block."""
    starts, ends, ptr = block.words(NOT_SPACE)
    n_words = np.diff(ptr)
    letters = NOT_SPACE[block.data] & ((block.data & 0xC0) != 0x80)
    h = block.hashes(starts, ends)
    owner = owners(ptr)

    covered = np.zeros(len(h) + 1, np.int64)
    ok = np.flatnonzero(inside(ptr, WINDOW))
    if len(ok):
        twice, _ = repeated(rolling(h, WINDOW)[ok], owner[ok])
        at = ok[twice]
        np.add.at(covered, at, 1)
        np.add.at(covered, at + WINDOW, -1)
    in_repeat = (np.cumsum(covered)[: len(h)] > 0).astype(np.int64)

    l_start, l_end, l_ptr = block.words(NOT_NEWLINE)
    has_word = np.searchsorted(starts, l_start) < np.searchsorted(starts, l_end)
    l_owner = owners(l_ptr)[has_word]
    _, later = repeated(block.hashes(l_start[has_word], l_end[has_word]), l_owner)
    return {
        "n_words": n_words,
        "word_chars": block.sums(letters),
        "n_symbols": block.sums(SYMBOLS[block.data]),
        "n_dup_lines": np.bincount(l_owner[later], minlength=block.n),
        "n_repeat_words": np.bincount(owner, in_repeat, block.n).astype(np.int64),
    }


def families(block: Block):
    """(hash index, owner) of every word and of every character n-gram."""
    shift = U64(64 - BITS)
    starts, ends, ptr = block.words(NOT_SPACE)
    yield (block.hashes(starts, ends) >> shift).astype(np.int64), owners(ptr)
    first = (block.data & 0xC0) != 0x80
    codes = np.frombuffer(block.data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32).astype(U64)
    at = np.zeros(len(block.data) + 1, np.int64)
    np.cumsum(first, out=at[1:])
    ptr = at[block.offsets]
    for family, n in enumerate(CHAR_GRAMS, 1):
        ok = inside(ptr, n)
        h = (rolling(codes, n) >> shift).astype(np.int64)[ok]
        yield h + (family << BITS), owners(ptr)[: len(ok)][ok]


def features(block: Block) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per text: (indices, relative frequency within the family)."""
    found: list[list] = [[] for _ in range(block.n)]
    for index, owner in families(block):
        edges = np.searchsorted(owner, np.arange(block.n + 1))
        for i in range(block.n):
            if edges[i + 1] > edges[i]:
                u, c = np.unique(index[edges[i] : edges[i + 1]], return_counts=True)
                found[i].append((u, c / c.sum()))
    empty = (np.zeros(0, np.int64), np.zeros(0))
    return [tuple(np.concatenate(x) for x in zip(*f)) if f else empty for f in found]


def _map_features(batches):
    for part in blocks(batches):
        rows = features(Block(part.column(1)))
        yield pa.RecordBatch.from_arrays(
            [
                part.column(0).cast(pa.int32()),
                pa.array([r[0].astype(np.int32) for r in rows], pa.list_(pa.int32())),
                pa.array([r[1].astype(np.float32) for r in rows], pa.list_(pa.float32())),
            ],
            ["label", "idx", "val"],
        )


def train(docs: DataFrame, labels: DataFrame, per_class: int = 1000) -> dict:
    """Fit and calibrate on at most ``per_class`` documents of each label."""
    sample = labelled_sample(docs, labels, "quality", per_class).select("label", "text")
    rows = sample.mapInArrow(_map_features, "label int, idx array<int>, val array<float>").toArrow()
    y = rows["label"].to_numpy()
    if len(set(y.tolist())) < 2:
        return {"w": np.zeros(DIM, np.float32), "b": 0.0, "calibration": (0.0, 10.0)}
    x = Sparse([r.values.to_numpy() for r in rows["idx"]], [r.values.to_numpy() for r in rows["val"]], DIM)
    del rows
    # The order in which rows arrive must not matter: split by content.
    fold = np.array([int(i.sum()) % 5 for i in np.split(x.idx, x.ptr[1:-1])]) == 0
    if len(set(y[fold].tolist())) < 2 or len(set(y[~fold].tolist())) < 2:
        fold[:] = False
    w, b = fit_logistic(x.take(~fold), y[~fold])
    held = fold if fold.any() else ~fold
    calibration = platt(x.take(held).dot(w) + b, y[held])
    return {"w": w.astype(np.float32), "b": float(b), "calibration": calibration}


def score(block: Block, model: dict) -> np.ndarray:
    total = np.full(block.n, model["b"])
    for index, owner in families(block):
        sums = np.bincount(owner, model["w"][index], block.n)
        total += sums / np.maximum(np.bincount(owner, minlength=block.n), 1)
    a, b = model["calibration"]
    return sigmoid(a * total + b)


def rate(docs: DataFrame, model: dict, keep_at: float = 0.5) -> DataFrame:
    """All columns of ``docs`` are dropped but doc_id and text's results."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        fitted = shared.value
        for part in blocks(batches):
            block = Block(part.column(1))
            c = counts(block)
            p = score(block, fitted)
            failed = (c["n_words"] < 20) | (100 * c["n_repeat_words"] > 30 * c["n_words"])
            yield pa.RecordBatch.from_arrays(
                [part.column(0).cast(pa.int64())]
                + [pa.array(v.astype(np.int64)) for v in c.values()]
                + [pa.array(failed), pa.array(~failed & (p >= keep_at)), pa.array(p)],
                ["doc_id", *c, "base_failed", "kept", "score"],
            )

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(
        run,
        "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "base_failed boolean, kept boolean, score double",
    )


def keep(docs: DataFrame, model: dict, keep_at: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches):
        for part in blocks(batches):
            block = Block(part.column(at).cast(pa.large_string()))
            c = counts(block)
            failed = (c["n_words"] < 20) | (100 * c["n_repeat_words"] > 30 * c["n_words"])
            yield part.filter(pa.array(~failed & (score(block, shared.value) >= keep_at)))

    return docs.mapInArrow(run, docs.schema)


def query(spark, sf_dir):
    """Counts and verdict for every document."""
    docs = read_table(spark, sf_dir, "documents")
    return rate(docs, train(docs, read_table(spark, sf_dir, "labels")))
