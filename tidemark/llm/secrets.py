"""Secret scans: fixed patterns, and a small character convolutional network over
every other candidate.

Base kinds are exact patterns, leftmost and non-overlapping per kind.  Further
candidates are all runs of 12 or more key-like characters, with digits or not, and
of a run that a base finding touches each piece that is left beside it (without
letters and digits it is none).  The network reads a candidate with 32 characters
of context on either side, and above the threshold it becomes a span of kind
``model``.  The word before a value (``name = value``, ``name=value`` or a prefix
such as AKIA) is blanked, in training as in the scan: the network judges the value
and the rest of its context, not the names that the base rules know.  Long
candidates are read in overlapping windows; as the network keeps the maximum of
each filter, this equals one pass over the whole candidate.

Training: values of the base findings of all documents are the positive labels.
The other candidates hold the secrets that the rules miss too, so they are not all
negative: each half is read by a network fitted to the other half, and what that
takes for a secret is left out.  Every different window of all documents takes part.
They are dealt by hash into shards of some ``shard`` windows, each of which is one
row of a table; where base findings are few, each is dealt to several shards, so that
all have some.  A fit makes ``rounds`` passes: in each the shards go on from the same
network by plain back-propagation in numpy, as Spark tasks, and the networks are
averaged.  A quarter of the windows (by hash) is not fitted, but calibrates the output
to a probability and sets the threshold: the highest that still finds ``recall`` of its
positives, from the counts of all its outputs, which are rounded to 1/1024.  The model
tells the recall and the share of negatives above the threshold that were measured
there (``held_recall``, ``held_false``), and how many windows were fitted, held and
left out (``windows``).  Shards, starts and sums (in whole numbers) don't depend on
how rows are spread over tasks.

Offsets are code points, ends exclusive.  Odd input: a null or empty text has no
spans, and ``base_sha256`` is the hash of the empty string; without findings of
both classes there is no network and only base spans; repeated rows are scanned
each; spans that start alike come in the order of the kinds; an empty table gives
no rows.  Of other columns only doc_id and text are read.  A very long text is a
block of its own; its candidates are read ``GROUP`` windows at a time, whatever
their number, so it costs its text and spans only.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import _written
from tidemark.llm.textblocks import blocks, small_batches
from tidemark.llm.training import platt, sigmoid
from tidemark.session import scratch_path, shuffles_removed
from tidemark.sources.tables import read_table

KINDS = ("assign", "access", "hex", "model")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ASSIGN_HINTS = ("passw", "secret", "token", "api")
# Runs are maximal, so a length bound in the pattern drops the same matches as a
# test afterwards; an assignment's match can hide another, so it is tested after.
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGN_LENGTH = 12
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=.-]{12,}")
SOLID = re.compile(r"[A-Za-z0-9]")
NAME = re.compile(r"[A-Za-z0-9_.-]+=+(?=[A-Za-z0-9])")  # inside a run, before its value
BEFORE = re.compile(r"""([A-Za-z0-9_]+)["']?\x20*[:=]?\x20*["']?$""")

CONTEXT, WIDTH, STRIDE = 32, 128, 96
GROUP = 2048  # windows that the network reads at a time
CHUNK = 32
KERNEL, FILTERS = 5, 24
SHARD, LEAST, ROUNDS = 16384, 256, 4  # windows of a shard, base values in it at least; averagings
REPEAT = 4  # base values are repeated in a shard until they are one in so many
RATE, DECAY = 0.01, 2.5  # of the first round; each later one's is lower
EPOCHS, STEPS, BATCH = 12, 64, 128  # passes over small data at most, steps of a round at least
OUTPUT_STEPS = 1024  # steps of a unit that outputs are rounded to
SCALE = 1 << 32  # weights are summed as whole numbers of this fraction
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"

# Symbols: a-z without case, digits, and punctuation one by one; 0 is padding.
_SYMBOL = np.full(0x80, 1, np.int64)
for _i, _c in enumerate("abcdefghijklmnopqrstuvwxyz"):
    _SYMBOL[ord(_c)] = _SYMBOL[ord(_c.upper())] = 2 + _i
_SYMBOL[ord("0") : ord("9") + 1] = 28
for _i, _c in enumerate(" \n\"'=:+/_-.@"):
    _SYMBOL[ord(_c)] = 29 + _i
N_SYMBOLS = 42
CHANNELS = N_SYMBOLS + 2  # and: upper case, inside the candidate


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of every base finding."""
    found = []
    lower = text.lower()
    if any(h in lower for h in ASSIGN_HINTS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= ASSIGN_LENGTH]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def candidates(text: str, base: list) -> list[tuple[int, int]]:
    """(start, end) of the key-like runs, without what base findings cover."""
    covered: list[list[int]] = []
    for s, _, e in base:
        if covered and s <= covered[-1][1]:
            covered[-1][1] = max(covered[-1][1], e)
        else:
            covered.append([s, e])
    found, i = [], 0
    for m in CANDIDATE.finditer(text):
        at, stop = m.span()
        while i < len(covered) and covered[i][1] <= at:
            i += 1
        j = i
        while j < len(covered) and covered[j][0] < stop:
            found.append((at, covered[j][0]))
            at = covered[j][1]
            j += 1
        found.append((at, stop))
    return [(s, e) for s, e in found if s < e and SOLID.search(text, s, e)]


def value(text: str, start: int, end: int) -> tuple[int, int]:
    """A candidate without a name in front, as the network reads it."""
    m = NAME.match(text, start, end)
    return (m.end() if m else start), end


def base_value(text: str, start: int, kind: int, end: int) -> tuple[int, int]:
    """A base finding without its keyword or prefix."""
    if kind == 0:
        return ASSIGN.match(text, start).start(2), end
    return (start + 4 if kind == 1 else start), end


def windows(text: str, start: int, end: int) -> np.ndarray:
    """Symbols, case and place of a span with its context, the word before it
    blank: (windows, WIDTH, 3)."""
    lo = start - CONTEXT
    size = end - start + 2 * CONTEXT
    count = max(1, -(-(size - WIDTH) // STRIDE) + 1)
    out = np.zeros((count * STRIDE + WIDTH, 3), np.uint8)
    piece = text[max(lo, 0) : end + CONTEXT]
    codes = np.frombuffer(piece.encode("utf-32-le", "replace"), np.uint32)
    at = max(-lo, 0)
    out[at : at + len(codes), 0] = np.where(codes < 0x80, _SYMBOL[np.minimum(codes, 0x7F)], 41)
    out[at : at + len(codes), 1] = (codes >= 0x41) & (codes <= 0x5A)
    if m := BEFORE.search(piece[: start - max(lo, 0)]):
        out[at + m.start(1) : at + m.end(1), :2] = 0
    out[CONTEXT : CONTEXT + end - start, 2] = 1
    return np.stack([out[i * STRIDE : i * STRIDE + WIDTH] for i in range(count)])


def codes_of(x: np.ndarray) -> np.ndarray:
    """Symbol, case and place of each character as one of 4 * N_SYMBOLS numbers."""
    symbol, upper_case, inside = np.moveaxis(x, -1, 0)
    return (symbol + N_SYMBOLS * (upper_case + 2 * inside)).astype(np.uint8)


def _taps(net: dict) -> np.ndarray:
    """The filters as a table of the characters' codes for each tap."""
    w = net["w"].reshape(KERNEL, CHANNELS, FILTERS)
    taps = w[:, :N_SYMBOLS].copy()
    taps[:, 0] = 0
    upper, within = w[:, N_SYMBOLS, None], w[:, N_SYMBOLS + 1, None]
    return np.concatenate([taps, taps + upper, taps + within, taps + upper + within], axis=1)


def _filtered(code: np.ndarray, taps: np.ndarray):
    """(rows, characters, each filter at each place) of some windows at a time, those
    of like length together: blank places but one are left out behind the longest."""
    length = code.shape[1] - (code[:, ::-1] != 0).argmax(axis=1)
    length[~code.any(axis=1)] = 0
    order = np.argsort(length, kind="stable")
    for i in range(0, len(code), CHUNK):
        rows = order[i : i + CHUNK]
        part = code[rows, : length[rows[-1]] + KERNEL].astype(np.intp)
        places = part.shape[1] - KERNEL + 1
        z = taps[0].take(part[:, :places], axis=0)
        for k in range(1, KERNEL):
            z += taps[k].take(part[:, k : k + places], axis=0)
        yield rows, part, z


def pooled(x: np.ndarray, net: dict) -> np.ndarray:
    """Maximum of each filter over all places of each window."""
    out = np.zeros((len(x), FILTERS), np.float32)
    for rows, _, z in _filtered(codes_of(x) if x.ndim == 3 else x, _taps(net)):
        out[rows] = np.maximum(z.max(axis=1) + net["b"], 0)
    return out


def logits(spans, net: dict) -> np.ndarray:
    """The network's output for each span's windows; ``spans`` may be an iterator,
    of which some ``GROUP`` windows are held at a time."""
    out, group, size = [], [], 0

    def read():
        top = pooled(np.concatenate(group), net)
        sizes = np.array([len(s) for s in group])
        out.append(np.maximum.reduceat(top, np.cumsum(sizes) - sizes, axis=0) @ net["v"] + net["c"])

    for span in spans:
        if group and size + len(span) > GROUP:
            read()
            group, size = [], 0
        group.append(span)
        size += len(span)
    if group:
        read()
    return np.concatenate(out) if out else np.zeros(0)


def start(seed: int = 5) -> dict:
    rng = np.random.RandomState(seed)
    return {
        "w": (rng.randn(KERNEL * CHANNELS, FILTERS) * 0.1).astype(np.float32),
        "b": np.zeros(FILTERS, np.float32),
        "v": (rng.randn(FILTERS) * 0.1).astype(np.float32),
        "c": np.zeros(1, np.float32),
    }


def _gradient(code: np.ndarray, y: np.ndarray, weight: np.ndarray, net: dict) -> dict:
    taps, filters = _taps(net), np.arange(FILTERS)
    table = np.zeros(taps.size)
    grad = {k: np.zeros(v.shape) for k, v in net.items()}
    for rows, part, z in _filtered(code, taps):
        where = z.argmax(axis=1)
        top = np.take_along_axis(z, where[:, None, :], axis=1)[:, 0] + net["b"]
        act = np.maximum(top, 0)
        r = (sigmoid(act @ net["v"] + net["c"]) - y[rows]) * weight[rows]
        back = r[:, None] * net["v"] * (top > 0)
        # Only the winning place of a filter has a gradient.
        spots = part[np.arange(len(rows))[:, None, None], where[:, :, None] + np.arange(KERNEL)]
        at = ((np.arange(KERNEL) * taps.shape[1] + spots) * FILTERS + filters[None, :, None]).ravel()
        table += np.bincount(at, np.repeat(back.ravel(), KERNEL), taps.size)
        grad["b"] += back.sum(0)
        grad["v"] += act.T @ r
        grad["c"] += r.sum()
    table = table.reshape(KERNEL, 2, 2, N_SYMBOLS, FILTERS)  # tap, inside, upper case
    gw = grad["w"].reshape(KERNEL, CHANNELS, FILTERS)
    gw[:, 1:N_SYMBOLS] = table.sum((1, 2))[:, 1:]
    gw[:, N_SYMBOLS] = table[:, :, 1].sum((1, 2))
    gw[:, N_SYMBOLS + 1] = table[:, 1].sum((1, 2))
    grad["w"] += 1e-4 * net["w"]
    grad["v"] += 1e-3 * net["v"]
    return grad


def fit(
    x: np.ndarray, y: np.ndarray, net: dict, epochs: int = 12, batch: int = 128, rate: float = 0.01, seed: int = 5
) -> dict:
    """Train a network on the codes of windows x with labels y (class-balanced cross
    entropy, Adam)."""
    rng = np.random.RandomState(seed)
    m = {k: np.zeros(v.shape) for k, v in net.items()}
    s = {k: np.zeros(v.shape) for k, v in net.items()}
    weight = np.where(y == 1, 0.5 / max((y == 1).mean(), 1e-6), 0.5 / max((y == 0).mean(), 1e-6))
    t = 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for i in range(0, len(x), batch):
            pick = order[i : i + batch]
            t += 1
            grad = _gradient(x[pick], y[pick], weight[pick] / len(pick), net)
            for k, g in grad.items():
                m[k] = 0.9 * m[k] + 0.1 * g
                s[k] = 0.999 * s[k] + 0.001 * g * g
                step = rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(s[k] / (1 - 0.999**t)) + 1e-8)
                net = {**net, k: (net[k] - step).astype(np.float32)}
    return net


def _map_findings(batches):
    """(label, hash, window) of all findings: base values 1, other candidates 0; a
    window as the codes of its characters."""
    for part in blocks(batches):
        rows: list[tuple] = []
        for text in part.column(0).to_pylist():
            if not text:
                continue
            base = base_spans(text)
            spans = {(*base_value(text, *b), 1) for b in base}
            spans |= {(*value(text, *c), 0) for c in candidates(text, base)}
            for begin, end, label in spans:
                for w in codes_of(windows(text, begin, end)):
                    row = w.tobytes()
                    h = int.from_bytes(hashlib.blake2b(row, digest_size=8).digest(), "little") >> 1
                    rows.append((label, h, row))
                if len(rows) >= GROUP:
                    yield from _found(rows)
                    rows = []
        yield from _found(rows)


def _found(rows: list):
    for i in range(0, len(rows), GROUP):
        label, h, row = zip(*rows[i : i + GROUP])
        yield pa.RecordBatch.from_arrays(
            [pa.array(label, pa.int32()), pa.array(h, pa.int64()), pa.array(row, pa.binary())],
            ["label", "hash", "window"],
        )


# A window's flags: its label, the half and the quarter it is in, and whether this is
# the first of the shards that it is dealt to (counts are of those).
LABEL, HALF, QUARTER, FIRST = 1, 2, 12, 16
PACKED = "shard long, windows binary, flags binary"


def _pack(found: pa.Table) -> pa.Table:
    """A shard's windows, in an order of their own, as one row."""
    found = found.sort_by([("hash", "ascending"), ("label", "ascending"), ("window", "ascending")])
    label, h, copy = (found[c].to_numpy() for c in ("label", "hash", "copy"))
    flags = LABEL * label + HALF * (h & 1) + QUARTER // 3 * ((h >> 1) & 3) + FIRST * (copy == 0)
    return pa.table(
        {
            "shard": pa.array(found["shard"].to_numpy()[:1], pa.int64()),
            "windows": pa.array([b"".join(found["window"].to_pylist())], pa.binary()),
            "flags": pa.array([flags.astype(np.uint8).tobytes()], pa.binary()),
        }
    )


def _unpacked(batches):
    """(shard, codes of its windows, flags) of each row."""
    for batch in batches:
        for i in range(batch.num_rows):
            shard, x, flags = (batch.column(j)[i].as_py() for j in range(3))
            yield shard, np.frombuffer(x, np.uint8).reshape(-1, WIDTH), np.frombuffer(flags, np.uint8)


def _shards(found: DataFrame, sizes: dict, shard: int) -> DataFrame:
    """The findings dealt into shards; base values are dealt to several each if a
    shard would get less than ``LEAST`` of them."""
    n = -(-sum(sizes.values()) // shard)
    copies = F.when(F.col("label") == 1, max(1, min(n, -(-LEAST * n // sizes[1])))).otherwise(1)
    dealt = found.select("label", "hash", "window", F.explode(F.sequence(F.lit(0), copies - 1)).alias("copy"))
    dealt = dealt.withColumn("shard", F.pmod(F.shiftright("hash", 8) + F.col("copy"), F.lit(n).cast("long")))
    parts = max(min(n, 2 * found.sparkSession.sparkContext.defaultParallelism), n // 8)
    return dealt.repartition(parts, "shard").groupBy("shard").applyInArrow(_pack, PACKED)


@contextmanager
def _one_by_one(spark):
    """Rows that hold a shard come to Python one at a time."""
    before = spark.conf.get(BATCH_ROWS)
    spark.conf.set(BATCH_ROWS, "1")
    try:
        yield
    finally:
        spark.conf.set(BATCH_ROWS, before)


def _wide(df: DataFrame, name: str) -> DataFrame:
    """Write and read rows that hold a shard; the writer looks at its size after each."""
    path = scratch_path(df.sparkSession, name)
    checked = {f"parquet.{size}.size.row.check.min": "1" for size in ("page", "block")}
    df.write.options(**checked, **{"parquet.block.size": str(1 << 24)}).parquet(path)
    return df.sparkSession.read.parquet(path)


def _members(flags: np.ndarray, group) -> np.ndarray:
    """Mask of a group's windows: one half (0, 1), the held quarter ("held"), the
    others ("fit"), or all."""
    if group in (0, 1):
        return (flags & HALF) == HALF * group
    held = (flags & QUARTER) == QUARTER
    return {"held": held, "fit": ~held, "all": np.ones(len(flags), bool)}[group]


def _local(x: np.ndarray, flags: np.ndarray, net: dict, turn: int, rounds: int, seed: int):
    """The network after a shard's windows; None without windows of both classes.
    Few base values are repeated, a small shard is read more often."""
    label = flags & LABEL
    found, other = np.flatnonzero(label == 1), np.flatnonzero(label == 0)
    if not len(found) or not len(other):
        return None
    pick = np.concatenate([np.tile(found, -(-len(other) // (REPEAT * len(found)))), other])
    epochs = max(1, min(EPOCHS // rounds, -(-STEPS * BATCH // len(pick))))
    return fit(x[pick], label[pick].astype(float), net, epochs, BATCH, RATE / DECAY**turn, seed)


def _fitted(shards: DataFrame, groups: list, rounds: int) -> list:
    """A network for each group of windows, by averaging over the shards; None for a
    group without windows of both classes."""
    nets: list = [start() for _ in groups]
    names, ends = list(nets[0]), np.cumsum([v.size for v in nets[0].values()])
    for turn in range(rounds):
        shared = shards.sparkSession.sparkContext.broadcast(nets)

        def run(batches, turn=turn, shared=shared):
            total = np.zeros((len(groups), ends[-1] + 1), np.int64)
            for shard, x, flags in _unpacked(batches):
                for i, group in enumerate(groups):
                    mine = _members(flags, group)
                    if shared.value[i] is not None:
                        net = _local(x[mine], flags[mine], shared.value[i], turn, rounds, (7 * shard + turn) % (1 << 32))
                        if net is not None:
                            flat = np.concatenate([net[k].ravel() for k in names]).astype(float)
                            total[i] += np.append(np.rint(flat * SCALE).astype(np.int64), 1)
            kept = np.flatnonzero(total[:, -1])
            at = np.tile(np.arange(total.shape[1]), len(kept))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(kept, total.shape[1])), pa.array(at), pa.array(total[kept].ravel())],
                ["net", "at", "total"],
            )

        sums = shards.mapInArrow(run, "net long, at long, total long").groupBy("net", "at").agg(F.sum("total").alias("total"))
        sums = sums.toArrow()
        total = np.zeros((len(groups), ends[-1] + 1), np.int64)
        total[sums["net"].to_numpy(), sums["at"].to_numpy()] = sums["total"].to_numpy()
        shared.unpersist()
        for i, row in enumerate(total):
            if nets[i] is None or not row[-1]:
                nets[i] = None
                continue
            parts = np.split((row[:-1] / SCALE / row[-1]).astype(np.float32), ends[:-1])
            nets[i] = {k: p.reshape(nets[i][k].shape) for k, p in zip(names, parts)}
    return nets


def _clear(shards: DataFrame, halves: list) -> DataFrame:
    """The shards without unlabelled windows that the network fitted to the other half
    of the windows takes for secrets."""
    shared = shards.sparkSession.sparkContext.broadcast(halves)

    def run(batches):
        for shard, x, flags in _unpacked(batches):
            keep = np.ones(len(x), bool)
            for half, net in enumerate(reversed(shared.value)):
                mine = np.flatnonzero(_members(flags, half) & ((flags & LABEL) == 0))
                if net is not None:
                    keep[mine] = _outputs(x[mine], net) <= 0
            columns = [[shard], [x[keep].tobytes()], [flags[keep].tobytes()]]
            kinds = (pa.int64(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds)], ["shard", "windows", "flags"]
            )

    return shards.mapInArrow(run, PACKED)


def _outputs(x: np.ndarray, net: dict) -> np.ndarray:
    return pooled(x, net) @ net["v"] + net["c"]


def rounded(out: np.ndarray) -> np.ndarray:
    """The network's output as a whole number of steps."""
    return np.rint(np.clip(out, -40, 40) * OUTPUT_STEPS).astype(np.int64)


def _counts(shards: DataFrame, net: dict | None, group) -> np.ndarray:
    """(label, held, output, number) of the different windows: of a group with their
    outputs, or of all with 0."""
    shared = shards.sparkSession.sparkContext.broadcast(net)

    def run(batches):
        found: Counter = Counter()
        for _, x, flags in _unpacked(batches):
            mine = ((flags & FIRST) != 0) & _members(flags, group)
            x, flags = x[mine], flags[mine]
            out = np.zeros(len(x), np.int64) if shared.value is None else rounded(_outputs(x, shared.value))
            found.update(zip((flags & LABEL).tolist(), _members(flags, "held").tolist(), out.tolist()))
        rows = [(y, int(held), out, n) for (y, held, out), n in found.items()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in (zip(*rows) if rows else [()] * 4)], ["label", "held", "out", "n"]
        )

    rows = shards.mapInArrow(run, "label long, held long, out long, n long").groupBy("label", "held", "out")
    rows = rows.agg(F.sum("n").alias("n")).orderBy("out", "label", "held").toArrow()
    return np.stack([rows[c].to_numpy() for c in ("label", "held", "out", "n")], axis=1)


def train(docs: DataFrame, recall: float = 0.99, shard: int = SHARD, rounds: int = ROUNDS) -> dict | None:
    """Network, calibration and threshold; None without findings of both classes."""
    spark = docs.sparkSession
    small_batches(spark)
    found = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(
        _map_findings, "label int, hash long, window binary"
    )
    with shuffles_removed(spark):
        found = _written(found.distinct(), "secrets-findings")
        sizes = {r["label"]: r["n"] for r in found.groupBy("label").agg(F.count("*").alias("n")).collect()}
        if 1 not in sizes or len(sizes) < 2:
            return None
        shards = _wide(_shards(found, sizes, shard), "secrets-shards")
        with _one_by_one(spark):
            shards = _wide(_clear(shards, _fitted(shards, [0, 1], rounds)), "secrets-clear")
            return _model(shards, sum(sizes.values()), recall, rounds)


def _model(shards: DataFrame, found: int, recall: float, rounds: int) -> dict | None:
    label, held, _, n = _counts(shards, None, "all").T
    number = {(y, h): int(n[(label == y) & (held == h)].sum()) for y in (0, 1) for h in (0, 1)}
    if not all(number[y, 0] + number[y, 1] for y in (0, 1)):
        return None
    split = all(number.values())
    net = _fitted(shards, ["fit" if split else "all"], rounds)[0]
    label, _, out, n = _counts(shards, net, "held" if split else "all").T
    a, b = platt(out / OUTPUT_STEPS, label, count=n)
    p = sigmoid(a * (out / OUTPUT_STEPS) + b)
    below = np.cumsum(n[label == 1])  # outputs ascend, and p with them
    threshold = float(p[label == 1][np.searchsorted(below, int((1 - recall) * below[-1]), "right")])
    hit = p >= threshold
    fitted = number[0, 0] + number[1, 0]
    return {
        "net": net,
        "calibration": (a, b),
        "threshold": threshold,
        "held_recall": float(n[hit & (label == 1)].sum() / n[label == 1].sum()),
        "held_false": float(n[hit & (label == 0)].sum() / n[label == 0].sum()),
        "windows": {"fitted": fitted, "held": sum(number.values()) - fitted, "left_out": found - sum(number.values())},
    }


def _told(spans: list) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def scan(docs: DataFrame, model: dict | None) -> DataFrame:
    """The contract's columns for each row of ``docs`` (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        fitted = shared.value
        for part in blocks(batches):
            texts = [t or "" for t in part.column(1).to_pylist()]
            base = [base_spans(t) for t in texts]
            spans = [list(b) for b in base]
            if fitted:
                more = [(i, s, e) for i, t in enumerate(texts) for s, e in candidates(t, base[i])]
                a, b = fitted["calibration"]
                read = (windows(texts[i], *value(texts[i], s, e)) for i, s, e in more)
                p = sigmoid(a * (rounded(logits(read, fitted["net"])) / OUTPUT_STEPS) + b)
                for (i, s, e), hit in zip(more, p >= fitted["threshold"]):
                    if hit:
                        spans[i].append((s, 3, e))
            kinds = [[k for _, k, _ in b] for b in base]
            yield pa.RecordBatch.from_arrays(
                [part.column(0).cast(pa.int64())]
                + [pa.array([k.count(i) for k in kinds], pa.int64()) for i in range(3)]
                + [
                    pa.array([hashlib.sha256(_told(b).encode()).hexdigest() for b in base], pa.string()),
                    pa.array([_told(sorted(s)) for s in spans], pa.string()),
                ],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
            )

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(
        run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    )


def query(spark, sf_dir):
    """Secrets in every document."""
    docs = read_table(spark, sf_dir, "documents")
    return scan(docs, train(docs))
