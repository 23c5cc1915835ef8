"""Secret scans: three exact rules, and a character convolutional network over every candidate.

A candidate is each longest run of twelve or more bytes of ``A-Za-z0-9+/_.=-`` in a whole text. The
network reads its bytes with 24 bytes before and 8 after: one convolution of width five (a table
of byte weights for each place, added up), the maximum and mean of its outputs over the candidate
and the maxima over both contexts, one hidden layer, one score. Runs of any length are read
whole, because the maxima and means do not depend on length.

It learns from labelled findings: a candidate that a rule's span touches is a finding, every other one
is not. ``train`` takes every distinct candidate of all documents. A fifth of them is held out; the others
are dealt by hash over shards of about ``SHARD``, and each round every shard's candidates teach a copy of
the network in a task of their own, both labels in equal parts; the copies' mean begins the next round.
The first shard alone gives the start. Labels that are rare in a shard's size are dealt to several
shards. Half of the findings' left contexts are blanked while learning, so the characters themselves must
speak. The scores of all held-out candidates, counted in steps of 1 / ``STEPS``, give Platt's calibration (labels
weigh the same) and for each kind of place (after a ``:`` or ``=``, or bare) the highest threshold that still
finds ``RECALL`` of the held-out findings, moved halfway down to the likeliest other candidate where that one is
lower, and never below one half. Findings of named places count for bare ones too, with their left context
blanked. Without findings for a kind of place, or without other candidates at all, nothing is added there.

Spans are in code points, end exclusive. Rules' spans always stay; the network adds candidates that
no such span touches, as kind ``model``.

Defined results: null texts are empty; empty texts have no span and the hash of the empty string; repeated
rows and rows with a null id are scanned alike; an empty table gives no rows. Extra columns are not read.
"""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass
import hashlib
from math import ceil
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from folioweave.llm.common import parts, ranges_of, stored, table, text_buffer, word_hashes
from folioweave.llm.terms import LOWERED, gathered

RECALL, SEED = 0.98, 12
LEAST, LEFT, RIGHT = 12, 24, 8
WIDTH, FILTERS, HIDDEN, BATCH = 5, 16, 16, 256
# Candidates of a shard, findings (or others) that it has at least, and rounds over all shards.
SHARD, LEAST_OF_LABEL, ROUNDS = 50_000, 512, 2
# Batches that a shard which learns alone, and each shard of a round, learns at least.
ALONE, SHARED = 900, 300
# Scores are counted in steps of 1 / STEPS, up to so far from zero.
STEPS, FARTHEST = 256, 64
KINDS = ("assign", "access", "hex", "model")

# The rules.
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
LEAST_VALUE, LEAST_ACCESS, LEAST_HEX = 12, 18, 16

_HEX = np.zeros(256, bool)
_HEX[list(b"0123456789abcdef")] = True
_RUN = np.zeros(256, bool)
_RUN[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-")] = True
_QUIET = np.zeros(256, bool)                    # may stand between a sign and its value
_QUIET[list(b"\"' ")] = True


def rule_spans(data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, kind, end) in bytes of every rule's spans, in order of start and kind."""
    raw, low = data.tobytes(), LOWERED[data].tobytes()
    bounds = offsets.tolist()
    out = []
    for kind, marks, pattern in ((0, KEYWORDS, ASSIGN), (1, (b"AKIA",), ACCESS)):
        where = low if kind == 0 else raw
        rows = set()
        for mark in marks:                      # only rows that hold a mark are searched
            at = where.find(mark)
            while at >= 0:
                row = bisect_right(bounds, at) - 1
                rows.add(row)
                at = where.find(mark, bounds[row + 1])
        for row in rows:
            for m in pattern.finditer(raw, bounds[row], bounds[row + 1]):
                enough = len(m[2]) >= LEAST_VALUE if kind == 0 else m.end() - m.start() >= LEAST_ACCESS
                if enough:
                    out.append((m.start(), kind, m.end()))
    starts, ends = ranges_of(_HEX[data], offsets)
    long = ends - starts >= LEAST_HEX
    out += [(s, 2, e) for s, e in zip(starts[long].tolist(), ends[long].tolist())]
    return sorted(out)


@dataclass(frozen=True)
class Candidates:
    """Candidates of a stretch of texts, with the bytes that the network reads of each."""

    starts: np.ndarray
    ends: np.ndarray
    rows: np.ndarray
    befores: np.ndarray             # where the left context begins
    afters: np.ndarray              # where the right context ends
    named: np.ndarray               # a sign of assignment stands before the candidate


def candidates(data: np.ndarray, offsets: np.ndarray) -> Candidates:
    starts, ends = ranges_of(_RUN[data], offsets)
    long = ends - starts >= LEAST
    starts, ends = starts[long], ends[long]
    rows = np.searchsorted(offsets, starts, side="right") - 1
    befores = np.maximum(starts - LEFT, offsets[rows])
    afters = np.minimum(ends + RIGHT, offsets[rows + 1])
    at = starts - 1                              # the nearest byte before, past quotes and spaces
    for _ in range(LEFT):
        at = np.where((at >= befores) & _QUIET[data[np.maximum(at, 0)]], at - 1, at)
    before = np.where(at >= befores, data[np.maximum(at, 0)] if len(data) else 0, 0)
    sign = (before == ord(":")) | (before == ord("="))
    # "name=value" is one run: its own sign counts as well
    inner = np.concatenate(([0], np.cumsum(data == ord("="))))
    trailing = np.minimum(ends, starts + LEFT)
    return Candidates(starts, ends, rows, befores, afters, sign | (inner[trailing] > inner[starts]))


def touched(found: Candidates, spans: list[tuple[int, int, int]]) -> np.ndarray:
    """Which candidates share a byte with a rule's span."""
    edge = np.zeros(len(found.starts), bool)
    if spans and len(edge):
        first = np.searchsorted(found.ends, [s for s, _, _ in spans], side="right")
        last = np.searchsorted(found.starts, [e for _, _, e in spans], side="left")
        marks = np.zeros(len(edge) + 1, np.int64)
        np.add.at(marks, np.minimum(first, last), 1)
        np.add.at(marks, last, -1)
        edge = np.cumsum(marks[:-1]) > 0
    return edge


class Windows:
    """Bytes of many candidates in one row, blanks between them, and the segments of each.

    Segments are left context, candidate and right context; each context has a blank of its own,
    so none is empty.
    """

    def __init__(self, data, befores, starts, ends, afters, blank_left=None):
        sizes = afters - befores + 4
        index, at = gathered(befores - 2, sizes)
        place = index - np.repeat(befores, sizes)
        inside = (place >= 0) & (place < np.repeat(afters - befores, sizes))
        self.codes = np.where(inside, data[np.clip(index, 0, max(len(data) - 1, 0))], 0)
        if blank_left is not None:
            left = place < np.repeat(starts - befores, sizes)
            self.codes[left & np.repeat(blank_left, sizes)] = 0
        begin = at[:-1]
        self.cuts = np.stack([begin, begin + 2 + starts - befores, begin + 2 + ends - befores], 1).reshape(-1)
        self.inner = (ends - starts).astype(np.float32)
        self.n = len(starts)


@dataclass
class Network:
    tables: np.ndarray              # (WIDTH, 256, FILTERS)
    bias: np.ndarray
    hidden: np.ndarray              # (4 FILTERS + 1, HIDDEN)
    hidden_bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    @classmethod
    def new(cls, rng: np.random.Generator) -> "Network":
        def normal(*shape, by):
            return (rng.standard_normal(shape) * by).astype(np.float32)
        return cls(normal(WIDTH, 256, FILTERS, by=0.3), np.zeros(FILTERS, np.float32),
                   normal(4 * FILTERS + 1, HIDDEN, by=0.2), np.zeros(HIDDEN, np.float32),
                   normal(HIDDEN, by=0.3), np.zeros(1, np.float32))

    def parts(self) -> list[np.ndarray]:
        return [self.tables, self.bias, self.hidden, self.hidden_bias, self.out, self.out_bias]

    def _convolved(self, codes: np.ndarray) -> np.ndarray:
        total = np.broadcast_to(self.bias, (len(codes), FILTERS)).copy()
        padded = np.pad(codes, WIDTH // 2)
        for k in range(WIDTH):
            total += self.tables[k][padded[k:k + len(codes)]]
        return np.maximum(total, 0, out=total)

    def _pooled(self, w: Windows, active: np.ndarray):
        tops = np.maximum.reduceat(active, w.cuts).reshape(w.n, 3, FILTERS)
        inner = np.add.reduceat(active, w.cuts).reshape(w.n, 3, FILTERS)[:, 1] / w.inner[:, None]
        return np.concatenate([tops.reshape(w.n, -1), inner, np.log(w.inner)[:, None] / 4], 1), tops

    def scores(self, w: Windows) -> np.ndarray:
        if not w.n:
            return np.empty(0, np.float32)
        pooled, _ = self._pooled(w, self._convolved(w.codes))
        return np.maximum(pooled @ self.hidden + self.hidden_bias, 0) @ self.out + self.out_bias[0]

    def gradients(self, w: Windows, labels: np.ndarray) -> list[np.ndarray]:
        """Of the mean logistic loss, in the order of ``parts``."""
        active = self._convolved(w.codes)
        pooled, tops = self._pooled(w, active)
        middle = np.maximum(pooled @ self.hidden + self.hidden_bias, 0)
        wrong = (1 / (1 + np.exp(-(middle @ self.out + self.out_bias[0]))) - labels) / w.n
        back = wrong[:, None] * self.out * (middle > 0)
        flow = back @ self.hidden.T
        # through the maxima to the places that reach them, and evenly through the means
        lengths = np.diff(np.append(w.cuts, len(w.codes)))
        highest = np.repeat(tops.reshape(-1, FILTERS), lengths, 0)
        given = np.repeat(flow[:, :3 * FILTERS].reshape(-1, FILTERS), lengths, 0) * (active == highest)
        mean = np.zeros((w.n, 3, FILTERS), np.float32)
        mean[:, 1] = flow[:, 3 * FILTERS:4 * FILTERS] / w.inner[:, None]
        given = (given + np.repeat(mean.reshape(-1, FILTERS), lengths, 0)) * (active > 0)
        tables, padded = np.zeros_like(self.tables), np.pad(w.codes, WIDTH // 2)
        for k in range(WIDTH):
            codes = padded[k:k + len(w.codes)]
            order = np.argsort(codes, kind="stable")
            known, first = np.unique(codes[order], return_index=True)
            tables[k][known] = np.add.reduceat(given[order], first)
        return [tables, given.sum(0), pooled.T @ back, back.sum(0), middle.T @ wrong,
                np.array([wrong.sum()], np.float32)]


@dataclass(frozen=True)
class Model:
    """A trained network, its calibration and its threshold for bare and for named places."""

    network: Network
    slope: float
    shift: float
    thresholds: tuple[float, float]
    held_out: dict

    def probability(self, scores: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.slope * scores.astype(np.float64) + self.shift)))


def _stretches(column: pa.Array):
    for low, n in parts(column, 2 << 20):
        yield (low, n, *text_buffer(column.slice(low, n)))


def _labelled(batches):
    """Distinct candidates of each stretch: hash, label, kind of place, bytes and the candidate's place in them."""
    for batch in batches:
        for _, _, data, offsets in _stretches(batch.column("text")):
            found = candidates(data, offsets)
            if not len(found.starts):
                continue
            label = touched(found, rule_spans(data, offsets))
            h = word_hashes(data, found.befores, found.afters)
            start, size = found.starts - found.befores, found.ends - found.starts
            order = np.lexsort((size, start, found.named, label, h))
            keys = np.stack([h.view(np.int64), label, found.named, start, size])[:, order]
            kept = order[np.concatenate(([True], (keys[:, 1:] != keys[:, :-1]).any(0)))]
            raw = data.tobytes()
            yield pa.RecordBatch.from_pydict({
                "h": h[kept].view(np.int64), "label": label[kept], "named": found.named[kept],
                "start": start[kept], "size": size[kept],
                "window": pa.array([raw[a:b] for a, b in zip(found.befores[kept].tolist(),
                                                             found.afters[kept].tolist())], pa.binary())})


def labelled(docs: DataFrame, text: str = "text") -> DataFrame:
    """Every distinct candidate of all documents with its label; the same rows for any partitioning."""
    rows = docs.select(F.col(text).alias("text")).mapInArrow(
        _labelled, "h long, label boolean, named boolean, start long, size long, window binary")
    return rows.withColumn("h", F.shiftrightunsigned("h", 1)).dropDuplicates(
        ["h", "label", "named", "start", "size"])


def _first(rows: DataFrame, limit: int) -> DataFrame:
    taken = None
    for label in (False, True):
        for named in (False, True):
            own = rows.where((F.col("label") == label) & (F.col("named") == named)).orderBy(
                "h", "start", "size").limit(limit)
            taken = own if taken is None else taken.unionByName(own)
    return taken


def findings(docs: DataFrame, limit: int, text: str = "text"):
    """A look at the labelled candidates: at most ``limit`` of each label and kind of place, as pandas rows."""
    return _first(labelled(docs, text), limit).toPandas().sort_values(
        ["label", "named", "h", "start", "size"], ignore_index=True)


class Lesson:
    """Labelled candidates in order of their hashes, and their bytes in one row."""

    def __init__(self, rows: pa.Table):
        rows = rows.sort_by([(name, "ascending") for name in ("h", "label", "named", "start", "size")])
        raw = rows.column("window").to_pylist()
        at = np.concatenate(([0], np.cumsum([len(x) for x in raw]))).astype(np.int64)
        self.data, self.befores, self.afters = np.frombuffer(b"".join(raw), np.uint8), at[:-1], at[1:]
        self.starts = self.befores + rows.column("start").to_numpy()
        self.ends = self.starts + rows.column("size").to_numpy()
        self.label, self.named = (np.array(rows.column(c).to_pylist(), bool) for c in ("label", "named"))

    def windows(self, chosen: np.ndarray, blank_left=None) -> Windows:
        return Windows(self.data, *(x[chosen] for x in (self.befores, self.starts, self.ends, self.afters)),
                       blank_left)


def _in_turn(rng: np.random.Generator, places: np.ndarray, n: int) -> np.ndarray:
    """``n`` places, each as often as any other: one shuffled turn after the other."""
    return np.concatenate([rng.permutation(places) for _ in range(ceil(n / len(places)))])[:n]


def taught(network: Network, lesson: Lesson, least: int, rng: np.random.Generator) -> Network:
    """The network after whole turns over a lesson, of at least so many batches; every candidate is learned from."""
    good, bad = np.flatnonzero(lesson.label), np.flatnonzero(~lesson.label)
    if not len(good) or not len(bad):
        return network
    network = Network(*[p.copy() for p in network.parts()])
    first, second = ([np.zeros_like(p) for p in network.parts()] for _ in range(2))
    half = BATCH // 2
    turn = ceil(max(len(good), len(bad)) / half)
    steps = turn * max(1, ceil(least / turn))
    ups, downs = _in_turn(rng, good, steps * half), _in_turn(rng, bad, steps * half)
    for step in range(1, steps + 1):
        own = slice((step - 1) * half, step * half)
        chosen = np.concatenate([ups[own], downs[own]])
        blank = lesson.label[chosen] & (rng.random(BATCH) < 0.5)
        moved = network.gradients(lesson.windows(chosen, blank), lesson.label[chosen].astype(np.float32))
        for p, g, a, b in zip(network.parts(), moved, first, second):        # Adam
            a += 0.1 * (g - a)
            b += 0.001 * (g * g - b)
            p -= 0.004 * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.999 ** step)) + 1e-8)
    return network


_SUMS = "part long, weight double, sums array<double>"


def _added_up(rows: list[tuple[int, float, np.ndarray]], part: int) -> pa.Table:
    """Weighted parameters added up in order of their parts, so the sum's last bits are always the same."""
    rows = sorted(rows, key=lambda r: r[0])
    return pa.table({"part": [part], "weight": [float(sum(w for _, w, _ in rows))],
                     "sums": pa.array([np.sum([v for _, _, v in rows], axis=0)], pa.list_(pa.float64()))})


def _round(dealt: DataFrame, network: Network, least: int, turn: int) -> Network:
    """The mean of the copies that each shard taught, weighted by their candidates."""
    def learn(rows: pa.Table) -> pa.Table:
        shard = rows.column("shard")[0].as_py()
        copy = taught(network, Lesson(rows), least, np.random.default_rng([SEED, turn, shard]))
        values = np.concatenate([p.reshape(-1) for p in copy.parts()]).astype(np.float64)
        return _added_up([(shard, float(rows.num_rows), values * rows.num_rows)], shard)

    def add(rows: pa.Table) -> pa.Table:
        each = [(r["part"], r["weight"], np.array(r["sums"])) for r in rows.to_pylist()]
        return _added_up(each, each[0][0] // 32)

    copies = dealt.groupBy("shard").applyInArrow(learn, _SUMS)
    sums = copies.groupBy(F.floor(F.col("part") / 32)).applyInArrow(add, _SUMS).orderBy("part").toArrow()
    mean = np.sum(np.array(sums.column("sums").to_pylist()), axis=0) / sum(sums.column("weight").to_pylist())
    out, at = [], 0
    for p in network.parts():
        out.append(mean[at:at + p.size].reshape(p.shape).astype(np.float32))
        at += p.size
    return Network(*out)


def _learned(rows: DataFrame, sizes: dict[bool, int]) -> Network:
    """A network taught by every row; ``sizes`` counts the rows of each label."""
    network = Network.new(np.random.default_rng(SEED))
    shards = ceil(sum(sizes.values()) / SHARD)
    copies = {label: min(shards, ceil(LEAST_OF_LABEL * shards / n)) for label, n in sizes.items()}
    turns = F.when(F.col("label"), copies[True]).otherwise(copies[False]) - 1
    dealt = rows.withColumn("copy", F.explode(F.sequence(F.lit(0), turns))).withColumn(
        "shard", F.pmod(F.xxhash64("h", "start", "size") + F.col("copy"), F.lit(shards)).cast("long"))
    if shards == 1:
        return _round(dealt, network, ALONE, 0)
    network = _round(dealt.where("shard = 0"), network, ALONE, 0)
    for turn in range(1, ROUNDS + 1):
        network = _round(dealt, network, SHARED, turn)
    return network


def _scores(rows: DataFrame, network: Network) -> list[tuple]:
    """(label, named, bared, score, count) of all rows; bared: a named finding without its left context."""
    def count(batches):
        for batch in batches:
            lesson = Lesson(pa.Table.from_batches([batch]))
            every = np.arange(len(lesson.label))
            moved = every[lesson.label & lesson.named]
            for low in range(0, len(every) + len(moved), 4096):
                own, bare = every[low:low + 4096], moved[low:low + 4096]
                score = np.concatenate([network.scores(lesson.windows(own)),
                                        network.scores(lesson.windows(bare, np.ones(len(bare), bool)))])
                at = np.clip(np.floor(score.astype(np.float64) * STEPS), -FARTHEST * STEPS, FARTHEST * STEPS)
                chosen = np.concatenate([own, bare])
                keys, n = np.unique(np.stack([lesson.label[chosen], lesson.named[chosen],
                                              np.arange(len(chosen)) >= len(own), at]).astype(np.int64),
                                    axis=1, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(k.astype(bool)) for k in keys[:3]), pa.array(keys[3]), pa.array(n.astype(np.int64))],
                    ["label", "named", "bared", "step", "n"])

    counted = rows.mapInArrow(count, "label boolean, named boolean, bared boolean, step long, n long")
    return counted.groupBy("label", "named", "bared", "step").agg(F.sum("n").alias("n")).orderBy(
        "label", "named", "bared", "step").collect()        # at most 32,769 steps of each kind


def fit(rows: DataFrame, recall: float = RECALL) -> Model | None:
    """A model of all labelled candidates; None where a label is missing."""
    held = F.expr("(h div 7) % 5 = 0")
    sizes = {(r["label"], r["held"]): r["count"]
             for r in rows.groupBy("label", held.alias("held")).count().collect()}
    if not all(sizes.get((label, False)) for label in (True, False)):
        return None
    network = _learned(rows.where(~held), {label: sizes[label, False] for label in (True, False)})
    judged = rows.where(held) if all(sizes.get((label, True)) for label in (True, False)) else rows
    counted = _scores(judged, network)
    label, named, bared = (np.array([r[i] for r in counted], bool) for i in range(3))
    scores = np.array([r["step"] for r in counted], np.float64) / STEPS
    counts = np.array([r["n"] for r in counted], np.int64)
    slope, shift = _platt(scores[~bared], label[~bared], counts[~bared])
    model = Model(network, slope, shift, (1.0, 1.0), {})
    probability, thresholds, report = model.probability(scores), [], {}
    for place in (False, True):
        hits = label & np.where(bared, not place, named == place)     # bared findings as in a bare place
        others = ~label & (named == place)
        total = int(counts[hits].sum())
        if not total:
            thresholds.append(2.0)              # nothing to hold a recall on: nothing is added
            continue
        order = np.flatnonzero(hits)[np.argsort(-probability[hits], kind="stable")]
        reached = float(probability[order][np.searchsorted(np.cumsum(counts[order]), ceil(recall * total))])
        level = max(0.5, _between(probability[others].max(initial=0.0), reached))
        thresholds.append(level)
        above = probability >= level
        report["named" if place else "bare"] = {
            "findings": total, "recall": float(counts[hits & above].sum() / total),
            "others": int(counts[others].sum()), "false": int(counts[others & above].sum())}
    return Model(network, slope, shift, tuple(thresholds), report)


def _between(other: float, reached: float) -> float:
    """Halfway, in log odds, from the likeliest other candidate up to ``reached``; that, if it is lower."""
    if other >= reached:
        return reached
    odds = [np.log(x / (1 - x)) for x in np.clip([other, reached], 1e-9, 1 - 1e-9)]
    return float(1 / (1 + np.exp(-np.mean(odds))))


def _platt(scores: np.ndarray, label: np.ndarray, counts: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve of counted scores, by Newton's method on smoothed labels of equal weight."""
    good, bad = counts[label].sum(), counts[~label].sum()
    weight = counts * np.where(label, (good + bad) / 2 / good, (good + bad) / 2 / bad)
    aim = np.where(label, (good + 1) / (good + 2), 1 / (bad + 2))
    design = np.stack([scores, np.ones_like(scores)], 1)
    at = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ at, -30, 30)))
        curve = (design * (weight * p * (1 - p))[:, None]).T @ design + 1e-6 * np.eye(2)
        move = np.linalg.solve(curve, design.T @ (weight * (p - aim)))
        at = at - np.clip(move, -2, 2)
    return float(max(at[0], 1e-6)), float(at[1])


def train(docs: DataFrame, limit: int | None = None, recall: float = RECALL, text: str = "text") -> Model | None:
    """The network of a corpus, from all its own labelled candidates, or the first ``limit`` of each kind."""
    rows = labelled(docs, text)
    return fit(stored(rows if limit is None else _first(rows, limit)), recall)


def added(model: Model | None, data: np.ndarray, offsets: np.ndarray,
          spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Candidates beyond the rules' spans that the model takes for secrets."""
    found = candidates(data, offsets)
    if model is None or not len(found.starts):
        return []
    probability = np.empty(len(found.starts))
    sizes = np.cumsum(found.afters - found.befores)
    at = 0
    while at < len(probability):                # about 200,000 places at a time
        stop = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + 200_000)))
        w = Windows(data, *(x[at:stop] for x in (found.befores, found.starts, found.ends, found.afters)))
        probability[at:stop] = model.probability(model.network.scores(w))
        at = stop
    level = np.where(found.named, model.thresholds[1], model.thresholds[0])
    new = (probability >= level) & ~touched(found, spans)
    return [(s, 3, e) for s, e in zip(found.starts[new].tolist(), found.ends[new].tolist())]


def _scanned(model: Model | None):
    def text_of(rows):
        return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in rows)

    def run(batches):
        for batch in batches:
            for low, n, data, offsets in _stretches(batch.column("text")):
                spans = rule_spans(data, offsets)
                every = sorted(spans + added(model, data, offsets, spans))
                follows = np.concatenate(([0], np.cumsum((data & 0xC0) == 0x80)))
                where = np.array([(s, e) for s, _, e in every], np.int64).reshape(-1, 2)
                rows = np.searchsorted(offsets, where[:, 0], side="right") - 1
                begin = offsets[rows][:, None]
                points = where - begin - (follows[where] - follows[begin])       # bytes to code points
                each: list[list] = [[] for _ in range(n)]
                for row, (s, e), (_, kind, _) in zip(rows.tolist(), points.tolist(), every):
                    each[row].append((s, kind, e))
                base = [[x for x in own if x[1] < 3] for own in each]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(low, n),
                     *[pa.array([sum(x[1] == k for x in own) for own in base], pa.int64()) for k in range(3)],
                     pa.array([hashlib.sha256(text_of(own).encode()).hexdigest() for own in base]),
                     pa.array([text_of(own) for own in each])],
                    ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])
    return run


def scan(docs: DataFrame, model: Model | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, counts and hash of the rules' spans, and all spans of every whole text."""
    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("id"), F.col(text).alias("text")).mapInArrow(
        _scanned(model), f"doc_id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, "
        "spans string")


def op12_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return scan(docs, train(docs))


QUERIES = {"op12_secrets": op12_secrets}
ORACLES: dict[str, str] = {}
