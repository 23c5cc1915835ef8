"""N-best segmentation into the pieces of a public SentencePiece model, and decoding.

The pieces of a text form a lattice; a segmentation's score is the sum of its pieces'
scores. Forward Viterbi gives the best score from the start to every place, which is an exact
heuristic for an A-star search backwards from the end: segmentations leave its queue in
order of score. No piece spans two characters that no piece has side by side, so the
lattice falls into units at such places; a text's N best are the best sums over its units, in
which only the N - 1 units with the closest second choice can depart from their best. A
worker remembers units; its memory is bounded and changes no result. New units of up to
``SHORT`` characters are solved together, place by place over all of them.

``segment`` gives the ids of all N: those of the best, and for each segmentation the places where
it departs from the best; ``alternatives`` writes them out, a row for each segmentation, and
``decode`` turns rows of ids into texts. Checksums and the round trip are taken from these ids.

As in the model's own format a space is written U+2581 and one is put before the text; a
literal U+2581 hence reads as a space. A character outside the vocabulary costs the lowest
regular score less ten and becomes its bytes' pieces, so decoding gives every text back.

Defined results: null and empty texts have one segmentation, of no pieces and score 0; a text
with fewer than N segmentations lists all; equal scores are listed in the fixed order of the
search; repeated rows are segmented alike. Further columns of the input are not read.
"""

from __future__ import annotations

from array import array
import heapq
from itertools import chain, islice
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType

from folioweave.llm.common import parts, table

MODEL, BEST, REMEMBERED = "piece_bpe_32k.model", 4, 600_000
SHORT, CELLS = 64, 1 << 16
SPACE, UNKNOWN_COST = "▁", 10.0
_UNITS = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+").findall
_ONE = array("I").itemsize


class Pieces:
    """A model's pieces and the memory of units met so far."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor
        model = SentencePieceProcessor(model_file=path)
        self.edges: dict[str, tuple[tuple[int, ...], float]] = {}
        self.bytes_of: dict[int, int] = {}
        self.spelled: list[bytes] = []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.bytes_of[int(piece[3:5], 16)] = i
                self.spelled.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.spelled.append(b"")
            else:
                self.edges[piece] = ((i,), float(model.get_score(i)))
                self.spelled.append(piece.replace(SPACE, " ").encode())
        self.spelled_bytes = np.frombuffer(b"".join(self.spelled), np.uint8)
        self.spelled_size = np.array([len(s) for s in self.spelled], np.int64)
        self.spelled_at = np.cumsum(self.spelled_size) - self.spelled_size
        self.listed: dict[tuple[str, int], list] = {}
        self.longest = max(map(len, self.edges))
        #: every beginning of a piece; None where it is no piece itself
        self.begun = {p[:i]: None for p in self.edges for i in range(1, len(p))} | self.edges
        regular = [s for _, s in self.edges.values() if s > -1e8]
        self.unknown = min(regular) - UNKNOWN_COST
        self.side_by_side = {p[i:i + 2] for p in self.edges for i in range(len(p) - 1)}
        self._walk()
        self.cores: dict[str, tuple[bytes, float, float]] = {}
        self.units: dict[str, int] = {}
        self.blobs: list[bytes] = []
        self.size = 0
        self.score = np.empty(0)
        self.gap = np.empty(0)
        self.length = np.empty(0, np.int64)

    def _walk(self) -> None:
        """The beginnings of pieces as states, and the next state by (state, class of a character)."""
        begun = sorted(self.begun, key=len)
        number = {"": 0} | {p: k for k, p in enumerate(begun, 1)}
        letters = sorted(set("".join(begun)))
        #: class of every character; 0 is in no piece
        self.kind_of = np.zeros(0x110000, np.int32)
        self.kind_of[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        self.n_kinds = len(letters) + 1
        steps = np.array([number[p[:-1]] for p in begun], np.int64) * self.n_kinds + self.kind_of[
            [ord(p[-1]) for p in begun]]
        order = np.argsort(steps)
        self.steps = np.append(steps[order], np.iinfo(np.int64).max)
        self.stepped = np.append(order + 1, 0).astype(np.int32)
        pieces = [self.begun[p] or ((0,), -np.inf) for p in begun]
        self.state_id = np.array([0] + [ids[0] for ids, _ in pieces], np.int32)
        self.state_score = np.array([-np.inf] + [s for _, s in pieces])

    # many units ----------------------------------------------------------------------

    def solve(self, units: list[str]) -> tuple[list[bytes], list[float], list[float]]:
        """What ``best_and_gap`` gives of each unit; short ones are solved together."""
        size = np.fromiter(map(len, units), np.int64, len(units))
        order = np.argsort(-size, kind="stable")
        blobs, scores, gaps, at = [], [], [], 0
        while at < len(order):
            longest = int(size[order[at]])
            some = order[at:at + (max(1, CELLS // max(1, longest)) if longest <= SHORT else 1)]
            if longest <= SHORT:
                got = self._solve([units[k] for k in some.tolist()], size[some])
            else:
                got = [[one] for one in self.best_and_gap(units[some[0]])]
            for all_of, own in zip((blobs, scores, gaps), got):
                all_of += own
            at += len(some)
        back = np.argsort(order).tolist()
        return [blobs[k] for k in back], [scores[k] for k in back], [gaps[k] for k in back]

    def _solve(self, units: list[str], size: np.ndarray) -> tuple[list[bytes], list[float], list[float]]:
        """Units in descending order of their lengths; rows are places, columns are units."""
        low, wide, n = -np.inf, int(size[0]), len(units)
        points = np.frombuffer("".join(units).encode("utf-32-le"), np.uint32)
        begins = np.cumsum(size) - size
        column = np.repeat(np.arange(n), size)
        cells = (np.arange(len(points)) - begins[column]) * n + column
        kinds = np.zeros(wide * n, np.int64)
        kinds[cells] = self.kind_of[points]
        # scores and states of the pieces of each length, by the place where they start
        scores, states = [], []
        place, state = cells, np.zeros(len(cells), np.int64)
        for length in range(min(self.longest, wide)):
            inside = place + length * n < wide * n
            place, state = place[inside], state[inside]
            steps = state * self.n_kinds + kinds[place + length * n]
            at = np.searchsorted(self.steps, steps)
            hit = self.steps[at] == steps
            place, state = place[hit], self.stepped[at[hit]].astype(np.int64)
            score, held = np.full(wide * n, low), np.full(wide * n, -1, np.int32)
            score[place], held[place] = self.state_score[state], state
            if not length:
                alone = cells[score[cells] == low]
                score[alone], held[alone] = self.unknown, -1
            scores.append(score.reshape(wide, n))
            states.append(held)
        having = [int(np.searchsorted(-size, -j, "right")) for j in range(wide + 1)]    # units of j places or more
        best, back = np.full((wide + 1, n), low), np.zeros((wide + 1, n), np.int8)
        best[0] = 0.0
        for j in range(1, wide + 1):
            m = having[j]
            most, by = best[j, :m], back[j, :m]
            for length in range(min(j, len(scores)), 0, -1):
                s = best[j - length, :m] + scores[length - 1][j - length, :m]
                more = s > most
                np.copyto(most, s, where=more)
                by[more] = length
        taken = np.zeros((wide, n), np.int8)
        unit, end = np.flatnonzero(size), size[size > 0]
        while len(unit):
            length = back[end, unit]
            end = end - length
            taken[end, unit] = length
            unit, end = unit[end > 0], end[end > 0]
        # the best way through every piece off the best path: the best of them is the second
        rest, second = np.full((wide + 1, n), low), np.full(n, low)
        rest[size, np.arange(n)] = 0.0
        for i in range(wide - 1, -1, -1):
            m = having[i + 1]
            for length in range(1, min(len(scores), wide - i) + 1):
                s = scores[length - 1][i, :m] + rest[i + length, :m]
                np.maximum(rest[i, :m], s, out=rest[i, :m])
                s += best[i, :m]
                s[taken[i, :m] == length] = low
                np.maximum(second[:m], s, out=second[:m])
        unit, start = np.nonzero(taken.T)
        length, cell = taken[start, unit], start * n + unit
        state = np.empty(len(cell), np.int32)
        for k in range(len(states)):
            own = length == k + 1
            state[own] = states[k][cell[own]]
        ids, sizes = self.state_id[state], np.ones(len(state), np.int64)
        missing = np.flatnonzero(state < 0)
        spelled = points[begins[unit[missing]] + start[missing]]
        others = {c: [self.bytes_of[b] for b in chr(c).encode()] for c in np.unique(spelled).tolist()}
        sizes[missing] = [len(others[c]) for c in spelled.tolist()]
        out, ends = np.repeat(ids, sizes), np.cumsum(sizes)
        for c, own in others.items():
            out[ends[missing[spelled == c], None] - np.arange(len(own), 0, -1)] = own
        blob = out.astype(np.uint32).tobytes()
        cut = [0, *(np.cumsum(np.bincount(unit, sizes, n)).astype(np.int64) * _ONE).tolist()]
        total = best[size, np.arange(n)]
        return [blob[a:b] for a, b in zip(cut[:-1], cut[1:])], total.tolist(), (total - second).tolist()

    # one unit ------------------------------------------------------------------------

    def lattice(self, unit: str) -> list[list[tuple[int, tuple[int, ...], float]]]:
        """For each end, the (start, ids, score) of the pieces that end there."""
        n, edges, longest = len(unit), self.edges, self.longest
        into: list[list] = [[] for _ in range(n + 1)]
        for i in range(n):
            for j in range(i + 1, min(n, i + longest) + 1):
                edge = edges.get(unit[i:j])
                if edge is not None:
                    into[j].append((i, *edge))
            if unit[i] not in edges:
                ids = tuple(self.bytes_of[b] for b in unit[i].encode())
                into[i + 1].append((i, ids, self.unknown))
        return into

    @staticmethod
    def forward(into) -> list[float]:
        best = [0.0] * len(into)
        for j in range(1, len(into)):
            best[j] = max([best[i] + s for i, _, s in into[j]])
        return best

    def best_and_gap(self, unit: str) -> tuple[bytes, float, float]:
        """Ids of the best segmentation, its score, and how far the second is below."""
        n, known, low = len(unit), self.begun.get, -np.inf
        best, back = [low] * (n + 1), [None] * (n + 1)
        best[0] = 0.0
        edges = []
        for i in range(n):
            here, j = best[i], i
            single = False
            while j < n:
                j += 1
                edge = known(unit[i:j], 0)
                if edge is None:
                    continue
                if edge == 0:
                    break
                single |= j == i + 1
                s = edge[1]
                edges.append((i, j, s))
                s += here
                if s > best[j]:
                    best[j] = s
                    back[j] = i, edge[0]
            if not single:
                edges.append((i, i + 1, self.unknown))
                if here + self.unknown > best[i + 1]:
                    best[i + 1] = here + self.unknown
                    back[i + 1] = i, tuple(self.bytes_of[x] for x in unit[i].encode())
        ids, at, path = [], n, set()
        while at:
            i, piece = back[at]
            ids.append(piece)
            path.add((i, at))
            at = i
        # the best way through every piece off the best path: the best of them is the second
        rest, second = [low] * n + [0.0], low
        for i, j, s in reversed(edges):
            s += rest[j]
            if s > rest[i]:
                rest[i] = s
            s += best[i]
            if s > second and (i, j) not in path:
                second = s
        return (array("I", [x for piece in reversed(ids) for x in piece]).tobytes(), best[n],
                best[n] - second)

    def n_best(self, unit: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
        """Backward A-star over the lattice, forward scores as its heuristic."""
        into = self.lattice(unit)
        best = self.forward(into)
        queue, count, found = [(-best[-1], 0, len(unit), 0.0, None)], 1, []
        while queue and len(found) < n:
            cost, _, at, behind, suffix = heapq.heappop(queue)
            if at == 0:
                ids = []
                while suffix:
                    ids += suffix[0]
                    suffix = suffix[1]
                found.append((-cost, tuple(ids)))
                continue
            for i, piece, s in into[at]:
                heapq.heappush(queue, (-(behind + s + best[i]), count, i, behind + s, (piece, suffix)))
                count += 1
        return found

    # a text --------------------------------------------------------------------------

    def cut(self, text: str) -> list[str]:
        """Units: after a space without it, else from a line feed on or as they stand."""
        if not text:
            return []
        out: list[str] = []
        for k, line in enumerate(text.split("\n")):
            if "  " in line or line.startswith(" ") or SPACE in line:
                marked = ("\n" if k else SPACE) + line.replace(" ", SPACE)
                out += [u[1:] if u[0] == SPACE else u for u in _UNITS(marked)]
            elif k:
                words = line.split(" ")
                words[0] = "\n" + words[0]
                out += words
            else:
                out += line.split(" ")
        return out

    def spell(self, key: str) -> str:
        return key if key[:1] == "\n" else SPACE + key

    def parted(self, unit: str) -> list[str]:
        """The parts of a long unit, cut where no piece spans the two characters."""
        if len(unit) <= SHORT:
            return [unit]
        at = [i for i in range(1, len(unit)) if unit[i - 1:i + 1] not in self.side_by_side]
        return [unit[a:b] for a, b in zip([0, *at], [*at, len(unit)])]

    def learn(self, keys) -> None:
        spelled = {key: self.spell(key) for key in keys}
        parts = {key: self.parted(unit) for key, unit in spelled.items() if len(unit) > SHORT}
        short = [key for key in spelled if key not in parts]
        new = {core for cores in parts.values() for core in cores}.difference(self.cores)
        solved = self.solve([*map(spelled.get, short), *new])
        whole = [one[:len(short)] for one in solved]
        if parts:
            cores = self.cores | dict(zip(new, zip(*[one[len(short):] for one in solved])))
            for key, own in parts.items():
                blobs, totals, gaps = zip(*map(cores.get, own))
                for one, value in zip(whole, (b"".join(blobs), sum(totals), min(gaps))):
                    one.append(value)
            self.cores = dict(islice(cores.items(), REMEMBERED // 2))
        blobs, score, gap = whole
        self.units.update(zip(chain(short, parts), range(len(self.blobs), len(self.blobs) + len(blobs))))
        self.blobs += blobs
        self.score = np.concatenate([self.score, score])
        self.gap = np.concatenate([self.gap, gap])
        self.length = np.concatenate([self.length, np.fromiter(map(len, blobs), np.int64, len(blobs)) // _ONE])

    def forget(self) -> None:
        """Once the memory is full, a call's new units are forgotten by the next."""
        self.size = min(len(self.units), max(self.size, REMEMBERED))
        while len(self.units) > self.size:
            self.units.popitem()
        del self.blobs[self.size:]
        self.score, self.gap, self.length = self.score[:self.size], self.gap[:self.size], self.length[:self.size]

    def encode(self, texts: list[str], n: int = BEST):
        """For each text the best ids, as bytes, and (score, pieces, crc32) of the ``n`` best."""
        for ids, best in self.segmentations(texts, n):
            yield ids, [(score, *checksum(ids, changes)) for score, changes in best]

    def segmentations(self, texts: list[str], n: int = BEST):
        """For each text the best ids, as bytes, and (score, changes of the best ids) of the ``n`` best.

        A change is (first place, number of ids that go, ids that come), in ascending order.
        """
        cuts = [self.cut(t) for t in texts]
        self.forget()
        missing = set().union(*cuts).difference(self.units)
        if missing:
            self.learn(missing)
        known, blob = self.units.__getitem__, self.blobs.__getitem__
        for keys in cuts:
            at = list(map(known, keys))
            yield b"".join(map(blob, at)), self._alternatives(keys, np.array(at, np.int64), n)

    def options(self, key: str, n: int):
        """The ``n`` best of a unit; the units that depart in one text often do in others."""
        found = self.listed.get((key, n))
        if found is None:
            found = self.n_best(self.spell(key), n)
            if len(self.listed) < REMEMBERED // 20:
                self.listed[key, n] = found
        return found

    def _alternatives(self, keys, at, n):
        total = float(self.score[at].sum()) if len(at) else 0.0
        gap = self.gap[at]
        near = np.flatnonzero(np.isfinite(gap))
        if len(near) > n - 1:
            near = near[np.argsort(gap[near], kind="stable")[:n - 1]]
        choices: list[tuple[float, tuple]] = [(0.0, ())]
        departs: dict[int, list] = {}
        for place in sorted(near.tolist()):
            options = self.options(keys[place], n)
            grown = [(loss + options[0][0] - s, held + ((place, k),)) for loss, held in choices
                     for k, (s, _) in enumerate(options)]
            grown.sort(key=lambda g: g[0])
            choices = grown[:n]
            departs[place] = options
        starts = np.concatenate(([0], np.cumsum(self.length[at])))
        return [(total - loss, [(int(starts[place]), int(starts[place + 1] - starts[place]), departs[place][k][1])
                                for place, k in held if k]) for loss, held in choices]

    def decode(self, ids: np.ndarray) -> str:
        """The text of a sequence of ids: the space before it falls away."""
        size = self.spelled_size[ids]
        ends = np.cumsum(size)
        at = np.repeat(self.spelled_at[ids] - ends + size, size) + np.arange(ends[-1] if len(ids) else 0)
        text = self.spelled_bytes[at].tobytes()
        return (text[1:] if text[:1] == b" " else text).decode("utf-8", "replace")


def checksum(ids: bytes, changes) -> tuple[int, int]:
    """Number and crc32 of the ids after the changes."""
    crc, done, size, view = 0, 0, 0, memoryview(ids)
    for at, gone, come in changes:
        crc = zlib.crc32(view[done:at * _ONE], crc)
        other = array("I", come).tobytes()
        crc = zlib.crc32(other, crc)
        size += at * _ONE - done + len(other)
        done = (at + gone) * _ONE
    return (size + len(ids) - done) // _ONE, zlib.crc32(view[done:], crc)


_models: dict[str, Pieces] = {}


def pieces(path: str) -> Pieces:
    if path not in _models:
        _models[path] = Pieces(path)
    return _models[path]


_BESTS = pa.list_(pa.struct([("score", pa.float64()), ("n_pieces", pa.int32()),
                             ("ids_crc32", pa.int64())]))
_CHANGES = pa.list_(pa.list_(pa.struct([("at", pa.int32()), ("gone", pa.int32()),
                                        ("come", pa.list_(pa.int32()))])))


def segment(docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = BEST,
            model: str | None = None) -> DataFrame:
    """Best ids, the ``n`` best segmentations, and whether decoding gives the text back.

    ``best`` has scores, numbers of pieces and checksums; ``changes`` has for each of them the
    places of ``ids`` (from 0) where it departs: ``gone`` ids go from ``at`` on, ``come`` come.
    """
    path = model or public_tokenizers.path(MODEL)
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        held = pieces(path)
        for batch in batches:
            column = batch.column("text")
            for low, rows in parts(column, 2 << 20):
                texts = column.slice(low, rows).to_pylist()
                got = list(held.segmentations(texts, n))
                ends = np.cumsum([0] + [len(g[0]) // _ONE for g in got]).astype(np.int32)
                flat = np.frombuffer(b"".join([g[0] for g in got]), np.int32)
                same = [held.decode(flat[a:b]) == t.replace(SPACE, " ") for a, b, t in
                        zip(ends[:-1].tolist(), ends[1:].tolist(), texts)]
                bests = [[dict(zip(("score", "n_pieces", "ids_crc32"), (s, *checksum(ids, changes))))
                          for s, changes in best] for ids, best in got]
                changes = [[[{"at": a, "gone": g, "come": c} for a, g, c in changes] for _, changes in best]
                           for _, best in got]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(low, rows),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                     pa.array(bests, _BESTS), pa.array(changes, _CHANGES), pa.array(same)],
                    ["doc_id", "ids", "best", "changes", "round_trip"])

    rows = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, ids array<int>, best array<struct<score: double, "
                                "n_pieces: int, ids_crc32: long>>, changes array<array<struct<at: int, "
                                "gone: int, come: array<int>>>>, round_trip boolean")


def alternatives(segmented: DataFrame) -> DataFrame:
    """(doc_id, rank, score, ids): every segmentation that ``segment`` found, with its own ids."""
    rows = segmented.select("doc_id", F.col("ids").alias("first"), F.posexplode(F.arrays_zip("best", "changes")))
    start = F.struct(F.lit(0).alias("done"), F.slice("first", 1, 0).alias("out"))
    ids = F.aggregate(
        "col.changes", start,
        lambda s, c: F.struct((c["at"] + c["gone"]).alias("done"), F.concat(
            s["out"], F.slice("first", s["done"] + 1, c["at"] - s["done"]), c["come"]).alias("out")),
        lambda s: F.concat(s["out"], F.slice("first", s["done"] + 1, F.size("first") - s["done"])))
    return rows.select("doc_id", (F.col("pos") + 1).alias("rank"), F.col("col.best.score").alias("score"),
                       ids.alias("ids"))


def decode(rows: DataFrame, ids: str = "ids", text: str = "text", model: str | None = None) -> DataFrame:
    """The rows with the ``text`` that their ``ids`` spell; null ids give null, unknown ids an error.

    The column replaces one of that name in the input.
    """
    path = model or public_tokenizers.path(MODEL)

    def spell(column: pa.Array) -> pa.Array:
        held, out = pieces(path), []
        for some in column:
            if not some.is_valid:
                out.append(None)
                continue
            given = some.values.to_numpy(zero_copy_only=False)
            if len(given) and not (given.min() >= 0 and given.max() < len(held.spelled)):
                raise ValueError("an id that the model does not have")
            out.append(held.decode(given.astype(np.int64)))
        return pa.array(out, pa.string())

    spell.__annotations__ = {"column": pa.Array, "return": pa.Array}
    return rows.withColumn(text, F.arrow_udf(spell, StringType())(F.col(ids)))


def op1_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segment(table(spark, sf_dir, "documents"))


QUERIES = {"op1_pieces": op1_pieces}
ORACLES: dict[str, str] = {}
