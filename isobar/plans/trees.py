"""Trees grown by numpy over binned rows, as deep as asked and in bounded memory.

A table is a sequence of blocks: bins of every feature (``uint8``, a row per
feature) and labels.  A tree draws its rows from the blocks; while more than
``rows`` of them lie in one node, they stay in a file and the node is split by
reading it, and from there on its whole subtree is grown in memory.
"""

from __future__ import annotations

import math
import tempfile
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np

#: Rows of one subtree in memory, rows of one block, histogram cells looked at together, and bytes of histograms kept for the next level.
LOCAL_ROWS = 1_000_000
BLOCK_ROWS = 65_536
CELLS = 65_536
KEPT_BYTES = 64 << 20

Block = tuple[np.ndarray, np.ndarray, np.ndarray]  # bins by feature, labels, weights


@dataclass(frozen=True)
class Shape:
    """What a tree may look like: features, bins of one, levels, features tried at a node, and whether labels are classes 0 and 1.

    Trees of classes keep twice the bin plus the class, so that one count does for both.
    """

    features: int
    bins: int
    depth: int
    tried: int
    classes: bool


class Spool:
    """Blocks in a file of its own, in the order they were added."""

    def __init__(self, features: int):
        self.features, self.sizes, self.waiting, self.rows = features, [], [], 0
        self.file = tempfile.TemporaryFile()

    def add(self, bins: np.ndarray, y: np.ndarray, w: np.ndarray) -> None:
        self.waiting.append((bins, y, w))
        self.rows += len(y)
        if sum(len(b[1]) for b in self.waiting) >= BLOCK_ROWS:
            self._flush()

    def _flush(self) -> None:
        if self.waiting:
            bins, y, w = (np.concatenate(parts, axis=-1) for parts in zip(*self.waiting))
            self.waiting = []
            for part in (bins.astype(np.uint8), y.astype(np.float64), w.astype(np.uint8)):
                self.file.write(np.ascontiguousarray(part).data)
            self.sizes.append(len(y))

    def __iter__(self) -> Iterator[Block]:
        self._flush()
        self.file.seek(0)
        for n in self.sizes:
            data = self.file.read(n * (self.features + 9))
            bins = np.frombuffer(data, np.uint8, n * self.features).reshape(self.features, n)
            y = np.frombuffer(data, np.float64, n, n * self.features)
            yield bins, y, np.frombuffer(data, np.uint8, n, n * (self.features + 8))

    def close(self) -> None:
        self.file.close()


@dataclass
class Nodes:
    """Nodes in the order they were made, children after their parents; a leaf has no children (-1)."""

    parts: list[dict[str, np.ndarray]] = field(default_factory=list)
    made: int = 0

    def add(self, level: int, count: np.ndarray, total: np.ndarray, squares: np.ndarray) -> dict[str, np.ndarray]:
        k = len(count)
        part = {"id": np.arange(self.made, self.made + k), "level": np.full(k, level), "count": count, "total": total, "squares": squares}
        part |= {c: np.full(k, -1) for c in ("left", "right", "feature", "bin")} | {"gain": np.full(k, -1.0)}
        self.parts.append(part)
        self.made += k
        return part

    def table(self) -> dict[str, np.ndarray]:
        return {c: np.concatenate([p[c] for p in self.parts]) for c in self.parts[0]}


def impurity(shape: Shape, count: np.ndarray, total: np.ndarray, squares: np.ndarray) -> np.ndarray:
    """Gini impurity of two classes, or variance; what is left by rounding is 0."""
    mean = total / count
    if shape.classes:
        return 2 * mean * (1 - mean)
    found = squares / count - mean * mean
    return np.where(found > 1e-12 * squares / count, found, 0.0)


def best_splits(counts: np.ndarray, totals: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place among the tried features, bin and gain of the best split of every node, from histograms (node, feature, bin)."""
    left, left_sum = counts.cumsum(2), totals.cumsum(2)
    count, total = left[:, :, -1:], left_sum[:, :, -1:]
    left, left_sum = left[:, :, :-1], left_sum[:, :, :-1]
    right, right_sum = count - left, total - left_sum
    with np.errstate(divide="ignore", invalid="ignore"):
        score = left_sum * left_sum / left + right_sum * right_sum / right
    score[(left < 1) | (right < 1)] = -np.inf
    score = score.reshape(len(score), -1)
    at = score.argmax(1)
    whole, sums = count[:, 0, 0], total[:, 0, 0]
    gain = (score[np.arange(len(at)), at] - sums * sums / whole) / whole
    gain[gain <= 1e-14 * sums * sums / (whole * whole)] = -1.0  # rounding is no gain
    return at // left.shape[2], at % left.shape[2], gain


class Level:
    """Rows of the open nodes of a level, in the order of the nodes, with weights, weighted labels and (not of classes) weighted squares."""

    def __init__(self, sizes: np.ndarray, row: np.ndarray, *sums: np.ndarray):
        self.sizes, self.row, self.sums = sizes, row, sums

    @classmethod
    def of(cls, shape: Shape, y: np.ndarray, w: np.ndarray) -> Level:
        w = w.astype(np.float64)
        return cls(np.array([len(y)]), np.arange(len(y)), w, w * y, *([] if shape.classes else [w * y * y]))

    def stats(self) -> list[np.ndarray]:
        """Count, total and squares of every node."""
        node = np.repeat(np.arange(len(self.sizes)), self.sizes)
        found = [np.bincount(node, v, len(self.sizes)) for v in self.sums]
        return [*found, found[-1]][:3]  # a class is its own square

    def part(self, first: int, last: int, starts: np.ndarray) -> Level:
        rows = slice(starts[first], starts[last])
        return Level(self.sizes[first:last], self.row[rows], *(v[rows] for v in self.sums))

    def only(self, nodes: np.ndarray) -> Level:
        if nodes.all():
            return self
        keep = np.flatnonzero(np.repeat(nodes, self.sizes))
        return Level(self.sizes[nodes], *(a.take(keep) for a in (self.row, *self.sums)))

    def split(self, goes_left: np.ndarray) -> Level:
        """Left children of all nodes, then right children of all nodes."""
        ends = self.sizes.cumsum()
        left = np.add.reduceat(goes_left, ends - self.sizes, dtype=np.int64)
        order = np.concatenate([np.flatnonzero(goes_left), np.flatnonzero(~goes_left)])
        return Level(np.concatenate([left, self.sizes - left]), *(a.take(order) for a in (self.row, *self.sums)))

    def histograms(self, bins: np.ndarray, shape: Shape, tried: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """Weights and weighted labels by node, feature and bin; ``tried`` names the features of each node, or else all count."""
        k, m, b = len(self.sizes), shape.tried, shape.bins
        b *= 1 + shape.classes
        found = [np.zeros((m, k * b)) for _ in range(2 - shape.classes)]
        width, flat = bins.shape[1], bins.reshape(-1)
        node = np.repeat(np.arange(k), self.sizes)
        for at in range(0, len(self.row), BLOCK_ROWS):
            to = at + BLOCK_ROWS
            row, of, sums = self.row[at:to], node[at:to], [v[at:to] for v in self.sums]
            first, last = of[0], of[-1] + 1
            base, cells = (of - first) * b, slice(first * b, last * b)
            for j in range(m):
                if k == 1:
                    column = bins[j if tried is None else tried[0, j]].take(row)
                else:
                    column = bins[j].take(row) if tried is None else flat.take(tried[of, j] * width + row)
                code = base + column
                for sum_, weights in zip(found, sums):
                    sum_[j, cells] += np.bincount(code, weights, (last - first) * b)
        counts, totals = (f.reshape(m, k, b).transpose(1, 0, 2) for f in (found[0], found[-1]))
        return (counts[:, :, ::2] + counts[:, :, 1::2], counts[:, :, 1::2]) if shape.classes else (counts, totals)


def _highest(shape: Shape, at: np.ndarray) -> np.ndarray:
    """The highest kept value of bin ``at``."""
    return 2 * at + 1 if shape.classes else at


def _draw(rng: np.random.Generator, nodes: int, shape: Shape) -> np.ndarray | None:
    """Features tried at each node; None if all are."""
    if shape.tried == shape.features:
        return None
    return rng.random((nodes, shape.features)).argpartition(shape.tried - 1, axis=1)[:, : shape.tried]


def grow_local(shape: Shape, block: Block, level: int, nodes: Nodes, rng: np.random.Generator) -> None:
    """The whole subtree over rows in memory, a level at a time."""
    bins, y, w = block
    rows = Level.of(shape, y, w)
    kept = None  # histograms of the parents, when all features are tried
    while True:
        count, total, squares = rows.stats()
        made = nodes.add(level, count, total, squares)
        if level == shape.depth:
            return
        open_ = impurity(shape, count, total, squares) > 0
        if not open_.any():
            return
        if kept is not None:  # the smaller child is counted, the other is what is left of the parent
            pairs = len(rows.sizes) // 2
            left_is_small = rows.sizes[:pairs] <= rows.sizes[pairs:]
            small = np.concatenate([left_is_small, ~left_is_small]) & np.tile(open_[:pairs] | open_[pairs:], 2)
            kept = _both(rows.only(small).histograms(bins, shape, None), kept, small, left_is_small, open_)
        rows = rows.only(open_)
        ids, k = np.flatnonzero(open_), int(open_.sum())
        tried = _draw(rng, k, shape)
        feature, at, gain = np.empty(k, np.int64), np.empty(k, np.int64), np.empty(k)
        step = max(1, CELLS // (shape.tried * shape.bins))
        starts = np.concatenate([[0], rows.sizes.cumsum()])
        hold = tried is None and level + 1 < shape.depth and k * shape.tried * shape.bins * 16 <= KEPT_BYTES
        held = []
        for i in range(0, k, step):
            j = min(i + step, k)
            if kept is None:
                counts, totals = rows.part(i, j, starts).histograms(bins, shape, None if tried is None else tried[i:j])
            else:
                counts, totals = kept[0][i:j], kept[1][i:j]
            place, at[i:j], gain[i:j] = best_splits(counts, totals)
            feature[i:j] = place if tried is None else tried[np.arange(i, j), place]
            if hold:
                held.append((counts, totals))
        split = gain > 0
        kept = None
        if not split.any():
            return
        if hold:
            kept = tuple(np.concatenate(h)[split] for h in zip(*held))
        del held
        rows, ids, feature, at = rows.only(split), ids[split], feature[split], at[split]
        made["feature"][ids], made["bin"][ids] = feature, at
        made["gain"][ids] = gain[split] * (2 if shape.classes else 1)
        made["left"][ids] = nodes.made + np.arange(len(ids))
        made["right"][ids] = nodes.made + len(ids) + np.arange(len(ids))
        node = np.repeat(np.arange(len(ids)), rows.sizes)
        goes_left = bins.reshape(-1).take(feature[node] * bins.shape[1] + rows.row) <= _highest(shape, at)[node]
        rows = rows.split(goes_left)
        level += 1


def _both(small: tuple, parents: tuple, is_small: np.ndarray, left_is_small: np.ndarray, open_: np.ndarray) -> tuple:
    """Histograms of the open children, left ones first, from those of the smaller children and of the parents."""
    pairs = len(left_is_small)
    place = np.cumsum(is_small) - 1  # of a small child among the counted ones
    out = []
    child = np.flatnonzero(open_)
    pair = child % pairs
    counted = place[np.where(left_is_small[pair], pair, pair + pairs)]
    whole = ~is_small[child]
    for mine, all_ in zip(small, parents):
        found = mine[counted]
        found[whole] = all_[pair[whole]] - found[whole]
        out.append(found)
    return tuple(out)


def _taken(wanted: np.ndarray, bins: np.ndarray, y: np.ndarray, w: np.ndarray) -> Block:
    at = np.flatnonzero(wanted)
    return np.stack([column.take(at) for column in bins]), y.take(at), w.take(at)


def grow(shape: Shape, rows: Spool, nodes: Nodes, rng: np.random.Generator, level: int = 0) -> None:
    """A subtree over rows in a file, which is closed."""
    if rows.rows <= LOCAL_ROWS:
        block = tuple(np.concatenate(p, axis=-1) for p in zip(*rows))
        rows.close()
        return grow_local(shape, block, level, nodes, rng)
    tried = _draw(rng, 1, shape)
    stats, counts, totals = np.zeros((3, 1)), 0.0, 0.0
    for bins, y, w in rows:
        part = Level.of(shape, y, w)
        stats += part.stats()
        if level < shape.depth:
            c, t = part.histograms(bins, shape, tried)
            counts, totals = counts + c, totals + t
    made = nodes.add(level, *stats)
    if level == shape.depth or impurity(shape, *stats)[0] <= 0:
        return rows.close()
    place, at, gain = (found[0] for found in best_splits(counts, totals))
    if gain <= 0:
        return rows.close()
    feature = place if tried is None else tried[0, place]
    made["feature"][0], made["bin"][0], made["gain"][0] = feature, at, gain * (2 if shape.classes else 1)
    halves = Spool(shape.features), Spool(shape.features)
    for bins, y, w in rows:
        goes_left = bins[feature] <= _highest(shape, at)
        for half, goes in zip(halves, (goes_left, ~goes_left)):
            half.add(*_taken(goes, bins, y, w))
    rows.close()
    for half, side in zip(halves, ("left", "right")):
        made[side][0] = nodes.made
        grow(shape, half, nodes, rng, level + 1)


#: Chances of fewer than 1, 2, ... draws, in steps of 2 ** -32.
_DRAWS = np.array([sum(math.exp(-1) / math.factorial(i) for i in range(k)) * 2**32 for k in range(1, 14)]).round().astype(np.uint64)
_DRAWS = _DRAWS[_DRAWS < 2**32].astype(np.uint32)


def draws(rng: np.random.Generator, rows: int) -> np.ndarray:
    """How often each row is drawn: Poisson numbers of mean 1."""
    lots, out = rng.integers(0, 2**32, rows, np.uint32), np.zeros(rows, np.uint8)
    for chance in _DRAWS:
        out += lots >= chance
    return out


def tree(shape: Shape, blocks: Iterable[Block], seed: int, number: int) -> dict[str, np.ndarray]:
    """Nodes of one tree over rows drawn with replacement, as a Poisson weight for every row."""
    rows = Spool(shape.features)
    for k, (bins, y, _) in enumerate(blocks):
        w = draws(np.random.default_rng([seed, number, 0, k]), len(y))
        bins, y, w = _taken(w > 0, bins, y, w)
        rows.add(2 * bins + y.astype(np.uint8) if shape.classes else bins, y, w)
    nodes = Nodes()
    if rows.rows:
        grow(shape, rows, nodes, np.random.default_rng([seed, number, 1]))
    else:  # nothing drawn from a handful of rows
        rows.close()
        nodes.add(0, *np.zeros((3, 1)))
    return pruned(shape, nodes.table())


def predictions(shape: Shape, nodes: dict[str, np.ndarray]) -> np.ndarray:
    mean = nodes["total"] / np.maximum(nodes["count"], 1)
    return (mean > 0.5).astype(np.float64) if shape.classes else mean


def pruned(shape: Shape, nodes: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Sibling leaves that predict the same become one leaf, as Spark does it; numbers stay in order."""
    value, left, right = predictions(shape, nodes), nodes["left"].copy(), nodes["right"].copy()
    for level in range(nodes["level"].max() - 1, -1, -1):
        at = np.flatnonzero((nodes["level"] == level) & (left >= 0))
        a, b = left[at], right[at]
        same = at[(left[a] < 0) & (left[b] < 0) & (value[a] == value[b])]
        left[same] = right[same] = -1
    reached = np.zeros(len(value), bool)
    reached[0] = True
    for level in range(nodes["level"].max() + 1):
        at = np.flatnonzero((nodes["level"] == level) & reached & (left >= 0))
        reached[left[at]] = reached[right[at]] = True
    number = np.cumsum(reached) - 1
    out = {c: v[reached] for c, v in nodes.items()}
    inner = left[reached] >= 0
    out["left"] = np.where(inner, number[left[reached]], -1)
    out["right"] = np.where(inner, number[right[reached]], -1)
    out["feature"], out["bin"], out["gain"] = (np.where(inner, out[c], -1) for c in ("feature", "bin", "gain"))
    out["id"], out["prediction"] = np.arange(len(inner)), value[reached]
    out["impurity"] = np.where(out["count"] > 0, impurity(shape, np.maximum(out["count"], 1), out["total"], out["squares"]), 0.0)
    return out
