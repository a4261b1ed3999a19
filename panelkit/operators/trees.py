"""Trees on binned features: histograms, splits, growth and walks over arrays.

A value is binned by the cut points of its feature; bin 0 holds missing values, which a
split sends to the side where they lose less. Sums of gradients are sums of integers, so
they are the same in any order and any division of the rows: a tree does not depend on how
its rows are partitioned.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np

BINS = 66  # missing, 64 cut points and what is above the last
UNIT = 2.0**24  # integer steps of a gradient, per scale of the target
PIECE = 14_336  # rows counted at once: their sums fit a double together with their number
CODES = 255  # of features counted as one column
JOINT = 8192  # codes of two columns counted as one: their sums fit a cache
JOINT_PIECE = 12_288  # rows counted at once then
JOINT_ROWS = 6_144  # fewer rows of a node are counted together with those of other nodes
STEEP = 2.0**26  # gradients above are not counted that way, nor are those that are no numbers
NODES = 32  # whose splits are sought at once
HEAD = 8192  # rows that tell whether features may share a column
PLACES = 9  # of leaf values that are picked, not summed
STEPS = 2.0**45  # of what a tree adds to an average, per scale of the target


@dataclass(frozen=True)
class TreeSettings:
    """One ensemble: squared error or, with ``quantile``, the pinball loss.

    ``averaged`` makes a forest: trees do not see each other and each draws ``share`` of
    the rows with replacement. ``impute`` sends missing values where the median goes.
    """

    rounds: int = 400
    depth: int = 6
    step: float = 0.05
    least: float = 1.0
    l2: float = 1.0
    leaves: int | None = None
    quantile: float | None = None
    averaged: bool = False
    share: float = 1.0
    impute: bool = False

    @property
    def weight(self) -> float:
        return 1.0 / self.rounds if self.averaged else self.step


@dataclass
class Tree:
    """Node arrays that grow by level; leaves have no feature."""

    feature: list[int] = field(default_factory=lambda: [-1])
    bin: list[int] = field(default_factory=lambda: [0])
    missing_left: list[bool] = field(default_factory=lambda: [True])
    left: list[int] = field(default_factory=lambda: [-1])
    right: list[int] = field(default_factory=lambda: [-1])
    total: list[float] = field(default_factory=lambda: [0.0])
    cover: list[float] = field(default_factory=lambda: [0.0])
    value: np.ndarray | None = None

    def grow(self, nodes: Sequence[int], splits: Mapping[str, np.ndarray], leaves: int | None) -> list[int]:
        """Split nodes where it helps, best first if the leaves are limited; the new nodes."""
        useful = [i for i in range(len(nodes)) if splits["gain"][i] > 0]
        if leaves is not None:
            now = sum(1 for f in self.feature if f < 0)
            useful = sorted(sorted(useful, key=lambda i: -splits["gain"][i])[: max(0, leaves - now)])
        made = []
        for i in useful:
            node = nodes[i]
            self.feature[node], self.bin[node] = int(splits["feature"][i]), int(splits["bin"][i])
            self.missing_left[node] = bool(splits["missing_left"][i])
            self.left[node], self.right[node] = len(self.feature), len(self.feature) + 1
            g, n = splits["left_g"][i], splits["left_n"][i]
            for total, cover in ((g, n), (self.total[node] - g, self.cover[node] - n)):
                made.append(len(self.feature))
                for name, first in (("feature", -1), ("bin", 0), ("missing_left", True), ("left", -1), ("right", -1)):
                    getattr(self, name).append(first)
                self.total.append(float(total))
                self.cover.append(float(cover))
        return made

    def means(self, l2: float, scale: float) -> np.ndarray:
        """Leaf values of the squared error."""
        return np.array(self.total) / np.maximum(np.array(self.cover) + l2, 1e-12) * (scale / UNIT)

    def added(self, s: TreeSettings, scale: float) -> np.ndarray:
        """What the leaves add to a prediction; sums of an average are exact in any order."""
        made = s.weight * self.value
        return np.rint(made * (STEPS / scale)) * (scale / STEPS) if s.averaged else made


def bin_values(values: np.ndarray, cuts: Sequence[np.ndarray], medians: Sequence[float] | None = None) -> np.ndarray:
    """Bins of a (rows, features) matrix; with ``medians``, missing values take theirs."""
    out = np.zeros(values.shape, dtype=np.uint8)
    for j, own in enumerate(cuts):
        column = values[:, j]
        missing = np.isnan(column)
        if medians is not None and not np.isnan(medians[j]):
            column, missing = np.where(missing, medians[j], column), np.zeros(len(column), dtype=bool)
        out[:, j] = np.where(missing, 0, 1 + np.searchsorted(own, column, side="left"))
    return out


def histograms(
    bins: np.ndarray, slot: np.ndarray, slots: int, g: np.ndarray, w: np.ndarray | None, rows: np.ndarray | None = None,
    bundles: "Bundles | None" = None,
) -> np.ndarray:
    """(2, slots, features, bins): gradient sums and rows; ``w`` None counts each row once.

    With ``rows``, ``slot`` belongs to these rows of the other arrays; rows in slot -1 do not
    count. They are counted in pieces that fit a cache, one column at a time. Both sums are made as
    one where they fit the 53 bits of a double: rows above, gradients below.
    """
    features = bins.shape[1]
    codes, widths = (bins, (BINS,) * features) if bundles is None else (bundles.codes, bundles.widths)
    sizes = [slots * n for n in widths]
    ends = np.cumsum(sizes)
    out, both = np.zeros((2, ends[-1])), np.empty(ends[-1])
    packed = slots * BINS <= PIECE // 2
    piece = PIECE if packed else 8 * PIECE
    counted = np.flatnonzero(slot >= 0)
    for at in range(0, len(counted), piece):
        some = counted[at : at + piece]
        own = some if rows is None else rows.take(some)
        here, grad, weight = slot.take(some).astype(np.int64), g.take(own), None if w is None else w.take(own)
        base = {n: here * n for n in set(widths)}
        columns = codes.T.take(own, axis=1) if codes.flags.f_contiguous else np.ascontiguousarray(codes.take(own, axis=0).T)
        unit = 4.0 * 2.0 ** np.floor(np.log2(max(np.abs(grad).sum(), 1.0)))
        if packed and ((len(own) if weight is None else weight.sum()) + 1) * unit <= 2.0**53:
            value = grad + (unit if weight is None else unit * weight)
            for column, n, size, end in zip(columns, widths, sizes, ends):
                both[end - size : end] = np.bincount(base[n] + column, value, size)
            number = np.rint(both / unit)
            out[0] += both - number * unit
            out[1] += number
            continue
        for column, n, size, end in zip(columns, widths, sizes, ends):
            key = base[n] + column
            out[0, end - size : end] += np.bincount(key, grad, size)
            out[1, end - size : end] += np.bincount(key, weight, size)
    parts = [out[:, end - size : end].reshape(2, slots, n) for n, size, end in zip(widths, sizes, ends)]
    return np.stack(parts, axis=2) if bundles is None else bundles.by_feature(parts)


def joint_histogram(rows: np.ndarray, g: np.ndarray, w: np.ndarray | None, bundles: "Bundles", steep: float) -> np.ndarray:
    """``histograms`` of the ``rows`` of one node: columns are counted two at a time and parted at the end.

    No gradient is above ``steep``. A cell holds gradients below and rows above. As long as it has at most ``most`` rows, it fits the 53
    bits of a double and its gradients do not reach ``unit / 2``; fuller cells are emptied in time.
    """
    most = int(0.98 * 2.0**26 / np.sqrt(steep))
    unit = np.ceil(2.02 * most * steep)
    sizes = [int(np.prod(bundles.shape_of(own))) for own in bundles.joined]
    sums, held, filled = [np.zeros((2, n)) for n in sizes], [np.zeros(n) for n in sizes], [0] * len(sizes)

    def empty(at: int) -> None:
        number = np.rint(held[at] / unit)
        sums[at][0] += held[at] - number * unit
        sums[at][1] += number
        held[at][:], filled[at] = 0.0, 0

    at, size = 0, JOINT_PIECE
    while at < len(rows):
        own = rows[at : at + size]
        weight = None if w is None else w.take(own)
        added = len(own) if weight is None else int(weight.sum())
        if added > most and len(own) > 1:
            size = max(1, size // 2)
            continue
        at += len(own)
        value = g.take(own, mode="clip") + (unit if weight is None else unit * weight)
        whole = own[-1] - own[0] == len(own) - 1  # the rows of a node are in order
        codes = bundles.joint[own[0] : own[-1] + 1] if whole else bundles.joint.take(own, axis=0, mode="clip")
        for place, column in enumerate(codes.T.astype(np.intp, order="C")):
            if filled[place] + added > most:
                # the fullest cell tells how many rows it may still take
                filled[place] = int(np.ceil(held[place].max() / (unit - steep)))
                if filled[place] + added > most:
                    empty(place)
            held[place] += np.bincount(column, value, sizes[place])
            filled[place] += added
    parts = [None] * len(bundles.widths)
    for place, own in enumerate(bundles.joined):
        empty(place)
        cells = sums[place].reshape(2, 1, *bundles.shape_of(own))
        for axis, column in enumerate(own):
            parts[column] = cells.sum(axis=3 - axis) if len(own) == 2 else cells
    return bundles.by_feature(parts)


@dataclass(frozen=True)
class Bundles:
    """Columns of codes for features; features that take few values together share one.

    ``members`` lists the features of each column and which of their bins a code means.
    """

    codes: np.ndarray
    widths: tuple[int, ...]
    members: tuple[tuple[tuple[int, np.ndarray | None], ...], ...]
    joined: tuple[tuple[int, ...], ...] = ()
    joint: np.ndarray | None = None

    def shape_of(self, columns: Sequence[int]) -> tuple[int, ...]:
        return tuple(self.widths[c] for c in columns)

    def by_feature(self, parts: Sequence[np.ndarray]) -> np.ndarray:
        """(2, slots, features, bins) from the sums of every column."""
        made = np.empty((*parts[0].shape[:2], sum(map(len, self.members)), BINS))
        for part, members in zip(parts, self.members):
            for feature, table in members:
                made[:, :, feature] = part if table is None else part @ table
        return made

    def pairs(self) -> "Bundles":
        """With the codes of two columns at a time as one."""
        joined, at = [], 0
        while at < len(self.widths):
            two = at + 1 < len(self.widths) and self.widths[at] * self.widths[at + 1] <= JOINT
            joined.append((at, at + 1) if two else (at,))
            at += len(joined[-1])
        joint = np.empty((len(self.codes), len(joined)), dtype=np.uint16)
        for place, own in enumerate(joined):
            code = self.codes[:, own[0]].astype(np.uint16)
            if len(own) == 2:
                code = code * np.uint16(self.widths[own[1]]) + self.codes[:, own[1]]
            joint[:, place] = code
        return Bundles(self.codes, self.widths, self.members, tuple(joined), joint)

    @staticmethod
    def of(bins: np.ndarray) -> "Bundles":
        columns, head = bins.T, bins[:HEAD].T.astype(np.int64)
        made: list[tuple[list[int], np.ndarray, np.ndarray]] = []  # features, codes, number of rows a code
        rest = []
        for j in sorted(range(len(columns)), key=lambda j: (len(np.unique(head[j])), j)):
            for place, (features, code, _) in enumerate(made):
                # more codes in some rows than allowed are too many in all rows
                if len(np.unique(code[:HEAD].astype(np.int64) * BINS + head[j])) > CODES:
                    continue
                joint = code.astype(np.int64) * BINS + columns[j]
                found = np.bincount(joint) > 0
                if found.sum() <= CODES:
                    made[place] = [*features, j], (np.cumsum(found) - 1).astype(np.uint8).take(joint), found
                    break
            else:
                made.append(([j], columns[j], None))
        codes, widths, members = [], [], []
        for features, code, _ in made:
            if len(features) == 1:
                rest.append(features[0])
                continue
            first = np.zeros(int(code.max()) + 1, dtype=np.int64)
            first[code] = np.arange(len(code))
            codes.append(code)
            widths.append(len(first))
            members.append(tuple((j, np.eye(BINS)[columns[j].take(first)]) for j in features))
        for j in sorted(rest):
            codes.append(columns[j])
            widths.append(BINS)
            members.append(((j, None),))
        return Bundles(np.stack(codes).T, tuple(widths), tuple(members))


def best_splits(hist: np.ndarray, l2: float, least: float) -> dict[str, np.ndarray]:
    """Per node: gain (0 or less: none), feature, bin, side of missing, sums of the left side.

    Some nodes at a time, so that the working arrays do not follow the width of the tree.
    """
    made = [_best_splits(hist[:, at : at + NODES], l2, least) for at in range(0, hist.shape[1], NODES)]
    return {name: np.concatenate([m[name] for m in made]) for name in made[0]}


def _best_splits(hist: np.ndarray, l2: float, least: float) -> dict[str, np.ndarray]:
    g, n = hist
    total_g, total_n = g[:, 0].sum(axis=1)[:, None, None], n[:, 0].sum(axis=1)[:, None, None]
    left = hist[:, :, :, 1:-1].cumsum(axis=3)
    with_missing = left + hist[:, :, :, :1]
    lg, ln = np.stack([with_missing, left], axis=2)  # (nodes, sides, features, cuts)
    rg, rn = total_g[:, None] - lg, total_n[:, None] - ln
    fits = (ln >= max(least, 1e-9)) & (rn >= max(least, 1e-9))
    worth = lg * lg / np.maximum(ln + l2, 1e-12) + rg * rg / np.maximum(rn + l2, 1e-12)
    parent = (total_g * total_g / np.maximum(total_n + l2, 1e-12))[:, 0, 0]
    flat = np.where(fits, worth, -1.0).reshape(len(parent), -1)
    best = flat.argmax(axis=1)
    at = np.arange(len(parent))
    side, feature, cut = np.unravel_index(best, lg.shape[1:])
    # a gain within rounding of the parent's worth is none
    gain = np.where(flat[at, best] > parent * (1 + 1e-9) + 1e-9, flat[at, best] - parent, 0.0)
    return {
        "gain": gain, "feature": feature, "bin": cut + 1, "missing_left": side == 0,
        "left_g": lg[at, side, feature, cut], "left_n": ln[at, side, feature, cut],
    }


def step_down(bins: np.ndarray, node: np.ndarray, tree: Tree) -> np.ndarray:
    """Nodes of the rows one level further down; rows in leaves stay."""
    feature, own = np.array(tree.feature)[:, None], np.arange(len(tree.feature))[:, None]
    number = np.arange(BINS)
    left = np.where(number == 0, np.array(tree.missing_left)[:, None], number <= np.array(tree.bin)[:, None])
    child = np.where(feature < 0, own, np.where(left, np.array(tree.left)[:, None], np.array(tree.right)[:, None])).ravel()
    n, features = bins.shape
    by_column = bins.flags.f_contiguous
    flat = bins.T.ravel() if by_column else np.ascontiguousarray(bins).ravel()
    across, along = (n, 1) if by_column else (1, features)
    asked = np.maximum(feature[:, 0], 0) * across
    out = np.empty(len(node), dtype=np.int32)
    for at in range(0, len(node), PIECE):
        here = node[at : at + PIECE].astype(np.int64)
        place = asked.take(here)
        place += np.arange(at * along, (at + len(here)) * along, along)
        out[at : at + PIECE] = child.take(here * BINS + flat.take(place))
    return out


def leaves_of(bins: np.ndarray, tree: Tree, depth: int) -> np.ndarray:
    node = np.zeros(len(bins), dtype=np.int32)
    for _ in range(depth):
        node = step_down(bins, node, tree)
    return node


def gradients(y: np.ndarray, prediction: np.ndarray, s: TreeSettings, scale: float, out: np.ndarray | None = None) -> np.ndarray:
    """Integer gradients, as floats, put into ``out`` if there is one."""
    out = np.empty(len(y)) if out is None else out
    for at in range(0, len(y), PIECE):
        own, made = y[at : at + PIECE], out[at : at + PIECE]
        if s.quantile is not None:
            made[:] = np.where(own > prediction[at : at + PIECE], np.round(s.quantile * UNIT), np.round((s.quantile - 1.0) * UNIT))
            continue
        np.multiply(own if s.averaged else own - prediction[at : at + PIECE], UNIT / scale, out=made)
        np.round(made, out=made)
    return out


def moved(prediction: np.ndarray, added: np.ndarray, leaf: np.ndarray) -> np.ndarray:
    """Predictions after a tree whose leaves add this."""
    out = np.empty(len(prediction))
    for at in range(0, len(out), PIECE):
        np.add(prediction[at : at + PIECE], added.take(leaf[at : at + PIECE]), out=out[at : at + PIECE])
    return out


def drawn(hashes: np.ndarray, tree: int, s: TreeSettings, seed: int) -> np.ndarray | None:
    """How often each row is drawn for a tree: Poisson numbers from a hash of the row."""
    if not s.averaged:
        return None
    made = np.empty(len(hashes), dtype=np.uint8)
    for at in range(0, len(hashes), PIECE):
        x = hashes[at : at + PIECE].astype(np.uint64) ^ np.uint64((seed * 1_000_003 + tree + 1) * 0x9E3779B97F4A7C15 % 2**64)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
        uniform = (x >> np.uint64(11)).astype(float) / 2.0**53
        chance, reached, out = np.exp(-s.share), np.exp(-s.share), np.zeros(len(x), dtype=np.uint8)
        for k in range(1, 40):
            more = uniform >= reached
            if not more.any():
                break
            out += more
            chance *= s.share / k
            reached += chance
        made[at : at + PIECE] = out
    return made


def percentile(values: np.ndarray, q: float) -> float:
    """Linear interpolation between order statistics, to ``PLACES`` places."""
    place = q * (len(values) - 1)
    low = int(np.floor(place))
    high = int(np.ceil(place))
    share = place - low
    ordered = np.partition(values, (low, high))
    return round(float(ordered[low] * (1 - share) + ordered[high] * share), PLACES)


def picked_values(tree: Tree, held: Mapping[int, np.ndarray], residual: np.ndarray, q: float) -> np.ndarray:
    """Leaf values of the pinball loss: percentiles of the residuals of the rows in each leaf."""
    out = np.zeros(len(tree.feature))
    for node, rows in held.items():
        if len(rows):
            out[node] = percentile(residual.take(rows), q)
    return out


def base_of(y: np.ndarray, s: TreeSettings, scale: float) -> float:
    if s.averaged or not len(y):
        return 0.0
    if s.quantile is not None:
        return percentile(y, s.quantile)
    return float(np.round(y * (UNIT / scale)).sum() / len(y) * (scale / UNIT))


def parted(column: np.ndarray, rows: np.ndarray, cut: int, missing_left: bool) -> tuple[np.ndarray, np.ndarray]:
    """Rows left and right of a split, in their order, made in pieces that fit a cache."""
    sides = [], []
    for at in range(0, len(rows), PIECE):
        some = rows[at : at + PIECE]
        value = column.take(some, mode="clip")  # all are in place: spares the check
        left = value <= cut if missing_left else (value - 1).astype(np.uint8) < cut
        sides[0].append(some.take(np.flatnonzero(left)))
        sides[1].append(some.take(np.flatnonzero(~left)))
    none = rows[:0]
    return np.concatenate([none, *sides[0]]), np.concatenate([none, *sides[1]])


def node_histograms(
    nodes: Sequence[int], held: Mapping[int, np.ndarray], bins: np.ndarray, g: np.ndarray, w: np.ndarray | None,
    bundles: Bundles | None, steep: float,
) -> dict[int, np.ndarray]:
    """Histograms of nodes with their rows: large ones one by one, the others together."""
    made, small = {}, []
    joint = bundles is not None and bundles.joint is not None and steep <= STEEP
    for node in nodes:
        if joint and len(held[node]) >= JOINT_ROWS:
            made[node] = joint_histogram(held[node], g, w, bundles, steep)[:, 0]
        else:
            small.append(node)
    if small:
        rows = np.concatenate([held[i] for i in small])
        slot = np.repeat(np.arange(len(small), dtype=np.int32), [len(held[i]) for i in small])
        hist = histograms(bins, slot, len(small), g, w, rows, bundles)
        made |= {node: hist[:, k] for k, node in enumerate(small)}
    return made


def grow_tree(
    bins: np.ndarray, g: np.ndarray, w: np.ndarray | None, rows: np.ndarray, s: TreeSettings, bundles: Bundles | None = None,
    held: dict[int, np.ndarray] | None = None, others: np.ndarray | None = None,
) -> tuple[Tree, np.ndarray]:
    """A tree from the training ``rows`` and the leaf of these and of the ``others`` (default: all rows).

    Every node keeps its rows. Of two siblings only the smaller is counted; the other is the rest of their
    parent. The training rows of every leaf are put into ``held``.
    """
    tree = Tree()
    tree.total = [float(g[rows].sum())]
    tree.cover = [float(len(rows) if w is None else w[rows].sum())]
    held = {} if held is None else held
    if others is None:
        other = np.ones(len(bins), dtype=bool)
        other[rows] = False
        others = np.flatnonzero(other)
    held[0], asked = rows, {0: others}
    steep = max(float(g.max(initial=0.0)), -float(g.min(initial=0.0)), 1.0)
    nodes, kept = [0], {}
    for _ in range(s.depth):
        counted = nodes if nodes == [0] else [min(a, b, key=lambda i: (tree.cover[i], i)) for a, b in zip(nodes[::2], nodes[1::2])]
        level = node_histograms(counted, held, bins, g, w, bundles, steep)
        if nodes != [0]:
            for a, b in zip(nodes[::2], nodes[1::2]):
                small, large = (a, b) if a in level else (b, a)
                level[large] = kept[a] - level[small]
        hist = np.stack([level[i] for i in nodes], axis=1)
        grown = tree.grow(nodes, best_splits(hist, s.l2, s.least), s.leaves)
        if not grown:
            break
        parents = [i for i in nodes if tree.feature[i] >= 0]
        kept = {tree.left[i]: level[i] for i in parents}
        for i in parents:
            split = bins[:, tree.feature[i]], tree.bin[i], tree.missing_left[i]
            for own in (held, asked):
                own[tree.left[i]], own[tree.right[i]] = parted(split[0], own.pop(i), *split[1:])
        nodes = grown
    leaf = np.zeros(len(bins), dtype=np.int32)
    for own in (held, asked):
        for node, inside in own.items():
            leaf[inside] = node
    return tree, leaf


def boost(
    bins: np.ndarray, y: np.ndarray, train: np.ndarray, hashes: np.ndarray, s: TreeSettings, seed: int, scale: float,
    numbers: range | None = None, whole: bool = True,
):
    """Base, and then (tree, prediction of all rows so far) of every round.

    ``numbers`` are the trees of an average to be made here, whose others are made elsewhere. Unless ``whole``, only
    the predictions of rows held out are of use: those of an average are not made for the others.
    """
    rows, out = np.flatnonzero(train), np.flatnonzero(~train)
    if not s.averaged:
        del hashes  # nothing is drawn
    bins = np.asfortranarray(bins)
    bundles = Bundles.of(bins).pairs() if len(bins) >= JOINT_ROWS else Bundles.of(bins) if len(bins) else None
    base = base_of(y[rows], s, scale)
    prediction, g = np.full(len(y), base), np.empty(len(y))
    yield base, prediction
    for t in range(s.rounds) if numbers is None else numbers:
        w = drawn(hashes, t, s, seed) if s.averaged else None
        g = gradients(y, prediction, s, scale, g)
        own, others = rows, out
        if w is not None:
            g *= w
            drew = w[rows] > 0
            own = rows[drew]
            others = np.sort(np.concatenate([out, rows[~drew]])) if whole else out
        held = {}
        tree, leaf = grow_tree(bins, g, w, own, s, bundles, held, others)
        if s.quantile is None:
            tree.value = tree.means(s.l2, scale)
        else:
            tree.value = picked_values(tree, held, y - prediction, s.quantile)
        prediction = moved(prediction, tree.added(s, scale), leaf)
        yield tree, prediction
