"""A small causal self-attention model over subword ids, in numpy.

The hidden vector of a place is the embedding of the id before it, plus ``HEADS`` heads of causal
self-attention over the places of its window; a learned bias per distance lets a head look at a
certain place back.  The ids are ranked by frequency.  The most frequent have a softmax of their
own (the head), in which the ranks after them are represented by clusters; a rank of a cluster
follows by a softmax within it.  So a place costs a product with the head, and rarely one more.

Texts are scored in windows of ``WIDTH`` places; each starts ``WIDTH - CONTEXT`` after the one before
and scores only the places the former ones did not, so every token is scored once, with at least
``CONTEXT`` places of context (fewer at the start of a text).  Windows of many texts are computed
together under a causal mask.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

SIZE = 16
HEADS = 1
WIDTH = 32
CONTEXT = 6
BATCH = 128
RATE = 0.2
HEAD = 112
CLUSTERS = 16
#: Places whose softmax is computed together.
HELD = 1 << 17
_CAUSAL = np.tril(np.ones((WIDTH, WIDTH), np.float32))
_BACK = np.maximum(np.arange(WIDTH)[:, None] - np.arange(WIDTH), 0)
#: Ranks at most of small clusters that are trained together.
TOGETHER = 128
#: Numbers that stay in the processor's cache.
CACHED = 1 << 16
_LOG2E = np.float32(np.log2(np.e))
# Single numbers as arrays, which cost less in each call: one that rounds small numbers when it is added and taken
# away, the place of the exponent, and a polynomial for 2 to the power of -1/2 to 1/2, the highest power first.
_ROUND, _EXPONENT = np.array(1.5 * 2**23, np.float32), np.array(23, np.int32)
_NODES = np.cos(np.pi * np.arange(0.5, 2000) / 2000) / 2
_FITTED = np.linalg.lstsq(np.vander(_NODES, 6) / 2 ** _NODES[:, None], np.ones(2000), rcond=None)[0]
_POLYNOMIAL = [np.array(x, np.float32) for x in _FITTED]


def cluster_starts(ranks: int) -> np.ndarray:
    """Where the clusters of ranks start, each larger than the one before, with the end of all."""
    rest = max(0, ranks - HEAD)
    shares = 1.4 ** np.arange(CLUSTERS)
    ends = np.ceil(rest * np.cumsum(shares) / shares.sum()).astype(np.int64)
    return HEAD + np.append(0, ends)


@dataclass
class Model:
    """Weights by name, and the rank of every id, -1 for ids the model does not have.

    The last id is the edge of texts.
    """

    weights: dict[str, np.ndarray]
    ranks: np.ndarray

    @property
    def edge(self) -> int:
        return len(self.ranks) - 1

    def starts(self) -> np.ndarray:
        return cluster_starts(len(self.weights["bias"]))


def new_model(counts: np.ndarray, kept: np.ndarray | None = None, seed: int = 1) -> Model:
    """A model of the ids ``kept`` (all by default) that starts at their smoothed shares.

    ``counts`` has the edge id, which is always kept, last.
    """
    pick = np.random.default_rng(seed)
    kept = np.arange(len(counts)) if kept is None else np.union1d(kept, [len(counts) - 1])
    order = kept[np.argsort(-counts[kept], kind="stable")]
    ranks = np.full(len(counts), -1, np.int64)
    ranks[order] = np.arange(len(order))
    shares = counts[order] + 0.1
    starts = cluster_starts(len(order))
    clusters = np.array([shares[a:b].sum() for a, b in zip(starts, starts[1:])])
    even = SIZE**-0.5
    weights = {
        "ids": pick.normal(0, 0.3, (len(order), SIZE)),
        "query": pick.normal(0, even, (SIZE, SIZE)),
        "key": pick.normal(0, even, (SIZE, SIZE)),
        "value": pick.normal(0, even, (SIZE, SIZE)),
        "back": pick.normal(0, even, (SIZE, SIZE)),
        "distance": -0.7 * np.abs(np.arange(WIDTH)[None] - np.arange(HEADS)[:, None]),
        "output": pick.normal(0, 0.1, (len(order), SIZE)),
        "bias": np.log(shares / shares.sum()),
        "cluster": pick.normal(0, 0.1, (CLUSTERS, SIZE)),
        "cluster_bias": np.log(np.maximum(clusters, 1e-9) / shares.sum()),
    }
    return Model({n: w.astype(np.float32) for n, w in weights.items()}, ranks)


def _split(flat: np.ndarray, shape: tuple[int, int]) -> np.ndarray:
    return flat.reshape(*shape, HEADS, SIZE // HEADS).transpose(0, 2, 1, 3)


def _joined(parts: np.ndarray) -> np.ndarray:
    return parts.transpose(0, 2, 1, 3).reshape(-1, SIZE)


class _Room:
    """32-bit arrays by name that are used again, so that no batch asks the system for memory."""

    def __init__(self):
        self._held: dict[str, np.ndarray] = {}

    def __call__(self, name: str, *shape: int) -> np.ndarray:
        size = math.prod(shape)
        if name not in self._held or len(self._held[name]) < size:
            self._held[name] = np.empty(size, np.float32)
        return self._held[name][:size].reshape(shape)


def _powers(raw: np.ndarray, room: _Room) -> np.ndarray:
    """2 to the power of ``raw``, within ±126, in its place; in two thirds of the time of ``np.exp2``.

    A polynomial gives the part after the point within 3e-7, and the whole part is added to its exponent.
    """
    every = raw.reshape(-1)
    for low in range(0, len(every), CACHED):
        some = every[low : low + CACHED]
        whole, found = room("whole", len(some)), room("found", len(some))
        np.add(some, _ROUND, out=whole)
        np.subtract(whole, _ROUND, out=found)
        np.subtract(some, found, out=some)
        np.multiply(some, _POLYNOMIAL[0], out=found)
        for factor in _POLYNOMIAL[1:-1]:
            np.add(found, factor, out=found)
            np.multiply(found, some, out=found)
        np.add(found, _POLYNOMIAL[-1], out=found)
        exponent = whole.view(np.int32)
        np.left_shift(exponent, _EXPONENT, out=exponent)
        np.add(found.view(np.int32), exponent, out=some.view(np.int32))
    return raw


def _shares(raw: np.ndarray, distance: np.ndarray, room: _Room) -> np.ndarray:
    """Attention, before it is divided by its sums, from products of queries and keys for powers of two."""
    wide = raw.shape[3]
    raw += distance[:, _BACK[:wide, :wide]] * _LOG2E
    np.clip(raw, -30 * _LOG2E, 30 * _LOG2E, out=raw)
    share = _powers(raw, room)
    share *= _CAUSAL[:wide, :wide]
    return share


def _largest(rows: np.ndarray) -> float:
    return float(np.einsum("ij,ij->i", rows, rows).max(initial=0)) ** 0.5


def _head(model: Model) -> np.ndarray:
    """Vectors of the head; the last column is the bias."""
    w = model.weights
    vectors = np.concatenate([w["output"][:HEAD], w["cluster"]])
    return np.append(vectors, np.append(w["bias"][:HEAD], w["cluster_bias"])[:, None], 1)


def _log_softmax(rows: np.ndarray, table: np.ndarray, chosen: np.ndarray, room: _Room) -> np.ndarray:
    """log2 shares of the chosen vectors; the rows' last column is 1 and meets the table's bias."""
    table = np.ascontiguousarray(table.T) * _LOG2E
    found = np.empty(len(rows), np.float32)
    many = table.shape[1]
    at_once = max(64, (1 << 17) // max(1, many))  # so many rows stay in the processor's cache
    ones = np.ones(many, np.float32)
    reach = _largest(rows[:, :SIZE]) * _largest(table[:SIZE].T) + np.abs(table[SIZE]).max(initial=0)
    for low in range(0, len(rows), at_once):
        some = slice(low, low + at_once)
        raw = np.matmul(rows[some], table, out=room("raw", len(rows[some]), many))
        if not (reach <= 126 or np.abs(raw).max(initial=0) <= 126):
            raw -= raw.max(1, keepdims=True)
            own = raw[np.arange(len(raw)), chosen[some]]
            found[some] = own - np.log2(np.exp2(raw) @ ones)
            continue
        own = raw[np.arange(len(raw)), chosen[some]]
        found[some] = own - np.log2(_powers(raw, room) @ ones)
    return found


def log_chances(model: Model, hidden: np.ndarray, ranks: np.ndarray, room: _Room | None = None) -> np.ndarray:
    """log10 of the probability of each rank after its hidden vector."""
    w, starts, room = model.weights, model.starts(), room or _Room()
    rows = np.ones((len(ranks), SIZE + 1), np.float32)
    rows[:, :SIZE] = hidden
    cluster = np.searchsorted(starts, ranks, side="right") - 1
    found = _log_softmax(rows, _head(model), np.where(cluster < 0, ranks, HEAD + cluster), room)
    order = np.argsort(cluster.astype(np.int16), kind="stable")
    cuts = np.searchsorted(cluster[order], np.arange(CLUSTERS + 1))
    for c in np.flatnonzero(cuts[1:] > cuts[:-1]):
        own, low, high = order[cuts[c] : cuts[c + 1]], starts[c], starts[c + 1]
        table = np.append(w["output"][low:high], w["bias"][low:high, None], 1)
        found[own] += _log_softmax(rows[own], table, ranks[own] - low, room)
    return found * np.float32(np.log10(2))


def windows_of(
    model: Model, ids: np.ndarray, first: np.ndarray, stride: int = WIDTH - CONTEXT, mixed_up: bool = False
) -> Iterator[tuple]:
    """Ranks before, target ranks and scored places of all windows of texts given by ``first``.

    A text ends with the edge, and one stands before it; yields batches with each window's text.
    For training the windows of all texts are mixed up.
    """
    sizes = np.diff(first)
    edge = model.ranks[model.edge]
    placed = np.full(len(ids) + len(sizes), edge, np.int64)
    placed[np.arange(len(ids)) + np.repeat(np.arange(len(sizes)), sizes)] = model.ranks[ids]
    begin, length = first[:-1] + np.arange(len(sizes)), sizes + 1
    many = 1 + np.maximum(0, -(-(length - WIDTH) // stride))
    text = np.repeat(np.arange(len(sizes)), many)
    number = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    start = begin[text] + number * stride
    stop = np.minimum(start + WIDTH, begin[text] + length[text])
    fresh = np.where(number > 0, WIDTH - stride, 0)
    # Short windows together, so that few places are only filled up.
    order = np.argsort(stop - start, kind="stable")
    if mixed_up:
        order = np.random.default_rng(len(order)).permutation(len(order))
        order = order[np.argsort((stop - start)[order] == WIDTH, kind="stable")]
    for low in range(0, len(order), BATCH):
        some = order[low : low + BATCH]
        wide = int((stop[some] - start[some]).max())
        at = start[some][:, None] + np.arange(wide)
        real = at < stop[some][:, None]
        target = placed[np.minimum(at, len(placed) - 1)]
        before = np.full(target.shape, edge, np.int64)
        before[:, 1:] = target[:, :-1]
        inner = number[some] > 0
        before[inner, 0] = placed[start[some][inner] - 1]
        yield text[some], before, target, real & (np.arange(wide) >= fresh[some][:, None])


class _Scorer:
    """Hidden vectors for scoring: what does not depend on the place is computed once for each rank."""

    def __init__(self, model: Model):
        w, part = model.weights, SIZE // HEADS
        self._distance, self.room = w["distance"], _Room()
        query = w["query"] * np.float32(part**-0.5 * _LOG2E)
        # The value of each head as it comes out of ``back``, and a 1 for the sum of the shares.
        back = [
            np.append(w["value"][:, h : h + part] @ w["back"][h : h + part], np.zeros((SIZE, 1), np.float32), 1)
            for h in range(0, SIZE, part)
        ]
        self._table = w["ids"] @ np.concatenate([np.eye(SIZE, dtype=np.float32), query, w["key"], *back], 1)
        self._table[:, 3 * SIZE + SIZE :: SIZE + 1] = 1

    def hidden(self, before: np.ndarray) -> np.ndarray:
        """Hidden vectors of windows given the ranks before their places; a row per place."""
        n, wide = before.shape
        at = self._table[before.ravel()]
        query, key = (_split(at[:, k * SIZE : (k + 1) * SIZE], before.shape) for k in (1, 2))
        value = at[:, 3 * SIZE :].reshape(n, wide, HEADS, SIZE + 1).transpose(0, 2, 1, 3)
        raw = np.matmul(query, key.transpose(0, 1, 3, 2), out=self.room("raw", n, HEADS, wide, wide))
        mixed = _shares(raw, self._distance, self.room) @ value
        mixed = (mixed[..., :SIZE] / mixed[..., SIZE:]).sum(1)
        return at[:, :SIZE] + mixed.reshape(-1, SIZE)


def score_texts(model: Model, ids: np.ndarray, first: np.ndarray) -> np.ndarray:
    """log10 of the probability of each text with its end."""
    found = np.zeros(len(first) - 1)
    held: list[tuple] = []
    scorer = _Scorer(model)

    def settle() -> None:
        texts, ranks, hidden = (np.concatenate(x) for x in zip(*held))
        found[:] += np.bincount(texts, log_chances(model, hidden, ranks, scorer.room), len(found))
        held.clear()

    for text, before, target, scored in windows_of(model, ids, first):
        hidden = scorer.hidden(before)
        held.append((np.repeat(text, scored.sum(1)), target[scored], hidden[scored.ravel()]))
        if len(held) * BATCH * WIDTH >= HELD:
            settle()
    if held:
        settle()
    return found


class Trainer:
    """Adagrad on batches of windows, gradients written out."""

    _BY_ROW = ("ids", "output")

    def __init__(self, model: Model, rate: float = RATE, sums: dict[str, np.ndarray] | None = None):
        """``sums`` of squared changes let a trainer go on where another one stopped."""
        self.model, self.rate = model, np.float32(rate)
        self.sums = {n: x.copy() for n, x in sums.items()} if sums else {
            n: np.full((len(w), 1) if n in self._BY_ROW else w.shape, 1e-2, np.float32)
            for n, w in model.weights.items()
        }
        self._room, w = _Room(), model.weights
        # Vectors with their bias in one array, of which the model's weights become views.
        self._both = np.append(w["output"], w["bias"][:, None], 1)
        w["output"], w["bias"] = self._both[:, :SIZE], self._both[:, SIZE]
        self._ones = np.ones(len(self._both) + CLUSTERS, np.float32)
        self._small = np.uint16 if len(self._both) <= 1 << 16 else np.int64
        self._plan(np.minimum(model.starts(), len(self._both)), len(self._both))

    def _plan(self, starts: np.ndarray, ranks: int) -> None:
        """Place in the head and cluster of each rank, and clusters that share a product.

        Small clusters next to each other are computed together, each rank seeing its own cluster only.
        """
        cluster = np.searchsorted(starts, np.arange(ranks), side="right") - 1
        self._place = np.where(cluster < 0, np.arange(ranks), HEAD + cluster)
        self._cluster = cluster
        self._groups, ends = [], [0]
        for c in range(1, CLUSTERS + 1):
            if c == CLUSTERS or starts[c + 1] - starts[ends[-1]] > TOGETHER:
                ends.append(c)
        for a, b in zip(ends, ends[1:]):
            within = np.repeat(np.eye(b - a, dtype=np.float32), np.diff(starts[a : b + 1]), 1)
            self._groups.append((int(starts[a]), int(starts[b]), a, within if b - a > 1 else None))
        self._group = np.searchsorted(ends, cluster, side="right").astype(np.uint8)  # 0: the head

    def _move(self, name: str, change: np.ndarray, rows: np.ndarray | slice = slice(None)) -> None:
        sums, weights = self.sums[name], self.model.weights[name]
        if name in self._BY_ROW:
            squares = np.einsum("ij,ij->i", change, change)[:, None] / np.float32(SIZE)
        else:
            squares = change * change
        sums[rows] += squares
        weights[rows] -= change * (self.rate / np.sqrt(sums[rows]))

    def _chances(self, every: np.ndarray, parts: list[tuple], safe: bool) -> None:
        """Chances of the vectors of all parts, not yet divided by their sums, in place of logarithms to base 2."""
        most = 60 * _LOG2E
        if safe or np.abs(every).max() <= most:
            _powers(every, self._room)
            for _, _, raw, within in parts:
                if within is not None:
                    raw *= within
            return
        np.clip(every, -most, most, out=every)
        for _, _, raw, within in parts:
            if within is not None:
                raw[within == 0] = -np.inf
            raw -= raw.max(1, keepdims=True)
            np.exp2(raw, out=raw)

    def _softmax(self, used: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, list[tuple]]:
        """Change of the hidden vectors ``used``, and moves of all that takes part in the softmaxes."""
        room, both, n = self._room, self._both, len(used)
        head = _head(self.model)
        group = self._group[ranks]
        order = np.argsort(group, kind="stable")
        cuts = np.searchsorted(group[order], np.arange(len(self._groups) + 2))
        rare, cuts = order[cuts[1] :], cuts[1:] - cuts[1]
        # The rows of the head, and after them those of the groups, one group after the other.
        rows = room("rows", n + len(rare), SIZE + 1)
        rows[:n, :SIZE], rows[:n, SIZE] = used, 1
        rows[n:] = rows[rare]
        powers = np.multiply(rows, _LOG2E, out=room("powers", *rows.shape))
        there = np.flatnonzero(cuts[1:] > cuts[:-1]).tolist()
        sizes = [n * len(head)] + [(cuts[g + 1] - cuts[g]) * (self._groups[g][1] - self._groups[g][0]) for g in there]
        every = room("every", int(sum(sizes)))
        raw = np.matmul(powers[:n], head.T, out=every[: sizes[0]].reshape(n, len(head)))
        parts, at = [(slice(n), head, raw, None)], sizes[0]
        chosen = [np.arange(n) * len(head) + self._place[ranks]]
        for g, size in zip(there, sizes[1:]):
            low, high, first, within = self._groups[g]
            own = slice(n + cuts[g], n + cuts[g + 1])
            raw = np.matmul(powers[own], both[low:high].T, out=every[at : at + size].reshape(-1, high - low))
            of = ranks[rare[cuts[g] : cuts[g + 1]]]
            parts.append((own, both[low:high], raw, None if within is None else within[self._cluster[of] - first]))
            chosen.append(np.arange(at - low, at + size - low, high - low) + of)
            at += size
        widest = max(_largest(both[:, :SIZE]), _largest(head[:, :SIZE]))
        bias = max(np.abs(both[:, SIZE]).max(), np.abs(head[:, SIZE]).max())
        self._chances(every, parts, bool(_largest(used) * widest + bias <= 60))
        total = room("total", len(rows))
        for own, _, raw, _ in parts:
            np.matmul(raw, self._ones[: raw.shape[1]], out=total[own])
        every[np.concatenate(chosen)] -= total
        # So a small batch makes a small step.  What is divided by sums is what has the fewest numbers.
        share = (np.float32(1 / WIDTH) / total)[:, None]
        rows *= share
        d_rows, d_both, d_head = room("d_rows", len(rows), SIZE), room("d_both", *both.shape), room("d_head", *head.shape)
        outs = [d_head] + [d_both[slice(*self._groups[g][:2])] for g in there]
        for (own, vectors, error, _), out in zip(parts, outs):
            np.matmul(error, vectors[:, :SIZE], out=d_rows[own])
            np.matmul(error.T, rows[own], out=out)
        d_rows *= share
        d_used = d_rows[:n]
        d_used[rare] += d_rows[n:]
        top = len(head) - CLUSTERS
        d_both[:top] = d_head[:top]
        spans = [[0, top]]
        for low, high, *_ in (self._groups[g] for g in there):
            if spans[-1][1] == low:
                spans[-1][1] = high
            else:
                spans.append([low, high])
        moves = [("cluster", d_head[top:, :SIZE], slice(None)), ("cluster_bias", d_head[top:, SIZE], slice(None))]
        for low, high in spans:
            moves.append(("output", d_both[low:high, :SIZE], slice(low, high)))
            moves.append(("bias", d_both[low:high, SIZE], slice(low, high)))
        return d_used, moves

    def step(self, before: np.ndarray, target: np.ndarray, scored: np.ndarray) -> None:
        w, room, shape = self.model.weights, self._room, before.shape
        n, wide = shape
        flat = before.ravel().astype(self._small)
        inside = w["ids"][flat]
        even = np.float32((SIZE // HEADS) ** -0.5)
        three = np.concatenate([w["query"] * even, w["key"], w["value"]], 1)
        projected = inside @ three
        query, key, value = (_split(projected[:, k * SIZE : (k + 1) * SIZE], shape) for k in range(3))
        raw = room("share", n, HEADS, wide, wide)
        np.matmul(query * _LOG2E, key.transpose(0, 1, 3, 2), out=raw)
        share = _shares(raw, w["distance"], room)
        share /= share.sum(3, keepdims=True)
        mixed = _joined(share @ value)
        hidden = inside + mixed @ w["back"]
        kept = scored.ravel()
        if kept.all():
            d_hidden, moves = self._softmax(hidden, target.ravel())
        else:
            d_hidden = np.zeros_like(hidden)
            d_hidden[kept], moves = self._softmax(hidden[kept], target[scored])
        moves.append(("back", mixed.T @ d_hidden, slice(None)))
        d_mixed = _split(d_hidden @ w["back"].T, shape)
        d_three = np.empty((n * wide, 3 * SIZE), np.float32)
        d_query, d_key, d_value = (_split(d_three[:, k * SIZE : (k + 1) * SIZE], shape) for k in range(3))
        d_value[:] = share.transpose(0, 1, 3, 2) @ d_mixed
        d_raw = np.matmul(d_mixed, value.transpose(0, 1, 3, 2), out=room("d_raw", *share.shape))
        d_raw -= np.einsum("nhij,nhij->nhi", d_raw, share)[..., None]
        d_raw *= share
        by_pair = d_raw.sum(0).reshape(HEADS, -1)
        back = _BACK[:wide, :wide].ravel()
        moves.append(("distance", np.stack([np.bincount(back, p, WIDTH) for p in by_pair]).astype(np.float32), slice(None)))
        d_query[:] = d_raw @ key
        d_key[:] = d_raw.transpose(0, 1, 3, 2) @ query
        d_weights = inside.T @ d_three
        d_weights[:, :SIZE] *= even
        moves += [(name, d_weights[:, k * SIZE : (k + 1) * SIZE], slice(None)) for k, name in enumerate(("query", "key", "value"))]
        d_inside = d_hidden + d_three @ three.T
        order = np.argsort(flat, kind="stable")
        ranks = flat[order]
        cuts = np.append(0, np.flatnonzero(ranks[1:] != ranks[:-1]) + 1)
        moves.append(("ids", np.add.reduceat(d_inside[order], cuts, 0), ranks[cuts]))
        for name, change, rows in moves:
            self._move(name, change, rows)

    def learn(self, ids: np.ndarray, first: np.ndarray, at_once: int = 64) -> int:
        """One pass over all windows, mixed up; returns how many places they have."""
        places = 0
        for _, before, target, scored in windows_of(self.model, ids, first, WIDTH, mixed_up=True):
            for low in range(0, len(before), at_once):
                part = slice(low, low + at_once)
                self.step(before[part], target[part], scored[part])
            places += int(scored.sum())
        return places
