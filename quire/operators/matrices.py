"""Small numpy helpers used inside tasks on one Arrow batch or block at a time."""

from __future__ import annotations

import numpy as np

#: Cells of one score matrix; bounds the memory of a task whatever the number of centroids.
_SCORE_CELLS = 1 << 23


def scores(q: np.ndarray, c: np.ndarray, metric: str) -> np.ndarray:
    """Inner products, or squared Euclidean distances, of every row of ``q`` with every row of ``c``."""
    products = q @ c.T
    if metric == "ip":
        return products
    squares = (q * q).sum(axis=1)[:, None] + (c * c).sum(axis=1)[None, :]
    return np.maximum(squares - 2.0 * products, 0.0)


def best(s: np.ndarray, n: int, metric: str) -> np.ndarray:
    """Column numbers of the ``n`` best scores per row, ties going to the lower column."""
    cost = -s if metric == "ip" else s
    if n == 1:
        return cost.argmin(axis=1)[:, None]
    if n < cost.shape[1]:
        cut = np.partition(cost, n - 1, axis=1)[:, n - 1 : n]
        better, tied = cost < cut, cost == cut
        room = n - better.sum(axis=1, keepdims=True)
        chosen = better | (tied & (tied.cumsum(axis=1) <= room))
        columns = np.nonzero(chosen)[1].reshape(len(cost), n)
    else:
        columns = np.broadcast_to(np.arange(cost.shape[1]), cost.shape)
    order = np.argsort(np.take_along_axis(cost, columns, axis=1), axis=1, kind="stable")
    return np.take_along_axis(columns, order, axis=1)


def better(s: np.ndarray, met: np.ndarray, n: int, metric: str) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of scores no worse than the ``n`` best costs ``met`` of each row, which are brought up to date.

    At least the ``n`` best scores of a row are among them if none were met before; ties go to the lower column.
    """
    cost = -s if metric == "ip" else s
    cut = met.max(axis=1, keepdims=True)
    few = np.isfinite(cut).all()
    if few:
        rows, columns = np.nonzero(cost <= cut)
        few = len(rows) <= n * len(cost)
    if not few:  # at first, or where many scores are equal
        columns = best(s, n, metric)
        rows = np.repeat(np.arange(len(s)), columns.shape[1])
        columns = columns.ravel()
        keep = ~(cost[rows, columns] > cut[rows, 0])
        rows, columns = rows[keep], columns[keep]
    if len(rows):
        count = np.bincount(rows, minlength=len(s))
        own = np.full((len(s), n + count.max()), np.inf)
        own[:, :n] = met
        own[rows, n + np.arange(len(rows)) - np.repeat(np.cumsum(count) - count, count)] = cost[rows, columns]
        met[:] = np.partition(own, n - 1, axis=1)[:, :n]
    return rows, columns


def nearest(x: np.ndarray, c: np.ndarray, metric: str, n: int = 1):
    """``(columns, scores)`` of the ``n`` best rows of ``c`` for each row of ``x``, in row chunks."""
    n = min(n, len(c))
    step = max(1, _SCORE_CELLS // max(1, len(c)))
    found, values = [], []
    for at in range(0, len(x), step):
        s = scores(x[at : at + step], c, metric)
        columns = best(s, n, metric)
        found.append(columns)
        values.append(np.take_along_axis(s, columns, axis=1))
    return np.concatenate(found), np.concatenate(values)


def nearest_in_groups(
    x: np.ndarray, c: np.ndarray, leaders: np.ndarray, starts: np.ndarray, metric: str, n: int = 1, probe: int = 1
):
    """As :func:`nearest`, looking only into the ``probe`` groups of rows of ``c`` with the best leaders.

    Group g is ``c[starts[g]:starts[g + 1]]``. Where these could hold fewer than ``n`` rows, more groups are taken.
    """
    n, sizes = min(n, len(c)), np.diff(starts)
    probe = max(probe, int(np.searchsorted(np.cumsum(np.sort(sizes)), n)) + 1)
    if probe >= len(leaders):
        return nearest(x, c, metric, n)
    found = np.empty((len(x), n), np.int64)
    values = np.empty((len(x), n), np.result_type(x, c))
    step = max(1, _SCORE_CELLS // (probe * n))
    for at in range(0, len(x), step):
        some = x[at : at + step]
        cost = np.full((len(some) * probe, n), np.inf)
        cells = np.full((len(some) * probe, n), len(c))
        groups = nearest(some, leaders, metric, probe)[0].ravel()
        order = np.argsort(groups, kind="stable")
        cuts = np.searchsorted(groups[order], np.arange(len(leaders) + 1))
        for g in np.flatnonzero(np.diff(cuts)):
            slots = order[cuts[g] : cuts[g + 1]]
            columns, s = nearest(some[slots // probe], c[starts[g] : starts[g + 1]], metric, n)
            cells[slots, : columns.shape[1]] = columns + starts[g]
            cost[slots, : columns.shape[1]] = -s if metric == "ip" else s
        cost, cells = cost.reshape(len(some), -1), cells.reshape(len(some), -1)
        order = np.lexsort((cells, cost), axis=1)[:, :n]
        found[at : at + step] = np.take_along_axis(cells, order, axis=1)
        best_cost = np.take_along_axis(cost, order, axis=1)
        values[at : at + step] = -best_cost if metric == "ip" else best_cost
    return found, values


def code_type(n_codes: int):
    return np.uint8 if n_codes <= 256 else np.uint16


def encode(x: np.ndarray, books: np.ndarray) -> np.ndarray:
    """Number of the nearest code for every sub-vector; ``books`` is ``(m, codes, width)``."""
    m, n_codes, width = books.shape
    if x.shape[1] != m * width:
        raise ValueError(f"{x.shape[1]} dimensions do not split into {m} times {width}")
    columns = [
        nearest(x[:, j * width : (j + 1) * width], books[j], "l2")[0][:, 0] for j in range(m)
    ]
    return np.stack(columns, axis=1).astype(code_type(n_codes))


def decode(codes: np.ndarray, books: np.ndarray) -> np.ndarray:
    """Vectors the codes stand for."""
    return np.concatenate([books[j][codes[:, j]] for j in range(len(books))], axis=1)


#: Queries in a block from which decoding the codes once beats looking each one up.
_DECODE_FROM = 16


def code_scores(q: np.ndarray, codes: np.ndarray, books: np.ndarray, metric: str) -> np.ndarray:
    """Scores of raw queries against coded vectors.

    For few queries they are summed from one table per sub-space; for many it is cheaper
    to decode the block and multiply. Both give the same scores.
    """
    if len(q) >= _DECODE_FROM:
        return scores(q, decode(codes, books), metric)
    width = books.shape[2]
    total = np.zeros((len(q), len(codes)))
    for j in range(len(books)):
        table = scores(q[:, j * width : (j + 1) * width], books[j], metric)
        total += table[:, codes[:, j]]
    return total


def sums_by_label(x: np.ndarray, labels: np.ndarray):
    """``(label, count, sum of rows)`` for each label present."""
    order = np.argsort(labels, kind="stable")
    present, starts, counts = np.unique(labels[order], return_index=True, return_counts=True)
    return present, counts, np.add.reduceat(x[order], starts, axis=0)
