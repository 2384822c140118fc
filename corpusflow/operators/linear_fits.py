"""Logistic regressions fitted together: one pass over the rows serves every fit that is still running.

MLlib runs a Spark job for each step of each fit.  Here the rows are written once,
the optimiser of each fit (the L-BFGS and OWL-QN that MLlib uses, step by step,
with its limits and its test of convergence) runs on the driver, and a job takes
the loss and the gradient at the points that all running fits ask for.  The
objective and the start are those of MLlib's ``LogisticRegression`` on columns
that are scaled already (``standardization=False``).

What reaches the driver: for each task and fit one loss and one gradient, and ten
steps of each fit.
"""
from __future__ import annotations

from collections.abc import Callable, Generator, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.session import materialised

#: Steps that an optimiser remembers, and values that its test of convergence looks back on.
MEMORY, BACK = 10, 20


class Failed(Exception):
    """No step of a line search is good enough."""


def _direction(grad: np.ndarray, steps: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The two-loop recursion; ``steps`` holds (step, change of the gradient), the last one first."""
    out, kept, scale = grad.copy(), [], 1.0
    if steps:
        sy = steps[0][0] @ steps[0][1]
        if not sy >= 0:
            raise Failed
        scale = sy / (steps[0][1] @ steps[0][1])
    for s, y in steps:
        rho = s @ y
        a = (s @ out) / rho if rho else np.nan
        if np.isnan(a):
            raise Failed
        out -= a * y
        kept.append((a, rho))
    out *= scale
    for (s, y), (a, rho) in zip(reversed(steps), reversed(kept)):
        out += (a - (y @ out) / rho) * s
    return -out


def _wolfe(point: Callable, first: float) -> Generator:
    """Strong Wolfe line search with cubic interpolation; ``point(t)`` yields the value and slope at ``t``."""
    c1, c2 = 1e-4, 0.9
    f0, d0 = yield from point(0.0)

    def inside(low: tuple, t: float, v: float, d: float) -> float:
        t0, v0, d0_ = low
        # A cubic between the two ends, kept off them.
        x, y = (low, (t, v, d)) if t0 <= t else ((t, v, d), low)
        d1 = x[2] + y[2] - 3 * (x[1] - y[1]) / (x[0] - y[0])
        with np.errstate(invalid="ignore"):
            d2 = np.sqrt(d1 * d1 - x[2] * y[2])
        width = y[0] - x[0]
        at = y[0] - width * (y[2] + d2 - d1) / (y[2] - x[2] + 2 * d2)
        low_end, high_end = x[0] + 0.1 * width, x[0] + 0.9 * width
        return high_end if at > high_end else low_end if at < low_end else at

    def zoom(low: tuple, high: tuple) -> Generator:
        for _ in range(10):
            t = (low[0] + high[0]) / 2 if high[0] == low[0] else inside(low, *high)
            v, d = yield from point(t)
            if v > f0 + c1 * t * d0 or v >= low[1]:
                high = (t, v, d)
            else:
                if abs(d) <= c2 * abs(d0):
                    return t
                if d * (high[0] - low[0]) >= 0:
                    high = low
                low = (t, v, d)
        raise Failed

    if d0 > 0:
        raise Failed
    low, t = (0.0, f0, d0), first
    for i in range(10):
        v, d = yield from point(t)
        if not np.isfinite(v):
            t /= 2
            continue
        if v > f0 + c1 * t * d0 or (v >= low[1] and i > 0):
            return (yield from zoom(low, (t, v, d)))
        if abs(d) <= c2 * abs(d0):
            return t
        if d >= 0:
            return (yield from zoom((t, v, d), low))
        low, t = (t, v, d), t * 1.5
    raise Failed


def _backtrack(point: Callable, first: float, shrink: float) -> Generator:
    """A step whose value and slope are good enough."""
    t, (value, d0) = first, (yield from point(0.0))
    v, d = yield from point(t)
    for _ in range(20):
        by = shrink if v > value + t * d0 * 1e-4 else 2.1 if d < 0.9 * d0 else shrink if d > -0.9 * d0 else 1.0
        if by == 1.0:
            return t
        t *= by
        if not 1e-10 <= t <= 1e10:
            raise Failed
        v, d = yield from point(t)
    raise Failed


def minimise(x: np.ndarray, most: int, tolerance: float, l1: np.ndarray | None = None) -> Generator[np.ndarray, tuple[float, np.ndarray], np.ndarray]:
    """Yields points, is sent (value, gradient) there, and returns the minimum: L-BFGS, or OWL-QN with ``l1`` weights."""
    known: list[tuple[np.ndarray, float, np.ndarray]] = []  # a point is not asked for twice in a row

    def at(x: np.ndarray) -> Generator:
        for p, v, g in known:
            if np.array_equal(p, x):
                return v, g
        v, g = yield x
        known[:] = [*known[-1:], (x, v, g)]
        return v, g

    def adjusted(x: np.ndarray, v: float, g: np.ndarray) -> tuple[float, np.ndarray]:
        if l1 is None:
            return v, g
        at_zero = np.where(g - l1 > 0, g - l1, np.where(g + l1 < 0, g + l1, 0.0))
        return v + float(np.abs(l1 * x).sum()), np.where(l1 == 0, g, np.where(x == 0, at_zero, g + np.sign(x) * l1))

    def moved(x: np.ndarray, ag: np.ndarray, way: np.ndarray, t: float) -> np.ndarray:
        new = x + way * t
        return new if l1 is None else np.where(np.sign(new) == np.where(x != 0, np.sign(x), np.sign(-ag)), new, 0.0)

    v, g = yield from at(x)
    av, ag = adjusted(x, v, g)
    start, past, steps, n, failed = av, [np.inf], [], 0, False
    while n < most and not (n and abs(av - max(past)) <= tolerance * abs(start)) and np.linalg.norm(ag) > max(tolerance * abs(av), 1e-8):
        try:
            way = _direction(ag, steps)
            if l1 is not None:
                way = np.where(way * ag < 0, way, 0.0)

            def point(t: float) -> Generator:
                to = moved(x, ag, way, t)
                got = adjusted(to, *(yield from at(to)))
                return got[0], float(got[1] @ way)

            if l1 is None:
                t = yield from _wolfe(point, 1.0 / np.linalg.norm(way) if n == 0 else 1.0)
                if t * np.linalg.norm(g) < 1e-10:
                    raise Failed
            else:
                t = yield from _backtrack(point, 0.05 / np.linalg.norm(g) if n < 1 else 1.0, 0.1 if n < 1 else 0.5)
        except Failed:
            if failed:
                break
            failed, steps = True, []
            continue
        new = moved(x, ag, way, t)
        v, new_g = yield from at(new)
        steps = [(new - x, new_g - g), *steps][:MEMORY]
        x, g, n, failed = new, new_g, n + 1, False
        av, ag = adjusted(x, v, g)
        past = [*past, av][-BACK:]
    return x


def written(rows: DataFrame, features: str, label: str = "label") -> DataFrame:
    """(y, x): the label and the column ``features``, a vector of one size, as the bytes of its doubles; written once."""

    def pack(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            x = batch.column("x")
            ends, values = x.offsets.to_numpy().astype(np.int64), x.values.to_numpy(zero_copy_only=False)
            held = np.ascontiguousarray(values[ends[0]:ends[-1]], np.float64)
            packed = pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer(((ends - ends[0]) * 8).astype(np.int32)), pa.py_buffer(held)])
            yield pa.RecordBatch.from_arrays([batch.column("y"), packed], names=["y", "x"])

    return materialised(rows.select(F.col(label).cast("double").alias("y"), vector_to_array(features).alias("x")).mapInArrow(pack, "y double, x binary"))


def _logistic_sums() -> Callable:
    def run(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sums of losses and gradients of fits x classes x (columns, intercept) weights; one class is the binomial case."""
        fits, classes, d = w.shape
        m = (x @ w[:, :, :-1].reshape(-1, d - 1).T).reshape(len(x), fits, classes) + w[None, :, :, -1]
        if classes == 1:
            one = (y == 1)[:, None]
            loss = np.logaddexp(0.0, np.where(one, -m[:, :, 0], m[:, :, 0])).sum(0)
            part = (1.0 / (1.0 + np.exp(-np.clip(m[:, :, 0], -700, 700))) - one)[:, :, None]
        else:
            own = np.arange(len(x)), slice(None), y.astype(np.int64)
            m -= m.max(axis=2, keepdims=True)
            part = np.exp(m)
            total = part.sum(axis=2, keepdims=True)
            loss = (np.log(total[:, :, 0]) - m[own]).sum(0)
            part /= total
            part[own] -= 1.0
        grad = (part.reshape(len(x), -1).T @ x).reshape(fits, classes, d - 1)
        return loss, np.concatenate([grad, part.sum(0)[:, :, None]], axis=2)

    return run


def fitted(held: DataFrame, start: np.ndarray, l2: list[float], l1: list[np.ndarray | None], most: int, tolerance: float, n: int) -> list[np.ndarray]:
    """The weights (classes x (columns, intercept)) of every fit on the rows of ``written``; ``l2`` leaves the intercepts out."""
    shape, losses = start.shape, _logistic_sums()
    few = held.coalesce(2 * held.sparkSession.sparkContext.defaultParallelism)

    def sums(points: dict[int, np.ndarray]) -> dict[int, tuple[float, np.ndarray]]:
        fits = list(points)
        w = np.stack([points[k].reshape(shape) for k in fits])

        def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            value, grad = np.zeros(len(w)), np.zeros(w.shape)
            for batch in found:
                x, y = batch.column("x"), batch.column("y").to_numpy(zero_copy_only=False)
                width = w.shape[2] - 1
                offsets = np.frombuffer(x.buffers()[1], np.int32)[x.offset:x.offset + len(x) + 1] if len(x) else np.zeros(1, np.int32)
                rows = np.frombuffer(x.buffers()[2], np.uint8)[offsets[0]:offsets[-1]].view(np.float64).reshape(len(y), width) if len(x) else np.zeros((0, width))
                for lo in range(0, len(y), 2_000):
                    v, g = losses(rows[lo:lo + 2_000], y[lo:lo + 2_000], w)
                    value += v
                    grad += g
            yield pa.RecordBatch.from_arrays([pa.array([value.tobytes()]), pa.array([grad.tobytes()])], names=["value", "grad"])

        parts = few.mapInArrow(run, "value binary, grad binary").collect()
        value = sum(np.frombuffer(p.value) for p in parts) / n
        grad = sum(np.frombuffer(p.grad).reshape(w.shape) for p in parts) / n
        out = {}
        for i, k in enumerate(fits):
            flat = w[i].copy()
            flat[:, -1] = 0.0
            out[k] = float(value[i] + 0.5 * l2[k] * (flat * flat).sum()), (grad[i] + l2[k] * flat).ravel()
        return out

    running = {k: minimise(start.ravel(), most, tolerance, l1[k]) for k in range(len(l2))}
    points, done = {k: next(fit) for k, fit in running.items()}, {}
    while points:
        answers, asked = sums(points), list(points)
        points = {}
        for k in asked:
            try:
                points[k] = running[k].send(answers[k])
            except StopIteration as end:
                done[k] = end.value.reshape(shape)
    return [done[k] for k in range(len(l2))]


def class_counts(held: DataFrame) -> np.ndarray:
    """Rows of every class from 0 to the highest."""
    found = {int(r.y): r["count"] for r in held.groupBy("y").count().collect()}  # one row per class
    return np.array([found.get(k, 0) for k in range(max(found) + 1)], float)


def logistic_weights(held: DataFrame, cells: list[tuple[float, float]], most: int, tolerance: float) -> list[np.ndarray]:
    """The weights of logistic regression for each ``(regParam, elasticNetParam)``: one row of weights for two classes, else one per class."""
    sizes = class_counts(held)
    width = len(held.first().x) // 8 + 1
    if (sizes > 0).sum() == 1:  # all rows of one class: that class, whatever the columns
        alone = np.zeros((1 if len(sizes) <= 2 else len(sizes), width))
        alone[-1 if len(sizes) <= 2 else int(np.argmax(sizes)), -1] = np.inf if len(sizes) != 1 else -np.inf
        return [alone for _ in cells]
    start = np.zeros((1 if len(sizes) == 2 else len(sizes), width))
    start[:, -1] = np.log(sizes[1] / sizes[0]) if len(sizes) == 2 else np.log1p(sizes) - np.log1p(sizes).mean()
    lasso = np.ones(start.shape)
    lasso[:, -1] = 0.0
    l1 = [None if r == 0 or e == 0 else (r * e * lasso).ravel() for r, e in cells]
    return fitted(held, start, [r * (1 - e) for r, e in cells], l1, most, tolerance, int(sizes.sum()))


def predicted(held: DataFrame, weights: list[np.ndarray]) -> list[float]:
    """The share of rows whose label each fit predicts."""
    w = np.stack(weights)

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hits, n = np.zeros(len(w), np.int64), 0
        for batch in found:
            y = batch.column("y").to_numpy(zero_copy_only=False)
            x = np.array([np.frombuffer(v.as_py()) for v in batch.column("x")]).reshape(len(y), w.shape[2] - 1)
            m = np.einsum("nd,fkd->nfk", x, w[:, :, :-1], optimize=True) + w[None, :, :, -1]
            chosen = m[:, :, 0] > 0 if w.shape[1] == 1 else m.argmax(axis=2)
            hits, n = hits + (chosen == y[:, None]).sum(0), n + len(y)
        yield pa.RecordBatch.from_arrays([pa.array([hits.tobytes()]), pa.array([n])], names=["hits", "n"])

    parts = held.mapInArrow(run, "hits binary, n long").collect()
    n = sum(p.n for p in parts)
    return (sum(np.frombuffer(p.hits, np.int64) for p in parts) / n).tolist() if n else [None] * len(weights)
