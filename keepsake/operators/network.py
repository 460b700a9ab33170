"""MLlib's feed-forward network, trained by matrix products over chunks of rows.

The network, its first weights, its loss and its model are MLlib's; the passes over the training
rows are numpy's, in Spark tasks. L-BFGS with a line search for the strong Wolfe conditions (Nocedal
and Wright, algorithms 7.4, 3.5 and 3.6) takes its steps on the driver, which holds the weights and
the sums of each pass.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import RDD, StorageLevel
from pyspark.ml.classification import (
    MultilayerPerceptronClassificationModel,
    MultilayerPerceptronClassifier,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keepsake.functions.cells import column

# Up to so many rows MLlib's own passes are as quick.
FEW_ROWS = 20_000

# Rows of a chunk, at least: one chunk is one matrix product per layer.
_CHUNK = 1024
# Numbers of a layer's output in one step. Fewer stay in a nearer cache, but numpy's calls then cost more.
_NUMBERS = 51_200
# Rows of a cached partition, about and at most; so many partitions' sums go to the driver directly.
_PART, _DIRECT = 500_000, 64

# Corrections that L-BFGS remembers, values that must agree before it stops, and its line search.
_HISTORY, _VALUES = 10, 20
_STEPS, _DECREASE, _CURVATURE = 10, 1e-4, 0.9

# exp at the points of a grid, up to 40 either way, and a cubic for exp(d / _GRID), |d| <= 1 / 2: the
# series with its fourth term spread over the others (Chebyshev).
_GRID = 1024
_EDGE = 40 * _GRID
_POWERS = np.exp(np.arange(-_EDGE, _EDGE + 1) / _GRID)
_CUBIC = (1 - _GRID**-4 / 3072, 1 / _GRID, _GRID**-2 / 2 + _GRID**-4 / 96, _GRID**-3 / 6)
# Added to a number, it leaves the nearest integer in the last bits.
_ROUND = 1.5 * 2**52
_FIRST = int(np.float64(_ROUND).view(np.int64)) - _EDGE

Loss = Callable[[np.ndarray], tuple[float, np.ndarray]]


class BlockNetwork(MultilayerPerceptronClassifier):
    """As its base class, which it asks for its first weights and its model.

    A partition's rows make blocks of ``blockSize``, the last one shorter; each block weighs alike,
    its rows too. Rows of many blocks go through the layers together, so a small ``blockSize`` costs
    nothing. The steps are MLlib's up to rounding. The fit of ``FEW_ROWS`` rows or fewer, and that by
    solver ``gd``, is MLlib's own; of other fits the model's ``summary`` tells nothing.
    """

    def _fit(self, dataset: DataFrame) -> MultilayerPerceptronClassificationModel:
        rows = dataset.count() if self.getSolver() == "l-bfgs" else 0
        if rows <= FEW_ROWS:
            return super()._fit(dataset)
        layers = self.getLayers()
        chunks = self._chunks(dataset, rows).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            blocks = chunks.map(lambda c: c[3]).sum()
            loss: Loss = lambda w: _mean_loss(chunks, layers, w, blocks)
            start = self._model(dataset).weights.toArray()
            weights = minimum(loss, start, self.getMaxIter(), self.getTol())
        finally:
            chunks.unpersist()
        return self._model(dataset, weights)

    def _model(
        self, dataset: DataFrame, weights: np.ndarray | None = None
    ) -> MultilayerPerceptronClassificationModel:
        """MLlib's model with these weights, or with those it starts from."""
        given = {} if weights is None else {self.initialWeights: weights.tolist()}
        still = self.copy({self.maxIter: 0, **given})
        zeros = F.array_repeat(F.lit(0.0), self.getLayers()[0])
        row = dataset.sparkSession.range(1).select(
            array_to_vector(zeros).alias(self.getFeaturesCol()),
            F.lit(0.0).alias(self.getLabelCol()),
        )
        return MultilayerPerceptronClassifier._fit(still, row)

    def _chunks(self, dataset: DataFrame, rows: int) -> RDD:
        """``(features, labels, weight, blocks)`` of chunks, dealt evenly to the session's cores."""
        layers, size = self.getLayers(), self.getBlockSize()
        numbers = dataset.select(
            vector_to_array(column(self.getFeaturesCol())).alias("x"),
            column(self.getLabelCol()).cast("double").alias("y"),
        )
        chunks = numbers.mapInArrow(
            lambda batches: _chunked(batches, layers[0], layers[-1], size),
            "x binary, y binary, weight double, blocks long",
        )
        cores = dataset.sparkSession.sparkContext.defaultParallelism
        if rows > cores * _CHUNK:
            chunks = chunks.repartition(cores * math.ceil(rows / (cores * _PART)))
        return chunks.rdd.map(tuple)


def _codec() -> pa.Codec:
    return pa.Codec("lz4")


def _chunked(
    batches: Iterator[pa.RecordBatch], inputs: int, classes: int, size: int
) -> Iterator[pa.RecordBatch]:
    """A partition's rows in whole blocks, and its last block. Rows that a network can't take are
    an error."""
    many = size * math.ceil(_CHUNK / size)
    xs, ys, held = [], [], 0
    for batch in batches:
        x, y = batch.column("x"), batch.column("y")
        if x.null_count or y.null_count:
            raise ValueError("a training row has no features or no label")
        if pc.any(pc.not_equal(pc.list_value_length(x), inputs)).as_py():
            raise ValueError(f"a training row has not {inputs} features")
        x = x.flatten().to_numpy(zero_copy_only=False).reshape(len(batch), inputs)
        y = y.to_numpy(zero_copy_only=False)
        if not np.isfinite(x).all():
            raise ValueError("a training row has a feature that is no finite number")
        if not np.isin(y, np.arange(classes)).all():
            raise ValueError(f"labels are 0 to {classes - 1}")
        xs.append(x)
        ys.append(y)
        held += len(y)
        if held >= many:
            x, y = np.concatenate(xs), np.concatenate(ys)
            whole = held - held % many
            for at in range(0, whole, many):
                yield _row(x[at : at + many], y[at : at + many], 1 / size, many // size)
            xs, ys, held = [x[whole:]], [y[whole:]], held - whole
    if held:
        x, y = np.concatenate(xs), np.concatenate(ys)
        whole = held - held % size
        if whole:
            yield _row(x[:whole], y[:whole], 1 / size, whole // size)
        if whole < held:
            yield _row(x[whole:], y[whole:], 1 / (held - whole), 1)


def _row(x: np.ndarray, y: np.ndarray, weight: float, blocks: int) -> pa.RecordBatch:
    packed = _codec().compress(np.ascontiguousarray(x, "<f8").tobytes(), asbytes=True)
    values = [[packed], [y.astype("<i4").tobytes()], [weight], [blocks]]
    types = [pa.binary(), pa.binary(), pa.float64(), pa.int64()]
    return pa.RecordBatch.from_arrays(
        [pa.array(v, t) for v, t in zip(values, types)], names=["x", "y", "weight", "blocks"]
    )


def _mean_loss(
    chunks: RDD, layers: list[int], weights: np.ndarray, blocks: int
) -> tuple[float, np.ndarray]:
    """The mean loss of all blocks and its gradient, summed near the rows first."""
    step = max(1, _NUMBERS // max(layers))
    depth = 1 if chunks.getNumPartitions() <= _DIRECT else 2
    sums = chunks.mapPartitions(lambda part: [_summed(part, layers, weights, step)])
    total = sums.treeAggregate(np.zeros(len(weights) + 1), np.add, np.add, depth)
    return total[0] / blocks, total[1:] / blocks


def _summed(
    part: Iterator[tuple], layers: list[int], weights: np.ndarray, step: int
) -> np.ndarray:
    """The weighted loss of a partition's chunks, and after it the gradient."""
    total, rooms = np.zeros(len(weights) + 1), {}
    for x, y, weight, _ in part:
        y = np.frombuffer(y, "<i4")
        size = len(y) * layers[0] * 8
        x = np.frombuffer(_codec().decompress(x, size), "<f8").reshape(len(y), layers[0])
        for at in range(0, len(y), step):
            rows = len(y[at : at + step])
            if rows not in rooms:
                # Whole steps, and what is left of a chunk: few sizes, of which one is kept besides.
                rooms = {k: v for k, v in rooms.items() if k == step}
                rooms[rows] = _Room(layers, weights, rows)
            total += weight * rooms[rows].loss(x[at : at + step], y[at : at + step])
    return total


class _Room:
    """A network's weights, and room for the numbers of so many rows in every layer, which is used
    again and again. A layer's numbers are a matrix of a column for each row, with ones below them:
    weights and bias are one matrix, as they lie side by side in ``weights``."""

    def __init__(self, layers: list[int], weights: np.ndarray, rows: int):
        self.classes, self.places, at = np.arange(layers[-1])[:, None], [], 0
        for n, m in zip(layers, layers[1:]):
            self.places.append((at, at + (n + 1) * m, (n + 1, m)))
            at += (n + 1) * m
        self.matrices = [weights[a:b].reshape(shape) for a, b, shape in self.places]
        # Times a power of 2, which rounds nothing.
        self.scaled = [w * -_GRID for w in self.matrices[:-1]]
        self.values = [np.ones((n + 1, rows)) for n in layers[:-1]]
        self.last = np.empty((layers[-1], rows))
        # Layers share this room, so that it stays in the cache.
        spare = np.empty((3, max(layers) * rows))
        index = np.empty(max(layers) * rows, np.int64)
        self.spare = [[s[: n * rows].reshape(n, rows) for s in spare] for n in layers[:-1]]
        self.index = [index[: n * rows].reshape(n, rows) for n in layers[:-1]]
        self.found = np.empty(len(weights) + 1)

    def loss(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """The summed cross-entropy of the rows, and after it the gradient. It is overwritten by
        the next rows."""
        self.values[0][:-1] = x.T
        with np.errstate(over="ignore", divide="ignore", invalid="ignore"):
            for k, w in enumerate(self.scaled):
                z = self.values[k + 1][:-1]
                np.matmul(w.T, self.values[k], out=z)
                _sigmoid(z, *self.spare[k + 1][:2], self.index[k + 1])
            z = np.matmul(self.matrices[-1].T, self.values[-1], out=self.last)
            z -= z.max(axis=0)
            np.exp(z, out=z)
            z /= z.sum(axis=0)
            # A probability of 0, also of another class, makes the loss no number: the step was too long.
            target = (self.classes == y).astype("f8")
            self.found[0] = -(target * np.log(z)).sum()
            delta = np.subtract(z, target, out=z)
            for k in range(len(self.matrices) - 1, -1, -1):
                a, b, shape = self.places[k]
                np.matmul(self.values[k], delta.T, out=self.found[a + 1 : b + 1].reshape(shape))
                if k:
                    value, slope, room = self.values[k][:-1], self.spare[k][0], self.spare[k][1 + k % 2]
                    delta = np.matmul(self.matrices[k][:-1], delta, out=room)
                    np.subtract(1, value, out=slope)
                    slope *= value
                    delta *= slope
        return self.found


def _sigmoid(z: np.ndarray, near: np.ndarray, power: np.ndarray, index: np.ndarray) -> None:
    """In place of ``z``, which is -``_GRID`` times x, 1 / (1 + exp(-x)): exp at the next point of
    the grid, from a table, times a cubic off the point. It is right to 1e-15 of itself within
    ``_EDGE`` grid points from 0 and stays as it is there beyond; numpy's exp of doubles takes
    half as long again where the processor has no AVX-512."""
    np.clip(z, -_EDGE, _EDGE, out=z)
    # The sum's last bits are the number of the point.
    np.add(z, _ROUND, out=near)
    np.subtract(near.view(np.int64), _FIRST, out=index)
    near -= _ROUND
    z -= near
    np.multiply(z, _CUBIC[3], out=near)
    for c in _CUBIC[2:0:-1]:
        near += c
        near *= z
    near += _CUBIC[0]
    np.take(_POWERS, index, out=power, mode="clip")  # no number has some point, and stays none
    power *= near
    power += 1
    np.divide(1, power, out=z)


class _NoStep(ArithmeticError):
    """There is no good step along this direction."""


def minimum(loss: Loss, x: np.ndarray, steps: int, tol: float) -> np.ndarray:
    """Where L-BFGS stops: after so many steps, or where the last values agree to ``tol`` times the
    first one, or at a gradient of almost 0, or where there is no good step even by the gradient."""
    value, grad = loss(x)
    first, values, history, done, failed = value, [math.inf], [], 0, False
    while not (
        done >= steps
        or (len(values) > 1 and abs(value - max(values)) <= tol * first)
        or np.linalg.norm(grad) <= max(tol * abs(value), 1e-8)
    ):
        try:
            way = _direction(grad, history)
            length = 1.0 if done else 1 / np.linalg.norm(way)
            new, new_value, new_grad = _search(loss, x, value, grad, way, length)
        except _NoStep:
            if failed:
                break
            failed, history = True, []
            continue
        history = [(new - x, new_grad - grad), *history][:_HISTORY]
        x, value, grad, done, failed = new, new_value, new_grad, done + 1, False
        values = [*values, value][-_VALUES:]
    return x


def _direction(grad: np.ndarray, history: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    way, shares = grad.copy(), []
    for s, y in history:
        shares.append(s @ way / (s @ y))
        way -= shares[-1] * y
    if history:
        s, y = history[0]
        if not s @ y >= 0 or np.isnan(shares).any():
            raise _NoStep
        way *= s @ y / (y @ y)
    for (s, y), share in zip(history[::-1], shares[::-1]):
        way += (share - y @ way / (s @ y)) * s
    return -way


def _search(
    loss: Loss, x: np.ndarray, value: float, grad: np.ndarray, way: np.ndarray, t: float
) -> tuple[np.ndarray, float, np.ndarray]:
    """The point, value and gradient at a step that meets the strong Wolfe conditions."""
    slope = grad @ way
    if slope > 0:
        raise _NoStep

    def at(t: float) -> tuple:
        point = x + t * way
        found, there = loss(point)
        return t, found, there @ way, point, there

    def ended(c: tuple) -> tuple[np.ndarray, float, np.ndarray]:
        if c[0] * np.linalg.norm(grad) < 1e-10:
            raise _NoStep
        return c[3], c[1], c[4]

    def zoom(low: tuple, high: tuple) -> tuple[np.ndarray, float, np.ndarray]:
        for _ in range(_STEPS):
            c = at(_between(*sorted((low, high), key=lambda b: b[0])))
            if c[1] > value + _DECREASE * c[0] * slope or c[1] >= low[1]:
                high = c
                continue
            if abs(c[2]) <= _CURVATURE * abs(slope):
                return ended(c)
            if c[2] * (high[0] - low[0]) >= 0:
                high = low
            low = c
        raise _NoStep

    low = (0.0, value, slope)
    for k in range(_STEPS):
        c = at(t)
        if not math.isfinite(c[1]):
            t /= 2
            continue
        if c[1] > value + _DECREASE * t * slope or (c[1] >= low[1] and k):
            return zoom(low, c)
        if abs(c[2]) <= _CURVATURE * abs(slope):
            return ended(c)
        if c[2] >= 0:
            return zoom(c, low)
        low, t = c, t * 1.5
    raise _NoStep


def _between(left: tuple, right: tuple) -> float:
    """Where the cubic through both ends is least, off the ends."""
    (a, f, d, *_), (b, g, e, *_) = left, right
    d1 = d + e - 3 * (f - g) / (a - b)
    with np.errstate(all="ignore"):
        d2 = np.sqrt(d1 * d1 - d * e)
        t = b - (b - a) * (e + d2 - d1) / (e - d + 2 * d2)
    near, far = a + 0.1 * (b - a), a + 0.9 * (b - a)
    return float(near if t < near else far if t > far else t)
