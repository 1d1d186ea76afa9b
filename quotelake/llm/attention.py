"""A causal self-attention model over subword classes, in numpy.

Subword ids fall into fine classes, and these into coarse ones: the most frequent ids have a class each, the others
share classes by frequency and by whether they begin a word. The model predicts the coarse class
from the fine classes before it; the id within its class gets its probability from corpus counts, so every
id has one.

One attention layer reads the last 17 to 32 classes: positions are scored in chunks of ``CHUNK``, and a chunk's
keys are the chunk before and itself, masked to the past. The windows overlap by one chunk and each
token is scored once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, fields

import numpy as np

from quotelake.llm.graphs import MICROSOFT, Graph

CHUNK = 16
CONTEXT = 2 * CHUNK
COARSE = (96, 31)
FINE = (448, 63)
WIDTH = 24

#: Windows in a training step, and windows scored at a time.
STEP_WINDOWS = 256
SCORE_WINDOWS = 128


@dataclass(frozen=True)
class Classes:
    """Fine class of each id, coarse class of each fine one (0: the end of a text), and each id's share of its
    coarse class."""

    fine: np.ndarray
    coarse_of: np.ndarray
    share: np.ndarray

    @property
    def coarse(self) -> np.ndarray:
        return self.coarse_of[self.fine]

    @property
    def sizes(self) -> tuple[int, int]:
        return len(self.coarse_of), sum(COARSE) + 1


def _grouped(weights: np.ndarray, begins_word: np.ndarray, own: int, shared: int) -> np.ndarray:
    """Numbers from 1: the ``own`` heaviest items one each; the others in ``shared`` groups of like
    weight, those that begin words apart from the rest."""
    order = np.lexsort((np.arange(len(weights)), -weights))
    found = np.zeros(len(weights), dtype=np.int64)
    found[order[:own]] = 1 + np.arange(len(order[:own]))
    first = own + 1
    for begins, n in ((True, shared // 2), (False, shared - shared // 2)):
        rest = order[own:]
        rest = rest[begins_word[rest] == begins]
        if len(rest):
            sums = np.cumsum(weights[rest])
            found[rest] = first + np.minimum((sums / sums[-1] * n).astype(int), n - 1)
        first += n
    return found


def make_classes(counts: np.ndarray, begins_word: np.ndarray) -> Classes:
    smooth = counts + 1.0
    fine = _grouped(smooth, begins_word, *FINE)
    n_fine, n_coarse = sum(FINE) + 1, sum(COARSE) + 1
    heavy = np.bincount(fine, smooth, n_fine)[1:]
    begins = np.zeros(n_fine, dtype=bool)
    begins[fine] = begins_word
    coarse_of = np.append(0, _grouped(heavy + 1e-9, begins[1:], *COARSE))
    total = np.bincount(coarse_of[fine], smooth, n_coarse)
    return Classes(fine.astype(np.uint16), coarse_of.astype(np.uint8), smooth / total[coarse_of[fine]])


@dataclass
class Weights:
    """Query, key and value vectors of each coarse class, residual vectors of each fine class, distance bias, output
    matrix, and the logits that follow from the last fine class alone."""

    q: np.ndarray
    k: np.ndarray
    v: np.ndarray
    r: np.ndarray
    distance: np.ndarray
    out: np.ndarray
    after: np.ndarray

    @classmethod
    def start(cls, sizes: tuple[int, int], seed: int = 1) -> Weights:
        rng, (m, n) = np.random.default_rng(seed), sizes

        def small(*shape: int) -> np.ndarray:
            return (rng.standard_normal(shape) * 0.3).astype(np.float32)

        return cls(small(n, WIDTH), small(n, WIDTH), small(n, WIDTH), small(m, WIDTH),
                   np.zeros(CONTEXT, np.float32), small(WIDTH, n) * 0.1, np.zeros((m, n), np.float32))

    def parts(self) -> list[np.ndarray]:
        return [getattr(self, f.name) for f in fields(self)]

    def dump(self) -> bytes:
        return b"".join(p.astype("<f4").tobytes() for p in self.parts())

    @classmethod
    def load(cls, data: bytes, sizes: tuple[int, int]) -> Weights:
        return cls.start(sizes).over(np.frombuffer(data, "<f4").copy())

    def over(self, flat: np.ndarray) -> Weights:
        """Weights of the same shapes that lie in ``flat``."""
        ends = np.cumsum([p.size for p in self.parts()])
        return Weights(*(flat[e - p.size : e].reshape(p.shape) for e, p in zip(ends, self.parts(), strict=True)))


#: Distance of each key of a window from each of its queries; negative: in the future.
AWAY = (np.arange(CHUNK)[:, None] + CHUNK) - np.arange(CONTEXT)[None, :]


def _tables(w: Weights) -> tuple[np.ndarray, np.ndarray]:
    """Attention weight of a query and a key class (0 for the padding class, the last), and of a distance (0 for the future)."""
    pair = np.zeros((len(w.q) + 1, len(w.k) + 1), np.float32)
    scaled = w.q / np.float32(np.sqrt(WIDTH)) @ w.k.T
    np.exp(np.minimum(np.maximum(scaled, -20, out=scaled), 20, out=scaled), out=pair[:-1, :-1])
    far = np.exp(np.minimum(np.maximum(w.distance, -20), 20)).take(np.abs(AWAY)) * (AWAY >= 0)
    return pair, far.astype(np.float32)


def layout(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First chunk of each text (its padding chunk), then the number of all chunks; and the number of own chunks.

    A text of n classes has n + 1 places: the end mark and its classes as inputs, its classes and the end
    mark as targets."""
    own = -(-(lengths + 1) // CHUNK)
    return np.concatenate(([0], np.cumsum(own + 1))), own


def windows(
    flat: np.ndarray, lengths: np.ndarray, coarse_of: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fine inputs and coarse targets by chunks (padding: one past the last class), and the first chunk of each text."""
    first, _ = layout(lengths)
    inputs = np.full(first[-1] * CHUNK, len(coarse_of), dtype=np.uint16)
    targets = np.full(first[-1] * CHUNK, sum(COARSE) + 1, dtype=np.uint8)
    begin = (first[:-1] + 1) * CHUNK
    place = np.repeat(begin - np.concatenate(([0], np.cumsum(lengths)))[:-1], lengths) + np.arange(len(flat))
    inputs[begin] = 0
    inputs[place + 1] = flat
    targets[place] = coarse_of[flat]
    targets[begin + lengths] = 0
    return inputs.reshape(-1, CHUNK), targets.reshape(-1, CHUNK), first


def _forward(outputs: dict[str, int], **constants: np.ndarray) -> Graph:
    """Graph from the weights of a batch of windows to the next class's logits at each place."""
    graph = Graph(
        {"weight": 3, "values": 3, "own": 2, "follow": 2, "out": 2}, {"k": 2, "last": 2, "aim": 2}, outputs,
        rows=np.array([-1, WIDTH]), **constants,
    )
    graph.node("sums", "MatMul", "weight", "values")
    graph.node("mean", "Reshape", "sums", "rows")
    graph.node("hidden", "Add", "mean", "own")
    graph.node("active", "Relu", "hidden")
    graph.node("logits", "Gemm", "active", "out", "follow")
    return graph


def _score_graph() -> Graph:
    graph = _forward({"given": 2})
    graph.node("shares", "LogSoftmax", "logits", axis=1)
    graph.node("given", "GatherElements", "shares", "aim", axis=1)
    return graph


def _step_graph() -> Graph:
    """Slopes of the loss summed over the places with a target. Padding places read nothing, so theirs are zero but
    for the row of the padding class."""
    m, n = sum(FINE) + 1, sum(COARSE) + 1
    graph = _forward(
        {"chosen": 2, "d_near": 3, "dot": 2, "d_v": 2, "d_r": 2, "d_out": 2, "d_after": 2},
        zero=np.array(0, np.float32), one=np.array(1, np.float32), minus=np.array(-1, np.float32), huge=np.array(1e38, np.float32),
        windows=np.array([-1, CHUNK, WIDTH]), column=np.array([-1, 1]), second=np.array([1]),
        all_v=np.array([n + 1, WIDTH]), all_r=np.array([m + 1, WIDTH]), all_after=np.array([m + 1, n]),
    )
    graph.node("p", "Softmax", "logits", axis=1)
    graph.node("chosen", "GatherElements", "p", "aim", axis=1)
    graph.node("places", "Shape", "chosen")
    graph.node("less", "Expand", "minus", "places")
    graph.node("slope", "ScatterElements", "p", "aim", "less", axis=1, reduction="add")
    graph.node("no_after", "Expand", "zero", "all_after")
    graph.node("d_after", "ScatterND", "no_after", "last", "slope", reduction="add")
    graph.node("d_out", "FusedMatMul", "active", "slope", domain=MICROSOFT, transA=1)
    graph.node("through", "FusedMatMul", "slope", "out", domain=MICROSOFT, transB=1)
    graph.node("large", "Mul", "active", "huge")
    graph.node("on", "Clip", "large", "zero", "one")
    graph.node("d_hidden", "Mul", "through", "on")
    graph.node("no_r", "Expand", "zero", "all_r")
    graph.node("d_r", "ScatterND", "no_r", "last", "d_hidden", reduction="add")
    graph.node("d_sums", "Reshape", "d_hidden", "windows")
    graph.node("d_values", "FusedMatMul", "weight", "d_sums", domain=MICROSOFT, transA=1)
    graph.node("d_keys", "Reshape", "d_values", "rows")
    graph.node("no_v", "Expand", "zero", "all_v")
    graph.node("keys", "Reshape", "k", "column")
    graph.node("d_v", "ScatterND", "no_v", "keys", "d_keys", reduction="add")
    graph.node("d_near", "FusedMatMul", "d_sums", "values", domain=MICROSOFT, transB=1)
    graph.node("both", "Mul", "d_hidden", "mean")
    graph.node("dot", "ReduceSum", "both", "second")
    return graph


_SCORES, _STEP = _score_graph(), _step_graph()


def _logits(
    weight: np.ndarray, values: np.ndarray, own: np.ndarray, follow: np.ndarray, out: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What the graphs begin with, in numpy; the logits less their largest."""
    mean = np.matmul(weight, values).reshape(-1, WIDTH)
    active = np.maximum(mean + own, 0)
    logits = active @ out
    logits += follow
    logits -= logits.max(axis=1, keepdims=True)
    return mean, active, logits


def _scores(k: np.ndarray, last: np.ndarray, aim: np.ndarray, **of_windows: np.ndarray) -> list[np.ndarray]:
    """``_SCORES`` in numpy."""
    logits = _logits(**of_windows)[-1]
    given = np.take_along_axis(logits, aim, axis=1)
    return [given - np.log(np.exp(logits, out=logits).sum(axis=1, keepdims=True))]


def _row_sums(rows: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """``size`` rows, each the sum of the ``rows`` whose number in ``at`` is its own."""
    found, order = np.zeros((size, rows.shape[1]), np.float32), np.argsort(at, kind="stable")
    first = np.flatnonzero(np.append(True, np.diff(at[order]) != 0))
    found[at[order[first]]] = np.add.reduceat(rows.take(order, axis=0), first, axis=0)
    return found


def _step(k: np.ndarray, last: np.ndarray, aim: np.ndarray, **of_windows: np.ndarray) -> list[np.ndarray]:
    """``_STEP`` in numpy."""
    weight, values, last = of_windows["weight"], of_windows["values"], last.ravel()
    m, n = sum(FINE) + 1, sum(COARSE) + 1
    mean, active, p = _logits(**of_windows)
    np.exp(p, out=p)
    p /= p.sum(axis=1, keepdims=True)
    chosen = np.take_along_axis(p, aim, axis=1)
    np.put_along_axis(p, aim, chosen - 1, axis=1)
    d_hidden = p @ of_windows["out"].T
    d_hidden *= active > 0
    d_sums = d_hidden.reshape(len(k), CHUNK, WIDTH)
    d_keys = np.matmul(weight.transpose(0, 2, 1), d_sums).reshape(-1, WIDTH)
    return [
        chosen, np.matmul(d_sums, values.transpose(0, 2, 1)), (d_hidden * mean).sum(axis=1, keepdims=True),
        _row_sums(d_keys, k.ravel(), n + 1), _row_sums(d_hidden, last, m + 1), active.T @ p, _row_sums(p, last, m + 1),
    ]


class _Batches:
    """Inputs of the graphs for batches of windows, by one model. They lie in ``memory`` until the next batch, as new
    memory for each costs more than what is computed in it."""

    def __init__(self, w: Weights, coarse_of: np.ndarray, memory: dict[str, np.ndarray]):
        self.n, self.memory = len(w.q), memory
        self.coarse_of = np.append(coarse_of, self.n).astype(np.int64)
        pair, self.far = _tables(w)
        self.pair, self.after = pair.ravel(), w.after
        self.out = self._room("out", np.float32, *w.out.shape)
        self.out[:] = w.out
        self.v, self.r = (np.vstack([t, np.zeros((1, WIDTH), np.float32)]) for t in (w.v, w.r))

    def _room(self, name: str, kind: type, *shape: int) -> np.ndarray:
        held, size = self.memory.get(name), math.prod(shape)
        if held is None or held.size < size:
            whole = np.empty(size * np.dtype(kind).itemsize + 64, np.uint8)
            begin = -whole.ctypes.data % 64  # of a cache line
            held = self.memory[name] = whole[begin : begin + len(whole) - 64].view(kind)
        return held[:size].reshape(shape)

    def _rows(self, name: str, table: np.ndarray, at: np.ndarray) -> np.ndarray:
        # no index is out of range but for logits after the padding class, which nobody reads; clipping is the fast mode
        return table.take(at, axis=0, mode="clip", out=self._room(name, np.float32, *at.shape, *table.shape[1:]))

    def of(self, before: np.ndarray, last: np.ndarray, aim: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]:
        """The inputs, the places that have no target, and where each weight lies in the table of pairs."""
        k = self.coarse_of.take(np.concatenate([before, last], axis=1), mode="clip")
        at = self._room("at", np.int64, len(k), CHUNK, CONTEXT)
        np.add((k[:, CHUNK:] * (self.n + 1))[:, :, None], k[:, None, :], out=at)
        weight = self._rows("weight", self.pair, at)
        weight *= self.far
        total = weight.reshape(-1, CONTEXT) @ np.ones(CONTEXT, np.float32)
        weight /= np.maximum(total, 1e-30).reshape(-1, CHUNK, 1)
        last, aim = last.ravel().astype(np.int64), aim.reshape(-1, 1).astype(np.int64)
        outside = np.flatnonzero(aim == self.n)
        aim[outside] = 0
        given = {
            "weight": weight, "values": self._rows("values", self.v, k), "own": self._rows("own", self.r, last),
            "follow": self._rows("follow", self.after, last), "out": self.out, "k": k, "last": last.reshape(-1, 1), "aim": aim,
        }
        return given, outside, at


def text_scores(w: Weights, flat: np.ndarray, lengths: np.ndarray, coarse_of: np.ndarray) -> np.ndarray:
    """log10 probability of the coarse classes of each text (``flat``: fine classes), its end included."""
    n = w.out.shape[1]
    inputs, targets, first = windows(flat, lengths, coarse_of)
    batches, run = _Batches(w, coarse_of, {}), _SCORES if _SCORES.ready() else _scores
    found = np.zeros(len(inputs))
    real = np.flatnonzero((targets != n).any(axis=1))
    for at in range(0, len(real), SCORE_WINDOWS):
        rows = real[at : at + SCORE_WINDOWS]
        batch, outside, _ = batches.of(inputs[rows - 1], inputs[rows], targets[rows])
        given = run(**batch)[0]
        given[outside] = 0
        found[rows] = given.reshape(len(rows), CHUNK).sum(axis=1, dtype=np.float64)
    return np.add.reduceat(found, first[:-1]) / np.log(10) if len(lengths) else np.zeros(0)


def _slopes(
    w: Weights, before: np.ndarray, last: np.ndarray, aim: np.ndarray, coarse_of: np.ndarray,
    memory: dict[str, np.ndarray] | None = None,
) -> tuple[list[np.ndarray], float]:
    """Gradient of the mean loss over a batch of windows, and the loss. ``memory`` is used again by the next batch."""
    m, n = w.after.shape
    batch, outside, at = _Batches(w, coarse_of, {} if memory is None else memory).of(before, last, aim)
    run = _STEP if _STEP.ready() else _step
    chosen, d_weight, dot, d_v, d_r, d_out, d_after = run(**batch)
    count = max(1, len(chosen) - len(outside))
    chosen[outside] = 1
    loss = -np.log(np.maximum(chosen, 1e-37)).sum(dtype=np.float64) / count
    # the weights of a place add up to one
    d_weight -= dot.reshape(-1, CHUNK, 1)
    d_weight *= batch["weight"]
    d_pair = np.bincount(at.ravel(), d_weight.ravel(), (n + 1) ** 2).reshape(n + 1, n + 1)[:n, :n].astype(np.float32)
    d_pair /= np.sqrt(WIDTH)
    d_far = np.bincount(np.maximum(AWAY, 0).ravel(), (d_weight.sum(axis=0) * (AWAY >= 0)).ravel(), CONTEXT)
    slopes = [d_pair @ w.k, d_pair.T @ w.q, d_v[:n], d_r[:m], d_far.astype(np.float32), d_out, d_after[:m]]
    return [s / np.float32(count) for s in slopes], float(loss)


def _steps(texts: list[np.ndarray], coarse_of: np.ndarray, rounds: int, seed: int) -> Iterator[tuple[np.ndarray, ...]]:
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    inputs, targets, _ = windows(np.concatenate([*texts, np.zeros(0, np.uint16)]), lengths, coarse_of)
    real = np.flatnonzero((targets <= sum(COARSE)).any(axis=1))
    rng = np.random.default_rng(seed)
    for _ in range(rounds):
        order = rng.permutation(real)
        for at in range(0, len(order), STEP_WINDOWS):
            rows = order[at : at + STEP_WINDOWS]
            yield inputs[rows - 1], inputs[rows], targets[rows]


def train(
    w: Weights, texts: list[np.ndarray], coarse_of: np.ndarray, rounds: int, rate: float, seed: int = 0
) -> tuple[Weights, list[float]]:
    """Adam over the windows of the texts (fine classes), the rate falling to a tenth; the weights and the losses."""
    steps = list(_steps(texts, coarse_of, rounds, seed))
    flat = np.concatenate([p.ravel() for p in w.parts()])
    parts, slope, a, b = w.over(flat), np.empty_like(flat), np.zeros_like(flat), np.zeros_like(flat)
    of_parts, change, size = w.over(slope).parts(), np.empty_like(flat), np.empty_like(flat)
    losses, memory = [], {}
    for step, batch in enumerate(steps, 1):
        slopes, loss = _slopes(parts, *batch, coarse_of, memory)
        losses.append(loss)
        for to, found in zip(of_parts, slopes, strict=True):
            to[:] = found
        # a: mean slope, b: mean square of the slope
        np.subtract(slope, a, out=change)
        change *= 0.1
        a += change
        np.multiply(slope, slope, out=change)
        change -= b
        change *= 0.01
        b += change
        np.divide(b, 1 - 0.99**step, out=size)
        np.sqrt(size, out=size)
        size += 1e-8
        np.divide(a, size, out=change)
        change *= rate * (1 - 0.9 * step / len(steps)) / (1 - 0.9**step)
        flat -= change
    return parts, losses
