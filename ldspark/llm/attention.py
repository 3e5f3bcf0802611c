"""A small causal self-attention model in numpy: one layer, trained by hand-written gradients.

Texts are ids; position t is predicted from those before it. A text is cut into windows that overlap: a window
scores its last ``STRIDE`` positions and sees ``CONTEXT`` more before them, so each position is scored once.

The output has two levels. A first softmax is over the most frequent targets and one class for all others, class
0; only where that is the target, a second one is over the targets of that class.
"""

from __future__ import annotations

import numpy as np

CONTEXT, STRIDE = 8, 24
WINDOW = CONTEXT + STRIDE
WIDTH = 16
_SCALE = np.float32(1 / np.sqrt(WIDTH))
# Powers of two take half the time of powers of e; logits are scaled on the narrow side of the product they come from.
_LOG2_E = np.float32(1 / np.log(2))
_SHOWN = (np.arange(WINDOW)[None, :] <= np.arange(CONTEXT, WINDOW)[:, None]).astype(np.float32)
STEADY = 50
BLOCK = 288
_HIGHEST_QUOTIENT = np.float32(3.4e8)


def shapes(inputs: int, outputs: int, others: int) -> dict[str, tuple[int, ...]]:
    return {
        "embed": (inputs, WIDTH),
        "place": (WINDOW, WIDTH),
        "query": (WIDTH, WIDTH),
        "key_value": (WIDTH, 2 * WIDTH),
        "mixed": (WIDTH, WIDTH),
        "out": (WIDTH, outputs),
        "out_bias": (outputs,),
        "other": (WIDTH, others),
        "other_bias": (others,),
    }


def fresh(inputs: int, out_bias: np.ndarray, other_bias: np.ndarray, seed: int = 0) -> dict[str, np.ndarray]:
    """Seeded weights; the outputs start from the biases, so the untrained model is about the unigram one."""
    rng = np.random.default_rng(seed)
    made = {}
    for name, shape in shapes(inputs, len(out_bias), len(other_bias)).items():
        scale = 0.05 if name in ("out", "other") else 0.3 if name in ("embed", "place") else shape[0] ** -0.5
        made[name] = (rng.standard_normal(shape) * scale).astype(np.float32)
    made["out_bias"], made["other_bias"] = out_bias.astype(np.float32), other_bias.astype(np.float32)
    return made


def flatten(weights: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([w.ravel() for w in weights.values()])


def unflatten(flat: np.ndarray, inputs: int, outputs: int, others: int) -> dict[str, np.ndarray]:
    made, at = {}, 0
    for name, shape in shapes(inputs, outputs, others).items():
        n = int(np.prod(shape))
        made[name] = np.asarray(flat[at : at + n], np.float32).reshape(shape)
        at += n
    return made


def _states(w: dict[str, np.ndarray], x: np.ndarray):
    """The last layer at the last ``STRIDE`` positions of each window of inputs ``x``, and what gradients need."""
    n = len(x)
    h = w["embed"].take(x, axis=0).reshape(n, -1)
    h += w["place"].ravel()
    h = h.reshape(n, WINDOW, WIDTH)
    kv = (h.reshape(-1, WIDTH) @ w["key_value"]).reshape(n, WINDOW, 2 * WIDTH)
    k, v = kv[..., :WIDTH], kv[..., WIDTH:]
    late = np.ascontiguousarray(h[:, CONTEXT:]).reshape(-1, WIDTH)
    q = (late @ (w["query"] * (_SCALE * _LOG2_E))).reshape(n, STRIDE, WIDTH)
    keys = np.ascontiguousarray(k.transpose(0, 2, 1))
    a = np.matmul(q, keys)
    np.exp2(a, out=a)
    a *= _SHOWN
    sums = a.reshape(-1, WINDOW) @ np.ones(WINDOW, a.dtype)
    if not _in_range(sums):
        a = _from_highest(np.where(_SHOWN, np.matmul(q, keys), -np.inf))
        sums = a.sum(axis=-1)
    sums = sums.reshape(n, STRIDE, 1)
    o = np.matmul(a, v)
    o /= sums
    o = o.reshape(-1, WIDTH)
    return late + o @ w["mixed"], (h, k, v, late, q, a, sums, o)


def _from_highest(logits: np.ndarray) -> np.ndarray:
    """Two to the power of each logit, the highest taken off first. Needed only where the plain powers leave the range
    of floats, which trained weights hardly do."""
    return np.exp2(logits - logits.max(axis=-1, keepdims=True))


def _in_range(sums: np.ndarray) -> bool:
    """Whether all are finite and above 1e-30: of any other, the quotient or its product with the sum is not finite."""
    return bool(np.isfinite(sums @ (_HIGHEST_QUOTIENT / sums)))


def _softmax(z: np.ndarray, matrix: np.ndarray, bias: np.ndarray, targets: np.ndarray):
    """Per block of rows, which stays in a core's cache: the rows, each one's probability of its target, the powers of
    its logits and their sums, where its target is, and the rows with a one."""
    # With a column of ones the bias is part of the product.
    both = np.concatenate([matrix, bias[None, :]]) * _LOG2_E
    each = np.ones(matrix.shape[1], matrix.dtype)
    firsts = np.arange(0, BLOCK * matrix.shape[1], matrix.shape[1])
    for i in range(0, len(z), BLOCK):
        rows = slice(i, i + BLOCK)
        some = z[rows]
        ones = np.empty((len(some), WIDTH + 1), z.dtype)
        ones[:, :WIDTH] = some
        ones[:, WIDTH] = 1
        made = ones @ both
        np.exp2(made, out=made)
        sums = made @ each
        if not _in_range(sums):
            made = _from_highest(ones @ both)
            sums = made @ each
        at = firsts[: len(some)] + targets[rows]
        yield rows, made.take(at) / sums, made, sums, at, ones


def _log(probabilities: np.ndarray) -> np.ndarray:
    return np.log(np.maximum(probabilities, 1e-30, dtype=np.float64))


def _log_softmax(z: np.ndarray, matrix: np.ndarray, bias: np.ndarray, targets: np.ndarray) -> np.ndarray:
    return _log(np.concatenate([found for _, found, *_ in _softmax(z, matrix, bias, targets)]))


def log_probabilities(w: dict[str, np.ndarray], x: np.ndarray, y: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Natural log probability of the targets of every scored position: class ``y``, and ``second`` where that is 0."""
    with np.errstate(over="ignore", divide="ignore", invalid="ignore"):
        z, _ = _states(w, x)
        targets = y.ravel()
        found = _log_softmax(z, w["out"], w["out_bias"], targets)
        others = np.flatnonzero(targets == 0)
        if len(others):
            found[others] += _log_softmax(z.take(others, axis=0), w["other"], w["other_bias"], second.ravel()[others])
        return found


def gradients(
    w: dict[str, np.ndarray], x: np.ndarray, y: np.ndarray, second: np.ndarray, valid: np.ndarray
) -> tuple[dict[str, np.ndarray], float]:
    """Gradients of the mean loss over valid positions, and that loss."""
    with np.errstate(over="ignore", divide="ignore", invalid="ignore"):
        return _gradients(w, x, y, second, valid)


def _gradients(
    w: dict[str, np.ndarray], x: np.ndarray, y: np.ndarray, second: np.ndarray, valid: np.ndarray
) -> tuple[dict[str, np.ndarray], float]:
    n = len(x)
    z, (h, k, v, late, q, a, sums, o) = _states(w, x)
    a /= sums
    targets, live = y.ravel(), valid.ravel()
    count = max(1, int(live.sum()))

    def output(name: str, some: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, float]:
        matrix = w[name]
        into, found = np.empty_like(some), np.empty(len(some), z.dtype)
        total = np.zeros((WIDTH + 1, matrix.shape[1]), z.dtype)
        for rows, found[rows], made, sums, at, ones in _softmax(some, matrix, w[f"{name}_bias"], chosen):
            # The powers stay as they are: what they are divided by is taken to the narrow side of each product.
            made.ravel()[at] -= sums
            share = (1 / (sums * count))[:, None]
            np.multiply(made @ matrix.T, share, out=into[rows])
            ones *= share
            total += ones.T @ made
        g[name], g[f"{name}_bias"] = total[:WIDTH], total[WIDTH]
        return into, -float(_log(found).sum())

    g: dict[str, np.ndarray] = {}
    dz = np.zeros_like(z)
    first = np.flatnonzero(live)
    dz[first], loss = output("out", z.take(first, axis=0), targets[first])
    others = np.flatnonzero(live & (targets == 0))
    more, second_loss = output("other", z.take(others, axis=0), second.ravel()[others])
    dz[others] += more
    g["mixed"] = o.T @ dz
    do = (dz @ w["mixed"].T).reshape(n, STRIDE, WIDTH)
    dkv = np.empty((n, WINDOW, 2 * WIDTH), z.dtype)
    np.matmul(a.transpose(0, 2, 1), do, out=dkv[..., WIDTH:])
    ds = np.matmul(do, v.transpose(0, 2, 1))
    # The mean of da under a row of a is the product of that row's output and its gradient.
    ds -= ((do.reshape(-1, WIDTH) * o) @ np.ones(WIDTH, z.dtype)).reshape(n, STRIDE, 1)
    ds *= a
    dq = np.matmul(ds, k).reshape(-1, WIDTH)
    # The queries hold the scale of powers of two, their gradients that of powers of e.
    q /= _LOG2_E
    np.matmul(ds.transpose(0, 2, 1), q, out=dkv[..., :WIDTH])
    dkv = dkv.reshape(-1, 2 * WIDTH)
    g["query"] = late.T @ dq * _SCALE
    dlate = dz + dq @ (w["query"].T * _SCALE)
    g["key_value"] = h.reshape(-1, WIDTH).T @ dkv
    dh = (dkv @ w["key_value"].T).reshape(n, WINDOW, WIDTH)
    dh[:, CONTEXT:] += dlate.reshape(n, STRIDE, WIDTH)
    g["place"] = dh.sum(axis=0)
    g["embed"] = np.zeros_like(w["embed"])
    np.add.at(g["embed"].ravel(), (x.reshape(-1, 1) * WIDTH + np.arange(WIDTH, dtype=x.dtype)).ravel(), dh.ravel())
    return g, (loss + second_loss) / count


class Adam:
    """Adam with clipped gradients and a rate that falls with the root of the steps after the first ``STEADY``."""

    def __init__(self, weights: dict[str, np.ndarray], rate: float):
        self.rate, self.steps = rate, 0
        # One array for all weights; their names are views of it.
        self.flat = flatten(weights)
        self.weights, at = {}, 0
        for name, w in weights.items():
            self.weights[name] = self.flat[at : at + w.size].reshape(w.shape)
            at += w.size
        self.first, self.second = np.zeros_like(self.flat), np.zeros_like(self.flat)

    def step(self, gradient: dict[str, np.ndarray]) -> None:
        self.steps += 1
        g = np.concatenate([gradient[name].ravel() for name in self.weights])
        norm = float(np.sqrt(g @ g))
        g *= np.float32(min(1.0, 1.0 / (norm + 1e-9)))
        rate = self.rate * min(1.0, (STEADY / self.steps) ** 0.5) * (1 - 0.99**self.steps) ** 0.5 / (1 - 0.9**self.steps)
        self.first *= 0.9
        self.first += 0.1 * g
        g *= g
        g *= 0.01
        self.second *= 0.99
        self.second += g
        np.sqrt(self.second, out=g)
        g += 1e-8
        np.divide(self.first, g, out=g)
        g *= rate
        self.flat -= g


def windows(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions (in the concatenation of texts of these lengths) of every window, and which of them are in the
    window's own text. Every position is in the last ``STRIDE`` places of exactly one window."""
    per_text = -(-lengths // STRIDE)
    starts = np.cumsum(lengths) - lengths
    text = np.repeat(np.arange(len(lengths)), per_text)
    nth = np.arange(per_text.sum()) - np.repeat(np.cumsum(per_text) - per_text, per_text)
    within = (nth * STRIDE - CONTEXT)[:, None] + np.arange(WINDOW)
    inside = (within >= 0) & (within < lengths[text][:, None])
    return np.where(inside, within + starts[text][:, None], 0), inside
