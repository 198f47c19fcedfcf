"""A gated recurrent language model in numpy with a class-factored softmax.

The vocabulary holds the most frequent words and, for all others, ``TYPES`` rest tokens by word
ending; a rest token is followed by the word's smoothed share among the words of its type. A
token's probability is that of its class times that within the class, both from the state of
gated recurrent units that have read the document so far.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

HIDDEN = 16
CLASSES = 32
SIZE = CLASSES * CLASSES
TYPES = 64
WINDOW = 16
STREAMS = 256
RATE = 0.01


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


def log_share(states: np.ndarray, weights: np.ndarray, bias: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Logarithm of the softmax at ``target``. States are within -1 and 1, which bounds the
    exponents; only weights that could overflow need the usual shift."""
    x = states @ weights + bias
    if float(np.abs(weights).sum(axis=0).max() + np.abs(bias).max()) > 80:
        x -= x.max(axis=1, keepdims=True)
    picked = x[np.arange(len(x)), target]
    return picked - np.log(np.exp(x, out=x).sum(axis=1))


def softmax(x: np.ndarray) -> np.ndarray:
    x -= x.max(axis=1, keepdims=True)
    np.exp(x, out=x)
    x /= x.sum(axis=1, keepdims=True)
    return x


def sums_by(keys: np.ndarray, rows: np.ndarray, size: int) -> np.ndarray:
    """Sum of the rows of each key below ``size``."""
    order = np.argsort(keys, kind="stable")
    own = keys[order]
    starts = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
    out = np.zeros((size, rows.shape[1]), rows.dtype)
    out[own[starts]] = np.add.reduceat(rows[order], starts, axis=0)
    return out


@dataclass
class Network:
    """``inputs``: what a token adds to the three gates; ``turn``: what the state adds."""

    inputs: np.ndarray
    turn: np.ndarray
    classes: np.ndarray
    class_bias: np.ndarray
    words: np.ndarray
    word_bias: np.ndarray

    @classmethod
    def start(cls, counts: np.ndarray) -> Network:
        """Small random weights; biases that give the tokens their shares in the corpus."""
        draw = np.random.default_rng(3)
        table = np.maximum(counts.astype(float), 0.5).reshape(CLASSES, CLASSES)
        by_class = table.sum(axis=1)
        small = lambda *shape: draw.normal(0, 0.1, shape).astype(np.float32)
        return cls(
            small(SIZE, 3 * HIDDEN),
            small(HIDDEN, 3 * HIDDEN),
            small(HIDDEN, CLASSES),
            np.log(by_class / by_class.sum()).astype(np.float32),
            small(CLASSES, HIDDEN, CLASSES),
            np.log(table / by_class[:, None]).astype(np.float32),
        )

    def parts(self) -> list[np.ndarray]:
        return [self.inputs, self.turn, self.classes, self.class_bias, self.words, self.word_bias]

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parts()])

    def filled(self, flat: np.ndarray) -> Network:
        out, at = [], 0
        for p in self.parts():
            out.append(flat[at : at + p.size].reshape(p.shape).astype(np.float32))
            at += p.size
        return Network(*out)

    def step(self, token: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, ...]:
        x, g = self.inputs[token], state @ self.turn
        gates = sigmoid(x[:, : 2 * HIDDEN] + g[:, : 2 * HIDDEN])
        r, z = gates[:, :HIDDEN], gates[:, HIDDEN:]
        n = np.tanh(x[:, 2 * HIDDEN :] + r * g[:, 2 * HIDDEN :])
        return n + z * (state - n), r, z, n, g[:, 2 * HIDDEN :]

    def log_probabilities(self, states: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Natural logarithms of the targets' probabilities."""
        kind, place = target // CLASSES, target % CLASSES
        out = log_share(states, self.classes, self.class_bias, kind)
        order = np.argsort(kind, kind="stable")
        ends = np.cumsum(np.bincount(kind, minlength=CLASSES))
        for c, (a, b) in enumerate(zip([0, *ends[:-1]], ends)):
            if b > a:
                at = order[a:b]
                out[at] += log_share(states[at], self.words[c], self.word_bias[c], place[at])
        return out

    def gradients(self, previous: np.ndarray, target: np.ndarray, fresh: np.ndarray, state: np.ndarray):
        """Gradients of one window (steps x streams), truncated at its start, and the last state.

        ``fresh`` marks steps at which a document begins and the state is zero.
        """
        steps, streams = previous.shape
        h = np.empty((steps + 1, streams, HIDDEN), dtype=np.float32)
        before = np.empty((steps, streams, HIDDEN), dtype=np.float32)
        saved = []
        h[0] = state
        for t in range(steps):
            before[t] = h[t] * ~fresh[t][:, None]
            h[t + 1], *rest = self.step(previous[t], before[t])
            saved.append(rest)
        states, flat = h[1:].reshape(-1, HIDDEN), target.ravel()
        kind, place = flat // CLASSES, flat % CLASSES
        share = np.float32(1 / len(flat))
        d_class = softmax(states @ self.classes + self.class_bias)
        d_class[np.arange(len(flat)), kind] -= 1
        d_class *= share
        d_states = d_class @ self.classes.T
        d_words, d_word_bias = np.zeros_like(self.words), np.zeros_like(self.word_bias)
        order = np.argsort(kind, kind="stable")
        ends = np.cumsum(np.bincount(kind, minlength=CLASSES))
        for c, (a, b) in enumerate(zip([0, *ends[:-1]], ends)):
            if b > a:
                at = order[a:b]
                d = softmax(states[at] @ self.words[c] + self.word_bias[c])
                d[np.arange(b - a), place[at]] -= 1
                d *= share
                d_words[c], d_word_bias[c] = states[at].T @ d, d.sum(axis=0)
                d_states[at] += d @ self.words[c].T
        d_states = d_states.reshape(steps, streams, HIDDEN)
        d_gates = np.empty((steps, streams, 3 * HIDDEN), dtype=np.float32)
        d_turn = np.zeros_like(self.turn)
        carry = np.zeros((streams, HIDDEN), dtype=np.float32)
        for t in reversed(range(steps)):
            r, z, n, g = saved[t]
            d = d_states[t] + carry
            dn = d * (1 - z) * (1 - n * n)
            d_gates[t, :, :HIDDEN] = dn * g * r * (1 - r)
            d_gates[t, :, HIDDEN : 2 * HIDDEN] = d * (before[t] - n) * z * (1 - z)
            d_gates[t, :, 2 * HIDDEN :] = dn
            d_g = d_gates[t].copy()
            d_g[:, 2 * HIDDEN :] *= r
            d_turn += before[t].T @ d_g
            carry = (d * z + d_g @ self.turn.T) * ~fresh[t][:, None]
        d_inputs = sums_by(previous.ravel(), d_gates.reshape(-1, 3 * HIDDEN), SIZE)
        grads = [d_inputs, d_turn, states.T @ d_class, d_class.sum(axis=0), d_words, d_word_bias]
        return grads, h[-1]


def train(network: Network, tokens: np.ndarray, end: int) -> Network:
    """One pass over ``tokens``, documents that each close with ``end``, in parallel streams.

    Truncated backpropagation: gradients stay within a window, states go on to the next. The
    last stream is filled up from the first tokens.
    """
    if len(tokens) < 2:
        return network
    streams = int(min(STREAMS, max(4, len(tokens) // (WINDOW * 64))))
    length = -(-(len(tokens) - 1) // streams)
    source = np.concatenate([tokens[:1], np.resize(tokens[1:], streams * length)])
    previous, target = source[:-1].reshape(streams, length).T, source[1:].reshape(streams, length).T
    parts = network.filled(network.flat()).parts()
    first = [np.zeros_like(p) for p in parts]
    second = [np.zeros_like(p) for p in parts]
    state = np.zeros((streams, HIDDEN), dtype=np.float32)
    for k, t in enumerate(range(0, length, WINDOW), 1):
        model = Network(*parts)
        before = previous[t : t + WINDOW]
        grads, state = model.gradients(before, target[t : t + WINDOW], before == end, state)
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
        clip = min(1.0, 1.0 / (norm + 1e-9))
        for p, g, m, v in zip(parts, grads, first, second):
            g *= clip
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= RATE * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-6)
    return Network(*parts)


def score(network: Network, tokens: np.ndarray, bounds: np.ndarray, end: int) -> np.ndarray:
    """Natural log-likelihood of each document ``tokens[bounds[i]:bounds[i + 1]]``.

    Documents run side by side, longest first; the state goes through a whole document, window
    after window, while the output layer works on many states at once.
    """
    sizes = np.diff(bounds)
    order = np.argsort(-sizes, kind="stable")
    begins, sizes = bounds[:-1][order], sizes[order]
    total = np.zeros(len(order))
    state = np.zeros((len(order), HIDDEN), dtype=np.float32)
    previous = np.full(len(order), end, dtype=np.int64)
    held: list[tuple[np.ndarray, np.ndarray, int]] = []
    waiting = 0

    def settle() -> None:
        if held:
            states, targets, numbers = zip(*held)
            logs = network.log_probabilities(np.concatenate(states), np.concatenate(targets))
            at = np.concatenate([np.arange(n) for n in numbers])
            total[: numbers[0]] += np.bincount(at, logs, numbers[0])

    active = np.searchsorted(-sizes, -np.arange(sizes[0] if len(sizes) else 0), side="left")
    for t, n in enumerate(active.tolist()):
        state = network.step(previous[:n], state[:n])[0]
        previous = tokens[begins[:n] + t].astype(np.int64)
        held.append((state, previous, n))
        waiting += n
        if waiting > 100_000:
            settle()
            held, waiting = [], 0
    settle()
    out = np.zeros(len(order))
    out[order] = total
    return out
