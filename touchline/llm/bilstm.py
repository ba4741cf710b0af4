"""A character-level bidirectional LSTM with CRF transitions, in numpy.

Windows are matrices of character codes (batch x time). Tags are numbered; all arithmetic is batched
over windows, and the same weights always come from the same windows.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

CODES = 128
EMBEDDED = 12
HIDDEN = 20


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def _lstm(x: np.ndarray, w: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, list]:
    """Outputs (time x batch x hidden) and what the way back needs."""
    h = np.zeros((x.shape[1], HIDDEN))
    c = np.zeros_like(h)
    out, memory = [], []
    for step in x:
        joined = np.concatenate([step, h], axis=1)
        gates = joined @ w + b
        i, f, o = (_sigmoid(gates[:, k * HIDDEN:(k + 1) * HIDDEN]) for k in range(3))
        g = np.tanh(gates[:, 3 * HIDDEN:])
        before = c
        c = f * before + i * g
        t = np.tanh(c)
        h = o * t
        out.append(h)
        memory.append((joined, i, f, o, g, before, t))
    return np.stack(out), memory


def _lstm_back(d_out: np.ndarray, memory: list, w: np.ndarray):
    """Gradients with respect to the inputs, the weights and the bias."""
    d_w, d_b = np.zeros_like(w), np.zeros(w.shape[1])
    size = memory[0][0].shape[1] - HIDDEN
    d_x = np.zeros((len(memory), d_out.shape[1], size))
    d_h = np.zeros(d_out.shape[1:])
    d_c = np.zeros_like(d_h)
    for t in range(len(memory) - 1, -1, -1):
        joined, i, f, o, g, before, tanh_c = memory[t]
        d_h = d_h + d_out[t]
        d_c = d_c + d_h * o * (1 - tanh_c ** 2)
        gates = np.concatenate([d_c * g * i * (1 - i), d_c * before * f * (1 - f),
                                d_h * tanh_c * o * (1 - o), d_c * i * (1 - g ** 2)], axis=1)
        d_w += joined.T @ gates
        d_b += gates.sum(axis=0)
        d_joined = gates @ w.T
        d_x[t], d_h = d_joined[:, :size], d_joined[:, size:]
        d_c = d_c * f
    return d_x, d_w, d_b


@dataclass
class Tagger:
    """Weights by name; ``tags`` is the number of tags."""

    tags: int
    weights: dict[str, np.ndarray] = field(default_factory=dict)

    def start(self, seed: int) -> None:
        random = np.random.default_rng(seed)

        def some(*shape: int) -> np.ndarray:
            return random.normal(0, 1 / np.sqrt(shape[0]), shape)

        self.weights = {"embed": some(CODES, EMBEDDED)}
        for way in ("ahead", "back"):
            self.weights[f"w_{way}"] = some(EMBEDDED + HIDDEN, 4 * HIDDEN)
            bias = np.zeros(4 * HIDDEN)
            bias[HIDDEN:2 * HIDDEN] = 1
            self.weights[f"b_{way}"] = bias
        self.weights |= {"out": some(2 * HIDDEN, self.tags), "bias": np.zeros(self.tags),
                         "step": np.zeros((self.tags, self.tags)), "begin": np.zeros(self.tags)}

    def _emissions(self, codes: np.ndarray):
        w = self.weights
        x = w["embed"][codes.T]
        ahead, m1 = _lstm(x, w["w_ahead"], w["b_ahead"])
        back, m2 = _lstm(x[::-1], w["w_back"], w["b_back"])
        h = np.concatenate([ahead, back[::-1]], axis=2)
        return h @ w["out"] + w["bias"], h, m1, m2

    def _passes(self, emissions: np.ndarray):
        """Forward and backward sums of the CRF and the logarithm of the whole."""
        step = self.weights["step"]
        forward = [emissions[0] + self.weights["begin"]]
        for e in emissions[1:]:
            forward.append(_log_sum(forward[-1][:, :, None] + step, 1) + e)
        backward = [np.zeros_like(forward[0])]
        for e in emissions[:0:-1]:
            backward.append(_log_sum(step + (e + backward[-1])[:, None, :], 2))
        return np.stack(forward), np.stack(backward[::-1]), _log_sum(forward[-1], 1)

    def marginals(self, codes: np.ndarray) -> np.ndarray:
        """Probability of each tag at each character (batch x time x tags)."""
        forward, backward, whole = self._passes(self._emissions(codes)[0])
        return np.exp(forward + backward - whole[None, :, None]).transpose(1, 0, 2)

    def gradients(self, codes: np.ndarray, tags: np.ndarray) -> tuple[float, dict]:
        """Mean negative log-likelihood of the tags, and its gradients."""
        w, count = self.weights, len(codes)
        emissions, h, m1, m2 = self._emissions(codes)
        forward, backward, whole = self._passes(emissions)
        y, rows = tags.T, np.arange(count)
        score = (w["begin"][y[0]] + w["step"][y[:-1], y[1:]].sum(axis=0)
                 + np.take_along_axis(emissions, y[:, :, None], 2)[:, :, 0].sum(axis=0))
        d_e = np.exp(forward + backward - whole[None, :, None])
        d_begin = d_e[0].sum(axis=0)
        d_step = np.zeros_like(w["step"])
        for t in range(1, len(y)):
            pair = (forward[t - 1][:, :, None] + w["step"]
                    + (emissions[t] + backward[t])[:, None, :] - whole[:, None, None])
            d_step += np.exp(pair).sum(axis=0)
        np.add.at(d_step, (y[:-1].ravel(), y[1:].ravel()), -1)
        np.add.at(d_begin, y[0], -1)
        for t in range(len(y)):
            d_e[t, rows, y[t]] -= 1
        d_h = d_e @ w["out"].T
        x1, w1, b1 = _lstm_back(d_h[:, :, :HIDDEN], m1, w["w_ahead"])
        x2, w2, b2 = _lstm_back(d_h[::-1, :, HIDDEN:], m2, w["w_back"])
        d_embed = np.zeros_like(w["embed"])
        np.add.at(d_embed, codes.T, x1 + x2[::-1])
        found = {"embed": d_embed, "w_ahead": w1, "b_ahead": b1, "w_back": w2, "b_back": b2,
                 "out": np.einsum("tbh,tbk->hk", h, d_e), "bias": d_e.sum(axis=(0, 1)),
                 "step": d_step, "begin": d_begin}
        return float((whole - score).mean()), {k: v / count for k, v in found.items()}

    def train(self, codes: np.ndarray, tags: np.ndarray, epochs: int, seed: int = 7,
              batch: int = 64, rate: float = 0.01) -> list[float]:
        """Adam over shuffled batches; the mean loss of each epoch."""
        self.start(seed)
        random = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.weights.items()}
        second = {k: np.zeros_like(v) for k, v in self.weights.items()}
        losses, done = [], 0
        for _ in range(epochs):
            order, total = random.permutation(len(codes)), 0.0
            for at in range(0, len(order), batch):
                chosen = order[at:at + batch]
                loss, found = self.gradients(codes[chosen], tags[chosen])
                total += loss * len(chosen)
                done += 1
                norm = np.sqrt(sum(float((g ** 2).sum()) for g in found.values()))
                for k, g in found.items():
                    g = g * min(1.0, 5.0 / max(norm, 1e-9))
                    first[k] += 0.1 * (g - first[k])
                    second[k] += 0.001 * (g ** 2 - second[k])
                    unbiased = first[k] / (1 - 0.9 ** done)
                    self.weights[k] -= rate * unbiased / (
                        np.sqrt(second[k] / (1 - 0.999 ** done)) + 1e-8)
            losses.append(total / len(order))
        return losses
