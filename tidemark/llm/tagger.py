"""A character tagger in numpy: bidirectional LSTM with a linear-chain CRF on top, trained by gradient descent."""

from __future__ import annotations

import numpy as np

EMBED, HIDDEN = 10, 20
_LARGEST = 1e4

#: Characters that the network tells apart; white space, other letters and the rest have one code each, 0 is padding.
_PRINTED = "".join(map(chr, range(33, 127)))
SPACE, LETTER, OTHER = len(_PRINTED) + 1, len(_PRINTED) + 2, len(_PRINTED) + 3
SYMBOLS = len(_PRINTED) + 4
_CODES = {c: i + 1 for i, c in enumerate(_PRINTED)}


def codes(text: str) -> list[int]:
    return [_CODES.get(c) or (SPACE if c.isspace() else LETTER if c.isalpha() else OTHER) for c in text]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


def _logsumexp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


class Tagger:
    """Tags are 0 (outside) and for kind k 2k + 1 (begins) and 2k + 2 (goes on)."""

    def __init__(self, kinds: int, seed: int = 5):
        self.tags = 2 * kinds + 1
        rng = np.random.default_rng(seed)

        def normal(*shape):
            return (rng.standard_normal(shape) / np.sqrt(shape[-2])).astype(np.float32)

        self.p = {
            "embed": normal(SYMBOLS, EMBED) * np.sqrt(np.float32(SYMBOLS / EMBED)),
            "wx": normal(2, EMBED, 4 * HIDDEN),
            "wh": normal(2, HIDDEN, 4 * HIDDEN),
            "b": np.zeros((2, 1, 4 * HIDDEN), np.float32),
            "wo": normal(2 * HIDDEN, self.tags),
            "bo": np.zeros(self.tags, np.float32),
            "step": np.zeros((self.tags, self.tags), np.float32),
            "begin": np.zeros(self.tags, np.float32),
        }
        self.p["b"][:, :, HIDDEN : 2 * HIDDEN] = 1
        self.barred = np.zeros((self.tags, self.tags), np.float32)
        self.barred_begin = np.zeros(self.tags, np.float32)
        for goes_on in range(2, self.tags, 2):
            self.barred[:, goes_on] = -_LARGEST
            self.barred[[goes_on - 1, goes_on], goes_on] = 0

    def _emissions(self, x: np.ndarray, keep: bool = False):
        """Scores (window, position, tag) of windows of codes; with `keep` also what the gradient needs."""
        p, (n, length) = self.p, x.shape
        embedded = p["embed"][x]
        both = np.stack([embedded, embedded[:, ::-1]]).transpose(2, 0, 1, 3)
        inputs = both @ p["wx"] + p["b"]
        h, c = np.zeros((2, n, HIDDEN), np.float32), np.zeros((2, n, HIDDEN), np.float32)
        states = np.empty((length, 2, n, HIDDEN), np.float32)
        kept = []
        for t in range(length):
            z = inputs[t] + h @ p["wh"]
            gates, g = _sigmoid(z[..., : 3 * HIDDEN]), np.tanh(z[..., 3 * HIDDEN :])
            i, f, o = gates[..., :HIDDEN], gates[..., HIDDEN : 2 * HIDDEN], gates[..., 2 * HIDDEN :]
            if keep:
                kept.append((h, c, i, f, o, g))
            c = f * c + i * g
            h = o * np.tanh(c)
            states[t] = h
        joined = np.concatenate([states[:, 0], states[::-1, 1]], axis=-1).transpose(1, 0, 2)
        scores = joined @ p["wo"] + p["bo"]
        return (scores, both, kept, joined) if keep else scores

    def loss_and_gradient(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict]:
        """Mean negative log-likelihood of the tag sequences y, and its gradient."""
        p, (n, length) = self.p, x.shape
        scores, both, kept, joined = self._emissions(x, keep=True)
        step, begin = p["step"] + self.barred, p["begin"] + self.barred_begin
        ahead = np.empty((length, n, self.tags), np.float32)
        ahead[0] = begin + scores[:, 0]
        for t in range(1, length):
            ahead[t] = _logsumexp(ahead[t - 1][:, :, None] + step, 1) + scores[:, t]
        back = np.zeros_like(ahead)
        for t in range(length - 2, -1, -1):
            back[t] = _logsumexp(step + (scores[:, t + 1] + back[t + 1])[:, None, :], 2)
        whole = _logsumexp(ahead[-1], 1)
        likely = np.exp(ahead + back - whole[:, None]).transpose(1, 0, 2)
        pairs = np.zeros_like(step)
        for t in range(1, length):
            pairs += np.exp(ahead[t - 1][:, :, None] + step + (scores[:, t] + back[t] - whole[:, None])[:, None, :]).sum(0)
        line, at = np.arange(n)[:, None], np.arange(length)
        gold = scores[line, at, y].sum() + step[y[:, :-1], y[:, 1:]].sum() + begin[y[:, 0]].sum()
        loss = float(whole.sum() - gold) / n
        grad = {k: np.zeros_like(v) for k, v in p.items()}
        np.add.at(pairs, (y[:, :-1], y[:, 1:]), -1)
        grad["step"] = pairs / n
        np.add.at(likely, (line, at, y), -1)
        likely /= n
        grad["begin"] = likely[:, 0].sum(0)
        grad["wo"] = joined.reshape(-1, 2 * HIDDEN).T @ likely.reshape(-1, self.tags)
        grad["bo"] = likely.sum((0, 1))
        above = (likely @ p["wo"].T).transpose(1, 0, 2)
        d_states = np.stack([above[..., :HIDDEN], above[::-1, :, HIDDEN:]], axis=1)
        dz = np.empty((length, 2, n, 4 * HIDDEN), np.float32)
        dh, dc = np.zeros((2, n, HIDDEN), np.float32), np.zeros((2, n, HIDDEN), np.float32)
        turned = p["wh"].transpose(0, 2, 1)
        for t in range(length - 1, -1, -1):
            h, c, i, f, o, g = kept[t]
            dh = dh + d_states[t]
            bent = np.tanh(f * c + i * g)
            dc = dc + dh * o * (1 - bent**2)
            dz[t] = np.concatenate([dc * g * i * (1 - i), dc * c * f * (1 - f), dh * bent * o * (1 - o), dc * i * (1 - g**2)], -1)
            grad["wh"] += h.transpose(0, 2, 1) @ dz[t]
            dh, dc = dz[t] @ turned, dc * f
        for way in (0, 1):
            flat = dz[:, way].reshape(-1, 4 * HIDDEN)
            grad["wx"][way] = both[:, way].reshape(-1, EMBED).T @ flat
            grad["b"][way] = flat.sum(0)
        embedded = (dz @ p["wx"].transpose(0, 2, 1)).transpose(1, 2, 0, 3)
        np.add.at(grad["embed"], x, embedded[0] + embedded[1][:, ::-1])
        return loss, grad

    def train(self, x: np.ndarray, y: np.ndarray, epochs: int, batch: int = 32, rate: float = 0.01, seed: int = 7) -> list[float]:
        """Adam with gradients clipped to norm 5; mean loss of each epoch."""
        rng = np.random.default_rng(seed)
        mean = {k: np.zeros_like(v) for k, v in self.p.items()}
        square = {k: np.zeros_like(v) for k, v in self.p.items()}
        losses, turn = [], 0
        for epoch in range(epochs):
            order, total = rng.permutation(len(x)), 0.0
            for a in range(0, len(x), batch):
                turn += 1
                some = order[a : a + batch]
                loss, grad = self.loss_and_gradient(x[some], y[some])
                total += loss * len(some)
                norm = np.sqrt(sum(float((g**2).sum()) for g in grad.values()))
                scale = min(1.0, 5.0 / max(norm, 1e-9))
                now = rate * (1 - 0.9 * epoch / max(1, epochs))
                for k, g in grad.items():
                    g = g * scale
                    mean[k] += 0.1 * (g - mean[k])
                    square[k] += 0.01 * (g**2 - square[k])
                    self.p[k] -= (now * (mean[k] / (1 - 0.9**turn)) / (np.sqrt(square[k] / (1 - 0.99**turn)) + 1e-8)).astype(np.float32)
            losses.append(total / max(1, len(x)))
        return losses

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best tags of each window (Viterbi) and each window's emission scores."""
        scores = self._emissions(x)
        return self.best(scores), scores

    def emissions(self, x: np.ndarray) -> np.ndarray:
        return self._emissions(x)

    def best(self, scores: np.ndarray) -> np.ndarray:
        """Best tags for emission scores (row, position, tag) by Viterbi."""
        n, length = scores.shape[:2]
        step = self.p["step"] + self.barred
        best = self.p["begin"] + self.barred_begin + scores[:, 0]
        came = np.empty((length, n, self.tags), np.int8)
        for t in range(1, length):
            options = best[:, :, None] + step
            came[t] = options.argmax(1)
            best = options.max(1) + scores[:, t]
        tags = np.empty((n, length), np.int8)
        tags[:, -1] = best.argmax(1)
        line = np.arange(n)
        for t in range(length - 1, 0, -1):
            tags[:, t - 1] = came[t][line, tags[:, t]]
        return tags
