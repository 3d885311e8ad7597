"""A character-level bidirectional LSTM with CRF transitions, in numpy."""

from __future__ import annotations

import numpy as np

KINDS = ("email", "ip", "card", "phone")
#: Tag 0 is outside; 1 + 2 * kind begins a span and 2 + 2 * kind goes on with it.
TAGS = 1 + 2 * len(KINDS)
CLASSES = 20


def char_classes(text: str) -> np.ndarray:
    """A class for each code point: letters by case, digits, each mark of the contract's patterns, others."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    found = np.full(len(codes), 17, np.int64)
    found[(codes >= 97) & (codes <= 122)] = 1
    found[(codes >= 65) & (codes <= 90)] = 2
    found[(codes >= 48) & (codes <= 57)] = 3
    found[codes > 127] = 18
    for i, mark in enumerate("@.-_%+() \n,:;"):
        found[codes == ord(mark)] = 4 + i
    return found  # 0 pads a window


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _logsum(x, axis):
    top = x.max(axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis, keepdims=True))).squeeze(axis)


class Tagger:
    def __init__(self, weights: dict[str, np.ndarray]):
        self.w = weights

    @classmethod
    def fresh(cls, hidden: int = 16, seed: int = 0) -> Tagger:
        rng = np.random.default_rng(seed)
        w = {}
        for way in ("f", "b"):
            w[f"x{way}"] = rng.normal(0, 0.3, (CLASSES, 4 * hidden))  # a class's embedding times the input weights
            w[f"h{way}"] = rng.normal(0, 1 / np.sqrt(hidden), (hidden, 4 * hidden))
            w[f"g{way}"] = np.repeat([0.0, 1.0, 0.0, 0.0], hidden)  # bias of input, forget, output and cell gates
        w["out"] = rng.normal(0, 1 / np.sqrt(2 * hidden), (2 * hidden, TAGS))
        w["bias"], w["trans"], w["start"] = np.zeros(TAGS), np.zeros((TAGS, TAGS)), np.zeros(TAGS)
        return cls(w)

    def _lstm(self, x: np.ndarray, way: str, keep: bool):
        """x: (time, batch) classes. Hidden states in the order of x, and what the way back needs."""
        steps, batch = x.shape
        hidden = self.w[f"h{way}"].shape[0]
        order = range(steps) if way == "f" else range(steps - 1, -1, -1)
        inputs = self.w[f"x{way}"][x] + self.w[f"g{way}"]
        h, c = np.zeros((batch, hidden)), np.zeros((batch, hidden))
        out, tape = np.empty((steps, batch, hidden)), []
        for t in order:
            z = inputs[t] + h @ self.w[f"h{way}"]
            gates = _sigmoid(z[:, :3 * hidden])
            i, f, o = gates[:, :hidden], gates[:, hidden:2 * hidden], gates[:, 2 * hidden:]
            g = np.tanh(z[:, 3 * hidden:])
            before = (h, c)
            c = f * c + i * g
            tc = np.tanh(c)
            h = o * tc
            out[t] = h
            if keep:
                tape.append((t, i, f, o, g, tc, *before))
        return out, tape

    def _scores(self, x: np.ndarray, keep: bool = False):
        forth, tape_f = self._lstm(x, "f", keep)
        back, tape_b = self._lstm(x, "b", keep)
        both = np.concatenate([forth, back], 2)
        return both @ self.w["out"] + self.w["bias"], both, tape_f, tape_b

    def decode(self, x: np.ndarray) -> np.ndarray:
        """Viterbi tags, (time, batch)."""
        scores = self._scores(x)[0]
        best, back = scores[0] + self.w["start"], []
        for t in range(1, len(x)):
            step = best[:, :, None] + self.w["trans"]
            back.append(step.argmax(1))
            best = step.max(1) + scores[t]
        tags = np.empty(x.shape, np.int64)
        tags[-1] = best.argmax(1)
        for t in range(len(x) - 1, 0, -1):
            tags[t - 1] = np.take_along_axis(back[t - 1], tags[t][:, None], 1)[:, 0]
        return tags

    def loss(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log likelihood of the tags y and its gradients."""
        steps, batch = x.shape
        scores, both, tape_f, tape_b = self._scores(x, True)
        trans, start = self.w["trans"], self.w["start"]
        ahead = [scores[0] + start]
        for t in range(1, steps):
            ahead.append(_logsum(ahead[-1][:, :, None] + trans, 1) + scores[t])
        total = _logsum(ahead[-1], 1)
        behind = [np.zeros((batch, TAGS))]
        for t in range(steps - 1, 0, -1):
            behind.append(_logsum(trans + (scores[t] + behind[-1])[:, None, :], 2))
        behind.reverse()
        lines = np.arange(batch)
        gold = start[y[0]] + scores[0][lines, y[0]]
        for t in range(1, steps):
            gold = gold + trans[y[t - 1], y[t]] + scores[t][lines, y[t]]
        grad = {k: np.zeros_like(v) for k, v in self.w.items()}
        d = np.exp(np.stack(ahead) + np.stack(behind) - total[None, :, None])
        grad["start"] = d[0].sum(0) - np.bincount(y[0], minlength=TAGS)
        for t in range(1, steps):
            pair = ahead[t - 1][:, :, None] + trans + (scores[t] + behind[t])[:, None, :] - total[:, None, None]
            grad["trans"] += np.exp(pair).sum(0)
            np.add.at(grad["trans"], (y[t - 1], y[t]), -1)
        d[np.arange(steps)[:, None], lines, y] -= 1
        grad["bias"], grad["out"] = d.sum((0, 1)), np.tensordot(both, d, ([0, 1], [0, 1]))
        inner = d @ self.w["out"].T
        hidden = inner.shape[2] // 2
        for way, tape, dh_out in (("f", tape_f, inner[:, :, :hidden]), ("b", tape_b, inner[:, :, hidden:])):
            dh, dc = np.zeros((batch, hidden)), np.zeros((batch, hidden))
            for t, i, f, o, g, tc, h0, c0 in reversed(tape):
                dh = dh + dh_out[t]
                dc = dc + dh * o * (1 - tc * tc)
                dz = np.concatenate([dc * g * i * (1 - i), dc * c0 * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)], 1)
                np.add.at(grad[f"x{way}"], x[t], dz)
                grad[f"g{way}"] += dz.sum(0)
                grad[f"h{way}"] += h0.T @ dz
                dh, dc = dz @ self.w[f"h{way}"].T, dc * f
        return float((total - gold).mean()), {k: v / batch for k, v in grad.items()}

    def fit(self, x: np.ndarray, y: np.ndarray, rounds: int = 250, batch: int = 64, rate: float = 0.03, seed: int = 0) -> Tagger:
        """Adam over random batches of (time, windows) classes and tags."""
        rng = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.w.items()}
        second = {k: np.zeros_like(v) for k, v in self.w.items()}
        for step in range(1, rounds + 1):
            own = rng.integers(0, x.shape[1], min(batch, x.shape[1]))
            _, grad = self.loss(x[:, own], y[:, own])
            size = np.sqrt(sum((g * g).sum() for g in grad.values()))
            for k, g in grad.items():
                g = g * min(1.0, 5.0 / (size + 1e-9))
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                self.w[k] = self.w[k] - rate * (1 - 0.9 * step / rounds) * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-8)
        return self


def spans_of(tags: np.ndarray) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the spans in one window's tags; a going-on tag without its beginning is outside."""
    found, kind, start = [], -1, 0
    for t, tag in enumerate([*tags.tolist(), 0]):
        goes_on = tag and tag % 2 == 0 and tag // 2 - 1 == kind
        if kind >= 0 and not goes_on:
            found.append((kind, start, t))
            kind = -1
        if tag % 2:
            kind, start = tag // 2, t
    return found


def tags_of(length: int, spans: list[tuple[int, int, int]]) -> np.ndarray:
    tags = np.zeros(length, np.int64)
    for kind, start, end in spans:
        tags[start:end] = 2 + 2 * kind
        tags[start] = 1 + 2 * kind
    return tags
