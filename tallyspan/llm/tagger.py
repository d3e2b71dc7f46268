"""A character-level bidirectional LSTM with a CRF on top, in numpy: training and decoding."""

from __future__ import annotations

import numpy as np

EMBEDDING = 12
HIDDEN = 16
ALPHABET = 131  # ASCII, other letters, other characters, padding
OTHER_LETTER, OTHER, PAD = 128, 129, 130


def codes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    return np.where(points < 128, points, np.where((points >= 0xC0) & (points < 0x2000), OTHER_LETTER, OTHER))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    most = x.max(axis=axis, keepdims=True)
    return (np.log(np.exp(x - most).sum(axis=axis, keepdims=True)) + most).squeeze(axis)


class Tagger:
    """Parameters by name; every method takes and gives whole batches."""

    def __init__(self, tags: int, seed: int = 5, dtype=np.float32):
        rng = np.random.default_rng(seed)

        def normal(*shape: int) -> np.ndarray:
            return (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(dtype)

        self.tags = tags
        self.p: dict[str, np.ndarray] = {"embedding": normal(ALPHABET, EMBEDDING)}
        for side in ("f", "b"):
            self.p |= {
                f"x_{side}": normal(EMBEDDING, 4 * HIDDEN),
                f"h_{side}": normal(HIDDEN, 4 * HIDDEN),
                f"c_{side}": np.repeat(np.array([0, 1, 0, 0], dtype), HIDDEN),  # forget gates start open
            }
        self.p |= {"out": normal(2 * HIDDEN, tags), "bias": np.zeros(tags, dtype)}
        self.p |= {"start": np.zeros(tags, dtype), "move": np.zeros((tags, tags), dtype)}

    # --- LSTM: gates in the order input, forget, output, candidate --------------------

    def _run(self, side: str, x: np.ndarray, live: np.ndarray, keep: bool) -> tuple[np.ndarray, list]:
        """States [text, time, hidden] of one direction; a padded place hands on the state."""
        rows, times = live.shape
        gates_x = x @ self.p[f"x_{side}"] + self.p[f"c_{side}"]
        h = np.zeros((rows, HIDDEN), x.dtype)
        c = np.zeros_like(h)
        out, tape = np.empty((rows, times, HIDDEN), x.dtype), []
        for t in range(times) if side == "f" else range(times - 1, -1, -1):
            z = gates_x[:, t] + h @ self.p[f"h_{side}"]
            gate = _sigmoid(z[:, : 3 * HIDDEN])
            i, f, o = gate[:, :HIDDEN], gate[:, HIDDEN : 2 * HIDDEN], gate[:, 2 * HIDDEN :]
            g = np.tanh(z[:, 3 * HIDDEN :])
            m = live[:, t, None]
            cell = f * c + i * g
            tanh = np.tanh(cell)
            if keep:
                tape.append((t, h, c, i, f, o, g, tanh, m))
            h, c = m * (o * tanh) + (1 - m) * h, m * cell + (1 - m) * c
            out[:, t] = h
        return out, tape

    def _back(self, side: str, x: np.ndarray, tape: list, d_out: np.ndarray, grad: dict) -> np.ndarray:
        d_gates = np.zeros((*x.shape[:2], 4 * HIDDEN), x.dtype)
        dh = np.zeros((x.shape[0], HIDDEN), x.dtype)
        dc = np.zeros_like(dh)
        for t, h, c, i, f, o, g, tanh, m in reversed(tape):
            dh = dh + d_out[:, t]
            d_cell = m * (dc + dh * o * (1 - tanh * tanh))
            dz = np.concatenate(
                [
                    d_cell * g * i * (1 - i),
                    d_cell * c * f * (1 - f),
                    m * dh * tanh * o * (1 - o),
                    d_cell * i * (1 - g * g),
                ],
                axis=1,
            )
            d_gates[:, t] = dz
            grad[f"h_{side}"] += h.T @ dz
            dh, dc = (1 - m) * dh + dz @ self.p[f"h_{side}"].T, (1 - m) * dc + d_cell * f
        flat = d_gates.reshape(-1, 4 * HIDDEN)
        grad[f"x_{side}"] += x.reshape(-1, EMBEDDING).T @ flat
        grad[f"c_{side}"] += flat.sum(axis=0)
        return d_gates @ self.p[f"x_{side}"].T

    def emissions(self, symbols: np.ndarray) -> np.ndarray:
        """[text, time, tag] for [text, time] symbols, ``PAD`` behind the end of a text."""
        live = (symbols != PAD).astype(self.p["out"].dtype)
        x = self.p["embedding"][symbols]
        both = np.concatenate([self._run(s, x, live, False)[0] for s in ("f", "b")], axis=2)
        return both @ self.p["out"] + self.p["bias"]

    # --- training ---------------------------------------------------------------------

    def loss(self, symbols: np.ndarray, tags: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log-likelihood of the tag sequences, and its gradient."""
        rows, times = symbols.shape
        p, dtype = self.p, self.p["out"].dtype
        live = (symbols != PAD).astype(dtype)
        x = p["embedding"][symbols]
        (ahead, tape_f), (behind, tape_b) = self._run("f", x, live, True), self._run("b", x, live, True)
        both = np.concatenate([ahead, behind], axis=2)
        e = both @ p["out"] + p["bias"]
        # Forward and backward sums of the CRF.
        alpha, beta = np.zeros_like(e), np.zeros_like(e)
        alpha[:, 0] = p["start"] + e[:, 0]
        for t in range(1, times):
            step = _lse(alpha[:, t - 1, :, None] + p["move"], 1) + e[:, t]
            alpha[:, t] = np.where(live[:, t, None] > 0, step, alpha[:, t - 1])
        for t in range(times - 2, -1, -1):
            step = _lse(p["move"] + (e[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
            beta[:, t] = np.where(live[:, t + 1, None] > 0, step, 0)
        log_z = _lse(alpha[:, -1], 1)
        at = np.arange(rows)
        score = p["start"][tags[:, 0]] + (np.take_along_axis(e, tags[..., None], 2)[..., 0] * live).sum(axis=1)
        score = score + (p["move"][tags[:, :-1], tags[:, 1:]] * live[:, 1:]).sum(axis=1)
        grad = {k: np.zeros_like(v) for k, v in p.items()}
        d_e = np.exp(alpha + beta - log_z[:, None, None]) * live[..., None]
        grad["start"] = d_e[:, 0].sum(axis=0)
        np.subtract.at(grad["start"], tags[:, 0], 1)
        pair = alpha[:, :-1, :, None] + p["move"] + (e[:, 1:] + beta[:, 1:])[:, :, None, :]
        pair = np.exp(np.minimum(pair - log_z[:, None, None, None], 0)) * live[:, 1:, None, None]
        grad["move"] = pair.sum(axis=(0, 1))
        np.subtract.at(grad["move"], (tags[:, :-1].ravel(), tags[:, 1:].ravel()), live[:, 1:].ravel())
        np.subtract.at(d_e, (at[:, None], np.arange(times)[None, :], tags), live)
        grad["out"] = both.reshape(-1, 2 * HIDDEN).T @ d_e.reshape(-1, self.tags)
        grad["bias"] = d_e.sum(axis=(0, 1))
        d_both = d_e @ p["out"].T
        d_x = self._back("f", x, tape_f, d_both[..., :HIDDEN], grad)
        d_x += self._back("b", x, tape_b, d_both[..., HIDDEN:], grad)
        np.add.at(grad["embedding"], symbols.ravel(), d_x.reshape(-1, EMBEDDING))
        return float((log_z - score).mean()), {k: (g / rows).astype(dtype) for k, g in grad.items()}

    def fit(self, symbols: np.ndarray, tags: np.ndarray, steps: int, batch: int = 32, rate: float = 0.02) -> list[float]:
        """Adam over shuffled batches; the loss of each step."""
        rng = np.random.default_rng(6)
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        history: list[float] = []
        order = np.zeros(0, np.int64)
        for step in range(1, steps + 1):
            if len(order) < min(batch, len(symbols)):
                order = np.concatenate([order, rng.permutation(len(symbols))])
            part, order = order[:batch], order[batch:]
            loss, grad = self.loss(symbols[part], tags[part])
            history.append(loss)
            now = rate / (1 + 4 * step / steps)
            size = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
            for k, g in grad.items():
                g = g * min(1.0, 5 / (size + 1e-9))
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                move = first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
                self.p[k] = (self.p[k] - now * move).astype(self.p[k].dtype)
        return history

    # --- decoding ---------------------------------------------------------------------

    def best_path(self, e: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Most likely tags [text, time] for emissions [text, time, tag] (Viterbi)."""
        rows, times, _ = e.shape
        score = self.p["start"] + e[:, 0]
        back = np.zeros((times, rows, self.tags), np.int8)
        for t in range(1, times):
            step = score[:, :, None] + self.p["move"]
            back[t] = step.argmax(axis=1)
            on = (t < lengths)[:, None]
            back[t] = np.where(on, back[t], np.arange(self.tags))
            score = np.where(on, step.max(axis=1) + e[:, t], score)
        path = np.zeros((rows, times), np.int8)
        path[:, -1] = score.argmax(axis=1)
        for t in range(times - 1, 0, -1):
            path[:, t - 1] = back[t, np.arange(rows), path[:, t]]
        return path
