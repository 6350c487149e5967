"""A small gated recurrent language model in numpy: class-factored output, truncated backpropagation, carried state.

Items are the words the network tells apart on its input: frequent words, and one item for each class of the others.
The output is factored: a softmax over classes, then, in a class of frequent words, a softmax over its words.  Within
a class of other words the network does not decide (see ``lm_scoring``).

Documents are laid into lanes, one after the other.  A lane is read in windows of ``window`` steps; the state goes on
from window to window and is zero where a document begins.  Gradients stop at the beginning of a window.  For training, long
documents are cut into segments, so that lanes are even and windows full; a segment's state begins at zero, its input is
the word before it.  Scoring never cuts a document.
"""

from __future__ import annotations

import numpy as np

from .bytewise import ranges

HIDDEN = 24
WINDOW = 16
SEGMENT = 512
RATE = 0.02


def _inputs(sizes: np.ndarray, items: np.ndarray, first: int) -> np.ndarray:
    """The item before each token; ``first`` before a document's first."""
    before = np.r_[first, items[:-1]]
    before[(np.cumsum(sizes) - sizes)[sizes > 0]] = first
    return before


def _segments(sizes: np.ndarray, longest: int) -> np.ndarray:
    """Sizes of the pieces, at most ``longest``, that documents are cut into."""
    n = -(-sizes // longest)
    cut = np.full(int(n.sum()), longest, np.int64)
    last = np.cumsum(n) - 1
    cut[last[n > 0]] = (sizes - (n - 1) * longest)[n > 0]
    return cut


class Lanes:
    """Documents (sizes in tokens) in at most ``n`` lanes, the longest lane first."""

    def __init__(self, sizes: np.ndarray, n: int):
        order = np.argsort(-sizes, kind="stable")
        n = max(1, min(n, len(sizes)))
        turn, place = np.divmod(np.arange(len(sizes)), n)
        lane = np.where(turn % 2 == 0, place, n - 1 - place)  # back and forth evens lanes out
        length = np.bincount(lane, sizes[order], n).astype(np.int64)
        rank = np.empty(n, np.int64)
        rank[np.argsort(-length, kind="stable")] = np.arange(n)
        by_lane = np.argsort(rank[lane], kind="stable")
        self.docs = order[by_lane]
        self.sizes = sizes[self.docs]
        self.length = np.sort(length)[::-1]
        self.base = np.cumsum(self.length) - self.length
        self.tokens = ranges((np.cumsum(sizes) - sizes)[self.docs], self.sizes)  # old place of each token
        self.begins = np.zeros(len(self.tokens), bool)
        self.begins[(np.cumsum(self.sizes) - self.sizes)[self.sizes > 0]] = True

    def windows(self, steps: int):
        """(places of tokens, which of them are real) for each window, lanes by steps."""
        t = 0
        while len(self.length) and t < self.length[0]:
            n = int(np.searchsorted(-self.length, -t, "left"))
            at = self.base[:n, None] + np.arange(t, t + steps)
            real = np.arange(t, t + steps) < self.length[:n, None]
            yield np.where(real, at, self.base[:n, None]), real
            t += steps


def _sigmoid_of_twice(x: np.ndarray) -> np.ndarray:
    """Of 2 x, in place: weights that lead to gates are halved once instead."""
    np.tanh(x, out=x)
    x *= np.float32(0.5)
    x += np.float32(0.5)
    return x


def _picked(x: np.ndarray, mask: np.ndarray) -> np.ndarray:
    return x.reshape(-1, *x.shape[2:]) if mask.all() else x[mask]


def _softmax(x: np.ndarray) -> np.ndarray:
    """In place."""
    x -= x.max(axis=1, keepdims=True)
    x -= np.log(np.exp(x).sum(axis=1, keepdims=True))
    return np.exp(x, out=x)


def _log_softmax_at(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    """One value of each row's log-softmax; ``x`` is used up."""
    x -= x.max(axis=1, keepdims=True)
    found = x[np.arange(len(at)), at]
    np.exp(x, out=x)
    return found - np.log(x.sum(axis=1))


class Network:
    """``weights``: x (items, 3 hidden), u (hidden, 3 hidden), c and cb (classes), w and wb (words of classes)."""

    NAMES = ("x", "u", "c", "cb", "w", "wb")

    def __init__(self, weights: dict[str, np.ndarray]):
        self.weights = weights
        self.hidden = weights["u"].shape[0]

    @classmethod
    def new(cls, items: int, class_prior: np.ndarray, word_prior: np.ndarray, hidden: int = HIDDEN, seed: int = 5) -> Network:
        """``word_prior``: (classes of frequent words, words of a class); priors are probabilities and begin as biases."""
        rng = np.random.default_rng(seed)
        heads, width = word_prior.shape

        def draw(*shape, scale):
            return rng.normal(0, scale, shape).astype(np.float32)

        return cls({
            "x": draw(items, 3 * hidden, scale=0.3), "u": draw(hidden, 3 * hidden, scale=hidden**-0.5),
            "c": draw(hidden, len(class_prior), scale=0.05), "cb": np.log(class_prior).astype(np.float32),
            "w": draw(heads, hidden, width, scale=0.05), "wb": np.log(word_prior).astype(np.float32),
        })

    def flat(self) -> np.ndarray:
        return np.concatenate([self.weights[k].reshape(-1) for k in self.NAMES])

    def filled(self, flat: np.ndarray) -> Network:
        out, at = {}, 0
        for k in self.NAMES:
            like = self.weights[k]
            out[k] = flat[at : at + like.size].astype(np.float32).reshape(like.shape)
            at += like.size
        return Network(out)

    def _run(self, inputs, resets, h, keep: bool):
        """States after each step (steps, lanes, hidden), and with ``keep`` what the way back needs, likewise by steps."""
        n = self.hidden
        halved = np.repeat(np.array([0.5, 1], np.float32), [2 * n, n])
        u = self.weights["u"] * halved
        given = (self.weights["x"] * halved)[inputs.T]
        steps, lanes = given.shape[:2]
        states = np.empty((steps, lanes, n), np.float32)
        gates, new = np.empty((steps if keep else 1, lanes, 2 * n), np.float32), np.empty((steps if keep else 1, lanes, n), np.float32)
        olds, owns = (np.empty_like(states), np.empty((steps, lanes, n), np.float32)) if keep else (None, None)
        own, anew = np.empty((lanes, 3 * n), np.float32), resets.any(axis=0).tolist()
        for t in range(steps):
            if anew[t]:
                h = np.where(resets[:, t, None], np.float32(0), h)
            np.matmul(h, u, out=own)
            k = t if keep else 0
            zr, c, x = gates[k], new[k], given[t]
            np.add(x[:, : 2 * n], own[:, : 2 * n], out=zr)
            _sigmoid_of_twice(zr)
            np.multiply(zr[:, n:], own[:, 2 * n :], out=c)
            c += x[:, 2 * n :]
            np.tanh(c, out=c)
            if keep:
                olds[t], owns[t] = h, own[:, 2 * n :]
            out = states[t]
            np.subtract(h, c, out=out)
            out *= zr[:, :n]
            out += c
            h = out
        return states, (olds, gates, new, owns), h.copy()

    def score(self, sizes: np.ndarray, items: np.ndarray, classes: np.ndarray, words: np.ndarray, first: int, lanes: int = 256) -> np.ndarray:
        """Natural log-probability of each token: of its class, and of its word in a class of frequent words.

        ``items``, ``classes``, ``words`` (place in its class, -1: none) of all tokens, documents one after the other;
        ``first`` is the item before a document's first token.
        """
        laid = Lanes(sizes, lanes)
        before = _inputs(sizes, items, first)[laid.tokens]
        cls_, word = classes[laid.tokens], words[laid.tokens]
        out = np.zeros(len(items), np.float32)
        h = np.zeros((len(laid.length), self.hidden), np.float32)
        for at, real in laid.windows(2 * WINDOW):
            states, _, h = self._run(before[at], laid.begins[at], h[: len(at)], False)
            places = _picked(at.T, real.T)
            out[places] = self._log_probabilities(_picked(states, real.T), cls_[places], word[places])
        back = np.empty(len(out), np.float32)
        back[laid.tokens] = out
        return back

    def _log_probabilities(self, states, classes, words):
        w = self.weights
        found = _log_softmax_at(states @ w["c"] + w["cb"], classes)
        named = np.flatnonzero(words >= 0)
        named = named[np.argsort(classes[named], kind="stable")]
        edges = np.searchsorted(classes[named], np.arange(len(w["w"]) + 1))
        states, words, more = states[named], words[named], np.empty(len(named), np.float32)
        for k, (a, b) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)):
            if b > a:
                more[a:b] = _log_softmax_at(states[a:b] @ w["w"][k] + w["wb"][k], words[a:b])
        found[named] += more
        return found


class Trainer:
    """Adam over windows of documents, one pass."""

    def __init__(self, network: Network, rate: float = RATE):
        self.network, self.rate = network, rate
        self.mean = {k: np.zeros_like(v) for k, v in network.weights.items()}
        self.square = {k: np.zeros_like(v) for k, v in network.weights.items()}
        self.steps = self.tokens = 0

    def learn(self, sizes, items, classes, words, first: int, lanes: int = 256) -> None:
        laid = Lanes(_segments(sizes, SEGMENT), lanes)
        before = _inputs(sizes, items, first)[laid.tokens]
        cls_, word = classes[laid.tokens], words[laid.tokens]
        h = np.zeros((len(laid.length), self.network.hidden), np.float32)
        for at, real in laid.windows(WINDOW):
            h = self._window(before[at], laid.begins[at], cls_[at], word[at], real, h[: len(at)])
        self.tokens += len(items)

    def _window(self, inputs, resets, classes, words, real, h):
        net, w, n = self.network, self.network.weights, self.network.hidden
        states, kept, h_end = net._run(inputs, resets, h, True)
        mask = real.T
        flat, cls_, word = (_picked(x, mask) for x in (states, classes.T, words.T))
        share = np.float32(1 / max(len(flat), 1))
        grads = {"w": np.zeros_like(w["w"]), "wb": np.zeros_like(w["wb"])}
        p = _softmax(flat @ w["c"] + w["cb"])
        p[np.arange(len(p)), cls_] -= 1
        p *= share
        grads["c"], grads["cb"] = flat.T @ p, p.sum(axis=0)
        d_flat = p @ w["c"].T
        named = np.flatnonzero(word >= 0)
        named = named[np.argsort(cls_[named], kind="stable")]
        edges = np.searchsorted(cls_[named], np.arange(len(w["w"]) + 1))
        met, word, d_met = flat[named], word[named], np.empty((len(named), n), np.float32)
        for k, (a, b) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)):
            if b > a:
                q = _softmax(met[a:b] @ w["w"][k] + w["wb"][k])
                q[np.arange(b - a), word[a:b]] -= 1
                q *= share
                grads["w"][k], grads["wb"][k] = met[a:b].T @ q, q.sum(axis=0)
                np.matmul(q, w["w"][k].T, out=d_met[a:b])
        d_flat[named] += d_met
        if len(d_flat) == mask.size:
            d_states = d_flat.reshape(states.shape)
        else:
            d_states = np.zeros_like(states)
            d_states[mask] = d_flat
        # all that doesn't depend on the step after, for all steps at once
        olds, gates, new, owns = kept
        z, r = gates[..., :n], gates[..., n:]
        not_z, not_r, change, slope = 1 - z, 1 - r, olds - new, 1 - new * new
        z, r = np.ascontiguousarray(z), np.ascontiguousarray(r)
        d_own = np.empty((*states.shape[:2], 3 * n), np.float32)
        d_new = np.empty_like(states)
        d_u, part = np.zeros_like(w["u"]), np.empty_like(h_end)
        anew = resets.any(axis=0).tolist()
        d_h = np.zeros_like(h_end)
        for t in range(len(states) - 1, -1, -1):
            d_h += d_states[t]
            given, own = d_new[t], d_own[t]
            np.multiply(d_h, not_z[t], out=given)
            given *= slope[t]
            np.multiply(d_h, change[t], out=part)
            part *= z[t]
            np.multiply(part, not_z[t], out=own[:, :n])
            np.multiply(given, owns[t], out=part)
            part *= r[t]
            np.multiply(part, not_r[t], out=own[:, n : 2 * n])
            np.multiply(given, r[t], out=own[:, 2 * n :])
            d_u += olds[t].T @ own
            d_h *= z[t]
            d_h += own @ w["u"].T
            if anew[t]:
                d_h[resets[:, t]] = 0
        d_x = d_own
        d_x[..., 2 * n :] = d_new
        grads["u"] = d_u
        grads["x"] = np.zeros_like(w["x"])
        asked = inputs.T.reshape(-1)
        order = np.argsort(asked, kind="stable")
        begin = np.flatnonzero(np.r_[True, asked[order][1:] != asked[order][:-1]])
        grads["x"][asked[order[begin]]] = np.add.reduceat(d_x.reshape(-1, 3 * n)[order], begin, axis=0)
        self._step(grads)
        return h_end

    def _step(self, grads) -> None:
        self.steps += 1
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
        scale = np.float32(min(1.0, 1.0 / max(norm, 1e-9)))
        rate = np.float32(self.rate * np.sqrt(1 - 0.99**self.steps) / (1 - 0.9**self.steps))
        for k, g in grads.items():
            g *= scale
            self.mean[k] += np.float32(0.1) * (g - self.mean[k])
            self.square[k] += np.float32(0.01) * (g * g - self.square[k])
            self.network.weights[k] -= rate * self.mean[k] / (np.sqrt(self.square[k]) + np.float32(1e-8))
