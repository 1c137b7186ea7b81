"""A small gated recurrent language model in numpy: class-factored softmax, truncated backpropagation."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np

HIDDEN = 16
#: Branches of a node of the class tree, at least and at most; the tree has three levels, or more where they would
#: need more branches.
BRANCHES, MOST = 16, 24
#: Numbers that are worked on at a time, so that they stay in the cache, and how often nodes of the class tree occur
#: that are worked on together; more frequent ones are by themselves.
CACHED, WIDTHS = 1 << 16, np.array([1, 2, 3, 4, 6, 8, 12, 16, 24, 32])


def _logs(h: np.ndarray, weights: np.ndarray, bias: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Log-softmax of each row at one place, some rows at a time, so that their logits stay in the cache.
    Inputs of the layer are within -1 and 1, so logits stay far from overflow."""
    out, ones = np.empty(len(h), dtype=np.float32), np.ones(len(bias), dtype=np.float32)
    span = max(1, CACHED // len(bias))
    for part in (slice(at, at + span) for at in range(0, len(h), span)):
        logits = h[part] @ weights
        logits += bias
        np.minimum(logits, 60, out=logits)
        own = logits[np.arange(len(logits)), wanted[part]]
        out[part] = own - np.log(np.exp(logits, out=logits) @ ones)
    return out


def _descent(h: np.ndarray, weights: np.ndarray, bias: np.ndarray, wanted: np.ndarray, scale: np.float32, dh: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of a softmax layer's weights and bias; that of ``h`` is added to ``dh``."""
    dw, db, ones = np.zeros_like(weights), np.zeros_like(bias), np.ones(len(bias), dtype=np.float32)
    span = max(1, CACHED // len(bias))
    for part in (slice(at, at + span) for at in range(0, len(h), span)):
        err = h[part] @ weights
        err += bias
        np.exp(np.minimum(err, 60, out=err), out=err)
        err *= (scale / (err @ ones))[:, None]
        err[np.arange(len(err)), wanted[part]] -= scale
        dw += h[part].T @ err
        db += err.sum(axis=0)
        dh[part] += err @ weights.T
    return dw, db


def _runs(nodes: np.ndarray, cells: int) -> Iterator[tuple[np.ndarray, slice | np.ndarray, np.ndarray | None]]:
    """(nodes, places, real) over sorted ``nodes``: a frequent node alone with the slice of its places, others that
    occur about as often together, each with its places in a row filled up to a common width; ``real`` tells
    the places that are its own. ``cells`` is what a place takes."""
    firsts = np.flatnonzero(np.append(True, nodes[1:] != nodes[:-1])) if len(nodes) else np.zeros(0, dtype=np.int64)
    counts = np.diff(np.append(firsts, len(nodes)))
    for first, count in zip(firsts[counts > WIDTHS[-1]].tolist(), counts[counts > WIDTHS[-1]].tolist()):
        yield nodes[first : first + 1], slice(first, first + count), None
    step = np.searchsorted(WIDTHS, counts)
    for number, width in enumerate(WIDTHS.tolist()):
        mine = np.flatnonzero(step == number)
        span = max(1, CACHED // (width * cells))
        for low in range(0, len(mine), span):
            some = mine[low : low + span]
            at = firsts[some][:, None] + np.arange(width)
            yield nodes[firsts[some]], np.minimum(at, len(nodes) - 1), np.arange(width) < counts[some][:, None]


#: Parameters that a window touches as a whole. Of the others it touches some rows, with one step size for each row.
WHOLE = ("state", "gates", "classes", "class_bias", "others", "others_bias")


class Gru:
    """Log-probabilities of symbols ``0 .. words + rest - 1``.

    Symbols below ``words`` are frequent words under a tree of classes, in order of frequency: a class, a
    class inside it, and the word inside that, each a softmax over some ``branches``, the cube root of the words and
    ``BRANCHES`` at least. Where that is more than ``MOST`` there are more classes inside each other, so that a word's
    cost grows with the logarithm of the words. The ``rest`` symbols are one class more, with a softmax over
    them. ``counts`` sets the biases to the symbols' frequencies, where training starts from.
    """

    def __init__(self, counts: np.ndarray, words: int, rest: int, seed: int = 1):
        rng = np.random.default_rng(seed)
        depth = next(d for d in itertools.count(3) if MOST**d >= words)
        k = self.branches = next(k for k in range(BRANCHES, MOST + 1) if k**depth >= words)
        self.words, self.rest, self.top = words, rest, -(-words // k ** (depth - 1))
        self.levels = ("mid", *[f"mid{n}" for n in range(2, depth - 1)], "leaf")

        def share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
            return np.where(part > 0, np.log(np.maximum(part, 1e-30) / np.maximum(whole, 1e-30)), -30.0).astype(np.float32)

        inner, below = {}, np.zeros(self.top * k ** (depth - 1))
        below[:words] = counts[:words] + 0.5
        for name in reversed(self.levels):
            below = below.reshape(-1, k)
            inner[f"{name}_bias"] = share(below, below.sum(axis=1, keepdims=True))
            inner[name] = np.zeros((len(below), HIDDEN, k), dtype=np.float32)
            below = below.sum(axis=1)
        others = counts[words:] + 0.5
        tops = np.append(below, others.sum())

        def small(*shape: int) -> np.ndarray:
            return rng.normal(0, 0.1, shape).astype(np.float32)

        self.p = {
            "input": small(words + rest, 3 * HIDDEN),
            "state": small(HIDDEN, 3 * HIDDEN) * 3,
            "gates": np.zeros(3 * HIDDEN, dtype=np.float32),
            "classes": np.zeros((HIDDEN, self.top + 1), dtype=np.float32),
            "class_bias": np.log(tops / tops.sum()).astype(np.float32),
            "others": np.zeros((HIDDEN, rest), dtype=np.float32),
            "others_bias": np.log(others / others.sum()).astype(np.float32),
        } | dict(reversed(inner.items()))
        self.squares = {n: np.full(len(self.p[n]), 1e-4, dtype=np.float32) for n in self.rowed}
        self.squares |= {n: np.full_like(self.p[n], 1e-4) for n in WHOLE}

    @property
    def rowed(self) -> list[str]:
        """Parameters of which a window touches some rows."""
        return [n for n in self.p if n not in WHOLE]

    def arrays(self) -> dict:
        """All that makes the model, as plain values."""
        return {n: getattr(self, n) for n in ("p", "squares", "words", "rest", "branches", "levels")}

    @classmethod
    def of(cls, arrays: dict) -> Gru:
        """A model of its own from ``arrays()``."""
        own = cls.__new__(cls)
        own.words, own.rest, own.branches, own.levels = (arrays[n] for n in ("words", "rest", "branches", "levels"))
        own.top = len(arrays["p"]["mid"])
        own.p, own.squares = ({n: v.copy() for n, v in arrays[part].items()} for part in ("p", "squares"))
        return own

    def rows(self, name: str, at: np.ndarray) -> np.ndarray:
        """Rows of a rowed parameter, with their step sizes last."""
        return np.concatenate([self.p[name][at].reshape(len(at), -1), self.squares[name][at][:, None]], axis=1)

    def shift(self, name: str, at: np.ndarray, by: np.ndarray) -> None:
        """Add what ``rows`` of two models differ by."""
        value = self.p[name]
        value[at] += by[:, :-1].reshape(len(at), *value.shape[1:])
        self.squares[name][at] += by[:, -1]

    def whole(self) -> np.ndarray:
        """The other parameters and their step sizes."""
        return np.concatenate([part[n].ravel() for part in (self.p, self.squares) for n in WHOLE])

    def load_whole(self, vector: np.ndarray) -> None:
        at = 0
        for part in (self.p, self.squares):
            for name in WHOLE:
                value = part[name]
                part[name] = vector[at : at + value.size].reshape(value.shape).astype(np.float32)
                at += value.size

    @staticmethod
    def blank(inputs: np.ndarray) -> np.ndarray:
        return np.zeros((inputs.shape[1], HIDDEN), dtype=np.float32)

    def _forward(self, inputs: np.ndarray, starts: np.ndarray, state: np.ndarray, kept: bool = True) -> tuple:
        """States before and after each step; a document's first step begins from a zero state. With ``kept``
        what training needs of each step. Gates and inputs lie apart by kind, each of them in one piece."""
        steps, lanes = inputs.shape
        state, rows = state[:lanes], steps if kept else 1
        weights = self._state_weights()
        after = np.empty((steps, lanes, HIDDEN), dtype=np.float32)
        before, new, inner = (np.empty((rows, lanes, HIDDEN), dtype=np.float32) for _ in range(3))
        gates, x = np.empty((rows, 2, lanes, HIDDEN), dtype=np.float32), np.empty((3, lanes, HIDDEN), dtype=np.float32)
        begins, going = starts.any(axis=1).tolist(), ~starts
        shift = self.p["gates"].reshape(3, 1, HIDDEN)
        for t in range(steps):
            at = t if kept else 0
            b, g, n, c = before[at], gates[at], new[at], inner[at]
            np.add(self.p["input"].take(inputs[t], axis=0).reshape(lanes, 3, HIDDEN).transpose(1, 0, 2), shift, out=x)
            if begins[t]:
                np.multiply(state, going[t][:, None], out=b)
            else:
                b[:] = state
            u = b @ weights
            np.add(x[:2], u[:2], out=g)
            g *= 0.5
            np.tanh(g, out=g)
            g *= 0.5
            g += 0.5
            c[:] = u[2]
            np.multiply(g[1], c, out=n)
            n += x[2]
            np.tanh(n, out=n)
            state = after[t]
            np.subtract(b, n, out=state)
            state *= g[0]
            state += n
        return before, after, gates, new, inner, state

    def _state_weights(self) -> np.ndarray:
        return np.ascontiguousarray(self.p["state"].reshape(HIDDEN, 3, HIDDEN).transpose(1, 0, 2))

    def _classes(self, targets: np.ndarray) -> np.ndarray:
        return np.where(targets < self.words, targets // self.branches ** len(self.levels), self.top)

    def _levels(self, targets: np.ndarray) -> tuple[np.ndarray, list[tuple[str, np.ndarray, np.ndarray]]]:
        """Places of frequent words in order of their nodes, and below their classes the node and branch of each level."""
        at, k = np.flatnonzero(targets < self.words), self.branches
        place, out = targets[at], []
        leaf = place // k
        # Numbers of 16 bits are sorted by their digits.
        order = np.argsort(leaf.astype(np.uint16) if self.words <= k << 16 else leaf, kind="stable")
        at, place = at[order], place[order]
        for name in reversed(self.levels):
            node = place // k
            out.append((name, node, place - node * k))
            place = node
        return at, out[::-1]

    def log_probabilities(self, inputs, starts, targets, state) -> tuple[np.ndarray, np.ndarray]:
        """Natural logarithms for each step and lane, and the state to go on with."""
        _, after, _, _, _, state = self._forward(inputs, starts, state, kept=False)
        h, wanted = after.reshape(-1, HIDDEN), targets.ravel()
        out = _logs(h, self.p["classes"], self.p["class_bias"], self._classes(wanted)).astype(np.float64)
        other = np.flatnonzero(wanted >= self.words)
        out[other] += _logs(h[other], self.p["others"], self.p["others_bias"], wanted[other] - self.words)
        at, levels = self._levels(wanted)
        h = h[at]
        below = np.zeros(len(at), dtype=np.float32)
        ones = np.ones(self.branches, dtype=np.float32)
        for name, nodes, branch in levels:
            weights, bias = self.p[name], self.p[f"{name}_bias"]
            for used, places, real in _runs(nodes, self.branches):
                if real is None:
                    below[places] += _logs(h[places], weights[used[0]], bias[used[0]], branch[places])
                    continue
                logits = h[places] @ weights[used]
                logits += bias[used][:, None, :]
                logits = np.minimum(logits, 60, out=logits).reshape(-1, self.branches)
                own = logits[np.arange(len(logits)), branch[places].ravel()]
                found = own - np.log(np.exp(logits, out=logits) @ ones)
                below[places[real]] += found.reshape(places.shape)[real]
        out[at] += below
        return out.reshape(targets.shape), state

    def train(self, inputs, starts, targets, live, state, rate: float, full: int) -> np.ndarray:
        """One step down the gradient of a window; ``live`` marks the steps that hold text. Losses are
        divided by ``full``, the places of a full window, so that a narrow one counts for less."""
        before, after, gates, new, inner, state = self._forward(inputs, starts, state)
        p, scale, k = self.p, np.float32(1 / full), self.branches
        on = np.flatnonzero(live)
        h, wanted = after.reshape(-1, HIDDEN)[on], targets.ravel()[on]
        found = np.zeros_like(h)
        d, parts = {}, {n: [] for n in self.rowed}
        d["classes"], d["class_bias"] = _descent(h, p["classes"], p["class_bias"], self._classes(wanted), scale, found)
        other = np.flatnonzero(wanted >= self.words)
        back = np.zeros((len(other), HIDDEN), dtype=np.float32)
        d["others"], d["others_bias"] = _descent(h[other], p["others"], p["others_bias"], wanted[other] - self.words, scale, back)
        found[other] += back
        at, levels = self._levels(wanted)
        h, back, ones = h[at], np.zeros((len(at), HIDDEN), dtype=np.float32), np.ones(k, dtype=np.float32)
        for name, nodes, branch in levels:
            weights, bias = p[name], p[f"{name}_bias"]
            for used, places, real in _runs(nodes, k):
                if real is None:
                    dw, db = _descent(h[places], weights[used[0]], bias[used[0]], branch[places], scale, back[places])
                    parts[name].append((used, dw.reshape(1, -1)))
                    parts[f"{name}_bias"].append((used, db[None]))
                    continue
                hc, own, share = h[places], weights[used], real * scale
                err = hc @ own
                err += bias[used][:, None, :]
                np.exp(np.minimum(err, 60, out=err), out=err)
                rows = err.reshape(-1, k)
                rows *= (share.ravel() / (rows @ ones))[:, None]
                rows[np.arange(len(rows)), branch[places].ravel()] -= share.ravel()
                dw = hc.transpose(0, 2, 1) * err if err.shape[1] == 1 else hc.transpose(0, 2, 1) @ err
                parts[name].append((used, dw.reshape(len(used), -1)))
                parts[f"{name}_bias"].append((used, err.sum(axis=1)))
                back[places[real]] += (err @ own.transpose(0, 2, 1))[real]
        found[at] += back
        dh = np.zeros_like(after)
        dh.reshape(-1, HIDDEN)[on] = found
        steps, lanes = inputs.shape
        # Gradients of the gates' sums, and of what the state gives to the third of them.
        dx, du = np.empty((steps, 3, lanes, HIDDEN), dtype=np.float32), np.empty((3, lanes, HIDDEN), dtype=np.float32)
        turned = np.ascontiguousarray(self._state_weights().transpose(0, 2, 1))
        begins, going = starts.any(axis=1).tolist(), ~starts
        by_state = np.zeros((3, HIDDEN, HIDDEN), dtype=np.float32)
        carry = np.zeros_like(dh[0])
        for t in range(steps - 1, -1, -1):
            g, (z, r), n, (dz, dr, dn) = dh[t], gates[t], new[t], dx[t]
            g += carry
            gz = g * z
            np.subtract(g, gz, out=dn)  # g * (1 - z)
            np.subtract(before[t], n, out=dz)
            dz *= z
            dz *= dn
            n *= n
            np.subtract(1, n, out=n)
            dn *= n
            np.multiply(dn, r, out=du[2])
            np.subtract(1, r, out=dr)
            dr *= inner[t]
            dr *= du[2]
            du[:2] = dx[t, :2]
            by_state += before[t].T @ du
            carry = (du @ turned).sum(axis=0)
            carry += gz
            if begins[t]:
                carry *= going[t][:, None]
        flat = dx.transpose(0, 2, 1, 3).reshape(-1, 3 * HIDDEN)
        d["gates"] = flat.sum(axis=0)
        d["state"] = by_state.transpose(1, 0, 2).reshape(HIDDEN, 3 * HIDDEN)
        parts["input"].append(_summed(inputs.ravel(), flat))
        parts = [(name, *map(np.concatenate, zip(*some))) for name, some in parts.items() if some]
        squares = [np.einsum("ij,ij->i", v, v) for *_, v in parts]
        size = np.sqrt(sum(float((v * v).sum()) for v in d.values()) + sum(float(v.sum()) for v in squares))
        rate *= min(1.0, 1.0 / max(size, 1e-9))
        for name, v in d.items():
            self.squares[name] += v * v
            p[name] -= rate * v / np.sqrt(self.squares[name])
        for (name, rows, v), square in zip(parts, squares):
            held = self.squares[name][rows] + square / np.float32(v.shape[1])
            self.squares[name][rows] = held
            v *= (np.float32(rate) / np.sqrt(held))[:, None]
            p[name][rows] -= v.reshape(len(rows), *p[name].shape[1:])
        return state


def _summed(keys: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the rows of each key."""
    order = np.argsort(keys, kind="stable")
    used, starts, counts = np.unique(keys[order], return_index=True, return_counts=True)
    out = rows[order[starts]]
    for nth in range(1, WIDTHS[-1]):
        more = np.flatnonzero((counts > nth) & (counts <= WIDTHS[-1]))
        if not len(more):
            break
        out[more] += rows[order[starts[more] + nth]]
    for at in np.flatnonzero(counts > WIDTHS[-1]).tolist():
        out[at] = rows[order[starts[at] : starts[at] + counts[at]]].sum(axis=0)
    return used, out


def lanes(documents: list[np.ndarray], number: int) -> list[list[int]]:
    """Documents dealt to lanes of about equal length; inside a lane they keep their order."""
    loads, out = np.zeros(number, dtype=np.int64), [[] for _ in range(number)]
    for i in sorted(range(len(documents)), key=lambda i: -len(documents[i])):
        lane = int(loads.argmin())
        out[lane].append(i)
        loads[lane] += len(documents[i])
    return [sorted(lane) for lane in out if lane]


def windows(documents: list[np.ndarray], number: int, steps: int, first: int) -> Iterator[tuple]:
    """(inputs, starts, targets, owner) by window over at most ``number`` lanes of whole documents.

    ``owner`` is the document of each step, -1 beyond a lane's end. The input of a step is the symbol
    before it, ``first`` at a document's start, where the state is reset. Lanes come longest first, and
    those that have ended are left out, so later windows are narrower. A window is laid out when its turn comes.
    """
    if not documents:
        return
    dealt = lanes(documents, number)
    ends = np.array([sum(len(documents[i]) for i in lane) for lane in dealt])
    dealt, ends = [dealt[k] for k in np.argsort(-ends, kind="stable")], -np.sort(-ends)
    order = [i for lane in dealt for i in lane]
    sizes = np.array([len(documents[i]) for i in order])
    begins = np.cumsum(sizes) - sizes
    targets = np.concatenate([documents[i] for i in order]).astype(np.int32)
    inputs = np.append(np.int32(first), targets[:-1])
    inputs[begins] = first
    starts = np.zeros(len(targets), dtype=bool)
    starts[begins] = True
    owner = np.repeat(np.array(order, dtype=np.int32), sizes)
    lows = np.cumsum(ends) - ends
    for at in range(0, int(ends[0]), steps):
        wide = int((ends > at).sum())
        step = np.arange(at, min(at + steps, int(ends[0])))[:, None]
        there = step < ends[:wide]
        place = np.where(there, lows[:wide] + step, 0)
        yield np.where(there, inputs[place], first), starts[place] & there, np.where(there, targets[place], 0), np.where(there, owner[place], -1)
