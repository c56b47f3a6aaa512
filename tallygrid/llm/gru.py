"""A gated recurrent network over word ids with a class-factored softmax, in numpy.

Documents are laid side by side in lanes and stepped together; a lane takes the next
document when one ends, with a fresh state. Training cuts the gradient after a
window of steps and carries the state on. A document longer than SEGMENT is trained
on in several lanes: each of its later segments first reads the LEAD tokens before
it, which bring the state up and are not learned from a second time. Scoring carries
the state through the whole document.
"""

from __future__ import annotations

import heapq

import numpy as np

END, OTHER = 0, 1

F32 = np.float32

# Tokens that one lane trains on in a row, and tokens before them that it reads to come to a state.
SEGMENT, LEAD = 4096, 64


class Network:
    """Parameters as one flat vector, so that they can be averaged, and views into it."""

    def __init__(self, counts: np.ndarray, n_classes: int, hidden: int, flat: np.ndarray | None = None) -> None:
        """counts: training count of each id (end, other, then the head words)."""
        self.counts, self.hidden = counts, hidden
        self.class_of = self._classes(counts, n_classes)
        self.n_classes = int(self.class_of.max()) + 1
        self.members = [np.flatnonzero(self.class_of == c) for c in range(self.n_classes)]
        self.place = np.zeros(len(counts), np.int64)
        for own in self.members:
            self.place[own] = np.arange(len(own))
        v, h, c = len(counts), hidden, self.n_classes
        shapes = [("emb", (v, 3 * h)), ("u", (h, 3 * h)), ("wc", (h, c)), ("bc", (c,)), ("ww", (v, h)), ("bw", (v,))]
        size = sum(int(np.prod(s)) for _, s in shapes)
        fresh = flat is None
        self.flat = np.zeros(size, F32) if fresh else flat.astype(F32)
        self.views = self.split(self.flat, shapes)
        self.shapes = shapes
        if fresh:
            rng = np.random.default_rng(11)
            self.views["emb"][:] = rng.normal(0, 0.3, (v, 3 * h))
            self.views["u"][:] = rng.normal(0, 0.5 / np.sqrt(h), (h, 3 * h))
            share = (counts + 0.1) / (counts.sum() + 0.1 * v)
            mass = np.array([share[own].sum() for own in self.members])
            self.views["bc"][:] = np.log(mass)
            self.views["bw"][:] = np.log(share / mass[self.class_of])

    @staticmethod
    def _classes(counts: np.ndarray, n_classes: int) -> np.ndarray:
        """Ids in order of frequency, cut into classes of about equal mass; `other` is a class of its own."""
        out = np.zeros(len(counts), np.int64)
        order = np.argsort(-counts, kind="stable")
        order = order[order != OTHER]
        mass = np.cumsum(counts[order] + 0.1)
        which = np.minimum((mass / mass[-1] * (n_classes - 1) - 1e-9).astype(np.int64), n_classes - 2) if len(order) else np.zeros(0, np.int64)
        _, out[order] = np.unique(which, return_inverse=True)
        out[OTHER] = out[order].max() + 1 if len(order) else 0
        return out

    @staticmethod
    def split(flat: np.ndarray, shapes) -> dict[str, np.ndarray]:
        views, at = {}, 0
        for name, shape in shapes:
            n = int(np.prod(shape))
            views[name] = flat[at : at + n].reshape(shape)
            at += n
        return views


def _sigmoid(x: np.ndarray) -> np.ndarray:
    np.multiply(x, F32(0.5), out=x)
    np.tanh(x, out=x)
    x += F32(1)
    x *= F32(0.5)
    return x


class Lanes:
    """Documents dealt to lanes, longest first; inputs, targets and fresh starts by step and lane."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray, n_lanes: int, before: np.ndarray | None = None, own: np.ndarray | None = None) -> None:
        """ids: the targets of all runs one after another; before: the token that each run follows, END if not given; own: which ids are learned from."""
        n_lanes = max(1, min(n_lanes, len(lengths)))
        begin = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        loads = [(0, lane) for lane in range(n_lanes)]
        lane_of, at_of = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
        for doc in np.argsort(-lengths, kind="stable").tolist():
            load, lane = heapq.heappop(loads)
            lane_of[doc], at_of[doc] = lane, load
            heapq.heappush(loads, (load + int(lengths[doc]), lane))
        total = np.zeros(n_lanes, np.int64)
        np.add.at(total, lane_of, lengths)
        rank = np.empty(n_lanes, np.int64)
        order = np.argsort(-total, kind="stable")
        rank[order] = np.arange(n_lanes)
        self.total = total[order]
        self.steps = int(self.total[0]) if len(lengths) else 0
        # Active lanes at each step: those with more steps, which come first.
        self.active = np.searchsorted(-self.total, -np.arange(self.steps), "left")
        self.first = np.concatenate([[0], np.cumsum(self.active)])  # tokens in step order
        step = np.arange(len(ids), dtype=np.int32) + np.repeat((at_of - begin).astype(np.int32), lengths)
        self.slot = self.first.astype(np.int32)[step] + np.repeat(rank[lane_of].astype(np.int32), lengths)
        self.y = np.empty(len(ids), ids.dtype)
        self.y[self.slot] = ids
        x = np.empty(len(ids), ids.dtype)
        x[1:] = ids[:-1]
        x[begin] = END if before is None else before
        self.own = np.ones(len(ids), bool)
        if own is not None:
            self.own[self.slot] = own
        self.x = np.empty(len(ids), ids.dtype)
        self.x[self.slot] = x
        self.fresh = np.zeros(len(ids), bool)
        self.fresh[self.slot[begin]] = True


def segments(ids: np.ndarray, lengths: np.ndarray, segment: int, lead: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Documents as runs of at most lead + segment tokens: ids, lengths, the token before each run, and which ids are its own."""
    begin = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    many = -(-lengths // segment)
    doc = np.repeat(np.arange(len(lengths)), many)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many)
    start = nth * segment
    end = np.minimum(start + segment, lengths[doc])
    read = np.maximum(start - lead, 0)
    size = end - read
    at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    own = at >= np.repeat(start - read, size)
    first = begin[doc] + read
    before = np.where(read > 0, ids[first - 1], END)
    return ids[at + np.repeat(first, size)], size, before, own


def _step(net: Network, x: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, ...]:
    n = net.hidden
    pre = net.views["emb"][x]
    hu = h @ net.views["u"]
    gates = _sigmoid(pre[:, : 2 * n] + hu[:, : 2 * n])
    z, r = gates[:, :n], gates[:, n:]
    hn = hu[:, 2 * n :]
    cand = np.tanh(pre[:, 2 * n :] + r * hn)
    return z, r, hn, cand, cand + z * (h - cand)


def _log_softmax_at(logits: np.ndarray, at: np.ndarray) -> np.ndarray:
    logits -= logits.max(axis=1, keepdims=True)
    picked = logits[np.arange(len(at)), at].copy()
    np.exp(logits, out=logits)
    return picked - np.log(logits.sum(axis=1))


def log_probs(net: Network, ids: np.ndarray, lengths: np.ndarray, n_lanes: int = 1024, block: int = 1 << 16) -> np.ndarray:
    """Natural log probability of every id, documents one after another, the state carried through each."""
    if not len(ids):
        return np.zeros(0)
    lanes = Lanes(ids, lengths, n_lanes)
    h = np.zeros((lanes.active[0], net.hidden), F32)
    out = np.empty(len(ids))
    states, begin, filled = np.empty((block + lanes.active[0], net.hidden), F32), 0, 0

    def flush() -> None:
        out[begin : begin + filled] = _output(net, states[:filled], lanes.y[begin : begin + filled])

    for t in range(lanes.steps):
        a, b = lanes.first[t], lanes.first[t + 1]
        n = b - a
        h = h[:n]
        fresh = lanes.fresh[a:b]
        if fresh.any():
            h = np.where(fresh[:, None], F32(0), h)
        h = _step(net, lanes.x[a:b], h)[4]
        states[filled : filled + n] = h
        filled += n
        if filled >= block:
            flush()
            begin, filled = begin + filled, 0
    flush()
    return out[lanes.slot]


def _output(net: Network, h: np.ndarray, y: np.ndarray) -> np.ndarray:
    p = net.views
    cls = net.class_of[y]
    out = _log_softmax_at(h @ p["wc"] + p["bc"], cls).astype(np.float64)
    order = np.argsort(cls, kind="stable")
    edges = np.searchsorted(cls[order], np.arange(net.n_classes + 1))
    for c, own in enumerate(net.members):
        at = order[edges[c] : edges[c + 1]]
        if len(at) and len(own) > 1:
            out[at] += _log_softmax_at(h[at] @ p["ww"][own].T + p["bw"][own], net.place[y[at]])
    return out


class Trainer:
    """Truncated backpropagation with Adagrad; the accumulators travel with the parameters."""

    def __init__(self, net: Network, squares: np.ndarray | None = None, rate: float = 0.1) -> None:
        self.net, self.rate = net, rate
        self.squares = np.full(len(net.flat), 0.01, F32) if squares is None else squares.astype(F32)
        self.grad = np.zeros_like(net.flat)
        self.g = net.split(self.grad, net.shapes)

    def train(self, ids: np.ndarray, lengths: np.ndarray, n_lanes: int = 256, window: int = 16, segment: int = SEGMENT, lead: int = LEAD) -> None:
        """One pass over the documents, an update after each window of steps.

        Every token is learned from once. There are no more lanes than the longest run
        leaves full, so that an update rests on as many texts as there can be, and a
        very long document does not hold up a task alone, step by step.
        """
        if not len(ids):
            return
        ids, lengths, before, own = segments(ids, lengths, segment, lead)
        n_lanes = int(max(1, min(n_lanes, len(ids) // (2 * window), -(-len(ids) // lengths.max()))))
        lanes = Lanes(ids, lengths, n_lanes, before, own)
        self.scale = (n_lanes * window) ** -0.5
        h = np.zeros((lanes.active[0], self.net.hidden), F32)
        for t0 in range(0, lanes.steps, window):
            h = self._window(lanes, range(t0, min(t0 + window, lanes.steps)), h)

    def _window(self, lanes: Lanes, steps: range, h: np.ndarray) -> np.ndarray:
        net, n = self.net, self.net.hidden
        kept, states = [], []
        for t in steps:
            a, b = lanes.first[t], lanes.first[t + 1]
            fresh = lanes.fresh[a:b]
            before = np.where(fresh[:, None], F32(0), h[: b - a])
            z, r, hn, cand, h = _step(net, lanes.x[a:b], before)
            kept.append((before, fresh, z, r, hn, cand))
            states.append(h)
        a, b = lanes.first[steps[0]], lanes.first[steps[-1] + 1]
        self.grad[:] = 0
        dh_out, states, own = np.zeros((b - a, n), F32), np.concatenate(states), lanes.own[a:b]
        dh_out[own] = self._output_grad(states[own], lanes.y[a:b][own])
        d_in = np.empty((b - a, 3 * n), F32)
        carry = np.zeros((0, n), F32)
        for k in range(len(kept) - 1, -1, -1):
            before, fresh, z, r, hn, cand = kept[k]
            p, q = lanes.first[steps[k]] - a, lanes.first[steps[k] + 1] - a
            dh = dh_out[p:q]
            dh[: len(carry)] += carry
            d = d_in[p:q]
            d[:, :n] = dh * (before - cand) * z * (1 - z)
            dc = dh * (1 - z) * (1 - cand * cand)
            d[:, 2 * n :] = dc
            d[:, n : 2 * n] = dc * hn * r * (1 - r)
            back = d.copy()
            back[:, 2 * n :] *= r
            self.g["u"] += before.T @ back
            carry = dh * z + back @ net.views["u"].T
            carry[fresh] = 0
        x = lanes.x[a:b]
        order = np.argsort(x, kind="stable")
        first = np.flatnonzero(np.concatenate([[True], x[order][1:] != x[order][:-1]]))
        seen = x[order][first]
        self.g["emb"][seen] = np.add.reduceat(d_in[order], first, axis=0)
        self._update()
        return h

    def _output_grad(self, h: np.ndarray, y: np.ndarray) -> np.ndarray:
        net, p, g = self.net, self.net.views, self.g
        cls = net.class_of[y]
        d = _softmax_minus(h @ p["wc"] + p["bc"], cls)
        g["wc"] += h.T @ d
        g["bc"] += d.sum(axis=0)
        dh = d @ p["wc"].T
        order = np.argsort(cls, kind="stable")
        edges = np.searchsorted(cls[order], np.arange(net.n_classes + 1))
        for c, own in enumerate(net.members):
            at = order[edges[c] : edges[c + 1]]
            if len(at) and len(own) > 1:
                hc = h[at]
                d = _softmax_minus(hc @ p["ww"][own].T + p["bw"][own], net.place[y[at]])
                g["ww"][own] = d.T @ hc
                g["bw"][own] = d.sum(axis=0)
                dh[at] += d @ p["ww"][own]
        return dh

    def _update(self) -> None:
        """Divide by what a full window holds: the end of a long lane, a few tokens of one text, then moves little."""
        grad = self.grad
        grad *= F32(self.scale)
        norm = float(np.sqrt((grad * grad).sum()))
        if norm > 5:
            grad *= F32(5 / norm)
        self.squares += grad * grad
        self.net.flat -= F32(self.rate) * grad / np.sqrt(self.squares)


def _softmax_minus(logits: np.ndarray, at: np.ndarray) -> np.ndarray:
    logits -= logits.max(axis=1, keepdims=True)
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=1, keepdims=True)
    logits[np.arange(len(at)), at] -= 1
    return logits
