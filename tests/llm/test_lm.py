import collections
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallygrid.llm.gru import END, Lanes, Network, Trainer, _step, log_probs, segments
from tallygrid.llm.lm import Table, fit, score, score_documents


def tokens(text):
    return (text or "").encode().lower().split() if (text or "").isascii() else "".join(c.lower() if c.isascii() else c for c in text).encode().split()


def base(rows, train):
    counts = collections.Counter(w for i, t in rows if train(i) for w in tokens(t))
    n_docs = sum(1 for i, _ in rows if train(i))
    n, v = sum(counts.values()) + n_docs, len(counts) + (n_docs > 0)
    out = []
    for i, t in rows:
        logs = [math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens(t)] + [math.log10((n_docs + 0.1) / (n + 0.1 * (v + 1)))]
        out.append((i, len(logs), sum(counts[w] > 0 for w in tokens(t)) + (n_docs > 0), n, sum(logs)))
    return out


def some_rows():
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice(["The", "cat", "sat", "on", f"x{rng.randrange(300)}", "É"]) for _ in range(rng.randrange(30)))) for i in range(120)]
    return rows + [(500, None), (501, ""), (502, "the cat " * 3000), (503, "the x1 x2 new"), (503, "the x1 x2 new")]


@pytest.mark.parametrize("table, head", [(1 << 18, 1022), (10, 4), (0, 4)])
def test_base_scores_exactly(docs, table, head):
    rows = some_rows()
    out = score_documents(docs(rows), F.col("doc_id") % 3 != 0, table=table, head=head, classes=6, hidden=4, rounds=1).collect()
    want = sorted(base(rows, lambda i: i % 3 != 0))
    got = sorted((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in out)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    assert np.allclose([g[4] for g in got], [w[4] for w in want])
    assert all(math.isfinite(r.score) and r.score <= 0 for r in out)


def test_without_training_or_documents(docs):
    corpus, counts = fit(docs([]))
    out = score(docs([(1, "a b"), (None, None)]), corpus, counts).collect()
    assert [(r.n_known, r.train_tokens, r.base_score) for r in out] == [(0, 0, 0.0)] * 2
    assert score(docs([]), corpus, counts).collect() == []


def test_model_learns_order(docs):
    rng = random.Random(2)
    rows = [(i, " ".join(["one", "two", "three", "four"] * rng.randrange(5, 40))) for i in range(400)]
    out = score_documents(docs(rows), F.col("doc_id") % 10 != 0, head=10, classes=4, hidden=8).filter("doc_id % 10 = 0").collect()
    assert sum(r.score for r in out) > 0.6 * sum(r.base_score for r in out)


def test_state_is_carried_and_lanes_agree():
    net = Network(np.array([5, 3, 9, 7, 4, 2], float), 3, 4)
    rng = np.random.default_rng(3)
    lengths = np.array([1, 7, 300, 2, 40])
    ids = rng.integers(1, 6, lengths.sum())
    ids[np.cumsum(lengths) - 1] = END
    want, at = [], 0
    for n in lengths:
        h, before = np.zeros((1, 4), np.float32), END
        for y in ids[at : at + n]:
            h = _step(net, np.array([before]), h)[4]
            c = h @ net.views["wc"] + net.views["bc"]
            own = net.members[net.class_of[y]]
            w = h @ net.views["ww"][own].T + net.views["bw"][own]
            total = c[0, net.class_of[y]] - np.log(np.exp(c).sum())
            want.append(total + (w[0, net.place[y]] - np.log(np.exp(w).sum()) if len(own) > 1 else 0))
            before = y
        at += n
    for n_lanes in (1, 2, 100):
        assert np.allclose(log_probs(net, ids, lengths, n_lanes, block=50), want, atol=1e-4)
    assert Lanes(ids, lengths, 2).steps == 300


def test_probabilities_sum_to_one():
    net = Network(np.array([5, 3, 9, 7, 4, 2], float), 3, 4)
    total = sum(np.exp(log_probs(net, np.array([y]), np.array([1]))[0]) for y in range(6))
    assert total == pytest.approx(1, abs=1e-4)


def test_gradient_against_differences():
    net = Network(np.array([5, 3, 9, 7], float), 3, 3)
    ids = np.array([2, 3, 1, END, 3, 2, END])
    lengths = np.array([4, 3])
    trainer = Trainer(net)
    trainer._update = lambda: None
    trainer.scale = 1.0
    trainer._window(Lanes(ids, lengths, 2), range(4), np.zeros((2, 3), np.float32))
    grad = trainer.grad.copy()
    rng = np.random.default_rng(5)
    for k in rng.choice(len(net.flat), 60, replace=False):
        old, ends = net.flat[k], []
        for step in (1e-2, -1e-2):
            net.flat[k] = old + step
            ends.append(-log_probs(net, ids, lengths).sum())
        net.flat[k] = old
        assert (ends[0] - ends[1]) / 2e-2 == pytest.approx(grad[k], abs=2e-2)


def test_table_finds_all():
    rng = np.random.default_rng(6)
    words = np.unique(rng.integers(0, 1 << 63, 5000).astype(np.uint64))
    table = Table(words)
    ask = np.concatenate([words, rng.integers(0, 1 << 63, 1000).astype(np.uint64)])
    assert (table.find(ask)[: len(words)] == np.arange(len(words))).all() and (table.find(ask)[len(words) :] == -1).all()
    assert (Table(words[:0]).find(ask) == -1).all()


def test_training_starts_anew_only_with_a_document():
    lengths = np.array([1300, 40, 700, 5])
    ids = np.random.default_rng(7).integers(1, 6, lengths.sum())
    ids[np.cumsum(lengths) - 1] = END
    trainer, seen = Trainer(Network(np.array([5, 3, 9, 7, 4, 2], float), 3, 4)), []
    plain = trainer._window

    def window(lanes, steps, h):
        seen.append(lanes)
        return plain(lanes, steps, h)

    trainer._window = window
    trainer.train(ids, lengths)
    lanes = seen[0]
    assert lanes.fresh.sum() == len(lengths) and (lanes.x == END).sum() == len(lengths)
    assert (lanes.x[lanes.fresh] == END).all() and sorted(lanes.y) == sorted(ids)


def test_long_documents_in_segments():
    rng = np.random.default_rng(8)
    lengths = np.array([3, 1000, 64, 65, 1, 129])
    ids = rng.integers(1, 6, lengths.sum())
    ids[np.cumsum(lengths) - 1] = END
    runs, size, before, own = segments(ids, lengths, 64, 16)
    assert (runs[own] == ids).all() and size.max() <= 64 + 16 and len(runs) == size.sum()  # every token is learned from once
    assert (before == END).sum() >= len(lengths)
    at = np.cumsum(lengths)[0]
    second = size[0] + size[1]  # the second run of the long document reads the 16 tokens before it
    assert size[2] == 64 + 16 and (runs[second : second + 16] == ids[at + 48 : at + 64]).all() and before[2] == ids[at + 47] and not own[second : second + 16].any()

    # With all tokens before it read, a run comes to the state of the whole document.
    net = Network(np.array([5, 3, 9, 7, 4, 2], float), 3, 4)
    runs, size, before, own = segments(ids[at : at + 200], np.array([200]), 64, 1000)
    states = {}
    for n, (a, b) in enumerate(zip(np.cumsum(size) - size, np.cumsum(size))):
        h = np.zeros((1, 4), np.float32)
        for y, x in zip(runs[a:b], [before[n], *runs[a : b - 1]]):
            h = _step(net, np.array([x]), h)[4]
        states[n] = h
    h, x = np.zeros((1, 4), np.float32), END
    for k, y in enumerate(ids[at : at + 200]):
        h, x = _step(net, np.array([x]), h)[4], y
        if k in (63, 127, 191, 199):
            assert np.allclose(states[(63, 127, 191, 199).index(k)], h, atol=1e-5)


def test_gradient_leaves_out_what_is_only_read():
    ids = np.random.default_rng(9).integers(1, 4, 40)
    ids[-1] = END
    trainer = Trainer(Network(np.array([5, 3, 9, 7], float), 3, 3))
    trainer._update, trainer.scale = lambda: None, 1.0
    own = np.arange(40) >= 30
    trainer._window(Lanes(ids, np.array([40]), 1, np.array([END]), own), range(40), np.zeros((1, 3), np.float32))
    assert np.abs(trainer.g["bw"]).sum() > 0 and (trainer.g["bw"][~np.isin(trainer.net.class_of, trainer.net.class_of[ids[own]])] == 0).all()
    grad, net = trainer.grad.copy(), trainer.net
    for k in np.random.default_rng(5).choice(len(net.flat), 40, replace=False):
        old, ends = net.flat[k], []
        for step in (1e-2, -1e-2):
            net.flat[k] = old + step
            ends.append(-log_probs(net, ids, np.array([40]))[own].sum())
        net.flat[k] = old
        assert (ends[0] - ends[1]) / 2e-2 == pytest.approx(grad[k], abs=3e-2)
