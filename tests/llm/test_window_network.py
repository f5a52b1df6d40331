import random

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm.lm_scoring import pseudo_likelihood
from tidemark.llm.window_network import BATCH, LONG, SLICE, Encoder, Network, fit_network, slices, unit_counts, units_for


def scores(docs):
    return [r.log_likelihood for r in pseudo_likelihood(docs).orderBy("doc_id").collect()]


def test_rare_words_are_told_apart(docs):
    """300 pairs of words of one length and ending, none among the commonest, which the corpus never mixes."""
    r = random.Random(1)
    common = [f"c{k:02d}" for k in range(95)]
    pairs = [("".join(r.choices("abcdefgh", k=6)), "".join(r.choices("abcdefgh", k=6))) for _ in range(300)]
    texts = [" ".join(common * 3)] * 200 + [" ".join(w for p in r.sample(pairs, 40) for w in p) for _ in range(600)]
    right = [" ".join(w for p in pairs for w in p)]
    wrong = [" ".join(w for k, p in enumerate(pairs) for w in (p[0], pairs[k - 7][1]))]
    a, b = scores(docs(*texts, *right, *wrong))[-2:]
    assert a > b + 100


def test_words_beyond_the_next_one_count(docs):
    r = random.Random(2)
    filler = ["aa", "bb", "cc"]
    good = [" ".join(w for _ in range(20) for k in [r.randrange(2)] for w in (("sun", "moon")[k], r.choice(filler), ("day", "night")[k], r.choice(filler), r.choice(filler))) for _ in range(600)]
    a, b = scores(docs(*good, "sun aa day bb cc moon aa night bb cc", "sun aa night bb cc moon aa day bb cc"))[-2:]
    assert a > b + 1


def test_units_follow_the_corpus(spark):
    small, larger = (spark.read.parquet(f"/root/testdata/{f}/documents.parquet") for f in ("sf0.001", "sf0.01"))
    nets = [fit_network(d, rounds=1) for d in (small, larger)]
    assert nets[0].units < nets[1].units and len(nets[1].table) == 2 * nets[1].units
    assert units_for(30 * 10**9) > 100 * units_for(3 * 10**6)


def test_every_window_is_trained_on_and_scored(docs):
    texts = ["the cat sat on the mat", None, "", "Zebra! 12 é", "the dog sat"] * 9
    table = docs(*texts)
    assert unit_counts(table.select("text"), 300).sum() == sum(len((t or "").split()) for t in texts)
    net = fit_network(table, units=300)
    encoder = Encoder(300, net.window)
    for r, t in zip(pseudo_likelihood(table, units=300).orderBy("doc_id").collect(), texts, strict=True):
        alone = net.log_probabilities(encoder.sequence([encoder.words(t)]))
        assert r.n_tokens == len((t or "").split()) == len(alone) and r.log_likelihood == pytest.approx(float(alone.sum()), rel=1e-2, abs=1e-2)
        assert (r.mean_log_likelihood is None) == (not t)


def test_probabilities_sum_to_one_and_follow_from_long_texts():
    counts = np.random.default_rng(3).integers(0, 50, 256)
    net, seq = Network.fresh(counts, 3), np.random.default_rng(4).integers(0, 256, 20_000).astype(np.int32)
    net.train(np.concatenate([[256] * 3, seq, [256] * 3]).astype(np.int32), np.zeros(512, np.float32))
    every = [net.log_probabilities(np.array([*seq[:3], t, *seq[4:7]], np.int32))[0] for t in range(256)]
    assert np.exp(every).sum() == pytest.approx(1, abs=1e-3)
    padded = np.concatenate([[256] * 3, seq, [256] * 3]).astype(np.int32)
    got = net.log_probabilities(padded)
    assert len(got) == len(seq) and got[9000] == pytest.approx(net.log_probabilities(padded[9000:9007])[0], abs=1e-4)


def test_edges_of_the_network(crowded, no_rows):
    rows = pseudo_likelihood(crowded).collect()
    assert len(rows) == crowded.count() and {r.log_likelihood for r in rows if r.doc_id in (3, 4, 6)} == {0.0}
    assert pseudo_likelihood(no_rows).count() == 0


def test_whole_columns_are_encoded_as_split_does():
    r = random.Random(6)
    parts = ["a", "b", "é", "日本", "😀", " ", " ", "  ", "\t", "\n", "\x0b", "\x0c", "\r", "\x00", "\x08", "\x0e", "\x1c", "\x1f", "\x85", "\xa0", "x" * LONG, "y" * 7]
    texts = [None if r.random() < 0.1 else "".join(r.choices(parts, k=r.randrange(30))) for _ in range(5000)] + ["z" * (2 * SLICE), "w " * SLICE]
    r.shuffle(texts)
    encoder, seen = Encoder(1 << 30, 2), {}
    for column in (pa.array(texts, pa.string()), pa.array(texts, pa.large_string()).slice(77), pa.array([None, ""], pa.string()), pa.array([], pa.string())):
        ids, counts = map(np.concatenate, zip(*map(encoder.encode, slices(column)), strict=True))
        words = [(t or "").encode().split() for t in column.to_pylist()]
        assert counts.tolist() == [len(x) for x in words] and len(ids) == counts.sum()
        for word, unit in zip((w for x in words for w in x), ids.tolist(), strict=True):
            assert seen.setdefault(word, unit) == unit
    assert len(set(seen.values())) > 0.999 * len(seen)
    assert all(encoder.words(w.decode()).tolist() == [seen[w]] for w in list(seen)[:200])


def test_minibatches_are_even(monkeypatch):
    """A sequence a little longer than a minibatch is one step, not a second one for a sliver."""
    steps, sums = [], Network._sums
    monkeypatch.setattr(Network, "_sums", lambda net, seq: steps.append(len(seq) - 2 * net.window) or sums(net, seq))
    seq = np.random.default_rng(7).integers(0, 300, 5 * BATCH + 300 + 6).astype(np.int32)
    net, touched = Network.fresh(np.bincount(seq, minlength=300), 3), np.zeros(600, np.float32)
    net.train(seq[: BATCH + 306], touched)
    assert steps == [BATCH + 300]
    steps.clear()
    assert len(net.log_probabilities(seq)) == sum(steps) == 5 * BATCH + 300 and max(steps) - min(steps) <= 1


def test_a_step_follows_the_plain_gradient():
    counts = np.random.default_rng(8).integers(0, 400, 500)
    seq = np.concatenate([[500] * 2, np.random.default_rng(9).integers(0, 500, 700), [500] * 2, np.random.default_rng(10).integers(0, 500, 5), [500] * 2]).astype(np.int32)
    net, touched = Network.fresh(counts, 2), np.zeros(1000, np.float32)
    net.table[501:] = np.random.default_rng(11).normal(0, 0.3, net.table[501:].shape)
    table, place, tree = net.table.astype(float), net.place.astype(float), net.tree
    grad, used, logs = np.zeros_like(table), np.zeros(len(table)), []
    used += np.bincount(seq, minlength=len(table))
    for at in range(2, len(seq) - 2):
        if seq[at] == 500:
            continue
        near = [at - 2, at - 1, at + 1, at + 2]
        h, back, log = place[-1] + sum(place[p] * table[seq[k]] for p, k in enumerate(near)), 0, 0.0
        for step in range(tree.start[seq[at]], tree.start[seq[at]] + tree.depth[seq[at]]):
            node, sign = tree.nodes[step], float(tree.sign[step])
            z = sign * (h @ table[501 + node] + tree.odds[node])
            g = sign / (1 + np.exp(z))
            log -= np.log1p(np.exp(-z))
            back = back + g * table[501 + node]
            grad[501 + node] += g * h
            used[501 + node] += 1
        for p, k in enumerate(near):
            grad[seq[k]] += place[p] * back
        logs.append(log)
    assert net.log_probabilities(seq) == pytest.approx(np.array(logs), abs=1e-4)
    squares = 1e-3 + (grad**2).mean(axis=1)
    net.train(seq, touched)
    assert (touched == used).all() and np.allclose(net.squares, squares, rtol=1e-3)
    assert np.allclose(net.table, table + 0.1 * grad / np.sqrt(squares)[:, None], atol=1e-4)
