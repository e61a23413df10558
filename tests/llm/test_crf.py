"""Forward-backward, Viterbi and training against enumeration and a plain recursion."""

import itertools

import numpy as np
import pytest

from sonomere.llm import crf


def paths(emission, transition):
    n, k = emission.shape
    for labels in itertools.product(range(k), repeat=n):
        score = sum(emission[i, x] for i, x in enumerate(labels))
        score += sum(transition[a, b] for a, b in zip(labels, labels[1:]))
        yield labels, score


@pytest.mark.parametrize("k", [1, 2, 4])
def test_against_enumeration(k):
    rng = np.random.default_rng(k)
    sizes = [0, 1, 5, 0, 3, 6]
    edges = np.concatenate([[0], np.cumsum(sizes)])
    emission, transition = rng.normal(size=(edges[-1], k)), rng.normal(size=(k, k))
    found = crf.posteriors(emission, edges, transition)
    labels = crf.viterbi(emission, edges, transition)
    for a, b in zip(edges, edges[1:]):
        if a == b:
            continue
        every = list(paths(emission[a:b], transition))
        weight = np.exp([s for _, s in every])
        chance = np.zeros((b - a, k))
        for (path, _), w in zip(every, weight):
            chance[np.arange(b - a), path] += w
        assert np.allclose(found[a:b], chance / weight.sum())
        assert tuple(labels[a:b]) == max(every, key=lambda x: x[1])[0]


def test_long_sequences_are_exact():
    rng = np.random.default_rng(0)
    sizes = [crf.BLOCK * 3 + 7, 2, crf.BLOCK, crf.BLOCK + 1]
    edges = np.concatenate([[0], np.cumsum(sizes)])
    emission, transition = rng.normal(size=(edges[-1], 3)) * 3, rng.normal(size=(3, 3))
    found = crf.posteriors(emission, edges, transition)
    for a, b in zip(edges, edges[1:]):
        ahead, back = np.empty((b - a, 3)), np.zeros((b - a, 3))
        ahead[0] = emission[a]
        for t in range(1, b - a):
            ahead[t] = np.logaddexp.reduce(ahead[t - 1][:, None] + transition, axis=0) + emission[a + t]
        for t in range(b - a - 2, -1, -1):
            back[t] = np.logaddexp.reduce(transition + emission[a + t + 1] + back[t + 1], axis=1)
        both = ahead + back
        both = np.exp(both - np.logaddexp.reduce(both, axis=1)[:, None])
        assert np.allclose(found[a:b], both)


def test_expected_transitions():
    rng = np.random.default_rng(3)
    emission, transition = rng.normal(size=(5, 3)), rng.normal(size=(3, 3))
    posterior = crf.posteriors(emission, np.array([0, 5]), transition)
    found = crf._pairs(posterior, np.arange(1, 5), transition)
    wanted, total = np.zeros((3, 3)), 0.0
    for labels, score in paths(emission, transition):
        total += np.exp(score)
        for a, b in zip(labels, labels[1:]):
            wanted[a, b] += np.exp(score)
    assert np.allclose(found, wanted / total, atol=1e-3)


def test_training_learns_transitions():
    rng = np.random.default_rng(5)
    label = np.repeat(rng.integers(0, 2, 200), 10)
    noisy = np.where(rng.random(len(label)) < 0.25, 1 - label, label)
    features = crf.Features(noisy.astype(np.int32), np.arange(len(label) + 1))
    edges = np.append(np.arange(0, len(label), 100), len(label))
    model = crf.train(features, label, edges, ["a", "b"], 2, epochs=20)
    found = crf.viterbi(features.emissions(model.weights), edges, model.transition)
    assert (found == label).mean() > 0.85 > 0.77 > (noisy == label).mean()
    assert model.transition[0, 0] > model.transition[0, 1]
