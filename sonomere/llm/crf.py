"""Linear-chain conditional random fields over many sequences at once.

Sequences lie one after another in flat arrays; ``edges`` has where each begins and the last ends.
An emission row holds one score per label.
"""

import pickle
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

BLOCK = 128


def _scaled(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(x.sum(axis=tuple(range(1, x.ndim)), keepdims=True), 1e-30)


def posteriors(emission: np.ndarray, edges: np.ndarray, transition: np.ndarray) -> np.ndarray:
    """Probability of every label at every position, by forward-backward.

    Long sequences are cut into blocks whose transfer matrices are built side by side, so the
    number of array operations follows the block size and the blocks of the longest sequence, not
    its length. The result is exact.
    """
    n_labels = emission.shape[1]
    if not len(emission):
        return np.empty((0, n_labels))
    move = np.exp(transition - transition.max())
    score = np.exp(emission - emission.max(axis=1, keepdims=True)).astype(np.float64)
    size = np.diff(edges)
    n_blocks = -(-size // BLOCK)
    first = np.concatenate([[0], np.cumsum(n_blocks)])  # blocks of each sequence
    begin = np.repeat(edges[:-1], n_blocks) + BLOCK * (
        np.arange(first[-1]) - np.repeat(first[:-1], n_blocks)
    )
    left = np.minimum(np.repeat(edges[1:], n_blocks) - begin, BLOCK)
    total, longest = int(first[-1]), int(left.max())
    at = begin[:, None] + np.arange(longest)
    there = np.arange(longest) < left[:, None]
    score = np.where(there[:, :, None], score[np.where(there, at, 0)], 1.0)

    # Nothing moves into the first position of a sequence.
    opens = np.zeros(total, bool)
    opens[first[:-1][n_blocks > 0]] = True

    def moved(x: np.ndarray, t: int) -> np.ndarray:
        if t:
            return x @ move
        return np.where(opens.reshape(-1, *[1] * (x.ndim - 1)), x, x @ move)

    whole = np.broadcast_to(np.eye(n_labels), (total, n_labels, n_labels)).copy()
    for t in range(longest):
        if not there[:, t].any():
            break
        stepped = _scaled(moved(whole, t) * score[:, None, t])
        whole = np.where(there[:, t, None, None], stepped, whole)

    # What enters each block from before and after, one block of every sequence at a time.
    enter = np.full((total, n_labels), 1.0 / n_labels)
    leave = np.full((total, n_labels), 1.0 / n_labels)
    for k in range(1, int(n_blocks.max())):
        on = first[:-1][n_blocks > k] + k
        enter[on] = _scaled(np.einsum("bi,bij->bj", enter[on - 1], whole[on - 1]))
    for k in range(int(n_blocks.max()) - 1, 0, -1):
        on = first[:-1][n_blocks > k] + k
        leave[on - 1] = _scaled(np.einsum("bij,bj->bi", whole[on], leave[on]))

    ahead = np.empty((longest, total, n_labels))
    now = enter
    for t in range(longest):
        now = np.where(there[:, t, None], _scaled(moved(now, t) * score[:, t]), now)
        ahead[t] = now
    out = np.empty((len(emission), n_labels))
    now = leave
    for t in range(longest - 1, -1, -1):
        mine = there[:, t]
        out[at[mine, t]] = _scaled(ahead[t, mine] * now[mine])
        now = np.where(mine[:, None], _scaled((score[:, t] * now) @ move.T), now)
    return out


def viterbi(emission: np.ndarray, edges: np.ndarray, transition: np.ndarray) -> np.ndarray:
    """The most probable labels of every sequence; of equal paths the one with lower labels."""
    size = np.diff(edges)
    order = np.argsort(-size, kind="stable")
    starts, size = edges[:-1][order], size[order]
    best = np.empty(emission.shape, np.float64)
    back = np.zeros(emission.shape, np.int8)
    longest = int(size.max(initial=0))
    for t in range(longest):
        on = starts[: np.searchsorted(-size, -t, "left")] + t  # sequences longer than t
        if t == 0:
            best[on] = emission[on]
        else:
            paths = best[on - 1][:, :, None] + transition
            back[on] = paths.argmax(axis=1)
            best[on] = paths.max(axis=1) + emission[on]
    labels = np.zeros(len(emission), np.int8)
    for t in range(longest - 1, -1, -1):
        n = np.searchsorted(-size, -t, "left")
        on = starts[:n] + t
        last = size[:n] == t + 1
        labels[on[last]] = best[on[last]].argmax(axis=1)
        inner = on[~last]
        labels[inner] = back[inner + 1, labels[inner + 1]]
    return labels


@dataclass(frozen=True)
class Features:
    """Active features of every position: ``index[offsets[i]:offsets[i + 1]]``."""

    index: np.ndarray
    offsets: np.ndarray

    def emissions(self, weights: np.ndarray) -> np.ndarray:
        sums = np.add.reduceat(
            np.concatenate([weights[self.index], np.zeros((1, weights.shape[1]), weights.dtype)]),
            np.minimum(self.offsets[:-1], len(self.index)), axis=0,
        ) if len(self.offsets) > 1 else np.zeros((0, weights.shape[1]), weights.dtype)
        sums[self.offsets[:-1] == self.offsets[1:]] = 0
        return sums

    @staticmethod
    def joined(parts: list["Features"]) -> "Features":
        before = np.cumsum([0] + [len(p.index) for p in parts])
        offsets = [p.offsets[:-1] + b for p, b in zip(parts, before)]
        index = [p.index for p in parts] or [np.empty(0, np.int32)]
        return Features(np.concatenate(index), np.concatenate([*offsets, before[-1:]]))

    def take(self, which: np.ndarray) -> "Features":
        size = (self.offsets[1:] - self.offsets[:-1])[which]
        offsets = np.concatenate([[0], np.cumsum(size)])
        inner = np.arange(offsets[-1]) - np.repeat(offsets[:-1], size)
        return Features(self.index[np.repeat(self.offsets[:-1][which], size) + inner], offsets)


@dataclass(frozen=True)
class Model:
    labels: list
    weights: np.ndarray
    transition: np.ndarray
    # What features need besides: plain arrays and lists.
    extra: tuple = ()

    @staticmethod
    def sent(docs: DataFrame, model: "Model | None"):
        """A broadcast of the parts of a model. Workers need not have this class to read it."""
        parts = None if model is None else _parts(model)
        return docs.sparkSession.sparkContext.broadcast(parts)

    @staticmethod
    def of(parts: tuple | None) -> "Model | None":
        return None if parts is None else Model(*parts)


def _parts(model: Model) -> tuple:
    return model.labels, model.weights, model.transition, model.extra


def fit_in_a_task(sample: DataFrame, fit: Callable[[pa.Table], Model | None]) -> Model | None:
    """``fit`` on a sample whose size its maker has bounded, by one task. The driver sees the model
    alone; neither the texts nor what training takes stay in its memory.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b for b in batches if b.num_rows]
        model = fit(pa.Table.from_batches(parts)) if parts else None
        if model is not None:
            data = pickle.dumps(_parts(model))
            yield pa.RecordBatch.from_pydict({"model": pa.array([data], pa.binary())})

    row = sample.repartition(1).mapInArrow(run, "model binary").first()
    return None if row is None else Model(*pickle.loads(row.model))


def train(
    features: Features,
    label: np.ndarray,
    edges: np.ndarray,
    labels: list,
    n_features: int,
    epochs: int = 4,
    batch: int = 64,
    rate: float = 0.2,
    seed: int = 7,
    position: np.ndarray | None = None,
) -> Model:
    """Weights that maximise the likelihood of labelled sequences, by AdaGrad over mini-batches.

    ``position`` says which features each element of the sequences has, if not those in its place.
    """
    position = np.arange(len(label)) if position is None else position
    n = len(labels)
    weights = np.zeros((n_features, n), np.float32)
    moved = np.full((n_features, n), 1e-6, np.float32)
    transition, moved_transition = np.zeros((n, n)), np.full((n, n), 1e-6)
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        order = rng.permutation(len(edges) - 1)
        for lo in range(0, len(order), batch):
            some = order[lo : lo + batch]
            size = np.diff(edges)[some]
            cut = np.concatenate([[0], np.cumsum(size)])
            which = np.repeat(edges[:-1][some], size) + np.arange(cut[-1]) - np.repeat(cut[:-1], size)
            mine, truth = features.take(position[which]), label[which]
            emission = mine.emissions(weights)
            wrong = -posteriors(emission, cut, transition)
            follows = np.ones(len(which), bool)
            follows[cut[:-1][size > 0]] = False
            pair = np.flatnonzero(follows)
            expected = _pairs(-wrong, pair, transition)
            wrong[np.arange(len(truth)), truth] += 1
            seen = np.zeros((n, n))
            np.add.at(seen, (truth[pair - 1], truth[pair]), 1)
            step = (seen - expected) / max(1, len(pair))
            moved_transition += step**2
            transition += rate * step / np.sqrt(moved_transition)
            count = np.diff(mine.offsets)
            touched, inverse = np.unique(mine.index, return_inverse=True)
            for k in range(n):
                g = np.bincount(inverse, np.repeat(wrong[:, k], count), len(touched)) / len(some)
                moved[touched, k] += g**2
                weights[touched, k] += rate * g / np.sqrt(moved[touched, k])
    return Model(list(labels), weights, transition)


def _pairs(posterior: np.ndarray, pair: np.ndarray, transition: np.ndarray) -> np.ndarray:
    """Expected transitions. The table of a pair is diag(a) exp(transition) diag(b) for some a and
    b; only one such table has the marginals of both ends, and scaling rows and columns in turn
    finds it.
    """
    table = np.broadcast_to(np.exp(transition), (len(pair), *transition.shape)).copy()
    for _ in range(8):
        table *= (posterior[pair - 1] / np.maximum(table.sum(axis=2), 1e-30))[:, :, None]
        table *= (posterior[pair] / np.maximum(table.sum(axis=1), 1e-30))[:, None, :]
    return table.sum(axis=0)
