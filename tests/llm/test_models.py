"""The convolutional classifier and the boosted trees against plain loops."""

import numpy as np
import pytest

from tidemark.llm import quality_trees, toxicity

TEXTS = ["a b c d e", "", "one", "x y", "some more words here and there", "b a", "z"]


def drawn_model(seed=1):
    model = toxicity.Model.new(seed)
    draw = np.random.default_rng(seed)
    model.vectors[:] = draw.normal(0, 1, model.vectors.shape)
    model.vectors[-1] = 0
    for b in model.biases:
        b[:] = draw.normal(0, 0.3, b.shape)
    model.middle = 0.2
    return model


def plain_logit(model, words):
    """One text's logit, place by place and filter by filter; words: its buckets."""
    zero = np.zeros(2 * toxicity.DIM)
    x = [np.concatenate([model.vectors[a, : toxicity.DIM], model.vectors[b, toxicity.DIM :]]) for a, b in words]
    total, k = -model.middle, 0
    for kernel, bias in zip(model.kernels, model.biases, strict=True):
        for f in range(toxicity.FILTERS):
            best = 0.0
            for place in range(max(1, len(x))):
                value = bias[f] + sum(float((x[place + j] if place + j < len(x) else zero) @ kernel[j][:, f]) for j in range(len(kernel)))
                best = max(best, value)
            total += best * model.weights[k]
            k += 1
    return total


def test_scores_equal_a_plain_forward_pass_and_know_no_neighbours():
    model, data = drawn_model(), toxicity.Texts.of(TEXTS)
    want = [plain_logit(model, data.words[data.first[i] : data.first[i + 1]]) for i in range(len(TEXTS))]
    assert data.logits(model, np.arange(len(TEXTS))) == pytest.approx(want, rel=1e-4, abs=1e-4)
    assert data.logits(model, np.arange(len(TEXTS))[::-1]) == pytest.approx(want[::-1], rel=1e-4, abs=1e-4)
    assert [data.logits(model, np.array([i]))[0] for i in range(len(TEXTS))] == pytest.approx(want, rel=1e-4, abs=1e-4)


class Taken:
    """Stands in for Adam: keeps the gradients and changes nothing."""

    def __init__(self):
        self.grads, self.table = {}, None

    def begin(self):
        pass

    def step(self, name, grad):
        self.grads[name] = np.array(grad)
        return np.zeros_like(grad)

    def rows(self, table, part, where, slope):
        self.table = np.zeros_like(table) if self.table is None else self.table
        np.add.at(self.table[:, part], where, slope)


def test_gradients_equal_differences_of_the_loss():
    model, data = drawn_model(4), toxicity.Texts.of(TEXTS)
    for name in ("vectors", "weights"):
        setattr(model, name, getattr(model, name).astype(np.float64))
    model.kernels, model.biases = ([a.astype(np.float64) for a in x] for x in (model.kernels, model.biases))
    label, weight = np.array([1, 0, 1, 0, 1, 0, 1.0]), np.array([1, 2, 1, 1, 3, 1, 1.0])
    rows, begins = data.batch(np.arange(len(TEXTS)))

    def loss():
        p = 1 / (1 + np.exp(-toxicity.logits(model, rows, begins)))
        return float(-(weight * (label * np.log(p) + (1 - label) * np.log(1 - p))).mean())

    taken = Taken()
    toxicity._step(model, rows, begins, label, weight, taken)
    bucket = int(rows[0, 0])
    for array, at, got in [
        (model.weights, (3,), taken.grads["weights"][3]), (model.biases[1], (2,), taken.grads["bias1"][2]), *[(model.kernels[k], (j, 5, 1), taken.grads[f"kernel{k}"][j, 5, 1]) for k in range(3) for j in range(k + 1)],
        (model.vectors, (bucket, 2), taken.table[bucket, 2]),
    ]:
        kept, ends = array[at], []
        for step in (1e-6, -1e-6):
            array[at] = kept + step
            ends.append(loss())
        array[at] = kept
        assert got == pytest.approx((ends[0] - ends[1]) / 2e-6, rel=1e-3, abs=1e-6)


def plain_split(x, grad, hess, leaf, ridge):
    """(gain, feature, threshold) of the best cut, by trying every one between two values."""
    best = (1e-6, None, None)
    g, h = grad.sum(), hess.sum()
    for j in range(x.shape[1]):
        values = np.unique(x[:, j])
        for low, high in zip(values[:-1], values[1:], strict=True):
            left = x[:, j] <= (low + high) / 2
            if min(left.sum(), (~left).sum()) < leaf:
                continue
            gl, hl = grad[left].sum(), hess[left].sum()
            gain = gl**2 / (hl + ridge) + (g - gl) ** 2 / (h - hl + ridge) - g**2 / (h + ridge)
            if gain > best[0] * (1 + 1e-9):
                best = (gain, j, (low + high) / 2)
    return best


def test_trees_equal_plain_splits_and_walks():
    draw = np.random.default_rng(3)
    x = draw.integers(0, 12, (120, 4)).astype(float)
    label = ((x[:, 0] > 5) ^ (x[:, 1] > 7) | (draw.random(120) < 0.1)).astype(float)
    weight = draw.choice([1.0, 2.0], 120)
    made = quality_trees.grow(x, label, weight, trees=3, leaf=5.0, ridge=1.0)
    z = np.full(120, made.base)
    share = ((label * weight).sum() + 0.5) / (weight.sum() + 1)
    assert made.base == pytest.approx(np.log(share / (1 - share)))
    for root in made.roots.tolist():
        p = 1 / (1 + np.exp(-z))
        grad, hess = (p - label) * weight, p * (1 - p) * weight
        queue = [(root, np.arange(120), 0)]
        while queue:
            node, rows, depth = queue.pop()
            leaf_here = made.left[node] == node
            gain, j, threshold = plain_split(x[rows], grad[rows], hess[rows], 5.0, 1.0)
            if leaf_here:
                assert depth == quality_trees.DEPTH or hess[rows].sum() < 2 or j is None
                assert made.value[node] == pytest.approx(-quality_trees.RATE * grad[rows].sum() / (hess[rows].sum() + 1.0))
                z[rows] += made.value[node]
            else:
                low = x[rows, j] <= threshold
                assert made.feature[node] == j and gain > 0 and ((x[rows, j] <= made.threshold[node]) == low).all()
                queue += [(made.left[node], rows[low], depth + 1), (made.right[node], rows[~low], depth + 1)]
    assert made.logits(x) == pytest.approx(z)
