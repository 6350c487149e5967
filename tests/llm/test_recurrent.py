"""The network's way back against differences of the loss."""

import numpy as np

from shelfmark.llm.recurrent import Network, Trainer


def test_gradients_are_slopes_of_the_loss():
    """Over windows with documents of uneven length, several in a lane, and over full windows."""
    rng = np.random.default_rng(4)
    for sizes, lanes in ((rng.integers(1, 17, 30), 256), (np.full(20, 16), 256), (np.full(24, 4), 6)):
        n = int(sizes.sum())
        items = rng.integers(0, 36, n)
        classes, words = np.where(items < 24, items // 8, items - 21), np.where(items < 24, items % 8, -1)
        priors = rng.random(15) + 0.5, rng.random((3, 8)) + 0.5
        network = Network.new(36, priors[0] / priors[0].sum(), priors[1] / priors[1].sum(axis=1, keepdims=True))
        trainer, found = Trainer(network), []
        trainer._step = found.append
        trainer.learn(sizes, items, classes, words, 5, lanes)
        assert len(found) == 1 and set(found[0]) == set(network.weights)
        for name, slope in found[0].items():
            size = float(np.sqrt((slope.astype(float) ** 2).sum()))
            at, loss = network.weights[name].copy(), []
            for step in (0.05, -0.05):
                network.weights[name] = at + np.float32(step / size) * slope
                loss.append(-network.score(sizes, items, classes, words, 5, lanes).astype(float).mean())
            network.weights[name] = at
            assert abs((loss[0] - loss[1]) / 0.1 - size) < 0.02 * size + 1e-4, name
