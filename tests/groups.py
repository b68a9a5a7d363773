"""Groups of unit vectors whose cosines are known beforehand."""

import numpy as np

DIM = 64


def axis(k, dim=DIM):
    return np.eye(dim)[k]


def between(a, b, cosine):
    """The vector in the plane of two orthogonal unit vectors that has this cosine to the first."""
    return cosine * a + np.sqrt(1 - cosine * cosine) * b


def fan(centre, n, cosine, first):
    """``n`` vectors with this cosine to ``centre``, each leaning to an axis of its own from ``first`` on, so with its square to each other."""
    return np.stack([between(centre, axis(first + k, len(centre)), cosine) for k in range(n)])


def scattered(rng, n, dim=8):
    """Random directions."""
    turns = np.linalg.qr(rng.normal(size=(n, dim, dim)))[0]
    return turns[:, :, 0]


def turned_fan(rng, n, cosine, strangers=0, dim=DIM):
    """A fan in a random turn of the axes, and then ``strangers`` at right angles to all of it."""
    turn = np.linalg.qr(rng.normal(size=(dim, dim)))[0]
    return np.vstack([fan(axis(0, dim), n, cosine, 1), *[axis(n + 1 + k, dim)[None] for k in range(strangers)]]) @ turn


def rows(groups):
    return [(g, f"i{k:03d}", [float(x) for x in v]) for g, vs in groups.items() for k, v in enumerate(vs)]
