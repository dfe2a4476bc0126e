"""Pairs of terms that say nothing alone."""

import numpy as np

from fasor.llm import toxicidade


def test_machine_learns_a_pair_of_neutral_terms():
    """Toxic with both terms or with none: the presence of either is independent of the label."""
    gerador = np.random.default_rng(4)
    listas, y = [], []
    for i in range(3000):
        a, b = i % 4 in (0, 1), i % 4 in (0, 2)
        listas.append(np.unique(np.concatenate([[1] * a, [2] * b, gerador.integers(10, 400, 5)]).astype(np.int64)))
        y.append(float(a == b))
    y = np.array(y)
    assert not toxicidade._dependentes(listas, y)[[1, 2]].any()
    m = toxicidade.treina(listas, y, np.ones(3000))
    um, dois, ambos = (m.pontua(np.zeros(len(t), int), np.array(t), 1)[0] for t in ([1], [2], [1, 2]))
    assert um < 0.3 and dois < 0.3 and ambos > 0.7
    assert m.uteis.sum() < 10


def test_pairs_by_chance_get_nothing():
    gerador = np.random.default_rng(5)
    listas = [np.unique(gerador.integers(0, 300, 20)) for _ in range(2000)]
    y = (gerador.random(2000) < 0.3).astype(float)
    assert not toxicidade._em_pares(listas, y - 0.3, np.full(2000, 0.21)).any()
