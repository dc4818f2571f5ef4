"""Embedding near-dedup: Hamming pruning, and recall of planted pairs."""

from __future__ import annotations

import math

import numpy as np
import pytest

from ebbflow.llm import embedding_dedup


def brute(x, cosine=0.95):
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = unit @ unit.T >= cosine
    np.fill_diagonal(near, False)
    return near


def planted(seed, pairs, dims, cluster):
    """Vectors with a partner at a cosine of 0.9501 to 0.99, a tight cluster, and plain ones."""
    rng = np.random.default_rng(seed)
    a = rng.normal(size=(pairs, dims))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    side = rng.normal(size=(pairs, dims))
    side -= (side * a).sum(axis=1, keepdims=True) * a
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    c = rng.uniform(0.9501, 0.99, (pairs, 1))
    b = c * a + np.sqrt(1 - c * c) * side
    base = rng.normal(size=dims)
    tight = base + rng.normal(size=(cluster, dims)) * 0.15
    return np.concatenate([a, b * 3, tight, rng.normal(size=(pairs, dims))])


def test_codes_pack_and_unpack():
    import pyarrow as pa
    keys = np.random.default_rng(1).integers(0, 1 << 11, (50, 17))
    packed = embedding_dedup.pack(keys, 11)
    assert packed.shape[1] % 8 == 0
    assert (embedding_dedup.unpack(pa.array([r.tobytes() for r in packed], pa.binary()), 11, 17) == keys).all()


@pytest.mark.parametrize("within", [True, False])
def test_near_codes_against_all_pairs(within):
    import pyarrow as pa
    rng = np.random.default_rng(3)
    keys = rng.integers(0, 16, (60, 12))
    keys[30:] = keys[:30] ^ (rng.random((30, 12)) < 0.7)  # one bit of most substrings differs
    code = embedding_dedup.pack(keys, 4)
    words = np.frombuffer(code.tobytes(), np.uint64).reshape(60, -1)
    side = np.full(60, 2) if within else np.repeat([0, 1], 30)
    want = np.zeros(60, bool)
    for i in range(60):
        for j in range(i + 1, 60):
            bits = sum(bin(int(a ^ b)).count("1") for a, b in zip(keys[i], keys[j]))
            if (within or side[i] != side[j]) and bits <= 9 and not (keys[i, :3] == keys[j, :3]).any():
                want[i] = want[j] = True
    got = embedding_dedup.near_codes(words, keys, side, 3, 9)
    assert (got == want).all() and 0 < want.sum() < 60


@pytest.mark.parametrize("kind,dims,cell", [("double", 64, 1024), ("float", 64, 64), ("float", 8, 256)])
def test_planted_pairs(spark, monkeypatch, kind, dims, cell):
    monkeypatch.setattr(embedding_dedup, "CELL", cell)
    x = planted(7, 700, dims, 150)
    if kind == "float":
        x = x.astype(np.float32).astype(np.float64)
    df = spark.createDataFrame([(k, v.tolist(), 1, "c") for k, v in enumerate(x)], f"vec_id long, embedding array<{kind}>, many int, code string")
    want = brute(x)
    got = {r.vec_id: r for r in embedding_dedup.near_duplicates(df).collect()}
    n = np.array([got[k].n_links for k in range(len(x))])
    assert (n <= want.sum(axis=1)).all()
    assert n.sum() >= 0.99 * want.sum() and want.sum() > 1400
    assert np.mean([got[k].component_id != k for k in range(700, 1400)]) >= 0.99


def test_reach_prunes_unlike_codes():
    bits, tables = embedding_dedup.tables_for(10 ** 6, 0.95)
    most = embedding_dedup.reach(bits * tables, 64, 0.95)
    mean = bits * tables * math.acos(0.95) / math.pi
    assert mean < most < bits * tables / 3
