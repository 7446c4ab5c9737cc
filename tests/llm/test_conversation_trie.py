"""Operator 11 against brute force: rebuilt and plain conversations, deep and wide tries, odd rows."""

import hashlib
import zlib

import numpy as np
import pytest

from reelstats.llm import conversation_trie as trie

SCHEMA = "conv_id long, turn int, role string, text string, key1 string, depth string, total long"


def brute(rows, openings):
    turns = {}
    for c, t, role, text in rows:
        if c is not None:
            turns.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in turns.items()}
    whole = {}
    for c, seq in own.items():
        if openings:
            h = zlib.crc32(str(c).encode()) % 6
            seq = own.get(c - int(np.fmod(c, 100)), [])[:h] + seq[h:]
        whole[c] = tuple(seq)
    nodes = {}
    for c, seq in whole.items():
        for d in range(len(seq) + 1):
            nodes.setdefault(seq[:d], []).append(c)
    leaves, saved, children = dict.fromkeys(nodes, 0), dict.fromkeys(nodes, 0), dict.fromkeys(nodes, 0)
    for k in nodes:
        if k:
            children[k[:-1]] += 1
    for k, m in nodes.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += not children[k]
            saved[k[:d]] += (len(m) - 1) * len(k[-1][1]) if k else 0
    out = []
    for k, m in nodes.items():
        ends = ",".join(str(c) for c in sorted(c for c in m if len(whole[c]) == len(k)))
        out.append((min(m), len(k), min(nodes[k[:-1]]) if k else None, len(m), children[k], leaves[k], saved[k], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "k", "d", 1) for r in rows], SCHEMA).repartition(4)


def got(df):
    assert df.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r) for r in df.collect()), key=repr)


def odd_rows():
    rng = np.random.RandomState(4)
    rows = [(c, t, "ua"[t % 2], f"t{rng.randint(0, 3)}é") for c in [*range(98, 104), 100, 200, 205, 299, 300, 1234, -5, -101, -100] for t in range(rng.randint(1, 9))]
    rows += [(7, None, None, None), (7, None, "u", "x"), (7, 0, None, "x"), (7, 0, "a", None), (7, 0, "a", None), (8, 0, "u", ""), (None, 0, "u", "lost"), (None, None, None, None)]
    # turnless after the rebuild: the lender is absent and c is skipped whole
    gone = next(c for c in range(501, 600) if zlib.crc32(str(c).encode()) % 6 > 1)
    return rows + [(gone, 0, "u", "a"), (gone, 1, "a", "b")]


@pytest.mark.parametrize("openings", [False, True])
def test_odd_conversations(spark, openings):
    rows = odd_rows()
    assert got(trie.prefix_trie(frame(spark, rows), openings)) == brute(rows, openings)


def test_empty_and_turnless(spark):
    empty = frame(spark, odd_rows()).limit(0)
    assert got(trie.prefix_trie(empty, True)) == []
    gone = next(c for c in range(501, 600) if zlib.crc32(str(c).encode()) % 6 > 1)
    rows = [(gone, 0, "u", "a")]
    assert got(trie.prefix_trie(frame(spark, rows), True)) == brute(rows, True) == [(gone, 0, None, 1, 0, 1, 0, hashlib.sha256(str(gone).encode()).hexdigest())]


def test_splitting_by_joins_and_long_conversations(spark, monkeypatch):
    """A tree above part_nodes is split in rounds; a conversation longer than a stretch and an end shared by many."""
    monkeypatch.setattr(trie, "BLOCK_BYTES", 12)
    rows = [(1, t, "u", "same" if t % 5 else f"x{t}") for t in range(40)]
    rows += [(2, t, "u", "same" if t % 5 else f"x{t}") for t in range(33)] + [(2, 40, "a", "b")]
    rows += [(c, t, "u", f"x{t}" if t == 0 else f"y{c % 3}") for c in range(10, 24) for t in range(c % 4 + 1)]
    rows += [(c, 0, "u", "alone") for c in range(30, 60)]
    want = brute(rows, False)
    assert got(trie.prefix_trie(frame(spark, rows), part_nodes=12, stretch=8)) == want
    assert got(trie.prefix_trie(frame(spark, rows), stretch=8)) == want


def test_decompose_equals_a_walk():
    rng = np.random.RandomState(2)
    for n, reach in ((1, 1), (2, 1), (50, 1), (300, 3), (300, 300), (2000, 40)):
        parent = np.array([-1 if i == 0 or rng.rand() < 0.02 else rng.randint(max(0, i - reach), i) for i in range(n)])
        depth, own = np.zeros(n, np.int64), rng.randint(1, 5, n)
        for i in range(n):
            depth[i] = 0 if parent[i] < 0 else depth[parent[i]] + 1
        values, added = rng.randint(0, 9, (n, 2)), rng.randint(0, 3, (n, 2))
        weight, sums = own.copy(), values.copy()
        for i in range(n - 1, -1, -1):
            if parent[i] >= 0:
                weight[parent[i]] += weight[i]
                sums[parent[i]] += sums[i]
        assert np.array_equal(trie.decompose(parent, depth, weight, values, added), sums + added)


def test_parents_with_equal_first_halves():
    key = np.array([[1, 1], [1, 2], [1, 3], [2, 1]])
    assert trie._parents(key, np.array([[0, 0], [1, 1], [1, 9], [1, 3]])).tolist() == [-1, 0, -1, 2]
