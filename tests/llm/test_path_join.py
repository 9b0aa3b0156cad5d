"""The chosen-path join against a comparison of all pairs, also with tiny tree nodes."""
import os
import random
import sys

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(__file__))
import plain  # noqa: E402
from strata.llm import path_join  # noqa: E402
from strata.llm.common import roots  # noqa: E402

R = random.Random(23)
VOCAB = [f"w{i}" for i in range(300)]
SCHEMA = "doc_id long, text string, id int, nid int, n int, label int, path int, tokens int"
PASSAGE = " ".join(R.choice(VOCAB) for _ in range(60))


def changed(words, edits):
    w = list(words)
    for _ in range(edits):
        w[R.randrange(len(w))] = R.choice(VOCAB).upper()
    return " ".join(w)


def table():
    texts = [None, "", " \n", "one", "ONE", "two words", "Two\tWords", "a b c d e", "a b c d e f"]
    base = [R.choice(VOCAB) for _ in range(200)]
    texts += [changed(base, R.choice([0, 1, 2, 3, 4])) for _ in range(90)]  # a large group of near copies, some linked by way of others
    chain = [R.choice(VOCAB) for _ in range(150)]
    for _ in range(12):
        chain = changed(chain, 2).split()
        texts.append(" ".join(chain))
    texts += [PASSAGE + " " + " ".join(R.choice(VOCAB) for _ in range(R.randrange(5, 80))) for _ in range(60)]  # a shared passage, no copies
    texts += [" ".join(R.choice(VOCAB) for _ in range(R.randrange(1, 40))) for _ in range(40)]
    long = " ".join(R.choice(VOCAB) for _ in range(15_000))
    texts += [long, long + " tail", long.replace(" ", "\n", 5)]
    rows = list(enumerate(texts, 10))
    R.shuffle(rows)
    return rows + [rows[0], rows[0], (None, texts[30]), (None, "nobody else has this text"), (None, None), (3, texts[40])]


def frame(spark, rows):
    return spark.createDataFrame([(*r, 0, 0, 0, 0, 0, 0) for r in rows], SCHEMA)


@pytest.mark.parametrize("percent,node_size", [(85, 256), (80, 5)])
def test_components(spark, monkeypatch, percent, node_size):
    rows = table()
    if node_size < 256:
        for name, value in {"VISITORS": 7, "HOSTS": 16, "COLUMNS": 50, "NODE_SHINGLES": 2000}.items():
            monkeypatch.setattr(path_join, name, value)
    out = path_join.path_join(frame(spark, rows), percent=percent, node_size=node_size).collect()
    have = sorted(((r.id, r.n_shingles, r.component_id) for r in out), key=repr)
    want = sorted(plain.jaccard(rows, percent), key=repr)
    assert have == want and len({w[2] for w in want}) < len(want) - 60


def test_empty_and_unlinked_tables(spark):
    assert path_join.path_join(frame(spark, [])).count() == 0
    out = path_join.path_join(frame(spark, [(1, "a b c"), (2, None), (3, "d e f")])).collect()
    assert sorted((r.id, r.n_shingles, r.component_id) for r in out) == [(1, 1, 1), (2, 0, 2), (3, 1, 3)]


def test_trees_and_sketches_meet_their_chances():
    trees, least = path_join.tree_count(85, 3, 1e-7), path_join.least_agreement(85, 1e-7)
    assert (1 - 0.85**3) ** trees <= 1e-7 and 70 < least < 0.85 * path_join.FUNCTIONS
    g = np.random.default_rng(3)
    agree = []
    for _ in range(200):
        x = g.integers(0, 2**64, 100, dtype=np.uint64, endpoint=False)
        y = np.concatenate([x[:-8], g.integers(0, 2**64, 8, dtype=np.uint64)])  # 92 of 108 in common
        agree.append((path_join.minwise(x) == path_join.minwise(y)).mean())
    assert abs(np.mean(agree) - 92 / 108) < 0.01 and min(agree) * path_join.FUNCTIONS >= least


def test_intersections(monkeypatch):
    monkeypatch.setattr(path_join, "COLUMNS", 7)
    g = np.random.default_rng(4)
    sets = [np.unique(g.integers(0, 60, g.integers(0, 40))).astype(np.uint64) for _ in range(30)]
    rows, columns = np.arange(0, 30, 3), np.arange(5, 25)
    want = [[len(np.intersect1d(sets[i], sets[j])) for j in columns] for i in rows]
    assert path_join.intersections(sets, rows, columns).tolist() == want


def test_roots_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(200)] + [(5000, 5000), (7, 7), (2003, 2001), (2002, 2003)]
    out = roots(spark.createDataFrame(edges, "a long, b long"))
    want = {i: 0 for i in range(301)} | {1000 + i: 1000 for i in range(200)} | {2001: 2001, 2002: 2001, 2003: 2001}
    assert {r.nid: r.root for r in out.collect()} == want
    assert roots(spark.createDataFrame([], "a long, b long")) is None
