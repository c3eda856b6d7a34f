"""Large groups of near copies: few pairs are verified, no link is lost, and a key has one name however its documents meet."""

import random

import numpy as np
from test_models_and_joins import brute_components

from tallyforge.llm import parity_join as pj


def test_pairs_of_a_group_are_not_all_verified(spark, monkeypatch):
    toss, rows = random.Random(2), []
    for member in range(240):
        words = [f"w{k}" for k in range(100)]
        for place in toss.sample(range(100), 1 if member < 160 else 2):
            words[place] = f"v{member}_{place}"
        rows.append((member, " ".join(words)))
    seen, verified = [], pj.verified

    def counted(pairs, *more):
        seen.append(pairs.count())
        return verified(pairs, *more)

    monkeypatch.setattr(pj, "verified", counted)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in pj.parity_join(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == brute_components(rows)
    assert sum(seen) < 10 * len(rows)  # 12,000 pairs link


def test_linked_sets_share_a_key_that_neither_may_leave_out():
    random_, join = np.random.default_rng(4), pj.Join()
    for _ in range(400):
        n = int(random_.integers(1, 120))
        a = np.unique(random_.integers(0, 1 << 63, n).astype(np.uint64))
        changed = int(random_.integers(0, max(1, n // 4) + 1))
        b = np.unique(np.concatenate([a[: n - changed // 2], random_.integers(0, 1 << 63, changed - changed // 2).astype(np.uint64)]))
        if 100 * len(np.intersect1d(a, b)) < 80 * len(np.union1d(a, b)):
            continue
        kept = []
        for x in (a, b):
            key, spare = pj.part_keys(x, join)
            rank = np.lexsort((key, key % 97))  # any order that both have in common
            odd = (key[rank] >> np.uint64(1)) & np.uint64(1)
            kept.append(np.concatenate([key[rank][odd == kind][spare[kind] :] for kind in (0, 1)]))
        assert len(np.intersect1d(*kept))


def test_a_hot_key_has_one_name():
    key = np.array([1 << 63 | 12345 << 20 | 6, 987654321987654321], np.uint64)
    many = list(pj.handed_over([key] * pj.HOT, list(range(pj.HOT)), 7, 7))
    hot = next(b for b in many if b.column("what")[0].as_py() == pj.MEMBERS)
    names = set(np.frombuffer(hot.column("x")[0].as_py(), np.uint64).tolist())
    rows = next(b for b in many if b.column("what")[0].as_py() == pj.KEYS).to_pylist()
    lows = set()
    for r in rows:
        n = int(np.frombuffer(r["x"], "<u4", 1)[0])
        lows |= {(r["slice"], int(k)) for k in np.frombuffer(r["x"], "<u4", n, 8)}
    assert names == {s << 32 | low for s, low in lows}
