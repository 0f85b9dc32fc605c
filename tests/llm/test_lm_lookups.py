"""Context totals of the language model: equal to brute force, with one search for each context."""

import numpy as np

from eventide.llm import ngram_lm as L


def _save(folder, name, array):
    array.tofile(f"{folder}/{name}")


def test_contexts(tmp_path, monkeypatch):
    rng, folder = np.random.default_rng(3), str(tmp_path)
    sizes = {2: 1, 5: L.SHORT, 6: L.SHORT + 1, 9: 1, 11: 40, 14: 2, 20: L.SHORT + 1, 21: L.SHORT}      # keys by context
    keys = np.array([c << 32 | w for c, n in sizes.items() for w in sorted(rng.choice(1000, n, replace=False).tolist())], np.uint64)
    counts = rng.choice([1, 2, 3, 4, 254, 255, 70_000], len(keys))
    ctx = (keys >> np.uint64(32)).astype(np.int64)
    want = {c: [int(counts[ctx == c].sum()), *(int((np.minimum(counts[ctx == c], 3) == k).sum()) for k in (1, 2, 3))] for c in sizes}
    stored = [c for c, n in sizes.items() if n > L.SHORT]
    big = np.flatnonzero(counts >= 255)
    for name, array in (("key", keys), ("count", np.minimum(counts, 255).astype("u1")), ("count.at", big.astype("<u8")),
                        ("count.big", counts[big].astype("<u8"))):
        _save(folder, f"gram2-0.{name}", array)
    _save(folder, "context2-0.id", np.array(stored, "<u4"))
    _save(folder, "context2-0.stats", np.array([want[c] for c in stored], "<u8"))
    model = L.Model(folder, 0, np.zeros(1, np.int64), 1, 1)
    model.levels[2] = L.Level(np.zeros(0, np.uint64), np.zeros((0, 4), np.int64), np.zeros(1, np.int64))
    asked = np.array([*range(25), *range(25), 2 ** 31], np.uint64)

    sought, search = [], np.searchsorted
    monkeypatch.setattr(np, "searchsorted", lambda a, v, *more: sought.append(np.size(v) * (len(a) == len(keys))) or search(a, v, *more))
    got, near = model.contexts(2, asked)
    once = sum(sought)
    of = near[np.searchsorted(asked[:25], ctx.astype(np.uint64))]
    ids, n = model.grams(2, np.concatenate((keys, keys + np.uint64(1000))), counts=True, near=np.concatenate((of, of)))
    monkeypatch.undo()
    assert ids.tolist() == [*range(len(keys)), *[-1] * len(keys)] and n.tolist() == [*counts.tolist(), *[0] * len(keys)]
    # the keys of a short context are next to its first: no search
    assert sum(sought) - once == 2 * int(np.isin(ctx, stored).sum())
    assert got.tolist() == [want.get(int(c), [0] * 4) for c in asked]
    assert once == len(np.unique(asked))
