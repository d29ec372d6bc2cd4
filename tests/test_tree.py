"""The walk of folders against a plain depth-first one."""

import random

from tidemill.sources import landed


def plain(cards, share, most):
    below = {}
    for c in sorted((c for c in cards if c[0] == share and c[4]), key=lambda c: c[5]):
        below.setdefault(c[1], []).append(c)
    seen, todo = {}, [(share, [], [])]
    while todo and len(seen) < most:
        folder, path, order = todo.pop()
        if folder in seen:
            continue
        seen[folder] = (path, order)
        todo += [(c[2], [*path, c[3]], [*order, c[5]]) for c in reversed(below.get(folder, []))]
    return [(share, c[2], c[3], tuple(seen[c[1]][0]), (*seen[c[1]][1], c[5])) for c in cards if c[0] == share and not c[4] and c[1] in seen]


def test_walks_with_cycles_repeats_and_caps(spark):
    rng = random.Random(7)
    cards, pos = [], 0
    for share, folders in (("a", 40), ("b", 5), ("c", 120), ("empty", 0)):
        for _ in range(3 * folders):  # any folder in any folder, again and again
            cards.append((share, rng.choice([share] + [f"f{k}" for k in range(folders)]), f"f{rng.randrange(folders)}", f"n{pos}", True, pos))
            pos += 1
        for k in range(2 * folders + 1):
            cards.append((share, rng.choice([share] + [f"f{k}" for k in range(folders)]), f"leaf{k}", "x", False, pos))
            pos += 1
    cards.append(("a", "nowhere", "lost", "x", False, pos))
    df = spark.createDataFrame(cards, "share string, parent string, id string, name string, is_folder boolean, pos int").repartition(3)
    for most in (1000, 25):
        got = sorted((r["share"], r["id"], r["name"], tuple(r["path"]), tuple(r["ord"])) for r in landed.tree_leaves(df, most_folders=most).collect())
        assert got == sorted(x for s in ("a", "b", "c", "empty") for x in plain(cards, s, most))
