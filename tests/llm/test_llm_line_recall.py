import collections
import itertools
import random

import cases
import pytest
from test_llm_line_dedup import edits

from ldspark.llm import line_dedup as d


def changed(words, n, how, rng):
    out = list(words)
    for k in range(n):
        at = rng.randrange(len(out))
        if how == "delete":
            del out[at]
        else:
            out[at : at + (how == "replace")] = [f"x{rng.randrange(10**6)}"]
    return out


def similar(a, b):
    a, b = a.split(" "), b.split(" ")
    longest = max(len(a), len(b))
    return min(len(a), len(b)) >= 5 and 5 * edits(a, b) <= longest


@pytest.mark.parametrize("how", ["replace", "insert", "delete"])
def test_every_pair_of_the_similarity_is_linked(spark, how):
    rng = random.Random(how)
    lines = []
    for n, k in ((5, 1), (8, 1), (9, 1), (10, 2), (20, 1), (20, 4), (30, 6), (100, 20)):
        for _ in range(12):
            words = [f"w{rng.randrange(10**6)}" for _ in range(n)]
            lines += [" ".join(words), " ".join(changed(words, k, how, rng))]
    # Words that stand again and again, and lines of few words.
    lines += ["a a a a a", "a a a a b", "b a a a a a", "x y x y x y x y x y", "x y x y z y x y x y", "a b c d", "a b c e"]
    rows = [(i, line, None, None, 0) for i, line in enumerate(dict.fromkeys(lines))]
    links = [(x[0], y[0]) for x, y in itertools.combinations(rows, 2) if similar(x[1], y[1])]
    assert len(links) > 50
    keep = cases.groups(links, [x[0] for x in rows])
    sizes = collections.Counter(keep.values())
    found = {r.id: (r.keep_id, r.group_lines) for r in d.dedup_lines(cases.frame(spark, rows)).collect()}
    assert found == {i: (keep[i], sizes[keep[i]]) for i, *_ in rows}
