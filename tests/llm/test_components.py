"""Components against a brute-force search, in one step and with links that come later."""

from __future__ import annotations

import random

from tidemark.llm.components import connected_components, joined_components


def _roots(links):
    root = {n: n for e in links for n in e if e[0] != e[1]}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            if a != b and root[a] != root[b]:
                root[a] = root[b] = min(root[a], root[b])
                changed = True
    return root


def test_components_with_later_links(spark, tmp_path):
    rng = random.Random(5)
    first = [(rng.randrange(300), rng.randrange(300)) for _ in range(150)] + [(1000, 1000 + k) for k in range(1, 40)] + [(7, 7), (1001, 1000)]
    later = [(rng.randrange(400), rng.randrange(400)) for _ in range(40)] + [(1005, 2000), (2000, 2001), (5, 1039)] * 2
    frame = lambda rows: spark.createDataFrame(rows, "a long, b long")
    rows = lambda df: sorted((r.node, r.root) for r in df.collect())
    one = connected_components(frame(first), f"file://{tmp_path}/one")
    assert rows(one) == sorted(_roots(first).items())
    assert rows(joined_components(one, frame(later), f"file://{tmp_path}/two")) == sorted(_roots(first + later).items())
    assert rows(connected_components(frame([]), f"file://{tmp_path}/none")) == []
