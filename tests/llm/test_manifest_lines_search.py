"""Merkle proofs, line dedup and ranked search against plain Python, with their edge cases."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import linededup, merkle, ranked

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, g string, key string, n long, node string, path string, line string, pos int, doc string, gone string, lines string, item string, id string, rank int"
EXTRA = ("g", "k", 1, "n", "p", "l", 2, "d", "o", "s", "i", "x", 3)


def table(spark, rows):
    return spark.createDataFrame([(*r, *EXTRA) for r in rows], SCHEMA)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(*fields):
    return sha("".join("-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields))


def tree(digests):
    """The top, and the (before, after) of each leaf at each level."""
    paths, level, where = [[] for _ in digests], list(digests), list(range(len(digests)))
    while len(level) > 1:
        for p, w in zip(paths, where):
            run = level[w // 8 * 8 : w // 8 * 8 + 8]
            p.append(("".join(run[: w % 8]), "".join(run[w % 8 + 1 :])))
        level = [sha("".join(level[k : k + 8])) for k in range(0, len(level), 8)]
        where = [w // 8 for w in where]
    return level[0], paths


def manifest(rows, presented):
    groups = defaultdict(list)
    for doc_id, text, lang, source, n_chars in rows:
        other = leaf(doc_id, source, lang, n_chars, presented(doc_id, text))
        groups[lang].append((doc_id is not None, doc_id or 0, leaf(doc_id, source, lang, n_chars, text), doc_id, other))
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    made = {x: tree([r[2] for r in sorted(groups[x], key=lambda r: r[:3])]) for x in langs}
    root, upper = tree([made[x][0] for x in langs])
    out = []
    for x, above in zip(langs, upper):
        for r, path in zip(sorted(groups[x], key=lambda r: r[:3]), made[x][1]):
            held = r[4]
            for before, after in path + above:
                held = sha(before + held + after)
            out.append((r[3], r[2], made[x][0], root, sha("".join(a + b for a, b in path + above)), held, held == root))
    return out


@pytest.mark.parametrize("parts", [1, 7])
def test_manifest(spark, parts):
    rows = [(i, f"Text {i}", "big", "s", i) for i in range(1200)] + [(1500 + i, "T" * i, "nine", None, None) for i in range(9)]
    rows += [(1600 + i, None, "eight", "s", 1) for i in range(8)] + [(1700, "Only", "one", "s", 1), (1701, "", "", "s", 1), (1702, "Null", None, "s", 1)]
    rows += [(None, "No id", "big", "s", 1), (3, "Again", "big", "s", 1), (3, "Again", "big", "s", 1), (4, "é" * 50_000, "nine", "ü", 1)]
    tampered = (F.col("doc_id") % 2 == 0) & F.col("text").isNotNull()
    got = merkle.proofs(table(spark, rows).repartition(parts), presented={"text": F.when(tampered, F.translate("text", linededup.UPPER, linededup.LOWER)).otherwise(F.col("text"))})
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "path", "folded_root", "verified"]
    got = [tuple(r) for r in got.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("path")), "folded_root", "verified").collect()]
    assert Counter(got) == Counter(manifest(rows, lambda i, t: t.translate(LOWER) if i is not None and i % 2 == 0 and t is not None else t))
    assert 0 < sum(r[-1] for r in got) < len(got)


def test_manifest_of_little(spark):
    assert merkle.proofs(table(spark, [])).count() == 0
    one = merkle.proofs(table(spark, [(1, "a", "en", "s", 1)])).first()
    assert one["leaf"] == one["subroot"] == one["root"] == one["folded_root"] and one["path"] == [] and one["verified"]


def test_manifest_of_many_groups_and_a_repeated_row(spark):
    rows = [(i, f"t{i}", f"lang{i}", "s", 1) for i in range(700)] + [(7, "same", "en", "s", 1)] * 600
    got = Counter(tuple(r) for r in merkle.proofs(table(spark, rows)).select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("path")), "folded_root", "verified").collect())
    assert got == Counter(manifest(rows, lambda i, t: t))


def deduplicated(rows, least_documents, least_chars):
    key = lambda line: line.strip(linededup.BLANKS).translate(LOWER)
    found = defaultdict(set)
    for r in rows:
        for line in (r[1] or "").split("\n"):
            if len(key(line)) >= max(1, least_chars):
                found[key(line)].add((r[0], r[1]))
    common = {k for k, docs in found.items() if len(docs) >= least_documents}
    out = []
    for r in rows:
        lines = (r[1] or "").split("\n")
        kept = [x for x in lines if key(x) not in common]
        out.append((r[0], "\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


LINES = [(i, f"Header \nbody {i}\n\t FOOTER\x0b\n\nheader\n", "en", "s", 1) for i in range(12)]
LINES += [(20, None, "en", "s", 1), (21, "", "en", "s", 1), (22, "\n\n", "en", "s", 1), (23, "header", "en", "s", 1), (None, "footer\nx", "en", "s", 1), (None, "footer\ny", "en", "s", 1)]
LINES += [(30, "rare\ntwice", "en", "s", 1)] * 5 + [(31, "rare", "en", "s", 1), (32, "İI É footer \n É\né", "en", "s", 1), (32, "footer \r\nrare", "en", "s", 1)]
LINES += [(40, "\n".join(["header", "own line"] * 20_000), "en", "s", 1), (41, "word " * 100_000 + "\nFooter", "en", "s", 1)]


@pytest.mark.parametrize(("least_documents", "least_chars", "hot"), [(10, 1, 4096), (2, 1, 4096), (3, 5, 2), (1, 1, 4096), (2, 1, 1)])
def test_lines(spark, monkeypatch, least_documents, least_chars, hot):
    monkeypatch.setattr(linededup, "HOT_KEYS", hot)
    got = linededup.without_common_lines(table(spark, LINES).repartition(3), least_documents, least_chars)
    assert got.columns == ["doc_id", "kept", "n_lines", "n_dropped"]
    assert Counter(map(tuple, got.collect())) == Counter(deduplicated(LINES, least_documents, least_chars))


def test_lines_of_nothing(spark):
    assert linededup.without_common_lines(table(spark, [])).count() == 0


def test_lines_run_in_the_jvm(spark):
    plan = linededup.without_common_lines(table(spark, LINES))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|ArrowEval", plan)


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def ranking(rows, items, k):
    docs = [(r[0], Counter(terms(r[1]))) for r in rows if terms(r[1])]
    n_docs, words = len(docs), sum(sum(c.values()) for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    out = []
    for item, text in set(items):
        scored = []
        for doc_id, c in docs:
            m = 25 + (75 * sum(c.values()) * n_docs) // words
            s = sum(n * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t, n in Counter(terms(text)).items() if t in c)
            if s > 0:
                scored.append((-s, doc_id is None, doc_id))
        out += [(item, rank, doc_id, -s) for rank, (s, _, doc_id) in enumerate(sorted(scored)[:k], 1)]
    return out


def corpus():
    rng = np.random.default_rng(3)
    vocabulary = [f"t{i}" for i in range(300)]
    pick = lambda n: " ".join(vocabulary[i] for i in np.minimum(rng.zipf(1.3, n) - 1, 299))
    rows = [(i, pick(int(rng.integers(1, 120))), "en", "s", 1) for i in range(900)]
    rows += [(1000 + i, "same t7 t9 t200 words", "en", "s", 1) for i in range(40)] + [(1100, None, "en", "s", 1), (1101, "", "en", "s", 1), (1102, " .,;", "en", "s", 1)]
    rows += [(None, "T7 T9", "en", "s", 1), (5, "T200 t7-É", "en", "s", 1), (5, "T200 t7-É", "en", "s", 1), (1200, "t3 " * 60_000 + "t299", "en", "s", 1)]
    items = [(i, pick(int(rng.integers(1, 60)))) for i in range(25)] + [(50, "t7 t7 T9 t200"), (50, "t7 t7 T9 t200"), (50, "t1"), (51, None), (52, "..."), (53, "nowhere found"), (None, "same words é"), (54, "t299 nowhere")]
    return rows, items


@pytest.mark.parametrize(("shard", "k", "block", "parts"), [(1 << 14, 10, 1 << 18, 3), (64, 3, 100, 5), (1, 1, 1 << 18, 2)])
def test_ranking(spark, monkeypatch, shard, k, block, parts):
    rows, items = corpus()
    for name, value in (("SHARD_DOCUMENTS", shard), ("BLOCK_TERMS", block)):
        monkeypatch.setattr(ranked, name, value)
    asked = spark.createDataFrame([(i, t, "r", 1) for i, t in items], "item_id long, text string, item string, rank int")
    if shard == 1:
        rows = rows[:60]
    got = ranked.search(table(spark, rows).repartition(parts), asked, k=k)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert Counter(map(tuple, got.collect())) == Counter(ranking(rows, items, k))


def test_ranking_of_nothing(spark):
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert ranked.search(table(spark, []), items).count() == 0
    assert ranked.search(table(spark, [(1, "a b", "en", "s", 1)]), items.limit(0)).count() == 0


def test_reading_stops_before_the_lists_end():
    """Direct access pushes best positions down: a clear winner ends the reading early, and a tie with the kth does not."""
    n, rng = 4000, np.random.default_rng(1)
    tf = np.stack([rng.integers(1, 9, n), rng.integers(1, 9, n)], axis=1).astype(np.int32)
    tf[17] = 400
    shard = ranked.Shard(pa.array(np.arange(n)), np.full(n, 20), np.arange(n + 1) * 2, np.tile(np.array([0, 1], np.int32), n), tf.ravel(), np.array([900, 700]), n, 20 * n)
    docs, _ = shard.best(np.array([0, 1]), np.array([1, 1]), 1)
    assert list(docs) == [17] and shard.read < 50
    tf[:] = 3
    shard = ranked.Shard(pa.array(np.arange(n)[::-1].copy()), np.full(n, 20), np.arange(n + 1) * 2, np.tile(np.array([0, 1], np.int32), n), tf.ravel(), np.array([900, 700]), n, 20 * n)
    docs, _ = shard.best(np.array([0, 1]), np.array([1, 1]), 2)
    assert list(docs) == [n - 1, n - 2] and shard.read == n
