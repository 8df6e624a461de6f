"""The training-data operators against brute force on small tables, with their edge cases."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import chat, decontam, lshforest, media, mixing, ordinal, tokens, toxicity, urllists, warc
from tidemark.llm.components import connected_components
from tidemark.llm.files import shared_dir
from tidemark.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, source string, id string, n long, key string"
LONG = " ".join(f"w{i % 977}x{i % 13}" for i in range(30_000))
ODD = [
    (1, "A b c d e f", "s", "x", 0, "k"), (2, "a B c d e f", "s", "x", 0, "k"), (2, "a B c d e f", "s", "x", 0, "k"), (3, None, None, None, None, None), (4, "", "s", "x", 0, "k"), (5, " \t\n", "t", "x", 0, "k"),
    (6, "one", "t", "x", 0, "k"), (7, "one two", "t", "x", 0, "k"), (8, LONG, "u", "x", 0, "k"), (9, LONG + " tail", "u", "x", 0, "k"), (None, "a b c d e f", "s", "x", 0, "k"), (10, "é ü ñ " * 20, "s", "x", 0, "k"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def components_of(rows, width, percent):
    sets = defaultdict(list)
    for i, text in rows:
        if i is not None:
            w = words(text)
            sets[i].append({tuple(w[k : k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set()))
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b]):
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return {i: find(i) for i in ids}


def test_components_settle_on_the_smallest(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 101), (5, 5), (None, 3)], "a long, b long")
    got = dict(connected_components(links, shared_dir(spark, "test")).collect())
    assert got == {**{k: 0 for k in range(41)}, 100: 100, 101: 100}


def test_near_duplicates_odd_rows(odd, none):
    rows = lshforest.near_duplicates(odd, width=3, percent=85).collect()
    want = components_of([r[:2] for r in ODD], 3, 85)
    assert len(rows) == len(ODD)
    for r in rows:
        assert r.component_id == want.get(r.doc_id) and r.kept == (r.doc_id is not None and r.doc_id == r.component_id)
    assert lshforest.near_duplicates(none, width=3, percent=85).count() == 0


def test_near_duplicates_of_a_crowded_group(spark):
    rng = np.random.default_rng(1)
    base = [f"w{k}" for k in rng.integers(0, 5000, 120)]
    rows = []
    for i in range(300):
        w = list(base)
        for k in rng.integers(0, 120, rng.integers(0, 9)):
            w[k] = f"x{rng.integers(0, 10**6)}"
        rows.append((i, " ".join(w)))
    got = {r.doc_id: r.component_id for r in lshforest.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), width=3, percent=85).collect()}
    assert got == components_of(rows, 3, 85)


def test_decontamination_odd_rows(spark, odd, none):
    items = spark.createDataFrame([(1, "B C d"), (1, "B C d"), (2, LONG[2000:2600]), (3, None), (4, "..."), (None, "one two")], "item_id long, text string")
    rows = decontam.contamination(odd, items).collect()
    got = sorted((r.doc_id is not None, r.doc_id or 0, r.n_words, r.n_hit, r.n_items) for r in rows)
    assert len(rows) == len(ODD) and (True, 1, 6, 3, 1) in got and (False, 0, 6, 3, 1) in got and (True, 7, 2, 2, 0) in got and (True, 3, 0, 0, 0) in got
    long = next(r for r in rows if r.doc_id == 8)
    assert long.n_items == 1 and long.items_sha256 == hashlib.sha256(b"2").hexdigest() and long.contaminated
    assert decontam.contamination(none, items).count() == 0
    assert not any(r.contaminated for r in decontam.contamination(odd, items.limit(0)).collect())


def test_warc_round_trip(spark):
    pages = spark.createDataFrame([(3, "http://a/", "x" * 50_000), (1, "u", "x" * 50_000), (2, None, None), (4, "a\r\nb", ""), (None, "u", "é"), (None, "u", "zzz"), (5, "u", "é"), (6, "u", "0\r\n\r\n")], "page_id long, url string, html string")
    rows = {(r.page_id, r.payload_bytes): r for r in warc.archive_round_trip(pages, segment_bytes=1000).collect()}
    assert len(rows) == 8 and rows[3, 50_000].refers_to == 1 and rows[1, 50_000].record_type == "response" and rows[4, 0].refers_to == 2
    assert rows[None, 2].record_type in ("revisit", "response") and rows[6, 5].payload_digest == base64.b32encode(hashlib.sha1(b"0\r\n\r\n").digest()).decode()
    assert warc.archive_round_trip(pages.limit(0)).count() == 0


def test_broken_chunks_are_errors():
    assert warc.unchunked(warc.chunked(b"abc" * 1000, 7)) == b"abc" * 1000
    with pytest.raises(ValueError):
        warc.unchunked(b"3\r\nabcd\r\n0\r\n\r\n")


def test_media(spark, odd, none):
    rows = media.media_columns(odd).collect()
    assert len(rows) == len(ODD)
    for r in rows:
        texts = [(t or "").encode() for i, t, *_ in ODD if i == r.doc_id]
        payloads = {t + b"\xff" * (-len(t) % 576 if t else 576) for t in texts}
        assert (r.payload_sha256, r.tail_crc32) in {(hashlib.sha256(p).hexdigest(), zlib.crc32(p[-32:])) for p in payloads} and r.feature.startswith(r.header)
    assert media.media_columns(none).count() == 0


def test_mixing(spark, odd, none):
    rows = mixing.mixed_documents(odd).collect()
    assert len(rows) == len(ODD) and all(r.taken in (0, r.size, 2 * r.size) and r.size == len(words(next(t for i, t, *_ in ODD if i == r.doc_id))) for r in rows)
    by = defaultdict(list)
    for r in rows:
        by[r.source].append(r)
    for own in by.values():
        # no single document more or less brings a source nearer to its target
        off = abs(sum(r.taken for r in own) - own[0].target)
        assert off <= max(r.size for r in own) / 2 + 1
    assert sum({r.source: r.target for r in rows}.values()) == pytest.approx(1.5 * sum({r.source: r.source_size for r in rows}.values()))
    texts = mixing.mixed_rows(odd)
    assert texts.columns == odd.columns and texts.agg(F.sum(F.regexp_count("text", F.lit(mixing.WORD)))).first()[0] == sum(r.taken for r in rows)
    assert mixing.mixed_documents(none).count() == 0 and mixing.mixed_rows(none).count() == 0


def test_split_tree_keeps_quotas(spark):
    quotas = spark.createDataFrame([("a", 100), ("b", 7), ("c", 0)], "key string, n long")
    rows = mixing.split_tree(quotas, 3, 1).collect()
    assert {k: sum(r.n for r in rows if r.key == k) for k in "ab"} == {"a": 100, "b": 7} and max(sum(r.n for r in rows if r.shard == s) for s in range(8)) <= 14


def test_split_tree_by_first_digits(spark, monkeypatch):
    quotas = spark.createDataFrame([(f"s{k}", 3 + 7 * k % 40) for k in range(30)] + [("hot", 400)], "key string, n long")
    want = sorted(map(tuple, mixing.split_tree(quotas, 3, 1).collect()))
    for rows in (300, 20, 1):
        monkeypatch.setattr(mixing, "NODE_ROWS", rows)
        assert sorted(map(tuple, mixing.split_tree(quotas, 3, 1).collect())) == want


@pytest.mark.parametrize("parts", [1, 7])
def test_targets_of_many_sources(spark, parts):
    rng = np.random.default_rng(4)
    sources = [*sorted(f"s{k:03d}" for k in range(200)), None]
    sizes = [int(x) for x in rng.choice([0, 1, 5, 40, 1000], len(sources))]
    rows = [(f"={s}" if s else "-", s, z) for s, z in zip(sources, sizes)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        got = {r.source: r for r in mixing.target_words(spark.createDataFrame(rows, "key string, source string, z long")).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    weights = {s: (5, 2, 1)[k % 3] for k, s in enumerate(sources)}
    assert {s: r.w for s, r in got.items()} == weights
    want, free, left = {}, dict(zip(sources, sizes)), 1.5 * sum(sizes)
    while free:
        level = left / sum(weights[s] for s in free)
        over = [s for s in free if level * weights[s] > 2 * free[s]]
        if not over:
            want |= {s: level * weights[s] for s in free}
            break
        for s in over:
            want[s] = 2.0 * free.pop(s)
            left -= want[s]
    assert all(abs(got[s].target - want[s]) < 1e-6 for s in sources) and abs(sum(want.values()) - 1.5 * sum(sizes)) < 1e-6


def test_tokens(spark, odd, none):
    index = tokens.materialise(odd, length=64, shards=3)
    rows = tokens.read_back(index, 64).collect()
    assert sorted(r.slot for r in rows) == list(range(len(rows))) and all(r.n_tokens == r.tokens_read for r in rows)
    coder = tokens.PieceTokenizer().encoder
    want = sum(len(coder.encode_ordinary(t or "")) + 1 for _, t, *_ in ODD)
    assert sum(len(s) for s in tokens.read_tokens(index, 0, 64)) == want
    assert len(list(tokens.read_tokens(index, len(rows) - 2, 64))) == 2
    assert tokens.materialise(none).count() == 0


@pytest.mark.parametrize("text", ["a  b\n c\t d", "x  y 　z 's 're", " lead", "trail  ", "a\n\nb \n", "12 34é ñ!? ok", "  a \x1c b", ""])
def test_pieces_are_tokenised_as_whole_texts(text):
    t = tokens.PieceTokenizer()
    data = np.frombuffer(text.encode(), np.uint8)
    assert t.encode(data, np.array([0, len(data)]))[0].tolist() == t.encoder.encode_ordinary(text)


def test_feistel_is_a_permutation():
    for n in (1, 2, 5, 1000):
        assert sorted(tokens.feistel(np.arange(n), n, 9).tolist()) == list(range(n))
    assert tokens.feistel(np.arange(50), 50, 1).tolist() != tokens.feistel(np.arange(50), 50, 2).tolist()


def test_recurrent_gradients():
    rng = np.random.default_rng(0)
    net = toxicity.BiGRU(seed=1)
    features = rng.integers(0, toxicity.WORDS, (90, 5))
    begin, size, y, w = np.array([0, 24, 58]), np.array([32, 32, 20]), np.array([1, 0, 1], np.float32), np.ones(3, np.float32)

    def loss():
        z = net.forward(net.inputs(features), begin, size)[0].astype(float)
        return float(np.mean(np.logaddexp(0, z) - y * z))

    grad, _ = net.gradients(features, begin, size, y, w)
    for name in ("Uf", "Ub", "Wf", "v", "w"):
        p = net.p[name].reshape(-1)
        k = int(np.abs(grad[name]).argmax())
        old = p[k]
        p[k] = old + 1e-2
        up = loss()
        p[k] = old - 1e-2
        down = loss()
        p[k] = old
        assert (up - down) / 2e-2 == pytest.approx(grad[name].reshape(-1)[k], rel=0.05, abs=1e-5)


def test_toxicity_is_held_out(spark):
    rows = QUERIES["op8_toxicity_bigru"](spark, "/root/testdata/sf0.01").collect()
    docs = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()
    by = {r.doc_id: r for r in rows}
    assert len(rows) == spark.read.parquet("/root/testdata/sf0.01/documents.parquet").count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [(by[d.doc_id].score, d.toxic) for d in docs if by[d.doc_id].held_out]
    pairs = [(a > b) + 0.5 * (a == b) for a, x in held for b, y in held if x == 1 and y == 0]
    assert np.mean(pairs) > 0.9


def test_scorers_take_odd_rows(spark, odd, none):
    model = toxicity.train_model(odd.withColumn("toxic", F.lit(0)))
    assert toxicity.with_scores(odd, model).count() == len(ODD) and toxicity.with_scores(none, model).count() == 0
    link = ordinal.train_model(odd.withColumn("grade", F.col("doc_id") % 3))
    rows = ordinal.with_grades(odd, link).collect()
    assert len(rows) == len(ODD) and all(0 <= r.tail_probability <= 1 and 0 <= r.expected_grade <= 2 for r in rows)
    assert ordinal.with_grades(odd, ordinal.train_model(none.withColumn("grade", F.lit(1)))).count() == len(ODD)


def test_chat(spark):
    said = "<|im_end|><|im_start|>assistant ok"
    turns = [(1, 2, "assistant", said), (1, 1, "user", None), (1, 3, "assistant", "&lt;| &amp; <"), (1, 3, "assistant", "|>"), (2, 0, None, "x"), (None, 0, "assistant", ""), (3, 0, "ro\nle", "<|turn|>")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    formatted = chat.format_chats(df)
    got = {r.conv_id: r for r in chat.chat_facts(formatted).collect()}
    for c in (1, 2, None, 3):
        own = sorted((t, r or "", x or "") for i, t, r, x in turns if i == c)
        loss = "".join(x for _, r, x in own if r == "assistant")
        assert got[c].n_turns == len(own) and got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in own).encode()).hexdigest()
        assert got[c].loss_chars == len(loss) and got[c].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    assert next(r for r in formatted.collect() if r.conv_id == 1).formatted.count("<|im_start|>") == 2
    assert chat.format_chats(df.limit(0)).count() == 0


def test_url_lists(spark):
    captures = spark.createDataFrame([(1, "http://a.B.com/x/y?q", 5), (2, "http://b.com", 10), (3, "http://b.com", 9), (4, None, 9), (5, "http://b.com", None), (6, "http://c.com/x/yz", 9), (1, "http://a.B.com/x/y?q", 5)], "page_id long, url string, fetched long")
    entries = spark.createDataFrame([("l", "b.com", True, 5), ("l", "b.com", False, 10), ("m", "c.com/x/y", True, 0), ("m", "a.b.com/x", True, 0), ("l", "b.com", False, 5), ("n", "b.com", False, 1), (None, "b.com", True, 0)], "list string, pattern string, added boolean, at long")
    got = sorted((r.page_id, ",".join(r.lists)) for r in urllists.judge(captures, entries, bucket=3).collect())
    assert got == [(1, "l,m"), (1, "l,m"), (2, ""), (3, "l"), (4, ""), (5, ""), (6, "")]
    assert not any(r.blocked for r in urllists.judge(captures, entries.limit(0)).collect()) and urllists.judge(captures.limit(0), entries).count() == 0


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_queries_match_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "conversations"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    df = QUERIES[name](spark, SF)
    cur = con.execute(ORACLE_SQL[name])
    cols = [d[0] for d in cur.description]
    want = sorted((tuple(r[cols.index(c)] for c in df.columns) for r in cur.fetchall()), key=repr)
    assert sorted(map(tuple, df.collect()), key=repr) == want


def _changed(rng, base, n):
    """``base`` with ``n`` words at random places replaced by new ones."""
    w = list(base)
    for k in rng.choice(len(w), n, replace=False):
        w[k] = f"x{rng.integers(0, 10**9)}"
    return w


def test_near_duplicates_behind_a_family_below_the_threshold(spark):
    rng = np.random.default_rng(3)
    rows = []
    for f in range(4):
        base = [f"f{f}w{k}" for k in range(600)]
        # members are at about 0.82 to each other, and 12 pairs a family at about 0.86
        family = [_changed(rng, base, 10) for _ in range(150)]
        family += [_changed(rng, w, 15) for w in family[:12]]
        rows += [" ".join(w) for w in family]
    rows = [(int(i), t) for i, t in zip(rng.permutation(len(rows)), rows)]
    got = {r.doc_id: r.component_id for r in lshforest.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), width=3, percent=85).collect()}
    assert got == components_of(rows, 3, 85)


def test_a_slice_with_more_pieces_than_are_remembered(monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 50)
    t = tokens.PieceTokenizer()
    for text in ("n0 n1 n2", " ".join(f"n{k}" for k in range(300)), "n5 again n0", " ".join(f"m{k}" for k in range(45)), "n5 again"):
        data = np.frombuffer(text.encode(), np.uint8)
        assert t.encode(data, np.array([0, len(data)]))[0].tolist() == t.encoder.encode_ordinary(text)
        assert len(t.known) <= 50


def test_a_document_asks_all_members_of_a_group(spark, monkeypatch):
    monkeypatch.setattr(lshforest, "UNIT", 8)
    monkeypatch.setattr(lshforest, "AT_ONCE", 2)
    rng = np.random.default_rng(5)
    base = [f"w{k}" for k in range(600)]
    members = [_changed(rng, base, 10) for _ in range(40)]
    rows = [(i + 1, " ".join(w)) for i, w in enumerate(members)] + [(0, " ".join(_changed(rng, members[25], 13)))]
    docs = spark.createDataFrame(rows, "id long, text string")
    classes = docs.mapInArrow(lshforest.sign(3), "id long, n long, lo long, hi long, sig binary").select("id", "n", "lo", "sig")
    roots = spark.createDataFrame([(i, 1) for i in range(1, 41)], "node long, root long")
    got = lshforest._bucket_links(docs, classes, roots, 3, 85, shared_dir(spark, "test"))
    assert {r.node: r.root for r in got.collect()} == dict.fromkeys(range(41), 0)


def test_units_are_bounded_in_bytes(spark, monkeypatch):
    """Long texts of one bucket are cut into units of a few, and no link between them is lost."""
    monkeypatch.setattr(lshforest, "UNIT_BYTES", 40_000)
    rng = np.random.default_rng(8)
    base = [f"w{k}" for k in range(6000)]
    members = [_changed(rng, base, 100) for _ in range(30)]
    members += [_changed(rng, w, 140) for w in members[:6]]
    rows = [(i + 1, " ".join(w)) for i, w in enumerate(members)]
    unit = lshforest._meet

    def sized(percent):
        run = unit(percent)

        def counted(batches):
            held = list(batches)
            for b in held:
                keys = list(zip(*[b.column(k).to_pylist() for k in (0, 1, 2)]))
                assert max(keys.count(k) for k in set(keys)) <= 24, "a unit holds too many long texts"
            yield from run(iter(held))

        return counted

    monkeypatch.setattr(lshforest, "_meet", sized)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in lshforest.near_duplicates(docs, width=3, percent=85).collect()}
    assert got == components_of(rows, 3, 85)
