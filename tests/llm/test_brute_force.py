"""Operators that SQL cannot express, and their hard inputs, against plain Python."""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import chat, lshforest, media, mixing, ordinal, tokens, toxicity, urllists, warc
from tidemark.llm.files import open_output, shared_dir
from tidemark.llm.textscan import NON_ALNUM, SPACES, WordScanner, column_bytes, ragged_array

SF = "/root/testdata/sf0.01"


def shingled(text, width=3):
    w = text.split()
    return {tuple(w[k : k + width]) for k in range(len(w) - width + 1)}


def changed(rng, base, n):
    w = list(base)
    for k in rng.choice(len(w), n, replace=False):
        w[k] = f"x{rng.integers(0, 10**9)}"
    return w


@pytest.mark.parametrize("parts", [2, 7])
def test_near_duplicates_of_stars_and_chains(spark, parts):
    """Every hub has the largest id and is the only link of its leaves; chains link neighbours only."""
    rng = np.random.default_rng(11)
    rows, want = [], {}
    for f in range(20):
        base = [f"f{f}w{k}" for k in range(300)]
        leaves = [base[:], changed(rng, base, 2), *[changed(rng, base, 6) for _ in range(6)]]
        own = list(range(f * 10, f * 10 + 8))
        rows += [(own[-1], " ".join(base + ["end"]))] + [(i, " ".join(w)) for i, w in zip(own[:-1], leaves[1:])]
    for c in range(5):
        w = [f"c{c}w{k}" for k in range(300)]
        for k in range(8):
            rows.append((1000 + c * 10 + k, " ".join(w)))
            w = changed(rng, w, 6)
    sets = [(i, shingled(t)) for i, t in rows]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if 100 * len(a & b) >= 85 * len(a | b):
                p, q = sorted((find(i), find(j)))
                root[q] = p
    want = {i: find(i) for i, _ in sets}
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts, "doc_id")
    got = {r.doc_id: r.component_id for r in lshforest.near_duplicates(df, width=3, percent=85).collect()}
    assert got == want and len(set(want.values())) < len(rows) / 4


def test_rarest_shingles_refute_no_link(spark):
    """The bound on the rarest shingles against exact similarity, on random pairs around the threshold."""
    rng = np.random.default_rng(2)
    ranks = np.zeros(1 << lshforest.SLOT_BITS, np.uint8)
    ranks[rng.integers(0, len(ranks), 9000)] = 30
    for trial in range(300):
        n = int(rng.integers(20, 200))
        base = rng.integers(1, 1 << 63, n, dtype=np.uint64)
        other = np.unique(np.concatenate([base[: int(n * rng.uniform(0.85, 1))], rng.integers(1, 1 << 63, int(n * rng.uniform(0, 0.12)), dtype=np.uint64)]))
        a, b = np.sort(base), other
        common = len(np.intersect1d(a, b))
        if 100 * common < 85 * (len(a) + len(b) - common):
            continue
        sets = np.concatenate([a, b])
        at = np.array([0, len(a), len(sets)])
        batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array([5, 6]), ragged_array(sets, at)], names=["id", "lo", "shingles"])
        rare = next(lshforest._rarest(ranks, 85)(iter([batch])))
        data, offsets = column_bytes(rare.column(2))
        x, y = (data.view(np.uint64)[offsets[k] // 8 : offsets[k + 1] // 8] for k in (0, 1))
        shared = len(np.intersect1d(x, y))
        least = -(-85 * (len(a) + len(b)) // 185)
        assert (x <= y[-1]).sum() - shared <= len(a) - least and (y <= x[-1]).sum() - shared <= len(b) - least


def test_mixed_rows_are_dealt_by_shard_in_order(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    _, drawn, shards = mixing.mix(docs)
    assert shards > 1
    want = defaultdict(list)
    for r in drawn.collect():
        want[r.shard].append((r.order_key, r.id))
    rows = mixing.mixed_rows(docs).withColumn("part", F.spark_partition_id()).select("part", "doc_id", "text").collect()
    got = defaultdict(list)
    for r in rows:
        got[r.part].append(r.doc_id)
    assert dict(got) == {s: [i for _, i in sorted(x)] for s, x in want.items()}
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    assert all(r.text == texts[r.doc_id] for r in rows)
    blocks = defaultdict(set)
    for r in drawn.select("key", "block", "shard").collect():
        blocks[r.key, r.block].add(r.shard)
    assert all(len(x) == 1 for x in blocks.values())
    sums = defaultdict(int)
    for r in (all_rows := mixing.mixed_documents(docs).collect()):
        sums[r.source] += r.taken
        assert r.taken in (0, r.size, 2 * r.size)
    assert all(abs(sums[r.source] - r.target) <= max(1, 0.01 * r.target) for r in all_rows)


def test_splitting_tree_draws_without_replacement(spark):
    """Quotas are exact at every node, halves are even, and over many seeds a source's left share has the hypergeometric mean and spread."""
    quotas = spark.createDataFrame([("a", 12), ("b", 20), ("c", 0)], "key string, n long")
    left = []
    for seed in range(12):
        rows = mixing.split_tree(quotas, 1, seed).collect()
        assert {k: sum(r.n for r in rows if r.key == k) for k in "ab"} == {"a": 12, "b": 20}
        assert sum(r.n for r in rows if r.shard == 0) == 16
        left.append(sum(r.n for r in rows if r.shard == 0 and r.key == "a"))
    assert len(set(left)) > 2 and 4.5 < np.mean(left) < 7.5


def sequences_of(docs, length):
    coder = tokens.PieceTokenizer().encoder
    flat, owners = [], []
    for i, t in docs:
        ids = [*coder.encode_ordinary(t or ""), tokens.END_OF_TEXT]
        flat += ids
        owners += [i] * len(ids)
    n = -(-len(flat) // length)
    slots = tokens.feistel(np.arange(n, dtype=np.uint64), n, 2024).astype(int)
    out = {}
    for k in range(n):
        part = owners[k * length : (k + 1) * length]
        out[int(slots[k])] = (flat[k * length : (k + 1) * length], part)
    return out


def test_training_order_is_that_of_the_files_whatever_the_splits(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").withColumn("slot", F.lit(1)).limit(240)
    path = f"file://{tmp_path}/docs"
    docs.repartition(3).write.option("parquet.block.size", 40_000).parquet(path)
    table = spark.read.parquet(path)
    place = table.metadataColumn("_metadata")
    rows = [(r.doc_id, r.text) for r in table.select("doc_id", "text", place["file_path"].alias("f"), place["row_index"].alias("r")).orderBy("f", "r").collect()]
    length = 512
    want = sequences_of(rows, length)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    seen = []
    try:
        for split in ("1000000", "70000"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", split)
            index = tokens.materialise(spark.read.parquet(path), length=length)
            got = {r.slot: r for r in tokens.read_back(index, length).collect()}
            seen.append(len(spark.read.parquet(path).select("doc_id").rdd.glom().collect()))
            assert sorted(got) == sorted(want) == list(range(len(want)))
            for slot, ids in enumerate(tokens.read_tokens(index, 0, length)):
                assert ids.tolist() == want[slot][0]
                assert got[slot].tokens_crc32 == zlib.crc32(np.array(want[slot][0], "<u2").tobytes()) and got[slot].doc_ids == list(dict.fromkeys(want[slot][1]))
                assert got[slot].n_tokens == got[slot].tokens_read == len(ids)
            assert [x.tolist() for x in tokens.read_tokens(index, len(want) - 3, length)] == [want[s][0] for s in range(len(want) - 3, len(want))]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert seen[0] < seen[1]


def test_training_order_of_string_ids_and_ties(spark):
    rows = [("a", "x y"), ("a", "x y"), (None, None), ("b", "z " * 400)]
    index = tokens.materialise(spark.createDataFrame(rows, "doc_id string, text string").coalesce(1), length=64)
    got = [i for _, r in sorted((r.slot, r) for r in index.collect()) for i in r.doc_ids]
    assert set(got) == {"a", "b", None} and sum(r.n_tokens for r in index.collect()) == sum(len(tokens.PieceTokenizer().encoder.encode_ordinary(t or "")) + 1 for _, t in rows)


def _words(text, separators):
    return [w.decode() for w in re.split(b"[" + re.escape(bytes(separators)) + b"]+", (text or "").encode()) if w]


def plain_score(net, text):
    """Window by window and word by word, with one small recurrence each way."""
    p, n, scanner = net.p, toxicity.SIZE, WordScanner(NON_ALNUM)
    sig = lambda x: 1 / (1 + np.exp(-x))

    def vector(word):
        data = np.frombuffer(word.encode(), np.uint8)
        starts, ends = np.array([0]), np.array([len(data)])
        return sum(p["E"][k] for k in toxicity.word_features(data, starts, ends, scanner.hashes(data, starts, ends), toxicity._FOLD)[0]).astype(float)

    def run(xs, d):
        h, out = np.zeros(n), []
        for x in xs if d == "f" else xs[::-1]:
            g, u = p[f"W{d}"] @ x + p[f"b{d}"][:, 0], p[f"U{d}"] @ h
            r, z = sig(g[:n] + u[:n]), sig(g[n : 2 * n] + u[n : 2 * n])
            new = np.tanh(g[2 * n :] + r * u[2 * n :])
            h = (1 - z) * new + z * h
            out.append(h)
        return out if d == "f" else out[::-1]

    words = _words(text, NON_ALNUM)
    vectors = {w: vector(w) for w in set(words)}
    best = -np.inf
    for k in range(max(1, -(-(len(words) - toxicity.WINDOW) // toxicity.STRIDE) + 1)):
        xs = [vectors[w] for w in words[k * toxicity.STRIDE : k * toxicity.STRIDE + toxicity.WINDOW]]
        if not xs:
            best = max(best, float(p["c"][0]))
            continue
        states = [np.concatenate(x) for x in zip(run(xs, "f"), run(xs, "b"))]
        a = np.array([s @ p["v"] for s in states])
        a = np.exp(a - a.max())
        a /= a.sum()
        best = max(best, float(p["w"] @ sum(w * s for w, s in zip(a, states)) + p["c"][0]))
    return sig(p["a"][0] * best + p["s"][0])


def test_toxicity_score_by_a_plain_forward_pass(spark):
    net = toxicity.BiGRU(seed=4)
    rng = np.random.default_rng(0)
    net.p["E"] = (rng.standard_normal(net.p["E"].shape) * 0.3).astype(np.float16).astype(np.float32)
    texts = ["", None, "one", "Some words, and more words here.", " ".join(f"w{i % 37}" for i in range(200)), "é ü ñ", "--- ..."]
    path = f"{shared_dir(spark, 'test')}/m.npz"
    with open_output(path) as out:
        out.write(net.dump())
    df = spark.createDataFrame([(i, t, 7.0) for i, t in enumerate(texts)], "doc_id long, text string, score double")
    got = {r.doc_id: r.score for r in toxicity.with_scores(df, path).collect()}
    for i, t in enumerate(texts):
        assert got[i] == pytest.approx(plain_score(net, t), abs=2e-4)


def test_the_recurrence_tells_order_apart():
    """Labels that depend on the order of two words alone: sums over words cannot tell them, the network does."""
    rng = np.random.default_rng(1)
    texts, labels = [], []
    for _ in range(900):
        w = [f"n{k}" for k in rng.integers(0, 60, 10)]
        y, k = int(rng.integers(0, 2)), int(rng.integers(0, 9))
        w[k : k + 2] = ["alpha", "omega"] if y else ["omega", "alpha"]
        texts.append(" ".join(w).encode())
        labels.append(y)
    net = toxicity.fit(texts[:700], np.array(labels[:700]), epochs=30)
    scanner = WordScanner(NON_ALNUM)
    scores = []
    for t in texts[700:]:
        data = np.frombuffer(t, np.uint8)
        f, first = toxicity._parts(scanner, data, np.array([0, len(data)]))
        _, begin, size = toxicity.windows_of(first)
        scores.append(net.logits(net.inputs(f), begin, size).max())
    y = np.array(labels[700:])
    s = np.array(scores)
    auc = np.mean([(a > b) + 0.5 * (a == b) for a in s[y == 1] for b in s[y == 0]])
    assert auc > 0.9


def test_ordinal_grades_by_plain_sums(spark):
    rng = np.random.default_rng(3)
    weights = rng.standard_normal(ordinal.WORDS + ordinal.CHARS).astype(np.float16).astype(np.float32)
    link = ordinal.CumulativeLink(weights, rng.standard_normal(6).astype(np.float32), np.array([-0.5, 0.8]))
    scanner = WordScanner(SPACES)

    def grades(text):
        text = text or ""
        raw, words = text.encode(), _words(text, SPACES)
        data = np.frombuffer(raw, np.uint8)
        n, k = max(1, len(raw)), max(1, len(words))
        letter = sum(65 <= c < 91 or 97 <= c < 123 or c >= 128 for c in raw)
        digit, upper, white = sum(48 <= c < 58 for c in raw), sum(65 <= c < 91 for c in raw), sum(c in (32, 10) for c in raw)
        f = np.dot([np.log1p(len(words)) / 5, len(raw) / k / 8, 4 * (len(raw) - letter - digit - white) / n, 4 * digit / n, 4 * upper / n, len({w.lower() if w.isascii() else w for w in words}) / k], link.measures)
        total = 0.0
        for w in words:
            d = np.frombuffer(w.encode(), np.uint8)
            at = np.array([0]), np.array([len(d)])
            total += weights[toxicity.word_features(d, *at, scanner.hashes(d, *at), toxicity._FOLD)[0]].sum(dtype=np.float64)
        f += total / k
        below = [1 / (1 + np.exp(-(t - f))) for t in link.thresholds]
        q = np.diff([0, *below, 1])
        assert data.size == len(raw)
        return q @ np.arange(3), q[2]

    path = f"{shared_dir(spark, 'test')}/m.npz"
    with open_output(path) as out:
        out.write(link.dump())
    texts = ["", None, "One two, THREE 4!", "same same same", " ".join(f"w{i}" for i in range(500))]
    df = spark.createDataFrame([(i, t, 0.5, 0.5) for i, t in enumerate(texts)], "doc_id long, text string, expected_grade double, tail_probability double")
    got = {r.doc_id: r for r in ordinal.with_grades(df, path).collect()}
    for i, t in enumerate(texts):
        e, tail = grades(t)
        assert got[i].expected_grade == pytest.approx(e, abs=1e-6) and got[i].tail_probability == pytest.approx(tail, abs=1e-6)
    tied = ordinal.with_grades(spark.createDataFrame([(1, "a b"), (1, "a b"), (2, "a b")], "doc_id long, text string"), path).select("expected_grade").distinct()
    assert tied.count() == 1


def test_ordinal_grades_hold_on_unseen_ratings(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    rated = spark.read.parquet(f"{SF}/labels.parquet").where("quality in (0, 1) and toxic in (0, 1)").select("doc_id", (F.col("quality") * (2 - F.col("toxic"))).alias("grade"), (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1).alias("held"))
    model = ordinal.train_model(ordinal.training_rows(docs, rated.where("not held")))
    rows = ordinal.with_grades(docs, model).join(rated.where("held"), "doc_id").select("expected_grade", "grade").collect()
    pairs = [(a.expected_grade > b.expected_grade) + 0.5 * (a.expected_grade == b.expected_grade) for a in rows for b in rows if a.grade == 2 and b.grade == 0]
    assert len(rows) > 50 and np.mean(pairs) > 0.85


def test_media_columns_by_plain_decoding(spark):
    texts = ["", None, "abc", "x" * 576, "é" * 700, "abc", "y" * 200_000]
    rows = media.media_columns(spark.createDataFrame([(i, t, "q", 1) for i, t in enumerate(texts)], "doc_id long, text string, digest string, member int").repartition(3)).collect()
    assert len(rows) == len(texts)
    for r in rows:
        raw = (texts[r.doc_id] or "").encode()
        payload = raw + b"\xff" * (-len(raw) % 576 if raw else 576)
        stored = media.to_png(payload)
        height = len(payload) // 576
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]))
        assert (r.media_bytes, r.media_sha256, r.header) == (len(stored), hashlib.sha256(stored).hexdigest(), f"png:576x{height}:8") and r.feature == f"png:576x{height}:8:mean={sum(payload) * 1000 // len(payload)}"
        # a plain reader of the format: chunks, then rows without a filter
        at, body = 8, b""
        while at < len(stored):
            n, kind = struct.unpack(">I4s", stored[at : at + 8])
            body += stored[at + 8 : at + 8 + n] if kind == b"IDAT" else b""
            at += 12 + n
        flat = zlib.decompress(body)
        assert b"".join(flat[k * 577 + 1 : (k + 1) * 577] for k in range(height)) == payload
    assert len({(r.shard, r.offset) for r in rows if r.doc_id in (0, 1)}) == 1


def test_chat_of_ten_thousand_turns(spark):
    n = 10_000
    turns = [(1, i, "user" if i % 3 == 0 else "assistant", f"text <| & {i} " + "word " * 10, 0) for i in range(n)]
    r = chat.chat_facts(chat.format_chats(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string, at int").withColumns({"block": F.lit(1), "formatted": F.lit("x"), "id": F.lit(2)}))).first()
    loss = "".join(x[3] for x in turns if x[2] == "assistant")
    assert r.n_turns == n and r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest() and r.turns_sha256 == hashlib.sha256("".join(f"{x[2]}\n{x[3]}\n" for x in turns).encode()).hexdigest()


def test_spans_lie_on_the_texts(spark):
    turns = [(1, 0, "assistant", "a & <|"), (1, 1, "assistant", "é" * 1500), (1, 2, "user", "q"), (1, 3, "assistant", ""), (1, 4, "assistant", "z")]
    r = chat.format_chats(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")).first()
    assert [r.formatted[s.start : s.start + s.length] for s in r.loss_spans] == ["a &amp; &lt;|", "é" * 1500, "", "z"]


def test_url_of_very_many_segments_and_clashing_columns(spark):
    url = "http://a.b.com/" + "/".join(f"s{i}" for i in range(20_000))
    captures = spark.createDataFrame([(1, url, 5, "l", 3), (2, "http://" + ".".join(f"x{i}" for i in range(3000)) + ".b.com/q", 7, "l", 3)], "page_id long, url string, fetched long, list string, at int")
    entries = spark.createDataFrame([("l", "a.b.com/s0/s1/s2", True, 0, "u"), ("m", "b.com", True, 6, "u")], "list string, pattern string, added boolean, at long, url string")
    assert sorted((r.page_id, r.lists) for r in urllists.judge(captures, entries).collect()) == [(1, ["l"]), (2, ["m"])]


def test_clashing_columns_of_archives(spark):
    pages = spark.createDataFrame([(1, "u", "h", "d", "p"), (2, "u", "h", "d", "p")], "page_id long, url string, html string, digest string, payload string").withColumns({"refers_to": F.lit(9), "n": F.lit(1), "sha1": F.lit("s")})
    assert sorted((r.page_id, r.record_type, r.refers_to) for r in warc.archive_round_trip(pages).collect()) == [(1, "response", None), (2, "revisit", 1)]


def test_damaged_archives_are_rows_with_errors(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"http://u/{i}", f"page {i} " * 50) for i in range(1, 7)], "page_id long, url string, html string")
    manifest = warc.write_archives(pages.coalesce(1), f"file://{tmp_path}/a", segment_bytes=150)
    path = manifest.first().path.removeprefix("file://")
    raw = open(path, "rb").read()
    members = [m.start() for m in re.finditer(b"\x1f\x8b\x08", raw)]
    cut = members[len(members) // 2] + 20
    with open(path, "wb") as out:
        out.write(raw[:cut] + b"\0" * 40 + raw[cut + 40 :])
    rows = warc.read_archives(manifest).collect()
    good = [r for r in rows if r.error is None]
    assert good and all(r.payload.decode() == f"page {r.page_id} " * 50 for r in good) and any(path in (r.error or "") for r in rows)
    with pytest.raises(ValueError, match="segments"):
        warc._payload("response", "sha1:x", 9, [{"segment": 1, "block": b"a"}, {"segment": 3, "block": b"b"}])


def test_ratings_off_the_scale_are_left_out(spark):
    docs = spark.range(400).selectExpr("id as doc_id", "concat('text ', id) as text", "'c' as grade")
    rated = spark.range(400).selectExpr("id as doc_id", "case when id < 100 then id % 3 when id < 110 then null else id end as grade")
    rated = rated.union(spark.sql("select 1L, 2L union all select null, 1L union all select 2L, 9L"))
    got = {r.doc_id: r.grade for r in ordinal.training_rows(docs, rated).collect()}
    assert got == {k: 2 if k == 1 else k % 3 for k in range(100)}
    assert ordinal.training_rows(docs, rated.limit(0)).count() == 0
