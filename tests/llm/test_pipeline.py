"""Every stage of the pipeline against plain Python or SQL, on a table with odd rows."""

from __future__ import annotations

import re
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F
from test_brute_force import plain_score, sequences_of
from test_llm_operators import LOWER, components_of

import corpus_pipeline
from tidemark.llm import toxicity
from tidemark.llm.files import open_input, shared_dir, written
from tidemark.llm.queries import ORACLE_SQL

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet")
    some = rows.where("doc_id < 3")
    odd = some.limit(2).withColumn("doc_id", F.lit(None).cast("long")).unionByName(some.limit(2)).unionByName(some.limit(3).withColumn("text", F.element_at(F.array(F.lit(None).cast("string"), F.lit(""), F.lit(" ")), (F.col("doc_id") + 1).cast("int"))).withColumn("doc_id", F.col("doc_id") + 5000))
    odd = odd.unionByName(some.limit(1).withColumn("text", F.lit("one of its own with an id that another text has too")))
    clash = {"_unit": F.lit("u"), "_toxicity": F.lit(0.5), "score": F.lit(1.0), "k": F.lit(1), "_h": F.lit(2), "key": F.lit("k"), "shard": F.lit(3), "file": F.lit("f")}
    return written(rows.unionByName(odd).withColumns(clash), f"{shared_dir(spark, 'test')}/docs")


def keys(df):
    return Counter((r.doc_id, r.text) for r in df.select("doc_id", "text").collect())


def test_toxic_documents_go(spark, docs, monkeypatch):
    held = {}
    fit = toxicity.train_model
    monkeypatch.setattr(toxicity, "train_model", lambda *a, **b: held.setdefault("model", fit(*a, **b)))
    out = corpus_pipeline.drop_toxic(spark, docs, SF)
    assert out.columns == docs.columns
    with open_input(held["model"]) as f:
        net = toxicity.BiGRU.load(f.read())
    got, short = keys(out), {k: n for k, n in keys(docs).items() if len(k[1] or "") < 6000}
    for key, n in short.items():
        s = plain_score(net, key[1])
        if abs(s - 0.7) > 1e-3:
            assert got.get(key, 0) == (n if s < 0.7 else 0)
    assert corpus_pipeline.drop_toxic(spark, docs.limit(0), SF).count() == 0


def test_one_of_each_group_stays(spark, docs):
    out = corpus_pipeline.drop_near_duplicates(spark, docs, SF)
    assert out.columns == docs.columns
    units = sorted(keys(docs), key=lambda k: (k[0] is None, k[0] or 0, k[1] or ""))
    several = {i for i, n in Counter(i for i, _ in units).items() if n > 1}
    groups = components_of(list(enumerate(t for _, t in units)), 5, 80)
    got = keys(out)
    assert set(got.values()) == {1}
    for c in set(groups.values()):
        own = [units[k] for k, x in groups.items() if x == c]
        kept = [u for u in own if u in got]
        named = [u for u in own if u[0] is not None and u[0] not in several]
        assert len(kept) == 1 and (not named or kept == [min(named)])
    assert corpus_pipeline.drop_near_duplicates(spark, docs.limit(0), SF).count() == 0


def test_contaminated_documents_go(spark, docs):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    windows = {}
    for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        w = words(r.text)
        n = min(10, len(w))
        for k in range(len(w) - n + 1) if n else ():
            windows.setdefault(n, set()).add(tuple(w[k : k + n]))

    def bad(text):
        w = words(text)
        return any(tuple(w[k : k + n]) in s for n, s in windows.items() for k in range(len(w) - n + 1))

    out = corpus_pipeline.drop_contaminated(spark, docs, SF)
    assert out.columns == docs.columns and keys(out) == Counter({k: n for k, n in keys(docs).items() if not bad(k[1])})
    assert corpus_pipeline.drop_contaminated(spark, docs.limit(0), SF).count() == 0


def test_mixed_rows_are_those_of_the_sql(spark, docs):
    out = corpus_pipeline.mix_sources(spark, docs, SF)
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "text", "source").toArrow())
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    want = Counter()
    for doc_id, n, _, _, taken, _ in con.execute(ORACLE_SQL["op6_source_mix"]).fetchall():
        want[doc_id, n] += taken // n if n else 0
    got = Counter((r.doc_id, size(r.text)) for r in out.collect())
    assert out.columns == docs.columns and got == +want and set(keys(out)) <= set(keys(docs))
    assert corpus_pipeline.mix_sources(spark, docs.limit(0), SF).count() == 0


def test_sequences_are_those_of_the_texts_in_order(spark, docs):
    place = docs.metadataColumn("_metadata")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text", place["file_path"].alias("f"), place["row_index"].alias("r")).orderBy("f", "r").collect()]
    got = {r.slot: r for r in corpus_pipeline.write_tokens(spark, docs, SF).collect()}
    want = sequences_of(rows, 8192)
    assert sorted(got) == sorted(want)
    for slot, (ids, _) in want.items():
        assert got[slot].tokens_read == len(ids)
    assert {d for r in got.values() for d in r.doc_ids} == {i for i, _ in rows}
    assert corpus_pipeline.write_tokens(spark, docs.limit(0), SF).count() == 0


def test_stages_follow_each_other(spark):
    docs, folder = spark.read.parquet(f"{SF}/documents.parquet"), shared_dir(spark, "test")
    columns = docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near duplicates", "decontamination", "mixing", "token output"]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        docs = written(stage(spark, docs, SF), f"{folder}/{k}")
        assert docs.columns == columns
    rows = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {d for r in rows for d in r.doc_ids} == {r.doc_id for r in docs.select("doc_id").collect()}
