"""The registered queries: against their SQL, or against brute force where SQL cannot express them; and the pipeline."""

import hashlib
import re
import struct
import sys
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from oracle_check import TABLES, _norm
from rillflow.llm import bpe, queries, toxicity
from test_llm_dedup import jaccard_brute, norm, removal_brute, words
from test_llm_operators import base_brute, targets_by_iteration

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return [(r["doc_id"], r["text"], r["source"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]


def test_all_are_registered():
    assert set(queries.QUERIES) <= set(entry.queries()) and "pipeline" in entry.queries()
    assert {re.match(r"op(\d+)_", n)[1] for n in queries.QUERIES} == {str(n) for n in range(1, 14)}


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, name):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = queries.QUERIES[name](spark, SF)
    rel = con.sql(queries.ORACLES[name])
    columns = sorted(got.columns)
    assert columns == sorted(rel.columns)
    mine = Counter(tuple(_norm(r[c]) for c in columns) for r in got.collect())
    theirs = Counter(tuple(_norm(v) for v in (row[rel.columns.index(c)] for c in columns)) for row in rel.fetchall())
    assert mine == theirs


def test_op2_targets(spark, docs):
    sizes = Counter()
    for _, text, source in docs:
        sizes[source] += len(words(text))
    goal, taken = targets_by_iteration(sizes), Counter()
    source = {d: s for d, _, s in docs}
    for r in queries.op2_mixing(spark, SF).collect():
        assert r["target"] == pytest.approx(goal[source[r["doc_id"]]]) and r["taken"] <= 2 * r["size"]
        taken[source[r["doc_id"]]] += r["taken"]
    most = max(len(words(t)) for _, t, _ in docs)
    assert all(abs(taken[s] - goal[s]) <= most for s in goal)


def test_op4_components(spark, docs):
    got = [tuple(r) for r in queries.op4_jaccard_join(spark, SF).collect()]
    assert sorted(got) == sorted(jaccard_brute([d[:2] for d in docs], 3, 9, 10))


def test_op5_removal(spark, docs):
    got = [tuple(r) for r in queries.op5_substring_dedup(spark, SF).collect()]
    assert sorted(got) == sorted((d, n, gone, hashlib.sha256(kept.encode()).hexdigest())
                                 for d, n, gone, kept in removal_brute([d[:2] for d in docs], 13))


def test_op6_digests(spark, docs):
    from tokenizers import Tokenizer
    own = Tokenizer.from_file(bpe.vocabulary_path())
    got = {r["doc_id"]: tuple(r)[1:] for r in queries.op6_bpe(spark, SF).collect()}
    for d, text, _ in docs:
        ids = own.encode(text or "", add_special_tokens=False).ids
        assert got[d] == (len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(),
                          hashlib.sha256(own.decode(ids, skip_special_tokens=False).encode()).hexdigest())


def test_op8_held_out_and_scores(spark, docs):
    got = queries.op8_toxicity(spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)


def test_op10_base(spark, docs):
    text = {d: t for d, t, _ in docs}
    for r in queries.op10_quality_rules(spark, SF).collect():
        own = base_brute(text[r["doc_id"]])
        assert tuple(r)[1:6] == own and not (r["kept"] and r["base_failed"])
        assert r["base_failed"] == (own[0] < 50 or 100 * own[4] > 50 * own[0])


def test_pipeline_stages_on_what_the_one_before_kept(spark, tmp_path):
    from tokenizers import Tokenizer
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    frame, kept = spark.read.parquet(f"{SF}/documents.parquet"), []
    columns = frame.columns
    kept.append(frame.collect())
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, frame, SF).write.parquet(str(tmp_path / str(i)))
        frame = spark.read.parquet(str(tmp_path / str(i)))
        assert i == len(names) - 1 or frame.columns == columns
        kept.append(frame.collect())
    start, clean, single, near, mixed, last = kept
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    scored = toxicity.score(docs, toxicity.train(docs, spark.read.parquet(f"{SF}/labels.parquet")))
    assert {r["doc_id"] for r in clean} == {r["doc_id"] for r in scored.where(F.col("score") < 0.7).collect()}
    first = {}
    for r in clean:
        first[norm(r["text"])] = min(first.get(norm(r["text"]), r["doc_id"]), r["doc_id"])
    assert sorted(r["doc_id"] for r in single) == sorted(first.values())
    groups = jaccard_brute([(r["doc_id"], r["text"]) for r in single], 5, 4, 5)
    assert sorted(r["doc_id"] for r in near) == sorted(d for d, _, c in groups if c == d)
    size = {r["doc_id"]: len(words(r["text"])) for r in near}
    copies = Counter(r["doc_id"] for r in mixed)
    assert set(copies) <= set(size) and max(copies.values()) <= 2
    assert sum(size[d] * n for d, n in copies.items()) == pytest.approx(1.5 * sum(size.values()), rel=0.05)
    own = Tokenizer.from_file(bpe.vocabulary_path())
    text = {r["doc_id"]: r["text"] for r in near}
    assert Counter(r["doc_id"] for r in last) == copies
    assert all(r["ids"] == own.encode(text[r["doc_id"]] or "", add_special_tokens=False).ids for r in last)


def test_rest_does_not_import_the_package():
    rest = [m for m in list(sys.modules) if m.startswith("rillflow.") and not m.startswith("rillflow.llm")]
    for name in rest:
        source = open(sys.modules[name].__file__).read()
        assert "rillflow.llm" not in source and "from .llm" not in source
