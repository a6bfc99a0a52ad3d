"""The queries against their SQL, and each pipeline stage against what its operator says."""

import os

import duckdb
import numpy as np
import pytest

from tests.llm.test_operators import bpe_path, plain_components, plain_simhash, plain_spans

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@pytest.mark.parametrize("name", ["op1_substring_dedup", "op6_url_filter", "op7_chat_format", "op9_warc"])
def test_query_equals_sql(spark, name):
    from cartwise.llm.queries import ORACLE_SQL, QUERIES
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = con.execute(ORACLE_SQL[name])
    columns = [d[0] for d in want.description]
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(columns)
    key = lambda row: tuple(str(x) for x in row)
    assert sorted(map(key, got.select(*columns).collect())) == sorted(map(key, want.fetchall()))


def test_every_operator_has_a_query():
    from cartwise.llm.queries import QUERIES
    assert "pipeline" in QUERIES
    assert {int(n[2:].split("_")[0]) for n in QUERIES if n.startswith("op")} == set(range(1, 11))


def test_stages_keep_what_they_should(spark):
    import corpus_pipeline as P
    from cartwise.llm.common import written
    from tokenizers import Tokenizer
    SF = "/root/testdata/sf0.01"  # enough labelled rows to fit the classifier on
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    seen = [docs]
    for name, stage in P.STAGES:
        seen.append(written(stage(spark, seen[-1], SF), "test-stage"))
    rows = [{r.doc_id: r for r in d.collect()} for d in seen]
    for d in seen[:-1]:
        assert d.columns == P.COLUMNS
    # quality: the labelled held-out rows are nearly all decided as labelled
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect() if r.doc_id in rows[0]}
    assert np.mean([(i in rows[1]) == bool(y) for i, y in labels.items()]) > 0.95
    # near copies: exactly the smallest id of each component
    ids = sorted(rows[1])
    comp = plain_components([plain_simhash(rows[1][i].text) for i in ids])
    assert sorted(rows[2]) == sorted({ids[c] for c in comp})
    # benchmark: no kept document holds an item, and those that go hold one (or nearly)
    assert not any(b in r.text for r in rows[3].values() for b in bench)
    gone = set(rows[2]) - set(rows[3])
    assert {i for i, r in rows[2].items() if any(b in r.text for b in bench)} <= gone
    # PII: no base span is left, texts without one are as they were
    for i, r in rows[4].items():
        before = rows[3][i]
        assert r.n_chars == len(r.text) and not plain_spans(r.text)
        assert r.text == before.text or plain_spans(before.text) or "[ID]" in r.text
    # BPE: the ids are the library's, the text comes back
    lib = Tokenizer.from_file(bpe_path())
    for i, r in rows[5].items():
        assert r.text == rows[4][i].text
        assert np.frombuffer(r.ids, "<u4").tolist() == lib.encode(r.text, add_special_tokens=False).ids
        assert r.n_tokens == len(r.ids) // 4


def test_stages_on_odd_and_empty_documents(spark):
    import corpus_pipeline as P
    odd = spark.createDataFrame(
        [(1, None, None, None, None), (2, "", "en", "s", 0), (2, "", "en", "s", 0), (3, "a@b.co", None, "s", 6)],
        "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for frame in (odd, odd.limit(0)):
        for _, stage in P.STAGES:
            rows = stage(spark, frame, SF).collect()
            assert len(rows) <= frame.count()
    assert os.path.exists(P.__file__)
