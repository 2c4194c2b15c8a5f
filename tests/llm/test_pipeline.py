"""The pipeline stage by stage on planted cases, and the registered queries against SQL."""

import os

import duckdb
import pytest
from tests_prose import prose

import corpus_pipeline
from queuelake.llm import packing
from queuelake.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


def run_stages(spark, docs, upto=None):
    out = [docs]
    for _, stage in corpus_pipeline.STAGES[:upto]:
        out.append(stage(spark, out[-1], SF))
    return out


def planted(odd_rows):
    rows = [(500 + i, " ".join(prose(i, 40 + i % 50)), "en", "big" if i % 3 else f"s{i % 4}") for i in range(90)]
    rows += [(700, rows[0][1].replace(" ", "  "), "en", "big"), (701, rows[1][1] + " extra", "en", "big"), (702, rows[1][1] + " more", "en", "big")]
    rows += [(800, "Это другой язык, и модели его не знают вовсе.", None, "s1"), (801, "?? 123 !!", "en", "s1")]
    return rows + odd_rows


def test_stages(spark, as_docs, odd_rows):
    frames = run_stages(spark, as_docs(planted(odd_rows)))
    ids = [[r.doc_id for r in f.select("doc_id").collect()] for f in frames]
    assert all(f.columns == frames[0].columns for f in frames[:-1])
    assert not {800, 801, 1, 2, 3} & set(ids[1]) and {500 + i for i in range(90)} <= set(ids[1])
    # 700 has more code points than the text it copies; of the repeated rows of 7 one is left.
    assert 500 not in ids[2] and {700, 501, 701, 702} <= set(ids[2]) and ids[2].count(7) == 1
    assert 501 in ids[3] and not {701, 702} & set(ids[3])
    clean = {500 + i for i in range(2, 90)}
    assert clean <= set(ids[3]) and set(ids[4]) == set(ids[3]) and len(ids[4]) > len(ids[3])
    encode = packing.encoder("byte_bpe_50k")
    tokens = sum(len(encode.ids(r.text or "")) + 1 for r in frames[4].collect())
    pieces = frames[5].collect()
    assert sum(p.length for p in pieces) == tokens
    used = {}
    for p in pieces:
        used[p.sequence_id] = used.get(p.sequence_id, 0) + p.length
    assert max(used.values()) <= 1024


def test_no_rows(spark, as_docs):
    frames = run_stages(spark, as_docs([(1, "x", "en", "s")]).where("doc_id = 0"))
    assert [f.count() for f in frames] == [0] * len(frames)


def test_run_equals_stages(spark):
    found = corpus_pipeline.run(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    expected = run_stages(spark, docs)[-1]
    assert found.count() == expected.count() > 0
    assert found.exceptAll(expected.select(found.columns)).count() == 0


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_queries_equal_sql(spark, name):
    connection = duckdb.connect()
    for file in os.listdir(SF):
        path = f"{SF}/{file}"
        connection.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    expected = connection.execute(ORACLE[name]).fetchdf()
    found = QUERIES[name](spark, SF).toPandas()
    order = sorted(expected.columns)
    assert sorted(found.columns) == order
    a, b = (f[order].sort_values(order).reset_index(drop=True) for f in (found, expected))
    # A null equals a null only; every other value has to be the same.
    assert len(a) == len(b) and all((a[c].isna() == b[c].isna()).all() for c in order)
    assert all((a[c].dropna().to_numpy() == b[c].dropna().to_numpy()).all() for c in order)


def test_all_are_registered():
    assert {name.split("_")[0] for name in QUERIES} == {f"op{n}" for n in range(1, 14)}
