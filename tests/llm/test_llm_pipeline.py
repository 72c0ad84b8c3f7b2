import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import duckdb
import corpus_pipeline
from llm_fixtures import EXTRA, corpus, frame
from pyspark.sql import functions as F
from test_llm_dedup import near_brute
from test_llm_encoding import checked_pieces

from hammerprice.llm import exact_dedup
from hammerprice.llm.columns import written
from hammerprice.llm.queries import ORACLES, QUERIES

NAMES = ["quality", "exact_dedup", "near_dedup", "suffix_dedup", "packing"]


def test_stages_follow_each_other(spark, small):
    assert [name for name, _ in corpus_pipeline.STAGES] == NAMES
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, small), f"test-{name}")
        if name != "packing":
            assert docs.columns == columns
            counts.append(docs.count())
    assert counts == sorted(counts, reverse=True) and counts[1] < counts[0] and counts[2] < counts[1]
    assert counts[4] == counts[3]  # passages go, documents stay
    kept = {r.doc_id for r in docs.select("doc_id").distinct().collect()}
    assert len(kept) == counts[4]
    whole = corpus_pipeline.run(spark, small)
    assert whole.agg({"length": "sum"}).first()[0] == docs.agg({"length": "sum"}).first()[0]


def exact_kept(rows):
    best = {}
    for i, text in rows:
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        if lower not in best or i > best[lower][0]:
            best[lower] = (i, text)
    return sorted(best.values())


def characters_kept(text, mask):
    """Without the characters whose bytes all go."""
    out, at = [], 0
    for character in text or "":
        size = len(character.encode())
        if not all(mask[at : at + size]):
            out.append(character)
        at += size
    return "".join(out)


def repeated_bytes(rows, length=100):
    seen, masks = set(), {}
    for i, text in sorted(rows):
        data = (text or "").encode()
        mask = masks[i] = bytearray(len(data))
        for at in range(len(data) - length + 1):
            window = data[at : at + length]
            if window in seen:
                mask[at : at + length] = b"\1" * length
            seen.add(window)
    return masks


def test_the_whole_pipeline_equals_brute_force_behind_quality(spark, small):
    """Every stage is given what brute force says the one before it leaves; quality is trained and tested by itself."""
    docs, held = spark.read.parquet(f"{small}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        docs = held[name] = written(stage(spark, docs, small), f"brute-{name}")
    texts = {name: sorted((r.doc_id, r.text) for r in held[name].collect()) for name in NAMES[:4]}
    rows = exact_kept(texts["quality"])
    assert rows == texts["exact_dedup"]
    near = {i: kept for i, _, _, kept in near_brute(rows, 5, 80)}
    rows = [(i, text) for i, text in rows if near[i]]
    assert rows == texts["near_dedup"]
    masks = repeated_bytes(rows)
    rows = [(i, characters_kept(text, masks[i])) for i, text in rows]
    assert rows == texts["suffix_dedup"]
    assert {r.doc_id: r.n_chars for r in held["suffix_dedup"].collect()} == {i: len(t) for i, t in rows}
    checked_pieces(rows, held["packing"].collect())


def test_stages_keep_columns_of_any_name(spark, small):
    rows = [(i, t) for i, t in corpus() if i is not None]
    values = {name: F.concat(F.lit(f"{name} of "), F.col("doc_id")) for name in EXTRA.split()}
    docs = frame(spark, rows).select("doc_id", "text", "lang", "source", "n_chars", *[v.alias(c) for c, v in values.items()])
    for _, stage in corpus_pipeline.STAGES[:4]:
        after = written(stage(spark, docs, small), "named")
        assert after.columns == docs.columns
        for row in after.collect():
            assert all(row[name] == f"{name} of {row.doc_id}" for name in EXTRA.split())


@pytest.mark.parametrize("parts", [1, 3, 5])
def test_of_texts_equal_but_for_case_under_one_id_the_least_stays(spark, small, parts):
    docs = frame(spark, [(1, "aB"), (1, "ab"), (1, "Ab"), (1, "AB c"), (2, "x"), (2, "x")]).repartition(parts)
    found = exact_dedup.drop_exact_copies(docs).collect()
    assert sorted((r.doc_id, r.text) for r in found) == [(1, "AB c"), (1, "Ab"), (2, "x")]


@pytest.mark.parametrize("rows", [corpus(), []])
def test_stages_take_odd_tables(spark, small, rows):
    docs = frame(spark, rows)
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, small), f"odd-{name}")
        assert name == "packing" or docs.columns == columns


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_equal_their_sql(spark, small, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "labels", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{small}/{table}.parquet'")
    wanted = con.execute(ORACLES[name]).df()
    found = QUERIES[name](spark, small).toPandas()
    order = sorted(wanted.columns)
    assert sorted(found.columns) == order

    def rows(df):
        return sorted(map(tuple, df[order].astype(object).where(df[order].notna(), None).values.tolist()), key=repr)

    assert rows(found) == rows(wanted)
