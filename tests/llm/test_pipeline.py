"""The stages on a small corpus whose outcome is known, and the registered queries on the smallest tables."""

import __spark_entry__ as entry
import pytest
from helpers import sentence

import corpus_pipeline as C
from quire.llm import queries as Q

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("tables"))
    passage = sentence(7000, 60)
    rows, labels = [], []
    for i in range(240):
        t, toxic = sentence(i, 90), int(i % 6 == 0)
        if toxic:
            t = " ".join(("grzkov " if k % 30 == 3 else "") + w for k, w in enumerate(t.split()))
        rows.append([i, t, "en", f"s{i % 3}"])
        labels.append((i, 1, toxic))
    rows.append([900, rows[1][1], "en", "s1"])  # an exact copy
    rows.append([901, rows[2][1] + " more", "en", "s1"])  # a near copy
    for i in (3, 5):
        rows[i][1] += " " + passage  # a passage that two documents share
    rows.append([902, None, "en", None])
    spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    return d, passage


def test_stage_names_and_oracle():
    assert [n for n, _ in C.STAGES] == ["toxicity", "near_duplicates", "repeated_passages", "mix_sources", "sentencepiece"]
    assert C.ORACLE_SQL is None and "pipeline" in entry.queries()


def test_stages_take_effect(spark, folder):
    d, passage = folder
    docs = C._read(spark, d, "documents")
    columns, seen = docs.columns, []
    for name, stage in C.STAGES:
        docs = C.saved(stage(spark, docs, d), f"test-{name}")
        seen.append(docs)
    toxic, near, cut, mixed, coded = seen
    assert all(s.columns == columns for s in seen[:-1])
    assert {r["doc_id"] for r in toxic.collect()} == {i for i in range(240) if i % 6} | {900, 901, 902}
    assert {r["doc_id"] for r in near.collect()} == {i for i in range(240) if i % 6} | {902}
    texts = {r["doc_id"]: r["text"] for r in cut.collect()}
    assert set(texts) == {i for i in range(240) if i % 6} | {902} and passage not in texts[3] and passage not in texts[5]
    assert texts[1] == sentence(1, 90) and texts[3].startswith(sentence(3, 80)) and texts[902] is None
    assert mixed.count() <= cut.count() and mixed.where("text is null").isEmpty()
    assert coded.where("not round_trip").isEmpty() and coded.count() == mixed.count()


def test_passages_of_short_words_are_cut(spark):
    over, under = " ".join(f"{k} é" for k in range(26))[:-2], " ".join(f"x{k}" for k in range(50))
    assert len(over.split()) == 51 and len(over.encode()) < C.PASSAGE_BYTES > len(under)
    rows = [(i, f"{sentence(i, 30)}\n{p}\u3000{sentence(i + 10, 30)}") for i, p in enumerate([over, over, under, under])]
    docs = spark.createDataFrame([*rows, (None, None), (9, "")], "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in C.cut_repeats(spark, docs, "").collect()}
    want = {i: t.replace(over, "") for i, t in rows} | {None: None, 9: ""}
    assert got == want and got[2] == rows[2][1]


@pytest.mark.parametrize("name", sorted(Q.QUERIES))
def test_registered_queries_run_on_whole_tables(spark, name):
    rows = Q.QUERIES[name](spark, SMALL).collect()
    table = {"op2_quotes": "conversations", "op10_embeddings": "embeddings"}.get(name, "documents")
    if name in ("op5_token_counts", "op9_warc"):
        assert rows
    elif name == "op11_ranked_search":
        items = spark.read.parquet(f"{SMALL}/benchmark.parquet").count()
        assert sorted((r["item_id"], r["rank"]) for r in rows) == sorted({(r["item_id"], r["rank"]) for r in rows}) and len(rows) <= 50 * items
        assert {r["rank"] for r in rows} == set(range(1, 51))
    else:
        assert len(rows) == spark.read.parquet(f"{SMALL}/{table}.parquet").count()
