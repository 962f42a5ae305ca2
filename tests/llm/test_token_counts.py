import os

import pytest
from helpers import awkward, sentence

from quire.llm import token_counts as C
from quire.llm.pieces import model_bytes

FOLDER = os.environ.get("QUIRE_TOKENIZERS", "/opt/tokenizers")


@pytest.fixture(scope="module")
def ranks():
    return model_bytes(os.path.join(FOLDER, "byte_bpe_50k.tiktoken"))


def test_counts_equal_the_tokenizer(spark, ranks):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(os.path.join(FOLDER, "byte_bpe_50k.json"))
    t.encode_special_tokens = True
    texts = [sentence(k, 40) for k in range(50)] + ["", "  x \n\n y", "<|endoftext|>", "日本語 é\U0001f600", "a" * 3000, "don't 12345 !!!"]
    df = spark.createDataFrame([(x,) for x in texts], "text string")
    got = {r["text"]: r["n_tokens"] for r in C.with_tokens(df, ranks).collect()}
    assert got == {x: len(t.encode(x, add_special_tokens=False).ids) for x in texts}


def test_limits_equal_brute_force(spark):
    lengths = [0, 0, 3, 3, 3, 7, 2500, 2500, 9000]
    hist = spark.createDataFrame([(x, lengths.count(x)) for x in set(lengths)], "length long, docs long")
    for block in (1, 4, 1024, 100_000):
        rows = {r["length"]: r for r in C.limits(hist, block).collect()}
        assert set(rows) == set(lengths)
        for x, r in rows.items():
            within = [y for y in lengths if y <= x]
            assert (r["docs_within"], r["tokens_within"], r["docs_cut"], r["tokens_left"]) == (
                len(within), sum(within), len(lengths) - len(within), sum(min(x, y) for y in lengths))
    got = {r["context"]: r["tokens_left"] for r in C.truncated_totals(hist, [0, 2, 5, 2048, 10**6]).collect()}
    assert got == {c: sum(min(c, y) for y in lengths) for c in (0, 2, 5, 2048, 10**6)}
    q = {r["share"]: r["length"] for r in C.quantiles(hist, [0.0, 0.2, 0.5, 0.9, 1.0]).collect()}
    assert q == {0.0: 0, 0.2: 0, 0.5: 3, 0.9: 9000, 1.0: 9000}
    with pytest.raises(ValueError):
        C.quantiles(hist, [1.5])


def test_awkward_rows(spark, ranks):
    hist = C.histogram(awkward(spark), ranks)
    rows = {r["length"]: r["docs"] for r in hist.collect()}
    assert sum(rows.values()) == 12 and rows[0] == 2
    empty = C.histogram(awkward(spark).limit(0), ranks)
    assert empty.count() == 0 and C.limits(empty).count() == 0
    assert [tuple(r) for r in C.truncated_totals(empty, [5]).collect()] == [(5, 0, 0, 0, 0)]
