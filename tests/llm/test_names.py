"""Every operator with columns whose names clash with its own, or hold dots and spaces."""

import pytest
from helpers import awkward, sentence

from quire.llm import embeddings, fim, fingerprints, mixing, neardup, passages, pieces, quotes, rules, search, token_counts, toxicity, warc

TOKENIZERS = "/opt/tokenizers"
CLASH = ("doc", "th", "k", "r", "m", "x", "h1", "rep", "class", "score", "row", "src", "c0", "lo", "qm_one", "nd_text", "psg_x", "tox_both")


def odd(spark):
    """The awkward documents with the columns read under odd names, and extra columns under the operators' own."""
    have = {"id", "th", "row", "size"}
    docs = awkward(spark).withColumnsRenamed({"doc_id": "my id", "text": "a.b", "source": "the `source`", "lang": "la.ng"})
    return docs.selectExpr("*", *(f"'{c}' as `{c}`" for c in CLASH if c not in have))


def mail(spark):
    rows = [(1, 0, "u", "hi there", "x"), (1, 1, "a", "> hi there\nyo", "y")]
    return spark.createDataFrame(rows, "`c.id` long, `the turn` int, `r.o` string, `b o` string, h string")


def trained(spark):
    rows = [(i, sentence(i, 30) + (" grzk" if i % 3 == 0 else ""), int(i % 3 == 0), 1.0) for i in range(90)]
    d = spark.createDataFrame(rows, "`my id` long, `a.b` string, `to.xic` int, tox_score double")
    return toxicity.trained(d, d.select("my id", "`to.xic`"), "my id", "a.b", "to.xic")


CASES = {
    "op1": lambda s: mixing.Mix(odd(s), "my id", "a.b", "the `source`").documents(odd(s), "my id", "a.b"),
    "op2": lambda s: quotes.conversations(mail(s), "c.id", "the turn", "r.o", "b o"),
    "op3": lambda s: fingerprints.compared(odd(s), "my id", "a.b"),
    "op4": lambda s: pieces.encode(odd(s), pieces.model_bytes(f"{TOKENIZERS}/piece_bpe_32k.model"), "a.b", "ids", check="same"),
    "op5": lambda s: token_counts.histogram(odd(s), pieces.model_bytes(f"{TOKENIZERS}/byte_bpe_50k.tiktoken"), "a.b"),
    "op6": lambda s: toxicity.score(odd(s), trained(s), "a.b"),
    "op7": lambda s: neardup.one_of_each(odd(s), "my id", "a.b"),
    "op8": lambda s: passages.cut_documents(odd(s), "my id", "a.b", words=50),
    "op9": lambda s: warc.archived(odd(s).selectExpr("`my id`", "`a.b`", "'u' as `u rl`", "k as number"), "my id", "u rl", "a.b"),
    "op10": lambda s: embeddings.range_join(s.createDataFrame([(1, [1.0, 2.0], 0, "x"), (2, [1.0, 2.0], 0, "y")], "`v.id` long, `e e` array<double>, `l.l` int, node string"), "v.id", "e e", "l.l"),
    "op11": lambda s: search.ranked(odd(s), odd(s).limit(5), "my id", "a.b", "my id", "a.b"),
    "op12": lambda s: fim.transformed(odd(s), "my id", "a.b"),
    "op13": lambda s: rules.judged(odd(s), "a.b", "la.ng"),
}
KEEPS = {"op1", "op7", "op8"}  # the columns as they come


@pytest.mark.parametrize("name", CASES)
def test_clashing_dotted_and_spaced_names(spark, name):
    got = CASES[name](spark)
    rows = got.collect()
    assert rows
    if name in KEEPS:
        assert got.columns == odd(spark).columns
    if name in KEEPS | {"op4", "op6", "op12", "op13"}:
        assert all(r[c] == c for r in rows for c in CLASH if c not in ("th", "row"))
