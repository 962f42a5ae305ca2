"""The corpus pipeline: stages applied to ``documents`` in turn, each written as Parquet and read again.

Every stage is one of the operators of ``quire.llm``; all but the last return the columns of
``documents``. SQL can express none of the trained, hashed or tokenising stages, so
``ORACLE_SQL`` is None and the stages are tested against brute force in ``tests/llm``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import mixing, neardup, passages, pieces, toxicity
from quire.llm.common import saved
from quire.llm.queries import TOKENIZERS

#: Repeated strings of so many bytes are cut, and those of more words than this that are shorter.
PASSAGE_BYTES = 240
PASSAGE_WORDS = 50


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score reaches the threshold go; the chain learns from ``labels``."""
    crf = toxicity.trained(docs, _read(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, crf, prefix="qt_", spans=False)
    return scored.where(F.col("qt_score") < toxicity.THRESHOLD).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates stays, the one with the least id."""
    return neardup.one_of_each(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that repeat in what is left are cut; documents of which nothing is left go."""
    return passages.cut_documents(docs, length=PASSAGE_BYTES, words=PASSAGE_WORDS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words the mix takes, a row per document: its taken words, repeats included."""
    return mixing.Mix(docs).documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix as SentencePiece ids, with whether they decode to the normalised text."""
    model = pieces.model_bytes(f"{TOKENIZERS}/piece_bpe_32k.model")
    keep = [c for c in docs.columns if c in ("doc_id", "text", "lang", "source", "n_chars")]
    return pieces.encode(docs.select(*keep), model, check="round_trip")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("repeated_passages", cut_repeats),
    ("mix_sources", mix_sources),
    ("sentencepiece", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is written to the shared folder and reread."""
    docs = _read(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = saved(docs, f"stage-{name}")
    return docs


ORACLE_SQL = None
