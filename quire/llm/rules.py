"""Quality rules: plain counts, and how far a text's letters and common words are from its language's.

A language's reference is two histograms, made from all its documents that pass the base rules:

* character classes (``CLASSES``), and
* its ``COMMON`` words that most documents hold (case kept, equal ones by the word), and all other words.

Each bin is the median over the documents of its share, so neither long documents nor junk below
half of them shift it, scaled to a sum of 1. Shares are whole thousandths and ten-thousandths, so
that medians are exact counts over at most 10,001 values, whatever the table's size.

A document is compared with every reference by the Jensen-Shannon distance (root of the
divergence to base 2, 0 to 1); the least of each kind counts, so a wrong or missing language label
does no harm. It is kept if it passes the base rules, its classes lie within ``CHAR_LIMIT``, and,
from ``WORD_GUARD`` words on (shorter texts hold too few common words to tell), its common words
lie within ``WORD_LIMIT``. The base rules are the guard of the first distance.

Words are runs outside ASCII white space. Null texts hold none. Languages need ``LEAST_DOCS``
documents to be a reference; where there is none, the base rules decide alone. Null languages
give no reference. Rows that repeat, null ids and other columns are rows like any other.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm.common import by_bytes, col, free_names, map_arrow, pick, ready, saved

LEAST_WORDS = 50
REPEAT_PERCENT = 50
COMMON = 20
CHAR_LIMIT = 0.18
WORD_LIMIT = 0.3
WORD_GUARD = 150
LEAST_DOCS = 10
MAX_LANGUAGES = 1000
#: Character classes, in the order of the histograms; what is beyond ASCII comes last.
CLASSES = ("[a-z]", "[A-Z]", "[0-9]", r"[\x20\x09-\x0D]", "[#*$%&|<>]", "other ASCII", "beyond ASCII")
WHITE, SYMBOLS = 3, 4
SHARES = (1000, 10000)
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_WHITE = re.compile(CLASSES[WHITE])
_CLASS = np.array([next((k for k, c in enumerate(CLASSES[:5]) if re.match(c, chr(i))), 5) for i in range(128)] + [6])
_PIECE = 1 << 20
_HELD = 200_000


def pieces(text: str):
    """A text in pieces of about ``_PIECE`` code points that cut no word."""
    at = 0
    while at < len(text):
        cut = _WHITE.search(text, at + _PIECE)
        z = cut.end() if cut else len(text)
        yield text[at:z] if at or z < len(text) else text
        at = z


def class_counts(text: str) -> np.ndarray:
    out = np.zeros(len(CLASSES), np.int64)
    for p in pieces(text):
        cp = np.frombuffer(p.encode("utf-32-le", "surrogatepass"), np.uint32)
        out += np.bincount(_CLASS[np.minimum(cp, 128)], minlength=len(CLASSES))
    return out


def repeated_words(ids: np.ndarray) -> int:
    """Words that stand in a window of three words which is there twice or more."""
    n = len(ids)
    if n < 4:
        return 0
    m = int(ids.max()) + 1
    _, pair = np.unique(ids[:-1] * m + ids[1:], return_inverse=True)
    _, window, count = np.unique(pair[:-1] * m + ids[2:], return_inverse=True, return_counts=True)
    hit = np.flatnonzero(count[window] > 1)
    mark = np.zeros(n, bool)
    for k in range(3):
        mark[hit + k] = True
    return int(mark.sum())


def duplicate_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split("\n") if _WORD.search(x)]
    return len(lines) - len(set(lines))


def base_counts(text: str) -> tuple[list[int], np.ndarray, dict[str, int], np.ndarray]:
    """Words, their code points, symbols, repeated lines and repeated words; class counts; the words' numbers; each word's number in order."""
    number: dict[str, int] = {}
    ids = [np.fromiter((number.setdefault(w, len(number)) for w in _WORD.findall(p)), np.int64) for p in pieces(text)]
    seen = np.concatenate(ids) if ids else np.empty(0, np.int64)
    c = class_counts(text)
    return [len(seen), len(text) - int(c[WHITE]), int(c[SYMBOLS]), duplicate_lines(text), repeated_words(seen)], c, number, seen


def base_failed(n_words, n_repeat_words):
    """The base rules, for numbers or columns."""
    return (n_words < LEAST_WORDS) | (100 * n_repeat_words > REPEAT_PERCENT * n_words)


def common_words(docs: DataFrame, lang: str, text: str, common: int = COMMON) -> dict[str, list[str]]:
    """For each language with enough documents of ``LEAST_WORDS`` words, the words that most of them hold."""
    def count(batches):
        held: dict[str, Counter] = defaultdict(Counter)
        docs_of: Counter = Counter()

        def out():
            rows = [(la, w, n) for la, c in held.items() for w, n in c.items()] + [(la, None, n) for la, n in docs_of.items()]
            held.clear()
            docs_of.clear()
            return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), (pa.string(), pa.string(), pa.int64()))], names=["lang", "word", "n"])

        for batch in batches:
            for la, t in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                n, words = 0, set()
                for p in pieces(t or ""):
                    ws = _WORD.findall(p)
                    n += len(ws)
                    words.update(ws)
                if n >= LEAST_WORDS:
                    held[la].update(words)
                    docs_of[la] += 1
                    if sum(map(len, held.values())) >= _HELD:
                        yield out()
        if docs_of:
            yield out()

    d = ready(pick(docs, lang=lang, text=text)).where("lang is not null and text is not null")
    n = saved(d.mapInArrow(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")), "rule-words")
    enough = n.where(F.col("word").isNull() & (F.col("n") >= LEAST_DOCS)).select("lang")
    languages = [r["lang"] for r in enough.limit(MAX_LANGUAGES + 1).collect()]
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages; {lang} is no language column")
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.col("n").desc(), "word"))
    top = n.where(F.col("word").isNotNull() & F.col("lang").isin(languages)).withColumn("k", place).where(F.col("k") <= common)
    words: dict[str, list[str]] = {la: [] for la in sorted(languages)}
    for r in top.orderBy("lang", "k").collect():
        words[r["lang"]].append(r["word"])
    return words


def distances(counts: np.ndarray, reference: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance of each row of counts to one distribution; rows of zeros are as far as can be."""
    total = counts.sum(1, keepdims=True)
    p = counts / np.maximum(total, 1)
    m = (p + reference) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        d = np.where(p > 0, p * np.log2(p / m), 0) + np.where(reference > 0, reference * np.log2(reference / m), 0)
    return np.where(total[:, 0] > 0, np.sqrt(np.maximum(0, d.sum(1) / 2)), 1.0)


def references(measured: DataFrame, common: dict[str, list[str]]) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Each language's two histograms: exact medians of the bins' shares over its documents that pass the base rules."""
    n = F.col("m.n_words")
    share = lambda a, of, times: F.transform(a, lambda x: F.floor(x * times / of))
    m = measured.where(~base_failed(n, F.col("m.n_repeat_words")) & F.col("m.own").isNotNull())
    one = m.select("m.lang", F.posexplode(F.concat(
        share(F.col("m.chars"), F.aggregate("m.chars", F.lit(0).cast("long"), lambda a, x: a + x), SHARES[0]),
        share(F.col("m.own"), n, SHARES[1]))).alias("bin", "x"))
    out = {}
    for r in one.groupBy("lang", "bin").agg(F.expr("percentile_disc(0.5) within group (order by x)").alias("x"), F.count("*").alias("n")).groupBy("lang").agg(
            F.sort_array(F.collect_list(F.struct("bin", "x"))).alias("x"), F.max("n").alias("n")).where(F.col("n") >= LEAST_DOCS).collect():
        x = np.array([b["x"] for b in r["x"]], float)
        c, w = x[:len(CLASSES)], x[len(CLASSES):]
        if c.sum() and w.sum() and r["lang"] in common:
            out[r["lang"]] = c / c.sum(), w / w.sum()
    return out


def _measures(common: dict[str, list[str]], keep: list[str], text: str, lang: str | None, out: str):
    """Rows without their text, with the struct ``out`` of the base counts, class counts and common words' counts."""
    vocabulary = {w: k for k, w in enumerate(sorted({w for ws in common.values() for w in ws}))}
    own = {la: np.array([vocabulary[w] for w in ws], np.int64) for la, ws in common.items()}

    def run(batches):
        for whole in batches:
            for batch in by_bytes(whole, text):
                langs = batch.column(lang).to_pylist() if lang else [None] * batch.num_rows
                rows = []
                for la, t in zip(langs, batch.column(text).to_pylist()):
                    (n, chars, symbols, lines, again), classes, number, seen = base_counts(t or "")
                    # most words of the vocabulary against the text's own: the smaller side is walked
                    found = [(vocabulary[w], number[w]) for w in (vocabulary if len(vocabulary) < len(number) else number) if w in number and w in vocabulary]
                    held = np.zeros(len(vocabulary), np.int64)
                    if found:
                        at, no = np.array(found).T
                        held[at] = np.bincount(seen, minlength=len(number))[no]
                    mine = held[own[la]] if la in own else None
                    rows.append({"n_words": n, "word_chars": chars, "n_symbols": symbols, "n_dup_lines": lines, "n_repeat_words": again, "lang": la,
                                 "chars": classes.tolist(), "common": held.tolist(), "own": None if mine is None else [*mine.tolist(), n - int(mine.sum())]})
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(rows, _ARROW)], names=[*keep, out])
    return run


_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_ARROW = pa.struct([(c, pa.int64()) for c in _COUNTS] + [("lang", pa.string())] + [(c, pa.list_(pa.int64())) for c in ("chars", "common", "own")])
_KIND = ("struct<" + ",".join(f"{c}:long" for c in _COUNTS) + ",lang:string,chars:array<long>,common:array<long>,own:array<long>>")


def judged(docs: DataFrame, text: str = "text", lang: str | None = "lang", prefix: str = "q_", common: int = COMMON,
           char_limit: float = CHAR_LIMIT, word_limit: float = WORD_LIMIT, word_guard: int = WORD_GUARD) -> DataFrame:
    """``docs`` without their texts, and with ``<prefix>`` and: the five base counts, ``base_failed``, ``char_distance``,
    ``word_distance`` (null without a reference) and ``kept``."""
    keep = [c for c in docs.columns if c != text]
    names = [*_COUNTS, "base_failed", "char_distance", "word_distance", "kept"]
    free_names(docs.drop(text), *(prefix + n for n in names), prefix + "m")
    words = common_words(docs, lang, text, common) if lang else {}
    schema = T.StructType([*(docs.schema[c] for c in keep), T.StructField(prefix + "m", T.DataType.fromDDL(_KIND))])
    measured = saved(map_arrow(docs, _measures(words, keep, text, lang, prefix + "m"), schema), "rule-counts")
    refs = references(measured.select(F.col(prefix + "m").alias("m")), words)
    vocabulary = {w: k for k, w in enumerate(sorted({w for ws in words.values() for w in ws}))}
    bins = [(c, w, [vocabulary[x] for x in words[la]]) for la, (c, w) in sorted(refs.items())]

    @F.pandas_udf("struct<chars:double,words:double>")
    def nearest(chars, held, n):
        import pandas as pd

        c, h = np.array(chars.tolist(), float).reshape(len(n), -1), np.array(held.tolist(), float).reshape(len(n), -1)
        rest = lambda at: np.column_stack((h[:, at], n.to_numpy() - h[:, at].sum(1)))
        return pd.DataFrame({"chars": np.min([distances(c, r) for r, _, _ in bins], 0), "words": np.min([distances(rest(at), r) for _, r, at in bins], 0)})

    m = lambda c: F.col(f"{prefix}m.{c}")
    far = nearest(m("chars"), m("common"), m("n_words")) if bins else F.lit(None).cast("struct<chars:double,words:double>")
    d = measured.withColumn(prefix + "m", F.struct(prefix + "m.*", far.alias("far")))
    failed = base_failed(m("n_words"), m("n_repeat_words"))
    good = (m("far.chars") <= char_limit) & ((m("n_words") < word_guard) | (m("far.words") <= word_limit)) if bins else F.lit(True)
    return d.select(*(col(c) for c in keep), *(m(c).alias(prefix + c) for c in _COUNTS), failed.alias(prefix + "base_failed"),
                    m("far.chars").alias(prefix + "char_distance"), m("far.words").alias(prefix + "word_distance"), (~failed & good).alias(prefix + "kept"))
