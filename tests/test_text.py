"""Scalar string functions against the FIXTURES edge tables and Python semantics."""

import random
from pathlib import PurePosixPath

from pyspark.sql import functions as F

from quire.functions import text as TX

KEPT = ["a.py", "a.PY", "..py", "a..py", "b.tar.Py", "a.markdown", "pkg/__init__.py", "_u.markdown", ".github/x.md", "a b%20c.py"]
DROPPED_EXT = [".py", "py", "a.py.", "x.md.txt", "a.py\n"]


def _one(spark, values, fn, schema="v string"):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(fn(F.col("v"))).collect()]


def test_source_extension(spark):
    got = _one(spark, KEPT + DROPPED_EXT, TX.has_source_extension)
    assert got == [True] * len(KEPT) + [False] * len(DROPPED_EXT)
    # agrees with pathlib on the whole list
    for name, ok in zip(KEPT + DROPPED_EXT, got):
        assert ok == (PurePosixPath(name).suffix.lower() in {".py", ".md", ".markdown"} and "\n" not in name)


def test_vcs_dirs(spark):
    paths = [".git/h.md", "a/.git/x.py", ".github/x.md", "a/.gitignore", "x/.git", "a.git/b.py"]
    assert _one(spark, paths, TX.in_vcs_dir) == [True, True, False, False, True, False]


SPECS = [
    ("git@github.com:psf/requests.git", True, "git__github.com__psf__requests.git", "git@github.com:psf/requests.git"),
    ("https://x.y/z w.git", True, "https______x.y__z__w.git", "https://x.y/z w.git"),
    (" repo:a/b ", True, "repo__a__b", "https://github.com/repo:a/b.git"),
    ("repo:a/b.git", True, "repo__a__b.git", "https://github.com/repo:a/b.git.git"),
    ("owner/name.git", False, "owner__name.git", "https://github.com/owner/name.git"),
    ("a/b/c.git", False, "a__b__c.git", "https://github.com/a/b/c.git.git"),
    (" x \n", False, "x", "https://github.com/x.git"),
    ("", False, "", "https://github.com/.git"),
]


def test_specs(spark):
    vals = [s[0] for s in SPECS]
    assert _one(spark, vals, TX.is_git_spec) == [s[1] for s in SPECS]
    assert _one(spark, vals, TX.dataset_slug) == [s[2] for s in SPECS]
    assert _one(spark, vals, TX.clone_url) == [s[3] for s in SPECS]
    assert _one(spark, ["owner/name.git", "a.git"], TX.repo_slug) == ["owner__name", "a"]


def test_py_strip_matches_python(spark):
    random.seed(7)
    alphabet = list(TX.PY_WHITESPACE) + list("ab é漢😀") + ["​", "﻿"]
    vals = ["".join(random.choices(alphabet, k=random.randint(0, 12))) for _ in range(400)]
    assert _one(spark, vals, TX.py_strip) == [v.strip() for v in vals]


def test_preview(spark):
    got = _one(spark, ["\n\nabc  defgh\n", None, "\n ab\n"], lambda c: TX.text_preview(c, 5))
    assert got == ["abc" + TX.PREVIEW_SUFFIX, "", " ab"]


# What goes in and what is left. Markers of a role go with their role, in the order assistant, system, user, and each
# once; what their removal brings together is a marker only to a later step.
STRIPPED = [
    ("", ""), (None, None), ("plain", "plain"), ("<|end|>", ""), ("a<|end|>b", "ab"),
    ("<|start|>assistant", ""), ("<|start|>assistantx", "x"), ("<|start|>system<|message|>hi<|end|>", "hi"),
    ("<|start|>user<|message|>q<|end|><|start|>assistant", "q"), ("<|start|>developer x", "developer x"), ("<|start|>tool<|x|>", "tool"),
    ("<||>", "<||>"), ("<|>|>", "<|>|>"), ("<|a>b|>", "<|a>b|>"), ("<|a<|b|>", ""), ("<|a|", "<|a|"), ("|>a<|", "|>a<|"), ("<<|a|>>", "<>"),
    ("<|a|><|b|>c", "c"), ("<|multi\nline|>y", "y"), ("é<|ü|>漢", "é漢"), ("Assistant <|START|>assistant", "Assistant assistant"),
    ("<|start|>as<|end|>sistant", "assistant"), ("<|start|>as<|start|>usersistant", "assistant"), ("<|start|>sys<|start|>assistanttem", ""),
    ("<|st<|start|>userart|>x", "x"), ("<|start|><|start|>assistantassistant", "assistant"),
]


def test_strip_markers(spark):
    from quire.streaming import segmenter

    assert _one(spark, [a for a, _ in STRIPPED], TX.strip_markers) == [b for _, b in STRIPPED]
    assert [segmenter.strip_markers(a) for a, _ in STRIPPED if a is not None] == [b for _, b in STRIPPED if b is not None]


def test_stripping_batch_and_stream_agree(spark):
    from quire.streaming import segmenter

    random.seed(3)
    parts = ["<|", "|>", "<|start|>", "assistant", "system", "user", "<|end|>", "x", ">", "|", " ", "<|start|>assistant"]
    vals = ["".join(random.choices(parts, k=random.randint(0, 10))) for _ in range(1000)]
    assert _one(spark, vals, TX.strip_markers) == [segmenter.strip_markers(v) for v in vals]


def test_normalize_newlines(spark):
    assert _one(spark, ["a\r\nb\rc\n", "\r\r\n"], TX.normalize_newlines) == ["a\nb\nc\n", "\n\n"]
