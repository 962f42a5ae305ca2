"""Scalar string functions as Column expressions (all JVM-side, no Python per row).

Each function takes and returns ``Column`` objects so it composes inside
``select`` / ``where`` / ``transform`` and stays within whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the behaviour being reproduced.
# Source-file extensions, matched case-insensitively on the last suffix.
SOURCE_EXTENSIONS = ("py", "md", "markdown")
# Version-control directory name that excludes a path.
VCS_DIR = ".git"
# Characters that become "__" in a dataset slug.
SLUG_CHARS = (":", "/", "@", "\\", " ")
# Spec prefixes/infixes that mark a git source.
GIT_PREFIXES = ("repo:", "git@", "ssh://")
GIT_URL_INFIX = "://"
FULL_URL_PREFIXES = ("git@", "ssh://")
GITHUB_PREFIX = "https://github.com/"
# Role starters removed before any other marker, in this order.
ROLE_STARTS = ("<|start|>assistant", "<|start|>system", "<|start|>user")
ANY_MARKER = r"<\|[^>]+\|>"
PREVIEW_SUFFIX = "\n\n... (truncated)"
# ---------------------------------------------------------------------------

# Python's str.isspace() set, derived by rule (all such code points are below U+3001).
PY_WHITESPACE = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())

SOURCE_EXT_PATTERN = r"(?iu)[^/]\.(?:" + "|".join(SOURCE_EXTENSIONS) + r")\z"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c: Column | str) -> Column:
    """Python ``str.strip()``: remove Unicode whitespace at both ends.

    ``trim(str, chars)`` treats its second argument as a character set, so this is
    one linear pass; Spark's one-argument ``trim`` strips spaces only.
    """
    return F.trim(_c(c), F.lit(PY_WHITESPACE))


def py_rstrip(c: Column | str) -> Column:
    return F.rtrim(_c(c), F.lit(PY_WHITESPACE))


def strip_newlines(c: Column | str) -> Column:
    """Python ``str.strip("\\n")``."""
    return F.trim(_c(c), F.lit("\n"))


def has_source_extension(path: Column | str) -> Column:
    """Last suffix of the file name, lower-cased, is one of the source extensions.

    A bare ``.py`` has no suffix; ``..py``, ``a.PY`` and ``b.tar.Py`` pass; ``a.py.`` does not.
    ``\\z`` (not ``$``) so that a trailing newline in a name is not accepted.
    """
    return _c(path).rlike(SOURCE_EXT_PATTERN)


def in_vcs_dir(path: Column | str) -> Column:
    """Some path component is exactly ``.git`` (``.github`` is not)."""
    return F.array_contains(F.split(_c(path), "/"), VCS_DIR)


def normalize_newlines(c: Column | str) -> Column:
    """Text-mode newline translation: ``\\r\\n`` and lone ``\\r`` become ``\\n``."""
    return F.replace(F.replace(_c(c), F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))


def is_git_spec(spec: Column | str) -> Column:
    """A dataset spec names a git source: after strip it starts with ``repo:``,
    ``git@`` or ``ssh://``, or it contains ``://``."""
    v = py_strip(spec)
    cond = v.contains(GIT_URL_INFIX)
    for p in GIT_PREFIXES:
        cond = cond | v.startswith(p)
    return F.coalesce(cond, F.lit(False))


def dataset_slug(spec: Column | str) -> Column:
    """Strip, then each of ``: / @ \\ space`` becomes ``__``."""
    out = py_strip(spec)
    for ch in SLUG_CHARS:
        out = F.replace(out, F.lit(ch), F.lit("__"))
    return out


def remove_suffix(c: Column, suffix: str) -> Column:
    """Python ``str.removesuffix``: drop one trailing ``suffix`` if present."""
    return F.when(c.endswith(suffix), F.substring(c, F.lit(1), F.length(c) - F.lit(len(suffix)))).otherwise(c)


def repo_slug(spec: Column | str) -> Column:
    """Slug minus one trailing ``.git``."""
    return remove_suffix(dataset_slug(spec), ".git")


def output_name(spec: Column | str, split: Column | str) -> Column:
    """Output folder name ``{slug}__{split}`` (the slug keeps its ``.git``)."""
    return F.concat(dataset_slug(spec), F.lit("__"), _c(split))


def clone_url(spec: Column | str) -> Column:
    """Normalise a clone URL: full URLs unchanged; otherwise
    ``https://github.com/{raw}.git``, where a plain ``owner/name.git`` (exactly one
    ``/``, no ``:`` or ``@``) first loses its ``.git``."""
    raw = py_strip(spec)
    full = raw.contains(GIT_URL_INFIX)
    for p in FULL_URL_PREFIXES:
        full = full | raw.startswith(p)
    slashes = F.length(raw) - F.length(F.replace(raw, F.lit("/"), F.lit("")))
    shorthand = (
        raw.endswith(".git") & (slashes == 1) & ~raw.contains(":") & ~raw.contains("@")
    )
    base = F.when(shorthand, F.substring(raw, F.lit(1), F.length(raw) - F.lit(4))).otherwise(raw)
    return F.when(full, raw).otherwise(F.concat(F.lit(GITHUB_PREFIX), base, F.lit(".git")))


def text_preview(c: Column | str, max_chars: int = 2000) -> Column:
    """Null becomes ``""``; strip newlines at both ends; if longer than ``max_chars``,
    keep the first ``max_chars``, right-strip, and append the truncation note."""
    t = strip_newlines(F.coalesce(_c(c), F.lit("")))
    cut = F.concat(py_rstrip(F.substring(t, 1, max_chars)), F.lit(PREVIEW_SUFFIX))
    return F.when(F.length(t) <= max_chars, t).otherwise(cut)


def strip_markers(c: Column | str) -> Column:
    """Delete role starters (in order), then every ``<|...|>`` marker.

    The steps stay separate: a single combined pattern removes different text.
    """
    out = _c(c)
    for m in ROLE_STARTS:
        out = F.replace(out, F.lit(m), F.lit(""))
    return F.regexp_replace(out, F.lit(ANY_MARKER), F.lit(""))
