"""Rows every operator must take: nulls, empties, ties, repeats, long texts, clashing extra columns."""

import random

WORDS = [a + b for a in "ka lo mi tu re sa no vi".split() for b in "pa de ri so lu".split()]


def sentence(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) for _ in range(n))


def awkward(spark):
    """Documents with every awkward case; ``text`` and ``n_chars`` clash with names operators use inside."""
    long = sentence(1, 6000)
    rows = [(1, None, None, None), (2, "", "", "s1"), (3, "   \n", "en", "s1"), (4, "one", "en", None), (5, long, "en", "s2"),
            (6, long, "en", "s2"), (6, long, "en", "s2"), (7, sentence(2, 80), "fr", "s1"), (8, sentence(2, 80), "fr", "s3"),
            (9, "é日\U0001f600 " * 30, "xx", "s1"), (None, sentence(3, 90), None, None), (10, "a" * 3000, "en", "s1")]
    rows = [(i, t, la, s, len(t or ""), "x", "y", 0, 1.0) for i, t, la, s in rows]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, id string, th string, row int, size double")
