"""Hypothesis properties (plain Python, no Spark): incremental segmentation equals
whole-text segmentation and the hand-written scanner for any text and any cuts;
stripping is idempotent on text without stray marker pieces."""

from hypothesis import given, settings
from hypothesis import strategies as st

from quire.functions import markers as M
from quire.streaming.segmenter import consume, strip_markers
from test_segments import scan

TOKENS = [
    M.ANALYSIS_START, M.ANALYSIS_END, M.FINAL_START, M.FINAL_END, M.COMMENTARY_START, M.TOOL_START, M.TOOL_END,
    M.START_ASSISTANT, "<|channel|>", "<|message|>", "<|start|>", "<|", "|>", "a", "b c", "\n", "é", "😀",
]

texts = st.lists(st.sampled_from(TOKENS), max_size=25).map("".join)


@settings(max_examples=1500, deadline=None)
@given(texts, st.lists(st.integers(min_value=0, max_value=400), max_size=8))
def test_any_cutting_equals_whole_text(text, cuts):
    cuts = sorted({c % (len(text) + 1) for c in cuts})
    pieces = [text[a:b] for a, b in zip([0] + cuts, cuts + [len(text)])]
    buf, rows = "", []
    for p in pieces:
        out, buf = consume(buf + p, final=False)
        rows.extend(out)
    out, buf = consume(buf, final=True)
    rows.extend(out)
    assert buf == ""
    assert [(i, *r) for i, r in enumerate(rows)] == scan(text)


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from(["a", " ", "\n", "<|end|>", "<|x|>", "<|start|>assistant", "é"]), max_size=20).map("".join))
def test_strip_is_idempotent_without_stray_pieces(text):
    once = strip_markers(text)
    assert strip_markers(once) == once
