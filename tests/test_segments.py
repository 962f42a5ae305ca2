"""Completion segmentation: a hand-written whole-text scanner (no regex for the
grammar) is the reference; Spark's regex form and the incremental segmenter
must agree with it."""

import random


from quire.functions import markers as M
from quire.operators.segments import completion_segments, transcripts
from quire.streaming.segmenter import consume, segments as py_segments, strip_markers as strip

# Start markers and the channel each opens; at any position at most one of them
# matches in full, so the scanner needs no priority among them.
STARTS = {
    M.ANALYSIS_START: "analysis",
    M.FINAL_START: "final",
    M.START_ASSISTANT + M.COMMENTARY_START: "commentary",
    M.COMMENTARY_START: "commentary",
    M.START_ASSISTANT + M.TOOL_START: "tool",
    M.TOOL_START: "tool",
}
ENDS = {"analysis": M.ANALYSIS_END, "commentary": M.ANALYSIS_END, "tool": M.TOOL_END, "final": M.FINAL_END}


def scan(text):
    """Whole-text scanner: raw text up to the leftmost position where a start
    marker matches, then the segment up to its end marker (or the end of text)."""
    out, i = [], 0

    def raw(piece):
        r = strip(piece)
        if r:
            out.append(("raw", r, True))

    while True:
        hits = [(text.find(s, i), s) for s in STARTS if text.find(s, i) != -1]
        if not hits:
            raw(text[i:])
            break
        idx = min(h[0] for h in hits)
        start = max((s for h, s in hits if h == idx), key=len)
        raw(text[i:idx])
        ch = STARTS[start]
        j = idx + len(start)
        e = text.find(ENDS[ch], j)
        if e == -1:
            out.append((ch, strip(text[j:]), False))
            break
        body = text[j:e]
        out.append((ch, body if ch in ("analysis", "final") else strip(body), True))
        i = e + len(ENDS[ch])
    return [(p, *r) for p, r in enumerate(out)]


PIECES = [
    M.ANALYSIS_START, M.ANALYSIS_END, M.FINAL_START, M.FINAL_END, M.COMMENTARY_START, M.TOOL_START, M.TOOL_END,
    M.START_ASSISTANT, "<|channel|>final<|message|>", "<|start|>system", "<|x|>", "<|", "|>", "hi ", "\n", "é", "😀",
]


def random_texts(n, seed):
    rnd = random.Random(seed)
    return ["".join(rnd.choices(PIECES, k=rnd.randint(0, 14))) for _ in range(n)]


def test_python_segmenter_matches_scanner():
    for t in random_texts(3000, 1):
        assert py_segments(t) == scan(t), t


def test_spark_matches_scanner(spark):
    texts = random_texts(1500, 2)
    df = spark.createDataFrame(list(enumerate(texts)), "completion_id long, text string")
    got = {}
    for r in completion_segments(df).collect():
        got.setdefault(r.completion_id, []).append((r.pos, r.channel, r.content, r.closed))
    for i, t in enumerate(texts):
        assert sorted(got.get(i, [])) == scan(t), t


def test_incremental_equals_whole_for_any_split():
    rnd = random.Random(5)
    for t in random_texts(2000, 3):
        cuts = sorted(rnd.sample(range(len(t) + 1), k=min(len(t) + 1, rnd.randint(0, 6))))
        pieces = [t[a:b] for a, b in zip([0] + cuts, cuts + [len(t)])]
        buf, rows = "", []
        for p in pieces:
            out, buf = consume(buf + p, final=False)
            rows.extend(out)
        out, buf = consume(buf, final=True)
        rows.extend(out)
        assert [(i, *r) for i, r in enumerate(rows)] == scan(t)


def test_fixture_edges(spark):
    cases = {
        1: "<|channel|>final<|message|>x",
        2: M.FINAL_START + "a<|end|>b" + M.FINAL_END,
        3: M.TOOL_START + "f(" + M.ANALYSIS_START + "z" + M.TOOL_END,
        4: M.ANALYSIS_START + "t1" + M.ANALYSIS_END + M.ANALYSIS_START + "t2" + M.ANALYSIS_END + M.FINAL_START + "ok" + M.FINAL_END,
        5: M.ANALYSIS_START + "never ends",
        6: "",
    }
    df = spark.createDataFrame(list(cases.items()), "completion_id long, text string")
    segs = {}
    for r in completion_segments(df).collect():
        segs.setdefault(r.completion_id, []).append((r.channel, r.content, r.closed))
    assert segs[1] == [("raw", "finalx", True)]
    assert segs[2] == [("final", "a<|end|>b", True)]
    assert segs[3] == [("tool", "f(analysisz", True)]
    assert segs[5] == [("analysis", "never ends", False)]
    assert 6 not in segs
    tr = dict(transcripts(df).collect())
    assert tr[4] == "Thinking: t1t2\n\nok"
    assert tr[3] == "Tool: f(analysisz\n"
    assert tr[6] == ""
