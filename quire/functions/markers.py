"""Channel markers of marked-up model completions and their segmentation patterns.

A completion interleaves raw text with marked segments. Outside a segment the
leftmost start marker wins; a segment runs lazily to its end marker or, if none
follows, to the end of the text (then it is *open*, ``closed = false``).

| channel    | start marker(s)                                    | end marker                  |
|------------|----------------------------------------------------|-----------------------------|
| analysis   | [<|start|>assistant]<|channel|>analysis<|message|> | <|end|>                     |
| commentary | [<|start|>assistant]<|channel|>commentary<|message|> | <|end|>                   |
| tool       | [<|start|>assistant]<|channel|>commentary to=functions> | <|call|>commentary<|end|> |
| final      | <|start|>assistant<|channel|>final<|message|>       | <|return|>                  |

Closed analysis and final bodies keep inner markers; commentary, tool, raw text
and any open body have markers stripped (see ``text.strip_markers``).
"""

from __future__ import annotations

import re

# ---------------------------------------------------------------------------
# Fixed marker strings.
START_ASSISTANT = "<|start|>assistant"
CHANNEL = "<|channel|>"
ANALYSIS_START = "<|channel|>analysis<|message|>"
ANALYSIS_END = "<|end|>"
FINAL_START = "<|start|>assistant<|channel|>final<|message|>"
FINAL_END = "<|return|>"
COMMENTARY_START = "<|channel|>commentary<|message|>"
TOOL_START = "<|channel|>commentary to=functions>"
TOOL_END = "<|call|>commentary<|end|>"
# Rendering of a transcript.
THINKING_PREFIX = "Thinking: "
COMMENTARY_PREFIX = "Commentary: "
TOOL_PREFIX = "Tool: "
FINAL_PREFIX = "\n\n"
# ---------------------------------------------------------------------------

CHANNEL_END = {
    "analysis": ANALYSIS_END,
    "commentary": ANALYSIS_END,
    "tool": TOOL_END,
    "final": FINAL_END,
}


def _q(s: str) -> str:
    return re.escape(s).replace("\\ ", " ")


def _lazy_to(end: str) -> str:
    return ".*?(?:" + _q(end) + r"|\z)"


# One pattern for all segments; the same text is valid Java regex and RE2.
SEGMENT_PATTERN = (
    "(?s)(?:" + _q(START_ASSISTANT) + ")?" + _q(CHANNEL) + "(?:"
    + _q("analysis<|message|>") + _lazy_to(ANALYSIS_END) + "|"
    + _q("commentary<|message|>") + _lazy_to(ANALYSIS_END) + "|"
    + _q("commentary to=functions>") + _lazy_to(TOOL_END) + ")"
    + "|" + _q(FINAL_START) + _lazy_to(FINAL_END)
)

# Start marker of a matched segment (group 1), for splitting head from body.
SEGMENT_HEAD_PATTERN = (
    "(?s)^((?:" + _q(START_ASSISTANT) + ")?" + _q(CHANNEL)
    + "(?:" + _q("analysis<|message|>") + "|" + _q("commentary<|message|>") + "|"
    + _q("commentary to=functions>") + ")|" + _q(FINAL_START) + ")"
)
