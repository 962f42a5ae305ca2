"""Chat templates: render message arrays to training text and generation prompts.

A template maps each message (role, content, optional thinking, position) to a
string Column; ``render`` joins them in order with ``transform`` + ``array_join``,
so rendering is a narrow, codegen-friendly projection with no shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions import markers as M

# ---------------------------------------------------------------------------
# Reasoning-effort levels and their token caps, decoding defaults.
EFFORT_LEVELS = ("low", "medium", "high")
EFFORT_MAX_NEW_TOKENS = {"low": 512, "medium": 1024, "high": 2048}
DEFAULT_MAX_NEW_TOKENS = 512
DEFAULT_TEMPERATURE = 0.7
DEFAULT_TOP_P = 0.9
DEFAULT_DO_SAMPLE = True
# ---------------------------------------------------------------------------


class ChatTemplate:
    """Base class: subclasses define how one message renders."""

    def message(self, role: Column, content: Column, thinking: Column, is_last: Column) -> Column:
        raise NotImplementedError

    def preamble(self, effort: Column | None) -> Column:
        return F.lit("")

    def generation_prompt(self) -> Column:
        return F.lit("")

    def render(
        self,
        messages: Column,
        *,
        add_generation_prompt: bool = False,
        effort: Column | None = None,
        has_thinking: bool = False,
    ) -> Column:
        """One string per message array (untokenised)."""
        n = F.size(messages)

        def one(m: Column, i: Column) -> Column:
            thinking = m["thinking"] if has_thinking else F.lit(None).cast("string")
            role = F.coalesce(m["role"], F.raise_error(F.lit("a message has no role")).cast("string"))
            return self.message(role, F.coalesce(m["content"], F.lit("")), thinking, i == n - 1)

        body = F.array_join(F.transform(messages, one), "")
        parts = [self.preamble(effort), body]
        if add_generation_prompt:
            parts.append(self.generation_prompt())
        return F.concat(*parts)


@dataclass(frozen=True)
class ChannelTemplate(ChatTemplate):
    """Default template built from the channel markers of the completions.

    * non-assistant: ``<|start|>{role}<|message|>{content}<|end|>``
    * assistant: optional ``<|start|>assistant<|channel|>analysis<|message|>{thinking}<|end|>``,
      then ``<|start|>assistant<|channel|>final<|message|>{content}``, closed by
      ``<|return|>`` when it is the last message and ``<|end|>`` otherwise
    * effort: a leading ``<|start|>system<|message|>Reasoning: {effort}<|end|>``
    * generation prompt: a trailing ``<|start|>assistant``
    """

    def message(self, role: Column, content: Column, thinking: Column, is_last: Column) -> Column:
        other = F.concat(F.lit("<|start|>"), role, F.lit("<|message|>"), content, F.lit("<|end|>"))
        think = F.when(
            thinking.isNotNull() & (thinking != ""),
            F.concat(F.lit(M.START_ASSISTANT + M.ANALYSIS_START), thinking, F.lit(M.ANALYSIS_END)),
        ).otherwise(F.lit(""))
        final_end = F.when(is_last, F.lit(M.FINAL_END)).otherwise(F.lit(M.ANALYSIS_END))
        assistant = F.concat(think, F.lit(M.FINAL_START), content, final_end)
        return F.when(role == "assistant", assistant).otherwise(other)

    def preamble(self, effort: Column | None) -> Column:
        if effort is None:
            return F.lit("")
        return F.when(
            effort.isNotNull(),
            F.concat(F.lit("<|start|>system<|message|>Reasoning: "), effort, F.lit("<|end|>")),
        ).otherwise(F.lit(""))

    def generation_prompt(self) -> Column:
        return F.lit(M.START_ASSISTANT)


DEFAULT_TEMPLATE = ChannelTemplate()


_EXPR_CACHE: dict[tuple, Column] = {}


def _render_expr(
    template: ChatTemplate, messages_col: str, add_generation_prompt: bool, effort_col: str | None, has_thinking: bool
) -> Column:
    """The render expression for a column name, built once per SparkContext (it takes
    many client calls to construct; unresolved expressions are plan-independent)."""
    from pyspark import SparkContext

    sc = SparkContext._active_spark_context
    try:
        key = (sc.applicationId, sc.startTime, template, messages_col, add_generation_prompt, effort_col, has_thinking)
        hash(key)
    except TypeError:  # an unhashable custom template: build every time
        key = None
    if key is not None and key in _EXPR_CACHE:
        return _EXPR_CACHE[key]
    expr = template.render(
        F.col(messages_col),
        add_generation_prompt=add_generation_prompt,
        effort=F.col(effort_col) if effort_col else None,
        has_thinking=has_thinking,
    )
    if key is not None:
        _EXPR_CACHE[key] = expr
    return expr


def _with_thinking(df: DataFrame, messages_col: str) -> bool:
    elem = df.schema[messages_col].dataType.elementType
    return "thinking" in elem.fieldNames()


def render_messages(
    df: DataFrame,
    messages_col: str = "messages",
    *,
    template: ChatTemplate = DEFAULT_TEMPLATE,
    out_col: str = "text",
    keep: list[str] | None = None,
) -> DataFrame:
    """Render each message list to one ``text`` column (no generation prompt)."""
    require_messages(df, messages_col)
    keep = [c for c in (keep if keep is not None else df.columns) if c != messages_col and c != out_col]
    text = _render_expr(template, messages_col, False, None, _with_thinking(df, messages_col))
    return df.select(*keep, text.alias(out_col))


def render_prompts(
    df: DataFrame,
    messages_col: str = "messages",
    *,
    effort_col: str | None = None,
    template: ChatTemplate = DEFAULT_TEMPLATE,
    out_col: str = "prompt",
) -> DataFrame:
    """Render a generation prompt: the messages, the optional effort preamble and
    the opening of an assistant turn."""
    require_messages(df, messages_col)
    prompt = _render_expr(template, messages_col, True, effort_col, _with_thinking(df, messages_col))
    keep = [c for c in df.columns if c != messages_col]
    return df.select(*keep, prompt.alias(out_col))


def require_messages(df: DataFrame, messages_col: str = "messages") -> None:
    """Fail at plan time when the ``messages`` column is missing."""
    if messages_col not in df.columns:
        raise ValueError(f"no column '{messages_col}' with messages among {df.columns}")


def effort_grid(df: DataFrame, levels=EFFORT_LEVELS, caps=EFFORT_MAX_NEW_TOKENS) -> DataFrame:
    """Every row once per reasoning-effort level, with that level's token cap.

    The levels are a literal array expanded by ``inline`` in the same stage: a
    fixed fan-out of ``len(levels)`` per row, no join and no shuffle.
    """
    grid = F.array(
        *[
            F.struct(F.lit(lvl).alias("effort"), F.lit(int(caps[lvl])).alias("max_new_tokens"))
            for lvl in levels
        ]
    )
    return df.select("*", F.inline(grid))


def request_params(
    df: DataFrame,
    *,
    do_sample: bool | Column = DEFAULT_DO_SAMPLE,
    temperature: float = DEFAULT_TEMPERATURE,
    top_p: float = DEFAULT_TOP_P,
    max_new_tokens: int = DEFAULT_MAX_NEW_TOKENS,
) -> DataFrame:
    """Decoding parameters per request; temperature and top_p only when sampling."""
    sample = do_sample if isinstance(do_sample, Column) else F.lit(bool(do_sample))
    out = df
    if "max_new_tokens" not in df.columns:
        out = out.withColumn("max_new_tokens", F.lit(int(max_new_tokens)))
    return out.withColumns(
        {
            "do_sample": sample,
            "temperature": F.when(sample, F.lit(float(temperature)).cast("double")),
            "top_p": F.when(sample, F.lit(float(top_p)).cast("double")),
        }
    )
