"""Generation requests: chat inputs → prompt messages → prompts per effort → decoding parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions.text import py_strip
from quire.operators.messages import prompt_messages
from quire.operators.template import (
    DEFAULT_DO_SAMPLE,
    DEFAULT_MAX_NEW_TOKENS,
    EFFORT_LEVELS,
    DEFAULT_TEMPERATURE,
    DEFAULT_TEMPLATE,
    DEFAULT_TOP_P,
    ChatTemplate,
    effort_grid,
    render_prompts,
    request_params,
)


def nonblank_inputs(df: DataFrame, user_col: str = "user_text") -> DataFrame:
    """Drop inputs whose user text is blank after a Unicode strip."""
    return df.where(py_strip(F.col(user_col)) != "")


def generation_requests(
    inputs: DataFrame,
    *,
    efforts: bool = True,
    effort: str | None = None,
    max_new_tokens: int = DEFAULT_MAX_NEW_TOKENS,
    do_sample: bool = DEFAULT_DO_SAMPLE,
    temperature: float = DEFAULT_TEMPERATURE,
    top_p: float = DEFAULT_TOP_P,
    template: ChatTemplate = DEFAULT_TEMPLATE,
) -> DataFrame:
    """``id, developer, user_text`` → ``id, effort, prompt, max_new_tokens, do_sample,
    temperature, top_p``.

    With ``efforts`` (default): one request per input and effort level, each with
    its level's token cap. Without: one request per input at the single ``effort``
    (or none) with ``max_new_tokens``."""
    msgs = prompt_messages(nonblank_inputs(inputs))
    if efforts:
        msgs = effort_grid(msgs)
        prompts = render_prompts(msgs, effort_col="effort", template=template)
    else:
        if effort is not None and effort not in EFFORT_LEVELS:
            raise ValueError(f"effort must be one of {EFFORT_LEVELS}, got {effort!r}")
        msgs = msgs.withColumn("effort", F.lit(effort).cast("string"))
        prompts = render_prompts(msgs, effort_col="effort", template=template)
        prompts = prompts.withColumn("max_new_tokens", F.lit(int(max_new_tokens)))
    out = request_params(prompts, do_sample=do_sample, temperature=temperature, top_p=top_p)
    return out.select(
        "id", "effort", "prompt", F.col("max_new_tokens").cast("bigint").alias("max_new_tokens"),
        "do_sample", "temperature", "top_p",
    )
