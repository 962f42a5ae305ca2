"""Construction of ``messages: array<struct<role,content>>`` columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.chunk import chunk_label
from quire.functions.text import py_strip

MESSAGE_TYPE = "array<struct<role:string,content:string>>"

# ---------------------------------------------------------------------------
# Fixed values.
FILE_PROMPT_TAIL = "Write the full contents of this file."
DEFAULT_ROLE_MAP = {
    "human": "user",
    "gpt": "assistant",
    "user": "user",
    "assistant": "assistant",
    "system": "system",
    "developer": "developer",
}
REASONING_LANGUAGE_PREFIX = "reasoning language: "
DEFAULT_INSTRUCTION = "You are a helpful assistant that can solve mathematical problems."
LANGUAGE_NAMES = {
    "en": "English",
    "fr": "French",
    "de": "German",
    "es": "Spanish",
    "it": "Italian",
    "pt": "Portuguese",
    "nl": "Dutch",
    "ru": "Russian",
    "zh": "Chinese",
    "ja": "Japanese",
    "ko": "Korean",
    "ar": "Arabic",
    "hi": "Hindi",
}
# ---------------------------------------------------------------------------


def message(role: Column | str, content: Column) -> Column:
    r = F.lit(role) if isinstance(role, str) else role
    return F.struct(r.alias("role"), content.alias("content"))


def file_prompt(repo: Column, path: Column, label: Column) -> Column:
    return F.concat(
        F.lit("Repository: "), repo, F.lit("\nFile: "), path, label, F.lit("\n\n" + FILE_PROMPT_TAIL)
    )


def file_messages(chunks: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Chunk rows (``repo, path, chunk_idx, chunk_cnt, chunk``) → a user message asking
    for the file and an assistant message holding the piece. ``repo`` is the spec
    as given."""
    keys = keys if keys is not None else ["repo", "path", "chunk_idx"]
    label = chunk_label(F.col("chunk_idx"), F.col("chunk_cnt"))
    msgs = F.array(
        message("user", file_prompt(F.col("repo"), F.col("path"), label)),
        message("assistant", F.col("chunk")),
    )
    return chunks.select(*keys, msgs.alias("messages"))


def standardize_roles(
    df: DataFrame,
    conv_col: str = "conversations",
    *,
    role_map: dict[str, str] | None = None,
    from_field: str = "from",
    value_field: str = "value",
    out_col: str = "messages",
) -> DataFrame:
    """ShareGPT-like ``array<struct<from,value>>`` → ``messages``. Roles map through
    ``role_map``; an unknown role fails the task that meets it."""
    role_map = role_map or DEFAULT_ROLE_MAP
    lookup = F.create_map(*[F.lit(x) for kv in role_map.items() for x in kv])

    def conv(t: Column) -> Column:
        mapped = F.element_at(lookup, t[from_field])
        role = F.when(mapped.isNotNull(), mapped).otherwise(
            F.raise_error(F.concat(F.lit("unknown role: "), F.coalesce(t[from_field], F.lit("null"))))
        )
        return message(role.cast("string"), t[value_field])

    keep = [c for c in df.columns if c != conv_col]
    return df.select(*keep, F.transform(F.col(conv_col), conv).alias(out_col))


def to_sharegpt(df: DataFrame, messages_col: str = "messages", out_col: str = "conversations") -> DataFrame:
    """Inverse shape: ``messages`` → ``array<struct<from,value>>`` (user→human, assistant→gpt)."""
    def conv(m: Column) -> Column:
        frm = F.when(m["role"] == "user", F.lit("human")).when(m["role"] == "assistant", F.lit("gpt")).otherwise(m["role"])
        return F.struct(frm.alias("from"), m["content"].alias("value"))

    keep = [c for c in df.columns if c != messages_col]
    return df.select(*keep, F.transform(F.col(messages_col), conv).alias(out_col))


# A conversation is assembled in one task as one row; a larger one is refused by name (a row cannot pass 2 GB).
MAX_CONVERSATION_BYTES = 128 << 20
# What a turn takes beside its text.
TURN_BYTES = 64


def oversized(turns: DataFrame, key: str = "conv_id", text_col: str = "text", max_bytes: int = MAX_CONVERSATION_BYTES) -> DataFrame:
    """Conversations above a bound: ``key, turns, bytes``. Summed per task before the shuffle, so a conversation of
    any length is a number from the start and none is ever gathered."""
    size = F.sum(F.coalesce(F.octet_length(text_col), F.lit(0)).cast("bigint") + TURN_BYTES)
    per = turns.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("turns"), size.alias("bytes"))
    return per.where(F.col("bytes") > int(max_bytes))


def turns_to_messages(
    turns: DataFrame,
    key: str = "conv_id",
    order: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    out_col: str = "messages",
    max_bytes: int | None = MAX_CONVERSATION_BYTES,
    on_oversize: str = "error",
) -> DataFrame:
    """Flat turns → one ordered ``messages`` array per conversation.

    ``collect_list`` has no order, so the turn number travels inside the struct and
    ``array_sort`` orders by it. The partial aggregate runs map-side. One output row
    holds one conversation of at most ``max_bytes``: turns of larger ones are left out before
    they are gathered, so all others are assembled. With ``on_oversize="error"`` the first of
    them then fails its task by name, with ``"skip"`` they are absent (``oversized`` names them);
    ``max_bytes=None`` spares the sums where conversations are known to be bounded. A turn
    without a key belongs to no conversation and fails the task that meets it.
    """
    if on_oversize not in ("error", "skip"):
        raise ValueError(f"on_oversize is 'error' or 'skip', got {on_oversize!r}")
    kept, large = turns, None
    if max_bytes is not None:
        large = oversized(turns, key, text_col, max_bytes)
        kept = turns.join(large.select(key), key, "left_anti")
    keyed = F.coalesce(F.col(key), F.raise_error(F.lit(f"a turn has no {key}")).cast(turns.schema[key].dataType))
    packed = F.struct(F.col(order).alias("o"), F.col(role_col).alias("role"), F.col(text_col).alias("content"))
    out = (
        kept.groupBy(keyed.alias(key))
        .agg(F.array_sort(F.collect_list(packed)).alias("_t"))
        .select(key, F.transform("_t", lambda t: message(t["role"], t["content"])).alias(out_col))
    )
    if large is None or on_oversize == "skip":
        return out
    said = F.concat(F.lit(f"{key} "), F.col(key).cast("string"), F.lit(" has "), F.col("bytes").cast("string"), F.lit(" bytes in "),
                    F.col("turns").cast("string"), F.lit(f" turns; a conversation holds {int(max_bytes)} at most"))
    # in a filter, so that no choice of columns prunes it
    refused = large.where(F.raise_error(said).cast("boolean")).select(key, F.lit(None).cast(out.schema[out_col].dataType).alias(out_col))
    return out.unionByName(refused)


def prompt_messages(
    df: DataFrame,
    user_col: str = "user_text",
    developer_col: str | None = "developer",
    out_col: str = "messages",
) -> DataFrame:
    """Optional developer message (stripped; blank = none), then the stripped user text."""
    user = message("user", py_strip(F.col(user_col)))
    if developer_col is None:
        msgs = F.array(user)
    else:
        dev = py_strip(F.col(developer_col))
        dev_msg = F.when(dev.isNotNull() & (dev != ""), message("developer", dev))
        msgs = F.filter(F.array(dev_msg, user), lambda m: m.isNotNull())
    keep = [c for c in df.columns if c not in (user_col, developer_col)]
    return df.select(*keep, msgs.alias(out_col))


def language_name(code: Column) -> Column:
    """Language name for a code from a fixed literal map (no join); unknown codes pass through."""
    lookup = F.create_map(*[F.lit(x) for kv in LANGUAGE_NAMES.items() for x in kv])
    return F.coalesce(F.element_at(lookup, code), code)


def with_language_system_prompt(
    df: DataFrame,
    lang_col: str = "lang",
    messages_col: str = "messages",
    instruction: str = DEFAULT_INSTRUCTION,
) -> DataFrame:
    """Prepend ``system: "reasoning language: {Language}\\n\\n{instruction}"``."""
    sys_msg = message(
        "system",
        F.concat(F.lit(REASONING_LANGUAGE_PREFIX), language_name(F.col(lang_col)), F.lit("\n\n" + instruction)),
    )
    return df.withColumn(messages_col, F.concat(F.array(sys_msg), F.col(messages_col)))


def explode_messages(df: DataFrame, keys: list[str], messages_col: str = "messages") -> DataFrame:
    """Flat view ``keys..., msg_idx, role, content`` (0-based position)."""
    return (
        df.select(*keys, F.posexplode_outer(messages_col).alias("msg_idx", "_m"))
        .where(F.col("msg_idx").isNotNull())
        .select(*keys, F.col("msg_idx").cast("bigint").alias("msg_idx"), F.col("_m.role").alias("role"), F.col("_m.content").alias("content"))
    )
