"""

Every query reads the given tables (or views Spark derives from them) in full;
limits appear only where the operator *is* a top-k / first-N selection.
Counters are ``bigint`` on both sides; every computed column is aliased to the
same name in Spark and SQL.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import text as TX
from quire.functions.chunk import chunk_label
from quire.operators import epochs as EP
from quire.operators import files as FL
from quire.operators import messages as MS
from quire.operators import parts as PT
from quire.operators import segments as SG
from quire.operators import select as SL
from quire.operators import shaping as SH
from quire.operators import template as TP
from quire.plans import chat as CH
from quire.plans import prepare as PR
from quire.plans import train as TR
from quire.sources import tables as TB
from quire.streaming.completions import segment_stream

SMOKE_DIR = "/root/testdata/sf0.001"

# Parameters of the registered queries (reference defaults, plus the small-piece
# and small-file settings that make the filters and cuts bite on the test tables).
SMALL_MAX_CHARS = 500
SMALL_MAX_FILE_BYTES = 3000  # of the size filter's own query
FULL_MAX_FILE_BYTES = 250_000
FIRST_N_SAMPLES = 512
FIRST_N_CONVERSATIONS = 50
PER_REPO_SAMPLES = 5


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return TB.read_table(spark, d, name)


def _source_files(spark, d):
    return TB.source_files(_t(spark, d, "documents"))


def _specs(spark, d):
    return TB.dataset_specs(_t(spark, d, "pages"))


def _completions(spark, d):
    return TB.completions(_t(spark, d, "conversations"))


def _chat_inputs(spark, d):
    return TB.chat_inputs(_t(spark, d, "conversations"))


def _small_samples(spark, d):
    return PR.file_samples(_source_files(spark, d), max_chars=SMALL_MAX_CHARS)


def _training_text(spark, d):
    return PR.training_text(_source_files(spark, d))


def _conv_text(spark, d):
    return PR.conversation_training_text(_t(spark, d, "conversations"))


def _merged_lengths(documents: DataFrame) -> DataFrame:
    """The quantiles of sketches merged over all sources, each with whether its rank is within the sketch's error."""
    got = PT.length_quantiles(PT.length_sketches(documents, ["source"]))
    n, c = F.col("n"), F.col("c")
    counts = documents.where("text is not null").select(SH.approx_tokens(F.col("text")).alias("n")).groupBy("n").agg(F.count(F.lit(1)).alias("c"))
    told = []
    for q in (0.5, 0.9, 0.99):
        v = got.select(f"p{q * 100:g}").scalar()
        below, upto = F.sum(F.when(n < v, c).otherwise(0)), F.sum(F.when(n <= v, c).otherwise(0))
        near = (below <= (q + PT.RANK_ERROR) * F.sum(c) + 1) & (upto >= (q - PT.RANK_ERROR) * F.sum(c) - 1)
        told.append(F.struct(F.lit(q).alias("q"), got.select("samples").scalar().alias("samples"), got.select("max_tokens").scalar().alias("max_tokens"), near.alias("within")))
    return counts.agg(F.array(*told).alias("t")).select(F.inline("t"))


STEPS_BATCH, STEPS_ACCUM, STEPS_MORE = 2, 4, 10


def _steps_by_index(table: DataFrame) -> DataFrame:
    steps = -(-table.count() // (STEPS_BATCH * STEPS_ACCUM)) + STEPS_MORE
    return EP.steps_of(table, 1, steps, batch_size=STEPS_BATCH, grad_accum=STEPS_ACCUM)


def _steps_sql() -> str:
    """The rounds of the order, one after the other; documents are stored in the order of their ids."""
    per = STEPS_BATCH * STEPS_ACCUM
    hexed = lambda of, n: f"md5('{SH.DEFAULT_SEED}:' || epoch || ':' || {of})[1:{n}]"
    rounds = "".join(f"""
k{r} as (select position, epoch, n, x, (('0x' || {hexed(f"'{r}'", EP.KEY_DIGITS)})::bigint % n - x + n) % n as y from x{r}),
x{r + 1} as (select position, epoch, n, case when contains('13579bdf', {hexed(f"'{r}:' || greatest(x, y)", 1)}) then y else x end as x from k{r}),"""
                     for r in range(EP.ROUNDS))
    return f"""with t as (select doc_id, row_number() over (order by doc_id) - 1 as row from documents),
s as (select count(*) as n, (cast(ceil(count(*) / {per}) as bigint) + {STEPS_MORE}) * {per} as budget from t),
x0 as (select position, position // n as epoch, n, position % n as x from (select unnest(range(budget)) as position, n from s)),{rounds}
done as (select * from x{EP.ROUNDS})
select doc_id, position, cast(epoch as bigint) as epoch, cast(position // {per} + 1 as bigint) as step,
       cast(position // {STEPS_BATCH} % {STEPS_ACCUM} + 1 as bigint) as micro
from done join t on t.row = done.x"""


def _chunks(spark, d, m):
    docs = _t(spark, d, "documents").select("doc_id", "text")
    return FL.chunk_files(docs, "text", m, keys=["doc_id"]).withColumn("chunk_idx", F.col("chunk_idx").cast("bigint")).withColumn(
        "chunk_cnt", F.col("chunk_cnt").cast("bigint")
    )


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: documents as a source tree → filters → chunks → messages → text."""
    return _training_text(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """One entry per operator of SURVEY §2 (see COVERAGE.md) and per composed flow;
    each callable takes ``(spark, sf_dir)`` and returns a lazy DataFrame."""
    q: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

    # --- sources -----------------------------------------------------------
    q["scan_conversations"] = lambda s, d: TB.scan_conversations(s, os.path.join(d, "conversations.parquet")).select(
        "conv_id", "turn", "role", "text"
    )
    q["scan_split"] = lambda s, d: TB.scan_conversations(
        s, os.path.join(d, "conversations.parquet"), split="user", split_col="role"
    ).select("conv_id", "turn", "text")
    q["pick_split"] = lambda s, d: SL.pick_split(_t(s, d, "documents").select("doc_id", "lang"), "lang", "train")
    q["pick_train"] = lambda s, d: SL.pick_split(_t(s, d, "documents").select(
        "doc_id", F.when(F.col("lang") == "en", "train").otherwise(F.col("lang")).alias("split")), "split", "train")

    # --- filters and scalar functions ---------------------------------------
    q["filter_source_ext"] = lambda s, d: FL.keep_source_extensions(_source_files(s, d)).select("repo", "path", "size")
    q["filter_vcs_dirs"] = lambda s, d: FL.drop_vcs_paths(_source_files(s, d)).select("repo", "path", "size")
    q["filter_file_size"] = lambda s, d: FL.keep_file_size(_source_files(s, d), SMALL_MAX_FILE_BYTES).select(
        "repo", "path", "size"
    )
    q["normalize_newlines"] = lambda s, d: _t(s, d, "documents").select(
        "doc_id", TX.normalize_newlines("text").alias("text")
    )
    q["nonblank_user_turns"] = lambda s, d: _t(s, d, "conversations").where(
        (F.col("role") == "user") & (TX.py_strip("text") != "")
    ).select("conv_id", "turn", "text")
    q["classify_specs"] = lambda s, d: _specs(s, d).select("page_id", "spec", TX.is_git_spec("spec").alias("is_git"))
    q["dataset_slug"] = lambda s, d: _specs(s, d).select("page_id", TX.dataset_slug("spec").alias("slug"))
    q["repo_slug"] = lambda s, d: _specs(s, d).select("page_id", TX.repo_slug("spec").alias("repo_slug"))
    q["output_name"] = lambda s, d: _specs(s, d).select(
        "page_id", TX.output_name("spec", F.lit("train")).alias("output_name")
    )
    q["clone_url"] = lambda s, d: _specs(s, d).select("page_id", TX.clone_url("spec").alias("clone_url"))
    q["text_preview"] = lambda s, d: _t(s, d, "documents").select("doc_id", TX.text_preview("text").alias("preview"))
    q["strip_markers"] = lambda s, d: _completions(s, d).select(
        "completion_id", TX.strip_markers("text").alias("stripped")
    )

    # --- chunking ------------------------------------------------------------
    q["chunk_documents"] = lambda s, d: _chunks(s, d, 12_000).select("doc_id", "chunk_idx", "chunk")
    q["chunk_documents_500"] = lambda s, d: _chunks(s, d, SMALL_MAX_CHARS).select("doc_id", "chunk_idx", "chunk")
    q["chunk_positions"] = lambda s, d: _chunks(s, d, SMALL_MAX_CHARS).select("doc_id", "chunk_idx", "chunk_cnt")
    q["chunk_labels"] = lambda s, d: _chunks(s, d, SMALL_MAX_CHARS).select(
        "doc_id", "chunk_idx", chunk_label(F.col("chunk_idx"), F.col("chunk_cnt")).alias("chunk_label")
    )

    # --- messages ------------------------------------------------------------
    q["file_messages"] = lambda s, d: MS.explode_messages(_small_samples(s, d), ["repo", "path", "chunk_idx"]).withColumn(
        "chunk_idx", F.col("chunk_idx").cast("bigint")
    )
    q["standardize_roles"] = lambda s, d: MS.explode_messages(
        MS.standardize_roles(TB.sharegpt_conversations(_t(s, d, "conversations"))), ["id"]
    )
    q["turns_to_messages"] = lambda s, d: MS.explode_messages(MS.turns_to_messages(_t(s, d, "conversations")), ["conv_id"])
    q["prompt_messages"] = lambda s, d: MS.explode_messages(
        MS.prompt_messages(CH.nonblank_inputs(_chat_inputs(s, d))), ["id"]
    )
    q["language_system_prompt"] = lambda s, d: MS.explode_messages(
        MS.with_language_system_prompt(
            _t(s, d, "documents").select("doc_id", "lang", F.array(MS.message("user", F.col("text"))).alias("messages"))
        ),
        ["doc_id"],
    )

    # --- rendering and requests -----------------------------------------------
    q["render_conversations"] = lambda s, d: TP.render_messages(MS.turns_to_messages(_t(s, d, "conversations")))
    q["render_prompts"] = lambda s, d: TP.render_prompts(MS.prompt_messages(CH.nonblank_inputs(_chat_inputs(s, d))))
    q["effort_grid"] = lambda s, d: TP.render_prompts(
        TP.effort_grid(MS.prompt_messages(CH.nonblank_inputs(_chat_inputs(s, d)))), effort_col="effort"
    ).select("id", "effort", F.col("max_new_tokens").cast("bigint").alias("max_new_tokens"), "prompt")
    q["request_params"] = lambda s, d: CH.generation_requests(_chat_inputs(s, d)).drop("prompt")
    q["request_params_greedy"] = lambda s, d: CH.generation_requests(_chat_inputs(s, d), do_sample=False).drop("prompt")

    # --- selection, counts, report --------------------------------------------
    q["first_samples"] = lambda s, d: TP.render_messages(
        PR.file_samples(
            _source_files(s, d), max_chars=SMALL_MAX_CHARS,
            max_samples=FIRST_N_SAMPLES, cap_per_repo=False,
        ),
        keep=PR.SAMPLE_KEYS,
    ).withColumn("chunk_idx", F.col("chunk_idx").cast("bigint"))
    q["first_conversations"] = lambda s, d: SL.first_groups(_t(s, d, "conversations"), "conv_id", FIRST_N_CONVERSATIONS)
    q["first_samples_per_repo"] = lambda s, d: PR.file_samples(
        _source_files(s, d), max_chars=SMALL_MAX_CHARS,
        max_samples=PER_REPO_SAMPLES, cap_per_repo=True,
    ).select("repo", "path", F.col("chunk_idx").cast("bigint").alias("chunk_idx"))
    # first row in (repo, path, chunk_idx) order; only the first file is chunked
    q["first_sample"] = lambda s, d: TP.render_messages(
        PR.file_samples(_source_files(s, d), max_samples=1, cap_per_repo=False, file_order=("repo", "path")),
        keep=PR.SAMPLE_KEYS,
    ).withColumn("chunk_idx", F.col("chunk_idx").cast("bigint"))
    q["sample_count"] = lambda s, d: SL.sample_count(_training_text(s, d))
    q["corpus_report"] = lambda s, d: SL.corpus_report(_source_files(s, d), max_chars=SMALL_MAX_CHARS)

    # --- training shaping ------------------------------------------------------
    q["training_budget"] = lambda s, d: SH.training_budget(
        TR.sample_id(_training_text(s, d)).select("sample_id", "text"), "sample_id"
    )
    q["training_batches"] = lambda s, d: SH.training_batches(
        TR.sample_id(_training_text(s, d)).select("sample_id", "text"), "sample_id"
    ).select("sample_id", "epoch", "step", "micro")
    # sketches of each source, merged: whether the ranks of their quantiles lie within the stated error
    q["merged_length_quantiles"] = lambda s, d: _merged_lengths(_t(s, d, "documents"))
    # one epoch and the first steps of the next, addressed by step
    q["steps_by_index"] = lambda s, d: _steps_by_index(_t(s, d, "documents").select("doc_id"))
    q["over_length_samples"] = lambda s, d: SH.flag_over_length(_conv_text(s, d)).select("conv_id", "n_tokens", "over_limit")
    # approximate quantiles (relative error 1e-4): at these sizes they are the exact
    # elements of rank ceil(p * n), which the oracle computes
    q["length_summary"] = lambda s, d: SH.length_summary(_conv_text(s, d))

    # --- completions -----------------------------------------------------------
    q["completion_segments"] = lambda s, d: SG.completion_segments(_completions(s, d)).withColumn(
        "pos", F.col("pos").cast("bigint")
    )
    q["final_answers"] = lambda s, d: SG.completion_parts(_completions(s, d))
    q["tool_calls"] = lambda s, d: SG.tool_calls(_completions(s, d)).withColumn("pos", F.col("pos").cast("bigint"))
    q["render_transcript"] = lambda s, d: SG.transcripts(_completions(s, d))
    # the stateful streaming segmenter, fed the completions cut into pieces; on
    # batch input it must give exactly the whole-text segmentation
    q["stream_segments"] = lambda s, d: segment_stream(TB.completion_chunks(_completions(s, d))).withColumn(
        "pos", F.col("pos").cast("bigint")
    )

    # --- composed flows ----------------------------------------------------------
    q["training_text"] = lambda s, d: _training_text(s, d).withColumn("chunk_idx", F.col("chunk_idx").cast("bigint"))
    q["conversation_training_text"] = lambda s, d: _conv_text(s, d)
    q["training_plan"] = lambda s, d: TR.training_plan(_conv_text(s, d))
    q["generation_requests"] = lambda s, d: CH.generation_requests(_chat_inputs(s, d))
    q.update(_llm_queries()[0])
    return q


# ---------------------------------------------------------------------------
# DuckDB oracles. Views below restate the derivations of ``quire.sources.tables``.

# The code points that a Unicode strip removes.
_WS_POINTS = (9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160, 5760, 8192, 8193, 8194, 8195, 8196, 8197, 8198, 8199, 8200, 8201,
              8202, 8232, 8233, 8239, 8287, 12288)
_WS = "concat(" + ", ".join(f"chr({c})" for c in _WS_POINTS) + ")"
NL = "chr(10)"


def _strip(x: str) -> str:
    return f"trim({x}, {_WS})"


def _strip_markers(x: str) -> str:
    return f"regexp_replace(replace(replace(replace({x}, '<|start|>assistant', ''), '<|start|>system', ''), '<|start|>user', ''), '<\\|[^>]+\\|>', '', 'g')"


V_SOURCE_FILES = """source_files as (
  select source as repo,
         concat(case when doc_id % 10 = 0 then '.git/' when doc_id % 10 = 1 then '.github/' else 'pkg/' end,
                case when doc_id % 6 = 0 then '_' else '' end, cast(doc_id as varchar),
                case doc_id % 4 when 0 then '.py' when 1 then '.md' when 2 then '.txt' else '.PY' end) as path,
         cast(strlen(text) as bigint) as size, text
  from documents)"""

V_SPECS = """specs as (
  select page_id, case page_id % 4 when 0 then url
                                   when 1 then concat('repo:owner/', cast(page_id as varchar), '.git')
                                   when 2 then concat('owner/', cast(page_id as varchar), '.git')
                                   else concat(' git@host:o/', cast(page_id as varchar), '.git ') end as spec
  from pages)"""

V_COMPLETIONS = """completions as (
  select a.conv_id * 100 + a.turn as completion_id,
         case when a.conv_id % 7 = 0 then substr(full_text, 1, length(full_text) - 15) else full_text end as text
  from (select a.conv_id, a.turn,
          concat('<|channel|>analysis<|message|>', u.text, '<|end|>',
                 case when a.conv_id % 5 = 0 then '<|start|>assistant<|channel|>commentary to=functions>search({})<|call|>commentary<|end|>' else '' end,
                 '<|start|>assistant<|channel|>final<|message|>', a.text, '<|return|>') as full_text
        from conversations a join conversations u on u.conv_id = a.conv_id and u.turn = a.turn - 1
        where a.role = 'assistant') a)"""

V_CHAT_INPUTS = """chat_inputs as (
  select u.conv_id * 100 + u.turn as id, s.developer, u.text as user_text
  from conversations u
  left join (select conv_id, arg_min(text, turn) as developer from conversations where role = 'system' group by conv_id) s
    on s.conv_id = u.conv_id
  where u.role = 'user')"""

_SRC_EXT = "regexp_matches(path, '(?i)[^/]\\.(?:py|md|markdown)\\z')"
_NOT_VCS = "not list_contains(string_split(path, '/'), '.git')"


def _chunks_sql(m: int, src: str = "select doc_id, text from documents", key: str = "doc_id") -> str:
    """Recursive CTE: the pieces of each text, an independent restatement of the cut rule."""
    return f"""r as (
  select {key} as k, 0 as idx, text as rest, cast(null as varchar) as chunk, false as done from ({src})
  union all
  select k, idx + 1, substr(rest, n + 1), substr(rest, 1, n), n >= length(rest)
  from (select k, idx, rest,
          case when length(rest) <= {m} then greatest(length(rest), 1)
               when position(chr(10) in substr(rest, 1, {m})) > 0
                and {m} + 1 - position(chr(10) in reverse(substr(rest, 1, {m}))) > 201
               then {m} + 1 - position(chr(10) in reverse(substr(rest, 1, {m})))
               else {m} end as n
        from r where not done)),
chunks as (
  select k as {key}, cast(idx as bigint) as chunk_idx, cast(count(*) over (partition by k) as bigint) as chunk_cnt, chunk
  from r where idx > 0)"""


def _label(idx: str = "chunk_idx", cnt: str = "chunk_cnt") -> str:
    return f"case when {cnt} = 1 then '' else ' (chunk ' || {idx} || '/' || {cnt} || ')' end"


def _render_msg(role: str, content: str, is_last: str) -> str:
    return (
        f"case when {role} = 'assistant' then '<|start|>assistant<|channel|>final<|message|>' || {content} || "
        f"case when {is_last} then '<|return|>' else '<|end|>' end "
        f"else '<|start|>' || {role} || '<|message|>' || {content} || '<|end|>' end"
    )


def _file_samples_sql(max_bytes: int, m: int) -> str:
    """CTEs ``kept`` and ``samples(repo, path, chunk_idx, chunk_cnt, user_content, chunk)``."""
    return f"""{V_SOURCE_FILES},
kept as (select * from source_files where {_SRC_EXT} and {_NOT_VCS} and size between 1 and {max_bytes}),
{_chunks_sql(m, "select path, text from kept", "path")},
samples as (
  select f.repo, c.path, c.chunk_idx, c.chunk_cnt,
         'Repository: ' || f.repo || chr(10) || 'File: ' || c.path || {_label('c.chunk_idx', 'c.chunk_cnt')}
           || chr(10) || chr(10) || 'Write the full contents of this file.' as user_content,
         c.chunk
  from chunks c join kept f on f.path = c.path)"""


def _file_text(alias: str = "") -> str:
    p = f"{alias}." if alias else ""
    return (
        f"'<|start|>user<|message|>' || {p}user_content || '<|end|>' || "
        f"'<|start|>assistant<|channel|>final<|message|>' || {p}chunk || '<|return|>'"
    )


_CONV_TEXT = f"""conv_text as (
  select conv_id, string_agg(piece, '' order by turn) as text
  from (select conv_id, turn,
               {_render_msg('role', 'text', 'turn = max(turn) over (partition by conv_id)')} as piece
        from conversations)
  group by conv_id)"""


def _prompt_msgs() -> str:
    """CTE ``pm(id, msg_idx, role, content)`` from non-blank chat inputs."""
    return f"""{V_CHAT_INPUTS},
ok as (select * from chat_inputs where {_strip('user_text')} <> ''),
pm as (
  select id, 0 as msg_idx, 'developer' as role, {_strip('developer')} as content from ok
   where developer is not null and {_strip('developer')} <> ''
  union all
  select id, case when developer is not null and {_strip('developer')} <> '' then 1 else 0 end, 'user', {_strip('user_text')}
  from ok)"""


# The grammar of marked completions, written out for the oracle apart from the engine's own patterns.
_OPEN = r"(?:<\|start\|>assistant)?<\|channel\|>"
_SEGMENT = (
    r"(?s)" + _OPEN + r"(?:analysis<\|message\|>.*?(?:<\|end\|>|\z)|commentary<\|message\|>.*?(?:<\|end\|>|\z)"
    r"|commentary to=functions>.*?(?:<\|call\|>commentary<\|end\|>|\z))"
    r"|<\|start\|>assistant<\|channel\|>final<\|message\|>.*?(?:<\|return\|>|\z)"
)
_SEGMENT_START = (
    r"(?s)^(" + _OPEN + r"(?:analysis<\|message\|>|commentary<\|message\|>|commentary to=functions>)"
    r"|<\|start\|>assistant<\|channel\|>final<\|message\|>)"
)


def _segments_sql() -> str:
    p = _SEGMENT
    h = _SEGMENT_START
    return f"""{V_COMPLETIONS},
parts as (select completion_id, regexp_extract_all(text, '{p}') as segs, string_split_regex(text, '{p}') as raws
          from completions where length(text) > 0),
raw_items as (
  select completion_id, 2 * i as k, 'raw' as channel, {_strip_markers('raws[i + 1]')} as content, true as closed
  from (select completion_id, raws, unnest(range(len(raws))) as i from parts)),
seg_m as (
  select completion_id, 2 * i + 1 as k, m, regexp_extract(m, '{h}', 1) as head
  from (select completion_id, segs[i + 1] as m, i from (select completion_id, segs, unnest(range(len(segs))) as i from parts))),
seg_c as (
  select completion_id, k, channel, body, end_m, ends_with(body, end_m) as closed
  from (select completion_id, k, substr(m, length(head) + 1) as body,
               case when ends_with(head, 'final<|message|>') then 'final'
                    when ends_with(head, 'analysis<|message|>') then 'analysis'
                    when ends_with(head, 'to=functions>') then 'tool' else 'commentary' end as channel,
               case when ends_with(head, 'final<|message|>') then '<|return|>'
                    when ends_with(head, 'to=functions>') then '<|call|>commentary<|end|>' else '<|end|>' end as end_m
        from seg_m)),
seg_items as (
  select completion_id, k, channel,
         case when closed and channel in ('analysis', 'final')
              then substr(body, 1, length(body) - length(end_m))
              else {_strip_markers("case when closed then substr(body, 1, length(body) - length(end_m)) else body end")} end as content,
         closed
  from seg_c),
segments as (
  select completion_id, cast(row_number() over (partition by completion_id order by k) - 1 as bigint) as pos,
         channel, content, closed
  from (select * from raw_items where content <> '' union all select * from seg_items))"""


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL per query over the pre-registered tables. Recursive CTEs restate
    the chunking rule independently of the Spark regex; ``length_summary`` compares
    approximate quantiles with exact ranks (equal at test sizes)."""
    o: dict[str, str] = {}
    o["scan_conversations"] = "select conv_id, turn, role, text from conversations"
    o["scan_split"] = "select conv_id, turn, text from conversations where role = 'user'"
    o["pick_train"] = "select doc_id, 'train' as split from documents where lang = 'en'"
    o["pick_split"] = """select doc_id, lang from documents
where lang = (select coalesce(max(case when lang = 'train' then lang end), min(lang)) from documents where lang is not null)"""

    o["filter_source_ext"] = f"with {V_SOURCE_FILES} select repo, path, size from source_files where {_SRC_EXT}"
    o["filter_vcs_dirs"] = f"with {V_SOURCE_FILES} select repo, path, size from source_files where {_NOT_VCS}"
    o["filter_file_size"] = (
        f"with {V_SOURCE_FILES} select repo, path, size from source_files where size between 1 and {SMALL_MAX_FILE_BYTES}"
    )
    o["normalize_newlines"] = "select doc_id, replace(replace(text, chr(13) || chr(10), chr(10)), chr(13), chr(10)) as text from documents"
    o["nonblank_user_turns"] = f"select conv_id, turn, text from conversations where role = 'user' and {_strip('text')} <> ''"
    o["classify_specs"] = f"""with {V_SPECS}
select page_id, spec, ({_strip('spec')} like 'repo:%' or {_strip('spec')} like 'git@%' or {_strip('spec')} like 'ssh://%'
                        or contains({_strip('spec')}, '://')) as is_git from specs"""
    slug = f"replace(replace(replace(replace(replace({_strip('spec')}, ':', '__'), '/', '__'), '@', '__'), chr(92), '__'), ' ', '__')"
    o["dataset_slug"] = f"with {V_SPECS} select page_id, {slug} as slug from specs"
    o["repo_slug"] = f"""with {V_SPECS}, s as (select page_id, {slug} as slug from specs)
select page_id, case when ends_with(slug, '.git') then substr(slug, 1, length(slug) - 4) else slug end as repo_slug from s"""
    o["output_name"] = f"with {V_SPECS} select page_id, {slug} || '__train' as output_name from specs"
    o["clone_url"] = f"""with {V_SPECS}, r as (select page_id, {_strip('spec')} as raw from specs)
select page_id,
  case when raw like 'git@%' or raw like 'ssh://%' or contains(raw, '://') then raw
       else 'https://github.com/' ||
            case when ends_with(raw, '.git') and length(raw) - length(replace(raw, '/', '')) = 1
                      and not contains(raw, ':') and not contains(raw, '@')
                 then substr(raw, 1, length(raw) - 4) else raw end || '.git' end as clone_url
from r"""
    o["text_preview"] = f"""with t as (select doc_id, trim(coalesce(text, ''), chr(10)) as t from documents)
select doc_id, case when length(t) <= 2000 then t
                    else rtrim(substr(t, 1, 2000), {_WS}) || chr(10) || chr(10) || '... (truncated)' end as preview
from t"""
    o["strip_markers"] = f"with {V_COMPLETIONS} select completion_id, {_strip_markers('text')} as stripped from completions"

    o["chunk_documents"] = f"with recursive {_chunks_sql(12_000)} select doc_id, chunk_idx, chunk from chunks"
    o["chunk_documents_500"] = f"with recursive {_chunks_sql(SMALL_MAX_CHARS)} select doc_id, chunk_idx, chunk from chunks"
    o["chunk_positions"] = f"with recursive {_chunks_sql(SMALL_MAX_CHARS)} select doc_id, chunk_idx, chunk_cnt from chunks"
    o["chunk_labels"] = f"with recursive {_chunks_sql(SMALL_MAX_CHARS)} select doc_id, chunk_idx, {_label()} as chunk_label from chunks"

    o["file_messages"] = f"""with recursive {_file_samples_sql(FULL_MAX_FILE_BYTES, SMALL_MAX_CHARS)}
select repo, path, chunk_idx, cast(0 as bigint) as msg_idx, 'user' as role, user_content as content from samples
union all
select repo, path, chunk_idx, cast(1 as bigint), 'assistant', chunk from samples"""
    o["standardize_roles"] = """with sg as (
  select conv_id, turn, case role when 'user' then 'human' when 'assistant' then 'gpt' else role end as frm, text from conversations)
select conv_id as id, cast(row_number() over (partition by conv_id order by turn) - 1 as bigint) as msg_idx,
       case frm when 'human' then 'user' when 'gpt' then 'assistant' else frm end as role, text as content
from sg"""
    o["turns_to_messages"] = """select conv_id, cast(row_number() over (partition by conv_id order by turn) - 1 as bigint) as msg_idx,
       role, text as content from conversations"""
    o["prompt_messages"] = f"with {_prompt_msgs()} select id, cast(msg_idx as bigint) as msg_idx, role, content from pm"
    lang = "case lang " + " ".join(f"when '{k}' then '{v}'" for k, v in MS.LANGUAGE_NAMES.items()) + " else lang end"
    o["language_system_prompt"] = f"""select doc_id, cast(0 as bigint) as msg_idx, 'system' as role,
       'reasoning language: ' || {lang} || chr(10) || chr(10) || '{MS.DEFAULT_INSTRUCTION}' as content from documents
union all
select doc_id, cast(1 as bigint), 'user', text from documents"""

    o["render_conversations"] = f"with {_CONV_TEXT} select conv_id, text from conv_text"
    o["render_prompts"] = f"""with {_prompt_msgs()}
select id, string_agg({_render_msg('role', 'content', 'false')}, '' order by msg_idx) || '<|start|>assistant' as prompt
from pm group by id"""
    efforts = "(values ('low', 512), ('medium', 1024), ('high', 2048)) e(effort, max_new_tokens)"
    o["effort_grid"] = f"""with {_prompt_msgs()},
body as (select id, string_agg({_render_msg('role', 'content', 'false')}, '' order by msg_idx) as body from pm group by id)
select id, effort, cast(max_new_tokens as bigint) as max_new_tokens,
       '<|start|>system<|message|>Reasoning: ' || effort || '<|end|>' || body || '<|start|>assistant' as prompt
from body, {efforts}"""
    o["request_params"] = f"""with {_prompt_msgs()}, ids as (select distinct id from pm)
select id, effort, cast(max_new_tokens as bigint) as max_new_tokens, true as do_sample,
       cast(0.7 as double) as temperature, cast(0.9 as double) as top_p
from ids, {efforts}"""
    o["request_params_greedy"] = f"""with {_prompt_msgs()}, ids as (select distinct id from pm)
select id, effort, cast(max_new_tokens as bigint) as max_new_tokens, false as do_sample,
       cast(null as double) as temperature, cast(null as double) as top_p
from ids, {efforts}"""

    o["first_samples"] = f"""with recursive {_file_samples_sql(FULL_MAX_FILE_BYTES, SMALL_MAX_CHARS)}
select repo, path, chunk_idx, {_file_text()} as text from samples order by path, chunk_idx limit {FIRST_N_SAMPLES}"""
    o["first_conversations"] = f"""select conv_id, turn, role, text from conversations
where conv_id in (select distinct conv_id from conversations order by conv_id limit {FIRST_N_CONVERSATIONS})"""
    o["first_samples_per_repo"] = f"""with recursive {_file_samples_sql(FULL_MAX_FILE_BYTES, SMALL_MAX_CHARS)}
select repo, path, chunk_idx from samples
qualify row_number() over (partition by repo order by path, chunk_idx) <= {PER_REPO_SAMPLES}"""
    full = _file_samples_sql(FL.DEFAULT_MAX_FILE_BYTES, 12_000)
    o["first_sample"] = f"""with recursive {full}
select repo, path, chunk_idx, {_file_text()} as text from samples order by repo, path, chunk_idx limit 1"""
    o["sample_count"] = f"with recursive {full} select cast(count(*) as bigint) as samples from samples"
    o["corpus_report"] = f"""with recursive {V_SOURCE_FILES},
flags as (
  select repo, path, size, text,
         list_contains(string_split(path, '/'), '.git') as vcs,
         not list_contains(string_split(path, '/'), '.git') and not {_SRC_EXT} as bad_ext
  from source_files),
reasons as (
  select *, not vcs and not bad_ext and size <= 0 as empty,
            not vcs and not bad_ext and size > {FULL_MAX_FILE_BYTES} as too_big,
            not vcs and not bad_ext and coalesce(size, 1) between 1 and {FULL_MAX_FILE_BYTES} and text is null as unreadable,
            not vcs and not bad_ext and size between 1 and {FULL_MAX_FILE_BYTES} and text is not null as kept
  from flags),
{_chunks_sql(SMALL_MAX_CHARS, "select path, text from reasons where kept", "path")},
per_file as (select path, count(*) as pieces from chunks group by path)
select repo, cast(count(*) as bigint) as files_in,
       cast(count(*) filter (where kept) as bigint) as files_kept,
       cast(count(*) filter (where vcs) as bigint) as skipped_vcs,
       cast(count(*) filter (where bad_ext) as bigint) as skipped_extension,
       cast(count(*) filter (where empty) as bigint) as skipped_empty,
       cast(count(*) filter (where too_big) as bigint) as skipped_too_big,
       cast(count(*) filter (where unreadable) as bigint) as skipped_unreadable,
       cast(coalesce(sum(case when kept then p.pieces else 0 end), 0) as bigint) as chunks,
       cast(coalesce(sum(case when kept then length(text) else 0 end), 0) as bigint) as characters
from reasons left join per_file p using (path)
group by repo"""

    ids = f"""ft as (select repo || ':' || path || ':' || cast(chunk_idx as varchar) as sample_id, {_file_text()} as text from samples)"""
    o["training_budget"] = f"""with recursive {full}, {ids}
select sample_id, text from ft order by md5('3407:' || sample_id), sample_id limit 120"""
    o["training_batches"] = f"""with recursive {full}, {ids},
n as (select count(*) as n from ft),
e as (select ft.*, unnest(range(greatest(1, cast(ceil(120 / n.n) as integer)))) as epoch from ft, n),
top as (select sample_id, epoch, md5(cast(3407 + epoch as varchar) || ':' || sample_id) as k from e
        order by epoch, k, sample_id limit 120),
rn as (select *, row_number() over (order by epoch, k, sample_id) - 1 as rn from top)
select sample_id, cast(epoch as bigint) as epoch, cast(rn // 4 + 1 as bigint) as step,
       cast((rn // 1) % 4 + 1 as bigint) as micro from rn"""
    o["steps_by_index"] = _steps_sql()
    o["merged_length_quantiles"] = """select unnest([0.5, 0.9, 0.99])::double as q, count(*) as samples,
       max(cast(ceil(length(text) / 4) as bigint)) as max_tokens, true as within from documents where text is not null"""
    o["length_summary"] = f"""with {_CONV_TEXT},
t as (select cast(ceil(length(text) / 4) as bigint) as n from conv_text),
r as (select n, row_number() over (order by n) as rk, count(*) over () as cnt from t)
select cast(count(*) as bigint) as samples,
       (select n from r where rk = greatest(1, cast(ceil(0.5 * cnt) as bigint)) limit 1) as p50,
       (select n from r where rk = greatest(1, cast(ceil(0.9 * cnt) as bigint)) limit 1) as p90,
       (select n from r where rk = greatest(1, cast(ceil(0.99 * cnt) as bigint)) limit 1) as p99,
       cast(max(n) as bigint) as max_tokens
from t"""
    o["over_length_samples"] = f"""with {_CONV_TEXT}
select conv_id, cast(ceil(length(text) / 4) as bigint) as n_tokens, ceil(length(text) / 4) > 4096 as over_limit from conv_text"""

    seg = _segments_sql()
    o["completion_segments"] = f"with {seg} select completion_id, pos, channel, content, closed from segments"
    o["stream_segments"] = o["completion_segments"]
    o["tool_calls"] = f"with {seg} select completion_id, pos, content as call, closed from segments where channel = 'tool'"
    o["final_answers"] = f"""with {seg}
select c.completion_id,
       string_agg(s.content, '' order by s.pos) filter (where s.channel = 'analysis') as thinking,
       string_agg(s.content, '' order by s.pos) filter (where s.channel = 'final') as final,
       coalesce(bool_or(s.channel = 'final'), false) as has_final,
       coalesce(bool_or(not s.closed), false) as truncated
from completions c left join segments s using (completion_id)
group by c.completion_id"""
    o["render_transcript"] = f"""with {seg},
r as (select completion_id, pos,
        case channel when 'raw' then content
             when 'analysis' then case when pos = min(pos) filter (where channel = 'analysis') over (partition by completion_id)
                                       then 'Thinking: ' else '' end || content
             when 'final' then chr(10) || chr(10) || content
             when 'commentary' then 'Commentary: ' || content || case when closed then chr(10) else '' end
             else 'Tool: ' || content || case when closed then chr(10) else '' end end as piece
      from segments)
select c.completion_id, coalesce(string_agg(r.piece, '' order by r.pos), '') as transcript
from completions c left join r using (completion_id) group by c.completion_id"""

    o["training_text"] = f"with recursive {full} select repo, path, chunk_idx, {_file_text()} as text from samples"
    o["conversation_training_text"] = f"with {_CONV_TEXT} select conv_id, text from conv_text"
    o["training_plan"] = f"""with {_CONV_TEXT},
ft as (select cast(conv_id as varchar) as sample_id, text from conv_text),
n as (select count(*) as n from ft),
e as (select ft.*, unnest(range(greatest(1, cast(ceil(120 / n.n) as integer)))) as epoch from ft, n),
top as (select sample_id, epoch, text, md5(cast(3407 + epoch as varchar) || ':' || sample_id) as k from e
        order by epoch, k, sample_id limit 120),
rn as (select *, row_number() over (order by epoch, k, sample_id) - 1 as rn from top)
select sample_id, cast(epoch as bigint) as epoch, cast(rn // 4 + 1 as bigint) as step,
       cast((rn // 1) % 4 + 1 as bigint) as micro, text from rn"""
    o["generation_requests"] = f"""with {_prompt_msgs()},
body as (select id, string_agg({_render_msg('role', 'content', 'false')}, '' order by msg_idx) as body from pm group by id)
select id, effort, '<|start|>system<|message|>Reasoning: ' || effort || '<|end|>' || body || '<|start|>assistant' as prompt,
       cast(max_new_tokens as bigint) as max_new_tokens, true as do_sample,
       cast(0.7 as double) as temperature, cast(0.9 as double) as top_p
from body, {efforts}"""
    o.update(_llm_queries()[1])
    return o


def _llm_queries() -> tuple[dict, dict]:
    """The training-data operators and the pipeline, where their subpackage is installed."""
    from importlib.util import find_spec

    if find_spec("quire.llm") is None or find_spec("corpus_pipeline") is None:
        return {}, {}
    import corpus_pipeline
    from quire.llm import queries as llm

    oracles = dict(llm.ORACLES)
    if corpus_pipeline.ORACLE_SQL is not None:
        oracles["pipeline"] = corpus_pipeline.ORACLE_SQL
    return {**llm.QUERIES, "pipeline": corpus_pipeline.run}, oracles
