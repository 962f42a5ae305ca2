"""Job entry points for ``spark-submit``: prepare a dataset, plan a training run,
build generation requests.

    spark-submit --py-files quire.zip quire/plans/jobs.py prepare --dataset conversations/ --out prepared/
    spark-submit --py-files quire.zip quire/plans/jobs.py prepare --dataset repo:owner/name --tree /mnt/src/name
    spark-submit --py-files quire.zip quire/plans/jobs.py plan --dataset-dir prepared/ --out plan/
    spark-submit --py-files quire.zip quire/plans/jobs.py requests --inputs chat_inputs/ --out requests/

(``quire.zip`` is the package folder zipped from the repository root: ``zip -r quire.zip quire``.)

Each job is one DataFrame program; the only values that reach the driver are a
row count (observed during the write) and the first sample for the log.
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions.chunk import DEFAULT_MAX_CHARS
from quire.functions.text import is_git_spec, output_name, text_preview
from quire.operators.files import DEFAULT_MAX_FILE_BYTES
from quire.operators.messages import MAX_CONVERSATION_BYTES, oversized
from quire.operators.shaping import (
    DEFAULT_BATCH_SIZE,
    DEFAULT_GRAD_ACCUM,
    DEFAULT_MAX_SEQ_LENGTH,
    DEFAULT_MAX_STEPS,
    DEFAULT_SEED,
    flag_over_length,
)
from quire.operators.template import (
    DEFAULT_DO_SAMPLE,
    DEFAULT_MAX_NEW_TOKENS,
    DEFAULT_TEMPERATURE,
    DEFAULT_TEMPLATE,
    DEFAULT_TOP_P,
    EFFORT_LEVELS,
    ChatTemplate,
)
from quire.operators.texttemplate import TextTemplate
from quire.plans import chat, prepare, train
from quire.sources.tables import Rejected, load_prepared, open_table, write_prepared


def _scalar(spark: SparkSession, col) -> object:
    """Evaluate a Column function on a constant (folded by the optimizer)."""
    return spark.range(1).select(col.alias("v")).first()["v"]


def prepare_dataset(
    spark: SparkSession,
    dataset: str,
    out: str | None = None,
    *,
    split: str = "train",
    tree: str | None = None,
    max_samples: int | None = None,
    max_file_bytes: int = DEFAULT_MAX_FILE_BYTES,
    max_chars: int = DEFAULT_MAX_CHARS,
    overwrite: bool = True,
    out_root: str = "prepared",
    skipped: prepare.SkipCounts | None = None,
    max_bad_share: float = 0.0,
    rejected: Rejected | None = None,
    bad_rows: str | None = None,
    max_conversation_bytes: int = MAX_CONVERSATION_BYTES,
    skipped_conversations: str | None = None,
    template: ChatTemplate = DEFAULT_TEMPLATE,
) -> tuple[int, str | None]:
    """Route by spec: a git spec reads the source tree at ``tree`` (already checked
    out on a shared mount); anything else is a conversation table: rows with
    ``messages`` (role, content, optional thinking), ShareGPT-like rows with
    ``conversations``, or flat turns ``conv_id, turn, role, text``.
    Writes ``text`` partitioned by ``split``; returns (rows, first sample). Malformed lines of a JSON table make no
    sample: up to ``max_bad_share`` of all lines they are counted in ``rejected`` and written to ``bad_rows``, beyond
    it the job fails. Conversations of flat turns above ``max_conversation_bytes`` fail the job by name, or, with
    ``skipped_conversations``, are left out and written there."""
    spec = F.lit(dataset)
    target = out or os.path.join(out_root, _scalar(spark, output_name(spec, F.lit(split))))
    if _scalar(spark, is_git_spec(spec)):
        if not tree:
            raise ValueError("a git spec needs the checked-out tree (--tree); cloning is not part of this engine")
        text = prepare.tree_training_text(
            spark, tree, dataset, max_samples=max_samples, max_file_bytes=max_file_bytes, max_chars=max_chars,
            skipped=skipped, template=template,
        )
        order = ["repo", "path", "chunk_idx"]
    else:
        found = rejected if rejected is not None else Rejected()
        df = open_table(spark, dataset, position=True, max_bad_share=max_bad_share, rejected=found)
        if bad_rows and found.rows is not None and found.rejected:
            found.rows.write.mode("overwrite").parquet(bad_rows)
        if "split" in df.columns:
            df = df.where(F.col("split") == split)
        if "conversations" in df.columns or "messages" in df.columns:
            # a row is told by its place in stored order; an id, where there is one, comes first in the order
            order = (["id"] if "id" in df.columns else []) + ["src_file", "src_row"]
            flow = prepare.messages_training_text if "messages" in df.columns else prepare.sharegpt_training_text
            text = flow(df, key=order, max_samples=max_samples, template=template)
        else:
            turns = df.drop("src_file", "src_row")
            if skipped_conversations:
                oversized(turns, max_bytes=max_conversation_bytes).write.mode("overwrite").parquet(skipped_conversations)
            text = prepare.conversation_training_text(turns, max_samples=max_samples, max_bytes=max_conversation_bytes,
                                                      on_oversize="skip" if skipped_conversations else "error", template=template)
            order = ["conv_id"]
    out_df = text.withColumn("split", F.lit(split))
    n = write_prepared(out_df.select(*order, "text", "split"), target, overwrite=overwrite)
    return n, first_preview(load_prepared(spark, target, prefer=split), order) if n else None


def first_preview(table: DataFrame, order: list[str]) -> str | None:
    """Preview of the first sample: the first key is found on the key columns alone
    (a top-k that never reads ``text``), then that one row is fetched with an
    equality filter that Parquet can push down to row groups."""
    key = table.select(*order).orderBy(*(F.col(c).asc_nulls_last() for c in order)).first()
    if key is None:
        return None
    cond = F.lit(True)
    for c in order:
        cond = cond & F.col(c).eqNullSafe(F.lit(key[c]))
    row = table.where(cond).select(text_preview("text").alias("p")).first()
    return row["p"] if row else None


def plan_training(
    spark: SparkSession,
    dataset_dir: str,
    out: str,
    *,
    max_steps: int = DEFAULT_MAX_STEPS,
    batch_size: int = DEFAULT_BATCH_SIZE,
    grad_accum: int = DEFAULT_GRAD_ACCUM,
    seed: int = DEFAULT_SEED,
    max_seq_length: int = DEFAULT_MAX_SEQ_LENGTH,
    from_step: int | None = None,
) -> int:
    """Reload a prepared table (``train`` split if present) and write the batches a
    run consumes, each sample flagged when it exceeds ``max_seq_length`` tokens. With ``from_step``
    the order is the one addressed by step, and only the steps from there to ``max_steps`` are planned."""
    samples = load_prepared(spark, dataset_dir)
    if from_step is not None:
        plan = train.resumed_plan(samples, from_step, max_steps, batch_size=batch_size, grad_accum=grad_accum, seed=seed)
    else:
        plan = train.training_plan(samples, max_steps=max_steps, batch_size=batch_size, grad_accum=grad_accum, seed=seed)
    plan = flag_over_length(plan, max_seq_length=max_seq_length)
    return write_prepared(plan, out, split_col=None)


def prepared_overview(spark: SparkSession, dataset_dir: str) -> tuple[int, str | None]:
    """How many samples a prepared table holds, and a preview of the first one."""
    samples = load_prepared(spark, dataset_dir)
    keys = [c for c in ("repo", "path", "chunk_idx", "conv_id", "id", "src_file", "src_row") if c in samples.columns]
    return samples.count(), first_preview(samples, keys) if keys else None


def stream_prepare(spark: SparkSession, source: str, out: str, kind: str = "conversations", fmt: str = "parquet") -> None:
    """Prepare what has arrived in ``source`` since the last run, appending to ``out``."""
    from quire.streaming.prepare import MESSAGES_SCHEMA, SHAREGPT_SCHEMA, start_prepare_stream

    schema = MESSAGES_SCHEMA if kind == "messages" else SHAREGPT_SCHEMA
    start_prepare_stream(spark, source, out, schema=schema, fmt=fmt).awaitTermination()


def build_requests(
    spark: SparkSession,
    inputs: str,
    out: str,
    *,
    efforts: bool = True,
    effort: str | None = None,
    max_new_tokens: int = DEFAULT_MAX_NEW_TOKENS,
    do_sample: bool = DEFAULT_DO_SAMPLE,
    temperature: float = DEFAULT_TEMPERATURE,
    top_p: float = DEFAULT_TOP_P,
    template: ChatTemplate = DEFAULT_TEMPLATE,
) -> int:
    """``id, developer, user_text`` rows → one generation request per input (and effort level)."""
    reqs = chat.generation_requests(
        open_table(spark, inputs), efforts=efforts, effort=effort, max_new_tokens=max_new_tokens,
        do_sample=do_sample, temperature=temperature, top_p=top_p, template=template,
    )
    return write_prepared(reqs, out, split_col=None)


def _template(path: str | None) -> ChatTemplate:
    if path is None:
        return DEFAULT_TEMPLATE
    with open(path, encoding="utf-8") as f:
        return TextTemplate(f.read())


def main(argv: list[str] | None = None) -> None:
    # The option names are the public interface.
    p = argparse.ArgumentParser(prog="quire.plans.jobs")
    sub = p.add_subparsers(dest="cmd", required=True)
    a = sub.add_parser("prepare")
    a.add_argument("--dataset", required=True)
    a.add_argument("--split", default="train")
    a.add_argument("--out")
    a.add_argument("--tree")
    a.add_argument("--max-samples", type=int)
    a.add_argument("--max-file-bytes", type=int, default=DEFAULT_MAX_FILE_BYTES)
    a.add_argument("--max-chars", type=int, default=DEFAULT_MAX_CHARS)
    a.add_argument("--no-overwrite", action="store_true")
    a.add_argument("--max-bad-share", type=float, default=0.0, help="share of malformed JSON lines above which the job fails")
    a.add_argument("--bad-rows", help="folder for the malformed lines, with file and byte offset")
    a.add_argument("--template", help="file with a chat template (see quire.operators.texttemplate)")
    a.add_argument("--max-conversation-bytes", type=int, default=MAX_CONVERSATION_BYTES)
    a.add_argument("--skipped-conversations", help="leave longer conversations out and write their keys and sizes to this folder")
    b = sub.add_parser("plan")
    b.add_argument("--dataset-dir", required=True)
    b.add_argument("--out", required=True)
    b.add_argument("--max-steps", type=int, default=DEFAULT_MAX_STEPS)
    b.add_argument("--batch-size", type=int, default=DEFAULT_BATCH_SIZE)
    b.add_argument("--grad-accum", type=int, default=DEFAULT_GRAD_ACCUM)
    b.add_argument("--seed", type=int, default=DEFAULT_SEED)
    b.add_argument("--max-seq-length", type=int, default=DEFAULT_MAX_SEQ_LENGTH)
    b.add_argument("--from-step", type=int, help="plan from this step on, in the order that is addressed by step")
    d = sub.add_parser("stream")
    d.add_argument("--source", required=True)
    d.add_argument("--out", required=True)
    d.add_argument("--kind", choices=["conversations", "messages"], default="conversations")
    d.add_argument("--format", choices=["parquet", "json"], default="parquet")
    c = sub.add_parser("requests")
    c.add_argument("--inputs", required=True)
    c.add_argument("--out", required=True)
    c.add_argument("--no-efforts", action="store_true", help="one request per input instead of the effort grid")
    c.add_argument("--reasoning-effort", choices=list(EFFORT_LEVELS), default=None)
    c.add_argument("--max-new-tokens", type=int, default=DEFAULT_MAX_NEW_TOKENS)
    c.add_argument("--greedy", action="store_true")
    c.add_argument("--temperature", type=float, default=DEFAULT_TEMPERATURE)
    c.add_argument("--top-p", type=float, default=DEFAULT_TOP_P)
    c.add_argument("--template", help="file with a chat template")
    args = p.parse_args(argv)
    spark = SparkSession.builder.getOrCreate()
    if args.cmd == "prepare":
        skipped, rejected = prepare.SkipCounts(), Rejected()
        n, first = prepare_dataset(
            spark, args.dataset, args.out, split=args.split, tree=args.tree, max_samples=args.max_samples,
            max_file_bytes=args.max_file_bytes, max_chars=args.max_chars, overwrite=not args.no_overwrite, skipped=skipped,
            max_bad_share=args.max_bad_share, rejected=rejected, bad_rows=args.bad_rows,
            max_conversation_bytes=args.max_conversation_bytes, skipped_conversations=args.skipped_conversations, template=_template(args.template),
        )
        print(f"wrote {n} samples; could not list {skipped.unlisted}, could not read {skipped.unread}, rejected {rejected.rejected} of {rejected.lines} lines")
        print(f"the first one begins:\n{first}")
    elif args.cmd == "stream":
        stream_prepare(spark, args.source, args.out, args.kind, args.format)
    elif args.cmd == "plan":
        have, first = prepared_overview(spark, args.dataset_dir)
        print(f"the table holds {have} samples; the first one begins:\n{first}")
        n = plan_training(
            spark, args.dataset_dir, args.out, max_steps=args.max_steps, batch_size=args.batch_size,
            grad_accum=args.grad_accum, seed=args.seed, max_seq_length=args.max_seq_length,
            from_step=args.from_step,
        )
        print(f"planned {n} samples")
    else:
        n = build_requests(
            spark, args.inputs, args.out, efforts=not args.no_efforts, effort=args.reasoning_effort,
            max_new_tokens=args.max_new_tokens, do_sample=not args.greedy, temperature=args.temperature, top_p=args.top_p,
            template=_template(args.template),
        )
        print(f"wrote {n} requests")


if __name__ == "__main__":
    main()
