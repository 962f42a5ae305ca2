"""quire: fine-tuning data preparation as Spark DataFrame programs.

Main entry points (imported lazily)::

    quire.training_text(files)                 # files → repo, path, chunk_idx, text
    quire.tree_training_text(spark, root, repo)
    quire.conversation_training_text(turns)    # flat turns → conv_id, text
    quire.training_plan(samples)               # → sample_id, epoch, step, micro, text
    quire.generation_requests(chat_inputs)     # → id, effort, prompt, decoding parameters
    quire.completion_segments(completions)     # → completion_id, pos, channel, content, closed
    quire.segment_stream(pieces)               # streaming form of the above

Column functions live in ``quire.functions``, DataFrame operators in
``quire.operators``, readers and sinks in ``quire.sources``.
"""

from __future__ import annotations

_EXPORTS = {
    "training_text": "quire.plans.prepare",
    "tree_training_text": "quire.plans.prepare",
    "conversation_training_text": "quire.plans.prepare",
    "sharegpt_training_text": "quire.plans.prepare",
    "messages_training_text": "quire.plans.prepare",
    "file_samples": "quire.plans.prepare",
    "training_plan": "quire.plans.train",
    "generation_requests": "quire.plans.chat",
    "completion_segments": "quire.operators.segments",
    "completion_parts": "quire.operators.segments",
    "transcripts": "quire.operators.segments",
    "segment_stream": "quire.streaming.completions",
    "local_session": "quire.session",
}

__all__ = sorted(_EXPORTS)


def __getattr__(name: str):
    if name in _EXPORTS:
        import importlib

        return getattr(importlib.import_module(_EXPORTS[name]), name)
    raise AttributeError(f"module 'quire' has no attribute {name!r}")
