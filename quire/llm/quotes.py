"""Chat formatting by quotation: reply-ordered conversations without quotes, in DataFrame functions alone.

A message body holds quoted lines ("> ", nested to any level) and own lines. Each line gets its
level; runs of lines of one level between blank lines are passages, and each of their lines is a
passage too, so partial and rewrapped quotes are both found. Passages are normalised (white space,
case) and hashed. The own passages of all messages form an index: who said a passage first in a
conversation, and who said it first anywhere; both are minima per hash, so a passage that a third
of all messages share is one row. A quoted passage is looked up in its conversation, then
anywhere, among earlier messages. A message answers the message that most characters of its
least deep linked quotes come from.

Answers form trees; pointer jumping finds each message's thread (its root) and depth in a
logarithmic number of joins. Sorted by (thread, depth, message), a thread is read in reply order.

A message is (conversation, turn); earlier means a smaller pair. Null bodies are empty; rows
without a conversation or a turn are left out; of rows that repeat a message one counts (the least role and
body). Messages without a linked quote start a thread.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import pick, saved

_MARKS = r"^((?:[ \t]{0,3}>)+)"
_QUOTED = r"^(?:[ \t]{0,3}>)+[ \t]?"


def quoted(text: Column, levels: int = 1) -> Column:
    """A text as a quotation: every line marked ``levels`` times."""
    return F.regexp_replace(text, r"(?m)^", "> " * levels)


def parsed(messages: DataFrame, body: str = "body") -> DataFrame:
    """``messages`` with ``own`` (the text without quotes) and ``passages`` (array of level, text)."""
    raw = F.split(F.coalesce(F.col(body), F.lit("")), r"\r?\n")
    norm = lambda t: F.lower(F.trim(F.regexp_replace(t, r"\s+", " ")))
    # every line is read once: its level, its text and its text as it is compared (empty for a blank line)
    m = messages.withColumn("q_lines", F.transform(F.transform(raw, lambda x: F.struct(
        F.length(F.regexp_replace(F.regexp_extract(x, _MARKS, 1), "[^>]", "")).alias("level"),
        F.regexp_replace(x, _QUOTED, "").alias("text"))), lambda x: F.struct(x["level"].alias("level"), x["text"].alias("text"), norm(x["text"]).alias("norm"))))
    n = F.size("q_lines")
    at = lambda i: F.get("q_lines", i)
    solid = lambda i: at(i)["norm"] != ""
    breaks = lambda i, j: (at(i)["level"] != at(j)["level"]) | ~solid(j)
    seq = F.sequence(F.lit(0), n - 1)
    m = m.withColumn("q_from", F.filter(seq, lambda i: solid(i) & ((i == 0) | F.coalesce(breaks(i, i - 1), F.lit(True)))))
    m = m.withColumn("q_to", F.filter(seq, lambda i: solid(i) & ((i == n - 1) | F.coalesce(breaks(i, i + 1), F.lit(True)))))
    runs = F.transform(F.arrays_zip("q_from", "q_to"), lambda z: F.struct(
        at(z["q_from"])["level"].alias("level"),
        F.array_join(F.transform(F.slice("q_lines", z["q_from"] + 1, z["q_to"] - z["q_from"] + 1), lambda x: x["norm"]), " ").alias("text")))
    lines = F.transform(F.filter("q_lines", lambda x: x["norm"] != ""), lambda x: F.struct(x["level"].alias("level"), x["norm"].alias("text")))
    own = F.regexp_replace(F.array_join(F.transform(F.filter("q_lines", lambda x: x["level"] == 0), lambda x: x["text"]), "\n"), r"^\s+|\s+$", "")
    return m.withColumn("own", own).withColumn("passages", F.array_distinct(F.concat(runs, lines))).drop("q_lines", "q_from", "q_to")


def linked(messages: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", body: str = "body") -> DataFrame:
    """Rows ``conv, turn, role, own, n_quotes, n_linked, parent_conv, parent_turn``, a row per message."""
    m = pick(messages, conv=conversation, turn=turn, role=role, body=body).where("conv is not null and turn is not null")
    m = m.groupBy("conv", "turn").agg(F.min(F.struct(F.coalesce("role", F.lit("")).alias("r"), F.coalesce("body", F.lit("")).alias("b"), F.col("role").alias("role"))).alias("x"))
    m = saved(parsed(m.select("conv", "turn", F.col("x.role").alias("role"), F.col("x.b").alias("body"))).drop("body"), "mail")
    p = m.select("conv", "turn", F.explode("passages").alias("p")).select(
        "conv", "turn", F.col("p.level").alias("level"), F.md5("p.text").alias("h"), F.length("p.text").alias("n"))
    said = p.where("level = 0").groupBy("conv", "h").agg(F.min("turn").alias("t"))
    anywhere = said.groupBy("h").agg(F.min(F.struct("conv", "t")).alias("g"))
    q = p.where("level > 0")
    q = q.join(said.withColumnsRenamed({"conv": "sc", "h": "sh"}), (F.col("conv") == F.col("sc")) & (F.col("h") == F.col("sh")) & (F.col("t") < F.col("turn")), "left")
    q = q.select("conv", "turn", "level", "h", "n", F.when(F.col("t").isNotNull(), F.struct(F.col("sc").alias("conv"), "t")).alias("here"))
    here = q.where("here is not null").withColumn("of", F.col("here"))
    there = q.where("here is null").join(anywhere, "h").where(
        (F.col("g.conv") < F.col("conv")) | ((F.col("g.conv") == F.col("conv")) & (F.col("g.t") < F.col("turn")))).withColumn("of", F.col("g"))
    found = here.select("conv", "turn", "level", "n", "of").unionByName(there.select("conv", "turn", "level", "n", "of"))
    best = found.groupBy("conv", "turn", "level", "of").agg(F.sum("n").alias("n"), F.count("*").alias("k")).groupBy("conv", "turn").agg(
        F.max(F.struct((-F.col("level")).alias("up"), F.col("n").alias("n"), F.col("of").alias("of"))).alias("best"), F.sum("k").alias("n_linked"))
    return m.join(best, ["conv", "turn"], "left").select(
        "conv", "turn", "role", "own", F.size(F.filter("passages", lambda x: x["level"] > 0)).alias("n_quotes"),
        F.coalesce("n_linked", F.lit(0)).cast("int").alias("n_linked"),
        F.col("best.of.conv").alias("parent_conv"), F.col("best.of.t").alias("parent_turn"))


def threads(links: DataFrame) -> DataFrame:
    """``links`` with ``thread_conv, thread_turn`` (the root that a chain of answers ends at) and ``depth``."""
    links = saved(links, "answers")
    top = F.col("parent_conv").isNull()
    at = saved(links.select("conv", "turn", F.coalesce("parent_conv", "conv").alias("ac"), F.coalesce("parent_turn", "turn").alias("at"),
                            F.when(top, 0).otherwise(1).cast("long").alias("depth"), top.alias("done")), "jumps")
    # a message whose pointer stands at a root is done; only the others jump on
    while not (active := at.where("not done")).isEmpty():
        far = at.select(F.col("conv").alias("ac"), F.col("turn").alias("at"), F.col("ac").alias("bc"), F.col("at").alias("bt"),
                        F.col("depth").alias("more"), F.col("done").alias("there"))
        moved = active.join(far, ["ac", "at"]).select("conv", "turn", F.col("bc").alias("ac"), F.col("bt").alias("at"),
                                                      (F.col("depth") + F.col("more")).alias("depth"), F.col("there").alias("done"))
        at = saved(at.where("done").unionByName(moved), "jumps")
    return links.join(at.select("conv", "turn", F.col("ac").alias("thread_conv"), F.col("at").alias("thread_turn"), "depth"), ["conv", "turn"])


def conversations(messages: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", body: str = "body") -> DataFrame:
    """Reply-ordered messages without quotes: ``linked`` and ``threads`` in one."""
    return threads(linked(messages, conversation, turn, role, body))
