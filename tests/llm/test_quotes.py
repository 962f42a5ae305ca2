import random

from helpers import sentence
from pyspark.sql import functions as F

from quire.llm import quotes as Q


def mail(spark, rows):
    rows = [(*r, "x", 0) for r in rows]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, body string, h string, level int")


def run(spark, rows):
    return {(r["conv"], r["turn"]): r for r in Q.conversations(mail(spark, rows)).collect()}


def test_levels_and_passages(spark):
    body = "Hi\n> one\n>  two\n>\n> three\n> > deep\nmine\n\nmore >x"
    r = Q.parsed(spark.createDataFrame([(body,)], "body string")).first()
    assert r["own"] == "Hi\nmine\n\nmore >x"
    got = {(p["level"], p["text"]) for p in r["passages"]}
    assert {(1, "one two"), (1, "three"), (2, "deep"), (0, "hi"), (0, "mine"), (0, "more >x"), (1, "one"), (1, "two")} == got


def test_threads_of_a_branching_conversation(spark):
    a, b, c, d = (sentence(k, 12) for k in range(4))
    rows = [(1, 0, "u", a), (1, 1, "a", f"> {a}\n{b}"), (1, 2, "u", f"> > {a}\n> {b}\n{c}"), (1, 3, "a", f"> {a.upper()}\n\n{d}"),
            (2, 0, "u", f"> {c[::-1]}\nfrom elsewhere"), (2, 1, "a", "> nobody said this\nalone")]
    got = run(spark, rows)
    parent = {k: (r["parent_conv"], r["parent_turn"]) for k, r in got.items()}
    assert parent == {(1, 0): (None, None), (1, 1): (1, 0), (1, 2): (1, 1), (1, 3): (1, 0), (2, 0): (None, None), (2, 1): (None, None)}
    assert got[(1, 2)]["depth"] == 2 and got[(1, 3)]["depth"] == 1 and got[(1, 2)]["own"] == c
    assert all((r["thread_conv"], r["thread_turn"]) == (1, 0) for k, r in got.items() if k[0] == 1)


def test_rewrapped_quotes_and_quotes_from_elsewhere(spark):
    a = sentence(9, 20)
    words = a.split()
    rows = [(1, 0, "u", " ".join(words[:10]) + "\n" + " ".join(words[10:])),
            (1, 1, "a", "> " + " ".join(words[:7]) + "\n> " + " ".join(words[7:]) + "\nyes"), (5, 0, "u", f"> {a}\nalso")]
    got = run(spark, rows)
    assert (got[(1, 1)]["parent_conv"], got[(1, 1)]["parent_turn"]) == (1, 0)
    assert (got[(5, 0)]["parent_conv"], got[(5, 0)]["parent_turn"]) == (1, 0) and got[(5, 0)]["thread_conv"] == 1


def test_long_chains(spark):
    rows = [(3, 0, "u", "start 0")] + [(3, k, "u", f"> start {k - 1}\nstart {k}") for k in range(1, 70)]
    got = run(spark, rows)
    assert [got[(3, k)]["depth"] for k in range(70)] == list(range(70))
    assert {(r["thread_conv"], r["thread_turn"]) for r in got.values()} == {(3, 0)}


def test_awkward_rows(spark):
    rows = [(1, 0, None, None), (1, 1, "u", ""), (1, 2, "u", "> "), (1, 3, "u", ">>>> x"), (1, 3, "u", ">>>> x"), (None, 1, "u", "a"), (2, None, "u", "a"),
            (4, 0, "u", "same"), (4, 1, "u", "same"), (4, 2, "u", "> same\r\nlast"), (6, 0, "u", sentence(1, 6000))]
    got = run(spark, rows)
    assert sorted(got) == [(1, 0), (1, 1), (1, 2), (1, 3), (4, 0), (4, 1), (4, 2), (6, 0)]
    assert (got[(4, 2)]["parent_conv"], got[(4, 2)]["parent_turn"]) == (4, 0) and got[(1, 0)]["own"] == "" and got[(1, 0)]["role"] is None
    assert len(run(spark, rows[:1])) == 1 and Q.conversations(mail(spark, rows[:1]).limit(0)).count() == 0


def brute(rows):
    """Levels, passages, links and threads by loops over all messages."""
    said, parts, order = {}, {}, sorted({(c, t) for c, t, _, _ in rows if c is not None and t is not None})
    for m in order:
        body = min((r or "", b or "") for c, t, r, b in rows if (c, t) == m)[1]
        found, run, level_of_run = set(), [], None
        for line in body.replace("\r\n", "\n").split("\n") + [None]:
            level, text = 0, line or ""
            while True:
                head = text.lstrip(" \t")
                if len(text) - len(head) > 3 or not head.startswith(">"):
                    break
                level, text = level + 1, head[1:]
            if level and text[:1] in (" ", "\t"):
                text = text[1:]
            text = " ".join(text.lower().split(None))
            if text:
                found.add((level, text))
            if line is None or not text or level != level_of_run:
                if run:
                    found.add((level_of_run, " ".join(run)))
                run = []
            if line is not None and text:
                run.append(text)
                level_of_run = level
            elif not text:
                level_of_run = None
        parts[m] = found
        for level, text in found:
            if level == 0:
                said.setdefault(text, []).append(m)
    parent = {}
    for m in order:
        scores = {}
        for level, text in parts[m]:
            if level:
                earlier = [x for x in said.get(text, []) if x < m]
                own = [x for x in earlier if x[0] == m[0]]
                # anywhere: the one who said it first of all, if that was earlier
                of = min(own) if own else min(said[text]) if earlier and min(said[text]) < m else None
                if of is not None:
                    scores[level, of] = scores.get((level, of), 0) + len(text)
        parent[m] = max(((-level, n, of) for (level, of), n in scores.items()), default=(0, 0, None))[2]
    out = {}
    for m in order:
        top, depth = m, 0
        while parent[top] is not None:
            top, depth = parent[top], depth + 1
        out[m] = parent[m], top, depth, sum(level > 0 for level, _ in parts[m])
    return out


def test_against_brute_force(spark):
    r = random.Random(11)
    rows, said = [], []
    for c in range(12):
        for t in range(r.randrange(1, 9)):
            lines = []
            for _ in range(r.randrange(0, 4)):
                if said and r.random() < 0.8:
                    text = r.choice(said[-12:] if r.random() < 0.8 else said)
                    words = text.split()
                    if r.random() < 0.3 and len(words) > 4:  # wrapped anew
                        k = r.randrange(1, len(words))
                        text = " ".join(words[:k]) + "\n" + "  ".join(words[k:])
                    mark = r.choice(["> ", ">", "> > ", " >\t", ">>"])
                    lines += [mark + x for x in text.upper().split("\n")] + [""] * r.randrange(2)
                else:
                    lines.append(r.choice(["> nobody said " + str(r.random()), "    > no quote", ">", ""]))
            own = sentence(r.randrange(40), r.randrange(1, 9)) if r.random() < 0.9 else ""
            said.append(own) if own else None
            rows.append((c, t, r.choice(["u", "a", None]), r.choice(["\n", "\r\n"]).join([*lines, own])))
    rows += [rows[3], (None, 1, "u", "x"), (3, None, "u", "y")]
    got = {k: ((x["parent_conv"], x["parent_turn"]) if x["parent_conv"] is not None else None, (x["thread_conv"], x["thread_turn"]), x["depth"], x["n_quotes"])
           for k, x in run(spark, rows).items()}
    want = brute(rows)
    assert got == want and sum(v[0] is not None for v in want.values()) > 15


def test_plan_runs_no_python(spark):
    plan = Q.linked(mail(spark, [(1, 0, "u", "a")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
    assert Q.quoted(F.lit("a"), 2) is not None
