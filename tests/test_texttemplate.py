"""Templates given as text against renderers written by hand, row by row."""

import random

import pytest
from pyspark.sql import functions as F

from quire.operators.template import render_messages, render_prompts
from quire.operators.texttemplate import TemplateError, TextTemplate

MESSAGES = "messages array<struct<role:string,content:string,thinking:string>>"

TURNS = """{%- for message in messages %}
    {{- '<|im_start|>' + message['role'] + '\\n' + message['content'] | trim + '<|im_end|>' + '\\n' }}
{%- endfor %}
{%- if add_generation_prompt %}
    {{- '<|im_start|>assistant\\n' }}
{%- endif %}
"""


def turns(messages, prompt, effort):
    return "".join(f"<|im_start|>{r}\n{c.strip()}<|im_end|>\n" for r, c, _ in messages) + ("<|im_start|>assistant\n" if prompt else "")


FOLDED = """{% if messages[0].role == 'system' %}
{% set system = '<<SYS>>\\n' ~ messages[0]['content'] ~ '\\n<</SYS>>\\n\\n' %}
{% set rest = messages[1:] %}
{% else %}
{% set rest = messages %}
{% endif %}
{# the system text goes into the first user turn #}
{% for m in rest %}
{% if loop.first and system is defined %}{% set content = system + m.content %}{% else %}{% set content = m.content %}{% endif %}
{% if m.role == 'user' %}{{ bos_token }}[INST] {{ content|trim }} [/INST]{% elif m.role == "assistant" %} {{ content }} {{ eos_token }}{% else %}{{ raise_exception('no ' + m.role + ' here') }}{% endif %}
{% endfor %}
"""


def folded(messages, prompt, effort):
    system = ""
    if messages and messages[0][0] == "system":
        system, messages = f"<<SYS>>\n{messages[0][1]}\n<</SYS>>\n\n", messages[1:]
    out = ""
    for k, (r, c, _) in enumerate(messages):
        c = system + c if k == 0 else c
        out += f"<s>[INST] {c.strip()} [/INST]" if r == "user" else f" {c} </s>"
        out += "\n" if r == "nobody" else ""
    return out


REASONED = """{%- if reasoning_effort is defined %}Effort: {{ reasoning_effort | upper }}{{ '\\n' }}{% endif -%}
{%- for m in messages -%}
  {%- if m.thinking and loop.last -%}<think>{{ m.thinking }}</think>{%- endif -%}
  {{ loop.index }}/{{ messages | length }} {{ m['role'] if m['role'] in ['user', 'assistant'] else 'other' }}: {{ m.content | default('nothing') }}
  {%- if 'x' in m.content and not loop.first %} (x){% endif -%}
  {{ '\\n' if not loop.last else eos_token }}
{%- endfor -%}
{%- if add_generation_prompt -%}assistant: {%- endif -%}"""


def reasoned(messages, prompt, effort):
    out = f"Effort: {effort.upper()}\n" if effort is not None else ""
    for k, (r, c, t) in enumerate(messages):
        last = k == len(messages) - 1
        out += f"<think>{t}</think>" if t and last else ""
        out += f"{k + 1}/{len(messages)} {r if r in ('user', 'assistant') else 'other'}: {'nothing' if c is None else c}"
        out += " (x)" if c and "x" in c and k else ""
        out += "</s>" if last else "\n"
    return out + ("assistant:" if prompt else "")


def talks(seed, roles, none=False):
    r = random.Random(seed)
    for i in range(40):
        rows = [(r.choice(roles), r.choice(["hi", " padded  ", "éx 日本", "two\nlines", "", "$1 \\n {{ no }}"]), r.choice([None, "", "why"])) for _ in range(r.randrange(0, 6))]
        if none and rows and r.random() < 0.3:
            rows[0] = (rows[0][0], None, None)
        if "system" in roles and roles[-1] == "assistant":
            rows = [("system" if k == 0 and r.random() < 0.5 else x[0] if x[0] != "system" else "user", *x[1:]) for k, x in enumerate(rows)]
        yield i, rows


CASES = [(TURNS, turns, ["system", "user", "assistant", "tool"], False), (FOLDED, folded, ["system", "user", "assistant"], False),
         (REASONED, reasoned, ["user", "tool", "system", "assistant", "x"], True)]


@pytest.mark.parametrize("source,expected,roles,none", CASES, ids=["turns", "folded", "reasoned"])
def test_three_templates_equal_renderers_by_hand(spark, source, expected, roles, none):
    rows = list(talks(5, roles, none))
    df = spark.createDataFrame(rows, "id int, " + MESSAGES).withColumn("effort", F.when(F.col("id") % 2 == 0, "low"))
    t = TextTemplate(source, (("bos_token", "<s>"), ("eos_token", "</s>")))
    text = {r.id: r.text for r in render_messages(df, template=t, keep=["id"]).collect()}
    prompt = {r.id: r.prompt for r in render_prompts(df, template=t, effort_col="effort").collect()}
    for i, ms in rows:
        assert text[i] == expected(ms, False, None)
        assert prompt[i] == expected(ms, True, "low" if i % 2 == 0 else None)
    plan = render_messages(df, template=t)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_a_template_fails_rows_by_its_own_words(spark):
    df = spark.createDataFrame([([("tool", "x", None)],)], MESSAGES)
    with pytest.raises(Exception, match="no tool here"):
        render_messages(df, template=TextTemplate(FOLDED)).collect()
    with pytest.raises(Exception, match="a message has no role"):
        render_messages(spark.createDataFrame([([(None, "x", None)],)], MESSAGES), template=TextTemplate(TURNS)).collect()


@pytest.mark.parametrize("source,said", [
    ("a\n{% for x in messages %}", "missing 'endfor'"), ("{% if 1 %}", "missing 'endif'"), ("\n\n{{ messages }}", "line 3: a messages cannot be printed"),
    ("{{ tojson(x) }}", "no function 'tojson'"), ("{{ 'a' | tojson }}", "no filter 'tojson'"), ("{% macro f() %}", "no block 'macro'"),
    ("{% set ns.x = 1 %}", "only plain names"), ("{{ 'a' 'b' }}", "unexpected"), ("{{ messages[0] < 3 }}", "cannot compare"), ("{{ 3 + 'a' }}", "int \\+ text"),
    ("{% for k in 'abc' %}{% endfor %}", "runs over messages"), ("{{ ? }}", "cannot read"), ("{{ }}", "ends early"), ("{{ (1 }}", "expected '\\)'")])
def test_what_the_language_lacks_is_an_error(spark, source, said):
    df = spark.createDataFrame([([("user", "x", None)],)], MESSAGES)
    with pytest.raises(TemplateError, match=said):
        render_messages(df, template=TextTemplate(source))


def test_values(spark):
    df = spark.createDataFrame([([("user", "a", None), ("user", "b", None), ("user", "c", None)],)], MESSAGES)
    show = lambda e: render_messages(df, template=TextTemplate("{{ " + e + " }}")).first().text
    assert show("messages[-1].content ~ messages[0].content ~ messages[9].content") == "ca"
    assert show("messages[1:][0].content + messages[:2] [1].content + messages[-2:][0].content") == "bbb"
    assert show("1 + 2 == 3 and not (2 < 1)") == "True" and show("missing or 'x'") == "x" and show("none") == ""
    assert show("'a' if messages | length > 3 else \"it's\"") == "it's" and show(r"'tab\tquote\''") == "tab\tquote'"
    assert show("'a' not in ['b', 'c']") == "True" and show("missing is not defined") == "True" and show("1 == '1'") == "False"
    assert show("' x '.strip() ~ 'ab'.startswith('a')") == "xTrue" and show("add_generation_prompt") == "False"
    assert render_messages(df, template=TextTemplate("  {% if true %}\n  text\n  {% endif %}\nend{# note #}\n")).first().text == "  text\nend"


def test_jobs_take_a_template_file(spark, tmp_path):
    from quire.plans import jobs
    from quire.sources.tables import read_published

    src, out, file = str(tmp_path / "in"), str(tmp_path / "out"), tmp_path / "t.txt"
    spark.createDataFrame([(1, 0, "user", "hi"), (1, 1, "assistant", "yo")], "conv_id long, turn long, role string, text string").write.parquet(src)
    file.write_text("{% for m in messages %}{{ m.role }}: {{ m.content }};{% endfor %}")
    jobs.main(["prepare", "--dataset", src, "--out", out, "--template", str(file)])
    assert [r.text for r in read_published(spark, out).collect()] == ["user: hi;assistant: yo;"]
