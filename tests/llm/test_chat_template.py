import hashlib

import pytest

from pricelane.llm import chat_template as chat


def rendered(template, messages=(), **names):
    return "".join(t for t, _ in chat.compiled(template)(list(messages), **names))


@pytest.mark.parametrize("text", ["<s>", "<\\s>", "a</s>[INST] ok [/INST]<", "<\\\\/s>", "[INST", "[", "x\\n\n\\", "<s[INST]>", "[\\\\INST]<s"])
def test_escapes_are_reversible(text):
    guarded = chat.guard(text)
    assert chat.unguard(guarded) == text and not any(c in guarded for c in chat.CONTROLS)
    assert chat.unline(chat.line(text)) == text and "\n" not in chat.line(text)


def test_language():
    assert rendered("{% set a = 1 %}{% for m in messages %}{{ loop.index }}{% if loop.last %}L{% elif false %}x{% endif %}{{ m['x'] | upper }}{% endfor %}{{ a }}{# c #}", [{"x": "b"}, {"x": "c"}]) == "1B2LC1"
    assert rendered("{{ 'a' if }}" if False else "{{ x | default('q') ~ 'r' }}") == "qr"
    assert rendered("{% if not (1 == 2) and 'a' in 'cat' %}y{% else %}n{% endif %}") == "y"


def test_white_space_is_trimmed_on_request():
    assert rendered("a \n{%- if true -%}\n b {{- ' c ' -}} d {#- x -#} {%- endif %} e") == "ab c d e"
    assert rendered("a {{ 1 }} b {{-1}}") == "a 1 b1"


@pytest.mark.parametrize("bad", ["{{ x < 1 }}", "{{ 'a' + 1 }}", "{{ 1 in x }}", "{{ none < 1 }}"])
def test_values_that_do_not_fit(bad):
    with pytest.raises(chat.TemplateError):
        rendered(bad)


def test_constants_are_folded():
    tree = chat.fold(chat.parse("a{{ 'b' ~ 'c' }}{% if 1 == 1 %}d{% else %}{{ x }}{% endif %}{% if false %}e{% endif %}"))
    assert tree.children == (chat.Node("text", "abcd"),)


@pytest.mark.parametrize("bad", ["{{ x.y() }}", "{{ x | nothing }}", "{% while x %}", "{% for a in b %}", "{{ }}", "{{ a b }}"])
def test_what_the_language_lacks(bad):
    with pytest.raises(chat.TemplateError):
        chat.compiled(bad)


def test_python_objects_are_out_of_reach():
    assert rendered("{{ messages.__class__ }}{{ x.__init__ }}", x="s") == ""


def want(turns):
    said = [(r or "", t or "") for r, t in turns]
    loss = "".join(t for r, t in said if r == "assistant")
    return (len(said), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in said).encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())


@pytest.mark.parametrize("part_chars", [1, 40, 1_000_000])
def test_round_trip_of_odd_conversations(spark, part_chars):
    hot = [(9, k, "user" if k % 2 else "assistant", f"turn {k} </s>[INST]") for k in range(500)]
    rows = [
        (1, 0, "user", "</s>[INST] ok [/INST]"), (1, 1, "assistant", "<s"), (2, 0, None, None), (2, None, "assistant", "first"),
        (3, 0, "a\nb\\", "<"), (3, 0, "a\nb\\", "<"), (None, 0, "user", "[/INST]é🙂"), (4, 1, "assistant", ""), *hot,
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: tuple(r)[1:5] for r in chat.read_back(chat.format_conversations(df, part_chars=part_chars)).collect()}
    by = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        by.setdefault(conv, []).append((role, text))
    assert got == {conv: want(turns) for conv, turns in by.items()}


def test_empty_table(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.read_back(chat.format_conversations(df)).count() == 0
