import pytest
from conftest import plan_of

from sftprep.operators.prompts import BLOCK_INTRO, format_block, layouts
from sftprep.operators.templates import Template, render


def test_slots_are_filled_in_two_stages(spark):
    t = Template.of("{{a}} {intro} {x}{y} {x}")
    assert t.slots == ("intro", "x", "y")
    filled = t.fill(intro="{x} $1 \\")
    assert filled.slots == ("x", "y") and filled.fill(x="1", y="{y}").slots == ()
    rows = spark.createDataFrame([("{y}", None), ("", "v")], "x string, z string")
    got = [r["text"] for r in render(rows, filled, y="z").collect()]
    assert got == ["{a} {x} $1 \\ {y}None {y}", "{a} {x} $1 \\ v "]


def test_values_match_string_formatting(spark, edge_rows):
    text = "{instruction}|{{}}|{input}|{output}|{rec_id}"
    got = {r["rec_id"]: r["text"] for r in render(edge_rows, text).collect()}
    assert got == {r["rec_id"]: text.format(**r.asDict()) for r in edge_rows.collect()}


@pytest.mark.parametrize("text", ["{}", "{0}", "{a.b}", "{a[0]}", "{a!r}", "{a:>4}", "{a b}", "{", "}"])
def test_other_slots_are_refused(text):
    with pytest.raises(ValueError):
        Template.of(text)


def test_unknown_names_are_errors(edge_rows):
    with pytest.raises(KeyError):
        Template.of("{a}").fill(b="x")
    with pytest.raises(KeyError):
        render(edge_rows, "{instruction}", other="output")
    with pytest.raises(ValueError):
        render(edge_rows, "{instruction}", when="input")


def test_the_fixed_layouts_are_templates(edge_rows):
    both, without = layouts(BLOCK_INTRO, "\n\n", "\n", "\n\n")
    assert both.slots == ("instruction", "context", "response") and without.slots == ("instruction", "response")
    plan = plan_of(format_block(edge_rows))
    assert "Python" not in plan and "concat" in plan
    assert Template.of("").column() is not None
