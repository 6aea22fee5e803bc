import pytest
from conftest import plan_of

from sftprep.operators.prompts import (
    CONTEXT_RESPONSE,
    INPUT_OUTPUT,
    format_block,
    format_inline,
    inference_prompt,
)

INTRO = (
    "Below is an instruction that describes a task. Write a response that "
    "appropriately completes the request."
)
JA_INTRO = INTRO.replace("a response that", "a response in Japanese that")


def texts(df):
    return {r["rec_id"]: r["text"] for r in df.select("rec_id", "text").collect()}


def test_block_layout(edge_rows):
    got = texts(format_block(edge_rows))
    assert got[1] == got[2] == f"{INTRO}\n\nUSER:\nSay hi\n\nASSISTANT:\nHi"
    assert got[3] == f"{INTRO}\n\nUSER:\nSay hi\n\nINPUT:\n  \n\nASSISTANT:\nHi"
    assert got[4] == f"{INTRO}\n\nUSER:\nSum it\n\nINPUT:\n1 2\n\nASSISTANT:\n3"
    assert got[5] == f"{INTRO}\n\nUSER:\nSay hi\n\nASSISTANT:\nNone"
    assert got[6] == (
        f'{INTRO}\n\nUSER:\nEcho {{response}} %s \\ "q"\n\nINPUT:\n{{input}}'
        "\n\nASSISTANT:\n$1 {x}"
    )
    assert got[7].endswith("USER:\n肺がんの特徴を２つ教えてください。\n\nASSISTANT:\nはい　そうでござる。")
    assert got[8] == f"{INTRO}\n\nUSER:\nemoji 😀\n\nASSISTANT:\n"


def test_inline_layout(edge_rows):
    got = texts(format_inline(edge_rows, INPUT_OUTPUT))
    assert got[1] == f"{JA_INTRO} USER:Say hi ASSISTANT:Hi"
    assert got[3] == f"{JA_INTRO} USER:Say hi INPUT:   ASSISTANT:Hi"
    assert got[4] == f"{JA_INTRO} USER:Sum it INPUT:1 2 ASSISTANT:3"


def test_field_families(edge_rows):
    renamed = edge_rows.withColumnsRenamed({"input": "context", "output": "response"})
    assert texts(format_block(renamed, CONTEXT_RESPONSE)) == texts(format_block(edge_rows))
    no_context = texts(format_block(edge_rows.drop("input")))
    assert no_context[4] == f"{INTRO}\n\nUSER:\nSum it\n\nASSISTANT:\n3"
    with pytest.raises(ValueError):
        format_block(renamed.drop("context"), CONTEXT_RESPONSE)


def test_inference_styles(spark):
    asked = spark.createDataFrame([("X",)], "user_input string")
    got = {
        s: inference_prompt(asked, s).first()["prompt"]
        for s in ("marked", "plain", "chat", "sections")
    }
    assert got["marked"] == f"{INTRO} \n### USER:　X \n### ASSISTANT:"
    assert got["plain"] == f"{INTRO} \nUSER:　X \nASSISTANT:"
    assert got["chat"] == (
        "A chat between a curious user and an artificial intelligence assistant. The "
        "assistant gives helpful, detailed, and polite answers to the user's questions. "
        "USER: X ASSISTANT:"
    )
    assert got["sections"] == f"{INTRO}\n### Instruction:\nX\n\n### Response: "
    with pytest.raises(ValueError):
        inference_prompt(asked, "other")


def test_rendering_is_one_projection(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = rows.selectExpr("doc_id", "text as instruction", "source as input", "lang as output")
    plan = plan_of(format_block(rows))
    assert "Exchange" not in plan and "Python" not in plan and "Pandas" not in plan
