"""Rendering instruction rows into training texts and requests into prompts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from sftprep.operators.templates import Template, render

# Wording a trained model expects, byte for byte.
BLOCK_INTRO = (
    "Below is an instruction that describes a task. "
    "Write a response that appropriately completes the request."
)
INLINE_INTRO = (
    "Below is an instruction that describes a task. "
    "Write a response in Japanese that appropriately completes the request."
)
CHAT_INTRO = (
    "A chat between a curious user and an artificial intelligence assistant. "
    "The assistant gives helpful, detailed, and polite answers to the user's questions."
)
INSTRUCTION_KEY = "USER:"
INPUT_KEY = "INPUT:"
RESPONSE_KEY = "ASSISTANT:"

# Text before and after the request for each inference style.
# The gap after the first two keys is the full-width space U+3000.
INFERENCE_STYLES = {
    "marked": (BLOCK_INTRO + " \n### USER:　", " \n### ASSISTANT:"),
    "plain": (BLOCK_INTRO + " \nUSER:　", " \nASSISTANT:"),
    "chat": (CHAT_INTRO + " USER: ", " ASSISTANT:"),
    "sections": (BLOCK_INTRO + "\n### Instruction:\n", "\n\n### Response: "),
}


@dataclass(frozen=True)
class Fields:
    """Which columns play instruction, context and response."""

    instruction: str = "instruction"
    context: str = "input"
    response: str = "output"
    context_optional: bool = True

    def context_column(self, df: DataFrame) -> Column:
        if self.context in df.columns:
            return F.col(self.context)
        if self.context_optional:
            return F.lit(None).cast("string")
        raise ValueError(f"column {self.context!r} is required by this layout")


INPUT_OUTPUT = Fields()
CONTEXT_RESPONSE = Fields("instruction", "context", "response", context_optional=False)


def layouts(intro: str, head: str, lead: str, sep: str) -> tuple[Template, Template]:
    """The layout with context and the one without, open slots being the fields."""
    start = "{intro}{head}{asks}{lead}{instruction}"
    end = "{sep}{answers}{lead}{response}"
    keys = {"intro": intro, "head": head, "lead": lead, "sep": sep, "asks": INSTRUCTION_KEY, "answers": RESPONSE_KEY}
    both = Template.of(start + "{sep}{given}{lead}{context}" + end).fill(**keys, given=INPUT_KEY)
    return both, Template.of(start + end).fill(**keys)


def _layout(df: DataFrame, fields: Fields, out: str, intro: str, head: str, lead: str, sep: str) -> DataFrame:
    with_context, without = layouts(intro, head, lead, sep)
    return render(
        df, with_context, without, when="context", out=out, instruction=fields.instruction,
        context=fields.context_column(df), response=fields.response,
    )


def format_block(
    df: DataFrame, fields: Fields = INPUT_OUTPUT, intro: str = BLOCK_INTRO, out: str = "text"
) -> DataFrame:
    """Keys and values on their own lines, blank lines between the blocks."""
    return _layout(df, fields, out, intro, "\n\n", "\n", "\n\n")


def format_inline(
    df: DataFrame, fields: Fields = CONTEXT_RESPONSE, intro: str = INLINE_INTRO, out: str = "text"
) -> DataFrame:
    """Everything on one line, each key directly followed by its value."""
    return _layout(df, fields, out, intro, " ", "", " ")


def inference_prompt(
    df: DataFrame, style: str = "marked", request: str = "user_input", out: str = "prompt"
) -> DataFrame:
    """A prompt whose response slot is open.

    Styles differ from the training layouts on purpose; they are what callers send.
    """
    if style not in INFERENCE_STYLES:
        raise ValueError(f"unknown style {style!r}; one of {sorted(INFERENCE_STYLES)}")
    before, after = INFERENCE_STYLES[style]
    asked = Template.of("{before}{request}{after}").fill(before=before, after=after)
    return render(df, asked, out=out, request=request)
