"""Prompt, completion and chat text as Column expressions.

A null ``input`` counts as empty everywhere.  Values are concatenated, so braces
and percent signs in the data stay as they are.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# The instruction templates and the system message.
HEAD_NO_INPUT = (
    "Below is an instruction that describes a task. "
    "Write a response that appropriately completes the request.\n\n"
)
HEAD_WITH_INPUT = (
    "Below is an instruction that describes a task, paired with an input that provides further context. "
    "Write a response that appropriately completes the request.\n\n"
)
INSTRUCTION = "### Instruction:\n"
INPUT = "\n\n### Input:\n"
RESPONSE = "\n\n### Response:\n"
# Variant with two irregularities: no colon after Response, a space before Input.
VARIANT_INPUT = "\n\n ### Input:\n"
VARIANT_RESPONSE_NO_INPUT = "\n\n### Response\n"
SYSTEM_MESSAGE = "You are a helpful assistant."


def has_input(input: Column | str = "input") -> Column:
    return F.coalesce(_col(input), F.lit("")) != ""


def prompt_only(
    instruction: Column | str = "instruction", input: Column | str = "input", variant: bool = False
) -> Column:
    """The prompt up to and including the response heading."""
    short_tail = VARIANT_RESPONSE_NO_INPUT if variant else RESPONSE
    input_heading = VARIANT_INPUT if variant else INPUT
    short = F.concat(F.lit(HEAD_NO_INPUT + INSTRUCTION), _text(instruction), F.lit(short_tail))
    long = F.concat(
        F.lit(HEAD_WITH_INPUT + INSTRUCTION),
        _text(instruction),
        F.lit(input_heading),
        _text(input),
        F.lit(RESPONSE),
    )
    return F.when(has_input(input), long).otherwise(short)


def completion(output: Column | str = "output", eos: str = "<eos>") -> Column:
    return F.concat(_text(output), F.lit(eos))


def prompt_full(
    instruction: Column | str = "instruction",
    input: Column | str = "input",
    output: Column | str = "output",
    variant: bool = False,
) -> Column:
    """Prompt and output in one text, without an end token."""
    return F.concat(prompt_only(instruction, input, variant), _text(output))


def to_messages(
    instruction: Column | str = "instruction",
    input: Column | str = "input",
    output: Column | str = "output",
    system: str = SYSTEM_MESSAGE,
) -> Column:
    """System, user and assistant messages as ``array<struct<role, content>>``."""
    user = F.when(
        has_input(input), F.concat(_text(instruction), F.lit("\n\n"), _text(input))
    ).otherwise(_text(instruction))
    turns = [("system", F.lit(system)), ("user", user), ("assistant", _text(output))]
    return F.array(*[F.struct(F.lit(r).alias("role"), c.alias("content")) for r, c in turns])


@dataclass(frozen=True)
class ChatTemplate:
    """The literal pieces around each message of a rendered chat."""

    bos: str = "<bos>"
    role_open: str = "<|role|>"
    role_close: str = "<|/role|>\n\n"
    turn_end: str = "<|end|>"

    @property
    def specials(self) -> tuple[str, ...]:
        return tuple(p.strip() for p in (self.bos, self.role_open, self.role_close, self.turn_end))


def render_chat(messages: Column | str, template: ChatTemplate = ChatTemplate()) -> Column:
    turns = F.transform(
        _col(messages),
        lambda m: F.concat(
            F.lit(template.role_open),
            m["role"],
            F.lit(template.role_close),
            m["content"],
            F.lit(template.turn_end),
        ),
    )
    return F.concat(F.lit(template.bos), F.array_join(turns, ""))


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _text(c: Column | str) -> Column:
    return F.coalesce(_col(c), F.lit(""))
