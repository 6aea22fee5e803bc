"""Templates with named slots, filled in two stages, as column expressions."""

from __future__ import annotations

from dataclasses import dataclass
from string import Formatter

from pyspark.sql import Column, DataFrame, functions as F

from sftprep.functions import truthy, words_or_none


@dataclass(frozen=True)
class Template:
    """Text and slots in turn: ``(text, None)`` or ``("", slot)``.

    ``Template.of("Q: {question} {{kept}}")`` reads a format string: ``{name}`` is a slot and
    doubled braces are braces. Constants are put in by ``fill`` when a template is defined,
    columns by ``column`` when it is used. What is put in is text from then on: braces in
    it stay as they are. Slots have names only; numbers, attributes, conversions and
    formats are refused, for columns have no such thing.
    """

    parts: tuple[tuple[str, str | None], ...]

    @classmethod
    def of(cls, text: str) -> Template:
        parts: list[tuple[str, str | None]] = []
        for literal, slot, spec, conversion in Formatter().parse(text):
            if literal:
                parts.append((literal, None))
            if slot is not None:
                if not slot.isidentifier() or spec or conversion:
                    raise ValueError(f"a slot needs a plain name, not {slot!r}{conversion or ''}{spec or ''}")
                parts.append(("", slot))
        return cls(tuple(parts))

    @property
    def slots(self) -> tuple[str, ...]:
        """Names of the slots still open, in order, each once."""
        return tuple(dict.fromkeys(s for _, s in self.parts if s is not None))

    def fill(self, **constants: str) -> Template:
        """The template with some slots filled; a name that is no open slot is an error."""
        unknown = sorted(set(constants) - set(self.slots))
        if unknown:
            raise KeyError(f"no open slot {unknown}; open are {list(self.slots)}")
        return Template(tuple((constants[s], None) if s in constants else (t, s) for t, s in self.parts))

    def column(self, **columns: Column | str) -> Column:
        """One native expression. A slot that is not named takes the column of its own
        name; null reads ``None``, as string formatting prints it."""
        unknown = sorted(set(columns) - set(self.slots))
        if unknown:
            raise KeyError(f"no open slot {unknown}; open are {list(self.slots)}")
        values = [
            F.lit(text) if slot is None else words_or_none(columns.get(slot, slot)) for text, slot in self.parts
        ]
        return F.concat(*values) if values else F.lit("")


def render(
    df: DataFrame,
    template: Template | str,
    otherwise: Template | str | None = None,
    when: str | None = None,
    out: str = "text",
    **columns: Column | str,
) -> DataFrame:
    """Adds ``out``. With ``when``, rows whose column of that name is null or empty take
    ``otherwise`` instead; white space counts as a value.

    ``columns`` may name slots of either template.
    """
    template, otherwise = (Template.of(t) if isinstance(t, str) else t for t in (template, otherwise))
    if (otherwise is None) != (when is None):
        raise ValueError("`when` and `otherwise` go together")
    used = {*template.slots, *(otherwise.slots if otherwise else ())}
    unknown = sorted(set(columns) - used)
    if unknown:
        raise KeyError(f"no open slot {unknown}; open are {sorted(used)}")

    def own(t: Template) -> Column:
        return t.column(**{s: columns[s] for s in t.slots if s in columns})

    text = own(template)
    if otherwise is not None:
        text = F.when(truthy(columns.get(when, when)), text).otherwise(own(otherwise))
    return df.withColumn(out, text)
