"""Sections of an occupation's notes, and the texts built from hits."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, functions as F

from jobweave import fixed
from jobweave.functions.expressions import let
from jobweave.functions.text import strip


def _section(lines: Column, headings: list[str], marker: str) -> Column:
    """The first heading of the list that occurs, with the marked lines right after it.

    The list's order counts, not the order in the text. Null where no heading occurs.
    """
    position = F.coalesce(
        *(F.nullif(F.array_position(lines, h), F.lit(0).cast("bigint")) for h in headings)
    ).cast("int")

    def take(start: Column) -> Column:
        rest = F.slice(lines, start + 1, F.size(lines))
        unmarked = F.array_position(
            F.transform(rest, lambda line: F.startswith(line, F.lit(marker))), False
        ).cast("int")
        items = F.when(unmarked == 0, rest).otherwise(F.slice(rest, 1, unmarked - 1))
        return F.concat(F.array(F.element_at(lines, start)), items)

    return let(position, lambda start: F.when(start.isNotNull(), take(start)))


def extract_info(text: Column, paragraphs: Collection[str]) -> Column:
    """First line, then the asked sections of ``tasks`` and ``examples``.

    When tasks are asked for but missing, examples are left out as well.
    """

    def build(lines: Column) -> Column:
        first = F.slice(lines, 1, 1)
        none = F.array().cast("array<string>")
        if list(paragraphs) == ["description"]:
            return F.array_join(first, "\n")
        examples = (
            F.coalesce(_section(lines, fixed.EXAMPLE_HEADINGS, "-"), none)
            if "examples" in paragraphs
            else none
        )
        if "tasks" not in paragraphs:
            return F.array_join(F.concat(first, examples), "\n")
        tasks = _section(lines, fixed.TASK_HEADINGS, "(")
        return let(
            tasks,
            lambda found: F.array_join(
                F.when(found.isNull(), first).otherwise(F.concat(first, found, examples)), "\n"
            ),
        )

    return let(F.transform(F.split(text, "\n"), strip), build)


def format_hits(hits: Column) -> Column:
    """``code: label - info`` of each hit, separated by blank lines."""
    return F.array_join(
        F.transform(
            hits,
            lambda h: F.concat(
                F.coalesce(h["code"], F.lit("None")), F.lit(": "),
                F.coalesce(h["label"], F.lit("None")), F.lit(" - "), h["info"],
            ),
        ),
        "\n\n",
    )


def keywords_text(keywords: Column) -> Column:
    """Comma-separated keywords: null stays null, an empty list gives an empty text."""
    return F.when(keywords.isNotNull(), F.array_join(keywords, ", "))
