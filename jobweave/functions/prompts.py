"""Prompts as column expressions."""

from __future__ import annotations

from collections.abc import Mapping
from string import Formatter

from pyspark.sql import Column, functions as F

from jobweave import fixed
from jobweave.config import ChatMarkers


def render(template: str, values: Mapping[str, Column]) -> Column:
    """Fill a template's placeholders; a missing value reads ``None``.

    The template is cut at its placeholders, so that a value which itself looks like a
    placeholder stays as it is.
    """
    pieces = []
    for literal, name, _, _ in Formatter().parse(template):
        if literal:
            pieces.append(F.lit(literal))
        if name is not None:
            pieces.append(F.coalesce(values[name].cast("string"), F.lit("None")))
    return F.concat(*pieces)


def message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def format_instructions(fields: Mapping[str, tuple[str, str]]) -> str:
    """How to answer, written from the answer's fields. The same for every row of a job."""
    lines = [f'- "{name}" ({kind}): {text}' for name, (kind, text) in fields.items()]
    return "\n".join(["Answer with one JSON object and nothing else. Its fields are:", *lines])


TRANSLATION_INSTRUCTIONS = format_instructions(fixed.TRANSLATION_FIELDS)
CLASSIFICATION_INSTRUCTIONS = format_instructions(fixed.CLASSIFICATION_FIELDS)


def retrieval_query(query: Column, task: str = fixed.RETRIEVAL_TASK) -> Column:
    """The search text for one field; no text, no query."""
    return F.when(
        query.isNotNull(),
        render(fixed.RETRIEVAL_QUERY, {"task_description": F.lit(task), "query": query}),
    )


def translation_messages(
    title: Column,
    description: Column,
    language: Column,
    instructions: str = TRANSLATION_INSTRUCTIONS,
) -> Column:
    """English ads are summarised, all others translated from ``language`` (its name)."""
    values = {
        "title": title,
        "description": description,
        "format_instructions": F.lit(instructions),
        "language": language,
    }

    def conversation(system: str, user: str) -> Column:
        return F.array(
            message("system", render(system, values)), message("user", render(user, values))
        )

    return F.when(
        language == "English", conversation(fixed.EXTRACTION_SYSTEM, fixed.EXTRACTION_USER)
    ).otherwise(conversation(fixed.TRANSLATION_SYSTEM, fixed.TRANSLATION_USER))


def classification_messages(
    title: Column,
    description: Column,
    categories: Column,
    instructions: str = CLASSIFICATION_INSTRUCTIONS,
) -> Column:
    user = render(
        fixed.CLASSIFICATION_USER,
        {
            "title": title,
            "description": description,
            "proposed_categories": categories,
            "format_instructions": F.lit(instructions),
        },
    )
    return F.array(
        message("system", F.lit(fixed.CLASSIFICATION_SYSTEM)), message("user", user)
    )


def chat_text(messages: Column, markers: ChatMarkers = ChatMarkers()) -> Column:
    """A conversation as one string that ends where the model has to go on."""
    return F.concat(
        F.array_join(
            F.transform(
                messages,
                lambda m: F.concat(
                    F.lit(markers.before_role), m["role"], F.lit(markers.after_role),
                    m["content"], F.lit(markers.after_content),
                ),
            ),
            "",
        ),
        F.lit(markers.generation),
    )
