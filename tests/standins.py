"""Stand-ins for models, for tests: they take prompts apart and answer from what stands there."""

from __future__ import annotations

import json
import re
from collections import Counter

from jobweave.functions.prompts import CLASSIFICATION_INSTRUCTIONS, TRANSLATION_INSTRUCTIONS
from jobweave.operators.models import Model

_LETTERS = re.compile(r"[^\W\d_]+")


def _between(prompt: str, start: str, end: str) -> str | None:
    head = prompt.find(start)
    tail = prompt.rfind(end)
    return prompt[head + len(start) : tail] if 0 <= head < tail else None


def _title_and_description(prompt: str, end: str) -> tuple[str, str] | None:
    for title_mark, description_mark in (
        ("- Translate the following Job Ad Title in english:\n",
         "\n\n- Translate the following Job Ad Description in english:\n"),
        ("- Job Ad Title:\n", "\n\n- Job Ad Description:\n"),
    ):
        body = _between(prompt, title_mark, end)
        if body is not None and description_mark in body:
            title, description = body.split(description_mark, 1)
            return title, description
    return None


def frequent_words(text: str, n: int = 5, shortest: int = 4) -> list[str]:
    counts = Counter(w for w in _LETTERS.findall(text.lower()) if len(w) >= shortest)
    return [w for w, _ in sorted(counts.items(), key=lambda item: (-item[1], item[0]))[:n]]


def answer_translation(prompt: str) -> str:
    """Title and description as they are, and the most frequent words as keywords."""
    parts = _title_and_description(prompt, "\n\n" + TRANSLATION_INSTRUCTIONS)
    if parts is None:
        return "no job ad found"
    title, description = parts
    return json.dumps(
        {
            "job_desc_extracted": description not in ("", "None"),
            "title": title,
            "description": description,
            "keywords": frequent_words(description),
        },
        ensure_ascii=False,
    )


def answer_classification(prompt: str) -> str:
    """The first proposed category, with the share of its words that the ad has."""
    parts = _title_and_description(prompt, "\n\n- Relevant Occupational Categories:\n")
    categories = _between(
        prompt, "\n\n- Relevant Occupational Categories:\n", "\n\n" + CLASSIFICATION_INSTRUCTIONS
    )
    first = re.match(r"(\S+): ([^\n]*)", categories or "")
    if parts is None or first is None:
        return json.dumps({"codable": False, "class_code": None, "likelihood": None})
    ad = set(_LETTERS.findall(" ".join(parts).lower()))
    label = set(_LETTERS.findall(first[2].lower()))
    share = len(ad & label) / len(label) if label else 0.0
    return json.dumps({"codable": True, "class_code": first[1], "likelihood": share})


def offline_translator() -> Model:
    return lambda prompts: prompts.map(answer_translation, na_action="ignore")


def offline_classifier() -> Model:
    return lambda prompts: prompts.map(answer_classification, na_action="ignore")
