"""Reading of model answers: JSON text to typed, validated fields.

An answer that breaks one rule counts as unreadable as a whole. The rules are stricter than
``from_json`` in some places (required fields, no number for a text) and laxer in others
(``"yes"`` is a boolean), hence VARIANT.
"""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column, functions as F
from pyspark.sql.types import StringType

from jobweave import fixed
from jobweave.functions.expressions import let
from jobweave.functions.text import strip

TRANSLATION_TYPE = (
    "struct<parsed:boolean,job_desc_extracted:boolean,title:string,description:string,"
    "keywords:array<string>>"
)
CLASSIFICATION_TYPE = "struct<parsed:boolean,codable:boolean,class_code:string,likelihood:double>"

_FENCE = r"(?s)```(?:json)?(.*?)(?:```|\z)"
_NUMBER = r"^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?$"
_SPECIAL = r"(?i)^[+-]?(inf|infinity|nan)$"
_NUMERIC_KIND = r"^(TINYINT|SMALLINT|INT|BIGINT|FLOAT|DOUBLE|DECIMAL.*)$"


def answer_json(raw: Column, strict: bool = False) -> Column:
    """The object in an answer as VARIANT, null where there is none.

    A fenced block, also one that is not closed, wins over the text around it. The object comes first in
    what remains; text after it does not matter, raw control characters in strings are taken as they
    are, and an object that breaks off is closed where it does. ``strict`` asks for exactly one object.
    """
    fenced = F.regexp_extract(raw, _FENCE, 1)
    body = strip(F.when(F.rlike(raw, F.lit(_FENCE)), fenced).otherwise(raw))

    def read(b: Column) -> Column:
        exact = F.when(F.rlike(b, F.lit(r"(?s)^\{.*\}\z")), F.try_parse_json(b))
        if strict:
            return exact
        # Only answers that are not already one object are looked at in Python.
        open_ = F.when(exact.isNull() & F.startswith(b, F.lit("{")), b)
        return F.coalesce(exact, F.try_parse_json(_first_object(open_)))

    return let(body, read) if strict else read(body)


def _first_object(text: Column) -> Column:
    def find(texts: pd.Series) -> pd.Series:
        return texts.map(first_object, na_action="ignore")

    return F.pandas_udf(find, StringType())(text)


_TOKEN = re.compile(r'"(?:[^"\\]|\\.)*"|[{}\[\]]|"|[^"{}\[\]]+', re.S)


def first_object(text: str) -> str | None:
    """The first object of a text as strict JSON; one that breaks off is closed."""
    closers: list[str] = []
    end = None
    for token in _TOKEN.finditer(text):
        mark = token[0]
        if mark in "{[":
            closers.append("}" if mark == "{" else "]")
        elif mark in "}]":
            if not closers or closers.pop() != mark:
                return None
            if not closers:
                end = token.end()
                break
        elif mark == '"':  # a string that never ends
            rest = text[token.start() :]
            return _strict(f"{text[: token.start()]}{rest.removesuffix(chr(92))}\"", closers)
    if end is not None:
        return _strict(text[:end], [])
    return _strict(text, closers)


def _strict(text: str, closers: list[str]) -> str | None:
    """Close what is open, dropping an unfinished member if the text cannot be read with it."""
    while True:
        for tail in ("", "null", ": null"):
            try:
                value = json.loads(text.rstrip().rstrip(",") + tail + "".join(reversed(closers)), strict=False)
            except ValueError:
                continue
            return json.dumps(value, ensure_ascii=False) if isinstance(value, dict) else None
        cut = text.rfind(",")
        if cut < 0 or not closers:
            return None
        text = text[:cut]


def _field(answer: Column, name: str, rule) -> Column:
    """``rule(value, kind)`` on one field. Kind is null for a missing field, VOID for JSON null."""
    value = F.try_variant_get(answer, f"$.{name}", "variant")
    return let(
        F.struct(value.alias("value"), F.schema_of_variant(value).alias("kind")),
        lambda f: rule(f["value"], f["kind"]),
    )


def _result(ok: Column, value: Column, kind: str) -> Column:
    return F.struct(F.coalesce(ok, F.lit(False)).alias("ok"), value.cast(kind).alias("value"))


def _text_of(value: Column) -> Column:
    return F.try_variant_get(value, "$", "string")


def _boolean(value: Column, kind: Column) -> Column:
    number = F.when(F.rlike(kind, F.lit(_NUMERIC_KIND)), F.try_variant_get(value, "$", "double"))
    word = F.when(kind == "STRING", F.lower(_text_of(value)))
    read = (
        F.when(kind == "BOOLEAN", F.try_variant_get(value, "$", "boolean"))
        .when((number == 1) | word.isin(fixed.TRUE_WORDS), True)
        .when((number == 0) | word.isin(fixed.FALSE_WORDS), False)
    )
    return let(read, lambda r: _result(r.isNotNull(), r, "boolean"))


def _number_or_null(value: Column, kind: Column) -> Column:
    word = strip(F.when(kind == "STRING", _text_of(value)))
    read = (
        F.when(F.rlike(kind, F.lit(_NUMERIC_KIND)), F.try_variant_get(value, "$", "double"))
        .when(kind == "BOOLEAN", F.try_variant_get(value, "$", "boolean").cast("double"))
        .when(F.rlike(word, F.lit(_NUMBER)) | F.rlike(word, F.lit(_SPECIAL)), word.try_cast("double"))
    )
    return let(read, lambda r: _result((kind == "VOID") | r.isNotNull(), r, "double"))


def _text_or_null(coerce_objects: bool, required: bool):
    def rule(value: Column, kind: Column) -> Column:
        read = F.when(kind == "STRING", _text_of(value))
        ok = kind.isin("STRING", "VOID")
        if coerce_objects:
            is_object = F.startswith(kind, F.lit("OBJECT"))
            read = read.when(is_object, F.to_json(value))
            ok = ok | is_object
        if not required:
            ok = ok | kind.isNull()
        return _result(ok, read, "string")

    return rule


def _texts_or_null(value: Column, kind: Column) -> Column:
    items = F.when(
        F.startswith(kind, F.lit("ARRAY")), F.try_variant_get(value, "$", "array<variant>")
    )
    all_texts = F.forall(items, lambda i: F.coalesce(F.schema_of_variant(i) == "STRING", F.lit(False)))
    return _result((kind == "VOID") | all_texts, F.transform(items, _text_of), "array<string>")


def _read(raw: Column, fields: dict, fallback: str, result_type: str) -> Column:
    def read(answer: Column) -> Column:
        parts = F.struct(*(_field(answer, name, rule).alias(name) for name, rule in fields.items()))

        def assemble(p: Column) -> Column:
            ok = F.lit(True)
            for name in fields:
                ok = ok & p[name]["ok"]
            values = [
                F.when(ok, p[name]["value"])
                .otherwise(F.lit(False) if name == fallback else F.lit(None))
                .alias(name)
                for name in fields
            ]
            return F.struct(ok.alias("parsed"), *values).cast(result_type)

        return let(parts, assemble)

    return let(answer_json(raw), read)


def parse_translation(raw: Column, coerce_objects: bool = False) -> Column:
    """Struct ``parsed, job_desc_extracted, title, description, keywords``."""
    text = _text_or_null(coerce_objects, required=True)
    return _read(
        raw,
        {"job_desc_extracted": _boolean, "title": text, "description": text,
         "keywords": _texts_or_null},
        fallback="job_desc_extracted",
        result_type=TRANSLATION_TYPE,
    )


def parse_classification(raw: Column, coerce_objects: bool = False) -> Column:
    """Struct ``parsed, codable, class_code, likelihood``; only the code may be left out."""
    return _read(
        raw,
        {"codable": _boolean, "class_code": _text_or_null(coerce_objects, required=False),
         "likelihood": _number_or_null},
        fallback="codable",
        result_type=CLASSIFICATION_TYPE,
    )
