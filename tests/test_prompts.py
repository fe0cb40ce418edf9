from pyspark.sql import functions as F

from jobweave import fixed
from jobweave.config import ChatMarkers
from jobweave.functions import prompts as P
from jobweave.plans.stages import translation_prompts

ADS = [("1", "en", "T {description}", "D"), ("2", "fr", None, "D"), ("3", "un", "T", None)]


def test_translation(spark):
    df = spark.createDataFrame(ADS, "id string, lang string, title string, description string")
    got = {r["id"]: r["translation_prompt"] for r in translation_prompts(df, "title", "description").collect()}
    marks = ChatMarkers()

    def whole(system, user, **values):
        body = user.format(format_instructions=P.TRANSLATION_INSTRUCTIONS, **values)
        return "".join(
            f"{marks.before_role}{role}{marks.after_role}{text}{marks.after_content}"
            for role, text in (("system", system), ("user", body))
        ) + marks.generation

    assert got["1"] == whole(fixed.EXTRACTION_SYSTEM, fixed.EXTRACTION_USER, title="T {description}", description="D")
    french = fixed.TRANSLATION_SYSTEM.format(language="French")
    assert got["2"] == whole(french, fixed.TRANSLATION_USER, title=None, description="D")
    undefined = fixed.TRANSLATION_SYSTEM.format(language="Undefined")
    assert got["3"] == whole(undefined, fixed.TRANSLATION_USER, title="T", description=None)


def test_classification(spark):
    df = spark.createDataFrame([("T", None, "1: a {title}")], "t string, d string, c string")
    messages = df.select(
        P.classification_messages(F.col("t"), F.col("d"), F.col("c")).alias("m")
    ).first()["m"]
    assert [m["role"] for m in messages] == ["system", "user"]
    assert messages[0]["content"] == fixed.CLASSIFICATION_SYSTEM
    assert messages[1]["content"] == fixed.CLASSIFICATION_USER.format(
        title="T", description="None", proposed_categories="1: a {title}",
        format_instructions=P.CLASSIFICATION_INSTRUCTIONS,
    )


def test_query(rows):
    assert rows(["nurse", None, ""], P.retrieval_query) == [
        f"Instruct: {fixed.RETRIEVAL_TASK}\nQuery: nurse", None,
        f"Instruct: {fixed.RETRIEVAL_TASK}\nQuery: ",
    ]


def test_instructions_name_every_field():
    for fields in (fixed.CLASSIFICATION_FIELDS, fixed.TRANSLATION_FIELDS):
        assert all(f'"{name}"' in P.format_instructions(fields) for name in fields)
