import random

from pyspark.sql import functions as F

from jobweave import fixed
from jobweave.functions import text as T

def test_whitespace_is_what_strip_takes_off():
    assert set(fixed.WHITESPACE) == {chr(c) for c in range(0x110000) if chr(c).isspace()}


CLEANED = {
    "&lt;b&gt;x&lt;/b&gt;": "x", "&amp;lt;": "&lt;", "&copy 2020": "© 2020", "&#8364;": "€", "&#x20AC;": "€",
    "<>": "<>", "<a<b>": "<a", "unclosed < here": "unclosed < here", "a < b > c": "a c", "x<br/>y": "x y",
    "http://a": "http://a", "http://ab": "", "https://www.x.y/z": "", "see http://ab, then": "see then",
    "https://www.": "", "http://$x": "http://$x", "a https://b.c/d?e#f g": "a g",
    "* * *": "", "a*b": "a b", "*" * 50: "", "a ** \n* b": "a b",
    "\xa0x\xa0": "x", "a\xa0b": "a b", "a\x1c\x1cb": "a b", "a\x85\x85b": "a b", "a  b": "a b", "a\r\nb": "a b",
    "a\n\nb": "a b", "a\nb": "a\nb", "": "", " ": "", None: None, "&notanentity;": "¬anentity;", "&&amp;&": "&&&",
    "You need to enable JavaScript to run this app. Go": ". Go", "x reCAPTCHA check page y": "x y",
}


def test_edges(rows):
    assert dict(zip(CLEANED, rows(list(CLEANED), T.clean_text))) == CLEANED


def test_random_texts(rows):
    """Whatever goes in: no tag, link, star, notice or double blank comes out, and cleaning again changes nothing."""
    random.seed(7)
    parts = ["<", ">", "*", "/", ".", "?", "#", "$", "http://", "https://www.", "\n", "\r", "\xa0",
             "\x1c", "\x85", " ", " ", "  ", "a", "b", "é", "\t", "　", "reCAPTCHA check page"]
    texts = ["".join(random.choices(parts, k=random.randint(0, 25))) for _ in range(4000)]
    once = rows(texts, T.clean_text)
    for text, clean in zip(texts, once):
        assert clean == clean.strip() and "*" not in clean and "\xa0" not in clean, text
        assert not any(a.isspace() and b.isspace() for a, b in zip(clean, clean[1:])), text
        assert "reCAPTCHA check page" not in clean
        kept = [c for c in text if c in "abé"]
        assert [c for c in clean if c in "abé"] == kept or "<" in text or "http" in text or "reCAPTCHA" in text
    plain = [c for c in once if "<" not in c and "http" not in c]
    assert rows(plain, T.clean_text) == plain and len(plain) > 500


def test_many_stars_do_not_overflow(rows):
    assert rows(["a" + "* " * 20_000 + "b"], T.strip_stars) == ["a b"]


def test_strip_keeps_inner_whitespace(rows):
    texts = ["  a \x1f", "\x1c", "a\xa0b", None]
    assert rows(texts, T.strip) == ["a", "", "a\xa0b", None]


def test_eol(rows):
    assert rows(["a\r\nb\nc", None], T.eol_to_space) == ["a  b c", None]


def test_words(rows):
    assert rows(["Äb 1c-d_e", "12", "", None], T.words) == [["äb", "c", "d", "e"], [], [], None]


def test_na_tokens(spark):
    values = [*fixed.NA_TOKENS, "na", "0110", None]
    df = T.na_to_null(spark.createDataFrame([(v, 1) for v in values], "v string, n int"))
    assert [r["v"] for r in df.collect()] == [None] * len(fixed.NA_TOKENS) + ["na", "0110", None]


def test_fallback(spark):
    ads = [
        ("both", "T *", "D  d"), ("null", "T *", None), ("tags", "T *", "<p> </p>"),
        ("no title", None, "D"), ("neither", None, None), ("blank", " ", "<br>"),
    ]
    df = T.clean_ads(spark.createDataFrame(ads, "id string, title string, description string"))
    got = {r["id"]: (r["description"], r["description_clean"], r["title_clean"]) for r in df.collect()}
    assert got == {
        "both": ("D  d", "D d", "T"), "null": ("T *", "T", "T"), "tags": ("<p> </p>", "T", "T"),
        "no title": ("D", "D", None), "neither": (None, None, None), "blank": ("<br>", "", ""),
    }


def test_cleaning_runs_once(spark):
    df = T.clean_ads(spark.createDataFrame([("1", "a", "b")], "id string, title string, description string"))
    plan = df.withColumn("n", F.length("description_clean"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_every_whitespace_character_is_squeezed(rows):
    others = "᠎​⁠﻿_-a0"
    texts = ["x" + c * 3 + "y" for c in fixed.WHITESPACE + others]
    want = ["x y"] * len(fixed.WHITESPACE) + ["x" + c * 3 + "y" for c in others]
    assert rows(texts, T.squeeze_spaces) == want
    assert rows([c + "x" + c for c in fixed.WHITESPACE], T.strip) == ["x"] * len(fixed.WHITESPACE)


def test_word_text_has_the_same_words(rows):
    texts = ["Äb 1c-d_e", "12", "", "áb Σς"]
    assert [t.split() for t in rows(texts, T.word_text)] == rows(texts, T.words)
