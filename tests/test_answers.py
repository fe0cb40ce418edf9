import math

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from jobweave.functions.answers import parse_classification, parse_translation
from jobweave.operators.coding import read_classifications, submission

BROKEN = {"parsed": False, "codable": False, "class_code": None, "likelihood": None}


def good(codable=True, code="0110", likelihood=0.5):
    return {"parsed": True, "codable": codable, "class_code": code, "likelihood": likelihood}


CLASSIFICATION = {
    '{"codable":true,"class_code":"0110","likelihood":0.5}': good(),
    '  {"codable":true,"class_code":"0110","likelihood":0.5}\n': good(),
    '```json\n{"codable":true,"class_code":"0110","likelihood":0.5}\n```': good(),
    'Sure:\n```\n{"codable":true,"class_code":"0110","likelihood":0.5}\n```\nbye': good(),
    'text {"codable":true,"class_code":"0110","likelihood":0.5}': BROKEN,
    '{"codable":true,"class_code":"0110","likelihood":0.5} text } {': good(),
    '{"codable":true,"class_code":"0110","likelihood":0.5': good(),
    '{"codable":true,"likelihood":0.5,"class_code":"01': good(code="01"),
    '{"codable":true,"class_code":"0110","likelihood":': good(likelihood=None),
    '{"codable":true,"class_code":"01\n10","likelihood":0.5}': good(code="01\n10"),
    '```json\n{"codable":true,"class_code":"0110","likelihood":0.5}\nbye': good(),
    '```\n{"codable":true,"class_code":"0110","likelihood":0.5': good(),
    '{"codable":true]': BROKEN,
    '{"codable":true,"class_code":"0110","likelih': BROKEN,
    "": BROKEN,
    None: BROKEN,
    "[1]": BROKEN,
    "null": BROKEN,
    '{"codable":true,"class_code":"0110"}': BROKEN,
    '{"codable":true,"likelihood":0.5}': good(code=None),
    '{"codable":true,"class_code":null,"likelihood":null}': good(code=None, likelihood=None),
    '{"codable":"yes","class_code":"0110","likelihood":0.5}': good(),
    '{"codable":"OFF","class_code":"0110","likelihood":0.5}': good(codable=False),
    '{"codable":1,"class_code":"0110","likelihood":0.5}': good(),
    '{"codable":0,"class_code":"0110","likelihood":0.5}': good(codable=False),
    '{"codable":2,"class_code":"0110","likelihood":0.5}': BROKEN,
    '{"codable":0.5,"class_code":"0110","likelihood":0.5}': BROKEN,
    '{"codable":null,"class_code":"0110","likelihood":0.5}': BROKEN,
    '{"codable":"1.0","class_code":"0110","likelihood":0.5}': BROKEN,
    '{"codable":" true","class_code":"0110","likelihood":0.5}': BROKEN,
    '{"codable":true,"class_code":110,"likelihood":0.5}': BROKEN,
    '{"codable":true,"class_code":{"code":"0110"},"likelihood":0.5}': BROKEN,
    '{"codable":true,"class_code":["0110"],"likelihood":0.5}': BROKEN,
    '{"codable":true,"class_code":"0110","likelihood":"0.9"}': good(likelihood=0.9),
    '{"codable":true,"class_code":"0110","likelihood":" 1e-1 "}': good(likelihood=0.1),
    '{"codable":true,"class_code":"0110","likelihood":7.5}': good(likelihood=7.5),
    '{"codable":true,"class_code":"0110","likelihood":1}': good(likelihood=1.0),
    '{"codable":true,"class_code":"0110","likelihood":true}': good(likelihood=1.0),
    '{"codable":true,"class_code":"0110","likelihood":"inf"}': good(likelihood=math.inf),
    '{"codable":true,"class_code":"0110","likelihood":"abc"}': BROKEN,
    '{"codable":true,"class_code":"0110","likelihood":"1d"}': BROKEN,
    '{"codable":true,"class_code":"0110","likelihood":""}': BROKEN,
    '{"codable":true,"class_code":"0110","likelihood":[1]}': BROKEN,
    '{"codable":true,"class_code":"0110","likelihood":0.5,"more":{"x":[1]}}': good(),
}


def test_classification(rows):
    got = rows(list(CLASSIFICATION), parse_classification)
    assert dict(zip(CLASSIFICATION, got)) == CLASSIFICATION


def test_objects_as_text(rows):
    raw = '{"codable":true,"class_code":{"code":"0110"},"likelihood":0.5}'
    assert rows([raw], lambda c: parse_classification(c, coerce_objects=True)) == [good(code='{"code":"0110"}')]


def test_translation(rows):
    def answer(keywords, rest='"title":"t","description":null'):
        return f'{{"job_desc_extracted":true,{rest},"keywords":{keywords}}}'

    fine = {"parsed": True, "job_desc_extracted": True, "title": "t", "description": None}
    broken = {"parsed": False, "job_desc_extracted": False, "title": None, "description": None, "keywords": None}
    cases = [
        (answer('["a","b"]'), {**fine, "keywords": ["a", "b"]}),
        (answer("[]"), {**fine, "keywords": []}),
        (answer("null"), {**fine, "keywords": None}),
        (answer('["a",1]'), broken),
        (answer('["a",null]'), broken),
        (answer('"a"'), broken),
        (answer("[]", '"title":"t"'), broken),
        (answer("[]", '"title":{"en":"t"},"description":null'), broken),
        (answer("[]", '"title":3,"description":null'), broken),
        ("no json", broken),
    ]
    assert rows([raw for raw, _ in cases], parse_translation) == [want for _, want in cases]


def test_any_text_gives_a_result(spark):
    texts = []

    @settings(max_examples=300, database=None)
    @given(st.text(alphabet='{}[]":,`jsontrue0123. \n\\u', max_size=60))
    def collect(text):
        texts.append(text)

    collect()
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    parsed = df.select(
        parse_classification(F.col("v"))["codable"].alias("a"),
        parse_translation(F.col("v"))["job_desc_extracted"].alias("b"),
    )
    assert parsed.where("a is null or b is null").count() == 0


LABELS = [("0110", "first", 0), ("0110", "second", 1), ("0210", "other", 2), ("02", "group", 3)]
ANSWERS = [
    ("valid", '{"codable":true,"class_code":"0110","likelihood":0.5}'),
    ("unsure", '{"codable":false,"class_code":"0210","likelihood":0.1}'),
    ("unknown", '{"codable":true,"class_code":"9999","likelihood":0.5}'),
    ("group", '{"codable":true,"class_code":"02","likelihood":0.5}'),
    ("none", '{"codable":true,"class_code":null,"likelihood":0.5}'),
    ("broken", "?"),
    ("unlabelled", '{"codable":true,"class_code":"0310","likelihood":0.5}'),
]


def coded(spark, codes=None):
    labels = spark.createDataFrame(LABELS, "code string, label string, pos int")
    answers = spark.createDataFrame(ANSWERS, "id string, raw_responses string")
    return read_classifications(answers, labels, codes=codes)


def test_response_handling(spark):
    codes = spark.createDataFrame([("0110",), ("0210",), ("0310",)], "code string")
    fields = ("codable", "class_code", "likelihood", "label_code", "outcome")
    got = {r["id"]: tuple(r[f] for f in fields) for r in coded(spark, codes).collect()}
    assert got == {
        "valid": (True, "0110", 0.5, "first", "ok"),
        "unsure": (False, "0210", 0.1, "other", "ok"),
        "unknown": (False, "9999", None, None, "invalid_code"),
        "group": (False, "02", None, None, "invalid_code"),
        "none": (False, None, None, None, "invalid_code"),
        "broken": (False, None, None, None, "parse_error"),
        "unlabelled": (True, "0310", 0.5, None, "ok"),
    }


def test_codes_come_from_the_labels(spark):
    outcome = {r["id"]: r["outcome"] for r in coded(spark).collect()}
    assert outcome["valid"] == outcome["unsure"] == "ok"
    assert outcome["group"] == outcome["unlabelled"] == "invalid_code"


def test_submission(spark):
    plain = {r["id"]: r["class_code"] for r in submission(coded(spark)).collect()}
    assert plain == {"valid": "0110", "unsure": None, "unknown": None, "group": None, "none": None,
                     "broken": None, "unlabelled": None}
    kept = {r["id"]: r["class_code"] for r in submission(coded(spark), compat=True).collect()}
    assert kept["unsure"] == "0210" and kept["unknown"] == "9999"
