import glob

import pandas as pd
import pytest
from pyspark.sql import functions as F

from jobweave.config import JobConfig, Sampling
from jobweave.operators.generation import AnswerStore, generate, usable_profile
from jobweave.operators.language import train_profile
from jobweave.operators.report import outcome_report
from jobweave.operators.retrieval import build_label_index
from jobweave.plans import stages
from jobweave.sources.tables import read_stage
from tests.standins import answer_classification, frequent_words, offline_classifier, offline_translator

CONFIG = JobConfig(dimensions=64)
TEXTS = {"en": "the nurse and the doctor care for people", "de": "der fahrer und die ärztin fahren das auto",
         "fr": "la infirmière et le médecin dans une maison"}


@pytest.fixture(scope="module")
def profile(spark):
    return train_profile(
        spark.createDataFrame([(t, lang) for lang, t in TEXTS.items()], "text string, lang string")
    ).cache()


@pytest.fixture
def paths(tmp_path):
    ads = pd.DataFrame(
        [{"id": f"{i:02d}", "title": t, "description": t, "extra": "x"}
         for i, t in enumerate(list(TEXTS.values()) * 4)]
        + [{"id": "90", "title": "the nurse", "description": None, "extra": "x"},
           {"id": "91", "title": None, "description": None, "extra": None},
           {"id": "92", "title": "zz", "description": "<p>the doctor</p>", "extra": ""}]
    )
    ads.to_csv(tmp_path / "ads.csv", index=False)
    labels = pd.DataFrame(
        [{"code": "2221", "label": "Nurses", "description": "Nurses care for people"},
         {"code": "8322", "label": "Drivers", "description": "fahrer fahren das auto"}]
    )
    labels.to_csv(tmp_path / "labels.csv", index=False)
    names = ("detected", "translated", "index", "prompts", "predicted", "submission")
    return stages.Paths(
        str(tmp_path / "ads.csv"), str(tmp_path / "labels.csv"), *(str(tmp_path / n) for n in names)
    )


LANGUAGES = ["en", "de", "fr", "un"]


def codes(spark):
    return spark.createDataFrame([("2221",), ("8322",)], "code string")


def submitted(paths):
    lines = "".join(open(p).read() for p in sorted(glob.glob(paths.submission + "/part-*"))).splitlines()
    return dict(line.split(",") for line in lines)


def test_all_stages(spark, paths, profile, capsys):
    def run():
        stages.run_all(
            spark, paths, offline_translator, offline_classifier, LANGUAGES, codes(spark), profile=profile, config=CONFIG
        )

    run()
    detected = {r["id"]: r["lang"] for r in read_stage(spark, paths.detected).collect()}
    assert len(detected) == 15
    assert [detected[f"{i:02d}"] for i in range(3)] == ["en", "de", "fr"]
    assert detected["90"] == "en" and detected["91"] == "un"
    predicted = read_stage(spark, paths.predicted)
    assert predicted.count() == 15
    assert {"extra", "score", "title_en", "keywords", "prompt", "label_code", "raw_responses"} <= set(predicted.columns)
    first = submitted(paths)
    assert len(first) == 15 and first["01"] == "8322" and first["00"] == "2221"
    run()  # a second run replaces the first and adds nothing
    assert submitted(paths) == first
    assert read_stage(spark, paths.predicted).count() == 15
    stages.run_classify(spark, paths, ["sv"], offline_classifier, codes(spark), config=CONFIG)
    assert "nothing to do for sv" in capsys.readouterr().out


def test_shards_give_what_one_run_gives(spark, paths, profile):
    stages.run_detect(spark, paths, profile, config=CONFIG)
    for shard in (1, 2, 3):
        stages.run_translate(
            spark, paths, "title_clean", "description_clean", LANGUAGES, offline_translator, shard, CONFIG
        )
    sharded = read_stage(spark, paths.translated)
    assert sharded.count() == 15 and sharded.select("id").distinct().count() == 15
    stored = spark.read.parquet(paths.translated).groupBy("shard").count().collect()
    assert {r["shard"]: r["count"] for r in stored} == {"1-of-3": 5, "2-of-3": 5, "3-of-3": 5}


def test_detect_overrides(spark, paths, profile):
    overrides = spark.createDataFrame([("00", TEXTS["de"])], "id string, description string")
    stages.run_detect(spark, paths, profile, overrides=overrides, config=CONFIG)
    assert read_stage(spark, paths.detected).where("id = '00'").first()["lang"] == "de"


def test_each_prompt_is_answered_once(spark, tmp_path):
    log = tmp_path / "calls"
    log.mkdir()

    def backend():
        import uuid

        def answer(prompts: pd.Series) -> pd.Series:
            (log / uuid.uuid4().hex).write_text(str(len(prompts)))
            return prompts.map(lambda p: uuid.uuid4().hex)

        return answer

    df = spark.createDataFrame([(i, f"p{i % 3}") for i in range(90)] + [(99, "one two three")], "id int, p string")
    done = generate(df, "p", "a", backend, Sampling(context_tokens=3, max_tokens=1))
    first = {r["id"]: r["a"] for r in done.collect()}
    assert sum(int(f.read_text()) for f in log.iterdir()) == 3
    assert len(first) == 91 and len(set(first.values()) - {None}) == 3 and first[99] is None
    assert {r["id"]: r["a"] for r in done.collect()} == first  # reading again does not ask again


def counting(log, broken=None):
    """A backend that writes down what it was asked."""

    def backend():
        import uuid

        def answer(prompts: pd.Series) -> pd.Series:
            if broken in set(prompts):
                raise RuntimeError("the model broke down")
            (log / uuid.uuid4().hex).write_text("\n".join(prompts))
            return prompts.map(lambda p: f"<{p}>")

        return answer

    return backend


def asked(log):
    return sorted(p for f in log.iterdir() for p in f.read_text().splitlines())


def test_answers_survive_a_failing_run(spark, tmp_path):
    df = spark.createDataFrame([(i, f"p{i % 20}") for i in range(60)], "id int, p string")
    store = AnswerStore(str(tmp_path / "answers"), batch=3)
    logs = [tmp_path / name for name in "abcd"]
    for log in logs:
        log.mkdir()
    with pytest.raises(Exception, match="broke down"):
        generate(df, "p", "a", counting(logs[0], broken="p7"), store=store)
    kept = store.read(spark).count()
    assert 0 < kept < 20
    done = generate(df, "p", "a", counting(logs[1]), store=store)
    assert {(r["p"], r["a"]) for r in done.collect()} == {(f"p{i}", f"<p{i}>") for i in range(20)}
    assert len(asked(logs[1])) == 20 - kept and "p7" in asked(logs[1])
    more = df.union(spark.createDataFrame([(99, "new"), (98, None)], "id int, p string"))
    answers = {r["id"]: r["a"] for r in generate(more, "p", "a", counting(logs[2]), store=store).collect()}
    assert asked(logs[2]) == ["new"] and answers[99] == "<new>" and answers[98] is None and len(answers) == 62
    generate(df, "p", "a", counting(logs[3]), Sampling(temperature=0.9), store=store)  # other settings, other answers
    assert len(asked(logs[3])) == 20


def test_a_leftover_of_a_broken_write_is_not_read(spark, tmp_path):
    store = AnswerStore(str(tmp_path / "answers"))
    assert store.read(spark).count() == 0
    store.add(spark.createDataFrame([("k", "b"), ("n", None)], "key string, answer string"))
    store.add(spark.createDataFrame([("k", "a")], "key string, answer string"))
    spark.createDataFrame([("x", "y")], "key string, answer string").write.parquet(f"{store.path}/_new-broken")
    assert {tuple(r) for r in store.read(spark).collect()} == {("k", "a"), ("n", None)}


def test_answers_of_a_given_table(spark):
    df = spark.createDataFrame([(1, "x"), (2, "x"), (3, "y"), (4, None), (5, "one two three four")], "id int, p string")
    given = spark.createDataFrame([("x", "b"), ("x", "a"), ("one two three four", "c")], "prompt string, answer string")
    done = generate(df, "p", "a", given, Sampling(context_tokens=4, max_tokens=1), too_long="long")
    assert {(r["id"], r["a"], r["long"]) for r in done.collect()} == {
        (1, "a", False), (2, "a", False), (3, None, False), (4, None, False), (5, None, True)}


def test_prompts_are_rendered_once(spark, tmp_path):
    log = tmp_path / "rendered"
    log.mkdir()

    @F.udf("string")
    def rendered(x):
        import uuid

        (log / uuid.uuid4().hex).write_text("x")
        return f"p{x % 5}"

    df = spark.range(20).withColumn("p", rendered.asNondeterministic()("id"))
    assert generate(df, "p", "a", lambda: lambda prompts: prompts).where("a = p").count() == 20
    assert len(list(log.iterdir())) == 20


def test_resources_are_asked_where_the_master_has_them(spark):
    from pyspark.resource import ResourceProfileBuilder, TaskResourceRequests

    gpu = ResourceProfileBuilder().require(TaskResourceRequests().resource("gpu", 1)).build
    assert usable_profile("local[4]", gpu) is None and usable_profile("yarn", gpu) is gpu
    assert usable_profile("k8s://host", None) is None
    asked_with = []

    class Prompts:
        sparkSession = type("S", (), {"sparkContext": type("C", (), {"master": "yarn"})})

        def select(self, *columns):
            return self

        def mapInPandas(self, work, schema, profile):
            asked_with.append(profile)

    from jobweave.operators.generation import _answered

    _answered(Prompts(), lambda: None, Sampling(), gpu)
    assert asked_with == [gpu]
    df = spark.createDataFrame([(1, "x")], "id int, p string")
    assert generate(df, "p", "a", lambda: lambda prompts: prompts, resources=gpu).first()["a"] == "x"


def test_sampling_reaches_the_backend_and_long_prompts_are_told(spark):
    def backend(sampling):
        return lambda prompts: prompts.map(lambda p: f'{{"codable":true,"likelihood":{sampling.temperature}}}')

    config = JobConfig(sampling=Sampling(temperature=0.75, context_tokens=4, max_tokens=1))
    prompts = spark.createDataFrame([("1", "en", "a b"), ("2", "en", "a b c d")], "id string, lang string, prompt string")
    labels = spark.createDataFrame([("2221", "Nurses", 0)], "code string, label string, pos int")
    got = {r["id"]: (r["raw_responses"], r["outcome"])
           for r in stages.classify_stage(prompts, labels, backend, codes(spark), config).collect()}
    assert got == {"1": ('{"codable":true,"likelihood":0.75}', "invalid_code"), "2": (None, "too_long")}


def test_row_local_stages_do_not_shuffle(spark, paths, profile):
    ads = spark.createDataFrame([("1", "the nurse", "care")], "id string, title string, description string")
    detected = stages.detect_stage(ads, profile)
    labels = spark.createDataFrame([("2221", "Nurses", "care", 0)], "code string, label string, description string, pos int")
    index = build_label_index(labels, CONFIG)
    asked = ads.withColumn("keywords", F.array(F.lit("care")))
    prompted = stages.prompt_stage(asked, index, "title", "description", config=CONFIG)
    for df in (detected, prompted, stages.translation_prompts(detected, "title", "description")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == plan.count("BroadcastExchange")


def test_stand_ins():
    assert frequent_words("bbbb aaaa bbbb cc dddd eeee ffff gggg") == ["bbbb", "aaaa", "dddd", "eeee", "ffff"]
    assert answer_classification("nothing") == '{"codable": false, "class_code": null, "likelihood": null}'


def test_outcomes(spark):
    df = spark.createDataFrame([("en", "ok"), ("en", "ok"), ("de", "parse_error")], "lang string, outcome string")
    assert {tuple(r) for r in outcome_report(df).collect()} == {("en", "ok", 2), ("de", "parse_error", 1)}


def test_needs_one_detector(spark):
    with pytest.raises(ValueError):
        stages.detect_stage(spark.range(1).select(F.lit("1").alias("id")))


def test_outcomes_are_counted_by_the_write(spark, tmp_path):
    from jobweave.operators.report import Counted
    from jobweave.sources.tables import write_stage

    rows = [("en", "ok"), ("en", "ok"), ("en", "too_long"), ("de", "parse_error"), ("xx", "ok"), (None, "invalid_code")]
    df = spark.createDataFrame(rows, "lang string, outcome string")
    counted = Counted(["en", "de", "fr"])
    write_stage(counted.watch(df), str(tmp_path / "t"), ["lang"])
    assert {tuple(r) for r in counted.report(df).collect()} == {
        ("en", "ok", 2), ("en", "too_long", 1), ("de", "parse_error", 1), (None, "ok", 1), (None, "invalid_code", 1)}


def test_an_incomplete_set_is_not_submitted(spark, tmp_path):
    from jobweave.sources.tables import write_stage

    path = str(tmp_path / "predicted")
    paths = stages.Paths("", "", "", "", "", "", path, str(tmp_path / "out"))
    rows = spark.createDataFrame(
        [("1", "en", True, True, "2221")], "id string, lang string, job_desc_extracted boolean, codable boolean, class_code string")
    levels = ["lang", "job_desc_extracted", "codable"]
    write_stage(rows, path, levels, (1, 2), ["en"])
    with pytest.raises(ValueError, match="en: 2-of-2"):
        stages.run_submission(spark, paths)
    stages.run_submission(spark, paths, incomplete=True)
    assert submitted(paths) == {"1": "2221"}
    write_stage(rows.limit(0), path, levels, (2, 2), ["en"])
    stages.run_submission(spark, paths)
    assert submitted(paths) == {"1": "2221"}


def test_answers_need_no_context(spark, tmp_path):
    from checks.queries import generate_offline, generate_resumed

    long = "nurse " * 12_000
    df = spark.createDataFrame([(1, long), (2, "one two")], "id int, p string")
    unbounded = Sampling(context_tokens=None)
    given = df.select(F.col("p").alias("prompt"), F.col("id").cast("string").alias("answer"))
    for backend in (given, lambda: lambda prompts: prompts.map(lambda p: "1" if len(p) > 9 else "2")):
        done = generate(df, "p", "a", backend, unbounded, too_long="long")
        assert {(r["id"], r["a"], r["long"]) for r in done.collect()} == {(1, "1", False), (2, "2", False)}
    documents = spark.createDataFrame(
        [(i, f"title {i}\ncare work", "en") for i in range(12)] + [(99, long, "en"), (100, long, "en")],
        "doc_id long, text string, lang string")
    documents.write.parquet(f"{tmp_path}/documents.parquet")
    assert generate_offline(spark, str(tmp_path)).where("parsed").count() == 14
    row = generate_resumed(spark, str(tmp_path)).first()
    assert (row["n"], row["right"], row["answers"]) == (14, 14, 13)
