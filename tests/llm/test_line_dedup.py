import random

import pytest
from pyspark.sql import functions as F

from jobweave.llm import line_dedup
from jobweave.llm.edit_distance import within


def distance(a, b):
    above = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            row.append(min(above[j] + 1, row[-1] + 1, above[j - 1] + (x != y)))
        above = row
    return above[-1]


@pytest.mark.parametrize("most", [1, 2, 3])
def test_edit_distance(most):
    rng = random.Random(most)
    left, right = [], []
    for _ in range(3000):
        a = "".join(rng.choice("abé") for _ in range(rng.randint(0, 16)))
        b = list(a)
        for _ in range(rng.randint(0, 5)):
            place = rng.randint(0, len(b))
            b[place : place + rng.randint(0, 1)] = rng.choice(["", "a", "z"])
        left.append(a)
        right.append("".join(b))
    assert within(left, right, most).tolist() == [distance(a, b) <= most for a, b in zip(left, right)]


def cut_by_hand(rows, most, least):
    seen, out = [], {}
    for key, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        kept = []
        for line in (text or "").split("\n"):
            if not line.strip():
                kept.append(line)
                continue
            if len(line) < least:
                if line not in seen:
                    kept.append(line)
            elif not any(len(s) >= least and abs(len(line) - len(s)) <= most and distance(line, s) <= most for s in seen):
                kept.append(line)
            if line not in seen:
                seen.append(line)
        out[key] = None if text is None else "\n".join(kept)
    return out


def documents():
    rng = random.Random(4)
    lines = ["".join(rng.choice("abcdé ") for _ in range(rng.randint(18, 40))) for _ in range(25)]
    rows = []
    for key in range(60):
        own = []
        for _ in range(rng.randint(0, 5)):
            line = list(rng.choice(lines))
            for _ in range(rng.choice([0, 0, 1, 2, 3])):
                place = rng.randint(0, len(line) - 1)
                line[place : place + rng.randint(0, 1)] = rng.choice(["", "x", "y"])
            own.append("".join(line))
        rows.append((key, "\n".join([*own, rng.choice(["short", "shore", "short ", "%", " \t"]), ""])))
    return rows + [(None, lines[0]), (900, None), (901, ""), (902, "\n\n"), (903, lines[3] + "\n" + lines[3])]


@pytest.mark.parametrize("listed", [2, 64])
def test_like_brute_force(spark, listed, monkeypatch):
    monkeypatch.setattr(line_dedup, "LISTED", listed)
    monkeypatch.setattr(line_dedup, "BLOCK", 4)
    rows = documents()
    df = spark.createDataFrame([(k, t, "x", 0) for k, t in rows], "doc_id long, text string, N_LINES string, at int")
    got = line_dedup.drop_repeated_lines(df.repartition(4), most=2, least_chars=20)
    wanted = cut_by_hand(rows, 2, 20)
    given = dict(rows)
    assert got.columns == ["doc_id", "text", "at", "n_lines", "n_removed"]
    for r in got.collect():
        assert r["text"] == wanted[r["doc_id"]], r["doc_id"]
        before = given[r["doc_id"]]
        assert r["n_lines"] == (0 if before is None else before.count("\n") + 1)


def test_edges(spark):
    schema = "doc_id long, text string"
    assert line_dedup.drop_repeated_lines(spark.createDataFrame([], schema)).count() == 0
    line = "a line of enough characters"
    rows = [(1, line), (1, line), (2, line), (2, f"other text\n{line}"), (3, "w" * 200_000), (4, "w" * 200_001)]
    got = line_dedup.drop_repeated_lines(spark.createDataFrame(rows, schema)).orderBy("doc_id", F.length("text")).collect()
    assert [r["text"] for r in got[:2]] == [line, line]  # rows that repeat both are one document
    assert sorted(r["text"] for r in got[2:4]) == ["", "other text"]
    assert len(got[4]["text"]) == 200_000 and got[5]["text"] == ""
    with pytest.raises(ValueError):
        line_dedup.drop_repeated_lines(spark.createDataFrame([], schema), most=2, least_chars=4)
