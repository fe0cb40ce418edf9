import random

from jobweave import fixed
from jobweave.functions import sections as S

FULL = ["description", "tasks", "examples"]
T1, T2 = fixed.TASK_HEADINGS[:2]
E1, E2 = fixed.EXAMPLE_HEADINGS


def test_edges(rows):
    cases = {
        "only text\nmore": "only text",
        f"d\n{T1}\n(a) x\n(b) y\nz": f"d\n{T1}\n(a) x\n(b) y",
        f"d\n{E1}\n- x\n": "d",
        f"d\n{T1}\n(a)\n{E2}\n- x\ny\n- z": f"d\n{T1}\n(a)\n{E2}\n- x",
        f"d\n{T2}\n(later)\n{T1}\n(first)": f"d\n{T1}\n(first)",
        f"d\n{T1}\n(a)\n\n(b)": f"d\n{T1}\n(a)",
        f"d\n  {T1} \n  (a) ": f"d\n{T1}\n(a)",
        f"d\n{T1}": f"d\n{T1}",
        "": "",
    }
    assert rows(list(cases), lambda c: S.extract_info(c, FULL)) == list(cases.values())


def test_random_texts(rows):
    """What is shown are lines of the text: the first, then headings in their order, each with the items below it."""
    random.seed(3)
    parts = [*fixed.TASK_HEADINGS, *fixed.EXAMPLE_HEADINGS, "(a) x", "- y", "", "z", " (b)", "\t- w", T1 + " "]
    texts = ["\n".join(random.choices(parts, k=random.randint(1, 9))) for _ in range(2000)]
    full = rows(texts, lambda c: S.extract_info(c, FULL))
    first = rows(texts, lambda c: S.extract_info(c, ["description"]))
    for text, shown, line in zip(texts, full, first):
        lines = [x.strip() for x in text.split("\n")]
        assert line == lines[0]
        head, *rest = shown.split("\n")
        assert head == line
        sign, above = None, None
        for item in rest:
            if item in (*fixed.TASK_HEADINGS, *fixed.EXAMPLE_HEADINGS) and not (sign and item.startswith(sign)):
                sign, above = ("(" if item in fixed.TASK_HEADINGS else "-"), item
            else:
                assert sign and item.startswith(sign), text
            assert item in lines
        has_tasks = any(h in lines for h in fixed.TASK_HEADINGS)
        assert bool(rest) == has_tasks, text
        if has_tasks:
            assert rest[0] == next(h for h in fixed.TASK_HEADINGS if h in lines)
            wanted = next((h for h in fixed.EXAMPLE_HEADINGS if h in lines), None)
            assert (wanted in rest) == (wanted is not None) and (above is None or above in lines)


def test_null_text(rows):
    assert rows([None], lambda c: S.extract_info(c, FULL)) == [None]


def test_keywords(rows):
    lists = [None, [], ["a"], ["a", "b c"]]
    assert rows(lists, S.keywords_text, "array<string>") == [None, "", "a", "a, b c"]


def test_format_hits(rows):
    hits = [[("0110", "L", "i"), ("1", None, "j\nk")], []]
    kind = "array<struct<code:string,label:string,info:string>>"
    assert rows(hits, S.format_hits, kind) == ["0110: L - i\n\n1: None - j\nk", ""]
