import random

import pytest

from pontualis.llm import lines


def brute(docs, min_words=5):
    """Texts without the maximal runs, of any number of lines, that occurred before."""
    order = sorted((d for d in docs if d[1] is not None), key=lambda d: d[0])
    numbered = {i: [(k, x) for k, x in enumerate(t.split("\n")) if x.split()] for i, t in order}
    gone = {i: set() for i, _ in order}
    for length in range(1, max((len(x) for x in numbered.values()), default=0) + 1):
        seen = set()
        for i, _ in order:
            own = numbered[i]
            for k in range(len(own) - length + 1):
                run = tuple(x for _, x in own[k:k + length])
                if run in seen and sum(len(x.split()) for x in run) >= min_words:
                    gone[i] |= {n for n, _ in own[k:k + length]}
                seen.add(run)
    return {i: "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[i]) for i, t in order}


@pytest.mark.parametrize("seed", range(3))
def test_against_brute_force(spark, seed):
    dice = random.Random(seed)
    pool = ["a b c d e f", "one", "two words", "", "  ", "three more words", "x y z v", "last"]
    docs = [(i, "\n".join(dice.choice(pool) if dice.random() < 0.6 else f"own line {dice.random()}"
                          for _ in range(dice.randrange(12)))) for i in range(40)]
    docs[7] = (7, docs[3][1])
    docs[8] = (8, "\n".join(["k", "m", "n", "o", "p", *docs[5][1].split("\n")]))
    docs[9] = (9, "\n".join(["q", "k", "m", "n", "o", "p", "end of this"]))
    df = spark.createDataFrame([*docs, (99, None)], "doc_id long, text string").repartition(3)
    got = {r.id: r.text for r in lines.dedup_lines(df).collect()}
    assert got == {**brute(docs), 99: None}


@pytest.mark.parametrize("min_words", [1, 2, 3, 4, 6, 7, 9])
def test_other_bounds(spark, min_words):
    dice = random.Random(min_words)
    docs = [(i, "\n".join(dice.choice(["a", "b", "c d", "e f g", "h"]) for _ in range(dice.randrange(9))))
            for i in range(25)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = {r.id: r.text for r in lines.dedup_lines(df, min_words=min_words).collect()}
    assert got == brute(docs, min_words)


def test_runs_of_few_short_lines(spark):
    docs = [(1, "a b\nc d\ne f\nown one"), (2, "first own\na b\nc d\ne f"), (3, "k\nl\nm\nn\no"),
            (4, "x\nk\nl\nm\nn\no\ny"), (5, "k\nl\nm\nn")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.id: r.text for r in lines.dedup_lines(df).collect()}
    assert got[2] == "first own" and got[4] == "x\ny" and got[5] == "k\nl\nm\nn"


def test_long_runs_and_repeats(spark):
    page = "\n".join(f"l{i}" for i in range(300))
    docs = [(1, page), (2, f"new first\n{page}\nnew last"), (3, "r r r r r\n" * 200)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.id: r for r in lines.dedup_lines(df).collect()}
    assert got[2].text == "new first\nnew last" and len(got[2].deleted) == 300
    assert got[1].text == page and got[1].n_lines == 300
    assert got[3].text == "r r r r r\n" and len(got[3].deleted) == 199


def test_odd_rows(odd, empty):
    rows = lines.dedup_lines(odd).collect()
    assert len(rows) == odd.count()
    got = {(r.id, r.text) for r in rows}
    assert {(1, None), (2, ""), (3, " \t\n "), (None, None)} <= got
    # The row without identifier comes first, so 10 is the later copy; the line of 6 returns in 12,
    # and its short last line with it.
    assert (None, "a b c d e f g h i j k l m n o p q r s t u v w x y z") in got and (10, "") in got
    assert (12, "another line of some words here") in got
    assert lines.dedup_lines(empty).count() == 0
