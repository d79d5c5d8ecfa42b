import random
from collections import Counter
from itertools import permutations

import pytest

from pontualis.llm import audit

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho".split()


def fails(text):
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {
        "A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words),
        "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text), "D": bool(re.search("[#$%&*|]", text)),
    }


def brute(docs, labels):
    """Every order, applied document by document."""
    good = {i for i, q, _ in labels if q == 1} - {None}
    toxic = {i for i, _, t in labels if t == 1} - {None}
    judged = []
    for i, text, part in docs:
        mine = fails(text or "")
        mine["E"] = i is not None and any(j is not None and j < i and (t or "") == (text or "")
                                          for j, t, _ in docs)
        judged.append((i, part or "", {k for k, v in mine.items() if v}))
    rows, shapley = {}, Counter()
    for part in {p for _, p, _ in judged}:
        for order in permutations("ABCDE"):
            left = [(i, f) for i, p, f in judged if p == part]
            removed_before = []
            for step, letter in enumerate(order, 1):
                here = [(i, f) for i, f in left if letter in f]
                left = [(i, f) for i, f in left if letter not in f]
                rows[part, "".join(order), step] = [
                    len(left), len(here), sum(letter in f for _, f in removed_before),
                    sum(f == {letter} for _, p, f in judged if p == part),
                    sum(i in good for i, _ in here), sum(i in toxic for i, _ in here)]
                removed_before += here
                shapley[part, letter] += len(here)
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in rows.items()}


def table(spark, docs, labels):
    df = spark.createDataFrame(docs, "doc_id long, text string, source string").repartition(3)
    return audit.interactions(audit.combinations(
        df, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")))


@pytest.mark.parametrize("seed", range(2))
def test_against_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(audit, "_DEALT", 3)  # so that copies lie on several keys
    dice = random.Random(seed)

    def text():
        own = [dice.choice(WORDS) + str(dice.randrange(dice.choice([3, 400]))) for _ in range(dice.choice([3, 49, 50, 80]))]
        if dice.random() < 0.3:
            own = [w.upper() if dice.random() < 0.3 else w for w in own]
        if dice.random() < 0.3:
            own.append(dice.choice("#$%&*|"))
        return dice.choice([" ", "\n", " \t"]).join(own)

    texts = [text() for _ in range(20)]
    docs = [(dice.randrange(70), dice.choice(texts), dice.choice(["x", "y", None, ""])) for _ in range(80)]
    docs += [(None, texts[0], "x"), (None, texts[0], "x"), (5, None, "y"), (6, "", "y"), (7, None, None)]
    labels = [(dice.randrange(90), dice.randrange(2), dice.randrange(2)) for _ in range(60)]
    labels += [(None, 1, 1), (3, None, None), (3, 1, None), (3, 0, 1)]
    got = {tuple(r)[:3]: tuple(r)[3:] for r in table(spark, docs, labels).collect()}
    assert got == brute(docs, labels)


def test_hot_copies_are_dealt_and_none_lost(spark):
    docs = [(i, "the same text", "x") for i in range(5000)] + [(i, f"own {i}", "y") for i in range(5000, 5100)]
    rows = table(spark, docs, []).filter("filter_order = 'EABCD' AND step = 1").collect()
    assert {r.part: (r.removed, r.kept, r.shapley) for r in rows} == {
        "x": (4999, 1, 4999 * 60), "y": (0, 100, 0)}


def test_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    counts = audit.combinations(odd, labels)
    assert counts.agg({"n": "sum"}).first()[0] == odd.count()
    assert audit.interactions(audit.combinations(empty, labels)).count() == 0
