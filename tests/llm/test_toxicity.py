import re
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pontualis.llm import toxicity
from pontualis.llm.queries import QUERIES


def patterns(text, **changes):
    model = toxicity.Model(toxicity.INSULTS, ("lowei",), dict(toxicity.PRIORS), 0.02)
    return dict(model.finder()(text)), model


@pytest.mark.parametrize("text, found", [
    ("An idiot.", {"insult": 1}),
    ("You are such an IDIOT! Stupid.", {"insult+target": 1, "insult": 1}),
    ("This is not at all stupid.", {"not-insult": 1}),
    ("This is not, in any sense that matters, stupid.", {"insult": 1}),
    ("The minister called the plan stupid.", {"said-insult": 1}),
    ("He said it was fine. Trash.", {"insult": 1}),
    ("I will kill time", {"threat": 1}),
    ("You I kill", {"threat+target": 1}),
    ("never kill", {"not-threat": 1}),
    ("Idiotic idioms", {}), ("antistupid", {}), ("loweisp und Loweix", {"insult": 2}),
    ("", {}), (None, {}),
])
def test_patterns(text, found):
    assert patterns(text)[0] == found


def by_clauses(text, insults, stems):
    """Patterns of a text, clause by clause and word by word, from their definition."""
    found = Counter()
    for clause in re.split(r"[.!?;:\n]", (text or "").lower()):
        words = re.findall(r"[^\W_]+", clause)

        def kind(word):
            if word in insults or any(word.startswith(s) for s in stems):
                return "insult"
            return next((name for name, some in (
                ("threat", toxicity.THREATS), ("target", toxicity.TARGETS), ("negation", toxicity.NEGATIONS),
                ("report", toxicity.REPORTS)) if word in some), "other")

        kinds = [kind(w) for w in words]
        for i, k in enumerate(kinds):
            if k not in ("insult", "threat"):
                continue
            if "negation" in kinds[max(0, i - 3):i]:
                pattern = f"not-{k}"
            elif "report" in kinds[:i]:
                pattern = f"said-{k}"
            elif "target" in kinds[max(0, i - 5):i]:
                pattern = f"{k}+target"
            else:
                pattern = k
            found[pattern] += pattern in toxicity.PRIORS
    return +found


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(
    st.sampled_from(["idiot", "Stupid", "kill", "you", "they", "not", "never", "said", "called", "lowei", "loweix",
                     "alowei", "plan", "and", "killer", "é", "idiot_kill", "x2", "trash"]),
    st.sampled_from([" ", " ", " ", ", ", ". ", "!", ";\n", "-", "'", "_"])), max_size=25))
def test_patterns_against_brute_force(parts):
    text = "".join(word + gap for word, gap in parts)
    assert patterns(text)[0] == by_clauses(text, toxicity.INSULTS, ("lowei",))


def test_the_cascade_is_one_machine():
    machine = toxicity.grammar()
    assert machine.run(["report", "other", "negation", "insult"])[-1] == "said-not-insult" or \
        machine.run(["report", "other", "insult"])[-1] == "said-insult"
    assert set(machine.outputs()) & set(toxicity.PRIORS)
    # Every symbol is accepted in every state.
    states = {s for s, _ in machine.arcs}
    assert len(machine.arcs) == len(states) * len(toxicity.SYMBOLS)


def test_scores():
    _, model = patterns("")
    score = lambda t: model.chance(model.finder()(t))
    assert score("nothing") == pytest.approx(0.02)
    assert score("you idiot") > score("idiot") > score("not stupid") > score("nothing")
    assert score("idiot. " * 50) <= 1


def test_learns_words_and_stems(spark):
    fill = "some words of plain text number {} and {} more"
    rows = [(i, fill.format(i, i * 7), 0) for i in range(300)]
    rows += [(300 + i, fill.format(i, -i) + (" zorp" if i % 2 else f" gnax{chr(97 + i % 20)}ing"), 1)
             for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.train(df.select("doc_id", "text"), df.select("doc_id", "toxic"))
    assert "zorp" in model.words
    assert any("gnax".startswith(s) or s.startswith("gnax") for s in model.stems)
    new = spark.createDataFrame([(1, "a zorp here"), (2, "gnaxzzing"), (3, "plain text"), (4, None)],
                                "doc_id long, text string")
    got = {r.doc_id: r.a.score for r in toxicity.score(new, model, "a").collect()}
    assert got[1] > 0.8 and got[2] > 0.8 and got[3] < 0.1 and got[4] == got[3]


def test_counts_of_all_tasks_add_up(spark):
    # Of the texts with "commonly", 22 are toxic and 15 are not, each of those in another task.
    rows = [(1, f"plain{i} commonly") for i in range(22)] + [(1, f"other{i} zorp") for i in range(40)]
    rows += [(0, f"clean{i} commonly") for i in range(15)]
    rows += [(0, f"fill{i} word{i}") for i in range(623)]
    known = toxicity.Model(toxicity.INSULTS, (), dict(toxicity.PRIORS), 0.0)
    df = spark.createDataFrame(rows, "label int, text string")
    found = [toxicity._learn_lexicon(df.repartition(n, "text"), known, 62, 62 / 700, 0.02)
             for n in (1, 50)]
    assert found[0] == found[1]
    words, stems = found[0]
    assert "zorp" in words and "commonly" not in words and not any("commonly".startswith(s) for s in stems)


def test_all_that_pass_the_tests_are_taken(spark):
    # Three thousand words, each in three toxic texts and no other.
    rows = [(1, " ".join(f"zo{chr(97 + k % 26)}{chr(97 + k // 26 % 26)}{chr(97 + k // 676)}q" for k in range(3000)))] * 30
    rows += [(0, f"clean text {i}") for i in range(400)]
    known = toxicity.Model(toxicity.INSULTS, (), dict(toxicity.PRIORS), 0.0)
    df = spark.createDataFrame(rows, "label int, text string").repartition(4)
    words, _ = toxicity._learn_lexicon(df, known, 30, 30 / 430, 0.02)
    assert len(words) == 3000


def test_what_chance_explains_is_not_taken(spark):
    # "often" has the most hits, but in a sample that is mostly toxic chance explains them.
    rows = [(1, "often")] * 30 + [(0, "often")] * 9 + [(1, "rarely")] * 27 + [(0, "x y")] * 6
    rows += [(1, "a b")] * 3
    known = toxicity.Model(toxicity.INSULTS, (), dict(toxicity.PRIORS), 0.0)
    df = spark.createDataFrame(rows, "label int, text string")
    words, stems = toxicity._learn_lexicon(df, known, 60, 60 / 75, 0.02)
    assert "rarely" in words and "often" not in words and not any("often".startswith(s) for s in stems)


def test_every_match_counts():
    _, model = patterns("")
    chances = [model.chance(model.finder()("never kill. " * n)) for n in (1, 3, 4, 40)]
    assert chances == sorted(set(chances))
    assert chances[-1] == pytest.approx(1 - 0.98 * 0.95 ** 40)


def test_held_out(spark):
    folder = "/root/testdata/sf0.1"
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = [r for r in QUERIES["op1_toxicity"](spark, folder).collect()
            if r.held_out and r.doc_id in toxic]
    hits = sum(r.predicted and toxic[r.doc_id] for r in rows)
    called, marked = sum(r.predicted for r in rows), sum(toxic[r.doc_id] for r in rows)
    assert hits / called > 0.85 and hits / marked > 0.8


def test_no_labels(spark, odd, empty):
    none = spark.createDataFrame([(1, None)], "doc_id long, toxic int")
    model = toxicity.train(odd, none)
    assert model.weights["insult"] == pytest.approx(toxicity.PRIORS["insult"])
    found = toxicity.score(odd, model, "found")
    assert found.columns == [*odd.columns, "found"] and found.count() == odd.count()
    assert toxicity.score(empty, model, "found").count() == 0
