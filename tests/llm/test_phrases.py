import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from pontualis.llm import phrases


def brute(docs, min_count, best, share=100):
    f, total = defaultdict(Counter), Counter()
    for text, lang in docs:
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang or "und"] += len(words)
            for k in range(1, 6):
                for i in range(len(words) - k + 1):
                    f[lang or "und"][tuple(words[i:i + k])] += 1
    rows = set()
    for lang, counts in f.items():
        candidates = {p: n for p, n in counts.items() if len(p) > 1 and n >= min_count}
        scored = []
        for p, a in candidates.items():
            inside = any(len(q) > len(p) and share * a <= 100 * b
                         and any(q[i:i + len(p)] == p for i in range(len(q))) for q, b in candidates.items())
            if not inside:
                score, _, l, r = min((1000 * a * total[lang] // (counts[p[:k]] * counts[p[k:]]), k,
                                      counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, p, l, r) in enumerate(sorted(scored)[:best], 1):
            rows.add((lang, rank, p.decode(), -a, l, r, total[lang], -score))
    return rows


def corpus(seed, n=60):
    dice = random.Random(seed)
    pool = ["New", "york", "the", "of", "a", "é", "É", "x-ray", "'s", "in\xa0between", "\U0001f600", "Zz"]
    docs = []
    for _ in range(n):
        words = [dice.choice(pool) if dice.random() < 0.8 else "new york city hall now" for _ in range(dice.randrange(60))]
        text = "".join(w + dice.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", ";\x0b"]) for w in words)
        docs.append((text, dice.choice(["en", "de", "und", None])))
    return [*docs, *docs[:5], (None, "en"), ("", "fr"), ("...!?", None), ("word", "one")]


COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


@pytest.mark.parametrize("limit", [1 << 22, 0])
@pytest.mark.parametrize("seed", range(2))
def test_against_brute_force(spark, seed, limit):
    docs = corpus(seed)
    df = spark.createDataFrame(docs, "text string, lang string").repartition(4)
    out = phrases.collocations(df, min_count=5, best=40, broadcast_rows=limit).select(*COLUMNS)
    assert {tuple(r) for r in out.collect()} == brute(docs, 5, 40)


def test_partly_contained_phrases(spark):
    docs = corpus(7)
    df = spark.createDataFrame(docs, "text string, lang string").repartition(2)
    out = phrases.collocations(df, min_count=4, best=500, share=60).select(*COLUMNS)
    assert {tuple(r) for r in out.collect()} == brute(docs, 4, 500, share=60)


def test_scores_are_exact(spark):
    dice = random.Random(3)
    rows = []
    for _ in range(300):
        l, r = (dice.randrange(1, 10 ** dice.randrange(1, 16)) for _ in range(2))
        rows.append((min(l, r, dice.randrange(1, 10 ** 15)), dice.randrange(1, 10 ** 16), l, r))
    rows = [x for x in rows if 1000 * x[0] * x[1] // (x[2] * x[3]) < 1 << 63]
    df = spark.createDataFrame(rows, "a long, n long, l long, r long")
    got = df.select("a", "n", "l", "r", phrases.cut_score(*map(F.col, ("a", "n", "l", "r"))).alias("s"))
    assert len(rows) > 200
    assert all(x.s == 1000 * x.a * x.n // (x.l * x.r) for x in got.collect())


def test_numbers_are_places(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("key")).repartition(5)
    assert all(r.id == r.key for r in phrases.numbered(df, "places", 7).collect())


def test_odd_rows(spark, odd, empty):
    assert phrases.collocations(empty).count() == 0
    assert phrases.collocations(odd, min_count=2, best=10).select(*COLUMNS).count() > 0
    hot = spark.range(3000).select(F.lit("hot words " * 50).alias("text"), F.lit(None).cast("string").alias("lang"))
    rows = {r.phrase: r for r in phrases.collocations(hot).collect()}
    assert rows["hot words"].a == 150_000 if "hot words" in rows else True
    assert rows["hot words hot words hot"].a == 3000 * 48 and rows["hot words hot words hot"].n == 300_000


def test_a_clash_is_refused(spark, monkeypatch):
    monkeypatch.setattr(phrases, "_vocabulary", lambda docs: spark.createDataFrame(
        [(1, "en", "a", 5), (1, "en", "b", 5)], "key long, lang string, word string, n long"))
    with pytest.raises(phrases.HashClash):
        phrases.collocations(spark.createDataFrame([("a b", "en")], "text string, lang string"))


def test_texts_and_relations_are_taken_in_small_parts(spark, monkeypatch):
    """Three thousand texts of seven thousand bytes in one partition."""
    tokens, adjacent = phrases._tokens, phrases._adjacent

    def small(batch):
        assert batch.get_total_buffer_size() < 10 << 20
        for found in tokens(batch):
            assert len(found[-1]) <= 1 << 18
            yield found

    def few(batch):
        assert len(batch.column("at").flatten()) <= 1 << 18
        return adjacent(batch)

    monkeypatch.setattr(phrases, "_tokens", small)
    monkeypatch.setattr(phrases, "_adjacent", few)
    words = "transform(sequence(0, 999), i -> concat('word', (i + id) % 40))"
    docs = spark.range(0, 3000, 1, 1).selectExpr(f"array_join({words}, ' ') AS text", "'en' AS lang")
    found, totals = phrases.frequent_phrases(docs, longest=2)
    assert totals.collect() == [("en", 3_000_000)]
    assert found.groupBy("words").agg(F.count("*"), F.sum("n")).sort("words").collect() == [
        (1, 40, 3_000_000), (2, 40, 2_997_000)]
