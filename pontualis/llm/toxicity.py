"""Toxicity by a weighted finite-state pattern grammar.

A text is cut into clauses.  The words of a clause that holds an insult or a threat become
symbols, and a cascade of transducers rewrites them: the negation transducer marks what
follows a negation within ``_SCOPE`` words, the reported-speech transducer what follows a verb of
saying, the target transducer what stands next to a person addressed.  The cascade is
composed into one machine, whose outputs are the matched patterns of the clause; so a
word never counts by itself, but as the pattern it stands in.

Learned from labels: the insult lexicon (words and stems, beside a small fixed one) and each
pattern's weight, the chance that a text with that pattern alone is toxic.  A text's score is one
minus the product of the chances that none of its patterns makes it toxic.

Training takes at most about ``train_rows`` labelled rows, chosen by a hash of the identifier;
copies (by their least word run) count once.

Defined cases: null and empty texts have the score of a text without patterns; rows without
a label are not learned from; of several labels of an identifier the largest holds; with no
labels the fixed lexicon and prior weights remain.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pontualis.llm.words import NOT_SPACE, find_words, flat, pieces, shingles
from pontualis.sources.scratch import materialize

INSULTS = frozenset("""idiot idiots moron morons stupid loser losers worthless pathetic scum trash
    disgusting clown dumb imbecile idiota estúpido imbécil idiote crétin dummkopf trottel""".split())
THREATS = frozenset("kill hurt destroy stab shoot strangle töten tuer matar".split())
TARGETS = frozenset("""you your yours yourself u he she they him her them all du dich dir ihr euch
    sie tu te toi vous usted ustedes""".split())
NEGATIONS = frozenset("""not no never nor neither without isn aren wasn don doesn didn nicht kein
    keine nie pas jamais nunca""".split())
REPORTS = frozenset("""said says wrote writes quoted quotes called calls claimed claims according
    sagte schrieb dijo disait""".split())

#: Prior chance that a text with this pattern alone is toxic, and how many rows it weighs.
PRIORS = {"insult": 0.9, "insult+target": 0.95, "not-insult": 0.4, "said-insult": 0.4,
          "threat+target": 0.8, "threat": 0.2, "not-threat": 0.05, "said-threat": 0.1}
_PRIOR_ROWS = 2.0
_SCOPE = 3
_AIM = 5  # words after a person addressed that are about them

_CLAUSE_END = re.compile(r"[.!?;:\n]")
_TOKEN = re.compile(r"[^\W_]+")


@dataclass
class Transducer:
    """A deterministic transducer: (state, symbol) -> (state, output)."""

    start: object
    arcs: dict = field(default_factory=dict)

    @classmethod
    def build(cls, start, symbols, step) -> Transducer:
        """Explores ``step(state, symbol)`` from ``start``."""
        machine, todo, seen = cls(start), [start], {start}
        while todo:
            state = todo.pop()
            for symbol in symbols:
                after, output = machine.arcs[state, symbol] = step(state, symbol)
                if after not in seen:
                    seen.add(after)
                    todo.append(after)
        return machine

    def outputs(self) -> set:
        return {output for _, output in self.arcs.values()}

    def then(self, other: Transducer, symbols) -> Transducer:
        """The composition: ``other`` reads what this one writes."""
        def step(state, symbol):
            first, middle = self.arcs[state[0], symbol]
            second, output = other.arcs[state[1], middle]
            return (first, second), output

        return Transducer.build((self.start, other.start), symbols, step)

    def run(self, symbols: list[str]) -> list[str]:
        state, out = self.start, []
        for symbol in symbols:
            state, output = self.arcs[state, symbol]
            out.append(output)
        return out


SYMBOLS = ("insult", "threat", "target", "negation", "report", "other")


def grammar() -> Transducer:
    """Negation, then reported speech, then target, composed."""
    def negate(since, symbol):
        if symbol == "negation":
            return _SCOPE, symbol
        marked = since and symbol in ("insult", "threat")
        return max(0, since - 1), f"not-{symbol}" if marked else symbol

    negation = Transducer.build(0, SYMBOLS, negate)

    def report(seen, symbol):
        if symbol == "report":
            return True, symbol
        return seen, f"said-{symbol}" if seen and symbol in ("insult", "threat") else symbol

    reported = Transducer.build(False, sorted(negation.outputs()), report)
    first = negation.then(reported, SYMBOLS)

    def aim(since, symbol):
        if symbol == "target":
            return _AIM, symbol
        hit = since and symbol in ("insult", "threat")
        return max(0, since - 1), f"{symbol}+target" if hit else symbol

    return first.then(Transducer.build(0, sorted(first.outputs()), aim), SYMBOLS)


@dataclass
class Model:
    words: frozenset  # insults as whole words
    stems: tuple  # and as beginnings of words
    weights: dict  # pattern -> chance
    base: float  # of a text without patterns

    def finder(self):
        """Text -> counts of its patterns."""
        trie = ahocorasick.Automaton()
        for word in self.words | THREATS:
            trie.add_word(word, (len(word), True))
        for stem in self.stems:
            whole = stem in self.words or stem in THREATS
            trie.add_word(stem, (len(stem), False))
            if whole:
                trie.add_word(stem, (len(stem), False))
        trie.make_automaton()
        machine, stems = grammar(), self.stems

        def symbol(word: str) -> str:
            if word in self.words or word.startswith(stems):
                return "insult"
            for name, some in (("threat", THREATS), ("target", TARGETS),
                               ("negation", NEGATIONS), ("report", REPORTS)):
                if word in some:
                    return name
            return "other"

        def clauses(low: str) -> Iterator[str]:
            done = 0
            for end, (size, whole) in trie.iter(low):
                begin, after = end - size + 1, end + 1
                if begin < done or (begin and low[begin - 1].isalnum()):
                    continue
                if whole and after < len(low) and low[after].isalnum():
                    continue
                first = begin
                while first > done and low[first - 1] not in ".!?;:\n":
                    first -= 1
                last = _CLAUSE_END.search(low, after)
                done = last.end() if last else len(low)
                yield low[first:done]

        def find(text: str | None) -> Counter:
            found: Counter = Counter()
            for clause in clauses((text or "").lower()):
                symbols = [symbol(word) for word in _TOKEN.findall(clause)]
                found.update(x for x in machine.run(symbols) if x in PRIORS)
            return found

        return find

    def chance(self, found: Counter) -> float:
        clean = 1 - self.base
        for pattern, n in found.items():
            clean *= (1 - self.weights[pattern]) ** n
        return 1 - clean


def _least_run(texts: pa.Array) -> np.ndarray:
    """The least hash of each text's runs of 5 words; 0 without words."""
    data, offsets = flat(texts)
    out = np.zeros(len(texts), np.uint64)
    for low, high in pieces(offsets):
        found = find_words(data[offsets[low]:offsets[high]],
                           offsets[low:high + 1] - offsets[low], NOT_SPACE)
        owner, h = shingles(found, high - low, 5)
        order = np.lexsort((h, owner))
        owner, h = owner[order], h[order]
        first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]])) if len(owner) else []
        out[low + owner[first]] = h[first]
    return out


def _features(text: str) -> set[str]:
    """Words, and their beginnings of 3 to 6 letters marked by a star."""
    words = {w for w in _TOKEN.findall(text.lower()) if len(w) >= 3 and not w.isdigit()}
    return words | {f"{w[:k]}*" for w in words for k in range(3, 7) if len(w) > k}


def _by_chance(hits: int, n: int, rate: float) -> float:
    """The chance of ``hits`` or more toxic texts among ``n`` at the common rate."""
    if not 0 < rate < 1:
        return float(rate >= 1)
    logs = [math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)
            + k * math.log(rate) + (n - k) * math.log1p(-rate) for k in range(hits, n + 1)]
    return sum(map(math.exp, logs))


def _learn_lexicon(sample: DataFrame, known: Model, toxic: int, rate: float, share: float):
    """Words and stems that mark toxic texts among those without a known pattern; ``rate`` is
    the share of toxic texts.  All that pass the tests are taken; as each is in ``share`` of the
    toxic texts of the sample at least, they are no more than the features of ``1 / share``
    texts."""
    shared = sample.sparkSession.sparkContext.broadcast(known)

    def count(batches):
        find, seen, hits = shared.value.finder(), Counter(), Counter()
        for batch in batches:
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                   strict=True):
                if label and find(text):
                    continue
                features = _features(text)
                seen.update(features)
                if label:
                    hits.update(features)
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen, pa.string()), pa.array(seen.values(), pa.int64()),
             pa.array([hits[f] for f in seen], pa.int64())], ["feature", "n", "hits"])

    least = max(3, int(share * toxic))
    counted = materialize(sample.mapInArrow(count, "feature string, n long, hits long")
                          .groupBy("feature").agg(F.sum("n").alias("n"), F.sum("hits").alias("hits")),
                          "features")
    # So rare by chance that, of all features, hardly one is taken wrongly.
    rare = 0.05 / max(1, counted.count())
    got = (counted.filter((F.col("hits") >= least) & (F.col("hits") * 4 > 3 * F.col("n")))
           .orderBy(F.desc("hits"), "feature").collect())
    hits = {r.feature: r.hits for r in got if _by_chance(r.hits, r.n, rate) < rare}
    # Of each stem the hits of the commonest other feature that begins with it.
    specific: Counter = Counter()
    for f, n in hits.items():
        for k in range(3, min(6, len(f.rstrip("*"))) + 1):
            if f != f"{f[:k]}*":
                specific[f[:k]] = max(specific[f[:k]], n)
    words = {f for f in hits if not f.endswith("*")}
    stems = {f[:-1] for f in hits if f.endswith("*") and hits[f] >= 1.3 * specific[f[:-1]]}
    return words, stems


def train(docs: DataFrame, labels: DataFrame, *, id_column: str = "doc_id",
          text_column: str = "text", label_column: str = "toxic",
          train_rows: int = 20_000) -> Model:
    """Learns lexicon and weights; ``docs`` and ``labels`` are the rows to learn from."""
    given = labels.filter(F.col(label_column).isNotNull() & F.col(id_column).isNotNull())
    share = min(1.0, train_rows / max(1, given.count()))
    chosen = F.pmod(F.xxhash64("_id", F.lit("train")), F.lit(1 << 30)) < int(share * (1 << 30))
    # At most about train_rows rows, so the sample of the labels may be broadcast.
    taken = (given.select(F.col(id_column).alias("_id"), F.col(label_column).alias("label"))
             .filter(chosen).groupBy("_id").agg(F.max("label").alias("label")))

    @F.arrow_udf("long")
    def least_run(texts: pa.Array) -> pa.Array:
        return pa.array(_least_run(texts).view(np.int64))

    texts = (docs.filter(F.col(text_column).isNotNull())
             .select(F.col(id_column).alias("_id"), F.col(text_column).alias("text"))
             .filter(chosen).join(F.broadcast(taken), "_id")
             .withColumn("run", least_run("text")))
    once = (texts.groupBy("run").agg(F.min_by(F.struct("label", "text"), F.struct("_id", "text"))
                                     .alias("row")).select("row.label", "row.text"))
    sample = materialize(once.select(F.col("label").cast("int").alias("label"), "text"), "labelled")
    toxic, rows = sample.filter("label = 1").count(), sample.count()
    model = Model(INSULTS, (), dict(PRIORS), 0.0)
    for least in (0.02, 0.01):
        words, stems = _learn_lexicon(sample, model, toxic, toxic / max(1, rows), least)
        model = Model(model.words | words, tuple(sorted({*model.stems, *stems})), model.weights, 0.0)
    return _weighed(sample, model)


def _weighed(sample: DataFrame, model: Model) -> Model:
    shared = sample.sparkSession.sparkContext.broadcast(model)

    def match(batches):
        find = shared.value.finder()
        rows: Counter = Counter()
        for batch in batches:
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                   strict=True):
                found = find(text)
                if len(found) <= 1:
                    rows[next(iter(found), ""), label] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in rows], pa.string()), pa.array([k[1] for k in rows], pa.int32()),
             pa.array(list(rows.values()), pa.int64())], ["pattern", "label", "n"])

    counts: Counter = Counter()
    for row in (sample.mapInArrow(match, "pattern string, label int, n long")
                .groupBy("pattern", "label").agg(F.sum("n").alias("n")).collect()):
        counts[row.pattern, row.label] = row.n

    def chance(pattern: str, prior: float) -> float:
        n = counts[pattern, 0] + counts[pattern, 1]
        return (counts[pattern, 1] + _PRIOR_ROWS * prior) / (n + _PRIOR_ROWS)

    weights = {p: min(0.999, chance(p, prior)) for p, prior in PRIORS.items()}
    return Model(model.words, model.stems, weights, min(0.25, chance("", 0.02)))


def score(df: DataFrame, model: Model, name: str, text_column: str = "text") -> DataFrame:
    """Adds ``name``: ``score`` and ``patterns``, how often each pattern was matched."""
    shared = _broadcast(df.sparkSession, model)

    @F.arrow_udf("score double, patterns map<string,int>")
    def judge(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        now = shared.value
        find = now.finder()
        for array in texts:
            found = [find(text) for text in array.to_pylist()]
            yield pa.StructArray.from_arrays(
                [pa.array([now.chance(f) for f in found], pa.float64()),
                 pa.array([list(f.items()) for f in found], pa.map_(pa.string(), pa.int32()))],
                ["score", "patterns"])

    return df.withColumn(name, judge(F.col(text_column)))


def _broadcast(spark: SparkSession, model: Model):
    return spark.sparkContext.broadcast(model)
