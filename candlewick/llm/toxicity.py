"""Toxicity by a weighted finite-state pattern grammar.

Words get one of eight tags: insult (I), violence (V), target (Y), negation (N), reported speech
(R), intention (F), intensifier (X) or other (w). Five weighted transducers over these tags are composed:

  insult    an intensifier strengthens the insult after it;
  threat    violence after a word of intention is a threat (H), else it weighs less;
  target    a target shortly before or after directs an insult (D) or aims a threat (A), which weighs more;
  negation  cancels what follows it closely (c): weighs less;
  reported  marks what follows a verb of saying (q): weighs less.

An arc's weight is the logarithm of a gain; composing adds weights along the path. A clause is read
left to right by the composed machine, and each of its cues adds its entry's weight times its path's
gain. So matched clauses are scored, never isolated words: the same cue weighs 1.5 times as much
when directed and a quarter when negated. The composed machine is made state by state as texts need it.

The cue lexicon starts from fixed seeds and learns from labels: words and word stems whose presence
in toxic texts stands out by a log-odds weight become insult entries with that weight. The score is a
logistic function of a text's log-damped insult and threat sums, its strongest clause and its density,
fitted on the same labelled rows with coefficients of at least 0: whatever weighs a clause down
lowers the score. Texts of any length are read whole, in learning too: words are counted where the
texts are, and only entries and four numbers per learned text come to the driver.

Learning uses about SAMPLE_PER_CLASS labelled texts per label, by the hash of doc_id, outside the
held-out fold, and keeps the MAX_ENTRIES entries of greatest weight.

Defined cases: null or empty text has no clause and gets the base score; labels that are null, or
join no document, or contradict each other, are not used; with no usable labels the seeds alone
decide; a doc_id with several texts is learned from by one of them; repeated documents get equal
scores; an empty table gives no rows; lang, source and other columns are never read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Scratch, bound_batches, fold, text_bytes

HELD_FOLDS, HELD_OUT = 4, 2
PREDICT_AT = 0.3
SAMPLE_PER_CLASS = 4000
MIN_STEM, MAX_STEM = 4, 8
#: An entry is learned from at least MIN_TEXTS toxic texts, at a log-odds of at least MIN_ODDS.
MIN_TEXTS, MIN_ODDS = 5, 3.0
MAX_ENTRIES = 8000
#: Words counted in a task before they are passed on.
COUNTED = 200_000
#: How many words an intensifier, an intention and a target reach, a negation holds, and reported speech lasts.
INTENSE_REACH, INTENT_REACH, TARGET_REACH, NEGATION_REACH, REPORT_REACH = 2, 4, 5, 3, 12
#: Gains of the arcs.
INTENSE, UNINTENDED, DIRECTED, NEGATED, REPORTED = 1.25, 0.5, 1.5, 0.25, 0.4

# Seed cues in English, German, French and Spanish.
INSULTS = "idiot moron stupid loser scum pathetic worthless disgusting trash dumb imbecile dumm trottel idiotin abschaum idiota imbécil estúpido estúpida basura idiote imbécile crétin ordure".split()
VIOLENCE = "kill murder strangle stab töten umbringen ermorden tuer assassiner matar asesinar".split()
TARGETS = "you your you're he she they him her them his their du dich dir dein ihr euch sie tu te toi vous votre ton tú te usted ustedes tu su ellos".split()
NEGATIONS = "not never no isn't aren't wasn't don't nicht kein keine nie jamais pas aucun nunca jamás".split()
REPORTS = "said says say wrote called claimed told reported quoted sagte sagt schrieb nannte dit écrit appelé dijo dice escribió llamó".split()
INTENTIONS = "will i'll we'll gonna going should must want werde werden sollte muss will vais allons doit voy vamos debe quiero".split()
INTENSIFIERS = "such total complete absolute utter so very völlig absolut so très tellement total absoluto muy tan".split()
SEED_WEIGHT = 2.0

_WORDS = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*")
_CLAUSE_END = re.compile(r"[.!?;:\n]")


@dataclass(frozen=True)
class Transducer:
    """Deterministic: (state, symbol) -> (state, output, weight). Other symbols pass unchanged, and
    the state goes on by ``step``."""

    start: object
    arcs: dict[tuple[object, str], tuple[object, str, float]]
    step: dict[object, object] = field(default_factory=dict)

    def go(self, state: object, symbol: str) -> tuple[object, str, float]:
        return self.arcs.get((state, symbol)) or (self.step.get(state, state), symbol, 0.0)


class Composed:
    """The machine that feeds what ``first`` writes to ``second``; weights add up. Its arcs are made when first taken."""

    def __init__(self, first: Transducer | Composed, second: Transducer | Composed) -> None:
        self.first, self.second = first, second
        self.start = (first.start, second.start)
        self.arcs: dict[tuple[object, str], tuple[object, str, float]] = {}

    def go(self, state: tuple, symbol: str) -> tuple[tuple, str, float]:
        arc = self.arcs.get((state, symbol))
        if arc is None:
            a, mid, w = self.first.go(state[0], symbol)
            b, out, v = self.second.go(state[1], mid)
            arc = self.arcs[state, symbol] = ((a, b), out, w + v)
        return arc


def windowed(opener: str, rewrites: dict[str, str], reach: int, gain: float) -> Transducer:
    """After ``opener`` and for ``reach`` words, symbols are rewritten, with a gain."""
    arcs = {(k, opener): (reach, opener, 0.0) for k in range(reach + 1)}
    for k in range(1, reach + 1):
        arcs |= {(k, a): (k - 1, b, math.log(gain)) for a, b in rewrites.items()}
    return Transducer(0, arcs, {k: k - 1 for k in range(1, reach + 1)})


def insult() -> Transducer:
    return windowed("X", {"I": "I"}, INTENSE_REACH, INTENSE)


def threat() -> Transducer:
    """Violence with an intention before it is H at its full weight; without, V at less."""
    t = windowed("F", {"V": "H"}, INTENT_REACH, 1.0)
    return Transducer(0, t.arcs | {(0, "V"): (0, "V", math.log(UNINTENDED))}, t.step)


def target() -> Transducer:
    """States are (words that the last target still reaches, words that the last undirected cue still
    waits for one). A late target is written as B: it strengthens the cue before it."""
    r, more = TARGET_REACH, math.log(DIRECTED)
    arcs: dict[tuple[object, str], tuple[object, str, float]] = {}
    step: dict[object, object] = {}
    for near in range(r + 1):
        for waits in range(r + 1):
            state = (near, waits)
            step[state] = (max(near - 1, 0), max(waits - 1, 0))
            arcs[state, "Y"] = ((r, 0), "B", more) if waits else ((r, 0), "Y", 0.0)
            for cue, directed in (("I", "D"), ("V", "A"), ("H", "A")):
                arcs[state, cue] = ((near - 1, 0), directed, more) if near else ((0, r), cue, 0.0)
    return Transducer((0, 0), arcs, step)


def negation() -> Transducer:
    return windowed("N", dict.fromkeys("IVHDA", "c"), NEGATION_REACH, NEGATED)


def reported() -> Transducer:
    return windowed("R", dict.fromkeys("IVHDAc", "q"), REPORT_REACH, REPORTED)


def compose(parts: Iterable[Transducer]) -> Composed | Transducer:
    out = None
    for part in parts:
        out = part if out is None else Composed(out, part)
    return out


def grammar() -> Composed:
    return compose((insult(), threat(), target(), negation(), reported()))


KINDS = {"I": 0, "V": 1}


class Lexicon:
    """Cue words and stems. ``stems`` match as the start of a word, ``words`` as a whole."""

    def __init__(self, words: dict[str, float], stems: dict[str, float], violence: dict[str, float] | None = None) -> None:
        self.words, self.stems = words, stems
        self.violence = dict.fromkeys(VIOLENCE, SEED_WEIGHT) if violence is None else violence
        self.tags: dict[str, str] = {}
        for names, tag in ((INTENSIFIERS, "X"), (INTENTIONS, "F"), (TARGETS, "Y"), (NEGATIONS, "N"), (REPORTS, "R"), (self.violence, "V"), (words, "I")):
            self.tags |= dict.fromkeys(names, tag)
        self.weights = self.violence | words
        self.sizes = sorted({len(s) for s in stems})
        self.machine = grammar()

    def __getstate__(self):
        return {"words": self.words, "stems": self.stems, "violence": self.violence}

    def __setstate__(self, state):
        self.__init__(**state)

    @cached_property
    def automaton(self):
        import ahocorasick

        out = ahocorasick.Automaton()
        for cue in {*self.words, *self.violence, *self.stems}:
            out.add_word(cue, len(cue))
        out.make_automaton()
        return out

    def tag(self, word: str) -> tuple[str, float]:
        if (tag := self.tags.get(word)) is not None:
            return tag, self.weights.get(word, 0.0)
        for n in self.sizes:
            if (weight := self.stems.get(word[:n])) is not None and len(word) >= n:
                return "I", weight
        return "w", 0.0

    def clauses(self, text: str) -> list[tuple[float, float]]:
        """The insult and threat sums of each clause that holds a cue."""
        out, done = [], 0
        if not (self.words or self.stems or self.violence):
            return out
        for end, size in self.automaton.iter(text):
            start = end - size + 1
            if start < done or (start and text[start - 1].isalpha()):
                continue
            left = max(done, *(text.rfind(mark, done, start) + 1 for mark in ".!?;:\n"))
            right = m.start() if (m := _CLAUSE_END.search(text, end)) else len(text)
            sums = self.run(text[left:right])
            if any(sums):
                out.append(sums)
                done = right
        return out

    def run(self, clause: str) -> tuple[float, float]:
        """A clause through the composed machine: each cue's weight times its path's gain."""
        state, sums, kind, last = self.machine.start, [0.0, 0.0], 0, 0.0
        for word in _WORDS.findall(clause):
            tag, weight = self.tag(word)
            state, out, gain = self.machine.go(state, tag)
            if (k := KINDS.get(tag)) is not None:
                kind, last = k, weight * math.exp(gain)
                sums[kind] += last
            elif out == "B":
                sums[kind] += last * (math.exp(gain) - 1.0)
        return sums[0], sums[1]


FEATURES = 4


def features(lexicon: Lexicon, text: str) -> tuple[list[float], int]:
    """(log-damped insult and threat sums, the strongest clause, density; clauses) of a lower-cased text."""
    clauses = lexicon.clauses(text)
    if not clauses:
        return [0.0] * FEATURES, 0
    insults, threats = sum(a for a, _ in clauses), sum(b for _, b in clauses)
    return [math.log1p(insults), math.log1p(threats), math.log1p(max(a + b for a, b in clauses)), 100 * (insults + threats) / (len(text) + 1000)], len(clauses)


def entries_of(text: str) -> set[str]:
    """What a text can teach: its words (after "=") and their stems (after "^")."""
    seen = set(_WORDS.findall(text))
    return {"=" + w for w in seen if len(w) > 2} | {"^" + w[:n] for w in seen for n in range(MIN_STEM, min(MAX_STEM, len(w) - 1) + 1)}


def odds(k1: int, k0: int, n1: int, n0: int) -> float:
    return math.log((k1 + 0.5) / (n1 + 1)) - math.log((k0 + 0.5) / (n0 + 1))


def learn_lexicon(counts: dict[str, tuple[int, int]], n0: int, n1: int) -> Lexicon:
    """Seeds, and words and stems that mark toxic texts, from (texts not toxic, toxic) per entry."""
    words: dict[str, float] = dict.fromkeys(INSULTS, SEED_WEIGHT)
    violence: dict[str, float] = dict.fromkeys(VIOLENCE, SEED_WEIGHT)
    stems: dict[str, float] = {}
    if not n1 or not n0:
        return Lexicon(words, stems, violence)
    for seeds in (words, violence):  # what the labels say of a seed stands
        for w in seeds:
            k0, k1 = counts.get("=" + w, (0, 0))
            if k1 + k0 >= MIN_TEXTS:
                seeds[w] = max(odds(k1, k0, n1, n0), 0.1)
    found = {e: odds(k1, k0, n1, n0) for e, (k0, k1) in counts.items() if k1 >= MIN_TEXTS}
    found = sorted(((e, o) for e, o in found.items() if o >= MIN_ODDS), key=lambda x: (-x[1], x[0]))
    clean = {e[1:] for e, _ in found if e[0] == "^"}
    for e, o in found:
        # the shortest stem that is clean covers its longer ones
        if e[0] == "^" and not any(e[1 : n + 1] in clean for n in range(MIN_STEM, len(e) - 1)):
            stems[e[1:]] = o
        elif e[0] == "=" and e[1:] not in violence:
            words[e[1:]] = max(o, words.get(e[1:], 0.0))
        if len(words) + len(stems) >= MAX_ENTRIES:
            break
    return Lexicon(words, stems, violence)


@dataclass
class Model:
    lexicon: Lexicon
    scale: np.ndarray
    coef: np.ndarray
    bias: float

    def score(self, rows: np.ndarray) -> np.ndarray:
        z = (rows / self.scale) @ self.coef + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(lexicon: Lexicon, x: np.ndarray, y: np.ndarray, share: float, rounds: int = 600) -> Model:
    """Logistic coefficients of at least 0; ``share`` is that of toxic rows among all labels."""
    if not len(y) or y.min() == y.max():  # seeds alone: one plain cue is not enough, a directed one is
        return Model(lexicon, np.ones(FEATURES), np.array([1.0, 1.0, 1.0, 0.0]), -3.2)
    weight = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
    scale = np.maximum(x.std(axis=0), 0.1)
    z, coef, bias = x / scale, np.zeros(FEATURES), math.log(max(share, 1e-3) / max(1 - share, 1e-3))
    ridge = 0.002
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ coef + bias, -30, 30)))
        g = weight * (p - y) / len(y)
        coef = np.maximum(coef - 2.0 * (z.T @ g + ridge * coef), 0.0)
        bias -= 2.0 * g.sum()
    return Model(lexicon, scale, coef, float(bias))


def labelled_sample(docs: DataFrame, labels: DataFrame, per_class: int) -> tuple[DataFrame, dict[int, int]]:
    """(doc_id, toxic, half, t of about ``per_class`` texts of each label, and how many rows are labelled so)."""
    open_fold = fold("doc_id", HELD_FOLDS) != HELD_OUT
    marked = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & open_fold).groupBy("doc_id").agg(F.min("toxic").cast("int").alias("toxic"), F.max("toxic").cast("int").alias("most"))
    marked = marked.where("toxic = most").drop("most")
    counts = {r.toxic: r["count"] for r in marked.groupBy("toxic").count().collect()}
    space = 1 << 30
    share = F.lit(0)
    for y, n in counts.items():
        share = F.when(F.col("toxic") == y, int(space * min(1.0, per_class / n))).otherwise(share)
    picked = marked.where(F.pmod(F.xxhash64("doc_id"), F.lit(space)) < share)
    # the sample's ids are at most about twice per_class rows, whatever the tables' sizes
    rows = docs.where(open_fold).select("doc_id", "text").join(F.broadcast(picked), "doc_id")
    half = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(2)).cast("int").alias("half")
    return rows.groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.min(F.lower(F.coalesce("text", F.lit("")))).cast("binary").alias("t")).select("doc_id", "toxic", half, "t"), counts


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many texts of each half and label hold an entry, added up before they leave the task."""
    sums: dict[str, Counter] = {}

    def rows() -> pa.RecordBatch:
        out = [(e, *(c[k] for k in range(4))) for e, c in sums.items()]
        sums.clear()
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.string()), *(pa.array([r[k + 1] for r in out], pa.int64()) for k in range(4))], names=["entry", "k0", "k1", "k2", "k3"])

    for b in batches:
        for half, toxic, t in zip(b.column("half"), b.column("toxic"), b.column("t"), strict=True):
            which = 2 * half.as_py() + toxic.as_py()
            for e in entries_of(t.as_py().decode("utf-8", "replace")):
                sums.setdefault(e, Counter())[which] += 1
            if len(sums) > COUNTED:
                yield rows()
    yield rows()


def train(docs: DataFrame, labels: DataFrame, sample_per_class: int = SAMPLE_PER_CLASS) -> Model:
    """Fit on a bounded sample of labelled rows outside the held-out fold: logistic coefficients on
    texts that their lexicon was not learned from, then a lexicon from all."""
    spark = docs.sparkSession
    bound_batches(spark)
    scratch = Scratch(spark, "toxicity")
    sample, counts = labelled_sample(docs, labels, sample_per_class)
    sample = scratch.cut(sample, "sample")
    sizes = {(r.half, r.toxic): r["count"] for r in sample.groupBy("half", "toxic").count().collect()}
    each = sample.select("half", "toxic", "t").mapInArrow(_counted, "entry string, k0 long, k1 long, k2 long, k3 long")
    sums = each.groupBy("entry").agg(*(F.sum(f"k{k}").alias(f"k{k}") for k in range(4)))
    # an entry is used if MIN_TEXTS toxic texts of the sample hold it and few others do, or it is a seed
    seeds = ["=" + w for w in (*INSULTS, *VIOLENCE)]
    toxic, other = F.col("k1") + F.col("k3"), F.col("k0") + F.col("k2")
    n1, n0 = sum(n for (_, y), n in sizes.items() if y), sum(n for (_, y), n in sizes.items() if not y)
    stands = F.log((toxic + 0.5) / (n1 + 1)) - F.log((other + 0.5) / (n0 + 1))
    used = sums.where((toxic >= MIN_TEXTS) & (stands >= MIN_ODDS - 1.0) | F.col("entry").isin(seeds))
    used = used.orderBy(F.col("entry").isin(seeds).desc(), stands.desc(), "entry").limit(4 * MAX_ENTRIES).collect()
    lexicon = learn_lexicon({r.entry: (r.k0 + r.k2, r.k1 + r.k3) for r in used}, n0, n1)
    learned = spark.sparkContext.broadcast(learn_lexicon({r.entry: (r.k0, r.k1) for r in used}, sizes.get((0, 0), 0), sizes.get((0, 1), 0)))

    def read(texts: pa.Array) -> pa.Array:
        return pa.array([features(learned.value, x.as_py().decode("utf-8", "replace"))[0] for x in texts], pa.list_(pa.float64()))

    seen = sample.where("half = 1").select("doc_id", "toxic", F.arrow_udf(read, "array<double>")("t").alias("x")).orderBy("doc_id").collect()
    x, y = np.array([r.x for r in seen], dtype=float).reshape(-1, FEATURES), np.array([r.toxic for r in seen], dtype=float)
    scratch.drop_all()
    return fit(lexicon, x, y, counts.get(1, 0) / max(sum(counts.values()), 1))


def score_toxicity(docs: DataFrame, labels: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, held_out, score, predicted, clauses (how many matched)."""
    spark = docs.sparkSession
    bound_batches(spark)
    shared = spark.sparkContext.broadcast(model or train(docs, labels))

    def run(texts: pa.Array) -> pa.Array:
        m = shared.value
        rows = [features(m.lexicon, x.as_py().decode("utf-8", "replace").lower()) for x in texts]
        scores = m.score(np.array([x for x, _ in rows], dtype=float).reshape(-1, FEATURES))
        return pa.StructArray.from_arrays([pa.array(scores), pa.array([n for _, n in rows], pa.int64())], ["score", "clauses"])

    s = F.arrow_udf(run, "struct<score:double,clauses:bigint>")(text_bytes())
    d = docs.select("doc_id", (fold("doc_id", HELD_FOLDS) == HELD_OUT).alias("held_out"), s.alias("s"))
    return d.select("doc_id", "held_out", F.col("s.score").alias("score"), (F.col("s.score") >= PREDICT_AT).cast("int").alias("predicted"), F.col("s.clauses").alias("clauses"))
