import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from candlewick.llm import toxicity as T

LEX = T.Lexicon(dict.fromkeys(T.INSULTS, 2.0), {})


def test_cascade_equals_the_composed_machine():
    parts = (T.insult(), T.threat(), T.target(), T.negation(), T.reported())
    rnd = random.Random(1)
    for _ in range(400):
        both, states = T.compose(parts), [p.start for p in parts]
        state = both.start
        for symbol in rnd.choices("IVYNRFXw", k=rnd.randint(1, 30)):
            out, total = symbol, 0.0
            for i, part in enumerate(parts):
                states[i], out, w = part.go(states[i], out)
                total += w
            state, said, weight = both.go(state, symbol)
            assert said == out and weight == pytest.approx(total)


def by_hand(tags, weight=2.0):
    """A clause's sums straight from the definition: what stands how far from each cue."""
    sums, directed, at = [0.0, 0.0], {}, {}
    cues = [i for i, t in enumerate(tags) if t in "IV"]
    before = lambda i, opener, reach: opener in tags[max(0, i - reach) : i]
    for i in cues:
        gain = 1.0
        if tags[i] == "I" and before(i, "X", T.INTENSE_REACH):
            gain *= T.INTENSE
        if tags[i] == "V" and not before(i, "F", T.INTENT_REACH):
            gain *= T.UNINTENDED
        if before(i, "Y", T.TARGET_REACH):
            gain *= T.DIRECTED
            directed[i] = True
        if before(i, "N", T.NEGATION_REACH):
            gain *= T.NEGATED
        if before(i, "R", T.REPORT_REACH):
            gain *= T.REPORTED
        at[i] = gain
    for i in cues:  # the next target directs the cue right before it
        later = [j for j in range(i + 1, len(tags)) if tags[j] == "Y" or j in at]
        if i not in directed and later and tags[later[0]] == "Y" and later[0] - i <= T.TARGET_REACH:
            at[i] *= T.DIRECTED
    for i in cues:
        sums["IV".index(tags[i])] += weight * at[i]
    return sums


def test_clause_scores_against_the_definition():
    word = {"I": "idiot", "V": "kill", "Y": "you", "N": "not", "R": "said", "F": "gonna", "X": "utter", "w": "tree"}
    rnd = random.Random(2)
    short = itertools.chain.from_iterable(itertools.product("IVYNRFXw", repeat=n) for n in (1, 2, 3))
    for tags in itertools.chain(short, (rnd.choices("IVYNRFXwww", k=rnd.randint(4, 25)) for _ in range(800))):
        assert LEX.run(" ".join(word[t] for t in tags)) == pytest.approx(tuple(by_hand("".join(tags)))), tags


def test_clauses_not_isolated_words():
    plain, directed, late = (LEX.run(x)[0] for x in ("an idiot", "you are an idiot", "an idiot like you"))
    assert plain == 2.0 and directed == late == pytest.approx(2.0 * T.DIRECTED)
    assert LEX.run("you are not an idiot")[0] == pytest.approx(2.0 * T.DIRECTED * T.NEGATED)
    assert LEX.run("he said you idiot")[0] == pytest.approx(2.0 * T.DIRECTED * T.REPORTED)
    assert LEX.run("gonna kill you")[1] > LEX.run("birds kill flies")[1] > 0
    assert LEX.clauses("a fine day. nothing here") == [] and len(LEX.clauses("you idiot. fine day; you moron")) == 2


def test_without_arcs_it_is_worse():
    """Ablation: the machine's arcs are what tells directed from negated and reported clauses."""
    clauses = {c: 1 for c in ("you are an idiot", "you stupid loser", "an idiot like you", "we are gonna kill you", "such a moron, you")}
    clauses |= {c: 0 for c in ("you are not an idiot", "she never was a loser", "he said you idiot", "they wrote that she is stupid", "the birds kill flies", "no idiot was here")}
    bare = T.Lexicon(dict.fromkeys(T.INSULTS, 2.0), {})
    bare.machine = T.Transducer(0, {})

    def right(lexicon):
        score = {c: sum(lexicon.run(c)) for c in clauses}
        return max(sum((score[c] >= cut) == bool(y) for c, y in clauses.items()) for cut in {*score.values(), math.inf})

    assert right(LEX) == len(clauses) > right(bare) + 2


def test_scores_fall_with_negation_and_reports():
    m = T.fit(LEX, T.np.empty((0, T.FEATURES)), T.np.empty(0), 0.1)
    score = lambda t: float(m.score(T.np.array([T.features(LEX, t)[0]]))[0])
    assert score("you are an idiot") > score("an idiot") > score("he said an idiot") > score("not an idiot") > score("a tree")


def test_seeds_alone(spark, make_docs, odd_docs):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = [*odd_docs, (100, "You are a stupid idiot and a loser. You pathetic scum!", "en", "a"), (101, "A walk in the park on a sunny day.", "en", "a")]
    out = {r.doc_id: r for r in T.score_toxicity(make_docs(rows), labels).collect()}
    assert T.score_toxicity(make_docs(rows), labels).count() == len(rows)
    assert out[100].predicted == 1 and out[101].predicted == 0 and out[1].predicted == 0 and out[1].score == out[2].score
    assert all(0 <= r.score <= 1 for r in out.values())
    assert T.score_toxicity(make_docs([]), labels).count() == 0


def test_held_out_accuracy(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    noisy = labels.unionByName(labels.limit(3)).unionByName(spark.createDataFrame([(None, 1, 1), (5, 1, None), (7, 1, 0), (7, 1, 1)], "doc_id long, quality int, toxic int"))
    model = T.train(d.unionByName(d.limit(5)), noisy)
    assert (model.coef >= 0).all() and len(model.lexicon.words) + len(model.lexicon.stems) <= T.MAX_ENTRIES
    s = T.score_toxicity(d, noisy, model).join(labels, "doc_id").where("held_out")
    r = s.agg(F.avg((F.col("toxic") == F.col("predicted")).cast("int")).alias("right"), F.avg(F.when(F.col("toxic") == 0, F.col("predicted"))).alias("false_alarms")).first()
    assert r.right > 0.93 and r.false_alarms < 0.03
