import random
from collections import Counter

import duckdb

from candlewick.llm import quality as Q
from candlewick.llm.queries import ORACLES


def brute(text):
    words = text.encode().split()
    if not words:
        return (0,) * 6
    grams = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    inside = {p for i in range(len(words) - 4) if grams[tuple(words[i : i + 5])] > 1 for p in range(i, i + 5)}
    lines = [x for x in text.split("\n") if x.encode().split()]
    return len(words), sum(len(w.decode()) for w in words), sum(c in Q.SYMBOLS for c in text), len(lines), len(lines) - len(set(lines)), len(inside)


def test_measures():
    rnd = random.Random(1)
    for _ in range(400):
        text = "".join(rnd.choice(["a ", "b ", "cc ", "é ", "#", "\n", "\t", "a b cc a b ", "\x0b", " "]) for _ in range(rnd.randint(0, 60)))
        assert Q.measure_text(text.encode()) == brute(text)


def test_buckets(spark):
    from pyspark.sql import functions as F

    for r in spark.range(0, 5000).select("id", Q.bucket(F.col("id")).alias("b")).collect():
        assert r.b <= r.id < r.b + max(1, r.b / 64 + 1e-9) and (r.id >= 128 or r.b == r.id)


def test_operator_equals_sql_on_odd_rows(spark, make_docs, odd_docs):
    rnd = random.Random(2)
    rows = [(100 + i, " ".join(rnd.choices(["alpha", "beta", "gamma", "delta"], k=rnd.randint(5, 40))) + rnd.choice(["", " ###", "\nx\nx"]), rnd.choice(["en", None]), rnd.choice(["a", None])) for i in range(600)]
    docs = make_docs([*odd_docs, *rows])
    arrow = docs.select("doc_id", "text", "lang", "source").toPandas()
    con = duckdb.connect()
    con.register("documents", arrow)
    rel = con.sql(ORACLES["op9_quality_rules"])
    want = sorted(map(repr, (tuple(dict(zip(rel.columns, r, strict=True))[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")) for r in rel.fetchall())))
    out = Q.quality_rules(docs).select("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept").collect()
    assert sorted(repr(tuple(r)) for r in out) == want
    assert Q.quality_rules(make_docs([])).count() == 0


def test_clean_documents_stay(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    r = {x.quality: x for x in Q.quality_rules(docs).join(labels, "doc_id").groupBy("quality").agg({"*": "count", "kept": "max"}).collect()}
    kept = {x.quality: x["count"] for x in Q.quality_rules(docs).join(labels, "doc_id").where("kept").groupBy("quality").count().collect()}
    assert kept.get(1, 0) > 0.95 * r[1]["count(1)"] and kept.get(0, 0) < 0.1 * r[0]["count(1)"]


def test_every_rule_decides_and_groups_differ(spark, make_docs):
    """Two sources with their own habits: what is normal in one is out in the other."""
    rnd = random.Random(4)
    word = lambda lo, hi: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(lo, hi)))
    prose = lambda n, lo=3, hi=7: [word(lo, hi) for _ in range(n)]
    rows = [(i, " ".join(prose(200)), "en", "plain") for i in range(400)]
    # the coded source has symbols everywhere, lines that repeat, and phrases that do
    for i in range(400, 800):
        phrase, lines = prose(rnd.randint(6, 9), 8, 16), [" ".join(prose(4, 8, 16)) for _ in range(60)]
        lines += rnd.sample(lines, rnd.randint(8, 16))
        rnd.shuffle(lines)
        text = " ".join([*phrase, *prose(200, 8, 16), *phrase]) + " " + "#" * rnd.randint(60, 90) + "\n" + "\n".join(lines)
        rows.append((i, text, "en", "coded"))
    short = [" ".join(prose(2)) for _ in range(20)] * 3 + [" ".join(prose(9)) for _ in range(30)]
    rnd.shuffle(short)
    odd = {900: " ".join(prose(200)) + " " + "#" * 70, 901: " ".join(prose(200, 12, 18)), 902: "\n".join(short), 903: " ".join([*prose(190), *prose(22) * 2])}
    rows += [(i, t, "en", "plain") for i, t in odd.items()]
    out = {r.doc_id: r for r in Q.quality_rules(make_docs(rows)).collect()}
    assert [out[i].failed_rules for i in (900, 901, 902)] == [["symbol_milli"], ["word_len_milli"], ["dup_line_milli"]]
    assert out[903].failed_rules == ["repeat_milli"] and not out[903].base_failed
    assert sum(out[i].kept for i in range(400)) >= 390 and sum(out[i].kept for i in range(400, 800)) >= 390


def test_small_groups_lean_on_the_merged_sketch(spark, make_docs):
    rows = [(i, " ".join("w" * (4 + (i + j) % 5) + str(j) for j in range(60)), "en", "large") for i in range(300)]
    rows += [(300, " ".join("w" * 30 + str(j) for j in range(60)), "en", "one")]
    out = {r.doc_id: r for r in Q.quality_rules(make_docs(rows)).collect()}
    assert not out[300].kept and all(out[i].kept for i in range(300))
