from candlewick.llm import chat as C

SCHEMA = "conv_id long, turn long, role string, text string, pos long, n long, key string"


def turns(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "k") for r in rows], SCHEMA)


def brute(rows):
    """{conv: (n_turns, n_copies, text)} of conversations that none extends."""
    low = lambda x: (x is not None, x or "")
    convs = {}
    for c, t, role, text in sorted(rows, key=lambda r: (r[1] is None, r[1] or 0, low(r[2]), low(r[3]))):
        convs.setdefault(c, []).append((role, text))
    out = {}
    for c, seq in convs.items():
        same = [d for d, s in convs.items() if s == seq]
        if any(len(s) > len(seq) and s[: len(seq)] == seq for s in convs.values()) or c != min((d for d in same if d is not None), default=None):
            continue
        out[c] = (len(seq), len(same), "".join(f"<|im_start|>{r or 'unknown'}\n{t or ''}<|im_end|>\n" for r, t in seq))
    return out


def got(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.conv_id is not None, r.conv_id or 0, r.part)):
        n, k, text = out.get(r.conv_id, (r.n_turns, r.n_copies, ""))
        out[r.conv_id] = (n, k, text + r.text)
    return out


def test_prefixes_and_copies(spark):
    base = [("user", "hi"), ("assistant", "hello"), ("user", "more"), ("assistant", "done")]
    rows = [(c, i, r, t) for c, n in ((1, 2), (2, 3), (3, 4), (4, 4), (5, 1)) for i, (r, t) in enumerate(base[:n])]
    rows += [(6, 0, "user", "hi"), (6, 1, "assistant", "other"), (7, 0, "user", None), (8, 0, "user", ""), (9, 0, None, "x"), (10, 0, "unknown", "x"), (11, None, "user", "a"), (11, 0, "user", "b"), (12, 0, "user", "r"), (12, 0, "user", "r")]
    assert got(C.format_chats(turns(spark, rows))) == brute(rows)
    assert set(brute(rows)) == {3, 6, 7, 8, 9, 10, 11, 12}


def test_null_conversation_and_empty_table(spark):
    out = C.format_chats(turns(spark, [(None, 0, "user", "alone"), (None, 1, "assistant", "yes")])).collect()
    assert [(r.conv_id, r.n_turns) for r in out] == [(None, 2)]
    assert C.format_chats(turns(spark, [])).count() == 0


def test_long_conversation_in_segments(spark):
    rows = [(1, i, "user", f"t{i}") for i in range(300)] + [(2, i, "user", f"t{i}") for i in range(150)] + [(3, 0, "user", "z" * 200_000)]
    df = C.format_chats(turns(spark, rows).repartition(5))
    assert got(df) == brute(rows)
    parts = df.where("conv_id = 1").orderBy("part").collect()
    assert [(r.part, r.first_turn, r.last_turn) for r in parts] == [(k, 64 * k + 1, min(300, 64 * k + 64)) for k in range(5)]


def test_plan_has_no_python(spark, sf_dir):
    plan = C.format_chats(spark.read.parquet(f"{sf_dir}/conversations.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
