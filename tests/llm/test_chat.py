"""Chat formatting: the fold against a plain one, exact round trips, the query against its SQL."""

import random

from compare import compare, duck
from pyspark.sql import functions as F

from ledgerday.llm.chat import chat_format, final_messages, parse, read_back, render, table_events
from ledgerday.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
EVENTS = "conv_id long, seq long, kind string, message long, role string, text string"
TURNS = "conv_id long, turn long, role string, text string"
NASTY = ["", "\\", "\\\\", "###", "\\### Assistant: </turn> ok", "### user: x </turn>\n", "a\nb\n", "<", "\\<\\", "é日 #<:\\n", "\n", " </turn>\n### "]


def plain_fold(events):
    """Messages by replaying a log event by event."""
    state = {}
    for conv, seq, kind, message, role, text in sorted(set(events), key=lambda e: (e[0], e[1], e[2], e[3])):
        messages = state.setdefault(conv, {})
        if kind in ("edit", "regenerate"):
            for m in [m for m in messages if m > message]:
                del messages[m]
            messages.setdefault(message, [None, ""])[1] = text or "" if kind == "edit" else ""
            if kind == "regenerate":
                messages[message][1] = text or ""
        else:
            entry = messages.setdefault(message, [None, ""])
            entry[1] += text or ""
            if kind == "open":
                entry[0] = role
    return {(c, m, r, t) for c, ms in state.items() for m, (r, t) in ms.items()}


def rows_of(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def random_log(seed, conversations=30, events=40):
    r = random.Random(seed)
    out = []
    for conv in range(conversations):
        n = r.randint(1, events) if conv else 400  # one hot conversation
        for seq in range(n):
            kind = r.choices(["open", "delta", "edit", "regenerate"], [4, 8, 1, 1])[0]
            text = None if kind == "regenerate" else r.choice([*NASTY, None, f"w{seq} "])
            out.append((conv, seq, kind, r.randint(0, 8), r.choice(["user", "assistant", "system"]) if kind == "open" else None, text))
    return out


def test_fold_equals_replay(spark):
    log = random_log(5)
    random.Random(6).shuffle(log)
    got = final_messages(spark.createDataFrame(log + log[:50], EVENTS).repartition(5))  # some events delivered twice
    assert rows_of(got) == plain_fold(log)


def test_resets_reach_over_ranges(spark):
    """A reset in the log's last range voids events in the first."""
    rows = [(1, i, "delta", i, None, f"{i} ") for i in range(5000)] + [(1, 6000, "edit", 10, None, "new"), (2, 0, "open", 0, "user", "x")]
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {(m, t) for c, m, _, t in rows_of(final_messages(spark.createDataFrame(rows, EVENTS))) if c == 1}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert got == {(i, f"{i} ") for i in range(10)} | {(10, "new")}


def test_formatted_texts_round_trip(spark):
    r = random.Random(7)
    messages = [(c, m, r.choice(["user", "assistant", "a:b#<\\", ""]), r.choice(NASTY) + r.choice(NASTY)) for c in range(40) for m in range(6)]
    rows = render(spark.createDataFrame(messages, "conv_id long, message long, role string, text string")).orderBy("conv_id", "message").collect()
    for c in range(40):
        whole = "".join(x.formatted for x in rows if x.conv_id == c)
        assert parse(whole) == [(role, text) for cc, _, role, text in messages if cc == c]
    for x, (_, _, role, text) in zip(rows, messages):
        assert (x.loss_from is None) == (role != "assistant")
        if role == "assistant":
            assert x.formatted[x.loss_from : x.loss_to].replace("\\", "") == "".join(ch for ch in text if ch != "\\") or "\\" in text


def test_edge_rows(spark):
    events = [
        (None, None, "open", None, None, None), (1, 0, "open", 0, None, None), (1, 1, "delta", 0, None, "x"), (1, 2, "other", 0, None, "y"),
        (1, 3, None, 0, None, "z"), (2, 0, "delta", 3, None, "no open"), (3, 0, "regenerate", 0, None, None), (4, 0, "open", None, "user", "a"),
        (4, 1, "edit", 0, None, "b"),
    ]
    df = spark.createDataFrame(events, EVENTS)
    want = {(None, None, None, ""), (1, 0, None, "x"), (2, 3, None, "no open"), (3, 0, None, ""), (4, None, "user", "a"), (4, 0, None, "b")}
    assert rows_of(final_messages(df)) == want
    assert rows_of(final_messages(df.withColumn("range", F.lit(1)).withColumn("c", F.lit(2)).withColumn("reset", F.lit("q")))) == want
    assert rows_of(chat_format(df.limit(0))) == set() and rows_of(read_back(chat_format(df.limit(0)))) == set()


def test_rows_of_a_table(spark, tmp_path):
    """Ties, repeated rows, nulls, long texts and clashing columns, against the SQL."""
    rows = [(1, 0, "user", t) for t in NASTY] + [(1, 0, "user", "same")] * 3 + [(2, None, None, None), (2, None, "assistant", None), (2, 1, "assistant", "x\n" * 20_000)]
    rows += [(None, 5, "assistant", "é"), (None, 4, "system", "s"), (None, None, None, "n")] + [(9, i, ("user", "assistant")[i % 2], NASTY[i % len(NASTY)]) for i in range(500)]
    df = spark.createDataFrame(rows, TURNS).withColumn("seq", F.lit(1)).withColumn("message", F.lit("m")).withColumn("kind", F.lit("edit"))
    df.write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.conv_id: r for r in read_back(chat_format(table_events(df))).collect()}
    assert got[1].n_turns == len(NASTY) + 3 and got[2].loss_chars == 40_000 and set(got) == {1, 2, None, 9}
    import duckdb

    con = duckdb.connect()
    con.execute(f"create view conversations as select conv_id, turn, role, text from read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    # Nulls first, as in Spark.
    con.execute("set default_null_order = 'nulls_first'")
    want = {r[0]: r[1:] for r in con.sql(ORACLE_SQL["op13_chat_formatting"]).fetchall() if r[0] != -7}
    assert {k: tuple(r)[1:] for k, r in got.items()} == want
    assert read_back(chat_format(table_events(df.limit(0)))).count() == 0


def test_query_equals_sql(spark):
    problems, n, _, _ = compare(spark, duck(SF), "op13", QUERIES["op13_chat_formatting"], ORACLE_SQL["op13_chat_formatting"], SF)
    assert not problems and n == 21
