from collections import defaultdict

from tillwright.llm import chat

TURNS = "conv_id BIGINT, turn BIGINT, role STRING, text STRING"


def plain(rows):
    convs = defaultdict(set)
    for conv, *turn in rows:
        convs[conv].add(tuple(turn))
    key = lambda t: tuple((v is not None, v if v is not None else "") for v in t)
    said = {c: tuple(t[1:] for t in sorted(ts, key=key)) for c, ts in convs.items()}
    prefixes = {s[:n] for s in said.values() for n in range(1, len(s))}
    groups = defaultdict(list)
    for c, s in said.items():
        if s not in prefixes:
            groups[s].append(c)
    return sorted((
        (min((c for c in cs if c is not None), default=None), len(s), len(cs),
         "".join(f"<|im_start|>{r or ''}\n{t or ''}<|im_end|>\n" for r, t in s))
        for s, cs in groups.items()
    ), key=str)


ROWS = [
    (1, 0, "user", "hi"), (2, 0, "user", "hi"), (2, 1, "assistant", "yes"), (3, 0, "user", "hi"),
    (3, 1, "assistant", "yes"), (3, 2, "user", "more"), (4, 5, "user", "hi"), (4, 7, "assistant", "yes"), (4, 9, "user", "more"),
    (5, 0, "user", None), (6, 0, "user", ""), (7, 0, None, "hi"), (8, 0, "userh", "i"), (9, None, "user", "x"), (9, 1, "user", "y"),
    (10, 1, "user", "b"), (10, 1, "user", "a"), (10, 1, "user", "a"), (None, 0, "user", "hi"), (None, 1, "assistant", "no"),
    (11, 0, "user", "z" * 100_000), (12, 0, "user", "z" * 100_000), (12, 1, "user", "z"), (13, 0, "4:user", "hi"),
]


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_against_brute_force(spark):
    assert rows_of(chat.format_chats(spark.createDataFrame(ROWS, TURNS))) == plain(ROWS)


def test_clashing_columns_and_common_first_turn(spark):
    from pyspark.sql import functions as F

    rows = [(i, 0, "user", "same") for i in range(500)] + [(i, 1, "assistant", f"a{i % 7}") for i in range(300)]
    df = spark.createDataFrame(rows, TURNS)
    for name in ("TEXT", "digest", "digests", "turns", "first", "n_turns"):
        df = df.withColumn(name, F.lit(1)) if name != "TEXT" else df.select("*", F.lit(1).alias("TEXT"))
    assert rows_of(chat.format_chats(df)) == plain(rows)


def test_empty_table(spark):
    assert chat.format_chats(spark.createDataFrame([], TURNS)).collect() == []


def test_a_very_long_conversation_and_its_snapshots(spark):
    """100,000 turns under one id, among others prefixes of it; time in proportion to the turns."""
    import time

    from pyspark.sql import functions as F

    def conv(conv_id, n):
        turn = F.col("id")
        return spark.range(n).select(
            conv_id.alias("conv_id"), turn.alias("turn"),
            F.when(turn % 2 == 0, "user").otherwise("assistant").alias("role"), F.concat(F.lit("t"), turn).alias("text"),
        )

    def took(n):
        began = time.time()
        df = conv(F.lit(1).cast("bigint"), n).unionAll(conv(F.lit(2).cast("bigint"), n - 1)).unionAll(
            conv(F.lit(None).cast("bigint"), n)).unionAll(conv(F.lit(3).cast("bigint"), n // 2).withColumn("role", F.lit("user")))
        rows = {r.conv_id: (r.n_turns, r.snapshots, len(r.turns)) for r in chat.maximal_conversations(df).collect()}
        assert rows == {1: (n, 2, n), 3: (n // 2, 1, n // 2)}
        return time.time() - began

    took(1_000)
    small, large = took(10_000), took(100_000)
    print("seconds", small, large)
    assert large < 10 * small


def test_conversations_over_several_ranges(spark):
    """Random logs over few words, dealt over more ranges than rows."""
    import random

    dice = random.Random(5)
    rows = []
    for c in [None, *range(40)]:
        n = dice.randint(1, 12)
        rows += [(c, t, dice.choice(["user", None]), dice.choice(["a", "b"])) for t in range(n)]
        if c is not None:
            rows += [(100 + c, t, r, x) for k, t, r, x in rows if k == c and t < dice.randint(1, 12)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "60")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert rows_of(chat.format_chats(spark.createDataFrame(rows, TURNS))) == plain(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_turns_stay_rows_until_rendered(spark):
    from tests.compare import plan_text

    ordered = chat.ordered_turns(spark.createDataFrame(ROWS, TURNS))
    plan = plan_text(chat.kept_conversations(chat.prefix_sums(ordered)))
    assert "collect_" not in plan and "text#" not in plan and "LeftAnti" in plan
