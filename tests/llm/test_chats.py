import random

from tests.conftest import SMALL
from watchfold.llm import chats
from watchfold.llm.common import table

SCHEMA = "conv_id long, turn long, role string, text string"


def plain(rows):
    convs = {}
    for r in rows:
        convs.setdefault(r[0], []).append(r)
    turns = {c: tuple((r[2], r[3]) for r in sorted(v, key=lambda r: (r[1] is not None, r[1] or 0))) for c, v in convs.items()}
    best = {}
    for c in sorted(turns, key=lambda c: (c is None, c or 0)):
        best.setdefault(turns[c], c)
    prefixes = {t[:k] for t in turns.values() for k in range(1, len(t))}
    say = lambda t: "".join(f"<|im_start|>{'user' if r is None else r}\n{x or ''}<|im_end|>\n" for r, x in t)
    return sorted(((c, len(t), say(t)) for t, c in best.items() if t not in prefixes), key=repr)


def found(df):
    return sorted((tuple(r) for r in chats.format_chats(df).collect()), key=repr)


def test_whole_table(spark):
    rows = table(spark, SMALL, "conversations")
    assert found(rows) == plain([tuple(r) for r in rows.select("conv_id", "turn", "role", "text").collect()])


def test_snapshots_and_odd_rows(spark):
    rng = random.Random(2)
    base = [("user", "hi"), ("assistant", "yes"), ("user", None), (None, ""), ("user", "bye")]
    rows = [(c, t, *base[t]) for c, n in enumerate((5, 3, 1, 5, 4)) for t in range(n)]
    rows += [(10, t, "user", "hi") for t in range(3)] + [(11, t, "user", "hi") for t in range(2)]
    rows += [(12, 0, "user", ""), (13, 0, "user", None), (14, None, "system", "x"), (14, 3, "user", "y")]
    rows += [(None, 0, "user", "alone"), (None, 1, "assistant", "with null id"), (-1, 0, "user", "alone")]
    rows += [(99, t, rng.choice(["user", "assistant"]), "t" * (t % 7)) for t in range(0, 6000)]
    rows += [(98, t, r[2], r[3]) for t, r in enumerate(rows[-6000:-3000])]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    assert found(df) == plain(rows)
    assert found(df.withColumnRenamed("turn", "place").withColumn("n_turns", df["conv_id"]).withColumnRenamed("place", "turn")) == plain(rows)
    assert chats.format_chats(spark.createDataFrame([], SCHEMA)).count() == 0


def test_equal_turns_have_one_order(spark):
    rows = [(c, 0, "user", x) for c in (1, 2) for x in ("a", "b", "b")]
    got = found(spark.createDataFrame(rows, SCHEMA))
    assert len(got) == 1 and got[0][:2] == (1, 3) and got[0][2].count("b<") == 2
