import hashlib
import itertools
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from tributary.llm import conversation_repair as cr

LEGAL = re.compile(r"(s?(ua)+)?\Z")


def brute(rows):
    """All edits with up to two insertions a gap: the cheapest, then ASCII-least."""
    best, names = None, {"u": "user", "a": "assistant"}
    gaps = [p for k in range(3) for p in itertools.product("ua", repeat=k)]

    def go(i, audit, roles, cost, out):
        nonlocal best
        for ins in gaps:
            c = cost + 3 * len(ins)
            if best and c > best[0]:
                continue
            a, r, o = audit + "I" * len(ins), roles + "".join(ins), out + [f"{names[x]}:" for x in ins]
            if i == len(rows):
                if LEGAL.match(r) and (best is None or (c, a) < best[:2]):
                    best = (c, a, "\n".join(o))
                continue
            role, text, fault = rows[i]
            more = 3 if fault == "truncated" else 0
            go(i + 1, a + "D", r, c + 4, o)
            if fault in ("blank", "duplicate"):
                continue
            go(i + 1, a + "K", r + role[:1], c + more, [*o, f"{role}:{text}"])
            for x in "ua":
                go(i + 1, a + "R", r + x, c + 3 + more, [*o, f"{names[x]}:{text}"])

    go(0, "", "", 0, [])
    return best[0], best[1], hashlib.sha256(best[2].encode()).hexdigest()


@pytest.mark.parametrize("segment", [1, 2, 256])
def test_integer_paths_equal_brute_force(monkeypatch, segment):
    monkeypatch.setattr(cr, "SEGMENT", segment)
    rnd = random.Random(segment)
    for _ in range(250):
        rows = [(rnd.choice(["system", "user", "assistant", "tool", " "]), rnd.choice(["x.", "y", "é"]), rnd.choice([None, None, "truncated", "blank", "duplicate"])) for _ in range(rnd.randint(0, 4))]
        work = cr.Repair()
        for r in rows:
            work.feed(*r)
        assert work.result() == brute(rows), rows


def test_segments_do_not_change_long_conversations(monkeypatch):
    rnd = random.Random(8)
    rows = [(rnd.choice(["user", "assistant", "tool", "system"]), "t.", rnd.choice([None, None, "truncated", "blank"])) for _ in range(700)]
    seen = set()
    for segment in (3, 64, 256):
        monkeypatch.setattr(cr, "SEGMENT", segment)
        work = cr.Repair()
        for r in rows:
            work.feed(*r)
        seen.add(work.result())
    # one integer over the whole conversation
    monkeypatch.setattr(cr, "SEGMENT", 1000)
    monkeypatch.setattr(cr, "WIDTH", 3003)
    work = cr.Repair()
    for r in rows:
        work.feed(*r)
    assert seen == {work.result()}
    assert len(work.result()[1]) >= 700


def sql(conversations):
    con = duckdb.connect()
    con.register("conversations", conversations)
    return sorted(con.sql(cr.repair_sql()).fetchall(), key=str)


def got(df):
    return sorted((tuple(r) for r in cr.repair(df, damaged=True).collect()), key=str)


def test_equals_the_sql_on_the_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    assert got(df) == sql(df.toArrow())


def test_equals_the_sql_on_random_and_hot_conversations(spark):
    """Nulls, gaps, ties, other roles, odd texts, and one conversation with a
    third of all rows."""
    rnd, rows = random.Random(2), []
    for c in [*range(120), None]:
        for _ in range(rnd.randint(1, 14) if c != 5 else 400):
            rows.append((c, rnd.choice([None, *range(-3, 300)]), rnd.choice(["user", "assistant", "system", "tool", "", None, "Agent"]),
                         rnd.choice([None, "", " \n", "hello there", "so it is.", "done! \x0b", "why?\n", "é…", "same."])))
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("fault", F.lit("clash")).repartition(6)
    assert got(df) == sql(df.drop("fault").toArrow())


def test_undamaged_input_and_empty_tables(spark):
    rows = [("a", 0, "user", "hi."), ("a", 1, "assistant", "yes."), ("b", 3, "assistant", "no"), ("c", None, None, None)]
    df = spark.createDataFrame(rows, "conv_id string, turn int, role string, text string")
    out = {r.conv_id: r for r in cr.repair(df).collect()}
    assert out["a"].audit == "KK" and out["a"].cost == 0 and out["a"].repaired_sha256 == hashlib.sha256(b"user:hi.\nassistant:yes.").hexdigest()
    assert out["b"].audit == "D" and out["b"].truncated == 1 and out["b"].repaired_sha256 == hashlib.sha256(b"").hexdigest()
    assert out["c"].blank == 1 and out["c"].gaps == 0
    assert cr.repair(df.limit(0), damaged=True).collect() == []
