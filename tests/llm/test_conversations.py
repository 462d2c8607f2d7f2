import hashlib
import random
import re
import sys
import zlib

import pytest

from gridlake.llm import conversations as c

SHAPE = "conv_id long, turn long, role string, text string, part int, seg string, copies long"


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if fault:
            text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
            out += [(conv, turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    return out


def brute(rows):
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, sha) of one conversation's rows: all edits, by memo."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
    seen, faults = set(), []
    for _, _, role, text in rows:
        bare = text.strip(" \t\n\v\f\r")
        faults.append("b" if not bare else "d" if (role, text) in seen else "t" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    memo = {}

    def best(i, s):
        """(cost, edits, rows) to come from row i on; s is the last initial given."""
        todo, got = [(i, s, 0, "", ())], None
        if (i, s) in memo:
            return memo[i, s]
        options = []
        for s2, cost, edits, made in inserted(s):
            if i == len(rows):
                if s2 in ("", "a"):
                    options.append((cost, edits, made))
                continue
            _, _, role, text = rows[i]
            ways = [("D", 3, s2, ())]
            if faults[i] not in ("b", "d"):
                more = faults[i] == "t"
                if (s2, role[:1]) in (("", "s"), ("", "u"), ("s", "u"), ("a", "u"), ("u", "a")):
                    ways.append(("K", more, role[:1], (f"{role}:{text}",)))
                new = "assistant" if s2 == "u" else "user"
                ways.append(("R", 2 + more, new[0], (f"{new}:{text}",)))
            for e, price, to, row in ways:
                rest = best(i + 1, to)
                options.append((cost + price + rest[0], edits + e + rest[1], made + row + rest[2]))
        memo[i, s] = min(options)
        return memo[i, s]

    def inserted(s):
        out = [(s, 0, "", ())]
        for n in range(1, 4):
            new = "assistant" if out[-1][0] == "u" else "user"
            out.append((new[0], 2 * n, "I" * n, out[-1][3] + (f"{new}:",)))
        return out

    cost, audit, made = best(0, "")
    turns = [r[1] for r in rows if r[1] is not None]
    pairs = zip(rows, rows[1:])
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("b"), faults.count("d"), faults.count("t"),
            sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in pairs), cost, audit,
            hashlib.sha256("\n".join(made).encode()).hexdigest())


def expected(rows, after):
    return {conv: brute([r for r in after if r[0] == conv]) for conv in {r[0] for r in rows}}


def got(spark, rows, segment_rows=4096):
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SHAPE).repartition(3)
    out = c.repair_report(c.damage(df), df, segment_rows)
    assert out.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return {r[0]: tuple(r)[1:] for r in out.collect()}


def sample(n, seed, longest=12):
    r = random.Random(seed)
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "uma"]
    texts = ["Hello.", "no end", "What? ", "", " \t", None, "a b!\n", "Fine.", "x.y"]
    return [(conv, r.choice([t, t, t + r.randint(0, 2), None]), r.choice(roles[:4] if conv % 2 else roles),
             f"{r.choice(texts) or ''}{r.choice(['', '', t])}" if r.random() < .9 else None)
            for conv in range(n) for t in range(r.randint(0, longest))]


@pytest.mark.parametrize("rows_at_once", [4096, 3])
def test_against_brute_force(spark, rows_at_once):
    rows = sample(120, 1) + [(None, 1, "user", "a."), (None, None, "assistant", "b"), (None, 1, "user", "a.")]
    rows += [(500, None, None, None), (501, 7, "system", "only."), (502, 7, "user", "日本。é")]
    want = expected(rows, damaged(rows))
    have = got(spark, rows, rows_at_once)
    assert have.keys() == want.keys()
    for conv in want:
        assert have[conv] == want[conv], (conv, [r for r in damaged(rows) if r[0] == conv])


def test_a_long_conversation_is_split(spark):
    r = random.Random(4)
    rows = [(1, t, r.choice(["user", "assistant", "system"]), r.choice(["Yes.", "no", f"turn {t}."])) for t in range(900)]
    rows += [(1, 950, "user", "the same.")] * 100 + [(2, t, "user", "again.") for t in range(200)] + sample(10, 9)
    df = spark.createDataFrame([(*x, 1, "x", 2) for x in rows], SHAPE).repartition(5)
    after = damaged(rows)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    pieces = c.repair(c.damage(df), segment_rows=16)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert pieces.filter("conv_id = 1 and not whole").select("part").distinct().count() > 1
    assert pieces.filter("length(edits) > 60").count() == 0
    out = {x[0]: tuple(x)[1:] for x in c.report(pieces).collect()}
    sys.setrecursionlimit(20_000)                # of the brute force
    for conv, found in out.items():
        assert found == brute([x for x in after if x[0] == conv]), conv
    rows_out = c.turns(pieces).filter("conv_id = 1").orderBy("part", "seg", "place").collect()
    assert hashlib.sha256("\n".join(f"{x.role}:{x.text}" for x in rows_out).encode()).hexdigest() == out[1][-1]


def test_tables_equal_the_plain_recurrence():
    vectors, table = c.tables()
    assert len(vectors) == 16 and len(table) == 1 + 9 + 81 + 729 + 6561
    r = random.Random(0)
    for _ in range(300):
        symbols = bytes(r.randrange(9) for _ in range(r.randint(0, 30)))
        plain = vectors[0]
        for s in reversed(symbols):
            plain = c._before(s, plain)
        edits, state, cost = c.edits_of(symbols)
        assert cost == plain[c.START] and state in c.FINAL and sum(e != "I" for e in edits) == len(symbols)


def test_edges(spark):
    assert got(spark, []) == {}
    empty = hashlib.sha256(b"").hexdigest()
    dropped = next(i for i in range(100) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    kept = next(i for i in range(100) if zlib.crc32(f"{i}:0".encode()) % 20 > 4)
    found = got(spark, [(dropped, 0, "user", "x."), (kept, 0, "assistant", " ")])
    assert found[dropped] == (0, 0, 0, 0, 0, 0, "", empty)
    assert found[kept] == (0, 1, 0, 0, 0, 3, "D", empty)
    long = [(kept, 0, "user", "word " * 500_000 + "."), (kept, 1, "assistant", "z" * 2_000_000)]
    assert got(spark, long)[kept] == expected(long, damaged(long))[kept]
