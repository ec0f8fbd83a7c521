"""Repaired conversations against a search from the end, and the survivors' tree against all paths."""

import hashlib
import itertools
import random
import re
import zlib
from functools import lru_cache

import pytest
from helpers import table

from gleanfield.llm import dialogue

SCHEMA = "conv_id long, turn long, role string, text string, fault string, segment int, edit string"
AFTER = {"": ("user", "u"), "s": ("user", "u"), "u": ("assistant", "a"), "a": ("user", "u")}
MAY = {"": "su", "s": "u", "u": "a", "a": "u"}
BLANK = re.compile(r"[\x20\x09-\x0D]*\Z")
ENDED = re.compile(r"[.!?][\x20\x09-\x0D]*\Z")


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1, "x") for r in rows], SCHEMA).repartition(3)


def spoilt(rows):
    out = []
    for conv, turn, role, text in rows:
        space = lambda v: " " if v is None else v
        kind, role, text = zlib.crc32(f"{space(conv)}:{space(turn)}".encode()) % 20, space(role), space(text)
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            out += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return sorted(out, key=lambda t: (t[0] is not None, t[0] or 0, t[1], hashlib.md5(t[2].encode()).hexdigest()))


def faults_of(rows):
    seen, out = set(), []
    for _, role, text in rows:
        fault = "blank" if BLANK.match(text) else "duplicate" if (role, text) in seen else None if ENDED.search(text) else "truncated"
        seen.add((role, text))
        out.append(fault)
    return out


def cheapest(rows, faults):
    """The least (cost, audit) and its lines, by the best way on from each place."""

    @lru_cache(None)
    def on(i, last, inserted):
        ways = []
        if i == len(rows) and last in ("", "a"):
            ways.append((0, "", ()))
        if inserted < 2:
            role, initial = AFTER[last]
            c, a, lines = on(i, initial, inserted + 1)
            ways.append((c + 3, "I" + a, (f"{role}:", *lines)))
        if i < len(rows):
            _, role, text = rows[i]
            c, a, lines = on(i + 1, last, 0)
            ways.append((c + 4, "D" + a, lines))
            if faults[i] in (None, "truncated"):
                more = 3 if faults[i] else 0
                if role[:1] and role[:1] in MAY[last]:
                    c, a, lines = on(i + 1, role[:1], 0)
                    ways.append((c + more, "K" + a, (f"{role}:{text}", *lines)))
                new, initial = AFTER[last]
                c, a, lines = on(i + 1, initial, 0)
                ways.append((c + more + 3, "R" + a, (f"{new}:{text}", *lines)))
        return min(ways, default=(10**9, "", ()))

    for i in range(len(rows), 0, -1):  # from the end, so that no call goes deep
        for last in AFTER:
            on(i, last, 0)
    return on(0, "", 0)


def brute(rows):
    for conv in {r[0] for r in rows}:
        turns = spoilt([r for r in rows if r[0] == conv])
        faults = faults_of(turns)
        named = [t[0] for t in turns if t[0] is not None]
        cost, audit, lines = cheapest(turns, faults)
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(turns, turns[1:])]
        yield {
            "conv_id": conv, "gaps": max(named) - min(named) + 1 - len(set(named)) if named else 0,
            **{f: faults.count(f) for f in ("blank", "duplicate", "truncated")},
            "illegal": sum(p not in ("su", "ua", "au") for p in pairs), "cost": cost, "audit": audit,
            "repaired_sha256": hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        }


def check(df, **segment):
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    got = [r.asDict() for r in dialogue.report(df, **segment).collect()]
    key = lambda r: repr(sorted(r.items()))
    assert sorted(map(key, got)) == sorted(map(key, brute(rows)))
    return got


def random_rows(seed, conversations, longest):
    rng = random.Random(seed)
    roles = ["user", "user", "user", "assistant", "assistant", "assistant", "system", "tool", "", None, "sage"]
    texts = ["Yes.", "No", "", " \t", "Why?", "a b", "Why? ", None, "x\n.\n"]
    return [
        (rng.choice([None, *range(conversations)]) if i == 0 else conv, rng.choice([None, t, t, t, t // 2]), rng.choice(roles), rng.choice(texts) if rng.random() < 0.4 else f"Text {rng.randrange(50)}{rng.choice('.!? x')}")
        for conv in range(conversations)
        for i, t in enumerate(range(rng.randrange(1, longest)))
    ]


@pytest.mark.parametrize("segment", [{}, {"segment_rows": 1}, {"segment_rows": 3}, {"segment_bytes": 20}])
def test_random_conversations_in_segments_of_any_size(spark, segment):
    check(conversations(spark, random_rows(len(segment) + sum(segment.values()), 150, 12)), **segment)


def test_conversations_of_the_table(spark):
    check(table(spark, "conversations", "/root/testdata/sf0.01"))


def test_one_conversation_holds_most_rows(spark):
    rows = random_rows(5, 40, 5) + [(7, t, ("user", "assistant")[t % 2], f"Text {t % 90}.") for t in range(600)]
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        check(conversations(spark, rows), segment_rows=50)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_odd_rows(spark):
    long_text = "word " * 200_000
    rows = [(1, 0, "user", long_text), (1, 1, "assistant", long_text + "."), (None, None, None, None), (None, None, None, None)]
    rows += [(2, 5, "user", "Same.")] * 4 + [(3, 2**62, "user", "A."), (3, -(2**62), "assistant", "B."), (4, None, "user", " ")]
    check(conversations(spark, rows))


def test_no_rows(spark):
    assert check(conversations(spark, [])) == []


def test_repaired_turns(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "assistant", "Hello."), (1, 2, "user", "Hi"), (1, 3, "tool", "Fine."), (1, 4, "assistant", "")]
    got = dialogue.repair(conversations(spark, rows)).orderBy("conv_id", "segment", "place").collect()
    assert [(r["edit"], r["old_role"], r["role"], r["text"], r["fault"]) for r in got] == [
        ("K", "system", "system", "Be kind.", None), ("I", None, "user", "", None), ("K", "assistant", "assistant", "Hello.", None),
        ("K", "user", "user", "Hi", "truncated"), ("R", "tool", "assistant", "Fine.", None), ("D", "assistant", None, "", "blank"),
    ]


@pytest.mark.parametrize("seed", range(40))
def test_survivors_equal_all_paths(seed):
    """Random costs and labels of one length a step; the tree holds nothing that all survivors share."""
    rng = random.Random(seed)
    steps = [[(p, q, rng.randrange(3), rng.choice("ab")) for p in range(3) for q in range(3) if rng.random() < 0.6] for _ in range(6)]
    found = dialogue.Survivors(0)
    for edges in steps:
        found.step(edges, {})
    want = {}
    for way in itertools.product(*steps):
        if way[0][0] == 0 and all(a[1] == b[0] for a, b in zip(way, way[1:])):
            path = (sum(e[2] for e in way), "".join(e[3] for e in way))
            want[way[-1][1]] = min(want.get(way[-1][1], path), path)
    assert found.ends() == want
    assert found.root.refs != 1 or len(found.heads) < 2


def test_edits_are_given_out_while_turns_come():
    turns = [{"role": r, "fault": None} for _ in range(500) for r in ("user", "assistant")]
    found = dialogue.search(turns, 0)
    assert len(found.done) > 990 and all(len(found.open_text(n)) < 10 for _, n in found.heads.values())
