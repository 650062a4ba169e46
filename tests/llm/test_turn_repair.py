import hashlib
import heapq
import random
import re
from collections import defaultdict

import edges
import pytest

from tocsin.llm import turn_repair

BLANK = re.compile(r"[^\x20\x09-\x0D]")
GOAL = re.compile(r"(s?(ua)+)?")


def faults(rows):
    """Rows (role, text) in order to their first faults."""
    seen, out = set(), []
    for role, text in rows:
        held = BLANK.findall(text)
        out.append("blank" if not held else "duplicate" if (role, text) in seen else "truncated" if held[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def brute(rows):
    """The least (cost, audit) with what it gives: all edits, cheapest first, no bounds or states."""
    found, heap, most = faults(rows), [(0, "", 0, ())], 4
    while heap:
        cost, audit, i, made = heapq.heappop(heap)
        initials = "".join(r[:1] for r, _ in made)
        if i == len(rows) and GOAL.fullmatch(initials):
            return cost, audit, made
        if not re.fullmatch(r"s?(ua)*u?", initials):
            continue
        if audit[-most:].count("I") < most:
            for role in ("user", "assistant"):
                heapq.heappush(heap, (cost + 2, audit + "I", i, (*made, (role, ""))))
        if i == len(rows):
            continue
        role, text = rows[i]
        heapq.heappush(heap, (cost + 3, audit + "D", i + 1, made))
        if found[i] in ("", "truncated"):
            more = found[i] == "truncated"
            if role[:1]:
                heapq.heappush(heap, (cost + more, audit + "K", i + 1, (*made, (role, text))))
            for new in ("user", "assistant"):
                heapq.heappush(heap, (cost + 2 + more, audit + "R", i + 1, (*made, (new, text))))


def expected(table):
    """{conversation: (gaps, faults, illegal, cost, audit, sha256)}."""
    by = defaultdict(list)
    for c, turn, role, text in table:
        by[c].append((turn is not None, turn, " " if role is None else role, " " if text is None else text))
    out = {}
    for c, rows in by.items():
        rows.sort(key=lambda r: (r[0], r[1] or 0, r[2].encode(), hashlib.md5(r[3].encode()).hexdigest()))
        plain, turns = [r[2:] for r in rows], {r[1] for r in rows if r[0]}
        found = faults(plain)
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(plain, plain[1:]))
        cost, audit, made = brute(plain)
        text = "\n".join(f"{r}:{t}" for r, t in made)
        out[c] = (gaps, *(found.count(k) for k in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())
    return out


def got(df, **options):
    found = turn_repair.repair(df, **options)
    rows = found.summary().join(found.digests(), "c").collect()
    return {
        (int(r.c[1:]) if r.c else None): (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in rows
    }, found


SHAPE = "conv_id long, turn long, role string, text string"


def some_conversations(seed, n, most):
    pick = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(pick.randint(1, most)):
            role = pick.choice(["user", "assistant", "user", "assistant", "system", "usher", "bot", "", None])
            text = pick.choice(["Yes.", "No!", "cut off", " ", "", None, f"own {t}?", f"more {t}", " "])
            turn = pick.choice([t, t, t, t + 3, 1, None])
            rows.append((c if c else None, turn, role, text))
    return rows


@pytest.mark.parametrize("segment", [1, 2, 3, 50_000])
def test_equals_brute_force(spark, segment):
    rows = some_conversations(7, 60, 6)
    found, _ = got(spark.createDataFrame(rows, SHAPE).repartition(3), segment=segment)
    assert found == expected(rows)


def test_search_is_the_least_of_all_audits():
    codes = {("", r): i for r, i in (("user", 2), ("assistant", 3), ("system", 1), ("bot", 0))}
    pick = random.Random(3)
    for _ in range(300):
        rows = []
        for t in range(pick.randint(0, 5)):
            rows.append((pick.choice(["user", "assistant", "system", "bot"]), pick.choice([f"a{t}.", f"b{t}", "", "same."])))
        found = bytes(
            codes["", r] + (turn_repair.MUST_GO if f in ("blank", "duplicate") else turn_repair.CUT if f == "truncated" else 0)
            for (r, _), f in zip(rows, faults(rows))
        )
        cost, audit, _ = brute(rows)
        assert turn_repair.search(found, 0, tuple(turn_repair.END), True) == (audit, turn_repair.search(found, 0, tuple(turn_repair.END), True)[1])
        assert turn_repair.lower_bounds(found, turn_repair.END)[0][0] == cost


def test_long_conversation_over_many_ranges(spark, monkeypatch):
    """One conversation has most of all rows, many of them equal."""
    pick = random.Random(5)
    rows = [(1, t // 2, pick.choice(["user", "assistant", "system"]), pick.choice(["Yes.", f"{t}.", f"{t} cut"])) for t in range(3000)]
    rows += [(1, 17, "user", "again.")] * 500 + some_conversations(9, 10, 4)
    df = spark.createDataFrame(rows, SHAPE).repartition(5)
    whole, _ = got(df)
    monkeypatch.setattr(turn_repair, "ranges", lambda n: 9)
    parts, found = got(df, segment=64)
    assert parts == whole and found.pieces.filter("c = '=1'").count() > 30
    kept = [r for r in found.rows().filter("c = '=1'").orderBy("place").collect()]
    assert "".join(r.edit for r in kept) == whole[1][6]
    made = [(r.role, r.text) for r in kept if r.edit != "D"]
    assert GOAL.fullmatch("".join(r[0] for r, _ in made))
    assert hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest() == whole[1][7]


def test_awkward_texts_and_further_columns(spark):
    rows = [(i, k, ("user", "assistant")[k % 2], t) for k, (i, t, *_) in enumerate(edges.rows()) if i != 10]
    rows += [(900, 0, "user", "z " * 300_000 + "."), (900, 1, "assistant", "é\U0001f600?"), (901, None, "user", "a."), (901, None, None, "b.")]
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SHAPE + ", c string, part int, copies int")
    assert got(df)[0] == expected(rows)


def test_empty_table(spark):
    found, whole = got(spark.createDataFrame([], SHAPE))
    assert found == {} and whole.rows().count() == 0
