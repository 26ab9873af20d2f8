"""Repair of conversations against a search over all edits, row by row."""

import hashlib
import heapq
import itertools
import random
import re
import zlib

import pytest
from corpus_cases import SF, rows  # noqa: F401

from shelfprice.llm.conversations import apply_edits, cheapest, damage, repair, repair_report, report_on_all

PATTERN = re.compile("(s?(ua)+)?")


def searched(kinds):
    """The smallest (cost, audit) over edit sequences, by uniform-cost search over (rows read, roles written)."""
    heap, best = [(0, "", 0, "")], None
    done = set()
    while heap:
        cost, audit, i, roles = heapq.heappop(heap)
        if best is not None and (cost, audit) >= best:
            return best
        if i == len(kinds) and PATTERN.fullmatch(roles):
            best = (cost, audit)
            continue
        state = (i, roles[-1:], roles[:1] == "s" and len(roles) == 1)
        if (state, audit) in done or roles.count("s") > 1:
            continue
        done.add((state, audit))
        if re.fullmatch("s?(ua)*u?", roles) is None:
            continue
        for r in "ua":
            if len(roles) <= len(kinds) + 2:
                heapq.heappush(heap, (cost + 2, audit + "I", i, roles + r))
        if i < len(kinds):
            initial, gone, truncated = kinds[i]
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, roles))
            if not gone:
                heapq.heappush(heap, (cost + truncated, audit + "K", i + 1, roles + (initial or "x")))
                for r in "ua":
                    heapq.heappush(heap, (cost + 2 + truncated, audit + "R", i + 1, roles + r))
    return best


def test_cells_equal_a_search_over_all_edits():
    kinds = [(i, g, t) for i in ("s", "u", "a", "x") for g, t in ((False, False), (False, True), (True, False))]
    random.seed(5)
    cases = [list(c) for n in range(3) for c in itertools.product(kinds, repeat=n)] + [random.choices(kinds, k=random.randint(3, 6)) for _ in range(300)]
    for case in cases:
        assert cheapest(case) == searched(case), case


def dynamic(kinds):
    """(cost, audit) by rows from left to right, over the roles that may come next."""
    follows = {"": "su", "s": "u", "u": "a", "a": "u"}
    now = {"": (0, "")}

    def insert(cells):
        for _ in range(3):
            for last, (cost, audit) in list(cells.items()):
                for r in set(follows[last]) & set("ua"):
                    cells[r] = min(cells.get(r, (cost + 2, audit + "I")), (cost + 2, audit + "I"))
        return cells

    for initial, gone, truncated in kinds:
        new = {}
        for last, (cost, audit) in insert(now).items():
            ways = [(last, cost + 3, "D")]
            if not gone:
                ways += [(r, cost + 2 + truncated, "R") for r in set(follows[last]) & set("ua")]
                ways += [(initial, cost + truncated, "K")] if initial in follows[last] and initial else []
            for r, c, e in ways:
                new[r] = min(new.get(r, (c, audit + e)), (c, audit + e))
        now = new
    return min(v for k, v in insert(now).items() if k in ("", "a"))


def expected(data):
    """What the contract says about each conversation of (conv_id, turn, role, text)."""
    by: dict = {}
    for conv, turn, role, text in data:
        by.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    out = []
    for conv, held in by.items():
        held.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, faults = set(), []
        for _, role, text in held:
            visible = re.sub("[\x20\x09-\x0d]", "", text)
            faults.append("blank" if not visible else "duplicate" if (role, text) in seen else "truncated" if visible[-1] not in ".!?" else "")
            seen.add((role, text))
        initials = [r[:1] for _, r, _ in held]
        cost, audit = dynamic([(i, f in ("blank", "duplicate"), f == "truncated") for i, f in zip(initials, faults, strict=True)])
        turns = [t for t, _, _ in held if t is not None]
        lines = [f"{r}:{x}" for _, r, x in apply_edits([(r, x) for _, r, x in held], audit)]
        assert PATTERN.fullmatch("".join(line[0] for line in lines))
        assert len(audit.replace("I", "")) == len(held)
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials[:-1], initials[1:], strict=True))
        sha = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out.append((conv, gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit, sha))
    return sorted(out, key=str)


def held(frame):
    return [(r.conv_id, r.turn, r.role, r.text) for r in frame.select("conv_id", "turn", "role", "text").collect()]


ODD = [
    (1, None, None, None),
    (1, None, "user", "first?"),
    (1, 5, "assistant", "later."),
    (1, 5, "assistant", "later."),
    (1, 5, "ape", "Later"),
    (None, 0, "user", "no id."),
    (None, 1, "assistant", "no id either."),
    (2, 0, "system", "\t \n"),
    (2, 3, "system", "set up."),
    (2, 4, "", "nobody."),
    (2, 6, "system", "again."),
    (3, 0, "tool", "x"),
    (4, 0, "user", "  "),
    (5, -3, "assistant", "é!\n"),
    (5, 2**40, "user", "é"),
    *((6, i % 7, ["user", "assistant", "system"][i % 3], f"turn {i % 11}{'.' * (i % 2)}") for i in range(90)),
    *((7, None, "user", "copies.") for _ in range(40)),
    (8, 0, "user", "long? " * 60_000),
    (8, 1, "assistant", "long " * 60_000 + "\n"),
]


@pytest.fixture(scope="module")
def odd(spark):
    frame = spark.createDataFrame(ODD, "conv_id long, turn long, role string, text string")
    return frame.selectExpr("*", "1 as task", "2 as piece", "'x' as copies", "'y' as of", "3 as start", "4 as code")


@pytest.fixture(scope="module")
def damaged(spark):
    return damage(spark.read.parquet(f"{SF}/conversations.parquet"))


@pytest.mark.parametrize("options", [{}, {"most_rows": 3}, {"most_bytes": 40}])
def test_reports_equal_brute_force(spark, odd, damaged, options):
    for frame in (odd, damaged):
        assert rows(repair_report(frame, **options)) == expected(held(frame))


@pytest.mark.parametrize("most_rows", [4, 4096])
def test_repaired_turns_have_the_digest(odd, most_rows):
    found: dict = {}
    for r in sorted(repair(odd, most_rows=most_rows).collect(), key=lambda r: r.position):
        found.setdefault(r.conv_id, []).append(r)
    for conv, *_, audit, sha in expected(held(odd)):
        turns = found.get(conv, [])
        assert [r.position for r in turns] == list(range(len(turns)))
        assert "".join(r.edit for r in turns) == audit.replace("D", "")
        assert hashlib.sha256("\n".join(f"{r.role}:{r.text}" for r in turns).encode()).hexdigest() == sha


def test_damage_follows_the_hash(spark):
    data = [(c, t, None if t == 3 else "assistant", f"a. {t}! b?") for c in (None, *range(40)) for t in (None, *range(5))]
    frame = spark.createDataFrame(data, "conv_id long, turn long, role string, text string")
    want = []
    for c, t, role, text in data:
        code = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        row = (c, t, "user" if code == 4 else role or " ", "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text)
        want += [row] * {0: 0, 3: 2}.get(code, 1)
    assert sorted(held(damage(frame)), key=str) == sorted(want, key=str)


def test_conversations_without_rows_are_reported(spark):
    turns = spark.createDataFrame([(1, 0, "user", "a."), (2, 0, "user", "b."), (None, 0, "user", "c.")], "conv_id long, turn long, role string, text string")
    found = rows(report_on_all(turns, turns.filter("conv_id = 1")))
    none = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert found == sorted([(2, *none), (None, *none), *expected(held(turns.filter("conv_id = 1")))], key=str)
    assert report_on_all(turns.limit(0), turns.limit(0)).count() == 0
    assert repair(turns.limit(0)).count() == 0
