"""Repair of conversations against a search over all edits."""

import hashlib
import random
import re
import zlib
from itertools import product

import pytest

from freightlake.llm import common, conversations, queries

FORM = re.compile(r"(s?(ua)+)?\Z")
BLANK = " \t\n\x0b\x0c\r"


def damaged(rows):
    out = {}
    for conv, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        name = ":".join(" " if v is None else str(v) for v in (conv, turn))
        kind = zlib.crc32(name.encode()) % 20
        own = out.setdefault(conv, [])
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        own += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    order = lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest())
    return {conv: sorted(own, key=order) for conv, own in out.items()}


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        bare = text.strip(BLANK)
        if not bare:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("" if bare[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def search(rows, found):
    """Least cost, audit and lines, from row to row by the role initials so far."""
    open_ends = {"": (0, "", ())}

    def better(ends, initials, cell):
        key = initials if len(initials) < 2 else ("p" if initials[-1] == "a" else "q")
        if FORM.match(initials) or FORM.match(initials + "a") or FORM.match(initials + "ua"):
            if key not in ends or cell < ends[key]:
                ends[key] = cell

    full = {"p": "ua", "q": "uau"}

    def with_inserts(ends):
        for _ in range(2):
            for key, (cost, audit, lines) in list(ends.items()):
                for role in ("user", "assistant"):
                    better(ends, full.get(key, key) + role[0], (cost + 5, audit + "I", (*lines, (role, ""))))
        return ends

    for (_, role, text), fault in zip(rows, found):
        ends = {}
        for key, (cost, audit, lines) in with_inserts(dict(open_ends)).items():
            initials = full.get(key, key)
            cell = (cost + 2, audit + "D", lines)
            if key not in ends or cell < ends[key]:
                ends[key] = cell
            if fault in ("blank", "duplicate"):
                continue
            extra = 5 if fault == "truncated" else 0
            for new, price, name in ((role, 0, "K"), ("user", 1, "R"), ("assistant", 1, "R")):
                cell = (cost + price + extra, audit + name, (*lines, (new, text)))
                # A role without an initial has no place in the pattern.
                better(ends, initials + (new[:1] or "?"), cell)
        open_ends = ends
    whole = [c for k, c in with_inserts(open_ends).items() if FORM.match(full.get(k, k))]
    return min(whole)


def expected(rows):
    out = []
    for conv, own in damaged(rows).items():
        found = faults(own)
        turns = [t for t, *_ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        initials = [r[:1] for _, r, _ in own]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit, lines = search(own, found)
        text = "\n".join(f"{r}:{t}" for r, t in lines)
        sha = hashlib.sha256(text.encode()).hexdigest()
        counts = [found.count(f) for f in ("blank", "duplicate", "truncated")]
        out.append((conv, gaps, *counts, illegal, cost, audit, sha))
    return sorted(out, key=str)


def repaired(make, rows, extra=False):
    schema = "conv_id long, turn long, role string, text string"
    frame = make(rows, schema)
    if extra:
        frame = frame.selectExpr("*", "1 AS n", "'x' AS audit", "2 AS part", "turn AS fault")
    got = conversations.repair(conversations.damaged(frame))
    return sorted(map(tuple, got.collect()), key=str)


def test_every_short_conversation_by_all_edits():
    """Cells against all sequences of edits, insertions included."""
    kinds = list(product(("s", "u", "a", "x"), (0, 1, 3)))
    for size in (1, 2):
        for rows in product(kinds, repeat=size):
            whole = conversations.parsed([conversations.unit(*r) for r in rows])
            best = None
            for inserts in product(("", "u", "a", "ua", "au"), repeat=size + 1):
                offered = [
                    [("D", 2, "")] + ([] if f == 1 else [
                        (n, p + (5 if f == 3 else 0), r)
                        for n, p, r in (("K", 0, i), ("R", 1, "u"), ("R", 1, "a"))
                    ])
                    for i, f in rows
                ]
                for edits in product(*offered):
                    initials, audit, cost = inserts[0], "I" * len(inserts[0]), 0
                    for (name, price, role), ins in zip(edits, inserts[1:]):
                        initials, audit = initials + role + ins, audit + name + "I" * len(ins)
                        cost += price
                    cell = (cost + 5 * sum(map(len, inserts)), audit)
                    if FORM.match(initials) and (best is None or cell < best):
                        best = cell
            assert conversations.cheapest(whole) == best, rows


def test_combination_does_not_depend_on_splits():
    draws = random.Random(3)
    units = [conversations.unit(draws.choice("suax"), draws.choice((0, 0, 1, 2, 3))) for _ in range(41)]
    one = units[0]
    for other in units[1:]:
        one = conversations.combined(one, other)
    assert conversations.parsed(units) == one
    copies = [units[0]] * 13
    assert conversations.repeated(units[0], 13) == conversations.parsed(copies)


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_search(make, seed):
    draws = random.Random(seed)
    texts = ["Yes.", "No!", "What?", "cut of", "", "  ", "Well. \n", "é.", "a.b"]
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", "u"]
    rows = []
    for conv in range(150):
        for turn in range(draws.randrange(9)):
            rows.append((conv, turn, draws.choice(roles), f"{draws.choice(texts)}"))
    rows += [(900, t, draws.choice(roles[:5]), f"{t}.") for t in range(700)]
    assert repaired(make, rows, extra=True) == expected(rows)


def test_odd_rows(make):
    rows = [(None, None, None, None), (None, 1, "user", "Hi."), (None, 2, "assistant", "Ho.")]
    rows += [(1, None, "user", "Hi."), (1, None, "user", "Hi."), (1, 3, "assistant", "Ho.")]
    rows += [(2, 5, "user", None), (3, 0, "user", "x" * 300_000 + "."), (3, 1, "assistant", "y" + " " * 9)]
    rows += [(4, t, "user", "same.") for t in range(40)] + [(5, 7, "user", "one.")] * 30
    rows += [(6, t, "user", "a.") for t in (0, 0, 9)]
    assert repaired(make, rows) == expected(rows)
    assert repaired(make, []) == []


def test_dropped_conversations_remain(make):
    gone = [(c, 0) for c in range(400) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    rows = [(c, t, "user", "Hi.") for c, t in gone]
    none = hashlib.sha256(b"").hexdigest()
    assert rows and repaired(make, rows) == sorted(
        ((c, 0, 0, 0, 0, 0, 0, "", none) for c, _ in gone), key=str
    )


def test_query_equals_search(spark, sf_dir):
    rows = common.table(spark, sf_dir, "conversations").collect()
    want = expected([(r.conv_id, r.turn, r.role, r.text) for r in rows])
    got = queries.op11_conversation_repair(spark, sf_dir)
    assert sorted(map(tuple, got.collect()), key=str) == want and want
