"""Conversation repair against a search of all cheapest edits, one conversation at a time."""

import functools
import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from starloom.llm import conversations as cv
from starloom.llm import queries
from tests.conftest import SF_SMALL

WS = " \t\n\x0b\x0c\r"
STEP = {"": "u", "s": "u", "u": "a", "a": "u"}  # what may be inserted or reroled after this state


def faults(rows):
    out, seen = [], set()
    for _, role, text in rows:
        bare = text.rstrip(WS)
        if not bare.strip(WS):
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def brute(rows):
    """(turn, role, text) in order -> the columns of the query without conv_id."""
    found = faults(rows)
    sys_limit = 10_000

    @functools.lru_cache(None)
    def best(i, state, inserted):
        """The cheapest (cost, audit, kept rows) from row i on."""
        options = []
        if i == len(rows):
            if state in ("", "a"):
                options.append((0, "", ()))
        else:
            _, role, text = rows[i]
            c, a, k = best(i + 1, state, 0)
            options.append((c + 2, "D" + a, k))
            if found[i] not in ("blank", "duplicate"):
                more = 5 * (found[i] == "truncated")
                first = role[:1]
                if first == STEP[state] or (first == "s" and state == ""):
                    c, a, k = best(i + 1, first, 0)
                    options.append((c + more, "K" + a, ((role, text), *k)))
                c, a, k = best(i + 1, STEP[state], 0)
                options.append((c + 1 + more, "R" + a, (({"u": "user", "a": "assistant"}[STEP[state]], text), *k)))
        if inserted < 4:
            c, a, k = best(i, STEP[state], inserted + 1)
            options.append((c + 5, "I" + a, (({"u": "user", "a": "assistant"}[STEP[state]], ""), *k)))
        return min(options, default=(sys_limit, "", ()))

    for i in range(len(rows), 0, -1):  # from the end, so that no call goes deep
        for state in ("", "s", "u", "a"):
            best(i, state, 0)
    cost, audit, kept = best(0, "", 0)
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    initials = [r[:1] for _, r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    counts = tuple(found.count(f) for f in ("blank", "duplicate", "truncated"))
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest()
    return gaps, *counts, illegal, cost, audit, digest


def in_order(rows):
    """Rows by turn, nulls first; the tests use turns that repeat only for equal rows, as ties go by hash."""
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))


def digest_of(repaired):
    """What the query returns, from the operator's results."""
    audits, lines = defaultdict(list), defaultdict(list)
    for r in repaired.pieces.collect():
        audits[r.conv_id].append((r.block, r.audit))
    for r in repaired.edits.filter("edit <> 'D'").collect():
        lines[r.conv_id].append((r.block, r.step, f"{r.role}:{r.text}"))
    out = {}
    for r in repaired.conversations.collect():
        audit = "".join(a for _, a in sorted(audits[r.conv_id]))
        digest = hashlib.sha256("\n".join(x[-1] for x in sorted(lines[r.conv_id])).encode()).hexdigest()
        out[r.conv_id] = (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, audit, digest)
    return out


def check(spark, by_conv, **options):
    rows = [(c, t, role, text, 1, "x") for c, rs in by_conv.items() for t, role, text in rs]
    random.Random(1).shuffle(rows)
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, seq int, block string")
    got = digest_of(cv.repair(frame, **options))
    want = {c: brute(in_order([(t, " " if r is None else r, " " if x is None else x) for t, r, x in rs])) for c, rs in by_conv.items()}
    assert got == want
    return got


def conversation(rng, n):
    rows, turn = [], rng.choice([0, 0, -3, 7])
    for _ in range(n):
        role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "unknown", ""])
        text = rng.choice(["Hi.", "Yes!", "What?", "cut off", " \n", "", "é?", "A. ", "x\x1f"])
        rows.append((turn, role, text))
        if rng.random() < 0.15:
            rows.append(rows[-1])
        turn += rng.choice([1, 1, 1, 2, 5])
    if rng.random() < 0.2:
        rows.append((None, "user", "No turn."))
    return rows


def test_against_brute_force(spark):
    rng = random.Random(3)
    check(spark, {i: conversation(rng, rng.choice([1, 2, 3, 4, 5, 8, 30])) for i in range(200)})


@pytest.mark.parametrize("block_rows,group", [(2, 2), (3, 2), (7, 256)])
def test_conversations_of_many_blocks(spark, block_rows, group):
    rng = random.Random(block_rows)
    check(spark, {i: conversation(rng, rng.choice([1, 2, 3, 6, 7, 14, 45])) for i in range(40)}, block_rows=block_rows, group=group)


def test_edge_cases(spark):
    long_text = "word " * 100_000 + "."
    got = check(spark, {
        1: [(0, "user", None), (1, None, "A."), (2, None, None)],
        2: [(None, "user", "Q?"), (None, "user", "Q?")],
        3: [(5, "user", long_text), (6, "assistant", long_text), (6, "assistant", long_text)],
        4: [(0, "assistant", "A.")] * 5,
        None: [(0, "user", "Q?"), (1, "assistant", "A.")],
    })
    assert got[None][:7] == (0, 0, 0, 0, 0, 0, "KK")
    assert got[3][6] == "KKD"
    empty = cv.repair(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))
    assert empty.conversations.count() == empty.pieces.count() == empty.edits.count() == 0
    with pytest.raises(ValueError, match="block_rows"):
        cv.repair(spark.createDataFrame([], "conv_id long, turn long, role string, text string"), block_rows=1)


def test_ranks_order_the_audits():
    """The ranks of prefix doubling are those of the audit strings themselves."""
    rng = np.random.default_rng(2)
    codes = rng.choice([0, 1, 2, 3, 5, 6, 9, 13, 14], 60).astype(np.int64)
    blocks = cv.Blocks(codes, np.array([0, 25, 25 + 35]), np.ones(2, bool))
    paths = cv.least_paths(*blocks.arcs(blocks.costs(np.array([cv._END, cv._END]))), cv._longest(blocks))

    def audit(node):
        out = ""
        while paths.letter[node] >= 0:
            out += cv.LETTERS[paths.letter[node]]
            node = paths.jumps[0][node]
        return out

    start = np.arange(blocks.nodes)
    path = paths.nodes(start)
    for node in start:
        letters = paths.letter[path[node]]
        assert "".join(cv.LETTERS[x] for x in letters[letters >= 0]) == audit(node)
    audits = [audit(node) for node in start]
    order = {a: i for i, a in enumerate(sorted(set(audits)))}
    assert [order[a] for a in audits] == paths.rank.tolist()


def test_a_hot_conversation_is_many_tasks(spark):
    """Blocks, not conversations, are the unit of work."""
    rng = random.Random(8)
    rows = [(1, i, rng.choice(["user", "assistant"]), rng.choice(["Hi.", "cut", f"t{i}."])) for i in range(600)]
    repaired = cv.repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), block_rows=16, group=4)
    assert repaired.pieces.count() == 38
    assert max(len(r.audit) for r in repaired.pieces.collect()) <= 3 * 17
    assert digest_of(repaired)[1] == brute(in_order([r[1:] for r in rows]))


def test_query_against_brute_force(spark):
    got = {r.conv_id: tuple(r)[1:] for r in queries.op13_conversation_repair(spark, SF_SMALL).collect()}
    by_conv = defaultdict(list)
    source = spark.read.parquet(f"{SF_SMALL}/conversations.parquet").collect()
    for r in source:
        by_conv[r.conv_id]
        h = zlib.crc32(f"{r.conv_id}:{r.turn}".encode()) % 20
        if h == 0:
            continue
        text = "" if h == 1 else r.text.translate(dict.fromkeys(map(ord, ".!?"))) if h == 2 else r.text
        row = (r.turn, "user" if h == 4 else r.role, text)
        by_conv[r.conv_id] += [row, row] if h == 3 else [row]
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert got == {c: brute(in_order(rs)) if rs else nothing for c, rs in by_conv.items()}
    assert len(got) == len({r.conv_id for r in source}) and any(g[1] for g in got.values())
