"""Structure repair against an exhaustive search by remaining rows."""
import hashlib
import random
import re
import zlib
from collections import defaultdict
from functools import cache

import pytest
from llm_helpers import TURN_EDGE, turns_frame

from sigshape.llm.queries import QUERIES
from sigshape.llm.structure_repair import (BLANK, CUT, DUPLICATE, NONE, damaged, edited, estimates, repair, repair_conversations)


def brute_audit(kinds, faults):
    """Least (cost, audit) over all edits, by the grammar's own regular expression on role initials."""
    @cache
    def best(i, tail, inserted):
        """tail: role initials so far, cut to what the grammar looks back at."""
        out = []
        if i == len(kinds) and tail in ("", "a"):
            out.append((0, ""))

        def go(cost, letter, j, new, k):
            if new is not None:
                rest = best(j, new, k)
                if rest is not None:
                    out.append((cost + rest[0], letter + rest[1]))

        def follow(c):
            return c if re.fullmatch("s|u|su|au|ua", tail + c) and (c != "s" or tail == "") and not (tail == "" and c == "a") else None

        if inserted < 3:
            for c in "ua":
                go(5, "I", i, follow(c), inserted + 1)
        if i < len(kinds):
            go(2, "D", i + 1, tail, 0)
            if faults[i] in (NONE, CUT):
                more = 5 if faults[i] == CUT else 0
                go(more, "K", i + 1, follow(kinds[i]), 0)
                for c in "ua":
                    go(1 + more, "R", i + 1, follow(c), 0)
        return min(out, default=None)

    return best(0, "", 0)


@pytest.mark.parametrize("seed", range(6))
def test_the_search_finds_the_least(seed):
    rng = random.Random(seed)
    for _ in range(400):
        n = rng.randint(0, 9)
        kinds = "".join(rng.choice(["sua", "ua", "uuua-", "s-"][seed % 4]) for _ in range(n))
        faults = bytes(rng.choice([NONE] * 4 + [BLANK, DUPLICATE, CUT] * (seed % 3)) for _ in range(n))
        assert repair(kinds, faults) == brute_audit(kinds, faults), (kinds, faults)


def test_estimates_never_exceed_the_cost():
    rng = random.Random(7)
    for _ in range(500):
        n = rng.randint(0, 8)
        kinds, faults = "".join(rng.choice("sua-") for _ in range(n)), bytes(rng.choice([0, 0, 0, 1, 2, 3]) for _ in range(n))
        ahead = estimates(kinds, faults)
        assert ahead[0] <= brute_audit(kinds, faults)[0]


def test_by_hand():
    assert repair("ua", bytes(2)) == (0, "KK") and repair("s", bytes(1)) == (2, "D")
    assert repair("u", bytes(1)) == (2, "D") and repair("sua", bytes(3)) == (0, "KKK")
    assert repair("uu", bytes(2)) == (1, "KR") and repair("uau", bytes(3)) == (2, "KKD")
    assert repair("au", bytes(2)) == (2, "RR") and list(edited("uu", "KR")) == [(0, False, None), (1, False, "assistant")]
    assert list(edited("u", "KI")) == [(0, False, None), (1, True, "assistant")]


def test_long_conversations():
    n = 3000
    assert repair("ua" * n, bytes(2 * n)) == (0, "K" * 2 * n)
    assert repair("u" * 800, bytes(800)) == (400, "KR" * 400)
    assert repair("sua" + "ua" * n, bytes([BLANK]) + bytes(2 * n + 2)) == (2, "D" + "K" * (2 * n + 2))


def brute(rows, damage=True):
    convs, every = defaultdict(list), {r[0] for r in rows}
    for c, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        hit = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20 if damage else 9
        if hit == 1:
            text = ""
        elif hit == 2:
            text = re.sub("[.!?]", "", text)
        elif hit == 4:
            role = "user"
        for _ in range({0: 0, 3: 2}.get(hit, 1)):
            convs[c].append((turn is not None, turn or 0, role, text))
    out = []
    for c in every:
        x = sorted(convs[c])
        faults, seen = [], set()
        for _, _, role, text in x:
            shown = text.strip(" \t\n\x0b\x0c\r")
            faults.append(BLANK if not shown else DUPLICATE if (role, text) in seen else CUT if shown[-1] not in ".!?" else NONE)
            seen.add((role, text))
        kinds = [r[:1] if r[:1] in ("s", "u", "a") else "-" for _, _, r, _ in x]
        pairs = [x[i][2][:1] + x[i + 1][2][:1] for i in range(len(x) - 1)]
        cost, audit = brute_audit("".join(kinds), bytes(faults))
        lines = [(role or x[i][2]) + ":" + ("" if new else x[i][3]) for i, new, role in edited("".join(kinds), audit)]
        turns = [t for known, t, _, _ in x if known]
        out.append((c, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count(BLANK), faults.count(DUPLICATE),
                    faults.count(CUT), sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
                    hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
                                                "repaired_sha256").collect()), key=repr)


def random_turns(seed, n):
    rng = random.Random(seed)
    return [(c, rng.choice([t, t * 2, None]), rng.choice(["system", "user", "assistant", "user", "tool", "", None]),
             rng.choice(["A b.", "A b.", "Well!", "open", " \t", "", None, "Is it? \n", "é?"]))
            for c in range(n) for t in range(rng.randint(1, 8))]


@pytest.mark.parametrize("rows", [TURN_EDGE, random_turns(1, 150)])
def test_query(spark, tmp_path, rows):
    turns_frame(spark, rows).write.parquet(f"{tmp_path}/conversations.parquet")
    assert got(QUERIES["op12_structure_repair"](spark, str(tmp_path))) == brute(rows)


def test_empty_table_and_the_widest_gap(spark, tmp_path):
    turns_frame(spark, []).write.parquet(f"{tmp_path}/conversations.parquet")
    assert QUERIES["op12_structure_repair"](spark, str(tmp_path)).collect() == []
    rows = [(9, -(1 << 63), "user", "a."), (9, (1 << 63) - 1, "assistant", "b.")]
    report = repair_conversations(turns_frame(spark, rows)).report.collect()
    assert [(r.gaps, r.cost) for r in report] == [((1 << 63) - 1, 0)]


def test_repaired_turns_are_real_rows(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "Yes."), (2, 0, "assistant", ""), (3, 0, "system", "Be good."), (3, 1, "user", "So?")]
    turns = repair_conversations(turns_frame(spark, rows)).turns.orderBy("conv_id", "at", "k").collect()
    assert [(r.conv_id, r.role, r.text) for r in turns] == [
        (1, "user", "Hi."), (1, "assistant", "Yes."), (3, "user", "Be good."), (3, "assistant", "So?")]
    assert damaged(turns_frame(spark, [])).collect() == []
