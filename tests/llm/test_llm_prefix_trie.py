"""Prefix trie against a dictionary of all prefixes."""
import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from llm_helpers import SF_SMALL, TURN_EDGE, turns_frame

import sigshape.llm.prefix_trie as m
from sigshape.llm.prefix_trie import prefix_trie, rebuilt, trie_report, turn_sequences
from sigshape.llm.queries import QUERIES


def ordered(rows):
    out = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            out[c].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [x[2:] for x in sorted(v)] for c, v in out.items()}


def brute_rebuilt(rows):
    convs = ordered(rows)
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        out[c] = convs.get(base, [])[:h] + own[h:]
    return out


def brute(convs):
    members, ends = defaultdict(list), defaultdict(list)
    for c, seq in convs.items():
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append(c)
        ends[tuple(seq)].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    out, sums = [], {}
    for p in sorted(members, key=len, reverse=True):
        saved = (len(members[p]) - 1) * (len(p[-1][1].encode()) if p else 0) + sum(sums[q][1] for q in children[p])
        sums[p] = (sum(sums[q][0] for q in children[p]) or 1, saved)
        out.append((min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]), len(children[p]), *sums[p],
                    hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest()))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                                                "saved_tokens", "ends_sha256").collect()), key=repr)


def random_turns(seed, n, texts=4, turns=9):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(rng.choice([0, 1, 2, 3, turns])):
            rows.append((c, t, rng.choice(["user", "assistant", None]), rng.choice("abcdefgh"[:texts]) * rng.randint(1, 2)))
    return rows


@pytest.mark.parametrize("seed,shard_turns,fan_in", [(0, 50_000, 16), (1, 40, 16), (2, 7, 2), (3, 3, 3)])
def test_nodes(spark, monkeypatch, seed, shard_turns, fan_in):
    """Also over many shards, whose boundary nodes are merged in several rounds."""
    monkeypatch.setattr(m, "SHARD_TURNS", shard_turns)
    monkeypatch.setattr(m, "FAN_IN", fan_in)
    rows = random_turns(seed, 60, texts=2 + seed)
    assert got(trie_report(prefix_trie(turn_sequences(turns_frame(spark, rows))))) == brute(ordered(rows))


def test_hot_conversations_and_long_ones(spark, monkeypatch):
    import sigshape.llm.turns as turns
    monkeypatch.setattr(m, "SHARD_TURNS", 50)
    monkeypatch.setattr(turns, "PIECE", 7)
    same = [(c, t, "user", f"turn {t}") for c in range(120) for t in range(4)]
    long = [(500 + c, t, "user", f"turn {t}") for c in range(2) for t in range(700)] + [(600, 700, "user", "other")]
    assert got(trie_report(prefix_trie(turn_sequences(turns_frame(spark, same + long))))) == brute(ordered(same + long))


@pytest.mark.parametrize("rows", [TURN_EDGE, TURN_EDGE[:1], [(-7, 0, "user", "x"), (-5, 0, "user", "base"), (-4, 1, "user", "y"), (0, 0, "u", "z")]])
def test_query_edges(spark, tmp_path, rows):
    turns_frame(spark, rows).write.parquet(f"{tmp_path}/conversations.parquet")
    assert got(QUERIES["op11_prefix_trie"](spark, str(tmp_path))) == brute(brute_rebuilt(rows))


def test_empty_table(spark, tmp_path):
    turns_frame(spark, []).write.parquet(f"{tmp_path}/conversations.parquet")
    assert QUERIES["op11_prefix_trie"](spark, str(tmp_path)).collect() == []


def test_small_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(QUERIES["op11_prefix_trie"](spark, SF_SMALL)) == brute(brute_rebuilt(rows))
    seqs = turn_sequences(turns_frame(spark, rows))
    assert rebuilt(seqs).count() == len({r[0] for r in rows})
