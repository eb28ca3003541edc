import hashlib
import itertools
import random
import re
import zlib

import pytest

from tessera.llm import conversation_repair as cr

WS = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id long, turn long, role string, text string"


def faults_of(rows):
    seen, out = set(), []
    for _, role, text in rows:
        bare = text.strip(WS)
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def brute(rows):
    """Every sequence of edits, with up to two insertions in each gap."""
    faults, best = faults_of(rows), None
    choices = []
    for f in faults:
        choices.append(["D"] if f in ("blank", "duplicate") else ["D", "K", "Ruser", "Rassistant"])
    gaps = [[], ["user"], ["assistant"], ["user", "assistant"], ["assistant", "user"]]
    for edits in itertools.product(*choices):
        for added in itertools.product(gaps, repeat=len(rows) + 1):
            cost = sum(5 * len(g) for g in added) + sum({"D": 2, "K": 0}.get(e, 1) + (5 if e != "D" and f == "truncated" else 0) for e, f in zip(edits, faults))
            if best and cost > best[0]:
                continue
            audit, left = "", []
            for i, g in enumerate(added):
                audit += "I" * len(g)
                left += [(r, "") for r in g]
                if i < len(rows):
                    audit += edits[i][0]
                    if edits[i] != "D":
                        left.append((rows[i][1] if edits[i] == "K" else edits[i][1:], rows[i][2]))
            if re.fullmatch("(s?(ua)+)?", "".join(r[:1] or "-" for r, _ in left)) and (best is None or (cost, audit) < best[:2]):
                best = (cost, audit, left)
    return best


def random_rows(rng, n):
    roles = ["system", "user", "user", "assistant", "assistant", "tool", "", "uncle"]
    texts = ["Fine.", "Why?", "cut", "", " \t", "Yes!\n", "a b", "Fine."]
    rows = [(rng.choice([None, 0, 1, 2, 3, 9, 12]), rng.choice(roles), rng.choice(texts)) for _ in range(n)]
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))


def test_search_against_every_sequence_of_edits():
    rng = random.Random(1)
    for n, times in ((0, 1), (1, 40), (2, 60), (3, 12)):
        for _ in range(times):
            rows = random_rows(rng, n)
            gaps, blank, dup, trunc, illegal, cost, audit, left = cr._one(rows)
            assert (cost, audit, left) == brute(rows), rows
            turns = [t for t, _, _ in rows if t is not None]
            assert gaps == (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0)
            assert [blank, dup, trunc] == [faults_of(rows).count(f) for f in ("blank", "duplicate", "truncated")]


def test_tables_multiply():
    rng = random.Random(7)
    for _ in range(200):
        drawn = random_rows(rng, rng.randrange(1, 25))
        rows = [(r[:1], f, 1) for (_, r, _), f in zip(drawn, faults_of(drawn))]
        cuts = sorted(rng.sample(range(len(rows) + 1), min(3, len(rows))))
        parts = [p for a, b in zip([0, *cuts], [*cuts, len(rows)]) if (p := rows[a:b])]
        costs, ranks = cr.fold([cr.table_of(p) for p in parts])
        whole = {(s, t): v for s in range(4) for t, v in cr.search(rows, s).items()}
        assert {(s, t): costs[4 * s + t] for s, t in whole} == {k: v[0] for k, v in whole.items()}
        for (k1, v1), (k2, v2) in itertools.combinations(whole.items(), 2):
            a, b = (ranks[4 * s + t] for s, t in (k1, k2))
            assert (a < b, a == b) == (v1[1] < v2[1], v1[1] == v2[1])
        end = cr.close(cr.search(rows, 0))[0]
        ways = cr.states_between([cr.table_of(p) for p in parts], 0, end)
        assert "".join(cr.search(p, s)[t][1] for p, (s, t) in zip(parts, ways)) == whole[0, end][1]


def plain(rows):
    """The contract, conversation by conversation, in Python (its search is held to brute force above)."""
    convs = {}
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        role, text = "user" if kind == 4 else role, "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        convs.setdefault(conv, []).extend([] if kind == 0 else [(turn, role, text)] * (2 if kind == 3 else 1))
    out = []
    for conv, found in convs.items():
        found.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        *facts, audit, left = cr._one(found)
        out.append((conv, *facts, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in left).encode()).hexdigest()))
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0))


@pytest.mark.parametrize("most_rows", [2048, 3, 20])
def test_conversations(spark, most_rows):
    rng = random.Random(3)
    rows = [(c, t, r, x) for c in range(30) for t, r, x in random_rows(rng, rng.randrange(1, 9))]
    rows += [(None, t, r, x) for t, r, x in random_rows(rng, 12)] + [(77, None, None, None)] * 9 + [(78, 5, "user", "Same.")] * 50
    rows += [(79, i, rng.choice(["user", "assistant"]), rng.choice(["Ok.", f"Turn {i}.", "cut"])) for i in range(700)]
    gone = next(i for i in range(1000, 2000) if zlib.crc32(f"{i}:1".encode()) % 20 == 0)
    rows += [(gone, 1, "user", "Hi.")] * 25 + [(80, 2, "assistant", "é long. " * 60_000)]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as seg", "'x' as audit", "2 as kind", "3 as c", "'y' as gone").repartition(4)
    got = [tuple(r) for r in cr.digests(cr.repair(cr.damage(docs), most_rows=most_rows)).collect()]
    assert sorted(got, key=lambda r: (r[0] is not None, r[0] or 0)) == plain(rows)
    assert (gone, *[0] * 6, "", hashlib.sha256(b"").hexdigest()) in got
    assert cr.digests(cr.repair(cr.damage(docs.limit(0)), most_rows=most_rows)).count() == 0


def test_pieces_of_a_long_conversation(spark, monkeypatch):
    monkeypatch.setattr(cr, "FAN", 3)  # several levels of tables
    rng = random.Random(6)
    rows = [(1, i, rng.choice(["user", "assistant", "tool"]), rng.choice([f"Turn {i}.", "cut", "", "Again."])) for i in range(160)] + [(2, 1, "user", "x" * 5000 + ".")]
    out = cr.repair(spark.createDataFrame(rows, SCHEMA), most_rows=10, most_bytes=4000).collect()
    pieces = sorted((r for r in out if r.conv_id == 1), key=lambda r: r.piece)
    *facts, audit, left = cr._one([r[1:] for r in rows if r[0] == 1])
    assert len(pieces) > 9 and not any(p.whole for p in pieces) and all(tuple(p[1:7]) == tuple(facts) for p in pieces)
    assert "".join(p.audit for p in pieces) == audit and [tuple(x) for p in pieces for x in p.repaired] == left
    assert [tuple(x) for r in out if r.conv_id == 2 for x in r.repaired] == cr._one([(1, "user", "x" * 5000 + ".")])[-1]
