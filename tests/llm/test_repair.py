"""Conversation repair against brute force: every edit sequence of small conversations."""

import hashlib
import random
import re
import zlib

import pytest

from constella.llm import repair
from tests.llm.cases import LONG

SCHEMA = "conv_id long, turn long, role string, text string, cost string, block int"
ROLE_NAMES = ("user", "assistant", "system", "tool", "", "unknown")


def every_way(rows):
    """(cost, audit, repaired rows) of each edit sequence; rows are (role, text, forced, truncated)."""

    def go(k, initials, cost, audit, out):
        if not re.fullmatch("(s|(s?(ua)*u?))", initials):
            return
        if k == len(rows):
            for n in range(3):
                added = list(out)
                now = initials
                for _ in range(n):
                    now += "a" if now.endswith("u") else "u"
                    added.append(("assistant" if now[-1] == "a" else "user", ""))
                if re.fullmatch("(s?(ua)+)?", now):
                    yield cost + 5 * n, audit + "I" * n, added
            return
        role, text, forced, truncated = rows[k]
        for n in range(3):
            now, added = initials, list(out)
            for _ in range(n):
                now += "a" if now.endswith("u") else "u"
                added.append(("assistant" if now[-1] == "a" else "user", ""))
            spent, said = cost + 5 * n, audit + "I" * n
            yield from go(k + 1, now, spent + 2, said + "D", added)
            if not forced:
                stays = spent + 5 * truncated
                if role[:1] in ("s", "u", "a") and role:
                    yield from go(k + 1, now + role[:1], stays, said + "K", [*added, (role, text)])
                for r in ("user", "assistant"):
                    yield from go(k + 1, now + r[0], stays + 1, said + "R", [*added, (r, text)])

    return go(0, "", 0, "", [])


def brute(rows):
    """The contract's result for rows (turn, role, text) in any order."""
    rows = sorted(((t is not None, t, " " if r is None else r, " " if x is None else x) for t, r, x in rows),
                  key=lambda r: (r[0], r[1] or 0, r[2], r[3][:256], hashlib.sha256(r[3].encode()).hexdigest()))
    turns = [r[1] for r in rows if r[0]]
    seen, judged, counts = set(), [], dict.fromkeys(("blank", "duplicate", "truncated"), 0)
    for _, _, role, text in rows:
        found = re.findall(r"[^\x20\x09-\x0D]", text)
        fault = ("blank" if not found else "duplicate" if (role, text) in seen else
                 "truncated" if found[-1] not in ".!?" else None)
        seen.add((role, text))
        if fault:
            counts[fault] += 1
        judged.append((role, text, fault in ("blank", "duplicate"), fault == "truncated"))
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(judged, judged[1:], strict=False))
    cost, audit, out = min(every_way(judged), key=lambda w: w[:2])
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *counts.values(), illegal, cost, audit,
            hashlib.sha256("\n".join(f"{r}:{x}" for r, x in out).encode()).hexdigest())


def results(spark, rows, bits):
    df = spark.createDataFrame([(*r, "c", 1) for r in rows], SCHEMA)
    found = repair.repair(df.repartition(3), bits)
    digests = {r.conv_id: r.repaired_sha256 for r in repair.digests(found.turns).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit,
                        digests.get(r.conv_id, empty)) for r in found.audits.collect()}


def conversations(n, most, seed):
    rng = random.Random(seed)
    texts = ["Yes.", "Why?", "cut off", " \n\t", "", None, "Yes.", "same, same", "ends! \n"]
    for conv in range(n):
        for turn in range(rng.randrange(1, most + 1)):
            yield (None if conv == 3 else conv, rng.choice([turn, turn, turn + 2, 0, None]),
                   rng.choice([*ROLE_NAMES, None, "user", "assistant"]), rng.choice(texts))


@pytest.mark.parametrize("bits", [0, 1, 12])
def test_equals_every_edit_sequence(spark, bits):
    rows = list(conversations(60, 5, 11))
    expected = {}
    for conv in {r[0] for r in rows}:
        expected[conv] = brute([r[1:] for r in rows if r[0] == conv])
    assert results(spark, rows, bits) == expected


def test_one_conversation_over_many_blocks_and_tasks(spark):
    rng = random.Random(5)
    rows = [(7, t, rng.choice(["user", "assistant", "assistant", "system"]),
             rng.choice(["Yes.", "No!", f"said {t}", f"Asked {t}?"])) for t in range(300)]
    rows += [(8, 1, "user", "Hi."), (8, 2, "assistant", LONG)]
    assert results(spark, rows, 3) == results(spark, rows, 12)
    assert results(spark, rows, 0)[8] == brute([r[1:] for r in rows if r[0] == 8])


def test_least_audit_with_colliding_hashes():
    rng = random.Random(2)
    kinds = [(i, t, f) for i in ("s", "u", "a", "") for t in (False, True) for f in (False, True)]
    for _ in range(300):
        rows = [rng.choice(kinds) for _ in range(rng.randrange(1, 40))]
        plain: dict[int, tuple[int, str]] = {0: (0, "")}
        for kind in rows:
            after: dict[int, tuple[int, str]] = {}
            for state, moves in enumerate(repair._MOVES[kind]):
                ways = [(plain[b][0] + c, plain[b][1] + e) for b, c, e in moves if b in plain]
                if ways:
                    after[state] = min(ways)
            plain = after
        for prefixes in (repair.Prefixes(), repair.Prefixes(modulus=3, base=2)):
            got = repair.cheapest(rows, 0, prefixes)
            assert {s: w for s, w in enumerate(got) if w} == plain


def test_longest_common_prefix_order():
    prefixes, rng = repair.Prefixes(modulus=5, base=2), random.Random(3)
    nodes = [0]
    for _ in range(400):
        nodes.append(prefixes.extend(rng.choice(nodes[-20:]), rng.choice("DIKR")))
    for _ in range(3000):
        a, b = rng.choice(nodes), rng.choice(nodes)
        assert prefixes.less(a, b) == (prefixes.text(a) < prefixes.text(b))


def test_damage(spark):
    rows = [(c, t, r, "Hm. Well, yes! Is it?") for c in (None, 1, 2) for t in (None, *range(40)) for r in ("system", None)]
    got = repair.damaged(spark.createDataFrame([(*r, "c", 1) for r in rows], SCHEMA)).collect()
    expected = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        text = {1: "", 2: "Hm Well, yes Is it"}.get(kind, text)
        role = "user" if kind == 4 else role or " "
        expected += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    key = lambda r: tuple((x is not None, str(x)) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(expected, key=key)


def test_empty_and_all_deleted(spark):
    found = repair.repair(spark.createDataFrame([], SCHEMA))
    assert found.audits.count() == 0 and found.turns.count() == 0
    rows = [(1, None, None, None), (1, None, None, None), (2, 5, "user", "")]
    assert results(spark, rows, 12) == {
        1: (0, 2, 0, 0, 1, 4, "DD", hashlib.sha256(b"").hexdigest()),
        2: (0, 1, 0, 0, 0, 2, "D", hashlib.sha256(b"").hexdigest())}
