import hashlib
import heapq
import random
import re
import zlib

import pytest

from tracewright.llm import conversation_repair as c

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
TARGET = re.compile("(s?(ua)+)?")


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(name.encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out += [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    return out


def cheapest(faulty):
    """(cost, audit, turns) by trying edits in the order of cost and audit."""
    heap, seen = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, roles, turns = heapq.heappop(heap)
        if i == len(faulty) and TARGET.fullmatch(roles):
            return cost, audit, turns
        if (i, roles[-3:], len(roles) > 3) in seen and len(roles) > 3:
            continue
        seen.add((i, roles[-3:], len(roles) > 3))
        steps = [(2, "I", 0, r, (r, "")) for r in ("user", "assistant")]
        if i < len(faulty):
            role, text, fault = faulty[i]
            steps.append((3, "D", 1, "", None))
            if fault not in ("blank", "duplicate"):
                more = fault == "truncated"
                steps.append((more, "K", 1, role, (role, text)))
                steps += [(2 + more, "R", 1, r, (r, text)) for r in ("user", "assistant")]
        for price, edit, used, role, turn in steps:
            after = roles + role[:1] if turn else roles
            if turn and (not role or not re.fullmatch("s?(ua)*u?", after)):
                continue
            heapq.heappush(heap, (cost + price, audit + edit, i + used, after, turns + ((turn,) if turn else ())))
    raise AssertionError


def brute(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        own = [r for r in damage(rows) if r[0] == conv]
        own.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        seen, faulty = set(), []
        for _, _, role, text in own:
            shown = text.strip("\x20\x09\x0a\x0b\x0c\x0d")
            fault = "blank" if not shown else "duplicate" if (role, text) in seen else (
                "truncated" if shown[-1] not in ".!?" else "")
            seen.add((role, text))
            faulty.append((role, text, fault))
        cost, audit, turns = cheapest(faulty)
        named = [t[1] for t in own if t[1] is not None]
        pairs = zip(faulty, faulty[1:])
        faults = [f for _, _, f in faulty]
        out[conv] = (
            max(named) - min(named) + 1 - len(set(named)) if named else 0,
            *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in pairs), cost, audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in turns).encode()).hexdigest())
    return out


def collected(frame):
    return {r[0]: tuple(r[1:]) for r in frame.collect()}


def conversations(seed, count, longest=7):
    rng = random.Random(seed)
    texts = ["Yes.", "no", "a b!", "a b! ", " \n", "", "why?\t", "é.", None, "x" * 50]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "u"]
    rows = []
    for conv in range(count):
        for turn in range(rng.randrange(1, longest)):
            rows.append((conv if conv else None, rng.choice((turn, turn, turn, turn + 3, 0, None)),
                         rng.choice(roles), rng.choice(texts)))
    return rows


@pytest.mark.parametrize("options", [{}, {"aligned_turns": 2}, {"held_bytes": 40}])
def test_against_all_edits(spark, options):
    rows = conversations(str(options), 250)
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as audit", "2 as conv", "3 as cost").repartition(7)
    assert collected(c.damaged_and_repaired(frame, **options)) == brute(rows)


def test_both_ways_agree():
    rng = random.Random(5)
    for _ in range(1500):
        codes = "".join(rng.choice("uuaasxUASX-") for _ in range(rng.randrange(12)))
        assert c.aligned(codes) == c.walked(codes), codes
    for n in (c.BLOCK - 1, c.BLOCK, 2 * c.BLOCK + 5):
        cost, audit = c.walked("ua" * (n // 2) + "-" * (n % 2))
        assert cost == 3 * (n % 2) and audit == "K" * (n - n % 2) + "D" * (n % 2)
    assert c.aligned("") == (0, "") == c.walked("")


def test_long_conversation_is_streamed(spark):
    rows = [(700, i, ("user", "assistant")[i % 2], f"t{i}.") for i in range(3000)] + conversations(1, 20)
    frame = spark.createDataFrame(rows, SCHEMA)
    found, cost, audit = collected(c.damaged_and_repaired(frame)), 0, ""
    own = damage([r for r in rows if r[0] == 700])
    cost, audit = found[700][5:7]
    assert len(audit.replace("I", "")) == len(own) and found[700][0] > 50 and cost > 100
    turns, at = [], 0
    for edit in audit:
        want = ("user", "assistant")[len(turns) % 2]
        if edit != "I":
            row, at = own[at], at + 1
        if edit != "D":
            turns.append((row[2] if edit == "K" else want, "" if edit == "I" else row[3]))
    assert re.fullmatch("(ua)*", "".join(r[0] for r, _ in turns))
    assert found[700][7] == hashlib.sha256("\n".join(f"{r}:{t}" for r, t in turns).encode()).hexdigest()


def test_edges(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert c.damaged_and_repaired(empty).count() == 0
    gone = next(i for i in range(100) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    found = c.damaged_and_repaired(spark.createDataFrame([(gone, 0, "user", "Hi.")], SCHEMA)).collect()
    assert [tuple(r) for r in found] == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
