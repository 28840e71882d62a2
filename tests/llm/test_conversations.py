import hashlib
import heapq
import itertools
import random
import re
import zlib

import pytest

from pyspark.sql import functions as F

from clickmart.llm import conversations as C

SCHEMA = "conv_id long, turn long, role string, text string"


def cheapest(turns):
    """(cost, audit) over all edits of (role, deleted only, truncated), by Dijkstra over the roles given so far."""
    heap, seen = [(0, "", 0, "")], set()
    while heap:
        cost, audit, place, end = heapq.heappop(heap)
        if place == len(turns) and re.fullmatch("(s?(ua)+)?", {"": "", "s": "s", "u": "u", "a": "ua"}[end]):
            return cost, audit
        if (place, end) in seen:
            continue
        seen.add((place, end))
        follows = {"": "su", "s": "u", "u": "a", "a": "u"}[end]
        for new in "ua":
            if new in follows:
                heapq.heappush(heap, (cost + 3, audit + "I", place, new))
        if place < len(turns):
            role, gone, cut = turns[place]
            heapq.heappush(heap, (cost + 4, audit + "D", place + 1, end))
            if not gone:
                if role[:1] and role[:1] in follows:
                    heapq.heappush(heap, (cost + 3 * cut, audit + "K", place + 1, role[:1]))
                for new in "ua":
                    if new in follows:
                        heapq.heappush(heap, (cost + 3 + 3 * cut, audit + "R", place + 1, new))
    raise AssertionError


def code(turn):
    role, gone, cut = turn
    return C.GONE if gone else {"s": C.SYSTEM, "u": C.USER, "a": C.ASSISTANT}.get(role[:1], C.OTHER) + C.CUT * cut


KINDS = [(role, False, cut) for role in ("system", "user", "assistant", "tool") for cut in (False, True)] + [("user", True, False)]


@pytest.mark.parametrize("length", range(5))
def test_all_short_conversations(length):
    for turns in itertools.product(KINDS, repeat=length):
        assert C.search(bytes(map(code, turns))) == cheapest(turns)


def test_random_conversations():
    draw = random.Random(4)
    for _ in range(60):
        turns = [draw.choice(KINDS) for _ in range(draw.randint(5, 40))]
        assert C.search(bytes(map(code, turns))) == cheapest(turns)


def test_very_long_conversations():
    assert C.search(bytes([C.USER, C.ASSISTANT] * 30_000)) == (0, "K" * 60_000)
    cost, audit = C.search(bytes([C.SYSTEM] * 3_001))
    assert (cost, audit) == (3 * 3_000, "K" + "R" * 3_000)
    assert C.search(bytes([C.GONE] * 3_000)) == (12_000, "D" * 3_000)


def brute(rows):
    """The result of the query, from its contract."""
    turns = {}
    for conv_id, turn, role, text in rows:
        kept = turns.setdefault(conv_id, [])
        role, text = (" " if value is None else value for value in (role, text))
        kind = zlib.crc32(f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}".encode()) % 20
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(kind, text)
        kept += [(turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    found = []
    for conv_id, kept in turns.items():
        kept.sort(key=lambda row: (row[0] is not None, row[0] or 0, row[1].encode(), row[2].encode()))
        faults, seen = [], set()
        for _, role, text in kept:
            solid = re.sub(r"[\x20\x09-\x0D]+", "", text)
            fault = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else ""
            seen.add((role, text))
            faults.append(fault)
        roles = [role[:1] for _, role, _ in kept]
        numbers = {turn for turn, _, _ in kept if turn is not None}
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        cost, audit = cheapest([(r, f in ("blank", "duplicate"), f == "truncated") for (_, r, _), f in zip(kept, faults, strict=True)])
        lines, rest, end = [], iter(kept), ""
        for letter in audit:
            role, text = next(rest)[1:] if letter != "I" else ("", "")
            if letter == "D":
                continue
            if letter != "K":
                role = {"": "user", "s": "user", "u": "assistant", "a": "user"}[end]
            end = role[:1]
            lines.append(f"{role}:{text}")
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(roles))
        counts = [faults.count(name) for name in ("blank", "duplicate", "truncated")]
        found.append((conv_id, gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(found, key=str)


def table():
    draw, rows = random.Random(9), []
    for conv_id in [None, *range(60)]:
        for turn in range(draw.randint(1, 12)):
            role = draw.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            text = draw.choice(["Hello there.", "What?", "no end", "", " \n", None, "Odd space. ", "Ends. \x0b", f"Só {draw.random()}!"])
            rows.append((conv_id, draw.choice([turn, turn, turn + 3, None]), role, text))
    rows += [(100, 1, "user", "Same."), (100, 1, "user", "Same."), (101, 0, "user", "long " * 50_000 + "text."), (101, 1, "assistant", "Yes.")]
    rows += [(200, n, ["user", "assistant"][n % 2], f"Turn {n}" + "." * (n % 7 > 0)) for n in range(500)]
    dropped = next(n for n in range(10_000) if zlib.crc32(f"{n}:0".encode()) % 20 == 0)
    return [*rows, (dropped, 0, "user", "Gone.")]


@pytest.mark.parametrize("held", [C.HELD_BYTES, 100, 0])
def test_query_same_as_brute_force(spark, held):
    rows = table()
    frame = spark.createDataFrame(rows, SCHEMA).withColumn("place", F.lit(7)).withColumn("audit", F.lit("mine")).repartition(5)
    found = C.repair_digests(*C.damaged(frame), held=held)
    assert found.columns == ["conv_id", *C.COUNTS, "audit", "repaired_sha256"]
    assert sorted(map(tuple, found.collect()), key=str) == brute(rows)


def test_repaired_turns(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "assistant", "Hi."), (1, 2, "user", "Bye."), (2, 0, "user", ""), (3, 0, "user", "Who?")]
    turns = spark.createDataFrame(rows, SCHEMA)
    first = [("system", "Be kind."), ("user", ""), ("assistant", "Hi."), ("user", "Bye."), ("assistant", "")]
    wanted = {1: first, 2: [], 3: [("user", "Who?"), ("assistant", "")]}
    reports = C.repair(turns)
    assert {row["conv_id"]: [tuple(turn) for turn in row["repaired"]] for row in reports.collect()} == wanted
    apart = C.repaired_turns(turns, reports).orderBy("conv_id", "place").collect()
    assert [(row["conv_id"], (row["role"], row["text"])) for row in apart] == [(n, turn) for n in wanted for turn in wanted[n]]


def test_empty_table(spark):
    turns = spark.createDataFrame([], SCHEMA)
    assert C.repair(turns).count() == 0
    assert C.repair_digests(*C.damaged(turns)).count() == 0
