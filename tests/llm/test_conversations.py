"""Repair of conversations against trying every edit of every target."""

import hashlib
import random
import zlib
from functools import cache

import pytest

from rosterlake.llm.conversations import aligned, aligned_long, audited, letter, parted, repaired_digests, repaired_turns, target
from rosterlake.llm.queries import QUERIES

SPACE = " \t\n\x0b\x0c\r"


def cheapest(speakers, faults):
    """The least (cost, audit) over all targets that can pay."""
    n, best = len(speakers), None
    for m in range(n + 5):
        for system in (False, True):
            if m and (m - system) % 2 or system and m < 3:
                continue
            goal = target(m, system)

            @cache
            def least(i, j, goal=goal, m=m):
                if (i, j) == (n, m):
                    return 0, ""
                found = []
                if i < n:
                    cost, audit = least(i + 1, j)
                    found.append((cost + 2, "D" + audit))
                if i < n and j < m and faults[i] in ("", "truncated"):
                    cost, audit = least(i + 1, j + 1)
                    cost += 5 * (faults[i] == "truncated")
                    if speakers[i] == goal[j]:
                        found.append((cost, "K" + audit))
                    if goal[j] != "s":
                        found.append((cost + 1, "R" + audit))
                if j < m and goal[j] != "s":
                    cost, audit = least(i, j + 1)
                    found.append((cost + 5, "I" + audit))
                return min(found, default=(1 << 50, ""))

            best = min(best or (1 << 50, ""), least(0, 0))
    return best


def damage(rows):
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
        yield from [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)


def expected(conv, rows):
    """The result row of one conversation's rows (turn, role, text)."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    faults, seen = [], set()
    for _, role, text in rows:
        last = text.rstrip(SPACE)[-1:]
        faults.append("blank" if not last else "duplicate" if (role, text) in seen else "" if last in ".!?" else "truncated")
        seen.add((role, text))
    speakers = [role[:1] if role[:1] in ("s", "u", "a") else "-" for _, role, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(speakers, speakers[1:], strict=False))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    cost, audit = cheapest(speakers, faults)
    lines, at, last = [], 0, ""
    for edit in audit:
        role, text = ("", "") if edit == "I" else rows[at][1:]
        at += edit != "I"
        if edit == "D":
            continue
        role = role if edit == "K" else "assistant" if last == "u" else "user"
        lines.append(f"{role}:{text}")
        last = role[:1]
    digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return (conv, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest)


@pytest.mark.parametrize("seed", [1, 2])
def test_alignments_equal_trying_all(seed):
    rng = random.Random(seed)
    for _ in range(600):
        kinds = rng.choice(["ABCDEFGHIJKLMNOP", "AEI", "EIHL", "AEIMHLD"])
        letters = "".join(rng.choice(kinds) for _ in range(rng.randrange(9)))
        speakers, faults = parted(letters)
        wanted = cheapest(speakers, [("", "blank", "duplicate", "truncated")[f] for f in faults])
        assert aligned(letters) == aligned_long(letters, rng.choice([1, 2, 5, 4096])) == wanted


def test_long_conversations_share_columns():
    rng = random.Random(4)
    for n in (100, 200):
        letters = "".join("EI"[i % 2] if rng.random() > 0.2 else rng.choice("HLFJEIAM") for i in range(n))
        assert aligned(letters) == aligned_long(letters, 16)
    cost, audit = aligned_long("EI" * 100_000)
    assert (cost, audit) == (0, "K" * 200_000)


def made():
    rng = random.Random(7)
    says = ["Yes.", "No", "Why?", " \n", "", "Go on! ", "a.b", None, "\x1c", "é."]
    rows = []
    for conv in [None, *range(60)]:
        for turn in rng.sample(range(-2, 12), rng.randrange(1, 7)):
            rows.append((conv, turn if rng.random() > 0.1 or any(r[0] == conv and r[1] is None for r in rows) else None,
                         rng.choice(["user", "assistant", "system", "user", "assistant", "tool", "", None]), rng.choice(says)))
    rows += [(100, i, ("user", "assistant")[i % 2], f"Turn {i}.") for i in range(700)]
    rows += [(101, 1, "user", "Hi."), (101, 1, "user", "Hi."), (101, 1, "user", "Hi."), (101, 2, "assistant", "x" * 100_000)]
    rng.shuffle(rows)
    return rows


def as_said(rows):
    """Null roles and texts as one space."""
    return [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]


def test_conversations_equal_trying_all(spark):
    rows = made()
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, conv string, kind int").repartition(5)
    audits = audited(frame)
    digests = {r.conv_id: r.repaired_sha256 for r in repaired_digests(frame, audits).collect()}
    found = {r.conv_id: (*r, digests[r.conv_id]) for r in audits.collect()}
    assert len(found) == len({r[0] for r in rows}) == 63
    for conv in found:
        own = as_said(r[1:] for r in rows if r[0] == conv)
        assert found[conv] == expected(conv, own) if conv != 100 else found[conv][6:8] == (0, "K" * 700)
    turns = repaired_turns(frame, audits).collect()
    for conv, digest in digests.items():
        own = sorted((r.position, f"{r.role}:{r.text}") for r in turns if r.conv_id == conv)
        assert [p for p, _ in own] == list(range(len(own)))
        assert hashlib.sha256("\n".join(line for _, line in own).encode()).hexdigest() == digest


def test_a_conversation_with_most_rows_is_read_from_several_ranges(spark):
    rng = random.Random(9)
    rows = [(5, i, ("user", "assistant")[i % 2], f"{i}" + rng.choice([".", ".", "", "!"])) for i in range(20_000)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(8)
    row = audited(frame).first()
    truncated = sum(r[3][-1] not in ".!" for r in rows)
    assert (row.gaps, row.blank, row.duplicate, row.truncated, row.illegal) == (0, 0, 0, truncated, 0)
    letters = "".join(letter("ua"[i % 2], "" if r[3][-1] in ".!" else "truncated") for i, r in enumerate(rows))
    assert (row.cost, row.audit) == aligned_long(letters)


def test_empty_table(spark):
    frame = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert audited(frame).collect() == [] and repaired_digests(frame, audited(frame)).collect() == []


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query(spark, sf):
    sf = f"/root/testdata/{sf}"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    own = {conv: [] for conv, *_ in rows}
    for conv, *rest in damage(rows):
        own[conv].append(tuple(rest))
    frame = QUERIES["op11_conversation_repair"](spark, sf)
    assert frame.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    found = sorted(tuple(r) for r in frame.collect())
    assert found == sorted(expected(conv, turns) for conv, turns in own.items())


def test_query_on_nulls_and_odd_rows(spark, tmp_path):
    rows = made()
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    own = {conv: [] for conv, *_ in rows}
    for conv, *rest in damage(rows):
        own[conv].append(tuple(rest))
    found = {r.conv_id: tuple(r) for r in QUERIES["op11_conversation_repair"](spark, str(tmp_path)).collect()}
    assert found.keys() == own.keys()
    assert all(found[conv] == expected(conv, turns) for conv, turns in own.items() if conv != 100)
