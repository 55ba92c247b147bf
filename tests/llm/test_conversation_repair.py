import hashlib
import random
import re
import zlib

import pytest

from seedloom.llm import conversation_repair as repair


def faults(rows):
    """Letters of a conversation's ordered (turn, role, text) rows, and fault counts."""
    seen, letters, counts = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
    for _, role, text in rows:
        last = re.findall(r"[^\x20\x09-\x0D]", text)[-1:]
        letter = role[:1] if role[:1] in ("s", "u", "a") else "x"
        if not last:
            counts["blank"] += 1
            letter = "d"
        elif (role, text) in seen:
            counts["duplicate"] += 1
            letter = "d"
        elif last[0] not in ".!?":
            counts["truncated"] += 1
            letter = letter.upper()
        seen.add((role, text))
        letters.append(letter)
    return letters, counts


def cheapest(letters):
    """Best (cost, edits) over plain strings: every reachable (initials so far, inserts) is kept."""
    best = {"": (0, "")}  # by the part of the initials that matters: "", "s", "u" or "a" at the end

    def better(table, key, value):
        if key not in table or value < table[key]:
            table[key] = value

    def follow(last, initial):
        return (last + initial) in ("s", "u", "su", "ua", "au")

    def inserts(table):
        for _ in range(3):
            for last, (cost, edits) in list(table.items()):
                for initial in "ua":
                    if follow(last, initial):
                        better(table, initial, (cost + 3, edits + "I"))

    for letter in letters:
        inserts(best)
        after = {}
        for last, (cost, edits) in best.items():
            better(after, last, (cost + 4, edits + "D"))
            if letter != "d":
                extra = 3 * letter.isupper()
                if letter != "x" and letter != "X" and follow(last, letter.lower()):
                    better(after, letter.lower(), (cost + extra, edits + "K"))
                for initial in "ua":
                    if follow(last, initial):
                        better(after, initial, (cost + extra + 3, edits + "R"))
        best = after
    inserts(best)
    return min(best[last] for last in ("", "a") if last in best)


def exhaustive(letters, most=6):
    """All edit lists of at most ``most`` more edits than turns; small inputs only."""
    found = []

    def go(at, roles, cost, edits):
        if len(edits) > most or not re.fullmatch(r"(s?(ua)*u?)?", roles):
            return
        if at == len(letters) and re.fullmatch(r"(s?(ua)+)?", roles):
            found.append((cost, edits))
        for initial in "ua":
            go(at, roles + initial, cost + 3, edits + "I")
        if at < len(letters):
            letter, extra = letters[at], 3 * letters[at].isupper()
            go(at + 1, roles, cost + 4, edits + "D")
            if letter != "d":
                for initial in "ua":
                    go(at + 1, roles + initial, cost + extra + 3, edits + "R")
                if letter.lower() != "x":
                    go(at + 1, roles + letter.lower(), cost + extra, edits + "K")

    go(0, "", 0, "")
    return min(found)


def applied(rows, edits):
    at, last, lines = 0, "", []
    for edit in edits:
        role, text = ("", "") if edit == "I" else rows[at][1:]
        at += edit != "I"
        if edit == "D":
            continue
        if edit != "K":
            role = "assistant" if last == "u" else "user"
        last = role[0]
        lines.append(f"{role}:{text}")
    return lines


def brute(rows):
    conversations = {}
    for conv_id, turn, role, text in rows:
        own = conversations.setdefault(conv_id, [])
        role, text = " " if role is None else role, " " if text is None else text
        name = f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}"
        fault = zlib.crc32(name.encode()) % 20
        if fault == 1:
            text = ""
        elif fault == 2:
            text = re.sub("[.!?]", "", text)
        elif fault == 4:
            role = "user"
        own += [(turn, role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    out = []
    for conv_id, own in conversations.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        letters, counts = faults(own)
        cost, audit = cheapest(letters)
        turns = {t for t, _, _ in own if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        pairs = zip(own, own[1:], strict=False)
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in pairs)
        digest = hashlib.sha256("\n".join(applied(own, audit)).encode()).hexdigest()
        out.append((conv_id, gaps, *counts.values(), illegal, cost, audit, digest))
    return out


def made(seed, conversations, longest):
    rng = random.Random(seed)
    rows = []
    for conv_id in [None, *range(conversations)]:
        for turn in range(rng.randint(1, longest)):
            role = rng.choice(["user", "assistant"] * 4 + ["system", "tool", "", None, "ädmin"])
            text = rng.choice(["ok.", "so?", "well", "", None, " \t", "é! ", "x" * rng.randint(1, 9) + ".", "a.\nb"])
            rows.append((conv_id, rng.choice([turn, turn, turn, 3 * turn, None]), role, text))
    return rows


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r))


SCHEMA = "conv_id long, turn long, role string, text string, gone int, audit int"


@pytest.mark.parametrize(("seed", "conversations", "longest", "every"), [(1, 300, 9, 2000), (2, 30, 90, 7), (3, 4, 700, 50)])
def test_same_as_brute_force(spark, monkeypatch, seed, conversations, longest, every):
    monkeypatch.setattr(repair, "SETTLE_EVERY", every)
    rows = made(seed, conversations, longest) + [(900, 1, "user", "y" * 300_000 + ".")]
    frame = spark.createDataFrame([(*r, 0, 0) for r in rows], SCHEMA).repartition(3)
    got = repair.audit_conversations(repair.damage(frame), absent="gone")
    assert ordered(map(tuple, got.collect())) == ordered(brute(rows))


def test_small_ones_against_every_edit_list():
    rng = random.Random(4)
    for _ in range(150):
        letters = [rng.choice("suaxSUAXd") for _ in range(rng.randint(0, 3))]
        assert repair.cheapest_audit("".join(letters)) == cheapest(letters) == exhaustive(letters)


def test_long_searches_settle():
    rng = random.Random(9)
    letters = [rng.choice("suaUAdx") if rng.random() < 0.2 else "ua"[i % 2] for i in range(3000)]
    search, settled = repair.AuditSearch(), ""
    for letter in letters:
        search.step(letter)
        if len(search.lists.parent) > 1000:
            settled += search.settle()
            assert len(search.lists.parent) < 500
    cost, rest = search.finish()
    assert (cost, settled + rest) == cheapest(letters)


def test_hash_collisions_are_seen(monkeypatch):
    monkeypatch.setattr(repair, "_MODULUS", 2)
    rng = random.Random(6)
    for _ in range(200):
        letters = [rng.choice("uaUAdsx") for _ in range(rng.randint(3, 30))]
        search = repair.AuditSearch()
        for letter in letters:
            search.step(letter)
        assert search.finish() == cheapest(letters)


def test_repaired_turns(spark):
    rows = made(7, 60, 12)
    frame = repair.damage(spark.createDataFrame([(*r, 0, 0) for r in rows], SCHEMA))
    lines = {}
    for r in repair.repaired_turns(frame, absent="gone").orderBy("conv_id", "place").collect():
        lines.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    for conv_id, *_, digest in brute(rows):
        assert hashlib.sha256("\n".join(lines.get(conv_id, [])).encode()).hexdigest() == digest


def test_all_dropped_and_empty_table(spark):
    gone = spark.createDataFrame([(5, 1, "user", "x.", True)], "conv_id long, turn long, role string, text string, gone boolean")
    nothing = hashlib.sha256(b"").hexdigest()
    assert [tuple(r) for r in repair.audit_conversations(gone, "gone").collect()] == [(5, 0, 0, 0, 0, 0, 0, "", nothing)]
    assert repair.audit_conversations(gone.limit(0)).count() == repair.repaired_turns(gone.limit(0)).count() == 0
