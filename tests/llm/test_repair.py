"""Least repairs against a search over all edits, and the chunks of long conversations."""

import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest

from mallflow.llm import repair

SCHEMA = "conv_id long, turn long, role string, text string, place long, chunk string, letter string"
WHITE = " \t\n\x0b\f\r"


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        bare = text.strip(WHITE)
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def best(rows):
    """(cost, audit, repaired) by trying everything; ties by the audit."""
    found = faults(rows)
    goes = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    names = {"u": "user", "a": "assistant"}

    @lru_cache(maxsize=None)
    def search(at, state, room):
        options = []
        if at == len(rows) and state in ("", "a"):
            options.append((0, "", ()))
        if room:
            for initial, name in names.items():
                if (state, initial) in goes:
                    cost, audit, made = search(at, goes[state, initial], room - 1)
                    options.append((cost + 5, "I" + audit, (f"{name}:", *made)))
        if at < len(rows):
            role, text = rows[at]
            cost, audit, made = search(at + 1, state, 3)
            options.append((cost + 2, "D" + audit, made))
            if found[at] not in ("blank", "duplicate"):
                more = 5 * (found[at] == "truncated")
                if (state, role[:1]) in goes:
                    cost, audit, made = search(at + 1, goes[state, role[:1]], 3)
                    options.append((cost + more, "K" + audit, (f"{role}:{text}", *made)))
                for initial, name in names.items():
                    if (state, initial) in goes:
                        cost, audit, made = search(at + 1, goes[state, initial], 3)
                        options.append((cost + 1 + more, "R" + audit, (f"{name}:{text}", *made)))
        return min(options, default=(1 << 30, "", ()))

    # From the end, so that long conversations do not recurse deeply.
    for at in range(len(rows), -1, -1):
        for state in ("", "s", "u", "a"):
            search(at, state, 3)
    return search(0, "", 3)


def plain(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    said = [(role, text) for _, role, text in rows]
    turns = [t for t, *_ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    found = faults(said)
    illegal = sum((a[0][:1] + b[0][:1]) not in ("su", "ua", "au") for a, b in zip(said, said[1:]))
    cost, audit, made = best(said)
    counts = [found.count(f) for f in ("blank", "duplicate", "truncated")]
    return (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(made).encode()).hexdigest())


def harm(rows):
    out = []
    for conv, turn, role, text in rows:
        what = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if what == 1 else re.sub("[.!?]", "", text) if what == 2 else text
        role = "user" if what == 4 else role
        out += [(conv, turn, role, text)] * (0 if what == 0 else 2 if what == 3 else 1)
    return out


def conversation(pick, conv, n):
    said = ["Yes.", "No!", "What?", "cut", "", " \t", "more words. ", "漢字.", None, "end.\n"]
    roles = ["user", "assistant", "system", "tool", "", None, "u", "sys", "User"]
    rows = []
    for turn in range(n):
        role = pick.choice(roles) if pick.random() < 0.3 else "user" if turn % 2 == 0 else "assistant"
        text = pick.choice(said) if pick.random() < 0.4 else f"turn {turn} is here."
        rows.append((conv, turn + (turn > 4) if pick.random() > 0.1 else None, role, text))
    return rows


@pytest.mark.parametrize("chunk", [1, 3, repair.CHUNK])
def test_against_all_edits(spark, chunk, monkeypatch):
    pick = random.Random(chunk)
    rows = [row for conv in range(60) for row in conversation(pick, conv, pick.randint(1, 12))]
    rows += conversation(pick, 1000, 150) + conversation(pick, None, 5) + [(70, None, "user", "all"), (70, None, "tool", None), (71, 3, None, None)]
    rows += [(72, 1, "user", "one.")] * 40 + [(73, n, "assistant", "x." * n) for n in range(1, 9)]
    rows += [(75, next(t for t in range(100) if zlib.crc32(f"75:{t}".encode()) % 20 == 0), "user", "dropped.")]
    monkeypatch.setattr(repair, "CHUNK", chunk)
    frame = spark.createDataFrame([(*row, 5, "c", "l") for row in rows], SCHEMA)
    got = {r[0]: tuple(r)[1:] for r in repair.digest(frame).collect()}
    hurt = harm(rows)
    want = {conv: plain([row[1:] for row in hurt if row[0] == conv]) for conv in {row[0] for row in rows}}
    assert want[75] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert got == want


def test_no_conversations(spark):
    assert repair.digest(spark.createDataFrame([], SCHEMA)).collect() == []


def test_vectors_agree_whatever_they_start_from():
    pick = random.Random(2)
    for _ in range(200):
        letters = "".join(pick.choice("suaoSUAOx") for _ in range(30))
        starts = [repair._normal([pick.randrange(30) for _ in range(4)]) for _ in range(2)]
        fronts = [repair.vectors(letters, start)[0] for start in starts]
        assert repair.refront(letters, *starts, fronts[0]) == fronts[1]
        # A bounded difference is all that can be left of any start.
        assert max(fronts[0]) <= 3 * repair.INSERT


def test_edits_are_applied():
    assert repair.apply_edits("KDriIR", [("system", "s"), ("x", "gone"), ("y", "b"), ("z", "c")]) == ["system:s", "assistant:b", "assistant:", "user:", "user:c"]
