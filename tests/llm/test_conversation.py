import hashlib
import random
import re
import zlib
from functools import lru_cache

import pyarrow.parquet as pq
import pytest

from marginalia.llm import conversation

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string"
SOLID = re.compile(r"[^\x20\x09-\x0D]")


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        role = "user" if fault == 4 else role
        out += [(conv, turn, role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    return out


def faults(turns):
    seen, out = set(), []
    for role, text in turns:
        solid = SOLID.findall(text)
        out.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(turns, kinds):
    """Every sequence of edits, told good by the pattern alone; for a few turns."""
    best, n = None, len(turns)
    inserts = ["", "u", "a", "uu", "ua", "au", "aa"]

    def go(i, cost, audit, made):
        nonlocal best
        if cost > 3 * n or (best and cost > best[0]):
            return
        for ins in inserts:
            c, a, m = cost + 2 * len(ins), audit + "I" * len(ins), made + [({"u": "user", "a": "assistant"}[x], "") for x in ins]
            if i == n:
                if re.fullmatch("(s?(ua)+)?", "".join(r[:1] or "-" for r, _ in m)) and (best is None or (c, a) < best[:2]):
                    best = (c, a, m)
                continue
            (role, text), kind = turns[i], kinds[i]
            go(i + 1, c + 3, a + "D", m)
            if kind not in ("blank", "duplicate"):
                more = kind == "truncated"
                go(i + 1, c + more, a + "K", m + [(role, text)])
                for r in ("user", "assistant"):
                    go(i + 1, c + 2 + more, a + "R", m + [(r, text)])

    go(0, 0, "", [])
    return best


def cheapest_long(turns, kinds):
    """The same by plain recursion over the place and the last role, for any number of turns."""
    ok = {"": "su", "s": "u", "u": "a", "a": "u"}

    @lru_cache(None)
    def go(i, last, inserted=0):
        ways = []
        if i == len(turns):
            if last in ("", "a"):
                ways.append((0, "", ()))
        else:
            (role, text), kind = turns[i], kinds[i]
            c, a, m = go(i + 1, last)
            ways.append((c + 3, "D" + a, m))
            if kind not in ("blank", "duplicate"):
                for r, op in [(role, "K"), ("user", "R"), ("assistant", "R")]:
                    if r and r[0] in ok[last]:
                        c, a, m = go(i + 1, r[0])
                        ways.append((c + 2 * (op == "R") + (kind == "truncated"), op + a, ((r, text), *m)))
        if inserted < 2:
            for r in ("user", "assistant"):
                if r[0] in ok[last]:
                    c, a, m = go(i, r[0], inserted + 1)
                    ways.append((c + 2, "I" + a, ((r, ""), *m)))
        return min(ways, key=lambda w: w[:2], default=(10**9, "", ()))

    return go(0, "")


def brute(rows, least=cheapest_long):
    out = []
    kept = damage(rows)
    for conv in {r[0] for r in rows}:
        mine = [r for r in kept if r[0] == conv]
        mine.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), hashlib.sha256(r[3].encode()).digest()))
        turns = tuple((r[2], r[3]) for r in mine)
        kinds = faults(turns)
        numbers = [r[1] for r in mine if r[1] is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
        cost, audit, made = least(turns, tuple(kinds))
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest()
        out.append((conv, gaps, *(kinds.count(k) for k in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest))
    return sorted(out, key=str)


def made_up(rng, convs, turns):
    rows = []
    for c in range(convs):
        for t in range(rng.randrange(turns)):
            role = rng.choice(["user", "assistant"] * 4 + ["system", "User", "agent", "", None])
            text = rng.choice(["Yes.", "No!", "cut", "cut ", " \t", "", None, f"own {c} {t}?", f"own {c} {t}"])
            rows.append((c, rng.choice([t, t, t, t + 1, None]), role, text))
    return rows


def run(spark, tmp_path, rows, monkeypatch=None, chunk=None):
    path = str(tmp_path / "conversations.parquet")
    spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA + ", place int, conv string").repartition(3).write.mode("overwrite").parquet(path)
    if chunk:
        monkeypatch.setattr(conversation.repair, "__defaults__", (chunk,))
    return sorted(map(tuple, conversation.op11_conversation_repair(spark, str(tmp_path)).collect()), key=str)


def test_every_sequence_of_edits(spark, tmp_path):
    rows = made_up(random.Random(1), 60, 4)
    assert brute(rows, cheapest) == brute(rows)
    assert run(spark, tmp_path, rows) == brute(rows, cheapest)


@pytest.mark.parametrize("chunk", [None, 3])
def test_long_conversations_repeats_nulls_and_chunks(spark, tmp_path, monkeypatch, chunk):
    rows = made_up(random.Random(2), 40, 30) + [(None, 3, "user", "Hi."), (None, None, None, None), (None, 4, "assistant", "Hi.")]
    rows += [(900, k, "user", "same text.") for k in range(40)] + [(901, 5, "user", "twin.")] * 20 + [(902, 7, "user", "long " * 40_000 + ".")]
    rows += [(903, k, "ua"[k % 2].replace("u", "user").replace("a", "assistant"), f"turn {k}.") for k in range(300)]
    rows += [(k, 0, "user", "gone") for k in range(1000, 1040)]
    want = brute(rows)
    assert any(w[7] == "" and w[8] == conversation.EMPTY for w in want) and any("I" in w[7] for w in want)
    assert run(spark, tmp_path, rows, monkeypatch, chunk) == want


def test_nodes_are_shared_by_signatures_that_end_alike():
    words = ["ua", "suA", "xua", "uaua", "xuaua", "oua"]
    automaton = conversation.Automaton()
    for w in sorted("$" + w[::-1] for w in words):
        automaton.entry(w)
    endings = {w[::-1][:k] for w in words for k in range(len(w) + 1)}
    assert automaton.made == len(endings)


def test_empty(spark, tmp_path):
    assert run(spark, tmp_path, []) == []


def test_given_table(spark):
    rows = [tuple(r.values()) for r in pq.read_table(f"{SF}/conversations.parquet", columns=["conv_id", "turn", "role", "text"]).to_pylist()]
    assert sorted(map(tuple, conversation.op11_conversation_repair(spark, SF).collect()), key=str) == brute(rows)
