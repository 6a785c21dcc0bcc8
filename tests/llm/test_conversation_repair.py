import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest

from postmill.llm import conversation_repair as cr

SCHEMA = "conv_id long, turn long, role string, text string, fault string, copies string"


def damage(rows):
    """(conv_id, turn, role, text) after damage; None for a dropped row."""
    for conv, turn, role, text in rows:
        spaced = [" " if x is None else str(x) for x in (conv, turn)]
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(":".join(spaced).encode()) % 20
        if kind == 0:
            yield conv, None
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        for _ in range(2 if kind == 3 else 1):
            yield conv, (turn, "user" if kind == 4 else role, text)


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        wordy = re.findall(r"[^\x20\x09-\x0D]", text)
        if not wordy:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("" if wordy[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def cheapest(rows, kinds):
    """Cost, audit and repaired rows by shortest paths that keep whole audits as text."""
    best = {("", 0): (0, "", [])}  # by pattern state and rows read

    def follows(state, role):
        return {"s": state == "", "u": state in ("", "s", "a"), "a": state == "u"}.get(role[:1], False)

    for i in range(len(rows) + 1):
        for _ in range(3):
            for state in ("", "s", "u", "a"):
                if (state, i) in best:
                    cost, audit, out = best[state, i]
                    for role in ("user", "assistant"):
                        if follows(state, role):
                            way = (cost + 3, audit + "I", [*out, (role, "")])
                            key = (role[0], i)
                            if key not in best or way[:2] < best[key][:2]:
                                best[key] = way
        if i == len(rows):
            break
        _, role, text = rows[i]
        for state in ("", "s", "u", "a"):
            if (state, i) not in best:
                continue
            cost, audit, out = best[state, i]
            ways = [(state, cost + 4, audit + "D", out)]
            if kinds[i] not in ("blank", "duplicate"):
                more = 3 if kinds[i] == "truncated" else 0
                if follows(state, role):
                    ways.append((role[0], cost + more, audit + "K", [*out, (role, text)]))
                for new in ("user", "assistant"):
                    if follows(state, new):
                        ways.append((new[0], cost + more + 3, audit + "R", [*out, (new, text)]))
            for to, *way in ways:
                if (to, i + 1) not in best or tuple(way[:2]) < best[to, i + 1][:2]:
                    best[to, i + 1] = tuple(way)
    return min((best[s, len(rows)] for s in ("", "a") if (s, len(rows)) in best), key=lambda w: w[:2])


def brute(rows):
    by_conv = defaultdict(list)
    for conv, row in damage(rows):
        by_conv[conv] += [row] if row else []
    reports, texts = {}, {}
    for conv, own in by_conv.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        kinds = faults(own)
        turns = {r[0] for r in own} - {None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(own))
        cost, audit, out = cheapest(own, kinds)
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
        counts = [kinds.count(k) for k in ("blank", "duplicate", "truncated")]
        reports[conv] = (conv, gaps, *counts, illegal, cost, audit, digest)
        texts[conv] = out
    return reports, texts


def corpus(seed):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "So it is", "Why?", "", "  \n", None, "end. ", "a.b", "é."]
    roles = ["user", "assistant", "system", "user", "assistant", None, "", "System", "ursa", "tool"]
    rows = []
    for conv in [*range(250), None]:
        n = rng.choice([1, 2, 3, 5, 8, 13])
        for turn in range(n):
            turn = rng.choice([turn, turn, turn, turn, rng.randint(-2, n + 4), None])
            role = ("user", "assistant")[turn % 2] if turn is not None and rng.random() < 0.6 else rng.choice(roles)
            text = rng.choice(texts) if rng.random() < 0.5 else f"words {rng.random()}" + rng.choice([".", "?", ""])
            rows += [(conv, turn, role, text)] * rng.choice([1, 1, 1, 1, 2, 5])
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_reports_and_repairs_equal_brute_force(spark, seed):
    rows = corpus(seed)
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(5)
    damaged = cr.damaged(df)
    reports = cr.repairs(damaged)
    want, texts = brute(rows)
    got = {r.conv_id: tuple(r) for r in reports.collect()}
    assert got == want
    out = defaultdict(list)
    for r in sorted(cr.repaired(damaged, reports).collect(), key=lambda r: r.place):
        out[r.conv_id].append((r.role, r.text))
    assert {c: t for c, t in texts.items() if t} == dict(out)


def test_long_conversation_is_one_stream(spark):
    """2,000 turns with faults throughout, more than the slots of a weight."""
    rng = random.Random(3)
    rows = [(7, i, rng.choice(["user", "assistant", "tool"]), rng.choice(["x.", f"y{i}.", f"z{i}", ""])) for i in range(2000)]
    got = cr.repairs(cr.damaged(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))).collect()
    assert tuple(got[0]) == brute(rows)[0][7]


def test_paths_that_share_no_edit_widen_the_weight(monkeypatch):
    """Few slots at first: they are freed or doubled without a change of the result."""
    rng = random.Random(4)
    for slots in (6, 64):
        monkeypatch.setattr(cr, "SLOTS", slots)
        rng.seed(5)
        for _ in range(60):
            rows = [(0, rng.choice(["user", "assistant", "system", "x"]), rng.choice(["a.", "b"])) for _ in range(rng.randint(1, 40))]
            kinds = [rng.choice(["", "truncated", "blank"]) for _ in rows]
            repair = cr.Repair()
            for (_, role, text), kind in zip(rows, kinds, strict=True):
                fault = {"": cr.NONE, "truncated": cr.TRUNCATED, "blank": cr.BLANK}[kind]
                repair.feed(fault, role.encode(), text.encode(), role[:1])
            cost, audit, out = cheapest(rows, kinds)
            digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
            assert repair.result() == (cost, audit, digest)


def test_empty_table(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    reports = cr.repairs(cr.damaged(df))
    assert reports.collect() == [] and cr.repaired(cr.damaged(df), reports).collect() == []
