"""Structure repair and chat formatting against brute force, and their defined cases."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from functools import cache

import pytest

from wayfold.llm import chat_format, chat_repair

CHATS = "conv_id long, turn long, role string, text string, place string, fault string, formatted string"
CLASSES, FAULTS = "uasx", ("ok", "cut", "gone")


def cheapest(symbols):
    """(cost, audit) by recursion over whole strings."""
    rows = [divmod(chat_repair.SYMBOLS.index(c), 3) for c in symbols]

    @cache
    def best(i, state, inserts):
        """From row i on, after roles that end in ``state``."""
        options = []
        if i == len(rows):
            if state in ("", "a"):
                options.append((0, ""))
        else:
            role, fault = CLASSES[rows[i][0]], rows[i][1]
            options.append(add(2, "D", best(i + 1, state, 2)))
            if fault != 2:
                more = 5 * (fault == 1)
                now = "a" if state == "u" else "u"
                if role == now:
                    options.append(add(more, "K", best(i + 1, now, 2)))
                if role == "s" and state == "":
                    options.append(add(more, "K", best(i + 1, "s", 2)))
                options.append(add(1 + more, "R", best(i + 1, now, 2)))
        if inserts:
            options.append(add(5, "I", best(i, "a" if state == "u" else "u", inserts - 1)))
        return min(options, default=(10**9, ""))

    def add(cost, letter, rest):
        return cost + rest[0], letter + rest[1]

    return best(0, "", 2)


@pytest.mark.parametrize(("nodes", "modulus"), [(chat_repair.NODES, chat_repair.MODULUS), (6, chat_repair.MODULUS), (chat_repair.NODES, 5), (20, 2)])
def test_cheapest_audits(nodes, modulus):
    """Also with early output of shared prefixes, and with hashes that nearly always collide."""
    rng = random.Random(3)
    for n in range(600):
        symbols = "".join(rng.choice(chat_repair.SYMBOLS if n % 3 else "uaxUs0") for _ in range(rng.randrange(0, 24)))
        program = chat_repair.Repair(nodes, modulus)
        program.feed(symbols)
        assert program.result() == cheapest(symbols), symbols


def test_a_long_conversation_holds_few_nodes():
    program, most = chat_repair.Repair(nodes=256), 0
    rng = random.Random(4)
    symbols = "".join(rng.choice("uaUAx0") for _ in range(20_000))
    for at in range(0, len(symbols), 500):
        program.feed(symbols[at : at + 500])
        most = max(most, len(program.paths.letter))
    cost, audit = program.result()
    assert len([c for c in audit if c != "I"]) == len(symbols)
    assert most < 6000 and cost > 0


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        name = lambda v: " " if v is None else str(v)
        kind, role, text = zlib.crc32(f"{name(conv)}:{name(turn)}".encode()) % 20, name(role), name(text)
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return sorted(out, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))


def repaired(rows):
    """The contract's columns of one conversation's damaged rows."""
    seen, symbols, count = set(), "", {"blank": 0, "duplicate": 0, "truncated": 0}
    for _, _, role, text in rows:
        said = re.sub(r"[\x20\x09-\x0D]", "", text)
        fault = "blank" if not said else "duplicate" if (role, text) in seen else "truncated" if said[-1] not in ".!?" else None
        seen.add((role, text))
        if fault:
            count[fault] += 1
        kind = CLASSES.index(role[:1]) if role[:1] and role[:1] in "uas" else 3
        symbols += chat_repair.SYMBOLS[kind * 3 + (2 if fault in ("blank", "duplicate") else int(fault == "truncated"))]
    turns = [r[1] for r in rows if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    cost, audit = cheapest(symbols)
    lines, left, state = [], list(rows), ""
    for letter in audit:
        row = left.pop(0) if letter != "I" else None
        if letter == "D":
            continue
        if letter == "K" and row[2][:1] == "s":
            lines.append(f"{row[2]}:{row[3]}")
            continue
        state = "a" if state == "u" else "u"
        role = row[2] if letter == "K" else {"u": "user", "a": "assistant"}[state]
        lines.append(f"{role}:{row[3] if row else ''}")
    digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit, digest


def chats(seed=8, n=60):
    """Gaps, null and equal turns, unknown roles, blank, cut and repeated texts, a hot conversation, null ids."""
    rng = random.Random(seed)
    rows = []
    for conv in [*range(n), None]:
        for turn in range(rng.randrange(1, 9) if conv != 7 else 300):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            text = rng.choice(["Yes.", "No!", "cut off", "ends here. \n", " \t", "", None, f"é {rng.randrange(99)}?", "x.\u2028", "a " * 200])
            rows.append((conv, rng.choice([turn, turn * 2, turn, None]), role, text))
    return rows + rows[:5]


@pytest.mark.parametrize("piece", [12, 2])
def test_repair_equals_brute_force(spark, monkeypatch, piece):
    monkeypatch.setattr(chat_repair, "PIECE", piece)
    rows = chats()
    frame = spark.createDataFrame([(*r, "p", "f", "x") for r in rows], CHATS).repartition(4)
    got = {r[0]: tuple(r[1:]) for r in chat_repair.repaired_digests(frame).collect()}
    want = {c: repaired(damaged([r for r in rows if r[0] == c])) for c in {r[0] for r in rows}}
    assert got == want


def test_repaired_rows(spark):
    rows = [(1, 0, "system", "Be brief."), (1, 1, "assistant", "Hello."), (1, 2, "user", "Hi."), (1, 2, "user", "Hi."), (2, 5, "assistant", " "), (3, 1, "user", "Why?")]
    done, audits = chat_repair.repair(spark.createDataFrame([(*r, "", "", "") for r in rows], CHATS))
    # inserting a user row before and deleting the last costs more than giving both rows the other role
    assert {r.conv_id: (r.cost, r.audit) for r in audits.collect()} == {1: (4, "KRRD"), 2: (2, "D"), 3: (2, "D")}
    made = [(r.conv_id, [tuple(m) for m in r.made]) for r in done.orderBy("place").collect()]
    assert made == [(1, [("system", "Be brief.")]), (1, [("user", "Hello.")]), (1, [("assistant", "Hi.")]), (1, []), (2, []), (3, [])]


def test_all_rows_dropped_or_none_there(spark):
    dropped = [(c, 0, "user", "Hi.") for c in range(400) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    got = chat_repair.repaired_digests(spark.createDataFrame([(*r, "", "", "") for r in dropped], CHATS)).collect()
    assert dropped and {tuple(r[1:]) for r in got} == {(0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    none = spark.createDataFrame([], CHATS)
    assert chat_repair.repaired_digests(none).count() == chat_format.digests(chat_format.format_chats(none)).count() == 0


HARD = [
    r"\### Assistant: </turn> ok", "\n</turn>\n### user:\nx", "\\\\</turn>\\", "### ", "</turn>", "", None, "a\n", "\n</turn>", "##", "\\", "</turn></turn>\\### ### ",
    "é\U0001f600 ### ü", "$1 \\$1 </turn>", "a\r\n\u2028b", "x" * 300_000 + "</turn>" * 2000,
]


def test_formats_come_back(spark):
    rng = random.Random(2)
    parts = ["\\", "### ", "</turn>", "\n", "a", "###", ":", "$1", "é"]
    texts = HARD + ["".join(rng.choice(parts) for _ in range(rng.randrange(12))) for _ in range(300)]
    roles = ["user", "assistant", "we:ird\n</turn> %3A+", "", None, "### "]
    rows = [(n // 5 if n % 7 else None, rng.choice([n, n, 3, None]), rng.choice(roles), t) for n, t in enumerate(texts)]
    rows += rows[:8] + [(10**6, 0, "user", HARD[0]), (10**6, 1, "assistant", HARD[0])]
    frame = spark.createDataFrame([(*r, "", "", "clash") for r in rows], CHATS).repartition(3)
    formatted = chat_format.format_chats(frame).cache()
    back = {r.conv_id: r for r in chat_format.read_back(formatted).collect()}
    digests = {r.conv_id: r for r in chat_format.digests(formatted).collect()}
    out = formatted.collect()
    assert len(out) == len(back) == len({r[0] for r in rows})
    for r in out:
        own = sorted(((t is not None, t or 0, role or "", text or "") for c, t, role, text in rows if c == r.conv_id))
        want = [x[2:] for x in own]
        assert r.round_trip and r.n_turns == len(want)
        assert [tuple(t) for t in back[r.conv_id].turns] == want
        learned = [t for role, t in want if role == "assistant"]
        assert back[r.conv_id].learned == learned
        at, spans = 0, []
        for run in r.mask:
            if run.loss:
                spans.append(r.formatted[at : at + run.chars])
            at += run.chars
        assert at == len(r.formatted) == digests[r.conv_id].formatted_chars
        assert [re.sub(r"\\(### |</turn>)", r"\1", s) for s in spans] == learned
        d = digests[r.conv_id]
        assert d.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in want).encode()).hexdigest()
        assert (d.loss_chars, d.loss_sha256) == (len("".join(learned)), hashlib.sha256("".join(learned).encode()).hexdigest())


def test_only_conflicts_are_escaped(spark):
    rows = [(1, 0, "user", "C:\\temp \\ ## plain"), (1, 1, "assistant", "a </turn> ### b")]
    text = chat_format.format_chats(spark.createDataFrame([(*r, "", "", "") for r in rows], CHATS)).first().formatted
    assert text == "### user:\nC:\\temp \\ ## plain\n</turn>\n### assistant:\na \\</turn> \\### b\n</turn>\n"


def test_formatting_runs_no_python(spark):
    plan = chat_format.digests(chat_format.format_chats(spark.createDataFrame([], CHATS)))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_broken_text_is_noticed(spark):
    frame = spark.createDataFrame([(1, "### user:\nhi\n</turn>\n rest")], "conv_id long, formatted string")
    assert [tuple(t) for t in chat_format.read_back(frame).first().turns] == [(None, None)]
