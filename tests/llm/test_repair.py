"""Conversation repair against a plain search over edits."""

import functools
import hashlib
import random
import re
import zlib

import pytest

from revwatch.llm import repair

FIELDS = "conv_id long, turn long, role string, text string, symbols string, whole string, o_row string, audit string, cost string"


def cheapest(symbols):
    """(cost, audit) from definitions, by suffixes: prepending an edit keeps the order of the rest."""

    @functools.cache
    def best(at, state, inserts):
        found = []
        if at == len(symbols) and state in (0, 3):
            found.append((0, ""))
        follow = "a" if state == 2 else "u"
        move = {"u": 2, "a": 3, "s": 1}

        def add(cost, edit, rest):
            if rest is not None:
                found.append((cost + rest[0], edit + rest[1]))

        if inserts < 3:
            add(3, "I", best(at, move[follow], inserts + 1))
        if at < len(symbols):
            role, fault = symbols[at]
            more = 3 if fault == "truncated" else 0
            add(4, "D", best(at + 1, state, 0))
            if fault not in ("blank", "duplicate"):
                if role == follow or role == "s" and state == 0:
                    add(more, "K", best(at + 1, move[role], 0))
                for new in "ua":
                    if new == follow:
                        add(3 + more, "R", best(at + 1, move[new], 0))
        return min(found, default=None)

    return best(0, 0, 0)


def expected(rows, damage=False):
    """Digest rows of (conv_id, turn, role, text), one conversation after another."""
    out = []
    space = lambda v: " " if v is None else str(v)
    for conv in dict.fromkeys(r[0] for r in rows):
        own = []
        for c, turn, role, text in (r for r in rows if r[0] == conv):
            role, text, copies = space(role), space(text), 1
            fault = zlib.crc32(f"{space(c)}:{space(turn)}".encode()) % 20 if damage else -1
            if fault == 0:
                continue
            text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
            role = "user" if fault == 4 else role
            own += [(turn, role, text)] * (2 if fault == 3 else 1)
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, hashlib.md5(f"{r[1]}:{r[2]}".encode()).hexdigest()))
        seen, symbols, count = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0, "": 0}
        for _, role, text in own:
            ink = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = "blank" if not ink else "duplicate" if (role, text) in seen else "" if ink[-1] in ".!?" else "truncated"
            seen.add((role, text))
            count[fault] += 1
            symbols.append((role[:1], fault))
        cost, audit = cheapest(tuple(symbols))
        lines, at, state = [], 0, None
        for edit in audit:
            if edit in "KR" or edit == "I":
                role = own[at][1] if edit == "K" else "assistant" if state == "u" else "user"
                lines.append(f"{role}:{'' if edit == 'I' else own[at][2]}")
                state = role[:1]
            at += edit != "I"
        turns = {t for t, _, _ in own if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out.append((conv, gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit, digest))
    return sorted(out, key=repr)


def taken(found):
    names = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    assert set(found.columns) == set(names)
    return sorted((tuple(r[n] for n in names) for r in found.collect()), key=repr)


def made(spark, rows):
    return spark.createDataFrame([(*r, *["x"] * 5) for r in rows], FIELDS).repartition(3)


def talk(r, conv, n):
    rows, turn = [], r.randrange(3)
    for _ in range(n):
        role = r.choice(("user", "assistant", "user", "assistant", "system", "User", "", None, "tool", "ümlaut"))
        text = r.choice(("Yes.", "No!", "So? \n", "well", "", " \t", None, "日本。", "a.b", f"line {r.randrange(9)}."))
        rows.append((conv, r.choice((turn, turn, turn, None)), role, text))
        turn += r.choice((0, 1, 1, 1, 2))
    return rows


def cases():
    r = random.Random(2)
    rows = [x for conv in range(120) for x in talk(r, conv, r.randrange(1, 9))]
    for conv in range(200, 260):  # well formed ones, and some with one fault
        for turn in range(r.randrange(1, 9)):
            rows.append((conv, turn, ("user", "assistant")[turn % 2], f"Line {turn}."))
    rows += talk(r, None, 7) + talk(r, 300, 90) + [(301, 1, "user", "Same.")] * 40
    return rows + [(302, t * 10**17, "user", "x" * 5000 + ".") for t in range(3)]


@pytest.mark.parametrize("most,damage", [(4096, True), (4096, False), (3, True), (3, False)])
def test_repairs_equal_plain_search(spark, monkeypatch, most, damage):
    monkeypatch.setattr(repair, "ROWS", most)
    rows = cases()
    table = made(spark, rows)
    given = repair.damaged(table) if damage else table
    assert taken(repair.repair_digest(repair.repair_conversations(given))) == expected(rows, damage)


def test_repaired_rows_and_empty_tables(spark):
    rows = [(1, 0, "system", "Be brief."), (1, 1, "user", "Hi."), (1, 2, "user", "There?")]
    found = repair.repair_conversations(made(spark, rows)).first()
    assert (found.cost, found.audit) == (3, "KKR")
    assert [m.role for m in found.repaired] == ["system", "user", "assistant"]
    assert [m.text for m in found.repaired] == ["Be brief.", "Hi.", "There?"]
    assert repair.repair_conversations(made(spark, [])).count() == 0
    gone = repair.repair_conversations(made(spark, rows[:1]).selectExpr("*", "false AS present")).first()
    assert (gone.conv_id, gone.cost, gone.audit, gone.repaired) == (1, 0, "", [])


def test_rules_repeat_the_product_of_their_symbols():
    """A grammar's matrices give the same costs and audits as symbols taken one by one."""
    r = random.Random(5)
    pair = lambda n, m: {(r.randrange(n), r.randrange(n)): n + i for i in range(m)}
    first = pair(9, 12)
    first = {p: 9 + i for i, p in enumerate(first)}
    second = {p: 9 + len(first) + i for i, p in enumerate(pair(9 + len(first), 12))}
    grammar, plain = repair.Grammar([first, second]), repair.Grammar([])
    for _ in range(300):
        symbols = "".join(r.choice(repair.SYMBOLS) for _ in range(r.randrange(1, 14)))
        names = {"D": ("u", "blank")}
        own = tuple(names.get(s) or (s.lower(), "truncated" if s.islower() else "") for s in symbols)
        assert grammar.best(symbols) == plain.best(symbols) == cheapest(own)


def test_learnt_rules_shrink_common_sequences(spark):
    rows = [("UA" * n + "D" * (n % 2),) for n in range(1, 40)]
    grammar = repair.learn(spark.createDataFrame(rows, "symbols string"))
    assert len(grammar.compressed("UA" * 32)) <= 4
    assert len(grammar.matrices) == len(repair.SYMBOLS) + sum(map(len, grammar.rounds))
