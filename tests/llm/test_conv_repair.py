import functools
import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from shelfspark.llm import conv_repair as R

SCHEMA = "conv_id long, turn long, role string, text string"
SPACE = "\x20\x09-\x0D"


def damage(rows):
    """The contract's damage, read literally: (conv, turn, role, text) -> rows."""
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        role, text = " " if role is None else role, " " if text is None else text
        h = zlib.crc32(key.encode()) % 20
        if h == 0:
            continue
        if h == 1:
            text = ""
        if h == 2:
            text = re.sub("[.!?]", "", text)
        if h == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if h == 3 else 1)
    return out


def best_edits(rows):
    """(cost, audit) by plain recursion from the end: rows are (initial, fault)."""
    legal = {"": "su", "s": "u", "u": "a", "a": "u"}

    @functools.cache
    def best(i, last, inserts):
        ways = [(0, "")] if i == len(rows) and last in ("", "a") else []
        nexts = [x for x in "ua" if x in legal[last]]
        if inserts < 3:
            ways += [(c + 2, "I" + a) for x in nexts for c, a in [best(i, x, inserts + 1)] if c < 10 ** 6]
        if i < len(rows):
            initial, fault = rows[i]
            c, a = best(i + 1, last, 0)
            ways.append((c + 3, "D" + a))
            if fault not in ("blank", "duplicate"):
                t = int(fault == "truncated")
                if initial and initial in legal[last]:
                    c, a = best(i + 1, initial, 0)
                    ways.append((c + t, "K" + a))
                for x in nexts:
                    c, a = best(i + 1, x, 0)
                    ways.append((c + 2 + t, "R" + a))
        return min(ways, default=(10 ** 6, ""))
    return best(0, "", 0)


def brute(rows, damaging=True):
    ids = {r[0] for r in rows}
    after = damage(rows) if damaging else [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    out = set()
    for conv in ids:
        mine = sorted((r for r in after if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        seen, steps, count = set(), [], dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        for _, _, role, text in mine:
            fault = None
            if not re.search(f"[^{SPACE}]", text):
                fault = "blank"
            elif (role, text) in seen:
                fault = "duplicate"
            elif text.strip(" \t\n\x0b\x0c\r")[-1] not in ".!?":
                fault = "truncated"
            seen.add((role, text))
            if fault:
                count[fault] += 1
            steps.append((role[:1], fault))
        turns = {r[1] for r in mine if r[1] is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(steps, steps[1:], strict=False))
        cost, audit = best_edits(tuple(steps))
        lines, last, k = [], "", 0
        for e in audit:
            other = "assistant" if last == "u" else "user"
            role, text = (other, "") if e == "I" else mine[k][2:]
            k += e != "I"
            if e == "R":
                role = other
            if e != "D":
                lines.append(f"{role}:{text}")
                last = role[0]
        assert re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in lines))
        sha = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out.add((conv, gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit, sha))
    return out


def rows_of(df):
    assert df.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    got = [tuple(r) for r in df.collect()]
    assert len(got) == len(set(got))
    return set(got)


def conversations(seed, n=60, longest=9):
    rnd = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(rnd.randint(1, longest)):
            role = rnd.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "User"])
            text = rnd.choice(["Yes.", "No!", "What? ", "cut off", "", " \t", None, "Yes.", f"line {t}.", f"é {t}\n"])
            rows.append((c, t if rnd.random() < 0.8 else rnd.choice([None, t + 5, 0]), role, text))
    return rows


def test_agenda_equals_recursion():
    rnd = random.Random(2)
    names = {None: R.FINE, "blank": R.BLANK, "duplicate": R.DUPLICATE, "truncated": R.CUT_OFF}
    for _ in range(400):
        rows = tuple((rnd.choice("suaxu"), rnd.choice([None, None, "blank", "truncated"])) for _ in range(rnd.randint(0, 8)))
        plain = [(i, names[f]) for i, f in rows]
        want = best_edits(rows)
        assert list(R.derive(plain, 0, True).values()) == [want]
        cuts = sorted(rnd.randint(0, len(rows)) for _ in range(rnd.randint(0, 3)))
        parts = [plain[a:b] for a, b in zip([0, *cuts], [*cuts, len(rows)], strict=True)]
        ways = [[{"enter": p, "leave": q, "cost": c, "audit": a} for p in R.STATES for q, (c, a) in
                 R.derive(x, p, False).items()] for x in parts]
        assert R.chain(ways) == want


@pytest.mark.parametrize("segment", [512, 3, 1])
def test_query_equals_brute_force(spark, tmp_path, monkeypatch, segment):
    monkeypatch.setattr(R, "SEGMENT", segment)
    rows = conversations(segment) + [(None, None, "user", "a."), (None, 3, None, None), (900, 2 ** 62, "user", "b."),
                                     (900, -(2 ** 62), "assistant", "c."), (901, 1, "user", "x" * 300_000)]
    rows += [(902, t, "user" if t % 2 else "assistant", f"turn {t}.") for t in range(90)]
    rows += [(903, 4, "user", "same.")] * 9 + [(904, None, "system", "same.")] * 5
    df = spark.createDataFrame(rows, SCHEMA).select("*", *[F.lit("z").alias(c) for c in ("_at", "fault", "audit", "first")])
    df.repartition(5).write.parquet(str(tmp_path / "conversations.parquet"))
    assert rows_of(R.query(spark, str(tmp_path))) == brute(rows)


def test_whole_small_table_equals_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r[c] for c in ("conv_id", "turn", "role", "text"))
            for r in spark.read.parquet(f"{sf}/conversations.parquet").collect()]
    assert rows_of(R.query(spark, sf)) == brute(rows)


def test_repaired_turns_and_empty_table(spark, tmp_path):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "Hi."), (1, 2, "user", "Well"), (2, 0, "tool", " ")]
    placed = R.in_order(spark.createDataFrame(rows, SCHEMA))
    done = R.repairs(placed)
    assert {(r["conv_id"], r["cost"], r["audit"]) for r in done.collect()} == {(1, 6, "KDR"), (2, 3, "D")}
    got = sorted(tuple(r) for r in R.repaired_turns(placed, done).collect())
    assert got == [(1, 0, "user", "Hi."), (1, 1, "assistant", "Well")]
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "conversations.parquet"))
    assert rows_of(R.query(spark, str(tmp_path))) == set()
