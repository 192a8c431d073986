import json
import os
import random
import subprocess
import sys
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from shelfspark.llm import tool_chat as C

SF = "/root/testdata/sf0.001"
TOOLS = {"add": {"properties": {"a": "integer", "b": "number", "s": "string"}, "required": ["a"]}}


def canonical(x):
    return json.dumps(x, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def make(spark, rows):
    rows = [(c, t, r, x if x is None or isinstance(x, str) else json.dumps(x)) for c, t, r, x in rows]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").coalesce(1)
    return df.withColumn("id", F.lit("clash")).withColumn("level", F.lit(1)).withColumn("json", F.lit(0))


def call(id_, name="add", args=None, after=()):
    return {"id": id_, "name": name, "arguments": {"a": 1} if args is None else args, "after": list(after)}


def by_call(df):
    return {r["call_id"]: r for r in df.collect() if r["kind"] == "call"}


def test_links_order_and_status(spark):
    rows = [(1, 0, "user", "hi"),
            (1, 1, "assistant", {"content": "wait", "tool_calls": [call("x", after=["y"]), call("y"), call("z", after=["x", "q"])]}),
            (1, 2, "tool", {"tool_call_id": "x", "content": "rx"}),
            (1, 3, "tool", {"tool_call_id": "y", "content": "ry"}),
            (1, 4, "tool", {"tool_call_id": "y", "content": "again"}),
            (1, 5, "tool", {"tool_call_id": "nobody", "content": "?"}),
            (1, 6, "tool", "not json"),
            (2, 0, "assistant", {"tool_calls": [call("x", after=["w"]), call("w", after=["x"]), call("v", after=["w"]), call(None)]})]
    out = C.format_tool_chats(make(spark, rows), TOOLS)
    got = out.where("conv_id = 1").orderBy("position").collect()
    assert [(r["position"], r["kind"], r["call_id"], r["level"], r["status"]) for r in got] == [
        (0, "message", None, 0, "ok"), (1, "message", None, 0, "ok"), (2, "call", "y", 0, "ok"), (3, "call", "x", 1, "ok"),
        (4, "call", "z", 2, "no_result"), (5, "result", "y", 0, "duplicate_result"),
        (6, "result", "nobody", 0, "orphan_result"), (7, "result", None, 0, "bad_result")]
    assert json.loads(got[1]["json"]) == {"content": "wait", "kind": "message", "role": "assistant"}
    c = by_call(out.where("conv_id = 1"))
    assert [(c[k]["level"], c[k]["status"]) for k in "yxz"] == [(0, "ok"), (1, "ok"), (2, "no_result")]
    assert c["y"]["position"] < c["x"]["position"] < c["z"]["position"]
    assert json.loads(c["z"]["json"])["errors"] == ["unknown_dependency:q"]
    assert json.loads(c["x"]["json"])["result"] == "rx"
    c = by_call(out.where("conv_id = 2"))
    assert {k: r["status"] for k, r in c.items()} == {"x": "cycle", "w": "cycle", "v": "cycle", None: "bad_call"}


@pytest.mark.parametrize("args,errors", [
    ({"a": 1}, []), ({"a": 1, "b": 2.5, "s": "x"}, []), ({"a": "1"}, ["type:a"]), ({"b": 1}, ["missing:a"]),
    ({"a": 1.0}, []), ('{"a": 1e2}', ["type:a"]), ('{"a": -12345678901234567890123}', []), ({"a": 1.25}, ["type:a"]),
    ({"a": 1.5, "z": 0, "b": True}, ["extra:z", "type:a", "type:b"]), ([1], ["not_object"]), ("{bad", ["not_object"])])
def test_arguments(spark, args, errors):
    rows = [(1, 0, "assistant", {"tool_calls": [call("x", args=args)]}), (1, 1, "tool", {"tool_call_id": "x", "content": "r"})]
    r = by_call(C.format_tool_chats(make(spark, rows), TOOLS))["x"]
    assert json.loads(r["json"])["errors"] == errors
    assert r["status"] == ("invalid_arguments" if errors else "ok")


def test_canonical_json(spark):
    args = {"s": "Ünï \"q\"\n\\/", "b": 1, "a": 3, "deep": {"z": [1, {"y": None, "x": True}], "c": {}}}
    rows = [(1, 0, "assistant", {"tool_calls": [call("x", args=args)]})]
    r = by_call(C.format_tool_chats(make(spark, rows), TOOLS))["x"]
    assert r["json"] == canonical(json.loads(r["json"]))
    assert json.loads(r["json"])["arguments"] == args


def test_chain_and_random_graphs_are_topological(spark):
    rng = random.Random(2)
    rows, parents = [], defaultdict(dict)
    for conv in range(6):
        n = 8 if conv == 0 else 12
        for i in range(n):
            after = [f"c{i - 1}"] if conv == 0 and i else [f"c{j}" for j in range(n) if conv and i != j and rng.random() < 0.15 and (j > i) == (conv % 2)]
            parents[conv][f"c{i}"] = after
            rows.append((conv, i if conv != 3 else 0, "assistant", {"tool_calls": [call(f"c{i}", after=after)]}))
    out = C.format_tool_chats(make(spark, rows), TOOLS).collect()
    pos = {(r["conv_id"], r["call_id"]): (r["position"], r["level"]) for r in out}
    for conv, calls in parents.items():
        assert sorted(pos[conv, c][0] for c in calls) == list(range(len(calls)))
        for c, after in calls.items():
            assert all(pos[conv, a][0] < pos[conv, c][0] for a in after)
            assert pos[conv, c][1] == (1 + max(pos[conv, a][1] for a in after) if after else 0)


@pytest.mark.parametrize("block", [3, 512])
def test_long_chains_settle_block_by_block(spark, monkeypatch, block):
    """Chains in both directions, a ladder of two parents each, and one that leaps between the ends; a cycle behind a chain."""
    monkeypatch.setattr(C, "BLOCK", block)
    n = 40 if block == 512 else 10
    after = {(1, i): [i - 1] for i in range(1, n)} | {(2, i): [i + 1] for i in range(n - 1)}
    after |= {(3, i): [j for j in (i - 1, i - 2) if j >= 0] for i in range(n)}
    leap = [x for pair in zip(range(4), range(n - 1, n - 5, -1), strict=True) for x in pair]
    after |= {(4, x): [y] for y, x in zip(leap, leap[1:], strict=False)}
    after |= {(5, i): [i - 1] for i in range(1, n)} | {(5, n // 2): [n // 2 - 1, n - 1]}
    edges = spark.createDataFrame([(str(c), f"c{i}", f"c{j}") for (c, i), js in after.items() for j in js], "ck string, id string, parent string")
    calls = spark.createDataFrame([(str(c), f"c{i}", 1000 - i if c == 2 and i % 7 == 0 else i, i, 0) for c in range(1, 6) for i in range(n)],
                                  "ck string, id string, turn0 long, rid long, i int")
    got = {(int(r["ck"]), int(r["id"][1:])): (r["level"], r["due"]) for r in C.levels(calls, edges).collect()}
    want, turn = {}, {(int(r["ck"]), int(r["id"][1:])): r["turn0"] for r in calls.collect()}
    open_ = set(turn)
    while True:
        ready = [x for x in open_ if all((x[0], j) in want for j in after.get(x, []))]
        if not ready:
            break
        for x in ready:
            up = [want[x[0], j] for j in after.get(x, [])]
            want[x] = (max((u[0] + 1 for u in up), default=0), max([turn[x], *(u[1] for u in up)]))
        open_ -= set(ready)
    assert got == want and len(open_) == n - n // 2


def test_rounds_follow_the_blocks_of_a_chain(spark, monkeypatch):
    names = []
    own = C.cut
    monkeypatch.setattr(C, "cut", lambda df, name: (names.append(name), own(df, name))[1])
    n = 1000
    calls = spark.range(n).select(F.lit("x").alias("ck"), F.col("id").cast("string").alias("id"), F.col("id").alias("turn0"),
                                  F.col("id").alias("rid"), F.lit(0).alias("i"))
    edges = calls.where("turn0 > 0").select("ck", "id", (F.col("turn0") - 1).cast("string").alias("parent"))
    out = C.levels(calls, edges)
    assert out.agg(F.count("*"), F.sum("level")).head() == (n, n * (n - 1) // 2)
    assert names.count("settled") <= -(-n // C.BLOCK) + 1


def test_odd_rows(spark):
    rows = [(None, None, None, None), (None, 1, "user", ""), (1, None, "assistant", {"tool_calls": []}), (1, 0, "tool", None),
            (2, 0, "assistant", {"tool_calls": [call("d")]}), (2, 0, "assistant", {"tool_calls": [call("d")]}),
            (2, 1, "tool", {"tool_call_id": "d", "content": "x" * 200_000}), (2, 1, "tool", {"tool_call_id": "d", "content": "x" * 200_000}),
            (3, 2, "assistant", {"tool_calls": [call("e")]}), (3, 1, "tool", {"tool_call_id": "e", "content": "early"})]
    df = make(spark, rows)
    out = C.format_tool_chats(df, TOOLS)
    got = sorted((r["conv_id"] or 0, r["position"], r["kind"], r["status"]) for r in out.collect())
    assert got == [(0, 0, "message", "ok"), (0, 1, "message", "ok"), (1, 0, "result", "bad_result"), (2, 0, "call", "ok"),
                   (2, 1, "call", "duplicate_call"), (2, 2, "result", "duplicate_result"), (3, 0, "call", "result_before_call")]
    assert C.format_tool_chats(df.where("false"), TOOLS).count() == 0


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    convs = defaultdict(dict)
    for c, t, r, x in rows:
        convs[c][t] = (r, x)
    want = {}
    for c, turns in convs.items():
        calls = {t for t, (r, _) in turns.items() if r == "user"}

        def parents(t):
            return sorted({t - 2, t - 2 * ((t + 3) // 4)}, key=str) if t > 1 else []

        def level(t, calls=calls):
            return max((1 + level(p, calls) for p in parents(t) if p in calls), default=0)
        for t, (r, x) in turns.items():
            if r == "user":
                tool = "rewrite" if t % 3 == 2 else "lookup"
                errors = ["missing:style"] if tool == "rewrite" and t % 6 != 2 else []
                errors += sorted(f"unknown_dependency:call-{p}" for p in parents(t) if p not in calls)
                args = {"query": x, "turn": t} | ({"style": "plain"} if t % 6 == 2 else {})
                result = turns[t + 1][1] if turns.get(t + 1, ("",))[0] == "assistant" else None
                status = "no_result" if result is None else "invalid_arguments" if errors else "ok"
                line = {"after": sorted(f"call-{p}" for p in parents(t)), "arguments": args, "errors": errors, "id": f"call-{t}",
                        "kind": "call", "level": level(t), "name": tool, "status": status}
                want[c, t] = canonical(line | ({} if result is None else {"result": result}))
            elif r == "system":
                want[c, t] = canonical({"content": x, "kind": "message", "role": r})
            elif turns.get(t - 1, ("",))[0] != "user":
                want[c, t] = canonical({"content": x, "id": f"call-{t - 1}", "kind": "result", "status": "orphan_result"})
    out = C.query(spark, SF).collect()
    assert {(r["conv_id"], r["turn"]): r["json"] for r in out} == want
    assert len(out) == len(want)
    by = defaultdict(list)
    for r in out:
        by[r["conv_id"]].append((r["position"], r["turn"]))
    assert all([t for _, t in sorted(v)] == sorted(t for _, t in v) and sorted(p for p, _ in v) == list(range(len(v))) for v in by.values())


BEYOND = """
import json
from pyspark.sql import functions as F
from shelfspark.llm import tool_chat as C
from shelfspark.session import get_spark
tools = {"add": {"properties": {"a": "integer", "s": "string"}, "required": ["a"]}}
big = "x" * 20_100_000
rows = [(1, 0, "assistant", json.dumps({"tool_calls": [{"id": "d", "name": "add", "arguments": {"a": 1, "s": big}, "after": []}]})),
        (1, 1, "tool", json.dumps({"tool_call_id": "d", "content": big}))]
spark = get_spark("local[1]", shuffle_partitions=1)
df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
out = C.format_tool_chats(df, tools).collect()
assert [(r["kind"], r["call_id"], r["status"]) for r in out] == [("call", "d", "ok")], [r[:7] for r in out]
line = json.loads(out[0]["json"])
assert line["arguments"] == {"a": 1, "s": big} and line["result"] == big
"""


def test_turns_beyond_the_default_limit_of_the_reader():
    """In a process of its own, whose heap holds turns of 20 million characters."""
    env = os.environ | {"PYSPARK_SUBMIT_ARGS": "--driver-memory 6g pyspark-shell", "PYTHONPATH": os.getcwd()}
    env = {k: v for k, v in env.items() if not k.startswith("PYSPARK_GATEWAY")}
    done = subprocess.run([sys.executable, "-c", BEYOND], env=env, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
