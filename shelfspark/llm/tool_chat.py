"""Chat formatting: tool calls are linked with their results, ordered, validated and serialised.

Messages are (conv_id, turn, role, text). An assistant text that is a JSON object with
``tool_calls`` (id, name, arguments, after: ids it depends on) makes calls and, with ``content``, a
plain message; a text of role ``tool`` that is a JSON object with ``tool_call_id`` and ``content`` is a
result. Everything else is a plain message.

Calls and results are joined by (conversation, identifier). A call's level is one more than the
highest of the calls it depends on. Blocks of ``BLOCK`` calls of a conversation settle their chains in
one pass, and rounds of joins carry the levels from block to block, so the rounds follow the blocks
that a chain crosses, not its length, and no conversation is gathered. A settled call also gets the
turn by which all its parents have come; ordering by (that turn, level, turn, place) is topological.
Arguments are checked against the tool's schema, as the values that the line shows. Each
message, call or stray result becomes one line of canonical JSON: keys sorted at every depth, no
white space, absent values left out. A conversation's lines are numbered without a gap, by
ranks that need no task to hold a whole conversation.

Status of a call, the first that holds: bad_call (no id), duplicate_call (not the first of its id),
cycle (it, or what it depends on, depends on itself), no_result, result_before_call,
invalid_arguments, ok. Results: bad_result (no id), orphan_result, duplicate_result.

Defined results: rows without conv_id make one conversation; null turns sort first; null texts or
roles are left out of the line; equal calls or results (repeated rows too) after the first are
duplicates; ties in turn go by place in the text, then by row; empty tables give no rows; extra
columns are not read. JSON that Spark cannot parse is plain text; its reader's default limits on
strings (20 million characters) and depth (1,000 levels) are lifted, but arguments that nest deeper
than 1,000 levels inside a call cannot be copied out of it, so that text stays plain. Arguments that
no variant can hold stand in the line as their raw text.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.llm.common import cut, rank_within
from shelfspark.operators.curate import LIMITS

#: Calls of a conversation that one pass settles together.
BLOCK = 512
#: JSON types by the names of a value's kind. An integer is a number that the line shows without fraction or exponent.
KINDS = {"string": "^STRING$", "integer": "^(BIGINT|DOUBLE|FLOAT|DECIMAL.*)$", "number": "^(BIGINT|DOUBLE|FLOAT|DECIMAL.*)$",
         "boolean": "^BOOLEAN$", "object": "^OBJECT<", "array": "^ARRAY<"}
CALLS = ("content string, tool_calls array<struct<id: string, name: string, arguments: string, after: array<string>>>")
RESULT = "tool_call_id string, content string"
#: Variants are built and shown level by level on the task's stack, so their depth keeps the reader's default limit.
VARIANT = {"maxStringLen": LIMITS["maxStringLen"]}
#: The tools of the registered query.
TOOLS = {"lookup": {"properties": {"query": "string", "turn": "integer"}, "required": ["query", "turn"]},
         "rewrite": {"properties": {"query": "string", "turn": "integer", "style": "string"},
                     "required": ["query", "style"]}}


def _variant(json) -> F.Column:
    """A variant of a JSON column, also with strings beyond the reader's default limit; null: none can hold it."""
    return F.coalesce(F.try_parse_json(json), F.from_json(json, "variant", VARIANT))


def argument_errors(tools: dict) -> F.Column:
    """The schema errors of columns (name, arguments), sorted."""
    value = _variant("arguments")
    kind = F.schema_of_variant(value)
    out = F.array(F.lit("unknown_tool"))
    for tool, schema in sorted(tools.items()):
        props, need = schema.get("properties", {}), schema.get("required", [])
        checks = []
        for p in sorted({*props, *need}):
            path = "$['" + p.replace("'", "\\'") + "']"
            held = F.try_variant_get(value, path, "variant")
            at = F.schema_of_variant(held)
            if p in need:
                checks.append(F.when(at.isNull(), F.lit(f"missing:{p}")))
            if p in props:
                fits = at.rlike(KINDS[props[p]])
                if props[p] == "integer":
                    fits = fits & F.to_json(held).rlike("^-?[0-9]+$")
                checks.append(F.when(at.isNotNull() & ~fits, F.lit(f"type:{p}")))
        known = F.array(*[F.lit(p) for p in props]).cast("array<string>")
        extra = F.transform(F.array_except(F.json_object_keys("arguments"), known), lambda k: F.concat(F.lit("extra:"), k))
        found = F.concat(F.array_compact(F.array(*checks).cast("array<string>")), F.coalesce(extra, F.array().cast("array<string>")))
        errors = F.when(F.coalesce(kind.startswith("OBJECT"), F.lit(False)), F.array_sort(found)).otherwise(
            F.array(F.lit("not_object")))
        out = F.when(F.col("name") == tool, errors).otherwise(out)
    return out


def _settle(rows) -> F.Column:
    """The calls of a block (pos, level, due, parents) that can be settled, forwards through ``rows`` and then backwards.

    parents: places of the open calls that a call depends on; a call is settled when all of them stand settled before it.
    """
    def step(done, r):
        hit = F.filter(done, lambda x: F.array_contains(r["parents"], x["pos"]))
        level = F.greatest(r["level"], F.array_max(F.transform(hit, lambda x: x["level"] + 1)))
        due = F.greatest(r["due"], F.array_max(F.transform(hit, lambda x: x["due"])))
        one = F.array(F.struct(r["pos"].alias("pos"), level.alias("level"), due.alias("due")))
        return F.when(F.size(hit) == F.size(r["parents"]), F.concat(done, one)).otherwise(done)

    forth = F.aggregate(rows, F.array().cast("array<struct<pos:bigint,level:int,due:bigint>>"), step)
    both = F.struct(forth.alias("done"), rows.alias("rs"))
    rest = lambda x: F.reverse(F.filter(x["rs"], lambda r: ~F.array_contains(x["done"]["pos"], r["pos"])))
    return F.transform(F.array(both), lambda x: F.aggregate(rest(x), x["done"], step))[0]


def levels(calls: DataFrame, edges: DataFrame) -> DataFrame:
    """(ck, id, level, due) of calls (ck, id, turn0, rid, i); edges (ck, id, parent). Calls on or behind a cycle: no row.

    due: the latest turn of the call and all it depends on. Each round settles, block by block of ``BLOCK`` calls in the
    order of the conversation, all calls whose parents are settled or come settled earlier in the block, and hands their
    levels on to the open calls of other blocks. A round always settles the calls without open parents, so one that
    settles none is the last.
    """
    known = cut(rank_within(calls.select("ck", "id", "turn0", "rid", "i"), ["ck"], ["turn0", "rid", "i"], "pos", "call-order")
                .select("ck", "id", "pos", "turn0"), "call-places")
    place = known.select("ck", "id", "pos")
    edges = (edges.join(place, ["ck", "id"]).drop("id")
             .join(place.select("ck", F.col("id").alias("parent"), F.col("pos").alias("ppos")), ["ck", "parent"])
             .select("ck", "pos", "ppos").distinct())
    edges = cut(edges, "edges")
    left = known.select("ck", "pos", F.lit(0).alias("level"), F.col("turn0").alias("due"))
    parts = []
    while True:
        parents = edges.groupBy("ck", "pos").agg(F.collect_list("ppos").alias("parents"))   # bounded by the call's own list
        rows = left.join(parents, ["ck", "pos"], "left").select(
            "ck", F.floor(F.col("pos") / BLOCK).alias("block"), F.struct(
                "pos", "level", "due", F.coalesce("parents", F.array().cast("array<bigint>")).alias("parents")).alias("r"))
        blocks = rows.groupBy("ck", "block").agg(F.array_sort(F.collect_list("r")).alias("rs"))
        done = cut(blocks.select("ck", F.explode(_settle(F.col("rs"))).alias("d")).select("ck", "d.*"), "settled")
        if not done.limit(1).count():
            break
        parts.append(done)
        if len(parts) > 16:    # very long chains across blocks: one table again
            parts = [cut(reduce(DataFrame.union, parts), "settled")]
        left = left.join(done.select("ck", "pos"), ["ck", "pos"], "left_anti")
        waits = edges.join(left.select("ck", "pos"), ["ck", "pos"], "left_semi")
        past = done.select("ck", F.col("pos").alias("ppos"), (F.col("level") + 1).alias("plevel"), F.col("due").alias("pdue"))
        waits = cut(waits.join(past, ["ck", "ppos"], "left"), "waits")
        came = waits.groupBy("ck", "pos").agg(F.max("plevel").alias("plevel"), F.max("pdue").alias("pdue"))
        left = cut(left.join(came, ["ck", "pos"], "left").select(
            "ck", "pos", F.greatest("level", "plevel").alias("level"), F.greatest("due", "pdue").alias("due")), "open-calls")
        edges = waits.where("plevel is null").select("ck", "pos", "ppos")
    if not parts:
        return known.where("false").select("ck", "id", F.lit(0).alias("level"), F.col("turn0").alias("due"))
    return reduce(DataFrame.union, parts).join(place, ["ck", "pos"]).select("ck", "id", "level", "due")


def format_tool_chats(messages: DataFrame, tools: dict) -> DataFrame:
    """(conv_id, position, kind, turn, call_id, level, status, json): one row of each message, call and stray result."""
    kind = messages.schema["conv_id"].dataType
    m = messages.select(F.to_json(F.struct("conv_id")).alias("ck"), F.col("turn").cast("long").alias("turn"), "role", "text",
                        F.monotonically_increasing_id().alias("rid"))
    m = cut(m.withColumn("turn0", F.coalesce("turn", F.lit(-(1 << 62)))), "messages")
    keep = ["ck", "turn", "turn0", "rid"]
    spoken = m.withColumn("j", F.when(F.col("role") == "assistant", F.from_json("text", CALLS, LIMITS)))
    has_calls = F.col("j.tool_calls").isNotNull()
    results = (m.where("role = 'tool'").withColumn("j", F.from_json("text", RESULT, LIMITS)).where("j.tool_call_id is not null")
               .select(*keep, F.col("j.tool_call_id").alias("id"), F.col("j.content").alias("content")))
    bad_result = (m.where("role = 'tool'").withColumn("j", F.from_json("text", RESULT, LIMITS))
                  .where("j.tool_call_id is null").select(*keep, "text"))
    calls = cut(spoken.where(has_calls).select(*keep, F.posexplode("j.tool_calls").alias("i", "c")).select(
        *keep, "i", "c.id", "c.name", "c.arguments", F.array_sort(F.array_distinct(F.coalesce(
            F.filter("c.after", lambda x: x.isNotNull()), F.array().cast("array<string>")))).alias("after")), "calls")
    plain = spoken.where((F.col("role").isNull() | (F.col("role") != "tool"))
                         & (~has_calls | F.col("j.content").isNotNull())).select(
        *keep, "role", F.when(has_calls, F.col("j.content")).otherwise(F.col("text")).alias("content"))

    place = F.struct("turn0", "rid", "i")
    first = calls.where("id is not null").groupBy("ck", "id").agg(F.min(place).alias("first"))
    named = calls.join(first, ["ck", "id"], "left")
    lead = cut(named.where(place == F.col("first")).drop("first"), "first-calls")
    spare = named.where("id is null").withColumn("status", F.lit("bad_call")).unionByName(
        named.where(place != F.col("first")).withColumn("status", F.lit("duplicate_call")))
    got = results.groupBy("ck", "id").agg(F.min(F.struct("turn0", "rid")).alias("first"))
    marked = results.join(got, ["ck", "id"])
    answer = marked.where(F.struct("turn0", "rid") == F.col("first")).select(
        "ck", "id", F.col("turn0").alias("answered"), "content")
    linked = lead.join(answer, ["ck", "id"], "left")
    edges = lead.select("ck", "id", F.explode("after").alias("parent"))
    known = edges.join(lead.select("ck", F.col("id").alias("parent")), ["ck", "parent"], "left_anti")
    unknown = known.groupBy("ck", "id").agg(F.array_sort(F.collect_set(
        F.concat(F.lit("unknown_dependency:"), "parent"))).alias("unknown"))    # bounded by the call's own list
    none = F.array().cast("array<string>")
    linked = linked.join(unknown, ["ck", "id"], "left").join(levels(lead, edges), ["ck", "id"], "left")
    errors = F.concat(argument_errors(tools), F.coalesce("unknown", none))
    status = (F.when(F.col("level").isNull(), "cycle").when(F.col("answered").isNull(), "no_result")
              .when(F.col("answered") <= F.col("turn0"), "result_before_call")
              .when(F.size("errors") > 0, "invalid_arguments").otherwise("ok"))
    linked = linked.withColumn("errors", errors).withColumn("status", status)
    spare = spare.withColumns({"answered": F.lit(None).cast("long"), "content": F.lit(None).cast("string"), "level": F.lit(0),
                               "due": F.col("turn0"), "errors": argument_errors(tools)})
    cols = [*keep, "i", "id", "name", "arguments", "after", "content", "level", "due", "errors", "status"]
    held = F.coalesce(_variant("arguments"), _variant(F.to_json(F.struct(F.col("arguments").alias("text")))))
    line = lambda arguments: F.to_json(F.struct(
        "after", arguments.alias("arguments"), "errors", "id", F.lit("call").alias("kind"), "level", "name",
        F.col("content").alias("result"), "status"))
    call_json = F.when(F.col("arguments").isNotNull() & held.isNull(), line(F.col("arguments"))).otherwise(line(held))
    out_calls = linked.select(*cols).unionByName(spare.select(*cols)).select(
        *keep, "i", F.lit("call").alias("kind"), F.col("id").alias("call_id"), "level", "status", "due", call_json.alias("json"))

    def other(df, status, json, call_id=None):
        return df.select(*keep, F.lit(-1).alias("i"), F.lit("message" if status == "ok" else "result").alias("kind"),
                         (F.col(call_id) if call_id else F.lit(None).cast("string")).alias("call_id"), F.lit(0).alias("level"),
                         F.lit(status).alias("status"), F.col("turn0").alias("due"), json.alias("json"))

    def stray(df, status):
        return other(df, status, F.to_json(F.struct("content", "id", F.lit("result").alias("kind"),
                                                    F.lit(status).alias("status"))), "id")

    orphans = marked.join(first.select("ck", "id"), ["ck", "id"], "left_anti")
    again = marked.join(first.select("ck", "id"), ["ck", "id"], "left_semi").where(F.struct("turn0", "rid") != F.col("first"))
    rows = reduce(DataFrame.unionByName, [
        out_calls,
        other(plain, "ok", F.to_json(F.struct("content", F.lit("message").alias("kind"), "role"))),
        stray(orphans, "orphan_result"), stray(again, "duplicate_result"),
        other(bad_result, "bad_result", F.to_json(F.struct(F.col("text").alias("content"), F.lit("result").alias("kind"),
                                                           F.lit("bad_result").alias("status"))))])
    rows = rows.withColumn("lev", F.coalesce("level", F.lit((1 << 31) - 1)))
    rows = rows.withColumn("due", F.coalesce("due", "turn0"))
    ranked = rank_within(rows, ["ck"], ["due", "lev", "turn0", "rid", "i"], "position", "lines")
    conv = F.from_json("ck", f"conv_id {kind.simpleString()}")
    return ranked.select(conv["conv_id"].alias("conv_id"), "position", "kind", "turn", "call_id", "level", "status", "json")


def as_tool_messages(conversations: DataFrame) -> DataFrame:
    """Tool messages made of plain turns: a user's turn calls a tool, the assistant's next turn is its result.

    The id is the turn's number; the call depends on the call before it and on the one about half as
    far into the conversation; every third turn calls ``rewrite``, which also wants a style.
    """
    t = F.col("turn").cast("long")
    parent = (t - 2 * F.floor((t + 3) / 4)).cast("long")
    ids = F.transform(F.array_distinct(F.array(t - 2, parent)), lambda x: F.concat(F.lit("call-"), x.cast("string")))
    after = F.when(t > 1, ids).otherwise(F.array().cast("array<string>"))
    name = F.when(t % 3 == 2, "rewrite").otherwise("lookup")
    call = F.to_json(F.struct(F.array(F.struct(
        F.concat(F.lit("call-"), t.cast("string")).alias("id"), name.alias("name"),
        F.struct(t.alias("turn"), F.col("text").alias("query"), F.when(t % 6 == 2, "plain").alias("style")).alias("arguments"),
        after.alias("after"))).alias("tool_calls")))
    result = F.to_json(F.struct(F.concat(F.lit("call-"), (t - 1).cast("string")).alias("tool_call_id"),
                                F.col("text").alias("content")))
    return conversations.select(
        "conv_id", "turn", F.when(F.col("role") == "user", "assistant").when(F.col("role") == "assistant", "tool")
        .otherwise(F.col("role")).alias("role"),
        F.when(F.col("role") == "user", call).when(F.col("role") == "assistant", result).otherwise(F.col("text")).alias("text"))


def query(spark, sf_dir: str) -> DataFrame:
    return format_tool_chats(as_tool_messages(spark.read.parquet(f"{sf_dir}/conversations.parquet")), TOOLS)
