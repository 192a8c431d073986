"""Conversation structure repair: the lightest derivation of a legal conversation from a damaged one.

A conversation is legal if its role initials read ``(s?(ua)+)?``. Rows may be kept (0), get the role user or
assistant (2) or be deleted (3); an empty user or assistant turn may be inserted anywhere (2); a truncated row that stays
adds 1; blank and duplicate rows must go. An item [rows read, state of the grammar] is derived from another by one edit;
its weight (cost, audit) holds the edits' initials. Appending an edit is a superior function of that weight, and
monotone: two audits of one item and cost never are prefixes of each other, since more inserts cost more. So Knuth's
agenda pops every item first with its lightest weight, and the goal item finalises with the answer.

A conversation may hold any share of all rows: rows are dealt by ranges of (conversation, turn), and the agenda runs over
segments of SEGMENT rows. A segment that holds only part of a conversation derives the lightest weight from each state
before it to each state after it; these weights are the edges of the same deduction over the conversation's segments.
One value of the result, its audit, is as long as the conversation; only the digest of the repaired turns, a hash over
their concatenation, passes the rows of one conversation through one task, as a stream.

Defined results: null role or text stands for one space; null turns come first and count for no gap; rows of one turn
go by the first code points of role and text, then by role and text; a null conversation id is a conversation of its own;
an empty table has none. Only the four columns are read, so that no other can clash.
"""

from __future__ import annotations

import hashlib
import heapq
import os

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from shelfspark.llm.common import cut, table

#: Rows over which one agenda runs.
SEGMENT = 512
#: Code points of role and text that take part in dealing rows to ranges (the range sample holds them).
ROLE_HEAD, TEXT_HEAD = 32, 64
WHITE = " \t\n\x0b\x0c\r"
#: The grammar: states are nothing read, system, user, assistant; legal ends are the first and the last.
NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
STATES, ENDS, LEGAL_PAIRS = (0, 1, 2, 3), (0, 3), {"su", "ua", "au"}
NAMES = {"u": "user", "a": "assistant"}
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: Faults of a row.
FINE, BLANK, DUPLICATE, CUT_OFF = 0, 1, 2, 3
LONG = (1 << 63) - 1

_LONGS = ("first", "first_turn", "last_turn", "n_turns", "blank", "duplicate", "truncated", "illegal")
_WAY = pa.struct([("enter", pa.int32()), ("leave", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])
PIECES = pa.schema([("conv_id", pa.int64()), ("whole", pa.bool_()), *[(c, pa.int64()) for c in _LONGS], ("head", pa.string()), ("tail", pa.string()),
                    ("ways", pa.list_(_WAY))])
REPAIRS = pa.schema([(c, pa.int64()) for c in ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
                    + [("audit", pa.string())])
TURNS = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())])
DIGESTS = pa.schema([("conv_id", pa.int64()), ("repaired_sha256", pa.string())])


def derive(rows: list[tuple[str, int]], enter: int, goal: bool) -> dict[int, tuple[int, str]]:
    """Lightest (cost, audit) of reading all ``rows`` (role initial, fault) from state ``enter``, by the state after them.

    With ``goal`` the agenda stops as the first legal end finalises, which is the only one returned.
    """
    agenda, done, out = [(0, "", 0, enter)], set(), {}
    while agenda:
        cost, audit, i, state = heapq.heappop(agenda)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(rows):
            out[state] = cost, audit
            if goal and state in ENDS:
                return {state: out[state]}
        offered = [NEXT[state, x] for x in NAMES if (state, x) in NEXT]
        for q in offered:
            heapq.heappush(agenda, (cost + INSERT, audit + "I", i, q))
        if i < len(rows):
            initial, fault = rows[i]
            heapq.heappush(agenda, (cost + DELETE, audit + "D", i + 1, state))
            if fault in (BLANK, DUPLICATE):
                continue
            stays = cost + (TRUNCATED if fault == CUT_OFF else 0)
            if (state, initial) in NEXT:
                heapq.heappush(agenda, (stays, audit + "K", i + 1, NEXT[state, initial]))
            for q in offered:
                heapq.heappush(agenda, (stays + REROLE, audit + "R", i + 1, q))
    return out


def chain(pieces: list[list[dict]]) -> tuple[int, str]:
    """Lightest (cost, audit) of a conversation from the ways through its pieces."""
    known, common = {0: (0, "")}, []
    for ways in pieces:
        found: dict[int, tuple[int, str]] = {}
        for w in ways:
            if w["enter"] in known:
                cost, audit = known[w["enter"]]
                weight = cost + w["cost"], audit + w["audit"]
                if w["leave"] not in found or weight < found[w["leave"]]:
                    found[w["leave"]] = weight
        shared = os.path.commonprefix([a for _, a in found.values()])   # so that the compared ends stay short
        common.append(shared)
        known = {q: (c, a[len(shared):]) for q, (c, a) in found.items()}
    cost, audit = min(known[q] for q in ENDS if q in known)
    return cost, "".join(common) + audit


def _segment(rows: pa.Table) -> pa.Table:
    """The pieces of conversations in one segment."""
    got = sorted(rows.to_pylist(), key=lambda r: r["_at"])
    bounds = [k for k in range(len(got)) if not k or got[k]["conv_id"] != got[k - 1]["conv_id"]] + [len(got)]
    out = []
    for a, b in zip(bounds, bounds[1:], strict=False):
        part = got[a:b]
        whole = a > 0 and b < len(got)          # neither the segment before nor the one after can hold more of it
        steps = [(r["initial"], r["fault"]) for r in part]
        ways = [{"enter": p, "leave": q, "cost": c, "audit": s} for p in ((0,) if a else STATES)
                for q, (c, s) in derive(steps, p, whole).items()]
        turns = [r["turn"] for r in part if r["turn"] is not None]
        faults = [r["fault"] for r in part]
        out.append({
            "conv_id": part[0]["conv_id"], "whole": whole, "first": part[0]["_at"], "n_turns": len(set(turns)), "ways": ways,
            "first_turn": turns[0] if turns else None, "last_turn": turns[-1] if turns else None,
            "blank": faults.count(BLANK), "duplicate": faults.count(DUPLICATE), "truncated": faults.count(CUT_OFF),
            "illegal": sum(x[0] + y[0] not in LEGAL_PAIRS for x, y in zip(steps, steps[1:], strict=False)),
            "head": steps[0][0], "tail": steps[-1][0]})
    return pa.Table.from_pylist(out, schema=PIECES)


def _conversation(rows: pa.Table) -> pa.Table:
    """The pieces of one conversation joined."""
    parts = sorted(rows.to_pylist(), key=lambda r: r["first"])
    total = {k: sum(p[k] for p in parts) for k in ("blank", "duplicate", "truncated", "illegal")}
    total["illegal"] += sum(x["tail"] + y["head"] not in LEGAL_PAIRS for x, y in zip(parts, parts[1:], strict=False))
    dated = [p for p in parts if p["n_turns"]]
    gaps = 0
    if dated:
        shared = sum(x["last_turn"] == y["first_turn"] for x, y in zip(dated, dated[1:], strict=False))
        gaps = dated[-1]["last_turn"] - dated[0]["first_turn"] + 1 - sum(p["n_turns"] for p in dated) + shared
    cost, audit = chain([p["ways"] for p in parts])
    return pa.Table.from_pylist([{"conv_id": parts[0]["conv_id"], "gaps": min(gaps, LONG), "cost": cost, "audit": audit,
                                  **total}], schema=REPAIRS)


def in_order(turns: DataFrame) -> DataFrame:
    """The rows dealt by ranges, sorted and written; ``_at`` numbers them, without a gap inside a range."""
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    keys = [F.col("conv_id"), F.col("turn"), F.substring("role", 1, ROLE_HEAD), F.substring("text", 1, TEXT_HEAD)]
    n = max(1, int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    placed = rows.repartitionByRange(n, *keys).sortWithinPartitions(*keys, "role", "text")
    return cut(placed.withColumn("_at", F.monotonically_increasing_id()), "repair_rows")


def faults(rows: DataFrame) -> DataFrame:
    """conv_id, turn, _at, initial, fault: what the agenda needs of every row, without its text."""
    same = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    firsts = rows.groupBy("conv_id", same.alias("same")).agg(F.min("_at").alias("_at")).select("_at", F.lit(True).alias("new"))
    last = F.right(F.rtrim("text", F.lit(WHITE)), F.lit(1))
    facts = rows.select("conv_id", "turn", "_at", F.substring("role", 1, 1).alias("initial"),
                        (last == "").alias("blank"), (~last.isin(".", "!", "?")).alias("truncated"))
    fault = (F.when(F.col("blank"), BLANK).when(F.col("new").isNull(), DUPLICATE).when(F.col("truncated"), CUT_OFF)
             .otherwise(FINE))
    return facts.join(firsts, "_at", "left").select("conv_id", "turn", "_at", "initial", fault.alias("fault"))


def repairs(rows: DataFrame) -> DataFrame:
    """One row of counts, cost and audit for each conversation of ``rows`` (``in_order``)."""
    inside = F.col("_at").bitwiseAND((1 << 33) - 1)
    segment = F.shiftright("_at", 33).alias("part"), F.floor(inside / SEGMENT).alias("segment")
    pieces = cut(faults(rows).groupBy(*segment).applyInArrow(_segment, from_arrow_schema(PIECES)), "repair_pieces")
    exact = [F.col(c).cast("decimal(20,0)") for c in ("last_turn", "first_turn", "n_turns")]
    gaps = F.least(exact[0] - exact[1] + 1 - exact[2], F.lit(LONG).cast("decimal(20,0)")).cast("long")
    way = F.col("ways")[0]
    one = pieces.where("whole").select(
        "conv_id", F.coalesce(gaps, F.lit(0)).alias("gaps"), "blank", "duplicate", "truncated", "illegal",
        way["cost"].alias("cost"), way["audit"].alias("audit"))
    several = pieces.where("not whole").groupBy("conv_id").applyInArrow(_conversation, from_arrow_schema(REPAIRS))
    return one.unionByName(several)


def _replay(batches):
    """(conv_id, role, text) of every repaired turn; (conv_id, None, None) as a conversation begins.

    The audit of a conversation comes before its rows, with a negative place.
    """
    conv, audit, k, last = None, "", 0, ""

    def inserted():
        nonlocal k, last
        while k < len(audit) and audit[k] == "I":
            last, k = ("a" if last == "u" else "u"), k + 1
            yield conv, NAMES[last], ""

    for b in batches:
        for c, at, role, text in zip(*(b.column(j).to_pylist() for j in range(4)), strict=True):
            if at < 0:
                yield from inserted()
                conv, audit, k, last = c, text, 0, ""
                yield conv, None, None
                continue
            yield from inserted()
            edit, k = audit[k], k + 1
            if edit == "D":
                continue
            if edit == "R":
                role = NAMES["a" if last == "u" else "u"]
            last = role[:1]
            yield conv, role, text
    yield from inserted()


def _told(rows: DataFrame, done: DataFrame) -> DataFrame:
    """Audits and rows of each conversation, one after another in one partition."""
    audits = done.select("conv_id", F.lit(-1).cast("long").alias("_at"), F.lit("").alias("role"), F.col("audit").alias("text"))
    return (audits.unionByName(rows.select("conv_id", "_at", "role", "text")).repartition("conv_id")
            .sortWithinPartitions("conv_id", "_at"))


def repaired_turns(rows: DataFrame, done: DataFrame) -> DataFrame:
    """conv_id, turn (from 0), role, text of the repaired conversations."""
    def batch(out):
        return pa.RecordBatch.from_pylist([dict(zip(TURNS.names, x, strict=True)) for x in out], schema=TURNS)

    def run(batches):
        out, size, turn = [], 0, 0
        for conv, role, text in _replay(batches):
            if role is None:
                turn = 0
                continue
            out.append((conv, turn, role, text))
            size, turn = size + len(text) + 64, turn + 1
            if size > 1 << 20:
                yield batch(out)
                out, size = [], 0
        yield batch(out)
    return _told(rows, done).mapInArrow(run, from_arrow_schema(TURNS))


def digests(rows: DataFrame, done: DataFrame) -> DataFrame:
    """conv_id, repaired_sha256 over the lines ``role:text``."""
    def run(batches):
        ids, hexes, h, fresh = [], [], None, True
        for conv, role, text in _replay(batches):
            if role is None:
                if h is not None:
                    hexes.append(h.hexdigest())
                ids.append(conv)
                h, fresh = hashlib.sha256(), True
                continue
            h.update(f"{'' if fresh else chr(10)}{role}:{text}".encode())
            fresh = False
        if h is not None:
            hexes.append(h.hexdigest())
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(hexes, pa.string())], schema=DIGESTS)
    return _told(rows, done).mapInArrow(run, from_arrow_schema(DIGESTS))


def damaged(conversations: DataFrame) -> DataFrame:
    """The fixed damage that the query repairs, by the crc32 of ``conv_id:turn`` modulo 20."""
    def text_of(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))
    h = F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn"))) % 20
    text = F.when(h == 1, "").when(h == 2, F.regexp_replace(text_of("text"), "[.!?]", "")).otherwise(text_of("text"))
    copies = F.explode(F.when(h == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return conversations.where(h != 0).select("conv_id", "turn", F.when(h == 4, "user").otherwise(text_of("role")).alias("role"),
                                              text.alias("text"), copies.alias("copy")).drop("copy")


def query(spark, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    rows = in_order(damaged(conversations))
    done = cut(repairs(rows), "repair_audits")
    all_ids = conversations.select(F.col("conv_id").cast("long").alias("c")).distinct()
    found = done.join(digests(rows, done).withColumnRenamed("conv_id", "d"), F.col("conv_id").eqNullSafe(F.col("d")))
    zero = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return all_ids.join(found, F.col("c").eqNullSafe(F.col("conv_id")), "left").select(
        F.col("c").alias("conv_id"), *[F.coalesce(x, F.lit(0).cast("long")).alias(x) for x in zero],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
