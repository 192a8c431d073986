"""Line deduplication with a fixed-depth tree of log templates, in DataFrame operations only.

A line is split into white-space tokens and a token that holds a digit becomes ``<*>``; lines of fewer than
``MIN_TOKENS`` tokens take part as they are, as a token masked in them would leave less than ``SAME``. The tree
has a fixed depth: the first level is the number of tokens, the next ``LEAD`` levels are the
leading tokens. In a leaf, a line's variable fields are told by the relative counts of its own tokens (``_relative``), at
every size of the corpus, and become ``<*>`` too, provided that at least ``SAME`` of the line's tokens stay.
What results is the line's template. Line forms and templates that occur in ``MIN_DOCS`` documents recur: all their
lines are dropped but the first in the corpus (smallest doc_id, then line number), so that no text is lost
altogether. Equal lines of over ``LONG_WORDS`` words or ``LONG_BYTES`` bytes go from the second document on.

Only hashes of lines are grouped; a leaf, template or line that many documents share is combined
before the shuffle, and nothing is gathered but line numbers of one document and the token counts of one line.

Defined results: null text stays null and has no lines; blank lines stay; a text whose lines all go becomes the
empty text; rows with one doc_id count as one document, rows without a doc_id as one for each text; repeated rows
are treated alike; an empty table gives no rows; extra columns are carried through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.llm.common import cut, free_name

MIN_DOCS, LEAD, SAME, MIN_TOKENS = 3, 3, 0.7, 3
#: A constant stands in at least so many times the documents of any variable field of its line.
GAP = 2
#: Equal lines of more words, or more bytes in UTF-8, go from their second document on.
LONG_WORDS, LONG_BYTES = 50, 300


def _even(text):
    """White space evened out in a whole text, before it is cut into lines: what follows tests plain column values."""
    odd = F.contains(text, F.lit("  "))
    for c in "\t\x0b\x0c\r":
        odd = odd | F.contains(text, F.lit(c))
    return F.when(odd, F.regexp_replace(text, "[\\x20\\x09\\x0B-\\x0D]+", " ")).otherwise(text)


def _masked(flat, n):
    """The line with its digit tokens masked."""
    return F.when((n >= MIN_TOKENS) & flat.rlike("[0-9]"),
                  F.regexp_replace(flat, "(?<![^ ])[^ 0-9]*+[0-9][^ ]*+", "<*>")).otherwise(flat)


def _lines(docs: DataFrame) -> DataFrame:
    """(doc_id, th, pos, masked, n, exact): the masked form of each line that is not blank, its tokens'
    number and, of a long line, the hash of it as it is."""
    raw = docs.where("text is not null").select("doc_id", F.xxhash64("text").alias("th"), _even(F.col("text")).alias("even"))
    flat = (raw.select("doc_id", "th", F.posexplode(F.split("even", "\n")).alias("pos", "line"))
            .select("doc_id", "th", "pos", F.trim("line").alias("flat")))
    n = F.length("flat") - F.length(F.replace("flat", F.lit(" "), F.lit(""))) + 1
    exact = F.when((n > LONG_WORDS) | (F.octet_length("flat") > LONG_BYTES), F.xxhash64("flat"))
    return (flat.where(F.col("flat") != "")
            .select("doc_id", "th", "pos", _masked(F.col("flat"), n).alias("masked"), n.alias("n"), exact.alias("exact")))


def _shown(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """``keys`` (leaf, form, docs, all, n, doc_id, th, pos) with the masked line there, ``masked``.

    The texts go once to the documents that show a form; only the lines asked for are cut out and masked.
    """
    want = keys.groupBy("doc_id", "th").agg(F.collect_list(F.struct("pos", "leaf", "form", "docs", "all", "n")).alias("want"))
    t = docs.where("text is not null").select("doc_id", F.xxhash64("text").alias("th"), "text").alias("t")
    on = F.col("t.doc_id").eqNullSafe(F.col("w.doc_id")) & (F.col("t.th") == F.col("w.th"))
    # one plan at every size: the texts are shuffled, never met by a broadcast side that grows
    per = t.join(want.alias("w").hint("merge"), on).select(F.split(_even(F.col("t.text")), "\n").alias("lines"), "w.want")
    cut_out = F.explode(F.transform("want", lambda w: F.struct(w.alias("w"), F.trim(F.get(F.col("lines"), w["pos"])).alias("flat"))))
    got = per.select(cut_out.alias("x")).select("x.w.*", "x.flat")
    return got.select("leaf", "form", "docs", "all", "n", _masked(F.col("flat"), F.col("n")).alias("masked"))


def _keyed(lines: DataFrame, lead: int) -> DataFrame:
    """Adds the leaf of the tree and the hash of the line form."""
    return lines.select("*", F.xxhash64("n", F.substring_index("masked", " ", lead)).alias("leaf"),
                        F.xxhash64("masked").alias("form"))


def _relative(tokens: DataFrame, min_docs: int, same: float) -> DataFrame:
    """(leaf, form, wild, sig) of the line forms with variable fields, told by the counts of a line's own tokens.

    A line's tokens are put in order of the documents ``d`` that have them at their place in the
    leaf (null: too few to recur). The rarest are variable fields, up to the last step at which the next token has
    ``GAP`` times as many documents, or the first that can recur, provided that ``same`` of the
    tokens stay. Constants are shared by all lines of a template, so all find the same step at
    every size of the corpus. What is gathered is one line's tokens.
    """
    ds = F.array_sort(F.collect_list(F.struct(F.coalesce("d", F.lit(1)).alias("d"), F.xxhash64("p", "tok").alias("h"))))
    lines = tokens.groupBy("leaf", "form").agg(F.max("n").alias("n"), F.max("all").alias("all"), ds.alias("ds"))
    wild = F.expr(f"""aggregate(sequence(1, size(ds)), 0, (found, i) -> CASE
        WHEN n - i < {same} * n THEN found
        WHEN coalesce(get(ds, i).d, all) >= {GAP} * get(ds, i - 1).d AND coalesce(get(ds, i).d, all) >= {min_docs} THEN i
        WHEN get(ds, i - 1).d < {min_docs} AND coalesce(get(ds, i).d, all) >= {min_docs} THEN i
        ELSE found END)""")
    return lines.withColumn("wild", wild).where("wild > 0").select(
        "leaf", "form", F.col("wild").cast("long").alias("wild"), F.expr("xxhash64(slice(ds, wild + 1, size(ds)))").alias("sig"))


def dropped_lines(docs: DataFrame, min_docs: int = MIN_DOCS, lead: int = LEAD, same: float = SAME) -> DataFrame:
    """(doc_id, th, pos) of the lines that go (some twice); th: the hash of the document's text."""
    rows = _keyed(_lines(docs), lead)
    at = cut(rows.select("doc_id", "th", "pos", "leaf", "form", "n", "exact"), "lines")
    dk = F.when(F.col("doc_id").isNull(), F.col("th")).otherwise(F.xxhash64("doc_id"))
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th", "pos")
    by_doc = at.groupBy("leaf", "form", dk.alias("dk")).agg(F.min(place).alias("first"), F.max("n").alias("n"))
    forms = cut(by_doc.groupBy("leaf", "form").agg(F.count("*").alias("docs"), F.min("first").alias("first"), F.max("n").alias("n")),
                "line-forms")
    settled = forms.where(F.col("docs") >= min_docs)

    # leaves whose forms may share a template: generalise their variable fields
    leaves = forms.groupBy("leaf").agg(F.sum("docs").alias("all"), F.count("*").alias("k"))
    leaves = leaves.where((F.col("all") >= min_docs) & (F.col("k") > 1)).drop("k")
    # a line of so few tokens beyond the leading ones keeps less than its share as soon as one is variable
    open_forms = cut(forms.where((F.col("n") > lead) & (F.col("n") - 1 >= same * F.col("n"))).join(leaves, "leaf"), "open-forms")
    shown = _shown(docs, open_forms.select("leaf", "form", "docs", "all", "n", "first.doc_id", "first.th", "first.pos"))
    tokens = (shown.select("leaf", "form", "docs", "all", "n", F.posexplode(F.split("masked", " ")).alias("p", "token"))
              .where(F.col("p") >= lead).select("leaf", "form", "docs", "all", "n", "p", F.xxhash64("token").alias("tok"))
              .dropDuplicates(["leaf", "form", "p"]))
    tokens = cut(tokens, "line-tokens")
    constant = tokens.groupBy("leaf", "p", "tok").agg(F.sum("docs").alias("d")).where(F.col("d") >= min_docs)
    shape = _relative(tokens.join(constant, ["leaf", "p", "tok"], "left"), min_docs, same)
    member = cut(open_forms.select("leaf", "form").join(shape, ["leaf", "form"]), "line-templates")
    template = ["leaf", "wild", "sig"]
    by_tdoc = at.join(member, ["leaf", "form"]).groupBy(*template, dk.alias("dk")).agg(F.min(place).alias("first"))
    recur = by_tdoc.groupBy(*template).agg(F.count("*").alias("docs"), F.min("first").alias("first"))
    general = member.join(recur.where(F.col("docs") >= min_docs), template).select("leaf", "form", "first")

    gone = at.join(settled.select("leaf", "form", "first").union(general), ["leaf", "form"])
    gone = gone.where(~place.eqNullSafe(F.col("first"))).select("doc_id", "th", "pos")
    # a long line needs no third document; its first one is also the first of its form or template, or goes with it
    long = at.where("exact is not null")
    twice = (long.groupBy("exact", dk.alias("dk")).agg(F.min(place).alias("first"))
             .groupBy("exact").agg(F.count("*").alias("docs"), F.min("first").alias("first")).where("docs > 1"))
    return gone.union(long.join(twice, "exact").where(~place.eqNullSafe(F.col("first"))).select("doc_id", "th", "pos"))


COUNTS = ("n_lines", "n_dropped")


def dedup_lines(docs: DataFrame, counts: bool = True, **how) -> DataFrame:
    """``docs`` with the dropped lines taken out of ``text``; with ``counts`` also n_lines and n_dropped, in place
    of input columns of these names."""
    gone = dropped_lines(docs, **how).groupBy("doc_id", "th").agg(F.collect_set("pos").alias("gone")).alias("g")
    kept = [c for c in docs.columns if not counts or c.lower() not in COUNTS]
    own = free_name(docs, "_th")
    d = docs.withColumn(own, F.xxhash64("text")).alias("d")
    both = d.join(gone.hint("merge"), F.col("d.doc_id").eqNullSafe(F.col("g.doc_id")) & (F.col(f"d.{own}") == F.col("g.th")), "left")
    lines = F.split("d.text", "\n")
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("g.gone"))
    text = F.when(F.col("g.gone").isNull(), F.col("d.text")).otherwise(
        F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n"))
    n_lines = F.when(F.col("d.text").isNull(), 0).otherwise(F.size(lines))
    n_dropped = F.when(F.col("g.gone").isNull(), 0).otherwise(F.size("g.gone"))
    return both.select(*[text.alias("text") if c == "text" else F.col(f"d.`{c}`") for c in kept],
                       *([n_lines.alias("n_lines"), n_dropped.alias("n_dropped")] if counts else []))


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return dedup_lines(docs)


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: all documents, less their recurring lines; n_chars follows the text."""
    out = dedup_lines(docs, counts=False)
    return out.select(*[F.length("text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(f"`{c}`")
                        for c in docs.columns])


#: The rows of dedup_lines with the fixed parameters above, over a relation ``docs`` (doc_id, text).
SQL_BODY = f"""
, ll AS (
  SELECT doc_id, text, coalesce(CAST(doc_id AS VARCHAR), 'text:' || text) AS dk,
         unnest(range(len(string_split(text, chr(10))))) AS pos, unnest(string_split(text, chr(10))) AS line
  FROM docs WHERE text IS NOT NULL),
nn AS (SELECT *, trim(regexp_replace(line, '[\\x20\\x09-\\x0D]+', ' ', 'g')) AS flat FROM ll),
mm AS (SELECT doc_id, text, dk, pos, flat, string_split(CASE WHEN len(string_split(flat, ' ')) < {MIN_TOKENS} THEN flat
              ELSE regexp_replace(flat, '[^ ]*[0-9][^ ]*', '<*>', 'g') END, ' ') AS toks
       FROM nn WHERE flat <> ''),
tt AS (SELECT *, len(toks) AS n, array_to_string(toks[1:{LEAD}], ' ') AS lead, array_to_string(toks, ' ') AS form FROM mm),
forms AS (SELECT n, lead, form, any_value(toks) AS toks, count(DISTINCT dk) AS docs FROM tt GROUP BY n, lead, form),
leaves AS (SELECT n, lead, sum(docs) AS total FROM forms GROUP BY n, lead HAVING sum(docs) >= {MIN_DOCS} AND count(*) > 1),
tok AS (SELECT f.n, f.lead, f.form, f.docs, l.total, unnest(range(len(toks))) AS p, unnest(toks) AS t
        FROM forms f JOIN leaves l ON f.n = l.n AND f.lead = l.lead),
con AS (SELECT n, lead, p, t, sum(docs) AS d FROM tok WHERE p >= {LEAD} GROUP BY n, lead, p, t HAVING sum(docs) >= {MIN_DOCS}),
counted AS (
  SELECT k.n, k.lead, k.form, k.total, k.p, k.t, coalesce(c.d, 1) AS d
  FROM tok k LEFT JOIN con c ON k.n = c.n AND k.lead = c.lead AND k.p = c.p AND k.t = c.t WHERE k.p >= {LEAD}),
sorted AS (
  SELECT n, lead, form, any_value(total) AS total, list(d ORDER BY d) AS ds FROM counted GROUP BY n, lead, form),
fields AS (
  SELECT *, list_max(list_filter(range(1, len(ds) + 1), lambda i: n - i >= {SAME} * n AND (
      (CASE WHEN i < len(ds) THEN ds[i + 1] ELSE total END >= {GAP} * ds[i]
       AND CASE WHEN i < len(ds) THEN ds[i + 1] ELSE total END >= {MIN_DOCS})
      OR (ds[i] < {MIN_DOCS} AND CASE WHEN i < len(ds) THEN ds[i + 1] ELSE total END >= {MIN_DOCS})))) AS wild
  FROM sorted),
shape AS (
  SELECT c.n, c.lead, c.form, string_agg(CASE WHEN f.wild = len(f.ds) OR c.d < f.ds[f.wild + 1] THEN chr(0) ELSE c.t END, ' ' ORDER BY c.p) AS template
  FROM counted c JOIN fields f ON c.n = f.n AND c.lead = f.lead AND c.form = f.form WHERE f.wild > 0
  GROUP BY c.n, c.lead, c.form),
named AS (
  SELECT n, lead, form, 'f ' || form AS template FROM forms WHERE docs >= {MIN_DOCS}
  UNION ALL
  SELECT n, lead, form, 't ' || n || ' ' || lead || chr(1) || template FROM shape),
occ AS (SELECT x.doc_id, x.text, x.dk, x.pos, y.template FROM tt x JOIN named y
        ON x.n = y.n AND x.lead = y.lead AND x.form = y.form
        UNION ALL
        SELECT doc_id, text, dk, pos, 'l ' || flat FROM tt WHERE n > {LONG_WORDS} OR strlen(flat) > {LONG_BYTES}),
recur AS (SELECT template, min({{'a': doc_id IS NULL, 'b': doc_id, 'c': text, 'd': pos}}) AS first FROM occ
          GROUP BY template HAVING count(DISTINCT dk) >= CASE WHEN template LIKE 'l %' THEN 2 ELSE {MIN_DOCS} END),
gone AS (SELECT DISTINCT o.doc_id, o.text, o.pos FROM occ o JOIN recur r ON o.template = r.template
         WHERE {{'a': o.doc_id IS NULL, 'b': o.doc_id, 'c': o.text, 'd': o.pos}} IS DISTINCT FROM r.first),
gg AS (SELECT doc_id, text, list(pos) AS gone FROM gone GROUP BY doc_id, text),
deduped AS (
  SELECT d.doc_id, CASE WHEN g.gone IS NULL THEN d.text ELSE array_to_string(
           list_filter(string_split(d.text, chr(10)), lambda s, i: NOT list_contains(g.gone, i - 1)), chr(10)) END AS text,
         CASE WHEN d.text IS NULL THEN 0 ELSE len(string_split(d.text, chr(10))) END AS n_lines,
         coalesce(len(g.gone), 0) AS n_dropped
  FROM docs d LEFT JOIN gg g ON d.doc_id IS NOT DISTINCT FROM g.doc_id AND d.text = g.text)
"""
SQL = "WITH docs AS (SELECT doc_id, text FROM documents)" + SQL_BODY + """
SELECT doc_id, text, CAST(n_lines AS INTEGER) AS n_lines, CAST(n_dropped AS INTEGER) AS n_dropped FROM deduped"""
