"""Image-asset discovery inside catalogue documents (walk, score, rank).

The walk visits a JSON document of arbitrary depth in pre-order and reports
every object that carries a URL key. Arbitrary nesting cannot be expressed
by a fixed Catalyst expression without a depth bound, so the walk itself is
a small Arrow-batched pandas helper; everything after it (scoring, de-dup,
ranking) is native Spark array code on the same row, with no shuffle.
"""

from __future__ import annotations

import json
import re
from functools import reduce
from json.decoder import scanstring
from operator import or_

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, StringType, StructField, StructType

from .columns import (FILENAME_KEYS, MEDIA_ID_KEYS, URL_KEYS, col_, image_score,
                      is_image_url)

CANDIDATE_TYPE = ArrayType(StructType([
    StructField("ord", IntegerType()), StructField("url", StringType()),
    StructField("filename", StringType()), StructField("media_id", StringType()),
    StructField("first", BooleanType())]))

_SPACE = re.compile(r"[ \t\n\r]*").match
_ATOM = re.compile(r"-?(?:0|[1-9]\d*)(?:\.\d+)?(?:[eE][-+]?\d+)?|true|false|null|NaN|-?Infinity").match

# Cheap text pre-filter: a document can only hold a candidate if one of the
# URL key names occurs in it as a quoted key.
URL_KEY_RX = "(?i)\"(" + "|".join(URL_KEYS) + ")\"\\s*:"
# What every such key ends with: plain searches for these rule most documents out before the regex is tried.
URL_KEY_ENDS = [k + '"' for k in URL_KEYS if not any(k != end and k.endswith(end) for end in URL_KEYS)]


def _pick(values: dict, keys, allow_int: bool = False):
    """First usable value among ``keys`` (lower-case names): a non-blank
    string, stripped; with ``allow_int`` an integer (as text) too."""
    for name in keys:
        v = values.get(name)
        ok_type = isinstance(v, str) or (allow_int and isinstance(v, int))
        text = str(v).strip() if ok_type else ""
        if text:
            return text
    return None


def loads_any_depth(text: str):
    """``json.loads`` without its limit on nesting: open containers are kept in a list, not on the call stack."""
    whole: list = []
    path, key = [whole], None
    i, end, want = 0, len(text), "value"
    while True:
        i = _SPACE(text, i).end()
        c = text[i:i + 1]
        top = path[-1]
        if want == "key":
            if c != '"':
                raise ValueError(f"no key at {i}")
            key, i = scanstring(text, i + 1)
            i = _SPACE(text, i).end()
            if text[i:i + 1] != ":":
                raise ValueError(f"no colon at {i}")
            i, want = i + 1, "value"
        elif want == "value":
            opened = c in ("{", "[")
            if opened:
                value, i = ({} if c == "{" else []), i + 1
            elif c == '"':
                value, i = scanstring(text, i + 1)
            else:
                atom = _ATOM(text, i)
                if not atom:
                    raise ValueError(f"no value at {i}")
                value, i = json.loads(atom.group()), atom.end()
            if isinstance(top, dict):
                top[key] = value
            else:
                top.append(value)
            want = "next"
            if opened:
                path.append(value)
                i = _SPACE(text, i).end()
                if text[i:i + 1] != ("}" if c == "{" else "]"):
                    want = "key" if c == "{" else "value"
        elif len(path) == 1:
            if i != end:
                raise ValueError(f"more text at {i}")
            return whole[0]
        elif c == ",":
            i, want = i + 1, "key" if isinstance(top, dict) else "value"
        elif c == ("}" if isinstance(top, dict) else "]"):
            path.pop()
            i += 1
        else:
            raise ValueError(f"not closed at {i}")


def walk_document(text):
    """Pre-order list of (ord, url, filename, media_id, first) for one document; first: no earlier one has its url."""
    if text is None:
        return None
    try:
        try:
            doc = json.loads(text)
        except RecursionError:
            doc = loads_any_depth(text)
    except (ValueError, TypeError):
        return []
    out, seen = [], set()
    pending = [doc]
    while pending:
        node = pending.pop()
        if isinstance(node, list):
            pending.extend(node[::-1])
            continue
        if not isinstance(node, dict):
            continue
        # keys compared case-insensitively; of two spellings the later wins
        by_lower = {}
        for k, v in node.items():
            by_lower[k.lower()] = v
        url = _pick(by_lower, URL_KEYS)
        if url:
            out.append({"ord": len(out), "url": url,
                        "filename": _pick(by_lower, FILENAME_KEYS),
                        "media_id": _pick(by_lower, MEDIA_ID_KEYS, allow_int=True),
                        "first": url not in seen})
            seen.add(url)
        pending.extend(list(node.values())[::-1])
    return out


@F.pandas_udf(CANDIDATE_TYPE)
def _walk_udf(texts: pd.Series) -> pd.Series:
    # rows the JVM-side prefilter ruled out arrive as NULL and map to NULL
    return texts.map(walk_document)


def may_hold_url_key(raw_json) -> Column:
    """False only where URL_KEY_RX finds nothing: the text, in lower case, holds no end of a URL key before a quote."""
    return reduce(or_, [F.contains(F.lower(col_(raw_json)), F.lit(end)) for end in URL_KEY_ENDS])


def image_candidates(raw_json) -> Column:
    """All URL-bearing objects of the document, in document order.
    Documents without any URL key skip the Python walk entirely."""
    raw = col_(raw_json)
    worth = F.when(may_hold_url_key(raw) & raw.rlike(URL_KEY_RX), raw)
    return F.coalesce(_walk_udf(worth), F.array().cast(CANDIDATE_TYPE))


def dedup_first_url(cands) -> Column:
    """Keep the first occurrence of each URL with its own metadata."""
    return F.filter(col_(cands), lambda x: x["first"])


def scored(cands) -> Column:
    return F.transform(col_(cands), lambda x: F.struct(
        x["ord"].alias("ord"), x["url"].alias("url"), x["filename"].alias("filename"),
        x["media_id"].alias("media_id"), image_score(x["url"]).alias("score"),
        is_image_url(x["url"]).alias("is_image")))


def ranked(cands) -> Column:
    """De-duplicated candidates sorted by score desc, then document order."""
    s = scored(dedup_first_url(cands))
    return F.array_sort(s, lambda a, b: F.when(a["score"] > b["score"], -1)
                        .when(a["score"] < b["score"], 1)
                        .otherwise(a["ord"] - b["ord"]))


def top2(ranked_cands) -> dict[str, Column]:
    """Curated image columns from the ranked candidates."""
    r = col_(ranked_cands)
    first, second = F.get(r, 0), F.get(r, 1)
    return {"PrimaryImageUrl": first["url"],
            "PrimaryImageFileName": first["filename"],
            "PrimaryImageMediaItemId": first["media_id"],
            "SecondaryImageUrl": second["url"]}
