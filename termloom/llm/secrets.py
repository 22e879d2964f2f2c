"""Secret scans with multipart credential linking.

Base spans (assignments, access identifiers, long hexadecimal runs) stand on their own.
Weak parts - names of users and accounts, tokens of mixed characters, endpoints - are
common in clean text and are reported only when complementary parts lie within ``REACH``
characters of each other, from the end of one to the start of the next, in the same scope
(a paragraph): an interval join.

Texts are scanned once in Arrow batches and stay where they are. Only the parts found,
a few narrow rows, are joined, on document, scope, side and cells of ``REACH`` characters
with the neighbouring cell: the starts of later parts near a part's end, the ends of earlier
ones near its start. A cell holds at most ``REACH`` / 3 starts or ends of a kind, so no part
meets more than a fixed number of others however many a document has, and however long they are.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.llm.common import kept, mark

REACH = 200
#: Kinds in the order that spans with equal starts take; the last three are the method's.
KINDS = ["assign", "access", "hex", "login", "opaque", "endpoint"]
BASE = KINDS[:3]

# The base patterns; lengths are checked by the pattern or below.
_ASSIGN = re.compile(
    r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII,
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")

# The method's weak parts.
_LOGIN = re.compile(
    r"""(?i:user(?:name)?|login|account|client|(?:access_?)?key)[_-]?(?i:id)?["']?\x20*[:=]\x20*["']?([A-Za-z0-9@._-]{3,})""",
    re.ASCII,
)
_RUN = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}")
_ENDPOINT = re.compile(r"""(?:[A-Za-z][A-Za-z0-9+.-]{0,30}://|(?<=@))[A-Za-z0-9.-]+(?::[0-9]{1,5})?(?:/[^\s"'<>]*)?""")
_BREAK = re.compile(r"\n[\x20\x09-\x0D]*\n")


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base matches by start, then kind as listed."""
    low = text.lower()
    found = []
    if any(k in low for k in ("passw", "secret", "token", "api")):
        found += [(*m.span(), "assign") for m in _ASSIGN.finditer(text) if len(m[1]) >= 6]
    if "AKIA" in text:
        found += [(*m.span(), "access") for m in _ACCESS.finditer(text)]
    found += [(*m.span(), "hex") for m in _HEX.finditer(text)]
    return ordered(found)


def ordered(spans: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def weak_parts(text: str, base: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Parts that mean nothing alone: logins, opaque tokens and endpoints, apart from
    those that overlap a base span."""
    found = []
    if ":" in text or "=" in text:
        found += [(*m.span(), "login") for m in _LOGIN.finditer(text)]
    if "://" in text or "@" in text:
        found += [(*m.span(), "endpoint") for m in _ENDPOINT.finditer(text)]
    for m in _RUN.finditer(text):
        run = m[0]
        mixed = any(c.isdigit() for c in run) and any(c.isalpha() for c in run)
        if mixed and len(set(run)) >= 10:
            found.append((*m.span(), "opaque"))
    if not found or not base:
        return found
    starts = [s[0] for s in base]
    reach = list(accumulate((s[1] for s in base), max))
    return [s for s in found if not (k := bisect_left(starts, s[1])) or reach[k - 1] <= s[0]]


def written(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


SCHEMA = """doc_id long, mark long, n_assign long, n_access long, n_hex long, base_sha256 string,
base array<struct<start:long,end:long,kind:string>>,
parts array<struct<start:long,end:long,kind:string,scope:long>>"""


def scanned(docs: DataFrame) -> DataFrame:
    """Base spans and all parts (base spans among them, with their scope) of every row."""
    span = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())])
    part = pa.struct([*span, pa.field("scope", pa.int64())])
    types = [pa.int64()] * 5 + [pa.string(), pa.list_(span), pa.list_(part)]
    names = ["doc_id", "mark", "n_assign", "n_access", "n_hex", "base_sha256", "base", "parts"]

    def row(text: str) -> tuple:
        base = base_spans(text)
        parts = base + weak_parts(text, base)
        breaks = [m.start() for m in _BREAK.finditer(text)] if len(parts) > 1 else []
        counts = [sum(s[2] == kind for s in base) for kind in BASE]
        digest = hashlib.sha256(written(base).encode()).hexdigest()
        scoped = [(*s, bisect_right(breaks, s[0])) for s in parts] if len(parts) > 1 else []
        return (
            *counts, digest,
            [dict(zip(("start", "end", "kind"), s, strict=True)) for s in base],
            [dict(zip(("start", "end", "kind", "scope"), s, strict=True)) for s in scoped],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [row(t) for t in batch["text"].fill_null("").to_pylist()]
            columns = list(zip(*rows, strict=True)) or [[]] * (len(names) - 2)
            columns = [batch["doc_id"], batch["mark"], *columns]
            made = [c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays(made, names)

    text = F.col("text").cast("string")
    slim = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), mark(text).alias("mark"), text.alias("text")
    )
    return kept(slim.mapInArrow(run, SCHEMA), "scanned")


def linked(found: DataFrame) -> DataFrame:
    """``doc_id, mark, extra``: weak parts that complementary parts stand by.

    Roles: logins and access identifiers name someone; assignments, hexadecimal runs and
    opaque tokens are secrets; endpoints are places. A login needs a secret, an opaque token
    a login or a place, an endpoint a secret and a login.
    """
    role = (
        F.when(F.col("p.kind").isin("login", "access"), "who")
        .when(F.col("p.kind") == "endpoint", "where")
        .otherwise("what")
    )
    parts = found.where(F.size("parts") > 1).select("doc_id", "mark", F.explode("parts").alias("p"))
    parts = parts.select(
        "doc_id", "mark", "p.scope", "p.start", "p.end", "p.kind", role.alias("role")
    ).distinct()

    def cell(place: Column) -> Column:
        return F.floor(place / REACH)

    def at(side: str, place: str, cell: Column) -> Column:
        return F.struct(F.lit(side).alias("side"), F.col(place).alias("place"), cell.alias("cell"))

    # A later part starts in the cell of this part's end or the next one, an earlier part
    # ends in the cell of its start or the one before.
    first, last = cell(F.col("start")), cell(F.col("end"))
    sought = [at("after", "end", last), at("after", "end", last + 1),
              at("before", "start", first), at("before", "start", first - 1)]
    weak = parts.where(F.col("kind").isin(*KINDS[3:])).select("*", F.inline(F.array(*sought)))
    held = [at("after", "start", first), at("before", "end", last)]
    other = parts.select("*", F.inline(F.array(*held)))
    other = other.select(*[
        F.col(c).alias(f"o_{c}") for c in ("doc_id", "mark", "scope", "side", "place", "cell", "role")
    ])
    ahead = F.col("o_place") - F.col("place")
    gap = F.when(F.col("side") == "after", ahead).otherwise(-ahead)
    near = (
        weak["doc_id"].eqNullSafe(other["o_doc_id"])
        & (weak["mark"] == other["o_mark"])
        & (weak["scope"] == other["o_scope"])
        & (weak["side"] == other["o_side"])
        & (weak["cell"] == other["o_cell"])
        & gap.between(0, REACH)
        & (weak["role"] != other["o_role"])
    )
    keys = ["doc_id", "mark", "start", "end", "kind"]
    met = weak.join(other, near).groupBy(*[weak[k] for k in keys]).agg(
        *[F.max(F.col("o_role") == x).alias(x) for x in ("who", "what", "where")]
    )
    enough = (
        ((F.col("kind") == "login") & F.col("what"))
        | ((F.col("kind") == "opaque") & (F.col("who") | F.col("where")))
        | ((F.col("kind") == "endpoint") & F.col("what") & F.col("who"))
    )
    span = F.struct("start", "end", "kind")
    return met.where(enough).groupBy("doc_id", "mark").agg(F.collect_set(span).alias("extra"))


def secrets(docs: DataFrame) -> DataFrame:
    """``doc_id``, base counts and digest, ``spans`` and ``n_linked`` for every row of ``docs``.

    Null and empty texts have no spans. Rows that share an id are scanned each on its own.
    """
    found = scanned(docs)
    extra = linked(found).select(
        F.col("doc_id").alias("_id"), F.col("mark").alias("_mark"), "extra"
    )
    same = found["doc_id"].eqNullSafe(extra["_id"]) & (found["mark"] == extra["_mark"])
    joined = found.join(extra, same, "left")
    none = F.array().cast("array<struct<start:long,end:long,kind:string>>")
    order = F.array(*[F.lit(k) for k in KINDS])
    every = F.concat("base", F.coalesce("extra", none))
    keyed = F.transform(
        every,
        lambda s: F.struct(s["start"], F.array_position(order, s["kind"]).alias("rank"), s["end"], s["kind"]),
    )
    texts = F.transform(
        F.sort_array(keyed), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
    )
    return joined.select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256",
        F.array_join(texts, ",").alias("spans"),
        F.size(F.coalesce("extra", none)).cast("long").alias("n_linked"),
    )
