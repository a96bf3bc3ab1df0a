"""Secret scan: plain patterns, and weak credential parts that count only together."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graticule.llm.common import table
from graticule.session import materialize

# The base patterns. Matches are leftmost and do not overlap within a kind.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
BASE_KINDS = ("assign", "access", "hex")
# Weak parts: too common to report alone.
WEAK = {
    "identifier": re.compile(r"(?<![A-Za-z0-9_])(?:A[BGIKNPRS][A-Z]A[A-Z0-9]{8,}|(?:client|access|account|user|key)[_-]?id[\"']?\x20{0,4}[:=]\x20{0,4}[\"']?[A-Za-z0-9._@-]{4,})", re.ASCII),
    "secret": re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}", re.ASCII),
    "endpoint": re.compile(r"(?:https?|postgres|postgresql|mysql|mongodb|redis|amqp|s3)://[^\s\"'<>]{4,}", re.ASCII),
}
DIGIT, SMALL = re.compile("[0-9]"), re.compile("[a-z]")  # a secret has both
# What must stand in the same scope for a weak part to be reported.
COMPLEMENTS = {"identifier": ("secret",), "secret": ("identifier", "endpoint"), "endpoint": ("secret",)}
KINDS = (*BASE_KINDS, *WEAK)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base patterns, in code points, by start and then kind as listed."""
    found = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], BASE_KINDS.index(s[2])))


def weak_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the weak parts; what lies in an identifier or endpoint is not a secret of its own."""
    found = [(m.start(), m.end(), kind) for kind in ("identifier", "endpoint") for m in WEAK[kind].finditer(text)]
    own = sorted(found)
    at = 0
    for m in WEAK["secret"].finditer(text):
        if not (DIGIT.search(text, m.start(), m.end()) and SMALL.search(text, m.start(), m.end())):
            continue
        while at < len(own) and own[at][1] <= m.start():
            at += 1
        if at == len(own) or own[at][0] >= m.end():
            found.append((m.start(), m.end(), "secret"))
    return found


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for given in batches:
        tags, ids, base, weak = [], [], [], []
        for tag, doc, text in zip(given.column(0), given.column(1), given.column(2)):
            text = text.as_py() or ""
            tags.append(tag.as_py())
            ids.append(doc.as_py())
            base.append([{"start": a, "end": z, "kind": k} for a, z, k in base_spans(text)])
            weak.append([{"start": a, "end": z, "kind": k} for a, z, k in weak_spans(text)])
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(tags, pa.int64()), pa.array(ids, pa.int64()), pa.array(base, span), pa.array(weak, span)], names=["_tag", "doc_id", "base", "weak"]
        )


def _linked(parts: DataFrame, reach: int) -> DataFrame:
    """The weak parts with a complementary part at most ``reach`` characters away.

    An interval join that never forms pairs: text is cut into stretches of ``reach``
    characters, a part stands in each stretch it touches, and a stretch keeps, per kind,
    only the first start and the last end. A candidate widened by ``reach`` meets a part
    of another kind if one of the stretches it touches holds one that overlaps it; within
    a stretch the one ending last or the one starting first decides that.
    """
    touched = F.sequence(F.call_function("div", F.col("start"), F.lit(reach)), F.call_function("div", F.col("end") - 1, F.lit(reach)))
    cells = parts.select("_tag", "kind", "start", "end", F.explode(touched).alias("cell"))
    # clipped to the stretch, so that the extremes of a stretch are enough
    low, high = F.greatest("start", F.col("cell") * reach), F.least("end", (F.col("cell") + 1) * reach)
    ends = cells.groupBy("_tag", "cell", F.col("kind").alias("other")).agg(F.min(low).alias("first"), F.max(high).alias("last"))
    wide = F.sequence(F.greatest(F.lit(0), F.call_function("div", F.col("start") - reach - 1, F.lit(reach))), F.call_function("div", F.col("end") + reach, F.lit(reach)))
    needs = F.create_map(*[x for k, c in COMPLEMENTS.items() for x in (F.lit(k), F.array(*map(F.lit, c)))])
    asked = (
        parts.select("_tag", "kind", "start", "end", F.explode(needs[F.col("kind")]).alias("other"))
        .select("*", F.explode(wide).alias("cell"))
    )
    near = (F.col("first") <= F.col("end") + reach) & (F.col("last") >= F.col("start") - reach)
    # exact: the widened candidate is longer than a stretch, so no two parts of one stretch can lie on both its sides
    return asked.join(ends, ["_tag", "other", "cell"]).where(near).select("_tag", "kind", "start", "end").distinct()


def find_secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", reach: int = 200) -> DataFrame:
    """One row per input row: _tag, doc_id, base and spans, both arrays of (start, end, kind).

    ``base`` holds the matches of the three base patterns. ``spans`` adds the linked weak
    parts: access identifiers, secrets (16 or more characters with a digit and a small
    letter) and endpoints. A weak part is reported only if a complementary one, a secret
    for an identifier or endpoint and either of these for a secret, is at most ``reach``
    characters away: alone it is too often an ordinary word, number or address. A weak
    part that is itself a base span is not repeated; it still links others.

    A null or empty text has no spans; a null doc_id stays null; repeated rows are
    scanned alike; an empty table gives no rows; other columns are not read. Texts go
    through one scan; only the rare spans are shuffled.
    """
    span = "array<struct<start: long, end: long, kind: string>>"
    scanned = docs.select(F.monotonically_increasing_id().alias("_tag"), F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    scanned = materialize(scanned.mapInArrow(_scan, f"_tag long, doc_id long, base {span}, weak {span}"), "secrets")
    parts = scanned.select("_tag", F.explode("weak").alias("w")).select("_tag", "w.*")
    linked = _linked(parts, reach).groupBy("_tag").agg(F.collect_list(F.struct("start", "end", "kind")).alias("linked"))
    known = F.coalesce("linked", F.array().cast(span))
    fresh = F.filter(known, lambda w: ~F.exists("base", lambda b: (b["start"] <= w["start"]) & (b["end"] >= w["end"])))
    order = F.array(*map(F.lit, KINDS))
    keyed = F.transform(
        F.concat("base", fresh),
        lambda s: F.struct(s["start"].alias("start"), F.array_position(order, s["kind"]).alias("n"), s["end"].alias("end"), s["kind"].alias("kind")),
    )
    ordered = F.transform(F.array_sort(keyed), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    return scanned.join(linked, "_tag", "left").select("_tag", "doc_id", "base", ordered.alias("spans"))


def query(spark, sf_dir):
    """All documents: counts per base kind, the digest of the base spans, and all spans."""
    found = find_secrets(table(spark, sf_dir, "documents"))

    def shown(spans: str):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, BASE_KINDS), F.sha2(shown("base").cast("binary"), 256).alias("base_sha256"), shown("spans").alias("spans"))
