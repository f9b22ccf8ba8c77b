"""Secret scans in DataFrame functions only, with multipart credential linking.

Three base kinds are certain by their form. Weak parts (endpoints, key-like identifiers and
bare key material) mean little alone: they are reported only when parts that complement each other
lie within one scope of a text, found by an interval join on the stretches of text they cover.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import Scratch, row_identity

#: fixed patterns of the base kinds, in the order in which spans of one start are listed
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"  # the runs of AKIA[A-Z0-9]+ with 18 characters or more
HEX = r"[0-9a-f]{16,}"
BASE = ("assign", "access", "hex")
#: fixed patterns of the weak parts, with what each of them complements
ENDPOINT = r"(https?|postgres(ql)?|mysql|mongodb|redis|amqp)://[A-Za-z0-9.-]+(:[0-9]+)?(/[A-Za-z0-9._~/-]*)?"
IDENTIFIER = r"""(?i)(client_?id|user_?name|user|login|account|access_key_?id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]{3,}"""
MATERIAL = r"[A-Za-z0-9+/=_-]{32,}"  # kept if it is base64 and mixes digits with letters of both cases
WEAK = ("endpoint", "identifier", "material")
ROLES = {"assign": "secret", "access": "access", "hex": "secret", "endpoint": "endpoint", "identifier": "access", "material": "secret"}
SCOPE = 200
#: hits of a text that are laid out at a time
SLICE_HITS = 128


def _is_material(hit: Column) -> Column:
    return hit.rlike("^[A-Za-z0-9+/]+={0,2}$") & hit.rlike("[0-9]") & hit.rlike("[A-Z]") & hit.rlike("[a-z]")


def found(text: Column, pattern: str, kind: str, group: int = 0, keep: Callable[[Column], Column] | None = None) -> Column:
    """Array of (start, rank, kind, end) of the leftmost non-overlapping matches, in code points.

    The pieces between the matches and the matches themselves add up to every position. A match whose ``group`` fails
    ``keep`` is dropped after it has taken its place.
    """
    rank = (BASE + WEAK).index(kind)
    pieces = F.split(text, pattern, -1)
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    inner = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    cut = F.arrays_zip(F.slice(pieces, F.lit(1), F.size(whole)).alias("piece"), whole.alias("hit"), inner.alias("inner"))
    lengths = F.transform(cut, lambda x: F.struct(F.length(x["piece"]).alias("before"), F.length(x["hit"]).alias("size"), x["inner"].alias("inner")))
    span = "struct<start:long,rank:int,kind:string,end:long,inner:string>"

    def one(s: Column, x: Column) -> Column:
        start = s["at"] + x["before"]
        new = F.struct(start.alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), (start + x["size"]).alias("end"), x["inner"].alias("inner"))
        return F.struct((start + x["size"]).alias("at"), F.concat(s["spans"], F.array(new)).alias("spans"))

    def slice_of(s: Column, x: Column) -> Column:
        done = F.aggregate(x, F.struct(s["at"].alias("at"), F.array().cast(f"array<{span}>").alias("spans")), one)
        return F.struct(done["at"].alias("at"), F.concat(s["slices"], F.array(done["spans"])).alias("slices"))

    # an array that grows is copied for every hit; slices keep what is copied short, so that a text's cost stays in proportion to its hits
    def sliced(every: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(every) - 1) / SLICE_HITS).cast("int")), lambda i: F.slice(every, i * SLICE_HITS + 1, F.lit(SLICE_HITS)))

    # a lambda's own variable is worked out once, what it takes from outside once per element
    slices = F.transform(F.array(lengths), sliced)[0]
    begin = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(f"array<array<{span}>>").alias("slices"))
    laid = F.aggregate(slices, begin, slice_of, lambda s: F.flatten(s["slices"]))
    kept = F.filter(laid, lambda x: keep(x["inner"])) if keep else laid
    plain = F.transform(kept, lambda x: F.struct(x["start"].alias("start"), x["rank"].alias("rank"), x["kind"].alias("kind"), x["end"].alias("end")))
    return F.when(text.rlike(pattern), plain).otherwise(F.array().cast("array<struct<start:long,rank:int,kind:string,end:long>>"))


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined, by start and then kind."""
    return F.array_join(F.transform(F.array_sort(spans), lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def _stretches(start: Column, end: Column, scope: int, around: int = 0) -> Column:
    """The stretches of ``scope`` characters that a span touches, and ``around`` more on both sides."""
    return F.explode(F.sequence(F.floor(start / scope) - around, F.floor((end - 1) / scope) + around)).alias("stretch")


def beside_base(rows: DataFrame, scope: int) -> DataFrame:
    """(r1, r2, span) of the weak spans that overlap no base span of their text.

    A join by the stretches that spans touch: a stretch holds few spans, as those of one kind do not overlap and none is short.
    """
    weak = rows.select("r1", "r2", F.explode("weak").alias("span")).distinct()
    base = rows.select("r1", "r2", F.explode("base").alias("b")).distinct()
    base = base.select("r1", "r2", "b.start", "b.end", _stretches(F.col("b.start"), F.col("b.end"), scope))
    touched = weak.select("r1", "r2", "span", _stretches(F.col("span.start"), F.col("span.end"), scope))
    over = touched.join(base, ["r1", "r2", "stretch"]).where((F.col("start") < F.col("span.end")) & (F.col("span.start") < F.col("end")))
    over = over.select(F.col("r1").alias("o1"), F.col("r2").alias("o2"), F.col("span").alias("o")).distinct()
    return weak.join(over, (F.col("r1") == F.col("o1")) & (F.col("r2") == F.col("o2")) & (F.col("span") == F.col("o")), "left_anti")


def linked_parts(spans: DataFrame, scope: int) -> DataFrame:
    """Weak spans of (r1, r2, span) that have a complementary part of another role within ``scope`` characters.

    An interval join: every part covers the stretches of ``scope`` characters it touches, a weak part asks in its own and the
    neighbouring ones, and per stretch only the outermost ends of each role take part, so a stretch crowded with parts does not multiply.
    """
    role = reduce(lambda c, k: c.when(F.col("span.kind") == k, ROLES[k]), ROLES, F.when(F.lit(False), ""))
    parts = spans.withColumn("role", role)
    touched = _stretches(F.col("span.start"), F.col("span.end"), scope)
    # of a role in a stretch: the first start and the last end, as nothing else can be nearer from outside it
    ends = parts.select("r1", "r2", "role", "span", touched).groupBy("r1", "r2", "stretch", "role").agg(
        F.min("span.start").alias("first"), F.max("span.end").alias("last"), F.count(F.lit(1)).alias("n")
    )
    asking = parts.where(F.col("span.kind").isin(*WEAK)).select(
        "r1", "r2", "role", "span", _stretches(F.col("span.start"), F.col("span.end"), scope, 1)
    )
    other = ends.select("r1", "r2", "stretch", F.col("role").alias("other"), "first", "last")
    near = (F.col("first") <= F.col("span.end") + scope) & (F.col("last") + scope >= F.col("span.start"))
    met = asking.join(other, ["r1", "r2", "stretch"]).where((F.col("role") != F.col("other")) & near)
    return met.select("r1", "r2", "span").distinct()


def scan_secrets(docs: DataFrame, scope: int = SCOPE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: its id, ``base`` and ``linked`` (arrays of (start, rank, kind, end)), sorted by start.

    ``base`` holds the three certain kinds. ``linked`` holds weak parts (``endpoint``, ``identifier``, ``material``) that have a part of
    another role (access, secret, endpoint; base spans included) within ``scope`` characters in the same text. A weak part that
    overlaps a base span is not listed again.

    Positions are in code points, ends exclusive. A null or empty text has no spans. Rows equal in id and text get equal results. Other
    columns take no part. An empty table gives an empty result. Texts never shuffle: only spans do.
    """
    scratch = Scratch(docs.sparkSession, "secrets")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    r1, r2 = row_identity(F.col(id_col), text)
    base = F.array_sort(F.concat(found(text, ASSIGN, "assign", 2, lambda v: F.length(v) >= 12), found(text, ACCESS, "access"), found(text, HEX, "hex")))
    weak = F.concat(found(text, ENDPOINT, "endpoint"), found(text, IDENTIFIER, "identifier"), found(text, MATERIAL, "material", 0, _is_material))
    rows = docs.select(F.col(id_col).alias("_ss_id"), r1.alias("r1"), r2.alias("r2"), base.alias("base"), weak.alias("weak"))
    rows = scratch.write(rows, "spans")
    hits = rows.where(F.size("weak") > 0)
    alone = scratch.write(beside_base(hits, scope), "weak")
    spans = hits.select("r1", "r2", F.explode("base").alias("span")).distinct().unionAll(alone)
    linked = linked_parts(spans, scope).groupBy("r1", "r2").agg(F.array_sort(F.collect_list("span")).alias("linked"))
    none = F.array().cast(linked.schema["linked"].dataType)
    return rows.join(linked, ["r1", "r2"], "left").select(F.col("_ss_id").alias(id_col), "base", F.coalesce("linked", none).alias("linked"))
