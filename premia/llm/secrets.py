"""Secret scan with corpus-wide ownership, in DataFrame operations only.

One pass over the texts finds the candidates of every kind with their places. Their values are then counted over the
whole corpus: by how many repositories and how many owners each is held. A value that one owner alone holds looks like
a live credential; one that many owners hold is a copied example. Kinds that are strong by themselves (``BASE``) are
always reported, with the counts as evidence; long mixed tokens without a telling context are reported, as kind
``owned``, only where their owner is the only one.

Places come from the lengths of the text between matches and of the matches, summed per document; they are code
points, the end is exclusive. Matches of a kind are leftmost and do not overlap. All counting is pre-aggregated before
the shuffle, so a value that a third of all rows holds is no hot group; the counts return to the candidates by a join
that Spark can split by its rows. Documents with many candidates are sorted, never held in one row until the last step.

Null texts count as empty. Rows are scanned one by one: repeated rows give repeated results (the same repository counts
once) and null ids stay. Null owners count as one owner of their own, and so do null repositories. Extra columns are
ignored unless they are named in ``keep``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from premia.llm.common import stored, text_of

# The patterns, the group that holds the value, and the least length of that group.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
MIXED = r"[A-Za-z0-9+_-]{20,}"
KINDS = {"assign": (ASSIGN, 2, 12), "access": (ACCESS, 0, 18), "hex": (HEX, 0, 16), "owned": (MIXED, 0, 20)}
BASE = ("assign", "access", "hex")
#: Owners up to which a value looks live, and from which it is a copied example.
LIVE_OWNERS, EXAMPLE_OWNERS = 1, 3


def _rank(kind: Column) -> Column:
    return reduce(lambda c, k: c.when(kind == k[1], k[0]), enumerate(KINDS), F.when(F.lit(False), 0))


def _mixed(value: Column) -> Column:
    """Digits and letters of both cases."""
    return value.rlike("[0-9]") & value.rlike("[a-z]") & value.rlike("[A-Z]")


def _scan(docs: DataFrame, id_col: str, text_col: str, repo_col: str, owner_col: str, keep: tuple[str, ...]) -> DataFrame:
    """One row per document with the matches of each kind and the lengths of the text between them."""
    text = F.col("__text")
    found = docs.select(
        F.monotonically_increasing_id().alias("__row"),
        F.struct(*[docs[c] for c in dict.fromkeys([id_col, *keep])]).alias("__kept"),
        docs[repo_col].cast("string").alias("__repo"),
        docs[owner_col].cast("string").alias("__owner"),
        text_of(text_col).alias("__text"),
    ).withColumns({f"m_{k}": F.regexp_extract_all(text, F.lit(p), F.lit(0)) for k, (p, *_) in KINDS.items()})
    none = F.array().cast("array<struct<gap:int,match:string,value:string>>")
    zipped = {}
    for kind, (pattern, group, _) in KINDS.items():
        match = F.col(f"m_{kind}")
        gaps = F.transform(F.slice(F.split(text, pattern, -1), 1, F.size(match)), F.length)
        values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else match
        zipped[kind] = F.when(F.size(match) > 0, F.arrays_zip(gaps.alias("gap"), match.alias("match"), values.alias("value")).cast("array<struct<gap:int,match:string,value:string>>")).otherwise(none)
    columns = [zipped[k].alias(k) for k in KINDS]
    return found.select("__row", "__kept", "__repo", "__owner", *columns)


def _candidates(scanned: DataFrame) -> DataFrame:
    """Candidates with their places and the hash of their value."""
    rows = reduce(
        DataFrame.unionByName,
        [
            scanned.filter(F.size(kind) > 0).select("__row", "__repo", "__owner", F.lit(kind).alias("kind"), F.posexplode(kind).alias("i", "x")).select("__row", "__repo", "__owner", "kind", "i", "x.*")
            for kind in KINDS
        ],
    )
    before = Window.partitionBy("__row", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    least = reduce(lambda c, k: c.when(F.col("kind") == k, KINDS[k][2]), KINDS, F.when(F.lit(False), 0))
    placed = rows.withColumn("end", F.sum(F.col("gap") + F.length("match")).over(before).cast("long"))
    return placed.filter((F.length("value") >= least) & ((F.col("kind") != "owned") | _mixed(F.col("value")))).select(
        "__row", "__repo", "__owner", "kind", (F.col("end") - F.length("match")).alias("start"), "end", F.sha2("value", 256).alias("value_hash")
    )


def ownership(candidates: DataFrame) -> DataFrame:
    """For each value hash the number of repositories and of owners that hold it."""
    held = candidates.select("value_hash", "__repo", "__owner").distinct()
    owners = held.groupBy("value_hash", "__owner").agg(F.lit(1).alias("one")).groupBy("value_hash").agg(F.count("*").alias("owners"))
    repos = held.groupBy("value_hash", "__repo").agg(F.lit(1).alias("one")).groupBy("value_hash").agg(F.count("*").alias("repos"))
    return owners.join(repos, "value_hash")


def scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    repo_col: str = "doc_id",
    owner_col: str = "source",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """One row per row of ``docs``: id, the columns of ``keep``, and ``spans`` by start and kind: kind, start, end,
    value_hash, repos, owners and verdict (live, shared or example)."""
    scanned = stored(_scan(docs, id_col, text_col, repo_col, owner_col, keep), "secret-matches")
    candidates = stored(_candidates(scanned), "secret-candidates")
    verdict = F.when(F.col("owners") <= LIVE_OWNERS, "live").when(F.col("owners") >= EXAMPLE_OWNERS, "example").otherwise("shared")
    judged = candidates.join(ownership(candidates), "value_hash").withColumn("verdict", verdict)
    reported = judged.filter((F.col("kind") != "owned") | (F.col("verdict") == "live"))
    span = F.struct("start", _rank(F.col("kind")).alias("rank"), "end", "kind", "value_hash", "repos", "owners", "verdict")
    spans = reported.groupBy("__row").agg(F.array_sort(F.collect_list(span)).alias("spans"))
    shape = "array<struct<kind:string,start:long,end:long,value_hash:string,repos:long,owners:long,verdict:string>>"
    ordered = F.transform("spans", lambda s: F.struct(*[s[c].alias(c) for c in ("kind", "start", "end", "value_hash", "repos", "owners", "verdict")]))
    joined = scanned.select("__row", "__kept").join(spans, "__row", "left")
    return joined.select("__kept.*", F.coalesce(ordered.cast(shape), F.array().cast(shape)).alias("spans"))


def listed(spans: Column) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def of_base(spans: Column) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*BASE))


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def masked(text: Column, spans: Column, mark: str = "[removed]") -> Column:
    """The text with every stretch that spans cover replaced by ``mark``; stretches that overlap or touch become one."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))

    def step(state: Column, span: Column) -> Column:
        gap = F.substring(text, (state["at"] + 1).cast("int"), (span["start"] - state["at"]).cast("int"))
        fresh = (span["start"] > state["at"]) | (state["out"] == "")
        return F.struct(
            F.when(fresh, F.concat(state["out"], gap, F.lit(mark))).otherwise(state["out"]).alias("out"),
            F.greatest(state["at"], span["end"]).alias("at"),
        )

    rest = lambda s: F.concat(s["out"], F.substring(text, (s["at"] + 1).cast("int"), F.length(text)))
    return F.when(F.size(spans) > 0, F.aggregate(spans, start, step, rest)).otherwise(text)
