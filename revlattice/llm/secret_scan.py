"""Secret scan with corpus-wide ownership, in DataFrame operations only.

Spans come from fixed patterns. Every candidate value is then counted over the distinct repositories and owners that hold
it: a value of one owner in few repositories looks live, a value that many owners or repositories share is an example.
Live values are also reported where they stand without a telling name.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revlattice.llm.common import written

#: Fixed values of the contract: the kinds in their order, and their patterns.
KINDS = ("assign", "access", "hex")
ASSIGN = r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
BARE = r"[A-Za-z0-9+/_.=-]{12,}"
#: The order of the kinds that a comma-joined list follows at equal starts; ``owned`` is added by the method.
ALL = (*KINDS, "owned")
#: A value looks live if no more owners and repositories than these hold it, and is an example if more of either do.
LIVE_OWNERS, LIVE_REPOS = 1, 2
EXAMPLE_OWNERS, EXAMPLE_REPOS = 3, 8
#: Matches whose offsets are added up at once.
BLOCK = 256
#: What a value is compared without: marks at its end, as of a sentence, and a name in front of its last equals sign.
END_MARKS, NAME = r"[./=_+-]+$", r"^.*="


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often it is named."""
    return F.transform(F.array(value), use)[0]


def _ranges(text: Column, pattern: str) -> Column:
    """(start, end, value) of every match: the lengths of the pieces between matches and of the matches add up to offsets.

    Offsets are added up in blocks, and then those of the blocks, as a growing array is copied with every value it gets.
    """
    kind = "array<struct<start:int,end:int,value:string>>"

    def placed(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        span = F.struct(start.alias("start"), (start + F.length(x["value"])).alias("end"), x["value"].alias("value"))
        return F.struct((start + F.length(x["value"])).alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))

    def added(blocks: Column) -> Column:
        begins = F.aggregate(
            blocks,
            F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")),
            lambda acc, x: F.struct((acc["at"] + x["at"]).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")),
            lambda acc: acc["out"],
        )
        moved = lambda block, by: F.transform(block["out"], lambda x: F.struct((x["start"] + by).alias("start"), (x["end"] + by).alias("end"), x["value"].alias("value")))
        return F.flatten(F.zip_with(blocks, begins, moved))

    def folded(parts: Column) -> Column:
        empty = F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("out"))
        numbers = F.sequence(F.lit(0), F.floor((F.size(parts) - 1) / BLOCK).cast("int"))
        return _let(F.transform(numbers, lambda b: F.aggregate(F.slice(parts, b * BLOCK + 1, F.lit(BLOCK)), empty, placed)), added)

    # There is one piece more than there are matches; the last one has no match behind it.
    pieces, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = F.filter(F.zip_with(pieces, found, lambda p, m: F.struct(F.length(p).alias("gap"), m.alias("value"))), lambda x: x["value"].isNotNull())
    return F.when(text.rlike(pattern), _let(parts, folded)).otherwise(F.array().cast(kind))


def compared(value: Column) -> Column:
    """What is left of a value for comparison; its span stays whole."""
    return F.regexp_replace(F.regexp_replace(value, END_MARKS, ""), NAME, "")


def _spans(text: Column, pattern: str, kind: int, value=lambda m: m, least: int = 0) -> Column:
    ranges = F.filter(_ranges(text, pattern), lambda x: F.length(value(x["value"])) >= least)
    return F.transform(ranges, lambda x: F.struct(x["start"].alias("start"), F.lit(kind).alias("kind"), x["end"].alias("end"), compared(value(x["value"])).alias("value")))


def _listed(spans: Column) -> Column:
    names = F.array(*(F.lit(k) for k in ALL))
    return F.array_join(F.transform(F.array_sort(spans), lambda x: F.concat_ws(":", F.element_at(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


def base_spans(docs: DataFrame) -> DataFrame:
    """``docs`` with ``base``: spans (start, kind number, end, compared value), offsets in code points, end exclusive."""
    text = F.coalesce("text", F.lit(""))
    assigned = lambda m: F.regexp_extract(m, ASSIGN, 2)
    return docs.withColumn("base", F.concat(_spans(text, ASSIGN, 1, assigned, 6), _spans(text, ACCESS, 2), _spans(text, HEX, 3)))


def _looks_random(value: Column) -> Column:
    return (F.length(value) >= 12) & value.rlike("[0-9]") & value.rlike("[A-Za-z]")


def ownership(occurrences: DataFrame) -> DataFrame:
    """Distinct repositories and owners of every value hash in (hash, repo, owner, named); a null one counts as one of its own.

    ``named`` tells whether any occurrence is a base span.

    Rows are reduced to distinct combinations first, so a value that is everywhere reaches a task as few rows.
    """
    sets = occurrences.groupBy("hash", F.coalesce(F.concat(F.lit("="), "repo"), F.lit("-")).alias("repo"), F.coalesce(F.concat(F.lit("="), "owner"), F.lit("-")).alias("owner")).agg(
        F.count(F.lit(1)).alias("seen"), F.max("named").alias("named")
    )
    by_owner = sets.groupBy("hash", "owner").agg(F.sum("seen").alias("seen"), F.max("named").alias("named"))
    owners = by_owner.groupBy("hash").agg(F.sum("seen").alias("seen"), F.max("named").alias("named"), F.count(F.lit(1)).alias("owners"))
    repos = sets.groupBy("hash", "repo").agg(F.lit(1).alias("one")).groupBy("hash").agg(F.count(F.lit(1)).alias("repos"))
    return owners.join(repos, "hash")


def scan(
    docs: DataFrame, live_owners: int = LIVE_OWNERS, example_owners: int = EXAMPLE_OWNERS, live_repos: int = LIVE_REPOS, example_repos: int = EXAMPLE_REPOS
) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, repo, owner).

    Returns doc_id, the base counts n_assign, n_access, n_hex, ``base`` and ``spans`` (kind:start:end, comma-joined by
    start, then kind), how many base spans have values that look live (at least one letter and one digit in 12 characters,
    held by at most ``live_owners`` owners and ``live_repos`` repositories) or are examples (more than ``example_owners`` owners
    or ``example_repos`` repositories), and the most owners and repositories that hold a base value of the row. The method
    adds ``owned`` spans: whole bare tokens outside base spans whose value looks live and is a base value elsewhere. Values
    are compared without marks at their end and without what precedes their last equals sign.
    A null text counts as empty and gives empty lists; a null repository or owner is one of its own. Rows that repeat a
    doc_id, or are equal, are scanned one by one. No rows give no rows.
    """
    scanned = base_spans(docs.select("doc_id", "text", F.col("repo").cast("string").alias("repo"), F.col("owner").cast("string").alias("owner")))
    bare = F.filter(_spans(F.coalesce("text", F.lit("")), BARE, 4), lambda x: _looks_random(x["value"]))
    rows = written(scanned.select(F.monotonically_increasing_id().alias("row"), "doc_id", "repo", "owner", "base", bare.alias("bare")), "spans")
    spans = rows.select("row", "repo", "owner", F.inline(F.concat("base", "bare"))).withColumn("named", F.col("kind") <= len(KINDS))
    # A base span meets a bare one if it began before and is still open, or begins before that one ends.
    before = Window.partitionBy("row").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    open_until = F.max(F.when(F.col("named"), F.col("end"))).over(before)
    # The spans behind one are those before it in the reverse order, where a sum runs along instead of being begun anew.
    behind = Window.partitionBy("row").orderBy(F.desc("start"), F.desc("kind")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    following = F.min(F.when(F.col("named"), F.col("start"))).over(behind)
    met = F.coalesce(open_until > F.col("start"), F.lit(False)) | F.coalesce(following < F.col("end"), F.lit(False))
    found = spans.withColumn("met", met).filter("named OR NOT met").withColumn("hash", F.sha2("value", 256)).drop("met")
    found = written(found, "found")
    values = ownership(found.select("hash", "repo", "owner", "named"))
    judged = found.drop("owner", "repo").join(values.filter("named").select("hash", "owners", "repos"), "hash")
    live = (F.col("owners") <= live_owners) & (F.col("repos") <= live_repos) & _looks_random(F.col("value"))
    example = (F.col("owners") > example_owners) | (F.col("repos") > example_repos)
    counted = lambda when: F.count(F.when(F.col("named") & when, 1))
    most = lambda c: F.max(F.when(F.col("named"), F.col(c)))
    verdicts = judged.groupBy("row").agg(
        F.collect_list(F.when(live & ~F.col("named"), F.struct("start", "kind", "end", "value"))).alias("added"),
        counted(live).alias("n_live"),
        counted(example).alias("n_example"),
        most("owners").alias("most_owners"),
        most("repos").alias("most_repos"),
    )
    count = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long")
    everything = F.concat("base", F.coalesce("added", F.array().cast(rows.schema["base"].dataType)))
    return rows.join(verdicts, "row", "left").select(
        "doc_id",
        *(count(i + 1).alias(f"n_{k}") for i, k in enumerate(KINDS)),
        _listed(F.col("base")).alias("base"),
        _listed(everything).alias("spans"),
        *(F.coalesce(c, F.lit(0)).alias(c) for c in ("n_live", "n_example", "most_owners", "most_repos")),
    )
