"""Secret scanning with corpus-wide ownership frequency.

Three base patterns (assignments of passwords and keys, access keys, long hex
runs) are found in every whole text with their code-point spans. On top, every
token that looks random (``CANDIDATE``: 20 characters and more that mix letters
and digits) is a candidate. Candidates are hashed and counted over the corpus:
in how many repositories and under how many owners does the same string appear?
A string copied between owners or across many repositories is an example from
some documentation; one that a single owner holds in few repositories looks live
and is reported as a span of kind ``owned``. Without a repository column owners alone
decide: copies of a file, or a key that its owner uses in many texts, are no
sign of an example. Base spans stay whatever their frequency.

Spans come from splitting a text at its matches: the pieces between them and the
matches themselves, laid end to end, give every start. All steps are DataFrame
expressions. Counting combines map-side (per string, owner and repository, then
per string), so a string that a third of all documents hold is a few rows.

Defined results: null text counts as empty and has no spans. Repeated rows are
scanned one by one; a repository counts once per string. A null owner or
repository is a value like others. An empty table gives no rows; other columns
are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pointframe.llm.common import materialize, pick

# fixed values: the base patterns (Java syntax), in the order of their kinds
KINDS = ("assign", "access", "hex")
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
# a run of key characters in which letters and digits mix
CANDIDATE = r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9])(?=[0-9+/_-]*[A-Za-z])[A-Za-z0-9+/_-]{20,}"


SPAN = "array<struct<start:long,kind:string,end:long,value:string>>"
RUN = 512


def spans(text: Column, pattern: str, kind: str, keep=None) -> Column:
    """Array of (start, kind, end, value) of the matches of ``pattern``; ``keep`` tells from an aligned array."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    ok = keep(text) if keep is not None else F.transform(found, lambda m: F.lit(True))
    gaps = F.slice(F.split(text, pattern, -1), 1, F.size(found))
    zipped = F.zip_with(F.zip_with(gaps, found, lambda g, m: F.struct(F.length(g).alias("gap"), m.alias("m"))), ok,
                        lambda z, k: F.struct(z["gap"].cast("long").alias("gap"), z["m"].alias("m"), k.alias("ok")))
    # starts are running sums of lengths: first within runs of matches, then over the runs, so
    # that texts with very many matches do not copy their whole list for each of them
    runs = F.transform(F.sequence(F.lit(0), F.size(found) - 1, F.lit(RUN)), lambda r: F.slice(zipped, r + 1, RUN))
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(SPAN).alias("out"))

    def one(acc, x):
        start = acc["at"] + x["gap"]
        end = start + F.length(x["m"])
        here = F.array(F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), x["m"].alias("value")))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.when(x["ok"], here).otherwise(F.array().cast(SPAN))).alias("out"))

    def all_(acc, run):
        inner = F.aggregate(run, zero, one)
        moved = F.transform(inner["out"], lambda s: F.struct(
            (s["start"] + acc["at"]).alias("start"), s["kind"].alias("kind"), (s["end"] + acc["at"]).alias("end"), s["value"].alias("value")))
        return F.struct((acc["at"] + inner["at"]).alias("at"), F.concat(acc["out"], moved).alias("out"))

    located = F.aggregate(runs, zero, all_, lambda acc: acc["out"])
    return F.when(F.regexp_like(text, F.lit(pattern)), located).otherwise(F.array().cast(SPAN))


def _long_enough(text: Column) -> Column:
    return F.transform(F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(1)), lambda v: F.length(v) >= 6)


def scan_secrets(docs: DataFrame, id: str = "doc_id", text: str = "text", owner: str = "source", repository: str | None = None, *,
                 max_owners: int = 1, max_repositories: int = 3) -> DataFrame:
    """Per row of ``docs``: id, base and owned, both arrays of (start, kind, end) in order.

    ``owned``: candidates that at most ``max_owners`` owners hold, where a ``repository`` column is
    given in at most ``max_repositories`` repositories.
    """
    rows = pick(docs, id=id, text=text, owner=owner, **({"repo": repository} if repository else {})).withColumn("text", F.coalesce("text", F.lit("")))
    if not repository:  # equal texts are one place, and an owner may have any number of them
        rows = rows.withColumn("repo", F.xxhash64("text"))
    t = F.col("text")
    scanned = rows.select(
        "id", "owner", "repo", F.monotonically_increasing_id().alias("row"),
        F.transform(spans(t, ASSIGN, "assign", _long_enough), lambda s: s.dropFields("value")).alias("assign"),
        F.transform(spans(t, ACCESS, "access"), lambda s: s.dropFields("value")).alias("access"),
        F.transform(spans(t, HEX, "hex"), lambda s: s.dropFields("value")).alias("hex"),
        F.transform(spans(t, CANDIDATE, "owned"), lambda s: F.struct(
            s["start"], s["end"], F.sha2(s["value"], 256).alias("sha"))).alias("candidates"))
    # written once, without the texts: what follows sees one fixed numbering of the rows
    scanned = materialize(scanned, "scanned")
    held = scanned.select("owner", "repo", "row", F.explode("candidates").alias("c")).select(
        "owner", "repo", "row", F.col("c.start").alias("start"), F.col("c.end").alias("end"), F.col("c.sha").alias("sha"))
    per_repo = held.groupBy("sha", "owner", "repo").agg(F.count("*").alias("n"))
    per_owner = per_repo.groupBy("sha", "owner").agg(F.count("*").alias("repos"))
    rare = (per_owner.groupBy("sha").agg(F.count("*").alias("owners"), F.sum("repos").alias("repos"))
            .where((F.col("owners") <= max_owners) & ((F.col("repos") <= max_repositories) if repository else F.lit(True))))
    owned = held.join(rare.select("sha"), "sha", "left_semi").groupBy("row").agg(
        F.collect_list(F.struct("start", F.lit("owned").alias("kind"), "end")).alias("owned"))
    none = F.array().cast("array<struct<start:long,kind:string,end:long>>")
    out = scanned.drop("candidates", "owner", "repo").join(owned, "row", "left")
    rank = lambda s: F.struct(s["start"], F.when(s["kind"] == "assign", 0).when(s["kind"] == "access", 1)
                              .when(s["kind"] == "hex", 2).otherwise(3).alias("rank"), s["kind"].alias("kind"), s["end"].alias("end"))
    order = lambda a: F.transform(F.array_sort(F.transform(a, rank)), lambda s: F.struct(s["start"], s["kind"], s["end"]))
    return out.select("id", "assign", "access", "hex", order(F.concat("assign", "access", "hex")).alias("base"),
                      order(F.concat("assign", "access", "hex", F.coalesce("owned", none))).alias("spans"))


def join_spans(a: Column) -> Column:
    return F.array_join(F.transform(a, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
