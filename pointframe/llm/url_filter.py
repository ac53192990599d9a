"""URL filtering: rules for hosts and paths, then trust spread over the host graph.

Rules (host, path, verdict) fit a host and all its subdomains when the URL's path
starts with the rule's; the longest fits best, and block wins a tie. URLs that no
rule fits get their host's verdict from the link graph: personalised PageRank
starts at hosts with pages that a rule allows and runs along the edges (trust),
and starts at hosts with pages that a rule blocks and runs against them
(distrust). A host is blocked when trust / (trust + distrust) is below
``threshold``; a host that neither reaches is allowed.

Edges go from a page's host to the hosts that its links name, and from a host to
its nearest parent domain that has pages. Walks are joins and aggregates over
host edges, cut by written tables every few rounds; dangling hosts lose their
mass, which scales all scores alike. All steps are DataFrame expressions, and
counts combine map-side, so a hot host is one row per task.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
lower-cased. Path: from there up to ``?``, ``#`` or the end. Defined results: a
null URL or one without ``://`` has an empty host and path, fits no rule and is
allowed by the method. Null html has no links. Repeated rows are judged one by
one and weigh as often. An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pointframe.llm.common import ascii_lower, materialize, pick, sized

# an attribute that links to another host, absolute or with the page's scheme
LINK = r"""(?i:href|src)\s*=\s*["']?(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#"'\s<>]+)"""


def host_of(url: Column) -> Column:
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    return F.coalesce(ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    return F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def suffixes(host: Column) -> Column:
    """The host and its parent domains, longest first."""
    parts = F.split(host, r"\.", -1)
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))


def host_rules(hosts: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """Per host: rules, an array of (length, block, rule, path) that fit it or a parent."""
    table = hosts.sparkSession.createDataFrame(
        [(h, p, len(h + p), v == "block", h + p) for h, p, v in rules], "suffix string, path string, length int, block boolean, rule string")
    table = F.broadcast(table) if len(rules) <= 100_000 else table
    fits = hosts.select("host", F.explode(suffixes(F.col("host"))).alias("suffix")).join(table, "suffix")
    return fits.groupBy("host").agg(F.collect_list(F.struct("length", "block", "rule", "path")).alias("rules"))


def best_rule(rules: Column, path: Column) -> Column:
    return F.array_max(F.filter(F.coalesce(rules, F.array().cast("array<struct<length:int,block:boolean,rule:string,path:string>>")),
                                lambda r: F.startswith(path, r["path"])))


def host_edges(pages: DataFrame, hosts: DataFrame) -> DataFrame:
    """(src, dst, weight): links between different hosts and steps to the nearest parent with pages."""
    links = pages.select("host", F.explode(F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(LINK), F.lit(1))).alias("to"))
    links = links.select(F.col("host").alias("src"), ascii_lower(F.col("to")).alias("dst"))
    links = links.groupBy("src", "dst").agg(F.count("*").cast("double").alias("weight"))
    up = hosts.select(F.col("host").alias("src"), F.posexplode(suffixes(F.col("host"))).alias("k", "dst")).where("k > 0")
    up = up.join(hosts.select(F.col("host").alias("dst")), "dst").groupBy("src").agg(F.min(F.struct("k", "dst")).alias("p"))
    edges = links.unionByName(up.select("src", F.col("p.dst").alias("dst"), F.lit(1.0).alias("weight")))
    edges = edges.where("src != dst and src != '' and dst != ''").groupBy("src", "dst").agg(F.sum("weight").alias("weight"))
    return edges


def walk(edges: DataFrame, seeds: DataFrame, damping: float = 0.85, rounds: int = 20, cut: int = 5) -> DataFrame:
    """Personalised PageRank (host, score): ``seeds`` (host, mass) restart the walk; scores add up to 1."""
    out = edges.groupBy("src").agg(F.sum("weight").alias("total"))
    steps = materialize(edges.join(out, "src").select("src", "dst", (F.col("weight") / F.col("total")).alias("part")), "steps")
    total = seeds.agg(F.sum("mass").alias("m")).collect()[0]["m"]
    if not total:
        return seeds.select("host", F.lit(0.0).alias("score")).where("false")
    start = materialize(seeds.where("mass > 0").select("host", (F.col("mass") / float(total)).alias("score")), "seeds")
    rank = start
    for k in range(1, rounds + 1):
        moved = steps.join(rank, steps["src"] == rank["host"]).select(F.col("dst").alias("host"), (F.col("part") * F.col("score") * damping).alias("score"))
        rank = moved.unionByName(start.select("host", (F.col("score") * (1 - damping)).alias("score"))).groupBy("host").agg(F.sum("score").alias("score"))
        if k % cut == 0 or k == rounds:
            rank = materialize(rank, "rank")
    whole = rank.agg(F.sum("score").alias("s")).collect()[0]["s"]
    return rank.select("host", (F.col("score") / float(whole)).alias("score"))


def judge_urls(pages: DataFrame, rules: list[tuple[str, str, str]], id: str = "page_id", url: str = "url", html: str = "html", *,
               threshold: float = 0.5, rounds: int = 20, max_hosts: int = 200_000) -> DataFrame:
    """Per row of ``pages``: id, host, path, rule, verdict, trust, distrust."""
    rows = pick(pages, id=id, url=url, html=html)
    rows = rows.select("id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "html")
    urls = materialize(rows.drop("html"), "urls")
    hosts = materialize(urls.groupBy("host").agg(F.count("*").alias("pages")), "hosts")
    ruled = materialize(hosts.join(host_rules(hosts, rules), "host", "left").select("host", "rules"), "rules")
    judged = urls.join(sized(ruled, max_hosts), "host").withColumn("best", best_rule(F.col("rules"), F.col("path"))).drop("rules")
    seeds = materialize(judged.where("best is not null and host != ''").groupBy("host").agg(
        F.count(F.when(~F.col("best.block"), 1)).alias("allowed"), F.count(F.when(F.col("best.block"), 1)).alias("blocked")), "seeds")
    edges = materialize(host_edges(rows, hosts), "edges")
    back = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")
    trust = walk(edges, seeds.select("host", F.col("allowed").alias("mass")), rounds=rounds)
    distrust = walk(back, seeds.select("host", F.col("blocked").alias("mass")), rounds=rounds)
    scores = hosts.select("host").join(trust.withColumnRenamed("score", "trust"), "host", "left").join(
        distrust.withColumnRenamed("score", "distrust"), "host", "left").fillna(0.0, ["trust", "distrust"])
    scores = materialize(scores.join(ruled, "host"), "scores")
    out = urls.join(sized(scores, max_hosts), "host").withColumn("best", best_rule(F.col("rules"), F.col("path")))
    doubt = (F.col("trust") + F.col("distrust") > 0) & (F.col("trust") < threshold * (F.col("trust") + F.col("distrust")))
    verdict = F.when(F.col("best").isNull(), F.when(doubt, "block").otherwise("allow")).when(F.col("best.block"), "block").otherwise("allow")
    return out.select("id", "host", "path", F.col("best.rule").alias("rule"), verdict.alias("verdict"), "trust", "distrust")
