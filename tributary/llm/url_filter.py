"""URL filters: longest rule, then trust and distrust over the link graph.

A rule names a host (it and all subdomains) and the start of a path; the longest
fitting rule decides a url.  Hosts of urls without a rule are judged by link
propagation: personalised PageRank from hosts with allowed pages along the host
edges (trust), and from hosts with blocked pages against them (distrust); a host
is blocked when distrust is more than ``threshold`` of both.  Host edges are the
absolute links of the pages, and a host and its parent domain point to each
other.  All of it is DataFrame joins and sums, one per step of the walk; blocks
of steps are extrapolated, which saves most of them.

Edges are counted once per host pair, pre-aggregated per task, so a host with a
third of all pages is one vertex, not a third of the edges.

Defined results: a null url or one without ``://`` has empty host and path, no
rule, and no evidence; a host without evidence is allowed; null or repeated ids
are kept, one row per page; null html has no links; rules given twice count
once; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.llm.store import cut, drop

#: Distance of the evidence from its fixed point, as a share of the seed mass, at which the walk has converged, and steps of a block.
TOLERANCE, EVERY = 1e-9, 8
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LINK = r"""(?i)\b(?:href|src)\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s>]+)"""


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
    in lower case.  Path: from there up to ``?``, ``#`` or the end."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise("")
    return F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def suffixes(host: Column) -> Column:
    """The host and its parent domains."""
    labels = F.split(host, r"\.", -1)
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def parent(host: Column) -> Column:
    """The parent domain of two labels or more, else null."""
    return F.nullif(F.regexp_extract(host, r"^[^.]*\.(.*\..*)$", 1), F.lit(""))


def with_rule(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``urls`` (host, path, ...) with ``rule`` and ``ruled`` (its verdict).
    ``rules``: host, path, verdict."""
    named = rules.select(F.translate("host", UPPER, LOWER).alias("rule_host"), F.col("path").alias("rule_path"), "verdict").distinct()
    hosts = urls.filter("host != ''").select("host").distinct().withColumn("rule_host", F.explode(suffixes(F.col("host"))))
    fits = hosts.join(named, "rule_host").groupBy("host").agg(F.collect_set(F.struct(
        (-F.length(F.concat("rule_host", "rule_path"))).alias("order"), F.concat("rule_host", "rule_path").alias("rule"), F.col("rule_path").alias("start"), "verdict")).alias("rules"))
    best = F.get(F.filter(F.array_sort("rules"), lambda r: F.startswith(F.col("path"), r["start"])), F.lit(0))
    return urls.join(fits, "host", "left").withColumn("best", best).withColumn("rule", F.col("best.rule")).withColumn("ruled", F.col("best.verdict")).drop("rules", "best")


def host_edges(pages: DataFrame, html: str) -> DataFrame:
    """(src, dst): absolute links between hosts, and host <-> parent domain."""
    links = pages.select("host", F.explode(F.array_distinct(F.regexp_extract_all(F.coalesce(F.col(html), F.lit("")), F.lit(LINK), F.lit(1)))).alias("to"))
    links = links.select(F.col("host").alias("src"), F.translate("to", UPPER, LOWER).alias("dst")).distinct()
    named = pages.select("host").union(links.select("dst")).distinct()
    tree = named.select(F.explode(suffixes(F.col("host"))).alias("host")).distinct().select("host", parent(F.col("host")).alias("up")).filter("up is not null")
    every = links.union(tree.select("host", "up")).union(tree.select("up", "host"))
    return every.filter("src != '' and dst != '' and src != dst").distinct()


def mixture(gram: np.ndarray) -> np.ndarray:
    """Weights of sum 1 that make the mixed step of a block smallest, from the
    inner products of its steps (reduced rank extrapolation); the last step
    alone where mixing gains nothing."""
    last = np.eye(len(gram))[-1]
    top = float(np.trace(gram))
    if not top > 0:
        return last
    best = np.linalg.lstsq(gram + 1e-15 * top * np.eye(len(gram)), np.ones(len(gram)), rcond=None)[0]
    if not np.isfinite(best).all() or abs(best.sum()) < 1e-300:
        return last
    best = best / best.sum()
    return best if best @ gram @ best < gram[-1, -1] else last


def propagate(edges: DataFrame, seeds: DataFrame, *, damping: float = 0.85, steps: int | None = None) -> DataFrame:
    """(host, trust, distrust) from seeds (host, kind, mass): kind 'trust' walks
    along the edges, 'distrust' against them, until no new host is reached and
    the ranks are within ``TOLERANCE`` of the mass of their fixed point (summed;
    or for ``steps`` plain steps).

    The walk goes in blocks of ``EVERY`` steps.  A row of the walk is an edge, or
    a host's own row, which hands on its earlier ranks and its restart; so a step
    is one join and one sum.  After a block the mixture of its ranks whose next
    step would be smallest goes on (``mixture``, from a table of EVERY x EVERY
    sums); where that is not positive, the host's plain rank does."""
    both = edges.withColumn("kind", F.lit("trust")).union(edges.select("dst", "src", F.lit("distrust")))
    nodes = both.select("src", "kind", F.lit(1).alias("n"), F.lit(0.0).alias("r")).union(both.select("dst", "kind", F.lit(0), F.lit(0.0)))
    nodes = nodes.union(seeds.select("host", "kind", F.lit(0), (1 - damping) * F.col("mass"))).groupBy("src", "kind").agg(F.sum("n").alias("n"), F.sum("r").alias("restart"))
    own = nodes.select("src", F.col("src").alias("dst"), "kind", F.lit(None).cast("double").alias("w"), "restart")
    walk = both.join(nodes.drop("restart"), ["src", "kind"]).select("src", "dst", "kind", (F.lit(damping) / F.col("n")).alias("w"), F.lit(0.0).alias("restart"))
    walk = cut(walk.union(own).repartition("src", "kind"))
    rank = kept = cut(seeds.select("host", "kind", F.col("mass").alias("r")))
    every = rank.agg(F.sum("r")).first()[0] or 0.0
    done = 0
    while steps is None or done < steps:
        size = EVERY if steps is None else min(EVERY, steps - done)
        block = rank.withColumnRenamed("r", "x0")
        for i in range(1, size + 1):
            earlier = [F.when(F.col("w").isNull(), F.col(f"x{j}")).alias(f"x{j}") for j in range(i)]
            moved = F.when(F.col("w").isNull(), F.col("restart")).otherwise(F.coalesce(f"x{i - 1}", F.lit(0.0)) * F.col("w"))
            moved = walk.join(block.withColumnRenamed("host", "src"), ["src", "kind"]).select(F.col("dst").alias("host"), "kind", *earlier, moved.alias(f"x{i}"))
            block = moved.groupBy("host", "kind").agg(*(F.sum(f"x{j}").alias(f"x{j}") for j in range(i + 1)))
        block = cut(block)
        drop(kept)
        done += size
        x = [F.coalesce(f"x{i}", F.lit(0.0)) for i in range(size + 1)]
        if steps is not None:
            rank, kept = block.select("host", "kind", x[size].alias("r")), block
            continue
        d = [b - a for a, b in zip(x, x[1:])]
        pairs = [(i, j) for i in range(size) for j in range(i + 1)]
        sums = {r["kind"]: r for r in block.groupBy("kind").agg(F.count(F.when(F.col("x0").isNull(), 1)).alias("new"), *(F.sum(d[i] * d[j]).alias(f"g{i}_{j}") for i, j in pairs)).collect()}
        mixed, step = F.lit(0.0), F.lit(0.0)
        for kind, r in sums.items():
            gram = np.zeros((size, size))
            for i, j in pairs:
                gram[i, j] = gram[j, i] = r[f"g{i}_{j}"]
            weights = [F.lit(float(v)) for v in mixture(gram)]
            mixed = F.when(F.col("kind") == kind, sum((v * y for v, y in zip(weights, x[1:])), F.lit(0.0))).otherwise(mixed)
            step = F.when(F.col("kind") == kind, sum((v * y for v, y in zip(weights, d)), F.lit(0.0))).otherwise(step)
        plain = F.when(mixed > 0, 0.0).otherwise(F.abs(mixed - x[size]))
        kept = cut(block.select("host", "kind", F.when(mixed > 0, mixed).otherwise(x[size]).alias("r"), (F.abs(step) + 2 * plain).alias("left")))
        drop(block)
        left = kept.agg(F.sum("left")).first()[0] or 0.0
        rank = kept.drop("left")
        if not any(r["new"] for r in sums.values()) and left <= TOLERANCE * (1 - damping) * every:
            break
    part = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("r"))), F.lit(0.0)).alias(kind)
    return rank.groupBy("host").agg(part("trust"), part("distrust"))


def judge(pages: DataFrame, rules: DataFrame, *, id_col: str = "page_id", url: str = "url", html: str = "html", threshold: float = 0.6, steps: int | None = None) -> DataFrame:
    """Per row: page_id, host, path, rule, verdict, trust and distrust, walked
    until the evidence converges (or for ``steps`` steps)."""
    host, path = host_and_path(F.col(url))
    urls = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"), F.col(html).alias("_html"))
    ruled = cut(with_rule(urls.drop("_html"), rules))
    mass = ruled.filter("ruled is not null and host != ''").groupBy("host", F.when(F.col("ruled") == "allow", "trust").otherwise("distrust").alias("kind")).agg(F.count("*").cast("double").alias("mass"))
    ranks = propagate(host_edges(urls, "_html"), cut(mass), steps=steps)
    out = ruled.join(ranks, "host", "left").withColumn("_t", F.coalesce("trust", F.lit(0.0))).withColumn("_d", F.coalesce("distrust", F.lit(0.0)))
    method = F.when(F.col("_d") > threshold * (F.col("_t") + F.col("_d")), "block").otherwise("allow")
    out = out.withColumn("trust", F.round("_t", 9)).withColumn("distrust", F.round("_d", 9))
    return out.select("page_id", "host", "path", "rule", F.coalesce("ruled", method).alias("verdict"), "trust", "distrust")
