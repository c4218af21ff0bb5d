"""Exact TTL anchoring for hot cache keys, in parallel (K2 at scale).

Greedy anchoring (a miss at ``t`` serves every request of its key before
``t + TTL``) looks sequential.  Cut each key's timeline into TTL-long chunks
``c = floor(t / TTL)``:

* a chunk holds at most one anchor (two anchors are at least TTL apart);
* the anchor of a chunk depends only on the anchor of the previous non-empty
  chunk: if the chunks are adjacent it is the first request at or after
  ``prev + TTL`` (or none), otherwise the first request of the chunk
  (the previous anchor has expired); after a chunk without an anchor the
  next chunk's first request is an anchor.

So "next anchor" is a function from the nodes of chunk ``k`` (its requests,
plus one NONE node) to the nodes of chunk ``k + 1``: a functional graph whose
edges advance exactly one chunk.  The anchors are the orbit of the first
request.  Pointer doubling finds it in ``ceil(log2 K)`` rounds of equi-joins
(``K`` = chunks of the longest key), each round written to the shared
checkpoint folder; every round is partitioned by (key, chunk, request), so a
key holding a third of all requests is spread over the whole cluster.

The successor of a request is an as-of lookup inside the next chunk (a window
partitioned by (key, chunk), i.e. at most one TTL of one key per partition).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickscope.session import cut_lineage

NONE_RID = -(2 ** 63)        # the "no anchor in this chunk" node of a chunk
SEED_RID = -(2 ** 63) + 1    # an existing cache entry (sorts before requests)


def anchor_parallel(req: DataFrame, ttl_us: int) -> DataFrame:
    """``req``: (request_id, cache_key, t_us, is_seed) where a key's seed, if
    any, is not later than its first request.  Returns the fold's columns
    (request_id, cache_key, t_us, cached, anchor_us) for the requests."""
    base = req.select(F.when(F.col("is_seed"), F.lit(SEED_RID)).otherwise(F.col("request_id"))
                      .alias("rid"), "cache_key", "t_us", "is_seed",
                      F.floor(F.col("t_us") / ttl_us).alias("chunk"))
    # dense chunk index per key: one row per non-empty (key, chunk) -- bounded
    # by the time span / TTL, not by the number of requests
    wk = Window.partitionBy("cache_key").orderBy("chunk")
    chunks = (base.select("cache_key", "chunk").distinct()
              .withColumn("k", F.row_number().over(wk) - 1)
              .withColumn("adjacent_next", F.lead("chunk").over(wk) == F.col("chunk") + 1)
              .withColumn("has_next", F.lead("chunk").over(wk).isNotNull()))
    chunks = cut_lineage(chunks, "cache-chunks")
    nodes = base.join(chunks, ["cache_key", "chunk"])
    nodes = cut_lineage(nodes, "cache-nodes")
    first = (nodes.groupBy("cache_key", "k")
             .agg(F.min(F.struct("t_us", "rid")).alias("f"))
             .select("cache_key", "k", F.col("f.rid").alias("first_rid")))

    # successor of a request in chunk k with an adjacent next chunk: first
    # request of chunk k+1 at or after t + TTL (probes sort before requests)
    probes = (nodes.filter(F.col("adjacent_next"))
              .select("cache_key", (F.col("k") + 1).alias("k"), (F.col("t_us") + ttl_us).alias("t"),
                      F.lit(0).alias("m"), F.col("rid").alias("from_rid"),
                      F.lit(None).cast("long").alias("real_rid")))
    reals = nodes.select("cache_key", "k", F.col("t_us").alias("t"), F.lit(1).alias("m"),
                         F.lit(None).cast("long").alias("from_rid"), F.col("rid").alias("real_rid"))
    wnext = (Window.partitionBy("cache_key", "k").orderBy("t", "m", "real_rid")
             .rowsBetween(Window.currentRow, Window.unboundedFollowing))
    asof = (probes.unionByName(reals)
            .withColumn("nxt", F.first("real_rid", ignorenulls=True).over(wnext))
            .filter(F.col("m") == 0)
            .select("cache_key", (F.col("k") - 1).alias("k"), F.col("from_rid").alias("rid"),
                    F.coalesce("nxt", F.lit(NONE_RID)).alias("to")))
    # other edges: request of a chunk whose next chunk is not adjacent, and
    # every NONE node, go to the first request of the next chunk
    nxt_first = first.select("cache_key", (F.col("k") - 1).alias("k"), F.col("first_rid").alias("to"))
    gap_edges = (nodes.filter(F.col("has_next") & ~F.col("adjacent_next"))
                 .select("cache_key", "k", "rid").join(nxt_first, ["cache_key", "k"]))
    none_edges = (chunks.filter(F.col("has_next") & (F.col("k") >= 1))
                  .select("cache_key", "k", F.lit(NONE_RID).alias("rid"))
                  .join(nxt_first, ["cache_key", "k"]))
    jump = cut_lineage(asof.unionByName(gap_edges).unionByName(none_edges), "cache-jump-0")

    n_chunks = chunks.agg(F.max("k")).first()[0]
    rounds = max(0, math.ceil(math.log2(n_chunks + 1))) if n_chunks is not None else 0
    orbit = first.filter(F.col("k") == 0).select("cache_key", "k", F.col("first_rid").alias("rid"))
    step = 1
    for i in range(rounds):
        ext = (orbit.join(jump, ["cache_key", "k", "rid"])
               .select("cache_key", (F.col("k") + step).alias("k"), F.col("to").alias("rid")))
        orbit = cut_lineage(orbit.unionByName(ext), f"cache-orbit-{i}")
        if i + 1 < rounds:
            # J_{i+1}(k, rid) = J_i(k + 2^i, J_i(k, rid))
            j2 = jump.select(F.col("cache_key").alias("ck2"), F.col("k").alias("k2"),
                             F.col("rid").alias("mid"), F.col("to").alias("to2"))
            jump = cut_lineage(
                jump.join(j2, (F.col("cache_key") == F.col("ck2"))
                          & (F.col("k") + step == F.col("k2")) & (F.col("to") == F.col("mid")))
                .select("cache_key", "k", "rid", F.col("to2").alias("to")),
                f"cache-jump-{i + 1}")
        step *= 2

    anchors = (orbit.filter(F.col("rid") != NONE_RID)
               .join(nodes.select("cache_key", "k", "rid", "t_us"), ["cache_key", "k", "rid"])
               .select("cache_key", "k", F.col("rid").alias("a_rid"), F.col("t_us").alias("a_t")))
    own = anchors
    prev = anchors.select("cache_key", (F.col("k") + 1).alias("k"), F.col("a_rid").alias("p_rid"),
                          F.col("a_t").alias("p_t"))
    r = (nodes.filter(~F.col("is_seed")).join(own, ["cache_key", "k"], "left")
         .join(prev, ["cache_key", "k"], "left"))
    on_own = F.col("a_t").isNotNull() & (
        (F.col("t_us") > F.col("a_t")) | ((F.col("t_us") == F.col("a_t")) & (F.col("rid") >= F.col("a_rid"))))
    return r.select(F.col("rid").alias("request_id"), "cache_key", "t_us",
                    F.when(on_own, F.col("rid") != F.col("a_rid")).otherwise(F.lit(True)).alias("cached"),
                    F.when(on_own, F.col("a_t")).otherwise(F.col("p_t")).alias("anchor_us"))
