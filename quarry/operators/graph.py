"""Link-graph operators and the two PageRank variants.

Plan shape per iteration (both variants):

* the input is read once; the weighted edge table ``(src, salt, dst, w)`` --
  ``w`` is the share of the source's rank that one edge carries -- is built
  from it, hash-partitioned on ``(src, salt)`` and checkpointed into the shared
  checkpoint folder; a source with more edges than a partition should hold is
  spread over as many salts as they fill;
* the rank rows of sources are sent to the edges' partitioning (one row per
  source, copied once per salt for the few hot ones); the edge table itself is
  scanned in place, never shuffled again;
* contributions are summed per ``dst`` with a partial aggregate (a node with
  a third of all in-links costs one row per map partition in the shuffle),
  which leaves the result hash-partitioned on the node id, like the node and
  rank tables, so the next rank vector is built without another shuffle;
* the redistributed share ``L/N`` reaches a node as ``L/N * in_w`` with the
  static in-edge weight ``in_w``, so only nodes holding a rank are sent;
* the new rank vector is checkpointed (reliable, not local), which cuts the
  lineage and survives executor loss; the dangling mass is a one-row
  aggregate over the checkpoint, handed to the next step as a literal.

Per iteration only rank-sized rows and partially aggregated contributions
move; the edges are read once and stay where they are.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators.joins import skew_safe_join
from quarry.session import checkpoint_dir, parallelism, scratch_path

# Fixed values of the reference's PageRank: damping factor and iteration count.
DAMPING = 0.85
ITERATIONS = 20
TOP_K = 11


def parse_edge_lines(lines: DataFrame, comment_rule: str = "startswith", line_col: str = "value") -> DataFrame:
    """S13 + P3: ``src<TAB>dst`` lines -> (src, dst) BIGINT; comments dropped.

    ``comment_rule='startswith'`` drops lines beginning with ``#`` (chained-job form);
    ``'contains'`` drops any line containing ``#`` (RDD form).  Unparsable lines are dropped
    (count them with :func:`edge_line_counts`).
    """
    return _edge_fields(lines, comment_rule, line_col).filter("not comment and ok").select("src", "dst")


def edge_line_counts(lines: DataFrame, comment_rule: str = "startswith", line_col: str = "value") -> DataFrame:
    """One row (lines, comment_lines, rejected_lines) for :func:`parse_edge_lines`."""
    return _edge_fields(lines, comment_rule, line_col).agg(
        F.count(F.lit(1)).alias("lines"), F.count_if(F.col("comment")).alias("comment_lines"),
        F.count_if(~F.col("comment") & ~F.col("ok")).alias("rejected_lines"))


def _edge_fields(lines: DataFrame, comment_rule: str, line_col: str) -> DataFrame:
    v = F.col(line_col)
    comment = v.startswith("#") if comment_rule == "startswith" else v.contains("#")
    parts = F.split(v, r"\t")
    out = lines.select(comment.alias("comment"), F.trim(parts[0]).try_cast("long").alias("src"),
                       F.trim(F.try_element_at(parts, F.lit(2))).try_cast("long").alias("dst"))
    return out.withColumn("ok", F.col("src").isNotNull() & F.col("dst").isNotNull())


def edges_distinct(edges: DataFrame) -> DataFrame:
    """A10 + U1: duplicate edges collapsed -> (src, dst)."""
    return edges.select("src", "dst").distinct()


def _ends(edges: DataFrame) -> DataFrame:
    """(id, out): both ends of every edge in one pass, and whether a node has out-links (partial aggregate)."""
    both = F.array(F.struct(F.col("src").alias("id"), F.lit(True).alias("out")),
                   F.struct(F.col("dst").alias("id"), F.lit(False).alias("out")))
    return edges.select(F.explode(both).alias("e")).select("e.*").groupBy("id").agg(F.max("out").alias("out"))


def graph_nodes(edges: DataFrame) -> DataFrame:
    """Every node that appears as a source or a target -> (id)."""
    return _ends(edges).select("id")


def dangling_nodes(edges: DataFrame) -> DataFrame:
    """A14 (structure): nodes without out-links -> (id)."""
    return _ends(edges).filter(~F.col("out")).select("id")


def adjacency(edges: DataFrame) -> DataFrame:
    """A11 in relational form: edge multiplicity and out-degree -> (src, dst, mult, outdeg).

    The reference's nested list per source is kept as rows: a source with a
    third of all edges never becomes a single array.
    """
    m = edges.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("mult"))
    deg = m.groupBy("src").agg(F.sum("mult").alias("outdeg"))
    return skew_safe_join(m, deg, "src", "inner").select("src", "dst", "mult", "outdeg")


@dataclass
class PageRankResult:
    ranks: DataFrame       # (id, pr): final score including the redistributed mass
    leaked: float          # dangling mass L_n of the last iteration
    n_nodes: float


KEPT_SETTINGS = ("spark.sql.session.timeZone", "spark.sql.ansi.enabled", "spark.sql.autoBroadcastJoinThreshold",
                 "spark.sql.files.maxPartitionBytes")


def _own_session(spark):
    """A session for the iteration's plans: adaptive execution off, so that a written RDD keeps its
    hash partitioning (an adaptive plan reports an unknown one and later joins would shuffle the
    checkpoint).  The caller's session, and queries on its other threads, keep their settings."""
    own = spark.newSession()
    for k in KEPT_SETTINGS:
        if (v := spark.conf.get(k, None)) is not None:
            own.conf.set(k, v)
    own.conf.set("spark.sql.adaptive.enabled", "false")
    return own


def _checkpointed(df: DataFrame, parts: int, *keys: str) -> DataFrame:
    """Reliable checkpoint, hash-partitioned on ``keys`` (the partitioning is kept by the
    checkpoint, so later joins on ``keys`` need no exchange on this side)."""
    return df.repartition(parts, *keys).checkpoint()


def _persisted(df: DataFrame, parts: int, *keys: str) -> DataFrame:
    """Like :func:`_checkpointed` but kept in executor memory/disk (materialized now).
    Lost blocks are recomputed from the lineage back to the last checkpoint."""
    from pyspark import StorageLevel

    out = df.repartition(parts, *keys).persist(StorageLevel.MEMORY_AND_DISK)
    out.count()
    return out


def _weighted_edges(edges: DataFrame, multi: bool, partitions: int | None, rows_per_partition: int):
    """-> (w, deg, hot, parts): salted weighted edges (src, salt, dst, w) hash-partitioned on
    (src, salt) into ``parts`` partitions and checkpointed; out-degrees (src, outdeg, n_rows);
    the hot sources (src, salts), those of more than ``rows_per_partition`` rows.
    ``parts`` is ``partitions`` or sized from the edge count (``rows_per_partition`` each,
    at least the cluster's parallelism).

    The input is evaluated once: its edges are grouped and written to the shared folder,
    and everything else starts from that table, in a session of its own.

    ``w`` = multiplicity / out-degree (multi) or 1 / distinct out-degree (set).  A hot source
    is dealt by a hash of ``dst`` into as many salts as its rows fill partitions, whatever
    the cluster's size; its degree row is copied once per salt.  There are fewer hot sources
    than ``parts``, so their list may be broadcast.
    """
    spark = edges.sparkSession
    if multi:
        grouped = edges.groupBy("src", "dst").agg(F.count(F.lit(1)).cast("double").alias("mult"))
    else:
        grouped = edges.select("src", "dst").distinct().withColumn("mult", F.lit(1.0))
    path = scratch_path(spark, "edges")
    grouped.write.parquet(path)
    own = _own_session(spark)
    m = own.read.schema(grouped.schema).parquet(path)
    total = m.count()
    parts = partitions or max(parallelism(spark), -(-total // rows_per_partition))
    own.conf.set("spark.sql.shuffle.partitions", str(parts))
    deg = m.groupBy("src").agg(F.sum("mult").alias("outdeg"), F.count(F.lit(1)).alias("n_rows")).checkpoint()
    # fresh attribute ids: the checkpoint carries the ids of ``m``, which it is joined back to
    degf = deg.select(*[F.col(c).alias(c) for c in deg.columns])
    hot = (degf.filter(F.col("n_rows") > rows_per_partition)
           .select(F.col("src").alias("src"), F.ceil(F.col("n_rows") / rows_per_partition).cast("int").alias("salts"))
           .checkpoint())
    hot_b = F.broadcast(hot)
    ms = (m.join(hot_b, "src", "left")
          .withColumn("salt", F.pmod(F.xxhash64("dst"), F.coalesce("salts", F.lit(1))).cast("int")))
    ds = degf.join(hot_b, "src", "left").withColumn("salt", F.explode(_salts(F.coalesce("salts", F.lit(1)))))
    w = (ms.join(ds.select("src", "salt", "outdeg"), ["src", "salt"])
         .select("src", "salt", "dst", (F.col("mult") / F.col("outdeg")).alias("w")))
    return _checkpointed(w, parts, "src", "salt"), deg, hot, parts


def _salts(n):
    return F.sequence(F.lit(0), n - 1)


def pagerank(edges: DataFrame, iterations: int = ITERATIONS, damping: float = DAMPING,
             n_nodes: float | None = None, variant: str = "set", dangling: str = "redistribute",
             digits: int | None = None, partitions: int | None = None, rows_per_partition: int = 4_000_000,
             checkpoint_every: int = 1, state: str | None = None) -> PageRankResult:
    """PageRank with the dangling mass added back after damping (undamped, as the reference does).

    ``variant='multi'`` (X9, chained-job semantics): duplicate edges count;
    only sources have a rank at step 0; a node keeps a row once it has one.
    ``variant='set'`` (X10, RDD semantics): edges collapsed; every node starts
    with ``1/N``; a node without in-links drops out after step 1 and then only
    passes on ``L/N``.  ``dangling='ignore'`` reproduces the as-written RDD job
    whose dangling mass is always 0 (D3).

    ``n_nodes`` defaults to the number of distinct nodes.  Scores are
    ``pr + L/N`` of the last step, optionally rounded to ``digits``.
    The iteration runs on ``partitions`` hash partitions, by default one per
    ``rows_per_partition`` edge rows (at least the cluster's parallelism); a source
    of more edges than that is split over as many partitions as they fill.
    Every ``checkpoint_every``-th rank vector (and the last) is a reliable
    checkpoint; the ones between are persisted, so a lost executor costs at
    most that many iterations of recomputation and the shared store sees
    1/``checkpoint_every`` of the writes.  The default (every iteration) was
    faster in local measurements; raise it where writes to the shared store
    dominate.

    ``state``: a shared folder that keeps the rank vector of every checkpointed step, published
    with its number and dangling mass in one atomic write.  A run that finds a step there goes
    on after it (with the same edges; other parameters than the number of iterations must be
    the same), so a driver that died costs the steps since then and the set-up.
    """
    spark = edges.sparkSession
    checkpoint_dir(spark)
    multi = variant == "multi"
    redistribute = dangling == "redistribute"
    e = edges.select(F.col("src").cast("long"), F.col("dst").cast("long"))

    w, deg, hot, parts = _weighted_edges(e, multi, partitions, rows_per_partition)
    # Node rows carry their flags (has out-links, parts of a hot source) and in_w = sum of the
    # weights of their in-edges.  Every node with out-links sends each step (its rank, or 0, plus
    # L/N), so the L/N part of what a node receives is (L/N) * in_w: static, computed once.  Every
    # node is a source or a target, so the two sides together are all nodes.
    in_w = w.groupBy("dst").agg(F.sum("w").alias("in_w")).select(F.col("dst").alias("id"), "in_w")
    out = deg.select(F.col("src").alias("id"), F.lit(True).alias("has_out"))
    nodes = (in_w.join(out, "id", "full_outer")
             .join(F.broadcast(hot.select(F.col("src").alias("id"), "salts")), "id", "left")
             .select("id", F.coalesce("has_out", F.lit(False)).alias("has_out"),
                     F.coalesce("salts", F.lit(1)).alias("salts"),
                     F.col("in_w").isNotNull().alias("has_in"),
                     F.coalesce("in_w", F.lit(0.0)).alias("in_w")))
    nodes = _checkpointed(nodes, parts, "id")
    counts = nodes.agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("has_out")).alias("d")).first()
    n_dangling = int(counts["d"])
    if n_nodes is None:
        n_nodes = float(counts["n"])
    N = float(n_nodes)
    base = (1.0 - damping) / N

    start = nodes.filter("has_out") if multi else nodes
    # a projection of the node checkpoint: same partitioning, nothing to write
    ranks = start.select("id", "has_out", "salts", F.lit(1.0 / N).alias("pr"))
    leaked, done = 0.0, 0
    what = {"variant": variant, "dangling": dangling, "damping": damping, "n_nodes": N}
    if state and (kept := kept_step(state)):
        if kept["what"] != what:
            raise ValueError(f"{state} keeps steps of another run: {kept['what']}, this one is {what}")
        done, leaked = kept["step"], kept["leaked"]
        if done > iterations:
            raise ValueError(f"{state} is at step {done}, beyond {iterations}")
        saved = nodes.sparkSession.read.parquet(f"{state.rstrip('/')}/step-{done}")
        flags = nodes.select(*[F.col(c).alias(c) for c in ("id", "has_out", "salts")])
        ranks = _checkpointed(flags.join(saved, "id").select("id", "has_out", "salts", "pr"), parts, "id")

    transient = None  # the persisted (not checkpointed) rank vector currently cached
    for step in range(done + 1, iterations + 1):
        share = F.lit(leaked / N)
        # senders with a rank row pass it on; the L/N part is added per receiver via in_w
        sent = (ranks.filter("has_out")
                .select(F.col("id").alias("src"), "pr", F.explode(_salts(F.col("salts"))).alias("salt")))
        contrib = (w.join(sent, ["src", "salt"])
                   .groupBy("dst").agg(F.sum(F.col("w") * F.col("pr")).alias("s"))
                   .withColumnRenamed("dst", "id"))
        # nodes, ranks and contrib are all hash-partitioned on the node id: no shuffle here
        j = nodes.join(contrib, "id", "left")
        if not multi:  # only nodes that received something keep a rank
            j = j.filter(F.col("has_in"))
        # multi: rows that existed stay and every target joins; the seeded rows are the sources,
        # and every node is a source or a target, so after any step every node has a row
        received = F.coalesce("s", F.lit(0.0)) + share * F.col("in_w")
        nxt = j.select("id", "has_out", "salts", (F.lit(base) + F.lit(damping) * received).alias("pr"))
        new_leaked = 0.0
        if redistribute:  # sum of cur = pr + L/N over dangling senders, from the checkpoint alone
            row = ranks.filter(~F.col("has_out")).agg(F.sum("pr").alias("s"), F.count(F.lit(1)).alias("n")).first()
            senders = row["n"] if multi else n_dangling
            new_leaked = float(row["s"] or 0.0) + senders * leaked / N
        if step % max(checkpoint_every, 1) == 0 or step == iterations:
            ranks = _checkpointed(nxt, parts, "id")
            fresh = None
            if state:
                _keep_step(state, step, new_leaked, what, ranks)
        else:
            ranks = fresh = _persisted(nxt, parts, "id")
        if transient is not None:
            transient.unpersist()
        transient = fresh
        leaked = new_leaked

    score = F.col("pr") + F.lit(leaked / N)
    if digits is not None:
        score = F.round(score, digits)
    return PageRankResult(ranks.select("id", score.alias("pr")), leaked, N)


def kept_step(state: str) -> dict | None:
    """The last step published in a state folder: ``step``, ``leaked``, ``what`` (the run's parameters)."""
    import json

    from quarry.sources.fsutil import is_file, resolve

    current = f"{state.rstrip('/')}/_CURRENT"
    if not is_file(current):
        return None
    fs, p = resolve(current)
    with fs.open_input_stream(p, compression=None) as f:
        return json.loads(f.read())


def _keep_step(state: str, step: int, leaked: float, what: dict, ranks: DataFrame) -> None:
    """Write a step's ranks, then publish it; the step before the one that it replaces goes."""
    import json

    from quarry.sources.fsutil import list_folders, remove_folder, write_atomic

    base = state.rstrip("/")
    before = kept_step(state)
    ranks.select("id", "pr").write.mode("overwrite").parquet(f"{base}/step-{step}")
    write_atomic(f"{base}/_CURRENT", [json.dumps({"step": step, "leaked": leaked, "what": what}).encode()])
    live = {f"step-{step}", f"step-{before['step']}" if before else ""}
    for folder in list_folders(base, "step-"):
        if folder.rsplit("/", 1)[-1] not in live:
            remove_folder(folder)


def ranked(ranks: DataFrame) -> DataFrame:
    """O1 (D7): total order by rank descending (positive rank), ties by id."""
    return ranks.orderBy(F.desc("pr"), F.asc("id"))


def top_k(ranks: DataFrame, k: int = TOP_K) -> DataFrame:
    """O2: the best ``k`` nodes (per-partition top-k, then one merge of k rows each)."""
    return ranks.orderBy(F.desc("pr"), F.asc("id")).limit(k)
