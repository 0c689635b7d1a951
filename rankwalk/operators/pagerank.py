"""PageRank with teleportation, dangling-mass redistribution and link
multiplicity, as an iterated DataFrame job.

Update rule (every node, sinks included)::

    p'(v) = alpha / N + (1 - alpha) * (m / N + sum_{u -> v} p(u) / deg(u) * cnt(u,v))

where ``m`` is the total rank held by dangling nodes *before* the step and
``deg(u)`` is u's out-degree counted with multiplicity.

Physical shape (asserted on the plan in ``tests/test_pagerank.py``):

* The edge source is evaluated once, into a written table from which three
  persisted tables are built (and a lost block is computed again):
  ``vertices`` (id, dangling, nsalt, out_degree) and ``links`` (src, dst,
  cnt), both hash-partitioned on the node id with the same partition count,
  and ``hub_links`` (src, salt, dst, cnt) for the few sources with more than
  ``salt_chunk`` targets, spread over (src, salt) buckets.  A hub holding a
  third of all links is thereby split over many tasks; the number of hubs is
  at most E / salt_chunk, and their table of salts is broadcast only after a
  count proves it small.
* The rank state (vertex columns + rank) keeps the vertex partitioning from
  step to step.  One step then moves exactly one data set: the per-target
  partial sums (combined map-side) to ``dst``.  The state meets ``links``
  co-partitioned (no exchange on either side; the edges stream through a hash
  table of the ranks), and the new state is the vertex table joined with the
  sums without re-shuffling the vertices.  Only hub ranks are replicated per
  salt and shuffled to their buckets.
* ``m`` is a scalar subquery and ``N`` one count: no cross join and no
  per-node driver work.
* The loop's partition count P follows the data (about 1M links per task,
  at least the cluster's default parallelism), not a session default, and
  every exchange of a step is planned with that P.
* Lineage is cut after every step with a reliable ``checkpoint()`` in the
  session's ``spark.checkpoint.dir``; a lost executor costs at most one step.
  The cut is planned statically (AQE off for that one action) because only a
  static plan reports the hash partitioning that the checkpoint then keeps;
  AQE has nothing to re-plan in a loop whose layout is fixed up front.
* Disk does not grow with the steps: a step's shuffle goes when its checkpoint
  is written, and the shuffles that made the edges when these are.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .graph import HUB_BROADCAST_MAX, SALT_CHUNK, Graph, out_degree, written
from ..session import FREED_CONF, drop_path, ensure_checkpoint_dir, scratch_path, session_conf

DEFAULT_SALT_CHUNK = SALT_CHUNK     # target links per (hub, salt) bucket
EDGES_PER_PARTITION = 1_000_000     # sizing of the loop's fixed partitioning
READ_BYTES = 16 << 20               # of the written edges that a task reads: about as many links


@dataclass
class PreparedGraph:
    """Loop-invariant tables, computed once before the iterations."""
    links: DataFrame              # src, dst, cnt            partitioned by src
    hub_links: DataFrame | None   # src, salt, dst, cnt      partitioned by (src, salt)
    vertices: DataFrame           # id, dangling, nsalt, out_degree   partitioned by id
    state0: DataFrame             # vertices + rank
    n: int
    partitions: int               # P of every table and exchange of the loop
    n_dangling: int = -1          # -1: unknown
    _persisted: list = field(default_factory=list)
    _folders: list = field(default_factory=list)    # written tables that a lost block is computed from
    views: dict = field(default_factory=dict)   # temp-view names of the step's SQL

    def release(self) -> None:
        spark = self.vertices.sparkSession
        for name in self.views.values():
            spark.catalog.dropTempView(name)
        self.views.clear()
        for df in self._persisted:
            df.unpersist()
        self._persisted.clear()
        for path in self._folders:
            drop_path(spark, path)
        self._folders.clear()

    def view(self, role: str) -> str:
        """Name of the temp view holding ``role`` (links, hub_links, vertices,
        state), unique to this prepared graph."""
        if role not in self.views:
            self.views[role] = f"rankwalk_{role}_{uuid.uuid4().hex[:12]}"
            frame = {"links": self.links, "hub_links": self.hub_links,
                     "vertices": self.vertices}.get(role)
            if frame is not None:
                frame.createOrReplaceTempView(self.views[role])
        return self.views[role]


def loop_partitions(spark: SparkSession, n_edges: int,
                    edges_per_partition: int = EDGES_PER_PARTITION) -> int:
    """Partition count of the loop, sized by the data: about
    ``edges_per_partition`` links per task, and never fewer tasks than the
    cluster's default parallelism."""
    floor = spark.sparkContext.defaultParallelism
    return max(1, floor, -(-n_edges // edges_per_partition))


def prepare(graph: Graph, salt_chunk: int = DEFAULT_SALT_CHUNK,
            initial: str = "uniform", partitions: int | None = None) -> PreparedGraph:
    """Build the static tables and the initial state.

    ``initial``: ``"uniform"`` gives 1/N to every node (the PageRank start),
    ``"one"`` gives 1.0 (the GraphX start).  ``partitions`` overrides the
    data-sized partition count of the loop.
    """
    held: list[DataFrame] = []
    folders: list[str] = []
    try:
        return _prepare(graph, salt_chunk, initial, partitions, held, folders)
    except BaseException:
        for df in held:
            df.unpersist()
        for path in folders:
            drop_path(graph.edges.sparkSession, path)
        raise


def _prepare(graph: Graph, salt_chunk: int, initial: str, partitions: int | None, held: list[DataFrame],
             folders: list[str]) -> PreparedGraph:
    """``held`` gets every frame as it is persisted, ``folders`` what is written."""
    spark = graph.edges.sparkSession
    level = StorageLevel.MEMORY_AND_DISK

    def persisted(df: DataFrame) -> DataFrame:
        held.append(df.persist(level))
        return df
    # One pass over the source writes the edges; its shuffles, and those of the
    # degrees, are gone before the tables of the loop are built.
    edges = graph.edges.select("src", "dst", "cnt")
    if not graph.stored:
        edges = written(edges, "edges", folders)
    with session_conf(spark, {"spark.sql.files.maxPartitionBytes": str(READ_BYTES)}):
        deg = written(out_degree(edges).withColumn("nsalt", F.ceil(F.col("n_targets") / F.lit(salt_chunk)).cast("int")), "degrees", folders)
    stats = deg.agg(F.coalesce(F.sum("n_targets"), F.lit(0)).alias("links"),
                    F.count(F.when(F.col("n_targets") > salt_chunk, 1)).alias("hubs")).first()
    n_hubs = stats["hubs"]
    parts = partitions or loop_partitions(spark, stats["links"])
    # Tables of the loop get their ``parts`` partitions whatever the session's
    # default, so that a task's share stays the same as the graph grows.
    with session_conf(spark, {"spark.sql.shuffle.partitions": str(parts), "spark.sql.adaptive.coalescePartitions.enabled": "false",
                              "spark.sql.files.maxPartitionBytes": str(READ_BYTES)}):
        hub_links = None
        plain = edges
        if n_hubs:
            hubs = deg.where(F.col("n_targets") > salt_chunk).select("src", "nsalt")
            # Beyond the broadcast a written table: Spark then splits a hub's partition.
            hub_side = F.broadcast(hubs) if n_hubs <= HUB_BROADCAST_MAX else written(hubs, "hubs", folders)
            hub_links = persisted(edges.join(hub_side, "src")
                                  .select("src", F.pmod(F.xxhash64("dst"), F.col("nsalt")).cast("int").alias("salt"),
                                          "dst", "cnt")
                                  .repartition(parts, "src", "salt"))
            plain = edges.join(hub_side, "src", "left_anti")
        # Equal targets side by side: a step's map-side sums then meet their
        # group at hand, and the cached column is short.
        links = persisted(plain.select("src", "dst", "cnt").repartition(parts, "src").sortWithinPartitions("dst"))

        # A null id (of links whose end is unknown) is a node without out-links.
        known = lambda c: F.when(F.col("src").isNotNull(), F.col(c)).alias(c)
        none = [F.lit(None).cast(deg.schema[c].dataType).alias(c) for c in ("out_degree", "nsalt")]
        ids = (deg.select(F.col("src").alias("id"), known("out_degree"), known("nsalt"))
               .unionByName(edges.select(F.col("dst").alias("id"), *none)))
        if graph.extra_ids is not None:
            ids = ids.unionByName(graph.extra_ids.select(F.col("id").cast("string").alias("id"), *none))
        vertices = persisted(ids.groupBy("id").agg(F.max("out_degree").alias("out_degree"), F.max("nsalt").alias("nsalt"))
                             .select("id",
                                     F.col("out_degree").isNull().alias("dangling"),
                                     F.coalesce("nsalt", F.lit(1)).alias("nsalt"),
                                     F.coalesce("out_degree", F.lit(0)).cast("double").alias("out_degree"))
                             .repartition(parts, "id"))
        counts = vertices.agg(F.count(F.lit(1)).alias("n"),
                              F.count(F.when(F.col("dangling"), 1)).alias("d")).first()
        n, n_dangling = counts["n"], counts["d"]
        links.count()
        if hub_links is not None:
            hub_links.count()
    start = F.lit(1.0 / n if n else 0.0) if initial == "uniform" else F.lit(1.0)
    state0 = vertices.withColumn("rank", start)
    kept = [links, vertices] + ([hub_links] if hub_links is not None else [])
    return PreparedGraph(links, hub_links, vertices, state0, n, parts, n_dangling, kept, folders)


def double_literal(x: float) -> str:
    """A double literal that round-trips exactly."""
    return f"CAST('{float(x)!r}' AS DOUBLE)"


def _incoming_sql(prepared: PreparedGraph, state_view: str) -> str:
    """(dst, p): rank mass arriving at each node over its in-links.

    Each source sends rank / out_degree per unit of link count.  Ordinary
    sources meet their links co-partitioned (no exchange; the links stream
    through a hash table of the ranks); hub ranks are replicated once per salt
    and shuffled to the hub buckets.  The per-target sum is combined map-side
    before its one shuffle.
    """
    flows = f"""
        SELECT /*+ SHUFFLE_HASH(r) */ l.dst, r.r * l.cnt AS x
        FROM {prepared.view("links")} l
        JOIN (SELECT id AS src, rank / out_degree AS r FROM {state_view} WHERE NOT dangling) r
          ON l.src = r.src"""
    if prepared.hub_links is not None:
        flows += f"""
        UNION ALL
        SELECT /*+ SHUFFLE_HASH(h) */ l.dst, h.r * l.cnt AS x
        FROM {prepared.view("hub_links")} l
        JOIN (SELECT id AS src, explode(sequence(0, nsalt - 1)) AS salt, rank / out_degree AS r
              FROM {state_view} WHERE NOT dangling AND nsalt > 1) h
          ON l.src = h.src AND l.salt = h.salt"""
    return f"SELECT dst, sum(x) AS p FROM ({flows}) f GROUP BY dst"


def _next_state(prepared: PreparedGraph, state: DataFrame, rank_sql) -> DataFrame:
    """The vertex table (partitioned by id) left-joined with the incoming sums
    (partitioned by dst), with the new rank computed by ``rank_sql(state_view)``.

    Written as one SQL statement over temp views: Spark parses and analyses the
    step once, instead of once per DataFrame call (the dominant driver cost of
    a step at small scale)."""
    spark = state.sparkSession
    state_view = prepared.view("state")
    state.createOrReplaceTempView(state_view)
    return spark.sql(f"""
        SELECT /*+ SHUFFLE_HASH(c) */ v.id, v.dangling, v.nsalt, v.out_degree,
               {rank_sql(state_view)} AS rank
        FROM {prepared.view("vertices")} v
        LEFT JOIN ({_incoming_sql(prepared, state_view)}) c ON v.id = c.dst""")


def incoming(state: DataFrame, prepared: PreparedGraph) -> DataFrame:
    """(dst, p) for ``state`` as a DataFrame (see ``_incoming_sql``)."""
    state_view = prepared.view("state")
    state.createOrReplaceTempView(state_view)
    return state.sparkSession.sql(_incoming_sql(prepared, state_view))


def step(state: DataFrame, prepared: PreparedGraph, alpha: float = 0.15,
         redistribute: bool = True, teleport: bool = True) -> DataFrame:
    """One update of the rank vector (lazy).

    ``redistribute`` adds m/N (m = rank held by dangling nodes before the
    step, a scalar subquery); ``teleport`` applies alpha/N + (1-alpha) * (.).
    With both off this is a plain vector x transition-matrix product, which
    leaks the mass of sinks.
    """
    n = max(prepared.n, 1)      # an empty graph has no row to rank

    def rank_sql(state_view: str) -> str:
        p = "coalesce(c.p, 0D)"
        if redistribute and prepared.n_dangling != 0:
            # without dangling nodes m is 0 and its per-step job is skipped
            m = f"(SELECT coalesce(sum(rank) FILTER (WHERE dangling), 0D) FROM {state_view})"
            p = f"({m} / {double_literal(n)} + {p})"
        if teleport:
            p = f"({double_literal(alpha / n)} + {double_literal(1.0 - alpha)} * {p})"
        return p

    return _next_state(prepared, state, rank_sql)


def _static_planning(spark: SparkSession, partitions: int | None):
    """Plan with AQE off and, if given, ``partitions`` shuffle partitions, so
    every exchange of a step lands on the loop's fixed partitioning."""
    settings = {"spark.sql.adaptive.enabled": "false"}
    if partitions:
        settings["spark.sql.shuffle.partitions"] = str(partitions)
    return session_conf(spark, settings)


def cut_lineage(df: DataFrame, mode: str = "checkpoint", partitions: int | None = None) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and return a frame
    reading it back, so later steps neither carry nor recompute its lineage.

    ``checkpoint``: Spark's reliable checkpoint, planned statically so the
    frame keeps its hash partitioning; ``parquet``: a written table in the same
    folder (partitioning is not kept).  Either way the shuffles that made it are
    freed: a loop holds those of one step, however many it runs.
    """
    spark = df.sparkSession
    if mode == "checkpoint":
        ensure_checkpoint_dir(spark)
        with _static_planning(spark, partitions), session_conf(spark, FREED_CONF):
            return df.select("*").checkpoint(eager=True)
    path = scratch_path(spark, "state")
    with session_conf(spark, FREED_CONF):
        df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def drop_checkpoint(df: DataFrame) -> None:
    """Delete the files of a state that :func:`cut_lineage` checkpointed and
    that nothing reads any more (its successor has been written)."""
    kept = df._jdf.queryExecution().logical().rdd().getCheckpointFile()
    if kept.isDefined():
        drop_path(df.sparkSession, kept.get())


def materialize(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Persist ``df`` (memory, spilling to disk) and compute it now, planned
    like a checkpoint so its hash partitioning is kept.  Lost blocks are
    recomputed from lineage, which reaches back only to the last checkpoint."""
    with _static_planning(df.sparkSession, partitions):
        kept = df.persist(StorageLevel.MEMORY_AND_DISK)
        kept.count()
    return kept


def iterate(prepared: PreparedGraph, max_iter: int, alpha: float = 0.15,
            redistribute: bool = True, teleport: bool = True,
            tol: float | None = None, keep_states: bool = False,
            checkpoint_every: int = 1, deltas: list | None = None, each=None):
    """Run ``max_iter`` steps (or fewer once the largest change drops below
    ``tol``).  Returns the final state, and the list of all states when
    ``keep_states`` is set (for per-step metrics).

    Every ``checkpoint_every``-th state (and the last) is a reliable
    checkpoint; the states in between are persisted.  Once the next checkpoint
    is written they are released and the checkpoint before it is deleted, so at
    most two are held (all of them with ``keep_states``) and a lost executor
    recomputes at most ``checkpoint_every`` steps.  With ``tol`` the largest
    change of every step is appended to ``deltas``.  ``each(i, state, before)``
    is called for every state while it and the one before it (None for the
    first) exist, so per-step metrics need no kept states.
    """
    parts = prepared.partitions
    every = max(1, checkpoint_every)
    state = cut_lineage(prepared.state0, partitions=parts)
    states = [state] if keep_states else []
    if each is not None:
        each(0, state, None)
    written, persisted = state, []              # the last checkpoint, and what was persisted since
    try:
        for i in range(1, max_iter + 1):
            nxt = step(state, prepared, alpha, redistribute, teleport)
            cut = every == 1 or i % every == 0 or i == max_iter
            new = cut_lineage(nxt, partitions=parts) if cut else materialize(nxt, partitions=parts)
            if not cut:
                persisted.append(new)
            delta = None
            if tol is not None:
                delta = (new.join(state.select("id", F.col("rank").alias("_old")), "id")
                            .agg(F.max(F.abs(F.col("rank") - F.col("_old")))).first()[0])
                if deltas is not None:
                    deltas.append(delta)
            if each is not None:
                each(i, new, state)
            stop = tol is not None and (delta is None or delta < tol)
            if stop and not cut:
                new, cut = cut_lineage(new, partitions=parts), True
            if cut and not keep_states:
                # Nothing reads what lies before the new checkpoint any more.
                drop_checkpoint(written)
                for df in persisted:
                    df.unpersist()
                persisted.clear()
            written = new if cut else written
            state = new
            if keep_states:
                states.append(state)
            if stop:
                break
    except BaseException:
        for df in persisted:
            df.unpersist()
        raise
    return (state, states) if keep_states else state


def pagerank(graph: Graph, alpha: float = 0.15, max_iter: int = 10, tol: float | None = None,
             salt_chunk: int = DEFAULT_SALT_CHUNK, partitions: int | None = None,
             checkpoint_every: int = 1) -> DataFrame:
    """(id, rank) after ``max_iter`` PageRank steps; ranks sum to 1."""
    prepared = prepare(graph, salt_chunk, partitions=partitions)
    if prepared.n == 0:
        prepared.release()
        return graph.vertices.select("id", F.lit(0.0).alias("rank"))
    try:
        final = iterate(prepared, max_iter, alpha, tol=tol, checkpoint_every=checkpoint_every)
    finally:
        prepared.release()
    return final.select("id", "rank")


def pagerank_metrics(graph: Graph, alpha: float = 0.15, max_iter: int = 10,
                     salt_chunk: int = DEFAULT_SALT_CHUNK,
                     redistribute: bool = True, teleport: bool = True) -> DataFrame:
    """(step, dangling_mass, total_mass, max_delta) for states 0..max_iter.

    The metrics of a step are gathered while its state and the one before it
    exist (one row a step), so the loop never holds more than two states.
    ``max_delta`` joins them on ``id``, by which both are partitioned.
    """
    rows: list = []

    def gather(i: int, s: DataFrame, before: DataFrame | None) -> None:
        change = F.lit(None).cast("double")
        if before is not None:
            prev = before.select("id", F.col("rank").alias("_old"))
            change = s.join(prev, "id").agg(F.max(F.abs(F.col("rank") - F.col("_old")))).scalar()
        masses = s.agg(F.coalesce(F.sum(F.when(F.col("dangling"), F.col("rank"))), F.lit(0.0)).alias("dangling_mass"),
                       F.coalesce(F.sum("rank"), F.lit(0.0)).alias("total_mass"))
        rows.append((i, *masses.withColumn("max_delta", change).first()))

    prepared = prepare(graph, salt_chunk)
    try:
        drop_checkpoint(iterate(prepared, max_iter, alpha, redistribute, teleport, each=gather))
    finally:
        prepared.release()
    return graph.edges.sparkSession.createDataFrame(rows, "step int, dangling_mass double, total_mass double, max_delta double")


def pagerank_convergence(graph: Graph, alpha: float = 0.15, tol: float = 1e-6, max_iter: int = 100,
                         salt_chunk: int = DEFAULT_SALT_CHUNK) -> DataFrame:
    """(step, max_delta, stopped) of every step until the largest change of a
    rank is below ``tol`` (stopped) or ``max_iter`` steps are done: one row a
    step, gathered while the loop runs."""
    deltas: list = []
    prepared = prepare(graph, salt_chunk)
    try:
        if prepared.n:
            drop_checkpoint(iterate(prepared, max_iter, alpha, tol=tol, deltas=deltas))
    finally:
        prepared.release()
    rows = [(i, d, d < tol) for i, d in enumerate(deltas, 1)]
    return graph.edges.sparkSession.createDataFrame(rows, "step int, max_delta double, stopped boolean")


def pagerank_graphx(graph: Graph, reset_probability: float = 0.15, max_iter: int = 10,
                    salt_chunk: int = DEFAULT_SALT_CHUNK) -> DataFrame:
    """(id, pagerank) under the GraphX/GraphFrames static convention.

    Ranks start at 1.0, each step is ``reset + (1 - reset) * incoming`` with
    no dangling redistribution, and the final vector is rescaled to sum to N.
    Link multiplicity weighs like parallel edges (cnt / out_degree).
    """
    prepared = prepare(graph, salt_chunk, initial="one")
    if prepared.n == 0:
        prepared.release()
        return graph.vertices.select("id", F.lit(0.0).alias("pagerank"))
    parts = prepared.partitions

    def rank_sql(_view: str) -> str:
        return (f"({double_literal(reset_probability)} + {double_literal(1.0 - reset_probability)}"
                f" * coalesce(c.p, 0D))")

    try:
        state = cut_lineage(prepared.state0, partitions=parts)
        for _ in range(max_iter):
            before, state = state, cut_lineage(_next_state(prepared, state, rank_sql), partitions=parts)
            drop_checkpoint(before)
    finally:
        prepared.release()
    correction = F.lit(float(prepared.n)) / state.agg(F.sum("rank")).scalar()
    return state.select("id", (F.col("rank") * correction).alias("pagerank"))
