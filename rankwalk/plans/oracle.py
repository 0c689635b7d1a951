"""Independent ANSI-SQL formulations (run by DuckDB over the same parquet
tables) used as correctness oracles for the registered queries.

They are written from the definitions, not from the Spark plans: iterations
are unrolled into one CTE per step.
"""

from __future__ import annotations

RANK_DIGITS = 10

# ---------------------------------------------------------------- graphs

TRADE_EDGES = """
SELECT src, dst, SUM(cnt) AS cnt FROM (
    SELECT 'C' || CAST(o.o_custkey AS VARCHAR) AS src,
           'P' || CAST(l.l_partkey AS VARCHAR) AS dst, 1 AS cnt
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
    UNION ALL
    SELECT 'P' || CAST(l_partkey AS VARCHAR), 'S' || CAST(l_suppkey AS VARCHAR), 1
    FROM lineitem
) t GROUP BY src, dst HAVING SUM(cnt) > 0
"""

TRADE_NAMES = """
SELECT 'C' || CAST(c_custkey AS VARCHAR) AS id, c_name AS title FROM customer
UNION ALL SELECT 'P' || CAST(p_partkey AS VARCHAR), p_name FROM part
UNION ALL SELECT 'S' || CAST(s_suppkey AS VARCHAR), s_name FROM supplier
"""

SEQ_EDGES = """
SELECT src, dst, COUNT(*) AS cnt FROM (
    SELECT CAST(l_partkey AS VARCHAR) AS src,
           LEAD(CAST(l_partkey AS VARCHAR)) OVER (
               PARTITION BY l_orderkey
               ORDER BY l_linenumber, l_partkey, l_suppkey, CAST(l_partkey AS VARCHAR)) AS dst
    FROM lineitem
) t WHERE dst IS NOT NULL GROUP BY src, dst
"""

WEB_LINKS = """
SELECT CAST(page_id AS VARCHAR) AS src,
       UNNEST(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS dst
FROM pages
"""

WEB_EDGES = f"""
SELECT src, dst, COUNT(*) AS cnt FROM ({WEB_LINKS}) t GROUP BY src, dst
"""

WEB_RECORD_IDS = "SELECT CAST(page_id AS VARCHAR) AS id FROM pages"

STATES_EDGES = """
SELECT src, dst, COUNT(*) AS cnt FROM (
    SELECT event_type AS src,
           LEAD(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id, event_type) AS dst
    FROM events
) t WHERE dst IS NOT NULL GROUP BY src, dst
"""

GRAPHS = {
    "trade": (TRADE_EDGES, None),
    "seq": (SEQ_EDGES, None),
    "web": (WEB_EDGES, WEB_RECORD_IDS),
    "states": (STATES_EDGES, None),
}


# One record per order: its customer and number of line items (0 without any).
ORDER_DEGREES = """SELECT 'C' || o.o_custkey AS id, COUNT(l.l_orderkey) AS out_degree
FROM orders o LEFT JOIN lineitem l ON o.o_orderkey = l.l_orderkey GROUP BY o.o_orderkey, o.o_custkey"""


RELAY_EDGES = f"""
SELECT src, dst, cnt FROM ({SEQ_EDGES}) s QUALIFY ROW_NUMBER() OVER (PARTITION BY src ORDER BY cnt DESC, dst) <= 2
"""

CHAIN_EDGES = f"""
SELECT src, dst, cnt FROM ({RELAY_EDGES}) r
UNION ALL SELECT 'C' || CAST(c_custkey AS VARCHAR), 'N' || CAST(c_nationkey AS VARCHAR), 1 FROM customer
UNION ALL SELECT 'N' || CAST(c_nationkey AS VARCHAR), 'C' || CAST(c_custkey AS VARCHAR), 1 FROM customer
"""

GRAPHS |= {"relay": (RELAY_EDGES, None), "chain": (CHAIN_EDGES, None)}


def graph_ctes(graph: str, binary: bool = False) -> str:
    """CTEs e(src,dst,cnt), v(id), deg(src,deg,n_targets),
    vt(id,dangling,out_degree), w(src,dst,w), n(n) for a named graph.
    ``binary`` counts every link once (0/1 adjacency)."""
    edges, records = GRAPHS[graph]
    if binary:
        edges = f"SELECT DISTINCT src, dst, 1 AS cnt FROM ({edges}) b"
    extra = f" UNION SELECT id FROM ({records}) r" if records else ""
    return f"""
e AS (SELECT src, dst, CAST(cnt AS BIGINT) AS cnt FROM ({edges}) e0),
v AS (SELECT src AS id FROM e UNION SELECT dst FROM e{extra}),
deg AS (SELECT src, CAST(SUM(cnt) AS BIGINT) AS deg, COUNT(*) AS n_targets FROM e GROUP BY src),
vt AS (SELECT v.id, deg.src IS NULL AS dangling,
              CAST(COALESCE(deg.deg, 0) AS BIGINT) AS out_degree
       FROM v LEFT JOIN deg ON v.id = deg.src),
w AS (SELECT e.src, e.dst, CAST(e.cnt AS DOUBLE) / deg.deg AS w,
             CAST(e.cnt AS DOUBLE) AS cnt, CAST(deg.deg AS DOUBLE) AS deg
      FROM e JOIN deg ON e.src = deg.src),
n AS (SELECT CAST(COUNT(*) AS DOUBLE) AS n FROM vt)"""


def rank_steps(steps: int, alpha: float | None = 0.15, redistribute: bool = True,
               start: str = "uniform", graphx: bool = False) -> str:
    """CTEs r0 .. r{steps} (id, dangling, rank), one per step.

    start: uniform (1/N), first (1 on the smallest id) or one (1.0 each).
    graphx: update ``alpha + (1 - alpha) * incoming`` (reset not divided by N).
    """
    init = {"uniform": "1.0 / n.n",
            "first": "CASE WHEN vt.id = (SELECT MIN(id) FROM vt) THEN 1.0 ELSE 0.0 END",
            "one": "1.0"}[start]
    parts = [f"r0 AS MATERIALIZED (SELECT vt.id, vt.dangling, CAST({init} AS DOUBLE) AS rank FROM vt, n)"]
    for k in range(1, steps + 1):
        prev = f"r{k-1}"
        p = "COALESCE(c.p, 0.0)"
        if redistribute:
            p = f"(m.m / n.n + {p})"
        if graphx:
            p = f"(CAST({alpha!r} AS DOUBLE) + CAST({1.0 - alpha!r} AS DOUBLE) * {p})"
        elif alpha is not None:
            p = f"(CAST({alpha!r} AS DOUBLE) / n.n + CAST({1.0 - alpha!r} AS DOUBLE) * {p})"
        parts.append(f"""r{k} AS MATERIALIZED (
    SELECT r.id, r.dangling, {p} AS rank
    FROM {prev} r CROSS JOIN n
    CROSS JOIN (SELECT COALESCE(SUM(rank) FILTER (WHERE dangling), 0.0) AS m FROM {prev}) m
    LEFT JOIN (SELECT w.dst, SUM(x.rank / w.deg * w.cnt) AS p FROM {prev} x JOIN w ON x.id = w.src
               GROUP BY w.dst) c ON r.id = c.dst)""")
    return ",\n".join(parts)


def _r(expr: str, alias: str) -> str:
    return f"ROUND({expr}, {RANK_DIGITS}) AS {alias}"


def pagerank_sql(graph: str, steps: int, alpha: float = 0.15) -> str:
    return f"""WITH {graph_ctes(graph)},
{rank_steps(steps, alpha)}
SELECT id, {_r("rank", "rank")} FROM r{steps}"""


def pagerank_topk_sql(k: int, steps: int, alpha: float = 0.15) -> str:
    return f"""SELECT id, rank FROM ({pagerank_sql("trade", steps, alpha)}) t
ORDER BY rank DESC, id LIMIT {k}"""


def titled_topk_sql(k: int, steps: int, alpha: float = 0.15) -> str:
    return f"""SELECT t.id, nm.title, t.rank
FROM ({pagerank_topk_sql(k, steps, alpha)}) t
JOIN ({TRADE_NAMES}) nm ON t.id = nm.id"""


def ranked_report_sql(k: int, steps: int, alpha: float = 0.15) -> str:
    fmt = "'%f' || chr(9) || '| %10s' || chr(9) || '| %s'"
    return f"""SELECT CAST(ROW_NUMBER() OVER (ORDER BY rank DESC, id) AS INTEGER) AS position,
       printf({fmt}, rank, id, COALESCE(title, '')) AS line
FROM ({titled_topk_sql(k, steps, alpha)}) x"""


def metrics_sql(graph: str, steps: int, alpha: float | None = 0.15, redistribute: bool = True,
                start: str = "uniform", binary: bool = False) -> str:
    """(step, dangling_mass, total_mass) for states 0..steps."""
    rows = " UNION ALL ".join(
        f"SELECT {k} AS step, COALESCE(SUM(rank) FILTER (WHERE dangling), 0.0) AS dangling_mass, "
        f"COALESCE(SUM(rank), 0.0) AS total_mass FROM r{k}" for k in range(steps + 1))
    return f"""WITH {graph_ctes(graph, binary)},
{rank_steps(steps, alpha, redistribute, start)}
{rows}"""


def vector_sql(graph: str, steps: int, start: str, binary: bool = True) -> str:
    """(id, mass) after ``steps`` plain steps x <- x T."""
    return f"""WITH {graph_ctes(graph, binary)},
{rank_steps(steps, None, False, start)}
SELECT id, {_r("rank", "mass")} FROM r{steps}"""


def graphx_sql(graph: str, steps: int, reset: float = 0.15, scale: str = "1.0") -> str:
    """Ranks that sum to ``scale``."""
    return f"""WITH {graph_ctes(graph)},
{rank_steps(steps, reset, False, "one", graphx=True)},
tot AS (SELECT SUM(rank) AS s FROM r{steps})
SELECT id, {_r(f"rank * ({scale} / tot.s)", "pagerank")} FROM r{steps}, n, tot"""


def with_graph(graph: str, body: str, binary: bool = False) -> str:
    return f"WITH {graph_ctes(graph, binary)}\n{body}"


def hops_sql(graph: str) -> str:
    """Breadth-first search: each turn adds the nodes that have no distance yet."""
    return f"""WITH RECURSIVE {graph_ctes(graph)},
bfs(id, hops) USING KEY (id) AS (
  SELECT MIN(id), CAST(0 AS BIGINT) FROM v HAVING MIN(id) IS NOT NULL
  UNION SELECT e.dst, MIN(b.hops) + 1 FROM bfs b JOIN e ON e.src = b.id
  WHERE e.dst NOT IN (SELECT id FROM recurring.bfs) GROUP BY e.dst)
SELECT v.id, bfs.hops FROM v LEFT JOIN bfs ON v.id = bfs.id"""


def paths_sql(graph: str) -> str:
    """Least sums of 1 / cnt: nodes are improved until none can be."""
    return f"""WITH RECURSIVE {graph_ctes(graph)},
paths(id, dist) USING KEY (id) AS (
  SELECT MIN(id), CAST(0 AS DOUBLE) FROM v HAVING MIN(id) IS NOT NULL
  UNION SELECT x.id, x.dist FROM (SELECT e.dst AS id, MIN(p.dist + CAST(1 AS DOUBLE) / e.cnt) AS dist
                                  FROM paths p JOIN e ON e.src = p.id GROUP BY e.dst) x
  LEFT JOIN recurring.paths r ON r.id = x.id WHERE r.id IS NULL OR x.dist < r.dist)
SELECT v.id, {_r("paths.dist", "dist")} FROM v LEFT JOIN paths ON v.id = paths.id"""


def components_sql(graph: str) -> str:
    """CTEs ending in scc (id, component): nodes that reach each other."""
    return f"""{graph_ctes(graph)},
reach AS (SELECT src, dst FROM e UNION SELECT r.src, e.dst FROM reach r JOIN e ON e.src = r.dst),
mutual AS (SELECT a.src AS id, a.dst AS other FROM reach a JOIN reach b ON a.src = b.dst AND a.dst = b.src),
scc AS MATERIALIZED (SELECT v.id, LEAST(v.id, MIN(mutual.other)) AS component FROM v LEFT JOIN mutual ON v.id = mutual.id GROUP BY v.id)"""


def strong_components_sql(graph: str) -> str:
    return f"""WITH RECURSIVE {components_sql(graph)}
SELECT id, component, COUNT(*) OVER (PARTITION BY component) AS size FROM scc"""


def chain_structure_sql(graph: str) -> str:
    return f"""WITH RECURSIVE {components_sql(graph)},
known AS MATERIALIZED (SELECT e.src, e.dst, a.component AS from_c, b.component AS to_c FROM e JOIN scc a ON a.id = e.src JOIN scc b ON b.id = e.dst),
inside AS MATERIALIZED (SELECT src, dst, from_c AS component FROM known WHERE from_c = to_c),
levels(id, level) USING KEY (id) AS (
  SELECT DISTINCT component, CAST(0 AS BIGINT) FROM scc
  UNION SELECT i.dst, MIN(l.level) + 1 FROM levels l JOIN inside i ON i.src = l.id WHERE i.dst NOT IN (SELECT id FROM recurring.levels) GROUP BY i.dst),
differences AS (SELECT DISTINCT component, abs(a.level + 1 - b.level) AS d FROM inside JOIN levels a ON a.id = src JOIN levels b ON b.id = dst),
periods AS (SELECT component, list_reduce(list(d), lambda x, y: gcd(x, y)) AS period FROM differences GROUP BY component)
SELECT scc.component, COUNT(*) AS size, scc.component NOT IN (SELECT from_c FROM known WHERE from_c <> to_c) AS closed,
       CAST(NULLIF(ANY_VALUE(period), 0) AS BIGINT) AS period
FROM scc LEFT JOIN periods ON periods.component = scc.component GROUP BY scc.component"""


def convergence_sql(graph: str, steps: int, alpha: float, tol: float) -> str:
    deltas = " UNION ALL ".join(f"SELECT {k} AS step, MAX(ABS(a.rank - b.rank)) AS max_delta FROM r{k} a JOIN r{k - 1} b ON a.id = b.id"
                                for k in range(1, steps + 1))
    return f"""WITH {graph_ctes(graph)},
{rank_steps(steps, alpha)},
d AS MATERIALIZED ({deltas})
SELECT step, {_r("max_delta", "max_delta")}, max_delta < {tol!r} AS stopped FROM d
WHERE step <= COALESCE((SELECT MIN(step) FROM d WHERE max_delta < {tol!r}), {steps})"""


def _adjacency_list_sql() -> str:
    return with_graph("seq", """
SELECT src AS id, ROW_NUMBER() OVER (PARTITION BY src ORDER BY dst) AS position, dst AS neighbor, cnt AS count FROM e
UNION ALL SELECT id, 0, NULL, NULL FROM vt WHERE dangling""")


def _histogram_sql(bins: int, sample: tuple[int, int] | None = None) -> str:
    """Equal-width histogram of out-degrees; over the md5-ordered sample of
    ``sample = (size, seed)`` rows if given, else over every source."""
    source = "deg"
    extra = ""
    if sample is not None:
        size, seed = sample
        extra = f""",
smp AS (SELECT src, deg FROM deg ORDER BY md5(src || '{seed}') LIMIT {size})"""
        source = "smp"
    return with_graph("trade", f"""{extra},
st AS (SELECT CAST(MIN(deg) AS DOUBLE) AS lo, CAST(MAX(deg) AS DOUBLE) AS hi FROM {source}),
b AS (SELECT CASE WHEN st.hi = st.lo THEN 0
                  ELSE LEAST(CAST(FLOOR((CAST(deg AS DOUBLE) - st.lo) / ((st.hi - st.lo) / {float(bins)!r})) AS BIGINT), {bins - 1})
             END AS bin
      FROM {source}, st),
c AS (SELECT bin, COUNT(*) AS cnt FROM b GROUP BY bin)
SELECT CAST(r.bin AS INTEGER) AS bin,
       {_r(f"st.lo + r.bin * ((st.hi - st.lo) / {float(bins)!r})", "lo")},
       {_r(f"CASE WHEN r.bin = {bins - 1} THEN st.hi ELSE st.lo + (r.bin + 1) * ((st.hi - st.lo) / {float(bins)!r}) END", "hi")},
       CAST(COALESCE(c.cnt, 0) AS BIGINT) AS count
FROM range({bins}) r(bin) CROSS JOIN st LEFT JOIN c ON c.bin = r.bin""")


def oracles(iterations: int = 10, alpha: float = 0.15, top_k: int = 20, top_degree: int = 10,
            sample_size: int = 1000, sample_seed: int = 42, bins: int = 50, tolerance: float = 1e-4,
            most_steps: int = 30) -> dict[str, str]:
    trade = lambda body: with_graph("trade", body)
    return {
        "adjacency_parse": f"SELECT src, dst, CAST(cnt AS BIGINT) AS cnt FROM ({TRADE_EDGES}) t",
        "page_index_lookup": trade(f""",
nm AS ({TRADE_NAMES}),
indeg AS (SELECT dst, CAST(SUM(cnt) AS BIGINT) AS in_degree FROM e GROUP BY dst)
SELECT nm.id, nm.title, CAST(COALESCE(indeg.in_degree, 0) AS BIGINT) AS in_degree,
       CAST(COALESCE(deg.deg, 0) AS BIGINT) AS out_degree
FROM nm LEFT JOIN indeg ON nm.id = indeg.dst LEFT JOIN deg ON nm.id = deg.src"""),
        "peek_rows": f"""SELECT src, dst, CAST(cnt AS BIGINT) AS cnt FROM ({TRADE_EDGES}) t
ORDER BY src, dst LIMIT 30""",
        "topk_parquet_roundtrip": pagerank_topk_sql(top_k, iterations, alpha),
        "ranked_report": ranked_report_sql(top_k, iterations, alpha),
        "node_set": trade("SELECT id FROM v"),
        "edge_table": with_graph("web", "SELECT src, dst, cnt FROM e"),
        "dangling_nodes": trade("SELECT id FROM vt WHERE dangling"),
        "graph_init": trade(f"SELECT vt.id, vt.dangling, vt.out_degree, {_r('1.0 / n.n', 'rank')} FROM vt, n"),
        "topk_with_titles": titled_topk_sql(top_k, iterations, alpha),
        "pagerank_step": pagerank_sql("trade", 1, alpha),
        "record_count": "SELECT COUNT(*) AS records FROM orders",
        "count_nodes": trade("SELECT COUNT(*) AS nodes FROM v"),
        "dangling_count": with_graph("web", """
SELECT COUNT(*) AS nodes, COUNT(*) FILTER (WHERE NOT dangling) AS records,
       COUNT(*) FILTER (WHERE dangling) AS dangling FROM vt"""),
        "out_degree": ORDER_DEGREES,
        "in_degree": trade("SELECT dst AS id, CAST(SUM(cnt) AS BIGINT) AS in_degree FROM e GROUP BY dst"),
        "avg_out_degree": f"""
SELECT COUNT(*) AS records, CAST(SUM(out_degree) AS BIGINT) AS links, {_r('AVG(out_degree)', 'avg_out_degree')} FROM ({ORDER_DEGREES}) d""",
        "transition_weights": trade("SELECT src, dst, w FROM w"),
        "dangling_mass": f"SELECT step, {_r('dangling_mass', 'dangling_mass')} FROM ({metrics_sql('trade', iterations, alpha)}) x",
        "total_mass": f"SELECT step, {_r('total_mass', 'total_mass')} FROM ({metrics_sql('trade', iterations, alpha)}) x",
        "degree_histogram": _histogram_sql(bins),
        "sample_histogram": _histogram_sql(bins, (sample_size, sample_seed)),
        "adjacency_list": _adjacency_list_sql(),
        "top_out_degree": trade(f"SELECT src AS id, deg AS out_degree FROM deg ORDER BY deg DESC, src LIMIT {top_degree}"),
        "degree_sample": trade(f"""SELECT src AS id, deg AS out_degree FROM deg
ORDER BY md5(src || '{sample_seed}') LIMIT {sample_size}"""),
        "pagerank_topk": pagerank_topk_sql(top_k, iterations, alpha),
        "adjacency_matrix": with_graph("states", "SELECT DISTINCT src, dst, CAST(1 AS BIGINT) AS value FROM e"),
        "transition_matrix": with_graph("states", "SELECT src, dst, w AS prob FROM w", binary=True),
        "adjacency_matrix_web": with_graph("web", "SELECT DISTINCT src, dst, CAST(1 AS BIGINT) AS value FROM e"),
        "transition_matrix_web": with_graph("web", "SELECT src, dst, w AS prob FROM w", binary=True),
        "power_iteration": vector_sql("seq", iterations, "first"),
        "power_iteration_squaring": vector_sql("states", 2 ** 3, "first"),
        "power_iteration_squaring_seq": vector_sql("seq", 2 ** 3, "first"),
        "mass_trace": f"""SELECT step, {_r('total_mass', 'total_mass')}
FROM ({metrics_sql('web', iterations, None, False, 'uniform', binary=True)}) x""",
        "pagerank": pagerank_sql("trade", iterations, alpha),
        "pagerank_web": pagerank_sql("web", iterations, alpha),
        "pagerank_graphx": graphx_sql("trade", iterations, alpha, "n.n"),
        "pagerank_graphx_norm": graphx_sql("trade", iterations, alpha),
        "pagerank_convergence": convergence_sql("seq", most_steps, alpha, tolerance),
        "node_count_sketches": trade("""
SELECT COALESCE(substr(id, 1, 1), '*') AS kind, COUNT(*) AS nodes, true AS within, true AS as_direct FROM v
GROUP BY GROUPING SETS ((substr(id, 1, 1)), ())"""),
        "record_edges": """
SELECT src, dst, CAST(SUM(cnt) AS BIGINT) AS cnt FROM (
    SELECT DISTINCT 'C' || CAST(o_custkey AS VARCHAR) AS src, 'P' || CAST(l_partkey AS VARCHAR) AS dst, n AS cnt
    FROM (SELECT l_orderkey, l_partkey, COUNT(*) AS n FROM lineitem GROUP BY ALL) JOIN orders ON l_orderkey = o_orderkey) GROUP BY src, dst""",
        "topk_titled_only": f"""SELECT t.id, s_name AS title, t.rank FROM ({pagerank_topk_sql(200, iterations, alpha)}) t
JOIN supplier ON t.id = 'S' || CAST(s_suppkey AS VARCHAR)""",
        "hops_trade": hops_sql("trade"),
        "hops_web": hops_sql("web"),
        "hops_seq": hops_sql("seq"),
        "shortest_paths_trade": paths_sql("trade"),
        "shortest_paths_seq": paths_sql("seq"),
        "strong_components": strong_components_sql("relay"),
        "chain_structure": chain_structure_sql("chain"),
    }
