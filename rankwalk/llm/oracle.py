"""DuckDB SQL for the registered queries of this subpackage.

Each function takes the name of (or a subquery for) its input and returns a
SELECT; the pipeline nests them.  Parameters are the operators' own defaults.
"""

from __future__ import annotations

from .licenses import KNOWN, NOT_WORD, SPELLINGS

WORD = r"[^\x20\x09-\x0D]+"
PUNCTUATION = r"\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E"    # of ASCII
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _words(text: str) -> str:
    return f"regexp_extract_all({text}, '{WORD}')"


def _cell(v: str, bits: int) -> str:
    half, shift = 1 << (bits - 1), f"(length(bin({v})) - {bits})"
    return f"CASE WHEN {v} < {2 * half} THEN {v} ELSE {2 * half} + ({shift} - 1) * {half} + ({v} >> {shift}) - {half} END"


def _cell_floor(c: str, bits: int) -> str:
    half = 1 << (bits - 1)
    return f"CASE WHEN {c} < {2 * half} THEN {c} ELSE ({half} + ({c} - {2 * half}) % {half}) << ((({c} - {2 * half}) // {half}) + 1)::INT END"


def _quality(docs: str) -> str:
    """CTEs ending in ``verdicts``: every row of docs with measures and kept.
    The numbers of the rules are stated here on their own."""
    least = {"symbol_rate": 4, "dup_line_rate": 50, "repeat_rate": 30, "upper_rate": 4, "mark_rate": 4, "word_length": 10}
    spread, min_group = 8, 100
    count = lambda chars: f"length(regexp_replace(body, '[^{chars}]', '', 'g'))"
    per = {"symbol_rate": ("n_symbols", "word_chars", 1000), "dup_line_rate": ("n_dup_lines", "n_lines", 1000), "repeat_rate": ("n_repeat_words", "n_words", 1000),
           "upper_rate": ("n_upper", "word_chars", 1000), "mark_rate": ("n_marks", "word_chars", 1000), "word_length": ("word_chars", "n_words", 100)}
    rate = {k: f"({unit} * {a}) // greatest({b}, 1)" for k, (a, b, unit) in per.items()}

    def fences(name: str, by: str) -> str:
        keys, part = (by + ", ", f"{by}, rate") if by else ("", "rate")
        return f"""
{name} AS (SELECT {keys}rate, max(grp) AS grp, mid - reach AS lo, mid + reach AS hi FROM (
  SELECT *, {spread} * greatest(mid - low, high - mid, least) AS reach FROM (
    SELECT {keys}rate, max(total) AS grp, {_cell_floor('min(CASE WHEN 10 * upto >= total THEN cell END)', 6)} AS low,
      {_cell_floor('min(CASE WHEN 2 * upto >= total THEN cell END)', 6)} AS mid,
      {_cell_floor('min(CASE WHEN 4 * upto >= 3 * total THEN cell END)', 6)} AS high,
      CASE rate {' '.join(f"WHEN '{k}' THEN {n}" for k, n in least.items())} END AS least
    FROM (SELECT *, sum(n) OVER (PARTITION BY {part} ORDER BY cell) AS upto, sum(n) OVER (PARTITION BY {part}) AS total
          FROM (SELECT {keys}rate, cell, sum(n) AS n FROM cells GROUP BY ALL))
    GROUP BY ALL)) GROUP BY ALL)"""

    return f"""
q_rows AS MATERIALIZED (SELECT *, row_number() OVER () AS rid, coalesce(text, '') AS body FROM {docs}),
q_words AS MATERIALIZED (SELECT rid, {_words('body')} AS ws FROM q_rows),
q_win AS (SELECT rid, i, ws[i:i + 7] AS win FROM (SELECT rid, ws, unnest(range(1, len(ws) - 6)) AS i FROM q_words WHERE len(ws) >= 8)),
q_rep AS (SELECT rid, count(DISTINCT i + k) AS n FROM (SELECT rid, i, unnest(range(0, 8)) AS k FROM (
  SELECT rid, i, count(*) OVER (PARTITION BY rid, win) AS c FROM q_win) WHERE c > 1) GROUP BY rid),
q_lines AS (SELECT rid, count(*) AS n, count(*) - count(DISTINCT line) AS dup FROM (
  SELECT rid, unnest(string_split(body, chr(10))) AS line FROM q_rows) WHERE regexp_matches(line, '{WORD}') GROUP BY rid),
q_base AS MATERIALIZED (SELECT q_rows.*, len(ws) AS n_words, length(regexp_replace(body, '[\\x20\\x09-\\x0D]+', '', 'g')) AS word_chars,
  {count('#*$%&|<>')} AS n_symbols, coalesce(dup, 0) AS n_dup_lines, coalesce(q_rep.n, 0) AS n_repeat_words,
  coalesce(q_lines.n, 0) AS n_lines, {count('A-Z')} AS n_upper, {count(PUNCTUATION)} - n_symbols AS n_marks
  FROM q_rows JOIN q_words USING (rid) LEFT JOIN q_rep USING (rid) LEFT JOIN q_lines USING (rid)),
q_judge AS MATERIALIZED (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed, {', '.join(f'{v} AS {k}' for k, v in rate.items())} FROM q_base),
cells AS MATERIALIZED (SELECT lang, source, rate, {_cell('value', 6)} AS cell, count(*) AS n FROM (
  {' UNION ALL '.join(f"SELECT lang, source, '{k}' AS rate, {k} AS value FROM q_judge WHERE NOT base_failed" for k in per)}) GROUP BY ALL),
{fences('f_own', 'lang, source')},{fences('f_lang', 'lang')},{fences('f_all', '')},
limits AS (SELECT a.lang, a.source, a.rate, CASE WHEN a.grp >= {min_group} THEN a.lo WHEN b.grp >= {min_group} THEN b.lo ELSE c.lo END AS lo,
  CASE WHEN a.grp >= {min_group} THEN a.hi WHEN b.grp >= {min_group} THEN b.hi ELSE c.hi END AS hi
  FROM f_own a JOIN f_lang b ON a.lang IS NOT DISTINCT FROM b.lang AND a.rate = b.rate JOIN f_all c ON a.rate = c.rate),
wide AS (SELECT lang AS l_, source AS s_, {', '.join(f"max(CASE WHEN rate = '{k}' THEN {f} END) AS {f}_{k}" for k in per for f in ('lo', 'hi'))} FROM limits GROUP BY ALL),
verdicts AS (SELECT q_judge.*, NOT base_failed AND {' AND '.join(f'coalesce({k} <= hi_{k}, true)' for k in per)} AND coalesce(word_length >= lo_word_length, true) AS kept
  FROM q_judge LEFT JOIN wide ON lang IS NOT DISTINCT FROM l_ AND source IS NOT DISTINCT FROM s_)"""


def quality_rules(docs: str = "documents") -> str:
    long = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return f"""WITH {_quality(docs)}
SELECT doc_id, {', '.join(f'{c}::BIGINT AS {c}' for c in long)}, base_failed, kept, {', '.join(f'{c}::BIGINT AS {c}' for c in ('n_lines', 'n_upper', 'n_marks'))} FROM verdicts"""


def quality_kept(docs: str) -> str:
    return f"WITH {_quality(docs)}\nSELECT doc_id, text, lang, source, n_chars FROM verdicts WHERE kept"


def _kept_lines(docs: str, min_docs: int) -> str:
    return f"""
l_rows AS MATERIALIZED (SELECT *, row_number() OVER () AS rid, string_split(coalesce(text, ''), chr(10)) AS ls FROM {docs}),
l_lines AS MATERIALIZED (SELECT rid, i, ls[i] AS line, translate(trim(ls[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{LOWER}') AS k
  FROM (SELECT rid, ls, unnest(range(1, len(ls) + 1)) AS i FROM l_rows)),
l_common AS (SELECT k FROM l_lines WHERE k <> '' GROUP BY k HAVING count(DISTINCT rid) >= {min_docs}),
l_kept AS (SELECT rid, count(*) AS n_lines, count(c.k) AS n_dropped, coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (c.k IS NULL), '') AS kept
  FROM l_lines LEFT JOIN l_common c ON l_lines.k = c.k GROUP BY rid)"""


def line_dedup(docs: str = "documents", min_docs: int = 10) -> str:
    return f"""WITH {_kept_lines(docs, min_docs)}
SELECT doc_id, n_lines::BIGINT AS n_lines, n_dropped::BIGINT AS n_dropped, sha256(kept) AS kept_sha256 FROM l_rows JOIN l_kept USING (rid)"""


def lines_kept(docs: str, min_docs: int = 10) -> str:
    return f"""WITH {_kept_lines(docs, min_docs)}
SELECT doc_id, CASE WHEN text IS NULL THEN NULL ELSE kept END AS text, lang, source, CASE WHEN text IS NULL THEN NULL ELSE length(kept) END::BIGINT AS n_chars
FROM l_rows JOIN l_kept USING (rid)"""


def license_scan(docs: str = "documents") -> str:
    year, gap = "(19|20)[0-9][0-9]", r"[^\p{L}\p{N}\n]*"
    own = rf"(?i)copyright{gap}([(]c[)]|©|{year}|yyyy|year\b)|[(]c[)]{gap}(copyright|{year})|©"
    line = rf"(?im)^{gap}(({own[4:]})[^\n]*|all rights reserved{gap}$)"
    form = lambda body: f"trim(regexp_replace(translate({body}, '{UPPER}', '{LOWER}'), '{NOT_WORD}', ' ', 'g'), ' ')"
    bare = lambda text: f"regexp_replace({text}, '{line}', '', 'g')"

    def respelled(words: str) -> str:
        words = f"' ' || {words} || ' '"
        for pattern, kept in SPELLINGS:
            words = f"regexp_replace({words}, ' ({pattern}) ', ' {kept} ', 'g')"
        return f"trim({words}, ' ')"

    known = ", ".join(f"({_lit(i)}, {_lit(t)})" for i, t in KNOWN)
    return f"""WITH known AS (SELECT md5(form) AS digest, min(license_id) AS license_id, max(length(form)) AS size FROM (
  SELECT license_id, {respelled(form(bare('text')))} AS form FROM (VALUES {known}) v(license_id, text)) WHERE form <> '' GROUP BY 1),
c_docs AS MATERIALIZED (SELECT doc_id, {bare("coalesce(text, '')")} AS body FROM {docs}),
c_units AS (SELECT doc_id, 'text' AS unit, NULL::INT AS line_no, body FROM c_docs
  UNION ALL SELECT doc_id, 'line', (i - 1)::INT, ls[i] FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM (
    SELECT doc_id, string_split(body, chr(10)) AS ls FROM c_docs WHERE contains(body, chr(10))))),
c_short AS MATERIALIZED (SELECT * FROM (SELECT doc_id, unit, line_no, {form('body')} AS form FROM c_units) WHERE length(form) <= (SELECT 4 * max(size) FROM known)),
c_forms AS (SELECT doc_id, unit, line_no, md5({respelled('form')}) AS digest FROM c_short WHERE form <> '')
SELECT doc_id, unit, line_no, license_id, digest FROM c_forms JOIN known USING (digest)"""


def substring_dedup(docs: str = "documents", size: int = 13) -> str:
    return f"""WITH s_rows AS MATERIALIZED (SELECT doc_id, row_number() OVER () AS rid, {_words("coalesce(text, '')")} AS ws FROM {docs}),
s_win AS MATERIALIZED (SELECT doc_id, rid, i, array_to_string(ws[i:i + {size - 1}], ' ') AS win FROM (
  SELECT doc_id, rid, ws, unnest(range(1, len(ws) - {size - 2})) AS i FROM s_rows WHERE len(ws) >= {size})),
s_first AS (SELECT win, min(doc_id) AS first FROM s_win GROUP BY win HAVING min(doc_id) < max(doc_id)),
s_gone AS (SELECT DISTINCT rid, i + k AS i FROM (SELECT rid, i, unnest(range(0, {size})) AS k FROM s_win JOIN s_first USING (win) WHERE first < doc_id)),
s_words AS (SELECT rid, i, ws[i] AS w FROM (SELECT rid, ws, unnest(range(1, len(ws) + 1)) AS i FROM s_rows)),
s_kept AS (SELECT s_words.rid, count(*) FILTER (g.i IS NOT NULL) AS n_removed, coalesce(string_agg(w, ' ' ORDER BY s_words.i) FILTER (g.i IS NULL), '') AS kept
  FROM s_words LEFT JOIN s_gone g ON s_words.rid = g.rid AND s_words.i = g.i GROUP BY s_words.rid)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM s_rows LEFT JOIN s_kept USING (rid)"""


def _shingles(text: str, size: int = 5) -> str:
    ws = _words(f"translate(coalesce({text}, ''), '{UPPER}', '{LOWER}')")
    return f"(SELECT list_distinct(CASE WHEN len(ws) >= {size} THEN [array_to_string(ws[i:i + {size - 1}], ' ') FOR i IN range(1, len(ws) - {size - 2})] WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) FROM (SELECT {ws} AS ws))"


def _components(docs: str) -> str:
    return f"""
j_rows AS MATERIALIZED (SELECT *, row_number() OVER () AS rid, {_shingles('text')} AS sh FROM {docs}),
j_sh AS MATERIALIZED (SELECT rid, len(sh) AS n, unnest(sh) AS s FROM j_rows),
j_links AS MATERIALIZED (SELECT a, b FROM (SELECT x.rid AS a, y.rid AS b, x.n AS na, y.n AS nb, count(*) AS c FROM j_sh x JOIN j_sh y ON x.s = y.s AND x.rid <> y.rid GROUP BY ALL)
  WHERE 100 * c >= 80 * (na + nb - c)),
j_reach AS (SELECT rid, rid AS other FROM j_rows UNION SELECT r.rid, l.b FROM j_reach r JOIN j_links l ON r.other = l.a),
j_comp AS MATERIALIZED (SELECT j_reach.rid, min(o.doc_id) AS component_id, min(other) AS root FROM j_reach JOIN j_rows o ON o.rid = other GROUP BY 1)"""


def jaccard_components(docs: str = "documents") -> str:
    return f"""WITH RECURSIVE {_components(docs)}
SELECT doc_id, len(sh)::BIGINT AS n_shingles, component_id FROM j_rows JOIN j_comp USING (rid)"""


def near_duplicates(docs: str = "documents") -> str:
    links = _components(docs).replace("100 * c >= 80 *", "100 * c >= 85 *")
    return f"""WITH RECURSIVE {links}
SELECT doc_id, len(sh)::BIGINT AS n_shingles, component_id, doc_id IS NOT DISTINCT FROM component_id AS kept FROM j_rows JOIN j_comp USING (rid)"""


def _field(column: str) -> str:
    return f"CASE WHEN {column} IS NULL THEN '-' ELSE strlen({column}::VARCHAR) || ':' || {column}::VARCHAR END"


def merkle_manifest(docs: str = "documents") -> str:
    leaf = lambda n: f"sha256({' || '.join(map(_field, ('doc_id', 'source', 'lang', n, 'text')))})"
    def levels(name: str, source: str) -> str:
        return f"""
{name} AS (SELECT tree, 0 AS level, idx, h, n FROM {source}
  UNION ALL SELECT tree, level + 1, idx // 2, sha256(string_agg(h, '' ORDER BY idx)), (n + 1) // 2 FROM {name} WHERE n > 1 GROUP BY tree, level, n, idx // 2)"""
    def climb(name: str, start: str, tree: str) -> str:
        return f"""
{name} AS ({start}
  UNION ALL SELECT c.rid, c.tree, c.level + 1, c.idx // 2, c.n // 2 + c.n % 2,
    sha256(CASE WHEN s.h IS NULL THEN c.folded WHEN c.idx % 2 = 1 THEN s.h || c.folded ELSE c.folded || s.h END), c.proof || coalesce(s.h, '')
  FROM {name} c LEFT JOIN {tree} s ON s.tree = c.tree AND s.level = c.level AND s.idx = xor(c.idx, 1) WHERE c.n > 1)"""
    return f"""WITH RECURSIVE b_table AS (SELECT list(list_reduce(range(0, 9), lambda c, k: CASE WHEN k = 0 THEN c WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, i) ORDER BY i) AS t FROM range(0, 256) r(i)),
m_rows AS MATERIALIZED (SELECT doc_id, CASE WHEN lang IS NULL THEN '-' ELSE '=' || lang END AS tree, {leaf('n_chars')} AS leaf, {leaf('(n_chars::HUGEINT + 1)')} AS other,
  xor(list_reduce(list_transform(regexp_extract_all(hex(encode(doc_id::VARCHAR)), '..'), lambda h: ('0x' || h)::BIGINT), lambda c, b: xor(c // 256, t[xor(c, b) % 256 + 1]), 4294967295), 4294967295) % 7 AS chosen,
  row_number() OVER () AS rid FROM {docs}, b_table),
m_leaves AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS LAST, leaf, rid) - 1 AS idx, leaf AS h, count(*) OVER (PARTITION BY tree) AS n FROM m_rows),
{levels('m_nodes', 'm_leaves')},
m_tree AS MATERIALIZED (SELECT * FROM m_nodes),
m_tops AS MATERIALIZED (SELECT '' AS tree, tree AS lang, row_number() OVER (ORDER BY tree) - 1 AS idx, h, count(*) OVER () AS n FROM m_tree WHERE n = 1),
{levels('m_upper', 'm_tops')},
m_above AS MATERIALIZED (SELECT * FROM m_upper),
{climb('m_climb', "SELECT rid, tree, 0 AS level, idx, n, CASE WHEN chosen = 0 THEN other ELSE leaf END AS folded, '' AS proof FROM m_leaves", 'm_tree')},
m_half AS MATERIALIZED (SELECT * FROM m_climb WHERE n = 1),
{climb('m_rest', "SELECT m.rid, '' AS tree, 0 AS level, t.idx, t.n, m.folded, m.proof FROM m_half m JOIN m_tops t ON t.lang = m.tree", 'm_above')}
SELECT l.doc_id, l.leaf, t.h AS subroot, r.h AS root, sha256(m.proof) AS proof_sha256, m.folded AS folded_root, m.folded = r.h AS verified
FROM m_rest m JOIN m_leaves l USING (rid) JOIN m_tops t ON t.lang = l.tree JOIN m_above r ON r.n = 1 WHERE m.n = 1"""


def one_of_each(docs: str) -> str:
    return f"""WITH RECURSIVE {_components(docs)}
SELECT doc_id, text, lang, source, n_chars FROM j_rows JOIN j_comp USING (rid)
QUALIFY row_number() OVER (PARTITION BY root ORDER BY doc_id NULLS LAST, rid) = 1"""


def balanced_shards(docs: str = "documents", shards: int = 24) -> str:
    return f"""WITH b_table AS (SELECT list(list_reduce(range(0, 9), lambda c, k: CASE WHEN k = 0 THEN c WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, i) ORDER BY i) AS t FROM range(0, 256) r(i)),
b_rows AS MATERIALIZED (SELECT doc_id, row_number() OVER () AS rid, coalesce(text, '') AS body, (strlen(coalesce(text, '')) + 8)::BIGINT AS size FROM {docs}),
b_crc AS MATERIALIZED (SELECT doc_id, rid, size, xor(list_reduce(list_transform(regexp_extract_all(hex(encode(body)), '..'), lambda h: ('0x' || h)::BIGINT), lambda c, b: xor(c // 256, t[xor(c, b) % 256 + 1]), 4294967295), 4294967295) AS text_crc32 FROM b_rows, b_table),
b_run AS MATERIALIZED (SELECT *, (sum(size) OVER w - size)::BIGINT AS first_byte, (sum(size) OVER ())::BIGINT AS total, row_number() OVER w - 1 AS nr FROM b_crc WINDOW w AS (ORDER BY doc_id NULLS LAST, text_crc32, size, rid ROWS UNBOUNDED PRECEDING)),
b_shard AS MATERIALIZED (SELECT *, ((2 * first_byte + size) * {shards} // (2 * total))::INT AS shard FROM b_run)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard, (nr - min(nr) OVER (PARTITION BY shard))::BIGINT AS slot, NULL::INT AS grown_shard, first_byte FROM b_shard"""


def _leaks(docs: str, items: str) -> str:
    return f"""
k_items AS MATERIALIZED (SELECT item_id, row_number() OVER () AS iid, {_shingles('text')} AS sh FROM {items}),
k_docs AS MATERIALIZED (SELECT doc_id, text, row_number() OVER () AS kid, {_shingles('text')} AS sh FROM (SELECT DISTINCT doc_id, text FROM {docs})),
k_shared AS (SELECT kid, iid, count(*) AS n_shared FROM (SELECT kid, unnest(sh) AS s FROM k_docs) d JOIN (SELECT iid, unnest(sh) AS s FROM k_items) i USING (s) GROUP BY ALL),
k_leaks AS MATERIALIZED (SELECT doc_id, text, item_id, n_shared, len(k_items.sh) AS q FROM k_shared JOIN k_items USING (iid) JOIN k_docs USING (kid) WHERE 5 * n_shared >= 4 * len(k_items.sh))"""


def benchmark_leaks(docs: str = "documents", items: str = "benchmark") -> str:
    return f"WITH {_leaks(docs, items)}\nSELECT doc_id, item_id, n_shared::BIGINT AS n_shared, q::BIGINT AS n_item_shingles FROM k_leaks"


def without_leaks(docs: str, items: str = "benchmark") -> str:
    return f"""WITH k_all AS MATERIALIZED (SELECT * FROM {docs}), {_leaks('k_all', items)}
SELECT * FROM k_all a WHERE NOT EXISTS (SELECT 1 FROM k_leaks k WHERE k.doc_id IS NOT DISTINCT FROM a.doc_id AND k.text IS NOT DISTINCT FROM a.text)"""


def url_filter(rules: list[tuple[str, str, str]], pages: str = "pages", default: str = "allow") -> str:
    values = ", ".join(f"({_lit(v)}, {_lit(h)}, {_lit(p)})" for v, h, p in rules)
    return f"""WITH rules(verdict, host, path) AS (VALUES {values}),
u_rest AS (SELECT page_id, row_number() OVER () AS rid, CASE WHEN contains(url, '://') THEN regexp_extract(substr(url, strpos(url, '://') + 3), '^[^?#]*') ELSE '' END AS bare FROM {pages}),
u_rows AS MATERIALIZED (SELECT page_id, rid, translate(regexp_extract(bare, '^[^/]*'), '{UPPER}', '{LOWER}') AS host, substr(bare, length(regexp_extract(bare, '^[^/]*')) + 1) AS path FROM u_rest),
u_best AS (SELECT rid, r.host || r.path AS rule, r.verdict FROM u_rows u JOIN rules r ON (u.host = r.host OR ends_with(u.host, '.' || r.host)) AND starts_with(u.path, r.path)
  QUALIFY row_number() OVER (PARTITION BY rid ORDER BY length(r.host) + length(r.path) DESC, length(r.host) DESC, r.verdict DESC) = 1)
SELECT page_id, host, path, rule, coalesce(verdict, '{default}') AS verdict FROM u_rows LEFT JOIN u_best USING (rid)"""


def packed(docs: str = "documents", buckets: int = 8, budget: int = 16384) -> str:
    steps = ["p_dp1 AS MATERIALIZED (SELECT j, cc * longest - ct AS cost, 0::BIGINT AS came FROM p_cells)"]
    steps += [f"""p_dp{k} AS MATERIALIZED (SELECT c.j, min(p.cost + (c.cc - i.cc) * c.longest - (c.ct - i.ct)) AS cost,
  arg_min(p.j, (p.cost + (c.cc - i.cc) * c.longest - (c.ct - i.ct)) * 100000 + p.j) AS came
  FROM p_cells c JOIN p_dp{k - 1} p ON p.j < c.j JOIN p_cells i ON i.j = p.j GROUP BY c.j)""" for k in range(2, buckets + 1)]
    every = " UNION ALL ".join(f"SELECT {k} AS k, j, came FROM p_dp{k}" for k in range(1, buckets + 1))
    return f"""WITH RECURSIVE p_rows AS MATERIALIZED (SELECT doc_id, row_number() OVER () AS rid, len({_words("coalesce(text, '')")})::HUGEINT AS n FROM {docs}),
p_hist AS (SELECT {_cell('n::BIGINT', 8)} AS cell, count(*) AS c, sum(n) AS t, max(n) AS longest FROM p_rows GROUP BY 1),
p_cells AS MATERIALIZED (SELECT row_number() OVER (ORDER BY cell) AS j, sum(c) OVER (ORDER BY cell) AS cc, sum(t) OVER (ORDER BY cell) AS ct, longest FROM p_hist),
{', '.join(steps)},
p_came AS MATERIALIZED ({every}),
p_back AS (SELECT least({buckets}, max(j))::INT AS k, max(j) AS j FROM p_cells HAVING max(j) IS NOT NULL
  UNION ALL SELECT b.k - 1, p.came FROM p_back b JOIN p_came p ON p.k = b.k AND p.j = b.j WHERE b.k > 1),
p_limits AS MATERIALIZED (SELECT c.longest AS lim, row_number() OVER (ORDER BY c.longest) - 1 AS bucket FROM p_back JOIN p_cells c USING (j)),
p_in AS MATERIALIZED (SELECT doc_id, rid, n, min(bucket) AS bucket, min(lim) AS lim FROM p_rows JOIN p_limits ON n <= lim GROUP BY ALL),
p_nr AS (SELECT *, row_number() OVER (PARTITION BY bucket ORDER BY doc_id NULLS LAST, n, rid) - 1 AS nr, greatest({budget} // greatest(lim, 1), 1)::BIGINT AS per FROM p_in)
SELECT doc_id, n::BIGINT AS n_tokens, bucket::INT AS bucket, lim::BIGINT AS bucket_limit, (nr // per)::BIGINT AS batch, (nr % per)::BIGINT AS slot FROM p_nr"""
