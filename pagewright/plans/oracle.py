"""The same queries as SQL for DuckDB, written on their own: no expression is shared with the engine."""

from __future__ import annotations

_JSWS = r"\t\n\x0B\f\r \x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}"
_WORD = r"[\p{L}\p{N}]+(?:[.''’/-][\p{L}\p{N}]+)*"


def _n(t: str, pattern: str) -> str:
    return f"len(regexp_extract_all({t}, '{pattern}'))::BIGINT"


def _words(t: str) -> str:
    return _n(t, _WORD)


def _meaning(t: str) -> str:
    return _n(t, r"[\p{L}\p{N}]")


def _valid(t: str) -> str:
    return _n(t, rf"[^{_JSWS}\x00-\x1F\x7F\x{{FFFD}}]")


def _invalid(t: str) -> str:
    return _n(t, r"[\x{FFFD}\x00-\x08\x0B\x0C\x0E-\x1F\x7F]")


def _units(t: str) -> str:
    return rf"(length({t}) + length(regexp_replace({t}, '[^\x{{10000}}-\x{{10FFFF}}]', '', 'g')))::BIGINT"


def _ratio(t: str) -> str:
    return f"({_invalid(t)}::DOUBLE / greatest({_units(t)}, 1))"


def _norm(t: str) -> str:
    t = rf"regexp_replace({t}, '[ \t]+\n', chr(10), 'g')"
    t = rf"regexp_replace({t}, '[ \t]{{2,}}', ' ', 'g')"
    return rf"regexp_replace({t}, '\A[{_JSWS}]+|[{_JSWS}]+\z', '', 'g')"


_RULES = {
    "broken": f"({_meaning('t')} >= 20 AND {_ratio('t')} > 0.01)",
    "no_valid": f"({_valid('t')} = 0)",
    "no_words": f"({_words('t')} = 0 AND c > 0.2)",
    "scanned": f"(c >= 0.8 AND {_words('t')} < 20)",
}
_MODE = "CASE WHEN " + " OR ".join(_RULES.values()) + " THEN 'ocr' ELSE 'native' END"
_ANALYSIS = "SELECT DISTINCT ON (analysis_id) analysis_id, item_id, page, recommended_mode AS stored, coalesce(text, '') AS t, coalesce(image_coverage, 0.0) AS c FROM page_analysis"
_RESULTS = "SELECT DISTINCT ON (result_id) result_id, text FROM page_results"
_ITEMS = "SELECT * FROM pdf_items QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY ingested_at DESC) = 1"
_FIXED4 = "CASE WHEN ({x} * 32) % 2 = 1 THEN floor({x} * 10000 + 0.5) / 10000 ELSE CAST(printf('%.4f', {x}) AS DOUBLE) END"

_WHOLE = "coalesce(NOT isnan({x}) AND abs({x}) < 9e15 AND floor({x}) = {x} AND {x} >= {n}, false)"
_END = "(CASE WHEN page_to = 0 THEN page_count ELSE page_to END)"
_RANGE = f"""CASE WHEN NOT {_WHOLE.format(x='page_from', n=1)} THEN 'Page From must be an integer greater than 0'
  WHEN NOT {_WHOLE.format(x='page_to', n=0)} THEN 'Page To must be 0 or a positive integer'
  WHEN {_END} < page_from THEN 'Page To must be greater than or equal to Page From'
  WHEN {_END} > page_count THEN 'Page To cannot exceed the document page count (' || page_count || ')' END"""
_PARTS = rf"[regexp_replace(p, '\A[{_JSWS}]+|[{_JSWS}]+\z', '', 'g') FOR p IN string_split(coalesce(specific_pages, ''), ',')]"
_LIST = f"""CASE WHEN regexp_replace(coalesce(specific_pages, ''), '[{_JSWS}]+', '', 'g') = '' THEN 'Pages must contain at least one page number'
  WHEN len([p FOR p IN parts IF NOT regexp_full_match(p, '[0-9]+')]) > 0 THEN 'Pages must be comma-separated positive integers, for example 1,5,6'
  WHEN len([p FOR p IN parts IF TRY_CAST(p AS HUGEINT) = 0]) > 0 THEN 'Pages must contain only integers greater than 0'
  WHEN len(list_distinct([TRY_CAST(p AS HUGEINT) FOR p IN parts])) <> len(parts) THEN 'Pages must not contain duplicates'
  WHEN len([p FOR p IN parts IF TRY_CAST(p AS HUGEINT) > page_count]) > 0 THEN 'Page ' || ([TRY_CAST(p AS HUGEINT) FOR p IN parts IF TRY_CAST(p AS HUGEINT) > page_count])[1] || ' cannot exceed the document page count (' || page_count || ')' END"""
_PICK = "([TRY_CAST(p AS BIGINT) FOR p IN parts])"

_SCANNED = f"""WITH a AS ({_ANALYSIS}), m AS (SELECT *, {_MODE} AS mode, {_words('t')} AS w FROM a), i AS ({_ITEMS}),
 j AS (SELECT m.*, i.page_count, greatest(0, floor(coalesce(CASE WHEN isnan(i.stop_after_ocr_pages) THEN 0 ELSE i.stop_after_ocr_pages END, 0)))::BIGINT AS k FROM m JOIN i USING (item_id)),
 r AS (SELECT *, sum(CASE WHEN mode = 'ocr' THEN 1 ELSE 0 END) OVER (PARTITION BY item_id ORDER BY page ROWS UNBOUNDED PRECEDING) AS run FROM j),
 s AS (SELECT * FROM r WHERE k = 0 OR run - CASE WHEN mode = 'ocr' THEN 1 ELSE 0 END < k) """

_ROUTED = f"""WITH a AS ({_ANALYSIS}), i AS ({_ITEMS}),
 r AS (SELECT a.item_id, a.page, a.t, i.page_count, i.page_selection, CASE WHEN coalesce(i.recognition_mode, 'auto') IN ('native', 'ocr') THEN i.recognition_mode ELSE {_MODE} END AS source FROM a JOIN i USING (item_id)) """


def _mul(a: str, b: str) -> str:
    return f"[{a}[1]*{b}[1]+{a}[3]*{b}[2], {a}[2]*{b}[1]+{a}[4]*{b}[2], {a}[1]*{b}[3]+{a}[3]*{b}[4], {a}[2]*{b}[3]+{a}[4]*{b}[4], {a}[1]*{b}[5]+{a}[3]*{b}[6]+{a}[5], {a}[2]*{b}[5]+{a}[4]*{b}[6]+{a}[6]]"


def _ok(m: str) -> str:
    return f"coalesce(len({m}) >= 6 AND len([x FOR x IN {m}[1:6] IF x IS NULL OR NOT isfinite(x)]) = 0, false)"


_FOLD = f"""WITH RECURSIVE p AS (SELECT item_id, page, width, height, coalesce(len(ops), 0) AS n, ops FROM page_operators),
 f AS (SELECT item_id, page, 0 AS i, [1,0,0,1,0,0]::DOUBLE[] AS m, []::DOUBLE[][] AS st, []::DOUBLE[][] AS drawn FROM p
  UNION ALL
  SELECT item_id, page, i + 1,
   CASE WHEN o.fn IN (12, 74) AND {_ok('o.matrix')} THEN {_mul('m', 'o.matrix')} WHEN o.fn IN (11, 75) AND len(st) > 0 THEN st[len(st)] ELSE m END,
   CASE WHEN o.fn IN (10, 74) THEN list_append(st, m) WHEN o.fn IN (11, 75) AND len(st) > 0 THEN st[1:len(st) - 1] ELSE st END,
   list_concat(drawn, CASE WHEN o.fn IN (85, 86) THEN [m]
    WHEN o.fn = 88 AND isfinite(o.scale_x) AND isfinite(o.scale_y) AND o.positions IS NOT NULL THEN [{_mul('m', '([o.scale_x, 0, 0, o.scale_y, o.positions[2*q+1], o.positions[2*q+2]])')} FOR q IN range(0, len(o.positions) // 2)]
    WHEN o.fn = 87 THEN [{_mul('m', 'g')} FOR g IN coalesce(o.placements, []) IF {_ok('g')}] ELSE []::DOUBLE[][] END)
  FROM (SELECT f.*, p.ops[f.i + 1] AS o FROM f JOIN p USING (item_id, page) WHERE f.i < p.n)),
 e AS (SELECT f.*, p.width, p.height FROM f JOIN p USING (item_id, page) WHERE f.i = p.n) """

_STRIPS = """ x AS (SELECT DISTINCT k, v FROM (SELECT k, x0 AS v FROM r UNION ALL SELECT k, x1 FROM r)),
 s AS (SELECT k, v AS l, lead(v) OVER (PARTITION BY k ORDER BY v) AS h FROM x),
 o AS (SELECT s.k, s.l, s.h, r.y0, r.y1 FROM s JOIN r ON r.k = s.k AND r.x0 < s.h AND r.x1 > s.l WHERE s.h IS NOT NULL),
 g AS (SELECT *, CASE WHEN y0 > max(y1) OVER (PARTITION BY k, l ORDER BY y0, y1 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 1 ELSE 0 END AS apart FROM o),
 q AS (SELECT *, sum(apart) OVER (PARTITION BY k, l ORDER BY y0, y1 ROWS UNBOUNDED PRECEDING) AS island FROM g),
 u AS (SELECT k, l, h, island, max(y1) - min(y0) AS covered FROM q GROUP BY ALL),
 a AS (SELECT k, sum((h - l) * c) AS area FROM (SELECT k, l, h, sum(covered) AS c FROM u GROUP BY ALL) GROUP BY k) """


def oracle_sql() -> dict[str, str]:
    sql = {
        "word_count": f"SELECT result_id, {_words('t')} AS n_words FROM (SELECT result_id, coalesce(text, '') AS t FROM ({_RESULTS}))",
        "char_classes": f"SELECT result_id, {_units('t')} AS n_units, {_meaning('t')} AS n_meaningful, {_valid('t')} AS n_valid, {_invalid('t')} AS n_invalid, {_ratio('t')} AS invalid_ratio FROM (SELECT result_id, coalesce(text, '') AS t FROM ({_RESULTS}))",
        "normalize_text": f"SELECT result_id, md5(t) AS digest, length(t)::BIGINT AS n_chars FROM (SELECT result_id, {_norm('text')} AS t FROM ({_RESULTS}) WHERE text IS NOT NULL)",
        "assemble_page_text": f"""SELECT result_id, md5({_norm('t')}) AS digest FROM (SELECT result_id, list_aggregate([CASE WHEN l[k] = '' THEN '' WHEN k < len(l) THEN l[k] || chr(10) ELSE l[k] || ' ' END FOR k IN range(1, len(l) + 1)], 'string_agg', '') AS t
            FROM (SELECT result_id, string_split(text, chr(10)) AS l FROM ({_RESULTS}) WHERE text IS NOT NULL))""",
        "recommend_mode": f"SELECT analysis_id, {_MODE} AS mode FROM ({_ANALYSIS})",
        "rule_breakdown": f"SELECT coalesce(stored, 'none') AS stored_mode, count(*) AS pages, " + ", ".join(f"sum({v}::BIGINT)::BIGINT AS {k}" for k, v in _RULES.items()) + f" FROM ({_ANALYSIS}) GROUP BY 1",
        "rect_clip": """SELECT l_orderkey, count(*) FILTER (WHERE ok) AS n_kept, sum(x0) FILTER (WHERE ok) AS c0, sum(y0) FILTER (WHERE ok) AS c1, sum(x1) FILTER (WHERE ok) AS c2, sum(y1) FILTER (WHERE ok) AS c3 FROM (
            SELECT *, x1 > x0 AND y1 > y0 AS ok FROM (SELECT l_orderkey, greatest(0.0, l_linenumber * 5.0) AS x0, greatest(0.0, 30.0 - l_quantity) AS y0, least(40.0, l_linenumber * 5.0 + l_quantity) AS x1, least(25.0, 30.0) AS y1 FROM lineitem)) GROUP BY 1""",
        "union_area": "WITH r AS (SELECT l_orderkey AS k, l_linenumber * 7.0::DOUBLE AS x0, l_quantity AS y0, l_linenumber * 7.0::DOUBLE + l_quantity % 13 + 4 AS x1, l_quantity + l_linenumber * 3 AS y1 FROM lineitem)," + _STRIPS + " SELECT k AS l_orderkey, area FROM a",
        "matrix_fold": _FOLD + "SELECT item_id, page, " + ", ".join(f"m[{i + 1}] AS m{i}" for i in range(6)) + ", len(st)::BIGINT AS depth, len(drawn)::BIGINT AS n_drawn FROM e",
        "image_coverage": _FOLD
        + """, d AS (SELECT item_id, page, width, height, unnest(drawn) AS m FROM e WHERE width IS NOT NULL AND height IS NOT NULL),
            b AS (SELECT item_id, page, width, height, [m[5], m[1]+m[5], m[3]+m[5], m[1]+m[3]+m[5]] AS xs, [m[6], m[2]+m[6], m[4]+m[6], m[2]+m[4]+m[6]] AS ys FROM d),
            r AS (SELECT item_id || '/' || page AS k, x0, y0, x1, y1 FROM (SELECT item_id, page, greatest(0, list_min(xs)) AS x0, greatest(0, list_min(ys)) AS y0, least(width, list_max(xs)) AS x1, least(height, list_max(ys)) AS y1
              FROM b WHERE len([v FOR v IN list_concat(xs, ys) IF v IS NULL OR isnan(v)]) = 0) WHERE x1 > x0 AND y1 > y0),"""
        + _STRIPS
        + f" SELECT item_id, page, {_FIXED4.format(x='c')} AS coverage FROM (SELECT e.item_id, e.page, CASE WHEN e.width IS NOT NULL AND e.height IS NOT NULL THEN least(1, coalesce(a.area, 0) / greatest(e.width * e.height, 1)) END AS c FROM e LEFT JOIN a ON a.k = e.item_id || '/' || e.page)",
        "page_range": f"SELECT item_id, error, CASE WHEN ok THEN ({_END} - page_from + 1)::BIGINT END AS n_pages, CASE WHEN ok THEN page_from::BIGINT END AS first_page, CASE WHEN ok THEN {_END}::BIGINT END AS last_page FROM (SELECT *, error IS NULL AND page_count IS NOT NULL AS ok FROM (SELECT *, {_RANGE} AS error FROM ({_ITEMS})))",
        "specific_pages": f"SELECT item_id, error, CASE WHEN ok THEN len(parts)::BIGINT END AS n_pages, CASE WHEN ok THEN list_min({_PICK}) END AS first_page, CASE WHEN ok THEN list_max({_PICK}) END AS last_page FROM (SELECT *, error IS NULL AND page_count IS NOT NULL AS ok FROM (SELECT *, {_LIST} AS error FROM (SELECT *, {_PARTS} AS parts FROM ({_ITEMS}))))",
        "selected_pages": f"""WITH i AS (SELECT *, {_PARTS} AS parts FROM ({_ITEMS}) WHERE page_count IS NOT NULL),
            s AS (SELECT item_id, unnest({_PICK}) AS page FROM i WHERE page_selection = 'specific' AND {_LIST} IS NULL),
            r AS (SELECT item_id, unnest(range(page_from::BIGINT, {_END}::BIGINT + 1)) AS page FROM i WHERE coalesce(page_selection, '') <> 'specific' AND {_RANGE} IS NULL) SELECT * FROM s UNION ALL SELECT * FROM r""",
        "slice_validate": f"""WITH r AS (SELECT DISTINCT ON (slice_id) * FROM slice_requests), i AS ({_ITEMS}),
            j AS (SELECT r.slice_id, r.page_from, r.page_to, r.max_output_bytes, r.slice_size_bytes, i.page_count, i.file_name FROM r LEFT JOIN i USING (item_id)),
            e AS (SELECT *, CASE WHEN NOT {_WHOLE.format(x='page_from', n=1)} THEN 'Page From must be an integer greater than 0' WHEN NOT {_WHOLE.format(x='page_to', n=1)} THEN 'Page To must be an integer greater than 0'
              WHEN page_to < page_from THEN 'Page To must be greater than or equal to Page From' WHEN page_from > page_count THEN 'Page From cannot exceed the document page count (' || page_count || ')'
              WHEN page_to > page_count THEN 'Page To cannot exceed the document page count (' || page_count || ')'
              WHEN max_output_bytes > 0 AND slice_size_bytes > max_output_bytes THEN 'Generated PDF slice is ' || slice_size_bytes || ' bytes and exceeds Max Output Bytes (' || max_output_bytes || ')' END AS error FROM j)
            SELECT slice_id, error, CASE WHEN error IS NULL THEN regexp_replace(CASE WHEN coalesce(file_name, '') = '' THEN 'document.pdf' ELSE file_name END, '(?i)\\.pdf\\z', '') || '-pages-' || page_from::BIGINT || '-' || page_to::BIGINT || '.pdf' END AS output_name,
            CASE WHEN error IS NULL THEN (page_to - page_from + 1)::BIGINT END AS n_pages FROM e""",
        "preflight_pages": _SCANNED + f"SELECT item_id, page::BIGINT AS page, mode AS recommended_mode, w AS word_count, {_FIXED4.format(x='c')} AS image_coverage FROM s",
        "preflight_document": _SCANNED
        + """, d AS (SELECT item_id, max(page_count) AS n, count(*) AS a, sum(CASE WHEN mode = 'ocr' THEN 1 ELSE 0 END) AS o, max(page) AS last, max(k) AS k, min(mode) AS lo, max(mode) AS hi FROM s GROUP BY item_id),
            z AS (SELECT *, coalesce(k > 0 AND o >= k AND last < n, false) AS stopped FROM d)
            SELECT item_id, n::BIGINT AS page_count, (a - o)::BIGINT AS native_pages, o::BIGINT AS ocr_pages, a::BIGINT AS analyzed_pages, CASE WHEN stopped THEN 'auto' WHEN lo = hi THEN lo ELSE 'auto' END AS recommended_mode, NOT stopped AS analysis_complete, stopped AS threshold_exceeded FROM z""",
        "route_auto": _ROUTED + "SELECT item_id, page::BIGINT AS page, source, md5(CASE WHEN source = 'ocr' THEN 'read: ' || t ELSE t END) AS digest, CASE WHEN source = 'ocr' THEN (length(t) % 100)::DOUBLE END AS confidence FROM r",
        "recognition_result": _ROUTED
        + """, d AS (SELECT item_id, CASE WHEN min(source) = max(source) THEN min(source) ELSE 'mixed' END AS source, max(page_count) AS n, max(page_selection) AS kind, list_sort(list(DISTINCT page)) AS asked, count(*) AS c FROM r GROUP BY item_id)
            SELECT item_id, source, n::BIGINT AS page_count, CASE WHEN kind <> 'specific' THEN asked[1]::BIGINT END AS range_from, CASE WHEN kind <> 'specific' THEN asked[len(asked)]::BIGINT END AS range_to, CASE WHEN kind = 'specific' THEN array_to_string(asked, ',') END AS selected, c::BIGINT AS n_pages, asked[1]::BIGINT AS first_page FROM d""",
        "context_projection": f"SELECT item_id, file_name, 3::BIGINT AS \"analyzedPageCount\" FROM ({_ITEMS})",
        "render_dimensions": f"SELECT p.item_id, p.page, ceil(p.width * (coalesce(i.dpi, 300)::DOUBLE / 72))::BIGINT AS width_px, ceil(p.height * (coalesce(i.dpi, 300)::DOUBLE / 72))::BIGINT AS height_px FROM page_operators p JOIN ({_ITEMS}) i USING (item_id)",
        "pdf_pages": f"SELECT item_id, page, page_count::BIGINT AS page_count, (199 + page)::DOUBLE AS width, (299 + page)::DOUBLE AS height, CASE WHEN (item_id + page) % 3 = 0 THEN '' ELSE 'Item ' || item_id || ' page ' || page END AS text, {_FIXED4.format(x='(15000.0::DOUBLE / ((199 + page) * (299 + page)))')} AS coverage FROM (SELECT item_id, page_count, unnest(range(1, page_count + 1)) AS page FROM ({_ITEMS}) WHERE page_count > 0)",
        "pdf_slice": f"""SELECT item_id, (page_count - 1)::BIGINT AS slice_pages, page_count::BIGINT AS source_pages, (page_count - 1)::BIGINT AS n_pages,
            md5(array_to_string([(p - 1) || ' ' || (199 + p) || ' ' || CASE WHEN (item_id + p) % 3 = 0 THEN '' ELSE 'Item ' || item_id || ' page ' || p END FOR p IN range(2, page_count + 1)], '|')) AS pages FROM ({_ITEMS}) WHERE page_count >= 2""",
        "slice_binaries": f"""WITH i AS (SELECT item_id, CASE WHEN coalesce(file_name, '') = '' THEN 'document.pdf' ELSE file_name END AS f, page_count, least(item_id % 4, page_count)::BIGINT AS b FROM ({_ITEMS}) WHERE page_count > 0),
            e AS (SELECT *, CASE WHEN item_id % 5 = 0 THEN 'Binary field "data" is missing' WHEN b = 0 THEN 'Failed to slice PDF pages 1-0: Page To must be an integer greater than 0' END AS error FROM i)
            SELECT item_id, error, CASE WHEN error IS NULL THEN regexp_replace(f, '(?i)\\.pdf\\z', '') || '-pages-1-' || b || '.pdf' END AS output_name, CASE WHEN error IS NULL THEN 'application/pdf' END AS mime_type, b AS n_pages, 0::BIGINT AS binaries_left, error IS NULL AS has_slice FROM e""",
        "preflight_context": _SCANNED
        + """, d AS (SELECT item_id, count(*) AS a, sum(CASE WHEN mode = 'ocr' THEN 1 ELSE 0 END) AS o, max(page) AS last, max(k) AS k, min(mode) AS lo, max(mode) AS hi FROM s GROUP BY item_id)
            SELECT i.item_id, i.file_name, i.page_count::BIGINT AS page_count, coalesce(o, 0)::BIGINT AS ocr_pages, CASE WHEN coalesce(k > 0 AND o >= k AND last < i.page_count, false) OR lo IS NULL OR lo <> hi THEN 'auto' ELSE lo END AS recommended_mode, coalesce(a, 0)::BIGINT AS n_pages FROM i LEFT JOIN d USING (item_id)""",
        "fail_fast": f"SELECT true AS failed, 'Failed to slice PDF pages 1-' || (page_count + 1) || ': Page To cannot exceed the document page count (' || page_count || ')' AS message FROM ({_ITEMS}) WHERE page_count > 0 ORDER BY item_id LIMIT 1",
        "map_limit": "SELECT (row_number() OVER (ORDER BY mix_name) - 1)::BIGINT AS place, upper(mix_name) AS name FROM (SELECT DISTINCT mix_name FROM mix_targets WHERE mix_name IS NOT NULL)",
        "recognize_documents": f"""WITH i AS (SELECT *, {_PARTS} AS parts FROM ({_ITEMS}) WHERE page_count > 0),
            e AS (SELECT *, CASE WHEN page_selection = 'specific' THEN {_LIST} ELSE {_RANGE} END AS error FROM (SELECT * REPLACE (coalesce(page_from, 1) AS page_from, coalesce(page_to, 0) AS page_to, coalesce(page_selection, 'range') AS page_selection, coalesce(recognition_mode, 'auto') AS recognition_mode) FROM i)),
            p AS (SELECT *, CASE WHEN error IS NULL THEN CASE WHEN page_selection = 'specific' THEN list_sort({_PICK}) ELSE range(page_from::BIGINT, {_END}::BIGINT + 1) END END AS asked FROM e),
            u AS (SELECT item_id, recognition_mode AS m, coalesce(ocr_language, 'deu') AS l, coalesce(dpi, 300) AS r, unnest(asked) AS g FROM p WHERE error IS NULL),
            w AS (SELECT *, CASE WHEN m IN ('native', 'ocr') THEN m WHEN (item_id + g) % 3 = 0 THEN 'ocr' ELSE 'native' END AS source, ceil((199 + g) * (r::DOUBLE / 72))::BIGINT AS x, ceil((299 + g) * (r::DOUBLE / 72))::BIGINT AS y FROM u),
            z AS (SELECT item_id, CASE WHEN min(source) = max(source) THEN min(source) ELSE 'mixed' END AS source, count(*) AS n,
              md5(string_agg(g || ' ' || source || ' ' || CASE WHEN source = 'ocr' THEN l || ' ' || x || 'x' || y || ' at ' || r || ' ' || (50 + x % 50) WHEN (item_id + g) % 3 = 0 THEN '' ELSE 'Item ' || item_id || ' page ' || g END, '|' ORDER BY g)) AS pages FROM w GROUP BY item_id)
            SELECT p.item_id, p.error, z.source, CASE WHEN p.error IS NULL THEN p.page_count::BIGINT END AS page_count, z.n::BIGINT AS n_pages, z.pages FROM p LEFT JOIN z USING (item_id)""",
    }
    return sql
