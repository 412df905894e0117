"""The same results in plain SQL, for a single-node engine.

Written from the definition of each step (windows over whole documents,
ordinary joins), not from the way the Spark steps split the work.
"""

import re

from checks.tables import CHARS_DUCKDB, LINES_DUCKDB

AXES = [f"z{i}" for i in range(7)]
VECTOR = ["font_size", "indentation", "is_bold", "centering_offset", "word_count", "y_coordinate", "ratio"]
EDGE = r"[^\p{L}\p{N}_]"

CTES = {
    "lines": LINES_DUCKDB,
    "chars": CHARS_DUCKDB,
    "styles": """
        SELECT document_name, page_number, line_no, fontname, fontsize FROM (
          SELECT *, row_number() OVER (PARTITION BY document_name, page_number, line_no ORDER BY n DESC, met) AS r FROM (
            SELECT document_name, page_number, line_no, fontname, round_even(size, 2) AS fontsize,
                   count(*) AS n, min(char_idx) AS met
            FROM chars GROUP BY ALL)) WHERE r = 1""",
    "nonblank": """
        SELECT * REPLACE (trim(text, ' ' || chr(9) || chr(10) || chr(13)) AS text) FROM lines
        WHERE trim(text, ' ' || chr(9) || chr(10) || chr(13)) <> ''""",
    # The keywords and what is trimmed off them, here and in "opened".
    "worded": "SELECT *, trim(lower(split_part(text, ' ', 1)), '•*: ') AS first_word FROM nonblank",
    "opened": """
        SELECT *, coalesce(prev_font IS NOT NULL AND (prev_font <> fontname OR prev_size <> fontsize), false) AS style_change,
               CASE WHEN prev_font IS NULL THEN 0
                    WHEN prev_font <> fontname OR prev_size <> fontsize
                      OR first_word IN ('introduction', 'overview', 'methodology', 'appendix') THEN 1 ELSE 0 END AS opens
        FROM (SELECT *, lag(fontname) OVER w AS prev_font, lag(fontsize) OVER w AS prev_size FROM worded
              WINDOW w AS (PARTITION BY document_name, page_number ORDER BY line_no))""",
    "numbered": """
        SELECT *, CAST(sum(opens) OVER (PARTITION BY document_name, page_number ORDER BY line_no
                                        ROWS UNBOUNDED PRECEDING) AS INT) AS block_no FROM opened""",
    "raw": """
        SELECT document_name, page_number, block_no, CAST(page_number AS BIGINT) * 4294967296 + block_no AS seq,
               string_agg(text, chr(10) ORDER BY line_no) AS text,
               arg_max(fontname, line_no) AS fontname, arg_max(fontsize, line_no) AS fontsize,
               min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1,
               max(page_width) AS page_width, max(page_height) AS page_height
        FROM numbered GROUP BY document_name, page_number, block_no""",
    "featured": """
        SELECT document_name, page_number, block_no, seq, text, fontname, fontsize,
               fontsize AS font_size, round_even(x0, 2) AS indentation,
               CAST(contains(lower(fontname), 'bold') AS INT) AS is_bold, round_even(y1, 2) AS y_coordinate,
               round_even(abs(x0 + (x1 - x0) / 2 - page_width / 2), 2) AS centering_offset,
               CAST(len(regexp_extract_all(text, '[^\\s]+')) AS INT) AS word_count
        FROM raw""",
    "blocks": """
        SELECT *, CASE WHEN font_size > 0 THEN round_even(indentation / font_size, 3) ELSE 0 END AS ratio FROM featured""",
    # Patterns, limits and points, here and in "scored", "rule_named" and "final".
    "judged": rf"""
        SELECT *, page_hit OR date_hit OR toc_hit OR cite_hit OR punct_hit OR symbol_hit AS rejected FROM (
          SELECT *,
            regexp_matches(text, '^(page|pg\.?)\s+\d+(\s+of\s+\d+)?$', 'i') AS page_hit,
            length(text) > 5 AND length(regexp_replace(text, '\P{{P}}', '', 'g')) / length(text) >= 0.8 AS punct_hit,
            regexp_full_match(text, '[\d\s.\-/:()]+') AS symbol_hit,
            regexp_matches(text, '(^|{EDGE})(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*($|{EDGE})', 'i')
              OR regexp_matches(text, '(^|{EDGE})\d{{1,2}}[/-]\d{{1,2}}[/-]\d{{2,4}}($|{EDGE})') AS date_hit,
            (regexp_matches(text, '\.{{3,}}') AND regexp_matches(text, '\d\s*$'))
              OR regexp_matches(text, '(section|chapter|\d+\.?\d*)\s+[^\n]*\.{{3,}}[^\n]*\d+', 'i') AS toc_hit,
            starts_with(text, '[') AND contains(text, ']') AND (
              regexp_matches(text, '^\[[A-Za-z0-9_-]+\]') OR regexp_matches(text, '^\[\d+\]')
              OR regexp_matches(text, '^\[[A-Za-z]+[^\n]*\d{{4}}[^\n]*\]')) AS cite_hit,
            NOT regexp_matches(regexp_extract(text, '(\p{{L}})', 1), '^\p{{Ll}}') AS valid_start,
            regexp_extract(text, '^(\d+(\.\d+){{0,2}})\s+', 1) AS number_prefix,
            CASE WHEN number_prefix <> '' THEN 'H' || (length(number_prefix) - length(replace(number_prefix, '.', '')) + 1) END AS level,
            regexp_matches(text, '\p{{Lu}}') AND NOT regexp_matches(text, '[\p{{Ll}}\p{{Lt}}]') AS upper_hit,
            regexp_full_match(text, '[\p{{L}}\p{{N}}]+') AS alnum_hit
          FROM blocks)""",
    "style": """
        SELECT document_name, count(*) AS n_blocks, stddev_pop(fontsize) AS size_std, count(DISTINCT fontsize) AS n_sizes,
               count(*) >= 10 AND (stddev_pop(fontsize) < 0.5 OR count(DISTINCT fontsize) <= 2) AS is_uniform
        FROM blocks GROUP BY document_name""",
    "ruled": "SELECT j.* FROM judged j JOIN style USING (document_name) WHERE is_uniform",
    "varied": "SELECT j.* FROM judged j JOIN style USING (document_name) WHERE NOT is_uniform",
    "ordered": """
        SELECT *, row_number() OVER (PARTITION BY document_name ORDER BY page_number, y_coordinate DESC, seq) - 1 AS i,
               CASE WHEN lag(y_coordinate) OVER w IS NULL THEN 100.0
                    ELSE greatest(0, lag(y_coordinate) OVER w - y_coordinate) END AS space_before
        FROM ruled WINDOW w AS (PARTITION BY document_name, page_number ORDER BY y_coordinate DESC, seq)""",
    "scored": """
        SELECT *, page_hit OR (word_count = 1 AND NOT alnum_hit) AS noise,
               CASE WHEN is_bold = 1 THEN 3 ELSE 0 END + CASE WHEN upper_hit AND word_count > 1 THEN 1 ELSE 0 END
               + CASE WHEN space_before > 25 THEN 2 WHEN space_before > 15 THEN 1 ELSE 0 END
               + CASE WHEN word_count < 10 THEN 2 WHEN word_count < 20 THEN 1 ELSE 0 END
               + CASE WHEN level IS NOT NULL THEN 4 ELSE 0 END AS heading_score
        FROM ordered""",
    "rule_named": """
        SELECT *, CASE WHEN noise THEN 'Noise' WHEN i = 0 AND word_count < 25 THEN 'Title'
                       WHEN heading_score >= 7 THEN 'H1' WHEN heading_score >= 5 THEN 'H2' WHEN heading_score >= 3 THEN 'H3'
                       ELSE 'Body' END AS label
        FROM scored""",
    "scaled": f"""
        SELECT v.document_name, v.seq, v.fontsize, n,
               {", ".join(f"floor((v.{c} - m.m{i}) / (CASE WHEN m.s{i} = 0 THEN 1 ELSE m.s{i} END) * 100000 + 0.5) AS z{i}" for i, c in enumerate(VECTOR))}
        FROM varied v JOIN (SELECT document_name, count(*) AS n,
               {", ".join(f"avg({c}) AS m{i}, round(stddev_pop({c}), 9) AS s{i}" for i, c in enumerate(VECTOR))}
               FROM varied GROUP BY document_name) m USING (document_name)""",
    "centers_1": f"SELECT document_name, 0 AS k, {', '.join(f'arg_max(z{i}, (fontsize, -seq)) AS z{i}' for i in range(7))} FROM scaled GROUP BY document_name",
    "grouped": """
        SELECT v.*, a.k AS cluster_label FROM varied v JOIN assigned a USING (document_name, seq)""",
    "fonts": "SELECT document_name, cluster_label, round(avg(fontsize), 6) AS mean_size FROM grouped GROUP BY ALL",
    "ranks": """
        SELECT *, CAST(row_number() OVER (PARTITION BY document_name ORDER BY mean_size DESC, cluster_label) AS INT) AS size_rank FROM fonts""",
    "cluster_named": """
        SELECT g.*, coalesce((['Title', 'H1', 'H2', 'H3', 'Body'])[size_rank], 'Body') AS label
        FROM grouped g JOIN ranks USING (document_name, cluster_label)""",
    "labelled": """
        SELECT document_name, page_number, seq, text, word_count, rejected, level, valid_start, label, i AS place
        FROM rule_named WHERE NOT noise
        UNION ALL
        SELECT document_name, page_number, seq, text, word_count, rejected, level, valid_start, label, seq AS place
        FROM cluster_named""",
    "texts": "SELECT document_name, text, count(DISTINCT page_number) AS n_pages FROM labelled GROUP BY document_name, text",
    "keys": "SELECT document_name, CASE WHEN length(text) <= 64 THEN text ELSE sha256(text) END AS text_key, n_pages FROM texts",
    "dismissed": """
        SELECT l.*, n_pages > 2 AS repeated, n_pages > 2 OR rejected AS out_of_question,
               CASE WHEN n_pages > 2 OR rejected THEN 'Body' ELSE coalesce(level, label) END AS label_2
        FROM labelled l JOIN texts USING (document_name, text)""",
    "titled": """
        SELECT *, CASE WHEN label_2 = 'Title' AND sum(CASE WHEN label_2 = 'Title' THEN 1 ELSE 0 END) OVER
                         (PARTITION BY document_name ORDER BY place ROWS UNBOUNDED PRECEDING) > 1
                       THEN 'H1' ELSE label_2 END AS label_3 FROM dismissed""",
    "final": """
        SELECT *, CASE WHEN label_3 <> 'Body' AND (word_count > 15 OR NOT valid_start) THEN 'Body' ELSE label_3 END AS label_4
        FROM titled""",
    "titles": """
        SELECT document_name, arg_min(text, (page_number, place)) AS title FROM final WHERE label_4 = 'Title' GROUP BY document_name""",
    "outlines": """
        SELECT document_name, coalesce(any_value(title), 'Untitled Document') AS title,
               coalesce(list({'level': label_4, 'text': text, 'page': page_number} ORDER BY page_number, place)
                        FILTER (WHERE label_4 IN ('H1', 'H2', 'H3')), []) AS outline
        FROM final LEFT JOIN titles USING (document_name) GROUP BY document_name""",
}

SQUARES = " + ".join(f"(p.{a} - c.{a}) * (p.{a} - c.{a})" for a in AXES)
for j in range(1, 5):
    CTES[f"seed_{j}"] = f"""
        SELECT document_name, {j} AS k, {', '.join(AXES)} FROM (
          SELECT *, row_number() OVER (PARTITION BY document_name ORDER BY d DESC, seq) AS r FROM (
            SELECT p.document_name, p.seq, {', '.join(f'p.{a}' for a in AXES)}, min({SQUARES}) AS d
            FROM scaled p JOIN centers_{j} c USING (document_name) WHERE p.n > {j} GROUP BY ALL)) WHERE r = 1"""
    CTES[f"centers_{j + 1}"] = f"SELECT * FROM centers_{j} UNION ALL SELECT * FROM seed_{j}"
APART = " + ".join(f"(p.{a} - c[{i + 1}]) * (p.{a} - c[{i + 1}])" for i, a in enumerate(AXES))
NEAREST = f"list_transform(centers, lambda c: {APART})"
CTES["steps"] = f"""
    SELECT document_name, list([{', '.join(AXES)}] ORDER BY k) AS centers, 0 AS t, true AS moves,
           [list([{', '.join(AXES)}] ORDER BY k)] AS seen FROM centers_5 GROUP BY document_name
    UNION ALL
    SELECT document_name, next AS centers, t + 1 AS t, NOT list_contains(seen, next) AS moves, list_append(seen, next) AS seen FROM (
      SELECT document_name, any_value(t) AS t, any_value(seen) AS seen,
             list_transform(range(1, len(any_value(centers)) + 1), lambda j: coalesce(map_from_entries(list((k, mean)))[j], any_value(centers)[j])) AS next
      FROM (SELECT document_name, k, any_value(t) AS t, any_value(seen) AS seen, any_value(centers) AS centers,
                   [{', '.join(f'floor(sum({a}) / count(*) + 0.5)' for a in AXES)}] AS mean
            FROM (SELECT p.*, t, seen, centers, list_position({NEAREST}, list_min({NEAREST})) AS k
                  FROM scaled p JOIN steps USING (document_name) WHERE moves) GROUP BY document_name, k) GROUP BY document_name)"""
CTES["settled"] = "SELECT document_name, arg_max(centers, t) AS centers FROM steps GROUP BY document_name"
CTES["assigned"] = f"""
    SELECT document_name, seq, CAST(list_position({NEAREST}, list_min({NEAREST})) - 1 AS INT) AS k
    FROM scaled p JOIN settled USING (document_name)"""


#: Queries whose result plain SQL cannot express: tests hold them against what must be true of it.
WITHOUT_SQL = ("corpus_model",)


def sql(select: str) -> str:
    """The statement with the common tables it needs, in order of need."""
    needed: list[str] = []
    open_names: list[str] = []  # a recursive table names itself

    def visit(text):
        for name in re.findall(r"\b(?:FROM|JOIN)\s+(\w+)", text):
            if name in CTES and name not in needed and name not in open_names:
                open_names.append(name)
                visit(CTES[name])
                open_names.remove(name)
                needed.append(name)

    visit(select)
    tables = ",\n".join(f"{name} AS {'' if name == 'steps' else 'MATERIALIZED '}({CTES[name]})" for name in needed)
    return f"WITH RECURSIVE {tables}\n{select}" if needed else select


BLOCK = "document_name, page_number, seq"
FEATURES = "font_size, indentation, is_bold, y_coordinate, centering_offset, word_count"
JSON_OUTLINE = "to_json({'title': title, 'outline': outline})"


def hit(column: str, name: str) -> str:
    return f"SELECT document_name, seq, {column} AS {name} FROM judged"


SELECTS = {
    "document_name": r"""
        SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN concat('doc_', doc_id) WHEN 1 THEN concat('doc.v2_', doc_id)
                       WHEN 2 THEN concat('.doc_', doc_id) ELSE concat('doc_', doc_id) END AS document_name FROM documents""",
    "read_blocks": f"SELECT {BLOCK}, block_no AS position, text, fontname, fontsize, {FEATURES} FROM (SELECT * REPLACE (row_number() OVER (PARTITION BY document_name ORDER BY seq) - 1 AS block_no) FROM blocks) WHERE CAST(replace(document_name, 'doc_', '') AS BIGINT) % 7 NOT IN (0, 3, 5)",
    "read_large_blocks": f"SELECT {BLOCK}, block_no AS position, text, fontname, fontsize, {FEATURES} FROM (SELECT * REPLACE (row_number() OVER (PARTITION BY document_name ORDER BY seq) - 1 AS block_no) FROM blocks) WHERE CAST(replace(document_name, 'doc_', '') AS BIGINT) % 7 NOT IN (0, 3, 5)",
    "reject_malformed": """
        SELECT document_name, CASE n WHEN 0 THEN 'not a JSON block array' WHEN 3 THEN 'no fontsize' ELSE 'wrong fontsize' END AS reason
        FROM (SELECT DISTINCT document_name, CAST(replace(document_name, 'doc_', '') AS BIGINT) % 7 AS n FROM blocks) WHERE n IN (0, 3, 5)""",
    "discover_documents": " UNION ALL ".join(
        f"SELECT '{t}.parquet' AS filename, '{t}' AS document_name, count(*) AS n_rows FROM {t}"
        for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
    ),
    "rejects": "SELECT document_name, 'no y1' AS reason, count(*) AS n_lines FROM lines WHERE CAST(replace(document_name, 'doc_', '') AS BIGINT) % 11 = 0 AND line_no = 0 GROUP BY document_name",
    "write_stage": f"SELECT {BLOCK}, text, fontname, fontsize, {FEATURES} FROM blocks",
    "skipped_documents": "SELECT DISTINCT document_name FROM lines WHERE CAST(replace(document_name, 'doc_', '') AS BIGINT) % 11 < 2",
    "run_report": """
        SELECT d.document_name, coalesce(n_lines, 0) AS n_lines, coalesce(n_blocks, 0) AS n_blocks,
               coalesce(n_labelled, 0) AS n_labelled, coalesce(n_headings, 0) AS n_headings,
               CASE WHEN n_lines IS NULL THEN 'no lines' WHEN n_blocks IS NULL THEN 'no blocks'
                    WHEN n_labelled IS NULL THEN 'nothing but noise' WHEN n_headings = 0 THEN 'no headings' ELSE 'done' END AS status
        FROM (SELECT DISTINCT concat('doc_', doc_id) AS document_name FROM documents) d
        LEFT JOIN (SELECT document_name, count(*) AS n_lines FROM lines GROUP BY 1) a USING (document_name)
        LEFT JOIN (SELECT document_name, count(*) AS n_blocks FROM blocks GROUP BY 1) b USING (document_name)
        LEFT JOIN (SELECT document_name, count(*) AS n_labelled FROM final GROUP BY 1) c USING (document_name)
        LEFT JOIN (SELECT document_name, count(*) FILTER (WHERE label_4 IN ('H1', 'H2', 'H3')) AS n_headings FROM final GROUP BY 1) e USING (document_name)""",
    "outline_json": f"SELECT document_name, concat(document_name, '_output.json') AS output_name, CAST({JSON_OUTLINE} AS VARCHAR) AS value FROM outlines",
    "outline_wrapped": f"""
        SELECT document_name, concat(document_name, '.pdf') AS filename, document_name AS base_name,
               'parsing,build_vectors,cluster_and_label,generate_outline' AS pipeline_stages,
               CAST({JSON_OUTLINE} AS VARCHAR) AS outline FROM outlines""",
    "line_style": "SELECT * FROM styles",
    "line_style_default": """
        SELECT document_name, page_number, line_no, coalesce(s.fontname, 'Unknown') AS fontname, coalesce(s.fontsize, 0.0) AS fontsize
        FROM (SELECT document_name, page_number, line_no FROM lines) l LEFT JOIN styles s USING (document_name, page_number, line_no)""",
    "nonblank_lines": "SELECT document_name, page_number, line_no, text FROM nonblank WHERE line_no % 5 <> 4",
    "first_word": "SELECT document_name, page_number, line_no, first_word FROM worded",
    "keyword_start": "SELECT document_name, page_number, line_no, first_word IN ('introduction', 'overview', 'methodology', 'appendix') AS keyword_start FROM worded",
    "style_change": "SELECT document_name, page_number, line_no, style_change FROM opened",
    "block_id": "SELECT document_name, page_number, line_no, block_no FROM numbered",
    "block_text": f"SELECT {BLOCK}, text FROM raw",
    "block_bbox": f"SELECT {BLOCK}, x0, y0, x1, y1 FROM raw",
    "block_style": f"SELECT {BLOCK}, fontname, fontsize FROM raw",
    "blocks_raw": f"SELECT {BLOCK}, row_number() OVER (PARTITION BY document_name ORDER BY seq) - 1 AS position, text, fontname, fontsize, x0, y0, x1, y1, page_width, page_height FROM raw",
    "block_features": f"SELECT {BLOCK}, is_bold, word_count, centering_offset, indentation, y_coordinate, font_size FROM featured",
    "featured_blocks": f"SELECT {BLOCK}, text, fontname, fontsize, {FEATURES} FROM featured",
    "feature_defaults": f"""
        SELECT {BLOCK}, CASE WHEN block_no % 2 = 0 THEN 0 ELSE font_size END AS v0, indentation AS v1, CAST(is_bold AS DOUBLE) AS v2,
               CASE WHEN block_no % 2 = 0 THEN 999 ELSE centering_offset END AS v3, CAST(word_count AS DOUBLE) AS v4,
               CASE WHEN block_no % 2 = 0 THEN 0 ELSE y_coordinate END AS v5, CASE WHEN block_no % 2 = 0 THEN 0 ELSE ratio END AS v6 FROM blocks""",
    "indent_ratio": f"SELECT {BLOCK}, CASE WHEN font_size > 0 THEN indentation / font_size ELSE 0 END AS indent_ratio FROM blocks",
    "feature_vectors": f"SELECT {BLOCK}, {', '.join(f'CAST({c} AS DOUBLE) AS v{i}' for i, c in enumerate(VECTOR))} FROM blocks",
    "is_page_number": hit("page_hit", "is_page_number"),
    "is_mostly_punct": hit("punct_hit", "is_mostly_punct"),
    "is_symbols_digits": hit("symbol_hit", "is_symbols_digits"),
    "is_date": hit("date_hit", "is_date"),
    "is_toc_entry": hit("toc_hit", "is_toc_entry"),
    "is_citation": hit("cite_hit", "is_citation"),
    "valid_heading_start": hit("valid_start", "valid_heading_start"),
    "numbering_level": hit("level", "numbering_level"),
    "is_upper": hit("upper_hit", "is_upper"),
    "is_alnum": hit("alnum_hit", "is_alnum"),
    "style_uniform": "SELECT document_name, n_blocks, round(size_std, 6) AS size_std, n_sizes, is_uniform FROM style",
    "route_documents": "SELECT document_name, seq, is_uniform FROM blocks JOIN style USING (document_name)",
    "rule_order": "SELECT document_name, seq, i AS position FROM ordered",
    "space_before": "SELECT document_name, seq, round(space_before, 6) AS space_before FROM ordered",
    "drop_noise": "SELECT document_name, seq, text FROM rule_named WHERE NOT noise",
    "heading_score": """
        SELECT document_name, seq, heading_score + CASE WHEN block_no % 3 = 0 THEN 3 ELSE 0 END + CASE WHEN block_no % 4 = 0 THEN 3 ELSE 0 END
               + CASE WHEN block_no % 5 = 0 THEN 3 ELSE 0 END AS heading_score FROM scored""",
    "score_label": "SELECT document_name, seq, CASE WHEN heading_score >= 7 THEN 'H1' WHEN heading_score >= 5 THEN 'H2' WHEN heading_score >= 3 THEN 'H3' ELSE 'Body' END AS score_label FROM scored",
    "rule_labels": "SELECT document_name, seq, text, label AS predicted_label FROM rule_named WHERE NOT noise",
    "cluster_k": "SELECT document_name, CAST(least(count(*), 5) AS INT) AS k FROM varied GROUP BY document_name",
    "scaled_features": f"SELECT document_name, seq, {', '.join(AXES)} FROM scaled",
    "document_kmeans": "SELECT document_name, seq, k AS cluster_label FROM assigned",
    "clustering_state": f"""
        SELECT document_name, count(*) AS n_blocks, count(DISTINCT own_k) AS n_clusters, CAST(count(*) FILTER (nearest < own) AS BIGINT) AS n_moved,
               round(sum(own) / 100000 / 100000, 4) AS inertia
        FROM (SELECT p.document_name, p.seq, a.k AS own_k, min({SQUARES}) AS nearest, min({SQUARES}) FILTER (c.k = a.k) AS own
              FROM scaled p JOIN assigned a USING (document_name, seq)
              JOIN (SELECT document_name, k, {", ".join(f"avg({x}) AS {x}" for x in AXES)}
                    FROM scaled JOIN assigned USING (document_name, seq) GROUP BY document_name, k) c ON c.document_name = p.document_name
              GROUP BY p.document_name, p.seq, a.k)
        GROUP BY document_name""",
    "accounted_rows": """
        SELECT 'lines' AS stage, 'rows' AS counted, (SELECT count(*) FROM lines) AS n
        UNION ALL SELECT 'lines', 'nonblank', (SELECT count(*) FROM nonblank) UNION ALL SELECT 'blocks', 'lines', (SELECT count(*) FROM nonblank)
        UNION ALL SELECT s, 'rows', (SELECT count(*) FROM blocks) FROM (SELECT unnest(['blocks', 'routed', 'scored']) AS s)
        UNION ALL SELECT 'routed', 'uniform', (SELECT count(*) FROM ruled) UNION ALL SELECT 'clusters', 'rows', (SELECT count(*) FROM varied)
        UNION ALL SELECT 'scored', 'noise', (SELECT count(*) FROM rule_named WHERE noise) UNION ALL SELECT 'labels', 'rows', (SELECT count(*) FROM final)
        UNION ALL SELECT 'labels', 'documents', (SELECT count(DISTINCT document_name) FROM final) UNION ALL SELECT 'outlines', 'rows', (SELECT count(*) FROM outlines)
        UNION ALL SELECT 'outlines', 'headings', (SELECT CAST(sum(len(outline)) AS BIGINT) FROM outlines)""",
    "cluster_font": "SELECT * FROM fonts",
    "cluster_rank": "SELECT * FROM ranks",
    "cluster_labels": "SELECT document_name, seq, cluster_label, label AS predicted_label FROM cluster_named",
    "text_pages": "SELECT * FROM keys",
    "repeating_text": "SELECT document_name, text_key FROM keys WHERE n_pages > 2",
    "reject_non_headings": "SELECT document_name, seq, repeated, out_of_question AS dismissed FROM dismissed",
    "numbering_override": "SELECT document_name, seq, label_2 AS predicted_label FROM dismissed",
    "single_title": "SELECT document_name, seq, label_3 AS predicted_label FROM titled",
    "demote_headings": "SELECT document_name, seq, label_4 AS predicted_label FROM final",
    "post_process": "SELECT document_name, page_number, seq, text, label_4 AS predicted_label FROM final",
    "outline_order": "SELECT document_name, seq, row_number() OVER (PARTITION BY document_name ORDER BY page_number, place) - 1 AS position FROM final",
    "document_title": "SELECT document_name, title FROM outlines",
    "headings": "SELECT document_name, seq, label_4 AS level, text, page_number AS page FROM final WHERE label_4 IN ('H1', 'H2', 'H3')",
    "document_outline": f"SELECT document_name, title, len(outline) AS n_headings, CAST({JSON_OUTLINE} AS VARCHAR) AS outline FROM outlines",
    "streamed_outlines": f"SELECT document_name, title, len(outline) AS n_headings, CAST({JSON_OUTLINE} AS VARCHAR) AS outline FROM outlines",
    "updated_outlines": f"SELECT document_name, title, len(outline) AS n_headings, CAST({JSON_OUTLINE} AS VARCHAR) AS outline FROM outlines",
    "resumed_outlines": f"SELECT document_name, title, len(outline) AS n_headings, CAST({JSON_OUTLINE} AS VARCHAR) AS outline FROM outlines",
    "empty_outlines": "SELECT document_name, len(outline) AS n_headings FROM outlines WHERE len(outline) = 0",
    "outlines_end_to_end": f"SELECT document_name, title, CAST({JSON_OUTLINE} AS VARCHAR) AS outline FROM outlines",
}
