"""SQL for every registered query."""

from __future__ import annotations

from checks import oracle as o
from spolia.config import MS_LEN, TOKEN_CLASS

_COPIES = "generate_series(1, CASE WHEN uid1 > uid2 THEN 2 ELSE 1 END)"
_OVERLAP = f"replace(text, {o.NL}, ' mms12s34' || {o.NL})"
_RESIDUE = rf"""regexp_replace(rtrim(ltrim({_OVERLAP}, chr(10)), {o.WS}), '{o.SPACED}', '', 'g')"""
_CLEAN = r"""regexp_replace(regexp_replace(translate(regexp_replace(translate({}, 'إأٱآ', 'اااا'), '[يى]ء', 'ئ', 'g'),
  'ىؤئ', 'يءء'), '[^\p{{L}}\p{{N}}_]+|[a-zA-Z0-9]+', ' ', 'g'), ' +', ' ', 'g')"""
_TAGGED = f"tagged AS (SELECT file_name, string_agg(text || ' ' || ms_label, '' ORDER BY n) AS tagged FROM labelled GROUP BY file_name)"
_JOINED = (
    "joined AS (SELECT a.*, o1.ch_offset AS ch_offset1, o2.ch_offset AS ch_offset2 FROM alignments a "
    "JOIN offsets o1 ON o1.sid = T1 AND o1.seq = seq1 JOIN offsets o2 ON o2.sid = T2 AND o2.seq = seq2)"
)
_MIRROR = o.mirrored(o.STAT_COLUMNS)
_STAT_LIST = ", ".join(o.STAT_COLUMNS)
_BOTH = f"SELECT {_STAT_LIST} FROM stats UNION ALL SELECT {_STAT_LIST} FROM (SELECT {_MIRROR} FROM stats)"
_CLEANED = [
    o.ALIGNMENTS.replace("alignments AS (\n  SELECT *,", "alignments0 AS (\n  SELECT *,"),
    f"""alignments AS (SELECT * FROM (SELECT * REPLACE (CASE WHEN trim(replace(s1, {o.NL}, ' ')) <> '' THEN score END AS score)
      FROM alignments0) WHERE score IS NOT NULL)""",
]
_FULL = [o.ALIGNMENTS, o.RECORDS, o.OFFSETS, o.BOOK_META, o.words(1), o.words(2), o.CHARS, o.WM_SETS, o.CM_SETS, o.SUMMARY, o.PAIR_META]
_FULL_FROM = "FROM pair_meta JOIN wm1 USING (T1, T2) JOIN wm2 USING (T1, T2) JOIN cm USING (T1, T2)"
_MS = [o.FILES, o.MILESTONES, o.LABELS]
_PAIRS = "pairs AS (SELECT DISTINCT T1, T2 FROM alignments)"
_KEYS = "uid1, uid2, b1, b2, T1 AS _T1, T2 AS _T2, CAST(seq1 AS BIGINT) AS seq1, CAST(seq2 AS BIGINT) AS seq2"
_MERGED_TAGGED = o.MERGED.replace("merged AS", "merged AS").replace("|| text ||", "|| tagged ||").replace(
    "FROM chosen", "FROM chosen JOIN tagged USING (file_name) JOIN vmeta ON vmeta.id = version AND status = 'pri'"
)


def expected() -> dict[str, str]:
    q = o.query
    return {
        "uri_parse": q(o.FILES, select="""SELECT file_name, author, title, book_uri, series, version, part, 'eng1' AS lang,
            ext, lang_ext, version || coalesce(part, '') AS short_id FROM files"""),
        "name_filter": q(o.FILES, select="SELECT doc_id, file_name FROM files WHERE doc_lang <> 'fr'"),
        "header_split": q(o.FILES, select=f"""SELECT file_name, '######Text#' AS header,
            {o.NL} || {o.NL} || '#META#Header#End#' || {o.NL} || {o.NL} ||
              repeat({o.NL}, CAST(length(text) - length(ltrim(text, {o.NL})) AS BIGINT)) AS marker,
            ltrim(text, {o.NL}) || {o.NL} AS body FROM files"""),
        "primary_filter": q(o.FILES, o.VERSION_META, select="""SELECT file_name, version FROM files
            WHERE version IN (SELECT id FROM vmeta WHERE status = 'pri')"""),
        "select_version": q(o.FILES, o.CHOSEN, select=f"""SELECT file_name, ext, part,
            '######Text#' || {o.NL} || {o.NL} || '#META#Header#End#' || {o.NL} || {o.NL} || text || {o.NL} AS value FROM chosen"""),
        "version_per_folder": q(o.FILES, select=f"""SELECT 'f' || (doc_id % 3) || '/' || file_name AS path,
            '######Text#' || {o.NL} || {o.NL} || '#META#Header#End#' || {o.NL} || {o.NL} || text || {o.NL} AS value FROM (
              SELECT *, row_number() OVER (PARTITION BY doc_id % 3, book_uri, version, part ORDER BY
                CASE ext WHEN 'mARkdown' THEN 1 WHEN 'completed' THEN 2 WHEN 'inProgress' THEN 3 ELSE 4 END) AS rk FROM files) WHERE rk = 1"""),
        "export_rejects": q(o.FILES, o.CHOSEN, select="""SELECT file_name,
            CASE WHEN doc_lang = 'fr' THEN 'missing splitter' ELSE 'other part rejected' END AS reason FROM chosen c
            WHERE doc_lang = 'fr' OR part IS NOT NULL AND EXISTS (SELECT 1 FROM chosen p WHERE p.book_uri = c.book_uri
              AND p.version = c.version AND p.part IS NOT NULL AND p.doc_lang = 'fr')"""),
        "milestones_default": rf"""
            WITH pieces AS (SELECT doc_id, unnest(ps) AS piece, generate_subscripts(ps, 1) AS pos FROM (
                SELECT doc_id, regexp_extract_all(translate(text, 'aeiounsrtdlhmcbgpvyw', 'إيءىأؤئآلدلهمكبـغَُِ'),
                  '[{o.WORD}]+|[^{o.WORD}]+') AS ps FROM documents)),
              placed AS (SELECT *, 1 + CAST(floor(coalesce(sum(CASE WHEN regexp_matches(piece, '[{TOKEN_CLASS}]') THEN 1 ELSE 0 END)
                OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) / {MS_LEN}) AS BIGINT) AS n FROM pieces)
            SELECT doc_id, n, string_agg(piece, '' ORDER BY pos) AS text FROM placed GROUP BY doc_id, n""",
        "merge_parts": q(o.FILES, o.CHOSEN, o.MERGED, select="SELECT series, book_uri, version, body FROM merged"),
        "corpus_log": q(o.FILES, o.CHOSEN, select="""SELECT series AS book_id,
            CASE WHEN series IN (SELECT series FROM files WHERE ext IS NULL AND part IS NULL
              AND doc_id IN (SELECT doc_id FROM labels)) THEN 0 ELSE 1 END AS write_status FROM chosen"""),
        "skip_existing": q(o.FILES, select="""SELECT series, file_name FROM files WHERE series NOT IN (
            SELECT series FROM files WHERE ext IS NULL AND part IS NULL AND doc_id IN (SELECT doc_id FROM labels))"""),
        "strip_milestones": rf"""SELECT doc_id, regexp_replace(rtrim(replace(text, {o.NL}, ' ms12' || {o.NL}) || '  msA013', {o.WS}),
            '{o.SPACED}', '', 'g') AS body FROM documents""",
        "residual_tags": rf"""SELECT doc_id, CAST(len(regexp_extract_all(
            regexp_replace(rtrim({_OVERLAP}, {o.WS}), '{o.SPACED}', '', 'g'), '{o.TAG}')) AS INTEGER) AS left_over FROM documents""",
        "tokenize_counts": rf"""SELECT doc_id, CAST(len(ps) AS INTEGER) AS pieces,
            CAST(len(list_filter(ps, lambda x: regexp_matches(x, '[\p{{L}}]'))) AS INTEGER) AS relevant,
            CAST(len(regexp_extract_all(text, '[\p{{L}}]+')) AS INTEGER) AS tokens, CAST(length(text) AS INTEGER) AS chars
            FROM (SELECT doc_id, text, regexp_extract_all(text, '[{o.WORD}]+|[^{o.WORD}]+') AS ps FROM documents)""",
        "token_rows": q(o.FILES, o.MILESTONES, select=r"""SELECT piece, regexp_matches(piece, '[\p{L}]') AS relevant,
            count(*) AS n, CAST(min(pos) - 1 AS INTEGER) AS first_pos FROM pieces GROUP BY piece"""),
        "assign_milestones": q(o.FILES, o.MILESTONES, select="""SELECT file_name, n, text,
            CAST(relevant AS INTEGER) AS relevant FROM ms"""),
        "range_milestones": q(o.FILES, o.MILESTONES, select="""SELECT file_name, n, text,
            CAST(relevant AS INTEGER) AS relevant FROM ms"""),
        "milestone_labels": q(*_MS, select="SELECT file_name, n, ms_label FROM labelled"),
        "continue_numbering": q(*_MS, select="""SELECT s.file_name, CAST(start AS BIGINT) AS start,
            CAST(coalesce(n_ms, 0) AS INTEGER) AS n_ms FROM starts s LEFT JOIN counts USING (file_name)"""),
        "rebuild_text": q(*_MS, _TAGGED, select="SELECT file_name, coalesce(tagged, '') AS tagged FROM files LEFT JOIN tagged USING (file_name)"),
        "milestoned_files": q(*_MS, _TAGGED, select=f"""SELECT file_name, '######Text#' || {o.NL} || {o.NL} || {o.NL} || {o.NL} ||
            '#META#Header#End#' || {o.NL} || {o.NL} || repeat({o.NL}, CAST(length(text) - length(ltrim(text, {o.NL})) AS BIGINT)) ||
            {o.NL} || {o.NL} || coalesce(tagged, '') AS value FROM files LEFT JOIN tagged USING (file_name)"""),
        "milestone_checks": q(o.FILES, rf"""left_over AS (SELECT *, CASE WHEN doc_lang = 'de' THEN
            len(regexp_extract_all({_RESIDUE}, '{o.TAG}')) ELSE 0 END AS tags FROM files)""",
            """reasons AS (SELECT *, CASE WHEN tags > 1 THEN 'remaining tags' WHEN tags = 1 THEN 'text changed' END AS reason FROM left_over)""",
            """marked AS (SELECT *, max(reason) OVER (PARTITION BY book_uri, version, part IS NULL, lang_ext) AS any_reason FROM reasons)""",
            select="""SELECT file_name, coalesce(reason, 'other part rejected') AS reason FROM marked
            WHERE reason IS NOT NULL OR (part IS NOT NULL AND any_reason IS NOT NULL)"""),
        "explode_milestones": q(*_MS, select="SELECT file_name, n AS pos, ms_label, text || ' ' AS text FROM labelled"),
        "record_text_clean": "SELECT doc_id, " + _CLEAN.format("translate(text, 'aeiounsrt', 'إيءىأؤئآل')") + " AS text FROM documents",
        "record_text_folded": "SELECT doc_id, " + _CLEAN.format(
            "replace(replace(translate(regexp_replace(text, '[aeimg]', '', 'g'), 'nsrtdlhcbp', 'بيكههيؤپچت'), 'o', 'لا'), 'u', 'الله')"
        ) + " AS text FROM documents",
        "record_chunks": q(*_MS, select="""SELECT series, lpad(CAST(CAST(ceil(n / 10.0) * 10 AS BIGINT) AS VARCHAR), 5, '0') AS chunk,
            count(*) AS n, min(CAST(regexp_replace(ms_label, '[^0-9]', '', 'g') AS BIGINT)) AS seq_min,
            max(CAST(regexp_replace(ms_label, '[^0-9]', '', 'g') AS BIGINT)) AS seq_max
            FROM labelled JOIN files USING (file_name) GROUP BY series, chunk"""),
        "text_records": q(*_MS, _TAGGED, o.CHOSEN, o.VERSION_META, _MERGED_TAGGED,
            rf"""cut AS (SELECT series, book_uri, unnest(regexp_extract_all(body, '{o.TAG}')) AS ms_label,
              unnest(list_slice(regexp_split_to_array(body, '{o.TAG}'), 1, -2)) AS text FROM merged)""",
            select=f"""SELECT series || '.' || ms_label AS id, series, {_CLEAN.format('text')} AS text,
            CAST(regexp_replace(ms_label, '[^0-9]', '', 'g') AS BIGINT) AS seq, book_uri FROM cut"""),
        "align_clean": q(*_CLEANED, select=f"SELECT {', '.join(o.ALIGN_COLUMNS)} FROM alignments"),
        "ch_match": q(o.ALIGNMENTS, select=f"SELECT uid1, uid2, b1, b2, {o.CH_MATCH} AS ch_match, matches AS ch_match_spaces FROM alignments"),
        "ch_match_arrow": q(o.ALIGNMENTS, select=f"SELECT uid1, uid2, b1, b2, {o.CH_MATCH} AS ch_match FROM alignments"),
        "align_len": q(o.ALIGNMENTS, select="SELECT uid1, uid2, b1, b2, CAST(length(s1) AS INTEGER) AS align_len FROM alignments"),
        "matches_percent": q(o.ALIGNMENTS, select=f"SELECT uid1, uid2, b1, b2, {o.PERCENT} AS matches_percent FROM alignments"),
        "w_match": q(o.ALIGNMENTS, o.words(1, False), o.W_COUNT, select="SELECT * FROM wc"),
        "count_dashes": q(o.ALIGNMENTS, select="""SELECT uid1, uid2, b1, b2, CAST(length(s1) - length(replace(s1, '-', '')) AS INTEGER) AS dashes1,
            CAST(length(s2) - length(replace(s2, '-', '')) AS INTEGER) AS dashes2 FROM alignments"""),
        "first_token_ascii": r"""SELECT doc_id, split_part(text, ' ', 1) AS first_token,
            regexp_replace(text, '[^\x00-\x7F]', '', 'g') AS ascii FROM documents""",
        "word_positions": q(o.ALIGNMENTS, o.words(1), select="""SELECT uid1, uid2, b1, b2, coalesce(string_agg(
            CASE WHEN hit THEN CAST((seq - 1) * 300 + bw + k AS VARCHAR) END, ',' ORDER BY k), '') AS positions
            FROM words1 GROUP BY uid1, uid2, b1, b2"""),
        "char_positions": q(o.ALIGNMENTS, o.RECORDS, o.OFFSETS, o.CHARS, select="""SELECT uid1, uid2, b1, b2, coalesce(string_agg(
            CASE WHEN z[1] = z[2] THEN CAST(ch_offset + b1 + i AS VARCHAR) END, ',' ORDER BY i), '') AS positions
            FROM chars JOIN offsets ON sid = T1 AND seq = seq1 GROUP BY uid1, uid2, b1, b2"""),
        "alignment_stats": q(o.ALIGNMENTS, o.words(1, False), o.W_COUNT, o.STATS, select=f"SELECT {_STAT_LIST} FROM stats"),
        "flip": q(o.ALIGNMENTS, o.words(1, False), o.W_COUNT, o.STATS, select=f"SELECT {_MIRROR} FROM stats"),
        "flip_recompute": q(o.ALIGNMENTS, o.words(2, False), o.W_COUNT.replace("words1", "words2"),
            select="""SELECT uid2 AS uid1, uid1 AS uid2, b2 AS b1, b1 AS b2, w_match FROM alignments JOIN wc USING (uid1, uid2, b1, b2)"""),
        "bidirectional": q(o.ALIGNMENTS, o.words(1, False), o.W_COUNT, o.STATS, select=_BOTH),
        "bidirectional_again": q(o.ALIGNMENTS, o.words(1, False), o.W_COUNT, o.STATS, select=_BOTH),
        "pairwise_table": q(*_CLEANED, o.words(1, False), o.W_COUNT, o.STATS, select=_BOTH),
        "pairwise_rows": q(*_CLEANED, o.words(1, False), o.W_COUNT, o.STATS, select=_BOTH),
        "pair_counts": q(o.ALIGNMENTS, select="""SELECT series1, series2, count(matches) AS instances, min(matches) AS matches_min,
            max(matches) AS matches_max, avg(matches) AS matches_mean FROM alignments GROUP BY series1, series2"""),
        "milestone_offsets": q(o.RECORDS, o.OFFSETS, select="SELECT series, seq, ch_len, ch_offset FROM offsets"),
        "milestone_offsets_exclusive": q(o.RECORDS, o.OFFSETS,
            select="SELECT series, seq, ch_len, ch_offset - ch_len AS ch_offset FROM offsets"),
        "meta_sides": q(o.BOOK_META, select=f"""SELECT {', '.join(f"id AS T{s}, tok_length AS tok_length_B{s}, char_length AS ch_length_B{s}, "
            f"date AS date_B{s}, author_lat AS author_B{s}, book AS book{s}" for s in (1, 2))} FROM meta"""),
        "meta_join": q(o.ALIGNMENTS, o.BOOK_META, _PAIRS, o.PAIR_META.replace("summary", "pairs"),
            select="SELECT * EXCLUDE (T1, T2), T1 AS _T1, T2 AS _T2 FROM pair_meta"),
        "offset_join": q(o.ALIGNMENTS, o.RECORDS, o.OFFSETS, _JOINED, select=f"SELECT {_KEYS}, ch_offset1, ch_offset2 FROM joined"),
        "lost_alignments": q(o.ALIGNMENTS, select=f"""SELECT {_KEYS} FROM alignments
            WHERE uid1 NOT IN (SELECT doc_id FROM labels) OR uid2 NOT IN (SELECT doc_id FROM labels)"""),
        "duplicate_milestones": """SELECT 'S' || source AS sid, CAST(length(text) AS INTEGER) AS seq, count(*) AS n FROM documents
            GROUP BY source, length(text) HAVING count(*) > 1""",
        "wm_totals": q(o.ALIGNMENTS, o.words(1), o.words(2), o.WM_SETS,
            select="SELECT T1 AS _T1, T2 AS _T2, WM1_Total, WM2_Total FROM wm1 JOIN wm2 USING (T1, T2)"),
        "cm_totals": q(o.ALIGNMENTS, o.RECORDS, o.OFFSETS, o.CHARS, o.CM_SETS,
            select="SELECT T1 AS _T1, T2 AS _T2, CM1_Total, CM2_Total FROM cm"),
        "matches_summary": q(o.ALIGNMENTS, o.SUMMARY, select="SELECT * EXCLUDE (T1, T2), T1 AS _T1, T2 AS _T2 FROM summary"),
        "positions_len_stats": q(o.ALIGNMENTS, o.CHARS, o.words(1), o.words(2),
            *[f"n{k} AS (SELECT T1, T2, greatest(count(*) FILTER ({hit}), 1) AS n FROM {src} GROUP BY T1, T2, uid1, uid2, b1, b2)"
              for k, src, hit in (("c", "chars", "z[1] = z[2]"), ("w1", "words1", "hit"), ("w2", "words2", "hit"))],
            *[f"g{k} AS (SELECT T1, T2, CAST(min(n) AS INTEGER) AS {c}_min, CAST(max(n) AS INTEGER) AS {c}_max, avg(n) AS {c}_mean FROM n{k} GROUP BY T1, T2)"
              for k, c in (("c", "chars"), ("w1", "words1"), ("w2", "words2"))],
            select="SELECT * EXCLUDE (T1, T2), T1 AS _T1, T2 AS _T2 FROM gw1 JOIN gw2 USING (T1, T2) JOIN gc USING (T1, T2)"),
        "ratios": q(*_FULL, select=f"SELECT T1 AS _T1, T2 AS _T2, {o.RATIOS} {_FULL_FROM}"),
        "chrono": q(o.ALIGNMENTS, o.BOOK_META, _PAIRS, o.PAIR_META.replace("summary", "pairs"),
            select=f"SELECT T1 AS _T1, T2 AS _T2, {o.CHRONO_12} AS chrono_B1B2, {o.CHRONO_21} AS chrono_B2B1 FROM pair_meta"),
        "book_pair_stats": q(*_FULL, select=f"""SELECT T1 AS _T1, T2 AS _T2, instances, WM2_Total, WM1_Total, CM2_Total, CM1_Total,
            ch_MATCHES_Min, ch_MATCHES_Max, ch_MATCHES_Mean, date_B1, date_B2, author_B1, author_B2, book1, book2,
            tok_length_B1, tok_length_B2, ch_length_B1, ch_length_B2, {o.RATIOS},
            {o.CHRONO_12} AS chrono_B1B2, {o.CHRONO_21} AS chrono_B2B1 {_FULL_FROM}"""),
    }
