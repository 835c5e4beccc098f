"""Expected results of the registered queries as SQL over the driver tables.

The statements define the results on their own terms: milestones by a running count over
token rows, matches and positions by comparing one character or word per row, distinct
positions by counting distinct rows.  They share nothing with the Spark expressions but
the definitions of the input tables.
"""

from __future__ import annotations

NL = "chr(10)"
WS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
TAG = r"ms[A-Z]?\p{Nd}+"
SPACED = r" *ms[A-Z]?\p{Nd}+"
WORD = r"\p{L}\p{N}_"

# --- input tables -----------------------------------------------------------------------

FILES = f"""
files0 AS (
  SELECT doc_id, lang AS doc_lang, text, doc_id // 4 AS v,
    lpad(CAST((doc_id // 4) % 1000 AS VARCHAR), 4, '0') || 'src' || ((doc_id // 4) % 20) AS author,
    'T' || ((doc_id // 4) % 7) AS title,
    'D' || (doc_id // 4) AS version,
    CASE WHEN (doc_id // 4) % 5 = 0 THEN CASE WHEN doc_id % 4 < 2 THEN 'A' ELSE 'B' END END AS part,
    CASE WHEN (doc_id // 4) % 5 = 0 THEN CASE WHEN doc_id % 2 = 1 THEN 'mARkdown' END
         ELSE CASE doc_id % 4 WHEN 1 THEN 'inProgress' WHEN 2 THEN 'completed' WHEN 3 THEN 'mARkdown' END END AS ext
  FROM documents),
files AS (
  SELECT *, author || '.' || title AS book_uri,
    'eng1' || coalesce('.' || ext, '') AS lang_ext,
    version || coalesce(part, '') || '-eng1' || coalesce('.' || ext, '') AS series,
    author || '.' || title || '.' || version || coalesce(part, '') || '-eng1' || coalesce('.' || ext, '') AS file_name
  FROM files0)
"""

VERSION_META = """
vmeta AS (
  SELECT 'D' || (doc_id // 4) AS id,
    CASE WHEN max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) = 1 THEN 'pri' ELSE 'sec' END AS status
  FROM documents LEFT JOIN labels USING (doc_id) GROUP BY doc_id // 4)
"""

CHOSEN = """
chosen AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY book_uri, version, part
      ORDER BY CASE ext WHEN 'mARkdown' THEN 1 WHEN 'completed' THEN 2 WHEN 'inProgress' THEN 3 ELSE 4 END) AS rk
    FROM files) WHERE rk = 1)
"""

MERGED = f"""
merged AS (
  SELECT CASE WHEN count(part) > 0 THEN any_value(version) || '-' || arg_min(lang_ext, file_name)
              ELSE any_value(series) END AS series,
    book_uri, version, string_agg({NL} || {NL} || text || {NL}, {NL} ORDER BY file_name) AS body
  FROM chosen GROUP BY book_uri, version)
"""

# Milestones of every file by a running count of relevant pieces (see WORD) over its pieces.
MILESTONES = rf"""
bodies AS (SELECT *, rtrim(ltrim(text, chr(10)), {WS}) AS body FROM files),
pieces AS (
  SELECT file_name, unnest(ps) AS piece, generate_subscripts(ps, 1) AS pos
  FROM (SELECT file_name, regexp_extract_all(body, '[{WORD}]+|[^{WORD}]+') AS ps FROM bodies)),
placed AS (
  SELECT *, 1 + CAST(floor(coalesce(sum(CASE WHEN regexp_matches(piece, '[\p{{L}}]') THEN 1 ELSE 0 END)
      OVER (PARTITION BY file_name ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) / 30) AS BIGINT) AS n
  FROM pieces),
ms AS (
  SELECT file_name, n, string_agg(piece, '' ORDER BY pos) AS text,
    sum(CASE WHEN regexp_matches(piece, '[\p{{L}}]') THEN 1 ELSE 0 END) AS relevant
  FROM placed GROUP BY file_name, n)
"""

# Number of the milestone in its book and its label.
LABELS = rf"""
counts AS (SELECT file_name, count(*) AS n_ms FROM ms GROUP BY file_name),
starts AS (
  SELECT f.file_name, f.part, length(CAST(len(regexp_extract_all(f.body, '[\p{{L}}]+')) // 30 AS VARCHAR)) AS width,
    CASE WHEN f.part IS NULL THEN 0 ELSE coalesce(sum(coalesce(c.n_ms, 0)) OVER (
      PARTITION BY f.book_uri, f.version, f.part IS NULL, f.lang_ext ORDER BY f.file_name
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) END AS start
  FROM bodies f LEFT JOIN counts c USING (file_name)),
labelled AS (
  SELECT m.file_name, m.n, m.text, m.relevant,
    'ms' || coalesce(s.part, '') || lpad(CAST(s.start + m.n AS VARCHAR),
      CAST(greatest(s.width, length(CAST(s.start + m.n AS VARCHAR))) AS INTEGER), '0') AS ms_label
  FROM ms m JOIN starts s USING (file_name))
"""

RECORDS = """
records AS (
  SELECT 'S' || source || '-eng1.ms' || (doc_id + 1) AS id, 'S' || source || '-eng1' AS series,
    'S' || source AS sid, doc_id + 1 AS seq, text FROM documents)
"""

OFFSETS = """
offsets AS (
  SELECT series, sid, seq, length(text) AS ch_len,
    CAST(sum(length(text)) OVER (PARTITION BY series ORDER BY seq) AS BIGINT) AS ch_offset FROM records)
"""

BOOK_META = """
meta AS (
  SELECT 'S' || source AS id,
    CASE WHEN n % 9 <> 8 THEN CAST(tokens AS VARCHAR) END AS tok_length,
    CAST(chars AS VARCHAR) AS char_length,
    CASE WHEN n % 7 = 6 THEN 'unknown' ELSE CAST(n % 7 AS VARCHAR) END AS date,
    'A' || (n % 4) AS author_lat, 'B' || n AS book
  FROM (SELECT source, CAST(substr(source, 4) AS INTEGER) AS n,
      CAST(sum(length(text) - length(replace(text, ' ', '')) + 1) AS BIGINT) AS tokens,
      CAST(sum(length(text)) AS BIGINT) AS chars
    FROM documents GROUP BY source))
"""

_LINES = r"regexp_extract_all({}.text, '[^\n]*\n|[^\n]+')"
ALIGNMENTS = f"""
firsts AS (
  SELECT split_part(text, {NL}, 1) AS first_line, min(doc_id) AS a, arg_min(source, doc_id) AS a_source FROM documents GROUP BY 1),
seconds AS (
  SELECT first_line, min(doc_id) AS b FROM documents JOIN firsts ON split_part(text, {NL}, 1) = first_line
  WHERE source <> a_source GROUP BY 1),
texts2 AS (
  SELECT CASE WHEN d.source < p.source THEN d ELSE p END AS x1, CASE WHEN d.source < p.source THEN p ELSE d END AS x2
  FROM documents d JOIN firsts f ON split_part(d.text, {NL}, 1) = f.first_line JOIN seconds s ON s.first_line = f.first_line
  JOIN documents p ON p.doc_id = CASE WHEN d.source <> f.a_source THEN f.a WHEN d.doc_id <> f.a THEN s.b END),
lines2 AS (
  SELECT x1, x2, unnest({_LINES.format('x1')}) AS t1, unnest({_LINES.format('x2')}) AS t2,
    generate_subscripts(range(greatest(len({_LINES.format('x1')}), len({_LINES.format('x2')}))), 1) AS k
  FROM texts2),
sized AS (
  SELECT *, coalesce(sum(length(t1)) OVER w, 0) AS c1, coalesce(sum(length(t2)) OVER w, 0) AS c2,
    coalesce(sum(length(t1) - length(replace(t1, ' ', ''))) OVER w, 0) AS w1,
    coalesce(sum(length(t2) - length(replace(t2, ' ', ''))) OVER w, 0) AS w2,
    rpad(t1, CAST(greatest(length(t1), length(t2)) AS INTEGER), '-') AS s1,
    rpad(t2, CAST(greatest(length(t1), length(t2)) AS INTEGER), '-') AS s2
  FROM (SELECT * REPLACE (coalesce(t1, '') AS t1, coalesce(t2, '') AS t2) FROM lines2)
  WINDOW w AS (PARTITION BY x1.doc_id, x2.doc_id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
alignments AS (
  SELECT *, matches / CAST(length(s1) AS DOUBLE) AS score FROM (
    SELECT {', '.join(f'''
      CAST(c{s} AS INTEGER) AS b{s}, CAST(c{s} + length(t{s}) AS INTEGER) AS e{s},
      CAST(w{s} AS INTEGER) AS bw{s},
      CAST(w{s} + length(t{s}) - length(replace(t{s}, ' ', '')) + 1 AS INTEGER) AS ew{s},
      x{s}.doc_id AS first{s}, CAST(substr(x{s}.source, 4) AS BIGINT) AS gid{s}, x{s}.doc_id AS uid{s},
      'S' || x{s}.source || '-eng1.ms' || (x{s}.doc_id + 1) AS id{s},
      CAST(length(x{s}.text) AS INTEGER) AS len{s},
      CAST(length(x{s}.text) - length(replace(x{s}.text, ' ', '')) + 1 AS INTEGER) AS tok{s},
      CAST(x{s}.doc_id + 1 AS INTEGER) AS seq{s}, 'S' || x{s}.source || '-eng1' AS series{s},
      'S' || x{s}.source AS T{s}, s{s}''' for s in (1, 2))},
      CAST(len(list_filter(list_zip(string_split(s1, ''), string_split(s2, '')), lambda x: x[1] = x[2])) AS INTEGER) AS matches
    FROM sized))
"""

# One row per aligned character, and one per blank-separated word of either side.
CHARS = f"""
chars AS (
  SELECT uid1, uid2, b1, b2, T1, T2, seq1, seq2, unnest(z) AS z, generate_subscripts(z, 1) - 1 AS i
  FROM (SELECT *, list_zip(string_split(replace(s1, {NL}, ' '), ''), string_split(replace(s2, {NL}, ' '), '')) AS z FROM alignments))
"""


def words(side: int, newlines: bool = True) -> str:
    """CTE `words<side>`: uid1, uid2, b1, b2, k, hit for the words of one side."""
    a, b = (f"replace(s{x}, {NL}, ' ')" if newlines else f"s{x}" for x in (side, 3 - side))
    return f"""
split{side} AS (
  SELECT uid1, uid2, b1, b2, T1, T2, seq{side} AS seq, bw{side} AS bw, {a} AS a, {b} AS b,
    string_split(rtrim_one({a}), ' ') AS ws FROM alignments),
word_rows{side} AS (
  SELECT *, unnest(ws) AS w, generate_subscripts(ws, 1) AS k FROM split{side}),
words{side} AS (
  SELECT uid1, uid2, b1, b2, T1, T2, seq, bw, k,
    substr(b, CAST(1 + coalesce(sum(length(w) + 1) OVER (PARTITION BY uid1, uid2, b1, b2 ORDER BY k
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT), length(w)) = w AS hit
  FROM word_rows{side})
""".replace(f"rtrim_one({a})", f"CASE WHEN {a} LIKE '% ' THEN substr({a}, 1, length({a}) - 1) ELSE {a} END")


def query(*ctes: str, select: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n" + select.strip()


# --- derived columns --------------------------------------------------------------------

PERCENT = "CAST(CAST(CASE WHEN length(s1) = 0 THEN 0 ELSE CAST(matches AS DOUBLE) / length(s1) * 100 END AS FLOAT) AS DOUBLE)"
CH_MATCH = (
    "CAST(len(list_filter(list_zip(string_split(s1, ''), string_split(s2, '')), "
    "lambda x: x[1] = x[2] AND x[1] <> ' ')) AS INTEGER)"
)
SIDES = ("b", "bw", "e", "ew", "first", "gid", "id", "len", "s", "seq", "series", "tok", "uid")
ALIGN_COLUMNS = [f"{c}{s}" for c in SIDES for s in (1, 2)] + ["matches", "score"]
STAT_COLUMNS = ALIGN_COLUMNS + ["ch_match", "align_len", "matches_percent", "w_match", "series_b1", "series_b2"]

W_COUNT = "wc AS (SELECT uid1, uid2, b1, b2, CAST(count(*) FILTER (hit) AS INTEGER) AS w_match FROM words1 GROUP BY ALL)"
STATS = f"""
stats AS (
  SELECT a.*, {CH_MATCH} AS ch_match, CAST(length(s1) AS INTEGER) AS align_len, {PERCENT} AS matches_percent,
    wc.w_match, series1 AS series_b1, series2 AS series_b2
  FROM alignments a JOIN wc USING (uid1, uid2, b1, b2))
"""


def mirrored(columns: list[str]) -> str:
    def twin(c: str) -> str:
        other = c[:-1] + {"1": "2", "2": "1"}.get(c[-1], "")
        return other if other in columns else c

    return ", ".join(f"{twin(c)} AS {c}" for c in columns)


CHRONO = """
CASE WHEN try_cast(date_{a} AS INTEGER) > try_cast(date_{b} AS INTEGER) THEN 'chron'
     WHEN try_cast(date_{a} AS INTEGER) < try_cast(date_{b} AS INTEGER) THEN 'anachron'
     WHEN try_cast(date_{a} AS INTEGER) = try_cast(date_{b} AS INTEGER) THEN
       CASE WHEN author_{a} = author_{b} THEN CASE WHEN {x} < {y} THEN 'sr_include' ELSE 'sr_exclude' END
            ELSE CASE WHEN author_{a} < author_{b} THEN 'include' ELSE 'exclude' END END END
"""
CHRONO_12 = CHRONO.format(a="B1", b="B2", x="book1", y="book2")
CHRONO_21 = CHRONO.format(a="B2", b="B1", x="book2", y="book1")

# Distinct matched positions of a pair; an alignment without any adds one to its pair.
WM_SETS = "\n".join(
    f"""wm{s} AS (
  SELECT T1, T2, CAST(count(DISTINCT CASE WHEN hit THEN (seq - 1) * 300 + bw + k END)
      + max(CASE WHEN hits = 0 THEN 1 ELSE 0 END) AS INTEGER) AS WM{s}_Total
  FROM (SELECT *, count(*) FILTER (hit) OVER (PARTITION BY uid1, uid2, b1, b2) AS hits FROM words{s})
  GROUP BY T1, T2){',' if s == 1 else ''}""" for s in (1, 2)
)
CM_SETS = """
located AS (
  SELECT c.*, o1.ch_offset + c.b1 + i AS p1, o2.ch_offset + c.b2 + i AS p2, z[1] = z[2] AS hit
  FROM chars c JOIN offsets o1 ON o1.sid = T1 AND o1.seq = seq1 JOIN offsets o2 ON o2.sid = T2 AND o2.seq = seq2),
cm AS (
  SELECT T1, T2, CAST(count(DISTINCT CASE WHEN hit THEN p1 END) + max(CASE WHEN hits = 0 THEN 1 ELSE 0 END) AS INTEGER) AS CM1_Total,
    CAST(count(DISTINCT CASE WHEN hit THEN p2 END) + max(CASE WHEN hits = 0 THEN 1 ELSE 0 END) AS INTEGER) AS CM2_Total
  FROM (SELECT *, count(*) FILTER (hit) OVER (PARTITION BY uid1, uid2, b1, b2) AS hits FROM located)
  GROUP BY T1, T2)
"""
SUMMARY = """
summary AS (
  SELECT T1, T2, count(matches) AS instances, min(matches) AS ch_MATCHES_Min, max(matches) AS ch_MATCHES_Max,
    avg(matches) AS ch_MATCHES_Mean FROM alignments GROUP BY T1, T2)
"""
PAIR_META = """
pair_meta AS (
  SELECT s.*, m1.date AS date_B1, m2.date AS date_B2, m1.author_lat AS author_B1, m2.author_lat AS author_B2,
    m1.book AS book1, m2.book AS book2, m1.tok_length AS tok_length_B1, m2.tok_length AS tok_length_B2,
    m1.char_length AS ch_length_B1, m2.char_length AS ch_length_B2
  FROM summary s LEFT JOIN meta m1 ON m1.id = T1 LEFT JOIN meta m2 ON m2.id = T2)
"""


def share(total: str, length: str) -> str:
    return f"CAST({total} AS DOUBLE) / nullif(try_cast({length} AS DOUBLE), 0)"


RATIOS = (
    f"{share('WM2_Total', 'tok_length_B2')} AS WM_B2inB1, {share('WM1_Total', 'tok_length_B1')} AS WM_B1inB2, "
    f"{share('CM2_Total', 'ch_length_B2')} AS CM_B2inB1, {share('CM1_Total', 'ch_length_B1')} AS CM_B1inB2"
)
