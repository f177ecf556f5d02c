"""DuckDB twins of the queries that SQL can express."""

OP4_LINE_DEDUP = r"""
WITH numbered AS (
  SELECT *, words > 0 AS full_line,
         sum(CASE WHEN words > 0 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY line_no) AS seq
  FROM (SELECT *, len(regexp_extract_all(line, '[^\s\x0B\x1C-\x1F\x{85}\pZ]+')) AS words
        FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
                     unnest(range(len(string_split(text, chr(10))))) AS line_no
              FROM documents))),
counted AS (
  SELECT *, sum(words) OVER (PARTITION BY doc_id ORDER BY seq) AS upto FROM numbered WHERE full_line),
spans AS (
  SELECT a.doc_id, a.seq AS first, min(b.seq) AS last FROM counted a JOIN counted b
    ON a.doc_id = b.doc_id AND a.seq <= b.seq AND b.upto - a.upto + a.words >= 50 GROUP BY a.doc_id, a.seq
  UNION
  SELECT b.doc_id, max(a.seq), b.seq FROM counted a JOIN counted b
    ON a.doc_id = b.doc_id AND a.seq <= b.seq AND b.upto - a.upto + a.words >= 50 GROUP BY b.doc_id, b.seq),
runs AS (
  SELECT s.doc_id, s.first, s.last, string_agg(c.line, chr(10) ORDER BY c.seq) AS run
  FROM spans s JOIN counted c ON s.doc_id = c.doc_id AND c.seq BETWEEN s.first AND s.last GROUP BY ALL),
later AS (
  SELECT *, row_number() OVER (PARTITION BY run ORDER BY doc_id, first) AS copy FROM runs),
gone AS (
  SELECT DISTINCT c.doc_id, c.seq FROM counted c JOIN later l
    ON c.doc_id = l.doc_id AND c.seq BETWEEN l.first AND l.last AND l.copy > 1),
marked AS (
  SELECT n.doc_id, n.line_no, n.line,
         CASE WHEN full_line THEN g.seq IS NOT NULL ELSE g.seq IS NOT NULL AND h.seq IS NOT NULL END AS removed
  FROM numbered n LEFT JOIN gone g ON n.doc_id = g.doc_id AND n.seq = g.seq
                  LEFT JOIN gone h ON n.doc_id = h.doc_id AND n.seq + 1 = h.seq),
cleaned AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (removed) AS n_removed,
         coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (NOT removed), '') AS cleaned
  FROM marked GROUP BY doc_id)
SELECT doc_id, n_lines, n_removed, length(cleaned) AS n_chars, md5(cleaned) AS text_md5 FROM cleaned
"""

_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _words(text: str) -> str:
    return f"list_filter(string_split_regex({_LOWER.format(text)}, '{_SEPARATORS}'), lambda x: x <> '')"


def op5_license_scan(templates: list[tuple[str, str]]) -> str:
    rows = ", ".join(f"('{label}', '{text.replace("'", "''")}')" for label, text in templates)
    return f"""
WITH templates AS (
  SELECT label, list_distinct({_words("text")}) AS tokens, len({_words("text")}) AS n FROM (VALUES {rows}) AS t(label, text)),
texts AS (SELECT doc_id, {_words("coalesce(text, '')")} AS w FROM documents),
places AS (
  SELECT doc_id, w,
    [i - 1 FOR i IN range(1, len(w) + 1) IF w[i] = 'mit' AND w[i + 1] = 'license'] AS mit,
    [i - 1 FOR i IN range(1, len(w) + 1) IF w[i] = 'apache' AND w[i + 1] = 'license'] AS apache,
    [i - 1 FOR i IN range(1, len(w) + 1) IF w[i] = 'general' AND w[i + 1] = 'public' AND w[i + 2] = 'license'] AS gpl
  FROM texts),
met AS (
  SELECT doc_id, label, containment FROM (
    SELECT doc_id, label, len(tokens) AS size,
      list_max([len(list_intersect(list_distinct(list_slice(w, s * n + 1, (s + 2) * n)), tokens))
                FOR s IN range(0, greatest(1, ceil(len(w) / n)::BIGINT - 1))]) AS common, common / size AS containment
    FROM texts, templates)
  WHERE common >= ceil(0.8 * size - 1e-9)),
found AS (SELECT doc_id, list(DISTINCT label) AS labels, max(containment) AS containment FROM met GROUP BY doc_id),
base AS (
  SELECT doc_id, len(w) AS n_words, list_concat(mit, list_concat(apache, gpl)) AS every,
         list_filter([CASE WHEN len(apache) > 0 THEN 'apache' END, CASE WHEN len(gpl) > 0 THEN 'gpl' END,
                      CASE WHEN len(mit) > 0 THEN 'mit' END], lambda x: x IS NOT NULL) AS labels
  FROM places)
SELECT b.doc_id, n_words, len(every) AS n_base, list_min(every) AS first_word, list_max(every) AS last_word,
       array_to_string(b.labels, ',') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(b.labels, coalesce(f.labels, [])))), ',') AS labels,
       CASE WHEN len(b.labels) > 0 THEN 1.0::DOUBLE ELSE coalesce(containment, 0.0::DOUBLE) END AS score
FROM base b LEFT JOIN found f ON b.doc_id = f.doc_id
"""


OP7_NEAR_DUPLICATES = rf"""
WITH RECURSIVE texts AS (
  SELECT doc_id, list_filter(string_split_regex({_LOWER.format("coalesce(text, '')")}, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) >= 5 THEN list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)])
                      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS shingles
  FROM texts),
members AS (SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM members a JOIN members b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reach AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION
  SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.other = l.a)
SELECT s.doc_id, len(shingles) AS n_shingles, min(other) AS component_id, s.doc_id = min(other) AS kept
FROM sets s JOIN reach r ON s.doc_id = r.doc_id GROUP BY s.doc_id, shingles
"""

OP11_HARD_NEGATIVES = """
WITH used AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
        list_dot_product(a.v, b.v)::BIGINT AS score
    FROM used a JOIN used b ON a.vec_id % 100 = 0
), positives AS (
    SELECT anchor_id, other_id AS positive_id, score AS positive_score
    FROM scored WHERE same AND other_id <> anchor_id
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT anchor_id, positive_id,
    row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id)::INTEGER AS rank,
    other_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""
