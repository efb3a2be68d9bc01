"""SQL for the queries that it can express. The others are tested against plain Python."""

from __future__ import annotations

from . import chat

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _escaped(text: str, escapes: tuple) -> str:
    for plain, code in escapes:
        char = "chr(10)" if plain == "\n" else f"'{plain}'"
        text = f"replace({text}, {char}, '{code}')"
    return text


def _chat() -> str:
    marks = len(chat.OPEN) + 1 + len(chat.CLOSE)
    role, text = _escaped("role", chat.ROLE_ESCAPES), _escaped("text", chat.ESCAPES)
    order = "PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text"
    return f"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), placed AS (
  SELECT *, row_number() OVER ({order}) AS place, count(*) OVER (PARTITION BY conv_id) AS turns,
         sum({marks} + length({role}) + length({text})) OVER ({order} ROWS UNBOUNDED PRECEDING) AS upto
  FROM rows
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(upto) FILTER (role = 'assistant' OR place = turns)::BIGINT AS formatted_chars
FROM placed GROUP BY conv_id"""


JACCARD = rf"""
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), each AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 3
    THEN list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS shingle
  FROM split
), sizes AS (
  SELECT doc_id, count(*) AS n FROM each GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k
  FROM each a JOIN each b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM common JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id
  WHERE 100 * k >= 90 * (x.n + y.n - k)
), edges AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach(doc_id, root) AS (
  SELECT doc_id, doc_id FROM split UNION SELECT b, root FROM reach JOIN edges ON a = reach.doc_id
)
SELECT split.doc_id, coalesce(n, 0) AS n_shingles, min(root) AS component_id
FROM split JOIN reach USING (doc_id) LEFT JOIN sizes USING (doc_id) GROUP BY ALL"""

EXACT = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))"""

CONTAMINATION = rf"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE item_id IS NOT NULL
), windows AS (
  SELECT DISTINCT item_id, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: w[i : i + k - 1])) AS gram
  FROM (SELECT *, least(len(w), 10) AS k FROM items) WHERE k > 0
), places AS (
  SELECT doc_id, k, unnest(range(1, len(w) - k + 2)) AS i, w FROM words, (SELECT DISTINCT k FROM windows)
), hits AS (
  SELECT doc_id, i, p.k, item_id FROM places p JOIN windows v ON p.k = v.k AND w[i : i + p.k - 1] = gram
), covered AS (
  SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS pos FROM hits) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)"""


#: crc32 of a list of bytes ``b`` is ``{_crc('b')}``, with the table ``t`` of this subquery.
CRC_TABLE = """
crc AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
                          lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM range(256) AS r(i)
)"""


def _crc(bytes_: str) -> str:
    step = "xor(c >> 8, t[(xor(c, b) & 255) + 1])"
    return f"xor(list_reduce(list_prepend(4294967295, {bytes_}), lambda c, b: {step}), 4294967295)"


def _points(text: str) -> str:
    return f"list_transform(range(1, length({text}) + 1), lambda i: unicode({text}[i])::BIGINT)"


#: The letters of a run are below U+0100, so each has one byte or two.
SPELLING = rf"""
WITH RECURSIVE {CRC_TABLE}, runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[A-Za-zÀ-ÿ]+')) AS run
  FROM documents
), counted AS (
  SELECT run, count(*) AS k, coalesce(doc_id::VARCHAR, '') || ':' || run AS tagged FROM runs GROUP BY doc_id, run
), hashed AS (
  SELECT run, k, {_crc("flatten(list_transform(" + _points("tagged") + ", lambda u: CASE WHEN u < 128 THEN [u] ELSE [195, u - 64] END))")} AS h
  FROM counted, crc
), words AS (
  SELECT word, sum(k)::BIGINT AS n
  FROM (SELECT k, CASE WHEN h % 97 = 0 THEN substring(run, 1, (h % length(run))::INT) || substring(run, (h % length(run))::INT + 2)
                  ELSE run END AS word FROM hashed)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(k) >= 3
), less AS (
  SELECT word, unnest(range(1, length(word) + 1)) AS i, substring(word, 1, i::INT - 1) || substring(word, i::INT + 1) AS rest
  FROM words
), near AS (
  SELECT a.word, b.word AS other FROM less a JOIN less b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT less.word, words.word FROM less JOIN words ON rest = words.word
  UNION SELECT words.word, less.word FROM less JOIN words ON rest = words.word
), best AS (
  SELECT near.word, count(*) AS n_near, first(other ORDER BY n DESC, other) AS other, max(n) AS other_n
  FROM near JOIN words ON words.word = other GROUP BY near.word
), rated AS (
  SELECT words.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 2 * n THEN other END AS form,
         CASE WHEN other_n >= 2 * n THEN other_n END AS form_n
  FROM words LEFT JOIN best USING (word)
), steps(word, root) AS (
  SELECT word, word FROM rated UNION ALL SELECT steps.word, form FROM steps JOIN rated ON steps.root = rated.word WHERE form IS NOT NULL
)
SELECT rated.word, rated.form, steps.root, rated.n, rated.n_near, rated.form_n
FROM rated JOIN steps ON steps.word = rated.word JOIN rated AS last ON last.word = steps.root AND last.form IS NULL"""

PREFIXES = rf"""
WITH {CRC_TABLE}, rows AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT conv_id, conv_id - conv_id % 100 AS base, {_crc(_points("(conv_id::VARCHAR)"))} % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM rows), crc
), joined AS (
  SELECT convs.conv_id, 0 AS part, place, role, text FROM convs JOIN rows ON rows.conv_id = base WHERE place <= h
  UNION ALL SELECT convs.conv_id, 1, place, role, text FROM convs JOIN rows USING (conv_id) WHERE place > h
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY part, place) AS depth FROM joined
), passed AS (
  SELECT conv_id, 0 AS depth, '' AS node, NULL AS parent, 0 AS chars FROM convs
  UNION ALL
  SELECT conv_id, depth, whole, substring(whole, 1, length(whole) - length(step)), length(text)
  FROM (SELECT *, string_agg(step, '') OVER (PARTITION BY conv_id ORDER BY depth ROWS UNBOUNDED PRECEDING) AS whole
        FROM (SELECT *, length(role) || ':' || role || length(text) || ':' || text AS step FROM placed))
), ended AS (
  SELECT *, depth = max(depth) OVER (PARTITION BY conv_id) AS is_end FROM passed
), nodes AS (
  SELECT node, any_value(parent) AS parent, min(conv_id) AS conv_id, any_value(depth) AS depth, count(*) AS n_convs,
         (count(*) - 1) * any_value(chars) AS saved,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (is_end), '')) AS ends_sha256
  FROM ended GROUP BY node
), children AS (
  SELECT parent AS node, count(*) AS n FROM nodes WHERE parent IS NOT NULL GROUP BY parent
), full_nodes AS (
  SELECT nodes.*, coalesce(n, 0) AS n_children FROM nodes LEFT JOIN children USING (node)
), below AS (
  SELECT DISTINCT a.node, b.node AS other FROM passed a JOIN passed b ON a.conv_id = b.conv_id AND b.depth >= a.depth
), sums AS (
  SELECT below.node, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved)::BIGINT AS saved_tokens
  FROM below JOIN full_nodes ON full_nodes.node = other GROUP BY below.node
)
SELECT x.conv_id, x.depth::BIGINT AS depth, up.conv_id AS parent_conv_id, x.n_convs, x.n_children, n_leaves, saved_tokens, x.ends_sha256
FROM full_nodes x JOIN sums USING (node) LEFT JOIN full_nodes up ON up.node = x.parent"""


def llm_oracles() -> dict[str, str]:
    return {
        "op3_chat": _chat(),
        "op5_jaccard": JACCARD,
        "op6_exact": EXACT,
        "op9_contamination": CONTAMINATION,
        "op11_spelling": SPELLING,
        "op13_prefixes": PREFIXES,
    }
