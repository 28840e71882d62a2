"""SQL of the queries that DuckDB can express."""

from clickmart.llm import licenses

ORACLE = {}

ORACLE["op10_substring_dedup"] = r"""
WITH texts AS (
  SELECT row_number() OVER () AS row_id, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), windows AS (
  SELECT row_id, place, array_to_string(list_slice(words, place, place + 34), ' ') AS run
  FROM (SELECT row_id, words, unnest(range(1, len(words) - 33)) AS place FROM texts)
), repeated AS (
  SELECT row_id, place FROM (SELECT row_id, place, count(*) OVER (PARTITION BY run) AS times FROM windows) WHERE times > 1
), covered AS (
  SELECT DISTINCT row_id, unnest(range(place, place + 35)) AS place FROM repeated
), gone AS (
  SELECT row_id, list(place) AS places, count(*) AS n FROM covered GROUP BY row_id
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed,
  sha256(array_to_string(CASE WHEN n IS NULL THEN words ELSE
    list_select(words, list_filter(range(1, len(words) + 1), lambda p: NOT list_contains(places, p))) END, ' ')) AS kept_sha256
FROM texts LEFT JOIN gone USING (row_id)
"""

_PLAIN = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

ORACLE["op6_decontamination"] = rf"""
WITH texts AS (
  SELECT row_number() OVER () AS row_id, doc_id, {_PLAIN} AS words FROM documents
), items AS (
  SELECT item_id, words, least(13, len(words)) AS size FROM (SELECT item_id, {_PLAIN} AS words FROM benchmark)
  WHERE len(words) > 0
), item_windows AS (
  SELECT DISTINCT item_id, size, array_to_string(list_slice(words, place, place + size - 1), ' ') AS run
  FROM (SELECT item_id, words, size, unnest(range(1, len(words) - size + 2)) AS place FROM items)
), sizes AS (
  SELECT DISTINCT size FROM item_windows
), windows AS (
  SELECT row_id, size, place, array_to_string(list_slice(words, place, place + size - 1), ' ') AS run
  FROM (SELECT row_id, words, size, unnest(range(1, len(words) - size + 2)) AS place FROM texts, sizes
        WHERE len(words) >= size)
), found AS (
  SELECT row_id, size, place, item_id FROM windows JOIN item_windows USING (size, run)
), hits AS (
  SELECT row_id, count(*) AS n FROM (SELECT DISTINCT row_id, unnest(range(place, place + size)) FROM found) GROUP BY row_id
), named AS (
  SELECT row_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT row_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY row_id
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n, 0) > 0 AND 20 * coalesce(n, 0) >= len(words) AS contaminated
FROM texts LEFT JOIN hits USING (row_id) LEFT JOIN named USING (row_id)
"""

ORACLE["op4_warc_archives"] = r"""
WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS payload FROM pages
), digests AS (
  SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes, sha1(payload) AS hex,
    max(page_id) OVER (PARTITION BY payload) AS largest
  FROM payloads
), bits AS (
  SELECT *, array_to_string(list_transform(string_split(hex, ''),
    lambda c: lpad(bin(instr('0123456789abcdef', c) - 1), 4, '0')), '') AS bits
  FROM digests
)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1
    + 16 * CAST(substr(bits, 5 * i + 1, 1) AS INT) + 8 * CAST(substr(bits, 5 * i + 2, 1) AS INT)
    + 4 * CAST(substr(bits, 5 * i + 3, 1) AS INT) + 2 * CAST(substr(bits, 5 * i + 4, 1) AS INT)
    + CAST(substr(bits, 5 * i + 5, 1) AS INT) AS BIGINT), 1)), '') AS payload_digest,
  CASE WHEN page_id = largest THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = largest THEN NULL ELSE largest END AS refers_to
FROM bits
"""


def _quoted(text):
    return "'" + text.replace("'", "''") + "'"


def _licence_sql():
    cut = f"regexp_replace(text, {_quoted(licenses.FULL_STOP)}, '\\1' || chr(1), 'g')"
    cut = f"regexp_replace({cut}, {_quoted(licenses.EMPTY_LINE)}, chr(1), 'g')"
    cut = f"regexp_replace({cut}, {_quoted(licenses.OPENER)}, chr(1) || '\\1', 'g')"
    keyword = _quoted(licenses.KEYWORD)
    plain = f"translate(s, {_quoted(licenses._UPPER + licenses.QUOTES)}, '{licenses._LOWER}')"
    plain = f"regexp_replace(regexp_replace({plain}, '[^a-z0-9.,+/()-]+', ' ', 'g'), '^[ .,/+-]+|[ .,/+-]+$', '', 'g')"
    cases = " ".join(f"WHEN regexp_full_match(s, {_quoted(p)}) THEN {_quoted(n)}" for n, p in licenses.SENTENCES)
    names = {}
    for licence, ids in licenses.RULES:
        names.setdefault("".join(f"<{name}>" for name in ids), licence)
    pattern = _quoted("|".join(run.replace(".", r"\.") for run in names))
    licence = " ".join(f"WHEN {_quoted(run)} THEN {_quoted(name)}" for run, name in names.items())
    return f"""
WITH cut AS (
  SELECT row_number() OVER () AS row_id, doc_id,
    list_filter(string_split({cut}, chr(1)), lambda s: regexp_matches(s, {keyword})) AS sentences
  FROM documents
), ids AS (
  SELECT row_id, doc_id, array_to_string(list_filter(list_transform(list_transform(coalesce(sentences, []),
    lambda s: {plain}), lambda s: CASE {cases} END), lambda i: i IS NOT NULL), ' ') AS sentence_ids
  FROM cut
), runs AS (
  SELECT row_id, doc_id, sentence_ids, list_transform(regexp_extract_all(regexp_replace(regexp_replace(sentence_ids,
    '([^ ]+) ?', '<\\1>', 'g'), '(<Copyright>)+(<[^A])', '\\2', 'g'), {pattern}), lambda r: CASE r {licence} END) AS found
  FROM ids
)
SELECT doc_id, sentence_ids, array_to_string(list_filter(found, lambda x, i: list_position(found, x) = i), ' ') AS licences
FROM runs
"""


ORACLE["op2_licence_scan"] = _licence_sql()

_CLASSES = r"""
WITH RECURSIVE texts AS (
  SELECT row_number() OVER () AS row_id, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), shingles AS (
  SELECT DISTINCT row_id, array_to_string(list_slice(words, place, place + @LAST@), ' ') AS shingle
  FROM (SELECT row_id, words, unnest(range(1, greatest(len(words) - @LAST@, 1) + 1)) AS place FROM texts WHERE len(words) > 0)
), sizes AS (
  SELECT row_id, count(*) AS n FROM shingles GROUP BY row_id
), links AS (
  SELECT x, y FROM (
    SELECT a.row_id AS x, b.row_id AS y, count(*) AS shared
    FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.row_id <> b.row_id GROUP BY ALL)
  JOIN sizes m ON m.row_id = x JOIN sizes k ON k.row_id = y WHERE 100 * shared >= @SHARE@ * (m.n + k.n - shared)
), reach AS (
  SELECT row_id, row_id AS other FROM texts
  UNION SELECT reach.row_id, links.y FROM reach JOIN links ON links.x = reach.other
), least AS (
  SELECT reach.row_id, min(texts.doc_id) AS component_id FROM reach JOIN texts ON texts.row_id = reach.other GROUP BY ALL
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id@MORE@
FROM texts LEFT JOIN sizes USING (row_id) JOIN least USING (row_id)
"""


def _classes_sql(size, share, more=""):
    """Classes of documents whose sets of runs of ``size`` words overlap by ``share`` of 100."""
    return _CLASSES.replace("@LAST@", str(size - 1)).replace("@SHARE@", str(share)).replace("@MORE@", more)


ORACLE["op3_jaccard_join"] = _classes_sql(5, 80)

ORACLE["op12_minmax_dedup"] = _classes_sql(3, 85, ", doc_id = component_id AS kept")

ORACLE["op13_source_divergence"] = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text
  FROM documents
), words AS (
  SELECT row_id, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM docs
), kept AS (
  SELECT lang, term FROM words GROUP BY ALL HAVING count(DISTINCT row_id) >= 30
), counts AS (
  SELECT lang, source, term, count(*) AS c FROM words JOIN kept USING (lang, term) GROUP BY ALL
), places AS (
  SELECT DISTINCT lang, source FROM docs
), shares AS (
  SELECT lang, source, term, c, 1 + (1000000000 * (c + 5)::HUGEINT) //
    (sum(c) OVER (PARTITION BY lang, source) + 5 * count(*) OVER (PARTITION BY lang, source)) AS p
  FROM (SELECT lang, source, term, coalesce(c, 0) AS c FROM places JOIN kept USING (lang) LEFT JOIN counts USING (lang, source, term))
), general AS (
  SELECT lang, term, 1 + (1000000000 * (c + 5)::HUGEINT) //
    (sum(c) OVER (PARTITION BY lang) + 5 * count(*) OVER (PARTITION BY lang)) AS q
  FROM (SELECT lang, term, sum(c) AS c FROM counts GROUP BY ALL)
), distances AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM places a JOIN places b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN distances d ON d.lang = a.lang AND d.source = a.source AND d.item = b.source
), terms AS (
  SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM shares JOIN general USING (lang, term) WHERE c > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS place
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(place AS INT) AS rank FROM ranked WHERE part = 'pair' OR place <= 50
"""


def _repair_sql():
    """Cheapest edits by dynamic programming, turn by turn: for each state the least (cost, audit, repaired lines)."""

    def add(state, cost, letter, line=None):
        lines = f"{state}.t" if line is None else f"{state}.t || chr(10) || {line}"
        return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 't': {lines}}}"

    def when(test, value):
        return f"CASE WHEN {test} THEN {value} ELSE far END"

    user, assistant, own = "'user:'", "'assistant:'", "role || ':' || text"
    twice = [add(s, 6, "II", f"{user} || chr(10) || {assistant}") for s in ("d0", "d1")]
    e2 = ", ".join(["d2", *[add(s, 3, "I", user) for s in ("d0", "d1", "d3")]])
    e3 = ", ".join(["d3", add("d2", 3, "I", assistant), *twice])
    stays = "NOT gone"
    reroled = {name: f"'{name}:' || text" for name in ("user", "assistant")}
    n1 = ", ".join([add("e1", 4, "D"), when(f"{stays} AND initial = 's'", add("e0", "cut", "K", own))])
    before = ("e0", "e1", "e3")
    n2 = [add("e2", 4, "D")]
    n2 += [when(f"{stays} AND initial = 'u'", add(s, "cut", "K", own)) for s in before]
    n2 += [when(stays, add(s, "cut + 3", "R", reroled["user"])) for s in before]
    n3 = [add("e3", 4, "D"), when(f"{stays} AND initial = 'a'", add("e2", "cut", "K", own))]
    n3 += [when(stays, add("e2", "cut + 3", "R", reroled["assistant"]))]
    return rf"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key
  FROM conversations
), hashed AS (
  SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(key, ''), lambda c: ascii(c)::BIGINT)),
    lambda crc, b: list_reduce(list_prepend(xor(crc, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
      lambda a, i: xor(a >> 1, 3988292384::BIGINT * (a & 1)))), 4294967295::BIGINT) % 20 AS kind
  FROM keyed
), turns AS (
  SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM hashed, (SELECT unnest([1, 2]) AS copy) WHERE kind <> 0 AND (copy = 1 OR kind = 3)
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place, substr(role, 1, 1) AS initial,
    NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank, NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS open
  FROM turns
), faults AS (
  SELECT *, NOT blank AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY place) > 1 AS duplicate,
    lag(initial) OVER (PARTITION BY conv_id ORDER BY place) || initial NOT IN ('su', 'ua', 'au') AS illegal,
    count(*) OVER (PARTITION BY conv_id) AS n
  FROM placed
), coded AS (
  SELECT *, blank OR duplicate AS gone, CASE WHEN open AND NOT blank AND NOT duplicate THEN 3 ELSE 0 END AS cut FROM faults
), steps AS (
  SELECT conv_id, 0::BIGINT AS step, {{'c': 0, 'a': '', 't': ''}} AS d0, far AS d1, far AS d2, far AS d3
  FROM (SELECT DISTINCT conv_id, {{'c': 1000000, 'a': '', 't': ''}} AS far FROM conversations)
  UNION ALL
  SELECT conv_id, step, {add("e0", 4, "D")}, least({n1}), least({", ".join(n2)}), least({", ".join(n3)})
  FROM (
    SELECT s.conv_id, place AS step, role, text, initial, gone, cut, {{'c': 1000000, 'a': '', 't': ''}} AS far,
      d0 AS e0, d1 AS e1, least({e2}) AS e2, least({e3}) AS e3
    FROM steps s JOIN coded c ON s.conv_id IS NOT DISTINCT FROM c.conv_id AND c.place = s.step + 1
  )
), ends AS (
  SELECT conv_id, step, least(d0, least({e3})) AS best FROM steps
), counts AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(blank) AS blank,
    count_if(duplicate) AS duplicate, count_if(cut > 0) AS truncated, count_if(illegal) AS illegal
  FROM coded GROUP BY conv_id
)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank, CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate,
  CAST(coalesce(truncated, 0) AS BIGINT) AS truncated, CAST(coalesce(illegal, 0) AS BIGINT) AS illegal,
  CAST(best.c AS BIGINT) AS cost, best.a AS audit, sha256(substr(best.t, 2)) AS repaired_sha256
FROM ends e LEFT JOIN counts c ON e.conv_id IS NOT DISTINCT FROM c.conv_id WHERE step = coalesce(n, 0)
"""


ORACLE["op11_conversation_repair"] = _repair_sql()
