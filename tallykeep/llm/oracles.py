"""DuckDB SQL for the queries that SQL can express over whole tables.

Written from the definitions, over words and windows as rows; nothing is hashed, sampled
or searched. The other queries are tested against plain Python: op4 (boosted trees), op6 (a trained tree), op8 (a tokenizer) and op9 (a learned tree).
"""

from __future__ import annotations

from tallykeep.llm import chat, decontaminate, ngram_join, quality, repeats, resample, search

_SPACE = r"[\x20\x09-\x0D]"
# Words of operator 11, after lowering, and terms of operator 12, before it.
_PLAIN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _words(text: str) -> str:
    """Words of a text as a list."""
    return f"list_filter(string_split_regex(coalesce({text}, ''), '{_SPACE}+'), lambda word: word <> '')"


def _lower(text: str) -> str:
    return f"translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _grams(name: str, source: str, key: str, size: str) -> str:
    """Rows (key, pos, gram) of the n-grams of word lists; shorter lists give none."""
    return f"""{name} AS (
      SELECT {key}, pos, list_aggregate(words[pos : pos + {size} - 1], 'string_agg', ' ') AS gram
      FROM (SELECT *, unnest(range(1, len(words) - {size} + 2)) AS pos FROM {source} WHERE len(words) >= {size}))"""


def _op1() -> str:
    size, percent = ngram_join.JOIN.words, ngram_join.JOIN.percent
    return f"""WITH RECURSIVE d AS (SELECT doc_id, {_words(_lower('text'))} AS words FROM documents),
    sized AS (SELECT doc_id, words, greatest(1, least(len(words), {size})) AS width FROM d WHERE len(words) > 0),
    {_grams('grams', 'sized', 'doc_id', 'width')},
    sets AS (SELECT DISTINCT doc_id, gram FROM grams),
    sizes AS (SELECT doc_id, COUNT(*) AS n FROM sets GROUP BY doc_id),
    links AS (
      SELECT a.doc_id AS a, b.doc_id AS b FROM sets a JOIN sets b ON a.gram = b.gram AND a.doc_id <> b.doc_id
      JOIN sizes s ON s.doc_id = a.doc_id JOIN sizes t ON t.doc_id = b.doc_id
      GROUP BY a.doc_id, b.doc_id, s.n, t.n HAVING 100 * COUNT(*) >= {percent} * (s.n + t.n - COUNT(*))),
    reached(start, node) AS (
      SELECT doc_id, doc_id FROM d UNION SELECT r.start, l.b FROM reached r JOIN links l ON l.a = r.node)
    SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, r.component_id
    FROM d LEFT JOIN sizes s ON s.doc_id = d.doc_id
    JOIN (SELECT start, MIN(node) AS component_id FROM reached GROUP BY start) r ON r.start = d.doc_id"""


def _op2() -> str:
    stops = ", ".join("'" + form.replace("'", "''") + "'" for form in quality.STOP_FORMS)
    names = {
        "mean_word_chars": "word_chars / nullif(n_words, 0)",
        "symbols_per_word": "n_symbols / nullif(n_words, 0)",
        "stop_word_ratio": "n_stop_words / nullif(n_words, 0)",
        "duplicate_line_ratio": "n_dup_lines / nullif(n_lines, 0)",
        "words_per_line": "n_words / nullif(n_lines, 0)",
    }
    passes = ["NOT base_failed"]
    for rule in quality.RULES:
        passes += [f"coalesce({rule.measure} >= {rule.least}, FALSE)"] if rule.least is not None else []
        passes += [f"coalesce({rule.measure} <= {rule.most}, FALSE)"] if rule.most is not None else []
    return f"""WITH d AS (
      SELECT doc_id, coalesce(text, '') AS text, {_words('text')} AS words,
             list_filter(string_split(coalesce(text, ''), chr(10)), lambda line: regexp_matches(line, '[^\\x20\\x09-\\x0D]')) AS lines
      FROM documents),
    {_grams('grams', 'd', 'doc_id', '3')},
    twice AS (SELECT doc_id, gram FROM grams GROUP BY ALL HAVING COUNT(*) > 1),
    covered AS (
      SELECT doc_id, COUNT(DISTINCT pos + step) AS n
      FROM grams JOIN twice USING (doc_id, gram), (SELECT unnest([0, 1, 2]) AS step) GROUP BY doc_id),
    stops AS (
      SELECT doc_id, COUNT(*) AS n FROM (SELECT doc_id, unnest(words) AS word FROM d) WHERE word IN ({stops}) GROUP BY doc_id),
    counts AS (
      SELECT d.doc_id, len(words) AS n_words, length(regexp_replace(text, '{_SPACE}', '', 'g')) AS word_chars,
             length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
             len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words,
             len(lines) AS n_lines, coalesce(stops.n, 0) AS n_stop_words
      FROM d LEFT JOIN covered ON covered.doc_id = d.doc_id LEFT JOIN stops ON stops.doc_id = d.doc_id),
    measured AS (
      SELECT *, {', '.join(f'{value} AS {name}' for name, value in names.items())},
             n_words < {quality.LEAST_WORDS} OR 100 * n_repeat_words > {quality.MOST_REPEATED_PERCENT} * n_words AS base_failed
      FROM counts)
    SELECT *, {' AND '.join(passes)} AS kept FROM measured"""


def _op3() -> str:
    size = repeats.PASSAGE_WORDS
    return f"""WITH d AS (SELECT doc_id, {_words('text')} AS words FROM documents),
    {_grams('grams', 'd', 'doc_id', str(size))},
    first AS (SELECT gram, MIN(doc_id) AS first_id FROM grams GROUP BY gram),
    removed AS (
      SELECT DISTINCT doc_id, pos + step AS pos
      FROM (SELECT doc_id, pos FROM grams JOIN first USING (gram) WHERE first_id < doc_id),
           (SELECT unnest(range({size})) AS step)),
    kept AS (
      SELECT doc_id, COUNT(*) AS n, string_agg(word, ' ' ORDER BY pos) AS text
      FROM (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS pos FROM d)
      ANTI JOIN removed USING (doc_id, pos) GROUP BY doc_id)
    SELECT d.doc_id, len(words) AS n_words, len(words) - coalesce(k.n, 0) AS n_removed,
           sha256(coalesce(k.text, '')) AS kept_sha256
    FROM d LEFT JOIN kept k ON k.doc_id = d.doc_id"""


def _op5() -> str:
    """The crawl of the pages as rows; a 304 is answered by an as-of join of captures."""
    each, again = 60, 60_030
    rest = "regexp_replace(regexp_replace(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.\\-]*://', ''), '#.*$', '', 's')"
    host = "regexp_replace(regexp_replace(lower(regexp_extract(rest, '^[^/?]*')), '^www\\.', ''), ':(80|443)$', '')"
    shown = "strftime(make_timestamp({at} * 1000000), '%Y-%m-%dT%H:%M:%SZ')"
    return f"""WITH rests AS (SELECT page_id, {rest} AS rest, coalesce(html, '') AS html FROM pages WHERE page_id IS NOT NULL),
    split AS (
      SELECT page_id, html, {host} AS host, regexp_replace(regexp_extract(rest, '^[^/?]*([^?]*)', 1), '/+$', '') AS path,
        list_sort(list_filter(string_split(regexp_extract(rest, '\\?(.*)$', 1, 's'), '&'),
          lambda one: one <> '' AND NOT regexp_matches(one, '^(utm_[^=&]*|ref|fbclid|gclid)(=[^&]*)?$'))) AS kept
      FROM rests),
    captures AS (
      SELECT page_id, page_id * {each} AS seconds, '"' || md5(html) || '"' AS tag, octet_length(encode(html)) AS n,
        host || path || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(kept, '&') ELSE '' END AS url_key
      FROM split),
    revisits AS (SELECT page_id, seconds + {again} AS seconds, tag, url_key FROM captures),
    met AS (
      SELECT r.page_id, r.url_key, r.seconds, r.tag, s.page_id AS source, s.seconds AS source_at, s.tag AS source_tag, s.n
      FROM revisits r ASOF LEFT JOIN (SELECT * FROM captures WHERE url_key <> '') s ON r.url_key = s.url_key AND r.seconds > s.seconds),
    judged AS (
      SELECT *, CASE WHEN source IS NULL THEN 'unresolved' WHEN tag = source_tag THEN 'resolved' ELSE 'mismatch' END AS outcome
      FROM met)
    SELECT page_id, url_key, seconds AS "at", outcome, CASE WHEN outcome = 'resolved' THEN source END AS source_page_id,
      CASE WHEN outcome = 'resolved' THEN source_at END AS source_at,
      CASE WHEN outcome = 'resolved' THEN 'cache-control: max-age=60' || chr(10) || 'content-length: ' || n || chr(10)
        || 'content-type: text/html' || chr(10) || 'date: ' || {shown.format(at='seconds')} || chr(10) || 'etag: ' || tag END AS header
    FROM judged"""


def _op7() -> str:
    width, percent = decontaminate.SHINGLE_WORDS, decontaminate.CONTAINED_PERCENT
    return f"""WITH items AS (
      SELECT item_id, words, least(len(words), {width}) AS width
      FROM (SELECT item_id, {_words(_lower('text'))} AS words FROM benchmark) WHERE len(words) > 0),
    {_grams('item_grams', 'items', 'item_id, width', 'width')},
    wanted AS (SELECT DISTINCT item_id, width, gram FROM item_grams),
    sizes AS (SELECT item_id, COUNT(*) AS n FROM wanted GROUP BY item_id),
    docs AS (
      SELECT doc_id, words, width
      FROM (SELECT doc_id, {_words(_lower('text'))} AS words FROM documents), (SELECT DISTINCT width FROM items)),
    {_grams('doc_grams', 'docs', 'doc_id, width', 'width')},
    held AS (SELECT DISTINCT doc_id, width, gram FROM doc_grams SEMI JOIN wanted USING (width, gram))
    SELECT doc_id, item_id, MAX(s.n) AS n_item_shingles, COUNT(*) AS n_shared
    FROM held JOIN wanted USING (width, gram) JOIN sizes s USING (item_id)
    GROUP BY doc_id, item_id HAVING 100 * COUNT(*) >= {percent} * MAX(s.n)"""


def _op10() -> str:
    def escaped(text: str) -> str:
        return rf"regexp_replace({text}, '([\\\[\]<~])', '\\\1', 'g')"

    return f"""WITH given AS (
      SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
      UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
    counted AS (
      SELECT *, len({_words('text')}) + {chat.TURN_MARKS} AS tokens, length({escaped('role')}) + 2 AS head,
             length({escaped('text')}) + {len(chat.CLOSE)} AS body FROM given),
    placed AS (
      SELECT *, row_number() OVER w AS place, sum(tokens) OVER w - tokens AS before,
             first_value(CASE WHEN role = 'system' THEN tokens END) OVER w AS system_tokens,
             first_value(CASE WHEN role = 'system' THEN head + body END) OVER w AS system_chars
      FROM counted WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text
                                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
    spans AS (
      SELECT *, CAST(floor(before / greatest(floor(({chat.BUDGET - chat.HISTORY} - coalesce(system_tokens, 0)) / 2), 1)) AS BIGINT) AS span
      FROM placed),
    opened AS (
      SELECT *, coalesce(lag(span) OVER (PARTITION BY conv_id ORDER BY place) <> span, FALSE) AS opens FROM spans),
    again AS (
      SELECT t.conv_id, sum(t.head + t.body + 1) AS chars
      FROM opened t JOIN opened u ON u.conv_id IS NOT DISTINCT FROM t.conv_id AND u.opens
       AND u.before - t.before BETWEEN 1 AND {chat.HISTORY}
      WHERE NOT (t.place = 1 AND t.system_chars IS NOT NULL) GROUP BY t.conv_id)
    SELECT o.conv_id, COUNT(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
           coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '')) AS loss_sha256,
           CAST({len(chat.OPEN)} * COUNT(DISTINCT span) + sum(head + body)
             + coalesce(sum(system_chars + 1) FILTER (opens), 0) + coalesce(max(a.chars), 0) AS BIGINT) AS formatted_chars
    FROM opened o LEFT JOIN again a ON a.conv_id IS NOT DISTINCT FROM o.conv_id
    GROUP BY o.conv_id"""


def _op11() -> str:
    draw = resample.DEFAULT
    features = f"SELECT unnest(words) AS feature FROM (SELECT regexp_extract_all({_lower('text')}, '{_PLAIN}') AS words FROM {{}})"
    return f"""WITH d AS (SELECT doc_id, regexp_extract_all({_lower("coalesce(text, '')")}, '{_PLAIN}') AS words FROM documents),
    crc AS (
      SELECT list_transform(range(256), lambda one: list_reduce(range(8),
               lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, one)) AS steps),
    held AS (SELECT feature, COUNT(*) AS n FROM ({features.format('documents')}) GROUP BY feature),
    wanted AS (SELECT feature, COUNT(*) AS n FROM ({features.format('benchmark')}) GROUP BY feature),
    digits AS (SELECT feature, hex(encode(feature)) AS code FROM (SELECT feature FROM held UNION SELECT feature FROM wanted)),
    bytes AS (
      SELECT feature, list_transform(range(1, length(code), 2), lambda i:
               16 * (instr('0123456789ABCDEF', code[i]) - 1) + instr('0123456789ABCDEF', code[i + 1]) - 1) AS codes FROM digits),
    bucketed AS (
      SELECT feature, xor(4294967295, list_reduce(codes,
               lambda c, one: xor(c >> 8, steps[CAST(xor(c, one) & 255 AS BIGINT) + 1]), 4294967295)) % {draw.buckets} AS bucket
      FROM bytes, crc),
    s AS (SELECT bucket, SUM(n) AS s FROM held JOIN bucketed USING (feature) GROUP BY bucket),
    t AS (SELECT bucket, SUM(n) AS t FROM wanted JOIN bucketed USING (feature) GROUP BY bucket),
    totals AS (SELECT coalesce((SELECT SUM(n) FROM held), 0) AS s_all, coalesce((SELECT SUM(n) FROM wanted), 0) AS t_all),
    gains AS (
      SELECT bucket, CAST(floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (s_all + {draw.buckets})
               / ((s + 1)::DOUBLE * (t_all + {draw.buckets})))) AS BIGINT) AS gain
      FROM s LEFT JOIN t USING (bucket), totals),
    of_features AS (SELECT feature, gain FROM bucketed JOIN gains USING (bucket)),
    weights AS (
      SELECT doc_id, SUM(gain) AS weight FROM (SELECT doc_id, unnest(words) AS feature FROM d) JOIN of_features USING (feature)
      GROUP BY doc_id),
    scored AS (
      SELECT d.doc_id, len(words) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
             coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || sha256('{draw.seed}:' || d.doc_id)[1:8] AS BIGINT) + 0.5::DOUBLE)
               / 4294967296::DOUBLE))) AS BIGINT) AS score
      FROM d LEFT JOIN weights USING (doc_id)),
    ranked AS (
      SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, COUNT(*) OVER () AS eligible
      FROM scored WHERE n_features >= {draw.least_words})
    SELECT doc_id, n_features, weight, CAST(score AS BIGINT) AS score,
           CASE WHEN place <= {draw.percent} * eligible // 100 THEN place END AS rank
    FROM scored LEFT JOIN ranked USING (doc_id)"""


def _op12() -> str:
    rank = search.RANKING
    terms = f"regexp_extract_all(coalesce(text, ''), '{_TERM}')"
    return f"""WITH d AS (
      SELECT doc_id, list_transform({terms}, lambda one: {_lower('one')}) AS terms FROM documents),
    totals AS (SELECT COUNT(*) FILTER (len(terms) > 0) AS n_docs, SUM(len(terms)) AS n_terms FROM d),
    held AS (SELECT doc_id, term, COUNT(*) AS tf FROM (SELECT doc_id, unnest(terms) AS term FROM d) GROUP BY ALL),
    weights AS (
      SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * COUNT(*) + 1))) AS BIGINT) AS w
      FROM held, totals GROUP BY term, n_docs),
    factors AS (
      SELECT doc_id, {100 - rank.by_length} + ({rank.by_length} * len(terms) * n_docs) // n_terms AS m FROM d, totals WHERE len(terms) > 0),
    asked AS (
      SELECT item_id, {_lower('term')} AS term, COUNT(*) AS times FROM (SELECT item_id, unnest({terms}) AS term FROM benchmark) GROUP BY ALL),
    scored AS (
      SELECT item_id, doc_id, SUM(times * w * ((1000000000 * tf) // (1000 * tf + {rank.eighths} * m))) AS score
      FROM asked JOIN weights USING (term) JOIN held USING (term) JOIN factors USING (doc_id) GROUP BY item_id, doc_id),
    ranked AS (
      SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score
      FROM scored WHERE score > 0)
    SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= {search.HITS}"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_ngram_jaccard_join": _op1(),
        "op2_quality_rules": _op2(),
        "op3_substring_dedup": _op3(),
        "op5_warc_revisits": _op5(),
        "op7_decontamination": _op7(),
        "op10_chat_formatting": _op10(),
        "op11_importance_resampling": _op11(),
        "op12_lexical_search": _op12(),
    }
