"""DuckDB SQL for the registered queries that SQL can express."""

from __future__ import annotations

from weftline.llm import quality_rules as q
from weftline.llm.licenses import TEMPLATES, THRESHOLD

_LETTERS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def _quality_rules() -> str:
    cutoffs = ", ".join(f"({i}, {c}::DOUBLE)" for i, c in enumerate(q.CUTOFFS))
    shares = " UNION ALL ".join(
        f"SELECT stratum, good, '{r}' AS rule, {r} AS share FROM labelled" for r in q.RULES
    )
    limits = ", ".join(f"max(cutoff) FILTER (rule = '{r}') AS {r}" for r in q.RULES)
    over = " OR ".join(f"coalesce(m.{r} > t.{r}, false)" for r in q.RULES)
    return f"""
    WITH body AS (SELECT doc_id, lang, coalesce(text, '') AS t FROM documents),
    parts AS (
        SELECT doc_id, lang, t, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS w,
               list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines,
               length(regexp_replace(t, '[\\x20\\x09-\\x0D]+', '', 'g')) AS word_chars
        FROM body),
    numbered AS (SELECT row_number() OVER () AS rid, * FROM parts),
    each AS (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM numbered),
    gram AS (SELECT rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM each),
    repeated AS (SELECT rid, i FROM gram QUALIFY count(*) OVER (PARTITION BY rid, g) > 1),
    covered AS (
        SELECT rid, count(DISTINCT i + j) AS n FROM repeated, (VALUES (0), (1), (2)) AS o(j) GROUP BY rid),
    counts AS (
        SELECT doc_id, lang, len(w) AS n_words, word_chars,
               length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
               len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
               coalesce(c.n, 0) AS n_repeat_words,
               length(t) - length(regexp_replace(t, '\\p{{Lu}}+', '', 'g')) AS n_upper
        FROM numbered LEFT JOIN covered c USING (rid)),
    measures AS (
        SELECT *, CASE WHEN word_chars > 0 THEN n_symbols::DOUBLE / word_chars ELSE 0 END AS symbols,
               CASE WHEN word_chars > 0 THEN n_upper::DOUBLE / word_chars ELSE 0 END AS upper,
               CASE WHEN n_lines > 0 THEN n_dup_lines::DOUBLE / n_lines ELSE 0 END AS lines,
               CASE WHEN n_words > 0 THEN n_repeat_words::DOUBLE / n_words ELSE 0 END AS repeats
        FROM counts),
    clean AS (
        SELECT doc_id, min(quality) = 1 AS good FROM labels WHERE quality IS NOT NULL
        GROUP BY doc_id HAVING min(quality) = max(quality)),
    labelled AS (SELECT m.lang AS stratum, c.good, m.* FROM measures m JOIN clean c USING (doc_id)),
    shares AS ({shares}),
    grid AS (
        SELECT stratum, rule, nth, cutoff, count(*) FILTER (good) AS good,
               count(*) FILTER (good AND share > cutoff) AS lost, count(*) FILTER (NOT good) AS bad,
               count(*) FILTER (NOT good AND share > cutoff) AS caught
        FROM shares, (VALUES {cutoffs}) AS c(nth, cutoff) GROUP BY ALL),
    tails AS (
        SELECT *, (SELECT count(*) FROM (SELECT DISTINCT stratum FROM labelled)) AS strata,
               CASE WHEN lost >= good * {q.ALPHA} THEN 1.0 ELSE
               list_sum(list_transform(range(0, lost + 1), lambda j: exp(
                   lgamma(good + 1) - lgamma(j + 1) - lgamma(good - j + 1)
                   + j * ln({q.ALPHA}) + (good - j) * ln(1 - {q.ALPHA})))) END AS p
        FROM grid),
    walked AS (
        SELECT *, min(p <= {q.DELTA} / ({len(q.RULES)} * strata))
                      OVER (PARTITION BY stratum, rule ORDER BY nth) AS certified
        FROM tails),
    gains AS (
        SELECT *, caught::DOUBLE / nullif(bad, 0) - {q.PENALTY} * lost / good AS gain
        FROM walked WHERE certified),
    best AS (
        SELECT stratum, rule, cutoff FROM gains WHERE gain > 0
        QUALIFY row_number() OVER (PARTITION BY stratum, rule ORDER BY gain DESC, nth) = 1),
    cut AS (SELECT stratum, {limits} FROM best GROUP BY stratum)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
           n_words < {q.MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed,
           NOT (n_words < {q.MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words)
               AND NOT ({over}) AS kept
    FROM measures m LEFT JOIN cut t ON m.lang IS NOT DISTINCT FROM t.stratum
    """


_URL_FILTER = f"""
    WITH parts AS (
        SELECT page_id, coalesce(CASE WHEN contains(url, '://') THEN
               substr(url, strpos(url, '://') + 3) END, '') AS rest FROM pages),
    split AS (
        SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), {_LETTERS}) AS host,
               regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM parts),
    rules(h, p, v) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
                              ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
    numbered AS (SELECT row_number() OVER () AS rid, * FROM split),
    fits AS (
        SELECT rid, h || p AS rule, v FROM numbered, rules
        WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
        QUALIFY row_number() OVER (PARTITION BY rid ORDER BY length(h || p) DESC, length(h) DESC) = 1)
    SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict
    FROM numbered LEFT JOIN fits USING (rid)
"""


_DECONTAMINATION = rf"""
    WITH RECURSIVE docs AS (
        SELECT row_number() OVER () AS rid, doc_id,
               regexp_extract_all(translate(coalesce(text, ''), {_LETTERS}),
                                  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
    items AS (
        SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), {_LETTERS}),
                                           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
    item_at AS (
        SELECT item_id, w, least(13, len(w)) AS span,
               unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM items WHERE len(w) > 0),
    windows AS (
        SELECT DISTINCT item_id, span, array_to_string(list_slice(w, i, i + span - 1), ' ') AS gram
        FROM item_at),
    doc_at AS (
        SELECT rid, w, span, unnest(range(1, len(w) - span + 2)) AS i
        FROM docs, (SELECT DISTINCT span FROM windows) WHERE len(w) >= span),
    grams AS (
        SELECT rid, i, span, array_to_string(list_slice(w, i, i + span - 1), ' ') AS gram FROM doc_at),
    hits AS (SELECT rid, i, span, item_id FROM grams JOIN windows USING (span, gram)),
    places AS (SELECT DISTINCT rid, unnest(range(i, i + span)) AS at FROM hits),
    covered AS (SELECT rid, count(*) AS n_hit FROM places GROUP BY rid),
    named AS (
        SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
        FROM (SELECT DISTINCT rid, item_id::VARCHAR AS item FROM hits WHERE item_id IS NOT NULL) GROUP BY rid)
    SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           sha256(coalesce(names, '')) AS items_sha256,
           coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
    FROM docs LEFT JOIN covered USING (rid) LEFT JOIN named USING (rid)
"""


_NEAR_DUP = rf"""
    WITH RECURSIVE docs AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_LETTERS}),
                                          '[^\x20\x09-\x0D]+') AS w FROM documents),
    each AS (
        SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 4) + 1)) AS i FROM docs WHERE len(w) > 0),
    shingles AS (
        SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 4), ' ') AS s FROM each),
    sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
    common AS (
        SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
        FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
    links AS (
        SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
        WHERE 100 * c >= 75 * (x.n + y.n - c)),
    steps AS (SELECT a AS p, b AS q FROM links UNION ALL SELECT b, a FROM links),
    reach AS (
        SELECT p, q FROM steps UNION SELECT reach.p, steps.q FROM reach JOIN steps ON reach.q = steps.p),
    least AS (SELECT p AS doc_id, min(q) AS other FROM reach GROUP BY p)
    SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(other, doc_id)) AS component_id,
           doc_id = least(doc_id, coalesce(other, doc_id)) AS kept
    FROM docs LEFT JOIN sizes USING (doc_id) LEFT JOIN least USING (doc_id)
"""


def _license_scan() -> str:
    quoted = [(n, name, text.replace("'", "''")) for n, (name, text) in enumerate(sorted(TEMPLATES))]
    listed = ", ".join(f"({n}, '{name}', '{text}')" for n, name, text in quoted)
    pattern = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

    def bigrams(source: str, keys: str) -> str:
        words = f"regexp_extract_all(translate(body, {_LETTERS}), {pattern})"
        return f"""
            SELECT DISTINCT {keys}, w[i] || ' ' || w[i + 1] AS g FROM (
                SELECT {keys}, w, unnest(range(1, len(w))) AS i
                FROM (SELECT {keys}, {words} AS w FROM {source}))"""

    return f"""
    WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS body FROM documents),
    texts(t, license, body) AS (VALUES {listed}),
    lines AS (
        SELECT rid, unnest(string_split(body, chr(10))) AS body,
               unnest(range(0, len(string_split(body, chr(10))))) AS line FROM docs),
    units AS (SELECT rid, body, line FROM lines UNION ALL SELECT rid, body, -1 FROM docs),
    of_unit AS ({bigrams("units", "rid, line")}),
    of_text AS ({bigrams("texts", "t, license")}),
    unit_size AS (SELECT rid, line, count(*) AS a FROM of_unit GROUP BY ALL),
    text_size AS (SELECT t, count(*) AS b FROM of_text GROUP BY ALL),
    common AS (SELECT rid, line, t, license, count(*) AS c FROM of_unit JOIN of_text USING (g) GROUP BY ALL),
    matched AS (
        SELECT rid, line, license, 2 * c / (a + b) AS dice
        FROM common JOIN unit_size USING (rid, line) JOIN text_size USING (t)
        WHERE 2 * c / (a + b) >= {THRESHOLD}
        QUALIFY row_number() OVER (
            PARTITION BY rid ORDER BY dice DESC, line = -1, line, t) = 1)
    SELECT doc_id, license, dice, line FROM docs LEFT JOIN matched USING (rid)
    """


def _conversation_repair() -> str:
    """A walk over each conversation's rows, with the least (cost, audit, text) in every state."""
    crc = """xor(list_reduce(
        list_prepend(4294967295::BIGINT, list_transform(string_split(name, ''), lambda x: ord(x)::BIGINT)),
        lambda r, b: list_reduce(
            list_prepend(xor(r, b), range(8)), lambda x, i: xor(x >> 1, 3988292384::BIGINT * (x & 1)))),
        4294967295::BIGINT)"""

    def step(state: str, role: str, edit: str, cost: str) -> str:
        """A row that stays, from a state."""
        text = "role || ':' || body" if edit == "K" else f"'{role}:' || body"
        fits = f"initial = '{role[0]}'" if edit == "K" else "true"
        return f"""CASE WHEN {state} IS NOT NULL AND fault NOT IN ('blank', 'duplicate') AND {fits} THEN
            {{'c': {state}.c + {cost} + more, 'a': {state}.a || '{edit}', 't': {state}.t || chr(10) || {text}}} END"""

    def dropped(state: str) -> str:
        return f"""CASE WHEN {state} IS NOT NULL THEN
            {{'c': {state}.c + 2, 'a': {state}.a || 'D', 't': {state}.t}} END"""

    def put(state: str, role: str) -> str:
        return f"""CASE WHEN {state} IS NOT NULL THEN
            {{'c': {state}.c + 5, 'a': {state}.a || 'I', 't': {state}.t || chr(10) || '{role}:'}} END"""

    def least(*options: str) -> str:
        return f"list_min([{', '.join(options)}])"

    def stays(state: str, role: str) -> list[str]:
        return [step(state, role, "K", "0"), step(state, role, "R", "1")]

    return f"""
    WITH RECURSIVE named AS (
        SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS body,
               coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name
        FROM conversations),
    kinds AS (SELECT * EXCLUDE (name), {crc} % 20 AS kind FROM named),
    damaged AS (
        SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
               CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(body, '.!?', '') ELSE body END AS body,
               unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
        FROM kinds),
    placed AS (
        SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, body) AS pos,
               left(role, 1) AS initial,
               right(regexp_replace(body, '[\x20\x09-\x0D]+$', ''), 1) AS ending
        FROM damaged),
    judged AS (
        SELECT *, CASE WHEN ending = '' THEN 'blank'
                       WHEN row_number() OVER (PARTITION BY conv_id, role, body ORDER BY pos) > 1 THEN 'duplicate'
                       WHEN ending NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
               lag(initial) OVER (PARTITION BY conv_id ORDER BY pos) || initial AS two
        FROM placed),
    rows AS (SELECT *, CASE fault WHEN 'truncated' THEN 5 ELSE 0 END AS more FROM judged),
    faults AS (
        SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
               count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
               count(*) FILTER (fault = 'truncated') AS truncated,
               count(*) FILTER (two NOT IN ('su', 'ua', 'au')) AS illegal
        FROM rows GROUP BY conv_id),
    walk AS (
        SELECT conv_id, 0::BIGINT AS pos, {{'c': 0::BIGINT, 'a': '', 't': ''}} AS s0,
               CAST(NULL AS STRUCT(c BIGINT, a VARCHAR, t VARCHAR)) AS s1,
               {{'c': 5::BIGINT, 'a': 'I', 't': chr(10) || 'user:'}} AS s2,
               {{'c': 10::BIGINT, 'a': 'II', 't': chr(10) || 'user:' || chr(10) || 'assistant:'}} AS s3
        FROM faults
        UNION ALL
        SELECT conv_id, pos, s0, s1, s2, {least("s3", put("s2", "assistant"))} AS s3 FROM (
            SELECT conv_id, pos, s0, s1, s3,
                   {least("s2", put("s0", "user"), put("s1", "user"), put("s3", "user"))} AS s2
            FROM (
                SELECT w.conv_id, r.pos, {dropped("s0")} AS s0,
                       {least(step("s0", "system", "K", "0"), dropped("s1"))} AS s1,
                       {least(*stays("s0", "user"), *stays("s1", "user"), *stays("s3", "user"), dropped("s2"))} AS s2,
                       {least(*stays("s2", "assistant"), dropped("s3"))} AS s3
                FROM walk w JOIN rows r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.pos = w.pos + 1))),
    ends AS (
        SELECT f.*, {least("s0", "s3")} AS best
        FROM walk w JOIN faults f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.n = w.pos),
    ids AS (SELECT DISTINCT conv_id FROM conversations)
    SELECT ids.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
           coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
           CAST(coalesce(best.c, 0) AS BIGINT) AS cost, coalesce(best.a, '') AS audit,
           sha256(coalesce(substr(best.t, 2), '')) AS repaired_sha256
    FROM ids LEFT JOIN ends e ON e.conv_id IS NOT DISTINCT FROM ids.conv_id
    """


_PHRASES = f"""
    WITH texts AS (
        SELECT row_number() OVER () AS rid, coalesce(lang, 'und') AS lang,
               translate(coalesce(text, ''), {_LETTERS}) AS t FROM documents),
    pieces AS (
        SELECT row_number() OVER () AS pid, lang, w FROM (
            SELECT lang, regexp_extract_all(unnest(regexp_split_to_array(t, '[.,;:!?\\x0A-\\x0D]')), '[^\\x20\\x09]+') AS w
            FROM texts)),
    places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM pieces),
    runs AS (
        SELECT lang, k, CASE k WHEN 1 THEN w[i] WHEN 2 THEN w[i] || ' ' || w[i + 1]
                               ELSE w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] END AS phrase
        FROM places, (VALUES (1), (2), (3)) AS s(k) WHERE i + k - 1 <= len(w)),
    counts AS (SELECT lang, k, phrase, count(*) AS f, string_split(phrase, ' ') AS w FROM runs GROUP BY ALL),
    totals AS (SELECT lang, sum(f) AS n FROM counts WHERE k = 1 GROUP BY lang),
    candidates AS (SELECT * FROM counts WHERE k > 1 AND f >= 10),
    held AS (
        SELECT lang, phrase, max(f) AS most FROM (
            SELECT lang, f, w[1] || ' ' || w[2] AS phrase FROM candidates WHERE k = 3
            UNION ALL SELECT lang, f, w[2] || ' ' || w[3] FROM candidates WHERE k = 3)
        GROUP BY ALL),
    kept AS (
        SELECT c.* FROM candidates c LEFT JOIN held h USING (lang, phrase)
        WHERE h.most IS NULL OR 100 * h.most < 50 * c.f),
    cuts AS (
        SELECT lang, phrase, f AS a, cut, array_to_string(w[1:cut], ' ') AS head,
               array_to_string(w[cut + 1:], ' ') AS tail
        FROM kept, (VALUES (1), (2)) AS c(cut) WHERE cut < k),
    scored AS (
        SELECT c.lang, c.phrase, c.a, cut, x.f AS l, y.f AS r,
               CAST((1000000::HUGEINT * c.a * c.a) // (x.f::HUGEINT * y.f) AS BIGINT) AS score
        FROM cuts c JOIN counts x ON x.lang = c.lang AND x.phrase = c.head
        JOIN counts y ON y.lang = c.lang AND y.phrase = c.tail
        QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY score, cut) = 1)
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
           phrase, a, l, r, CAST(n AS BIGINT) AS n, score
    FROM scored JOIN totals USING (lang)
    QUALIFY rank <= 2000
    """


def oracle_sql() -> dict[str, str]:
    return {
        "op1_quality_rules": _quality_rules(),
        "op2_license_scan": _license_scan(),
        "op5_near_dup": _NEAR_DUP,
        "op8_decontamination": _DECONTAMINATION,
        "op10_url_filter": _URL_FILTER,
        "op11_phrases": _PHRASES,
        "op12_conversation_repair": _conversation_repair(),
    }
