"""SQL with the results of the operators that SQL can express."""

from __future__ import annotations

from sessionlens.llm import imatch, line_dedup, mixing, urls


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def url_rules(rules, vocabulary: urls.Vocabulary) -> str:
    def count(terms) -> str:
        return " + ".join(
            f"regexp_matches(lower(url), '(^|[^\\pL\\pN]){term}([^\\pL\\pN]|$)')::INT"
            for term in terms
        )

    values = ", ".join(
        f"({_quoted(r.text)}, {_quoted(r.verdict)}, {_quoted(r.host)}, {_quoted(r.path)})"
        for r in rules
    )
    return f"""
WITH parts AS (
  SELECT page_id, coalesce(url, '') AS url,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
rules(rule, rule_verdict, rule_host, rule_path) AS (VALUES {values}),
places AS (SELECT *, row_number() OVER () AS place FROM parts),
fits AS (
  SELECT place, arg_max(rule, (length(rule), rule)) AS rule,
    arg_max(rule_verdict, (length(rule), rule)) AS rule_verdict
  FROM places JOIN rules
    ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY place),
counted AS (
  SELECT *, ({count(vocabulary.strict)})::INT AS n_strict, ({count(vocabulary.soft)})::INT AS n_soft
  FROM places)
SELECT page_id, host, path, rule, n_strict, n_soft,
  coalesce(rule_verdict, CASE WHEN n_strict > 0 OR n_soft >= {vocabulary.soft_limit}
    THEN 'block' ELSE 'allow' END) AS verdict
FROM counted LEFT JOIN fits USING (place)"""


def imatch_fingerprints(least_share: float, most_share: float) -> str:
    mask = " + ".join(
        f"CASE WHEN ('0x' || substr(md5('{salt}:' || term), {1 + 2 * density}, 2))::INT"
        f" < {2 ** (imatch.DENSITIES - 1 - density)}"
        f" THEN {2 ** (salt * imatch.DENSITIES + density)}::BIGINT ELSE 0 END"
        for salt in range(imatch.SUBSETS_EACH)
        for density in range(imatch.DENSITIES)
    )
    dots = "." * imatch.HASH_CHARS
    hashes = " || ".join(
        f"coalesce(substr(md5(string_agg(term, ' ' ORDER BY term)"
        f" FILTER (WHERE mask & {2**k} <> 0)), 1, {imatch.HASH_CHARS}), '{dots}')"
        for k in range(imatch.SUBSETS)
    )

    def likeness(left: str, right: str) -> str:
        def part(text: str) -> str:
            return f"substr({text}, k * {imatch.HASH_CHARS} + 1, {imatch.HASH_CHARS})"

        used = (
            f"list_filter(range({imatch.SUBSETS}), lambda k: "
            f"{part(left)} <> '{dots}' OR {part(right)} <> '{dots}')"
        )
        equal = f"list_filter({used}, lambda k: {part(left)} = {part(right)})"
        return f"CASE WHEN len({used}) = 0 THEN 1.0 ELSE len({equal})::DOUBLE / len({used}) END"

    def terms(text: str) -> str:
        return (
            f"list_distinct(list_filter(string_split_regex(lower({text}),"
            " '[^\\pL\\pN]+'), lambda x: x <> ''))"
        )

    return f"""
WITH numbered AS (
  SELECT doc_id, coalesce(text, '') AS text,
    row_number() OVER (ORDER BY doc_id NULLS FIRST, coalesce(text, '')) AS place
  FROM documents),
with_next AS (
  SELECT doc_id, text, place, count(*) OVER () AS n,
    coalesce(lead(text) OVER (ORDER BY place), first_value(text) OVER (ORDER BY place)) AS next
  FROM numbered),
edited AS (
  SELECT doc_id, text, place, n, substr(text, 1, length(text) - length(text) // 2)
    || substr(next, 1, length(text) // 2) AS edited
  FROM with_next),
df AS (SELECT unnest({terms("text")}) AS term FROM numbered),
lexicon AS (
  SELECT term, {mask} AS mask FROM df GROUP BY term
  HAVING count(*) BETWEEN ceil({least_share} * (SELECT count(*) FROM numbered))
    AND {most_share} * (SELECT count(*) FROM numbered)),
sides AS (
  SELECT place, 0 AS side, unnest({terms("text")}) AS term FROM edited
  UNION ALL SELECT place, 1, unnest({terms("edited")}) FROM edited),
prints AS (
  SELECT place, side, {hashes} AS print FROM sides JOIN lexicon USING (term)
  GROUP BY place, side),
joined AS (
  SELECT e.doc_id, length(e.text)::BIGINT AS n_chars, sha256(e.edited) AS edited_sha256,
    coalesce(a.print, '{dots * imatch.SUBSETS}') AS fingerprint,
    coalesce(b.print, '{dots * imatch.SUBSETS}') AS edited_fingerprint,
    coalesce(c.print, '{dots * imatch.SUBSETS}') AS next_fingerprint
  FROM edited e
  LEFT JOIN prints a ON a.place = e.place AND a.side = 0
  LEFT JOIN prints b ON b.place = e.place AND b.side = 1
  LEFT JOIN prints c ON c.place = e.place % e.n + 1 AND c.side = 0)
SELECT doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
  {likeness("fingerprint", "edited_fingerprint")} AS near_edited,
  {likeness("fingerprint", "next_fingerprint")} AS near_next
FROM joined"""


def line_chunks(least_lines: int, least_chars: int) -> str:
    marked = "coalesce(text, '')"
    for separator in line_dedup.SEPARATORS:
        shown = separator.replace("\n", "' || chr(10) || '")
        marked = f"replace({marked}, '{shown}', '{shown}' || chr(1))"
    return f"""
WITH lines AS (
  SELECT doc_id, text, list_filter(string_split({marked}, chr(1)), lambda x: x <> '') AS u
  FROM documents),
hashed AS (
  SELECT *, list_transform(u, lambda x: ('0x' || substr(md5(x), 1, 8))::BIGINT) AS h FROM lines),
rolled AS (
  SELECT *, list_transform(h, lambda x, i:
    (coalesce(h[i - 1], 0) * {line_dedup.FACTOR} + x) % {line_dedup.HASH_RANGE}) AS r
  FROM hashed),
parted AS (
  SELECT *, list_filter(range(1, len(r) + 1), lambda i:
    i = len(r) OR coalesce(r[i] < r[i - 1] AND r[i] < r[i + 1], false)) AS b
  FROM rolled),
ended AS (
  SELECT *, list_sort(list_distinct(flatten(list_transform(b, lambda x, k:
    list_append(range(coalesce(b[k - 1], 0) + {line_dedup.MOST_LINES}, x,
      {line_dedup.MOST_LINES}), x))))) AS e
  FROM parted),
chunked AS (
  SELECT doc_id, text, len(e)::INT AS n_chunks, unnest(list_transform(e, lambda x, k: {{
    'place': k, 'lines': x - coalesce(e[k - 1], 0),
    'chunk': array_to_string(u[coalesce(e[k - 1], 0) + 1:x], '')}})) AS c
  FROM ended),
chunks AS (
  SELECT doc_id, c.place AS place, c.chunk AS chunk,
    c.lines >= {least_lines} AND length(c.chunk) >= {least_chars} AS counts
  FROM chunked),
firsts AS (SELECT chunk, min((doc_id, place)) AS first FROM chunks WHERE counts GROUP BY chunk),
judged AS (
  SELECT doc_id, place, c.chunk, counts AND (doc_id, place) <> first AS gone
  FROM chunks c LEFT JOIN firsts f ON f.chunk = c.chunk AND c.counts),
rebuilt AS (
  SELECT doc_id, count(*) FILTER (WHERE gone)::INT AS n_removed,
    coalesce(string_agg(chunk, '' ORDER BY place) FILTER (WHERE NOT coalesce(gone, false)), '')
      AS cleaned
  FROM judged GROUP BY doc_id)
SELECT doc_id, len(e)::INT AS n_chunks, coalesce(n_removed, 0)::INT AS n_removed,
  CASE WHEN n_removed > 0 THEN cleaned ELSE text END AS text
FROM ended LEFT JOIN rebuilt USING (doc_id)"""


def jaccard_classes(threshold: float, width: int) -> str:
    return f"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''),
    '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN []
    WHEN len(w) < {width} THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - {width} + 2),
      lambda i: array_to_string(w[i:i + {width - 1}], ' ')) END) AS s
  FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id),
links AS (
  SELECT a, b, c = x.n AND c = y.n AS same FROM common
  JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE c >= {threshold} * (x.n + y.n - c)),
reached(a, b) AS (
  SELECT a, b FROM links
  UNION SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b),
classes AS (SELECT a AS doc_id, min(b) AS least FROM reached GROUP BY a),
counts AS (
  SELECT a AS doc_id, count(*) AS n_links, count(*) FILTER (WHERE same) AS n_copies
  FROM links GROUP BY a)
SELECT doc_id, least(doc_id, coalesce(least, doc_id)) AS class_id,
  coalesce(n_links, 0) AS n_links, coalesce(n_copies, 0) AS n_copies
FROM documents LEFT JOIN classes USING (doc_id) LEFT JOIN counts USING (doc_id)"""


def temperature_mix(target: mixing.Target) -> str:
    """For a target whose budget is the number of tokens (no budget, no whole passes)."""

    def place(number: str) -> str:
        name = f"concat_ws(':', '{target.seed}', ({number})::BIGINT::VARCHAR, doc_id::VARCHAR)"
        return f"('0x' || substr(md5({name}), 1, {mixing.PLACE_BITS // 4}))::BIGINT"

    rounds = ["range_0 AS (SELECT 0.0::DOUBLE AS low, 1.0::DOUBLE AS high)"]
    for n in range(1, mixing.ROUNDS + 1):
        rounds.append(f"""
grid_{n} AS (
  SELECT low, high, low + (high - low) * k / {mixing.SECTIONS} AS a
  FROM range_{n - 1}, range({mixing.SECTIONS + 1}) AS t(k)),
beyond_{n} AS (
  SELECT max(a) AS a FROM (
    SELECT a, sum(pow(p, a)) AS z, sum(pow(p, a) * ln(pow(p, a))) AS e,
      max(pow(p, a) / tokens) AS most
    FROM grid_{n}, shares GROUP BY a)
  WHERE ln(z) - e / z > {target.entropy} * ln((SELECT count(*) FROM shares))
    OR most / z * (SELECT sum(tokens) FROM shares) > {target.max_repeats} * (1 + 1e-12)),
range_{n} AS (
  SELECT CASE WHEN b IS NULL THEN low WHEN b >= high THEN high ELSE b END AS low,
    CASE WHEN b IS NULL THEN low WHEN b >= high THEN high
      ELSE (SELECT min(a) FROM grid_{n} WHERE a > b) END AS high
  FROM (SELECT low, high, (SELECT a FROM beyond_{n}) AS b FROM range_{n - 1}))""")
    return f"""
WITH tokened AS (
  SELECT doc_id, source, coalesce(source, '') AS key,
    CASE WHEN coalesce(text, '') = '' THEN 0
      ELSE length(text) - length(translate(text, ' ' || chr(10), '')) + 1
        + length(text) - length(regexp_replace(text, '{mixing.UNSPACED}+', '', 'g'))
      END AS tokens
  FROM documents),
shares AS (
  SELECT key, sum(tokens)::BIGINT AS tokens,
    sum(tokens)::DOUBLE / (SELECT sum(tokens) FROM tokened)::DOUBLE AS p
  FROM tokened GROUP BY key HAVING sum(tokens) > 0),
{",".join(rounds)},
weighed AS (SELECT key, tokens, pow(p, (SELECT high FROM range_{mixing.ROUNDS})) AS w FROM shares),
plan AS (
  SELECT key, tokens AS source_tokens,
    round(w / (SELECT sum(w) FROM weighed) * (SELECT sum(tokens) FROM shares)::DOUBLE)::BIGINT AS budget
  FROM weighed),
placed AS (
  SELECT t.*, source_tokens, budget, budget // source_tokens AS passes,
    budget % source_tokens AS rest, {place("budget // source_tokens")} AS place
  FROM tokened t JOIN plan USING (key)),
used AS (
  SELECT *, sum(tokens) OVER (PARTITION BY key ORDER BY place) AS used FROM placed),
copies AS (
  SELECT *, unnest(range(passes + (rest > 0 AND used <= rest)::INT)) AS mix_pass FROM used)
SELECT doc_id, source, tokens::BIGINT AS tokens, mix_pass::INT AS mix_pass,
  least(floor((mix_pass + {place("mix_pass")} / {float(2**mixing.PLACE_BITS)}::DOUBLE)
    * source_tokens / budget * {target.out_blocks}), {target.out_blocks - 1})::INT AS mix_block
FROM copies"""


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _terms(text: str, pattern: str) -> str:
    return f"regexp_extract_all(translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}'), '{pattern}')"


def lexical_search(top: int) -> str:
    pattern = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    return f"""
WITH listed AS (
  SELECT row_number() OVER () AS place, doc_id, {_terms("text", pattern)} AS terms FROM documents),
totals AS (
  SELECT count(*) FILTER (WHERE len(terms) > 0) AS n_docs, sum(len(terms))::BIGINT AS n_all
  FROM listed),
item_terms AS (
  SELECT DISTINCT item_id, unnest({_terms("text", pattern)}) AS term FROM benchmark),
held AS (
  SELECT place, doc_id, n, term, count(*) AS tf
  FROM (SELECT place, doc_id, len(terms) AS n, unnest(terms) AS term FROM listed)
  WHERE term IN (SELECT term FROM item_terms) GROUP BY ALL),
weights AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM held, totals GROUP BY term, n_docs),
impacts AS (
  SELECT place, doc_id, term,
    (1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * n_docs) // n_all)) AS impact
  FROM held, totals),
scores AS (
  SELECT item_id, place, doc_id, sum(w * impact)::BIGINT AS score
  FROM item_terms JOIN impacts USING (term) JOIN weights USING (term)
  GROUP BY item_id, place, doc_id HAVING score > 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank
  FROM scores)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= {top}"""


def divergence(least_documents: int, top: int) -> str:
    pattern = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"

    def price(count: str, total: str) -> str:
        return f"1 + (1000000000::HUGEINT * ({count} + 1)) // ({total} + n_terms)"

    return f"""
WITH listed AS (
  SELECT row_number() OVER () AS place, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    {_terms("text", pattern)} AS terms
  FROM documents),
words AS (SELECT place, lang, source, unnest(terms) AS term FROM listed),
kept AS (
  SELECT lang, term, count(*) AS lang_n FROM words
  GROUP BY lang, term HAVING count(DISTINCT place) >= {least_documents}),
langs AS (
  SELECT lang, count(term) AS n_terms, coalesce(sum(lang_n), 0) AS lang_total
  FROM (SELECT DISTINCT lang FROM listed) LEFT JOIN kept USING (lang) GROUP BY lang),
counted AS (SELECT lang, source, term, count(*) AS n FROM words GROUP BY ALL),
groups AS (SELECT DISTINCT lang, source FROM listed),
cells AS (
  SELECT lang, source, term, lang_n, coalesce(n, 0) AS n
  FROM groups JOIN kept USING (lang) LEFT JOIN counted USING (lang, source, term)),
totals AS (
  SELECT lang, source, n_terms, lang_total, coalesce(sum(n), 0) AS total
  FROM groups JOIN langs USING (lang) LEFT JOIN cells USING (lang, source) GROUP BY ALL),
priced AS (
  SELECT lang, source, term, n, {price("n", "total")} AS p, {price("lang_n", "lang_total")} AS q
  FROM cells JOIN totals USING (lang, source)),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM priced a JOIN priced b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY ALL),
every_pair AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND item = b.source),
terms AS (
  SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // q AS value
  FROM priced WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM (SELECT * FROM every_pair UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, value::BIGINT AS value, rank::INT AS rank
FROM ranked WHERE part = 'pair' OR rank <= {top}"""
