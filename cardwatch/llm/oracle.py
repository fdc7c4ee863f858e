"""DuckDB SQL of the corpus queries that SQL can express on whole tables."""

from __future__ import annotations

from . import linkgraph, quality

#: Every window of up to four words of a piece, by language, counted; then the cuts of each.
PHRASES = r"""WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
worded AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
spots AS (
  SELECT lang, w, unnest(generate_series(1, len(w))) AS i FROM worded WHERE len(w) > 0),
grams AS (
  SELECT lang, w[i:i + k - 1] AS g, count(*) AS f
  FROM spots, (VALUES (1), (2), (3), (4)) AS sizes(k)
  WHERE i + k - 1 <= len(w)
  GROUP BY lang, w[i:i + k - 1]),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM grams WHERE len(g) = 1 GROUP BY lang),
frequent AS (SELECT * FROM grams WHERE f >= 30),
cuts AS (
  SELECT c.lang, c.g, c.f AS a, k, x.f AS l, y.f AS r,
         (2000000::HUGEINT * c.f) // (x.f + y.f) AS score
  FROM frequent c, (VALUES (1), (2), (3)) AS splits(k), frequent x, frequent y
  WHERE k < len(c.g) AND x.lang = c.lang AND x.g = c.g[1:k]
    AND y.lang = c.lang AND y.g = c.g[k + 1:len(c.g)]),
lowest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
inside AS (
  SELECT lang, g[i:i + k - 1] AS g, max(f) AS f
  FROM frequent, (VALUES (2), (3)) AS sizes(k), (VALUES (1), (2), (3)) AS starts(i)
  WHERE k < len(g) AND i + k - 1 <= len(g)
  GROUP BY lang, g[i:i + k - 1]),
kept AS (
  SELECT o.* FROM lowest o LEFT JOIN inside s ON s.lang = o.lang AND s.g = o.g
  WHERE s.f IS NULL OR 100::HUGEINT * s.f < 80::HUGEINT * o.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC,
         array_to_string(g, ' ')) AS rank,
       array_to_string(g, ' ') AS phrase, a, l, r, n, score::BIGINT AS score
FROM kept JOIN totals USING (lang)
QUALIFY rank <= 2000"""


#: All 200-byte windows, as hexadecimal digits, grouped as whole strings; runs of those found
#: twice by gaps and islands. (Cut out of parts, since a cut costs what stands before it.)
REPEATED = """WITH texts AS (
  SELECT row_number() OVER () AS d, doc_id, hex(encode(coalesce(text, ''))) AS h,
         strlen(coalesce(text, '')) AS n
  FROM documents),
blocks AS (SELECT d, h, n, unnest(generate_series(0, n - 200, 200)) AS base FROM texts WHERE n >= 200),
parts AS (SELECT d, base, substr(h, 2 * base + 1, 798) AS p FROM blocks),
places AS (SELECT d, base, p, unnest(generate_series(1, len(p) // 2 - 199)) AS i FROM parts),
windows AS (SELECT d, base + i AS i, substr(p, 2 * i - 1, 400) AS s FROM places),
twice AS (SELECT s FROM windows GROUP BY s HAVING count(*) > 1),
starts AS (SELECT d, i FROM windows SEMI JOIN twice USING (s)),
marked AS (
  SELECT d, i, CASE WHEN i <= lag(i) OVER (PARTITION BY d ORDER BY i) + 200 THEN 0 ELSE 1 END AS new
  FROM starts),
numbered AS (SELECT d, i, sum(new) OVER (PARTITION BY d ORDER BY i) AS run FROM marked),
runs AS (SELECT d, min(i) AS first, max(i) + 199 AS last FROM numbered GROUP BY d, run),
ends AS (
  SELECT d, first, last, false AS rest FROM runs
  UNION ALL
  SELECT d, n + 1, n, true FROM texts),
gaps AS (
  SELECT d, first, last, rest,
         coalesce(lag(last) OVER (PARTITION BY d ORDER BY first, rest), 0) AS before FROM ends)
SELECT any_value(doc_id) AS doc_id, any_value(n)::BIGINT AS n_bytes,
       coalesce(sum(last - first + 1) FILTER (NOT rest), 0)::BIGINT AS n_removed,
       count(*) FILTER (NOT rest) AS n_spans,
       sha256(unhex(string_agg(substr(h, 2 * before + 1, 2 * (first - 1 - before)), ''
                               ORDER BY first, rest))) AS kept_sha256
FROM gaps JOIN texts USING (d) GROUP BY d"""


def _case(column: str) -> str:
    """Column ``rule`` or its verdict: the longest fitting rule's."""
    arms = []
    for verdict, rule in sorted(linkgraph.RULES, key=lambda r: (-len(r[1]), r[1])):
        name, slash, rest = rule.partition("/")
        value = rule if column == "rule" else verdict
        arms.append(f"WHEN (host = '{name}' OR host LIKE '%.{name}') "
                    f"AND starts_with(path, '{slash + rest}') THEN '{value}'")
    return f"CASE {' '.join(arms)} END AS {column}"


def link_graph(rounds: int = linkgraph.ROUNDS) -> str:
    """Rank as the sum of what arrives after 0, 1, 2, ... links."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    url, link = (x.replace("'", "''") for x in (linkgraph.URL, linkgraph.LINK))
    d, share = linkgraph.DAMPING, linkgraph.MAX_SHARE
    return f"""WITH RECURSIVE placed AS (
  SELECT page_id, html, coalesce(translate(regexp_extract(url, '{url}', 1), '{upper}', '{lower}'),
         '') AS host, coalesce(regexp_extract(url, '{url}', 2), '') AS path
  FROM pages),
judged AS (SELECT *, {_case("rule")}, {_case("ruled")} FROM placed),
linked AS (
  SELECT host AS src,
         translate(unnest(regexp_extract_all(html, '{link}', 1)), '{upper}', '{lower}') AS dst
  FROM placed),
edges AS (
  SELECT src, dst, count(*) AS n FROM linked WHERE src <> dst AND src <> '' GROUP BY src, dst),
both_ways AS (
  SELECT 'allow' AS graph, src, dst, n FROM edges
  UNION ALL
  SELECT 'block', dst, src, n FROM edges),
weights AS (
  SELECT graph, src, dst, n / sum(n) OVER (PARTITION BY graph, src) AS w FROM both_ways),
seeds AS (
  SELECT graph, host, avg((ruled = graph)::INT) AS mass
  FROM judged, (VALUES ('allow'), ('block')) AS sides(graph)
  WHERE ruled IS NOT NULL GROUP BY graph, host HAVING mass > 0),
steps AS (
  SELECT 0 AS step, graph, host, mass FROM seeds
  UNION ALL
  SELECT s.step + 1, s.graph, w.dst, sum(s.mass * w.w * {d})
  FROM steps s JOIN weights w ON w.graph = s.graph AND w.src = s.host
  WHERE s.step < {rounds}
  GROUP BY s.step, s.graph, w.dst),
ranks AS (
  SELECT graph, host, sum(mass * CASE WHEN step < {rounds} THEN {1 - d} ELSE 1 END) AS rank
  FROM steps GROUP BY graph, host),
blocked AS (
  SELECT host FROM ranks GROUP BY host
  HAVING coalesce(sum(rank) FILTER (graph = 'block'), 0) > {share} * sum(rank))
SELECT page_id, host, path, rule, coalesce(ruled, CASE WHEN host IN (SELECT host FROM blocked)
       THEN 'block' END, 'allow') AS verdict
FROM judged"""


def quality_rules(rounds: int = quality.ROUNDS, threshold: float = 0.5) -> str:
    """Signals by lists, then expectation-maximisation as a recursion over one row: the share
    of good documents, and by rule the shares of bad votes in both classes."""
    votes = []
    for num, den, (_, good), (_, bad) in quality.RULES.values():
        share = f"{num}::DOUBLE / nullif({den}, 0)"
        votes.append(f"CASE WHEN {share} <= {good} THEN 1 WHEN {share} >= {bad} THEN -1 ELSE 0 END")
    k, one = len(votes), quality.SMOOTHING
    places = range(1, k + 1)

    def z(v: str) -> str:
        return "ln(good / (1 - good)) + " + " + ".join(
            f"CASE {v}[{j}] WHEN -1 THEN ln(of_good[{j}] / of_bad[{j}]) "
            f"WHEN 1 THEN ln((1 - of_good[{j}]) / (1 - of_bad[{j}])) ELSE 0 END" for j in places)

    def shares(weight: str, start: float, bounds: tuple) -> str:
        return "[" + ", ".join(
            f"least({bounds[1]}, greatest({bounds[0]}, "
            f"({start * 2 * one} + coalesce(sum({weight}) FILTER (v[{j}] = -1), 0)) "
            f"/ ({2 * one} + coalesce(sum({weight}) FILTER (v[{j}] <> 0), 0))))"
            for j in places) + "]"

    g0, b0 = quality.START_BAD_VOTES
    start = quality.START_GOOD
    return rf"""WITH RECURSIVE worded AS (
  SELECT doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM documents),
numbered AS (SELECT row_number() OVER () AS d, * FROM worded),
spots AS (
  SELECT d, unnest(list_transform(generate_series(1, len(w) - 2),
                                  lambda i: {{'i': i, 'g': array_to_string(w[i:i + 2], ' ')}})) AS s
  FROM numbered),
places AS (SELECT d, list(s.i) AS found FROM spots GROUP BY d, s.g HAVING count(*) > 1),
covered AS (
  SELECT d, count(DISTINCT i + k) AS n
  FROM (SELECT d, unnest(found) AS i FROM places), (VALUES (0), (1), (2)) AS steps(k) GROUP BY d),
signals AS (
  SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
         len(ls) AS n_lines, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
         length(t) - length(replace(t, '!', '')) AS n_shouts,
         length(regexp_replace(t, '[^\p{{Lu}}]+', '', 'g')) AS n_upper,
         len(list_filter(w, lambda x: x = '|')) AS n_bars, coalesce(n, 0) AS n_repeat_words
  FROM numbered LEFT JOIN covered USING (d)),
voted AS (
  SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
         n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         [{", ".join(votes)}] AS v
  FROM signals),
patterns AS (SELECT v, count(*) AS n FROM voted GROUP BY v),
model AS (
  SELECT 0 AS round, {start}::DOUBLE AS good, {[float(g0)] * k}::DOUBLE[] AS of_good,
         {[float(b0)] * k}::DOUBLE[] AS of_bad
  UNION ALL
  SELECT round + 1, ({one} + sum(p * n)) / ({2 * one} + sum(n)),
         {shares("p * n", g0, quality.GOOD_BOUNDS)}::DOUBLE[],
         {shares("(1 - p) * n", b0, quality.BAD_BOUNDS)}::DOUBLE[]
  FROM (SELECT round, v, n, 1 / (1 + exp(-({z("v")}))) AS p FROM model, patterns
        WHERE round < {rounds})
  GROUP BY round)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars,
       n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
       n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       NOT base_failed AND round(1 / (1 + exp(-({z("v")}))), 4) >= {threshold} AS kept
FROM voted, model WHERE round = {rounds}"""


def statements() -> dict[str, str]:
    return {"op2_quality_rules": quality_rules(), "op8_suffix_dedup": REPEATED,
            "op9_link_graph": link_graph(), "op13_phrases": PHRASES}
