"""DuckDB SQL for the corpus queries that SQL can express."""

from __future__ import annotations

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

ORACLES: dict[str, str] = {}

ORACLES["op9_exact_dedup"] = f"""
WITH t AS (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}') AS x FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, CAST(count(*) OVER w AS BIGINT) AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(x) AS text_sha256
FROM t WINDOW w AS (PARTITION BY x)
"""

ORACLES["op2_source_mix"] = r"""
WITH counted AS (
  SELECT doc_id, coalesce(lang, '') AS language, coalesce(source, '') AS leaf,
         regexp_extract(coalesce(source, ''), '([0-9]{1,9})$', 1) AS number,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS n_tokens
  FROM documents),
t AS (
  SELECT doc_id, language, leaf, n_tokens,
         CASE WHEN number = '' THEN 'other' WHEN CAST(number AS INT) % 3 = 0 THEN 'web'
              WHEN CAST(number AS INT) % 3 = 1 THEN 'books' ELSE 'forums' END AS domain
  FROM counted WHERE n_tokens > 0),
leaves AS (
  SELECT domain, language, leaf, CAST(sum(n_tokens) AS BIGINT) AS tokens, CAST(sum(n_tokens) * 2 AS BIGINT) AS cap,
         CASE leaf WHEN 'src0' THEN 4 ELSE 1 END AS w FROM t GROUP BY ALL),
languages AS (
  SELECT domain, language, CAST(sum(cap) AS BIGINT) AS cap,
         CASE language WHEN 'en' THEN 6 WHEN 'de' THEN 2 ELSE 1 END AS w FROM leaves GROUP BY ALL),
domains AS (
  SELECT domain, CAST(sum(cap) AS BIGINT) AS cap,
         CASE domain WHEN 'web' THEN 5 WHEN 'books' THEN 3 WHEN 'forums' THEN 2 ELSE 1 END AS w,
         (SELECT CAST(sum(tokens) AS BIGINT) * 60 // 100 FROM leaves) AS b
  FROM languages GROUP BY domain),
d1 AS (SELECT *, sum(cap) OVER o AS cc, sum(w) OVER o AS cw, sum(w) OVER () AS tw FROM domains WINDOW o AS (ORDER BY cap / w)),
d2 AS (SELECT *, cc * w + cap * (tw - cw) <= b * w AS f FROM d1),
d3 AS (SELECT *, coalesce(sum(cap) FILTER (f) OVER (), 0) AS fc, coalesce(sum(w) FILTER (f) OVER (), 0) AS fw FROM d2),
d4 AS (SELECT domain, CASE WHEN f THEN cap ELSE (b - fc) * w // (tw - fw) END AS b FROM d3),
l1 AS (SELECT l.*, d4.b, sum(cap) OVER o AS cc, sum(w) OVER o AS cw, sum(w) OVER (PARTITION BY l.domain) AS tw
       FROM languages l JOIN d4 USING (domain) WINDOW o AS (PARTITION BY l.domain ORDER BY cap / w)),
l2 AS (SELECT *, cc * w + cap * (tw - cw) <= b * w AS f FROM l1),
l3 AS (SELECT *, coalesce(sum(cap) FILTER (f) OVER (PARTITION BY domain), 0) AS fc,
              coalesce(sum(w) FILTER (f) OVER (PARTITION BY domain), 0) AS fw FROM l2),
l4 AS (SELECT domain, language, CASE WHEN f THEN cap ELSE (b - fc) * w // (tw - fw) END AS b FROM l3),
s1 AS (SELECT s.*, l4.b, sum(cap) OVER o AS cc, sum(w) OVER o AS cw,
              sum(w) OVER (PARTITION BY s.domain, s.language) AS tw
       FROM leaves s JOIN l4 USING (domain, language) WINDOW o AS (PARTITION BY s.domain, s.language ORDER BY cap / w)),
s2 AS (SELECT *, cc * w + cap * (tw - cw) <= b * w AS f FROM s1),
s3 AS (SELECT *, coalesce(sum(cap) FILTER (f) OVER (PARTITION BY domain, language), 0) AS fc,
              coalesce(sum(w) FILTER (f) OVER (PARTITION BY domain, language), 0) AS fw FROM s2),
s4 AS (SELECT domain, language, leaf, tokens,
              CAST(CASE WHEN f THEN cap ELSE (b - fc) * w // (tw - fw) END AS BIGINT) AS given FROM s3),
p AS (
  SELECT t.*, given AS leaf_target, given // tokens AS whole, given % tokens AS rest,
         sum(n_tokens) OVER (PARTITION BY domain, language, leaf
           ORDER BY md5(concat('42:', CAST(given // tokens AS VARCHAR), ':', CAST(doc_id AS VARCHAR))), doc_id, n_tokens
           ROWS UNBOUNDED PRECEDING) AS upto
  FROM t JOIN s4 USING (domain, language, leaf))
SELECT doc_id, domain, language, leaf, n_tokens, leaf_target,
       CAST(unnest(range(CAST(whole AS BIGINT) + CASE WHEN upto <= rest THEN 1 ELSE 0 END)) AS INTEGER) AS epoch
FROM p
"""

ORACLES["op6_quality_rules"] = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS x, coalesce(source, '') AS host,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         [l for l in string_split(coalesce(text, ''), chr(10)) if regexp_matches(l, '[^\x20\x09-\x0D]')] AS lines
  FROM documents),
w AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i, len(words) AS n FROM t),
g AS (SELECT doc_id, i, n, list(word) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING) AS gram FROM w),
d AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS found FROM g WHERE i <= n - 4),
c AS (SELECT doc_id, count(DISTINCT i + k) AS covered FROM d, range(5) r(k) WHERE found > 1 GROUP BY doc_id),
m AS (
  SELECT t.doc_id, host, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(x, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(x) - length(regexp_replace(x, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(covered, 0) AS BIGINT) AS n_repeat_words
  FROM t LEFT JOIN c USING (doc_id)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m),
h AS (SELECT host, count(*) AS n, sum(CASE WHEN base_failed THEN 1 ELSE 0 END) AS fails FROM b GROUP BY host),
a AS (SELECT avg(fails / n) AS mean, var_pop(fails / n) AS var FROM h),
k AS (SELECT mean, CASE WHEN var > 0 THEN least(greatest(mean * (1 - mean) / var - 1, 1.0), 1000.0) ELSE 1000.0 END AS weight FROM a),
r AS (SELECT host, (fails + mean * weight) / (n + weight) AS rate FROM h, k)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND rate <= 0.5 AS kept
FROM b JOIN r USING (host)
"""

#: The table of CRC-32 from its polynomial, and the checksum of a text of ASCII characters.
CRC_TABLE = """crc_table AS (
  SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c % 2 = 1
    THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS crc_values FROM range(256) r(i))"""


def crc32(text: str) -> str:
    steps = f"list_prepend(CAST(4294967295 AS BIGINT), [CAST(ord(x) AS BIGINT) FOR x IN string_split({text}, '')])"
    fold = "lambda c, b: xor(c >> 8, crc_values[CAST(xor(c, b) & 255 AS INT) + 1])"
    return f"xor(list_reduce({steps}, {fold}), 4294967295)"


def _merkle_tree(name: str, tree: str, levels: int) -> str:
    """Nodes per level (``<name>0`` given: ``tree, i, h``), then for each leaf its step of every level."""
    parts = []
    for k in range(levels):
        parts.append(f"""{name}{k}s AS (
  SELECT {tree}, i, h, count(*) OVER (PARTITION BY {tree}) AS n, i // 8 AS up,
         list(h) OVER (PARTITION BY {tree}, i // 8 ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS run
  FROM {name}{k}),
{name}{k + 1} AS (
  SELECT {tree}, up AS i, CASE WHEN any_value(n) > 1 THEN sha256(array_to_string(any_value(run), '')) ELSE any_value(h) END AS h
  FROM {name}{k}s GROUP BY {tree}, up)""")
    joins = "\n".join(f"  JOIN {name}{k}s s{k} ON s{k}.{tree} = l.{tree} AND s{k}.i = l.i // {8**k}" for k in range(levels))
    steps = ", ".join(
        f"""CASE WHEN s{k}.n > 1 THEN {{'a': array_to_string(s{k}.run[1 : s{k}.i % 8], ''),
      'b': array_to_string(s{k}.run[s{k}.i % 8 + 2 :], '')}} END"""
        for k in range(levels)
    )
    parts.append(f"""{name}path AS (
  SELECT l.{tree}, l.i, list_filter([{steps}], lambda x: x IS NOT NULL) AS path FROM {name}0 l
{joins})""")
    return ",\n".join(parts)


def _field(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"


def _leaf(text: str) -> str:
    return f"sha256({' || '.join(map(_field, ('doc_id', 'source', 'lang', 'n_chars', text)))})"


ORACLES["op11_merkle_manifest"] = f"""
WITH {CRC_TABLE},
leaves AS (
  SELECT doc_id, CASE WHEN lang IS NULL THEN '' ELSE 'x' || lang END AS tree, {_leaf('text')} AS leaf,
         CASE WHEN {crc32("coalesce(CAST(doc_id AS VARCHAR), '')")} % 3 = 0
              THEN {_leaf(f"translate(text, '{UPPER}', '{UPPER.lower()}')")} END AS altered
  FROM documents, crc_table),
ranked AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM leaves),
t0 AS (SELECT tree, i, leaf AS h FROM ranked),
{_merkle_tree("t", "tree", 7)},
r0 AS (SELECT '' AS al, tree AS name, h, row_number() OVER (ORDER BY tree) - 1 AS i FROM t7),
{_merkle_tree("r", "al", 3)},
whole AS (
  SELECT doc_id, leaf, altered, r0.h AS subroot, r3.h AS root, list_concat(tpath.path, rpath.path) AS path
  FROM ranked JOIN tpath USING (tree, i) JOIN r0 ON r0.name = ranked.tree JOIN rpath ON rpath.i = r0.i CROSS JOIN r3),
told AS (
  SELECT *, sha256(array_to_string([p.a || p.b FOR p IN path], '')) AS proof_sha256,
         list_reduce(list_prepend({{'a': coalesce(altered, leaf), 'b': ''}}, path),
           lambda x, p: {{'a': sha256(p.a || x.a || p.b), 'b': ''}}).a AS folded_root
  FROM whole)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM told
"""

ORACLES["op13_prefix_trie"] = f"""
WITH {CRC_TABLE},
own AS (
  SELECT conv_id, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}} ORDER BY turn NULLS FIRST) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
drawn AS (SELECT conv_id, turns, CAST({crc32('CAST(conv_id AS VARCHAR)')} % 6 AS INT) AS h FROM own, crc_table),
rebuilt AS (
  SELECT a.conv_id, list_concat(coalesce(b.turns[1:h], []), a.turns[h + 1 :]) AS turns
  FROM drawn a LEFT JOIN own b ON b.conv_id = a.conv_id - a.conv_id % 100),
prefixes AS (
  SELECT conv_id, d, turns[1:d] AS seq, len(turns) = d AS ended
  FROM (SELECT *, unnest(range(len(turns) + 1)) AS d FROM rebuilt)),
nodes AS (
  SELECT seq, CAST(d AS BIGINT) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ended), '')) AS ends_sha256
  FROM prefixes GROUP BY seq, d),
children AS (SELECT seq[1 : depth - 1] AS seq, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL),
counted AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN children USING (seq)),
below AS (
  SELECT seq[1:k] AS seq, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves,
         sum(CASE WHEN depth > 0 THEN (n_convs - 1) * length(seq[depth].t) ELSE 0 END) AS saved_tokens
  FROM (SELECT *, unnest(range(depth + 1)) AS k FROM counted) GROUP BY 1)
SELECT c.conv_id, c.depth, p.conv_id AS parent_conv_id, c.n_convs, c.n_children,
       CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, c.ends_sha256
FROM counted c JOIN below b ON b.seq = c.seq
LEFT JOIN counted p ON c.depth > 0 AND p.seq = c.seq[1 : c.depth - 1]
"""


def _level(k: int) -> str:
    """One level of the template tree: ``t<k-1>(host, shape, n, m, g, prefix)`` to ``t<k>``."""
    gap = "(acc.g * x.m - x.g * acc.m)::DOUBLE"
    all_m, all_g = "(acc.m + x.m)::DOUBLE", "(acc.g + x.g)::DOUBLE"
    same = f"{gap} * {gap} * {all_m} <= acc.m::DOUBLE * x.m::DOUBLE * {all_g} * ({all_m} - {all_g}) * 3.84::DOUBLE"
    step = f"""CASE WHEN {same}
      THEN {{'m': acc.m + x.m, 'g': acc.g + x.g, 'c': acc.c, 'told': list_append(acc.told, {{'token': x.token, 'c': acc.c}})}}
      ELSE {{'m': x.m, 'g': x.g, 'c': acc.c + 1, 'told': list_append(acc.told, {{'token': x.token, 'c': acc.c + 1}})}} END"""
    item = "STRUCT(rate DOUBLE, token VARCHAR, m BIGINT, g BIGINT, c BIGINT, told STRUCT(token VARCHAR, c BIGINT)[])"
    return f"""c{k} AS (
  SELECT host, prefix, string_split(shape, '/')[{k + 1}] AS seg, sum(n) AS n, sum(m) AS m, sum(g) AS g
  FROM t{k - 1} WHERE len(string_split(shape, '/')) > {k} GROUP BY ALL),
w{k} AS (
  SELECT *, CASE WHEN count(*) OVER o > 1 AND (n < 2 OR n * 32 < sum(n) OVER o) THEN '*' ELSE seg END AS token,
         sum(m) OVER o AS all_m, sum(g) OVER o AS all_g
  FROM c{k} WINDOW o AS (PARTITION BY host, prefix)),
f{k} AS (
  SELECT host, prefix, token, CAST(sum(m) AS BIGINT) AS m, CAST(sum(g) AS BIGINT) AS g,
         (sum(g) + CASE WHEN all_m > 0 THEN all_g::DOUBLE / all_m::DOUBLE ELSE 0.5::DOUBLE END * 5.0::DOUBLE)
           / (sum(m) + 5.0::DOUBLE) AS rate
  FROM w{k} GROUP BY host, prefix, token, all_m, all_g),
b{k} AS (
  SELECT host, prefix, list(CAST({{'rate': rate, 'token': token, 'm': m, 'g': g, 'c': 0,
           'told': []}} AS {item}) ORDER BY rate, token, m, g) AS branches FROM f{k} GROUP BY host, prefix),
m{k} AS (
  SELECT host, prefix, list_reduce(branches, lambda acc, x: CAST({step.replace("{'m'", "{'rate': 0, 'token': '', 'm'")} AS {item}),
           CAST({{'rate': 0, 'token': '', 'm': 0, 'g': 0, 'c': 0, 'told': []}} AS {item})).told AS told FROM b{k}),
u{k} AS (SELECT host, prefix, told, unnest(told) AS x FROM m{k}),
n{k} AS (
  SELECT host, prefix, x.token AS token, CASE WHEN len(told) > 1 AND told[-1].c = 0 THEN '*'
         ELSE array_to_string(list_sort([y.token FOR y IN told IF y.c = x.c]), '|') END AS name FROM u{k}),
t{k} AS (
  SELECT t.host, t.shape, t.n, t.m, t.g, CASE WHEN s.name IS NULL THEN t.prefix ELSE t.prefix || '/' || s.name END AS prefix
  FROM t{k - 1} t LEFT JOIN (SELECT w.host, w.prefix, w.seg, n.name FROM w{k} w JOIN n{k} n USING (host, prefix, token)) s
    ON s.host = t.host AND s.prefix = t.prefix AND s.seg = string_split(t.shape, '/')[{k + 1}])"""


ORACLES["op12_url_filters"] = rf"""
WITH cut AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)\A.*?://([^/?#]*)', 1), '{UPPER}', '{UPPER.lower()}') AS host,
         regexp_extract(coalesce(url, ''), '(?s)\A.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
formed AS (
  SELECT *, [CASE WHEN regexp_matches(s, '\A[0-9A-Fa-f-]{{16,}}\z') THEN '{{id}}' ELSE regexp_replace(s, '[0-9]+', '{{n}}', 'g') END
             FOR s IN string_split(path, '/')] AS parts FROM cut),
p AS (
  SELECT page_id, host, path, array_to_string(CASE WHEN len(parts) > 9 THEN list_append(parts[1:9], '**') ELSE parts END, '/') AS shape
  FROM formed),
known AS (SELECT doc_id, min(quality) AS good FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
t0 AS (
  SELECT host, shape, count(*) AS n, count(good) AS m, coalesce(sum(good), 0) AS g, '' AS prefix
  FROM p LEFT JOIN known ON known.doc_id = p.page_id GROUP BY host, shape),
{", ".join(_level(k) for k in range(1, 10))},
found AS (SELECT host, prefix, sum(m) AS m, sum(g) AS g FROM t9 GROUP BY host, prefix),
hosts AS (
  SELECT host, (sum(g) + (SELECT CASE WHEN sum(m) > 0 THEN sum(g)::DOUBLE / sum(m)::DOUBLE ELSE 0.5::DOUBLE END FROM found) * 5.0::DOUBLE)
           / (sum(m) + 5.0::DOUBLE) AS rate FROM found GROUP BY host),
judged AS (
  SELECT host, prefix, CASE WHEN (g + rate * 5.0::DOUBLE) / (m + 5.0::DOUBLE) >= 0.7::DOUBLE THEN 'allow' ELSE 'block' END AS learned
  FROM found JOIN hosts USING (host)),
ruled AS (
  SELECT p.*, t9.prefix AS template, learned,
         CASE WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
              WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
              WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
              WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM p JOIN t9 USING (host, shape) JOIN judged USING (host, prefix))
SELECT page_id, host, path, rule, template, CASE rule WHEN 'net/' THEN 'block' WHEN 'example.com/de/' THEN 'block'
         WHEN 'example.net/en/' THEN 'allow' WHEN 'org/fr/' THEN 'allow' ELSE learned END AS verdict
FROM ruled
"""
