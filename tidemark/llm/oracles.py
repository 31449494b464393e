"""DuckDB SQL for the corpus queries that SQL can express, over whole tables."""

from __future__ import annotations

import math
from collections import Counter

from tidemark.llm import jaccard_join, licences, mixing, near_vectors, secret_ledger

# Smallest node that each node reaches, by a recursive walk over links(a, b) in both directions.
_REACHED = """
both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
walk AS (
    SELECT DISTINCT a AS node, a AS reached FROM both_ways
    UNION
    SELECT w.node, e.b FROM walk w JOIN both_ways e ON w.reached = e.a
),
least AS (SELECT node, min(reached) AS component FROM walk GROUP BY node)"""

_WORDS = r"string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+')"


def jaccard() -> str:
    numerator, denominator = jaccard_join.LEAST
    lower = f"translate(coalesce(text, ''), '{'ABCDEFGHIJKLMNOPQRSTUVWXYZ'}', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH RECURSIVE words AS (
    SELECT doc_id, list_filter(string_split_regex({lower}, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w FROM documents
),
sets AS (
    SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')) END) AS s
    FROM words
),
items AS (SELECT doc_id, unnest(s) AS item FROM sets),
common AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS inter
    FROM items x JOIN items y ON x.item = y.item AND x.doc_id < y.doc_id GROUP BY 1, 2
),
links AS (
    SELECT a, b FROM common JOIN sets p ON p.doc_id = a JOIN sets q ON q.doc_id = b
    WHERE {denominator} * inter >= {numerator} * (len(p.s) + len(q.s) - inter)
),{_REACHED}
SELECT s.doc_id, len(s.s) AS n_shingles, coalesce(l.component, s.doc_id) AS component_id
FROM sets s LEFT JOIN least l ON l.node = s.doc_id"""


def near() -> str:
    return f"""
WITH RECURSIVE vectors AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links AS (
    SELECT p.vec_id AS a, q.vec_id AS b FROM vectors p JOIN vectors q ON p.vec_id < q.vec_id
    WHERE list_cosine_similarity(p.v, q.v) >= {near_vectors.THRESHOLD}
),{_REACHED},
degrees AS (SELECT a AS node, count(*) AS n FROM both_ways GROUP BY 1)
SELECT e.vec_id, coalesce(d.n, 0) AS n_links, coalesce(l.component, e.vec_id) AS component_id,
       coalesce(l.component, e.vec_id) = e.vec_id AS kept
FROM embeddings e LEFT JOIN degrees d ON d.node = e.vec_id LEFT JOIN least l ON l.node = e.vec_id"""


def mixture() -> str:
    """Raking with its rounds written out."""
    t = mixing.TEMPERATURES
    steps = []
    for k in range(1, mixing.ROUNDS + 1):
        steps.append(f"""
a{k} AS MATERIALIZED (
    SELECT c.source, any_value(s.want) / sum(c.m * l.f * t.f) AS f FROM shares c JOIN sources s USING (source)
    JOIN l{k - 1} l USING (lang) JOIN t{k - 1} t USING (topic) GROUP BY c.source
),
l{k} AS MATERIALIZED (
    SELECT c.lang, any_value(w.want) / sum(a.f * c.m * t.f) AS f FROM shares c JOIN a{k} a USING (source)
    JOIN t{k - 1} t USING (topic) JOIN langs w USING (lang) GROUP BY c.lang
),
t{k} AS MATERIALIZED (
    SELECT c.topic, any_value(w.want) / sum(a.f * c.m * l.f) AS f FROM shares c JOIN a{k} a USING (source)
    JOIN l{k} l USING (lang) JOIN topics w USING (topic) GROUP BY c.topic
)""")
    last = mixing.ROUNDS
    margin = lambda table, column: f"""
{table} AS MATERIALIZED (
    SELECT {column}, pow(sum(m), {t[column]}) / sum(pow(sum(m), {t[column]})) OVER () AS want FROM shares GROUP BY {column}
)"""  # noqa: E731
    return f"""
WITH words AS (
    SELECT doc_id, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           CAST(len(list_filter({_WORDS}, lambda w: w <> '')) AS BIGINT) AS tokens FROM documents
),
rows AS MATERIALIZED (
    SELECT *, CASE WHEN contains(text, '|') THEN 'table' WHEN contains(text, '!!') THEN 'shout'
        WHEN regexp_matches(text, '[#$%&*]{{3}}') THEN 'noise' WHEN tokens < 100 THEN 'note'
        WHEN tokens < 1000 THEN 'article' ELSE 'book' END AS topic FROM words
),
shares AS MATERIALIZED (
    SELECT source, lang, topic, sum(tokens) / (SELECT CAST(sum(tokens) AS DOUBLE) FROM rows) AS m FROM rows
    GROUP BY 1, 2, 3 HAVING sum(tokens) > 0
),{margin("sources", "source")},{margin("langs", "lang")},{margin("topics", "topic")},
l0 AS (SELECT lang, 1.0::DOUBLE AS f FROM langs), t0 AS (SELECT topic, 1.0::DOUBLE AS f FROM topics),
{",".join(steps)},
again AS (
    SELECT c.source, any_value(s.want) / sum(c.m * l.f * t.f) AS f FROM shares c JOIN sources s USING (source)
    JOIN l{last} l USING (lang) JOIN t{last} t USING (topic) GROUP BY c.source
),
ratios AS (
    SELECT c.source, c.lang, c.topic, a.f * l.f * t.f AS ratio FROM shares c JOIN again a USING (source)
    JOIN l{last} l USING (lang) JOIN t{last} t USING (topic)
),
given AS (
    SELECT doc_id, tokens, topic, round(least(1.0, coalesce(ratio, 0) * budget), 6) AS probability,
           CAST(('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || ':{mixing.SEED}'), 1, 13)) AS BIGINT)
               / pow(2, 52) AS u
    FROM rows LEFT JOIN ratios USING (source, lang, topic), (SELECT least({mixing.BUDGET}, 1 / max(ratio)) AS budget FROM ratios)
)
SELECT doc_id, tokens, topic, probability, u < probability AS selected FROM given"""


def licence_scan() -> str:
    templates = []
    for name, text in licences.TEMPLATES:
        for word, n in sorted(Counter(licences.words_of(text)).items()):
            templates.append(f"('{name}', '{word}', {n})")
    cues = ", ".join(f"'{w}'" for w in licences.CUES)
    space = licences.SPACE
    assert math.isclose(licences.THRESHOLD, 0.75)
    return f"""
WITH notices(licence, word, n) AS (VALUES {", ".join(templates)}),
plain AS (
    SELECT page_id, regexp_replace(regexp_replace(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://', ''), '[?#].*$', '') AS path,
           lower(regexp_replace(regexp_replace(coalesce(html, ''),
               '(?is)<(script|style)\\b.*?</(script|style)>', chr(10), 'g'), '<[^>]*>', chr(10), 'g')) AS text
    FROM pages
),
lines AS (
    SELECT page_id, unnest(list_filter(string_split_regex(
        regexp_replace(text, '([.!?]){space}', '\\1' || chr(10), 'g'), chr(10) || '+'), lambda p: p <> '')) AS passage FROM plain
),
passages AS (
    SELECT page_id, row_number() OVER () AS line_id, words FROM (
        SELECT page_id, regexp_extract_all(passage, '[a-z0-9]+') AS words FROM lines) WHERE len(words) > 0
),
frequencies AS (
    SELECT word, count(*) AS n FROM (SELECT line_id, unnest(list_distinct(words)) AS word FROM passages)
    WHERE word IN (SELECT word FROM notices) GROUP BY word
),
weights AS (
    SELECT DISTINCT t.word, ln((1 + (SELECT count(*) FROM passages)) / (1.0 + coalesce(f.n, 0))) + 1 AS idf
    FROM notices t LEFT JOIN frequencies f USING (word)
),
counted AS (
    SELECT page_id, line_id, word, count(*) AS n FROM (
        SELECT page_id, line_id, unnest(words) AS word FROM passages WHERE list_has_any(words, [{cues}])) GROUP BY ALL
),
weighed AS (
    SELECT page_id, line_id, word,
           c.n * coalesce(idf, ln((1 + (SELECT count(*) FROM passages)) / 2.0) + 1) AS v
    FROM counted c LEFT JOIN weights USING (word)
),
norms AS (SELECT line_id, sqrt(sum(v * v)) AS norm FROM weighed GROUP BY line_id),
notice_norms AS (SELECT licence, sqrt(sum(pow(n * idf, 2))) AS norm FROM notices JOIN weights USING (word) GROUP BY licence),
cosines AS (
    SELECT w.page_id, w.line_id, t.licence, round(sum(w.v * t.n * i.idf) / any_value(p.norm) / any_value(q.norm), 6) AS score
    FROM weighed w JOIN notices t USING (word) JOIN weights i USING (word) JOIN norms p ON p.line_id = w.line_id
    JOIN notice_norms q ON q.licence = t.licence GROUP BY w.page_id, w.line_id, t.licence
),
best AS (
    SELECT page_id, licence AS own_licence, score AS own_score FROM (
        SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY score DESC, licence) AS r FROM cosines WHERE score >= 0.75)
    WHERE r = 1
),
own AS (SELECT DISTINCT page_id, path, own_licence, own_score FROM plain LEFT JOIN best USING (page_id)),
parts AS (
    SELECT *, string_split(path, '/') AS p FROM own
),
speakers AS (
    SELECT array_to_string(p[1:len(p) - 1], '/') AS directory, own_licence, own_score FROM parts
    WHERE own_licence IS NOT NULL AND len(p) > 1
      AND (p[len(p)] = '' OR regexp_matches(lower(p[len(p)]), '^(licen[sc]e|copying|notice|legal|index|readme)([.-].*)?$'))
),
licensed AS (
    SELECT directory, own_licence AS licence FROM (
        SELECT *, row_number() OVER (PARTITION BY directory ORDER BY own_score DESC, own_licence) AS r FROM speakers) WHERE r = 1
),
above AS (
    SELECT page_id, unnest(list_transform(range(1, len(p)), lambda n: array_to_string(p[1:n], '/'))) AS directory
    FROM parts WHERE own_licence IS NULL
),
nearest AS (
    SELECT page_id, directory, licence FROM (
        SELECT page_id, directory, licence, row_number() OVER (PARTITION BY page_id ORDER BY length(directory) DESC) AS r
        FROM above JOIN licensed USING (directory)) WHERE r = 1
)
SELECT o.page_id, o.own_licence, o.own_score, coalesce(o.own_licence, n.licence) AS licence,
       CASE WHEN o.own_licence IS NOT NULL THEN 'own' WHEN n.page_id IS NOT NULL THEN 'inherited' ELSE 'none' END AS origin,
       n.directory
FROM own o LEFT JOIN nearest n USING (page_id)"""


def fill_in_middle() -> str:
    return """
WITH drawn AS (
    SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\\n]*\\n|[^\\n]+') AS lines,
           sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS h
    FROM documents
),
draws AS (
    SELECT *, CAST(len(lines) AS BIGINT) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
           CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM drawn
),
cuts AS (
    SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
           CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 100
                THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM draws
),
pieces AS (
    SELECT *, array_to_string(lines[1:a], '') AS prefix, array_to_string(lines[a + 1:b], '') AS middle,
           array_to_string(lines[b + 1:], '') AS suffix FROM cuts
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM pieces"""


def _either_case(pattern: str) -> str:
    """Letters of the keywords in either case, without the non-ASCII letters that case folding would add."""
    return "".join(f"[{c}{c.upper()}]" if c.islower() else c for c in pattern)


def secrets() -> str:
    words = _either_case("password|passwd|secret|token|api_") + "?" + _either_case("key")
    base = {
        "assign": (rf"""({words})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
        "access": ("AKIA[A-Z0-9]+", 0, 20),
        "hex": ("[0-9a-f]+", 0, 24),
    }
    kinds = base | {r.kind: (r.pattern, r.group, r.least) for r in secret_ledger.ADDED}
    quoted = {kind: p.replace("'", "''") for kind, (p, _, _) in kinds.items()}
    found = " UNION ALL ".join(
        f"SELECT row, {order} AS o, '{kind}' AS kind, {least} AS least, string_split_regex(text, '{quoted[kind]}') AS pieces, "
        f"regexp_extract_all(text, '{quoted[kind]}') AS whole, regexp_extract_all(text, '{quoted[kind]}', {group}) AS part FROM texts"
        for order, (kind, (_, group, least)) in enumerate(kinds.items())
    )
    base_kinds = ", ".join(f"'{k}'" for k in base)
    counts = ", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in base)
    return f"""
WITH texts AS MATERIALIZED (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS row FROM documents),
found AS ({found}),
matches AS (
    SELECT row, o, kind, least, unnest(pieces) AS piece, unnest(list_append(whole, '')) AS whole,
           unnest(list_append(part, '')) AS part, generate_subscripts(pieces, 1) AS i FROM found WHERE len(whole) > 0
),
placed AS (
    SELECT *, sum(length(piece) + length(whole)) OVER (PARTITION BY row, o ORDER BY i) AS e FROM matches
),
spans AS (
    SELECT row, o, kind, e - length(whole) AS a, kind || ':' || CAST(e - length(whole) AS BIGINT) || ':' || CAST(e AS BIGINT) AS span
    FROM placed WHERE whole <> '' AND length(part) >= least
),
per_row AS (
    SELECT row, string_agg(span, ',' ORDER BY a, o) AS spans,
           string_agg(span, ',' ORDER BY a, o) FILTER (kind IN ({base_kinds})) AS base,
           {", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in base)} FROM spans GROUP BY row
)
SELECT doc_id, {counts}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN per_row USING (row)"""


#: Levels of sixteen that the manifest's SQL writes out, in a source and over the sources.
_LEVELS = 6


def manifest() -> str:
    def field(column: str) -> str:
        return f"coalesce(CAST(strlen(CAST({column} AS VARCHAR)) AS VARCHAR) || ':' || CAST({column} AS VARCHAR), '-')"

    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    crc = (
        "xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), "
        "lambda c: CAST(unicode(c) AS BIGINT))), lambda crc, b: list_reduce(list_prepend(xor(crc, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), "
        "lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))))"
    )

    def tree(name: str, start: str) -> str:
        """Levels of one tree a ``g``: nodes by idx, and the runs of siblings below each parent."""
        out = [f"{name}0 AS MATERIALIZED ({start})"]
        for k in range(_LEVELS):
            out.append(f"""
{name}_runs{k} AS MATERIALIZED (
    SELECT g, idx // 16 AS parent, list(digest ORDER BY idx) AS digests, any_value(cnt) AS cnt FROM {name}{k} GROUP BY ALL
),
{name}{k + 1} AS MATERIALIZED (
    SELECT g, parent AS idx, CASE WHEN cnt = 1 THEN digests[1] ELSE sha256(array_to_string(digests, '')) END AS digest,
           (cnt + 15) // 16 AS cnt FROM {name}_runs{k}
)""")
        return ",".join(out)

    def climb(name: str, rows: str, at: str) -> tuple[str, str, str]:
        """Joins to the runs along a row's path, the proof they make, and the steps that fold a digest."""
        joins, proof, steps = [], [], []
        for k in range(_LEVELS):
            run = f"{name}_r{k}"
            joins.append(f"JOIN {name}_runs{k} {run} ON {run}.g = {rows} AND {run}.parent = {at} // {16 ** (k + 1)}")
            j = f"({at} // {16**k}) % 16"
            left, right = f"array_to_string({run}.digests[1:{j}], '')", f"array_to_string({run}.digests[{j} + 2:], '')"
            proof.append(f"CASE WHEN {run}.cnt > 1 THEN {left} || {right} ELSE '' END")
            steps.append((f"{run}.cnt > 1", left, right))
        return "\n    ".join(joins), " || ".join(proof), steps

    own_joins, own_proof, own_steps = climb("n", "l.g", "l.idx")
    top_joins, top_proof, top_steps = climb("s", "0", "(l.g - 1)")
    folds, previous = [], "candidate"
    columns = []
    for i, (there, left, right) in enumerate([*own_steps, *top_steps]):
        columns.append(f"{there} AS there{i}, {left} AS left{i}, {right} AS right{i}")
        folds.append(f"f{i} AS (SELECT *, CASE WHEN there{i} THEN sha256(left{i} || {previous} || right{i}) ELSE {previous} END AS fold{i} FROM {'climbed' if i == 0 else f'f{i - 1}'})")
        previous = f"fold{i}"
    texts = [field(c) for c in ("doc_id", "source", "lang", "n_chars")]
    changed = f"CASE WHEN {crc} % 5 = 0 THEN translate(text, '{upper}', '{lower}') ELSE text END"
    return f"""
WITH leaves AS MATERIALIZED (
    SELECT doc_id, source, sha256({" || ".join([*texts, field("text")])}) AS leaf,
           sha256({" || ".join([*texts, field(f"({changed})")])}) AS candidate FROM documents
),
ordered AS MATERIALIZED (
    SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) AS g,
           row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx FROM leaves
),{tree("n", "SELECT g, idx, leaf AS digest, count(*) OVER (PARTITION BY g) AS cnt FROM ordered")},
{tree("s", f"SELECT 0 AS g, g - 1 AS idx, digest, count(*) OVER () AS cnt FROM n{_LEVELS}")},
climbed AS (
    SELECT l.doc_id, l.leaf, l.candidate, o.digest AS subroot, r.digest AS root, sha256({own_proof} || {top_proof}) AS proof_sha256,
           {", ".join(columns)}
    FROM ordered l JOIN n{_LEVELS} o ON o.g = l.g CROSS JOIN s{_LEVELS} r
    {own_joins}
    {top_joins}
),{",".join(folds)}
SELECT doc_id, leaf, subroot, root, proof_sha256, {previous} AS folded_root, {previous} = root AS verified FROM f{len(folds) - 1}"""


def build() -> dict[str, str]:
    return {
        "op2_mixing": mixture(),
        "op4_licence_scan": licence_scan(),
        "op8_near_vectors": near(),
        "op9_jaccard_join": jaccard(),
        "op11_fill_in_middle": fill_in_middle(),
        "op12_secret_ledger": secrets(),
        "op13_merkle_manifest": manifest(),
    }
