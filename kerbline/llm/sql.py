"""SQL of the manifest, clustering and quality queries, for another engine to check them by."""

from __future__ import annotations

from kerbline.llm import line_quality as rules

#: crc32 of an ASCII text: eight steps a byte, the byte itself taken in by the first.
_CRC32 = """xor(4294967295, list_reduce([CAST(4294967295 AS BIGINT)] || flatten([
    [CAST(ascii(c) AS BIGINT), 0, 0, 0, 0, 0, 0, 0] FOR c IN string_split({text}, '') IF c <> '']),
    lambda a, e: xor(xor(a, e) >> 1, 3988292384 * (xor(a, e) & 1))))"""


def _field(value: str) -> str:
    return f"coalesce(octet_length(encode(CAST({value} AS VARCHAR))) || ':' || CAST({value} AS VARCHAR), '-')"


def _leaf(n_chars: str) -> str:
    return f"sha256({' || '.join(_field(v) for v in ('doc_id', 'source', 'lang', n_chars, 'text'))})"


#: Every tree comes with the nodes at its level, `n`; a climber takes the sibling (if any) of where it is.
MERKLE = f"""
    WITH RECURSIVE leaves AS (
        SELECT row_number() OVER () AS id, doc_id, coalesce('=' || lang, '') AS grp, {_leaf("n_chars")} AS leaf,
               CASE WHEN {_CRC32.format(text="CAST(doc_id AS VARCHAR)")} % 7 = 0
                    THEN {_leaf("CAST(n_chars AS HUGEINT) + 1")} ELSE {_leaf("n_chars")} END AS claimed
        FROM documents
    ), placed AS MATERIALIZED (
        SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
               count(*) OVER (PARTITION BY grp) AS n
        FROM leaves
    ), tree(grp, level, n, idx, node) AS (
        SELECT grp, 0, n, idx, leaf FROM placed
        UNION ALL
        SELECT grp, level + 1, (n + 1) // 2, idx // 2, sha256(string_agg(node, '' ORDER BY idx))
        FROM tree WHERE n > 1 GROUP BY grp, level, n, idx // 2
    ), roots AS (
        SELECT grp, node, row_number() OVER (ORDER BY grp) - 1 AS idx, count(*) OVER () AS n FROM tree WHERE n = 1
    ), top(level, n, idx, node) AS (
        SELECT 0, n, idx, node FROM roots
        UNION ALL
        SELECT level + 1, (n + 1) // 2, idx // 2, sha256(string_agg(node, '' ORDER BY idx))
        FROM top WHERE n > 1 GROUP BY level, n, idx // 2
    ), climb(id, grp, level, n, idx, folded, proof) AS (
        SELECT id, grp, 0, n, idx, claimed, '' FROM placed
        UNION ALL
        SELECT c.id, c.grp, c.level + 1, (c.n + 1) // 2, c.idx // 2,
               sha256(CASE WHEN c.idx % 2 = 0 THEN c.folded || coalesce(s.node, '') ELSE s.node || c.folded END),
               c.proof || coalesce(s.node, '')
        FROM climb c LEFT JOIN tree s ON s.grp = c.grp AND s.level = c.level AND s.idx = xor(c.idx, 1)
        WHERE c.n > 1
    ), over(id, level, n, idx, folded, proof) AS (
        SELECT c.id, 0, r.n, r.idx, c.folded, c.proof FROM climb c JOIN roots r ON r.grp = c.grp WHERE c.n = 1
        UNION ALL
        SELECT c.id, c.level + 1, (c.n + 1) // 2, c.idx // 2,
               sha256(CASE WHEN c.idx % 2 = 0 THEN c.folded || coalesce(s.node, '') ELSE s.node || c.folded END),
               c.proof || coalesce(s.node, '')
        FROM over c LEFT JOIN top s ON s.level = c.level AND s.idx = xor(c.idx, 1)
        WHERE c.n > 1
    )
    SELECT p.doc_id, p.leaf, r.node AS subroot, t.node AS root, sha256(o.proof) AS proof_sha256, o.folded AS folded_root,
           o.folded = t.node AS verified
    FROM placed p JOIN over o ON o.id = p.id AND o.n = 1 JOIN roots r ON r.grp = p.grp JOIN top t ON t.n = 1"""


def _clustering(clusters: int, rounds: int, size: int, seed: int, scale: int) -> str:
    gaps = " + ".join(f"(v[{i}] - c[{i}]) * (v[{i}] - c[{i}])" for i in range(1, size + 1))
    sums = ", ".join(f"sum(v[{i}])" for i in range(1, size + 1))
    whole = "len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x)))"
    steps = [
        f"""vectors AS MATERIALIZED (
            SELECT row_number() OVER () AS id, vec_id,
                   list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings WHERE len(embedding) = {size} AND {whole} = {size}
        ), centroids0 AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY sha256('{seed}:' || vec_id), v) - 1 AS k, v AS c
            FROM vectors WHERE vec_id IS NOT NULL QUALIFY k < {clusters}
        )"""
    ]
    for r in range(rounds + 1):
        steps.append(
            f"""gaps{r} AS MATERIALIZED (SELECT id, vec_id, v, k, CAST({gaps} AS HUGEINT) AS d FROM vectors, centroids{r}),
            placed{r} AS MATERIALIZED (SELECT id, vec_id, v, k, d FROM gaps{r}
            QUALIFY row_number() OVER (PARTITION BY id ORDER BY d, k) = 1)"""
        )
        if r < rounds:
            steps.append(
                f"""sums{r} AS (SELECT k, count(*) AS n, [{sums}] AS s FROM placed{r} GROUP BY k),
                centroids{r + 1} AS MATERIALIZED (
                    SELECT o.k, coalesce(
                        list_transform(s, lambda x: CAST((x - ((x % n) + n) % n) // n AS BIGINT)), c) AS c
                    FROM centroids{r} o LEFT JOIN sums{r} m ON m.k = o.k)"""
            )
    return f"""WITH {", ".join(steps)}
    SELECT vec_id, CAST(p.k AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance,
           CAST(sum(d) OVER (PARTITION BY p.k) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
           sha256(array_to_string(c, ',')) AS centroid_sha256
    FROM placed{rounds} p JOIN centroids{rounds} f ON f.k = p.k"""


CENTROIDS = _clustering(clusters=8, rounds=10, size=64, seed=3, scale=1024)


def _listed(values: tuple[str, ...]) -> str:
    return ", ".join(f"'{value}'" for value in values)


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = "regexp_extract_all({}, '[^\\x20\\x09-\\x0D]+')"
_PHRASE = " OR ".join(f"contains(translate(line, '{_UPPER}', '{_LOWER}'), '{phrase}')" for phrase in rules.PHRASES)

QUALITY = f"""
    WITH docs AS MATERIALIZED (
        SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS text FROM documents
    ), texts AS MATERIALIZED (
        SELECT id, doc_id, text, {_WORDS.format("text")} AS w FROM docs
    ), cut AS (
        SELECT id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS nth
        FROM docs
    ), lines AS MATERIALIZED (
        SELECT id, line, nth, {_WORDS.format("line")} AS w, row_number() OVER (PARTITION BY id, line ORDER BY nth) AS copy,
               length(regexp_replace(line, '[^#*$%&|<>!?]', '', 'g')) AS noise
        FROM cut
    ), judged AS MATERIALIZED (
        SELECT id, line, nth, len(w) AS n, len(w) > 0 AND copy > 1 AS again,
               len(w) > 0 AND noise > len(w) AND noise >= {rules.NOISE_MARKS} AS punctuation,
               len(list_filter(w, lambda x: x IN ({_listed(rules.SEPARATORS)}))) AS parts,
               len(w) > 0 AND (copy > 1 OR {_PHRASE}
                   OR 2 * len([1 FOR i IN range(2, len(w) + 1) IF w[i] = w[i - 1]]) > len(w)) AS boilerplate
        FROM lines
    ), ruled AS (
        SELECT *, parts > 1 AND {rules.NAVIGATION} * parts >= n AS navigation FROM judged
    ), by_text AS (
        SELECT id, count(*) FILTER (again) AS dup, count(*) FILTER (punctuation) AS punctuation_lines,
               count(*) FILTER (navigation) AS navigation_lines, count(*) FILTER (boilerplate) AS boilerplate_lines,
               coalesce(sum(n) FILTER (punctuation OR navigation OR boilerplate), 0) AS lost,
               coalesce(string_agg(line, chr(10) ORDER BY nth) FILTER (NOT (punctuation OR navigation OR boilerplate)), '') AS cleaned
        FROM ruled GROUP BY id
    ), words AS (
        SELECT id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM texts
    ), threes AS (
        SELECT id, i, word, lead(word, 1) OVER own AS second, lead(word, 2) OVER own AS third
        FROM words WINDOW own AS (PARTITION BY id ORDER BY i)
    ), windows AS (
        SELECT id, i, count(*) OVER (PARTITION BY id, word, second, third) AS found FROM threes WHERE third IS NOT NULL
    ), covered AS (
        SELECT id, count(DISTINCT place) AS n FROM (SELECT id, unnest([i, i + 1, i + 2]) AS place FROM windows WHERE found > 1)
        GROUP BY id
    ), counted AS (
        SELECT t.doc_id, CAST(len(t.w) AS BIGINT) AS n_words,
               CAST(coalesce(list_sum(list_transform(t.w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
               CAST(length(regexp_replace(t.text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, b.dup AS n_dup_lines,
               coalesce(c.n, 0) AS n_repeat_words, punctuation_lines, navigation_lines, boilerplate_lines,
               CAST(lost AS BIGINT) AS lost_words, sha256(cleaned) AS cleaned_sha256
        FROM texts t JOIN by_text b ON b.id = t.id LEFT JOIN covered c ON c.id = t.id
    ), verdicts AS (
        SELECT *, n_words < {rules.LEAST_WORDS} OR 100 * n_repeat_words > {rules.REPEATED_PERCENT} * n_words AS base_failed
        FROM counted
    )
    SELECT *, NOT base_failed AND 100 * lost_words <= {rules.LOST_PERCENT} * n_words AS kept FROM verdicts"""
