"""The SQL of the operators that SQL can express, in DuckDB's functions."""

from __future__ import annotations

from termloom.llm import licences as known


def crc32(value: str) -> str:
    """The unsigned CRC-32 of an ASCII string, bit by bit."""
    codes = f"list_transform(string_split({value}, ''), lambda x: ascii(x)::BIGINT)"
    step = (
        "list_reduce(range(8), lambda k, i: "
        "CASE WHEN k & 1 = 1 THEN xor(k >> 1, 3988292384) ELSE k >> 1 END, xor(s, b))"
    )
    return f"xor(list_reduce({codes}, lambda s, b: {step}, 4294967295::BIGINT), 4294967295)"


PREFIX_TRIE = f"""
    WITH t AS (
        SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
               row_number() OVER (
                   PARTITION BY conv_id
                   ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')
               ) AS pos
        FROM conversations WHERE conv_id IS NOT NULL
    ), numbered AS (
        SELECT conv_id, pos, dense_rank() OVER (ORDER BY role, text) AS id,
               octet_length(encode(text)) AS size
        FROM t
    ), sizes AS (SELECT DISTINCT id, size FROM numbered),
    c AS (
        SELECT conv_id, list(id ORDER BY pos) AS ids, {crc32('conv_id::VARCHAR')} % 9 AS h
        FROM numbered GROUP BY conv_id
    ), r AS (
        SELECT c.conv_id, list_concat(list_slice(coalesce(b.ids, []), 1, c.h),
                                      list_slice(c.ids, c.h + 1, len(c.ids))) AS ids
        FROM c LEFT JOIN c b ON b.conv_id = c.conv_id - c.conv_id % 5
    ), m AS (
        SELECT conv_id, d, list_slice(ids, 1, d) AS key, len(ids) = d AS ends
        FROM (SELECT conv_id, ids, unnest(range(0, len(ids) + 1)) AS d FROM r)
    ), n AS (
        SELECT key, d, min(conv_id) AS conv_id, count(*) AS n_convs,
               sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)
                               FILTER (WHERE ends), '')) AS ends_sha256,
               count(*) = count(*) FILTER (WHERE ends) AS leaf
        FROM m GROUP BY key, d
    ), v AS (
        SELECT n.*, CASE WHEN d > 0 THEN (n_convs - 1) * s.size ELSE 0 END AS saved
        FROM n LEFT JOIN sizes s ON s.id = n.key[n.d]
    ), up AS (
        SELECT list_slice(key, 1, a) AS key, sum(saved) AS saved, count(*) FILTER (WHERE leaf) AS leaves,
               count(*) FILTER (WHERE a = d - 1) AS children
        FROM (SELECT key, d, saved, leaf, unnest(range(0, d + 1)) AS a FROM v) GROUP BY 1
    )
    SELECT v.conv_id, v.d AS depth, p.conv_id AS parent_conv_id, v.n_convs, up.children AS n_children,
           up.leaves AS n_leaves, up.saved::BIGINT AS saved_tokens, v.ends_sha256
    FROM v JOIN up ON up.key = v.key
    LEFT JOIN v p ON p.d = v.d - 1 AND p.key = list_slice(v.key, 1, v.d - 1)
"""


def _leaf(text: str) -> str:
    values = ["doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text]
    fields = (f"coalesce(octet_length(encode({v}))::VARCHAR || ':' || {v}, '-')" for v in values)
    return f"sha256({' || '.join(fields)})"


def _levels(leaves: str) -> str:
    """All nodes over ``leaves`` (tree, i, digest); to stand in a recursive WITH."""
    return f"""
        SELECT tree, 0 AS level, i, digest, count(*) OVER (PARTITION BY tree) AS size FROM {leaves}
        UNION ALL
        SELECT tree, level + 1, i // 3, sha256(string_agg(digest, '' ORDER BY i)), (any_value(size) + 2) // 3
        FROM {{name}} WHERE size > 1 GROUP BY tree, level, i // 3
    """


def _beside(nodes: str) -> str:
    run = "PARTITION BY tree, level, i // 3 ORDER BY i ROWS BETWEEN"
    return f"""
        SELECT tree, level, i,
               coalesce(string_agg(digest, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') || '|' ||
               coalesce(string_agg(digest, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS step
        FROM {nodes} WHERE size > 1
    """


_TAMPERED = (
    f"CASE WHEN {crc32('doc_id::VARCHAR')} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END"
)

MERKLE = f"""
    WITH RECURSIVE l AS (
        SELECT doc_id, coalesce('=' || source, '-') AS tree, {_leaf('text')} AS digest,
               {_leaf(_TAMPERED)} AS tampered,
               row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, {_leaf('text')}) - 1 AS i
        FROM documents
    ), n AS ({_levels('l').format(name='n')}),
    s AS (
        SELECT '' AS tree, tree AS of, row_number() OVER (ORDER BY encode(tree)) - 1 AS i, digest
        FROM n WHERE size = 1
    ), u AS ({_levels('s').format(name='u')}),
    nb AS ({_beside('n')}), ub AS ({_beside('u')}),
    inner_steps AS (
        SELECT l.doc_id, l.tree, l.i, list(step ORDER BY level) AS steps
        FROM l JOIN nb ON nb.tree = l.tree AND nb.i = l.i // (3 ** level)::BIGINT GROUP BY ALL
    ), upper_steps AS (
        SELECT s.of, list(step ORDER BY level) AS steps
        FROM s JOIN ub ON ub.i = s.i // (3 ** level)::BIGINT GROUP BY ALL
    ), w AS (
        SELECT l.*, s.digest AS subroot, (SELECT digest FROM u WHERE size = 1) AS root,
               list_concat(coalesce(a.steps, []::VARCHAR[]), coalesce(b.steps, []::VARCHAR[])) AS steps
        FROM l JOIN s ON s.of = l.tree LEFT JOIN upper_steps b ON b.of = l.tree
        LEFT JOIN inner_steps a ON a.tree = l.tree AND a.i = l.i
    ), f AS (
        SELECT doc_id, digest AS leaf, subroot, root,
               sha256(replace(array_to_string(steps, ''), '|', '')) AS proof_sha256,
               list_reduce(steps, lambda d, x: sha256(split_part(x, '|', 1) || d || split_part(x, '|', 2)),
                           coalesce(tampered, digest)) AS folded_root
        FROM w
    )
    SELECT *, folded_root = root AS verified FROM f
"""


def _quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _values(rows) -> str:
    return ", ".join(f"({', '.join(map(_quoted, row))})" for row in rows)


def licences() -> str:
    """The same canonical form in DuckDB's functions."""
    copyright_line = known.COPYRIGHT_LINE.replace("(?md)", "(?m)")
    lines = (
        f"' ' || replace(regexp_replace(regexp_replace(lower(text), {_quoted(copyright_line)}, '', 'g'), "
        f"{_quoted(known.OTHER)}, '  ', 'g'), chr(10), ' ' || chr(10) || ' ') || ' '"
    )
    for pair in known.SPELLINGS:
        spelling, other = (f" {words} ".replace(" ", "  ")[1:-1] for words in pair)
        lines = f"replace({lines}, {_quoted(spelling)}, {_quoted(other)})"
    names = [(licence_id, name) for licence_id, names in known.NAMES for name in names]

    def digest(value: str) -> str:
        flat = f"trim(regexp_replace({value}, {_quoted(known.BREAK)}, '  ', 'g'))"
        return f"CASE WHEN {flat} <> '' THEN sha256({flat}) END"

    return f"""
        WITH texts AS (
            SELECT * FROM (VALUES {_values(known.KNOWN)}) k(id, text)
            UNION ALL
            SELECT DISTINCT id, {_quoted(known.TAG)} || ' ' || id FROM (VALUES {_values(names)}) n(id, name)
            UNION ALL
            SELECT id, subject || ' ' || verb || ' ' || link || ' ' || name
            FROM (VALUES {_values(names)}) n(id, name),
                 (VALUES {_values((x,) for x in known.SUBJECTS)}) s(subject),
                 (VALUES {_values((x,) for x in known.VERBS)}) v(verb),
                 (VALUES {_values((x,) for x in known.LINKS)}) l(link)
        ), known AS (
            SELECT digest, min(id) AS licence_id
            FROM (
                SELECT {digest('lines')} AS digest, id FROM (SELECT id, {lines} AS lines FROM texts)
                UNION ALL
                SELECT digest, id FROM (VALUES {_values(known.DIGESTS)}) t(id, digest)
            ) GROUP BY 1
        ), d AS (
            SELECT doc_id, {lines} AS lines FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents)
        ), l AS (
            SELECT doc_id, k.licence_id
            FROM (SELECT doc_id, unnest(string_split(lines, chr(10))) AS line FROM d) x
            JOIN known k ON k.digest = {digest('line')}
        ), g AS (
            SELECT doc_id, string_agg(DISTINCT licence_id, ',' ORDER BY licence_id) AS ids, count(*) AS n
            FROM l GROUP BY doc_id
        )
        SELECT d.doc_id, {digest('d.lines')} AS canonical_sha256, k.licence_id,
               coalesce(g.ids, '') AS line_licences, coalesce(g.n, 0) AS n_lines
        FROM d LEFT JOIN known k ON k.digest = {digest('d.lines')} LEFT JOIN g USING (doc_id)
    """
