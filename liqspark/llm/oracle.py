"""DuckDB SQL for the operators that SQL can express, over the same tables."""

from __future__ import annotations

from .common import LOWER, UPPER
from .spotsigs import ANCHORS

_WORDS = (f"list_filter(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), "
          r"'[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')")

OP6 = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
     i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
     il AS (SELECT item_id, w, least(10, len(w)) AS l FROM i WHERE len(w) > 0),
     iw AS (SELECT DISTINCT item_id, l, array_to_string(w[s:s + l - 1], ' ') AS win
            FROM (SELECT item_id, w, l, unnest(generate_series(1, len(w) - l + 1)) AS s FROM il)),
     dw AS (SELECT doc_id, s, l, array_to_string(w[s:s + l - 1], ' ') AS win
            FROM (SELECT doc_id, w, l, unnest(generate_series(1, len(w) - l + 1)) AS s
                  FROM d, (SELECT DISTINCT l FROM iw) WHERE len(w) >= l)),
     m AS (SELECT doc_id, item_id, s, dw.l FROM dw JOIN iw USING (win, l)),
     h AS (SELECT doc_id, count(DISTINCT p) AS n_hit
           FROM (SELECT doc_id, unnest(generate_series(s, s + l - 1)) AS p FROM m) GROUP BY 1),
     n AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids
           FROM (SELECT DISTINCT doc_id, CAST(item_id AS varchar) AS x FROM m) GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS bigint) AS n_words, CAST(coalesce(n_hit, 0) AS bigint) AS n_hit,
       CAST(coalesce(n_items, 0) AS bigint) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN n USING (doc_id)
"""

_ANCHORS = "[" + ", ".join(f"'{a}'" for a in ANCHORS) + "]"


def _signatures(source: str, text: str) -> str:
    """Relation of (doc_id, sigs) for a text column, by rows of words."""
    return f"""
    (WITH w AS (SELECT doc_id, list_filter(string_split_regex(lower({text}), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '') AS w
                FROM {source}),
          p AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS i, len(w) AS n FROM w),
          q AS (SELECT *, list_contains({_ANCHORS}, x) AS common, lag(x) OVER t AS was FROM p
                WINDOW t AS (PARTITION BY doc_id ORDER BY i)),
          c AS (SELECT *, lead(x) OVER t AS later, row_number() OVER t AS k FROM q WHERE NOT common
                WINDOW t AS (PARTITION BY doc_id ORDER BY i)),
          s AS (SELECT doc_id, CASE WHEN list_contains({_ANCHORS}, was) THEN was ELSE '^' END || ' ' || x || ' ' || later AS sig
                FROM c WHERE later IS NOT NULL AND (k = 1 OR list_contains({_ANCHORS}, was))
                UNION SELECT doc_id, '^ ' || array_to_string(w, ' ') FROM w
                WHERE len(w) > 0 AND len(list_filter(w, lambda x: NOT list_contains({_ANCHORS}, x))) < 2)
     SELECT w.doc_id, list_sort(coalesce(list(DISTINCT sig) FILTER (sig IS NOT NULL), [])) AS sigs
     FROM w LEFT JOIN s USING (doc_id) GROUP BY 1)"""


def _jaccard(a: str, b: str) -> str:
    return f"""CASE WHEN len({a}) = 0 AND len({b}) = 0 THEN 1.0::double
        ELSE len(list_intersect({a}, {b}))::double / len(list_distinct(list_concat({a}, {b}))) END"""


OP2 = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n FROM documents),
     nx AS (SELECT *, coalesce(lead(text) OVER (ORDER BY doc_id), first_value(text) OVER (ORDER BY doc_id)) AS nt,
                   coalesce(lead(doc_id) OVER (ORDER BY doc_id), first_value(doc_id) OVER (ORDER BY doc_id)) AS nid FROM d),
     e AS (SELECT *, substr(text, 1, n - n // 2) || substr(nt, 1, n // 2) AS edited FROM nx),
     a AS {_signatures('e', 'text')},
     b AS {_signatures('e', 'edited')}
SELECT e.doc_id, CAST(n AS bigint) AS n_chars, sha256(edited) AS edited_sha256,
       md5(array_to_string(a.sigs, ',')) AS fingerprint, md5(array_to_string(b.sigs, ',')) AS edited_fingerprint,
       {_jaccard('a.sigs', 'b.sigs')} AS near_edited, {_jaccard('a.sigs', 'f.sigs')} AS near_next
FROM e JOIN a ON e.doc_id = a.doc_id JOIN b ON e.doc_id = b.doc_id JOIN a AS f ON e.nid = f.doc_id
"""

# The first four 8-digit groups of the digest, as integers.
_DRAWS = ", ".join(f"CAST('0x' || substr(x, {8 * i + 1}, 8) AS bigint) AS h{i + 1}" for i in range(4))

OP12 = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(CAST(doc_id AS varchar), '')) AS x FROM documents),
     t AS (SELECT doc_id, text, {_DRAWS}, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') AS t FROM d),
     n AS (SELECT *, len(t) AS n, least(h1 % (len(t) + 1), h2 % (len(t) + 1)) AS a,
                  greatest(h1 % (len(t) + 1), h2 % (len(t) + 1)) AS b,
                  CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                            OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM t),
     c AS (SELECT *, array_to_string(t[1:a], '') AS p, array_to_string(t[a + 1:b], '') AS m,
                  array_to_string(t[b + 1:n], '') AS s FROM n)
SELECT doc_id, CAST(n AS bigint) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(p) AS bigint) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(m) AS bigint) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
              ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM c
"""

OP13 = r"""
WITH w AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
     l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY 1),
     f AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
                  [len(w) < 50, 100 * len(list_distinct(w)) < 65 * len(w),
                   100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text),
                   regexp_matches(text, '[#$%&*|]'),
                   coalesce(w.doc_id > min(w.doc_id) OVER (PARTITION BY text), false)] AS fails
           FROM w LEFT JOIN l ON w.doc_id = l.doc_id),
     c AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
           FROM f GROUP BY 1, 2),
     x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
     o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM x a, x b, x c, x d, x e
           WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
     s AS (SELECT filter_order, step, substr(filter_order, step, 1) AS own,
                  list_transform(range(1, step), lambda i: ascii(substr(filter_order, i, 1)) - 64) AS before,
                  ascii(substr(filter_order, step, 1)) - 64 AS k
           FROM o, (SELECT unnest(range(1, 6)) AS step)),
     j AS (SELECT part, filter_order, step, own, n, good, toxic, fails[k] AS mine,
                  len(list_filter(before, lambda i: fails[i])) > 0 AS gone,
                  len(list_filter(fails, lambda y: y)) AS failed FROM c, s),
     r AS (SELECT part, filter_order, step, own, coalesce(sum(n) FILTER (NOT mine AND NOT gone), 0) AS kept,
                  coalesce(sum(n) FILTER (mine AND NOT gone), 0) AS removed,
                  coalesce(sum(n) FILTER (mine AND gone), 0) AS redundant,
                  coalesce(sum(n) FILTER (mine AND failed = 1), 0) AS unique_fails,
                  coalesce(sum(good) FILTER (mine AND NOT gone), 0) AS good_lost,
                  coalesce(sum(toxic) FILTER (mine AND NOT gone), 0) AS toxic_lost
           FROM j GROUP BY 1, 2, 3, 4)
SELECT part, filter_order, CAST(step AS int) AS step, CAST(kept AS bigint) AS kept, CAST(removed AS bigint) AS removed,
       CAST(redundant AS bigint) AS redundant, CAST(unique_fails AS bigint) AS unique_fails,
       CAST(good_lost AS bigint) AS good_lost, CAST(toxic_lost AS bigint) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, own) AS bigint) AS shapley
FROM r
"""

ORACLE_SQL: dict[str, str] = {"op13_filter_audit": OP13, "op12_fill_in_middle": OP12, "op2_fingerprints": OP2, "op6_decontamination": OP6}
