"""SQL for DuckDB of the training-data queries that plain SQL can express, over the same whole tables."""

from __future__ import annotations

_WORDS = r"regexp_extract_all(lower({x}), '[\p{{L}}\p{{N}}\p{{M}}]+')"
_RECORDS = f"""SELECT DISTINCT 'd' AS rec, doc_id AS id, {_WORDS.format(x="text")} AS w FROM documents UNION SELECT DISTINCT 'm', msg_id, {_WORDS.format(x="body")} FROM messages"""


def _runs(w: str, n: int) -> str:
    """The runs of n words of a list."""
    return f"list_distinct(list_transform(range(1, len({w}) - {n - 2}), lambda i: array_to_string({w}[i:i + {n - 1}], ' ')))"


def _near(size: int, share: str) -> str:
    return f"""taking AS MATERIALIZED (SELECT rec, id, {_runs("w", size)} AS s FROM ({_RECORDS}) WHERE len(w) >= 20),
      each AS MATERIALIZED (SELECT rec, id, len(s) AS n, unnest(s) AS g FROM taking),
      near AS MATERIALIZED (SELECT a.rec, a.id AS id_a, b.id AS id_b FROM each a JOIN each b ON a.rec = b.rec AND a.g = b.g AND a.id < b.id GROUP BY a.rec, a.id, b.id, a.n, b.n HAVING count(*) >= {share} * (a.n + b.n - count(*)))"""


ORACLES: dict[str, str] = {
    "p1_found": f"WITH {_near(3, '0.6')} SELECT rec, id_a, id_b FROM near",
    "p1_groups": f"""WITH RECURSIVE {_near(5, '0.8')}, both_ways AS (SELECT rec, id_a AS a, id_b AS b FROM near UNION ALL SELECT rec, id_b, id_a FROM near),
      reach AS (SELECT rec, id AS a, id AS b FROM taking UNION SELECT r.rec, r.a, e.b FROM reach r JOIN both_ways e ON r.rec = e.rec AND r.b = e.a)
      SELECT rec, a AS id, min(b) AS group_id, count(*) AS members FROM reach GROUP BY rec, a""",
    "p1_links": f"""WITH {_near(3, '0.6')}, raw AS (SELECT DISTINCT 'd' AS rec, doc_id AS id, text FROM documents UNION SELECT DISTINCT 'm', msg_id, body FROM messages),
      same AS (SELECT rec, id, min(id) OVER (PARTITION BY rec, text) AS class_id, count(*) OVER (PARTITION BY rec, text) AS copies FROM raw),
      ends AS (SELECT rec, id, count(*) AS k FROM (SELECT rec, id_a AS id FROM near UNION ALL SELECT rec, id_b FROM near) GROUP BY rec, id)
      SELECT rec, id, class_id, copies, coalesce(k, 0)::bigint AS n_links FROM taking JOIN same USING (rec, id) LEFT JOIN ends USING (rec, id)""",
    "p7_found": f"""WITH d AS (SELECT doc_id, unnest({_runs("w", 12)}) AS g FROM (SELECT doc_id, {_WORDS.format(x="text")} AS w FROM documents)),
      i AS (SELECT item_id, unnest({_runs("w", 12)}) AS g FROM (SELECT item_id, {_WORDS.format(x="item_text")} AS w FROM eval_items))
      SELECT DISTINCT item_id, doc_id FROM i JOIN d USING (g)""",
    "p9_found": """WITH w AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, length(text) - 298), lambda i: md5(substring(text, i, 300)))) AS h FROM documents),
      held AS (SELECT list(doc_id ORDER BY doc_id) AS ids FROM w GROUP BY h HAVING count(*) > 1), sets AS (SELECT DISTINCT ids FROM held),
      firsts AS (SELECT ids, unnest(ids) AS doc_a FROM sets)
      SELECT DISTINCT doc_a, doc_b FROM (SELECT doc_a, unnest(ids) AS doc_b FROM firsts) WHERE doc_a < doc_b""",
    "p9_units": r"""WITH u AS (SELECT doc_id AS id, k, l, regexp_replace(trim(regexp_replace(lower(l), '[^\p{L}\p{N}]+', ' ', 'g')), ' +', ' ', 'g') AS plain
        FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l, generate_subscripts(string_split(text, chr(10)), 1) AS k FROM documents WHERE text IS NOT NULL)),
      r AS (SELECT *, length(plain) >= 40 AND row_number() OVER (PARTITION BY plain ORDER BY id, k) > 1 AS gone FROM u)
      SELECT id, count(*) AS units, count(*) FILTER (WHERE gone) AS removed_units, coalesce(sum(length(l)) FILTER (WHERE gone), 0)::bigint AS removed_chars, coalesce(string_agg(l, chr(10) ORDER BY k) FILTER (WHERE NOT gone), '') AS kept_text FROM r GROUP BY id""",
}
