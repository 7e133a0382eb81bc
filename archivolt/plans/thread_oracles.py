"""SQL for DuckDB of the queries on mail threads, links and clusters; all pairs are formed plainly here."""

from __future__ import annotations

from archivolt.plans.oracles import _clean_for_matching, _clean_message_body, _clean_text, _doc_type, _EMAILS, _fix_date, _header, _HEADED, _lit, _norm_body, _norm_email, _strip, _subject_norm, _W

_S = r"[\s\p{Z}]"
# What opens a quoted message.
_ATTRIBUTION = rf"(?i)On{_S}+([{_W},\s\p{{Z}}]+\p{{Nd}}{{4}}[,\s\p{{Z}}]+(?:at{_S}+)?\p{{Nd}}{{1,2}}:\p{{Nd}}{{2}}{_S}*(?:AM|PM)?)[,\s\p{{Z}}]*([^<\n]*)?(?:<([^>]+)>)?{_S}*(?:>?{_S}*wrote:)?"
_MARKERS = (rf"-{{3,}}{_S}*Original message{_S}*-{{3,}}", rf"----+{_S}*Original message", "Sent using BlackBerry", "Sent from my iPhone", "Sent from my iPod")
_HEADS = "^(?:to|from|sent|date|subject|fran):"


def _first(text: str, pattern: str) -> str:
    """Characters before the first match, null without one."""
    return f"CASE WHEN regexp_matches({text}, {_lit(pattern)}) THEN length(string_split_regex({text}, {_lit(pattern)})[1]) END"


def _boundary(source: str, key: str) -> str:
    plain = ", ".join(_first("text", "(?i)" + m) for m in _MARKERS)
    return f"""SELECT {key}, text, least(coalesce(named, plain), plain) AS cut, coalesce(named <= plain AND named < length(text), false) AS attributed
        FROM (SELECT {key}, text, {_first("text", _ATTRIBUTION)} AS named, least({plain}, length(text)) AS plain FROM ({source}))"""


def _drop(x: str, pattern: str) -> str:
    return f"regexp_replace({x}, {_lit(pattern)}, '', 'g')"


def _after(x: str, pattern: str) -> str:
    """What follows the first match; the pattern must match."""
    m = f"regexp_extract({x}, {_lit(pattern)})"
    return f"substring({x}, strpos({x}, {m}) + length({m}))"


def thread_messages(source: str) -> str:
    """Messages (filename, msg_idx, sender, recipient, date_str, subject, body) of a source of filename, text."""
    heads = {k: _header(p) for k, p in {"h_to": r"^To:\s*(.+?)(?:\n|$)", "h_from": r"^From:\s*(.+?)(?:\n|$)", "h_sent": r"^(?:Sent|Date)[:\s]+(.+?)(?:\n|$)", "h_subject": r"^Subject:\s*(.+?)(?:\n|$)"}.items()}
    listed = ", ".join(f"{v} AS {k}" for k, v in heads.items())
    low = "lower(" + _strip("l") + ")"
    name = _strip(_drop(_strip(_drop("rtrim(raw_name, ',')", rf"(?i){_S}*>?{_S}*wrote:?{_S}*$")), ">+$"))
    body = _drop(_strip(f"CASE WHEN regexp_matches(quoted, '(?i)wrote:') THEN {_after('quoted', rf'(?i)wrote:{_S}*')} WHEN regexp_matches(quoted, 'On{_S}+[^\\n]+\\n') THEN {_after('quoted', rf'On{_S}+[^\n]+\n')} ELSE quoted END"), rf"(?m)^>{_S}?")
    body = f"string_split_regex({body}, {_lit(rf'\n{_S}*On{_S}+[{_W},\s\p{{Z}}]+\p{{Nd}}{{4}}')})[1]"
    for sign in (rf"(?is)\n--{_S}*\n.*", r"(?is)\nSent from my.*", r"(?is)\n_{3,}.*"):
        body = _drop(body, sign)
    return f"""
      WITH cut AS ({_boundary(f"SELECT filename, text, {listed} FROM ({source})", "filename, " + ", ".join(heads))}),
      parts AS (SELECT *, {_strip("substring(text, 1, cut)")} AS above, CASE WHEN cut < length(text) THEN {_strip("substring(text, cut + 1)")} END AS quoted FROM cut),
      lined AS (SELECT *, string_split(above, chr(10)) AS ls FROM parts),
      stops AS (SELECT *, coalesce(list_min(list_filter(range(1, len(ls) + 1), lambda i: list_transform(ls, lambda l: {low} <> '' AND NOT regexp_matches({low}, {_lit(_HEADS)}))[i])), len(ls) + 1) AS stop FROM lined),
      bodies AS (SELECT *, {_strip("array_to_string(ls[coalesce(list_max(list_filter(range(1, stop), lambda i: list_transform(ls, lambda l: regexp_matches(" + low + ", " + _lit(_HEADS) + "))[i])), 0) + 1:], chr(10))")} AS top FROM stops),
      named AS (SELECT *, CASE WHEN attributed THEN {_strip(f"regexp_extract(quoted, {_lit(_ATTRIBUTION)}, 2)")} ELSE '' END AS raw_name,
          CASE WHEN attributed THEN {_strip(f"regexp_extract(quoted, {_lit(_ATTRIBUTION)}, 3)")} ELSE '' END AS address,
          CASE WHEN attributed THEN {_strip(f"regexp_extract(quoted, {_lit(_ATTRIBUTION)}, 1)")} ELSE '' END AS q_date, {_clean_text("top")} AS body, {_clean_text(body)} AS q_body FROM bodies),
      who AS (SELECT *, {name} AS q_name FROM named)
      SELECT filename, 0 AS msg_idx, h_from AS sender, h_to AS recipient, h_sent AS date_str, h_subject AS subject, body FROM who WHERE length(body) > 5
      UNION ALL
      SELECT filename, 1, CASE WHEN address <> '' AND q_name <> '' THEN '"' || q_name || '" <' || address || '>' WHEN address <> '' THEN address ELSE q_name END, h_from, q_date, h_subject, q_body
      FROM who WHERE quoted IS NOT NULL AND length(q_body) > 10"""


_MAIL = "SELECT filename, text FROM documents WHERE doc_type = 'email' AND text IS NOT NULL"

ORACLES: dict[str, str] = {
    "quote_boundary": f"SELECT doc_id, cut::int AS \"offset\", attributed FROM ({_boundary('SELECT doc_id, text FROM documents WHERE text IS NOT NULL', 'doc_id')})",
    "thread_participants": f"SELECT DISTINCT filename, unnest([sender, recipient]) AS participant FROM ({thread_messages(_MAIL)}) WHERE true QUALIFY participant <> ''",
    "thread_messages": f"SELECT filename, msg_idx, sender, recipient, date_str, subject, body FROM ({thread_messages(_MAIL)})",
}

_MONTH = "(?:jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sept?(?:ember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)"
_CLOCK = r"(\d{1,2}):(\d{1,2})(?::(\d{2}))?"
#: Notations: pattern, and the groups of year, month, day, hour, minute, second, half of the day (0: none).
_NOTATIONS = (
    (rf"(?i)(?:^|[a-z,] )({_MONTH}) (\d{{1,2}}), (\d{{4}}) (?:at )?{_CLOCK} (AM|PM)(?: [A-Z]+)?$", (3, 1, 2, 4, 5, 6, 7)),
    (rf"(?i)^(?:[a-z]+, )?({_MONTH}) (\d{{1,2}}), (\d{{4}})$", (3, 1, 2, 0, 0, 0, 0)),
    (rf"(?i)^({_MONTH}) (\d{{4}})$", (2, 1, 0, 0, 0, 0, 0)),
    (rf"(?i)^(?:[^\d]* )?(\d{{1,2}}) ({_MONTH}),? (\d{{4}}),? (?:at )?{_CLOCK}(?: [A-Z+(].*)?(?: [+-]\d{{4}}.*)?$", (3, 2, 1, 4, 5, 6, 0)),
    (rf"(?i)^[a-z]+, (\d{{1,2}})\. ({_MONTH}) (\d{{4}}) {_CLOCK}$", (3, 2, 1, 4, 5, 6, 0)),
    (rf"(?i)^(?:[\p{{L}}]+, )?(\d{{1,2}})\.? [\p{{L}}]+ (\d{{4}}) {_CLOCK}$", (2, 1, 0, 3, 4, 5, 0)),
    (r"^(\d{4})[-/](\d{1,2})[-/](\d{1,2})(?:[T ](\d{2}):(\d{2}):(\d{2}).*)?$", (1, 2, 3, 4, 5, 6, 0)),
    (rf"(?i)^[a-z]{{3}} ({_MONTH}) (\d{{1,2}}) {_CLOCK} (\d{{4}})$", (6, 1, 2, 3, 4, 5, 0)),
    (r"^(\d{4})(\d{2})(\d{2})T(\d{2})(\d{2})(\d{2})Z$", (1, 2, 3, 4, 5, 6, 0)),
    (rf"(?i)^(0?[1-9]|1[0-2])[/.](\d{{1,2}})[/.](\d{{2,4}}) {_CLOCK}(?: (AM|PM))?$", (3, 1, 2, 4, 5, 6, 7)),
    (rf"(?i)^(\d{{1,2}})[/.](\d{{1,2}})[/.](\d{{2,4}}) {_CLOCK}(?: (AM|PM))?$", (3, 2, 1, 4, 5, 6, 7)),
)
# What the fuzzy reading makes of damaged texts that no notation above describes.
_DAMAGED = {
    "Apr 23, 2015 10 :09 AM": "2015-04-23 09:00:00", "31 mars 2014 03:29": None,
}


def dated(source: str) -> str:
    """``date_str, wall`` (text) of the distinct texts of a source with ``date_str``."""
    cases = []
    for pattern, groups in _NOTATIONS:
        y, mo, d, h, mi, s, half = (f"regexp_extract(t, {_lit(pattern)}, {g})" if g else "''" for g in groups)
        year = f"CASE WHEN length({y}) = 2 THEN '20' || {y} ELSE {y} END"
        month = f"CASE WHEN regexp_matches({mo}, '^\\d') THEN {mo}::int ELSE (strpos('janfebmaraprmayjunjulaugsepoctnovdec', lower({mo}[1:3])) + 2) // 3 END"
        hour = f"coalesce(try_cast({h} AS int), 0) % (CASE WHEN {half} <> '' THEN 12 ELSE 24 END) + CASE WHEN upper({half}) = 'PM' THEN 12 ELSE 0 END"
        stamp = f"printf('%s-%02d-%02d %02d:%02d:%02d', {year}, {month}, coalesce(try_cast({d} AS int), 1), {hour}, coalesce(try_cast({mi} AS int), 0), coalesce(try_cast({s} AS int), 0))"
        cases.append(f"WHEN regexp_matches(t, {_lit(pattern)}) THEN {stamp}")
    odd = " ".join(f"WHEN date_str = {_lit(k)} THEN {_lit(v) if v else 'NULL'}" for k, v in _DAMAGED.items())
    days = " ".join(f"WHEN t = '{n}' THEN '2000-01-{k:02d} 00:00:00'" for k, n in enumerate(("Saturday", "Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday"), 1))
    # a letter that sticks to a number says nothing to the fuzzy reading
    tidy = _fix_date(f"regexp_replace({_strip('date_str')}, {_lit(_S + '+')}, ' ', 'g')")
    return f"""SELECT date_str, strftime(try_strptime(CASE {odd} {days} {" ".join(cases)} END, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S') AS wall
        FROM (SELECT date_str, regexp_replace(regexp_replace({tidy}, '(\\d)[lI]([ ,])', '\\1\\2', 'g'), ' [lI](\\d,)', ' \\1', 'g') AS t FROM (SELECT DISTINCT date_str FROM ({source})))"""


ORACLES["parse_dates"] = dated("SELECT date_str FROM messages")
ORACLES["thread_messages"] = f"WITH m AS ({thread_messages(_MAIL)}) SELECT m.*, d.wall FROM m LEFT JOIN ({dated('SELECT date_str FROM m')}) d USING (date_str)"
ORACLES["thread_participants"] = f"SELECT DISTINCT filename, participant FROM (SELECT filename, sender AS participant FROM ({thread_messages(_MAIL)}) UNION ALL SELECT filename, recipient FROM ({thread_messages(_MAIL)})) WHERE participant <> ''"


def _lcs(pairs: str) -> str:
    """``a, b, lcs``: longest common subsequence of distinct pairs; after each letter of b, r[k] is the least end in a of a common subsequence of k letters."""
    after = "(coalesce(r[k - 1], 0) + nullif(strpos(substring(a, coalesce(r[k - 1], 0) + 1), c), 0))"
    return f"""WITH RECURSIVE lcs_pairs AS (SELECT DISTINCT a, b FROM ({pairs})), lcs_rows AS (
        SELECT a, b, 0 AS n, []::bigint[] AS r FROM lcs_pairs
        UNION ALL
        SELECT a, b, n + 1, list_filter(list_transform(range(1, len(r) + 2), lambda k: least(r[k], {after})), lambda v: v IS NOT NULL) FROM (SELECT *, b[n + 1] AS c FROM lcs_rows WHERE n < length(b)))
      SELECT a, b, len(r) AS lcs FROM lcs_rows WHERE n = length(b)"""


def _alike(strings: str, percent: int) -> str:
    """``a, b, ratio`` of the distinct strings ``s`` that are more alike; a < b."""
    near = f"SELECT x.s AS a, y.s AS b FROM alike_s x JOIN alike_s y ON x.s < y.s AND levenshtein(x.s, y.s) * 100 <= (length(x.s) + length(y.s)) * {100 - percent}"
    return f"WITH alike_s AS (SELECT DISTINCT s FROM ({strings})) SELECT a, b, 200.0::double * lcs / (length(a) + length(b)) AS ratio FROM ({_lcs(near)}) WHERE 200.0::double * lcs / (length(a) + length(b)) > {percent}"


def _dedup(source: str) -> str:
    """``thread, k`` of the messages that strict order keeps; the source has ``thread, k`` (unique order), ``body``."""
    heads = "substring(x.norm, 1, 50)", "substring(y.norm, 1, 50)"
    short, long = "CASE WHEN length(x.norm) <= length(y.norm) THEN x.norm ELSE y.norm END", "CASE WHEN length(x.norm) <= length(y.norm) THEN y.norm ELSE x.norm END"
    return f"""WITH RECURSIVE norms AS MATERIALIZED (SELECT thread, k, {_norm_body('body')} AS norm FROM ({source})),
      first AS MATERIALIZED (SELECT thread, norm, min(k) AS k FROM norms WHERE length(norm) >= 10 GROUP BY thread, norm),
      ranked AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY thread ORDER BY k) AS r FROM first),
      met AS MATERIALIZED (SELECT x.thread, x.r AS rx, y.r AS ry, length(x.norm) > 20 AND length(y.norm) > 20 AND (contains(x.norm, y.norm) OR contains(y.norm, x.norm)) AS inside,
          length(x.norm) > 30 AND length(y.norm) > 30 AND levenshtein({heads[0]}, {heads[1]}) * 100 <= 15 * (length({heads[0]}) + length({heads[1]})) AS near,
          {heads[0]} AS hx, {heads[1]} AS hy, {short} AS short, substring({long}, 1, length({short}) + 20) AS long
        FROM ranked x JOIN ranked y ON x.thread IS NOT DISTINCT FROM y.thread AND x.r < y.r),
      heads AS MATERIALIZED ({_lcs("SELECT hx AS a, hy AS b FROM met WHERE near AND NOT inside")}),
      alike AS MATERIALIZED (SELECT m.*, levenshtein(short, long) AS lev FROM met m JOIN heads h ON m.hx = h.a AND m.hy = h.b WHERE near AND NOT inside AND 200 * h.lcs > 85 * (length(hx) + length(hy))),
      doubtful AS MATERIALIZED (SELECT DISTINCT short, long, least(length(short), length(long)) AS n FROM alike WHERE lev * 100 <= 20 * (length(short) + length(long)) AND lev * 200 >= 20 * (length(short) + length(long))),
      headed AS MATERIALIZED (SELECT *, coalesce(list_min(list_filter(range(1, n + 1), lambda i: short[i] <> long[i])), n + 1) - 1 AS pre FROM doubtful),
      tailed AS MATERIALIZED (SELECT *, coalesce(list_min(list_filter(range(1, n - pre + 1), lambda i: short[-i] <> long[-i])), n - pre + 1) - 1 AS suf FROM headed),
      middles AS MATERIALIZED (SELECT *, short[pre + 1:length(short) - suf] AS ma, long[pre + 1:length(long) - suf] AS mb FROM tailed),
      middle AS MATERIALIZED ({_lcs("SELECT ma AS a, mb AS b FROM middles")}),
      bodies AS (SELECT short AS a, long AS b, pre + suf + m.lcs AS lcs FROM middles JOIN middle m ON ma = m.a AND mb = m.b),
      dups AS (SELECT thread, rx, ry FROM met WHERE inside
        UNION ALL SELECT thread, rx, ry FROM alike WHERE lev * 200 < 20 * (length(short) + length(long))
        UNION ALL SELECT thread, rx, ry FROM alike m JOIN bodies b ON m.short = b.a AND m.long = b.b WHERE 200 * b.lcs > 80 * (length(b.a) + length(b.b))),
      before AS MATERIALIZED (SELECT r.thread, r.r, r.k, list_filter(list(d.rx), lambda v: v IS NOT NULL) AS earlier FROM ranked r LEFT JOIN dups d ON r.thread IS NOT DISTINCT FROM d.thread AND r.r = d.ry GROUP BY r.thread, r.r, r.k),
      walk AS (SELECT thread, 0 AS n, []::bigint[] AS kept FROM before WHERE r = 1
        UNION ALL SELECT w.thread, w.n + 1, CASE WHEN list_has_any(w.kept, b.earlier) THEN w.kept ELSE list_append(w.kept, b.r) END FROM walk w JOIN before b ON w.thread IS NOT DISTINCT FROM b.thread AND b.r = w.n + 1),
      last AS (SELECT thread, max_by(kept, n) AS kept FROM walk GROUP BY thread)
    SELECT b.thread, b.k FROM before b JOIN last l ON b.thread IS NOT DISTINCT FROM l.thread WHERE list_contains(l.kept, b.r)"""


def _clean_participant(source: str) -> str:
    """A source with ``p0`` and its cleaned form ``shown``."""
    inside = r"regexp_extract(p, '[<\[(]([^>\])]+@[^>\])]+)[>\])]', 1)"
    name = f"regexp_replace({_strip(r'''regexp_replace(p, '(?s)[<\[(].*', '', 'g')''')}, '^On.*?,\\s*', '')"
    return f"""SELECT *, CASE
        WHEN p = '' OR contains(lower(p), 'wrote:') OR length(p) > 80 OR contains(p, 'Sent from') OR regexp_matches(p, '^(?:On |I |i |ein\\(|eini|• )') THEN ''
        WHEN inside <> '' THEN CASE WHEN name <> '' AND length(name) < 40 AND NOT starts_with(name, 'On ') THEN name || ' <' || {_norm_email('inside')} || '>' ELSE {_norm_email('inside')} END
        WHEN address <> '' THEN {_norm_email('address')}
        WHEN length(p) < 40 AND NOT regexp_matches(p, '[:@><\\n(]') AND NOT regexp_matches(p, '^[\\d.\\s]+$') THEN p ELSE '' END AS shown
      FROM (SELECT *, {inside} AS inside, {name} AS name, regexp_extract(p, '[{_W}.\\-]+@[{_W}.\\-]+\\.[{_W}]+') AS address FROM (SELECT *, {_strip("coalesce(p0, '')")} AS p FROM ({source})))"""


_CHUNKS = f"""SELECT filename, c, unnest(list_filter(list_transform(range(0, greatest(ceil((length(c) - 100) / 50.0), 0)::bigint), lambda i: substring(c, i * 50 + 1, 100)),
    lambda x: length({_strip('x')}) >= 80 AND length(regexp_replace(x, '[^\\p{{L}}]', '', 'g')) >= 40)) AS chunk FROM (SELECT filename, {_clean_for_matching('text')} AS c FROM documents)"""
_QUOTED = f"""WITH own AS MATERIALIZED (SELECT DISTINCT filename, chunk FROM ({_CHUNKS})),
    held AS MATERIALIZED (SELECT DISTINCT filename, w FROM (SELECT filename, unnest(list_transform(range(1, length(c) - 98), lambda i: substring(c, i, 100))) AS w FROM (SELECT filename, {_clean_for_matching('text')} AS c FROM documents)) SEMI JOIN own ON w = chunk)
  SELECT DISTINCT least(o.filename, h.filename) AS i, greatest(o.filename, h.filename) AS j FROM own o JOIN held h ON o.chunk = h.w WHERE o.filename <> h.filename"""

_LINKED = f"""docs AS MATERIALIZED (SELECT d.filename, text, lower({_subject_norm(_header(r'^Subject:\s*(.+?)(?:\n|$)'))}) AS subject, {_header(r'^Subject:\s*(.+?)(?:\n|$)')} AS raw_subject, {_EMAILS} AS addresses, try_cast(nullif(regexp_extract(filename, 'EFTA(\\d+)', 1), '') AS bigint) AS n, t.found_type AS kind
      FROM documents d JOIN ({_doc_type('text')}) t USING (doc_id) WHERE {_strip('text')} <> ''),
    mail AS MATERIALIZED ({thread_messages("SELECT filename, text FROM docs WHERE kind = 'email'")}),
    read AS MATERIALIZED ({dated('SELECT date_str FROM mail')}),
    days AS MATERIALIZED (SELECT DISTINCT filename, (wall || regexp_extract(date_str, 'T[0-9:]{{8}}([.][0-9]{{1,6}})', 1))::timestamp AS t FROM mail JOIN read USING (date_str) WHERE wall IS NOT NULL),
    quoted AS MATERIALIZED ({_QUOTED}),
    alike AS MATERIALIZED ({_alike("SELECT subject AS s FROM docs WHERE length(subject) > 3", 80)}),
    same AS MATERIALIZED (SELECT DISTINCT x.filename AS i, y.filename AS j FROM days x JOIN days y ON x.filename < y.filename AND x.t >= y.t AND x.t < y.t + INTERVAL 24 HOUR),
    shared AS MATERIALIZED (WITH e AS (SELECT filename, unnest(addresses) AS address FROM docs) SELECT x.filename AS i, y.filename AS j, count(*) AS common FROM e x JOIN e y ON x.address = y.address AND x.filename < y.filename GROUP BY ALL),
    flags AS (SELECT a.filename AS i, b.filename AS j, q.i IS NOT NULL AS quoted, CASE WHEN length(a.subject) > 3 AND a.subject = b.subject THEN 100.0 ELSE coalesce(l.ratio, 0) END AS alike,
        coalesce(abs(a.n - b.n) < 50, false) AS close, s.i IS NOT NULL AS day, coalesce(h.common, 0) AS common
      FROM docs a JOIN docs b ON a.filename < b.filename LEFT JOIN quoted q ON q.i = a.filename AND q.j = b.filename LEFT JOIN same s ON s.i = a.filename AND s.j = b.filename
      LEFT JOIN shared h ON h.i = a.filename AND h.j = b.filename LEFT JOIN alike l ON l.a = least(a.subject, b.subject) AND l.b = greatest(a.subject, b.subject)),
    scored AS MATERIALIZED (SELECT i, j, (CASE WHEN quoted THEN 60 ELSE 0 END + CASE WHEN alike > 95 THEN 50 WHEN alike > 80 THEN 25 ELSE 0 END + CASE WHEN close THEN 10 ELSE 0 END
        + CASE WHEN day AND close THEN 30 WHEN day THEN 5 ELSE 0 END + CASE WHEN common >= 2 THEN 20 WHEN common = 1 AND day THEN 10 ELSE 0 END)::int AS score,
        concat_ws('; ', CASE WHEN quoted THEN 'quoted text match' END, CASE WHEN alike > 95 THEN 'same subject' WHEN alike > 80 THEN 'similar subject' END, CASE WHEN close THEN 'close file numbers' END,
          CASE WHEN day AND close THEN 'same date' END, CASE WHEN common >= 2 THEN 'shared addresses' WHEN common = 1 AND day THEN 'shared address' END) AS why FROM flags)"""
_CLUSTERED = """links AS MATERIALIZED (SELECT i, j, score FROM scored WHERE score >= 30),
    nodes AS MATERIALIZED (SELECT node, row_number() OVER (ORDER BY node) AS p FROM (SELECT i AS node FROM links UNION SELECT j FROM links)),
    steps AS MATERIALIZED (SELECT row_number() OVER (ORDER BY score DESC, i DESC, j DESC) AS k, a.p AS a, b.p AS b, score FROM links JOIN nodes a ON a.node = i JOIN nodes b ON b.node = j),
    grow AS (SELECT 0::bigint AS k, (SELECT list(p ORDER BY p) FROM nodes) AS of
      UNION ALL
      SELECT s.k, CASE WHEN of[a] <> of[b] AND (score >= 70 OR len(list_filter(of, lambda x: x = of[a] OR x = of[b])) <= 15)
          THEN list_transform(of, lambda x: CASE WHEN x = greatest(of[a], of[b]) THEN least(of[a], of[b]) ELSE x END) ELSE of END FROM grow g JOIN steps s ON s.k = g.k + 1),
    clusters AS MATERIALIZED (WITH placed AS (SELECT node, (SELECT max_by(of, k) FROM grow)[p] AS root FROM nodes)
      SELECT p.node, n.node AS cluster, count(*) OVER (PARTITION BY root) AS size FROM placed p JOIN nodes n ON n.p = root)"""
_SHOWN = _clean_participant("SELECT DISTINCT source_file, unnest([sender, recipient]) AS p0 FROM messages")

ORACLES |= {
    "indel_ratio": f"""WITH p AS (SELECT DISTINCT subject, sender FROM messages), l AS ({_lcs("SELECT subject AS a, sender AS b FROM p WHERE subject IS NOT NULL AND sender IS NOT NULL")})
        SELECT subject, sender, CASE WHEN subject IS NULL OR sender IS NULL THEN 0.0::double WHEN length(subject) + length(sender) = 0 THEN 100.0::double ELSE round(200.0::double * lcs / (length(subject) + length(sender)), 6) END AS ratio
        FROM p LEFT JOIN l ON subject = a AND sender = b""",
    "subject_similarity": _alike(f"SELECT lower({_subject_norm('subject')}) AS s FROM messages WHERE length(lower({_subject_norm('subject')})) > 3", 80),
    "quoted_text_match": f"SELECT filename, count(*) AS n_links FROM (SELECT unnest([i, j]) AS filename FROM ({_QUOTED})) GROUP BY filename",
    "dedup_messages": f"SELECT thread, k AS msg_id FROM ({_dedup(f'SELECT DISTINCT {_subject_norm("subject")} AS thread, msg_id AS k, body FROM messages')})",
    "participant_collapse": f"""SELECT source_file, key, arg_min(shown, struct_pack(l := -length(shown), s := shown)) AS shown
        FROM (SELECT source_file, shown, CASE WHEN i <> '' THEN {_norm_email('i')} WHEN length(low) > 8 THEN low[1:5] || low[-3:] ELSE whole END AS key
          FROM (SELECT DISTINCT source_file, shown, regexp_extract(shown, '<([^>]+)>', 1) AS i, {_strip("split_part(regexp_replace(translate(lower(" + _strip('shown') + "), '\"''', ''), '\\s+', ' ', 'g'), '<', 1)")} AS low, regexp_replace(translate(lower({_strip('shown')}), '"''', ''), '\\s+', ' ', 'g') AS whole FROM ({_SHOWN}) WHERE shown <> ''))
        GROUP BY source_file, key""",
    "link_edges": f"WITH {_LINKED} SELECT i, j, score, CASE WHEN score >= 70 THEN 'high' WHEN score >= 40 THEN 'probable' ELSE 'low' END AS confidence, CASE WHEN why = '' THEN 'no link' ELSE why END AS reasons FROM scored WHERE score >= 30",
    "capped_clusters": f"WITH RECURSIVE {_LINKED}, {_CLUSTERED} SELECT node, cluster, size FROM clusters",
}


def _shown(x: str) -> str:
    p = _strip(f"coalesce({x}, '')")
    return f"CASE WHEN {p} = '' THEN '[Unknown]' WHEN {_strip(_drop(p, '<[^>]+>'))} = '' AND regexp_matches({p}, '<[^>]+>') THEN '[REDACTED]' ELSE {p} END"


def _message(number: str, source: bool) -> str:
    unknown = "[Unknown Sender]" if source else "[Unknown]"
    return f"""concat_ws(chr(10), '### Message ' || {number}, '- **From**: ' || CASE WHEN coalesce(sender, '') = '' THEN '{unknown}' ELSE {_shown('sender')} END,
        CASE WHEN coalesce(recipient, '') <> '' THEN '- **To**: ' || {_shown('recipient')} END, '- **Date**: ' || coalesce(strftime(wall::timestamp, '%B %d, %Y at %I:%M %p'), nullif(date_str, '')),
        {"'- **Source**: ' || filename" if source else 'NULL'}, '', nullif({_clean_message_body('body')}, ''), '', '---', '')"""


_PEOPLE = _clean_participant("SELECT cluster, participant AS p0 FROM people")
_TALKS = f"""multi AS MATERIALIZED (SELECT node AS filename, cluster FROM clusters WHERE size > 1),
    posts AS MATERIALIZED (SELECT m.*, r.wall, u.cluster, row_number() OVER (ORDER BY m.filename, msg_idx) AS k FROM mail m JOIN multi u USING (filename) LEFT JOIN read r USING (date_str)),
    kept AS MATERIALIZED (SELECT p.*, row_number() OVER (PARTITION BY cluster ORDER BY wall NULLS LAST, filename, msg_idx) AS number FROM posts p SEMI JOIN ({_dedup('SELECT cluster AS thread, k, body FROM posts')}) d ON p.k = d.k),
    people AS MATERIALIZED (SELECT DISTINCT cluster, participant FROM (SELECT cluster, sender AS participant FROM posts UNION ALL SELECT cluster, recipient FROM posts) WHERE participant <> ''),
    titles AS (SELECT cluster, mode(s ORDER BY s) AS subject FROM (SELECT cluster, {_subject_norm('raw_subject')} AS s FROM docs JOIN multi USING (filename) WHERE raw_subject <> '') GROUP BY cluster),
    means AS (SELECT a.cluster, avg(score) AS mean_score FROM scored JOIN multi a ON a.filename = i JOIN multi b ON b.filename = j AND a.cluster = b.cluster GROUP BY a.cluster),
    talks AS MATERIALIZED (SELECT row_number() OVER (ORDER BY date_min NULLS LAST, cluster) AS id, * FROM (
      SELECT c.cluster, c.documents, coalesce(subject, '') AS subject, date_min, date_max, coalesce(n_people, 0) AS n_people, mean_score, CASE WHEN mean_score >= 50 THEN 'high' ELSE 'probable' END AS confidence, coalesce(n_messages, 0) AS n_messages
      FROM (SELECT cluster, list(filename ORDER BY filename) AS documents FROM multi GROUP BY cluster) c LEFT JOIN titles USING (cluster) LEFT JOIN means USING (cluster)
      LEFT JOIN (SELECT cluster, min(wall)::timestamp AS date_min, max(wall)::timestamp AS date_max FROM posts GROUP BY cluster) USING (cluster) LEFT JOIN (SELECT cluster, count(*) AS n_people FROM people GROUP BY cluster) USING (cluster)
      LEFT JOIN (SELECT cluster, count(*) AS n_messages FROM kept GROUP BY cluster) USING (cluster))),
    alone AS MATERIALIZED (SELECT row_number() OVER (ORDER BY filename) AS id, * FROM docs ANTI JOIN multi USING (filename)),
    listed AS (SELECT cluster, string_agg('  - ' || p, chr(10) ORDER BY p) AS names FROM (SELECT DISTINCT cluster, regexp_replace({_shown('shown')}, {_lit('^["' + chr(39) + ']+|["' + chr(39) + ']+$')}, '', 'g') AS p FROM (
      SELECT cluster, key, arg_min(shown, struct_pack(l := -length(shown), s := shown)) AS shown FROM (SELECT cluster, shown, {{key}} AS key FROM (SELECT DISTINCT cluster, shown FROM ({_PEOPLE}) WHERE shown <> '')) GROUP BY cluster, key)) GROUP BY cluster)"""
_LOW = "regexp_replace(translate(lower(" + _strip("shown") + "), '\"''', ''), '\\s+', ' ', 'g')"
_NAME = _strip(f"split_part({_LOW}, '<', 1)")
_INSIDE = "regexp_extract(shown, '<([^>]+)>', 1)"
_KEY = f"CASE WHEN {_INSIDE} <> '' THEN {_norm_email(_INSIDE)} WHEN length({_NAME}) > 8 THEN ({_NAME})[1:5] || ({_NAME})[-3:] ELSE {_LOW} END"
_ALL = f"WITH RECURSIVE {_LINKED}, {_CLUSTERED}, {_TALKS.replace('{key}', _KEY)}"
_LISTED = "CASE WHEN len({x}) > 0 THEN '- **{t}**:' || chr(10) || array_to_string(list_transform(list_sort({x}), lambda v: '  - ' || v), chr(10)) END"

ORACLES |= {
    "conversation_confidence": f"{_ALL} SELECT id, cluster, len(documents)::int AS n_documents, subject, n_messages, mean_score, confidence FROM talks",
    "conversation_markdown": f"""{_ALL} SELECT id, 'conversation_' || printf('%03d', id) || '.md' AS name, concat_ws(chr(10), '# Conversation ' || printf('%03d', id), '', '## Metadata', '- **Original PDFs**: ' || array_to_string(documents, ', '), CASE WHEN subject <> '' THEN '- **Subject**: ' || subject END,
        CASE WHEN strftime(date_min, '%B %d, %Y') = strftime(date_max, '%B %d, %Y') THEN '- **Date**: ' || strftime(date_min, '%B %d, %Y') WHEN date_min IS NOT NULL THEN '- **Date Range**: ' || strftime(date_min, '%B %d, %Y') || ' to ' || strftime(date_max, '%B %d, %Y') END,
        CASE WHEN n_people > 0 THEN '- **Participants**:' END, names, '- **Link Confidence**: ' || confidence, '', '## Conversation Thread', '', thread) AS markdown
        FROM talks LEFT JOIN listed USING (cluster) LEFT JOIN (SELECT cluster, string_agg({_message('number', True)}, chr(10) ORDER BY number) AS thread FROM kept GROUP BY cluster) USING (cluster)""",
    "standalone_markdown": f"""{_ALL} SELECT id, 'standalone_' || printf('%03d', id) || '.md' AS name, concat_ws(chr(10), '# Standalone Document ' || printf('%03d', id), '', '## Metadata', '- **Original PDF**: ' || filename, '- **Document Type**: ' || kind, CASE WHEN raw_subject <> '' THEN '- **Subject**: ' || raw_subject END,
        {_LISTED.format(x="addresses", t="Email Addresses")}, {_LISTED.format(x="headed", t="Names Mentioned")}, '', '## Content', '', CASE WHEN kind = 'email' AND thread IS NOT NULL THEN thread ELSE {_clean_text('text')} END) AS markdown
        FROM (SELECT *, {_HEADED} AS headed FROM alone) LEFT JOIN (SELECT filename, string_agg({_message('(msg_idx + 1)', False)}, chr(10) ORDER BY msg_idx) AS thread FROM mail LEFT JOIN read USING (date_str) GROUP BY filename) USING (filename)""",
    "index_lines": f"""{_ALL} SELECT 0 AS part, (u - 1)::bigint AS id, ['# Archive Index', '', '## Summary', '', '- **Total Conversations**: ' || (SELECT count(*) FROM talks), '- **Standalone Documents**: ' || (SELECT count(*) FROM alone),
          '- **Total Output Files**: ' || ((SELECT count(*) FROM talks) + (SELECT count(*) FROM alone)), '', '## Conversations', '', '| ID | Subject | Files | Date Range | Participants | Confidence |', '|---|---|---|---|---|---|'][u] AS line FROM range(1, 13) t(u)
        UNION ALL SELECT 1, id, '| [' || printf('%03d', id) || '](conversation_' || printf('%03d', id) || '.md) | ' || CASE WHEN length(subject) > 50 THEN subject[1:50] || '...' ELSE subject END || ' | ' || len(documents) || ' | '
          || CASE WHEN date_min IS NULL THEN 'Unknown' ELSE strftime(date_min, '%Y-%m-%d') || CASE WHEN date_min <> date_max THEN ' to ' || strftime(date_max, '%Y-%m-%d') ELSE '' END END || ' | ' || n_people || ' | ' || confidence || ' |' FROM talks
        UNION ALL SELECT 2, u - 1, ['', '## Standalone Documents', '', 'Documents that could not be linked to any conversation thread:', ''][u] FROM range(1, 6) t(u)
        UNION ALL SELECT 3, id, '- [standalone_' || printf('%03d', id) || '.md](standalone_' || printf('%03d', id) || '.md)' FROM alone""",
}
_EVERY = thread_messages("SELECT filename, text FROM documents WHERE text IS NOT NULL")
_SENT = "SELECT DISTINCT msg_id, source_file, date_ts, date_str FROM messages"
ORACLES |= {
    "main_body": f"SELECT filename, body FROM ({_EVERY}) WHERE msg_idx = 0",
    "quoted_message": f"SELECT filename, sender, recipient, date_str, subject, body FROM ({_EVERY}) WHERE msg_idx = 1",
    "name_occurrences": f"SELECT unnest({_HEADED}) AS name, filename, len({_EMAILS})::bigint AS times FROM documents WHERE len({_EMAILS}) > 0",
    "sort_messages": f"""WITH s AS ({_SENT}), d AS ({dated(_SENT)}), t AS (SELECT msg_id, source_file, coalesce(date_ts, wall::timestamp) AS sent FROM s LEFT JOIN d USING (date_str))
        SELECT source_file, row_number() OVER (PARTITION BY source_file ORDER BY sent NULLS LAST, msg_id)::int AS number, msg_id, strftime(sent, '%Y-%m-%d %H:%M:%S') AS wall FROM t""",
    "dedup_containment": f"""WITH n AS (SELECT {_subject_norm('subject')} AS thread, msg_id, {_norm_body('body')} AS norm FROM messages), f AS (SELECT thread, norm, min(msg_id) AS msg_id FROM n WHERE length(norm) >= 10 AND thread IS NOT NULL GROUP BY thread, norm)
        SELECT a.thread, a.msg_id, count(*) AS n_holders FROM f a JOIN f b ON a.thread = b.thread AND a.norm <> b.norm AND length(a.norm) > 20 AND contains(b.norm, a.norm) GROUP BY a.thread, a.msg_id""",
    "summary_rows": "SELECT filename AS Filename, string_agg(DISTINCT keyword, ', ' ORDER BY keyword) AS Keywords FROM search_results WHERE keyword IS NOT NULL GROUP BY filename",
    "same_date_counts": """WITH m AS (SELECT DISTINCT folder, msg_id, date_ts FROM messages WHERE date_ts IS NOT NULL)
        SELECT a.folder, a.msg_id, a.date_ts, count(*) AS n_within_day FROM m a JOIN m b ON a.date_ts >= b.date_ts AND a.date_ts < b.date_ts + INTERVAL 24 HOUR AND (a.folder, a.msg_id, a.date_ts) <> (b.folder, b.msg_id, b.date_ts) GROUP BY ALL""",
}
