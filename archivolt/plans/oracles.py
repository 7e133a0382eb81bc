"""SQL for DuckDB that gives the same rows as the core queries, over the same whole tables."""

from __future__ import annotations

# The fixed values are stated here once more, so that a wrong one in the library shows.
# Patterns of junk in extracted page text, removed in this order (ignoring case, ^ and $ at lines).
JUNK_PATTERNS = (
    r"(?:^>?\s*\*{5,}\s*\n)?(?:^>?\s*)?The information contained in this communication is[\s\S]*?(?:including all attachments|all copies thereof)[\s\S]*?(?:attachments\.?|thereof[,.])",
    r"(?:^>?\s*)?The information contained in this communication[\s\S]*?destroy this communication[\s\S]*?attachments\.?",
    r"\*{10,}[\s\S]*?The information contained in this communication is[\s\S]*?all rights reserved[\s\S]*?\*{5,}",
    r"\*{10,}[\s\S]*?confidential[\s\S]*?attachments[\s\S]*?\*{5,}",
    r"Unauthorized use,?\s*disc[\s\S]*?prohibited",
    r"copyright\s*-?\s*all rights reserved",
    r"(?:^>\s*)+\*{5,}[\s\S]*?(?:^>\s*)+attachments\.?",
    r"(?:^>\s*w{5,}\*{5,}[\s\S]*?)(?=\n(?!>)|$)",
    r"Sent from my iP(?:hone|od|ad)",
    r"Sent from Samsung Mobile",
    r"Sent from my BlackBerry",
    r"Sent from (?:a )?Samsung (?:device|Galaxy)",
    r"Sent from Samaung Malib",
    r"Sent Irma Sainting.*",
    r"Sag from Si mmg Mat",
    r"EFTA_R\d+_\d+",
    r"EFTA\d{8,}(?:\s|$)",
    r"<\?xml[\s\S]*?\?>",
    r"<!DOCTYPE[\s\S]*?>",
    r"\*{5,}",
    r"\n{3,}",
)
# Indicator substrings of the document types, in order of precedence.
TYPE_INDICATORS = {
    "email": ("to:", "from:", "sent:", "subject:", "wrote:", "re:"),
    "interview": ("q:", "a:", "question:", "answer:", "interview", "deposition"),
    "financial": ("account", "balance", "transaction", "payment", "invoice", "$", "usd"),
    "article": ("article", "news", "published", "reporter", "newspaper"),
}
# Repairs of dates read by a scanner, in this order: pattern, replacement, whether case counts.
DATE_REPAIRS = (
    (r"([A-Za-z]{3,})\s+([Il])\s*,", "$1 1,", True),
    (r"([A-Za-z]{3,})\s+([Il])(\s|$)", "$1 1$3", True),
    (r"(\d)O", "$10", True),
    (r"O(\d)", "0$1", True),
    (r"(\d{3})S(\s|$|,)", "$15$2", True),
    (r"(\d{2})B(\d)", "$18$2", True),
    (r"\blan\b", "Jan", False),
    (r"\bJari\b", "Jan", False),
    (r"\bMar\s*ch\b", "March", False),
    (r"\bApr\s*il\b", "April", False),
    (r"\bJuiy\b", "July", False),
    (r"\bAugust\b", "August", False),
    (r"\bSept\b", "Sep", False),
    (r"\bNov\s*ember\b", "November", False),
    (r"\bDec\s*ember\b", "December", False),
    (r"(\d{1,2});(\d{2})\s*(AM|PM|am|pm)", "$1:$2 $3", True),
    (r"(\d{1,2}):\s+(\d{2})", "$1:$2", True),
    (r"\bl(\d:\d{2})", "1$1", True),
)
# Literal repairs of mail addresses read by a scanner, in this order, after lower case.
ADDRESS_REPAIRS = (("agmail", "@gmail"), ("egmail", "@gmail"), ("@ernail", "@email"), ("@grnail", "@gmail"), ("®", "@"))

_W = r"\p{L}\p{M}\p{Nd}\p{Pc}"


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^[\\s\\p{{Z}}]+|[\\s\\p{{Z}}]+$', '', 'g')"


def _replace_all(x: str, pattern: str, now: str = "", flags: str = "g") -> str:
    return f"regexp_replace({x}, {_lit(pattern)}, {_lit(now)}, '{flags}')"


def _norm_email(x: str) -> str:
    out = _strip(f"lower({x})")
    for was, now in ADDRESS_REPAIRS:
        out = f"replace({out}, {_lit(was)}, {_lit(now)})"
    return out


def _clean_for_matching(x: str) -> str:
    out = _replace_all(x, r"(?is)The information contained in this communication.*?all attachments\.?")
    out = _replace_all(out, r"(?s)\*{5,}.*?\*{5,}")
    out = _replace_all(out, rf"EFTA[{_W}]*\d+")
    out = _replace_all(out, rf"(?i)Sent from my [{_W}]+")
    return _replace_all(out, r"(?im)^(To|From|Sent|Subject|Date):.*$")


def _fix_date(x: str) -> str:
    for pattern, now, exact in DATE_REPAIRS:
        x = _replace_all(x, ("" if exact else "(?i)") + pattern, now.replace("$", "\\"))
    return x


def _doc_type(x: str) -> str:
    scores = {k: " + ".join(f"(contains(lower({x}), {_lit(w)}))::int" for w in ws) for k, ws in TYPE_INDICATORS.items()}
    ranked = "greatest(" + ", ".join(f"({s}) * 10 + {len(scores) - i}" for i, s in enumerate(scores.values())) + ")"
    cases = " ".join(f"WHEN r % 10 = {len(scores) - i} THEN '{k}'" for i, k in enumerate(scores))
    return f"SELECT doc_id, CASE WHEN r < 20 THEN 'other' {cases} END AS found_type FROM (SELECT doc_id, {ranked} AS r FROM documents)"


def _subject_norm(x: str) -> str:
    return _strip(_replace_all(x, r"(?i)^(Re:\s*)+"))


def _norm_body(x: str) -> str:
    out = _strip(f"coalesce({x}, '')")
    out = _replace_all(out, r"(?m)^>+\s*")
    out = _replace_all(out, rf"(?is)On\s+[{_W},\s]+\d{{4}}.*?wrote:")
    out = _replace_all(out, r"(?im)^Subject\s*:?\s*Re:?\s*")
    out = f"lower({_strip(_replace_all(out, r'[\s\p{Z}]+', ' '))})"
    return _replace_all(out, rf"[^{_W}\s]")


def _clean_text(x: str) -> str:
    out = f"coalesce({x}, '')"
    for pattern in JUNK_PATTERNS:
        # the one lookahead ends at the first line end in any case, which a plain pattern says too
        out = _replace_all(out, "(?im)" + pattern.replace(r"[\s\S]*?)(?=\n(?!>)|$)", ".*)"))
    return _strip(_replace_all(_replace_all(out, r"[ \t]+", " "), r"\n{3,}", "\n\n"))


def _clean_message_body(x: str) -> str:
    out = _clean_text(x)
    for head in ("To:", "From:", "Fran:", "Sent:?", "Subject:", "Date:"):
        out = _replace_all(out, f"(?im)^{head}.*$")
    for pattern in (
        r"(?m)^[Ii]?lane-Images:.*$", r"(?im)^\d{4,}_\d+.*jpg.*$", rf"(?im)^\d+\s+\d+;\s+\d+\s+\d+:\d+_[{_W}]+\.?jpg.*$", r"(?im)^\d{4,}\s+\d+;\s+\d+\s+\d+:\d+_njpg.*$",
        r"(?m)^\s*\d{5,}\s*$", r"EFTA_R\d+_\d+\s*", r"EFTA\d{8,}\s*",
        r"(?im)(?:^>?\s*[w*]{5,}\s*\n)?(?:^>?\s*)*The information contained in this communication is[\s\S]*?(?:including all attachments|all copies thereof|attachments)\s*\.?",
        r"(?m)^>\s*[w*]+\s*$", r"(?im)(?:^>?\s*)*and may be unlawful[\s\S]*?attachments\.?",
        r"(?im)(?:^>?\s*)*confidential,?\s*may be attorney-client privileged[\s\S]*?addressee\.?", r"(?im)(?:^>?\s*)*If you have received this[\s\S]*?(?:attachments\.?|thereof[,.])",
    ):
        out = _replace_all(out, pattern)
    return _strip(_replace_all(out, r"\n{3,}", "\n\n"))


_PARTICIPANT = rf"""SELECT sender, CASE
    WHEN p = '' OR contains(lower(p), 'wrote:') OR length(p) > 80 OR starts_with(p, 'On ') OR starts_with(p, 'I ') OR starts_with(p, 'i ') OR contains(p, 'Sent from') OR starts_with(p, 'ein(') OR starts_with(p, 'eini') OR starts_with(p, '• ') THEN ''
    WHEN inside <> '' THEN CASE WHEN name <> '' AND length(name) < 40 AND NOT starts_with(name, 'On ') THEN name || ' <' || {_norm_email('inside')} || '>' ELSE {_norm_email('inside')} END
    WHEN address <> '' THEN {_norm_email('address')}
    WHEN length(p) < 40 AND NOT regexp_matches(p, '[:@><\n(]') AND NOT regexp_matches(p, '^[\d.\s]+$') THEN p ELSE '' END AS cleaned
  FROM (SELECT sender, p, regexp_extract(p, '[<\[(]([^>\])]+@[^>\])]+)[>\])]', 1) AS inside, regexp_extract(p, '[{_W}.\-]+@[{_W}.\-]+\.[{_W}]+') AS address,
        regexp_replace({_strip(r"regexp_replace(p, '(?s)[<\[(].*', '', 'g')")}, '^On.*?,\s*', '') AS name
        FROM (SELECT DISTINCT sender, {_strip("coalesce(sender, '')")} AS p FROM messages))"""
_KEYWORDS = f"SELECT ord, lower({_strip('keyword')}) AS keyword FROM keywords WHERE {_strip('keyword')} <> ''"
_PARTS = f"""
  SELECT d.folder, d.filename, 1 AS page, k.ord, k.keyword, d.text, length(k.folded) AS step,
         string_split_regex(d.folded, '\\b' || regexp_escape(k.folded) || '\\b') AS parts
  FROM (SELECT folder, filename, text, lower(strip_accents(text)) AS folded FROM documents) d,
       (SELECT ord, keyword, lower(strip_accents(keyword)) AS folded FROM ({_KEYWORDS})) k
  WHERE contains(d.folded, k.folded)"""
_COUNTS = f"SELECT folder, filename, page, ord, keyword, len(parts) - 1 AS n FROM ({_PARTS}) WHERE len(parts) > 1"
_STARTS = f"""
  SELECT folder, filename, page, ord, keyword, text, step,
         (list_sum(list_transform(parts[1:i], lambda p: length(p))) + (i - 1) * step)::int AS start
  FROM (SELECT *, unnest(range(1, len(parts))) AS i FROM ({_PARTS}) WHERE len(parts) > 1)"""
_EMAILS = f"list_sort(list_distinct(list_transform(regexp_extract_all(text, '(?i)[{_W}.\\-®]+@[{_W}.\\-]+\\.[{_W}]+'), lambda e: {_norm_email('e')})))"
_HEADED = r"list_distinct(regexp_extract_all(text, '([A-Z][a-z]+(?:\s+[A-Z][a-z]+)+)\s*<', 1))"
_TOP = "array_to_string(string_split(text, chr(10))[1:10], chr(10))"


def _header(pattern: str) -> str:
    return _strip(f"regexp_extract({_TOP}, {_lit('(?im)' + pattern)}, 1)")


def _moment(x: str, pattern: str) -> str:
    return f"strftime({x}, '{pattern}')"


_CHUNKED = f"""
  SELECT doc_id, c, generate_series(0, greatest(ceil((length(c) - 100) / 50.0), 0)::int - 1) AS starts FROM (SELECT doc_id, {_clean_for_matching('text')} AS c FROM documents)"""

ORACLES: dict[str, str] = {
    "keyword_load": _KEYWORDS,
    "fold_text": "SELECT doc_id, lower(strip_accents(text)) AS folded FROM documents",
    "keyword_hits": _COUNTS,
    "keyword_context": f"""SELECT folder, filename, page, ord, keyword, start,
        CASE WHEN lo > 0 THEN '...' ELSE '' END || {_strip("replace(substring(text, lo + 1, hi - lo), chr(10), ' ')")} || CASE WHEN hi < length(text) THEN '...' ELSE '' END AS context
        FROM (SELECT *, greatest(0, start - 50) AS lo, least(length(text), start + step + 50) AS hi FROM ({_STARTS}))""",
    "hits_by_keyword": f"SELECT keyword, sum(n)::bigint AS n FROM ({_COUNTS}) GROUP BY keyword",
    "hits_by_folder": f"SELECT folder, sum(n)::bigint AS n FROM ({_COUNTS}) GROUP BY folder",
    "hits_grouping_sets": f"SELECT keyword, folder, sum(n)::bigint AS n FROM ({_COUNTS}) GROUP BY GROUPING SETS ((keyword), (folder))",
    "file_keywords": f"SELECT filename, string_agg(DISTINCT keyword, ', ' ORDER BY keyword) AS keywords FROM ({_COUNTS}) GROUP BY filename",
    "scan_totals": f"SELECT sum(n)::bigint AS matches, count(DISTINCT (folder, filename)) AS files_matched, (SELECT count(DISTINCT (folder, filename)) FROM documents) AS files FROM ({_COUNTS})",
    "matched_files": "SELECT DISTINCT s.folder, s.filename, s.folder || '_' || s.filename AS target FROM search_results s WHERE EXISTS (SELECT 1 FROM documents d WHERE d.folder = s.folder AND d.filename = s.filename)",
    "result_file_keywords": "SELECT filename, string_agg(DISTINCT keyword, ', ' ORDER BY keyword) AS keywords FROM search_results WHERE keyword IS NOT NULL GROUP BY filename",
    "recent_matches_topk": "SELECT hit_id, filename, keyword, found_at FROM search_results ORDER BY found_at DESC, hit_id DESC LIMIT 10",
    "file_id_semijoin": "SELECT DISTINCT filename FROM search_results WHERE filename IN (SELECT filename FROM documents)",
    "needs_ocr": f"""SELECT filename, len(p)::int AS n_pages, NOT (list_sum(list_transform(p, lambda x: length({_strip('x')}))) > 180 * len(p)) AS needs_ocr
        FROM (SELECT filename, string_split(text, chr(10) || chr(10)) AS p FROM documents)""",
    "hits_by_day": "SELECT date_trunc('day', found_at)::timestamp AS day, keyword, count(*) AS n FROM search_results GROUP BY 1, 2",
    "html_link_extract": r"""SELECT DISTINCT CASE WHEN regexp_extract(folder, '(\d+)', 1) <> '' THEN 'DS-' || regexp_extract(folder, '(\d+)', 1) ELSE 'Unknown' END AS folder, keyword, trim(filename) AS filename, page, trim(coalesce(context, '')) AS context, pdf_url FROM crawl_results""",
    "folder_from_heading": r"""SELECT DISTINCT filename, heading, CASE WHEN regexp_extract(heading, 'DataSet\s+(\d+)', 1) <> '' THEN 'DS-' || regexp_extract(heading, 'DataSet\s+(\d+)', 1) ELSE 'Unknown' END AS folder
        FROM (SELECT filename, filename || ' - DataSet ' || regexp_replace(folder, '^DS-', '') AS heading FROM crawl_results)""",
    "pagination_math": """SELECT keyword, CASE WHEN n % 5 > 0 THEN 'Showing 1 to ' || (n % 7 + 4) || ' of ' || n || ' Results' ELSE '' END AS label, n AS results,
        CASE WHEN n % 5 > 0 THEN (n + (n % 7 + 4) - 1) // (n % 7 + 4) ELSE 1 END AS pages
        FROM (SELECT keyword, count(*) AS n FROM crawl_results WHERE keyword IS NOT NULL GROUP BY keyword)""",
    "pdf_magic_filter": "SELECT filename, (9 + strlen(filename))::int AS n_bytes FROM documents WHERE doc_id % 3 <> 0",
    "crawl_dedup": """SELECT keyword, filename, page, folder, pdf_url, fetched FROM (SELECT keyword, filename, page, folder, pdf_url, strftime(fetched_at, '%Y-%m-%d %H:%M:%S') AS fetched,
        row_number() OVER (PARTITION BY keyword, filename ORDER BY page, folder, pdf_url, fetched_at) AS r FROM crawl_results) WHERE r = 1""",
    "download_plan": "SELECT filename, min(pdf_url) AS pdf_url, CASE WHEN filename IN (SELECT filename FROM documents WHERE page_count = 1) THEN 'skipped' ELSE 'wanted' END AS status FROM crawl_results GROUP BY filename",
    "download_counts": """SELECT count(*) FILTER (WHERE NOT there AND length(url) > 0) AS downloaded, count(*) FILTER (WHERE there) AS skipped, count(*) FILTER (WHERE NOT there AND NOT length(url) > 0) AS failed
        FROM (SELECT filename, min(pdf_url) AS url, filename IN (SELECT filename FROM documents WHERE page_count = 1) AS there FROM crawl_results GROUP BY filename)""",
    "crawl_page_totals": "SELECT keyword, count(*) AS hits, count(DISTINCT page) AS pages, max(page) AS last_page FROM crawl_results GROUP BY keyword",
    "extract_emails": f"SELECT doc_id, array_to_string({_EMAILS}, ' ') AS emails FROM documents",
    "normalize_email": f"SELECT DISTINCT sender, {_norm_email('sender')} AS normal FROM messages",
    "extract_names": f"""SELECT doc_id, array_to_string(list_sort(list_distinct(list_concat(list_filter(['William Keldiford', 'Legal Services'], lambda n: contains(lower(text), lower(n))), {_HEADED}))), '|') AS found FROM documents""",
    "header_fields": f"SELECT doc_id, {_header(r'^To:\s*(.+?)(?:\n|$)')} AS h_to, {_header(r'^From:\s*(.+?)(?:\n|$)')} AS h_from, {_header(r'^(?:Sent|Date)[:\s]+(.+?)(?:\n|$)')} AS h_sent, {_header(r'^Subject:\s*(.+?)(?:\n|$)')} AS h_subject FROM documents",
    "doc_type": _doc_type("text"),
    "doc_type_counts": f"SELECT found_type, count(*) AS n FROM ({_doc_type('text')}) GROUP BY found_type",
    "clean_text": f"SELECT doc_id, {_clean_text('text')} AS cleaned FROM documents",
    "clean_message_body": f"SELECT DISTINCT msg_id, {_clean_message_body('body')} AS cleaned FROM messages",
    "clean_participant": _PARTICIPANT,
    "clean_for_matching": f"SELECT doc_id, {_clean_for_matching('text')} AS cleaned FROM documents",
    "fix_date_ocr": f"SELECT DISTINCT date_str, {_fix_date('date_str')} AS fixed FROM messages",
    "normalize_body": f"SELECT DISTINCT msg_id, {_norm_body('body')} AS norm FROM messages",
    "subject_norm": f"SELECT DISTINCT subject, {_subject_norm('subject')} AS norm FROM messages",
    "format_time": """SELECT doc_id, CASE WHEN s < 60 THEN s || 's' WHEN s < 3600 THEN (s // 60) || 'm ' || (s % 60) || 's' ELSE (s // 3600) || 'h ' || (s % 3600 // 60) || 'm' END AS shown FROM (SELECT doc_id, n_chars * 4 AS s FROM documents)""",
    "render_dates": f"SELECT DISTINCT msg_id, {_moment('date_ts', '%B %d, %Y')} AS day, {_moment('date_ts', '%B %d, %Y at %I:%M %p')} AS moment FROM messages WHERE date_ts IS NOT NULL",
    "name_email_pairs": f"""SELECT lower(email) AS email, name, count(DISTINCT filename) AS n_documents FROM (SELECT filename, email, unnest(names) AS name FROM (SELECT filename, unnest({_EMAILS}) AS email, {_HEADED} AS names FROM documents)) GROUP BY 1, 2""",
    "ordinal_band_join": r"""WITH f AS (SELECT filename, try_cast(regexp_extract(filename, 'EFTA(\d+)', 1) AS bigint) AS n FROM documents)
        SELECT a.filename AS i, count(*) AS n_close, max(b.filename) AS last_close FROM f a JOIN f b ON abs(a.n - b.n) < 50 AND a.filename < b.filename GROUP BY a.filename""",
    "same_date_interval_join": """WITH m AS (SELECT DISTINCT folder, msg_id, date_ts FROM messages WHERE date_ts IS NOT NULL),
        e AS (SELECT folder, unnest([min(date_ts), max(date_ts)]) AS t FROM m GROUP BY folder)
        SELECT e.folder AS edge_folder, count(*) AS n_within_day FROM m JOIN e ON m.date_ts >= e.t AND m.date_ts < e.t + INTERVAL 24 HOUR GROUP BY e.folder""",
    "shared_email_overlap": f"""WITH e AS (SELECT doc_id, unnest({_EMAILS}) AS email FROM documents)
        SELECT doc_id, count(*) AS n_shared FROM e WHERE email IN (SELECT email FROM e GROUP BY email HAVING count(*) > 1) GROUP BY doc_id""",
    "chunk_shingles": f"""SELECT doc_id, len(list_filter(list_transform(starts, lambda i: substring(c, (i * 50 + 1)::bigint, 100)), lambda x: length({_strip('x')}) >= 80 AND length(regexp_replace(x, '[^\\p{{L}}]', '', 'g')) >= 40))::int AS n_chunks FROM ({_CHUNKED})""",
    "link_confidence": "SELECT s AS score, CASE WHEN s >= 70 THEN 'high' WHEN s >= 40 THEN 'probable' ELSE 'low' END AS confidence FROM range(0, 175, 5) t(s)",
    "doc_components": f"""WITH n AS (SELECT filename, lower({_subject_norm('subject')}) AS s FROM documents)
        SELECT filename AS node, min(filename) OVER (PARTITION BY s) AS root FROM n WHERE length(s) > 3 QUALIFY count(*) OVER (PARTITION BY s) > 1""",
    "dedup_exact": f"""SELECT DISTINCT folder, min(msg_id) AS msg_id FROM (SELECT folder, msg_id, {_norm_body('body')} AS norm FROM messages) WHERE length(norm) >= 10 GROUP BY folder, norm""",
    "message_numbering": "SELECT source_file, row_number() OVER (PARTITION BY source_file ORDER BY date_ts ASC NULLS LAST, msg_id)::int AS number, msg_id FROM (SELECT DISTINCT msg_id, source_file, date_ts FROM messages)",
    "conversation_subject": f"""SELECT source_file, mode(s ORDER BY s) AS subject FROM (SELECT DISTINCT ON (msg_id, source_file, subject) source_file, {_subject_norm('subject')} AS s FROM messages WHERE subject <> '') GROUP BY source_file""",
    "conversation_date_range": "SELECT source_file, min(date_ts) AS date_min, max(date_ts) AS date_max FROM messages GROUP BY source_file",
    "conversation_participants": "SELECT source_file, string_agg(DISTINCT p, '|' ORDER BY p) AS participants FROM (SELECT source_file, unnest([sender, recipient]) AS p FROM messages) WHERE p <> '' GROUP BY source_file",
    "conversation_numbering": "SELECT row_number() OVER (ORDER BY a ASC NULLS LAST, source_file) AS id, source_file FROM (SELECT source_file, min(date_ts) AS a FROM messages GROUP BY source_file)",
    "index_rows": r"""SELECT id, '| [' || n || '](conversation_' || n || '.md) | ' || CASE WHEN length(s) > 50 THEN s[1:50] || '...' ELSE s END || ' | ' || docs || ' | ' || CASE WHEN a IS NULL THEN 'Unknown' ELSE strftime(a, '%Y-%m-%d') || CASE WHEN b <> a THEN ' to ' || strftime(b, '%Y-%m-%d') ELSE '' END END || ' | ' || people || ' | ' || CASE WHEN people * 30 >= 70 THEN 'high' WHEN people * 30 >= 40 THEN 'probable' ELSE 'low' END || ' |' AS line
        FROM (SELECT regexp_extract(source_file, 'EFTA(\d+)', 1)::bigint AS id, printf('%03d', regexp_extract(source_file, 'EFTA(\d+)', 1)::bigint) AS n, min(subject) AS s, count(DISTINCT folder) AS docs, count(DISTINCT sender) AS people, min(date_ts) AS a, max(date_ts) AS b FROM messages GROUP BY source_file)""",
}
