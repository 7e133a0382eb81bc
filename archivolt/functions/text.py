"""Text functions on columns: JVM expressions only, so plans keep their generated code.

Patterns follow one dialect: ``(?d)`` so that only a line feed ends a line,
``(?U)`` for Unicode classes and word boundaries, ``(?u)`` with ``(?i)``.
Null gives null everywhere; the empty string stays empty.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import cache, reduce
from itertools import groupby
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from archivolt.config import ADDRESS_REPAIRS, BODY_JUNK, BODY_NOTICES, BODY_OWNER, DATE_REPAIRS, DEFAULTS, JUNK_PATTERNS, TYPE_INDICATORS


#: What ``(?U)\\s`` means.
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
#: Pieces in lower case of which each junk pattern but the last needs one. None has s, k or i, as other letters count as those without case.
JUNK_PIECES = ("on conta", "*****", "unauthor", "copyr", "ent from", "rma ", "mmg mat", "efta", "<?xml", "<!doctype")
_HEADS, _PICTURES, _NOTICES = ("to:", "from:", "fran:"), ("lane-", "jpg"), ("may be unla", "may be attorney-cl", "you have rece")
#: The same for the patterns of a body and, from the sixteenth on, the notices; none where a pattern has no such piece.
BODY_PIECES = (_HEADS, _HEADS, _HEADS, (), ("ubject:", "date:"), ("ubject:", "date:"), *(_PICTURES,) * 4, (), ("efta",), ("efta",), ("on conta",), (">",), *(_NOTICES,) * 3)


def strip(c: Column) -> Column:
    """Unicode white space off both ends (``trim`` without a list knows only the blank)."""
    return F.btrim(c, F.lit(WHITE))


def once(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once, however often it is mentioned."""
    return F.get(F.transform(F.array(value), lambda v: use(v)), F.lit(0))


def where_piece(c: Column, pieces: tuple[str, ...], change) -> Column:
    """``change(c)`` where the lower-case text holds one of the pieces that the change needs, else ``c``: looking for them is far cheaper than a pattern."""
    some = lambda low: reduce(or_, (F.contains(low, F.lit(p)) for p in pieces))
    return once(c, lambda v: F.when(once(F.lower(v), some), change(v)).otherwise(v))


@cache
def _fold_table() -> tuple[str, str]:
    """Characters that lose their marks to one other, then the marks themselves, which vanish."""
    source, target, gone = [], [], []
    for code in range(0x80, sys.maxunicode + 1):
        ch = chr(code)
        if unicodedata.category(ch) == "Cs":
            continue
        if unicodedata.category(ch) == "Mn":
            gone.append(ch)
            continue
        plain = "".join(x for x in unicodedata.normalize("NFD", ch) if unicodedata.category(x) != "Mn")
        if plain != ch and len(plain) == 1:
            source.append(ch)
            target.append(plain)
    return "".join(source + gone), "".join(target)


def fold(c: Column) -> Column:
    """No diacritics, lower case. Characters whose decomposition is longer than one (Hangul) stay as they are."""
    source, target = _fold_table()
    # most text is plain: the table is only walked where a character beyond ASCII occurs
    return F.lower(F.when(c.rlike(r"[^\x00-\x7F]"), F.translate(c, source, target)).otherwise(c))


def clean_text(c: Column) -> Column:
    """Junk out in the order of the list, runs of blanks to one, ends stripped; null to the empty string."""
    drop = lambda v, patterns: reduce(lambda x, p: F.regexp_replace(x, "(?dimuU)" + p, ""), patterns, v)
    out = where_piece(F.coalesce(c, F.lit("")), JUNK_PIECES, lambda v: drop(v, JUNK_PATTERNS[:-1]))
    out = drop(out, JUNK_PATTERNS[-1:])
    # a single blank stays as it is
    return strip(F.regexp_replace(F.regexp_replace(out, r"[ \t]{2,}|\t", " "), r"\n{3,}", "\n\n"))


def clean_for_matching(c: Column) -> Column:
    """The text that is compared between documents: no notices, rules, file marks, device or header lines."""

    def marks(v: Column) -> Column:
        v = F.regexp_replace(v, r"(?iuU)The information contained in this communication[\s\S]*?all attachments\.?", "")
        v = F.regexp_replace(v, r"\*{5,}[\s\S]*?\*{5,}", "")
        v = F.regexp_replace(v, r"(?U)EFTA\w*\d+", "")
        return F.regexp_replace(v, r"(?iuU)Sent from my \w+", "")

    out = where_piece(c, ("on conta", "*****", "efta", "ent from"), marks)
    return F.regexp_replace(out, r"(?dimuU)^(To|From|Sent|Subject|Date):.*$", "")


def normalize_email(c: Column, repairs: tuple[tuple[str, str], ...] = ADDRESS_REPAIRS, mailboxes: tuple[str, ...] = DEFAULTS.mailboxes) -> Column:
    """Lower case, ends stripped, scanner slips set right in order (a repaired ``x@agmail.com`` keeps its two signs).

    Of each of the caller's ``mailboxes`` (local parts such as ``jane-holiday``: a short name, a hyphen, the rest) damaged forms are set right: the
    rest before the sign, and at most four letters before it that begin like the name.
    """
    out = strip(F.lower(c))
    for was, now in repairs:
        out = F.replace(out, F.lit(was), F.lit(now))
    for box in mailboxes:
        name, _, rest = box.partition("-")
        head = F.substring_index(out, f"{rest}@", 1)
        damaged = F.contains(out, F.lit(f"{rest}@")) & out.startswith(name[:1]) & (F.length(head) <= 4)
        out = F.when(damaged, F.concat(F.lit(f"{name}{rest}@"), F.substring_index(out, f"{rest}@", -1))).otherwise(out)
    return out


def extract_emails(c: Column) -> Column:
    """Distinct normalised addresses of a text, sorted."""
    # tried only where a word begins or a match has ended; what stands before the sign is never given back
    found = F.regexp_extract_all(c, F.lit(r"(?iuU)(?:\G|(?<![\w.\-®]))[\w.\-®]++@[\w.-]+\.\w+"), F.lit(0))
    return F.array_sort(F.array_distinct(F.transform(found, lambda e: normalize_email(e))))


def fix_date_ocr(c: Column) -> Column:
    for pattern, now, exact in DATE_REPAIRS:
        c = F.regexp_replace(c, ("(?U)" if exact else "(?iuU)") + pattern, now)
    return c


def headers(c: Column) -> dict[str, Column]:
    """``to, from, sent, subject`` of the first ten lines; the empty string where a header is missing.

    An empty header takes the next line, as the white space after its colon may hold the line feed.
    """
    top = F.substring_index(c, "\n", 10)
    patterns = {"to": r"^To:\s*(.+?)(?:\n|$)", "from": r"^From:\s*(.+?)(?:\n|$)", "sent": r"^(?:Sent|Date)[:\s]+(.+?)(?:\n|$)", "subject": r"^Subject:\s*(.+?)(?:\n|$)"}
    return {k: strip(F.regexp_extract(top, "(?dimuU)" + p, 1)) for k, p in patterns.items()}


def extract_names(c: Column, known: tuple[str, ...] = DEFAULTS.known_names) -> Column:
    """Configured names that occur in any case, and capitalised names before a bracketed address; sorted, distinct."""
    listed = F.filter(F.array(*(F.lit(n) for n in known)).cast("array<string>"), lambda n: F.contains(F.lower(c), F.lower(n)))
    headed = F.regexp_extract_all(c, F.lit(r"([A-Z][a-z]+(?:\s+[A-Z][a-z]+)+)\s*<"), F.lit(1))
    return F.array_sort(F.array_union(listed, headed))


def document_type(c: Column) -> Column:
    """The type with most indicators in the text, at least two; the earlier type wins a tie."""

    def ranked(low: Column) -> Column:
        # one number holds score and precedence: the larger score first, then the earlier type
        scores = [sum((F.contains(low, F.lit(w)).cast("int") for w in ws), F.lit(0)) for ws in TYPE_INDICATORS.values()]
        return F.greatest(*(s * 10 + (len(scores) - i) for i, s in enumerate(scores)))

    def named(rank: Column) -> Column:
        pick = F.lit("other")
        for i, kind in enumerate(TYPE_INDICATORS):
            pick = F.when((rank >= 20) & (rank % 10 == len(TYPE_INDICATORS) - i), kind).otherwise(pick)
        return pick

    return once(once(F.lower(F.coalesce(c, F.lit(""))), ranked), named)


def clean_message_body(c: Column, owners: tuple[str, ...] = DEFAULTS.owner_names) -> Column:
    """A message body for display: junk, doubled headers, picture names, numbers and notices removed."""
    out = clean_text(c)
    owned = [BODY_OWNER.replace("{owner}", owner) for owner in owners]
    steps = [("(?dimuU)" if fold else "(?dmU)") + p for p, fold in (*BODY_JUNK, *((p, True) for p in owned), *BODY_NOTICES)]
    # neighbours with the same need are tried together
    for pieces, few in groupby(zip((*BODY_PIECES[: len(BODY_JUNK)], *(("property of",) for _ in owned), *BODY_PIECES[len(BODY_JUNK) :]), steps, strict=True), key=lambda x: x[0]):
        drop = lambda v, few=[p for _, p in few]: reduce(lambda x, p: F.regexp_replace(x, p, ""), few, v)
        out = where_piece(out, pieces, drop) if pieces else drop(out)
    return strip(F.regexp_replace(out, r"\n{3,}", "\n\n"))


def normalize_body(c: Column) -> Column:
    """The form in which message bodies are compared: no quote marks, attributions or punctuation; one case, single blanks."""
    out = strip(F.coalesce(c, F.lit("")))
    out = F.regexp_replace(out, r"(?dmU)^>+\s*", "")
    out = where_piece(out, ("wrote:",), lambda v: F.regexp_replace(v, r"(?isuU)On\s+[\w,\s]+\d{4}.*?wrote:", ""))
    out = F.regexp_replace(out, r"(?dimuU)^Subject\s*:?\s*Re:?\s*", "")
    out = F.lower(strip(F.regexp_replace(out, r"(?U)\s+", " ")))
    return F.regexp_replace(out, r"(?U)[^\w\s]", "")


def subject_norm(c: Column) -> Column:
    return strip(F.regexp_replace(c, r"(?iuU)^(Re:\s*)+", ""))


def file_ordinal(c: Column) -> Column:
    """The number in a file's mark, null without one or beyond the range of a long."""
    return F.nullif(F.regexp_extract(c, r"EFTA(\d+)", 1), F.lit("")).try_cast("bigint")


def clean_participant(c: Column) -> Column:
    """``name <address>``, an address or a short name; the empty string for what is none of these."""
    p = strip(F.coalesce(c, F.lit("")))
    bracket = r"(?U)[<\[(]([^>\])]+@[^>\])]+)[>\])]"
    inside = F.regexp_extract(p, bracket, 1)
    name = F.regexp_replace(strip(F.regexp_replace(p, r"(?sU)[<\[(].*", "")), r"(?U)^On.*?,\s*", "")
    address = F.regexp_extract(p, r"(?U)[\w.\-]+@[\w.\-]+\.\w+", 0)
    rejected = F.contains(F.lower(p), F.lit("wrote:")) | (F.length(p) > 80) | p.startswith("On ") | p.startswith("I ") | p.startswith("i ") | F.contains(p, F.lit("Sent from")) | p.startswith("ein(") | p.startswith("eini") | p.startswith("• ")
    named = (name != "") & (F.length(name) < 40) & ~name.startswith("On ")
    plain = (F.length(p) < 40) & ~p.rlike(r"[:@><\n(]") & ~p.rlike(r"(?U)^[\d.\s]+$")
    return (
        F.when((p == "") | rejected, "")
        .when(inside != "", F.when(named, F.concat(name, F.lit(" <"), normalize_email(inside), F.lit(">"))).otherwise(normalize_email(inside)))
        .when(address != "", normalize_email(address))
        .when(plain, p)
        .otherwise("")
    )


def participant_key(cleaned: Column) -> Column:
    """What spellings of one participant share: the address, else the first five and last three letters of a longer name."""
    key = F.regexp_replace(F.regexp_replace(F.lower(strip(cleaned)), "[\"']", ""), r"(?U)\s+", " ")
    inside = F.regexp_extract(cleaned, "<([^>]+)>", 1)
    name = strip(F.substring_index(key, "<", 1))
    short = F.when(F.length(name) > 8, F.concat(F.substring(name, 1, 5), F.right(name, F.lit(3)))).otherwise(key)
    return F.when(inside != "", normalize_email(inside)).otherwise(short)


def display_participant(c: Column, resolved: Column | None = None) -> Column:
    """A participant as printed; an address without a name shows what a curated map gives, else ``[REDACTED]``."""
    p = strip(F.coalesce(c, F.lit("")))
    bare = strip(F.regexp_replace(p, "<[^>]+>", ""))
    hidden = F.coalesce(resolved, F.lit("[REDACTED]")) if resolved is not None else F.lit("[REDACTED]")
    return F.when(p == "", "[Unknown]").when((bare == "") & p.rlike("<[^>]+>"), hidden).otherwise(p)


def duration(seconds: Column) -> Column:
    """``Ns`` under a minute, ``Mm Ss`` under an hour, else ``Hh Mm``."""
    s = seconds.cast("double")
    whole = F.floor(s)
    return (
        F.when(s < 60, F.concat(F.bround(s, 0).cast("int").cast("string"), F.lit("s")))
        .when(s < 3600, F.format_string("%dm %ds", F.floor(whole / 60), whole % 60))
        .otherwise(F.format_string("%dh %dm", F.floor(whole / 3600), F.floor((whole % 3600) / 60)))
    )


def ellipsis(c: Column, n: int) -> Column:
    return F.when(F.length(c) > n, F.concat(F.substring(c, 1, n), F.lit("..."))).otherwise(c)
