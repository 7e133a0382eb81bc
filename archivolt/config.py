"""Settings of the archive operators. Everything here is a default that a caller can replace.

Names of real persons and mailboxes belong to a caller's configuration; the
defaults are empty.
"""

from __future__ import annotations

from dataclasses import dataclass

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

# What is removed from a body for display, in this order (^ and $ at lines), and whether case is ignored.
BODY_JUNK = (
    (r"^To:.*$", True),
    (r"^From:.*$", True),
    (r"^Fran:.*$", True),
    (r"^Sent:?.*$", True),
    (r"^Subject:.*$", True),
    (r"^Date:.*$", True),
    (r"^[Ii]?lane-Images:.*$", False),
    (r"^\d{4,}_\d+.*jpg.*$", True),
    (r"^\d+\s+\d+;\s+\d+\s+\d+:\d+_\w+\.?jpg.*$", True),
    (r"^\d{4,}\s+\d+;\s+\d+\s+\d+:\d+_njpg.*$", True),
    (r"^\s*\d{5,}\s*$", False),
    (r"EFTA_R\d+_\d+\s*", False),
    (r"EFTA\d{8,}\s*", False),
    (r"(?:^>?\s*[w*]{5,}\s*\n)?(?:^>?\s*)*The information contained in this communication is[\s\S]*?(?:including all attachments|all copies thereof|attachments)\s*\.?", True),
    (r"^>\s*[w*]+\s*$", False),
)
# The notice that names an owner, and the notices after it.
BODY_OWNER = r"(?:^>?\s*)*(?:It is the )?property of\s*\n?(?:^>?\s*)*\Q{owner}\E[\s\S]*?(?:attachments\.?|thereof[,.])"
BODY_NOTICES = (
    (r"(?:^>?\s*)*and may be unlawful[\s\S]*?attachments\.?", True),
    (r"(?:^>?\s*)*confidential,?\s*may be attorney-client privileged[\s\S]*?addressee\.?", True),
    (r"(?:^>?\s*)*If you have received this[\s\S]*?(?:attachments\.?|thereof[,.])", True),
)


@dataclass(frozen=True)
class Settings:
    """Thresholds and lists. The defaults reproduce the archive's own rules."""

    context_chars: int = 50
    text_chars_per_page: int = 50
    link_threshold: int = 30
    cluster_cap: int = 15
    cap_free_score: int = 70
    chunk: int = 100
    stride: int = 50
    ordinal_gap: int = 50
    ignored_addresses: tuple[str, ...] = ()
    known_names: tuple[str, ...] = ()
    owner_names: tuple[str, ...] = ()
    mailboxes: tuple[str, ...] = ()
    retry_base_seconds: float = 2.0
    max_attempts: int = 3
    default_date: str = "2000-01-01"


DEFAULTS = Settings()
