"""Newly written text of mail bodies: a recursive layout grammar.

A body is parsed line by line into a tree::

    mail      := part*
    part      := quote | inline | forward | closing | device | notice | furniture | text
    quote     := attribution blank* (prefixed+ | mail-to-the-end)
    prefixed  := line starting with > or |      its content, prefix taken off, is again a mail
    forward   := marker header-line* mail-to-the-end
    closing   := phrase blank* [rule] contact*  |  rule contact*  |  name contact*
    device    := "Sent from ..."
    notice    := (rule with mark | mark) blank* paragraph
    furniture := page number, stamp or running header of a scanned page

Only ``text`` nodes outside any quote or forward are serialised. Fixed phrases
are compared by their shape, in which letters that scanners confuse are one, and
with one typing slip allowed.

Defined results: null and empty bodies have no lines; a body of nothing but
quotes has no row; repeated deliveries count once; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from archivolt.llm.furniture import furniture_lines

# Phrases that close a mail, as single lines.
CLOSINGS = (
    "best regards", "kind regards", "warm regards", "regards", "thanks", "many thanks", "thanks and regards", "cheers", "best", "best wishes",
    "yours sincerely", "sincerely", "yours truly", "yours faithfully", "thank you", "cordialement", "bien cordialement", "bien à vous", "salutations",
    "mit freundlichen grüßen", "mit freundlichen grüssen", "viele grüße", "freundliche grüße", "beste grüße",
)
# Short whole answers, which look like a name or a header but are text.
ANSWERS = ("fyi", "ok", "okay", "yes", "no", "agreed", "noted", "done", "thanks", "received", "understood", "see below", "will do")

_DEVICE = re.compile(r"(?i)^(?:sent (?:from|using|via|with)|gesendet (?:von|mit)|envoyé (?:de|depuis|avec)|von mein\w+ \w+ gesendet)\b.{0,70}$")
_FORWARD = re.compile(r"(?i)^(?:-{2,} ?(?:original|forwarded) message ?-{2,}|begin forwarded message:|-{2,} ?(?:ursprüngliche|weitergeleitete) nachricht ?-{2,}|-{2,} ?message (?:d'origine|transféré) ?-{2,}|anfang der weitergeleiteten nachricht:|début du message (?:transféré|réexpédié) ?:)$")
_RULE_MARK = re.compile(r"^(?:_{5,}|\*{5,}|-{5,}|={5,}) ?\[?[A-Z0-9]{2,6}/[A-Z0-9]{2,6}\]?(?: ?[_*=-]*)$")
_BRACKET_MARK = re.compile(r"^\[[A-Z0-9]{2,6}/[A-Z0-9]{2,6}\] ")
_SIGN_RULE = re.compile(r"^(?:-- ?|_{6,31}|-{2,3})$")
_LONG_RULE = re.compile(r"^_{20,}$")
_HEADER = re.compile(r"(?i)^(?:from|fran|frorn|sent|date|to|cc|subject|von|gesendet|an|betreff|de|envoyé|à|objet) ?:")
_PREFIX = re.compile(r"^[>|] ?")
_LEAD = re.compile(r"^(?:On|0n|Am|Le|AM|LE|ON) ")
_ATTRIBUTION = (
    re.compile(r"(?i)^[O0]n (?=.*\d).{3,80}?, .{1,160}? ?wr?[o0ce]?[tf][ec]?[rt]?[e]?:$"),
    re.compile(r"(?i)^Am .*\d.* um .{3,12} [s5]chr[il1]e[bh]\b.{0,160}:$"),
    re.compile(r"(?i)^Le .*\d.*, .{1,160} a [éec]cr[il1]t ?:$"),
)
_NAME = re.compile(r"^(?:(?:Dr|Prof|Hon|Mrs?|Ms|Sir|Mme)\.? )?[A-ZÀ-ŽȘȚ][\w'’-]*\.?(?:,? +[A-ZÀ-ŽȘȚ][\w'’.-]*){0,3}$")
_NOTICE_START = re.compile(
    r"(?i)^(?:the information contained in this (?:communication|e-?mail|message)|this (?:message|e-?mail) (?:is meant|is intended|and any)|confidentiality notice|nothing in this e-?mail|please think before printing|ce message et ses annexes|diese (?:nachricht|e-?mail) enth|.{3,60} is registered in .{3,40}\. messages may be)"
)

_SHAPE = str.maketrans({"0": "o", "c": "o", "e": "o", "1": "l", "i": "l", "|": "l", "j": "l", "f": "t", "5": "s", "8": "b", "h": "b", "q": "g", "9": "g", "6": "b", "u": "n", "v": "y", "a": "o", "ß": "s"})


def shape(line: str) -> str:
    """A line in lower case with the letters that scanners confuse made one."""
    s = re.sub(r"[^\w ]+", "", line.lower()).strip()
    return s.replace("rn", "m").replace("ri", "n").replace("cl", "d").replace("ii", "u").translate(_SHAPE)


_CLOSING_SHAPES = {shape(p): len(p) for p in CLOSINGS}
_ANSWER_SHAPES = {shape(p) for p in ANSWERS}


def _one_slip(a: str, b: str) -> bool:
    """Equal but for one letter left out, put in, changed, or two swapped."""
    if a == b:
        return True
    if abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    x, y = a[i:], b[i:]
    return x[1:] == y or x == y[1:] or x[1:] == y[1:] or (len(x) > 1 and len(y) > 1 and x[0] == y[1] and x[1] == y[0] and x[2:] == y[2:])


def is_closing(line: str) -> bool:
    if len(line) > 30 or line.endswith((".", "?", "!")):
        return False
    s = shape(line)
    return s in _CLOSING_SHAPES or any(n > 7 and _one_slip(s, p) for p, n in _CLOSING_SHAPES.items())


@dataclass
class Node:
    kind: str
    lines: list[int] = field(default_factory=list)
    children: list[Node] = field(default_factory=list)


class _Parser:
    """One body; ``rows`` are (line number, content without prefixes at this depth)."""

    def __init__(self, rows: list[tuple[int, str]], depth: int = 0):
        self.rows, self.depth, self.i = rows, depth, 0

    def text_at(self, k: int) -> str | None:
        return self.rows[k][1] if k < len(self.rows) else None

    def blank(self, k: int) -> bool:
        return k < len(self.rows) and not self.rows[k][1].strip()

    def skip_blank(self, k: int) -> int:
        while self.blank(k):
            k += 1
        return k

    def take(self, kind: str, end: int, children: list[Node] | None = None) -> Node:
        node = Node(kind, [n for n, _ in self.rows[self.i : end]], children or [])
        self.i = end
        return node

    # what begins at row k

    def attribution(self, k: int) -> int:
        """The row after a reply header that begins at k, else 0."""
        first = self.text_at(k)
        if first is None or not _LEAD.match(first):
            return 0
        joined = ""
        for end in range(k, min(k + 5, len(self.rows))):
            line = self.rows[end][1].strip()
            if not line:
                break
            joined = f"{joined} {line}" if joined else line
            if line.endswith(":") and any(p.match(joined) for p in _ATTRIBUTION):
                return end + 1
        return 0

    def forward(self, k: int) -> bool:
        line = self.text_at(k)
        if line is None:
            return False
        line = line.strip()
        if _FORWARD.match(line) or (line[:1] == "-" and _FORWARD.match(line.replace("0", "O").replace("1", "l"))):
            return True
        if _LONG_RULE.match(line):
            after = self.text_at(self.skip_blank(k + 1))
            return bool(after and _HEADER.match(after))
        return bool(re.match(r"(?i)^(?:from|von|de) ?:", line)) and sum(bool(_HEADER.match(self.text_at(j) or "")) for j in range(k, k + 4)) >= 3

    def notice(self, k: int) -> bool:
        line = (self.text_at(k) or "").strip()
        return bool(_RULE_MARK.match(line) or _BRACKET_MARK.match(line) or _NOTICE_START.match(line))

    def starts_other(self, k: int) -> bool:
        line = self.text_at(k)
        return line is None or bool(_PREFIX.match(line)) or self.forward(k) or self.notice(k) or bool(_DEVICE.match(line.strip())) or bool(self.attribution(k))

    def name_block(self, k: int) -> bool:
        """A paragraph of a name and contact lines without a closing phrase before it."""
        line = (self.text_at(k) or "").strip()
        if (k and not self.blank(k - 1)) or len(line) > 45 or shape(line) in _ANSWER_SHAPES:
            return False
        end = k
        while end < len(self.rows) and not self.blank(end) and not self.starts_other(end):
            end += 1
        block = [self.rows[j][1].strip() for j in range(k, end)]
        if any(len(x) > 60 or re.search(r"[.?!:;]$", x) and not re.search(r"\b[A-Z]\.$|Tr\.$|Co\.$|Ltd\.$|Fdn\.$|L\.L\.C\.$|L\.P\.$|Inc\.$|Gmbh\.$|GmbH\.$", x) for x in block):
            return False
        if not _NAME.match(line):
            return len(block) > 1 and line == line.lower() and bool(re.match(r"^[^\W\d_]+(?: [^\W\d_]+){1,3}$", line)) and any(_contact(x) for x in block[1:])
        if len(block) > 1:
            return all(len(x.split()) <= 7 for x in block)
        return self.starts_other(self.skip_blank(end)) or self.skip_blank(end) >= len(self.rows)

    # the parts

    def parse(self) -> list[Node]:
        out: list[Node] = []
        while self.i < len(self.rows):
            out.append(self.part())
        return out

    def part(self) -> Node:
        i, line = self.i, self.rows[self.i][1]
        stripped = line.strip()
        if not stripped:
            return self.take("blank", i + 1)
        if _PREFIX.match(line):
            return self.prefixed()
        if (i == 0 or self.blank(i - 1) or _PREFIX.match(self.rows[i - 1][1])) and (end := self.attribution(i)):
            after = self.skip_blank(end)
            if after < len(self.rows) and not _PREFIX.match(self.rows[after][1]):
                return self.rest("quote", end)
            return self.take("quote", end)
        if self.forward(i):
            return self.rest("forward", i + 1)
        if self.notice(i):
            end = i + 1
            if _RULE_MARK.match(stripped):
                end = self.skip_blank(end)
            while end < len(self.rows) and not self.blank(end) and not _PREFIX.match(self.rows[end][1]) and not self.forward(end):
                end += 1
            return self.take("notice", end)
        if _DEVICE.match(stripped):
            return self.take("device", i + 1)
        if is_closing(stripped) or (_SIGN_RULE.match(stripped) and not self.forward(i)):
            return self.closing()
        if self.name_block(i):
            return self.take("closing", self.contacts(i))
        return self.take("text", i + 1)

    def contacts(self, k: int) -> int:
        while k < len(self.rows) and not self.blank(k) and not self.starts_other(k):
            k += 1
        return k

    def closing(self) -> Node:
        k = self.i + 1
        if not _SIGN_RULE.match(self.rows[self.i][1].strip()):
            rule = self.skip_blank(k)
            after = self.text_at(rule)
            if after is not None and _SIGN_RULE.match(after.strip()):
                k = rule + 1
            elif rule > k and after is not None and self.name_block(rule):
                k = rule
        return self.take("closing", self.contacts(k))

    def prefixed(self) -> Node:
        """Consecutive prefixed lines; what they hold is parsed again one level down."""
        end, inner = self.i, []
        while end < len(self.rows) and _PREFIX.match(self.rows[end][1]):
            n, content = self.rows[end]
            inner.append((n, _PREFIX.sub("", content, count=1)))
            end += 1
        # deep nesting is a quote all the same
        children = _Parser(inner, self.depth + 1).parse() if self.depth < 20 else []
        return self.take("quote", end, children)

    def rest(self, kind: str, start: int) -> Node:
        """Everything to the end belongs to the earlier mail, which is parsed as one."""
        children = _Parser(self.rows[start:], self.depth + 1).parse() if self.depth < 20 else []
        return self.take(kind, len(self.rows), children)


def _contact(line: str) -> bool:
    return bool(re.search(r"@|\d{3}", line)) or bool(re.match(r"^(?:M|T|Tel|Ph|Fax|Mob)\b[.:]", line))


def parse_mail(body: str | None) -> list[Node]:
    """The layout tree of a body; line numbers start at 1."""
    if not body:
        return []
    lines = body.split("\n")
    gone = furniture_lines(lines)
    rows, top = [], []
    skip_gap = False
    for n, line in enumerate(lines, 1):
        if n - 1 in gone:
            top.append(Node("furniture", [n]))
            skip_gap = gone[n - 1] == "header"
            continue
        # the empty line under a running header belongs to the page break, unless a sentence ended before it
        if skip_gap and not line.strip() and rows and not re.search(r"[.?!:]$", rows[-1][1].strip()):
            skip_gap = False
            continue
        skip_gap = False
        rows.append((n, line))
    return [*_Parser(rows).parse(), *top]


def authored_lines(body: str | None) -> list[int]:
    """Numbers of the non-blank lines that the sender newly wrote."""
    return sorted(n for node in parse_mail(body) if node.kind == "text" for n in node.lines)


def _per_message(messages: DataFrame, body: str, schema: str, rows) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield rows(batch)

    return messages.select("msg_id", F.col(body).alias("body")).mapInPandas(run, schema)


def new_lines(messages: DataFrame, body: str = "body") -> DataFrame:
    """``msg_id, line_no`` of every newly written line."""

    def rows(batch: pd.DataFrame) -> pd.DataFrame:
        out = [(m, n) for m, b in zip(batch["msg_id"], batch["body"], strict=True) for n in authored_lines(b)]
        return pd.DataFrame(out, columns=["msg_id", "line_no"])

    return _per_message(messages, body, "msg_id bigint, line_no int", rows).distinct()


def without_headers(raw: str | None) -> str | None:
    """A complete mail without the block of header lines at its top; a header's further lines are indented."""
    if not raw:
        return raw
    lines = raw.split("\n")
    k = 0
    while k < len(lines) and (_HEADER.match(lines[k]) or (k and lines[k][:1] in " \t" and lines[k].strip())):
        k += 1
    return "\n".join(lines[k:])


def new_text(messages: DataFrame, body: str = "body", headed: bool = False) -> DataFrame:
    """``msg_id, new_text, kept_lines, dropped_lines``; one row a message, empty text where nothing is new.

    With ``headed`` the text is a complete mail, whose own headers go first; a mail cut short is read as far as it goes.
    """

    def rows(batch: pd.DataFrame) -> pd.DataFrame:
        out = []
        for m, b in zip(batch["msg_id"], batch["body"], strict=True):
            b = without_headers(b) if headed else b
            lines = (b or "").split("\n")
            keep = set(authored_lines(b))
            text = "\n".join(x if i in keep else "" for i, x in enumerate(lines, 1))
            out.append((m, re.sub(r"\n{3,}", "\n\n", text).strip(), len(keep), sum(bool(x.strip()) for x in lines) - len(keep)))
        return pd.DataFrame(out, columns=["msg_id", "new_text", "kept_lines", "dropped_lines"])

    return _per_message(messages, body, "msg_id bigint, new_text string, kept_lines int, dropped_lines int", rows).dropDuplicates(["msg_id"])
