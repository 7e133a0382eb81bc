"""Personal information in free text: candidates, boosted trees, typed placeholders.

Generators propose overlapping spans with high recall: persons' names around
words that the archive's own name fields hold, mail addresses, phone and identity
numbers, street and box addresses. Boosted trees score each span by its form
and its surroundings; a threshold calibrated on held-out spans accepts it, and
of overlapping spans the best is kept; trees decide every kind. Labels for names are the documents' own ``names``
(a bounded sample, ``TRAINING_DOCUMENTS``); numbers, mail and street addresses are learnt
from made-up texts whose truth is known (``pii_samples``). A record's own ``names`` play no part in finding. The
statistics of name words cover all documents and messages, every word that is used twice. The ``CACHE_WORDS`` most frequent
ones are broadcast; of further ones a record gets by a keyed join those that its text holds.

Defined results: null and empty texts hold nothing; a value found twice in a
record is one row; repeated deliveries count once; texts of any length are read
whole. Extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from archivolt.llm import pii_samples
from archivolt.llm.boosting import BoostedTrees
from archivolt.runtime import materialize

TRAINING_DOCUMENTS = 1500
#: Made-up samples of each of numbers, mail and street addresses.
TRAINING_SAMPLES = 6000
#: Most name words whose counts are broadcast.
CACHE_WORDS = 300_000
KINDS = ("name", "email", "phone", "idno", "address")
# Words of organisations, and titles before names.
ORG_WORDS = frozenset(
    "ltd limited llc l.l.c lp l.p llp inc incorporated co company corp gmbh ag sa plc trust tr tr. fund foundation fdn partners ptnrs holdings hldgs capital cap shipping aviation legal services serv group bank office bros associates consulting logistics".split()
)
TITLES = frozenset("dr prof hon mr mrs ms sir mme rev capt".split())
_NOT_NAMES = frozenset(
    "the a an and or of in on at to for with from by as is was were be been has had have if it its their our my your he she they we you this that these those there both neither nor every please note once could nobody without according dear hello hi thanks regards best kind many cheers yours sincerely sent subject date re fwd fw cc attention tel ext page file mail call project invoice docket passport keys wire der die das ein eine wir und nach ohne le la les un une chaque selon nous monday tuesday wednesday thursday friday saturday sunday january february march april may june july august september october november december am um schrieb wrote said gave".split()
)

_TOKEN = re.compile(r"[^\W\d_][^\W_]*(?:['’-][^\W\d_][^\W_]*)*")
_GAP = re.compile(r"(?:[ \t]+|[ \t]*\n(?:[>|] ?)*[ \t]*)$")
_DIGITS = re.compile(r"(?<![\w+])(?:\+\d{1,3}[ \-.]?)?(?:\(\d{2,5}\)[ \-.]?)?\d[\d\-. \n]{3,}\d(?!\w)(?:,? ?(?:ext|x|extension)\.? ?\d{1,6})?")
_IDENT = re.compile(r"(?<![\w-])(?:[A-Z]{1,3}\d{6,9}|[A-Z]{2}[ \n]?\d\d[ \n]?\d\d[ \n]?\d\d[ \n]?[A-Z])(?![\w-])")
_PHONE_FORMS = (
    re.compile(r"^\+\d{1,3}(?:[ \-.]?\(?\d{1,5}\)?){2,6}$"),
    re.compile(r"^(?:1[-. ])?\(\d{3}\)[ \-.]?\d{3}[-. ]\d{4}$"),
    re.compile(r"^(?:1[-. ])?\d{3}([-. ])\d{3}\1\d{4}$"),
    re.compile(r"^0\d{1,4}(?:[ \-.]\d{2,5}){2,4}$"),
)
_ID_FORMS = (re.compile(r"^\d{3}[- ]\d{2}[- ]\d{4}$"), re.compile(r"^\d{13}$"), re.compile(r"^\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{4}$"), re.compile(r"^[A-Z]{1,3}\d{6,9}$"), re.compile(r"^[A-Z]{2} ?\d\d ?\d\d ?\d\d ?[A-Z]$"))
_DATE = re.compile(r"^(?:\d{1,2}([.\- ])\d{1,2}\1(?:19|20)\d\d|(?:19|20)\d\d([.\- ]?)\d\d\2\d\d)$")
_EXT = re.compile(r",? ?(?:ext|x|extension)\.? ?\d{1,6}$")
_W = r"(?:[ \t]+|[ \t]*\n(?:[>|] ?)*)"
_TOWN = r"[^\W\d_a-z][^\W\d_]+(?:-[^\W\d_]+)*"
_FLAT = rf"(?:(?:Apt|APT|Flat|FLAT|Unit|UNIT|Suite|SUITE)\.?{_W}\d+[A-Za-z]?,{_W})?"
_ROAD = r"(?:Street|St|Road|Rd|Lane|Ln|Avenue|Ave|Court|Ct|Terrace|Ter|Drive|Dr|Place|Pl|Square|Sq|Way|Row|Close|Boulevard|Blvd|Crescent|Hill|Gardens|Walk)"
_END = rf",{_W}(?:\d{{4,6}}{_W})?{_TOWN}(?:{_W}\d{{4,6}}(?![\w-]))?"
#: Street addresses by where the number stands, each tried only where its own sign occurs.
_NUMBER_FIRST = re.compile(
    rf"[\dAFUS](?<![\w-].)(?:(?<=\d)|(?<=[AFUS])(?:pt|PT|lat|LAT|nit|NIT|uite|UITE)\.?{_W}\d+[A-Za-z]?,{_W}\d)\d{{0,4}}[A-Za-z]?{_W}(?:(?:[^\W\d_a-z][\w'’-]*{_W}){{1,3}}(?:{_ROAD}|{_ROAD.upper()})\b\.?"
    rf"|(?:rue|RUE|avenue|AVENUE|place|PLACE|chemin|boulevard){_W}(?:(?:du|de|des|la|le|DU|DE|DES|LA|LE){_W}|de{_W}la{_W}|[dDlL]['’])*[^\W\d_][\w'’-]*)" + _END
)
_NUMBER_LAST = re.compile(rf"(?<![\w-]){_FLAT}[^\W\d_a-z][\w-]*(?:straße|strasse|STRASSE|STRAßE|weg|allee|platz|gasse){_W}\d{{1,5}}[a-z]?" + _END)
_BOX = re.compile(rf"(?<![\w-])P\.? ?O\.?(?:{_W})?(?:Box|BOX){_W}\d+" + _END)
_MAIL_LEFT, _MAIL_RIGHT = re.compile(r"[\w.+-]"), re.compile(r"[\w-]+(?:\.[\w-]+)+")
_NUMERIC = re.compile(r"[+(\d][\d\-. ()\n]{4,}\d")
_SPELT = re.compile(r"[\w.+-]+ ?[(\[{] ?at ?[)\]}] ?[\w-]+(?:(?:\.| dot | ?[(\[{] ?dot ?[)\]}] ?)[\w-]+)+|[\w.+-]+ at [\w-]+(?: dot [\w-]+)+", re.I)

# Words that announce a personal number, and words that announce another kind of number.
_PERSONAL = frozenset("id identity passport card ssn social security national holder personal".split())
_OTHER = frozenset("lot invoice inv docket account ending ref reference batch file box item drawing version phase row shelf tray sent date order total usd eur gbp bates no page".split())
_MONTHS = frozenset("january february march april may june july august september october november december".split())
_CALL = frozenset("phone tel call mobile m t fax ph cell kept at ring reach or".split())


@dataclass
class Lexicon:
    """Counts of words in person and organisation names: (given, family, organisation)."""

    counts: dict[str, tuple[int, int, int]]
    memo: dict[str, int] = field(default_factory=dict)

    def kind(self, token: str) -> int:
        """0 nothing, 1 in persons' names, 2 an organisation's word, 3 a title."""
        got = self.memo.get(token)
        if got is None:
            if len(self.memo) > 500_000:
                self.memo.clear()
            low = token.lower()
            g, f, o = self.counts.get(low, (0, 0, 0))
            got = 3 if low in TITLES else 2 if low in ORG_WORDS else 1 if g + f > o and g + f > 1 and low not in _NOT_NAMES else 0
            self.memo[token] = got
        return got


def split_name(name: str) -> tuple[list[str], list[str], bool]:
    """(given words, family words, is an organisation) of a name as written."""
    words = [w for w in re.split(r"[\s]+", name.strip()) if w]
    bare = [w.strip(".,\"'").lower() for w in words]
    if any(b in ORG_WORDS for b in bare[1:]) or not words:
        return [], [], True
    keep = [(w, b) for w, b in zip(words, bare, strict=True) if b and b not in TITLES and len(b) > 1]
    if len(keep) < 1:
        return [], [], False
    if any(w.endswith(",") for w in words[:-1]):
        return [b for _, b in keep[1:]], [keep[0][1]], False
    upper = [w.isupper() and len(w) > 2 for w, _ in keep]
    if len(keep) > 1 and upper[0] and not upper[-1]:
        return [b for _, b in keep[1:]], [keep[0][1]], False
    if len(words) > 1 and len(keep) == 1:
        return [], [keep[0][1]], False
    return [b for _, b in keep[:-1]], [keep[-1][1]], False


def name_words(names: DataFrame) -> tuple[Lexicon, DataFrame | None]:
    """The lexicon of a column ``name`` (all spellings, with their repetitions): its ``CACHE_WORDS`` most frequent words, and a table ``w, g, f, o`` of the rest if there is any."""

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for n, times in zip(batch["name"], batch["times"], strict=True):
                given, family, org = split_name(n)
                words = [w.strip(".,\"'").lower() for w in n.split()] if org else []
                rows.extend((w, times, 0, 0) for w in given)
                rows.extend((w, 0, times, 0) for w in family)
                rows.extend((w, 0, 0, times) for w in words if w)
            yield pd.DataFrame(rows, columns=["w", "g", "f", "o"])

    spelt = names.where("name is not null and trim(name) <> '' and not name like '%@%'").groupBy("name").agg(F.count("*").alias("times"))
    words = spelt.mapInPandas(split, "w string, g bigint, f bigint, o bigint").groupBy("w").agg(F.sum("g").alias("g"), F.sum("f").alias("f"), F.sum("o").alias("o"))
    words = materialize(words.withColumn("n", F.col("g") + F.col("f") + F.col("o")).where("n > 1"), "namewords")
    # how many words are used how often: few rows, as counts repeat
    least, held = 1, 0
    for r in words.groupBy("n").agg(F.count("*").alias("k")).orderBy(F.desc("n")).toLocalIterator():
        held += r.k
        if held > CACHE_WORDS:
            least = r.n + 1
            break
    rows = words.where(F.col("n") >= least).toPandas()
    counts = {w: (int(g), int(f), int(o)) for w, g, f, o in rows[["w", "g", "f", "o"]].itertuples(index=False)}
    return Lexicon(counts), words.where(F.col("n") < least).drop("n") if least > 1 else None


def looked_up(records: DataFrame, lexicon: Lexicon, rest: DataFrame) -> DataFrame:
    """``records`` with ``extra``: the counts from ``rest`` of the words that a record's text holds."""
    shared = records.sparkSession.sparkContext.broadcast(lexicon.counts)

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = shared.value
        for batch in batches:
            rows = [(rec, i, w) for rec, i, text in zip(batch["rec"], batch["id"], batch["text"], strict=True) if text for w in {t.lower() for t in _TOKEN.findall(text)} if w not in known]
            yield pd.DataFrame(rows, columns=["rec", "id", "w"])

    asked = records.select("rec", "id", "text").mapInPandas(ask, "rec string, id bigint, w string").distinct()
    extra = asked.join(rest, "w").groupBy("rec", "id").agg(F.map_from_entries(F.collect_list(F.struct("w", F.array("g", "f", "o").alias("c")))).alias("extra"))
    return records.join(extra, ["rec", "id"], "left")


def _gap_ok(text: str, a: int, b: int) -> bool:
    return b > a and bool(_GAP.match(text, a, b)) and text.count("\n", a, b) < 2


def name_spans(text: str, lexicon: Lexicon) -> list[tuple[int, int, list[str]]]:
    """Overlapping candidate spans of persons' names with their words."""
    kind = lexicon.kind
    found = list(_TOKEN.finditer(text))
    get = lexicon.memo.get
    hits = [i for i, m in enumerate(found) if (kind(m[0]) if (k := get(m[0])) is None else k) == 1]
    tokens: dict[int, tuple[int, int, str]] = {}
    for h in hits:
        for i in range(max(0, h - 3), min(len(found), h + 4)):
            if i not in tokens:
                tokens[i] = (*found[i].span(), found[i][0])
    out: dict[tuple[int, int], list[str]] = {}
    n = len(found)

    def add(i: int, j: int) -> None:
        """The span of tokens i..j, with a title before it and an initial's period after it."""
        s, e = tokens[i][0], tokens[j][1]
        if len(tokens[j][2]) == 1 and text[e : e + 1] == ".":
            e += 1
        if i and kind(found[i - 1][0]) == 3 and re.fullmatch(rf"\.?{_W}", text[found[i - 1].end() : s]):
            s = found[i - 1].start()
        out[s, e] = [tokens[k][2] for k in range(i, j + 1)]

    def joint(i: int) -> str:
        """How tokens i and i+1 hang together: '' not, ' ' blank, '.' after an initial, ',' comma."""
        if i + 1 >= n:
            return ""
        a, b = tokens[i][1], tokens[i + 1][0]
        if b - a > 8:
            return ""
        if text[a] == ",":
            return "," if _gap_ok(text, a + 1, b) else ""
        if text[a] == ".":
            return "." if len(tokens[i][2]) == 1 and _gap_ok(text, a + 1, b) else ""
        return " " if _gap_ok(text, a, b) else ""

    def part(i: int) -> bool:
        w = tokens[i][2]
        if len(w) == 1:
            return w.isupper()
        k = kind(w)
        return k == 1 or (k == 0 and w[0].isupper() and w.lower() not in _NOT_NAMES)

    for h in hits:
        # Given [I.] Family, FAMILY Given, I. Family: the hit is the first, middle or last word
        for i in range(max(0, h - 2), h + 1):
            for j in range(max(h, i + 1), min(n, i + 3)):
                links = [joint(k) for k in range(i, j)]
                if "" in links or "," in links[1:] or not all(part(k) for k in range(i, j + 1)):
                    continue
                if links[0] == "," and j - i > 1 and len(tokens[j][2]) > 1:
                    continue
                if j - i == 2 and links[0] != "," and len(tokens[i + 1][2]) > 1 and len(tokens[j][2]) > 1:
                    continue  # two words and an initial at most
                if sum(len(tokens[k][2]) > 1 for k in range(i, j + 1)) < 1:
                    continue
                add(i, j)
    return [(s, e, w) for (s, e), w in out.items()]


def _words_before(text: str, s: int, n: int = 4) -> list[str]:
    return [w.lower() for w in re.findall(r"[^\W\d_]+", text[max(0, s - 45) : s])[-n:]]


def _words_after(text: str, e: int, n: int = 3) -> list[str]:
    return [w.lower() for w in re.findall(r"[^\W\d_]+", text[e : e + 35])[:n]]


def name_features(text: str, s: int, e: int, words: list[str], lexicon: Lexicon) -> list[float]:
    shown = text[s:e]
    c = lexicon.counts
    long = [w for w in words if len(w) > 1 and w.lower() not in TITLES]
    first, last = (long[0].lower(), long[-1].lower()) if long else ("", "")
    comma = "," in shown
    g1, f1, o1 = c.get(first, (0, 0, 0))
    g2, f2, o2 = c.get(last, (0, 0, 0))
    given, family = ((g2, f1) if comma else (g1, f2))
    after, before = _words_after(text, e, 2), _words_before(text, s, 2)
    tail = text[e : e + 1]
    near = bool(re.match(rf"{_W}|,{_W}", text[e : e + 6]))
    lg = lambda v: math.log1p(v)
    unknown = sum(w.lower() not in c for w in long)
    return [
        len(long), float(len(words) > len(long)), float(comma), lg(given), lg(family), lg(f1 if not comma else f2), lg(g2 if not comma else g1), lg(o1), lg(o2), float(unknown),
        float(shown.isupper()), float(shown.islower()), float(sum(w.isupper() for w in long) == 1 and len(long) > 1), float(bool(after) and near and after[0] in ORG_WORDS),
        float(bool(before) and (before[-1] in ("the", "a", "an", "near", "in", "from", "at"))), float(bool(before) and lexicon.kind(before[-1]) == 1 and bool(re.search(r"[\w.] $", text[max(0, s - 2) : s]))),
        float(bool(after) and near and tail != "," and lexicon.kind(after[0]) == 1), float("\n" in shown), float(any(w.lower() in ORG_WORDS for w in words)), float(tail == "@" or text[s - 1 : s] == "@"), float(len(long) == 1),
    ]


def number_spans(text: str) -> list[tuple[int, int]]:
    out = []
    spans = [m.span() for m in _NUMERIC.finditer(text)]
    matches = [m for s, e in spans for m in _DIGITS.finditer(text, s, min(len(text), e + 18))]
    for group in (matches, _IDENT.finditer(text)):
        for m in group:
            digits = sum(c.isdigit() for c in m.group())
            if 6 <= digits <= 22:
                s, e = m.span()
                if text[s - 1 : s] == "(" and ")" in m.group() and "(" not in m.group():
                    s -= 1
                if s >= 2 and text[s - 2 : s] == "1-" and not m.group().startswith("1-"):
                    s -= 2
                out.append((s, e))
                # a number may end with its line: the parts between line ends are candidates too
                for part in re.finditer(r"[^\n]+", text[s:e]) if "\n" in m.group() else ():
                    a, b = s + part.start(), s + len(text[s : s + part.end()].rstrip(" .-"))
                    if 6 <= sum(c.isdigit() for c in text[a:b]) <= 22:
                        out.append((a, b))
    return out


def mail_spans(text: str) -> list[tuple[int, int]]:
    out, at = [], text.find("@")
    while at >= 0:
        start = at
        while start and _MAIL_LEFT.match(text, start - 1, at):
            start -= 1
        right = _MAIL_RIGHT.match(text, at + 1)
        if start < at and right:
            out.append((start, right.end()))
        at = text.find("@", at + 1)
    low = text.lower()
    if "at)" in low or "at]" in low or " dot " in low:
        out += [m.span() for m in _SPELT.finditer(text)]
    return out


def mail_features(text: str, s: int, e: int) -> list[float]:
    shown = re.sub(r" ?[(\[{] ?at ?[)\]}] ?| at ", "@", text[s:e], flags=re.I)
    spelt = shown != text[s:e]
    local, _, host = re.sub(r" dot | ?[(\[{] ?dot ?[)\]}] ?", ".", shown, flags=re.I).partition("@")
    parts = host.split(".")
    return [
        float(spelt), float(len(local)), float(sum(c.isalpha() for c in local)), float(len(parts)), float(len(parts[-1])), float(parts[-1].isalpha()), float(len(parts[0])), float(any(c.isalpha() for c in parts[0])),
        float(sum(c.isdigit() for c in host)), float(text[s - 1 : s] in "<[(\"" and s > 0), float(text[e : e + 1] in ">])\"" and e < len(text)),
    ]


def address_features(text: str, s: int, e: int) -> list[float]:
    shown = text[s:e]
    before = _words_before(text, s, 2)
    number = re.match(r"\d+", shown)
    first = int(number[0][:6]) if number else 0
    return [
        float(first), float(1900 <= first < 2100), float(bool(re.search(r"\d{4,6}", shown[5:]))), float(shown[:1].isdigit()), float(bool(re.match(r"(?i)p\.? ?o", shown))), float(bool(re.match(r"(?i)apt|flat|unit|suite", shown))),
        float(len(shown.split())), float(bool(re.search(r"(?i)stra(?:ss|ß)e|weg|platz|gasse|allee|\brue\b|\bavenue\b|chemin", shown))), float(shown.isupper()), float("\n" in shown),
        float(bool(before) and before[-1] in _MONTHS), float(bool(before) and before[-1] in ("in", "since", "until", "before", "of")), float(bool(before) and before[-1] in ("at", "to", "address")),
    ]


def address_spans(text: str) -> list[tuple[int, int]]:
    out = [m.span() for m in _NUMBER_FIRST.finditer(text)]
    low = text.lower()
    if "stra" in low or "weg" in low or "allee" in low or "platz" in low or "gasse" in low:
        out += [m.span() for m in _NUMBER_LAST.finditer(text)]
    if "box" in low:
        out += [m.span() for m in _BOX.finditer(text)]
    return out


def number_features(text: str, s: int, e: int) -> list[float]:
    shown = re.sub(r"\s+", " ", text[s:e])
    core = _EXT.sub("", shown)
    before, after = _words_before(text, s), _words_after(text, e)
    line = text.rfind("\n", 0, s) + 1
    head = text[line:s].strip()
    return [
        *(float(bool(p.match(core))) for p in _PHONE_FORMS), *(float(bool(p.match(core))) for p in _ID_FORMS),
        float(sum(c.isdigit() for c in core)), float(core != shown), float(core.startswith("+")), float(core.startswith("0")), float(core.startswith("9")),
        float(bool(_DATE.match(core))), float(any(w in _PERSONAL for w in before)), float(any(w in _PERSONAL for w in before[-2:])), float(any(w in _OTHER for w in before[-2:])), float(any(w in _OTHER for w in before)), float(any(w in _CALL for w in before[-2:])),
        float(bool(before) and before[-1] == "number"), float(bool(after) and (after[0] in ("next", "holder", "and"))), float(bool(re.match(r"(?i)^(?:sent|date|from|subject) ?:", head))), float(not head), float(s > 0 and text[s - 1] in "-/#:."), float(s > 0 and text[s - 1] == ":"), float("\n" in text[s:e]), float(bool(re.match(r"[.\-:]\d", text[e : e + 2]))),
    ]


@dataclass
class Finder:
    """The lexicon and the fitted trees of all kinds."""

    lexicon: Lexicon
    names: BoostedTrees
    phones: BoostedTrees
    idnos: BoostedTrees
    mails: BoostedTrees
    streets: BoostedTrees
    rest: DataFrame | None = None

    def spans(self, texts: list[str | None]) -> list[list[tuple[int, int, str, float]]]:
        """Accepted (start, end, kind, probability) of each text, without overlaps, in order."""
        found: list[list[tuple[int, int, str, float]]] = [[] for _ in texts]
        nf, nn, df, dn = [], [], [], []
        rows: dict[str, tuple[list, list]] = {"email": ([], []), "address": ([], [])}
        for i, text in enumerate(texts):
            if not text:
                continue
            for s, e, words in name_spans(text, self.lexicon):
                nf.append(name_features(text, s, e, words, self.lexicon))
                nn.append((i, s, e))
            for s, e in number_spans(text):
                df.append(number_features(text, s, e))
                dn.append((i, s, e))
            for kind, spans, features in (("email", mail_spans, mail_features), ("address", address_spans, address_features)):
                for s, e in spans(text):
                    rows[kind][0].append(features(text, s, e))
                    rows[kind][1].append((i, s, e))
        for kind, model in (("email", self.mails), ("address", self.streets)):
            if rows[kind][0]:
                for (i, s, e), p in zip(rows[kind][1], model.probability(np.array(rows[kind][0])), strict=True):
                    if p >= model.threshold:
                        found[i].append((s, e, kind, float(p)))
        if nf:
            for (i, s, e), p in zip(nn, self.names.probability(np.array(nf)), strict=True):
                if p >= self.names.threshold:
                    found[i].append((s, e, "name", float(p)))
        if df:
            x = np.array(df)
            for (i, s, e), p, q in zip(dn, self.phones.probability(x), self.idnos.probability(x), strict=True):
                if p >= self.phones.threshold and p >= q:
                    found[i].append((s, e, "phone", float(p)))
                elif q >= self.idnos.threshold:
                    found[i].append((s, e, "idno", float(q)))
        return [_best(f) for f in found]


def _best(spans: list[tuple[int, int, str, float]]) -> list[tuple[int, int, str, float]]:
    """Of overlapping spans the surer one, then the longer one; mail and street addresses hold what lies inside them."""
    rank = {"email": 2, "address": 2}
    kept: list[tuple[int, int, str, float]] = []
    for x in sorted(spans, key=lambda x: (-rank.get(x[2], 0), -round(x[3], 2), x[0] - x[1], x[0])):
        if all(x[1] <= k[0] or x[0] >= k[1] for k in kept):
            kept.append(x)
    return sorted(kept)


def fit(samples: list[tuple[str, list[str]]], lexicon: Lexicon) -> Finder:
    """Fit on (text, names) pairs whose names list all persons and organisations of the text, and on made-up texts."""
    nx, ny = [], []
    for text, names in samples:
        listed = {re.sub(r"\s+", " ", n.strip()) for n in names if n}
        persons = {n for n in listed if not split_name(n)[2]}
        for s, e, words in name_spans(text, lexicon):
            shown = re.sub(r"\s*\n(?:[>|] ?)*\s*|\s+", " ", text[s:e])
            nx.append(name_features(text, s, e, words, lexicon))
            ny.append(shown in persons and len(_TOKEN.findall(shown)) > 1)

    def made(rows: list[tuple[str, int, int, str]], spans, features) -> tuple[list, list]:
        """Features and labels of what the generator finds in made-up texts; a span that is not exactly the written one is none."""
        x, y = [], []
        for text, s, e, label in rows:
            for a, b in spans(text):
                x.append(features(text, a, b))
                y.append(label if (a, b) == (s, e) else "")
        return x, y

    dx, dy = made(pii_samples.numbers(TRAINING_SAMPLES), number_spans, number_features)
    mx, my = made(pii_samples.mails(TRAINING_SAMPLES), mail_spans, mail_features)
    ax, ay = made(pii_samples.addresses(TRAINING_SAMPLES), address_spans, address_features)

    def trees(x: list, y: list) -> BoostedTrees:
        if not x or not any(y) or all(y):
            model = BoostedTrees()
            model.prior = 9.0 if y and all(y) else -9.0
            return model
        return BoostedTrees().fit(np.array(x), np.array(y, float))

    kinds = [(nx, ny), (dx, [v == "phone" for v in dy]), (dx, [v == "idno" for v in dy]), (mx, [v == "email" for v in my]), (ax, [v == "address" for v in ay])]
    return Finder(lexicon, *(trees(x, y) for x, y in kinds))


def trained_finder(documents: DataFrame, messages: DataFrame) -> Finder:
    """``documents`` has ``doc_id, text, names``; ``messages`` ``sender, recipient``."""
    cells = messages.select(F.explode(F.split(F.concat_ws(";", "sender", "recipient"), ";")).alias("cell"))
    bare = F.regexp_replace("cell", r'\s*[<\[][^>\]]*[>\]]\s*$|^\s+|\s+$|"', "")
    names = documents.select(F.explode("names").alias("name")).unionByName(cells.select(bare.alias("name")))
    lexicon, rest = name_words(names)
    sample = documents.where("size(names) > 1 and text is not null").orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAINING_DOCUMENTS).select(F.lit("d").alias("rec"), F.col("doc_id").alias("id"), "text", "names")
    if rest is not None:
        sample = looked_up(sample, lexicon, rest)
    rows = sample.orderBy("id").collect()
    extra = {w: tuple(c) for r in rows if rest is not None and r.extra for w, c in r.extra.items()}
    finder = fit([(r.text, r.names) for r in rows], Lexicon({**lexicon.counts, **extra}))
    finder.lexicon, finder.rest = lexicon, rest
    return finder


def _run(records: DataFrame, finder: Finder, schema: str, rows) -> DataFrame:
    """``records``: rec, id, text."""
    columns = ["rec", "id", "text"]
    if finder.rest is not None:
        records = looked_up(records, finder.lexicon, finder.rest)
        columns.append("extra")
    shared = records.sparkSession.sparkContext.broadcast(replace(finder, rest=None))

    def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = shared.value
        for batch in batches:
            for start in range(0, len(batch), 200):
                part = batch.iloc[start : start + 200]
                texts = part["text"].tolist()
                use = own
                if "extra" in part:
                    more = {w: tuple(c) for m in part["extra"] if m for w, c in dict(m).items()}
                    use = replace(own, lexicon=Lexicon({**own.lexicon.counts, **more}))
                yield rows(part, texts, use.spans(texts))

    return records.select(columns).mapInPandas(apply, schema)


def findings(records: DataFrame, finder: Finder) -> DataFrame:
    """``rec, rec_id, pii, shown``, each distinct value of a record once."""

    def rows(part: pd.DataFrame, texts: list, spans: list) -> pd.DataFrame:
        out = {(r, i, k, t[s:e]) for r, i, t, f in zip(part["rec"], part["id"], texts, spans, strict=True) for s, e, k, _ in f}
        return pd.DataFrame(sorted(out), columns=["rec", "rec_id", "pii", "shown"])

    return _run(records, finder, "rec string, rec_id bigint, pii string, shown string", rows).distinct()


def redacted(records: DataFrame, finder: Finder) -> DataFrame:
    """``rec, rec_id, text`` with ``[NAME]``, ``[EMAIL]``, ``[PHONE]``, ``[IDNO]`` and ``[ADDRESS]`` in place of the values; one row a record."""

    def rows(part: pd.DataFrame, texts: list, spans: list) -> pd.DataFrame:
        out = []
        for text, f in zip(texts, spans, strict=True):
            pieces, at = [], 0
            for s, e, k, _ in f:
                pieces += [text[at:s], f"[{k.upper()}]"]
                at = e
            out.append(None if text is None else "".join([*pieces, text[at:]]))
        return pd.DataFrame({"rec": part["rec"], "rec_id": part["id"], "text": out})

    return _run(records, finder, "rec string, rec_id bigint, text string", rows).dropDuplicates(["rec", "rec_id"])
