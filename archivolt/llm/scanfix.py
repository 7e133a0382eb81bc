"""Repair of texts from scanned pages: furniture, broken words, misread characters.

An averaged perceptron edits words character by character. At each place of a
word it may keep what stands there, or replace, delete or insert (an edit of a
short run of characters); at a line end it may join two halves with or without
the hyphen; and a line by itself it may keep or take out as page furniture. It is
trained here on a bounded sample of scanned documents whose typed text is known
(``clean_samples``), aligned word by word, and on the same words with one
confusion put in. The edits are the usual confusions of scanners and those that the samples show.
What the rest of the corpus holds enters as a feature: how
often the word as it stands, and as it would be, occurs in texts that were never
scanned. Those counts cover all documents and every word that stands there three times. The ``CACHE_WORDS`` most frequent
ones are broadcast; of further ones a record gets by a keyed join those that its own words ask for.

Defined results: texts that aren't scanned (no page number as last non-blank line) are
returned as they are and have no findings; null and empty texts likewise. Words
without a known spelling are kept unless a digit stands inside them. Repeated
rows of one id count once.
"""

from __future__ import annotations

import difflib
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from archivolt.llm.furniture import furniture_lines, is_header, page_number
from archivolt.runtime import materialize

# What scanners read, and what stands on the page.
CONFUSIONS = (
    ("c", "e"), ("l", "i"), ("o", "a"), ("ri", "n"), ("f", "t"), ("0", "o"), ("1", "l"), ("cl", "d"), ("5", "s"), ("rn", "m"), ("ii", "u"),
    ("b", "h"), ("m", "in"), ("q", "g"), ("6", "b"), ("vv", "w"), ("h", "li"), ("m", "rn"), ("d", "cl"), ("8", "b"), ("9", "g"), ("i", "l"),
    ("e", "c"), ("a", "o"), ("n", "ri"), ("t", "f"), ("u", "ii"), ("1", "i"), ("in", "m"), ("g", "q"), ("h", "b"),
)
BREAKS = "\u00ac\u00ad\u2010\u2011-"
#: Labelled documents that training may use; the fit does not depend on the corpus beyond these and the word counts.
TRAINING_DOCUMENTS = 200

_WORD_EDGE = re.compile(r"^[^\w]+|[^\w]+$")
_PREFIX = re.compile(r"^(?:[>|] ?)+")
_BROKEN = re.compile(rf"(?:^|(?<=\s))(\S*[^\W_])([{BREAKS}]) ?$")
_BROKEN_INLINE = re.compile(rf"([^\W_][^\s{BREAKS}]*(?:-[^\s{BREAKS}]+)*)([{BREAKS}]) {{1,3}}(?=([^\W\d_]\S*))")
#: Most words whose counts are broadcast.
CACHE_WORDS = 500_000
#: Words of the samples that must show an edit before it is tried everywhere.
EDIT_EVIDENCE = 3
#: The last non-blank line of a scanned text is a page number; the same forms as in ``furniture``, for the filter inside the scan.
SCANNED_END = r"^[ \t]*(?:[Pp]a[gq][eco] [\dOoIlSB]{1,5}(?: [oc0]f [\dOoIlSB]{1,5})?|- ?[\dOoIlSB]{1,5} ?-|\[[\dOoIlSB]{1,5}\]|p\. ?[\dOoIlSB]{1,5}/[\dOoIlSB]{1,5}|[ivxlc]+|\d{1,4})[ \t]*$"


class Perceptron:
    """Averaged perceptron over sparse string features; one weight vector, highest score wins."""

    def __init__(self) -> None:
        self.w: dict[str, float] = defaultdict(float)
        self._sum: dict[str, float] = defaultdict(float)
        self._at: dict[str, int] = defaultdict(int)
        self.t = 0

    def score(self, features: Iterable[str]) -> float:
        get = self.w.get
        return sum(get(f, 0.0) for f in features)

    def _add(self, f: str, d: float) -> None:
        self._sum[f] += (self.t - self._at[f]) * self.w[f]
        self._at[f] = self.t
        self.w[f] += d

    def learn(self, options: list[list[str]], right: int) -> None:
        self.t += 1
        best = max(range(len(options)), key=lambda i: self.score(options[i]))
        if best != right:
            for f in options[right]:
                self._add(f, 1.0)
            for f in options[best]:
                self._add(f, -1.0)

    def averaged(self) -> dict[str, float]:
        for f in list(self.w):
            self._add(f, 0.0)
        return {f: s / max(1, self.t) for f, s in self._sum.items() if s}


@dataclass
class Editor:
    """The trained weights and the counts of common words."""

    weights: dict[str, float]
    counts: dict[str, int]
    pairs: tuple[tuple[str, str], ...] = CONFUSIONS

    def __post_init__(self) -> None:
        self._model = Perceptron()
        self._model.w = defaultdict(float, self.weights)
        self._memo: dict[str, str] = {}

    def _bucket(self, word: str) -> int:
        n = self.counts.get(word, 0)
        return n.bit_length() // 3 + (n > 0)

    def edits(self, word: str) -> list[tuple[int, str, str, str]]:
        """(place, from, to, result) of every edit of a lower-case word."""
        out = []
        for a, b in self.pairs:
            i = word.find(a)
            while i >= 0:
                out.append((i, a, b, word[:i] + b + word[i + len(a) :]))
                i = word.find(a, i + 1)
        return out

    def features(self, word: str, edit: tuple[int, str, str, str] | None) -> list[str]:
        known = self._bucket(word)
        digit = any(c.isdigit() for c in word)
        if edit is None:
            return [f"keep {min(known, 2)}", f"keep digit {digit} {known > 0}", "keep"]
        i, a, b, result = edit
        gain = self._bucket(result) - known
        before, after = word[i - 1] if i else "^", word[i + len(a)] if i + len(a) < len(word) else "$"
        clean = not any(c.isdigit() for c in result)
        return [f"edit {a}>{b}", f"gain {max(-2, min(gain, 4))} {known > 0}", f"known {self._bucket(result) > 0} {known > 0}", f"clean {digit} {clean} {a.isdigit()}", f"left {before}{a}>{b}", f"right {a}>{b}{after}"]

    def _search(self, word: str) -> str:
        """Two edits at most are looked ahead, since one alone may not reach a known word."""
        if self.counts.get(word):
            return word
        first = self.edits(word)
        for e in first:
            if self.counts.get(e[3]):
                break
        else:
            deeper = {}
            # a short word is two edits away from too many others
            for e in first if len(word) >= 6 else ():
                for f in self.edits(e[3]):
                    n = self.counts.get(f[3], 0)
                    if n and f[3] != word and (e[0] != f[0] or e[1] == f[1]):
                        s = self._model.score(self.features(word, e)) + self._model.score(self.features(e[3], f))
                        deeper[f[3]] = max(deeper.get(f[3], -1e9), s + 0.01 * n.bit_length())
            if deeper:
                return max(deeper, key=lambda w: (deeper[w], w))
        if not first:
            return word
        best = max(first, key=lambda e: (self._model.score(self.features(word, e)), e[3]))
        return best[3] if self._model.score(self.features(word, best)) > self._model.score(self.features(word, None)) else word

    def word(self, word: str) -> str:
        """The word as typed, lower case; the same word if nothing is to be changed."""
        got = self._memo.get(word)
        if got is None:
            if len(self._memo) > 500_000:
                self._memo.clear()
            got = word
            letters = sum(c.isalpha() for c in word)
            if 3 <= len(word) <= 40 and letters >= 2 and letters > len(word) / 2 and "@" not in word and "/" not in word and "." not in word:
                for _ in range(3):
                    nxt = self._search(got)
                    if nxt == got:
                        break
                    got = nxt
                # an unknown word may only become a known one, or lose the digits inside it
                if not self.counts.get(got) and (any(c.isdigit() for c in got) or not any(c.isdigit() for c in word)):
                    got = word
            self._memo[word] = got
        return got

    def join(self, left: str, mark: str, right: str) -> tuple[str, str]:
        """The two halves of a broken word made one (raw, and as typed in lower case)."""
        options = []
        for glue in ("", "-"):
            raw = left + glue + right
            bare = self.word(_WORD_EDGE.sub("", raw.lower()))
            n = self.counts.get(bare, 0)
            options.append((self._model.score(self.join_features(glue, mark, n)), glue == "", raw, bare))
        _, _, raw, bare = max(options)
        return raw, bare

    @staticmethod
    def join_features(glue: str, mark: str, n: int) -> list[str]:
        hard = mark == "-"
        return [f"join {glue!r} {hard}", f"join known {n > 0}", f"join {glue!r} known {n > 0}", f"join count {min(n.bit_length() // 3, 5)}"]


def line_features(lines: list[str], i: int, hint: str | None) -> list[str]:
    """Features of a line's place on its page and of its form."""
    line = lines[i].strip()
    above = page_number(lines[i - 1]) is not None if i else False
    return [
        f"line hint {hint}",
        f"line header {is_header(line)} {above}",
        f"line number {page_number(line) is not None} {hint is not None}",
        f"line last {i >= len(lines) - 2}",
        f"line end {line[-1:] in '.?!,' if line else None}",
        f"line words {min(len(line.split()), 8)}",
    ]


@dataclass
class Scan:
    """A scanned text taken apart: furniture, and the typed lines with broken words joined."""

    furniture: list[str]
    lines: list[str]
    joined: list[tuple[str, str]]


def take_apart(text: str, editor: Editor) -> Scan | None:
    lines = text.split("\n")
    hints = furniture_lines(lines)
    if not hints:
        return None
    out, furniture, joined, held = [], [], [], None
    gap = False
    score = editor._model.score
    for i, line in enumerate(lines):
        hint = hints.get(i)
        if hint and score([*line_features(lines, i, hint), "line out"]) > 0:
            furniture.append(line.strip())
            gap = hint == "header"
            continue
        body = _PREFIX.sub("", line)
        if held is not None:
            if not body.strip():
                continue
            left, mark = held
            first, _, rest = body.lstrip().partition(" ")
            raw, bare = editor.join(left, mark, first)
            joined.append((raw, bare))
            out[-1] += raw
            body = rest
            held = None
            line = rest
            if not rest.strip():
                continue
        elif gap and not line.strip():
            gap = False
            if out and not re.search(r"[.?!:]$", out[-1]):
                continue
        gap = False
        m = _BROKEN.search(body)
        if m and i < len(lines) - 1 and len(m[1]) > 0 and m[1][-1].isalpha():
            held = (m[1], m[2])
            out.append(line.rstrip()[: -len(m[0].rstrip())])
        else:
            out.append(line)
    if held is not None and out:
        out[-1] += held[0] + held[1]
    return Scan(furniture, out, joined)


def _misread(token: str, editor: Editor, typed: frozenset[str] = frozenset()) -> str | None:
    """The right word of a misread one; words in ``typed`` (names as their writer spelt them) are right."""
    bare = _WORD_EDGE.sub("", token.lower())
    if len(bare) < 3 or bare in typed:
        return None
    fixed = editor.word(bare)
    return fixed if fixed != bare else None


def _typed(names: Iterable[str] | None) -> frozenset[str]:
    if names is None:
        return frozenset()
    return frozenset(_WORD_EDGE.sub("", w.lower()) for n in names if n for w in n.split())


def findings(rec: str, text: str | None, editor: Editor, names: Iterable[str] | None = None) -> set[tuple[str, str]]:
    """(defect, reading) of a record; ``names`` are the names in it as they were typed."""
    if not text:
        return set()
    typed = _typed(names)
    if rec == "s":
        return _context_findings(text, editor, typed)
    scan = take_apart(text, editor)
    if scan is None:
        return set()
    out = {("line", x) for x in scan.furniture if x}
    out |= {("split", bare) for _, bare in scan.joined if bare}
    for line in scan.lines:
        for token in line.split():
            if fixed := _misread(token, editor, typed):
                out.add(("char", fixed))
    return out


def _context_findings(text: str, editor: Editor, typed: frozenset[str]) -> set[tuple[str, str]]:
    open_left, open_right = text.startswith("..."), text.endswith("...")
    core = text[3 * open_left : len(text) - 3 * open_right]
    out: set[tuple[str, str]] = set()
    pieces, at = [], 0
    for m in _BROKEN_INLINE.finditer(core):
        if m.start() < at:
            continue
        raw, bare = editor.join(m[1], m[2], m[3])
        whole = not (open_left and m.start() == 0) and not (open_right and m.end() + len(m[3]) >= len(core))
        if whole and bare:
            out.add(("split", bare))
        pieces.append(core[at : m.start()] + raw)
        at = m.end() + len(m[3])
    tokens = "".join([*pieces, core[at:]]).split()
    for k, token in enumerate(tokens):
        fixed = _misread(token, editor, typed)
        if fixed:
            cut = open_left and k == 0 or open_right and k == len(tokens) - 1
            # a word at the cut may be a fragment; a long known word is taken for whole
            if not cut or (len(fixed) >= 6 and editor.counts.get(fixed)):
                out.add(("char", fixed))
    return out


def repair(text: str | None, editor: Editor, names: Iterable[str] | None = None) -> str | None:
    """The text as typed: furniture out, words whole and right, paragraphs continuous."""
    if not text:
        return text
    scan = take_apart(text, editor)
    if scan is None:
        return text
    fixed, typed = [], _typed(names)
    for line in scan.lines:
        parts = re.split(r"(\s+)", line)
        for i, token in enumerate(parts):
            if token and not token.isspace() and (right := _misread(token, editor, typed)):
                bare = _WORD_EDGE.sub("", token)
                parts[i] = token.replace(bare, _with_case(bare, right), 1)
        fixed.append("".join(parts))
    out: list[str] = []
    width = max((len(x) for x in fixed), default=0)
    for k, line in enumerate(fixed):
        # a line that nearly fills the page runs on into the next
        if out and out[-1].strip() and line.strip() and len(fixed[k - 1]) > 0.72 * width and not re.match(r"^(?:[>|•*-]|\d+[.)] |[QA]: |\w+: )", line):
            out[-1] = out[-1].rstrip() + " " + line.lstrip()
        else:
            out.append(line)
    return "\n".join(out).strip()


def repair_context(text: str | None, editor: Editor, names: Iterable[str] | None = None) -> str | None:
    """A cut context as typed: words broken over a blank made whole, misread words right; the cut ends stay."""
    if not text:
        return text
    typed = _typed(names)
    pieces, at = [], 0
    for m in _BROKEN_INLINE.finditer(text):
        if m.start() >= at:
            pieces += [text[at : m.start()], editor.join(m[1], m[2], m[3])[0]]
            at = m.end() + len(m[3])
    whole = "".join([*pieces, text[at:]])
    parts = re.split(r"(\s+)", whole)
    for i, token in enumerate(parts):
        cut = (i == 0 and text.startswith("...")) or (i == len(parts) - 1 and text.endswith("..."))
        if token and not token.isspace() and not cut and (right := _misread(token, editor, typed)):
            bare = _WORD_EDGE.sub("", token)
            parts[i] = token.replace(bare, _with_case(bare, right), 1)
    return "".join(parts)


def _with_case(was: str, now: str) -> str:
    if was.isupper() and len(was) > 1:
        return now.upper()
    return now[0].upper() + now[1:] if was[0].isupper() or (was[0].isdigit() and was[1:2].isupper()) else now


def train(samples: list[tuple[str, str]], counts: dict[str, int], rounds: int = 4) -> Editor:
    """Fit the editor to (scanned, typed) texts."""
    model = Perceptron()
    editor = Editor({}, counts)
    editor._model = model
    words: list[tuple[str, str]] = []
    lines: list[tuple[list[str], bool]] = []
    joins: list[tuple[str, str, str, str]] = []
    for scanned, typed in samples:
        raw = scanned.split("\n")
        hints = furniture_lines(raw)
        typed_lines = {x.strip() for x in typed.split("\n")}
        kept = []
        for i, x in enumerate(raw):
            if x.strip():
                lines.append((line_features(raw, i, hints.get(i)), i in hints and x.strip() not in typed_lines))
            if i not in hints:
                kept.append(_PREFIX.sub("", x))
        right = [_WORD_EDGE.sub("", w.lower()) for w in typed.split() if w.strip(">|")]
        known = set(right)
        body = "\n".join(kept)
        for m in re.finditer(rf"(\S*[^\W\d_])([{BREAKS}]) ?\n\s*([^\W\d_]\S*)", body):
            for glue in ("", "-"):
                whole = _WORD_EDGE.sub("", (m[1] + glue + m[3]).lower())
                if whole in known:
                    joins.append((m[1], m[2], m[3], glue))
                    break
        left = [_WORD_EDGE.sub("", w.lower()) for w in re.sub(rf"(?<=[^\W\d_])[{BREAKS}] ?\n\s*(?=[^\W\d_])", "", body).split()]
        for tag, a, b, c, d in difflib.SequenceMatcher(None, left, right, autojunk=False).get_opcodes():
            if tag in ("equal", "replace") and b - a == d - c:
                words.extend(zip(left[a:b], right[c:d], strict=True))
        for k, w in enumerate(sorted(known)):
            fits = [(a, b) for a, b in CONFUSIONS if b in w]
            if fits and len(w) > 3:  # one confusion put in, a different one for each word
                a, b = fits[k % len(fits)]
                words.append((w.replace(b, a, 1), w))
    words = sorted(set(words))
    editor.pairs = (*CONFUSIONS, *learned_edits(words))
    for _ in range(rounds):
        for wrong, right in words:
            options = [None, *editor.edits(wrong)]
            good = next((i for i, e in enumerate(options) if (e[3] if e else wrong) == right), None)
            if good is not None and len(options) > 1:
                model.learn([editor.features(wrong, e) for e in options], good)
        for feats, out in lines:
            model.learn([[], [*feats, "line out"]], int(out))
        for left, mark, right, glue in joins:
            options = [Editor.join_features(g, mark, counts.get(_WORD_EDGE.sub("", (left + g + right).lower()), 0)) for g in ("", "-")]
            model.learn(options, 0 if glue == "" else 1)
    return Editor(model.averaged(), counts, editor.pairs)


def learned_edits(words: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """Edits of one place that ``EDIT_EVIDENCE`` different words of the samples show, beyond the usual ones."""
    seen: dict[tuple[str, str], set[str]] = defaultdict(set)
    for wrong, right in words:
        if wrong == right or len(right) < 4:
            continue
        i = 0
        while i < min(len(wrong), len(right)) and wrong[i] == right[i]:
            i += 1
        j = 0
        while j < min(len(wrong), len(right)) - i and wrong[-1 - j] == right[-1 - j]:
            j += 1
        a, b = wrong[i : len(wrong) - j], right[i : len(right) - j]
        if not a and i:  # a letter was lost: it is put in again behind the one before it
            a, b = wrong[i - 1], wrong[i - 1] + b
        if a and len(a) <= 2 and len(b) <= 2:
            seen[a, b].add(right)
    return sorted(e for e, shown in seen.items() if len(shown) >= EDIT_EVIDENCE and e not in CONFUSIONS)


def last_line(text) -> Column:
    """The last non-blank line of a text."""
    return F.substring_index(F.regexp_replace(text, r"\s+$", ""), "\n", -1)


def common_words(documents: DataFrame) -> tuple[dict[str, int], DataFrame | None]:
    """Counts of the words that never-scanned texts hold three times: the ``CACHE_WORDS`` most frequent ones, and a table ``w, n`` of the rest if there is any."""
    typed = documents.where(F.col("text").isNotNull() & ~last_line(F.col("text")).rlike(SCANNED_END))
    split = typed.select(F.explode(F.split(F.lower("text"), r"[^\p{L}\p{M}\p{N}-]+")).alias("w")).select(F.btrim("w", F.lit("-")).alias("w"))
    words = split.groupBy("w").agg(F.count("*").alias("n"))
    counted = materialize(words.where("n > 2 and length(w) > 1").where(~F.col("w").rlike(r"\p{N}")), "words")
    # how many words occur how often: few rows, as counts repeat
    least, held = 1, 0
    for r in counted.groupBy("n").agg(F.count("*").alias("k")).orderBy(F.desc("n")).toLocalIterator():
        held += r.k
        if held > CACHE_WORDS:
            least = r.n + 1
            break
    rows = counted.where(F.col("n") >= least).toPandas()
    return dict(zip(rows["w"], rows["n"].astype(int), strict=True)), counted.where(F.col("n") < least) if least > 1 else None


class _Asked(dict):
    """Counts that note which words were asked for and not there."""

    def __init__(self, counts: dict[str, int]):
        super().__init__(counts)
        self.asked: set[str] = set()

    def get(self, word, default=None):
        got = super().get(word)
        if got is None:
            self.asked.add(word)
            return default
        return got


def looked_up(scanned: DataFrame, editor: Editor, rest: DataFrame) -> DataFrame:
    """``scanned`` with ``extra``: the counts from ``rest`` of the words that a record's own words may stand for."""
    shared = scanned.sparkSession.sparkContext.broadcast(editor)

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        base = shared.value
        for batch in batches:
            rows = []
            for rec, i, text, names in zip(batch["rec"], batch["id"], batch["text"], batch["names"], strict=True):
                own = Editor(base.weights, counts := _Asked(base.counts), base.pairs)
                # what is asked while no further word is known covers what is asked when some are
                findings(rec, text, own, names)
                rows.extend((rec, i, w) for w in counts.asked)
            yield pd.DataFrame(rows, columns=["rec", "id", "w"])

    asked = scanned.select("rec", "id", "text", "names").mapInPandas(ask, "rec string, id bigint, w string").distinct()
    extra = asked.join(rest, "w").groupBy("rec", "id").agg(F.map_from_entries(F.collect_list(F.struct("w", "n"))).alias("extra"))
    return scanned.join(extra, ["rec", "id"], "left")


def trained_editor(documents: DataFrame, samples: DataFrame) -> tuple[Editor, DataFrame | None]:
    """The editor for a corpus (``id, text``) from its labelled sample (``doc_id, clean_text``), and the words beyond its own counts."""
    counts, rest = common_words(documents)
    some = samples.where("clean_text is not null").orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAINING_DOCUMENTS)
    pairs = documents.join(some.select(F.col("doc_id").alias("id"), "clean_text"), "id").select("id", "text", "clean_text").where("text is not null").orderBy("id").limit(2 * TRAINING_DOCUMENTS)
    if rest is not None:
        texts = pairs.select(F.lit("d").alias("rec"), "id", "text", F.lit(None).cast("array<string>").alias("names"))
        found = looked_up(texts, Editor({}, counts), rest).where("extra is not null").select("extra").collect()
        counts = {**counts, **{w: n for r in found for w, n in r.extra.items()}}
    return train([(r.text, r.clean_text) for r in pairs.collect()], counts), rest


def scanned_records(documents: DataFrame, messages: DataFrame, search_results: DataFrame) -> DataFrame:
    """``rec, id, text, names`` of scanned documents and messages, and of the contexts cut from scanned or unlisted files."""
    flag = F.coalesce(last_line(F.col("text")).rlike(SCANNED_END), F.lit(False))
    named = documents.select("filename", "names", flag.alias("scanned")).groupBy("filename").agg(F.first("names").alias("names"), F.max("scanned").alias("scanned"))
    own = documents.where(flag).select(F.lit("d").alias("rec"), F.col("doc_id").alias("id"), "text", "names")
    mail = messages.select(F.lit("m").alias("rec"), F.col("msg_id").alias("id"), F.col("body").alias("text"), "sender", F.col("source_file").alias("filename")).where(flag).distinct()
    mail = mail.join(named.where("scanned").select("filename", "names"), "filename", "left").withColumn("names", F.concat(F.coalesce("names", F.array().cast("array<string>")), F.array("sender")))
    cut = search_results.where("context is not null").select(F.lit("s").alias("rec"), F.col("hit_id").alias("id"), F.col("context").alias("text"), "filename")
    cut = cut.join(named, "filename", "left").where("scanned or scanned is null")
    return own.unionByName(mail.select(own.columns)).unionByName(cut.select(own.columns))


def _apply(scanned: DataFrame, editor: Editor, rest: DataFrame | None, schema: str, rows) -> DataFrame:
    shared = scanned.sparkSession.sparkContext.broadcast((dict(editor.weights), editor.counts, editor.pairs))
    columns = ["rec", "id", "text", "names"]
    if rest is not None:
        scanned = looked_up(scanned, editor, rest)
        columns.append("extra")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        weights, counts, pairs = shared.value
        own = Editor(weights, dict(counts), pairs)
        for batch in batches:
            if "extra" in batch:
                own = Editor(weights, {**counts, **{w: n for m in batch["extra"] if m for w, n in dict(m).items()}}, pairs)
            yield rows(batch, own)

    return scanned.select(columns).mapInPandas(run, schema)


def scan_findings(scanned: DataFrame, editor: Editor, rest: DataFrame | None = None) -> DataFrame:
    """``rec, rec_id, defect, reading``, each once."""

    def rows(batch: pd.DataFrame, own: Editor) -> pd.DataFrame:
        out = [(rec, i, *f) for rec, i, text, names in zip(batch["rec"], batch["id"], batch["text"], batch["names"], strict=True) for f in sorted(findings(rec, text, own, names))]
        return pd.DataFrame(out, columns=["rec", "rec_id", "defect", "reading"])

    return _apply(scanned, editor, rest, "rec string, rec_id bigint, defect string, reading string", rows).distinct()


def repaired_texts(scanned: DataFrame, editor: Editor, rest: DataFrame | None = None) -> DataFrame:
    """``rec, rec_id, text`` of scanned documents, messages and the contexts cut from them, as continuous paragraphs; one row a record."""

    def rows(batch: pd.DataFrame, own: Editor) -> pd.DataFrame:
        return pd.DataFrame({"rec": batch["rec"], "rec_id": batch["id"], "text": [repair_context(t, own, n) if rec == "s" else repair(t, own, n) for rec, t, n in zip(batch["rec"], batch["text"], batch["names"], strict=True)]})

    return _apply(scanned, editor, rest, "rec string, rec_id bigint, text string", rows).dropDuplicates(["rec", "rec_id"])
