"""Variant spellings of names: q-gram MinHash bands, Monge-Elkan verification, star clusters.

Each distinct spelling is read once into parts (family and given word, or the
stem and kind of an organisation). Padded q-grams of the family word or stem are
signed with MinHash and banded; the number of bands follows from the collision
curve, so that a pair of the lowest wanted q-gram similarity meets with the
wanted recall. Pairs that meet are verified with a Monge-Elkan similarity, in
which family and given part must find their counterpart: equal, one or
two slips apart, a short form of it, or its initial. Slips in given names are set right first, by
keys over all given names of the corpus, however rare (see :func:`corrected_words`). Stars are then built around
the most telling and most frequent spellings; a spelling that could belong to
several persons (an initial, a short form) joins the one whose mail address it
shares, else the clearly more frequent one, else none.

Defined results: null, empty and pure mail addresses are no names; spellings
differ by case and inner blanks; ties go to the smaller spelling; repeated rows
only add to a spelling's weight.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from archivolt.llm.neardup import band_keys
from archivolt.llm.pii import ORG_WORDS, TITLES
from archivolt.llm.texts import mix
from archivolt.runtime import discard, materialize

# Short forms of given names in public use, by the name they stand for.
SHORT_FORMS = {
    "alexander": "alex sasha sandy xander lex", "anastasia": "nastya ana stacy asya", "bartholomew": "bart barty", "benjamin": "ben benny benji", "christopher": "chris kit topher", "cornelia": "nelly connie corrie nelia",
    "desmond": "des desi", "dorothea": "dora thea dot dorothy dolly", "eleonora": "nora ellie leonora ella lena", "elizabeth": "liz betty beth lizzie eliza lisa bess", "elodie": "lodie", "ferdinand": "ferdi ferdy nando", "frederick": "fred freddie freddy fritz",
    "gabriela": "gabi gaby ela", "gregory": "greg greggy", "heinrich": "heinz heiner heini", "hildegard": "hilde hilda", "ignatius": "iggy nate", "isidora": "dora isi izzy", "jerome": "jeromy jerry", "josephine": "josie jo josy fina",
    "katherine": "kate kathy katie kit kitty kat", "krisztina": "kriszti kriszta tina", "leonard": "len lenny leo", "ludmila": "mila lida luda", "margaret": "peggy meg maggie madge greta", "maximilian": "max maxi", "nicholas": "nick nico nicky klaus",
    "octavian": "tavi", "ottilie": "otti tilly", "patricia": "patty pat trish tricia", "philippa": "pippa pip", "quentin": "quin", "rahel": "rahi", "raymond": "ray", "rebecca": "becky becca", "robert": "rob bob bobby robbie bert",
    "samuel": "sam sammy", "stefan": "fane steve fanel", "stefania": "stefi fania steffi", "susanna": "suzy sue susie susi sanna", "theodore": "ted teddy theo", "timothy": "tim timmy", "ulrich": "uli ulli", "valentin": "val valy", "victoria": "tori vicky vickie vika",
    "vincenzo": "enzo vinnie vince", "wilhelmina": "mina willa minna wilma", "william": "bill will billy willy liam", "yvonne": "evie vonnie yvie", "zoltan": "zoli",
}
# Kinds of organisation by the words that stand for them; legal forms say nothing about identity.
ORG_KINDS = {
    "holdings": "holdings hldgs holding", "partners": "partners ptnrs prtnrs", "capital": "capital cap", "shipping": "shipping shpg", "aviation": "aviation avn", "legal": "legal", "services": "services serv svcs service", "trust": "trust tr",
    "foundation": "foundation fdn found", "group": "group grp", "bank": "bank", "consulting": "consulting", "logistics": "logistics",
}
LEGAL_FORMS = frozenset("ltd limited llc lp llp inc incorporated co company corp gmbh ag sa plc fund the".split())

_FULL_OF: dict[str, list[str]] = {}
for _full, _shorts in SHORT_FORMS.items():
    for _s in _shorts.split():
        _FULL_OF.setdefault(_s, []).append(_full)
_KIND_OF = {w: kind for kind, ws in ORG_KINDS.items() for w in ws.split()}
_DIGIT = str.maketrans("0158", "olsb")


def folded(word: str) -> str:
    """Lower case, no diacritics, digits inside words read as the letters they stand for."""
    w = "".join(c for c in unicodedata.normalize("NFD", word.lower()) if unicodedata.category(c) != "Mn").replace("ß", "ss").replace("ø", "o").replace("ł", "l")
    return w.translate(_DIGIT) if any(c.isalpha() for c in w) else w


def slips(a: str, b: str, most: int = 2) -> int:
    """Letters left out, put in, changed or swapped with a neighbour (optimal alignment); most + 1 if more."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > most:
        return most + 1
    two: list[int] = []
    one = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            v = min(one[j] + 1, row[j - 1] + 1, one[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                v = min(v, two[j - 2] + 1)
            row.append(v)
        if min(row) > most:
            return most + 1
        two, one = one, row
    return min(one[-1], most + 1)


def read_name(name: str) -> tuple[str, str, str]:
    """(kind, head, rest): ``p`` family given, ``o`` stem and kinds of an organisation; ``-`` if neither."""
    raw = re.sub(r"\s+", " ", name.strip())
    words = raw.split(" ")
    plain = [folded(re.sub(r"[.,\"']", "", w)) for w in words]
    if len([p for p in plain if p]) < 2:
        return "-", "", ""
    tail = [p for p in plain[1:] if p]
    if any(p in _KIND_OF or p in LEGAL_FORMS or p in ORG_WORDS for p in tail) and not (len(tail) == 1 and "," not in raw and tail[0] in ("co", "sa", "ag")):
        rest = [p for p in plain if p and p not in LEGAL_FORMS]
        if rest:
            kinds = sorted({_KIND_OF[p] for p in rest[1:] if p in _KIND_OF} | {p for p in rest[1:] if p not in _KIND_OF})
            return "o", rest[0], " ".join(kinds)
        return "-", "", ""
    comma = next((i for i, w in enumerate(words[:-1]) if w.endswith(",")), None)
    parts = [(w, p) for w, p in zip(words, plain, strict=True) if p and p not in TITLES]
    if len(parts) < 2:
        return "-", "", ""
    if comma is not None:
        return "p", parts[0][1], parts[1][1]
    bare = [re.sub(r"[.,\"']", "", w) for w, _ in parts]
    if len(bare[0]) > 2 and bare[0].isupper() and not bare[-1].isupper():
        return "p", parts[0][1], parts[1][1]
    return "p", parts[-1][1], parts[0][1]


def given_reading(given: str) -> tuple[str, list[str]]:
    """(level, names it may stand for): ``full``, ``short`` or ``initial``."""
    if len(given) == 1:
        return "initial", [given]
    if given not in SHORT_FORMS and given in _FULL_OF:
        return "short", _FULL_OF[given]
    return "full", [given]


def slips_allowed(word: str) -> int:
    return 2 if len(word) > 6 else 1


def _slip_keys(word: str) -> set[str]:
    """Keys of which two words share one if they are as near as either allows.

    What is left after taking out one or two letters (Garbe's symmetric deletion); of words beyond 27 letters also fifths
    with their places, as two slips (at most four letters touched) leave a fifth whole and at most two places away.
    """
    out = set()
    if len(word) <= 30:
        out = {word} | {word[:i] + word[i + 1 :] for i in range(len(word))}
        if len(word) > 4:
            out |= {w[:i] + w[i + 1 :] for w in tuple(out) if len(w) == len(word) - 1 for i in range(len(w))}
    if len(word) > 27:
        cuts = [len(word) * k // 5 for k in range(6)]
        for k in range(5):
            out.add(f"{k} {word[cuts[k] : cuts[k + 1]]}")
            # the fifths of words up to two letters shorter or longer, where they may stand in this one
            for n in range(len(word) - 2, len(word) + 3):
                lo, hi = n * k // 5, n * (k + 1) // 5
                out |= {f"{k} {word[at : at + hi - lo]}" for at in range(max(0, lo - 2), min(lo + 2, len(word) - (hi - lo)) + 1)}
    return out


def corrected_words(words: DataFrame) -> DataFrame:
    """``rest, right``: given words that are slips of more frequent ones (``words`` has ``rest, n``, each once).

    A word is a slip of the nearest word that is used more than three times as often; a word used once or twice also of
    any word used more often, or as often and later in the alphabet. Slips of slips lead to the last one. All words take part, whatever their
    number: they meet by keys, and nothing is collected.
    """
    named = sorted(set(SHORT_FORMS) | set(_FULL_OF))

    def keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(w, int(n), k) for w, n in zip(batch["rest"], batch["n"], strict=True) for k in sorted(_slip_keys(w))]
            yield pd.DataFrame(rows, columns=["rest", "n", "key"])

    keyed = materialize(words.where("length(rest) > 1").mapInPandas(keys, "rest string, n bigint, key string"), "slipkeys")
    own, other = keyed.where(~F.col("rest").isin(named)), keyed.select("key", F.col("rest").alias("right"), F.col("n").alias("m"))
    rarer = (F.col("m") > 3 * F.col("n")) | ((F.col("n") <= 2) & (F.struct("m", "right") > F.struct("n", "rest")))
    met = own.join(other, "key").where((F.col("rest") != F.col("right")) & rarer).select("rest", "right", "m").distinct()

    def near(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            d = [slips(a, b, slips_allowed(a)) for a, b in zip(batch["rest"], batch["right"], strict=True)]
            out = batch.assign(d=d)
            yield out[[x <= slips_allowed(a) for x, a in zip(d, batch["rest"], strict=True)]]

    best = met.mapInPandas(near, "rest string, right string, m bigint, d int").groupBy("rest").agg(F.min_by("right", F.struct("d", (-F.col("m")).alias("m"), "right")).alias("right"))
    best = materialize(best, "slips")
    while True:  # each step goes to a more frequent word, so this ends
        nxt = best.join(best.select(F.col("rest").alias("right"), F.col("right").alias("on")), "right", "left")
        new = materialize(nxt.select("rest", F.coalesce("on", "right").alias("right"), F.col("on").isNotNull().alias("moved")), "slips")
        moved = new.where("moved").limit(1).count()
        discard(best)
        best = new.select("rest", "right")
        best._archivolt_path = new._archivolt_path
        if not moved:
            return best


def monge_elkan(head_a: str, head_b: str, given_a: list[str], level_a: str, given_b: list[str], level_b: str) -> float:
    """Mean of the best counterparts of the parts, 0 if any part has none."""
    n = slips(head_a, head_b, 2)
    long = min(len(head_a), len(head_b))
    if n > (2 if long > 8 else 1 if long > 3 else 0):
        return 0.0
    head = 1 - n / max(len(head_a), len(head_b))
    if level_a == "initial" or level_b == "initial":
        same = {g[0] for g in given_a} & {g[0] for g in given_b}
        given = 0.85 if same else 0.0
    elif set(given_a) & set(given_b):
        given = 1.0 if level_a == level_b == "full" else 0.9
    else:
        given = 0.0
    return (head + given) / 2 if given else 0.0


def bands_for(similarity: float, recall: float, rows: int) -> int:
    """Bands that let a pair of this similarity meet with this probability: 1 - (1 - s^r)^b >= recall."""
    return math.ceil(math.log(1 - recall) / math.log(1 - similarity**rows))


def _grams(word: str, q: int) -> list[str]:
    padded = "^" * (q - 1) + word + "$" * (q - 1)
    return [padded[i : i + q] for i in range(len(padded) - q + 1)]


def spellings(documents: DataFrame, messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``name, n``: every distinct spelling with its number of uses; and ``name, address``: the mail addresses written beside it."""
    cell = F.explode(F.split(F.concat_ws(";", "sender", "recipient"), ";"))
    mail = messages.select(cell.alias("cell"))
    address = F.lower(F.nullif(F.regexp_extract("cell", r"[<\[]([^<>\[\]]*@[^<>\[\]]*)[>\]]\s*$", 1), F.lit("")))
    bare = F.regexp_replace(F.regexp_replace("cell", r"\s*[<\[][^<>\[\]]*[>\]]\s*$", ""), r"^\s+|\s+$", "")
    bare = F.regexp_replace(bare, r'^"(.*)"$', "$1")
    mail = mail.select(bare.alias("name"), address.alias("address"))
    listed = documents.select(F.explode("names").alias("name"), F.lit(None).cast("string").alias("address"))
    used = listed.unionByName(mail).where("name is not null and trim(name) <> '' and not name rlike '^[^ ]+@[^ ]+$'")
    counted = materialize(used.groupBy("name", "address").agg(F.count("*").alias("n")), "uses")
    return counted.groupBy("name").agg(F.sum("n").alias("n")), counted.where("address is not null").select("name", "address")


def read_spellings(names: DataFrame) -> DataFrame:
    """``names`` with ``kind, head, level, given`` and band keys; spellings that are neither person nor organisation have kind ``-``."""
    first = materialize(_parsed(names), "spellings")
    used = first.where("kind = 'p' and length(rest) > 1").groupBy("rest").agg(F.sum("n").alias("n"))
    right = corrected_words(used)
    known = first.join(right, "rest", "left").withColumn("rest", F.when(F.col("kind") == "p", F.coalesce("right", "rest")).otherwise(F.col("rest")))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            got = [given_reading(rest) if k == "p" else ("full", [rest]) for k, rest in zip(batch["kind"], batch["rest"], strict=True)]
            yield batch[["name", "n", "kind", "head"]].assign(level=[g[0] for g in got], given=[list(g[1]) for g in got])

    return known.select(first.columns).mapInPandas(read, "name string, n bigint, kind string, head string, level string, given array<string>")


def _parsed(names: DataFrame) -> DataFrame:
    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            parts = [read_name(n) for n in batch["name"]]
            yield batch.assign(kind=[p[0] for p in parts], head=[p[1] for p in parts], rest=[p[2] for p in parts])

    return names.mapInPandas(parse, "name string, n bigint, kind string, head string, rest string")


def _banded(heads: DataFrame, q: int, rows: int, bands: int) -> DataFrame:
    """``kind, head, key`` of all bands of the distinct heads."""

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash

        seeds = mix(np.arange(1, rows * bands + 1, dtype=np.uint64))
        for batch in batches:
            sigs = np.empty((len(batch), rows * bands), np.uint64)
            for i, (k, h) in enumerate(zip(batch["kind"], batch["head"], strict=True)):
                g = np.array([xxhash.xxh3_64_intdigest(k + x) for x in set(_grams(h, q))], np.uint64)
                sigs[i] = mix(g[:, None] ^ seeds[None, :]).min(axis=0)
            yield pd.DataFrame({"kind": batch["kind"], "head": batch["head"], "keys": list(band_keys(sigs, bands))})

    return heads.mapInPandas(sign, "kind string, head string, keys array<bigint>").select("kind", "head", F.explode("keys").alias("key"))


def similar_spellings(read: DataFrame, q: int = 2, rows: int = 2, similarity: float = 0.45, recall: float = 0.99) -> DataFrame:
    """``a, b, score`` of the verified pairs of spellings (a < b)."""
    real = read.where("kind <> '-'")
    banded = _banded(real.select("kind", "head").distinct(), q, rows, bands_for(similarity, recall, rows))
    x, y = banded.alias("x"), banded.alias("y")
    heads = x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.kind") == F.col("y.kind")) & (F.col("x.head") <= F.col("y.head"))).select(F.col("x.kind").alias("kind"), F.col("x.head").alias("head_a"), F.col("y.head").alias("head_b")).distinct()
    # heads too far apart are dropped before the spellings are joined to them
    heads = heads.where((F.col("head_a") == F.col("head_b")) | (F.levenshtein("head_a", "head_b") <= 4))
    # parts of a name must agree in the first letter or be a short form: the blocking key keeps relatives apart early
    letters = F.array_distinct(F.transform("given", lambda g: F.substring(g, 1, 1)))
    forms = real.select("kind", "head", "name", "level", "given", F.explode(letters).alias("letter"))
    left = forms.select("kind", F.col("head").alias("head_a"), F.col("name").alias("name_a"), F.col("level").alias("level_a"), F.col("given").alias("given_a"), "letter")
    right = forms.select("kind", F.col("head").alias("head_b"), F.col("name").alias("name_b"), F.col("level").alias("level_b"), F.col("given").alias("given_b"), "letter")
    pairs = heads.join(left, ["kind", "head_a"]).join(right, ["kind", "head_b", "letter"]).where("name_a <> name_b and (head_a <> head_b or name_a < name_b)").drop("letter").dropDuplicates(["name_a", "name_b"])

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            score = [monge_elkan(ha, hb, list(ga), la, list(gb), lb) for ha, hb, ga, la, gb, lb in zip(batch.head_a, batch.head_b, batch.given_a, batch.level_a, batch.given_b, batch.level_b, strict=True)]
            out = pd.DataFrame({"a": batch.name_a, "b": batch.name_b, "score": score})
            yield out[out.score > 0]

    found = pairs.select("name_a", "name_b", "head_a", "head_b", "given_a", "level_a", "given_b", "level_b").mapInPandas(verify, "a string, b string, score double")
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "score").groupBy("a", "b").agg(F.max("score").alias("score"))


def star_clusters(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``name, center``: stars around the nodes of highest rank.

    ``nodes`` has ``name, rank`` (a sortable struct, unique), ``edges`` both directions as
    ``name, other, score, other_rank``. In each round a free node without a free
    neighbour of higher rank becomes a center, and its free neighbours join the
    best center beside them. Every round is written to the shared folder.
    """
    state = materialize(nodes.select("name", "rank", F.lit(None).cast("string").alias("center")), "stars")
    while True:  # the free node of highest rank becomes a center in every round, so this ends
        free = state.where("center is null").select("name", "rank")
        among = edges.join(free.select("name"), "name").join(free.select(F.col("name").alias("other")), "other", "left_semi")
        best = among.groupBy("name").agg(F.max("other_rank").alias("top"))
        centers = free.join(best, "name", "left").where("top is null or rank > top").select("name")
        joins = among.join(centers.select(F.col("name").alias("other")), "other", "left_semi").groupBy("name").agg(F.max(F.struct("score", "other_rank", "other")).alias("m")).select("name", F.col("m.other").alias("joined"))
        step = state.join(centers.withColumn("own", F.col("name")), "name", "left").join(joins, "name", "left")
        new = materialize(step.select("name", "rank", F.coalesce("center", "own", "joined").alias("center")), "stars")
        left = new.where("center is null").limit(1).count()
        discard(state)
        state = new
        if not left:
            return state.select("name", "center")


def linked_names(names: DataFrame, beside: DataFrame) -> DataFrame:
    """``name, center`` of every spelling of a person or organisation (``names`` and ``beside`` as from :func:`spellings`)."""
    read = materialize(read_spellings(names), "read")
    edges = materialize(similar_spellings(read), "edges")
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"), "score"))
    weak = read.where("kind = 'p' and (level = 'initial' or (level = 'short' and size(given) > 1))").select(F.col("name").alias("a"))
    full = read.where("level <> 'initial' and size(given) = 1").select(F.col("name").alias("b"), F.col("given")[0].alias("person"), F.col("n").alias("n_b"))
    # which person does an initial or an ambiguous short form mean: shared addresses first, then uses
    claims = both.join(weak, "a").join(full, "b")
    # common addresses are counted along the edges, so the users of one address never meet as such
    met = claims.select("a", "b").join(beside.withColumnRenamed("name", "a"), "a").join(beside.withColumnRenamed("name", "b"), ["b", "address"]).groupBy("a", "b").agg(F.count("*").alias("common"))
    claims = claims.join(met, ["a", "b"], "left").groupBy("a", "person").agg(F.sum(F.coalesce("common", F.lit(0))).alias("shared"), F.sum("n_b").alias("uses"))
    chosen = claims.groupBy("a").agg(F.max(F.struct("shared", "uses", "person")).alias("m"), F.sum("uses").alias("all"))
    chosen = chosen.select("a", F.when((F.col("m.shared") > 0) | (F.col("m.uses") >= 0.6 * F.col("all")), F.col("m.person")).alias("chosen"))
    tagged = both.join(chosen.withColumn("judged", F.lit(True)), "a", "left").join(full.select("b", "person"), "b", "left")
    kept = tagged.where("judged is null or person is null or person = chosen").select("a", "b", "score")
    # an edge stays if it stays in both directions
    kept = kept.join(kept.select(F.col("b").alias("a"), F.col("a").alias("b")), ["a", "b"], "left_semi")
    strength = F.when(F.col("level") == "full", 2).when((F.col("level") == "short") & (F.size("given") == 1), 1).otherwise(0)
    nodes = read.where("kind <> '-'").select("name", F.struct(strength.alias("s"), F.col("n").alias("n"), F.col("name").alias("w")).alias("rank"))
    edges = materialize(kept.join(nodes.select(F.col("name").alias("b"), F.col("rank").alias("other_rank")), "b").select(F.col("a").alias("name"), F.col("b").alias("other"), "score", "other_rank"), "staredges")
    return star_clusters(nodes, edges)


def linked_pairs(names: DataFrame, beside: DataFrame) -> DataFrame:
    """``name_a, name_b`` of all spellings in one star, a < b by code points."""
    stars = linked_names(names, beside)
    a, b = stars.select("center", F.col("name").alias("name_a")), stars.select("center", F.col("name").alias("name_b"))
    return a.join(b, "center").where("name_a < name_b").select("name_a", "name_b")
