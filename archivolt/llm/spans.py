"""Long exact spans shared between records.

A text is cut into units at line breaks and sentence or clause ends, and the
digest of the ``window`` characters from each unit's start is grouped over all
records. A unit longer than ``unit`` characters gets further starts by
winnowing (Schleimer et al., 2003), so no stretch of ``unit`` characters is
without a start. Hence, with window = length - unit - 2, each span of ``length``
characters that two records share holds a start whose whole window lies inside
it, in both records alike: candidates lose nothing. Characters are compared as
they stand, so no unit is normalised.

A digest shared by very many records (a notice, a form) forms no pairs as it is: every
window of ``length`` characters that may begin a shared span around such a start is
digested in its turn, and only records that agree on one of these meet. What then
meets does share a span, so the pairs are those that the result holds anyway.

Candidate pairs meet with the shift between their starts, and the exact runs of
equal characters along that shift are measured on the whole texts. Equal texts
are one class until the end.

:func:`unit_dedup` takes lines as units: normalised, grouped by digest over all records, the earliest kept and the
rest removed with their original offsets. It forms no pairs.

Defined results: null and short texts share nothing; repeated rows of one id
count once; a record shares nothing with itself; ties in rank go to the smaller
id; extra columns are dropped.
"""

from __future__ import annotations

import re
import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from archivolt.llm.texts import digest, text_class
from archivolt.runtime import materialize

#: A digest that more classes share than this is split by the exact windows around it before any pair is formed.
HOT_DIGEST = 100
_START = re.compile(r"(?:\n|[.?!;:] )(?=\S)")
_UNIT_WORD = re.compile(r"[^\W_]+")
_GRAM = 16


def _winnowed(text: str, lo: int, hi: int, unit: int) -> Iterator[int]:
    """Places of the smallest gram hash in every run of ``unit`` characters of text[lo:hi]; the leftmost wins."""
    width = unit - _GRAM + 1
    queue: deque[tuple[int, int]] = deque()
    last = -1
    for i in range(lo, hi - _GRAM + 1):
        h = zlib.crc32(text[i : i + _GRAM].encode("utf-8", "surrogatepass"))
        while queue and queue[-1][0] > h:
            queue.pop()
        queue.append((h, i))
        if queue[0][1] <= i - width:
            queue.popleft()
        if i - lo + 1 >= width and queue[0][1] != last:
            last = queue[0][1]
            yield last


def unit_starts(text: str, unit: int) -> list[int]:
    """Starts of the units of a text, dense enough that every ``unit`` + 2 characters hold one."""
    natural = [m.end() for m in _START.finditer(text)]
    out, before = [], 0
    for p in [*natural, len(text)]:
        if p - before > unit:
            out.extend(_winnowed(text, before, p, unit))
        if p < len(text):
            out.append(p)
        before = p
    return sorted(set(out))


def unit_digests(classes: DataFrame, length: int, unit: int) -> DataFrame:
    """``cls, key, pos``: the digest of the window at every unit start; equal texts give equal rows, kept once."""
    window = length - unit - 2

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            cls, key, pos = [], [], []
            for c, text in zip(batch["cls"], batch["text"], strict=True):
                if text is None or len(text) < length:
                    continue
                for p in unit_starts(text, unit):
                    if p + window <= len(text):
                        cls.append(c)
                        pos.append(p)
                        key.append(xxhash.xxh3_64_intdigest(text[p : p + window].encode("utf-8", "surrogatepass")))
            yield pd.DataFrame({"cls": np.array(cls, np.int64), "key": np.array(key, np.uint64).view(np.int64), "pos": np.array(pos, np.int32)})

    return classes.select("cls", "text").mapInPandas(cut, "cls bigint, key bigint, pos int").distinct()


def _runs(a: str, b: str, shift: int, length: int) -> list[tuple[int, int]]:
    """(start in a, length) of the runs of at least ``length`` equal characters with a[i] == b[i - shift]."""
    lo, hi = max(0, shift), min(len(a), len(b) + shift)
    x = np.frombuffer(a[lo:hi].encode("utf-32-le", "surrogatepass"), np.uint32)
    y = np.frombuffer(b[lo - shift : hi - shift].encode("utf-32-le", "surrogatepass"), np.uint32)
    breaks = np.concatenate(([-1], np.flatnonzero(x != y), [len(x)]))
    gaps = np.diff(breaks) - 1
    return [(int(lo + breaks[i] + 1), int(gaps[i])) for i in np.flatnonzero(gaps >= length)]


def _exact_windows(starts: DataFrame, keyed: DataFrame, length: int, unit: int) -> DataFrame:
    """``cls, key, pos`` of every window of ``length`` characters that begins at most ``unit`` + 2 before a hot start."""
    per_class = starts.groupBy("cls").agg(F.collect_set("pos").alias("starts"))  # at most a text's own starts
    joined = keyed.select("cls", "text").join(per_class, "cls")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for c, text, hot_starts in zip(batch["cls"], batch["text"], batch["starts"], strict=True):
                at = sorted({s for p in hot_starts for s in range(max(0, p - unit - 2), p + 1) if s + length <= len(text)})
                key = np.array([xxhash.xxh3_64_intdigest(text[s : s + length].encode("utf-8", "surrogatepass"), seed=1) for s in at], np.uint64)
                yield pd.DataFrame({"cls": np.full(len(at), c, np.int64), "key": key.view(np.int64), "pos": np.array(at, np.int32)})

    return joined.mapInPandas(cut, "cls bigint, key bigint, pos int").distinct()


def shared_runs(documents: DataFrame, length: int = 300, unit: int = 120, hot: int = HOT_DIGEST) -> tuple[DataFrame, DataFrame]:
    """Shared spans of classes and the members of classes.

    ``documents`` has ``id, text``. Returns ``(cls_a, cls_b, start_a, start_b, chars)`` with
    cls_a < cls_b, and ``(id, cls, chars)`` of all records long enough to share anything.
    """
    keyed = documents.select("id", "text", text_class(F.col("text")).alias("cls")).where(F.length("text") >= length)
    members = keyed.select("id", "cls", F.length("text").alias("chars")).distinct()
    units = materialize(unit_digests(keyed, length, unit), "units")
    sizes = units.groupBy("key").agg(F.min("cls").alias("lo"), F.max("cls").alias("hi"), F.count("*").alias("n")).where("lo <> hi").select("key", "n")
    sizes = materialize(sizes, "digests")
    common = units.join(sizes.where(F.col("n") <= hot).select("key"), "key", "left_semi")
    if sizes.where(F.col("n") > hot).limit(1).count():
        common = common.unionByName(_exact_windows(units.join(sizes.where(F.col("n") > hot).select("key"), "key", "left_semi"), keyed, length, unit))
    candidates = common.alias("a").join(common.alias("b"), (F.col("a.key") == F.col("b.key")) & (F.col("a.cls") < F.col("b.cls"))).select(F.col("a.cls").alias("cls_a"), F.col("b.cls").alias("cls_b"), (F.col("a.pos") - F.col("b.pos")).alias("shift")).distinct()
    candidates = materialize(candidates, "candidates")
    wanted = candidates.select(F.explode(F.array("cls_a", "cls_b")).alias("cls")).distinct()
    texts = keyed.select("cls", "text").join(wanted, "cls", "left_semi").withColumn("_d", digest(F.col("text"))).dropDuplicates(["cls", "_d"]).drop("_d")
    joined = candidates.join(texts.select(F.col("cls").alias("cls_a"), F.col("text").alias("text_a")), "cls_a").join(texts.select(F.col("cls").alias("cls_b"), F.col("text").alias("text_b")), "cls_b")

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for a, b, shift, ta, tb in zip(batch.cls_a, batch.cls_b, batch["shift"], batch.text_a, batch.text_b, strict=True):
                rows.extend((a, b, start, start - shift, n) for start, n in _runs(ta, tb, int(shift), length))
            yield pd.DataFrame(rows, columns=["cls_a", "cls_b", "start_a", "start_b", "chars"])

    return joined.mapInPandas(measure, "cls_a bigint, cls_b bigint, start_a int, start_b int, chars int"), members


def shared_span_pairs(documents: DataFrame, length: int = 300, unit: int = 120, hot: int = HOT_DIGEST) -> DataFrame:
    """``doc_a, doc_b`` of all records that share a span of at least ``length`` characters."""
    runs, members = shared_runs(documents, length, unit, hot)
    a = members.select(F.col("id").alias("x"), "cls")
    across = runs.select("cls_a", "cls_b").distinct().join(a.withColumnRenamed("cls", "cls_a"), "cls_a").join(a.select(F.col("x").alias("y"), F.col("cls").alias("cls_b")), "cls_b").select("x", "y")
    within = a.join(a.select(F.col("x").alias("y"), "cls"), "cls").where("x < y").select("x", "y")
    return across.unionByName(within).select(F.least("x", "y").alias("doc_a"), F.greatest("x", "y").alias("doc_b")).distinct()


def shared_shares(documents: DataFrame, length: int = 300, unit: int = 120) -> DataFrame:
    """``id, chars, spans, shared_chars, shared_share, removed_chars, ranges, kept_text``: one row a record of at least ``length`` characters.

    ``ranges`` cuts the record into ``start, end, shared, kept`` by its own offsets; ``kept_text`` joins the kept ranges.

    ``shared_chars`` counts characters inside any shared span. ``removed_chars`` counts those whose
    earliest ranked occurrence (smallest id) is another record: what deduplication would drop
    while the earliest copy stays. Overlapping spans are merged with a running maximum over
    the ends of each record's own spans.
    """
    runs, members = shared_runs(documents, length, unit)
    runs = materialize(runs, "runs")
    first = members.groupBy("cls").agg(F.min("id").alias("first"), F.count("*").alias("copies"), F.max("chars").alias("chars"))
    sides = runs.select(F.col("cls_a").alias("cls"), F.col("start_a").alias("s"), (F.col("start_a") + F.col("chars")).alias("e"), F.col("cls_b").alias("other")).unionByName(runs.select(F.col("cls_b").alias("cls"), F.col("start_b").alias("s"), (F.col("start_b") + F.col("chars")).alias("e"), F.col("cls_a").alias("other")))
    ranked = sides.join(first.select("cls", "first"), "cls").join(first.select(F.col("cls").alias("other"), F.col("first").alias("other_first")), "other")
    sides = ranked.groupBy("cls", "s", "e").agg(F.max((F.col("other_first") < F.col("first")).cast("int")).alias("later"))

    def covered(df: DataFrame, name: str) -> DataFrame:
        # one row a class, its merged spans; the array is bounded by the record's own length
        spans = df.groupBy("cls").agg(F.array_sort(F.collect_set(F.struct("s", "e"))).alias("spans"))
        kind = "array<struct<s:int,e:int>>"

        def add(acc, x):
            last = F.get(acc, F.size(acc) - 1)
            longer = F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(F.struct(last["s"].alias("s"), F.greatest(last["e"], x["e"]).alias("e"))))
            return F.when(last["e"] >= x["s"], longer).otherwise(F.concat(acc, F.array(x))).cast(kind)

        return spans.select("cls", F.aggregate("spans", F.array().cast(kind), add).alias(name))

    shared, dropped = covered(sides, "_all"), covered(sides.where("later = 1"), "_later")
    texts = documents.select("id", "text", text_class(F.col("text")).alias("cls")).where(F.length("text") >= length).dropDuplicates(["id", "cls"])
    out = members.join(first.select("cls", "first", "copies"), "cls").join(shared, "cls", "left").join(dropped, "cls", "left").join(texts, ["id", "cls"])
    copied, none = F.col("copies") > 1, F.array().cast("array<struct<s:int,e:int>>")
    whole = F.array(F.struct(F.lit(0).alias("s"), F.col("chars").alias("e")))
    out = out.withColumn("_in", F.when(copied, whole).otherwise(F.coalesce("_all", none))).withColumn("_out", F.when(copied & (F.col("id") > F.col("first")), whole).otherwise(F.coalesce("_later", none)))
    edges = F.array_sort(F.array_distinct(F.flatten(F.array(F.array(F.lit(0), F.col("chars")), *(F.col(f"{c}.{e}") for c in ("_in", "_out") for e in "se")))))
    within = lambda spans, p: F.exists(spans, lambda x: (x["s"] <= p) & (p < x["e"]))
    pieces = F.transform(F.slice(F.col("_edges"), F.lit(1), F.size("_edges") - 1), lambda p, i: F.struct(p.alias("start"), F.get("_edges", i + 1).alias("end"), within(F.col("_in"), p).alias("shared"), (~within(F.col("_out"), p)).alias("kept")))
    out = out.withColumn("_edges", edges).withColumn("ranges", pieces)
    total = lambda spans: F.aggregate(spans, F.lit(0), lambda acc, x: acc + x["e"] - x["s"])
    kept = F.array_join(F.transform(F.filter("ranges", lambda r: r["kept"]), lambda r: F.substring(F.col("text"), r["start"] + 1, r["end"] - r["start"])), "")
    return out.select("id", "chars", F.size("_in").alias("spans"), total(F.col("_in")).alias("shared_chars"), (total(F.col("_in")) / F.col("chars")).alias("shared_share"), total(F.col("_out")).alias("removed_chars"), "ranges", kept.alias("kept_text"))


def unit_dedup(documents: DataFrame, least: int = 40) -> DataFrame:
    """``id, units, removed_units, removed_chars, kept_text, removed``: every record without the lines that an earlier place holds already.

    A line counts by its letters and digits in lower case, if these are ``least`` characters or more; the earliest place is
    the smallest id, then the smallest offset. ``removed`` lists ``start, end`` of the lines taken out, by the record's own
    offsets. Null texts are left out, repeated rows of one id count once.
    """
    ready = documents.select("id", "text").where("text is not null").dropDuplicates(["id"])

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for i, text in zip(batch["id"], batch["text"], strict=True):
                at = 0
                for line in text.split("\n"):
                    plain = " ".join(_UNIT_WORD.findall(line.lower()))
                    if len(plain) >= least:
                        rows.append((i, at, at + len(line), xxhash.xxh3_128_digest(plain.encode("utf-8", "surrogatepass"))))
                    at += len(line) + 1
            yield pd.DataFrame(rows, columns=["id", "start", "end", "digest"])

    units = materialize(ready.mapInPandas(cut, "id bigint, start int, end int, digest binary"), "lines")
    first = units.groupBy("digest").agg(F.min(F.struct("id", "start")).alias("first"), F.count("*").alias("k")).where("k > 1")
    gone = units.join(first, "digest").where(F.struct("id", "start") != F.col("first")).groupBy("id").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("removed"))

    def keep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for i, text, removed in zip(batch["id"], batch["text"], batch["removed"], strict=True):
                spans = [] if removed is None else [(r["start"], r["end"]) for r in removed]
                starts, kept, at, n = {s for s, _ in spans}, [], 0, 0
                for line in text.split("\n"):
                    n += 1
                    if at not in starts:
                        kept.append(line)
                    at += len(line) + 1
                rows.append((i, n, len(spans), sum(e - s for s, e in spans), "\n".join(kept), [{"start": s, "end": e} for s, e in spans]))
            yield pd.DataFrame(rows, columns=["id", "units", "removed_units", "removed_chars", "kept_text", "removed"])

    return ready.join(gone, "id", "left").mapInPandas(keep, "id bigint, units bigint, removed_units bigint, removed_chars bigint, kept_text string, removed array<struct<start:int,end:int>>")
