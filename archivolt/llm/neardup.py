"""Near-duplicate records: SuperMinHash signatures, banding, exact verification, grouping.

SuperMinHash (Ertl, 2017) gives every element one random permutation of the
signature's places and a random rank for each step along it; a place keeps the
smallest step-plus-rank it is given. The ranks of an element are correlated, so
the estimate varies less than with independent hashes, and an element stops as
soon as its step exceeds the largest value that a place of its record still
holds. Both hold here for all records of an Arrow batch at once.

Equal texts are one class throughout: a class is signed, banded and verified
once, and its members are joined back at the end. Candidate pairs are verified
on the whole shingle sets, so banding decides recall only: with bands b of r rows a pair of
similarity s is missed with probability (1 - s^r)^b (0.4 % at 0.6 with 40 x 4).

Defined results: null and empty texts, and records with fewer than ``min_words``
words, take part in no pair and form no group; repeated rows of one id with
equal text count once; extra columns are dropped; empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from archivolt.llm.texts import WordHashes, digest, mix, ngram_hashes, text_class, words
from archivolt.operators.graph import connected_components
from archivolt.runtime import materialize

_DONE = np.uint64(1 << 63)
_S32 = np.uint64(32)
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def superminhash(elements: np.ndarray, sizes: np.ndarray, places: int, seed: int = 1) -> np.ndarray:
    """Signatures of many sets at once.

    ``elements`` holds the distinct 64-bit hashes of all sets one after the other,
    ``sizes`` the number of each. Returns one row of ``places`` values a set.
    A value is ``step << 32 | rank``: it orders as step + rank / 2^32.
    """
    n = len(sizes)
    sig = np.full(n * places, _DONE, np.uint64)
    owner = np.repeat(np.arange(n, dtype=np.int64), sizes)
    live = np.arange(len(elements))
    base = mix(elements + np.uint64(seed) * _GOLD)
    swaps: list[np.ndarray] = []  # the place drawn by each live element in each earlier step
    for step in range(places):
        if not len(live):
            break
        state = mix(base[live] + np.uint64((2 * step + 1) * int(_GOLD) & (2**64 - 1)))
        draw = (mix(state + _GOLD) >> _S32) * np.uint64(places - step) >> _S32
        k = draw.astype(np.int64) + step
        # the place now at index k of the element's permutation: follow earlier swaps back
        place = k.copy()
        for i in range(step - 1, -1, -1):
            place[swaps[i] == place] = i
        np.minimum.at(sig, owner[live] * places + place, (np.uint64(step) << _S32) | (state >> _S32))
        largest = sig.reshape(n, places).max(axis=1) >> _S32
        go_on = largest[owner[live]] > np.uint64(step)
        swaps = [s[go_on] for s in [*swaps, k]]
        live = live[go_on]
    return sig.reshape(n, places)


def band_keys(signatures: np.ndarray, bands: int) -> np.ndarray:
    n, places = signatures.shape
    rows = signatures.reshape(n, bands, places // bands)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (n, bands)) * _GOLD
    for i in range(places // bands):
        key = mix(key ^ (rows[:, :, i] + _GOLD))
    return key.view(np.int64)


class _Shingler:
    def __init__(self, size: int, min_words: int):
        self.size, self.min_words, self.hashes = size, min_words, WordHashes()

    def __call__(self, text: str | None) -> np.ndarray:
        ws = words(text)
        if len(ws) < max(self.min_words, self.size):
            return np.empty(0, np.uint64)
        return np.unique(ngram_hashes(self.hashes.of(ws), self.size))


def signatures(classes: DataFrame, size: int, min_words: int, bands: int, rows: int) -> DataFrame:
    """``cls, keys`` (one key a band) of every class that takes part; one row a class."""

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingle = _Shingler(size, min_words)
        for batch in batches:
            for start in range(0, len(batch), 500):
                part = batch.iloc[start : start + 500]
                sets = [shingle(t) for t in part["text"]]
                keep = [i for i, s in enumerate(sets) if len(s)]
                if not keep:
                    continue
                sizes = np.array([len(sets[i]) for i in keep])
                keys = band_keys(superminhash(np.concatenate([sets[i] for i in keep]), sizes, bands * rows), bands)
                apart = shingle.hashes.of([part["rec"].iloc[i] for i in keep])  # only records of one kind may meet
                yield pd.DataFrame({"cls": part["cls"].to_numpy()[keep], "keys": list(keys ^ mix(apart).view(np.int64)[:, None])})

    return classes.select("rec", "cls", "text").mapInPandas(sign, "cls bigint, keys array<bigint>").dropDuplicates(["cls"])


def _verified(pairs: DataFrame, size: int, min_words: int, threshold: float) -> DataFrame:
    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingle = _Shingler(size, min_words)
        kept: dict[int, np.ndarray] = {}
        for batch in batches:
            sims = np.empty(len(batch))
            for i, (a, ta, b, tb) in enumerate(zip(batch.cls_a, batch.text_a, batch.cls_b, batch.text_b, strict=True)):
                if len(kept) > 2000:
                    kept.clear()
                sa = kept.get(a)
                if sa is None:
                    sa = kept[a] = shingle(ta)
                sb = kept.get(b)
                if sb is None:
                    sb = kept[b] = shingle(tb)
                both = len(np.intersect1d(sa, sb, assume_unique=True))
                sims[i] = both / max(1, len(sa) + len(sb) - both)
            out = batch[["cls_a", "cls_b"]].assign(similarity=sims)
            yield out[sims >= threshold]

    return pairs.mapInPandas(verify, "cls_a bigint, cls_b bigint, similarity double")


def _keyed(records: DataFrame) -> DataFrame:
    return records.select("rec", "id", "text", text_class(F.col("rec"), F.col("text")).alias("cls"))


def _check(candidates: DataFrame, keyed: DataFrame, size: int, min_words: int, threshold: float) -> DataFrame:
    """The candidates (``cls_a, cls_b``, written once) that are similar enough, by their whole texts."""
    wanted = candidates.select(F.explode(F.array("cls_a", "cls_b")).alias("cls")).distinct()
    texts = keyed.select("cls", "text").join(wanted, "cls", "left_semi").withColumn("_d", digest(F.col("text"))).dropDuplicates(["cls", "_d"]).drop("_d")
    joined = candidates.join(texts.select(F.col("cls").alias("cls_a"), F.col("text").alias("text_a")), "cls_a").join(texts.select(F.col("cls").alias("cls_b"), F.col("text").alias("text_b")), "cls_b")
    return _verified(joined, size, min_words, threshold).distinct()


def near_pairs(records: DataFrame, threshold: float = 0.6, size: int = 3, min_words: int = 20, bands: int = 40, rows: int = 4) -> tuple[DataFrame, DataFrame]:
    """Pairs of classes and the members of classes.

    ``records`` has ``rec, id, text``; only records of one ``rec`` are compared.
    Returns ``(cls_a, cls_b, similarity)`` with each pair once, and ``(rec, id, cls)``
    of the records that take part. Nothing is collected: bands are matched by a
    sort-merge self-join that adaptive execution splits where a key is hot.
    """
    keyed = _keyed(records)
    signed = materialize(signatures(keyed, size, min_words, bands, rows), "bands")
    members = keyed.select("rec", "id", "cls").distinct().join(signed.select("cls"), "cls", "left_semi")
    banded = signed.select("cls", F.explode("keys").alias("key"))
    candidates = banded.alias("a").join(banded.alias("b"), (F.col("a.key") == F.col("b.key")) & (F.col("a.cls") < F.col("b.cls"))).select(F.col("a.cls").alias("cls_a"), F.col("b.cls").alias("cls_b")).distinct()
    candidates = materialize(candidates, "candidates")
    return _check(candidates, keyed, size, min_words, threshold), members


def near_record_pairs(records: DataFrame, **options) -> DataFrame:
    """``rec, id_a, id_b`` of all near-duplicate records, members of one class included."""
    pairs, members = near_pairs(records, **options)
    a = members.select("cls", "rec", F.col("id").alias("x"))
    b = members.select("cls", F.col("id").alias("y"))
    across = pairs.join(a.withColumnRenamed("cls", "cls_a"), "cls_a").join(b.withColumnRenamed("cls", "cls_b"), "cls_b").select("rec", "x", "y")
    within = a.join(b, "cls").where("x < y").select("rec", "x", "y")
    both = across.unionByName(within).where("x <> y")
    return both.select("rec", F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b")).distinct()


def near_links(records: DataFrame, **options) -> DataFrame:
    """``rec, id, class_id, copies, n_links``: every taking-part record with the smallest id of its equal texts, their number, and how many records it is similar to.

    Links are counted between classes by their sizes; neither copies nor partners are expanded into pairs of records.
    """
    pairs, members = near_pairs(records, **options)
    members = materialize(members, "members")
    sizes = members.groupBy("cls").agg(F.min("id").alias("class_id"), F.count("*").alias("copies"))
    sides = pairs.select(F.col("cls_a").alias("cls"), F.col("cls_b").alias("other")).unionByName(pairs.select(F.col("cls_b").alias("cls"), F.col("cls_a").alias("other")))
    near = sides.join(sizes.select(F.col("cls").alias("other"), "copies"), "other").groupBy("cls").agg(F.sum("copies").alias("near"))
    out = members.join(sizes, "cls").join(near, "cls", "left")
    return out.select("rec", "id", "class_id", "copies", (F.coalesce("near", F.lit(0)) + F.col("copies") - 1).alias("n_links"))


def near_groups(records: DataFrame, threshold: float = 0.8, size: int = 5, min_words: int = 20, bands: int = 40, rows: int = 4) -> DataFrame:
    """``rec, id, group_id, members``: every taking-part record with the smallest id of its group and the group's size.

    Groups are the connected components of all similar pairs, found without forming all pairs of a bucket: first each
    class of a bucket is held against the bucket's first one, and what is similar is united. Then only classes of
    one bucket that are still in different components are held against each other, so no link between
    different texts is lost and a bucket of many near copies costs little more than its size.
    A record without partner is its own group.
    """
    keyed = _keyed(records)
    signed = materialize(signatures(keyed, size, min_words, bands, rows), "bands")
    members = keyed.select("rec", "id", "cls").distinct().join(signed.select("cls"), "cls", "left_semi")
    banded = signed.select("cls", F.explode("keys").alias("key"))
    firsts = banded.groupBy("key").agg(F.min("cls").alias("first"), F.max("cls").alias("last")).where("first <> last").select("key", "first")
    shared = materialize(banded.join(firsts, "key"), "buckets")
    stars = materialize(shared.where("cls <> first").select(F.col("first").alias("cls_a"), F.col("cls").alias("cls_b")).distinct(), "stars")
    edges = materialize(_check(stars, keyed, size, min_words, threshold).select(F.col("cls_a").alias("u"), F.col("cls_b").alias("v")), "edges")
    roots = connected_components(edges).withColumnRenamed("node", "cls")
    placed = shared.select("key", "cls").join(roots, "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    # buckets whose classes are one component already need nothing more
    open_keys = placed.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("key")
    left = materialize(placed.join(open_keys, "key", "left_semi"), "open")
    apart = left.alias("a").join(left.alias("b"), (F.col("a.key") == F.col("b.key")) & (F.col("a.cls") < F.col("b.cls")) & (F.col("a.root") != F.col("b.root")))
    apart = apart.select(F.col("a.cls").alias("cls_a"), F.col("b.cls").alias("cls_b")).distinct().join(stars, ["cls_a", "cls_b"], "left_anti")
    more = _check(materialize(apart, "apart"), keyed, size, min_words, threshold).select(F.col("cls_a").alias("u"), F.col("cls_b").alias("v"))
    roots = connected_components(edges.unionByName(more)).withColumnRenamed("node", "cls")
    grouped = members.join(roots, "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    sizes = grouped.groupBy("root").agg(F.min("id").alias("group_id"), F.count("*").alias("members"))
    return grouped.join(sizes, "root").select("rec", "id", "group_id", "members")
