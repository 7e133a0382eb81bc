"""From clusters of documents to conversations: messages, dedup, order, summary."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from archivolt.functions.fingerprints import with_fingerprints
from archivolt.functions.similarity import ratio
from archivolt.functions.text import clean_participant, normalize_body, participant_key, subject_norm
from archivolt.operators.graph import numbered
from archivolt.operators.joins import fuzzy_pairs
from archivolt.runtime import materialize


def dedup_exact(messages: DataFrame, group: str, order: list[str], keep: list[str] | None = None) -> DataFrame:
    """The first message of each group and compared body; bodies under 10 compared characters are dropped. ``keep`` are the columns wanted, without it all.

    Only the first copy can ever be kept, so this pre-aggregation is exact for the greedy phase. ``first`` is
    a minimum by key: no window gathers a group.
    """
    with_norm = messages.withColumn("norm", normalize_body(F.col("body"))).where(F.length("norm") >= 10)
    rest = [c for c in keep or with_norm.columns if c not in (group, "norm")]
    first = with_norm.groupBy(group, "norm").agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("m"))
    return first.select(group, "norm", "m.*")


def is_duplicate(norm: str, kept: list[str]) -> bool:
    """Contained in, containing, or much like a kept body."""
    for other in kept:
        if norm == other:
            return True
        if len(norm) > 20 and len(other) > 20 and (norm in other or other in norm):
            return True
        if len(norm) > 30 and len(other) > 30:
            short, long = (norm, other) if len(norm) <= len(other) else (other, norm)
            if ratio(short[:50], long[:50]) > 85 and ratio(short, long[: len(short) + 20]) > 80:
                return True
    return False


def contained_pairs(bodies: DataFrame, group: str, small: int = 64) -> DataFrame:
    """``group, a, b`` of all different bodies (``norm``) of a group of which a, of more than 20 characters, is a part of b.

    The bodies of a group of at most ``small`` meet as they are. In larger groups a body contained in another has all its
    fingerprints there, so its rarest one is looked up; only digests are exploded, and texts come back to the pairs found.
    """
    c = F.col
    once = bodies.select(group, "norm").where(c(group).isNotNull() & (F.length("norm") > 20)).distinct()
    sizes = once.groupBy(group).agg(F.count("*").alias("_n"))
    few = once.join(sizes.where(c("_n").between(2, small)).select(group), group)
    near = few.withColumnRenamed("norm", "a").join(few.withColumnRenamed("norm", "b"), group)
    many = materialize(once.join(sizes.where(c("_n") > small).select(group), group), "manybodies")
    # two digests name a body within its group
    body = F.struct(F.xxhash64(group, "norm").alias("x"), F.xxhash64(F.lit(7), "norm").alias("y"))
    prints = materialize(with_fingerprints(many, "norm", 11, 11).select(body.alias("k"), F.explode("prints").alias("print"), F.xxhash64(group).alias("_g")).select("k", F.xxhash64("_g", "print").alias("print")), "bodyprints")
    uses = prints.groupBy("print").agg(F.count("*").alias("n"))
    rarest = prints.join(uses, "print").groupBy("k").agg(F.min_by("print", F.struct("n", "print")).alias("print"))
    met = rarest.select("print", c("k").alias("ka")).join(prints.select("print", c("k").alias("kb")), "print").where("ka <> kb").select("ka", "kb")
    far = met.join(many.select(group, c("norm").alias("a"), body.alias("ka")), "ka").join(many.select(c(group).alias("_other"), c("norm").alias("b"), body.alias("kb")), "kb").where(c(group) == c("_other"))
    return near.select(group, "a", "b").unionByName(far.select(group, "a", "b")).where(F.length("a") < F.length("b")).where(F.contains("b", "a"))


def like_pairs(bodies: DataFrame, group: str) -> DataFrame:
    """``group, a, b`` of all bodies of a group of which one is a duplicate of the other.

    Candidates are the contained bodies and those with like first 50 characters; :func:`is_duplicate` decides on each.
    """
    held = contained_pairs(bodies, group)
    heads = bodies.where(F.length("norm") > 30).select(group, "norm", F.substring("norm", 1, 50).alias("head"))
    alike = fuzzy_pairs(heads, "head", 85, group).select(group, F.col("a").alias("head"), F.col("b").alias("other"))
    every = alike.unionByName(heads.select(group, "head", F.col("head").alias("other")).distinct())
    near = heads.withColumnRenamed("norm", "a").join(every, [group, "head"]).join(heads.select(group, F.col("norm").alias("b"), F.col("head").alias("other")), [group, "other"]).where("a <> b").select(group, "a", "b")
    met = held.unionByName(near).select(group, F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()

    @F.pandas_udf("boolean")
    def duplicate(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([is_duplicate(x, [y]) for x, y in zip(a, b, strict=True)], dtype=bool)

    return met.where(duplicate("a", "b"))


def first_of_like(bodies: DataFrame, group: str, order: list[str]) -> DataFrame:
    """The rows that the ordered greedy choice keeps, in rounds: a row with a kept earlier neighbour goes, one with no earlier neighbour left stays."""
    ranked = bodies.select(group, "norm", F.struct(*order, "norm").alias("r"))
    sides = like_pairs(bodies, group).join(ranked.select(group, F.col("norm").alias("a"), F.col("r").alias("ra")), [group, "a"]).join(ranked.select(group, F.col("norm").alias("b"), F.col("r").alias("rb")), [group, "b"])
    earlier = F.col("ra") < F.col("rb")
    edges = materialize(sides.select(group, F.when(earlier, F.col("a")).otherwise(F.col("b")).alias("before"), F.when(earlier, F.col("b")).otherwise(F.col("a")).alias("norm")), "like")
    gone = None
    while edges.limit(1).count():
        # a first one without an earlier neighbour among the undecided is kept; its later neighbours go
        kept = edges.join(edges.select(group, F.col("norm").alias("before")).distinct(), [group, "before"], "left_anti")
        lost = materialize(kept.select(group, "norm").distinct(), "lost")
        gone = lost if gone is None else gone.unionByName(lost)
        edges = materialize(edges.join(lost, [group, "norm"], "left_anti").join(lost.withColumnRenamed("norm", "before"), [group, "before"], "left_anti").select(group, "before", "norm"), "like")
    return bodies if gone is None else bodies.join(gone, [group, "norm"], "left_anti").select(bodies.columns)


def greedy_keep(parts: DataFrame, group: str, order: list[str], buckets: int) -> DataFrame:
    """The rows that strict order keeps within each group; many groups share a bucket, so no group costs a call of its own."""

    def greedy(bucket: pd.DataFrame) -> pd.DataFrame:
        bucket = bucket.sort_values([group, *order, "norm"], kind="stable")
        at, kept, keep = None, [], []
        for g, norm in zip(bucket[group], bucket["norm"], strict=True):
            if g != at:
                at, kept = g, []
            duplicate = is_duplicate(norm, kept)
            keep.append(not duplicate)
            if not duplicate:
                kept.append(norm)
        return bucket[keep]

    dealt = parts.withColumn("_bucket", F.pmod(F.xxhash64(group), F.lit(buckets)))
    return dealt.groupBy("_bucket").applyInPandas(greedy, ", ".join(f"`{n}` {t}" for n, t in dealt.dtypes)).drop("_bucket")


def dedup_messages(messages: DataFrame, group: str, order: list[str], hot: int = 500, keep: list[str] | None = None) -> DataFrame:
    """Greedy fuzzy dedup within each group: the first of like messages stays, in the given order.

    Exact copies go first, natively. What is left of a group (a conversation) is taken by one task; a group of
    more than ``hot`` different bodies is decided in rounds over its like pairs, with the same result. ``keep`` are the
    columns wanted, without it all; ``order`` is among them.
    """
    # as a text a null group is a key like any other
    first = dedup_exact(messages, group, order, keep).withColumn("_g", F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("")))
    first = materialize(first, "dedup")
    large = F.broadcast(first.groupBy("_g").agg(F.count("*").alias("_n")).where(F.col("_n") > hot).select("_g"))
    # a few buckets a task
    buckets = 4 * int(messages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    whole = greedy_keep(first.join(large, "_g", "left_anti").select(first.columns), "_g", order, buckets)
    hot_ones = first.join(large, "_g", "left_semi").select(first.columns)
    if hot_ones.limit(1).count():
        whole = whole.unionByName(first_of_like(hot_ones, "_g", order))
    return whole.drop("_g")


def sort_messages(messages: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``number`` from 1 within each group: by date, undated last, then in the given order.

    The window is over one conversation, the unit that is rendered.
    """
    by = Window.partitionBy(group).orderBy(F.col("date").asc_nulls_last(), *order)
    return messages.withColumn("number", F.row_number().over(by))


def conversation_subject(documents: DataFrame, group: str) -> DataFrame:
    """The most frequent cleaned non-empty subject of each group, the smallest of equals."""
    return documents.where("subject is not null and subject <> ''").groupBy(group).agg(F.mode(subject_norm(F.col("subject")), True).alias("subject"))


def conversation_date_range(dates: DataFrame, group: str) -> DataFrame:
    return dates.groupBy(group).agg(F.min("date").alias("date_min"), F.max("date").alias("date_max"))


def conversation_participants(people: DataFrame, group: str) -> DataFrame:
    """``participants``: the distinct participants of each group, sorted."""
    return people.where("participant <> ''").groupBy(group).agg(F.array_sort(F.collect_set("participant")).alias("participants"))


def conversation_confidence(scores: DataFrame, group: str) -> DataFrame:
    """Mean score of all pairs within a group, pairs below the threshold included; from 50 on ``high``."""
    mean = scores.groupBy(group).agg(F.avg("score").alias("mean_score"))
    return mean.withColumn("confidence", F.when(F.col("mean_score") >= 50, "high").otherwise("probable"))


def participant_collapse(people: DataFrame, group: str) -> DataFrame:
    """One spelling for each participant of a group: the longest, the smallest of equals."""
    cleaned = people.select(group, clean_participant(F.col("participant")).alias("shown")).where("shown <> ''").distinct()
    keyed = cleaned.withColumn("key", participant_key(F.col("shown")))
    # of equally long spellings the smallest: ranked by falling length, then the text
    return keyed.groupBy(group, "key").agg(F.min_by("shown", F.struct((-F.length("shown")).alias("l"), "shown")).alias("shown"))


def conversations(clusters: DataFrame, features: DataFrame, kept: DataFrame, scored: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations of more than one document, and their deduplicated, numbered messages.

    ``clusters`` has ``node, cluster, size``; ``features`` the documents; ``kept`` their messages; ``scored`` ``i, j, score`` of all
    pairs within clusters. Conversations are numbered by first date, undated last, then by their first document.
    """
    multi = clusters.where("size > 1").select(F.col("node").alias("filename"), "cluster")
    docs = multi.join(features, "filename")
    mail = multi.join(kept, "filename")
    unique = dedup_messages(mail, "cluster", ["filename", "msg_idx"])
    ordered = sort_messages(unique, "cluster", ["filename", "msg_idx"])
    people = mail.select("cluster", F.explode(F.array("sender", "recipient")).alias("participant"))
    within = scored.join(multi.select(F.col("filename").alias("i"), "cluster"), "i").join(multi.select(F.col("filename").alias("j"), F.col("cluster").alias("_c")), "j").where("cluster = _c")
    out = docs.groupBy("cluster").agg(F.array_sort(F.collect_set("filename")).alias("documents"))
    for part in (conversation_subject(docs, "cluster"), conversation_date_range(mail, "cluster"), conversation_participants(people, "cluster"), conversation_confidence(within, "cluster"), unique.groupBy("cluster").agg(F.count("*").alias("n_messages"))):
        out = out.join(part, "cluster", "left")
    out = out.withColumn("subject", F.coalesce("subject", F.lit(""))).withColumn("participants", F.coalesce("participants", F.array().cast("array<string>"))).withColumn("n_messages", F.coalesce("n_messages", F.lit(0)))
    return numbered(out, [F.col("date_min").asc_nulls_last(), F.col("cluster").asc()]), ordered


def cluster_pairs(clusters: DataFrame) -> DataFrame:
    """``i, j`` of all pairs within each cluster, of any size."""
    from archivolt.operators.joins import group_pairs

    return group_pairs(clusters.where("size > 1").select("cluster", "node"), "cluster", "node")
