"""Mixing sources to target weights, measured in tokens of a public tokenizer.

Every record gets a hash-random key. Within a source the keys are range
partitioned (equal ranges of the hash), token counts are summed per range, and a
running sum over the ranges finds the range in which the source's budget ends;
only that range is ordered record by record. So no source, however large, is
sorted or summed in one task. A source whose budget exceeds its size is taken
whole as often as it fits (an epoch each) and the last epoch is cut.

Defined results: with no ``total`` the mixture is the largest in which every
source still reaches its share within its repeat cap. With a larger ``total`` a
capped source gives cap times its tokens and the report shows what it reached.
Sources without target, or with null, zero or negative share, give nothing;
a target source without tokens is reported with zero and set aside when the
total is chosen. Null and empty texts have no tokens and are left out. The cut
takes the record that crosses the budget only if that comes nearer. Repeated
rows of one id count once.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from archivolt.runtime import materialize

TOKENIZERS = "/opt/tokenizers"
#: Ranges of the random key in each source; the report's running sums are over sources x RANGES rows.
RANGES = 1024


def token_counts(documents: DataFrame, folder: str = TOKENIZERS, vocabulary: str = "byte_bpe_50k.tiktoken") -> DataFrame:
    """``documents`` (``id, source, text``) to ``id, source, tokens``; the vocabulary must lie at ``folder`` on every worker."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import importlib.util

        import tiktoken

        spec = importlib.util.spec_from_file_location("public_tokenizers_at", Path(folder) / "__init__.py")
        public = importlib.util.module_from_spec(spec)
        spec.loader.exec_module(public)
        with open(Path(folder) / vocabulary, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        coder = tiktoken.Encoding("public", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})
        for batch in batches:
            texts = batch["text"].fillna("")
            tokens = [len(coder.encode_ordinary(t)) for t in texts]
            yield batch[["id", "source"]].assign(tokens=tokens)

    return documents.select("id", "source", "text").mapInPandas(count, "id bigint, source string, tokens int")


def _plan(sizes: DataFrame, targets: DataFrame, total: float | None) -> DataFrame:
    """One row a target source: budget and cap in tokens. The target table has one row a source."""
    wanted = targets.groupBy("source").agg(F.max("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats")).where("target_share > 0 and source is not null")
    rows = wanted.join(sizes, "source", "left").withColumn("available", F.coalesce("available", F.lit(0))).withColumn("max_repeats", F.greatest(F.coalesce("max_repeats", F.lit(1)), F.lit(0)))
    everything = Window.partitionBy()
    usable = F.sum(F.when((F.col("available") > 0) & (F.col("max_repeats") > 0), F.col("target_share"))).over(everything)
    share = F.when((F.col("available") > 0) & (F.col("max_repeats") > 0), F.col("target_share") / usable).otherwise(F.lit(0.0))
    rows = rows.withColumn("share", share).withColumn("cap", F.col("max_repeats") * F.col("available"))
    largest = F.min(F.when(F.col("share") > 0, F.col("cap") / F.col("share"))).over(everything)
    whole = F.coalesce(largest, F.lit(0.0)) if total is None else F.lit(float(total))
    return rows.withColumn("budget", F.least(F.col("cap").cast("double"), F.col("share") * whole)).withColumn("capped", F.col("cap") < F.col("share") * whole - 0.5)


def mix_sources(counted: DataFrame, targets: DataFrame, total: float | None = None, seed: int = 17) -> tuple[DataFrame, DataFrame]:
    """The mixture and its report.

    ``counted`` has ``id, source, tokens``. Returns ``(id, source, tokens, repeats)`` of
    the chosen records and one report row a target source: ``source, target_share,
    max_repeats, available, tokens, repeats_used, actual_share, capped``.
    """
    once = counted.where("tokens > 0 and source is not null").groupBy("id").agg(F.max(F.struct("source", "tokens")).alias("r")).select("id", "r.*")
    keyed = once.withColumn("key", F.xxhash64(F.lit(seed), F.col("id"))).withColumn("range", F.shiftrightunsigned("key", 64 - RANGES.bit_length() + 1).cast("int"))
    keyed = materialize(keyed, "keyed")
    ranges = keyed.groupBy("source", "range").agg(F.sum("tokens").alias("tokens"))
    # sources x RANGES rows at most: a running sum over the ranges of one source
    along = Window.partitionBy("source").orderBy("range")
    ranges = ranges.withColumn("before", F.sum("tokens").over(along) - F.col("tokens"))
    plan = _plan(ranges.groupBy("source").agg(F.sum("tokens").alias("available")), targets, total)
    plan = plan.withColumn("epochs", F.when(F.col("available") > 0, F.floor(F.col("budget") / F.col("available"))).otherwise(F.lit(0)).cast("int")).withColumn("rest", F.col("budget") - F.col("epochs") * F.col("available"))
    plan = materialize(plan, "plan")
    cuts = ranges.join(plan.select("source", "epochs", "rest"), "source")
    side = F.when(F.col("before") + F.col("tokens") <= F.col("rest"), 1).when(F.col("before") >= F.col("rest"), 0).otherwise(-1)
    cuts = cuts.select("source", "range", "before", "epochs", "rest", side.alias("side"))
    placed = keyed.join(cuts, ["source", "range"])
    clear = placed.where("side >= 0").select("id", "source", "tokens", (F.col("epochs") + F.col("side")).alias("repeats"))
    # one range a source is cut: it is parted once more by the next bits of its keys, and only one part is sorted
    bits = RANGES.bit_length() - 1
    edge = placed.where("side = -1").withColumn("part", F.shiftrightunsigned(F.shiftleft("key", bits), 64 - bits).cast("int"))
    parts = edge.groupBy("source", "part").agg(F.sum("tokens").alias("held")).withColumn("sofar", F.sum("held").over(Window.partitionBy("source").orderBy("part")) - F.col("held"))
    edge = edge.join(parts, ["source", "part"]).withColumn("begin", F.col("before") + F.col("sofar"))
    lies = F.when(F.col("begin") + F.col("held") <= F.col("rest"), 1).when(F.col("begin") >= F.col("rest"), 0)
    clear = clear.unionByName(edge.where(lies.isNotNull()).select("id", "source", "tokens", (F.col("epochs") + lies).alias("repeats")))
    inside = Window.partitionBy("source", "part").orderBy("key", "id")
    edge = edge.where(lies.isNull()).withColumn("end", F.col("begin") + F.sum("tokens").over(inside))
    taken = (F.col("end") - F.col("tokens") / 2 <= F.col("rest")).cast("int")
    edge = edge.select("id", "source", "tokens", (F.col("epochs") + taken).alias("repeats"))
    chosen = clear.unionByName(edge).where("repeats > 0")
    got = chosen.groupBy("source").agg(F.sum(F.col("tokens") * F.col("repeats")).alias("tokens"), F.max("repeats").alias("repeats_used"))
    report = plan.join(got, "source", "left").withColumn("tokens", F.coalesce("tokens", F.lit(0)))
    share = F.col("tokens") / F.nullif(F.sum("tokens").over(Window.partitionBy()), F.lit(0))
    report = report.select("source", "target_share", "max_repeats", "available", "tokens", F.coalesce("repeats_used", F.lit(0)).alias("repeats_used"), share.alias("actual_share"), "capped")
    return chosen, report
