"""Evaluation texts inside a corpus: latent semantic retrieval, then exact checks.

Texts are cut into passages of ``WINDOW`` words, one beginning every ``STEP``
words, so any run of 12 words lies whole in one passage of the document and in one of the item. The terms of a passage are its
pairs of neighbouring words; only pairs that occur in some item can point
towards an item, so the term space is the items' own and its size is bounded by
theirs. A passage of fewer than ``LEAST`` such pairs is about nothing that the
items say and is left out (a run of 12 words brings 11). Document frequencies
count every document.

The TF-IDF matrix of the passages is reduced by a distributed randomised SVD
(Halko, Martinsson, Tropp, 2011): every partition multiplies its rows with a
random matrix and with itself, the sums are added by block of terms in two steps, one QR and
a small eigenproblem follow on the driver. Passages whose latent direction has
a cosine of at least ``cosine`` with an item's passage are candidates, and nothing else is. Of these
the longest common subsequence of the two passages decides: 12 words must follow each other in the same order,
as they do in every run of 12. On the whole texts of what is left the longest
run of consecutive words tells verbatim leaks; a leak without such a run is a
paraphrase if two thirds of an item's passage stand there in order, or half of it and the item's answer near by.

Items are taken in blocks of ``BLOCK_WORDS`` words, longer ones in overlapping parts: the only thing that is broadcast.

Defined results: null and empty texts and items of fewer than ``run`` words match nothing;
repeated rows of one id count once; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from archivolt.llm.texts import words
from archivolt.runtime import materialize

WINDOW, STEP = 24, 12
#: Item pairs, of 23, that a passage must have to be searched for: a third.
LEAST = 8
#: Words of items whose pairs and latent passages are in memory at once.
BLOCK_WORDS = 100_000
#: Width of the random projection, and dimensions kept of it.
SKETCH, DIMENSIONS = 160, 128
_TERM_BLOCK = 2048
#: Groups in which the sums of partitions are added first.
_PARTS = 64


class ItemTerms:
    """Ids of the words and neighbouring pairs of a block of items."""

    def __init__(self, texts: list[list[str]]):
        self.word = {w: i for i, w in enumerate(dict.fromkeys(w for t in texts for w in t))}
        codes = [self.codes(t) for t in texts]
        self.pairs = np.unique(np.concatenate(codes)) if codes else np.empty(0, np.int64)
        self.pairs = self.pairs[self.pairs >= 0]

    def codes(self, ws: list[str]) -> np.ndarray:
        """A number for each pair of neighbours, -1 where a word occurs in no item."""
        get = self.word.get
        ids = np.fromiter((get(w, -1) for w in ws), np.int64, len(ws))
        if len(ids) < 2:
            return np.empty(0, np.int64)
        a, b = ids[:-1], ids[1:]
        return np.where((a >= 0) & (b >= 0), a * len(self.word) + b, -1)

    def terms(self, ws: list[str]) -> np.ndarray:
        """The term of each pair of neighbours, -1 where the pair occurs in no item."""
        codes = self.codes(ws)
        if not len(codes) or not len(self.pairs):
            return np.full(len(codes), -1, np.int32)
        at = np.searchsorted(self.pairs, codes)
        at[at == len(self.pairs)] = 0
        return np.where(self.pairs[at] == codes, at, -1).astype(np.int32)


def windows(n: int) -> range:
    """First words of the passages of a text of n words."""
    return range(0, max(1, n - STEP), STEP)


def _passages(documents: DataFrame, terms: ItemTerms, run: int) -> DataFrame:
    """``id, pos, terms, said, df``: passages with enough item pairs and their words; a row with pos -1 carries document counts of terms."""
    shared = documents.sparkSession.sparkContext.broadcast(terms)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = shared.value
        seen = np.zeros(max(1, len(own.pairs)), np.int64)
        for batch in batches:
            rows = []
            for i, text in zip(batch["id"], batch["text"], strict=True):
                ws = words(text)
                if len(ws) < run:
                    continue
                t = own.terms(ws)
                hit = t >= 0
                seen[np.unique(t[hit])] += 1
                total = np.concatenate(([0], np.cumsum(hit)))
                if total[-1] < LEAST:
                    continue
                for p in windows(len(ws)):
                    q = min(p + WINDOW - 1, len(t))
                    if total[q] - total[p] >= LEAST:
                        rows.append((i, p, np.unique(t[p:q][hit[p:q]]).tolist(), " ".join(ws[p : p + WINDOW]), []))
            yield pd.DataFrame(rows, columns=["id", "pos", "terms", "said", "df"])
        some = np.flatnonzero(seen)
        yield pd.DataFrame({"id": [-1], "pos": [-1], "terms": [some.tolist()], "said": [""], "df": [seen[some].tolist()]})

    return documents.select("id", "text").mapInPandas(cut, "id bigint, pos int, terms array<int>, said string, df array<bigint>")


def _project(rows: list[np.ndarray], weight: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Products of normalised sparse TF-IDF rows with a dense matrix."""
    out = np.zeros((len(rows), basis.shape[1]), np.float32)
    for k, t in enumerate(rows):
        if len(t):
            w = weight[t]
            out[k] = (w / (np.linalg.norm(w) + 1e-12)) @ basis[t]
    return out


def latent_basis(passages: DataFrame, weight: np.ndarray, item_rows: list[np.ndarray], seed: int = 5) -> np.ndarray:
    """Leading right singular vectors of the TF-IDF passages of documents and items (terms x DIMENSIONS)."""
    spark = passages.sparkSession
    n = len(weight)
    width = min(SKETCH, max(1, n))
    omega = np.random.default_rng(seed).standard_normal((n, width)).astype(np.float32)
    shared = spark.sparkContext.broadcast((weight, omega))

    def outer(rows: list[np.ndarray], first: np.ndarray, w: np.ndarray, into: dict[int, np.ndarray]) -> None:
        """Add A^T (A Omega) of these rows, one dense block of terms at a time."""
        y = _project(rows, w, first)
        for k, t in enumerate(rows):
            v = w[t] / (np.linalg.norm(w[t]) + 1e-12)
            for block in np.unique(t // _TERM_BLOCK):
                part = t // _TERM_BLOCK == block
                if block not in into:
                    into[block] = np.zeros((_TERM_BLOCK, first.shape[1]), np.float32)
                into[block][t[part] - block * _TERM_BLOCK] += v[part, None] * y[k]

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        w, om = shared.value
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            outer([np.asarray(t, np.int32) for t in batch["terms"]], om, w, sums)
        part = int(np.random.default_rng().integers(_PARTS))
        yield pd.DataFrame({"block": list(map(int, sums)), "part": part, "m": [s.tobytes() for s in sums.values()]})

    def add(batch: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(m, np.float32) for m in batch["m"])
        return pd.DataFrame({"block": [int(batch["block"].iloc[0])], "m": [total.tobytes()]})

    def added(parts: DataFrame) -> list:
        """The sums of every block: first of some partitions each, then of these sums, so no task meets all partitions."""
        return parts.groupBy("block", "part").applyInPandas(add, "block int, m binary").groupBy("block").applyInPandas(add, "block int, m binary").collect()

    summed = added(passages.select("terms").mapInPandas(partial, "block int, part int, m binary"))
    own: dict[int, np.ndarray] = {}
    outer(item_rows, omega, weight, own)
    y = np.zeros(((n // _TERM_BLOCK + 1) * _TERM_BLOCK, width), np.float32)
    for block, m in [*((r.block, np.frombuffer(r.m, np.float32).reshape(_TERM_BLOCK, width)) for r in summed), *own.items()]:
        y[block * _TERM_BLOCK : (block + 1) * _TERM_BLOCK] += m
    q, _ = np.linalg.qr(y[:n])
    q = q.astype(np.float32)
    basis = spark.sparkContext.broadcast((weight, q))

    def gram(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        w, b = basis.value
        total = np.zeros((b.shape[1], b.shape[1]))
        for batch in batches:
            x = _project([np.asarray(t, np.int32) for t in batch["terms"]], w, b)
            total += x.T @ x
        yield pd.DataFrame({"block": [0], "part": [int(np.random.default_rng().integers(_PARTS))], "m": [total.astype(np.float32).tobytes()]})

    grams = added(passages.select("terms").mapInPandas(gram, "block int, part int, m binary"))
    x = _project(item_rows, weight, q)
    total = x.T @ x + sum(np.frombuffer(r.m, np.float32).reshape(q.shape[1], q.shape[1]) for r in grams)
    values, vectors = np.linalg.eigh(total)
    return q @ vectors[:, np.argsort(values)[::-1][:DIMENSIONS]].astype(np.float32)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def _candidates(documents: DataFrame, total: int, items: list[tuple[int, list[str]]], run: int, cosine: float) -> DataFrame:
    """``item_id, id, common, needed`` of the documents with a passage near one of the item: the longest common subsequence of two near passages and the words of the item's."""
    spark = documents.sparkSession
    terms = ItemTerms([ws for _, ws in items])
    passages = materialize(_passages(documents, terms, run), "passages")
    counts = passages.where("pos = -1").select(F.explode(F.arrays_zip("terms", "df")).alias("z")).groupBy(F.col("z.terms").alias("t")).agg(F.sum("z.df").alias("df")).toPandas()
    df = np.zeros(max(1, len(terms.pairs)))
    df[counts["t"].to_numpy(int)] = counts["df"].to_numpy()
    weight = np.log((2.0 + total) / (1.0 + df)).astype(np.float32)
    passages = passages.where("pos >= 0")
    owners, rows, said = [], [], []
    for item, ws in items:
        t = terms.terms(ws)
        for p in windows(len(ws)):
            owners.append(item)
            rows.append(np.unique(t[p : min(p + WINDOW - 1, len(t))]))
            said.append(ws[p : p + WINDOW])
    basis = latent_basis(passages, weight, rows)
    shared = spark.sparkContext.broadcast((weight, basis, np.array(owners), _unit(_project(rows, weight, basis)), said))

    def near(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        w, b, owner, latent, words_of = shared.value
        masks = [_masks(ws) for ws in words_of]
        for batch in batches:
            for start in range(0, len(batch), 256):
                part = batch.iloc[start : start + 256]
                rows = [np.asarray(t, np.int32) for t in part["terms"]]
                i, j = np.nonzero(_unit(_project(rows, w, b)) @ latent.T >= cosine)
                texts = part["said"].tolist()
                heard = {k: texts[k].split(" ") for k in set(i.tolist())}
                common = np.array([_in_order(masks[q], heard[k], run) for k, q in zip(i.tolist(), j.tolist(), strict=True)], np.int32)
                keep = common >= run
                size = np.array([len(words_of[q]) for q in j[keep]], np.int32)
                yield pd.DataFrame({"item_id": owner[j[keep]], "id": part["id"].to_numpy()[i[keep]], "common": common[keep], "needed": size})

    found = passages.select("id", "terms", "said").mapInPandas(near, "item_id bigint, id bigint, common int, needed int")
    return found.groupBy("item_id", "id").agg(F.max(F.struct((F.col("common") / F.col("needed")).alias("share"), "common", "needed")).alias("m")).select("item_id", "id", "m.common", "m.needed")


def longest_run(a: list[str], b: list[str]) -> int:
    """Length of the longest run of equal consecutive words."""
    where: dict[str, list[int]] = {}
    for j, w in enumerate(b):
        where.setdefault(w, []).append(j)
    best, last = 0, {}
    for w in a:
        now = {}
        for j in where.get(w, ()):
            now[j] = n = last.get(j - 1, 0) + 1
            best = max(best, n)
        last = now
    return best


def _masks(a: list[str]) -> tuple[dict[str, int], int]:
    """The places of every word as bits, and all places."""
    masks: dict[str, int] = {}
    for i, w in enumerate(a):
        masks[w] = masks.get(w, 0) | 1 << i
    return masks, (1 << len(a)) - 1


def _in_order(places: tuple[dict[str, int], int], b: list[str], least: int = 0) -> int:
    """Longest common subsequence with the text of ``places``, 0 if it must be below ``least`` (bit-parallel)."""
    masks, full = places
    hits = [m for w in b if (m := masks.get(w))]
    if len(hits) < least:
        return 0
    v = full
    for m in hits:
        u = v & m
        v = ((v + u) | (v - u)) & full
    return full.bit_count() - v.bit_count()


def common_subsequence(a: list[str], b: list[str]) -> int:
    """Length of the longest common subsequence of words."""
    return _in_order(_masks(a), b)


def _blocks(items: Iterator, run: int) -> Iterator[list[tuple[int, list[str]]]]:
    """Items as (id, words), in blocks of at most ``BLOCK_WORDS`` words; longer items in parts that overlap by a passage."""
    block: list[tuple[int, list[str]]] = []
    size = 0
    for row in items:
        ws = words(row.item_text)
        for at in range(0, max(1, len(ws) - WINDOW), BLOCK_WORDS - WINDOW):
            part = ws[at : at + BLOCK_WORDS]
            if len(part) < run:
                continue
            if size + len(part) > BLOCK_WORDS and block:
                yield block
                block, size = [], 0
            block.append((row.item_id, part))
            size += len(part)
    if block:
        yield block


def leaked_items(documents: DataFrame, items: DataFrame, run: int = 12, cosine: float = 0.3) -> DataFrame:
    """``item_id, id, longest_run, passage_share, subsequence_share, answer_present, kind`` of the documents that hold an item or part of it.

    ``documents`` has ``id, text``; ``items`` has ``item_id, item_text, answer``. ``kind`` is ``verbatim`` from a run of ``run``
    consecutive words on, else ``paraphrase``; ``passage_share`` is the part of the best passage of the item that
    stands in a passage of the document in the same order. The item set is read to the driver in blocks; documents never are.
    """
    asked = items.groupBy("item_id").agg(F.min(F.struct("item_text", "answer")).alias("i")).select("item_id", "i.*").orderBy("item_id")
    spark = documents.sparkSession
    total = documents.count()
    parts = [_candidates(documents, total, block, run, cosine) for block in _blocks(asked.toLocalIterator(), run)]
    found = spark.createDataFrame([], "item_id bigint, id bigint, common int, needed int")
    for part in parts:
        found = found.unionByName(part)
    found = found.groupBy("item_id", "id").agg(F.max(F.struct((F.col("common") / F.col("needed")).alias("share"), "common", "needed")).alias("m")).select("item_id", "id", F.col("m.share").alias("passage_share"))
    found = materialize(found, "near")
    texts = documents.select("id", "text").join(found.select("id").distinct(), "id", "left_semi").dropDuplicates(["id"])
    joined = found.join(texts, "id").join(asked, "item_id")

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for item, i, share, text, asked_text, answer in zip(batch["item_id"], batch["id"], batch["passage_share"], batch["text"], batch["item_text"], batch["answer"], strict=True):
                a, b = words(asked_text), words(text)
                n = longest_run(a, b)
                ans = words(answer)
                present = bool(ans) and any(b[k : k + len(ans)] == ans for k in range(len(b) - len(ans) + 1))
                if n >= run or share >= 2 / 3 or (share >= 0.5 and present):
                    rows.append((item, i, n, share, common_subsequence(a, b) / len(a), present, "verbatim" if n >= run else "paraphrase"))
            yield pd.DataFrame(rows, columns=["item_id", "id", "longest_run", "passage_share", "subsequence_share", "answer_present", "kind"])

    kinds = "item_id bigint, id bigint, longest_run int, passage_share double, subsequence_share double, answer_present boolean, kind string"
    return joined.select("item_id", "id", "passage_share", "text", "item_text", "answer").mapInPandas(check, kinds).distinct()
