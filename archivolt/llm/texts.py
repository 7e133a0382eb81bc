"""Words, shingles and hashes shared by the text operators (numpy, one Arrow batch at a time)."""

from __future__ import annotations

import re

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from archivolt.runtime import spread, table

# Words are runs of letters and digits; combining marks are part of a word, the underscore is not.
_PLAIN = re.compile(r"[^\W_]+")
_MARKED = re.compile("(?:[^\\W_]|[̀-ͯ᪰-᫿᷀-᷿⃐-⃿︠-︯])+")
_HAS_MARK = re.compile("[̀-ͯ᪰-᫿᷀-᷿⃐-⃿︠-︯]")

_K = tuple(np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F))


def words(text: str | None) -> list[str]:
    """Lower-cased words of a text; none for null."""
    if not text:
        return []
    low = text.lower()
    return (_MARKED if not low.isascii() and _HAS_MARK.search(low) else _PLAIN).findall(low)


class WordHashes(dict):
    """64-bit hashes of words, computed once each; emptied when it grows past ``limit``."""

    limit = 1_000_000

    def __missing__(self, word: str) -> int:
        if len(self) > self.limit:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h

    def of(self, ws: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, ws), np.uint64, len(ws))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (each output bit depends on each input bit)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def ngram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` words, in order."""
    if len(h) < n:
        return np.empty(0, np.uint64)
    out = np.zeros(len(h) - n + 1, np.uint64)
    for i in range(n):
        out = mix(out * _K[0] + h[i : len(h) - n + 1 + i] * _K[1] + _K[2])
    return out


def text_class(*columns: Column) -> Column:
    """A 64-bit class of equal texts; a chance collision is told apart by :func:`digest`."""
    return F.xxhash64(*columns)


def digest(text: Column) -> Column:
    return F.unhex(F.md5(text))


def records(spark, folder: str, names: str = "dm") -> DataFrame:
    """``rec, id, text`` of documents (``d``), messages (``m``) and search results (``s``); copies of a delivery are not yet merged."""
    sources = {"d": ("documents", "doc_id", "text"), "m": ("messages", "msg_id", "body"), "s": ("search_results", "hit_id", "context")}
    parts = [spread(table(spark, folder, t).select(F.lit(rec).alias("rec"), F.col(key).alias("id"), F.col(text).alias("text"))) for rec, (t, key, text) in sources.items() if rec in names]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
