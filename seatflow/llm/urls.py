"""URL rules in a sorted digest array: 64-bit xxhash keys, memory-mapped and probed by binary search.

A rule is `host/path`; it fits its host and all subdomains when the URL's path starts with the rule's
path; the longest rule wins. Keys of all (host suffix, path prefix) pairs of a URL whose path prefix
has the length of some rule's path are probed at once, and a hit counts only if the stored full
string is the probed one. The array and its strings lie in files that every executor fetches once and
maps: memory follows the pages that are touched, not the length of the list.

NULL URLs and URLs without `://` have an empty host and path, which no rule fits; they get the default
verdict. An empty rule list fits nothing; of repeated rules the first counts. Other columns of the table are kept
out of the result.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from seatflow.llm.files import mapped, ship

HOST = r"^[\s\S]*?://([^/?#]*)"
PATH = r"^[\s\S]*?://[^/?#]*([^?#]*)"
_FILES = ("keys", "ends", "names", "blocks", "lengths")


def parts(url) -> tuple:
    """Columns for the host, lower-cased in A-Z, and the path of a URL."""
    url = F.coalesce(url, F.lit(""))
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(F.regexp_extract(url, HOST, 1), upper, lower), F.regexp_extract(url, PATH, 1)


class DigestArray:
    """Sorted 64-bit keys with the strings that they stand for."""

    def __init__(self, name: str):
        self.keys, self.ends = mapped(name, "keys", "<u8"), mapped(name, "ends", "<i8")
        self.names, self.blocks = mapped(name, "names", "u1"), mapped(name, "blocks", "u1")
        self.lengths = mapped(name, "lengths", "<i8").tolist()

    @staticmethod
    def write(rules: Iterable[tuple[str, bool]], folder: str) -> None:
        """Files of (rule, whether it blocks); `rule` is `host/path`."""
        first: dict[str, bool] = {}
        for rule, blocks in rules:
            host, _, path = rule.partition("/")
            first.setdefault(f"{host.lower()}/{path}", blocks)
        keyed = sorted((xxhash.xxh64_intdigest(name.encode()), name, blocks) for name, blocks in first.items())
        names = [name.encode() for _, name, _ in keyed]
        paths = sorted({len(name) - name.index("/") for name in first})
        for name, array in zip(_FILES, (
            np.array([k for k, _, _ in keyed], "<u8"), np.cumsum([0, *map(len, names)]).astype("<i8"),
            np.frombuffer(b"".join(names), "u1"), np.array([b for _, _, b in keyed], "u1"), np.array(paths, "<i8"),
        ), strict=True):
            array.tofile(os.path.join(folder, name))

    def find(self, probes: list[bytes]) -> np.ndarray:
        """The place of each probed string, or -1. Equal keys lie side by side and are all compared."""
        out = np.full(len(probes), -1, np.int64)
        if not len(self.keys) or not probes:
            return out
        keys = np.fromiter((xxhash.xxh64_intdigest(p) for p in probes), np.uint64, len(probes))
        low = np.searchsorted(self.keys, keys, "left")
        high = np.searchsorted(self.keys, keys, "right")
        for i in np.flatnonzero(high > low):
            for at in range(low[i], high[i]):
                if self.names[self.ends[at] : self.ends[at + 1]].tobytes() == probes[i]:
                    out[i] = at
                    break
        return out

    def name(self, at: int) -> str:
        return self.names[self.ends[at] : self.ends[at + 1]].tobytes().decode()


def probes_of(host: str, path: str, lengths: list[int]) -> list[bytes]:
    """All strings whose rule would fit this host and path."""
    if not host or not path:
        return []
    suffixes = [host, *(host[m.end() :] for m in re.finditer(r"\.", host))]
    prefixes = [path[:n] for n in lengths if n <= len(path)]
    return [(s + p).encode() for s in suffixes if s for p in prefixes]


def judged(pages: DataFrame, rules: list[tuple[str, bool]], default_blocks: bool = False) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every row of `pages` (page_id, url); ids of any type, NULL or repeated, pass through."""
    name = ship(pages.sparkSession, lambda folder: DigestArray.write(rules, folder))
    default = "block" if default_blocks else "allow"

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        array = DigestArray(name)
        for batch in batches:
            probes, owner = [], []
            for i, (host, path) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)):
                own = probes_of(host, path, array.lengths)
                probes += own
                owner += [i] * len(own)
            best: dict[int, tuple[int, int]] = {}
            found = array.find(probes)
            for j in np.flatnonzero(found >= 0):
                best[owner[j]] = max(best.get(owner[j], (0, 0)), (len(probes[j].decode()), int(found[j])))
            rule = [array.name(best[i][1]) if i in best else None for i in range(len(batch))]
            verdict = [("block" if array.blocks[best[i][1]] else "allow") if i in best else default for i in range(len(batch))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(rule, pa.string()), pa.array(verdict, pa.string())], [*batch.schema.names, "rule", "verdict"])

    host, path = parts(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    return rows.mapInArrow(judge, StructType([*rows.schema.fields, *StructType.fromDDL("rule string, verdict string").fields]))
