"""URL filters: a sort-merge range join of URLs with nested host and path rules.

The host's labels in reverse order, each followed by a dot, make the key: a rule
for a host and its subdomains then is the interval of all keys that its own key
begins.  URLs are sorted by key within each partition (no shuffle) and merged
with the sorted rules; a stack holds the rules whose interval is open.  Of the
open rules whose path begins the URL's, the longest (host and path together)
decides; of equal ones the one with the longer host.

Rules come as a list of (verdict, host, path).  ``block_rules`` bounds what is
broadcast at a time: longer lists are merged in several passes, each keeping the
longest rule so far.

Defined results: a null URL, or one without ``://``, has an empty host and path,
fits no rule and gets the method's own verdict ``default``, as does every URL that
no rule fits.  Rows are handled one by one; other columns pass through.  A rule
given twice counts once; of two verdicts for one host and path, block wins.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLOCK_RULES = 200_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_key(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def _key(host: str) -> str:
    return ".".join(reversed(host.split("."))) + "."


def sorted_rules(rules: list[tuple[str, str, str]]) -> list[tuple[str, str, dict[str, str]]]:
    """(key, host, {path: verdict}) in key order."""
    by_host: dict[str, dict[str, str]] = {}
    for verdict, host, path in rules:
        paths = by_host.setdefault(host.lower(), {})
        if paths.get(path) != "block":
            paths[path] = verdict
    return sorted((_key(host), host, paths) for host, paths in by_host.items())


class Sweep:
    """Merges keys, given in ascending order, with the sorted rules."""

    def __init__(self, rules):
        self.rules, self.next, self.open, self.last = rules, 0, [], None
        self.lengths = [sorted({len(p) for p in paths}, reverse=True) for _, _, paths in rules]

    def at(self, key: str) -> list[tuple[str, dict[str, str], list[int]]]:
        """The rules open at ``key``, outermost first."""
        if key != self.last:
            while self.open and not key.startswith(self.open[-1][0]):
                self.open.pop()
            while self.next < len(self.rules) and self.rules[self.next][0] <= key:
                start, host, paths = self.rules[self.next]
                if key.startswith(start):
                    self.open.append((start, host, paths, self.lengths[self.next]))
                self.next += 1
            self.last = key
        return self.open

    def best(self, key: str, path: str) -> tuple[str, str, int] | None:
        """(rule, verdict, length) of the longest rule for this URL."""
        found = None
        for _, host, paths, lengths in self.at(key):
            n = next((n for n in lengths if n <= len(path) and path[:n] in paths), None)
            if n is not None and (found is None or len(host) + n >= found[2]):
                found = (host + path[:n], paths[path[:n]], len(host) + n)
        return found


def judge_urls(
    pages: DataFrame,
    rules: list[tuple[str, str, str]],
    url: str = "url",
    default: str = "allow",
    block_rules: int = BLOCK_RULES,
) -> DataFrame:
    """``pages`` with ``__host``, ``__path``, ``__rule`` and ``__verdict``."""
    names = pages.columns
    out = pages.select(
        *names,
        url_host(F.col(url)).alias("__host"),
        url_path(F.col(url)).alias("__path"),
        F.lit(None).cast("string").alias("__rule"),
        F.lit(default).alias("__verdict"),
        F.lit(-1).alias("__length"),
    ).withColumn("__key", host_key(F.col("__host")))
    ordered = sorted_rules(rules)
    for at in range(0, len(ordered), block_rules):
        out = _merge(out.sortWithinPartitions("__key"), ordered[at : at + block_rules])
    return out.select(*names, "__host", "__path", "__rule", "__verdict")


def _merge(out: DataFrame, block: list) -> DataFrame:
    shared = out.sparkSession.sparkContext.broadcast(block)

    def run(batches):
        sweep = Sweep(shared.value)
        for part in batches:
            held = {c: part.column(part.schema.get_field_index(c)).to_pylist() for c in ("__key", "__path", "__rule", "__verdict", "__length")}
            rows = []
            for key, path, rule, verdict, length in zip(*held.values(), strict=True):
                best = sweep.best(key, path)
                rows.append(best if best and best[2] >= length else (rule, verdict, length))
            new = {
                "__rule": pa.array([r[0] for r in rows], pa.string()),
                "__verdict": pa.array([r[1] for r in rows], pa.string()),
                "__length": pa.array([r[2] for r in rows], pa.int32()),
            }
            yield pa.RecordBatch.from_arrays(
                [new.get(c, part.column(i)) for i, c in enumerate(part.schema.names)], names=part.schema.names
            )

    fields = [T.StructField(f.name, f.dataType, True) for f in out.schema.fields]
    return out.mapInArrow(run, T.StructType(fields))
