"""Secret scans over a ledger of blobs: every text version is scanned once per rule version."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackside.llm import filters
from trackside.llm.groups import attach
from trackside.llm.store import keep

SPANS = "array<struct<start:int,end:int,kind:string>>"
FINDINGS = f"blob binary, rule string, version int, spans {SPANS}"


@dataclass(frozen=True)
class Rule:
    """A kind of secret. A change of pattern or length needs a new ``version``.

    ``group`` must have ``least`` characters. Of ``hints``, lower-case strings, a text with a match
    has one at least, and in it ``needs`` is found: both only save time.
    """

    name: str
    version: int
    pattern: str
    group: int
    least: int
    hints: tuple[str, ...] = ()
    needs: str = ""


#: The base rules, in the order of their names in reports. Fixed values.
RULES = (
    Rule(
        "assign", 1,
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2, 8, ("passw", "secret", "token", "api"),
    ),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 16, ("akia",)),
    Rule("hex", 1, r"[0-9a-f]+", 0, 32, needs=r"[0-9a-f]{32}"),
)


def scan(text: str, rule: Rule, pattern: re.Pattern[str], low: str) -> list[tuple[int, int]]:
    """The matches of a rule in a text: leftmost, not overlapping, long enough; code points."""
    if rule.hints and not any(hint in low for hint in rule.hints):
        return []
    if rule.needs and not re.search(rule.needs, text):
        return []
    return [
        m.span() for m in pattern.finditer(text) if len(m.group(rule.group)) >= rule.least
    ]


def _ledger(df: DataFrame, path: str | None) -> DataFrame:
    """What earlier runs have scanned; nothing if there was none."""
    empty = df.sparkSession.createDataFrame([], FINDINGS)
    if path is None:
        return empty
    try:
        return df.sparkSession.read.schema(FINDINGS).parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return empty


def scan_versions(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    rules: tuple[Rule, ...] = RULES, ledger: str | None = None,
) -> DataFrame:
    """One row for each document (a path's version): ``id, blob, spans`` (start, end, kind).

    A text's blob is the SHA-256 of its UTF-8 bytes; null is the empty text. ``ledger`` is a folder that remembers
    which (blob, rule, version) have been scanned and what was found. Only pairs that it lacks
    are scanned, one text for each blob, and are added to it; the findings of all rules in force
    are then joined back to every document with the blob. Without a folder every blob is new.

    Blobs are grouped as digests, never as texts: texts stay where they are, and a filter of
    the (blob, id) to scan picks them there. A pair that passes the filter by chance is scanned
    for nothing, and counted once. A blob may be that of any part of all documents. Rows that repeat an id
    are versions of their own. Spans are in code points, end exclusive, by start, then in the order of the rules.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    versions = docs.select(
        F.col(f"`{id_col}`").alias("id"), F.unhex(F.sha2(text, 256)).alias("blob"), text.alias("text")
    )
    paths = keep(versions.select("id", "blob"), "paths")
    total = paths.count()
    blobs = keep(
        paths.groupBy("blob").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("paths")), "blobs"
    )
    force = spark.sql("select * from values " + ", ".join(
        f"({i}, '{r.name}', {r.version})" for i, r in enumerate(rules)
    ) + " as t(place, rule, version)")
    known = _ledger(docs, ledger).join(F.broadcast(force), ["rule", "version"])
    done = keep(
        known.join(blobs.select("blob"), "blob", "left_semi").select("blob", "place", "spans"), "done"
    )
    scanned = done.groupBy("blob").agg(F.collect_set("place").alias("places"))
    todo = keep(
        blobs.join(scanned, "blob", "left").select("id", "blob", F.array_sort(F.array_except(
            F.array(*[F.lit(i) for i in range(len(rules))]),
            F.coalesce("places", F.array().cast("array<int>")),
        )).alias("places")).filter(F.size("places") > 0),
        "todo",
    )
    # Blobs that need the same rules share a filter; there are few such lists, mostly one.
    pair = F.struct("id", "blob")
    blocks = filters.blocks_for(todo.count())
    chosen, needed = versions, []
    for i, row in enumerate(todo.select("places").distinct().collect()):
        part = todo.filter(F.col("places") == F.lit(row.places)).select(pair.alias("pair"))
        chosen = filters.flagged(
            chosen, filters.seen(part, "pair", blocks), pair, blocks, f"list_{i}"
        )
        needed.append(F.when(F.col(f"list_{i}"), F.lit(row.places)))
    none = F.array().cast("array<int>")
    places = F.array_distinct(F.flatten(F.array_compact(F.array(none, *needed))))

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        patterns = [re.compile(r.pattern, re.ASCII) for r in rules]
        for batch in batches:
            rows = []
            for blob, text, places in zip(*(batch[c] for c in batch.columns), strict=True):
                low = text.lower()
                rows += [
                    (blob, i, [
                        {"start": s, "end": e, "kind": rules[i].name}
                        for s, e in scan(text, rules[i], patterns[i], low)
                    ])
                    for i in map(int, places)
                ]
            yield pd.DataFrame(rows, columns=["blob", "place", "spans"])

    # A blob may have been scanned twice, chosen by chance; all scans of it are alike.
    found = keep(
        chosen.select("blob", "text", places.alias("places")).filter(F.size("places") > 0)
        .mapInPandas(search, f"blob binary, place int, spans {SPANS}"),
        "scans",
    )
    if ledger is not None:
        wanted = todo.select("blob", F.explode("places").alias("place"))
        found = found.join(wanted, ["blob", "place"], "left_semi")
        new = found.dropDuplicates(["blob", "place"]).join(F.broadcast(force), "place")
        new.select("blob", "rule", "version", "spans").write.mode("append").parquet(ledger)
    order = F.create_map(*[F.lit(x) for i, r in enumerate(rules) for x in (r.name, i)])
    by_place = F.array_sort(F.transform("spans", lambda x: F.struct(
        x["start"].alias("start"), order[x["kind"]].alias("place"), x.alias("span")
    )))
    secrets = (
        found.unionByName(done).filter(F.size("spans") > 0).dropDuplicates(["blob", "place"])
        .groupBy("blob").agg(F.flatten(F.collect_list("spans")).alias("spans"))
        .select("blob", F.transform(by_place, lambda x: x["span"]).alias("spans"))
    )
    verdict = keep(
        blobs.join(secrets, "blob", "left").select(
            "blob", "paths", F.coalesce("spans", F.array().cast(SPANS)).alias("spans")
        ),
        "verdicts",
    )
    return attach(paths, verdict, "blob", "paths", total).select("id", "blob", "spans")
