"""Secrets in every version of every file, scanned once per content and rule version.

A *ledger* holds a row for each (blob, rule set version) that has been scanned, with the findings.
A blob is a text under its SHA-256 digest, so a text that occurs in many paths or versions is scanned
once, and a later run scans only blobs, or rule versions, it has not seen. Findings are joined
back to all paths. Everything is built-in functions.

A position is found without a loop over the text: ``split`` gives the pieces between the matches of a
pattern and ``regexp_extract_all`` the matches; running sums of their lengths are the places. The sums
are made in parts of ``TOGETHER`` matches, so the time grows with the text and not with its square.

Defined results: a null text is the empty one; a null path or version is kept as it is; repeated
rows are repeated in the findings; an empty table gives no rows; other columns are passed over.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.sources.sinks import materialise


@dataclass(frozen=True)
class Rule:
    """A pattern and the least length of what it finds (of its whole match, or of a group)."""

    kind: str
    pattern: str
    least: int
    group: int = 0


#: Fixed values. In ``hex`` and ``access`` the least length is part of the pattern: a match starts
#: where a run of the characters starts, and a run too short has no part that is long enough.
BASE_RULES = (
    Rule("assign", r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]"""
         r"""|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"""
         r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2),
    Rule("access", r"AKIA[A-Z0-9]{16,}", 20),
    Rule("hex", r"[0-9a-f]{24,}", 24),
)
#: Forms that the base rules have no pattern for.
MORE_RULES = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 20),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{16,}\.[A-Za-z0-9_-]{16,}\.[A-Za-z0-9_-]{16,}", 52),
)
RULES = BASE_RULES + MORE_RULES
RULES_VERSION = 1

#: Matches whose places are found together, so that no array grows match by match with the text.
TOGETHER = 128
FINDINGS = "array<struct<start:long,rank:int,kind:string,`end`:long>>"


def _found(rule: Rule, rank: int, text: Column) -> Column:
    """Findings of one rule as an array of (start, rank, kind, end)."""
    pattern = F.lit(rule.pattern)
    matches = F.regexp_extract_all(text, pattern, F.lit(0))
    measured = F.transform(matches, lambda m: F.length(m))
    judged = (F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), lambda m: F.length(m))
              if rule.group else measured)
    gaps = F.transform(F.split(text, rule.pattern, -1), lambda m: F.length(m))
    steps = F.slice(F.arrays_zip(gaps.alias("gap"), measured.alias("size"), judged.alias("judged")),
                    F.lit(1), F.size(measured))
    none = F.array().cast(FINDINGS)

    def one(start: Column, x: Column) -> Column:
        found = F.array(F.struct(start.alias("start"), F.lit(rank).alias("rank"),
                                 F.lit(rule.kind).alias("kind"), (start + x["size"]).alias("end")))
        return F.when(x["judged"] >= rule.least, found).otherwise(none)

    def places(part: Column, at: Column) -> Column:
        def step(state: Column, x: Column) -> Column:
            start = state["at"] + x["gap"]
            return F.struct((start + x["size"]).alias("at"),
                            F.concat(state["found"], one(start, x)).alias("found"))

        return F.aggregate(part, F.struct(at.alias("at"), none.alias("found")), step,
                           lambda s: s["found"])

    def starts(parts: Column) -> Column:
        """Where the text stands before each part."""
        sizes = F.transform(parts, lambda p: F.aggregate(
            p, F.lit(0).cast("long"), lambda s, x: s + x["gap"] + x["size"]))
        begin = F.array(F.lit(0).cast("long"))
        return F.aggregate(sizes, begin, lambda s, x: F.concat(s, F.array(F.element_at(s, -1) + x)))

    def all_places(s: Column) -> Column:
        # Arrays are bound to a name once: an expression is evaluated wherever it stands.
        count = F.ceil(F.size(s) / TOGETHER).cast("int")
        parts = F.transform(F.sequence(F.lit(1), count), lambda k: F.slice(
            s, (k - 1) * TOGETHER + 1, F.lit(TOGETHER)))
        bound = F.transform(F.array(parts), lambda p: F.arrays_zip(
            p.alias("part"), F.slice(starts(p), F.lit(1), F.size(p)).alias("at")))[0]
        return F.flatten(F.transform(bound, lambda z: places(z["part"], z["at"])))

    # A plain search first: few texts have a match, and only those are split.
    return F.when(F.regexp_like(text, pattern),
                  F.transform(F.array(steps), all_places)[0]).otherwise(none)


def scan(blobs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``findings`` beside every row of ``blobs``, ordered by place, then by the rules' order."""
    parts = [_found(rule, rank, F.col("text")) for rank, rule in enumerate(rules)]
    return blobs.withColumn("findings", F.array_sort(F.concat(*parts)))


def ledger_entries(versions: DataFrame, ledger: DataFrame | None = None,
                   rules: tuple[Rule, ...] = RULES, version: int = RULES_VERSION) -> DataFrame:
    """Rows to append to the ledger (blob, rules_version, findings): what it has not seen yet."""
    text = F.coalesce("text", F.lit(""))
    # Copies of a text meet as the same group, after each task has combined its own.
    blobs = (versions.select(text.alias("text")).withColumn("blob", F.unhex(F.sha2("text", 256)))
             .groupBy("blob").agg(F.first("text").alias("text"))
             .withColumn("rules_version", F.lit(version)))
    if ledger is not None:
        blobs = blobs.join(ledger.select("blob", "rules_version"),
                           ["blob", "rules_version"], "left_anti")
    return scan(blobs, rules).select("blob", "rules_version", "findings")


def path_findings(versions: DataFrame, ledger: DataFrame,
                  version: int = RULES_VERSION) -> DataFrame:
    """Every row of ``versions`` (without its text) with the findings of its blob."""
    text = F.coalesce("text", F.lit(""))
    paths = versions.withColumn("blob", F.unhex(F.sha2(text, 256))).drop("text")
    found = ledger.where((F.col("rules_version") == version) & (F.size("findings") > 0))
    joined = paths.join(found.select("blob", "findings"), "blob", "left")
    return joined.withColumn("findings", F.coalesce("findings", F.array().cast(FINDINGS)))


def scan_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, findings): documents as the first version of paths, against an empty ledger."""
    versions = docs.select("doc_id", "text")
    ledger = materialise(ledger_entries(versions), "ledger")
    return path_findings(versions, ledger).select("doc_id", "findings")


def digest(found: DataFrame) -> DataFrame:
    """The columns of the query: counts and spans of the base rules, and all spans."""
    base = F.filter("findings", lambda f: f["rank"] < len(BASE_RULES))

    def spans(findings: Column) -> Column:
        return F.array_join(F.transform(findings, lambda f: F.concat_ws(
            ":", f["kind"], f["start"], f["end"])), ",")

    def count(rank: int) -> Column:
        return F.size(F.filter("findings", lambda f: f["rank"] == rank)).cast("long")

    return found.select(
        "doc_id", *[count(rank).alias(f"n_{rule.kind}") for rank, rule in enumerate(BASE_RULES)],
        F.sha2(spans(base), 256).alias("base_sha256"), spans(F.col("findings")).alias("spans"))
