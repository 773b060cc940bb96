"""Secret scans with an incremental blob ledger, in DataFrame and SQL functions only.

Every historical version of a path is content-addressed (SHA-256 of its text), so a text
kept under many paths or versions is one blob.  The ledger holds the (blob, rule version)
pairs scanned before; only unseen pairs are scanned, and findings join back to all paths.

Spans are code points, end exclusive.  A regular expression gives its matches
(``regexp_extract_all``) and what stands between them (``split``); running sums of both
lengths give the positions, so all leftmost non-overlapping matches are placed exactly.

Defined cases: null text is empty and has no finding; null paths are scanned and keep their
findings; repeated rows keep theirs; an empty table gives empty tables; input columns other
than the path and the text are ignored by ``scan`` and kept by ``join_paths`` (but for one named
``found``) and ``redact``.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from martlake.llm._common import fresh


@dataclass(frozen=True)
class Rule:
    """``pattern`` finds leftmost non-overlapping matches; a match counts when its ``group``
    has ``least`` characters or more.  A new ``version`` makes the ledger scan anew."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    version: int = 1

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


# The base kinds, in their listed order, then further well-known token forms.
BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         group=2, least=6),
    Rule("access", r"AKIA[A-Z0-9]+", least=20),
    # runs below 24 can't count, and a longer run is matched whole either way
    Rule("hex", r"[0-9a-f]{24,}"),
)
RULES = BASE + (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{5,}"),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)

FINDING = "array<struct<rule:int,between:array<int>,size:array<int>,counts:array<boolean>>>"


def content_address(text: Column) -> Column:
    return F.sha2(F.coalesce(text.cast("string"), F.lit("")), 256)


def blobs(versions: DataFrame, text_col: str) -> DataFrame:
    """``(blob, text)``: each distinct text once (partial aggregation collapses copies first)."""
    return (versions.select(content_address(F.col(text_col)).alias("blob"),
                            F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
            .groupBy("blob").agg(F.first("text").alias("text")))


def _place(i: int, rule: Rule) -> Column:
    """Lengths of the matches of one rule and of what precedes each."""
    re = F.lit(rule.pattern)
    text = F.col("text")
    match = F.regexp_extract_all(text, re, F.lit(0))
    part = F.regexp_extract_all(text, re, F.lit(rule.group)) if rule.group else match
    return F.when(F.array_contains("todo", rule.key) & F.regexp_like(text, re), F.struct(
        F.lit(i).alias("rule"),
        F.transform(F.split(text, rule.pattern, -1), lambda x: F.char_length(x)).alias("between"),
        F.transform(match, lambda x: F.char_length(x)).alias("size"),
        F.transform(part, lambda x: F.char_length(x) >= rule.least).alias("counts")))


def scan(versions: DataFrame, text_col: str = "text", ledger: DataFrame | None = None,
         rules: tuple[Rule, ...] = RULES) -> tuple[DataFrame, DataFrame]:
    """Scan the unseen (blob, rule version) pairs of ``versions``.

    ``ledger(blob, rule)`` lists the pairs seen.  Returns ``(findings, scanned)``:
    ``findings(blob, kind, rule, start, end)`` of the new pairs, and the pairs to add to
    the ledger.
    """
    every = F.array(*[F.lit(r.key) for r in rules])
    todo = blobs(versions, text_col)
    if ledger is None:
        todo = todo.withColumn("todo", every)
    else:
        seen = ledger.groupBy("blob").agg(F.collect_set("rule").alias("seen"))
        todo = (todo.join(seen, "blob", "left")
                .withColumn("todo", F.array_except(every, F.coalesce("seen", F.array().cast("array<string>"))))
                .filter(F.size("todo") > 0))
    scanned = todo.select("blob", F.explode("todo").alias("rule"))
    found = (todo.select("blob", F.explode(F.array_compact(F.array(*[_place(i, r) for i, r in enumerate(rules)]))
                                           .cast(FINDING)).alias("x")).select("blob", "x.*"))
    one = found.select("blob", "rule", F.posexplode(F.arrays_zip("size", "between", "counts")).alias("at", "m"))
    # split gives one piece more than there are matches; the last has no match behind it
    one = one.select("blob", "rule", "at", "m.*").filter("size is not null")
    before = Window.partitionBy("blob", "rule").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("size").cast("long") + F.col("between")).over(before)
    names, keys = (F.array(*[F.lit(v) for v in x]) for x in ([r.kind for r in rules], [r.key for r in rules]))
    findings = (one.withColumn("end", end).withColumn("start", F.col("end") - F.col("size")).filter("counts")
                .select("blob", F.element_at(names, F.col("rule") + 1).alias("kind"),
                        F.element_at(keys, F.col("rule") + 1).alias("rule"), "start", "end"))
    return findings, scanned


def by_blob(findings: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row a blob: its spans ``(start, place of the kind in rules, end, kind)`` in order."""
    place = F.create_map(*[F.lit(v) for i, r in enumerate(rules) for v in (r.kind, i)])
    return findings.groupBy("blob").agg(F.array_sort(F.collect_list(
        F.struct("start", place[F.col("kind")].alias("place"), "end", "kind"))).alias("found"))


def span_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def join_paths(versions: DataFrame, per_blob: DataFrame, text_col: str = "text") -> DataFrame:
    """All rows of ``versions`` with ``found``, the spans of their blob (empty if none); a column of
    that name in ``versions`` gives way to it."""
    versions = versions.drop(*[c for c in versions.columns if c.lower() == "found"])
    name = fresh(versions, "blob")
    empty = F.array().cast("array<struct<start:bigint,place:int,end:bigint,kind:string>>")
    return (versions.withColumn(name, content_address(F.col(text_col)))
            .join(per_blob.withColumnRenamed("blob", name), name, "left").drop(name)
            .withColumn("found", F.coalesce("found", empty)))


def redact(docs: DataFrame, text_col: str = "text", mask: str = "[SECRET]", rules: tuple[Rule, ...] = RULES,
           length_col: str | None = None) -> DataFrame:
    """``docs`` (all columns) with every span, overlapping ones as one, replaced by ``mask``;
    ``length_col``, if given, gets the new number of code points where a text changed."""
    text = F.col(text_col)
    suspect = F.coalesce(reduce(lambda a, b: a | b, [F.regexp_like(text.cast("string"), F.lit(r.pattern)) for r in rules]), F.lit(False))
    # only texts that match a rule are dealt by content; all others pass through where they lie
    clean, docs = docs.filter(~suspect), docs.filter(suspect)
    findings, _ = scan(docs, text_col, None, rules)
    order = Window.partitionBy("blob").orderBy("start", "end")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    merged = (findings.withColumn("fresh", F.when(F.coalesce(reach, F.lit(-1)) < F.col("start"), 1).otherwise(0))
              .withColumn("run", F.sum("fresh").over(order.rowsBetween(Window.unboundedPreceding, 0)))
              .groupBy("blob", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"))
              .groupBy("blob").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("cuts")))
    blob, name = fresh(docs, "blob"), fresh(docs, "cuts")
    text, cuts = F.col(text_col), F.col(name)
    ends = F.concat(F.array(F.lit(0).cast("long")), F.transform(cuts, lambda c: c["end"]))
    pieces = F.zip_with(cuts, F.slice(ends, F.lit(1), F.size(cuts)),
                        lambda c, e: F.substring(text, e.cast("int") + 1, (c["start"] - e).cast("int")))
    rest = F.substring(text, F.element_at(ends, -1).cast("int") + 1, F.char_length(text))
    new = F.array_join(F.concat(pieces, F.array(rest)), mask)
    out = (docs.withColumn(blob, content_address(text)).join(merged.toDF(blob, name), blob, "left")
           .withColumn(text_col, F.when(cuts.isNull(), text).otherwise(new)))
    if length_col:
        size = F.char_length(text_col).cast(docs.schema[length_col].dataType)
        out = out.withColumn(length_col, F.when(cuts.isNull(), F.col(length_col)).otherwise(size))
    return clean.unionByName(out.select(*docs.columns))
