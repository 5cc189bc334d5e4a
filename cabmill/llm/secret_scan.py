"""Secret scan with a ledger of blobs: content is scanned once per rule version.

Every version of every path is addressed by the SHA-256 of its text. A blob is scanned only by
the rules (name and version) that the ledger does not list for it; its findings are appended to
the ledger and joined back to all paths and versions that hold the blob. Only DataFrame functions
run: matches come from ``regexp_extract_all``, their places from the pieces between them.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cabmill.llm.common import Work, chosen, read


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of ``pattern`` whose ``group`` has ``least`` characters."""

    name: str
    version: int
    pattern: str
    group: int = 0
    least: int = 1

    @property
    def key(self) -> str:
        return f"{self.name}@{self.version}"


# The three base rules. A run of one class of characters is matched whole either
# way, so its least length may stand in the pattern; that of an assigned value may not, as a value
# that is too short still uses up its characters.
ASSIGN = Rule(
    "assign", 1,
    r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    2, 12,
)
ACCESS = Rule("access", 1, "AKIA[A-Z0-9]{14,}")
HEX = Rule("hex", 1, "[0-9a-f]{16,}")
BASE = (ASSIGN, ACCESS, HEX)
# Further rules of our own.
RULES = (
    *BASE,
    Rule("pem", 1, r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("bearer", 1, r"Bearer\x20+[A-Za-z0-9._~+/-]{20,}"),
)

_SPANS = "array<struct<rule:string,start:long,end:long>>"


def blob_of(text: Column) -> Column:
    """Address of a text; null counts as empty."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def _matches(rule: Rule) -> Column:
    """(rule, gap, length, value) per match: gap is what lies between it and the match before."""
    found = F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(0))
    values = F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(rule.group)) if rule.group else found
    gaps = F.split("text", rule.pattern, -1)
    each = F.transform(
        F.arrays_zip(F.slice(gaps, 1, F.size(found)).alias("g"), found.alias("m"), values.alias("v")),
        lambda x: F.struct(
            F.lit(rule.key).alias("rule"), F.length(x["g"]).cast("long").alias("gap"),
            F.length(x["m"]).cast("long").alias("length"),
            (F.length(x["v"]) >= rule.least).alias("kept"),
        ),
    )
    return F.when(
        F.array_contains("todo", rule.key) & F.col("text").rlike(rule.pattern), each
    ).otherwise(F.array().cast("array<struct<rule:string,gap:long,length:long,kept:boolean>>"))


def _scan(blobs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(blob, rules, spans) from (blob, text, todo). Offsets are code points, the end exclusive."""
    hits = blobs.select("blob", "todo", F.posexplode_outer(F.concat(*map(_matches, rules))).alias("i", "m"))
    before = Window.partitionBy("blob", "m.rule").orderBy("i")
    ended = F.sum(F.col("m.gap") + F.col("m.length")).over(before)
    span = F.when(
        F.col("m.kept"),
        F.struct(
            F.col("m.rule").alias("rule"), (F.col("end") - F.col("m.length")).alias("start"), "end"
        ),
    )
    return (
        hits.withColumn("end", ended).groupBy("blob")
        .agg(F.first("todo").alias("rules"), F.collect_list(span).alias("spans"))
    )


def blob_findings(
    work: Work, versions: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """(blob, spans) of the texts of ``versions``, after the ledger has seen them; spans (rule, start,
    end) by start, then by the order of ``rules``.

    The ledger holds each span with the version of its rule, so findings of a rule's older versions
    never show, whether a newer one matches more, less or the same. ``ledger`` is a folder, empty or missing at first; a run that fails before its findings are
    committed leaves it as it was and may be repeated.
    """
    spark = versions.sparkSession
    keys = F.array(*(F.lit(r.key) for r in rules))
    addressed = versions.withColumn("blob", blob_of(F.col("text")))
    known = _ledger(spark, ledger)
    if known is None:
        unseen = addressed.withColumn("todo", keys)
    else:
        done = work.write(
            known.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("done"))
        )
        unseen = (
            addressed.join(done, "blob", "left")
            .withColumn("todo", F.array_except(keys, F.coalesce("done", F.array().cast("array<string>"))))
            .where(F.size("todo") > 0)
        )
    blobs = unseen.groupBy("blob").agg(
        F.first(F.coalesce("text", F.lit(""))).alias("text"), F.first("todo").alias("todo")
    )
    _scan(blobs, rules).write.mode("append").parquet(ledger)

    # Findings of these versions of the rules, each once, though several runs may have scanned the
    # same blob at the same time; only blobs of this run are looked up.
    wanted = work.write(addressed.select("blob").distinct())
    found = (
        _ledger(spark, ledger).join(wanted, "blob", "left_semi")
        .select("blob", F.explode("spans").alias("s"))
        .where(F.col("s.rule").isin([r.key for r in rules])).select("blob", "s.*").distinct()
    )
    place = reduce(
        lambda rest, x: F.when(F.col("rule") == x[1].key, x[0]).otherwise(rest), enumerate(rules), F.lit(len(rules))
    )
    ranked = F.array_sort(F.collect_list(F.struct("start", place.alias("k"), "end")))
    names = F.array(*(F.lit(r.name) for r in rules))
    spans = F.transform(
        ranked, lambda s: F.struct(F.element_at(names, s["k"] + 1).alias("rule"), s["start"].alias("start"), s["end"].alias("end"))
    )
    listed = found.groupBy("blob").agg(spans.alias("spans"))
    return work.write(
        wanted.join(listed, "blob", "left").select("blob", F.coalesce("spans", F.array().cast(_SPANS)).alias("spans")),
        keep=True,
    )


def scan_versions(
    work: Work, versions: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """The columns of ``versions`` (any that name a path and a version) but its text, plus blob
    and spans: the findings of a blob, for every path and version that holds it."""
    names = [c for c in versions.columns if c != "text"]
    findings = blob_findings(work, versions, ledger, rules)
    addressed = versions.select(*names, blob_of(F.col("text")).alias("blob"))
    return addressed.join(findings, "blob", "left").select(
        *names, "blob", F.coalesce("spans", F.array().cast(_SPANS)).alias("spans")
    )


def _ledger(spark: SparkSession, path: str) -> DataFrame | None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return None
    return spark.read.schema(f"blob binary, rules array<string>, spans {_SPANS}").parquet(path)


def spans_text(spans: Column, names: list[str] | None = None) -> Column:
    kept = spans if names is None else F.filter(spans, lambda s: s["rule"].isin(names))
    return F.array_join(
        F.transform(kept, lambda s: F.concat_ws(":", s["rule"], s["start"], s["end"])), ","
    )


def redacted(text: Column, spans: Column, mark: str = "[secret]") -> Column:
    """The text with every maximal run of overlapping spans replaced by a mark; ``spans`` sorted."""
    merged = F.aggregate(
        spans, F.array().cast("array<struct<start:long,end:long>>"),
        lambda done, s: F.when(
            (F.size(done) > 0) & (F.element_at(done, -1)["end"] > s["start"]),
            F.concat(
                F.slice(done, 1, F.size(done) - 1),
                F.array(F.struct(
                    F.element_at(done, -1)["start"].alias("start"),
                    F.greatest(F.element_at(done, -1)["end"], s["end"]).alias("end"),
                )),
            ),
        ).otherwise(F.concat(done, F.array(F.struct(s["start"].alias("start"), s["end"].alias("end"))))),
    )
    starts = F.concat(F.array(F.lit(0).cast("long")), F.transform(merged, lambda s: s["end"]))
    ends = F.concat(F.transform(merged, lambda s: s["start"]), F.array(F.length(text).cast("long")))
    pieces = F.transform(
        F.arrays_zip(starts.alias("a"), ends.alias("b")),
        lambda p: F.substring(text, (p["a"] + 1).cast("int"), (p["b"] - p["a"]).cast("int")),
    )
    return F.when(F.size(spans) > 0, F.array_join(pieces, mark)).otherwise(text)


def secret_report(documents: DataFrame, ledger: str | None = None) -> DataFrame:
    """One row per document: counts and digest of the base findings, and all spans as text.

    A null text is an empty one and has no findings; repeated rows each get a row; a null doc_id
    stays null; an empty table gives no rows; further columns are ignored.
    """
    spark = documents.sparkSession
    docs = chosen(documents, doc_id="long", text="string")
    with Work(spark, "secrets") as work:
        found = scan_versions(work, docs, ledger or work.path(keep=True))
    count = lambda r: F.size(F.filter("spans", lambda s: s["rule"] == r.name)).cast("long")
    return found.select(
        "doc_id", count(ASSIGN).alias("n_assign"), count(ACCESS).alias("n_access"), count(HEX).alias("n_hex"),
        F.sha2(spans_text(F.col("spans"), [r.name for r in BASE]), 256).alias("base_sha256"),
        spans_text(F.col("spans")).alias("spans"),
    )


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_report(read(spark, sf_dir, "documents"))
